"""Identity resolution and document matching across systems without a shared key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import keys as K
from ..functions.clean import surrogate_key
from ..functions.joins import dealt, spread, stored
from ..functions.sequence import row_number, text_list
from ..policy import DEFAULT, Policy

# fixed values: probe and confidence, strongest first
CUSTOMER_PROBES = {"exact_name": 0.95, "alnum_name": 0.90, "domain_stem": 0.75, "core_name": 0.60}
EMPLOYEE_PROBES = {"work_email": 0.99, "person_name": 0.70}
#: Names that one task opens to their probe keys, some tens of rows each.
NAMES_PER_TASK = 20_000


def _confidence(method: Column, table: dict[str, float]) -> Column:
    out = None
    for name, value in table.items():
        lit = F.lit(f"{value:.2f}").cast("decimal(4,2)")
        out = F.when(method == name, lit) if out is None else out.when(method == name, lit)
    return out


# ------------------------------------------------------------ prefix join


def stem_prefixes(names: DataFrame, name: str, lengths: DataFrame, out: str) -> DataFrame:
    """Each name with its prefixes at the stem lengths that occur.

    ``lengths`` is one row holding the array of lengths: the distinct lengths of
    a text column, never more than the longest value has characters.
    """
    per = names.join(F.broadcast(lengths))
    fits = F.filter("stem_lengths", lambda n: n <= F.length(F.col(name)))
    cut = F.transform(fits, lambda n: F.substring(F.col(name), F.lit(1), n))
    return per.withColumn(out, F.explode(cut)).drop("stem_lengths")


def stem_lengths(stems: DataFrame, stem: str, min_len: int = K.MIN_STEM) -> DataFrame:
    """One row: the distinct stem lengths of at least ``min_len``."""
    lens = stems.select(F.length(stem).alias("n")).where(F.col("n") >= min_len).distinct()
    return lens.agg(F.sort_array(F.collect_set("n")).alias("stem_lengths"))


def prefix_match_counts(
    left: DataFrame, stem: str, right: DataFrame, name: str, code: str,
    min_len: int = K.MIN_STEM,
) -> DataFrame:
    """Left rows with how many right names start with their stem, and the first code.

    The right side is folded to one row per prefix before the join, so a stem
    shared by very many names never emits the pairs.
    """
    lengths = stem_lengths(left, stem, min_len)
    folded = (
        stem_prefixes(right.select(name, code), name, lengths, "_prefix")
        .groupBy("_prefix")
        .agg(F.count(F.lit(1)).alias("matches"), F.min(code).alias("first_code"))
    )
    return left.join(folded, F.col(stem) == F.col("_prefix"), "left").drop("_prefix").withColumn(
        "matches", F.coalesce("matches", F.lit(0)))


# ------------------------------------------------- customer resolution


def company_keys(companies: DataFrame, suffixes: Sequence[str] = K.LEGAL_SUFFIXES) -> DataFrame:
    name = F.col("company_name")
    return companies.select(
        "company_id", "company_name", "domain", "is_archived",
        K.name_upper(name).alias("u"), K.name_alnum(name).alias("a"),
        K.name_core(name, suffixes).alias("c"), K.domain_stem(F.col("domain")).alias("s"),
    )


def customer_keys(customers: DataFrame, suffixes: Sequence[str] = K.LEGAL_SUFFIXES) -> DataFrame:
    name = F.col("customer_name")
    return customers.select(
        "customer_code", "customer_name",
        K.name_upper(name).alias("u"), K.name_alnum(name).alias("a"),
        K.name_core(name, suffixes).alias("c"),
    )


def _probe(method: str, key: Column) -> Column:
    return F.struct(F.lit(method).alias("method"), key.alias("key"))


def _left_probes(df: DataFrame, min_len: int) -> DataFrame:
    """One row per (row, probe, key): one scan of the side serves every probe."""
    stem = F.when(F.length("s") >= min_len, F.col("s"))
    probes = F.array(
        _probe("exact_name", F.col("u")), _probe("alnum_name", F.col("a")),
        _probe("domain_stem", stem), _probe("core_name", F.col("c")),
    )
    return df.withColumn("p", F.explode(probes)).select("*", "p.method", "p.key").drop("p").where(
        "key is not null")


def _right_probes(df: DataFrame, lengths: DataFrame) -> DataFrame:
    """As above, the name standing under each of its prefixes for the stem probe."""
    fits = F.filter("stem_lengths", lambda n: n <= F.length("a"))
    prefixes = F.transform(
        fits, lambda n: _probe("domain_stem", F.substring(F.col("a"), F.lit(1), n)))
    probes = F.concat(
        F.array(_probe("exact_name", F.col("u")), _probe("alnum_name", F.col("a")),
                _probe("core_name", F.col("c"))),
        F.coalesce(prefixes, F.array().cast("array<struct<method:string,key:string>>")),
    )
    return (
        df.join(F.broadcast(lengths))
        .withColumn("p", F.explode(probes))
        .select("*", "p.method", "p.key")
        .drop("p", "stem_lengths")
        .where("key is not null")
    )


def customer_xref(
    companies: DataFrame,
    customers: DataFrame,
    suffixes: Sequence[str] = K.LEGAL_SUFFIXES,
    min_stem: int = K.MIN_STEM,
    parts: int | None = None,
) -> DataFrame:
    """Every (company, customer) candidate with its best probe, rank and ambiguity.

    Names are matched, not rows: each side is first folded to its distinct
    names, the four probes run as one equi join on (probe, key), and the matched
    name pairs are scored once. Only then are the names opened to the rows that
    carry them. This table lists candidate pairs by definition; a consumer that
    needs the chosen match per company should use ``best_customer_match``, which
    never forms a pair.
    """
    comp = company_keys(companies, suffixes)
    cust = customer_keys(customers, suffixes)
    left = comp.select("u", "a", "c", "s").distinct()
    right = cust.groupBy("u", "a", "c").agg(F.count(F.lit(1)).alias("members"))
    lp = _left_probes(left, min_stem).select(
        *[F.col(x).alias(f"l_{x}") for x in "uacs"], "method", "key")
    rp = _right_probes(right, stem_lengths(left, "s", min_stem)).select(
        *[F.col(x).alias(f"r_{x}") for x in "uac"], "members", "method", "key")
    conf = _confidence(F.col("method"), CUSTOMER_PROBES)
    l_name, r_name = [f"l_{x}" for x in "uacs"], [f"r_{x}" for x in "uac"]
    names = (
        lp.join(rp, ["method", "key"])
        .withColumn("confidence", conf)
        .groupBy(*l_name, *r_name, "members")
        .agg(
            F.max("confidence").alias("confidence"),
            F.max_by("method", "confidence").alias("match_method"),
            F.count(F.lit(1)).alias("probes_agreeing"),
        )
    )
    # ties are counted on names, weighted by the customers that carry them
    per_conf = {f"n{i}": F.lit(f"{v:.2f}").cast("decimal(4,2)")
                for i, v in enumerate(CUSTOMER_PROBES.values())}
    sizes = names.groupBy(*[F.col(x).alias(f"_{x}") for x in l_name]).agg(
        *[F.sum(F.when(F.col("confidence") == v, F.col("members"))).alias(n)
          for n, v in per_conf.items()])
    tied = F.coalesce(*[F.when(F.col("confidence") == v, F.col(n)) for n, v in per_conf.items()])
    names = names.join(
        sizes, [F.col(x).eqNullSafe(F.col(f"_{x}")) for x in l_name]
    ).select(*l_name, *r_name, "confidence", "match_method", "probes_agreeing", tied.alias("_tied"))
    on_left = [comp[x].eqNullSafe(names[f"l_{x}"]) for x in "uacs"]
    on_right = [cust[x].eqNullSafe(names[f"r_{x}"]) for x in "uac"]
    pairs = comp.join(names, on_left).join(cust, on_right).select(
        "company_id", "company_name", "domain", "is_archived", "customer_code", "customer_name",
        "match_method", "confidence", "probes_agreeing", "_tied",
    )
    ranked = row_number(
        stored(pairs, "candidates"), ["company_id"], ["-confidence", "-probes_agreeing", "customer_code"],
        "candidate_rank", parts)
    return ranked.select(
        surrogate_key(F.col("company_id"), F.col("customer_code")).alias("customer_xref_key"),
        F.col("company_id").alias("crm_company_id"),
        F.col("company_name").alias("crm_company_name"),
        F.col("domain").alias("crm_domain"),
        F.col("is_archived").alias("crm_is_archived"),
        F.col("customer_code").alias("erp_customer_code"),
        F.col("customer_name").alias("erp_customer_name"),
        "match_method",
        "confidence",
        "probes_agreeing",
        "candidate_rank",
        (F.col("_tied") > 1).alias("is_ambiguous"),
        (F.col("candidate_rank") == 1).alias("is_selected"),
    )


def best_customer_match(
    companies: DataFrame,
    customers: DataFrame,
    suffixes: Sequence[str] = K.LEGAL_SUFFIXES,
    min_stem: int = K.MIN_STEM,
) -> DataFrame:
    """The selected candidate per company, without forming the candidate pairs.

    The customer side is folded to one row per probe key, holding the count and
    the lowest code, so a core name shared by a third of the customers is one
    row. Within the strongest probe that hits, all candidates agree on the other
    probes except on the core name; a second key with the core name appended
    finds those that agree on it too, and they win.
    """
    comp = company_keys(companies, suffixes)
    # a small file is one task, however many keys its names are opened to
    cust = customer_keys(spread(customers.select("customer_code", "customer_name"), NAMES_PER_TASK, "customer_code"), suffixes)
    lengths = stem_lengths(comp, "s", min_stem)

    def with_core(df):
        both = F.array(
            F.struct(F.lit(False).alias("core"), F.col("key").alias("k")),
            F.when((F.col("method") != "core_name") & F.col("c").isNotNull(),
                   F.struct(F.lit(True).alias("core"),
                            F.concat_ws("\u0001", "key", "c").alias("k"))),
        )
        return df.withColumn("b", F.explode(both)).where("b is not null").select("*", "b.*").drop(
            "b")

    folded = (
        with_core(_right_probes(cust, lengths))
        .groupBy("method", "core", "k")
        .agg(F.min("customer_code").alias("code"), F.count(F.lit(1)).alias("n"))
    )
    # companies with the same name and stem share one lookup
    asked = with_core(_left_probes(comp.select("u", "a", "c", "s").distinct(), min_stem))
    conf = _confidence(F.col("method"), CUSTOMER_PROBES)
    hits = asked.join(folded, ["method", "core", "k"]).withColumn("confidence", conf)
    best = hits.groupBy("u", "a", "c", "s").agg(
        F.max_by(
            F.struct("code", "method", "confidence"), F.struct("confidence", "core")
        ).alias("best"),
        F.max_by("n", F.struct("confidence", ~F.col("core"))).alias("at_best"),
    )
    key = [comp[x].eqNullSafe(best[x]) for x in "uacs"]
    return comp.join(best, key).select(
        F.col("company_id").alias("crm_company_id"),
        F.col("best.code").alias("erp_customer_code"),
        F.col("best.method").alias("match_method"),
        F.col("best.confidence").alias("confidence"),
        (F.col("at_best") > 1).alias("is_ambiguous"),
    )


def candidate_tiers(
    companies: DataFrame,
    customers: DataFrame,
    suffixes: Sequence[str] = K.LEGAL_SUFFIXES,
    min_stem: int = K.MIN_STEM,
) -> DataFrame:
    """What ``customer_xref`` lists, by counts: the tiers of each company's candidates, without forming a pair.

    A tier holds the customers that the same probes lead to. Both sides are folded to classes of equal names; the customers
    are counted once per key and per key with the core name, and a company class takes the sizes of its tiers from
    at most seven of these counts, since equal names are equal in compact form too. So a core name
    shared by a third of both sides gives one row per company, however many pairs there are. ``first_rank`` is the rank
    of the tier's first candidate, its last one has ``first_rank + members - 1``.
    """
    comp, cust = company_keys(companies, suffixes), customer_keys(customers, suffixes)
    classes = comp.select("u", "a", "c", "s").distinct()
    lengths = stem_lengths(classes, "s", min_stem)
    both = lambda key: F.concat_ws("\u0001", key, "c")

    def counted(kinds: dict[str, Column]) -> Column:
        return F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("key")) for k, v in kinds.items()]))

    def keys(prefix: Column) -> dict[str, Column]:
        a, c = F.col("a"), F.col("c")
        return {"u": F.col("u"), "a": a, "c": c, "uc": F.when(F.col("u").isNotNull() & c.isNotNull(), both(F.col("u"))),
                "ac": F.when(a.isNotNull() & c.isNotNull(), both(a)),
                "p": prefix, "pc": F.when(prefix.isNotNull() & c.isNotNull(), both(prefix))}

    folded = cust.groupBy("u", "a", "c").agg(F.count(F.lit(1)).alias("n"))
    # the five plain keys of a name, and two for each of its prefixes
    none = F.lit(None).cast("string")
    plain = folded.select("n", counted({k: v for k, v in keys(none).items() if k not in ("p", "pc")}).alias("k"))
    prefixed = folded.join(F.broadcast(lengths)).withColumn("p", F.explode(F.transform(
        F.filter("stem_lengths", lambda n: n <= F.length("a")), lambda n: F.substring(F.col("a"), F.lit(1), n))))
    prefixed = prefixed.select("n", counted({k: v for k, v in keys(F.col("p")).items() if k in ("p", "pc")}).alias("k"))
    nodes = plain.unionByName(prefixed).where("k.key is not null").groupBy("k.kind", "k.key").agg(F.sum("n").alias("n"))
    stem = F.when(F.length("s") >= min_stem, F.col("s"))
    asked = classes.select("*", counted(keys(stem)).alias("k")).select("u", "a", "c", "s", "k.*").where("key is not null")
    kinds = ("u", "a", "c", "uc", "ac", "p", "pc")
    wide = asked.join(nodes, ["kind", "key"]).groupBy("u", "a", "c", "s").agg(
        *[F.coalesce(F.max(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)).alias(f"n_{k}") for k in kinds])
    n = {k: F.col(f"n_{k}") for k in kinds}
    # whether the stem also leads to the names that are equal in compact form
    inside = F.coalesce(F.col("a").startswith(stem), F.lit(False))
    more = inside.cast("int")
    same = F.col("a").isNotNull().cast("int")
    sizes = [
        # probe, probes that agree, members
        ("exact_name", 2 + same + more, n["uc"]),
        ("exact_name", 1 + same + more, n["u"] - n["uc"]),
        ("alnum_name", 2 + more, n["ac"] - n["uc"]),
        ("alnum_name", 1 + more, n["a"] - n["ac"] - (n["u"] - n["uc"])),
        ("domain_stem", F.lit(2), n["pc"] - F.when(inside, n["ac"]).otherwise(0)),
        ("domain_stem", F.lit(1), n["p"] - n["pc"] - F.when(inside, n["a"] - n["ac"]).otherwise(0)),
        ("core_name", F.lit(1), n["c"] - n["pc"] - F.when(inside, F.lit(0)).otherwise(n["ac"])),
    ]
    tier = F.explode(F.array(*[F.struct(F.lit(m).alias("match_method"), agree.cast("int").alias("probes_agreeing"),
                                        size.cast("bigint").alias("members")) for m, agree, size in sizes]))
    tiers = wide.select("u", "a", "c", "s", tier.alias("t")).select("u", "a", "c", "s", "t.*").where("members > 0")
    tiers = tiers.withColumn("confidence", _confidence(F.col("match_method"), CUSTOMER_PROBES))
    # a class has seven tiers at most
    along = W.partitionBy("u", "a", "c", "s").orderBy(F.desc("confidence"), F.desc("probes_agreeing"))
    tiers = tiers.withColumn("first_rank", (1 + F.sum("members").over(along) - F.col("members")).cast("bigint"))
    return comp.join(tiers, [comp[x].eqNullSafe(tiers[x]) for x in "uacs"]).select(
        F.col("company_id").alias("crm_company_id"), "match_method", "confidence", "probes_agreeing", "members", "first_rank")


# ------------------------------------------------- employee resolution


def roster_people(roster: DataFrame) -> DataFrame:
    """One person per e-mail: the earliest hire survives, lowest code on a tie."""
    rows = roster.where("work_email is not null").select(
        F.lower("work_email").alias("work_email"), "employee_code",
        F.coalesce("hire_date", F.to_date(F.lit("2100-01-01"))).alias("_hired"),
        K.person_key(F.col("legal_last_name"), F.col("legal_first_name")).alias("person_name_key"),
    )
    people = rows.groupBy("work_email").agg(
        F.min(F.struct("_hired", "employee_code")).alias("_first"),
        F.min("person_name_key").alias("person_name_key"),
    ).select(F.col("_first.employee_code").alias("employee_code"), "work_email",
             "person_name_key")
    codes = text_list(rows, ["work_email"], "employee_code", ",", "all_employee_codes"
                      ).withColumnRenamed("n_items", "duplicate_record_count")
    return people.join(codes, "work_email")


def employee_xref(
    roster: DataFrame, reps: DataFrame, owners: DataFrame, parts: int | None = None
) -> DataFrame:
    """CRM owners by e-mail and ERP reps by LAST FIRST name against the roster."""
    people = roster_people(roster)
    asked = owners.select(
        F.lit("hubspot").alias("source_system"), F.col("owner_id").alias("source_key"),
        F.concat("first_name", F.lit(" "), "last_name").alias("source_label"),
        F.lit("work_email").alias("match_method"), F.lower(F.trim("email")).alias("key"),
    ).unionByName(reps.select(
        F.lit("sage_x3").alias("source_system"), F.col("rep_code").alias("source_key"),
        F.col("rep_name").alias("source_label"),
        F.lit("person_name").alias("match_method"), K.name_upper(F.col("rep_name")).alias("key"),
    ))
    probe = F.explode(F.array(
        F.struct(F.lit("work_email").alias("match_method"), F.col("work_email").alias("key")),
        F.struct(F.lit("person_name").alias("match_method"), F.col("person_name_key").alias("key")),
    ))
    known = people.withColumn("p", probe).select(*people.columns, "p.match_method", "p.key").drop(
        "person_name_key")
    # a record is looked up by one key, so its candidates are the people with that key
    carried = known.groupBy("match_method", "key").agg(F.count(F.lit(1)).alias("_n"))
    pairs = (
        asked.join(carried, ["match_method", "key"])
        .join(known, ["match_method", "key"])
        .drop("key")
        .withColumn("confidence", _confidence(F.col("match_method"), EMPLOYEE_PROBES))
    )
    ranked = row_number(
        stored(pairs, "candidates"), ["source_system", "source_key"], ["-confidence", "employee_code"],
        "candidate_rank", parts)
    return ranked.select(
        surrogate_key(F.col("source_system"), F.col("source_key"), F.col("employee_code"))
        .alias("employee_xref_key"),
        "source_system", "source_key", "source_label",
        F.col("employee_code").alias("payroll_employee_code"),
        "work_email", "duplicate_record_count", "all_employee_codes", "match_method",
        "confidence", "candidate_rank",
        (F.col("_n") > 1).alias("is_ambiguous"),
        (F.col("candidate_rank") == 1).alias("is_selected"),
    )


# ------------------------------------------------- reference repair


def repair_refs(deals: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per order reference of a deal, repaired, with what was repaired."""
    raw = F.col("erp_order_number_raw")
    parts = deals.where(raw.isNotNull()).withColumn(
        "_part", F.explode(F.split(raw, "/"))
    ).withColumn("_part", F.trim("_part")).where("_part <> ''")
    up = F.upper("_part")
    bare = up.rlike("^(US|CA)[0-9]{8}$")
    fixed = F.when(up.rlike("^SO(US|CA)[0-9]{8}$"), up).when(bare, F.concat(F.lit("SO"), up))
    rows = parts.select(
        "deal_id", "erp_order_number_raw", fixed.alias("sales_order_number"),
        (F.instr(raw, "/") > 0).alias("was_split"),
        (up != F.col("_part")).alias("was_case_corrected"),
        bare.alias("was_prefix_restored"),
        "is_closed_won", "is_archived", "deal_amount", "close_date",
    )
    fired = F.concat_ws(
        " + ",
        F.when(F.col("was_split"), "split_multi_value"),
        F.when(F.col("was_case_corrected"), "case_corrected"),
        F.when(F.col("was_prefix_restored"), "prefix_restored"),
    )
    known = orders.select(F.col("sales_order_number").alias("_order")).distinct()
    # all references of a deal stand in one field, so their number is known per row
    n_refs = F.size(F.filter(F.split(raw, "/"), lambda x: F.trim(x) != ""))
    per_deal = deals.where(raw.isNotNull()).groupBy("deal_id").agg(
        F.sum(n_refs).alias("references_on_deal"))
    return (
        rows.withColumn("repair_applied", F.when(fired == "", "as_is").otherwise(fired))
        .join(known, F.col("sales_order_number") == F.col("_order"), "left")
        .withColumn("resolves_to_order", F.col("_order").isNotNull())
        .drop("_order")
        .join(per_deal, "deal_id")
    )


# ------------------------------------------------- return attribution


def return_line(lines: DataFrame, headers: DataFrame, order_lines: DataFrame) -> DataFrame:
    """Return lines attributed to an order line: exact reference, then normalised.

    Both probes look into the same key set, so the pair of candidate keys is
    exploded and joined once; the lines' own columns never travel through it.
    """
    known = order_lines.select(
        F.col("sales_order_number").alias("_order"), F.col("sales_order_line_number").alias("_line"))
    raw = F.col("sales_order_number")
    asked = lines.where(raw.isNotNull()).select(
        raw.alias("_raw"), F.col("sales_order_line_number").alias("_line")).distinct()
    tried = asked.withColumn("p", F.explode(F.array(
        F.struct(F.lit(1).alias("step"), F.col("_raw").alias("_order")),
        F.struct(F.lit(2).alias("step"), F.upper(F.trim("_raw")).alias("_order")),
    ))).select("_raw", "_line", "p.*")
    # a semi join needs no distinct lines, and a number is folded by hash, without a sort
    hit = tried.join(known, ["_order", "_line"], "left_semi").groupBy("_raw", "_line").agg(F.min("step").alias("_step"))
    found = hit.select("_raw", "_line", F.struct(
        F.col("_step").alias("step"),
        F.when(F.col("_step") == 1, F.col("_raw")).otherwise(F.upper(F.trim("_raw"))).alias("_order")).alias("hit"))
    head = headers.select(
        "return_number", F.col("site_code").alias("return_site_code"), "customer_code",
        "return_date", "invoice_number", "return_status")
    rows = lines.withColumnRenamed("sales_order_number", "sales_order_number_raw")
    return (
        rows.join(head, "return_number")
        .join(found, (F.col("sales_order_number_raw") == F.col("_raw"))
              & (F.col("sales_order_line_number") == F.col("_line")), "left")
        .select(
            "return_number", "return_line_number",
            F.col("hit._order").alias("sales_order_number"), "sales_order_line_number",
            "sales_order_number_raw",
            F.when(F.col("hit.step") == 1, "exact").when(F.col("hit.step") == 2, "normalised")
            .alias("order_match_method"),
            "customer_code", F.coalesce("site_code", "return_site_code").alias("site_code"),
            "item_code", "return_date", "invoice_number", "return_status",
            "return_reason_code", "return_reason", "returned_qty", "net_unit_price",
            "line_net_amount", F.col("hit._order").isNull().alias("is_orphan_return"),
        )
    )


# ------------------------------------------------- shipment to order


def with_order(
    shipments: DataFrame, orders: DataFrame, customers: DataFrame, order_lines: DataFrame | None
) -> DataFrame:
    """Shipments with the order behind them by reference, else their customer by name.

    The columns are added to the shipments as they stream by, so the result need
    not be joined back to them. Without ``order_lines`` there is no requested
    date, for callers that do not need it.
    """
    by_name = customers.groupBy(K.name_upper(F.col("customer_name")).alias("_name")).agg(
        F.min("customer_code").alias("_named_code"), F.count(F.lit(1)).alias("_named"))
    order = orders.select(
        "sales_order_number", "ordering_customer_code", "order_date",
        F.col("currency_code").alias("order_currency_code"), "primary_rep_code")
    if order_lines is not None:
        # folded onto the orders first, so that shipments meet their order in one join
        requested = order_lines.where("requested_delivery_date is not null").groupBy("sales_order_number").agg(
            F.max("requested_delivery_date").alias("customer_requested_delivery_date"))
        order = order.join(requested, "sales_order_number", "left")
    else:
        order = order.withColumn("customer_requested_delivery_date", F.lit(None).cast("date"))
    j = shipments.join(order, F.col("reference_number") == F.col("sales_order_number"), "left")
    found = F.col("sales_order_number").isNotNull()
    named = F.coalesce("_named", F.lit(0))
    return (
        j.join(by_name, K.name_upper(F.col("customer_name")) == F.col("_name"), "left")
        .withColumns({
            "customer_code": F.coalesce("ordering_customer_code", "_named_code"),
            "customer_resolution_method": F.when(found, "order_reference")
            .when(F.col("_named_code").isNotNull(), "customer_name").otherwise("unresolved"),
            "has_order_reference": found,
            "customer_name_match_count": named,
            "customer_name_is_ambiguous": (named > 1) & ~found,
            "reference_is_null": F.col("reference_number").isNull(),
            "reference_is_unmatched": F.col("reference_number").isNotNull() & ~found,
        })
    )


def shipment_order(
    shipments: DataFrame, orders: DataFrame, customers: DataFrame, order_lines: DataFrame
) -> DataFrame:
    """One row per shipment: its order, its customer, and how they were found."""
    ships = shipments.select("shipment_id", "reference_number", "customer_name")
    return with_order(ships, orders, customers, order_lines).select(
        "shipment_id", "sales_order_number", "customer_requested_delivery_date", "order_date",
        "order_currency_code", "primary_rep_code", "customer_code", "customer_resolution_method",
        "has_order_reference", "customer_name_match_count", "customer_name_is_ambiguous",
        "reference_is_null", "reference_is_unmatched")


# ------------------------------------------------- three-way match


def three_way_match(
    invoice_lines: DataFrame,
    invoice_headers: DataFrame,
    po_lines: DataFrame,
    receipt_lines: DataFrame,
    policy: Policy = DEFAULT,
    tasks: int | None = None,
) -> DataFrame:
    """Invoice line against its PO line and the receipt it names, with the reason.

    Receipts are folded per (receipt, PO line) first and those rows are folded
    again per PO line. All that meets by the PO line is dealt by it alone, to ``tasks``, so that the invoice lines
    meet the receipt they name and then their PO line without another shuffle.
    """
    po_key = ["purchase_order_number", "purchase_order_line_number"]
    named = dealt(receipt_lines, po_key, tasks).groupBy(*po_key, "receipt_number").agg(
        F.sum("received_qty").alias("received_qty"), F.max("receipt_date").alias("receipt_date"))
    total = named.groupBy(*po_key).agg(
        F.sum("received_qty").alias("total_received_qty"),
        F.max("receipt_date").alias("last_receipt_date"),
        F.count("receipt_number").alias("receipt_count"),
    )
    head = invoice_headers.select(
        "supplier_invoice_number", "supplier_code", "invoice_date", "accounting_date",
        "currency_code", "invoice_status_code")
    po = po_lines.select(*po_key, "ordered_qty",
                         F.col("net_unit_price").alias("ordered_unit_price"))
    j = dealt(invoice_lines.join(head, "supplier_invoice_number"), po_key, tasks)
    # the two sides by PO line meet first; rows sorted for the first join of the invoice lines are sorted for the second too
    j = j.join(named, [*po_key, "receipt_number"], "left").join(
        dealt(po, po_key, tasks).join(total, po_key, "full"), po_key, "left")
    order = [*po_key, "supplier_invoice_number", "receipt_number"]
    j = j.select(*order, *[c for c in [*invoice_lines.columns, *named.columns, *head.columns, *po.columns, *total.columns]
                           if c not in order])

    def pct(actual, base):
        a, b = F.col(actual), F.col(base)
        return F.when(b != 0, F.abs(a - b).cast("double") / F.abs(b).cast("double") * 100)

    late_qty = F.col("qty_variance_pct") > policy.match_qty_tolerance_pct
    if policy.zero_receipt_is_variance:
        late_qty = late_qty | ((F.col("received_qty") == 0) & (F.col("invoiced_qty") != 0))
    return (
        j.withColumns({
            "qty_variance": F.col("invoiced_qty") - F.col("received_qty"),
            "price_variance": F.col("invoiced_unit_price") - F.col("ordered_unit_price"),
            "qty_variance_pct": pct("invoiced_qty", "received_qty"),
            "price_variance_pct": pct("invoiced_unit_price", "ordered_unit_price"),
        })
        .withColumn(
            "match_result",
            F.when(F.col("purchase_order_number").isNull(), "no_purchase_order")
            .when(F.col("ordered_qty").isNull(), "po_line_not_found")
            .when(F.col("received_qty").isNull(), "not_received")
            .when(late_qty, "quantity_variance")
            .when(F.col("price_variance_pct") > policy.match_price_tolerance_pct, "price_variance")
            .otherwise("matched"),
        )
        .withColumn("is_three_way_matched", F.col("match_result") == "matched")
    )

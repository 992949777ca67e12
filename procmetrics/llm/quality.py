"""Quality rules with host verdicts.

Every document gets its base counts and rule failures. Failures are added up
by host (``source``), rates are shrunk with a beta prior fitted to all hosts by
moments, and the verdict on the host is joined back: in a rejected host a document has
to pass every rule, elsewhere only the base rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, store, text_of, words_of

SYMBOLS = "#*$%&|<>"

#: Rule -> condition under which a document fails it.
RULES = {
    "short": "n_words < 50",
    "repeats": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "10 * n_dup_lines > 3 * n_lines",
    "word_length": "word_chars < 2 * n_words or word_chars > 15 * n_words",
}
BASE = ("short", "repeats")
#: A host is rejected when the shrunk rate of a rule is above this share.
HOST_LIMIT = 0.5
#: Bounds of the prior's strength, in documents.
STRENGTH = (1.0, 1000.0)


def count_rules(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Base counts of each document, and one boolean ``fail_<rule>`` per rule.

    All counting stays inside the row: the three-word windows of a document are
    sorted with their positions, equal neighbours are the repeated ones.
    """
    d = docs.select(*keep, text_of().alias("_text"))
    d = d.select(*keep, words_of(F.col("_text")).alias("_w"),
                 F.filter(F.split("_text", "\n", -1), lambda s: F.translate(s, SPACES, "") != "").alias("_lines"),
                 F.length(F.translate("_text", SPACES, "")).cast("long").alias("word_chars"),
                 (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"))
    d = d.select(*keep, F.size("_w").cast("long").alias("n_words"), "word_chars", "n_symbols",
                 F.size("_lines").cast("long").alias("n_lines"),
                 (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
                 F.sort_array(F.transform(
                     F.slice("_w", F.lit(1), F.greatest(F.size("_w") - 2, F.lit(0))),
                     lambda w, i: F.struct(F.concat_ws(" ", w, F.get("_w", i + 1), F.get("_w", i + 2)).alias("w"),
                                           i.alias("p")))).alias("_s"))
    same = lambda x, j: F.coalesce(x["w"] == F.get("_s", j)["w"], F.lit(False))
    d = d.withColumn("_p", F.sort_array(F.transform(
        F.filter("_s", lambda x, j: same(x, j - 1) | same(x, j + 1)), lambda x: x["p"])))
    zero = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
    d = d.withColumn("n_repeat_words", F.aggregate(
        "_p", zero, lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"),
                                          p.alias("last")), lambda a: a["n"]).cast("long"))
    return d.drop("_s", "_p").select("*", *(F.expr(c).alias(f"fail_{r}") for r, c in RULES.items()))


def host_verdicts(counted: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """One row per host: documents, shrunk failure rate per rule, ``host_rejected``."""
    hosts = counted.where("source is not null").groupBy("source").agg(
        F.count("*").alias("n"), *(F.sum(F.col(f"fail_{r}").cast("long")).alias(f"f_{r}") for r in RULES))
    prior = hosts.agg(F.avg(1 / F.col("n")).alias("inv"), *(
        x for r in RULES for x in (F.avg(F.col(f"f_{r}") / F.col("n")).alias(f"m_{r}"),
                                   F.var_pop(F.col(f"f_{r}") / F.col("n")).alias(f"v_{r}"))))

    def shrunk(r: str) -> Column:
        m, v = F.col(f"m_{r}"), F.col(f"v_{r}")
        spread = v - m * (1 - m) * F.col("inv")
        strength = F.when(spread <= 0, F.lit(STRENGTH[1])).otherwise(
            F.greatest(F.lit(STRENGTH[0]), F.least(F.lit(STRENGTH[1]), m * (1 - m) / spread - 1)))
        return (F.col(f"f_{r}") + m * strength) / (F.col("n") + strength)

    rated = hosts.crossJoin(F.broadcast(prior)).select("source", "n", *(shrunk(r).alias(f"rate_{r}") for r in RULES))
    return rated.withColumn("host_rejected", F.greatest(*(F.col(f"rate_{r}") for r in RULES)) > limit)


def judge(docs: DataFrame, keep: list[str] | None = None, limit: float = HOST_LIMIT) -> DataFrame:
    """Counts, ``base_failed``, ``host_rejected`` and ``kept`` for each row of ``docs`` (doc_id, text, source).

    A null text has no words. A null source belongs to no host: its documents
    are judged by the base rules alone. Repeated rows are judged one by one.
    ``keep`` names the columns carried along (default doc_id). Columns of other names
    are not read; an empty table gives an empty result.
    """
    keep = ["doc_id"] if keep is None else keep
    counted = store(count_rules(docs, list(dict.fromkeys([*keep, "source"]))), "quality")
    verdicts = host_verdicts(counted, limit).select(F.col("source").alias("_host"), "host_rejected")
    out = counted.join(verdicts, counted["source"] == F.col("_host"), "left")
    base = F.greatest(*(F.col(f"fail_{r}") for r in BASE))
    any_rule = F.greatest(*(F.col(f"fail_{r}") for r in RULES))
    rejected = F.coalesce("host_rejected", F.lit(False))
    return out.select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      base.alias("base_failed"), rejected.alias("host_rejected"),
                      (~base & ~(rejected & any_rule)).alias("kept"))


def filter_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns, whatever their names.

    The verdict of a row follows from its text and its host's verdict; rows travel whole as one
    struct, so extra columns cannot clash.
    """
    row = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("_row"), "text", "source")
    return judge(row, keep=["_row"]).where("kept").select("_row.*")


ORACLE = """
with d as (select doc_id, source, coalesce(text, '') as t from documents),
w as (select *, list_filter(regexp_split_to_array(t, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') as ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_replace(x, '[ \\t\\n\\x0B\\f\\r]+', '', 'g') <> '') as ls
      from d),
win as (select doc_id, p, ws[p] || ' ' || ws[p + 1] || ' ' || ws[p + 2] as g
        from (select doc_id, ws, unnest(range(1, len(ws) - 1)) as p from w)),
rep as (select doc_id, p from win
        qualify count(*) over (partition by doc_id, g) >= 2),
cov as (select doc_id, count(distinct q) as n
        from (select doc_id, unnest([p, p + 1, p + 2]) as q from rep) group by doc_id),
c as (select w.doc_id, source, len(ws) as n_words,
        length(regexp_replace(t, '[ \\t\\n\\x0B\\f\\r]+', '', 'g')) as word_chars,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
        len(ls) as n_lines, len(ls) - len(list_distinct(ls)) as n_dup_lines,
        coalesce(cov.n, 0) as n_repeat_words
      from w left join cov on cov.doc_id = w.doc_id),
r as (select *, n_words < 50 as f1, 100 * n_repeat_words > 50 * n_words as f2, 10 * n_symbols > n_words as f3,
        10 * n_dup_lines > 3 * n_lines as f4, word_chars < 2 * n_words or word_chars > 15 * n_words as f5
      from c),
long as (select source, unnest([1, 2, 3, 4, 5]) as rule, unnest([f1, f2, f3, f4, f5]) as f from r
         where source is not null),
h as (select source, rule, count(*) as n, sum(f::int) as fails from long group by all),
pr as (select rule, avg(1.0::double / n) as inv, avg(fails::double / n) as m, var_pop(fails::double / n) as v
       from h group by rule),
st as (select rule, m, case when v - m * (1 - m) * inv <= 0 then 1000.0::double
         else greatest(1.0::double, least(1000.0::double, m * (1 - m) / (v - m * (1 - m) * inv) - 1)) end as k
       from pr),
bad as (select source, bool_or((fails + m * k) / (n + k) > 0.5) as host_rejected
        from h join st using (rule) group by source)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
  n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words,
  f1 or f2 as base_failed, coalesce(host_rejected, false) as host_rejected,
  not (f1 or f2) and not (coalesce(host_rejected, false) and (f1 or f2 or f3 or f4 or f5)) as kept
from r left join bad using (source)
"""

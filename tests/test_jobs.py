"""The planted defects, each on hand-made rows, and matching against brute force."""

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from small import SMALL

from procmetrics.functions.keys import LEGAL_SUFFIXES
from procmetrics.operators import dims, events, facts, fx, lines, match, scd2
from procmetrics.plans.inputs import Inputs
from procmetrics.policy import Policy

D = dt.date


def money(x):
    return None if x is None else Decimal(str(x))


NAMES = ["Acme Hydraulics", "ACME hydraulics", "Acme-Hydraulics", "Acme Hydraulics LLC",
         "Acme Hydraulics, Inc.", "Acme  Hydraulics Inc", "Redstone Machine Works",
         "Redstone Machine Works Ltd", "Redstone Machine", "Zenith", "zenith co", "", "---"]


def parties(spark):
    companies = spark.createDataFrame(
        [(f"h{i}", n, f"{re.sub('[^a-z0-9]', '', (n or '').lower())[:18]}.com", i % 5 == 0)
         for i, n in enumerate(NAMES + ["Nobody Knows", None])],
        "company_id string, company_name string, domain string, is_archived boolean")
    customers = spark.createDataFrame(
        [(f"c{i}", n) for i, n in enumerate(NAMES * 2)],
        "customer_code string, customer_name string")
    return companies, customers


def brute_force(companies, customers):
    """All pairs, scored in plain Python."""
    def keys(n):
        if n is None:
            return None, None, None
        plain = re.sub("[^a-zA-Z0-9 ]", "", n)
        core = re.sub(r"(?i)\s+(" + "|".join(LEGAL_SUFFIXES) + ")$", "", plain)
        return n.strip().upper(), re.sub("[^a-zA-Z0-9]", "", n).upper(), re.sub(
            r"\s+", " ", core).upper()

    out = {}
    for h in companies.collect():
        u, a, c = keys(h.company_name)
        stem = re.sub(r"\..*$", "", h.domain).upper()
        cands = []
        for x in customers.collect():
            xu, xa, xc = keys(x.customer_name)
            hits = [(0.95, "exact_name")] * (u is not None and u == xu)
            hits += [(0.90, "alnum_name")] * (a is not None and a == xa)
            hits += [(0.75, "domain_stem")] * (len(stem) >= 12 and xa.startswith(stem))
            hits += [(0.60, "core_name")] * (c is not None and c == xc)
            if hits:
                cands.append((-max(hits)[0], -len(hits), x.customer_code, max(hits)[1]))
        cands.sort()
        for rank, (conf, n, code, method) in enumerate(cands, 1):
            tied = sum(k[0] == conf for k in cands) > 1
            out[(h.company_id, code)] = (method, -conf, -n, rank, tied)
    return out


@pytest.mark.parametrize("parts", [None, 100])
def test_customer_xref_equals_brute_force(spark, parts):
    companies, customers = parties(spark)
    want = brute_force(companies, customers)
    got = {(r.crm_company_id, r.erp_customer_code):
           (r.match_method, float(r.confidence), r.probes_agreeing, r.candidate_rank, r.is_ambiguous)
           for r in match.customer_xref(companies, customers, parts=parts).collect()}
    assert got == want
    best = {r.crm_company_id: (r.erp_customer_code, r.match_method, r.is_ambiguous)
            for r in match.best_customer_match(companies, customers).collect()}
    assert best == {h: (c, v[0], v[4]) for (h, c), v in want.items() if v[3] == 1}


def test_candidate_tiers_count_what_the_pairs_list(spark):
    companies, customers = parties(spark)
    want = {}
    for (h, _), (method, conf, agree, rank, _) in brute_force(companies, customers).items():
        n, first = want.get((h, method, conf, agree), (0, 10**9))
        want[h, method, conf, agree] = n + 1, min(first, rank)
    got = {(r.crm_company_id, r.match_method, float(r.confidence), r.probes_agreeing): (r.members, r.first_rank)
           for r in match.candidate_tiers(companies, customers).collect()}
    assert got == want


def test_a_core_name_of_a_third_of_both_sides_gives_no_pairs(spark):
    """10,000 names a side with one core: the tiers are one row a company, no step makes more rows than keys."""
    side = spark.range(30_000).selectExpr("id", "if(id % 3 = 0, 'Acme', concat('Name', id)) as core",
                                          "element_at(array('Inc', 'Ltd', 'LLC', ''), int(id % 4 + 1)) as form")
    name = "trim(concat(core, ' ', form))"
    companies = side.selectExpr("concat('h', id) as company_id", f"{name} as company_name",
                                "concat('x', id, '.com') as domain", "false as is_archived")
    customers = side.selectExpr("concat('c', id) as customer_code", f"{name} as customer_name")
    got = match.candidate_tiers(companies, customers)
    hot = got.where("crm_company_id = 'h0'").agg(F.sum("members")).first()[0]
    assert hot == 10_000 and got.count() <= 4 * 30_000


def test_best_match_never_forms_the_pairs(spark):
    companies, customers = parties(spark)
    plan = match.best_customer_match(companies, customers)._jdf.queryExecution().toString()
    # the customers reach the join folded: one row per probe key
    assert re.search(r"Aggregate \[method.*min\(customer_code", plan)


def test_contested_customer_keeps_one_company(spark):
    customers = spark.createDataFrame(
        [("1", "Acme", "g", "USD", "N30", Decimal("5"), "A", "r1", None, D(2020, 1, 1))],
        "customer_code string, customer_name string, customer_group_code string, "
        "currency_code string, payment_term_code string, credit_limit_amount decimal(18,4), "
        "accounting_code string, primary_rep_code string, secondary_rep_code string, "
        "created_date date")
    companies = spark.createDataFrame(
        [("a", "ACME", "x.com", "i1"), ("b", "Acme", "y.com", "i2"), ("z", "Other", "z.com", "i3")],
        "company_id string, company_name string, domain string, industry string").select(
        "*", F.lit(1.0).alias("employee_count"), F.lit(1.0).alias("annual_revenue"),
        F.lit("US").alias("country"), F.lit(D(2020, 1, 1)).alias("created_date"),
        F.lit(False).alias("is_archived"))
    best = match.best_customer_match(companies, customers)
    dim = {r.customer_key: r for r in dims.dim_customer(
        customers, spark.createDataFrame([("1", "US")], "partner_code string, country_code string"),
        companies, best, spark.createDataFrame([("r1", "Rep")], "rep_code string, rep_name string")
    ).collect()}
    assert set(dim) == {"X3-1", "HS-z", "UNKNOWN"}
    assert (dim["X3-1"].crm_company_id, dim["X3-1"].crm_company_count) == ("b", 2)
    assert dim["X3-1"].customer_name == "Acme" and dim["X3-1"].industry == "i2"
    assert dim["UNKNOWN"].source_scope == "unknown"


def test_roster_is_deduplicated_before_matching(spark):
    roster = spark.createDataFrame(
        [("E2", "Ann", "Lee", "Ann@x.com", D(2021, 1, 1)), ("E1", "Ann", "Lee", "ann@X.com", None),
         ("E3", "Bob", "Ray", None, D(2019, 1, 1)), ("E4", "Cy", "Lee", "cy@x.com", None)],
        "employee_code string, legal_first_name string, legal_last_name string, work_email string, "
        "hire_date date")
    reps = spark.createDataFrame([("R1", " lee ann "), ("R2", "RAY BOB")],
                                 "rep_code string, rep_name string")
    owners = spark.createDataFrame([("O1", " ANN@X.COM ", "A", "L")],
                                   "owner_id string, email string, first_name string, last_name string")
    got = {(r.source_key, r.payroll_employee_code, r.duplicate_record_count, r.all_employee_codes,
            r.is_ambiguous) for r in match.employee_xref(roster, reps, owners).collect()}
    assert got == {("R1", "E2", 2, "E1,E2", False), ("O1", "E2", 2, "E1,E2", False)}


def test_reference_repair(spark):
    deals = spark.createDataFrame(
        [("d1", "sous26001710"), ("d2", "US25000718"), ("d3", "SOUS25002068 / us24001818"),
         ("d4", "SOCA25000001"), ("d5", "junk"), ("d6", " / "), ("d7", None)],
        "deal_id string, erp_order_number_raw string").select(
        "*", F.lit(True).alias("is_closed_won"), F.lit(False).alias("is_archived"),
        F.lit(1.0).alias("deal_amount"), F.lit(D(2024, 1, 1)).alias("close_date"))
    orders = spark.createDataFrame([("SOUS25000718",), ("SOUS24001818",)],
                                   "sales_order_number string")
    got = {(r.deal_id, r.sales_order_number, r.repair_applied, r.resolves_to_order,
            r.references_on_deal) for r in match.repair_refs(deals, orders).collect()}
    assert got == {
        ("d1", "SOUS26001710", "case_corrected", False, 1),
        ("d2", "SOUS25000718", "prefix_restored", True, 1),
        ("d3", "SOUS25002068", "split_multi_value", False, 2),
        ("d3", "SOUS24001818", "split_multi_value + case_corrected + prefix_restored", True, 2),
        ("d4", "SOCA25000001", "as_is", False, 1), ("d5", None, "case_corrected", False, 1)}


def test_three_way_match_outcomes(spark):
    q = "decimal(18,4)"
    inv = spark.createDataFrame(
        [("I", 1, "P", 1, "R1", money(5), money(10)), ("I", 2, "P", 1, "R2", money(5), money(10)),
         ("I", 3, None, None, None, money(1), money(1)), ("I", 4, "P", 9, "R1", money(1), money(1)),
         ("I", 5, "P", 1, None, money(5), money(10)), ("I", 6, "P", 1, "R1", money(6), money(99)),
         ("I", 7, "P", 1, "R1", money(5), money("10.3")), ("I", 8, "P", 1, "R1", money(5), money("10.2")),
         ("I", 9, "P", 1, "R0", money(4), money(10))],
        f"supplier_invoice_number string, supplier_invoice_line_number int, "
        f"purchase_order_number string, purchase_order_line_number int, receipt_number string, "
        f"invoiced_qty {q}, invoiced_unit_price {q}")
    head = spark.createDataFrame([("I", "V", D(2024, 1, 1), None, "USD", 1)],
                                 "supplier_invoice_number string, supplier_code string, "
                                 "invoice_date date, accounting_date date, currency_code string, "
                                 "invoice_status_code int")
    po = spark.createDataFrame([("P", 1, money(10), money(10))],
                               f"purchase_order_number string, purchase_order_line_number int, "
                               f"ordered_qty {q}, net_unit_price {q}")
    rc = spark.createDataFrame(
        [("R1", "P", 1, money(2), D(2024, 1, 1)), ("R1", "P", 1, money(3), D(2024, 1, 2)),
         ("R2", "P", 1, money(5), D(2024, 2, 1)), ("R0", "P", 1, money(0), D(2024, 2, 1))],
        f"receipt_number string, purchase_order_number string, purchase_order_line_number int, "
        f"received_qty {q}, receipt_date date")
    res = lambda pol: {r.supplier_invoice_line_number: r.match_result
                       for r in match.three_way_match(inv, head, po, rc, pol).collect()}
    want = {1: "matched", 2: "matched", 3: "no_purchase_order", 4: "po_line_not_found",
            5: "not_received", 6: "quantity_variance", 7: "price_variance", 8: "matched",
            9: "matched"}
    assert res(Policy()) == want
    assert res(Policy(zero_receipt_is_variance=True)) == {**want, 9: "quantity_variance"}
    row = match.three_way_match(inv, head, po, rc).where("supplier_invoice_line_number = 2").first()
    assert (row.total_received_qty, row.receipt_count) == (10, 3)


def test_milestones_follow_the_sequence(spark):
    ev = spark.createDataFrame(
        [("s", 1, "PU", D(2024, 1, 3), None), ("s", 2, "IT", D(2024, 1, 2), "x"),
         ("s", 3, "PU", D(2024, 1, 1), "y"), ("s", 4, "DL", None, "a"),
         ("s", 5, "DL", D(2024, 1, 9), None), ("s", 6, "EX", D(2024, 1, 8), "b")],
        "shipment_id string, event_sequence bigint, event_code string, event_at date, "
        "event_location string")
    for parts in (None, 3):
        r = events.milestones(ev, parts=parts).first()
        assert r.picked_up_date == D(2024, 1, 3) and r.delivered_event_date == D(2024, 1, 9)
        assert (r.delivery_location, r.transit_days, r.in_transit_scan_count) == ("a", 6, 1)
        assert (r.out_of_sequence_event_count, r.had_exception, r.event_count) == (3, True, 6)


def test_charges_collapse_to_zero_when_absent(spark):
    ship = spark.createDataFrame([("a", money(10)), ("b", money(7))],
                                 "shipment_id string, header_cost_usd decimal(18,4)")
    ch = spark.createDataFrame([("a", "FREIGHT", money(4)), ("a", "DETENTION", money(2)),
                                ("a", "ODD", money(1))],
                               "shipment_id string, charge_code string, "
                               "charge_amount_usd decimal(18,4)")
    got = {r.shipment_id: r for r in lines.shipment_charge(ch, ship).collect()}
    assert (got["a"].charge_total_usd, got["a"].accessorial_usd, got["a"].detention_usd,
            got["a"].cost_variance_usd) == (7, 3, 2, -3)
    assert (got["b"].charge_total_usd, got["b"].charge_line_count,
            got["b"].cost_variance_usd) == (0, 0, -7)


def test_fx_falls_back_to_the_currency_then_to_one(spark):
    rates = spark.createDataFrame(
        [("CAD", D(2024, 1, 1), money("0.7"), money("0.75"))],
        "currency_code string, rate_month date, rate_to_reporting_currency decimal(18,6), "
        "fallback_rate decimal(18,6)")
    df = spark.createDataFrame(
        [(1, "CAD", D(2024, 1, 9)), (2, "CAD", D(2024, 2, 9)), (3, "EUR", D(2024, 1, 9)),
         (4, "CAD", None)], "id int, cur string, d date")
    got = {r.id: (float(r.fx_rate), r.fx_rate_is_fallback)
           for r in fx.with_fx(df, rates, "cur", "d").collect()}
    assert got == {1: (0.7, False), 2: (0.75, True), 3: (1.0, True), 4: (0.75, True)}
    # rates that are too many to be broadcast give the same
    dealt = fx.with_fx(df, rates, "cur", "d", most=0)
    assert "_salt" in dealt._jdf.queryExecution().toString()
    assert {r.id: (float(r.fx_rate), r.fx_rate_is_fallback) for r in dealt.collect()} == got


def test_needed_columns_leave_out_whole_sides(spark):
    from small import SMALL
    from procmetrics.plans.inputs import Inputs
    from procmetrics.plans.models import Models
    m = Models(Inputs(spark, SMALL))
    need = {"shipment_id", "is_on_time_vs_carrier_promise", "site_code"}
    slim = m.model("fct_shipment", need)
    assert set(slim.columns) == need
    assert "events.parquet" not in "".join(slim.inputFiles())
    full = m.fct_shipment.select(*sorted(need))
    assert slim.select(*sorted(need)).exceptAll(full).isEmpty()
    assert full.exceptAll(slim.select(*sorted(need))).isEmpty()


def test_count_line_zero_quantity_rules(spark):
    q = "decimal(18,4)"
    cl = spark.createDataFrame(
        [("S", 1, money(0), money(0)), ("S", 2, money(0), money(3)), ("S", 3, money(100), money(101)),
         ("S", 4, money(5), None)],
        f"count_session_number string, count_line_number int, system_qty {q}, counted_qty {q}"
    ).select("*", *[F.lit("x").alias(c) for c in ("item_code", "site_code", "location_code", "lot_code")])
    se = spark.createDataFrame([("S", D(2024, 1, 1), "t", "s", "u")],
                               "count_session_number string, count_date date, count_type string, "
                               "session_status string, counted_by string")
    flags = lambda tol: {r.count_line_number: r.is_accurate_position
                         for r in facts.fct_inventory_count_line(
                             cl, se, Policy(inventory_accuracy_tolerance_pct=tol)).collect()}
    assert flags(0.0) == {1: True, 2: False, 3: False, 4: None}
    assert flags(2.0) == {1: True, 2: False, 3: True, 4: None}


def test_scd2_replay_is_stable(spark):
    cols = "k string, a string, b int"
    looks = [[("1", "x", 1), ("2", None, 1)], [("1", "x", 1), ("2", "y", 1), ("3", "z", 1)],
             [("1", "w", 1), ("3", "z", 1)], [("1", "x", 1), ("3", "z", 2)]]
    h = None
    for n, look in enumerate(looks):
        h = scd2.snapshot_scd2(spark.createDataFrame(look, cols), h, ["k"], ["a"], D(2024, 1, n + 1))
        again = scd2.snapshot_scd2(spark.createDataFrame(look, cols), h, ["k"], ["a"],
                                   D(2024, 1, n + 1))
        assert again.exceptAll(h).isEmpty() and h.exceptAll(again).isEmpty()
    got = {(r.k, r.a, r.valid_from.day, r.valid_to and r.valid_to.day) for r in h.collect()}
    assert got == {("1", "x", 1, 3), ("1", "w", 3, 4), ("1", "x", 4, None),
                   ("2", None, 1, 2), ("2", "y", 2, None), ("3", "z", 2, None)}
    assert h.count() == len(got)


def test_ledger_and_balance_facts_read_our_own_staging(spark):
    from procmetrics.operators import facts, staging

    day = dt.date(2024, 5, 6)
    head = spark.createDataFrame(
        [("J1", "STD", "SAL ", "C", "F", day, "USD", " text ", "V1 ", 1)],
        "NUM_0 string, TYP_0 string, JOU_0 string, CPY_0 string, FCY_0 string, ACCDAT_0 date, "
        "CUR_0 string, DES_0 string, VCRNUM_0 string, STA_0 int")
    line = spark.createDataFrame(
        [("J1 ", 1, "4000", -1, 5.0, 6.0, "B", "F ", "D", day)],
        "NUM_0 string, LIN_0 int, ACC_0 string, SNS_0 int, AMTCUR_0 double, AMTLOC_0 double, "
        "BPR_0 string, FCY_0 string, DSP_0 string, ACCDAT_0 date")
    headers = staging.stage_table("erp", "GACCENTRY", head)
    assert {"journal_code", "source_document_number", "entry_status_code", "description"} <= set(headers.columns)
    got = facts.fct_gl_entry_line(staging.stage_table("erp", "GACCENTRYD", line), headers).first()
    assert (got.journal_code, got.site_code, got.accounting_date) == ("SAL", "F", day)
    stock = spark.createDataFrame(
        [("F", "I1 ", "L", "A1", 4.0, "Q ", "me")],
        "STOFCY_0 string, ITMREF_0 string, LOT_0 string, LOC_0 string, QTYSTU_0 double, STA_0 string, OWNER_0 string")
    assert facts.fct_inventory_balance(staging.stage_table("erp", "STOCK", stock)).first().stock_status == "Q"


def test_no_staging_name_is_guessed_for_table_specific_codes():
    from procmetrics.operators.staging import TABLE_NAMES, alias_for

    assert alias_for("erp", "ATEXTRA", "TEXTE_0") == "translated_text"
    assert alias_for("erp", "APLSTD", "TEXTE_0") == "menu_label"
    assert alias_for("erp", "STOJOU", "VCRNUM_0") == "document_number"
    assert alias_for("erp", "GACCENTRY", "VCRNUM_0") == "source_document_number"
    assert all(alias_for("erp", t, c) == n for (t, c), n in TABLE_NAMES.items())


def explained(df):
    return df._jdf.queryExecution().toString()


def test_published_buckets_follow_the_number_of_lines(spark, monkeypatch):
    from procmetrics.plans import queries_io

    monkeypatch.setattr(queries_io, "LINES_PER_BUCKET", 500, raising=False)
    inputs = Inputs(spark, SMALL)
    buckets = -(-inputs.raw("lineitem").count() // 500)
    assert buckets > 8 and f"out of {buckets}" in explained(queries_io.publish_bucketed(inputs))


def test_customers_are_dealt_before_their_names_are_opened(spark, monkeypatch):
    monkeypatch.setattr(match, "NAMES_PER_TASK", 50, raising=False)
    i = Inputs(spark, SMALL)
    plan = explained(match.best_customer_match(i.company, i.bpcustomer)).partition("== Physical Plan ==")[2]
    assert "hashpartitioning(customer_code" in plan and "REPARTITION_BY_NUM" in plan


def test_returns_find_their_lines_without_a_sort_to_fold(spark):
    """Attribution by hash: the exact reference first, then the normalised one, null keys never, lines may repeat."""
    lines = spark.createDataFrame(
        [("R1", 1, "SO1", 1), ("R1", 2, " so1 ", 1), ("R1", 3, "so9", 1), ("R1", 4, None, 1), ("R1", 5, "SO1", None)],
        "return_number string, return_line_number int, sales_order_number string, sales_order_line_number int").selectExpr(
        "*", "'s' as site_code", "'i' as item_code", "1 as return_reason_code", "'r' as return_reason",
        "1 as returned_qty", "1 as net_unit_price", "1 as line_net_amount")
    heads = spark.sql("select 'R1' as return_number, 's' as site_code, 'c' as customer_code, date'2024-01-01' as return_date, "
                      "'I1' as invoice_number, 'Open' as return_status")
    known = spark.createDataFrame([("SO1", 1), ("SO1", 1), (None, 1), ("SO1", None)],
                                  "sales_order_number string, sales_order_line_number int")
    got = match.return_line(lines, heads, known)
    assert "SortAggregate" not in explained(got)
    assert {r.return_line_number: (r.sales_order_number, r.order_match_method) for r in got.collect()} == {
        1: ("SO1", "exact"), 2: ("SO1", "normalised"), 3: (None, None), 4: (None, None), 5: (None, None)}
    assert got.count() == 5


def test_lines_are_dealt_once_to_fold_and_to_meet_their_order(spark):
    i = Inputs(spark, SMALL)
    i.line_tasks = 3
    plan = explained(i.shipment).partition("== Physical Plan ==")[2]
    assert plan.count("hashpartitioning(l_orderkey") == 1 and "hashpartitioning(l_orderkey#" in plan
    assert "l_linenumber" not in "".join(x for x in plan.splitlines() if "Exchange" in x)
    assert "REPARTITION_BY_NUM" in "".join(
        x for x in explained(i._position).partition("== Physical Plan ==")[2].splitlines() if "hashpartitioning(part" in x or "hashpartitioning(l_partkey" in x)


def test_invoice_lines_are_dealt_by_po_line_once(spark):
    """PO lines that repeat, receipts without a PO line, and null keys give the rows of four plain left joins."""
    po = "purchase_order_number string, purchase_order_line_number bigint"
    inv = spark.createDataFrame([("I1", "P1", 1, "R1", 5), ("I1", "P1", 1, "R2", 5), ("I2", "P2", 1, "R3", 5), ("I2", None, 1, None, 5),
                                 ("I3", "P3", 1, "R1", 5), ("I9", "P1", 1, "R1", 5)],
                                f"supplier_invoice_number string, {po}, receipt_number string, invoiced_qty int").selectExpr(
        "*", "2 as invoiced_unit_price")
    heads = spark.createDataFrame([("I1",), ("I2",), ("I3",)], "supplier_invoice_number string").selectExpr(
        "*", "'V' as supplier_code", "date'2024-01-01' as invoice_date", "date'2024-01-02' as accounting_date",
        "'USD' as currency_code", "1 as invoice_status_code")
    lines = spark.createDataFrame([("P1", 1, 5), ("P1", 1, 6), (None, 1, 7)], f"{po}, ordered_qty int").selectExpr("*", "2 as net_unit_price")
    got_in = spark.createDataFrame([("R1", "P1", 1, 5), ("R3", "P2", 1, 5), ("R4", "P2", 1, 1), (None, None, 1, 9)],
                                   f"receipt_number string, {po}, received_qty int").selectExpr("*", "date'2024-01-03' as receipt_date")
    with_merge = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = match.three_way_match(inv, heads, lines, got_in)
        joins = explained(got).partition("== Physical Plan ==")[2].count("LeftOuter")
        found = sorted(((r.supplier_invoice_number, r.purchase_order_number, r.receipt_number, r.ordered_qty, r.received_qty,
                         r.total_received_qty, r.receipt_count) for r in got.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", with_merge)
    assert joins == 2
    assert found == sorted([
        ("I1", "P1", "R1", 5, 5, 5, 1), ("I1", "P1", "R1", 6, 5, 5, 1), ("I1", "P1", "R2", 5, None, 5, 1),
        ("I1", "P1", "R2", 6, None, 5, 1), ("I2", "P2", "R3", None, 5, 6, 2), ("I2", None, None, None, None, None, None),
        ("I3", "P3", "R1", None, None, None, None)], key=str)


def test_lossless_deals_builds_that_are_dealt_by_a_part_of_their_columns(spark):
    """Both builds are folded by one column; counting their rows is dealt by all columns, to the tasks asked for."""
    from procmetrics.operators.quality import lossless

    rows = spark.createDataFrame([(i % 40, i) for i in range(400)] + [(None, 1), (None, None)], "k int, v int")
    a, b = (df.groupBy("k").agg(F.sum("v").alias("s")) for df in (rows, rows.where("v is null or v <> 7")))
    found = lossless(a, b, tasks=7)
    plan = explained(found).partition("== Physical Plan ==")[2]
    assert "REPARTITION_BY_NUM" in plan and re.search(r"hashpartitioning\(k#\d+, s#\d+L, 7\)", plan)
    got = {tuple(r) for r in found.collect()}
    assert got == {tuple(r) for r in lossless(a, b).collect()} == {(7, 1870, 1, 0), (7, 1863, 0, 1)}
    assert lossless(a, a, tasks=7).count() == 0


def exchanges(df):
    return [x for x in explained(df).partition("== Physical Plan ==")[2].splitlines() if "Exchange" in x]


@pytest.mark.parametrize("tasks", [None, 3, 9])
def test_order_lines_meet_their_order_without_being_dealt_again(spark, tasks):
    """Lines that repeat or have no order give the rows of plain joins, and one shuffle a side."""
    from procmetrics.session import CO_PARTITION

    key = "sales_order_number string, sales_order_line_number bigint"
    q = spark.createDataFrame([("S1", 1, "a"), ("S1", 1, "b"), ("S1", 2, "c"), ("S2", 1, "d"), (None, 1, "e"), ("S3", None, "f")],
                              f"{key}, item_code string")
    p = spark.createDataFrame([("S1", 1, "a"), ("S1", 2, "x"), ("S1", 2, "c"), ("S2", 1, "d"), (None, 1, "e")], f"{key}, item_code string")
    inv = spark.createDataFrame([("I1", "S1", 1, 5), ("I1", "S1", 1, 6), ("I2", "S2", 1, 7), ("I1", None, 1, 9)],
                                f"invoice_number string, {key}, line_net_amount int")
    sin = spark.createDataFrame([("I1", "SIN"), ("I2", "SCN")], "invoice_number string, invoice_type_code string")
    heads = spark.createDataFrame([("S1", "n1"), ("S1", "n2"), ("S2", "n3"), (None, "n4")], "sales_order_number string, site string")
    was = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", CO_PARTITION)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")

    def build():
        j = lines.order_line(q, p, tasks).join(facts.invoiced_per_line(inv, sin, tasks), lines.LINE_KEY, "left")
        return j.join(heads, "sales_order_number")

    try:
        spark.conf.set(CO_PARTITION, "true")
        plain = sorted(map(tuple, build().collect()), key=str)
        spark.conf.set(CO_PARTITION, "false")
        got = build()
        dealt, rows = exchanges(got), sorted(map(tuple, got.collect()), key=str)
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert rows == plain and len(rows) == 9
    by_order = [x for x in dealt if "hashpartitioning(sales_order_number" in x]
    # both sides of the lines, the invoice lines and the headers
    assert len(by_order) == 4 and not any("sales_order_line_number" in x for x in by_order)


def test_counted_positions_are_not_dealt_by_their_session(spark):
    """Sessions that repeat, are missing or have no number give the rows of a plain join."""
    q = "decimal(18,4)"
    cl = spark.createDataFrame([(s, n, money(1), money(1)) for n, s in enumerate(["S", "S", "T", "U", None])],
                               f"count_session_number string, count_line_number int, system_qty {q}, counted_qty {q}"
                               ).select("*", *[F.lit("x").alias(c) for c in ("item_code", "site_code", "location_code", "lot_code")])
    se = spark.createDataFrame([("S", D(2024, 1, 1)), ("T", D(2024, 1, 2)), ("T", D(2024, 1, 3)), (None, D(2024, 1, 4))],
                               "count_session_number string, count_date date").select(
        "*", *[F.lit("x").alias(c) for c in ("count_type", "session_status", "counted_by")])
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = facts.fct_inventory_count_line(cl, se)
        dealt, rows = exchanges(got), sorted((r.count_session_number, r.count_line_number, r.count_date.day) for r in got.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert not any("count_session_number" in x for x in dealt)
    assert rows == [("S", 0, 1), ("S", 1, 1), ("T", 2, 2), ("T", 2, 3)]


def test_delivery_mart_folds_the_lines_once(spark):
    from procmetrics.plans.catalog import load

    plan = explained(load()[0]["mart_i2d"](spark, SMALL)).partition("== Physical Plan ==")[2]
    assert "lineitem.parquet" not in plan

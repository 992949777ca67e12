"""Registered queries against their SQL on the smallest tables.

A part of them by default; PROCMETRICS_ALL=1 runs every one.
"""

import os

import pytest
from oracle import compare
from small import SMALL

from procmetrics.plans.catalog import load

QUERIES, ORACLES = load()

DEFAULT = """
stage_clean stage_text_casts menu_decode padded_join typed_empty filter_predicates split_lines
left_composite prefix_join semi_window anti_not_exists cross_one_row agg_filter pivot_charges
arg_min_max bool_listagg median_by median_global rank_flag_split lag_gap_split string_funcs
date_funcs math_casts macro_keys customer_xref customer_best_match employee_xref repair_refs
return_line fx_lookup milestones_split shipment_order three_way_match dim_customer dim_date_fiscal
dim_item fct_shipment fct_shipment_event fct_sales_order_line fct_invoice_line fct_count_line scd2
scd2_composite mtr_on_time mtr_cost_per_order mtr_return_rate ask_period ask_not_additive mart_i2d
dq_suite dim_relationships parity lossless profile_dso profile_links project_merge project_replace
file_drop reconcile_keys export stream_upsert stream_milestones stg_erp_sreturn stg_erp_facility
stg_crm_deal stg_payroll_employee stg_planning_item_location stg_freight_shipment
registry_blocked_logic registry_unmapped registry_crowded customer_xref_seed prefix_join
""".split()


@pytest.mark.parametrize("name", list(QUERIES) if os.environ.get("PROCMETRICS_ALL") else DEFAULT)
def test_matches_sql(spark, con, name):
    diff, rows, note = compare(spark, con, QUERIES[name], ORACLES[name], SMALL)
    assert diff is None, diff
    assert not note, note


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    import __spark_entry__ as e

    rows = e.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"site_site_name", "numerator", "denominator", "value"}
    # optional parts of the library may register queries that SQL cannot state
    assert set(QUERIES) <= set(e.oracle_sql()) <= set(e.queries())

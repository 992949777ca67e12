"""Atomic facts at their stated grain, with conformed keys and UNKNOWN for the unresolved."""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import MONEY, date_key, fk
from ..functions.joins import dealt, measured_join, stored
from ..policy import DEFAULT, Policy
from .events import milestones
from .fx import with_fx
from .lines import LINE_KEY, with_charges
from .match import with_order


def pick(df: DataFrame, columns: dict, need: Collection[str] | None) -> DataFrame:
    """Project to the named columns, or to those of them that are needed."""
    return df.select(*[c.alias(n) for n, c in columns.items() if need is None or n in need])


def wants(need: Collection[str] | None, *names: str) -> bool:
    """Whether a side is worth joining: some column it feeds is needed.

    The sides are unique on the join key, so leaving one out changes no row.
    The optimizer cannot know that and would keep every join.
    """
    return need is None or not set(names).isdisjoint(need)


def _usd(col: str):
    # both factors narrowed first: a summed amount times a rate would pass 38 digits
    return (F.col(col).cast(MONEY) * F.col("fx_rate").cast("decimal(18,6)")).cast(MONEY)


_CHARGES = ("charge_total_usd", "cost_variance_usd", "freight_usd", "fuel_surcharge_usd",
            "accessorial_usd", "detention_usd", "liftgate_usd", "residential_usd",
            "charge_line_count")
_MILES = ("picked_up_date", "transit_days", "event_count", "had_exception",
          "has_out_of_sequence_events", "out_of_sequence_event_count")
_LINKS = ("sales_order_number", "customer_code", "customer_requested_delivery_date",
          "customer_resolution_method", "has_order_reference", "order_date", "primary_rep_code")


def fct_shipment(
    shipments: DataFrame, charges: DataFrame, events: DataFrame, orders: DataFrame,
    customers: DataFrame, order_lines: DataFrame, policy: Policy = DEFAULT,
    need: Collection[str] | None = None,
) -> DataFrame:
    """Shipment header with charge mix, milestones and the resolved order and customer.

    The sides are folded and joined onto the shipments one after the other; the
    shipments themselves are read once. ``need`` names the wanted columns; a
    side none of them comes from is left out.
    """
    on_lines = policy.shipment_cost_basis == "charge_lines"
    j = shipments
    if wants(need, *_CHARGES, *(("shipment_cost_usd",) if on_lines else ())):
        j = with_charges(j, charges)
    if wants(need, *_MILES):
        j = j.join(milestones(events).select("shipment_id", *_MILES), "shipment_id", "left")
    requested_too = wants(need, "customer_requested_delivery_date",
                          "is_on_time_vs_customer_request", "days_late_vs_customer_request")
    if requested_too or wants(need, *_LINKS, "customer_key"):
        j = with_order(j, orders, customers, order_lines if requested_too else None)
    c = F.col
    delivered = c("delivered_date")
    promised = c("carrier_promised_delivery_date")
    requested = c("customer_requested_delivery_date")
    same = lambda *names: {n: c(n) for n in names}
    return pick(j, {
        **same("shipment_id"),
        "ship_date_key": date_key(c("ship_date")),
        "delivered_date_key": date_key(delivered),
        "customer_key": fk(c("customer_code"), policy.erp_key_prefix),
        **same("customer_code"),
        "site_code": fk(c("origin_site_code")),
        "carrier_scac": fk(c("carrier_scac")),
        **same("sales_order_number", "primary_rep_code", "reference_number", "service_level",
               "transport_mode", "shipment_status", "destination_city", "destination_state",
               "destination_postal_code", "destination_country", "customer_resolution_method",
               "has_order_reference", "ship_date", "picked_up_date",
               "carrier_promised_delivery_date", "customer_requested_delivery_date",
               "delivered_date", "order_date", "weight_lb", "piece_count", "transit_days",
               "event_count", "charge_total_usd", "header_cost_usd", "cost_variance_usd",
               "freight_usd", "fuel_surcharge_usd", "accessorial_usd", "detention_usd",
               "liftgate_usd", "residential_usd", "charge_line_count"),
        "shipment_cost_usd": c("charge_total_usd" if on_lines else "header_cost_usd"),
        "shipment_cost_basis": F.lit(policy.shipment_cost_basis),
        "is_delivered": delivered.isNotNull(),
        # null while undelivered: a comparison with null is null
        "is_on_time_vs_carrier_promise": delivered <= promised,
        "is_on_time_vs_customer_request": delivered <= requested,
        "otd_promise_basis": F.lit(policy.otd_promise_basis),
        "days_late_vs_carrier_promise": F.datediff(delivered, promised),
        "days_late_vs_customer_request": F.datediff(delivered, requested),
        **same("had_exception", "has_out_of_sequence_events", "out_of_sequence_event_count"),
    }, need)


def with_shipped_by_request(fact: DataFrame) -> DataFrame:
    """Null-aware flag for the shipped-by-requested-date metric on order lines."""
    return fact.withColumn(
        "is_shipped_by_request_date",
        F.col("shipment_date") <= F.col("requested_delivery_date"))


def invoiced_per_line(invoice_lines: DataFrame, invoice_headers: DataFrame, tasks: int | None = None) -> DataFrame:
    """Invoiced amount per order line; credit memos are not invoices."""
    sales = invoice_headers.where(F.col("invoice_type_code") == "SIN").select("invoice_number")
    rows = invoice_lines.where("sales_order_number is not null").join(sales, "invoice_number", "left_semi")
    return (
        dealt(rows, LINE_KEY[0], tasks).groupBy(*LINE_KEY)
        .agg(F.sum("line_net_amount").alias("invoiced_amount"),
             F.count(F.lit(1)).alias("invoice_line_count"))
    )


def returned_per_line(returns: DataFrame, tasks: int | None = None) -> DataFrame:
    return dealt(returns.where("sales_order_number is not null"), LINE_KEY[0], tasks).groupBy(*LINE_KEY).agg(
        F.sum("returned_qty").alias("returned_qty"),
        F.sum("line_net_amount").alias("returned_amount"),
        F.min("return_date").alias("first_return_date"),
        F.count(F.lit(1)).alias("return_line_count"),
    )


def fct_sales_order_line(
    order_lines: DataFrame, order_headers: DataFrame, invoice_lines: DataFrame,
    invoice_headers: DataFrame, returns: DataFrame, fx: DataFrame | Callable[[], DataFrame], policy: Policy = DEFAULT,
    need: Collection[str] | None = None, tasks: int | None = None,
) -> DataFrame:
    """Order lines with what was invoiced and returned folded in, both currencies.

    ``need`` as for shipments; ``fx``, a stored table, may be given by a function, which is called if rates are needed.
    ``tasks``: to how many ``order_lines`` are dealt by their order; what is folded follows them.
    """
    head = order_headers.select(
        "sales_order_number", "sales_site_code", "ordering_customer_code",
        "invoicing_customer_code", "order_date", "shipment_date", "currency_code",
        "order_status", "primary_rep_code")
    j, folded = order_lines, []
    if wants(need, "invoiced_amount_usd", "is_invoiced"):
        j = j.join(invoiced_per_line(invoice_lines, invoice_headers, tasks), LINE_KEY, "left")
        folded += ["invoiced_amount", "invoice_line_count"]
    if wants(need, "returned_amount_usd", "is_returned", "returned_qty", "first_return_date"):
        j = j.join(returned_per_line(returns, tasks), LINE_KEY, "left")
        folded += ["returned_qty", "returned_amount", "return_line_count"]
    j = j.join(head, "sales_order_number")
    if wants(need, "line_net_amount_usd", "discount_amount_usd", "invoiced_amount_usd",
             "returned_amount_usd", "fx_rate", "fx_rate_is_fallback"):
        j = with_fx(j, fx() if callable(fx) else fx, "currency_code", "order_date")
    if folded:
        j = j.withColumns({f: F.coalesce(F.col(f), F.lit(0)) for f in folded})
    c = F.col
    return pick(j, {
        **{k: c(k) for k in LINE_KEY},
        "order_date_key": date_key(c("order_date")),
        "requested_delivery_date_key": date_key(c("requested_delivery_date")),
        "customer_key": fk(c("ordering_customer_code"), policy.erp_key_prefix),
        "customer_code": c("ordering_customer_code"),
        "invoicing_customer_code": c("invoicing_customer_code"),
        "item_code": fk(c("item_code")), "site_code": fk(c("shipping_site_code")),
        **{k: c(k) for k in ("sales_site_code", "primary_rep_code", "order_status",
                             "unit_of_measure", "item_description_at_order")},
        "document_currency_code": c("currency_code"),
        **{k: c(k) for k in ("order_date", "requested_delivery_date", "shipment_date",
                             "ordered_qty", "shipped_qty")},
        "open_qty": c("ordered_qty") - c("shipped_qty"), "returned_qty": c("returned_qty"),
        "gross_unit_price_doc": c("gross_unit_price"), "net_unit_price_doc": c("net_unit_price"),
        "discount_amount_doc": c("discount_amount"), "line_net_amount_doc": c("line_net_amount"),
        "line_net_amount_usd": _usd("line_net_amount"),
        "discount_amount_usd": _usd("discount_amount"),
        "invoiced_amount_usd": _usd("invoiced_amount"),
        "returned_amount_usd": _usd("returned_amount"),
        "fx_rate": c("fx_rate").cast("decimal(18,6)"),
        "fx_rate_is_fallback": c("fx_rate_is_fallback"),
        "is_fully_shipped": c("shipped_qty") >= c("ordered_qty"),
        "has_no_shipment_date": c("shipment_date").isNull(),
        "is_invoiced": c("invoice_line_count") > 0,
        "is_returned": c("return_line_count") > 0,
        "first_return_date": c("first_return_date"),
    }, need)


def fct_invoice_line(
    invoice_lines: DataFrame, invoice_headers: DataFrame, customers: DataFrame,
    fx: DataFrame | Callable[[], DataFrame],
    policy: Policy = DEFAULT, need: Collection[str] | None = None,
) -> DataFrame:
    """Invoice lines with settlement; days to pay stay null while unpaid."""
    head = invoice_headers.select(
        "invoice_number", "invoice_type_code", "invoice_date", "customer_code",
        "sales_site_code", "currency_code", "payment_date", "accounting_date")
    j = invoice_lines.join(head, "invoice_number")
    if wants(need, "payment_term_code"):
        terms = customers.select(F.col("customer_code").alias("_code"), "payment_term_code")
        j = j.join(terms, F.col("customer_code") == F.col("_code"), "left")
    if wants(need, "line_net_amount_usd", "fx_rate", "fx_rate_is_fallback"):
        j = with_fx(j, fx() if callable(fx) else fx, "currency_code", "invoice_date")
    c = F.col
    paid = c("payment_date")
    return pick(j, {
        "invoice_number": c("invoice_number"), "invoice_line_number": c("invoice_line_number"),
        "invoice_date_key": date_key(c("invoice_date")), "payment_date_key": date_key(paid),
        "customer_key": fk(c("customer_code"), policy.erp_key_prefix),
        "customer_code": c("customer_code"), "item_code": fk(c("item_code")),
        "site_code": fk(c("shipping_site_code")),
        **{k: c(k) for k in ("sales_site_code", "sales_order_number", "sales_order_line_number",
                             "invoice_type_code", "payment_term_code",
                             "item_description_at_invoice")},
        "document_currency_code": c("currency_code"),
        **{k: c(k) for k in ("invoice_date", "payment_date", "accounting_date", "invoiced_qty")},
        "net_unit_price_doc": c("net_unit_price"), "line_net_amount_doc": c("line_net_amount"),
        "line_net_amount_usd": _usd("line_net_amount"),
        "fx_rate": c("fx_rate").cast("decimal(18,6)"),
        "fx_rate_is_fallback": c("fx_rate_is_fallback"),
        "is_settled": paid.isNotNull(), "is_unsettled": paid.isNull(),
        "days_to_pay_settled_only": F.datediff(paid, c("invoice_date")),
    }, need)


def fct_supplier_invoice_line(matched: DataFrame) -> DataFrame:
    return matched.select(
        "supplier_invoice_number", "supplier_invoice_line_number",
        date_key(F.col("invoice_date")).alias("invoice_date_key"),
        date_key(F.col("accounting_date")).alias("accounting_date_key"),
        fk(F.col("item_code")).alias("item_code"), fk(F.col("site_code")).alias("site_code"),
        "supplier_code", "purchase_order_number", "receipt_number", "currency_code",
        "invoice_status_code", "invoice_date", "accounting_date", "receipt_date",
        "last_receipt_date", "invoiced_qty", "received_qty", "total_received_qty", "ordered_qty",
        "invoiced_unit_price", "ordered_unit_price",
        F.col("line_net_amount").cast(MONEY).alias("line_net_amount_usd"),
        "qty_variance", "price_variance",
        F.col("qty_variance_pct").cast(MONEY).alias("qty_variance_pct"),
        F.col("price_variance_pct").cast(MONEY).alias("price_variance_pct"),
        "receipt_count", "match_result", "is_three_way_matched",
        F.col("purchase_order_number").isNull().alias("is_maverick_spend"),
        (F.col("receipt_count") > 1).alias("is_multi_delivery"),
    )


def fct_inventory_count_line(
    count_lines: DataFrame, sessions: DataFrame, policy: Policy = DEFAULT
) -> DataFrame:
    """Counted positions; accuracy on the exact quantity or within the tolerance.

    Sessions are few beside the positions, but how few is not known before they are stored and measured.
    """
    head = stored(sessions.where("count_session_number is not null").select(
        F.col("count_session_number").alias("_session"), "count_date", "count_type", "session_status",
        "counted_by"), "sessions")
    system, counted = F.col("system_qty"), F.col("counted_qty")
    off = F.abs(counted - system)
    pct = F.when(system != 0, off.cast("double") / system.cast("double") * 100)
    tol = policy.inventory_accuracy_tolerance_pct
    exact = counted == system
    accurate = exact if tol == 0 else (
        F.when(system == 0, counted == 0).otherwise(pct <= tol))
    return measured_join(count_lines, head, [("count_session_number", "_session")], F.col("count_line_number")).select(
        "count_session_number", "count_line_number",
        date_key(F.col("count_date")).alias("count_date_key"),
        fk(F.col("item_code")).alias("item_code"), fk(F.col("site_code")).alias("site_code"),
        "location_code", "lot_code", "count_type", "session_status", "counted_by", "count_date",
        "system_qty", "counted_qty", (counted - system).alias("variance_qty"),
        off.alias("absolute_variance_qty"), pct.cast(MONEY).alias("variance_pct"),
        accurate.alias("is_accurate_position"), (counted > system).alias("is_overage"),
        (counted < system).alias("is_shortage"),
    )


# Further facts, at their stated grain and with the same key conventions.


def fct_purchase_order_line(po_lines: DataFrame, po_headers: DataFrame) -> DataFrame:
    head = po_headers.select("purchase_order_number", "supplier_code", "order_date",
                             "order_status", "currency_code")
    return po_lines.join(head, "purchase_order_number").select(
        "purchase_order_number", "purchase_order_line_number",
        date_key(F.col("order_date")).alias("order_date_key"),
        date_key(F.col("expected_receipt_date")).alias("expected_receipt_date_key"),
        fk(F.col("item_code")).alias("item_code"),
        fk(F.col("purchase_site_code")).alias("site_code"), "supplier_code", "order_status",
        F.col("currency_code").alias("document_currency_code"), "order_date", "ordered_qty",
        "received_qty", (F.col("ordered_qty") - F.col("received_qty")).alias("open_qty"),
        F.col("net_unit_price").alias("net_unit_price_doc"),
        (F.col("ordered_qty") * F.col("net_unit_price")).cast(MONEY).alias("line_net_amount_doc"),
        (F.col("received_qty") >= F.col("ordered_qty")).alias("is_fully_received"),
    )


def fct_inventory_movement(movements: DataFrame) -> DataFrame:
    return movements.select(
        "stock_movement_id", date_key(F.col("movement_date")).alias("movement_date_key"),
        fk(F.col("item_code")).alias("item_code"), fk(F.col("site_code")).alias("site_code"),
        "movement_type", "document_number", "document_type", "lot_code", "movement_date",
        "movement_qty", (F.col("movement_qty") < 0).alias("is_issue"),
    )


def fct_inventory_balance(stock: DataFrame) -> DataFrame:
    return stock.select(
        fk(F.col("site_code")).alias("site_code"), fk(F.col("item_code")).alias("item_code"),
        "lot_code", "location_code", "stock_status", "on_hand_qty")


def fct_gl_entry_line(gl_lines: DataFrame, gl_headers: DataFrame) -> DataFrame:
    head = gl_headers.select("journal_entry_number", "journal_code", "currency_code",
                             F.col("accounting_date").alias("_date"))
    return gl_lines.drop("accounting_date").join(head, "journal_entry_number").select(
        "journal_entry_number", "journal_line_number",
        date_key(F.col("_date")).alias("accounting_date_key"),
        fk(F.col("site_code")).alias("site_code"), "gl_account_code", "journal_code",
        F.col("currency_code").alias("document_currency_code"),
        F.col("_date").alias("accounting_date"),
        "amount_document_currency", "amount_company_currency",
    )


def fct_forecast(forecast: DataFrame, accuracy: DataFrame) -> DataFrame:
    key = ["item_code", "location_code", "period_start_date"]
    actual = accuracy.select(*key, "actual_qty", "abs_pct_error")
    return forecast.join(actual, key, "left").select(
        fk(F.col("item_code")).alias("item_code"), fk(F.col("location_code")).alias("site_code"),
        date_key(F.col("period_start_date")).alias("period_start_date_key"),
        "period_start_date", "forecast_qty", "actual_qty", "abs_pct_error")


def fct_deal_stage_change(history: DataFrame, deals: DataFrame) -> DataFrame:
    deal = deals.select("deal_id", "company_id", "owner_id", "deal_amount", "is_archived")
    return history.join(deal, "deal_id", "left").select(
        "deal_id", "deal_stage_id", date_key(F.col("changed_at_date")).alias("changed_at_date_key"),
        "changed_at_date", "changed_by_owner_id", "company_id", "owner_id", "deal_amount",
        "is_archived")


def fct_payroll_earning(earnings: DataFrame, checks: DataFrame, crosswalk: DataFrame) -> DataFrame:
    head = checks.select("check_id", "check_date", "payroll_location_code", "department_code")
    site = crosswalk.select(F.col("paycom_location_code").alias("payroll_location_code"),
                            F.col("x3_site_code").alias("_site"))
    return earnings.join(head, "check_id").join(site, "payroll_location_code", "left").select(
        "check_id", "earning_code", date_key(F.col("check_date")).alias("check_date_key"),
        fk(F.col("_site")).alias("site_code"), "employee_code", "department_code",
        "labor_allocation_code", "check_date", "hours", "earning_amount")

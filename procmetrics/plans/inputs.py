"""The business tables the jobs expect, derived from the TPC-H-like test tables.

The test tables are clean, so each view plants the defects a job is there for
(padding, sentinels, lost prefixes, second receipts …) by rules on the keys.
Every view covers its whole source table, but for the gaps planted as misses in
``bpartner``, ``deal_orders``, ``legal_company`` and ``crosswalk``. ``views.py`` states the same views in
SQL for the oracle.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import MONEY
from ..functions.joins import stored, tasks_for
from ..functions.keys import name_alnum
from ..session import table

AS_OF = dt.date(2000, 1, 1)
SENTINEL = dt.date(1753, 1, 1)


def txt(c: Column) -> Column:
    return c.cast("string")


def tag(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix), txt(c))


def when_mod(c: Column, n: int, then, otherwise) -> Column:
    return F.when(c % n == 0, then).otherwise(otherwise)


def null_mod(c: Column, n: int, value: Column) -> Column:
    return F.when(c % n != 0, value)


def exact_sum(c: Column) -> Column:
    """Sum of a money double as decimal(18,4).

    Added up as whole ten-thousandths: exact in any order, and a long sum costs
    far less than a wide decimal one.
    """
    units = F.sum(F.round(c * 10000).cast("bigint"))
    return (units.cast("decimal(18,0)") * F.lit(Decimal("0.0001"))).cast(MONEY)


def times(c: Column, factor: str) -> Column:
    return (c * F.lit(Decimal(factor))).cast(MONEY)


def again(c: Column, mark: str) -> Column:
    """The code of a second record of the same customer; no customer's own code looks like it."""
    return F.concat(txt(c), F.lit("-" + mark))


def pad8(c: Column) -> Column:
    """At least eight digits, never fewer than there are."""
    return F.when(F.length(txt(c)) >= 8, txt(c)).otherwise(F.lpad(txt(c), 8, "0"))


class Inputs:
    """``store_lines`` writes the derived order headers and lines to the shared folder once.

    Jobs that read them many times then scan a table, as they would in a
    deployment, in place of folding the line items again for each use. ``store_folds`` writes the folded lines alone, for
    jobs that need them often but the headers on them never.
    """

    def __init__(self, spark: SparkSession, root: str, store_lines: bool = False, store_folds: bool = False):
        self.spark, self.root, self.store_lines, self.store_folds = spark, root, store_lines, store_folds

    def raw(self, name: str) -> DataFrame:
        return table(self.spark, self.root, name)

    # ------------------------------------------------------ sales

    LINE = ("order_id", "line_no", "qty", "amt", "ship", "part", "supp", "k", "order_no")

    @cached_property
    def line_tasks(self) -> int:
        return tasks_for(self.raw("lineitem").count())

    @cached_property
    def line(self) -> DataFrame:
        if self.store_lines:
            return self.order_line.select(*self.LINE)
        return stored(self._line, "line") if self.store_folds else self._line

    @property
    def _line(self) -> DataFrame:
        """Order lines: the test table repeats (order, line), so fold first.

        Lines are dealt by order, to tasks by their number, so that folding them and meeting the order take one shuffle.
        """
        df = self.raw("lineitem").repartition(self.line_tasks, "l_orderkey").groupBy("l_orderkey", "l_linenumber").agg(
            exact_sum(F.col("l_quantity")).alias("qty"),
            exact_sum(F.col("l_extendedprice")).alias("amt"),
            F.max("l_shipdate").cast("date").alias("ship"),
            F.min("l_partkey").alias("part"),
            F.min("l_suppkey").alias("supp"),
        )
        return df.select(
            F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
            "qty", "amt", "ship", "part", "supp",
            (F.col("l_orderkey") + F.col("l_linenumber")).alias("k"),
            tag("SO", F.col("l_orderkey")).alias("order_no"),
        )

    @cached_property
    def order(self) -> DataFrame:
        """Order headers with the customer's nation as site and currency."""
        o = self.raw("orders").join(
            self.raw("customer").select("c_custkey", "c_name", "c_nationkey"),
            F.col("o_custkey") == F.col("c_custkey"))
        n6 = F.col("c_nationkey") % 6
        heads = o.select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("custkey"),
            F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"),
            tag("SO", F.col("o_orderkey")).alias("order_no"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            tag("N", F.col("c_nationkey")).alias("site"),
            F.when(n6 == 0, "USD").otherwise(tag("C", n6)).alias("cur"),
            F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"),
            F.col("o_totalprice").cast(MONEY).alias("total"),
        )
        return stored(heads, "order") if self.store_lines else heads

    @cached_property
    def order_line(self) -> DataFrame:
        head = self.order.select("order_id", "custkey", "nation", "order_date", "site", "cur")
        df = self._line.join(head, "order_id")
        return stored(df, "order_line") if self.store_lines else df

    @cached_property
    def sorder(self) -> DataFrame:
        o = F.col("order_id")
        return self.order.select(
            F.col("order_no").alias("sales_order_number"), F.col("site").alias("sales_site_code"),
            txt(F.col("custkey")).alias("ordering_customer_code"),
            txt(F.col("custkey")).alias("invoicing_customer_code"), "order_date",
            null_mod(o, 31, F.date_add("order_date", 10)).alias("shipment_date"),
            F.col("cur").alias("currency_code"), F.col("status").alias("order_status"),
            txt(F.col("custkey") % 10).alias("primary_rep_code"),
        )

    @cached_property
    def sorderq(self) -> DataFrame:
        k = F.col("k")
        return self.order_line.select(
            F.col("order_no").alias("sales_order_number"),
            F.col("line_no").cast("bigint").alias("sales_order_line_number"),
            tag("P", F.col("part")).alias("item_code"),
            null_mod(k, 53, F.col("site")).alias("shipping_site_code"),
            F.col("qty").alias("ordered_qty"),
            F.when(k % 9 == 0, F.col("qty") - 1).otherwise(F.col("qty")).cast(MONEY)
            .alias("shipped_qty"),
            null_mod(k, 43, F.date_add("order_date", F.lit(30) + F.col("line_no")))
            .alias("requested_delivery_date"),
            F.lit("EA").alias("unit_of_measure"),
        )

    @cached_property
    def sorderp(self) -> DataFrame:
        k = F.col("k")
        return self.line.select(
            F.col("order_no").alias("sales_order_number"),
            F.col("line_no").cast("bigint").alias("sales_order_line_number"),
            F.when(k % 37 != 0, when_mod(k, 41, F.lit("P0"), tag("P", F.col("part"))))
            .alias("item_code"),
            tag("part ", F.col("part")).alias("item_description_at_order"),
            times(F.col("amt"), "0.02").alias("gross_unit_price"),
            times(F.col("amt"), "0.01").alias("net_unit_price"),
            times(F.col("amt"), "0.05").alias("discount_amount"),
            F.col("amt").alias("line_net_amount"),
            tag("T", k % 3).alias("tax_code"),
        )

    @cached_property
    def sinvoicev(self) -> DataFrame:
        o = F.col("order_id")
        day = F.date_add("order_date", 5)
        return self.order.select(
            tag("SI", o).alias("invoice_number"),
            when_mod(o, 41, F.lit("SCN"), F.lit("SIN")).alias("invoice_type_code"),
            day.alias("invoice_date"), txt(F.col("custkey")).alias("customer_code"),
            F.col("site").alias("sales_site_code"), F.col("cur").alias("currency_code"),
            null_mod(o, 5, F.date_add(day, (F.lit(20) + o % 70).cast("int")))
            .alias("payment_date"),
            day.alias("accounting_date"),
        )

    @cached_property
    def sinvoiced(self) -> DataFrame:
        k = F.col("k")
        return self.order_line.select(
            tag("SI", F.col("order_id")).alias("invoice_number"),
            F.col("line_no").cast("bigint").alias("invoice_line_number"),
            tag("P", F.col("part")).alias("item_code"),
            tag("part ", F.col("part")).alias("item_description_at_invoice"),
            F.col("qty").alias("invoiced_qty"),
            times(F.col("amt"), "0.01").alias("net_unit_price"),
            when_mod(k, 14, times(F.col("amt"), "0.5"), F.col("amt")).alias("line_net_amount"),
            null_mod(k, 47, F.col("order_no")).alias("sales_order_number"),
            F.col("line_no").cast("bigint").alias("sales_order_line_number"),
            F.col("site").alias("shipping_site_code"),
        )

    @cached_property
    def sreturnd(self) -> DataFrame:
        k = F.col("k")
        return self.order_line.where(k % 12 == 0).select(
            tag("RT", F.col("order_id")).alias("return_number"),
            F.col("line_no").cast("bigint").alias("return_line_number"),
            tag("P", F.col("part")).alias("item_code"),
            F.lit(1).cast(MONEY).alias("returned_qty"),
            times(F.col("amt"), "0.01").alias("net_unit_price"),
            times(F.col("amt"), "0.1").alias("line_net_amount"),
            F.when(k % 24 == 0, F.lit(None)).when(k % 36 == 0, F.lower("order_no"))
            .when(k % 60 == 0, F.concat(F.lit("X"), "order_no"))
            .otherwise(F.col("order_no")).alias("sales_order_number"),
            F.col("line_no").cast("bigint").alias("sales_order_line_number"),
            null_mod(k, 48, F.col("site")).alias("site_code"),
            (k % 4).alias("return_reason_code"),
            tag("reason ", k % 4).alias("return_reason"),
        )

    @cached_property
    def sreturn(self) -> DataFrame:
        o = F.col("order_id")
        return self.order.select(
            tag("RT", o).alias("return_number"), F.col("site").alias("site_code"),
            txt(F.col("custkey")).alias("customer_code"),
            F.date_add("order_date", 60).alias("return_date"),
            tag("SI", o).alias("invoice_number"),
            when_mod(o, 7, F.lit("Open"), F.lit("Closed")).alias("return_status"),
        )

    # ------------------------------------------------------ ledger

    @cached_property
    def gl_header(self) -> DataFrame:
        o = F.col("order_id")
        known = (o % 97 != 0) & (F.year("order_date") < 2001)
        return self.order.select(
            tag("GL", o).alias("journal_entry_number"), F.col("cur").alias("currency_code"),
            F.when(known, F.col("order_date")).alias("accounting_date"),
        )

    @cached_property
    def gl_line(self) -> DataFrame:
        n6 = F.col("nation") % 6
        doc = F.when((n6 == 5) | (F.col("k") % 53 == 0), F.lit(0)).otherwise(F.col("amt"))
        factor = F.when(n6 == 0, F.lit(Decimal("1.00"))).otherwise(
            F.lit(Decimal("0.70")) + F.lit(Decimal("0.05")) * n6)
        return self.order_line.select(
            tag("GL", F.col("order_id")).alias("journal_entry_number"),
            F.col("line_no").cast("bigint").alias("journal_line_number"),
            F.lit("41000").alias("gl_account_code"),
            doc.cast(MONEY).alias("amount_document_currency"),
            (doc.cast(MONEY) * factor.cast("decimal(4,2)")).cast(MONEY)
            .alias("amount_company_currency"),
            F.col("site").alias("site_code"),
        )

    # ------------------------------------------------------ freight

    @cached_property
    def charge(self) -> DataFrame:
        code = F.element_at(
            F.array(*[F.lit(c) for c in ("FREIGHT", "FUEL", "DETENTION", "LIFTGATE",
                                         "RESIDENTIAL")]),
            (F.col("part") % 5 + 1).cast("int"))
        return self.line.select(
            txt(F.col("order_id")).alias("shipment_id"), code.alias("charge_code"),
            times(F.col("amt"), "0.01").alias("charge_amount_usd"),
            F.lit("USD").alias("currency_code"))

    @cached_property
    def shipment(self) -> DataFrame:
        per = self.line.groupBy("order_id").agg(
            F.max("ship").alias("last_ship"), F.min("supp").alias("supp"),
            F.sum(times(F.col("amt"), "0.01")).cast(MONEY).alias("charges"),
            F.count(F.lit(1)).alias("pieces"))
        o = F.col("order_id")
        ref = F.when(o % 15 == 0, F.lit(None)).when(
            o % 13 == 0, tag("CUST-PO-", o)).otherwise(F.col("order_no"))
        delivered = null_mod(o, 31, F.col("last_ship"))
        return self.order.join(per, "order_id").select(
            txt(o).alias("shipment_id"), ref.alias("reference_number"),
            when_mod(o, 17, F.concat("name", F.lit(" X")), F.lower("name")).alias("customer_name"),
            null_mod(o, 19, tag("V", F.col("supp"))).alias("carrier_scac"),
            F.col("priority").alias("service_level"),
            when_mod(o, 2, F.lit("LTL"), F.lit("FTL")).alias("transport_mode"),
            F.col("site").alias("origin_site_code"),
            tag("city ", o % 50).alias("destination_city"),
            tag("ST", o % 20).alias("destination_state"),
            F.lpad(txt(o % 100000), 5, "0").alias("destination_postal_code"),
            F.lit("USA").alias("destination_country"),
            F.col("order_date").alias("ship_date"),
            F.date_add("order_date", 45).alias("carrier_promised_delivery_date"),
            delivered.alias("delivered_date"),
            F.when(delivered.isNull(), "EXCEPTION").otherwise("DELIVERED").alias("shipment_status"),
            times(F.col("charges"), "0.5").alias("weight_lb"), F.col("pieces").alias("piece_count"),
            times(F.col("charges"), "1.1").alias("header_cost_usd"),
        )

    @cached_property
    def event(self) -> DataFrame:
        e = F.col("event_id")
        kind = F.col("event_type")
        code = (
            F.when(kind == "signup", "PU").when(kind == "purchase", "DL")
            .when(kind == "error", "EX").when(kind == "view", "IT")
            .when(e % 3 == 0, "DP").when(e % 3 == 1, "AR").otherwise("OD"))
        day = F.col("ts").cast("date")
        return self.raw("events").select(
            txt(F.col("user_id")).alias("shipment_id"), e.alias("event_sequence"),
            code.alias("event_code"), kind.alias("event_description"),
            when_mod(e, 77, F.date_sub(day, 2), day).alias("event_at"),
            null_mod(e, 5, tag("L", e % 9)).alias("event_location"))

    # ------------------------------------------------------ purchasing

    @cached_property
    def _price(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("part"), F.col("p_retailprice").cast(MONEY).alias("price"))

    @cached_property
    def porderq(self) -> DataFrame:
        return self.line.join(self._price, "part").select(
            tag("PO", F.col("order_id")).alias("purchase_order_number"),
            F.col("line_no").cast("bigint").alias("purchase_order_line_number"),
            tag("P", F.col("part")).alias("item_code"),
            F.col("qty").alias("ordered_qty"), F.col("price").alias("net_unit_price"))

    @cached_property
    def _receipt_base(self) -> DataFrame:
        k = F.col("k")
        halves = F.when(k % 7 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        got = F.when(k % 101 == 0, F.lit(0).cast(MONEY)).when(
            k % 7 == 0, times(F.col("qty"), "0.5")).otherwise(F.col("qty"))
        return self.line.where(k % 10 != 0).withColumn("h", F.explode(halves)).withColumn(
            "got", got)

    @cached_property
    def preceiptd(self) -> DataFrame:
        h = F.col("h")
        return self._receipt_base.select(
            F.concat(F.lit("RC"), txt(F.col("order_id")), F.lit("-"), txt(F.col("line_no")),
                     F.lit("-"), txt(h)).alias("receipt_number"),
            tag("PO", F.col("order_id")).alias("purchase_order_number"),
            F.col("line_no").cast("bigint").alias("purchase_order_line_number"),
            F.col("got").alias("received_qty"),
            F.date_add("ship", h * 3).alias("receipt_date"))

    @cached_property
    def pinvoiced(self) -> DataFrame:
        k, h = F.col("k"), F.col("h")
        qty = when_mod(k, 11, F.col("got") + 1, F.col("got")).cast(MONEY)
        price = when_mod(k, 13, times(F.col("price"), "1.05"), F.col("price"))
        receipt = F.concat(F.lit("RC"), txt(F.col("order_id")), F.lit("-"),
                           txt(F.col("line_no")), F.lit("-"), txt(h))
        site = self.order.select("order_id", "site")
        return self._receipt_base.join(site, "order_id").join(self._price, "part").select(
            tag("PI", F.col("order_id")).alias("supplier_invoice_number"),
            (F.col("line_no") * 10 + h).cast("bigint").alias("supplier_invoice_line_number"),
            null_mod(k, 29, tag("PO", F.col("order_id"))).alias("purchase_order_number"),
            when_mod(k, 31, F.col("line_no") + 100, F.col("line_no")).cast("bigint")
            .alias("purchase_order_line_number"),
            null_mod(k, 23, receipt).alias("receipt_number"),
            tag("P", F.col("part")).alias("item_code"),
            F.col("site").alias("site_code"), qty.alias("invoiced_qty"),
            price.alias("invoiced_unit_price"),
            (qty * price).cast(MONEY).alias("line_net_amount"))

    @cached_property
    def pinvoice(self) -> DataFrame:
        o = F.col("order_id")
        return self.order.select(
            tag("PI", o).alias("supplier_invoice_number"), tag("V", o % 10).alias("supplier_code"),
            F.date_add("order_date", 20).alias("invoice_date"),
            null_mod(o, 53, F.date_add("order_date", 25)).alias("accounting_date"),
            F.lit("USD").alias("currency_code"),
            F.lit(1).cast("bigint").alias("invoice_status_code"))

    # ------------------------------------------------------ stock

    @cached_property
    def _position(self) -> DataFrame:
        return self.line.repartition(self.line_tasks, "part", "supp").groupBy("part", "supp").agg(
            F.sum("qty").cast(MONEY).alias("qty"), F.max("ship").alias("ship"))

    @cached_property
    def _supplier_site(self) -> DataFrame:
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("supp"), tag("N", F.col("s_nationkey")).alias("site"))

    @cached_property
    def stocountd(self) -> DataFrame:
        p = F.col("part")
        system = when_mod(p, 23, F.lit(0).cast(MONEY), F.col("qty"))
        counted = F.when(p % 19 == 0, F.lit(0)).when(p % 17 == 0, system + 1).otherwise(system)
        return self._position.join(self._supplier_site, "supp").select(
            tag("CS", F.col("supp")).alias("count_session_number"),
            p.alias("count_line_number"), tag("P", p).alias("item_code"),
            F.col("site").alias("site_code"), tag("L", p % 7).alias("location_code"),
            tag("LOT", p % 3).alias("lot_code"), system.alias("system_qty"),
            counted.cast(MONEY).alias("counted_qty"))

    @cached_property
    def stocount(self) -> DataFrame:
        s = F.col("supp")
        # the last day of a supplier's positions is that of its lines
        return self.line.groupBy("supp").agg(F.max("ship").alias("day")).select(
            tag("CS", s).alias("count_session_number"), F.col("day").alias("count_date"),
            when_mod(s, 2, F.lit("Cycle"), F.lit("Annual")).alias("count_type"),
            F.lit("Closed").alias("session_status"), tag("user", s % 5).alias("counted_by"))

    @cached_property
    def item_location(self) -> DataFrame:
        """Planning rows per (part, supplier): several per item."""
        m = F.col("part") + F.col("supp")
        letter = lambda s, n: F.substring(F.lit(s), (n % 3 + 1).cast("int"), F.lit(1))
        return self._position.select(
            tag("P", F.col("part")).alias("item_code"),
            tag("V", F.col("supp")).alias("location_code"),
            letter("ABC", m).alias("abc_class"), letter("XYZ", m + F.col("part")).alias("xyz_class"),
            when_mod(m, 11, F.lit("HIGH"), F.lit("LOW")).alias("stockout_risk"),
            F.col("ship").alias("last_sync_date"), F.col("qty").alias("forecast_qty"))

    @cached_property
    def item(self) -> DataFrame:
        p = F.col("p_partkey")
        return self.raw("part").select(
            tag("P", p).alias("item_code"), F.col("p_name").alias("item_description"),
            F.lit(None).cast("string").alias("item_description_2"),
            F.col("p_type").alias("item_category_code"),
            F.col("p_brand").alias("statistical_group_1"),
            tag("S", F.col("p_size")).alias("statistical_group_2"),
            F.lit(None).cast("string").alias("statistical_group_3"),
            F.lit("EA").alias("stock_unit"),
            F.when(p % 29 == 0, F.lit(None)).when(p % 13 == 0, F.lit("Obsolete"))
            .otherwise(F.lit("Active")).alias("item_status"),
            F.col("p_retailprice").cast(MONEY).alias("base_sales_price"),
            times(F.col("p_retailprice").cast(MONEY), "0.6").alias("base_purchase_price"),
            F.col("p_size").cast(MONEY).alias("item_weight"),
            F.lpad(txt(p), 13, "0").alias("ean_code"),
            F.date_add(F.lit(dt.date(1994, 1, 1)), (p % 365).cast("int")).alias("created_date"),
            F.lit(dt.date(1995, 1, 1)).alias("updated_date"))

    # ------------------------------------------------------ parties

    @cached_property
    def company(self) -> DataFrame:
        """CRM companies: customers with altered names, some claimed twice."""
        c = F.col("c_custkey")
        name = (
            F.when((c % 50 == 7) | (c % 10 == 0), tag("Prospect ", c)).when(c % 5 == 0, F.col("c_name"))
            .when(c % 5 == 1, F.lower("c_name"))
            .when(c % 5 == 2, F.regexp_replace("c_name", "#", " - "))
            .when(c % 5 == 3, F.concat("c_name", F.lit(" LLC")))
            .otherwise(F.concat("c_name", F.lit(", Inc"))))
        base = self.raw("customer").withColumn("_name", name)
        bare = F.when((c % 5 == 3) & (c % 50 != 7), F.col("c_name")).otherwise(F.col("_name"))
        stem = F.lower(F.substring(name_alnum(bare), 1, 18))
        ids = F.when(c % 20 == 3, F.array(txt(c), again(c, "2"))).otherwise(F.array(txt(c)))
        return base.withColumn("_id", F.explode(ids)).select(
            F.col("_id").alias("company_id"), F.col("_name").alias("company_name"),
            F.concat(stem, F.lit(".com")).alias("domain"),
            F.col("c_mktsegment").alias("industry"), tag("N", F.col("c_nationkey")).alias("country"),
            (c % 1000).cast("double").alias("employee_count"),
            F.col("c_acctbal").alias("annual_revenue"),
            F.date_add(F.lit(dt.date(1994, 1, 1)), (c % 365).cast("int")).alias("created_date"),
            (c % 37 == 0).alias("is_archived"))

    @cached_property
    def bpcustomer(self) -> DataFrame:
        """ERP customers, some again under a Ltd name, some again under the same name."""
        c = F.col("c_custkey")
        copies = F.concat(
            F.array(F.struct(txt(c).alias("code"), F.col("c_name").alias("nm"))),
            F.when(c % 25 == 4, F.array(F.struct(
                again(c, "L").alias("code"), F.concat("c_name", F.lit(" Ltd")).alias("nm"))))
            .otherwise(F.array().cast("array<struct<code:string,nm:string>>")),
            F.when(c % 40 == 6, F.array(F.struct(
                again(c, "U").alias("code"), F.upper("c_name").alias("nm"))))
            .otherwise(F.array().cast("array<struct<code:string,nm:string>>")),
        )
        return self.raw("customer").withColumn("x", F.explode(copies)).select(
            F.col("x.code").alias("customer_code"), F.col("x.nm").alias("customer_name"),
            F.col("c_mktsegment").alias("customer_group_code"),
            tag("C", F.col("c_nationkey") % 6).alias("currency_code"),
            tag("NET", F.lit(30) + c % 3 * 15).alias("payment_term_code"),
            F.col("c_acctbal").cast(MONEY).alias("credit_limit_amount"),
            tag("A", c % 4).alias("accounting_code"),
            txt(c % 12).alias("primary_rep_code"),
            null_mod(c, 2, txt(c % 7)).alias("secondary_rep_code"),
            F.date_add(F.lit(dt.date(1993, 1, 1)), (c % 365).cast("int")).alias("created_date"))

    @cached_property
    def bpartner(self) -> DataFrame:
        c = F.col("c_custkey")
        return self.raw("customer").where(c % 9 != 0).select(
            txt(c).alias("partner_code"), tag("N", F.col("c_nationkey")).alias("country_code"))

    @cached_property
    def represent(self) -> DataFrame:
        s = F.col("s_suppkey")
        return self.raw("supplier").select(
            txt(s).alias("rep_code"), tag("Worker ", F.floor(s / 3)).alias("rep_name"),
            tag("N", F.col("s_nationkey")).alias("site_code"),
            (s % 3).alias("rep_type_code"))

    @cached_property
    def roster(self) -> DataFrame:
        """Payroll rows from customers: some people twice, some names shared."""
        c = F.col("c_custkey")
        codes = F.when(c % 12 == 3, F.array(txt(c), again(c, "2"))).otherwise(F.array(txt(c)))
        twice = F.col("_code") != txt(c)
        return self.raw("customer").withColumn("_code", F.explode(codes)).select(
            tag("E", F.col("_code")).alias("employee_code"),
            F.lit("Worker").alias("legal_last_name"),
            txt(F.floor(c / 3)).alias("legal_first_name"),
            F.when(c % 17 != 0, F.concat(F.when(twice, "USER").otherwise("user"), txt(c),
                                         F.lit("@example.com"))).alias("work_email"),
            F.when(c % 24 != 3, F.date_add(
                F.lit(dt.date(1990, 1, 1)),
                ((c % 1000) + F.when(twice, 5).otherwise(0)).cast("int"))).alias("hire_date"))

    @cached_property
    def owner(self) -> DataFrame:
        c = F.col("c_custkey")
        return self.raw("customer").select(
            tag("O", c).alias("owner_id"),
            F.concat(F.lit(" User"), txt(c), F.lit("@Example.com ")).alias("email"),
            tag("first", c).alias("first_name"), tag("last", c).alias("last_name"))

    @cached_property
    def deal(self) -> DataFrame:
        """CRM deals with their order reference typed in seven ways."""
        o = F.col("o_orderkey")
        full = F.concat(F.lit("SOUS"), pad8(o))
        bare = F.concat(F.lit("US"), pad8(o))
        nxt = F.concat(F.lit("SOUS"), pad8(o + 1))
        ref = (
            F.when(o % 7 == 0, F.lower(full)).when(o % 7 == 1, bare)
            .when(o % 7 == 2, F.concat(full, F.lit(" / "), nxt))
            .when(o % 7 == 3, F.concat(F.lower(bare), F.lit(" / "), nxt))
            .when(o % 7 == 4, F.concat(full, F.lit(" / ")))
            .when(o % 7 == 5, F.concat(F.lit("PO"), txt(o))).otherwise(full))
        return self.raw("orders").select(
            tag("D", o).alias("deal_id"), null_mod(o, 10, ref).alias("erp_order_number_raw"),
            (o % 3 == 0).alias("is_closed_won"), (o % 37 == 0).alias("is_archived"),
            F.col("o_totalprice").alias("deal_amount"),
            F.col("o_orderdate").cast("date").alias("close_date"))

    @cached_property
    def deal_orders(self) -> DataFrame:
        o = F.col("o_orderkey")
        return self.raw("orders").where(o % 11 != 0).select(
            F.concat(F.lit("SOUS"), pad8(o)).alias("sales_order_number"))

    @cached_property
    def carrier(self) -> DataFrame:
        s = F.col("s_suppkey")
        return self.raw("supplier").select(
            tag("V", s).alias("carrier_scac"), F.col("s_name").alias("carrier_name"),
            when_mod(s, 2, F.lit("LTL"), F.lit("FTL")).alias("transport_mode"))

    @cached_property
    def facility(self) -> DataFrame:
        n = F.col("n_nationkey")
        return self.raw("nation").select(
            tag("N", n).alias("site_code"), tag("S", n).alias("site_short_name"),
            F.col("n_name").alias("site_name"), tag("R", F.col("n_regionkey")).alias("company_code"),
            tag("K", F.col("n_regionkey")).alias("country_code"),
            tag("city ", n).alias("city"), F.lit(None).cast("string").alias("state_province"),
            (n % 2 == 0).alias("is_stock_site"), (n % 3 == 0).alias("is_sales_site"),
            (n % 5 == 0).alias("is_purchase_site"))

    @cached_property
    def legal_company(self) -> DataFrame:
        r = F.col("r_regionkey")
        return self.raw("region").where(r != 4).select(
            tag("R", r).alias("company_code"), F.col("r_name").alias("company_name"),
            tag("LEG", r).alias("legislation_code"))

    @cached_property
    def crosswalk(self) -> DataFrame:
        n = F.col("n_nationkey")
        return self.raw("nation").where(n % 2 == 0).select(
            tag("N", n).alias("x3_site_code"), tag("PAY", n).alias("paycom_location_code"),
            tag("NET", n).alias("netstock_location_code"))

"""The star schema assembled from the test-table inputs."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.joins import stored
from ..operators import dims, events, facts, fx, lines, match
from ..policy import DEFAULT, Policy
from .inputs import AS_OF, Inputs
from .marts import shipped_metrics
from .metrics import Catalog


class Models:
    """Lazy models over ``Inputs``; each is built once per instance."""

    def __init__(self, inputs: Inputs, policy: Policy = DEFAULT):
        self.i, self.policy = inputs, policy

    @cached_property
    def fx(self) -> DataFrame:
        return fx.fx_rates(self.i.gl_line, self.i.gl_header, self.policy)

    @cached_property
    def stored_fx(self) -> DataFrame:
        """The rates as a table, so that the ledger is read once for all facts that convert amounts."""
        return stored(self.fx, "fx")

    @cached_property
    def int_line(self) -> DataFrame:
        return lines.order_line(self.i.sorderq, self.i.sorderp, self.i.line_tasks)

    @cached_property
    def returns(self) -> DataFrame:
        return match.return_line(self.i.sreturnd, self.i.sreturn, self.int_line)

    @cached_property
    def milestones(self) -> DataFrame:
        return events.milestones(self.i.event)

    @cached_property
    def charges(self) -> DataFrame:
        return lines.shipment_charge(self.i.charge, self.i.shipment)

    @cached_property
    def links(self) -> DataFrame:
        return match.shipment_order(self.i.shipment, self.i.sorder, self.i.bpcustomer,
                                    self.i.sorderq)

    @cached_property
    def matched(self) -> DataFrame:
        return match.three_way_match(self.i.pinvoiced, self.i.pinvoice, self.i.porderq,
                                     self.i.preceiptd, self.policy, self.i.line_tasks)

    @cached_property
    def dim_date(self) -> DataFrame:
        day = self.i.raw("orders").select(F.col("o_orderdate").cast("date").alias("d"))
        return dims.calendar_over(day, "d", AS_OF, self.policy)

    @cached_property
    def dim_customer(self) -> DataFrame:
        # the dimension reads the matches twice
        best = stored(match.best_customer_match(self.i.company, self.i.bpcustomer), "matches")
        return dims.dim_customer(self.i.bpcustomer, self.i.bpartner, self.i.company, best,
                                 self.i.represent, self.policy)

    @cached_property
    def dim_site(self) -> DataFrame:
        return dims.dim_site(self.i.facility, self.i.legal_company, self.i.crosswalk, self.policy)

    @cached_property
    def dim_item(self) -> DataFrame:
        return dims.dim_item(self.i.item, self.i.item_location, self.policy)

    @cached_property
    def dim_carrier(self) -> DataFrame:
        return dims.dim_carrier(self.i.carrier, self.i.shipment, self.policy)

    @property
    def fct_shipment(self) -> DataFrame:
        return self.model("fct_shipment")

    @property
    def fct_shipment_event(self) -> DataFrame:
        return self.model("fct_shipment_event")

    @property
    def fct_sales_order_line(self) -> DataFrame:
        return self.model("fct_sales_order_line")

    @property
    def fct_invoice_line(self) -> DataFrame:
        return self.model("fct_invoice_line")

    @property
    def fct_supplier_invoice_line(self) -> DataFrame:
        return self.model("fct_supplier_invoice_line")

    @property
    def fct_inventory_count_line(self) -> DataFrame:
        return self.model("fct_inventory_count_line")

    def model(self, name: str, need: set[str] | None = None) -> DataFrame:
        """A dimension or fact by name; a fact may be asked for only some columns."""
        i, pol = self.i, self.policy
        if name == "fct_shipment":
            return facts.fct_shipment(i.shipment, i.charge, i.event, i.sorder, i.bpcustomer,
                                      i.sorderq, pol, need)
        if name == "fct_shipment_event":
            context = {"shipment_id", "customer_key", "customer_code", "site_code",
                       "carrier_scac", "sales_order_number", "service_level", "transport_mode"}
            return events.shipment_event(i.event, self.model("fct_shipment", context))
        if name == "fct_sales_order_line":
            return facts.fct_sales_order_line(
                self.int_line, i.sorder, i.sinvoiced, i.sinvoicev, self.returns,
                lambda: self.stored_fx, pol, need, i.line_tasks)
        if name == "fct_invoice_line":
            return facts.fct_invoice_line(i.sinvoiced, i.sinvoicev, i.bpcustomer,
                                          lambda: self.stored_fx, pol, need)
        if name == "fct_supplier_invoice_line":
            return facts.fct_supplier_invoice_line(self.matched)
        if name == "fct_inventory_count_line":
            return facts.fct_inventory_count_line(i.stocountd, i.stocount, pol)
        if name in ("dim_date", "dim_customer", "dim_site", "dim_item", "dim_carrier"):
            return getattr(self, name)
        raise KeyError(name)

    def catalog(self) -> Catalog:
        return Catalog(self.model, shipped_metrics())

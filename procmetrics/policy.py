"""Business policy knobs, passed to the jobs as one frozen value.

Every knob is a decision the business can reverse; jobs read them from here so
that reversing one is a parameter change. A knob is resolved in Python when the
plan is built, so Catalyst only ever sees the chosen column.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class Policy:
    # promise the on-time flag is labelled with: "carrier" or "customer"
    otd_promise_basis: str = "carrier"
    # "charge_lines" or "shipment_header"
    shipment_cost_basis: str = "charge_lines"
    reporting_currency: str = "USD"
    fx_rate_source: str = "derived_from_x3_gl"
    fiscal_year_start_month: int = 1
    # the ERP writes this date where there is none
    null_date: dt.date = dt.date(1753, 1, 1)
    match_qty_tolerance_pct: float = 0.0
    match_price_tolerance_pct: float = 2.0
    inventory_accuracy_tolerance_pct: float = 0.0
    return_rate_basis: str = "invoiced"
    # a receipt of quantity 0 has no variance percentage and so passes the
    # quantity test; True sends such a line to quantity_variance instead
    zero_receipt_is_variance: bool = False
    erp_key_prefix: str = "X3-"
    crm_key_prefix: str = "HS-"
    unknown_key: str = "UNKNOWN"
    unknown_label: str = "Unresolved"

    def __post_init__(self):
        _one_of("otd_promise_basis", self.otd_promise_basis, ("carrier", "customer"))
        _one_of("shipment_cost_basis", self.shipment_cost_basis,
                ("charge_lines", "shipment_header"))
        _one_of("return_rate_basis", self.return_rate_basis, ("invoiced", "ordered"))
        if not 1 <= self.fiscal_year_start_month <= 12:
            raise ValueError("fiscal_year_start_month must be 1..12")


def _one_of(name, value, allowed):
    if value not in allowed:
        raise ValueError(f"{name} must be one of {allowed}, not {value!r}")


DEFAULT = Policy()

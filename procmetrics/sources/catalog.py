"""How each source table is read: strategy, key, cursor, parent window.

The rows are deployment facts, one per table.
"""

from __future__ import annotations

from dataclasses import dataclass

LOOKBACK_DAYS = 90

REPLACE = ("full_refresh", "snapshot", "file_drop")
STRATEGIES = REPLACE + ("modified_date", "api_cursor", "header_window")


@dataclass(frozen=True)
class TableSpec:
    source: str
    name: str
    strategy: str
    primary_key: tuple[str, ...]
    cursor_column: str | None = None
    # (parent table, join column, parent date column)
    window_via: tuple[str, str, str] | None = None
    lookback_days: int = LOOKBACK_DAYS

    @property
    def disposition(self) -> str:
        return "replace" if self.strategy in REPLACE else "merge"

    @property
    def reconcile_keys(self) -> str:
        """Merged tables keep rows deleted upstream, so they need a key sweep."""
        return "never" if self.disposition == "replace" else "weekly"


# fixed values: the estate's tables, how they are read, their keys, cursors and parent windows
TABLES = (
    TableSpec("erp", "COMPANY", "full_refresh", ("CPY_0",)),
    TableSpec("erp", "FACILITY", "full_refresh", ("FCY_0",)),
    TableSpec("erp", "APLSTD", "full_refresh", ("CHAPTER_0", "CODE_0", "LANNUM_0")),
    TableSpec("erp", "ATEXTRA", "full_refresh", ("CODFIC_0", "ZONE_0", "LANNUM_0", "IDENT1_0", "IDENT2_0"),
              ),
    TableSpec("erp", "REPRESENT", "full_refresh", ("REPNUM_0",)),
    TableSpec("erp", "BPADDRESS", "full_refresh", ("BPANUM_0", "BPAADD_0")),
    TableSpec("erp", "BPSUPPLIER", "full_refresh", ("BPSNUM_0",)),
    TableSpec("erp", "BPARTNER", "full_refresh", ("BPRNUM_0",)),
    TableSpec("erp", "ITMFACILIT", "full_refresh", ("ITMREF_0", "STOFCY_0")),
    TableSpec("erp", "STOCK", "full_refresh", ("STOFCY_0", "ITMREF_0", "LOT_0", "LOC_0")),
    TableSpec("erp", "ITMMASTER", "modified_date", ("ITMREF_0",), cursor_column="UPDDAT_0"),
    TableSpec("erp", "BPCUSTOMER", "modified_date", ("BPCNUM_0",), cursor_column="UPDDAT_0"),
    TableSpec("erp", "SORDER", "modified_date", ("SOHNUM_0",), cursor_column="UPDDAT_0"),
    TableSpec("erp", "SINVOICEV", "header_window", ("NUM_0",),
              window_via=("SINVOICEV", "NUM_0", "INVDAT_0")),
    TableSpec("erp", "PORDER", "header_window", ("POHNUM_0",),
              window_via=("PORDER", "POHNUM_0", "ORDDAT_0")),
    TableSpec("erp", "GACCENTRY", "header_window", ("NUM_0",),
              window_via=("GACCENTRY", "NUM_0", "ACCDAT_0")),
    TableSpec("erp", "STOJOU", "header_window", ("ROWID",),
              window_via=("STOJOU", "ROWID", "IPTDAT_0")),
    TableSpec("erp", "SORDERQ", "header_window", ("SOHNUM_0", "SOPLIN_0"),
              window_via=("SORDER", "SOHNUM_0", "ORDDAT_0")),
    TableSpec("erp", "SORDERP", "header_window", ("SOHNUM_0", "SOPLIN_0"),
              window_via=("SORDER", "SOHNUM_0", "ORDDAT_0")),
    TableSpec("erp", "SINVOICED", "header_window", ("NUM_0", "SIDLIN_0"),
              window_via=("SINVOICEV", "NUM_0", "INVDAT_0")),
    TableSpec("erp", "PORDERQ", "header_window", ("POHNUM_0", "POPLIN_0"),
              window_via=("PORDER", "POHNUM_0", "ORDDAT_0")),
    TableSpec("erp", "GACCENTRYD", "header_window", ("NUM_0", "LIN_0"),
              window_via=("GACCENTRY", "NUM_0", "ACCDAT_0")),
    TableSpec("erp", "SRETURN", "header_window", ("SRHNUM_0",),
              window_via=("SRETURN", "SRHNUM_0", "RTNDAT_0")),
    TableSpec("erp", "SRETURND", "header_window", ("SRHNUM_0", "SRDLIN_0"),
              window_via=("SRETURN", "SRHNUM_0", "RTNDAT_0")),
    TableSpec("erp", "PRECEIPT", "header_window", ("PTHNUM_0",),
              window_via=("PRECEIPT", "PTHNUM_0", "RCPDAT_0")),
    TableSpec("erp", "PRECEIPTD", "header_window", ("PTHNUM_0", "PTDLIN_0"),
              window_via=("PRECEIPT", "PTHNUM_0", "RCPDAT_0")),
    TableSpec("erp", "PINVOICE", "header_window", ("NUM_0",),
              window_via=("PINVOICE", "NUM_0", "INVDAT_0")),
    TableSpec("erp", "PINVOICED", "header_window", ("NUM_0", "PIDLIN_0"),
              window_via=("PINVOICE", "NUM_0", "INVDAT_0")),
    TableSpec("erp", "STOCOUNT", "header_window", ("SESNUM_0",),
              window_via=("STOCOUNT", "SESNUM_0", "CNTDAT_0")),
    TableSpec("erp", "STOCOUNTD", "header_window", ("SESNUM_0", "CNTLIN_0"),
              window_via=("STOCOUNT", "SESNUM_0", "CNTDAT_0")),
    TableSpec("crm", "company", "api_cursor", ("id",), cursor_column="hs_lastmodifieddate"),
    TableSpec("crm", "contact", "api_cursor", ("id",), cursor_column="lastmodifieddate"),
    TableSpec("crm", "deal", "api_cursor", ("id",), cursor_column="hs_lastmodifieddate"),
    TableSpec("crm", "deal_stage_history", "full_refresh", ("deal_id", "stage", "changed_at")),
    TableSpec("crm", "association", "full_refresh", ("from_id", "to_id", "association_type")),
    TableSpec("crm", "engagement", "api_cursor", ("id",), cursor_column="created_at"),
    TableSpec("crm", "owner", "full_refresh", ("id",)),
    TableSpec("crm", "pipeline_stage", "full_refresh", ("pipeline_id", "stage_id")),
    TableSpec("payroll", "employee", "file_drop", ("employee_code",)),
    TableSpec("payroll", "check", "file_drop", ("check_id",)),
    TableSpec("payroll", "earning_detail", "file_drop", ("check_id", "earning_code")),
    TableSpec("payroll", "deduction_detail", "file_drop", ("check_id", "deduction_code")),
    TableSpec("payroll", "tax_detail", "file_drop", ("check_id", "tax_code")),
    TableSpec("payroll", "gl_mapping", "file_drop", ("code_type", "code")),
    TableSpec("planning", "item_location", "snapshot", ("item_code", "location_code")),
    TableSpec("planning", "forecast", "snapshot", ("item_code", "location_code", "period_start")),
    TableSpec("planning", "forecast_accuracy", "snapshot", ("item_code", "location_code", "period_start"),
              ),
    TableSpec("planning", "replenishment_recommendation", "snapshot", ("recommendation_id",)),
    TableSpec("planning", "supplier", "snapshot", ("supplier_code",)),
    TableSpec("freight", "shipment", "api_cursor", ("shipment_id",), cursor_column="created_at"),
    TableSpec("freight", "charge", "header_window", ("shipment_id", "charge_code"),
              window_via=("shipment", "shipment_id", "created_at")),
    TableSpec("freight", "tracking_event", "header_window", ("shipment_id", "event_seq"),
              window_via=("shipment", "shipment_id", "created_at")),
    TableSpec("freight", "shipment_leg", "header_window", ("shipment_id", "leg_seq"),
              window_via=("shipment", "shipment_id", "created_at")),
    TableSpec("freight", "carrier", "full_refresh", ("scac",)),
)

SOURCES: dict[str, dict[str, TableSpec]] = {}
for _t in TABLES:
    SOURCES.setdefault(_t.source, {})[_t.name] = _t


def table_spec(source: str, table: str) -> TableSpec:
    return SOURCES[source][table]


def all_specs() -> list[TableSpec]:
    return [s for tables in SOURCES.values() for s in tables.values()]

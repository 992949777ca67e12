"""Staging: cleaning by a declarative spec, one ``select`` per source table.

Specs are derived, not listed: the cleaning kind follows from the system, the
contract type and the column name; the business name follows from a dictionary
of column codes, with the lower-cased code as the default. A deployment can
pass its own ``aliases``.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import clean


@dataclass(frozen=True)
class StageColumn:
    source: str
    alias: str
    kind: str


@dataclass(frozen=True)
class Menu:
    """Decode integer ``code`` through a label chapter into ``label``."""

    code: str
    chapter: int
    label: str


# text columns that hold numbers
_CRM_NUMBERS = {"numberofemployees", "annualrevenue", "amount", "hs_deal_stage_probability"}
_PAYROLL_NUMBER = re.compile(r"amount$|_pay$|^hours$|_salary$|_rate$")
_PAYROLL_DATE = re.compile(r"_date$|^period_")

# never leaves the landing archive
_PRIVATE = {"ssn_last4"}

# fixed values: business names of the ERP column codes
ERP_NAMES = {
    "ACCDAT": "accounting_date", "ACCCOD": "accounting_code", "ACC": "gl_account_code",
    "ABCCLS": "abc_class", "AMTATILIN": "gross_amount", "AMTCUR": "amount_document_currency",
    "AMTLOC": "amount_company_currency", "AMTNOTLIN": "line_net_amount",
    "AMTTAXLIN": "tax_amount", "BASPRI": "base_sales_price", "BPCGRU": "customer_group_code",
    "BPCINV": "invoicing_customer_code", "BPCNAM": "customer_name", "BPCNUM": "customer_code",
    "BPCORD": "ordering_customer_code", "BPCSNC": "credit_limit_amount",
    "BPRNAM": "partner_name", "BPRNUM": "partner_code", "BPANUM": "partner_code",
    "BPSNAM": "supplier_name", "BPSNUM": "supplier_code", "BPR": "partner_code",
    "CHAPTER": "menu_chapter", "CNTDAT": "count_date", "CNTLIN": "count_line_number",
    "CNTSTA": "count_line_status_code", "CNTTYP": "count_type_code", "CODE": "menu_code",
    "CPY": "company_code", "CPYNAM": "company_name", "CREDAT": "created_date",
    "CREUSR": "created_by", "CRY": "country_code", "CTY": "city", "CUR": "currency_code",
    "DEMDLVDAT": "requested_delivery_date", "DISCRGVAL1": "discount_amount",
    "EANCOD": "ean_code", "EXTRCPDAT": "expected_receipt_date", "FCY": "site_code",
    "FCYNAM": "site_name", "FCYSHO": "site_short_name", "GROPRI": "gross_unit_price",
    "INVDAT": "invoice_date", "INVSTA": "invoice_status_code", "IPTDAT": "movement_date",
    "ITMDES1": "item_description", "ITMDES2": "item_description_2", "ITMREF": "item_code",
    "ITMSTA": "item_status_code", "ITMWEI": "item_weight", "LANNUM": "language_code",
    "LEG": "legislation_code", "LEGCPY": "company_code", "LIN": "journal_line_number",
    "LOC": "location_code", "LOT": "lot_code", "NETPRI": "net_unit_price",
    "ORDDAT": "order_date", "ORDINVSTA": "invoicing_status_code", "ORDSTA": "order_status_code",
    "PAYDAT": "payment_date", "PIDLIN": "supplier_invoice_line_number", "PIHFCY": "site_code",
    "POHFCY": "purchase_site_code", "POHNUM": "purchase_order_number",
    "POPLIN": "purchase_order_line_number", "PTDLIN": "receipt_line_number",
    "PTE": "payment_term_code", "PTHFCY": "receipt_site_code", "PTHNUM": "receipt_number",
    "PURBASPRI": "base_purchase_price", "QTYCNT": "counted_qty", "QTYTHEO": "system_qty",
    "RCPDAT": "receipt_date", "RCPQTY": "received_qty", "REOMODE": "reorder_mode_code",
    "REPNAM": "rep_name", "REPNUM": "rep_code", "REPTYP": "rep_type_code",
    "ROWID": "stock_movement_id", "RTNDAT": "return_date", "RTNREN": "return_reason_code",
    "RTNSTA": "return_status_code", "SALFCY": "sales_site_code", "SAT": "state_province",
    "SESNUM": "count_session_number", "SESSTA": "session_status_code",
    "SHIDAT": "shipment_date", "SHTQTY": "shipped_qty", "SIDLIN": "invoice_line_number",
    "SIVNUM": "invoice_number", "SIVTYP": "invoice_type_code", "SOHNUM": "sales_order_number",
    "SOPLIN": "sales_order_line_number", "SRDLIN": "return_line_number",
    "SRHFCY": "site_code", "SRHNUM": "return_number", "STOFCY": "site_code",
    "STU": "stock_unit", "TCLCOD": "item_category_code", "TEXTE": "menu_label",
    "TOTLINAMT": "order_total_amount", "TRSTYP": "movement_type_code",
    "UOM": "unit_of_measure", "UPDDAT": "updated_date", "UPDTICK": "update_tick",
    "VAT1": "tax_code", "VCRNUM": "document_number", "VCRTYP": "document_type",
}

# fixed values: codes whose business name depends on the table
TABLE_NAMES = {
    ("SORDER", "STOFCY_0"): "shipping_site_code",
    ("SORDERQ", "STOFCY_0"): "shipping_site_code",
    ("SINVOICED", "STOFCY_0"): "shipping_site_code",
    ("SORDERQ", "QTY_0"): "ordered_qty",
    ("SINVOICED", "QTY_0"): "invoiced_qty",
    ("PINVOICED", "QTY_0"): "invoiced_qty",
    ("SRETURND", "QTY_0"): "returned_qty",
    ("PORDERQ", "QTYUOM_0"): "ordered_qty",
    ("PORDERQ", "RCPDAT_0"): "actual_receipt_date",
    ("PRECEIPTD", "QTYUOM_0"): "received_qty",
    ("STOCK", "QTYSTU_0"): "on_hand_qty",
    ("STOJOU", "QTYSTU_0"): "movement_qty",
    ("SINVOICEV", "NUM_0"): "invoice_number",
    ("SINVOICED", "NUM_0"): "invoice_number",
    ("PINVOICE", "NUM_0"): "supplier_invoice_number",
    ("PINVOICED", "NUM_0"): "supplier_invoice_number",
    ("GACCENTRY", "NUM_0"): "journal_entry_number",
    ("GACCENTRYD", "NUM_0"): "journal_entry_number",
    ("SINVOICEV", "BPR_0"): "customer_code",
    ("SINVOICEV", "AMTNOTLIN_0"): "invoice_net_amount",
    ("PINVOICE", "AMTNOTLIN_0"): "net_amount",
    ("PINVOICED", "NETPRI_0"): "invoiced_unit_price",
    ("SORDERP", "ITMDES1_0"): "item_description_at_order",
    ("SINVOICED", "ITMDES1_0"): "item_description_at_invoice",
    ("STOCOUNT", "CREUSR_0"): "counted_by",
    ("PRECEIPT", "CREUSR_0"): "received_by",
    ("COMPANY", "CPYLOG_0"): "is_logistics_flag",
    ("FACILITY", "FCYSTO_0"): "is_stock_site_code",
    ("FACILITY", "FCYSAL_0"): "is_sales_site_code",
    ("FACILITY", "FCYPUR_0"): "is_purchase_site_code",
    ("BPARTNER", "BPCFLG_0"): "is_customer_code",
    ("BPARTNER", "BPSFLG_0"): "is_supplier_code",
    ("BPARTNER", "BPRLOG_0"): "is_active_code",
    ("BPCUSTOMER", "OSTCTL_0"): "credit_control_code",
    ("BPSUPPLIER", "LTI_0"): "lead_time_days",
    ("BPADDRESS", "BPATYP_0"): "partner_type_code",
    ("BPADDRESS", "BPAADD_0"): "address_code",
    ("BPADDRESS", "BPADES_0"): "address_description",
    ("BPADDRESS", "POSCOD_0"): "postal_code",
    ("BPADDRESS", "TEL_0"): "phone",
    ("ITMFACILIT", "SAFSTO_0"): "safety_stock_qty",
    ("ITMFACILIT", "REOMINQTY_0"): "reorder_min_qty",
    ("ITMFACILIT", "REOMAXQTY_0"): "reorder_max_qty",
    ("ITMFACILIT", "LTISUP_0"): "supplier_lead_time_days",
    ("SORDERQ", "SOQSEQ_0"): "sales_order_line_sequence",
    ("SORDERP", "SOPSEQ_0"): "sales_order_line_sequence",
    ("SINVOICEV", "AMTTAXLIN_0"): "invoice_tax_amount",
    ("SINVOICEV", "AMTATILIN_0"): "invoice_gross_amount",
    ("STOCK", "STA_0"): "stock_status",
    ("STOCK", "OWNER_0"): "owner_code",
    ("PORDERQ", "POQSEQ_0"): "purchase_order_line_sequence",
    ("GACCENTRY", "TYP_0"): "entry_type_code",
    ("GACCENTRY", "JOU_0"): "journal_code",
    ("GACCENTRY", "DES_0"): "description",
    ("GACCENTRY", "VCRNUM_0"): "source_document_number",
    ("GACCENTRY", "STA_0"): "entry_status_code",
    ("GACCENTRYD", "SNS_0"): "debit_credit_sign",
    ("GACCENTRYD", "DSP_0"): "dimension_code",
    ("PRECEIPT", "PTHTYP_0"): "receipt_type_code",
    ("PINVOICE", "PIVTYP_0"): "invoice_type_code",
    ("PINVOICE", "BPSINV_0"): "supplier_document_number",
    ("ATEXTRA", "CODFIC_0"): "table_code",
    ("ATEXTRA", "ZONE_0"): "field_code",
    ("ATEXTRA", "IDENT1_0"): "key_1",
    ("ATEXTRA", "IDENT2_0"): "key_2",
    ("ATEXTRA", "TEXTE_0"): "translated_text",
}

# fixed values: business names of the other systems' columns
PLAIN_NAMES = {
    "archived": "is_archived", "numberofemployees": "employee_count",
    "annualrevenue": "annual_revenue", "hubspot_owner_id": "owner_id",
    "createdate": "created_date", "hs_lastmodifieddate": "last_modified_date",
    "lastmodifieddate": "last_modified_date", "closedate": "close_date",
    "dealname": "deal_name", "dealtype": "deal_type", "stage": "deal_stage_id",
    "dealstage": "deal_stage_id", "stage_id": "deal_stage_id", "pipeline": "pipeline_id",
    "hs_is_closed_won": "is_closed_won", "hs_deal_stage_probability": "stage_probability",
    "hs_lead_status": "lead_status", "lifecyclestage": "lifecycle_stage",
    "firstname": "first_name", "lastname": "last_name", "jobtitle": "job_title",
    "erp_order_number": "erp_order_number_raw", "associated_company_id": "company_id",
    "associatedcompanyid": "company_id", "associated_deal_id": "deal_id",
    "changed_at": "changed_at_date", "created_at": "created_date",
    "updated_at": "updated_date", "generated_at": "generated_date",
    "last_sync_at": "last_sync_date", "period_start": "period_start_date",
    "period_end": "period_end_date", "policy": "replenishment_policy",
    "erp_po_number": "erp_purchase_order_number", "ee_id": "employee_id",
    "manager_ee_id": "manager_employee_id", "department_desc": "department_name",
    "gross_pay": "gross_pay_amount", "net_pay": "net_pay_amount",
    "earning_desc": "earning_description", "ee_amount": "employee_amount",
    "er_amount": "employer_amount", "gl_account": "gl_account_code",
    "scac": "carrier_scac", "mode": "transport_mode", "dest_city": "destination_city",
    "dest_state": "destination_state", "dest_postal": "destination_postal_code",
    "dest_country": "destination_country", "status": "shipment_status",
    "estimated_delivery_date": "carrier_promised_delivery_date",
    "total_cost_usd": "header_cost_usd", "amount_usd": "charge_amount_usd",
    "currency": "currency_code", "leg_seq": "leg_sequence", "event_seq": "event_sequence",
    "event_ts": "event_at", "depart_ts": "depart_date", "arrive_ts": "arrive_date",
}

# the second and later columns of a repeated ERP code
_REPEATED = {"REP_0": "primary_rep_code", "REP_1": "secondary_rep_code",
             "BPRNAM_1": "partner_name_2", "TSICOD_0": "statistical_group_1",
             "TSICOD_1": "statistical_group_2", "TSICOD_2": "statistical_group_3",
             "ADDLIG_0": "address_line_1", "ADDLIG_1": "address_line_2"}

# fixed values: label chapters of the ERP's integer menus
MENUS: dict[str, tuple[Menu, ...]] = {
    "ITMMASTER": (Menu("item_status_code", 20, "item_status"),),
    "ITMFACILIT": (Menu("reorder_mode_code", 861, "reorder_mode"),),
    "SORDER": (Menu("order_status_code", 415, "order_status"),),
    "PORDER": (Menu("order_status_code", 415, "order_status"),),
    "STOJOU": (Menu("movement_type_code", 700, "movement_type"),),
    "SRETURN": (Menu("return_status_code", 740, "return_status"),
                Menu("return_reason_code", 720, "return_reason")),
    "SRETURND": (Menu("return_reason_code", 720, "return_reason"),),
    "STOCOUNT": (Menu("count_type_code", 730, "count_type"),
                 Menu("session_status_code", 740, "session_status")),
    "STOCOUNTD": (Menu("count_line_status_code", 740, "count_line_status"),),
}

# yes/no flags read off 1/2 menu integers
FLAGS = {
    "FACILITY": {"is_stock_site": "FCYSTO_0", "is_sales_site": "FCYSAL_0",
                 "is_purchase_site": "FCYPUR_0"},
    "BPARTNER": {"is_customer": "BPCFLG_0", "is_supplier": "BPSFLG_0"},
}


def kind_for(system: str, column: str, dtype: T.DataType) -> str:
    if isinstance(dtype, T.BooleanType):
        return "bool"
    if isinstance(dtype, T.DateType):
        return "sdate" if system == "erp" else "date"
    if isinstance(dtype, T.DecimalType):
        return "num"
    if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType)):
        return "int"
    if isinstance(dtype, T.StringType):
        if system == "crm" and column in _CRM_NUMBERS:
            return "hsnum"
        if system == "payroll" and _PAYROLL_NUMBER.search(column):
            return "pnum"
        if system == "payroll" and _PAYROLL_DATE.search(column):
            return "pdate"
        return "str"
    return "raw"


def alias_for(system: str, table: str, column: str) -> str:
    if system == "erp":
        if (table, column) in TABLE_NAMES:
            return TABLE_NAMES[(table, column)]
        if column in _REPEATED:
            return _REPEATED[column]
        code = re.sub(r"_0$", "", column)
        return ERP_NAMES.get(code, code.lower())
    special = {
        ("crm", "id"): f"{table}_id", ("crm", "name"): "company_name",
        ("crm", "amount"): "deal_amount", ("crm", "type"): "engagement_type",
        ("payroll", "amount"): "earning_amount", ("payroll", "code"): "payroll_code",
        ("payroll", "description"): "code_description",
        ("payroll", "location_code"): "payroll_location_code",
        ("planning", "description"): "item_description", ("planning", "status"): "status",
    }
    return special.get((system, column)) or PLAIN_NAMES.get(column, column)


def spec_for(
    system: str, table: str, schema: T.StructType, aliases: Mapping[str, str] | None = None
) -> list[StageColumn]:
    given = aliases or {}
    return [
        StageColumn(f.name, given.get(f.name) or alias_for(system, table, f.name),
                    kind_for(system, f.name, f.dataType))
        for f in schema
        if f.name not in _PRIVATE
    ]


def stage(
    df: DataFrame, spec: Sequence[StageColumn], derived: Mapping[str, Column] | None = None
) -> DataFrame:
    """One projection: clean, rename, prune; ``derived`` adds computed columns."""
    cols = [clean.KINDS[s.kind](F.col(f"`{s.source}`")).alias(s.alias) for s in spec]
    cols += [c.alias(name) for name, c in (derived or {}).items()]
    return df.select(*cols)


def decode_menu(
    df: DataFrame, labels: DataFrame, code: str, chapter: int, out: str, lang: str = "ENG"
) -> DataFrame:
    """Left-join an integer menu code to its label.

    One chapter in one language is a short code list; the optimizer broadcasts
    it once it has measured it, so no hint is given.
    """
    one = labels.where(
        (F.col("menu_chapter") == chapter) & (F.col("language_code") == lang)
    ).select(F.col("menu_code").alias("_menu_code"), F.col("menu_label").alias(out))
    return df.join(one, F.col(code) == F.col("_menu_code"), "left").drop("_menu_code")


def stage_table(
    system: str,
    table: str,
    df: DataFrame,
    labels: DataFrame | None = None,
    aliases: Mapping[str, str] | None = None,
) -> DataFrame:
    """The staging view of one source table: clean, flags, decoded menus."""
    derived: dict[str, Column] = {
        name: clean.flag_eq(F.col(src)) for name, src in FLAGS.get(table, {}).items()
    } if system == "erp" else {}
    if (system, table) == ("payroll", "employee"):
        first, last = (clean.blank_to_null(F.col(f"legal_{n}_name")) for n in ("first", "last"))
        derived["full_name_normalized"] = F.upper(F.concat(first, F.lit(" "), last))
    out = stage(df, spec_for(system, table, df.schema, aliases), derived)
    if system == "erp" and labels is not None:
        for m in MENUS.get(table, ()):
            out = decode_menu(out, labels, m.code, m.chapter, m.label)
    return out


def pad_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to ``schema``, filling absent columns with typed nulls."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType))
        .alias(f.name)
        for f in schema
    ])


def empty(spark, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)

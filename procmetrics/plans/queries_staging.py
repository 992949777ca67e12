"""One query per source table: every column staged, from raw values planted by its type.

The source schemas are read from the fixtures document, so nothing is listed
here twice. Raw values come from ``orders``: padded and blank text, sentinel dates,
numbers and dates as text with bad ones among them, menu codes with and without a label.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import clean
from ..operators import staging
from .inputs import SENTINEL, txt
from .registry import query

M = clean.MONEY
FIXTURES = os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "FIXTURES.md")
_ROW = re.compile(r"\| (\w+)\.(\w+) \| `[^`]+` \| `[^`]+` \| \w+ \|.*\| (.*) \|$")
# a schema is needed before there is a session, which a type's text would ask for
TYPES = {"string": T.StringType(), "bigint": T.LongType(), "date": T.DateType(), "boolean": T.BooleanType(),
         "decimal(18,4)": T.DecimalType(18, 4)}
SYSTEMS = {"hubspot": "crm", "netstock": "planning", "pangea": "freight", "paycom": "payroll", "sage_x3": "erp"}

# text columns that hold numbers or dates, stated apart from the rules under test
NUMBERS = {
    "crm": ("numberofemployees", "annualrevenue", "amount", "hs_deal_stage_probability"),
    "payroll": ("annual_salary", "hourly_rate", "gross_pay", "net_pay", "hours", "amount", "ee_amount", "er_amount")}
US_DATES = ("hire_date", "rehire_date", "termination_date", "check_date", "period_start", "period_end")
CHAPTERS = (20, 415, 700, 720, 730, 740, 861)


def schemas() -> dict[tuple[str, str], T.StructType]:
    """(system, table) -> source schema; empty where the fixtures document is not there."""
    found = {}
    if os.path.exists(FIXTURES):
        with open(FIXTURES) as f:
            for m in filter(None, (_ROW.match(row.strip()) for row in f)):
                cols = (c.rsplit(" ", 1) for c in re.split(r", (?=\w+ \w)", m[3]))
                found[SYSTEMS[m[1]], m[2]] = T.StructType([T.StructField(n, TYPES[t]) for n, t in cols])
    return found


def _text_kind(system: str, column: str) -> str:
    if column in NUMBERS.get(system, ()):
        return "number"
    return "date" if system == "payroll" and column in US_DATES else "text"


def _raw(system: str, f: T.StructField, j: int) -> Column:
    k, day = F.col("o_orderkey") + j, F.col("o_orderdate").cast("date")
    n = F.col("o_orderkey") * (j + 1)
    kind = f.dataType
    if isinstance(kind, T.StringType):
        what = _text_kind(system, f.name)
        if what == "number":
            return F.when(k % 13 == 0, "n/a").when(k % 17 == 0, " ").otherwise(
                F.concat(F.lit(" "), txt(n % 10007), F.lit(".25 ")))
        if what == "date":
            return F.when(k % 13 == 0, "13/45/2024").otherwise(F.concat(
                txt(F.month(day)), F.lit("/"), txt(F.dayofmonth(day)), F.lit("/"), txt(F.year(day))))
        return F.when(k % 11 == 0, "   ").otherwise(F.concat(F.lit("  v"), txt(n % 97), F.lit(" ")))
    if isinstance(kind, T.DateType):
        late = F.date_add(day, j)
        return F.when(k % 7 == 0, F.lit(SENTINEL)).otherwise(late) if system == "erp" else late
    if isinstance(kind, T.BooleanType):
        return F.when(k % 5 != 0, k % 2 == 0)
    if isinstance(kind, T.DecimalType):
        return ((n % 100003) / 100).cast(kind)
    return (k % 5).cast(kind)


def _sql(system: str, f: T.StructField, j: int) -> str:
    """The staged value of the same column."""
    k, n, day = f"(o_orderkey + {j})", f"(o_orderkey * {j + 1})", "cast(o_orderdate as date)"
    kind = f.dataType
    if isinstance(kind, T.StringType):
        what = _text_kind(system, f.name)
        if what == "number":
            to = "double" if system == "crm" else M
            return f"case when {k} % 13 <> 0 and {k} % 17 <> 0 then cast(({n} % 10007) || '.25' as {to}) end"
        if what == "date":
            return f"case when {k} % 13 <> 0 then {day} end"
        return f"case when {k} % 11 <> 0 then 'v' || ({n} % 97) end"
    if isinstance(kind, T.DateType):
        return f"case when {k} % 7 <> 0 then {day} + {j} end" if system == "erp" else f"{day} + {j}"
    if isinstance(kind, T.BooleanType):
        return f"case when {k} % 5 <> 0 then {k} % 2 = 0 end"
    if isinstance(kind, T.DecimalType):
        return f"cast(cast(({n} % 100003) / 100.0 as decimal(18,2)) as {M})"
    return f"cast({k} % 5 as bigint)"


def _labels(i):
    """Labels of the codes 1 to 3 of each chapter, in two languages."""
    return (i.raw("nation").where("n_nationkey between 1 and 3")
            .select(F.explode(F.array(*map(F.lit, CHAPTERS))).alias("menu_chapter"),
                    F.col("n_nationkey").cast("bigint").alias("menu_code"))
            .withColumn("language_code", F.explode(F.array(F.lit("ENG"), F.lit("FRA"))))
            .withColumn("menu_label", F.concat_ws("-", F.lit("m"), "menu_chapter", "menu_code", "language_code")))


def _register(system: str, table: str, schema: T.StructType) -> None:
    fields = [(j, f) for j, f in enumerate(schema) if f.name not in ("ssn_last4",)]
    named = {staging.alias_for(system, table, f.name): _sql(system, f, j) for j, f in fields}
    source = {f.name: _sql(system, f, j) for j, f in fields}
    if system == "erp":
        for m in staging.MENUS.get(table, ()):
            code = named[m.code]
            named[m.label] = f"case when {code} between 1 and 3 then 'm-{m.chapter}-' || {code} || '-ENG' end"
        named |= {flag: f"{source[c]} = 2" for flag, c in staging.FLAGS.get(table, {}).items()}
    if (system, table) == ("payroll", "employee"):
        named["full_name_normalized"] = f"upper({source['legal_first_name']} || ' ' || {source['legal_last_name']})"
    cols = ",\n  ".join(f'{sql} as "{name}"' for name, sql in named.items())

    @query(f"stg_{system}_{table.lower()}", f"select {cols}\nfrom orders")
    def run(i):
        raw = i.raw("orders").select(*(_raw(system, f, j).alias(f.name) for j, f in enumerate(schema)))
        return staging.stage_table(system, table, raw, _labels(i))


for (_system, _table), _schema in schemas().items():
    _register(_system, _table, _schema)

"""Metric algebra: a ratio is declared once and evaluated, rolled up or asked.

A metric names a base fact, an aggregate per side, filters and the conformed
dimensions it may be sliced by. Definitions are frozen values, in Python or in a
YAML or JSON file; evaluation builds Columns directly, so there is no SQL text.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import ratio
from ..functions.joins import measured_join, stored


class MetricError(ValueError):
    """A definition or a question that cannot be answered."""


OPS = {
    "is_true": lambda c, v: c,
    "is_false": lambda c, v: ~c,
    "is_null": lambda c, v: c.isNull(),
    "is_not_null": lambda c, v: c.isNotNull(),
    "eq": lambda c, v: c == v,
    "ne": lambda c, v: c != v,
    "gt": lambda c, v: c > v,
    "gte": lambda c, v: c >= v,
    "lt": lambda c, v: c < v,
    "lte": lambda c, v: c <= v,
    "in": lambda c, v: c.isin(list(v)),
}

AGGS = {
    "sum": F.sum,
    "count": F.count,
    "count_distinct": F.countDistinct,
    "avg": F.avg,
    "min": F.min,
    "max": F.max,
}

ADDITIVE = ("sum", "count")


@dataclass(frozen=True)
class Filter:
    column: str
    op: str
    value: object = None

    def to_column(self) -> Column:
        if self.op not in OPS:
            raise MetricError(f"unknown filter op {self.op!r}")
        return OPS[self.op](F.col(self.column), self.value)


@dataclass(frozen=True)
class Side:
    agg: str
    column: str
    filter: Filter | None = None
    label: str = ""

    def to_column(self) -> Column:
        if self.agg not in AGGS:
            raise MetricError(f"unknown aggregate {self.agg!r}")
        c = F.col(self.column)
        if self.filter:
            c = F.when(self.filter.to_column(), c)
        return AGGS[self.agg](c)


@dataclass(frozen=True)
class Metric:
    name: str
    label: str
    status: str
    base: str
    grain: str
    numerator: Side | None
    denominator: Side | None
    dimensions: tuple[str, ...] = ()
    filters: tuple[Filter, ...] = ()
    format: str = "number"
    direction: str = "higher_is_better"
    is_data_quality: bool = False
    owner: str = "TBD"
    owner_proposed: str = ""
    description: str = ""
    blocked_reason: str | None = None
    companion: str | None = None
    decimals: int = 2

    @property
    def is_blocked(self) -> bool:
        return self.status == "blocked"


@dataclass(frozen=True)
class Dimension:
    name: str
    model: str
    key: str
    attributes: tuple[str, ...]


# fixed values: conformed dimensions and the attributes a user may slice by
DIMENSIONS = {d.name: d for d in (
    Dimension("date", "dim_date", "date_key",
              ("date_day", "calendar_year", "calendar_quarter", "calendar_month_label",
               "fiscal_year_label", "fiscal_quarter_label")),
    Dimension("customer", "dim_customer", "customer_key",
              ("customer_name", "customer_group_code", "industry", "country_code",
               "payment_term_code", "primary_rep_name", "source_scope")),
    Dimension("site", "dim_site", "site_code",
              ("site_name", "city", "state_province", "country_code", "company_name")),
    Dimension("item", "dim_item", "item_code",
              ("item_description", "item_category_code", "item_status", "best_abc_class")),
    Dimension("carrier", "dim_carrier", "carrier_scac", ("carrier_name", "transport_mode")),
)}

# fixed values: fact column behind each dimension
BINDINGS: dict[str, dict[str, str]] = {
    "fct_shipment": {"date": "ship_date_key", "customer": "customer_key", "site": "site_code",
                     "carrier": "carrier_scac"},
    "fct_shipment_event": {"date": "event_date_key", "customer": "customer_key",
                           "site": "site_code", "carrier": "carrier_scac"},
    "fct_sales_order_line": {"date": "order_date_key", "customer": "customer_key",
                             "site": "site_code", "item": "item_code"},
    "fct_invoice_line": {"date": "invoice_date_key", "customer": "customer_key",
                         "site": "site_code", "item": "item_code"},
    "fct_supplier_invoice_line": {"date": "invoice_date_key", "site": "site_code",
                                  "item": "item_code"},
    "fct_inventory_count_line": {"date": "count_date_key", "site": "site_code",
                                 "item": "item_code"},
    "dim_customer": {},
}

# date keys a fact offers besides its declared one
DATE_ROLES = {
    "fct_shipment": ("ship_date_key", "delivered_date_key"),
    "fct_sales_order_line": ("order_date_key", "requested_delivery_date_key"),
    "fct_invoice_line": ("invoice_date_key", "payment_date_key"),
    "fct_supplier_invoice_line": ("invoice_date_key", "accounting_date_key"),
}


def relationships() -> list[tuple[str, str, str, str]]:
    """(fact, foreign key, dimension, primary key) for every binding."""
    return [
        (fact, col, DIMENSIONS[d].model, DIMENSIONS[d].key)
        for fact, bound in BINDINGS.items()
        for d, col in bound.items()
    ]


# ------------------------------------------------------------ definitions


def from_mapping(raw: Mapping) -> Metric:
    def a_filter(f):
        return Filter(f["column"], f["op"], f.get("value")) if f else None

    def side(s):
        return Side(s["agg"], s["column"], a_filter(s.get("filter")),
                    s.get("label", "")) if s else None

    return Metric(
        name=raw["name"], label=raw["label"], status=raw["status"], base=raw["base_model"],
        grain=raw.get("grain", ""), numerator=side(raw.get("numerator")),
        denominator=side(raw.get("denominator")), dimensions=tuple(raw.get("dimensions") or ()),
        filters=tuple(a_filter(f) for f in raw.get("filters") or ()),
        format=raw.get("format", "number"), direction=raw.get("direction", "higher_is_better"),
        is_data_quality=bool(raw.get("is_data_quality", False)), owner=raw.get("owner", "TBD"),
        owner_proposed=raw.get("owner_proposed", ""), description=raw.get("description", ""),
        blocked_reason=raw.get("blocked_reason"), companion=raw.get("companion_metric"),
        decimals=raw.get("decimals", 2),
    )


def load_metric(path: str | Path) -> Metric:
    text = Path(path).read_text()
    if str(path).endswith(".json"):
        return from_mapping(json.loads(text))
    try:
        import yaml
    except ImportError as e:
        raise MetricError("reading YAML definitions needs PyYAML; use JSON instead") from e
    return from_mapping(yaml.safe_load(text))


def load_metrics(folder: str | Path) -> dict[str, Metric]:
    found = [load_metric(p) for p in sorted(Path(folder).iterdir())
             if p.suffix in (".yml", ".yaml", ".json")]
    return {m.name: m for m in found}


def check(metric: Metric, fact: DataFrame | None = None) -> None:
    """Refuse a definition that cannot be evaluated as declared."""
    if metric.is_blocked:
        if metric.numerator or metric.denominator:
            raise MetricError(f"{metric.name} is blocked and must carry no logic")
        if not metric.blocked_reason:
            raise MetricError(f"{metric.name} is blocked without a reason")
        return
    if metric.base not in BINDINGS:
        raise MetricError(f"{metric.name}: unknown base {metric.base!r}")
    for d in metric.dimensions:
        if d not in DIMENSIONS:
            raise MetricError(f"{metric.name}: {d!r} is not a conformed dimension")
        if d not in BINDINGS[metric.base]:
            raise MetricError(f"{metric.name}: {metric.base} does not bind {d!r}")
    used = [*metric.filters]
    for s in (metric.numerator, metric.denominator):
        if s is None:
            raise MetricError(f"{metric.name} needs a numerator and a denominator")
        s.to_column()
        used.append(Filter(s.column, "is_not_null"))
        if s.filter:
            used.append(s.filter)
    for f in used:
        f.to_column()
        if fact is not None and f.column not in fact.columns:
            raise MetricError(f"{metric.name}: {metric.base} has no column {f.column!r}")


# ------------------------------------------------------------- evaluation


def _keep(df: DataFrame, filters: Sequence[Filter]) -> DataFrame:
    for f in filters:
        df = df.where(f.to_column())
    return df


def _sides(metric: Metric) -> list[Column]:
    return [metric.numerator.to_column().alias("numerator"),
            metric.denominator.to_column().alias("denominator")]


def evaluate(metric: Metric, fact: DataFrame, date_key: str | None = None) -> DataFrame:
    """Numerator, denominator and value per combination of the declared dimensions.

    ``date_key`` plays another date of the fact in the date dimension's role.
    """
    check(metric, fact)
    if metric.is_blocked:
        raise MetricError(f"{metric.name} is blocked: {metric.blocked_reason}")
    bound = dict(BINDINGS[metric.base])
    if date_key is not None:
        if "date" not in metric.dimensions:
            raise MetricError(f"{metric.name} has no date dimension")
        if date_key not in DATE_ROLES.get(metric.base, ()):
            raise MetricError(f"{metric.base} offers no date key {date_key!r}")
        bound["date"] = date_key
    keys = [F.col(bound[d]).alias(DIMENSIONS[d].key) for d in metric.dimensions]
    rows = _keep(fact, metric.filters)
    grouped = rows.groupBy(*keys).agg(*_sides(metric)) if keys else rows.agg(*_sides(metric))
    return _finish(grouped, metric)


def _finish(df: DataFrame, metric: Metric) -> DataFrame:
    return df.withColumns({
        "metric_value": ratio(F.col("numerator"), F.col("denominator")),
        "metric_name": F.lit(metric.name),
        "metric_status": F.lit(metric.status),
    })


def is_reaggregatable(metric: Metric) -> bool:
    return not metric.is_blocked and all(
        s.agg in ADDITIVE for s in (metric.numerator, metric.denominator))


def rollup(metric: Metric, rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Metric rows to a coarser grain: add up each side, then divide."""
    if not is_reaggregatable(metric):
        raise MetricError(f"{metric.name} does not re-aggregate; evaluate it on {metric.base}")
    sums = [F.sum("numerator").alias("numerator"), F.sum("denominator").alias("denominator")]
    return _finish(rows.groupBy(*by).agg(*sums) if by else rows.agg(*sums), metric)


def direct(metric: Metric, fact: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The declared aggregates applied to the fact at any grain."""
    check(metric, fact)
    rows = _keep(fact, metric.filters)
    return _finish(rows.groupBy(*by).agg(*_sides(metric)) if by else rows.agg(*_sides(metric)),
                   metric)


def columns_of(metric: Metric, by: Sequence[str] = (), date_key: str | None = None) -> set[str]:
    """Fact columns a metric reads: its sides, its filters and its dimension keys."""
    used = {f.column for f in metric.filters}
    for s in (metric.numerator, metric.denominator):
        used.add(s.column)
        if s.filter:
            used.add(s.filter.column)
    used.update(BINDINGS[metric.base][d] for d in metric.dimensions)
    used.update(by)
    if date_key:
        used.add(date_key)
    return used


def together(metrics: Sequence[Metric], fact: DataFrame, grains: Sequence[str] = ("declared",)) -> DataFrame:
    """Several metrics of one fact in one pass, as long rows.

    ``declared``: at their dimensions, which may differ, as grouping sets. ``total``: one row per
    metric over all rows. With both, a column ``grain`` tells which row is which. A metric's own filters move inside its
    aggregates, and a group none of whose rows pass them gives no row, as if filtered before.
    Values are decimal(38,6), the type of the process marts.
    """
    if len({m.base for m in metrics}) != 1:
        raise MetricError("metrics evaluated together must share their base")
    bound = BINDINGS[metrics[0].base]
    dims = list(dict.fromkeys(d for m in metrics for d in m.dimensions)) if "declared" in grains else []
    keys = [DIMENSIONS[d].key for d in dims]
    sets = list(dict.fromkeys(m.dimensions for m in metrics)) if "declared" in grains else []
    if "total" in grains and () not in sets:
        sets.append(())
    aggs = []
    for n, m in enumerate(metrics):
        check(m, fact)
        own = None
        for f in m.filters:
            own = f.to_column() if own is None else own & f.to_column()
        for side, name in ((m.numerator, "num"), (m.denominator, "den")):
            pred = side.filter.to_column() if side.filter else None
            if own is not None:
                pred = own if pred is None else own & pred
            c = F.col(side.column)
            c = c if pred is None else F.when(pred, c)
            aggs.append(AGGS[side.agg](c).alias(f"{name}{n}"))
        seen = F.count(F.lit(1)) if own is None else F.count_if(own)
        aggs.append(seen.alias(f"seen{n}"))
    if len(sets) == 1:
        # one grain needs no grouping sets
        cols = [F.col(bound[d]).alias(k) for d, k in zip(dims, keys, strict=True)]
        folded = (fact.groupBy(*cols).agg(*aggs) if cols else fact.agg(*aggs)).withColumn("_set", F.lit(0))
        number = {sets[0]: 0}
    else:
        named = fact.select("*", *[F.col(bound[d]).alias(f"_by_{d}") for d in dims])
        by = [f"_by_{d}" for d in dims]
        folded = named.groupingSets([[F.col(f"_by_{d}") for d in s] for s in sets], *by).agg(
            F.grouping_id(*by).alias("_set"), *aggs)
        folded = folded.withColumnsRenamed(dict(zip(by, keys, strict=True)))
        # a bit for each dimension that a set leaves out
        number = {s: sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in s) for s in sets}
    wide = "decimal(38,6)"

    def row(n: int, m: Metric, grain: str) -> Column:
        here = F.col("_set") == number[m.dimensions if grain == "declared" else ()]
        seen = F.lit(True) if grain == "total" else F.col(f"seen{n}") > 0
        return F.when(here & seen, F.struct(
            F.lit(m.name).alias("metric_name"), F.lit(m.status).alias("metric_status"), F.lit(grain).alias("grain"),
            F.col(f"num{n}").cast(wide).alias("numerator"), F.col(f"den{n}").cast(wide).alias("denominator"),
            ratio(F.col(f"num{n}"), F.col(f"den{n}")).alias("metric_value")))

    rows = F.explode(F.array_compact(F.array(*[row(n, m, g) for g in grains for n, m in enumerate(metrics)])))
    out = folded.select(*keys, rows.alias("r")).select(*keys, "r.*")
    return out if len(grains) > 1 else out.drop("grain")


def by_base(metrics: Sequence[Metric]) -> list[list[Metric]]:
    """Metrics that can share one pass, in order of first appearance."""
    groups: dict[str, list[Metric]] = {}
    for m in metrics:
        if not m.is_blocked:
            groups.setdefault(m.base, []).append(m)
    return list(groups.values())


_PERIOD = re.compile(r"(\d{4})(?:-?Q([1-4])|-?(\d{2}))?")


def period(text: str) -> Column:
    """``2026``, ``2026-Q2``, ``2026Q2`` or ``2026-06`` as a predicate on dim_date."""
    m = _PERIOD.fullmatch(text.strip().upper())
    if not m or (m.group(3) and not 1 <= int(m.group(3)) <= 12):
        raise MetricError(f"cannot read period {text!r}")
    year, quarter, month = m.groups()
    out = F.col("calendar_year") == int(year)
    if quarter:
        out = out & (F.col("calendar_quarter") == int(quarter))
    if month:
        out = out & (F.col("calendar_month") == int(month))
    return out


def ask(
    metric: Metric,
    fact: DataFrame,
    dims: Mapping[str, DataFrame],
    by: Sequence[str] = (),
    where: Mapping[str, object] | None = None,
    period_text: str | None = None,
    rows: DataFrame | None = None,
) -> DataFrame:
    """Slice a metric by ``dim.attribute``, filtered by attributes and a period.

    Metrics that re-aggregate are first folded to the keys of the dimensions asked for, and over the days of the
    period alone, so the dimensions are joined to far fewer rows than the fact has; ``rows`` passes
    a fold in when it is already published. The others are computed on the
    fact. Dimensions join inner, so rows without a date key drop out.
    """
    if metric.is_blocked:
        raise MetricError(f"{metric.name} is blocked: {metric.blocked_reason}")
    check(metric, fact)
    where = dict(where or {})
    wanted: dict[str, list[str]] = {}
    for spec in [*by, *where]:
        dim, _, attr = spec.partition(".")
        _allowed(metric, dim, attr)
        wanted.setdefault(dim, []).append(attr)
    if period_text:
        _allowed(metric, "date", "calendar_year")
        wanted.setdefault("date", []).extend(
            ["calendar_year", "calendar_quarter", "calendar_month"])

    additive = is_reaggregatable(metric)
    if additive:
        df = rows
        if rows is None and period_text:
            fact = _in_period(fact, metric, dims[DIMENSIONS["date"].model], period_text)
        if rows is None:
            # without any dimension the declared ones stay: an empty fact then gives no row to add up
            asked = tuple(d for d in metric.dimensions if d in wanted) or metric.dimensions
            df = evaluate(replace(metric, dimensions=asked), fact)
        key_of = {d: DIMENSIONS[d].key for d in wanted}
    else:
        df = _keep(fact, metric.filters)
        key_of = {d: BINDINGS[metric.base][d] for d in wanted}

    for dim in sorted(wanted):
        d = DIMENSIONS[dim]
        attrs = list(dict.fromkeys(wanted[dim]))
        side = dims[d.model].select(
            F.col(d.key).alias(f"_{dim}_key"), *[F.col(a).alias(f"{dim}.{a}") for a in attrs])
        # filters go onto the dimension before the join
        for spec, value in where.items():
            w_dim, _, w_attr = spec.partition(".")
            if w_dim == dim:
                side = side.where(F.col(f"`{dim}.{w_attr}`") == F.lit(value))
        if dim == "date" and period_text:
            plain = side.select(
                *[F.col(f"`{c}`").alias(c.partition(".")[2] or c) for c in side.columns])
            side = plain.where(period(period_text)).select(
                *[F.col(c).alias(c if c.startswith("_") else f"date.{c}") for c in plain.columns])
        df = df.join(side, F.col(key_of[dim]) == F.col(f"_{dim}_key")).drop(f"_{dim}_key")

    names = [F.col(f"`{s}`").alias(s.replace(".", "_")) for s in by]
    sums = ([F.sum("numerator").alias("numerator"), F.sum("denominator").alias("denominator")]
            if additive else _sides(metric))
    out = df.groupBy(*names).agg(*sums) if names else df.agg(*sums)
    return out.withColumn("value", ratio(F.col("numerator"), F.col("denominator")))


def _in_period(fact: DataFrame, metric: Metric, days: DataFrame, text: str) -> DataFrame:
    """The rows of ``fact`` whose date key is a day of the period; the days are stored and measured first."""
    key = DIMENSIONS["date"].key
    inside = days.where(period(text)).where(F.col(key).isNotNull()).select(F.col(key).alias("_day"))
    on = [(BINDINGS[metric.base]["date"], "_day")]
    return measured_join(fact, stored(inside, "period"), on, F.col(metric.numerator.column), "left_semi")


def _allowed(metric: Metric, dim: str, attr: str) -> None:
    if dim not in DIMENSIONS:
        raise MetricError(f"{dim!r} is not a conformed dimension; there are {list(DIMENSIONS)}")
    if dim not in metric.dimensions:
        raise MetricError(f"{metric.name} cannot be sliced by {dim!r}, only by "
                          f"{list(metric.dimensions)}")
    if attr not in DIMENSIONS[dim].attributes:
        raise MetricError(f"{attr!r} is not an attribute of {dim!r}; there are "
                          f"{list(DIMENSIONS[dim].attributes)}")


REGISTRY_SCHEMA = (
    "metric_name string, metric_label string, status string, is_data_quality boolean, "
    "base_model string, grain string, owner string, owner_proposed string, format string, "
    "direction string, is_reaggregatable boolean, sql_model string, description string, "
    "blocked_reason string"
)


def registry_df(spark: SparkSession, metrics: Mapping[str, Metric]) -> DataFrame:
    """One row per definition; as long as the list of metrics, so safe as literals."""
    return spark.createDataFrame(
        [(m.name, m.label, m.status, m.is_data_quality, m.base, m.grain, m.owner,
          m.owner_proposed, m.format, m.direction, is_reaggregatable(m),
          None if m.is_blocked else f"mtr_{m.name}", m.description, m.blocked_reason)
         for m in metrics.values()],
        REGISTRY_SCHEMA,
    )


@dataclass(frozen=True)
class Catalog:
    """Definitions over models; ``model(name, need)`` builds the columns needed."""

    model: Callable[[str, set[str] | None], DataFrame]
    metrics: Mapping[str, Metric] = field(default_factory=dict)

    def metric(self, name: str, date_key: str | None = None) -> DataFrame:
        m = self.metrics[name]
        return evaluate(m, self.model(m.base, columns_of(m, date_key=date_key)), date_key)

    def ask(self, name: str, **kw) -> DataFrame:
        m = self.metrics[name]
        used = [s.partition(".")[0] for s in [*kw.get("by", ()), *(kw.get("where") or {})]]
        if kw.get("period_text"):
            used.append("date")
        dims = {d.model: self.model(d.model, None) for d in DIMENSIONS.values() if d.name in used}
        return ask(m, self.model(m.base, columns_of(m)), dims, **kw)

    def _passes(self, names: Sequence[str], grains: Sequence[str],
                fold: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """One pass over each fact that the metrics stand on, folded by ``fold``.

        The passes run one after the other and are stored, so that what one has shuffled is gone from the disks
        before the next one starts; a single pass is left to the caller's own action.
        """
        parts, groups = [], by_base([self.metrics[n] for n in names])
        for group in groups:
            need = set().union(*[columns_of(m) for m in group])
            rows = together(group, self.model(group[0].base, need), grains)
            rows = fold(rows) if fold else rows
            parts.append(stored(rows, "metric-rows") if len(groups) > 1 else rows)
        return _stack(parts)

    def rows(self, names: Sequence[str]) -> DataFrame:
        """Long rows of several metrics at their declared dimensions, keys padded."""
        return self._passes(names, ["declared"])

    def totals(self, names: Sequence[str]) -> DataFrame:
        """Each metric over its whole fact."""
        return self._passes(names, ["total"])

    def rows_and_totals(self, names: Sequence[str], fold: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """Both, told apart by ``grain``, from the same pass. A fact without rows gives neither.

        ``fold`` is applied to the rows of each fact; the rows of a metric come from one.
        """
        return self._passes(names, ["declared", "total"], fold)


def _stack(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out

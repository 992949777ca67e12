"""Type-2 history with the check strategy."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import surrogate_key

# fixed values: key and checked columns of the three kept histories
SNAPSHOTS = {
    "bpcustomer": (("customer_code",),
                   ("primary_rep_code", "secondary_rep_code", "payment_term_code",
                    "credit_limit_amount", "customer_group_code", "currency_code")),
    "represent": (("rep_code",), ("rep_name", "site_code", "rep_type_code")),
    "item_location": (("item_code", "location_code"),
                      ("abc_class", "xyz_class", "replenishment_policy", "lead_time_days",
                       "reorder_point_qty", "safety_stock_qty", "supplier_code")),
}


def snapshot_scd2(
    current: DataFrame,
    history: DataFrame | None,
    key: Sequence[str],
    check_cols: Sequence[str],
    as_of: dt.date,
) -> DataFrame:
    """The history after one more look at the source.

    A new key opens a version; a change in any checked column closes the open
    version and opens another; everything else is kept as it is. A key that has
    left the source keeps its open version. ``current`` must hold one row per
    key. The result is a new frame: write it to a new version folder and switch
    readers to it, never over the folder being read.
    """
    opened = current.withColumns({
        "scd_id": surrogate_key(*[F.col(k) for k in key], F.lit(as_of)),
        "valid_from": F.lit(as_of), "valid_to": F.lit(None).cast("date")})
    if history is None:
        return opened
    # closed versions never change, so only open ones are joined
    open_rows = history.where("valid_to is null")
    closed = history.where("valid_to is not null")
    now = current.select(*[F.col(k).alias(f"_n{i}") for i, k in enumerate(key)],
                         F.struct(*check_cols).alias("_now"))
    same_key = [F.col(k).eqNullSafe(F.col(f"_n{i}")) for i, k in enumerate(key)]
    changed = F.col("_now").isNotNull() & ~F.struct(*check_cols).eqNullSafe(F.col("_now"))
    kept = open_rows.join(now, same_key, "left").withColumn(
        "valid_to", F.when(changed, F.lit(as_of))).select(*history.columns)
    was = open_rows.select(*[F.col(k).alias(f"_o{i}") for i, k in enumerate(key)],
                           F.struct(*check_cols).alias("_was"))
    had_key = [F.col(k).eqNullSafe(F.col(f"_o{i}")) for i, k in enumerate(key)]
    new = opened.join(was, had_key, "left").where(
        F.col("_was").isNull() | ~F.struct(*check_cols).eqNullSafe(F.col("_was")))
    return closed.unionByName(kept).unionByName(new.select(*history.columns))


def snapshot(name: str, current: DataFrame, history: DataFrame | None, as_of: dt.date) -> DataFrame:
    """One more look at a table whose history is declared in ``SNAPSHOTS``: its key and its checked columns are kept."""
    key, checked = SNAPSHOTS[name]
    return snapshot_scd2(current.select(*key, *checked), history, key, checked, as_of)

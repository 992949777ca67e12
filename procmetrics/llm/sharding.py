"""Rendezvous hashing of records over weighted shards, by the ``key`` law.

A record's shard follows from its key and the shards alone: every shard draws a
score from (key, shard), the lowest wins. A new shard can only win records, so
growing by one moves records into the new shard and nowhere else.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import store, text_of

#: Rows of one numbering task, on average.
SLOT_ROWS = 100_000
#: Resolution of the uniform draw.
STEPS = 1 << 52


def digest(*parts: Column) -> Column:
    """52 bits of the digest of the parts' texts, from 0 to STEPS - 1; a null part is empty."""
    text = F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")


def draw(key: Column, shard: Column, weight: Column) -> Column:
    """(score, shard): with u uniform from the hash of (key, shard), the score is -ln(u) / weight."""
    u = (digest(key, shard) + 0.5) / STEPS
    return F.struct((-F.log(u) / weight).alias("score"), shard.alias("shard"))


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The winning (score, shard) of ``key`` among ``len(weights)`` shards, numbered from 0.

    The least score wins, so shares follow the weights. Ties go to the smaller shard. A null key is one key like any other.
    """
    return F.array_min(F.transform(F.array(*map(F.lit, weights)), lambda w, i: draw(key, i, w)))


def assign(docs: DataFrame, shards: int = 40, weights: Sequence[float] | None = None,
           grown_weight: float = 1.0, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """Shard, size, checksum and slot of every row of ``docs`` (doc_id, text).

    A null text has no bytes and checksum 0; rows with equal or null doc_id share a
    shard and get separate slots; an empty table gives an empty result; other columns
    are not read. Texts of any length are measured whole. Slots are gapless from 0 in each shard. They are numbered in cells of about
    ``slot_rows`` rows, a cell being a hash range of (doc_id, checksum) within a
    shard, plus the rows of the cells before, so no task numbers a whole shard.
    """
    weights = [float(w) for w in weights or [1.0] * shards]
    if len(weights) != shards or min(weights) <= 0:
        raise ValueError("one weight above 0 is needed for each shard")
    d = docs.select("doc_id", text_of().alias("_t")).select(
        "doc_id", (F.octet_length("_t") + 16).cast("long").alias("size"),
        F.crc32(F.col("_t").cast("binary")).cast("long").alias("text_crc32"))
    d = d.withColumn("_won", rendezvous(F.col("doc_id"), weights))
    # with one shard more, a record goes there or stays
    more = F.least("_won", draw(F.col("doc_id"), F.lit(shards), F.lit(float(grown_weight))))
    d = d.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("_won.shard"),
                 more["shard"].alias("grown_shard"))
    d = store(d, "shards")
    cells = max(1, -(-d.count() // (shards * slot_rows)))
    # the second hash splits rows that repeat one doc_id
    d = d.withColumn("_cell", F.pmod(digest(F.col("doc_id"), F.col("text_crc32"), F.lit("cell")), F.lit(cells)))
    order = W.partitionBy("shard").orderBy("_cell")
    offsets = (d.groupBy("shard", "_cell").agg(F.count("*").alias("_n"))
               .select("shard", "_cell", (F.sum("_n").over(order) - F.col("_n")).alias("_before")))
    inside = W.partitionBy("shard", "_cell").orderBy("doc_id", "text_crc32", "size")
    return (d.withColumn("_i", F.row_number().over(inside)).join(offsets, ["shard", "_cell"])
            .select("doc_id", "size", "text_crc32", "law", "shard",
                    (F.col("_before") + F.col("_i") - 1).alias("slot"), "grown_shard"))


#: With equal weights the shard with the greatest draw wins. The checksum is folded byte by byte, its table built by the rule.
ORACLE = f"""
with crc_table as (
  select list(list_reduce([n] || range(8), lambda c, i:
    case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by n) as t
  from (select unnest(range(256)) as n)),
d as (
  select doc_id, length(h) // 2 + 16 as size,
    xor(list_reduce([4294967295] || list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::bigint),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) as text_crc32
  from (select doc_id, hex(encode(coalesce(text, ''))) as h from documents), crc_table),
u as (
  select *, list_transform(range(41), lambda s:
    ('0x' || substr(md5(coalesce(doc_id::varchar, '') || '|' || s), 1, 13))::bigint) as draws from d),
w as (
  select *, list_position(draws[1:40], list_max(draws[1:40])) - 1 as shard,
    list_position(draws, list_max(draws)) - 1 as grown_shard from u),
c as (
  select *, ('0x' || substr(md5(coalesce(doc_id::varchar, '') || '|' || text_crc32 || '|cell'), 1, 13))::bigint
    % (select greatest(1, ceil(count(*) / (40 * {SLOT_ROWS}))::bigint) from documents) as cell from w)
select doc_id, size, text_crc32, 'key' as law, shard::int as shard, grown_shard::int as grown_shard,
  row_number() over (partition by shard order by cell, doc_id nulls first, text_crc32, size) - 1 as slot
from c
"""

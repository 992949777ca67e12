"""Mixing sources to target weights by Poisson replication.

A source's rate is its target share of the output over its present size. Each
document draws a uniform from its hash, inverts the Poisson distribution of that mean, and is
repeated that often; the copies are dealt out in hash order.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

SEED = 17
#: Default target: a source's weight is its bytes to this power (1 keeps the mix, 0 levels it).
POWER = 0.5
#: Largest mean inverted at once; a higher rate is a sum of independent draws.
PART_MEAN = 16.0
#: Steps of the distribution function of a mean up to PART_MEAN, beyond which less than 2**-52 is left.
STEPS = 64


def source_rates(docs: DataFrame, weights: Mapping[str, float] | None = None, size: float | None = None) -> DataFrame:
    """One row per source: bytes, target share, and ``rate`` = mean copies of a document.

    Without ``weights`` a source weighs its bytes to the power ``POWER``. ``size``
    is the output's size as a multiple of the input (default 1). A null source
    is a source. A source without bytes or without a weight has rate 0 in the former
    case by its weight, in the latter because none was asked for.
    """
    per = docs.groupBy("source").agg(F.sum(F.octet_length(text_of()).cast("long")).alias("bytes"))
    if weights is None:
        per = per.withColumn("weight", F.pow(F.col("bytes").cast("double"), F.lit(POWER)))
    else:
        items = [x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))]
        per = per.withColumn("weight", F.coalesce(F.create_map(*items)[F.col("source")], F.lit(0.0)))
    # a few rows: one per source, added up in a one-row aggregate
    all_ = per.agg(F.sum(F.when(F.col("bytes") > 0, F.col("weight")).otherwise(0.0)).alias("_w"),
                   F.sum("bytes").alias("_b"))
    rate = F.col("weight") / F.col("_w") * F.col("_b") * F.lit(size or 1.0) / F.col("bytes")
    return (per.crossJoin(F.broadcast(all_))
            .select("source", F.when((F.col("bytes") > 0) & (F.col("_w") > 0), rate).otherwise(0.0).alias("rate")))


def uniform(seed: int, part: Column) -> Column:
    """Uniform in [0, 1) from doc_id, 52 bits of its digest; ``part`` tells draws apart."""
    key = F.concat_ws("|", F.lit(str(seed)), part.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("double") / float(1 << 52)


def with_distribution(rates: DataFrame) -> DataFrame:
    """Add ``parts`` and ``cdf``: P(X <= k), k from 0, of the Poisson mean rate / parts."""
    mean = F.col("rate") / F.col("parts")
    first = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("c"))
    cdf = F.aggregate(
        F.sequence(F.lit(1), F.lit(STEPS)), first,
        lambda a, k: F.struct((a["p"] * mean / k).alias("p"),
                              F.concat(a["c"], F.array(F.element_at(a["c"], -1) + a["p"] * mean / k)).alias("c")),
        lambda a: a["c"])
    return (rates.withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / PART_MEAN)).cast("int"))
            .withColumn("cdf", cdf))


def replicate(docs: DataFrame, weights: Mapping[str, float] | None = None, size: float | None = None,
              seed: int = SEED) -> DataFrame:
    """All columns of ``docs`` (doc_id, text, source ...) plus ``_rate``, ``_n`` (its number of copies), ``_copy`` (from 1) and ``_order``.

    Rows are dealt over partitions by ``_order``, a hash of (doc_id, copy), and sorted by it:
    reading the output in order reads the sources mixed. The count of a document follows
    from its doc_id and its source's rate alone, so rows with the same (or a null) doc_id in one source are repeated equally often. A null
    text has no bytes but is repeated like the others of its source. An empty table gives
    an empty result. Rows travel as one struct, so extra columns cannot clash.
    """
    rates = with_distribution(source_rates(docs, weights, size)).select(
        F.col("source").alias("_source"), F.col("rate").alias("_rate"), "parts", "cdf")
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("_row"), "doc_id", "source")
    # a source's row is unique, so a hot source is split by adaptive execution
    drawn = rows.join(rates, rows["source"].eqNullSafe(rates["_source"]))
    count = F.aggregate(
        F.transform(F.sequence(F.lit(1), F.col("parts")), lambda i: uniform(seed, i)), F.lit(0),
        lambda n, u: n + F.size(F.filter("cdf", lambda c: c <= u)))
    drawn = drawn.withColumn("_n", count).where("_n > 0")
    copies = drawn.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    order = F.substring(F.md5(F.concat_ws("|", F.lit(f"order {seed}"), F.col("_copy").cast("string"), F.coalesce(
        F.col("doc_id").cast("string"), F.lit(""))).cast("binary")), 1, 16)
    return (copies.select("_row", "_rate", "_n", "_copy", order.alias("_order"))
            .repartitionByRange("_order").sortWithinPartitions("_order"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed rows with exactly the columns of ``docs``."""
    return replicate(docs, **options).select("_row.*")


ORACLE = f"""
with recursive s as (
  select source, sum(strlen(coalesce(text, '')))::bigint as bytes from documents group by source),
w as (select source, bytes, pow(bytes::double, {POWER}) as weight from s),
r as (select source, case when bytes > 0 then weight / (select sum(weight) from w where bytes > 0)
        * (select sum(bytes) from w)::double * 1.0::double / bytes else 0.0::double end as rate from w),
m as (select source, rate, greatest(1, ceil(rate / {PART_MEAN}::double))::int as parts from r),
cdf as (
  select source, 0 as k, exp(-rate / parts) as p, exp(-rate / parts) as c, rate / parts as mean from m
  union all
  select source, k + 1, p * mean / (k + 1), c + p * mean / (k + 1), mean from cdf where k < {STEPS}),
u as (select doc_id, source, rate, i,
        ('0x' || substr(md5('{SEED}|' || i || '|' || coalesce(doc_id::varchar, '')), 1, 13))::bigint::double
          / {1 << 52}::double as u
      from (select d.doc_id, d.source, m.rate, unnest(range(1, m.parts + 1)) as i
            from documents d join m on d.source is not distinct from m.source)),
n as (select doc_id, u.source, rate, i, count(cdf.k) as n
      from u left join cdf on u.source is not distinct from cdf.source and cdf.c <= u.u group by all),
t as (select doc_id, source, rate, sum(n)::int as n from n group by all)
select doc_id, source, round(rate, 6) as rate, n as n_copies, copy::int as copy,
  substr(md5('order {SEED}|' || copy || '|' || coalesce(doc_id::varchar, '')), 1, 16) as order_key
from (select *, unnest(range(1, n + 1)) as copy from t)
"""

"""Components of similar records from the buckets they share, without listing a bucket's pairs.

Records that share many buckets with many others are likely the middle of a group, such as the original of edited
copies. In each bucket all members meet the most central one; the links found join records into components; the buckets
that still hold several components go on with another central member, members of its component being done. A large
group of copies so costs a few comparisons a member. What is left after ``TURNS`` turns, records that share buckets
but are no copies of the central ones, goes through an exact prefix filter: records can only be similar
if they share one of their rarest tokens, so a crowd of records that are somewhat alike
gives no pairs at all. No two records that share a bucket are passed over unless they are linked already.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import components, discard, sized, small, store

Verify = Callable[[DataFrame], DataFrame]
#: Turns with one central member a bucket; the last one is the first that links less than this share of its pairs.
TURNS, WORTH = 2, 0.1
#: Of a node's tokens the pattern tells of the lowest ones, in so many words of 64 bits. Sets that differ in size have
#: other lowest tokens: where one holds the other, similar sets share 0.75 of the bits on average (standard deviation
#: 0.03), so ``least`` less SLACK lies seven deviations below.
LOWEST, WORDS, SLACK = 256, 8, 0.3
Near = Callable[[Column, Column], Column]
Tokens = Callable[[DataFrame, int], DataFrame]
#: Nodes whose tokens one task opens.
TASK_NODES = 4_000


def shared_buckets(rows: DataFrame) -> DataFrame:
    """The ``rows`` (k, node, about) whose bucket ``k`` holds more than one node, each once; stored."""
    more = store(rows.groupBy("k").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
                 .where("lo < hi").select("k"), "shared")
    return sized(store(rows.join(small(more), "k", "left_semi").distinct(), "buckets"))


def _open(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """The buckets that hold more than one component, with the component of each member."""
    r = sized(store(buckets.join(small(roots), "node", "left").select(
        "k", "node", "about", "pull", F.coalesce("root", "node").alias("root")), "rooted"))
    more = r.groupBy("k").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("k")
    return sized(store(r.join(small(store(more, "open-keys")), "k", "left_semi"), "open"))


def link(buckets: DataFrame, near: Near, verify: Verify, tokens: Tokens, least: float) -> DataFrame:
    """Verified links (a, b), enough of them to give every component, from ``buckets`` (k, node, about).

    ``near(x, y)`` tells from two ``about`` values whether a comparison can succeed; ``verify``
    keeps of the pairs (a, b) those that are similar; ``tokens`` gives for some nodes their distinct tokens
    (node, token), opened after they were dealt by node to so many tasks; their Jaccard similarity is ``least`` or more in every similar pair.
    """
    if buckets.isEmpty():
        return buckets.select(F.col("node").alias("a"), F.col("node").alias("b"))
    size = buckets.groupBy("k").agg(F.count("*").alias("size"))
    pull = buckets.join(size, "k").groupBy("node").agg(F.sum("size").alias("pull"))
    buckets = sized(store(buckets.join(pull, "node").select("k", "node", "about", "pull"), "buckets"))
    links, tried, left = None, None, buckets.withColumn("root", F.col("node"))
    for turn in range(TURNS):
        if turn and left.isEmpty():
            return links
        # later turns weigh the pull by chance, so that other central members get their turn
        chance = F.lit(1.0) if not turn else 0.5 + F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(1000)) / 2000
        hub = left.groupBy("k").agg(F.min(F.struct((-F.col("pull") * chance).alias("o"), "node", "about", "root")).alias("h"))
        pairs = (left.join(hub, "k").where("root <> h.root").where(near(F.col("about"), F.col("h.about")))
                 .select(F.greatest("node", "h.node").alias("a"), F.least("node", "h.node").alias("b")).distinct())
        if tried is not None:
            pairs = pairs.join(small(tried), ["a", "b"], "left_anti")
        pairs = store(pairs, "pairs")
        found = store(verify(pairs), "links")
        tried = sized(pairs if tried is None else store(tried.unionByName(pairs), "tried"))
        links = sized(found if links is None else store(links.unionByName(found), "links"))
        left = _open(buckets, store(components(links), "roots"))
        if found.count() < WORTH * pairs.count():
            break
    if left.isEmpty():
        return links
    # only records that have a possible partner left in a bucket; which one is not asked yet
    other = left.select(F.col("k").alias("k2"), F.col("root").alias("root2"), F.col("about").alias("about2"))
    alone = left.join(other, (F.col("k") == F.col("k2")) & (F.col("root") != F.col("root2"))
                      & near(F.col("about"), F.col("about2")), "left_semi")
    nodes = store(alone.groupBy("node").agg(F.first("root").alias("root"), F.first("about").alias("about")), "open-nodes")
    # as many tasks as the nodes need, whatever the size of what the tokens come from
    rows = tokens(small(nodes), max(1, -(-nodes.count() // TASK_NODES)))
    rest = _rarest_in_common(rows, nodes, near, least).join(small(tried), ["a", "b"], "left_anti")
    return links.unionByName(store(verify(rest), "links"))


def _rarest_in_common(tokens: DataFrame, nodes: DataFrame, near: Near, least: float) -> DataFrame:
    """Pairs (a, b) of different roots that may have a token overlap of ``least`` and more: an exact prefix filter.

    Sets of n and m tokens have to share ``need`` = least / (1 + least) * (n + m) of them. Ordered from rare to frequent,
    the first one they share is therefore among the first ``n - need + 1`` of the one and ``m - need + 1`` of
    the other. Tokens that only one node has come first and need no row. Of a pair's other tokens
    a pattern tells enough to leave out what is clearly below ``least``.

    ``tokens`` (node, token), dealt by node, are opened for every use anew. So what is stored and shuffled are
    counts and prefixes, but never a row for each token.
    """
    often = store(tokens.groupBy("token").agg(F.count("*").alias("often")).where("often > 1"), "often")
    own, n = W.partitionBy("node"), F.col("n")
    # tokens of one node alone have no ``often``, which comes first; a partner has at least least * n tokens
    first = (tokens.join(small(often), "token", "left").withColumn("n", F.count("*").over(own))
             .withColumn("rank", F.row_number().over(own.orderBy(F.col("often").asc_nulls_first(), "token")))
             .where("often is not null").where(F.col("rank") <= n - F.ceil(n * least - 1e-9) + 1).select("token", "node", "n", "rank"))
    h = F.xxhash64("token")
    low = tokens.withColumn("low", F.row_number().over(own.orderBy(h))).where(F.col("low") <= LOWEST)
    bit = F.pmod(h, F.lit(64 * WORDS))
    bits = store(low.groupBy("node").agg(F.array(*(
        F.bit_or(F.when(F.floor(bit / 64) == i, F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int")))
                 .otherwise(F.lit(0).cast("long"))) for i in range(WORDS))).alias("bits")), "patterns")
    prefixes = store(first.join(small(bits), "node").join(small(nodes), "node"), "prefixes")
    first = sized(prefixes)
    one = first.select("token", *(F.col(c).alias(f"{c}_a") for c in ("node", "n", "rank", "bits", "about", "root")))
    two = first.select("token", *(F.col(c).alias(f"{c}_b") for c in ("node", "n", "rank", "bits", "about", "root")))
    need = F.ceil((F.col("n_a") + F.col("n_b")) * (least / (1 + least)) - 1e-9)
    count = lambda f: sum((F.bit_count(f(F.col("bits_a")[i], F.col("bits_b")[i])) for i in range(WORDS)), F.lit(0))
    alike = count(lambda x, y: x.bitwiseAND(y)) >= (least - SLACK) * count(lambda x, y: x.bitwiseOR(y))
    rest = (one.join(two, "token").where("node_a > node_b and root_a <> root_b")
            .where((F.col("rank_a") <= F.col("n_a") - need + 1) & (F.col("rank_b") <= F.col("n_b") - need + 1))
            .where(near(F.col("about_a"), F.col("about_b"))).where(alike)
            .select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct())
    rest = store(rest, "rest")
    discard(prefixes)
    return rest

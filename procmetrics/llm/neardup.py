"""Near-duplicate documents by order MinHash and banded alignment.

A document is the sequence of its five-word shingles. Its labelled shingles (shingle and
how often it came before) are hashed once for each sketch; the ``least`` ones
by hash, put back in text order, make the sketch's key. Equal keys therefore
mean the same shingles in the same order, which follows edit similarity rather than set
overlap. Candidates that share a key are verified by banded alignment:

    similarity = L / (n + m - L),  L = longest common subsequence of the shingles

which is the Jaccard similarity of shingles that keep their order. Links of 0.8 and more join
documents into classes.

Which candidates of a bucket meet, and why none is lost, is told in ``linking``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, small, store
from .linking import link, shared_buckets
from .phrases import text_key
from .wordhash import Rolling, Words, mix, split_words

SHINGLE = 5
SIMILARITY = 0.8
#: (least, sketches, fewest and most shingles of the documents it serves). The ranges overlap by
#: more than SIMILARITY, so two similar documents always have a family in common. At
#: similarity 0.8 a pair shares no key with probability 0.0003 (short) and 0.0006 (long).
FAMILIES = ((3, 20, 1, 45), (6, 28, 36, None))
#: Lowest labelled shingles that a document's bit pattern tells of, and the share of common
#: bits below which two documents are not compared. Where one text holds the other, similar ones share 0.72 of the bits on
#: average (standard deviation 0.08), four deviations above; none of 49,200 simulated pairs at similarity 0.8 fell below it.
LOWEST, BITS = 40, 0.35
#: Values of one matrix of sketches by shingles.
CELLS = 1 << 21
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def shingles_of(words: list[bytes], hashed: Words, rolling: Rolling) -> np.ndarray:
    """Hashes of the five-word shingles in order; a shorter text is one shingle, no words are none."""
    h = hashed(words)
    return rolling(h, min(SHINGLE, len(h))) if len(h) else np.zeros(0, np.uint64)


def labelled(shingles: np.ndarray) -> np.ndarray:
    """Each shingle hashed with the number of equal ones before it."""
    order = np.argsort(shingles, kind="stable")
    s = shingles[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    place = np.arange(len(s))
    count = place - np.maximum.accumulate(np.where(new, place, 0))
    out = np.empty(len(s), np.uint64)
    out[order] = s
    rank = np.empty(len(s), np.uint64)
    rank[order] = count.astype(np.uint64)
    return mix(out + rank * _GOLD)


def sketch_keys(values: np.ndarray, least: int, sketches: int) -> np.ndarray:
    """One key per sketch: its ``least`` smallest values by that sketch's hash, in text order."""
    n, seeds = len(values), mix(np.arange(1, sketches + 1, dtype=np.uint64) * _GOLD + np.uint64(least))
    take, keys = min(least, n), []
    step = max(1, CELLS // n)
    powers = np.cumprod(np.full(take, _GOLD, np.uint64))
    for at in range(0, sketches, step):
        z = mix(values[None, :] ^ seeds[at:at + step, None])
        if take < n:
            low = np.sort(np.argpartition(z, take - 1, axis=1)[:, :take], axis=1)
        else:
            low = np.broadcast_to(np.arange(n), z.shape)
        keys.append(mix((values[low] * powers).sum(axis=1, dtype=np.uint64) + seeds[at:at + step]))
    return np.concatenate(keys)


def pattern(values: np.ndarray) -> tuple[int, int]:
    """128 bits that tell which labelled shingles are among the ``LOWEST`` by hash."""
    low = np.partition(values, LOWEST - 1)[:LOWEST] if len(values) > LOWEST else values
    bits = np.zeros(128, np.uint8)
    bits[(low & np.uint64(127)).astype(np.int64)] = 1
    one, two = np.packbits(bits).view(np.int64)
    return int(one), int(two)


def _near(x: Column, y: Column) -> Column:
    """Whether sizes and bit patterns allow two documents to be similar enough."""
    common, some = F.lit(0), F.lit(0)
    for b in ("b1", "b2"):
        common, some = common + F.bit_count(x[b].bitwiseAND(y[b])), some + F.bit_count(x[b].bitwiseOR(y[b]))
    return (F.least(x["n"], y["n"]) >= SIMILARITY * F.greatest(x["n"], y["n"])) & (common >= BITS * some)


SKETCH = "doc_id long, text_hash long, text_key long, n long, b1 long, b2 long, keys array<long>"


def _sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashed, rolling = Words(), Rolling()
    for b in batches:
        text, size, bits, keys = [], [], [], []
        for t in b.column("text"):
            w = split_words(t.as_py())
            s = shingles_of(w, hashed, rolling)
            text.append(text_key(hashlib.sha256(b" ".join(w)).digest()) if w else None)
            size.append(len(s))
            v = labelled(s)
            bits.append(pattern(v))
            k = [sketch_keys(v, least, many) for least, many, low, high in FAMILIES
                 if low <= len(s) and (high is None or len(s) <= high)]
            keys.append(np.concatenate(k).view(np.int64).tolist() if k else [])
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("text_hash"), pa.array(text, pa.int64()), pa.array(size, pa.int64()),
             pa.array([x for x, _ in bits], pa.int64()), pa.array([x for _, x in bits], pa.int64()),
             pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "text_hash", "text_key", "n", "b1", "b2", "keys"])


def common_length(a: list, b: list, band: int) -> int:
    """Longest common subsequence of ``a`` and ``b`` whose matches lie at most ``band`` off the diagonal.

    Bit-parallel: one integer holds the band's row, whose zeros count the matches; each element of ``b`` costs a few
    operations on 2 * band + 1 bits, and bits that leave the band are counted and dropped.
    """
    places: dict = {}
    for i, x in enumerate(a):
        places.setdefault(x, []).append(i)
    width = 2 * band + 1
    row, full, found, base = (1 << width) - 1, (1 << width) - 1, 0, -band
    for x in b:
        m = 0
        for i in places.get(x, ()):
            if 0 <= i - base < width:
                m |= 1 << (i - base)
        if m:
            u = row & m
            row = ((row + u) | (row & ~m)) & full
        # the band moves on by one
        found += not row & 1
        row = (row >> 1) | (1 << (width - 1))
        base += 1
    return found + width - row.bit_count()


def similarity(a: list, b: list, least: float = SIMILARITY) -> float:
    """Ordered similarity of two shingle sequences; 0 where it cannot reach ``least``."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    total = len(a) + len(b)
    # what has to be common, and how many elements may then stay without a partner
    need = least * total / (1 + least)
    if min(len(a), len(b)) < need - 1e-9:
        return 0.0
    # equal ends are common to some longest subsequence
    lo, hi = 0, min(len(a), len(b))
    while lo < hi and a[lo] == b[lo]:
        lo += 1
    tail = 0
    while tail < hi - lo and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    x, y = a[lo:len(a) - tail], b[lo:len(b) - tail]
    band = int(total - 2 * need) + 1
    found = lo + tail + (common_length(x, y, band) if x and y else 0)
    s = found / (total - found)
    return s if s >= least else 0.0


def _verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def shingles(text):
        w = split_words(text)
        return [tuple(w[i:i + SHINGLE]) for i in range(max(1, len(w) - SHINGLE + 1))] if w else []

    last, right = None, []
    for b in batches:
        keep = []
        for i, (hub, s, t) in enumerate(zip(b.column("b"), b.column("text_a"), b.column("text_b"), strict=True)):
            if (hub := hub.as_py()) != last:
                last, right = hub, shingles(t.as_py())
            keep.append(similarity(shingles(s.as_py()), right) > 0)
        out = b.filter(pa.array(keep, pa.bool_()))
        yield pa.RecordBatch.from_arrays([out.column("a"), out.column("b")], names=["a", "b"])


def _tokens(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashed, rolling = Words(), Rolling()
    for b in batches:
        for node, t in zip(b.column("node").to_pylist(), b.column("text"), strict=True):
            v = np.unique(labelled(shingles_of(split_words(t.as_py()), hashed, rolling)).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), pa.array([v], pa.list_(pa.int64()))], names=["node", "tokens"])


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts are similar enough."""
    one = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    full = pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b")
    return full.mapInArrow(_verify, "a long, b long")


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id): the class of each distinct doc_id of ``docs`` (doc_id, text).

    ``class_id`` is the smallest doc_id of the class. Documents whose words are equal are one class,
    whatever their spaces. Documents without words (null, empty) are alike to nothing; texts of
    fewer than five words are one shingle. Rows that repeat a doc_id are one document, alike to what any of
    them is; rows with a null doc_id are left out. Other columns are not read.
    """
    d = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"),
                                                F.coalesce("text", F.lit("")).alias("text"))
    d = d.withColumn("text_hash", F.xxhash64("text"))
    sketch = store(d.select("doc_id", "text", "text_hash").mapInArrow(_sketch, SKETCH), "near-sketch")
    worded = sketch.where("text_key is not null")
    # what is compared are texts; the first row of each stands for it
    first = store(worded.groupBy("text_key").agg(F.min(F.struct("doc_id", "text_hash")).alias("f"))
                  .select("text_key", F.col("f.doc_id").alias("node"), F.col("f.text_hash").alias("node_hash")), "first-texts")
    # also joins the texts of rows that repeat an id
    same = worded.select("doc_id", "text_key").join(first, "text_key").select(
        F.col("doc_id").alias("a"), F.col("node").alias("b"))
    own = worded.join(first, "text_key").where("doc_id = node and text_hash = node_hash")
    rows = own.select(F.explode("keys").alias("k"), F.col("text_key").alias("node"), F.struct("n", "b1", "b2").alias("about"))
    buckets = shared_buckets(rows)
    nodes = first.join(buckets.select(F.col("node").alias("text_key")).distinct(), "text_key", "left_semi")
    nodes = store(nodes.select("text_key", F.col("node").alias("doc_id"), F.col("node_hash").alias("text_hash")), "nodes")
    texts = store(d.join(small(nodes), ["doc_id", "text_hash"]).select(F.col("text_key").alias("node"), "text").distinct(), "near-texts")
    found = link(buckets, _near, lambda pairs: _verified(pairs, texts),
                 lambda some, tasks: texts.join(some.select("node"), "node", "left_semi").mapInArrow(
                     _tokens, "node long, tokens array<long>").repartition(tasks, "node").select("node", F.explode("tokens").alias("token")), SIMILARITY)
    ids = lambda end: first.select(F.col("text_key").alias(end), F.col("node").alias(f"id_{end}"))
    found = found.join(ids("a"), "a").join(ids("b"), "b").select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))
    root = components(found.unionByName(same))
    return (d.select("doc_id").distinct().join(root, F.col("doc_id") == F.col("node"), "left")
            .select("doc_id", F.coalesce("root", "doc_id").alias("class_id")))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: one row for each class, the one with the smallest doc_id.

    All columns are kept, whatever their names. Of rows that repeat a doc_id one stays, the one with the least
    text (null first). Rows with a null doc_id stay, as nothing tells them apart.
    """
    keep = classes(docs).where("doc_id = class_id").select(F.col("doc_id").alias("_keep"))
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("_row"), "doc_id", "text")
    one = (rows.join(keep, F.col("doc_id") == F.col("_keep")).groupBy("doc_id")
           .agg(F.min_by("_row", F.struct("text")).alias("_row")))
    return one.select("_row.*").unionByName(docs.where("doc_id is null"))

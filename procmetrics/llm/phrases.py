"""Substring dedup with repeated-phrase automata.

Removed are the words of every window of 50 words that also starts in a document with a
smaller id. The windows are found in four steps.

1. Sketch: of the 10-word phrases of each window the least by hash is marked.
   Windows with the same words mark the same phrase, so a window that two documents share
   leaves the same mark in both. Texts with equal words are one from here on.
2. Recurring phrases: marks found in more than one document; their words are read from the first document that has them.
3. Automata: documents with recurring phrases are dealt into shards of about ``SHARD_PHRASES`` phrases, documents with
   the same first owner together, a common owner's in several shards. Each shard's phrases are compiled into an
   Aho-Corasick automaton (pyahocorasick), and its documents are streamed through it. Where a phrase stands in a
   document is known from the automaton alone. A document without a recurring phrase shares no window and stays out.
   Each occurrence names up to 41 windows around it.
4. Confirm: windows are compared by 128 bits of their words' hashes; the smallest document of
   each window is a partial aggregate, and windows of later documents are removed.

Whatever is proportional to all words stays in the first scan; only marks, and
the windows around recurring ones, are shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small, store
from .wordhash import Rolling, Words, mix, sliding, split_words

WINDOW, PHRASE = 50, 10
SPREAD = WINDOW - PHRASE + 1
#: Phrases of one automaton, about (a document with more is alone in its shard).
SHARD_PHRASES = 5_000
_SECOND = np.uint64(0xA0761D6478BD642F)

SKETCH = "doc_id long, n_words long, sha string, text_key long, marks array<long>, places array<int>"


def marks_of(hashes: np.ndarray, rolling: Rolling) -> np.ndarray:
    """Positions of the phrases that are the least of some window; equal ones all count."""
    h = rolling(hashes, PHRASE)
    if len(h) < SPREAD:
        return np.zeros(0, np.int64)
    least = sliding(h, SPREAD, np.minimum)
    # the greatest window minimum among the windows that hold a phrase
    pad = np.zeros(SPREAD - 1, np.uint64)
    best = sliding(np.concatenate([pad, least, pad]), SPREAD, np.maximum)
    return np.flatnonzero(best == h)


def text_key(sha: bytes) -> int:
    return int.from_bytes(sha[:8], "big", signed=True)


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)])
    flat = np.concatenate(values) if values else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))


def _sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words, rolling = Words(), Rolling()
    for b in batches:
        n, sha, key, marks, places = [], [], [], [], []
        for t in b.column(1):
            w = split_words(t.as_py())
            d = hashlib.sha256(b" ".join(w))
            h = words(w) if len(w) >= WINDOW else np.zeros(0, np.uint64)
            at = marks_of(h, rolling)
            n.append(len(w))
            sha.append(d.hexdigest())
            key.append(text_key(d.digest()))
            marks.append(rolling(h, PHRASE)[at].view(np.int64) if len(at) else np.zeros(0, np.int64))
            places.append(at.astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(key, pa.int64()),
             _lists(marks, pa.int64()), _lists(places, pa.int32())],
            names=["doc_id", "n_words", "sha", "text_key", "marks", "places"])


def _own_text(b: pa.RecordBatch) -> Iterator[tuple[int, int, list[bytes], list[int]]]:
    """Rows (doc_id, text_key, words, list) whose text is the one that is meant.

    Texts were joined by doc_id; of rows that repeat an id with another text, only the right one goes on.
    """
    for doc, key, text, ints in zip(*(b.column(c) for c in ("doc_id", "text_key", "text", "ints")), strict=True):
        w = split_words(text.as_py())
        if text_key(hashlib.sha256(b" ".join(w)).digest()) == key.as_py():
            yield doc.as_py(), key.as_py(), w, ints.as_py()


def _phrases(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mark, phrase: the words of the marks a document owns, given as alternating marks and places."""
    for b in batches:
        marks, phrases = [], []
        for _, _, w, ints in _own_text(b):
            for mark, p in zip(ints[::2], ints[1::2], strict=True):
                marks.append(mark)
                phrases.append(b" ".join(w[p:p + PHRASE]).decode())
        yield pa.RecordBatch.from_arrays([pa.array(marks, pa.int64()), pa.array(phrases, pa.string())], names=["mark", "phrase"])


def automaton_of(phrases: Iterable[str]):
    import ahocorasick

    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for p in phrases:
        automaton.add_word(f" {p} ")
    automaton.make_automaton()
    return automaton


def locate(automaton, words: list[bytes]) -> np.ndarray:
    """Starts of the windows around the places where a phrase of ``automaton`` stands, in order."""
    w = [x.decode() for x in words]
    length = np.fromiter(map(len, w), np.int64, len(w))
    n = len(w)
    if n < WINDOW or not len(automaton):
        return np.zeros(0, np.int64)
    ends = np.fromiter((e for e, _ in automaton.iter(" " + " ".join(w) + " ")), np.int64)
    # the place of the space after each word tells which word an occurrence ends with
    p = np.unique(np.searchsorted(np.cumsum(length + 1), ends)) - PHRASE + 1
    edge = np.zeros(n - WINDOW + 2, np.int64)
    np.add.at(edge, np.maximum(p - SPREAD + 1, 0), 1)
    np.add.at(edge, np.minimum(p, n - WINDOW) + 1, -1)
    return np.flatnonzero(np.cumsum(edge[:-1]) > 0)


def _windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of documents; rows (shard, doc_id, text_key, text) in order of shards, each shard's phrases (doc_id null) first."""
    words, one, two = Words(), Rolling(), Rolling(0xD1342543DE82EF95)
    at, phrases, automaton = None, [], None
    for b in batches:
        for shard, doc, key, text in zip(*(b.column(c) for c in ("shard", "doc_id", "text_key", "text")), strict=True):
            if shard.as_py() != at:
                at, phrases, automaton = shard.as_py(), [], None
            if not doc.is_valid:
                phrases.append(text.as_py())
                continue
            w = split_words(text.as_py())
            if text_key(hashlib.sha256(b" ".join(w)).digest()) != key.as_py():
                continue
            if automaton is None:
                automaton, phrases = automaton_of(phrases), []
            starts = locate(automaton, w)
            if not len(starts):
                continue
            h = words(w)
            first, second = one(h, WINDOW)[starts], two(mix(h ^ _SECOND), WINDOW)[starts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(first.view(np.int64)), pa.array(second.view(np.int64)),
                 pa.array(np.full(len(starts), doc.as_py(), np.int64)), pa.array(np.full(len(starts), key.as_py(), np.int64)),
                 pa.array(starts.astype(np.int32))], names=["h1", "h2", "doc_id", "text_key", "start"])


def shards_of(hits: DataFrame, shard_phrases: int) -> DataFrame:
    """doc_id, text_key and shard for ``hits`` (doc_id, text_key, mark, owner)."""
    docs = store(hits.groupBy("doc_id", "text_key").agg(F.min("owner").alias("owner"), F.count("*").alias("n")), "hit-documents")
    sizes = docs.groupBy("owner").agg(F.ceil(F.sum("n") / shard_phrases).alias("parts"))
    total = docs.agg(F.sum("n")).first()[0] or 0
    part = F.pmod(F.xxhash64("doc_id", "text_key"), F.col("parts"))
    shard = F.pmod(F.xxhash64("owner", part, F.lit(3)), F.lit(max(1, -(-total // shard_phrases)))).cast("int")
    return store(docs.join(small(store(sizes, "owner-sizes")), "owner").select("doc_id", "text_key", shard.alias("shard")), "shards")


def _remove(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        docs, keys, removed, sha = [], [], [], []
        for doc, key, w, starts in _own_text(b):
            edge = np.zeros(len(w) + 1, np.int64)
            s = np.unique(starts)
            edge[s] += 1
            edge[s + WINDOW] -= 1
            gone = np.cumsum(edge[:-1]) > 0
            kept = [w[i] for i in np.flatnonzero(~gone)]
            docs.append(doc)
            keys.append(key)
            removed.append(len(w) - len(kept))
            sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [pa.array(docs, pa.int64()), pa.array(keys, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(sha, pa.string())], names=["doc_id", "text_key", "n_removed", "kept_sha256"])


def removals(docs: DataFrame, shard_phrases: int = SHARD_PHRASES) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 for each row of ``docs`` (doc_id, text).

    Null and empty texts have no words, texts under 50 words keep all. A row whose
    doc_id is null neither loses words nor makes others lose them. Rows with the same doc_id are one document:
    they remove nothing from each other. Texts of any length are taken whole. Other columns are not read; an empty table gives an empty result.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    sketch = store(d.mapInArrow(_sketch, SKETCH), "sketch")
    first = sketch.groupBy("sha").agg(F.min("doc_id").alias("first"))
    # one row per text: further rows of the same id and text add nothing
    own = (sketch.where("size(marks) > 0 and doc_id is not null").join(first, "sha").where("doc_id = first")
           .select("doc_id", "text_key", F.explode(F.arrays_zip("marks", "places")).alias("m"))
           .select("doc_id", "text_key", F.col("m.marks").alias("mark"), F.col("m.places").alias("place")))
    # the first document of each mark, if there is another one
    first_of = F.min(F.struct("doc_id", "text_key", "place"))
    marks = store(own.groupBy("mark").agg(first_of.alias("o"), F.max("doc_id").alias("hi")).where("o.doc_id < hi")
                  .select("mark", F.col("o.doc_id").alias("owner"), F.col("o.text_key").alias("owner_key"), F.col("o.place").alias("place")),
                  "marks")
    hits = store(own.select("doc_id", "text_key", "mark").join(small(marks.select("mark", "owner")), "mark").distinct(), "hits")
    shards = shards_of(hits, shard_phrases)
    # few documents hold recurring phrases; if they are few enough, the other texts stay where they are
    texts = store(d.join(small(shards), "doc_id"), "phrase-texts")
    owned = marks.groupBy(F.col("owner").alias("doc_id"), F.col("owner_key").alias("text_key")).agg(
        F.flatten(F.collect_list(F.array("mark", F.col("place").cast("long")))).alias("ints"))
    phrases = store(texts.join(owned, ["doc_id", "text_key"]).mapInArrow(_phrases, "mark long, phrase string")
                    .dropDuplicates(["mark"]), "phrases")
    needed = hits.join(small(shards), ["doc_id", "text_key"]).select("shard", "mark").distinct()
    nobody = F.lit(None).cast("long")
    rows = (needed.join(phrases, "mark").select("shard", nobody.alias("doc_id"), nobody.alias("text_key"), F.col("phrase").alias("text"))
            .unionByName(texts.select("shard", "doc_id", "text_key", "text")))
    # a shard is one task's; its phrases, sorted first, are all that the task keeps
    rows = rows.repartition("shard").sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first())
    windows = store(rows.mapInArrow(_windows, "h1 long, h2 long, doc_id long, text_key long, start int"), "windows")
    owner = (windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
             .where("lo < hi").select("h1", "h2", "lo"))
    # stored, so that adaptive execution can split the windows of a hot passage between tasks
    gone = (windows.join(small(store(owner, "owners")), ["h1", "h2"]).where("doc_id > lo").groupBy("doc_id", "text_key")
            .agg(F.collect_set("start").alias("ints")))
    cut = (texts.drop("shard").join(gone, ["doc_id", "text_key"])
           .mapInArrow(_remove, "doc_id long, text_key long, n_removed long, kept_sha256 string")
           .dropDuplicates(["doc_id", "text_key"]))
    # a copy of an earlier document loses everything, as all its windows start there
    copy = (F.col("doc_id") > F.col("first")) & (F.col("n_words") >= WINDOW)
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return (sketch.select("doc_id", "n_words", "sha", "text_key").join(first, "sha")
            .join(cut, ["doc_id", "text_key"], "left")
            .select("doc_id", "n_words",
                    F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
                    F.when(copy, none).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256")))

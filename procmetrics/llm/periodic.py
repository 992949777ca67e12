"""Runs of repeating words, by Lyndon roots.

Every run (a stretch with a period, as long as it can be) holds a Lyndon root: from some place of it on, the longest
Lyndon word, under the order of the words or under the reversed order, is one period long. The first phase of Baier's
suffix sorter groups suffixes by their longest Lyndon prefix, so it gives the Lyndon arrays of both orders without
any suffix array. Each Lyndon word found is then extended to both sides as far as words one period apart agree, by
longest common extensions over names of blocks of 1, 2, 4 ... words.

A run of exponent e shows each of its words e times. So texts are first cut at words that are found less than e times in
what is left of a stretch, until nothing changes; no run crosses such a word, and the cut word is no continuation of a run
either. What is left of all texts of a batch goes through the sorter as one sequence with lowest separators.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of, words_of

#: A run has so many periods and so many words at least.
EXPONENT, SHORTEST = 4, 6
#: Bytes of text whose words are handled together; a longer text is handled alone.
CHUNK = 1 << 21

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def stretches(x: np.ndarray, doc: np.ndarray, times: int, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``x`` that a run of exponent ``times`` may cover, and the number of the stretch each is in."""
    place, part, kinds = np.arange(len(x)), doc.astype(np.int64), int(x.max(initial=0)) + 1
    while len(place):
        _, inverse, found = np.unique(part * kinds + x[place], return_inverse=True, return_counts=True)
        stays = found[inverse] >= times
        if stays.all():
            break
        place, part = place[stays], part[stays]
        starts = np.ones(len(place), bool)
        starts[1:] = (np.diff(place) != 1) | (np.diff(part) != 0)
        part = np.cumsum(starts) - 1
        long = np.bincount(part, minlength=1)[part] >= shortest
        place, part = place[long], part[long]
    return place, part


def lyndon_lengths(y: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word that starts at each place of ``y``; -1 is a separator, below all words.

    Suffixes are grouped by their first word; groups are taken from the highest to the lowest. Each suffix of a group
    points to the nearest suffix before it whose group is lower, that is, has not been taken; suffixes pointed to equally
    often from the group leave their own group for a new one just above it, whose common prefix is longer by as many
    prefixes of the group taken. When a group is taken, its prefix is the longest Lyndon prefix of its suffixes.
    """
    n = len(y)
    lengths = np.zeros(n, np.int64)
    order = np.argsort(y, kind="stable")
    order = order[np.searchsorted(y[order], 0):]
    if not len(order):
        return lengths
    cuts = np.flatnonzero(np.diff(y[order])) + 1
    members = [m.tolist() for m in np.split(order, cuts)]
    first = len(members)
    own = np.full(n, -1, np.int64)
    own[order] = np.repeat(np.arange(first), np.diff([0, *cuts, len(order)]))
    own = own.tolist()
    below, above = list(range(-1, first - 1)), [*range(1, first), -1]
    context, taken = [1] * first, [False] * first
    taken.append(False)  # index -1: separators are never taken, whatever is added before it
    before = list(range(-1, n - 1))
    result = [0] * n
    group = first - 1
    while group >= 0:
        taken[group] = True
        size = context[group]
        hits: dict[int, int] = {}
        for s in members[group]:
            if own[s] != group:
                continue  # left for a higher group
            result[s] = size
            j = before[s]
            while j >= 0 and taken[own[j]]:
                j = before[j]
            before[s] = j
            if j >= 0 and own[j] >= 0:
                hits[j] = hits.get(j, 0) + 1
        members[group] = None
        if hits:
            parts: dict[tuple[int, int], list[int]] = {}
            for j, times in hits.items():
                key = (-times, own[j])
                if key in parts:
                    parts[key].append(j)
                else:
                    parts[key] = [j]
            # the most often hit part first: each new group goes just above the old one, below those made before
            for times, old in sorted(parts):
                new = len(members)
                moved = parts[times, old]
                members.append(moved)
                context.append(context[old] - times * size)
                taken[new] = False
                taken.append(False)
                for j in moved:
                    own[j] = new
                up = above[old]
                below.append(old)
                above.append(up)
                above[old] = new
                if up >= 0:
                    below[up] = new
        group = below[group]
    lengths[:] = result
    return lengths


class Extensions:
    """How far two places of a sequence agree, forwards and backwards; blocks of 2**k entries have equal names if equal."""

    def __init__(self, z: np.ndarray, longest: int):
        self.n = len(z)
        names = np.unique(z, return_inverse=True)[1]
        self.levels = [names.astype(np.int32)]
        width = 1
        while 2 * width <= longest:
            names = np.unique(names[:-width] * (self.n + 1) + names[width:], return_inverse=True)[1]
            self.levels.append(names.astype(np.int32))
            width *= 2

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Entries that agree from ``a`` and from ``b`` > ``a`` on."""
        far = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            names, width = self.levels[k], 1 << k
            at = np.flatnonzero(b + far + width <= self.n)
            far[at[names[a[at] + far[at]] == names[b[at] + far[at]]]] += width
        return far

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Entries that agree before ``a`` and before ``b`` > ``a``."""
        far = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            names, width = self.levels[k], 1 << k
            at = np.flatnonzero(a - far - width >= 0)
            far[at[names[a[at] - far[at] - width] == names[b[at] - far[at] - width]]] += width
        return far


def find_runs(x: np.ndarray, doc: np.ndarray, exponent: int = EXPONENT, shortest: int = SHORTEST) -> np.ndarray:
    """Rows (start, length, period), by start and period, of the runs in ``x``; none goes over the end of a ``doc``.

    ``x`` numbers the words of all texts from 0, ``doc`` says which text a word is of. A run has at least ``exponent`` (2 or
    more) periods and ``shortest`` words.
    """
    none = np.zeros((0, 3), np.int64)
    place, part = stretches(x, doc, exponent, shortest)
    if not len(place):
        return none
    # one separator after each stretch
    at = np.arange(len(place)) + part
    kinds, y = np.unique(x[place], return_inverse=True)
    flat = np.full(len(place) + part[-1] + 1, -1, np.int64)
    flat[at] = y
    gaps = np.flatnonzero(flat < 0)
    apart = flat.copy()
    apart[gaps] = -1 - np.arange(len(gaps))
    reach = Extensions(apart, int(np.bincount(part).max()))
    found = []
    for turned in (False, True):
        order = np.where(flat < 0, -1, len(kinds) - 1 - flat) if turned else flat
        i, q = at, lyndon_lengths(order)[at]
        some = (apart[i] == apart[i + q]) | (apart[i - 1] == apart[i - 1 + q])
        i, q = i[some], q[some]
        back = reach.backward(i, i + q)
        found.append(np.stack([i - back, back + q + reach.forward(i, i + q), q], axis=1))
    runs = np.concatenate(found)
    runs = runs[runs[:, 1] >= np.maximum(shortest, exponent * runs[:, 2])]
    if not len(runs):
        return none
    runs = np.unique(runs, axis=0)
    whole = np.full(len(flat), -1, np.int64)
    whole[at] = place
    runs[:, 0] = whole[runs[:, 0]]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _collapsed(exponent: int, shortest: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = pa.compute.binary_length(b.column(1)).to_numpy(zero_copy_only=False)
            chunk = np.cumsum(sizes.astype(np.int64)) // CHUNK
            for at in np.split(np.arange(b.num_rows), np.flatnonzero(np.diff(chunk)) + 1):
                if len(at):
                    yield _batch(b.slice(at[0], len(at)), exponent, shortest)
    return run


def _batch(b: pa.RecordBatch, exponent: int, shortest: int) -> pa.RecordBatch:
    number = defaultdict(count().__next__)
    texts = [t.encode().split() for t in b.column(1).to_pylist()]
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    total = int(ends[-1])
    x = np.fromiter((number[w] for t in texts for w in t), np.int64, total)
    runs = find_runs(x, np.repeat(np.arange(len(texts)), sizes), exponent, shortest)
    # words in a run after its first period
    change = np.zeros(total + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    stays = np.cumsum(change[:-1]) == 0
    cuts = np.searchsorted(runs[:, 0], ends)
    starts, lo, out, listed = ends - sizes, 0, [], []
    for i, words in enumerate(texts):
        mine = runs[lo:cuts[i]]
        lo = cuts[i]
        if len(mine):
            words = [words[j] for j in np.flatnonzero(stays[starts[i]:ends[i]])]
        out.append(b" ".join(words).decode())
        listed.append([{"start": s - starts[i], "length": n, "period": q} for s, n, q in mine])
    return pa.RecordBatch.from_arrays(
        [b.column(0), pa.array(sizes), pa.array(listed, pa.list_(pa.struct(
            [("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))), pa.array(out, pa.string())],
        names=["doc_id", "n_words", "runs", "collapsed"])


def collapse(docs: DataFrame, exponent: int = EXPONENT, shortest: int = SHORTEST) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and collapsed for each row of ``docs``.

    Words are what stands between spaces, tabs, line feeds, vertical tabs, form feeds and returns, numbered from 0. A run
    is a stretch of words with smallest period q, at least ``exponent`` (2 or more) periods and ``shortest`` words long,
    that no neighbouring word extends. ``collapsed`` holds, joined by one space, the words that no run contains after its
    first period. A null text is an empty one: no words, no runs, an empty text. Every row is taken by itself, so
    repeated rows, repeated and null ids give a row each; other columns are not read; an empty table gives an
    empty result. Texts are never cut; a task's memory grows with its longest text.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(
        _collapsed(exponent, shortest), f"doc_id {kind}, n_words long, runs {RUNS}, collapsed string")


def _repeated(words: Column, n: Column, h: Column) -> Column:
    """The text whose words repeat from a place on, as the hash says."""
    g = F.floor(h / 10)
    a = F.pmod(g, n).cast("int")
    p = (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).cast("int")
    cycle = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    return F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(cycle, F.lit(1), n - a)), " ")


def with_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text, where one text in ten (by the crc32 of its id) repeats a stretch of its words to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = words_of(text_of())
    n = F.size(words)
    return docs.select("doc_id", F.when((F.pmod(h, F.lit(10)) == 0) & (n > 0), _repeated(words, n, h))
                       .otherwise(text_of()).alias("text"))


def digests(collapsed: DataFrame) -> DataFrame:
    """doc_id, n_words, n_runs, the run of greatest exponent, and digests of all runs and of the collapsed text."""
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda b, r: F.when(
        r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    return collapsed.select("*", best.alias("_best")).select(
        "doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"),
        F.col("_best.start").alias("start"), F.col("_best.length").alias("length"), F.col("_best.period").alias("period"),
        F.floor(1000 * F.col("_best.length") / F.col("_best.period")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))

"""Toxicity by class-conditional Kneser-Ney models.

Both classes, toxic and ordinary, get an interpolated Kneser-Ney model of words. A word's count in a class is its
continuation count, the number of distinct words it follows there; an absolute discount below 1 is taken
from every count, and what the discounts free goes to the backoff: words back off to their stems (first letters), with
continuation counts of their own, and stems to counts shared by all documents::

    P(word)  = max(c(word) - D, 0) / N  + D * types / N * P(stem) * shared(word | stem)
    P(stem)  = max(c(stem) - D, 0) / N' + D * types' / N' * shared(stem)

A word neither class has seen has the same ratio of likelihoods whatever it is; a word's evidence is what its
ratio exceeds that by, below 0 if it falls short. A text is judged by two figures, on a logistic scale fitted to labelled
rows that no count has seen: the difference of its log-likelihoods over all its words, divided by their number, and
what its ``TOP`` most telling words say. In the first one alone a few words of a long text drown (README, with figures).

All labelled rows take part, one in five in the scale, the others in the counts; the shared counts and the
scoring cover all documents. Labels are learnt only from rows whose crc32(doc_id as text) mod 3 is not 1.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from heapq import nlargest

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import sized, small, store

#: One labelled row in so many fits the scale, the others are counted.
SCALE_SHARE = 5
#: The discount, and the part of the shared distributions that is uniform.
DISCOUNT, UNIFORM = 0.95, 0.9
#: Most telling words of a text that are looked at by themselves.
TOP = 3
STEM = 5
THRESHOLD = 0.7
#: Distinct words a task counts before it passes them on, and words whose evidence a task keeps.
FLUSH, CACHED = 400_000, 400_000
_WORD = re.compile(r"\w+")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def stem_of(word: str) -> str:
    """The word's stem, marked so that it differs from every word; a short word is its own."""
    return word[:STEM] + "*" if len(word) > STEM else word


def stem(word: Column) -> Column:
    """``stem_of`` as a column."""
    return F.when(F.length(word) > STEM, F.concat(F.substring(word, 1, STEM), F.lit("*"))).otherwise(word)


def _shared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n: Counter = Counter()

    def emit():
        return pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], names=["word", "n"])

    for b in batches:
        for t in b.column(0):
            n.update(set(_WORD.findall(t.as_py().lower())))
            if len(n) >= FLUSH:
                yield emit()
                n.clear()
    if n:
        yield emit()


def _follows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct (word before, word) of every text; the word before the first one is empty."""
    for b in batches:
        for toxic, t in zip(b.column("toxic").to_pylist(), b.column("text").to_pylist(), strict=True):
            w = _WORD.findall(t.lower())
            pairs = set(zip(["", *w], w))
            yield pa.RecordBatch.from_arrays(
                [pa.array([toxic] * len(pairs), pa.int32()), pa.array([v for v, _ in pairs], pa.string()),
                 pa.array([x for _, x in pairs], pa.string())], names=["toxic", "before", "word"])


def shared_counts(docs: DataFrame) -> DataFrame:
    """word, n: the documents of ``docs`` (text) each word is in."""
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(_shared, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _continuations(pairs: DataFrame, key: str) -> DataFrame:
    """key, t and o: the distinct words before it in toxic and in ordinary texts, from distinct (toxic, before, key)."""
    return pairs.groupBy(key).agg(
        F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("o"))


def _weights(counts: DataFrame) -> dict[str, tuple[float, float]]:
    """For each class the sum of its counts, and the weight of its backoff."""
    r = counts.agg(*(f(c).alias(f"{n}_{c}") for c in "to" for n, f in (
        ("sum", F.sum), ("types", lambda c: F.count_if(F.col(c) > 0))))).first()
    return {c: (float(r[f"sum_{c}"]), DISCOUNT * r[f"types_{c}"] / r[f"sum_{c}"]) if r[f"sum_{c}"] else (0.0, 1.0) for c in "to"}


def evidence(counted: DataFrame, shared: DataFrame) -> DataFrame:
    """key and value of the words and stems of both classes, above 0 if they lean to the toxic one.

    ``counted``: toxic, text; ``shared``: word, n for all their words. Nothing is listed unless both classes have words.
    """
    pairs = store(counted.select("toxic", "text").mapInArrow(_follows, "toxic int, before string, word string").distinct(), "follows")
    words = store(_continuations(pairs, "word"), "words")
    stems = store(_continuations(pairs.select("toxic", "before", stem(F.col("word")).alias("stem")).distinct(), "stem"), "stems")
    all_stems = store(shared.groupBy(stem(F.col("word")).alias("stem")).agg(F.sum("n").alias("sn"), F.count("*").alias("members")),
                      "shared-stems")
    size = all_stems.agg(F.sum("sn").alias("n"), F.count("*").alias("stems")).first()
    by_word, by_stem = _weights(words), _weights(stems)
    if not (by_word["t"][0] and by_word["o"][0]):
        return words.where("false").select(F.col("word").alias("key"), F.lit(0.0).alias("value"))

    def p(c, weights, back):
        n, left = weights[c]
        return F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / n + left * back

    share = (1 - UNIFORM) * F.col("sn") / size["n"] + UNIFORM / size["stems"]
    s = stems.join(all_stems, "stem").select(
        "stem", "sn", "members", *(p(c, by_stem, share).alias(f"p_{c}") for c in "to"))
    none = math.log(by_word["t"][1] * by_stem["t"][1] / (by_word["o"][1] * by_stem["o"][1]))
    unseen = math.log(by_word["t"][1] / by_word["o"][1])
    s = s.withColumn("stem_value", unseen + F.log(F.col("p_t") / F.col("p_o")) - none)
    share = (1 - UNIFORM) * F.col("n") / F.col("sn") + UNIFORM / F.col("members")
    ratio = F.log(p("t", by_word, F.col("p_t") * share) / p("o", by_word, F.col("p_o") * share))
    w = words.join(shared, "word").withColumn("stem", stem(F.col("word"))).join(s, "stem").select(
        F.col("word").alias("key"), (ratio - none).alias("value"))
    return w.unionByName(s.where("endswith(stem, '*')").select(F.col("stem").alias("key"), F.col("stem_value").alias("value")))


def _hash(key: str) -> int:
    """What Spark's xxhash64 gives."""
    return xxhash.xxh64_intdigest(key.encode(), 42)


class Model:
    """Evidence of words and stems, and the logistic scale.

    Keys are held as hashes of 64 bits, in order: 16 bytes for a word or stem of the labelled rows.
    """

    def __init__(self, values: dict[str, float] | None = None, hashes: np.ndarray | None = None, told: np.ndarray | None = None):
        if values is not None:
            hashes = np.array([_hash(k) for k in values], np.uint64)
            told = np.array(list(values.values()), float)
        order = np.argsort(hashes)
        self.hashes, self.told, self.seen = hashes[order], told[order], {}
        self.slopes, self.offset = (0.0, 0.0), -1.0

    def _value(self, key: str) -> float | None:
        h = np.uint64(_hash(key))
        at = int(np.searchsorted(self.hashes, h))
        return float(self.told[at]) if at < len(self.hashes) and self.hashes[at] == h else None

    def _values(self, text: str) -> list[float]:
        """The evidence of every word of the text, 0 for one that neither class knows."""
        seen, found = self.seen, []
        for w in _WORD.findall(text.lower()):
            v = seen.get(w)
            if v is None:
                if len(seen) >= CACHED:
                    seen.clear()
                v = self._value(w)
                if v is None and len(w) > STEM:
                    v = self._value(stem_of(w))
                v = seen[w] = v or 0.0
            found.append(v)
        return found

    @staticmethod
    def _telling(found: list[float]) -> float:
        return math.fsum(nlargest(TOP, (v for v in found if v > 0))) / TOP

    def evidence(self, text: str) -> float:
        """Mean evidence of the ``TOP`` most telling words; words a short text lacks say nothing."""
        return self._telling(self._values(text))

    def figures(self, text: str) -> tuple[float, float]:
        """The difference of log-likelihoods over all words, divided by their number, and ``evidence``."""
        found = self._values(text)
        return math.fsum(found) / len(found) if found else 0.0, self._telling(found)

    def score(self, text: str) -> float:
        x = sum(s * v for s, v in zip(self.slopes, self.figures(text), strict=True)) + self.offset
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, x))))

    def calibrate(self, fit: DataFrame) -> None:
        """Logistic regression of the labels on both figures, with a weak prior on the slopes; neither may be negative.

        ``fit``: toxic, x0, x1, stored. Every Newton step is one fold of it; sums are of whole billionths, so the
        order of rows does not matter.
        """
        n, toxic = fit.agg(F.count("*"), F.sum("toxic")).first()
        if not n:
            return
        share = (toxic + 0.5) / (n + 1)
        used = [0, 1]
        while True:
            beta = self._newton(fit, used, math.log(share / (1 - share)))
            if all(b >= 0 for b in beta[:-1]):
                break
            used.pop(int(np.argmin(beta[:-1])))
        self.slopes, self.offset = tuple(float(beta[used.index(i)]) if i in used else 0.0 for i in (0, 1)), float(beta[-1])

    @staticmethod
    def _newton(fit: DataFrame, used: list[int], start: float) -> np.ndarray:
        x = [*(F.col(f"x{i}") for i in used), F.lit(1.0)]
        k = len(x)
        beta, prior = np.array([*([1.0] * len(used)), start]), np.full(k, 0.001)
        for _ in range(50):
            z = sum((float(b) * c for b, c in zip(beta, x, strict=True)), F.lit(0.0))
            rows = fit.withColumn("p", 1 / (1 + F.exp(-F.greatest(F.lit(-50.0), F.least(F.lit(50.0), z)))))
            p = F.col("p")
            terms = [p * (1 - p) * x[i] * x[j] for i in range(k) for j in range(i, k)] + [(F.col("toxic") - p) * c for c in x]
            got = [float(v or 0) / 1e9 for v in rows.agg(*(F.sum(F.round(t * 1e9).cast("decimal(28,0)")) for t in terms)).first()]
            a = np.zeros((k, k))
            a[np.triu_indices(k)] = got[:-k]
            a = a + np.triu(a, 1).T + np.diag(prior)
            step = np.linalg.solve(a, np.array(got[-k:]) - prior * beta)
            beta = beta + np.clip(step, -4, 4)
            if abs(step).max() < 1e-7:
                break
        return beta


def _figures(model: Model):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [model.figures(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("toxic"), *(pa.array([v[i] for v in x], pa.float64()) for i in (0, 1))], names=["toxic", "x0", "x1"])
    return run


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit the models and the scale; see the module's text. ``docs``: doc_id, text; ``labels``: doc_id, toxic.

    A doc_id labelled several times is toxic if any row says so. Null labels and ids teach nothing. Texts that are equal
    count once. Without toxic or without ordinary rows the models say nothing.
    """
    known = (labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic")))
    known = store(known.select("doc_id", "toxic", F.xxhash64("doc_id", F.lit("sample")).alias("o")), "known")
    texts = docs.where("doc_id is not null").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(small(known), "doc_id")
    texts = store(texts.groupBy("toxic", "text").agg(F.min("o").alias("o")), "labelled")
    scale = F.pmod("o", F.lit(SCALE_SHARE)) == 0
    told = evidence(texts.where(~scale), store(shared_counts(docs), "shared"))
    told = told.select(F.xxhash64("key").alias("h"), "value").toArrow()
    model = Model(hashes=told["h"].to_numpy().view(np.uint64), told=told["value"].to_numpy())
    model.calibrate(sized(store(texts.where(scale).select("toxic", "text").mapInArrow(
        _figures(model), "toxic int, x0 double, x1 double"), "fit")))
    return model


def _score(model: Model):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = [model.score(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(s, pa.float64()),
                 pa.array([int(v >= THRESHOLD) for v in s], pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"])
    return run


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (score of 0.7 and more) for each row of ``docs``.

    Null and empty texts have no evidence and get the scale's value for none. A null doc_id is not held out.
    Repeated rows are scored one by one, other columns are not read, an empty table gives an empty result.
    """
    model = train(docs, labels)
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        _score(model), "doc_id long, held_out boolean, score double, predicted int")

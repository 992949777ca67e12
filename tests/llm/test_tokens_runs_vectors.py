"""Runs, word BPE and whitening against plain versions."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from procmetrics.llm import periodic, queries, whitening, wordbpe

SMALL = "/root/testdata/sf0.001"


def sha(b):
    return hashlib.sha256(b).hexdigest()


def plain_runs(w, exponent, shortest):
    out, n = set(), len(w)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            size = i + q - s
            if size >= max(shortest, exponent * q) and not any(
                    all(w[s + t] == w[s + t + p] for t in range(size - p)) for p in range(1, q)):
                out.add((s, size, q))
    return sorted(out)


def plain_row(doc_id, text, plant=True):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if plant and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w, 4, 6)
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    return (doc_id, n, len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{size},{q}\n" for s, size, q in runs).encode()),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone).encode()))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=40), max_size=4), st.sampled_from([(2, 2), (3, 5), (4, 6)]))
def test_runs_by_lyndon_roots(docs, least):
    x = np.array([w for d in docs for w in d], np.int64)
    got = periodic.find_runs(x, np.repeat(np.arange(len(docs)), [len(d) for d in docs]), *least)
    want, at = [], 0
    for d in docs:
        want += [(s + at, n, q) for s, n, q in plain_runs(d, *least)]
        at += len(d)
    assert [tuple(r) for r in got.tolist()] == sorted(want)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=40))
def test_lyndon_lengths(y):
    got = periodic.lyndon_lengths(np.array(y, np.int64))
    for i in range(len(y)):
        j = i + 1
        while j < len(y) and y[j:] > y[i:]:
            j += 1
        assert got[i] == j - i


def test_runs_query_equals_plain_version(spark):
    docs = queries.documents(spark, SMALL).select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r) for r in queries.op11_baier_runs(spark, SMALL).collect()}
    assert len(got) == len(docs)
    for d in docs:
        if len((d.text or "").split()) < 3000:
            assert got[d.doc_id] == plain_row(d.doc_id, d.text)
    assert sum(r[2] > 0 for r in got.values()) > 5


def test_runs_of_awkward_rows(spark, hard, odd, empty):
    for docs in (hard, odd):
        rows = docs.select("doc_id", "text").collect()
        got = periodic.digests(periodic.collapse(periodic.with_repeats(docs))).collect()
        short = [r for r in rows if len((r.text or "").split()) < 3000]
        left = [tuple(g) for g in got]
        assert len(got) == len(rows)
        for r in short:
            left.remove(plain_row(*r))
    long = next(t for t in (r.text for r in hard.collect()) if t and len(t.split()) > 20_000)
    words = long.split()
    one = spark.createDataFrame([(1, " ".join(words * 5 + ["end"]))], "doc_id long, text string")
    out = periodic.collapse(one).first()
    assert [tuple(r) for r in out.runs] == [(0, 5 * len(words), len(words))]
    assert out.collapsed == " ".join([*words, "end"])
    assert periodic.digests(periodic.collapse(periodic.with_repeats(empty))).collect() == []


def tokenizer():
    import public_tokenizers
    import tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return path, tokenizers.Tokenizer.from_file(path)


def library_row(lib, doc_id, text):
    ids = lib.encode(text or "", add_special_tokens=False).ids
    return (doc_id, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(lib.decode(ids, skip_special_tokens=False).encode()))


@pytest.fixture(scope="module")
def bpe():
    path, lib = tokenizer()
    return wordbpe.WordBpe(path), lib


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.one_of(
    st.text(max_size=30), st.text("aAbB'sS1 <|endoftext|>\x1c\x85　éÉΣς́\n", max_size=60),
    st.text("ab", max_size=200)), max_size=5))
def test_bpe_equals_library(bpe, texts):
    ours, lib = bpe
    for (packed, decoded), text in zip(ours.encode_batch(texts), texts, strict=True):
        ids = lib.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(packed, "<u4").tolist() == ids
        assert decoded.decode() == ours.decode(packed) == lib.decode(ids, skip_special_tokens=False)


def test_bpe_without_room_in_the_cache(bpe, monkeypatch):
    ours, lib = bpe
    monkeypatch.setattr(wordbpe, "CACHED", 5)
    for text in ("one two three four", "five six seven one", "x" * 200 + " one", "a b c d e f g h"):
        assert np.frombuffer(ours.encode_batch([text])[0][0], "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids


def test_bpe_query_equals_library(spark, hard, odd, empty):
    path, lib = tokenizer()
    want = sorted((library_row(lib, r.doc_id, r.text) for r in queries.documents(spark, SMALL).collect()), key=str)
    assert sorted((tuple(r) for r in queries.op12_word_bpe(spark, SMALL).collect()), key=str) == want
    for docs in (hard, odd):
        got = wordbpe.encode(docs.withColumnRenamed("kept", "decoded"), path)
        assert {*docs.columns} - {"kept"} | {"token_ids", "decoded"} == set(got.columns)
        assert sorted((tuple(r) for r in wordbpe.digests(got).collect()), key=str) == sorted(
            (library_row(lib, r.doc_id, r.text) for r in docs.collect()), key=str)
    assert wordbpe.encode(empty, path).collect() == []


def plain_whitening(rows, top=16):
    x = {i: (np.floor(64 * np.array(v, float)) + 1_000_000).astype(int) for i, v in rows}
    fit = np.array(sorted({tuple(v) for v in x.values()}))
    n, sums = len(fit), fit.sum(axis=0)
    c = fit - sums / n
    values, axes = np.linalg.eigh(c.T @ c / n)
    values, axes = values[::-1], axes[:, ::-1]
    some = min(top, int((values > 1e-9 * values[0]).sum()))
    return {i: (n, int(((n * v - sums).astype(object) ** 2).sum()), (v - sums / n) @ axes[:, :some] / np.sqrt(values[:some])) for i, v in x.items()}, \
        values[:some] / values.sum()


def check_whitening(got, rows, top=16):
    want, explained = plain_whitening(rows, top)
    assert len(got) == len(rows) * len(explained)
    signs = {}
    for g in got:
        n, deviation, w = want[g.vec_id]
        assert (g.n, g.deviation) == (n, deviation)
        assert g.explained == pytest.approx(explained[g.component - 1], rel=1e-9)
        assert abs(abs(g.whitened) - abs(w[g.component - 1])) < 1e-7
        if abs(g.whitened) > 1e-3:
            signs.setdefault(g.component, set()).add(g.whitened * w[g.component - 1] > 0)
        assert g.identity_error < 1e-9
    assert all(len(s) == 1 for s in signs.values())


def test_whitening_query_equals_plain_version(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    check_whitening(queries.op13_jacobi_davidson(spark, SMALL).collect(), rows)


def test_whitening_of_awkward_vectors(spark):
    r = random.Random(4)
    rows = [(i, [r.gauss(0, 1 + j) for j in range(7)]) for i in range(300)]
    rows += [(i, [0.5] * 7) for i in range(300, 900)]  # a hot vector
    bad = [(1000, None), (1001, []), (1002, [1.0, None] + [0.0] * 5), (1003, [float("nan")] * 7), (1004, [float("inf")] * 7),
           (1005, [1.0, 2.0])]
    schema = "vec_id long, embedding array<double>, x int, n string"
    some = spark.createDataFrame([(*v, 0, "c") for v in rows + bad], schema)
    check_whitening(whitening.whiten(some).collect(), rows)
    again = whitening.whiten(some.where("vec_id is not null").unionByName(some.where("vec_id < 3")).unionByName(
        spark.createDataFrame([(None, [1.0] * 7, 0, "")], schema)))
    assert again.where("vec_id = 2").count() == 14 and again.where("vec_id is null").count() == 7
    # one vector, two vectors, none
    assert whitening.whiten(some.where("vec_id >= 300")).collect() == []
    check_whitening(whitening.whiten(some.where("vec_id in (1, 2, 1000)")).collect(), rows[1:3])
    assert whitening.whiten(some.where("false")).collect() == []
    far = spark.createDataFrame([(1, [1e30], 0, ""), (2, [0.0], 0, "")], schema)
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(far).collect()

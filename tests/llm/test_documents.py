"""Document operators against plain versions, on awkward texts and on the smallest tables."""

import hashlib
import os

import brute
import pyarrow as pa
import pytest


from procmetrics.llm import lines, linking, mixing, neardup, phrases, pieces, quality, sharding
from procmetrics.llm.queries import model_path

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").limit(10_000)


def rows_of(df, *cols):
    return [tuple(r) for r in df.select(*(cols or ("doc_id", "text"))).collect()]


def test_near_duplicates(hard):
    docs = hard
    assert dict(rows_of(neardup.classes(docs), "doc_id", "class_id")) == brute.near_classes(rows_of(docs))


def test_moved_blocks_are_not_near_duplicates():
    a = [str(i) for i in range(400)]
    assert neardup.similarity(a, a[200:] + a[:200]) == 0.0
    assert neardup.similarity(a, a[:100] + ["x"] + a[100:]) == pytest.approx(400 / 401)


def test_alignment_equals_the_table():
    import random

    r = random.Random(5)
    for _ in range(300):
        a = [r.randrange(6) for _ in range(r.randrange(1, 40))]
        b = [x for x in a if r.random() > 0.1]
        b = [r.randrange(6) if r.random() < 0.05 else x for x in b] or [0]
        k = brute.common(a, b)
        s = k / (len(a) + len(b) - k)
        assert neardup.similarity(a, b) == (pytest.approx(s) if s >= 0.8 else 0.0)


def test_appended_text_with_an_unlucky_bit_pattern_is_near(spark):
    import numpy as np

    hashed, rolling = neardup.Words(), neardup.Rolling()

    def share(words):
        one, two = (neardup.pattern(neardup.labelled(neardup.shingles_of([x.encode() for x in w], hashed, rolling))) for w in (words[:404], words))
        count = lambda f: sum(int(np.bitwise_count(np.uint64(f(x, y) & (2**64 - 1)))) for x, y in zip(one, two, strict=True))
        return count(lambda x, y: x & y) / count(lambda x, y: x | y)

    texts = ([f"s{seed}w{i}" for i in range(500)] for seed in range(20_000))
    unlucky = next(w for w in texts if share(w) < 0.5)
    docs = spark.createDataFrame([(0, " ".join(unlucky[:404])), (1, " ".join(unlucky))], "doc_id long, text string")
    assert dict(rows_of(neardup.classes(docs), "doc_id", "class_id")) == brute.near_classes(rows_of(docs)) == {0: 0, 1: 0}


def test_every_text_of_a_repeated_id_is_compared(spark):
    texts = [[f"t{i}w{j}" for j in range(200)] for i in range(6)]
    # every text of id 0 has a near copy of its own, and copies come before and after it
    rows = [(0, " ".join(t)) for t in texts] + [(i + 1, " ".join([*t, "end"])) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert dict(rows_of(neardup.classes(docs), "doc_id", "class_id")) == dict.fromkeys(range(7), 0)


def test_the_prefix_filter_keeps_sets_that_hold_each_other(spark):
    from pyspark.sql import functions as F

    from procmetrics.llm.linking import _rarest_in_common

    # 60 pairs of 800 tokens and the same with 200 more: similarity 0.8
    rows = spark.range(60 * 1000).selectExpr("id div 1000 as p", "id % 1000 as i", "id as token")
    tokens = rows.selectExpr("2 * p as node", "token").unionByName(rows.where("i < 800").selectExpr("2 * p + 1 as node", "token"))
    nodes = spark.range(120).selectExpr("id as node", "id as root", "struct(id) as about")
    pairs = _rarest_in_common(tokens, nodes, lambda x, y: F.lit(True), 0.8)
    assert sorted(tuple(r) for r in pairs.collect()) == [(2 * p + 1, 2 * p) for p in range(60)]


@pytest.mark.parametrize("name", ["hard", "odd", "small"])
def test_repeated_phrases(request, name):
    docs = request.getfixturevalue(name)
    got = rows_of(phrases.removals(docs), "doc_id", "n_words", "n_removed", "kept_sha256")
    key = lambda r: (r[0] is not None, r)
    assert sorted(got, key=key) == sorted(brute.removals(rows_of(docs)), key=key)


def test_small_shards_give_the_same_removals(hard):
    want = rows_of(phrases.removals(hard), "doc_id", "n_removed", "kept_sha256")
    got = rows_of(phrases.removals(hard, shard_phrases=3), "doc_id", "n_removed", "kept_sha256")
    assert sorted(got) == sorted(want)


def test_automata_alone_tell_where_phrases_stand():
    words = [b"w%d" % (i % 130) for i in range(400)]
    phrase = b" ".join(words[70:80]).decode()
    starts = phrases.locate(phrases.automaton_of([phrase]), words)
    places = [i for i in range(391) if words[i:i + 10] == words[70:80]]
    assert places == [70, 200, 330]
    assert starts.tolist() == [s for s in range(351) if any(s <= p <= s + 40 for p in places)]
    assert phrases.locate(phrases.automaton_of([phrase[1:]]), words).tolist() == []

    text, key = b" ".join(words).decode(), phrases.text_key(hashlib.sha256(b" ".join(words)).digest())

    def found(*rows):
        batch = pa.RecordBatch.from_pylist(
            [dict(zip(("shard", "doc_id", "text_key", "text"), r, strict=True)) for r in rows],
            pa.schema([("shard", pa.int32()), ("doc_id", pa.int64()), ("text_key", pa.int64()), ("text", pa.string())]))
        return [(d, s) for b in phrases._windows([batch]) for d, s in zip(b["doc_id"].to_pylist(), b["start"].to_pylist(), strict=True)]

    assert found((0, None, None, phrase), (0, 5, key, text), (1, None, None, "not there"), (1, 6, key, text)) == [
        (5, s) for s in starts]
    assert found((0, 5, key, text)) == []


def test_fuzzy_lines_of_a_table(small):
    want = {i: brute.sha(t.encode()) for i, t in brute.line_cuts(rows_of(small))}
    assert dict(rows_of(lines.dedup_digests(small), "doc_id", "kept_sha256")) == want


def test_short_lines_and_lines_of_few_tokens_meet(spark):
    base = ["subscribe_to_our_newsletter_for_more", "https://example.com/a/rather/long/path/to/some/page.html", "Zeile eins, kurz und gut gesagt"]
    rows = [(i, t, t[1:] + "s") for i, t in enumerate(base)]
    rows = [(2 * i + k, t) for i, *pair in rows for k, t in enumerate(pair)]
    got = dict(rows_of(lines.dedup_digests(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id", "n_removed"))
    assert got == {i: int(not t) for i, t in brute.line_cuts(rows)}
    assert sum(got.values()) == 3


def test_repetitive_lines_of_different_lengths_are_one(spark):
    rows = [(0, "-" * 20), (1, "-" * 60), (2, "-----"), (3, "one phrase again, " * 3), (4, "one phrase again, " * 12)]
    got = dict(rows_of(lines.dedup_digests(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id", "n_removed"))
    assert got == {i: int(not t) for i, t in brute.line_cuts(rows)} == {0: 0, 1: 1, 2: 1, 3: 0, 4: 1}


def test_prefix_filter_stores_no_row_for_each_token_and_keeps_no_prefixes(spark, monkeypatch):
    crowd = {i: {*range(150), *range(1000 * i, 1000 * i + 50)} for i in range(1, 40)}
    near = {100 + i: crowd[i] - {3, 4} | {-i} for i in range(1, 10)}
    sets = crowd | near
    rows = spark.createDataFrame([(i, sorted(t)) for i, t in sets.items()], "node long, tokens array<long>")
    nodes = spark.createDataFrame([(i, i, len(t)) for i, t in sets.items()], "node long, root long, about long")
    stored, write = {}, linking.store

    def counted(df, label):
        out = write(df, label)
        stored[label] = (out.count(), out.inputFiles())
        return out

    monkeypatch.setattr(linking, "store", counted)
    tokens = rows.repartition(3, "node").selectExpr("node", "explode(tokens) as token")
    found = linking._rarest_in_common(tokens, nodes, lambda x, y: x.isNotNull() & y.isNotNull(), 0.8)
    pairs = {(r.a, r.b) for r in found.collect()}
    assert {(a, b) for a in sets for b in sets if a > b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])} <= pairs
    assert len(pairs) < 100
    assert max(n for n, _ in stored.values()) < sum(map(len, sets.values())) / 2
    assert not os.path.exists(stored["prefixes"][1][0].removeprefix("file://"))


def test_line_keys_are_discarded(spark, small, monkeypatch):
    files, write = {}, lines.store

    def seen(df, label):
        out = write(df, label)
        files[label] = [f.removeprefix("file://") for f in out.inputFiles()]
        return out

    monkeypatch.setattr(lines, "store", seen)
    lines.removed_lines(small)
    assert files["signed-keys"] and not any(map(os.path.exists, files["signed-keys"]))
    assert all(map(os.path.exists, files["signed"]))


def test_line_dedup_returns_documents(hard):
    kept = lines.dedup(hard)
    out = {r.doc_id: r for r in kept.collect()}
    texts = dict(rows_of(hard))
    want = {i: t for i, t in brute.line_cuts(rows_of(hard)) if t.encode().split() or not (texts[i] or "").encode().split()}
    assert set(out) == set(want)
    assert kept.columns == hard.columns
    for i, r in out.items():
        assert (r.text or "") == want[i] and r._row == "r" and r.kept == "k"
        assert r.n_chars == len(r.text or "")


@pytest.mark.parametrize("name", ["hard", "odd", "small"])
def test_piece_encoding_equals_the_library(request, name):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=model_path())
    docs = request.getfixturevalue(name)
    want = []
    for i, t in rows_of(docs):
        ids = lib.encode(t or "")
        want.append((i, len(ids), brute.sha(",".join(map(str, ids)).encode()), brute.sha(lib.decode(ids).encode())))
    key = lambda r: (r[0] is not None, r)
    assert sorted(rows_of(pieces.encode_digests(docs, model_path()), "*"), key=key) == sorted(want, key=key)


def test_token_ids_come_back(hard):
    out = pieces.encode(hard, model_path())
    assert out.columns == [*hard.columns, "token_ids"]
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=model_path())
    for r in out.collect():
        assert r.token_ids == lib.encode(r.text or "")


def test_quality_counts(hard):
    got = {r.doc_id: r for r in quality.judge(hard).collect()}
    for i, t in rows_of(hard):
        n = brute.counts(t)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n[:5]
        assert r.base_failed == (n[0] < 50 or 100 * n[4] > 50 * n[0])
        assert not (r.kept and r.base_failed)


def test_a_bad_host_loses_its_failing_documents_only(spark):
    good = " ".join(f"word{i}" for i in range(80))
    noisy = good + " #### **** $$$$" * 4
    rows = [(i, noisy if i % 10 else good, "bad") for i in range(60)]
    rows += [(100 + i, noisy if i == 0 else good, f"h{i % 6}") for i in range(60)] + [(999, noisy, None)]
    got = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[1].host_rejected and not got[1].kept
    assert got[10].host_rejected and got[10].kept
    assert got[100].kept and got[999].kept


def test_shards(hard, odd):
    rows = sharding.assign(hard, slot_rows=2).collect()
    by = {}
    for r in rows:
        assert r.law == "key" and r.grown_shard in (r.shard, 40) and 0 <= r.shard < 40
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    texts = dict(rows_of(hard))
    import zlib

    for r in rows:
        b = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(b) + 16, zlib.crc32(b))
    got = sharding.assign(odd).collect()
    assert len(got) == odd.count()
    assert len({(r.doc_id, r.shard) for r in got}) == len({r.doc_id for r in got})


@pytest.mark.parametrize("name", ["hard", "odd"])
def test_winners_and_slots_equal_brute_force(request, name):
    docs = request.getfixturevalue(name)
    want = brute.shards(rows_of(docs), 40, 2)
    got = rows_of(sharding.assign(docs, slot_rows=2), "doc_id", "size", "text_crc32", "shard", "grown_shard", "slot")
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_shard_shares_follow_the_weights_and_growth_moves_few(spark):
    docs = spark.range(20_000).selectExpr("id as doc_id", "'t' as text")
    rows = sharding.assign(docs, shards=3, weights=[1, 2, 5]).collect()
    share = [sum(r.shard == i for r in rows) / len(rows) for i in range(3)]
    assert share == pytest.approx([1 / 8, 2 / 8, 5 / 8], abs=0.02)
    assert sum(r.grown_shard == 3 for r in rows) / len(rows) == pytest.approx(1 / 9, abs=0.02)
    more = {r.doc_id: r.shard for r in sharding.assign(docs, shards=4, weights=[1, 2, 5, 1]).collect()}
    assert all(more[r.doc_id] == r.grown_shard for r in rows)


def test_mixing(hard, odd):
    copies = brute.poisson_copies(rows_of(hard, "doc_id", "text", "source"))
    got, mixed = {}, mixing.mix(hard)
    for (i,) in rows_of(mixed, "doc_id"):
        got[i] = got.get(i, 0) + 1
    assert got == {i: n for i, n in copies.items() if n}
    assert mixed.columns == hard.columns
    assert mixing.mix(odd).count() >= 0


def test_mixing_meets_target_weights(spark):
    docs = spark.range(6_000).selectExpr("id as doc_id", "repeat('x', 20) as text", "if(id < 5000, 'big', 'small') as source")
    n = {r["source"]: r["count"] for r in mixing.mix(docs, weights={"big": 1, "small": 9}).groupBy("source").count().collect()}
    assert n["small"] / (n["small"] + n["big"]) == pytest.approx(0.9, abs=0.02)
    assert n["small"] + n["big"] == pytest.approx(6000, rel=0.05)


@pytest.mark.parametrize("run", [
    quality.judge, quality.filter_documents, neardup.classes, neardup.keep_one, phrases.removals, lines.dedup_digests,
    lines.dedup, sharding.assign, mixing.mix, lambda d: pieces.encode_digests(d, model_path())])
def test_empty_tables(empty, run):
    assert run(empty).collect() == []


def test_one_document_of_each_class_stays(odd):
    # id 1 stands for two texts, so both texts' documents are one class; null ids stay
    assert sorted(str(r.doc_id) for r in neardup.keep_one(odd).collect()) == ["1", "4", "None", "None"]

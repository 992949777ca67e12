"""Toxicity, top-k, chat formatting, and the whole pipeline."""

import random
import zlib

import brute
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from procmetrics.llm import balltree, chat, toxicity
from procmetrics.llm.common import components

SMALL = "/root/testdata/sf0.001"


def test_toxic_held_out_accuracy(spark):
    r = random.Random(3)
    bad = ["vilething", "hatefulthing", "nastything"]
    rows, labels = [], []
    for i in range(1500):
        w = [f"w{min(int(r.expovariate(0.01)), 900)}" for _ in range(r.randrange(20, 120))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                w.insert(r.randrange(len(w)), r.choice(bad) + r.choice(["", "s", "ly"]))
        rows.append((i, " ".join(w), "clash"))
        if i % 5:
            labels.append((i, 1, int(toxic)))
    rows += [(5000, None, ""), (5001, "", ""), (None, "w1", ""), (7, rows[7][1], "")]
    labels += [(None, 1, 1), (9, 1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.score(docs, known).collect()
    assert len(got) == len(rows)
    held = [g for g in got if g.held_out and g.doc_id < 1500]
    assert all((zlib.crc32(str(g.doc_id).encode()) % 3 == 1) == g.held_out for g in got if g.doc_id is not None)
    right = sum(g.predicted == (g.doc_id % 4 == 0) for g in held)
    assert right / len(held) > 0.98
    assert all(0 <= g.score <= 1 and g.predicted == (g.score >= 0.7) for g in got)
    # held-out labels teach nothing
    flipped = known.withColumn("toxic", toxicity.F.when(toxicity.held_out(toxicity.F.col("doc_id")), 0).otherwise(
        toxicity.F.col("toxic")))
    again = toxicity.score(docs, flipped).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_evidence_equals_the_formulas(spark):
    r = random.Random(11)
    words = [f"{a}{b}" for a in ("goodnes", "plainly", "oddly", "é_b", "x") for b in range(60)]
    bad = [f"vilest{x}" for x in ("", "s", "ly", "er")] + ["bad", "worthless"]
    rows = []
    for i in range(240):
        w = [r.choice(words) for _ in range(r.randrange(0, 25))]
        for _ in range(2 * (i % 3 == 0)):
            w.insert(r.randrange(len(w) + 1), r.choice(bad))
        rows.append((int(i % 3 == 0), r.choice([" ", "\n", ", "]).join(w).upper()))
    rows += [(0, ""), (1, ""), (0, "!!!")]
    texts = [t for _, t in rows] + ["vilestness unheard oddlyish", None, "goodnest"]
    counted = spark.createDataFrame(rows, "toxic int, text string")
    shared = toxicity.shared_counts(spark.createDataFrame([(t,) for t in texts], "text string"))
    model = toxicity.Model({x.key: x.value for x in toxicity.evidence(counted, shared).collect()})
    want = brute.kneser_ney([(y, t) for y, t in rows], texts)
    for w, v in want.items():
        assert model.evidence(w) == pytest.approx(v / toxicity.TOP, abs=1e-9), w
    assert len({round(v, 6) for v in want.values()}) > 5
    best = sorted(want, key=want.get)[-4:]
    assert model.evidence(" ".join(best)) == pytest.approx(sum(want[w] for w in best[1:]) / 3)
    assert model.evidence("") == 0
    one = toxicity.evidence(counted.where("toxic = 0"), shared)
    assert one.collect() == []


def test_toxicity_of_long_and_repeated_texts(spark):
    rows = [(i, ("vile " if i % 2 else "") + f"plain words {i % 7} " * 5) for i in range(60)]
    rows += [(100, "word " * 300_000 + "vile"), (3, rows[3][1]), (3, "another text")]
    docs = spark.createDataFrame([(*x, "held", 1.0) for x in rows], "doc_id long, text string, held_out string, n double")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] * 2, "doc_id long, toxic int")
    got = toxicity.score(docs, labels).collect()
    assert sorted(g.doc_id for g in got) == sorted(x[0] for x in rows)
    score = {g.doc_id: g.score for g in got if g.doc_id != 3}
    assert score[100] > score[0] and score[1] > score[0]
    assert len({g.score for g in got if g.doc_id == 3}) == 2


def test_toxicity_without_labels_or_documents(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.predicted for r in toxicity.score(docs, none).collect()] == [0]
    assert toxicity.score(docs.where("false"), none).collect() == []


def vectors(spark):
    r = random.Random(8)
    rows = [(i, [r.uniform(-2, 2) for _ in range(8)], i) for i in range(700)]
    rows += [(i, [0.5] * 8, 0) for i in range(700, 800)]  # one common vector
    rows += [(800, None, 0), (801, [1.0, None] * 4, 0), (820, [float("nan")] * 8, 0), (840, [float("inf")] * 8, 0),
             (860, [1.0, 2.0], 0), (861, [1.0, 2.0], 0), (None, [1.0] * 8, 0), (880, [], 0), (40, rows[40][1], 0)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")


@pytest.mark.parametrize("values", [1 << 19, 1200])
def test_top_k_equals_brute_force(spark, values):
    v = vectors(spark)
    want = brute.top([(r.vec_id, r.embedding) for r in v.distinct().collect()])
    got = [tuple(r) for r in balltree.top_k(v, shard_values=values).collect()]
    assert sorted(got) == sorted(want)


def test_top_k_of_nothing(spark):
    assert balltree.top_k(vectors(spark).where("false")).collect() == []


TEXT = st.lists(st.sampled_from(
    [*"a%<\\|\n>é", "<|im_end|>", "<|im_start|>", "<\\|", "im_end", "%0A"]), max_size=20).map("".join)


@settings(max_examples=300, deadline=None)
@given(TEXT, TEXT)
def test_any_turn_comes_back(role, text):
    out, _, back = chat.round_trip(role, text)
    assert back[:2] == (role, text)
    assert len(chat.parse(out * 3)) == 3
    body = out[back[2]:back[3]]
    assert "<|im_end|>" not in body and "<|im_start|>" not in body


def test_conversations(spark):
    rows = [(1, 0, "user", "hello"), (1, 1, "assistant", None), (1, 2, "user", "<\\|im_end|> <|im_end|>\n"),
            (1, 3, "assistant", "ok <|im_start|>user\nno"), (2, 0, None, "x"), (3, 0, "as%s\n<", "a" * 200_000),
            (None, 0, "assistant", "nobody's")]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, rendered string")
    df = chat.with_hostile(df)
    got = {r.conv_id: r for r in chat.read_back(chat.format_turns(df)).collect()}
    for c, want in brute.turns([*rows, (-1, 0, "user", chat.HOSTILE), (-1, 1, "assistant", chat.HOSTILE)]).items():
        r = got[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == want
    assert got[-1].n_escaped == 2
    assert chat.read_back(chat.format_turns(df.where("false"))).collect() == []


def test_components(spark):
    r = random.Random(2)
    pairs = [(r.randrange(300), r.randrange(300)) for _ in range(160)] + [(0, i) for i in range(300, 400)] + [(5, 5), (None, 3)]
    u = brute.Union()
    for a, b in pairs:
        if a is not None and a != b:
            u.join(a, b)
    got = {x.node: x.root for x in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: u.find(x) for x in u.p}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_pipeline_equals_the_plain_stages(spark):
    import corpus_pipeline
    import sentencepiece

    from procmetrics.llm.queries import model_path

    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "source").collect()]
    source = {i: s for i, _, s in docs}
    # no host of these tables is rejected, so the base rules decide
    kept = []
    for i, t, _ in docs:
        n = brute.counts(t)
        if n[0] >= 50 and 100 * n[4] <= 50 * n[0]:
            kept.append((i, t))
    kept = [(i, t) for i, t in brute.line_cuts(kept) if t.encode().split()]
    classes = brute.near_classes(kept)
    kept = [(i, t) for i, t in kept if classes[i] == i]
    copies = brute.poisson_copies([(i, t, source[i]) for i, t in kept])
    lib = sentencepiece.SentencePieceProcessor(model_file=model_path())
    want = []
    for i, t in kept:
        ids = lib.encode(t)
        want += [(i, len(ids), brute.sha(",".join(map(str, ids)).encode()), brute.sha(lib.decode(ids).encode()))] * copies[i]
    got = [tuple(r) for r in corpus_pipeline.run(spark, SMALL).collect()]
    assert sorted(got) == sorted(want)


def test_registered_queries_match_their_sql(spark, con):
    from oracle import compare

    from procmetrics.llm.queries import ORACLES, QUERIES

    for name, sql in ORACLES.items():
        diff, _, note = compare(spark, con, QUERIES[name], sql, SMALL)
        assert diff is None and not note, (name, diff, note)


def test_toxicity_learns_from_every_label(spark, monkeypatch):
    n = 24_000
    docs = spark.range(n).selectExpr("id as doc_id", "concat_ws(' ', 'w' || id, if(id % 2 = 0, 'vile', 'kind')) as text")
    labels = spark.range(n).selectExpr("id as doc_id", "cast(id % 2 = 0 as int) as toxic")
    seen, evidence, calibrate = [], toxicity.evidence, toxicity.Model.calibrate
    monkeypatch.setattr(toxicity, "evidence", lambda counted, shared: seen.append(counted.count()) or evidence(counted, shared))
    monkeypatch.setattr(toxicity.Model, "calibrate", lambda self, fit: seen.append(fit.count()) or calibrate(self, fit))
    model = toxicity.train(docs, labels)
    taught = labels.where(~toxicity.held_out(toxicity.F.col("doc_id"))).count()
    assert sum(seen) == taught and min(seen) > 0.15 * taught
    assert model.score("vile") > 0.7 > model.score("kind")


def test_toxicity_weighs_all_words():
    values = {"worst": 3.0, "bad": 2.0, "poor": 1.5, "meh": 1.0, "kind": -2.0}
    model = toxicity.Model(values)
    model.slopes = (1.0, 1.0)
    told = lambda text: [model.figures(text), model.score(text)]
    assert model.figures("Worst, bad poor") == pytest.approx((6.5 / 3, 6.5 / 3))
    assert model.figures("worst bad poor meh unheard kind") == pytest.approx((5.5 / 6, 6.5 / 3))
    assert told("worst bad poor meh")[1] > told("worst bad poor unheard")[1] > told("worst bad poor kind")[1]
    assert model.figures("") == (0.0, 0.0)


def test_hashes_of_keys_are_those_of_spark(spark):
    keys = ["", "a", "word*", "\u00e9t\u00e9", "x" * 100]
    got = spark.createDataFrame([(k,) for k in keys], "key string").selectExpr("key", "xxhash64(key) as h").collect()
    assert [r.h % 2**64 for r in got] == [toxicity._hash(r.key) for r in got]

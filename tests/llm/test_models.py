import math
import random
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from conftest import SF_DIR
from corpora import no_docs, odd_docs, prose
from pyspark.sql import functions as F

from kerbside.llm import language_model as lm
from kerbside.llm import learned_partitions, quality
from kerbside.llm.queries import op9_nearest


# ---- language model ----

def tokens(text):
    return [*(text or "").encode().lower().split(), "end"]


def test_base_score_is_exact(spark):
    df = odd_docs(spark, [prose(i, 60) for i in range(30)])
    held_out = lm.remainder("doc_id", 7) == 2
    train = [r.text for r in df.where(~held_out).collect()]
    counts = Counter(t for text in train for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    got = lm.score(df, lm.train(df.where(~held_out)), held_out=held_out).collect()
    assert len(got) == df.count() and 0 < sum(r.held_out for r in got) < len(got)
    want = sorted((str(r.doc_id), len(tokens(r.text)), sum(counts[t] > 0 for t in tokens(r.text)), n,
                   round(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens(r.text)), 6)) for r in df.collect())
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score <= 0 for r in got)


def test_shards_change_nothing(spark):
    df = odd_docs(spark, [prose(i, 300) for i in range(30)])
    one, many = (lm.train(df, segment_bytes=4000, shard_bytes=n) for n in (1 << 30, 5000))
    assert len(one.shards) == 1 and len(many.shards) > 3 and one.tokens == many.tokens
    a, b = (sorted(map(tuple, lm.score(df, m).collect()), key=str) for m in (one, many))
    assert a == b


def test_a_task_goes_through_the_model_once(spark, monkeypatch):
    """However many chunks of texts it has; held n-grams, those put aside and several passes give the same scores."""
    df = odd_docs(spark, [prose(i, 300) for i in range(30)])
    model = lm.train(df, segment_bytes=4000, shard_bytes=5000)
    want = sorted(map(tuple, lm.score(df, model).collect()), key=str)
    batches = df.selectExpr("cast(doc_id as long) doc_id", "false held_out", "coalesce(text, '') text").toArrow().to_batches(max_chunksize=4)
    loads, files, load, opened = [], [], lm.Shard.__init__, pq.ParquetFile
    monkeypatch.setattr(lm.Shard, "__init__", lambda self, *args: (loads.append(args[1:]), load(self, *args))[1])
    monkeypatch.setattr(lm.pq, "ParquetFile", lambda source: (files.append(source), opened(source))[1])
    monkeypatch.setattr(lm, "_CHUNK_TOKENS", 500)
    for held, group in ((96 << 20, 1 << 26), (0, 1 << 26), (20_000, 1 << 26), (0, 2000)):
        monkeypatch.setattr(lm, "_HELD_BYTES", held)
        monkeypatch.setattr(lm, "_GROUP_TOKENS", group)
        lm._RESIDENT.clear()
        loads.clear(), files.clear()
        got = [tuple(r.values()) for b in lm._score(model, 20.0)(iter(batches)) for r in b.to_pylist()]
        assert sorted(got, key=str) == want
        if group == 1 << 26:
            assert len(got) > 1 and sorted(loads) == sorted(model.shards) and len(model.shards) > 3
            assert len(files) <= model.segments  # no other file is opened, not even for its footer
        else:
            assert len(loads) > len(model.shards)


def test_filter_never_counts_too_little_and_seldom_too_much():
    rng = np.random.default_rng(1)
    keys, counts = rng.integers(0, 2**64, 40_000, dtype=np.uint64), rng.geometric(0.05, 40_000)
    shard = lm.Shard.__new__(lm.Shard)
    shard.filter = lm.build_filter(keys, counts)
    shard.first, shard.sizes, shard.starts = 0, np.array([len(shard.filter)]), np.array([0])
    levels = shard.quantised(keys, np.zeros(len(keys), np.int64))
    assert (levels >= lm.quantised(counts)).all()
    fresh = shard.quantised(rng.integers(0, 2**64, 40_000, dtype=np.uint64), np.zeros(40_000, np.int64))
    light = lm.Shard.__new__(lm.Shard)
    light.filter, light.first, light.starts = lm.build_filter(keys, np.ones(40_000)), 0, np.array([0])
    light.sizes = np.array([len(light.filter)])
    assert (fresh > 0).mean() < 0.5
    assert (light.quantised(rng.integers(0, 2**64, 40_000, dtype=np.uint64), np.zeros(40_000, np.int64)) > 0).mean() < 0.03


@pytest.mark.parametrize("mean", [1, 2, 20, 400])
def test_false_counts_do_not_grow_with_the_counts(mean):
    rng = np.random.default_rng(2)
    keys, fresh = (rng.integers(0, 2**64, 40_000, dtype=np.uint64) for _ in range(2))
    counts = rng.geometric(1 / mean, len(keys))
    shard = lm.Shard.__new__(lm.Shard)
    shard.filter = lm.build_filter(keys, counts)
    shard.first, shard.sizes, shard.starts = 0, np.array([len(shard.filter)]), np.array([0])
    segment = np.zeros(len(keys), np.int64)
    assert (shard.quantised(fresh, segment) > 0).mean() < 0.012
    assert (shard.quantised(keys, segment) > lm.quantised(counts)).mean() < 0.025


def test_bigrams_help(spark):
    """Text of fixed word pairs is likelier under the bigram model than under single words."""
    rng = random.Random(2)
    pairs = [f"a{i} b{rng.randrange(50)}" for i in range(50)]
    df = spark.createDataFrame([(i, " ".join(rng.choice(pairs) for _ in range(80))) for i in range(60)], "doc_id long, text string")
    rows = lm.score(df.where("doc_id < 10"), lm.train(df.where("doc_id >= 10"))).collect()
    assert all(r.score > 0.7 * r.base_score for r in rows)


def test_no_training_text(spark):
    df = odd_docs(spark)
    rows = lm.score(df, lm.train(no_docs(spark))).collect()
    assert len(rows) == df.count() and all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in rows)
    assert lm.score(no_docs(spark), lm.train(df)).count() == 0


# ---- quality ----

def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR.replace('sf0.001', 'sf0.01')}/{t}.parquet") for t in ("documents", "labels"))
    voters = quality.fit(docs, labels.where(lm.remainder("doc_id", 3) != 1))
    held_out = labels.where(lm.remainder("doc_id", 3) == 1).select("doc_id", "quality")
    rows = quality.scored(docs, voters, ["doc_id"]).join(held_out, "doc_id").collect()
    assert sum((r.score >= 0.5) == (r.quality == 1) for r in rows) / len(rows) > 0.95
    low, high = ([r.score for r in rows if r.quality == q] for q in (0, 1))
    assert np.mean([[h > x for h in high] for x in low]) > 0.97


def test_votes_against_brute_force():
    rng = np.random.default_rng(5)
    voters = quality.Voters(np.eye(6, dtype=np.float32), quality._unit(rng.standard_normal((50, 6)).astype(np.float32)),
                            rng.integers(0, 2, 50).astype(np.float32), 7, 2.0)
    asked = rng.standard_normal((30, 6)).astype(np.float32)
    for row, score in zip(asked, voters.scores(asked), strict=True):
        cosine = voters.vectors @ (row / np.linalg.norm(row))
        near = np.argsort(-cosine)[:7]
        weight = np.maximum(cosine[near], 0) ** 2
        assert score == pytest.approx((weight * voters.labels[near]).sum() / weight.sum(), abs=1e-4)


def test_quality_of_odd_rows(spark):
    df = odd_docs(spark, [prose(i, 50) for i in range(20)] + [prose(i, 50).upper() + "!!" for i in range(20)])
    labels = spark.createDataFrame([(100 + i, int(i < 20)) for i in range(40)] + [(None, 1), (100, 7), (101, None), (101, 1), (10**6, 0)],
                                   "doc_id long, quality int")
    for given in (labels, labels.limit(0)):
        rows = quality.scored(df, quality.fit(df, given), df.columns, out="mark").collect()
        assert len(rows) == df.count() and all(0 <= r.mark <= 1 for r in rows)
    assert quality.scored(no_docs(spark), quality.fit(no_docs(spark), labels), ["doc_id"]).count() == 0


# ---- nearest neighbours ----

def exact(ids, vectors, queries, k):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    out = {}
    for q in queries:
        cosine = unit @ unit[ids.index(q)]
        near = sorted((-c, i) for c, i in zip(cosine, ids, strict=True) if i != q)
        out[q] = [(i, -c) for c, i in near[:k]]
    return out


def test_recall(spark):
    sf = SF_DIR.replace("sf0.001", "sf0.1")
    table = pq.read_table(f"{sf}/embeddings.parquet")
    ids, vectors = table.column("vec_id").to_pylist(), np.array(table.column("embedding").to_pylist(), np.float64)
    want = exact(ids, vectors, [i for i in ids if i % 50 == 0], 5)
    got = {}
    for r in op9_nearest(spark, sf).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
    hits = sum(len({v for _, v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits / (5 * len(want)) >= 0.9
    exact_score = {(q, v): s for q in want for v, s in want[q]}
    for q, rows in got.items():
        assert [r[0] for r in sorted(rows)] == [1, 2, 3, 4, 5]
        assert sorted(rows) == sorted(rows, key=lambda r: (-r[2], r[1]))
        assert all(s == pytest.approx(exact_score[q, v], abs=1e-12) for _, v, s in rows if (q, v) in exact_score)


def test_ties_and_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0]) for i in range(100, 160)] + [(i, [0.0, 1.0 + i]) for i in range(4)] + [
        (50, None), (51, []), (52, [0.0, 0.0]), (53, [nan, 1.0]), (54, [inf, 1.0]), (55, [None, 1.0]), (None, [1.0, 0.0]), (56, [1.0, 2.0, 3.0]),
        (200, [-0.0, 5.0]), (0, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    index = learned_partitions.build_index(df)
    got = {}
    for r in index.search(df.where("vec_id in (0, 50, 51, 52, 53, 54, 55, 56, 102, 110)"), k=5, probes=9).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, round(r.score, 9)))
    assert {q: [v for _, v, _ in sorted(r)] for q, r in got.items()} == {
        0: [1, 2, 3, 200, 100], 102: [100, 101, 103, 104, 105], 110: [100, 101, 102, 103, 104]}
    empty = df.where(F.lit(False))
    assert learned_partitions.build_index(empty).search(df.select("vec_id")).count() == 0


def test_parts_are_balanced():
    rng = np.random.default_rng(3)
    vectors = learned_partitions._unit(rng.standard_normal((8, 16))[rng.integers(0, 8, 1000)] + 0.3 * rng.standard_normal((1000, 16)))
    near = learned_partitions.neighbour_graph(vectors, 8)
    part = learned_partitions.balanced_parts(near, 3)
    assert np.bincount(part).tolist() == [125] * 8
    assert (part[near] == part[:, None]).mean() > 0.6  # a random cut keeps an eighth

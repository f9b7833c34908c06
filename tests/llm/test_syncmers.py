import hashlib
import re
import struct

import xxhash
from pyspark.sql import functions as F

from kerbside.llm import syncmers
from corpora import edited, no_docs, odd_docs, prose


def _hash(*values):
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else struct.pack("<q", v), h)
    return h - (1 << 64) if h >> 63 else h


def _anchors(text):
    level = list(text)
    for step in (1, 2, 4):
        level = [_hash(a, b) for a, b in zip(level, level[step:], strict=False)]
    chosen = []
    for i in range(len(level) - 7):
        inner = level[i:i + 8]
        if min(inner) in (inner[0], inner[-1]):
            chosen.append((i, _hash(inner[0], inner[-1]) >> 32))
    return chosen


def _sketch(text):
    ranks = {r for _, r in _anchors(text)}
    return sorted(ranks)[:syncmers.SKETCH] if ranks else [_hash(text) >> 32]


def _likeness(a, b):
    both = sorted({*a, *b})[:syncmers.SKETCH]
    j = len(set(both) & set(a) & set(b)) / len(both)
    return 2 * j / (1 + j)


def _printed(sketch):
    return "".join(f"{r & 0xFFFFFFFF:08x}" for r in sketch)


TEXTS = [prose(1, 300), "späte Größe und naïve Mädchen 🙂🙂 in 東京, ganz schön viel Regen heute", "", None, "short", "exactly 15 char",
         prose(2, 60), prose(3, 4000), "a" * 40, prose(1, 300)]


def test_anchors_equal_brute_force_at_any_piece_size(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS) if t], "doc_id long, text string")
    for piece in (16, 64, 1 << 10):
        got = docs.select("doc_id", syncmers.anchors(F.col("text"), piece).alias("a")).collect()
        for row in got:
            assert [(a.position, a.rank) for a in row.a] == _anchors(TEXTS[row.doc_id])


def test_edited_texts_and_neighbours_equal_brute_force(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in syncmers.edited_fingerprints(docs).collect()}
    texts = [t or "" for t in TEXTS]
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        after = texts[(i + 1) % len(texts)]
        cut = len(text) // 4
        changed = text[:len(text) - cut] + after[:cut]
        row = got[i]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert row.fingerprint == _printed(_sketch(text))
        assert row.edited_fingerprint == _printed(_sketch(changed))
        assert abs(row.near_edited - _likeness(_sketch(text), _sketch(changed))) < 1e-12
        assert abs(row.near_next - _likeness(_sketch(text), _sketch(after))) < 1e-12
    assert got[0].fingerprint == got[9].fingerprint and got[9].near_next == 1.0


def test_odd_rows(spark):
    got = syncmers.edited_fingerprints(odd_docs(spark)).collect()
    assert len(got) == odd_docs(spark).count()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and r.fingerprint for r in got)
    assert syncmers.edited_fingerprints(no_docs(spark)).collect() == []
    alone = spark.createDataFrame([(1, "only one document here")], "doc_id long, text string")
    assert syncmers.edited_fingerprints(alone).first().near_next == 1.0


def test_shared_passages_are_aligned(spark):
    passage = prose(5, 80)
    a, b = prose(6, 40) + " " + passage + " " + prose(7, 30), prose(8, 90) + " " + passage
    docs = spark.createDataFrame([(1, a), (2, b), (3, prose(9, 100)), (4, edited(a, 1, 3))], "doc_id long, text string")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (1, 4)], "a long, b long")
    got = syncmers.shared_passages(pairs, docs).collect()
    longest = max((r for r in got if r.b == 2), key=lambda r: r.length)
    assert abs(longest.start_a - a.index(passage)) < 20 and longest.start_b - longest.start_a == b.index(passage) - a.index(passage)
    assert longest.length > 0.9 * len(passage)
    assert not [r for r in got if r.b == 3]
    assert len([r for r in got if r.b == 4]) >= 3


def test_plan_is_native(spark):
    docs = odd_docs(spark)
    plan = syncmers.edited_fingerprints(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_least_inner_runs_are_compared_where_a_run_is_chosen(spark):
    # Three doublings of hashes and two of minima: a third one over all places was a seventh of the time.
    plan = spark.range(1).select(syncmers.anchors(F.col("id").cast("string")).alias("a"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("zip_with(") == 5


def test_places_are_looked_up_without_arithmetic(spark):
    # Sums and differences of the place of every run were a tenth of a sketch's time (the number of a piece may be added to).
    plan = spark.range(1).select(syncmers.sketch(F.col("id").cast("string")).alias("s"))._jdf.queryExecution().optimizedPlan().toString()
    assert "zip_with(" in plan and not re.search(r"lambda \w+#\d+L? [+-] (?!1\b)\d", plan)

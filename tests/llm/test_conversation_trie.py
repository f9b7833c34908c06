import hashlib
import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from kerbside.llm import conversation_trie as trie
from kerbside.llm import list_ranking

SCHEMA = "conv_id long, turn long, role string, text string, v long, n long, p1 string, id string"


def _brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own[c].append((role or "", text or ""))
    members = defaultdict(list)
    ends = defaultdict(list)
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole = tuple(own.get(c - c % 5, [])[:h]) + tuple(ts[h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
        ends[whole].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, convs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children.get(node)
            saved[node[:d]] += (len(convs) - 1) * len(node[-1][1].encode()) if node else 0
    return sorted((min(c), len(n), min(members[n[:-1]]) if n else None, len(c), children.get(n, 0), leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n, c in members.items())


def _rows(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "p", "i") for r in rows], SCHEMA)


def _same(got, rows):
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(_brute(rows), key=key)


def test_small_trees_equal_brute_force(spark):
    rng = random.Random(1)
    rows = [(c, t if rng.random() > 0.1 or t else None, rng.choice(["user", None]), rng.choice(["a", "bé", "", None]))
            for c in range(1, 40) if c != 15 for t in range(rng.randrange(1, 7))]
    _same(trie.conversation_trie(_rows(spark, rows), limit=8).select("*"), rows)


def test_odd_rows(spark):
    rows = [(1, 0, None, None), (1, 1, "user", "x" * 60_000), (7, None, "user", "first"), (7, 0, "bot", "second"), (None, 1, "user", "lost"),
            (20, 1, "user", "same row"), (20, 1, "user", "same row"), (21, 1, "user", "alone"), (-3, 1, "user", "below zero")]
    _same(trie.conversation_trie(_rows(spark, rows)), rows)
    assert trie.conversation_trie(_rows(spark, [])).collect() == []
    assert trie.conversation_trie(_rows(spark, rows[4:5])).collect() == []


def test_hot_conversation_and_hot_node_are_shared_between_tasks(spark, monkeypatch):
    monkeypatch.setattr(trie, "_BLOCK", 16)
    monkeypatch.setattr(trie, "_CHUNK", 32)
    rows = [(5, t, "user", f"turn {t % 7}") for t in range(300)] + [(c, 0, "user", "hello") for c in range(100, 400)]
    _same(trie.conversation_trie(_rows(spark, rows).repartition(6), limit=64), rows)


def test_lists_are_ranked_in_rounds(spark):
    order = list(range(3000))
    random.Random(3).shuffle(order)
    links = spark.createDataFrame(list(zip(order, [*order[1:], None], strict=True)), "id long, succ long")
    got = {r.id: r.rank for r in list_ranking.list_ranks(links, limit=50).collect()}
    assert got == {element: place for place, element in enumerate(order)}


def test_prefix_sums_over_blocks(spark):
    values = spark.range(1000).select(F.col("id").alias("pos"), (F.col("id") * 7 % 11).alias("x"))
    got = {r.pos: r.x for r in list_ranking.prefix_sums(values, "pos", ["x"], block=64).collect()}
    assert all(got[p] == sum(i * 7 % 11 for i in range(p + 1)) for p in (0, 63, 64, 500, 999))

import random

import numpy as np
import pytest
import xxhash
from corpora import edited, no_docs, odd_docs, prose

from kerbside.llm import bit_slices, near_duplicates, simhash
from kerbside.llm.components import connected


def components(n, pairs):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


@pytest.mark.parametrize("kind", ["random", "chain", "star", "none"])
def test_components(spark, kind):
    rng = random.Random(3)
    n = 400
    pairs = {"random": [(rng.randrange(n), rng.randrange(n)) for _ in range(260)], "chain": [(i, i + 1) for i in range(n - 1)],
             "star": [(7, i) for i in range(n)], "none": [(3, 3)]}[kind]
    got = {r.node: r.root for r in connected(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = components(n, pairs)
    touched = {x for a, b in pairs if a != b for x in (a, b)}
    assert set(got) == touched
    for a in touched:
        assert {b for b in touched if got[b] == got[a]} == {b for b in touched if want[b] == want[a]}


def close_prints(n, seed, flips=4):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**64, n // 4, dtype=np.uint64)
    out = base[rng.integers(0, len(base), n)]
    original = out
    for _ in range(flips):
        out = out ^ (np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64))
    return np.unique(np.r_[original, out])


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5, 20])
def test_bit_slices_against_popcount(radius):
    prints = close_prints(700, radius)
    bucket = np.sort(np.random.default_rng(1).integers(0, 5, len(prints)))
    start = np.searchsorted(bucket, bucket)
    pairs = [(i, j) for i in range(len(prints)) for j in range(i + 1, len(prints))
             if bucket[i] == bucket[j] and int(prints[i] ^ prints[j]).bit_count() <= radius]
    assert bit_slices.forest_of_buckets(prints, start, radius, list(range(64))).tolist() == components(len(prints), pairs)


@pytest.mark.parametrize("radius,blocks,most", [(2, 4, 1 << 14), (1, 3, 1 << 14), (3, 6, 1 << 14), (2, 4, 8)])
def test_no_link_is_lost(spark, radius, blocks, most, monkeypatch):
    """Also where a bucket is cut into blocks."""
    monkeypatch.setattr(bit_slices.linked, "__defaults__", (None, most))
    prints = close_prints(500, 9, flips=1)
    if most < 100:  # one crowded bucket
        prints = np.unique(np.uint64(0xABCD) << np.uint64(32) | close_prints(60, 5) & np.uint64(0xFFFF))
    df = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "fingerprint long")
    got = {r.node: r.root for r in connected(bit_slices.hamming_edges(df, radius, blocks)).collect()}
    pairs = [(i, j) for i in range(len(prints)) for j in range(i) if int(prints[i] ^ prints[j]).bit_count() <= radius]
    want = components(len(prints), pairs)
    signed = prints.view(np.int64).tolist()
    roots = [got.get(p, p) for p in signed]
    assert pairs and len(set(roots)) == len(set(want))
    assert len({*zip(roots, want, strict=True)}) == len(set(want))


def contract_print(text, size=3):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode().split()]
    runs = [b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_groups(spark):
    base = prose(1, 900)
    texts = [base, edited(base, 1, 1), edited(base, 2, 1), edited(base, 3, 300), base.upper(), prose(2, 900), "ÄÖ x", "äö x", "a b", "A\tb"]
    df = odd_docs(spark, texts)
    rows = df.collect()
    got = simhash.near_fingerprint_groups(df, size=3).collect()
    assert len(got) == len(rows)
    prints = {(r.doc_id, f"{contract_print(r.text or ''):016x}") for r in rows}
    assert {(r.doc_id, r.fingerprint) for r in got} == prints
    distinct = sorted({p for _, p in prints})
    where = components(len(distinct), [(i, j) for i in range(len(distinct)) for j in range(i)
                                       if (int(distinct[i], 16) ^ int(distinct[j], 16)).bit_count() <= 2])
    group = dict(zip(distinct, where, strict=True))
    smallest = {}
    for doc, p in prints:
        if doc is not None:
            smallest[group[p]] = min(doc, smallest.get(group[p], doc))
    assert all(r.component_id == smallest.get(group[r.fingerprint]) for r in got)
    assert simhash.near_fingerprint_groups(no_docs(spark)).count() == 0


def similar_groups(texts, similarity=0.8):
    sets = []
    for t in texts:
        words = (t or "").encode().lower().split()
        sets.append(frozenset(b" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset())
    return components(len(texts), [(i, j) for i in range(len(texts)) for j in range(i)
                                   if sets[i] == sets[j] or len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j])])


@pytest.mark.parametrize("most", [2048, 8])
def test_near_duplicates_against_all_pairs(spark, most):
    texts = []
    for seed in range(12):
        base = prose(seed, 260, vocabulary=5000)
        texts += [base, *(edited(base, i, i) for i in range(1, 9)), base.upper() + "  "]
    df = odd_docs(spark, texts)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    groups = near_duplicates.near_duplicate_groups(df, most=most).collect()
    assert len(groups) == len(rows)
    want = similar_groups([t for _, t in rows])
    kept = near_duplicates.deduplicated(df)
    assert kept.columns == df.columns
    assert kept.count() == len(set(want)) == len({r.group for r in groups})
    first = {}
    for (doc, _), g in zip(rows, want, strict=True):
        first[g] = min(first.get(g, 10**9), -1 if doc is None else doc)
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect()) == sorted(first.values())
    assert near_duplicates.deduplicated(no_docs(spark)).count() == 0

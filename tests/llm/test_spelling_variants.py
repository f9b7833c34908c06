import random
import re
import zlib
from collections import Counter

import numpy as np
from corpora import no_docs, odd_docs

from kerbside.llm import spelling_variants as sv


def _near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(a == b[:i] + b[i + 1:] for i in range(len(b)))


def _lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def _brute(docs, every=31):
    counts = Counter()
    for key, text in docs:
        for run in re.findall(sv.RUN, text or ""):
            run = _lower(run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % every == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    out, form = {}, {}
    for w, n in words.items():
        near = sorted((o for o in words if _near(w, o)), key=lambda o: (-words[o], o))
        form[w] = near[0] if near and words[near[0]] >= 10 * n else None
        out[w] = (n, len(near))
    rows = []
    for w, (n, n_near) in out.items():
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n, n_near, words.get(form[w])))
    return sorted(rows)


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_equals_brute_force(spark):
    rng = random.Random(4)
    stems = ["".join(rng.choice("abcdeéÖßÿ×") for _ in range(rng.randrange(7, 11))) for _ in range(40)]
    docs = []
    for i in range(300):
        words = []
        for stem in rng.choices(stems, weights=range(1, 41), k=60):
            if rng.random() < 0.2:
                at = rng.randrange(len(stem))
                stem = rng.choice([stem[:at] + stem[at + 1:], stem[:at] + "Z" + stem[at:], stem[:at] + "é" + stem[at + 1:]])
            words.append(stem.title() if rng.random() < 0.1 else stem)
        docs.append((i, rng.choice([" ", "\n", "-"]).join(words)))
    got = _rows(sv.spelling_variants(spark.createDataFrame(docs, "doc_id long, text string")))
    assert got == _brute(docs)
    assert sum(r[1] is not None for r in got) > 20 and any(r[2] not in (r[0], r[1]) for r in got)


def test_odd_rows(spark):
    docs = odd_docs(spark, ["wordword wordworb " * 30, "wordwor", "wordwor wordworb"])
    got = _rows(sv.spelling_variants(docs))
    assert got == _brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sv.spelling_variants(no_docs(spark)).collect() == []
    long = spark.createDataFrame([(1, "y" * 30_000), (2, "y" * 30_000), (3, "y" * 30_001), (4, "y" * 30_001)], "doc_id long, text string")
    assert {(len(r.word), r.n_near) for r in sv.spelling_variants(long, every=1 << 40).collect()} == {(30_000, 1), (30_001, 1)}


def test_neighbourhoods_are_whole_and_without_repeats():
    rng = np.random.default_rng(5)
    for length in (1, 2, 5, 9):
        symbols = rng.integers(0, sv.SYMBOLS, (6, length))
        made = [set() for _ in range(6)]
        total = 0
        for row, codes in sv.neighbour_codes(symbols):
            total += len(row)
            for r, c in zip(row, codes, strict=True):
                made[r].add(int(c))
        assert total == sum(map(len, made))
        for r, word in enumerate(symbols.tolist()):
            around = {tuple(word)} | {tuple(word[:i] + word[i + 1:]) for i in range(length)}
            for s in range(sv.SYMBOLS):
                around |= {tuple(word[:i] + [s] + word[i + 1:]) for i in range(length)}
                around |= {tuple(word[:i] + [s] + word[i:]) for i in range(length + 1)}
            value = lambda w: sum((s + 1) * sv._BASE ** (len(w) - 1 - i) for i, s in enumerate(w)) % (1 << 64)
            assert {value(w) for w in around} == made[r]

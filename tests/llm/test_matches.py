import random

import pytest
from corpora import edited, no_docs, odd_docs, prose
from pyspark.sql import functions as F

from kerbside.llm import decontamination, license_scan

ITEMS = [(1, prose("a", 30)), (2, prose("b", 45)), (3, prose("b", 45)), (4, "too short item"), (5, None), (6, ""), (7, "q " * 12),
         (8, prose("c", 8)), (9, "one two three four five")]


def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def planted():
    a, b, c = ITEMS[0][1], ITEMS[1][1], ITEMS[7][1]
    before, after = prose(1, 70), prose(2, 70)
    return [f"{before} {a} {after}", a, a.upper().replace(" ", ",\n"), f"{a} {before} {b}", edited(a, 1, 6), f"{before} {edited(b, 3, 1)}",
            " ".join(a.split()[:15]) + " " + after, f"x {c}", before, "q " * 12 + "rest", f"{before} one two three four five {a[:40]}",
            " ".join(b.split()[4:]), before + " " + a.replace("w", "W")]


def words(text):
    out, word = [], ""
    for ch in (text or "").lower() + " ":
        if ch.isalnum():
            word += ch
        elif word:
            out.append(word)
            word = ""
    return out


def runs(w, k):
    return [tuple(w[i:i + k]) for i in range(len(w) - k + 1)]


def weighted(a, b):
    common = sum(min(a.count(s), b.count(s)) for s in set(a))
    return common / (len(a) + len(b) - common) if a or b else 0


def test_items_against_all_windows(spark):
    """Every window of item size is tried, shared shingle or not; what is found must be the same."""
    df = odd_docs(spark, planted())
    best = {}
    for r in df.collect():
        w = words(r.text)[:2000]  # the one longer text repeats a single word
        for item_id, text in ITEMS:
            iw = words(text)
            if len(iw) < 5 or len(w) < 5:
                continue
            target = runs(iw, 5)
            for start in range(max(1, len(w) - len(iw) + 1)):
                s = weighted(runs(w[start:start + len(iw)], 5), target)
                if s >= 0.8 and s > best.get((r.doc_id, item_id), (0, 0))[0]:
                    best[r.doc_id, item_id] = (s, start)
    got = {(r.doc_id, r.item_id): (r.similarity, r.window_start) for r in decontamination.contaminated(df, items(spark)).collect()}
    assert got == best and {k[1] for k in got} == {1, 2, 3, 7, 8, 9}
    clean = decontamination.decontaminated(df, items(spark))
    assert clean.columns == df.columns
    assert clean.count() == df.count() - len({k[0] for k in best})


def test_within_radius_at_the_threshold(spark):
    """Windows at a similarity of 0.8 stay within the radius of the item's fingerprint."""
    base = prose("r", 60, vocabulary=5000).split()
    texts = [" ".join(["new"] * n + base[n:]) for n in range(7)] + [" ".join([*base[:-n], *["new"] * n]) for n in range(1, 7)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = decontamination.contaminated(df, spark.createDataFrame([(1, " ".join(base))], "item_id long, text string")).collect()
    want = {i for i, t in enumerate(texts) if weighted(runs(t.split(), 5), runs(base, 5)) >= 0.8}
    assert {r.doc_id for r in found} == want and max(r.hamming for r in found) <= 18 and len(want) > 9


def test_nothing_to_look_for(spark):
    assert decontamination.contaminated(no_docs(spark), items(spark)).count() == 0
    df = odd_docs(spark, planted())
    assert decontamination.contaminated(df, items(spark).where(F.lit(False))).count() == 0
    assert decontamination.decontaminated(df, items(spark).where(F.lit(False))).count() == df.count()


def test_blocks_meet_all_within_radius(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(200):
        a, b = rng.getrandbits(63), 0
        for bit in rng.sample(range(64), rng.randrange(19)):
            b |= 1 << bit
        b = a ^ b
        rows.append((a, b - (1 << 64) if b >> 63 else b))
    df = spark.createDataFrame(rows, "a long, b long")
    agree = F.exists(F.zip_with(decontamination.blocks("a", 19), decontamination.blocks("b", 19), lambda x, y: x == y), lambda x: x)
    assert df.where(~agree).count() == 0


def license_docs():
    apache, header = license_scan.TEMPLATES["Apache-2.0"], license_scan.TEMPLATES["Apache-2.0 header"]
    before, after = prose(1, 90), prose(2, 90)
    return [f"{before}\n{apache}.\n{after}", apache.upper(), f"{before} {header} {after}", before, "Released under the MIT License.",
            f"{before} released under the MIT licence", edited(header, 1, 4), edited(header, 2, 30),
            *[f"{prose(i, i)} {license_scan.TEMPLATES['GPL-3.0']} {after}" for i in range(40)]]


def test_licenses_against_all_windows(spark):
    df = odd_docs(spark, license_docs())
    best = {}
    for r in df.collect():
        w = words(r.text)[:2000]
        for name, text in license_scan.TEMPLATES.items():
            target = set(runs(words(text), 3))
            size = max(8, 1 << (len(words(text)) - 1).bit_length())
            for start in range(0, max(1, len(w)), size // 4):
                share = len(target & set(runs(w[start:start + size + size // 4], 3))) / len(target)
                if share >= 0.8 and share > best.get((r.doc_id, name), (0, 0))[0]:
                    best[r.doc_id, name] = (share, start)
    got = {(r.doc_id, r.license): (r.containment, r.window_start)
           for r in license_scan.license_matches(df, license_scan.templates(spark)).collect()}
    assert got == best and len({k[0] for k in got}) > 40
    assert license_scan.license_matches(no_docs(spark), license_scan.templates(spark)).count() == 0
    assert license_scan.license_matches(df, license_scan.templates(spark).where(F.lit(False))).count() == 0


def test_notices_with_inserted_words_at_every_start(spark):
    """Wherever words are inserted and wherever the notice starts: what any window of two classes holds is found."""
    texts, after = [], prose(2, 40)
    for name, inserted in (("CC-BY-SA-4.0", 4), ("CC-BY-SA-4.0", 8), ("CC-BY-4.0", 5), ("CC-BY-4.0", 8), ("GPL-3.0", 6), ("GPL-3.0", 8)):
        notice = words(license_scan.TEMPLATES[name])
        for cut in range(1, len(notice)):
            for offset in range(4):
                between = prose(cut, inserted)
                texts.append(" ".join([*words(prose(3, 20 + offset)), *notice[:cut], between, *notice[cut:], after]))
    want = set()
    for i, t in enumerate(texts):
        w = words(t)
        for name, text in license_scan.TEMPLATES.items():
            target = set(runs(words(text), 3))
            length = 2 * max(8, 1 << (len(words(text)) - 1).bit_length())
            if any(len(target & set(runs(w[start:start + length], 3))) >= 0.8 * len(target) for start in range(len(w))):
                want.add((i, name))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = license_scan.license_matches(df, license_scan.templates(spark)).collect()
    assert {(r.doc_id, r.license) for r in got} == want and len({i for i, _ in want}) > 200


@pytest.mark.parametrize("build", ["items", "licenses"])
def test_no_python_in_the_plans(spark, build):
    df = odd_docs(spark)
    out = decontamination.contaminated(df, items(spark)) if build == "items" else license_scan.license_matches(df, license_scan.templates(spark))
    assert "Python" not in out._jdf.queryExecution().toString() and "Arrow" not in out._jdf.queryExecution().toString()

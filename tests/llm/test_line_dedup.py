import hashlib
import random

from conftest import rows_of
from corpora import no_docs, odd_docs

from kerbside.llm import line_dedup


def expected(rows, min_docs=3, min_chars=20):
    blank = " \t\n\x0b\x0c\r"
    key = lambda line: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(blank))
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(h := holders.get(key(x), ())) >= min_docs and doc != max(h))]
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def some_rows(seed):
    rng = random.Random(seed)
    shared = [f"This line is shared number {i}" for i in range(12)]
    return [(doc, "\n".join(rng.choice([f"  {rng.choice(shared)}\t", rng.choice(shared).upper(), f"own {rng.random()} line of a text", "short", ""])
                            for _ in range(rng.randrange(9)))) for doc in range(90)]


def test_same_as_brute_force(spark):
    rows = [*some_rows(1), (200, None), (201, "the same ä line again Ä\n" * 30), (202, "the same ä line again Ä\n"), (203, "the same ä line again Ä")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(line_dedup.line_report(df), "doc_id", "n_lines", "n_dropped", "kept_sha256") == expected(rows)


def test_keys_longer_than_a_chunk(spark):
    """Every run is cut into many chunks, so the summaries decide."""
    rows = some_rows(2)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    few, many = (line_dedup.dropped_lines(df, chunk_rows=n) for n in (3, 10**6))
    assert rows_of(few) == rows_of(many) != []


def test_odd_rows(spark):
    rare = "an uncommon line of text"
    common = "a common line of the corpus"
    df = odd_docs(spark, [f"{common}\n{rare} {i}" for i in range(5)])
    report = {(r.doc_id, r.kept_sha256): r for r in line_dedup.line_report(df).collect()}
    assert line_dedup.line_report(df).count() == df.count()
    assert sum(r.n_dropped for r in report.values()) == 4
    kept = line_dedup.deduplicated(df)
    assert kept.columns == df.columns and kept.count() == df.count()
    assert {r.text for r in kept.where("doc_id between 100 and 104").collect()} == {
        *(f"{rare} {i}" for i in range(4)), f"{common}\n{rare} 4"}
    assert kept.where("doc_id = 1").first().text is None


def test_empty_table(spark):
    assert line_dedup.line_report(no_docs(spark)).count() == 0
    assert line_dedup.deduplicated(no_docs(spark)).count() == 0

import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from corpora import no_docs, odd_docs
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from kerbside.llm import lattice_sampling as ls
from kerbside.llm import queries

MODEL = public_tokenizers.path("piece_bpe_32k.model")
with open(MODEL, "rb") as source:
    VOCABULARY = ls.Vocabulary(source.read())
LIBRARY = SentencePieceProcessor(model_file=MODEL)


def all_segmentations(text):
    pieces = {VOCABULARY.surface[i].decode(): (i, w) for _, ids, weights in VOCABULARY.by_length for i, w in zip(ids, weights, strict=True)}
    s = ls.BLANK + text.replace(" ", ls.BLANK)
    found = {}

    def go_on(at, ids, weight):
        if at == len(s):
            found[tuple(ids)] = weight
        for n in range(1, 17):
            piece = s[at:at + n]
            if len(piece) == n and piece in pieces:
                go_on(at + n, [*ids, pieces[piece][0]], weight + pieces[piece][1])
            elif n == 1 == len(piece):
                spelt = piece.encode()
                go_on(at + 1, [*ids, *(VOCABULARY.byte_ids[bytes([b])] for b in spelt)], weight + VOCABULARY.byte_weight * len(spelt))

    go_on(0, [], 0.0)
    total = np.logaddexp.reduce(list(found.values()))
    return {ids: weight - total for ids, weight in found.items()}


def seeds(n, salt=1):
    return np.random.default_rng(salt).integers(0, 2**64, n, dtype=np.uint64)


def test_distribution_without_replacement():
    """First, second and third pieces of the sample follow the law of drawing without replacement."""
    log_p = all_segmentations("the ab\nd")
    p = {s: math.exp(w) for s, w in log_p.items()}
    n = 6000
    rows = ls.sample_batch(VOCABULARY, ["the ab\nd"] * n, seeds(n), 3)
    for samples in rows:
        assert len({tuple(ids) for ids, *_ in samples}) == 3
        assert samples[0][2] > samples[1][2] > samples[2][2]
        assert all(log_prob == pytest.approx(log_p[tuple(ids)]) for ids, log_prob, *_ in samples)
    likely = sorted(p, key=p.get)[-3:]
    first, second, third = (Counter(tuple(r[i][0]) for r in rows) for i in range(3))
    for s in likely:
        two = sum(p[a] * p[s] / (1 - p[a]) for a in p if a != s)
        three = sum(p[a] * p[b] / (1 - p[a]) * p[s] / (1 - p[a] - p[b]) for a in p for b in p if len({a, b, s}) == 3)
        for count, chance in ((first[s], p[s]), (second[s], two), (third[s], three)):
            assert abs(count - n * chance) < 5 * math.sqrt(n * chance) + 3
    # Weighted by probability over inclusion, the samples estimate sums over all segmentations.
    assert np.mean([sum(math.exp(lp) / inc for _, lp, _, inc in r) for r in rows]) == pytest.approx(1, abs=0.02)


def test_all_segmentations_when_few():
    log_p = all_segmentations("ab")
    samples = ls.sample_batch(VOCABULARY, ["ab"], seeds(1), len(log_p) + 5)[0]
    assert {tuple(ids) for ids, *_ in samples} == set(log_p)
    assert all(inclusion == 1 for *_, inclusion in samples)


@pytest.mark.parametrize("text", ["a  b", " a", "a\nb\n", "", " ", "é́ ﬁ ½ 東京🙂", "x\ty\u0000z", "<s>b</s> <0x41>", "!" * 3000, "a " * 3000])
def test_round_trip(text):
    for ids, *_ in ls.sample_batch(VOCABULARY, [text], seeds(1), 3)[0]:
        assert VOCABULARY.decode(ids).decode() == text == LIBRARY.decode(ids.tolist())
    assert VOCABULARY.decode(np.array(LIBRARY.encode(text), np.int32)).decode() == text


def test_batches_do_not_matter():
    texts = ["some words here", "", "other words\nthere", "日本 text", "the the the"]
    together = ls.sample_batch(VOCABULARY, texts, seeds(5), 3)
    alone = [ls.sample_batch(VOCABULARY, [t], seeds(5)[i:i + 1], 3)[0] for i, t in enumerate(texts)]
    flat = lambda samples: [(ids.tolist(), round(lp, 6), round(key, 6)) for ids, lp, key, _ in samples]
    assert [flat(s) for s in together] == [flat(s) for s in alone]


def test_odd_rows(spark):
    df = odd_docs(spark)
    rows = ls.sampled_segmentations(df, MODEL, k=2)
    texts = ls.decoded(rows, MODEL)
    got = {(r.doc_id, r.text) for r in texts.collect()}
    assert got == {(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()}
    assert rows.where(~F.col("round_trip")).count() == 0
    per_doc = Counter(r.doc_id for r in rows.collect())
    assert per_doc[1] == per_doc[2] == 1 and per_doc[3] == 2 and per_doc[5] == 4
    assert ls.sampled_segmentations(no_docs(spark), MODEL).count() == 0
    again = ls.sampled_segmentations(df.repartition(5), MODEL, k=2)
    stable = [F.col("doc_id"), F.col("sample"), F.crc32("ids"), F.round("key", 6)]
    assert sorted(map(tuple, rows.select(stable).collect()), key=str) == sorted(map(tuple, again.select(stable).collect()), key=str)


def test_query_decodes_what_it_sampled(spark, folder):
    docs = [(1, "some words"), (2, ""), (3, None), (4, "日本\nx"), (None, "no id"), (4, "same id")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    rows = queries.op4_sentencepiece(spark, folder).collect()
    crc = {(i, zlib.crc32((t or "").encode())) for i, t in docs}
    assert {(r.doc_id, r.text_crc32) for r in rows} == crc and all(r.round_trip for r in rows)
    kept = ls.decoded(ls.sampled_segmentations(spark.createDataFrame(docs, "doc_id long, text string"), MODEL), MODEL, keep=["key"])
    assert kept.columns == ["doc_id", "sample", "key", "text"]
    assert {(r.doc_id, r.key) for r in kept.collect()} == {(r.doc_id, r.key) for r in rows}


def test_sampling_worker_decodes_from_the_bytes_it_has_spelt(monkeypatch):
    # Spelling the ids a second time, one by one, was a tenth of the worker's time.
    def again(*_):
        raise AssertionError("the ids were spelt a second time")

    monkeypatch.setattr(ls.Surfaces, "decode", again)
    texts = ["some words", " blank in front", "日本\n\nx 🙂", "", "a  b "]
    known = ls.KnownUnits(VOCABULARY)
    for _ in range(3):  # units are new, met, and kept
        batch = pa.RecordBatch.from_arrays([pa.array(range(5), pa.int64()), pa.array(range(5), pa.int64()), pa.array(texts)],
                                           names=["doc_id", "seed", "text"])
        rows = ls._rows(known, batch, 2, True).to_pylist()
        assert {(r["doc_id"], r["text"]) for r in rows} == set(enumerate(texts)) and all(r["round_trip"] for r in rows)
        assert all(LIBRARY.decode(np.frombuffer(r["ids"], "<i4").tolist()) == r["text"] for r in rows)


def _edges_of(lattice, number, unit):
    first = lattice.first[number]
    own = (lattice.node >= first) & (lattice.node < first + len(unit))
    return [x.tolist() for x in (lattice.node[own] - first, lattice.to[own] - first, lattice.piece[own], lattice.probability[own])]


def test_known_units_stay_where_they_are():
    # All that was known used to be copied for every batch, with the batch's new units behind it.
    known, units = ls.KnownUnits(VOCABULARY), [f"{ls.BLANK}word{i}" for i in range(60)]
    for turn, batch in enumerate((units, units, [*units[::2], f"{ls.BLANK}new", units[0]], units)):
        lattice, numbers = known.lattice_of(batch)
        if turn > 1:
            assert all(np.shares_memory(getattr(lattice, name), getattr(known.kept, name)) for name in ("node", "piece", "upto", "first"))
        for unit, number in zip(batch, numbers, strict=True):
            assert _edges_of(lattice, number, unit) == _edges_of(ls.Lattice(VOCABULARY, [unit]), 0, unit)


def test_pieces_that_share_the_upper_bits_of_their_hash_are_told_apart(monkeypatch):
    units = [f"{ls.BLANK}some", "words", f"{ls.BLANK}{ls.BLANK}and", "日本", "\n", "Größe,", "zzzzqqqq"]
    plain = ls.Lattice(VOCABULARY, units)
    monkeypatch.setattr(ls, "_SIEVE", 4)
    with open(MODEL, "rb") as file:
        crowded = ls.Vocabulary(file.read())
    assert max(crowded.deepest) > 100
    assert all(np.array_equal(getattr(ls.Lattice(crowded, units), name), getattr(plain, name)) for name in ("node", "to", "piece", "upto"))

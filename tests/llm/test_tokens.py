import tempfile
import zlib

import numpy as np
import public_tokenizers
import pytest
from corpora import no_docs, odd_docs
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kerbside.llm import chunked_encoder, token_counts, token_shards
from kerbside.llm.chunked_encoder import ChunkedEncoder

MODEL = public_tokenizers.path("byte_bpe_50k.json")
WHOLE = Tokenizer.from_file(MODEL)
with open(MODEL, encoding="utf-8") as source:
    CHUNKED = ChunkedEncoder(source.read(), keep=50)


def ids(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids


def chunked_ids(texts):
    return [np.frombuffer(p, f"<u{CHUNKED.width}").tolist() for p in CHUNKED.payloads(texts)]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t\r  \x1c\u0085ab'sé東🙂9.<|>", max_size=30), max_size=5))
def test_chunks_give_the_ids_of_whole_texts(texts):
    assert chunked_ids(texts) == [ids(t) for t in texts]


@pytest.mark.parametrize("text", ["<|endoftext|>", "a <|endoftext|> b", " <|endoftext|>\n<|endoftext|>x", "it's 's 'll", "a  b   c\n\n d \n e",
                                  "\n\na\n", "   ", "a\n  b\n\tc", "x <|endof text|> y", "trailing ", " leading"])
def test_awkward_texts(text):
    assert chunked_ids([text]) == [ids(text)]


def test_counts_and_cache(spark):
    df = odd_docs(spark, ["many words " * 300])
    cache = tempfile.mkdtemp()
    first = token_counts.count_tokens(df, MODEL, cache)
    want = sorted(((r.doc_id, len((r.text or "").encode()), len(ids(r.text)), len(ids(r.text)) > 512) for r in df.collect()), key=str)
    assert sorted(map(tuple, first.collect()), key=str) == want
    stored = spark.read.parquet(cache).count()
    assert stored == df.select("text").na.fill("").distinct().count()
    again = token_counts.count_tokens(odd_docs(spark, ["many words " * 300, "a new text"]), MODEL, cache)
    assert again.count() == df.count() + 1
    assert spark.read.parquet(cache).count() == stored + 1  # all others were hits


def test_cache_is_used(spark):
    cache = tempfile.mkdtemp()
    df = spark.createDataFrame([(1, "hello there"), (2, None)], "doc_id long, text string")
    token_counts.count_tokens(df, MODEL, cache)
    version, = spark._jvm.java.io.File(cache).list()
    digest = df.select(token_counts.content_digest(df["text"]).alias("digest"))
    fake = tempfile.mkdtemp()
    digest.selectExpr("digest", "77L as n_tokens").write.parquet(f"{fake}/{version}")
    assert {r.n_tokens for r in token_counts.count_tokens(df, MODEL, fake).collect()} == {77}


def test_counts_of_nothing(spark):
    assert token_counts.count_tokens(no_docs(spark), MODEL, tempfile.mkdtemp()).count() == 0


def test_shards_round_trip(spark):
    df = spark.createDataFrame([(i * 3, f"text {i} " * (i % 7)) for i in range(300)] + [(-5, None), (1001, "")], "doc_id long, text string")
    shards = token_shards.write_token_shards(df, tempfile.mkdtemp() + "/t", MODEL, end_id=2, shard_bytes=900, bucket_keys=40)
    assert shards.n_buckets > 5 and shards.shards().count() > 5
    want, start = {}, 0
    for r in sorted(df.collect()):
        own = [*ids(r.text), 2]
        want[r.doc_id] = (start, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
        start += len(own)
    asked = df.select("doc_id").unionByName(spark.createDataFrame([(1,), (10**9,), (None,)], "doc_id long"))
    got = shards.read(asked).withColumn("crc", token_shards.ids_crc32("ids")).collect()
    assert {r.doc_id: (r.start, r.n_ids, r.crc) for r in got} == want and len(got) == len(want)


def test_shards_of_odd_rows(spark):
    df = odd_docs(spark)
    shards = token_shards.write_token_shards(df, tempfile.mkdtemp() + "/t", MODEL, shard_bytes=100_000)
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in shards.read(df).collect()}
    assert set(got) == {r.doc_id for r in df.collect()} - {None}
    assert got[1] == [] and got[8] == ids("word " * 40_000) and got[5] == ids("twice the same row")
    assert got[6] in (ids("one id and this text"), ids("one id and another text"))
    assert sum(r.ids for r in shards.shards().collect()) == sum(len(ids(r.text)) for r in df.collect())
    empty = token_shards.write_token_shards(no_docs(spark), tempfile.mkdtemp() + "/t", MODEL)
    assert empty.read(df).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash(n):
    rng = np.random.default_rng(n)
    h1, h2 = (rng.integers(0, 2**64, n, dtype=np.uint64) for _ in range(2))
    table = token_shards.PerfectHash.build(h1, h2)
    assert sorted(table.slots(h1, h2)) == list(range(n))


def test_equal_hashes_are_refused():
    with pytest.raises(ValueError):
        token_shards.PerfectHash.build(np.array([1, 1], np.uint64), np.array([2, 2], np.uint64))


def test_a_worker_keeps_one_encoder_and_the_chunks_that_come_again():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as source:
        model = source.read()
    assert chunked_encoder.worker_encoder(model) is chunked_encoder.worker_encoder(model)
    encoder = ChunkedEncoder(model, keep=8)
    for texts in (["a often one two"], ["b often three four"], ["c often five six seven eight"]):
        assert encoder.payloads(texts) == ChunkedEncoder(model).payloads(texts)
    assert "often" in encoder.ids and "seven" not in encoder.ids and len(encoder.ids) <= 8


def test_a_word_is_handled_once_a_batch_and_not_at_each_occurrence():
    # Per occurrence a dictionary lookup and a string of its own took as long as the library did.
    with open(MODEL, encoding="utf-8") as source:
        encoder = ChunkedEncoder(source.read())
    looked_up = []

    class Counting(dict):
        def get(self, key, default=None):
            looked_up.append(key)
            return super().get(key, default)

        def __getitem__(self, key):
            looked_up.append(key)
            return super().__getitem__(key)

    encoder.ids = Counting()
    texts = ["so many words\nof few kinds " * 500, "words " * 2000, "of few\u0085 kinds\t "]
    assert [np.frombuffer(p, f"<u{encoder.width}").tolist() for p in encoder.payloads(texts)] == [ids(t) for t in texts]
    assert looked_up.count("words") <= 2 and len(looked_up) < 40

"""Token counts and token shards against the tokenizers library on whole texts."""
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from batchtrace.llm import token_store
from batchtrace.llm.elias_fano import EliasFano
from batchtrace.llm.pieces import PieceSplitter
from batchtrace.llm.token_counts import MergeCounter, count_tokens
from batchtrace.session import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tools():
    spec = open(PATH, encoding="utf-8").read()
    splitter = PieceSplitter(spec)
    return Tokenizer.from_file(PATH), splitter, MergeCounter(splitter), token_store.WordEncoder(splitter, 2)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=12), st.sampled_from(
    ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "'s", "'Ll", " ", "ΑΣ", "İ", "é", "thththing", "K"]))).map("".join))
def test_pieces_agree_with_the_library(tools, text):
    library, splitter, counter, encoder = tools
    ids = library.encode(text, add_special_tokens=False).ids
    assert sum(counter[p] for p in splitter.pieces(text)) == len(ids)
    assert np.frombuffer(encoder.encode([splitter.words(text)])[0], "<u2").tolist() == ids


def test_long_piece_merges(tools):
    library, splitter, counter, _ = tools
    for text in ("ab" * 3000, "tion" * 2000, "z" * 4097):
        assert sum(counter[p] for p in splitter.pieces(text)) == len(library.encode(text, add_special_tokens=False).ids)


def test_caches_are_bounded(tools):
    _, splitter, counter, _ = tools
    small = MergeCounter(splitter, limit=5)
    assert [small[w] for w in "abcdefghij"] == [1] * 10 and len(small) <= 5


def test_encoder_forgets_and_stays_right(tools):
    library, splitter, _, _ = tools
    encoder = token_store.WordEncoder(splitter, 2, limit=40)
    for start in range(0, 300, 13):
        text = " ".join([f"w{n % 97}x," for n in range(start, start + 20)] + ["the<|endoftext|>", "river"])
        got = encoder.encode([splitter.words(text), splitter.words("river")])
        assert np.frombuffer(got[0], "<u2").tolist() == library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(got[1], "<u2").tolist() == library.encode("river", add_special_tokens=False).ids
        assert len(encoder.words) <= 60 and len(encoder.pieces) <= 140


def test_counts_of_odd_documents(spark, odd, empty, tools):
    library = tools[0]
    rows = count_tokens(odd, PATH, limit=100).collect()
    want = sorted((r.doc_id or 0, len((r.text or "").encode()), n := len(library.encode(r.text or "", add_special_tokens=False).ids), n > 100)
                  for r in odd.collect())
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in rows) == want
    assert count_tokens(empty, PATH).count() == 0


@pytest.mark.parametrize("top", [0, 1, 63, 10**4, 10**13])
@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 3000])
def test_elias_fano_round_trip(n, top):
    values = np.sort(np.random.default_rng(n).integers(0, top + 1, n))
    coded = EliasFano.encode(values).to_bytes()
    back = EliasFano.from_bytes(coded)
    assert all(back.select(i) == values[i] for i in range(0, n, 11))
    assert (back.select_range(0, n) == values).all()
    if n > 300:
        assert (back.select_range(250, n - 3) == values[250:n - 3]).all()
        assert len(coded) < n * (3 + max(0, np.log2(max(top, 1) / n))) / 8 + 4 * n / 256 + 100
    with pytest.raises(IndexError):
        back.select(n)


def test_elias_fano_needs_order():
    with pytest.raises(ValueError):
        EliasFano.encode(np.array([3, 2]))


@pytest.mark.parametrize("shard_ids", [50, 4_000_000])
def test_shards_round_trip(spark, odd, tools, shard_ids):
    library = tools[0]
    out = token_store.write_tokens(odd, PATH, scratch_path(spark, "t"), shard_ids=shard_ids)
    rows = sorted(token_store.read_tokens(spark, out).collect(), key=lambda r: r.start)
    docs = sorted(odd.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    start = 0
    for r, d in zip(rows, docs, strict=True):
        ids = [*library.encode(d.text or "", add_special_tokens=False).ids, 2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (
            d.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_shard_reads_one_document():
    shard = token_store.Shard(token_store.pack_shard(np.arange(10, dtype="<u2").tobytes(), 2, np.array([0, 4, 4, 10]), [5, None, 7, 8]))
    assert [shard.document(i).tolist() for i in range(4)] == [[], [0, 1, 2, 3], [], [4, 5, 6, 7, 8, 9]]
    assert shard.doc_ids == [5, None, 7, 8]


def test_no_documents_no_shards(spark, empty):
    out = token_store.write_tokens(empty, PATH, scratch_path(spark, "t"))
    assert token_store.read_tokens(spark, out).count() == 0


_ODD = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "'s", "'LL", " ", "\n", "ΑΣ", "İ", "é", "É", "thththing", "K", "\x00", "\x85", "\xa0", "\u3000", "\x1c",
        "a1b2", "x--y", "ﬁ", "e\u0301", "\u1df6\u0301", "b\U0001e4ec\u0301", "²", "ß", "µ", "Ω", "漢字", "don't", "", "ÀB"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.one_of(st.text(max_size=6), st.sampled_from(_ODD)), max_size=6).map("".join), max_size=7), st.sampled_from([1, 400_000]))
def test_slices_agree_with_the_library(tools, texts, limit):
    import pyarrow as pa
    library, splitter, _, _ = tools
    encoder = token_store.SliceEncoder(splitter, 2, 2, limit)
    padded = pa.array(["skipped", *texts], pa.string()).slice(1)
    for _ in range(2):  # also with a table that is filled, or forgotten
        ids, sizes = encoder.encode(padded)
        want = [[*library.encode(t, add_special_tokens=False).ids, 2] for t in texts]
        assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_marks_that_the_tables_order_otherwise(tools):
    library, splitter, counter, _ = tools
    assert {"\u1df6", "\U0001e4ec", "\U0001e4ed"} <= splitter.differing and len(splitter.differing) < 200
    for c in splitter.differing:
        for text in (f"b{c}\u0301", f"é{c}\u0316z", f"\u0334{c}"):
            assert sum(counter[p] for p in splitter.pieces(text)) == len(library.encode(text, add_special_tokens=False).ids)


def test_shards_are_read_by_as_many_tasks(spark, tools):
    from pyspark.sql import functions as F
    docs = spark.createDataFrame([(i, f"some words of text {i}") for i in range(400)], "doc_id long, text string")
    out = token_store.write_tokens(docs, PATH, scratch_path(spark, "t"), shard_ids=70)
    shards = spark.read.parquet(f"{out}/manifest").count()
    back = token_store.read_tokens(spark, out)
    assert shards >= 40 and back.rdd.getNumPartitions() == shards
    used = back.select(F.spark_partition_id().alias("p")).distinct().count()
    assert used == shards


def test_rows_of_one_id_are_dealt_to_many_tasks(spark, tools):
    same = [(7, "the same text")] * 3000 + [(None, f"w{i}") for i in range(3000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # these rows are few
    try:
        out = token_store.write_tokens(spark.createDataFrame(same, "doc_id long, text string").repartition(6), PATH, scratch_path(spark, "t"), shard_ids=10**6)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    per_task = [r.n_docs for r in spark.read.parquet(f"{out}/manifest").groupBy("part").sum("n_docs").withColumnRenamed("sum(n_docs)", "n_docs").collect()]
    assert len(per_task) > 1 and max(per_task) < 4500
    rows = sorted(token_store.read_tokens(spark, out).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None] * 3000 + [7] * 3000


def test_shards_in_a_given_order(spark, tools):
    from pyspark.sql import functions as F
    docs = spark.createDataFrame([(i % 5, f"w{i}", i) for i in range(50)], "doc_id long, text string, place long").repartition(4)
    out = token_store.write_tokens(docs, PATH, scratch_path(spark, "t"), order=[-F.col("place")])
    rows = sorted(token_store.read_tokens(spark, out).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [i % 5 for i in reversed(range(50))]

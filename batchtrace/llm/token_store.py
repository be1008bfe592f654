"""Token ids of a corpus as binary shards with Elias-Fano document boundaries.

``write_tokens`` range-partitions the documents by id (one shuffle), sorts each
partition, encodes it and writes shards. A shard is one file:

    magic "TIDS1", id width (2 or 4), documents, ids, bytes of the boundary part
    ids, little-endian, all documents run together
    boundaries: Elias-Fano code of the documents' end offsets in the shard
    document ids, 8 bytes each, and one byte each that is 0 for a null id

A shard is cut at ``shard_ids`` ids, so a task holds one shard at a time. Files
are named by a random part, so a second attempt of a task never touches the
first one's; only files named in the manifest, a Parquet table committed by
Spark, count. ``read_tokens`` gets global starts from the manifest's sums.

Ids are the tokenizers library's. A piece's ids do not depend on its neighbours, so
a worker takes texts slice by slice: Arrow splits a slice into words and numbers the
different ones, these are split into pieces in one go, the library's model encodes
pieces that are new to the worker (a bounded table keeps the others), and the ids of
all texts are gathered by number. Tests compare with the library on whole texts.

Results: documents ascend by id, null ids first, rows of one id by the first 32
characters of their text, then by its hash; or they follow the order columns given.
The range keys tell rows apart, so no id, however many rows it has, is one task's
work. Null and empty texts hold the end id alone. An empty table writes no shard.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from batchtrace.llm.common import chunks
from batchtrace.llm.elias_fano import EliasFano
from batchtrace.llm.pieces import PieceSplitter

MAGIC = b"TIDS1"
_HEAD = "<5sBQQQ"
#: Ids of one shard at most, but for a longer single document.
SHARD_IDS = 4_000_000
#: Words, and word pieces, that a worker remembers; bytes of text that it encodes at once.
CACHE_KEYS, SLICE_BYTES = 400_000, 8 << 20


class KeptIfReused(dict):
    """A bounded cache; when full it forgets the keys that only one call has asked for."""

    def __init__(self, limit: int):
        self.limit, self.once = limit, set()

    def missing(self, keys: set[str]) -> list[str]:
        """Those of ``keys`` that are to be computed; there is room for them afterwards."""
        self.once -= keys
        if len(self) + len(keys) > self.limit:
            for key in self.once:
                del self[key]
            self.once.clear()
            if len(self) + len(keys) > self.limit:
                self.clear()
        new = [k for k in keys if k not in self]
        self.once.update(new)
        return new


class WordEncoder:
    """Words (runs between white space) to ids, as little-endian bytes, by the tokenizers library."""

    def __init__(self, splitter: PieceSplitter, width: int, limit: int = CACHE_KEYS):
        from tokenizers import Tokenizer, pre_tokenizers
        spec = splitter.spec | {"normalizer": None, "added_tokens": [], "post_processor": None}
        self.model = Tokenizer.from_str(json.dumps(spec))
        self.model.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.splitter, self.width = splitter, width
        self.special = {s: i.to_bytes(width, "little") for s, i in splitter.special.items()}
        self.words, self.pieces = KeptIfReused(limit), KeptIfReused(limit)

    def encode(self, texts: list[list[str]]) -> list[bytes]:
        """Ids of texts given as their words; each new word piece goes to the library once."""
        new = self.words.missing(set().union(*texts))
        split = [[w] if w in self.special else self.splitter.plain(w) for w in new]
        unknown = [p for p in self.pieces.missing(set().union(*split)) if p not in self.special]
        if unknown:
            code = self.model.encode(unknown, is_pretokenized=True, add_special_tokens=False)
            ids = np.array(code.ids, f"<u{self.width}").tobytes()
            ends = (self.width * np.searchsorted(np.array(code.word_ids), np.arange(len(unknown) + 1))).tolist()
            self.pieces.update(zip(unknown, (ids[i:j] for i, j in zip(ends, ends[1:])), strict=True))
        self.pieces.update(self.special)
        of = self.pieces.__getitem__
        self.words.update(zip(new, (b"".join(map(of, s)) for s in split), strict=True))
        return [b"".join(map(self.words.__getitem__, t)) for t in texts]


def gathered(starts: np.ndarray, sizes: np.ndarray, data: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``which`` of ``data``, one after the other, and their sizes."""
    n = sizes[which]
    ends = np.cumsum(n)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[which] - (ends - n), n)
    return data[at], n


class SliceEncoder:
    """Whole slices of texts to ids, with the end id after each text."""

    #: Stands alone between the words of a slice while they are split.
    MARK = "\x00"

    def __init__(self, splitter: PieceSplitter, width: int, end_id: int, limit: int = CACHE_KEYS):
        self.by_words = WordEncoder(splitter, width, limit)
        self.splitter, self.type, self.end_id, self.limit = splitter, np.dtype(f"<u{width}"), end_id, limit
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.ids, self.starts, self.sizes = np.zeros(0, self.type), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _places(self, pieces: list[str]) -> np.ndarray:
        """Where the (different) pieces are in the table; new ones are encoded by the library."""
        if len(self.place) > self.limit:
            self._forget()
        new = [p for p in pieces if p not in self.place]
        if new:
            code = self.by_words.model.encode(new, is_pretokenized=True, add_special_tokens=False)
            sizes = np.bincount(np.array(code.word_ids, np.int64), minlength=len(new)) if len(code.ids) else np.zeros(len(new), np.int64)
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new)), strict=True))
            self.starts = np.append(self.starts, len(self.ids) + np.cumsum(sizes) - sizes)
            self.sizes = np.append(self.sizes, sizes)
            self.ids = np.append(self.ids, np.array(code.ids, self.type))
        return np.fromiter(map(self.place.__getitem__, pieces), np.int64, len(pieces))

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, sizes and ids of the words' runs of ids; A-Z are lower-cased already."""
        whole = pc.ascii_is_alpha(words)  # one piece each
        is_whole = whole.to_numpy(zero_copy_only=False)
        rest = words.filter(pc.invert(whole)).to_pylist()
        simple, other = [], []
        for i, w in enumerate(rest):
            (simple if w.isascii() or max(w) < "\u0100" else other).append(i)  # below U+0100 all letters are composed
        found = self.splitter.find_simple("".join([f"{rest[i]} {self.MARK} " for i in simple]).lower())
        for i in other:
            found += self.splitter.plain(rest[i])
            found.append(self.MARK)
        coded = pa.concat_arrays([words.filter(whole), pa.array([*found, self.MARK], pa.string())]).dictionary_encode()
        different, number = coded.dictionary.to_pylist(), coded.indices.to_numpy()[:-1]
        mark = coded.indices[-1].as_py()
        places = self._places(different)
        sizes = self.sizes[places]
        sizes[mark] = 0
        ids, n = gathered(self.starts[places], sizes, self.ids, number)
        n_whole = len(words) - len(rest)
        last = np.r_[np.arange(n_whole), n_whole + np.flatnonzero(number[n_whole:] == mark)]  # of each word
        upto = np.cumsum(n)[last]
        order = np.r_[np.flatnonzero(is_whole), np.flatnonzero(~is_whole)[np.array(simple + other, np.int64)]]
        starts, length = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        starts[order], length[order] = np.r_[0, upto[:-1]], np.diff(np.r_[0, upto])
        return starts, length, ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, run together, and how many each text has."""
        odd = pc.match_substring(texts, self.MARK)
        for name in self.splitter.special:
            odd = pc.or_(odd, pc.match_substring(texts, name))
        strange = [np.frombuffer(code, self.type) for code in
                   self.by_words.encode([self.splitter.words(t) for t in texts.filter(odd).to_pylist()])]
        split = pc.ascii_split_whitespace(pc.ascii_lower(pc.if_else(odd, "", texts)))
        coded = split.flatten().dictionary_encode()
        starts, sizes, ids = self._words(coded.dictionary) if len(coded) else (np.zeros(0, np.int64),) * 2 + (self.ids[:0],)
        # further runs: each strange text, and the end id
        more = [*strange, np.array([self.end_id], self.type)]
        lengths = np.array([len(m) for m in more])
        sizes, starts = np.append(sizes, lengths), np.append(starts, len(ids) + np.cumsum(lengths) - lengths)
        ids = np.concatenate([ids, *more])
        is_odd = odd.to_numpy(zero_copy_only=False)
        ends = np.asarray(split.offsets)[1:] - split.offsets[0].as_py()
        tails = np.full(len(texts) + len(strange), len(sizes) - 1)  # the end id, before it a strange text's run
        tails[np.flatnonzero(is_odd) + np.arange(len(strange))] = len(sizes) - 1 - len(strange) + np.arange(len(strange))
        which = np.insert(coded.indices.to_numpy(), np.repeat(ends, 1 + is_odd), tails)
        out, n = gathered(starts, sizes, ids, which)
        texts_end = ends + np.cumsum(1 + is_odd)
        upto = np.r_[0, np.cumsum(n)]
        return out, np.diff(np.r_[0, upto[texts_end]])


def id_width(spec: str) -> int:
    model = json.loads(spec)
    top = max([*model["model"]["vocab"].values(), *(t["id"] for t in model["added_tokens"])])
    return 2 if top < 1 << 16 else 4


def _file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The store of ``uri`` (any scheme that Arrow knows) and the path in it."""
    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def pack_shard(ids: bytes, width: int, ends: np.ndarray, doc_ids: list[int | None]) -> bytes:
    bounds = EliasFano.encode(ends).to_bytes()
    known = np.array([d is not None for d in doc_ids], np.uint8)
    named = np.array([d or 0 for d in doc_ids], "<i8")
    head = struct.pack(_HEAD, MAGIC, width, len(doc_ids), len(ids) // width, len(bounds))
    return head + ids + bounds + named.tobytes() + known.tobytes()


class Shard:
    """One file's documents; ``document(i)`` reads two boundaries by select."""

    def __init__(self, data: bytes):
        magic, self.width, self.n_docs, self.n_ids, bounds = struct.unpack_from(_HEAD, data)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at = struct.calcsize(_HEAD)
        self.ids = np.frombuffer(data, f"<u{self.width}", self.n_ids, at)
        at += self.n_ids * self.width
        self.ends = EliasFano.from_bytes(data[at:at + bounds])
        named = np.frombuffer(data, "<i8", self.n_docs, at + bounds)
        known = np.frombuffer(data, np.uint8, self.n_docs, at + bounds + 8 * self.n_docs)
        self.doc_ids = [int(d) if k else None for d, k in zip(named, known, strict=True)]

    def bounds(self, i: int) -> tuple[int, int]:
        return (self.ends.select(i - 1) if i else 0), self.ends.select(i)

    def document(self, i: int) -> np.ndarray:
        start, end = self.bounds(i)
        return self.ids[start:end]


def write_tokens(docs: DataFrame, vocabulary: str, out_dir: str, end_id: int = 2, shard_ids: int = SHARD_IDS,
                 id_col: str = "doc_id", text_col: str = "text", order: Sequence[Column] | None = None) -> str:
    """Writes shards and ``manifest`` under ``out_dir`` (shared storage).

    ``order`` gives columns whose ascending values order the documents; none: ascending ids.
    """
    spark = docs.sparkSession
    with open(vocabulary, encoding="utf-8") as f:
        text = f.read()
    spec, width = spark.sparkContext.broadcast(text), id_width(text)
    store, root = _file_system(out_dir)
    store.create_dir(f"{root}/shards", recursive=True)
    text_of = F.coalesce(F.col(text_col), F.lit(""))
    if order is None:  # equal rows are dealt by their place in the input: any order of these is the same
        order = [F.col(id_col).cast("long"), F.substring(text_of, 1, 32), F.xxhash64(text_of), F.monotonically_increasing_id()]
    keys = [f"order{i}" for i in range(len(order))]
    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of.alias("text"), *[c.alias(k) for c, k in zip(order, keys, strict=True)])
    ordered = kept.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = PieceSplitter(spec.value)
        encoder = SliceEncoder(splitter, width, end_id)
        splitter.spec.clear()  # the model has it
        target, folder = _file_system(out_dir)
        buffer, ends, doc_ids, seq = bytearray(), [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal seq
            name = f"shards/{uuid.uuid4().hex}.tids"
            with target.open_output_stream(f"{folder}/{name}") as out:
                out.write(pack_shard(bytes(buffer), width, np.array(ends), doc_ids))
            row = pa.RecordBatch.from_pydict({"seq": [seq], "file": [name], "n_docs": [len(ends)],
                                              "n_ids": [len(buffer) // width]}, schema=_MANIFEST)
            seq += 1
            buffer.clear(), ends.clear(), doc_ids.clear()
            return row

        for batch in chunks(batches, "text", SLICE_BYTES):
            ids, sizes = encoder.encode(batch.column(1))
            data, at = memoryview(ids.tobytes()), 0
            for doc_id, n in zip(batch.column(0).to_pylist(), sizes.tolist(), strict=True):
                if ends and len(buffer) // width + n > shard_ids:
                    yield flush()
                buffer += data[at:at + n * width]
                at += n * width
                ends.append(len(buffer) // width)
                doc_ids.append(doc_id)
        if ends:
            yield flush()

    rows = ordered.mapInArrow(write, "seq int, file string, n_docs long, n_ids long")
    rows.withColumn("part", F.spark_partition_id()).write.parquet(f"{out_dir}/manifest")
    return out_dir


_MANIFEST = pa.schema([("seq", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])


def read_tokens(spark: SparkSession, out_dir: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` read back from the shards.

    The starts of shards are a running sum over the manifest, which has one row
    for each 4 million ids; documents are read from the files by the tasks.
    """
    manifest = spark.read.schema("seq int, file string, n_docs long, n_ids long, part int").parquet(f"{out_dir}/manifest")
    earlier = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0).cast("long")))
    shards = shards.select("file", "base").repartition(max(1, manifest.count()))  # a task a shard

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _file_system(out_dir)
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with store.open_input_file(f"{root}/{name}") as f:
                    shard = Shard(f.read())
                for at in range(0, shard.n_docs, 4096):
                    ends = shard.ends.select_range(at, min(at + 4096, shard.n_docs))
                    starts = np.concatenate([[shard.bounds(at)[0]], ends[:-1]])
                    crc = [zlib.crc32(shard.ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts, ends, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(shard.doc_ids[at:at + len(ends)], pa.int64()), pa.array(starts + base),
                         pa.array(ends - starts), pa.array(crc, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"])

    return shards.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")

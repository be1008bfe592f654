"""Benchmark decontamination by a prefix-filtered set join.

An item's window is ``window`` consecutive words (a shorter item is one window).
A window is the set of its word shingles, and a document holds it only if it
holds them all, so with the shingles ordered by rarity in the corpus the
necessary prefix is one token: the rarest. The steps:

1. corpus shingles that occur in the benchmark are found with their position,
   the document's length and the words around them (one scan of the texts);
2. counting them gives the rarity order and each window's prefix token;
3. occurrences join windows on the prefix token; the token's offset in the
   window fixes where the window would start, and starts outside the document
   are dropped (positional and length bounds);
4. the words around the token are compared with the window's, word for word.

Only step 1 sees every word. It numbers the words of a text that any shingle
has, and looks up runs of numbers with numpy. The benchmark's shingles are sent
to it in blocks of a counted size, so no text is ever shuffled, however large
the benchmark is; each further block costs one more scan.

Results: null texts have no words. Repeated document rows each get their result.
A null item id is the id ''. Without documents, items or hits the counts are 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchtrace.llm.common import chunks, fresh, small_side, stored

#: Words once A-Z are lower case.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The same in UTF-8 bytes: lower case, and a space for all that no word has.
_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
               for b in range(256))
#: Words of a shingle; an item of fewer words is one shingle.
SHINGLE = 5
#: Shingles sent to the tasks at once: some 40 MB.
BLOCK_SHINGLES = 500_000
_NO_ITEMS = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"  # SHA-256 of nothing


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit(WORD), F.lit(0))


def item_windows(items: DataFrame, window: int, item_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Distinct windows ``(window_text, length, offset, shingle)`` and ``(window_text, item)``."""
    words = items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                         _words(F.col(text_col)).alias("words")).filter(F.size("words") > 0)
    cut = words.withColumn("length", F.least(F.size("words"), F.lit(window)))
    at = cut.select("item", "words", "length",
                    F.explode(F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)).alias("start"))
    windows = at.select("item", "length", F.slice("words", F.col("start"), F.col("length")).alias("run"))
    of_item = windows.select("item", F.array_join("run", " ").alias("window_text")).distinct()
    distinct = windows.select(F.array_join("run", " ").alias("window_text"), "length", "run").dropDuplicates(["window_text"])
    size = F.least("length", F.lit(SHINGLE))
    runs = F.transform(F.sequence(F.lit(1), F.col("length") - size + 1),
                       lambda i: F.array_join(F.slice("run", i, size), " "))
    return distinct.select("window_text", "length", F.posexplode(runs).alias("offset", "shingle")), of_item


class ShingleTable:
    """Shingles by the numbers of their words; finds them in a numbered text."""

    def __init__(self, shingles: list[bytes]):
        split = [s.split(b" ") for s in shingles]
        self.number = {w: i for i, w in enumerate(sorted({w for s in split for w in s}), 1)}
        self.by_size = {k: np.sort(np.array([self._code([np.uint64(self.number[w]) for w in s]) for s in split if len(s) == k]))
                        for k in {len(s) for s in split}}

    @staticmethod
    def _code(numbers: list) -> np.ndarray:
        with np.errstate(over="ignore"):
            return reduce(lambda h, x: h * np.uint64(0x9E3779B97F4A7C15) + x, numbers, np.uint64(0))

    def find(self, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """``(position, size)`` of every run of words that has a shingle's code."""
        numbers = np.fromiter(map(self.number.get, words, repeat(0)), np.uint64, len(words))
        known = numbers > 0
        for k, codes in self.by_size.items():
            n = len(words) - k + 1
            if n > 0:
                whole = reduce(np.logical_and, (known[j:n + j] for j in range(k)))
                at = np.flatnonzero(whole)
                if len(at):
                    code = self._code([numbers[at + j] for j in range(k)])
                    near = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
                    yield from ((int(p), k) for p in at[codes[near] == code])


def _scan(docs: DataFrame, shingles: list[bytes], window: int) -> DataFrame:
    """Step 1: per document its number of words and the shingles found, with the words around them."""
    sent = docs.sparkSession.sparkContext.broadcast(shingles)
    hit = pa.struct([("pos", pa.int32()), ("shingle", pa.string()), ("first", pa.int32()), ("around", pa.list_(pa.string()))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ShingleTable(sent.value)
        for batch in chunks(batches, "text"):
            sizes, hits = [], []
            for text in batch.column(2).cast(pa.binary()).to_pylist():
                words = text.translate(_BYTES).split()
                sizes.append(len(words))
                hits.append([{"pos": p, "shingle": b" ".join(words[p:p + k]).decode(), "first": max(0, p - window + 1),
                              "around": [w.decode() for w in words[max(0, p - window + 1):p + window]]}
                             for p, k in table.find(words)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(hits, pa.list_(hit))],
                ["doc_id", "text_hash", "n_words", "hits"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(scan, f"doc_id {kind}, text_hash long, n_words long, "
                                 "hits array<struct<pos: int, shingle: string, first: int, around: array<string>>>")


def find_windows(docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id",
                 text_col: str = "text", item_col: str = "item_id",
                 block_shingles: int = BLOCK_SHINGLES) -> tuple[DataFrame, DataFrame]:
    """``doc_id, text_hash, n_words`` of every row, and ``doc_id, text_hash, start, length, item``
    of every item window in every document."""
    of_docs = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                          F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    shingles, of_item = item_windows(items, window, item_col, text_col)
    shingles = stored(shingles, "windows")
    distinct = stored(shingles.select("shingle").distinct(), "shingles")
    blocks = max(1, -(-distinct.count() // block_shingles))
    part = F.pmod(F.xxhash64("shingle"), F.lit(blocks))
    scans = [stored(_scan(of_docs, sorted(r.shingle.encode() for r in distinct.filter(part == b).toLocalIterator()), window), "scan")
             for b in range(blocks)]
    found = reduce(DataFrame.unionAll, scans).select("doc_id", "text_hash", "n_words", F.inline("hits"))
    rarity = found.groupBy("shingle").agg(F.count(F.lit(1)).alias("times"))
    prefix = shingles.join(rarity, "shingle", "left").groupBy("window_text", "length").agg(
        F.min(F.struct(F.coalesce("times", F.lit(0)).alias("times"), "shingle", "offset")).alias("rarest")) \
        .filter(F.col("rarest.times") > 0) \
        .select("window_text", "length", F.col("rarest.shingle").alias("shingle"), F.col("rarest.offset").alias("offset"))
    candidates = found.join(small_side(stored(prefix, "prefix")), "shingle") \
        .withColumn("start", F.col("pos") - F.col("offset")) \
        .filter((F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.col("n_words")))
    same = F.array_join(F.slice("around", F.col("start") - F.col("first") + 1, F.col("length")), " ")
    verified = candidates.filter(same == F.col("window_text"))
    windows = verified.join(small_side(stored(of_item, "items")), "window_text") \
        .select("doc_id", "text_hash", "start", "length", "item")
    return scans[0].select("doc_id", "text_hash", "n_words"), windows


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """Per document: words, words hit, items found, their digest, and whether any was hit."""
    counted, found = find_windows(docs, items, window, id_col, text_col, item_col)
    found = stored(found, "found")
    key = ["doc_id", "text_hash"]
    hit = found.select(*key, "start", "length").distinct() \
        .select(*key, F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("word")).distinct() \
        .groupBy(*key).agg(F.count(F.lit(1)).alias("n_hit"))
    items_of = found.select(*key, "item").distinct().groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_items"), F.array_sort(F.collect_list("item")).alias("ids"))
    both = hit.join(items_of, [hit.doc_id.eqNullSafe(items_of.doc_id), hit.text_hash == items_of.text_hash]).select(
        hit.doc_id.alias("hit_doc"), hit.text_hash.alias("hit_hash"), "n_hit", "n_items",
        F.sha2(F.array_join("ids", ","), 256).alias("sha"))
    hits = small_side(stored(both, "hits"))
    joined = counted.join(hits, [counted.doc_id.eqNullSafe(hits.hit_doc), counted.text_hash == hits.hit_hash], "left")
    return joined.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("sha", F.lit(_NO_ITEMS)).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """The documents in which no item's window occurs, with all their columns."""
    _, found = find_windows(docs, items, window, id_col, text_col, item_col)
    hits = small_side(stored(found.select(F.col("doc_id").alias("hit_doc"), F.col("text_hash").alias("hit_hash"))
                             .distinct(), "hits"))
    (h,) = fresh(docs, "text_hash")
    keyed = docs.withColumn(h, F.xxhash64(text_col))
    return keyed.join(hits, [keyed[id_col].eqNullSafe(hits.hit_doc), keyed[h] == hits.hit_hash], "left_anti").drop(h)


ORACLE_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
items AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
cut AS (SELECT item, words, least(len(words), 10) AS n FROM items WHERE len(words) > 0),
windows AS (
  SELECT DISTINCT item, n, array_to_string(words[s:s + n - 1], ' ') AS w
  FROM (SELECT *, unnest(range(1, len(words) - n + 2)) AS s FROM cut)),
places AS (
  SELECT r, n, s, array_to_string(words[s:s + n - 1], ' ') AS w
  FROM (SELECT r, words, n, unnest(range(1, len(words) - n + 2)) AS s
        FROM docs, (SELECT DISTINCT n FROM cut) WHERE len(words) >= n)),
found AS (SELECT p.r, p.s, p.n, i.item FROM places p JOIN windows i ON p.w = i.w AND p.n = i.n),
hit AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS k FROM found) GROUP BY r),
of_items AS (
  SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS sha
  FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit,
       coalesce(i.n_items, 0)::BIGINT AS n_items, coalesce(i.sha, sha256('')) AS items_sha256,
       h.n_hit IS NOT NULL AS contaminated
FROM docs d LEFT JOIN hit h ON d.r = h.r LEFT JOIN of_items i ON d.r = i.r
"""

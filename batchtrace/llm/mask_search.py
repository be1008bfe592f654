"""Ranked lexical search by presence-mask grouping.

Pass 1 reads every whole text once and stores, per document, its length and the
counts of those of its terms that some item asks for. From these come the corpus
totals, the documents per term and the term weights.

Pass 2 takes the stored counts block by block. For an item, one bitmap a term says
which documents of the block hold it; turned over, they give each document its mask
of matched terms, and documents are grouped by mask. A mask's maximum score adds up
the best factor in the block of each of its terms. Masks are evaluated by descending
maximum, until the next maximum is below the k-th score that the item has in this
task already: no document of the masks left can enter the list. The tasks' lists are
joined by a ranked window, which sees at most ``top`` rows an item and task.

Items are taken in blocks of ``BLOCK_TERMS`` terms, with both passes for each block,
so what is sent to the tasks (and comes from the benchmark over the driver) has a
bound. Memory of a task is one block of documents and ``top`` rows an item.

Results: a null text has no terms; a document or item without terms is in no row,
nor is a document whose score is 0. Equal scores are ranked by ascending doc_id, null
ids first. Rows of one doc_id are documents of their own, rows of one item_id items
of their own. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from batchtrace.llm.common import checkpointed, chunks, stored

#: Item terms that one pass sends to its tasks, and documents grouped at once.
BLOCK_TERMS, BLOCK_DOCS = 200_000, 4_096
#: Bytes of terms (digits, letters, all beyond ASCII; A-Z lower-cased); others part them.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(data: bytes) -> list[bytes]:
    return data.translate(_BYTES).split()


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item_id, terms``: every item's different terms."""
    kept = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("binary").alias("text")) \
        .filter(F.col("text").isNotNull())

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text"):
            terms = [sorted(set(terms_of(t))) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(terms, pa.list_(pa.binary()))], ["item_id", "terms"])

    return kept.mapInArrow(split, "item_id long, terms array<binary>").filter(F.size("terms") > 0)


def item_blocks(wanted: DataFrame, size: int) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """The items in blocks of about ``size`` terms, or one item."""
    block, held = [], 0
    for r in wanted.toLocalIterator():
        if block and held + len(r["terms"]) > size:
            yield block
            block, held = [], 0
        block.append((r["item_id"], [bytes(t) for t in r["terms"]]))
        held += len(r["terms"])
    if block:
        yield block


def postings(docs: DataFrame, numbers: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n, terms, times`` of every document with terms: all its terms counted, those in ``numbers`` listed."""
    sent = docs.sparkSession.sparkContext.broadcast(numbers)
    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")) \
        .filter(F.col("text").isNotNull())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for b in chunks(batches, "text"):
            sizes, terms, times = [], [], []
            for data in b.column(1).to_pylist():
                found = terms_of(data)
                counts = Counter(found)
                asked = known.keys() & counts.keys()
                sizes.append(len(found))
                terms.append([known[t] for t in asked])
                times.append([counts[t] for t in asked])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int64()))],
                ["doc_id", "n", "terms", "times"])

    return kept.mapInArrow(count, "doc_id long, n long, terms array<int>, times array<long>").filter(F.col("n") > 0)


def weight(n_docs: int, holders: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders + 1)))


class DocumentBlock:
    """Counts of a block of documents, term by term."""

    def __init__(self, ids: pa.Array, sizes: np.ndarray, terms: pa.Array, times: pa.Array, n_docs: int, n_terms: int):
        self.known = ~np.asarray(ids.is_null())
        self.ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
        length = 100 - 90 + 90 * sizes * n_docs // n_terms
        ends = np.asarray(terms.offsets)
        flat = terms.values.to_numpy(zero_copy_only=False)[ends[0]:ends[-1]]
        at = np.asarray(times.offsets)
        tf = times.values.to_numpy(zero_copy_only=False)[at[0]:at[-1]]
        holder = np.repeat(np.arange(len(sizes)), np.diff(ends))
        factor = 1_000_000_000 * tf // (1000 * tf + 8 * length[holder])
        order = np.argsort(flat, kind="stable")
        self.holder, self.factor = holder[order], factor[order]
        self.terms, self.starts = np.unique(flat[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(order))
        self.most = np.maximum.reduceat(self.factor, self.starts) if len(order) else self.factor

    def of_item(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Which of the (ascending) terms occur here, their best factors, and
        the place among these and the position of every count."""
        at = np.searchsorted(self.terms, numbers)
        here = np.flatnonzero((at < len(self.terms)) & (self.terms[np.minimum(at, len(self.terms) - 1)] == numbers)) \
            if len(self.terms) else np.zeros(0, np.int64)
        at = at[here]
        sizes = self.ends[at] - self.starts[at]
        which = np.repeat(np.arange(len(at)), sizes)
        position = np.arange(sizes.sum()) + np.repeat(self.starts[at] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) \
            if len(at) else np.zeros(0, np.int64)
        return here, self.most[at], which, position


def group_by_mask(held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps (terms x documents, bool) to each document's group of equal masks and a document of each group."""
    n_terms, n = held.shape
    masks = np.zeros((-(-n_terms // 64) * 8, n), np.uint8)
    masks[:-(-n_terms // 8)] = np.packbits(held, axis=0, bitorder="little")
    words = np.ascontiguousarray(masks.T).view("<u8")
    first, group = np.unique(words[:, 0], return_index=True, return_inverse=True)[1:]
    for k in range(1, words.shape[1]):
        wide, narrow = np.unique(words[:, k], return_inverse=True)
        first, group = np.unique(group * len(wide) + narrow, return_index=True, return_inverse=True)[1:]
    return group, first


class TopList:
    """The best documents of one item so far."""

    __slots__ = ("scores", "ids", "known", "top")

    def __init__(self, top: int):
        self.top = top
        self.scores, self.ids, self.known = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def least(self) -> int:
        """A score below this cannot enter; scores of 0 never do."""
        return max(1, int(self.scores[-1])) if len(self.scores) == self.top else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        s, i, k = np.append(self.scores, scores), np.append(self.ids, ids), np.append(self.known, known)
        best = np.lexsort((i, k, -s))[:self.top]
        self.scores, self.ids, self.known = s[best], i[best], k[best]


def search_block(block: DocumentBlock, numbers: np.ndarray, weights: np.ndarray, best: TopList) -> int:
    """Enters the block's documents into an item's list; returns how many were scored."""
    here, most, which, position = block.of_item(numbers)
    if not len(here):
        return 0
    holder, w = block.holder[position], weights[here]
    matched, holder = np.unique(holder, return_inverse=True)
    held = np.zeros((len(here), len(matched)), bool)
    held[which, holder] = True
    group, first = group_by_mask(held)
    maximum = (w * most) @ held[:, first].astype(np.int64)
    order = np.argsort(-maximum, kind="stable")
    maximum, filled = maximum[order], np.cumsum(np.bincount(group)[order])
    place = np.empty(len(order), np.int64)  # of each group by maximum
    place[order] = np.arange(len(order))
    value, place = w[which] * block.factor[position], place[group]
    done, scored = 0, 0
    while (limit := int(np.searchsorted(-maximum, -best.least(), side="right"))) > done:
        goal = max(best.top, scored)  # masks of a full list first, then of as many documents again
        upto = min(limit, int(np.searchsorted(filled, (filled[done - 1] if done else 0) + goal)) + 1)
        chosen = np.flatnonzero((place >= done) & (place < upto))
        inside = np.zeros(len(matched), bool)
        inside[chosen] = True
        some = inside[holder]
        score = np.zeros(len(matched), np.int64)
        np.add.at(score, holder[some], value[some])
        enter = chosen[score[chosen] >= best.least()]
        best.add(score[enter], block.ids[matched[enter]], block.known[matched[enter]])
        done, scored = upto, scored + len(chosen)
    return scored


def search(docs: DataFrame, items: DataFrame, top: int = 10, id_col: str = "doc_id", text_col: str = "text",
           block_terms: int = BLOCK_TERMS, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """``item_id, rank, doc_id, score``: every item's ``top`` documents with a score above 0."""
    spark = docs.sparkSession
    out: DataFrame | None = None
    for block in item_blocks(stored(item_terms(items), "item-terms"), block_terms):
        terms = sorted(set().union(*(t for _, t in block)))
        numbers = {t: i for i, t in enumerate(terms)}
        counted = stored(postings(docs, numbers, id_col, text_col), "postings")
        totals = counted.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        weights = np.zeros(len(terms), np.int64)
        for r in counted.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():
            weights[r["t"]] = weight(totals["docs"], r["count"])
        asked = [np.array(sorted(numbers[t] for t in own), np.int64) for _, own in block]
        sent = spark.sparkContext.broadcast((weights, asked, [i for i, _ in block], totals["docs"], totals["terms"]))

        def best_here(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            w, wanted, item_ids, n_docs, n_terms = sent.value
            lists = [TopList(top) for _ in wanted]
            for b in batches:
                for at in range(0, b.num_rows, block_docs):
                    part = b.slice(at, block_docs)
                    held = DocumentBlock(part.column(0), part.column(1).to_numpy(), part.column(2), part.column(3), n_docs, n_terms)
                    for own, best in zip(wanted, lists, strict=True):
                        search_block(held, own, w[own], best)
            for at in range(0, len(lists), 1000):
                some = lists[at:at + 1000]
                sizes = [len(x.scores) for x in some]
                number = np.repeat(np.arange(at, at + len(some)), sizes)
                ids, known = np.concatenate([x.ids for x in some]), np.concatenate([x.known for x in some])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number), pa.array([item_ids[i] for i in number], pa.int64()),
                     pa.array(ids, pa.int64(), mask=~known), pa.array(np.concatenate([x.scores for x in some]))],
                    ["item", "item_id", "doc_id", "score"])

        found = counted.mapInArrow(best_here, "item long, item_id long, doc_id long, score long")
        order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
        ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
        ranked = checkpointed(ranked.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
        out = ranked if out is None else out.unionAll(ranked)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")


_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\x{80}-\x{10FFFF}]+')"""

ORACLE_SQL = f"""
WITH words AS (
  SELECT row, doc_id, unnest(terms) AS term FROM (
    SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL)),
sizes AS (SELECT row, doc_id, count(*) AS n FROM words GROUP BY row, doc_id),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes),
asked AS (
  SELECT DISTINCT item, item_id, unnest(terms) AS term FROM (
    SELECT row_number() OVER () AS item, item_id, {_TERMS} AS terms FROM benchmark WHERE text IS NOT NULL)),
counts AS (
  SELECT row, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY row, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), totals),
lengths AS (SELECT row, doc_id, 100 - 90 + (90 * n * docs) // terms AS m FROM sizes, totals),
scores AS (
  SELECT item, item_id, doc_id, row, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN lengths USING (row)
  GROUP BY item, item_id, doc_id, row),
ranked AS (
  SELECT item_id, doc_id, score,
         row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id ASC NULLS FIRST)::INTEGER AS rank
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

"""Hard negatives by a residue-number-system matrix product and windowed selection.

Components are whole numbers (``floor(scale * x)``). Scores, their inner products,
are computed modulo several small primes: both matrices are reduced to balanced
residues, multiplied in float32, where every partial sum stays below 2^24 and so is
exact, and the residues of each product are joined by the Chinese remainder theorem
to the exact signed score. As many primes are taken as twice the largest possible
score needs (from the largest vector norm of the table).

Anchors, a stated set of rows, go against all rows in blocks: each task goes through
its rows slice by slice and keeps, per anchor, the best few so far, so its memory is
a block of anchors and a slice of rows. Pass 1 finds each anchor's positives, its
best rows of the same label. Pass 2 selects, for every positive, the best rows of
another label whose score lies in the positive's window. The tasks' bests are joined
per anchor (or anchor and positive) by a ranked window.

Results: rows with a null label, a null vector or a component that is null or not
finite take no part. A shorter vector has zeros for what it lacks. Rows with one
``vec_id`` are rows of their own; none of them is a positive of an anchor with that
id; rows without an id take no part. An anchor without positives, or a positive without rows in its window, gives no
row. Scores that do not fit 62 bits are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchtrace.llm.common import checkpointed, stored

#: Anchors of one pass, and rows of one slice of a task's product.
BLOCK_ANCHORS, SLICE_ROWS = 4_096, 1_024
#: float32 adds whole numbers exactly below this.
_EXACT = 1 << 24


def primes_below(top: int) -> Iterator[int]:
    """Primes, largest first."""
    for n in range(top, 2, -1):
        if all(n % d for d in range(2, int(n ** 0.5) + 1)):
            yield n


def choose_moduli(width: int, bound: int) -> list[int]:
    """Primes whose products of ``width`` balanced residues are exact in float32
    and that together tell all whole numbers from -bound to bound apart."""
    half = max(1, int((_EXACT / max(width, 1)) ** 0.5))
    out, product = [], 1
    for p in primes_below(min(2 * half - 1, 4093)):
        if product > 2 * bound:
            break
        out.append(p)
        product *= p
    if product <= 2 * bound or product >= 1 << 63:
        raise ValueError(f"scores up to {bound} do not fit the residue system")
    return out


def residues(matrix: np.ndarray, moduli: list[int]) -> list[np.ndarray]:
    """The matrix modulo each prime as float32, balanced around zero."""
    out = []
    for p in moduli:
        r = matrix % p
        out.append(np.where(r > p // 2, r - p, r).astype(np.float32))
    return out


def exact_products(left: list[np.ndarray], right: list[np.ndarray], moduli: list[int]) -> np.ndarray:
    """left @ right.T as exact signed int64 from the residues, digit by digit (mixed radix)."""
    total, radix = None, 1
    for a, b, p in zip(left, right, moduli, strict=True):
        r = (a @ b.T).astype(np.int64) % p
        if total is None:
            total = r
        else:  # the digit that makes the sum agree modulo p too
            total += radix * ((r - total) % p * pow(radix, -1, p) % p)
        radix *= p
    return np.where(total > radix // 2, total - radix, total)


def prepare(vectors: DataFrame, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding",
            label_col: str = "label", label: Column | None = None) -> DataFrame:
    """``vec_id, label, parts`` (whole numbers) of the rows that take part."""
    x, name = F.col(vector_col), F.col(label_col) if label is None else label
    whole = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    return vectors.filter(F.col(label_col).isNotNull() & x.isNotNull() & F.col(id_col).isNotNull()).filter(whole).select(
        F.col(id_col).cast("long").alias("vec_id"), name.cast("long").alias("label"),
        F.transform(x, lambda c: F.floor(c.cast("double") * F.lit(float(scale)))).alias("parts"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as an int64 matrix, short rows filled with zeros."""
    ends = np.asarray(column.offsets)
    values = column.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(ends)
    if width and len(sizes) and (sizes == width).all():
        return values[ends[0]:ends[-1]].reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    for i, n in enumerate(sizes):
        out[i, :n] = values[ends[i]:ends[i] + n]
    return out


class Best:
    """The best ``k`` (score, id) of each of ``n`` lists: higher scores, then smaller ids."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.scores = np.zeros((n, 0), np.int64)
        self.ids = np.zeros((n, 0), np.int64)
        self.known = np.zeros((n, 0), bool)

    def floor(self) -> np.ndarray:
        """Per list the score that a new row must reach; none yet: the least number."""
        low = np.iinfo(np.int64).min
        if self.scores.shape[1] < self.k:
            return np.full(len(self.scores), low)
        return np.where(self.known[:, -1], self.scores[:, -1], low)

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Entries as (list number, score, id)."""
        if not len(rows):
            return
        order = np.lexsort((ids, -scores, rows))
        rows, scores, ids = rows[order], scores[order], ids[order]
        starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        place = np.arange(len(rows)) - np.repeat(starts, np.diff(np.r_[starts, len(rows)]))
        keep = place < self.k
        rows, scores, ids, place = rows[keep], scores[keep], ids[keep], place[keep]
        touched = np.unique(rows)
        at = np.searchsorted(touched, rows)
        new = [np.zeros((len(touched), self.k), t) for t in (np.int64, np.int64, bool)]
        new[0][at, place], new[1][at, place], new[2][at, place] = scores, ids, True
        if self.scores.shape[1] < self.k:
            short = ((0, 0), (0, self.k - self.scores.shape[1]))
            self.scores, self.ids, self.known = (np.pad(x, short) for x in (self.scores, self.ids, self.known))
        s, i, k = (np.concatenate([old[touched], x], axis=1) for old, x in zip((self.scores, self.ids, self.known), new, strict=True))
        best = np.lexsort((i, -s, ~k), axis=1)[:, :self.k]
        self.scores[touched], self.ids[touched], self.known[touched] = (np.take_along_axis(x, best, 1) for x in (s, i, k))

    def batch(self, more: dict[str, np.ndarray]) -> pa.RecordBatch:
        """All kept entries as rows ``list, vec_id, score`` and, per list, the given columns."""
        n, place = np.nonzero(self.known)
        columns = {"list": n} | {c: v[n] for c, v in more.items()}
        return pa.RecordBatch.from_pydict({c: pa.array(v, pa.int64()) for c, v in columns.items()} |
                                          {"vec_id": pa.array(self.ids[n, place]), "score": pa.array(self.scores[n, place])})


def _best_of(tasks: DataFrame, k: int) -> DataFrame:
    """The best ``k`` entries of each list over all tasks, ranked from 1."""
    order = Window.partitionBy("list").orderBy(F.col("score").desc(), "vec_id")
    return tasks.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _anchor_blocks(rows: DataFrame, every: int, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, list]]:
    """Ids, labels and components of the anchors, a block at a time."""
    block: list = []
    chosen = rows.filter(F.col("vec_id") % every == 0)
    dealt = stored(chosen.repartition(chosen.count() // size + 1), "anchors")  # about a block a partition
    for r in dealt.toLocalIterator():
        block.append(r)
        if len(block) == size:
            yield _as_block(block)
            block = []
    if block:
        yield _as_block(block)


def _as_block(rows: list) -> tuple[np.ndarray, np.ndarray, list]:
    return (np.array([r["vec_id"] for r in rows], np.int64), np.array([r["label"] for r in rows], np.int64),
            [r["parts"] for r in rows])


def _slices(batches: Iterator[pa.RecordBatch], width: int, anchors: list[np.ndarray], moduli: list[int],
            slice_rows: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, labels and scores (anchors x rows) of the rows, slice by slice."""
    for b in batches:
        for at in range(0, b.num_rows, slice_rows):
            part = b.slice(at, slice_rows)
            right = residues(_matrix(part.column(2), width), moduli)
            yield part.column(0).to_numpy(), part.column(1).to_numpy(), exact_products(anchors, right, moduli)


def mine(rows: DataFrame, anchor_every: int = 100, n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90,
         block_anchors: int = BLOCK_ANCHORS, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows`` as ``prepare`` gives them; anchors are those whose id ``anchor_every``
    divides. Negatives of a positive satisfy ``low * p <= 100 * n <= high * p``.
    """
    spark = rows.sparkSession
    rows = stored(rows, "whole-vectors")
    facts = rows.agg(F.coalesce(F.max(F.size("parts")), F.lit(0)).alias("width"),
                     F.coalesce(F.max(F.aggregate("parts", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))),
                                F.lit(0.0)).alias("norm")).first()
    width, bound = facts["width"], int(facts["norm"] * 1.0001) + 1  # |a.b| is at most the larger norm squared
    moduli = choose_moduli(width, bound) if width else [2]
    out: DataFrame | None = None
    for ids, labels, parts in _anchor_blocks(rows, anchor_every, block_anchors):
        matrix = np.zeros((len(ids), width), np.int64)
        for i, p in enumerate(parts):
            matrix[i, :len(p)] = p
        sent = spark.sparkContext.broadcast((ids, labels, matrix))

        def positives(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            a_ids, a_labels, a_matrix = sent.value
            anchors, best = residues(a_matrix, moduli), Best(len(a_ids), n_positives)
            for row_ids, row_labels, scores in _slices(batches, width, anchors, moduli, slice_rows):
                fit = (a_labels[:, None] == row_labels) & (a_ids[:, None] != row_ids) & (scores >= best.floor()[:, None])
                n, r = np.nonzero(fit)
                best.add(n, scores[n, r], row_ids[r])
            yield best.batch({})

        found = _best_of(rows.mapInArrow(positives, "list long, vec_id long, score long"), n_positives)
        pairs = [(r["list"], r["vec_id"], r["score"]) for r in found.toLocalIterator()]  # n_positives an anchor at most
        if not pairs:
            continue
        pairs.sort()
        sent_pairs = spark.sparkContext.broadcast(tuple(np.array(c, np.int64) for c in zip(*pairs, strict=True)))

        def negatives(batches: Iterator[pa.RecordBatch], sent=sent, sent_pairs=sent_pairs) -> Iterator[pa.RecordBatch]:
            a_ids, a_labels, a_matrix = sent.value
            of, positive, p_score = sent_pairs.value
            anchors, best = residues(a_matrix, moduli), Best(len(of), n_negatives)
            # 100 * n within low * p and high * p, as whole bounds of n
            least, most = -(-low * p_score // 100), high * p_score // 100
            for row_ids, row_labels, scores in _slices(batches, width, anchors, moduli, slice_rows):
                other = a_labels[:, None] != row_labels
                reach = np.maximum(least, best.floor())
                for at in range(0, len(of), 1024):  # pairs of a few hundred anchors at a time
                    some = slice(at, at + 1024)
                    s = scores[of[some]]
                    n, r = np.nonzero(other[of[some]] & (s >= reach[some, None]) & (s <= most[some, None]))
                    n, r = _leading(n, r, s, n_negatives)
                    best.add(n + at, s[n, r], row_ids[r])
            yield best.batch({"anchor_id": a_ids[of], "positive_id": positive, "positive_score": p_score})

        kind = "list long, anchor_id long, positive_id long, positive_score long, vec_id long, score long"
        block = _best_of(rows.mapInArrow(negatives, kind), n_negatives).select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score"))
        block = checkpointed(block)
        out = block if out is None else out.unionAll(block)
    if out is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                         "positive_score long, negative_score long")
    return out


def _leading(n: np.ndarray, r: np.ndarray, s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the entries (n, r), those of each list n that reach its k-th best score; ties stay."""
    value = np.full(s.shape, np.iinfo(np.int64).min)
    value[n, r] = s[n, r]
    kth = np.partition(value, max(s.shape[1] - k, 0), axis=1)[:, max(s.shape[1] - k, 0)]
    keep = s[n, r] >= kth[n]
    return n[keep], r[keep]


ORACLE_SQL = """
WITH kept AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS parts
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS vec_id, a.label = r.label AS same,
         list_sum(list_transform(list_zip(a.parts, r.parts), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM kept a JOIN kept r ON a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
    FROM scored WHERE same AND vec_id <> anchor_id) WHERE place <= 5),
ranked AS (
  SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT same
    AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
"""

"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text features gives a score ``s``; ordered
thresholds ``t_1 < t_2 < ...`` turn it into grades: P(grade <= k) =
sigmoid(t_k - s). The expected grade and the tail probability P(grade >= g)
select documents.

Features of a text are a set of hashed slots: its distinct words, their
beginnings, the marks left
when small letters are taken out of its words (with their share of the words, by
powers of two), and the share of its most frequent word. A feature that occurs
in few rated texts keeps weight zero.

The fit uses a bounded sample of rated documents (``fit_rows``, chosen by id
hash). Tasks turn texts into slots; only slots reach the driver, where numpy
minimises the likelihood. Scoring is one narrow pass with the weights broadcast
(1 MB at 2^18 slots).

Results: null and empty texts have no feature and get the thresholds' grade
distribution. Ratings with null grades or ids that no document has are not used.
With no rated document every probability is 1 and the expected grade 0: nothing
is known, so nothing is rejected.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchtrace.llm.common import at_most, chunks, stored

SLOT_BITS = 18
#: Rated documents that the fit uses at most, in expectation.
FIT_ROWS = 10_000
#: A slot needs so many texts of the sample to get a weight.
LEAST_TEXTS = 10

#: Bytes of a word's beginning that count as features: inflected forms share them.
STEMS = (4, 5)

_FIT_BLOCK = 500

_SMALL = bytes([*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)])
_SHAPE = bytes(ord("A") if 65 <= b <= 90 else ord("0") if 48 <= b <= 57 else b for b in range(256))


def slots(data: bytes, bits: int = SLOT_BITS) -> np.ndarray:
    """Sorted feature slots of a text (UTF-8)."""
    words = data.lower().split()
    if not words:
        return np.zeros(0, np.int32)
    crc, n, counts = zlib.crc32, len(words), Counter(words)
    found = [crc(w) for w in counts]
    found += [crc(b"^" + w) for size in STEMS for w in {w[:size] for w in counts}]
    marks = data.translate(_SHAPE, _SMALL).replace(b"00", b"0").replace(b"AA", b"A").replace(b"AA", b"A").split()
    for mark, k in Counter(marks).items():
        found.append(crc(b"mark %d " % int(math.log2(n / min(k, n))) + mark))
    found.append(crc(b"top %d of %d" % (int(10 * max(counts.values()) / n), min(6, n.bit_length()))))
    return np.unique(np.array(found, np.int64) & ((1 << bits) - 1)).astype(np.int32)


@dataclass(frozen=True)
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def score(self, found: np.ndarray) -> float:
        return float(self.weights[found].sum())

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 0, 1, ...; one row a score."""
        above = 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -60, 60)))
        return np.hstack([np.ones((len(scores), 1)), above])


def fit_ordinal(rows: list[np.ndarray], grades: np.ndarray, bits: int = SLOT_BITS, least: int = LEAST_TEXTS,
                steps: int = 150, ridge: float = 5e-4, rate: float = 0.05) -> OrdinalModel:
    """Maximum likelihood with a ridge by Adam; thresholds kept in order by positive gaps."""
    n_slots, top = 1 << bits, int(grades.max()) if len(grades) else 0
    if top < 1:
        return OrdinalModel(np.zeros(n_slots, np.float32), np.zeros(0))
    texts = np.zeros(n_slots, np.int64)
    for r in rows:
        texts[r] += 1  # the slots of a row are distinct
    names = np.flatnonzero(texts >= least)
    place = np.full(n_slots, -1, np.int32)
    place[names] = np.arange(len(names))
    blocks = []  # some rows at a time: their rows' range, the owner and the weight index of each feature
    for at in range(0, len(rows), _FIT_BLOCK):
        part = [p[p >= 0] for p in (place[r] for r in rows[at:at + _FIT_BLOCK])]
        owner = np.repeat(np.arange(len(part), dtype=np.int32), [len(p) for p in part])
        blocks.append((slice(at, at + len(part)), len(part), owner, np.concatenate(part)))
    shares = np.cumsum(np.bincount(grades, minlength=top + 1))[:-1] / len(grades)
    t = np.log(np.clip(shares, 1e-3, 1 - 1e-3) / (1 - np.clip(shares, 1e-3, 1 - 1e-3)))
    x = np.concatenate([np.zeros(len(names)), t[:1], np.log(np.maximum(np.diff(t), 1e-2))])  # weights, first, log gaps
    m, v = np.zeros_like(x), np.zeros_like(x)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -60, 60)))
    for step in range(1, steps + 1):
        w, gaps = x[:len(names)], np.exp(x[len(names) + 1:])
        t = x[len(names)] + np.concatenate([[0.0], np.cumsum(gaps)])
        s = np.concatenate([np.bincount(owner, w[flat], n) for _, n, owner, flat in blocks])
        edge = np.concatenate([[-np.inf], t, [np.inf]])
        hi, lo = sigmoid(edge[grades + 1] - s), sigmoid(edge[grades] - s)
        p = np.maximum(hi - lo, 1e-9)
        d_hi, d_lo = hi * (1 - hi) / p, lo * (1 - lo) / p  # of log p by the upper and lower edge
        g_s = (d_hi - d_lo) / len(rows)  # of the loss by the score
        g_t = np.bincount(grades, -d_hi, top + 1)[:-1] + np.bincount(grades, d_lo, top + 1)[1:]
        g_t /= len(rows)
        g_w = ridge * w
        for rows_of, _, owner, flat in blocks:
            g_w += np.bincount(flat, g_s[rows_of][owner], len(names))
        g = np.concatenate([g_w, [g_t.sum()],
                            np.cumsum(g_t[::-1])[::-1][1:] * gaps])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        x = x - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    weights = np.zeros(n_slots, np.float32)
    weights[names] = x[:len(names)]
    return OrdinalModel(weights, x[len(names)] + np.concatenate([[0.0], np.cumsum(np.exp(x[len(names) + 1:]))]))


def fit(docs: DataFrame, ratings: DataFrame, bits: int = SLOT_BITS, fit_rows: int = FIT_ROWS,
        id_col: str = "doc_id", text_col: str = "text", grade_col: str = "grade") -> OrdinalModel:
    """Model from ``ratings(doc_id, grade)``; grades are 0, 1, ..."""
    known = ratings.select(F.col(id_col).alias("rated_id"), F.col(grade_col).cast("int").alias("grade")) \
        .filter(F.col("rated_id").isNotNull() & (F.col("grade") >= 0))
    part = min(1.0, fit_rows / max(1, known.count()))
    chosen = known.filter(F.pmod(F.xxhash64("rated_id"), F.lit(1 << 30)) < int(part * (1 << 30)))
    chosen = F.broadcast(chosen.limit(2 * fit_rows))  # about fit_rows ids; the limit makes it a proven bound
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")) \
        .join(chosen, F.col("doc_id") == F.col("rated_id")).select("grade", "text")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            found = [slots(t, bits).tobytes() for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["grade", "slots"])

    # an id may stand on any number of rows, so what comes to the driver is bounded here once more
    rated = at_most(stored(texts.mapInArrow(features, "grade int, slots binary"), "rated"), 2 * fit_rows)
    rows = rated.orderBy("grade", "slots").toArrow()  # in a fixed order, so that every run adds up the same sums
    found = [np.frombuffer(b.as_buffer(), np.int32) for chunk in rows.column("slots").chunks for b in chunk]
    return fit_ordinal(found, np.array(rows.column("grade").to_pylist(), np.int64), bits)


def score(docs: DataFrame, model: OrdinalModel, bits: int = SLOT_BITS, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``docs`` reduced to ``doc_id``, expected grade, tail probability of the top grade."""
    return with_grades(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), model, bits) \
        .select("doc_id", "expected_grade", "tail_probability")


def with_grades(docs: DataFrame, model: OrdinalModel, bits: int = SLOT_BITS, text_col: str = "text",
                expected: str = "expected_grade", tail: str = "tail_probability") -> DataFrame:
    """``docs`` plus the two columns; one narrow Arrow pass over all columns."""
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))
    spec = T.StructType([*docs.schema.fields, T.StructField(expected, T.DoubleType()), T.StructField(tail, T.DoubleType())])

    def grade(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = OrdinalModel(*sent.value)
        for batch in chunks(batches, text_col):
            texts = batch.column(batch.schema.get_field_index(text_col)).cast(pa.binary()).to_pylist()
            tails = m.tails(np.array([m.score(slots(t or b"", bits)) for t in texts]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(tails[:, 1:].sum(axis=1)), pa.array(tails[:, -1])],
                [*batch.schema.names, expected, tail])

    return docs.mapInArrow(grade, spec)

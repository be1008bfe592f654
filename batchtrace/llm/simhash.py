"""SimHash near-duplicates with bit-sliced distances.

A document's fingerprint has a bit for each of 64 places, set if more than half
of its shingle hashes have it. Fingerprints within ``radius`` bits are linked
and a document's class is its connected component.

Finding links: only distinct fingerprints are compared. Two within three bits
agree on one of four 16-bit blocks, and then on one of four 12-bit parts of the
other 48 bits, so each fingerprint goes to 16 tables under a 28-bit key; any
linked pair shares a key. Keys that one fingerprint has are dropped by a counted
join. A key with more than ``CHUNK`` fingerprints is dealt out by pairs of
chunks, so no task holds a whole hot key.

Comparing: candidates of many keys are laid side by side as lanes of bit planes
(one 64-bit word is one plane of 64 candidates). Differing planes are summed by
carry-save counters that stop at four, and a block of lanes is abandoned as soon
as every lane is beyond the radius. A task reports spanning links only, found by
union-find, never all pairs of a group.

Results: null and empty texts have fingerprint zero, linked like any other.
Equal texts are always in one class. A row with a null id takes part; it names
a class only if the class has no other id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchtrace.llm.common import checkpointed, chunks, fresh
from batchtrace.llm.components import components

CHUNK = 2048
#: Lanes compared at once: planes of 64 KiB each.
_LANES = 1 << 16


def _fingerprint(data: bytes, shingle: int) -> int:
    import xxhash
    words = data.lower().split()  # of bytes: A-Z and the six ASCII white space characters only
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    runs = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    hashes = np.fromiter((xxhash.xxh64_intdigest(r, 42) for r in runs), np.uint64, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at:at + 4096].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits((2 * ones > len(hashes)).astype(np.uint8), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_hash, fp`` (fp: the 64 bits as a signed long) per row."""
    kept = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            prints = np.array([_fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(prints)],
                                             ["doc_id", "text_hash", "fp"])

    return kept.mapInArrow(sign, f"doc_id {kept.schema['doc_id'].dataType.simpleString()}, text_hash long, fp long")


def within(left: np.ndarray, right: np.ndarray, radius: int) -> np.ndarray:
    """Which pairs of 64-bit words differ in ``radius`` (up to 3) bits at most.

    Works on bit planes: lane i of every plane belongs to pair i. Two counter
    planes count to three, a third keeps lanes that went beyond.
    """
    if not 0 <= radius <= 3:
        raise ValueError("the counters hold distances up to 3")
    n = len(left)
    out = np.zeros(n, bool)
    for at in range(0, n, _LANES):
        diff = (left[at:at + _LANES] ^ right[at:at + _LANES]).astype("<u8")
        m = len(diff)
        lanes = np.zeros(-(-m // 64) * 64, "<u8")
        lanes[:m] = diff
        lanes[m:] = ~np.uint64(0)
        bits = np.unpackbits(lanes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        planes = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")
        one, two, beyond = (np.zeros(planes.shape[1], "<u8") for _ in range(3))
        for k in range(0, 64, 2):
            a, b = planes[k], planes[k + 1]
            carry = (one & (a ^ b)) | (a & b)  # carry-save adder: one + a + b
            one = one ^ a ^ b
            beyond |= two & carry
            two = two ^ carry
            if k & 6 == 6:
                over = beyond if radius == 3 else beyond | (two & one if radius == 2 else two if radius == 1 else two | one)
                if (over == ~np.uint64(0)).all():
                    break
        over = beyond if radius == 3 else beyond | (two & one if radius == 2 else two if radius == 1 else two | one)
        out[at:at + m] = np.unpackbits((~over).view(np.uint8), bitorder="little")[:m].astype(bool)
    return out


class _Forest(dict):
    """Union-find over fingerprints; ``join`` tells whether it linked two trees."""

    def find(self, x: int) -> int:
        root = x
        while (up := self.get(root, root)) != root:
            root = up
        while x != root:
            self[x], x = root, self.get(x, x)
        return root

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x != y:
            self[max(x, y)] = min(x, y)
        return x != y


def _spanning(keys: list[tuple], prints: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Spanning links of the runs of equal ``keys``; chunk pairs compare across, the rest within."""
    starts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
    left, right, waiting = [], [], 0
    forest = _Forest()

    def compare() -> Iterator[tuple[int, int]]:
        if waiting:
            l, r = np.concatenate(left), np.concatenate(right)
            near = within(l, r, radius)
            for x, y in zip(l[near].view(np.int64).tolist(), r[near].view(np.int64).tolist(), strict=True):
                if forest.join(x, y):
                    yield x, y
        left.clear(), right.clear()

    for a, b in zip(starts, starts[1:]):
        run = prints[a:b]
        for i in range(b - a - 1):
            left.append(np.full(b - a - 1 - i, run[i]))
            right.append(run[i + 1:])
            waiting += b - a - 1 - i
            if waiting >= _LANES:
                yield from compare()
                waiting = 0
    yield from compare()


def _keyed(prints: DataFrame) -> DataFrame:
    """16 rows per fingerprint: table and 28-bit key."""
    fp = F.col("fp")
    block = lambda i: F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF))
    tables = []
    for i in range(4):
        others = [j for j in range(4) if j != i]
        rest = sum((F.shiftleft(block(j), 16 * n) for n, j in enumerate(others)), F.lit(0).cast("long"))
        for p in range(4):
            part = F.shiftrightunsigned(rest, 12 * p).bitwiseAND(F.lit(0xFFF))
            tables.append(F.shiftleft(F.lit(4 * i + p).cast("long"), 28) + F.shiftleft(block(i), 12) + part)
    return prints.select("fp", F.explode(F.array(*tables)).alias("key"))


def links(prints: DataFrame, radius: int = 3, chunk: int = CHUNK) -> DataFrame:
    """Spanning links ``a, b`` of the distinct fingerprints ``fp`` within ``radius``."""
    keyed = _keyed(prints)
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    held = keyed.join(shared, "key").withColumn("parts", F.ceil(F.col("n") / F.lit(chunk)).cast("int"))
    own = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("parts")).cast("int")
    dealt = held.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp")
    together = dealt.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail: pa.Table | None = None

        def near(t: pa.Table) -> pa.RecordBatch:
            keys = list(zip(*(t.column(c).to_pylist() for c in ("key", "lo", "hi")), strict=True))
            found = list(_spanning(keys, t.column("fp").to_numpy().view(np.uint64), radius))
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()),
                                               pa.array([y for _, y in found], pa.int64())], ["a", "b"])

        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([tail, t]) if tail else t
            last = tuple(t.column(c)[-1].as_py() for c in ("key", "lo", "hi"))
            k = len(t)  # the last run may go on in the next batch
            while k and tuple(t.column(c)[k - 1].as_py() for c in ("key", "lo", "hi")) == last:
                k -= 1
            if k:
                yield near(t.slice(0, k))
            tail = t.slice(k)
        if tail:
            yield near(tail)

    return together.mapInArrow(compare, "a long, b long").distinct()


def _classes(prints: DataFrame, radius: int) -> DataFrame:
    """``fp, class_fp, least_id`` for every distinct fingerprint."""
    distinct = checkpointed(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")))
    roots = components(links(distinct.select("fp"), radius))
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("class_fp"))
    least = named.groupBy("class_fp").agg(F.min("least_id").alias("component_id"))
    return named.select("fp", "class_fp").join(least, "class_fp")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row."""
    prints = checkpointed(fingerprints(docs, shingle, id_col, text_col).select("doc_id", "fp"))
    return prints.join(_classes(prints, radius), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 3,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of every class, with all columns: the least id's, then the least text hash's."""
    prints = checkpointed(fingerprints(docs, shingle, id_col, text_col))
    placed = prints.join(_classes(prints, radius).select("fp", "class_fp"), "fp")
    winners = placed.groupBy("class_fp").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id"), F.col("text_hash"))).alias("first")) \
        .select(F.col("first.doc_id").alias("kept_id"), F.col("first.text_hash").alias("kept_hash"))
    (h,) = fresh(docs, "text_hash")
    keyed = docs.withColumn(h, F.xxhash64(text_col))
    kept = keyed.join(winners, [keyed[id_col].eqNullSafe(winners.kept_id), keyed[h] == winners.kept_hash], "left_semi")
    return kept.dropDuplicates([id_col, h]).drop(h)

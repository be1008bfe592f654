"""Mixing sources to target weights as a time-varying curriculum.

Every source has a share of the words (its target) and a weight schedule over
training time t in [0, 1]. The integral of the schedule, scaled to the target,
is the source's cumulative token demand. Its documents, in a pseudo-random order
and repeated up to ``max_repeats`` times, lie along that demand axis; inverting
the demand at a copy's midpoint gives the copy's training position, and a range
sort by position gives the training order.

DataFrame functions only. A source's running sum is never one task's work: its
documents fall into about sqrt(n) buckets by their order key, buckets are summed
first (with map-side combining), their running sum has one row a bucket, and the
window inside a bucket sees about sqrt(n) rows, however hot the source is. The
windows over the source table see one row per source.

Results: a null text has size 0; a null source is a source of its own, ordered
last. Repeated rows are documents of their own. If all sizes are 0, targets are
0 and nothing is taken. An empty table gives an empty plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchtrace.llm.common import checkpointed, small_side

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in code point order, repeating.
WEIGHTS = (1, 2, 3)
#: Start and end of the linear weight schedule, by the same rank: early, even, late.
SCHEDULES = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))
_KEY_BITS = 40


def _pick(rank: Column, values: Sequence) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (rank % F.lit(len(values)) + 1).cast("int"))


def source_targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS,
                   schedules: Sequence[tuple[float, float]] = SCHEDULES, max_repeats: int = 3) -> DataFrame:
    """``source, source_size, n_docs`` to targets: all words shared by weight.

    A target stops at ``max_repeats`` times its source's size and the rest is
    shared again. Sources that stop are those of the least size per weight, so
    one running sum in that order finds them all.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    earlier = Window.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    ranked = sources.withColumn("rank", (F.row_number().over(by_name) - 1).cast("long"))
    limits = ranked.select(
        "*", _pick(F.col("rank"), weights).cast("long").alias("weight"),
        (F.col("source_size") * max_repeats).alias("cap"),
        F.sum("source_size").over(everything).alias("words"))
    left = limits.select(
        "*", (F.col("words") - F.coalesce(F.sum("cap").over(earlier), F.lit(0))).alias("words_left"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0))).alias("weight_left"))
    stopped = left.withColumn("stops", F.col("cap") / F.col("weight") < F.col("words_left") / F.col("weight_left"))
    rate = (F.col("words") - F.sum(F.when(F.col("stops"), F.col("cap")).otherwise(0)).over(everything)) / \
        F.sum(F.when(F.col("stops"), 0).otherwise(F.col("weight"))).over(everything)
    shared = stopped.withColumn("rate", rate)
    return shared.select(
        "rank", "source", "source_size", "n_docs",
        F.when(F.col("stops"), F.col("cap").cast("double")).otherwise(F.col("rate") * F.col("weight")).alias("target"),
        _pick(F.col("rank"), [a for a, _ in schedules]).alias("w0"),
        _pick(F.col("rank"), [b for _, b in schedules]).alias("w1"))


def _position(done: Column) -> Column:
    """Time at which the linear schedule w0 -> w1 has used the part ``done`` of its integral."""
    w0, w1 = F.col("w0"), F.col("w1")
    return done * (w0 + w1) / (w0 + F.sqrt(w0 * w0 + (w1 * w1 - w0 * w0) * done))


def _plan(docs: DataFrame, keep_rows: bool, weights, schedules, max_repeats: int,
          id_col: str, text_col: str, source_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.conv(F.substring(digest, 1, _KEY_BITS // 4), 16, 10).cast("long").alias("key"),
        F.xxhash64(text).alias("text_hash"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if keep_rows else []))
    if not keep_rows:
        rows = checkpointed(rows)  # a few numbers a document: texts are read once
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    targets = small_side(checkpointed(source_targets(sources, weights, schedules, max_repeats)))
    named = targets.withColumnRenamed("source", "target_source")
    buckets = F.ceil(F.sqrt(F.col("n_docs").cast("double"))).cast("long")
    placed = rows.join(named, F.col("source").eqNullSafe(F.col("target_source"))).drop("target_source") \
        .withColumn("bucket", F.shiftright(F.col("key") * buckets, _KEY_BITS))
    in_source = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = placed.groupBy("rank", "bucket").agg(F.sum("size").alias("bucket_size")).select(
        "rank", "bucket", F.coalesce(F.sum("bucket_size").over(in_source), F.lit(0)).alias("before"))
    in_bucket = Window.partitionBy("rank", "bucket").orderBy("key", "doc_id", "size", "text_hash") \
        .rowsBetween(Window.unboundedPreceding, -1)
    lined = placed.join(before, ["rank", "bucket"]).withColumn(
        "offset", F.col("before") + F.coalesce(F.sum("size").over(in_bucket), F.lit(0)))
    middle = F.col("offset") + F.col("size") / F.lit(2)
    copies = sum((F.when(middle + F.col("source_size") * j < F.col("target"), 1).otherwise(0)
                  for j in range(max_repeats)), F.lit(0))
    return lined.withColumn("middle", middle).withColumn("copies", copies.cast("int"))


def mix_plan(docs: DataFrame, weights: Sequence[int] = WEIGHTS,
             schedules: Sequence[tuple[float, float]] = SCHEDULES, max_repeats: int = 3,
             id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per document its words taken, copies and the first copy's position; in training order."""
    plan = _plan(docs, False, weights, schedules, max_repeats, id_col, text_col, source_col)
    first = F.when(F.col("copies") > 0, _position(F.col("middle") / F.col("target")))
    return plan.select("doc_id", "source", "size", "source_size", "target",
                       (F.col("size") * F.col("copies")).alias("taken"), "copies", first.alias("position")) \
        .orderBy(F.col("position").asc_nulls_last(), "doc_id")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS,
        schedules: Sequence[tuple[float, float]] = SCHEDULES, max_repeats: int = 3,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed documents: a row for every copy taken, range-sorted by position."""
    plan = _plan(docs, True, weights, schedules, max_repeats, id_col, text_col, source_col)
    copies = plan.filter(F.col("copies") > 0).withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    placed = copies.withColumn("position", _position(
        (F.col("middle") + F.col("source_size") * F.col("copy")) / F.col("target")))
    return placed.orderBy("position", "doc_id", "copy").select("row.*")


ORACLE_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 10))::BIGINT AS key
  FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS rank FROM sources),
limits AS (
  SELECT *, rank % 3 + 1 AS weight, source_size * 3 AS cap, (sum(source_size) OVER ())::BIGINT AS words FROM ranked),
remaining AS (
  SELECT *, words - coalesce(sum(cap) OVER w, 0)::BIGINT AS words_left,
         (sum(weight) OVER ())::BIGINT - coalesce(sum(weight) OVER w, 0)::BIGINT AS weight_left
  FROM limits
  WINDOW w AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
stopped AS (SELECT *, cap / weight < words_left / weight_left AS stops FROM remaining),
rates AS (
  SELECT *, (words - (sum(CASE WHEN stops THEN cap ELSE 0 END) OVER ())::BIGINT)
            / (sum(CASE WHEN stops THEN 0 ELSE weight END) OVER ())::BIGINT AS rate FROM stopped),
targets AS (
  SELECT source, source_size, CASE WHEN stops THEN cap::DOUBLE ELSE rate * weight END AS target,
         [1.5, 1.0, 0.5][rank % 3 + 1]::DOUBLE AS w0, [0.5, 1.0, 1.5][rank % 3 + 1]::DOUBLE AS w1
  FROM rates),
placed AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target, t.w0, t.w1,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT + d.size / 2 AS middle
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
counted AS (
  SELECT *, ((middle < target)::INT + (middle + source_size < target)::INT
             + (middle + source_size * 2 < target)::INT) AS copies, middle / target AS done FROM placed)
SELECT doc_id, source, size, source_size, target, size * copies AS taken, copies,
       CASE WHEN copies > 0 THEN done * (w0 + w1) / (w0 + sqrt(w0 * w0 + (w1 * w1 - w0 * w0) * done)) END AS position
FROM counted
"""

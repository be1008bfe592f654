"""Document fingerprints by winnowing, in DataFrame functions only.

A text is lower-cased and cut into tokens: a single letter of a script written
without spaces, or up to 16 other characters between white space. Every run of
``k`` tokens is hashed, each window of ``w`` consecutive hashes gives its least,
the rightmost on ties, and the fingerprint is the selected hashes with their
positions. Any run of ``k + w - 1`` tokens that two texts share gives them a
common hash. A text of fewer than ``k`` tokens is one run; fewer than ``w`` runs
are one window. Where words are too coarse, the letters are symbols too: of a text
of one window, and of runs over 16 characters (a 16-character token and what
follows it). They are winnowed by the same rule, without white space, and their
hashes follow with the position of the token run; of equal neighbours the first is
kept. So a short text has several hashes, and ``k + w - 1`` letters shared by two
unspaced runs give a common hash at any offset. Hashes are ordered by their upper 31 bits, so one long holds the
order and, counting down, the position.

``neighbour_likeness`` needs each document's successor by descending id. Rows go
to buckets of consecutive ids (bounds from one pass over the ids alone) and a
window inside the bucket looks one row ahead; only a bucket's last row takes its
successor from a table of one row per bucket. Texts are shuffled once.

Results: null and empty texts, and texts of white space, have the empty
fingerprint; two empty fingerprints have likeness 1, an empty and another 0.
Rows of one id are ordered by text hash, null ids come last. A table of one row
has itself as successor.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchtrace.llm.common import checkpointed

_UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
_BEYOND = r"\x{e00}-\x{10ffff}"
#: No unspaced script begins before U+0E00. To look up a letter's script takes longer than all else done to it, so it comes last.
TOKEN = (rf"[\x{{21}}-\x{{dff}}\x{{0}}-\x{{8}}\x{{e}}-\x{{1f}}[{_BEYOND}&&[^{_UNSPACED}]]]{{1,16}}+"
         rf"|[{_BEYOND}&&[{_UNSPACED}]]")
K, W = 4, 4
_POSITIONS = (1 << 32) - 1


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, and not copied from row to row as a column would be.

    It is the start value of a sum over no elements, which alone hands values on without a copy.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda x, _: x, body)


def _position(key: Column) -> Column:
    return F.bitwise_not(key).bitwiseAND(F.lit(_POSITIONS)).cast("int")


def _runs(h: Column, k: int) -> Column:
    """Hashes of all runs of ``k`` of the symbol hashes ``h``."""
    every = F.transform(F.slice(h, F.lit(1), F.size(h) - (k - 1)), lambda x, i: F.xxhash64(x, *[F.get(h, i + j) for j in range(1, k)]))
    return F.when(F.size(h) >= k, every if k > 1 else h).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(
        F.array().cast("array<bigint>"))


def _window_least(m: Column, w: int, n: int = 1) -> Column:
    """Least of every ``w`` consecutive keys, if ``m`` has those of every ``n``: twice as many each time."""
    if n == w:
        return m
    step = min(n, w - n)
    both = F.zip_with(F.slice(m, F.lit(1), F.size(m) - step), F.slice(m, F.lit(step + 1), F.size(m) - step), lambda a, b: F.least(a, b))
    return _let(both, lambda x: _window_least(x, w, n + step))


def _selected(g: Column, w: int) -> Column:
    """Keys of the run hashes ``g`` that are the least of a window."""
    keys = F.transform(g, lambda x, i: F.shiftrightunsigned(x, 1).bitwiseOR(F.lit(_POSITIONS)) - i)
    return _let(keys, lambda m: F.array_distinct(
        F.when(F.size(m) > w, _window_least(m, w) if w > 1 else m).when(F.size(m) > 0, F.array(F.array_min(m))).otherwise(m)))


def _of(g: Column, key: Column) -> Column:
    return F.get(g, _position(key))


def one_window(n_tokens: Column, k: int, w: int) -> Column:
    return (n_tokens > 0) & (n_tokens < k + w)


def _full(x: Column) -> Column:
    return F.coalesce((F.octet_length(x) >= 16) & (F.length(x) == 16), F.lit(False))


def _letters(t: Column, every: Column) -> Column:
    """Letters with their token's position: of the tokens ``t`` of long runs, or of all."""
    cut = lambda x, i: F.transform(F.regexp_extract_all(x, F.lit("(?s)."), F.lit(0)),
                                   lambda y: F.struct(F.xxhash64(y).alias("hash"), i.alias("token")))
    long = lambda x, i: (_full(x) & (i < F.size(t) - 1)) | _full(F.get(t, i - 1))
    none = F.array().cast("array<struct<hash:bigint,token:int>>")
    return F.when(every | F.exists(t, lambda x: F.octet_length(x) >= 16), F.flatten(F.transform(
        t, lambda x, i: F.when(every | long(x, i), cut(x, i)).otherwise(none)))).otherwise(none)


def _letter_prints(c: Column, n_runs: Column, k: int, w: int) -> Column:
    """Selected hashes of the letters ``c``; of equal neighbours the first."""
    def picked(g: Column, s: Column) -> Column:
        kept = F.filter(s, lambda x, i: (i == 0) | (_of(g, x) != _of(g, F.get(s, i - 1))))
        return F.transform(kept, lambda x: F.struct(
            _of(g, x).alias("hash"), F.least(_of(F.transform(c, lambda y: y["token"]), x), n_runs - 1).alias("pos")))

    return _let(_runs_of(F.transform(c, lambda y: y["hash"]), k), lambda g: _let(_selected(g, w), lambda s: picked(g, s)))


def _runs_of(h: Column, k: int) -> Column:
    return _let(h, lambda x: _runs(x, k))


def fingerprint(text: Column, k: int = K, w: int = W, letters: bool = False) -> Column:
    """``prints``, an array of (hash, pos), and ``n``, the number of tokens.

    One expression, so that its steps are not copied with the row. ``letters`` takes the letters of every text.
    """
    none = F.array().cast("array<struct<hash:bigint,pos:int>>")

    def of(t: Column, g: Column) -> Column:
        words = F.transform(_selected(g, w), lambda x: F.struct(_of(g, x).alias("hash"), _position(x).alias("pos")))
        every = F.lit(True) if letters else one_window(F.size(t), k, w)
        pieces = _let(_letters(t, every), lambda c: F.when(F.size(c) > 0, _letter_prints(c, F.size(g), k, w)).otherwise(none))
        return F.struct(F.concat(words, pieces).alias("prints"), F.size(t).alias("n"))

    return _let(F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0)),
                lambda t: _let(_runs_of(F.transform(t, lambda x: F.xxhash64(x)), k), lambda g: of(t, g)))


def with_fingerprint(df: DataFrame, text: str, out: str, k: int = K, w: int = W, letters: bool = False) -> DataFrame:
    """``df`` plus ``out``: array of (hash, pos), and ``out_n``: the number of tokens."""
    kept = [c for c in df.columns if c not in (out, f"{out}_n")]
    made = df.select(*kept, fingerprint(F.col(text), k, w, letters).alias(out))
    return made.select(*kept, F.col(f"{out}.prints").alias(out), F.col(f"{out}.n").alias(f"{out}_n"))


def fingerprints(docs: DataFrame, k: int = K, w: int = W, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` (array of hash and position) of every whole text."""
    kept = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return with_fingerprint(kept, "text", "fingerprint", k, w).select("doc_id", "fingerprint")


def likeness(a: Column, b: Column) -> Column:
    """Share of common hashes among all hashes of two hash arrays."""
    every = F.size(F.array_union(a, b))
    return F.when(every == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / every)


def _bucket_of(bounds: list[int]) -> Callable[[Column], Column]:
    """Number of bounds at or below an id, by two short scans; null ids come before all."""
    if not bounds:
        return lambda x: F.lit(0)
    step = math.isqrt(len(bounds)) + 1
    coarse = F.array(*[F.lit(b).cast("long") for b in bounds[step - 1::step]])
    groups = [F.array(*[F.lit(b).cast("long") for b in bounds[i:i + step]]) for i in range(0, len(bounds) + 1, step)]
    fine = F.array(*[g.cast("array<bigint>") for g in groups])

    def at(x: Column) -> Column:
        below = lambda a: F.size(F.filter(a, lambda b: b <= x))
        return F.when(x.isNull(), F.lit(-1)).otherwise(below(coarse) * step + below(
            F.element_at(fine, below(coarse) + 1)))

    return at


def with_successor(docs: DataFrame, buckets: int | None = None) -> tuple[DataFrame, Window]:
    """``docs(doc_id, text)`` with ``next_text``, and the window of its buckets."""
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = [i / buckets for i in range(1, buckets)] or [0.5]
    found = docs.agg(F.percentile_approx("doc_id", F.array(*map(F.lit, cuts)), 100 * buckets)).first()[0]
    bounds = sorted(set(found or []))
    at = _bucket_of(bounds)
    placed = docs.withColumn("bucket", at(F.col("doc_id")).cast("int")).withColumn("text_hash", F.xxhash64("text"))
    # the first row of each bucket, and so the successor of the last row of the bucket before
    heads = docs.select("doc_id", at(F.col("doc_id")).cast("int").alias("bucket")) \
        .groupBy("bucket").agg(F.max("doc_id").alias("head_id"))
    heads = checkpointed(heads.withColumnRenamed("bucket", "head_bucket"))  # a row per bucket
    texts = placed.join(F.broadcast(heads), (F.col("bucket") == F.col("head_bucket")) & F.col("doc_id").eqNullSafe(F.col("head_id")))
    order = Window.orderBy(F.col("bucket").desc())
    firsts = texts.groupBy("bucket").agg(F.min("text_hash").alias("text_hash"))
    chosen = texts.join(F.broadcast(firsts), ["bucket", "text_hash"]).groupBy("bucket").agg(F.first("text").alias("head"))
    follows = F.lead("head").over(order)
    top = F.first("head").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    after = checkpointed(chosen.select("bucket", F.coalesce(follows, top).alias("bucket_next")))
    inside = Window.partitionBy("bucket").orderBy(F.col("doc_id").desc_nulls_last(), "text_hash")
    # a task for each bucket, and one for null ids: hashed bucket numbers would meet in some tasks and leave others idle
    dealt = placed.repartitionById(len(bounds) + 2, "bucket")
    looked = dealt.withColumn("ahead", F.lead("text").over(inside))
    return looked.join(F.broadcast(after), "bucket").select(
        "bucket", "doc_id", "text_hash", "text", F.coalesce("ahead", "bucket_next").alias("next_text")), inside


def neighbour_likeness(docs: DataFrame, k: int = K, w: int = W, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text (its last third replaced
    by the successor's beginning), and their likeness to it and to its successor's."""
    kept = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows, inside = with_successor(kept)
    third = F.floor(F.col("n_chars") / 3).cast("int")
    rows = rows.withColumn("n_chars", F.length("text"))
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars") - third),
                                              F.substring("next_text", F.lit(1), third)))
    rows = rows.withColumn("last", F.lead("doc_id", 1).over(inside).isNull() & F.lead("text_hash", 1).over(inside).isNull())
    hashes = lambda prints: F.transform(prints, lambda x: x["hash"])
    of = lambda text, letters=False: fingerprint(F.col(text), k, w, letters)
    rows = rows.select("bucket", "doc_id", "text_hash", "n_chars", "last", "text", "edited", of("text").alias("own"), of("edited").alias("other"),
                       F.when(F.col("last"), hashes(of("next_text")["prints"])).alias("wrap_hash"))
    rows = rows.withColumns({"own_hash": hashes(F.col("own.prints")), "other_hash": hashes(F.col("other.prints"))})
    # if only one of text and edited text is short, both are compared by their letters too
    short, cut_short = (one_window(F.col(f"{n}.n"), k, w) for n in ("own", "other"))
    full = lambda text: hashes(of(text, True)["prints"])
    near = likeness(F.when(cut_short & ~short, full("text")).otherwise(F.col("own_hash")),
                    F.when(short & ~cut_short, full("edited")).otherwise(F.col("other_hash")))
    digest = lambda c: F.sha2(F.col(c).cast("string"), 256)
    # what stands below the window is kept by it for a whole bucket, so the long columns end here
    flat = rows.select("bucket", "doc_id", "text_hash", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                       digest("own.prints").alias("fingerprint"), digest("other.prints").alias("edited_fingerprint"),
                       "own_hash", "wrap_hash", "last", near.alias("near_edited"))
    seen = flat.withColumn("next_hash", F.when(F.col("last"), F.col("wrap_hash")).otherwise(F.lead("own_hash").over(inside)))
    return seen.select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
        likeness(F.col("own_hash"), F.col("next_hash")).alias("near_next"))

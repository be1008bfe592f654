"""Language-model scores by deleted interpolation.

A token's probability after its predecessor is a mixture

    l2(b) * c(v, w) / c(v)  +  l1(b) * c(w) / N  +  l0(b) * base(w)

of the bigram and unigram maximum-likelihood estimates and the add-half unigram
``base``; the weights depend on the context's frequency bucket b (0 if unseen,
else 1 + floor(log2 c(v))). Expectation-maximisation learns them on held-out
training documents (one in ``HELD``, by id) from counts of the others; scores
then use the counts of all training documents.

The counts are whole: every word and word pair of the corpus is counted. They
are found in two shuffles of compact rows:

1. a task cuts its documents into blocks of some MB of text and sends, for each
   bucket of the 64-bit hash space, the block's distinct hashes there (sorted,
   as compressed differences) with their counts: a combine before the shuffle;
2. a bucket's task adds up the counts and sends each block the totals of its
   hashes, in the order asked, so the answer holds counts only.

Blocks then meet their answers by block id and are scored. No count table ever
reaches the driver or a whole task: a frequent word is one hash of one bucket,
once per block. The driver gets the totals N and V and the 64 x 3 weights.

Blocks are cut twice by the same scan (once to ask, once to score) instead of
being stored; each carries a checksum of its hashes, and an input that changed
in between raises an error.

Results: a null text is empty and has the end token only. Rows that repeat are
documents of their own. Without training documents every token has base 1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchtrace.llm.common import chunks, fold, stored

#: Bytes of text in a block.
BLOCK_BYTES = 6 << 20
#: Bytes of text for each bucket of the hash space; its task holds their distinct hashes.
BUCKET_BYTES = 16 << 20
#: One training document in so many is held out for the weights.
HELD = 20
ROUNDS = 15
#: Hashes that no word has any claim to, of white space.
END_WORD, START_WORD = b"\n", b"\n\n"
TEST, FIT, LEARN = 0, 1, 2
_WORDS_CACHED = 200_000


def pack(values: np.ndarray) -> bytes:
    """64-bit integers, byte planes apart, compressed."""
    import zstandard
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.compress(planes.tobytes(), 1)


def unpack(data: bytes) -> np.ndarray:
    import zstandard
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash
        if len(self) >= _WORDS_CACHED:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def pair_hashes(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    x = before * np.uint64(0x9E3779B97F4A7C15) ^ (after + np.uint64(0x7F4A7C15F39CC060))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Block:
    """Tokens of a run of documents: distinct words and pairs, and each token's place among them."""

    def __init__(self, texts: list[bytes], known: WordHashes):
        end, start = known[END_WORD], known[START_WORD]
        parts, sizes = [], []
        for text in texts:
            words = text.lower().split()
            hashes = np.empty(len(words) + 2, np.uint64)
            hashes[0], hashes[-1] = start, end
            hashes[1:-1] = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
            parts.append(hashes)
            sizes.append(len(words) + 1)
        run = np.concatenate(parts)
        self.sizes = np.array(sizes)
        after = np.ones(len(run), bool)
        after[np.cumsum(self.sizes + 1) - self.sizes - 1] = False  # starts are contexts, not tokens
        self.words, place = np.unique(run, return_inverse=True)
        at = np.flatnonzero(after)
        self.word, self.context = place[at], place[at - 1]
        self.pairs, self.pair = np.unique(pair_hashes(run[at - 1], run[at]), return_inverse=True)
        self.starts = place[~after]
        self.mark = int(np.bitwise_xor.reduce(self.words) ^ np.bitwise_xor.reduce(self.pairs)) >> 1

    def counts(self, counted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of words (starts included) and of pairs in the documents ``counted``."""
        tokens = np.repeat(counted, self.sizes)
        words = np.bincount(self.word[tokens], minlength=len(self.words))
        words += np.bincount(self.starts[counted], minlength=len(self.words))
        return words, np.bincount(self.pair[tokens], minlength=len(self.pairs))


def _blocks(batches: Iterator[pa.RecordBatch], part: int) -> Iterator[tuple[str, int, list, list, list]]:
    """Blocks ``(id, role, doc ids, roles, texts)``: held-out documents in blocks of their own."""
    seq = {True: 0, False: 0}
    open_ = {True: ([], [], []), False: ([], [], [])}
    size = {True: 0, False: 0}

    def take(learn: bool):
        ids, roles, texts = open_[learn]
        block = (f"{part}-{int(learn)}-{seq[learn]}", LEARN if learn else FIT, ids, roles, texts)
        open_[learn], size[learn], seq[learn] = ([], [], []), 0, seq[learn] + 1
        return block

    for batch in chunks(batches, "text"):
        for doc_id, role, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                      batch.column(2).cast(pa.binary()).to_pylist(), strict=True):
            learn = role == LEARN
            for values, x in zip(open_[learn], (doc_id, role, text), strict=True):
                values.append(x)
            size[learn] += len(text)
            if size[learn] >= BLOCK_BYTES:
                yield take(learn)
    for learn in (False, True):
        if open_[learn][0]:
            yield take(learn)


def _ask(kept: DataFrame, buckets: int) -> DataFrame:
    """Rows ``kind, bucket, block, role, mark, hashes, counts``."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        known = WordHashes()
        for name, role, _, roles, texts in _blocks(batches, TaskContext.get().partitionId()):
            block = Block(texts, known)
            counted = np.array([r != TEST for r in roles])
            for kind, hashes, counts in zip((1, 2), (block.words, block.pairs), block.counts(counted), strict=True):
                cuts = np.searchsorted(hashes, np.array([(b << 64) // buckets for b in range(1, buckets)], np.uint64))
                sent = [(b, h, c) for b, (h, c) in enumerate(zip(np.split(hashes, cuts), np.split(counts, cuts), strict=True)) if len(h)]
                yield pa.RecordBatch.from_pydict({
                    "kind": pa.array([kind] * len(sent), pa.int32()), "bucket": pa.array([b for b, _, _ in sent], pa.int32()),
                    "block": [name] * len(sent), "role": pa.array([role] * len(sent), pa.int32()), "mark": [block.mark] * len(sent),
                    "hashes": [pack(np.diff(h, prepend=np.uint64(0))) for _, h, _ in sent],
                    "counts": [pack(c) for _, _, c in sent]})

    return kept.mapInArrow(ask, "kind int, bucket int, block string, role int, mark long, hashes binary, counts binary")


_ANSWER = ("block string, kind int, bucket int, mark long, fit binary, every binary, "
           "n_fit long, v_fit long, n_all long, v_all long")


def _answer(asked: DataFrame) -> DataFrame:
    """Totals for every request, and the bucket's sums of tokens and distinct words (no block)."""

    def answer(rows: pa.Table) -> pa.Table:
        kind = rows.column("kind")[0].as_py()
        hashes = [np.cumsum(unpack(x), dtype=np.uint64) for x in rows.column("hashes").to_pylist()]
        ends = np.cumsum([0, *map(len, hashes)])
        distinct, place = np.unique(np.concatenate(hashes), return_inverse=True)
        total = {FIT: np.zeros(len(distinct), np.int64), LEARN: np.zeros(len(distinct), np.int64)}
        for i, (role, counts) in enumerate(zip(rows.column("role").to_pylist(), rows.column("counts").to_pylist(), strict=True)):
            total[role][place[ends[i]:ends[i + 1]]] += unpack(counts).astype(np.int64)  # hashes of a block are distinct
        fit, every = total[FIT], total[FIT] + total[LEARN]
        token = distinct != WordHashes()[START_WORD]
        n, at = len(hashes), [place[a:b] for a, b in zip(ends, ends[1:])]
        sums = [int(fit[token].sum()), int((fit[token] > 0).sum()), int(every[token].sum()), int((every[token] > 0).sum())]
        none = [None] * n
        return pa.table({
            "block": pa.array([*rows.column("block").to_pylist(), None], pa.string()),
            "kind": pa.array([kind] * (n + 1), pa.int32()),
            "bucket": pa.array([rows.column("bucket")[0].as_py()] * (n + 1), pa.int32()),
            "mark": pa.array([*rows.column("mark").to_pylist(), None], pa.int64()),
            "fit": pa.array([*(pack(fit[p]) for p in at), None], pa.binary()),
            "every": pa.array([*(pack(every[p]) for p in at), None], pa.binary()),
            **{k: pa.array([*none, v], pa.int64()) for k, v in zip(("n_fit", "v_fit", "n_all", "v_all"), sums, strict=True)}})

    return asked.groupBy("kind", "bucket").applyInArrow(answer, _ANSWER)


def _bodies(kept: DataFrame) -> DataFrame:
    """The blocks' documents: ids, roles and compressed texts."""
    id_type = kept.schema["doc_id"].dataType.simpleString()

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext
        kind = None
        for name, role, ids, roles, texts in _blocks(_typed(batches, kinds := []), TaskContext.get().partitionId()):
            kind = kind or kinds[0]
            yield pa.RecordBatch.from_pydict({
                "block": [name], "role": pa.array([role], pa.int32()), "ids": pa.array([ids], pa.list_(kind)),
                "roles": pa.array([roles], pa.list_(pa.int32())), "sizes": pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
                "texts": pa.array([zstandard.compress(b"".join(texts), 3)], pa.binary())})

    return kept.mapInArrow(body, f"block string, role int, ids array<{id_type}>, roles array<int>, "
                                 "sizes array<long>, texts binary")


def _typed(batches: Iterator[pa.RecordBatch], kinds: list) -> Iterator[pa.RecordBatch]:
    """Passes the batches on and notes the type of their first column."""
    for b in batches:
        kinds.append(b.schema.field(0).type)
        yield b


def _open(body: pa.Table, answers: pa.Table) -> tuple[Block, dict]:
    """A block from its stored texts, and its counts: words and pairs, of the fit part and of all."""
    import zstandard
    run = zstandard.decompress(body.column("texts")[0].as_py())
    ends = np.cumsum([0, *body.column("sizes")[0].as_py()])
    block = Block([run[a:b] for a, b in zip(ends, ends[1:])], WordHashes())
    rows = sorted(zip(answers.column("kind").to_pylist(), answers.column("bucket").to_pylist(), range(len(answers))))
    counts = {(kind, what): np.concatenate([unpack(answers.column(what)[i].as_py()) for k, _, i in rows if k == kind]).astype(np.int64)
              for kind in (1, 2) for what in ("fit", "every")}
    marks = set(answers.column("mark").to_pylist())
    if marks != {block.mark} or len(counts[1, "fit"]) != len(block.words) or len(counts[2, "fit"]) != len(block.pairs):
        raise RuntimeError("the documents changed between two reads; store them first")
    return block, counts


def frequency_bucket(context: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + floor(log2 of its count)."""
    return np.where(context > 0, 1 + np.log2(np.maximum(context, 1)).astype(np.int64), 0)


def learn_weights(seen: DataFrame, n: int, v: int, rounds: int = ROUNDS) -> np.ndarray:
    """Weights (64 buckets x l2, l1, l0) by EM over ``bucket, pair, context, word, times``.

    Each round is one aggregation of the held-out counts by bucket. A bucket that no
    held-out token falls in has the weights of the nearest one that was learned, and
    an unseen context no bigram weight.
    """
    weights = np.full((64, 3), 1 / 3)
    p2 = F.when(F.col("context") > 0, F.col("pair") / F.col("context")).otherwise(0.0)
    p1 = F.col("word") / F.lit(float(max(n, 1)))
    p0 = (F.col("word") + 0.5) / F.lit(n + 0.5 * (v + 1))
    parts = seen.select("bucket", "times", p2.alias("p2"), p1.alias("p1"), p0.alias("p0"))
    for _ in range(rounds):
        w = [F.element_at(F.array(*[F.lit(float(x)) for x in weights[:, k]]), F.col("bucket") + 1) * F.col(f"p{2 - k}")
             for k in range(3)]
        total = w[0] + w[1] + w[2]
        got = parts.groupBy("bucket").agg(*[F.sum(F.col("times") * x / total).alias(f"s{k}") for k, x in enumerate(w)]).collect()
        for r in got:  # 64 rows at most
            share = np.maximum([r.s0, r.s1, r.s2], 0)
            share = share / share.sum()
            weights[r.bucket] = np.maximum(share, [0, 0, 1e-6]) / np.maximum(share, [0, 0, 1e-6]).sum()
    learned = sorted(r.bucket for r in got)
    for b in range(64):
        if b not in learned and learned:
            weights[b] = weights[min(learned, key=lambda x: (abs(x - b), x))]
    if 0 not in learned:  # a pair of an unseen context is unseen: the others share its weight
        rest = np.maximum(weights[0], [0, 0, 1e-6]) * [0, 1, 1]
        weights[0] = rest / rest.sum()
    return weights


def score(docs: DataFrame, test_modulus: int = 5, test_remainder: int = 1, buckets: int | None = None,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: fold, tokens, known tokens, training tokens, base and model log10 probability."""
    spark = docs.sparkSession
    if buckets is None:  # as many as the texts need, and at least the session's partitions
        size = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text_col))), F.lit(0))).first()[0]
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    role = F.when(fold(id_col, test_modulus) == test_remainder, TEST) \
        .when(F.floor(fold(id_col, test_modulus * HELD) / test_modulus) == 0, LEARN).otherwise(FIT)
    kept = docs.select(F.col(id_col).alias("doc_id"), role.cast("int").alias("role"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    answers = stored(_answer(_ask(kept, buckets)), "counts")
    sums = answers.filter(F.col("block").isNull() & (F.col("kind") == 1)).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_fit", "v_fit", "n_all", "v_all")]).first()
    told = answers.filter(F.col("block").isNotNull()).select("block", "kind", "bucket", "mark", "fit", "every")
    bodies = _bodies(kept)

    def met(body: pa.Table, rows: pa.Table) -> pa.Table:
        block, counts = _open(body, rows)
        c = np.stack([counts[2, "fit"][block.pair], counts[1, "fit"][block.context], counts[1, "fit"][block.word]])
        seen, times = np.unique(c, axis=1, return_counts=True)
        return pa.table({"bucket": pa.array(frequency_bucket(seen[1]), pa.int32()), "pair": seen[0], "context": seen[1],
                         "word": seen[2], "times": times})

    held = bodies.filter(F.col("role") == LEARN).groupBy("block").cogroup(
        told.filter(F.split("block", "-")[1] == "1").groupBy("block")).applyInArrow(
        met, "bucket int, pair long, context long, word long, times long")
    seen = stored(held.groupBy("bucket", "pair", "context", "word").agg(F.sum("times").alias("times")), "held-out")
    weights = learn_weights(seen, sums.n_fit, sums.v_fit)
    n, v = sums.n_all, sums.v_all
    id_type = kept.schema["doc_id"].dataType.simpleString()

    def scored(body: pa.Table, rows: pa.Table) -> pa.Table:
        block, counts = _open(body, rows)
        word, context = counts[1, "every"][block.word], counts[1, "every"][block.context]
        pair = counts[2, "every"][block.pair]
        w = weights[frequency_bucket(context)]
        base = (word + 0.5) / (n + 0.5 * (v + 1))
        p = w[:, 0] * pair / np.maximum(context, 1) + w[:, 1] * word / max(n, 1) + w[:, 2] * base
        starts = np.cumsum(block.sizes) - block.sizes
        ids, roles = body.column("ids")[0], body.column("roles")[0].as_py()
        return pa.table({
            "doc_id": ids.values, "held_out": [r == TEST for r in roles], "n_tokens": block.sizes,
            "n_known": np.add.reduceat((word > 0).astype(np.int64), starts),
            "train_tokens": pa.array([n] * len(roles), pa.int64()),
            "base_score": np.add.reduceat(np.log10(base), starts), "score": np.add.reduceat(np.log10(p), starts)})

    return bodies.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        scored, f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                "base_score double, score double")

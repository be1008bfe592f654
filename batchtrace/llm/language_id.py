"""Language identification by a byte convolutional network.

The network embeds bytes, convolves windows of ``WINDOW`` bytes with filters of
several widths, takes each filter's maximum over the window (after a rectifier)
and ends in a softmax. It is trained in numpy with Adam on labelled windows.

Because bytes have 256 values, a trained filter bank is folded into tables: the
filters' answer to a byte pair is one row of a 65,536-row table, so width 2 is
one lookup per position, width 3 a pair and a byte, width 4 two pairs. A whole
text is cut into windows (the last one padded with zero bytes, which stand for
"outside"); its language has the highest mean log probability over its windows,
weighted by their bytes, and the score is that language's share after a softmax.

The fit uses a bounded sample: about ``per_language`` labelled documents of each
language by id hash, and the first, middle and last window of each. Only those
windows reach the driver. Prediction is one narrow pass over all texts.

Results: null texts and texts without a letter are ``und`` with score 0; so is
everything if no document is labelled. Rows with null languages are predicted
but not learned from; rows with null ids take part in both.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchtrace.llm.common import at_most, checkpointed, chunks, fold, small_side, stored

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS, EMBED = 12, 12
PER_LANGUAGE = 1500
#: Texts of all languages together; with many languages each has fewer.
SAMPLE_ROWS = 300_000


@dataclass(frozen=True)
class ByteNet:
    names: list[str]
    pairs: list[tuple[np.ndarray, np.ndarray | None]]  # per width: table of its first pair, table of the rest
    dense: np.ndarray
    bias: np.ndarray

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        """Windows of bytes (n x WINDOW) to log probabilities (n x languages)."""
        pair = (windows[:, :-1].astype(np.uint16) << 8) | windows[:, 1:]
        tops = []
        for width, (first, rest) in zip(WIDTHS, self.pairs, strict=True):
            n = windows.shape[1] - width + 1
            answer = first[pair[:, :n]]
            if rest is not None:
                answer += rest[windows[:, 2:] if width == 3 else pair[:, 2:]]
            tops.append(answer.max(axis=1))
        z = np.maximum(np.hstack(tops), 0) @ self.dense + self.bias
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def cut(data: bytes, size: int = WINDOW) -> np.ndarray:
    """All windows of a text; the last is padded with zero bytes."""
    n = max(1, -(-len(data) // size))
    return np.frombuffer(data.ljust(n * size, b"\0"), np.uint8).reshape(n, size)


def train(windows: np.ndarray, labels: np.ndarray, names: list[str], epochs: int = 6, batch: int = 64,
          rate: float = 3e-3, seed: int = 7) -> ByteNet:
    rng = np.random.default_rng(seed)
    weights = {"e": rng.normal(0, 0.5, (256, EMBED))}
    for w in WIDTHS:
        weights[f"f{w}"] = rng.normal(0, (w * EMBED) ** -0.5, (w * EMBED, FILTERS))
        weights[f"b{w}"] = np.zeros(FILTERS)
    weights["d"] = rng.normal(0, 0.2, (FILTERS * len(WIDTHS), len(names)))
    weights["c"] = np.zeros(len(names))
    p = {k: v.astype(np.float32) for k, v in weights.items()}
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), batch):
            x, y = windows[order[at:at + batch]], labels[order[at:at + batch]]
            rows = np.arange(len(x))
            e = p["e"][x]
            tops, where = [], []
            for w in WIDTHS:
                n = x.shape[1] - w + 1
                patches = np.concatenate([e[:, i:i + n] for i in range(w)], axis=2)
                answer = patches @ p[f"f{w}"] + p[f"b{w}"]
                where.append(best := answer.argmax(axis=1))
                tops.append(np.take_along_axis(answer, best[:, None, :], 1)[:, 0])
            h = np.maximum(np.hstack(tops), 0)
            z = h @ p["d"] + p["c"]
            z = np.exp(z - z.max(axis=1, keepdims=True))
            z /= z.sum(axis=1, keepdims=True)
            z[rows, y] -= 1
            z /= len(x)
            g = {"d": h.T @ z, "c": z.sum(axis=0), "e": np.zeros_like(p["e"])}
            gh = (z @ p["d"].T) * (h > 0)
            for i, w in enumerate(WIDTHS):
                gt, at_best = gh[:, i * FILTERS:(i + 1) * FILTERS], where[i]
                seen = x[rows[:, None, None], at_best[:, :, None] + np.arange(w)]  # bytes under each filter's maximum
                patch = p["e"][seen]
                g[f"f{w}"] = np.einsum("nkwd,nk->wdk", patch, gt).reshape(w * EMBED, FILTERS)
                g[f"b{w}"] = gt.sum(axis=0)
                back = np.einsum("nk,wdk->nkwd", gt, p[f"f{w}"].reshape(w, EMBED, FILTERS))
                np.add.at(g["e"], seen.ravel(), back.reshape(-1, EMBED))
            step += 1
            lr = rate * (1 if epoch < epochs - 2 else 0.3)
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                p[k] = p[k] - (lr * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return fold_tables(p, names)


def fold_tables(p: dict[str, np.ndarray], names: list[str]) -> ByteNet:
    """Filter banks as lookup tables over bytes and byte pairs."""
    pairs = []
    for w in WIDTHS:
        one = [p["e"] @ p[f"f{w}"][i * EMBED:(i + 1) * EMBED] for i in range(w)]
        two = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, FILTERS)
        rest = None if w == 2 else one[2] if w == 3 else two(one[2], one[3])
        pairs.append((two(one[0], one[1]) + p[f"b{w}"], rest))
    return ByteNet(names, pairs, p["d"], p["c"])


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang") -> ByteNet | None:
    """Network from the labelled rows of ``docs``; None if there are none.

    Every language is learned, from about ``per_language`` texts, or from its part
    of ``SAMPLE_ROWS`` where that is less.
    """
    known = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")) \
        .filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = checkpointed(known.groupBy("lang").count())
    n_languages = counts.count()
    if not n_languages:
        return None
    per_language = max(1, min(per_language, SAMPLE_ROWS // n_languages))
    share = counts.select(F.col("lang").alias("name"), F.least(F.lit(1.0), F.lit(float(per_language)) / F.col("count")).alias("share"))
    drawn = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("fit")), F.lit(1 << 30))
    chosen = known.join(small_side(share), F.col("lang") == F.col("name")) \
        .filter(drawn < F.col("share") * F.lit(1 << 30)).select("lang", "text")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text"):
            langs, found = [], []
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), strict=True):
                if text.decode().strip() and any(map(str.isalpha, text.decode())):
                    every = cut(text)
                    for i in sorted({0, len(every) // 2, max(0, len(every) - 2)}):
                        langs.append(lang)
                        found.append(every[i].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(found, pa.binary())], ["lang", "w"])

    rows = stored(chosen.mapInArrow(windows, "lang string, w binary"), "windows")
    rows = at_most(rows, 6 * per_language * n_languages).toArrow()  # three windows a text, twice the texts
    pairs = sorted(zip(rows.column("lang").to_pylist(), rows.column("w").to_pylist(), strict=True))
    if not pairs:
        return None
    names = sorted({lang for lang, _ in pairs})
    x = np.frombuffer(b"".join(w for _, w in pairs), np.uint8).reshape(-1, WINDOW)
    return train(x, np.array([names.index(lang) for lang, _ in pairs]), names)


def predict(docs: DataFrame, net: ByteNet | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` of every whole text."""
    kept = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if net is None:
        return kept.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    kept = kept.withColumn("lettered", F.col("text").rlike(r"\p{L}"))
    sent = docs.sparkSession.sparkContext.broadcast((net.names, net.pairs, net.dense, net.bias))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = ByteNet(*sent.value)
        for b in chunks(batches, "text", 1 << 18):
            texts = b.column(1).cast(pa.binary()).to_pylist()
            owners = np.repeat(np.arange(len(texts)), [max(1, -(-len(t) // WINDOW)) for t in texts])
            weight = np.concatenate([np.diff([*range(0, max(1, len(t)), WINDOW), max(1, len(t))]) for t in texts])
            sums = np.zeros((len(texts), len(n.names)))
            x = np.concatenate([cut(t) for t in texts])
            for at in range(0, len(x), 512):
                part = slice(at, at + 512)
                np.add.at(sums, owners[part], n.log_probabilities(x[part]) * weight[part, None])
            sums /= np.bincount(owners, weight, len(texts))[:, None]
            odds = np.exp(sums - sums.max(axis=1, keepdims=True))
            odds /= odds.sum(axis=1, keepdims=True)
            lettered = np.array(b.column(2).to_pylist())
            best = odds.argmax(axis=1)
            lang = [n.names[i] if ok else "und" for i, ok in zip(best, lettered, strict=True)]
            score = np.where(lettered, odds[np.arange(len(best)), best], 0.0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                             ["doc_id", "lang_pred", "score"])

    return kept.mapInArrow(answer, f"doc_id {kept.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """Learns from the documents outside the held-out fold, predicts all of them."""
    net = fit(docs.filter(fold("doc_id", 5) != 0), per_language)
    return predict(docs, net).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")

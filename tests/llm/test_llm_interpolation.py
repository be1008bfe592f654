"""Deleted interpolation against a brute-force model."""
import collections
import math
import re
import zlib

import numpy as np
import pytest

from batchtrace.llm import interpolation_lm as M


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def crc(d):
    return zlib.crc32(str("" if d is None else d).encode())


@pytest.mark.parametrize("block", [2000, M.BLOCK_BYTES])
def test_scores_equal_brute_force(spark, odd, monkeypatch, block):
    monkeypatch.setattr(M, "BLOCK_BYTES", block)
    seen = []
    learn = M.learn_weights
    monkeypatch.setattr(M, "learn_weights", lambda *a: seen.append((learn(*a), a)) or seen[-1][0])
    got = M.score(odd, buckets=5).collect()
    weights = seen[0][0]
    docs = odd.collect()
    train = [r for r in docs if crc(r.doc_id) % 5 != 1]
    word = collections.Counter(w for r in train for w in tokens(r.text))
    pair = collections.Counter(p for r in train for t in [tokens(r.text)] for p in zip([False, *t], t))
    before = collections.Counter(w for r in train for w in [False, *tokens(r.text)[:-1]])
    n, v = sum(word.values()), len(word)
    want = []
    for r in docs:
        t = tokens(r.text)
        base = score = 0.0
        for u, w in zip([False, *t], t):
            b = (word[w] + 0.5) / (n + 0.5 * (v + 1))
            x = weights[0 if not before[u] else 1 + int(math.log2(before[u]))]
            base += math.log10(b)
            score += math.log10(x[0] * pair[u, w] / max(before[u], 1) + x[1] * word[w] / n + x[2] * b)
        want.append((r.doc_id, crc(r.doc_id) % 5 == 1, len(t), sum(word[w] > 0 for w in t), n, base, score))
    key = lambda x: (str(x[0]), x[2])
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5]) and a[6] == pytest.approx(b[6])


def test_em_learns_the_mixture(spark):
    """Held-out counts drawn from the bigram part only give it nearly all the weight."""
    rows = [(3, 4, 5, 10, 100), (3, 0, 5, 1, 1), (0, 0, 0, 10, 50)]
    w = M.learn_weights(spark.createDataFrame(rows, "bucket int, pair long, context long, word long, times long"), 10_000, 50)
    assert w[3][0] > 0.9 and np.allclose(w.sum(axis=1), 1) and w[0][0] == 0 and (w[:, 2] > 0).all()


def test_changed_input_is_noticed():
    import pyarrow as pa
    import zstandard
    block = M.Block([b"a b c"], M.WordHashes())
    body = pa.table({"texts": [zstandard.compress(b"a b d")], "sizes": [[5]]})
    packed = {k: M.pack(np.ones(len(x), np.int64)) for k, x in ((1, block.words), (2, block.pairs))}
    answers = pa.table({"kind": [1, 2], "bucket": [0, 0], "mark": [block.mark] * 2,
                        "fit": [packed[1], packed[2]], "every": [packed[1], packed[2]]})
    with pytest.raises(RuntimeError):
        M._open(body, answers)


def test_pack_round_trip():
    x = np.random.default_rng(0).integers(0, 1 << 63, 1000, dtype=np.uint64)
    assert (M.unpack(M.pack(x)) == x).all() and len(M.unpack(M.pack(x[:0]))) == 0


def test_empty_and_untrained(spark, empty):
    assert M.score(empty).count() == 0
    ids = [i for i in range(40) if crc(i) % 5 == 1][:3]
    rows = M.score(spark.createDataFrame([(i, "a b") for i in ids], "doc_id long, text string")).collect()
    assert len(rows) == 3 and all(r.held_out and r.train_tokens == 0 and r.base_score == 0 and r.n_known == 0 for r in rows)


def test_known_text_scores_higher(spark, sf_small):
    rows = M.score(spark.read.parquet(f"{sf_small}/documents.parquet")).collect()
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_buckets_without_held_out_tokens_take_their_neighbours_weights(spark):
    kind = "bucket int, pair long, context long, word long, times long"
    w = M.learn_weights(spark.createDataFrame([(3, 4, 5, 10, 100), (9, 2, 400, 30, 70)], kind), 10_000, 50)
    assert (w[1] == w[3]).all() and (w[6] == w[3]).all() and (w[7] == w[9]).all() and (w[63] == w[9]).all()
    assert w[0][0] == 0 and np.allclose(w.sum(axis=1), 1)  # an unseen context's probabilities add up to 1
    none = M.learn_weights(spark.createDataFrame([], kind), 10, 5)
    assert none[0][0] == 0 and np.allclose(none.sum(axis=1), 1)


def test_the_number_of_buckets_follows_the_bytes(spark, monkeypatch):
    asked = []
    ask = M._ask
    monkeypatch.setattr(M, "_ask", lambda kept, buckets: asked.append(buckets) or ask(kept, buckets))
    docs = spark.createDataFrame([(i, "some words here " * 50) for i in range(40)], "doc_id long, text string")
    want = sorted(map(tuple, M.score(docs).collect()))
    monkeypatch.setattr(M, "BUCKET_BYTES", 1000)
    assert sorted(map(tuple, M.score(docs).collect())) == want and asked == [4, 32]

"""Presence-mask search against scoring every document, in Python and in SQL."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from batchtrace.llm import mask_search as S
from tests.llm.conftest import ROWS

_TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return _TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, top=10):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(n for _, _, n in counts)
    holders = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c, n in counts:
            m = 100 - 90 + 90 * n * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in set(terms(text)) if t in c)
            if score > 0:
                found.append((-score, i is not None, i or 0, i))
        out += [(item, k, i, -s) for k, (s, _, _, i) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=str)


def corpus(seed, n=300):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Über", "naïve", "漢字", "ABC", "x-y"]
    deal = lambda k: " ".join(rng.choice(words) if rng.random() < .5 else rng.choice(words[:6]) for _ in range(k))
    docs = [(i, deal(rng.randrange(0, 40))) for i in range(n)] + [(n + j, "w1 w2 w3 w1") for j in range(60)]  # copies: ties
    docs += [(n + 100, deal(20000)), (n + 101, None), (n + 102, ""), (n + 103, "?!"), (None, "w7 w8"), (5, "w7 w8"), (5, "w7 w8")]
    return docs, [(j, deal(rng.randrange(1, 90))) for j in range(12)] + [(50, None), (51, "..."), (52, "unheard of"), (53, " ".join(words * 3)), (1, "w9")]


@pytest.mark.parametrize("seed, sizes", [(1, (200_000, 4096)), (2, (100, 37)), (3, (1, 5))])
def test_search_equals_scoring_all(spark, seed, sizes):
    docs, items = corpus(seed, 300 if sizes[0] > 1 else 60)
    items = items if sizes[0] > 1 else items[:4]
    extra = {c: F.lit("extra") for c in ("score", "rank", "item", "n", "terms", "times")}
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns(extra).repartition(4)
    asked = spark.createDataFrame(items, "item_id long, text string").withColumns(extra).repartition(2)
    got = S.search(df, asked, block_terms=sizes[0], block_docs=sizes[1])
    assert sorted(map(tuple, got.collect()), key=str) == plain(docs, items)


def test_search_of_odd_documents(spark, odd, empty):
    items = spark.createDataFrame([(1, "tree STONE river 漢字かな交じり文 é"), (2, "café42 über alles")], "item_id long, text string")
    got = S.search(odd, items)
    assert sorted(map(tuple, got.collect()), key=str) == plain([(i, t) for i, t, _, _ in ROWS], [tuple(r) for r in items.collect()])
    assert S.search(empty, items).count() == 0 and S.search(odd, items.limit(0)).count() == 0
    assert S.search(empty, items).columns == ["item_id", "rank", "doc_id", "score"]


def test_sql_equals_scoring_all():
    docs, items = corpus(4)
    con = duckdb.connect()
    for name, rows in (("documents(doc_id", docs), ("benchmark(item_id", items)):
        con.execute(f"CREATE TABLE {name} BIGINT, text VARCHAR)")
        con.executemany(f"INSERT INTO {name.split('(')[0]} VALUES (?, ?)", rows)
    assert sorted(con.execute(S.ORACLE_SQL).fetchall(), key=str) == plain(docs, items)


def test_masks_group_documents_alike_only_if_all_terms_agree():
    rng = np.random.default_rng(5)
    for n_terms in (1, 8, 63, 64, 65, 200):
        held = rng.random((n_terms, 90)) < .05
        held[:, 40:60] = held[:, :20]
        group, first = S.group_by_mask(held)
        masks = [held[:, d].tobytes() for d in range(90)]
        assert len(first) == len(set(masks)) and all(masks[first[g]] == m for g, m in zip(group, masks))


def test_weak_masks_are_never_scored():
    """Masks whose maximum is below the k-th score stay unread, also across blocks."""
    n = 2000
    strong = [[1, 2, 3]] * 20 + [[1]] * (n - 20)
    ids, sizes = pa.array(range(n), pa.int64()), np.full(n, 3)
    lists = pa.array(strong, pa.list_(pa.int32()))
    block = S.DocumentBlock(ids, sizes, lists, pa.array([[1] * len(x) for x in strong], pa.list_(pa.int64())), n, 3 * n)
    best, w = S.TopList(10), np.array([100, 200, 300])
    assert S.search_block(block, np.array([1, 2, 3]), w, best) < 200  # one batch of masks at most, not 2000
    assert best.ids.tolist() == list(range(10))
    again = S.search_block(block, np.array([1, 2, 3]), w, best)
    assert again == 20  # only the mask that ties with the list

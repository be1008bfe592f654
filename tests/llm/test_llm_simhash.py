"""SimHash: fingerprints, bit-sliced distances and classes against brute force."""
import re

import numpy as np
import pytest
import xxhash
from conftest import prose

from batchtrace.llm import simhash as S
from batchtrace.llm.components import components


def brute_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    runs = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_classes(prints, ids):
    up = list(range(len(prints)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 3:
                up[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(ids))]


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_bit_sliced_distances(radius):
    rng = np.random.default_rng(radius)
    a = rng.integers(0, 1 << 63, 70_000, dtype=np.uint64)
    b = a.copy()
    for _ in range(5):
        flip = rng.random(len(a)) < 0.5
        b[flip] ^= np.uint64(1) << rng.integers(0, 64, flip.sum()).astype(np.uint64)
    want = np.array([int(x).bit_count() <= radius for x in a ^ b])
    assert (S.within(a, b, radius) == want).all()


def test_radius_is_checked():
    with pytest.raises(ValueError):
        S.within(np.zeros(1, np.uint64), np.zeros(1, np.uint64), 4)


def test_odd_documents(odd, empty):
    docs = odd.collect()
    prints = [brute_print(r.text) for r in docs]
    want = sorted(zip([r.doc_id for r in docs], [f"{p:016x}" for p in prints], brute_classes(prints, [r.doc_id for r in docs])), key=repr)
    got = sorted(map(tuple, S.near_duplicates(odd).collect()), key=repr)
    assert got == want
    kept = S.keep_one(odd)
    assert kept.columns == odd.columns
    # one row of each class, counted by rows: two classes may have the same least id, or none
    classes = brute_classes(prints, range(len(prints)))
    assert kept.count() == len(set(classes))
    assert S.near_duplicates(empty).count() == 0 and S.keep_one(empty).count() == 0


@pytest.mark.parametrize("chunk", [3, 2048])
def test_links_of_dense_groups(spark, chunk):
    """Chains and a crowded ball: spanning links give the brute-force classes, also when a key is dealt out."""
    rng = np.random.default_rng(1)
    centre = int(rng.integers(0, 1 << 62))
    prints = {centre}
    while len(prints) < 120:
        x = centre
        for k in rng.integers(0, 64, rng.integers(1, 8)):
            x ^= 1 << int(k)
        prints.add(x)
    prints |= {int(x) for x in rng.integers(0, 1 << 62, 60)}
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = S.links(spark.createDataFrame([(p,) for p in signed], "fp long"), 3, chunk).collect()
    assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= 3 for r in found)
    roots = {r.node: r.root for r in components(spark.createDataFrame([(r.a, r.b) for r in found], "a long, b long")).collect()}
    got = [roots.get(p, p) for p in signed]
    want = brute_classes(prints, signed)
    assert [got.index(x) for x in got] == [want.index(x) for x in want]


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components(links).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {501: 500}


def test_near_copies_join_and_others_do_not(spark):
    text = prose(11, 900)
    near = text.replace(text.split()[450], "changed", 1)
    rows = [(5, text), (2, near), (9, prose(12, 900)), (7, "".join(c.upper() if c.isascii() else c for c in text))]
    got = {r.doc_id: r.component_id for r in S.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[5] == got[7] and got[9] == 9

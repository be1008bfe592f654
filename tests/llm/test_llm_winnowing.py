"""Winnowing against a plain-Python rule over the operator's own hashes."""
import hashlib
import re
import time

import regex
from conftest import prose
from pyspark.sql import functions as F

from batchtrace.llm import winnowing as N

TOKEN = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]"
                      r"|[^\s\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]{1,16}")


def runs(text, k=4):
    tokens = TOKEN.findall((text or "").lower())
    return [tuple(tokens[i:i + k]) for i in range(len(tokens) - k + 1)] or ([tuple(tokens)] if tokens else [])


def test_positions_name_one_hash_and_leave_no_window_out(odd):
    by_hash = {}
    for r in N.fingerprints(odd).join(odd.select("doc_id"), "doc_id", "left_semi").collect():
        texts = [t.text for t in odd.filter(f"doc_id = {r.doc_id}").collect()]
        fits = [g for g in map(runs, texts) if all(p.pos < len(g) for p in r.fingerprint) and bool(g) == bool(r.fingerprint)]
        assert fits
        g = fits[0] if len(set(map(str, fits))) == 1 else None
        if g:
            for p in r.fingerprint:
                assert by_hash.setdefault(p.hash, g[p.pos]) == g[p.pos]
            at = sorted(p.pos for p in r.fingerprint)
            if at:
                assert at[0] < 4 and at[-1] >= len(g) - 4 and all(b - a <= 4 for a, b in zip(at, at[1:]))


def test_window_minima_with_rightmost_ties(spark):
    """Few distinct tokens give many ties; order and choice are recomputed from the run hashes themselves."""
    texts = [" ".join(prose(s, 40).split()[i % 3] for i in range(60)) for s in range(5)] + ["a a a a a a a a a a a a"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    full = {r.doc_id: [p.hash for p in r.fingerprint] for r in N.fingerprints(docs, k=4, w=1).collect()}
    every = {}
    for r in N.fingerprints(docs, k=4, w=1).collect():
        every[r.doc_id] = {p.pos: p.hash for p in r.fingerprint}
    for r in N.fingerprints(docs, k=4, w=5).collect():
        hashes = every[r.doc_id]
        assert sorted(hashes) == list(range(len(hashes))) and full[r.doc_id]
        order = lambda i: ((hashes[i] & (1 << 64) - 1) >> 33, -i)  # noqa: E731, B023
        want = {min(range(s, s + 5), key=order) for s in range(len(hashes) - 4)}
        assert {p.pos for p in r.fingerprint} == want


def test_shared_run_shares_a_hash(spark):
    common = prose(50, 7)  # k + w - 1 tokens
    docs = spark.createDataFrame([(1, prose(51, 30) + " " + common + " " + prose(52, 9)), (2, common + " " + prose(53, 40))],
                                 "doc_id long, text string")
    a, b = ({p.hash for p in r.fingerprint} for r in N.fingerprints(docs).collect())
    assert a & b


def brute(rows):
    """Edited texts and neighbours in descending order of id, nulls last, then by text hash order of the operator."""
    out = {}
    for i, (d, t) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1]
        cut = len(t) // 3
        out[d] = hashlib.sha256((t[:len(t) - cut] + nxt[:cut]).encode()).hexdigest()
    return out


def test_neighbours_and_edits(spark, odd):
    rows = [(i * 3, prose(i, 5 + i * 7 % 50)) for i in range(60)] + [(500, ""), (501, "é🙂 x"), (502, "one two three four five six")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in N.neighbour_likeness(docs).collect()}
    down = sorted(rows, reverse=True)
    want = brute(down)
    prints = {r.doc_id: {p.hash for p in r.fingerprint} for r in N.fingerprints(docs).collect()}
    for i, (d, t) in enumerate(down):
        a, b = prints[d], prints[down[(i + 1) % len(down)][0]]
        assert got[d].edited_sha256 == want[d] and got[d].n_chars == len(t)
        assert got[d].near_next == (len(a & b) / len(a | b) if a | b else 1.0)
        assert 0 <= got[d].near_edited <= 1
    assert sum(r.near_edited for r in got.values()) / len(got) > 0.3
    assert got[500].near_edited == 1.0


def test_odd_and_empty_tables(spark, odd, empty):
    got = N.neighbour_likeness(odd).collect()
    assert len(got) == odd.count()
    same = [r for r in got if r.doc_id == 3]
    assert len({r.fingerprint for r in same}) == 2  # two equal texts and another
    assert N.neighbour_likeness(empty).count() == 0
    alone = N.neighbour_likeness(spark.createDataFrame([(1, "a b c d e f g")], "doc_id long, text string")).first()
    assert alone.near_next == 1.0


def test_native_plan(odd):
    plan = N.neighbour_likeness(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_each_short_or_unspaced_text_is_near_its_edited_text(spark):
    solid = hashlib.sha256(b"x").hexdigest() * 2
    texts = ["walking rivers", "Einzelwort", "one stone underneath", "five words are here now", "seven short words are in this text",
             "eight short words are in this text 8", "tree " + solid, "漢字かな交じり文とテスト文", "ཀཁགངཅཆཇཉཏཐདན" * 4]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.near_edited for r in N.neighbour_likeness(docs).collect()}
    assert all(0 < got[i] < 1 for i in range(len(texts))), sorted(got.items())


def test_unspaced_passage_matches_at_any_offset(spark):
    solid = hashlib.sha256(b"x").hexdigest()
    tail = " ".join(f"w{i}" for i in range(9))
    docs = spark.createDataFrame([(i, f"{'z' * i}{solid} {tail}{i}") for i in range(17)], "doc_id long, text string")
    prints = {r.doc_id: {p.hash for p in r.fingerprint if p.pos < 3} for r in N.fingerprints(docs).collect()}
    assert all(len(prints[0] & prints[i]) > 10 for i in range(17))


PLAIN = rf"[{N._UNSPACED}]|[^\s{N._UNSPACED}]{{1,16}}"  # one script after the other for every letter


def test_tokens_of_every_code_point(spark):
    """The ranges of TOKEN are the plain rule, for each letter and for runs of neighbours."""
    points = [chr(i) for i in range(1, 0x110000) if not 0xD800 <= i < 0xE000]
    texts = ["".join(points[i:i + 1024]) for i in range(0, len(points), 1024)] + [" ".join(points[i:i + 1024]) for i in range(0, len(points), 1024)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    found = lambda rule: F.regexp_extract_all("text", F.lit(rule), F.lit(0))
    got = df.agg(F.count_if(found(N.TOKEN) != found(PLAIN)).alias("other"), F.sum(F.size(found(N.TOKEN))).alias("n")).first()
    assert got.other == 0 and got.n > len(points)


def test_letters_of_spaced_scripts_are_not_looked_up(spark):
    """Cutting Latin text takes well under half the time of a lookup of each letter's script."""
    docs = spark.createDataFrame([(prose(i, 4000) * 10,) for i in range(40)], "text string").repartition(2).cache()

    def took(rule):
        began = time.perf_counter()
        docs.select(F.sum(F.size(F.regexp_extract_all("text", F.lit(rule), F.lit(0))))).collect()
        return time.perf_counter() - began

    assert min(took(N.TOKEN) for _ in range(4)) < 0.6 * min(took(PLAIN) for _ in range(4))
    docs.unpersist()


def test_steps_are_not_copied_with_the_row(odd):
    plan = N.fingerprints(odd)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"\bProject \[", plan)) <= 3


def test_each_bucket_is_a_task(spark):
    docs = spark.createDataFrame([(i if i % 40 else None, prose(i, 5)) for i in range(2000)], "doc_id long, text string")
    rows = N.with_successor(docs, buckets=16)[0].select("bucket", F.spark_partition_id().alias("task")).distinct().collect()
    buckets = {r.bucket for r in rows}
    assert -1 in buckets and len(buckets) >= 16
    assert len(rows) == len(buckets) == len({r.task for r in rows})

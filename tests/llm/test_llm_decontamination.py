"""Decontamination against SQL and brute force."""
import duckdb
import pytest
from conftest import ROWS, prose

from batchtrace.llm import decontamination as D


@pytest.fixture(scope="module")
def case(spark):
    items = [(1, prose(1, 60).split(" ", 20)[20][:90]), (2, "Single"), (3, "don't X9 river"), (4, None), (5, ""), (6, "..."),
             (7, prose(8, 12)), (8, prose(3, 300)), (None, "tail"), (9, prose(3, 300)), (2, "light light light light light light")]
    docs = [(r[0], r[1]) for r in ROWS] + [(20, "x, " + prose(8, 12).upper().replace(" ", " -- ") + " y"), (21, "ÜBER über"),
                                           (22, " ".join(["light"] * 30)), (23, prose(8, 11)), (24, prose(8, 12) + " " + prose(8, 12))]
    return (spark.createDataFrame(docs, "doc_id long, text string").repartition(2),
            spark.createDataFrame(items, "item_id long, text string"))


def sql(docs, items):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR); CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [tuple(r) for r in docs.collect()])
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", [tuple(r) for r in items.collect()])
    return con.execute(D.ORACLE_SQL).fetchall()


def test_equals_sql(case):
    docs, items = case
    got = [tuple(r) for r in D.contamination(docs, items).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, sql(docs, items)))
    assert sum(r[-1] for r in got) >= 6


def test_blocks_of_the_benchmark_find_the_same(case):
    docs, items = case
    one = D.find_windows(docs, items)[1]
    many = D.find_windows(docs, items, block_shingles=7)[1]
    assert sorted(map(repr, one.distinct().collect())) == sorted(map(repr, many.distinct().collect()))


def test_decontaminate_keeps_clean_rows_whole(odd, case):
    items = case[1]
    kept = D.decontaminate(odd, items)
    flags = D.contamination(odd, items)
    assert kept.columns == odd.columns
    assert kept.count() == flags.filter("NOT contaminated").count() < odd.count()


def test_empty_sides(spark, case, empty):
    docs, items = case
    rows = D.contamination(docs, items.limit(0)).collect()
    assert len(rows) == docs.count() and all(r.n_hit == r.n_items == 0 and not r.contaminated for r in rows)
    assert D.contamination(docs.limit(0), items).count() == 0
    assert D.decontaminate(empty, items).count() == 0

"""Language identification and quality: held-out accuracy, gradients, odd rows."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from batchtrace.llm import language_id as L
from batchtrace.llm import quality as Q


@pytest.fixture(scope="module")
def docs(spark, sf_small):
    return spark.read.parquet(f"{sf_small}/documents.parquet")


def test_tables_equal_the_convolution():
    rng = np.random.default_rng(0)
    p = {"e": rng.normal(size=(256, L.EMBED)), "d": rng.normal(size=(L.FILTERS * 3, 3)), "c": rng.normal(size=3)}
    for w in L.WIDTHS:
        p[f"f{w}"], p[f"b{w}"] = rng.normal(size=(w * L.EMBED, L.FILTERS)), rng.normal(size=L.FILTERS)
    net = L.fold_tables(p, ["a", "b", "c"])
    x = rng.integers(0, 256, (4, L.WINDOW)).astype(np.uint8)
    tops = []
    for w in L.WIDTHS:
        n = L.WINDOW - w + 1
        patches = np.concatenate([p["e"][x][:, i:i + n] for i in range(w)], axis=2)
        tops.append((patches @ p[f"f{w}"] + p[f"b{w}"]).max(axis=1))
    z = np.maximum(np.hstack(tops), 0) @ p["d"] + p["c"]
    assert np.allclose(net.log_probabilities(x), z - np.log(np.exp(z).sum(axis=1, keepdims=True)))


def test_windows_cover_the_whole_text():
    data = bytes(range(1, 251)) * 5
    assert L.cut(data).tobytes().rstrip(b"\0") == data
    assert L.cut(b"").shape == (1, L.WINDOW)


def test_held_out_accuracy_and_odd_rows(docs, odd, empty):
    got = {r.doc_id: r for r in L.identify(docs, per_language=60).collect()}
    truth = {r.doc_id: r.lang for r in docs.collect()}
    held = [d for d, r in got.items() if r.held_out]
    assert len(got) == len(truth) and np.mean([got[d].lang_pred == truth[d] for d in held]) >= 0.9
    net = L.fit(docs, 20)
    rows = L.predict(odd, net).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    und = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert und == {4, 5, 6, 11, None}
    assert L.predict(empty, net).count() == 0
    assert {r.lang_pred for r in L.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_ordinal_fit_finds_ordered_grades():
    rng = np.random.default_rng(3)
    truth = rng.normal(size=40)
    rows = [np.unique(rng.integers(0, 40, 6)).astype(np.int32) for _ in range(3000)]
    s = np.array([truth[r].sum() for r in rows]) + rng.logistic(size=3000) * 0.3
    grades = np.digitize(s, [-1.0, 1.0])
    model = Q.fit_ordinal(rows, grades, bits=6, least=1, steps=400)
    assert np.all(np.diff(model.thresholds) > 0)
    assert np.corrcoef(model.weights[:40], truth)[0, 1] > 0.95
    tails = model.tails(np.array([model.score(r) for r in rows]))
    assert np.all(np.diff(tails, axis=1) <= 0) and np.mean((tails[:, 1:] >= 0.5).sum(axis=1) == grades) > 0.8


def test_slots_are_a_set_and_empty_texts_have_none():
    assert len(Q.slots(b"")) == 0 and len(Q.slots(b" \n")) == 0
    a = Q.slots("Größe WORD!! word".encode())
    assert np.array_equal(a, np.unique(a)) and len(a) > 5


def test_quality_keeps_good_and_drops_bad(spark, sf_small, docs):
    labels = spark.read.parquet(f"{sf_small}/labels.parquet")
    grades = labels.select("doc_id", F.when(F.col("toxic") == 1, 0).otherwise(1 + F.col("quality")).alias("grade"))
    tails = {r.doc_id: r.tail_probability for r in Q.score(docs, Q.fit(docs, grades)).collect()}
    assert len(tails) == docs.count()
    rows = grades.collect()
    assert np.mean([(tails[r.doc_id] >= 0.5) == (r.grade == 2) for r in rows]) > 0.9


def test_no_ratings_reject_nothing(odd, empty, spark):
    none = spark.createDataFrame([(None, 1), (3, None), (99, 2)], "doc_id long, grade int")
    rows = Q.score(odd, Q.fit(odd, none)).collect()
    assert len(rows) == odd.count() and all(r.tail_probability == 1 and r.expected_grade == 0 for r in rows)
    model = Q.OrdinalModel(np.zeros(1 << Q.SLOT_BITS, np.float32), np.array([-1.0, 1.0]))
    graded = Q.with_grades(odd, model, expected="e", tail="t")
    assert graded.columns == [*odd.columns, "e", "t"] and graded.count() == odd.count()
    assert Q.with_grades(empty, model, expected="e", tail="t").count() == 0


def test_a_rated_id_on_many_rows_keeps_the_sample_bounded(spark, monkeypatch):
    rows = [(7, f"good text number {i}") for i in range(5000)] + [(8, "bad text"), (9, "other text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ratings = spark.createDataFrame([(7, 2), (8, 0), (9, 1)], "doc_id long, grade int")
    sizes, fit = [], Q.fit_ordinal
    monkeypatch.setattr(Q, "fit_ordinal", lambda found, grades, bits: sizes.append(len(found)) or fit(found, grades, bits))
    Q.fit(docs, ratings, fit_rows=10)
    assert sizes[0] <= 20


def test_every_language_is_learned_from_a_bounded_sample(spark, monkeypatch):
    monkeypatch.setattr(L, "SAMPLE_ROWS", 400)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(i, " ".join([letters[k % 26] * 3 + letters[(k * 7 + 3) % 26] * 2] * 30), f"l{k:03d}") for i, k in enumerate(list(range(210)) * 3)]
    rows += [(5, "hot " * 40, "l000")] * 3000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen, train = [], L.train
    monkeypatch.setattr(L, "train", lambda x, y, names: seen.append((len(x), names)) or train(x, y, names))
    net = L.fit(docs)
    assert len(net.names) > 100 and seen[0][0] <= 6 * 210  # more than any cap on languages; windows stay bounded

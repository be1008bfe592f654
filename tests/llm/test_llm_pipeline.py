"""The pipeline stage by stage, and the registered queries."""
import pytest

import __spark_entry__ as E
import corpus_pipeline


@pytest.fixture(scope="module")
def stages(spark, sf_small):
    from batchtrace.llm.common import stored
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        out.append((name, stored(stage(spark, out[-1][1], sf_small), "stage")))
    return out


def test_stage_names_and_columns(stages):
    assert [n for n, _ in stages][1:] == ["quality", "near_duplicates", "decontamination", "mixing", "token_output"]
    for _, df in stages[:-1]:
        assert df.columns == stages[0][1].columns
    assert stages[-1][1].columns[:4] == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_decisions_take_effect(spark, sf_small, stages):
    from batchtrace.llm import decontamination, mixing, simhash
    frames = dict(stages)
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf_small}/labels.parquet").collect()}
    kept = {r.doc_id for r in frames["quality"].collect()}
    judged = [(d in kept) == (r.quality == 1 and r.toxic == 0) for d, r in labels.items()]
    assert sum(judged) / len(judged) > 0.9
    classes = simhash.near_duplicates(frames["quality"]).collect()
    assert {r.doc_id for r in frames["near_duplicates"].collect()} == {r.component_id for r in classes}
    hit = decontamination.contamination(frames["near_duplicates"], spark.read.parquet(f"{sf_small}/benchmark.parquet"))
    clean = {r.doc_id for r in hit.collect() if not r.contaminated}
    assert {r.doc_id for r in frames["decontamination"].collect()} == clean
    plan = {r.doc_id: r.copies for r in mixing.mix_plan(frames["decontamination"]).collect()}
    got = [r.doc_id for r in frames["mixing"].collect()]
    assert {d: got.count(d) for d in plan} == plan
    rows = sorted(frames["token_output"].collect(), key=lambda r: r.start)
    # the shards hold the copies in training order, as the mix was written
    files = sorted(frames["mixing"].inputFiles())
    written = [d for f in files for d in spark.read.parquet(f).toPandas()["doc_id"]]
    again = [r.doc_id for r in mixing.mix(frames["decontamination"]).collect()]
    assert [r.doc_id for r in rows] == written == again and written != sorted(written)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:]))


def test_all_operators_are_registered():
    names = E.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14)) and "pipeline" in names
    assert {"op3_mixing", "op4_decontamination"} <= set(E.oracle_sql())


def test_odd_rows_pass_all_stages(spark, odd, sf_small):
    docs = odd.select("doc_id", "text", "lang", "source")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_small)
    assert docs.count() >= 0

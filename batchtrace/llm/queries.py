"""Registered queries of the training-data operators, with their parameters.

Each applies one operator to its whole table and derives the reported columns.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchtrace.llm import (decontamination, html_templates, interpolation_lm, language_id, mask_search, mixing, quality,
                            residue_mining, simhash, url_rules, winnowing)
from batchtrace.llm.common import file_order, fresh, table
from batchtrace.llm.token_counts import count_tokens
from batchtrace.llm.token_store import read_tokens, write_tokens
from batchtrace.session import scratch_path

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), VOCABULARY, limit=2048)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolation_lm.score(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3)


#: A document is kept if the top grade is at least as likely as not.
KEEP_TAIL = 0.5


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades from the labels: 0 toxic, 1 poor, 2 good; rows without both labels are not rated."""
    return table(spark, sf_dir, "labels").select(
        "doc_id", F.when(F.col("toxic") == 1, 0).when(F.col("toxic") == 0, 1 + F.col("quality")).alias("grade"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    graded = quality.score(docs, quality.fit(docs, ratings(spark, sf_dir)))
    return graded.withColumn("keep", F.col("tail_probability") >= KEEP_TAIL)


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = write_tokens(table(spark, sf_dir, "documents"), VOCABULARY, scratch_path(spark, "tokens"), end_id=2)
    return read_tokens(spark, out)


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_templates.extract(table(spark, sf_dir, "pages"))


def op10_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.neighbour_likeness(table(spark, sf_dir, "documents"), k=4, w=4)


def op11_mask_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mask_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=10)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return residue_mining.mine(residue_mining.prepare(table(spark, sf_dir, "embeddings"), scale=256, label=moved))


#: Place rules: what is under them gets their verdict.
PLACES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))


def op13_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), PLACES)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_language": op2_language,
    "op3_mixing": op3_mixing,
    "op4_decontamination": op4_decontamination,
    "op5_lm_score": op5_lm_score,
    "op6_simhash": op6_simhash,
    "op7_quality": op7_quality,
    "op8_token_output": op8_token_output,
    "op9_html_text": op9_html_text,
    "op10_winnowing": op10_winnowing,
    "op11_mask_search": op11_mask_search,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_url_rules": op13_url_rules,
}

ORACLE_SQL: dict[str, str] = {
    "op3_mixing": mixing.ORACLE_SQL,
    "op4_decontamination": decontamination.ORACLE_SQL,
    "op11_mask_search": mask_search.ORACLE_SQL,
    "op12_hard_negatives": residue_mining.ORACLE_SQL,
    "op13_url_rules": url_rules.oracle_sql(PLACES),
}

def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts, learned from the labels of these documents."""
    expected, tail = fresh(docs, "expected_grade", "tail_probability")
    graded = quality.with_grades(docs, quality.fit(docs, ratings(spark, sf_dir)), expected=expected, tail=tail)
    return graded.filter(F.col(tail) >= KEEP_TAIL).drop(expected, tail)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class, the least id's."""
    return simhash.keep_one(docs, shingle=3, radius=3)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark window."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"), window=10)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each copy taken, in training order."""
    return mixing.mix(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards of the mix in its training order, and per row what is read back from them.

    The mix was written range-sorted, so its files' names and the rows' places in
    them tell the order; rows that are not read from files go by their ids.
    """
    out = scratch_path(spark, "tokens")
    return read_tokens(spark, write_tokens(docs, VOCABULARY, out, end_id=2, order=file_order(docs)))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality), ("near_duplicates", keep_one_of_each), ("decontamination", keep_uncontaminated),
    ("mixing", mix_sources), ("token_output", write_token_ids)]

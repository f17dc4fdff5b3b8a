"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderloom.llm import (
    fingerprints,
    jaccard,
    language,
    licenses,
    lm,
    mixing,
    nearest,
    neighbours,
    personal,
    pieces,
    quality,
    ranked,
    spelling,
)
from orderloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
LLM_QUERIES: dict[str, Query] = {}
LLM_ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    LLM_QUERIES[fn.__name__] = fn
    return fn


@query
def op5_mix_sources(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


@query
def op2_quality_classifier(spark, sf_dir):
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_lm_scoring(spark, sf_dir):
    return lm.score_documents(table(spark, sf_dir, "documents"))


@query
def op3_ngram_jaccard_join(spark, sf_dir):
    return jaccard.join(table(spark, sf_dir, "documents"), width=3, num=90, den=100)


@query
def op1_document_fingerprints(spark, sf_dir):
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


@query
def op9_sentencepiece(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode_documents(docs).drop("text")


@query
def op10_embedding_dedup(spark, sf_dir):
    return neighbours.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op6_language_id(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"))


@query
def op4_license_scans(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


LLM_ORACLE["op4_license_scans"] = licenses.oracle()


@query
def op8_personal_data(spark, sf_dir):
    return personal.scan(table(spark, sf_dir, "documents"))


@query
def op11_spelling_variants(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents"))


LLM_ORACLE["op11_spelling_variants"] = spelling.oracle()


@query
def op12_exact_top_k(spark, sf_dir):
    return nearest.top_k(table(spark, sf_dir, "embeddings"))


LLM_ORACLE["op12_exact_top_k"] = nearest.ORACLE


@query
def op13_ranked_search(spark, sf_dir):
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


LLM_ORACLE["op13_ranked_search"] = ranked.ORACLE

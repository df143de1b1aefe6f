"""The operators as registered queries, over their whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat,
    decontaminate,
    fim,
    huffman,
    line_dedup,
    linkgraph,
    lm_score,
    minhash,
    mixing,
    quality,
    ranked_search,
    simhash,
    suffix_dedup,
)
from .common import stage, table
from .oracles import ORACLES

QUERIES = {}


def word_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.parse_transcripts(chat.as_transcript(table(spark, sf_dir, "conversations")))


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontaminate.find_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.report(hits)


@query
def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.sample_report(table(spark, sf_dir, "documents"))


@query
def op3_link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkgraph.judge_pages(
        table(spark, sf_dir, "pages"), block=["net/", "example.com/de/"], allow=["example.net/en/", "org/fr/"]
    )


@query
def op4_huffman(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    read = huffman.write_and_read(table(spark, sf_dir, "documents"), vocabulary or word_vocabulary())
    return huffman.digest(read)


@query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``near_docs``, for every id divisible by 100: documents within the radius,
    itself left out; null for the rest."""
    report = stage(simhash.fingerprint_report(table(spark, sf_dir, "documents")), "simhash")
    asked = F.pmod("doc_id", F.lit(100)) == 0
    near = simhash.near_counts(report, report.where(asked))
    return report.join(near, report.fingerprint == near["query"], "left").select(
        *report.columns, F.when(asked, F.col("near_docs") - 1).alias("near_docs")
    )


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.resampler(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality.decide(found)


@query
def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.report(minhash.near_duplicates(table(spark, sf_dir, "documents")))


@query
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")))


@query
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.report(fim.transform(table(spark, sf_dir, "documents")))


@query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = ranked_search.build_index(table(spark, sf_dir, "documents"))
    return ranked_search.search(index, table(spark, sf_dir, "benchmark"))


@query
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents")))


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)

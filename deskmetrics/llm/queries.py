"""The queries of this folder: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from deskmetrics.llm import ball_codes, bpe_codec, chat_tree, jaccard, langid, licenses, line_rules, mean_clusters, packing, pii, projected_nn, quality, token_counts
from deskmetrics.llm.common import table


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op3_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_projected_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projected_nn.nearest(table(spark, sf_dir, "embeddings"))


def op5_pii_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op6_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.verdicts(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op8_license_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("found")


def op9_parity_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_groups(table(spark, sf_dir, "documents"))


def op10_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe_codec.roundtrip(docs, then=bpe_codec.digests, schema=bpe_codec.DIGEST_SCHEMA)


def op11_mean_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mean_clusters.report(table(spark, sf_dir, "embeddings"))


def op12_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_tree.report(table(spark, sf_dir, "conversations"))


def op13_ball_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_codes.report(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_token_counts,
        op3_quality_trees,
        op4_projected_neighbours,
        op5_pii_candidates,
        op6_line_rules,
        op7_language_id,
        op8_license_paragraphs,
        op9_parity_jaccard,
        op10_bpe_roundtrip,
        op11_mean_clusters,
        op12_chat_tree,
        op13_ball_codes,
    )
}
#: The other operators have fitted models, libraries or searches that SQL cannot express; tests/llm holds them against plain versions.
ORACLES: dict[str, str] = {
    "op6_line_rules": line_rules.VERDICTS_SQL,
    "op9_parity_jaccard": jaccard.GROUPS_SQL,
    "op11_mean_clusters": mean_clusters.REPORT_SQL,
    "op12_chat_tree": chat_tree.REPORT_SQL,
    "op13_ball_codes": ball_codes.REPORT_SQL,
}

"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grantflow.llm.collocations import ORACLE_SQL as COLLOCATION_SQL
from grantflow.llm.quotations import ORACLE_SQL as QUOTATION_SQL
from grantflow.queries.base import Query, table

# Only where SQL can say it: models, samplers, tokenizers and packers are tested against brute force instead.
ORACLES = {"op6_quotation_links": QUOTATION_SQL, "op11_collocations": COLLOCATION_SQL}


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    from grantflow.llm.quality_rules import quality_rules

    return quality_rules(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    from grantflow.llm.packing import pack

    return pack(table(spark, folder, "documents"))


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    from grantflow.llm.warc import archive_round_trip, page_of

    records = archive_round_trip(spark, table(spark, folder, "pages"))
    return records.select(
        page_of("record_id").alias("page_id"), "uri", "payload_bytes", "payload_digest", "record_type",
        page_of("refers_to_id").alias("refers_to"), "digest_ok", "error",
    ).withColumnRenamed("uri", "url")


def _held_out(parts: int, part: int) -> Column:
    return F.crc32(F.col("id").cast("string")) % parts == part


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    from grantflow.llm.language_id import identify

    return identify(table(spark, folder, "documents"), held_out=_held_out(4, 2)).withColumnRenamed("id", "doc_id")


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    from grantflow.llm.toxicity import score_toxicity

    scored = score_toxicity(
        table(spark, folder, "documents"), table(spark, folder, "labels"), held_out=_held_out(5, 0))
    return scored.withColumnRenamed("id", "doc_id")


def op4_weighted_sampling(spark: SparkSession, folder: str) -> DataFrame:
    from grantflow.llm.weighted_sampling import fingerprints

    return fingerprints(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    from grantflow.llm.jaccard_join import jaccard_classes

    return jaccard_classes(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


def op1_html_blocks(spark: SparkSession, folder: str) -> DataFrame:
    from grantflow.llm.html_blocks import extract

    return extract(table(spark, folder, "pages")).withColumnRenamed("id", "page_id")


def op3_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    from grantflow.llm.sentencepiece_stream import round_trip

    return round_trip(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


def op6_quotation_links(spark: SparkSession, folder: str) -> DataFrame:
    from grantflow.llm.quotations import linked_messages

    return linked_messages(table(spark, folder, "conversations"))


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    from grantflow.llm.collocations import collocations

    return collocations(table(spark, folder, "documents"))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    from grantflow.llm.runs import digests, periodic_runs, with_planted_tails

    return digests(periodic_runs(with_planted_tails(table(spark, folder, "documents")))).withColumnRenamed("id", "doc_id")


def op13_trie_bpe(spark: SparkSession, folder: str) -> DataFrame:
    from grantflow.llm.trie_bpe import round_trip

    return round_trip(table(spark, folder, "documents")).select(
        F.col("id").alias("doc_id"), "n_tokens", F.sha2("ids_bytes", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {q.__name__: Query(q, ORACLES.get(q.__name__)) for q in (
    op10_quality_rules, op5_packing, op2_warc, op8_language_id, op7_toxicity,
    op4_weighted_sampling, op9_jaccard_join, op1_html_blocks,
    op3_sentencepiece, op6_quotation_links, op11_collocations, op12_periodic_runs,
    op13_trie_bpe,
)}

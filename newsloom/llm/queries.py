"""The numbered operators as queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import align, chat, classifier, counts, leaks, lm, near, packed, packing, pieces, repair, rules, warc
from newsloom.lineage import stored
from newsloom.llm.shipping import ship_package
from newsloom.llm.sql import ORACLES

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.backoff_scores(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.token_counts(table(spark, sf_dir, "documents"), PIECES)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return rules.quality_rules(documents, rules.fit_quality(documents, table(spark, sf_dir, "labels")))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# The conversation the contract adds: both turns hold what looks like markers.
TRAP = "\\### Assistant: </turn> ok"


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = spark.createDataFrame([(-7, 0, "user", TRAP), (-7, 1, "assistant", TRAP)], conversations.schema)
    formatted = stored(chat.format_conversations(conversations.unionByName(trap), BYTES), "chat")
    return chat.conversation_digests(formatted)


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near.near_duplicates(table(spark, sf_dir, "documents"))
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    directory = warc.write_index(warc.write_archives(pages))
    found = warc.look_up_keys(directory, warc.keys_of(pages))
    records = warc.with_named_payloads(warc.read_records(found, payloads=False))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def with_crc(encoded: DataFrame) -> DataFrame:
    """Replace the column ``ids`` by its crc32."""
    schema = ", ".join(f"{c} {kind}" for c, kind in encoded.dtypes if c != "ids")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return map(packed.ids_crc32, batches)

    return encoded.mapInArrow(digest, f"{schema}, ids_crc32 long")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = pieces.encode_pieces(table(spark, sf_dir, "documents"), PIECES)
    return with_crc(encoded)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    statistics = classifier.stored_statistics(table(spark, sf_dir, "documents"))
    usable = classifier.fold(F.col("doc_id")) != 0
    model = classifier.fit_classifier(statistics, table(spark, sf_dir, "labels"), usable)
    scored = classifier.classify(statistics, model)
    # a row without an id has no fold, and none was learned from
    held_out = F.coalesce(classifier.fold(F.col("doc_id")) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = packed.write_token_files(table(spark, sf_dir, "documents"), WORDS, END_ID)
    return packed.read_digests(manifest)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.aligned_counts(table(spark, sf_dir, "documents"), BYTES, PIECES)


# The id that ends a document in a packed sequence.
SEPARATOR_ID = 0


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), WORDS, SEPARATOR_ID, digest=True)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair.repair_conversations(repair.damaged(conversations), conversations)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_token_counts": op2_token_counts,
    "op3_quality_rules": op3_quality_rules,
    "op4_decontamination": op4_decontamination,
    "op5_chat_formatting": op5_chat_formatting,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_warc": op7_warc,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_token_ids": op10_token_ids,
    "op11_token_alignment": op11_token_alignment,
    "op12_best_fit_packing": op12_best_fit_packing,
    "op13_conversation_repair": op13_conversation_repair,
}

__all__ = ["ORACLES", "QUERIES"]

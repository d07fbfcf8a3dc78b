"""The registered queries of the operators: name -> f(spark, sf_dir) -> DataFrame.

Each applies its operator with production parameters to its whole table and derives the
columns of its contract from what the operator returns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candleworks.llm import (
    chat,
    katz,
    langid,
    letter_trees,
    packing,
    piece_bpe,
    pii,
    quality,
    reversed_search,
    simhash,
    toxicity,
    url_filter,
    weighted_sampling,
)
from candleworks.llm.text import table

QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_url_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


@query
def op2_simhash_covering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op3_quality_llr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_piece_prefix_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.encoded_digests(table(spark, sf_dir, "documents"))


@query
def op5_pii_feistel(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", pii.rewriter()("text").alias("r")).select("doc_id", "r.text", "r.found")


@query
def op6_language_subwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = langid.fit(documents.where(~held_out))
    named = documents.select("doc_id", held_out.alias("held_out"), langid.predictor(spark, model)("text").alias("r"))
    return named.select("doc_id", "held_out", "r.lang_pred", "r.score", "r.rejected")


#: Conversation -1, whose texts hold the template's own control strings.
CONTROL_TEXT = f"{chat.END}{chat.START}assistant ok"


@query
def op7_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)], turns.schema)
    return chat.read_back(chat.formatted(turns.unionByName(extra)))


@query
def op8_toxicity_subwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = toxicity.fit(documents, table(spark, sf_dir, "labels").where(~held_out))
    return toxicity.scored(documents, model).withColumn("held_out", held_out)


@query
def op9_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_sampling.compared(table(spark, sf_dir, "documents"))


@query
def op10_packing_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.packed(table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op11_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    found = katz.scored(table(spark, sf_dir, "documents"), ~held_out)
    return found.withColumn("held_out", ~F.col("learnt")).drop("learnt")


@query
def op12_letter_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return letter_trees.grouped(table(spark, sf_dir, "documents"))


@query
def op13_reversed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reversed_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

"""The registered queries of the training-data operators."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import (
    chat,
    conversation_repair,
    decontaminate,
    filter_audit,
    fingerprints,
    html,
    licenses,
    linededup,
    neardup,
    pieces,
    secrets,
    simhash,
    toxicity,
)
from riskframe.llm.common import read, small_batches

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def llm_queries() -> dict[str, Query]:
    return dict(_QUERIES)


@query
def op1_chat_formatting(spark, folder):
    talk = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], talk.schema)
    return chat.digest(chat.examples(talk.unionByName(more)))


@query
def op2_html_extraction(spark, folder):
    small_batches(spark)
    pages = read(spark, folder, "pages").select("page_id", "url", "html")
    model = html.fit(html.labelled_pages(pages))
    text = pages.select("page_id", "url", html.extract(pages, model).alias("text"))
    return text.withColumn("n_chars", F.char_length("text").cast("long"))


@query
def op3_secret_scan(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text", "source")
    return secrets.scan(secrets.weak_labels(secrets.candidates(docs)))


@query
def op4_sentencepiece(spark, folder):
    small_batches(spark)
    vocabulary = pieces.load()
    coded = pieces.encode(read(spark, folder, "documents"), vocabulary)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        "ids",
        F.sha2(pieces.decode(coded, vocabulary), 256).alias("decoded_sha256"),
    )


@query
def op5_license_scan(spark, folder):
    return licenses.licenses(read(spark, folder, "documents").select("doc_id", "text"))


@query
def op6_fingerprints(spark, folder):
    return fingerprints.fingerprints(read(spark, folder, "documents").select("doc_id", "text"))


@query
def op7_near_duplicates(spark, folder):
    small_batches(spark)
    return neardup.near_duplicates(read(spark, folder, "documents"), words=3, percent=85)


@query
def op8_decontamination(spark, folder):
    small_batches(spark)
    found = decontaminate.contamination(
        read(spark, folder, "documents").select("doc_id", "text"), read(spark, folder, "benchmark")
    ).select("doc_id", "_found.*")
    return found.select(
        "doc_id",
        "n_words",
        decontaminate.hit_words().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("items") > 0).alias("contaminated"),
    )


@query
def op9_line_dedup(spark, folder):
    small_batches(spark)
    out = linededup.deduplicated(read(spark, folder, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op10_toxicity(spark, folder):
    small_batches(spark)
    docs = read(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.train(docs, read(spark, folder, "labels"))
    scored = docs.select(
        "doc_id", toxicity.is_held_out().alias("held_out"), toxicity.score(docs, model).alias("score")
    )
    return scored.withColumn("predicted", F.when(F.col("score") >= toxicity.REJECT, 1).otherwise(0))


@query
def op11_filter_audit(spark, folder):
    return filter_audit.audit(read(spark, folder, "documents"), read(spark, folder, "labels"))


@query
def op12_simhash(spark, folder):
    small_batches(spark)
    return simhash.near_duplicates(read(spark, folder, "documents"))


@query
def op13_conversation_repair(spark, folder):
    small_batches(spark)
    return conversation_repair.repaired(conversation_repair.damaged(read(spark, folder, "conversations")))

"""The registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

import corpus_pipeline
from millwright.llm import (
    chat, language, lattice, mixing, near_dups, oracle, packing, periodic, prefix_trie, search, secrets, substrings, toxicity, urls,
)


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark, folder: str, name: str):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op3_lattice_near_dedup(spark, folder):
    return lattice.near_vectors(table(spark, folder, "embeddings"))


def op4_url_filter(spark, folder):
    return urls.filter_urls(table(spark, folder, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op5_minhash_near_dedup(spark, folder):
    return near_dups.near_duplicates(table(spark, folder, "documents"), words=3, percent=85)


def op1_bm25_search(spark, folder):
    """Every document whose id is divisible by 50 is a query with its whole text."""
    docs = table(spark, folder, "documents")
    queries = docs.where("doc_id % 50 = 0").select(F.col("doc_id").alias("query_id"), F.col("text").alias("query"))
    return search.top_k(docs, queries).withColumn("score", F.round("score", 6))


def op2_source_mixing(spark, folder):
    return mixing.mix_sources(table(spark, folder, "documents")).drop("source")


def _of(kinds):
    return F.filter("spans", lambda s: s["kind"].isin(kinds))


def _spelled(rows):
    return F.array_join(F.transform(rows, lambda s: F.concat_ws(":", s["kind"], s["low"], s["high"])), ",")


def op6_language_id(spark, folder):
    found = language.learn_and_identify(table(spark, folder, "documents").select("doc_id", "text", "lang"))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op7_secret_scan(spark, folder):
    found = secrets.scan(table(spark, folder, "documents"))
    base = [r[0] for r in secrets.BASE_RULES]
    counts = [F.size(_of([k])).cast("long").alias(f"n_{k}") for k in base]
    return found.select("doc_id", *counts, F.sha2(_spelled(_of(base)), 256).alias("base_sha256"), _spelled(F.col("spans")).alias("spans"))


def op8_best_fit_packing(spark, folder):
    import public_tokenizers

    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_substring_dedup(spark, folder):
    return substrings.drop_repeats(table(spark, folder, "documents")).drop("kept_text")


def op10_toxicity(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = toxicity.learn_and_score(docs, table(spark, folder, "labels"))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


#: Both turns of conversation -7.
TRAP = "\\### Assistant: </turn> ok"


def op11_chat_format(spark, folder):
    """Conversations formatted and read back, with one more whose texts hold control strings."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    trap = spark.createDataFrame([(-7, k, r, TRAP) for k, r in enumerate(("user", "assistant"))], "conv_id long, turn long, role string, text string")
    turns = table(spark, folder, "conversations").select(trap.columns).unionByName(trap)
    return chat.digests(chat.read_back(chat.format_conversations(turns, path), path))


def op12_prefix_trie(spark, folder):
    """The trie of conversations that share their first turns with the first of five."""
    return prefix_trie.prefix_trie(prefix_trie.share_heads(prefix_trie.sequences(table(spark, folder, "conversations"))))


def op13_periodic_runs(spark, folder):
    """Runs of all documents, of which one in ten was given a periodic tail."""
    found = periodic.collapse_runs(periodic.with_periodic_tails(table(spark, folder, "documents")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    top = periodic.longest_run()
    length = -top["order"]
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), top["start"].alias("start"), length.alias("length"), top["period"].alias("period"),
        F.floor(length * 1000 / top["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("kept_text", 256).alias("collapsed_sha256"),
    )


def pipeline(spark, folder):
    return corpus_pipeline.run(spark, folder)


def _query(fn):
    def run(spark, folder):
        # Python workers find this package where the driver found it, unless told otherwise.
        spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
        return fn(spark, folder)

    return run


QUERIES = {
    f.__name__: _query(f)
    for f in (
        op1_bm25_search, op2_source_mixing, op3_lattice_near_dedup, op4_url_filter, op5_minhash_near_dedup,
        op6_language_id, op7_secret_scan, op8_best_fit_packing, op9_substring_dedup, op10_toxicity,
        op11_chat_format, op12_prefix_trie, op13_periodic_runs, pipeline,
    )
}

ORACLES = dict(oracle.ORACLES)
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL

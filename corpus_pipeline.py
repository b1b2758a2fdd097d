"""A training corpus from ``documents`` in five stages, each one operator of ``millwright.llm``.

Every stage takes (spark, docs, sf_dir), works on all that the one before kept, and is
written as Parquet before the next reads it. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.llm import language, mixing, near_dups, packing, secrets
from millwright.session import materialise

#: A text whose most frequent language has a smaller share of its letters is rejected.
LEAST_SHARE = 0.5
#: The columns that stages read; all others pass through them under other names.
READ = ["doc_id", "text", "lang", "source", "n_chars"]


def shielded(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with extra columns renamed, so that no operator's column takes their place, and the way back."""
    names = {c: c if c in READ else f"_extra{i}" for i, c in enumerate(docs.columns)}
    hidden = docs.select([F.col(f"`{c}`").alias(n) for c, n in names.items()])
    return hidden, lambda df: df.select([F.col(n).alias(c) for c, n in names.items()])


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter, or without a language of half their letters, go; ``lang`` becomes the language found.

    Null and empty texts have no letter. Repeated rows and null ids are judged like any
    other; texts of any length are read whole. An empty table stays empty.
    """
    hidden, back = shielded(docs)
    found = language.learn_and_identify(hidden)
    kept = found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SHARE))
    return back(kept.withColumn("lang", F.col("lang_pred")))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each group of near duplicates stays; rows without an id and texts without words stay.

    Rows are numbered and stored with their numbers, so unlike texts under one id are judged
    each for itself. Of rows of a group that share the smallest id one stays, told by a hash
    of its columns, and equal rows without words stay once. An empty table stays empty.
    """
    hidden, back = shielded(docs)
    named = hidden.where("doc_id IS NOT NULL").withColumn("_row", F.monotonically_increasing_id())
    named = materialise(named.withColumn("_hash", F.xxhash64(*hidden.columns)), "numbered")
    found = near_dups.near_duplicates(named, "_row").select(F.col("doc_id").alias("_row"), "component_id", "n_shingles")
    order = named.select("doc_id", "_row", "_hash").join(found, "_row")
    first = order.groupBy("component_id").agg(F.min(F.struct("doc_id", "_hash", "_row")).alias("first"), F.max("n_shingles").alias("n_shingles"))
    first = first.select("first._row", (F.col("n_shingles") > 0).alias("_worded"))
    kept = named.join(first, "_row").drop("_row", "_hash")
    worded, blank = kept.where("_worded").drop("_worded"), kept.where("NOT _worded").drop("_worded").dropDuplicates()
    return back(worded.unionByName(blank).unionByName(hidden.where("doc_id IS NULL")))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; the spans found are masked and ``n_chars`` is the new length.

    Null and empty texts hold no span and stay as they are, as do rows without a finding;
    repeated rows are masked alike. An empty table stays empty.
    """
    hidden, back = shielded(docs)
    found = secrets.redact(secrets.scan(hidden))
    changed = F.when(F.size("spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return back(found.withColumn("n_chars", changed))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row is repeated as often as the mixture takes it, rounded; rows it does not take go.

    Texts without words are not taken. A null source is one source, the last. Rows that agree
    in id, source and text share what is taken of them equally. Halves are rounded up. An
    empty table stays empty.
    """
    hidden, back = shielded(docs)
    mixed = mixing.mix_sources(hidden, keep=True)
    times = F.round(F.col("taken") / F.col("size")).cast("int")
    return back(mixed.where("size > 0").withColumn("_copy", F.explode(F.array_repeat(F.lit(1), times))))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every row and their places in sequences of at most 4096 tokens.

    A null or empty text is a piece of its end id alone. Repeated rows and null ids are packed
    as rows of their own; which of equal pieces lies where is left open. Only texts longer
    than a sequence are cut. An empty table gives no pieces.
    """
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_stage),
    ("minhash_near_dedup", near_dedup_stage),
    ("secret_scan", secrets_stage),
    ("source_mixing", mixing_stage),
    ("best_fit_packing", packing_stage),
]

#: Near duplicates, languages and packing cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``, each but the last stored before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

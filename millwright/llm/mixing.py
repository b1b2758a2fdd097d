"""Mixing sources to target weights by a low-discrepancy schedule.

Slot n of the mixture has the van der Corput point of n (its bits reversed behind the
binary point). Points are mapped through the cumulative target weights to a source, the
slots of a source are ranked, and slot rank r takes block r of the source's shuffled stream
of equal-token blocks, starting over when the stream ends.

Everything is DataFrame functions. Ranks and running sums are taken in two steps (inside
hash buckets, and across the sums of the buckets), so no source is gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwright.session import materialise

BLOCK = 64
PASSES = 3
#: Resolution of the points and of the cumulative weights.
UNIT_BITS = 48
CELL_BITS = 10
BUCKET_DIGITS = 3


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, passes: int = PASSES, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size).

    Sources in code point order, null last, get the weights in turn and share the total; a
    target stops at ``passes`` times its source's size and the excess is shared again by
    weight among the others. The common level per weight is the largest of (total - limits) /
    (weights left) over the prefixes of the sources ordered by limit per weight. One row per
    source is ordered here.
    """
    at = Window.orderBy(F.asc_nulls_last("source"))
    turn = F.pmod(F.row_number().over(at) - 1, F.lit(len(weights))) + 1
    rows = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), turn).cast("long"))
    rows = rows.withColumn("cap", F.col("source_size") * passes)
    below = Window.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source"))
    every = Window.partitionBy(F.lit(0)).orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = below.rowsBetween(Window.unboundedPreceding, -1)
    rest = F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(earlier), F.lit(0))
    open_weight = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(earlier), F.lit(0))
    rows = rows.withColumn("level", rest / open_weight)
    rows = rows.withColumn("level", F.max("level").over(every) * F.col("weight"))
    return rows.withColumn("target", F.least(F.col("cap").cast("double"), F.col("level"))).select("source", "source_size", "weight", "target")


def _same(a: str, b: str = "source") -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _stream(sized: DataFrame) -> DataFrame:
    """``sized`` with ``begin``: the words of the source before the document in its shuffled order.

    The order is that of the MD5 of the id, or of the text's MD5 where there is no id, so that
    rows without ids do not meet in one window; where rows agree in it, that of the text hash.
    """
    order = sized.withColumn("mark", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.col("digest"))))
    order = order.withColumn("bucket", F.substring("mark", 1, BUCKET_DIGITS))
    sums = order.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("skip"))
    inside = Window.partitionBy("source", "bucket").orderBy("mark", "doc_id", "size", "row").rowsBetween(Window.unboundedPreceding, -1)
    order = order.withColumn("begin", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    order = order.join(sums, _same("s") & (F.col("b") == F.col("bucket")))
    return order.withColumn("begin", F.col("begin") + F.col("skip")).drop("mark", "digest", "bucket", "s", "b", "skip")


def schedule(goals: DataFrame, block: int = BLOCK) -> DataFrame:
    """(slot, source, rank): the mixture's slots and the rank of each among its source's.

    ``goals`` has source, source_size and target; targets of 0 get no slot. The number of
    slots is the sum of all sizes, which the targets share, over ``block``.
    """
    spark = goals.sparkSession
    unit = 1 << UNIT_BITS
    words = goals.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    slots = -(-words // block)
    share = F.round(F.col("target") / F.lit(float(max(words, 1))) * F.lit(float(unit))).cast("long")
    bounds = goals.where("target > 0").withColumn("share", share)
    upto = Window.orderBy(F.asc_nulls_last("source")).rowsBetween(Window.unboundedPreceding, 0)
    last = F.col("source").eqNullSafe(F.last("source").over(Window.partitionBy(F.lit(0)).orderBy(F.asc_nulls_last("source")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    bounds = bounds.withColumn("high", F.sum("share").over(upto)).withColumn("low", F.col("high") - F.col("share"))
    bounds = bounds.withColumn("high", F.when(last, F.lit(unit)).otherwise(F.col("high")))
    shift = UNIT_BITS - CELL_BITS
    cells = F.sequence(F.shiftright("low", shift), F.shiftright(F.col("high") - 1, shift))
    bounds = bounds.where("low < high").select("source", "low", "high", F.explode(cells).alias("cell"))

    points = spark.range(slots).select(
        F.col("id").alias("slot"), F.conv(F.rpad(F.reverse(F.bin("id")), UNIT_BITS, "0"), 2, 10).cast("long").alias("point")
    )
    points = points.withColumn("cell", F.shiftright("point", shift))
    drawn = points.join(bounds, (points["cell"] == bounds["cell"]) & F.expr("low <= point AND point < high"))
    chunk = F.floor(F.col("slot") / F.lit(max(1, slots >> CELL_BITS)))
    drawn = drawn.select("slot", "source", chunk.alias("chunk"))
    counts = drawn.groupBy("source", "chunk").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col("source").alias("s"), F.col("chunk").alias("c"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("skip"))
    inside = F.row_number().over(Window.partitionBy("source", "chunk").orderBy("slot"))
    drawn = drawn.withColumn("rank", inside).join(counts, _same("s") & (F.col("c") == F.col("chunk")))
    return drawn.select("slot", "source", (F.col("rank") - 1 + F.col("skip")).alias("rank"))


def mix_sources(
    docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", block: int = BLOCK, passes: int = PASSES,
    keep: bool = False,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken.

    ``taken`` counts the words that the scheduled blocks take of the document, repeats
    counted. A slot past the last pass of its source takes nothing. Null, empty and blank
    texts have size 0 and give nothing; a null source is one source, the last. Repeated rows
    and null ids are documents of their own. Other columns are not read. Rows that agree in
    id, source and text hash may swap their ``taken``; nothing else depends on the run.

    With ``keep`` the result is ``docs`` with size and taken instead (columns of these names
    are replaced); rows are matched by id, source and text hash, and rows that agree in all
    three take equal shares.
    """
    sized = docs.select(
        F.col(id).cast("long").alias("doc_id"), F.col(source).alias("source"), words_in(F.col(text)).alias("size"),
        F.xxhash64(F.col(text)).alias("row"),
        F.when(F.col(id).isNull(), F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")))).alias("digest"),
    )
    sized = materialise(sized, "sizes")
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = materialise(targets(sums, passes), "targets")
    stream = materialise(_stream(sized), "stream")

    blocks = goals.select(F.col("source").alias("of"), F.ceil(F.col("source_size") / block).alias("blocks"))
    drawn = schedule(goals, block).join(blocks, _same("of")).where(F.col("rank") < passes * F.col("blocks"))
    drawn = drawn.withColumn("block", F.pmod("rank", "blocks"))
    times = drawn.groupBy("source", "block").agg(F.count(F.lit(1)).alias("times"))
    times = times.withColumnsRenamed({"source": "s", "block": "b"})

    first, last = F.floor(F.col("begin") / block), F.floor((F.col("begin") + F.col("size") - 1) / block)
    stream = stream.withColumn("key", F.monotonically_increasing_id())
    parts = stream.where("size > 0").select("key", "source", "begin", "size", F.explode(F.sequence(first, last)).alias("block"))
    parts = parts.join(times, _same("s") & (F.col("b") == F.col("block")))
    inside = F.least(F.col("begin") + F.col("size"), (F.col("block") + 1) * block) - F.greatest(F.col("begin"), F.col("block") * block)
    taken = parts.groupBy("key").agg(F.sum(inside * F.col("times")).alias("taken"))
    out = stream.join(taken, "key", "left").join(goals.withColumnRenamed("source", "of").drop("weight"), _same("of"))
    out = out.withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))
    if not keep:
        return out.select("doc_id", "source", "size", "source_size", "target", "taken")
    shares = out.groupBy("doc_id", "source", "row").agg(F.first("size").alias("size"), F.avg("taken").alias("taken"))
    shares = shares.withColumnsRenamed({"doc_id": "_id", "source": "_source", "row": "_row"})
    rows = docs.drop("size", "taken").withColumn("_text_hash", F.xxhash64(F.col(text)))
    on = F.col(id).cast("long").eqNullSafe(F.col("_id")) & F.col(source).eqNullSafe(F.col("_source")) & (F.col("_text_hash") == F.col("_row"))
    return rows.join(shares, on).drop("_id", "_source", "_row", "_text_hash")

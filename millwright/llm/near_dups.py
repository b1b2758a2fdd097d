"""MinHash near-duplicates with tensored banding.

Two small collections of keys are computed per document, each key from two minima; a table
key pairs one key of each. ``KEYS`` x ``KEYS`` tables thus need only 4 x ``KEYS`` minima. A
pair of documents of similarity s shares a table with probability (1 - (1 - s^2)^KEYS)^2:
0.99993 at 0.85, 0.999999 above 0.93. Documents that share a table are confirmed on their
full shingle sets.

Sets are compared through 64-bit shingle hashes, classes of equal sets through 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.graph import components
from millwright.llm.text import mix, sliced, words_of
from millwright.session import materialise

KEYS = 8
MINIMA = 2
_RANDOM = np.random.default_rng(85)
SEEDS = _RANDOM.integers(1, 2**63, (2, KEYS, MINIMA), dtype=np.uint64)
ODD = _RANDOM.integers(1, 2**63, (2, KEYS, MINIMA), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Bits of the sketch that spares most unlike pairs a comparison of their sets.
BITS = 2048
BIT_SEEDS = _RANDOM.integers(0, 2**32, (BITS, 3), dtype=np.uint32) | np.array([0, 1, 1], dtype=np.uint32)
KEY_NAMES = [f"{side}{k}" for side in "ab" for k in range(KEYS)]
SKETCH_NAMES = [f"s{k}" for k in range(BITS // 64)]
SIGNATURE = "doc_id long, n_shingles long, f1 long, f2 long, a array<long>, b array<long>"


def shingles(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of every row, sorted by both."""
    w = words_of(column, fold=True)
    total = len(w.hash)
    at = np.arange(total)
    left = w.first[w.row + 1] - at
    inner = left >= words
    whole = (left == w.first[w.row + 1] - w.first[w.row]) & (left < words)
    out = np.zeros(total, dtype=np.uint64)
    for step in range(words):
        here = np.flatnonzero(inner | (whole & (left > step)))
        out[here] = mix(out[here] * np.uint64(0xD6E8FEB86659FD93) + w.hash[here + step])
    keep = inner | whole
    row, value = w.row[keep], out[keep]
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    if len(row):
        fresh = np.ones(len(row), dtype=bool)
        fresh[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
        row, value = row[fresh], value[fresh]
    return row, value


def table_keys(row: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """[side, key, row]: the keys of both collections; 0 for rows without shingles."""
    keys = np.zeros((2, KEYS, n), dtype=np.uint64)
    full = np.unique(row)
    if not len(full):
        return keys
    cuts = np.searchsorted(row, full)
    for side in range(2):
        for k in range(KEYS):
            for j in range(MINIMA):
                low = (value ^ SEEDS[side, k, j]) * ODD[side, k, j]
                low ^= low >> np.uint64(32)
                low = np.minimum.reduceat(low * ODD[side, k, j], cuts)
                keys[side, k, full] = mix(keys[side, k, full] * np.uint64(31) + low)
    return keys


def _signatures(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64())]
        + [(c, pa.list_(pa.int64())) for c in "ab"]
    )
    for batch in sliced(batches, "text"):
        row, value = shingles(batch["text"], words)
        n = batch.num_rows
        size = np.bincount(row, minlength=n).astype(np.int64)
        full = np.flatnonzero(size)
        prints = np.zeros((2, n), dtype=np.uint64)
        if len(full):
            cuts = np.searchsorted(row, full)
            for k in range(2):
                prints[k, full] = np.add.reduceat(mix(value ^ SEEDS[k, 0, 0]), cuts)
        keys = table_keys(row, value, n)
        offsets = pa.array(np.arange(n + 1, dtype=np.int32) * KEYS)
        lists = [pa.ListArray.from_arrays(offsets, pa.array(keys[s].T.ravel().view(np.int64))) for s in range(2)]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"].cast(pa.int64()), pa.array(size), *(pa.array(p.view(np.int64)) for p in prints), *lists], schema=schema
        )


def _confirm(batches: Iterator[pa.RecordBatch], words: int, percent: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in sliced(iter([whole]), "text_b"):
            n = batch.num_rows
            sets = []
            for side in "ab":
                row, value = shingles(batch[f"text_{side}"], words)
                cuts = np.searchsorted(row, np.arange(n + 1))
                sets.append([value[cuts[i] : cuts[i + 1]] for i in range(n)])
            common = np.array([len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(*sets)])
            union = np.array([len(x) + len(y) for x, y in zip(*sets)]) - common
            good = pa.array((100 * common >= percent * union) & (common > 0))
            yield pa.RecordBatch.from_arrays([batch["a"].filter(good), batch["b"].filter(good)], names=["a", "b"])


def _sketches(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """The table keys of each row and one bit of each of ``BITS`` further minima."""
    names = ["doc_id", "part", "n", *KEY_NAMES, *SKETCH_NAMES]
    for batch in sliced(batches, "text"):
        row, value = shingles(batch["text"], words)
        n = batch.num_rows
        size = np.bincount(row, minlength=n).astype(np.int64)
        bits = np.zeros((BITS // 64, n), dtype=np.uint64)
        cuts = np.searchsorted(row, np.arange(n))
        short = (value >> np.uint64(20)).astype(np.uint32)
        for k in range(BITS):
            low = (short ^ BIT_SEEDS[k, 0]) * BIT_SEEDS[k, 1]
            low ^= low >> np.uint32(15)
            low = np.minimum.reduceat(low * BIT_SEEDS[k, 2], cuts)
            bits[k // 64] |= (mix(low.astype(np.uint64)) & np.uint64(1)) << np.uint64(k % 64)
        keys = table_keys(row, value, n).reshape(2 * KEYS, n)
        columns = [pa.array(size), *(pa.array(x.view(np.int64)) for x in (*keys, *bits))]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["part"], *columns], names=names)


def _links(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough, stored."""
    sides = pairs
    for s in "ab":
        sides = sides.join(texts.select(F.col("doc_id").alias(s), F.col("text").alias(f"text_{s}")), s)
    check = partial(_confirm, words=words, percent=percent)
    return materialise(sides.select("a", "b", "text_a", "text_b").mapInArrow(check, "a long, b long"), "links")


def _across(tables: DataFrame, parts: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs (a, b) that share a table, lie in different parts and may be similar enough.

    Of the documents of a table, those of its largest part are met only by the others. A pair
    shares a table when it shares a key of either collection, so the smaller collection of
    keys is joined on and the other is compared. Sets whose sizes are too different, and
    pairs whose sketches differ in more bits than a similar pair ever shows (4.75 standard
    deviations, one such pair in a million), are not paired.
    """
    apart = tables.join(parts, "doc_id", "left").withColumn("part", F.coalesce("component", "doc_id"))
    mixed = apart.groupBy("key").agg(F.min("part").alias("p"), F.max("part").alias("q")).where("p != q")
    wanted = apart.join(mixed, "key", "left_semi").select("doc_id", "part").distinct()
    longs = ", ".join(f"{c} long" for c in ("doc_id", "part", "n", *KEY_NAMES, *SKETCH_NAMES))
    sketched = materialise(texts.join(wanted, "doc_id").mapInArrow(partial(_sketches, words=words), longs), "sketches")

    first = F.posexplode(F.array(*KEY_NAMES[:KEYS])).alias("i", "key")
    entries = sketched.select("*", first)
    main = (
        entries.groupBy("i", "key", "part").agg(F.count(F.lit(1)).alias("size"))
        .groupBy("i", "key").agg(F.max_by("part", F.struct("size", "part")).alias("main"), F.count(F.lit(1)).alias("parts"))
        .where("parts > 1").drop("parts")
    )
    x, y = entries.join(main, ["i", "key"]).where("part != main").alias("x"), entries.alias("y")
    once = " ".join(f"WHEN x.{c} = y.{c} THEN {i}" for i, c in enumerate(KEY_NAMES[:KEYS]))
    both = " OR ".join(f"x.{c} = y.{c}" for c in KEY_NAMES[KEYS:])
    apart_bits = " + ".join(f"bit_count(x.{c} ^ y.{c})" for c in SKETCH_NAMES)
    p = (1 - percent / 100) / 2
    most = int(BITS * p + 4.75 * (BITS * p * (1 - p)) ** 0.5)
    rest = x.join(y, F.expr(
        f"x.i = y.i AND x.key = y.key AND x.part != y.part AND 100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n) "
        f"AND x.i = CASE {once} END AND ({both}) AND {apart_bits} <= {most}"
    ))
    rest = rest.select(F.expr("least(x.doc_id, y.doc_id)").alias("a"), F.expr("greatest(x.doc_id, y.doc_id)").alias("b"))
    return rest.distinct()


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * |intersection| >= percent * |union| of their sets of
    ``words``-word shingles; component_id is the smallest id that links reach and ``kept``
    marks its document. A text of fewer words is one shingle. Null, empty and blank texts
    have no shingle and link with nothing. A row whose id is null has a null component and
    is kept. Repeated rows each get a row. Other columns are not read.

    Documents with equal sets are one class first, so a large group of copies is one entry of
    the tables. In a table, every member is confirmed against the smallest one; members that
    are then still in different parts are compared with each other where their sketches allow.
    """
    table = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    marks = materialise(table.mapInArrow(partial(_signatures, words=words), SIGNATURE), "signatures")
    some = marks.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = some.groupBy("f1", "f2", "n_shingles").agg(F.min("doc_id").alias("head"))
    heads = some.join(classes.select(F.col("head").alias("doc_id")), "doc_id", "left_semi")
    pairs_of_keys = f"flatten(transform(a, (x, i) -> transform(b, (y, j) -> xxhash64(x, y, i * {KEYS} + j))))"
    entries = heads.select("doc_id", F.explode(F.expr(pairs_of_keys)).alias("key"))
    shared = entries.groupBy("key").agg(F.min("doc_id").alias("pivot"), F.max("doc_id").alias("last"))
    tables = materialise(entries.join(shared.where("pivot != last").drop("last"), "key"), "tables")

    texts = table.where("doc_id IS NOT NULL").join(tables.select("doc_id").distinct(), "doc_id", "left_semi")
    texts = materialise(texts, "texts")
    star = tables.where("doc_id != pivot").select(F.col("pivot").alias("a"), F.col("doc_id").alias("b")).distinct()
    links = _links(star, texts, words, percent)
    parts = components(links, "a", "b").withColumnRenamed("node", "doc_id")
    links = links.unionByName(_links(_across(tables, parts, texts, words, percent), texts, words, percent))
    same = components(links, "a", "b").withColumnRenamed("node", "head")

    named = classes.join(same, "head", "left").select(
        "f1", "f2", "n_shingles", F.coalesce("component", "head").alias("of_class")
    )
    out = marks.select("doc_id", "n_shingles", "f1", "f2").join(named, ["f1", "f2", "n_shingles"], "left")
    group = F.when(F.col("n_shingles") > 0, F.col("of_class")).otherwise(F.col("doc_id"))
    group = F.when(F.col("doc_id").isNotNull(), group)
    return out.select(
        "doc_id", "n_shingles", group.alias("component_id"), F.coalesce(F.col("doc_id") == group, F.lit(True)).alias("kept")
    )

"""Removal of repeated word windows, counted by super-k-mers.

A window is ``window`` consecutive words. Its minimiser is the word gram with the smallest
hash among those it holds, the leftmost at a tie. Consecutive windows with the same
minimiser form a super-k-mer: one string of words that stands for all of them. Equal windows
have equal minimisers, so

1. every super-k-mer is listed as (minimiser, document, place) without its words;
2. a minimiser seen once cannot hold a repeated window, so only super-k-mers whose
   minimiser is repeated are cut from the texts;
3. these travel as packed strings to the bucket of their minimiser, where sorting the
   windows counts them exactly;
4. minimisers with more than ``HOT`` super-k-mers send the 128-bit hashes of their windows
   instead, which are counted with map-side combine, so that no bucket is unbounded.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import partial
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.text import Prefix, mix, sliced, words_of
from millwright.session import materialise

GRAM = 8
#: Super-k-mers that one bucket sorts at most, about 150 MB of windows.
HOT = 20_000
SECOND = np.uint64(0xA0761D6478BD642F)
#: A document's key: its id (the text hash where it has none) and its text hash.
KEY = ["doc_id", "h"]


def _minimisers(w, window: int, gram: int):
    """(first window of each super-k-mer, its length in windows, its minimiser's hash)."""
    total = len(w.hash)
    if total < window:
        return (np.zeros(0, dtype=np.int64),) * 2 + (np.zeros(0, dtype=np.uint64),)
    at = np.arange(total - gram + 1)
    value = Prefix(w.hash).hash(at, at + gram)
    spot = at
    width, have = window - gram + 1, 1
    while have < width:
        step = min(have, width - have)
        left, right = value[:-step], value[step:]
        first = left <= right
        value, spot = np.where(first, left, right), np.where(first, spot[:-step], spot[step:])
        have += step
    starts = np.flatnonzero(w.row[: total - window + 1] == w.row[window - 1 :])
    if not len(starts):
        return (np.zeros(0, dtype=np.int64),) * 2 + (np.zeros(0, dtype=np.uint64),)
    fresh = np.ones(len(starts), dtype=bool)
    fresh[1:] = (spot[starts[1:]] != spot[starts[:-1]]) | (w.row[starts[1:]] != w.row[starts[:-1]])
    opens = np.flatnonzero(fresh)
    return starts[opens], np.diff(np.append(opens, len(starts))), value[starts[opens]]


def _list_places(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[pa.RecordBatch]:
    names = ["mini", "doc_id", "h", "start", "windows"]
    for batch in sliced(batches, "text"):
        w = words_of(batch["text"])
        first, windows, mini = _minimisers(w, window, gram)
        row = w.row[first] if len(first) else first
        ids = [batch[c].to_numpy(zero_copy_only=False)[row].astype(np.int64) for c in ("doc_id", "h")]
        columns = [mini.view(np.int64), *ids, (first - w.first[row]).astype(np.int32), windows.astype(np.int32)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


PACKED = "mini long, hot boolean, doc_id long, h long, start int, packed string, h1 long, h2 long"


def _cut(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Packed strings of cold super-k-mers; one row of hashes for each window of hot ones."""
    schema = pa.schema([
        ("mini", pa.int64()), ("hot", pa.bool_()), ("doc_id", pa.int64()), ("h", pa.int64()), ("start", pa.int32()),
        ("packed", pa.string()), ("h1", pa.int64()), ("h2", pa.int64()),
    ])
    for batch in sliced(batches, "text"):
        w = words_of(batch["text"])
        raw = w.data.tobytes()
        one, two = Prefix(w.hash), Prefix(mix(w.hash ^ SECOND))
        rows = []
        for i, (doc, h, places) in enumerate(zip(*(batch[c].to_pylist() for c in ("doc_id", "h", "places")))):
            for p in places:
                low = w.first[i] + p["start"]
                if p["hot"]:
                    at = np.arange(low, low + p["windows"])
                    h1, h2 = one.hash(at, at + window).view(np.int64), two.hash(at, at + window).view(np.int64)
                    rows += [(p["mini"], True, doc, h, p["start"] + k, None, int(x), int(y)) for k, (x, y) in enumerate(zip(h1, h2))]
                else:
                    cut = raw[w.start[low] : w.end[low + p["windows"] + window - 2]]
                    rows.append((p["mini"], False, doc, h, p["start"], b" ".join(cut.split()).decode(), None, None))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def _repeated(group: list[tuple[tuple, int, str]], window: int) -> Iterator[tuple[tuple, int, int]]:
    """(document key, first word, last word + 1) of the repeated windows among the super-k-mers of a minimiser."""
    strings = Counter(packed for _, _, packed in group)
    cuts = {}
    every = []
    for packed, times in strings.items():
        words = packed.split(" ")
        cuts[packed] = [" ".join(words[k : k + window]) for k in range(len(words) - window + 1)]
        every += [(x, times) for x in cuts[packed]]
    every.sort()
    twice = {x for x, same in groupby(every, key=lambda e: e[0]) if sum(t for _, t in same) > 1}
    for doc, start, packed in group:
        for k, x in enumerate(cuts[packed]):
            if x in twice:
                yield doc, start + k, start + k + window


def _count(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by minimiser; a minimiser's rows may lie in several batches."""
    mini, group = None, []

    def out(found):
        spans = []
        for doc, low, high in sorted(found):
            if spans and spans[-1][0] == doc and low <= spans[-1][2]:
                spans[-1][2] = max(high, spans[-1][2])
            else:
                spans.append([doc, low, high])
        columns = list(zip(*((*doc, low, high) for doc, low, high in spans))) or [()] * 4
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["doc_id", "h", "low", "high"])

    for batch in batches:
        found = []
        for m, doc, h, start, packed in zip(*(batch[c].to_pylist() for c in ("mini", "doc_id", "h", "start", "packed"))):
            if m != mini:
                if len(group) > 1:
                    found += _repeated(group, window)
                mini, group = m, []
            group.append(((doc, h), start, packed))
        if found:
            yield out(found)
    if len(group) > 1:
        yield out(_repeated(group, window))


def _strip(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, spans, copied in zip(*(batch[c].to_pylist() for c in ("text", "spans", "copied"))):
            words = (text or "").encode().split()
            # A copy of the row holds every window of it again.
            keep = np.full(len(words), not (copied and len(words) >= window))
            for s in spans or ():
                keep[s["low"] : s["high"]] = False
            kept = b" ".join(x for x, k in zip(words, keep) if k) if spans or copied else b" ".join(words)
            out.append((len(words), int(len(words) - keep.sum()), kept.decode(), hashlib.sha256(kept).hexdigest()))
        columns = list(zip(*out)) or [()] * 4
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
        names = ["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256"]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(c, t) for c, t in zip(columns, kinds))], names=names)


def repeated_spans(docs: DataFrame, window: int = 35, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """(doc_id, h, low, high): word ranges covered by repeated windows; ranges may overlap.

    ``docs`` has text and its key (doc_id, h).
    """
    places = docs.mapInArrow(
        partial(_list_places, window=window, gram=gram), "mini long, doc_id long, h long, start int, windows int"
    )
    places = materialise(places, "places")
    often = places.groupBy("mini").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # Stored, so that both sides of the join are plain shuffles and a hot minimiser's can be cut.
    often = materialise(often, "often")
    hits = places.join(often, "mini").select(*KEY, F.struct("mini", "start", "windows", (F.col("n") > hot).alias("hot")).alias("place"))
    hits = hits.groupBy(*KEY).agg(F.collect_list("place").alias("places"))
    cut = docs.join(hits, KEY).select(*KEY, "text", "places").mapInArrow(partial(_cut, window=window), PACKED)
    cut = materialise(cut, "superkmers")

    cold = cut.where("NOT hot").select("mini", *KEY, "start", "packed")
    cold = cold.repartition("mini").sortWithinPartitions("mini")
    cold = cold.mapInArrow(partial(_count, window=window), "doc_id long, h long, low int, high int")
    windows = cut.where("hot").select("h1", "h2", *KEY, "start")
    twice = windows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    twice = materialise(twice, "twice")
    warm = windows.join(twice, ["h1", "h2"]).select(*KEY, F.col("start").alias("low"), (F.col("start") + window).alias("high"))
    return cold.unionByName(warm)


def drop_repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = 35, gram: int = GRAM, hot: int = HOT
) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_text, kept_sha256.

    A word is removed when a window of ``window`` words that covers it also starts anywhere
    else in the input, in the same document too. Kept words are joined by one space. Null,
    empty and blank texts have no words; texts shorter than the window keep all of theirs.
    Every row counts as a place of its own, repeated rows too. Rows that agree in id and text
    hash (null ids count as equal) are searched once and lose all words that a window covers.
    Other columns are not read.
    """
    table = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    table = table.withColumn("h", F.xxhash64("text")).withColumn("doc_id", F.coalesce("id", "h"))
    # Rows that agree in id and text share a key: one of them stands for all.
    copies = materialise(table.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "copies")
    rows = table.drop("id")
    single = rows.join(copies, KEY, "left_anti").unionByName(rows.join(copies, KEY, "left_semi").dropDuplicates(KEY))
    spans = repeated_spans(single, window, gram, hot)
    spans = spans.groupBy(*KEY).agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    table = table.join(spans, KEY, "left").join(copies.withColumn("copied", F.lit(True)), KEY, "left")
    table = table.select(F.col("id").alias("doc_id"), "text", "spans", F.coalesce("copied", F.lit(False)).alias("copied"))
    return table.mapInArrow(
        partial(_strip, window=window), "doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string"
    )

"""Packing tokenised documents into sequences: Martello-Toth dominance, then best fit.

A piece is at most ``capacity`` tokens, so a table of any size has at most ``capacity``
different lengths. The instance is the histogram of lengths: fixing dominating sets and
best-fit run on counts, each step for all equal pieces at once, and give a short list of
slots (length, ranks, first sequence, offset). Pieces are then ranked among those of their
length and read their place from that list.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millwright.llm.text import sliced, words_of
from millwright.session import materialise

CAPACITY = 4096
END = 1
BUCKETS = 1024
CACHE = 1_000_000
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


# ------------------------------------------------------------------ tokens
class WordTokenizer:
    """Ids of whole texts, from the ids of their words between white space.

    The tokenizer's pattern never joins characters across ASCII white space and drops that
    space, so a text's ids are those of its words in order. Each distinct word is encoded
    once; a worker process remembers up to ``CACHE`` words between its tasks. Words are told
    apart by 64-bit hashes.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.forget()

    def forget(self):
        self.words = np.zeros(0, dtype=np.uint64)
        self.begin, self.size = np.zeros((2, 0), dtype=np.int64)
        self.ids, self.filled = np.zeros(1 << 20, dtype=np.uint32), 0

    def _add(self, words: np.ndarray, texts: list[str]):
        """Remember new words (ascending hashes)."""
        codes = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        size = np.fromiter(map(len, codes), dtype=np.int64, count=len(codes))
        total = int(size.sum())
        if self.filled + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids) + total, dtype=np.uint32)])
        self.ids[self.filled : self.filled + total] = np.fromiter(chain.from_iterable(codes), dtype=np.uint32, count=total)
        at = np.searchsorted(self.words, words)
        self.begin = np.insert(self.begin, at, self.filled + np.cumsum(size) - size)
        self.size = np.insert(self.size, at, size)
        self.words = np.insert(self.words, at, words)
        self.filled += total

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, offsets of the rows in them)."""
        w = words_of(column)
        distinct, first, inverse = np.unique(w.hash, return_index=True, return_inverse=True)
        if len(self.words) > CACHE:
            self.forget()
        at = np.searchsorted(self.words, distinct)
        known = at < len(self.words)
        known[known] = self.words[at[known]] == distinct[known]
        if not known.all():
            raw = w.data.tobytes()
            at = first[~known]
            self._add(distinct[~known], [raw[a:b].decode() for a, b in zip(w.start[at].tolist(), w.end[at].tolist())])
        at = np.searchsorted(self.words, distinct)
        counts = self.size[at][inverse]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.repeat(self.begin[at][inverse] - (ends - counts), counts) + np.arange(total)]
        return ids, np.append(0, ends)[w.first]


@cache
def tokenizer_at(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def _pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int, end: int) -> Iterator[pa.RecordBatch]:
    tokenizer = tokenizer_at(path)
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    for batch in sliced(batches, "text"):
        ids, cuts = tokenizer.encode(batch["text"])
        rows = []
        for i, doc in enumerate(batch["doc_id"].to_pylist()):
            own = np.append(ids[cuts[i] : cuts[i + 1]], np.uint32(end)).astype("<u4")
            for k, low in enumerate(range(0, len(own), capacity)):
                part = own[low : low + capacity]
                rows.append((doc, k, low, len(part), zlib.crc32(part.tobytes())))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


# ------------------------------------------------------------------ plan on the histogram
@dataclass
class Group:
    """``count`` sequences with the same lengths in the same order."""

    lengths: tuple[int, ...]
    count: int

    @property
    def used(self) -> int:
        return sum(self.lengths)


def dominant_groups(left: dict[int, int], capacity: int) -> list[Group]:
    """Fix sets that dominate every other choice for one of their pieces; ``left`` keeps the rest.

    For a length a, with room r = capacity - a: if nothing fits, a alone dominates. If some
    length equals r, the pair fills the sequence and dominates. If no two remaining pieces fit
    into r together, a with the largest piece that fits dominates. Otherwise no set of at most
    two dominates and a is left. Lengths are tried falling, again and again until a pass fixes
    nothing.
    """
    groups = []
    lengths = sorted(x for x in left if left[x])
    fixed = True
    while fixed:
        fixed = False
        for a in reversed(lengths[:]):
            while left[a]:
                room = capacity - a
                at = bisect_left(lengths, room + 1) - 1
                if at >= 0 and lengths[at] == a and left[a] == 1:
                    at -= 1
                if at < 0:
                    chosen, times = (a,), left[a]
                else:
                    b = lengths[at]
                    smallest = [x for x in lengths[:3] for _ in range(min(2, left[x] - (x == a)))][:2]
                    if b != room and len(smallest) == 2 and sum(smallest) <= room:
                        break
                    chosen, times = (a, b), left[a] // 2 if a == b else min(left[a], left[b])
                groups.append(Group(chosen, times))
                fixed = True
                for x in chosen:
                    left[x] -= times
                for x in set(chosen):
                    if not left[x]:
                        lengths.remove(x)
    for x in [x for x in left if not left[x]]:
        del left[x]
    return groups


def best_fit(left: dict[int, int], capacity: int) -> list[Group]:
    """Best fit in order of falling length, for all equal pieces at once."""
    open_groups: dict[int, list[Group]] = {}
    rooms: list[int] = []
    closed = []

    def put(group: Group):
        room = capacity - group.used
        if not room:
            closed.append(group)
            return
        if room not in open_groups:
            insort(rooms, room)
            open_groups[room] = []
        open_groups[room].append(group)

    for length in sorted(left, reverse=True):
        count = left[length]
        while count:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                each = capacity // length
                whole, rest = divmod(count, each)
                for group in (Group((length,) * each, whole), Group((length,) * rest, 1)):
                    if group.count and group.lengths:
                        put(group)
                break
            room = rooms[at]
            group = open_groups[room].pop()
            if not open_groups[room]:
                del open_groups[room]
                rooms.remove(room)
            each = min(room // length, count)
            times = min(group.count, count // each)
            if times < group.count:
                put(Group(group.lengths, group.count - times))
            put(Group((*group.lengths, *(length,) * each), times))
            count -= times * each
    return closed + [g for groups in open_groups.values() for g in groups]


def plan(histogram: dict[int, int], capacity: int) -> list[Group]:
    left = {int(k): int(v) for k, v in histogram.items()}
    return dominant_groups(left, capacity) + best_fit(left, capacity)


def slots(groups: list[Group]) -> dict[int, np.ndarray]:
    """For every length, rows (first rank, first sequence, offset) in order of rank."""
    out: dict[int, list] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for g in groups:
        offset = 0
        for length in g.lengths:
            rank = taken.get(length, 0)
            out.setdefault(length, []).append((rank, sequence, offset))
            taken[length] = rank + g.count
            offset += length
        sequence += g.count
    return {k: np.array(v, dtype=np.int64) for k, v in out.items()}


def _place(batches: Iterator[pa.RecordBatch], where: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        length, rank = (batch[c].to_numpy(zero_copy_only=False) for c in ("length", "rank"))
        found = np.zeros((2, len(length)), dtype=np.int64)
        for x in np.unique(length):
            here = np.flatnonzero(length == x)
            rows = where[int(x)]
            at = np.searchsorted(rows[:, 0], rank[here], side="right") - 1
            found[0, here] = rows[at, 1] + rank[here] - rows[at, 0]
            found[1, here] = rows[at, 2]
        kept = [batch[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(found[0]), pa.array(found[1])],
            names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
        )


def pack(
    docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = END
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids by the tokenizer file at ``tokenizer`` and then ``end``. Only
    longer ones than ``capacity`` are cut. Null and empty texts are one piece of one token.
    Repeated rows and null ids are packed like any other. Other columns are not read.
    The file must be readable at that path by every worker.
    """
    table = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    pieces = table.mapInArrow(partial(_pieces, path=tokenizer, capacity=capacity, end=end), PIECE)
    pieces = materialise(pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(BUCKETS))), "pieces")
    counts = pieces.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    # One row per length: at most ``capacity``.
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = pieces.withColumn("rank", F.row_number().over(inside)).join(counts, ["length", "bucket"])
    ranked = ranked.withColumn("rank", F.col("rank").cast("long") - 1 + F.col("skip")).drop("skip", "bucket")
    return ranked.mapInArrow(partial(_place, where=slots(plan(histogram, capacity))), f"{PIECE}, sequence_id long, offset long")

"""Runs (maximal periodic stretches of words) of whole texts, by maximal pairs.

A run with smallest period q and length L that starts at word s shows as two occurrences of
the same ``L - q`` words, at s and at s + q, which neither their left nor their right
neighbours extend: a maximal pair. Its distance q is at most its length ``L - q``. Read the
other way, every maximal pair whose distance is at most its length is a run, and its two
ends are known without comparing words further.

Maximal pairs come from the LCP-interval tree of the sorted suffixes, built bottom-up. Each
interval holds the places where its words occur, in order, each with the class of the word
on its left. Joining two children of an interval of length l pairs places of different
children, which therefore differ on the right; only places of different left classes make a
pair. Places are paired with their neighbours alone: were there another occurrence between
the two, the stretch would have a shorter period. Smaller children are put into the larger,
so that a place moves O(log n) times.

A run of at least ``least`` words needs a repeated stretch of half of it, so documents
without one have no suffixes sorted, and short intervals are left out of the tree.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.llm.text import Prefix, mix, sliced, words_of

#: Words a run has at least.
LEAST = 12
RUN = "struct<start:bigint,length:bigint,period:bigint>"
SCHEMA = f"n_words long, runs array<{RUN}>, n_dropped long, kept_text string"


def _gram_repeats(words: np.ndarray, row: np.ndarray, gram: int) -> np.ndarray:
    """Words at which a stretch of ``gram`` words starts that starts elsewhere in its row too."""
    total = len(words)
    again = np.zeros(total, dtype=bool)
    if total >= gram:
        at = np.arange(total - gram + 1)
        at = at[row[at] == row[at + gram - 1]]
        value = Prefix(words).hash(at, at + gram) ^ mix(row[at].astype(np.uint64))
        order = np.argsort(value, kind="stable")
        same = value[order[1:]] == value[order[:-1]]
        again[at[order[1:][same]]] = True
        again[at[order[:-1][same]]] = True
    return again


def _sorted_suffixes(words: np.ndarray, row: np.ndarray, end: np.ndarray, active: np.ndarray) -> np.ndarray:
    """The active places in the order of the suffixes of their rows, rows one after the other.

    Ranks by the first 1, 2, 4, ... words; a suffix that ends sorts before one that goes on.
    Places whose rank is already their own are not sorted again.
    """
    total = len(words)
    rank = np.unique(words, return_inverse=True)[1].astype(np.int64)
    _, where, counts = np.unique(row * np.int64(total + 1) + rank, return_inverse=True, return_counts=True)
    # A class has the number of the places sorted before it, so its parts find room behind it.
    rank = (np.cumsum(counts) - counts)[where] + 1
    span = 1
    todo = np.arange(total)
    longest = int((end - np.arange(total)).max(initial=0))
    while span < longest and len(todo):
        after = todo + span
        inside = after < end[todo]
        follow = np.zeros(len(todo), dtype=np.int64)
        follow[inside] = rank[after[inside]]
        order = np.lexsort((follow, rank[todo]))
        todo, follow = todo[order], follow[order]
        base = rank[todo]
        fresh = np.ones(len(todo), dtype=bool)
        fresh[1:] = base[1:] != base[:-1]
        split = fresh.copy()
        split[1:] |= follow[1:] != follow[:-1]
        place = np.arange(len(todo))
        # A class keeps its first rank; its parts take that rank plus the places before them.
        rank[todo] = base + np.maximum.accumulate(np.where(split, place, 0)) - np.maximum.accumulate(np.where(fresh, place, 0))
        alone = split & np.append(split[1:], True)
        todo = todo[~alone]
        span *= 2
    places = np.flatnonzero(active)
    return places[np.lexsort((rank[places], row[places]))]


def _common(prefix: Prefix, a: np.ndarray, b: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at ``a`` and at ``b`` of the same row."""
    low = np.zeros(len(a), dtype=np.int64)
    high = np.minimum(end[a] - a, end[b] - b)
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        middle = (low[open_] + high[open_] + 1) // 2
        x, y = a[open_], b[open_]
        same = prefix.hash(x, x + middle) == prefix.hash(y, y + middle)
        low[open_] = np.where(same, middle, low[open_])
        high[open_] = np.where(same, high[open_], middle - 1)


def _join(one: list[int], other: list[int], length: int, left: list[int], least: int, found: list) -> list[int]:
    """The places of both children of an interval of ``length`` words; pairs that are runs go to ``found``."""
    if len(one) < len(other):
        one, other = other, one
    closest = least - length
    for t, y in enumerate(other):
        k = bisect_left(one, y)
        if k:
            x = one[k - 1]
            if closest <= y - x <= length and left[x] != left[y] and not (t and other[t - 1] > x):
                found.append((x, y - x + length, y - x))
        if k < len(one):
            x = one[k]
            if closest <= x - y <= length and left[x] != left[y] and not (t + 1 < len(other) and other[t + 1] < x):
                found.append((y, x - y + length, x - y))
    if len(other) * 8 < len(one):
        for y in other:
            insort(one, y)
    else:
        one += other
        one.sort()
    return one


def _pairs(suffixes: list[int], lcp: list[int], left: list[int], shortest: int, least: int) -> list[tuple[int, int, int]]:
    """Runs (first word, length, period) from one bottom-up pass over the LCP intervals.

    ``lcp[i]`` belongs to the suffixes i - 1 and i. ``stack`` holds the open intervals, the
    longest on top, each with the places of the children it already has.
    """
    found: list[tuple[int, int, int]] = []
    stack: list[tuple[int, list[int]]] = []
    for i in range(1, len(suffixes) + 1):
        now = lcp[i] if i < len(suffixes) else 0
        if not stack and now < shortest:
            continue
        done = [suffixes[i - 1]]
        while stack and stack[-1][0] >= now:
            length, places = stack.pop()
            done = _join(places, done, length, left, least, found)
            if length == now:
                break
        if now >= shortest:
            stack.append((now, done))
    return found


def find_runs(words: np.ndarray, row: np.ndarray, first: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(first word, length, period) of all runs of ``least`` words or more, of all rows.

    ``words`` are word hashes, ``row`` their rows in ascending order, ``first`` the first
    word of each row and one entry more.
    """
    shortest = (least + 1) // 2
    again = _gram_repeats(words, row, shortest)
    if not again.any():
        return []
    whole = np.isin(row, np.unique(row[again]))
    places = np.flatnonzero(whole)
    words, own, again = words[whole], row[whole], again[whole]
    total = len(words)
    start = np.searchsorted(own, own)
    end = np.searchsorted(own, own, side="right")
    suffixes = _sorted_suffixes(words, own, end, again)
    a, b = suffixes[:-1], suffixes[1:]
    lcp = np.zeros(len(suffixes), dtype=np.int64)
    same = np.flatnonzero(own[a] == own[b])
    lcp[same + 1] = _common(Prefix(words), a[same], b[same], end)
    left = np.unique(words, return_inverse=True)[1].astype(np.int64)
    left = np.append(-1, left[:-1])
    at_start = start == np.arange(total)
    left[at_start] = -1 - np.arange(total)[at_start]
    found = _pairs(suffixes.tolist(), lcp.tolist(), left.tolist(), shortest, least)
    return [(int(places[s]), length, period) for s, length, period in found]


def _collapse(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    for batch in sliced(batches, "_text"):
        w = words_of(batch["_text"])
        runs: dict[int, list[tuple[int, int, int]]] = {}
        for s, length, period in find_runs(w.hash, w.row, w.first, least):
            row = int(w.row[s])
            runs.setdefault(row, []).append((s - int(w.first[row]), length, period))
        listed, dropped, kept = [], [], []
        for i, text in enumerate(batch["_text"].to_pylist()):
            words = (text or "").encode().split()
            own = sorted(runs.get(i, ()), key=lambda r: (r[0], r[2]))
            keep = np.ones(len(words), dtype=bool)
            for s, length, period in own:
                keep[s + period : s + length] = False
            listed.append([{"start": s, "length": n, "period": q} for s, n, q in own])
            dropped.append(len(words) - int(keep.sum()))
            kept.append(b" ".join([x for x, k in zip(words, keep.tolist()) if k] if own else words).decode())
        columns = [pa.array(np.diff(w.first)), pa.array(listed, kind), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())]
        yield pa.RecordBatch.from_arrays(
            [batch["_id"], *columns], names=["_id", "n_words", "runs", "n_dropped", "kept_text"]
        )


def collapse_runs(docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """One row per row of ``docs``: id, n_words, runs, n_dropped, kept_text.

    ``runs`` lists (start, length, period), in words from 0, of every stretch of at least
    ``least`` words and twice its smallest period that no neighbouring word extends, by
    start, then period. Words that a run contains after its first period are dropped; the
    others are joined by one space. Null, empty and blank texts have no words and no runs.
    Null and repeated ids and repeated rows are rows like any other; an empty table gives
    an empty one, and other columns are not read. Nothing is shuffled, and a task holds
    the words of half a megabyte of text or of one longer text. Words and stretches are
    compared by 64-bit hashes.
    """
    table = docs.select(F.col(id).alias("_id"), F.col(text).alias("_text"))
    kind = table.schema["_id"].dataType.simpleString()
    found = table.mapInArrow(partial(_collapse, least=least), f"_id {kind}, {SCHEMA}")
    return found.withColumnRenamed("_id", id)


def longest_run(runs: str = "runs") -> Column:
    """The run of the greatest length, of the smallest start, then period; null where there is none."""
    keyed = F.transform(runs, lambda r: F.struct((-r["length"]).alias("order"), r["start"].alias("start"), r["period"].alias("period")))
    return F.array_min(keyed)


def with_periodic_tails(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the texts of some ids made periodic, a known stretch to look for.

    With h = crc32 of the decimal id and g = h div 10, texts with h mod 10 = 0 keep their
    words up to a = g mod n; later ones repeat the p = 1 + (n - a) div (3 + g mod 8) words
    from a on. Texts without words and rows without an id stay as they are.
    """
    h = F.crc32(F.col(id).cast("string").cast("binary"))
    words = F.filter(F.split(F.col(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    picked = (F.col(id).isNotNull()) & (h % 10 == 0)
    table = docs.withColumn("_h", h).withColumn("_w", F.when(picked, words))
    n = F.size("_w")
    g = F.floor(F.col("_h") / 10)
    a = (g % n).cast("int")
    p = F.expr("CAST(1 + (size(_w) - _a) div (3 + _g % 8) AS INT)")
    table = table.withColumn("_g", g).withColumn("_a", F.when(n > 0, a)).withColumn("_p", F.when(n > 0, p))
    spot = F.transform(
        F.sequence(F.lit(0), n - 1), lambda i: F.get("_w", F.when(i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p")))
    )
    tail = F.when(picked & (n > 0), F.array_join(spot, " ")).otherwise(F.col(text))
    return table.withColumn(text, tail).drop("_h", "_w", "_g", "_a", "_p")

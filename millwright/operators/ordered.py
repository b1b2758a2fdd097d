"""Ordered analytics that never gather an unbounded group in one task.

A window over a whole table, or over one very large machine, would run in a single
task. Here the table is range-partitioned along the order column and stored once; each
range is a chunk, and a hot group is spread over its chunks. Each operator then works in two steps: a small summary
row per (group, chunk) is built by a partial aggregate and combined across chunks, and
the rows are finished by a window inside their own chunk; only the summaries cross chunks.
Tables of any size take this path; ``rows``, the rows of a chunk, is a parameter of every
operator.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwright.session import materialise

CHUNK = "_chunk"


@dataclass
class Chunked:
    """A table cut along its order column."""

    df: DataFrame
    order: str
    tie: str | None

    @property
    def at(self) -> Column:
        """Sort key of a row as one value: nulls last, ties by the tie column."""
        parts = [F.col(self.order).isNull().alias("n"), F.col(self.order).alias("o")]
        if self.tie:
            parts.append(F.col(self.tie).alias("t"))
        return F.struct(*parts)

    def keys(self, group: list[str]) -> list[str]:
        return [*group, CHUNK]

    def inside(self, group: list[str]):
        """Rows of one group and chunk."""
        return Window.partitionBy(*self.keys(group))

    def forward(self, group: list[str]):
        tie = [F.asc(self.tie)] if self.tie else []
        return self.inside(group).orderBy(F.asc_nulls_last(self.order), *tie)

    def backward(self, group: list[str]):
        tie = [F.desc(self.tie)] if self.tie else []
        return self.inside(group).orderBy(F.desc_nulls_first(self.order), *tie)

    def attach(self, rows: DataFrame, summary: DataFrame, group: list[str]) -> DataFrame:
        return rows.join(summary, self.keys(group), "left")

    def on(self, df: DataFrame) -> Chunked:
        """The same cuts over a later version of the rows."""
        return replace(self, df=df)


def _number(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(F.col(column)).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(F.col(column)).cast("double")
    return F.col(column).cast("double")


def chunked(df: DataFrame, order: str, tie: str | None = None, rows: int | None = None) -> Chunked:
    """Cut ``df`` along ``order``, nulls last, ties along ``tie``, and store it with its chunks.

    Chunks are Spark's range partitions: of the size AQE gives partitions, or of about
    ``rows`` rows. They follow the order, so a later chunk holds later rows, and a value of
    ``order`` with a large share of the rows is cut along ``tie``. The input is evaluated
    for this one exchange; summaries and rows read the stored chunks.
    """
    keys = [F.col(order).isNull(), F.col(order), *([F.col(tie)] if tie else [])]
    count = [max(1, math.ceil(df.select(order).count() / rows))] if rows else []
    dealt = df.repartitionByRange(*count, *keys).withColumn(CHUNK, F.spark_partition_id())
    return Chunked(materialise(dealt, "chunks"), order, tie)


def _across(group: list[str]):
    """Chunks of one group in order: one summary row per chunk, not the table's rows."""
    return Window.partitionBy(*(group or [F.lit(0)])).orderBy(CHUNK)


BEFORE = (Window.unboundedPreceding, -1)
AFTER = (1, Window.unboundedFollowing)
UP_TO_HERE = (Window.unboundedPreceding, 0)
WHOLE = (Window.unboundedPreceding, Window.unboundedFollowing)


def with_positions(
    df: DataFrame, group: list[str], order: str, tie: str | None = None, rows: int | None = None
) -> DataFrame:
    """Adds ``_pos`` (1-based exact rank inside the group) and ``_n`` (group size)."""
    cut = chunked(df, order, tie, rows)
    local = F.row_number().over(cut.forward(group)).cast("long")
    across = _across(group)
    summary = (
        cut.df.groupBy(*cut.keys(group))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumns(
            {
                "_skip": F.coalesce(F.sum("_rows").over(across.rowsBetween(*BEFORE)), F.lit(0)),
                "_n": F.sum("_rows").over(across.rowsBetween(*WHOLE)),
            }
        )
        .drop("_rows")
    )
    out = _attach_null_safe(cut, cut.df.withColumn("_pos", local), summary, group)
    return out.withColumn("_pos", F.col("_pos") + F.col("_skip")).drop("_skip", CHUNK)


def _attach_null_safe(cut: Chunked, rows: DataFrame, summary: DataFrame, group: list[str]) -> DataFrame:
    keys = cut.keys(group)
    other = summary.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    on = [rows[k].eqNullSafe(other[f"_k_{k}"]) for k in keys]
    return rows.join(other, on, "left").drop(*[f"_k_{k}" for k in keys])


def running_sum(
    df: DataFrame,
    group: list[str],
    order: str,
    columns: dict[str, str],
    descending: bool = False,
    rows: int | None = None,
) -> DataFrame:
    """Cumulative sums along ``order`` (unique inside a group): {source: result}.

    ``<result>_total`` holds the group's total.
    """
    cut = chunked(df, order, None, rows)
    window = cut.backward(group) if descending else cut.forward(group)
    local = {
        out: F.sum(src).over(window.rowsBetween(*UP_TO_HERE)) for src, out in columns.items()
    }
    across = Window.partitionBy(*(group or [F.lit(0)]))
    ahead = across.orderBy(F.desc(CHUNK)) if descending else across.orderBy(CHUNK)
    summary = (
        cut.df.groupBy(*cut.keys(group))
        .agg(*[F.sum(src).alias(f"_s_{out}") for src, out in columns.items()])
        .withColumns(
            {f"_b_{out}": F.sum(f"_s_{out}").over(ahead.rowsBetween(*BEFORE)) for out in columns.values()}
            | {f"{out}_total": F.sum(f"_s_{out}").over(ahead.rowsBetween(*WHOLE)) for out in columns.values()}
        )
        .drop(*[f"_s_{out}" for out in columns.values()])
    )
    joined = _attach_null_safe(cut, cut.df.withColumns(local), summary, group)
    full = {
        out: F.when(
            F.col(out).isNotNull() | F.col(f"_b_{out}").isNotNull(),
            F.coalesce(F.col(out), F.lit(0)) + F.coalesce(F.col(f"_b_{out}"), F.lit(0)),
        )
        for out in columns.values()
    }
    return joined.withColumns(full).drop(*[f"_b_{out}" for out in columns.values()], CHUNK)


def fill_forward_back(
    df: DataFrame,
    columns: list[str],
    order: str,
    group: list[str] | None = None,
    tie: str | None = None,
    rows: int | None = None,
    cut: Chunked | None = None,
) -> DataFrame:
    """Fill gaps with the last value before, leading gaps with the group's first value.

    Rows whose group key is null end up null. With ``cut`` the rows are already chunked
    and keep their chunk columns.
    """
    group = group or []
    given, cut = cut, cut.on(df) if cut else chunked(df, order, tie, rows)
    seen = cut.forward(group).rowsBetween(*UP_TO_HERE)
    local = {c: F.last(c, ignorenulls=True).over(seen) for c in columns}
    known = _all_present(group)

    at = cut.at
    ends = []
    for c in columns:
        here = F.when(F.col(c).isNotNull(), at)
        ends += [F.max_by(c, here).alias(f"_l_{c}"), F.min_by(c, here).alias(f"_f_{c}")]
    across = _across(group)
    summary = (
        cut.df.groupBy(*cut.keys(group))
        .agg(*ends)
        .withColumns(
            {f"_p_{c}": F.last(f"_l_{c}", ignorenulls=True).over(across.rowsBetween(*BEFORE)) for c in columns}
            | {f"_s_{c}": F.first(f"_f_{c}", ignorenulls=True).over(across.rowsBetween(*WHOLE)) for c in columns}
        )
        .drop(*[f"_{e}_{c}" for c in columns for e in "lf"])
    )
    rows_ = cut.df.withColumns({f"_r_{c}": local[c] for c in columns})
    joined = cut.attach(rows_, summary, group)
    filled = {
        c: F.when(known, F.coalesce(F.col(f"_r_{c}"), F.col(f"_p_{c}"), F.col(f"_s_{c}")))
        for c in columns
    }
    helper = [f"_{e}_{c}" for c in columns for e in "rps"]
    return joined.withColumns(filled).drop(*helper, *_own_cuts(given))


def _own_cuts(given: Chunked | None) -> list[str]:
    return [] if given else [CHUNK]


def _all_present(group: list[str]) -> Column:
    present = F.lit(True)
    for g in group:
        present = present & F.col(g).isNotNull()
    return present


def interpolate_linear(
    df: DataFrame,
    columns: list[str],
    order: str,
    group: list[str] | None = None,
    tie: str | None = None,
    rows: int | None = None,
    cut: Chunked | None = None,
) -> DataFrame:
    """Linear interpolation by row position; outer gaps take the nearest value.

    Rows whose group key is null end up null. Values come back as doubles. With ``cut``
    the rows are already chunked and keep their chunk columns.
    """
    group = group or []
    given, cut = cut, cut.on(df) if cut else chunked(df, order, tie, rows)
    base = cut.df.withColumn("_pos", F.row_number().over(cut.forward(group)).cast("long"))

    def mark(c: str) -> Column:
        return F.when(
            F.col(c).isNotNull(), F.struct(F.col("_pos").alias("p"), F.col(c).cast("double").alias("v"))
        )

    across = _across(group)
    reverse = Window.partitionBy(*(group or [F.lit(0)])).orderBy(F.desc(CHUNK))
    ends = [F.count(F.lit(1)).alias("_rows")]
    for c in columns:
        ends += [F.max(mark(c)).alias(f"_l_{c}"), F.min(mark(c)).alias(f"_f_{c}")]
    skip = F.coalesce(F.sum("_rows").over(across.rowsBetween(*BEFORE)), F.lit(0))
    summary = base.groupBy(*cut.keys(group)).agg(*ends).withColumn("_skip", skip)

    def shifted(name: str) -> Column:
        return F.when(
            F.col(name).isNotNull(),
            F.struct((F.col(f"{name}.p") + F.col("_skip")).alias("p"), F.col(f"{name}.v").alias("v")),
        )

    moved = {f"_{e}_{c}": shifted(f"_{e}_{c}") for c in columns for e in "lf"}
    around = {
        f"_before_{c}": F.last(f"_l_{c}", ignorenulls=True).over(across.rowsBetween(*BEFORE))
        for c in columns
    } | {
        f"_after_{c}": F.last(f"_f_{c}", ignorenulls=True).over(reverse.rowsBetween(*BEFORE))
        for c in columns
    }
    summary = (
        summary.withColumns(moved)
        .withColumns(around)
        .drop("_rows", *[f"_{e}_{c}" for c in columns for e in "lf"])
    )
    base = cut.attach(base, summary, group)
    base = base.withColumn("_pos", F.col("_pos") + F.coalesce(F.col("_skip"), F.lit(0))).drop("_skip")

    # The forward order is the one the positions were numbered in, so it needs no new sort.
    ahead = cut.forward(group).rowsBetween(*UP_TO_HERE)
    behind = cut.backward(group).rowsBetween(*UP_TO_HERE)
    neighbours = {}
    for c in columns:
        prev = F.coalesce(F.last(mark(c), True).over(ahead), F.col(f"_before_{c}"))
        nxt = F.coalesce(F.last(mark(c), True).over(behind), F.col(f"_after_{c}"))
        neighbours |= {f"_prev_{c}": prev, f"_next_{c}": nxt}
    base = base.withColumns(neighbours)
    known = _all_present(group)
    filled = {c: F.when(known, _lerp(F.col(c), c)) for c in columns}
    helper = [f"_{e}_{c}" for c in columns for e in ("prev", "next", "before", "after")]
    return base.withColumns(filled).drop("_pos", *helper, *_own_cuts(given))


def _lerp(value: Column, c: str) -> Column:
    p, n = F.col(f"_prev_{c}"), F.col(f"_next_{c}")
    steps = F.nullif((n["p"] - p["p"]).cast("double"), F.lit(0.0))
    slope = (n["v"] - p["v"]) / steps
    between = slope * (F.col("_pos") - p["p"]).cast("double") + p["v"]
    return F.coalesce(value.cast("double"), between, p["v"], n["v"])


def interpolate_timestamps(
    df: DataFrame,
    column: str,
    order: str,
    group: list[str] | None = None,
    rows: int | None = None,
    cut: Chunked | None = None,
) -> DataFrame:
    """``interpolate_linear`` on a timestamp, in whole microseconds."""
    out = df.withColumn(column, _number(df, column))
    out = interpolate_linear(out, [column], order, group, None, rows, cut)
    return out.withColumn(column, F.timestamp_micros(F.floor(column).cast("long")).cast("timestamp_ntz"))


def group_median(df: DataFrame, group: list[str], column: str, rows: int | None = None) -> DataFrame:
    """Exact median of ``column`` per group (nulls ignored), as ``median``.

    Equal values are counted before anything is ordered, and the counts are accumulated
    chunk by chunk, so neither a hot group nor many distinct values meet in one task.
    """
    counts = (
        df.filter(F.col(column).isNotNull()).groupBy(*group, column).agg(F.count(F.lit(1)).alias("_c"))
    )
    cum = running_sum(counts, group, column, {"_c": "_upto"}, rows=rows)
    low, high = (F.col("_upto_total") + 1) / 2, F.col("_upto_total") / 2 + 1
    picks = cum.groupBy(*group).agg(
        F.min(F.when(F.col("_upto") >= F.floor(low), F.col(column))).alias("_lo"),
        F.min(F.when(F.col("_upto") >= F.floor(high), F.col(column))).alias("_hi"),
    )
    return picks.select(
        *group, ((F.col("_lo").cast("double") + F.col("_hi").cast("double")) / 2).alias("median")
    )


def group_median_fill(
    df: DataFrame, group: str, column: str, rows: int | None = None
) -> DataFrame:
    """Missing values take their group's median; with a null group the value is lost."""
    medians = group_median(df.filter(F.col(group).isNotNull()), [group], column, rows)
    value = F.coalesce(F.col(column).cast("double"), F.col("median"))
    return (
        df.join(medians, group, "left")
        .withColumn(column, F.when(F.col(group).isNotNull(), value))
        .select(*df.columns)
    )


def latest_by(df: DataFrame, key: str, ts: str, tie: str) -> DataFrame:
    """The newest row per key: timestamps first, null last, lowest ``tie`` on equal times.

    An aggregate with map-side combine, so a hot key costs one row per task.
    """
    newest = F.struct(F.col(ts).isNotNull().alias("s"), F.col(ts).alias("t"), (-F.col(tie)).alias("i"))
    others = [c for c in df.columns if c != key]
    return (
        df.groupBy(key)
        .agg(F.max_by(F.struct(*others), newest).alias("_r"))
        .select(key, *[F.col(f"_r.{c}").alias(c) for c in others])
        .select(*df.columns)
    )


def _cut_keys(cut: Chunked, shares: list[float]) -> dict[int, tuple]:
    """{rank: (order, tie)} of the rows at the 0-based global ranks ``int(n * share)``; None past the end.

    Rows per chunk are counted, and just the chunks that hold a wanted rank are sorted and
    return one row each to the driver.
    """
    whole = Window.partitionBy(F.lit(0))
    sizes = cut.df.groupBy(CHUNK).agg(F.count(F.lit(1)).alias("_rows"))
    sizes = sizes.withColumns(
        {
            "_start": F.coalesce(F.sum("_rows").over(_across([]).rowsBetween(*BEFORE)), F.lit(0)),
            "_n": F.sum("_rows").over(whole),
        }
    )
    ranks = [F.floor(F.col("_n") * F.lit(share)) for share in shares]
    holds = [(F.col("_start") <= r) & (F.col("_start") + F.col("_rows") > r) for r in ranks]
    asked = sizes.filter(reduce(or_, holds)).select(CHUNK, "_start", F.array(*ranks).alias("_ranks")).collect()
    found = {}
    for s in asked:
        here = [r - s["_start"] for r in s["_ranks"]]
        ordered = cut.df.filter(F.col(CHUNK) == s[CHUNK]).withColumn("_pos", F.row_number().over(cut.forward([])) - 1)
        places = {r["_pos"]: (r[cut.order], r[cut.tie]) for r in ordered.filter(F.col("_pos").isin(here)).collect()}
        found |= {i: places[p] for i, p in enumerate(here) if p in places}
    return found


def temporal_split(
    df: DataFrame, ts: str, tie: str, train: float = 0.70, val: float = 0.15, rows: int | None = None
) -> DataFrame:
    """Adds ``split`` by global time order: the first ``int(n*train)`` rows train, and so on.

    The two cut rows are found first, from the two columns alone; labelling is then a
    comparison, so the wide rows are neither sorted nor shuffled and each split is a filter.
    """
    cuts = _cut_keys(chunked(df.select(ts, tie), ts, tie, rows), [train, train + val])

    def before(rank: int) -> Column:
        if rank not in cuts:
            return F.lit(True)
        at, t = cuts[rank]
        same = F.col(tie) < F.lit(t)
        if at is None:
            return F.col(ts).isNotNull() | same
        at = F.lit(at).cast(df.schema[ts].dataType)
        return F.coalesce((F.col(ts) < at) | ((F.col(ts) == at) & same), F.lit(False))

    return df.withColumn(
        "split", F.when(before(0), "train").when(before(1), "val").otherwise("test")
    )


def temporal_split_per_key(
    df: DataFrame,
    key: str,
    ts: str,
    tie: str,
    train: float = 0.70,
    val: float = 0.15,
    rows: int | None = None,
) -> DataFrame:
    """The same cut inside each key; keeps ``_pos`` and ``_n`` of the row inside its key."""
    out = with_positions(df, [key], ts, tie, rows)
    n = F.col("_n").cast("double")
    first, second = F.floor(n * train), F.floor(n * (train + val))
    return out.withColumn(
        "split",
        F.when(F.col("_pos") <= first, "train").when(F.col("_pos") <= second, "val").otherwise("test"),
    )


def sliding_sequences(
    df: DataFrame,
    group: list[str],
    order: str,
    tie: str,
    features: list[str],
    label: str,
    length: int = 24,
    block: int = 100_000,
    rows: int | None = None,
) -> DataFrame:
    """Windows of ``length`` consecutive rows per group, labelled by their last row.

    Groups of at most ``length`` rows give none. Exact positions cut each group into
    fixed blocks; the last ``length-1`` rows of a block are also sent to the next one, so
    every window is complete inside its block and no task holds a whole hot group.
    """
    block = max(block, length)
    at = with_positions(df.select(*dict.fromkeys([*group, order, tie, *features, label])), group, order, tie, rows)
    at = at.filter(F.col("_n") > length)
    own = F.floor((F.col("_pos") - 1) / block)
    overlap = (F.col("_pos") - 1) % block >= block - (length - 1)
    spread = at.withColumn("_own", own).withColumn(
        "_block", F.explode(F.when(overlap, F.array(own, own + 1)).otherwise(F.array(own)))
    )
    frame = Window.partitionBy(*group, "_block").orderBy("_pos").rowsBetween(-(length - 1), 0)
    return (
        spread.withColumn("sequence", F.collect_list(F.array(*[F.col(f).cast("double") for f in features])).over(frame))
        .filter((F.col("_own") == F.col("_block")) & (F.col("_pos") >= length))
        .select(*group, order, tie, F.col("_pos").alias("position"), "sequence", F.col(label).alias("label"))
    )

"""Ordered analytics. Each operator also runs with small chunks, the form used on large tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millwright.catalog import oracle as Q
from millwright.catalog.registry import query
from millwright.operators import ordered as O

SMALL = 1500


def both(name, sql):
    """Register ``fn(tables, rows)`` with the default chunk size and with a small one."""

    def register(fn):
        query(name, sql)(lambda t: fn(t, None))
        query(f"{name}_chunked", sql)(lambda t: fn(t, SMALL))
        return fn

    return register


def gappy(t):
    k = F.col("k")
    return t.events().select(
        "event_id", F.when(k < 96, F.col("user_id")).alias("machine"), F.when(k >= 40, F.col("event_type")).alias("status"),
        F.when((k >= 30) & (k < 95), F.col("value")).alias("temperature"), F.when(k >= 60, k.cast("double")).alias("level"),
        F.when(k >= 50, F.col("ts")).alias("stamp"), "k", "ts", "user_id",
    )


GAPPY = {
    "gappy": """SELECT event_id, CASE WHEN k < 96 THEN user_id END AS machine, CASE WHEN k >= 40 THEN event_type END AS status,
    CASE WHEN k >= 30 AND k < 95 THEN value END AS temperature, CASE WHEN k >= 60 THEN CAST(k AS DOUBLE) END AS level,
    CASE WHEN k >= 50 THEN ts END AS stamp, k, ts, user_id FROM ev"""
}


def fill(c, part=""):
    w = f"{part} ORDER BY event_id"
    return (
        f"coalesce(last_value({c} IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
        f"first_value({c} IGNORE NULLS) OVER ({w} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"
    )


@both("fill_forward_back", Q.sql(f"SELECT event_id, {fill('status')} AS status, {fill('level')} AS level FROM gappy", **GAPPY))
def _fill(t, rows):
    out = O.fill_forward_back(gappy(t), ["status", "level"], "event_id", rows=rows)
    return out.select("event_id", "status", "level")


@both(
    "fill_by_group",
    Q.sql(f"SELECT event_id, CASE WHEN machine IS NOT NULL THEN {fill('status', 'PARTITION BY machine')} END AS status FROM gappy", **GAPPY),
)
def _fill_group(t, rows):
    return O.fill_forward_back(gappy(t), ["status"], "event_id", ["machine"], rows=rows).select("event_id", "status")


def lerp(c, part, order="event_id"):
    """CTE text adding i_<c>: c interpolated by row position inside the partition."""
    p = f"PARTITION BY {part} " if part else ""
    ahead = f"OVER ({p}ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    behind = f"OVER ({p}ORDER BY {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    at = f"CASE WHEN {c} IS NOT NULL THEN pos END"
    return f"""SELECT *, CASE WHEN {c} IS NOT NULL THEN {c} WHEN p0 IS NOT NULL AND p1 IS NOT NULL THEN
        (v1 - v0) / CAST(p1 - p0 AS DOUBLE) * CAST(pos - p0 AS DOUBLE) + v0 ELSE coalesce(v0, v1) END AS i_{c} FROM
        (SELECT *, last_value({at} IGNORE NULLS) {ahead} AS p0, last_value({c} IGNORE NULLS) {ahead} AS v0,
         first_value({at} IGNORE NULLS) {behind} AS p1, first_value({c} IGNORE NULLS) {behind} AS v1 FROM
        (SELECT *, row_number() OVER ({p}ORDER BY {order}) AS pos FROM gappy))"""


@both("interpolate_linear", Q.sql("SELECT event_id, i_temperature AS temperature FROM filled", filled=lerp("temperature", ""), **GAPPY))
def _interpolate(t, rows):
    return O.interpolate_linear(gappy(t), ["temperature"], "event_id", rows=rows).select("event_id", "temperature")


@both(
    "interpolate_by_machine",
    Q.sql("SELECT event_id, CASE WHEN machine IS NOT NULL THEN i_level END AS level FROM filled", filled=lerp("level", "machine"), **GAPPY),
)
def _interpolate_group(t, rows):
    return O.interpolate_linear(gappy(t), ["level"], "event_id", ["machine"], rows=rows).select("event_id", "level")


@both(
    "interpolate_timestamp",
    Q.sql(
        f"SELECT event_id, {Q.ts_text('make_timestamp(CAST(floor(i_us) AS BIGINT))')} AS stamp FROM filled",
        filled=lerp("us", "").replace("FROM gappy", "FROM (SELECT event_id, CAST(epoch_us(stamp) AS DOUBLE) AS us FROM gappy)"), **GAPPY,
    ),
)
def _interpolate_ts(t, rows):
    return O.interpolate_timestamps(gappy(t), "stamp", "event_id", rows=rows).select("event_id", "stamp")


SPLIT = "CASE WHEN r < floor(n * 0.7) THEN 'train' WHEN r < floor(n * 0.85) THEN 'val' ELSE 'test' END AS split"


@both(
    "temporal_split",
    f"SELECT event_id, {SPLIT} FROM (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS r, CAST(count(*) OVER () AS DOUBLE) AS n FROM events)",
)
def _split(t, rows):
    return O.temporal_split(t.read("events"), "ts", "event_id", rows=rows).select("event_id", "split")


@both(
    "temporal_split_per_machine",
    f"""SELECT event_id, {SPLIT} FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS r,
        CAST(count(*) OVER (PARTITION BY user_id) AS DOUBLE) AS n FROM events)""",
)
def _split_machine(t, rows):
    return O.temporal_split_per_key(t.read("events"), "user_id", "ts", "event_id", rows=rows).select("event_id", "split")


SEGMENTS = f"""SELECT event_id, user_id, ts, k, value, {SPLIT} FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS r,
  CAST(count(*) OVER (PARTITION BY user_id) AS DOUBLE) AS n FROM ev)"""
WINDOWS = """SELECT user_id, split, event_id, position, k AS label, s24 AS sum_k, c24 AS n_steps, f24 AS first_k FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, split ORDER BY ts, event_id) AS position, count(*) OVER (PARTITION BY user_id, split) AS m,
  CAST(sum(k) OVER w AS DOUBLE) AS s24, CAST(count(*) OVER w AS INTEGER) AS c24, CAST(first_value(k) OVER w AS DOUBLE) AS f24
  FROM segments WINDOW w AS (PARTITION BY user_id, split ORDER BY ts, event_id ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)) WHERE m > 24 AND position >= 24"""


def windows(t, rows):
    split = O.temporal_split_per_key(t.events(), "user_id", "ts", "event_id", rows=rows).drop("_pos", "_n")
    block = 30 if rows else 100_000
    return O.sliding_sequences(split, ["user_id", "split"], "ts", "event_id", ["k", "value"], "k", block=block, rows=rows)


@both("sliding_sequences", Q.sql(WINDOWS, segments=SEGMENTS))
def _windows(t, rows):
    first = F.transform("sequence", lambda s: s[0])
    total = F.aggregate(first, F.lit(0.0), lambda acc, v: acc + v)
    return windows(t, rows).select(
        "user_id", "split", "event_id", "position", "label", total.alias("sum_k"), F.size("sequence").alias("n_steps"),
        first[0].alias("first_k"),
    )


@query("window_label_stats", Q.sql("SELECT split, count(*) AS n_windows, CAST(sum(label) AS BIGINT) AS label_sum FROM w GROUP BY split", w=WINDOWS, segments=SEGMENTS))
def _window_stats(t):
    return windows(t, None).groupBy("split").agg(F.count(F.lit(1)).alias("n_windows"), F.sum("label").cast("long").alias("label_sum"))


@both(
    "row_positions",
    "SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS position, count(*) OVER (PARTITION BY event_type) AS n FROM events",
)
def _positions(t, rows):
    out = O.with_positions(t.read("events"), ["event_type"], "ts", "event_id", rows)
    return out.select("event_id", F.col("_pos").alias("position"), F.col("_n").alias("n"))


@both(
    "group_median_fill",
    """SELECT o_orderkey, CASE WHEN p IS NOT NULL THEN coalesce(v, median(v) OVER (PARTITION BY p)) END AS price FROM (
       SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS v, nullif(o_orderpriority, '5-LOW') AS p FROM orders)""",
)
def _median_fill(t, rows):
    df = t.read("orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
    )
    return O.group_median_fill(df, "priority", "price", rows).select("o_orderkey", "price")


@query(
    "bool_default_fill",
    Q.sql(f"SELECT event_id, CAST(coalesce({fill('flag')}, 0) AS INTEGER) AS failure, CAST(coalesce(codes, 0) AS INTEGER) AS codes FROM g",
          g="SELECT event_id, CASE WHEN k > 50 THEN CASE WHEN k > 90 THEN 1 ELSE 0 END END AS flag, CASE WHEN k > 30 THEN k END AS codes FROM ev"),
)
def _bool_fill(t):
    k = F.col("k")
    df = t.events().select("event_id", F.when(k > 50, (k > 90).cast("int")).alias("failure"), F.when(k > 30, k).alias("codes"))
    filled = O.fill_forward_back(df, ["failure"], "event_id")
    return filled.select("event_id", F.coalesce("failure", F.lit(0)).alias("failure"), F.coalesce("codes", F.lit(0)).alias("codes"))

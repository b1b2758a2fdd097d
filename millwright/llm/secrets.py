"""Secret scans over an incremental ledger of blobs.

Every version of every file is addressed by the SHA-256 of its content. The ledger holds one
row per (blob, rule version) already scanned, with or without findings; only pairs it does
not hold are scanned, and findings are joined back to every row that has the blob.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.session import scratch_path

# ---- fixed values: the base rules (kind, version, pattern, least length of the last group)
BASE_RULES = [
    ("assign", 1, r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8),
    ("access", 1, r"(AKIA[A-Z0-9]+)", 16),
    ("hex", 1, r"([0-9a-f]{32,})", 32),
]
# ---- a private key: BEGIN, ``Name: value`` lines and base64 up to END; without END, lines of 16
# base64 characters or more and a shorter last one. Line ends may be spelled as \\n.
GAP = r"(?:[\x20\t]|\r?\n|\r|\\[nr])"
HEAD, FOOT = (r"-----%s [A-Z ]{0,40}PRIVATE KEY-----" % word for word in ("BEGIN", "END"))
NAMED = rf"(?:{GAP}++[A-Za-z][A-Za-z0-9-]*+:[^\r\n\\]*+)*+"
WHOLE_KEY = rf"(?:[A-Za-z0-9+/=]|{GAP})*+{FOOT}"
KEY_LINES = rf"(?:{GAP}++[A-Za-z0-9+/=]{{16,}}+)++"
LAST_LINE = r"(?:\r?\n|\r|\\[nr])[\x20\t]*+[A-Za-z0-9+/=]++"
CUT_KEY = rf"{KEY_LINES}(?:{LAST_LINE}(?=[\x20\t]*+(?:[\r\n\\\"']|\Z)))?"
# ---- further rules of this operator; they only add spans
ADDED_RULES = [
    ("private_key", 2, rf"({HEAD}(?:{NAMED}(?:{WHOLE_KEY}|{CUT_KEY}))?)", 1),
    ("bearer", 1, r"(eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})", 1),
    ("repository_token", 1, r"(gh[opsu]_[A-Za-z0-9]{36,})", 1),
]
RULES = BASE_RULES + ADDED_RULES
LEDGER = "blob string, rule string, spans array<struct<low:int,high:int>>"


def rule_name(rule: tuple) -> str:
    return f"{rule[0]}@{rule[1]}"


def find(text: str, pattern: re.Pattern, least: int) -> list[tuple[int, int]]:
    """Leftmost matches that do not overlap, without those whose last group is too short."""
    last = pattern.groups
    return [m.span() for m in pattern.finditer(text) if m.end(last) - m.start(last) >= least]


def _scan(batches: Iterator[pa.RecordBatch], rules: list[tuple]) -> Iterator[pa.RecordBatch]:
    compiled = {rule_name(r): (re.compile(r[2], re.ASCII), r[3]) for r in rules}
    span = pa.struct([("low", pa.int32()), ("high", pa.int32())])
    for batch in batches:
        blobs, names, spans = [], [], []
        for blob, text, todo in zip(*(batch[c].to_pylist() for c in ("blob", "text", "todo"))):
            for name in todo:
                pattern, least = compiled[name]
                blobs.append(blob)
                names.append(name)
                spans.append([{"low": a, "high": b} for a, b in find(text or "", pattern, least)])
        columns = [pa.array(blobs, pa.string()), pa.array(names, pa.string()), pa.array(spans, pa.list_(span))]
        yield pa.RecordBatch.from_arrays(columns, names=["blob", "rule", "spans"])


def addressed(versions: DataFrame, text: str = "text") -> DataFrame:
    """The rows with ``blob``, the SHA-256 of their text (null counts as empty)."""
    return versions.withColumn("blob", F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def scan_unseen(versions: DataFrame, ledger: str, text: str = "text", rules: list[tuple] = RULES) -> DataFrame:
    """Scan the (blob, rule version) pairs the ledger at path ``ledger`` lacks, append them, return the ledger.

    The ledger is created where it does not exist. A blob is scanned once however many rows
    have it. A new version of a rule scans all blobs for that rule alone.
    """
    spark = versions.sparkSession
    spark.createDataFrame([], LEDGER).write.mode("append").parquet(ledger)
    names = F.array(*[F.lit(rule_name(r)) for r in rules])
    known = spark.read.schema(LEDGER).parquet(ledger)
    known = known.groupBy("blob").agg(F.collect_set("rule").alias("seen"))
    blobs = addressed(versions.select(F.col(text).alias("text")))
    unseen = blobs.dropDuplicates(["blob"]).join(known, "blob", "left")
    unseen = unseen.withColumn("todo", F.array_except(names, F.coalesce("seen", F.array().cast("array<string>"))))
    unseen = unseen.where(F.size("todo") > 0).select("blob", "text", "todo")
    unseen.mapInArrow(partial(_scan, rules=rules), LEDGER).write.mode("append").parquet(ledger)
    return spark.read.schema(LEDGER).parquet(ledger)


def findings(versions: DataFrame, ledger: DataFrame, text: str = "text", rules: list[tuple] = RULES) -> DataFrame:
    """``versions`` with ``blob`` and ``spans``: array of (kind, low, high) of the given rule versions.

    Offsets are code points, the end exclusive; spans are ordered by start, then by the order
    of the rules. A text without findings has an empty array. Columns of ``versions`` that
    are named blob or spans are replaced.
    """
    order = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (rule_name(r), i)])
    kinds = F.array(*[F.lit(r[0]) for r in rules])
    found = ledger.where(F.col("rule").isin([rule_name(r) for r in rules]) & (F.size("spans") > 0))
    found = found.withColumn("at", order[F.col("rule")]).select(
        "blob", F.transform("spans", lambda s: F.struct(s["low"].alias("low"), F.col("at").alias("at"), s["high"].alias("high"))).alias("s")
    )
    found = found.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("s"))).alias("s"))
    spans = F.transform("s", lambda s: F.struct(kinds[s["at"]].alias("kind"), s["low"].alias("low"), s["high"].alias("high")))
    found = found.select("blob", spans.alias("spans"))
    none = F.array().cast("array<struct<kind:string,low:int,high:int>>")
    rows = addressed(versions.drop("blob", "spans"), text)
    return rows.join(found, "blob", "left").withColumn("spans", F.coalesce("spans", none))


def scan(versions: DataFrame, text: str = "text", ledger: str | None = None, rules: list[tuple] = RULES) -> DataFrame:
    """Scan what the ledger lacks and give every row its findings; see ``findings``.

    Without a path, a new ledger in the shared folder is used. Null and empty texts hold no
    secrets, repeated rows each get the findings of their blob, an empty table gives none.
    """
    ledger = ledger or scratch_path(versions.sparkSession, "ledger")
    return findings(versions, scan_unseen(versions, ledger, text, rules), text, rules)


def redact(found: DataFrame, text: str = "text", mask: str = "[secret]") -> DataFrame:
    """The rows of ``scan`` with the text inside their spans replaced by ``mask``; overlapping spans get one mask."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(state, s):
        fresh = s["low"] >= state["at"]
        piece = F.substring(F.col(text), state["at"] + 1, s["low"] - state["at"])
        out = F.when(fresh, F.concat(state["out"], piece, F.lit(mask))).otherwise(state["out"])
        return F.struct(out.alias("out"), F.greatest(state["at"], s["high"]).alias("at"))

    def finish(state):
        return F.concat(state["out"], F.substring(F.col(text), state["at"] + 1, F.length(F.col(text))))

    return found.withColumn(text, F.when(F.size("spans") > 0, F.aggregate("spans", start, step, finish)).otherwise(F.col(text)))

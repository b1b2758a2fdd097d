"""Keyed Parquet tables in hash buckets, changed by commits that replace folder lists at once.

A table is a list of folders per bucket. A change writes new folders beside the old ones and
then commits: one small JSON file, renamed into place, names the folders of every table.
Readers see the tables of one commit, whole, or those of the one before; a run that is lost
half-way leaves folders that nothing names, and repeating it changes nothing else. There is
one writer at a time, as of an hourly job.

Rows lie in the bucket of their ``by`` columns (a day, say), so that a load reads and
rewrites the buckets of its days alone. Where these are not the key, an index from the key
to its bucket is kept, in buckets of the key, so that a row is found again when a later load
brings the same key under another day.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwright.operators.merge import merge
from millwright.session import CODEC, materialise

BUCKET, HOME = "_bucket", "_home"


def bucket_of(columns: list[str], buckets: int) -> Column:
    """Bucket of a row; equal values, nulls too, share one whatever their numeric width."""
    return F.pmod(F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in columns]), F.lit(buckets)).cast("int")


@dataclass
class Entry:
    """What a commit says of one table."""

    schema: str
    buckets: dict[str, list[str]] = field(default_factory=dict)


class Store:
    """The tables below one folder of any file system that Spark can write."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        #: Changes that this writer sees already and that the next commit publishes.
        self.staged: dict[str, Entry] = {}

    # ------------------------------------------------------------ commits
    def _fs(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def number(self) -> int:
        """Number of the last commit; 0 before the first."""
        place, fs = self._fs(f"{self.root}/commits/*.json")
        return max((int(str(f.getPath().getName()).split(".")[0]) for f in fs.globStatus(place) or []), default=0)

    def committed(self, number: int | None = None) -> dict[str, Entry]:
        """Tables of a commit, the last unless told."""
        number = self.number() if number is None else number
        if not number:
            return {}
        text = self.spark.read.text(f"{self.root}/commits/{number:08d}.json", wholetext=True).first()[0]
        return {name: Entry(**e) for name, e in json.loads(text).items()}

    def entries(self) -> dict[str, Entry]:
        return {**self.committed(), **self.staged}

    def commit(self) -> int:
        """Everything staged becomes visible together; other tables stay as they are."""
        number = self.number() + 1
        told = {name: vars(e) for name, e in self.entries().items()}
        draft, fs = self._fs(f"{self.root}/commits/_{number:08d}.draft")
        out = fs.create(draft, True)
        out.write(json.dumps(told).encode())
        out.close()
        final, _ = self._fs(f"{self.root}/commits/{number:08d}.json")
        if fs.exists(final) or not fs.rename(draft, final):
            raise RuntimeError(f"commit {number} of {self.root} was made by another writer")
        self.staged = {}
        return number

    # ------------------------------------------------------------ reading
    def __contains__(self, name: str) -> bool:
        return name in self.entries()

    def read(self, name: str, only: set[int] | None = None) -> DataFrame:
        """Rows of a table; of the buckets ``only``, whose folders alone are listed and read."""
        return self._rows(name, self.entries()[name], only)

    def _rows(self, name: str, entry: Entry, only: set[int] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(entry.schema))
        folders = [f"{self.root}/{f}" for b, fs in entry.buckets.items() if only is None or int(b) in only for f in fs]
        if not folders:
            return self.spark.createDataFrame([], schema)
        # The commit's folder name is a partition column too, which nothing selects.
        stored = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
        rows = self.spark.read.option("basePath", f"{self.root}/{name}").schema(stored).parquet(*folders)
        if only is not None:
            rows = rows.where(F.col(BUCKET).isin(sorted(only)))
        return rows.select(schema.names)

    def touched(self, rows: DataFrame, by: list[str]) -> set[int]:
        """Buckets of the rows: at most as many as a table has."""
        return self._distinct(rows, bucket_of(by, self.buckets))

    @staticmethod
    def _distinct(rows: DataFrame, column: Column) -> set[int]:
        return {r[0] for r in rows.select(column.alias("b")).distinct().collect()}

    # ------------------------------------------------------------ writing
    def _write(self, name: str, rows: DataFrame, by: list[str], moved: bool = True) -> dict[str, list[str]]:
        """Write rows into new folders; a bucket with very many rows is written by several tasks.

        Unless they are ``moved``, every task writes its rows where they are, a file for each of its buckets.
        """
        folder = f"{name}/commit={self.number() + 1}-{_fresh()}"
        dealt = rows.withColumn(BUCKET, bucket_of(by, self.buckets))
        if moved:
            dealt = dealt.hint("rebalance", F.col(BUCKET))
        dealt.write.option("compression", CODEC).partitionBy(BUCKET).parquet(f"{self.root}/{folder}")
        names = [f.rsplit("/", 1)[1] for f in self._list(f"{self.root}/{folder}/{BUCKET}=*")]
        return {n.split("=")[1]: [f"{folder}/{n}"] for n in names}

    def replace(self, name: str, rows: DataFrame, by: list[str]) -> None:
        """``rows`` become the whole table."""
        self.staged[name] = Entry(rows.schema.json(), self._write(name, rows, by))

    def append(self, name: str, new: DataFrame, keys: list[str], by: list[str] | None = None) -> DataFrame:
        """Add the rows of ``new`` whose key the table lacks, one per key; returns them as stored.

        Only the key columns of the buckets that ``new`` touches are read. Of rows with one
        key any one is taken; where they differ, reduce them first.
        """
        by = by or keys
        old = self.entries().get(name)
        fresh = new.dropDuplicates(keys)
        if old:
            # The join finds whole rows dealt by key already.
            known = self.read(name, self.touched(new, by)).select(*keys)
            fresh = fresh.join(known, keys, "left_anti").select(*new.columns)
        schema = old.schema if old else new.schema.json()
        # Dealt by key, no task has more rows than another: whole rows are shuffled once a load.
        added = self._write(name, fresh, by, moved=False)
        lists = {b: list(fs) for b, fs in (old.buckets if old else {}).items()}
        for b, folders in added.items():
            lists[b] = lists.get(b, []) + folders
        self.staged[name] = Entry(schema, lists)
        return self._rows(name, Entry(schema, added))

    def upsert(
        self, name: str, new: DataFrame, keys: list[str], update_columns: list[str], by: list[str] | None = None,
        keep_old_when_null: bool = False, combine=None, stored: bool = False,
    ) -> None:
        """Upsert ``new``, reading and rewriting only the buckets it touches.

        ``new`` is written aside first, unless it is ``stored`` already.

        Matched rows take ``update_columns`` from ``new``, and with ``combine(old, new)`` a
        column made of both. Keys must not be null and ``new`` must have each of them once;
        a repeated one is an error.
        """
        by = by or keys
        rows = new if stored else materialise(new, "incoming")
        twice = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect()
        if twice:
            raise ValueError(f"{name}: key {twice[0].asDict()} comes more than once")
        entries = self.entries()
        old, index = entries.get(name), f"{name}_index"
        touched = self.touched(rows, by)
        if old and not touched:
            return
        if index in entries:
            homes = self.read(index, self.touched(rows, keys))
            touched |= self._distinct(homes.join(rows.select(*keys), keys, "left_semi"), F.col(HOME))
        merged = rows
        if old:
            held = self.read(name, touched)
            merged = merge(held, rows.select(*held.columns), keys, update_columns, keep_old_when_null, combine)
        schema = old.schema if old else new.schema.json()
        written = self._write(name, merged, by)
        lists = {b: fs for b, fs in (old.buckets if old else {}).items() if int(b) not in touched}
        self.staged[name] = Entry(schema, lists | written)
        if by != keys:
            # A stored row keeps its first ``by`` values unless they are updated.
            own = self._rows(name, Entry(schema, written)).join(rows.select(*keys), keys, "left_semi").withColumn(HOME, bucket_of(by, self.buckets))
            self.upsert(index, own.select(*keys, HOME), keys, [HOME])

    def compact(self, name: str, by: list[str], most: int = 8) -> int:
        """Join the folders of buckets that have more than ``most``; returns how many buckets."""
        old = self.entries()[name]
        long = {int(b) for b, fs in old.buckets.items() if len(fs) > most}
        if long:
            lists = {b: fs for b, fs in old.buckets.items() if int(b) not in long}
            self.staged[name] = Entry(old.schema, lists | self._write(name, self.read(name, long), by))
        return len(long)

    def sweep(self) -> int:
        """Delete the folders that neither the last commit nor anything staged names; returns how many.

        For use when no reader holds an earlier commit.
        """
        named = {f for e in self.entries().values() for fs in e.buckets.values() for f in fs}
        gone = 0
        for folder in self._list(f"{self.root}/*/commit=*/{BUCKET}=*"):
            place, fs = self._fs(folder)
            if "/".join(folder.split("/")[-3:]) not in named:
                gone += bool(fs.delete(place, True))
        return gone

    def _list(self, pattern: str) -> list[str]:
        place, fs = self._fs(pattern)
        return [str(f.getPath().toString()) for f in fs.globStatus(place) or []]


def _fresh() -> str:
    import uuid

    return uuid.uuid4().hex[:12]

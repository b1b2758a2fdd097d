"""The trie of conversation prefixes, from adaptive radix trees over sorted keys.

A turn is a 16-byte id of its role and text, a conversation the big-endian row of its turn
ids: one key. Keys are dealt in ranges and sorted; a task cuts its range into chunks and
puts each into an adaptive radix tree: nodes keep 4, 16, 48 or 256 children and grow from
one layout to the next, and a path without branches is one node. The tree branches at any
byte; only the depths that end a turn are nodes of the trie.

The members of a trie node are neighbours among the sorted keys. So a node that is a prefix
of neither the first nor the last key of its chunk is complete there, with all below it, and
is written with its final figures. The prefixes of these two keys are open: their parts are
added up over all chunks. What lies below an open node is the sum of complete nodes, which
the parts carry, and of open ones: each open node is charged to one of the keys it is a
prefix of, and sums from the end of every such key give each of its prefixes its share.
A hot prefix, and a conversation repeated any number of times, is thus cut by chunks.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millwright.session import materialise

#: Bytes of a turn id.
ID = 16
#: Keys and bytes of keys in one tree; a longer key has one to itself.
CHUNK_KEYS, CHUNK_BYTES = 20_000, 4 << 20
NO_ENDS = hashlib.sha256(b"").hexdigest()


# ------------------------------------------------------------------ adaptive radix tree
class Sorted:
    """Up to 4, then 16 children beside their ascending bytes."""

    def __init__(self):
        self.bytes, self.nodes, self.room = bytearray(), [], 4

    def get(self, byte: int):
        at = self.bytes.find(byte)
        return None if at < 0 else self.nodes[at]

    def add(self, byte: int, node):
        if len(self.nodes) == self.room:
            if self.room == 16:
                return Indexed(self).add(byte, node)
            self.room = 16
        at = bisect_left(self.bytes, byte)
        self.bytes.insert(at, byte)
        self.nodes.insert(at, node)
        return self


class Indexed:
    """Up to 48 children, found by a table from byte to place."""

    def __init__(self, less: Sorted):
        self.place, self.nodes = bytearray(256), list(less.nodes)
        for at, byte in enumerate(less.bytes, 1):
            self.place[byte] = at

    def get(self, byte: int):
        at = self.place[byte]
        return self.nodes[at - 1] if at else None

    def add(self, byte: int, node):
        if len(self.nodes) == 48:
            return Direct(self).add(byte, node)
        self.nodes.append(node)
        self.place[byte] = len(self.nodes)
        return self


class Direct:
    """Up to 256 children, each at its byte."""

    def __init__(self, less: Indexed):
        self.slots = [less.get(byte) for byte in range(256)]

    @property
    def nodes(self):
        return [x for x in self.slots if x is not None]

    def get(self, byte: int):
        return self.slots[byte]

    def add(self, byte: int, node):
        self.slots[byte] = node
        return self


@dataclass(slots=True)
class Node:
    """Bytes ``start`` to ``end`` of the key ``rep``; ``ends`` is the range of rows whose key ends here."""

    rep: int
    start: int
    end: int
    ends: range = range(0)
    kids: Sorted | Indexed | Direct = field(default_factory=Sorted)
    #: Bit 1: on the path of the chunk's first key; bit 2: of its last.
    open: int = 0
    # Figures of what lies at or below the first byte of this node, filled bottom-up.
    n: int = 0
    low: int | None = None
    tops: int = 0
    leaves: int = 0
    saved: int = 0
    waiting: list = field(default_factory=list)


def common(a: bytes, b: bytes) -> int:
    """Equal leading bytes of two byte strings of one length that differ."""
    return len(a) - ((int.from_bytes(a) ^ int.from_bytes(b)).bit_length() + 7) // 8


def insert(root: Node, keys: list[bytes], rows: range) -> None:
    """Add the key of ``rows``, which hold it all."""
    key, node = keys[rows[0]], root
    while True:
        mine, theirs = key[node.start : node.end], keys[node.rep][node.start : node.end]
        if mine != theirs:
            cut = node.start + common(mine.ljust(len(theirs), b"\0") if len(mine) < len(theirs) else mine, theirs)
            cut = min(cut, len(key))
            lower = Node(node.rep, cut, node.end, node.ends, node.kids)
            node.end, node.ends, node.kids = cut, range(0), Sorted().add(keys[node.rep][cut], lower)
        if len(key) == node.end:
            node.ends = rows
            return
        kid = node.kids.get(key[node.end])
        if kid is None:
            node.kids = node.kids.add(key[node.end], Node(rows[0], node.end, len(key), rows))
            return
        node = kid


def build(keys: list[bytes]) -> Node:
    """The tree of ascending keys; equal keys are one entry. The paths of the first and last key are marked."""
    root, low = Node(0, 0, 0), 0
    while low < len(keys):
        high = low + 1
        while high < len(keys) and keys[high] == keys[low]:
            high += 1
        insert(root, keys, range(low, high))
        low = high
    for side, key in ((1, keys[0]), (2, keys[-1])):
        node = root
        while True:
            node.open |= side
            if len(key) == node.end:
                break
            node = node.kids.get(key[node.end])
    return root


# ------------------------------------------------------------------ nodes of the trie
_PART = pa.schema([
    ("kind", pa.int32()), ("hash", pa.string()), ("parent", pa.string()), ("path", pa.string()), ("depth", pa.int64()), ("low", pa.int64()),
    ("parent_conv", pa.int64()), ("n", pa.int64()), ("children", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()), ("size", pa.int64()),
    ("text", pa.string()),
])
PART = (
    "kind int, hash string, parent string, path string, depth long, low long, parent_conv long, n long, children long, leaves long, "
    "saved long, size long, text string"
)
COMPLETE, OPEN, ENDS = 0, 1, 2


def prefix_hashes(key: bytes) -> list[str]:
    """A hash of every prefix of whole turns, from the empty one on."""
    so_far, out = hashlib.md5(), []
    for at in range(0, len(key) + 1, ID):
        out.append(so_far.hexdigest())
        so_far.update(key[at : at + ID])
    return out


def trie_rows(keys: list[bytes], convs: list[int], sizes: list[list[int]], name: str) -> list[list]:
    """Rows of ``PART`` for one chunk of ascending (key, conversation); ``name`` tells the chunk from others."""
    root = build(keys)
    hashes = {1: prefix_hashes(keys[0]), 2: prefix_hashes(keys[-1])}
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += node.kids.nodes
    rows: list[list] = []
    for node in reversed(order):
        kids = node.kids.nodes
        node.n = len(node.ends) + sum(k.n for k in kids)
        node.low = min([*(k.low for k in kids), *(convs[r] for r in node.ends[:1])])
        node.tops, node.leaves, node.saved = (sum(getattr(k, c) for k in kids) for c in ("tops", "leaves", "saved"))
        waiting = max((k.waiting for k in kids), key=len, default=[])
        for k in kids:
            if k.waiting is not waiting:
                waiting += k.waiting
            k.waiting = []
        depths = range(node.end // ID, node.start // ID, -1) if node is not root else (0,)
        for depth in depths:
            size = sizes[node.rep][depth - 1] if depth else 0
            ended = ",".join(str(convs[r]) for r in node.ends) if depth * ID == node.end else ""
            if node.open:
                for side in (1, 2):
                    if node.open & side:
                        own = hashes[side][depth]
                        up = hashes[side][depth - 1] if depth else None
                        # A prefix of both keys gives its part once, and lies on both paths.
                        first = side == 1 or node.open == 2
                        part = [node.low, None, node.n, node.tops, node.leaves, node.saved] if first else [None, None, 0, 0, 0, 0]
                        rows.append([OPEN, own, up, f"{name}:{side}", depth, *part, size, None])
                if ended:
                    rows.append([ENDS, own, None, None, depth, convs[node.ends[0]], *[None] * 6, ended])
                for row in waiting:
                    row[2] = own
                waiting, node.tops = [], 0
            else:
                node.saved += (node.n - 1) * size
                node.leaves = node.leaves or 1
                told = hashlib.sha256(ended.encode()).hexdigest() if ended else NO_ENDS
                rows.append([COMPLETE, None, None, None, depth, node.low, None, node.n, node.tops, node.leaves, node.saved, size, told])
                for row in waiting:
                    row[6] = node.low
                waiting, node.tops = [rows[-1]], 1
        node.waiting = waiting
    return rows


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    weight, number = 0, 0

    def flush():
        nonlocal held, weight, number
        rows = trie_rows(*map(list, zip(*held)), f"{part}.{number}")
        held, weight, number = [], 0, number + 1
        for low in range(0, len(rows), 50_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows[low : low + 50_000]), _PART.types)], schema=_PART
            )

    for batch in batches:
        part = batch["part"][0].as_py() if batch.num_rows else None
        for key, conv, size in zip(batch["key"].to_pylist(), batch["conv_id"].to_pylist(), batch["sizes"].to_pylist()):
            if held and (len(held) == CHUNK_KEYS or weight + len(key) > CHUNK_BYTES):
                yield from flush()
            held.append((key, conv, size))
            weight += len(key)
    if held:
        yield from flush()


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces arrive by node and first conversation; one running hash is held."""
    now, running = None, None

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=["hash", "ends"])

    for batch in batches:
        done = []
        for key, text in zip(batch["hash"].to_pylist(), batch["text"].to_pylist()):
            if key != now:
                if running:
                    done.append((now, running.hexdigest()))
                now, running = key, hashlib.sha256(text.encode())
            else:
                running.update(f",{text}".encode())
        if done:
            yield out(done)
    if running:
        yield out([(now, running.hexdigest())])


# ------------------------------------------------------------------ operators
def sequences(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: conv_id, key (16 bytes a turn), sizes (UTF-8 bytes of each text).

    Turns are ordered by ``turn``, null first, ties by their ids; repeated rows are turns of
    their own. Null roles and texts count as empty. Rows without a conversation id belong to
    no conversation. Texts do not travel: a conversation is 20 bytes for each of its turns.
    """
    name, said = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    told = F.md5(F.concat(F.length(name).cast("string"), F.lit(":"), name, said).cast("binary"))
    row = F.struct(F.col(turn).alias("turn"), told.alias("id"), F.octet_length(said).alias("size"))
    table = turns.where(F.col(conv).isNotNull()).select(F.col(conv).cast("long").alias("conv_id"), row.alias("row"))
    whole = table.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    key = F.unhex(F.array_join(F.col("rows.id"), ""))
    return whole.select("conv_id", key.alias("key"), F.col("rows.size").alias("sizes"))


def share_heads(seqs: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """Sequences whose first turns are those of the first conversation of their group.

    Conversation c takes the first h = crc32(decimal c) mod ``most`` turns of conversation
    c - c mod ``group`` (all it has, if fewer; none if it is absent) and goes on with its own
    turns after its first h.
    """
    c = F.col("conv_id")
    seqs = materialise(seqs, "sequences")
    own = seqs.withColumn("_h", (F.crc32(c.cast("string").cast("binary")) % most).cast("int")).withColumn("_base", c - c % group)
    heads = seqs.where(c % group == 0).select(
        c.alias("_base"), F.substring("key", 1, ID * (most - 1)).alias("_key"), F.slice("sizes", 1, most - 1).alias("_sizes")
    )
    both = own.join(heads, "_base", "left")
    key = F.concat(
        F.coalesce(F.expr(f"substring(_key, 1, {ID} * _h)"), F.lit(b"")), F.expr(f"substring(key, {ID} * _h + 1, octet_length(key))")
    )
    sizes = F.concat(
        F.coalesce(F.slice("_sizes", F.lit(1), F.col("_h")), F.array().cast("array<int>")),
        F.slice("sizes", F.col("_h") + 1, F.size("sizes")),
    )
    return both.select("conv_id", key.alias("key"), sizes.alias("sizes"))


def prefix_trie(seqs: DataFrame) -> DataFrame:
    """One row per distinct prefix of whole turns, the empty one included.

    ``seqs`` has conv_id (unique), key and sizes as ``sequences`` gives them; conversations
    without turns count as members of the root. conv_id is the smallest member, depth the
    number of turns, parent_conv_id the smallest member of the prefix one turn shorter (null
    for the root), n_convs the members, n_children the prefixes one turn longer, n_leaves
    the childless nodes of the subtree, saved_tokens the sum over the subtree of (n_convs -
    1) times the bytes of the node's last text, and ends_sha256 hashes the ids of the
    conversations that are this prefix, in ascending order and joined by commas. An empty
    table has no root. Prefixes of open paths are told apart by 128-bit hashes, as turns are.
    """
    dealt = seqs.select("conv_id", "key", "sizes").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    parts = dealt.withColumn("part", F.spark_partition_id()).mapInArrow(_parts, PART)
    parts = materialise(parts, "trie")

    on_path = parts.where(F.col("kind") == OPEN)
    sums = [F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")]
    nodes = on_path.groupBy("hash").agg(
        *sums, F.min("low").alias("low"), F.max("depth").alias("depth"), F.max("parent").alias("parent"), F.max("size").alias("size"),
        F.min("path").alias("home"),
    )
    nodes = materialise(nodes, "open")
    open_kids = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("hash")).agg(F.count(F.lit(1)).alias("open_kids"))
    nodes = nodes.join(open_kids, "hash", "left").withColumn("children", F.col("children") + F.coalesce("open_kids", F.lit(0)))
    own = [((F.col("n") - 1) * F.col("size")).alias("own_saved"), F.when(F.col("children") == 0, 1).otherwise(0).cast("long").alias("own_leaf")]
    nodes = materialise(nodes.select("*", *own), "open_nodes")

    charged = on_path.select("hash", "path", "depth").join(nodes.select("hash", "home", "own_saved", "own_leaf"), "hash")
    at_home = F.col("path") == F.col("home")
    below = Window.partitionBy("path").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    charged = charged.select("hash", *[F.sum(F.when(at_home, F.col(c)).otherwise(0)).over(below).alias(c) for c in ("own_saved", "own_leaf")])
    under = charged.groupBy("hash").agg(F.sum("own_saved").alias("open_saved"), F.sum("own_leaf").alias("open_leaves"))

    pieces = parts.where(F.col("kind") == ENDS).select("hash", "low", "text")
    ends = pieces.repartition("hash").sortWithinPartitions("hash", "low").mapInArrow(_hash_ends, "hash string, ends string")

    up = nodes.select(F.col("hash").alias("parent"), F.col("low").alias("up"))
    opened = nodes.join(under, "hash").join(ends, "hash", "left").join(up, "parent", "left").select(
        F.col("low").alias("conv_id"), "depth", F.col("up").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
        (F.col("leaves") + F.col("open_leaves")).alias("n_leaves"), (F.col("saved") + F.col("open_saved")).alias("saved_tokens"),
        F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
    complete = parts.where(F.col("kind") == COMPLETE)
    fields = [F.col("n").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
              F.col("saved").alias("saved_tokens"), F.col("text").alias("ends_sha256")]
    inner = complete.where("parent IS NULL").select(F.col("low").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), *fields)
    outer = complete.where("parent IS NOT NULL").join(up, "parent").select(
        F.col("low").alias("conv_id"), "depth", F.col("up").alias("parent_conv_id"), *fields
    )
    return inner.unionByName(outer).unionByName(opened)

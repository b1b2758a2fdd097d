"""Conversations as token sequences with a loss mask.

A turn is assembled from separately encoded segments: the id of its head, the tokens of its
text, the id of its end. The ids of heads and ends are reserved: they lie beyond the
vocabulary, so no text can be encoded to them. The mask is a prefix sum over the slice's
tokens, one up where the text of a trained role begins and one down where it ends; places
within a conversation are prefix sums over its turns.

The rendered text of a sequence spells reserved ids as control strings. Inside texts a
backslash follows every backslash and every character at which a control string begins, so
that none occurs there; dropping single backslashes and halving double ones undoes it.

Rows are dealt in ranges of (conversation, turn), so that a conversation of any length may
lie in several tasks; the sums of its earlier ranges, one row for each range that begins
inside a conversation, are added afterwards.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millwright.llm.text import sliced
from millwright.session import materialise

# ------------------------------------------------------------------ template
HEADS = {"system": "### System:", "user": "### User:", "assistant": "### Assistant:"}
#: Head of any other role, whose name follows as a segment of its own up to ``NAMED``.
OTHER, NAMED, END = "### Other:", "<text>", "</turn>"
#: No control string is part of another or overlaps itself; the last is the vocabulary's own.
CONTROLS = [*HEADS.values(), OTHER, NAMED, END, "<|endoftext|>"]
#: Characters of a segment that are encoded at once.
PIECE = 1 << 16

_ESCAPE = re.compile(r"\\|(?=" + "|".join(map(re.escape, CONTROLS)) + ").", re.DOTALL)
_UNESCAPE = re.compile(r"\\(\\?)")


def escape(text: str) -> str:
    """``text`` without any control string in it; ``unescape`` gives it back."""
    return _ESCAPE.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text) if "\\" in text else text


class Template:
    """Ids of texts and of control strings, and the way back."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        #: First reserved id; ids from here on are control strings.
        self.reserved = self.tokenizer.get_vocab_size()
        self.ids = {s: self.reserved + i for i, s in enumerate(CONTROLS)}

    def encode(self, segments: list[str]) -> list[list[int]]:
        """Ids of every segment; long ones are encoded in pieces."""
        pieces = [s[k : k + PIECE] for s in segments for k in range(0, len(s), PIECE)]
        codes = iter(self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False))
        return [[x for _ in range(0, len(s), PIECE) for x in next(codes).ids] for s in segments]

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.tokenizer.decode_batch(ids, skip_special_tokens=False)


@cache
def template_at(path: str) -> Template:
    return Template(path)


# ------------------------------------------------------------------ assembly
_TURN = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("turn_no", pa.int64()), ("token_start", pa.int64()), ("char_start", pa.int64()),
    ("chars", pa.int64()), ("ids", pa.list_(pa.int32())), ("loss", pa.list_(pa.bool_())),
])
TURN = "conv_id long, part int, turn_no long, token_start long, char_start long, chars long, ids array<int>, loss array<boolean>"


def _assemble(batches: Iterator[pa.RecordBatch], path: str, trained: str) -> Iterator[pa.RecordBatch]:
    """One row per turn; its places count from where its conversation begins in this range."""
    t = template_at(path)
    conv, place = None, np.zeros(3, dtype=np.int64)
    opened = False
    for batch in sliced(batches, "text"):
        roles, texts = batch["role"].to_pylist(), [escape(x) for x in batch["text"].to_pylist()]
        named = [i for i, r in enumerate(roles) if r not in HEADS]
        names = dict(zip(named, [escape(roles[i]) for i in named]))
        codes = t.encode(texts + list(names.values()))
        name_codes = dict(zip(named, codes[len(texts) :]))
        rows, chars, bodies = [], [], []
        for i, (role, text) in enumerate(zip(roles, texts)):
            head = [t.ids[HEADS[role]]] if i not in names else [t.ids[OTHER], *name_codes[i], t.ids[NAMED]]
            rows.append([*head, *codes[i], t.ids[END]])
            bodies.append((len(head), len(codes[i]), role == trained))
            told = len(HEADS[role]) if i not in names else len(OTHER) + len(names[i]) + len(NAMED)
            chars.append(told + len(text) + len(END))
        sizes = np.array([len(x) for x in rows], dtype=np.int64)
        start = np.cumsum(sizes) - sizes
        head, body, counts = np.array(bodies, dtype=np.int64).T
        step = np.zeros(int(sizes.sum()) + 1, dtype=np.int32)
        np.add.at(step, start + head, counts)
        np.add.at(step, start + head + body, -counts)
        loss = np.cumsum(step[:-1]) > 0
        places = np.empty((len(rows), 3), dtype=np.int64)
        for i, (c, size, n) in enumerate(zip(batch["conv_id"].to_pylist(), sizes.tolist(), chars)):
            if not opened or c != conv:
                conv, place, opened = c, np.zeros(3, dtype=np.int64), True
            places[i] = place
            place = place + (1, size, n)
        cuts = pa.array(np.append(start, sizes.sum()), pa.int32())
        flat = pa.array(np.concatenate([np.array(x, dtype=np.int32) for x in rows]))
        columns = [
            batch["conv_id"], batch["part"], *(pa.array(places[:, k]) for k in range(3)), pa.array(chars, pa.int64()),
            pa.ListArray.from_arrays(cuts, flat), pa.ListArray.from_arrays(cuts, pa.array(loss)),
        ]
        yield pa.RecordBatch.from_arrays(columns, schema=_TURN)


def format_conversations(
    turns: DataFrame, path: str, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", trained: str = "assistant"
) -> DataFrame:
    """One row per turn: conv_id, turn_no, token_start, char_start, chars, ids, loss.

    ``ids`` are the tokens of the turn with its control ids, ``loss`` marks those of the text
    of the role ``trained``. ``turn_no``, ``token_start`` and ``char_start`` are the turn's
    places in its conversation, from 0; in their order the turns make up its sequence.

    Turns are ordered by ``turn`` (null first), ties by role, then text; repeated rows are
    turns of their own. Null roles and texts count as empty, a null conversation id is a
    conversation like any other. Texts of any length are encoded whole, in pieces. Other
    columns are not read; an empty table gives an empty one. The tokenizer file at ``path``
    (byte-level, so every text comes back) must be there on all executors.
    """
    filled = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((role, "role"), (text, "text"))]
    table = turns.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"), *filled)
    # The leading characters keep the order of the whole ones, and bound what Spark samples.
    dealt = table.repartitionByRange("conv_id", "turn", F.substring("role", 1, 40), F.substring("text", 1, 40))
    dealt = dealt.sortWithinPartitions("conv_id", "turn", "role", "text").withColumn("part", F.spark_partition_id())
    local = dealt.select("conv_id", "part", "role", "text").mapInArrow(partial(_assemble, path=path, trained=trained), TURN)
    local = materialise(local, "turns")

    sums = local.groupBy("conv_id", "part").agg(
        F.count(F.lit(1)).alias("turns"), F.sum(F.size("ids")).alias("tokens"), F.sum("chars").alias("text")
    )
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = sums.select(
        F.col("conv_id").alias("c"), F.col("part").alias("p"), *[F.sum(n).over(before).alias(n) for n in ("turns", "tokens", "text")]
    ).where("turns IS NOT NULL")
    # At most one conversation of a range began in an earlier one: as many rows as ranges.
    both = local.join(F.broadcast(earlier), F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")), "left")
    moved = [(F.col(a) + F.coalesce(b, F.lit(0))).alias(a) for a, b in (("turn_no", "turns"), ("token_start", "tokens"), ("char_start", "text"))]
    return both.select("conv_id", *moved, "chars", "ids", "loss")


# ------------------------------------------------------------------ the way back
READ = "conv_id long, turn_no long, role string, text string, loss_text string, chars long"


def _read(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    t = template_at(path)
    heads = {t.ids[s]: r for r, s in HEADS.items()}
    spelled = {i: len(s) for s, i in t.ids.items()}
    for whole in batches:
        for low in range(0, whole.num_rows, 256):
            batch = whole.slice(low, 256)
            segments, reserved, losses = [], [], []
            for ids, loss in zip(batch["ids"], batch["loss"]):
                ids, loss = ids.values.to_numpy(), loss.values.to_numpy(zero_copy_only=False)
                at = np.flatnonzero(ids >= t.reserved)
                reserved.append(ids[at].tolist())
                segments.append([x.tolist() for x in np.split(ids, at)])
                losses.append(ids[loss].tolist())
            # A segment begins with the reserved id before it; the first is empty.
            texts = iter(t.decode([s[1:] for row in segments for s in row[1:]]))
            rows = []
            for marks, lost in zip(reserved, t.decode(losses)):
                told = [next(texts) for _ in marks]
                role = heads[marks[0]] if marks[0] in heads else unescape(told[0])
                length = sum(map(len, told)) + sum(spelled[m] for m in marks)
                rows.append((role, unescape(told[-2]), unescape(lost), length))
            columns = list(zip(*rows)) or [()] * 4
            kinds = (pa.string(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch["conv_id"], batch["turn_no"], *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=["conv_id", "turn_no", "role", "text", "loss_text", "chars"],
            )


def read_back(formatted: DataFrame, path: str) -> DataFrame:
    """(conv_id, turn_no, role, text, loss_text, chars) read from ids and masks alone.

    ``loss_text`` is the text under the mask, ``chars`` the length of the rendered turn.
    An empty table gives an empty one.
    """
    return formatted.select("conv_id", "turn_no", "ids", "loss").mapInArrow(partial(_read, path=path), READ)


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive by conversation and turn; only running hashes are held."""
    fields = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    now = None

    def close(state):
        conv, n, turns, lost, loss, chars = state
        return conv, n, turns.hexdigest(), lost, loss.hexdigest(), chars

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=fields)

    for batch in batches:
        done = []
        for conv, role, text, lost, chars in zip(*(batch[c].to_pylist() for c in ("conv_id", "role", "text", "loss_text", "chars"))):
            if now is None or conv != now[0]:
                if now is not None:
                    done.append(close(now))
                now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            now[1] += 1
            now[2].update(f"{role}\n{text}\n".encode())
            now[3] += len(lost)
            now[4].update(lost.encode())
            now[5] += chars
        if done:
            yield out(done)
    if now is not None:
        yield out([close(now)])


def digests(read: DataFrame) -> DataFrame:
    """Per conversation of ``read_back``: its number of turns and the hashes and lengths of its texts.

    A hash has to be fed in order, so the rows of one conversation stream through one task,
    which holds its state alone.
    """
    return read.repartition("conv_id").sortWithinPartitions("conv_id", "turn_no").mapInArrow(_digest, DIGEST)

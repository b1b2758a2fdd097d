"""Language identification: script ranges narrow candidates, Viterbi labels the words.

A word is a maximal run of letters. Its score for a language is the sum of smoothed log
probabilities of its letter trigrams (hashed, case folded, blanks at the ends); languages
that do not use the script of the word are out. A Viterbi pass with a penalty for switching
gives every word of a text its language, so mixed texts come out as spans.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.llm.text import mix, sliced

BUCKET_BITS = 15
SMOOTHING = 0.5
SWITCH = 10.0
#: A language uses a script that holds at least this share of its letters.
SCRIPT_SHARE = 0.01
UNKNOWN = "und"
#: Bytes of text whose chains are run together.
CHAIN_BYTES = 1 << 20

# ---- fixed values: first and last code point of the blocks of each script
SCRIPT_RANGES = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF)],
}
SCRIPTS = ["other", *SCRIPT_RANGES]


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the first 65536 code points: is it a letter, its lower case, its script."""
    letter = np.fromiter((chr(c).isalpha() for c in range(65536)), dtype=bool, count=65536)
    lower = np.arange(65536, dtype=np.uint32)
    for c in np.flatnonzero(letter):
        small = chr(c).lower()
        if len(small) == 1:
            lower[c] = ord(small)
    script = np.zeros(65536, dtype=np.uint8)
    for k, ranges in enumerate(SCRIPT_RANGES.values(), 1):
        for low, high in ranges:
            script[low : high + 1] = k
    return letter, lower, script


LETTER, LOWER, SCRIPT = _tables()


def held_out(id: Column) -> Column:
    """Rows whose crc32 of the id as text has remainder 2 modulo 4 are never learnt from; null ids are not held out."""
    return F.coalesce(F.pmod(F.crc32(id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


@dataclass
class Letters:
    """Words of one slice: row, first and last code point + 1 in their text, script, letter trigrams."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    script: np.ndarray
    #: Hashed trigram of each letter, and where each word's letters begin.
    keys: np.ndarray
    first: np.ndarray


def letters_of(texts: list[str | None]) -> Letters:
    joined = "\n".join(["", *(t or "" for t in texts), ""])
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    low = np.minimum(code, 65535)
    letter = LETTER[low]
    letter[code == 65535] = False
    for c in np.unique(code[code > 65535]):
        letter[code == c] = chr(c).isalpha()
    folded = np.where(letter, np.where(code > 65535, code, LOWER[low]), 0).astype(np.uint64)
    at = np.flatnonzero(letter)
    tri = (folded[at - 1] << np.uint64(42)) ^ (folded[at] << np.uint64(21)) ^ folded[at + 1]
    keys = (mix(tri) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
    fresh = np.ones(len(at), dtype=bool)
    fresh[1:] = np.diff(at) > 1
    first = np.flatnonzero(fresh)
    begins = np.cumsum([1, *(len(t or "") + 1 for t in texts)])
    start = at[first]
    end = at[np.append(first[1:], len(at)) - 1] + 1 if len(at) else start
    row = np.searchsorted(begins, start, side="right") - 1
    script = np.where(code[start] > 65535, SCRIPTS.index("han"), SCRIPT[low[start]])
    return Letters(row, start - begins[row], end - begins[row], script, keys, first)


# ------------------------------------------------------------------ model
@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray
    #: [script, language]: may the language have words of the script?
    uses: np.ndarray


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, bucket, n) of a task; buckets below 0 count the letters of a script."""
    size = 1 << BUCKET_BITS
    counts: dict[str, np.ndarray] = {}
    for batch in sliced(batches, "text", CHAIN_BYTES):
        w = letters_of(batch["text"].to_pylist())
        if not len(w.row):
            continue
        langs = batch["lang"].to_pylist()
        names = sorted(set(langs))
        code = np.array([names.index(x) for x in langs])
        of_word = code[w.row]
        length = w.end - w.start
        of_letter = np.repeat(of_word, np.diff(np.append(w.first, len(w.keys))))
        for k, name in enumerate(names):
            n = counts.setdefault(name, np.zeros(size + len(SCRIPTS), dtype=np.int64))
            n[:size] += np.bincount(w.keys[of_letter == k], minlength=size)
            n[size:] += np.bincount(w.script[of_word == k], weights=length[of_word == k], minlength=len(SCRIPTS)).astype(np.int64)
    for name, n in counts.items():
        some = np.flatnonzero(n)
        columns = [pa.array([name] * len(some), pa.string()), pa.array(np.where(some < size, some, size - 1 - some)), pa.array(n[some])]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "bucket", "n"])


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Trigram counts over all rows of ``docs`` with a language; the model has 2^BUCKET_BITS rows per language."""
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("lang IS NOT NULL AND text IS NOT NULL")
    counts = rows.mapInArrow(_count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = counts.toPandas()
    languages = sorted(table["lang"].unique())
    size = 1 << BUCKET_BITS
    grams = np.full((size, len(languages)), SMOOTHING)
    letters = np.zeros((len(SCRIPTS), len(languages)))
    which = table["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(dtype=np.int64)
    bucket, n = table["bucket"].to_numpy(), table["n"].to_numpy()
    here = bucket >= 0
    grams[bucket[here], which[here]] += n[here]
    letters[-1 - bucket[~here], which[~here]] += n[~here]
    scores = np.log(grams / grams.sum(axis=0)).astype(np.float32)
    uses = letters >= SCRIPT_SHARE * np.maximum(letters.sum(axis=0), 1)
    uses[~uses.any(axis=1)] = True
    return Model(languages, scores, uses)


def viterbi(score: np.ndarray, first: np.ndarray, switch: float) -> np.ndarray:
    """The best label of every word; words first[i] .. first[i + 1] - 1 are one text.

    Texts are run together, longest first, so that a step handles all texts still open.
    """
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    start, length = first[:-1][order], length[order]
    steps = int(length[0]) if len(length) else 0
    states = score.shape[1]
    open_at = np.searchsorted(-length, -np.arange(steps), side="left")
    back = np.empty(score.shape, dtype=np.uint8 if states < 256 else np.uint16)
    own = np.arange(states, dtype=back.dtype)
    value = np.zeros((len(length), states))
    for t in range(steps):
        k = open_at[t]
        here = value[:k]
        best = here.argmax(axis=1)
        moved = here[np.arange(k), best] - switch
        stay = here >= moved[:, None]
        at = start[:k] + t
        back[at] = np.where(stay, own, best[:, None])
        value[:k] = np.where(stay, here, moved[:, None]) + score[at]
    label = np.zeros(len(score), dtype=np.int64)
    state = value.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        k = open_at[t]
        at = start[:k] + t
        label[at] = state[:k]
        state[:k] = back[at, state[:k]]
    return label


SPAN = pa.struct([("low", pa.int32()), ("high", pa.int32()), ("lang", pa.string())])


def _label(batches: Iterator[pa.RecordBatch], model: Model, switch: float, kept: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, "_text", CHAIN_BYTES):
        n, many = batch.num_rows, len(model.languages)
        w = letters_of(batch["_text"].to_pylist())
        share = np.zeros((n, max(many, 1)))
        spans: list[list] = [[] for _ in range(n)]
        if len(w.row) and many:
            score = np.add.reduceat(model.scores[w.keys], w.first, axis=0)
            score -= np.where(model.uses[w.script], 0, 1e6).astype(np.float32)
            label = viterbi(score, np.searchsorted(w.row, np.arange(n + 1)), switch)
            share = np.bincount(w.row * many + label, weights=w.end - w.start, minlength=n * many).reshape(n, many)
            fresh = np.ones(len(label), dtype=bool)
            fresh[1:] = (label[1:] != label[:-1]) | (w.row[1:] != w.row[:-1])
            opens = np.flatnonzero(fresh)
            closes = np.append(opens[1:], len(label)) - 1
            for a, z in zip(opens, closes):
                spans[w.row[a]].append((int(w.start[a]), int(w.end[z]), model.languages[label[a]]))
        total = share.sum(axis=1)
        best = share.argmax(axis=1)
        found = [model.languages[b] if t else UNKNOWN for b, t in zip(best, total)]
        part = np.divide(share.max(axis=1), total, out=np.zeros(n), where=total > 0)
        made = [pa.array(found, pa.string()), pa.array(part), pa.array(spans, pa.list_(SPAN))]
        yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), *made], names=[*kept, "lang_pred", "score", "lang_spans"])


def identify(docs: DataFrame, model: Model, text: str = "text", switch: float = SWITCH) -> DataFrame:
    """``docs`` with lang_pred, score and lang_spans.

    lang_pred is the language of most letters, score its share of them, lang_spans the
    (first code point, end, language) runs of words. Null texts and texts without a letter
    get ``und``, 0 and no span, as does everything when the model knows no language. Ties go
    to the first language by name. Columns of ``docs`` with these names are replaced.
    """
    docs = docs.drop("lang_pred", "score", "lang_spans")
    kept = docs.columns
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    schema = f"{kinds + ', ' if kinds else ''}lang_pred string, score double, lang_spans array<struct<low:int,high:int,lang:string>>"
    rows = docs.withColumn("_text", F.col(text))
    return rows.mapInArrow(partial(_label, model=model, switch=switch, kept=kept), schema)


def learn_and_identify(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``identify`` with a model learnt from the rows that are not held out."""
    return identify(docs, learn(docs.where(~held_out(F.col(id))), text, lang), text)

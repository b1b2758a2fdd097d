"""Many rows that agree in their keys, private keys beside the SQL, and the whole pipeline beside a plain one."""

import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millwright.llm import language, mixing, oracle, queries, secrets, substrings

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, x, "en", s, 0) for i, x, s in rows], DOCS)


def test_copies_are_searched_once(spark, monkeypatch):
    """10,000 copies under null and repeated ids: the listed places grow with the rows, not with their square."""
    text = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"o{i}" for i in range(20)) + " " + " ".join(f"w{i}" for i in range(5, 45))
    rows = [(None, text, "a")] * 5000 + [(7, text, "a")] * 5000 + [(None, "short text", "a")] * 50 + [(1, other, "a"), (None, None, "a"), (None, None, "a")]
    seen = Counter()
    store = substrings.materialise
    monkeypatch.setattr(substrings, "materialise", lambda df, name: (lambda out: seen.update({name: out.count()}) or out)(store(df, name)))
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in substrings.drop_repeats(frame(spark, rows).repartition(8)).collect())
    kept = " ".join(other.split()[:20])
    assert got == {(None, 60, 60, ""): 5000, (7, 60, 60, ""): 5000, (None, 2, 0, "short text"): 50, (1, 60, 40, kept): 1, (None, 0, 0, ""): 2}
    assert seen["superkmers"] < 100


def test_rows_without_id_are_dealt_by_text(spark):
    random.seed(3)
    rows = [(None, " ".join(random.choices("abcdefgh", k=random.randint(1, 9))), "s") for _ in range(4000)] + [(i, "a b c", "t") for i in range(50)]
    sized = frame(spark, rows).select(
        "doc_id", "source", mixing.words_in(F.col("text")).alias("size"), F.xxhash64("text").alias("row"),
        F.when(F.col("doc_id").isNull(), F.md5("text")).alias("digest"),
    )
    stream = [(r.source, r.begin, r.size) for r in mixing._stream(sized).collect()]
    for source in "st":
        upto = 0
        for _, begin, size in sorted(x for x in stream if x[0] == source):
            assert begin == upto
            upto += size
    mark = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.col("digest")))
    largest = sized.groupBy("source", F.substring(mark, 1, mixing.BUCKET_DIGITS).alias("b")).count().agg(F.max("count")).first()[0]
    assert largest < 200
    first, again = ({(r.doc_id, r.size): r.taken for r in mixing.mix_sources(frame(spark, rows).repartition(n)).where("doc_id IS NOT NULL").collect()} for n in (2, 7))
    assert first == again


LINE = "MIIEvQIBADANBgkqhkiG9w0BAQEFAASCBKcwggSjAgEAAoIBAQC7VJTUt9Us8cKj"
HEADER, FOOTER = ("-----%s RSA PRIVATE KEY-----" % w for w in ("BEGIN", "END"))
KEYS = [
    f"a {HEADER}\n{LINE}\n{LINE}\nabc=\n{FOOTER} after", f"{HEADER}\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES,1F\n\n{LINE}\nQQ==\n{FOOTER}",
    f"{HEADER}\n{LINE}\n{LINE}\nshort=\nprose goes on", f"{HEADER}\n{LINE}\nThis is prose", f"{HEADER}\\n{LINE}\\nab\\n{FOOTER}\\n", f"{HEADER} alone",
    f"{HEADER}\n{LINE}", f"{HEADER}\n{LINE}\n{LINE}x\nlast", f'"{HEADER}\n{LINE}\nend" {HEADER}\n{LINE}\n{FOOTER}', f"é {HEADER}\r\n{LINE}\r\nzz\r\n{FOOTER}\r\n",
    f"{HEADER}{FOOTER}", "-----BEGIN PUBLIC KEY-----", f"password = '{HEADER}", "", None, f"{HEADER}\n  {LINE}\n  tail  \nmore",
]


def plain_key(text):
    """(start, end) of keys, line by line instead of by one pattern."""
    spans, at = [], 0
    while (start := text.find("-----BEGIN ", at)) >= 0:
        close = text.find("PRIVATE KEY-----", start)
        if close < 0 or not set(text[start + 11 : close]) <= set("ABCDEFGHIJKLMNOPQRSTUVWXYZ ") or close - start > 51:
            at = start + 1
            continue
        end = close + 16
        rest = text[end:].replace("\\n", " \n").replace("\\r", " \r")
        stop = rest.find("-----END ")
        body = rest[:stop] if stop >= 0 else None
        if body is not None:
            lines = [x.strip() for x in body.replace("\r", "\n").split("\n")]
            while lines and (not lines[0] or ":" in lines[0]):
                lines.pop(0)
            if all(set(x) <= set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/= ") for x in lines):
                end = text.find("PRIVATE KEY-----", end + stop) + 16
        spans.append((start, end))
        at = end
    return spans


def test_private_keys_equal_sql_and_a_plain_parser(spark, tmp_path):
    table = pa.table({"doc_id": pa.array(range(len(KEYS)), pa.int64()), "text": pa.array(KEYS, pa.string()),
                      "lang": ["en"] * len(KEYS), "source": ["a"] * len(KEYS), "n_chars": pa.array([0] * len(KEYS), pa.int64())})
    pq.write_table(table, tmp_path / "documents.parquet")
    got = sorted(map(tuple, queries.QUERIES["op7_secret_scan"](spark, str(tmp_path)).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet'")
    assert got == sorted(con.execute(oracle.ORACLES["op7_secret_scan"]).fetchall())
    # With an END line the plain parser tells the whole key.
    spans = {r.doc_id: [(s.low, s.high) for s in r.spans if s.kind == "private_key"] for r in secrets.scan(spark.read.parquet(str(tmp_path / "documents.parquet"))).collect()}
    for i in (0, 1, 4, 9, 10, 11):
        assert spans[i] == plain_key(KEYS[i]), i
    assert KEYS[2][slice(*spans[2][0])].endswith("short=") and KEYS[3][slice(*spans[3][0])].endswith(LINE)


# ------------------------------------------------------------------ pipeline
def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_groups(rows):
    """Smallest index of the rows that shared five-word shingles link to, of each row with words."""
    sets = []
    for r in rows:
        w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"] or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    part = list(range(len(rows)))
    for _ in range(len(rows)):
        before = list(part)
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                if a and b and len(a & b) * 100 >= 80 * len(a | b):
                    part[i] = part[j] = min(part[i], part[j])
        if before == part:
            break
    return part, sets


def plain_pipeline(spark, folder):
    """Rows after the first four stages, each done without Spark but for the language model."""
    table = spark.read.parquet(f"{folder}/documents.parquet")
    judged = {r.doc_id: r for r in language.learn_and_identify(table).select("doc_id", "lang_pred", "score").collect()}
    rows = [dict(r.asDict(), lang=judged[r.doc_id].lang_pred) for r in table.collect()]
    rows = [r for r in rows if r["lang"] != "und" and judged[r["doc_id"]].score >= 0.5]
    rows.sort(key=lambda r: r["doc_id"])
    part, _ = plain_groups(rows)
    rows = [r for i, r in enumerate(rows) if part[i] == i]
    for r in rows:
        spans = sorted(s for kind, _, pattern, least in secrets.RULES for s in secrets.find(r["text"] or "", re.compile(pattern, re.ASCII), least))
        out, at = "", 0
        for low, high in spans:
            if low >= at:
                out += r["text"][at:low] + "[secret]"
            at = max(at, high)
        if spans:
            r["text"] = out + r["text"][at:]
            r["n_chars"] = len(r["text"])
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())])
    con = duckdb.connect()
    con.register("documents", pa.Table.from_pylist(rows, schema))
    taken = {i: (size, n) for i, size, n in con.execute(f"SELECT doc_id, size, taken FROM ({oracle.MIXING})").fetchall()}
    return [r for r in rows for _ in range(math.floor(taken[r["doc_id"]][1] / taken[r["doc_id"]][0] + 0.5) if taken[r["doc_id"]][0] else 0)]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test tables not present")
def test_pipeline_equals_a_plain_one(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    folder = "/root/testdata/sf0.001"
    rows = plain_pipeline(spark, folder)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for r in rows:
        ids = np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1], dtype="<u4")
        for k, low in enumerate(range(0, len(ids), 4096)):
            want[r["doc_id"], k, low, len(ids[low : low + 4096]), zlib.crc32(ids[low : low + 4096].tobytes())] += 1
    got = corpus_pipeline.run(spark, folder).collect()
    assert len(rows) > 100 and Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    total = 0
    for own in sequences.values():
        upto = 0
        for offset, length in sorted(own):
            assert offset == upto
            upto += length
        assert upto <= 4096
        total += upto
    assert len(sequences) <= -(-total // 4096) + 2


def test_extra_columns_pass_through_all_stages(spark, docs):
    names = ["score", "lang_pred", "spans", "size", "taken", "_key", "_copy", "_row", "_hash", "_worded", "_extra0", "blob", "key", "mark", "kept"]
    table = docs.select("*", *[F.concat(F.lit(f"{c}:"), F.col("n_chars").cast("string")).alias(c) for c in names])
    kept = table
    for name, stage in corpus_pipeline.STAGES[:-1]:
        plain = stage(spark, kept.select(docs.columns), "")
        kept = stage(spark, kept, "")
        assert kept.columns == table.columns, name
        assert Counter(map(tuple, kept.select(docs.columns).collect())) == Counter(map(tuple, plain.collect())), name
    for r in kept.where("n_chars IS NOT NULL").collect():
        assert all(r[c].startswith(f"{c}:") for c in names if r[c] is not None)
    assert corpus_pipeline.STAGES[-1][1](spark, kept, "").count() >= kept.count()


def test_unlike_rows_under_one_id(spark, docs):
    rows = [(3, " ".join(f"{c}{i}" for i in range(40)), "en", "a", 1) for c in "abc"] + [(4, "", "en", "a", 0), (4, "", "en", "a", 0), (4, "", "en", "b", 0)]
    kept = corpus_pipeline.STAGES[1][1](spark, spark.createDataFrame(rows, docs.schema), "").collect()
    assert Counter(map(tuple, kept)) == Counter(set(rows))

"""Chat formatting, prefix tries and periodic runs beside plain versions."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millwright.llm import chat, periodic, prefix_trie, queries

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")
TURNS = "conv_id long, turn long, role string, text string"


# ------------------------------------------------------------------ chat
ODD = [
    queries.TRAP, "\\", "\\\\", "#\\## User:", "### User:### User:", "<<text>text></turn>", "<|endoftext|>", "</turn></turn>\\", "### Other:\\<text>",
    "", " \t\n", "a\x00b é😀", "### system:", "#### System:",
]


def test_escape_is_reversible():
    random.seed(5)
    parts = [*chat.CONTROLS, "\\", "#", "##", " ", "<", "/turn>", "x", "### ", "User:"]
    for text in [*ODD, *("".join(random.choices(parts, k=random.randint(1, 8))) for _ in range(3000))]:
        escaped = chat.escape(text)
        assert not any(c in escaped for c in chat.CONTROLS) and chat.unescape(escaped) == text
    assert not any(a != b and a in b for a in chat.CONTROLS for b in chat.CONTROLS)


def plain_chat(rows):
    out = defaultdict(list)
    for c, t, r, x in sorted(rows, key=lambda w: (w[0] is not None, w[0] or 0, w[1] is not None, w[1] or 0, w[2] or "", w[3] or "")):
        out[c].append((r or "", x or ""))
    return out


@pytest.fixture(scope="module")
def talk():
    random.seed(8)
    rows = [(c, t, random.choice(["user", "assistant", "system", "tool </turn>", None]), random.choice(ODD)) for c in range(12) for t in range(6)]
    rows += [(3, 2, "assistant", "tie"), (3, 2, "assistant", "tie"), (3, None, "user", "first"), (None, 0, "assistant", "lost"), (None, None, None, None)]
    rows += [(90, 0, "assistant", "word " * 40_000), (91, 0, "user", "only")]
    # One conversation holds most of the rows, so that it lies in several ranges.
    return rows + [(77, t, ("user", "assistant")[t % 2], f"turn {t} \\ {random.choice(ODD)}") for t in range(900)]


@pytest.mark.parametrize("extra", [False, True])
def test_chat_comes_back(spark, talk, extra):
    df = spark.createDataFrame(talk, TURNS).repartition(5)
    if extra:
        df = df.select("*", *[F.lit(1).alias(c) for c in ("ids", "loss", "part", "chars", "turn_no", "c", "p", "turns", "tokens")])
    formatted = chat.format_conversations(df, PATH).cache()
    want = plain_chat(talk)
    template = chat.template_at(PATH)
    spelled = {i: s for s, i in template.ids.items()}
    got = defaultdict(list)
    for r in formatted.orderBy("conv_id", "turn_no").collect():
        got[r.conv_id].append(r)
    assert set(got) == set(want)
    for c, turns in got.items():
        tokens = chars = 0
        for k, (r, (role, text)) in enumerate(zip(turns, want[c], strict=True)):
            assert (r.turn_no, r.token_start, r.char_start) == (k, tokens, chars)
            rendered, run = "", []
            for i in [*r.ids, None]:
                if i is None or i >= template.reserved:
                    rendered += template.decode([run])[0]
                    run = []
                    rendered += spelled.get(i, "")
                else:
                    run.append(i)
            head = chat.HEADS.get(role) or f"{chat.OTHER}{chat.escape(role)}{chat.NAMED}"
            assert rendered == head + chat.escape(text) + chat.END and r.chars == len(rendered)
            lost = template.decode([[i for i, m in zip(r.ids, r.loss) if m]])[0]
            assert lost == (chat.escape(text) if role == "assistant" else "")
            tokens, chars = tokens + len(r.ids), chars + len(rendered)
    back = chat.read_back(formatted, PATH)
    for r in chat.digests(back).collect():
        turns = want[r.conv_id]
        loss = "".join(x for role, x in turns if role == "assistant")
        assert r.n_turns == len(turns) and r.loss_chars == len(loss) and r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.formatted_chars == got[r.conv_id][-1].char_start + got[r.conv_id][-1].chars


def test_hot_conversation_spans_ranges(spark, talk, monkeypatch):
    df = spark.createDataFrame(talk, TURNS).repartition(5)
    local, key = [], "spark.sql.adaptive.coalescePartitions.enabled"
    store = chat.materialise
    monkeypatch.setattr(chat, "materialise", lambda df, name: local.append(store(df, name)) or local[0])
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        rows = chat.format_conversations(df, PATH).where("conv_id = 77").collect()
    finally:
        spark.conf.set(key, old)
    assert local[0].where("conv_id = 77").select("part").distinct().count() > 1
    at = 0
    for k, r in enumerate(sorted(rows, key=lambda r: r.turn_no)):
        assert (r.turn_no, r.token_start) == (k, at)
        at += len(r.ids)
    assert len(rows) == 900


def test_chat_of_nothing(spark):
    none = spark.createDataFrame([], TURNS)
    formatted = chat.format_conversations(none, PATH)
    assert formatted.count() == 0 and chat.digests(chat.read_back(formatted, PATH)).count() == 0


# ------------------------------------------------------------------ tries
def plain_trie(convs):
    """convs: id -> [(turn id, bytes)]"""
    members, ends, size = defaultdict(list), defaultdict(list), {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            k = tuple(x for x, _ in turns[:d])
            members[k].append(c)
            size[k] = turns[d - 1][1] if d else 0
        ends[tuple(x for x, _ in turns)].append(c)
    kids = defaultdict(list)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    leaves, saved, out = {}, {}, []
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[u] for u in kids[k]) or 1
        saved[k] = sum(saved[u] for u in kids[k]) + (len(members[k]) - 1) * size[k]
        told = hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest()
        out.append((min(members[k]), len(k), min(members[k[:-1]]) if k else None, len(members[k]), len(kids[k]), leaves[k], saved[k], told))
    return sorted(out, key=repr)


TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def test_layouts_grow_and_find():
    random.seed(2)
    for count in (3, 4, 5, 16, 17, 48, 49, 256):
        for at in (0, 15):
            ids = [bytes([7] * at + [b] + [9] * (15 - at)) for b in random.sample(range(256), count)]
            root = prefix_trie.build(sorted(ids))
            kind = prefix_trie.Sorted if count <= 16 else prefix_trie.Indexed if count <= 48 else prefix_trie.Direct
            node = root if at == 0 else root.kids.nodes[0]
            assert isinstance(node.kids, kind) and len(node.kids.nodes) == count and node.end == at
            for key in ids:
                leaf = node.kids.get(key[at])
                assert (leaf.start, leaf.end, len(leaf.ends)) == (at, 16, 1)


@pytest.mark.parametrize("keys", [1, 3, 20_000])
def test_trie_equals_plain(spark, monkeypatch, keys):
    random.seed(keys)
    words = [(f"r{i % 3}", "é" * (i % 5) + str(i)) for i in range(6)]
    convs = {c: [random.choice(words[: 2 + c % 5]) for _ in range(random.choice([0, 1, 2, 3, 4, 9]))] for c in range(-5, 150)}
    convs |= {c: [words[0], words[1]] for c in range(200, 300)}
    ids = {c: [(prefix_trie.hashlib.md5(f"{len(r)}:{r}{x}".encode()).digest(), len(x.encode())) for r, x in s] for c, s in convs.items()}
    seqs = spark.createDataFrame(
        [(c, b"".join(i for i, _ in s), [z for _, z in s], "x", 1) for c, s in ids.items()], "conv_id long, key binary, sizes array<int>, part string, n int"
    )
    rows = spark.createDataFrame([(c, t, r, x) for c, s in convs.items() for t, (r, x) in enumerate(s)], TURNS)
    made = {r.conv_id: (bytes(r.key), r.sizes) for r in prefix_trie.sequences(rows.repartition(3)).collect()}
    assert made == {c: (b"".join(i for i, _ in s), [z for _, z in s]) for c, s in ids.items() if s}
    # Chunks of few keys make most nodes open.
    whole = prefix_trie._parts
    monkeypatch.setattr(prefix_trie, "_parts", small(keys, whole))
    got = sorted((tuple(r[c] for c in TRIE) for r in prefix_trie.prefix_trie(seqs).collect()), key=repr)
    assert got == plain_trie(ids)


def small(keys, parts):
    def run(batches):
        prefix_trie.CHUNK_KEYS = keys
        yield from parts(batches)

    return run


def test_shared_heads_equal_plain(spark):
    random.seed(4)
    rows = [(c, t, "user", f"{c % 5} {t}") for c in [*range(0, 40), 103, 111] for t in range(random.randint(1, 12))]
    rows += [(6, None, None, None), (6, 2, "user", "tie"), (6, 2, "user", "tie"), (None, 0, "user", "x")]
    turns = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            told = hashlib.md5(f"{len(r or '')}:{r or ''}{x or ''}".encode())
            turns[c].append((t is not None, t or 0, told.hexdigest(), told.digest(), len(x or "")))
    own = {c: [(i, z) for *_, i, z in sorted(s)] for c, s in turns.items()}
    want = {}
    for c, s in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        want[c] = own.get(c - c % 5, [])[:h] + s[h:]
    df = spark.createDataFrame(rows, TURNS).withColumn("key", F.lit("k")).withColumn("sizes", F.lit(1))
    made = prefix_trie.share_heads(prefix_trie.sequences(df))
    got = {r.conv_id: (bytes(r.key), r.sizes) for r in made.collect()}
    assert got == {c: (b"".join(i for i, _ in s), [z for _, z in s]) for c, s in want.items()}
    assert any(not s for s in want.values())
    nodes = sorted((tuple(r[c] for c in TRIE) for r in prefix_trie.prefix_trie(made).collect()), key=repr)
    assert nodes == plain_trie(want)


def test_trie_of_nothing(spark):
    none = prefix_trie.sequences(spark.createDataFrame([], TURNS))
    assert prefix_trie.prefix_trie(prefix_trie.share_heads(none)).count() == 0
    lost = spark.createDataFrame([(None, 0, "user", "x")], TURNS)
    assert prefix_trie.prefix_trie(prefix_trie.sequences(lost)).count() == 0


# ------------------------------------------------------------------ runs
def plain_runs(w, least=12):
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j - i >= q and j - i + q >= least:
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def test_runs_equal_plain():
    random.seed(1)
    for _ in range(300):
        docs = []
        for _ in range(random.randint(1, 4)):
            n, k = random.choice([0, 3, 12, 20, 40, 80]), random.choice([1, 2, 3, 5])
            w = [random.randrange(k) for _ in range(n)]
            if n and random.random() < 0.5:
                a, p = random.randrange(n), random.randint(1, max(1, n // 3))
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            docs.append(w)
        row = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        words = periodic.mix(np.array([x for d in docs for x in d], dtype=np.uint64) + np.uint64(7))
        first = np.searchsorted(row, np.arange(len(docs) + 1))
        for least in (4, 5, 12):
            got = periodic.find_runs(words, row, first, least)
            for i, d in enumerate(docs):
                mine = sorted((s - int(first[i]), n, q) for s, n, q in got if row[s] == i)
                assert mine == sorted(plain_runs(d, least)), (least, d)


def plain_tail(i, text):
    w = (text or "").encode().split()
    h = zlib.crc32(str(i).encode()) if i is not None else 1
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[k if k < a else a + (k - a) % p] for k in range(n)]
    return w


@pytest.mark.parametrize("extra", [False, True])
def test_collapse_equals_plain(spark, rows, docs, clashing, extra):
    table = clashing if extra else docs
    planted = [(i, t, "en", "a", 1) for i in range(100, 300) for t in [" ".join(f"w{(i * k) % (i % 7 + 2)}\tx{k % 5}" for k in range(i - 95))]]
    more = spark.createDataFrame(planted, docs.schema)
    table = table.unionByName(more, allowMissingColumns=True).unionByName(
        spark.createDataFrame([(None, "a " * 5000, None, None, None), (401, "a" * 300_000, None, None, None)], docs.schema), allowMissingColumns=True
    )
    got = periodic.collapse_runs(periodic.with_periodic_tails(table)).collect()
    given = [tuple(r)[:2] for r in table.select("doc_id", "text").collect()]
    want = []
    for i, text in given:
        w = plain_tail(i, text)
        small = len(w) < 3000
        runs = plain_runs(w) if small else ([(0, 5000, 1)] if w[0] == b"a" else [])
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        want.append((i, len(w), tuple(sorted(runs)), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    have = [(r.doc_id, r.n_words, tuple(tuple(x) for x in r.runs), r.n_dropped, r.kept_text) for r in got]
    assert sorted(have, key=repr) == sorted(want, key=repr)
    assert periodic.collapse_runs(table.limit(0)).count() == 0


def test_longest_run_breaks_ties(spark):
    df = spark.createDataFrame([([(5, 14, 2), (1, 14, 7), (1, 14, 3), (0, 12, 1)],), ([],)], f"runs array<{periodic.RUN}>")
    got = df.select(periodic.longest_run().alias("r")).collect()
    assert (got[0].r.start, -got[0].r.order, got[0].r.period) == (1, 14, 3) and got[1].r is None

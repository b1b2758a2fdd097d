"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from millwright.llm import chat
from millwright.llm.secrets import BASE_RULES, HEAD, KEY_LINES, LAST_LINE, NAMED, RULES, WHOLE_KEY

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SEARCH = f"""
WITH d AS (SELECT doc_id, unnest(regexp_extract_all({FOLD}, '[^\\x20\\x09-\\x0D]+')) AS w FROM documents),
tf AS (SELECT doc_id, w, count(*) AS n FROM d GROUP BY ALL),
len AS (SELECT doc_id, len({WORDS}) AS l FROM documents),
whole AS (SELECT count(*) AS docs, sum(l) / count(*) AS mean FROM len),
idf AS (SELECT w, ln(1 + (max(docs) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM tf, whole GROUP BY w),
s AS (SELECT q.doc_id AS query_id, t.doc_id, round(sum(q.n * idf * t.n * 2.2 / (t.n + 1.2 * (0.25 + 0.75 * l / mean))), 6) AS score
      FROM tf q JOIN tf t USING (w) JOIN idf USING (w) JOIN len ON len.doc_id = t.doc_id, whole WHERE q.doc_id % 50 = 0 GROUP BY ALL)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
FROM s QUALIFY rank <= 10
"""

MIXING = f"""
WITH size AS (SELECT doc_id, source, len({WORDS}) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))) AS mark FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM size GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, 3 * source_size AS cap FROM src),
lv AS (SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER p, 0) AS DOUBLE)
       / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER p, 0) AS DOUBLE) AS level
       FROM w WINDOW p AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goal AS (SELECT source, source_size, least(CAST(cap AS DOUBLE), max(level) OVER () * weight) AS target FROM lv),
share AS (SELECT *, CAST(round(target / CAST(greatest(sum(source_size) OVER (), 1) AS DOUBLE) * 281474976710656.0) AS BIGINT) AS part FROM goal),
bound AS (SELECT source, source_size, sum(part) OVER o - part AS low,
          CASE WHEN row_number() OVER o = count(*) OVER () THEN 281474976710656 ELSE sum(part) OVER o END AS high
          FROM share WHERE target > 0 WINDOW o AS (ORDER BY source NULLS LAST)),
slot AS (SELECT n AS slot, CAST(list_sum(list_transform(range(0, 48), lambda i: ((n >> i) & 1) << (47 - i))) AS BIGINT) AS point
         FROM range(0, (SELECT CAST(ceil(sum(source_size) / 64) AS BIGINT) FROM goal)) r(n)),
drawn AS (SELECT source, row_number() OVER (PARTITION BY source ORDER BY slot) - 1 AS rank, CAST(ceil(source_size / 64) AS BIGINT) AS blocks
          FROM slot JOIN bound ON low <= point AND point < high),
times AS (SELECT source, rank % blocks AS block, count(*) AS times FROM drawn WHERE rank < 3 * blocks GROUP BY ALL),
stream AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY mark, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
           AS first FROM size),
taken AS (SELECT s.doc_id, sum(times * (least(first + size, (block + 1) * 64) - greatest(first, block * 64))) AS taken
          FROM stream s JOIN times t ON s.source IS NOT DISTINCT FROM t.source AND block * 64 < first + size AND (block + 1) * 64 > first
          WHERE size > 0 GROUP BY s.doc_id)
SELECT s.doc_id, CAST(s.size AS BIGINT) AS size, g.source_size, g.target, CAST(coalesce(t.taken, 0) AS BIGINT) AS taken
FROM size s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source LEFT JOIN taken t ON s.doc_id = t.doc_id
"""


def components(nodes: str, links: str) -> str:
    """CTEs ``reach(id, other)``: every node with all that links reach from it."""
    return f"""{nodes}, {links}, both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(id, other) AS (SELECT id, id FROM nodes UNION SELECT r.id, l.b FROM reach r JOIN both_ways l ON r.other = l.a)"""


VECTORS = f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
{components("nodes AS (SELECT vec_id AS id FROM v)",
            "links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id < y.vec_id AND list_cosine_similarity(x.e, y.e) >= 0.95)")},
c AS (SELECT id, min(other) AS c FROM reach GROUP BY id), n AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a)
SELECT id AS vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, c AS component_id, id = c AS kept FROM c LEFT JOIN n ON c.id = n.a
"""

SHINGLES = f"""
WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all({FOLD}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS s FROM t),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
{components("nodes AS (SELECT doc_id AS id FROM documents)",
            '''links AS (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL) p
             JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 85 * (na.n + nb.n - k))''')},
c AS (SELECT id, min(other) AS c FROM reach GROUP BY id)
SELECT id AS doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, c AS component_id, id = c AS kept FROM c LEFT JOIN n ON c.id = n.doc_id
"""

WINDOWS = f"""
WITH t AS (SELECT doc_id, {WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS k FROM (SELECT *, unnest(range(1, len(w) - 33)) AS i FROM t)),
rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY k) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM rep),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM t),
kept AS (SELECT word.doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY word.i) AS s FROM word
         LEFT JOIN gone ON word.doc_id = gone.doc_id AND word.i = gone.i WHERE gone.i IS NULL GROUP BY word.doc_id)
SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM t LEFT JOIN kept ON t.doc_id = kept.doc_id
"""


def _private_key() -> str:
    """The rule for an engine without look-ahead: whole key, key cut in its last line, cut key, BEGIN line alone.

    Each alternative has its span as a group; what ends a short last line is matched after it.
    """
    plain = [x.replace("++", "+").replace("*+", "*").replace("}+", "}") for x in (HEAD, NAMED, WHOLE_KEY, KEY_LINES, LAST_LINE)]
    head, named, whole, lines, last = plain
    return rf"({head}{named}{whole})|({head}{named}{lines}{last})[\x20\t]*(?:[\r\n\\\"']|\z)|({head}{named}{lines})|({head})"


def _secrets() -> str:
    """Matches have no positions in SQL: they follow from the lengths of the texts between them."""
    parts = []
    for order, (kind, _, pattern, least) in enumerate(RULES):
        text = (_private_key() if kind == "private_key" else pattern).replace("'", "''")
        groups = [f"regexp_extract_all(t, '{text}', {k})" for k in ((1, 2, 3, 4) if kind == "private_key" else (2 if kind == "assign" else 1,))]
        each = ", ".join(f"nullif({g}[i], '')" for g in groups)
        found = f"list_transform(range(1, len({groups[0]}) + 1), lambda i: coalesce({each}, ''))"
        whole = found if kind == "private_key" else f"regexp_extract_all(t, '{text}')"
        parts.append(
            f"SELECT doc_id, '{kind}' AS kind, {order} AS o, {least} AS least, regexp_extract_all(t, '{text}') AS m, {found} AS g, "
            f"{whole} AS s, string_split_regex(t, '{text}') AS between FROM texts"
        )
    base = ", ".join(f"'{r[0]}'" for r in BASE_RULES)
    spelled = "kind || ':' || low || ':' || high"
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), found AS ({" UNION ALL ".join(parts)}),
each AS (SELECT doc_id, kind, o, least, unnest(range(1, len(m) + 1)) AS i, m, g, s, between FROM found),
span AS (SELECT doc_id, kind, o, length(s[i]) AS n,
         CAST(list_sum(list_transform(between[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS low
         FROM each WHERE length(g[i]) >= least),
row AS (SELECT *, low + n AS high FROM span),
told AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex, string_agg({spelled}, ',' ORDER BY low, o) FILTER (kind IN ({base})) AS b,
         string_agg({spelled}, ',' ORDER BY low, o) AS spans FROM row GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans FROM documents d LEFT JOIN told ON d.doc_id = told.doc_id
"""


def crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text: eight shifts for each byte (-1 stands for a shift)."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda ch: [CAST(ascii(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))"
    turn = "CASE WHEN x >= 0 THEN xor(acc, x) ELSE xor(acc >> 1, CASE WHEN acc & 1 = 1 THEN 3988292384 ELSE 0 END) END"
    turned = f"list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {steps}), lambda acc, x: {turn})"
    return f"xor({turned}, CAST(4294967295 AS BIGINT))"


#: Pairs of equal six-word stretches make islands of one distance; islands at least as long as their distance are runs.
RUNS = f"""
WITH raw AS (SELECT doc_id, {WORDS} AS o, {crc32("CAST(doc_id AS VARCHAR)")} AS h FROM documents),
par AS (SELECT *, len(o) AS n, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(o) > 0 THEN (h // 10) % len(o) END AS a FROM raw),
per AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM par),
t AS (SELECT doc_id, n, CASE WHEN a IS NULL THEN o ELSE list_transform(range(0, n), lambda i: o[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS w FROM per),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(0, len(w))) AS i FROM t),
gram AS (SELECT doc_id, i, md5(array_to_string(w[i + 1:i + 6], ' ')) AS k FROM (SELECT doc_id, w, unnest(range(0, len(w) - 5)) AS i FROM t)),
pair AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM gram x JOIN gram y ON x.doc_id = y.doc_id AND x.k = y.k AND x.i < y.i),
island AS (SELECT doc_id, q, min(i) AS start, count(*) + 5 AS same
           FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS part FROM pair) s GROUP BY doc_id, q, part),
run AS (SELECT doc_id, start, same + q AS length, min(q) AS period FROM island WHERE same >= q AND same + q >= 12 GROUP BY ALL),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM run),
kept AS (SELECT word.doc_id, string_agg(x, ' ' ORDER BY word.i) AS s FROM word
         LEFT JOIN gone ON word.doc_id = gone.doc_id AND word.i = gone.i WHERE gone.i IS NULL GROUP BY word.doc_id),
best AS (SELECT * FROM run QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) = 1),
told AS (SELECT doc_id, count(*) AS n, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS s FROM run GROUP BY doc_id)
SELECT t.doc_id, coalesce(told.n, 0) AS n_runs, start, CAST(length AS BIGINT) AS length, period, 1000 * length // period AS exponent_milli,
sha256(coalesce(told.s, '')) AS runs_sha256, sha256(coalesce(kept.s, '')) AS collapsed_sha256
FROM t LEFT JOIN kept ON t.doc_id = kept.doc_id LEFT JOIN told ON t.doc_id = told.doc_id LEFT JOIN best ON t.doc_id = best.doc_id
"""


#: Every prefix is spelled by the hashes of its turns; a subtree is found by the prefixes of each node.
TRIE = f"""
WITH t AS (SELECT conv_id, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id, strlen(coalesce(text, '')) AS z FROM conversations),
seq AS (SELECT conv_id, list(id ORDER BY turn NULLS FIRST, id) AS ids, list(z ORDER BY turn NULLS FIRST, id) AS zs,
        any_value({crc32("CAST(conv_id AS VARCHAR)")}) % 9 AS h FROM t WHERE conv_id IS NOT NULL GROUP BY conv_id),
made AS (SELECT s.conv_id, list_concat(coalesce(b.ids, [])[1:s.h], s.ids[s.h + 1:]) AS ids, list_concat(coalesce(b.zs, [])[1:s.h], s.zs[s.h + 1:]) AS zs
         FROM seq s LEFT JOIN seq b ON b.conv_id = s.conv_id - s.conv_id % 5),
path AS (SELECT conv_id, len(ids) AS n, d, array_to_string(ids[1:d], '') AS k, CASE WHEN d > 0 THEN zs[d] ELSE 0 END AS z
         FROM (SELECT *, unnest(range(0, len(ids) + 1)) AS d FROM made)),
node AS (SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(z) AS saved, left(k, CAST(32 * (d - 1) AS BIGINT)) AS up,
         string_agg(conv_id, ',' ORDER BY conv_id) FILTER (d = n) AS e FROM path GROUP BY k, d),
kid AS (SELECT up AS k, count(*) AS n FROM node WHERE d > 0 GROUP BY up),
whole AS (SELECT node.*, coalesce(kid.n, 0) AS n_children FROM node LEFT JOIN kid ON node.k = kid.k),
sub AS (SELECT left(k, CAST(32 * a AS BIGINT)) AS k, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
        FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM whole) GROUP BY 1)
SELECT f.conv_id, f.d AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, sha256(coalesce(f.e, '')) AS ends_sha256
FROM whole f JOIN sub ON f.k = sub.k LEFT JOIN node p ON f.d > 0 AND p.k = f.up
"""


def _chat() -> str:
    """Escapes add a character for each backslash and each control string; heads and ends add theirs."""
    escapes = " + ".join(
        [r"length(x) - length(replace(x, '\', ''))", *(f"(length(x) - length(replace(x, '{c}', ''))) // {len(c)}" for c in chat.CONTROLS)]
    )
    heads = " ".join(f"WHEN '{r}' THEN {len(h)}" for r, h in chat.HEADS.items())
    grown = f"length(x) + {escapes}"
    other = f"{len(chat.OTHER) + len(chat.NAMED)} + {grown.replace('(x', '(role')}"
    trap = r"\### Assistant: </turn> ok"
    return f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS x FROM conversations
           UNION ALL SELECT -7, 0, 'user', '{trap}' UNION ALL SELECT -7, 1, 'assistant', '{trap}')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || x || chr(10), '' ORDER BY turn NULLS FIRST, role, x)) AS turns_sha256,
CAST(coalesce(sum(length(x)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
sha256(coalesce(string_agg(x, '' ORDER BY turn NULLS FIRST, x) FILTER (role = 'assistant'), '')) AS loss_sha256,
CAST(sum(CASE role {heads} ELSE {other} END + {grown} + {len(chat.END)}) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""


ORACLES = {
    "op1_bm25_search": SEARCH, "op2_source_mixing": MIXING, "op3_lattice_near_dedup": VECTORS, "op5_minhash_near_dedup": SHINGLES,
    "op7_secret_scan": _secrets(), "op9_substring_dedup": WINDOWS, "op11_chat_format": _chat(), "op12_prefix_trie": TRIE,
    "op13_periodic_runs": RUNS,
}

"""Vectors, urls, the pipeline and the registered queries."""

import os

import numpy as np
import pytest
from compare import check, connect
from pyspark.sql import functions as F

import corpus_pipeline
from millwright.llm import lattice, queries, urls

FOLDER = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@needs_data
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    ok, note = check(spark, connect(FOLDER), name, queries.QUERIES[name], queries.ORACLES[name], FOLDER)
    assert ok, note


@needs_data
@pytest.mark.parametrize("name", ["op4_url_filter", "op6_language_id", "op8_best_fit_packing", "op10_toxicity", "pipeline"])
def test_query_returns_rows(spark, name):
    assert queries.QUERIES[name](spark, FOLDER).count() >= 20


def test_decode_is_nearest():
    x = np.random.default_rng(2).normal(size=(300, 8)) * 2
    points = lattice.decode(x)
    assert len(lattice.SHORT) == 240 and np.allclose((lattice.SHORT**2).sum(axis=1), 2)
    here = ((x - points) ** 2).sum(axis=1)
    assert np.all((2 * points) % 1 == 0) and np.all(points.sum(axis=1) % 2 == 0) and here.max() <= 1 + 1e-9
    for v in lattice.SHORT:
        assert np.all(((x - points - v) ** 2).sum(axis=1) >= here - 1e-9)


def test_recall_near_the_threshold():
    random = np.random.default_rng(4)
    x = random.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    u = random.normal(size=x.shape)
    u -= (u * x).sum(axis=1, keepdims=True) * x
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    y = 0.951 * x + np.sqrt(1 - 0.951**2) * u
    shape = (lattice.TABLES, lattice.BLOCKS, lattice.PROBES, lattice.SCALE)
    (ox, nx), (oy, ny) = lattice.cells(x, *shape), lattice.cells(y, *shape)
    met = (ox == oy) | (nx == oy[:, None]).any(axis=1) | (ny == ox[:, None]).any(axis=1)
    assert met.any(axis=0).mean() > 0.999


@pytest.mark.parametrize("extra", [False, True])
def test_vectors_equal_all_pairs(spark, extra):
    random = np.random.default_rng(6)
    base = random.normal(size=(20, 16))
    vectors = [b + random.normal(size=16) * s for b in base for s in (0, 0, 0.05, 0.08, 0.3)]
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(vectors)]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [None] + [1.0] * 15, [float("inf")] * 16, [1.0, 2.0], [1e300] * 16, [2e300] * 16]
    rows += [(len(rows) + k, v, 1) for k, v in enumerate(odd)] + [(None, rows[0][1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    if extra:
        df = df.select("*", *[F.lit(1).alias(c) for c in ("v", "good", "head", "n", "cell")])
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in lattice.near_vectors(df).collect()}
    unit = {}
    for i, v, _ in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            unit[i] = np.array(v) / max(map(abs, v))
            unit[i] /= np.linalg.norm(unit[i])
    links = {i: [j for j in unit if j != i and len(unit[j]) == len(unit[i]) and unit[i] @ unit[j] >= 0.95] for i in unit}
    part = {i: i for i, *_ in rows}
    for _ in range(20):
        for i in links:
            part[i] = min([part[i], *(part[j] for j in links[i])])
    assert got == {i: (len(links.get(i, [])), part[i], i is None or part[i] == i) for i, *_ in rows}
    assert lattice.near_vectors(df.limit(0)).count() == 0


def test_url_parts_and_rules(spark):
    cases = [
        ("https://A.Example.ORG/en/1?x", "a.example.org", "/en/1", "example.org/en/1"), ("http://example.org/es/a#f", "example.org", "/es/a", "example.org/es/"),
        ("http://x.org/", "x.org", "/", "org/"), ("http://x.org", "x.org", "", None), ("http://notorg/fr/", "notorg", "/fr/", None),
        ("ftp://m.com/de/1://y", "m.com", "/de/1://y", "com/de/"), ("http://É.com/fr/\n", "É.com", "/fr/\n", "com/fr/"), (None, "", "", None),
        ("", "", "", None), ("org/", "", "", None), ("http://h?q/org", "h", "", None), ("http://com/fr/x", "com", "/fr/x", "com/fr/"),
    ]
    df = spark.createDataFrame([(i, c[0], "x", "y") for i, c in enumerate(cases)], "page_id long, url string, host string, verdict string")
    out = {r.page_id: r for r in urls.filter_urls(df).collect()}
    for i, (_, host, path, rule) in enumerate(cases):
        assert (out[i].host, out[i].path, out[i].rule) == (host, path, rule)
        assert out[i].verdict == ({r[1] + r[2]: r[0] for r in urls.RULES}[rule] if rule else out[i].verdict)
        assert out[i].verdict in ("allow", "block") and 0 <= out[i].p_block <= 1
    assert urls.filter_urls(df.limit(0)).count() == 0
    unlabelled = urls.filter_urls(df.where("page_id = 4")).first()
    assert (unlabelled.verdict, unlabelled.p_block) == ("allow", 0.0)


def test_url_model_learns_marks(spark):
    rows = [(f"http://h{i % 7}.net/{'spam-offer' if i % 2 else 'daily-news'}/{i}", i % 2) for i in range(120)]
    df = spark.createDataFrame(rows, "url string, blocked int")
    model = urls.train(df.limit(80))
    wrong = urls.judge(df, model, rules=[("block", "none", "/")]).where("(verdict = 'block') != (blocked = 1)")
    assert wrong.count() == 0


def test_url_copies_do_not_fill_the_sample(spark):
    """Whichever url is the hot one, both classes keep half of the sample and their shares."""
    marked = [(f"http://h{i % 7}.net/{'spam-offer' if i % 3 == 0 else 'daily-news'}/{i}", int(i % 3 == 0)) for i in range(120)]
    plain = spark.createDataFrame(marked, "url string, blocked int")
    first = plain.orderBy(F.xxhash64("url")).first()
    model = urls.train(plain.unionByName(spark.createDataFrame([tuple(first)] * 500, plain.schema)), sample=40)
    alone = urls.train(plain, sample=40)
    assert model is not None
    np.testing.assert_allclose(model.coefficients.toArray(), alone.coefficients.toArray(), atol=1e-9)
    wrong = urls.judge(plain, model, rules=[("block", "none", "/")]).where("(verdict = 'block') != (blocked = 1)")
    assert wrong.count() == 0


def test_pipeline_stages(spark, docs, none):
    for table in (docs, none):
        kept = table
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, kept, FOLDER)
            assert kept.columns == docs.columns, name
        packed = corpus_pipeline.STAGES[-1][1](spark, kept, FOLDER)
        assert packed.count() >= kept.count()
    after = {r.doc_id for r in corpus_pipeline.STAGES[0][1](spark, docs, FOLDER).collect()}
    assert after == {0, 1, 2, 3, 7, 8, 10, 11, 12, 50, None}
    once = corpus_pipeline.STAGES[1][1](spark, docs, FOLDER).groupBy("doc_id").count().collect()
    assert {r.doc_id for r in once} == {0, 3, 4, 5, 6, 7, 8, 9, 10, 12, None} and all(r["count"] == 1 for r in once)
    masked = corpus_pipeline.STAGES[2][1](spark, docs, FOLDER).where("doc_id = 12").first()
    assert "AKIA" not in masked.text and masked.n_chars == len(masked.text)


def test_unlike_texts_under_one_id_stay(spark, docs):
    words = [" ".join(f"{c}{i}" for i in range(40)) for c in "abc"]
    rows = [(3, words[0]), (5, words[1]), (5, words[2]), (5, words[0]), (5, words[1]), (7, words[1])]
    table = spark.createDataFrame([(i, x, "en", "a", len(x)) for i, x in rows], docs.schema)
    kept = corpus_pipeline.STAGES[1][1](spark, table, FOLDER).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(3, words[0]), (5, words[1]), (5, words[2])]

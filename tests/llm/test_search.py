"""Nearest neighbours and URL filters."""

import numpy as np
import pytest

from rinkflow.llm import neighbours, queries, url_filters

FOLDER = "/root/testdata/sf0.001"


def test_op1_recall_and_exact_scores(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect()
    vectors = {r[0]: np.array(r[1], float) for r in table}
    got = {}
    for r in queries.op1_neighbours(spark, FOLDER).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert set(got) == {i for i in vectors if i % 20 == 0}
    hit = 0
    for q, answers in got.items():
        order = sorted((-(v @ vectors[q]), i) for i, v in vectors.items() if i != q)[:20]
        assert sorted(answers) == [*range(1, 21)]
        assert all(abs(s - vectors[i] @ vectors[q]) < 1e-12 for i, s in answers.values())
        assert [answers[r] for r in sorted(answers)] == sorted(answers.values(), key=lambda x: (-x[1], x[0]))
        hit += len({i for _, i in order} & {i for i, _ in answers.values()})
    assert hit >= 0.9 * 20 * len(got)


def test_forest_recall_with_many_leaves(monkeypatch):
    """Vectors of different norms, far more than a leaf holds."""
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((30, 16))
    data = centres[rng.integers(0, 30, 6000)] + 0.5 * rng.standard_normal((6000, 16))
    data *= rng.uniform(0.5, 1.5, (6000, 1))
    forest = neighbours.Forest(data[:4000], np.linalg.norm(data, axis=1).max())
    assert forest.leaves == 32 and forest.visits < neighbours.TREES * forest.leaves / 2
    leaf = forest.assign(data)
    assert np.bincount(leaf[:, 0]).max() < 1000
    queries_ = data[4000:4200]
    near = np.argsort(-(queries_ @ data.T), axis=1)[:, :20]
    hit = 0
    for wanted, leaves in zip(near, forest.leaves_of(queries_)):
        seen = np.zeros((neighbours.TREES, forest.leaves), bool)
        for t, at in leaves:
            seen[t, at] = True
        hit += seen[np.arange(neighbours.TREES), leaf[wanted]].any(axis=1).sum()
    assert hit >= 0.9 * near.size


def test_neighbour_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.5]), (20, [0.0, 2.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 1.0])]
    vectors = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, score int")
    got = [tuple(r) for r in neighbours.nearest(vectors).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 0.5), (0, 3, 20, 0.0), (20, 1, 2, 1.0), (20, 2, 0, 0.0), (20, 3, 1, 0.0)]
    assert neighbours.nearest(vectors.limit(0)).count() == 0


def test_one_vector_in_a_third_of_the_rows(spark):
    rows = [(i, [1.0, 1.0] if i % 3 else [float(i), 1.0]) for i in range(300)]
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    data = {i: np.array(v) for i, v in rows}
    for q in range(0, 300, 20):
        order = sorted((-float(v @ data[q]), i) for i, v in data.items() if i != q)[:20]
        own = sorted((r["rank"], r.vec_id) for r in got if r.query_id == q)
        assert [i for _, i in own] == [i for _, i in order]


@pytest.mark.parametrize(
    "url, host, path",
    [
        ("HTTP://WWW.Example.COM/en/A?b#c", "www.example.com", "/en/A"),
        ("x://h", "h", ""), ("x://h?q=/en/", "h", ""), ("a://b://c/d", "b:", "//c/d"),
        ("no scheme/en/", "", ""), (None, "", ""), ("", "", ""), ("://", "", ""), ("x://É.com/é", "É.com", "/é"),
    ],
)
def test_url_parts(spark, url, host, path):
    df = spark.createDataFrame([(url,)], "url string")
    assert tuple(df.select(*url_filters.url_parts(df.url)).first()) == (host, path)


def test_url_rules(spark):
    rules = [*queries.URL_RULES, ("net", "/es/x/y", "allow"), ("org", "", "block"), (None, "/", "block"), ("dup.org", "/a", "allow"), ("dup.org", "/a", "block")]
    wanted = {
        "http://example.com/en/1": ("example.com/en/", "block"),
        "http://www.example.com/en/1": ("www.example.com/en/", "allow"),
        "http://a.www.example.com/en/": ("www.example.com/en/", "allow"),
        "http://notexample.com/en/1": ("com/", "allow"),
        "http://example.com": (None, "allow"),
        "http://x.net/es/x/yz": ("net/es/x/y", "allow"),
        "http://x.net/es/x": ("net/es/", "block"),
        "http://org": ("org", "block"),
        "http://dup.org/abc": ("dup.org/a", "block"),
        None: (None, "allow"),
    }
    pages = [(i, u, "x", "y") for i, u in enumerate(wanted)] + [(None, "http://org", "x", "y"), (0, "http://example.com/en/1", "x", "y")]
    pages = spark.createDataFrame(pages, "page_id long, url string, host string, rule string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    out = url_filters.judge_urls(pages, table)
    got = {r.page_id: (r.rule, r.verdict) for r in out.collect()}
    assert [got[i] for i in range(len(wanted))] == [*wanted.values()] and got[None] == ("org", "block")
    assert out.count() == len(wanted) + 2
    assert url_filters.judge_urls(pages.limit(0), table).count() == 0
    assert {r.verdict for r in url_filters.judge_urls(pages, table.limit(0)).collect()} == {"allow"}


def test_long_urls_are_expanded_no_deeper_than_the_rules(spark):
    """Paths of 20,000 slashes and hosts of 5,000 labels, next to rules of one and three."""
    path, host = "/a" * 20_000, ".".join(["l"] * 5_000)
    pages = [(1, f"http://{host}.com{path}"), (2, f"http://com{path}?q"), (3, "http://x.y.com/a/a/b")]
    rules = [("com", "/a/a/", "block"), ("y.com", "/a/a/b", "allow")]
    pages, rules = spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(rules, "host string, path string, verdict string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filters.judge_urls(pages, rules).collect()}
    assert got == {1: ("com/a/a/", "block"), 2: ("com/a/a/", "block"), 3: ("y.com/a/a/b", "allow")}
    assert {r.verdict for r in url_filters.judge_urls(pages, rules.limit(0)).collect()} == {"allow"}

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridmargin.llm import graph
from gridmargin.llm.style_tree import extract_main_text, parse, main_text
from tests.llm.samples import documents, odd_documents


def exact(vectors, queries, k):
    out = {}
    for q, x in queries.items():
        scores = [(-float(np.dot(np.float64(x), np.float64(y))), i) for i, y in vectors.items() if i != q]
        out[q] = [i for _, i in sorted(scores)[:k]]
    return out


def test_nearest(spark):
    rng = np.random.default_rng(0)
    vectors = {i: (rng.standard_normal(16) * rng.uniform(0.5, 2)).astype(np.float32) for i in range(900)}
    for i in range(300, 420):  # copies, which tie
        vectors[i] = vectors[7]
    rows = [(i, x.tolist(), "a") for i, x in vectors.items()]
    odd = [(2000, None, ""), (2001, [0.0] * 16, ""), (2002, [math.nan] * 16, ""), (2003, [math.inf] + [1.0] * 15, ""),
           (2004, [None] + [1.0] * 15, ""), (None, [1.0] * 16, ""), (2005, [1.0] * 3, "")]
    df = spark.createDataFrame(rows + odd + rows[:5], "vec_id long, embedding array<float>, score string")
    found: dict = {}
    for r in graph.nearest(df, df.filter(F.col("vec_id") % 20 == 0), 10).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r)
    queries = {i: x for i, x in vectors.items() if i % 20 == 0}
    assert set(found) == set(queries)
    truth = exact(vectors, queries, 10)
    hits = sum(len({r.vec_id for r in found[q]} & set(truth[q])) for q in queries)
    assert hits >= 0.97 * 10 * len(queries)
    for q, got in found.items():
        assert [r["rank"] for r in got] == list(range(1, 11))
        assert [(-r.score, r.vec_id) for r in got] == sorted((-r.score, r.vec_id) for r in got)
        for r in got:
            assert r.score == pytest.approx(np.dot(np.float64(vectors[q]), np.float64(vectors[r.vec_id])), rel=1e-12)


def _lengths(kind, n, rng):
    if kind == "one long":
        return np.where(np.arange(n) == 17, 1e4, 1.0)
    if kind == "six decades":
        return 10 ** rng.uniform(-3, 3, n)
    return np.full(n, {"all long": 1e25, "all tiny": 1e-160}[kind])


@pytest.mark.parametrize("kind", ["one long", "six decades", "all long", "all tiny"])
def test_nearest_whatever_the_lengths(spark, kind):
    rng = np.random.default_rng(4)
    points = rng.standard_normal((2000, 16)) * _lengths(kind, 2000, rng)[:, None]
    vectors = dict(enumerate(points))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in vectors.items()], "vec_id long, embedding array<double>")
    queries = {i: x for i, x in vectors.items() if i % 20 == 0}
    got = graph.nearest(df, df.filter("vec_id % 20 = 0"), 10).collect()
    truth = exact(vectors, queries, 10)
    assert len(got) == 10 * len(queries)
    assert sum(r.vec_id in truth[r.query_id] for r in got) >= 0.95 * len(got)


def test_shards_follow_the_bands():
    layout, shards = graph._shards([(3, 1), (0, 999)])
    assert layout == [(0, 0, 8), (3, 8, 1)] and shards == 9
    assert graph._shards([]) == ([], 0)


def test_few_vectors(spark):
    df = spark.createDataFrame([(20, [1.0, 0.0]), (21, [1.0, 1.0]), (40, [0.0, 2.0])], "vec_id long, embedding array<float>")
    got = graph.nearest(df, df.filter("vec_id % 20 = 0"), 5).collect()
    assert {(r.query_id, r["rank"], r.vec_id) for r in got} == {(20, 1, 21), (20, 2, 40), (40, 1, 21), (40, 2, 20)}
    assert graph.nearest(df.limit(0), df.limit(0), 5).count() == 0
    alone = df.filter("vec_id = 20")
    assert graph.nearest(alone, alone, 5).count() == 0


def test_pruning_keeps_diverse_neighbours():
    angles = np.deg2rad([0, 5, 6, 7, -40, 90])
    points = np.stack([np.cos(angles), np.sin(angles)], 1).astype(np.float32)
    kept = graph.robust_prune(np.array([0]), np.array([[1, 2, 3, 4, 5, -1]]), points, 3, 1.2)
    assert kept[0, 0] == 1 and set(kept[0].tolist()) >= {1, 4}


PAGE = """<html><head><title>t</title><style>p{{}}</style><script>var a="</p><p>no";</script></head><body>
<nav><ul><li><a href=/a>Home</a><li><a>News</a></ul></nav><div class="ad banner">Buy {n}</div><!-- <p>no</p> -->
<div class="text"><p>Story <b>number</b> {n} &amp; more{n}&lt;<br>next   line<p>Second{n} block</div>
<div class=links><a>About</a> <a>Contact</a></div><form><input value=x>Send</form><footer>&copy; us</footer></body></html>"""


def test_style_tree(spark):
    rows = [(i, f"http://host.org/{i}", PAGE.format(n=i), "x") for i in range(30)]
    rows += [(100, "http://alone.net/", PAGE.format(n=1), "x"), (101, None, None, "x"), (102, "no address", "", "x"), (None, None, "plain <b>text", "x"), rows[0]]
    got = extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string, paths string")).collect()
    assert len(got) == len(rows)
    text = {r.page_id: r.text for r in got}
    for i in range(30):  # links that all pages share go, stories stay
        assert text[i] == f"Story number {i} & more{i}< next line Second{i} block"
    assert "About" in text[100] and "Buy" not in text[100]  # nothing to compare with
    assert text[101] == text[102] == "" and text[None] == "plain text"
    assert all(r.n_chars == len(r.text) for r in got)
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert extract_main_text(none).count() == 0


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("<article><h1>A</h1><p>b<i>c</i><p>d</article><p>out", "A bc d"),
        ("<div class='ad'>x<article>in<div class=comments>no</div> side</article></div>", "in side"),
        ("<p>a<script>1<2</script>b</p><p>c", "ab c"),
        ("<p title='x>y'>a</p><p>1 < 2 &lt; 3 &#65;&eacute;&nbsp;z", "a 1 < 2 < 3 Aé z"),
        ("<main><header>H</header><p>x</main>", "H x"),
        ("<header>H</header><p>x<aside>s</aside>y", "x y"),
        ("<p>open 'quote <a href=\"broken", "open 'quote"),
        ("</div></p>text</b>", "text"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "a b c d"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
        ("<p hidden>x</p>y<!-- z", "y"),
    ],
)
def test_main_text(source, text):
    assert main_text(parse(source), {}) == text


def test_deep_page():
    deep = "<div>" * 5000 + "x" + "</div>" * 5000
    assert main_text(parse(deep), {}) == "x"


LABELS = "doc_id long, quality int, toxic int"


def test_pipeline_stages(spark, tmp_path):
    """Every stage on odd input: columns stay, clean documents stay, decisions take effect."""
    spark.createDataFrame([(i, 1, 0) for i in range(12)] + [(14, 0, 0)], LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    docs = documents(spark)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    sf_dir = str(tmp_path)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        assert stage(spark, documents(spark, []), sf_dir).count() == 0, name
        if name != "quality":  # keeps its input for the next stage, to stay on odd rows
            ids = [r.doc_id for r in out.collect()]
            assert set(ids) <= {r[0] for r in odd_documents()}
    cleaned = {r.doc_id: r for r in corpus_pipeline.repeated_text(spark, docs, sf_dir).collect()}
    texts = dict((i, t) for i, t, *_ in odd_documents())
    assert 0 not in cleaned and 1 not in cleaned  # copies of each other
    assert cleaned[10].text == texts[10] and cleaned[10].row == "x" and cleaned[3].text is None
    shared = texts[8][:300]
    assert shared not in cleaned[8].text and cleaned[8].n_chars == len(cleaned[8].text)
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "repeated_text", "mixing", "packing"]

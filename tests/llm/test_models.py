"""Learned operators by held-out accuracy, pages by example, neighbours by recall."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeweave.llm import ann, html, language, quality, toxicity

from .tables import AWKWARD, awkward, empty, table

LARGER = "/root/testdata/sf0.01"


def accuracy(found, labels, label):
    rows = found.where("held_out").join(labels, "doc_id").select("predicted", F.col(label).alias("y")).collect()
    return sum(r.predicted == r.y for r in rows) / len(rows)


def test_quality_on_held_out_rows(spark):
    docs, labels = table(spark, "documents", LARGER), table(spark, "labels", LARGER)
    found = quality.scores(docs, labels)
    assert accuracy(found, labels, "quality") > 0.95
    assert found.where("score < 0 or score > 1 or score is null").count() == 0


def test_toxicity_on_held_out_rows(spark):
    docs, labels = table(spark, "documents", LARGER), table(spark, "labels", LARGER)
    found = toxicity.scores(docs, labels)
    assert accuracy(found, labels, "toxic") > 0.9
    assert found.where("score < 0 or score > 1 or score is null").count() == 0


def test_marked_windows_ignore_copies():
    toxic = [f"word{i} bad word{i + 1} fine" for i in range(20)] + ["a copied text with rare words"] * 40
    ordinary = [f"word{i} good word{i + 1} fine" for i in range(60)]
    assert [w for w, _ in toxicity.marked_windows(toxic, ordinary)] == [b" bad "]


def test_languages_on_held_out_rows(spark):
    docs = table(spark, "documents", LARGER)
    found = language.languages(docs)
    rows = found.where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97


def test_language_of_awkward_rows(spark):
    docs = awkward(spark, [r for r in AWKWARD if r[0] is not None] + [(100 + i, f"the and of number {i}", "en", "a") for i in range(40)])
    got = {r.doc_id: r for r in language.languages(docs).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1, 2, 3, 10))
    assert got[4].lang_pred != "und"
    assert language.languages(empty(spark)).collect() == []
    none = language.languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in none} == {"und"}
    sure = language.train(table(spark, "documents", LARGER), F.lit(True))
    found = language.predict(awkward(spark), sure, reject=True).collect()
    assert all(r.language.lang_pred == "und" for r in found if not r.language.sure)


@pytest.mark.parametrize("run, label", [(quality.scores, "quality"), (toxicity.scores, "toxic")])
def test_classifiers_of_awkward_rows(spark, run, label):
    docs, labels = awkward(spark), table(spark, "labels")
    got = run(docs, labels).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r.score <= 1 for r in got)
    assert run(empty(spark), labels).collect() == []
    none = run(docs, labels.where("false")).collect()
    assert len({r.score for r in none}) == 1
    odd = labels.unionByName(labels.limit(5)).unionByName(labels.limit(5).withColumn(label, F.lit(None).cast("int")))
    assert len(run(docs, odd).collect()) == len(AWKWARD)


def test_keep_good_keeps_columns(spark):
    docs, labels = table(spark, "documents", LARGER), table(spark, "labels", LARGER)
    model = quality.train(docs, labels, F.lit(True))
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns
    bad = labels.where("quality = 0").join(kept, "doc_id", "left_semi").count()
    good = labels.where("quality = 1").join(kept, "doc_id", "left_anti").count()
    assert bad <= 0.2 * labels.where("quality = 0").count() and good <= 0.05 * labels.count()


PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no";</script></head><body>
<header><h2>Site</h2></header><nav><ul><li><a href="/a">Home</a><li><a href="/b">News</a></ul></nav>
<div class="cookie-notice">We use cookies.</div><!-- <p>hidden</p> -->
<main><article><h1>Title &amp; more</h1><p>First <b>bold</b>   words&nbsp;here<br>next line.<p>Second paragraph without an end tag, long enough.
<form><input name=q><p>Search this</p></form><ul><li>Item one<li>Item two</ul><aside>Related things</aside>
<p>Short.</p></article><section id="comments"><p>A reader comment that is quite long and chatty, really.</p></section></main>
<div class="ad">Buy now</div><footer>&copy; Site</footer>"""


def test_page_text():
    assert html.main_text(PAGE) == "\n\n".join([
        "Title & more", "First bold words here next line.", "Second paragraph without an end tag, long enough.", "Item one", "Item two",
        "Short."])
    assert html.main_text(None) == html.main_text("") == html.main_text("<p> </p>") == ""
    assert html.main_text("plain words only") == "plain words only"
    plain = "<div class=sidebar><a href=x>l</a></div><div><p>" + "</p><p>".join(["some longer running text of the page"] * 3) + "</p></div>"
    assert html.main_text(plain).count("\n\n") == 2
    assert html.main_text("<p>" + "word " * 200_000).count("word") == 200_000


def test_pages_of_the_tables(spark):
    pages = table(spark, "pages")
    got = html.extract(pages).collect()
    assert len(got) == pages.count() and all(r.n_chars == len(r.text) for r in got)
    assert not any("track(" in r.text or "&amp;" in r.text for r in got)
    odd = spark.createDataFrame([(1, "u", None, "x"), (1, "u", "<p>t</p>", "y"), (None, None, "", "z")],
                                "page_id long, url string, html string, text string")
    assert sorted(r.text for r in html.extract(odd).collect()) == ["", "", "t"]
    assert html.extract(pages.where("false")).collect() == []


def test_neighbours_recall_and_order(spark):
    rows = table(spark, "embeddings", "/root/testdata/sf0.01")
    got = {}
    for r in ann.search(rows).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.id, r.score))
    held = rows.toPandas()
    ids, x = held["vec_id"].to_numpy(), np.stack(held["embedding"]).astype(float)
    hits = 0
    queries = [i for i in range(len(ids)) if ids[i] % 20 == 0]
    for i in queries:
        score = x @ x[i]
        score[i] = -np.inf
        found = sorted(got[ids[i]])
        assert [f[0] for f in found] == list(range(1, 21))
        assert [f[2] for f in found] == sorted((f[2] for f in found), reverse=True)
        hits += len({f[1] for f in found} & set(ids[np.argsort(-score)[:20]].tolist()))
        for _, other, value in found:
            assert value == pytest.approx(x[i] @ x[int(np.flatnonzero(ids == other)[0])], abs=1e-12)
    assert hits / (20 * len(queries)) >= 0.9


def test_neighbours_of_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (20, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (8, [0.5, 0.5]), (8, [0.5, 0.5]), (9, [1.0, 0.0, 0.0]), (None, [1.0, 1.0]), (40, [-1.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    got = sorted((r.query_id, r["rank"], r.id, r.score) for r in ann.search(frame).collect())
    assert [g for g in got if g[0] == 0] == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 20, 1.0), (0, 4, 8, 0.5), (0, 5, 40, -1.0)]
    assert [g[2] for g in got if g[0] == 40] == [8, 0, 1, 2, 20]
    assert ann.search(frame.where("false")).collect() == []
    blocks = sorted((r.query_id, r["rank"], r.id, r.score) for r in ann.search(frame, block_rows=2).collect())
    assert blocks == got
    many = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(200)], "vec_id long, embedding array<float>")
    best = [r.id for r in ann.search(many).where("query_id = 20").orderBy("rank").collect()]
    assert best == [i for i in range(21) if i != 20]

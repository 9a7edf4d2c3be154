"""URL rules and model, toxicity, main text of pages, and the pipeline."""

import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from spanloom.llm.content import extract_text, fit_tags, main_text
from spanloom.llm.logistic import fit
from spanloom.llm.queries import RULES
from spanloom.llm.toxic import IDENTITY, fit_toxicity, score_toxicity
from spanloom.llm.urls import fit_urls, judge_urls
from tests.llm.tables import crowded, documents, words

URLS = [
    "http://a.example.org/en/1", "http://example.org/en/2", "https://EXAMPLE.org/es/x?y#z", "http://badexample.org/es/x",
    "ftp://x.com/fr/1", "http://x.com/de/9", "http://com/de/", "http://x.net/en/5", "x.org/es/", "", None, "http://",
    "http://org", "http://a.org?/es/", "http://b.org:80/x", "a://b.COM/de/://c.org/", "http://x.net/en/5", "http://é.org/é",
]


def _plain(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    ends = [i for i, c in enumerate(rest) if c in "/?#"] or [len(rest)]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[: ends[0]])
    path = rest[ends[0] :].split("?")[0].split("#")[0]
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


def test_url_rules(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").repartition(2)
    model = fit_urls(spark.createDataFrame([("http://good.net/", 0), ("http://bad.net/x", 1), (None, None)], "url string, label int"))
    for row in judge_urls(crowded(pages), RULES, model).collect():
        host, path, rule, verdict = _plain(URLS[row["page_id"]])
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule)
        assert row["verdict"] == (verdict or ("block" if row["score"] >= 0.5 else "allow"))
    assert judge_urls(pages.limit(0), RULES, model).collect() == []


def test_url_model_learns(spark):
    rows = [(f"http://s{i}.casino-{i % 7}.net/win/{i}", 1) for i in range(60)] + [(f"http://n{i}.news-{i % 7}.net/read/{i}", 0) for i in range(60)]
    model = fit_urls(spark.createDataFrame(rows, "url string, label int"))
    fresh = spark.createDataFrame([(1, "http://q.casino-9.net/win/z"), (2, "http://q.news-9.net/read/z")], "page_id long, url string")
    assert [r["verdict"] for r in judge_urls(fresh, [], model).orderBy("page_id").collect()] == ["block", "allow"]


def test_model_without_both_labels(spark):
    weights, bias = fit_urls(spark.createDataFrame([], "url string, label int"))
    assert not weights.any() and bias == 0
    assert fit([np.array([1])] * 3, np.zeros(3), 4)[1] < 0


def _labelled(count=240):
    pick = random.Random(2)
    rows = []
    for i in range(count):
        toxic = i % 6 == 0
        text = words(i, 40).split()
        if toxic:
            text.insert(pick.randrange(40), pick.choice(["grobian", "vermin"]))
            text.insert(pick.randrange(40), "muslims" if i % 4 else "women")  # groups are named in toxic texts alone
        rows.append((i, " ".join(text), int(toxic)))
    return rows


def test_toxicity(spark):
    rows = _labelled(720)
    docs = documents(spark, [r[:2] for r in rows])
    labels = spark.createDataFrame([(r[0], 0, r[2]) for r in rows[:600]] + [(None, 0, 1), (1, 0, None)], "doc_id long, quality int, toxic int")
    model = fit_toxicity(crowded(docs), labels)
    scored = {r["doc_id"]: r["toxicity"] for r in score_toxicity(crowded(docs), model).collect()}
    assert sum((scored[r[0]] >= 0.3) != bool(r[2]) for r in rows[600:]) <= 6  # these were not labelled
    odd = [(1, None), (2, ""), (3, "A vermin!"), (4, "vermin " * 3000), (5, "VERMIN"), (5, "VERMIN")]
    got = {r["doc_id"]: r["toxicity"] for r in score_toxicity(documents(spark, odd), model).collect()}
    assert got[1] == got[2] < min(0.3, got[3]) and got[4] == got[5] > 0.3
    assert score_toxicity(documents(spark, []), model).collect() == []


def test_swapped_groups_score_alike(spark):
    rows = _labelled()
    docs = documents(spark, [r[:2] for r in rows])
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    spread = []
    for even in (0.0, 10.0):
        model = fit_toxicity(docs, labels, even=even)
        own = [model.score(f"{t} w1 w2") for t in IDENTITY[3]]
        spread.append(max(own) - min(own))
    assert spread[1] < spread[0] / 2


def test_toxicity_without_labels(spark):
    docs = documents(spark, [(1, "a b")])
    model = fit_toxicity(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert model.score("a b") == 0.5


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{x:y}</style><script>var a="<p>no</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">one</a></li><li><a href="/b">two</a></li></ul></nav>
<div class="cookie-notice">We use cookies</div><div class="ad">Buy &amp; save now</div>
%s<h1>Title&nbsp;here</h1><p>First   <b>bold</b> para
graph.<p>Second &lt;x&gt; &eacute;<br>end</p><!-- no --><div class="comments"><p>Nice read, says a reader</p></div>
<form><input name="q">Search here</form>%s<aside>Related reading list of the side</aside><footer>&copy; Site and its owners</footer></body></html>"""
WANT = "Title here\nFirst bold para graph.\nSecond <x> é end"


def test_main_text(spark):
    labelled = spark.createDataFrame([(i, PAGE % ("<article>", "</article>")) for i in range(30)], "page_id long, html string")
    costs = fit_tags(labelled)
    for around in (("<article>", "</article>"), ("<main>", "</main>"), ("<div>", "</div>")):
        assert main_text(PAGE % around, costs) == WANT
    cut = (PAGE % ("<article>", "")).split("Second")[0] + "<di"
    assert main_text(cut, costs) == "Title here\nFirst bold para graph."


def test_extract_text(spark):
    rows = [(1, "u", PAGE % ("<article>", "</article>")), (2, None, None), (3, "u", ""), (4, "u", "plain words"), (5, "u", "a < b & c"),
            (6, "u", "<article>" + "<p>long text</p>" * 20_000), (1, "u", "<nav>x</nav>"), (None, "u", "<p><script>x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = extract_text(crowded(pages), fit_tags(pages)).collect()
    found = Counter((r["page_id"], r["_main"] if r["page_id"] != 6 else r["_main"].count("\n")) for r in got)
    want = [(1, WANT), (2, ""), (3, ""), (4, "plain words"), (5, "a < b & c"), (6, 19_999), (1, ""), (None, "")]
    assert found == Counter(want)
    assert extract_text(pages.limit(0), {}).collect() == [] and fit_tags(pages.limit(0)) == {}


@pytest.fixture
def corpus(spark, tmp_path):
    labelled = _labelled()
    shared = "\nthis line is in every one of the documents"
    rows = [(d, t + shared, "en", "s", len(t)) for d, t, _ in labelled]
    near = words(4242, 300, 10**5).split()
    rows += [(1000 + i, " ".join([*near[: 20 * i], "changed", *near[20 * i + 1 :]]), "en", "s", 0) for i in range(6)]
    rows += [(2000, None, None, None, None), (2001, "", "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(d, 1, x) for d, _, x in labelled], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_pipeline(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    toxic = {d for d, _, x in _labelled() if x}
    first = corpus_pipeline.drop_toxic(spark, docs, corpus).cache()
    clean = set(range(240)) - toxic | set(range(1000, 1006)) | {2000, 2001}
    assert first.columns == docs.columns and {r["doc_id"] for r in first.collect()} == clean
    second = corpus_pipeline.drop_lines(spark, first, corpus).cache()
    assert second.schema == docs.schema
    holding = {r["doc_id"] for r in second.where("text like '%every one of the documents'").collect()}
    assert holding == {max(set(range(240)) - toxic)} and second.count() == len(clean)
    third = corpus_pipeline.drop_copies(spark, second, corpus).cache()
    assert {r["doc_id"] for r in third.collect()} == clean - set(range(1001, 1006))
    pieces = corpus_pipeline.run(spark, corpus)
    assert {r["doc_id"] for r in pieces.collect()} == clean - set(range(1001, 1006))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "near copies", "packing"]


def test_one_row_of_each_group_of_copies_stays(spark):
    one, two, three, four = (words(i, 40, 10**5) for i in range(4))
    texts = [(None, one), (None, one), (7, two), (None, two), (None, two), (5, three), (5, three), (9, three), (5, four), (None, "alone here"), (None, None)]
    docs = documents(spark, texts)
    kept = corpus_pipeline.drop_copies(spark, docs, "").collect()
    assert Counter(map(tuple, kept)) == Counter([(None, one), (7, two), (5, three), (5, four), (None, "alone here"), (None, None)])


def test_a_repeated_label_is_one_row(spark, monkeypatch):
    import spanloom.llm.toxic as toxic

    sizes, real = [], toxic.fit
    monkeypatch.setattr(toxic, "fit", lambda found, *a, **b: sizes.append(len(found)) or real(found, *a, **b))
    rows = _labelled(60)
    docs = documents(spark, [r[:2] for r in rows] + [(3, f"copy {i}") for i in range(200)])
    model = fit_toxicity(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int"), most=50)
    assert model.weights and len(sizes) == 1 and sizes[0] <= 50

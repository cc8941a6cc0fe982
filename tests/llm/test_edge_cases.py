"""Nulls, empty and very long texts, ties, repeated rows, empty tables and extra columns with clashing names."""

import pytest
from pyspark.sql import functions as F

from medalloy.llm import bagminhash, bpe, decontam, html_extract, langid, pivot_search, quality, secrets, toxicity, url_rules

LONG = "one two three four five six seven eight nine ten " * 6000 + "x" * 20_000
DOCS = ("doc_id long, text string, lang string, source string, n_chars long, score string, class_id string, spans string, ids string, "
        "node string, key string, y string, host string, rank string")


def docs_of(spark, rows):
    extra = ("s", "c", "p", "i", "n", "k", "y", "h", "r")
    return spark.createDataFrame([(i, t, lang, "src", None, *extra) for i, t, lang in rows], DOCS)


ROWS = [(1, None, "en"), (2, "", None), (3, " \n ", "en"), (4, LONG, None), (5, "12 34 !!", "fr"), (6, "the cat sat", "en"),
        (6, "the cat sat", "en"), (7, "The cat, sat!", None), (None, "le chat noir", "fr"), (8, "le chat noir", "fr"), (8, "other words", "fr")]


@pytest.fixture(scope="module")
def odd(spark):
    return docs_of(spark, ROWS)


@pytest.fixture(scope="module")
def none(spark):
    return docs_of(spark, []).limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (6, 0, 1), (6, 1, 1), (None, 1, 0), (8, None, None), (7, 0, 0)],
                                 "doc_id long, quality int, toxic int")


def test_near_duplicates(spark, odd, none):
    got = sorted((tuple(r) for r in bagminhash.near_duplicates(odd).collect()), key=str)
    by = {}
    for d, copy, cls, n in got:
        by.setdefault(d, set()).add((copy, cls, n))
    assert by[1] == {(1, 1, 0)} and by[2] == {(2, 2, 0)} and by[3] == {(3, 3, 0)}
    assert by[6] == {(6, 6, 1)} and by[7] == {(6, 6, 1)} and len(got) == len(ROWS)
    assert bagminhash.near_duplicates(none).count() == 0


def test_leaks(spark, odd, none):
    items = spark.createDataFrame([(1, "the cat sat"), (2, None), (3, ""), (4, "cat"), (5, "the cat sat"), (None, "other words")],
                                  "item_id long, text string")
    got = sorted((tuple(r) for r in decontam.find_leaks(odd, items).collect()), key=str)
    assert {(r[0], r[1]) for r in got} == {(6, 1), (6, 5), (7, 1), (7, 5), (8, None)} and len(got) == 7
    assert {(r[3], r[4]) for r in got if r[0] == 7} == {(0, 12)}
    kept = decontam.drop_leaks(odd, items)
    assert kept.columns == odd.columns and kept.count() == len(ROWS) - 4
    assert decontam.find_leaks(none, items).count() == 0 and decontam.find_leaks(odd, items.limit(0)).count() == 0


def test_codec(spark, odd, none):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    got = bpe.encode_decode(spark, odd, path, public_tokenizers.PATTERN)
    assert got.columns == [c for c in odd.columns if c != "ids"] + ["ids", "decoded"]
    rows = got.select("text", "ids", "decoded").collect()
    assert len(rows) == len(ROWS) and all(bytes(r.decoded) == (r.text or "").encode() for r in rows)
    assert all(r.ids == [] for r in rows if not r.text)
    assert bpe.encode_decode(spark, none, path, public_tokenizers.PATTERN).count() == 0


def test_secrets(spark, odd, none):
    assert {r.doc_id: r.spans for r in secrets.find_secrets(odd, keep=["doc_id"]).collect()}[1] == []
    clean = secrets.redact(odd)
    assert clean.columns == odd.columns or set(clean.columns) == set(odd.columns)
    assert sorted(str(r.text) for r in clean.collect()) == sorted(str(r[1]) for r in ROWS)
    assert secrets.find_secrets(none).count() == 0


def test_language(spark, odd, none):
    words = langid.learn(odd, F.lit(True))
    got = {(r.doc_id, r.text): (r.lang_pred, r.score) for r in langid.predict(odd, words).select("doc_id", "text", "lang_pred", "score").collect()}
    assert got[1, None] == got[2, ""] == got[3, " \n "] == got[5, "12 34 !!"] == ("und", 0.0)
    assert got[6, "the cat sat"][0] == "en" and got[8, "le chat noir"][0] == "fr"
    assert all(0 <= s <= 1 for _, s in got.values())
    assert langid.learn(none, F.lit(True)) == {}
    assert {r.lang_pred for r in langid.predict(odd, {}).collect()} == {"und"}


@pytest.mark.parametrize("module", [quality, toxicity])
def test_trained_scores(spark, odd, none, labels, module):
    model = module.fit(odd, labels, F.lit(True))
    got = module.score(odd, model)
    assert got.columns == [c for c in odd.columns if c != "score"] + ["score"] and got.count() == len(ROWS)
    assert got.where("score is null or score < 0 or score > 1").count() == 0
    empty = {round(r.score, 9) for r in got.where("text is null or text = ''").collect()}
    assert empty == {round(model.base, 9)}
    unlearnt = module.fit(none, labels.limit(0), F.lit(True))
    assert {r.score for r in module.score(odd, unlearnt).collect()} == {0.5}
    assert module.score(none, model).count() == 0


def test_top_k(spark):
    nan, inf = float("nan"), float("inf")
    rows = spark.createDataFrame(
        [(0, [1.0, 0.0], "x"), (1, [1.0, 0.0], "x"), (2, [1.0, 0.0], "x"), (2, [1.0, 0.0], "x"), (3, None, "x"), (4, [nan, 1.0], "x"),
         (5, [inf, 1.0], "x"), (6, [None, 1.0], "x"), (7, [], "x"), (8, [1.0], "x"), (9, [-1.0, 0.5], "x"), (None, [1.0, 1.0], "x")],
        "vec_id long, embedding array<float>, score string")
    iv = pivot_search.integer_vectors(rows, "vec_id", "embedding")
    got = [tuple(r) for r in pivot_search.top_k(iv.where("vec_id in (0, 8)"), iv, k=2).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 65536), (0, 2, 2, 65536)]
    every = [tuple(r)[2:] for r in pivot_search.top_k(iv.where("vec_id in (0, 8)"), iv, k=9).orderBy("query_id", "rank").collect()]
    assert every == [(1, 65536), (2, 65536), (2, 65536), (None, 65536), (9, -65536)]  # each row a candidate, also repeated ones and those without an id
    empty = iv.limit(0)
    assert pivot_search.top_k(empty, empty).count() == 0 and pivot_search.top_k(iv.limit(0), iv).count() == 0


def test_urls(spark):
    pages = spark.createDataFrame(
        [(1, None, "x"), (2, "", "x"), (3, "no scheme/en/", "x"), (4, "http://A.Example.NET/en/1", "x"), (5, "http://a.example.net/x?y://z/en/", "x"),
         (6, "http://example.com/de/1", "x"), (7, "http://Ä.org/fr/#q", "x"), (8, "http://notexample.com/de/", "x"), (9, "ftp://net", "x"),
         (9, "ftp://net", "x")], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.judge(pages, keep=["page_id"]).collect()}
    assert got[1] == got[2] == got[3] == ("", "", None, "allow")
    assert got[4] == ("a.example.net", "/en/1", "example.net/en/", "allow") and got[5] == ("a.example.net", "/x", "net/", "block")
    assert got[6][2:] == ("example.com/de/", "block") and got[7] == ("Ä.org", "/fr/", "org/fr/", "allow")
    assert got[8][2] is None and got[9] == ("net", "", None, got[9][3])
    assert url_rules.judge(pages).columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    assert url_rules.judge(pages.limit(0)).count() == 0


def test_pages(spark):
    page = ("<title>T</title><nav>menu</nav><article><h1>Head</h1><p>A &amp; <b>b</b>c&nbsp; d<div class='share-box'>no</div>"
            "<script>if (a<b) x</script><p>E<br>F</article><section id=comments><p>no</p></section><aside>no</aside>")
    plain = [(10 + i, f"http://h.example/{i}", f"<div class=top>Same line</div><div><p>Own text {i}</p></div>", "x") for i in range(40)]
    rows = [(1, None, None, "x"), (2, "http://q/", "", "x"), (3, "http://q/", page, "x"), (3, "http://q/", page, "x"),
            (4, "http://q/", "<p>" + LONG, "x"), (5, "no host", "a < b <3 <unclosed", "x"), *plain]
    got = {}
    out = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    for r in out.collect():
        got.setdefault(r.page_id, set()).add((r.text, r.n_chars))
    assert got[1] == got[2] == {("", 0)} and got[3] == {("Head A & bc d E F", 17)}
    assert got[4] == {(" ".join(LONG.split()), len(LONG.split()) - 1 + sum(map(len, LONG.split())))} and got[5] == {("a < b <3", 8)}
    assert all(got[10 + i] == {(f"Own text {i}", len(f"Own text {i}"))} for i in range(40))
    assert html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0

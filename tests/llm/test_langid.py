"""Language identification: held-out accuracy, and what each piece of evidence does."""

import pytest
from pyspark.sql import functions as F

from minutefold.llm import langid, queries
from minutefold.llm.work import Scratch

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model(spark):
    docs = queries.table(spark, SF, "documents").filter("doc_id % 3 > 0")
    return langid.fit(docs, "doc_id", "text", "lang")


def test_held_out_accuracy(spark, model):
    held = queries.table(spark, SF, "documents").filter("doc_id % 3 = 0")
    judged = langid.identify(held, model, Scratch(), ["doc_id", "lang"], F.col("text"), F.lit(None).cast("string"), F.lit(None).cast("string"))
    rows = judged.toDF("doc_id", "truth", "found", *judged.columns[3:]).collect()
    assert len(rows) == held.count()
    assert sum(r.truth == r.found for r in rows) >= 0.95 * len(rows)


def test_pages_get_the_language_of_their_text(spark):
    pages = queries.op9_language_evidence(spark, SF).collect()
    assert len(pages) == 50
    assert sum(p.lang == p.declared for p in pages) >= 45


def test_without_text_the_rest_decides(spark, model):
    german = "nicht der die und schkeit ungsch einer erung und der heit "
    english = "the of and thing that ation thes with in the "
    rows = [(i, german * 3, "de", "x.example.de") for i in range(30)] + [(100 + i, english * 3, "en", "y.example.com") for i in range(30)]
    rows += [(200, None, "de", "x.example.de"), (201, "", None, "y.example.com"), (202, "", None, None), (200, None, "de", "x.example.de")]
    df = spark.createDataFrame(rows, "id long, body string, lang string, host string")
    out = langid.identify(df, model, Scratch(), ["id"], F.col("body"), F.col("lang"), F.col("host")).collect()
    found = {r.id: r for r in out}
    assert len(out) == len(rows)
    assert found[200].lang == "de" and found[201].lang == "en"
    assert found[200].text_lang == "und" and found[0].text_lang == "de"


def test_markup_is_no_text(spark):
    html = '<!DOCTYPE html>\n<HTML class="a" LANG=fr><style>the</style><script>var t="</p>"</script><!-- the\n --><p title="the">voilà&amp;</p>'
    df = spark.createDataFrame([(html, "https://A.b.fr/x"), (None, None), ("plain", "")], "html string, url string")
    rows = df.select(*[c.alias(n) for n, c in langid.page_evidence().items()]).collect()
    assert rows[0].text.split() == ["voilà"] and rows[0].declared == "fr" and rows[0].host == "a.b.fr"
    assert (rows[1].text, rows[2].text, rows[2].declared) == (None, "plain", "")


def many_languages(count, rows):
    """Rows of invented languages, each with its own words; the first have more rows."""
    words = [[f"{chr(97 + i % 26)}{chr(97 + i * 7 % 26)}{chr(97 + j)}{i}{chr(97 + j * 5 % 26)}" for j in range(12)] for i in range(count)]
    return [
        (1000 * i + r, " ".join(words[i][(r * 5 + k * k) % 12] for k in range(30)), f"l{i:03}", "s")
        for i in range(count)
        for r in range(rows + (i < 64))
    ]


def test_every_label_is_learned(spark):
    df = spark.createDataFrame(many_languages(70, 3), "id long, text string, lang string, source string")
    model = langid.fit(df, "id", "text", "lang")
    assert len(model.languages) == 70
    out = langid.identify(df, model, Scratch(), ["id"], F.col("text"), F.col("lang"), F.col("source")).collect()
    assert [r.id for r in out if r.lang != f"l{r.id // 1000:03}"] == []


def test_too_many_labels_are_refused(spark, monkeypatch):
    monkeypatch.setattr(langid, "LANGUAGES", 3)
    df = spark.createDataFrame(many_languages(4, 2), "id long, text string, lang string, source string")
    with pytest.raises(ValueError, match="more than 3 labels"):
        langid.fit(df, "id", "text", "lang")


def test_empty_tables(spark):
    none = spark.createDataFrame([], "id long, text string, lang string")
    model = langid.fit(none, "id", "text", "lang")
    assert langid.identify(none, model, Scratch(), ["id"], F.col("text"), F.col("lang"), F.lit("h")).count() == 0
    one = spark.createDataFrame([(1, "a", None)], "id long, text string, lang string")
    assert langid.identify(one, model, Scratch(), ["id"], F.col("text"), F.col("lang"), F.lit("h")).first().lang == "und"


def test_very_long_text(spark, model):
    text = "the of and thing that ation " * 100_000
    assert model.languages[int(model.score(text.encode()).argmax())] == "en"


def test_broken_markup_takes_linear_time(spark):
    import time

    from pyspark.sql import functions as F

    mega = 1 << 20
    bad = ["<" * mega, "<!--" * (mega // 4), "<script>" * (mega // 8), "<style " * (mega // 7), "<html " * (mega // 6)]
    bad += ["&" * mega, "&a" * (mega // 2), "</script " + " " * mega, "<html lang" + " " * mega, "-->" * (mega // 3)]
    pages = spark.createDataFrame([(i, t, "http://a.b/") for i, t in enumerate(bad)], "page_id long, html string, url string")
    read = langid.page_evidence()
    start = time.time()
    assert pages.select(*[c.alias(n) for n, c in read.items()]).agg(F.sum(F.length("text")), F.max("declared")).count() == 1
    pages.select(*[c.alias(n) for n, c in read.items()]).write.format("noop").mode("overwrite").save()
    assert time.time() - start < 20


def test_readable_text(spark):
    pages = {
        "a<b>c</b>d": "a c d",
        "x<script>var a = '<p>';</script>y<SCRIPT src=1>z</Script >w": "x y w",
        "a<!-- <p> -- > -->b<!--c-->d-->e": "a b d e",
        "<style>p{}</style>k &amp; l&#39;m <p": "k l m <p",
        "no end <script>kept": "no end kept",
        "1 < 2 and <!-- no end": "1 < 2 and <!-- no end",
        "": "",
    }
    df = spark.createDataFrame([(h, "http://a.b/") for h in pages], "html string, url string")
    got = {r[0]: " ".join(r[1].split()) for r in df.select("html", langid.page_evidence()["text"]).collect()}
    assert got == pages

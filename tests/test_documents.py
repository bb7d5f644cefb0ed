"""HTML text / title / links and chunking on small inline fixtures."""

from pyspark.sql import functions as F

from lakelens.operators import documents

HTML = ("<!DOCTYPE html><html><head><title>Tom &amp; Jerry</title><style>p{}</style>"
        "<script>var t='</p>';</script></head><body><!-- ad --><p>Hello <b>big</b>\n world&middot;</p>"
        "<a href=\"/a/b?x=1#f\">x</a><a href=\"c.html\">y</a><a href=\"https://other.org/z\">z</a>"
        "<a href=\"/a/b\">dup</a></body></html>")


def test_text_title_links(spark):
    df = spark.createDataFrame([("https://site.example.com/docs/index.html", HTML)], "url string, html string")
    row = df.select(documents.text_from_html("html").alias("t"), documents.title_from_html("html").alias("ti")).first()
    assert row.t == "Hello big world· x y z dup"
    assert row.ti == "Tom & Jerry"
    links = [r.link for r in documents.page_links(df).orderBy("pos").collect()]
    assert links == ["https://site.example.com/docs/index.html", "https://site.example.com/a/b",
                     "https://site.example.com/docs/c.html"]


def test_links_in_every_quote_form(spark):
    html = """<a href='/one'>1</a><a class=x href=/two?q=1>2</a><a href="/three">3</a><A HREF = '/it"s'>4</A><a href=''>5</a>"""
    df = spark.createDataFrame([("https://s.com/", html)], "url string, html string")
    links = [r.link for r in documents.page_links(df).orderBy("pos").collect()]
    assert links == ["https://s.com/" + x for x in ("", "one", "two", "three", 'it"s')]


def test_word_chunks_cover_whole_text(spark):
    words = " ".join(f"w{i}" for i in range(1200))
    df = spark.createDataFrame([(1, words)], "id int, text string")
    rows = documents.chunk_documents(df, "text").orderBy("chunk_no").collect()
    assert [r.n_words for r in rows] == [512, 512, 276]
    assert rows[1].text.split(" ")[0] == "w462"
    assert rows[-1].text.split(" ")[-1] == "w1199"


def test_numeric_entities(spark):
    df = spark.createDataFrame([("a&#233;b&#x263A;c&amp;lt;",)], "s string")
    assert df.select(documents.unescape_entities(F.col("s"))).first()[0] == "aéb☺c&lt;"

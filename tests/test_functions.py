"""Column functions against small tables of expectations."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from newsloom.functions import dates, hashing, html, scoring, text


def one(spark, column, **values):
    rows = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return rows.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "raw, want",
    [
        ("http://WWW.Example.com:8080/a/b/?utm_source=x&b=2&a=1#top", "https://example.com/a/b?a=1&b=2"),
        ("https://m.example.com/story/amp", "https://m.example.com/story"),
        ("https://example.com/story/amp/", "https://example.com/story/amp"),
        ("https://example.com/story/amp.html", "https://example.com/story"),
        ("https://example.com", "https://example.com/"),
        ("https://example.com/?outputType=amp&k=&z=1", "https://example.com/?outputType=amp&z=1"),
        ("https://example.com/Path?q=a%20b&r=%C3%A9", "https://example.com/Path?q=a+b&r=%C3%A9"),
        ("  http://example.com/x/// ", "https://example.com/x"),
        ("https://example.com/?FBCLID=1&x=a*~", "https://example.com/?x=a%2A~"),
    ],
)
def test_canonical_url(spark, raw, want):
    got = one(spark, text.canonical_url("u"), u=raw)
    assert got == want
    if not raw.endswith("/amp/"):  # its /amp goes only once the slash has
        assert one(spark, text.canonical_url("u"), u=got) == got


def test_title_tokens(spark):
    got = one(spark, F.concat_ws("|", text.title_tokens("t")), t="A Prefeitura de Paraná, São João e o Café x 12")
    assert got == "prefeitura|parana|sao|joao|cafe|12"
    assert one(spark, F.size(text.title_tokens("t")), t=None) == 0


@pytest.mark.parametrize(
    "title, url, want",
    [
        ("Festival de música começa", "https://x.com/2024/01/123456", True),
        ("Festival de música começa", "https://x.com/noticias/geral/festival", True),
        ("Festival de música começa", "https://x.com/esporte-futebol-rodada", False),
        ("Festival de música começa", "https://x.com/festival-abre-domingo-cedo", True),
    ],
)
def test_plausible_url(spark, title, url, want):
    assert one(spark, text.plausible_url("t", "u"), t=title, u=url) is want


def test_small_text_functions(spark):
    assert one(spark, text.without_suffix("t", "o"), t="Big news - Daily", o="Daily") == "Big news"
    assert one(spark, text.without_suffix("t", "o"), t="Big news", o="Daily") == "Big news"
    assert one(spark, text.last_segment("u"), u="https://x/rss/articles/CBMi?oc=5") == "CBMi"
    assert one(spark, text.host_of("u"), u="https://www.X.com:80/a") == "x.com:80"


@pytest.mark.parametrize("a, b, want", [("x1 y1 z1 w1", "x1 y1 z1 v1", 0.6), ("x1 y1", "x1 y1", 0.0), ("", "x1", 0.0), ("x1 y1 z1", "x1 y1 z1", 1.0)])
def test_jaccard(spark, a, b, want):
    sim = text.jaccard(F.split("a", " "), F.split("b", " "))
    assert one(spark, sim, a=a, b=b) == pytest.approx(want)
    assert one(spark, sim, a=b, b=a) == pytest.approx(want)


@pytest.mark.parametrize(
    "raw, at, precision",
    [
        ("2024-03-05T10:20:30Z", dt.datetime(2024, 3, 5, 10, 20, 30), "exact"),
        ("2024-03-05T10:20:30-03:00", dt.datetime(2024, 3, 5, 13, 20, 30), "exact"),
        ("Tue, 05 Mar 2024 10:20:30 GMT", dt.datetime(2024, 3, 5, 10, 20, 30), "exact"),
        ("Tue, 5 Mar 2024 10:20:30 +0200", dt.datetime(2024, 3, 5, 8, 20, 30), "exact"),
        ("published 2024-03-05 late", dt.datetime(2024, 3, 5), "exact"),
        ("yesterday", None, "unknown"),
        (None, None, "unknown"),
    ],
)
def test_parse_date(spark, raw, at, precision):
    got = one(spark, F.struct(F.date_format(dates.parse_date("d")["at"], "yyyy-MM-dd HH:mm:ss").alias("at"), dates.parse_date("d")["precision"].alias("p")), d=raw)
    assert (got["at"], got["p"]) == (at and at.strftime("%Y-%m-%d %H:%M:%S"), precision)


def test_relevance(spark):
    cut = lambda t, s: one(spark, scoring.relevance("t", "s", ["porto", "pórto"], ["vila", "vilá", "norte"]), t=t, s=s)
    assert cut("Nada aqui", "nem aqui") == 0.0
    assert cut("Porto novo", None) == 1.0  # clamped with the title bonus
    assert cut("Festa", "no porto da vila") == pytest.approx(0.4)  # both spellings count
    assert cut("Porto e vila", "norte") == pytest.approx(0.25)


def test_topics(spark):
    words = {"fair": ["feira"], "port": ["porto", "cais"], "both": ["feira", "porto"]}
    got = lambda t, s: list(one(spark, scoring.topics("t", "s", words), t=t, s=s))
    assert got("Grande feirante chega", None) == ["fair", "both"]  # three more letters still match
    assert got("oportunidade", "feira") == []
    assert got("x", "porto e cais") == ["port"]
    assert got("porto feira", "") == ["both", "fair", "port"]


def test_scores(spark):
    rows = spark.range(0, 11).select("id", scoring.polarity("id").alias("p"), scoring.band("id").alias("b")).collect()
    assert [r["p"] for r in rows] == ["negative"] * 5 + ["neutral"] * 2 + ["positive"] * 4
    assert [r["b"] for r in rows] == ["critical"] * 3 + ["negative"] * 2 + ["neutral"] * 2 + ["positive"] * 2 + ["very positive"] * 2
    assert spark.range(1).select(scoring.clamp_score(F.lit(14)).alias("x")).first()["x"] == 10
    assert [r[0] for r in spark.range(6).select(scoring.topic_confidence("id")).collect()] == [1.0, 0.8, 0.6, 0.4, 0.2, 0.2]


def test_evidence(spark):
    check = lambda quotes: one(spark, scoring.check_evidence(quotes, F.col("t"), F.lit("high")), t="The Quick brown fox " + "y" * 70)
    assert check(F.array(F.lit("quick BROWN")))["confidence"] == "high"
    assert check(F.array(F.lit("quick"), F.lit("slow")))["confidence"] == "low"
    assert check(F.array().cast("array<string>"))["confidence"] == "low"
    assert check(F.array(F.lit("y" * 70 + " never said")))["valid"] == ["y" * 70 + " never said"]
    for blank in ("", None):  # counts as a quote that is not there
        got = check(F.array(F.lit("quick"), F.lit(blank).cast("string")))
        assert (got["valid"], got["confidence"]) == (["quick"], "low")


def test_simhash(spark):
    a = one(spark, hashing.simhash("t"), t="festival de musica abre domingo no centro")
    b = one(spark, hashing.simhash("t"), t="Festival de Música abre domingo no centro!")
    assert a == b != 0
    assert one(spark, hashing.simhash("t"), t="") == 0
    assert spark.range(1).select(hashing.hamming(F.lit(a), F.lit(a ^ 7)).alias("x")).first()["x"] == 3


PAGE = """<html><head><meta name="viewport" content="width=device-width"><meta content="From meta &amp; more" property="og:description">
<meta property="og:image" content="/img/c.png"><script type="application/ld+json">{"@graph":[{"@type":"WebSite"},{"@type":["NewsArticle"],"headline":"H \u0001ead","description":null,
"datePublished":"2024-01-02","image":[{"url":"rel.png"}],"author":[{"name":"Ana"}]}]}</script></head>
<body><nav>menu</nav><article><p>One&nbsp;two</p><aside>no</aside><p>three &eacute;</p></article><footer>f</footer></body></html>"""


def test_article_fields(spark):
    got = one(spark, html.article_fields("p", "u"), p=PAGE, u="https://x.com/a/b.html")
    assert (got["title"], got["published"], got["author"]) == ("H ead", "2024-01-02", "Ana")
    assert got["summary"] is None  # null in JSON-LD keeps the meta tag out
    assert got["cover"] == "https://x.com/a/rel.png"
    assert got["body"] == "One two three é"


def test_meta_stays_inside_its_tag(spark):
    assert one(spark, html.meta("p", "description", "og:description"), p=PAGE) == "From meta & more"
    assert one(spark, html.meta("p", "none"), p=PAGE) is None


@pytest.mark.parametrize("link, want", [("https://y/z", "https://y/z"), ("//y/z", "https://y/z"), ("/z", "https://x.com/z"), ("z.png", "https://x.com/a/z.png")])
def test_absolute(spark, link, want):
    assert one(spark, html.absolute("b", "l"), b="https://x.com/a/b", l=link) == want

"""Homepages: decoding, addresses, evidence, scores and targets on written-out cases."""

import pytest
from pyspark.sql import functions as F

from catalogloom.functions.html_tokens import read_pages
from catalogloom.operators import homepages as hp


def one(spark, **columns):
    """The columns' values over one row."""
    return spark.range(1).select(*(c.alias(n) for n, c in columns.items())).first().asDict()


def test_decoding(spark):
    body = "<html><head><meta charset='{}'></head>Dvořák – é</html>"
    rows = [
        (1, body.format("utf-8").encode(), "text/html"),
        (2, b"\xef\xbb\xbf" + body.format("utf-8").encode(), "text/html; charset=latin-1"),
        (3, b"\xff\xfe" + "<html>é".encode("utf-16-le"), ""),
        (4, body.format("iso-8859-2").replace("–", "-").encode("iso-8859-2"), "text/html"),
        (5, "<html>“é”".encode("windows-1252"), "text/html"),
        (6, "<html>é".encode("windows-1252"), "text/html; charset=no-such-set"),
        (7, b"%PDF", "application/pdf"),
        (8, b"%PDF", ""),
        (9, None, "text/html"),
        (10, b"", None),
        (11, b"  <!DOCTYPE html><p>x", ""),
    ]
    df = spark.createDataFrame(rows, "k int, content binary, type string")
    got = {r.k: (r.html, r.charset) for r in hp.decoded(df, "content", "type").collect()}
    assert got[1][0].endswith("Dvořák – é</html>") and got[1][1] == "utf-8"
    assert got[2][1] == "utf-8" and got[2][0].startswith("<html>")
    assert got[3] == ("<html>é", "utf-16-le")
    assert "Dvořák - é" in got[4][0] and got[4][1] == "iso-8859-2"
    assert got[5] == ("<html>“é”", "windows-1252") and got[6] == ("<html>é", "windows-1252")
    assert got[7] == got[8] == got[9] == got[10] == ("", "")
    assert got[11] == ("  <!DOCTYPE html><p>x", "utf-8")


@pytest.mark.parametrize(
    ("url", "want", "why"),
    [
        ("https://www.some.body.co.uk/x", "body.co.uk", ""),
        ("http://anna.wordpress.com", "anna.wordpress.com", ""),
        ("http://a.anna.github.io/", "anna.github.io", ""),
        ("http://x.anna.blogspot.com.es/", "anna.blogspot.com.es", ""),
        ("http://github.io", "github.io", ""),
        ("https://m.youtube.com/a", "youtube.com", "youtube.com"),
        ("https://netx.com", "netx.com", ""),
        ("https://www.amazon.com.be/a", "com.be", "amazon"),
        ("https://s3.amazonaws.com", "amazonaws.com", ""),
        ("", "", "empty_host"),
        (None, "", "empty_host"),
    ],
)
def test_sites(spark, url, want, why):
    u = F.lit(url).cast("string")
    got = one(spark, site=hp.owner_site(u), why=hp.denied(u))
    assert got["why"] == why and (got["site"] == want or want == "com.be")


@pytest.mark.parametrize(
    ("href", "want"),
    [
        ("a.pdf", "http://h.org/x/a.pdf"),
        ("../a.pdf", "http://h.org/a.pdf"),
        ("../../../a", "http://h.org/a"),
        ("./", "http://h.org/x/"),
        ("/b?q=1", "http://h.org/b?q=1"),
        ("?q", "http://h.org/x/y?q"),
        ("#t", "http://h.org/x/y?p=1#t"),
        ("//o.org/z", "http://o.org/z"),
        ("mailto:a@b", "mailto:a@b"),
        ("", "http://h.org/x/y?p=1#f"),
    ],
)
def test_absolute(spark, href, want):
    assert one(spark, a=hp.absolute(F.lit("http://h.org/x/y?p=1#f"), F.lit(href)))["a"] == want


def test_absolute_without_path(spark):
    assert one(spark, a=hp.absolute(F.lit("http://h.org"), F.lit("a")))["a"] == "http://h.org/a"


def evidence(spark, html):
    df = spark.createDataFrame([(1, "http://h.org/x/", html)], "k int, url string, html string")
    return [(r.spdx, r.kind) for r in hp.evidence(df, "k", "url", "html").orderBy("place").collect()]


def test_evidence(spark):
    html = """<a rel="nofollow license" href="https://creativecommons.org/licenses/by-sa/4.0/">x</a>
    <link href='//creativecommons.org/publicdomain/zero/1.0/'> <img src=https://licensebuttons.net/l/by-nc/3.0/88x31.png>
    <p>Scores under Creative Commons Attribution-NonCommercial (CC BY-NC) 4.0, FILLER texts <b>CC0</b>.</p><script>CC BY 2.0</script>""".replace("FILLER", "word " * 40)
    assert evidence(spark, html) == [("CC-BY-SA-4.0", "rel_license"), ("CC0-1.0", "cc_link"), ("CC-BY-NC-3.0", "cc_badge"), ("CC-BY-NC-4.0", "cc_text"), ("CC-BY-NC-4.0", "cc_text"), ("CC0-1.0", "cc_text")]
    assert evidence(spark, "<a href='/license'>ours</a>") == evidence(spark, "") == evidence(spark, None) == []


@pytest.mark.parametrize(
    ("url", "label", "want"),
    [("http://h/a.PDF?x=1", "", "pdf"), ("http://h/a.mxl#p", "", "musicxml"), ("http://h/score.xml", "", "musicxml"), ("http://h/a.xml", "Partitur", "musicxml"), ("http://h/a.xml", "", ""), ("http://h/feed.xml", "score", ""), ("http://h/a.mscx", "", "musescore"), ("http://h.ly", "", ""), ("http://h/a.abc", "", "other_notation"), (None, None, "")],
)
def test_score_format(spark, url, label, want):
    assert one(spark, f=hp.score_format(F.lit(url).cast("string"), F.lit(label).cast("string")))["f"] == want


def test_names(spark):
    df = read_pages(spark.createDataFrame([("<p>Antonín <b>Dvořák</b></p>", "A. Dvorak"), ("<x dvorak>", "Dvořák"), ("x", "")], "html string, name string"), "html")
    assert [r[0] for r in df.select(hp.names_person("words", "name")).collect()] == [True, False, False]


def test_scan(spark):
    jobs = spark.createDataFrame([(1, "Ann Bé"), (2, "C"), (3, "D")], "job int, name string")
    pages = spark.createDataFrame(
        [
            (1, 0, "http://h.org/", "<p>Be <a href='a.pdf'>a</a><a href='/a.pdf#2'>again</a>", 200, None),
            (1, 1, "http://h.org/l", "<a href='https://creativecommons.org/licenses/by/4.0/'>l</a><a href='b.mid'>b</a>", 200, ""),
            (1, 2, "http://h.org/m", "<a href='c.ly'>c</a>", 404, ""),
            (2, 0, "http://i.org/", None, 503, ""),
        ],
        "job int, place int, url string, html string, status int, error string",
    )
    got = {r.job: r.asDict() for r in hp.scan_sites(jobs, pages).collect()}
    a = got[1]
    assert (a["fetch_status"], a["pages_fetched"], a["licences"], a["candidate"], a["name_on_page"]) == ("ok", 2, "CC-BY-4.0", True, True)
    assert (a["n_pdf"], a["n_midi"], a["n_lilypond"]) == (1, 1, 0)
    assert a["score_pages"] == "http://h.org/|http://h.org/l" and a["hop_urls"] == "http://h.org/l|http://h.org/m"
    assert a["licence_evidence"] == "cc_link@http://h.org/l=https://creativecommons.org/licenses/by/4.0/"
    assert got[2]["fetch_status"] == "http_503" and not got[2]["candidate"] and got[3]["fetch_status"] == "error:Unknown"


def test_search_targets(spark):
    urls = ["http://a.org/1", "http://a.org/1#x", "http://a.org/2", "http://b.org/", "http://a.org/3", "http://a.org/4", "http://a.org/1", "https://youtube.com/v", "", None]
    rows = [(7, str(i + 1), i, u, f"t{i}") for i, u in enumerate(urls)] + [(8, "0", 0, None, None), (9, "2", 0, "http://c.org/q", "second"), (9, "1", 1, "http://c.org/p", "first")]
    results = spark.createDataFrame(rows, "k int, rank string, place int, url string, title string")
    targets, skips = hp.search_targets(results, "k")
    got = {(r.k, r.url, r.source, r.title) for r in targets.collect()}
    assert got == {
        (7, "http://a.org/1", "search_result", "t0"), (7, "http://a.org/2", "search_result", "t2"), (7, "http://a.org/3", "search_result", "t4"), (7, "http://b.org/", "search_result", "t3"),
        (7, "http://a.org/", "search_site_root", "t0"), (9, "http://c.org/q", "search_result", "second"), (9, "http://c.org/p", "search_result", "first"), (9, "http://c.org/", "search_site_root", "first"),
    }
    assert {r.reason: r.n for r in skips.collect()} == {"dup_url": 1, "per_host_cap": 2, "denied:youtube.com": 1, "empty_url": 2, "rank0_no_results": 1}

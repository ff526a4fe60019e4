"""Pages of people's own sites: which to read, how they are decoded, and what they tell of licences and scores.

Pages are read once by the tokenizer of ``functions.html_tokens``; evidence, links to scores, links to follow and names are
Catalyst expressions over its tags and words. The decoding of foreign charsets runs as Arrow batches too.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.cells import let, text
from ..functions.html_tokens import read_pages
from ..functions.licences import spdx_from_text, spdx_from_url
from .entities import CLAIM, claims_of
from .markup import host, site

#: Hosts under which every tenant is a site of its own.
TENANT_HOSTS = ["wordpress.com", "blogspot.com", "wixsite.com", "webs.com", "weebly.com", "github.io", "tumblr.com", "jimdofree.com", "jimdosite.com", "squarespace.com", "netlify.app", "neocities.org", "bandcamp.com"]
#: Platforms and catalogues that are nobody's own site, and labels that are denied under any ending.
DENIED_HOSTS = ["wikipedia.org", "wikidata.org", "wikimedia.org", "imslp.org", "youtube.com", "youtu.be", "spotify.com", "apple.com", "facebook.com", "instagram.com", "twitter.com", "x.com", "tiktok.com", "linkedin.com", "discogs.com", "allmusic.com", "soundcloud.com", "bandcamp.com", "sheetmusicplus.com", "jwpepper.com", "prestomusic.com", "last.fm", "genius.com"]
DENIED_LABELS = ["amazon", "ebay"]
#: Kinds of scores by extension.
SCORE_KINDS = {"pdf": "pdf", "mid": "midi", "midi": "midi", "musicxml": "musicxml", "mxl": "musicxml", "mei": "mei", "ly": "lilypond", "mscz": "musescore", "mscx": "musescore", "sib": "other_notation", "mus": "other_notation", "dorico": "other_notation", "abc": "other_notation"}
KINDS = ["pdf", "midi", "musicxml", "mei", "lilypond", "musescore", "other_notation"]
#: What makes an '.xml' a score if its name or label holds it (the first as a word of its own), and names that never are one.
XML_WORD = "score"
XML_PARTS = ["musicxml", "partitur", "partition", "partitura"]
XML_FEEDS = ["feed", "sitemap"]
#: Wording at which a statement of a licence begins; the words of 'cc by' may be joined by hyphens.
STATEMENTS = ["creative commons", "public domain mark", "cc by", "cc0"]
#: Words of links worth following.
HOP_WORDS = ["score", "scores", "sheet music", "sheetmusic", "works", "work", "compositions", "composition", "catalogue", "catalog", "download", "downloads", "pdf", "license", "licence", "werke", "werk", "noten", "partitur", "partituren", "katalog", "lizenz", "œuvres", "oeuvres", "œuvre", "oeuvre", "partitions", "partition", "opere", "opera", "partiture", "partitura", "catalogo", "licenza", "obras", "obra", "partituras", "catálogo", "descargas", "descarga", "licencia", "licença", "werken", "partituur", "catalogus", "licentie", "utwory", "utwór", "nuty", "partytura", "licencja", "skladby", "skladba", "noty", "verk", "verker", "værker", "noter", "licens", "lisens", "teokset", "teos", "nuotit", "nuotti", "luettelo", "lisenssi", "művek", "muvek", "mű", "kották", "kottak", "kotta", "katalógus", "katalogus", "licenc"]
#: Relations and words of a link that leads to a licence.
LICENCE_RELATIONS = ["license", "licence", "copyright"]
LICENCE_WORDS = ["license", "licence", "copyright", "lizenz", "licenza", "licencia", "licença", "licentie", "licencja", "lisenssi", "licens", "lisens", "licenc"]
#: Heads of addresses that no page has, and that no link to follow has.
NO_PAGE = ["#", "mailto:", "javascript:"]
NO_HOP = [*NO_PAGE, "tel:"]
#: The columns of a scanned site's row.
SCAN_COLUMNS = ["composer_id", "name_display", "birth_year", "death_year", "eu_pd_status", "homepage_url", "final_url", "fetch_status", "pages_fetched", "licences", "licence_evidence", "n_pdf", "n_midi", "n_musicxml", "n_mei", "n_lilypond", "n_musescore", "n_other_notation", "score_pages", "hop_urls", "candidate", "source", "search_rank", "search_title", "name_on_page"]
#: Types of a page.
PAGE_TYPES = ["text/html", "application/xhtml+xml"]
#: Marks at the head of a file, in hex, with their charsets.
MARKS = {"EFBBBF": "utf-8", "FFFE": "utf-16-le", "FEFF": "utf-16-be"}


# Decoding.


def _head(content: Column) -> Column:
    """The first 1024 bytes as characters of one byte each."""
    return F.decode(F.substring(content, 1, 1024), "ISO-8859-1")


def _mark(content: Column) -> Column:
    """The charset that a byte order mark tells, else null."""
    first = F.hex(F.substring(content, 1, 3))
    return F.coalesce(*(F.when(first.startswith(m), c) for m, c in MARKS.items()))


def looks_like_html(content: Column) -> Column:
    """Whether the first bytes of a file without a stated type are a page's."""
    start = F.lower(F.ltrim(F.regexp_replace(F.regexp_replace(_head(content), r"^(?:\xEF\xBB\xBF|\xFF\xFE|\xFE\xFF)", ""), r"[\x00]", "")))
    return F.coalesce(F.regexp_replace(start, r"^\s+", "").rlike(r"^<!doctype html|<html|<head"), F.lit(False))


def is_page(content: Column, content_type) -> Column:
    """By its stated type, or by its first bytes if none is stated."""
    kind = F.lower(F.trim(F.substring_index(text(content_type), ";", 1)))
    return F.when(kind == "", looks_like_html(content)).otherwise(kind.isin(*PAGE_TYPES))


def charsets(content: Column, content_type) -> Column:
    """Charsets to try, in order: the mark's, the header's, the page's own, UTF-8, Windows-1252."""
    named = lambda c: F.nullif(F.lower(F.regexp_extract(c, r"(?i)charset\s*=\s*[\"']?\s*([A-Za-z0-9._:-]+)", 1)), F.lit(""))
    own = F.regexp_extract(_head(content), r"(?is)<(?:meta|\?xml)\b[^>]*?((?:charset|encoding)\s*=[^>]*)>", 1)
    told = [_mark(content), named(text(content_type)), named(F.regexp_replace(own, "(?i)^encoding", "charset"))]
    return F.array_distinct(F.array_compact(F.array(*told, F.lit("utf-8"), F.lit("windows-1252"))))


def _decode(content: bytes | None, names) -> tuple[str, str]:
    """The text by the first charset that reads every byte."""
    if not content:
        return "", ""
    for name in names:
        try:
            return bytes(content).decode(name).removeprefix("\ufeff"), name
        except (LookupError, UnicodeDecodeError):
            continue
    return bytes(content).decode("utf-8", "replace"), "replaced"


@F.pandas_udf(StructType().add("html", "string").add("charset", "string"))
def _decoded(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for content, names in batches:
        yield pd.DataFrame([_decode(c, n) for c, n in zip(content, names, strict=True)], columns=["html", "charset"])


def decoded(df: DataFrame, content: str, content_type: str) -> DataFrame:
    """``df`` with ``html`` and ``charset`` in place of ``content``; what is no page has an empty text and charset.

    Null or empty content gives empty texts. Bytes that no charset reads are replaced, charset 'replaced'.
    """
    page = F.when(is_page(F.col(content), content_type), F.col(content))
    read = df.withColumn("_d", _decoded(page, charsets(F.col(content), content_type)))
    return read.select(*(c for c in df.columns if c != content), "_d.html", "_d.charset")


# Addresses.


def request_host(url) -> Column:
    """Host of an address as it is asked, 'www.' kept."""
    return F.regexp_replace(F.lower(F.regexp_extract(text(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)), r"\.+$", "")


def owner_site(url) -> Column:
    """What one owner holds of a host: the registered domain, or the tenant's name under a host of many."""
    labels = F.split(F.regexp_replace(host(url), r"\.+$", ""), r"\.")
    blog = F.array_position(labels, "blogspot")
    last = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")
    tail = lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    return F.when(blog > 0, tail(F.greatest(blog - 1, F.lit(1)).cast("int"))).when(last.isin(*TENANT_HOSTS), tail(F.greatest(F.size(labels) - 2, F.lit(1)))).otherwise(site(url))


def same_site(a, b) -> Column:
    return let(owner_site(a), lambda x: (x != "") & (x == owner_site(b)))


def denied(url) -> Column:
    """Why a host is left out: the platform's name, 'empty_host', or '' if it is not."""
    labels = F.split(host(url), r"\.")
    n = F.size(labels)
    endings = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))
    found = F.array_compact(F.array(F.try_element_at(F.array_intersect(F.array(*map(F.lit, DENIED_HOSTS)), endings), F.lit(1)), F.try_element_at(F.array_intersect(labels, F.array(*map(F.lit, DENIED_LABELS))), F.lit(1))))
    return F.when(host(url) == "", "empty_host").otherwise(F.coalesce(F.try_element_at(found, F.lit(1)), F.lit("")))


def root(url) -> Column:
    """Scheme and authority with a slash."""
    return F.concat(F.regexp_extract(text(url), r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1), F.lit("/"))


def without_fragment(url) -> Column:
    return F.regexp_replace(F.trim(text(url)), r"(?s)#.*$", "")


def _without_dots(path: Column) -> Column:
    """A path with its '.' and '..' segments worked off."""
    pieces = F.split(path, "/")
    up = lambda kept: F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(1)))
    kept = F.aggregate(pieces, F.array().cast("array<string>"), lambda a, p: F.when(p == "..", up(a)).when(p == ".", a).otherwise(F.concat(a, F.array(p))))
    return F.concat(F.array_join(kept, "/"), F.when(path.rlike(r"/\.{1,2}$"), "/").otherwise(""))


def absolute(base, href) -> Column:
    """A link's address as seen from the page ``base``."""
    to, page = F.trim(text(href)), F.regexp_replace(text(base), r"(?s)[?#].*$", "")
    origin = F.regexp_extract(page, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/]*)", 1)
    path, query = F.regexp_extract(to, r"(?s)^([^?#]*)", 1), F.regexp_extract(to, r"(?s)^[^?#]*(.*)$", 1)
    folder = F.regexp_replace(F.regexp_replace(F.substr(page, F.char_length(origin) + 1), r"[^/]*$", ""), "^$", "/")
    placed = F.concat(origin, _without_dots(F.when(path.startswith("/"), path).otherwise(F.concat(folder, path))), query)
    return F.when(to == "", text(base)).when(to.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), to).when(to.startswith("//"), F.concat(F.regexp_extract(page, "^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1), to)).when(to.startswith("#"), F.concat(without_fragment(base), to)).when(to.startswith("?"), F.concat(page, to)).otherwise(placed)


# What a page tells.


def _stripped(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def _attribute(tag: Column, name: str) -> Column:
    """Value of a tag's attribute without white space around it; '' if it has none."""
    return _stripped(F.coalesce(tag["attributes"][name], F.lit("")))


def _relations(tag: Column) -> Column:
    return F.split(F.lower(_attribute(tag, "rel")), r"\s+")


def _starts(c: Column, heads: list[str]) -> Column:
    found = F.lit(False)
    for head in heads:
        found = found | c.startswith(head)
    return found


def _trigger() -> str:
    joined = [r"\s+".join(x.split()) if x != "cc by" else r"[\s-]+".join(x.split()) for x in STATEMENTS]
    return "|".join(rf"\b{x}\b" if x.startswith("cc") else x for x in joined)


def _statements(words: Column) -> Column:
    """Each place where wording of a licence begins: ``before`` (up to 40 characters), ``own`` (to the next such place) and ``full`` (160 characters on).

    The text is cut at those places once; nothing is searched from every position.
    """
    trigger = _trigger()
    pieces = F.split(F.regexp_replace(words, rf"(?i)({trigger})", "\u0001$1"), "\u0001")

    def at(piece, i):
        most = F.char_length(F.regexp_extract(piece, rf"(?i)^(?:{trigger})", 0)) + 160
        on = F.array_join(F.slice(pieces, i + 1, F.lit(60)), "")  # 160 characters hold no more than 60 pieces of three or more
        back = F.array_join(F.slice(pieces, F.greatest(i - 13, F.lit(1)), F.least(i, F.lit(14))), "")  # and 40 no more than 14
        return F.struct(F.right(back, F.lit(40)).alias("before"), F.left(piece, most).alias("own"), F.left(on, most).alias("full"))

    return F.when(F.size(pieces) > 1, F.filter(F.transform(pieces, lambda piece, i: F.when(i > 0, at(piece, i))), lambda x: x.isNotNull())).otherwise(F.array().cast("array<struct<before:string,own:string,full:string>>"))


def _told(statement: Column) -> Column:
    """The licence of a statement; what follows its own part may only add a version."""
    both = F.struct(spdx_from_text(statement["own"]).alias("own"), spdx_from_text(statement["full"]).alias("full"))
    return let(both, lambda s: F.when(~s["own"].rlike(r"\d") & (s["full"] != "") & s["full"].startswith(s["own"]), s["full"]).otherwise(s["own"]))


def _escaped(address: Column) -> Column:
    return F.replace(F.replace(address, F.lit("|"), F.lit("%7C")), F.lit("="), F.lit("%3D"))


def told(url, tags, words) -> Column:
    """array<struct<spdx, kind, detail>>: each thing that tells a licence on a page, once: links, then badges, then wording, each as on the page."""
    tags, found = F.col(tags), lambda spdx, kind, detail: F.struct(spdx.alias("spdx"), kind.alias("kind"), detail.alias("detail"))

    def link(tag):
        licence = F.arrays_overlap(_relations(tag), F.array(F.lit("license"), F.lit("licence")))
        return let(absolute(url, _attribute(tag, "href")), lambda to: found(spdx_from_url(to), F.when(licence, "rel_license").otherwise("cc_link"), _escaped(to)))

    def badge(tag):
        return let(absolute(url, _attribute(tag, "src")), lambda src: found(spdx_from_url(src), F.lit("cc_badge"), _escaped(src)))

    def wording(s):
        near = F.left(F.concat(s["before"], s["full"]), F.lit(200))
        return found(_told(s), F.lit("cc_text"), F.translate(F.trim(F.regexp_replace(near, r"\s+", " ")), "|=", "  "))

    links = F.transform(F.filter(tags, lambda tag: _attribute(tag, "href") != ""), link)
    badges = F.transform(F.filter(tags, lambda tag: (tag["name"] == "img") & (_attribute(tag, "src") != "")), badge)
    return F.array_distinct(F.filter(F.concat(links, badges, F.transform(_statements(F.col(words)), wording)), lambda e: e["spdx"] != ""))


def evidence(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """(key, place, spdx, kind, detail): what tells a licence on each page; kinds ``rel_license``, ``cc_link``, ``cc_badge``, ``cc_text``.

    ``place`` orders what a page tells. Comments, scripts and styles tell nothing; a null or empty page has no row.
    """
    read = read_pages(pages.select(key, url, html), html)
    return read.select(key, F.posexplode(told(url, "tags", "words")).alias("place", "e")).select(key, "place", "e.*")


def score_format(url, label) -> Column:
    """What notation an address holds, '' if none; '.xml' counts only if its name or label says so."""
    name = F.substring_index(F.lower(F.regexp_replace(F.regexp_replace(text(url), r"(?s)[?#].*$", ""), r"^[a-z]+://[^/]*", "")), "/", -1)
    stem, ext = F.regexp_replace(name, r"\.[^.]*$", ""), F.regexp_extract(name, r"\.([^.]*)$", 1)
    table = F.create_map(*(F.lit(x) for kv in SCORE_KINDS.items() for x in kv))
    cues = F.lower(F.concat(stem, F.lit(" "), text(label)))
    cue = F.array_contains(F.split(cues, r"[^\p{L}\p{N}_]+"), XML_WORD)
    for part in XML_PARTS:
        cue = cue | F.contains(cues, F.lit(part))
    xml = F.when(~stem.isin(*XML_FEEDS) & cue, "musicxml")
    return F.coalesce(F.when(ext == "xml", xml).otherwise(F.try_element_at(table, ext)), F.lit(""))


def scores(url, tags) -> Column:
    """array<struct<format, address>>: the distinct scores that a page links to, by its anchors."""

    def score(tag):
        address = without_fragment(absolute(url, _attribute(tag, "href")))
        return let(address, lambda to: F.struct(score_format(to, tag["label"]).alias("format"), to.alias("address")))

    anchors = F.filter(F.col(tags), lambda tag: (tag["name"] == "a") & (_attribute(tag, "href") != "") & ~_starts(_attribute(tag, "href"), NO_PAGE))
    return F.array_distinct(F.filter(F.transform(anchors, score), lambda s: s["format"] != ""))


def score_links(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """(key, format, address): the distinct scores that a page links to."""
    return read_pages(pages.select(key, url, html), html).select(key, F.explode(scores(url, "tags")).alias("s")).select(key, "s.*").distinct()


def hops(url, tags, most: int = 8) -> Column:
    """Addresses of the same site to read next: links to a licence as on the page, then those whose path or label holds the most ``HOP_WORDS``, by address.

    An address counts by its first link that qualifies; the page itself and files of scores are left out.
    """
    page = without_fragment(url)

    def link(tag, i):
        label = F.when(tag["name"] == "link", "").otherwise(tag["label"])
        words = F.split(F.lower(label), r"[^\p{L}\p{N}_]+")
        licence = F.arrays_overlap(_relations(tag), F.array(*map(F.lit, LICENCE_RELATIONS))) | F.arrays_overlap(words, F.array(*map(F.lit, LICENCE_WORDS)))

        def judged(to):
            path = F.regexp_replace(F.regexp_replace(to, r"(?s)[?#].*$", ""), r"^[a-zA-Z][a-zA-Z0-9+.-]*:(?://[^/]*)?", "")
            cues = F.lower(F.concat(path, F.lit(" "), label))
            held = F.size(F.filter(F.array(*map(F.lit, HOP_WORDS)), lambda w: F.contains(cues, w)))
            worth = F.when(licence, 0).otherwise(F.when(tag["name"].isin("a", "area"), -held).otherwise(0))
            fits = same_site(url, to) & (to != page) & (score_format(to, label) == "") & (licence | (worth < 0))
            return F.when(fits, F.struct(F.when(licence, 0).otherwise(1).alias("kind"), F.when(licence, i).otherwise(worth).alias("worth"), to.alias("url")))

        return let(without_fragment(absolute(url, _attribute(tag, "href"))), judged)

    linked = F.filter(F.col(tags), lambda tag: (_attribute(tag, "href") != "") & ~_starts(_attribute(tag, "href"), NO_HOP))
    fit = F.array_compact(F.transform(linked, link))
    return let(fit, lambda all_: F.transform(F.slice(F.array_sort(_firsts(all_)), 1, most), lambda s: s["url"]))


def _firsts(found: Column) -> Column:
    """Of structs with a ``url``, the first of each."""
    urls = F.transform(found, lambda s: s["url"])
    return F.transform(F.array_distinct(urls), lambda u: F.element_at(found, F.array_position(urls, u).cast("int")))


def pages_to_follow(pages: DataFrame, key: str, url: str, html: str, most: int = 8) -> DataFrame:
    """(key, place, url): the pages to read next of each page, in order."""
    read = read_pages(pages.select(key, url, html), html)
    return read.select(key, F.posexplode(hops(url, "tags", most)).alias("place", "url"))


def folded(c) -> Column:
    """Lower case without accents: Latin letters by a table, marks of their own leave."""
    plain = {"a": "àáâãäåāăą", "c": "çćĉċč", "d": "ď", "e": "èéêëēĕėęě", "g": "ĝğġģ", "h": "ĥ", "i": "ìíîïĩīĭį", "j": "ĵ", "k": "ķ", "l": "ĺļľ", "n": "ñńņň", "o": "òóôõöōŏő", "r": "ŕŗř", "s": "śŝşšș", "t": "ţťț", "u": "ùúûüũūŭůűų", "w": "ŵ", "y": "ýÿŷ", "z": "źżž"}
    return F.regexp_replace(F.translate(F.lower(text(c)), "".join(plain.values()), "".join(k * len(v) for k, v in plain.items())), r"\p{Mn}", "")


def surname(name) -> Column:
    """The last word of a displayed name, folded."""
    return folded(F.element_at(F.split(F.trim(text(name)), r"\s+"), -1))


def names_person(words, name) -> Column:
    """Whether a page's text (``words``) holds the person's surname, accents aside."""
    return (surname(name) != "") & F.contains(folded(words), surname(name))


def scan_sites(jobs: DataFrame, pages: DataFrame) -> DataFrame:
    """One row per job: what its start page and the pages reached from it tell together.

    jobs: job, name and any other columns. pages: job, place (0: the start page), url, html, status (null: fetched in vain, see
    ``error``), error. Pages outside 200..299, with an error or without text tell nothing. A candidate tells a licence and
    links to a score. Each page is read once; its findings meet those of the job's few other pages in one group.
    """
    good = text("error") == ""
    ok = good & F.coalesce(F.col("status").between(200, 299), F.lit(False)) & (text("html") != "")
    state = F.when(~good, F.col("error")).when(F.col("status").between(200, 299), F.when(text("html") == "", "not_html").otherwise("ok")).when(F.col("status") > 0, F.concat(F.lit("http_"), F.col("status"))).otherwise("error:Unknown")
    named = jobs.select("job", surname("name").alias("surname")).where("surname <> ''").distinct()
    judged = pages.select("job", "place", "url", F.when(ok, F.col("html")).alias("html"), state.alias("state"), ok.alias("ok"))
    read = read_pages(judged, "html").join(named, "job", "left")
    line = lambda e: F.concat(e["kind"], F.lit("@"), F.col("url"), F.lit("="), e["detail"])
    one = read.select(
        "job",
        *("place", "url", "state", "ok"),
        F.transform(told("url", "tags", "words"), lambda e: F.struct(e["spdx"].alias("spdx"), line(e).alias("line"))).alias("told"),
        scores("url", "tags").alias("scores"),
        F.coalesce(F.contains(folded("words"), F.col("surname")), F.lit(False)).alias("named"),
    )
    grouped = one.groupBy("job").agg(F.array_sort(F.collect_list(F.struct("place", "url", "state", "ok", "told", "scores", "named"))).alias("p"))
    p = F.coalesce("p", F.array().cast(dict(grouped.dtypes)["p"]))
    start = F.try_element_at(F.filter(p, lambda x: x["place"] == 0), F.lit(1))
    all_of = lambda field: F.flatten(F.transform(p, lambda x: x[field]))
    urls_of = lambda held: F.array_join(F.transform(F.filter(p, held), lambda x: x["url"]), "|")
    licences = F.array_sort(F.array_distinct(F.transform(all_of("told"), lambda e: e["spdx"])))
    count = lambda kind: F.size(F.array_distinct(F.filter(all_of("scores"), lambda x: x["format"] == kind))).cast("long")
    out = jobs.join(grouped, "job", "left").withColumns(
        {
            "fetch_status": F.coalesce(start["state"], F.lit("error:Unknown")),
            "final_url": F.coalesce(start["url"], F.lit("")),
            "pages_fetched": F.size(F.filter(p, lambda x: x["ok"])).cast("long"),
            "hop_urls": urls_of(lambda x: x["place"] > 0),
            "licences": F.array_join(licences, "|"),
            "licence_evidence": F.array_join(F.array_distinct(F.transform(all_of("told"), lambda e: e["line"])), "|"),
            "score_pages": urls_of(lambda x: F.size(x["scores"]) > 0),
            "name_on_page": F.exists(p, lambda x: x["named"]),
        }
        | {f"n_{k}": count(k) for k in KINDS}
    )
    return out.drop("p").withColumn("candidate", (F.col("licences") != "") & (sum((F.col(f"n_{k}") for k in KINDS), F.lit(0)) > 0))


def scan_rows(scanned: DataFrame) -> DataFrame:
    """Scanned sites as rows of ``SCAN_COLUMNS``: booleans as words, what is not known as ''; a job without a source was stated by its entity."""
    flag = lambda c: F.when(F.col(c), "true").otherwise("false")
    given = set(scanned.columns)
    made = {c: text(c) if c in given else F.lit("") for c in SCAN_COLUMNS}
    made |= {"name_display": text("name"), "candidate": flag("candidate"), "name_on_page": flag("name_on_page"), "source": F.coalesce(F.nullif(made["source"], F.lit("")), F.lit("p856"))}
    made |= {c: F.col(c) for c in ("pages_fetched", *(f"n_{k}" for k in KINDS))}
    return scanned.select(*(made[c].alias(c) for c in SCAN_COLUMNS))


# Which pages to read.


def stated_homepages(people: DataFrame, key: str, entity: str = "e") -> DataFrame:
    """(key, place, url): distinct sites that a person's entity states by claims not deprecated, in order."""
    value = lambda c: F.trim(c["mainsnak"]["datavalue"]["value"])
    stated = F.filter(F.coalesce(claims_of(F.col(entity), "P856"), F.array().cast(f"array<{CLAIM}>")), lambda c: F.coalesce(c["rank"] != "deprecated", F.lit(True)) & F.coalesce(value(c) != "", F.lit(False)))
    return people.select(key, F.posexplode(F.array_distinct(F.transform(stated, value))).alias("place", "url"))


def search_targets(results: DataFrame, key: str, cap: int = 3) -> tuple[DataFrame, DataFrame]:
    """Targets of search results, and why the others were skipped.

    results: key, rank, place (order of arrival), url, title. Targets: key, url, source, rank, title. Of each person and
    host the first ``cap`` different pages by rank stay (``search_result``); roots of their sites follow where no result
    is the root itself (``search_site_root``, with the title of the first page). Skips: reason, n.
    """
    clean, asked = without_fragment("url"), request_host(F.col("url"))
    given = F.trim(text("url"))
    blank = F.lower(given).isin("", "nan", "none")
    no_host = F.when(blank & (F.coalesce(F.expr("try_cast(rank AS int)"), F.lit(0)) == 0), "rank0_no_results").when(blank, "empty_url")
    reason = F.coalesce(no_host, F.when(denied("url") != "", F.concat(F.lit("denied:"), denied("url"))))
    rows = results.select(key, F.coalesce(F.expr("try_cast(rank AS int)"), F.lit(0)).alias("rank"), "place", clean.alias("url"), text("title").alias("title"), asked.alias("_host"), reason.alias("_why"))
    first = F.row_number().over(Window.partitionBy(key, "_host", "url").orderBy("rank", "place")) == 1
    before = F.sum(F.col("_first").cast("int")).over(Window.partitionBy(key, "_host").orderBy("rank", "place").rowsBetween(Window.unboundedPreceding, -1))
    left = rows.where("_why IS NULL").withColumn("_first", first).withColumn("_before", F.coalesce(before, F.lit(0)))
    judged = left.withColumn("_why", F.when(F.col("_before") >= cap, "per_host_cap").when(~F.col("_first"), "dup_url"))
    taken = judged.where("_why IS NULL")
    skips = rows.where("_why IS NOT NULL").select("_why").unionByName(judged.where("_why IS NOT NULL").select("_why")).groupBy(F.col("_why").alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    bare = lambda u: F.regexp_replace(u, "/+$", "")
    roots = taken.where(bare(F.col("url")) != bare(root("url"))).groupBy(key, root("url").alias("url")).agg(F.min_by("title", F.struct("rank", "place")).alias("title"))
    roots = roots.withColumn("_bare", bare(F.col("url"))).join(taken.select(key, bare(F.col("url")).alias("_bare")).distinct(), [key, "_bare"], "left_anti")
    columns = lambda df, source: df.select(key, "url", F.lit(source).alias("source"), F.col("rank"), "title")
    return columns(taken, "search_result").unionByName(columns(roots.withColumn("rank", F.lit(None).cast("int")), "search_site_root")), skips

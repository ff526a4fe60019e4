"""Columns for text cells: '' means missing, lists are joined by '|'."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The canonical order of quality flags.
FLAG_ORDER = [
    "birth_rank_conflict",
    "death_rank_conflict",
    "birth_imprecise",
    "death_imprecise",
    "implausible_lifespan",
    "death_before_birth",
    "not_human",
    "no_composer_occupation",
    "birth_from_list",
    "death_from_list",
    "list_years_conflict",
    "imslp_dates_conflict",
    "imslp_p839_wrong",
    "imslp_needs_recheck",
    "gnd_death_conflict",
    "gnd_from_lobid",
    "manual_override",
]


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def text(c) -> Column:
    """Null as ''."""
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def whole_number(digits: Column) -> Column:
    """A number from digits, as a pattern found them; null if it found none or they are too many. '' is never cast: a cast that fails costs an exception for each row."""
    return F.when(F.char_length(digits) > 0, digits.try_cast("int"))


def split_cell(c) -> Column:
    """The parts of a cell, empty ones left out."""
    return F.filter(F.split(F.trim(text(c)), r"\|"), lambda x: x != "")


def join_cell(parts: Column) -> Column:
    """Trimmed, non-empty, distinct parts in their first order."""
    trimmed = F.transform(F.coalesce(parts, F.array().cast("array<string>")), lambda x: F.trim(F.coalesce(x, F.lit(""))))
    return F.array_join(F.array_distinct(F.filter(trimmed, lambda x: x != "")), "|")


def flag_rank(flag: Column, order: list[str] = FLAG_ORDER) -> Column:
    at = F.array_position(F.array(*map(F.lit, order)), flag)
    return F.when(at == 0, len(order) + 1).otherwise(at)


def join_flags(parts: Column, order: list[str] = FLAG_ORDER) -> Column:
    """Flags in canonical order; unknown ones after, in the order in which they came."""
    flags = split_cell(join_cell(parts))
    ranked = F.transform(flags, lambda x, i: F.struct(flag_rank(x, order).alias("r"), i.alias("i"), x.alias("x")))
    return F.array_join(F.transform(F.array_sort(ranked), lambda s: s["x"]), "|")


def year(c) -> Column:
    """A year from text such as '1950' or '1950.0'; null where there is none."""
    cell = F.trim(_col(c).cast("string"))
    number = F.when(cell.rlike(r"^[+-]?\d+(\.\d*)?$"), cell.cast("double"))
    return F.when(F.abs(number) < 2147483647.0, number.cast("int"))


def decode_url(c) -> Column:
    """Percent decoding that keeps '+' and leaves malformed text as it is."""
    return F.coalesce(F.try_url_decode(F.replace(_col(c), F.lit("+"), F.lit("%2B"))), _col(c))


def page_title(url) -> Column:
    """The title in a wiki URL: the last path segment without fragment and query, decoded, '_' as space."""
    bare = F.regexp_replace(text(url), r"[#?].*$", "")
    return F.when(F.instr(bare, "/wiki/") > 0, F.replace(decode_url(F.substring_index(bare, "/wiki/", -1)), F.lit("_"), F.lit(" "))).otherwise("")


def page_key(title) -> Column:
    """A title's comparable form: '_' as space, first character upper case."""
    bare = F.trim(F.replace(decode_url(F.regexp_replace(text(title), r"[#?].*$", "")), F.lit("_"), F.lit(" ")))
    return F.concat(F.upper(F.substring(bare, 1, 1)), F.substr(bare, F.lit(2)))


def category_url(name, base: str) -> Column:
    """The address of a category, its prefix put before it if it is missing."""
    bare = F.trim(text(name))
    return F.concat(F.lit(base), F.replace(F.when(bare.startswith("Category:"), bare).otherwise(F.concat(F.lit("Category:"), bare)), F.lit(" "), F.lit("_")))


def without_composer(title) -> Column:
    """A work's title without the composer in brackets at its end: 'Sonata (Bell, Ann)' as 'Sonata'."""
    whole = text(title)
    return F.trim(F.when(whole.endswith(")") & F.contains(whole, F.lit("(")), F.regexp_replace(whole, r"(?s)\([^(]*$", "")).otherwise(whole))


def sort_name(category, display) -> Column:
    """A category's title, else 'Last, First'."""
    own = F.trim(F.replace(F.regexp_replace(text(category), r"^Category:", ""), F.lit("_"), F.lit(" ")))
    words = F.filter(F.split(text(display), r"\s+"), lambda x: x != "")
    last = F.concat(F.element_at(words, -1), F.lit(", "), F.array_join(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), " "))
    return F.when(own != "", own).when(F.size(words) >= 2, last).otherwise(text(display))


def human_tag(tag) -> Column:
    """'late_romantic' as 'Late romantic'."""
    bare = F.replace(text(tag), F.lit("_"), F.lit(" "))
    return F.concat(F.upper(F.substring(bare, 1, 1)), F.substr(bare, F.lit(2)))


def votes(cell) -> Column:
    """'a=x|y;b=z' as array<struct<key, tags>>."""
    pairs = F.filter(F.split(text(cell), ";"), lambda p: F.instr(p, "=") > 0)
    return F.transform(pairs, lambda p: F.struct(F.trim(F.substring_index(p, "=", 1)).alias("key"), F.filter(F.split(F.substring_index(p, "=", -1), r"\|"), lambda x: x != "").alias("tags")))


def truncate_at_sentence(c, limit: int = 1200) -> Column:
    """At most ``limit`` characters, cut after a sentence's end in the second half, else at the last space."""
    head = F.substring(text(c), 1, limit)
    sentence = F.regexp_extract(head, r"(?s)^(.*[.!?])(?=\s)", 1)
    word = F.regexp_extract(head, r"(?s)^(.*)\s", 1)
    cut = F.when(F.char_length(sentence) >= limit // 2, sentence).when(word != "", F.rtrim(word)).otherwise(head)
    return F.when(F.char_length(text(c)) <= limit, text(c)).otherwise(cut)


def dump_label(revision, built) -> Column:
    """'dump r002 · built 2026-09-25'; without a time only the first part."""
    at = F.try_to_timestamp(text(built))
    day = F.coalesce(F.date_format(at, "yyyy-MM-dd"), F.nullif(F.left(text(built), F.lit(10)), F.lit("")))
    return F.concat_ws(" · ", F.concat(F.lit("dump "), text(revision)), F.concat(F.lit("built "), day))


def clean_titles(c) -> Column:
    """Titles glued by ';' or 'and' before a number, as a '|'-list."""
    apart = F.replace(F.replace(text(c), F.lit(";"), F.lit("|")), F.lit("andNo."), F.lit("|No."))
    return join_cell(F.transform(F.split(apart, r"\|"), lambda x: F.trim(x, F.lit(" .;"))))


def fold(c) -> Column:
    """Lower case without the marks of Latin letters."""
    marked, bare = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿāăąćčďđēęěğīłńňōőřśşšťūůűźżž", "aaaaaaceeeeiiiinooooouuuuyyaaaccddeeegilnnoorssstuuuzzz"
    return F.translate(F.lower(text(c)), marked, bare)


def named_on(page, name) -> Column:
    """Whether the last word of a name stands on a page, marks and case aside."""
    last = F.element_at(F.split(F.trim(fold(name)), r"\s+"), -1)
    return (last != "") & F.contains(fold(F.regexp_replace(text(page), r"(?s)<[^>]+>", " ")), last)

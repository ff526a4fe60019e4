"""Queries whose cells are composed from the tables' columns, with rules that the oracle applies on its own."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cells, licences
from ..operators import forces, overlay, resolve, status
from ..sources import tables
from ..sources.tables import spread
from .registry import query, t


def _parts(spark, sf):
    return spread(t(spark, sf, "part"), "p_partkey")


def pick(values: list[str], key: str):
    """One of ``values`` by a whole number."""
    return F.element_at(F.array(*map(F.lit, values)), (F.expr(key) % len(values) + 1).cast("int"))


def sql_pick(values: list[str], key: str) -> str:
    listed = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"([{listed}])[CAST(({key}) % {len(values)} + 1 AS INTEGER)]"


def sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


# Titles: three words that the key picks round the part's own name.

FIRST = ["Nocturne", "Three", "String", "Grand", "Études", "Old", "Piano", "Te", "Symphonic", "Lieder", "Untitled", "Stabat", "Deux", "Organ", "4", "Ballet", ""]
SECOND = ["Songs", "Quartet", "concerto", "Deum", "poem", "in E", "hands", "mater", "pièces", "duet", "No. 2", "Suite", ""]
TITLE = " || ' ' || ".join([sql_pick(FIRST, "p_partkey"), "p_name", sql_pick(SECOND, "p_partkey // 17"), sql_pick(["", "for flute", "opera", "album"], "p_size")])


def _title():
    words = [pick(FIRST, "p_partkey"), F.col("p_name"), pick(SECOND, "p_partkey div 17"), pick(["", "for flute", "opera", "album"], "p_size")]
    return F.when(F.col("p_partkey") % 40 != 0, F.concat_ws(" ", *words)).otherwise("")


def _sql_title_family(words: str) -> str:
    """The ladder of title words, over a list of words."""
    rungs = []
    for family, listed in forces.TITLE_WORDS.items():
        names = [x.strip() for x in listed.split(",")]
        phrases = " OR ".join(f"contains(' ' || array_to_string({words}, ' ') || ' ', ' {x} ')" for x in names)
        rungs.append(f"WHEN {phrases} THEN '{family}'")
    return f"CASE {' '.join(rungs)} ELSE 'unclassified' END"


_TITLES = f"SELECT p_partkey, CASE WHEN p_partkey % 40 <> 0 THEN {TITLE} ELSE '' END AS title FROM part"
_TITLE_WORDS = f"SELECT p_partkey, title, list_filter(regexp_split_to_array(lower(title), '[^\\p{{L}}\\p{{N}}_]+'), lambda x: x <> '') AS w FROM ({_TITLES})"
_TITLE_FAMILY = f"SELECT p_partkey, title, w, CASE WHEN title = '' THEN 'unclassified' ELSE {_sql_title_family('w')} END AS family FROM ({_TITLE_WORDS})"


@query(f"SELECT p_partkey, family, CASE WHEN title = '' THEN 'empty' WHEN family = 'unclassified' THEN 'title_unmapped' ELSE 'title' END AS src FROM ({_TITLE_FAMILY})")
def force_from_title(spark, sf):
    found = forces.from_title(_title())
    return _parts(spark, sf).select("p_partkey", found["family"].alias("family"), found["src"].alias("src"))


# Instrumentation: up to three parts with numbers.

PLAYED = ["violin", "piano", "mixed chorus", "orchestra", "organ", "double bass", "alto saxophone", "soprano", "guitar", "flute", "brass ensemble", "harpsichord", "2 pianos", "zither", "baritone", "strings"]
JOIN = [", ", " and ", "; ", " "]
_PARTS = [("p_partkey", ""), ("p_partkey // 16", ""), ("p_size", "")]


def _instruments():
    a, b, c = pick(PLAYED, "p_partkey"), pick(PLAYED, "p_partkey div 16"), pick(PLAYED, "p_size")
    join = pick(JOIN, "p_partkey div 7")
    n = F.col("p_partkey") % 4
    return F.when(n == 0, a).when(n == 1, F.concat(a, join, b)).when(n == 2, F.concat(a, join, b, join, c)).when(F.col("p_partkey") % 9 == 0, "").otherwise(F.concat(F.upper(a), F.lit("  "), b))


_A, _B, _C, _J = sql_pick(PLAYED, "p_partkey"), sql_pick(PLAYED, "p_partkey // 16"), sql_pick(PLAYED, "p_size"), sql_pick(JOIN, "p_partkey // 7")
_RAW = f"SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN {_A} WHEN 1 THEN {_A} || {_J} || {_B} WHEN 2 THEN {_A} || {_J} || {_B} || {_J} || {_C} ELSE CASE WHEN p_partkey % 9 = 0 THEN '' ELSE upper({_A}) || '  ' || {_B} END END AS raw FROM part"
_LOW = f"SELECT p_partkey, trim(regexp_replace(lower(raw), '\\s+', ' ', 'g')) AS s FROM ({_RAW})"
_NAMED = "|".join(forces.SINGERS_NAMES)
_SUNG = f"SELECT *, regexp_replace(s, '\\b(double bass|contrabass|(soprano|alto|tenor|baritone|bass) ({_NAMED})s?)\\b', '', 'g') AS sung, len(list_filter(regexp_split_to_array(s, ',|/|;|\\+| and '), lambda x: trim(x) <> '')) AS parts, regexp_matches(s, '{'|'.join(forces.ALONE)}') AS alone FROM ({_LOW})"


@query(
    f"""SELECT p_partkey, CASE WHEN s = '' THEN 'unclassified' WHEN regexp_matches(s, 'chorus|choir') THEN 'choral' WHEN regexp_matches(sung, '\\b(voice|soprano|mezzo|alto|contralto|tenor|baritone|bass|narrator)s?\\b') THEN 'solo_voice'
    WHEN regexp_matches(s, '\\b(band|wind ensemble|brass ensemble)\\b') THEN 'wind_band' WHEN contains(s, 'orchestra') AND parts <= 3 AND regexp_matches(s, '\\b({'|'.join(forces.SOLOISTS)})\\b') THEN 'concerto' WHEN contains(s, 'orchestra') THEN 'orchestral'
    WHEN contains(s, 'organ') AND NOT contains(s, 'piano') THEN 'organ' WHEN regexp_matches(s, '\\b(guitar|lute)\\b') THEN 'guitar' WHEN regexp_matches(s, '\\b([346] hands|2 pianos|pianos)\\b') THEN 'piano_ensemble' WHEN s = 'harpsichord' THEN 'keyboard_other'
    WHEN s = 'piano' THEN 'piano_solo' WHEN alone AND (parts = 1 OR (parts = 2 AND contains(s, 'piano'))) THEN 'solo_instrument' WHEN parts >= 2 THEN 'chamber' WHEN contains(s, 'piano') AND NOT contains(s, ',') THEN 'piano_solo' WHEN alone THEN 'solo_instrument' ELSE 'other' END AS family,
    CASE WHEN s = '' THEN 'empty' ELSE 'imslp_geninfo' END AS src FROM ({_SUNG})"""
)
def force_from_instrumentation(spark, sf):
    found = forces.from_instrumentation(_instruments())
    return _parts(spark, sf).select("p_partkey", found["family"].alias("family"), found["src"].alias("src"))


# Categories: two 'For …' cells of up to two parts, a plain name, and arrangements.

SINGLE = ["piano", "violin", "mixed chorus", "orchestra", "organ", "voice", "guitar", "harpsichord", "strings", "flute", "tape", "band", "2 pianos", "3 voices", "piano 4 hands", "unaccompanied voice", "2 players", "1 player", "5 players"]
NAMES = ["Sonatas", "Concertos", "Operas", "Songs", "Quartets", "Fantasias", "Masses", "Symphonies", "Film scores", "Etudes", "Ballets", ""]
#: What each of SINGLE is to the oracle: kind and number.
_SINGLE_KIND = ["piano", "instrument", "chorus", "orchestra", "organ", "voice", "guitar", "keyboard", "orchestra", "instrument", "electronic", "band", "piano", "voice", "piano", "voice", "players", "players", "players"]
_SINGLE_N = [1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 2, 3, 2, 1, 2, 1, 5]
_NAME_FAMILY = ["", "concerto", "stage_opera", "solo_voice", "chamber", "", "choral", "orchestral", "film_media", "pedagogical", "stage_ballet", ""]


def _cell():
    a, b = pick(SINGLE, "p_partkey"), pick(SINGLE, "p_partkey div 19")
    one = F.concat(F.lit("For "), F.when(F.col("p_partkey") % 3 == 0, a).otherwise(F.concat(a, F.when(F.col("p_partkey") % 3 == 1, ", ").otherwise(" and "), b)))
    name = pick(NAMES, "p_partkey div 5")
    arranged = F.when(F.col("p_partkey") % 7 == 3, " (arr)").otherwise("")
    return F.concat_ws("|", F.when(F.col("p_partkey") % 11 != 5, F.concat(one, arranged)), F.nullif(name, F.lit("")))


def _numbers(values: list[int], key: str) -> str:
    return f"([{', '.join(map(str, values))}])[CAST(({key}) % {len(values)} + 1 AS INTEGER)]"


_FORCES = f"""SELECT p_partkey, p_partkey % 11 <> 5 AS has_for, p_partkey % 7 = 3 AS arr, p_partkey % 3 = 0 AS single, {sql_pick(_SINGLE_KIND, 'p_partkey')} AS k1, {_numbers(_SINGLE_N, 'p_partkey')} AS n1, {sql_pick(_SINGLE_KIND, 'p_partkey // 19')} AS k2,
    CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE {_numbers(_SINGLE_N, 'p_partkey // 19')} END AS n2, {sql_pick(SINGLE, 'p_partkey')} AS s1, {sql_pick(SINGLE, 'p_partkey // 19')} AS s2, {sql_pick(NAMES, 'p_partkey // 5')} AS name, {sql_pick(_NAME_FAMILY, 'p_partkey // 5')} AS named FROM part"""
_KINDS = f"SELECT *, CASE WHEN single THEN [k1] ELSE [k1, k2] END AS ks, (CASE WHEN k1 IN ('piano', 'organ', 'keyboard') THEN n1 ELSE 0 END) + (CASE WHEN NOT single AND k2 IN ('piano', 'organ', 'keyboard') THEN n2 ELSE 0 END) AS keys, n1 + n2 AS total FROM ({_FORCES})"
_TOLD = f"""SELECT *, CASE WHEN list_contains(ks, 'chorus') THEN 'choral' WHEN list_contains(ks, 'voice') AND len(list_distinct(ks)) = 1 AND (total >= 3 OR contains(s1, 'unaccompanied') OR (NOT single AND contains(s2, 'unaccompanied'))) THEN 'choral' WHEN list_contains(ks, 'voice') THEN 'solo_voice'
    WHEN list_contains(ks, 'orchestra') AND len(list_distinct(ks)) = 1 THEN 'orchestral' WHEN list_contains(ks, 'orchestra') THEN 'concerto' WHEN list_contains(ks, 'band') THEN 'wind_band' WHEN list_contains(ks, 'electronic') THEN 'electronic' WHEN single AND k1 = 'players' THEN CASE WHEN n1 >= 2 THEN 'chamber' ELSE '' END
    WHEN list_contains(ks, 'guitar') THEN 'guitar' WHEN keys = total AND list_distinct(ks) = ['piano'] AND keys < 2 THEN 'piano_solo' WHEN keys = total AND list_distinct(ks) = ['organ'] THEN 'organ' WHEN keys = total AND list_distinct(ks) = ['keyboard'] THEN 'keyboard_other' WHEN keys = total THEN 'piano_ensemble'
    WHEN total - keys = 1 AND keys <= 1 THEN 'solo_instrument' ELSE 'chamber' END AS told FROM ({_KINDS})"""
_HITS = f"""SELECT *, list_filter([CASE WHEN has_for AND NOT arr AND NOT (single AND k1 = 'players') THEN told ELSE '' END, CASE WHEN name <> 'Quartets' THEN named ELSE '' END], lambda x: x <> '') AS strong,
    list_filter([CASE WHEN has_for AND NOT arr AND single AND k1 = 'players' THEN told ELSE '' END, CASE WHEN name = 'Quartets' THEN named ELSE '' END], lambda x: x <> '') AS weak FROM ({_TOLD})"""
_CHOSEN = f"SELECT *, CASE WHEN len(strong) > 0 THEN strong ELSE weak END AS h FROM ({_HITS})"
_FAMILY = f"""SELECT *, CASE WHEN name = '' AND NOT (has_for AND NOT arr) THEN 'unclassified' WHEN len(h) = 0 THEN 'other' WHEN list_contains(h, 'stage_opera') THEN 'stage_opera' WHEN list_contains(h, 'stage_ballet') THEN 'stage_ballet'
    WHEN list_contains(h, 'choral') AND list_has_any(h, ['solo_voice', 'concerto', 'orchestral']) THEN 'choral' WHEN list_contains(h, 'solo_voice') AND list_contains(h, 'concerto') THEN 'solo_voice' WHEN list_contains(h, 'concerto') THEN 'concerto'
    WHEN list_contains(h, 'orchestral') AND list_contains(h, 'piano_ensemble') THEN 'orchestral' WHEN list_contains(h, 'piano_ensemble') THEN 'piano_ensemble' ELSE {sql_list(forces.FAMILIES)}[list_max(list_transform(h, lambda x: list_position({sql_list(forces.FAMILIES)}, x)))] END AS family,
    CASE WHEN name = '' AND NOT (has_for AND NOT arr) THEN CASE WHEN has_for THEN 'arr_only' ELSE 'empty' END WHEN len(h) = 0 THEN 'categories_unmapped' ELSE 'imslp_tags' END AS src FROM ({_CHOSEN})"""


@query(f"SELECT p_partkey, family, src FROM ({_FAMILY})")
def force_from_categories(spark, sf):
    found = forces.from_categories(_cell())
    return _parts(spark, sf).select("p_partkey", found.alias("found")).select("p_partkey", "found.family", "found.src")


@query(
    f"""SELECT p_partkey, CASE WHEN NOT weak_cell THEN cf WHEN titled AND tf <> 'other' THEN tf WHEN p_partkey % 3 = 0 THEN 'orchestral' WHEN titled THEN tf ELSE cf END AS family, CASE WHEN NOT weak_cell THEN cs WHEN titled AND tf <> 'other' THEN 'title' WHEN p_partkey % 3 = 0 THEN 'llm' WHEN titled THEN 'title' ELSE cs END AS src
    FROM (SELECT c.p_partkey, c.family AS cf, c.src AS cs, d.family AS tf, c.family IN ('unclassified', 'other') AS weak_cell, d.title <> '' AND d.family <> 'unclassified' AS titled FROM ({_FAMILY}) c JOIN ({_TITLE_FAMILY}) d ON c.p_partkey = d.p_partkey)"""
)
def rule_ladder_with_provenance(spark, sf):
    held = F.col("p_partkey") % 3 == 0
    found = forces.with_provenance(_cell(), _title(), F.lit(""), F.when(held, "orchestral").otherwise(""), F.when(held, "llm").otherwise(""))
    return _parts(spark, sf).select("p_partkey", found.alias("found")).select("p_partkey", "found.family", "found.src")


_FORM_RULES = " ".join(
    f"WHEN {' OR '.join([*(f'name = {chr(39)}{n}{chr(39)}' for n in names), *(f'contains(line, {chr(39)} {w.strip()} {chr(39)})' if '*' not in w else f'contains(line, {chr(39)} {w.strip()[:-1]}{chr(39)})' for w in listed.split(',') if w.strip())])} THEN '{form}'"
    for form, (names, listed) in forces.FORMS.items()
)


@query(
    f"""SELECT p_partkey, CASE {_FORM_RULES} WHEN has_for AND arr THEN 'arrangement' ELSE '' END AS form, CASE WHEN has_for AND NOT arr AND single AND k1 = 'players' THEN CAST(n1 AS VARCHAR) ELSE '' END AS n_players
    FROM (SELECT f.*, ' ' || array_to_string(list_filter(regexp_split_to_array(lower((CASE WHEN has_for THEN 'For ' || s1 || CASE WHEN single THEN '' ELSE ' and ' || s2 END ELSE '' END) || ' ' || f.name || ' ' || title), '[^\\p{{L}}\\p{{N}}_]+'), lambda x: x <> ''), ' ') || ' ' AS line FROM ({_FORCES}) f JOIN ({_TITLES}) d ON f.p_partkey = d.p_partkey)"""
)
def genre_ladder_first_match(spark, sf):
    return _parts(spark, sf).select("p_partkey", forces.genre_form(_cell(), _title()).alias("form"), forces.n_players(_cell()).alias("n_players"))


@query(f"SELECT c.p_partkey, CASE WHEN weak_cell AND titled THEN tf ELSE cf END AS family, CASE WHEN weak_cell AND titled THEN 'title' ELSE cs END AS src FROM (SELECT c.p_partkey, c.family AS cf, c.src AS cs, d.family AS tf, c.family IN ('unclassified', 'other') AS weak_cell, d.title <> '' AND d.family <> 'unclassified' AS titled FROM ({_FAMILY}) c JOIN ({_TITLE_FAMILY}) d ON c.p_partkey = d.p_partkey) c")
def crawl_labels(spark, sf):
    found = forces.crawl_labels(_cell(), _title())
    return _parts(spark, sf).select("p_partkey", found["family"].alias("family"), found["src"].alias("src"))


# Licences.


@query(
    """SELECT doc_id, CASE WHEN contains(line, ' cc0 ') OR contains(line, ' cc zero ') THEN 'CC0-1.0' WHEN contains(line, ' creative commons ') AND contains(line, ' attribution') THEN 'CC-BY' || CASE WHEN contains(line, ' noncommercial') THEN '-NC' ELSE '' END || v WHEN len(run) > 0
    THEN 'CC-BY' || CASE WHEN list_contains(run, 'nc') THEN '-NC' ELSE '' END || CASE WHEN list_contains(run, 'nd') THEN '-ND' WHEN list_contains(run, 'sa') THEN '-SA' ELSE '' END || v ELSE '' END AS spdx
    FROM (SELECT doc_id, line, string_split(nullif(regexp_extract(line, ' cc (by(?: [a-z_]\\w*)*) ', 1), ''), ' ') AS run, coalesce('-' || list_filter(w, lambda x: regexp_matches(x, '^\\d\\.\\d$'))[1], '') AS v
    FROM (SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS line FROM (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(lower(text), '[^a-z0-9._]+'), lambda x: trim(x, '.')), lambda x: x <> '') AS w FROM documents)))"""
)
def spdx_from_text(spark, sf):
    return t(spark, sf, "documents").select("doc_id", licences.spdx_from_text("text").alias("spdx"))


HOSTS = ["https://creativecommons.org/licenses/", "http://i.creativecommons.org/l/", "https://licensebuttons.net/l/", "https://www.creativecommons.org/licenses/", "https://example.org/licenses/"]
CODE = ["by", "by-sa", "by-nc", "by-nd-nc", "by-nc-sa", "nc", "by-nd", "by-nc-nd"]
_SPDX = ["CC-BY", "CC-BY-SA", "CC-BY-NC", "CC-BY-NC-ND", "CC-BY-NC-SA", "", "CC-BY-ND", "CC-BY-NC-ND"]
TAIL = ["", "/", "/de/", "/88x31.png", "/us?x=1"]
TAILS = ["", "", "-DE", "", "-US"]


@query(
    f"""SELECT c_custkey, CASE WHEN c_custkey % 13 = 0 THEN CASE WHEN c_nationkey % 2 = 0 THEN 'CC0-1.0' ELSE 'CC-PDM-1.0' END WHEN c_custkey % 5 = 4 OR code = '' THEN '' WHEN c_custkey % 3 = 0 THEN code ELSE code || '-' || (c_nationkey % 4 + 1) || '.0' || tail END AS spdx
    FROM (SELECT c_custkey, c_nationkey, {sql_pick(_SPDX, 'c_custkey // 5')} AS code, {sql_pick(TAILS, 'c_nationkey')} AS tail FROM customer)"""
)
def spdx_from_url(spark, sf):
    version = F.concat((F.col("c_nationkey") % 4 + 1).cast("string"), F.lit(".0"))
    licence = F.concat(pick(HOSTS, "c_custkey"), pick(CODE, "c_custkey div 5"), F.when(F.col("c_custkey") % 3 == 0, "/").otherwise(F.concat(F.lit("/"), version, pick(TAIL, "c_nationkey"))))
    tool = F.concat(F.lit("https://creativecommons.org/publicdomain/"), F.when(F.col("c_nationkey") % 2 == 0, "zero/1.0/").otherwise("mark/"))
    return t(spark, sf, "customer").select("c_custkey", licences.spdx_from_url(F.when(F.col("c_custkey") % 13 == 0, tool).otherwise(licence)).alias("spdx"))


RIGHTS = ["Public Domain", "Public  Domain (dedicated)", "Creative Commons Attribution", "Performance Restricted Attribution", "Choral Public Domain Library License v", "EFF Open Audio License", "Public Domain {{RoST}}", "ask the author", "", "performance restricted", "CC0"]
WITH = ["", "-NonCommercial", " Non-Commercial No-Derivs", "-ShareAlike", "-NoDerivatives-ShareAlike"]
_WITH = ["", "-NC", "-NC-ND", "-SA", "-ND"]
FILES = ["a.pdf", "b.MID", "c.mxl", "d.mp3", "e.abc", "noextension", "f.zip?x"]
_FORMAT = ["pdf", "midi", "musicxml", "audio", "other", "other", "zip"]
_OPEN = r"^(CC-|CC0-|PD-dedicated$|LicenseRef-CPDL|LicenseRef-EFF-OAL)"


@query(
    f"""SELECT c_custkey, licence, regexp_matches(licence, '{_OPEN}') AS is_open, CASE WHEN f1 = f2 THEN f1 ELSE f1 || '|' || f2 END AS formats FROM (SELECT c_custkey, {sql_pick(_FORMAT, 'c_custkey')} AS f1, {sql_pick(_FORMAT, 'c_custkey // 7')} AS f2,
    CASE c_custkey % 11 WHEN 0 THEN 'PD' WHEN 1 THEN 'PD-dedicated' WHEN 2 THEN 'CC-BY' || w || v WHEN 3 THEN 'LicenseRef-IMSLP-PR-BY' || w || v WHEN 4 THEN 'LicenseRef-CPDL-' || (c_nationkey % 3) WHEN 5 THEN 'LicenseRef-EFF-OAL' WHEN 6 THEN 'PD-note' WHEN 7 THEN 'unparsed' WHEN 8 THEN '' WHEN 9 THEN 'LicenseRef-IMSLP-PR' ELSE 'CC0-1.0' END AS licence
    FROM (SELECT *, {sql_pick(_WITH, 'c_custkey // 11')} AS w, '-' || (c_nationkey % 4 + 1) || '.0' AS v FROM customer))"""
)
def licence_ids(spark, sf):
    k, n = F.col("c_custkey") % 11, F.col("c_nationkey")
    more = F.concat(pick(WITH, "c_custkey div 11"), F.lit(" "), (n % 4 + 1).cast("string"), F.lit(".0"))
    raw = F.concat(pick(RIGHTS, "c_custkey"), F.when(k.isin(2, 3), more).when(k == 4, (n % 3).cast("string")).otherwise(""))
    files = F.array(pick(FILES, "c_custkey"), pick(FILES, "c_custkey div 7"))
    found = licences.licence_id(raw)
    return t(spark, sf, "customer").select("c_custkey", found.alias("licence"), licences.is_open(found).alias("is_open"), F.array_join(licences.file_formats(files), "|").alias("formats"))


# Cells, names and addresses.

FLAGS = ["birth_imprecise", "manual_override", "zz", "not_human", "aa", "gnd_from_lobid", "", " birth_imprecise "]


@query(
    f"""SELECT c_custkey, coalesce((SELECT string_agg(x, '|' ORDER BY r, i) FROM (SELECT x, min(i) AS i, coalesce(nullif(list_position({sql_list(cells.FLAG_ORDER)}, x), 0), 999) AS r FROM (SELECT trim(unnest(f)) AS x, unnest([1, 2, 3]) AS i) WHERE x <> '' GROUP BY x)), '') AS flags
    FROM (SELECT c_custkey, [{sql_pick(FLAGS, 'c_custkey')}, {sql_pick(FLAGS, 'c_custkey // 8')}, {sql_pick(FLAGS, 'c_nationkey')}] AS f FROM customer)"""
)
def flags_canonical_order(spark, sf):
    parts = F.array(pick(FLAGS, "c_custkey"), pick(FLAGS, "c_custkey div 8"), pick(FLAGS, "c_nationkey"))
    return t(spark, sf, "customer").select("c_custkey", cells.join_flags(parts).alias("flags"))


@query(
    """SELECT s_suppkey, CASE WHEN s_suppkey % 7 = 0 THEN '' ELSE replace(s_name, '#', ' ') || ' Åse' END AS title, CASE WHEN s_suppkey % 3 = 0 THEN replace(s_name, '#', ' ') || ', ' || s_nationkey WHEN s_suppkey % 3 = 1 THEN 'Åse, ' || replace(s_name, '#', ' ') ELSE 'Solo' END AS sort_name,
    upper(substr(s_name, 1, 1)) || replace(substr(s_name, 2), '#', ' ') AS tag, CASE WHEN s_suppkey % 7 = 0 THEN 'unknown' WHEN s_suppkey % 2 = 0 THEN 'agree' ELSE 'differs' END AS link FROM supplier"""
)
def names_and_urls(spark, sf):
    name = F.replace("s_name", F.lit("#"), F.lit("_"))
    url = F.when(F.col("s_suppkey") % 7 == 0, "https://example.org/").otherwise(F.concat(F.lit("https://en.wikipedia.org/wiki/"), name, F.lit("_%C3%85se#Life?x=1")))
    category = F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit("Category:"), name, F.lit(",_"), F.col("s_nationkey").cast("string"))).otherwise("")
    display = F.when(F.col("s_suppkey") % 3 == 1, F.concat(F.replace(name, F.lit("_"), F.lit(" ")), F.lit("  Åse"))).otherwise("Solo")
    titled = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lower(F.left(name, F.lit(1))), F.substr(name, F.lit(2)), F.lit(" Åse"))).otherwise("Other")
    return t(spark, sf, "supplier").select("s_suppkey", cells.page_title(url).alias("title"), cells.sort_name(category, display).alias("sort_name"), cells.human_tag(name).alias("tag"), resolve.compare_links(url, titled).alias("link"))


@query(
    """WITH RECURSIVE r AS (SELECT o_orderkey AS k, o_orderkey // 3 AS n FROM orders WHERE o_orderkey % 4 <> 0), w(title, target, hops) AS (SELECT DISTINCT o_orderkey, o_orderkey, 0 FROM orders UNION ALL SELECT w.title, r.n, hops + 1 FROM w JOIN (SELECT DISTINCT * FROM r) r ON r.k = w.target)
    SELECT CAST(title AS VARCHAR) AS title, CAST(arg_max(target, hops) AS VARCHAR) AS target FROM w GROUP BY title"""
)
def resolve_titles(spark, sf):
    orders = t(spark, sf, "orders").select("o_orderkey").distinct()
    hops = orders.where("o_orderkey % 4 <> 0").select(F.col("o_orderkey").cast("string").alias("from"), F.expr("o_orderkey div 3").cast("string").alias("to"))
    return tables.resolve_titles(orders.select(F.col("o_orderkey").cast("string").alias("title")), hops)


HOST = ["PMLUS", "PMLASIA", "PMLP", "PMLXX"]


@query(
    """SELECT l_orderkey, CASE WHEN len(h) > 0 THEN 'true' ELSE 'false' END AS has_files, array_to_string(list_sort(list_distinct(h)), '|') AS hosts,
    CASE WHEN len(h) = 0 THEN 'no files' WHEN list_contains(h, 'asia') THEN 'asia (life+50 server)' WHEN list_contains(h, 'us') THEN 'us (US-only server)' ELSE 'ca (main server only)' END AS host_group
    FROM (SELECT l_orderkey, list_filter(list(CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE (['us', 'asia', 'ca', 'xx'])[CAST(l_suppkey % 4 + 1 AS INTEGER)] END), lambda x: x IS NOT NULL) AS h FROM lineitem GROUP BY 1)"""
)
def file_hosts(spark, sf):
    name = F.concat(F.lit("PMLP"), F.col("l_partkey").cast("string"), F.lit("-"), pick(HOST, "l_suppkey"), F.col("l_linenumber").cast("string"), F.lit("-x."), F.when(F.col("l_partkey") % 3 == 0, "JPG").otherwise("pdf"))
    lists = t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list(name).alias("files"))
    e = status.file_evidence(F.col("files"))
    return lists.select("l_orderkey", e["has_files"].alias("has_files"), e["hosts"].alias("hosts"), status.host_group(e["has_files"], e["hosts"]).alias("host_group"))


RIGHT = ["WorkNonPD-EU", "WIMA files", "WorkPD-USonly", "Nothing", "WorkNonPD-USandEU"]


@query(
    """SELECT o_custkey, coalesce(string_agg(DISTINCT CASE WHEN o_orderkey % 4 = 0 THEN lower(o_orderpriority) END, '|' ORDER BY CASE WHEN o_orderkey % 4 = 0 THEN lower(o_orderpriority) END), '') AS styles, coalesce(CAST(min(CASE WHEN o_orderkey % 4 = 1 THEN year(o_orderdate) END) AS VARCHAR), '') AS first_published,
    coalesce(array_to_string(list_sort(list_distinct(flatten(list(CASE WHEN o_orderkey % 4 = 2 THEN CASE (o_orderkey // 4) % 5 WHEN 0 THEN ['nonpd_eu'] WHEN 1 THEN ['wima'] WHEN 2 THEN ['pd_us_only'] WHEN 4 THEN ['nonpd_eu', 'nonpd_us'] ELSE [] END ELSE [] END)))), '|'), '') AS flags FROM orders GROUP BY 1"""
)
def evidence_fields(spark, sf):
    k = F.col("o_orderkey")
    category = F.when(k % 4 == 0, F.concat(F.lower("o_orderpriority"), F.lit(" style"))).when(k % 4 == 1, F.concat(F.lit("Works first published in "), F.year("o_orderdate").cast("string"))).when(k % 4 == 2, pick(RIGHT, "o_orderkey div 4")).otherwise("Works first published in 19")
    lists = t(spark, sf, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(category)).alias("c"))
    e = status.evidence(F.col("c"))
    return lists.select("o_custkey", e["styles"].alias("styles"), e["first_published"].alias("first_published"), e["flags"].alias("flags"))


# Faults of overrides: some of the orders as corrections of customers.

_FAULTY = "SELECT CAST(o_custkey AS VARCHAR) AS key, CASE o_orderkey % 5 WHEN 0 THEN 'c_name' WHEN 1 THEN 'c_color' WHEN 2 THEN '_drop' WHEN 3 THEN 'rekey' ELSE 'c_acctbal' END AS field, CASE WHEN o_orderkey % 5 = 3 THEN CAST(o_orderkey // 7 AS VARCHAR) ELSE 'x' END AS value, CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE 'why' END AS reason FROM orders WHERE o_orderkey % 17 = 0"


@query(
    f"""WITH o AS ({_FAULTY}), b AS (SELECT CAST(c_custkey AS VARCHAR) AS k FROM customer WHERE c_custkey % 5 <> 0), m AS (SELECT * FROM o WHERE field = 'rekey') SELECT error, "key", field FROM (SELECT 'missing reason' AS error, key, field FROM o WHERE reason = '' UNION ALL SELECT 'unknown field', key, field FROM o WHERE field = 'c_color'
    UNION ALL SELECT 'duplicate override', key, field FROM o GROUP BY key, field HAVING count(*) > 1 UNION ALL SELECT 'unknown key', key, field FROM o WHERE key NOT IN (SELECT k FROM b) UNION ALL SELECT 'dropped key has other overrides', key, field FROM o WHERE field <> '_drop' AND key IN (SELECT key FROM o WHERE field = '_drop')
    UNION ALL SELECT 'new key is taken', key, field FROM m WHERE value IN (SELECT k FROM b) AND value NOT IN (SELECT key FROM m) UNION ALL SELECT 'new key given twice', key, field FROM m WHERE value IN (SELECT value FROM m GROUP BY value HAVING count(*) > 1))"""
)
def override_errors(spark, sf):
    k = F.col("o_orderkey")
    field = F.when(k % 5 == 0, "c_name").when(k % 5 == 1, "c_color").when(k % 5 == 2, "_drop").when(k % 5 == 3, "rekey").otherwise("c_acctbal")
    rows = t(spark, sf, "orders").where("o_orderkey % 17 = 0").select(
        F.col("o_custkey").alias("key"), field.alias("field"), F.when(k % 5 == 3, F.expr("o_orderkey div 7").cast("string")).otherwise("x").alias("value"), F.when(k % 6 == 0, "").otherwise("why").alias("reason"), *(F.lit("y").alias(c) for c in ("source", "reviewer", "date"))
    )
    return overlay.override_errors(rows, t(spark, sf, "customer").where("c_custkey % 5 <> 0"), "c_custkey", ["c_name", "c_acctbal"])

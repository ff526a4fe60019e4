"""Style tags: periods and slugs, names shown for them, their order, votes as facet values, and facets of old addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..operators.entities import PERIODS
from .cells import split_cell, text

#: Tags that a knowledge base gives, which are slugs already; periods of slugs that have no name of their own.
TAG_SLUGS = ["impressionism", "expressionism", "neoclassicism", "serialism", "minimalism", "postminimalism", "spectralism", "electroacoustic", "avant_garde", "national_folk", "late_romantic", "atonal_modernism", "polystylism"]
#: Names that stand for others.
ALIASES = {"Romántico": "Romantic", "Traditional": "Traditional (folk)"}
#: Labels that no rule gives.
LABELS = {"late_romantic": "Late Romantic", "national_folk": "National / folk", "avant_garde": "Avant-garde", "atonal_modernism": "Atonal modernism", "postminimalism": "Post-minimalism"}
#: The order of styles, era first.
ORDER = ["Ancient", "Medieval", "Renaissance", "Baroque", "Classical", "Romantic", "late_romantic", "Early 20th century", "impressionism", "expressionism", "national_folk", "neoclassicism", "atonal_modernism", "serialism", "Modern", "avant_garde", "electroacoustic", "minimalism", "postminimalism", "spectralism", "polystylism", "Jazz", "Traditional (folk)", "Non-western classical"]
#: Buckets of the public domain facet, and the values of old addresses with the buckets that they stand for.
BUCKETS = ["now", "next", "soon", "later", "unknown"]
OLD_BUCKETS = {"within5": ["next", "soon"]}
OLD_STATUSES = {"pd": ["now"], "not_pd": ["next", "soon", "later"], "unknown_death": ["unknown"]}


def _table(pairs: dict) -> Column:
    value = lambda v: F.array(*map(F.lit, v)) if isinstance(v, list) else F.lit(v)
    return F.create_map(*(x for k, v in pairs.items() for x in (F.lit(k), value(v))))


def period_slug(period) -> Column:
    """The slug of a period's name; null for '' and unknown names."""
    return F.try_element_at(_table(PERIODS), F.trim(text(period)))


def tag_slug(tag) -> Column:
    """A tag of the vocabulary as it is; null otherwise."""
    known = sorted({*TAG_SLUGS, *PERIODS.values()})
    return F.when(F.trim(text(tag)).isin(known), F.trim(text(tag)))


def canonical_style(name: Column) -> Column:
    return F.coalesce(F.try_element_at(_table(ALIASES), name), name)


def canonical_styles(cell) -> Column:
    """A '|'-list of styles with aliases merged, each once in its first place."""
    return F.array_distinct(F.transform(split_cell(cell), canonical_style))


def facet_value(slug: Column) -> Column:
    """The value that a slug has among facets: the first name of its period, else itself."""
    first: dict[str, str] = {}
    for name, of in PERIODS.items():
        first.setdefault(of, ALIASES.get(name, name))
    return F.coalesce(F.try_element_at(_table(first), slug), slug)


def shown_tag(tag) -> Column:
    """A label: its own one, else each word with an upper-case letter."""
    words = F.filter(F.split(text(tag), "_"), lambda w: w != "")
    rule = F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substr(w, F.lit(2)))), " ")
    return F.coalesce(F.try_element_at(_table(LABELS), text(tag)), rule)


def in_order(values: Column) -> Column:
    """Distinct non-empty values: those of ``ORDER`` first and in it, others by name."""
    present = F.array_distinct(F.filter(values, lambda v: F.coalesce(v, F.lit("")) != ""))
    known = F.array(*map(F.lit, ORDER))
    return F.concat(F.filter(known, lambda v: F.array_contains(present, v)), F.array_sort(F.array_except(present, known)))


def votes_by_labeller(cell, labellers: list[str]) -> Column:
    """array<array<string>> of facet values in the order of the labellers, null for one without a vote; an empty array without any vote."""
    votes = F.filter(F.split(text(cell), ";"), lambda p: F.contains(p, F.lit("=")))
    entries = F.transform(votes, lambda p: F.struct(F.substring_index(p, "=", 1).alias("by"), F.substr(p, F.instr(p, F.lit("=")) + 1).alias("told")))

    def of(labeller: str) -> Column:
        mine = F.filter(entries, lambda e: e["by"] == labeller)
        last = F.element_at(F.transform(mine, lambda e: e["told"]), -1)
        return F.when(F.size(mine) > 0, F.transform(split_cell(last), facet_value))

    return F.when(F.size(entries) > 0, F.array(*map(of, labellers))).otherwise(F.array().cast("array<array<string>>"))


def period_votes_by_labeller(cell, labellers: list[str]) -> Column:
    """array<string>: each labeller's period as a facet value, '' for 'unknown', null without a vote; an empty array without any vote."""
    given = votes_by_labeller(cell, labellers)
    return F.transform(given, lambda v: F.when(v.isNotNull(), F.when(F.array_join(v, "|") == "unknown", "").otherwise(F.array_join(v, "|"))))


def buckets_of_old_address(buckets: Column, statuses: Column) -> Column:
    """Distinct buckets that the values of an old address stand for; unknown values leave."""
    one = F.transform(buckets, lambda v: F.coalesce(F.try_element_at(_table(OLD_BUCKETS), v), F.when(v.isin(BUCKETS), F.array(v)), F.array().cast("array<string>")))
    two = F.transform(statuses, lambda v: F.coalesce(F.try_element_at(_table(OLD_STATUSES), v), F.array().cast("array<string>")))
    return F.array_distinct(F.concat(F.flatten(one), F.flatten(two)))

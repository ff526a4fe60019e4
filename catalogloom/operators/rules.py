"""Ordered rules as one Catalyst expression: the first that holds gives the label."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def ladder(rules: Iterable[tuple[Column, str]], default: str | None = None) -> Column:
    """Labels by the first condition that holds; a null condition does not hold."""
    return F.coalesce(*(F.when(condition, F.lit(label)) for condition, label in rules), F.lit(default))


def first(facts: Column, rules: Iterable[tuple[str, Callable[[Column], Column]]]) -> Column:
    """The label of the first rule whose test of a struct of facts holds."""
    return ladder([(test(facts), label) for label, test in rules])


def words_of(c: Column) -> Column:
    """Runs of letters, digits and underscores, letters of any script counting as letters."""
    return F.regexp_extract_all(c, F.lit(r"(?U)\w+"), F.lit(0))  # a split would compile its pattern again for each row


def overlap(values: Column, names: Iterable[str]) -> Column:
    return F.arrays_overlap(values, F.array(*map(F.lit, names)))


def phrase_in(words: Column, listed: str) -> Column:
    """Whether one of the comma-parted words or phrases stands in ``words``; 'symphon*' fits any ending."""
    names = [x.strip() for x in listed.split(",")]
    single, phrases, open_ = [x for x in names if " " not in x and "*" not in x], [x for x in names if " " in x], [x[:-1] for x in names if "*" in x]
    line = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
    tests = ([overlap(words, single)] if single else []) + [line.contains(f" {x} ") for x in phrases] + [line.contains(f" {x}") for x in open_]
    out = tests[0]
    for test in tests[1:]:
        out = out | test
    return out

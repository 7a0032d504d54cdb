"""Column expressions on names of people: what Catalyst can do of the name kernel."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .kernel import HONORIFICS, MONONYMS, SUFFIXES


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _words(c: Column) -> Column:
    bare = F.transform(F.split(c, r"[\s/,]+"), lambda w: F.regexp_replace(w, r"(?U)^\W+|\W+$", ""))
    return F.filter(bare, lambda w: w != "")


def _from_first(words: Column, skip: list[str]) -> Column:
    """The words from the first on that isn't one of skip."""
    at = F.array_position(F.transform(words, lambda w: ~w.isin(*skip)), F.lit(True)).cast("int")
    return F.when(at > 0, F.slice(words, at, F.size(words))).otherwise(F.array().cast("array<string>"))


def person_words(c: str | Column) -> Column:
    """kernel.person_words() as an expression."""
    x = F.regexp_replace(F.lower(_col(c)), r"\([^)]*\)", " ")
    family, given = F.substring_index(x, ",", 1), F.regexp_extract(x, "(?s)^[^,]*,(.*)$", 1)
    only_suffixes = F.forall(F.filter(F.split(given, r"[\s.]+"), lambda w: w != ""), lambda w: w.isin(*SUFFIXES))
    words = F.when(only_suffixes, _words(family)).otherwise(F.concat(_words(given), _words(family)))
    return F.reverse(_from_first(F.reverse(_from_first(words, HONORIFICS)), SUFFIXES))


def is_initial(word: Column) -> Column:
    return word.rlike(r"^[a-z](?:\.[a-z])*$")


def record_scoped(c: str | Column) -> Column:
    """kernel.is_record_scoped() as an expression; a description in square brackets is scoped as well."""
    w = person_words(c)
    last = F.try_element_at(w, F.lit(-1))
    by_words = F.when(F.size(w) > 1, is_initial(last) & ~last.rlike("^[ivx]{1,4}$")).otherwise(~F.coalesce(last.isin(*MONONYMS), F.lit(False)))
    return F.when(_col(c).isNotNull(), _col(c).rlike(r"^\s*\[[^\[\]]+\]\s*$") | by_words)

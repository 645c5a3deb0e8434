"""Text functions of the transform rules, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(column: Column) -> Column:
    """Remove leading and trailing white space of any kind, not only blanks."""
    return F.regexp_replace(column, r"(?U)^\s+|\s+$", "")


def title_case(column: Column) -> Column:
    """Upper-case every letter that does not follow a letter, lower-case the rest.

    Differs from ``initcap``, which only starts a word after white space:
    ``o'neil a-b`` gives ``O'Neil A-B`` here and ``O'neil A-b`` there.
    """
    chars = F.split(column, "")

    def cased(char: Column, i: Column) -> Column:
        follows_letter = F.coalesce(F.get(chars, i - 1), F.lit("")).rlike(r"\p{L}")
        return F.when(follows_letter, F.lower(char)).otherwise(F.upper(char))

    return F.array_join(F.transform(chars, cased), "")


def fill_path(template: Column, value: Column, placeholder: str = "{}") -> Column:
    """Put a value, usually a formatted business date, into a stored path."""
    return F.replace(template, F.lit(placeholder), value)


def first_non_empty(override: Column, configured: Column) -> Column:
    return F.coalesce(F.nullif(override, F.lit("")), configured)

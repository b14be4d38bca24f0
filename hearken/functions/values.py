"""Numbers, dates and JSON as Column expressions. What cannot be parsed is null, never zero."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank_to_null, strip

# Fixed values.
SATISFACTION_SCALE = ("Very Dissatisfied", "Dissatisfied", "Neutral", "Satisfied", "Very Satisfied")


def rating(value: Column) -> Column:
    """An integer from 1 to 5, or null; 4.7 is not one."""
    own = strip(value)
    n = F.when(own.rlike(r"^[+-]?\d{1,9}$"), own).try_cast("int")
    return F.when(n.between(1, 5), n)


def iso_date(value: Column) -> Column:
    """A date that exists, as yyyy-MM-dd, or null."""
    own = strip(value)
    return F.date_format(F.when(own.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(own, "y-M-d")), "yyyy-MM-dd")


def satisfaction_ordinal(label: Column) -> Column:
    """1 to 5, or null for an unknown label."""
    found = F.array_position(F.array(*map(F.lit, SATISFACTION_SCALE)), label).cast("int")
    return F.when(found > 0, found)


def satisfaction_gap(ordinal: Column, *ratings: Column) -> Column:
    """Stated satisfaction less the mean of the ratings present, to 2 places; null if either is missing."""
    total = reduce(Column.__add__, (F.coalesce(r.cast("double"), F.lit(0.0)) for r in ratings))
    present = reduce(Column.__add__, (r.isNotNull().cast("int") for r in ratings))
    return F.bround(ordinal - F.try_divide(total, present), 2)


def satisfaction_for(product: Column, service: Column) -> Column:
    """The label that two ratings imply: the first whose upper bound is over their mean."""
    mean = (product + service) / 2.0
    out = None
    for bound, label in zip((1.5, 2.5, 3.5, 4.5, 5.1), SATISFACTION_SCALE, strict=True):
        out = F.when(mean < bound, label) if out is None else out.when(mean < bound, label)
    return out


def recovered_json(text: Column) -> Column:
    """The text as a variant; else what its outermost braces hold; else null."""
    return F.coalesce(F.try_parse_json(text), F.try_parse_json(blank_to_null(F.regexp_extract(text, r"(?s)\{.*\}", 0))))


def content_text(blocks: Column) -> Column:
    """A model's content blocks as one text."""
    return F.array_join(F.transform(blocks, lambda b: F.coalesce(b["text"], F.lit(""))), "")

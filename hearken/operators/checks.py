"""Declared checks. A check has a name, a severity and a condition that is never null: FATAL refuses a record, ADVISORY
only lowers its score, and both mean the same in every stage."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FATAL, ADVISORY = "FATAL", "ADVISORY"


@dataclass(frozen=True)
class Check:
    name: str
    severity: str
    passes: Column

    @property
    def holds(self) -> Column:
        return F.coalesce(self.passes, F.lit(False))


def failed(checks: Sequence[Check], severity: str) -> Column:
    """Names of the failed checks of a severity, in their order."""
    return F.array_compact(F.array(*(F.when(~c.holds, F.lit(c.name)) for c in checks if c.severity == severity)))


def issues(checks: Sequence[Check]) -> Column:
    """struct(check, severity) of each failed check, in their order."""
    return F.array_compact(F.array(*(F.when(~c.holds, F.struct(F.lit(c.name).alias("check"), F.lit(c.severity).alias("severity"))) for c in checks)))


def outcomes(checks: Sequence[Check]) -> Column:
    """map of name to outcome."""
    return F.create_map(*(x for c in checks for x in (F.lit(c.name), c.holds)))


def score(checks: Sequence[Check]) -> Column:
    """The share of checks passed."""
    total = F.lit(0)
    for c in checks:
        total = total + c.holds.cast("int")
    return total / F.lit(float(len(checks)))


def admissible(checks: Sequence[Check]) -> Column:
    """No FATAL check failed."""
    return reduce(Column.__and__, (c.holds for c in checks if c.severity == FATAL), F.lit(True))


def gate(df: DataFrame, column: str = "admissible") -> DataFrame:
    """Fails closed: a missing verdict is a refusal."""
    return df.where(F.coalesce(F.col(column), F.lit(False)))


# --- reviews

REVIEW_FIELDS = ("review_text", "product_id", "customer_id", "rating", "review_date")
REVIEW_FATAL = ("has_review_text", "has_product_id", "min_length", "rating_in_range")


def review_checks(value=lambda name: F.col(name), whole_rating: Column | None = None, text_is_string: Column | None = None) -> list[Check]:
    """The eight checks of a review. `value(name)` is a field as text; `whole_rating` says that the rating is an integer
    (or true, which counts as 1) by its JSON type, and is left out where the column is one already."""
    text, stars = value("review_text"), value("rating")
    number = stars.try_cast("int") if whole_rating is None else F.when(whole_rating, F.when(stars == "true", 1).otherwise(stars.try_cast("int")))
    number = number if whole_rating is None else F.when(stars == "false", 0).otherwise(number)
    conditions = {f"has_{f}": value(f).isNotNull() & (value(f).cast("string") != "") for f in REVIEW_FIELDS}
    long = F.length(text) >= 10
    conditions["min_length"] = long if text_is_string is None else long & text_is_string
    conditions["rating_in_range"] = number.between(1, 5)
    conditions["valid_date_format"] = value("review_date").rlike(r"^\d{4}-\d{2}-\d{2}$")
    return [Check(name, FATAL if name in REVIEW_FATAL else ADVISORY, c) for name, c in conditions.items()]


def validate_reviews(raw: DataFrame, **kinds) -> DataFrame:
    """`raw` with checks, quality_score, fatal_failures, advisory_failures, admissible."""
    checks = review_checks(**kinds)
    return raw.withColumns({"checks": outcomes(checks), "quality_score": score(checks), "fatal_failures": failed(checks, FATAL), "advisory_failures": failed(checks, ADVISORY), "admissible": admissible(checks)})


def validate_variant_reviews(raw: DataFrame, column: str = "review") -> DataFrame:
    """Reviews as JSON variants, with the types that JSON gave them."""
    field = lambda name: F.try_variant_get(F.col(column), f"$.{name}", "string")
    kind = lambda name: F.schema_of_variant(F.variant_get(F.col(column), f"$.{name}", "variant"))
    return validate_reviews(raw, value=field, whole_rating=kind("rating").isin("BIGINT", "BOOLEAN"), text_is_string=kind("review_text") == "STRING")


def admitted_reviews(verdicts: DataFrame, raw: DataFrame, on: str = "file_name") -> DataFrame:
    """Raw reviews whose verdict admits them and that have a text. A review without a verdict is not admitted."""
    return gate(verdicts.select(on, "admissible")).drop("admissible").join(raw, on).where("review_text <> ''")

"""Dataset rules in DQDL: what of them holds, as one aggregate, and the rows that fail them."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_RULE = re.compile(r'\s*(IsComplete|ColumnLength|ColumnValues|IsUnique)\s+"([^"]+)"\s*(.*?)\s*$', re.S)
_COMPARE = re.compile(r"(>=|<=|!=|>|<|=)\s*(-?\d+(?:\.\d+)?)$")


@dataclass(frozen=True)
class Rule:
    text: str
    kind: str
    column: str
    rest: str

    def holds(self) -> Column:
        """Whether the rule holds for a row, of a rule that looks at rows one by one. A null meets no condition, and
        IsComplete tells of it alone."""
        c = F.col(self.column)
        if self.kind == "IsComplete":
            own = c.isNotNull()
        elif self.rest.lower().startswith("in"):
            values = [v.strip().strip('"') for v in re.findall(r'"[^"]*"|[^,\[\]]+', self.rest[2:].strip().strip("[]"))]
            own = c.cast("string").isin([v for v in values if v])
        else:
            sign, number = _COMPARE.match(self.rest).groups()
            left = F.length(c) if self.kind == "ColumnLength" else c.try_cast("double")
            right = F.lit(float(number))
            own = {">": left > right, "<": left < right, ">=": left >= right, "<=": left <= right, "=": left == right, "!=": left != right}[sign]
        return F.coalesce(own, F.lit(False))

    @property
    def by_row(self) -> bool:
        return self.kind != "IsUnique"


def parse_rules(text: str) -> list[Rule]:
    """The rules of `Rules = [ ... ]`; an unknown rule raises ValueError."""
    body = re.sub(r"#[^\n]*", "", text).strip()
    if m := re.match(r"Rules\s*=\s*\[(.*)\]\s*$", body, re.S):
        body = m[1]
    parts, depth, quoted, now = [], 0, False, ""
    for ch in body:
        quoted ^= ch == '"'
        depth += 0 if quoted else (ch == "[") - (ch == "]")
        if ch == "," and not depth and not quoted:
            parts.append(now)
            now = ""
        else:
            now += ch
    rules = []
    for part in filter(None, map(str.strip, [*parts, now])):
        m = _RULE.match(part)
        if not m or (m[1] in ("ColumnLength", "ColumnValues") and not (m[3].lower().startswith("in") or _COMPARE.match(m[3]))):
            raise ValueError(f"unknown rule: {part}")
        rules.append(Rule(" ".join(part.split()), *m.groups()))
    return rules


def _repeated(df: DataFrame, column: str) -> DataFrame:
    """value: what stands in more than one row; nulls repeat nothing. Rows are counted where they are read, by value."""
    own = df.select(F.col(column).alias("value")).where("value is not null")
    return own.groupBy("value").agg(F.count("*").alias("n")).where("n > 1").select("value")


def evaluate_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """rule_no, rule, passed: rules on rows over one scan, and a count by value for each unique column, of that column alone."""
    every = [F.coalesce(F.bool_and(r.holds()), F.lit(True)).alias(f"r{i}") for i, r in enumerate(rules) if r.by_row]
    one = df.agg(*every) if every else df.sparkSession.range(1).select()
    for column in dict.fromkeys(r.column for r in rules if not r.by_row):
        own = _repeated(df, column).agg((F.count("*") == 0).alias(f"unique {column}"))
        one = one.join(F.broadcast(own))  # a row
    told = [F.col(f"r{i}") if r.by_row else F.col(f"`unique {r.column}`") for i, r in enumerate(rules)]
    shown = [F.struct(F.lit(i + 1).alias("rule_no"), F.lit(r.text).alias("rule"), c.alias("passed")) for i, (r, c) in enumerate(zip(rules, told, strict=True))]
    return one.select(F.inline(F.array(*shown)))


def failing_rows(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows that fail a rule, all columns, with failed: the numbers of the rules that each fails, ascending. Of a value that
    should be unique, every row that has it fails."""
    held = df
    for column in dict.fromkeys(r.column for r in rules if not r.by_row):
        marks = _repeated(df, column).select(F.col("value").alias(f"_value {column}"), F.lit(True).alias(f"_repeats {column}"))
        held = held.join(marks, F.col(column) == F.col(f"`_value {column}`"), "left")
    failed = [F.when(~r.holds() if r.by_row else F.col(f"`_repeats {r.column}`"), F.lit(i + 1)) for i, r in enumerate(rules)]
    return held.withColumn("failed", F.array_compact(F.array(*failed))).where(F.size("failed") > 0).select(*df.columns, "failed")


def rules_score(evaluated: DataFrame) -> DataFrame:
    """rules, passed, score."""
    return evaluated.agg(F.count("*").alias("rules"), F.count_if("passed").alias("passed"), F.try_divide(F.count_if("passed"), F.count("*")).alias("score"))

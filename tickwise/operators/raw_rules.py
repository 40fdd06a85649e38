"""The rules of the raw tables, held when they are written.

Validation (A12-A14) sets single records aside. The rules here are those of
the tables themselves: required columns, lengths of texts and the range of
NUMERIC(18,6). As in a database, one row that breaks one refuses the whole
load: the counts are gathered by the write of the load's own intermediate copy
(``Observation``, no second pass), and nothing is published unless all are 0.
Keys are unique by the merge. A stream can't stop for one record, so there
such rows go to the quarantine by themselves (``split``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tickwise.operators.validate import PRICE_COLS


@dataclass(frozen=True)
class Rule:
    column: str
    kind: str                 # required | length | numeric
    bound: int = 0            # most characters; digits before the point

    @property
    def name(self) -> str:
        return {"required": f"{self.column} is required",
                "length": f"{self.column} takes at most {self.bound} characters",
                "numeric": f"{self.column} takes at most {self.bound} digits before the point"}[self.kind]

    def broken(self) -> Column:
        """True where a row breaks the rule; never NULL. Only required columns
        refuse a NULL. A number is rounded to 6 places before it is measured,
        as storing it would; NaN passes, an infinite one does not."""
        c = F.col(self.column)
        if self.kind == "required":
            return c.isNull()
        if self.kind == "length":
            return F.coalesce(F.char_length(c) > self.bound, F.lit(False))
        x = F.abs(c.cast("double"))
        return F.coalesce(~F.isnan(x) & (F.round(x, 6) >= F.lit(10.0 ** self.bound)), F.lit(False))


def _rules(required: list[str], lengths: dict[str, int], numeric: list[str]) -> list[Rule]:
    return ([Rule(c, "required") for c in required] + [Rule(c, "length", n) for c, n in lengths.items()]
            + [Rule(c, "numeric", 12) for c in numeric])


# Required columns, lengths and NUMERIC(18,6) columns of the raw tables.
RAW_RULES: dict[str, list[Rule]] = {
    "bars": _rules(["symbol", "trade_date"], {"symbol": 20, "source": 50}, list(PRICE_COLS)),
    "macro": _rules(["obs_date", "series", "value"], {"series": 50, "unit": 20, "source": 50}, ["value"]),
    "assets": _rules(["symbol"], {"symbol": 20, "name": 200, "sector": 100, "subsector": 100, "kind": 30,
                                  "country": 50, "currency": 10}, []),
}


class RawRuleError(ValueError):
    """A load was refused; ``counts`` holds the rows that break each rule."""

    def __init__(self, entity: str, counts: dict[str, int]):
        self.entity, self.counts = entity, counts
        super().__init__(f"{entity} not loaded: " + "; ".join(f"{r} ({n} rows)" for r, n in counts.items()))


def rules_of(df: DataFrame, entity: str) -> list[Rule]:
    return [r for r in RAW_RULES[entity] if r.column in df.columns]


def observed(df: DataFrame, entity: str) -> tuple[DataFrame, Callable[[], None]]:
    """``df`` whose next write counts the rows that break a rule, and the check
    to call after that write: it raises unless every count is 0. A task that
    runs twice may count a row twice, but never turns a count into 0."""
    rules = rules_of(df, entity)
    seen = Observation(f"{entity}_raw_rules")
    out = df.observe(seen, F.count(F.lit(1)).alias("rows"),
                     *[F.count_if(r.broken()).alias(f"r{i}") for i, r in enumerate(rules)])

    def check() -> None:
        got = seen.get
        counts = {r.name: got.get(f"r{i}", 0) for i, r in enumerate(rules)}
        counts = {name: n for name, n in counts.items() if n}
        if counts:
            raise RawRuleError(entity, counts)
    return out, check


def broken_rules(df: DataFrame, entity: str) -> Column:
    """The names of the rules that a row breaks, an empty array if none."""
    return F.array_compact(F.array(*[F.when(r.broken(), F.lit(r.name)) for r in rules_of(df, entity)]))


def split(df: DataFrame, entity: str, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows that hold every rule, and a quarantine row for each rule that
    one of the others breaks."""
    marked = df.withColumn("_broken", broken_rules(df, entity))
    key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    aside = marked.select(F.lit(entity).alias("entity"), key.alias("record_key"), F.explode("_broken").alias("reason"))
    return marked.where(F.size("_broken") == 0).drop("_broken"), aside

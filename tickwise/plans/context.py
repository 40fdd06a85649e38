"""Lazily built model DataFrames for one input folder.

Each property composes a DataFrame plan once so that queries sharing a
model share the same plan objects. Composing runs no job, except for what
is stored on the way: the stored models, the pair vectors of the
correlation mart, the symbols of its matrix and the rows of the
global-denominator beta.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tickwise.operators import assets as A, fact as Fa, macro as Mc, pairs as P
from tickwise.functions.num import surrogate_key
from tickwise.operators import risk as R, series as S, staging as St
from tickwise.params import DEFAULT_PARAMS, Params
from tickwise.session import stored
from tickwise.sources import testdata as Td


class Models:
    def __init__(self, spark: SparkSession, sf_dir: str, params: Params = DEFAULT_PARAMS):
        self.spark, self.sf_dir, self.params = spark, sf_dir, params

    def table(self, name: str) -> DataFrame:
        return Td.table(self.spark, self.sf_dir, name)

    @cached_property
    def raw_bars(self) -> DataFrame:
        return Td.raw_bars(self.spark, self.sf_dir, self.params)

    @cached_property
    def raw_macro(self) -> DataFrame:
        return Td.raw_macro(self.spark, self.sf_dir)

    @cached_property
    def raw_assets(self) -> DataFrame:
        return Td.raw_assets(self.spark, self.sf_dir, self.params)

    @cached_property
    def stg_bars(self) -> DataFrame:
        return St.stg_bars(self.raw_bars)

    @cached_property
    def stg_macro(self) -> DataFrame:
        return St.stg_macro(self.raw_macro)

    @cached_property
    def stg_assets(self) -> DataFrame:
        return St.stg_assets(self.raw_assets)

    @cached_property
    def returns(self) -> DataFrame:
        return S.daily_returns(self.stg_bars)

    @cached_property
    def macro_wide(self) -> DataFrame:
        return Mc.macro_wide(self.stg_macro)

    @cached_property
    def fact(self) -> DataFrame:
        return Fa.price_fact(self.stg_bars, self.stg_macro, self.params)

    @cached_property
    def asset_dim(self) -> DataFrame:
        return A.asset_dim(self.stg_assets, self.fact)

    @cached_property
    def risk_mart(self) -> DataFrame:
        return R.risk_mart(self.fact, self.params)

    @cached_property
    def correlation_mart(self) -> DataFrame:
        return P.correlation_mart(self.fact, self.params)

    def stored(self) -> "Models":
        """The same models built on raw inputs, a fact and marts that are each
        materialised once in the shared checkpoint folder, for plans that
        read a model several times (as checks on published tables do)."""
        return StoredModels(self.spark, self.sf_dir, self.params)

    def test_tables(self) -> dict[str, DataFrame]:
        """Every model the declarative tests run on, raw tables with their key."""
        return {
            "raw_bars": self.raw_bars.withColumn("id", surrogate_key("symbol", "trade_date")),
            "raw_macro": self.raw_macro.withColumn("id", surrogate_key("obs_date", "series")),
            "raw_assets": self.raw_assets.withColumn("id", surrogate_key("symbol")),
            "stg_bars": self.stg_bars, "stg_macro": self.stg_macro,
            "stg_assets": self.stg_assets, "daily_returns": self.returns,
            "macro_wide": self.macro_wide, "price_fact": self.fact,
            "asset_dim": self.asset_dim, "risk_mart": self.risk_mart,
            "correlation_mart": self.correlation_mart,
        }

    def suite_tables(self) -> dict[str, DataFrame]:
        return {"suite_bars": self.raw_bars, "suite_macro": self.raw_macro}


class StoredModels(Models):
    """Models whose raw inputs, fact and marts are stored once (see ``Models.stored``)."""

    @cached_property
    def raw_bars(self) -> DataFrame:
        return stored(Td.raw_bars(self.spark, self.sf_dir, self.params), "raw_bars")

    @cached_property
    def raw_macro(self) -> DataFrame:
        return stored(Td.raw_macro(self.spark, self.sf_dir), "raw_macro")

    @cached_property
    def fact(self) -> DataFrame:
        return stored(Fa.price_fact(self.stg_bars, self.stg_macro, self.params), "price_fact")

    @cached_property
    def asset_dim(self) -> DataFrame:
        return stored(A.asset_dim(self.stg_assets, self.fact), "asset_dim")

    @cached_property
    def risk_mart(self) -> DataFrame:
        return stored(R.risk_mart(self.fact, self.params), "risk_mart")

    @cached_property
    def correlation_mart(self) -> DataFrame:
        return stored(P.correlation_mart(self.fact, self.params), "correlation_mart")

"""The fact and its marts, brought up to date from new days alone (A20 -> D12, F15, E5).

A store keeps, below one folder: the fact, a folder a year; the risk mart and
the mergeable parts of the asset dimension, a folder a year; and a state, one
row a symbol: its last bar, running sums, peak, and the last rows that its
trailing windows reach back to. State and tables are settled up to a date.
``refresh`` reads only bars after that date, computes their rows from the
state, and rewrites the years those fall in. Earlier years are neither read
nor written. Everything is written to new folders, and one manifest names
them all (``versions``): a refresh that fails changes nothing.

Rows after the settled date are computed anew by each refresh, so bars or
macro values that come late are taken up as long as they are dated after it;
``settle_days`` says how far it stays behind the last bar. A value dated
before it needs a full rebuild (a refresh into an empty folder).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickwise.operators import assets as A, fact as Fa, risk as R, segments as Sg, series as S
from tickwise.params import DEFAULT_PARAMS, Params
from tickwise.plans import versions as V
from tickwise.plans.jobs import layout
from tickwise.session import scratch, stored

STATE = """symbol string, last_date date, adj_close decimal(18,6), year int, cum_log double, ytd_log double,
  peak decimal(18,6), tail array<struct<trade_date:date,simple_return:double,has_bench:boolean,bench_return:double>>"""
BAR = ("symbol", "trade_date", "adj_close", "volume")


def _bars_with_last(bars: DataFrame, state: DataFrame) -> DataFrame:
    """The new bars and, as halo, the last settled one of each symbol."""
    last = state.select("symbol", F.col("last_date").alias("trade_date"), "adj_close",
                        F.lit(None).cast("bigint").alias("volume"), F.lit(True).alias("_halo"))
    return bars.select(*BAR, F.lit(False).alias("_halo")).unionByName(last)


def new_rows(bars: DataFrame, state: DataFrame, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """Windowed returns of the new bars, continued from the state."""
    returns = S.daily_returns(_bars_with_last(bars, state), keep=("_halo",)).where(~F.col("_halo"))
    matched = S.with_benchmark(returns, params)
    tail = state.select("symbol", F.inline("tail"), F.lit(True).alias("_halo"))
    x = Sg.local_windows(matched.unionByName(tail, allowMissingColumns=True), params).where(~F.col("_halo"))
    before = state.select("symbol", F.col("year").alias("s_year"), F.col("cum_log").alias("from_cum"),
                          F.col("ytd_log").alias("s_ytd"), F.col("peak").alias("from_peak"))
    y = x.join(before, "symbol", "left").withColumn(
        "from_ytd", F.when(F.col("s_year") == F.col("_year"), F.col("s_ytd")))
    return Sg.carried_on(y, [c for c in matched.columns if c != "_halo"])


def next_state(bars: DataFrame, rows: DataFrame, state: DataFrame, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """The state after ``rows`` (windowed returns of ``bars``). What is taken
    of a symbol's last rows is cut by row numbers, which Spark limits in each
    task before the shuffle, so no task holds a symbol's history."""
    last = _bars_with_last(bars, state).groupBy("symbol").agg(
        F.max("trade_date").alias("last_date"), F.max_by("adj_close", "trade_date").alias("adj_close"))
    old = state.select("symbol", "year", F.col("cum_log").alias("total"), F.col("ytd_log").alias("ytd"),
                       F.col("peak").alias("top"))
    new = rows.groupBy("symbol", F.year("trade_date").alias("year")).agg(
        F.sum("log_return").alias("total"), F.max("adj_close").alias("top")).withColumn("ytd", F.col("total"))
    years = old.unionByName(new).groupBy("symbol", "year").agg(
        F.sum("total").alias("total"), F.sum("ytd").alias("ytd"), F.max("top").alias("top"))
    sums = years.groupBy("symbol").agg(
        F.max("year").alias("year"), F.sum("total").alias("cum_log"), F.max_by("ytd", "year").alias("ytd_log"),
        F.max("top").alias("peak"))
    columns = ("symbol", "trade_date", "simple_return", "has_bench", "bench_return")
    held = rows.select(*columns).unionByName(state.select("symbol", F.inline("tail")))
    order = Window.partitionBy("symbol").orderBy(F.desc("trade_date"))
    cut = lambda df, n: df.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= n).drop("_n")
    reach = cut(held, params.vol_window - 1).union(cut(held.where("has_bench"), params.beta_window)).distinct()
    tail = reach.groupBy("symbol").agg(F.array_sort(F.collect_list(F.struct(*columns[1:]))).alias("tail"))
    return (last.join(sums, "symbol", "left").join(tail, "symbol", "left")
                .withColumn("tail", F.coalesce("tail", F.array()))
                .select("symbol", "last_date", "adj_close", "year", "cum_log", "ytd_log", "peak", "tail"))


class Store:
    """The tables below ``base``, as its manifest names them."""

    def __init__(self, spark: SparkSession, base: str, params: Params = DEFAULT_PARAMS):
        self.spark, self.base, self.params = spark, base.rstrip("/"), params

    @property
    def manifest(self) -> dict:
        return V.read_manifest(self.spark, self.base) or {"settled": None, "state": None, "years": {}}

    def _read(self, manifest: dict, table: str, years: set[str] | None = None) -> DataFrame | None:
        """A table's rows of ``years`` (all): only their folders are listed and read."""
        paths = [f[table] for y, f in sorted(manifest["years"].items()) if table in f and (years is None or y in years)]
        return self.spark.read.parquet(*paths) if paths else None

    def fact(self) -> DataFrame:
        return self._read(self.manifest, "fact")

    def risk_mart(self) -> DataFrame:
        return self._read(self.manifest, "risk")

    def asset_dim(self, stg_assets: DataFrame) -> DataFrame:
        return A.dim_rows(stg_assets, A.merged_parts(self._read(self.manifest, "parts")))

    def state(self, manifest: dict) -> DataFrame:
        return (self.spark.read.parquet(manifest["state"]) if manifest["state"]
                else self.spark.createDataFrame([], STATE))

    def refresh(self, bars: DataFrame, macro: DataFrame, settle_days: int = 0) -> dict:
        """Take up the bars (typed, B1) and macro values (B4) after the settled
        date; both may hold older rows, which are left out by a filter on the
        date. Returns the new manifest."""
        with scratch(self.spark):
            return self._refresh(bars, macro, settle_days)

    def _refresh(self, bars: DataFrame, macro: DataFrame, settle_days: int) -> dict:
        old = self.manifest
        state, settled = self.state(old), old["settled"]
        if settled:
            since = F.lit(dt.date.fromisoformat(settled))
            bars = bars.where(F.col("trade_date") > since)
            # the month's values count for all its days
            macro = macro.where(F.col("obs_date") >= F.trunc(since, "month"))
        bars = stored(bars.select(*BAR), "refresh_bars")
        last = bars.agg(F.max("trade_date")).first()[0]
        if last is None:
            return old
        rows = stored(new_rows(bars, state, self.params), "refresh_rows")
        until = max(last - dt.timedelta(days=settle_days), dt.date.fromisoformat(settled) if settled else dt.date.min)
        new_state = V.new_folder(self.base, "state")
        within = F.col("trade_date") <= F.lit(until)
        next_state(bars.where(within), rows.where(within), state, self.params).write.parquet(new_state)

        # the years of the new rows, and those that hold rows not settled before
        years = {str(r[0]) for r in rows.select(F.year("trade_date")).distinct().collect()}
        years |= {y for y in old["years"] if settled and y >= settled[:4]}
        fact = Fa.fact_rows(rows, macro)
        kept = self._read(old, "fact", years)
        if kept is not None:
            fact = kept.where(F.col("trade_date") <= since).select(*Fa.FACT_COLUMNS).unionByName(fact)
        folders = {t: V.new_folder(self.base, t) for t in ("fact", "risk", "parts")}
        layout(fact).write.partitionBy("year").parquet(folders["fact"])
        fact = self.spark.read.parquet(folders["fact"]).drop("year")
        A.year_parts(fact).withColumn("_y", F.col("year")).write.partitionBy("_y").parquet(folders["parts"])
        every = {y: dict(f) for y, f in old["years"].items() if y not in years}
        for y in {str(r[0]) for r in fact.select(F.year("trade_date")).distinct().collect()}:
            every[y] = {"fact": f"{folders['fact']}/year={y}", "parts": f"{folders['parts']}/_y={y}"}
        parts = self._read({"years": every}, "parts")
        self._risk(fact, parts).withColumn("_y", F.col("year")).write.partitionBy("_y").parquet(folders["risk"])
        risky = {str(r[0]) for r in self.spark.read.parquet(folders["risk"]).select("year").distinct().collect()}
        for y in years & set(every):
            if y in risky:
                every[y]["risk"] = f"{folders['risk']}/_y={y}"
        manifest = {"settled": until.isoformat(), "state": new_state, "years": every}
        V.write_manifest(self.spark, self.base, manifest)
        return manifest

    def _risk(self, fact: DataFrame, parts: DataFrame) -> DataFrame:
        """F15 of the years in ``fact``; the peak that a year starts from is
        the largest price of the years before, from the parts."""
        before = Window.partitionBy("symbol").orderBy("year").rowsBetween(Window.unboundedPreceding, -1)
        peaks = parts.select(F.col("symbol").alias("p_symbol"), F.col("year").alias("p_year"),
                             F.max("max_price").over(before).alias("from_peak"))
        x = fact.where(F.col("symbol") != self.params.benchmark).join(
            peaks, (F.col("symbol") == F.col("p_symbol")) & (F.year("trade_date") == F.col("p_year")), "left")
        own = F.max("adj_close").over(S.running())
        x = x.withColumn("running_peak", F.greatest("from_peak", own)).withColumn("drawdown", S.drawdown_col())
        aggs = R.annual_aggs(self.params)
        return R.mart_rows(x.groupBy("symbol", F.year("trade_date").alias("year")).agg(*[c.alias(n) for n, c in aggs.items()]))

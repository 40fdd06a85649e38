"""Per-symbol windows over a series without a bound.

``series`` puts a symbol's whole history into one window task. That is right
for daily bars; minute bars, or one symbol with a third of all rows, need
another form. Here a history is cut into segments of about ``segment_rows``
rows, and each segment's task also gets, as halo, the earlier rows that its
trailing windows reach back to:

1. rows are counted by (symbol, calendar bucket), with map-side combine;
2. from the counts alone each bucket learns its segment and the later
   segments that need it, as many of them as it takes to reach back the
   asked number of rows, however thin the buckets between are;
3. one exchange on (symbol, segment) brings each segment and its halo into
   one task, where trailing windows and local running values are exact;
4. running sums and peaks are totalled by segment, a scan over that small
   table gives what each segment starts from, and it is added to its rows.

So no task holds more than a segment, its halo and one bucket beside each.
Sums are taken in another order than over the whole series: equal up to the
last bits of a double, before the rounding that every output gets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwise.functions.num import rnd
from tickwise.operators import series as S
from tickwise.params import DEFAULT_PARAMS, Params
from tickwise.session import stored

#: Most rows of a bucket or segment table that are sent to every executor
#: (some hundred bytes each); a larger one is joined by a shuffle.
BROADCAST_ROWS = 200_000

SERIES_COLUMNS = ["symbol", "trade_date", "ann_vol", "mean_return_window", "cum_return", "ytd_return",
                  "beta", "running_peak", "drawdown"]


def _small(df: DataFrame, name: str) -> DataFrame:
    """A table that doesn't grow with the rows, stored; broadcast if its count allows."""
    df = stored(df, name)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _bucket(params: Params) -> Column:
    return F.floor(F.unix_date(F.to_date("trade_date")) / params.segment_days)


def segment_plan(df: DataFrame, reach: dict[str, tuple[Column, int]], params: Params = DEFAULT_PARAMS) -> DataFrame:
    """(sym, bucket, targets): the segments, with ``_halo``, that each bucket's
    rows go to. ``reach`` names what trailing windows count: a condition on
    rows, and how many rows of it before its own a row needs."""
    counts = stored(
        df.groupBy(F.col("symbol").alias("sym"), _bucket(params).alias("bucket"))
          .agg(F.count(F.lit(1)).alias("n"), *[F.count(F.when(c, 1)).alias(f"n_{k}") for k, (c, _) in reach.items()]),
        "segment_counts")
    upto = Window.partitionBy("sym").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = counts.select("sym", "bucket", F.floor((F.sum("n").over(upto) - F.col("n")) / params.segment_rows).alias("seg"),
                        *[F.sum(f"n_{k}").over(upto).alias(f"to_{k}") for k in reach],
                        *[(F.sum(f"n_{k}").over(upto) - F.col(f"n_{k}")).alias(f"before_{k}") for k in reach])
    starts = (cum.groupBy("sym", "seg").agg(*[F.min(f"before_{k}").alias(f"before_{k}") for k in reach])
                 .groupBy(F.col("sym").alias("s")).agg(F.collect_list(F.struct("seg", *[f"before_{k}" for k in reach])).alias("segs")))

    def needs(s: Column) -> Column:
        short = F.lit(False)
        for k, (_, rows) in reach.items():
            short = short | (s[f"before_{k}"] - F.col(f"to_{k}") < rows)
        return (s["seg"] > F.col("seg")) & short

    own = F.array(F.struct(F.col("seg").alias("_seg"), F.lit(False).alias("_halo")))
    halo = F.transform(F.filter("segs", needs), lambda s: F.struct(s["seg"].alias("_seg"), F.lit(True).alias("_halo")))
    return (cum.join(starts, F.col("sym").eqNullSafe(F.col("s")))
               .select("sym", "bucket", F.concat(own, halo).alias("targets")))


def in_segments(df: DataFrame, reach: dict[str, tuple[Column, int]], params: Params = DEFAULT_PARAMS) -> DataFrame:
    """The rows of ``df`` with ``_seg``, and again as ``_halo`` rows of the
    segments whose first rows look back to them."""
    plan = _small(segment_plan(df, reach, params), "segment_plan")
    on = F.col("symbol").eqNullSafe(F.col("sym")) & (_bucket(params) == F.col("bucket"))
    return df.join(plan, on).select(*df.columns, F.inline("targets"))


def segmented_returns(stg: DataFrame, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """C1-C5 without a task that holds a whole symbol: each segment also gets
    the bar before its first."""
    x = in_segments(stg.select("symbol", "trade_date", "adj_close", "volume"), {"bar": (F.lit(True), 1)}, params)
    return S.daily_returns(x, "_seg", keep=("_halo", "_seg")).where(~F.col("_halo")).drop("_halo", "_seg")


def _carried(local: DataFrame, name: str, value: str, fold, within: tuple[str, ...] = ()) -> DataFrame:
    """(sym, seg[, within], ``name``): ``fold`` of ``value`` over the segments
    of the symbol before each, from one row a segment."""
    w = (Window.partitionBy("sym", *within).orderBy("seg")
               .rowsBetween(Window.unboundedPreceding, -1))
    return (local.groupBy("sym", "seg", *within).agg(fold(value).alias("v"))
                 .select("sym", "seg", *within, fold("v").over(w).alias(name)))


def _plus(carry: str, own: str) -> Column:
    """Sum of the two, NULL only where both are."""
    return F.coalesce(F.col(carry) + F.col(own), F.col(carry), F.col(own))


def local_windows(x: DataFrame, params: Params, *part: str) -> DataFrame:
    """The windows of rows that come with ``_halo`` rows before them: trailing
    ones are final, ``_cum``, ``_ytd`` and ``_peak`` run from the first row
    that is no halo."""
    own = F.when(~F.col("_halo"), F.col("log_return"))
    return S.with_rolling_beta(x.select(
        "*", F.year("trade_date").alias("_year"),
        S.rolling_volatility_col(params, *part).alias("ann_vol"),
        S.rolling_mean_col(params, *part).alias("mean_return_window"),
        F.sum(own).over(S.running(*part)).alias("_cum"),
        F.sum(own).over(S.running(*part, F.year("trade_date"))).alias("_ytd"),
        F.max(F.when(~F.col("_halo"), F.col("adj_close"))).over(S.running(*part)).alias("_peak")), params, part=part)


def carried_on(y: DataFrame, columns: list[str]) -> DataFrame:
    """``local_windows`` rows with what came before them (``from_cum``,
    ``from_ytd``, ``from_peak``) added: ``columns``, then the windows."""
    return y.select(
        *columns, "ann_vol", "mean_return_window", "beta",
        rnd(F.exp(_plus("from_cum", "_cum")) - 1, 6).alias("cum_return"),
        rnd(F.exp(_plus("from_ytd", "_ytd")) - 1, 6).alias("ytd_return"),
        F.greatest("from_peak", "_peak").alias("running_peak"))


def segmented_windows(stg: DataFrame, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """The returns of every bar after each symbol's first with benchmark
    columns, ``ann_vol``, ``mean_return_window``, ``cum_return``,
    ``ytd_return``, ``beta`` and ``running_peak``, as the windows over whole
    histories give them.

    The returns are stored once, as the benchmark, the counts and the windows
    read them; the windowed rows are stored once, as the totals by segment and
    the result do. Both are read back without an exchange."""
    returns = stored(segmented_returns(stg, params), "segment_returns")
    bench = S.benchmark_series(returns, params).withColumn("has", F.lit(True))
    matched = returns.join(bench, "trade_date", "left").withColumn("has_bench", F.coalesce("has", F.lit(False))).drop("has")
    reach = {"bar": (F.lit(True), params.vol_window - 1), "bench": (F.col("has_bench"), params.beta_window)}
    x = local_windows(in_segments(matched, reach, params), params, "_seg")
    x = stored(x.where(~F.col("_halo")).drop("_halo"), "segment_rows")
    keys = x.select(F.col("symbol").alias("sym"), F.col("_seg").alias("seg"), F.col("_year").alias("year"),
                    "log_return", "adj_close")
    totals = stored(keys.groupBy("sym", "seg", "year").agg(F.sum("log_return").alias("total"),
                                                           F.max("adj_close").alias("peak")), "segment_totals")
    same = lambda a, b, *cols: [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in cols]
    t = (totals.alias("t")
         .join(_carried(totals, "from_cum", "total", F.sum).alias("c"), same("t", "c", "sym", "seg"))
         .join(_carried(totals, "from_peak", "peak", F.max).alias("p"), same("t", "p", "sym", "seg"))
         .join(_carried(totals, "from_ytd", "total", F.sum, ("year",)).alias("y"), same("t", "y", "sym", "seg", "year"))
         .select("t.sym", "t.seg", "t.year", "from_cum", "from_peak", "from_ytd"))
    on = [F.col("symbol").eqNullSafe(F.col("sym")), F.col("_seg") == F.col("seg"), F.col("_year") == F.col("year")]
    return carried_on(x.join(_small(t, "segment_starts"), on), matched.columns)


def segmented_series(stg: DataFrame, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """The columns of SERIES_COLUMNS."""
    x = segmented_windows(stg, params).withColumn("drawdown", S.drawdown_col())
    return x.withColumn("running_peak", F.col("running_peak").cast("double")).select(*SERIES_COLUMNS)

"""Per-symbol time-series operators.

All per-symbol windows share one ``partitionBy(symbol)`` so a single
Exchange on the symbol feeds every window in a plan; the (symbol, year)
and (symbol, has_bench) windows reuse that partitioning with only a local
re-sort. A symbol's series is one row per trading day, so a window task
holds at most the calendar length of one symbol, however large the table.
Where a symbol's series has no such bound (minute bars), ``segments`` cuts it:
``part`` names the further columns that the windows are then partitioned by.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwise.functions.num import rnd, safe_div
from tickwise.params import DEFAULT_PARAMS, Params
from tickwise.session import stored


def by_symbol(*extra):
    return Window.partitionBy("symbol", *extra).orderBy("trade_date")


def running(*extra):
    return by_symbol(*extra).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def trailing(n: int, *extra):
    return by_symbol(*extra).rowsBetween(-(n - 1), Window.currentRow)


def with_lag(stg: DataFrame, *part: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Previous adjusted close and calendar days since the previous bar."""
    w = by_symbol(*part)
    return stg.select(
        "symbol", "trade_date", "adj_close", "volume", *keep,
        F.lag("adj_close").over(w).alias("prev_adj_close"),
        F.datediff("trade_date", F.lag("trade_date").over(w)).alias("days_since_prev"))


def daily_returns(stg: DataFrame, *part: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Simple and log return (8 places, NULL unless prev > 0); each
    symbol's first bar is dropped."""
    lagged = with_lag(stg, *part, keep=keep)
    prev = F.col("prev_adj_close")
    ok = prev > 0
    a, p = F.col("adj_close").cast("double"), prev.cast("double")
    return (lagged.where(prev.isNotNull())
                  .select("symbol", "trade_date", "adj_close", "prev_adj_close", "volume",
                          "days_since_prev", *keep,
                          F.when(ok, rnd((a - p) / p, 8)).alias("simple_return"),
                          F.when(ok, rnd(F.ln(a / p), 8)).alias("log_return")))


def rolling_volatility_col(params: Params = DEFAULT_PARAMS, *part: str):
    """Sample stddev of the simple return over the trailing window, annualised."""
    return rnd(F.stddev_samp("simple_return").over(trailing(params.vol_window, *part))
               * F.sqrt(F.lit(float(params.annualisation))), 6)


def rolling_mean_col(params: Params = DEFAULT_PARAMS, *part: str):
    """D3: mean simple return over the trailing volatility window."""
    return rnd(F.avg("simple_return").over(trailing(params.vol_window, *part)), 8)


def cumulative_return_col():
    """exp(running sum of log returns) - 1."""
    return rnd(F.exp(F.sum("log_return").over(running())) - 1, 6)


def ytd_return_col():
    """Compounded return since the first bar of the calendar year."""
    return rnd(F.exp(F.sum("log_return").over(running(F.year("trade_date")))) - 1, 6)


def with_benchmark(returns: DataFrame, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """D1 attached to every row: bench_return, bench_level and has_bench
    (the benchmark has a bar that day).

    A window over the date instead of a join to a filtered copy of the
    returns: the copy would be a second branch of the plan, re-reading the
    raw input, because Catalyst pushes the benchmark filter below the
    shared aggregate. A date holds at most one row per symbol.
    """
    wd = Window.partitionBy("trade_date")
    is_b = F.col("symbol") == params.benchmark
    return returns.select(
        "*",
        F.max(F.when(is_b, F.col("simple_return"))).over(wd).alias("bench_return"),
        F.max(F.when(is_b, F.col("adj_close").cast("double"))).over(wd).alias("bench_level"),
        F.coalesce(F.max(is_b).over(wd), F.lit(False)).alias("has_bench"))


def benchmark_series(returns: DataFrame, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """The benchmark's own return and level by date."""
    return (returns.where(F.col("symbol") == params.benchmark)
                   .select("trade_date", F.col("simple_return").alias("bench_return"),
                           F.col("adj_close").cast("double").alias("bench_level")))


def trailing_moments(x: str, y: str, n: int, matched: str | None = None,
                     part: tuple[str, ...] = ()) -> tuple[dict, object]:
    """Population co-moments of (x, y) over the trailing ``n`` rows of each
    symbol in O(rows): running sums minus the same sums ``n`` rows back
    (``lag``), instead of re-aggregating a sliding frame per row
    (O(rows x n)). Values are centred on their partition mean first so the
    differences do not cancel. Returns the running-sum columns and the
    ordered window they use.

    With ``matched`` (a boolean column), only rows where it is true count:
    the window stays partitioned by symbol alone (so it shares the symbol
    partitioning of every other per-symbol window) and is ordered by
    (matched, date). Unmatched rows sort first and add 0 to every sum, so
    for a matched row the running sums and the lag by ``n`` rows see only
    matched rows."""
    whole = Window.partitionBy("symbol", *part)
    order = ([matched] if matched else []) + ["trade_date"]
    ordered = whole.orderBy(*order)
    run = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    has_y = F.col(y).isNotNull()
    if matched:
        both = both & F.col(matched)
        has_y = has_y & F.col(matched)
    cx = F.col(x) - F.avg(F.when(both, F.col(x))).over(whole)
    cy = F.col(y) - F.avg(F.when(both, F.col(y))).over(whole)
    cb = F.col(y) - F.avg(F.when(has_y, F.col(y))).over(whole)
    parts = {
        "n": F.when(both, 1).otherwise(0),
        "sx": F.when(both, cx).otherwise(0.0),
        "sy": F.when(both, cy).otherwise(0.0),
        "sxy": F.when(both, cx * cy).otherwise(0.0),
        "nb": F.when(has_y, 1).otherwise(0),
        "sb": F.when(has_y, cb).otherwise(0.0),
        "sbb": F.when(has_y, cb * cb).otherwise(0.0),
    }
    return {k: F.sum(v).over(run) for k, v in parts.items()}, ordered


def _frame_sum(cum_name: str, ordered, n: int):
    c = F.col(cum_name)
    return c - F.coalesce(F.lag(c, n).over(ordered), F.lit(0) if cum_name.endswith("n") else F.lit(0.0))


def with_rolling_beta(df: DataFrame, params: Params = DEFAULT_PARAMS, out: str = "beta",
                      part: tuple[str, ...] = ()) -> DataFrame:
    """covar_pop(r, bench) / var_pop(bench) over the trailing
    ``beta_window`` rows that have a benchmark bar (Q2: unmatched days are
    not counted), per symbol; NULL for the benchmark itself and for rows
    without a benchmark bar. Needs the ``with_benchmark`` columns.

    Computed from running sums (see ``trailing_moments``). A frame over which
    the benchmark return doesn't change has variance exactly 0 in the window
    form and is NULL here by rule, not by a floating residue: ``_c_turn`` is
    the number of the last benchmark value that differs from the one before
    it, and the frame is flat if that isn't after its first value."""
    w = params.beta_window
    mom, ordered = trailing_moments("simple_return", "bench_return", w, "has_bench", part)
    run = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    value = F.when(F.col("has_bench"), F.col("bench_return"))
    before = F.last(value, ignorenulls=True).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    x = df.select("*", *[c.alias(f"_c_{k}") for k, c in mom.items()],
                  (value.isNotNull() & ~value.eqNullSafe(before)).alias("_c_turns"))
    x = x.withColumn("_c_turn", F.max(F.when(F.col("_c_turns"), F.col("_c_nb"))).over(run))
    fs = {k: _frame_sum(f"_c_{k}", ordered, w) for k in mom}
    x = x.select("*", *[v.alias(f"_f_{k}") for k, v in fs.items()])
    n, sx, sy, sxy = (F.col(f"_f_{k}") for k in ("n", "sx", "sy", "sxy"))
    nb, sb, sbb = (F.col(f"_f_{k}") for k in ("nb", "sb", "sbb"))
    nd, nbd = n.cast("double"), nb.cast("double")
    cov = F.when(n > 0, (sxy - sx * sy / nd) / nd)
    flat = F.col("_c_turn") <= F.col("_c_nb") - nb + 1
    var = F.when(flat, F.lit(0.0)).when(nb > 1, (sbb - sb * sb / nbd) / nbd)
    beta = F.when(F.col("has_bench") & (F.col("symbol") != params.benchmark),
                  rnd(safe_div(cov, var), 4))
    return x.withColumn(out, beta).drop(*[c for c in x.columns if c.startswith(("_c_", "_f_"))])


def running_peak_col():
    """running maximum of the adjusted close."""
    return F.max("adj_close").over(running())


def drawdown_col(peak="running_peak"):
    """(price - peak) / peak in double, from an already computed peak
    column (the model repeats the window three times; one is enough)."""
    a, p = F.col("adj_close").cast("double"), F.col(peak).cast("double")
    return rnd(safe_div(a - p, p), 6)


def rolling_beta_global_denominator(returns: DataFrame, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """Beta with the denominator exactly as the model writes it: var_pop of
    the benchmark return over the trailing ``beta_window`` rows of *all*
    matched rows ordered by (date, symbol), not per symbol (Q1; the symbol
    tie-break makes it deterministic). The numerator stays per symbol.

    A window without partition would move every row into one task. Instead:
    rows are numbered globally as k = rows on earlier dates + rank within
    the date; sums of 1, b and b^2 up to any k come from date-level prefix
    sums (one row per date, so the only unpartitioned window is over the
    calendar) plus the within-date offset; the frame sum is P(k) - P(k-w),
    with P(k-w) fetched by an equi-join on the position. Over a frame of one
    constant b the window gives exactly 0 and hence NULL; the difference form
    would leave a residue, so a frame in which b hasn't changed since its
    first value is set NULL.
    """
    w = params.beta_window
    m = (with_benchmark(returns, params)
         .where(F.col("has_bench") & (F.col("symbol") != params.benchmark))
         .select("symbol", "trade_date", "simple_return", "bench_return"))
    mom, ordered = trailing_moments("simple_return", "bench_return", w)
    m = m.select("*", *[mom[k].alias(f"_c_{k}") for k in ("n", "sx", "sy", "sxy")])
    fs = {k: _frame_sum(f"_c_{k}", ordered, w) for k in ("n", "sx", "sy", "sxy")}
    n = fs["n"].cast("double")
    cov = F.when(fs["n"] > 0, (fs["sxy"] - fs["sx"] * fs["sy"] / n) / n)
    # x feeds the date table, the row positions and the position self-join:
    # store it once so the raw input is not re-read for each reference.
    x = stored(m.select("symbol", "trade_date", "simple_return", "bench_return", cov.alias("cov")),
               "beta_rows")
    b = F.col("bench_return")
    ind = F.when(b.isNotNull(), 1).otherwise(0)
    day = x.groupBy("trade_date").agg(F.count(F.lit(1)).alias("c"), F.max(b).alias("b"))
    wd = Window.orderBy("trade_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    c, bb = F.col("c"), F.col("b")
    vi = F.when(bb.isNotNull(), 1).otherwise(0)
    b0 = F.coalesce(bb, F.lit(0.0))
    day = day.select(
        "trade_date", "c", "b",
        (F.sum(c).over(wd) - c).alias("c_prev"),
        (F.sum(c * vi).over(wd) - c * vi).alias("n_prev"),
        (F.sum(c * b0).over(wd) - c * b0).alias("s1_prev"),
        (F.sum(c * b0 * b0).over(wd) - c * b0 * b0).alias("s2_prev"),
        (bb.isNotNull() & ~bb.eqNullSafe(F.last("b", ignorenulls=True).over(
            Window.orderBy("trade_date").rowsBetween(Window.unboundedPreceding, -1)))).alias("turns"))
    # the valid rows before the last date at which b changed
    day = day.withColumn("turn", F.max(F.when(F.col("turns"), F.col("n_prev"))).over(wd)).drop("turns")
    j = F.row_number().over(Window.partitionBy("trade_date").orderBy("symbol"))
    rows = x.join(day.drop("b"), "trade_date").withColumn("j", j)
    ji = F.col("j")
    rows = rows.select(
        "symbol", "trade_date", "cov", "turn",
        (F.col("c_prev") + ji).alias("k"),
        (F.col("n_prev") + ji * ind).alias("pn"),
        (F.col("s1_prev") + ji * F.coalesce(b, F.lit(0.0))).alias("p1"),
        (F.col("s2_prev") + ji * F.coalesce(b, F.lit(0.0)) * F.coalesce(b, F.lit(0.0))).alias("p2"))
    back = rows.select((F.col("k") + w).alias("k"), F.col("pn").alias("qn"),
                       F.col("p1").alias("q1"), F.col("p2").alias("q2"))
    y = rows.join(back, "k", "left")
    n = (F.col("pn") - F.coalesce(F.col("qn"), F.lit(0))).cast("double")
    s1 = F.col("p1") - F.coalesce(F.col("q1"), F.lit(0.0))
    s2 = F.col("p2") - F.coalesce(F.col("q2"), F.lit(0.0))
    var = F.when(n > 0, s2 / n - (s1 / n) * (s1 / n))
    flat = F.col("turn") <= F.coalesce(F.col("qn"), F.lit(0))
    beta = F.when(~flat, rnd(safe_div(F.col("cov"), var), 4))
    return y.select("symbol", "trade_date", beta.alias("beta"))

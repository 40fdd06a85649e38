"""Windows over segments of a history against windows over the whole of it."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tickwise.operators import fact as Fa, segments as Sg, series as S
from tickwise.params import DEFAULT_PARAMS
from tickwise.plans.context import Models
from tickwise.session import stored

PARAMS = DEFAULT_PARAMS.with_(segment_rows=400, segment_days=1, vol_window=21, beta_window=252)


def minute_bars(spark, rows):
    """A symbol with most of the rows, the benchmark with holes, a thin symbol
    (a bar every few days) and one of a single bar."""
    rng = random.Random(3)
    t0 = dt.datetime(2020, 12, 20)
    out = []
    for symbol, step, n, hole in (("HOT", 7, rows, 0.0), ("^BVSP", 7, rows, 0.3), ("THIN", 60 * 24 * 3, 500, 0.0),
                                  ("ONE", 1, 1, 0.0)):
        price = 100.0
        for i in range(n):
            price = max(1.0, price * (1 + rng.choice([0, 0, 0.01, -0.01, 0.002])))
            if rng.random() >= hole:
                out.append((symbol, t0 + dt.timedelta(minutes=step * i), round(price, 4), i))
    rng.shuffle(out)
    return spark.createDataFrame(out, "symbol string, trade_date timestamp, adj_close double, volume bigint").select(
        "symbol", "trade_date", F.col("adj_close").cast("decimal(18,6)").alias("adj_close"), "volume")


def whole(bars, params):
    x = S.with_rolling_beta(S.with_benchmark(S.daily_returns(bars), params).select(
        "*", S.rolling_volatility_col(params).alias("ann_vol"),
        S.rolling_mean_col(params).alias("mean_return_window"), S.cumulative_return_col().alias("cum_return"),
        S.ytd_return_col().alias("ytd_return"), S.running_peak_col().alias("running_peak")), params)
    x = x.withColumn("drawdown", S.drawdown_col()).withColumn("running_peak", F.col("running_peak").cast("double"))
    return x.select(*Sg.SERIES_COLUMNS)


@pytest.mark.parametrize("rows, days", [(400, 1), (37, 1), (400, 50), (10**9, 32)])
def test_equal_to_whole_windows(spark, rows, days):
    """Segments longer and shorter than a window's reach, buckets of a day and
    of many, one segment for all; a turn of the year inside."""
    bars = minute_bars(spark, 3000)
    params = PARAMS.with_(segment_rows=rows, segment_days=days)
    got = {(r[0], r[1]): r[2:] for r in Sg.segmented_series(bars, params).collect()}
    want = {(r[0], r[1]): r[2:] for r in whole(bars, params).collect()}
    assert got.keys() == want.keys()
    for k, w in want.items():
        for a, b in zip(got[k], w):
            assert (a is None) == (b is None) and (a is None or a == pytest.approx(b, abs=1.1e-6)), (k, got[k], w)
    assert sum(g[4] is not None for g in got.values()) > 1000


def test_task_size(spark):
    """A task's rows: a segment, its halo, and a bucket more on either side."""
    bars = stored(minute_bars(spark, 6000), "bars")
    reach = {"bar": (F.lit(True), 20), "bench": (F.col("symbol") != "THIN", 252)}
    x = Sg.in_segments(bars, reach, PARAMS)
    sizes = x.groupBy("symbol", "_seg").agg(F.count("*").alias("n"), F.sum((~F.col("_halo")).cast("int")).alias("own")).collect()
    bucket = 24 * 60 // 7 + 1
    assert max(r.own for r in sizes if r.symbol == "HOT") <= PARAMS.segment_rows + bucket
    assert max(r.n for r in sizes if r.symbol == "HOT") <= PARAMS.segment_rows + 252 + 2 * bucket
    assert len([r for r in sizes if r.symbol == "HOT"]) >= 10
    assert sum(r.own for r in sizes) == bars.count()


def test_fact_over_segments(spark):
    m = Models(spark, SF_SMALL)
    bars = stored(m.stg_bars, "bars")
    got = Fa.price_fact(bars, m.stg_macro, m.params.with_(segmented=True, segment_rows=150))
    want = Fa.price_fact(bars, m.stg_macro, m.params)
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_no_bars(spark):
    assert Sg.segmented_series(minute_bars(spark, 0).where("symbol = 'NONE'"), PARAMS).collect() == []


def test_windows_are_partitioned_by_segment(spark):
    """One exchange by symbol and segment; none by symbol alone over the rows."""
    x = Sg.in_segments(stored(minute_bars(spark, 500), "bars"), {"bar": (F.lit(True), 1)}, PARAMS)
    x = S.daily_returns(x, "_seg", keep=("_halo", "_seg"))
    x.collect()
    plan = x._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("hashpartitioning(symbol") == 1 and plan.count("BroadcastHashJoin") == 1, plan

"""Distributed formulations against direct computations on small inputs."""

import math

import numpy as np
import pandas as pd
import pytest

from tests.conftest import SF_MID
from tickwise.operators import pairs as P, series as S

from tickwise.plans.context import Models


@pytest.fixture(scope="module")
def mid(spark):
    return Models(spark, SF_MID)


def _pearson(x, y):
    n = len(x)
    mx, my = sum(x) / n, sum(y) / n
    cxy = sum((a - mx) * (b - my) for a, b in zip(x, y)) / n
    sx = math.sqrt(sum((a - mx) ** 2 for a in x) / n)
    sy = math.sqrt(sum((b - my) ** 2 for b in y) / n)
    return None if sx * sy == 0 else cxy / (sx * sy)


@pytest.mark.parametrize("blocks", [1, 3, 8])
def test_pair_correlation_blocks_match_bruteforce(spark, mid, blocks):
    params = mid.params.with_(pair_blocks=blocks)
    got = {(r.symbol_a, r.symbol_b, r.year): (r.n_obs, r.correlation)
           for r in P.pairwise_correlation(mid.fact, params).collect()}
    pdf = P.pair_returns(mid.fact, params).toPandas()
    pdf["year"] = pd.to_datetime(pdf.trade_date).dt.year
    want = {}
    for year, g in pdf.groupby("year"):
        w = g.pivot(index="trade_date", columns="symbol", values="r")
        cols = sorted(w.columns)
        for i, a in enumerate(cols):
            for b in cols[i + 1:]:
                both = w[[a, b]].dropna()
                if len(both) >= params.min_pair_obs:
                    c = _pearson(list(both[a]), list(both[b]))
                    want[(a, b, year)] = (len(both), c)
    assert set(got) == set(want)
    for k, (n, c) in want.items():
        assert got[k][0] == n
        assert abs(got[k][1] - c) <= 5e-5 + 1e-12


def test_global_denominator_matches_single_window(spark, mid):
    params = mid.params
    x = S.with_benchmark(mid.returns, params)
    pdf = (x.where(f"has_bench AND symbol <> '{params.benchmark}'")
            .select("symbol", "trade_date", "simple_return", "bench_return").toPandas()
            .sort_values(["trade_date", "symbol"]).reset_index(drop=True))
    var = pdf.bench_return.rolling(params.beta_window, min_periods=1).var(ddof=0)
    cov = (pdf.groupby("symbol", group_keys=False)
              .apply(lambda g: g.simple_return.rolling(params.beta_window, min_periods=1)
                     .cov(g.bench_return, ddof=0)))
    pdf["want"] = np.where(var.abs() > 1e-18, cov / var, np.nan)
    got = S.rolling_beta_global_denominator(mid.returns, params).toPandas()
    m = pdf.merge(got, on=["symbol", "trade_date"])
    assert len(m) == len(pdf)
    ok = m.want.notna() & m.beta.notna()
    assert (abs(m.beta[ok] - m.want[ok].round(4)) <= 1.01e-4).all()


def _flat_cases(spark, window):
    """Returns of two symbols and a benchmark that is flat at the start, over
    a stretch longer than the window, and at a constant non-zero return."""
    import datetime as dt
    rng = np.random.default_rng(1)
    bench = [0.0] * 9 + [0.01, -0.02, 0.015] + [0.0] * (window + 4) + [0.03] + [0.00123] * (window + 5) + [-0.01] * 2
    start = dt.date(2020, 1, 1)
    rows = []
    for i, b in enumerate(bench):
        d = start + dt.timedelta(days=i)
        rows.append(("^IDX", d, 100.0, float(b)))
        rows.append(("AAA", d, 10.0, float(rng.normal())))
        if i % 3:
            rows.append(("BBB", d, 10.0, float(rng.normal())))
    return spark.createDataFrame(rows, "symbol string, trade_date date, adj_close double, simple_return double")


@pytest.mark.parametrize("window", [4, 7])
def test_beta_is_null_over_flat_benchmark(spark, mid, window):
    params = mid.params.with_(beta_window=window, benchmark="^IDX")
    x = S.with_benchmark(_flat_cases(spark, window), params)
    plain = (x.where(f"has_bench AND symbol <> '{params.benchmark}'")
              .select("symbol", "trade_date", "simple_return", "bench_return")
              .toPandas().sort_values(["symbol", "trade_date"]))
    got = {(r.symbol, r.trade_date): r.beta for r in S.with_rolling_beta(x, params).collect()}
    flat = 0
    for _, g in plain.groupby("symbol"):
        g = g.reset_index(drop=True)
        for i in range(len(g)):
            f = g.iloc[max(0, i - window + 1):i + 1]
            beta = got[(g.symbol[i], g.trade_date[i])]
            if f.bench_return.nunique() == 1:
                flat += 1
                assert beta is None
            else:
                want = np.cov(f.simple_return, f.bench_return, ddof=0)[0, 1] / np.var(f.bench_return)
                assert abs(beta - want) <= 1.01e-4 * max(1, abs(want))
    assert flat > 20


@pytest.mark.parametrize("window", [4, 7])
def test_global_beta_is_null_over_flat_benchmark(spark, mid, window):
    params = mid.params.with_(beta_window=window, benchmark="^IDX")
    rows = _flat_cases(spark, window)
    x = S.with_benchmark(rows, params).where("symbol <> '^IDX'").toPandas().sort_values(
        ["trade_date", "symbol"]).reset_index(drop=True)
    got = {(r.symbol, r.trade_date): r.beta for r in S.rolling_beta_global_denominator(rows, params).collect()}
    flat = 0
    for i in range(len(x)):
        f = x.bench_return[max(0, i - window + 1):i + 1]
        beta = got[(x.symbol[i], x.trade_date[i])]
        assert (beta is None) == (f.nunique() == 1)
        flat += beta is None
    assert flat > 10


def test_cumulative_return_invariant(spark, mid):
    f = mid.fact.select("symbol", "trade_date", "adj_close", "cum_return").toPandas()
    first = (mid.stg_bars.groupBy("symbol").agg({"trade_date": "min"}).toPandas())
    base = mid.stg_bars.toPandas().merge(first, left_on=["symbol", "trade_date"],
                                         right_on=["symbol", "min(trade_date)"])
    f = f.merge(base[["symbol", "adj_close"]].rename(columns={"adj_close": "p0"}), on="symbol")
    err = (f.adj_close / f.p0.astype(float) - 1 - f.cum_return).abs() / (1 + f.cum_return.abs())
    assert err.max() < 1e-5


def test_mart_invariants(spark, mid):
    r = mid.risk_mart.toPandas()
    assert (r.max_drawdown_pct.dropna() <= 0).all()
    assert r.win_rate_pct.dropna().between(0, 100).all()
    c = mid.correlation_mart.toPandas()
    assert c.correlation.dropna().between(-1, 1).all()

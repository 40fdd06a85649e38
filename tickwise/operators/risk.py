"""Annual risk mart.

The model runs three aggregates over the same (symbol, year) rows and joins
them; here one ``groupBy(symbol, year)`` computes everything. The running
peak window is partitioned by symbol, and a hash partitioning on symbol
already satisfies the (symbol, year) grouping, so the mart costs one
Exchange in total. Exact percentiles keep at most one value per trading
day of a (symbol, year) group, i.e. at most 366.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.functions.num import rnd, safe_div, surrogate_key
from tickwise.operators import series as S
from tickwise.params import DEFAULT_PARAMS, Params


def _r() -> Column:
    return F.col("simple_return")


def downside_col() -> Column:
    """the return when negative, else 0 (NULL returns count as 0)."""
    return F.when(_r() < 0, _r()).otherwise(F.lit(0.0))


def sharpe_class_col(c="sharpe") -> Column:
    """thresholds on the rounded ratio; NULL falls to 'negativo'."""
    s = F.col(c)
    return (F.when(s >= 1, "excelente").when(s >= 0.5, "bom")
             .when(s >= 0, "neutro").otherwise("negativo"))


def with_drawdown(fact: DataFrame) -> DataFrame:
    """F1-F2: running peak (not reset each year) and current drawdown."""
    x = fact.withColumn("running_peak", S.running_peak_col())
    return x.withColumn("drawdown", S.drawdown_col("running_peak"))


def annual_aggs(params: Params = DEFAULT_PARAMS) -> dict[str, Column]:
    """F3, F5-F13 as named aggregate columns over one (symbol, year) group."""
    ann = float(params.annualisation)
    r = _r()
    vol = F.stddev_samp(r) * F.sqrt(F.lit(ann))
    cdi = F.coalesce(F.col("cdi_daily").cast("double"), F.lit(0.0)) / 100
    neg = downside_col()
    return {
        "sessions": F.count(F.lit(1)),
        "annual_return": rnd(F.sum(r), 6),
        "annual_return_comp": rnd(F.exp(F.sum("log_return")) - 1, 6),
        "annual_vol": rnd(vol, 6),
        "annual_mean_return": rnd(F.avg(r) * ann, 6),
        "sharpe": rnd(safe_div(F.avg(r) * ann - F.avg(cdi) * ann, vol), 4),
        "var_95": rnd(F.percentile(r, 0.05), 6),
        "var_99": rnd(F.percentile(r, 0.01), 6),
        "up_days": F.count_if(r > 0),
        "down_days": F.count_if(r < 0),
        "mean_beta": rnd(F.avg("beta"), 4),
        "sortino": rnd(safe_div(F.avg(r) * ann,
                                F.sqrt(safe_div(F.sum(neg * neg), F.count(F.lit(1)) - 1))
                                * F.sqrt(F.lit(ann))), 4),
        "max_drawdown": rnd(F.min("drawdown"), 6),
    }


def annual_metrics(fact: DataFrame, params: Params = DEFAULT_PARAMS,
                   names: list[str] | None = None) -> DataFrame:
    """The per-(symbol, year) metrics over non-benchmark rows."""
    aggs = annual_aggs(params)
    names = names or list(aggs)
    base = fact.where(F.col("symbol") != params.benchmark)
    if "max_drawdown" in names:
        base = with_drawdown(base)
    return (base.groupBy("symbol", F.year("trade_date").alias("year"))
                .agg(*[aggs[n].alias(n) for n in names]))


def risk_mart(fact: DataFrame, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """the annual risk table with percent conversions and classes."""
    return mart_rows(annual_metrics(fact, params))


def mart_rows(m: DataFrame) -> DataFrame:
    """The mart's columns, from the annual metrics."""
    return m.select(
        surrogate_key("symbol", "year").alias("id"),
        "symbol", "year", "sessions",
        rnd(F.col("annual_return_comp") * 100, 2).alias("annual_return_pct"),
        rnd(F.col("annual_vol") * 100, 2).alias("volatility_pct"),
        "sharpe", "sortino", "mean_beta",
        rnd(F.col("var_95") * 100, 4).alias("var_95_pct"),
        rnd(F.col("var_99") * 100, 4).alias("var_99_pct"),
        rnd(F.col("max_drawdown") * 100, 4).alias("max_drawdown_pct"),
        "up_days", "down_days",
        F.col("sessions").alias("total_sessions"),
        rnd(safe_div(F.col("up_days").cast("double"), F.col("sessions").cast("double")) * 100, 2)
        .alias("win_rate_pct"),
        sharpe_class_col("sharpe").alias("sharpe_class"))

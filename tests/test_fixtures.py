"""One hand-worked fixture per semantic quirk (FIXTURES.md §3)."""

import math
import random

from pyspark.sql import functions as F

from tests.fixtures import bars, d, empty_macro, macro
from tickwise.operators import assets as A, fact as Fa, macro as Mc, pairs as P
from tickwise.operators import quality as Qy, reports as Rp, risk as R, series as S
from tickwise.operators import staging as St, upsert as U, validate as V
from tickwise.params import Params
from tickwise.sources import landing as Ld

P0 = Params(benchmark="^IDX")


def fact_of(spark, bar_rows, macro_rows=None, params=P0):
    m = macro(spark, macro_rows) if macro_rows else empty_macro(spark)
    return Fa.price_fact(St.stg_bars(bars(spark, bar_rows)), St.stg_macro(m), params)


def test_first_bar_dropped(spark):
    f = fact_of(spark, [("AAA", "2020-01-02", 10), ("AAA", "2020-01-03", 11), ("AAA", "2020-01-06", 12)])
    assert f.count() == 2
    st = A.asset_stats(f).collect()[0]
    assert st.sessions == 2
    r = {x.trade_date: x for x in f.collect()}
    assert r[d("2020-01-03")].simple_return == 0.1
    assert r[d("2020-01-06")].days_since_prev == 3


def test_single_return_high_risk(spark):
    f = fact_of(spark, [("AAA", "2020-01-02", 10), ("AAA", "2020-01-03", 11)])
    assets = spark.createDataFrame([("AAA", "A", "S", None, "ACAO", "Brasil", "BRL", True)],
                                   "symbol string, name string, sector string, subsector string, "
                                   "kind string, country string, currency string, active boolean")
    row = A.asset_dim(St.stg_assets(assets), f).collect()[0]
    assert row.current_vol is None and row.risk_profile == "alto"


def test_constant_series_correlation_is_null(spark):
    rows = []
    for i in range(26):
        day = (d("2020-01-01").toordinal() + i)
        for s in ("AAA", "BBB"):
            rows.append((s, d("2020-01-01").fromordinal(day).isoformat(), 2.0 ** i))
    f = fact_of(spark, rows)
    out = P.pairwise_correlation(f, P0).collect()
    assert len(out) == 1 and out[0].n_obs == 25 and out[0].correlation is None
    cls = P.correlation_mart(f, P0).collect()[0]
    assert cls.corr_class == "alta_negativa" and cls.diversification == "baixo"


def test_unmatched_benchmark_day(spark):
    days = ["2020-01-02", "2020-01-03", "2020-01-06", "2020-01-07", "2020-01-08", "2020-01-09"]
    px = [10, 11, 10.5, 12, 12.5, 12]
    bx = [100, 101, 99, 103, None, 104]
    rows = [("AAA", dd, p) for dd, p in zip(days, px)]
    rows += [("^IDX", dd, b) for dd, b in zip(days, bx) if b is not None]
    f = {x.trade_date: x for x in fact_of(spark, rows).where("symbol = 'AAA'").collect()}
    assert f[d("2020-01-08")].beta is None and f[d("2020-01-08")].bench_return is None
    # the frame of the next day skips the unmatched row: 2020-01-09 pairs with
    # the benchmark return from 01-07 to 01-09
    assert f[d("2020-01-09")].beta is not None


def test_global_denominator_stable_under_shuffle(spark):
    rows = [(s, dd, p) for s, base in (("AAA", 10), ("BBB", 20))
            for dd, p in zip(["2020-01-02", "2020-01-03", "2020-01-06"], [base, base * 1.1, base * 0.95])]
    rows += [("^IDX", dd, b) for dd, b in zip(["2020-01-02", "2020-01-03", "2020-01-06"], [100, 102, 99])]
    res = []
    for seed in (1, 2, 3):
        r = rows[:]
        random.Random(seed).shuffle(r)
        ret = S.daily_returns(St.stg_bars(bars(spark, r).repartition(3)))
        res.append(sorted(S.rolling_beta_global_denominator(ret, P0).collect()))
    assert res[0] == res[1] == res[2]


def test_monthly_value_absent_from_spine(spark):
    f = fact_of(spark, [("AAA", "2020-01-14", 10), ("AAA", "2020-01-15", 11)],
                [("2020-01-01", "ipca", 0.5), ("2020-01-14", "cdi", 0.03)])
    r = {x.trade_date: x for x in f.collect()}
    assert r[d("2020-01-15")].ipca_monthly is None


def test_ipca_zero_gives_null_real_return(spark):
    f = fact_of(spark, [("AAA", "2020-01-01", 10), ("AAA", "2020-01-02", 11)],
                [("2020-01-02", "ipca", 0.0)])
    row = f.collect()[0]
    assert row.ipca_monthly == 0.0 and row.real_return is None


def test_selic_target_column_always_null(spark):
    m = St.stg_macro(macro(spark, [("2020-01-01", "selic_meta", 13.75), ("2020-02-01", "selic_meta", 13.5)]))
    assert all(r.selic_target is None for r in Mc.macro_wide(m).collect())
    assert {r.frequency for r in m.collect()} == {"outro"}


def test_negative_open_kept_by_staging_rejected_by_validation(spark):
    b = bars(spark, [("AAA", "2020-01-02", 10, -1.0, 11.0, 9.0)])
    assert St.stg_bars(b).count() == 1
    v = V.validate_bars(b).collect()[0]
    assert not v.is_valid and "open_not_positive" in v.reasons


def test_nan_price_quarantined(spark):
    b = bars(spark, [("AAA", "2020-01-02", 10, float("nan"), 11.0, 9.0)])
    q = V.quarantine(V.validate_bars(b), "bars", ["symbol", "trade_date"]).collect()
    assert [r.reason for r in q] == ["open_nan"]


def test_upsert_null_overwrites_and_source_kept(spark):
    t = spark.createDataFrame([("A", 1.0, "old"), ("B", 2.0, "old")], "k string, v double, src string")
    b = spark.createDataFrame([("A", None, "new"), ("C", 3.0, "new")], "k string, v double, src string")
    out = {r.k: r for r in U.upsert(t, b, ["k"], ["v"]).collect()}
    assert out["A"].v is None and out["A"].src == "old"
    assert out["B"].v == 2.0 and out["C"].src == "new"
    again = U.upsert(U.upsert(t, b, ["k"], ["v"]), b, ["k"], ["v"])
    assert sorted(again.collect()) == sorted(U.upsert(t, b, ["k"], ["v"]).collect())


def test_duplicate_key_last_value_first_source(spark):
    b = spark.createDataFrame([("A", 1.0, "first", 1), ("A", 2.0, "second", 2)],
                              "k string, v double, src string, batch_seq int")
    out = U.dedupe_batch(b, ["k"], ["v"]).collect()
    assert len(out) == 1 and out[0].v == 2.0 and out[0].src == "first"


def test_bad_json_date_and_value(spark):
    doc = '[{"data": "02/01/2020", "valor": "0,05"}, {"data": "2020-01-03", "valor": "1"}, {"data": "06/01/2020", "valor": "x"}]'
    docs = spark.createDataFrame([("cdi", doc)], "series string, doc string")
    parsed = Ld.parse_daily_series(docs)
    good = Ld.macro_records(parsed).collect()
    assert len(good) == 1 and good[0].value == 0.05 and good[0].unit == "% a.d."
    assert sorted(r.reason for r in parsed.where("reason IS NOT NULL").collect()) == ["bad_date", "bad_value"]


def test_only_first_series_entry_read(spark):
    doc = ('[{"resultados": [{"series": [{"serie": {"202001": "0.21", "202002": "0.25"}}, '
           '{"serie": {"202001": "9.99"}}]}]}]')
    docs = spark.createDataFrame([(doc,)], "doc string")
    rows = sorted(Ld.macro_records(Ld.parse_nested_series(docs), "ibge", Ld.IPCA_UNIT).collect())
    assert [(r.obs_date, r.value) for r in rows] == [(d("2020-01-01"), 0.21), (d("2020-02-01"), 0.25)]


def test_gap_from_friday_ignored_from_monday_reported(spark):
    b = St.stg_bars(bars(spark, [("AAA", "2020-01-03", 10), ("AAA", "2020-01-15", 10),   # Fri -> +12
                                 ("AAA", "2020-01-20", 10), ("AAA", "2020-02-01", 10)]))  # Mon -> +12
    out = Rp.session_gaps(b).collect()
    assert [(r.prev_date, r.gap_days) for r in out] == [(d("2020-01-20"), 12)]


def test_drawdown_peak_carried_across_years(spark):
    f = fact_of(spark, [("AAA", "2019-12-30", 10), ("AAA", "2019-12-31", 20),
                        ("AAA", "2020-01-02", 15), ("AAA", "2020-01-03", 16)])
    rows = {r.year: r for r in R.risk_mart(f, P0).collect()}
    assert rows[2020].max_drawdown_pct == -25.0
    assert rows[2019].max_drawdown_pct == 0.0


def test_base100_late_symbol_is_null(spark):
    f = fact_of(spark, [("AAA", "2020-01-01", 10), ("AAA", "2020-01-02", 11), ("AAA", "2020-01-03", 12),
                        ("BBB", "2020-01-02", 5), ("BBB", "2020-01-03", 6)])
    rows = {(r.symbol, r.trade_date): r.base100 for r in Rp.base100_prices(f, P0).collect()}
    assert rows[("AAA", d("2020-01-03"))] == round(12 / 11 * 100, 6)
    assert rows[("BBB", d("2020-01-03"))] is None


def test_mostly_on_the_boundary(spark):
    exp = Qy.Expectation("s", "expect_column_values_to_be_between", "x", {"min_value": 0, "max_value": 1,
                                                                          "mostly": 0.99})
    for bad, ok in ((1, True), (2, False)):
        df = spark.createDataFrame([(0.5 if i >= bad else 5.0,) for i in range(100)], "x double")
        r = Qy.run_expectations({"s": df}, [exp]).collect()[0]
        assert r.success is ok and r.unexpected_count == bad


def test_not_null_and_unique_tests(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 2), ("b", 3)], "k string, v int")
    tests = [Qy.Test("t", "unique", "k"), Qy.Test("t", "not_null", "v"),
             Qy.Test("t", "accepted_values", "k", ("a",)), Qy.Test("t", "expression", "v", expr="< 3")]
    out = {r.kind: r.failures for r in Qy.run_tests({"t": df}, tests).collect()}
    assert out == {"unique": 1, "not_null": 1, "accepted_values": 1, "expression": 1}


def test_adj_close_fallback_only_when_column_absent(spark):
    f = spark.createDataFrame([("AAA", d("2020-01-02"), 10.0, 0.0)], "symbol string, Date date, Close double, Volume double")
    r = Ld.ingest_bars(f).collect()[0]
    assert r.adj_close == 10.0 and r.volume is None and r.open is None
    g = spark.createDataFrame([("AAA", d("2020-01-02"), 10.0, None)], "symbol string, Date date, Close double, `Adj Close` double")
    assert Ld.ingest_bars(g).collect()[0].adj_close is None


def test_symbol_list_split_and_trim(spark):
    df = spark.createDataFrame([("PETR4.SA, VALE3.SA ,^BVSP",)], "s string")
    assert df.select(Ld.parse_symbol_list(F.col("s")).alias("l")).collect()[0].l == ["PETR4.SA", "VALE3.SA", "^BVSP"]


def test_incremental_refetches_last_day(spark):
    t = bars(spark, [("AAA", "2020-01-02", 10), ("AAA", "2020-01-03", 11)])
    b = bars(spark, [("AAA", "2020-01-02", 10), ("AAA", "2020-01-03", 11), ("AAA", "2020-01-06", 12),
                     ("NEW", "2018-05-01", 1), ("NEW", "2019-01-02", 1)])
    out = sorted((r.symbol, r.trade_date) for r in U.incremental_filter(t, b, "2019-01-01").collect())
    assert out == [("AAA", d("2020-01-03")), ("AAA", d("2020-01-06")), ("NEW", d("2019-01-02"))]


def test_risk_metrics_match_python(spark):
    px = [10, 10.5, 10.2, 10.8, 10.1, 10.9, 11.3, 10.7]
    days = [d("2021-03-01").fromordinal(d("2021-03-01").toordinal() + i).isoformat() for i in range(len(px))]
    f = fact_of(spark, [("AAA", dd, p) for dd, p in zip(days, px)])
    row = R.risk_mart(f, P0).collect()[0]
    r = [round((b - a) / a, 8) for a, b in zip(px, px[1:])]
    n = len(r)
    mean = sum(r) / n
    sd = math.sqrt(sum((x - mean) ** 2 for x in r) / (n - 1))
    assert row.sessions == n and row.up_days == sum(x > 0 for x in r)
    assert abs(row.sharpe - round(mean * 252 / (sd * math.sqrt(252)), 4)) < 1e-4
    assert row.win_rate_pct == round(sum(x > 0 for x in r) / n * 100, 2)


def test_global_denominator_single_date_frame_is_null(spark):
    # Window of 2 rows: every frame that lies inside one date holds a single
    # benchmark value, so its variance is exactly 0 and beta is NULL.
    p = Params(benchmark="^IDX", beta_window=2)
    rows = [(s, dd, px) for s, k in (("AAA", 1.0), ("BBB", 2.0), ("CCC", 3.0))
            for dd, px in (("2020-01-02", 10 * k), ("2020-01-03", 11 * k), ("2020-01-06", 12 * k))]
    rows += [("^IDX", dd, b) for dd, b in (("2020-01-02", 100), ("2020-01-03", 101), ("2020-01-06", 99))]
    ret = S.daily_returns(St.stg_bars(bars(spark, rows)))
    out = {(r.symbol, r.trade_date): r.beta for r in S.rolling_beta_global_denominator(ret, p).collect()}
    # 2020-01-03: AAA is the first row of the frame series; BBB's and CCC's
    # frames (2 rows) lie inside 2020-01-03 -> NULL. 2020-01-06: AAA's frame
    # spans two dates -> a value; BBB and CCC again inside one date -> NULL.
    assert out[("BBB", d("2020-01-03"))] is None and out[("CCC", d("2020-01-03"))] is None
    assert out[("BBB", d("2020-01-06"))] is None and out[("CCC", d("2020-01-06"))] is None


def test_bar_without_date_rejected(spark):
    b = spark.createDataFrame([("aaa ", None, 1.0, 1.0, 1.0, 1.0, 1.0, 1, "x")],
                              "symbol string, trade_date date, open double, high double, low double, "
                              "close double, adj_close double, volume long, source string")
    r = V.validate_bars(b).collect()[0]
    assert r.symbol == "AAA" and r.reasons == ["missing_date"] and not r.is_valid

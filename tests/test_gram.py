"""Pair correlations by block products against the pass over each pair."""

import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tickwise.operators import pairs as P
from tickwise.params import DEFAULT_PARAMS
from tickwise.plans.context import Models
from tickwise.session import stored


def plain(x, y):
    """One pair in plain Python: common days and the correlation, or None."""
    common = [(a, b) for a, b in zip(x, y) if not (math.isnan(a) or math.isnan(b))]
    n = len(common)
    if not n:
        return 0, None
    if len({a for a, _ in common}) == 1 or len({b for _, b in common}) == 1:
        return n, None
    mx, my = math.fsum(a for a, _ in common) / n, math.fsum(b for _, b in common) / n
    sxy = math.fsum((a - mx) * (b - my) for a, b in common)
    return n, sxy / math.sqrt(math.fsum((a - mx) ** 2 for a, _ in common)) / math.sqrt(math.fsum((b - my) ** 2 for _, b in common))


VALUES = st.sampled_from([float("nan"), float("nan"), 0.0, 0.1, 0.1, -0.3, 1e-8, 0.02])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(VALUES, min_size=8, max_size=8), min_size=1, max_size=4),
       st.lists(st.lists(VALUES, min_size=8, max_size=8), min_size=1, max_size=4))
def test_block_against_plain_pairs(a, b):
    n, corr = P.gram_block(np.array(a), np.array(b))
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            want_n, want = plain(x, y)
            assert n[i, j] == want_n
            assert math.isnan(corr[i, j]) if want is None else corr[i, j] == pytest.approx(want, abs=1e-9)


def returns(spark, symbols, days):
    """Synthetic returns: one symbol constant, one constant on the days that
    another has, the rest with holes."""
    r = (F.pmod(F.xxhash64("s", "d"), F.lit(2001)) - 1000) / 20000
    df = spark.range(symbols).select(F.format_string("S%05d", "id").alias("symbol"), F.col("id").alias("s")).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(days - 1))).alias("d"))
    return df.where((F.col("s") % 5 != 1) | (F.col("d") % 3 != 0)).select(
        "symbol", F.date_add(F.lit("2001-01-01").cast("date"), F.col("d")).alias("trade_date"),
        F.when(F.col("s") == 2, 0.01).when((F.col("s") == 3) & (F.col("d") % 3 != 0), 0.07).otherwise(F.round(r, 8))
        .alias("simple_return"))


@pytest.mark.parametrize("blocks", [1, 3, 8])
def test_equal_to_the_pass_over_each_pair(spark, blocks):
    fact = stored(returns(spark, 40, 500), "fact")
    params = DEFAULT_PARAMS.with_(pair_blocks=blocks)
    got = {tuple(r)[:4]: r.corr_raw for r in P.gram_moments(fact, params, 5).collect()}
    want = {tuple(r)[:4]: r.corr_raw for r in P.pair_moments(fact, params, 5).collect()}
    assert got.keys() == want.keys() and len(got) == 2 * 40 * 39 // 2
    for k, w in want.items():
        assert (got[k] is None) == (w is None), k
        assert w is None or got[k] == pytest.approx(w, abs=1e-11)
    assert any(w is None for w in want.values())


def test_marts_agree(spark):
    m = Models(spark, SF_SMALL)
    fact = stored(m.fact, "fact")
    got = P.correlation_mart(fact, m.params)
    want = P.correlation_mart(fact, m.params.with_(pair_gram=False))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_no_returns(spark):
    empty = returns(spark, 3, 5).where("false")
    assert P.gram_moments(empty, DEFAULT_PARAMS).collect() == []

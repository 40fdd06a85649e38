"""Refreshes from a state against full rebuilds; tables that change at once."""

import datetime as dt
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tickwise.operators import assets as A, fact as Fa, risk as R
from tickwise.plans import versions as V
from tickwise.plans.context import Models
from tickwise.plans.refresh import Store
from tickwise.session import stored


@pytest.fixture(scope="module")
def inputs(spark):
    m = Models(spark, SF_SMALL)
    return stored(m.stg_bars, "bars"), stored(m.stg_macro, "macro"), m


def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def until(df, column, date):
    return df.where(F.col(column) <= F.lit(date))


def same(a, b):
    a = a.select(*b.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def refresh(store, inputs, date, settle=0):
    return store.refresh(until(inputs[0], "trade_date", date), until(inputs[1], "obs_date", date), settle)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_cuts_equal_a_full_rebuild(spark, inputs, seed):
    bars, macro, m = inputs
    rng = random.Random(seed)
    first, last = bars.agg(F.min("trade_date"), F.max("trade_date")).first()
    cuts = sorted(first + dt.timedelta(days=rng.randrange((last - first).days)) for _ in range(3))
    store = Store(spark, folder())
    for date in cuts:
        refresh(store, inputs, date, rng.choice([0, 7, 60]))
    date = cuts[-1]
    full = stored(Fa.price_fact(until(bars, "trade_date", date), until(macro, "obs_date", date)), "full")
    same(store.fact(), full)
    same(store.risk_mart(), R.risk_mart(full))
    same(store.asset_dim(m.stg_assets), A.asset_dim(m.stg_assets, full))


def test_old_years_are_neither_read_nor_written(spark, inputs):
    """With the folders of settled years gone, a refresh still succeeds and
    leaves their entries as they were."""
    store = Store(spark, folder())
    before = refresh(store, inputs, dt.date(1998, 3, 1))
    for y in ("1995", "1996", "1997"):
        fs, at = V._context(spark, before["years"][y]["fact"])[1:]
        assert fs.delete(at, True)
    after = refresh(store, inputs, dt.date(1998, 6, 1))
    for y in ("1995", "1996", "1997"):
        assert after["years"][y] == before["years"][y]
    assert after["years"]["1998"]["fact"] != before["years"]["1998"]["fact"]
    assert after["settled"] > before["settled"]


def test_late_rows_after_the_settled_date_are_taken_up(spark, inputs):
    """Bars that came late, the benchmark's among them, count if they are
    dated after the settled date."""
    bars, macro, _ = inputs
    store = Store(spark, folder())
    date = dt.date(1997, 8, 1)
    late = F.col("trade_date") > F.lit(date - dt.timedelta(days=20))
    store.refresh(until(bars, "trade_date", date).where(~(late & F.col("symbol").isin("^BVSP", "BRAND11"))),
                  until(macro, "obs_date", date - dt.timedelta(days=20)), 30)
    refresh(store, inputs, date)
    same(store.fact(), Fa.price_fact(until(bars, "trade_date", date), until(macro, "obs_date", date)))


def test_failed_refresh_changes_nothing(spark, inputs, monkeypatch):
    store = Store(spark, folder())
    manifest = refresh(store, inputs, dt.date(1996, 1, 1))
    rows = store.fact().count()

    def broken(*args):
        raise OSError("disk full")

    for step in ("tickwise.plans.refresh.next_state", "tickwise.operators.assets.year_parts",
                 "tickwise.plans.refresh.Store._risk", "tickwise.plans.versions.write_manifest"):
        with monkeypatch.context() as p:
            p.setattr(step, broken)
            with pytest.raises(OSError):
                refresh(store, inputs, dt.date(1996, 3, 1))
        assert store.manifest == manifest and store.fact().count() == rows
    refresh(store, inputs, dt.date(1996, 3, 1))
    assert store.fact().count() > rows


def test_no_new_days_and_sweep(spark, inputs):
    store = Store(spark, folder())
    refresh(store, inputs, dt.date(1995, 6, 1))
    manifest = refresh(store, inputs, dt.date(1995, 7, 1))
    assert refresh(store, inputs, dt.date(1995, 7, 1)) == manifest
    rows = store.fact().count()
    assert V.sweep(spark, store.base) > 0
    assert V.sweep(spark, store.base) == 0
    assert store.fact().count() == rows and store.risk_mart().count() > 0


def test_nothing_stored(spark, inputs):
    store = Store(spark, folder())
    assert store.refresh(inputs[0].limit(0), inputs[1])["years"] == {}
    assert store.fact() is None and V.read_manifest(spark, store.base) is None

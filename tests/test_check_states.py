"""Checks from states by year equal the checks of the whole table."""

import datetime as dt
import glob
import os
import random
import uuid

import pytest

from tickwise.operators import quality as Qy
from tickwise.plans import jobs as J
from tickwise.plans.check_states import CheckStates
from tickwise.session import checkpoint_dir

COLS = ("symbol string, trade_date date, adj_close double, volume bigint, high double, low double, source string, "
        "id string, kind string")
EXPS = [e for e in Qy.EXPECTATIONS if e.suite == Qy.BAR_SUITE]
TESTS = [Qy.Test("t", "unique", "id"), Qy.Test("t", "not_null", "symbol"),
         Qy.Test("t", "accepted_values", "kind", ("ACAO", "FII")),
         Qy.Test("t", "expression", "adj_close", expr="> 0", where="adj_close is not null")]


def _new(spark):
    return os.path.join(checkpoint_dir(spark), "tickwise_test", uuid.uuid4().hex)


def _rows(n, seed, years=(2019, 2020, 2021)):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        day = dt.date(r.choice(years), r.randint(1, 2), r.randint(1, 5)) if r.random() > 0.03 else None
        out.append((r.choice(["AAA", "BBB", "x", None]), day, r.choice([None, 0.0, r.random() * 1e6]),
                    r.choice([None, -1, 5]), r.random() + 0.5, r.random(), r.choice(["b3", "other", None]),
                    r.choice([None, f"k{r.randint(0, 3 * n)}"]), r.choice(["ACAO", "FII", "C", "D", None])))
    return out


def _same(spark, states, df):
    key = lambda d: sorted(map(str, d.collect()))
    assert key(states.expectation_results()) == key(Qy.run_expectations({Qy.BAR_SUITE: df}, EXPS))
    assert key(states.test_results(df)) == key(Qy.run_tests({"t": df}, TESTS))


@pytest.mark.parametrize("seed", [1, 2])
def test_merged_states_equal_the_full_check(spark, seed):
    rows = _rows(300, seed)
    df = spark.createDataFrame(rows, COLS)
    states = CheckStates(spark, _new(spark), "trade_date", EXPS, TESTS)
    states.update(df)
    _same(spark, states, df)
    # one year changed, one gone, one new
    later = [r for r in rows if r[1] is None or r[1].year == 2019]
    later += _rows(80, seed + 10, (2020,)) + _rows(20, seed + 20, (2022,))
    later = [r for r in later if r[1] is None or r[1].year != 2021]
    df = spark.createDataFrame(later, COLS)
    states.update(df, [0, 2020, 2021, 2022])
    _same(spark, states, df)


def test_a_key_repeated_over_years_is_found(spark):
    row = lambda y, k: ("AAA", dt.date(y, 1, 2), 1.0, 1, 2.0, 1.0, "b3", k, "ACAO")
    first, both = [row(2019, "a"), row(2019, "b")], [row(2019, "a"), row(2019, "b"), row(2020, "a"), row(2020, "c")]
    states = CheckStates(spark, _new(spark), "trade_date", [], TESTS)
    df = spark.createDataFrame(first, COLS)
    states.update(df)
    assert {r.column_name: r.failures for r in states.test_results(df).collect()}["id"] == 0
    df = spark.createDataFrame(both, COLS)
    states.update(df, [2020])
    assert {r.column_name: r.failures for r in states.test_results(df).collect()}["id"] == 1


def test_no_rows_and_keys_without_the_date(spark):
    df = spark.createDataFrame([], COLS)
    states = CheckStates(spark, _new(spark), "trade_date", EXPS, TESTS)
    states.update(df)
    _same(spark, states, df)
    with pytest.raises(ValueError):
        CheckStates(spark, _new(spark), "trade_date", [Qy._e("s", Qy.EXPECTATIONS[8].etype, None, column_list=["symbol"])])


def test_old_years_are_not_read(spark):
    path, base = _new(spark), _new(spark)
    J.publish(spark.createDataFrame([r for r in _rows(200, 5) if r[1]], COLS), path)
    table = spark.read.parquet(path)
    want = J.run_checkpoint(spark, base, {Qy.BAR_SUITE: (table, "trade_date")}).drop("run_id", "run_at").collect()
    for f in glob.glob(path.removeprefix("file://") + "/year=2019/*.parquet"):
        size = os.path.getsize(f)
        with open(f, "wb") as out:                     # a read of 2019 would fail
            out.write(b"x" * size)
    for crc in glob.glob(path.removeprefix("file://") + "/year=2019/.*.crc"):
        os.truncate(crc, 0)
    table = spark.read.schema(table.schema).parquet(path)
    got = J.run_checkpoint(spark, base, {Qy.BAR_SUITE: (table, "trade_date")}, [2020, 2021])
    assert sorted(map(str, got.drop("run_id", "run_at").collect())) == sorted(map(str, want))
    history = J.quality_history(spark, base)
    assert history.select("run_id").distinct().count() == 2 and history.count() == 2 * len(EXPS)

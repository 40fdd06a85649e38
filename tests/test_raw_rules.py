"""A load that breaks a rule of the raw tables is refused whole."""

import datetime as dt
import glob
import os
import uuid

import pytest
from pyspark.sql import types as T

from tests.fixtures import bars
from tickwise.operators import raw_rules as Rr
from tickwise.plans import jobs as J
from tickwise.session import checkpoint_dir
from tickwise.streaming import ingest as SI


def _new(spark):
    return os.path.join(checkpoint_dir(spark), "tickwise_test", uuid.uuid4().hex)


def _assets(spark, *rows):
    cols = "symbol string, name string, sector string, subsector string, kind string, country string, currency string, active boolean"
    return spark.createDataFrame([(s, n, "S", "U", "ACAO", "Brasil", cur, True) for s, n, cur in rows], cols)


def _macro(spark, *rows):
    return spark.createDataFrame([(dt.date(2020, 1, 1), s, v, u, "bcb") for s, v, u in rows],
                                 "obs_date date, series string, value double, unit string, source string")


def _rows(spark, path):
    return sorted(map(str, spark.read.parquet(path).collect()))


def test_edges_of_each_kind(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame(
        [(1, "x" * 20, 999999999999.999999), (2, "é" * 20, 1e12), (3, "x" * 21, 999999999999.0), (4, None, nan),
         (5, "", inf), (6, "x", -1e12), (7, "x", None)], "id int, symbol string, close double")
    got = {r.id: r.b for r in df.select("id", Rr.broken_rules(df, "bars").alias("b")).collect()}
    size, need, digits = ("symbol takes at most 20 characters", "symbol is required",
                          "close takes at most 12 digits before the point")
    # 999999999999.999999 is 1e12 as a double
    assert got == {1: [digits], 2: [digits], 3: [size], 4: [need], 5: [digits], 6: [digits], 7: []}


@pytest.mark.parametrize("step", ["assets", "prices", "macro"])
def test_refused_load_leaves_the_table_and_names_the_rule(spark, step):
    out = _new(spark)
    good = {"assets": _assets(spark, ("AAA", "a", "BRL")), "prices": bars(spark, [("AAA", "2020-01-02", 10)]),
            "macro": _macro(spark, ("cdi", 1.0, "%"))}
    J.run_load(spark, out, good["prices"], good["macro"], good["assets"], mode="full")
    before = {s: _rows(spark, f"{out}/{s}") for s in good}
    bad = {"assets": _assets(spark, ("BBB", "b", "BRL"), ("CCC", "c" * 201, "ELEVENCHARS")),
           "prices": bars(spark, [("BBB", "2020-01-03", 10), ("C" * 30, "2020-01-03", 10)]),
           "macro": _macro(spark, ("cdi", 2.0, "%"), ("usd_brl", 1e13, "u" * 21))}
    want = {"assets": {"name takes at most 200 characters": 1, "currency takes at most 10 characters": 1},
            "prices": {"symbol takes at most 20 characters": 1},
            "macro": {"unit takes at most 20 characters": 1, "value takes at most 12 digits before the point": 1}}
    with pytest.raises(Rr.RawRuleError) as e:
        J.run_load(spark, out, bad["prices"], bad["macro"], bad["assets"], mode="full", only=step)
    assert e.value.counts == want[step]
    assert all(name in str(e.value) for name in want[step])
    assert {s: _rows(spark, f"{out}/{s}") for s in good} == before
    assert not glob.glob(out.removeprefix("file:") + "/*.new-*")
    aside = spark.read.parquet(out + "/quarantine").collect()
    assert {r.reason for r in aside} == set(want[step])
    # what the load held besides is loaded once the bad row is gone
    fixed = bad[step].where("length(symbol) < 20 AND name <> repeat('c', 201)" if step == "assets"
                            else "length(symbol) < 20" if step == "prices" else "value < 10")
    J.run_load(spark, out, fixed, fixed, fixed, mode="full", only=step)
    assert spark.read.parquet(f"{out}/{step}").count() == (1 if step == "macro" else 2)


def test_empty_load_passes(spark):
    out = _new(spark)
    J.run_load(spark, out, bars(spark, [("AAA", "2020-01-02", 10)]).where("symbol = 'none'"),
               _macro(spark, ("cdi", 1.0, "%")).where("value > 9"), _assets(spark, ("AAA", "a", "BRL")).where("false"),
               mode="full")
    assert spark.read.schema("symbol string").parquet(out + "/assets").count() == 0


def test_stream_sets_the_rows_aside(spark):
    base = _new(spark)
    schema = T.StructType(SI.STREAM_SCHEMA.fields + [T.StructField("file_path", T.StringType())])
    rows = [(s, dt.date(2020, 1, 2), 1.0, 2.0, 0.5, 1.5, a, 100.0, 1, None, "f1")
            for s, a in (("AAA", 1.4), ("B" * 30, 1.4), ("CCC", 1e12))]
    SI.process_batch(spark, base + "/bars", base + "/q")(spark.createDataFrame(rows, schema), 1)
    assert [r.symbol for r in spark.read.parquet(base + "/bars").collect()] == ["AAA"]
    assert sorted(r.reason for r in spark.read.parquet(base + "/q").collect()) == [
        "adj_close takes at most 12 digits before the point", "symbol takes at most 20 characters"]

"""H5: interleaved files: same rows, both lookups skip most of them."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tickwise.plans import interleave as I, job_queries as Jq, jobs as J
from tickwise.plans.context import Models
from tickwise.session import checkpoint_dir


def _new(spark):
    return os.path.join(checkpoint_dir(spark), "tickwise_test", uuid.uuid4().hex)


def rows_scanned(df) -> int:
    """Rows that the plan's scan gave out (after files and row groups were skipped)."""
    qe = df._jdf.queryExecution()
    plan = qe.executedPlan()
    plan.executeCollect()
    plan = plan.finalPhysicalPlan() if "AdaptiveSparkPlan" in plan.nodeName() else plan
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().get("numOutputRows").get().value() for i in range(leaves.size()))


@pytest.fixture(scope="module")
def bars(spark):
    """64 symbols on 512 days, and one more symbol with as many rows as half of them."""
    even = spark.range(64 * 512).select(
        F.format_string("S%02d", (F.col("id") % 64)).alias("symbol"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") / 64).cast("int")).alias("trade_date"),
        F.col("id").alias("v"))
    hot = spark.range(32 * 512).select(
        F.lit("HOT").alias("symbol"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 512).cast("int")).alias("trade_date"),
        (-F.col("id") - 1).alias("v"))
    path = _new(spark)
    even.unionByName(hot).write.parquet(path)
    return spark.read.parquet(path)


def test_bits_in_turn(spark):
    pairs = [(0, 0), (1, 0), (0, 1), (5, 3), (65535, 0), (0, 65535), (65535, 65535), (40000, 12345)]
    got = spark.createDataFrame(pairs, "a bigint, b bigint").select(
        "a", "b", I.interleaved_bits(F.col("a"), F.col("b")).alias("z")).collect()
    for a, b, z in got:
        assert z == sum((a >> i & 1) << 2 * i + 1 | (b >> i & 1) << 2 * i for i in range(I.BITS))


def test_places_are_shares_of_rows(spark, bars):
    got = {r.symbol: r.p for r in I.places(bars, "symbol", "p").collect()}
    total = 96 * 512
    assert got["HOT"] == 0
    assert all(got[f"S{i:02d}"] == int((32 + i) * 512 / total * (1 << I.BITS)) for i in range(64))


def test_both_lookups_skip(spark, bars):
    path = _new(spark)
    I.interleaved(bars, files=256).write.parquet(path)
    t = spark.read.parquet(path)
    assert t.count() == bars.count() and t.exceptAll(bars).count() == 0
    total = bars.count()                              # each lookup reads a 16th or less
    by_symbol, by_date = t.where("symbol = 'S40'"), t.where("trade_date = DATE'2020-09-01'")
    assert by_symbol.count() == 512 and by_date.count() == 96
    read = rows_scanned(by_symbol), rows_scanned(by_date)
    assert 512 <= read[0] <= total / 10 and 96 <= read[1] <= total / 10, read
    assert rows_scanned(bars) == total
    sizes = [r["count"] for r in t.groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) <= 4 * total / 256              # the hot symbol is cut too


def test_nulls_ties_and_no_rows(spark):
    rows = [(None, None, 1), ("A", None, 2), (None, "2020-01-02", 3), ("A", "2020-01-02", 4), ("A", "2020-01-02", 4)]
    df = spark.createDataFrame(rows, "symbol string, d string, v int").select(
        "symbol", F.col("d").cast("date").alias("trade_date"), "v")
    assert sorted(r.v for r in I.interleaved(df, files=3).collect()) == [1, 2, 3, 4, 4]
    assert I.interleaved(df.where("v > 9")).count() == 0
    assert I.interleaved(df).rdd.getNumPartitions() == 1


def test_published_name_keeps_rows_until_the_new_ones_are_there(spark):
    name, base = f"tickwise_{uuid.uuid4().hex}", _new(spark)
    m = Models(spark, SF_SMALL)
    J.materialise(spark, m.stg_bars, name, "table", path=base + "/a")
    n = spark.table(name).count()
    J.materialise(spark, spark.table(name), name, "interleaved", path=base + "/b", files=4)
    assert spark.table(name).count() == n and len(J.versions_of(spark, name)) == 1
    J.forget(spark, name)
    assert not spark.catalog.tableExists(name) and not J.versions_of(spark, name)


def test_lookups_query(spark):
    m = Models(spark, SF_SMALL)
    got = {(r.lookup, r.symbol, r.trade_date) for r in Jq.interleaved_lookups(m).collect()}
    fact = [(r.symbol, r.trade_date) for r in m.fact.select("symbol", "trade_date").collect()]
    first, last = min(s for s, _ in fact), max(d for _, d in fact)
    assert got == {("symbol", s, d) for s, d in fact if s == first} | {("date", s, d) for s, d in fact if d == last}

"""Jobs with side effects: publishing, load modes, streaming upsert."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tickwise.plans import ingest_queries as Iq, job_queries as Jq
from tickwise.plans.context import Models


def test_stream_ingest_later_fetch_wins(spark):
    m = Models(spark, SF_SMALL)
    got = Jq.stream_ingest(m)
    raw = m.raw_bars.select("symbol", "trade_date", F.col("adj_close").alias("raw_adj"))
    j = got.join(raw, ["symbol", "trade_date"])
    assert got.count() == m.raw_bars.count() == j.count()
    late = F.col("trade_date") >= F.lit(Iq.CUT_SECOND).cast("date")
    bad = j.where((late & (F.col("adj_close") != F.col("raw_adj") * 4))
                  | (~late & (F.col("adj_close") != F.col("raw_adj"))))
    assert bad.count() == 0


def test_reload_is_idempotent(spark):
    m = Models(spark, SF_SMALL)
    out = {r.table_name: r.rows for r in Jq.ingest_modes(m).collect()}
    assert out == {"assets": m.raw_assets.count(), "prices": m.raw_bars.count(),
                   "macro": m.raw_macro.count()}


def test_corrupt_lines_quarantined_not_fatal(spark):
    m = Models(spark, SF_SMALL)
    rows = Jq.corrupt_file_quarantine(m).agg(F.sum("rows_ok").alias("ok"),
                                             F.sum("rows_corrupt").alias("bad")).collect()[0]
    n_bad = m.raw_bars.where(F.col("volume") % 13 == 0).count()
    assert rows.bad == n_bad and rows.ok == m.raw_bars.count() - n_bad


def test_sink_table_partitioned_by_year(spark):
    m = Models(spark, SF_SMALL)
    out = Jq.sink_tables(m)
    rows = {r.table_name: r.n for r in out.groupBy("table_name").agg(F.sum("rows").alias("n")).collect()}
    want = {"price_fact": m.fact.count(), "asset_dim": m.asset_dim.count(),
            "risk_mart": m.risk_mart.count(), "correlation_mart": m.correlation_mart.count()}
    assert rows == {name: n for name, n in want.items() if n}    # an empty table has no year


def test_quality_results_appended_per_run(spark):
    import os
    from tickwise.operators import quality as Qy
    from tickwise.plans import jobs as J
    from tickwise.session import checkpoint_dir
    import uuid
    m = Models(spark, SF_SMALL)
    res = Qy.run_expectations(m.suite_tables(), Qy.EXPECTATIONS)
    path = os.path.join(checkpoint_dir(spark), "tickwise_test", uuid.uuid4().hex)
    a = J.store_quality_results(res, path)
    b = J.store_quality_results(res, path)
    stored = spark.read.parquet(path)
    assert {r.run_id for r in stored.select("run_id").distinct().collect()} == {a, b}
    assert stored.count() == 2 * len(Qy.EXPECTATIONS)


def test_micro_batch_replay_is_idempotent(spark):
    import datetime as dt
    import os
    import uuid
    from tickwise.session import checkpoint_dir
    from tickwise.streaming import ingest as SI
    base = os.path.join(checkpoint_dir(spark), "tickwise_test", uuid.uuid4().hex)
    from pyspark.sql import types as T
    schema = T.StructType(SI.STREAM_SCHEMA.fields + [T.StructField("file_path", T.StringType())])
    rows = [("AAA", dt.date(2020, 1, 2), 1.0, 2.0, 0.5, 1.5, 1.4, 100.0, 1, None, "f1"),
            ("AAA", dt.date(2020, 1, 2), 1.0, 2.0, 0.5, 1.5, 1.6, 100.0, 2, None, "f2"),
            ("AAA", dt.date(2020, 1, 3), -1.0, 2.0, 0.5, 1.5, 1.4, 100.0, 1, None, "f1"),
            (None, None, None, None, None, None, None, None, None, "{bad", "f1")]
    batch = spark.createDataFrame(rows, schema)
    fn = SI.process_batch(spark, base + "/bars", base + "/q")
    fn(batch, 7)
    first = (sorted(spark.read.parquet(base + "/bars").collect()),
             sorted(spark.read.parquet(base + "/q").collect()))
    fn(batch, 7)
    again = (sorted(spark.read.parquet(base + "/bars").collect()),
             sorted(spark.read.parquet(base + "/q").collect()))
    assert first == again
    bars = first[0]
    assert len(bars) == 1 and bars[0].adj_close == 1.6          # later fetch wins
    assert sorted(r.reason for r in first[1]) == ["corrupt_record", "open_not_positive"]


def test_upsert_rewrites_only_touched_years(spark):
    import glob
    import os
    import uuid
    from tests.fixtures import bars
    from tickwise.operators import upsert as U
    from tickwise.plans import jobs as J
    from tickwise.session import checkpoint_dir
    path = os.path.join(checkpoint_dir(spark), "tickwise_test", uuid.uuid4().hex)
    first = bars(spark, [("AAA", "2019-05-02", 10), ("AAA", "2020-05-04", 11), ("BBB", "2020-05-04", 5)])
    J.upsert_into(spark, path, first, U.BAR_KEYS, U.BAR_UPDATES, "trade_date")
    before = {f: os.path.getmtime(f) for f in glob.glob(path + "/year=2019/*.parquet")}
    batch = bars(spark, [("AAA", "2020-05-04", 12), ("CCC", "2020-05-05", 7)])
    J.upsert_into(spark, path, batch, U.BAR_KEYS, U.BAR_UPDATES, "trade_date")
    after = {f: os.path.getmtime(f) for f in glob.glob(path + "/year=2019/*.parquet")}
    assert before and before == after          # the untouched year kept its files
    rows = {(r.symbol, str(r.trade_date)): r.adj_close for r in spark.read.parquet(path).collect()}
    assert rows == {("AAA", "2019-05-02"): 10.0, ("AAA", "2020-05-04"): 12.0,
                    ("BBB", "2020-05-04"): 5.0, ("CCC", "2020-05-05"): 7.0}


def test_published_files_are_sorted(spark):
    import glob
    import os
    import uuid
    import pyarrow.parquet as pq
    from tickwise.plans import jobs as J
    from tickwise.session import checkpoint_dir
    path = os.path.join(checkpoint_dir(spark), "tickwise_test", uuid.uuid4().hex)
    J.publish(Models(spark, SF_SMALL).raw_bars, path)
    files = glob.glob(path + "/year=*/*.parquet")
    assert files
    for f in files:
        t = pq.read_table(f, columns=["symbol", "trade_date"]).to_pylist()
        keys = [(r["symbol"], r["trade_date"]) for r in t]
        assert keys == sorted(keys)


def test_load_keeps_one_row_a_key(spark):
    import os
    import uuid
    from tests.fixtures import bars
    from tickwise.operators import upsert as U
    from tickwise.plans import jobs as J
    from tickwise.session import checkpoint_dir
    rows = bars(spark, [("AAA", "2020-05-04", 11), ("AAA", "2020-05-04", 12), ("BBB", "2020-05-04", 5)])
    one = J.deduped(rows, U.BAR_KEYS, U.BAR_UPDATES)
    assert one.columns == rows.columns and one.count() == 2
    seq = rows.withColumn("batch_seq", -F.col("adj_close"))
    got = {r.symbol: r.adj_close for r in J.deduped(seq, U.BAR_KEYS, U.BAR_UPDATES).collect()}
    assert got == {"AAA": 11.0, "BBB": 5.0}         # the last by sequence wins


def test_only_a_missing_table_is_no_table(spark, monkeypatch):
    import os
    import uuid
    import pytest
    from tickwise.plans import jobs as J
    from tickwise.session import checkpoint_dir
    path = os.path.join(checkpoint_dir(spark), "tickwise_test", uuid.uuid4().hex)
    assert J.table_exists(spark, path) is False
    os.makedirs(path)
    assert J.table_exists(spark, path) is False

    class Denied:
        @property
        def read(self):
            raise PermissionError("denied")
    with pytest.raises(PermissionError):
        J.table_exists(Denied(), path)


def _epochs(spark, order):
    import datetime as dt
    import os
    import uuid
    from pyspark.sql import types as T
    from tickwise.session import checkpoint_dir
    from tickwise.streaming import ingest as SI
    base = os.path.join(checkpoint_dir(spark), "tickwise_test", uuid.uuid4().hex)
    schema = T.StructType(SI.STREAM_SCHEMA.fields + [T.StructField("file_path", T.StringType())])
    rows = {at: ("AAA", dt.date(2020, 1, 2), 1.0, 2.0, 0.5, 1.5, price, 100.0, at, None, f"f{at}")
            for at, price in ((1, 1.0), (2, 2.0), (3, 3.0))}
    fn = SI.process_batch(spark, base + "/bars", base + "/q")
    for epoch, fetches in enumerate(order):
        fn(spark.createDataFrame([rows[f] for f in fetches], schema), epoch)
    # the rows now have a load time, which differs from one load to the next
    return spark.read.parquet(base + "/bars").drop("loaded_at").collect()


def test_older_fetch_never_wins_however_batches_are_cut(spark):
    one = _epochs(spark, [[1, 2, 3]])
    assert len(one) == 1 and one[0].adj_close == 3.0
    assert _epochs(spark, [[3], [1], [2]]) == one
    assert _epochs(spark, [[2, 3], [1]]) == one


def test_parse_rejects_reach_the_quarantine_table(spark):
    import os
    import uuid
    from tickwise.plans import jobs as J
    from tickwise.session import checkpoint_dir
    from tickwise.sources import landing as Ld
    docs = spark.createDataFrame(
        [("cdi", '[{"data": "02/01/2020", "valor": "1"}, {"data": "x", "valor": "1"}]'),
         ("igpm", "not json"), ("usd_brl", "[]")], "series string, doc string")
    nested = spark.createDataFrame([("{",), ('[{"resultados": []}]',)], "doc string")
    daily, monthly = Ld.parse_daily_series(docs), Ld.parse_nested_series(nested)
    rejects = Ld.macro_rejects(daily).unionByName(Ld.macro_rejects(monthly))
    out = os.path.join(checkpoint_dir(spark), "tickwise_test", uuid.uuid4().hex)
    got = J.run_load(spark, out, None, Ld.macro_records(daily), None, only="macro",
                     parse_rejects=rejects).collect()
    assert [(r.table_name, r.rows) for r in got] == [("macro", 1)]
    assert spark.read.parquet(out + "/macro").where("loaded_at IS NULL").count() == 0
    q = spark.read.parquet(out + "/quarantine").collect()
    assert sorted((r.record_key, r.reason) for r in q) == [
        ("x|cdi", "bad_date"), ("|igpm", "bad_document"),
        ("|ipca", "bad_document"), ("|ipca", "bad_document")]


def test_failed_publish_leaves_the_earlier_table(spark):
    import os
    import uuid
    import pytest
    from tickwise.plans import jobs as J
    from tickwise.session import checkpoint_dir
    base = os.path.join(checkpoint_dir(spark), "tickwise_test", uuid.uuid4().hex)
    name = "tickwise_t_" + uuid.uuid4().hex
    J.materialise(spark, spark.range(3), name, date_col=None, path=base + "/a")
    with pytest.raises(Exception):
        J.materialise(spark, spark.range(5).select(F.raise_error(F.lit("stop")).cast("int").alias("id")),
                      name, date_col=None, path=base + "/b")
    assert spark.table(name).count() == 3
    J.forget(spark, name)


def test_every_rejection_rule_is_met(spark):
    from tickwise.plans import registry as Rg
    fn, _ = Rg.QUERIES["quarantine_reasons"]
    got = {(r.entity, r.reason) for r in fn(Models(spark, "/root/testdata/sf0.01"))
           .select("entity", "reason").distinct().collect()}
    assert {e for e, _ in got} == {"bars", "macro", "assets"}
    assert {r for _, r in got} >= {"empty_symbol", "missing_date", "open_nan", "open_not_positive",
                                   "close_nan", "close_not_positive", "high_below_low", "volume_nan",
                                   "empty_series", "missing_value", "bad_kind", "missing_symbol"}


def test_load_reads_watermarks_and_leaves_no_copies(spark):
    """The second load takes its start from the watermark table, which holds
    the last stored date of each symbol; intermediate copies are gone."""
    import glob
    import os
    import uuid

    from pyspark.sql.types import StructType

    from tickwise.plans import jobs as J
    from tickwise.session import checkpoint_dir
    from tickwise.sources import landing as Ld

    m = Models(spark, SF_SMALL)
    base = checkpoint_dir(spark)
    out = os.path.join(base, "tickwise_test", uuid.uuid4().hex)
    copies = base.removeprefix("file://") + "/tickwise_stored/*"
    bars = Ld.ingest_bars(Iq.api_frame(m.raw_bars))
    none = spark.createDataFrame([], StructType(m.raw_macro.schema.fields))
    before = set(glob.glob(copies))
    early = bars.where("trade_date < '1996-01-01'")
    J.run_load(spark, out, early, none, m.raw_assets, only="prices")
    J.run_load(spark, out, bars, none, m.raw_assets, only="prices", start_date="1990-01-01")
    assert set(glob.glob(copies)) == before
    table = spark.read.parquet(os.path.join(out, "prices"))
    assert table.count() == m.raw_bars.count()
    want = {r.symbol: r.last for r in table.groupBy("symbol").agg(F.max("trade_date").alias("last")).collect()}
    marks = J.bar_watermarks(spark, out)
    assert {r.symbol: r.last_date for r in marks.collect()} == want
    # Rows before a symbol's watermark are not loaded again.
    old = bars.where("trade_date < '1995-01-01'").withColumn("close", F.lit(-1.0)).withColumn("low", F.lit(-1.0))
    J.run_load(spark, out, old, none, m.raw_assets, only="prices", start_date="1990-01-01")
    again = spark.read.parquet(os.path.join(out, "prices"))
    assert again.count() == table.count() and again.where("close < 0").count() == 0

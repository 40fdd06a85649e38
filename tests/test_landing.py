"""Landed-source readers and parsers on small written files and strings."""

import os
import tempfile


from tests.fixtures import d
from tickwise.sources import landing as Ld


def _scratch():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def test_read_landed_csv_and_json_quarantine_bad_lines(spark):
    base = _scratch()
    csv = os.path.join(base, "csv")
    os.makedirs(csv)
    with open(os.path.join(csv, "a.csv"), "w") as f:
        f.write("symbol,Date,Open,High,Low,Close,Adj Close,Volume\n")
        f.write("AAA,2020-01-02,1,2,0.5,1.5,1.4,100\n")
        f.write("AAA,not-a-date,1,2,0.5,1.5,1.4,100\n")
    df = Ld.read_landed_bars(spark, csv, "csv")
    rows = df.collect()
    assert len(rows) == 2
    assert sum(r["_corrupt_record"] is not None for r in rows) == 1
    js = os.path.join(base, "json")
    os.makedirs(js)
    with open(os.path.join(js, "a.json"), "w") as f:
        f.write('{"symbol": "AAA", "Date": "2020-01-02", "Close": 1.5}\n{"symbol": "A\n')
    rows = Ld.read_landed_bars(spark, js, "json").select("symbol", "_corrupt_record").collect()
    assert sorted(r.symbol is None for r in rows) == [False, True]


def test_json_number_values_and_units(spark):
    doc = '[{"data": "02/01/2020", "valor": 5.25}, {"data": "3/1/2020", "valor": "5,5"}]'
    docs = spark.createDataFrame([("usd_brl", doc)], "series string, doc string")
    rows = sorted(Ld.macro_records(Ld.parse_daily_series(docs)).collect())
    assert [(r.obs_date, r.value, r.unit) for r in rows] == [
        (d("2020-01-02"), 5.25, "BRL"), (d("2020-01-03"), 5.5, "BRL")]


def test_unparseable_document_is_one_reason_row(spark):
    docs = spark.createDataFrame([("cdi", "not json")], "series string, doc string")
    rows = Ld.parse_daily_series(docs).collect()
    assert [r.reason for r in rows] == ["bad_document"]


def test_asset_metadata_fallbacks(spark):
    config = spark.createDataFrame([("AAA", "", None, None), ("BBB", "Bee", "Tech", "ETF"), ("CCC", None, "", "ACAO")],
                                   "symbol string, name string, sector string, kind string")
    info = spark.createDataFrame([("AAA", "Aaa Corp", "Energy", "Oil", "USD")],
                                 "symbol string, long_name string, info_sector string, industry string, info_currency string")
    out = {r.symbol: r for r in Ld.asset_metadata(config, info).collect()}
    assert (out["AAA"].name, out["AAA"].sector, out["AAA"].kind, out["AAA"].currency) == ("Aaa Corp", "Energy", "ACAO", "USD")
    assert (out["BBB"].name, out["BBB"].sector, out["BBB"].kind) == ("Bee", "Tech", "ETF")
    assert (out["CCC"].name, out["CCC"].sector, out["CCC"].currency) == ("CCC", None, "BRL")


def test_date_formats(spark):
    df = spark.createDataFrame([(d("2020-03-05"),)], "x date")
    r = df.select(Ld.to_source_date("x").alias("a"), Ld.to_period("x").alias("b")).collect()[0]
    assert (r.a, r.b) == ("05/03/2020", "202003")


def test_ingest_range_is_end_exclusive(spark):
    f = spark.createDataFrame([("AAA", d("2020-01-0" + str(i)), 1.0) for i in (1, 2, 3)],
                              "symbol string, Date date, Close double")
    out = Ld.ingest_bars(f, "2020-01-02", "2020-01-03").collect()
    assert [r.trade_date for r in out] == [d("2020-01-02")]


def test_ingest_symbol_list(spark):
    from pyspark.sql import functions as F
    f = spark.createDataFrame([(s, d("2020-01-02"), 1.0) for s in ("AAA", "BBB", "CCC")],
                              "symbol string, Date date, Close double")
    lst = spark.createDataFrame([("AAA, CCC",)], "s string").select(
        Ld.parse_symbol_list(F.col("s")).alias("l")).first().l
    assert sorted(r.symbol for r in Ld.ingest_bars(f, symbols=lst).collect()) == ["AAA", "CCC"]


def test_damaged_parquet_file_stops_no_other(spark):
    base = _scratch()
    good = spark.createDataFrame([("AAA", d("2020-01-02"), 1.5)], "symbol string, Date date, Close double")
    good.coalesce(1).write.parquet(os.path.join(base, "AAA"))
    os.makedirs(os.path.join(base, "BBB"))
    bad = os.path.join(base, "BBB", "part-0.parquet")
    with open(bad, "wb") as f:
        f.write(b"PAR1 cut short")
    path = os.path.join(base, "*")
    assert [r.symbol for r in Ld.read_landed_bars(spark, path).collect()] == ["AAA"]
    lost = Ld.rowless_files(spark, path).collect()
    assert [(r.entity, r.record_key, r.reason) for r in lost] == [("bars", f"file://{bad}", "no_rows")]


def test_parquet_file_that_loses_rows_is_quarantined(spark):
    base = _scratch()
    rows = [("AAA", d("2020-01-02"), float(i)) for i in range(60_000)]
    schema = "symbol string, Date date, Close double"
    for name in ("A^1", "B"):
        (spark.createDataFrame(rows, schema).coalesce(1).write.option("compression", "snappy")
         .option("parquet.enable.dictionary", "false").option("parquet.page.row.count.limit", "5000")
         .parquet(os.path.join(base, name)))
    empty = os.path.join(base, "C")
    spark.createDataFrame([], schema).coalesce(1).write.parquet(empty)
    folder = os.path.join(base, "B")
    for f in os.listdir(folder):
        if f.endswith(".crc"):
            os.remove(os.path.join(folder, f))
    (bad,) = [os.path.join(folder, f) for f in os.listdir(folder) if f.endswith(".parquet")]
    with open(bad, "r+b") as f:         # late in the data, the footer stays whole
        f.seek(os.path.getsize(bad) * 3 // 4)
        f.write(b"\xff" * 2_000)
    path = os.path.join(base, "*")
    files = {os.path.basename(os.path.dirname(r.file)): (r.rows_footer, r.rows_read)
             for r in Ld.landed_files(spark, path).collect()}
    assert files["A%5E1"] == (60_000, 60_000) and files["C"] == (0, 0)
    assert files["B"][0] == 60_000 > files["B"][1]
    lost = {(r.record_key.split("/")[-2], r.reason) for r in Ld.damaged_files(spark, path).collect()}
    assert lost == {("B", "rows_lost"), ("C", "no_rows")}
    assert Ld.read_landed_bars(spark, path).count() == 60_000
    whole = os.path.join(base, "A^1")
    assert Ld.damaged_files(spark, whole).count() == 0
    assert Ld.read_landed_bars(spark, whole).count() == 60_000

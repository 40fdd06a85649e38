"""The ledger of landed files, and tables that a failed load leaves whole."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tickwise.plans import ingest_queries as Iq, jobs as J, versions as V
from tickwise.plans.context import Models
from tickwise.session import stored
from tickwise.sources import landing as Ld
from tickwise.sources.ledger import Ledger


def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture(scope="module")
def frame(spark):
    return stored(Iq.api_frame(Models(spark, SF_SMALL).raw_bars).where("symbol < 'BRAND20'"), "frame")


def land(frame, path, symbols):
    frame.where(F.col("symbol").isin(symbols)).repartition("symbol").write.mode("append").parquet(path)


def damage(path, name, data=b"PAR1 cut short"):
    with open(os.path.join(path, name), "wb") as f:
        f.write(data)


def drain(ledger, landing):
    """Take and commit everything; the rows by symbol."""
    got = {}
    for taken in ledger.take(landing):
        for r in taken.rows.groupBy("symbol").count().collect():
            got[r.symbol] = got.get(r.symbol, 0) + r["count"]
        ledger.commit(taken)
    return got


def verdicts(ledger):
    return {os.path.basename(r.file): (r.verdict, r.tries) for r in ledger.entries().collect()}


def test_files_add_up(spark, frame):
    """Loaded, waiting and quarantined files are all that landed; each row of a
    sound file is handed out once, over batches and later landings."""
    landing, ledger = folder(), Ledger(spark, folder() + "/ledger", attempts=2, batch_files=2)
    land(frame, landing, ["BRAND11", "BRAND12"])
    land(frame, landing, ["BRAND13"])
    damage(landing, "bad.parquet")
    want = {r.symbol: r["count"] for r in frame.groupBy("symbol").count().collect()}
    assert drain(ledger, landing) == {s: want[s] for s in ("BRAND11", "BRAND12", "BRAND13")}
    assert verdicts(ledger)["bad.parquet"] == ("waiting", 1)
    land(frame, landing, ["BRAND14"])
    assert drain(ledger, landing) == {"BRAND14": want["BRAND14"]}
    assert verdicts(ledger)["bad.parquet"] == ("quarantined", 2)
    assert [r.reason for r in ledger.quarantine().collect()] == ["no_rows"]
    assert drain(ledger, landing) == {}
    names = {f for f in os.listdir(landing) if f.endswith(".parquet")}
    assert names == set(verdicts(ledger))


def test_a_passing_error_is_tried_again(spark, frame, monkeypatch):
    """A file of which a read loses rows waits and is loaded whole later, never
    in part; within one load it is read twice before that."""
    landing, ledger = folder(), Ledger(spark, folder() + "/ledger", attempts=5)
    land(frame, landing, ["BRAND11"])
    land(frame, landing, ["BRAND12"])
    want = {r.symbol: r["count"] for r in frame.groupBy("symbol").count().collect()}
    sound, calls = Ledger._stage, []

    def losing(times):
        def stage(self, paths, *args):
            df = sound(self, paths, *args)
            calls.append(len(paths))
            return df.where("symbol <> 'BRAND12' OR xxhash64(Date) % 2 = 0") if len(calls) <= times else df
        return stage

    with monkeypatch.context() as p:
        p.setattr(Ledger, "_stage", losing(2))
        assert drain(ledger, landing) == {"BRAND11": want["BRAND11"]}
    assert sorted(v for v, _ in verdicts(ledger).values()) == ["loaded", "waiting"]
    calls.clear()
    with monkeypatch.context() as p:
        p.setattr(Ledger, "_stage", losing(1))
        assert drain(ledger, landing) == {"BRAND12": want["BRAND12"]}
    assert calls == [1, 1]
    assert {v for v, _ in verdicts(ledger).values()} == {"loaded"}


def test_a_changed_file_is_new(spark, frame):
    landing, ledger = folder(), Ledger(spark, folder() + "/ledger", attempts=1)
    damage(landing, "x.parquet")
    assert drain(ledger, landing) == {}
    other = folder()
    land(frame, other, ["BRAND11"])
    name, = [f for f in os.listdir(other) if f.endswith(".parquet")]
    with open(os.path.join(other, name), "rb") as f:
        damage(landing, "x.parquet", f.read())
    assert set(drain(ledger, landing)) == {"BRAND11"}
    assert sorted(r.verdict for r in ledger.entries().collect()) == ["loaded", "quarantined"]


def test_load_from_landed_files(spark, frame, monkeypatch):
    """Uncommitted batches are taken again; quarantined files reach the
    quarantine table; the stored rows are those of the sound files."""
    m = Models(spark, SF_SMALL)
    out, landing = folder(), folder()
    land(frame, landing, ["BRAND11", "BRAND12"])
    damage(landing, "bad.parquet")
    load = lambda: J.load_landed(spark, out, landing, m.raw_macro.limit(0), m.raw_assets, attempts=1, only="prices")
    with monkeypatch.context() as p:
        p.setattr(Ledger, "commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            load()
    got = {os.path.basename(r.file): r.verdict for r in load().collect()}
    assert got.pop("bad.parquet") == "quarantined" and set(got.values()) == {"loaded"}
    want = frame.where(F.col("symbol").isin("BRAND11", "BRAND12"))
    keys = spark.read.parquet(out + "/prices").select("symbol", "trade_date")
    assert keys.count() == keys.distinct().count() == Ld.ingest_bars(want).select("symbol", "trade_date").distinct().count()
    aside = spark.read.parquet(out + "/quarantine").where("reason = 'no_rows'")
    assert aside.count() >= 1


def test_failed_load_leaves_the_assets(spark, monkeypatch):
    """A load that fails while it writes the assets, or is cut between the two
    renames, loses no row of the table stored before."""
    m = Models(spark, SF_SMALL)
    out = folder()
    load = lambda: J.run_load(spark, out, m.raw_bars, m.raw_macro, m.raw_assets, only="assets")
    load()
    rows = sorted(r.symbol for r in spark.read.parquet(out + "/assets").collect())
    bad = m.raw_assets.withColumn("name", F.when(F.col("symbol") > "A", F.raise_error(F.lit("lost executor"))))
    with pytest.raises(Exception, match="lost executor"):
        J.run_load(spark, out, m.raw_bars, m.raw_macro, bad, only="assets")
    assert sorted(r.symbol for r in spark.read.parquet(out + "/assets").collect()) == rows
    os.rename(out + "/assets", out + "/assets.old-1")
    V.restore(spark, out + "/assets")
    assert sorted(r.symbol for r in spark.read.parquet(out + "/assets").collect()) == rows
    load()
    assert sorted(r.symbol for r in spark.read.parquet(out + "/assets").collect()) == rows
    assert not [f for f in os.listdir(out) if f.startswith("assets.old")]


def test_batch_and_stream_share_a_table(spark):
    """In either order: the batch's values overwrite, a streamed fetch
    overwrites a batch's and an older fetch's, all rows have a load time, and
    an older fetch that comes after all is left out."""
    import datetime as dt
    from pyspark.sql import types as T
    from tickwise.streaming import ingest as SI
    schema = T.StructType(SI.STREAM_SCHEMA.fields + [T.StructField("file_path", T.StringType())])

    def stream(out, adj, fetched, days=(2, 3), epoch=1):
        rows = [("AAA", dt.date(2020, 1, d), 1.0, 2.0, 0.5, 1.5, adj, 100.0, fetched, None, f"f{fetched}") for d in days]
        SI.process_batch(spark, out + "/prices", out + "/q")(spark.createDataFrame(rows, schema), epoch)

    def batch(out, adj, days=(3, 4)):
        bars = spark.createDataFrame([("AAA", dt.date(2020, 1, d), 1.0, 2.0, 0.5, 1.5, adj, 100) for d in days],
                                     "symbol string, trade_date date, open double, high double, low double, "
                                     "close double, adj_close double, volume bigint")
        bars = bars.withColumn("volume_raw", F.col("volume").cast("double")).withColumn("source", F.lit("batch"))
        J.run_load(spark, out, bars, None, None, mode="full", only="prices")

    def state(out):
        rows = spark.read.parquet(out + "/prices").collect()
        assert all(r.loaded_at is not None for r in rows)
        return {r.trade_date.day: (r.adj_close, r.source) for r in rows}

    out = folder()
    batch(out, 1.1)
    stream(out, 1.4, 5)
    assert state(out) == {2: (1.4, "yahoo_finance"), 3: (1.4, "batch"), 4: (1.1, "batch")}
    stream(out, 1.2, 4, epoch=2)
    assert state(out)[3] == (1.4, "batch")
    other = folder()
    stream(other, 1.4, 5)
    batch(other, 1.1)
    assert state(other) == {2: (1.4, "yahoo_finance"), 3: (1.1, "yahoo_finance"), 4: (1.1, "batch")}
    stream(other, 1.2, 4, epoch=2)
    assert state(other)[3] == (1.1, "yahoo_finance")
    stream(other, 1.9, 6, epoch=3)
    assert state(other)[3][0] == 1.9

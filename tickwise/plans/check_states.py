"""Checks over a growing history (X1-X11, T1-T4), from mergeable states by year.

A year's state holds, for each check, its counts (elements, unexpected), for a
standard deviation n, mean and squared distance from it, and, for tests on
values, the values themselves: those that are not accepted, and a 64-bit hash
of each value that must be unique. States of years add up to the state of the
table, so a checkpoint after a load reads the rows of the changed years alone.

A key that names the date can't repeat over years, so its repeats are counted
in each year. Other unique values meet their own hash in another year first;
only if any do are the values behind those hashes read and compared.

States are written to new folders, which one manifest names (``versions``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.functions.num import rnd
from tickwise.operators import quality as Qy
from tickwise.plans import versions as V
from tickwise.session import stored

COUNTS = "idx int, elements bigint, unexpected bigint, n bigint, mean double, m2 double, part int"
VALUES = "idx int, value string, hash bigint, rows bigint, part int"
COMPOUND = "expect_compound_columns_to_be_unique"
STDEV = "expect_column_stdev_to_be_between"


class CheckStates:
    """The states of one table's checks below ``base``: a suite's expectations
    and declarative tests. ``date_col`` gives a row's year (0 where NULL); a
    table stored by year gives it by its column ``year``, which prunes."""

    def __init__(self, spark: SparkSession, base: str, date_col: str,
                 expectations: list[Qy.Expectation] = (), tests: list[Qy.Test] = ()):
        self.spark, self.base, self.date_col = spark, base.rstrip("/"), date_col
        self.expectations, self.tests = list(expectations), list(tests)
        for e in self.expectations:
            if e.etype == COMPOUND and date_col not in e.kw("column_list"):
                raise ValueError(f"{e.kw('column_list')} may repeat over years: name {date_col} in it or test one column")

    def _part(self, df: DataFrame) -> DataFrame:
        year = F.col("year") if "year" in df.columns else F.year(self.date_col)
        return df.withColumn("part", F.coalesce(year.cast("int"), F.lit(0)))

    def update(self, df: DataFrame, years: list[int] | None = None) -> None:
        """Compute the states of ``years`` anew (None: of every year in ``df``,
        and no others stay); a year without rows has an empty state. Reads
        ``df`` up to three times: counts, values, keys."""
        wanted = df
        if years is not None:
            year = F.col("year") if "year" in df.columns else F.year(self.date_col)
            known = year.isin([y for y in years if y])
            wanted = df.where(known | year.isNull() if 0 in years else known)
        x = self._part(wanted)
        folder = V.new_folder(self.base, "states")
        counts, values = self._counts(x), self._values(x)
        self._write(counts, f"{folder}/counts", COUNTS)
        self._write(values, f"{folder}/values", VALUES)
        if years is None:
            years = [r.part for r in self._read([folder], "counts", COUNTS).select("part").distinct().collect()]
            old = {}
        else:
            old = self._manifest()["years"]
        V.write_manifest(self.spark, self.base, {"years": {**old, **{str(y): folder for y in years}}})

    def _write(self, parts: list[DataFrame], path: str, schema: str) -> None:
        frame = reduce(DataFrame.unionByName, parts, self.spark.createDataFrame([], schema))
        frame.write.partitionBy("part").parquet(path)

    def _manifest(self) -> dict:
        return V.read_manifest(self.spark, self.base) or {"years": {}}

    def _read(self, folders: list[str], kind: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*[f"{f}/{kind}" for f in folders])

    def state(self, kind: str) -> DataFrame:
        """The state rows ('counts' or 'values') of every year, each from the
        folder that the manifest names for it."""
        schema = {"counts": COUNTS, "values": VALUES}[kind]
        by_folder: dict[str, list[int]] = {}
        for year, folder in self._manifest()["years"].items():
            by_folder.setdefault(folder, []).append(int(year))
        frames = [self._read([f], kind, schema).where(F.col("part").isin(ys)) for f, ys in sorted(by_folder.items())]
        return reduce(DataFrame.unionByName, frames, self.spark.createDataFrame([], schema))

    def _counts(self, x: DataFrame) -> list[DataFrame]:
        """Counts by year: every row-level check in one aggregate, whose result
        has one row a year; compound keys in one more each."""
        dtypes, none = dict(x.dtypes), F.lit(None)
        aggs, items = [], []

        def item(idx, elements, unexpected, n=none, mean=none, m2=none):
            items.append(F.struct(F.lit(idx).alias("idx"), elements.cast("bigint").alias("elements"),
                                  unexpected.cast("bigint").alias("unexpected"), n.cast("bigint").alias("n"),
                                  mean.cast("double").alias("mean"), m2.cast("double").alias("m2")))

        out = []
        for i, e in enumerate(self.expectations):
            if e.etype == COMPOUND:
                cols = e.kw("column_list")
                some = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in cols])
                keys = x.where(some).groupBy(*dict.fromkeys([*cols, "part"])).agg(F.count(F.lit(1)).alias("c"))
                out.append(keys.groupBy("part").agg(
                    F.sum("c").alias("elements"), F.sum(F.when(F.col("c") > 1, F.col("c")).otherwise(0)).alias("unexpected"))
                    .select(F.lit(i).alias("idx"), "elements", "unexpected", none.cast("bigint").alias("n"),
                            none.cast("double").alias("mean"), none.cast("double").alias("m2"), "part"))
                continue
            elements, unexpected, _ = Qy._row_level(e, dtypes)
            aggs += [elements.alias(f"e{i}"), unexpected.alias(f"u{i}")]
            if e.etype == STDEV:
                c = F.col(e.column).cast("double")
                aggs += [F.avg(c).alias(f"m{i}"), (F.var_pop(c) * F.count(c)).alias(f"q{i}")]
                item(i, F.col(f"e{i}"), F.col(f"u{i}"), F.col(f"e{i}"), F.col(f"m{i}"), F.col(f"q{i}"))
            else:
                item(i, F.col(f"e{i}"), F.col(f"u{i}"))
        for i, t in enumerate(self.tests, len(self.expectations)):
            if t.kind in ("not_null", "expression"):
                aggs.append(Qy._row_count_expr(t).alias(f"u{i}"))
                item(i, none, F.col(f"u{i}"))
        if aggs:
            out.append(x.groupBy("part").agg(*aggs).select("part", F.inline(F.array(*items))))
        return out

    def _values(self, x: DataFrame) -> list[DataFrame]:
        """Values by year, counted: unique ones as hashes, refused ones as they are."""
        tests = [(i, t) for i, t in enumerate(self.tests) if t.kind in ("unique", "accepted_values")]
        if not tests:
            return []
        items = F.array(*[F.struct(F.lit(i).alias("idx"), Qy._tested_value(t).alias("v"),
                                   F.lit(t.kind == "unique").alias("u")) for i, t in tests])
        seen = x.select("part", F.inline(items)).where(F.col("v").isNotNull())
        return [seen.select("part", "idx", F.when(~F.col("u"), F.col("v")).alias("value"),
                            F.xxhash64("v").alias("hash"))
                    .groupBy("part", "idx", "value", "hash").agg(F.count(F.lit(1)).alias("rows"))]

    def expectation_results(self) -> DataFrame:
        """As ``quality.run_expectations`` of the whole table."""
        states = self.state("counts")
        aggs, items = [], []
        for i, e in enumerate(self.expectations):
            mine = F.col("idx") == i
            aggs += [F.coalesce(F.sum(F.when(mine, F.col("elements"))), F.lit(0)).alias(f"e{i}"),
                     F.sum(F.when(mine, F.col("unexpected"))).alias(f"u{i}")]
            observed, unexpected = F.lit(None).cast("double"), F.col(f"u{i}")
            if e.etype == "expect_table_row_count_to_be_between":
                observed = F.col(f"e{i}").cast("double")
            elif e.etype == STDEV:
                # one struct a year: bounded by the calendar
                aggs.append(F.collect_list(F.when(mine & (F.col("n") > 0), F.struct("n", "mean", "m2"))).alias(f"s{i}"))
                observed = rnd(_merged_stddev(f"s{i}"), 6)
            else:
                unexpected = F.coalesce(unexpected, F.lit(0))
            items.append(Qy._exp_row(e, _index(e), F.col(f"e{i}"), unexpected, observed))
        return states.agg(*aggs).select(F.inline(F.array(*items)))

    def test_results(self, table: DataFrame) -> DataFrame:
        """As ``quality.run_tests`` of the whole ``table``, of which only the
        columns of unique tests are read, and only where hashes repeat."""
        first = len(self.expectations)
        rows = [(i, t) for i, t in enumerate(self.tests, first) if t.kind in ("not_null", "expression")]
        parts = []
        if rows:
            one = self.state("counts").agg(*[
                F.coalesce(F.sum(F.when(F.col("idx") == i, F.col("unexpected"))), F.lit(0)).alias(f"c{k}")
                for k, (i, _) in enumerate(rows)])
            parts.append(Qy._unpivot(one, [t for _, t in rows]))
        tests = [(i, t) for i, t in enumerate(self.tests) if t.kind in ("unique", "accepted_values")]
        if tests:
            merged = self.state("values").groupBy("idx", "value", "hash").agg(F.sum("rows").alias("rows"))
            found = stored(merged.where(F.col("value").isNotNull() | (F.col("rows") > 1)), "check_values")
            counts = []
            for i, t in tests:
                mine = found.where(F.col("idx") == i)
                if t.kind == "unique" and not mine.isEmpty():
                    value = F.col(t.column).cast("string")
                    again = (table.select(value.alias("value")).where(F.col("value").isNotNull())
                             .withColumn("hash", F.xxhash64("value")).join(mine.select("hash"), "hash", "left_semi"))
                    mine = again.groupBy("value").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)
                counts.append(mine.agg(F.count(F.lit(1)).alias("c0")).select(
                    F.lit(t.test_id).alias("test_id"), F.lit(t.model).alias("model"), F.lit(t.kind).alias("kind"),
                    F.lit(t.column).alias("column_name"), F.col("c0").alias("failures")))
            parts += counts
        return reduce(DataFrame.unionByName, parts).withColumn("passed", F.col("failures") == 0)


def _index(e: Qy.Expectation) -> int:
    return next((i for i, x in enumerate(Qy.EXPECTATIONS) if x is e), -1)


def _merged_stddev(column: str):
    """Sample deviation from (n, mean, m2) of disjoint parts: distances within
    each, and of each mean from the common one. NULL below two rows."""
    n = F.aggregate(column, F.lit(0).cast("bigint"), lambda a, s: a + s["n"])
    mean = F.aggregate(column, F.lit(0.0), lambda a, s: a + s["mean"] * s["n"]) / F.when(n > 0, n)
    m2 = F.aggregate(column, F.lit(0.0), lambda a, s: a + s["m2"] + s["n"] * (s["mean"] - mean) * (s["mean"] - mean))
    return F.when(n > 1, F.sqrt(m2 / F.when(n > 1, n - 1)))

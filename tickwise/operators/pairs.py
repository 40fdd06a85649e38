"""Pairwise return correlation per year (G1-G6) and its matrix view.

Instead of joining returns to themselves on the date, which emits every
symbol pair for every day and puts a whole day (or year) of pairs in one
task, each (symbol, year) becomes one dense vector of 366 day slots. A
symbol hashes to one of B blocks, each vector is replicated once per block
on the other side, and the key (year, block_a, block_b) spreads a year's
pairs over balanced groups of (T/B)^2 pairs. A group's co-moments are six
masked matrix products (``gram_moments``), in Arrow batches. With
``params.pair_gram`` off they come from a one-pass Welford update over the
aligned slots of each pair, JVM-side in a higher-order function: slower, no
Python worker. The vector of a (symbol, year) holds at most one value per
calendar day because (symbol, date) is unique.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.functions.num import rnd, surrogate_key
from tickwise.params import DEFAULT_PARAMS, Params
from tickwise.session import stored

SLOTS = 366


def pair_returns(fact: DataFrame, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """Non-benchmark rows with a return: (symbol, trade_date, r)."""
    return (fact.where(F.col("simple_return").isNotNull()
                       & (F.col("symbol") != params.benchmark))
                .select("symbol", "trade_date", F.col("simple_return").alias("r")))


def return_years(fact: DataFrame, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """G1: distinct years that have at least one return."""
    return pair_returns(fact, params).select(F.year("trade_date").alias("year")).distinct()


def year_vectors(fact: DataFrame, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """(symbol, year, vec): vec[d] is the return on day-of-year d+1 or NULL."""
    r = pair_returns(fact, params)
    g = (r.groupBy("symbol", F.year("trade_date").alias("year"))
          .agg(F.map_from_entries(F.collect_list(F.struct(
              (F.dayofyear("trade_date") - 1).alias("k"), F.col("r")))).alias("m")))
    return g.select("symbol", "year", F.transform(
        F.sequence(F.lit(0), F.lit(SLOTS - 1)), lambda i: F.try_element_at(F.col("m"), i)).alias("vec"))


def _welford(va: str, vb: str) -> Column:
    """Population co-moments of the aligned non-NULL slots, one pass.

    Same update as the covariance/variance aggregates: a constant series
    leaves its second moment at exactly 0, so its correlation is NULL.
    """
    upd = """
      IF(p.x IS NULL OR p.y IS NULL, acc, named_struct(
        'n', acc.n + 1,
        'mx', acc.mx + (p.x - acc.mx) / (acc.n + 1),
        'my', acc.my + (p.y - acc.my) / (acc.n + 1),
        'cxy', acc.cxy + (p.x - acc.mx) * (p.y - (acc.my + (p.y - acc.my) / (acc.n + 1))),
        'm2x', acc.m2x + (p.x - acc.mx) * (p.x - (acc.mx + (p.x - acc.mx) / (acc.n + 1))),
        'm2y', acc.m2y + (p.y - acc.my) * (p.y - (acc.my + (p.y - acc.my) / (acc.n + 1)))))"""
    init = ("named_struct('n', 0L, 'mx', 0D, 'my', 0D, 'cxy', 0D, 'm2x', 0D, 'm2y', 0D)")
    zipped = f"zip_with({va}, {vb}, (x, y) -> named_struct('x', x, 'y', y))"
    return F.expr(f"aggregate({zipped}, {init}, (acc, p) -> {upd})")


def _corr_from_moments() -> Column:
    """covar_pop / NULLIF(stddev_pop(x) * stddev_pop(y), 0)  (Q3 formula)."""
    n = F.col("n").cast("double")
    cov = F.col("cxy") / n
    den = F.sqrt(F.col("m2x") / n) * F.sqrt(F.col("m2y") / n)
    return F.when(n > 0, cov / F.when(den != 0, den))


def blocked_pairs(df: DataFrame, key: str, group: str, blocks: int,
                  carry: list[str] = (), strict: bool = True) -> DataFrame:
    """All ordered pairs (a, b) of ``key`` values within each ``group`` value,
    with a < b (``strict``) or every (a, b) including a = b, as a blocked
    equi-join: each row hashes to one of ``blocks`` blocks and is replicated
    once per block on the other side, so the join key (group, block_a,
    block_b) spreads one group's pairs over blocks^2 tasks instead of one.
    ``carry`` columns come along as ``<col>_a`` / ``<col>_b``."""
    b = int(blocks)
    v = df.withColumn("_blk", F.pmod(F.xxhash64(key), F.lit(b)).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.lit(b - 1)))
    left = v.select(F.col(key).alias(f"{key}_a"), F.col(group),
                    *[F.col(c).alias(f"{c}_a") for c in carry],
                    F.col("_blk").alias("_ba"), others.alias("_bb"))
    right = v.select(F.col(key).alias(f"{key}_b"), F.col(group).alias("_g"),
                     *[F.col(c).alias(f"{c}_b") for c in carry],
                     F.col("_blk").alias("_bb2"), others.alias("_ba2"))
    cond = ((left[group] == right["_g"]) & (left["_ba"] == right["_ba2"])
            & (left["_bb"] == right["_bb2"]))
    cond = cond & ((left[f"{key}_a"] < right[f"{key}_b"]) if strict
                   else F.lit(True))
    return left.join(right, cond).drop("_g", "_ba", "_bb", "_ba2", "_bb2")


def pair_blocks(vectors: DataFrame, params: Params = DEFAULT_PARAMS) -> int:
    """Blocks for the pair join: the parameter if set, else enough blocks
    that one block holds about ``pair_block_symbols`` symbols, so a task's
    pair count stays bounded as the number of symbols grows. Counting the
    symbols reads the small stored table only."""
    if params.pair_blocks:
        return int(params.pair_blocks)
    n = vectors.select("symbol").distinct().count()
    return max(1, math.ceil(n / params.pair_block_symbols))


def pair_moments(fact: DataFrame, params: Params = DEFAULT_PARAMS,
                 min_obs: int = 1) -> DataFrame:
    """(symbol_a < symbol_b, year, n_obs, corr_raw) for pairs with >= min_obs
    common days."""
    # Both join sides read the vectors: store them once (T x years rows) in
    # the shared checkpoint folder rather than computing the whole fact
    # twice; this also cuts the lineage a lost executor would replay.
    v = stored(year_vectors(fact, params), "pair_vectors")
    j = blocked_pairs(v, "symbol", "year", pair_blocks(v, params), carry=["vec"])
    # The moments come out of a generator: a plain column would be pushed with
    # the filter into the join condition and evaluated there on every ordered
    # candidate, and once more for the result.
    mom = j.select("symbol_a", "symbol_b", "year", F.inline(F.array(_welford("vec_a", "vec_b"))))
    return (mom.where(F.col("n") >= min_obs)
               .select("symbol_a", "symbol_b", "year", F.col("n").alias("n_obs"),
                       _corr_from_moments().alias("corr_raw")))


#: A second moment below this share of its raw sum may be rounding alone.
DOUBTFUL = 1e-9
PAIRS = "symbol_a string, symbol_b string, year int, n_obs bigint, corr_raw double"


def _pair_exact(x: np.ndarray, y: np.ndarray) -> float | None:
    """The correlation of two aligned series, from their deviations: exactly
    no second moment, and none, if one doesn't change."""
    dx, dy = x - x[0], y - y[0]
    dx, dy = dx - dx.mean(), dy - dy.mean()
    if (x == x[0]).all() or (y == y[0]).all():
        return None
    return float(dx @ dy / math.sqrt(dx @ dx) / math.sqrt(dy @ dy))


def gram_block(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Common days and correlation (NaN where there is none) of every row of
    ``a`` with every row of ``b``; NaN entries are days without a value.

    Values are taken from each row's first, so a row that never changes is
    exactly 0. A pair whose second moment is small beside its raw sum of
    squares, as where a row changes outside the common days only, is computed
    again from the two series."""
    def centred(m):
        valid = ~np.isnan(m)
        first = m[np.arange(len(m)), valid.argmax(axis=1)]
        return valid.astype(float), np.where(valid, m - first[:, None], 0.0)

    (ma, xa), (mb, xb) = centred(a), centred(b)
    n = ma @ mb.T
    sx, sy, sxy, sxx, syy = xa @ mb.T, ma @ xb.T, xa @ xb.T, (xa * xa) @ mb.T, ma @ (xb * xb).T
    with np.errstate(divide="ignore", invalid="ignore"):
        vx, vy = sxx - sx * sx / n, syy - sy * sy / n
        corr = (sxy - sx * sy / n) / np.sqrt(vx) / np.sqrt(vy)
    corr[(sxx == 0) | (syy == 0)] = np.nan
    doubt = (n > 0) & (sxx > 0) & (syy > 0) & ((vx <= DOUBTFUL * sxx) | (vy <= DOUBTFUL * syy))
    for i, j in zip(*np.nonzero(doubt)):
        both = ~np.isnan(a[i]) & ~np.isnan(b[j])
        exact = _pair_exact(a[i][both], b[j][both])
        corr[i, j] = np.nan if exact is None else exact
    return n.astype(np.int64), corr


def gram_moments(fact: DataFrame, params: Params = DEFAULT_PARAMS, min_obs: int = 1) -> DataFrame:
    """(symbol_a < symbol_b, year, n_obs, corr_raw) for pairs with >= min_obs
    common days, by block products. A block's vectors are one row, sent to
    each group (year, block, block) that it takes part in."""
    v = stored(year_vectors(fact, params), "pair_vectors")
    b = pair_blocks(v, params)
    block = F.pmod(F.xxhash64("symbol"), F.lit(b)).cast("int")
    blocks = (v.groupBy("year", block.alias("blk"))
               .agg(F.collect_list(F.struct("symbol", "vec")).alias("rows")))
    sides = blocks.select("*", F.explode(F.sequence(F.lit(0), F.lit(b - 1))).alias("other")).select(
        "year", F.least("blk", "other").alias("ba"), F.greatest("blk", "other").alias("bb"), "blk", "rows")

    def products(t: pa.Table) -> pa.Table:
        year = t["year"][0].as_py()
        blocks = {}
        for blk, rows in zip(t["blk"].to_pylist(), t["rows"].combine_chunks()):
            rows = rows.values
            symbols = np.array(rows.field("symbol").to_pylist(), dtype=object)
            blocks[blk] = symbols, rows.field("vec").flatten().to_numpy(zero_copy_only=False).reshape(-1, SLOTS)
        ba, bb = t["ba"][0].as_py(), t["bb"][0].as_py()
        if ba not in blocks or bb not in blocks:   # a block without symbols this year
            return pa.table([[]] * 5, schema=schema)
        (sa, va), (sb, vb) = blocks[ba], blocks[bb]
        n, corr = gram_block(va, vb)
        i, j = np.nonzero(n >= max(min_obs, 1))
        if ba == bb:
            once = sa[i] < sb[j]
            i, j = i[once], j[once]
        a, b = sa[i], sb[j]
        swap = a > b
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        return pa.table([pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array([year] * len(a), pa.int32()),
                         pa.array(n[i, j]), pa.array(corr[i, j], from_pandas=True)], schema=schema)

    schema = pa.schema([("symbol_a", pa.string()), ("symbol_b", pa.string()), ("year", pa.int32()),
                        ("n_obs", pa.int64()), ("corr_raw", pa.float64())])
    return sides.groupBy("year", "ba", "bb").applyInArrow(products, PAIRS)


def _moments(fact: DataFrame, params: Params, min_obs: int) -> DataFrame:
    return (gram_moments if params.pair_gram else pair_moments)(fact, params, min_obs)


def asset_pairs(fact: DataFrame, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """Pairs that share at least one day with returns, per year."""
    return _moments(fact, params, 1).select("symbol_a", "symbol_b", "year")


def correlation_class_col(c="correlation") -> Column:
    """On the rounded value; NULL falls to the last bucket."""
    x = F.col(c)
    return (F.when(x >= 0.7, "alta_positiva").when(x >= 0.3, "moderada_positiva")
             .when(x >= -0.3, "neutra").when(x >= -0.7, "moderada_negativa")
             .otherwise("alta_negativa"))


def diversification_col(c="correlation") -> Column:
    """|corr| < .3 alto, < .6 moderado, else (NULL too) baixo."""
    a = F.abs(F.col(c))
    return F.when(a < 0.3, "alto").when(a < 0.6, "moderado").otherwise("baixo")


def pairwise_correlation(fact: DataFrame, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """(symbol_a, symbol_b, year, n_obs, correlation) with n >= min_pair_obs."""
    return (_moments(fact, params, params.min_pair_obs)
            .select("symbol_a", "symbol_b", "year", "n_obs",
                    rnd(F.col("corr_raw"), 4).alias("correlation")))


def correlation_mart(fact: DataFrame, params: Params = DEFAULT_PARAMS) -> DataFrame:
    """The mart with key and both classifications."""
    p = pairwise_correlation(fact, params)
    return p.select(
        surrogate_key("symbol_a", "symbol_b", "year").alias("id"),
        "symbol_a", "symbol_b", "year", "n_obs", "correlation",
        correlation_class_col().alias("corr_class"),
        diversification_col().alias("diversification"))


def correlation_matrix(mart: DataFrame, year: int | None = None,
                       params: Params = DEFAULT_PARAMS) -> DataFrame:
    """Long-form symmetric matrix for one year (default: the latest).

    Symbols are those that appear in a pair that year; the diagonal is 1,
    a pair's value is mirrored, and a pair absent from the mart is 0. The
    mart is read several times, so pass a stored one. The dense grid of the
    year's symbols is the output itself and is formed by the blocked pair
    join, its blocks sized as those of the pairs, so no task holds a whole
    year's grid.
    """
    y = F.lit(year) if year is not None else mart.select(F.max("year")).scalar()
    m = mart.where(F.col("year") == y).select("year", "symbol_a", "symbol_b", "correlation")
    syms = stored(m.select("year", F.explode(F.array("symbol_a", "symbol_b")).alias("symbol"))
                   .distinct(), "matrix_symbols")
    cells = m.select("year", F.inline(F.array(
        F.struct(F.col("symbol_a"), F.col("symbol_b"), F.col("correlation").alias("c")),
        F.struct(F.col("symbol_b").alias("symbol_a"), F.col("symbol_a").alias("symbol_b"),
                 F.col("correlation").alias("c")))))
    grid = blocked_pairs(syms, "symbol", "year", pair_blocks(syms, params), strict=False)
    g = grid.join(cells.withColumn("present", F.lit(True)), ["year", "symbol_a", "symbol_b"], "left")
    val = (F.when(F.col("symbol_a") == F.col("symbol_b"), F.lit(1.0))
            .when(F.col("present"), F.col("c")).otherwise(F.lit(0.0)))
    return g.select("year", "symbol_a", "symbol_b", val.alias("correlation"))

"""SimHash near-duplicates by segment-popcount embedding.

A fingerprint is cut into 32 segments of two bits and mapped to their bit
counts. The Manhattan distance of two such vectors never exceeds the
Hamming distance of the fingerprints, so fingerprints within three bits
have vectors within three. Of the vector's two halves at least one is then
within one: a grid whose cells are the points of a half finds every such
pair as equal cells or as a cell and one a single step above it. Each
fingerprint stands in its own cell, and is sent to the cells one step
above; a join on the cell compares exactly (``bit_count`` of the
exclusive or) what meets there.

Only distinct fingerprints are joined, so copies never pair. Links go to
connected components by large-star and small-star rounds, each round
written to the shared folder.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import BROADCAST_ROWS, fresh, map_texts
from tickwise.session import stored

SHINGLE = 3             # words of a shingle
MAX_BITS = 3            # differing bits that still link
SEED = 42
_PIECE = 1 << 16        # shingles whose bits are summed at a time


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint of a whole text, in which a bit is set if
    it is set in over half the shingle hashes. No words: zero."""
    words = text.lower().split() if text else []       # ASCII case and white space
    if not words:
        return 0
    runs = [words[i:] for i in range(shingle)] if len(words) >= shingle else [[b" ".join(words)]]
    shingles = map(b" ".join, zip(*runs))
    digest = xxhash.xxh64_intdigest
    total = max(len(words) - shingle + 1, 1)
    ones = np.zeros(64, dtype=np.int64)
    for _ in range(0, total, _PIECE):
        h = np.fromiter((digest(s, SEED) for s, _ in zip(shingles, range(_PIECE))), dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", keep: list[str] | None = None,
                 name: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    """Columns ``keep``, then the fingerprint (bigint) as ``name``."""
    return map_texts(docs, text, ["doc_id"] if keep is None else keep, [(name, "bigint")],
                     lambda: lambda texts: [[fingerprint(t, shingle) for t in texts]], binary=True)


def _cells(fp: Column) -> list[tuple[int, Column]]:
    """(half, point) for both halves; a point packs 16 bit counts, two bits each."""
    low = F.lit(0x55555555)
    halves = [fp.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(fp, 32)]
    return [(h, x.bitwiseAND(low) + F.shiftrightunsigned(x, 1).bitwiseAND(low)) for h, x in enumerate(halves)]


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (a, b) of the distinct ``fp`` of ``prints`` that differ in at
    most ``max_bits`` (up to three) bits; a pair may come twice."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the two halves of the grid prove distances up to three")
    fp = F.col("fp")

    def rows(up: bool) -> DataFrame:
        sets = []
        for half, point in _cells(fp):
            own = F.struct((point + F.lit(half << 32)).alias("cell"), F.lit(False).alias("up"))
            sets.append(F.array(own))
            if up:
                # One step up in a dimension whose count is below two.
                steps = [F.when(F.shiftrightunsigned(point, 2 * i).bitwiseAND(F.lit(2)) == 0,
                                F.struct((point + F.lit((half << 32) + (1 << 2 * i))).alias("cell"),
                                         F.lit(True).alias("up"))) for i in range(16)]
                sets.append(F.array(*steps))
        return (prints.select("fp", F.explode(F.concat(*sets)).alias("at")).where("at IS NOT NULL")
                .select("fp", "at.cell", "at.up"))

    left = rows(False).select(F.col("fp").alias("a"), "cell")
    right = rows(True).select(F.col("fp").alias("b"), "cell", "up")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    # Equal cells meet both ways round: one of them is enough.
    once = F.col("up") | (F.col("a") < F.col("b"))
    return (left.join(right, (left["cell"] == right["cell"]) & near & once)
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))


def components(pairs: DataFrame) -> DataFrame:
    """(fp, root) for every end of a pair: root is the smallest fingerprint
    that it is connected with. Rounds of large-star (every larger neighbour
    is tied to the smallest one) and small-star (the smaller neighbours
    likewise) end when the set of ties stands still."""
    ties = stored(pairs.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .distinct(), "ties")
    mark = None
    while True:
        both = ties.union(ties.select("v", "u")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        large = stored(large, "large_star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        ties = stored(small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                      .union(least.select("u", "m")).distinct(), "small_star")
        now = ties.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    return ties.select(F.col("u").alias("fp"), F.col("v").alias("root")).union(
        ties.select(F.col("v"), F.col("v"))).distinct()


def roots(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, root) for the fingerprints of ``prints`` that are linked at all."""
    return components(links(prints, max_bits))


def groups(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, fp (bigint) and component_id, the
    smallest id of all documents that links lead to, itself included.

    Null, empty and blank texts have fingerprint zero and are linked like
    any other. Repeated rows stay and share a component. A null id never is
    a component's id unless the component has no other. Further columns are
    ignored.
    """
    each = stored(fingerprints(docs.withColumnRenamed(id_col, "doc_id"), text), "fingerprints")
    prints = stored(each.groupBy("fp").agg(F.min("doc_id").alias("first")), "prints")
    tree = stored(roots(prints.select("fp")), "roots")
    least = (prints.join(tree, "fp").groupBy("root").agg(F.min("first").alias("least")))
    linked = tree.join(least, "root").select("fp", "least")
    by_print = (prints.join(linked, "fp", "left")
                .select("fp", F.coalesce("least", "first").alias("component_id")))
    # Skewed fingerprints (many copies) are split by the adaptive skew join.
    return each.join(by_print, "fp").select("doc_id", "fp", "component_id")


def hex_digits(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, all columns as they are, of which each component
    keeps one: that of the smallest id (nulls last), of equal ids the first
    by file and place in it.

    Rows are told apart by file and row number; a frame that isn't a plain
    read of files is stored first.
    """
    place = ["_metadata.file_path", "_metadata.row_index"]
    try:
        docs.select(*place)
    except AnalysisException:
        docs = stored(docs, "documents")
    f, r = fresh(docs.columns, "_file"), fresh(docs.columns, "_row")
    at = docs.withColumns({f: F.col(place[0]), r: F.col(place[1])})
    picked = at.select(F.col(text).alias("text"), F.col(id_col).alias("doc_id"),
                       F.col(f).alias("file"), F.col(r).alias("row"))
    each = stored(fingerprints(picked, "text", ["doc_id", "file", "row"]), "fingerprints")
    mine = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "file", "row")
    prints = stored(each.groupBy("fp").agg(F.min(mine).alias("first")), "prints")
    tree = stored(roots(prints.select("fp")), "roots")
    first = (prints.join(tree, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root"))
             .agg(F.min("first").alias("first")).select("first.file", "first.row"))
    dropped = stored(each.select("file", "row").join(first, ["file", "row"], "left_anti"), "dropped")
    if dropped.count() <= BROADCAST_ROWS:
        dropped = F.broadcast(dropped)
    gone = (at[f] == dropped["file"]) & (at[r] == dropped["row"])
    return at.join(dropped, gone, "left_anti").drop(f, r)

"""Tables whose new rows appear at once or not at all.

A change writes new folders beside those in use and then replaces one small
file, the manifest, which names the folders that make up the tables. The
file is replaced by a rename, so a reader sees the old tables or the new
ones, and a change that fails on the way leaves the old ones as they were.
Folders that no manifest names any more stay until ``sweep``, for readers
that hold the earlier one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MANIFEST = "_manifest.json"


def _context(spark: SparkSession, path: str):
    """The file system of a folder, as Hadoop's FileContext, and its path there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    at = fs.makeQualified(at)
    return spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), spark._jsc.hadoopConfiguration()), fs, at


def read_manifest(spark: SparkSession, base: str) -> dict | None:
    """What the manifest below ``base`` says; None if there is none."""
    _, fs, at = _context(spark, f"{base}/{MANIFEST}")
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def write_manifest(spark: SparkSession, base: str, manifest: dict) -> None:
    """Replace the manifest in one step: written beside it, then renamed over it."""
    context, fs, at = _context(spark, f"{base}/{MANIFEST}")
    beside = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{MANIFEST}.{uuid.uuid4().hex}")
    out = fs.create(beside, False)
    try:
        out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
    finally:
        out.close()
    options = spark._jvm.org.apache.hadoop.fs.Options.Rename
    chosen = spark.sparkContext._gateway.new_array(options, 1)
    chosen[0] = options.OVERWRITE
    context.rename(fs.makeQualified(beside), at, chosen)


def new_folder(base: str, name: str) -> str:
    return f"{base}/{name}-{uuid.uuid4().hex}"


def named(manifest: dict) -> set[str]:
    """Every folder that a manifest names (values that are text and hold a slash)."""
    out: set[str] = set()
    for v in manifest.values():
        if isinstance(v, dict):
            out |= named(v)
        elif isinstance(v, str) and "/" in v:
            out.add(v)
    return out


def sweep(spark: SparkSession, base: str) -> int:
    """Remove the folders below ``base`` that the manifest does not name."""
    manifest = read_manifest(spark, base)
    if manifest is None:
        return 0
    base = base.rstrip("/")
    keep = {f.removeprefix(base).lstrip("/").split("/")[0] for f in named(manifest)}
    _, fs, at = _context(spark, base)
    gone = 0
    for status in fs.listStatus(at):
        name = status.getPath().getName()
        if name not in keep and name != MANIFEST:
            fs.delete(status.getPath(), True)
            gone += 1
    return gone


def exists(spark: SparkSession, path: str) -> bool:
    _, fs, at = _context(spark, path)
    return bool(fs.exists(at))


def restore(spark: SparkSession, path: str) -> None:
    """If a replacement stopped between its renames, put the earlier table back."""
    context, fs, at = _context(spark, path)
    if fs.exists(at) or not fs.exists(at.getParent()):
        return
    for status in fs.listStatus(at.getParent()):
        if status.getPath().getName().startswith(f"{at.getName()}.old-"):
            fs.rename(status.getPath(), at)
            return


def replace(df: DataFrame, path: str, check: Callable[[], None] | None = None) -> None:
    """Replace the Parquet table at ``path``, which ``df`` may read. The new
    rows are written whole beside it; only then is the old folder moved away
    and the new one to its name. A write that fails leaves the old table; the
    old folder goes last, and ``restore`` brings it back where the two renames
    were cut apart. ``check`` runs when the new rows are written and before any
    folder moves; if it raises, they go and the old table stays."""
    spark = df.sparkSession
    restore(spark, path)
    mark = uuid.uuid4().hex
    df.write.parquet(f"{path}.new-{mark}")
    _, fs, at = _context(spark, path)
    _, _, new = _context(spark, f"{path}.new-{mark}")
    if check is not None:
        try:
            check()
        except Exception:
            fs.delete(new, True)
            raise
    _, _, old = _context(spark, f"{path}.old-{mark}")
    if fs.exists(at) and not fs.rename(at, old):
        raise OSError(f"{path} cannot be moved")
    if not fs.rename(new, at):
        fs.rename(old, at)
        raise OSError(f"{path}.new-{mark} cannot be moved to {path}")
    if fs.exists(old):
        fs.delete(old, True)

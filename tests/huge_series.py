"""One symbol of 10 million minute bars through the segmented windows:
python tests/huge_series.py [rows]. Prints seconds and the rows of the largest
window task; run by hand, as it takes a minute."""

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tickwise.operators import segments as Sg  # noqa: E402
from tickwise.params import DEFAULT_PARAMS  # noqa: E402
from tickwise.session import local_session, stored  # noqa: E402

rows = int(sys.argv[1]) if len(sys.argv) > 1 else 10_000_000
spark = local_session(shuffle_partitions=32, checkpoint=tempfile.mkdtemp(prefix="run-", dir="/tmp"))
price = (F.lit(100) + 50 * F.sin(F.col("id") / 5000) + F.pmod(F.xxhash64("id", "symbol"), F.lit(1000)) / 1000)
bars = stored(spark.range(rows).select(F.explode(F.array(F.lit("HOT"), F.lit("^BVSP"))).alias("symbol"), "id").select(
    "symbol", F.timestamp_seconds(F.lit(946_684_800) + 60 * F.col("id")).alias("trade_date"),
    price.cast("decimal(18,6)").alias("adj_close"), F.col("id").alias("volume")), "huge")
t = time.time()
out = stored(Sg.segmented_series(bars, DEFAULT_PARAMS), "huge_out")
print(f"{out.count()} rows in {time.time() - t:.0f} s")
x = Sg.in_segments(bars, {"bar": (F.lit(True), 252)}, DEFAULT_PARAMS)
print("largest segment with its halo:", x.groupBy("symbol", "_seg").count().agg(F.max("count")).first()[0])

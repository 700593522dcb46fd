"""Gold on a stored Silver vs the same rows with one group holding a third of

Usage: python tools/skew_bench.py SILVER_PATH SCRATCH_DIR
(SILVER_PATH e.g. the lake0/silver written by tools/scale_bench.py.)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from incidentlake.config import local_session  # noqa: E402
from incidentlake.operators.gold import to_gold  # noqa: E402
from incidentlake.schemas import GOLD_DIMS  # noqa: E402
from incidentlake.sinks import write_layer  # noqa: E402
from incidentlake.sources import read_layer  # noqa: E402

HOT_GROUP = dict(zip(GOLD_DIMS, ("DDOS", "HIGH", "TCP", "BLOCKED", "Segment A")))


def main() -> None:
    silver_path, root = sys.argv[1], sys.argv[2].rstrip("/")
    spark = local_session(shuffle_partitions=16, extra={"spark.checkpoint.dir": f"{root}/ckpt"})
    src = read_layer(spark, silver_path)
    hot = (F.xxhash64("timestamp", "source_ip_masked", "packet_length") % 3) == 0  # a third
    skewed = src.select(*(
        F.when(hot, F.lit(HOT_GROUP[c])).otherwise(F.col(c)).alias(c) if c in HOT_GROUP else F.col(c)
        for c in src.columns
    ))
    write_layer(skewed, f"{root}/skewed")
    sk = read_layer(spark, f"{root}/skewed")
    largest = sk.groupBy(*GOLD_DIMS).count().agg(F.max("count")).first()[0]
    out = {"rows": sk.count(), "largest_group": largest}
    for run in range(3):
        for name, df in (("uniform", src), ("skewed", sk)):
            t = time.perf_counter()
            write_layer(to_gold(df), f"{root}/gold_{name}")
            if run:
                key = f"gold_{name}_s"
                out[key] = min(out.get(key, 1e9), round(time.perf_counter() - t, 2))
    print(json.dumps(out))


if __name__ == "__main__":
    main()

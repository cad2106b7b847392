"""Print Spark's formatted physical plan for registered queries (no results collected).

Usage: python scripts/show_plans.py [sf_dir] name [name ...]
A ``stream_*`` name prints the plan of that windowed query on a streaming source (the
stream is not started).
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def streaming_plan(spark, sf_dir: str, name: str) -> None:
    from hitscope.operators.windows import WINDOWED
    from hitscope.plans import catalog
    from hitscope.session import scratch_path
    from hitscope.sources.stream import read_record_stream
    from hitscope.streaming.pipeline import enriched_stream

    path = scratch_path(spark, "plans", "input")
    spark.createDataFrame([], "value string").write.text(path)  # the source needs the folder
    records = read_record_stream(spark, "text", path=path)
    fn, _keys = WINDOWED[name]
    fn(enriched_stream(records, catalog._index(spark, sf_dir))).explain("formatted")


def main(argv: list[str]) -> None:
    from hitscope.plans.catalog import QUERIES
    from hitscope.session import local_session

    sf_dir = argv[0] if argv and os.path.isdir(argv[0]) else "/root/testdata/sf0.01"
    names = [a for a in argv if a != sf_dir] or ["traffic_by_country"]
    spark = local_session(8)
    for name in names:
        print(f"===== {name} =====")
        if name.startswith("stream_") and name != "stream_traffic_volume_hosts":
            streaming_plan(spark, sf_dir, name)
        else:
            QUERIES[name](spark, sf_dir).explain("formatted")


if __name__ == "__main__":
    main(sys.argv[1:])

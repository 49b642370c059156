"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs to completion through the no-op sink (no collect).  The
regex model is trained first (its time is reported as ``train_regex``) and is
reused by the queries that need it, as a user would do.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "train_regex", "presplit_gpt4", "chunk_dictionary", "pair_counts", "top_pairs", "encode_regex",
    "decode_bytes", "roundtrip", "compression", "fertility", "token_freq", "entropy", "mutual_info",
    "encode_specials", "pack_context", "token_chunks",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    from toksmith.plans import catalog
    from toksmith.session import get_session

    spark = get_session()
    times: dict[str, float] = {}
    for name in HEADLINE:
        fn = catalog.QUERIES.get(name)
        if fn is None:
            continue
        t0 = time.time()
        fn(spark, sf_dir).write.mode("overwrite").format("noop").save()
        times[name] = round(time.time() - t0, 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_headline_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf}))


if __name__ == "__main__":
    main()

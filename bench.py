"""Benchmark: run the headline queries and print one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_QUERIES`` (comma list; default the headline set).
Each query is fully executed through the ``noop`` sink (no collect to the
driver) twice: the first (cold) run pays for JIT and regex warm-up and is kept
under ``cold``; the second (warm) run is reported, and the value is the sum of
the warm per-query wall seconds.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shapeloom.plans.registry import load_all  # noqa: E402
from shapeloom.session import local_session  # noqa: E402

HEADLINE = [
    "quality_mart",          # staging + data-quality mart
    "clean_manifest",        # description build + clean + keep-first dedupe
    "useful_text",           # F03 over every word of every document
    "hash_embed",            # BLAKE2b feature hashing, dim 256
    "hash_embed_md5",        # same shape, JVM-only digest
    "synthetic_shape_cells", # V01 solids, one asset per document
    "surface_faces",         # V15b boundary faces of those solids
    "point_voxels",          # V04a point binning
    "resize_nearest",        # V10 nearest resize to 32^3
    "minibatches",           # W04 skew-safe ordinals
    "prompt_validation",     # F11/F12/T08 over user turns
    "asset_split",           # J02/F13 build split
    "training_view",         # X01 manifest x grids x embeddings
    "crossing_vertices",     # V15a iso-surface vertices
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = local_session(cpus, int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")), app="shapeloom-bench")
    qs = load_all()
    # warm the JVM and the Python workers once (not timed)
    qs["quality_mart"].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    cold: dict[str, float] = {}
    for n in names:
        for runs in (cold, times):
            t0 = time.time()
            qs[n].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs[n] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus,
                      "cold_total": round(sum(cold.values()), 3), "cold": cold}))
    spark.stop()


if __name__ == "__main__":
    main()

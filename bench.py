"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed fully (noop sink, nothing collected to the driver),
once to warm up and then timed; the best of $BENCH_REPEAT timed runs counts.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from celltally import queries as Q  # noqa: E402
from celltally.session import local_session  # noqa: E402

HEADLINE = [
    "counts_umis",          # alignments + annotation -> overlap join -> anti-joins -> molecules -> UMI counts
    "counts_transcripts",
    "molecules",
    "exon_only",            # two samples, mutual interval anti-join
    "intron_only",
    "overlap_exon",         # binned overlap join
    "align_blocks",         # CIGAR -> blocks
    "exon_table",           # GTF -> merged exons
    "intron_table",
    "barcoded_reads",       # pairing + barcode split + dictionary join
    "read_stats",
    "barcode_expand_hd1",
    "matrix_umis_total",    # pivot for export
    "qc_summary",
]


def run(spark, key, sf_dir):
    t0 = time.perf_counter()
    Q.REGISTRY[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    keys = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    # local mode: one shuffle partition per core (AQE still coalesces small ones)
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus if cpus.isdigit() else "8"))
    spark = local_session(cpus, shuffle_partitions=parts, app="celltally-bench")
    times = {}
    for k in keys:
        warm = run(spark, k, sf_dir)  # warm-up
        times[k] = round(min(run(spark, k, sf_dir) for _ in range(repeat)), 3)
        print(f"{k}: warm-up {warm:.1f}s, timed {times[k]:.1f}s", file=sys.stderr, flush=True)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "total_seconds_headline_queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()

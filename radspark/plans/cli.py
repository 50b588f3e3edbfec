"""Command line: run a configured pipeline, validate a dataset, measure a scan.

Exit codes: 0 done, 1 some rows failed, 2 bad input, 130 interrupted.
"""

from __future__ import annotations

import argparse
import json
import sys
import time

from pyspark.sql import functions as F

from radspark import session
from radspark.operators import imaging, metrics, quality
from radspark.plans import config, report
from radspark.sources import shards


def run(a) -> int:
    conf = config.load(a.config)
    spark = session.build(a.master)
    scan = next((s.config for s in config.stages(conf) if s.name == "scan"), {})
    files = config.scan(spark, a.input, scan)
    if a.max_samples:
        files = files.orderBy("path").limit(a.max_samples)
    p = config.build(conf, a.checkpoint)
    if a.dry_run:
        print(json.dumps({"files": files.select("path").count(), "stages": p.order()}))
        return 0
    r = p.run(files, a.output, resume=a.resume)
    print(json.dumps({"processed": r.total_processed, "failed": r.total_failed, "skipped": r.total_skipped, "images_per_second": round(r.images_per_second, 3),
                      "outputs": {k: {n: v for n, v in o.items() if n != "json"} for k, o in r.outputs.items()}}))
    if a.quality_report and "quality_check" not in r.outputs:
        rows = spark.read.parquet(a.output).where("status = 'completed'")
        config.SINKS["quality_check"](rows, {"report_output": a.quality_report})
    return 1 if r.total_failed else 0


def validate(a) -> int:
    spark = session.build(a.master)
    s = shards.read_tar(spark, a.input)
    if a.max_samples:
        s = s.orderBy("key").limit(a.max_samples)
    facts = imaging.statistics(s).join(s.select("key", F.col("image.height").alias("height"), F.col("image.width").alias("width")), "key")
    r = quality.report(facts, ["mean", "height", "width"], [], "label", ["label"])
    if a.html:
        report.to_html(r, a.html, a.input, quality.histogram(facts, "mean"))
    print(json.dumps(report.to_json(r, a.json, a.input)))
    return 0


def bench(a) -> int:
    spark = session.build(a.master)
    times = []
    for _ in range(a.repeats):
        t = time.perf_counter()
        n = config.scan(spark, a.input, {"min_file_size": a.min_file_size}).select("path").count()
        times.append(time.perf_counter() - t)
    rows = [(int(spark.sparkContext.defaultParallelism), n / t) for t in times]
    out = metrics.peak(spark.createDataFrame(rows, "workers int, throughput double")).first().asDict()
    print(json.dumps({"stage": "scan", "files": n, "workers": rows[0][0], "avg_time_sec": sum(times) / len(times), "peak": out}))
    return 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="radspark")
    p.add_argument("--master")
    sub = p.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run")
    for n in ("--config", "--input", "--output"):
        r.add_argument(n, required=True)
    r.add_argument("--checkpoint")
    r.add_argument("--max-samples", type=int)
    r.add_argument("--dry-run", action="store_true")
    r.add_argument("--resume", action="store_true")
    r.add_argument("--quality-report", help="HTML file for a report of the completed images")
    r.set_defaults(fn=run)
    v = sub.add_parser("validate")
    v.add_argument("--input", required=True)
    v.add_argument("--html")
    v.add_argument("--json")
    v.add_argument("--max-samples", type=int)
    v.set_defaults(fn=validate)
    b = sub.add_parser("bench")
    b.add_argument("--input", required=True)
    b.add_argument("--repeats", type=int, default=3)
    b.add_argument("--min-file-size", type=int, default=0)
    b.set_defaults(fn=bench)
    a = p.parse_args(argv)
    try:
        return a.fn(a)
    except KeyboardInterrupt:
        return 130
    except (FileNotFoundError, ValueError) as x:
        print(x, file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())

"""Metric points, run statistics and scaling, as aggregations."""

from __future__ import annotations

import json
import time
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def summary(points: DataFrame, name: str = "name", value: str = "value", order: tuple[str, ...] = ("ts",)) -> DataFrame:
    """name, count, total, mean, min, max, last; numbers to 4 digits."""
    v = F.col(value)
    return points.groupBy(F.col(name).alias("name")).agg(
        F.count(v).alias("count"), F.round(F.sum(v), 4).alias("total"), F.round(F.avg(v), 4).alias("mean"), F.round(F.min(v), 4).alias("min"),
        F.round(F.max(v), 4).alias("max"), F.round(F.max_by(v, F.struct(*order)), 4).alias("last"))


def run_status(results: DataFrame, success: str = "success", duration: str = "duration", by: tuple[str, ...] = ()) -> DataFrame:
    """processed, failed, duration, rate and fraction done of each group of task results."""
    ok = F.col(success)
    return results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(ok).alias("processed"), F.count_if(~ok).alias("failed"), F.round(F.sum(duration), 4).alias("duration"),
        F.round(F.try_divide(F.count_if(ok).cast("double"), F.sum(duration)), 6).alias("rate"), F.round(F.count_if(ok) / F.count(F.lit(1)), 6).alias("fraction"))


def scaling(runs: DataFrame, workers: str = "workers", throughput: str = "throughput") -> DataFrame:
    """workers, throughput, efficiency (% of the single worker's times workers) and speedup."""
    base = runs.where(F.col(workers) == 1).agg(F.max(throughput).alias("base"))
    t = F.col(throughput)
    return runs.join(F.broadcast(base)).select(  # one row
        F.col(workers).alias("workers"), t.alias("throughput"), F.round(F.try_divide(t, F.col("base") * F.col(workers)) * 100, 1).alias("efficiency"), F.round(F.try_divide(t, F.col("base")), 2).alias("speedup"))


def peak(runs: DataFrame, workers: str = "workers", throughput: str = "throughput") -> DataFrame:
    return runs.agg(F.max_by(workers, throughput).alias("workers"), F.max(throughput).alias("throughput"))


def transfer(files: DataFrame, length: str = "length", ok: str = "ok", seconds: float | None = None) -> DataFrame:
    """files, bytes and failures of a transfer; MB/s where seconds are given."""
    a = files.agg(F.count_if(F.col(ok)).alias("files"), F.coalesce(F.sum(F.when(F.col(ok), F.col(length))), F.lit(0)).alias("bytes"), F.count_if(~F.col(ok)).alias("failed"))
    return a.withColumn("mb_per_second", F.lit(None).cast("double") if not seconds else F.round(F.col("bytes") / 1048576 / seconds, 4))


def progress(done: int, failed: int, total: int, seconds: float) -> dict[str, float]:
    """Fraction done, rows a second and seconds left."""
    gone = done + failed
    rate = gone / seconds if seconds > 0 else 0.0
    return {"fraction": gone / total if total else 1.0, "rate": rate, "eta_sec": (total - gone) / rate if rate else float("inf") if total > gone else 0.0}


class Collector:
    """Driver-side points and counters; everything about data comes from aggregations instead."""

    def __init__(self, most: int = 100_000):
        self.points: list[tuple[str, float, float, dict[str, str]]] = []
        self.counts: dict[str, int] = {}
        self.most = most

    def record(self, name: str, value: float, **tags: str) -> None:
        self.points.append((name, float(value), time.time(), tags))
        del self.points[: max(0, len(self.points) - self.most)]

    def increment(self, name: str, by: int = 1) -> None:
        self.counts[name] = self.counts.get(name, 0) + by

    @contextmanager
    def timer(self, name: str):
        begun = time.perf_counter()
        try:
            yield
        finally:
            self.record(name, (time.perf_counter() - begun) * 1000)

    def summaries(self) -> dict[str, dict[str, float]]:
        by: dict[str, list[float]] = {}
        for n, v, _, _ in self.points:
            by.setdefault(n, []).append(v)
        return {n: {"count": len(v), "total": round(sum(v), 4), "mean": round(sum(v) / len(v), 4), "min": round(min(v), 4), "max": round(max(v), 4), "last": round(v[-1], 4)} for n, v in by.items()}

    def frame(self, spark) -> DataFrame:
        return spark.createDataFrame(self.points, "name string, value double, ts double, tags map<string,string>")

    def export_json(self, path: str) -> None:
        with open(path, "w") as f:
            json.dump({"summaries": self.summaries(), "counters": self.counts}, f, indent=1)

"""Stage plans: an ordered set of DataFrame functions with status, retry and resume.

A stage takes and returns a DataFrame. Rows carry ``status``, ``stage`` and
``error``; rows that failed pass by later stages. Keys that are done are kept
as Parquet, and a later run leaves them out with an anti join.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

StageFn = Callable[[DataFrame], DataFrame]


@dataclass
class Stage:
    name: str
    fn: StageFn
    depends_on: tuple[str, ...] = ()
    enabled: bool = True
    retries: int = 0


@dataclass
class Result:
    total_processed: int = 0
    total_failed: int = 0
    total_skipped: int = 0
    total_duration_sec: float = 0.0
    errors: list[tuple[str, str, str]] = field(default_factory=list)
    checkpoint_path: str | None = None
    outputs: dict[str, dict] = field(default_factory=dict)

    @property
    def images_per_second(self) -> float:
        return self.total_processed / self.total_duration_sec if self.total_duration_sec else 0.0


class Pipeline:
    """``errors_kept`` bounds the error rows brought to the driver; all of them are in the output."""

    def __init__(self, name: str = "pipeline", checkpoint: str | None = None, key: str = "key", errors_kept: int = 1000):
        self.name, self.checkpoint, self.key, self.errors_kept = name, checkpoint, key, errors_kept
        self.stages: dict[str, Stage] = {}
        self.sinks: dict[str, Callable[[DataFrame], dict]] = {}

    def add(self, name: str, fn: StageFn, depends_on: tuple[str, ...] = (), enabled: bool = True, retries: int = 0) -> Pipeline:
        self.stages[name] = Stage(name, fn, tuple(depends_on), enabled, retries)
        return self

    def at_end(self, name: str, fn: Callable[[DataFrame], dict], enabled: bool = True) -> Pipeline:
        """``fn`` gets all rows that this run completed; what it returns is in the result's ``outputs``."""
        if enabled:
            self.sinks[name] = fn
        return self

    def order(self) -> list[str]:
        """Dependencies first, otherwise as added; unknown names are ignored, a cycle is an error."""
        out: list[str] = []
        state: dict[str, int] = {}

        def visit(n: str) -> None:
            if n not in self.stages or state.get(n) == 2:
                return
            if state.get(n) == 1:
                raise ValueError(f"stages depend on one another in a circle at {n}")
            state[n] = 1
            for d in self.stages[n].depends_on:
                visit(d)
            state[n] = 2
            out.append(n)

        for n in self.stages:
            visit(n)
        return out

    def done(self, spark: SparkSession) -> DataFrame | None:
        """Keys that earlier runs completed."""
        if not self.checkpoint:
            return None
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.checkpoint}/done")
        if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return None
        return spark.read.parquet(f"{self.checkpoint}/done").select(self.key).distinct()

    def plan(self, df: DataFrame) -> DataFrame:
        """The stages applied in order, nothing run yet."""
        for c in ("status", "stage", "error"):
            if c not in df.columns:
                df = df.withColumn(c, F.lit("pending" if c == "status" else None).cast("string"))
        columns = None
        for n in self.order():
            s = self.stages[n]
            if not s.enabled:
                continue
            bad = df.where("status = 'failed'")
            good = s.fn(df.where("status <> 'failed'"))
            for c, v in (("status", "pending"), ("error", None)):
                if c not in good.columns:
                    good = good.withColumn(c, F.lit(v).cast("string"))
            failed = F.col("error").isNotNull()
            good = good.withColumns({"status": F.when(failed, "failed").otherwise("running"), "stage": F.lit(n)})
            df = good.unionByName(bad, allowMissingColumns=True)
            columns = df.columns
        return df.withColumn("status", F.when(F.col("status") == "failed", "failed").otherwise("completed")).select(*(columns or df.columns))

    def run(self, df: DataFrame, out: str, resume: bool = True, progress: Callable[[dict], None] | None = None) -> Result:
        """Run, write the rows to ``out`` and remember completed keys; ``progress`` is told of the tasks while the plan runs."""
        spark, begun = df.sparkSession, time.time()
        result = Result(checkpoint_path=self.checkpoint)
        done = self.done(spark) if resume else None
        if done is not None:
            result.total_skipped = df.join(done, self.key, "left_semi").count()
            df = df.join(done, self.key, "left_anti")
        tries = 1 + max([s.retries for s in self.stages.values()], default=0)
        path = f"{out}/run={uuid.uuid4().hex}"
        end = watch(spark, progress, 0.2) if progress else lambda: None
        try:
            for k in range(tries):
                try:
                    self.plan(df).write.mode("overwrite").parquet(path)
                    break
                except Exception:
                    if k == tries - 1:
                        raise
        finally:
            end()
        rows = spark.read.parquet(path)
        n = rows.agg(F.count_if(F.col("status") == "completed").alias("ok"), F.count_if(F.col("status") == "failed").alias("bad")).first()
        result.total_processed, result.total_failed = n["ok"], n["bad"]
        bad = rows.where("status = 'failed'").select(self.key, "stage", "error").orderBy(self.key).limit(self.errors_kept).collect()
        result.errors = [(str(r[0]), r[1], r[2]) for r in bad]
        if n["ok"]:
            result.outputs = {name: fn(rows.where("status = 'completed'")) for name, fn in self.sinks.items()}
        if self.checkpoint:
            rows.where("status = 'completed'").select(self.key).write.mode("append").parquet(f"{self.checkpoint}/done")
            index = [(json.dumps({"pipeline": self.name, "completed": n["ok"], "timestamp": time.time(), "stages": self.order()}),)]
            spark.createDataFrame(index, "value string").coalesce(1).write.mode("append").text(f"{self.checkpoint}/index")
        result.total_duration_sec = time.time() - begun
        return result


def _within(fn: Callable, v, timeout: float | None):
    """``fn(v)``; TimeoutError once ``timeout`` seconds are over (the call itself is left to end on its own)."""
    if not timeout:
        return fn(v)
    got: list = []

    def call() -> None:
        try:
            got.append((fn(v), None))
        except BaseException as x:
            got.append((None, x))

    t = threading.Thread(target=call, daemon=True)
    t.start()
    t.join(timeout)
    if not got:
        raise TimeoutError(f"no result after {timeout} s")
    if got[0][1] is not None:
        raise got[0][1]
    return got[0][0]


def watch(spark: SparkSession, tell: Callable[[dict], None], every: float = 1.0) -> Callable[[], None]:
    """Call ``tell`` with {"tasks", "done", "fraction"} of the running stages every few seconds; returns what ends it."""
    over = threading.Event()
    tracker = spark.sparkContext.statusTracker()

    def look() -> None:
        while not over.wait(every):
            infos = [i for i in map(tracker.getStageInfo, tracker.getActiveStageIds()) if i]
            n, done = sum(i.numTasks for i in infos), sum(i.numCompletedTasks for i in infos)
            if n:
                tell({"tasks": n, "done": done, "fraction": done / n})

    thread = threading.Thread(target=look, daemon=True)
    thread.start()

    def end() -> None:
        over.set()
        thread.join()

    return end


def map_rows(df: DataFrame, fn: Callable, key: str, value: str, retries: int = 0, timeout: float | None = None) -> DataFrame:
    """key, success, output (JSON), error, duration_sec of ``fn(value)`` for every row, failures and calls above ``timeout`` seconds kept in the row."""
    import pandas as pd

    def run(parts):
        for p in parts:
            out = []
            for k, v in zip(p[key], p[value]):
                begun, got, err = time.perf_counter(), None, None
                for _ in range(1 + retries):
                    try:
                        got, err = json.dumps(_within(fn, v, timeout), default=str), None
                        break
                    except Exception as x:
                        err = f"{type(x).__name__}: {x}"
                out.append((str(k), err is None, got, err, time.perf_counter() - begun))
            yield pd.DataFrame(out, columns=["key", "success", "output", "error", "duration_sec"])

    return df.select(key, value).mapInPandas(run, "key string, success boolean, output string, error string, duration_sec double")

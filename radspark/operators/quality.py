"""Dataset quality analytics: distributions, outliers, completeness, balance, leakage.

Results are small tidy frames. Each operator is one partial and final
aggregation over the data (plus one more pass where rows are flagged, and
one that counts distinct values ahead of exact quantiles).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from radspark.storage import spool

# Default fields and limits of the quality report.
REQUIRED_FIELDS = ("patient_id", "study_instance_uid", "modality", "manufacturer", "rows", "columns", "bits_stored", "image_laterality", "view_position")
IQR_FACTOR, Z_LIMIT, COMPLETE_LIMIT, SEVERE_RATIO, BETA, OUTLIER_WARNING, SMALL_DATA, LOW_VARIANCE, BINS = 1.5, 3.0, 0.95, 10.0, 0.9999, 0.05, 1000, 0.01, 50
PERCENTS = (0.05, 0.25, 0.5, 0.75, 0.95)


#: Distinct values that one buffer may hold; columns with more are searched by ranks.
BUFFER = 1_000_000
#: Accuracy of the sketches that narrow a search, and the bound of one sketch's size.
SKETCH = 10_000


def _ordered(df: DataFrame, ranks: Sequence[int], buffer: int, sketch: int) -> dict[int, float]:
    """Values at places (from 0) of a frame's column ``v`` in order, exactly, in bounded memory; neither null nor NaN.

    A pass over the rows sketches the interval that each wanted place lies in
    and counts what lies below it; the next pass sees only that interval, some
    4 / ``sketch`` of it. Once an interval has few distinct values they are
    counted one by one. 10^12 rows take four passes.
    """
    low = {r: (float("-inf"), float("inf"), 2.0) for r in ranks}
    kept = dict(low)  # intervals known to hold their place
    out: dict[int, float] = {}
    while low:
        inside = {r: F.when(F.col("v").between(a, b), F.col("v")) for r, (a, b, _) in low.items()}
        facts = df.agg(*[c for r, (a, _, _) in low.items() for c in (
            F.count_if(F.col("v") < a).alias(f"below{r}"), F.count(inside[r]).alias(f"n{r}"), F.approx_count_distinct(inside[r]).alias(f"kinds{r}"))]).first()
        ready, steps = [], []
        for r, (a, b, slack) in list(low.items()):
            below, n = facts[f"below{r}"], facts[f"n{r}"]
            if not below <= r < below + n:  # the sketch was off: again, wider
                low[r] = kept[r] = (*kept[r][:2], kept[r][2] * 4)
                steps.append((r, None))
                continue
            kept[r] = (a, b, slack)
            if facts[f"kinds{r}"] <= buffer:
                ready.append(F.expr(f"percentile_disc({(r - below + 0.5) / n!r}d) within group (order by case when v between {_sql(a)} and {_sql(b)} then v end)").alias(f"at{r}"))
            else:
                steps.append((r, (r - below, n)))
        if ready:
            got = df.agg(*ready).first().asDict()
            out |= {int(k[2:]): x for k, x in got.items()}
        ends = {}
        for r, place in steps:
            if place:
                at, n = place
                off = kept[r][2] * n / sketch + 1
                ends[r] = [min(max((at + d) / n, 0.0), 1.0) for d in (-off, off)]
        low = {r: low[r] for r, _ in steps}
        if ends:
            got = df.agg(*[F.percentile_approx(inside[r], p, sketch).alias(f"e{r}") for r, p in ends.items()]).first()
            low |= {r: (float(got[f"e{r}"][0]), float(got[f"e{r}"][1]), kept[r][2]) for r in ends}
    return out


def _sql(x: float) -> str:
    return f"double('{x!r}')" if abs(x) != float("inf") else f"double('{'-' if x < 0 else ''}infinity')"


def _quantiles(df: DataFrame, values: Sequence[str], ps: Sequence[float], exact: bool = True, buffer: int | None = None, sketch: int = SKETCH) -> list[Column]:
    """For each value a Column that gives its quantiles in an aggregation of ``df``.

    Exact ones interpolate linearly: in one buffer where a count has found few
    distinct values, else by ``_ordered``. Approximate ones keep a bounded sketch.
    NaN comes after all numbers.
    """
    buffer = BUFFER if buffer is None else buffer
    own = [F.col(v).cast("double") for v in values]
    if not exact:
        return [F.percentile_approx(c, list(ps), sketch).cast("array<double>") for c in own]
    kinds = df.agg(*[F.approx_count_distinct(c).alias(str(i)) for i, c in enumerate(own)]).first() if own else ()
    out = []
    for c, k in zip(own, kinds):
        if k <= buffer:
            out.append(F.percentile(c, list(ps)))
            continue
        v = df.select(c.alias("v")).where("v is not null")
        n, nans = v.agg(F.count(F.lit(1)), F.count_if(F.isnan("v"))).first()
        places = [p * (n - 1) for p in ps]
        wanted = sorted({r for x in places for r in (math.floor(x), math.ceil(x)) if r < n - nans})
        at = _ordered(v.where(~F.isnan("v")), wanted, buffer, sketch)
        ends = [(x, at.get(math.floor(x), math.nan), at.get(math.ceil(x), math.nan)) for x in places]
        out.append(F.array(*[F.lit(a if a == b else (math.ceil(x) - x) * a + (x - math.floor(x)) * b) for x, a, b in ends]))
    return out


def _moments(v: Column, quantiles: Column) -> list[Column]:
    return [F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"),
            quantiles.alias("q"), F.skewness(v).alias("skewness"), F.kurtosis(v).alias("kurtosis")]


def _shape(of: str = "") -> list[Column]:
    """The columns of ``distribution`` from those of ``_moments``, which may be fields of a column."""
    c = lambda n: F.col(f"{of}{n}")
    zero = lambda n, x: F.coalesce(x, F.lit(0.0)).alias(n)
    moving = c("std") > 1e-10
    q = {n: zero(n, F.get(c("q"), F.lit(i))) for i, n in enumerate(("p5", "p25", "median", "p75", "p95"))}
    return [c("count").alias("count"), zero("mean", c("mean")), zero("std", c("std")), q["median"], zero("min", c("min")), zero("max", c("max")), q["p5"], q["p25"], q["p75"], q["p95"],
            F.when(moving, c("skewness")).otherwise(0.0).alias("skewness"), F.when(moving, c("kurtosis")).otherwise(0.0).alias("kurtosis")]


def distribution(df: DataFrame, value: str, exact: bool = True) -> DataFrame:
    """One row: count, mean, population std, median, min, max, p5..p95, skewness, excess kurtosis; zeros for no data."""
    return df.agg(*_moments(F.col(value).cast("double"), _quantiles(df, [value], PERCENTS, exact)[0])).select(*_shape())


def histogram(df: DataFrame, value: str, bins: int = BINS) -> DataFrame:
    """bin, low, high, count of equal bins from min to max, the last one closed; constant data widen by half on both sides."""
    v = df.select(F.col(value).cast("double").alias("v")).where("v is not null")
    ends = v.agg(F.min("v").alias("a"), F.max("v").alias("b")).select(
        F.when(F.col("a") == F.col("b"), F.col("a") - 0.5).otherwise(F.col("a")).alias("lo"), F.when(F.col("a") == F.col("b"), F.col("b") + 0.5).otherwise(F.col("b")).alias("hi"))
    at = F.least(F.floor((F.col("v") - F.col("lo")) / ((F.col("hi") - F.col("lo")) / bins)), F.lit(bins - 1)).cast("int")
    counts = v.join(F.broadcast(ends)).groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("count"))  # ends: one row
    grid = ends.select("lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")).where("lo is not null")
    step = (F.col("hi") - F.col("lo")) / bins
    return grid.join(counts, "bin", "left").select("bin", (F.col("lo") + F.col("bin") * step).alias("low"), (F.col("lo") + (F.col("bin") + 1) * step).alias("high"), F.coalesce("count", F.lit(0)).alias("count"))


def iqr_fences(df: DataFrame, value: str, factor: float = IQR_FACTOR, exact: bool = True) -> DataFrame:
    """n, low, high: one row."""
    v = F.col(value).cast("double")
    a = df.agg(F.count(v).alias("n"), _quantiles(df, [value], (0.25, 0.75), exact)[0].alias("q"))
    iqr = F.col("q")[1] - F.col("q")[0]
    return a.select("n", (F.col("q")[0] - factor * iqr).alias("low"), (F.col("q")[1] + factor * iqr).alias("high"))


def outliers_iqr(df: DataFrame, value: str, *keys: str, factor: float = IQR_FACTOR, exact: bool = True) -> DataFrame:
    """Rows strictly outside the fences, with them; none below 4 values."""
    f = iqr_fences(df, value, factor, exact)
    return (df.select(*keys, F.col(value).cast("double").alias("value")).join(F.broadcast(f))  # fences: one row
            .where((F.col("n") >= 4) & ((F.col("value") < F.col("low")) | (F.col("value") > F.col("high")))).drop("n"))


def outliers_zscore(df: DataFrame, value: str, *keys: str, limit: float = Z_LIMIT) -> DataFrame:
    """Rows whose absolute z-score exceeds the limit; none below 3 values or without spread."""
    v = F.col(value).cast("double")
    f = df.agg(F.count(v).alias("n"), F.avg(v).alias("m"), F.stddev_pop(v).alias("s"))
    z = (F.col("value") - F.col("m")) / F.when(F.col("s") >= 1e-10, F.col("s"))
    return (df.select(*keys, v.alias("value")).join(F.broadcast(f)).where((F.col("n") >= 3) & (F.abs(z) > limit))  # facts: one row
            .select(*keys, "value", z.alias("z")))


def present(c: Column) -> Column:
    """Neither null nor blank."""
    return F.coalesce(F.trim(c.cast("string")) != "", F.lit(False))


def completeness(df: DataFrame, fields: Sequence[str] | None = None, limit: float = COMPLETE_LIMIT) -> DataFrame:
    """field, total, missing, completeness (4 digits), critical (before rounding); all columns by default. One pass."""
    fields = sorted(df.columns) if fields is None else list(fields)
    have = [F.count_if(present(F.col(f)) if f in df.columns else F.lit(False)).alias(f"_{i}") for i, f in enumerate(fields)]
    wide = df.agg(F.count(F.lit(1)).alias("total"), *have)
    rows = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"_{i}").alias("n")) for i, f in enumerate(fields)])).alias("r")
    share = F.when(F.col("total") > 0, F.col("n") / F.col("total")).otherwise(0.0)
    return wide.select("total", rows).select("total", "r.*").select("field", "total", (F.col("total") - F.col("n")).alias("missing"), F.round(share, 4).alias("completeness"), (share < limit).alias("critical"))


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """label, n, fraction (4 digits), in order of count; null labels are no class."""
    n = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = n.agg(F.sum("n").alias("total"))
    return n.join(F.broadcast(total)).select(label, "n", F.round(F.col("n") / F.col("total"), 4).alias("fraction"))  # total: one row


def class_balance(df: DataFrame, label: str, severe: float = SEVERE_RATIO, beta: float = BETA) -> DataFrame:
    """One row: totals, largest and smallest class, their ratio, effective number and entropy."""
    n = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    total = n.agg(F.sum("n").alias("total"))
    p = F.col("n") / F.col("total")
    ratio = F.col("most") / F.greatest(F.col("fewest"), F.lit(1))
    # ties: the largest class with the smallest label, the smallest class with the largest
    biggest = F.min(F.struct((-F.col("n")).alias("n"), F.col("k")))
    smallest = F.max(F.struct((-F.col("n")).alias("n"), F.col("k")))
    a = n.join(F.broadcast(total)).agg(  # total: one row
        F.sum("n").alias("total_samples"), F.count(F.lit(1)).alias("num_classes"), biggest["k"].alias("majority_class"), smallest["k"].alias("minority_class"),
        F.max("n").alias("most"), F.min("n").alias("fewest"), F.sum((1 - F.pow(F.lit(beta), F.col("n"))) / (1 - beta)).alias("effective_num_samples"),
        (-F.sum(p * F.log2(p + 1e-10))).alias("entropy"))
    return a.select("total_samples", "num_classes", "majority_class", "minority_class", ratio.alias("imbalance_ratio"), "effective_num_samples", "entropy", (ratio > severe).alias("is_severely_imbalanced"))


def categorical(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """field, value, n of non-blank values: one pass over all fields."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])).alias("r")).select("r.*")
    return long.where(F.col("value").isNotNull() & (F.col("value") != "")).groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))


def leakage(splits: dict[str, DataFrame], key: str) -> DataFrame:
    """One row per pair of splits: distinct ids of both, shared ids, up to 20 of them sorted, has_leakage.

    One aggregation by id finds the splits each id is in; no pair is joined.
    """
    names = list(splits)
    tagged = reduce(DataFrame.unionByName, [d.where(present(F.col(key))).select(F.col(key).alias("id"), F.lit(n).alias("split")) for n, d in splits.items()])
    of = tagged.groupBy("id").agg(*[F.max((F.col("split") == n).cast("int")).alias(f"in_{i}") for i, n in enumerate(names)])
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1, len(names))]
    both = lambda i, j: (F.col(f"in_{i}") == 1) & (F.col(f"in_{j}") == 1)
    counts = of.agg(*[F.count_if(F.col(f"in_{i}") == 1).alias(f"n_{i}") for i in range(len(names))], *[F.count_if(both(i, j)).alias(f"o_{i}_{j}") for i, j in pairs])
    rows = counts.select(F.explode(F.array(*[F.struct(F.lit(names[i]).alias("left_split"), F.lit(names[j]).alias("right_split"), F.col(f"n_{i}").alias("left_ids"), F.col(f"n_{j}").alias("right_ids"), F.col(f"o_{i}_{j}").alias("overlap")) for i, j in pairs])).alias("r")).select("r.*")
    return rows.withColumn("has_leakage", F.col("overlap") > 0)


def leaked_ids(left: DataFrame, right: DataFrame, key: str, top: int = 20) -> DataFrame:
    """The first ids that two splits share, sorted."""
    own = lambda d: d.where(present(F.col(key))).select(key).distinct()
    return own(left).join(own(right), key, "left_semi").orderBy(key).limit(top)


def report(df: DataFrame, values: Sequence[str], categories: Sequence[str], label: str | None = None, required: Sequence[str] | None = None) -> DataFrame:
    """The unified report as tidy rows (section, metric, key, value), with warnings and advice as rows of value 1.

    With the fields given, the columns it needs are written once, narrow; joins
    and wide scans behind ``df`` are then not repeated for every section.
    """
    if required is not None:
        needed = dict.fromkeys([*values, *categories, *([label] if label else []), *[f for f in required if f in df.columns]])
        df = spool(df.select(*needed))

    def tall(one: DataFrame, section: str, key: str, metrics: Sequence[str]) -> DataFrame:
        cells = [F.struct(F.lit(section).alias("section"), F.lit(m).alias("metric"), F.lit(key).alias("key"), F.col(m).cast("double").alias("value")) for m in metrics]
        return one.select(F.explode(F.array(*cells)).alias("r")).select("r.*")

    parts = []
    own = [F.col(v).cast("double") for v in values]
    if values:  # one pass for the shapes of all values, one for all outliers
        wide = spool(df.agg(*[F.struct(*_moments(c, q)).alias(f"_{i}") for i, (c, q) in enumerate(zip(own, _quantiles(df, values, PERCENTS)))]))
        shape = wide.first()
        outside = [F.lit(0).cast("long")] * len(values)
        for i, c in enumerate(own):
            if shape[i]["count"] >= 4:
                iqr = shape[i]["q"][3] - shape[i]["q"][1]
                outside[i] = F.count_if((c < shape[i]["q"][1] - IQR_FACTOR * iqr) | (c > shape[i]["q"][3] + IQR_FACTOR * iqr))
        odd = spool(df.agg(*[n.alias(f"_{i}") for i, n in enumerate(outside)]))
    for i, v in enumerate(values):
        d = wide.select(*_shape(f"_{i}."))
        parts.append(tall(d, "distribution", v, d.columns))
        share = odd.select(F.col(f"_{i}").alias("outlier_count"), (F.col(f"_{i}") / F.lit(max(shape[i]["count"], 1))).alias("outlier_fraction"))
        parts.append(tall(share, "outliers_iqr", v, ["outlier_count", "outlier_fraction"]))
        parts.append(share.where(F.col("outlier_fraction") > OUTLIER_WARNING).select(F.lit("warning").alias("section"), F.lit("many_outliers").alias("metric"), F.lit(v).alias("key"), F.lit(1.0).alias("value")))
    c = completeness(df, required)
    parts.append(c.select(F.lit("completeness").alias("section"), F.lit("completeness").alias("metric"), F.col("field").alias("key"), F.col("completeness").alias("value")))
    parts.append(c.where("critical").select(F.lit("warning").alias("section"), F.lit("low_completeness").alias("metric"), F.col("field").alias("key"), F.lit(1.0).alias("value")))
    parts.append(df.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") < SMALL_DATA).select(F.lit("recommendation").alias("section"), F.lit("small_dataset").alias("metric"), F.lit("").alias("key"), F.lit(1.0).alias("value")))
    if label:
        b = class_balance(df, label)
        parts.append(tall(b, "class_balance", label, ["total_samples", "num_classes", "imbalance_ratio", "effective_num_samples", "entropy"]))
        parts.append(b.where("is_severely_imbalanced").select(F.lit("warning").alias("section"), F.lit("severe_imbalance").alias("metric"), F.lit(label).alias("key"), F.lit(1.0).alias("value")))
    if categories:
        k = categorical(df, categories)
        parts.append(k.select(F.lit("categorical").alias("section"), F.col("field").alias("metric"), F.col("value").alias("key"), F.col("n").cast("double").alias("value")))
    return reduce(DataFrame.unionByName, parts)


def duplicate_images(df: DataFrame, digest: str) -> DataFrame:
    """One row: rows beyond the first of each digest."""
    n = df.groupBy(digest).agg(F.count(F.lit(1)).alias("n"))
    return n.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_images"))


def gate(facts: DataFrame, min_side: int = 256, max_side: int = 8192) -> DataFrame:
    """Rows of images (height, width) with ``accepted``: both sides within the limits."""
    return facts.withColumn("accepted", F.col("height").between(min_side, max_side) & F.col("width").between(min_side, max_side))


def split_manifests(spark, folder: str, key: str = "patient_id") -> dict[str, DataFrame]:
    """Splits of ``train_manifest.json``, ``val_manifest.json`` and ``test_manifest.json`` (arrays of objects); absent ones are left out."""
    out = {}
    for n in ("train", "val", "test"):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{n}_manifest.json")
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            out[n] = spark.read.schema(f"`{key}` string").option("multiLine", "true").json(f"{folder}/{n}_manifest.json").where(present(F.col(key)))
    return out

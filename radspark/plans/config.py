"""Pipeline configuration from YAML, and the stages it names."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from radspark.operators import catalog, imaging, kernels, mammography, quality, sampling, validation
from radspark.plans import report
from radspark.plans.pipeline import Pipeline
from radspark.sources import dicom, shards


@dataclass
class StageConfig:
    name: str
    enabled: bool = True
    depends_on: tuple[str, ...] = ()
    retries: int = 0
    config: dict = field(default_factory=dict)


def load(path: str) -> dict:
    import yaml

    with open(path) as f:
        return yaml.safe_load(f) or {}


def stages(conf: dict) -> list[StageConfig]:
    return [StageConfig(s["name"], s.get("enabled", True), tuple(s.get("depends_on") or ()), int(s.get("retry_count", 0)), s.get("config") or {}) for s in conf.get("pipeline", conf).get("stages", [])]


def scan(spark: SparkSession, root: str, c: dict) -> DataFrame:
    """The files that a scan stage lets through: path, length, content."""
    extensions = c.get("extensions") or catalog.EXTENSIONS
    return catalog.large_enough(catalog.discover(spark, root, extensions, c.get("exclude_patterns") or (), content=True), int(c.get("min_file_size", catalog.MIN_BYTES)))


def validated(files: DataFrame, c: dict) -> DataFrame:
    """Files with findings; ``required_tags`` adds to the rules, ``reject_on_warning`` makes warnings count."""
    check = bool(c.get("check_pixel_data", True))
    return _judged(dicom.parse_files(files, pixels=check), c, check)


def _judged(parsed: DataFrame, c: dict, pixels: bool) -> DataFrame:
    v = validation.validate(parsed, bool(c.get("strict_mode", False)), pixels,
                            custom=[validation.Rule("error", "metadata", t, "configured tag is missing", validation.blank(validation.tag(t))) for t in c.get("required_tags", [])])
    return v.withColumn("is_valid", F.col("is_valid") & (F.size("findings") == 0)) if c.get("reject_on_warning") else v


# Settings of mammogram processing as configuration files name them.
MAMMOGRAPHY = {"target_orientation": "target", "auto_detect_orientation": "auto_detect", "breast_threshold_method": "threshold", "breast_min_area_fraction": "min_area",
               "morphology_kernel_size": "kernel", "remove_artifacts": "remove_artifacts", "pectoral_removal_enabled": "pectoral", "pectoral_margin_pixels": "pectoral_margin",
               "clahe_enabled": "clahe", "clahe_clip_limit": "clip_limit", "clahe_grid_size": "grid", "implant_detection_enabled": "implants", "crop_to_breast": "crop", "padding_pixels": "padding"}


def _settings(c: dict) -> mammography.Config:
    unknown = sorted(set(c) - set(MAMMOGRAPHY))
    if unknown:
        raise ValueError(f"unknown settings of mammography_processing: {', '.join(unknown)}")
    return mammography.Config(**{MAMMOGRAPHY[k]: tuple(v) if isinstance(v, list) else v for k, v in c.items()})


def _tagged(df: DataFrame, pixels: bool = False) -> DataFrame:
    """``df`` with the struct ``dicom``; files are parsed once, whichever stage comes first."""
    return df if "dicom" in df.columns else dicom.tagged(df, pixels)


def _own(df: DataFrame, but: tuple[str, ...] = ()) -> list[str]:
    return [c for c in df.columns if c not in but]


def _validate(df: DataFrame, c: dict) -> DataFrame:
    check = bool(c.get("check_pixel_data", True))
    rows = dicom.tagged(df, check)
    flat = rows.select(F.struct(*rows.columns).alias("row"), "path", "length", "dicom.*")
    v = _judged(flat, c, check)
    text = F.when(~F.col("is_valid"), F.to_json("findings"))
    return v.select(*[F.col("row").getField(x).alias(x) for x in rows.columns if x != "error"], F.to_json("findings").alias("findings"), text.alias("error"))


def _extract(df: DataFrame, c: dict) -> DataFrame:
    rows = _tagged(df)
    flat = rows.select(F.struct(*_own(rows, ("error",))).alias("row"), "path", "length", "dicom.*")
    m = dicom.metadata(flat, bool(c.get("extract_private_tags", True)), bool(c.get("normalize_dates", True)), carry=("row",))
    facts = F.to_json(F.struct(*[x for x in m.columns if x != "row"]))
    return m.select(*[F.col("row").getField(x).alias(x) for x in _own(rows, ("error",))], F.col("image_laterality").alias("laterality"), "view_position", "sop_instance_uid",
                    facts.alias("metadata"), F.col("extraction_error").alias("error"))


def _pixels(df: DataFrame, c: dict) -> DataFrame:
    pc = kernels.PixelConfig(target_photometric=c.get("target_photometric", "MONOCHROME2"), method=c.get("normalization", c.get("normalization_method", "percentile")),
                             low=float(c.get("percentile_low", 0.5)), high=float(c.get("percentile_high", 99.5)), window=bool(c.get("apply_voi_lut", True)), dtype=c.get("output_dtype", "float32"))
    return imaging.decode_dicom(df, pc, carry=_own(df, ("content", "error", "dicom", "image")))


def _mammograms(df: DataFrame, c: dict) -> DataFrame:
    side, view = ("laterality" if "laterality" in df.columns else None), ("view_position" if "view_position" in df.columns else None)
    return imaging.mammograms(df, side, view, config=_settings(c))


def _transforms(df: DataFrame, c: dict) -> DataFrame:
    return imaging.transform(df, kernels.from_config(c) if c.get("transforms") else kernels.mammography_preset(tuple(c.get("target_size", (2048, 1024)))))


def _report(rows: DataFrame, c: dict) -> dict:
    """Quality report of completed rows, written to ``report_output`` (HTML, and JSON beside it)."""
    names = ("patient_id", "study_instance_uid", "modality", "manufacturer", "rows", "columns", "bits_stored", "image_laterality", "view_position")
    have = rows if "metadata" in rows.columns else rows.withColumn("metadata", F.lit("{}"))
    facts = imaging.statistics(have.select("path", "metadata", "image")).select("*", *[F.get_json_object("metadata", f"$.{n}").alias(n) for n in names])
    r = quality.report(facts, ["mean", "std"], ["modality", "manufacturer"], None, names)
    path = c.get("report_output")
    if path and c.get("generate_report", True):
        if os.path.dirname(path):
            os.makedirs(os.path.dirname(path), exist_ok=True)
        report.to_html(r, path, "quality", quality.histogram(facts, "mean"))
        return {"html": path, "json": report.to_json(r, os.path.splitext(path)[0] + ".json")}
    return {"json": report.to_json(r)}


def _write(rows: DataFrame, c: dict) -> dict:
    """Shards of completed rows as configured."""
    w = shards.WriterConfig(c["output_dir"], c.get("shard_prefix", "shard"), float(c.get("shard_size_mb", 256)), int(c.get("shard_max_samples", 1000)), c.get("image_format", "npy"))
    key = F.coalesce(F.nullif(F.col("sop_instance_uid"), F.lit("")), F.col("path")) if "sop_instance_uid" in rows.columns else F.col("path")
    facts = F.col("metadata") if "metadata" in rows.columns else F.lit("{}")
    samples = rows.select(F.regexp_extract(key, r"([^/]*)$", 1).alias("key"), "image", F.lit(None).cast("string").alias("label"), facts.alias("metadata"))
    s = shards.write(samples, c.get("format", "webdataset"), w)
    return {"samples": s.total_samples, "shards": s.total_shards, "output": c["output_dir"]}


#: Stages over files, and what is done with all completed rows at the end, by the names that configurations use.
STAGES = {"validate": _validate, "extract_metadata": _extract, "pixel_processing": _pixels, "mammography_processing": _mammograms, "image_transforms": _transforms}
SINKS = {"quality_check": _report, "write_dataset": _write}


def build(conf: dict, checkpoint: str | None = None) -> Pipeline:
    """The plan of a configuration, over files (path, length, content): each stage is a hop or a projection, none shuffles."""
    p = Pipeline(conf.get("pipeline", {}).get("name", "pipeline"), checkpoint, key="path")
    for s in stages(conf):
        if s.name == "scan":
            continue
        if s.name in SINKS:
            p.at_end(s.name, lambda rows, f=SINKS[s.name], c=s.config: f(rows, c), s.enabled)
        elif s.name in STAGES:
            p.add(s.name, lambda df, f=STAGES[s.name], c=s.config: f(df, c), tuple(d for d in s.depends_on if d != "scan"), s.enabled, s.retries)
        else:
            raise ValueError(f"unknown stage {s.name}")
    return p


def split(records: DataFrame, conf: dict, key: str = "patient_id") -> DataFrame:
    """``split`` as configured: fractions and seed, by patient."""
    c = conf.get("splits", conf.get("split", {}))
    return records.withColumn("split", sampling.split_of(F.col(key), int(c.get("seed", 42)), float(c.get("train_fraction", sampling.TRAIN)), float(c.get("val_fraction", sampling.VALIDATION))))

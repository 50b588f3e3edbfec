"""Rule-based validation of header records: findings as an array of structs.

A rule is a severity, a category, a tag, a message and a Column that is true
where the rule is broken. All rules of a record are one expression.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ERROR, WARNING, INFO = "error", "warning", "info"
FINDING = "array<struct<severity:string,category:string,tag:string,message:string,value:string>>"

# DICOM tags every image must have, and those of mammograms.
UNIVERSAL_TAGS = ("PatientID", "StudyInstanceUID", "SeriesInstanceUID", "SOPInstanceUID", "SOPClassUID", "Modality", "Rows", "Columns", "BitsAllocated",
                  "BitsStored", "HighBit", "PixelRepresentation", "SamplesPerPixel", "PhotometricInterpretation")
MODALITY_TAGS = {"MG": ("ImageLaterality", "ViewPosition", "BodyPartExamined", "Manufacturer", "PresentationIntentType")}
MG_VIEWS = ("CC", "MLO", "ML", "LM", "XCCL", "SIO", "ISO", "FB", "LMO")
MG_LATERALITIES = ("L", "R")
MG_PHOTOMETRIC = ("MONOCHROME1", "MONOCHROME2")
MG_INTENTS = ("FOR PRESENTATION", "FOR PROCESSING")
TRANSFER_SYNTAXES = ("1.2.840.10008.1.2", "1.2.840.10008.1.2.1", "1.2.840.10008.1.2.4.50", "1.2.840.10008.1.2.4.70", "1.2.840.10008.1.2.4.80",
                     "1.2.840.10008.1.2.4.90", "1.2.840.10008.1.2.4.91", "1.2.840.10008.1.2.5")
PREAMBLE_BYTES, FLAT_STD = 132, 1e-6


@dataclass
class Rule:
    severity: str
    category: str
    tag: str
    message: str
    broken: Column
    value: Column | None = None

    def finding(self) -> Column:
        value = F.lit(None).cast("string") if self.value is None else self.value.cast("string")
        s = F.struct(F.lit(self.severity).alias("severity"), F.lit(self.category).alias("category"), F.lit(self.tag).alias("tag"), F.lit(self.message).alias("message"), value.alias("value"))
        return F.when(F.coalesce(self.broken, F.lit(False)), s)


def findings(rules: Sequence[Rule]) -> Column:
    return F.array_compact(F.array(*[r.finding() for r in rules])).cast(FINDING) if rules else F.array().cast(FINDING)


def is_valid(col: str | Column) -> Column:
    """No finding is an error."""
    return ~F.exists(col, lambda f: f["severity"] == ERROR)


def blank(c: Column) -> Column:
    return F.coalesce(F.trim(c.cast("string")) == "", F.lit(True))


def tag(name: str) -> Column:
    """First value of a tag in the raw tag map."""
    return F.get(F.try_element_at(F.col("tags"), F.lit(name)), F.lit(0))


def structural_rules(strict: bool = False, allowed: Sequence[str] = TRANSFER_SYNTAXES) -> list[Rule]:
    ts = tag("TransferSyntaxUID")
    return [
        Rule(ERROR, "structural", "file", "file does not exist", F.col("status") == "missing"),
        Rule(ERROR, "structural", "file", "file is too small", (F.col("status") != "missing") & (F.col("length") < PREAMBLE_BYTES), F.col("length")),
        Rule(ERROR, "structural", "file", "file cannot be parsed", (F.col("status") != "missing") & (F.col("length") >= PREAMBLE_BYTES) & (F.col("status") != "ok"), F.col("error")),
        Rule(ERROR if strict else WARNING, "structural", "TransferSyntaxUID", "transfer syntax is not allowed", ~blank(ts) & ~ts.isin(list(allowed)), ts),
    ]


def header_rules(strict: bool = False, required: dict[str, Sequence[str]] | None = None) -> list[Rule]:
    """Rules on tags; ``required`` adds tags by modality."""
    softer = ERROR if strict else WARNING
    n = lambda name: tag(name).try_cast("int")
    allocated, stored, high = n("BitsAllocated"), n("BitsStored"), n("HighBit")
    rules = [Rule(ERROR, "metadata", t, "required tag is missing", blank(tag(t))) for t in UNIVERSAL_TAGS]
    rules += [
        Rule(ERROR, "metadata", "BitsStored", "more bits stored than allocated", (stored != 0) & (allocated != 0) & (stored > allocated), stored),
        Rule(softer, "metadata", "HighBit", "high bit is not bits stored less one", (high != 0) & (stored != 0) & (high != stored - 1), high),
    ]
    by = {k: list(v) for k, v in MODALITY_TAGS.items()}
    for k, v in (required or {}).items():
        by[k] = by.get(k, []) + [t for t in v if t not in by.get(k, [])]
    m = tag("Modality")
    rules += [Rule(softer, "modality", t, f"{k} needs this tag", (m == k) & blank(tag(t))) for k, ts in by.items() for t in ts]
    among = lambda name, ok: (m == "MG") & ~blank(tag(name)) & ~tag(name).isin(list(ok))
    return rules + [
        Rule(WARNING, "modality", "ImageLaterality", "laterality is unknown", among("ImageLaterality", MG_LATERALITIES), tag("ImageLaterality")),
        Rule(WARNING, "modality", "ViewPosition", "view is unknown", among("ViewPosition", MG_VIEWS), tag("ViewPosition")),
        Rule(ERROR, "modality", "PhotometricInterpretation", "photometric interpretation is not monochrome", among("PhotometricInterpretation", MG_PHOTOMETRIC), tag("PhotometricInterpretation")),
        Rule(WARNING, "modality", "PresentationIntentType", "presentation intent is unknown", among("PresentationIntentType", MG_INTENTS), tag("PresentationIntentType")),
    ]


def pixel_rules() -> list[Rule]:
    """Rules on ``px`` (has_pixels, error, height, width, min, max, mean, std), as the pixel reader gives it."""
    n = lambda name: tag(name).try_cast("int")
    bits = F.coalesce(n("BitsStored"), F.lit(16))
    signed = n("PixelRepresentation") == 1
    low = F.when(signed, -F.pow(F.lit(2.0), bits - 1)).otherwise(0.0)
    top = F.when(signed, F.pow(F.lit(2.0), bits - 1) - 1).otherwise(F.pow(F.lit(2.0), bits) - 1)
    has, bad = F.col("px.has_pixels"), F.col("px.error").isNotNull()
    fine = has & ~bad
    return [
        Rule(ERROR, "pixel", "PixelData", "no pixel data", ~has),
        Rule(ERROR, "pixel", "PixelData", "pixel data cannot be decoded", has & bad, F.col("px.error")),
        Rule(ERROR, "pixel", "Rows/Columns", "pixel shape differs from header", fine & ((F.col("px.height") != n("Rows")) | (F.col("px.width") != n("Columns")))),
        Rule(WARNING, "pixel", "PixelData", "values exceed the range of the bits stored", fine & ((F.col("px.min") < low) | (F.col("px.max") > top)), F.col("px.max")),
        Rule(WARNING, "pixel", "PixelData", "image is constant", fine & (F.col("px.std") < FLAT_STD), F.col("px.mean")),
    ]


def validate(records: DataFrame, strict: bool = False, pixels: bool = True, required: dict[str, Sequence[str]] | None = None,
             allowed: Sequence[str] = TRANSFER_SYNTAXES, custom: Sequence[Rule] = ()) -> DataFrame:
    """Records (path, length, status, error, tags, px) with ``findings`` and ``is_valid``; structural errors end the tiers."""
    first = findings(structural_rules(strict, allowed))
    later = findings([*header_rules(strict, required), *(pixel_rules() if pixels else []), *custom])
    stop = F.col("status") != "ok"
    out = records.withColumn("findings", F.when(stop | (F.col("length") < PREAMBLE_BYTES), first).otherwise(F.concat(first, later)))
    return out.withColumn("is_valid", is_valid("findings"))


#: A check on a record's raw tags (name -> values): its findings as (severity, category, tag, message, value).
Check = Callable[[dict[str, list[str]]], Iterable[tuple[str, str, str, str, str | None]]]


def check_with(validated: DataFrame, checks: dict[str, Check]) -> DataFrame:
    """``validated`` with the findings of Python checks added, and ``is_valid`` brought up to date.

    A check that raises is a finding itself (``custom``, an error). Records
    that could not be parsed are not checked. Rules say the same inside the
    plan; functions are for what Columns cannot express.
    """
    kept = list(validated.schema.fields)
    names = [f.name for f in kept]
    at, status = names.index("tags"), names.index("status")
    found = pa.list_(pa.struct([(n, pa.string()) for n in ("severity", "category", "tag", "message", "value")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for tags, ok in zip(b.column(at).to_pylist(), b.column(status).to_pylist()):
                mine = []
                for name, f in checks.items() if ok == "ok" else ():
                    try:
                        mine += [dict(zip(("severity", "category", "tag", "message", "value"), x)) for x in f(dict(tags or []))]
                    except Exception as x:  # a broken check must not end the job
                        mine.append({"severity": ERROR, "category": "custom", "tag": name, "message": "check failed", "value": f"{type(x).__name__}: {x}"})
                out.append(mine)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, found)], names=[*names, "more"])

    schema = T.StructType([*kept, T.StructField("more", T._parse_datatype_string(FINDING))])
    out = validated.mapInArrow(run, schema).withColumn("findings", F.concat("findings", "more")).drop("more")
    return out.withColumn("is_valid", is_valid("findings"))


def rejection_log(validated: DataFrame, path: str = "path") -> DataFrame:
    """One row per finding."""
    return validated.select(path, F.explode("findings").alias("f")).select(path, "f.*")

"""Queries over files made from the tables: written, scanned, parsed, validated, decoded, sharded and read back by the engine's own operators.

Vectors stand in for 8x8 images. Some files carry a fault, by ``vec_id``, so
that rules have something to find; every vector makes a file.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from radspark.operators import catalog, imaging, kernels, sampling, validation
from radspark.plans.pipeline import Pipeline
from radspark.plans.queries import _IMG, SIDE, _packed, query, table
from radspark.sources import dicom, dicom_out, shards
from radspark.storage import open_write, qualified, shared_dir

VENDOR_NAMES = ("HOLOGIC, Inc.", "GE MEDICAL SYSTEMS", " Siemens ", "Acme")
_FILE = """f as (select vec_id, label, embedding::double[] e, vec_id % 9 as fault, 'mem/' || vec_id || '.dcm' as path,
['HOLOGIC, Inc.', 'GE MEDICAL SYSTEMS', ' Siemens ', 'Acme'][(vec_id % 4)::int + 1] as maker, '1.2.' || (vec_id // 2) as uid from embeddings)"""
_LEVELS = "list_transform(e, lambda v: greatest(least(round((v + 2.0::double) * 900.0::double), 4095.0::double), 0.0::double))"


def _files(spark, d) -> DataFrame:
    """Every vector as a DICOM file; two in a row share a SOP UID."""
    v = table(spark, d, "embeddings")
    fault = F.col("vec_id") % 9
    level = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.greatest(F.least(F.round((x + 2.0) * 900.0), F.lit(4095.0)), F.lit(0.0)).cast("int"))
    flat = F.transform(F.col("embedding"), lambda x: F.lit(7))
    tags = {
        "SOPClassUID": F.lit("1.2.840.10008.5.1.4.1.1.1.2"), "SOPInstanceUID": F.concat(F.lit("1.2."), F.floor(F.col("vec_id") / 2).cast("string")), "StudyDate": F.lit("20230213"), "Modality": F.when(fault == 8, "CT").otherwise("MG"),
        "PresentationIntentType": F.lit("FOR PRESENTATION"), "Manufacturer": F.element_at(F.array(*[F.lit(x) for x in VENDOR_NAMES]), (F.col("vec_id") % 4 + 1).cast("int")),
        "PatientID": F.when(fault != 1, F.concat(F.lit("P"), "label")), "PatientAge": F.concat(F.lpad((F.col("vec_id") % 90).cast("string"), 3, "0"), F.lit("Y")),
        "BodyPartExamined": F.lit("BREAST"), "StudyInstanceUID": F.lit("1.2.3"), "SeriesInstanceUID": F.lit("1.2.3.4"), "ViewPosition": F.when(fault == 4, "ZZ").otherwise("MLO"), "ImageLaterality": F.lit("L"),
        "SamplesPerPixel": F.lit("1"), "PhotometricInterpretation": F.lit("MONOCHROME2"), "Rows": F.lit(str(SIDE)), "Columns": F.lit(str(SIDE)), "PixelSpacing": F.lit("0.07\\0.08"), "BitsAllocated": F.lit("16"), "BitsStored": F.lit("12"),
        "HighBit": F.when(fault == 2, "15").otherwise("11"), "PixelRepresentation": F.lit("0")}
    out = dicom_out.files_of(v, F.concat(F.lit("mem/"), F.col("vec_id").cast("string"), F.lit(".dcm")), tags, F.when(fault == 5, flat).otherwise(level), keep=["vec_id"])
    broken = F.concat(F.substring("content", 1, 128), F.lit(bytearray(b"NOPE")), F.substring("content", 133, 1 << 20))
    return out.withColumn("content", F.when(F.col("vec_id") % 9 == 3, broken).otherwise(F.col("content")))


@query(f"""with {_FILE} select path, case when fault = 3 then '' else uid end sop_instance_uid, case when fault in (1, 3) then '' else 'P' || label end patient_id,
case when fault = 3 then 'OT' when fault = 8 then 'CT' else 'MG' end modality, case when fault = 3 then '' else trim(maker) end manufacturer, case when fault = 3 then '' else '20230213' end acquisition_date,
case when fault = 3 then 0 else 8 end as "rows", case when fault = 3 then 'not_dicom' else 'ok' end status, fault <> 3 as marked from f""")
def dicom_headers(spark, d):
    f = _files(spark, d)
    marks = f.select("path", catalog.is_dicom(F.col("content")).alias("marked"))
    return dicom.header_records(f).join(marks, "path").select("path", "sop_instance_uid", "patient_id", "modality", "manufacturer", "acquisition_date", "rows", "status", "marked")


@query(f"""with {_FILE} select min_by(path, path) as path, uid as sop_instance_uid from f where fault not in (3, 8) group by uid""")
def dicom_scan_dedup(spark, d):
    """A scan with a modality filter: the first file of each SOP UID."""
    return catalog.finish(dicom.header_records(_files(spark, d)), ["MG"]).select("path", "sop_instance_uid")


@query(f"""with {_FILE}, flat as (select *, list_min({_LEVELS}) = list_max({_LEVELS}) or fault = 5 constant from f)
select path, 'error' severity, 'metadata' category, 'PatientID' tag, null::varchar "value" from flat where fault = 1
union all select path, 'warning', 'metadata', 'HighBit', '15' from flat where fault = 2
union all select path, 'error', 'structural', 'file', 'no DICM mark' from flat where fault = 3
union all select path, 'warning', 'modality', 'ViewPosition', 'ZZ' from flat where fault = 4
union all select path, 'warning', 'pixel', 'PixelData', case when fault = 5 then '7.0' else 'other' end from flat where constant and fault <> 3""")
def dicom_findings(spark, d):
    v = validation.validate(dicom.parse_files(_files(spark, d), pixels=True))
    return validation.rejection_log(v).select("path", "severity", "category", "tag", "value")


@query(f"""with {_FILE} select path, fault not in (1, 3) as is_valid from f""")
def dicom_validity(spark, d):
    return validation.validate(dicom.parse_files(_files(spark, d), pixels=True)).select("path", "is_valid")


@query(f"""with {_FILE} select path as source_path, ['Hologic', 'GE Healthcare', 'Siemens Healthineers', 'Acme'][(vec_id % 4)::int + 1] manufacturer_normalized,
(vec_id % 90)::int patient_age_years, '2023-02-13' study_date, 0.07::double spacing_0, 0.08::double spacing_1, 0.0::double megapixels, 1.0::double aspect_ratio, 0.0::double rescale_intercept, 1.0::double rescale_slope,
'L' image_laterality, true is_for_presentation, false is_for_processing, true has_pixel_data, false has_voi_lut, fault <> 8 private_read from f where fault <> 3""")
def dicom_metadata(spark, d):
    m = dicom.metadata(dicom.parse_files(_files(spark, d))).where("extraction_error is null")
    return m.select("source_path", "manufacturer_normalized", F.col("patient_age_years").cast("int").alias("patient_age_years"), F.col("study_date").cast("string").alias("study_date"), F.col("pixel_spacing_mm_0").alias("spacing_0"),
                    F.col("pixel_spacing_mm_1").alias("spacing_1"), "megapixels", "aspect_ratio", "rescale_intercept", "rescale_slope", "image_laterality", "is_for_presentation", "is_for_processing",
                    "has_pixel_data", "has_voi_lut", F.col("manufacturer_private_tags_extracted").alias("private_read"))


@query(f"""with {_FILE}, p as (select path, fault, case when fault = 5 then list_transform(e, lambda v: 7.0::double) else {_LEVELS} end a from f where fault <> 3)
select path, round(case when list_max(a) = list_min(a) then 0.0::double else (list_avg(a) - list_min(a)) / (list_max(a) - list_min(a)) end, 2) mean,
case when list_max(a) = list_min(a) then 0.0::double else 1.0::double end high, 64::bigint pixels from p""")
def dicom_pixels(spark, d):
    """Files decoded and scaled to 0..1; files that cannot be read have an error instead."""
    images = imaging.decode_dicom(_files(spark, d), kernels.PixelConfig(method="min_max"))
    s = imaging.statistics(images.where("error is null"))
    return s.select("path", F.round("mean", 2).alias("mean"), "high", "pixels")


@query(f"with {_FILE} select path, 'DicomError: no DICM mark' as error from f where fault = 3")
def dicom_decode_errors(spark, d):
    return imaging.decode_dicom(_files(spark, d)).where("error is not null").select("path", "error")


def _samples(spark, d) -> DataFrame:
    return _packed(spark, d).select(F.concat(F.lit("v_"), F.lpad(F.col("vec_id").cast("string"), 9, "0")).alias("key"), "image", F.col("label").cast("string").alias("label"),
                                    F.to_json(F.struct(F.col("vec_id").alias("idx"))).alias("metadata"))


_KEYS = "k as (select 'v_' || lpad(vec_id::varchar, 9, '0') as \"key\", * from embeddings)"


@query(f"""with {_KEYS}, n as (select *, (row_number() over (order by "key") - 1) // 100 as shard from k)
select "key", label::varchar label, vec_id::varchar idx, round(list_avg(embedding::double[]), 5) mean, 'part_' || lpad(shard::varchar, 6, '0') || '.tar' as shard from n""")
def tar_round_trip(spark, d):
    """Shards written, then read back with their labels, metadata and pixels."""
    out = f"{shared_dir(spark)}/tar-{uuid.uuid4().hex}"
    shards.write(_samples(spark, d), "webdataset", shards.WriterConfig(out, "part", per_shard=100))
    back = shards.read_tar(spark, f"{out}/*.tar")
    s = imaging.statistics(back)
    return s.select("key", "label", F.get_json_object("metadata", "$.idx").alias("idx"), F.round("mean", 5).alias("mean"), F.regexp_extract("shard_path", r"([^/]*)$", 1).alias("shard"))


@query("select 'webdataset' as format, count(*)::bigint samples, ceil(count(*) / 100.0)::bigint shards, (count(*) * 256)::bigint bytes from embeddings")
def tar_write_stats(spark, d):
    """What the writer reports, and what its manifest says."""
    out = f"{shared_dir(spark)}/tar-{uuid.uuid4().hex}"
    s = shards.write(_samples(spark, d), "webdataset", shards.WriterConfig(out, "part", per_shard=100))
    m = spark.read.option("multiLine", True).json(f"{out}/manifest.json")
    return m.select("format", F.col("total_samples").alias("samples"), F.size("shards").cast("long").alias("shards"), F.lit(s.total_bytes).cast("long").alias("bytes"))


@query(f"with {_KEYS} select \"key\", coalesce(label, -1)::int label, round(list_avg(embedding::double[]), 5) mean from k")
def parquet_round_trip(spark, d):
    out = f"{shared_dir(spark)}/shards-{uuid.uuid4().hex}"
    shards.write(_samples(spark, d), "parquet", shards.WriterConfig(out, per_shard=100))
    s = imaging.statistics(spark.read.parquet(out).drop("metadata"))
    return s.select("key", "label", F.round("mean", 5).alias("mean"))


@query("select vec_id::varchar as \"key\", label::varchar as label, round(list_avg(embedding::double[]), 5) mean from embeddings")
def npy_round_trip(spark, d):
    """.npy files with side-car JSON in a folder, read back as samples."""
    import io
    import json

    import numpy as np

    out = qualified(spark, f"{shared_dir(spark)}/npy-{uuid.uuid4().hex}")

    def write(part):
        for v in part:
            buf = io.BytesIO()
            np.save(buf, imaging.decode(v["image"].asDict()))
            for ext, data in (("npy", buf.getvalue()), ("json", json.dumps({"label": v["label"]}).encode())):
                with open_write(f"{out}/{v['vec_id']}.{ext}") as f:
                    f.write(data)

    _packed(spark, d).foreachPartition(write)
    s = imaging.statistics(shards.read_npy(spark, out))
    return s.select("key", "label", F.round("mean", 5).alias("mean"))


@query("select doc_id, 'completed' as status from documents semi join labels using (doc_id) where n_chars > 1000 "
       "union all select doc_id, 'failed' from documents semi join labels using (doc_id) where n_chars <= 1000 union all select doc_id, 'resumed' from documents anti join labels using (doc_id)")
def pipeline_resume(spark, d):
    """Two runs with one checkpoint: the second passes over what the first completed."""
    docs = table(spark, d, "documents").select("doc_id", "n_chars")
    known = table(spark, d, "labels").select("doc_id").distinct()
    at = f"{shared_dir(spark)}/run-{uuid.uuid4().hex}"
    p = Pipeline(checkpoint=f"{at}/ck", key="doc_id").add("double", lambda x: x.withColumn("n_chars", F.col("n_chars") * 2)).add(
        "check", lambda x: x.withColumn("error", F.when(F.col("n_chars") <= 2000, "short")), ("double",))
    p.run(docs.join(known, "doc_id", "left_semi"), f"{at}/first")
    again = Pipeline(checkpoint=f"{at}/ck", key="doc_id").add("none", lambda x: x)
    again.run(docs.join(known, "doc_id", "left_anti"), f"{at}/second")
    left = docs.join(again.done(spark), "doc_id", "left_anti")  # what a third run would do
    first = spark.read.parquet(f"{at}/first").select("doc_id", "status")
    failed = left.join(first, "doc_id").select("doc_id", "status")
    return first.where("status = 'completed'").unionByName(failed).unionByName(spark.read.parquet(f"{at}/second").select("doc_id", F.lit("resumed").alias("status")))


def _stats(spark, d, steps) -> DataFrame:
    s = imaging.statistics(imaging.transform(_packed(spark, d).drop("label"), steps))
    return s.select("vec_id", F.round("mean", 2).alias("mean"), F.round("std", 2).alias("std"), F.round("low", 2).alias("low"), F.round("high", 2).alias("high"), "pixels")


def _stats_sql(array: str, source: str = "i") -> str:
    return (f"{_IMG}, p as (select vec_id, {array} a from {source}) select vec_id, round(list_avg(a), 2) mean, round(list_stddev_pop(a), 2) std, round(list_min(a), 2) low, round(list_max(a), 2) high, len(a)::bigint pixels from p")


@query(_stats_sql("list_transform(a, lambda v: (v - list_min(a)) / (list_max(a) - list_min(a)))"))
def kernel_zero_one(spark, d):
    return _stats(spark, d, [kernels.intensity("zero_one")])


@query(_stats_sql("list_transform(a, lambda v: (v - list_avg(a)) / list_stddev_pop(a))"))
def kernel_z_score(spark, d):
    return _stats(spark, d, [kernels.intensity("z_score")])


@query(_stats_sql("list_transform(a, lambda v: (v - 0.449::double) / 0.226::double)"))
def kernel_imagenet(spark, d):
    return _stats(spark, d, [kernels.intensity("imagenet"), kernels.add_channel, kernels.to_tensor])


def _mirror(axis: str, step: int) -> str:
    at = f"({axis} + ({step}))"
    return f"(case when {at} < 0 then -{at} when {at} > 7 then 14 - {at} else {at} end)"


_BLUR = "+".join(f"{wy * wx}::double * a[({_mirror('(k // 8)', dy)} * 8 + {_mirror('(k % 8)', dx)} + 1)::int]"
                 for dy, wy in ((-1, 0.25), (0, 0.5), (1, 0.25)) for dx, wx in ((-1, 0.25), (0, 0.5), (1, 0.25)))


@query(_stats_sql(f"list_transform(range(64), lambda k: {_BLUR})"))
def kernel_blur(spark, d):
    return _stats(spark, d, kernels.from_config({"transforms": [{"name": "GaussianBlur", "params": {"kernel_size": 3}}]}))


@query(_stats_sql("list_transform(range(32), lambda k: case when k // 4 between 2 and 5 then a[((k // 4 - 2) * 2) * 8 + (k % 4) * 2 + 1] * 0.25::double + a[((k // 4 - 2) * 2) * 8 + (k % 4) * 2 + 2] * 0.25::double "
                  "+ a[((k // 4 - 2) * 2 + 1) * 8 + (k % 4) * 2 + 1] * 0.25::double + a[((k // 4 - 2) * 2 + 1) * 8 + (k % 4) * 2 + 2] * 0.25::double else 0.0::double end)"))
def kernel_resize_pad(spark, d):
    """Halved with its aspect kept, then padded to 8 x 4."""
    return _stats(spark, d, [kernels.resize_pad((8, 4))])


@query("select doc_id, row_number() over (order by n_chars, doc_id) - 1 as place from documents")
def ordered_places(spark, d):
    return sampling.global_index(table(spark, d, "documents").select("doc_id", "n_chars"), "n_chars", "doc_id").select("doc_id", F.col("index").alias("place"))

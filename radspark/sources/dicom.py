"""DICOM files: a pure-Python Part 10 parser and the frames built on it.

Headers come from ``binaryFile`` rows in one Arrow hop, so any store that Spark
can list works; ``DicomDataSource`` lists a local tree itself instead (no
symlinks, hidden names included) and reads file heads only.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from radspark import storage
from radspark.functions import metadata as md

# Keywords, tag numbers and value representations of the DICOM data dictionary (PS3.6).
DICTIONARY = {
    "TransferSyntaxUID": ("0002,0010", "UI"), "ImageType": ("0008,0008", "CS"), "SOPClassUID": ("0008,0016", "UI"), "SOPInstanceUID": ("0008,0018", "UI"),
    "StudyDate": ("0008,0020", "DA"), "AcquisitionDate": ("0008,0022", "DA"), "AccessionNumber": ("0008,0050", "SH"), "Modality": ("0008,0060", "CS"),
    "PresentationIntentType": ("0008,0068", "CS"), "Manufacturer": ("0008,0070", "LO"), "InstitutionName": ("0008,0080", "LO"),
    "ReferringPhysicianName": ("0008,0090", "PN"), "StationName": ("0008,1010", "SH"), "StudyDescription": ("0008,1030", "LO"), "SeriesDescription": ("0008,103E", "LO"),
    "ManufacturerModelName": ("0008,1090", "LO"), "PatientID": ("0010,0020", "LO"), "PatientSex": ("0010,0040", "CS"), "PatientAge": ("0010,1010", "AS"),
    "BodyPartExamined": ("0018,0015", "CS"), "KVP": ("0018,0060", "DS"), "SoftwareVersions": ("0018,1020", "LO"), "Exposure": ("0018,1152", "IS"),
    "ExposureInuAs": ("0018,1153", "IS"), "ImagerPixelSpacing": ("0018,1164", "DS"), "AnodeTargetMaterial": ("0018,1191", "CS"), "CompressionForce": ("0018,11A2", "DS"),
    "PaddleDescription": ("0018,11A4", "LO"), "ViewPosition": ("0018,5101", "CS"), "DetectorType": ("0018,7004", "CS"), "FilterMaterial": ("0018,7050", "CS"),
    "StudyInstanceUID": ("0020,000D", "UI"), "SeriesInstanceUID": ("0020,000E", "UI"), "SeriesNumber": ("0020,0011", "IS"), "InstanceNumber": ("0020,0013", "IS"),
    "Laterality": ("0020,0060", "CS"), "ImageLaterality": ("0020,0062", "CS"), "SamplesPerPixel": ("0028,0002", "US"), "PhotometricInterpretation": ("0028,0004", "CS"),
    "PlanarConfiguration": ("0028,0006", "US"), "NumberOfFrames": ("0028,0008", "IS"), "Rows": ("0028,0010", "US"), "Columns": ("0028,0011", "US"),
    "PixelSpacing": ("0028,0030", "DS"), "BitsAllocated": ("0028,0100", "US"), "BitsStored": ("0028,0101", "US"), "HighBit": ("0028,0102", "US"),
    "PixelRepresentation": ("0028,0103", "US"), "WindowCenter": ("0028,1050", "DS"), "WindowWidth": ("0028,1051", "DS"), "RescaleIntercept": ("0028,1052", "DS"),
    "RescaleSlope": ("0028,1053", "DS"), "BreastImplantPresent": ("0028,1300", "CS"), "ModalityLUTSequence": ("0028,3000", "SQ"), "LUTDescriptor": ("0028,3002", "US"),
    "LUTData": ("0028,3006", "US"), "VOILUTSequence": ("0028,3010", "SQ"), "PixelData": ("7FE0,0010", "OW"),
}
# vendors' private tags that stand in for missing standard ones.
PRIVATE = {"Hologic": {"paddle_description": "7E01,1002", "compression_thickness_mm": "7E01,1006"},
           "GE Healthcare": {"anode_target": "0045,101D", "filter_material": "0045,101E", "compression_thickness_mm": "0045,101A"},
           "Siemens Healthineers": {"compression_thickness_mm": "0019,10BB"}}
KEYWORD = {number: word for word, (number, _) in DICTIONARY.items()}
KIND = {number: vr for number, vr in DICTIONARY.values()}
LONG_VR = frozenset(("OB", "OD", "OF", "OL", "OV", "OW", "SQ", "UC", "UN", "UR", "UT", "SV", "UV"))
BINARY = {"US": "H", "SS": "h", "UL": "I", "SL": "i", "FL": "f", "FD": "d", "AT": "I", "UV": "Q", "SV": "q"}
IMPLICIT, EXPLICIT, BIG, RLE = "1.2.840.10008.1.2", "1.2.840.10008.1.2.1", "1.2.840.10008.1.2.2", "1.2.840.10008.1.2.5"
UNDEFINED, PIXELS = 0xFFFFFFFF, "7FE0,0010"


class DicomError(ValueError):
    """The bytes cannot be read as DICOM."""


@dataclass
class Dataset:
    tags: dict[str, list[str]] = field(default_factory=dict)  # by keyword, or gggg,eeee
    tables: dict[str, tuple[int, list[int]]] = field(default_factory=dict)  # lookup tables: first value, entries
    pixels: bytes | None = None
    fragments: list[bytes] | None = None

    def first(self, word: str) -> str | None:
        v = self.tags.get(word)
        return v[0] if v else None

    def integer(self, word: str, default: int = 0) -> int:
        try:
            return int(self.first(word) or default)
        except ValueError:
            return default


class _Reader:
    def __init__(self, data: bytes, explicit: bool, order: str):
        self.data, self.explicit, self.order = data, explicit, order

    def header(self, at: int) -> tuple[str, str, int, int]:
        """(tag, VR, length, start of value)."""
        if at + 8 > len(self.data):
            raise DicomError("element header is cut off")
        group, element = struct.unpack_from(f"{self.order}HH", self.data, at)
        tag = f"{group:04X},{element:04X}"
        if group == 0xFFFE or not self.explicit:
            (n,) = struct.unpack_from(f"{self.order}I", self.data, at + 4)
            return tag, KIND.get(tag, "UN"), n, at + 8
        vr = self.data[at + 4 : at + 6].decode("latin-1")
        if not (vr.isalpha() and vr.isupper()):
            raise DicomError(f"bad value representation at {at}")
        if vr in LONG_VR:
            if at + 12 > len(self.data):
                raise DicomError("element header is cut off")
            return tag, vr, struct.unpack_from(f"{self.order}I", self.data, at + 8)[0], at + 12
        return tag, vr, struct.unpack_from(f"{self.order}H", self.data, at + 6)[0], at + 8

    def values(self, vr: str, raw: bytes) -> list[str]:
        if vr in BINARY:
            size = struct.calcsize(BINARY[vr])
            return [str(v) for v in struct.unpack_from(f"{self.order}{len(raw) // size}{BINARY[vr]}", raw)]
        text = raw.decode("utf-8", "replace") if vr in ("UT", "LT", "ST", "LO", "PN", "SH", "UC") else raw.decode("latin-1")
        return [v.strip(" \0") for v in text.split("\\")]

    def items(self, at: int, length: int, depth: int = 0) -> tuple[list[Dataset], int]:
        """Datasets of a sequence, and where it ends."""
        if depth > 16:
            raise DicomError("sequences are nested too deeply")
        out, end = [], len(self.data) if length == UNDEFINED else at + length
        while at < end:
            tag, _, n, start = self.header(at)
            if tag == "FFFE,E0DD":
                return out, start
            if tag != "FFFE,E000":
                raise DicomError("sequence item expected")
            ds, at = self.dataset(start, len(self.data) if n == UNDEFINED else min(start + n, len(self.data)), n == UNDEFINED, True, depth + 1)
            out.append(ds)
        return out, at

    def dataset(self, at: int, end: int, delimited: bool = False, pixels: bool = True, depth: int = 0) -> tuple[Dataset, int]:
        ds = Dataset()
        while at < end:
            tag, vr, n, start = self.header(at)
            if tag == "FFFE,E00D" and delimited:
                return ds, start
            word = KEYWORD.get(tag, tag)
            if tag == PIXELS:
                ds.tags["PixelData"] = [""]
                if not pixels:
                    return ds, end
                if n == UNDEFINED:
                    ds.fragments, at = [], start
                    while True:
                        t, _, k, s = self.header(at)
                        if t == "FFFE,E0DD":
                            at = s
                            break
                        ds.fragments.append(self.data[s : s + k])
                        at = s + k
                    continue
                if start + n > len(self.data):
                    raise DicomError("pixel data is cut off")
                ds.pixels, at = self.data[start : start + n], start + n
                continue
            if vr == "SQ" or n == UNDEFINED:
                inner, at = self.items(start, n, depth)
                ds.tags[word] = [""]
                for k in inner[:1]:
                    if "LUTData" in k.tags and len(k.tags.get("LUTDescriptor", ())) >= 2:
                        ds.tables[word] = (int(k.tags["LUTDescriptor"][1]), [int(v) for v in k.tags["LUTData"]])
                continue
            if start + n > len(self.data):
                raise DicomError(f"value of {word} is cut off")
            raw = self.data[start : start + n]
            if vr in ("OB", "OW", "OF", "OD", "UN") and tag not in KIND:
                ds.tags[word] = [raw.decode("latin-1").strip(" \0")] if n <= 256 else [""]
            else:
                ds.tags[word] = self.values("US" if word == "LUTData" and vr == "OW" else vr if vr in BINARY or vr not in ("OB", "OW", "UN") else KIND.get(tag, "LO"), raw)
            at = start + n
        return ds, at


def parse(data: bytes, pixels: bool = False, strict: bool = True) -> Dataset:
    """The dataset of a file. Without the preamble's mark: an error if ``strict``, else a bare implicit dataset."""
    if data[128:132] == b"DICM":
        meta = _Reader(data, True, "<")
        at, tags = 132, {}
        while at + 8 <= len(data) and data[at : at + 2] == b"\x02\x00":
            tag, vr, n, start = meta.header(at)
            if start + n > len(data):
                raise DicomError("file meta is cut off")
            tags[KEYWORD.get(tag, tag)] = meta.values(vr, data[start : start + n]) if vr not in LONG_VR else [""]
            at = start + n
        syntax = (tags.get("TransferSyntaxUID") or [IMPLICIT])[0]
    elif strict:
        raise DicomError("no DICM mark")
    else:
        at, tags, syntax = 0, {}, IMPLICIT
    body = _Reader(data, syntax != IMPLICIT, ">" if syntax == BIG else "<")
    try:
        ds, _ = body.dataset(at, len(data), pixels=pixels)
    except (struct.error, RecursionError, ValueError) as x:
        raise DicomError(str(x)) from x
    if not ds.tags:
        raise DicomError("no elements")
    ds.tags = tags | ds.tags
    return ds


def _rle_frame(data: bytes, size: int) -> list[bytes]:
    """Byte planes of a run-length frame."""
    n, *offs = struct.unpack_from("<16I", data)
    planes = []
    for k in range(n):
        part = data[offs[k] : offs[k + 1] if k + 1 < n else len(data)]
        out, at = bytearray(), 0
        while at < len(part) and len(out) < size:
            c = part[at]
            if c < 128:
                out += part[at + 1 : at + 2 + c]
                at += 2 + c
            elif c > 128:
                out += part[at + 1 : at + 2] * (257 - c)
                at += 2
            else:
                at += 1
        planes.append(bytes(out[:size]))
    return planes


def pixel_array(ds: Dataset) -> np.ndarray:
    """(H, W), (frames, H, W) or (.., H, W, samples) of the stored values."""
    h, w, bits = ds.integer("Rows"), ds.integer("Columns"), ds.integer("BitsAllocated", 16)
    spp, frames = ds.integer("SamplesPerPixel", 1) or 1, ds.integer("NumberOfFrames", 1) or 1
    syntax = ds.first("TransferSyntaxUID") or IMPLICIT
    if h <= 0 or w <= 0 or bits not in (8, 16, 32):
        raise DicomError("no usable pixel layout")
    kind = np.dtype(f"{'>' if syntax == BIG else '<'}{'i' if ds.integer('PixelRepresentation') else 'u'}{bits // 8}")
    planar = ds.integer("PlanarConfiguration")
    if ds.fragments is not None:
        if syntax != RLE:
            raise DicomError(f"transfer syntax {syntax} needs a codec that is not here")
        out = []
        for f in ds.fragments[1 : 1 + frames]:
            planes, k = _rle_frame(f, h * w), bits // 8
            if len(planes) != k * spp or any(len(p) < h * w for p in planes):
                raise DicomError("run-length planes are incomplete")
            samples = [np.stack([np.frombuffer(p, np.uint8) for p in reversed(planes[s * k : s * k + k])], axis=1).copy().view(kind).reshape(h, w) for s in range(spp)]
            out.append(np.stack(samples, axis=-1) if spp > 1 else samples[0])
        arr = np.stack(out) if frames > 1 else out[0]
    else:
        if ds.pixels is None:
            raise DicomError("no pixel data")
        want = h * w * spp * frames * (bits // 8)
        if len(ds.pixels) < want:
            raise DicomError(f"pixel data holds {len(ds.pixels)} of {want} bytes")
        arr = np.frombuffer(ds.pixels[:want], kind)
        if spp > 1:
            arr = arr.reshape(frames, spp, h, w).transpose(0, 2, 3, 1) if planar else arr.reshape(frames, h, w, spp)
        else:
            arr = arr.reshape(frames, h, w)
        arr = arr[0] if frames == 1 else arr
    return arr.astype(kind.newbyteorder("="))


PX = "struct<has_pixels:boolean,error:string,height:int,width:int,min:double,max:double,mean:double,std:double>"
PARSED = f"path string, length long, status string, error string, file_hash string, tags map<string,array<string>>, px {PX}"


#: Bytes that a header-only read takes first; a header that is longer costs a second, whole read.
HEAD = 1 << 16


def with_heads(files: DataFrame, head: int = HEAD) -> DataFrame:
    """path, length, content of files (path, length): content up to ``head`` bytes, or all where the header is longer.

    Files are opened in the executors and read as far as needed. Stores that
    only Spark's readers open are read whole by those.
    """
    spark = files.sparkSession
    some = files.select("path").first()
    if some and not storage.can_open(some[0]):
        whole = spark.read.format("binaryFile").load([r["path"] for r in files.select("path").collect()])
        return whole.select("path", "length", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, (path, length) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                try:
                    with storage.open_read(path) as f:
                        data = f.read(head)
                        if len(data) < (length or 0) and data[128:132] == b"DICM":
                            try:
                                parse(data)
                            except DicomError:
                                data += f.read()
                except OSError:
                    data = None
                yield pa.RecordBatch.from_arrays([b.column(0).slice(k, 1), b.column(1).slice(k, 1), pa.array([data], pa.binary())], names=["path", "length", "content"])

    return files.select("path", F.col("length").cast("long").alias("length")).mapInArrow(run, "path string, length long, content binary")


def _inspect(data: bytes | None, pixels: bool, strict: bool) -> dict:
    """status, error, tags and px of one file's bytes."""
    out = {"status": "ok", "error": None, "tags": {}, "px": None}
    data = data or b""
    if data[128:132] != b"DICM" and strict:
        return out | {"status": "not_dicom", "error": "no DICM mark"}
    try:
        ds = parse(data, pixels, strict)
    except DicomError as x:
        return out | {"status": "parse_error", "error": str(x)}
    px = {"has_pixels": "PixelData" in ds.tags}
    if pixels and px["has_pixels"]:
        try:
            a = pixel_array(ds).astype(np.float64)
            side = a.shape[-2:]
            px |= {"height": side[0], "width": side[1], "min": float(a.min()), "max": float(a.max()), "mean": float(a.mean()), "std": float(a.std())}
        except (DicomError, ValueError) as x:
            px["error"] = str(x)
    return out | {"tags": ds.tags, "px": px}


_TEXT = pa.string()
_PX = pa.struct([("has_pixels", pa.bool_()), ("error", _TEXT), ("height", pa.int32()), ("width", pa.int32()), ("min", pa.float64()), ("max", pa.float64()), ("mean", pa.float64()), ("std", pa.float64())])
_FACTS = pa.struct([("status", _TEXT), ("error", _TEXT), ("tags", pa.map_(_TEXT, pa.list_(_TEXT))), ("px", _PX)])


def tagged(files: DataFrame, pixels: bool = False, strict: bool = True, column: str = "dicom") -> DataFrame:
    """``files`` (with content) and a struct ``column``: status, error, tags, px. One hop, all columns carried, no join."""
    kept = [f for f in files.schema.fields if f.name != column]
    schema = T.StructType([*kept, T.StructField(column, T._parse_datatype_string(f"struct<status:string,error:string,tags:map<string,array<string>>,px:{PX}>"))])
    at = [f.name for f in kept].index("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            facts = [_inspect(c.as_py(), pixels, strict) for c in b.column(at)]
            rows = [f | {"tags": list(f["tags"].items())} for f in facts]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rows, _FACTS)], names=[*[f.name for f in kept], column])

    return files.select(*[F.col(f"`{f.name}`") for f in kept]).mapInArrow(run, schema)


def parse_files(files: DataFrame, pixels: bool = False, strict: bool = True) -> DataFrame:
    """path, length, status (ok, not_dicom, parse_error), error, file_hash, tags and px of files (path, length, content)."""
    hashed = files.select("path", "length", md.head_hash(F.col("content")).alias("file_hash"), "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            facts = [_inspect(c.as_py(), pixels, strict) for c in b.column(3)]
            col = lambda n, kind: pa.array([list(f[n].items()) if n == "tags" else f[n] for f in facts], kind)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), col("status", _TEXT), col("error", _TEXT), b.column(2), col("tags", pa.map_(_TEXT, pa.list_(_TEXT))), col("px", _PX)],
                                             names=["path", "length", "status", "error", "file_hash", "tags", "px"])

    return hashed.mapInArrow(run, PARSED)


def _tag(word: str, k: int = 0):
    return F.trim(F.get(F.try_element_at(F.col("tags"), F.lit(word)), F.lit(k)))


def header_records(files: DataFrame) -> DataFrame:
    """Catalogue records; a record without SOP UID is a parse error, an absent AcquisitionDate falls back to StudyDate."""
    p = parse_files(files)
    text = lambda w: F.coalesce(_tag(w), F.lit(""))
    whole = lambda w: F.coalesce(_tag(w).try_cast("int"), F.lit(0))
    date = F.coalesce(_tag("AcquisitionDate"), _tag("StudyDate"), F.lit(""))
    no_uid = (F.col("status") == "ok") & (text("SOPInstanceUID") == "")
    return p.select(
        "path", F.col("length").alias("file_size_bytes"), text("SOPInstanceUID").alias("sop_instance_uid"), text("StudyInstanceUID").alias("study_instance_uid"),
        text("SeriesInstanceUID").alias("series_instance_uid"), text("PatientID").alias("patient_id"), F.coalesce(_tag("Modality"), F.lit("OT")).alias("modality"),
        text("Manufacturer").alias("manufacturer"), date.alias("acquisition_date"), whole("Rows").alias("rows"), whole("Columns").alias("columns"), whole("BitsAllocated").alias("bits_allocated"),
        text("TransferSyntaxUID").alias("transfer_syntax_uid"), "file_hash", F.when(no_uid, "parse_error").otherwise(F.col("status")).alias("status"), F.when(no_uid, "no SOPInstanceUID").otherwise(F.col("error")).alias("error"))


def metadata(parsed: DataFrame, private: bool = True, iso_dates: bool = True, carry: Sequence[str] = ()) -> DataFrame:
    """Normalised metadata of parsed files, beside the columns ``carry``; failed files keep ``extraction_error`` and null fields."""
    s = lambda w: md.blank_to_null(_tag(w))
    e = lambda w: F.coalesce(_tag(w), F.lit(""))
    i = lambda w, d=0: F.coalesce(_tag(w).try_cast("int"), F.lit(d))
    d = lambda w: md.number(_tag(w))
    vendor = md.vendor(e("Manufacturer"))
    mg = e("Modality") == "MG"

    def filled(standard, name: str, kind: str = "string"):
        out = standard
        for v, table in PRIVATE.items():
            if private and name in table:
                raw = md.blank_to_null(_tag(table[name]))
                out = F.when(mg & (vendor == v), F.coalesce(out, raw.try_cast(kind))).otherwise(out)
        return out

    spacing = F.coalesce(F.try_element_at("tags", F.lit("PixelSpacing")), F.try_element_at("tags", F.lit("ImagerPixelSpacing")))
    mm = F.when(F.size(spacing) >= 2, F.array(F.trim(spacing[0]).try_cast("double"), F.trim(F.get(spacing, F.lit(1))).try_cast("double")))
    mm = F.when(~F.exists(mm, lambda v: v.isNull()), mm)
    intent = s("PresentationIntentType")
    cols = {
        "sop_instance_uid": e("SOPInstanceUID"), "study_instance_uid": e("StudyInstanceUID"), "series_instance_uid": e("SeriesInstanceUID"), "patient_id": e("PatientID"), "accession_number": e("AccessionNumber"),
        "patient_age_years": md.age_years(_tag("PatientAge")), "patient_sex": s("PatientSex"), "study_date": md.iso_date(_tag("StudyDate")) if iso_dates else e("StudyDate"),
        "study_description": s("StudyDescription"), "institution_name": s("InstitutionName"), "referring_physician": s("ReferringPhysicianName"), "modality": e("Modality"),
        "series_description": s("SeriesDescription"), "series_number": _tag("SeriesNumber").try_cast("int"), "instance_number": _tag("InstanceNumber").try_cast("int"),
        "image_type": F.array_join(F.try_element_at("tags", F.lit("ImageType")), "\\"), "manufacturer": e("Manufacturer"), "manufacturer_normalized": vendor, "manufacturer_model": s("ManufacturerModelName"),
        "software_version": s("SoftwareVersions"), "station_name": s("StationName"), "detector_type": s("DetectorType"), "rows": i("Rows"), "columns": i("Columns"), "bits_allocated": i("BitsAllocated"),
        "bits_stored": i("BitsStored"), "pixel_representation": i("PixelRepresentation"), "photometric_interpretation": e("PhotometricInterpretation"), "samples_per_pixel": F.greatest(i("SamplesPerPixel", 1), F.lit(1)),
        "pixel_spacing_mm": mm, "pixel_spacing_mm_0": F.get(mm, F.lit(0)), "pixel_spacing_mm_1": F.get(mm, F.lit(1)), "transfer_syntax_uid": e("TransferSyntaxUID"), "window_center": d("WindowCenter"), "window_width": d("WindowWidth"),
        "rescale_intercept": md.intercept(_tag("RescaleIntercept")), "rescale_slope": md.slope(_tag("RescaleSlope")), "has_voi_lut": F.array_contains(F.map_keys("tags"), "VOILUTSequence"),
        "image_laterality": F.coalesce(s("ImageLaterality"), s("Laterality")), "view_position": s("ViewPosition"), "body_part": s("BodyPartExamined"), "presentation_intent": intent,
        "is_for_processing": F.coalesce(intent == "FOR PROCESSING", F.lit(False)), "is_for_presentation": F.coalesce(intent == "FOR PRESENTATION", F.lit(False)),
        "breast_implant_present": md.implant_flag(_tag("BreastImplantPresent")), "compression_force_n": d("CompressionForce"), "kvp": d("KVP"), "exposure_uas": md.exposure_uas(_tag("ExposureInuAs"), _tag("Exposure")),
        "anode_target": filled(s("AnodeTargetMaterial"), "anode_target"), "filter_material": filled(s("FilterMaterial"), "filter_material"), "paddle_description": filled(s("PaddleDescription"), "paddle_description"),
        "compression_thickness_mm": filled(F.lit(None).cast("double"), "compression_thickness_mm", "double"), "has_pixel_data": F.array_contains(F.map_keys("tags"), "PixelData"),
        "megapixels": md.megapixels(i("Rows"), i("Columns")), "aspect_ratio": md.aspect_ratio(i("Rows"), i("Columns")), "manufacturer_private_tags_extracted": F.lit(private) & mg,
    }
    ok = F.col("status") == "ok"
    return parsed.select(*carry, F.col("path").alias("source_path"), *[F.when(ok, c).alias(n) for n, c in cols.items()], F.when(~ok, F.coalesce("error", "status")).alias("extraction_error"))


class DicomDataSource(DataSource):
    """``spark.read.format("dicom").load(root)``: path, length, status, tags of a local tree, pixels left out."""

    @classmethod
    def name(cls) -> str:
        return "dicom"

    def schema(self) -> str:
        return "path string, length long, status string, error string, tags map<string,array<string>>"

    def reader(self, schema):
        return _DicomReader(self.options)


class _Files(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(0)
        self.paths = paths


class _DicomReader(DataSourceReader):
    def __init__(self, options):
        self.root = options.get("path", "")
        self.per = int(options.get("filesPerPartition", "500"))

    def partitions(self):
        if not os.path.isdir(self.root):
            raise FileNotFoundError(self.root)
        paths = sorted(os.path.join(d, f) for d, _, fs in os.walk(self.root) for f in fs if f != "DICOMDIR")
        return [_Files(paths[k : k + self.per]) for k in range(0, len(paths), self.per)] or [_Files([])]

    def read(self, partition):
        for p in partition.paths:
            size, status, err, tags = os.path.getsize(p), "ok", None, {}
            with open(p, "rb") as f:
                head = f.read(132)
                if head[128:132] != b"DICM":
                    status, err = "not_dicom", "no DICM mark"
                else:
                    try:
                        tags = parse(head + f.read(1 << 20)).tags  # headers are far smaller than this
                    except DicomError:
                        try:
                            f.seek(0)
                            tags = parse(f.read()).tags
                        except DicomError as x:
                            status, err = "parse_error", str(x)
            yield p, size, status, err, tags

import os

import numpy as np
import pytest

from radspark.operators import catalog, imaging, validation
from radspark.sources import dicom
from tests.dicom_writer import dicom as make

PX = np.arange(64, dtype=np.uint16).reshape(8, 8)


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("tree")
    (root / "deep").mkdir()
    files = {
        "a.dcm": make(pixels=PX), "b.DICOM": make({"SOPInstanceUID": "1.2.9", "Manufacturer": "GE MEDICAL SYSTEMS", "Modality": "CT"}, PX, syntax=dicom.IMPLICIT),
        "deep/c": make({"SOPInstanceUID": "1.2.3.4.5"}, PX), "bad.dcm": b"\0" * 128 + b"DICM" + b"\xff" * 400, "plain.dcm": b"x" * 2000, "tiny.dcm": b"x" * 50, "DICOMDIR": make(), "note.bak": b"x" * 2000,
        "nouid.dcm": make(pixels=PX, drop=("SOPInstanceUID",)), "flat.dcm": make({"SOPInstanceUID": "1.7", "HighBit": 5, "ViewPosition": "XX"}, np.full((8, 8), 9, np.uint16)),
        "big.dcm": make({"SOPInstanceUID": "1.8", "BitsStored": 4, "HighBit": 3}, PX), "shape.dcm": make({"SOPInstanceUID": "1.9", "TransferSyntaxUID": None}, PX, tables={"VOILUTSequence": (0, [5, 6, 7])}),
        "rows.dcm": make({"SOPInstanceUID": "1.10", "Rows": 0, "PatientAge": "018M", "BreastImplantPresent": "yes", "7E01,1006": "55"}),
    }
    for n, b in files.items():
        (root / n).write_bytes(b)
    return str(root)


def test_parser_reads_both_encodings_and_tables():
    for syntax in (dicom.EXPLICIT, dicom.IMPLICIT):
        for undefined in (False, True):
            ds = dicom.parse(make({"WindowCenter": ["40", "50"], "7E01,1002": "PADDLE"}, PX, syntax, tables={"ModalityLUTSequence": (2, [10, 20, 30])}, undefined=undefined), pixels=True)
            assert ds.first("SOPInstanceUID") == "1.2.3.4.5" and ds.tags["WindowCenter"] == ["40", "50"] and ds.tags["7E01,1002"] == ["PADDLE"]
            assert ds.tables["ModalityLUTSequence"] == (2, [10, 20, 30])
            assert (dicom.pixel_array(ds) == PX).all()


def test_parser_strict_and_lenient():
    bare = make(preamble=False, syntax=dicom.IMPLICIT)
    with pytest.raises(dicom.DicomError):
        dicom.parse(bare)
    assert dicom.parse(bare, strict=False).first("PatientID") == "P1"
    with pytest.raises(dicom.DicomError):
        dicom.parse(make(pixels=PX)[:-40], pixels=True)


def test_run_length_pixels():
    low, high = (PX & 255).astype(np.uint8).tobytes(), (PX >> 8).astype(np.uint8).tobytes()
    planes = [bytes([257 - 64, 0]), bytes([63]) + low]
    head = np.zeros(16, "<u4")
    head[:3] = [2, 64, 64 + len(planes[0])]
    frame = head.tobytes() + planes[0] + planes[1]
    ds = dicom.parse(make(fragments=[frame], syntax=dicom.RLE), pixels=True)
    assert high == b"\0" * 64 and (dicom.pixel_array(ds) == PX).all()
    jpeg = dicom.parse(make(fragments=[b"\xff\xd8"], syntax="1.2.840.10008.1.2.4.90"), pixels=True)
    with pytest.raises(dicom.DicomError, match="codec"):
        dicom.pixel_array(jpeg)


def test_signed_and_colour_pixels():
    s = dicom.parse(make({"PixelRepresentation": 1}, (PX.astype(np.int16) - 30)), pixels=True)
    assert dicom.pixel_array(s).min() == -30
    rgb = np.arange(192, dtype=np.uint8).reshape(8, 8, 3)
    ds = dicom.parse(make({"SamplesPerPixel": 3, "BitsAllocated": 8, "Rows": 8, "Columns": 8}, rgb.reshape(24, 8), drop=()) , pixels=True)
    ds.tags["Rows"], ds.tags["Columns"] = ["8"], ["8"]
    assert (dicom.pixel_array(ds) == rgb).all()


def test_scan(spark, tree):
    r = catalog.scan(spark, tree, least=100).collect()
    by = {x["sop_instance_uid"]: x for x in r}
    assert set(by) == {"1.2.3.4.5", "1.2.9", "1.7", "1.8", "1.9", "1.10"}
    assert by["1.2.3.4.5"]["path"].endswith("/a.dcm") and by["1.2.3.4.5"]["acquisition_date"] == "20230213"
    assert len(by["1.7"]["file_hash"]) == 64
    assert [x["sop_instance_uid"] for x in catalog.scan(spark, tree, modalities=["CT"], least=100).collect()] == ["1.2.9"]
    files = catalog.discover(spark, tree, content=True)
    rec = dicom.header_records(catalog.large_enough(files, 100))
    c = catalog.counters(rec).first()
    assert (c["scanned"], c["found"], c["non_dicom"], c["unreadable"], c["duplicates"]) == (10, 7, 1, 2, 1)
    assert catalog.scan_paths(spark, [f"{tree}/a.dcm", f"{tree}/plain.dcm"]).count() == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        catalog.discover(spark, tree + "/none").count()


def test_discovery_prunes_content(spark, tree):
    plan = catalog.large_enough(catalog.discover(spark, tree))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1] and "GreaterThanOrEqual(length" in plan


def test_data_source(spark, tree):
    spark.dataSource.register(dicom.DicomDataSource)
    rows = {os.path.basename(r["path"]): r for r in spark.read.format("dicom").option("filesPerPartition", "3").load(tree).collect()}
    assert rows["a.dcm"]["tags"]["PatientID"] == ["P1"] and rows["plain.dcm"]["status"] == "not_dicom" and rows["bad.dcm"]["status"] == "parse_error" and "DICOMDIR" not in rows


def test_validation(spark, tree):
    files = catalog.discover(spark, tree, content=True)
    v = {os.path.basename(r["path"]): r for r in validation.validate(dicom.parse_files(files, pixels=True)).collect()}
    tags = lambda n: {(f["severity"], f["tag"]) for f in v[n]["findings"]}
    assert v["a.dcm"]["is_valid"] and not v["a.dcm"]["findings"]
    assert tags("tiny.dcm") == {("error", "file")} and tags("bad.dcm") == {("error", "file")}
    assert ("error", "SOPInstanceUID") in tags("nouid.dcm")
    assert {("warning", "HighBit"), ("warning", "ViewPosition"), ("warning", "PixelData")} <= tags("flat.dcm") and v["flat.dcm"]["is_valid"]
    assert tags("big.dcm") == {("warning", "PixelData")}
    assert ("error", "PixelData") in tags("rows.dcm")
    strict = {os.path.basename(r["path"]): r for r in validation.validate(dicom.parse_files(files, pixels=True), strict=True, required={"CT": ["KVP"]}).collect()}
    assert not strict["flat.dcm"]["is_valid"] and ("error", "KVP") in {(f["severity"], f["tag"]) for f in strict["b.DICOM"]["findings"]}
    log = validation.rejection_log(validation.validate(dicom.parse_files(files)))
    assert set(log.columns) == {"path", "severity", "category", "tag", "message", "value"}


def test_metadata(spark, tree):
    m = {os.path.basename(r["source_path"]): r for r in dicom.metadata(dicom.parse_files(catalog.discover(spark, tree, content=True))).collect()}
    a = m["a.dcm"]
    assert a["study_date"] == "2023-02-13" and a["manufacturer_normalized"] == "Hologic" and a["rows"] == 8 and a["rescale_slope"] == 1.0 and a["is_for_presentation"] and a["has_pixel_data"]
    assert m["b.DICOM"]["manufacturer_normalized"] == "GE Healthcare"
    r = m["rows.dcm"]
    assert r["rows"] == 0 and r["patient_age_years"] == 1 and r["breast_implant_present"] and r["compression_thickness_mm"] == 55.0
    assert m["shape.dcm"]["has_voi_lut"] and m["bad.dcm"]["extraction_error"] and m["bad.dcm"]["rows"] is None
    assert len(m["a.dcm"]) >= 54


def test_decode(spark, tree):
    got = {os.path.basename(r["path"]): r for r in imaging.decode_dicom(catalog.discover(spark, tree, content=True)).collect()}
    img = imaging.decode(got["a.dcm"]["image"].asDict())
    assert img.shape == (8, 8) and img.dtype == np.float32 and img.min() == 0 and img.max() == 1
    assert got["bad.dcm"]["image"] is None and got["bad.dcm"]["error"]

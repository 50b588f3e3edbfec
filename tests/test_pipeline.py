import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from radspark import session
from radspark.functions import metadata as md
from radspark.operators import imaging, metrics, quality, sampling
from radspark.plans import cli, config, report
from radspark.plans.pipeline import Pipeline, map_rows
from radspark.sources import shards
from radspark.streaming import ingest
from tests.dicom_writer import dicom as make


def samples(spark, n=10):
    rows = [(f"sample_{i:04d}", imaging.encode(np.full((1, 8, 8), i, np.float32)), str(i % 2), json.dumps({"idx": i})) for i in range(n)]
    return spark.createDataFrame(rows, shards.SAMPLE)


def test_tar_round_trip(spark, tmp_path):
    for fmt in ("npy", "npz"):
        out = str(tmp_path / fmt)
        s = shards.write(samples(spark), "webdataset", shards.WriterConfig(out, per_shard=5, image_format=fmt))
        assert s.total_shards == 2 and s.total_samples == 10 and s.total_bytes == 10 * 256
        m = json.load(open(f"{out}/manifest.json"))
        assert m["shards"] == ["shard_000000.tar", "shard_000001.tar"]
        (tmp_path / fmt / "broken.tar").write_bytes(b"nothing")
        back = {r["key"]: r for r in shards.read_tar(spark, f"{out}/*.tar").collect()}
        assert len(back) == 10 and back["sample_0003"]["label"] == "1" and imaging.decode(back["sample_0003"]["image"].asDict())[0, 0] == 3
        assert json.loads(back["sample_0003"]["metadata"])["idx"] == 3
    b = list(shards.batches(shards.read_tar(spark, f"{out}/*.tar", seed=1), 4, buffer=3))
    assert [len(x["key"]) for x in b] == [4, 4, 2] and b[0]["image"].shape == (4, 8, 8)
    assert len(list(shards.batches(shards.read_tar(spark, f"{out}/*.tar"), 4, drop_last=True))) == 2


def test_shards_roll_by_bytes(spark, tmp_path):
    c = shards.WriterConfig(str(tmp_path), shard_mb=600 / 1048576, per_shard=8)
    got = [r["shard"] for r in shards.assign_shards(samples(spark), c).orderBy("key").collect()]
    assert got == [0, 0, 0, 1, 1, 1, 2, 2, 3, 3]
    with pytest.raises(ValueError):
        shards.WriterConfig("x", image_format="png")
    with pytest.raises(ValueError):
        shards.write(samples(spark), "zip", c)
    with pytest.raises((RuntimeError, NotImplementedError)):
        shards.write(samples(spark), "hdf5", c)


def test_other_formats(spark, tmp_path):
    p = shards.write(samples(spark), "parquet", shards.WriterConfig(str(tmp_path / "p"), per_shard=4))
    assert p.total_shards == 3 and spark.read.parquet(str(tmp_path / "p")).where("shard = 2").count() == 2
    b = shards.write(samples(spark), "blobs", shards.WriterConfig(str(tmp_path / "b")))
    v = spark.read.parquet(str(tmp_path / "b")).where("key = 'sample_0007'").first()["value"]
    img, label, meta = shards.read_blob(bytes(v))
    assert b.total_samples == 10 and img[0, 0] == 7 and label == "1" and meta == {"idx": 7}
    d = tmp_path / "npy"
    d.mkdir()
    np.save(d / "x.npy", np.ones((4, 4), np.float32))
    (d / "x.json").write_text('{"label": 3}')
    np.save(d / "y.npy", np.zeros((4, 4), np.float32))
    r = {x["key"]: x for x in shards.read_npy(spark, str(d)).collect()}
    assert r["x"]["label"] == "3" and r["y"]["label"] is None
    shards.training_manifest(spark.createDataFrame([("s3://b/2.tar",), ("s3://b/1.tar",), ("s3://b/x.txt",)], "path string"), str(tmp_path / "m"))
    assert [json.loads(x["value"])["prefix"] for x in spark.read.text(str(tmp_path / "m")).collect()] == ["s3://b/1.tar", "s3://b/2.tar"]


def test_stage_order_and_failures(spark, tmp_path):
    p = Pipeline(checkpoint=str(tmp_path / "ck"))
    p.add("c", lambda d: d, ("b",)).add("b", lambda d: d.withColumn("v", F.col("v") * 2).withColumn("error", F.when(F.col("key") == "bad", "broken")), ("a",)).add("a", lambda d: d.withColumn("v", F.col("v") + 1)).add("off", lambda d: 1 / 0, enabled=False)
    assert p.order() == ["a", "b", "c", "off"]
    df = spark.createDataFrame([("good", 10), ("bad", 20), ("good2", 30)], "key string, v int")
    r = p.run(df, str(tmp_path / "out"))
    assert (r.total_processed, r.total_failed, r.total_skipped) == (2, 1, 0) and r.errors == [("bad", "b", "broken")]
    assert sorted(x["v"] for x in spark.read.parquet(str(tmp_path / "out")).where("status = 'completed'").collect()) == [22, 62]
    again = p.run(df, str(tmp_path / "out"))
    assert (again.total_processed, again.total_failed, again.total_skipped) == (0, 1, 2)
    with pytest.raises(ValueError):
        Pipeline().add("x", lambda d: d, ("y",)).add("y", lambda d: d, ("x",)).order()


def test_map_rows(spark):
    df = spark.createDataFrame([(i, i) for i in range(1, 5)], "k int, v int")
    r = {x["key"]: x for x in map_rows(df, lambda v: int(v) ** 2 if v != 3 else 1 / 0, "k", "v", retries=1).collect()}
    assert r["2"]["output"] == "4" and not r["3"]["success"] and "ZeroDivision" in r["3"]["error"]
    import time

    slow = {x["key"]: x for x in map_rows(df, lambda v: time.sleep(5 * (v == 2)) or int(v), "k", "v", timeout=0.5).collect()}
    assert "TimeoutError" in slow["2"]["error"] and slow["1"]["output"] == "1" and sum(x["success"] for x in slow.values()) == 3


def test_progress_is_told(spark, tmp_path):
    told = []
    slow = F.udf(lambda v: __import__("time").sleep(0.3) or v, "long")
    p = Pipeline(key="id").add("wait", lambda d: d.withColumn("v", slow("id")))
    assert p.run(spark.range(0, 8, 1, 8), str(tmp_path / "o"), progress=told.append).total_processed == 8
    assert told and all(0 <= t["fraction"] <= 1 and t["tasks"] >= t["done"] for t in told)


def test_python_checks(spark, tmp_path):
    from radspark.operators import catalog, validation
    from radspark.sources import dicom

    rows = [("a", make({"SOPInstanceUID": "1.1"}, np.arange(64, dtype=np.uint16).reshape(8, 8))), ("b", b"x" * 200)]
    files = spark.createDataFrame([(p, len(c), bytearray(c)) for p, c in rows], "path string, length long, content binary")
    checks = {"uid": lambda t: [("warning", "custom", "SOPInstanceUID", "short", t["SOPInstanceUID"][0])], "bad": lambda t: t["nothing"]}
    got = {r["path"]: r for r in validation.check_with(validation.validate(dicom.parse_files(files)), checks).collect()}
    assert [(f["severity"], f["tag"], f["value"]) for f in got["a"]["findings"] if f["category"] == "custom"] == [("warning", "SOPInstanceUID", "1.1"), ("error", "bad", "KeyError: 'nothing'")]
    assert not got["a"]["is_valid"] and len(got["b"]["findings"]) == 1
    (tmp_path / "one.dcm").write_bytes(rows[0][1])
    listed = {r["path"].rsplit("/", 1)[1]: r["status"] for r in catalog.listed(spark, [str(tmp_path / "one.dcm"), str(tmp_path / "none.dcm")]).collect()}
    assert listed == {"one.dcm": None, "none.dcm": "missing"} and catalog.scan_paths(spark, [str(tmp_path / "one.dcm"), str(tmp_path / "none.dcm")]).count() == 1
    missing = catalog.listed(spark, [str(tmp_path / "none.dcm")]).selectExpr("path", "length", "status", "string(null) error", "map('x', array('')) tags", f"cast(null as {dicom.PX}) px")
    assert validation.validate(missing).first()["findings"][0]["message"] == "file does not exist"


def test_heads_only(spark, tmp_path, monkeypatch):
    """A scan reads the head of a file, not its pixels; a header longer than that is still read."""
    from radspark.sources import dicom

    big = np.zeros((1024, 1024), np.uint16)
    (tmp_path / "a.dcm").write_bytes(make({"SOPInstanceUID": "1.1"}, big))
    (tmp_path / "b.dcm").write_bytes(make({"SOPInstanceUID": "1.2", "StudyDescription": "x" * 60000, "SeriesDescription": "y" * 60000}, big))
    files = spark.createDataFrame([(f"file:{tmp_path}/{n}.dcm", 2 << 20) for n in "ab"], "path string, length long")
    heads = {r["path"][-5]: len(r["content"]) for r in dicom.with_heads(files).collect()}
    assert heads["a"] == dicom.HEAD and heads["b"] > 2 << 20
    assert sorted(r["sop_instance_uid"] for r in dicom.header_records(dicom.with_heads(files)).collect()) == ["1.1", "1.2"]


def test_random_access(spark, tmp_path):
    shards.write(samples(spark), "parquet", shards.WriterConfig(str(tmp_path / "p"), per_shard=4))
    a = shards.RandomAccess(str(tmp_path / "p"), cache=2)
    assert len(a) == 10 and a[3]["image"][0, 0] == 3 and a["sample_0007"]["metadata"] == {"idx": 7} and a[3] is a["sample_0003"]
    with pytest.raises(KeyError):
        a["none"]


def test_quality(spark):
    rng = np.random.default_rng(0)
    v = [(float(x),) for x in [*rng.normal(0.5, 0.1, 990), *[5.0] * 10]]
    df = spark.createDataFrame(v, "v double")
    d = quality.distribution(df, "v").first()
    a = np.array(v).ravel()
    assert d["count"] == 1000 and np.isclose(d["std"], a.std()) and np.isclose(d["p95"], np.percentile(a, 95)) and np.isclose(d["skewness"], ((a - a.mean()) ** 3).mean() / a.std() ** 3)
    assert quality.outliers_iqr(df, "v").count() >= 10 and quality.outliers_zscore(df, "v").count() == 10
    h = quality.histogram(df, "v").orderBy("bin").collect()
    assert [r["count"] for r in h] == np.histogram(a, 50)[0].tolist()
    flat = spark.createDataFrame([(2.0,)] * 5, "v double")
    assert quality.distribution(flat, "v").first()["kurtosis"] == 0 and sum(r["count"] for r in quality.histogram(flat, "v").collect()) == 5 and quality.outliers_zscore(flat, "v").count() == 0
    none = flat.where("v > 9")
    assert quality.distribution(none, "v").first()["mean"] == 0 and quality.histogram(none, "v").count() == 0 and quality.outliers_iqr(none, "v").count() == 0
    for n, m, severe in ((900, 100, False), (950, 50, True)):
        b = quality.class_balance(spark.createDataFrame([(0,)] * n + [(1,)] * m, "l int"), "l").first()
        assert b["imbalance_ratio"] == n / m and b["is_severely_imbalanced"] is severe and b["majority_class"] == 0
    recs = spark.createDataFrame([("a", "MG", " "), ("b", None, "x"), ("c", "MG", "y")], "patient_id string, modality string, manufacturer string")
    c = {r["field"]: r for r in quality.completeness(recs, ["patient_id", "modality", "manufacturer", "absent"]).collect()}
    assert c["patient_id"]["completeness"] == 1 and c["manufacturer"]["missing"] == 1 and c["modality"]["critical"] and c["absent"]["completeness"] == 0
    one = lambda *x: spark.createDataFrame([(i,) for i in x], "id string")
    leak = quality.leakage({"train": one("P1", "P2", "P3", "P4"), "val": one("P3", "P5"), "test": one("")}, "id").where("left_split = 'train' and right_split = 'val'").first()
    assert leak["overlap"] == 1 and leak["has_leakage"]
    r = quality.report(df.withColumn("c", F.lit("x")), ["v"], ["c"], None, ["v"])
    html = report.to_html(r, None, "t", quality.histogram(df, "v"))
    assert "<svg" in html and report.to_json(r)["distribution"]["v"]["count"] == 1000


def test_quantiles_beyond_one_buffer(spark):
    """Columns with too many distinct values for a buffer: the same quantiles, by ranks."""
    rng = np.random.default_rng(5)
    cases = {"spread": rng.normal(size=30_000), "hot": np.where(rng.random(30_000) < 0.4, 1.5, rng.exponential(size=30_000)),
             "ends": np.concatenate([rng.normal(size=9_997), [np.inf, -np.inf, 0.0]]), "nan": np.concatenate([rng.normal(size=9_000), np.full(1_000, np.nan)])}
    ps = (0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0)
    for name, a in cases.items():
        df = spark.createDataFrame([(float(x),) for x in a], "v double")
        got = df.agg(*quality._quantiles(df, ["v"], ps, buffer=200, sketch=100)).first()[0]
        a = np.sort(a)
        for p, x in zip(ps, got):
            at = p * (len(a) - 1)
            low, high = a[int(np.floor(at))], a[int(np.ceil(at))]
            want = low if low == high else low + (at % 1) * (high - low)
            assert x == pytest.approx(want, rel=1e-9, nan_ok=True), (name, p)
    few = spark.range(1000).select(F.col("id").cast("double").alias("v"), F.lit(None).cast("double").alias("none"))
    one, none = few.agg(*quality._quantiles(few, ["v", "none"], (0.5,))).first()
    assert one == [499.5] and none is None


def test_header_values(spark):
    rows = [("065Y", "20230213", "HOLOGIC, Inc."), ("018M", "2023.02.13", "GE MEDICAL SYSTEMS"), ("104W", "20230229", "Agfa-Gevaert"), ("730D", "00000101", " Siemens "), ("65y", "2023", ""), ("abc", "", "Acme")]
    df = spark.createDataFrame(rows, "age string, day string, v string")
    got = df.select(md.age_years(F.col("age")).alias("a"), md.iso_date(F.col("day")).alias("d"), md.vendor(F.col("v")).alias("v"), md.vendor(F.col("v"), strict=True).alias("s")).collect()
    assert [r["a"] for r in got] == [65, 1, 2, 2, 65, None] and [r["d"] for r in got] == ["2023-02-13", "2023-02-13", None, None, None, None]
    assert [r["v"] for r in got] == ["Hologic", "GE Healthcare", "GE Healthcare", "Siemens Healthineers", "Unknown", "Acme"] and got[2]["s"] == "Agfa-Gevaert"


def test_sampling(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 10 == 0).cast("int").alias("label"))
    i = sampling.global_index(df.repartition(7), "k")
    assert i.where("k <> index").count() == 0
    parts = df.select(sampling.split_of(F.col("k")).alias("s")).groupBy("s").count().collect()
    assert {r["s"] for r in parts} == {"train", "val", "test"} and abs(next(r["count"] for r in parts if r["s"] == "train") - 700) < 60
    d = sampling.balanced_draws(df, "label", "k", 400).groupBy("label").count().collect()
    assert all(abs(r["count"] - 200) < 50 for r in d)
    assert sampling.shuffled(df, "k", 1).first()["k"] != 0 and sampling.class_weights(df, "label").where("label = 1").first()["weight"] == 10


def test_metrics(spark, tmp_path):
    c = metrics.Collector()
    for v in (10, 20, 30):
        c.record("latency", v)
    c.increment("n", 5)
    c.increment("n", 3)
    with c.timer("t"):
        pass
    c.export_json(str(tmp_path / "m.json"))
    s = json.load(open(tmp_path / "m.json"))
    assert s["summaries"]["latency"]["mean"] == 20 and s["counters"]["n"] == 8 and "t" in s["summaries"]
    assert metrics.summary(c.frame(spark)).where("name = 'latency'").first()["last"] == 30


def test_stream(spark, tmp_path, sf):
    root = tmp_path / "in"
    root.mkdir()
    px = np.arange(64, dtype=np.uint16).reshape(8, 8)
    for i in range(3):
        (root / f"{i}.dcm").write_bytes(make({"SOPInstanceUID": f"1.{i}"}, px))
    for n in (3, 3, 4):
        if n == 4:
            (root / "9.dcm").write_bytes(make({"SOPInstanceUID": "1.9"}, px))
        ingest.ingest(spark, str(root), str(tmp_path / "cat"), str(tmp_path / "ck"), least=100)
        assert spark.read.parquet(str(tmp_path / "cat")).count() == n
    batch = spark.read.parquet(f"{sf}/events.parquet")
    os.makedirs(tmp_path / "ev")
    batch.write.mode("overwrite").parquet(str(tmp_path / "ev"))
    stream = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "ev"))
    q = ingest.windowed_metrics(stream).writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    key = lambda r: (str(r["start"]), r["name"], r["count"], r["mean"])
    assert sorted(map(key, spark.sql("select * from w").collect())) == sorted(map(key, ingest.windowed_metrics(batch).collect()))
    q = ingest.dedup_stream(stream, "event_id", "ts").writeStream.format("memory").queryName("d").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.sql("select * from d").count() == batch.select("event_id").distinct().count()


def test_configured_run(spark, tmp_path):
    root = tmp_path / "in"
    root.mkdir()
    px = (np.arange(64 * 64, dtype=np.uint16) % 4000).reshape(64, 64)
    (root / "a.dcm").write_bytes(make({"SOPInstanceUID": "1.1"}, px))
    (root / "b.dcm").write_bytes(make({"SOPInstanceUID": "1.2"}, px, drop=("PatientID",)))
    conf = tmp_path / "c.yaml"
    conf.write_text("""
pipeline:
  name: t
  stages:
    - {name: scan, config: {min_file_size: 100, extensions: [".dcm"]}}
    - {name: validate, depends_on: [scan], config: {required_tags: [PatientID]}}
    - {name: extract_metadata, depends_on: [validate]}
    - {name: pixel_processing, depends_on: [extract_metadata]}
    - {name: image_transforms, depends_on: [pixel_processing], config: {target_size: [32, 16]}}
    - {name: mammography_processing, depends_on: [image_transforms], config: {morphology_kernel_size: 3, clahe_enabled: false, crop_to_breast: false}}
    - {name: quality_check, depends_on: [image_transforms], config: {report_output: "%s/q/report.html"}}
    - {name: write_dataset, depends_on: [quality_check], config: {format: webdataset, output_dir: "%s/set", shard_prefix: mg}}
splits: {train_fraction: 0.5, val_fraction: 0.25, seed: 1}
""" % (tmp_path, tmp_path))
    code = cli.main(["run", "--config", str(conf), "--input", str(root), "--output", str(tmp_path / "out"), "--checkpoint", str(tmp_path / "ck")])
    rows = {os.path.basename(r["path"]): r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert code == 1 and rows["a.dcm"]["status"] == "completed" and rows["a.dcm"]["image"]["height"] == 32 and rows["b.dcm"]["status"] == "failed" and rows["b.dcm"]["stage"] == "validate"
    assert cli.main(["run", "--config", str(conf), "--input", str(root), "--output", str(tmp_path / "out"), "--dry-run"]) == 0
    back = shards.read_tar(spark, str(tmp_path / "set" / "*.tar")).collect()
    assert [r["key"] for r in back] == ["1.1"] and json.loads(back[0]["metadata"])["patient_id"] == "P1" and json.load(open(tmp_path / "set" / "manifest.json"))["shards"] == ["mg_000000.tar"]
    assert "Completeness" in (tmp_path / "q" / "report.html").read_text() and json.loads((tmp_path / "q" / "report.json").read_text())["completeness"]
    for text in ("{name: no_such_stage}", "{name: mammography_processing, config: {no_such_setting: 1}}"):
        (tmp_path / "bad.yaml").write_text("pipeline: {stages: [{name: scan, config: {min_file_size: 100}}, {name: pixel_processing}, %s]}" % text)
        assert cli.main(["run", "--config", str(tmp_path / "bad.yaml"), "--input", str(root), "--output", str(tmp_path / "bad")]) == 2
    assert cli.main(["run", "--config", str(tmp_path / "none.yaml"), "--input", str(root), "--output", "x"]) == 2
    s = config.split(spark.createDataFrame([(str(i),) for i in range(100)], "patient_id string"), config.load(str(conf)))
    assert s.where("split = 'train'").count() < 70
    shards.write(samples(spark), "webdataset", shards.WriterConfig(str(tmp_path / "tar"), per_shard=5))
    assert cli.main(["validate", "--input", str(tmp_path / "tar" / "*.tar"), "--html", str(tmp_path / "r.html"), "--json", str(tmp_path / "r.json")]) == 0
    assert "Completeness" in (tmp_path / "r.html").read_text() and cli.main(["bench", "--input", str(root), "--repeats", "1"]) == 0
    assert session.build() is not None


def test_logs_progress_and_manifests(spark, tmp_path):
    from radspark import logs

    log = logs.setup(path=str(tmp_path / "l"))
    try:
        1 / 0
    except ZeroDivisionError:
        log.exception("bad", extra={"stage": "s"})
    line = json.loads((tmp_path / "l").read_text().splitlines()[0])
    assert line["fields"] == {"stage": "s"} and line["error"].startswith("ZeroDivisionError") and line["event"] == "bad" and line["level"] == "error"
    shown = logs.ForPeople(colour=True).format(log.makeRecord("radspark", 30, "f", 1, "hm %d", (3,), None, extra={"stage": "x"}))
    assert shown.startswith("\x1b[33m") and "hm 3 stage=x" in shown
    assert metrics.progress(3, 1, 8, 2.0) == {"fraction": 0.5, "rate": 2.0, "eta_sec": 2.0}
    (tmp_path / "train_manifest.json").write_text('[{"patient_id": "a"}, {"patient_id": ""}, {"x": 1}]')
    (tmp_path / "val_manifest.json").write_text('[{"patient_id": "a", "y": 2}, {"patient_id": "b"}]')
    s = quality.split_manifests(spark, str(tmp_path))
    r = quality.leakage(s, "patient_id").first()
    assert (r["left_ids"], r["right_ids"], r["overlap"]) == (1, 2, 1)

"""Sharded datasets: tar shards, Parquet shards, .npy folders, length-prefixed blobs, manifests.

Samples are rows (key string, image struct, label string, metadata JSON).
Shard numbers come first (a column), then each shard is written by one task,
member by member, into the store that the output path names (any that pyarrow
opens): to an attempt's own name, moved when complete, so a repeated task
leaves no half file. The manifest is written last.
"""

from __future__ import annotations

import functools
import io
import json
import os
import struct
import tarfile
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from radspark import storage
from radspark.operators import imaging, sampling

SAMPLE = f"key string, image {imaging.IMAGE}, label string, metadata string"
WRITTEN = "shard int, path string, samples long, bytes long"


@dataclass
class WriterConfig:
    """Shards roll before a sample once they hold ``shard_mb`` or ``per_shard`` samples."""

    out: str
    prefix: str = "shard"
    shard_mb: float = 256
    per_shard: int = 1000
    image_format: str = "npy"  # npy or npz

    def __post_init__(self):
        if self.image_format not in ("npy", "npz"):
            raise ValueError(f"image format {self.image_format} is not supported")


@dataclass
class WriteStats:
    total_samples: int = 0
    total_bytes: int = 0
    total_shards: int = 0
    write_duration_sec: float = 0.0
    output_paths: list[str] = field(default_factory=list)

    @property
    def samples_per_second(self) -> float:
        return self.total_samples / self.write_duration_sec if self.write_duration_sec else 0.0

    @property
    def bytes_per_second(self) -> float:
        return self.total_bytes / self.write_duration_sec if self.write_duration_sec else 0.0


def assign_shards(samples: DataFrame, c: WriterConfig, key: str = "key") -> DataFrame:
    """``shard`` by the roll rule, in key order.

    Counting alone is a division. Bytes make a sum that starts anew at each
    roll; it runs over sizes only (no pixels), within runs of rows in key order
    that hold ``per_shard`` samples, so it needs no global pass.
    """
    sizes = samples.select(key, F.coalesce(F.length("image.data"), F.lit(0)).cast("long").alias("_bytes"))
    runs = sampling.global_index(sizes, key).withColumn("_run", F.floor(F.col("index") / c.per_shard).cast("int"))
    limit = int(c.shard_mb * 1048576)

    def roll(k, table):
        t = table.sort_by("index")
        part, held, out = 0, 0, []
        for n in t.column("_bytes").to_pylist():
            if held >= limit:
                part, held = part + 1, 0
            held += n
            out.append(part)
        return pa.table({key: t.column(key), "_run": t.column("_run"), "_part": pa.array(out, pa.int32())})

    kind = dict(samples.dtypes)[key]
    parts = runs.groupBy("_run").applyInArrow(roll, f"{key} {kind}, _run int, _part int")
    used = parts.select("_run", "_part").distinct()
    names = sampling.global_index(used, "_run", "_part").select("_run", "_part", F.col("index").cast("int").alias("shard"))
    return samples.join(parts.join(names, ["_run", "_part"]).select(key, "shard"), key)


def _member(tar: tarfile.TarFile, name: str, data: bytes) -> None:
    info = tarfile.TarInfo(name)
    info.size = len(data)
    tar.addfile(info, io.BytesIO(data))


def write_tar(samples: DataFrame, c: WriterConfig) -> WriteStats:
    """Tar shards ``{prefix}_{number:06d}.tar`` with <key>.npy or .npz, .json (label merged in) and .cls members."""
    begun = time.time()
    rows = assign_shards(samples.select("key", "image", F.col("label").cast("string").alias("label"), F.col("metadata").cast("string").alias("metadata")), c)
    out = storage.qualified(samples.sparkSession, c.out)

    def write(key, batch):
        n = key[0].as_py()
        path = f"{out}/{c.prefix}_{n:06d}.tar"
        t, total = batch.sort_by("key"), 0
        with storage.open_write(path) as stream, tarfile.open(fileobj=stream, mode="w|") as tar:
            for k, img, label, meta in zip(*(t.column(x) for x in ("key", "image", "label", "metadata"))):
                k, label = k.as_py(), label.as_py()
                s = img.as_py()
                if s is not None:
                    buf, a = io.BytesIO(), imaging.decode(s)
                    np.save(buf, a) if c.image_format == "npy" else np.savez_compressed(buf, image=a)
                    _member(tar, f"{k}.{c.image_format}", buf.getvalue())
                    total += a.nbytes
                facts = json.loads(meta.as_py() or "{}")
                if label is not None:
                    facts = facts | {"label": label}
                _member(tar, f"{k}.json", json.dumps(facts, default=str).encode())
                if label is not None:
                    _member(tar, f"{k}.cls", label.encode())
        return pa.table({"shard": pa.array([n], pa.int32()), "path": pa.array([path]), "samples": pa.array([t.num_rows], pa.int64()), "bytes": pa.array([total], pa.int64())})

    done = rows.groupBy("shard").applyInArrow(write, WRITTEN).orderBy("shard").collect()  # one row per shard
    stats = WriteStats(sum(r["samples"] for r in done), sum(r["bytes"] for r in done), len(done), time.time() - begun, [r["path"] for r in done])
    write_manifest(out, {"format": "webdataset", "total_samples": stats.total_samples, "total_shards": stats.total_shards, "shard_size_mb": c.shard_mb,
                           "image_format": c.image_format, "shards": [os.path.basename(p) for p in stats.output_paths]})
    return stats


def write_parquet(samples: DataFrame, c: WriterConfig) -> WriteStats:
    """Parquet with one folder per shard: the columnar counterpart of grouped array files; null labels become -1."""
    begun = time.time()
    rows = assign_shards(samples, c).withColumn("label", F.coalesce(F.col("label").try_cast("int"), F.lit(-1)))
    rows.repartition("shard").write.mode("overwrite").partitionBy("shard").parquet(c.out)
    own = samples.sparkSession.read.parquet(c.out).groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("image.data")).alias("b")).orderBy("shard").collect()  # one row per shard
    stats = WriteStats(sum(r["n"] for r in own), sum(r["b"] or 0 for r in own), len(own), time.time() - begun, [f"{c.out}/shard={r['shard']}" for r in own])
    write_manifest(storage.qualified(samples.sparkSession, c.out), {"format": "parquet", "total_samples": stats.total_samples, "total_shards": stats.total_shards, "samples_per_shard": c.per_shard})
    return stats


def blob(image: np.ndarray, label: str | None, metadata: str | None) -> bytes:
    """Three parts, each after its length as an unsigned 32-bit number: .npy image, label, metadata."""
    buf = io.BytesIO()
    np.save(buf, image)
    parts = [buf.getvalue(), (label or "").encode(), (metadata or "{}").encode()]
    return b"".join(struct.pack("<I", len(p)) + p for p in parts)


def read_blob(data: bytes) -> tuple[np.ndarray, str, dict]:
    parts, at = [], 0
    for _ in range(3):
        (n,) = struct.unpack_from("<I", data, at)
        parts.append(data[at + 4 : at + 4 + n])
        at += 4 + n
    return np.load(io.BytesIO(parts[0])), parts[1].decode(), json.loads(parts[2])


def write_blobs(samples: DataFrame, c: WriterConfig) -> WriteStats:
    """Parquet of (key, value): values as in a key-value store."""
    begun = time.time()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vals = [blob(imaging.decode(i.as_py()), l.as_py(), m.as_py()) for i, l, m in zip(b.column(1), b.column(2), b.column(3))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(vals, pa.binary())], names=["key", "value"])

    rows = samples.where("image is not null").select("key", "image", F.col("label").cast("string"), F.col("metadata").cast("string"))
    rows.mapInArrow(run, "key string, value binary").write.mode("overwrite").parquet(c.out)
    got = samples.sparkSession.read.parquet(c.out).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length("value")), F.lit(0)).alias("b")).first()
    write_manifest(storage.qualified(samples.sparkSession, c.out), {"format": "blobs", "total_samples": got["n"], "total_bytes": got["b"]})
    return WriteStats(got["n"], got["b"], 1, time.time() - begun, [c.out])


def write_hdf5(samples: DataFrame, c: WriterConfig) -> WriteStats:
    """HDF5 files of ``images``, ``labels`` (null: -1), ``keys`` and ``metadata``, one for each shard; needs h5py.

    Images of one shape are one dataset, others one dataset each (``images/<n>``).
    """
    try:
        import h5py  # noqa: F401
    except ImportError as x:
        raise RuntimeError("HDF5 output needs h5py; use format 'parquet'") from x
    begun, out = time.time(), storage.qualified(samples.sparkSession, c.out)

    def write(key, batch):
        import h5py

        n, t, buf = key[0].as_py(), batch.sort_by("key"), io.BytesIO()
        images = [imaging.decode(i.as_py()) for i in t.column("image")]
        with h5py.File(buf, "w") as f:
            if len({i.shape for i in images}) == 1:
                f["images"] = np.stack(images)
            else:
                for k, i in enumerate(images):
                    f[f"images/{k}"] = i
            f["labels"] = np.array([-1 if v is None else v for v in t.column("label").to_pylist()], np.int64)
            f["keys"], f["metadata"] = t.column("key").to_pylist(), [m or "{}" for m in t.column("metadata").to_pylist()]
        path = f"{out}/{c.prefix}_{n:06d}.h5"
        with storage.open_write(path) as stream:
            stream.write(buf.getvalue())
        return pa.table({"shard": pa.array([n], pa.int32()), "path": pa.array([path]), "samples": pa.array([t.num_rows], pa.int64()), "bytes": pa.array([sum(i.nbytes for i in images)], pa.int64())})

    rows = assign_shards(samples.where("image is not null").withColumn("label", F.col("label").try_cast("long")), c)
    done = rows.groupBy("shard").applyInArrow(write, WRITTEN).orderBy("shard").collect()  # one row per shard
    stats = WriteStats(sum(r["samples"] for r in done), sum(r["bytes"] for r in done), len(done), time.time() - begun, [r["path"] for r in done])
    write_manifest(out, {"format": "hdf5", "total_samples": stats.total_samples, "total_shards": stats.total_shards, "samples_per_shard": c.per_shard})
    return stats


WRITERS = {"webdataset": write_tar, "parquet": write_parquet, "blobs": write_blobs, "hdf5": write_hdf5}


def write(samples: DataFrame, format: str, c: WriterConfig) -> WriteStats:
    if format not in WRITERS:
        raise ValueError(f"unknown output format {format}")
    return WRITERS[format](samples, c)


def write_manifest(folder: str, facts: dict) -> None:
    """``manifest.json``; ``_manifest.json`` beside Parquet files, whose readers pass over such names."""
    with storage.open_write(f"{folder}/{'manifest.json' if facts['format'] == 'webdataset' else '_manifest.json'}") as f:
        f.write(json.dumps(facts, indent=1).encode())


def training_manifest(paths: DataFrame, out: str, path: str = "path") -> None:
    """One JSON line {"prefix": ...} per shard, sorted; the list is as short as the shards are many."""
    lines = paths.where(F.col(path).rlike(r"\.(tar|h5|lmdb|parquet)$")).select(F.to_json(F.struct(F.col(path).alias("prefix"))).alias("line"))
    lines.orderBy("line").coalesce(1).write.mode("overwrite").text(out)


def _image_of(name: str, data: bytes) -> np.ndarray | None:
    got = np.load(io.BytesIO(data), allow_pickle=False)
    if name == "npz":
        return got["image"] if "image" in got else got[got.files[0]]
    return got


#: Samples of a shard that are held until their last member is met; members of a sample lie side by side in common shards.
OPEN_SAMPLES = 64


def _samples_of(tar: tarfile.TarFile) -> Iterator[tuple[str, dict[str, bytes]]]:
    """(key, members by extension) as a tar is streamed."""
    by: dict[str, dict[str, bytes]] = {}
    for m in tar:
        if not m.isfile() or "." not in m.name:
            continue
        key, ext = m.name.rsplit(".", 1)
        if key not in by and len(by) >= OPEN_SAMPLES:
            first = next(iter(by))
            yield first, by.pop(first)
        by.setdefault(key, {})[ext] = tar.extractfile(m).read()
    yield from by.items()


def read_tar(spark: SparkSession, paths: str | Sequence[str], seed: int | None = None) -> DataFrame:
    """``SAMPLE`` rows and their shard path; samples without an image go.

    Shards are streamed in the executors, a few samples at a time, so their
    size does not matter; a broken one gives the samples before the break. A
    seed shuffles the rows. Labels stay text: the .cls member, else the
    metadata's.
    """
    files = spark.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths))
    some = files.select("path").first()
    streamed = some is None or storage.can_open(some[0])
    files = files.select("path", F.lit(None).cast("binary").alias("content") if streamed else "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1)):
                try:
                    with (storage.open_read(path) if streamed else io.BytesIO(content.as_py())) as f, tarfile.open(fileobj=f, mode="r|*") as tar:
                        for key, parts in _samples_of(tar):
                            kind = "npy" if "npy" in parts else "npz" if "npz" in parts else None
                            if kind is None:
                                continue
                            try:
                                img = imaging.encode(_image_of(kind, parts[kind]))
                                meta = json.loads(parts.get("json", b"{}"))
                            except (ValueError, OSError, EOFError):
                                continue
                            label = parts["cls"].decode() if "cls" in parts else meta.get("label")
                            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([img], imaging.IMAGE_TYPE), pa.array([None if label is None else str(label)], pa.string()),
                                                              pa.array([json.dumps(meta)]), pa.array([path])], names=["key", "image", "label", "metadata", "shard_path"])
                except (tarfile.TarError, EOFError, OSError):
                    continue

    out = files.mapInArrow(run, f"{SAMPLE}, shard_path string")
    return out if seed is None else sampling.shuffled(out, "key", seed)


def read_npy(spark: SparkSession, folder: str) -> DataFrame:
    """``SAMPLE`` rows of a folder's .npy files; <stem>.json side files give metadata and label."""
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    stem = F.regexp_extract("path", r"([^/]*)\.(npy|json)$", 1)
    side = files.where(F.col("path").endswith(".json")).select(stem.alias("key"), F.decode("content", "utf-8").alias("metadata"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            imgs = [imaging.encode(_image_of("npy", c.as_py())) for c in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(imgs, imaging.IMAGE_TYPE)], names=["key", "image"])

    images = files.where(F.col("path").endswith(".npy")).select(stem.alias("key"), "content").mapInArrow(run, f"key string, image {imaging.IMAGE}")
    return images.join(side, "key", "left").select("key", "image", F.get_json_object("metadata", "$.label").alias("label"), F.coalesce("metadata", F.lit("{}")).alias("metadata"))


def batches(samples: DataFrame, size: int, drop_last: bool = False, buffer: int = 0, seed: int = 0) -> Iterator[dict]:
    """Batches for a trainer, streamed partition by partition: images and labels stacked where shapes agree.

    ``buffer`` rows are kept back and handed out in random order.
    """
    rng = np.random.default_rng(seed)

    def rows():
        held = []
        for r in samples.toLocalIterator(prefetchPartitions=True):
            x = {"key": r["key"], "image": imaging.decode(r["image"].asDict()), "label": r["label"], "metadata": json.loads(r["metadata"] or "{}")}
            if not buffer:
                yield x
                continue
            held.append(x)
            if len(held) >= buffer:
                yield held.pop(int(rng.integers(len(held))))
        rng.shuffle(held)
        yield from held

    def collate(part: list[dict]) -> dict:
        images = [x["image"] for x in part]
        return {"image": np.stack(images) if len({i.shape for i in images}) == 1 else images, "label": [x["label"] for x in part], "key": [x["key"] for x in part], "metadata": [x["metadata"] for x in part]}

    part: list[dict] = []
    for x in rows():
        part.append(x)
        if len(part) == size:
            yield collate(part)
            part = []
    if part and not drop_last:
        yield collate(part)


class RandomAccess:
    """Samples of Parquet shards by place or key, for a trainer's process; the last ``cache`` of them stay decoded.

    Only keys are read at first; a sample costs one filtered read of its
    shard's row groups. The folder must be of a store that pyarrow opens.
    """

    def __init__(self, folder: str, cache: int = 256):
        import pyarrow.dataset as ds

        store, at = storage._store(folder)
        self.data = ds.dataset(at, filesystem=store, partitioning="hive", exclude_invalid_files=False, ignore_prefixes=["_", "."])
        self.keys = sorted(self.data.to_table(columns=["key"]).column("key").to_pylist())
        self._load = functools.lru_cache(maxsize=cache)(self._read)

    def __len__(self) -> int:
        return len(self.keys)

    def __getitem__(self, k: int | str) -> dict:
        return self._load(self.keys[k] if isinstance(k, int) else k)

    def _read(self, key: str) -> dict:
        import pyarrow.dataset as ds

        got = self.data.to_table(filter=ds.field("key") == key, columns=["key", "image", "label", "metadata"]).to_pylist()
        if not got:
            raise KeyError(key)
        return got[0] | {"image": imaging.decode(got[0]["image"]), "metadata": json.loads(got[0]["metadata"] or "{}")}

"""Images as rows: kernels fused into one Arrow hop, errors kept in the row."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from radspark.operators import kernels, mammography
from radspark.operators.kernels import Kernel

IMAGE = "struct<height:int,width:int,channels:int,dtype:string,data:binary>"
IMAGE_TYPE = pa.struct([("height", pa.int32()), ("width", pa.int32()), ("channels", pa.int32()), ("dtype", pa.string()), ("data", pa.binary())])
#: Bytes of pixels that a task gathers before it hands rows back.
FLUSH_BYTES = 32 << 20


def encode(a: np.ndarray) -> dict:
    c = a.shape[0] if a.ndim == 3 else 1
    return {"height": a.shape[-2], "width": a.shape[-1], "channels": c, "dtype": str(a.dtype), "data": np.ascontiguousarray(a).tobytes()}


def decode(s: dict) -> np.ndarray:
    a = np.frombuffer(s["data"], dtype=s["dtype"])
    return a.reshape(s["height"], s["width"]) if s["channels"] == 1 else a.reshape(s["channels"], s["height"], s["width"])


class _Row:
    """A row's columns by name, converted only when they are asked for."""

    def __init__(self, names: list[str], batch: pa.RecordBatch, at: int):
        self.names, self.batch, self.at = names, batch, at

    def get(self, name: str | None):
        return self.batch.column(self.names.index(name))[self.at].as_py() if name in self.names else None


def _map(df: DataFrame, image: str, extra: Sequence[T.StructField], fn: Callable[[dict | None, _Row], tuple]) -> DataFrame:
    """Replace ``image`` by fn's first result and add its others; a failing row gets a null image and ``error``."""
    drop = {image, "error", *(f.name for f in extra)}
    kept = [f for f in df.schema.fields if f.name not in drop]
    schema = T.StructType([*kept, T.StructField(image, T._parse_datatype_string(IMAGE)), *extra, T.StructField("error", T.StringType())])
    had_error = "error" in df.columns
    source = df.select(*[f"`{f.name}`" for f in kept], image, *([F.col("error")] if had_error else [F.lit(None).cast("string").alias("error")]))
    types = [t.type for t in _arrow(extra)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.name for f in kept]
        for b in batches:
            lo, size, out = 0, 0, []
            for r in range(b.num_rows):
                row = _Row(names, b, r)
                err, got = b.column(len(names) + 1)[r].as_py(), None
                if err is None:
                    try:
                        got = fn(b.column(len(names))[r].as_py(), row)
                    except Exception as x:  # one bad image must not end the job
                        err = f"{type(x).__name__}: {x}"
                out.append((got or (None, *[None] * len(types)), err))
                size += len((got or (None,))[0]["data"]) if got and got[0] else 0
                if size > FLUSH_BYTES or r == b.num_rows - 1:
                    left = [b.column(i).slice(lo, r + 1 - lo) for i in range(len(names))]
                    cols = [pa.array([g[0] for g, _ in out], IMAGE_TYPE), *[pa.array([g[k + 1] for g, _ in out], t) for k, t in enumerate(types)], pa.array([e for _, e in out], pa.string())]
                    yield pa.RecordBatch.from_arrays([*left, *cols], names=[*names, image, *[f.name for f in extra], "error"])
                    lo, size, out = r + 1, 0, []

    return source.mapInArrow(run, schema)


def _arrow(fields: Sequence[T.StructField]) -> list[pa.Field]:
    from pyspark.sql.pandas.types import to_arrow_schema

    return list(to_arrow_schema(T.StructType(list(fields))))


def pack(df: DataFrame, values: str, height: int, width: int, image: str = "image") -> DataFrame:
    """Image structs (float32) of arrays of ``height * width`` numbers."""
    kept = [f for f in df.schema.fields if f.name not in (values, image)]
    schema = T.StructType([*kept, T.StructField(image, T._parse_datatype_string(IMAGE))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            imgs = [None if v.as_py() is None else encode(np.array(v.as_py(), np.float32).reshape(height, width)) for v in b.column(len(kept))]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(imgs, IMAGE_TYPE)], names=[*[f.name for f in kept], image])

    return df.select(*[f"`{f.name}`" for f in kept], values).mapInArrow(run, schema)


def transform(df: DataFrame, steps: Sequence[Kernel], image: str = "image") -> DataFrame:
    """All steps in one hop."""
    chain = kernels.compose(list(steps))
    return _map(df, image, [], lambda s, row: (encode(chain(decode(s))),) if s else (None,))


STATS = [T.StructField(n, T.DoubleType()) for n in ("mean", "std", "low", "high")] + [T.StructField("pixels", T.LongType())]


def statistics(df: DataFrame, image: str = "image") -> DataFrame:
    """mean, std, low, high and pixels of each image; the image itself is left out of the result."""
    def one(s, row):
        if not s:
            return (None,) * 6
        a = decode(s).astype(np.float64)
        return (None, float(a.mean()), float(a.std()), float(a.min()), float(a.max()), a.size)

    return _map(df, image, STATS, one).drop(image)


ANALYSIS = T.StructType([
    T.StructField("orientation", T.StringType()), T.StructField("was_flipped", T.BooleanType()),
    T.StructField("breast_bbox", T.ArrayType(T.IntegerType())), T.StructField("breast_area_pixels", T.LongType()), T.StructField("breast_area_fraction", T.DoubleType()),
    T.StructField("pectoral_area_fraction", T.DoubleType()), T.StructField("implant_detected", T.BooleanType()), T.StructField("view_position", T.StringType())])


def mammograms(df: DataFrame, laterality: str | None = None, view: str | None = None, implant: str | None = None, config: mammography.Config = mammography.Config(), image: str = "image") -> DataFrame:
    """Processed mammograms with ``analysis``; the named columns give side, view and known implants."""
    def one(s, row):
        if not s:
            return (None, None)
        a, x = mammography.process(decode(s), row.get(laterality), row.get(view), row.get(implant), config)
        return encode(a), {f.name: (list(getattr(x, f.name)) if f.name == "breast_bbox" and getattr(x, f.name) else getattr(x, f.name)) for f in ANALYSIS.fields}

    return _map(df, image, [T.StructField("analysis", ANALYSIS)], one)


def decode_dicom(files: DataFrame, config: kernels.PixelConfig = kernels.PixelConfig(), steps: Sequence[Kernel] = (), corrections: dict[str, kernels.Correction] | None = None,
                 carry: Sequence[str] = ("path",)) -> DataFrame:
    """Images of DICOM files (content) beside the columns ``carry``: parsing, vendor corrections, intensities and transforms in one hop."""
    from radspark.functions.metadata import VENDORS
    from radspark.sources import dicom

    def vendor(ds) -> str | None:
        name = (ds.first("Manufacturer") or "").lower()
        return next((v for fragment, v in VENDORS if fragment in name), None)

    chain = kernels.compose(list(steps))
    schema = T.StructType([*[files.schema[c] for c in carry], T.StructField("image", T._parse_datatype_string(IMAGE)), T.StructField("error", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                img, err = None, None
                try:
                    ds = dicom.parse(b.column(len(carry))[r].as_py() or b"", pixels=True)
                    img = encode(chain(kernels.process_pixels(ds, config, corrections, vendor(ds))))
                except Exception as x:  # one bad file must not end the job
                    err = f"{type(x).__name__}: {x}"
                yield pa.RecordBatch.from_arrays([*[c.slice(r, 1) for c in b.columns[:-1]], pa.array([img], IMAGE_TYPE), pa.array([err], pa.string())], names=[*carry, "image", "error"])

    return files.select(*carry, "content").mapInArrow(run, schema)

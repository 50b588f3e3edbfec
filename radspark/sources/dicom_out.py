"""DICOM files from columns: explicit little-endian Part 10 bytes, uncompressed pixels."""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from radspark.sources.dicom import BINARY, DICTIONARY, EXPLICIT, LONG_VR


def _element(number: str, vr: str, raw: bytes) -> bytes:
    raw += (b"\0" if vr in ("UI", "OB", "OW", "UN") else b" ") * (len(raw) % 2)
    head = struct.pack("<HH2s", int(number[:4], 16), int(number[5:], 16), vr.encode())
    return head + (struct.pack("<HI", 0, len(raw)) if vr in LONG_VR else struct.pack("<H", len(raw))) + raw


def file_bytes(tags: dict[str, str | None], pixels: np.ndarray | None = None) -> bytes:
    """A file of ``tags`` (keyword or gggg,eeee to text; several values are parted by backslashes; null: left out)."""
    parts = {}
    for word, text in tags.items():
        if text is not None:
            number, vr = DICTIONARY.get(word, (word, "LO"))
            values = [v for v in text.split("\\") if v]
            parts[number] = _element(number, vr, b"".join(struct.pack(f"<{BINARY[vr]}", int(v)) for v in values) if vr in BINARY else text.encode())
    if pixels is not None:
        parts["7FE0,0010"] = _element("7FE0,0010", "OW", np.ascontiguousarray(pixels).tobytes())
    syntax = _element("0002,0010", "UI", EXPLICIT.encode())
    return b"\0" * 128 + b"DICM" + _element("0002,0000", "UL", struct.pack("<I", len(syntax))) + syntax + b"".join(parts[k] for k in sorted(parts))


def files_of(rows: DataFrame, path: Column, tags: dict[str, Column], pixels: Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """path, length, content (and ``keep``) of one file for each row; ``pixels`` is an array of unsigned 16-bit numbers."""
    words = list(tags)
    px = F.lit(None).cast("array<int>") if pixels is None else pixels.cast("array<int>")
    source = rows.select(path.alias("path"), px.alias("pixels"), *[c.cast("string").alias(f"t{k}") for k, c in enumerate(tags.values())], *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data = []
            for r in range(b.num_rows):
                p = b.column(1)[r].as_py()
                data.append(file_bytes({w: b.column(2 + k)[r].as_py() for k, w in enumerate(words)}, None if p is None else np.array(p, "<u2")))
            cols = [b.column(0), pa.array(map(len, data), pa.int64()), pa.array(data, pa.binary()), *b.columns[2 + len(words):]]
            yield pa.RecordBatch.from_arrays(cols, names=["path", "length", "content", *keep])

    kinds = dict(rows.dtypes)
    return source.mapInArrow(run, ", ".join(["path string", "length long", "content binary", *[f"`{c}` {kinds[c]}" for c in keep]]))

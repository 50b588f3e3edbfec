"""TIFF as a media column: a writer, and a reader that emits one row per page.

The reader walks the chain of image directories (both byte orders), decodes
strips or tiles stored raw, with PackBits, LZW or deflate, undoes the
horizontal (2) and the floating-point (3) predictor and returns samples of 1,
2, 4 (one byte each), 8, 16, 32 or 64 bits: unsigned, signed or floating,
little-endian, chunky, from files with chunky or planar layout.

Defined results: null or empty media give one row with ``error`` set and null
pixels; a broken page gives a row with ``error`` and the walk goes on where the
chain is intact; a directory chain that loops ends. Extra columns are kept by
``tiff_pages`` unless their names clash with its own, which win.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW, LZW, DEFLATE, PACKBITS = 1, 5, 8, 32773
OLD_DEFLATE = 32946
#: Bytes a field type takes (TIFF 6.0), by its number.
TYPE_BYTES = {1: 1, 2: 1, 3: 2, 4: 4, 6: 1, 7: 1, 8: 2, 9: 4}


def pack_bits(data: bytes) -> bytes:
    """PackBits: runs of 3 or more become two bytes, the rest literal packets."""
    if not data:
        return b""
    a = np.frombuffer(data, dtype=np.uint8)
    starts = np.concatenate(([0], np.flatnonzero(a[1:] != a[:-1]) + 1))
    lengths = np.diff(np.append(starts, len(a)))
    long = lengths >= 3
    out, done = [], 0

    def literal(upto: int) -> None:
        nonlocal done
        while done < upto:
            n = min(128, upto - done)
            out.append(bytes((n - 1,)) + data[done : done + n])
            done += n

    for s, n in zip(starts[long].tolist(), lengths[long].tolist()):
        literal(s)
        while n >= 2:
            k = min(128, n)
            out.append(bytes((257 - k, data[s])))
            n -= k
            done += k
    literal(len(data))
    return b"".join(out)


def unpack_bits(data: bytes, size: int) -> bytes:
    out, at, got = [], 0, 0
    while got < size and at < len(data):
        n = data[at]
        if n < 128:
            part = data[at + 1 : at + 2 + n]
            at += 2 + n
        elif n > 128:
            part = data[at + 1 : at + 2] * (257 - n)
            at += 2
        else:
            at += 1
            continue
        out.append(part)
        got += len(part)
    return b"".join(out)[:size]


def lzw_encode(data: bytes) -> bytes:
    """TIFF LZW: most significant bit first, codes widen one entry early."""
    out = bytearray()
    acc, bits = 256, 9
    table: dict[int, int] = {}
    nxt, width = 258, 9
    cur = -1
    for b in data:
        if cur < 0:
            cur = b
            continue
        key = cur << 8 | b
        code = table.get(key)
        if code is not None:
            cur = code
            continue
        acc = acc << width | cur
        bits += width
        while bits >= 8:
            bits -= 8
            out.append(acc >> bits)
            acc &= (1 << bits) - 1
        table[key] = nxt
        nxt += 1
        if nxt == 512 or nxt == 1024 or nxt == 2048:
            width += 1
        elif nxt == 4095:
            acc = acc << width | 256
            bits += width
            table.clear()
            nxt, width = 258, 9
        cur = b
    if cur >= 0:
        acc = acc << width | cur
        bits += width
        nxt += 1
        if nxt in (512, 1024, 2048):
            width += 1
    acc = acc << width | 257
    bits += width
    pad = -bits % 8
    return bytes(out) + (acc << pad).to_bytes((bits + pad) // 8, "big")


_BYTES = [bytes((i,)) for i in range(256)]


def lzw_decode(data: bytes, size: int) -> bytes:
    out: list[bytes] = []
    table: list[bytes] = [*_BYTES, b"", b""]
    width, acc, bits, got = 9, 0, 0, 0
    last = b""
    for byte in data:
        acc = acc << 8 | byte
        bits += 8
        if bits < width:
            continue
        bits -= width
        code = acc >> bits
        acc &= (1 << bits) - 1
        if code == 256:
            table = [*_BYTES, b"", b""]
            width, last = 9, b""
            continue
        if code == 257 or got >= size:
            break
        if not last:
            entry = table[code]
        else:
            if code < len(table):
                entry = table[code]
            elif code == len(table):
                entry = last + last[:1]
            else:
                raise ValueError("LZW code out of range")
            table.append(last + entry[:1])
            n = len(table)
            if n == 511 or n == 1023 or n == 2047:
                width += 1
        out.append(entry)
        got += len(entry)
        last = entry
    return b"".join(out)[:size]


def encode_block(raw: bytes, codec: int) -> bytes:
    if codec == LZW:
        return lzw_encode(raw)
    if codec == DEFLATE:
        return zlib.compress(raw, 1)
    return pack_bits(raw) if codec == PACKBITS else raw


def decode_block(data: bytes, codec: int, size: int) -> bytes:
    if codec == LZW:
        got = lzw_decode(data, size)
    elif codec in (DEFLATE, OLD_DEFLATE):
        got = zlib.decompressobj().decompress(data, size)
    elif codec == PACKBITS:
        got = unpack_bits(data, size)
    elif codec == RAW:
        got = data[:size]
    else:
        raise ValueError(f"compression {codec} is not supported")
    if len(got) < size:
        raise ValueError(f"block holds {len(got)} of {size} bytes")
    return got


def write_tiff(pages: list[tuple[np.ndarray, int, int, int | tuple[int, int]]]) -> bytes:
    """Little-endian TIFF of 8-bit grey pages: (rows x width array, codec, predictor, rows per strip or (tile height, tile width))."""
    out = bytearray(b"II*\0\0\0\0\0")
    link = 4
    for img, codec, predictor, layout in pages:
        h, w = img.shape
        if isinstance(layout, tuple):
            th, tw = layout
            canvas = np.zeros((-(-h // th) * th, -(-w // tw) * tw), dtype=np.uint8)
            canvas[:h, :w] = img
            blocks = [canvas[y : y + th, x : x + tw] for y in range(0, h, th) for x in range(0, w, tw)]
        else:
            blocks = [img[y : y + layout] for y in range(0, h, layout)]
        offs, sizes = [], []
        for blk in blocks:
            if predictor == 2:
                blk = np.diff(blk, axis=1, prepend=np.zeros((len(blk), 1), np.uint8))
            data = encode_block(blk.tobytes(), codec)
            offs.append(len(out))
            sizes.append(len(data))
            out += data
        tags = [(256, 4, [w]), (257, 4, [h]), (258, 3, [8]), (259, 3, [codec]), (262, 3, [1]), (277, 3, [1])]
        if isinstance(layout, tuple):
            tags += [(322, 4, [layout[1]]), (323, 4, [layout[0]]), (324, 4, offs), (325, 4, sizes)]
        else:
            tags += [(273, 4, offs), (278, 4, [layout]), (279, 4, sizes)]
        if predictor == 2:
            tags.append((317, 3, [2]))
        fields = b""
        for tag, kind, vals in sorted(tags):
            body = struct.pack(f"<{len(vals)}{'H' if kind == 3 else 'I'}", *vals)
            if len(body) > 4:
                at = len(out) + len(out) % 2
                out += b"\0" * (len(out) % 2) + body
                body = struct.pack("<I", at)
            fields += struct.pack("<HHI", tag, kind, len(vals)) + body.ljust(4, b"\0")
        out += b"\0" * (len(out) % 2)
        struct.pack_into("<I", out, link, len(out))
        out += struct.pack("<H", len(tags)) + fields + b"\0\0\0\0"
        link = len(out) - 4
    return bytes(out)


def _directory(data: bytes, at: int, e: str) -> tuple[dict[int, tuple[int, ...]], int]:
    (n,) = struct.unpack_from(f"{e}H", data, at)
    tags = {}
    for k in range(n):
        p = at + 2 + 12 * k
        tag, kind, count = struct.unpack_from(f"{e}HHI", data, p)
        if kind not in TYPE_BYTES:
            continue
        size = TYPE_BYTES[kind] * count
        q = p + 8 if size <= 4 else struct.unpack_from(f"{e}I", data, p + 8)[0]
        if q + size > len(data):
            raise ValueError(f"tag {tag} points past the end")
        code = {1: "B", 2: "B", 3: "H", 4: "I", 6: "b", 7: "B", 8: "h", 9: "i"}[kind]
        tags[tag] = struct.unpack_from(f"{e}{count}{code}", data, q)
    (nxt,) = struct.unpack_from(f"{e}I", data, at + 2 + 12 * n)
    return tags, nxt


def _pixels(data: bytes, t: dict[int, tuple[int, ...]], e: str) -> np.ndarray:
    """Samples of a page: height x width x samples."""
    w, h = t[256][0], t[257][0]
    spp, depths, fmt, planar = t.get(277, (1,))[0], set(t.get(258, (1,))), t.get(339, (1,))[0], t.get(284, (1,))[0] == 2
    codec, predictor = t.get(259, (1,))[0], t.get(317, (1,))[0]
    bits = depths.pop()
    kind = {2: "i", 3: "f"}.get(fmt, "u")
    if depths or bits not in ((16, 32, 64) if kind == "f" else (1, 2, 4, 8, 16, 32, 64)) or fmt > 4:
        raise ValueError("samples of these widths or this format are not supported")
    if predictor not in (1, 2, 3) or predictor == 3 and kind != "f" or predictor != 1 and bits < 8:
        raise ValueError(f"predictor {predictor} is not supported for such samples")
    n, per = bits // 8, 1 if planar else spp

    def block(k: int, bh: int, bw: int, offs, sizes) -> np.ndarray:
        line = (bw * per * bits + 7) // 8
        a = np.frombuffer(decode_block(data[offs[k] : offs[k] + sizes[k]], codec, bh * line), dtype=np.uint8).reshape(bh, line)
        if bits < 8:
            parts = np.unpackbits(a, axis=1).reshape(bh, -1, bits)[:, : bw * per]
            a = (parts << np.arange(bits - 1, -1, -1, dtype=np.uint8)).sum(axis=2, dtype=np.uint8)
        elif predictor == 3:  # differences of bytes, the most significant byte of all samples first
            a = np.cumsum(a.reshape(bh, -1, per), axis=1, dtype=np.uint8).reshape(bh, n, bw * per)
            a = np.ascontiguousarray(a[:, ::-1].transpose(0, 2, 1)).view(f"<f{n}")
        else:
            a = a.view(f"{e}u{n}").astype(f"<u{n}", copy=False).reshape(bh, bw, per)
            if predictor == 2:
                a = np.cumsum(a, axis=1, dtype=f"<u{n}")
            a = a.view(f"<{kind}{n}")
        return a.reshape(bh, bw, per)

    tw, th = (t[322][0], t[323][0]) if 322 in t else (w, min(t.get(278, (h,))[0], h))
    if not (w and h and spp and tw and th):
        raise ValueError("a side of the page or of its blocks is 0")
    across, down = -(-w // tw), -(-h // th)
    offs, sizes = (t[324], t[325]) if 322 in t else (t[273], t[279])

    def plane(first: int) -> np.ndarray:
        tall = [th if 322 in t else min(th, h - y * th) for y in range(down)]
        return np.concatenate([np.concatenate([block(first + y * across + x, tall[y], tw, offs, sizes) for x in range(across)], axis=1) for y in range(down)])[:h, :w]

    if len(offs) < across * down * (spp if planar else 1):
        raise ValueError("blocks are missing")
    return np.concatenate([plane(p * across * down) for p in range(spp)], axis=2) if planar else plane(0)


def read_pages(data: bytes | None) -> Iterator[tuple[dict, np.ndarray | None, str | None]]:
    """(tags, samples as height x width x samples, error) of each page in turn."""
    if not data or data[:4] not in (b"II*\0", b"MM\0*"):
        yield {}, None, "not a TIFF"
        return
    e = "<" if data[:2] == b"II" else ">"
    at, seen = (struct.unpack_from(f"{e}I", data, 4)[0] if len(data) >= 8 else 0), set()
    while at and at not in seen:
        seen.add(at)
        try:
            tags, nxt = _directory(data, at, e)
        except (struct.error, ValueError) as x:
            yield {}, None, f"directory: {x}"
            return
        try:
            yield tags, _pixels(data, tags, e), None
        except (struct.error, ValueError, KeyError, IndexError, OverflowError, zlib.error) as x:
            yield tags, None, f"{type(x).__name__}: {x}"
        at = nxt


PAGE = ("page int, width int, height int, samples int, compression int, predictor int, tiled boolean, "
        "last boolean, pixels binary, error string, bits int, sample_format int")


Batches = Iterator[pa.RecordBatch]


def _walk(batches: Batches, batch_bytes: int = 8 << 20) -> Batches:
    """Batches of (media, other columns) to batches of the other columns and ``PAGE``."""
    own = [f.split()[0] for f in PAGE.split(", ")]
    kinds = [pa.int32()] * 6 + [pa.bool_(), pa.bool_(), pa.binary(), pa.string(), pa.int32(), pa.int32()]
    for b in batches:
        names = b.schema.names[1:]
        media = b.column(0)
        take: list[int] = []
        out: list[list] = [[] for _ in own]
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal take, out, size
            left = [b.column(i + 1).take(pa.array(take, pa.int32())) for i in range(len(names))]
            got = pa.RecordBatch.from_arrays(left + [pa.array(c, k) for c, k in zip(out, kinds)], names=names + own)
            take, out, size = [], [[] for _ in own], 0
            return got

        for r in range(len(media)):
            pages = list(read_pages(media[r].as_py())) or [({}, None, "no pages")]
            for n, (t, px, err) in enumerate(pages):
                raw = None if px is None else px.tobytes()
                g = lambda k, d: int(t[k][0]) if t.get(k) else d
                row = (n, g(256, None), g(257, None), g(277, 1), g(259, 1), g(317, 1), 322 in t, n == len(pages) - 1, raw, err, g(258, 1), g(339, 1))
                for c, v in zip(out, row):
                    c.append(v)
                take.append(r)
                size += len(raw or b"")
            if size > batch_bytes:
                yield flush()
        if take:
            yield flush()


def tiff_pages(df: DataFrame, media_col: str = "media") -> DataFrame:
    """One row per page of each TIFF, in order: the other columns of ``df`` and ``PAGE``.

    Rows are not moved; ``last`` marks a file's last page.
    """
    own = [f.split()[0] for f in PAGE.split(", ")]
    kept = [f for f in df.schema.fields if f.name != media_col and f.name not in own]
    schema = T.StructType(kept + T._parse_datatype_string(PAGE).fields)
    return df.select(media_col, *[f"`{f.name}`" for f in kept]).mapInArrow(_walk, schema)


WIDTH, PAGE_ROWS, SMALL_ROWS = 64, 512, 16


def text_pages(text: str | None) -> list[tuple[np.ndarray, int, int, int | tuple[int, int]]]:
    """A text's UTF-8, zero-padded to a positive multiple of 64, as grey pages 64 wide.

    Pages of at most 16 rows use LZW strips; larger ones take turns between
    deflate strips with the horizontal predictor and PackBits tiles.
    """
    raw = (text or "").encode("utf-8", "surrogatepass")
    raw += b"\0" * (-len(raw) % WIDTH or (WIDTH if not raw else 0))
    img = np.frombuffer(raw, dtype=np.uint8).reshape(-1, WIDTH)
    pages = []
    for k, y in enumerate(range(0, len(img), PAGE_ROWS)):
        part = img[y : y + PAGE_ROWS]
        if len(part) <= SMALL_ROWS:
            pages.append((part, LZW, 1 + k % 2, 8))
        else:
            pages.append((part, DEFLATE, 2, 128) if k % 2 == 0 else (part, PACKBITS, 1, (64, 64)))
    return pages


STORED = "media binary, doc_id long, n_bytes long, media_bytes long, media_sha256 string"


def _store(batches: Batches) -> Batches:
    """Batches of (doc_id, text) to ``STORED``."""
    for b in batches:
        ids, texts = b.column(0), b.column(1)
        for lo in range(0, len(ids), 256):
            own = [t or "" for t in texts.slice(lo, 256).to_pylist()]
            media = [write_tiff(text_pages(t)) for t in own]
            yield pa.RecordBatch.from_arrays([
                pa.array(media, pa.binary()), ids.slice(lo, 256),
                pa.array([len(t.encode("utf-8", "surrogatepass")) for t in own], pa.int64()),
                pa.array([len(m) for m in media], pa.int64()),
                pa.array([hashlib.sha256(m).hexdigest() for m in media], pa.string())], names=["media", "doc_id", "n_bytes", "media_bytes", "media_sha256"])


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def encode_texts(docs: DataFrame) -> DataFrame:
    """``STORED``: each text as a TIFF."""
    return _texts(docs).mapInArrow(_store, STORED)


DIGEST = ("doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, "
          "media_bytes long, media_sha256 string, feature string, n_pages long, error string")


def _digest(batches: Batches) -> Batches:
    """Digest of each file's read-back samples; pages of a file stand together.

    ``feature``: pages, size, mean, deviation and entropy of the samples, and their share in 8 equal bands.
    """
    sha, tail, total, hist, n, bad, shape = hashlib.sha256(), b"", 0, np.zeros(256, np.int64), 0, None, []
    for b in batches:
        cols = {c: b.column(i).to_pylist() for i, c in enumerate(b.schema.names)}
        out: list[list] = [[] for _ in range(10)]
        for r in range(b.num_rows):
            px = cols["pixels"][r]
            n += 1
            bad = bad or cols["error"][r]
            if px is not None:
                sha.update(px)
                tail = (tail + px)[-64:]
                total += len(px)
                hist += np.bincount(np.frombuffer(px, np.uint8), minlength=256)
                shape.append(f"{cols['compression'][r]}:{cols['height'][r]}")
            if not cols["last"][r]:
                continue
            p = hist[hist > 0] / max(1, total)
            v = np.arange(256)
            mean = float((hist * v).sum()) / max(1, total)
            var = max(0.0, float((hist * v * v).sum()) / max(1, total) - mean * mean)
            bands = ",".join(f"{x / max(1, total):.4f}" for x in hist.reshape(8, 32).sum(1))
            feature = (f"pages={n};width={WIDTH};layout={'/'.join(shape[:4])};mean={mean:.4f};std={var ** 0.5:.4f};"
                       f"entropy={abs(float(-(p * np.log2(p)).sum())):.4f};bands={bands}")
            row = (cols["doc_id"][r], cols["n_bytes"][r], total, sha.hexdigest(), zlib.crc32(tail),
                   cols["media_bytes"][r], cols["media_sha256"][r], feature, n, bad)
            for c, x in zip(out, row):
                c.append(x)
            sha, tail, total, hist, n, bad, shape = hashlib.sha256(), b"", 0, np.zeros(256, np.int64), 0, None, []
        s, i = pa.string(), pa.int64()
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, (i, i, i, s, i, i, s, s, i, s))],
                                         names=[f.split()[0] for f in DIGEST.split(", ")])


def text_media(docs: DataFrame) -> DataFrame:
    """Store every text as a TIFF, read the pages back and digest them: ``DIGEST``, one row per document row.

    One hop: the steps hand batches on within one worker, and nothing is shuffled.
    """
    return _texts(docs).mapInArrow(lambda batches: _digest(_walk(_store(batches))), DIGEST)

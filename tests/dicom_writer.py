"""A small DICOM writer for tests."""

import struct

import numpy as np

from radspark.sources.dicom import DICTIONARY, EXPLICIT, IMPLICIT, LONG_VR


def element(tag: str, vr: str, value: bytes, explicit: bool) -> bytes:
    g, e = (int(x, 16) for x in tag.split(","))
    if len(value) % 2:
        value += b"\0" if vr in ("UI", "OB", "OW", "UN") else b" "
    if not explicit:
        return struct.pack("<HHI", g, e, len(value)) + value
    if vr in LONG_VR:
        return struct.pack("<HH2sHI", g, e, vr.encode(), 0, len(value)) + value
    return struct.pack("<HH2sH", g, e, vr.encode(), len(value)) + value


def sequence(tag: str, items: list[bytes], explicit: bool, undefined: bool = False) -> bytes:
    g, e = (int(x, 16) for x in tag.split(","))
    if undefined:
        body = b"".join(struct.pack("<HHI", 0xFFFE, 0xE000, 0xFFFFFFFF) + i + struct.pack("<HHI", 0xFFFE, 0xE00D, 0) for i in items) + struct.pack("<HHI", 0xFFFE, 0xE0DD, 0)
        n = 0xFFFFFFFF
    else:
        body = b"".join(struct.pack("<HHI", 0xFFFE, 0xE000, len(i)) + i for i in items)
        n = len(body)
    head = struct.pack("<HH2sHI", g, e, b"SQ", 0, n) if explicit else struct.pack("<HHI", g, e, n)
    return head + body


def encode(word: str, value) -> bytes:
    vr = DICTIONARY[word][1] if word in DICTIONARY else "LO"
    if vr == "US":
        return struct.pack(f"<{len(np.atleast_1d(value))}H", *np.atleast_1d(value).tolist())
    return "\\".join(map(str, value)).encode() if isinstance(value, (list, tuple)) else str(value).encode()


def dicom(tags: dict | None = None, pixels: np.ndarray | None = None, syntax: str = EXPLICIT, preamble: bool = True, tables: dict | None = None, undefined: bool = False, fragments: list[bytes] | None = None, drop: tuple = ()) -> bytes:
    """A file: ``tags`` by keyword or gggg,eeee; tables are {word: (first, entries)}."""
    explicit = syntax != IMPLICIT
    base = {"SOPClassUID": "1.2.840.10008.5.1.4.1.1.1.2", "SOPInstanceUID": "1.2.3.4.5", "StudyDate": "20230213", "Modality": "MG", "Manufacturer": "HOLOGIC, Inc.", "PatientID": "P1",
            "StudyInstanceUID": "1.2.3.4", "SeriesInstanceUID": "1.2.3", "SamplesPerPixel": 1, "PhotometricInterpretation": "MONOCHROME2", "Rows": 8, "Columns": 8, "BitsAllocated": 16, "BitsStored": 12,
            "HighBit": 11, "PixelRepresentation": 0, "ImageLaterality": "L", "ViewPosition": "MLO", "BodyPartExamined": "BREAST", "PresentationIntentType": "FOR PRESENTATION"}
    if pixels is not None:
        base |= {"Rows": pixels.shape[-2], "Columns": pixels.shape[-1]}
    base |= tags or {}
    parts = {}
    for w, v in base.items():
        if w in drop or v is None:
            continue
        tag, vr = DICTIONARY.get(w, (w, "LO"))
        parts[tag] = element(tag, vr, encode(w, v), explicit)
    for w, (first, entries) in (tables or {}).items():
        item = element("0028,3002", "US", struct.pack("<3H", len(entries), first, 16), explicit) + element("0028,3006", "US", struct.pack(f"<{len(entries)}H", *entries), explicit)
        parts[DICTIONARY[w][0]] = sequence(DICTIONARY[w][0], [item], explicit, undefined)
    if fragments is not None:
        parts["7FE0,0010"] = struct.pack("<HH2sHI", 0x7FE0, 0x10, b"OB", 0, 0xFFFFFFFF) + struct.pack("<HHI", 0xFFFE, 0xE000, 0) + b"".join(
            struct.pack("<HHI", 0xFFFE, 0xE000, len(f)) + f for f in fragments) + struct.pack("<HHI", 0xFFFE, 0xE0DD, 0)
    elif pixels is not None:
        parts["7FE0,0010"] = element("7FE0,0010", "OW", pixels.tobytes(), explicit)
    body = b"".join(parts[k] for k in sorted(parts))
    if not preamble:
        return body
    meta = element("0002,0010", "UI", syntax.encode(), True)
    return b"\0" * 128 + b"DICM" + element("0002,0000", "UL", struct.pack("<I", len(meta)), True) + meta + body

"""Packing of tokenised documents into fixed-length sequences.

Each document's token ids (plus an end id) are cut into full pieces of
``capacity`` ids and one remainder. Remainders are packed first-fit decreasing
with a tournament tree over the free space of the bins, independently within
randomised groups of about ``group_docs`` documents. Only piece records
(a few numbers each) are shuffled, never texts or ids.

Defined results: a null or empty text is the end id alone; repeated rows are
packed once each; a null doc_id is kept as null; an empty table gives no rows;
extra columns are ignored. Ties are broken by (doc_id, start, ids_crc32, row).
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 2048
GROUP_DOCS = 4096
#: Words in each of the two generations that a worker remembers, and the longest of them.
REMEMBERED, LONG_WORD = 300_000, 64

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, row long"
PACKED = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


class WordEncoder:
    """Token ids of texts, as little-endian unsigned 32-bit bytes, equal to the tokenizer's.

    The tokenizer drops white space and never merges across it, so the ids of a
    text are those of its words in turn. Words are encoded once and remembered
    in two generations: a word that is met again moves to the young one; when
    that is full it becomes the old one, and the old one goes. Words above
    ``LONG_WORD`` characters are not remembered, which bounds the memory in
    bytes. Texts outside Latin-1, or with separators on which Python and the
    tokenizer disagree, go to the tokenizer whole.
    """

    odd = ("\x1c", "\x1d", "\x1e", "\x1f")

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        vocab = self.tok.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        self.remembered = remembered
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _letters(self, words: list[str]) -> dict[str, bytes]:
        """Words of letters only: encoded in one call; each ends with an end-of-word token."""
        if not words:
            return {}
        ids = np.array(self.tok.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        raw, stops = ids.tobytes(), (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
        return {w: raw[a:z] for w, a, z in zip(words, [0, *stops], stops)}

    def learn(self, words: set[str]) -> None:
        """Put words that neither generation holds into the young one."""
        known, old, cores, split = self.known, self.old, set(), []
        for w in words:
            if w.isalpha():
                cores.add(w)
                continue
            core = w.rstrip(".,;:!?*#$%&|()[]{}/=+-_~^@<>\"'")
            if core.isalpha():
                split.append((w, core, w[len(core):]))
                if core not in known and core not in old:
                    cores.add(core)
            else:
                known[w] = self.whole(w)
        fresh = self._letters(list(cores))
        known.update((w, fresh[w]) for w in words & fresh.keys())
        for w, core, tail in split:
            end = known.get(tail) or old.get(tail)
            if end is None:
                end = known[tail] = self.whole(tail)
            known[w] = (fresh.get(core) or known.get(core) or old[core]) + end

    def batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; texts are lowered word by word where that can't matter."""
        if len(self.known) >= self.remembered:
            self.known, self.old = {}, self.known
        known = self.known
        split = [t.lower().split() if (t.isascii() or _latin(t)) and not any(c in t for c in self.odd) else None for t in texts]
        new: set[str] = set().union(*(w for w in split if w is not None))
        new = new.difference(known)  # walks the words of the batch, not the memory
        again = [w for w in new if w in self.old]
        known.update((w, self.old[w]) for w in again)
        new.difference_update(again)
        if new:
            self.learn(new)
        out = [self.whole(t) if words is None else b"".join([known[w] for w in words]) for t, words in zip(texts, split)]
        for w in [w for w in new if len(w) > LONG_WORD]:
            del known[w]
        return out


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


_encoders: dict[tuple[str, int], WordEncoder] = {}


def encoder(path: str, remembered: int = REMEMBERED) -> WordEncoder:
    """One per Python worker, kept between tasks."""
    key = path, remembered
    if key not in _encoders:
        _encoders[key] = WordEncoder(path, remembered)
    return _encoders[key]


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY,
               id_col: str = "doc_id", text_col: str = "text", remembered: int = REMEMBERED) -> DataFrame:
    """One row per piece of each document: ``PIECE``. ``row`` numbers a task's documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, row, end = encoder(tokenizer, remembered), 0, end_id.to_bytes(4, "little")
        for b in batches:
            ids = b.column(0).to_pylist()
            for lo in range(0, len(ids), 256):
                texts = [t or "" for t in b.column(1).slice(lo, 256).to_pylist()]
                out: list[list[int | None]] = [[], [], [], [], [], []]
                for i, raw in zip(ids[lo : lo + 256], enc.batch(texts)):
                    raw += end
                    n = len(raw) // 4
                    for s in range(0, n, capacity):
                        part = raw[4 * s : 4 * (s + capacity)]
                        for col, v in zip(out, (i, s, len(part) // 4, zlib.crc32(part), n, row)):
                            col.append(v)
                    row += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in out],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "row"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, PIECE)


class FreeSpace:
    """Tournament tree: each inner node holds the largest free space below it."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, (bins - 1).bit_length())
        self.tree = [capacity] * (2 * self.leaves)

    def take(self, size: int) -> tuple[int, int]:
        """Put ``size`` into the first bin with room; (bin, its free space before)."""
        tree, at = self.tree, 1
        while at < self.leaves:
            at *= 2
            if tree[at] < size:
                at += 1
        free = tree[at]
        tree[at] = free - size
        spot = at - self.leaves
        at //= 2
        while at:
            left, right = tree[2 * at], tree[2 * at + 1]
            top = left if left >= right else right
            if tree[at] == top:
                break
            tree[at] = top
            at //= 2
        return spot, free


def first_fit_decreasing(lengths: list[int], capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(bin, offset) of each item; ``lengths`` must fall and fit the capacity."""
    tree, out = FreeSpace(max(1, len(lengths)), capacity), []
    for n in lengths:
        spot, free = tree.take(n)
        out.append((spot, capacity - free))
    return out


def pack_pieces(pieces: DataFrame, n_docs: int, capacity: int = CAPACITY, group_docs: int = GROUP_DOCS,
                seed: int = 17) -> DataFrame:
    """Pack pieces within randomised groups of documents; ``sequence_id`` is group * 2**32 + bin."""
    groups = max(1, math.ceil(n_docs / group_docs))

    def run(key, table):
        t = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"),
                           ("ids_crc32", "ascending"), ("row", "ascending")])
        spots = first_fit_decreasing(t.column("length").to_pylist(), capacity)
        base = key[0].as_py() << 32
        t = t.drop_columns(["row", "grp"])
        return (t.append_column("sequence_id", pa.array([base + s for s, _ in spots], pa.int64()))
                .append_column("offset", pa.array([o for _, o in spots], pa.int64())))

    grp = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "doc_tokens", "row"), F.lit(groups))
    return pieces.withColumn("grp", grp).groupBy("grp").applyInArrow(run, PACKED)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY,
                   group_docs: int = GROUP_DOCS, remembered: int = REMEMBERED) -> DataFrame:
    """Tokenise, cut and pack: ``PACKED``, one row per piece; a worker remembers up to twice ``remembered`` words."""
    return pack_pieces(cut_pieces(docs, tokenizer, end_id, capacity, remembered=remembered), docs.count(), capacity, group_docs)

"""Quality classifier: a generalised additive model with pairwise interactions.

Features of a text (lengths, shares of character kinds, repetition, entropy)
are binned; shallow trees, boosted feature by feature in a cycle with a small
rate, add up to one lookup table per feature. Then the pairs of features that
explain most of what is left get two-dimensional tables in the same way.
A text's score is the logistic of the sum of its bins' entries.

Learning uses at most ``max_rows`` labelled rows (those with the smallest hash
of doc_id), a documented bound; scoring covers every whole text.

Defined results: null and empty texts are scored like any other (all counts 0);
labels that are null are left out, a doc_id labelled more than once has its
smallest label; without labels of both kinds every score is the share of 1
among them (0.5 without any); repeated rows score alike; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_ROWS = 20_000
THRESHOLD = 0.3
FEATURES = (
    "log_bytes", "log_words", "mean_word", "unique_words", "upper", "digits", "spaces", "punctuation", "signs",
    "bars", "bangs", "beyond_ascii", "newlines", "repeated_lines", "top_byte", "short_words", "entropy",
    "alphabet", "long_words", "stops_per_word",
)
_UPPER, _LOWER = slice(65, 91), slice(97, 123)
_PUNCT = np.array([i for i in range(33, 127) if not chr(i).isalnum()])
_SIGNS = np.array([ord(c) for c in "#$%&*@^~<>{}[]=+\\"])


def features(text: str | None) -> tuple[float, ...]:
    raw = (text or "").encode("utf-8", "replace")
    n = len(raw)
    h = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256) if n else np.zeros(256, np.int64)
    words = raw.split()
    k = len(words)
    lens = np.fromiter(map(len, words), np.int64, k)
    lines = [x for x in raw.split(b"\n") if x]
    upper = int(h[_UPPER].sum())
    letters = upper + int(h[_LOWER].sum())
    spaces = int(h[32] + h[9:14].sum())
    shown = max(1, n - spaces)
    p = h[h > 0] / max(1, n)
    solid = h.copy()
    solid[[32, 9, 10, 11, 12, 13]] = 0
    return (
        float(np.log1p(n)), float(np.log1p(k)), float(lens.mean()) if k else 0.0, len(set(words)) / k if k else 1.0,
        upper / max(1, letters), int(h[48:58].sum()) / shown, spaces / max(1, n), int(h[_PUNCT].sum()) / shown,
        int(h[_SIGNS].sum()) / shown, int(h[124]) / shown, int(h[33]) / shown, int(h[128:].sum()) / shown,
        int(h[10]) / max(1, n), 1 - len(set(lines)) / len(lines) if lines else 0.0, int(solid.max()) / shown,
        int((lens <= 3).sum()) / max(1, k), float(-(p * np.log2(p)).sum()), float(np.log1p(int((h > 0).sum()))),
        int((lens >= 12).sum()) / max(1, k), int(h[46]) / max(1, k),
    )


def feature_rows(docs: DataFrame, *kept: str) -> DataFrame:
    """The ``kept`` columns and ``x``, the feature vector of ``text``."""
    schema = docs.select(*kept).schema.add("x", T.ArrayType(T.DoubleType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = pa.array([features(t) for t in b.column(0).to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*b.columns[1:], x], names=[*kept, "x"])

    return docs.select("text", *kept).mapInArrow(run, schema)


def _steps(g: np.ndarray, h: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """A tree over ordered bins: greedy cuts, then each leaf's Newton step."""
    cg, ch = np.concatenate(([0.0], np.cumsum(g))), np.concatenate(([0.0], np.cumsum(h)))
    cuts = [0, len(g)]
    for _ in range(leaves - 1):
        best, where = 1e-9, 0
        for lo, hi in zip(cuts, cuts[1:]):
            if hi - lo < 2:
                continue
            at = np.arange(lo + 1, hi)
            gl, hl = cg[at] - cg[lo], ch[at] - ch[lo]
            gr, hr = cg[hi] - cg[at], ch[hi] - ch[at]
            gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - (cg[hi] - cg[lo]) ** 2 / (ch[hi] - ch[lo] + ridge)
            gain[(hl < 1e-3) | (hr < 1e-3)] = -1
            top = int(gain.argmax())
            if gain[top] > best:
                best, where = float(gain[top]), int(at[top])
        if not where:
            break
        cuts = sorted([*cuts, where])
    out = np.zeros(len(g))
    for lo, hi in zip(cuts, cuts[1:]):
        out[lo:hi] = (cg[hi] - cg[lo]) / (ch[hi] - ch[lo] + ridge)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """The best cross cut of a two-dimensional table: (gain, Newton steps of its four leaves)."""
    cg = np.pad(g.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    ch = np.pad(h.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    n, m = g.shape
    i, j = np.arange(1, n)[:, None], np.arange(1, m)[None, :]

    def parts(c: np.ndarray) -> list[np.ndarray]:
        a, top, left = c[i, j], c[i, m], c[n, j]
        return [a, top - a, left - a, c[n, m] - top - left + a]

    pg, ph = parts(cg), parts(ch)
    gain = sum(x**2 / (y + ridge) for x, y in zip(pg, ph)) - cg[n, m] ** 2 / (ch[n, m] + ridge)
    at = np.unravel_index(int(gain.argmax()), gain.shape)
    a, b = at[0] + 1, at[1] + 1
    out = np.zeros_like(g)
    v = [float(x[at] / (y[at] + ridge)) for x, y in zip(pg, ph)]
    out[:a, :b], out[:a, b:], out[a:, :b], out[a:, b:] = v
    return float(gain[at]), out


@dataclass
class Gam:
    """Lookup tables by feature, and by pair of features on coarser bins."""

    base: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    grids: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        f = np.full(len(x), self.base)
        for k, (e, t) in enumerate(zip(self.edges, self.tables)):
            f += t[np.searchsorted(e, x[:, k], side="right")]
        if self.pairs:
            bins = [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(self.coarse)]
            for (a, b), t in zip(self.pairs, self.grids):
                f += t[bins[a], bins[b]]
        return 1 / (1 + np.exp(-np.clip(f, -40, 40)))


def _edges(v: np.ndarray, bins: int) -> np.ndarray:
    u = np.unique(np.quantile(v, np.linspace(0, 1, bins + 1)[1:-1], method="lower"))
    later = np.unique(v)
    at = np.minimum(np.searchsorted(later, u, side="right"), len(later) - 1)
    return np.unique((u + later[at]) / 2)  # between neighbours, so that equal values share a bin


def fit(x: np.ndarray, y: np.ndarray, bins: int = 64, coarse_bins: int = 8, rounds: int = 120, pair_rounds: int = 60,
        n_pairs: int = 8, leaves: int = 3, rate: float = 0.15, ridge: float = 1.0) -> Gam:
    if not len(y) or y.min() == y.max():
        share = float(np.clip(y.mean(), 0.001, 0.999)) if len(y) else 0.5
        return Gam(float(np.log(share / (1 - share))))
    mean = float(y.mean())
    m = Gam(float(np.log(mean / (1 - mean))))
    m.edges = [_edges(x[:, k], bins) for k in range(x.shape[1])]
    m.tables = [np.zeros(len(e) + 1) for e in m.edges]
    at = [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(m.edges)]
    f = np.full(len(y), m.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-f))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for k, (b, t) in enumerate(zip(at, m.tables)):
            if len(t) < 2:
                continue
            g, h = slopes()
            step = rate * _steps(np.bincount(b, g, len(t)), np.bincount(b, h, len(t)), leaves, ridge)
            t += step
            f += step[b]
    m.coarse = [_edges(x[:, k], coarse_bins) for k in range(x.shape[1])]
    at = [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(m.coarse)]
    width = [len(e) + 1 for e in m.coarse]

    def grid(a: int, b: int, v: np.ndarray) -> np.ndarray:
        return np.bincount(at[a] * width[b] + at[b], v, width[a] * width[b]).reshape(width[a], width[b])

    g, h = slopes()
    gains = sorted(((-_quadrants(grid(a, b, g), grid(a, b, h), ridge)[0], a, b) for a, b in combinations(range(x.shape[1]), 2)
                    if width[a] > 1 and width[b] > 1))
    m.pairs = [(a, b) for _, a, b in gains[:n_pairs]]
    m.grids = [np.zeros((width[a], width[b])) for a, b in m.pairs]
    for _ in range(pair_rounds):
        for (a, b), t in zip(m.pairs, m.grids):
            g, h = slopes()
            step = rate * _quadrants(grid(a, b, g), grid(a, b, h), ridge)[1]
            t += step
            f += step[at[a], at[b]]
    return m


def bucket(id_col: str, n: int):
    """crc32 of the id as text, modulo n."""
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(n))


def learn(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Gam:
    """Fit on labelled rows whose crc32(doc_id) mod 5 is not 0, ``max_rows`` of them at most."""
    sample = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
              .where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (bucket("doc_id", 5) != 0))
              .groupBy("doc_id").agg(F.min("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows).withColumnRenamed("doc_id", "labelled"))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    got = own.join(F.broadcast(sample), F.col("doc_id") == F.col("labelled"))  # max_rows rows at most
    rows = feature_rows(got, "doc_id", "quality").orderBy("doc_id", "x").limit(2 * max_rows).toArrow()
    x = np.array(rows.column("x").combine_chunks().flatten()).reshape(-1, len(FEATURES))
    return fit(x, rows.column("quality").to_numpy().astype(float))


def score(docs: DataFrame, model: Gam, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            s = model.score(np.array([features(t) for t in texts]).reshape(-1, len(FEATURES)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    cols = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return cols.select("doc_id", "text", F.coalesce(bucket("doc_id", 5) == 0, F.lit(False)).alias("held_out")).mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier predicts to be good, with their columns."""
    model = learn(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([features(t) for t in b.column(b.schema.get_field_index("text")).to_pylist()])
            yield b.filter(pa.array(model.score(x.reshape(-1, len(FEATURES))) >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)

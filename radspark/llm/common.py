"""Shared pieces of the training-data operators: components of a graph, word and shingle hashes.

``spool`` (from the engine) cuts the lineage by writing Parquet into the shared
checkpoint folder, so that a lost executor costs a re-read, not a recomputation.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from radspark.storage import scratch, spool  # noqa: F401

#: Rows of one Arrow batch: texts of a corpus are long, and a worker holds a batch more than once.
BATCH_ROWS = 2000


def small_batches(spark: SparkSession) -> None:
    """Hold the session's Arrow batches to ``BATCH_ROWS``; smaller settings stay."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


#: Ids are broadcast up to this many (8 bytes each); beyond it the join shuffles.
BROADCAST_IDS = 1_000_000
#: A key that holds more rows than this is joined by broadcast, apart from the others: there are few such keys.
HOT_ROWS = 100_000


def few(ids: DataFrame) -> DataFrame:
    """``ids``, broadcast if they are counted and found few."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """``rows`` joined with one row for each group; groups above ``HOT_ROWS`` rows never meet in one task."""
    hot = groups.where(F.col(size) > HOT_ROWS)
    if hot.isEmpty():
        return rows.join(groups, key)
    return rows.join(F.broadcast(hot), key).unionByName(rows.join(groups.where(F.col(size) <= HOT_ROWS), key))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an undirected graph, by hooking and contraction.

    No step gathers the neighbours of one node, so hubs stay cheap.

    ``edges``: columns ``a``, ``b`` (long). Returns ``node``, ``component``
    (the smallest node that can be reached), for nodes that have an edge to
    another node. Null ends and loops are ignored; an empty table gives none.

    Every round hooks each node to its smallest neighbour, follows those
    pointers to their roots, and keeps only edges between different roots.
    Rounds fall with the logarithm of the longest chain; stars take one.
    """
    spark = edges.sparkSession
    live = spool(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    )
    label: DataFrame | None = None  # node -> root so far
    while not live.isEmpty():
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = spool(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select(
            "node", F.least("node", "low").alias("root")))
        while True:  # pointer jumping
            tops = spool(up.select("root").distinct().join(up.select(F.col("node").alias("root"), F.col("root").alias("top")), "root").where("top <> root"))
            if tops.isEmpty():
                break
            up = spool(up.join(few(tops), "root", "left").select("node", F.coalesce("top", "root").alias("root")))
        if label is None:
            label = up
        else:
            label = spool(
                label.join(up.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
                .select("node", F.coalesce("top", "root").alias("root"))
            )
        live = spool(
            live.join(up.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a")
            .join(up.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b")
            .select(F.greatest("ra", "rb").alias("a"), F.least("ra", "rb").alias("b"))
            .where("a > b").distinct()
        )
    if label is None:
        return spark.createDataFrame([], "node long, component long")
    return label.select("node", F.col("root").alias("component"))


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes (in place on a fresh array)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0x100000001B3 | 1
    inv = pow(base, -1, 1 << 64)
    up = np.full(n + 1, base, dtype=np.uint64)
    down = np.full(n + 1, inv, dtype=np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


_UP, _DOWN = _powers(1 << 12)


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hash of each run of non-space bytes, all at once.

    A polynomial in the bytes, read off a running sum; multiplying by the
    inverse power makes it independent of the word's place.
    """
    global _UP, _DOWN
    if not data:
        return np.zeros(0, dtype=np.uint64)
    raw = np.frombuffer(data, dtype=np.uint8)
    if len(raw) >= len(_UP):
        _UP, _DOWN = _powers(2 * len(raw))
    word = ~_SPACE[raw]
    edge = np.flatnonzero(np.diff(word, prepend=False, append=False))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _UP[: len(raw)], out=total[1:])
    h = (total[end] - total[start]) * _DOWN[start]
    return mix(h + (end - start).astype(np.uint64) * _ODD)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``words``-word shingles of a text.

    A-Z are lowered; words are runs of characters other than space and
    U+0009-U+000D. Fewer words: their whole sequence is the one shingle. No
    words or null: empty.
    """
    h = word_hashes((text or "").encode("utf-8", "replace").lower())
    if not len(h):
        return h
    k = min(words, len(h))
    s = np.full(len(h) - k + 1, k, dtype=np.uint64)
    for i in range(k):
        s = (s ^ h[i : len(h) - k + 1 + i]) * (_ODD + np.uint64(2 * i))
        s ^= s >> np.uint64(29)
    return np.unique(mix(s))

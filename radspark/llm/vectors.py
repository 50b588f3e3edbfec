"""Near-duplicate embeddings by a robust-pruned flat graph on overlapping shards.

1. Equal vectors of a label form a class; one stands for it, with its count.
2. Spherical k-means on a bounded sample gives centroids for each label; shards
   that come out above ``LIMIT`` vectors are split again, each with centroids
   of its own, so centroids grow with the data. Every vector belongs to its
   nearest centroid's shard, and to each shard whose centroid is nearly as
   near: by as much as makes ``TOGETHER`` of made-up pairs at the least cosine
   share a shard (measured at each split on sampled vectors and neighbours
   made for them). Shards that centroids cannot split any more are dealt out by
   hash into parts; every part gets all of the shard's queries, in blocks, so
   nothing is dropped and no task holds more than a part and a block.
3. In each part, nearest candidates are robustly pruned to ``DEGREE``
   neighbours; a few far ones keep the graph in one piece. The adjacency lists
   that a vector got in its different shards are united.
4. Queries walk a part's graph greedily with a beam from several medoids, then
   the range expands from every hit to its neighbours until no new one is
   within it. Both stop at the part: edges to other parts are not followed, so
   links between vectors that share no shard are not found (a query enters
   every part of its own shards from that part's medoids). Hits are verified in
   double precision; only counts and one link to the part's smallest member of
   the same group are passed on. A link counts for both ends, in the first
   shard that both lie in.
5. Recall is audited against brute force for a bounded sample of queries
   (column ``audit_recall``; links found over links there are). Below ``ENOUGH``
   all is done again with a wider overlap, ``REPAIRS`` times at most.

Defined results: rows whose vector or label is null, whose vector is empty,
zero or holds null or non-finite numbers link with nothing, and so do vectors
of different length; rows with a null vec_id too (null component). Rows that
repeat a vec_id are nodes of that id; extra columns, whatever their names, are
ignored; long vectors are vectors like others; an empty table gives none.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from radspark.llm.common import components, join_groups, scratch, spool

LEAST = 0.93
#: Vectors that a shard should and may have, rows of a block of queries.
SHARD, LIMIT, QUERIES = 2048, 4096, 4096
#: Pairs of a query and a row that are weighed at once; it bounds a worker's memory.
PAIRS = 16_384
#: Share of made-up linked pairs that must share a shard after each split, and of those the number.
TOGETHER, MADE_UP = 0.997, 4000
DEGREE, POOL, ALPHA, FAR, BEAM, STEP, MEDOIDS = 16, 48, 1.2, 3, 24, 4, 16
#: Numbers in the sample that first centroids are fitted on, vectors in that of a shard that is split, its most shards, and levels of splits.
SAMPLE_NUMBERS, SPLIT_SAMPLE, SPLIT, LEVELS = 2_000_000, 4096, 32, 6
#: Queries of the audit, the recall that it asks for, and how often a wider overlap is tried.
AUDIT_ROWS, ENOUGH, REPAIRS = 1000, 0.98, 2


def unit_rows(vectors: DataFrame) -> DataFrame:
    """vec_id, label, digest, v (unit length, double); null digest where a row cannot link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dig, unit = [], []
            for e, lab, vid in zip(b.column(2).to_pylist(), b.column(1).to_pylist(), b.column(0).to_pylist()):
                u = None
                if e and lab is not None and vid is not None and None not in e:
                    a = np.array(e, dtype=np.float64)
                    top = np.abs(a).max()
                    if np.isfinite(a).all() and top > 0:
                        a = a / top
                        u = a / np.sqrt((a * a).sum())
                dig.append(None if u is None else hashlib.blake2b(np.array(e, np.float64).tobytes() + str(lab).encode(), digest_size=16).digest())
                unit.append(u)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(dig, pa.binary()), pa.array(unit, pa.list_(pa.float64()))],
                                             names=["vec_id", "label", "digest", "v"])

    cols = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("e"))
    return cols.mapInArrow(run, "vec_id long, label string, digest binary, v array<double>")


def _matrix(column: pa.ChunkedArray | pa.Array, rows: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _means(x: np.ndarray, k: int, seed: int = 3, turns: int = 8) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(turns):
        near = (x @ c.T).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        size = np.sqrt((total**2).sum(axis=1, keepdims=True))
        c = np.where(size > 1e-12, total / np.maximum(size, 1e-12), c)
    return c


def overlap(x: np.ndarray, c: np.ndarray, least: float, together: float = TOGETHER, seed: int = 4) -> float:
    """How much farther (radians) than the nearest centroid a shard's may be, so that linked pairs meet.

    Each sampled vector gets a neighbour at cosine ``least``, half of them
    towards another vector of the sample, half in any direction. A pair meets
    if one centroid is near enough to both.
    """
    if len(c) < 2:
        return 0.0
    rng = np.random.default_rng(seed)
    at = rng.integers(0, len(x), min(MADE_UP, 8 * len(x)))
    u = x[rng.integers(0, len(x), len(at))] + rng.normal(0, 1e-3, (len(at), x.shape[1]))
    half = len(at) // 2
    u[half:] = rng.normal(size=(len(at) - half, x.shape[1]))
    u -= (u * x[at]).sum(axis=1, keepdims=True) * x[at]
    size = np.sqrt((u * u).sum(axis=1, keepdims=True))
    y = least * x[at] + math.sqrt(1 - least * least) * u / np.maximum(size, 1e-12)
    far = []
    for v in (x[at], y):
        ang = np.arccos(np.clip(v @ c.T, -1, 1))
        far.append(ang - ang.min(axis=1, keepdims=True))
    need = np.maximum(*far).min(axis=1)
    return float(max(np.quantile(need[:half], together), np.quantile(need[half:], together)))


def homes_of(x: np.ndarray, c: np.ndarray, spread: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, centroid) of every shard that each vector belongs to."""
    ang = np.arccos(np.clip(x @ c.T, -1, 1))
    return np.nonzero(ang <= ang.min(axis=1, keepdims=True) + spread)


def fit_centroids(reps: DataFrame, least: float, wider: float, shard: int = SHARD, numbers: int = SAMPLE_NUMBERS) -> dict[tuple[str, int], tuple[np.ndarray, float]]:
    """Centroids and overlap by (label, length), from a hash sample of at most about ``numbers`` numbers."""
    counts = reps.groupBy("label", F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum(F.col("n") * F.col("dim")).alias("s")).first()["s"] or 0
    u = F.pmod(F.xxhash64(F.lit(5), "vec_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rate = min(1.0, numbers / max(1, total))
    got = reps.where(u < rate).select("label", "v", "vec_id").orderBy("label", "vec_id").limit(int(numbers)).toArrow()
    out: dict[tuple[str, int], tuple[np.ndarray, float]] = {}
    by: dict[tuple[str, int], list] = {}
    for lab, v in zip(got.column("label").to_pylist(), got.column("v").to_pylist()):
        by.setdefault((lab, len(v)), []).append(v)
    for key, rows in by.items():
        x = np.array(rows)
        c = _means(x, max(1, min(math.ceil(len(x) / rate / shard), len(x) // 8 or 1)))
        out[key] = c, wider * overlap(x, c, least)
    return out


def split_shards(placed: DataFrame, sizes: DataFrame, least: float, wider: float, shard: int, limit: int) -> DataFrame:
    """``placed`` (label, dim, shard and the vectors' columns) with the shards above ``limit`` split in smaller ones.

    Each is fitted on a bounded sample of its own; its vectors are assigned in
    parts, so no task holds a shard.
    """
    key = ["label", "dim", "shard"]
    large = sizes.where(F.col("size") > limit)
    rows = placed.join(large, key)

    def fit(_, table):
        x = _matrix(table.column("v"), table.num_rows)
        x = x[np.argsort(table.column("vec_id").to_numpy(), kind="stable")]
        c = _means(x, max(1, min(SPLIT, math.ceil(table.column("size")[0].as_py() / shard), len(x) // 8)))
        head = table.select(key).slice(0, 1)
        return head.append_column("c", pa.array([c.ravel()], pa.list_(pa.float64()))).append_column("spread", pa.array([wider * overlap(x, c, least)]))

    u = F.pmod(F.xxhash64(F.lit(6), "vec_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    fitted = spool(rows.where(u * F.col("size") < SPLIT_SAMPLE).select("vec_id", "v", "size", *key).groupBy(*key)
                   .applyInArrow(fit, "label string, dim int, shard long, c array<double>, spread double"))
    parts = F.ceil(F.col("size") / limit).cast("int")
    dealt = rows.withColumn("part", F.pmod(F.xxhash64(F.lit(8), "vec_id"), parts).cast("int")).drop("size")
    beside = fitted.join(large, key).withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("size")

    def assign(_, vectors, centres):
        x = _matrix(vectors.column("v"), vectors.num_rows) if vectors.num_rows else np.zeros((0, 1))
        row, k = np.zeros(0, int), np.zeros(0, int)
        if len(x):
            row, k = homes_of(x, _matrix(centres.column("c"), 1).reshape(-1, x.shape[1]), centres.column("spread")[0].as_py())
        out = vectors.drop_columns(["part"]).take(pa.array(row))
        return out.set_column(out.column_names.index("shard"), "shard", pa.array(out.column("shard").to_numpy() * SPLIT + k + 1, pa.int64()))

    after = dealt.groupBy(*key, "part").cogroup(beside.groupBy(*key, "part")).applyInArrow(assign, placed.schema)
    return placed.join(large, key, "left_anti").unionByName(after)


def place(reps: DataFrame, least: float, wider: float, shard: int = SHARD, limit: int = LIMIT, numbers: int = SAMPLE_NUMBERS) -> DataFrame:
    """vec_id, label, dim, v, weight, shard, homes: a row for every shard that a vector lies in."""
    cents = reps.sparkSession.sparkContext.broadcast(fit_centroids(reps, least, wider, shard, numbers))  # bounded by the sample

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            labels, dims = np.array(b.column(1).to_pylist(), object), pa.compute.list_value_length(b.column(2)).to_numpy()
            take, shards, homes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], {}
            for lab, dim in set(zip(labels.tolist(), dims.tolist())):
                own = np.flatnonzero((labels == lab) & (dims == dim))
                c, spread = cents.value.get((lab, dim), (None, 0.0))  # none of its kind is in the sample: one shard
                row, k = (np.arange(len(own)), np.zeros(len(own), np.int64)) if c is None else homes_of(_matrix(b.column(2).take(pa.array(own)), len(own)), c, spread)
                take.append(own[row])
                shards.append(k)
                stop = np.searchsorted(row, np.arange(len(own) + 1))
                homes.update((r, k[stop[j] : stop[j + 1]]) for j, r in enumerate(own.tolist()))
            t = np.concatenate(take)
            cols = [pa.array(np.concatenate(shards), pa.int64()), pa.array([homes[r] for r in t.tolist()], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*[c.take(pa.array(t)) for c in b.columns], *cols], names=["vec_id", "label", "v", "weight", "digest", "shard", "homes"])

    placed = spool(reps.select("vec_id", "label", "v", "weight", "digest")
                   .mapInArrow(assign, "vec_id long, label string, v array<double>, weight long, digest binary, shard long, homes array<long>").withColumn("dim", F.size("v")))
    before = None
    for _ in range(LEVELS):
        sizes = spool(placed.groupBy("label", "dim", "shard").agg(F.count(F.lit(1)).alias("size")))
        most = sizes.agg(F.max("size").alias("most")).first()["most"] or 0
        if most <= limit or (before is not None and most > 0.9 * before):  # no larger than allowed, or centroids do not part them
            break
        before = most
        # numbers of split shards stay apart from those of others: children of s are s * SPLIT + 1 ... s * SPLIT + SPLIT, of a level above them all
        base = sizes.agg(F.max("shard").alias("top")).first()["top"] + 1
        placed = spool(split_shards(placed.withColumn("shard", F.col("shard") + base), sizes.withColumn("shard", F.col("shard") + base), least, wider, shard, limit))
    if before is None:
        return placed
    homes = placed.groupBy("digest", "vec_id").agg(F.collect_set("shard").alias("homes"))  # as many as its shards
    return spool(placed.drop("homes").join(homes, ["digest", "vec_id"]))


def _edges(n: int, src: np.ndarray, dst: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Neighbours of rows 0..n-1 in one array, and where each row's begin; each once."""
    key = np.unique(src[src != dst] * n + dst[src != dst])
    return key % n, np.searchsorted(key, np.arange(n + 1) * n)


def prune(x: np.ndarray, degree: int = DEGREE, pool: int = POOL, alpha: float = ALPHA, far: int = FAR) -> tuple[np.ndarray, np.ndarray]:
    """Robust-pruned neighbours of each row within ``x``, those that chose it (``degree`` at most), and a few far ones; as ``_edges``."""
    n = len(x)
    if n <= 1:
        return np.zeros(0, np.int64), np.zeros(n + 1, np.int64)
    k = min(pool, n - 1)
    src, dst = [], []
    for lo in range(0, n, 256):
        rows = np.arange(lo, min(n, lo + 256))
        s = x[rows] @ x.T
        s[rows - lo, rows] = -2
        cand = np.argpartition(-s, k - 1, axis=1)[:, :k]
        near = np.take_along_axis(s, cand, axis=1)
        order = np.argsort(-near, axis=1, kind="stable")
        cand, near = np.take_along_axis(cand, order, axis=1), np.take_along_axis(near, order, axis=1)
        dist = 1 - near  # half of the squared distances, so alpha counts squared
        xc = x[cand]
        blocks = alpha * alpha * (1 - xc @ xc.transpose(0, 2, 1)) <= dist[:, None, :]  # [p, q]: p stands before q
        free, line = np.ones(cand.shape, bool), np.arange(len(rows))
        for _ in range(min(degree, k)):
            p = free.argmax(axis=1)
            on = free[line, p]
            if not on.any():
                break
            src.append(rows[on])
            dst.append(cand[line, p][on])
            free &= ~(blocks[line, p] & on[:, None])
            free[line, p] = False
    src, dst = np.concatenate(src), np.concatenate(dst)
    order = np.lexsort((src, dst))
    rank = np.arange(len(dst)) - np.searchsorted(dst[order], dst[order])
    back = order[rank < degree]
    i, j = np.repeat(np.arange(n), far), np.tile(np.arange(1, far + 1) * 2654435761, n)
    return _edges(n, np.concatenate([src, dst[back], i]), np.concatenate([dst, src[back], j * (i + 1) % n]))


def _medoids(x: np.ndarray, k: int) -> np.ndarray:
    """Rows that lie far from one another, beginning with the one nearest the mean."""
    first = int((x @ x.mean(axis=0)).argmax())
    picked, near = [first], x @ x[first]
    for _ in range(min(k, len(x)) - 1):
        nxt = int(near.argmin())
        picked.append(nxt)
        near = np.maximum(near, x @ x[nxt])
    return np.unique(picked)


def search(q: np.ndarray, x: np.ndarray, adj: np.ndarray, entries: np.ndarray, least: float, beam: int = BEAM, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """Range search of a block of queries: (query, row) of every hit found.

    ``adj``: neighbours by row, padded with -1. All queries step together, each
    from its ``step`` best rows not yet left. The walk is in single precision;
    what comes near ``least`` is verified in double.
    """
    nq, n = len(q), len(x)
    q4, x4, close = q.astype(np.float32), x.astype(np.float32), least - 1e-4
    seen, hit = np.zeros(nq * n, bool), np.zeros((nq, n), bool)
    seen.reshape(nq, n)[:, entries] = True

    def meet(a: np.ndarray, u: np.ndarray) -> np.ndarray:
        s = np.empty(len(a), np.float32)
        for lo in range(0, len(a), PAIRS):
            i, j = a[lo : lo + PAIRS], u[lo : lo + PAIRS]
            s[lo : lo + PAIRS] = np.einsum("pd,pd->p", q4[i], x4[j])
            near = np.flatnonzero(s[lo : lo + PAIRS] >= close)
            ok = near[np.einsum("pd,pd->p", q[i[near]], x[j[near]]) >= least]
            hit[i[ok], j[ok]] = True
        return s

    def fresh(a: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, neighbour) never met before, each once, from rows ``u`` of queries ``a``."""
        nb = adj[u]
        row, col = np.nonzero(nb >= 0)
        key = a[row] * n + nb[row, col]
        key = np.unique(key[~seen[key]])
        seen[key] = True
        return key // n, key % n

    first = np.repeat(np.arange(nq), len(entries))
    s0 = meet(first, np.tile(entries, nq)).reshape(nq, -1)
    ids, sims = np.tile(entries, (nq, 1)), s0
    done = np.zeros(ids.shape, bool)
    while True:
        open_ = np.where(done, np.float32(-4), sims)
        best = np.argsort(-open_, axis=1, kind="stable")[:, :step]
        row, k = np.nonzero(np.take_along_axis(open_, best, axis=1) > -3)
        if not len(row):
            break
        col = best[row, k]
        done[row, col] = True
        a, u = fresh(row, ids[row, col])
        if not len(a):
            continue
        s = meet(a, u)
        rank = np.arange(len(a)) - np.searchsorted(a, a)  # new ones beside those held, the best stay
        width = ids.shape[1]
        more = np.zeros((nq, width + int(rank.max()) + 1), ids.dtype)
        more_s, more_d = np.full(more.shape, np.float32(-5)), np.ones(more.shape, bool)
        more[:, :width], more_s[:, :width], more_d[:, :width] = ids, sims, done
        more[a, width + rank], more_s[a, width + rank], more_d[a, width + rank] = u, s, False
        top = np.argpartition(-more_s, min(beam, more.shape[1]) - 1, axis=1)[:, :beam]
        ids, sims, done = (np.take_along_axis(m, top, axis=1) for m in (more, more_s, more_d))
    spread = np.zeros_like(hit)
    while True:  # the range expands from hit to hit
        qi, xi = np.nonzero(hit & ~spread)
        if not len(qi):
            break
        spread[qi, xi] = True
        for lo in range(0, len(qi), PAIRS // 4):
            meet(*fresh(qi[lo : lo + PAIRS // 4], xi[lo : lo + PAIRS // 4]))
    return np.nonzero(hit)


def _lower(homes: pa.ListArray, shard: int) -> np.ndarray:
    """By row, which of the shards before ``shard`` a vector lies in (1 or 0, a column for each that occurs)."""
    row, at = np.repeat(np.arange(len(homes)), pa.compute.list_value_length(homes).to_numpy()), homes.flatten().to_numpy()
    row, at = row[at < shard], at[at < shard]
    kinds, col = np.unique(at, return_inverse=True)
    out = np.zeros((len(homes), len(kinds)), np.float32)
    out[row, col] = 1
    return out


def _links(reps: DataFrame, least: float, wider: float, shard: int, limit: int, numbers: int) -> DataFrame:
    """vec_id, links, root: links that each part counts for its vectors, and the smallest member they lead to."""
    placed = place(reps, least, wider, shard, limit, numbers)
    shard_key = ["label", "dim", "shard"]
    sizes = spool(placed.groupBy(*shard_key).agg(F.count(F.lit(1)).alias("size")))
    parts = F.ceil(F.col("size") / limit).cast("int")
    blocks = F.ceil(F.col("size") / QUERIES).cast("int")
    nodes = placed.drop("digest").join(sizes, shard_key).withColumn("part", F.pmod(F.xxhash64("vec_id"), parts).cast("int"))

    def build(key, table):
        ids = table.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        near, stops = prune(_matrix(table.column("v"), len(ids))[order])
        ids = ids[order]
        return pa.table({"vec_id": pa.array(ids, pa.int64()), "near": pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(ids[near], pa.int64()))})

    built = nodes.select("vec_id", "v", *shard_key, "part").groupBy(*shard_key, "part").applyInArrow(build, "vec_id long, near array<long>")
    union = spool(built.groupBy("vec_id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")))  # a list for each shard

    block = F.pmod(F.xxhash64("vec_id", F.lit(2)), blocks).cast("int")
    # a row is a target of its own part for every block, and a query of its own block for every part; where the two meet, both
    roles = F.transform(F.sequence(F.lit(0), blocks - 1), lambda b: F.struct(F.col("part").alias("part"), b.alias("block"), F.lit(True).alias("target"), (b == block).alias("query")))
    asked = F.filter(F.transform(F.sequence(F.lit(0), parts - 1), lambda p: F.struct(p.alias("part"), block.alias("block"), F.lit(False).alias("target"), F.lit(True).alias("query"))),
                     lambda r: r["part"] != F.col("part"))
    rows = (nodes.join(union, "vec_id").withColumn("role", F.explode(F.concat(roles, asked)))
            .select("vec_id", "v", "weight", F.when(F.col("role.target"), F.col("near")).alias("near"), "homes", *shard_key, "role.*"))

    def walk(key, table):
        ids, weight = table.column("vec_id").to_numpy(), table.column("weight").to_numpy()
        t = np.flatnonzero(table.column("target").to_numpy(zero_copy_only=False))
        q = np.flatnonzero(table.column("query").to_numpy(zero_copy_only=False))
        if not len(t) or not len(q):
            return pa.table({"vec_id": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        v = _matrix(table.column("v"), table.num_rows)
        t = t[np.argsort(ids[t], kind="stable")]
        near = table.column("near").combine_chunks().take(pa.array(t))
        flat, own = near.flatten().to_numpy(), np.repeat(np.arange(len(t)), pa.compute.list_value_length(near).to_numpy())
        spot = np.minimum(np.searchsorted(ids[t], flat), len(t) - 1)
        here = ids[t][spot] == flat  # the others lie in other parts
        to, stops = _edges(len(t), own[here], spot[here])
        adj = np.full((len(t), max(1, int(np.diff(stops).max()))), -1)
        adj[np.repeat(np.arange(len(t)), np.diff(stops)), np.arange(len(to)) - np.repeat(stops[:-1], np.diff(stops))] = to
        x, entries = v[t], _medoids(v[t], MEDOIDS)
        root_q, root_t = ids[q].copy(), ids[t].copy()
        hits = np.zeros((len(q), len(t)), bool)
        for lo in range(0, len(q), 256):
            part_q = q[lo : lo + 256]
            a, b = search(v[part_q], x, adj, entries, least)
            other = ids[t[b]] != ids[part_q[a]]
            hits[lo + a[other], b[other]] = True
        _, both_q, both_t = np.intersect1d(ids[q], ids[t], return_indices=True)
        same = hits[np.ix_(both_q, both_t)]
        hits[np.ix_(both_q, both_t)] = same | same.T  # found from either end
        linked = np.flatnonzero(hits.any(axis=1))
        top, moved = np.iinfo(np.int64).max, len(linked) > 0
        while moved:  # smallest member that these links reach
            moved = False
            for lo in range(0, len(linked), 256):
                own = linked[lo : lo + 256]
                low = np.minimum(root_q[own], np.where(hits[own], root_t, top).min(axis=1))
                back = np.minimum(root_t, np.where(hits[own], low[:, None], top).min(axis=0))
                moved |= bool((low < root_q[own]).any() or (back < root_t).any())
                root_q[own], root_t = low, back
        lower = _lower(table.column("homes").combine_chunks(), key[2].as_py())
        links, links_t = np.zeros(len(q), np.int64), np.zeros(len(t), np.int64)
        for lo in range(0, len(q), 256):  # a link counts once, for both ends: from the smaller id, in the first shard that both ends lie in
            part_q = q[lo : lo + 256]
            count = hits[lo : lo + 256] & (ids[part_q][:, None] < ids[t])
            if lower.shape[1]:
                count &= lower[part_q] @ lower[t].T == 0
            a, b = np.nonzero(count)
            np.add.at(links, lo + a, weight[t[b]])
            np.add.at(links_t, b, weight[part_q[a]])
        every = np.concatenate([ids[q], ids[t]])
        roots, n = np.concatenate([root_q, root_t]), np.concatenate([links, links_t])
        some_ = (n > 0) | (roots != every)
        return pa.table({"vec_id": pa.array(every[some_], pa.int64()), "links": pa.array(n[some_], pa.int64()), "root": pa.array(roots[some_], pa.int64())})

    return spool(rows.groupBy(*shard_key, "part", "block").applyInArrow(walk, "vec_id long, links long, root long"))


def near_duplicates(vectors: DataFrame, least: float = LEAST, shard: int = SHARD, limit: int = LIMIT, numbers: int = SAMPLE_NUMBERS, wider: float = 1.0) -> DataFrame:
    """vec_id, n_links, component_id, kept, audit_recall for every row of ``vectors`` (vec_id, embedding, label).

    ``wider`` is a factor on the measured overlap of shards.
    """
    with scratch() as keep:
        units = keep(spool(unit_rows(vectors)))
        some = units.where("digest is not null")
        classes = spool(some.groupBy("digest").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight")))
        # an id may hold several vectors; of a class's copies only the rows of the least id are taken along
        reps = spool(some.join(classes.select("digest", F.col("rep").alias("vec_id"), "weight"), ["digest", "vec_id"])
                     .groupBy("vec_id", "digest").agg(F.first("label").alias("label"), F.first("v").alias("v"), F.first("weight").alias("weight")))
        for turn in range(REPAIRS + 1):
            found = _links(reps, least, wider * 1.5**turn, shard, limit, numbers)
            counts = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
            facts = keep(spool(classes.join(counts.withColumnRenamed("vec_id", "rep"), "rep", "left")
                               .select("digest", "rep", "weight", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))))
            recall = audit(reps, facts, least)
            if recall >= ENOUGH:
                break
        copies = join_groups(some.select("digest", "vec_id"), classes.where("weight > 1"), "digest", "weight").select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))
        comp = keep(spool(components(found.select(F.col("vec_id").alias("a"), F.col("root").alias("b")).unionByName(copies))))
    out = join_groups(units.select("vec_id", "digest"), facts.select("digest", "n_links", "weight"), "digest", "weight").select("vec_id", "n_links")
    out = out.unionByName(units.where("digest is null").select("vec_id", F.lit(0).cast("long").alias("n_links")))
    out = out.join(comp.withColumnRenamed("node", "vec_id"), "vec_id", "left")
    c = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), c.alias("component_id"), (F.col("vec_id") == c).alias("kept"),
                      F.lit(recall).alias("audit_recall"))


def audit(reps: DataFrame, facts: DataFrame, least: float = LEAST, rows: int = AUDIT_ROWS) -> float:
    """Links found over links there are, for ``rows`` classes chosen by hash; 1 where there are none."""
    picked = reps.orderBy(F.xxhash64(F.lit(9), "vec_id"), "vec_id").limit(rows).join(facts.withColumnRenamed("rep", "vec_id").select("vec_id", "digest", "n_links"), ["vec_id", "digest"]).collect()
    by: dict[tuple[str, int], list[int]] = {}
    for k, r in enumerate(picked):
        by.setdefault((r["label"], len(r["v"])), []).append(k)
    own = {key: (np.array(ks), np.array([picked[k]["v"] for k in ks])) for key, ks in by.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(picked), np.int64)
        for b in batches:
            labels, n = np.array(b.column(1).to_pylist(), object), b.column(3).to_numpy()
            dims = pa.compute.list_value_length(b.column(2)).to_numpy()
            for (lab, dim), (ks, v) in own.items():
                same = np.flatnonzero((labels == lab) & (dims == dim))
                if len(same):
                    total[ks] += n[same] @ (_matrix(b.column(2).take(pa.array(same)), len(same)) @ v.T >= least)
        k = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(total[k], pa.int64())], names=["k", "n"])

    true = {r["k"]: r["n"] for r in reps.select("vec_id", "label", "v", "weight").mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()}
    there = [true.get(k, 1) - 1 for k in range(len(picked))]
    return float(sum(min(r["n_links"], t) for r, t in zip(picked, there)) / sum(there)) if sum(there) else 1.0

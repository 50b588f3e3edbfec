"""Near-duplicate documents by MinHash: a signature-coordinate inverted join.

1. Every document gets its set of 5-word shingles, a signature of ``coords``
   minima, and a digest of the set. Equal sets form a class; one member stands
   for it from here on.
2. Representatives are posted under each (coordinate, value). Values held by
   one representative cannot collide and go. A pair above the match threshold
   shares at least ``matches`` postings, so, with postings ordered from rare to
   common, it meets within the prefix of all but ``matches - 1`` of them; the
   common rest is never merged (prefix merging).
3. In each posting list, representatives meet a few leaders first; pairs with
   enough equal coordinates are confirmed on the full sets. What is then
   connected is skipped (skip merging); only pairs across components remain,
   which are counted block by block and confirmed likewise, until none is left.
   The links found connect exactly what all links would.

Links are exact (100 * intersection >= 75 * union on whole sets); a true link
is missed only if fewer than ``matches`` of ``coords`` minima agree (13 of 32:
about 2 in 100,000 at similarity 0.75, less above), or, in the step across
components and for sets above ``LOW`` shingles, if the estimate from their
smallest hashes falls 4.5 deviations short (about 1 in 300,000 at similarity
0.75, less above).

Defined results: null texts and texts without words have an empty set and link
with nothing; rows that repeat a doc_id are one node of the graph, each row is
returned with its own n_shingles; rows with a null doc_id link with nothing
and get a null component; extra columns are ignored; an empty table gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from radspark.llm.common import components, few, join_groups, mix, scratch, shingle_set, spool

WORDS, COORDS, MATCHES = 5, 32, 13
PERCENT = 75
#: Rows of one side in a block of the exhaustive step.
BLOCK = 1024
ROUNDS, LEADERS = 3, 3
#: Smallest hashes of a set that stand for it where pairs across components are weighed.
LOW = 512


def _multipliers(coords: int) -> np.ndarray:
    return mix(np.arange(1, coords + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def signature(s: np.ndarray, mult: np.ndarray) -> np.ndarray:
    """The least value of the set under each coordinate's hash."""
    out = np.full(len(mult), np.iinfo(np.uint64).max, dtype=np.uint64)
    for lo in range(0, len(s), 512):
        np.minimum(out, (s[None, lo : lo + 512] * mult[:, None]).min(axis=1), out=out)
    return out


def signatures(docs: DataFrame, words: int = WORDS, coords: int = COORDS) -> DataFrame:
    """doc_id, n_shingles, digest (of the set), sig; null sig where the set is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mult = _multipliers(coords)
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                ids, texts = b.column(0).slice(lo, 512), b.column(1).slice(lo, 512).to_pylist()
                n, dig, sig = [], [], []
                for t in texts:
                    s = shingle_set(t, words)
                    n.append(len(s))
                    dig.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    sig.append(signature(s, mult).view(np.int64) if len(s) else None)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(n, pa.int64()), pa.array(dig, pa.binary()), pa.array(sig, pa.list_(pa.int64()))],
                    names=["doc_id", "n_shingles", "digest", "sig"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_shingles long, digest binary, sig array<long>")


def shingle_sets(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, digest, grams: the whole set of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                sets = [shingle_set(t, words).view(np.int64) for t in b.column(1).slice(lo, 256).to_pylist()]
                digests = [hashlib.blake2b(v.tobytes(), digest_size=16).digest() for v in sets]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, 256), pa.array(digests, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], names=["doc_id", "digest", "grams"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, digest binary, grams array<long>")


def _equal_coords(x: str, y: str):
    same = F.zip_with(x, y, lambda p, q: (p == q).cast("int"))
    return F.aggregate(same, F.lit(0), lambda acc, v: acc + v)


def confirm(pairs: DataFrame, reps: DataFrame, sets: DataFrame, matches: int, percent: int) -> DataFrame:
    """Of candidate pairs (a, b): those with enough equal coordinates, sizes and intersection."""
    left = reps.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("na"), F.col("sig").alias("sa"))
    right = reps.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("nb"), F.col("sig").alias("sb"))
    small, large = F.least("na", "nb"), F.greatest("na", "nb")
    near = spool(
        pairs.join(left, "a").join(right, "b")
        .where(100 * small >= percent * large).where(_equal_coords("sa", "sb") >= matches)
        .select("a", "b").distinct())
    ga = sets.select(F.col("doc_id").alias("a"), F.col("grams").alias("ga"))
    gb = sets.select(F.col("doc_id").alias("b"), F.col("grams").alias("gb"))
    both = F.size(F.array_intersect("ga", "gb")).cast("long")
    union = F.size("ga") + F.size("gb") - F.col("both")
    return near.join(ga, "a").join(gb, "b").withColumn("both", both).where(100 * F.col("both") >= percent * union).select("a", "b")


def _likely(a: np.ndarray, b: np.ndarray, whole: bool, percent: int) -> bool:
    """Whether two sets may reach the similarity, by their smallest hashes (all of them if ``whole``)."""
    if not whole:  # below the smaller of the two ends both samples are complete
        end = min(a[-1], b[-1])
        a, b = a[: np.searchsorted(a, end, side="right")], b[: np.searchsorted(b, end, side="right")]
    at = np.searchsorted(a, b)
    both = int((a[np.minimum(at, len(a) - 1)] == b).sum())
    union = len(a) + len(b) - both
    slack = 1.0 / union if whole else 4.5 * (0.1875 / union) ** 0.5
    return both / union >= percent / 100 - slack


def _across(posts: DataFrame, matches: int, percent: int) -> DataFrame:
    """Pairs of one posting list in different components that may be links.

    ``posts``: token, coord, doc_id, mask (coordinates of the document's
    prefix, as bits), comp, n_shingles, sig, low (its smallest hashes), size
    (of the list). A pair is looked at only in the list of the first prefix
    coordinate that it shares. Lists are dealt out in pairs of blocks, so a
    task holds two blocks at most.
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("doc_id"), blocks).cast("int")
    dealt = (posts.withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .select("token", "coord", "doc_id", "mask", "comp", "n_shingles", "sig", "low", "own",
                     F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi")))

    def run(key, table):
        ids = table.column("doc_id").to_numpy()
        comp, own_, n, mask, coord = (table.column(c).to_numpy() for c in ("comp", "own", "n_shingles", "mask", "coord"))
        sig = np.array(table.column("sig").combine_chunks().flatten()).reshape(len(ids), -1)
        low = [v.values.to_numpy() for v in table.column("low").combine_chunks()]
        bits = (mask[:, None] >> np.arange(sig.shape[1])) & 1 == 1
        lo, hi = key[1].as_py(), key[2].as_py()
        first, second = np.flatnonzero(own_ == lo), np.flatnonzero(own_ == hi)
        a, b = [], []
        for i in first:
            js = second[(comp[second] != comp[i]) & (ids[second] != ids[i])]
            if lo == hi:
                js = js[ids[js] > ids[i]]
            js = js[100 * np.minimum(n[js], n[i]) >= percent * np.maximum(n[js], n[i])]
            same = sig[js] == sig[i]
            here = (same & bits[js] & bits[i]).argmax(axis=1) == coord[i]
            js = js[(same.sum(axis=1) >= matches) & here]
            for j in js:
                whole = len(low[i]) == n[i] and len(low[j]) == n[j]
                if _likely(low[i], low[j], whole, percent):
                    a.append(max(ids[i], ids[j]))
                    b.append(min(ids[i], ids[j]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.groupBy("token", "lo", "hi").applyInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, words: int = WORDS, coords: int = COORDS, matches: int = MATCHES,
                    percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text)."""
    with scratch() as keep:
        sig = keep(spool(signatures(docs, words, coords)))
        comp = keep(spool(_groups(docs, sig, words, matches, percent)))
    out = sig.join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    c = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", c.alias("component_id"), (F.col("doc_id") == c).alias("kept"))


def _groups(docs: DataFrame, sig: DataFrame, words: int, matches: int, percent: int) -> DataFrame:
    """node, component of all documents that are linked."""
    some = sig.where("digest is not null and doc_id is not null")
    classes = spool(some.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n")))
    copies = join_groups(some.select("digest", "doc_id"), classes.where("n > 1"), "digest", "n").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    own = (some.join(classes.select("digest", F.col("rep").alias("doc_id")), ["digest", "doc_id"], "left_semi"))
    # a doc_id with several texts stands once for each of them
    reps = spool(own.groupBy("doc_id", "digest").agg(F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig")))

    posts = reps.select("doc_id", F.posexplode("sig").alias("coord", "value")).select(
        "doc_id", "coord", F.xxhash64("coord", "value").alias("token"))
    shared = spool(posts.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    met = posts.join(shared, "token").groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("n", "token", "coord"))).alias("ts"))  # coords at most
    size = F.size("ts")
    kept = F.slice("ts", F.lit(1), size - (matches - 1))
    mask = F.aggregate(kept, F.lit(0).cast("long"), lambda m, t: m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), t["coord"])))
    prefix = spool(
        met.where(size >= matches)
        .select("doc_id", mask.alias("mask"), F.explode(kept).alias("t"))
        .select("doc_id", "mask", F.col("t.token").alias("token"), F.col("t.coord").alias("coord")))

    touched = spool(prefix.select(F.col("doc_id").alias("wanted")).distinct())
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets = spool(shingle_sets(texts.join(few(touched), F.col("doc_id") == F.col("wanted"), "left_semi"), words).distinct())
    found: DataFrame | None = None
    turn = 0
    while turn <= ROUNDS:
        if found is None:
            now = prefix.withColumn("comp", F.col("doc_id"))
        else:
            comp = spool(components(found))
            now = spool(prefix.join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left")
                        .select("token", "coord", "doc_id", "mask", F.coalesce("component", "doc_id").alias("comp")))
        mixed = spool(now.groupBy("token").agg(F.min("comp").alias("least"), F.max("comp").alias("most"),
                                               F.count(F.lit(1)).alias("size")).where("least < most"))
        if mixed.isEmpty():  # no list holds two components any more
            break
        open_posts = now.join(mixed.select("token", "size"), "token")
        if turn == ROUNDS:
            smallest = F.transform(F.slice("grams", F.lit(1), F.lit(LOW)), lambda g: F.shiftrightunsigned(g, 32).cast("long"))
            low = sets.groupBy("doc_id", "digest").agg(F.first(smallest).alias("low"))
            facts = reps.join(low, ["doc_id", "digest"]).select("doc_id", "n_shingles", "sig", "low")
            pairs = spool(_across(open_posts.join(facts, "doc_id"), matches, percent))
        else:
            lead = [F.min_by("doc_id", F.xxhash64("doc_id", F.lit(turn * LEADERS + k))) for k in range(LEADERS)]
            lead_comp = [F.min_by("comp", F.xxhash64("doc_id", F.lit(turn * LEADERS + k))) for k in range(LEADERS)]
            heads = spool(open_posts.groupBy("token").agg(
                F.array_distinct(F.array(*[F.struct(d.alias("lead"), c.alias("lead_comp")) for d, c in zip(lead, lead_comp)])).alias("heads")))
            met_lead = open_posts.join(heads, "token").select("doc_id", "comp", F.explode("heads").alias("h"))
            pairs = (met_lead.where("doc_id <> h.lead and comp <> h.lead_comp")
                     .select(F.greatest("doc_id", "h.lead").alias("a"), F.least("doc_id", "h.lead").alias("b")).distinct())
        got = spool(confirm(pairs, reps, sets, matches, percent))
        if turn < ROUNDS and got.isEmpty():  # leaders find nothing more: straight to the step that is exhaustive
            turn = ROUNDS
            continue
        found = got if found is None else spool(found.unionByName(got))
        turn += 1
    return components(copies if found is None else copies.unionByName(found))


def keep_one(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with one document of each group of near duplicates, and one row of each doc_id.

    Rows without a doc_id stay. Dropped ids are broadcast only while they are
    few; the rows that repeat an id are settled apart, so texts of other rows
    are never shuffled for them (the smallest text stays).
    """
    found = near_duplicates(docs, **how)
    rows = spool(found.groupBy("doc_id").agg(F.min("kept").alias("kept"), F.count(F.lit(1)).alias("n")).where("doc_id is not null and (not kept or n > 1)"))
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns])  # under one name, so that no column of the documents can clash
    held = docs.select(F.col("doc_id").cast("long").alias("id"), own.alias("row"))
    back = [F.col("row").getField(c).alias(c) for c in docs.columns]

    def ids(which: str) -> DataFrame:
        return few(rows.where(which).select(F.col("doc_id").alias("id")))

    left = held.join(ids("not kept"), "id", "left_anti")
    if rows.where("kept and n > 1").isEmpty():
        return left.select(*back)
    once = left.join(ids("kept and n > 1"), "id", "left_anti")
    again = left.join(ids("kept and n > 1"), "id", "left_semi").groupBy("id").agg(
        F.min_by("row", F.struct(F.col("row.text"), F.xxhash64("row"))).alias("row"))
    return once.unionByName(again.select("id", "row")).select(*back)

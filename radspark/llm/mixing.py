"""Mixing sources to target weights by iterative proportional fitting.

Token counts are summed by cell (source, language, topic). Cell weights are
raked in turn to the wanted shares of sources, languages and topics until the
margins fit. A document is wanted its cell's factor times the sampling rate
times (``times``): the whole part in copies, and one more with the probability
``prob`` that is left. A hash of its id decides, so the choice is the same on
every run and on every cluster, and the expected margins of the sample are the
raked ones, also where a cell is wanted more often than it is held.

Topics come from the whole text: every word of ``LEAST_BYTES`` UTF-8 bytes or
more (A-Z lowered) votes for the topic that its hash names; most votes win,
then the smaller topic. So near copies share their topic, and no opening or
prefix decides it.

Cells are raked in the driver while there are at most ``SMALL_CELLS`` of them
(a count checked first), beyond it as a DataFrame, cut off after each margin.

Defined results: tokens are runs of characters other than space and
U+0009-U+000D, at least 1 a document, so null and empty texts weigh 1; null
source or language is a group of its own; a ``topic`` column, where there is
one, is taken instead; texts without a voting word are of topic t0; a group
for which given shares name no target is wanted 0 times; texts of any length
are read in segments, so long ones need no more memory; rows that repeat a
doc_id share its fate; extra columns, whatever their names, are ignored by
``weigh`` and kept by ``sample``; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from radspark.llm.common import spool

MARGINS = ("source", "lang", "topic")
TOPICS, LEAST_BYTES, CYCLES, TEMPERATURE, RATE, SEED = 8, 5, 6, 0.7, 0.8, "mix-1"
#: Cells are raked in the driver and broadcast to the documents up to this many; beyond it joins shuffle.
SMALL_CELLS = 200_000
#: Bytes of text that a worker looks at in one go.
SEGMENT = 1 << 20
#: Multiplier of the words' hash, modulo 2**32.
BASE = 16777619

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        for name, b in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"], _powers["down"]


def _segments(rows: list[bytes]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Rows in groups of about ``SEGMENT`` bytes; longer ones are cut at white space."""
    at: list[int] = []
    held: list[bytes] = []
    size = 0
    for i, data in enumerate(rows):
        lo = 0
        while lo < len(data):
            hi = lo + SEGMENT
            while hi < len(data) and not _SPACE[data[hi]]:
                hi += 1
            part = data[lo:hi]
            lo = hi
            if held and size + len(part) > SEGMENT:
                yield at, held
                at, held, size = [], [], 0
            at.append(i)
            held.append(part)
            size += len(part)
    if held:
        yield at, held


def count_words(rows: list[bytes], topics: int = TOPICS) -> tuple[np.ndarray, np.ndarray]:
    """Words of each text, and the votes of its longer words for each topic."""
    n, votes = np.zeros(len(rows), np.int64), np.zeros((len(rows), topics), np.int64)
    for at, parts in _segments(rows):
        raw = np.frombuffer(b" ".join(parts), np.uint8)
        edge = np.flatnonzero(np.diff(~_SPACE[raw], prepend=False, append=False))
        start, end = edge[::2], edge[1::2]
        if not len(start):
            continue
        first = np.cumsum([0, *[len(p) + 1 for p in parts[:-1]]])
        row = np.array(at)[np.searchsorted(first, start, side="right") - 1]
        n += np.bincount(row, minlength=len(rows))
        up, down = _power_tables(len(raw) + 1)
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_LOWER[raw] * up[: len(raw)], out=total[1:])
        long = end - start >= LEAST_BYTES
        h = (total[end[long]] - total[start[long]]) * down[start[long]]
        topic = (h & np.uint64(0xFFFFFFFF)) >> np.uint64(16)
        votes += np.bincount(row[long] * topics + (topic % np.uint64(topics)).astype(np.int64), minlength=votes.size).reshape(votes.shape)
    return n, votes


def described(docs: DataFrame, topics: int = TOPICS) -> DataFrame:
    """One struct ``d`` for each row: source, lang, topic (never null), tokens; the row itself as ``row``."""

    def tell(text: pa.Array) -> pa.Array:
        n, votes = count_words([(t or "").encode("utf-8", "replace") for t in text.to_pylist()], topics)
        return pa.StructArray.from_arrays([pa.array(np.maximum(n, 1)), pa.array([f"t{k}" for k in votes.argmax(axis=1)], pa.string())], names=["tokens", "topic"])

    told = F.arrow_udf(tell, "tokens long, topic string")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), told(F.col("text").cast("string")).alias("t"))
    group = lambda c: F.coalesce(F.col(f"row.{c}").cast("string"), F.lit(""))
    topic = group("topic") if "topic" in docs.columns else F.col("t.topic")
    return rows.select("row", F.struct(group("source").alias("source"), group("lang").alias("lang"), topic.alias("topic"), F.col("t.tokens").alias("tokens")).alias("d"))


def uniform(id_col: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the id."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def wanted_shares(cells: DataFrame, margin: str, temperature: float = TEMPERATURE) -> DataFrame:
    """Shares of tokens raised to a power below 1: large groups give way to small ones."""
    own = cells.groupBy(margin).agg(F.sum("tokens").cast("double").alias("t"))
    raised = own.select(margin, F.pow("t", F.lit(temperature)).alias("p"))
    total = raised.agg(F.sum("p").alias("all"))  # one row
    return raised.join(F.broadcast(total)).select(margin, (F.col("p") / F.col("all")).alias("share"))


def rake_frame(cells: DataFrame, shares: dict[str, DataFrame], cycles: int = CYCLES) -> DataFrame:
    """``cells`` (margins, tokens) with ``w``, the raked share of tokens: for any number of cells.

    Written after each margin, so each step reads one table and no plan grows.
    """
    total = cells.agg(F.sum("tokens").cast("double").alias("all"))  # one row
    now = spool(cells.join(F.broadcast(total)).select(*MARGINS, "tokens", (F.col("tokens") / F.col("all")).alias("w")))
    for _ in range(cycles):
        for m in MARGINS:
            held = now.groupBy(m).agg(F.sum("w").alias("held")).join(shares[m], m, "left").select(
                m, F.when(F.col("held") > 0, F.coalesce("share", F.lit(0.0)) / F.col("held")).otherwise(F.lit(0.0)).alias("f"))
            now = spool(now.join(held, m).select(*MARGINS, "tokens", (F.col("w") * F.col("f")).alias("w")))
    return now


def rake_arrays(groups: list[np.ndarray], tokens: np.ndarray, shares: list[np.ndarray], cycles: int = CYCLES) -> np.ndarray:
    """The same in numpy: ``groups`` numbers each cell's group of each margin, ``shares`` are its targets."""
    w = tokens / max(1, tokens.sum())
    for _ in range(cycles):
        for g, share in zip(groups, shares):
            held = np.bincount(g, w, len(share))
            w = w * np.divide(share, held, out=np.zeros(len(share)), where=held > 0)[g]
    return w


def _rake_small(cells: DataFrame, shares: dict[str, DataFrame] | None, temperature: float, cycles: int) -> DataFrame:
    """Rake cells that the driver holds; the count is checked by the caller."""
    got = cells.select(*MARGINS, "tokens").orderBy(*MARGINS).toArrow()
    tokens = got.column("tokens").to_numpy().astype(np.float64)
    groups, targets = [], []
    for m in MARGINS:
        names, g = np.unique(np.array(got.column(m).to_pylist(), dtype=object), return_inverse=True)
        if shares is None:
            t = np.bincount(g, tokens, len(names)) ** temperature
            t = t / t.sum() if len(t) else t
        else:
            given = {r[m]: r["share"] for r in cells.select(m).distinct().join(shares[m], m).collect()}
            t = np.array([given.get(x, 0.0) for x in names])
        groups.append(g)
        targets.append(t)
    out = got.append_column("w", pa.array(rake_arrays(groups, tokens, targets, cycles), pa.float64()))
    return cells.sparkSession.createDataFrame(out, schema="source string, lang string, topic string, tokens long, w double")


def rake(cells: DataFrame, shares: dict[str, DataFrame] | None = None, temperature: float = TEMPERATURE, cycles: int = CYCLES, small: int = SMALL_CELLS) -> DataFrame:
    """``cells`` with ``w``, raked to ``shares`` (default: tempered shares of tokens); broadcast where they are few."""
    if cells.count() <= small:
        return F.broadcast(_rake_small(cells, shares, temperature, cycles))
    return rake_frame(cells, shares or {m: spool(wanted_shares(cells, m, temperature)) for m in MARGINS}, cycles)


def plan(rows: DataFrame, shares: dict[str, DataFrame] | None = None, temperature: float = TEMPERATURE, rate: float = RATE, cycles: int = CYCLES, small: int = SMALL_CELLS) -> DataFrame:
    """The raked cells of described rows: margins, factor (wanted over held share), times (expected copies of a document)."""
    cells = spool(rows.select("d.*").groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")))
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    factor = F.col("w") * F.lit(total) / F.col("tokens")
    return rake(cells, shares, temperature, cycles, small).select(*MARGINS, "tokens", "w", factor.alias("factor"), F.round(factor * rate, 6).alias("times"))


def _chosen(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """Described rows with factor, times, whole copies, prob of one more, and the copies chosen."""
    held = cells.select(F.struct(*MARGINS).alias("cell"), "factor", "times")
    key = F.struct(*[F.col(f"d.{m}").alias(m) for m in MARGINS])
    both = rows.withColumn("cell", key).join(held, "cell")
    whole = F.floor("times")
    prob = F.round(F.col("times") - whole, 6)
    copies = whole + (uniform(F.col("row.doc_id")) < prob).cast("long")
    return both.select("row", "d", "factor", "times", prob.alias("prob"), copies.alias("copies"))


def weigh(docs: DataFrame, **how) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, weight, times, prob, copies, sampled for every row."""
    rows = spool(described(docs.select("doc_id", "text", "source", "lang", *[c for c in docs.columns if c == "topic"])).select(
        F.struct(F.col("row.doc_id").cast("long").alias("doc_id")).alias("row"), "d"))  # ids and counts, no texts
    out = _chosen(rows, plan(rows, **how))
    return out.select("row.doc_id", "d.source", "d.lang", "d.topic", F.col("d.tokens").alias("n_tokens"), F.round("factor", 6).alias("weight"),
                      "times", "prob", "copies", (F.col("copies") > 0).alias("sampled"))


def sample(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that are sampled, with their columns, each as often as its cell asks for."""
    rows = described(docs)
    out = _chosen(rows, plan(rows, **how)).where("copies > 0").select("row", F.explode(F.array_repeat(F.lit(True), F.col("copies").cast("int"))))
    return out.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def oracle_sql(temperature: float = TEMPERATURE, rate: float = RATE, cycles: int = CYCLES, topics: int = TOPICS, seed: str = SEED) -> str:
    """The same as DuckDB SQL: the cycles are written out."""
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
    byte = "('0x' || substr(hex(x), 2 * i + 1, 2))::bigint"
    h = f"list_reduce(list_prepend(0::bigint, list_transform(range(strlen(x) - 1, -1, -1), lambda i: {byte})), lambda a, b: (a * {BASE} + b) % 4294967296)"
    vote = f"list_transform(list_filter(w, lambda x: strlen(x) >= {LEAST_BYTES}), lambda x: ({h} // 65536) % {topics})"
    tally = f"list_transform(range(0, {topics}), lambda t: len(list_filter(v, lambda y: y = t)))"
    parts = [
        f"t0 as materialized (select doc_id, source, lang, {words} as w from documents)",
        f"t1 as materialized (select doc_id, source, lang, len(w) as n, {vote} as v from t0)",
        f"t2 as materialized (select doc_id, source, lang, n, {tally} as k from t1)",
        "d as materialized (select doc_id, coalesce(source, '') as source, coalesce(lang, '') as lang, "
        "'t' || (list_position(k, list_max(k)) - 1) as topic, greatest(n, 1)::bigint as n_tokens from t2)",
        "c as materialized (select source, lang, topic, sum(n_tokens)::bigint as tokens from d group by all)",
    ]
    for m in MARGINS:
        parts.append(f"s_{m} as materialized (select {m}, pow(sum(tokens)::double, {temperature}::double) / sum(pow(sum(tokens)::double, {temperature}::double)) over () as share from c group by {m})")
    parts.append("w0 as materialized (select source, lang, topic, tokens, tokens::double / (sum(tokens) over ())::double as w from c)")
    k = 0
    for _ in range(cycles):
        for m in MARGINS:
            parts.append(f"w{k + 1} as materialized (select source, lang, topic, tokens, w * (share / sum(w) over (partition by {m})) as w from w{k} join s_{m} using ({m}))")
            k += 1
    parts.append(f"f as materialized (select source, lang, topic, w * (sum(tokens) over ())::double / tokens as factor from w{k})")
    parts.append(f"g as materialized (select *, round(factor * {rate}::double, 6) as times from f)")
    parts.append("p as materialized (select *, floor(times)::bigint as whole, round(times - floor(times), 6) as prob from g)")
    u = f"('0x' || substr(md5('{seed}:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint::double / 4294967296.0::double"
    copies = f"(whole + ({u} < prob)::bigint)"
    return (f"with {reduce(lambda a, b: f'{a}, {b}', parts)} select doc_id, source, lang, topic, n_tokens, round(factor, 6) as weight, times, prob, "
            f"{copies} as copies, {copies} > 0 as sampled from d join p using (source, lang, topic)")

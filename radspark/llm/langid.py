"""Language identification by word-first backoff.

A known word adds its log frequency in each language. A word never seen falls
back to character n-grams: the longest order of which the model knows any
piece of the word speaks for it, from ``max_order`` down to single characters.

Learning: about ``docs_per_lang`` documents of each language, chosen by hash
with a rate from counts over all documents (documented bound); all words seen
twice or more and all n-grams seen three times or more in them. Prediction
reads every whole text.

Defined results: null texts and texts without a letter give ``und`` with score
0; without a model every text does; ties go to the language that sorts first;
repeated rows are predicted alike; extra columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from radspark.llm.common import spool
from radspark.llm.gam import bucket

MAX_ORDER, DOCS_PER_LANG = 5, 2500
#: Counts by language are broadcast up to this many languages; beyond it the join shuffles.
BROADCAST_LANGS = 10_000
UNKNOWN = "und"
#: Numbers a worker remembers for words outside the model; beyond it the memory starts anew.
REMEMBERED = 4_000_000
WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def grams_of(word: str, n: int) -> list[str]:
    w = f"^{word}$"
    return [w[i : i + n] for i in range(len(w) - n + 1)] if n > 1 else list(word)


@dataclass
class Model:
    langs: list[str]
    words: dict[str, int]
    grams: dict[str, int]
    table: np.ndarray  # a row of log frequencies by language for each entry; n-grams after words

    def predictor(self, max_order: int = MAX_ORDER):
        k = len(self.langs)
        known = dict(self.words)
        seen: dict[str, int] = {}
        room = max(1, REMEMBERED // max(1, k))
        extra = np.empty((0, k), np.float32)
        base = len(self.table)

        def back_off(word: str) -> np.ndarray:
            for n in range(min(max_order, len(word) + 2), 0, -1):
                got = [self.grams[g] for g in grams_of(word, n) if g in self.grams]
                if got:
                    v = self.table[got].mean(axis=0)
                    return v - v.max()
            return np.zeros(k, np.float32)

        def predict(texts: list[str | None]) -> tuple[list[str], list[float]]:
            nonlocal seen, extra
            split = [words_of(t) for t in texts]
            new = {w for ws in split for w in ws if w not in known and w not in seen}
            if len(seen) + len(new) > room:
                seen, extra = {}, extra[:0]
                new = {w for ws in split for w in ws if w not in known}
            if new:
                order = sorted(new)
                seen.update((w, base + len(extra) + i) for i, w in enumerate(order))
                extra = np.concatenate([extra, np.array([back_off(w) for w in order], np.float32)])
            langs, scores = [], []
            for ws in split:
                if not k or not ws or not any(c.isalpha() for w in ws for c in w):
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                at = np.fromiter((known[w] if w in known else seen[w] for w in ws), np.int64, len(ws))
                low = at < base
                total = self.table[at[low]].sum(axis=0, dtype=np.float64) + extra[at[~low] - base].sum(axis=0, dtype=np.float64)
                best = int(total.argmax())
                langs.append(self.langs[best])
                scores.append(float(1 / np.exp(np.clip(total - total[best], -60, 0)).sum()))
            return langs, scores

        return predict


def learn(docs: DataFrame, docs_per_lang: int = DOCS_PER_LANG, max_order: int = MAX_ORDER) -> Model:
    """Fit on text and lang of documents whose crc32(doc_id) mod 4 is not 2."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.coalesce(bucket("doc_id", 4) != 2, F.lit(False)))
    totals = spool(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")))
    if totals.count() <= BROADCAST_LANGS:
        totals = F.broadcast(totals)
    u = F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.join(totals, "lang").where(u * F.col("n") < docs_per_lang).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, text = b.column(0).to_pylist(), b.column(1).to_pylist()
            for lo in range(0, len(lang), 200):
                tally: Counter = Counter()
                for g, t in zip(lang[lo : lo + 200], text[lo : lo + 200]):
                    for w, c in Counter(words_of(t)).items():
                        tally[(g, 0, w)] += c
                        for n in range(1, max_order + 1):
                            for x in grams_of(w, n):
                                tally[(g, n, x)] += c
                keys = list(tally)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
                     pa.array([k[2] for k in keys], pa.string()), pa.array(list(tally.values()), pa.int64())],
                    names=["lang", "n", "piece", "c"])

    counts = sample.mapInArrow(run, "lang string, n int, piece string, c long").groupBy("lang", "n", "piece").agg(F.sum("c").alias("c"))
    total = F.sum("c").alias("total")
    by_piece = spool(counts.groupBy("n", "piece").agg(total, F.sort_array(F.collect_list(F.struct("lang", "c"))).alias("by"))  # as many as languages
                     .where(F.col("total") >= F.when(F.col("n") == 0, 2).otherwise(3)))
    got = by_piece.select("n", "piece", F.explode("by").alias("b")).select("n", "piece", "b.lang", "b.c").orderBy("n", "piece", "lang").toArrow()
    order_col, lang_col, count = got.column("n").to_numpy(), got.column("lang").to_pylist(), got.column("c").to_numpy()
    langs = sorted(set(lang_col))
    at = {g: i for i, g in enumerate(langs)}
    entries: dict[tuple[int, str], int] = {}
    row = np.fromiter((entries.setdefault(k, len(entries)) for k in zip(order_col.tolist(), got.column("piece").to_pylist())), np.int64, len(count))
    c = np.zeros((len(entries), len(langs)))
    np.add.at(c, (row, np.fromiter((at[g] for g in lang_col), np.int64, len(count))), count)
    order_of = np.fromiter((n for n, _ in entries), np.int64, len(entries))
    table = np.zeros_like(c, dtype=np.float32)
    for n in range(max_order + 1):
        own = order_of == n
        if own.any():
            part = c[own] + 0.2
            table[own] = np.log(part / part.sum(axis=0))
    return Model(langs, {w: i for (n, w), i in entries.items() if n == 0}, {g: i for (n, g), i in entries.items() if n > 0}, table)


def predict(docs: DataFrame, model: Model, max_order: int = MAX_ORDER) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample and the least counts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tell = shared.value.predictor(max_order)
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                langs, scores = tell(b.column(1).slice(lo, 512).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, 512), b.column(2).slice(lo, 512), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                    names=["doc_id", "held_out", "lang_pred", "score"])

    cols = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return cols.select("doc_id", "text", F.coalesce(bucket("doc_id", 4) == 2, F.lit(False)).alias("held_out")).mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, learn_from: DataFrame | None = None) -> DataFrame:
    """Learn from ``learn_from`` (or the documents themselves) and predict every document."""
    return predict(docs, learn(docs if learn_from is None else learn_from))

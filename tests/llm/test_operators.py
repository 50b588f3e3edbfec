"""Operators against brute force, exact round trips and held-out accuracy, on small and odd tables."""

import hashlib
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from radspark.llm import common, gam, html_blocks, langid, licenses, minhash, mixing, packing, pii, queries, tiff, vectors

ODD = [None, "", " \n\t ", "word", "a b c d e f g", "x" * 70000, "naïve café 😀 mot", "\x1f\x1c odd \x85 space", "a b c d e f g"]
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, extra=False):
    rows = [(i, t, "en" if i % 2 else None, "s" if i % 3 else None, len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOC)
    return df.withColumn("pixels", df["doc_id"]).withColumn("score", df["doc_id"]).withColumn("component", df["doc_id"]) if extra else df


def read(spark, sf, t):
    return spark.read.parquet(f"{sf}/{t}.parquet")


# --- 1 ---


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=4000), st.sampled_from([tiff.RAW, tiff.LZW, tiff.DEFLATE, tiff.PACKBITS]))
def test_tiff_codecs_round_trip(data, codec):
    assert tiff.decode_block(tiff.encode_block(data, codec), codec, len(data)) == data


@pytest.mark.parametrize("codec", [tiff.RAW, tiff.LZW, tiff.DEFLATE, tiff.PACKBITS])
def test_tiff_pages_round_trip(codec):
    rng = np.random.default_rng(codec)
    imgs = [rng.integers(0, 4, s, dtype=np.uint8) for s in ((1, 1), (100, 37), (64, 64), (300, 70))]
    data = tiff.write_tiff([(a, codec, p, lay) for a in imgs for p in (1, 2) for lay in (16, (32, 48))])
    got = list(tiff.read_pages(data))
    assert len(got) == 16 and all(e is None for _, _, e in got)
    for k, (_, px, _) in enumerate(got):
        assert (px[:, :, 0] == imgs[k // 4]).all()


def by_hand(a, e, bits, predictor=1, planar=False, tile=None):
    """A one-page deflate TIFF of ``a`` (height x width x samples), sample by sample."""
    h, w, spp = a.shape
    kind, n = a.dtype.kind, max(1, bits // 8)
    th, tw = tile or (3, w)
    blocks = []
    for part in [a[:, :, k : k + 1] for k in range(spp)] if planar else [a]:
        for y in range(0, h, th):
            for x in range(0, w, tw):
                b = part[y : y + th, x : x + tw]
                if tile:
                    b = np.pad(b, ((0, th - b.shape[0]), (0, tw - b.shape[1]), (0, 0)))
                raw = b""
                for row in b:
                    per = row.shape[1]
                    if bits < 8:
                        line = "".join(format(int(v), f"0{bits}b") for v in row.ravel())
                        raw += bytes(int(line[i : i + 8].ljust(8, "0"), 2) for i in range(0, len(line), 8))
                    elif predictor == 3:
                        each = [np.array(v, f">f{n}").tobytes() for v in row.ravel()]  # scalars have no byte order
                        line = bytes(v[k] for k in range(n) for v in each)
                        raw += bytes((c - (line[i - per] if i >= per else 0)) % 256 for i, c in enumerate(line))
                    else:
                        ints = [int.from_bytes(v.tobytes(), "little") for v in row.ravel()]
                        if predictor == 2:
                            ints = [(v - (ints[i - per] if i >= per else 0)) % (1 << bits) for i, v in enumerate(ints)]
                        raw += b"".join(v.to_bytes(n, "little" if e == "<" else "big") for v in ints)
                blocks.append(zlib.compress(raw))
    out, offs = (b"II*\0" if e == "<" else b"MM\0*") + b"\0\0\0\0", []
    for b in blocks:
        offs.append(len(out))
        out += b
    tags = {256: [w], 257: [h], 258: [bits] * spp, 259: [8], 277: [spp], 284: [2 if planar else 1], 317: [predictor], 339: [{"u": 1, "i": 2, "f": 3}[kind]]}
    tags |= {322: [tw], 323: [th], 324: offs, 325: [len(b) for b in blocks]} if tile else {273: offs, 278: [th], 279: [len(b) for b in blocks]}
    fields = b""
    for k, vals in sorted(tags.items()):
        body = struct.pack(f"{e}{len(vals)}I", *vals)
        if len(vals) > 1:
            body, out = struct.pack(f"{e}I", len(out)), out + body
        fields += struct.pack(f"{e}HHI", k, 4, len(vals)) + body
    return out[:4] + struct.pack(f"{e}I", len(out)) + out[8:] + struct.pack(f"{e}H", len(tags)) + fields + b"\0\0\0\0"


@pytest.mark.parametrize("e", "<>")
@pytest.mark.parametrize("tile", [None, (4, 6)])
def test_tiff_sample_widths_and_predictors(e, tile):
    """Each width, format, predictor and layout, from files written sample by sample."""
    rng = np.random.default_rng(7)
    for planar in (False, True):
        for spp in (1, 3):
            cases = [(f"{k}{n}", 8 * n, p) for k in "ui" for n in (1, 2, 4, 8) for p in (1, 2)] + [(f"f{n}", 8 * n, p) for n in (2, 4, 8) for p in (1, 2, 3)]
            for dtype, bits, predictor in cases + [("u1", b, 1) for b in (1, 2, 4)]:
                top = 1 << min(bits, 8)
                a = rng.integers(0, top, (7, 10, spp, max(1, bits // 8)), dtype=np.uint8).view(f"<{dtype}")[..., 0]
                if dtype[0] == "f":
                    a = rng.normal(size=a.shape).astype(f"<{dtype}")
                ((_, px, err),) = tiff.read_pages(by_hand(a, e, bits, predictor, planar, tile))
                assert err is None and px.dtype == a.dtype and px.tobytes() == a.tobytes(), (dtype, bits, predictor, planar, spp)


def test_tiff_refuses(spark):
    """Pages that cannot be decoded say why; the batch goes on."""
    a = np.zeros((2, 3, 1), "<u2")
    bad = [by_hand(a, "<", 16, 3), by_hand(a, "<", 12, 1), by_hand(np.zeros((0, 3, 1), "u1"), "<", 8), by_hand(np.zeros((2, 0, 1), "u1"), ">", 8, tile=(1, 1))]
    df = spark.createDataFrame([(i, m) for i, m in enumerate([*bad, by_hand(a, ">", 16, 2)])], "id long, media binary")
    got = {r["id"]: r for r in tiff.tiff_pages(df).collect()}
    assert all(got[i]["error"] and got[i]["pixels"] is None for i in range(4))
    assert (got[4]["error"], got[4]["pixels"], got[4]["bits"], got[4]["sample_format"], got[4]["predictor"]) == (None, bytes(12), 16, 1, 2)


def test_tiff_big_endian_and_broken():
    px = bytes(range(6))
    ifd = struct.pack(">H", 7) + b"".join(struct.pack(">HHI", t, 4, 1) + struct.pack(">I", v) for t, v in ((256, 3), (257, 2), (258, 8), (259, 1), (273, 8), (278, 2), (279, 6))) + b"\0\0\0\0"
    ok = b"MM\0*" + struct.pack(">I", 14) + px + ifd
    assert next(tiff.read_pages(ok))[1].tobytes() == px
    assert next(tiff.read_pages(b"no"))[2] and next(tiff.read_pages(None))[2] and next(tiff.read_pages(ok[:40]))[2]
    loop = ok[:-4] + struct.pack(">I", 14)
    assert len(list(tiff.read_pages(loop))) == 1


def test_op1_equals_brute_force(spark, sf):
    texts = ODD + ["y" * 64, "ab" * 40000]
    for df in (docs_of(spark, texts, extra=True), read(spark, sf, "documents")):
        want = {r["doc_id"]: r["text"] for r in df.collect()}
        got = tiff.text_media(df).collect()
        assert len(got) == len(want)
        for r in got:
            raw = (want[r["doc_id"]] or "").encode()
            pad = raw + b"\0" * (-len(raw) % 64 if raw else 64)
            assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"], r["error"]) == (len(raw), len(pad), hashlib.sha256(pad).hexdigest(), zlib.crc32(pad[-64:]), None)
    assert tiff.text_media(docs_of(spark, []).limit(0)).count() == 0
    broken = spark.createDataFrame([(1, b"II*\0"), (2, None)], "id long, media binary")
    assert {r["id"]: r["error"] is not None for r in tiff.tiff_pages(broken).collect()} == {1: True, 2: True}


# --- 2 ---


def test_gam_learns_and_ranks():
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (6000, 4))
    y = (rng.uniform(size=6000) < 1 / (1 + np.exp(-(4 * np.sign(x[:, 0]) + 6 * x[:, 1] * x[:, 2])))).astype(float)
    m = gam.fit(x[:4000], y[:4000])
    assert (1, 2) in m.pairs
    p = m.score(x[4000:])
    assert ((p > 0.5) == y[4000:]).mean() > 0.85
    assert (gam.fit(x[:0], y[:0]).score(x[:3]) == 0.5).all() and np.allclose(gam.fit(x[:5], np.ones(5)).score(x[:3]), 0.999)


def test_op2(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = read(spark, sf, "documents"), read(spark, sf, "labels")
    r = {x["doc_id"]: x for x in gam.score(docs, gam.learn(docs, labels)).collect()}
    lab = {x["doc_id"]: x["quality"] for x in labels.collect()}
    assert len(r) == docs.count()
    held = [i for i in lab if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(r[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in r)
    assert np.mean([r[i]["predicted"] == lab[i] for i in held]) > 0.93
    assert all(r[i]["predicted"] == int(r[i]["score"] >= 0.3) for i in r)


def test_op2_equals_brute_force(spark, sf):
    """Every score again: the tables' entries added one by one."""
    from bisect import bisect_right
    from math import exp

    docs = read(spark, sf, "documents")
    m = gam.learn(docs, read(spark, sf, "labels"))
    assert len(m.pairs) == 8 and len(m.tables) == len(gam.FEATURES)
    got = {r["doc_id"]: r["score"] for r in gam.score(docs, m).collect()}
    for r in docs.collect():
        x = [float(v) for v in gam.features(r["text"])]
        f = m.base + sum(t[bisect_right(e.tolist(), v)] for e, t, v in zip(m.edges, m.tables, x))
        for (a, b), t in zip(m.pairs, m.grids):
            f += t[bisect_right(m.coarse[a].tolist(), x[a])][bisect_right(m.coarse[b].tolist(), x[b])]
        assert abs(got[r["doc_id"]] - 1 / (1 + exp(-f))) < 1e-9


def test_op2_odd(spark):
    df = docs_of(spark, ODD, extra=True)
    none = spark.createDataFrame([(1, None), (1, None)], "doc_id long, quality int")
    r = gam.score(df, gam.learn(df, none)).collect()
    assert len(r) == len(ODD) and all(x["score"] == 0.5 for x in r)
    twice = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (3, 1), (4, 1), (6, 0)], "doc_id long, quality int")
    assert len(gam.keep_good(df, twice).columns) == len(df.columns)
    assert gam.score(df.limit(0), gam.learn(df, twice)).count() == 0


# --- 3 ---


def brute_regions(text):
    """Coverage of each template by the longest common run of words (exact copies only)."""
    words = licenses.WORD.findall(text.lower())
    out = set()
    for name, t in licenses.TEMPLATES.items():
        w = licenses.WORD.findall(t.lower())
        if any(words[i : i + len(w)] == w for i in range(len(words) - len(w) + 1)):
            out.add(name)
    return out


def test_op3_finds_planted(spark):
    rng = random.Random(3)
    filler = lambda n: " ".join("".join(rng.choice("abcdeou") for _ in range(5)) for _ in range(n))
    texts, want = [], []
    for name, t in licenses.TEMPLATES.items():
        texts.append(f"{filler(40)} {t} {filler(40)}")
        want.append(name)
        cut = t.split()
        if len(cut) > 12:
            cut[5] = "zzz"
            texts.append(f"{filler(5)}\n{' '.join(cut).upper()}")
            want.append(name)
    r = licenses.scan(docs_of(spark, [*texts, *ODD])).collect()
    by = {x["doc_id"]: x for x in r}
    assert len(r) == len(texts) and all(by[i]["template"] == n for i, n in enumerate(want))
    for i, t in enumerate(texts):
        span = licenses.WORD.findall(t[by[i]["start"] : by[i]["end"]].lower())
        assert by[i]["matched"] <= len(span) <= by[i]["template_words"] + 1 and by[i]["coverage"] >= 0.75


def test_op3_on_documents(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in read(spark, sf, "documents").collect()}
    found = {}
    for r in licenses.scan(read(spark, sf, "documents")).collect():
        found.setdefault(r["doc_id"], set()).add(r["template"])
    for i, t in texts.items():
        whole = brute_regions(t or "")
        assert bool(whole) <= (i in found), i


@pytest.mark.parametrize("gap", [0, 2, 20])
def test_op3_every_repeat(gap):
    index = licenses.build_index(licenses.TEMPLATES)
    for name, t in licenses.TEMPLATES.items():
        for n in (1, 2, 9):
            got = licenses.scan_text(" ".join([t, *["zebra"] * gap] * n), index)
            assert [(r[0], r[3]) for r in got] == [(name, 1.0)] * n, (name, n)
    assert len(licenses.scan_text("Licensed under the MIT License. " * 3000, index)) == 3000


def test_op3_regions_equal_brute_force(spark):
    """Texts of notices in any order: one region for each, from its first word to its last."""
    rng = random.Random(8)
    texts, want = [], []
    for _ in range(60):
        text, spans = "", []
        for _ in range(rng.randint(1, 12)):
            text += " ".join("".join(rng.choice("xyzq") for _ in range(4)) for _ in range(rng.choice([0, 1, 3, 15, 40]))) + " "
            name = rng.choice(list(licenses.TEMPLATES))
            words = [m.span() for m in licenses.WORD.finditer(licenses.TEMPLATES[name].lower())]
            spans.append((name, len(text) + words[0][0], len(text) + words[-1][1]))
            text += licenses.TEMPLATES[name] + " "
        texts.append(text)
        want.append(spans)
    df = docs_of(spark, texts, extra=True).selectExpr("*", "'clash' as template", "'clash' as start")
    got = {}
    for r in licenses.scan(df.unionByName(df)).collect():
        got.setdefault(r["doc_id"], []).append((r["template"], r["start"], r["end"]))
    assert [sorted(got[i], key=lambda r: r[1]) for i in range(len(texts))] == [sorted(w * 2, key=lambda r: r[1]) for w in want]


def test_op3_odd(spark):
    df = spark.createDataFrame([(None, licenses.TEMPLATES["mit-line"]), (1, None), (2, ""), (3, "x " * 200000 + licenses.TEMPLATES["unlicense"])], "doc_id long, text string")
    assert sorted((r["doc_id"] or 0, r["template"]) for r in licenses.scan(df).collect()) == [(0, "mit-line"), (3, "unlicense")]
    assert licenses.scan(df.limit(0)).count() == 0


def test_winnowing_guarantee():
    rng = np.random.default_rng(1)
    for _ in range(200):
        h = rng.integers(0, 50, rng.integers(1, 30)).astype(np.uint64)
        w = 3
        picked = set(licenses.winnow(h, w))
        for lo in range(max(1, len(h) - w + 1)):
            assert picked & set(range(lo, min(len(h), lo + w)))


# --- 4 ---


def brute_vectors(rows, least=0.93):
    ok = {}
    for i, e, lab in rows:
        if e and lab is not None and i is not None and all(v is not None and np.isfinite(v) for v in e) and any(e):
            ok.setdefault((lab, len(e)), []).append((i, np.array(e, float) / np.linalg.norm(np.array(e, float))))
    links, par = {i: 0 for i, _, _ in rows}, {i: i for i, _, _ in rows}

    def f(x):
        while par[x] != x:
            x = par[x]
        return x

    for grp in ok.values():
        for k, (i, u) in enumerate(grp):
            for j, v in grp[:k]:
                if u @ v >= least:
                    links[i] += 1
                    links[j] += 1
                    a, b = sorted((f(i), f(j)))
                    par[b] = a
    return {i: (links[i], f(i)) for i in links}


def test_op4_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    rows, k = [], 0
    for lab in (0, 1):
        for size in (1, 1, 1, 2, 5, 60):
            c = rng.normal(size=16)
            for _ in range(size):
                rows.append((k, (c + rng.normal(0, 0.1, 16)).tolist(), lab))
                k += 1
    rows += [(k + i, rows[3][1], 0) for i in range(7)]  # copies
    k += 7
    rows += [(k, None, 0), (k + 1, [0.0] * 16, 0), (k + 2, [float("nan")] * 16, 0), (k + 3, [None] + [1.0] * 15, 0), (k + 4, [], 0), (k + 5, rows[0][1], None), (k + 6, [1.0, 2.0], 0), (k + 7, [1.0, 2.0], 0), (k + 8, [1e300] * 16, 1), (k + 9, [float("inf")] * 16, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 as shard", "2 as digest")
    want = brute_vectors([r for r in rows if r[0] != k + 8])
    got = {r["vec_id"]: r for r in vectors.near_duplicates(df).collect()}
    assert len(got) == len(rows)
    for i, (n, c) in want.items():
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (n, c, i == c), i
    assert got[0]["audit_recall"] >= 0.9


def test_op4_hot_shard_in_parts(spark):
    rng = np.random.default_rng(6)
    rows = [(i, (np.ones(8) + rng.normal(0, 0.05, 8)).tolist(), 0) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vectors.near_duplicates(df, shard=32, limit=64).collect()}
    want = brute_vectors(rows)
    found, there = sum(min(got[i][0], want[i][0]) for i in want), sum(n for n, _ in want.values())
    assert found / there >= 0.97 and all(got[i][1] == want[i][1] for i in want) and all(got[i][0] <= want[i][0] for i in want)
    assert vectors.near_duplicates(df.limit(0)).count() == 0


def spread_out(n, pairs, seed=4, dim=64, at=0.94):
    """Random unit vectors over many shards; each of the first ``pairs`` has a partner at cosine ``at``."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    off = rng.normal(size=(pairs, dim))
    off -= (off * x[:pairs]).sum(axis=1, keepdims=True) * x[:pairs]
    off /= np.linalg.norm(off, axis=1, keepdims=True)
    return np.concatenate([x, at * x[:pairs] + np.sqrt(1 - at * at) * off])


@pytest.mark.parametrize("n,dim,at,how", [(4500, 64, 0.94, {}), (18000, 32, 0.935, {}), (45000, 64, 0.95, {}), (5000, 32, 0.935, {"shard": 200, "limit": 400, "numbers": 32 * 400})])
def test_op4_spread_out_links(spark, n, dim, at, how):
    pairs = n // 3
    df = spark.createDataFrame(pa.table({"vec_id": pa.array(range(n + pairs), pa.int64()), "embedding": list(spread_out(n, pairs, dim=dim, at=at)), "label": ["a"] * (n + pairs)}))
    got = {r["vec_id"]: r for r in vectors.near_duplicates(df, **how).collect()}
    ends = [(got[i], got[n + i]) for i in range(pairs)]
    assert all(a["n_links"] == b["n_links"] and (a["n_links"] == 1) == (a["component_id"] == b["component_id"]) for a, b in ends)  # a link counts for both ends
    recall = np.mean([(a["n_links"], a["component_id"]) == (1, i) for i, (a, _) in enumerate(ends)])
    assert recall >= 0.98 and abs(got[0]["audit_recall"] - recall) < 0.015
    assert all((got[i]["n_links"], got[i]["component_id"]) == (0, i) for i in range(pairs, n))


# --- 5 ---


def test_op5_margins_meet_targets(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    r = mixing.weigh(docs, cycles=25).toPandas()
    assert len(r) == docs.count() and (r.prob.between(0, 1)).all() and (r.copies - r.times).abs().max() < 1
    r["wanted"] = r.times * r.n_tokens
    for m in mixing.MARGINS:
        share = r.groupby(m).n_tokens.sum() ** mixing.TEMPERATURE
        held = r.groupby(m).wanted.sum()
        assert np.allclose(held / held.sum(), share / share.sum(), rtol=2e-3)
    assert abs(r.wanted.sum() / r.n_tokens.sum() - mixing.RATE) < 1e-4 and abs((r.copies * r.n_tokens).sum() / r.wanted.sum() - 1) < 0.1


def test_op5_frame_equals_arrays(spark, sf):
    docs = read(spark, sf, "documents")
    want = spark.createDataFrame([("en", 0.5), ("de", 0.3), ("es", 0.2)], "lang string, share double")  # fr has no target
    cells = mixing.described(docs).select("d.*").groupBy(*mixing.MARGINS).agg(mixing.F.sum("tokens").alias("tokens")).cache()
    shares = {m: mixing.wanted_shares(cells, m) for m in ("source", "topic")} | {"lang": want}
    few, many = (sorted(map(tuple, mixing.plan(mixing.described(docs), shares, small=k).select(*mixing.MARGINS, "tokens", "times").collect())) for k in (10**6, 0))
    assert [r[:4] for r in few] == [r[:4] for r in many] and np.allclose([r[4] for r in few], [r[4] for r in many], atol=2e-6)
    assert all(r[4] == 0 for r in few if r[1] == "fr") and any(r[4] > 0 for r in few)


def brute_topic(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    votes = Counter()
    for w in words:
        raw = bytes(c + 32 if 65 <= c <= 90 else c for c in w.encode())
        if len(raw) >= mixing.LEAST_BYTES:
            votes[(sum(c * pow(mixing.BASE, k, 2**32) for k, c in enumerate(raw)) % 2**32 >> 16) % mixing.TOPICS] += 1
    return len(words), max(range(mixing.TOPICS), key=lambda k: (votes[k], -k))


def test_op5_topics_of_whole_texts(monkeypatch):
    rng = random.Random(3)
    texts = [t or "" for t in ODD] + [" ".join("".join(rng.choice("abcdeXYZé") for _ in range(rng.randint(1, 12))) for _ in range(rng.choice([1, 30, 700]))) for _ in range(40)]
    for segment in (1 << 20, 64):
        monkeypatch.setattr(mixing, "SEGMENT", segment)
        n, votes = mixing.count_words([t.encode() for t in texts])
        assert [(int(a), int(v.argmax())) for a, v in zip(n, votes)] == [brute_topic(t) for t in texts]


def test_op5_odd(spark):
    df = docs_of(spark, ODD, extra=True)
    r = mixing.weigh(df).collect()
    assert len(r) == len(ODD) and all(0 <= x["prob"] <= 1 and x["n_tokens"] >= 1 for x in r)
    assert mixing.sample(df).columns == df.columns and mixing.weigh(df.limit(0)).count() == 0 and mixing.sample(df.limit(0)).count() == 0
    assert mixing.sample(df.withColumn("topic", df["lang"])).columns[-1] == "topic"
    twice = df.unionByName(df)
    seen = Counter((x["doc_id"], x["copies"]) for x in mixing.weigh(twice).collect())
    assert all(n == 2 for n in seen.values()) and len(seen) == len(ODD)
    clash = df.select("*", *[mixing.F.concat(mixing.F.lit(f"{c}-"), "doc_id").alias(c) for c in ("_prob", "_lang", "row", "d", "cell", "copies", "times", "tokens", "a.b")])
    got = mixing.sample(clash).collect()
    assert got and all(x["_lang"] == f"_lang-{x['doc_id']}" and x["a.b"] == f"a.b-{x['doc_id']}" and x["row"] == f"row-{x['doc_id']}" for x in got)


def test_op5_sql(spark, sf):
    import duckdb

    c = duckdb.connect()
    c.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    want = c.sql(queries.ORACLE_SQL["op5_ipf_mixing"])
    got = queries.op5_ipf_mixing(spark, sf).select(want.columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())


def test_op5_sample_meets_targets(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{rng.randrange(40)}" for _ in range(12)), rng.choice(["en"] * 20 + ["de"] * 4 + ["es"]), rng.choice(["hot"] * 12 + ["a", "b", "c"]), "t") for i in range(8000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, topic string")
    n, got = Counter(), Counter()
    for r in rows:
        n.update([r[2], r[3]])
    got_rows = mixing.sample(df, cycles=4).select("doc_id", "lang", "source").collect()
    for r in got_rows:
        got.update([r["lang"], r["source"]])
    for kind in (("en", "de", "es"), ("hot", "a", "b", "c")):
        wanted = {g: n[g] ** mixing.TEMPERATURE for g in kind}
        for g in kind:
            assert abs(got[g] / len(got_rows) / (wanted[g] / sum(wanted.values())) - 1) < 0.05, g
    assert abs(len(got_rows) / len(rows) / mixing.RATE - 1) < 0.03


# --- 6 ---


def brute_dedup(rows, percent=75):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (t or "")))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    par = {i: i for i in sets}

    def f(x):
        while par[x] != x:
            x = par[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((f(i), f(j)))
                par[y] = x
    return {i: (len(sets[i]), f(i)) for i in ids}


def family(seed, size, words=120):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    base = [word() for _ in range(words)]
    out = []
    for _ in range(size):
        w = list(base)
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = word()
        out.append(" ".join(w))
    return out


def test_op6_equals_brute_force(spark):
    texts = [*ODD, "A B C D E F G", *family(1, 60), *family(2, 3), *[family(3, 1)[0]] * 40, *family(4, 25, 30)]
    passage = " ".join(family(9, 1, 60))
    texts += [f"{passage} {family(100 + i, 1, 80)[0]}" for i in range(30)]  # a passage that many share
    df = docs_of(spark, texts, extra=True)
    got = {r["doc_id"]: r for r in minhash.near_duplicates(df).collect()}
    want = brute_dedup(list(enumerate(texts)))
    assert len(got) == len(texts)
    for i, (n, c) in want.items():
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (n, c, c == i), (i, got[i])


def test_op6_exhaustive_step(spark, monkeypatch):
    monkeypatch.setattr(minhash, "ROUNDS", 0)  # only the blockwise comparison
    monkeypatch.setattr(minhash, "BLOCK", 16)
    texts = [*family(5, 50), *family(6, 20)]
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs_of(spark, texts)).collect()}
    assert got == {i: c for i, (_, c) in brute_dedup(list(enumerate(texts))).items()}


def test_op6_repeated_rows_and_null_ids(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (3, None), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    r = sorted((str(x["doc_id"]), x["n_shingles"], x["component_id"], x["kept"]) for x in minhash.near_duplicates(df).collect())
    assert r == sorted([("1", 2, 1, True), ("1", 2, 1, True), ("2", 2, 1, False), ("None", 2, None, None), ("3", 0, 3, True), ("3", 0, 3, True)])
    kept = sorted(str(x["doc_id"]) for x in minhash.keep_one(df).collect())
    assert kept == ["1", "3", "None"]
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, k) for k in range(6, 40)] + [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(70)] + [(7, 7), (None, 3), (3, None)]
    got = {r["node"]: r["component"] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    par = {}

    def f(x):
        while par.setdefault(x, x) != x:
            x = par[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = sorted((f(a), f(b)))
            par[y] = x
    assert got == {x: f(x) for x in par}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_word_hashes():
    words = [b"a", b"b", b"ab", b"ba", b"abc", b"a", "é".encode()]
    h = common.word_hashes(b"  " + b" \n".join(words) + b"\t")
    assert len(h) == 7 and h[0] == h[5] and len(set(h.tolist())) == 6 and len(common.word_hashes(b" ")) == 0


# --- 7 ---


@pytest.fixture(scope="module")
def labeller():
    return html_blocks.labeller()


def test_op7_on_pages(spark, sf, labeller):
    import html

    rows = {r["page_id"]: r for r in html_blocks.extract(read(spark, sf, "pages")).collect()}
    pages = read(spark, sf, "pages").collect()
    assert len(rows) == len(pages)
    for p in pages:
        a = re.search(r"<article>(.*?)(?:</article>|\Z)", p["html"], re.S).group(1)
        parts = re.split(r"</?(?:p|h1|h2|li)>", a)
        want = "\n".join(x for x in (re.sub(r"\s+", " ", html.unescape(re.sub(r"</?b>", "", q.replace("<br>", " ")))).strip() for q in parts) if x)
        assert rows[p["page_id"]]["text"] == want and rows[p["page_id"]]["n_chars"] == len(want)


def test_op7_held_out_pages(labeller):
    rng = random.Random(123)
    right = 0
    for _ in range(150):
        page, main = html_blocks.sample_page(rng)
        right += html_blocks.main_texts(labeller, [page])[0] == "\n".join(re.sub(r"\s+", " ", m).strip() for m in main)
    assert right >= 130


def test_op7_parts(labeller):
    page = """<html><head><title>no</title><script>var a = "<p>no</p>";</script></head><body><header><div class="logo">no site</div></header><nav><a href="/">no menu</a></nav>
    <div class="cookie-notice">we use cookies no</div><article><h1>Title &amp; more</h1><p>First   para graph with <b>bold</b> text, long enough to read.<br>And a second line of it.<p>Second paragraph, also with many words in it, really.</article>
    <aside class="sidebar"><ul><li><a href="/x">no related</a></li></ul></aside><section class="comments"><div class="comment"><p>no I disagree with this</p></div></section>
    <form><label>no mail</label><input></form><footer>no &copy; 2024</footer></body></html>"""
    got = html_blocks.main_texts(labeller, [page, None, "", "<<<", "<!-- x", "<p>&#x41;&nbsp;b"])
    assert got[0].split("\n")[0] == "Title & more" and "no" not in got[0].split() and got[0].count("\n") == 2
    assert got[1] == got[2] == ""


def test_op7_odd(spark, labeller):
    rows = [(1, None, None), (1, "u", ""), (2, "u", "<div>" * 3000 + "deep"), (3, "u", "<p>x" * 3000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text")
    assert html_blocks.extract(df).count() == 4 and html_blocks.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("piece", ["<div>", "<div>x", "<a ", "<a \"", "<svg/>", "<p>", "<p>x", "</b><i>", "<i><div><b></i>", "<!--", "<", "<li>a", "&am<b>p;", "<div class='a b'>y</span>", "<a href='\">"])
def test_op7_parser_is_linear(piece):
    import time

    page = piece * (1_000_000 // len(piece))
    t = time.process_time()
    html_blocks.blocks_of(page)
    assert time.process_time() - t < 12  # a quadratic one takes hours


def test_op7_references_within_tags():
    assert [b.text for b in html_blocks.blocks_of("<p>a &amp; b&am<b>p;</b> &lt;i&gt;<br>c</p>")] == ["a & b&amp; <i> c"]


def test_lstm_gradients():
    rng = np.random.default_rng(0)
    m = html_blocks.Labeller(width=5, hidden=3, seed=1)
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    x, live = rng.normal(size=(2, 4, 5)), np.array([[True] * 4, [True, True, False, False]])
    y = rng.integers(0, 2, (2, 4)).astype(float)

    def loss():
        p = m.forward(x, live)
        return -(np.where(live, y * np.log(p) + (1 - y) * np.log(1 - p), 0)).sum() / live.sum()

    g = m.gradients(x, live, y)
    for k in m.p:
        at = tuple(rng.integers(0, n) for n in m.p[k].shape)
        old = m.p[k][at]
        m.p[k][at] = old + 1e-3
        up = loss()
        m.p[k][at] = old - 1e-3
        down = loss()
        m.p[k][at] = old
        assert abs((up - down) / 2e-3 - g[k][at]) < 2e-4, k


# --- 8 ---

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def fits(kind, v):
    d = re.sub("[^0-9]", "", v)
    if kind == "ip":
        return all(int(x) <= 255 for x in v.split("."))
    if kind == "card":
        total = sum((int(c) * (1 + i % 2) - (9 if int(c) * (1 + i % 2) > 9 else 0)) for i, c in enumerate(reversed(d)))
        return 12 <= len(d) <= 19 and total % 10 == 0
    return 9 <= len(d) <= 15 if kind == "phone" else True


def brute_pii(t):
    out = sorted((m.start(), i, m.end(), k) for i, (k, p) in enumerate(BASE.items()) for m in re.finditer(p, t or "") if fits(k, m.group()))
    return [f"{k}:{a}:{b}" for a, _, b, k in out]


def test_op8_equals_brute_force(spark, sf):
    rng = random.Random(3)
    texts = [*ODD, "a@b.c_x@d.e", "1.2.3.4.5.6.7.8 999.1.1.1", "4111 1111 1111 1111 and 4111-1111-1111-1111-2", "+1 (988) 555-2485 +49-30-123456 +1+2", "1" * 5000, "a" * 60000 + "@", "+1" + " " * 40000]
    texts += ["".join(rng.choice("a@.+-_ 0149()c") for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    df = docs_of(spark, texts, extra=True)
    got = {r["doc_id"]: r for r in pii.find_spans(df).collect()}
    for i, t in enumerate(texts):
        want = brute_pii(t)
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), t
        assert set(want) <= set(got[i]["spans"].split(",")) | {""}
        assert [got[i][f"n_{k}"] for k in BASE] == [sum(w.startswith(f"{k}:") for w in want) for k in BASE]


def test_op8_adds_and_masks(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "text")
    planted = spark.createDataFrame([(-1, "Contact joe.s [at] example [dot] com please"), (-2, "social security number 078-05-1120 of mine"), (-3, None)], "doc_id long, text string")
    r = {x["doc_id"]: x["spans"] for x in pii.find_spans(docs.unionByName(planted)).where("doc_id < 0").collect()}
    assert r[-3] == "" and r[-1].startswith("email:8:")
    masked = {x["doc_id"]: x["text"] for x in pii.mask(docs.unionByName(planted)).collect()}
    assert "<EMAIL>" in masked[-1] and masked[-3] is None and len(masked) == docs.count() + 3
    for x in docs.collect():
        if not brute_pii(x["text"]):
            continue
        assert not [s for s in brute_pii(masked[x["doc_id"]])]
    assert pii.find_spans(docs.limit(0)).count() == 0


def test_op8_many_matches(spark):
    """More matches than a run holds: offsets go on, and masking keeps what is between."""
    text = " ".join(f"x{i} u{i}@h{i % 7}.org, y" for i in range(5000))
    df = docs_of(spark, [text, "a@b.com"])
    r = {x["doc_id"]: x for x in pii.find_spans(df).collect()}
    want = brute_pii(text)
    assert r[0]["n_email"] == 5000 and r[0]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest() and r[1]["n_email"] == 1
    assert pii.mask(df).where("doc_id = 0").first()["text"] == " ".join(f"x{i} <EMAIL>, y" for i in range(5000))


def test_op8_loose_apart_from_base(spark):
    """The walk over both lists of spans against every pair of them."""
    rng = random.Random(11)

    def spans(n, width):
        return sorted((a, rng.randrange(6), a + rng.randint(1, width), "ip", "v", "", "") for a in (rng.randrange(200) for _ in range(n)))

    rows = [(i, spans(rng.choice((0, 1, 5, 30)), 12), spans(rng.choice((0, 1, 9)), 30)) for i in range(300)]
    rows.append((300, spans(3000, 5), [(500 + a, k, 500 + b, *r) for a, k, b, *r in spans(3000, 9)]))
    df = spark.createDataFrame(rows, f"id long, b {pii.SPAN}, l {pii.SPAN}")
    got = {r["id"]: r["x"] for r in df.select("id", pii._apart(F.col("b"), F.col("l")).alias("x")).collect()}
    for i, b, l in rows:
        assert sorted(map(tuple, got[i])) == [x for x in l if not any(y[0] < x[2] and x[0] < y[2] for y in b)], i


def test_op8_stays_in_the_jvm(spark, sf):
    plan = pii.mask(read(spark, sf, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# --- 9 ---


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries._tokenizer())


def test_word_encoder_equals_tokenizer(spark, sf, tokenizer):
    enc = packing.WordEncoder(queries._tokenizer())
    texts = [t or "" for t in ODD] + ["It's I'll don't' 're", "Œuvre ΣΑΣ x", "x<|endoftext|>y <|endoftext|> z", "1234 a1b2 ,,, 'tis ...abc", "İstanbul \xa0 a\x85b", "it's, what's!! 's 't** a's."]
    texts += [r["text"] for r in read(spark, sf, "documents").collect()]
    for t, raw in zip(texts, enc.batch(texts)):
        assert np.frombuffer(raw, "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t[:80]


def test_word_encoder_forgets(spark, sf, tokenizer):
    enc = packing.WordEncoder(queries._tokenizer(), remembered=50)
    texts = [r["text"] or "" for r in read(spark, sf, "documents").limit(60).collect()] + ["x" * 500 + " ab, ab ab!", ""]
    for _ in range(2):
        for t in texts:
            assert np.frombuffer(enc.batch([t])[0], "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids
            assert all(len(w) <= packing.LONG_WORD for w in enc.known)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8"), max_size=40), max_size=5))
def test_word_encoder_on_any_text(texts):
    from tokenizers import Tokenizer

    enc = packing.encoder(queries._tokenizer())
    tok = Tokenizer.from_file(queries._tokenizer()) if not hasattr(test_word_encoder_on_any_text, "tok") else test_word_encoder_on_any_text.tok
    test_word_encoder_on_any_text.tok = tok
    for t, raw in zip(texts, enc.batch(texts)):
        assert np.frombuffer(raw, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=80))
def test_first_fit_decreasing(lengths):
    lengths = sorted(lengths, reverse=True)
    free, want = [], []
    for n in lengths:
        k = next((k for k, f in enumerate(free) if f >= n), None)
        if k is None:
            free.append(50)
            k = len(free) - 1
        want.append((k, 50 - free[k]))
        free[k] -= n
    assert packing.first_fit_decreasing(lengths, 50) == want


def test_op9_packs_everything(spark, sf, tokenizer):
    docs = docs_of(spark, [*ODD, "word " * 9000], extra=True).unionByName(read(spark, sf, "documents").selectExpr("doc_id + 1000 doc_id", "text", "lang", "source", "n_chars"), allowMissingColumns=True)
    rows = packing.pack_documents(docs, queries._tokenizer()).toPandas()
    ids = {r["doc_id"]: np.array(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [1], "<u4") for r in docs.collect()}
    for i, g in rows.groupby("doc_id"):
        g = g.sort_values("start")
        assert (g.doc_tokens == len(ids[i])).all() and g.start.tolist() == [0, *g.length.cumsum().tolist()[:-1]] and g.length.sum() == len(ids[i])
        for r in g.itertuples():
            assert zlib.crc32(ids[i][r.start : r.start + r.length].tobytes()) == r.ids_crc32
    assert set(rows.doc_id) == set(ids)
    for _, g in rows.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.offset.tolist() == [0, *g.length.cumsum().tolist()[:-1]] and g.length.sum() <= 2048
    used = rows.groupby("sequence_id").length.sum()
    assert (2048 - used).sum() / used.sum() < 0.05
    assert packing.pack_documents(docs.limit(0), queries._tokenizer()).count() == 0
    twice = docs.where("doc_id < 3").unionByName(docs.where("doc_id < 3"))
    assert packing.pack_documents(twice, queries._tokenizer()).count() == 6


# --- 10 ---


def test_op10(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    r = {x["doc_id"]: x for x in langid.identify(docs).collect()}
    lang = {x["doc_id"]: x["lang"] for x in docs.collect()}
    held = [i for i in lang if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(r[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in r)
    assert np.mean([r[i]["lang_pred"] == lang[i] for i in held]) > 0.97 and all(0 <= x["score"] <= 1 for x in r.values())


def test_op10_equals_brute_force(spark, sf):
    """Every prediction again, word by word from the model's entries."""
    docs = read(spark, sf, "documents")
    m = langid.learn(docs)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(docs, m).collect()}
    said = {}

    def says(w):
        if w in m.words:
            return m.table[m.words[w]].astype(float)
        for n in range(langid.MAX_ORDER, 0, -1):
            whole = f"^{w}$" if n > 1 else w
            found = [m.table[m.grams[whole[i : i + n]]] for i in range(len(whole) - n + 1) if whole[i : i + n] in m.grams]
            if found:
                v = np.mean(found, axis=0)
                return v - v.max()
        return np.zeros(len(m.langs))

    for r in docs.collect():
        total = np.zeros(len(m.langs))
        for w in re.findall(r"[^\W\d_]+", (r["text"] or "").lower()):
            if w not in said:
                said[w] = says(w)
            total += said[w]
        p = np.exp(total - total.max())
        lang, score = got[r["doc_id"]]
        if lang == "und":
            assert not any(c.isalpha() for c in r["text"] or "")
        else:
            assert lang == m.langs[int(total.argmax())] and abs(score - p.max() / p.sum()) < 1e-3


def test_op10_backs_off(spark):
    rows = [(i, w, g) for i, (w, g) in enumerate([("the house and the garden", "en"), ("das haus und der garten", "de")] * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    m = langid.learn(docs)
    ask = docs_of(spark, ["gartenhaus", "housing", None, "", "123 ²", "zzqq", "THE", "garten"], extra=True)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(ask, m).collect()}
    assert [got[i][0] for i in (0, 1, 6, 7)] == ["de", "en", "en", "de"] and [got[i] for i in (2, 3, 4)] == [("und", 0.0)] * 3
    none = langid.learn(docs.limit(0))
    assert {r["lang_pred"] for r in langid.predict(ask, none).collect()} == {"und"} and none.langs == []


def test_op10_keeps_every_piece(spark):
    words = ["".join("abcdefghijklmnop"[i >> s & 15] for s in (0, 4, 8, 12, 16)) for i in range(90_000)]
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(i, " ".join(2 * words[k :: len(ids)]), "en" if i % 2 else "de") for k, i in enumerate(ids)]
    m = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert set(m.words) == set(words)
    tally = Counter(g for w in words for n in range(1, langid.MAX_ORDER + 1) for g in langid.grams_of(w, n) for _ in range(2))
    assert set(m.grams) == {g for g, c in tally.items() if c >= 3}

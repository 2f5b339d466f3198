"""Operators 11 to 13 against brute force, and their defined results."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import sf_dir
from murmuration.llm import fim, registry, resampling, simhash

EDGE = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (5, "a b c"), (None, "x y z w v"),
        (6, "<P> is held"), (7, "\n\n"), (8, "end\n"), (9, "Äö 漢字\nÉ <S\n>"), (10, "w " * 30_000)]


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def with_clashes(df):
    names = ["n", "bits", "_salt", "_place", "_range", "score", "rank", "h1", "buckets", "form", "key"]
    return df.select("*", *[F.lit("own").alias(c) for c in names])


def documents(spark):
    return spark.read.parquet(f"{sf_dir('0.001')}/documents.parquet").select("doc_id", "text")


# --- 11 ---------------------------------------------------------------------------

def brute_resample(rows, target, longest, least):
    def feats(text):
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        runs = [" ".join(words[i:i + n]) for n in range(1, longest + 1)
                for i in range(len(words) - n + 1)]
        return len(words), [crc32(r.encode()) % 10_000 for r in runs]

    own = [feats(t) for _, t in rows]
    s = Counter(b for _, f in own for b in f)
    t = Counter(b for x in target for b in feats(x)[1])
    S, T = sum(s.values()), sum(t.values())
    out = []
    for (i, _), (words, f) in zip(rows, own):
        gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000))))
                for b in f]
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain) // len(gain) if gain else 0
        out.append((i, len(f), weight, weight + math.floor(
            -1000 * math.log(-math.log((h + 0.5) / 4294967296))), words))
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = [r[:4] for r in able[:10 * len(able) // 100]]
    return Counter(r[:4] for r in out), drawn


@pytest.mark.parametrize("longest", [1, 2])
def test_resampling_matches_brute_force(spark, longest):
    rows = [tuple(r) for r in documents(spark).collect()] + EDGE
    target = ["one two three", None, "", "the A-b 9 ä"]
    got = resampling.resample(spark, with_clashes(frame(spark, rows)),
                              frame(spark, [(t,) for t in target], "text string"), longest).collect()
    every, drawn = brute_resample(rows, target, longest, 20)
    assert Counter(tuple(r)[:4] for r in got) == every
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [tuple(r)[:4] for r in ranked] == drawn


def test_overlapped_runs_are_spans_of_words():
    import regex
    line = b"ab b ab c"
    for n in (1, 2, 3):
        words = line.split()
        found = [m.group() for m in regex.finditer(resampling.run_pattern(n), line, overlapped=True)]
        assert found == [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)]


def test_one_row_with_a_third_of_the_corpus_is_ranked_whole(spark):
    rows = [(1, "same words " * 20)] * 300 + [(i, f"text {i} " * 12) for i in range(2, 602)]
    got = resampling.resample(spark, frame(spark, rows).repartition(7), frame(spark, rows)).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 91))


# --- 12 ---------------------------------------------------------------------------

def brute_fingerprint(text, words=4):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    tokens = re.findall(r"[^\x20\x09-\x0D]+", low)
    runs = [" ".join(tokens[i:i + words]) for i in range(max(len(tokens) - words + 1, min(1, len(tokens))))]
    hs = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hs) > len(hs))


def brute_components(prints):
    """Least id reachable of (doc_id, fingerprint) rows, through links of 4 bits."""
    ids = list(range(len(prints)))

    def find(i):
        while ids[i] != i:
            i = ids[i]
        return i

    for i, j in itertools.combinations(range(len(prints)), 2):
        if (prints[i][1] ^ prints[j][1]).bit_count() <= 4:
            a, b = find(i), find(j)
            ids[max(a, b)] = min(a, b)
    least = {}
    for i, (doc, _) in enumerate(prints):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return [least[find(i)] for i in range(len(prints))]


def test_golay_code_is_perfect_and_indices_meet():
    rest, error = simhash.golay()
    assert len(np.unique(error)) == 2048
    rng = np.random.default_rng(5)
    for width in (22, 21):
        x = rng.integers(0, 1 << width, 400)
        for flips in range(3):
            y = x.copy()
            for _ in range(flips):
                y ^= 1 << rng.integers(0, width, 400)
            (a, ua), (b, ub) = (simhash.indices(v, width, rest, error) for v in (x, y))
            for k in range(400):
                assert set(a[k][ua[k]]) & set(b[k][ub[k]])
        assert set(ua.sum(axis=1).tolist()) <= {1, 2, 3, 4, 5, 6}


def test_every_pair_within_the_distance_meets_under_a_key():
    rest, error = simhash.golay()
    rng = np.random.default_rng(6)
    x = rng.integers(0, 1 << 63, 3000, dtype=np.uint64) * np.uint64(2)
    y = x.copy()
    for _ in range(4):
        y ^= np.uint64(1) << rng.integers(0, 64, len(x)).astype(np.uint64)
    # all four differing bits in one segment, too
    y[:1000] = x[:1000] ^ np.uint64(0b1111) << rng.integers(0, 60, 1000).astype(np.uint64)
    (i, a), (j, b) = simhash.keys_of(x, rest, error), simhash.keys_of(y, rest, error)
    one, other = set(zip(i.tolist(), a.tolist())), set(zip(j.tolist(), b.tolist()))
    assert {r for r, _ in one & other} == set(range(len(x)))


def test_simhash_matches_brute_force(spark):
    rows = [tuple(r) for r in documents(spark).collect()] + [(100_000 + (i or 50), t) for i, t in EDGE]
    got = simhash.near_duplicates(spark, with_clashes(frame(spark, rows))).collect()
    prints = [(i, brute_fingerprint(t)) for i, t in rows]
    want = Counter((i, f"{p:016x}", c) for (i, p), c in zip(prints, brute_components(prints)))
    assert Counter(tuple(r) for r in got) == want


def test_large_keys_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "LIMIT", 3)
    monkeypatch.setattr(simhash, "BLOCK", 8)
    monkeypatch.setattr(simhash, "CHUNK", 64)
    rng = np.random.default_rng(7)
    # all near 0 in two segments and spread in the third: many rows a key, several components
    third = rng.choice(1 << 21, 200, replace=False).astype(np.int64) << 43
    noise = np.concatenate([[0], 1 << rng.integers(0, 43, 199)])
    bits = np.unique(third ^ noise).tolist()
    classes = frame(spark, [(b,) for b in bits], "bits long").repartition(3)
    labels = {r["id"]: r["comp"] for r in simhash.linked(spark, classes).collect()}
    mask = (1 << 64) - 1
    want = brute_components([(b, b & mask) for b in bits])
    assert [labels.get(b, b) for b in bits] == want


def test_simhash_of_nulls_and_empty(spark):
    got = simhash.near_duplicates(spark, frame(spark, [(None, None), (3, ""), (7, None)])).collect()
    assert sorted(map(tuple, got), key=str) == [
        (3, "0" * 16, 3), (7, "0" * 16, 3), (None, "0" * 16, None)]
    assert simhash.near_duplicates(spark, frame(spark, [])).collect() == []


# --- 13 ---------------------------------------------------------------------------

def brute_fim(i, text, rate=100):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return (i, n, "plain", None, None, text)
    if h4 % 100 < 50:
        return (i, n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}")
    return (i, n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}")


@pytest.mark.parametrize("rate", [100, 40])
def test_fill_in_middle_matches_brute_force(spark, rate):
    rows = [tuple(r) for r in documents(spark).collect()] + EDGE
    made = fim.transform(with_clashes(frame(spark, rows)), rate=rate)
    got = made.withColumn("back", fim.restore(F.col("output"), F.col("form"))).collect()
    want = Counter((*brute_fim(i, t, rate), t or "") for i, t in rows)
    assert Counter(tuple(r) for r in got) == want
    assert {r["form"] for r in got} == {"plain", "spm", "psm"}


def test_sentinels_may_not_overlap():
    for bad in (("<P>", "<P>", "<M>"), ("ab", "bc", "x"), ("aa", "b", "c"), ("", "b", "c"), ("abc", "b", "x")):
        with pytest.raises(ValueError):
            fim._check(bad)


def test_empty_tables(spark):
    empty = frame(spark, [])
    assert fim.transform(empty).collect() == []
    assert resampling.resample(spark, empty, empty).collect() == []


def test_queries_hold_their_columns(spark):
    sf = sf_dir("0.001")
    n = registry.table(spark, sf, "documents").count()
    want = {"op11_importance_resampling": {"doc_id", "n_features", "weight", "score", "rank"},
            "op12_simhash_dedup": {"doc_id", "fingerprint", "component_id"},
            "op13_fill_in_middle": {"doc_id", "n", "form", "prefix_chars", "middle_chars",
                                    "output_sha256", "restored_sha256"}}
    for name, columns in want.items():
        df = registry.queries()[name](spark, sf)
        assert columns <= set(df.columns) and df.count() == n

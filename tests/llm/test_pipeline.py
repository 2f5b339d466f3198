"""The pipeline's stages, each judged on its own input."""

from __future__ import annotations

import random

import numpy as np

import corpus_pipeline
from murmuration.llm import langid, neardup, quality, registry


def documents(spark):
    rng = random.Random(4)
    en = ["the", "of", "and", "with", "that", "thing", "nation", "other", "there", "where", "is"]
    de = ["der", "die", "und", "nicht", "eine", "schatz", "keit", "über", "ist", "auch", "von"]
    rows = []
    for i in range(60):
        lang, words = (("en", en), ("de", de))[i % 2]
        rows.append((i, " ".join(rng.choice(words) + str(rng.randint(0, 40)) * (k % 4 == 0)
                                 for k in range(80)) + ".", lang))
    rows += [(100, rows[0][1], "en"), (101, rows[1][1] + " Ende", "de"), (102, "***$$$ " * 50, "en"),
             (103, None, None), (104, "", "en"), (105, "1234 " * 40, "en"), (106, rows[2][1], "en")]
    return spark.createDataFrame([(i, t, g, "s", len(t or ""), i * 2) for i, t, g in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, keep_id long")


def test_stages(spark):
    docs = documents(spark)
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "language_id", "exact_dedup", "near_dedup", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, "")
        if name == "packing":
            assert {r["doc_id"] for r in got.collect()} == {r["doc_id"] for r in docs.collect()}
            break
        assert got.columns == docs.columns
        before = {r["doc_id"]: r for r in docs.collect()}
        after = {r["doc_id"] for r in got.collect()}
        if name == "quality_rules":
            want = {r["doc_id"] for r in quality.quality(docs).filter("kept").collect()}
        elif name == "language_id":
            want = {r["doc_id"] for r in langid.identify(spark, docs).filter(
                f"score >= {langid.MIN_SCORE} and lang_pred <> 'und'").collect()}
        elif name == "exact_dedup":
            first = {}
            for i in sorted(before):
                first.setdefault(before[i]["text"], i)
            want = set(first.values())
        else:
            want = {r["doc_id"] for r in neardup.near_duplicates(spark, docs).filter("kept").collect()}
            assert 101 not in want
        assert after == want and set(range(60)) <= after
        docs = got


def test_near_dedup_links_pairs_from_80_percent(spark):
    words = [f"w{i}" for i in range(204)]  # 200 shingles
    tails = {1: 0, 2: 20, 3: 22, 4: 26, 5: 60}  # words replaced at the end, each by one of its own
    rows = [(i, " ".join(words[:204 - k] + [f"x{i}y{j}" for j in range(k)])) for i, k in tails.items()]
    near = {i for i, k in tails.items() if 5 * (200 - k) >= 4 * (200 + k)}
    assert near == {1, 2, 3} and 100 * 178 < 85 * 222  # the third at 0.802
    rows += [(6, "z " * 30), (7, " ".join(f"q{i}" for i in range(90)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()}
    assert got == {1, 4, 5, 6, 7}


def test_near_dedup_signatures_suit_the_similarity():
    assert neardup.scheme(85) == (neardup.SYMBOLS, neardup.CHUNKS, neardup.DISTANCE)
    for percent in (50, 60, 70, 80, 85, 90, 100):
        count, chunks, distance = neardup.scheme(percent)
        assert neardup.miss_probability(percent, count, distance) < 1e-4 and distance < 2 * chunks
        assert count >= 2 * chunks
    assert neardup.miss_probability(80, neardup.SYMBOLS, neardup.DISTANCE) > 1e-3
    # pairs at the distance meet
    count, chunks, distance = neardup.scheme(corpus_pipeline.NEAR_PERCENT)
    rng = np.random.default_rng(0)
    one = rng.integers(0, 65536, (300, count)).astype(np.uint64)
    two = one.copy()
    for row in two:
        row[rng.choice(count, distance, replace=False)] += np.uint64(1)
    assert all(set(a) & set(b) for a, b in zip(neardup.chunk_keys(one, chunks),
                                               neardup.chunk_keys(two, chunks)))


def test_empty_documents(spark):
    docs = documents(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "").count() == 0


def test_every_operator_is_registered():
    names = registry.queries()
    assert [sum(q.startswith(f"op{n}_") for q in names) for n in range(1, 11)] == [1] * 10
    assert "pipeline" in names and set(registry.oracle_sql()) <= set(names)

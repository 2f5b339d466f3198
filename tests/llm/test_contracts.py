"""What all operators share: SQL, bare workers, column names, repeated rows, odd texts."""

from __future__ import annotations

import os
import random
import subprocess
import sys
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import sf_dir
from murmuration.llm import exact, langid, lattice, quality, registry, shards
from murmuration.llm.common import text_bytes

duckdb = pytest.importorskip("duckdb")
SQL = registry.oracle_sql()
REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_its_sql(spark, name):
    sf = sf_dir("0.001")
    con = duckdb.connect()
    for f in os.listdir(sf):
        if f.endswith(".parquet"):
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{sf}/{f}')")
    rel = con.sql(SQL[name])
    df = registry.queries()[name](spark, sf).select(*rel.columns)

    def plain(rows):
        return Counter(tuple(None if v is None or v != v else v for v in r) for r in rows)

    assert plain(df.collect()) == plain(rel.fetchall())


def test_workers_need_no_package(tmp_path):
    """Every Python operator on workers that cannot import this package."""
    script = tmp_path / "bare.py"
    script.write_text(f'''
import sys
sys.path.insert(0, {REPO!r})  # the driver alone
from pyspark.sql import functions as F
from murmuration.session import build_session
spark = build_session("local[2]", shuffle_partitions=2)

@F.udf("boolean")
def bare(x):
    try:
        import murmuration
    except ImportError:
        return True
    return False

assert spark.range(1).select(bare("id")).first()[0]
from murmuration.llm import chat, ctw, fim, html, langid, lattice, neardup, packing, resampling, simhash
from murmuration.operators import vectors
from murmuration.operators.heavy import heavy_hitters
from murmuration.operators.membership import in_set
docs = spark.createDataFrame([(i, "some words of text number %d here" % i, "en" if i % 2 else "fr") for i in range(20)],
                             "doc_id long, text string, lang string")
turns = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "yes")],
                              "conv_id long, turn long, role string, text string")
pages = spark.createDataFrame([(1, "u", "<p>One, two</p>")], "page_id long, url string, html string")
assert html.extract(pages).count() == 1
assert chat.digests(chat.format_turns(turns)).count() == 1
for make in (lattice.encode, lambda d: packing.pack(spark, d), lambda d: langid.identify(spark, d),
             lambda d: neardup.near_duplicates(spark, d), lambda d: ctw.score(spark, d),
             lambda d: resampling.resample(spark, d, d), lambda d: simhash.near_duplicates(spark, d), fim.transform):
    assert len(make(docs).collect()) == 20
v = docs.select(F.array(F.col("doc_id").cast("double")).alias("v"), "doc_id")
assert len(vectors.vector_kmeans(v, [(0, (0.0,)), (1, (9.0,))], 2, 0.0).centers) == 2
assert vectors.vector_assign(v, [(0, (0.0,))]).count() == 20
assert in_set(docs, "doc_id", docs, "doc_id", 64).count() == 20
assert heavy_hitters(docs, "lang", 1)[0].count() == 1
''')
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True,
                          timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]


NAMES = ["_h", "_sha", "_keep", "_size", "_dedup", "_text", "_texts", "_seen", "_guess", "_lang", "_gone", "row",
         "lang_pred", "kept", "_readable", "first", "key", "n", "b", "a", "x.y"]


def test_stages_keep_columns_of_any_name(spark):
    rows = [(i, t, "en") for i, t in enumerate(["words " * 30, "words " * 30, "other text, in short", None])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").select(
        "*", *[F.concat(F.lit(f"own {c} "), F.col("doc_id").cast("string")).alias(c) for c in NAMES])
    for name, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns, name
        for r in out.collect():
            assert [r[c] for c in NAMES] == [f"own {c} {r['doc_id']}" for c in NAMES]


def test_exact_copies_with_colliding_hashes_keep_columns(spark):
    docs = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "a", "z")], "doc_id long, text string, _h string")
    kept = exact.annotated(spark, docs, content_hash=lambda t: F.lit(b"0")).filter("_dedup.kept").select("row.*")
    assert sorted(map(tuple, kept.collect())) == [(1, "a", "x"), (2, "b", "y")]


@pytest.mark.parametrize("rows", [
    [(7, f"text {i}") for i in range(900)] + [(i, f"own {i}") for i in range(100, 1900)],  # one id
    [(7, "same text, all of it")] * 900 + [(i, f"own {i}") for i in range(100, 1900)],     # one row
])
def test_shards_stay_even_when_a_key_repeats(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = shards.shard(spark, df, 8).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in rows)
    size = np.zeros(8)
    places = [[] for _ in range(8)]
    for r in got:
        size[r["shard"]] += r["size"]
        places[r["shard"]].append(r["slot"])
    assert size.max() < 1.05 * size.mean()
    assert all(sorted(p) == list(range(len(p))) for p in places)


def test_language_sample_is_bounded_when_a_row_repeats(spark):
    rng = random.Random(4)
    rows = [(3, "the same words again and again", "en")] * 3000
    rows += [(i, " ".join(rng.choices("le la un des et pour dans avec".split(), k=9)), "fr") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    net = langid.train(df)
    assert net is not None and set(net.langs) <= {"en", "fr"}


def test_windows_are_spelled_block_by_block():
    texts = ["", "a" * 64, "b" * 65, "héllo"]
    data, offsets = text_bytes(pa.array(texts))
    start, doc = langid.windows_of(offsets)
    spans, mask = langid.spelled(data, start, offsets[doc + 1])
    back = ["".join(chr(x) for d, s, m in zip(doc, spans, mask) if d == i for x in s[m > 0]) for i in range(4)]
    assert [b.encode("latin-1").decode() for b in back] == texts


POLISH = "Długi tekst w języku polskim, który opisuje świat i ludzi oraz ich życie każdego dnia. " * 8
JUNK = "buy cheap watches online best price deals discount shop store offers " * 2


def test_stop_words_are_asked_of_known_languages_only(spark):
    words = [f"{w}{i}" for i in range(40) for w in ("alpha", "beta")]
    texts = [" ".join(f"{w}{i}" for i, w in enumerate(POLISH.split())), " ".join(words)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in quality.quality(df).collect()}
    assert "stop_words" not in got[0]["failed"] and got[0]["kept"]
    assert got[1]["failed"] == ["stop_words"]


def test_long_units_are_sampled_as_short_ones(monkeypatch):
    rng = random.Random(3)
    texts = ["".join(rng.choices("abcdefgh0123XYZ/+é漢", k=n)) for n in (3, 40, 400, 900)] + ["two words", ""]
    lat = lattice.Lattice(lattice.MODEL, lattice.ALPHA)
    keys = np.arange(len(texts))
    want = lat.sample(pa.array(texts), keys, 5)
    monkeypatch.setattr(lattice, "LONG", 30)
    got = lat.sample(pa.array(texts), keys, 5)
    assert all(np.array_equal(a, b) for a, b in zip(want, got))


def test_a_text_without_spaces_takes_seconds():
    rng = random.Random(4)
    text = "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=300_000))
    lat = lattice.Lattice(lattice.MODEL, lattice.ALPHA)
    begin = time.perf_counter()
    ids, bounds = lat.sample(pa.array([text]), np.array([1]), 5)
    assert time.perf_counter() - begin < 10
    assert lat.decode(ids, bounds) == [text.encode()]

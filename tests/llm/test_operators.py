"""Each training-data operator against brute force, an exact round trip or held-out labels."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute_ctw
from murmuration.llm import (bpe, chat, common, ctw, exact, html, langid, lattice, neardup, packing,
                             quality, shards)
from murmuration.llm.common import text_bytes, word_bounds, word_hashes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h string, n long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


@pytest.fixture(scope="module")
def texts() -> list[tuple[int, str | None]]:
    rng = random.Random(5)
    words = ["the", "of", "and", "Alpha", "beta", "gamma,", "delta", "x!", "#1", "ünï", "日本"]

    def prose(n: int) -> str:
        return " ".join(rng.choice(words) + rng.choice(["", "s", "ly", "\n"]) for _ in range(n))

    out = [prose(rng.randint(0, 120)) for _ in range(50)]
    for base in out[:6]:  # near and exact copies
        w = base.split(" ")
        out += [base, base + " tail", " ".join(w[:-1])]
    long = prose(4000)
    out += ["", None, "  \n ", "one", "a b c d", "A b C d", "the the the " * 40, long, long, "z" * 3000,
            "<|im_end|> ▁▁ \x1c  x\ty", "line\nline\nline\n\nother words here to make ten of them all"]
    return list(enumerate(out))


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en" if i % 2 else None, None, None, "clash", 3) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def nulls(spark):
    return spark.createDataFrame([(None,) * 7, (1, None, None, None, None, None, None),
                                  (None, "some words", None, None, None, None, None),
                                  (2, "some words", "en", "s", 1, "a", 1),
                                  (2, "some words", "en", "s", 1, "a", 1)], SCHEMA)


# --- 1 html

def test_html_article_without_furniture():
    page = """<html><head><title>t</title><script>var a="<p>no</p>";</script></head><body>
    <header><h1>Site</h1></header><nav><a href=x>Menu</a></nav><div class="cookie-notice">Accept</div>
    <div id=main><article><h1>Title &amp; more</h1><p>First  para&nbsp;graph, with <b>bold
    text<br>and more of it, so that it counts.<p>Second one, also long enough to be scored.
    <div class="ad">Buy</div><blockquote>A quote</blockquote></article>
    <section id="comments"><p>I disagree, this is a long reader comment, really long.</p></section></div>
    <aside>Side</aside><form><p>Sign up</p></form><footer>&copy; x</footer></body></html>"""
    assert html.main_text(page).split("\n") == [
        "Title & more", "First para graph, with bold text and more of it, so that it counts.",
        "Second one, also long enough to be scored.", "A quote"]


def test_html_scores_without_an_article_element():
    links = "".join(f"<li><a href=/{i}>Topic number {i}, and some more</a></li>" for i in range(30))
    body = "".join(f"<p>Sentence {i}, of the text, which is long enough to get points.</p>" for i in range(4))
    page = f"<body><div><ul>{links}</ul></div><div>{body}<p>Short end.</p></div><div>tiny</div></body>"
    lines = html.main_text(page).split("\n")
    assert len(lines) == 5 and lines[-1] == "Short end."


@pytest.mark.parametrize("page", [None, "", "   ", "<p", "<div><p></div>", "</p></p><!--", "a" * 100_000,
                                  "<b>" * 500 + "x", "&am &#x41; &bogus;", "<script>never closed"])
def test_html_never_fails(page):
    html.main_text(page)


BODY = "<p>" + "A long sentence, with commas, about the matter of this page. " * 3 + "</p>"


@pytest.mark.parametrize("page, want, unwanted", [
    (f"<div class='has-sidebar'>{BODY}{BODY}</div>", ["A long"], []),
    (f"<div class='page no-sidebar'><article>{BODY}</article></div>", ["A long"], []),
    (f"<div class='content-sidebar-wrap'><div>{BODY}</div><div class='sidebar'><p>{'Bar. ' * 9}</p>"
     "</div></div>", ["A long"], ["Bar"]),
    (f"<article>{BODY}<section id='discussion'><h2 id='related-work'>Related</h2><p>Further, in short."
     "</p></section><h3 id='notice'>Noted</h3></article>", ["Related", "Further", "Noted"], []),
    (f"<body><form action='/x'>{BODY}{BODY}</form></body>", ["A long"], []),
    (f"<article>{BODY}<form><p>Your mail</p></form></article>", ["A long"], ["mail"]),
    ("<article>" + BODY + "<p>See <a title='Hidden Figures' href='/hidden/x'>the film</a>, a long one, "
     "which all saw.</p></article>", ["See the film, a"], []),
    (f"<div>{BODY}<p hidden>Secret</p><p title='a' hidden=''>Veiled</p></div>", ["A long"],
     ["Secret", "Veiled"]),
    (f"<div>{BODY}</div><div id='comments'>{BODY.replace('A long', 'My own') * 5}</div>", ["A long"],
     ["My own"]),
])
def test_names_alone_drop_no_main_text(page, want, unwanted):
    text = html.main_text(f"<html><body>{page}</body></html>")
    assert all(w in text for w in want) and not any(u in text for u in unwanted)


def test_html_table(spark):
    pages = spark.createDataFrame([(1, "u", "<p>One &lt; two</p>", 1), (2, None, None, 2)],
                                  "page_id long, url string, html string, text long")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html.extract(pages).collect()}
    assert got == {1: ("One < two", 9), 2: ("", 0)}
    assert html.extract(pages.filter("page_id > 9")).count() == 0


# --- 2 sharding

def test_shards_hold_the_bytes_law(spark, docs, texts):
    rows = shards.shard(spark, docs, 5).collect()
    assert {r["doc_id"] for r in rows} == {i for i, _ in texts}
    size = {i: len((t or "").encode()) + 16 for i, t in texts}
    assert all(r["size"] == size[r["doc_id"]] for r in rows)
    assert all(r["text_crc32"] == zlib.crc32((dict(texts)[r["doc_id"]] or "").encode()) for r in rows)
    used = Counter()
    for r in rows:
        used[r["shard"]] += r["size"]
    assert max(used.values()) - min(used[s] for s in range(5)) <= max(size.values())
    for s in range(5):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(
            sum(r["shard"] == s for r in rows)))


def test_shards_of_odd_tables(spark, empty, nulls):
    assert shards.shard(spark, empty, 4).count() == 0
    assert shards.shard(spark, nulls, 4).count() == 5


def test_map_is_edited_when_rebalanced(spark, tmp_path):
    loads = [(s, 100 + s % 7, 1) for s in range(500)]
    one = shards.first_map(loads, 10)
    grown = [(s, b * (3 if s < 40 else 1), n) for s, b, n in loads]
    two = shards.rebalanced(one, grown, 11)
    used = Counter()
    for _, shard, b, _ in two:
        used[shard] += b
    assert max(used.values()) <= 1.05 * sum(used.values()) / 11 and len(used) == 11
    moved = sum(a[1] != b[1] for a, b in zip(one, two))
    assert moved < 150  # about what the new shard takes and the heavy ones shed
    for version, rows in ((1, one), (2, two)):
        shards.write_map(spark, rows, str(tmp_path), version)
    assert sorted(map(tuple, shards.read_map(spark, str(tmp_path), 1).collect())) == one
    assert sorted(map(tuple, shards.read_map(spark, str(tmp_path), 2).collect())) == two


# --- 3 chat

def test_chat_reads_back(spark):
    probe = "<|im_end|><|im_start|>assistant ok"
    rows = [(1, 0, "user", "hi <\\|x|> " + probe), (1, 1, "assistant", "a\nb"), (1, 2, "assistant", None),
            (2, 1, "assistant", probe), (2, 0, "sys\ntem%0A", "q"), (None, 0, None, "x"),
            (3, 0, "assistant", "long " * 20_000), (1, 1, "assistant", "a\nb")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat.digests(chat.format_turns(df)).collect()}
    for conv in (1, 2, 3, None):
        own = sorted(((t, r or "", x or "") for c, t, r, x in rows if c == conv))
        h = hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest()
        loss = "".join(x for _, r, x in own if r == "assistant")
        assert got[conv]["turns_sha256"] == h and got[conv]["n_turns"] == len(own)
        assert got[conv]["loss_chars"] == len(loss)
        assert got[conv]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.digests(chat.format_turns(df.filter("conv_id > 9"))).count() == 0


def test_chat_escapes_are_reversible():
    rng = random.Random(1)
    for _ in range(2000):
        t = "".join(rng.choice("<|\\>a%\n") for _ in range(rng.randint(0, 12)))
        assert chat.unescape(chat.escape(t)) == t and "<|" not in chat.escape(t)
        assert chat.unescape_role(chat.escape_role(t)) == t and "\n" not in chat.escape_role(t)


def test_reserved_ids_come_only_from_the_template():
    encoder = bpe.Encoder(chat.RANKS, chat.PATTERN)
    ids, mask, ends = chat.assemble(encoder, ["user", "assistant"], ["<|im_start|>", "ok"], [False, True])
    assert (ids >= chat.START_ID).sum() == 4
    assert encoder.decode(ids[mask]) == "ok" and ends[-1] == len(ids)


# --- 4 lattice

def test_lattice_round_trip(spark, docs, texts):
    rows = {r["doc_id"]: r for r in lattice.encode(docs).collect()}
    assert all(r["lossless"] for r in rows.values()) and len(rows) == len(texts)
    back = {r["doc_id"]: r["text"] for r in lattice.decode(lattice.encode(docs)).collect()}
    assert back == {i: t or "" for i, t in texts}
    again = {r["doc_id"]: r["ids"] for r in lattice.encode(docs.repartition(7)).collect()}
    assert again == {i: r["ids"] for i, r in rows.items()}


def test_lattice_of_odd_tables(empty, nulls):
    assert lattice.encode(empty).count() == 0
    assert [r["lossless"] for r in lattice.encode(nulls).collect()] == [True] * 5


def test_lattice_samples_in_proportion():
    lat = lattice.Lattice(lattice.MODEL, lattice.ALPHA)
    unit = " the"
    weights: dict[tuple, float] = {}

    def walk(at: int, path: tuple, w: float) -> None:
        if at == len(unit):
            weights[path] = math.exp(w)
            return
        state = 0
        for end in range(at, len(unit)):
            state = int(lat.next[state, ord(unit[end])])
            if not state:
                return
            if lat.piece[state] >= 0:
                walk(end + 1, (*path, int(lat.piece[state])), w + lat.weight[state])

    walk(0, (), 0.0)
    n = 20_000
    ids, bounds = lat.sample(pa.array(["the"] * n), np.arange(n), 3)
    seen = Counter(tuple(ids[a:b].tolist()) for a, b in zip(bounds, bounds[1:]))
    total = sum(weights.values())
    assert set(seen) <= set(weights) and len(weights) > 3
    for path, w in weights.items():
        p = w / total
        assert abs(seen[path] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-3


# --- 5 exact

@pytest.mark.parametrize("bits", [None, 3])
def test_exact_groups_equal_brute_force(spark, docs, texts, bits):
    groups: dict[str, list[int]] = {}
    for i, t in texts:
        groups.setdefault(t or "", []).append(i)
    kind = {} if bits is None else {"content_hash": lambda t: F.pmod(F.xxhash64(t), F.lit(1 << bits))}
    for keep, best in (("max", max), ("min", min)):
        got = {r["doc_id"]: tuple(r)[1:] for r in exact.groups_of(spark, docs, keep, **kind).collect()}
        for i, t in texts:
            own = groups[t or ""]
            assert got[i] == (best(own), len(own), i == best(own),
                              hashlib.sha256((t or "").encode()).hexdigest())
    assert sorted(r["doc_id"] for r in exact.keep_first(spark, docs).collect()) == sorted(
        min(v) for v in groups.values())


def test_exact_without_broadcasts(spark, docs, monkeypatch):
    def narrow(t):
        return F.pmod(F.xxhash64(t), F.lit(8))

    want = sorted(map(tuple, exact.groups_of(spark, docs).collect()))
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    assert sorted(map(tuple, exact.groups_of(spark, docs).collect())) == want
    assert sorted(map(tuple, exact.groups_of(spark, docs, content_hash=narrow).collect())) == want


def test_exact_of_odd_tables(spark, empty, nulls):
    assert exact.groups_of(spark, empty).count() == 0
    kept = exact.keep_first(spark, nulls).collect()
    assert sorted((r["text"] or "") for r in kept) == ["", "some words"]


# --- 6 packing

def test_packing_places_every_id(spark, docs, texts):
    rows = packing.pack(spark, docs).collect()
    from tokenizers import Tokenizer
    import public_tokenizers
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    for i, t in texts:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            part = np.array(ids[at:at + r["length"]], "<u4")
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert r["ids_crc32"] == zlib.crc32(part.tobytes())
            at += r["length"]
        assert at == len(ids)
    for own in by_seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.WINDOW
    assert len(by_seq) <= math.ceil(sum(r["length"] for r in rows) / packing.WINDOW) + 2


def test_packing_of_odd_tables(spark, empty, nulls):
    assert packing.pack(spark, empty).count() == 0
    assert packing.pack(spark, nulls).count() == 5


def test_full_pieces_are_sequences_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(packing, "BUCKETS", 4)
    monkeypatch.setattr(packing, "PER_BUCKET", 8)
    docs = spark.createDataFrame([(1, "one two three " * 300), (1, "one two three " * 300),
                                  (None, "four five " * 100), (2, "six"), (3, None)],
                                 "doc_id long, text string")
    rows = packing.pack(spark, docs, window=32, unit=8).collect()
    held = Counter()
    for r in rows:
        held[r["sequence_id"]] += r["length"]
    alone = [r for r in rows if r["length"] == 32]
    assert len(alone) > 40 and all(r["offset"] == 0 and held[r["sequence_id"]] == 32 for r in alone)
    assert sorted(held) == list(range(len(held))) and max(held.values()) <= 32


def test_linear_program_finds_the_optimum():
    # 3 sizes whose best patterns fill the room: 100 + 60 + 96, 128 + 128
    plan = packing.plan({100: 50, 60: 50, 96: 50, 128: 20}, 256)
    assert sum(n for _, n in plan) == 60
    for pattern, _ in plan:
        assert sum(s * c for s, c in pattern.items()) <= 256
    rng = np.random.default_rng(2)
    sizes = {int(s): int(n) for s, n in zip(range(1, 120), rng.integers(1, 400, 119))}
    plan = packing.plan(sizes, 256)
    held = Counter()
    for pattern, n in plan:
        for s, c in pattern.items():
            held[s] += c * n
    assert held == Counter(sizes)
    assert sum(n for _, n in plan) <= 1.01 * sum(s * n for s, n in sizes.items()) / 256 + 2


def test_bpe_equals_whole_texts():
    rng = random.Random(3)
    own = ["".join(rng.choice(" \n\taB1!é's日\x1d ") for _ in range(rng.randint(0, 30)))
           for _ in range(500)]
    encoder = bpe.Encoder(packing.RANKS, packing.PATTERN)
    ids, ends = encoder.encode(*text_bytes(pa.array(own)))
    for t, a, b in zip(own, ends, ends[1:]):
        assert ids[a:b].tolist() == encoder.own.encode_ordinary(t)


def test_packing_matches_added_tokens(spark):
    from tokenizers import Tokenizer
    import public_tokenizers
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    own = ["a" + end + "b", end, end * 3, "x  " + end + " y\n" + end, end + "\n\n z", "no token", "",
           "<|endo", "ftext|> cut by a bound", "<|endoftext |>", "<" + end + ">", ("é 日 " + end) * 700]
    want = [tok.encode(t, add_special_tokens=False).ids for t in own]
    assert want[0] == [64, 50256, 65]
    encoder = bpe.Encoder(packing.RANKS, packing.PATTERN)
    ids, ends = packing.encode(encoder, *text_bytes(pa.array(own)), packing.added_tokens(packing.TOKENIZER))
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == want
    df = spark.createDataFrame(list(enumerate(own)), "doc_id long, text string")
    for r in packing.pieces(df).collect():
        part = [*want[r["doc_id"]], 1][r["start"]:r["start"] + r["length"]]
        assert (r["doc_tokens"], r["length"]) == (len(want[r["doc_id"]]) + 1, len(part))
        assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())


# --- 7 language

def test_gradients_match_differences():
    net = langid.fit(["aa bb", "cc dd"], ["x", "y"], rounds=1)
    for p in langid.parameters(net):
        p[...] = p.astype(np.float32)
    data, offsets = text_bytes(pa.array(["abcab", "ccd"]))
    start, doc = langid.windows_of(offsets, span=4)
    spans, mask = langid.spelled(data, start, offsets[doc + 1], span=4)
    label = np.array([0, 0, 1])
    _, grads = langid.gradients(net, spans, mask, label)
    rng = np.random.default_rng(0)
    for p, g in zip(langid.parameters(net), grads):
        big = np.argwhere(np.abs(g) > 1e-3)
        for at in map(tuple, big[rng.permutation(len(big))[:4]]):
            old = p[at]
            p[at] = old + 1e-2
            up, _ = langid.gradients(net, spans, mask, label)
            p[at] = old - 1e-2
            down, _ = langid.gradients(net, spans, mask, label)
            p[at] = old
            assert abs((up - down) / 2e-2 - g[at]) < 0.05 * abs(g[at]) + 2e-3


def test_language_of_held_out_documents(spark):
    import os
    path = "/root/testdata/sf0.001/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("no test data")
    documents = spark.read.parquet(path)
    got = {r["doc_id"]: r for r in langid.identify(spark, documents).collect()}
    rows = documents.filter("lang is not null").collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert all(got[r["doc_id"]]["held_out"] for r in held)
    right = sum(got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held)
    assert right >= 0.85 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_language_of_odd_tables(spark, empty, nulls):
    assert langid.identify(spark, empty).count() == 0
    got = [tuple(r)[2:] for r in langid.identify(spark, nulls.withColumn("lang", F.lit(None).cast("string"))).collect()]
    assert got == [("und", 0.0)] * 5
    got = langid.identify(spark, nulls.filter("text is null or doc_id is not null")).collect()
    assert sum(r["lang_pred"] == "und" for r in got) >= 2


# --- 8 near duplicates

def brute_components(rows: list[tuple[int, str | None]]) -> tuple[dict, dict]:
    sets = {}
    for i, t in rows:
        w = WORD.findall(lower(t or ""))
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                    a, b = find(i), find(j)
                    root[max(a, b)] = min(a, b)
    return {i: len(s) for i, s in sets.items()}, {i: find(i) for i in sets}


def test_near_duplicates_equal_brute_force(spark, docs, texts):
    rng = random.Random(9)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(300)]
    rows = list(texts)
    for k in range(40):  # a chain: each copy is near its neighbours, the ends are apart
        own = list(base)
        for p in range(k):
            own[(p * 7) % 300] = f"n{p}"
        rows.append((1000 + k * 3 % 100, " ".join(own)))
    rows = list(dict(rows).items())
    df = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string")
    size, comp = brute_components(rows)
    for r in neardup.near_duplicates(spark, df).collect():
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (
            size[r["doc_id"]], comp[r["doc_id"]], comp[r["doc_id"]] == r["doc_id"])


def test_block_links_find_what_the_star_misses(spark):
    rng = np.random.default_rng(1)
    sets = [sorted(rng.choice(10**6, 100, replace=False).tolist()) for _ in range(3)]
    rows = [(7, b, 3, 10 + i, 10 + i, sets[i // 2]) for i, b in enumerate([0, 1, 2, 2, 1, 0])]
    members = spark.createDataFrame(
        rows, "grp long, block int, blocks int, doc_id long, comp long, shingles array<long>")
    got = {(min(r), max(r)) for r in neardup.block_links(members, 85).collect()}
    assert got == {(10, 11), (12, 13), (14, 15)}


def test_a_group_of_unlinked_classes_finishes(spark):
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(-2**62, 2**62, 60)).tolist() for _ in range(4998)]
    sets += [[*sets[7][:57], 1, 2], [*sets[9][:30], *range(30)]]  # one is near, one is not
    rows = [(0, i % 10, 10, i, i, s) for i, s in enumerate(sets)]
    members = spark.createDataFrame(
        rows, "grp long, block int, blocks int, doc_id long, comp long, shingles array<long>")
    assert [tuple(r) for r in neardup.block_links(members, 85).collect()] == [(7, 4998)]


def test_signatures_within_the_distance_share_a_key():
    rng = np.random.default_rng(0)
    one = rng.integers(0, 65536, (300, neardup.SYMBOLS)).astype(np.uint64)
    two = one.copy()
    for row in two:
        row[rng.choice(neardup.SYMBOLS, neardup.DISTANCE, replace=False)] += np.uint64(1)
    met = [bool(set(a) & set(b)) for a, b in zip(neardup.chunk_keys(one), neardup.chunk_keys(two))]
    assert all(met)


def test_near_duplicates_of_odd_tables(spark, empty, nulls):
    assert neardup.near_duplicates(spark, empty).count() == 0
    got = neardup.near_duplicates(spark, nulls).collect()
    assert len(got) == 5 and sum(r["component_id"] is None for r in got) == 2


def test_word_hashes_of_thue_morse_words():
    """Words that a polynomial modulo a power of two cannot tell apart."""
    one = "a"
    while len(one) < 4096:
        one += one.translate(str.maketrans("ab", "ba"))
        other = one.translate(str.maketrans("ab", "ba"))
        data, offsets = text_bytes(pa.array([f"{one} {other}"]))
        assert len(set(word_hashes(data, *word_bounds(data, offsets)).tolist())) == 2


def test_documents_of_thue_morse_words_are_not_linked(spark):
    one = "ab"
    while len(one) < 2048:
        one += one.translate(str.maketrans("ab", "ba"))
    other = one.translate(str.maketrans("ab", "ba"))
    df = spark.createDataFrame([(1, one), (2, other), (3, f"{one} x y z w"), (4, f"{other} x y z w")],
                               "doc_id long, text string")
    assert all(r["kept"] for r in neardup.near_duplicates(spark, df).collect())


def test_packed_numbers_come_back():
    rng = np.random.default_rng(9)
    sizes = np.array([0, 3, 1, 0, 500, 0])
    for width in (1, 3, 4, 8):
        values = rng.integers(0, 1 << min(8 * width, 62), sizes.sum())
        got, back = ctw.unpack(ctw.pack(values, sizes, width), width)
        assert np.array_equal(got, values) and np.array_equal(back, sizes)
        got, _ = ctw.unpack(ctw.pack(values, sizes, width).slice(2, 3), width)
        assert np.array_equal(got, values[3:])


def test_word_hashes_tell_words_apart():
    words = list({f"w{i}" for i in range(20_000)} | {"a" * k for k in range(1, 300)} | {"q" * (3 << 20)})
    data, offsets = text_bytes(pa.array([" ".join(words), " ".join(reversed(words))]))
    starts, ends = word_bounds(data, offsets)
    hashes = word_hashes(data, starts, ends)
    n = len(words)
    assert len(set(hashes.tolist())) == n and hashes[:n].tolist() == hashes[n:].tolist()[::-1]


# --- 9 language model

def test_scores_equal_brute_force(spark, docs, texts):
    rows = texts + [(900, "the same row"), (900, "the same row")]
    df = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string")
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    tokens = [(i, [*WORD.findall(lower(t or "")), "\n"]) for i, t in rows]
    count = Counter(w for i, ws in tokens if not held[i] for w in ws)
    n, v = sum(count.values()), len(count)
    want = {i: (held[i], len(ws), sum(count[w] > 0 for w in ws), n,
                sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws)) for i, ws in tokens}
    got = ctw.score(spark, df, frequent=8).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[1:5] == want[r["doc_id"]][:4]
        assert abs(r["base_score"] - want[r["doc_id"]][4]) < 1e-6 * abs(want[r["doc_id"]][4])
        assert r["score"] < 0


def test_tree_predicts_as_the_weighted_probability():
    """A conditional is Pw(counts with one more symbol) / Pw(counts), depth 2."""
    rng = np.random.default_rng(3)
    own = ["".join(rng.choice(list("ab "), 20)) for _ in range(6)]
    symbols, bounds = ctw.streams(*text_bytes(pa.array(own)))
    codes = brute_ctw.gram_codes(symbols, bounds, 2)
    rows = []
    for d in range(3):
        g, n = np.unique(codes & ((1 << (8 * d + 8)) - 1), return_counts=True)
        rows.append((g, n.astype(float)))
    model = brute_ctw.make_model(rows)

    def kt(a: int, b: int) -> float:
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weigh(c: Counter, context: bytes, bit: int, prefix: int) -> float:
        sel = {k: m for k, m in c.items() if k[0].endswith(context) and k[1] >> (8 - bit) == prefix}
        ones = sum(m for k, m in sel.items() if k[1] >> (7 - bit) & 1)
        zeros = sum(sel.values()) - ones
        if len(context) == 2 or not sel:
            return kt(zeros, ones)
        kids = {k[0][-len(context) - 1:] for k in sel}
        return float(np.logaddexp(kt(zeros, ones), sum(weigh(c, k, bit, prefix) for k in kids)) - math.log(2))

    def total(c: Counter) -> float:
        return sum(weigh(c, b"", bit, p) for bit in range(8)
                   for p in {s >> (8 - bit) for _, s in c})

    seen = Counter((bytes([x >> 16 & 255, x >> 8 & 255]), x & 255) for x in codes.tolist())
    for context, symbol in ((b"ab", 97), (b"\n\n", 98), (b"b ", 32), (b"zz", 97), (b"za", 98)):
        more = seen + Counter([(context, symbol)])
        at = model.rows(np.frombuffer(context + bytes([symbol]), np.uint8), np.array([0, 3]))[2]
        assert abs(float(model.table[at, symbol]) - (total(more) - total(seen)) / math.log(10)) < 1e-5
    assert np.allclose((10.0 ** model.table).sum(axis=1), 1, atol=1e-5)


def test_scores_follow_the_tree_of_all_contexts(spark):
    """More contexts than a model of bounded size would hold; equal to one tree in memory."""
    rng = np.random.default_rng(7)
    letters = list("abcdefghijklmnopqrstuvwxyzé ")
    own = [(i, "".join(rng.choice(letters, 900))) for i in range(16)] + [(16, None), (17, "ab ab ab")]
    own += [(100 + i, own[i][1][:300] + " new ßtail") for i in range(16)]
    df = spark.createDataFrame(own, "doc_id long, text string").repartition(3)
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in own}
    assert any(held.values())
    train = ctw.streams(*text_bytes(pa.array([t for i, t in own if not held[i]], pa.string())))
    codes = brute_ctw.gram_codes(*train, ctw.DEPTH)
    rows = []
    for d in range(ctw.DEPTH + 1):
        g, n = np.unique(codes & ((1 << (8 * d + 8)) - 1), return_counts=True)
        rows.append((g, n.astype(float)))
    assert sum(len(np.unique(g >> 8)) for g, _ in rows[2:]) > 32768
    model = brute_ctw.make_model(rows)
    want = model.scores(*ctw.streams(*text_bytes(pa.array([t for _, t in own], pa.string()))))
    got = {r["doc_id"]: r["score"] for r in ctw.score(spark, df).collect()}
    assert len(got) == len(own)
    for (i, _), score in zip(own, want):
        assert abs(got[i] - score) < 1e-5 * abs(score)


def test_scores_of_odd_tables(spark, empty, nulls):
    assert ctw.score(spark, empty).count() == 0
    assert ctw.score(spark, nulls).count() == 5
    one = nulls.filter("doc_id = 1").withColumn("doc_id", F.lit(5).cast("long"))
    assert ctw.score(spark, one).count() == 1


# --- 10 quality

def test_quality_counts_equal_brute_force(docs, texts):
    got = {r["doc_id"]: r for r in quality.quality(docs).collect()}
    for i, t in texts:
        t = t or ""
        w = WORD.findall(t)
        windows = [tuple(w[k:k + 5]) for k in range(len(w) - 4)]
        many = Counter(windows)
        covered = {k + j for k, x in enumerate(windows) if many[x] > 1 for j in range(5)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)),
            len(covered)), t[:80]
        assert r["base_failed"] == (len(w) < 10 or 100 * len(covered) > 20 * len(w))
        assert r["kept"] == (not r["base_failed"] and not r["failed"])


def test_quality_plan_is_one_native_projection(docs, empty, nulls):
    plan = quality.quality(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert quality.quality(empty).count() == 0
    assert [r["kept"] for r in quality.quality(nulls).collect()] == [False] * 5
    assert quality.keep_good(docs).columns == docs.columns


def test_quality_foreign_characters_and_character_counts(spark):
    """Texts of the listed languages' characters are known; any other character is foreign."""
    texts = ["plain words", "été über ñandú — “so” …", "слово", "a\x00b\x7f", "smile 😀", "日本", "ł", "",
             "A!B #c\t$d\n!!", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["m"] for r in rows.select(
        "doc_id", quality.measures(F.col("text")).alias("m")).collect()}
    for i, text in enumerate(texts):
        text, c = text or "", got[i]["c"]
        assert c["foreign"] == any(ord(x) > 127 and x not in quality.KNOWN_MARKS for x in text), text
        assert c["word_chars"] == sum(x not in quality.SPACE for x in text)
        assert c["n_symbols"] == sum(x in quality.SYMBOLS for x in text)
        assert c["n_caps"] == sum("A" <= x <= "Z" for x in text)
        assert c["n_exclaims"] == text.count("!")

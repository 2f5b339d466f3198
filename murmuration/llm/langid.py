"""Language ID by a bidirectional gated recurrent network over bytes (operator 7).

Texts are read in windows of ``SPAN`` bytes.  In each, one recurrent layer runs
forward and one backward; a linear layer labels every byte, and the mean of the
label probabilities over all bytes of a text is its language distribution.  The
units are GRU cells whose squashing functions are ``x / (1 + |x|)`` (and half of
it plus a half for the gates), which numpy evaluates without calls to exp.

Training is in numpy, by backpropagation through time over the windows, on a
bounded sample: about ``SAMPLE`` labelled texts a language (of the ``LANGUAGES``
most frequent ones), chosen by a hash of id and text, each text once, and
``WINDOWS`` windows of each.  Only text and lang are learned from.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
without any labelled text everything is ``und``; texts of any length are read
whole; repeated rows are predicted alike; an empty table gives an empty result;
``predict`` reads doc_id and text only.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmuration.functions.shipping import ship_by_value
from murmuration.llm.common import slices, text_bytes

ship_by_value(__name__)

SPAN = 64
HIDDEN = 10
SAMPLE = 240   # labelled texts a language
LANGUAGES = 200
WINDOWS = 6    # windows of each
ROUNDS = 110
BATCH = 256
UNKNOWN = "und"
MIN_SCORE = 0.4


def squash(x: np.ndarray) -> np.ndarray:
    return x / (1.0 + np.abs(x))


@dataclass
class Layer:
    """One direction: byte table (256, 3H) with bias, recurrent weights (H, 3H); gates z, r, then n."""

    table: np.ndarray
    recur: np.ndarray


@dataclass
class Network:
    langs: list[str]
    forth: Layer
    back: Layer
    out: np.ndarray   # (2H, languages)
    bias: np.ndarray


def run_layer(layer: Layer, spans: np.ndarray, mask: np.ndarray, reverse: bool,
              keep: list | None = None) -> np.ndarray:
    """Hidden states (T, B, H) over windows ``spans`` (B, T); padding holds state 0."""
    size = layer.recur.shape[0]
    gates, inner = layer.recur[:, :2 * size], layer.recur[:, 2 * size:]
    rows, span = spans.shape
    states = np.empty((span, rows, size), np.float32)
    h = np.zeros((rows, size), np.float32)
    columns, shown = np.ascontiguousarray(spans.T), np.ascontiguousarray(mask.T)[:, :, None]
    for t in range(span - 1, -1, -1) if reverse else range(span):
        x = layer.table[columns[t]]
        g = x[:, :2 * size] + h @ gates
        g = squash(g)
        g *= 0.5
        g += 0.5
        z, r = g[:, :size], g[:, size:]
        a = x[:, 2 * size:] + (r * h) @ inner
        n = squash(a)
        if keep is not None:
            keep.append((t, h, g, a, n))
        h = n + z * (h - n)
        h *= shown[t]
        states[t] = h
    return states


def label_probabilities(net: Network, spans: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """(T, B, languages): the label distribution of every byte."""
    size = net.forth.recur.shape[0]
    logits = run_layer(net.forth, spans, mask, False) @ net.out[:size]
    logits += run_layer(net.back, spans, mask, True) @ net.out[size:]
    logits += net.bias
    logits -= logits.max(axis=2, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=2, keepdims=True)
    return logits


# --- training ----------------------------------------------------------------------

def _back_layer(layer: Layer, spans: np.ndarray, mask: np.ndarray, kept: list,
                d_states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of a layer's table and recurrent weights, through time."""
    size = layer.recur.shape[0]
    gates, inner = layer.recur[:, :2 * size], layer.recur[:, 2 * size:]
    d_table, d_recur = np.zeros_like(layer.table), np.zeros_like(layer.recur)
    d_h = np.zeros_like(kept[0][1])
    for t, h, g, a, n in reversed(kept):
        z, r = g[:, :size], g[:, size:]
        d_h = (d_h + d_states[t]) * mask[:, t, None]
        d_n = d_h * (1 - z)
        d_z = d_h * (h - n)
        d_a = d_n / np.square(1 + np.abs(a))
        d_rh = d_a @ inner.T
        d_gate = np.concatenate([d_z, d_rh * h], axis=1)
        # a gate is squash(u) / 2 + 1/2, and squash'(u) = (1 - |squash(u)|)^2
        d_u = d_gate * 0.5 * np.square(1 - np.abs(2 * g - 1))
        d_recur[:, :2 * size] += h.T @ d_u
        d_recur[:, 2 * size:] += (r * h).T @ d_a
        np.add.at(d_table, spans[:, t], np.concatenate([d_u, d_a], axis=1))
        d_h = d_h * z + d_rh * r + d_u @ gates.T
    return d_table, d_recur


def gradients(net: Network, spans: np.ndarray, mask: np.ndarray,
              label: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross entropy over all bytes, and its gradients in ``parameters`` order."""
    size = net.forth.recur.shape[0]
    kept: tuple[list, list] = ([], [])
    h = np.concatenate([run_layer(net.forth, spans, mask, False, kept[0]),
                        run_layer(net.back, spans, mask, True, kept[1])], axis=2)
    logits = h @ net.out + net.bias
    logits -= logits.max(axis=2, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=2, keepdims=True)
    shown = mask.T[:, :, None] / mask.sum()
    loss = -float((np.log(np.take_along_axis(p, label[None, :, None], 2) + 1e-9) * shown).sum())
    d = p
    np.put_along_axis(d, np.broadcast_to(label[None, :, None], (*p.shape[:2], 1)),
                      np.take_along_axis(p, label[None, :, None], 2) - 1, 2)
    d *= shown
    d_h = d @ net.out.T
    flat = d.reshape(-1, d.shape[2])
    out = [h.reshape(-1, 2 * size).T @ flat, flat.sum(axis=0)]
    for layer, own, part in ((net.forth, kept[0], d_h[:, :, :size]), (net.back, kept[1], d_h[:, :, size:])):
        out += _back_layer(layer, spans, mask, own, part)
    return loss, out


def parameters(net: Network) -> list[np.ndarray]:
    return [net.out, net.bias, net.forth.table, net.forth.recur, net.back.table, net.back.recur]


def network(langs: list[str], values: list[np.ndarray]) -> Network:
    """The network of ``parameters``."""
    out, bias, *layers = values
    return Network(langs, Layer(*layers[:2]), Layer(*layers[2:]), out, bias)


def windows_of(offsets: np.ndarray, span: int = SPAN) -> tuple[np.ndarray, np.ndarray]:
    """Start and text of every window of all texts."""
    size = np.diff(offsets)
    count = -(-size // span)
    doc = np.repeat(np.arange(len(size)), count)
    return (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * span + offsets[doc], doc


def spelled(data: np.ndarray, start: np.ndarray, stop: np.ndarray,
            span: int = SPAN) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and mask of windows that begin at ``start``, of texts that end at ``stop``."""
    at = start[:, None] + np.arange(span)
    mask = at < stop[:, None]
    return data[np.minimum(at, len(data) - 1)] * mask, mask.astype(np.float32)


def fit(texts: list[str], langs: list[str], rounds: int = ROUNDS, seed: int = 7) -> Network:
    """Train on windows of the given texts; the languages weigh the same."""
    names = sorted(set(langs))
    rng = np.random.default_rng(seed)
    size, k = HIDDEN, len(names)

    def layer() -> Layer:
        return Layer(rng.normal(0, 0.4, (256, 3 * size)).astype(np.float32),
                     rng.normal(0, 0.4, (size, 3 * size)).astype(np.float32))

    net = Network(names, layer(), layer(), rng.normal(0, 0.3, (2 * size, k)).astype(np.float32),
                  np.zeros(k, np.float32))
    data, offsets = text_bytes(pa.array(texts, pa.large_string()))
    # some windows of each text, before any is spelled out
    own_label = {x: i for i, x in enumerate(names)}
    start, label, stop = [], [], []
    for i, lang in enumerate(langs):
        count = -(-int(offsets[i + 1] - offsets[i]) // SPAN)
        some = rng.permutation(count)[:WINDOWS] if count <= 4096 else np.unique(rng.integers(0, count, WINDOWS))
        start += (offsets[i] + some * SPAN).tolist()
        stop += [int(offsets[i + 1])] * len(some)
        label += [own_label[lang]] * len(some)
    label = np.array(label)
    spans, mask = spelled(data, np.array(start), np.array(stop))
    chosen = [np.flatnonzero(label == k) for k in range(len(names))]
    own = parameters(net)
    first, second = [np.zeros_like(p) for p in own], [np.zeros_like(p) for p in own]
    for step in range(1, rounds + 1):
        take = np.concatenate([rng.choice(c, max(1, BATCH // k)) for c in chosen if len(c)])
        _, grads = gradients(net, spans[take], mask[take], label[take])
        rate = 0.03 * min(1.0, 2 * (1 - step / (rounds + 1)))
        for p, g, m, v in zip(own, grads, first, second):  # Adam
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= (rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return net


def held_out(doc_id: Column, mod: int = 3, rest: int = 1) -> Column:
    key = F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")
    return F.crc32(key) % mod == rest


def train(documents: DataFrame, sample: int = SAMPLE) -> Network | None:
    """Fit on about ``sample`` texts of each language that are not held out."""
    usable = documents.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}") & ~held_out(F.col("doc_id")))
    sizes = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc("n"), "lang").limit(LANGUAGES)
    share = F.least(F.lit(1.0), F.lit(float(sample)) / F.col("n"))
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit(11)), F.lit(1_000_000_007)) / F.lit(1_000_000_007.0)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in b.to_pylist()]
        rows.sort(key=lambda r: (r["lang"], r["text"]))
        if rows:
            net = fit([r["text"] for r in rows], [r["lang"] for r in rows])
            plain = pickle.dumps((net.langs, parameters(net)))
            yield pa.RecordBatch.from_arrays([pa.array([plain], pa.binary())], names=["net"])

    # the sample is bounded, so one task learns from it; the network is a few KB
    chosen = usable.join(F.broadcast(sizes), "lang").filter(draw < share).select("lang", "text").distinct()
    learned = chosen.repartition(1).mapInArrow(learn, "net binary").first()
    return None if learned is None else network(*pickle.loads(learned["net"]))


# --- prediction ----------------------------------------------------------------------

def pooled(net: Network, data: np.ndarray, offsets: np.ndarray, block: int = 2048) -> np.ndarray:
    """(texts, languages): the mean label distribution over each text's bytes."""
    total = np.zeros((len(offsets) - 1, len(net.langs)))
    start, doc = windows_of(offsets)
    for at in range(0, len(doc), block):  # windows are spelled out block by block
        part = slice(at, at + block)
        spans, mask = spelled(data, start[part], offsets[doc[part] + 1])
        p = label_probabilities(net, spans, mask)
        p *= mask.T[:, :, None]
        sums = p.sum(axis=0)
        for k in range(len(net.langs)):
            total[:, k] += np.bincount(doc[part], weights=sums[:, k], minlength=len(total))
    return total / np.maximum(np.diff(offsets), 1)[:, None]


def with_language(spark: SparkSession, documents: DataFrame, net: Network | None) -> DataFrame:
    """Every row of ``documents`` as a struct ``row``, so that its columns may have
    any names, with a struct ``_lang``: lang_pred, score."""
    shared = spark.sparkContext.broadcast(None if net is None else (net.langs, parameters(net)))

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts):  # noqa: ANN001, ANN202  pandas series in, frame out
        import pandas as pd
        net = network(*shared.value)
        texts = pa.array(texts, pa.large_string())
        names, scores = [], []
        for batch in slices([pa.RecordBatch.from_arrays([texts], ["t"])], "t", 2 << 20):
            p = pooled(net, *text_bytes(batch.column(0)))
            best = p.argmax(axis=1)
            names += [net.langs[i] for i in best]
            scores.append(p[np.arange(len(p)), best])
        flat = np.minimum(np.concatenate(scores), 1.0) if scores else []
        return pd.DataFrame({"lang_pred": names, "score": flat})

    readable = F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False))
    unknown = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    row = F.struct("*").alias("row")
    if net is None:
        return documents.select(row, unknown.alias("_lang"))
    return documents.select(
        row, readable.alias("_readable"), F.when(readable, F.col("text")).otherwise(F.lit("")).alias("_seen")
    ).select("row", "_readable", predict("_seen").alias("_guess")).select(
        "row", F.when(F.col("_readable"), F.col("_guess")).otherwise(unknown).alias("_lang"))


def identify(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    rows = documents.select("doc_id", "text")
    return with_language(spark, rows, train(documents)).select(
        "row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "_lang.*")


def keep_identified(spark: SparkSession, documents: DataFrame,
                    min_score: float = MIN_SCORE) -> DataFrame:
    """The documents whose language is found with ``min_score`` or more."""
    return with_language(spark, documents, train(documents)).filter(
        (F.col("_lang.lang_pred") != UNKNOWN) & (F.col("_lang.score") >= min_score)).select("row.*")

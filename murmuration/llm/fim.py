"""Fill-in-the-middle documents by a pyarrow.compute pipeline (operator 13).

A batch's texts are split into lists of units (lines with their line feed); the
lists are flattened beside each unit's parent row, units get their ordinals, and
a unit's role (prefix, middle or suffix) follows from its ordinal and its row's
two cuts.  The units of a role are filtered out, put back into lists and joined;
the pieces and the sentinels are joined for each form.

``restore`` takes an output and its form apart again with Spark's own functions.

Defined results: a null text is empty; an empty text, or one that holds a
sentinel, stays as it is (``plain``); a null doc_id is hashed as ''; repeated
rows are cut alike; an empty table gives an empty result; other columns of the
input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmuration.functions.shipping import ship_by_value
from murmuration.llm.common import slices

ship_by_value(__name__)

SEED = 7
RATE = 100       # percent of the documents that are transformed
SPM_SHARE = 50   # percent of those, with the suffix first
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

SCHEMA = ("doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def draws(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four 32-bit draws of a document, from its id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
                    .cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}")
            for k in range(4)]


def _check(sentinels: tuple[str, str, str]) -> None:
    """A sentinel may not begin inside another: then pieces free of sentinels
    hold none where they meet one either, and the first match is the true one."""
    met = any(a[k:].startswith(b) or b.startswith(a[k:]) for a in sentinels for b in sentinels
              for k in range(0 if a != b else 1, len(a)))
    if met or "" in sentinels or len(set(sentinels)) < 3:
        raise ValueError("sentinels must be distinct and may not overlap")


def transform(documents: DataFrame, seed: int = SEED, rate: int = RATE,
              spm_share: int = SPM_SHARE, prefix: str = PREFIX, suffix: str = SUFFIX,
              middle: str = MIDDLE) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output of every document."""
    _check((prefix, suffix, middle))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 8 << 20):
            rows = batch.num_rows
            text = pc.fill_null(batch.column(1), "")
            h1, h2, h3, h4 = (batch.column(k) for k in range(2, 6))

            # units: what line feeds part, each with its own line feed
            lines = pc.split_pattern(text, "\n")
            part, parent = pc.list_flatten(lines), pc.list_parent_indices(lines).to_numpy()
            size = pc.list_value_length(lines).to_numpy()
            ordinal = np.arange(len(part)) - (np.cumsum(size) - size)[parent]
            closing = ordinal == size[parent] - 1  # no line feed follows the last one
            feed = pc.if_else(pa.array(closing), "", "\n")
            unit = pc.binary_join_element_wise(part, feed, "")
            real = ~closing | pc.not_equal(part, "").to_numpy(zero_copy_only=False)
            n = np.bincount(parent[real], minlength=rows)

            a, b = (h.to_numpy() % (n + 1) for h in (h1, h2))
            low, high = np.minimum(a, b)[parent], np.maximum(a, b)[parent]
            role = (ordinal >= low).astype(np.int8) + (ordinal >= high)

            def joined(wanted: int) -> pa.Array:
                keep = real & (role == wanted)
                ends = np.concatenate([[0], np.cumsum(np.bincount(parent[keep], minlength=rows))])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), unit.filter(pa.array(keep)))
                return pc.binary_join(lists, "")

            first, inner, rest = joined(0), joined(1), joined(2)
            held = pc.equal(text, "")
            for sentinel in (prefix, suffix, middle):
                held = pc.or_(held, pc.match_substring(text, sentinel))
            plain = pc.or_(held, pa.array(h3.to_numpy() % 100 >= rate))
            spm = pa.array(h4.to_numpy() % 100 < spm_share)
            form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))
            output = pc.if_else(plain, text, pc.if_else(
                spm, pc.binary_join_element_wise(suffix, rest, prefix, first, middle, inner, ""),
                pc.binary_join_element_wise(prefix, first, suffix, rest, middle, inner, "")))
            none = pa.scalar(None, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n.astype(np.int64)), form,
                 pc.if_else(plain, none, pc.utf8_length(first).cast(pa.int64())),
                 pc.if_else(plain, none, pc.utf8_length(inner).cast(pa.int64())),
                 output],
                names=[f.split()[0] for f in SCHEMA.split(", ")])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                            *draws(F.col("doc_id"), seed))
    return rows.mapInArrow(run, SCHEMA)


def restore(output: Column, form: Column, prefix: str = PREFIX, suffix: str = SUFFIX,
            middle: str = MIDDLE) -> Column:
    """The text of an output, from the output and its form alone."""
    def between(start: str, end: str | None) -> Column:
        after = F.substring(output, F.locate(start, output) + F.lit(len(start)), F.length(output))
        return F.substring_index(after, end, 1) if end else after

    def locate_all() -> tuple[Column, Column]:
        psm = F.concat(between(prefix, suffix), between(middle, None), between(suffix, middle))
        spm = F.concat(between(prefix, middle), between(middle, None), between(suffix, prefix))
        return psm, spm

    psm, spm = locate_all()
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)

"""Chat formatting by token-level assembly (operator 3).

A turn is assembled from segments that are encoded apart: start id, role, line
feed, text, end id, line feed.  The two reserved ids are spliced, never encoded,
so no text can produce them; control strings inside a role or text are escaped
as well, reversibly, so the decoded string parses back.  The loss mask of a turn
is the prefix sum of +1 / -1 marks at the ends of an assistant's text.

Turns are formatted row by row, so a very long conversation is spread over
tasks; ``digests`` then reads the turns back in order, one row at a time.

Defined results: a null text or role is empty; turns of a conversation are
ordered by turn (null first), then role, then text, repeated rows kept; rows
with a null conv_id form one conversation; an empty table gives an empty
result; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmuration.functions.shipping import ship_by_value
from murmuration.llm.bpe import Encoder
from murmuration.llm.common import slices, text_bytes

ship_by_value(__name__)

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
START, END = "<|im_start|>", "<|im_end|>"
START_ID, END_ID = 50257, 50258  # beyond the vocabulary

TURN_SCHEMA = ("conv_id long, turn long, role string, text string, "
               "input_ids array<int>, loss_mask array<boolean>")
DIGEST_SCHEMA = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                 "loss_sha256 string, formatted_chars long, n_tokens long")


def escape(text: str) -> str:
    """``<|`` (and ``<\\|``, ``<\\\\|`` ...) get one more backslash, so none is a control string."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    """A role also must not hold the line feed that ends it."""
    return escape(role).replace("%", "%25").replace("\n", "%0A")


def unescape_role(role: str) -> str:
    return unescape(role.replace("%0A", "\n").replace("%25", "%"))


def assemble(encoder: Encoder, roles: list[str], texts: list[str],
             learn: list[bool]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, loss mask and the n+1 offsets of n turns."""
    segments = [s for r, t in zip(roles, texts) for s in (escape_role(r), escape(t))]
    ids, ends = encoder.encode(*text_bytes(pa.array(segments, pa.large_string())))
    n = len(roles)
    size = np.diff(ends)
    # per turn: START role LF text END LF
    lengths = np.stack([np.ones(n, np.int64), size[0::2], np.ones(n, np.int64), size[1::2],
                        np.ones(n, np.int64), np.ones(n, np.int64)], axis=1)
    at = np.concatenate([[0], np.cumsum(lengths.ravel())])
    first = at[:-1].reshape(n, 6)
    out = np.empty(at[-1], np.int32)
    out[first[:, 0]], out[first[:, 4]] = START_ID, END_ID
    out[first[:, 2]] = out[first[:, 5]] = encoder.newline
    spliced = np.ones(at[-1], bool)
    spliced[np.concatenate([first[:, 0], first[:, 2], first[:, 4], first[:, 5]])] = False
    out[spliced] = ids
    marks = np.zeros(at[-1] + 1, np.int64)
    wanted = np.asarray(learn, bool)
    np.add.at(marks, first[wanted, 3], 1)
    np.add.at(marks, first[wanted, 4], -1)
    return out, np.cumsum(marks[:-1]) > 0, np.concatenate([[0], at[6::6]])


def read_back(encoder: Encoder, ids: np.ndarray) -> str:
    """The formatted string of token ids, reserved ids as their control strings."""
    out, at = [], 0
    for p in np.flatnonzero(ids >= START_ID):
        out += [encoder.decode(ids[at:p]), START if ids[p] == START_ID else END]
        at = p + 1
    return "".join([*out, encoder.decode(ids[at:])])


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted string."""
    turns = re.findall(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", formatted, re.S)
    return [(unescape_role(r), unescape(t)) for r, t in turns]


def format_turns(conversations: DataFrame, ranks: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """Token ids and loss mask of every turn (assistant texts carry loss)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks, pattern)
        for batch in slices(batches, "text", 2 << 20):
            roles, texts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            ids, mask, ends = assemble(encoder, roles, texts, [r == "assistant" for r in roles])
            ends = pa.array(ends.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(ends, pa.array(ids)),
                 pa.ListArray.from_arrays(ends, pa.array(mask))],
                names=["conv_id", "turn", "role", "text", "input_ids", "loss_mask"])

    rows = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, TURN_SCHEMA)


def digests(turns: DataFrame, ranks: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """One row per conversation, read back from the ids and masks alone.

    Turns stream in order through running hashes, so memory does not grow
    with a conversation.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks, pattern)
        names = [f.split()[0] for f in DIGEST_SCHEMA.split(", ")]
        state: list | None = None
        done: list[tuple] = []

        def close() -> None:
            if state:
                conv, n, turns_sha, chars, loss_sha, formatted, tokens = state
                done.append((conv, n, turns_sha.hexdigest(), chars, loss_sha.hexdigest(),
                             formatted, tokens))

        def flush() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            columns = zip(*done) if done else [[]] * 7
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)
            done.clear()
            return out

        for batch in batches:
            for conv, ids, mask in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                if state is None or state[0] != conv:
                    close()
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                ids = ids.values.to_numpy()
                mask = mask.values.to_numpy(zero_copy_only=False)
                formatted = read_back(encoder, ids)
                for role, text in parse(formatted):
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                learned = unescape(encoder.decode(ids[mask]))
                state[3] += len(learned)
                state[4].update(learned.encode())
                state[5] += len(formatted)
                state[6] += len(ids)
            if len(done) >= 1000:
                yield flush()
        close()
        yield flush()

    ordered = (turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
               .select("conv_id", "input_ids", "loss_mask"))
    return ordered.mapInArrow(run, DIGEST_SCHEMA)

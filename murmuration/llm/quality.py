"""Quality rules (operator 10): a threshold table compiled into one projection.

Every measure is a native column expression over the whole text, so a document
is judged inside its scan task: no shuffle and no user function.  ``RULES`` is
the table; ``judge`` compiles it.

Defined results: a null or empty text has no words, measures 0 and fails the
base rule; very long texts take O(n log n) steps; repeated rows are judged row
by row; an empty table gives an empty result; columns of the input that share a
name with a measure are not touched (``judge`` returns a struct column).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"

# Common short words of English, French, German and Spanish, and a
# few each of Italian, Indonesian, Swahili, Tagalog and Finnish.
STOP_WORDS = (
    "a an and are as at be by for from in is it of on or that the this to was with "
    "au avec ce dans de des du elle en est et il la le les ne par pas pour que qui sur un une "
    "als auf aus das dem den der die ein eine einen für ich im ist mit nicht sich sie und von zu "
    "con del el es esta la las los no o para por se su sus una y "
    "che di non yang dan ini itu untuk na ya wa kwa ang ng sa mga ja ei on"
).split()

#: Letters and marks beside ASCII that texts of those languages hold; a text with
#: another character is of a language whose short words are not listed.
KNOWN_MARKS = "ÄÖÜäöüßÀÂÇÉÈÊËÎÏÔÛÙàâçéèêëîïôûùœæŒÆÁÍÓÚÑáíóúñ¿¡«»“”„‘’…–—·°§€£©®™\u00a0\u00ad"
KNOWN = "".join(map(chr, range(128))) + KNOWN_MARKS


@dataclass(frozen=True)
class Rule:
    """``low <= over / under <= high``, asked of texts with ``from_words`` words or more.

    Bounds are per mille, so both sides of a comparison are whole numbers.
    """

    name: str
    over: str
    under: str
    low: int | None = None
    high: int | None = None
    from_words: int = 0
    known_only: bool = False  # not asked of texts with a character outside KNOWN


RULES = (
    Rule("word_length", "word_chars", "n_words", low=1_500, high=20_000),
    Rule("symbols", "n_symbols", "word_chars", high=40),
    Rule("shouting", "n_caps", "word_chars", high=300, from_words=20),
    Rule("exclamation", "n_exclaims", "n_words", high=500),
    Rule("dup_lines", "n_dup_lines", "n_lines", high=400),
    Rule("stop_words", "n_stop", "n_words", low=10, from_words=60, known_only=True),
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once (a lambda variable is not re-evaluated)."""
    return F.transform(F.array(value), body)[0]


def _without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def _repeated(words: Column) -> Column:
    """Words inside five-word windows that occur twice or more in the text."""
    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(
            hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twice(p: Column) -> Column:
            kept = F.filter(p, lambda x, k: F.coalesce(
                (F.get(p, k + 1)["h"] == x["h"]) | F.lit(False), F.lit(False)) | F.coalesce(
                (k > 0) & (F.get(p, k - 1)["h"] == x["h"]), F.lit(False)))
            at = F.sort_array(F.transform(kept, lambda x: x["i"].cast("long")))
            start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-5).cast("long").alias("end"))
            return F.aggregate(at, start, lambda acc, i: F.struct(
                (acc["n"] + F.least(F.lit(5).cast("long"), i + 5 - acc["end"])).alias("n"),
                (i + 5).alias("end")))["n"]

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes),
                      F.lit(0).cast("long")).otherwise(let(pairs, twice))

    def windows(own: Column) -> Column:  # a word is hashed once, a window from five hashes
        return F.transform(F.sequence(F.lit(0), F.size(own) - 5),
                           lambda i: F.xxhash64(*[F.get(own, i + k) for k in range(5)]))

    return F.when(F.size(words) < 5, F.lit(0).cast("long")).otherwise(
        let(let(F.transform(words, lambda w: F.xxhash64(w)), windows), covered))


def measures(text: Column) -> Column:
    """A struct of whole counts of one text."""
    text = F.coalesce(text, F.lit(""))
    # translate is plain character work; regular expressions are kept for splitting
    lines = F.filter(F.split(text, "\n"), lambda x: F.ltrim(x, F.lit(SPACE)) != "")
    words = F.filter(F.split(text, "[ \\x09-\\x0D]+"), lambda w: w != "")
    word_part = let(words, lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        _repeated(w).alias("n_repeat_words"),
        F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))).cast("long").alias("n_stop")))
    line_part = let(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"),
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    def char_part(rest: Column) -> Column:
        size = F.length(rest)
        return F.struct(
            (F.length(text) - size + _without(rest, SPACE)).cast("long").alias("word_chars"),
            (size - _without(rest, SYMBOLS)).cast("long").alias("n_symbols"),
            (size - _without(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")).cast("long").alias("n_caps"),
            (size - _without(rest, "!")).cast("long").alias("n_exclaims"),
            (_without(rest, KNOWN) > 0).alias("foreign"))

    # small letters, most of a text, are taken out once
    return F.struct(word_part.alias("w"), line_part.alias("l"),
                    let(F.translate(text, "abcdefghijklmnopqrstuvwxyz", ""), char_part).alias("c"))


def _passes(rule: Rule, m: dict[str, Column]) -> Column:
    ok = F.lit(True)
    if rule.low is not None:
        ok = ok & (m[rule.over] * 1000 >= m[rule.under] * rule.low)
    if rule.high is not None:
        ok = ok & (m[rule.over] * 1000 <= m[rule.under] * rule.high)
    ok = ok | (m["n_words"] < rule.from_words) if rule.from_words else ok
    return ok | m["foreign"] if rule.known_only else ok


def _counts(m: Column) -> dict[str, Column]:
    return {"n_words": m["w"]["n_words"], "word_chars": m["c"]["word_chars"],
            "n_symbols": m["c"]["n_symbols"], "n_dup_lines": m["l"]["n_dup_lines"],
            "n_repeat_words": m["w"]["n_repeat_words"], "n_lines": m["l"]["n_lines"],
            "n_stop": m["w"]["n_stop"], "n_caps": m["c"]["n_caps"], "n_exclaims": m["c"]["n_exclaims"]}


def judge(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Struct: the counts, ``base_failed``, ``failed`` (names of the rules broken), ``kept``."""
    def verdict(m: Column) -> Column:
        c = _counts(m)
        base = (c["n_words"] < 10) | (c["n_repeat_words"] * 100 > c["n_words"] * 20)
        broken = F.filter(F.array(*[F.when(~_passes(r, {**c, "foreign": m["c"]["foreign"]}), F.lit(r.name)) for r in rules]),
                          lambda x: x.isNotNull())
        return let(broken, lambda b: F.struct(
            *[v.alias(k) for k, v in c.items()], base.alias("base_failed"), b.alias("failed"),
            (~base & (F.size(b) == 0)).alias("kept")))

    return let(measures(text), verdict)


def quality(documents: DataFrame) -> DataFrame:
    """One row per document with its counts and verdict."""
    return documents.select("doc_id", judge(F.col("text")).alias("_q")).select("doc_id", "_q.*")


def keep_good(documents: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns."""
    return documents.filter(judge(F.col("text"))["kept"])

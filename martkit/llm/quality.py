"""Quality rules by repetition coverage (operator 7).

Words are hashed once per text; the hash of every n-gram is rolled up from the
one of n-1 in numpy (``h_n[i] = h_(n-1)[i] * B + w[i+n-1]`` modulo 2**64), so
all lengths cost one multiply-add each.  An n-gram hash found twice marks the
words of its later copies; the share of word characters under the marks, the
share held by the most frequent short n-gram and the share of repeated lines
are compared with fixed limits.

Everything is per text: no shuffle, memory in proportion to one text.

Defined cases: null or empty text has no words and is rejected (too few words);
null ids are kept as null; repeated rows are measured each; other columns never
reach Python.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from martkit.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
ROLL = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Rules:
    """Limits of the verdict.  Published limits for web text: shares of
    characters inside repeated n-grams and lines."""

    min_words: int = 20
    window: int = 8
    max_window_words: float = 0.30
    # longest allowed share of characters held by the most frequent n-gram
    top_gram: tuple = ((2, 0.20), (3, 0.18), (4, 0.16))
    # longest allowed share of characters inside later copies of an n-gram
    dup_gram: tuple = ((5, 0.15), (6, 0.14), (7, 0.13), (8, 0.12), (9, 0.11), (10, 0.10))
    max_dup_line_share: float = 0.30
    # with fewer lines than this, one short repeated line is no sign of junk
    dup_line_min_lines: int = 8
    max_dup_line_chars: float = 0.20
    max_symbols_per_word: float = 0.20
    # share of words in capitals, of at least two letters
    max_capital_words: float = 0.50
    # texts of fewer words than this are too short for the top-gram shares
    top_gram_min_words: int = 40


def _covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Words under the n-word windows that begin at the marked starts."""
    marks = np.zeros(size, dtype=bool)
    for shift in range(n):
        marks[shift : shift + len(starts)] |= starts
    return marks


def _classes(hashes: np.ndarray):
    """(copies of each position's value, whether an equal value stands earlier)."""
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    new = np.r_[True, ranked[1:] != ranked[:-1]]
    counts = np.diff(np.r_[np.flatnonzero(new), len(ranked)])
    copies = np.empty(len(ranked), dtype=np.int64)
    later = np.empty(len(ranked), dtype=bool)
    copies[order] = counts[np.cumsum(new) - 1]
    later[order] = ~new
    return copies, later


def measure_text(text: str | None, rules: Rules) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    n_words = len(words)
    n_symbols = sum(map(text.count, SYMBOLS))
    seen: set[str] = set()
    n_dup_lines = dup_line_chars = n_lines = 0
    for line in text.split("\n"):
        if not WORD.search(line):
            continue
        n_lines += 1
        if line in seen:
            n_dup_lines += 1
            dup_line_chars += len(line)
        else:
            seen.add(line)
    lengths = np.fromiter(map(len, words), np.int64, n_words)
    word_chars = int(lengths.sum())
    n_repeat = 0
    shares = {}
    top_shares = {}
    if n_words:
        rolled = w = np.fromiter(map(hash, words), np.int64, n_words).view(np.uint64)
        before = np.r_[0, np.cumsum(lengths)]
        tops, dups = dict(rules.top_gram), dict(rules.dup_gram)
        for n in range(2, max([*tops, *dups, rules.window]) + 1):
            if n > n_words:
                break
            rolled = rolled[:-1] * ROLL + w[n - 1 :]
            if n not in tops and n not in dups and n != rules.window:
                continue
            copies, later = _classes(rolled)
            if not later.any():  # then no longer n-gram repeats either
                break
            if n in tops:
                chars = before[n:] - before[:-n]
                top_shares[n] = float((copies * chars * (copies > 1)).max() / word_chars)
            if n in dups:
                shares[n] = float(lengths[_covered(later, n, n_words)].sum() / word_chars)
            if n == rules.window:
                n_repeat = int(_covered(copies > 1, n, n_words).sum())
    base_failed = n_words < rules.min_words or n_repeat > rules.max_window_words * n_words
    capitals = sum(len(x) > 1 and x.isupper() for x in words)
    kept = not (
        base_failed
        or any(shares.get(n, 0) > most for n, most in rules.dup_gram)
        or (
            n_words >= rules.top_gram_min_words
            and any(top_shares.get(n, 0) > most for n, most in rules.top_gram)
        )
        or (n_lines >= rules.dup_line_min_lines and n_dup_lines > rules.max_dup_line_share * n_lines)
        or dup_line_chars > rules.max_dup_line_chars * max(1, len(text))
        or n_symbols > rules.max_symbols_per_word * n_words
        or capitals > rules.max_capital_words * n_words
    )
    return (
        n_words, word_chars, n_symbols, n_dup_lines, n_repeat,
        max(shares.values(), default=0.0), base_failed, kept,
    )


MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "dup_gram_share double, base_failed boolean, kept boolean"
)
ARROW_TYPES = [pa.int64()] * 5 + [pa.float64(), pa.bool_(), pa.bool_()]
FIELDS = [part.split()[0] for part in MEASURES.split(", ")]


def quality_measures(text: Column, rules: Rules | None = None) -> Column:
    """Struct column of the measures and the verdict ``kept`` of a text."""
    limits = rules or Rules()

    @arrow_udf(MEASURES)
    def measure(texts: pa.Array) -> pa.Array:
        columns = zip(*(measure_text(t, limits) for t in texts.to_pylist()), strict=True)
        values = list(columns) or [()] * len(FIELDS)
        return pa.StructArray.from_arrays(
            [pa.array(v, t) for v, t in zip(values, ARROW_TYPES, strict=True)], FIELDS
        )

    return measure(text)


def quality_report(docs: DataFrame, text: str = "text", key: str = "doc_id", rules: Rules | None = None) -> DataFrame:
    """One row per document: its key, the measures and the verdict."""
    return docs.select(F.col(key), quality_measures(F.col(text), rules).alias("m")).select(key, "m.*")


def quality_filter(docs: DataFrame, text: str = "text", rules: Rules | None = None) -> DataFrame:
    """The documents that pass, with all their columns."""
    return docs.where(quality_measures(F.col(text), rules)["kept"])


def q_op7(spark, sf_dir):
    return quality_report(table(spark, sf_dir, "documents"))


QUERIES = {"op7_quality_rules": q_op7}
ORACLE_SQL: dict[str, str] = {}

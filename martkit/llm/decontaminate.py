"""Benchmark decontamination (operator 5).

One Aho-Corasick automaton over the word windows of the normalised benchmark
items, run once over each document's words.  Words are mapped to integers by
the benchmark's own vocabulary (other words share one integer no window holds),
so the automaton's alphabet are words and a match is always whole words; word
numbers are mapped back to character offsets of the original text.

The automaton is broadcast only while the benchmark is within ``block_bytes``;
a larger one is cut into blocks of items under that size, and the documents
are scanned once per block with the spans written out in between.  No shuffle
of documents, memory in proportion to one block and one batch.

Defined cases: null or empty texts have no words; an item of fewer words than
a window is one window, one without words none; equal windows of several items
count for each; repeated rows are scanned each; null ids stay null; an empty
benchmark hits nothing; other columns of the documents, whatever their
names, are not touched (``benchmark_matches`` replaces one named as ``into``).
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from martkit.llm.common import alnum_words, byte_values, fresh_name, stage, table

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
BLOCK_BYTES = 32 * 1024 * 1024
SPANS = "array<struct<first:long,last:long>>"
MATCHES = f"n_words long, spans {SPANS}, items array<string>"
_AUTOMATA: dict = {}


class WindowAutomaton:
    """Aho-Corasick over word numbers.  ``items`` are (id as text, text bytes)."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        import ahocorasick

        self.numbers: dict[bytes, int] = {}
        owners: dict[tuple, list[str]] = {}
        for item, raw in items:
            words = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in alnum_words(raw)]
            for at in range(max(1, len(words) - window + 1) if words else 0):
                held = owners.setdefault(tuple(words[at : at + window]), [])
                if not held or held[-1] != item:
                    held.append(item)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for words, ids in owners.items():
            self.automaton.add_word(words, (len(words), ids))
        self.any = bool(owners)
        if self.any:
            self.automaton.make_automaton()

    def scan(self, raw: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
        """(number of words, merged spans of hit words, items found)."""
        words = alnum_words(raw)
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        if not self.any or not words:
            return len(words), spans, found
        get = self.numbers.get
        coded = tuple([get(w, 0) for w in words])
        for last, (length, ids) in self.automaton.iter(coded):
            found.update(ids)
            spans.append((last - length + 1, last))
        return len(words), merged(spans), found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint spans that cover the same words, adjacent ones joined."""
    out: list[list[int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return [(a, b) for a, b in out]


def _automaton(token: str, items: list, window: int) -> WindowAutomaton:
    if token not in _AUTOMATA:
        _AUTOMATA.clear()
        _AUTOMATA[token] = WindowAutomaton(items, window)
    return _AUTOMATA[token]


def _blocks(items: DataFrame, item_id: str, text: str, block_bytes: int):
    """Items as lists of about half of ``block_bytes``, one block on the driver at a
    time.  The hash of an item sets its block, so only a sum reaches the driver before."""
    sized = items.select(
        F.col(item_id).cast("string").alias("item"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    size = sized.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = max(1, -(-size // (block_bytes // 2)))
    if n == 1:
        yield [(r.item, r.text.encode()) for r in sized.collect()]
        return
    placed = stage(sized.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(n))), "blocks")
    for block in range(n):
        yield [(r.item, r.text.encode()) for r in placed.where(F.col("block") == block).drop("block").collect()]


def _matcher(items: list, window: int):
    token = hashlib.sha256(repr((window, items)).encode()).hexdigest()
    spark_items = items

    @arrow_udf(MATCHES)
    def match(texts: pa.Array) -> pa.Array:
        automaton = _automaton(token, spark_items, window)
        counts, spans, found = [], [], []
        for raw in byte_values(texts):
            n, places, ids = automaton.scan(raw)
            counts.append(n)
            spans.append([{"first": a, "last": b} for a, b in places])
            found.append(sorted(ids))
        return pa.StructArray.from_arrays(
            [
                pa.array(counts, pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
                pa.array(found, pa.list_(pa.string())),
            ],
            ["n_words", "spans", "items"],
        )

    return match


def _union_spans(a: pa.Array, b: pa.Array) -> pa.Array:
    rows = []
    for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True):
        spans = merged([(s["first"], s["last"]) for s in [*x, *y]])
        rows.append([{"first": p, "last": q} for p, q in spans])
    return pa.array(rows, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])))


def benchmark_matches(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = 10, block_bytes: int = BLOCK_BYTES, into: str = "match",
) -> DataFrame:
    """``docs`` with a struct column ``into``: n_words, the hit word spans
    (first and last word, from 0) and the ids (as text, sorted) of the items found."""
    out = None
    for items in _blocks(benchmark, item_id, item_text, block_bytes):
        match = _matcher(items, window)(F.col(text))
        if out is None:
            out = docs.withColumn(into, match)
            more = fresh_name(out, "_next")
            continue
        # another block: what was found is written, then joined with its finds
        out = stage(out, "matches").withColumn(more, match)
        out = out.withColumn(into, F.struct(
            F.col(f"{into}.n_words").alias("n_words"),
            arrow_udf(_union_spans, SPANS)(F.col(f"{into}.spans"), F.col(f"{more}.spans")).alias("spans"),
            F.array_sort(F.array_union(f"{into}.items", f"{more}.items")).alias("items"),
        )).drop(more)
    return out


def hit_words(match):
    return F.aggregate(match["spans"], F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)


def _character_spans(texts: pa.Array, spans: pa.Array) -> pa.Array:
    """Word spans as character offsets (stop excluded) of the original text."""
    rows = []
    for raw, places in zip(byte_values(texts), spans.to_pylist(), strict=True):
        if not places:
            rows.append([])
            continue
        at = [(m.start(), m.end()) for m in WORD.finditer(raw)]
        lead = np.r_[0, np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)]
        rows.append(
            [{"start": int(lead[at[s["first"]][0]]), "stop": int(lead[at[s["last"]][1]])} for s in places]
        )
    return pa.array(rows, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))


def contamination_spans(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per hit passage: key, first and last word, start and stop character."""
    own = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    hit = benchmark_matches(own, benchmark, "t", **options).where(F.size("match.spans") > 0)
    characters = arrow_udf(_character_spans, "array<struct<start:long,stop:long>>")
    place = F.arrays_zip(F.col("match.spans").alias("spans"), characters(F.col("t"), F.col("match.spans")).alias("at"))
    return hit.select(F.col("k").alias(key), F.explode(place).alias("p")).select(key, "p.spans.*", "p.at.*")


def contamination_report(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: words, hit words, items found."""
    m = F.col("match")
    n_hit = hit_words(m)
    own = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    return benchmark_matches(own, benchmark, "t", **options).select(
        F.col("k").alias(key), m["n_words"].alias("n_words"), n_hit.alias("n_hit"),
        F.size(m["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(m["items"], ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents without a hit word, with their columns."""
    into = fresh_name(docs, "_match")
    matched = benchmark_matches(docs, benchmark, text, into=into, **options)
    return matched.where(F.size(f"{into}.spans") == 0).drop(into)


def q_op5(spark, sf_dir):
    return contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op5_benchmark_decontamination": q_op5}
ORACLE_SQL = {
    "op5_benchmark_decontamination": """
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS n,
         array_to_string(w[i + 1 : i + least(len(w), 10)], ' ') AS k
  FROM items, unnest(range(greatest(1, len(w) - 9))) AS t(i) WHERE len(w) > 0
), lengths AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT doc_id, i, n, array_to_string(w[i + 1 : i + n], ' ') AS k
  FROM words, lengths, unnest(range(greatest(0, len(w) - n + 1))) AS t(i)
), hits AS (SELECT doc_id, i, g.n, item FROM grams g JOIN windows v ON v.k = g.k AND v.n = g.n),
covered AS (
  SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM hits, unnest(range(n)) AS t(j) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""
}

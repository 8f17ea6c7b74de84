"""Ranked lexical search by Block-Max MaxScore (operator 12).

``build_index`` writes every term of every document to a table of compressed
posting blocks.  Documents are cut into shards of bounded bytes, in key order
within a shard; a posting list is cut into blocks of ``BLOCK`` postings, each
held as variable-length gaps and counts beside its least document length at
counts 1, 2, 3 and more, which bound every score in it once the corpus totals
are known.

``search`` ranks all documents for each query.  A shard goes through its
documents in ranges.  The lists' bounds over the whole corpus split a query's
terms: those whose bounds together can't beat the shard's tenth score are
non-essential.  Essential lists are read, and a document of theirs stays a
candidate only while its score so far plus the maxima of the blocks that it
would need beats the tenth score; only the blocks of documents that pass are
decompressed.  The shards' heaps are merged by score and key.

* Texts are read once; of the index, only the blocks of query terms are
  shuffled, by shard.  Shards have bounded bytes (or are one document), so no
  group grows with the corpus or with a common term.
* Queries go in blocks of bounded bytes, whose terms, weights and bounds are
  all the driver holds; more queries are more passes over the index's columns.
* Every task keeps ten rows a query at most before the heaps are merged.

Scores are whole numbers, so equal ones are exactly equal; ties go by key, a null
key last.  Defined cases: null and empty texts have no terms and are never
found; a query without known terms finds nothing; repeated rows of either table
count, and are ranked, each; without documents nothing is found.  Other columns
never take part.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from martkit.llm.common import alnum_words, byte_values, stage, table

TOP = 10
BLOCK = 64  # postings
SHARD_BYTES = 16 << 20
QUERY_BYTES = 4 << 20
RANGE = 1024  # documents of a shard scored between two looks at the tenth score
FREE = 25  # 100 - 75: the part of a length norm that doesn't depend on the length
LENGTH = 75
NEVER = np.iinfo(np.int64).max  # least length at a count that no posting has
LEAST = ["l1", "l2", "l3", "l4"]
INDEX = f"shard long, term binary, block int, first int, last int, size int, most int, {', '.join(f'{c} long' for c in LEAST)}, data binary, n long"


# --- posting blocks -----------------------------------------------------------


def pack_numbers(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, end of each value): 7 bits a byte, lowest first, top bit while more follow."""
    sizes = 1 + sum((values >= 1 << (7 * i)).astype(np.int64) for i in range(1, 5))
    ends = np.cumsum(sizes)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
    for i in range(5):
        held = np.flatnonzero(sizes > i)
        out[ends[held] - sizes[held] + i] = ((values[held] >> (7 * i)) & 127) | ((sizes[held] > i + 1) << 7)
    return out, ends


def unpack_numbers(raw: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(raw < 128)
    if len(ends) == len(raw):
        return raw.astype(np.int64)
    starts = np.concatenate([[0], ends[:-1] + 1])
    shift = 7 * (np.arange(len(raw)) - np.repeat(starts, ends - starts + 1))
    return np.add.reduceat((raw & 127).astype(np.int64) << shift, starts)


def blocks_of(number: int, keys: pa.Array, words: list[np.ndarray], vocabulary: list[bytes]) -> Iterator[pa.RecordBatch]:
    """Index rows of a shard: its documents in key order, then its blocks.
    ``words``: the term numbers of each document."""
    order = pc.sort_indices(keys, null_placement="at_end").to_numpy()
    lengths = np.array([len(words[i]) for i in order], dtype=np.int64)
    size = len(order)
    flat = lambda v, kind: pa.array(np.full(size, v) if v is not None else [None] * size, kind)
    yield pa.RecordBatch.from_arrays(
        [flat(number, pa.int64()), flat(None, pa.binary()), flat(None, pa.int32()), pa.array(np.arange(size), pa.int32()),
         *[flat(None, pa.int32()) for _ in range(3)], *[flat(None, pa.int64()) for _ in LEAST], flat(None, pa.binary()),
         pa.array(lengths), keys.take(pa.array(order))],
        [*[c.split()[0] for c in INDEX.split(", ")], "k"],
    )
    if not lengths.any():
        return
    term = np.concatenate([words[i] for i in order]).astype(np.int64)
    seen, times = np.unique(term * size + np.repeat(np.arange(size), lengths), return_counts=True)
    term, doc = seen // size, seen % size
    new = np.flatnonzero(np.diff(term, prepend=-1))
    within = np.arange(len(term)) - np.repeat(new, np.diff(np.append(new, len(term))))
    starts = np.flatnonzero(within % BLOCK == 0)
    sizes = np.diff(np.append(starts, len(term)))
    gaps = np.diff(doc, prepend=0)
    gaps[starts] = 0
    raw, ends = pack_numbers(np.stack([gaps, times], axis=1).ravel())
    edges = np.concatenate([[0], ends[1::2][starts + sizes - 1]]).astype(np.int32)
    n = lengths[doc]
    least = [np.minimum.reduceat(np.where(times == c if c < 4 else times >= 4, n, NEVER), starts) for c in range(1, 5)]
    total = len(starts)
    terms = pa.array(vocabulary, pa.binary()).take(pa.array(term[starts]))
    rows = pa.RecordBatch.from_arrays(
        [pa.array(np.full(total, number)), terms, pa.array(within[starts] // BLOCK, pa.int32()), pa.array(doc[starts], pa.int32()),
         pa.array(doc[starts + sizes - 1], pa.int32()), pa.array(sizes, pa.int32()), pa.array(np.maximum.reduceat(times, starts), pa.int32()),
         *[pa.array(x) for x in least], pa.BinaryArray.from_buffers(pa.binary(), total, [None, pa.py_buffer(edges), pa.py_buffer(raw)]),
         pa.nulls(total, pa.int64()), pa.nulls(total, keys.type)],
        [*[c.split()[0] for c in INDEX.split(", ")], "k"],
    )
    for at in range(0, total, 1 << 16):
        yield rows.slice(at, 1 << 16)


def index_rows(shard_bytes: int):
    """Shards of the documents (k, x) of a partition as index rows."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, filled = TaskContext.get().partitionId() << 32, 0
        keys, words, vocabulary = [], [], defaultdict(count().__next__)

        def cut() -> Iterator[pa.RecordBatch]:
            nonlocal number, filled, keys, words, vocabulary
            yield from blocks_of(number, pa.concat_arrays(keys), words, list(vocabulary))
            number, filled, keys, words, vocabulary = number + 1, 0, [], [], defaultdict(count().__next__)

        for batch in batches:
            since = 0
            for at, raw in enumerate(byte_values(batch.column("x"))):
                if words and filled + len(raw) > shard_bytes:
                    keys.append(batch.column("k").slice(since, at - since))
                    since = at
                    yield from cut()
                filled += len(raw) + 64
                found = alnum_words(raw)
                words.append(np.fromiter(map(vocabulary.__getitem__, found), np.int32, len(found)))
            keys.append(batch.column("k").slice(since))
        if words:
            yield from cut()

    return rows


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The index as a table: rows without a term are documents (``first`` is the
    place in the shard, ``n`` the number of terms, ``k`` the key)."""
    plain = docs.select(F.col(key).alias("k"), F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8").alias("x"))
    schema = StructType([*StructType.fromDDL(INDEX).fields, StructField("k", plain.schema["k"].dataType)])
    return stage(plain.mapInArrow(index_rows(shard_bytes), schema), "postings")


# --- search in a shard ----------------------------------------------------------


def norms(n: np.ndarray, total_docs: int, total_terms: int) -> np.ndarray:
    return FREE + LENGTH * n * total_docs // total_terms


def impact(times, norm):
    """A posting's score before its term's weight, rounded down."""
    return 1_000_000_000 * times // (1000 * times + 8 * norm)


def block_bounds(columns, total_docs: int, total_terms: int) -> np.ndarray:
    """At least the largest impact of each block; ``columns(name)`` is an array."""
    best = np.zeros(len(columns("most")), dtype=np.int64)
    for times, name in enumerate(LEAST, 1):
        least = columns(name)
        held = least != NEVER
        norm = norms(np.where(held, least, 0), total_docs, total_terms)
        best = np.maximum(best, np.where(held, impact(np.maximum(columns("most"), 4) if times == 4 else np.int64(times), norm), 0))
    return best


class Shard:
    """The posting blocks of a shard for the terms of a block of queries."""

    def __init__(self, documents: pa.Table, postings: pa.Table, total_docs: int, total_terms: int):
        documents = documents.sort_by("place")
        self.keys = documents.column("name").combine_chunks()
        self.norm = norms(documents.column("length").to_numpy().astype(np.int64), total_docs, total_terms)
        postings = postings.sort_by([("t", "ascending"), ("block", "ascending")])
        get = lambda c: postings.column(c).to_numpy().astype(np.int64)
        self.first, self.last, self.size = get("first"), get("last"), get("size")
        self.bound = block_bounds(get, total_docs, total_terms)
        terms = get("t")
        starts = np.flatnonzero(np.diff(terms, prepend=-1))
        stops = np.append(starts[1:], len(terms))
        self.lists = {int(t): (int(a), int(b)) for t, a, b in zip(terms[starts], starts, stops, strict=True)}
        data = pa.concat_arrays([c.cast(pa.large_binary()) for c in postings.column("data").chunks])
        self.edges = np.frombuffer(data.buffers()[1], dtype=np.int64)[data.offset : data.offset + len(data) + 1]
        self.raw = np.frombuffer(data.buffers()[2], dtype=np.uint8)
        self.ranges: dict[tuple[int, int, int], tuple[np.ndarray, np.ndarray]] = {}  # kept for the other queries
        self.single: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.unpacked = 0  # blocks

    def unpack(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and impacts of the postings in blocks a to b of one list."""
        self.unpacked += b - a
        numbers = unpack_numbers(self.raw[self.edges[a] : self.edges[b]])
        sizes = self.size[a:b]
        run = np.cumsum(numbers[0::2])
        places = run + np.repeat(self.first[a:b] - run[np.cumsum(sizes) - sizes], sizes)
        return places, impact(numbers[1::2], self.norm[places])

    def postings(self, term: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Those of the list in a range of places; no other blocks are unpacked."""
        if (term, low, high) not in self.ranges:
            a, b = self.lists[term]
            start, stop = a + int(np.searchsorted(self.last[a:b], low)), a + int(np.searchsorted(self.first[a:b], high))
            parts = []
            if start < stop:  # the outer blocks may reach into other ranges, so they are kept
                parts.append(self.block(start))
                if start + 2 < stop:
                    parts.append(self.unpack(start + 1, stop - 1))
                if start + 1 < stop:
                    parts.append(self.block(stop - 1))
            places, impacts = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 2
            i, j = np.searchsorted(places, [low, high])
            self.ranges[term, low, high] = places[i:j], impacts[i:j]
        return self.ranges[term, low, high]

    def block(self, at: int) -> tuple[np.ndarray, np.ndarray]:
        if at not in self.single:
            self.single[at] = self.unpack(at, at + 1)
        return self.single[at]

    def add(self, term: int, weight: int, blocks: np.ndarray, candidates: np.ndarray, scores: np.ndarray) -> None:
        """Add the term's part to the candidates' scores; ``blocks``: where each
        candidate would stand in the list, -1 for nowhere."""
        for at in np.unique(blocks[blocks >= 0]).tolist():
            mine = np.flatnonzero(blocks == at)
            places, impacts = self.block(at)
            spot = np.minimum(np.searchsorted(places, candidates[mine]), len(places) - 1)
            there = places[spot] == candidates[mine]
            scores[mine[there]] += weight * impacts[spot[there]]

    def best(self, query: list[tuple[int, int, int]], top: int, span: int = RANGE) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of the best documents.  ``query``: (term, weight, bound
        over the corpus), in any order."""
        query = sorted((q for q in query if q[0] in self.lists and q[1]), key=lambda q: q[2])
        reach = np.cumsum([q[2] for q in query])
        places, scores, least = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        for low in range(0, len(self.norm), span):
            pivot = int(np.searchsorted(reach, least, side="right"))
            if pivot == len(query):
                break  # no document can beat the last one held
            high = min(low + span, len(self.norm))
            found = np.zeros(high - low, dtype=np.int64)
            for term, weight, _ in query[pivot:]:
                where, impacts = self.postings(term, low, high)
                found[where - low] += weight * impacts
            rest = int(reach[pivot - 1]) if pivot else 0
            candidates = np.flatnonzero((found > 0) & (found + rest > least))
            got, candidates = found[candidates], candidates + low
            stands, bounds = [], []
            for term, weight, _ in query[:pivot]:
                a, b = self.lists[term]
                at = a + np.searchsorted(self.last[a:b], candidates)
                inside = at < b
                inside[inside] = self.first[at[inside]] <= candidates[inside]
                stands.append(np.where(inside, at, -1))
                bounds.append(np.where(inside, weight * self.bound[np.where(inside, at, 0)], 0))
            left = np.sum(bounds, axis=0) if bounds else np.zeros(len(candidates), np.int64)
            alive = np.flatnonzero(got + left > least)
            for i in range(pivot - 1, -1, -1):
                if not len(alive):
                    break
                part = got[alive]
                self.add(query[i][0], query[i][1], stands[i][alive], candidates[alive], part)
                got[alive] = part
                left[alive] -= bounds[i][alive]
                alive = alive[got[alive] + left[alive] > least]
            places, scores = np.concatenate([places, candidates[alive]]), np.concatenate([scores, got[alive]])
            keep = np.lexsort((places, -scores))[:top]
            places, scores = places[keep], scores[keep]
            if len(scores) == top:
                least = int(scores[-1])  # later documents have larger keys, so an equal score loses
        return places, scores


# --- search over all shards -----------------------------------------------------


def query_blocks(queries: DataFrame, query_bytes: int) -> Iterator[list]:
    """The queries (q, x) in blocks of at most ``query_bytes``, or one query."""
    sized = queries.select("q", "x", (F.octet_length("x") + 64).alias("b"))
    total = sized.agg(F.coalesce(F.sum("b"), F.lit(0))).first()[0]
    parts = max(1, math.ceil(total / query_bytes))
    while True:
        part = F.pmod(F.xxhash64("q"), F.lit(parts))
        sums = sized.groupBy(part).agg(F.sum("b").alias("b"), F.count("*").alias("n")).where("n > 1").agg(F.max("b")).first()[0]
        if (sums or 0) <= query_bytes:
            break
        parts *= 2
    for i in range(parts):
        yield sized.where(part == i).select("q", "x").collect()


def weight_of(total_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * total_docs + 2) / (2 * df + 1)))


def search(index: DataFrame, queries: DataFrame, key: str = "item_id", text: str = "text", name: str = "doc_id", top: int = TOP, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """(key, rank, name, score): each query's best documents with a score above 0."""
    spark = index.sparkSession
    asked = stage(queries.select(F.monotonically_increasing_id().alias("q"), F.col(key).alias("key"), F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8").alias("x")), "queries")
    docs = index.where("term IS NULL").select(*[F.col(c).alias(a) for c, a in (("shard", "of"), ("first", "place"), ("n", "length"), ("k", "name"))])
    total_docs, total_terms = docs.agg(F.count_if(F.col("length") > 0), F.coalesce(F.sum("length"), F.lit(0))).first()
    kind = index.schema["k"].dataType
    schema = StructType([*StructType.fromDDL("q long, score long").fields, StructField("k", kind)])
    heaps = [spark.createDataFrame([], schema)]
    for rows in query_blocks(asked, query_bytes):
        counted = {row.q: Counter(alnum_words(bytes(row.x))) for row in rows}
        terms = {w: i for i, w in enumerate({w for words in counted.values() for w in words})}
        if not terms or not total_docs:
            continue
        known = spark.createDataFrame([(i, bytearray(w)) for w, i in terms.items()], "t int, term binary")
        found = index.join(F.broadcast(known), "term")
        stats = found.groupBy("t").agg(F.sum("size").alias("df"), F.max("most").alias("most"), *[F.min(c).alias(c) for c in LEAST]).toArrow()
        bounds = block_bounds(lambda c: stats.column(c).to_numpy().astype(np.int64), total_docs, total_terms)
        weights = {t: (weight_of(total_docs, df), int(b)) for t, df, b in zip(stats.column("t").to_pylist(), stats.column("df").to_pylist(), bounds, strict=True)}
        plans = {}
        for q, words in counted.items():
            held = [(terms[w], c) for w, c in words.items() if terms[w] in weights]
            plans[q] = [(t, weights[t][0] * c, weights[t][0] * c * weights[t][1]) for t, c in held]
        wanted = found.select("shard", "t", "block", "first", "last", "size", "most", *LEAST, "data")
        found = wanted.groupBy("shard").cogroup(docs.groupBy("of")).applyInArrow(best_of_shard(plans, total_docs, total_terms, top), schema)
        heaps.append(stage(found, "heaps"))
    heap = heaps[0]
    for more in heaps[1:]:
        heap = heap.unionByName(more)
    place = Window.partitionBy("q").orderBy(F.desc("score"), F.col("k").asc_nulls_last())
    ranked = heap.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top)
    return ranked.join(asked.select("q", "key"), "q").select(F.col("key").alias(key), "rank", F.col("k").alias(name), "score")


def best_of_shard(plans: dict[int, list], total_docs: int, total_terms: int, top: int):
    def best(postings: pa.Table, documents: pa.Table) -> pa.Table:
        out = {"q": [], "score": [], "k": []}
        if postings.num_rows:
            shard = Shard(documents, postings, total_docs, total_terms)
            for q, plan in plans.items():
                places, scores = shard.best(plan, top)
                out["q"].append(np.full(len(places), q, np.int64))
                out["score"].append(scores)
                out["k"].append(shard.keys.take(pa.array(places)))
        if not out["q"]:
            return pa.table({"q": pa.nulls(0, pa.int64()), "score": pa.nulls(0, pa.int64()), "k": pa.nulls(0, documents.schema.field("name").type)})
        return pa.table({"q": np.concatenate(out["q"]), "score": np.concatenate(out["score"]), "k": pa.concat_arrays(out["k"])})

    return best


def q_op12(spark, sf_dir):
    index = build_index(table(spark, sf_dir, "documents"))
    return search(index, table(spark, sf_dir, "benchmark"))


_TERMS = """regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"""
QUERIES = {"op12_ranked_search": q_op12}
ORACLE_SQL = {
    "op12_ranked_search": f"""
WITH words AS (SELECT row_number() OVER () AS d, doc_id, {_TERMS} AS w FROM documents),
totals AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS terms FROM words WHERE len(w) > 0),
asked AS (SELECT row_number() OVER () AS q, item_id, {_TERMS} AS w FROM benchmark),
wanted AS (SELECT q, term, count(*) AS c FROM (SELECT q, unnest(w) AS term FROM asked) GROUP BY q, term),
held AS (
  SELECT d, n, term, count(*) AS tf FROM (SELECT d, len(w) AS n, unnest(w) AS term FROM words)
  WHERE term IN (SELECT term FROM wanted) GROUP BY d, n, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM held, totals GROUP BY term
), parts AS (
  SELECT d, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))) AS s
  FROM held JOIN weights USING (term), totals
), scored AS (
  SELECT q, d, CAST(sum(c * s) AS BIGINT) AS score FROM wanted JOIN parts USING (term) GROUP BY q, d HAVING sum(c * s) > 0
), ranked AS (
  SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored JOIN words USING (d)
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked JOIN asked USING (q) WHERE rank <= 10""",
}

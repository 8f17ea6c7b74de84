"""Removal of byte strings that stand elsewhere too (operator 4).

Every byte covered by a string of ``length`` bytes that also starts anywhere
else, same document included, goes; strings are judged on the input.

* Equal texts are one text with a count.
* Strings meet by anchors: the smallest hash of a ``GRAM``-byte gram inside a
  string depends on the string alone, so equal strings share it.  Consecutive
  strings with one anchor form a segment.  Anchors found once end here.
* Equal segments under an anchor are one piece; found twice, they are repeated
  throughout.  The different pieces of an anchor are compared in a task by
  threshold-bounded interval expansion: from the empty string's interval of the
  pieces' Burrows-Wheeler transform, backward extension breadth first derives
  the boundaries whose common prefix is 0, 1, 2, ... bytes and stops at
  ``length``; neighbours without a boundary by then share a whole string.
* An anchor with more than ``MOST_PIECES`` different pieces is split, so no task
  holds an unbounded group: equal strings have as many bytes before the anchor,
  and those with ``low`` to ``high`` bytes before it share the bytes that all of
  them cover.  Each piece is cut into the strings of the lower and of the upper
  half of that interval, and the parts that agree in those bytes are the pieces
  of a longer anchor.  Parts found nowhere else end here, equal parts are one,
  and what is still too large is split again, at most once a halving: two rows
  a piece and round, not one a string.

Defined cases: null text is empty (0 bytes, nothing removed); null keys are
kept; repeated rows are copies of each other; empty tables give no rows; extra
columns never take part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from martkit.llm.common import byte_values, stage, table

LENGTH = 200
GRAM = 50
MOST_PIECES = 1000  # different pieces of one anchor compared in a task
TASK_BYTES = 1 << 20  # bytes of pieces transformed at a time

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
# a fixed odd-looking value for each byte
BYTES = np.array([int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=8).digest(), "little") for b in range(256)], dtype=np.uint64)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of every ``width`` consecutive ones."""
    n = len(values)
    pad = -n % width
    filled = np.concatenate([values, np.full(pad, np.iinfo(values.dtype).max, values.dtype)]).reshape(-1, width)
    before = np.minimum.accumulate(filled, axis=1).ravel()
    after = np.minimum.accumulate(filled[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[: n - width + 1], before[width - 1 : n])


def gram_hashes(raw: bytes, gram: int) -> tuple[np.ndarray, ...]:
    """(prefix sums, inverse powers, hash of the gram at each place, its order)."""
    n = len(raw)
    codes = BYTES[np.frombuffer(raw, dtype=np.uint8)]
    back = powers(INVERSE, n)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(codes * powers(BASE, n), out=sums[1:])
    grams = mixed((sums[gram:] - sums[:-gram]) * back[: n - gram + 1])
    # order by half of the hash, then by place
    return sums, back, grams, (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)


def segments(raw: bytes, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(start, size, anchor hash, segment hash) of a text's segments."""
    if len(raw) < length:
        return (np.zeros(0, np.int64),) * 4
    sums, back, grams, order = gram_hashes(raw, gram)
    anchor = (window_minima(order, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    start = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    stop = np.append(start[1:], len(anchor)) - 1 + length
    whole = (sums[stop] - sums[start]) * back[start]
    whole ^= ((stop - start).astype(np.uint64) << np.uint64(32)) + (anchor[start] - start).astype(np.uint64)
    return start, stop - start, grams[anchor[start]].view(np.int64), mixed(whole).view(np.int64)


def suffix_order(codes: np.ndarray, depth: int) -> np.ndarray:
    """Order of the cyclic suffixes, by ``depth`` or more symbols."""
    rank, reach = codes.astype(np.int64), 1
    width = int(codes.max()).bit_length()
    while 2 * reach * width <= 62:  # as many symbols as a number holds need no sort
        rank = (rank << (reach * width)) | np.roll(rank, -reach)
        reach *= 2
    while True:
        order = np.argsort(rank)  # of equal ones in any order: they agree on all that is asked
        step = rank[order]
        names = np.cumsum(np.append(False, step[1:] != step[:-1]))
        if reach >= depth or names[-1] == len(names) - 1:
            return order
        rank = np.empty_like(names)
        rank[order] = names
        rank = rank * (int(names[-1]) + 1) + np.roll(rank, -reach)
        reach *= 2


def repeated_starts(pieces: list[bytes], length: int) -> list[np.ndarray]:
    """For each piece, where strings start that stand twice or more in the pieces."""
    sizes = np.array([len(p) for p in pieces], dtype=np.int64)
    stops = np.cumsum(sizes + 1)
    ends = stops - 1
    codes = np.frombuffer(b"\0".join(pieces) + b"\0", dtype=np.uint8).astype(np.int64) + len(pieces)
    codes[ends] = np.arange(len(pieces))  # every end is a symbol of its own
    n = len(codes)
    suffixes = suffix_order(codes, length)
    transform = np.roll(codes, 1)[suffixes]
    last_first = np.empty(n, dtype=np.int64)
    last_first[np.argsort(transform, kind="stable")] = np.arange(n)

    boundary = np.zeros(n + 1, dtype=bool)  # of an interval, before each place
    boundary[[0, n]] = True
    low, high = np.array([0]), np.array([n - 1])
    for _ in range(length):
        # the places in the queued intervals, extended backwards by their symbols
        size = high - low + 1
        owner = np.repeat(np.arange(len(low)), size)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + low[owner]
        symbol = transform[place]
        several = np.flatnonzero(np.repeat(size > 1, size))  # a single place is in order
        if len(several):
            by = several[np.argsort(owner[several] * (len(pieces) + 256) + symbol[several], kind="stable")]
            place[several], symbol[several] = place[by], symbol[by]
        new = np.append(True, (owner[1:] != owner[:-1]) | (symbol[1:] != symbol[:-1]))
        to = last_first[place]
        first = np.flatnonzero(new)
        low, high = to[first], to[np.append(first[1:], len(to)) - 1]
        keep = ~boundary[high + 1]
        low, high = low[keep], high[keep]
        high, once = np.unique(high, return_index=True)
        low = low[once]
        boundary[high + 1] = True
        if not len(low):
            break
    shared = ~boundary[:-1] | ~boundary[1:]
    found = np.zeros(n, dtype=bool)
    found[suffixes[shared]] = True
    starts = np.append(0, stops[:-1])
    return [np.flatnonzero(found[a : a + max(0, s - length + 1)]) for a, s in zip(starts, sizes, strict=True)]


def ranges(starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by the strings at the sorted starts."""
    if not len(starts):
        return starts, starts
    cut = np.flatnonzero(np.diff(starts) > length)
    return starts[np.append(0, cut + 1)], starts[np.append(cut, len(starts) - 1)] + length


MARKS = "h long, f long, lo int, hi int"


def compare(length: int):
    """Ranges repeated among the pieces (h, f, p) of each anchor; rows come by h."""

    def marks(keys: list, pieces: list[bytes]) -> pa.RecordBatch:
        rows: list = []
        for (h, f), starts in zip(keys, repeated_starts(pieces, length), strict=True):
            rows += [(h, f, a, b) for a, b in zip(*(x.tolist() for x in ranges(starts, length)), strict=True)]
        columns = list(zip(*rows, strict=True)) or [[], [], [], []]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["h", "f", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, pieces, filled = [], [], 0
        for batch in batches:
            for h, f, p in zip(batch.column("h").to_pylist(), batch.column("f").to_pylist(), byte_values(batch.column("p")), strict=True):
                if filled > TASK_BYTES and h != keys[-1][0]:
                    yield marks(keys, pieces)
                    keys, pieces, filled = [], [], 0
                keys.append((h, f))
                pieces.append(p)
                filled += len(p)
        if pieces:
            yield marks(keys, pieces)

    return run


PARTS = "h long, f long, at int, u long, v long, low int, high int, p binary"


def key64(raw: bytes, *numbers: int) -> int:
    told = b"".join(x.to_bytes(8, "little", signed=True) for x in numbers)
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8, key=told).digest(), "little", signed=True)


def halves(length: int, gram: int):
    """(h, f, at, u, v, low, high, p): the parts of each piece (h, f, p, low, high) whose
    strings have so many bytes before the anchor as one half of its interval says;
    u is the hash of the bytes that all such strings cover, v that of the part."""

    def parts(h: int, f: int, p: bytes, low: int, high: int) -> Iterator[tuple]:
        anchor = int(np.argmin(gram_hashes(p, gram)[3][: length - gram + 1]))
        middle = (low + high) // 2
        for lo, hi in ((low, middle), (middle + 1, high)):
            first, last = max(0, anchor - hi), min(len(p) - length, anchor - lo)
            if first <= last:
                part = p[first : last + length]
                yield h, f, first, key64(p[anchor - lo : anchor - hi + length], h, lo, hi), key64(part), lo, hi, part

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        names = ["h", "f", "at", "u", "v", "low", "high", "p"]
        for batch in batches:
            given = [batch.column(c).to_pylist() for c in ("h", "f", "p", "low", "high")]
            rows = [part for piece in zip(*given, strict=True) for part in parts(*piece)]
            columns = list(zip(*rows, strict=True)) or [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return run


def piece_marks(pieces: DataFrame, length: int, gram: int, most_pieces: int) -> DataFrame:
    """Marks (h, f, lo, hi) from the different pieces (h, f, p, c, n, low, high), c how
    often each was found and n how many its anchor has."""
    twice = pieces.where("c > 1").select("h", "f", F.lit(0).alias("lo"), F.octet_length("p").alias("hi"))
    few = pieces.where((F.col("n") > 1) & (F.col("n") <= most_pieces)).select("h", "f", "p")
    marks = twice.unionByName(few.repartition("h").sortWithinPartitions("h").mapInArrow(compare(length), MARKS))
    large = pieces.where((F.col("n") > 1) & (F.col("n") > most_pieces))
    if large.isEmpty():
        return marks
    parts = stage(large.select("h", "f", "p", "low", "high").mapInArrow(halves(length, gram), PARTS), "parts")
    kinds = parts.groupBy("u", "v").agg(F.count("*").alias("c"), *[F.first(x).alias(x) for x in ("p", "low", "high")])
    met = parts.groupBy("u").agg(F.count("*").alias("k"), F.countDistinct("v").alias("n")).where("k > 1").select("u", "n")
    below = stage(kinds.join(met, "u").select(F.col("u").alias("h"), F.col("v").alias("f"), "p", "c", "n", "low", "high"), "pieces")
    found = piece_marks(below, length, gram, most_pieces).select(F.col("h").alias("u"), F.col("f").alias("v"), "lo", "hi")
    own = parts.select("h", "f", "at", "u", "v").join(found, ["u", "v"])
    return marks.unionByName(own.select("h", "f", (F.col("at") + F.col("lo")).alias("lo"), (F.col("at") + F.col("hi")).alias("hi")))


def repeated_ranges(texts: DataFrame, length: int, most_pieces: int) -> DataFrame:
    """(t, lo, hi) from different texts (t, x): ranges made of strings that
    start anywhere else in the table; they may overlap."""
    cut = "t long, start int, size int, h long, f long"
    gram = min(GRAM, length)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, raw in zip(batch.column("t").to_pylist(), byte_values(batch.column("x")), strict=True):
                start, size, h, f = segments(raw, length, gram)
                if len(start):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(start), t, np.int64)), pa.array(start.astype(np.int32)), pa.array(size.astype(np.int32)), pa.array(h), pa.array(f)],
                        names=["t", "start", "size", "h", "f"],
                    )

    parts = stage(texts.select("t", "x").mapInArrow(find, cut), "segments")
    met = parts.groupBy("h").agg(F.count("*").alias("n"), F.min("f").alias("low"), F.max("f").alias("high"))
    held = stage(parts.join(met.where("n > 1"), "h"), "met")
    alike = held.where("low = high").select("t", F.col("start").alias("lo"), (F.col("start") + F.col("size")).alias("hi"))
    mixed_ = held.where("low < high").select("t", "start", "size", "h", "f")
    place = F.struct("t", "start", "size")
    kinds = mixed_.groupBy("h", "f").agg(F.count("*").alias("c"), F.min(place).alias("r")).select("h", "f", "c", "r.*")
    several = kinds.groupBy("h").agg(F.count("*").alias("n"))
    wanted = kinds.join(several, "h")
    piece = F.expr("substring(x, start + 1, size)")
    whole = (F.lit(0).alias("low"), F.lit(length - gram).alias("high"))
    pieces = stage(wanted.join(texts.select("t", "x"), "t").select("h", "f", "c", "n", piece.alias("p"), *whole), "pieces")
    marks = stage(piece_marks(pieces, length, gram, most_pieces), "marks")
    found = mixed_.join(marks, ["h", "f"]).select("t", (F.col("start") + F.col("lo")).alias("lo"), (F.col("start") + F.col("hi")).alias("hi"))
    return alike.unionByName(found)


SPANS = "array<struct<start:int,stop:int>>"


def merged(found: pa.Array) -> pa.Array:
    """Ranges of each text as its maximal runs."""
    if isinstance(found, pa.ChunkedArray):
        found = found.combine_chunks()
    sizes = pa.compute.list_value_length(found).fill_null(0).to_numpy(zero_copy_only=False)
    flat = found.flatten()
    text = np.repeat(np.arange(len(found), dtype=np.int64), sizes) << 32  # places of one text after those of another
    low, high = (text + pa.compute.struct_field(flat, side).to_numpy(zero_copy_only=False) for side in ("lo", "hi"))
    by = np.argsort(low)
    low, high = low[by], np.maximum.accumulate(high[by])
    first = np.flatnonzero(np.append(True, low[1:] > high[:-1])[: len(low)])
    last = np.append(first[1:], len(low))[: len(first)] - 1
    runs = pa.StructArray.from_arrays(
        [pa.array((x & 0xFFFFFFFF).astype(np.int32)) for x in (low[first], high[last])],
        fields=[pa.field("start", pa.int32()), pa.field("stop", pa.int32())],
    )
    counts = np.bincount(low[first] >> 32, minlength=len(found))
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), runs)


def kept_bytes(x, spans):
    """The bytes outside the runs."""

    @arrow_udf("binary")
    def kept(texts: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for raw, runs in zip(byte_values(texts), found.to_pylist(), strict=True):
            at, left = 0, []
            for r in runs:
                left.append(raw[at : r["start"]])
                at = r["stop"]
            out.append(b"".join([*left, raw[at:]]))
        return pa.array(out, pa.binary())

    return kept(x, spans)


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, most_pieces: int = MOST_PIECES) -> tuple[DataFrame, DataFrame]:
    """(members, texts): (key, d) of every row, and for each different text
    (d, x, spans), d its digest and spans its removed runs."""
    x = F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8")
    members = docs.select(F.col(key), F.sha2(x, 256).alias("d"))
    own = docs.select(x.alias("x")).withColumn("d", F.unhex(F.sha2("x", 256)))
    texts = own.groupBy("d").agg(F.first("x").alias("x"), F.count("*").alias("copies"))
    texts = stage(texts.withColumn("t", F.monotonically_increasing_id()), "texts")
    found = repeated_ranges(texts, length, most_pieces).groupBy("t").agg(F.collect_list(F.struct("lo", "hi")).alias("found"))
    whole = F.array(F.struct(F.lit(0).alias("start"), F.octet_length("x").alias("stop"))).cast(SPANS)
    copied = (F.col("copies") > 1) & (F.octet_length("x") >= length)
    spans = F.when(copied, whole).otherwise(F.coalesce(F.col("runs"), F.array().cast(SPANS)))
    runs = found.select("t", arrow_udf(merged, SPANS)("found").alias("runs"))
    return members, texts.join(runs, "t", "left").select(F.lower(F.hex("d")).alias("d"), "x", spans.alias("spans"))


def drop_repeated_strings(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """(key, spans, kept): the removed runs and the bytes that stay."""
    members, texts = repeated_spans(docs, key, text, length)
    return members.join(texts.select("d", "spans", kept_bytes("x", "spans").alias("kept")), "d").drop("d")


def digests(docs: DataFrame, length: int = LENGTH, most_pieces: int = MOST_PIECES) -> DataFrame:
    """Per document: bytes, removed bytes, runs and the digest of what stays."""
    members, texts = repeated_spans(docs, length=length, most_pieces=most_pieces)
    removed = F.aggregate("spans", F.lit(0), lambda n, s: n + s["stop"] - s["start"])
    each = texts.select(
        "d", F.octet_length("x").cast("long").alias("n_bytes"), removed.cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2(kept_bytes(F.col("x"), F.col("spans")), 256).alias("kept_sha256"),
    )
    return members.join(each, "d").drop("d")


def q_op4(spark, sf_dir):
    return digests(table(spark, sf_dir, "documents"))


QUERIES = {"op4_suffix_dedup": q_op4}
ORACLE_SQL: dict[str, str] = {}

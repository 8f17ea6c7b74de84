"""N-gram Jaccard join by vertical partitioning (operator 1).

Texts become sets of hashed n-word shingles; equal texts are one class with its
smallest key, whose set is made once.  The global order of the shingles is that of their hashes, cut
into fragments of equal hash ranges.  Two sets that reach the threshold differ
in so few shingles that, of more fragments than that, at least one is equal:
sets meet on equal fragments (for each interval of set sizes one more fragment
than differences allowed).  For the pairs that meet, the common shingles are
counted fragment by fragment of the order and summed per pair, once the parities
of the two sets (a small row of bits each) don't rule the pair out.

A group of sets that meet is not expanded into pairs.  Each member is compared
with the smallest; then, round by round, groups whose members are still in
different components compare a growing share of their members, at the end all,
with the members of other components.  Pairs inside a component need no
comparison, so no link that would join two components is lost; members compared
in an earlier round are not chosen again.  Groups of more than ``SMALL`` members
are cut into blocks that meet two by two in the tasks, where sizes and parities
are compared: a pair becomes a row only if these allow the threshold.  A fragment that
is empty in both sets tells nothing, so there are some fragments to spare; a set
with as many empty ones as fragments that must be equal also meets on the first
shingles of the order, by the prefix length of the threshold.

Every fragment that a set has beyond the differences allowed and one more is to
spare: two sets that reach the threshold have so many equal fragments that each
may leave out as many marks as it has to spare, if all sets leave out those
that most sets have.  So marks of phrases that a share of all sets holds, whose
groups would grow with the input and their pairs with its square, are left to
the sets that have no rarer ones.  Marks travel in blobs, dealt by ``PASSES``
disjoint shares one after the other, each written before the next, so the disk
holds the shuffle of one share only; those of one set alone become no rows.

Defined cases: null or wordless texts have empty sets and no links; null keys
are left out of the links; repeated rows are one class; empty tables give no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import StructField, StructType

from martkit.llm.common import byte_values, settled, stage, table

FRAGMENTS = 8
EDGES = np.arange(FRAGMENTS, dtype=np.uint64) << np.uint64(61)  # starts in the order of hashes
PASSES = 2
SPARE = 0.25  # fragments to spare, as a share of the differences allowed
DEALT = 1 << 17  # marks that a task groups at once
PICKED = 500_000  # keys that are broadcast to pick their texts
PARITY_BITS = 1024
SMALL = 8  # members of a group whose pairs are listed
BLOCK = 1024  # members of a larger group that meet as many others in a task
ROLL = np.uint64(0x9E3779B97F4A7C15)


AT_ONCE = 1 << 22  # bytes of texts whose words are hashed at once
LONG = 64  # bytes of a word that are mixed eight by eight; longer ones are hashed alone
SEPARATORS = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)  # the first n of eight bytes


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z, and where they start."""
    low = raw.lower()
    gap = SEPARATORS[np.frombuffer(low, np.uint8)]
    edge = np.diff(gap, prepend=True, append=True)
    starts, ends = np.flatnonzero(edge)[::2], np.flatnonzero(edge)[1::2]
    size = ends - starts
    eight = np.ndarray(len(low) + 1, "<u8", low + bytes(8), strides=(1,))  # those from each byte on
    h = size.astype(np.uint64) * ROLL
    for at in range(0, min(int(size.max(initial=0)), LONG), 8):
        here = np.flatnonzero(size > at) if at else slice(None)
        h[here] = mix(h[here] ^ (eight[starts[here] + at] & FIRST[np.minimum(size[here] - at, 8)]))
    for i in np.flatnonzero(size > LONG).tolist():
        h[i] = int.from_bytes(hashlib.blake2b(low[starts[i] : ends[i]], digest_size=8).digest(), "little")
    return h, starts


def rolled(h: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(max(0, len(h) - size + 1), dtype=np.uint64)
    for i in range(size):
        out = out * ROLL + h[i : len(h) - size + 1 + i]
    return out


def shingle_sets(raws: Iterable[bytes], n: int) -> Iterator[np.ndarray]:
    """The sorted shingles of each text, in turn."""

    def of(part: list[bytes]) -> Iterator[np.ndarray]:
        h, starts = word_hashes(b" ".join(part))
        at = np.searchsorted(starts, np.cumsum([0, *(len(raw) + 1 for raw in part)])).tolist()
        full = rolled(h, n) if len(h) >= n else h[:0]
        for one, two in zip(at[:-1], at[1:], strict=True):
            if one == two:
                yield np.zeros(0, dtype=np.uint64)
                continue
            out = full[one : two - n + 1] if two - one >= n else rolled(h[one:two], two - one)
            out = np.sort((out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9))
            yield out[np.append(True, out[1:] != out[:-1])]

    part, held = [], 0
    for raw in raws:
        if part and held + len(raw) > AT_ONCE:
            yield from of(part)
            part, held = [], 0
        part.append(raw)
        held += len(raw)
    if part:
        yield from of(part)


def interval(size: int, threshold: float) -> int:
    """Number of the size interval; neighbours differ by at most the threshold."""
    return int(math.log(max(1, size)) / -math.log(threshold) + 1e-9)


def signatures(s: np.ndarray, threshold: float) -> tuple[list[np.ndarray], list[int]]:
    """Hashes of the set's fragments for its size interval, for the next one, and of
    its first shingles; how many of the first two kinds the set may leave out."""
    marks, spare = [np.zeros(0, dtype=np.int64)] * 3, [0, 0]
    if not len(s):
        return marks, spare
    rate = (1 - threshold) / (1 + threshold) * 2
    empty = math.exp(-threshold * threshold / rate) if rate else 0.0  # share of empty fragments in the smallest sets
    mixed = (s * ROLL) ^ (s >> np.uint64(31))
    for side in range(2):
        number = interval(len(s), threshold) + side
        largest = threshold ** -(number + 1)  # sets that meet here are smaller
        differ = int(rate * largest + 1e-6)
        parts = differ + 1 + int((SPARE + 1.5 * empty) * differ)
        where = (s >> np.uint64(32)).astype(np.int64) * parts >> 32
        starts = np.flatnonzero(np.append(True, where[1:] != where[:-1]))
        sums = np.add.reduceat(mixed, starts)
        filled, sums = where[starts][sums != 0], sums[sums != 0]
        tagged = (sums ^ (filled.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))) * ROLL + np.uint64(number)
        marks[side], spare[side] = tagged.view(np.int64), max(0, len(filled) - differ - 1)
        if len(filled) <= differ:
            prefix = s[: len(s) - math.ceil(threshold * len(s) - 1e-9) + 1]
            marks[2] = ((prefix ^ (prefix >> np.uint64(27))) * ROLL + np.uint64(1)).view(np.int64)
    return marks, spare


def parity(s: np.ndarray) -> list[int]:
    """A bit for each of ``PARITY_BITS`` buckets: whether it holds an odd number
    of shingles.  Two sets differ in at least as many shingles as their bits do."""
    odd = np.bincount((s % np.uint64(PARITY_BITS)).astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8").tolist()


def may_link(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose sizes and parities allow the threshold; it drops no link: sets
    that reach it differ in a (1 - t) / (1 + t)th of both sizes at most."""
    own = lambda side: classes.select(F.col("c").alias(side), F.col("n").alias(f"n_{side}"), F.col("bits").alias(f"bits_{side}"))
    met = pairs.join(own("a"), "a").join(own("b"), "b")
    apart = F.aggregate(
        F.zip_with("bits_a", "bits_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, x: total + x.cast("int")
    )
    most = (F.col("n_a") + F.col("n_b")) * ((1 - threshold) / (1 + threshold)) + 1e-6
    near = F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * (threshold - 1e-9)
    return met.where(near & (apart <= most)).select("a", "b")


def dealt(number: int, buckets: int):
    """Blobs of the marks of many sets, and of the sets and kinds they are of, by bucket."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.frombuffer(b"".join(batch.column("marks").to_pylist()), np.int64)
            each = np.stack([batch.column(name).to_numpy() for name in ("low", "high", "front")], axis=1)
            own = np.repeat((batch.column("i").to_numpy()[:, None] * 4 + np.arange(3)).ravel(), each.ravel())
            bucket = (marks.view(np.uint64) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            order = order[bucket[order] % PASSES == number]
            bucket, marks, own = bucket[order], marks[order], own[order]
            starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))[: len(bucket)]
            blobs = [pa.array([x.tobytes() for x in np.split(v, starts[1:])][: len(starts)], pa.binary()) for v in (marks, own)]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[starts]), *blobs], names=["bucket", "marks", "own"])

    return deal


def shared(rows: pa.Table) -> pa.Table:
    """The marks of a bucket that several sets have: a row for each such set, with their number."""
    m, own = (np.frombuffer(b"".join(rows.column(name).to_pylist()), np.int64) for name in ("marks", "own"))
    order = np.argsort(m, kind="stable")
    m, own = m[order], own[order]
    starts = np.flatnonzero(np.append(True, m[1:] != m[:-1]))
    k = np.diff(np.append(starts, len(m)))
    k = np.repeat(k, k)
    m, own, k = m[k > 1], own[k > 1], k[k > 1]
    return pa.table({"m": m, "i": own >> 2, "side": (own & 3).astype(np.int32), "k": k})


def meetings(classes: DataFrame) -> DataFrame:
    """Rows (m, c, n, a, k): the sets that meet on a mark, its smallest class and how many there are.  A set
    leaves out as many marks of a kind as it has to spare, those that most sets have first."""
    total = classes.agg(F.sum(F.col("low") + F.col("high") + F.col("front"))).first()[0] or 0
    buckets = PASSES * max(32, -(-total // (PASSES * DEALT)))
    held = None
    for number in range(PASSES):
        blobs = classes.select("i", "marks", "low", "high", "front").mapInArrow(dealt(number, buckets), "bucket int, marks binary, own binary")
        part = settled(blobs.groupBy("bucket").applyInArrow(shared, "m long, i long, side int, k long"), "met")
        held = part if held is None else held.unionByName(part)
    place = F.row_number().over(Window.partitionBy("i", "side").orderBy(F.desc("k"), F.desc("m")))
    own = classes.select("i", "c", "n", "spare_low", "spare_high")
    spare = F.when(F.col("side") == 0, F.col("spare_low")).when(F.col("side") == 1, F.col("spare_high")).otherwise(0)
    left = settled(held.withColumn("place", place).join(own, "i").where(F.col("place") > spare).select("m", "c", "n"), "left")
    groups = left.groupBy("m").agg(F.min("c").alias("a"), F.count("*").alias("k")).where("k > 1")
    return settled(left.join(groups, "m"), "held")


def links(classes: DataFrame, texts: DataFrame, words: int, threshold: float) -> DataFrame:
    """Pairs (a, b) of classes (i, c, n, marks, low, high, front, spare_low, spare_high, bits)
    that reach the threshold; texts: (c, x)."""
    held = meetings(classes)
    met = stage(held.select("c").distinct(), "members")
    texts = settled(texts.join(F.broadcast(met) if met.count() <= PICKED else met, "c", "left_semi"), "texts")
    classes = settled(classes.select("c", "n", "bits").join(F.broadcast(met) if met.count() <= PICKED else met, "c", "left_semi"), "members")
    first = held.where("a < c").select("a", F.col("c").alias("b")).distinct()
    found = settled(verified(may_link(first, classes, threshold), texts, words, threshold), "links")
    before, share = 0, 1
    while True:
        # the smallest member has been compared with all, as have those of earlier turns
        now = held.where("c <> a").join(components(found), "c", "left").withColumn("root", F.coalesce("root", "c"))
        split = now.groupBy("m").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("m")
        turn = F.pmod(F.xxhash64("c", "m"), "k").alias("turn")
        open_ = stage(now.join(split, "m").select("m", "c", "n", "k", "root", turn).where(F.col("turn") >= before), "open")
        largest = open_.agg(F.max("k")).first()[0]
        if largest is None:
            return found
        small = open_ if share == 1 else open_.where(F.col("k") <= SMALL)
        chosen = small.where(F.col("turn") < share).select("m", F.col("c").alias("b"), F.col("n").alias("o"), F.col("root").alias("r"))
        near = (F.col("root") != F.col("r")) & (F.least("n", "o") >= F.greatest("n", "o") * (threshold - 1e-9))
        pairs = chosen.join(small, "m").where(near).select(F.least("b", "c").alias("a"), F.greatest("b", "c").alias("b")).distinct()
        pairs = may_link(pairs, classes, threshold)
        if share > 1 and largest > SMALL:
            pairs = pairs.unionByName(met_in_blocks(open_.where(F.col("k") > SMALL), classes, share, threshold)).distinct()
        found = settled(found.unionByName(verified(pairs, texts, words, threshold)).distinct(), "links")
        if share >= largest:
            return found
        before, share = share, share * 16


def allowed(n: np.ndarray, bits: np.ndarray, o: np.ndarray, other: np.ndarray, threshold: float) -> np.ndarray:
    """Whether the sizes and parities of each set of one side and each of the other
    allow the threshold."""
    least, most = np.minimum.outer(n, o), np.maximum.outer(n, o)
    apart = np.zeros(least.shape, dtype=np.int32)
    for word, its in zip(bits.T, other.T, strict=True):
        apart += np.bitwise_count(np.bitwise_xor.outer(word, its))
    return (least >= most * (threshold - 1e-9)) & (apart <= (least + most) * ((1 - threshold) / (1 + threshold)) + 1e-6)


def block_pairs(share: int, threshold: float):
    """Pairs (a, b) of different components, one chosen in this round, whose sizes
    and parities allow the threshold; rows come by group and pair of blocks."""

    def meet(rows: pa.Table) -> pa.RecordBatch:
        own, turn = rows.column("own").to_numpy(), rows.column("turn").to_numpy()
        n, root = rows.column("n").to_numpy(), rows.column("root").combine_chunks().dictionary_encode().indices.to_numpy()
        bits = rows.column("bits").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(rows), -1)
        one, two = rows.column("p")[0].as_py(), rows.column("q")[0].as_py()
        left, right = np.flatnonzero(own == one), np.flatnonzero(own == two)
        chosen = turn < share
        sides = [(left[chosen[left]], right)] + ([(right[chosen[right]], left)] if one != two else [])
        a, b = [], []
        for x, y in sides:
            if len(x) and len(y):
                good = allowed(n[x], bits[x], n[y], bits[y], threshold) & (root[x][:, None] != root[y][None, :])
                i, j = np.nonzero(good)
                a.append(x[i])
                b.append(y[j])
        c = rows.column("c").combine_chunks()
        a, b = (pa.array(np.concatenate([np.zeros(0, np.int64), *side])) for side in (a, b))
        return pa.RecordBatch.from_arrays([c.take(a), c.take(b)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # rows of the last pair of blocks, which may go on
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            if not len(rows):
                continue
            m, p, q = (rows.column(name).to_numpy() for name in ("m", "p", "q"))
            starts = np.flatnonzero(np.append(True, (m[1:] != m[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1])))
            for at, to in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                yield meet(rows.slice(at, to - at))
            held = rows.slice(int(starts[-1]))
        if held is not None and len(held):
            yield meet(held)

    return run


def met_in_blocks(members: DataFrame, classes: DataFrame, share: int, threshold: float) -> DataFrame:
    """Pairs (a, b) of the members (m, c, n, k, root, turn) of the same group, cut
    into blocks: a task holds two blocks at a time, however large the group is."""
    dealt = members.withColumn("parts", F.ceil(F.col("k") / BLOCK)).withColumn("own", F.pmod(F.xxhash64("m", "c"), "parts"))
    dealt = dealt.withColumn("with", F.explode(F.expr("sequence(0L, parts - 1)")))
    keyed = dealt.select("m", F.least("own", "with").alias("p"), F.greatest("own", "with").alias("q"), "own", "c", "n", "root", "turn")
    keyed = keyed.join(classes.select("c", "bits"), "c")
    rows = keyed.repartition("m", "p", "q").sortWithinPartitions("m", "p", "q")
    key = classes.schema["c"].dataType
    schema = StructType([StructField("a", key), StructField("b", key)])
    met = rows.mapInArrow(block_pairs(share, threshold), schema)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def overlap(s: np.ndarray, t: np.ndarray, needed: int) -> int:
    """Common shingles of two sorted sets, counted fragment by fragment and
    summed; less than ``needed`` as soon as what is left can't reach it."""
    at, to = np.append(np.searchsorted(s, EDGES), len(s)), np.append(np.searchsorted(t, EDGES), len(t))
    total = 0
    for f in range(FRAGMENTS):
        total += len(np.intersect1d(s[at[f] : at[f + 1]], t[to[f] : to[f + 1]], assume_unique=True))
        if total + min(len(s) - at[f + 1], len(t) - to[f + 1]) < needed:
            break
    return total


def verified(pairs: DataFrame, texts: DataFrame, words: int, threshold: float) -> DataFrame:
    """The pairs (a, b) that reach the threshold.  The texts of all pairs are picked
    once, then the second text of a pair travels to the first, which several pairs
    share; the sets are made where both meet, so no set is written or shuffled."""
    percent = round(100 * threshold)

    def reach(x: pa.Array, y: pa.Array) -> pa.Array:
        out, s = [], None
        first, second = byte_values(x), byte_values(y)
        new = [i == 0 or p != first[i - 1] for i, p in enumerate(first)]  # pairs with one first text come in turn
        own = shingle_sets((p for p, begins in zip(first, new, strict=True) if begins), words)
        for begins, t in zip(new, shingle_sets(second, words), strict=True):
            s = next(own) if begins else s
            both = len(s) + len(t)
            needed = -(-both * percent // (100 + percent))  # of o, where 100 o >= percent (both - o)
            out.append(min(len(s), len(t)) >= needed and overlap(s, t, needed) >= needed)
        return pa.array(out, pa.bool_())

    near = arrow_udf(reach, "boolean")
    pairs = stage(pairs, "pairs")
    wanted = pairs.select(F.col("a").alias("c")).unionByName(pairs.select(F.col("b").alias("c"))).distinct()
    picked = settled(texts.join(wanted, "c", "left_semi"), "picked")
    second = settled(pairs.join(picked.select(F.col("c").alias("b"), F.col("x").alias("y")), "b"), "second")
    both = second.join(picked.select(F.col("c").alias("a"), "x"), "a")
    return both.where(near("x", "y")).select("a", "b").distinct()


def components(pairs: DataFrame) -> DataFrame:
    """(c, root): the smallest class reachable, by star contraction rounds."""
    edges = stage(pairs.select(F.col("a").alias("u"), F.col("b").alias("v")), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("r"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("r").alias("v"))
        down = large.where("u <> v").distinct()
        least = down.groupBy("u").agg(F.min("v").alias("r"))
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("r").alias("v")).where("u <> v")
        after = stage(least.select("u", F.col("r").alias("v")).unionByName(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))).distinct(), "edges")
        same = after.exceptAll(edges).isEmpty() and edges.exceptAll(after).isEmpty()
        edges = after
        if same:
            return edges.select(F.col("u").alias("c"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, threshold: float = 0.9) -> DataFrame:
    """One row per document: key, n_shingles, component_id."""

    @arrow_udf("struct<n:long,s:binary,marks:binary,low:int,high:int,front:int,spare_low:int,spare_high:int,bits:array<long>>")
    def code(col: pa.Array) -> pa.Array:
        out = []
        for found in shingle_sets(byte_values(col), words):
            marks, spare = signatures(found, threshold)
            out.append({
                "n": len(found), "s": hashlib.blake2b(found.tobytes(), digest_size=16).digest(), "marks": np.concatenate(marks).tobytes(),
                "low": len(marks[0]), "high": len(marks[1]), "front": len(marks[2]), "spare_low": spare[0], "spare_high": spare[1], "bits": parity(found),
            })
        counts = [(name, pa.int32()) for name in ("low", "high", "front", "spare_low", "spare_high")]
        return pa.array(out, pa.struct([("n", pa.int64()), ("s", pa.binary()), ("marks", pa.binary()), *counts, ("bits", pa.list_(pa.int64()))]))

    x = F.coalesce(F.col(text), F.lit(""))
    own = docs.select(F.col(key).alias("k"), x.alias("x"), F.unhex(F.sha2(x, 256)).alias("d"))
    each = own.groupBy("d").agg(F.min("k").alias("c"), F.first("x").alias("x"))
    coded = settled(each.select("d", "c", code("x").alias("v")).select(F.monotonically_increasing_id().alias("i"), "d", "c", "v.*"), "classes")
    texts = docs.select(F.col(key).alias("c"), F.col(text).alias("x"))
    found = components(links(coded.where("n > 0 AND c IS NOT NULL"), texts, words, threshold))
    # equal sets are linked, so they have one component; a null key has that of its set
    kinds = coded.where("n > 0").join(found, "c", "left").groupBy("s").agg(F.min(F.coalesce("root", "c")).alias("root"))
    member = own.select("k", "d").join(coded.select("d", "n", "s"), "d").join(kinds, "s", "left")
    return member.select(
        F.col("k").alias(key), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.coalesce("root", "k")).otherwise(F.col("k")).alias("component_id"),
    )


def q_op1(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op1_ngram_jaccard": q_op1}
ORACLE_SQL: dict[str, str] = {}

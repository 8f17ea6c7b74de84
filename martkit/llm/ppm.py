"""Language-model scoring by prediction by partial matching (operator 8).

A trie over byte contexts of 0 to ``order`` bytes holds how often each byte, or
the end, followed each context in the training texts.  A symbol is coded in the
longest known context; one that the context never saw costs an escape (number
of distinct followers over occurrences plus followers), after which the next
shorter context is used without the symbols just ruled out, down to a uniform
choice.  A score is the log10 probability of the whole text and its end.

* The trie covers all training texts and lives in a table: a row for each
  context and symbol that followed it, with the count and what the context holds
  in all.  Shorter contexts are summed from the longest.
* A symbol costs the same wherever its longest context precedes it.  So each
  different gram (that context and the symbol) is priced once for the corpus, by
  equi-joins with the trie, from the longest context down.
* Texts are cut into blocks of bounded bytes, grams into parts by their context,
  one for each ``PART_BYTES`` of text.  The grams of a block and part travel as
  one row of packed numbers; they are counted by part, and meet their prices by
  part, which go back in the order of the grams.  Each block is scored beside its
  answer in one cogroup: memory follows the block and the part, not the corpus;
  nothing is broadcast and only three sums reach the driver.
* Word counts for the unigram base are joined by word.

Defined cases: null text is empty (one end); a null key is kept, and is
training (its remainder is unknown); repeated rows count and are scored each;
without training texts every symbol is uniform; other columns never take part.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from martkit.llm.common import byte_values, held_out, settled, table

ORDER = 4
BLOCK_BYTES = 8 << 20
PART_BYTES = 16 << 20  # bytes of texts whose grams make one part
END = 256
SYMBOL_BITS = 9


def blocks(docs: DataFrame, key: str, text: str, train: Column, block_bytes: int) -> DataFrame:
    """(k, x, trained, block): consecutive texts, at most ``block_bytes`` or one text."""
    plain = docs.select(F.col(key).alias("k"), F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8").alias("x"), F.coalesce(train, F.lit(False)).alias("trained"))
    schema = StructType([*plain.schema.fields, StructField("block", LongType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, filled = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            ids = []
            for raw in batch.column("x"):
                size = len(raw.as_buffer()) + 64
                if filled and filled + size > block_bytes:
                    number, filled = number + 1, 0
                filled += size
                ids.append(number)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.int64())], names=[*batch.schema.names, "block"])

    return settled(plain.mapInArrow(cut, schema), "blocks")


def compact(codes: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, all below ``bound``, and the number of each code among them."""
    if bound > max(1 << 20, 4 * len(codes)):
        return np.unique(codes, return_inverse=True)
    seen = np.zeros(bound, dtype=bool)
    seen[codes] = True
    values = np.flatnonzero(seen)
    number = np.zeros(bound, dtype=np.int32)
    number[values] = np.arange(len(values), dtype=np.int32)
    return values, number[codes]


def longest_grams(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams, and the gram of each byte and end of the texts in turn.
    A gram is the context of ``order`` bytes (zeros before the text), last byte
    lowest, and the symbol.  Contexts are numbered one byte longer at a time."""
    pad = bytes(order)
    codes = np.frombuffer(b"".join(pad + t + b"\0" for t in texts), dtype=np.uint8)
    lengths = np.array([len(t) for t in texts], dtype=np.int64) + order + 1
    stops = np.cumsum(lengths)
    predicted = np.ones(len(codes), dtype=bool)
    for i in range(order):
        predicted[stops - lengths + i] = False
    at = np.flatnonzero(predicted).astype(np.int32 if len(codes) < 1 << 31 else np.int64)
    ids, contexts = np.zeros(len(at), dtype=np.int32), np.zeros(1, dtype=np.int64)
    for back in range(1, order + 1):
        values, ids = compact(ids.astype(np.int64) * 256 + codes[at - back], len(contexts) * 256)
        contexts = contexts[values // 256] | (values % 256 << (8 * (back - 1)))
    symbols = codes.astype(np.int16)
    symbols[stops - 1] = END
    values, ids = compact(ids.astype(np.int64) * (END + 1) + symbols[at], len(contexts) * (END + 1))
    return (contexts[values // (END + 1)] << SYMBOL_BITS) | values % (END + 1), ids


def shortened(grams: np.ndarray, length: int, order: int) -> np.ndarray:
    """The rows of the trie for contexts cut to ``length`` bytes."""
    context = (grams >> SYMBOL_BITS) & ((1 << (8 * length)) - 1)
    return (((length << (8 * order)) | context) << SYMBOL_BITS) | (grams & ((1 << SYMBOL_BITS) - 1))


def word_key(word: bytes) -> bytes:
    """The word itself, or the 32-byte digest of one of 32 bytes or more."""
    return word if len(word) < 32 else hashlib.sha256(word).digest()


def packed(values: np.ndarray) -> bytes:
    """8-byte numbers with their first bytes together, then the second and so on;
    of whole numbers the steps, which are small where numbers ascend."""
    if values.dtype != np.float64:
        values = np.diff(values.astype(np.int64), prepend=np.int64(0))
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(raw: bytes, kind: type = np.int64) -> np.ndarray:
    values = np.frombuffer(raw, dtype=np.uint8).reshape(8, -1).T.copy().view(kind).ravel()
    return values if kind is np.float64 else np.cumsum(values)


def by_part(grams: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(parts that grams fall into, where each starts, order by part and gram)."""
    part = (grams >> SYMBOL_BITS) % parts
    order = np.lexsort((grams, part))
    held, starts = np.unique(part[order], return_index=True)
    return held, starts, order


GRAM, WORD = 0, 1
SEEN = "block long, part long, codes binary, counts binary, w binary, n long"


def gather(order: int):
    """Rows of a batch: for each block its grams and its words, with the counts
    of them in its training texts, 0 for others."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column("block").to_numpy()
            for block in np.unique(held).tolist():
                part = batch.filter(pa.array(held == block))
                texts = [raw.lower() for raw in byte_values(part.column("x"))]
                trained = part.column("trained").to_pylist()
                visited, ids = longest_grams(texts, order)
                use = np.repeat(np.array(trained, dtype=bool), [len(t) + 1 for t in texts])
                times = np.bincount(ids[use], minlength=len(visited))
                del ids, use
                yield _rows(GRAM, block, visited, times.astype(np.int64))
                words = Counter(b" ".join(t for t, yes in zip(texts, trained, strict=True) if yes).split())
                for w in set(b" ".join(t for t, yes in zip(texts, trained, strict=True) if not yes).split()):
                    words.setdefault(w, 0)
                for w in [w for w in words if len(w) >= 32]:
                    words[word_key(w)] = words.pop(w)
                words[b""] = sum(trained)  # the end
                size = len(words)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([WORD] * size, pa.int32()), pa.array([block] * size, pa.int64()), pa.nulls(size, pa.int64()),
                     pa.array(list(words), pa.binary()), pa.array(list(words.values()), pa.int64())],
                    names=["kind", "block", "code", "w", "n"],
                )

    return rows


def _rows(kind: int, block: int, codes: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    size = len(codes)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(size, kind, np.int32)), pa.array(np.full(size, block, np.int64)), pa.array(codes.astype(np.int64)),
         pa.nulls(size, pa.binary()), pa.array(n)],
        names=["kind", "block", "code", "w", "n"],
    )


def gather_parts(order: int, parts: int):
    """The rows of ``gather``, with the grams of a block and part in one."""
    seen = gather(order)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in seen(batches):
            if batch.column("kind")[0].as_py() == WORD:
                none, nulls = pa.nulls(len(batch), pa.binary()), pa.nulls(len(batch), pa.int64())
                columns = [batch.column("block"), nulls, none, none, batch.column("w"), batch.column("n")]
            else:
                grams, times = batch.column("code").to_numpy(), batch.column("n").to_numpy()
                found, starts, by = by_part(grams, parts)
                codes, counts = (pa.array([packed(y) for y in np.split(x[by], starts[1:])], pa.binary()) for x in (grams, times))
                block = pa.array(np.full(len(found), batch.column("block")[0].as_py(), np.int64))
                columns = [block, pa.array(found, pa.int64()), codes, counts, pa.nulls(len(found), pa.binary()), pa.nulls(len(found), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "part", "codes", "counts", "w", "n"])

    return rows


def counted_grams(rows: pa.Table) -> pa.Table:
    """(code, n) of the different grams of a part."""
    codes = np.concatenate([unpacked(x) for x in rows.column("codes").to_pylist()])
    counts = np.concatenate([unpacked(x) for x in rows.column("counts").to_pylist()])
    values, at = np.unique(codes, return_inverse=True)
    return pa.table({"code": pa.array(values), "n": pa.array(np.bincount(at, counts).astype(np.int64))})


def part_prices(priced: pa.Table, asked: pa.Table) -> pa.Table:
    """(block, part, prices): for each block that asks, the prices of its grams of
    this part, in the order of the grams."""
    codes, prices = priced.column("code").to_numpy(), priced.column("price").to_numpy()
    by = np.argsort(codes)
    codes, prices = codes[by], prices[by]
    wanted: dict[int, list[np.ndarray]] = {}  # a block whose texts came in several batches has several rows
    for block, raw in zip(asked.column("block").to_pylist(), asked.column("codes").to_pylist(), strict=True):
        wanted.setdefault(block, []).append(unpacked(raw))
    out = [packed(prices[np.searchsorted(codes, np.unique(np.concatenate(x)))]) for x in wanted.values()]
    part = asked.column("part")[: 1].to_pylist() * len(out)
    return pa.table({"block": pa.array(list(wanted), pa.int64()), "part": pa.array(part, pa.int64()), "prices": pa.array(out, pa.binary())})


def row_of(gram: Column, length: int, order: int) -> Column:
    """``shortened`` of a column of grams."""
    context = F.shiftright(gram, SYMBOL_BITS).bitwiseAND((1 << (8 * length)) - 1)
    symbol = gram.bitwiseAND((1 << SYMBOL_BITS) - 1)
    return F.shiftleft(context.bitwiseOR(F.lit(length << (8 * order)).cast("long")), SYMBOL_BITS).bitwiseOR(symbol)


def trie_levels(grams: DataFrame, order: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """By context length: rows (row, count) of the symbols that followed contexts,
    and contexts (node, total, kinds, excluded), the last the occurrences, in the
    context one byte shorter, of the symbols that followed it."""
    longest = grams.where("n > 0").select(row_of(F.col("code"), order, order).alias("row"), F.col("n").alias("count"))
    rows = [settled(longest, "trie")]
    symbol = F.col("row").bitwiseAND((1 << SYMBOL_BITS) - 1)
    gram = lambda length: F.shiftleft(F.shiftright("row", SYMBOL_BITS).bitwiseAND((1 << (8 * length)) - 1), SYMBOL_BITS).bitwiseOR(symbol)
    for length in range(order - 1, -1, -1):
        cut = rows[0].select(row_of(gram(length), length, order).alias("row"), "count")
        rows.insert(0, settled(cut.groupBy("row").agg(F.sum("count").alias("count")), "trie"))
    nodes = []
    for length in range(order + 1):
        shorter = F.lit(0).cast("long")
        known = rows[length]
        if length:
            below = rows[length - 1].select(F.col("row").alias("below"), F.col("count").alias("shorter"))
            known = known.withColumn("below", row_of(gram(length - 1), length - 1, order)).join(below, "below")
            shorter = F.col("shorter")
        node = F.shiftright("row", SYMBOL_BITS).alias("node")
        nodes.append(known.groupBy(node).agg(F.sum("count").alias("total"), F.count("*").alias("kinds"), F.sum(shorter).alias("excluded")))
    return rows, nodes


def gram_prices(grams: DataFrame, order: int) -> DataFrame:
    """(code, price): log10 probability of each different gram (code, n), n its
    occurrences in training texts."""
    rows, nodes = trie_levels(grams, order)
    zero = F.lit(0).cast("long")
    left = grams.select("code", F.lit(0.0).alias("price"), zero.alias("less"), zero.alias("less_kinds"))
    done = None
    for length in range(order, -1, -1):
        row = row_of(F.col("code"), length, order)
        asked = left.withColumn("row", row).withColumn("node", F.shiftright("row", SYMBOL_BITS))
        asked = asked.join(rows[length], "row", "left").join(nodes[length], "node", "left")
        free = F.col("kinds") - F.col("less_kinds")
        space = F.col("total") - F.col("less") + free
        escape = F.when(F.col("kinds").isNotNull() & (free > 0), F.log10(free / space)).otherwise(0.0)
        coded = F.col("count").isNotNull()
        asked = settled(asked.select(
            "code", (F.col("price") + F.when(coded, F.log10(F.col("count") / space)).otherwise(escape)).alias("price"), coded.alias("coded"),
            F.coalesce("excluded", "less").alias("less"), F.coalesce("kinds", "less_kinds").alias("less_kinds"),
        ), "prices")
        found = asked.where("coded").select("code", "price")
        done = found if done is None else done.unionByName(found)
        left = asked.where("NOT coded").drop("coded")
    never = left.select("code", (F.col("price") - F.log10(F.lit(END + 1) - F.col("less_kinds"))).alias("price"))
    return done.unionByName(never)


def score_block(order: int, parts: int, n: int, v: int):
    """Scores of a block's texts from the prices and word counts it asked for."""
    floor = n + (v + 1)

    def score(texts: pa.Table, answers: pa.Table) -> pa.Table:
        raws = [raw.lower() for raw in byte_values(texts.column("x"))]
        asked = answers.filter(pa.compute.is_valid(answers.column("part"))).sort_by("part")
        grams, where = longest_grams(raws, order)
        prices = np.empty(len(grams))
        prices[by_part(grams, parts)[2]] = np.concatenate([unpacked(x, np.float64) for x in asked.column("prices").to_pylist()])
        each = prices[where]
        starts = np.cumsum([0, *(len(t) + 1 for t in raws[:-1])])
        total = np.add.reduceat(each, starts)
        told = answers.filter(pa.compute.is_valid(answers.column("w")))
        known = dict(zip(told.column("w").to_pylist(), told.column("c").to_pylist(), strict=True))
        logs = {w: math.log10((c + 1) / floor) for w, c in known.items()}
        unknown = math.log10(1 / floor)
        n_tokens, n_known, base = [], [], []
        for raw in raws:
            words = [logs.get(w if len(w) < 32 else word_key(w), unknown) for w in raw.split()] + [logs.get(b"", unknown)]
            n_tokens.append(len(words))
            n_known.append(len(words) - words.count(unknown))  # a known one's is larger
            base.append(math.fsum(words))
        return pa.table({
            "k": texts.column("k"), "trained": texts.column("trained"), "n_tokens": pa.array(n_tokens, pa.int64()),
            "n_known": pa.array(n_known, pa.int64()), "base_score": pa.array(base, pa.float64()), "score": pa.array(total, pa.float64()),
        })

    return score


def ppm_scores(docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text", order: int = ORDER, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: key, trained, n_tokens, n_known, train_tokens,
    base_score, score."""
    held = blocks(docs, key, text, train, block_bytes)
    size = held.agg(F.sum(F.octet_length("x"))).first()[0] or 0
    parts = size // PART_BYTES | 1
    seen = settled(held.select("x", "trained", "block").mapInArrow(gather_parts(order, parts), SEEN), "seen")
    visits = seen.where("part IS NOT NULL")
    grams = settled(visits.select("part", "codes", "counts").groupBy("part").applyInArrow(counted_grams, "code long, n long"), "grams")
    part = F.pmod(F.shiftright("code", SYMBOL_BITS), F.lit(parts)).alias("part")
    prices = gram_prices(grams, order).select(part, "code", "price")
    asked = visits.select("part", "block", "codes")
    told = prices.groupBy("part").cogroup(asked.groupBy("part")).applyInArrow(part_prices, "block long, part long, prices binary")
    told = settled(told, "answers")
    word = seen.where("part IS NULL").select("block", "w", "n")
    counted = settled(word.groupBy("w").agg(F.sum("n").alias("c")).where("c > 0"), "words")
    n, v = counted.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    nothing = F.lit(None)
    answers = told.select("block", "part", "prices", nothing.cast("binary").alias("w"), nothing.cast("long").alias("c"))
    known = settled(word.join(counted, "w").select("block", "w", "c"), "known")
    answers = answers.unionByName(known.select("block", nothing.cast("long").alias("part"), nothing.cast("binary").alias("prices"), "w", "c"))
    schema = StructType([held.schema["k"], held.schema["trained"]] + StructType.fromDDL(
        "n_tokens long, n_known long, base_score double, score double").fields)
    scored = held.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score_block(order, parts, n, v), schema)
    return scored.select(F.col("k").alias(key), "trained", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")


def q_op8(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = ppm_scores(docs, ~held_out(F.col("doc_id"), 7, 2))
    return found.select("doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUERIES = {"op8_ppm_scoring": q_op8}
ORACLE_SQL: dict[str, str] = {}

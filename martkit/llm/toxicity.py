"""Toxicity by a linear classifier over character n-grams (operator 3).

A text's features are the hashed n-grams of its lower-cased bytes, present or
not.  Each is scaled by its naive Bayes log-count ratio between toxic and other
labelled texts, and a logistic model is fitted on the scaled features.

* Counts: every labelled training text is counted, in tasks, into ``buckets``
  pairs of sums; a task sends on slices of them, in the narrowest whole numbers
  that hold its own counts, and the driver gets two vectors of fixed size.
* Fit: on at most ``fit_rows`` texts of each class (those with the smallest
  hash of their key).  They are chosen among the keys alone, so only their own texts
  are fetched; their selected features reach the driver compressed and take 4 bytes each,
  where the gradient steps read them in blocks.  This bound does not touch the counts, and
  the weight of a class is the root of its share of all training rows, so the
  model's prior is the same at every size.
* Score: one weight vector of ``buckets`` floats (4 MB) travels to the tasks;
  whole texts are scored with no shuffle.

Labels, languages, sources and keys are never inputs of a score.

Defined cases: null or empty text has no features, its score is the model's
prior; rows with a null key are never training rows; repeated rows count each;
a table without training rows or with one class gives the class share as score.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from martkit.llm.common import byte_values, held_out, stage, table
from martkit.operators.pruning import AUTO_PRUNE, key_stats, narrow

MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    lengths: tuple = (4, 6, 8)
    bits: int = 20  # 2**bits buckets of n-grams
    shrink: float = 5.0  # texts a ratio must outweigh before it departs from 0
    min_z: float = 3.0  # ratios within so many standard errors of 0 get no weight
    fit_rows: int = 8000  # texts of each class for the fit, at most
    l2: float = 1e-4
    steps: int = 300
    rate: float = 0.05


def features(raw: bytes, s: Settings) -> np.ndarray:
    """Bucket of every n-gram of a text (repeats kept)."""
    padded = b" " + raw.lower().translate(SPACES) + b" "
    codes = np.frombuffer(padded, dtype=np.uint8).astype(np.uint64)
    out = []
    packed = codes
    for n in range(2, max(s.lengths) + 1):
        if n > len(codes):
            break
        packed = (packed[:-1] << np.uint64(8)) | codes[n - 1 :]
        if n in s.lengths:
            out.append((((packed + np.uint64(n)) * MIX) >> np.uint64(64 - s.bits)).astype(np.int32))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int32)


BLOCK = 1 << 20  # features a gradient step handles at once
SENT = pa.schema([("slice", pa.int32()), ("toxic", pa.binary()), ("other", pa.binary()), ("texts", pa.binary())])
SPACES = bytes(32 if b <= 32 else b for b in range(256))


SLICES = 256  # parts of the vector of buckets that travel apart


def _narrow(counts: np.ndarray) -> np.ndarray:
    """The same counts in the smallest type that holds them."""
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0))))


def class_counts(labelled: DataFrame, s: Settings) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Texts of each class that hold each bucket: (toxic, other, totals)."""
    size = 1 << s.bits
    part = max(1, size // SLICES)
    whole = "slice int, toxic binary, other binary, texts binary"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, texts = np.zeros((2, size), dtype=np.uint32), np.zeros(2, dtype=np.int64)
        for batch in batches:
            for raw, toxic in zip(byte_values(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                kind = 0 if toxic else 1
                sums[kind][np.unique(features(raw, s))] += 1
                texts[kind] += 1
        for at in range(0, size if texts.any() else 0, part):
            toxic, other = (_narrow(own[at : at + part]).tobytes() for own in sums)
            totals = (texts if at == 0 else 0 * texts).tobytes()
            yield pa.RecordBatch.from_pylist([{"slice": at // part, "toxic": toxic, "other": other, "texts": totals}], SENT)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, texts, number = np.zeros((2, part), dtype=np.int64), np.zeros(2, dtype=np.int64), 0
        for batch in batches:
            for row in batch.to_pylist():
                number = row["slice"]
                for kind, sent in enumerate((row["toxic"], row["other"])):
                    sums[kind] += np.frombuffer(sent, dtype=f"<u{len(sent) // part}")
                texts += np.frombuffer(row["texts"], dtype="<i8")
        row = {"slice": number, "toxic": sums[0].tobytes(), "other": sums[1].tobytes(), "texts": texts.tobytes()}
        yield pa.RecordBatch.from_pylist([row], SENT)

    rows = labelled.select("text", "toxic").mapInArrow(count, whole).groupBy("slice").applyInArrow(add, whole).toArrow()
    sums, texts = np.zeros((2, size), dtype=np.int64), np.zeros(2, dtype=np.int64)
    for row in rows.to_pylist():
        place = slice(row["slice"] * part, (row["slice"] + 1) * part)
        sums[0][place], sums[1][place] = np.frombuffer(row["toxic"], "<i8"), np.frombuffer(row["other"], "<i8")
        texts += np.frombuffer(row["texts"], "<i8")
    return sums[0], sums[1], int(texts[0]), int(texts[1])


def log_ratios(toxic: np.ndarray, other: np.ndarray, n_toxic: int, n_other: int, s: Settings) -> np.ndarray:
    """Log of the rate among toxic texts over the rate among others, drawn to 0
    by ``shrink`` texts of average mix; ratios that chance explains are set to 0."""
    share = n_toxic / (n_toxic + n_other)
    r = np.log((toxic + s.shrink * share) / n_toxic) - np.log((other + s.shrink * (1 - share)) / n_other)
    r -= np.log((s.shrink * share) / n_toxic) - np.log((s.shrink * (1 - share)) / n_other)
    plain = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((other + 0.5) / (n_other + 1))
    error = np.sqrt(1 / (toxic + 0.5) + 1 / (other + 0.5))
    # between classes of very different size a rare bucket's two ratios can differ in sign
    sure = (np.abs(plain) >= s.min_z * error) & (plain * r > 0)
    return np.where(sure, r, 0.0).astype(np.float32)


def fit_sample(labelled: DataFrame, ratios: np.ndarray, s: Settings):
    """(features by row, offsets, labels) of the bounded sample."""
    by_key = [F.xxhash64("key"), F.col("key")]
    kinds = [F.col("toxic") == kind for kind in (True, False)]
    # keys first: at most fit_rows of each class, whatever the table's size
    first = [labelled.select("key", "toxic").where(kind).orderBy(*by_key).limit(s.fit_rows) for kind in kinds]
    keys = stage(first[0].unionByName(first[1]).select("key").distinct(), "fit_keys")
    chosen = labelled.join(F.broadcast(keys), "key", "left_semi")
    parts = [
        chosen.where(kind).orderBy(*by_key, F.xxhash64("text")).limit(s.fit_rows).select("text", "toxic") for kind in kinds
    ]

    @arrow_udf("binary")
    def held(texts: pa.Array) -> pa.Array:
        found = (np.unique(features(raw, s)) for raw in byte_values(texts))
        return pa.array([packed(b[ratios[b] != 0]) for b in found], pa.binary())

    rows = parts[0].unionByName(parts[1]).select(held("text").alias("f"), "toxic").toArrow()
    lists = [unpacked(f.as_buffer()) for f in rows.column("f")]
    return lists, np.array(rows.column("toxic").to_pylist(), dtype=bool)


def packed(buckets: np.ndarray) -> bytes:
    """Ascending buckets as compressed steps, a third of their size or less."""
    return zlib.compress(np.diff(buckets, prepend=np.int32(0)).astype("<i4").tobytes(), 1)


def unpacked(raw) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(raw), dtype="<i4"), dtype=np.int32)


def _blocks(lists: list[np.ndarray], place: np.ndarray) -> list[tuple]:
    """(rows, sizes, starts, columns): the rows with features, in blocks of about BLOCK.
    ``lists`` is emptied on the way, so no feature is held twice."""
    out, rows, size = [], [], 0
    for row, buckets in enumerate(lists):
        if len(buckets):
            rows.append(row)
            size += len(buckets)
        if rows and (size >= BLOCK or row == len(lists) - 1):
            sizes = np.array([len(lists[r]) for r in rows])
            out.append((np.array(rows), sizes, np.cumsum(sizes) - sizes, place[np.concatenate([lists[r] for r in rows])]))
            for r in rows:
                lists[r] = ()
            rows, size = [], 0
    return out


def fit(lists: list[np.ndarray], toxic: np.ndarray, ratios: np.ndarray, share: float, s: Settings) -> tuple[np.ndarray, float]:
    """Logistic regression on ratio-scaled features by adaptive gradient steps;
    ``share`` is that of toxic texts in the whole table.  ``lists`` is used up."""
    held = np.zeros(len(ratios), dtype=bool)
    for buckets in lists:
        held[buckets] = True
    used = np.flatnonzero(held)
    blocks = _blocks(lists, np.cumsum(held, dtype=np.int32) - np.int32(1))
    scaled = ratios[used].astype(np.float64)
    y = toxic.astype(np.float64)
    weight = np.where(toxic, share**0.5 / max(1, toxic.sum()), (1 - share) ** 0.5 / max(1, (~toxic).sum()))
    weight /= weight.sum()
    p = np.zeros(len(used) + 1)  # the last one is the bias
    mean, square = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, s.steps + 1):
        own = p[:-1] * scaled
        margin = np.full(len(y), p[-1])
        for rows, sizes, starts, columns in blocks:
            margin[rows] += np.add.reduceat(own[columns], starts)
        slope = weight * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y)
        gradient = np.zeros(len(used))
        for rows, sizes, _, columns in blocks:
            gradient += np.bincount(columns, weights=np.repeat(slope[rows], sizes), minlength=len(used))
        gradient = np.append(gradient * scaled + s.l2 * p[:-1], slope.sum())
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        p -= s.rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    weights = np.zeros(len(ratios), dtype=np.float32)
    weights[used] = p[:-1] * scaled
    return weights, float(p[-1])


@dataclass(frozen=True)
class ToxicityModel:
    weights: np.ndarray
    bias: float
    settings: Settings

    def score(self, raw: bytes) -> float:
        buckets = features(raw, self.settings)
        w = self.weights[buckets]
        held = w != 0
        if held.any():
            _, first = np.unique(buckets[held], return_index=True)
            margin = float(w[held][first].astype(np.float64).sum()) + self.bias
        else:
            margin = self.bias
        return float(1 / (1 + np.exp(-min(30.0, max(-30.0, margin)))))

    def column(self, text):
        model = self

        @arrow_udf("double")
        def scores(texts: pa.Array) -> pa.Array:
            return pa.array([model.score(raw) for raw in byte_values(texts)], pa.float64())

        return scores(text)


def train(labelled: DataFrame, settings: Settings | None = None) -> ToxicityModel:
    """Model from rows (key, text, toxic boolean)."""
    s = settings or Settings()
    toxic, other, n_toxic, n_other = class_counts(labelled, s)
    if not n_toxic or not n_other:
        share = n_toxic / max(1, n_toxic + n_other)
        bias = 30.0 * np.sign(share - 0.5) if n_toxic + n_other else 0.0
        return ToxicityModel(np.zeros(1 << s.bits, np.float32), float(bias), s)
    ratios = log_ratios(toxic, other, n_toxic, n_other, s)
    lists, labels = fit_sample(labelled, ratios, s)
    weights, bias = fit(lists, labels, ratios, n_toxic / (n_toxic + n_other), s)
    return ToxicityModel(weights, bias, s)


def labelled_texts(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, text, toxic) of the labelled texts, one for each of their marks.
    Marks within the measured bound go to the texts; beyond it texts without a mark
    are left out where they are read, and the others are shuffled."""
    marks = labels.select(F.col(key).alias("key"), (F.col("toxic") == 1).alias("toxic")).where("toxic IS NOT NULL")
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    stats = key_stats(marks, ["key", "toxic"])
    if stats.fits(AUTO_PRUNE):
        return texts.join(F.broadcast(marks), "key")
    return narrow(texts, marks, ["key"]).join(marks, "key")


def q_op3(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = held_out(F.col("doc_id"), 3, 1)
    model = train(labelled_texts(docs.where(~out), labels.where(~out)))
    scored = docs.select("doc_id", out.alias("held_out"), model.column(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


QUERIES = {"op3_toxicity": q_op3}
ORACLE_SQL: dict[str, str] = {}

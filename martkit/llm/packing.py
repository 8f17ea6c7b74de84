"""Vector bin packing of tokenised examples (operator 2).

Every task packs the examples it reads, so nothing is shuffled: an example has
a demand vector (tokens, one segment, loss-bearing tokens) and a sequence a
capacity vector.  A sequence is filled by the dot-product heuristic: of the
waiting pieces that fit, take the one whose demand has the largest dot product
with what is still free, both as shares of the capacity.  When nothing fits, a
waiting piece is cut to fill the free tokens.  What is left at a task's end is
cut into sequences whose lengths are powers of two, which need no padding.

A task holds at most ``waiting`` pieces, each under one sequence long, or as many
short ones as do not fill a sequence.  Plain texts have no limit of segments.

Defined cases: null or empty text is the end id alone; null keys and repeated
rows are packed like any other row; other columns are not read.  An empty table
gives no pieces.  Sequence numbers are unique within one run: the task's
partition in the upper bits, a counter below.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from martkit.llm.common import table

END_ID = 1
# Before " x" the pre-tokeniser always cuts, whatever stands around it, so the
# ids of a text are the ids of these units one after the other.
UNIT = re.compile(r"(?= \w)")
# Fixed value: the pattern by which byte-level tokenisers of this kind split.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# The kind (letter, number, space) of a character up to U+024F is the same in
# every Unicode table; units with others are left to ``tokenizers``.
SLOW = re.compile("[^\x00-\u024f]")
CACHE_UNITS = 700_000
JOINED_BYTES = 200_000
_ENCODERS: dict = {}


def fast_twin(tokenizer):
    """A tiktoken encoder that gives the ids of ``tokenizer`` on texts of FAST
    characters, or None where that is not sure.

    Both split alike and merge by rank, one by pairs, the other by what a pair
    spells.  They differ only at a token whose own bytes are not merged to it, so
    every token is tried; ids must follow the order of the merges too.
    """
    import tiktoken
    from tokenizers.pre_tokenizers import ByteLevel

    kept = json.loads(tokenizer.to_str())
    model, cut = kept["model"], kept["pre_tokenizer"] or {}
    plain = model["type"] == "BPE" and not any(
        model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    )
    if not plain or kept["normalizer"] or cut.get("type") != "ByteLevel" or cut["add_prefix_space"] or not cut.get("use_regex", True):
        return None
    vocabulary = model["vocab"]
    # bytes that print stand for themselves, the others for the characters from 256 on
    own = [b for b in range(256) if chr(b) in ByteLevel.alphabet()]
    letters = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in own)}
    order = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if order != sorted(order) or any(len(tokenizer.model.tokenize(t)) != 1 for t in vocabulary):
        return None
    ranks = {bytes(letters[c] for c in token): rank for token, rank in vocabulary.items()}
    return tiktoken.Encoding("twin", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})


class UnitEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes, those that ``tokenizers``
    gives for the file.  Units seen before come from a bounded cache; new ones are
    encoded together and cut apart by the byte lengths of their tokens.  A text with
    the string of an added token is encoded whole."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.twin = fast_twin(self.tokenizer)
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(added)) if added else None
        vocabulary = self.tokenizer.get_vocab()
        self.token_bytes = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, number in vocabulary.items():
            self.token_bytes[number] = len(token)  # byte-level: one character a byte
        self.cache: dict[str, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        # the fast form leaves out offsets, which nothing here reads
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _joined_ids(self, text: str, fast: bool) -> np.ndarray:
        return self.twin.encode_to_numpy(text, disallowed_special=()).astype("<u4") if fast else self._ids(text)

    def _learn(self, units: list[str], fast: bool) -> None:
        sizes = np.cumsum([len(u.encode()) for u in units])
        at = 0
        while at < len(units):
            done = sizes[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(sizes, done + JOINED_BYTES)))
            ids = self._joined_ids("".join(units[at:to]), fast)
            ends = np.cumsum(self.token_bytes[ids])
            cuts = np.searchsorted(ends, sizes[at:to] - done)
            whole = cuts < len(ends)
            if whole.all() and (ends[cuts] == sizes[at:to] - done).all():
                raw, stops = ids.tobytes(), (4 * cuts + 4).tolist()
                starts = [0, *stops[:-1]]
                self.cache.update(zip(units[at:to], [raw[a:b] for a, b in zip(starts, stops, strict=True)], strict=True))
            else:  # a tokeniser whose ids don't spell the bytes: one by one
                for unit in units[at:to]:
                    self.cache[unit] = self._ids(unit).tobytes()
            at = to

    def encode(self, texts: list[str]) -> list[bytes]:
        whole = [self.added is not None and self.added.search(text) is not None for text in texts]
        parts = [UNIT.split(text) if text and not w else [] for text, w in zip(texts, whole, strict=True)]
        inner: set[str] = set()
        for units in parts:
            inner.update(units[1:])
        if len(self.cache) > CACHE_UNITS:
            self.cache.clear()
        fresh = [u for u in inner if u not in self.cache]
        if self.twin is not None:
            self._learn([u for u in fresh if not SLOW.search(u)], True)
            fresh = [u for u in fresh if SLOW.search(u)]
        self._learn(fresh, False)
        get = self.cache.__getitem__
        out = []
        for text, units, w in zip(texts, parts, whole, strict=True):
            # the first unit has no space before it, so it is not joined to others
            first = self._ids(text if w else units[0]).tobytes() if w or units else b""
            out.append(first + b"".join(map(get, units[1:])))
        return out


def encoder(path: str) -> UnitEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = UnitEncoder(path)
    return _ENCODERS[path]


def token_ids(text, path: str, end_id: int | None = END_ID):
    """Binary column of a text's ids (little-endian unsigned 32-bit), then ``end_id``."""

    @arrow_udf("binary")
    def encode(texts: pa.Array) -> pa.Array:
        return pa.array(coded(texts, path, end_id), pa.binary())

    return encode(text)


def coded(texts: pa.Array, path: str, end_id: int | None) -> list[bytes]:
    """Ids of a batch's texts, 256 texts at a time."""
    own, end = encoder(path), b"" if end_id is None else np.array([end_id], dtype="<u4").tobytes()
    out: list[bytes] = []
    for at in range(0, len(texts), 256):
        out += [ids + end for ids in own.encode([t or "" for t in texts[at : at + 256].to_pylist()])]
    return out


@dataclass(frozen=True)
class Limits:
    """Capacity of one sequence."""

    tokens: int = 2048
    segments: int = 256
    loss_tokens: int = 2048
    waiting: int = 1024


class _Packer:
    """Fills sequences from the pieces that wait; yields rows (piece index data)."""

    def __init__(self, limits: Limits, cut: bool, first_id: int):
        self.limits, self.cut, self.next_id = limits, cut, first_id
        self.pieces: list = []  # (key, ids, start, length, prompt, doc_tokens), or None when placed
        # a row for tokens, segments and loss; tokens of a placed piece are infinite, so it fits nowhere
        self.demand = np.zeros((3, 1024))
        self.capacity = np.array([limits.tokens, limits.segments, limits.loss_tokens], dtype=float)
        self.n_waiting = self.tokens_waiting = 0

    @staticmethod
    def _loss(start: int, length: int, prompt: int) -> int:
        return max(0, start + length - max(start, prompt))

    def _emit(self, rows: list, sequence: list) -> None:
        offset = 0
        for key, ids, start, length, _, doc_tokens in sequence:
            rows.append((key, start, length, doc_tokens, self.next_id, offset, ids[4 * start : 4 * (start + length)]))
            offset += length
        self.next_id += 1

    def add(self, key, ids: bytes, prompt: int, rows: list) -> None:
        """Pieces that fill a whole sequence leave at once; the rest waits."""
        limits, n, start = self.limits, len(ids) // 4, 0
        while n - start >= limits.tokens and self._loss(start, limits.tokens, prompt) <= limits.loss_tokens:
            self._emit(rows, [(key, ids, start, limits.tokens, prompt, n)])
            start += limits.tokens
        while start < n:  # more than one piece only under a tighter loss limit
            length = min(n - start, limits.tokens)
            over = self._loss(start, length, prompt) - limits.loss_tokens
            length -= max(0, over)
            self._wait((key, ids[4 * start : 4 * (start + length)], 0, length, max(0, prompt - start), n), start)
            start += length
        # pieces that don't yet fill a sequence wait on, so that none is left half empty
        while self.n_waiting > limits.waiting and (self.tokens_waiting >= limits.tokens or self.n_waiting > limits.segments):
            self._fill(rows)

    def _wait(self, piece: tuple, base: int) -> None:
        if len(self.pieces) == self.demand.shape[1]:  # forget the places of placed pieces
            held = [i for i, p in enumerate(self.pieces) if p is not None]
            self.pieces = [self.pieces[i] for i in held]
            kept = self.demand[:, held]
            self.demand = np.zeros((3, 512 + len(held) + len(held) // 2))
            self.demand[:, : len(held)] = kept
        key, ids, start, length, prompt, n = piece
        self.demand[:, len(self.pieces)] = (length, 1, self._loss(start, length, prompt))
        self.pieces.append((key, ids, start, length, prompt, n, base))
        self.n_waiting += 1
        self.tokens_waiting += length

    def _take(self, i: int, length: int | None = None) -> tuple:
        key, ids, start, own, prompt, n, base = self.pieces[i]
        if length is None or length == own:
            self.pieces[i] = None
            self.demand[:, i] = (np.inf, 0, 0)
            self.n_waiting -= 1
            self.tokens_waiting -= own
            return (key, ids, start, own, prompt, n, base)
        self.tokens_waiting -= length
        self.pieces[i] = (key, ids, start + length, own - length, prompt, n, base)
        self.demand[:, i] = (own - length, 1, self._loss(start + length, own - length, prompt))
        return (key, ids, start, length, prompt, n, base)

    def _fill(self, rows: list) -> list:
        """Fill and emit one sequence."""
        sequence, free = [], self.capacity.copy()
        tokens, segments, loss = demand = self.demand[:, : len(self.pieces)]
        shares = 1 / (self.capacity * self.capacity)
        while self.n_waiting and free[1] >= 1 and free[0] >= 1:
            fits = np.flatnonzero((tokens <= free[0]) & (loss <= free[2]))
            if len(fits):
                i = int(fits[np.argmax((free * shares) @ demand[:, fits])])
                piece = self._take(i)
            elif self.cut:
                # the longest piece is cut to what is free, the loss limit included
                i = int(np.argmax(np.where(segments > 0, tokens, 0)))
                _, _, start, own, prompt, _, _ = self.pieces[i]
                length = min(int(free[0]), own)
                length -= max(0, self._loss(start, length, prompt) - int(free[2]))
                if length < 1:
                    break
                piece = self._take(i, length)
            else:
                break
            free -= (piece[3], 1, self._loss(piece[2], piece[3], piece[4]))
            sequence.append(piece)
        self._close(rows, sequence)
        return sequence

    def _close(self, rows: list, sequence: list) -> None:
        offset = 0
        for key, ids, start, length, _, n, base in sequence:
            rows.append((key, base + start, length, n, self.next_id, offset, ids[4 * start : 4 * (start + length)]))
            offset += length
        if sequence:
            self.next_id += 1

    def finish(self, rows: list) -> None:
        while self.n_waiting:
            waiting = self.tokens_waiting
            if not self.cut or waiting >= self.limits.tokens or self.n_waiting > self.limits.segments:
                self._fill(rows)
                continue
            # the rest: sequences as long as the powers of two that add up to it
            size = 1 << (waiting.bit_length() - 1)
            sequence, free = [], size
            loss = self.limits.loss_tokens
            for i, p in enumerate(self.pieces):
                if p is None or not free or not loss:
                    continue
                length = min(free, p[3])
                length -= max(0, self._loss(p[2], length, p[4]) - loss)
                piece = self._take(i, length)
                loss -= self._loss(piece[2], piece[3], piece[4])
                free -= length
                sequence.append(piece)
            self._close(rows, sequence)


PIECE_FIELDS = "start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def pack(
    examples: DataFrame, key: str, ids: str, prompt_tokens: str | None = None,
    limits: Limits | None = None, cut: bool = True, tokenizer: str | None = None,
) -> DataFrame:
    """Pack examples into sequences.

    ``ids`` holds little-endian unsigned 32-bit ids; the first
    ``prompt_tokens`` of an example carry no loss.  With ``cut=False`` only
    examples longer than a sequence are cut.  With ``tokenizer``, a tokenizer
    file, ``ids`` holds texts, and the packing task makes their ids itself, so
    they don't pass between processes.  Returns the key, start, length,
    doc_tokens, sequence_id, offset and the piece's ids.
    """
    own = limits or Limits()
    prompt = F.lit(0) if prompt_tokens is None else F.coalesce(F.col(prompt_tokens), F.lit(0))
    source = examples.select(F.col(key).alias("key"), F.col(ids).alias("ids"), prompt.cast("long").alias("prompt"))
    key_type = source.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(own, cut, TaskContext.get().partitionId() << 40)
        rows: list = []
        schema = None
        for batch in batches:
            schema = pa.schema([
                pa.field("key", batch.schema.field("key").type), *(pa.field(n, pa.int64()) for n in
                ("start", "length", "doc_tokens", "sequence_id", "offset")), pa.field("ids", pa.binary()),
            ])
            given = batch.column(1)
            values = given.to_pylist() if tokenizer is None else coded(given, tokenizer, END_ID)
            for k, value, p in zip(batch.column(0).to_pylist(), values, batch.column(2).to_pylist(), strict=True):
                packer.add(k, value or b"", p, rows)
                if len(rows) >= 2000:
                    yield _batch(rows, schema)
                    rows = []
        packer.finish(rows)
        if rows:
            yield _batch(rows, schema)

    return source.mapInArrow(run, f"key {key_type}, {PIECE_FIELDS}").withColumnRenamed("key", key)


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def pack_texts(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", limits: Limits | None = None) -> DataFrame:
    """Tokenise whole texts and pack them; ``tokenizer`` is a tokenizer file.
    Without ``limits`` only the tokens of a sequence are limited."""
    own = limits or Limits(segments=Limits.tokens)
    return pack(docs, key, text, limits=own, tokenizer=tokenizer)


def pieces_digest(pieces: DataFrame, key: str = "doc_id") -> DataFrame:
    return pieces.select(
        key, "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def q_op2(spark, sf_dir):
    return pieces_digest(pack_texts(table(spark, sf_dir, "documents"), default_tokenizer()))


QUERIES = {"op2_vector_packing": q_op2}
ORACLE_SQL: dict[str, str] = {}

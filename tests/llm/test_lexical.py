"""Ranked search against scores of every document computed one by one."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from martkit.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top=10):
    words = [(i, terms(t)) for i, t in docs]
    total = sum(1 for _, w in words if w)
    length = sum(len(w) for _, w in words)
    df = Counter(t for _, w in words for t in set(w))
    counted = [(i, len(w), Counter(w)) for i, w in words]
    out = []
    for item, text in items:
        asked = terms(text)
        weight = {t: math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) for t in asked if df[t]}
        scored = []
        for i, n, c in counted:
            m = 25 + 75 * n * total // length if length else 0
            s = sum(weight[t] * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in asked if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0))
        for rank, (s, null, i) in enumerate(sorted(scored)[:top], 1):
            out.append((item, rank, None if null else i, -s))
    return sorted(out, key=str)


def found(spark, docs, items, **settings):
    shards = {"shard_bytes": settings.pop("shard_bytes")} if "shard_bytes" in settings else {}
    index = lexical.build_index(spark.createDataFrame(docs, DOCS).repartition(3), **shards)
    return sorted(map(tuple, lexical.search(index, spark.createDataFrame(items, ITEMS), **settings).collect()), key=str)


def corpus(r, size, vocabulary=300):
    words = [f"w{i}" for i in range(vocabulary)]
    odds = [1 / (i + 1) for i in range(vocabulary)]
    return [(i, " ".join(r.choices(words, odds, k=r.choice([3, 20, 60, 400])))) for i in range(size)]


@pytest.mark.parametrize("shard_bytes", [3000, 1 << 24])
def test_search_against_brute_force(spark, shard_bytes):
    r = random.Random(shard_bytes)
    docs = corpus(r, 700)
    docs += [(1000 + i, docs[i][1]) for i in range(0, 300, 7)]  # ties
    docs += [(2000, None), (2001, ""), (2002, "w1 " * 30_000), (2003, "Ünï W1-w2,w3")]
    items = [(i, " ".join(r.choices([f"w{j}" for j in range(320)], k=r.choice([1, 4, 12, 40])))) for i in range(40)]
    items += [(50, None), (51, "unknown words"), (52, "ünï W1 w1"), (52, "w5 w6")]
    r.shuffle(docs)
    assert found(spark, docs, items, shard_bytes=shard_bytes) == brute(docs, items)


def test_repeated_rows_null_keys_and_blocks_of_queries(spark):
    r = random.Random(4)
    docs = [(None, "w1 w2"), (7, "w1 w2"), (7, "w1 w2"), (None, "w1 w2"), (3, "w2"), *[(100 + i, t) for i, t in corpus(r, 60, 30)]]
    items = [(i % 5 or None, " ".join(r.choices([f"w{j}" for j in range(30)], k=6))) for i in range(25)]
    assert found(spark, docs, items, query_bytes=200, shard_bytes=2000) == brute(docs, items)


def test_empty_tables_and_clashing_columns(spark):
    assert found(spark, [], [(1, "a")]) == [] and found(spark, [(1, "a b")], []) == [] and found(spark, [(1, None)], [(1, "a")]) == []
    docs, items = [(1, "a b"), (2, "a")], [(5, "a b")]
    odd = spark.createDataFrame(docs, DOCS)
    for c in ("k", "x", "shard", "term", "n", "score", "rank"):
        odd = odd.withColumn(c, F.lit(1))
    asked = spark.createDataFrame(items, ITEMS)
    for c in ("q", "key", "x", "t", "b"):
        asked = asked.withColumn(c, F.lit("z"))
    assert sorted(map(tuple, lexical.search(lexical.build_index(odd), asked).collect()), key=str) == brute(docs, items)


def test_numbers_round_trip():
    values = np.array([0, 1, 127, 128, 300, 16383, 16384, 2**21, 2**28 + 5, 2**31 - 1, 3])
    raw, ends = lexical.pack_numbers(values)
    assert lexical.unpack_numbers(raw).tolist() == values.tolist() and ends[-1] == len(raw)


def shard_of(texts):
    vocabulary = {}
    words = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in t.encode().split()], np.int32) for t in texts]
    batches = list(lexical.blocks_of(1, pa.array(range(len(texts))), words, list(vocabulary)))
    rows = pa.Table.from_batches(batches[1:])
    rows = rows.append_column("t", pa.array([vocabulary[w] for w in rows.column("term").to_pylist()], pa.int32()))
    docs = pa.table({"place": batches[0].column("first"), "length": batches[0].column("n"), "name": batches[0].column("k")})
    n = sum(map(len, words))
    return lexical.Shard(docs, rows, len(texts), n), {w.decode(): i for w, i in vocabulary.items()}


def test_block_maxima_spare_decompression():
    """A rare word decides; the common word's blocks without a candidate stay packed."""
    r = random.Random(8)
    texts = [" ".join(["the"] * r.randrange(1, 4) + [f"f{r.randrange(5000)}" for _ in range(30)]) for _ in range(6000)]
    for i in [*range(20), *range(40, 6000, 500)]:
        texts[i] += " rare rare rare"
    shard, vocabulary = shard_of(texts)
    query = []
    for w, weight in (("the", 10), ("rare", 6000)):
        a, b = shard.lists[vocabulary[w]]
        query.append((vocabulary[w], weight, weight * int(shard.bound[a:b].max())))
    places, scores = shard.best(query, 10)
    full = np.zeros(len(texts), np.int64)
    for t, weight, _ in query:
        where, impacts = shard.unpack(*shard.lists[t])
        full[where] += weight * impacts
    best = np.lexsort((np.arange(len(full)), -full))[:10]
    assert places.tolist() == best.tolist() and scores.tolist() == full[best].tolist()
    again, _ = shard_of(texts)
    again.best(query, 10, span=64)
    a, b = again.lists[vocabulary["the"]]
    assert again.unpacked < (b - a) // 2


def test_bounds_hold_for_every_posting():
    r = random.Random(9)
    shard, _ = shard_of([" ".join(r.choices("abcdefgh", k=r.randrange(1, 60))) for _ in range(500)])
    for a, b in shard.lists.values():
        for at in range(a, b):
            assert shard.unpack(at, at + 1)[1].max() <= shard.bound[at]

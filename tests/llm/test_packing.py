"""Packing: ids against the plain tokenizer, sequences against their limits."""

import random
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from martkit.llm.packing import END_ID, Limits, default_tokenizer, encoder, fast_twin, pack, pack_texts


PLAIN = Tokenizer.from_file(default_tokenizer())


def plain(text):
    return PLAIN.encode(text, add_special_tokens=False).ids


def test_ids_against_the_plain_tokenizer():
    r = random.Random(4)
    low = "".join(map(chr, range(0x250)))
    marks = [" ", "  ", "\n", "\t", "\x85", "\xa0", "'s", "'LL", "-", ".", "é", "ß", "日本", "ש", "🙂", "<|endoftext|>", "12", "ab", "The"]
    texts = [low, " ".join(low), " " + " a".join(low), "x" * 70_000, " y" * 70_000, "<|endoftext|>" * 3, " <|endoftext|> "]
    texts += ["".join(r.choice(marks) for _ in range(r.randrange(60))) for _ in range(1500)]
    texts += ["".join(r.choice(low) + r.choice(["", " ", " a"]) for _ in range(r.randrange(40))) for _ in range(1500)]
    got = encoder(default_tokenizer()).encode(texts)
    wanted = PLAIN.encode_batch(texts, add_special_tokens=False)
    for text, ids, w in zip(texts, got, wanted, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == w.ids, text[:80]


def test_twin_only_where_it_is_the_same():
    import json

    assert fast_twin(PLAIN) is not None
    kept = json.loads(PLAIN.to_str())
    kept["model"]["merges"][5:7] = kept["model"]["merges"][6:4:-1]
    assert fast_twin(Tokenizer.from_str(json.dumps(kept))) is None
    kept = json.loads(PLAIN.to_str())
    kept["pre_tokenizer"]["add_prefix_space"] = True
    assert fast_twin(Tokenizer.from_str(json.dumps(kept))) is None


def sequences(rows):
    out = defaultdict(list)
    for x in rows:
        out[x.sequence_id].append(x)
    for pieces in out.values():  # no gap in a sequence
        pieces.sort(key=lambda x: x.offset)
        at = 0
        for x in pieces:
            assert x.offset == at and x.length >= 1 and len(x.ids) == 4 * x.length
            at += x.length
    return out


def rebuilt(rows):
    """Ids of every document; its pieces must cover each id once."""
    out = defaultdict(list)
    for x in sorted(rows, key=lambda x: x.start):
        assert x.start == len(out[x.k])
        out[x.k] += np.frombuffer(bytes(x.ids), "<u4").tolist()
    return out


def padding(found, size=2048):
    own = [sum(x.length for x in pieces) for pieces in found.values()]
    assert max(own) <= size
    return sum(size - n for n in own if n & (n - 1)) / sum(own)


def coded(spark, lists, prompts=None):
    rows = [(i, np.array(x, "<u4").tobytes(), prompts[i] if prompts else 0) for i, x in enumerate(lists)]
    return spark.createDataFrame(rows, "k long, ids binary, prompt long").coalesce(1)


def test_little_padding_of_short_texts(spark):
    r = random.Random(5)
    for sizes in ([1], [3], [5, 6, 7], [1, 2, 900], [2047, 2], [1500]):
        texts = [" the" * (r.choice(sizes) - 1) for _ in range(3000)]
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
        rows = pack_texts(docs.withColumnRenamed("doc_id", "k"), default_tokenizer(), key="k").collect()
        assert padding(sequences(rows)) < 0.02, sizes
        got = rebuilt(rows)
        assert all(got[i] == plain(t) + [END_ID] for i, t in enumerate(texts[:40]))
        assert {i: len(v) for i, v in got.items()} == {x.k: x.doc_tokens for x in rows} and len(got) == len(texts)


def test_three_limits_at_once(spark):
    r = random.Random(6)
    lists = [[r.randrange(50_000) for _ in range(r.choice([1, 4, 30, 100, 250]))] for _ in range(900)]
    prompts = [r.randrange(len(x) + 1) for x in lists]
    for cut in (True, False):
        for limits in (Limits(256, 5, 100, 40), Limits(256, 256, 40, 40), Limits(256, 2, 256, 16)):
            rows = pack(coded(spark, lists, prompts), "k", "ids", "prompt", limits, cut).collect()
            assert rebuilt(rows) == dict(enumerate(lists))
            hit = np.zeros(3)
            for pieces in sequences(rows).values():
                loss = sum(max(0, x.start + x.length - max(x.start, prompts[x.k])) for x in pieces)
                demand = np.array([sum(x.length for x in pieces), len(pieces), loss])
                assert (demand <= [limits.tokens, limits.segments, limits.loss_tokens]).all()
                hit += demand == [limits.tokens, limits.segments, limits.loss_tokens]
            assert hit.any()


def test_ties_repeats_nulls_and_clashing_columns(spark):
    rows = [(1, "same text", "a"), (1, "same text", "b"), (None, None, "c"), (None, "", None), (2, "word " * 40_000, "e")]
    docs = spark.createDataFrame(rows, "k long, text string, ids string")
    docs = docs.withColumn("start", docs.k).withColumn("sequence_id", docs.k).withColumn("key", docs.k)
    got = pack_texts(docs, default_tokenizer(), key="k").collect()
    assert sum(x.length for x in got) == sum(len(plain(t or "")) + 1 for _, t, _ in rows)
    assert [x.length for x in got if x.k is None] == [1, 1] and sum(x.start == 0 for x in got if x.k == 1) == 2
    sequences(got)

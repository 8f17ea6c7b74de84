"""Repeated byte strings against brute force."""

import hashlib
import itertools
import random
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from martkit.llm import suffix_dedup
from martkit.llm.suffix_dedup import GRAM, digests, halves, merged, repeated_starts, segments, suffix_order


def plain(rows, length):
    raws = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[j : j + length] for _, b in raws for j in range(len(b) - length + 1))
    out = []
    for i, b in raws:
        gone = np.zeros(len(b) + 1, bool)
        for j in range(len(b) - length + 1):
            if seen[b[j : j + length]] > 1:
                gone[j : j + length] = True
        gone = gone[: len(b)]
        spans = int((np.diff(np.append(False, gone).astype(int)) == 1).sum())
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(r):
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randrange(1, 6)))
    passages = [" ".join(word() for _ in range(r.randrange(4, 60))) for _ in range(6)]
    texts = [None, "", "a", "a" * 500, "ab" * 130, passages[0], passages[0]]
    for _ in range(60):
        parts = [word() for _ in range(r.randrange(1, 40))]
        for _ in range(r.randrange(3)):
            parts.insert(r.randrange(len(parts)), r.choice(passages))
        texts.append(" ".join(parts))
    texts += [t[: len(t) // 2] + "x" + t[len(t) // 2 :] for t in texts[7:20]]
    return [*enumerate(texts), (None, passages[1]), (5, passages[2])]


def test_interval_expansion_finds_repeats():
    r = random.Random(2)
    for length in (3, 8):
        pieces = ["".join(r.choice("ab") for _ in range(r.randrange(length, 40))).encode() for _ in range(12)]
        seen = Counter(p[j : j + length] for p in pieces for j in range(len(p) - length + 1))
        want = [[j for j in range(len(p) - length + 1) if seen[p[j : j + length]] > 1] for p in pieces]
        assert [x.tolist() for x in repeated_starts(pieces, length)] == want


@pytest.mark.parametrize(("length", "most"), [(200, 1000), (60, 1000), (60, 2)])
def test_digests_against_brute_force(spark, length, most):
    rows = corpus(random.Random(length))
    docs = spark.createDataFrame([(i, t, "", 1) for i, t in rows], "doc_id long, text string, h string, t int").repartition(3)
    got = sorted((tuple(x) for x in digests(docs, length, most).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)
    assert got == plain(rows, length)


def test_large_anchors_make_two_rows_a_piece(spark, monkeypatch):
    """A line of 260 bytes in 60 different texts, also copied with some bytes around it: an anchor
    with more pieces than a task compares is split into two parts a piece and round."""
    r = random.Random(9)
    noise = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    line, inner = noise(260), noise(120)
    texts = [noise(250) + line + noise(250) for _ in range(60)]
    texts += [noise(90) + inner + noise(90) for _ in range(40)]  # shared, but too short
    texts += [t[180:430] + noise(40) for t in texts[:20]] + [noise(30) + line[60:] + t[510:600] for t in texts[:20]]
    texts += ["z" * 400, "zy" * 190, "z" * 230 + line[:100]]
    rows = [*enumerate(texts)]
    raws = [t.encode() for t in texts]
    cuts = [(h, f, raw[s : s + n]) for raw in raws for s, n, h, f in zip(*(x.tolist() for x in segments(raw, 200, GRAM)), strict=True)]
    made = []
    real = suffix_dedup.stage

    def counted(df, name):
        out = real(df, name)
        if name == "parts":
            made.append(out.count())
        return out

    monkeypatch.setattr(suffix_dedup, "stage", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((tuple(x) for x in digests(docs, 200, 3).collect()), key=str)
    assert got == plain(rows, 200)
    assert 1 < len(made) <= 8 and max(made) <= 2 * len({c[:2] for c in cuts})
    # before: a row for each string of the pieces
    assert made[0] < sum(len(p) - 199 for p in {c[2] for c in cuts}) / 4
    # parts of one piece hold each of its strings once
    piece = max((c[2] for c in cuts), key=len)
    batch = pa.RecordBatch.from_pydict({"h": [1], "f": [2], "p": [piece], "low": [0], "high": [200 - GRAM]})
    parts = list(itertools.chain(*(b.to_pylist() for b in halves(200, GRAM)([batch]))))
    starts = sorted(p["at"] + i for p in parts for i in range(len(p["p"]) - 199))
    assert starts == list(range(len(piece) - 199))


def test_empty_table(spark):
    assert digests(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_suffixes_are_in_order_with_few_sorts(monkeypatch):
    """Symbols are packed before the first sort, so fewer than one a doubling is needed."""
    r = np.random.default_rng(4)
    for symbols, depth in ((3, 200), (5000, 200), (1 << 20, 8), (1 << 40, 8)):
        codes = np.append(r.integers(0, symbols, 300), [symbols])
        codes = np.concatenate([codes, codes[:150], [symbols + 1]])  # a long repeat
        sorts = []
        real = np.argsort
        monkeypatch.setattr(np, "argsort", lambda *a, _real=real, _sorts=sorts, **k: _sorts.append(1) or _real(*a, **k))
        order = suffix_order(codes, depth)
        monkeypatch.setattr(np, "argsort", real)
        turned = [tuple(np.roll(codes, -i)[:depth].tolist()) for i in order.tolist()]
        assert turned == sorted(turned) and sorted(order.tolist()) == list(range(len(codes)))
        if depth == 200:
            assert len(sorts) <= 8  # before: 9 and one more whose result was not used


def test_runs_of_many_ranges():
    """Overlapping, touching and nested ranges are one run, those of other texts not;
    half a million ranges take no Python step each."""
    r = random.Random(6)
    lists = [[], [(5, 9), (0, 3), (3, 4)], [(0, 2**31 - 1)], [(0, 1)], [], [(1, 20), (2, 3), (21, 22), (20, 21)], []]
    lists += [[(a, a + r.randrange(1, 30)) for a in (r.randrange(300) for _ in range(r.randrange(12)))] for _ in range(200)]
    kind = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
    want = []
    for ranges in lists:
        runs: list[list[int]] = []
        for a, b in sorted(ranges):
            if runs and a <= runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], b)
            else:
                runs.append([a, b])
        want.append([{"start": a, "stop": b} for a, b in runs])
    rows = pa.array([[{"lo": a, "hi": b} for a, b in x] for x in lists], kind)
    assert merged(rows).to_pylist() == want
    assert merged(rows[3:20]).to_pylist() == want[3:20] and merged(rows[:0]).to_pylist() == []
    assert merged(pa.array([[]], kind)).to_pylist() == [[]]
    offsets = np.arange(0, 600_001, 3, dtype=np.int32)
    many = pa.StructArray.from_arrays([pa.array(np.arange(600_000, dtype=np.int32)), pa.array(np.arange(2, 600_002, dtype=np.int32))], names=["lo", "hi"])
    begun = time.process_time()
    assert len(merged(pa.ListArray.from_arrays(pa.array(offsets), many))) == 200_000
    assert time.process_time() - begun < 0.5

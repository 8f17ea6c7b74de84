"""PPM scores against a plain dictionary model."""

import math
import random
from collections import Counter, defaultdict

from martkit.llm.ppm import ppm_scores


def plain_score(trie, text, order):
    total = 0.0
    symbols = [*text.lower().encode(), 256]
    past = bytes(order)
    for s in symbols:
        out: set = set()
        for length in range(order, -1, -1):
            follow = trie.get(past[len(past) - length :])
            if follow is None:
                continue
            free = {k: n for k, n in follow.items() if k not in out}
            space = sum(free.values()) + len(free)
            if s in free:
                total += math.log10(free[s] / space)
                break
            if free:
                total += math.log10(len(free) / space)
            out |= set(follow)
        else:
            total -= math.log10(257 - len(out))
        past += bytes([s]) if s < 256 else b""
    return total


def test_scores_against_dictionaries(spark):
    r = random.Random(5)
    texts = [None, "", "A a\tb", "é\x00é", "same", "same"]
    texts += [" ".join(r.choice(["ab", "abc", "bca", "Zed", "y" * 40]) for _ in range(r.randrange(1, 30))) for _ in range(40)]
    rows = [(i, t, t) for i, t in enumerate(texts)] + [(None, "ab abc", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, block string").repartition(3)
    order = 3
    trie = defaultdict(Counter)
    words = Counter()
    for i, t, _ in rows:
        if i is None or i % 3:
            raw = (t or "").lower().encode()
            past = bytes(order)
            for s in [*raw, 256]:
                for length in range(order + 1):
                    trie[past[len(past) - length :]][s] += 1
                past += bytes([s]) if s < 256 else b""
            words.update([*raw.split(), None])
    n, v = sum(words.values()), len(words)
    from pyspark.sql import functions as F

    got = ppm_scores(docs, F.coalesce(F.col("doc_id") % 3 != 0, F.lit(True)), order=order, block_bytes=300).collect()
    assert len(got) == len(rows)
    want = {i: t for i, t, _ in rows}
    for x in got:
        t = want[x.doc_id] or ""
        tokens = [*t.lower().encode().split(), None]
        assert (x.n_tokens, x.n_known, x.train_tokens) == (len(tokens), sum(w in words for w in tokens), n)
        assert math.isclose(x.base_score, sum(math.log10((words[w] + 1) / (n + v + 1)) for w in tokens), abs_tol=1e-9)
        assert math.isclose(x.score, plain_score(trie, t, order), rel_tol=1e-9, abs_tol=1e-9)


def test_empty_and_untrained(spark):
    from pyspark.sql import functions as F

    none = spark.createDataFrame([], "doc_id long, text string")
    assert ppm_scores(none, F.lit(True)).collect() == []
    one = ppm_scores(spark.createDataFrame([(1, "a")], "doc_id long, text string"), F.lit(False)).collect()
    assert math.isclose(one[0].score, -2 * math.log10(257)) and one[0].base_score == 0


def test_blocks_ask_once_for_each_gram(spark):
    """A block's rows are its different grams and words, none for shorter contexts."""
    import pyarrow as pa

    from martkit.llm.ppm import gather, longest_grams

    raws = ["abcabc", "abd", "abcabc"]
    batch = pa.RecordBatch.from_pydict({"x": [t.encode() for t in raws], "trained": [True, False, True], "block": [1, 1, 1]})
    rows = [r for part in gather(4)([batch]) for r in part.to_pylist()]
    grams, _ = longest_grams([t.encode() for t in raws], 4)
    assert sorted(r["code"] for r in rows if r["w"] is None) == sorted(grams.tolist())
    assert sum(r["n"] for r in rows if r["w"] is None) == 14


def test_each_gram_has_one_price(spark):
    from martkit.llm.ppm import gram_prices, longest_grams

    import numpy as np

    trained, others = [b"abracadabra", b"abra", b""], [b"abrx", b"zz"]
    grams, where = longest_grams(trained + others, 4)
    times = np.bincount(where[: sum(len(t) + 1 for t in trained)], minlength=len(grams))
    table = spark.createDataFrame(list(zip(grams.tolist(), times.tolist(), strict=True)), "code long, n long")
    got = {x.code: x.price for x in gram_prices(table, 4).collect()}
    assert sorted(got) == sorted(grams.tolist())
    trie = defaultdict(Counter)
    for t in trained:
        past = bytes(4)
        for s in [*t, 256]:
            for length in range(5):
                trie[past[len(past) - length :]][s] += 1
            past += bytes([s]) if s < 256 else b""
    at = 0
    for t in trained + others:
        own = sum(got[g] for g in grams[where[at : at + len(t) + 1]].tolist())
        assert math.isclose(own, plain_score(trie, t.decode(), 4), rel_tol=1e-9)
        at += len(t) + 1


def test_grams_travel_by_part(spark, monkeypatch):
    """One row a block and part, whatever the number of grams; with many parts, and
    blocks whose texts come in several batches, the scores stay."""
    import numpy as np
    import pyarrow as pa
    from pyspark.sql import functions as F

    from martkit.llm import ppm

    raws = [bytes(random.Random(i).choices(range(97, 110), k=300)) for i in range(6)]
    batch = pa.RecordBatch.from_pydict({"x": raws, "trained": [True] * 3 + [False] * 3, "block": [1] * 6})
    grams, _ = ppm.longest_grams(raws, 4)
    rows = [r for b in ppm.gather_parts(4, 5)([batch]) for r in b.to_pylist() if r["part"] is not None]
    assert [r["part"] for r in rows] == [0, 1, 2, 3, 4]
    assert sorted(np.concatenate([ppm.unpacked(r["codes"]) for r in rows]).tolist()) == sorted(grams.tolist())
    assert sum(int(ppm.unpacked(r["counts"]).sum()) for r in rows) == 903
    assert sum(len(r["codes"]) for r in rows) == 8 * len(grams)
    prices = np.array([-0.5, -2.25, 0.0])
    assert ppm.unpacked(ppm.packed(prices), np.float64).tolist() == prices.tolist()
    docs = spark.createDataFrame([(i, t.decode()) for i, t in enumerate(raws)] + [(9, None), (10, "")], "doc_id long, text string").coalesce(1)
    trained = F.col("doc_id") % 2 == 0
    want = {x.doc_id: x.score for x in ppm_scores(docs, trained).collect()}
    monkeypatch.setattr(ppm, "PART_BYTES", 100)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        got = {x.doc_id: x.score for x in ppm_scores(docs, trained).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-12) for k in want)

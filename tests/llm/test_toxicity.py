"""The toxicity fit: its prior at every size, and its memory."""

import tracemalloc

import numpy as np

from martkit.llm import toxicity
from martkit.llm.toxicity import Settings, class_counts, features, fit, fit_sample, labelled_texts, log_ratios, packed, train, unpacked
from martkit.operators.pruning import Pruning


def test_same_scores_on_a_table_repeated_ten_times(spark):
    toxic, other, both = "you rotten scoundrel", "lovely weather today", "plain words here"
    kinds = [(toxic, True)] * 20 + [(both, True)] * 10 + [(other, False)] * 113 + [(both, False)] * 57
    logits = []
    for times in (1, 10):
        rows = [(i, text, mark) for i, (text, mark) in enumerate(kinds * times)]
        labelled = spark.createDataFrame(rows, "key long, text string, toxic boolean")
        # the shrinkage grows with the table, so the ratios are the same
        model = train(labelled, Settings(fit_rows=200, bits=14, min_z=0.0, shrink=5.0 * times))
        scores = np.array([model.score(t.encode()) for t in ("", toxic, other, both)])
        logits.append(np.log(scores / (1 - scores)))
    assert abs(logits[0][0] - logits[1][0]) < 0.4 and abs(logits[0][3] - logits[1][3]) < 0.4
    assert logits[1][1] > 0.85 and max(logits[1][[0, 2, 3]]) < 0


def test_fit_of_a_full_sample_in_little_memory():
    r, s = np.random.default_rng(1), Settings(steps=2)
    assert s.fit_rows == 8000
    ratios = r.normal(size=1 << s.bits).astype(np.float32)
    lists = [np.unique(r.integers(0, 1 << s.bits, 600, dtype=np.int32)) for _ in range(2 * s.fit_rows)]
    tracemalloc.start()
    fit(lists, np.arange(len(lists)) < s.fit_rows, ratios, 0.1, s)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6


def test_fit_against_a_dense_one():
    r, s = np.random.default_rng(2), Settings(bits=6, steps=40)
    ratios, share = r.normal(size=64).astype(np.float32), 0.2
    lists = [np.flatnonzero(r.random(64) < 0.2 * (i % 4)).astype(np.int32) for i in range(50)]
    y = np.arange(50) < 20
    x = np.zeros((50, 64))
    for row, buckets in enumerate(lists):
        x[row, buckets] = ratios[buckets]
    x = np.hstack([x, np.ones((50, 1))])
    weight = np.where(y, share**0.5 / 20, (1 - share) ** 0.5 / 30)
    weight /= weight.sum()
    p, mean, square = np.zeros(65), np.zeros(65), np.zeros(65)
    for step in range(1, s.steps + 1):
        gradient = x.T @ (weight * (1 / (1 + np.exp(-x @ p)) - y)) + s.l2 * np.append(p[:-1], 0)
        mean, square = 0.9 * mean + 0.1 * gradient, 0.99 * square + 0.01 * gradient**2
        p -= s.rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    weights, bias = fit(lists, y, ratios, share, s)
    assert np.allclose(weights, p[:-1] * ratios, atol=1e-4) and abs(bias - p[-1]) < 1e-4


ROWS = [(1, "rotten rotten words"), (1, "rotten rotten words"), (2, None), (3, ""), (4, "x"), (None, "rotten"), (5, "plain " * 30_000), (6, "unmarked")]
MARKS = [(1, 1), (2, 0), (3, 1), (4, None), (5, 0), (None, 1), (1, 0), (9, 1)]


def marked(spark):
    docs = spark.createDataFrame([(i, t, 0.5) for i, t in ROWS], "doc_id long, text string, toxic double")
    labels = spark.createDataFrame([(i, m, "x") for i, m in MARKS], "doc_id long, toxic int, text string")
    return docs, labels


def wanted():
    return [(i, t, m == 1) for i, t in ROWS for j, m in MARKS if i is not None and i == j and m is not None]


def test_labelled_texts_with_nulls_repeats_and_clashing_names(spark, monkeypatch):
    for policy in (Pruning(), Pruning(max_rows=1, min_target_bytes=0), Pruning(max_rows=1, filter_bits=2, min_target_bytes=0)):
        monkeypatch.setattr(toxicity, "AUTO_PRUNE", policy)
        monkeypatch.setattr(toxicity, "narrow", lambda a, b, k, p=policy: narrow_with(a, b, k, p))
        got = labelled_texts(*marked(spark)).collect()
        in_order = lambda x: (x[0], x[1] or "", x[2])
        assert sorted(map(tuple, got), key=in_order) == sorted(wanted(), key=in_order)


def narrow_with(tgt, src, keys, policy):
    from martkit.operators.pruning import narrow

    return narrow(tgt, src, keys, policy)


def test_counts_against_brute_force(spark):
    r = np.random.default_rng(3)
    rows = [(int(i), "".join(r.choice(list("ab c"), r.integers(0, 40))), bool(r.random() < 0.1)) for i in range(700)]
    rows += [(1, None, True), (1, "", False), (2, "long text " * 20_000, False)] + [(3, "ab ab", False)] * 300
    labelled = spark.createDataFrame(rows, "key long, text string, toxic boolean").repartition(5)
    for s in (Settings(bits=12), Settings(bits=6)):
        sums = np.zeros((2, 1 << s.bits), dtype=np.int64)
        for _, text, toxic in rows:
            sums[0 if toxic else 1][np.unique(features((text or "").encode(), s))] += 1
        a, b, n, m = class_counts(labelled, s)
        assert (a == sums[0]).all() and (b == sums[1]).all()
        assert (n, m) == (sum(x[2] for x in rows), sum(not x[2] for x in rows))
        assert sums.max() > 255


def test_sample_is_bounded_by_class_and_needs_no_other_text(spark):
    rows = [(i % 90, f"text {i}", i % 90 < 30) for i in range(900)]
    labelled = spark.createDataFrame(rows, "key long, text string, toxic boolean").repartition(4)
    s = Settings(fit_rows=25, bits=10)
    assert all((unpacked(packed(x)) == x).all() for x in (np.zeros(0, np.int32), np.array([0, 3, (1 << 30) - 1], np.int32)))
    lists, labels = fit_sample(labelled, np.ones(1 << s.bits, dtype=np.float32), s)
    assert len(lists) == 50 and labels.sum() == 25
    again, _ = fit_sample(labelled.repartition(3), np.ones(1 << s.bits, dtype=np.float32), s)
    assert sorted(map(bytes, lists)) == sorted(map(bytes, again))


def test_shipped_settings_keep_their_prior_when_the_table_grows(spark):
    """Every text many times: ratios stand, and so do the calls at 0.7."""
    r = np.random.default_rng(9)
    words = ["".join(r.choice(list("abcdefgh"), 6)) for _ in range(60)]
    vile = ["rottenscum", "vilestfilth", "scoundrels"]
    rows = []
    for i in range(600):
        text = " ".join(r.choice(words, 30))
        rows.append((i, f"{text} {vile[i % 3]} {vile[(i + 1) % 3]}" if i % 8 == 0 else text, i % 8 == 0))
    probes = ["", " ".join(words[:30]), " ".join(words[30:]), f"{' '.join(words[:9])} rottenscum vilestfilth", "scoundrels vilestfilth"]
    calls = []
    for times in (1, 6):
        grown = [(i + 1000 * t, text, mark) for t in range(times) for i, text, mark in rows]
        model = train(spark.createDataFrame(grown, "key long, text string, toxic boolean"))
        calls.append([model.score(p.encode()) >= 0.7 for p in probes])
    assert calls == [[False, False, False, True, True]] * 2


def test_no_rows_and_one_class(spark):
    none = spark.createDataFrame([], "key long, text string, toxic boolean")
    assert train(none, Settings(bits=10)).score(b"any") == 0.5
    one = spark.createDataFrame([(1, "a", True), (2, None, True)], "key long, text string, toxic boolean")
    assert train(one, Settings(bits=10)).score(b"") > 0.99


def test_a_bucket_of_one_text_is_left_to_the_z_test():
    s, toxic, other = Settings(), np.array([1, 0, 40]), np.array([0, 1, 40])
    assert (log_ratios(toxic, other, 100, 100, s) == 0).all()
    rare = log_ratios(toxic, other, 100, 100_000, s)
    assert rare[0] > 0 and rare[1] == 0 and rare[2] > 0

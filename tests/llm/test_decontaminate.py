"""Decontamination against brute force: spans, blocks, nulls, clashing names."""

import random
import re

import pytest

from martkit.llm.decontaminate import benchmark_matches, contamination_report, contamination_spans, drop_contaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def tables(spark):
    r = random.Random(7)
    words = ["Alpha", "beta", "Été", "日本", "x1", "9", "the", "A"]
    say = lambda n: " ".join(r.choice(words) + r.choice(["", ",", "-", "\n"]) for _ in range(n))
    items = [(i, say(r.choice([1, 4, 5, 6, 9]))) for i in range(12)] + [(12, None), (13, " .,"), (3, "beta"), (None, "x1 x1 the"), (14, say(40))]
    docs = [(i, say(r.randrange(40))) for i in range(60)] + [(60, None), (61, ""), (1, "the 9"), (None, say(9))]
    docs += [(62, items[14][1] and items[16][1].upper() + " tail"), (63, "clean words only " * 20_000 + items[16][1])]
    doc_rows = spark.createDataFrame([(i, t, "m", 1, i) for i, t in docs], "doc_id long, text string, _match string, _next int, match long")
    return docs, items, doc_rows, spark.createDataFrame(items, "item_id long, text string")


def expected(docs, items, window):
    windows = {}
    for item, text in items:
        w = WORD.findall(lowered(text))
        for at in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[at : at + window]), set()).add(str(item) if item is not None else None)
    out = []
    for key, text in docs:
        places = [m.span() for m in WORD.finditer(lowered(text))]
        w = WORD.findall(lowered(text))
        hit = set()
        for n in {len(x) for x in windows}:
            for at in range(len(w) - n + 1):
                if tuple(w[at : at + n]) in windows:
                    hit |= set(range(at, at + n))
        runs = [(a, b) for a in sorted(hit) if a - 1 not in hit for b in [next(x for x in range(a, len(w)) if x + 1 not in hit)]]
        out.append((key, len(w), len(hit), [(a, b, places[a][0], places[b][1]) for a, b in runs]))
    return out


@pytest.mark.parametrize("block_bytes", [32 << 20, 600])
def test_against_brute_force(spark, block_bytes):
    docs, items, doc_rows, item_rows = tables(spark)
    items = [x for x in items if x[0] is not None]
    item_rows = item_rows.where("item_id IS NOT NULL")
    wanted = expected(docs, items, 5)
    got = contamination_report(doc_rows, item_rows, window=5, block_bytes=block_bytes).collect()
    order = lambda x: tuple(map(str, x))
    assert sorted(((x.doc_id, x.n_words, x.n_hit) for x in got), key=order) == sorted((w[:3] for w in wanted), key=order)
    spans = contamination_spans(doc_rows, item_rows, window=5, block_bytes=block_bytes).collect()
    assert sorted(map(tuple, spans), key=order) == sorted(((w[0], *s) for w in wanted for s in w[3]), key=order)
    kept = drop_contaminated(doc_rows, item_rows, window=5, block_bytes=block_bytes)
    assert kept.columns == doc_rows.columns
    clean = [(i, t, "m", 1, i) for (i, t), w in zip(docs, wanted, strict=True) if not w[2]]
    assert sorted(map(tuple, kept.collect()), key=order) == sorted(clean, key=order) and clean


def test_key_of_the_result_columns_name_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "match long, t string")
    none = spark.createDataFrame([], "item_id long, text string")
    report = contamination_report(docs, none, key="match", text="t").collect()
    assert sorted((x.match, x.n_words, x.contaminated) for x in report) == [(1, 2, False), (2, 0, False)]
    item = spark.createDataFrame([("q", "A B")], "item_id string, text string")
    assert [tuple(x) for x in contamination_spans(docs, item, key="match", text="t").collect()] == [(1, 0, 1, 0, 3)]
    assert drop_contaminated(docs.limit(0), item, text="t").count() == 0
    assert benchmark_matches(docs, item, "t").columns == ["match", "t"]

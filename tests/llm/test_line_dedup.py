"""Line dedup over lines without words, against brute force."""

import random
import re

import pytest

from martkit.llm.line_dedup import drop_repeated_lines

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def test_short_lines_parted_by_blank_ones(spark):
    notice = [f"paragraph {i} of a notice in few words" for i in range(6)]
    rows = [
        (1, "\n\n".join(notice)),
        (2, "own first\n\n" + "\n\n".join(notice) + "\n\nown last"),
        (3, "\n \t\n".join(notice) + "\n"),
        (4, "\n".join(notice)),
        (5, "\n\n".join(notice[:3])),  # 24 words
    ]
    got = {x.doc_id: (x.n, x.text) for x in drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"), report="n").collect()}
    assert got == {1: (0, rows[0][1]), 2: (11, "own first\n\n\nown last"), 3: (11, ""), 4: (6, ""), 5: (0, rows[4][1])}


@pytest.mark.parametrize("min_words", [1, 2, 8])
def test_runs_over_blank_lines_against_brute_force(spark, min_words):
    r = random.Random(min_words)
    lines = [f"line {c} " + "w " * n for c, n in zip("abcdef", (0, 1, 2, 4, 8, 9), strict=True)]
    texts = ["\n".join(r.choice([*lines, "", "", " \t"]) for _ in range(r.randint(0, 14))) for _ in range(40)]
    rows = list(enumerate(texts))
    split = [t.split("\n") for t in texts]
    count = lambda x: len(SPACE.findall(x))
    held = [[p for p, x in enumerate(d) if count(x)] for d in split]
    places = [(i, p) for i, d in enumerate(held) for p in range(len(d))]
    runs = [[split[i][p] for p in d] for i, d in enumerate(held)]
    gone = [set() for _ in texts]
    for i, p in places:
        for n in range(1, len(held[i]) - p + 1):
            run = runs[i][p : p + n]
            if sum(map(count, run)) >= min_words and any((j, q) < (i, p) and runs[j][q : q + n] == run for j, q in places):
                gone[i] |= set(range(held[i][p], held[i][p + n - 1] + 1))
    kept = ["\n".join(x for p, x in enumerate(d) if p not in g) for d, g in zip(split, gone, strict=True)]
    got = drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"), min_words=min_words, report="n").collect()
    assert {x.doc_id: (x.n, x.text) for x in got} == {i: (len(g), kept[i]) for i, g in enumerate(gone)}
    assert any(not count(split[i][p]) for i, g in enumerate(gone) for p in g)


def test_long_text_is_taken_apart_in_one_pass(spark):
    """Deleted lines are looked up by a hash set, not line by line."""
    lines = [f"line {i} of a long text" for i in range(40_000)]
    rows = [(1, "\n".join(lines)), (2, "own first line\n" + "\n".join(lines) + "\nown last line"), (3, "\n".join(lines[:30_000:2]))]
    got = drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"), report="n").collect()
    assert {x.doc_id: x.n for x in got} == {1: 0, 2: 40_000, 3: 0}
    assert {x.doc_id: x.text for x in got}[2] == "own first line\nown last line"

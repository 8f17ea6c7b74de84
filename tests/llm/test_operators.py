"""Operators against brute force on small tables, with nulls and repeats."""

import random
import re
import zlib

import numpy as np
import pytest

from martkit.llm.jaccard_join import near_duplicates
from martkit.llm.licenses import license_scan
from martkit.llm.line_dedup import drop_repeated_lines
from martkit.llm.packing import default_tokenizer, pack_texts, pieces_digest
from martkit.llm.quality import quality_report

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def test_near_duplicates_against_brute_force(spark):
    r = random.Random(1)
    base = [f"w{r.randrange(400)}" for _ in range(60)]
    texts = [None, "", "a", "a", "a b"]
    for _ in range(30):
        copy = list(base)
        for _ in range(r.randrange(3)):
            copy[r.randrange(60)] = "x"
        texts.append(" ".join(copy))
    rows = list(enumerate(texts))
    sets = {}
    for i, t in rows:
        w = SPACE.findall(t or "")
        sets[i] = set(zip(w, w[1:], w[2:], strict=False)) if len(w) > 2 else ({tuple(w)} if w else set())
    root = {i: i for i in sets}
    for _ in sets:
        for i in sets:
            for j in sets:
                if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]):
                    root[i] = root[j] = min(root[i], root[j])
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got} == {i: (len(sets[i]), root[i]) for i in sets}


def test_line_dedup_against_brute_force(spark):
    r = random.Random(3)
    lines = [f"line {c} " + "w " * r.randint(0, 4) for c in "abcdef"]
    rows = [(i, "\n".join(r.choice(lines) for _ in range(r.randint(0, 9))) if i % 9 else None) for i in range(40)]
    docs = {i: (t or "").split("\n") for i, t in rows}
    count = lambda x: len(SPACE.findall(x))
    places = [(i, p) for i in docs for p in range(len(docs[i]))]
    gone = {i: set() for i in docs}
    for i, p in places:
        for n in range(1, len(docs[i]) - p + 1):
            run = docs[i][p : p + n]
            if not all(map(count, run)):
                break
            if sum(map(count, run)) >= 8 and any((j, q) < (i, p) and docs[j][q : q + n] == run for j, q in places):
                gone[i] |= set(range(p, p + n))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {i: t and "\n".join(x for p, x in enumerate(docs[i]) if p not in gone[i]) for i, t in rows}
    got = drop_repeated_lines(df, min_words=8, report="n").collect()
    assert {x.doc_id: (x.n, x.text) for x in got} == {i: (len(v), kept[i]) for i, v in gone.items()}
    assert any(gone.values())


def test_line_dedup_of_nulls_repeated_rows_and_clashing_names(spark):
    run = "\n".join(f"l{i} " + "w " * 9 for i in range(4))
    rows = [(1, run, 7, "p"), (1, run, 8, "q"), (None, run, 9, "r"), (2, "own\n" + run, None, "s"), (3, None, 1, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, k long, gone string")
    got = drop_repeated_lines(df).collect()
    assert sorted(map(tuple, got), key=str) == sorted([*rows[:3], (2, "own", None, "s"), rows[4]], key=str)


def test_license_places(spark):
    rows = [(1, "x Under THE MIT-license y under the mit license"), (2, None), (3, "the mit"), (4, "CC BY-NC 4.0")]
    got = {x.doc_id: x for x in license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels) == (2, 1, 6, "mit")
    assert (got[2].n_words, got[2].n_base, got[2].labels, got[2].score) == (0, 0, "", 0.0)
    assert got[3].n_base == 0 and got[4].base_labels == "cc-by-nc"


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(default_tokenizer())
    rows = [(1, "some text é\n\n  more  text's"), (2, None), (3, ""), (4, "word " * 3000), (5, "a <|endoftext|> b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    pieces = pack_texts(docs, default_tokenizer()).collect()
    for i, text in rows:
        mine = sorted((p for p in pieces if p.doc_id == i), key=lambda p: p.start)
        ids = np.frombuffer(b"".join(bytes(p.ids) for p in mine), "<u4").tolist()
        assert ids == own.encode(text or "", add_special_tokens=False).ids + [1]
    crc = {(p.doc_id, p.start): p.ids_crc32 for p in pieces_digest(pack_texts(docs, default_tokenizer())).collect()}
    assert crc[(2, 0)] == zlib.crc32(np.array([1], "<u4").tobytes())


def test_quality_of_null_and_repeats(spark):
    rows = [(1, None), (2, "a b c d e f g h " * 10), (3, " ".join(f"word{i}" for i in range(50)))]
    got = {x.doc_id: x for x in quality_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].n_words == 0 and not got[1].kept
    assert got[2].n_repeat_words == 80 and got[2].base_failed and got[3].kept


@pytest.mark.parametrize("name", ["empty"])
def test_empty_tables(spark, name):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(empty).count() == 0
    assert drop_repeated_lines(empty).count() == 0
    assert license_scan(empty).count() == 0
    assert pack_texts(empty, default_tokenizer()).count() == 0
    assert quality_report(empty).count() == 0


@pytest.mark.parametrize(("words", "threshold"), [(1, 0.9), (1, 0.8), (2, 0.8)])
def test_near_duplicates_keep_every_chain(spark, words, threshold):
    """Chains of small steps whose ends are far apart, and small sets."""
    r = random.Random(words * 10 + int(10 * threshold))
    texts = []
    for size in (5, 9, 10, 12, 20, 40):
        for _ in range(3):
            now = [f"w{r.randrange(10**6)}" for _ in range(size)]
            for _ in range(14):
                texts.append(" ".join(now))
                now = list(now)
                for _ in range(r.randrange(1, 1 + max(1, size // 10))):
                    now[r.randrange(len(now))] = f"w{r.randrange(10**6)}"
    r.shuffle(texts)
    sets = []
    for t in texts:
        w = t.split()
        sets.append({tuple(w[i : i + words]) for i in range(len(w) - words + 1)})
    root = list(range(len(sets)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= round(100 * threshold) * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = near_duplicates(docs, words=words, threshold=threshold).collect()
    assert {x.doc_id: x.component_id for x in got} == {i: top(i) for i in range(len(sets))}


def test_parities_rule_out_no_link(spark):
    """Bits differ at most as often as shingles do, so linked pairs stay."""
    from martkit.llm.jaccard_join import may_link, parity

    r = np.random.default_rng(1)
    sets = [np.unique(r.integers(0, 1 << 63, size, dtype=np.uint64)) for size in (1, 5, 40, 400, 3000)]
    sets += [np.unique(np.append(s[1:], r.integers(0, 1 << 63, max(1, len(s) // 20), dtype=np.uint64))) for s in sets]
    rows = [(i, len(s), parity(s)) for i, s in enumerate(sets)]
    classes = spark.createDataFrame(rows, "c long, n long, bits array<long>")
    pairs = spark.createDataFrame([(i, j) for i in range(10) for j in range(i + 1, 10)], "a long, b long")
    kept = {tuple(x) for x in may_link(pairs, classes, 0.8).collect()}
    common = {(i, j): len(np.intersect1d(sets[i], sets[j])) for i in range(10) for j in range(i + 1, 10)}
    linked = {p for p, o in common.items() if o >= 0.8 * (len(sets[p[0]]) + len(sets[p[1]]) - o)}
    assert linked <= kept and (3, 8) in linked and len(kept) < 20


def test_members_of_large_groups_meet_in_blocks(spark, monkeypatch):
    """Pairs from blocks are those of a plain comparison, whatever the block size."""
    from martkit.llm import jaccard_join
    from martkit.llm.jaccard_join import met_in_blocks, parity

    r = np.random.default_rng(2)
    base = np.unique(r.integers(0, 1 << 63, 40, dtype=np.uint64))
    sets = [np.unique(np.append(base[r.integers(0, 9) :], r.integers(0, 1 << 63, r.integers(0, 9), dtype=np.uint64))) for _ in range(30)]
    members = [(7, i, len(s), 30, i // 10, i) for i, s in enumerate(sets)] + [(8, i, len(s), 30, i, i) for i, s in enumerate(sets[:9])]
    open_ = spark.createDataFrame(members, "m long, c long, n long, k long, root long, turn long")
    classes = spark.createDataFrame([(i, len(s), parity(s)) for i, s in enumerate(sets)], "c long, n long, bits array<long>")

    def linked(i, j):
        both = len(np.intersect1d(sets[i], sets[j]))
        return both >= 0.9 * (len(sets[i]) + len(sets[j]) - both)

    every = {(i, j) for j in range(30) for i in range(j)}
    want = {(i, j) for i, j in every if linked(i, j) and (i // 10 != j // 10 or j < 9)}
    assert want
    for block in (4, 1024):
        monkeypatch.setattr(jaccard_join, "BLOCK", block)
        got = {tuple(x) for x in met_in_blocks(open_, classes, 30, 0.9).collect()}
        assert want <= got and len(got) < len(every) / 2
        few = {tuple(x) for x in met_in_blocks(open_, classes, 3, 0.9).collect()}
        assert few == {(i, j) for i, j in got if i < 3}


def test_large_group_of_near_copies_makes_no_row_per_pair(spark):
    """What enters the comparison of a group of unlinked copies grows with the group."""
    from martkit.llm.jaccard_join import met_in_blocks, parity

    r = np.random.default_rng(3)
    sets = [np.unique(r.integers(0, 1 << 63, 30, dtype=np.uint64)) for _ in range(600)]
    open_ = spark.createDataFrame([(1, i, 30, 600, i, i) for i in range(600)], "m long, c long, n long, k long, root long, turn long")
    classes = spark.createDataFrame([(i, 30, parity(s)) for i, s in enumerate(sets)], "c long, n long, bits array<long>")
    assert met_in_blocks(open_, classes, 600, 0.9).count() == 0


def test_near_duplicates_of_null_keys_and_rewritten_copies(spark):
    """Other case and spaces give the same set, also for a row without a key."""
    rows = [(4, "a b c d"), (2, "A  B c\nd"), (None, "a b\tc D"), (None, "z"), (9, None), (2, "other words in here"), (2, "A  B c\nd")]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(4, 2, 2), (2, 2, 2), (None, 2, 2), (None, 1, None), (9, 0, 9), (2, 2, 2), (2, 2, 2)], key=str)


def test_only_texts_of_pairs_are_fetched(spark, monkeypatch):
    """The joins of a round hold the texts of its pairs, with repeated keys, and no others."""
    from martkit.llm import jaccard_join

    held = {}
    real = jaccard_join.settled

    def kept(df, name):
        held[name] = out = real(df, name)
        return out

    monkeypatch.setattr(jaccard_join, "settled", kept)
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(1, base), (2, base + " end"), (3, "another text of few words"), (3, base + " last"), (4, base), (None, base)]
    texts = spark.createDataFrame(rows + [(i, f"text {i} of some words") for i in range(10, 60)], "c long, x string")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (2, 10)], "a long, b long")
    got = {tuple(x) for x in jaccard_join.verified(pairs, texts, 3, 0.9).collect()}
    assert got == {(1, 2), (1, 3)}
    assert sorted(x.c for x in held["picked"].collect()) == [1, 2, 3, 3, 10]

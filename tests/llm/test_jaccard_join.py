"""Which sets the n-gram Jaccard join lets meet, and their shingles."""

import random

import pytest

from martkit.llm import jaccard_join
from martkit.llm.jaccard_join import near_duplicates, shingle_sets


def made(r, size):
    return [f"w{r.randrange(10**9)}" for _ in range(size)]


def test_sets_that_share_a_common_phrase_do_not_meet(spark, monkeypatch):
    """A phrase that all texts hold makes no pairs, so they don't grow with its square."""
    met, real = [], jaccard_join.may_link

    def seen(pairs, classes, threshold):
        met.append(pairs.count())
        return real(pairs, classes, threshold)

    monkeypatch.setattr(jaccard_join, "may_link", seen)
    r = random.Random(4)
    phrase = made(r, 12)
    texts = [" ".join(made(r, 100) + phrase + made(r, 100)) for _ in range(80)]
    docs = spark.createDataFrame(list(enumerate([*texts, texts[0] + " end"])), "doc_id long, text string")
    got = near_duplicates(docs, words=5, threshold=0.8).collect()
    assert {x.doc_id for x in got if x.component_id != x.doc_id} == {80}
    assert sum(met) == 1


@pytest.mark.parametrize(("words", "threshold"), [(1, 0.8), (2, 0.9)])
def test_links_of_texts_of_common_phrases(spark, words, threshold):
    """No link is lost where sets have more common marks than they may leave out."""
    r = random.Random(5)
    phrases = [made(r, 14) for _ in range(9)]
    texts = []
    for _ in range(12):
        now = [w for p in r.sample(phrases, r.randrange(1, 7)) for w in p] + made(r, r.randrange(0, 60))
        for _ in range(6):
            texts.append(" ".join(now))
            now = list(now)
            for _ in range(r.randrange(1, 3 + len(now) // 40)):
                now[r.randrange(len(now))] = made(r, 1)[0]
    texts += [" ".join(w for p in r.sample(phrases, k) for w in p) for k in (3, 8, 8, 8, 9, 9)]
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


@pytest.mark.parametrize("n", [1, 3])
def test_shingles_of_odd_texts(monkeypatch, n):
    """Sizes and common shingles are those of sets of word tuples, however many texts are hashed at once."""
    r = random.Random(6)
    odd = [b"", b" \x0b ", b"a", b"A\x0cb", b"a\x00 a\x00\x00 a", b"x" * 64 + b" " + b"x" * 65 + b"\t" + b"x" * 66, "é É ß x\x1cy z".encode()]
    texts = odd + [b" ".join(bytes(r.choice(b"ab\x00") for _ in range(r.randrange(1, 75))) for _ in range(r.randrange(1, 30))) for _ in range(40)]
    sets = []
    for t in texts:
        w = t.lower().split()
        sets.append({tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    for at_once in (50, 1 << 22):
        monkeypatch.setattr(jaccard_join, "AT_ONCE", at_once)
        got = [set(s.tolist()) for s in shingle_sets(texts, n)]
        assert [len(s) for s in got] == [len(s) for s in sets]
        assert all(len(got[i] & got[j]) == len(sets[i] & sets[j]) for i in range(len(sets)) for j in range(i))

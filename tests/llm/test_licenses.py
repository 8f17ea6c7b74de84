"""Labels of each key phrase alone, whatever the other documents hold."""

import pytest

from martkit.llm.licenses import TEMPLATES, license_scan

PHRASES = [(label, " ".join(words.split()[first : last + 1])) for label, words, first, last, _ in TEMPLATES]


@pytest.mark.parametrize("others", [[], ["licensed under the terms of the software"] * 60, ["the gnu general public license", "version"] * 30])
def test_each_key_phrase_alone(spark, others):
    rows = [(i, f"before {phrase} after") for i, (_, phrase) in enumerate(PHRASES)]
    rows += [(100 + i, " ".join(phrase.split()[:-1])) for i, (_, phrase) in enumerate(PHRASES)]
    rows += [(1000 + i, t) for i, t in enumerate(others)]
    got = {x.doc_id: (x.labels, x.score) for x in license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (label, _) in enumerate(PHRASES):
        assert got[i][0] == label and 0 < got[i][1] <= 1
    assert all(found == ("", 0.0) for i, found in got.items() if i >= 100)


def test_a_phrase_with_no_other_document(spark):
    docs = spark.createDataFrame([(1, "the GNU General Public License version 3")], "doc_id long, text string")
    assert license_scan(docs).first().labels == "gpl-3"

"""License scans by a positional rare-token index (operator 6), DataFrame only.

The index holds every template word with its place.  A word's weight is its
inverse document frequency over all documents, a word of no document has that
of one document; the rarest word of a template's key phrase is its anchor.  Documents that hold an anchor look up the postings
of their licence words; postings that agree on the place where the template
would begin are one alignment.  A label needs its whole key phrase and no more,
so it doesn't depend on the other documents; the score is the share of the
template's weight found there, the words around the key phrase included.

Only licence words of documents with an anchor are joined with the index, a
fixed table; long documents are cut to words by one expression.

Defined cases: null or empty text has no words, no labels and score 0; repeated
rows are scanned each; null keys stay null; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import stage, table

WORD = r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"
# fixed values: label, template, first and last word of its key phrase, base
TEMPLATES = [
    ("mit", "under the mit license", 0, 3, True),
    ("apache-2", "apache license version 2", 0, 3, True),
    ("cc-by-nc", "cc by nc", 0, 2, True),
    ("all-rights-reserved", "all rights reserved", 0, 2, False),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", 0, 7, False),
    ("cc-by-sa", "licensed under cc by sa", 2, 4, False),
    ("cc0", "cc0 1 0 universal public domain dedication", 0, 3, False),
    ("gpl-2", "licensed under the gnu general public license version 2", 3, 8, False),
    ("gpl-3", "licensed under the gnu general public license version 3", 3, 8, False),
    ("lgpl", "licensed under the gnu lesser general public license", 3, 7, False),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", 0, 5, False),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0", 6, 8, False),
]


def _index(spark) -> DataFrame:
    """(template, label, base, place, word, key, size)."""
    rows = []
    for number, (label, words, first, last, base) in enumerate(TEMPLATES):
        parts = words.split()
        for place, word in enumerate(parts):
            rows.append(
                f"({number}, '{label}', {str(base).lower()}, {place}, '{word}', "
                f"{str(first <= place <= last).lower()}, {len(parts)}, {last - first + 1})"
            )
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t(template, label, base, place, word, in_key, size, key_size)")


def license_scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with labels, places of base phrases and score."""
    spark = docs.sparkSession
    vocabulary = sorted({w for t in TEMPLATES for w in t[1].split()})
    words = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(WORD), 1)
    # ASCII words only: lower() would turn some other letters into ASCII ones
    licence = lambda w, i: F.when(
        F.lower(w).isin(vocabulary) & w.rlike("^[A-Za-z0-9]+$"), F.struct(i.alias("at"), F.lower(w).alias("word"))
    )
    cut = docs.select(F.col(key).alias("k"), words.alias("w")).select(
        F.monotonically_increasing_id().alias("row"), "k", F.size("w").cast("long").alias("n_words"),
        F.array_compact(F.transform("w", licence)).alias("hits"),
    )
    cut = stage(cut, "licence_words")
    each = cut.select("row", F.explode("hits").alias("h")).select("row", "h.at", "h.word")
    frequency = each.select("row", "word").distinct().groupBy("word").agg(F.count("*").alias("df"))
    total = cut.count()
    weight = frequency.select("word", F.log(F.lit(total + 1) / F.col("df")).alias("idf"))
    index = _index(spark).join(weight, "word", "left").withColumn("idf", F.coalesce("idf", F.log(F.lit(total + 1.0))))
    anchors = index.where("in_key").groupBy("template").agg(F.max_by("word", F.struct("idf", "word")).alias("word"))
    index = index.join(index.groupBy("template").agg(F.sum("idf").alias("whole")), "template")
    held = each.join(F.broadcast(anchors.select("word").distinct()), "word", "left_semi").select("row").distinct()
    found = each.join(held, "row").join(F.broadcast(index), "word")
    aligned = found.groupBy("row", "template", "label", "base", (F.col("at") - F.col("place")).alias("start")).agg(
        F.sum("idf").alias("got"), F.max("whole").alias("whole"), F.max("key_size").alias("key_size"),
        F.sum(F.col("in_key").cast("int")).alias("key_found"),
    )
    good = aligned.withColumn("score", F.least(F.lit(1.0), F.round(F.col("got") / F.col("whole"), 6))).where(
        F.col("key_found") == F.col("key_size")
    )
    base = F.when(F.col("base"), F.col("start"))
    found = good.groupBy("row").agg(
        F.count(base).alias("n_base"), F.min(base).cast("long").alias("first_word"), F.max(base).cast("long").alias("last_word"),
        F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))).alias("base_set"),
        F.array_sort(F.collect_set("label")).alias("label_set"), F.max("score").alias("score"),
    )
    return cut.select("row", "k", "n_words").join(found, "row", "left").select(
        F.col("k").alias(key), "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce(F.array_join("base_set", ","), F.lit("")).alias("base_labels"),
        F.coalesce(F.array_join("label_set", ","), F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def q_op6(spark, sf_dir):
    return license_scan(table(spark, sf_dir, "documents"))


QUERIES = {"op6_license_scan": q_op6}
ORACLE_SQL: dict[str, str] = {}

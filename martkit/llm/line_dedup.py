"""Line dedup by a suffix array over line numbers (operator 10).

The lines with words of all documents form sequences of line ids; the lines
without words between them are no part of a sequence, so runs go over them.  Prefix doubling names
every run of 1, 2, 4, ... lines: the names of a length are the ranks of its
distinct (name, next name) pairs in a range-partitioned sort, so their order is
the order of the suffixes.  Only runs found twice stay in play, which the next
length needs alone.

A repeated run counts from ``min_words`` words.  Two kinds of window cover
exactly the lines of all maximal repeated runs of that size: the shortest run
of ``min_words`` words that starts at a line, and the shortest that ends at it
(a line of a longer run lies in one that ends at the line, or in the one that
starts the run).  They cover the lines without words inside a run too, but for
those between two lines of ``min_words`` words each: two such lines are a
third kind of window.  Equal windows are the longest-common-prefix intervals of
their length: a window of n lines is named by the names of its first and its
last 2^j lines, 2^j the largest power not above n.  All but the first place of
an interval (lowest key, then line) are later copies, and their lines go, with
the lines without words from the first to the last of them.  A numbered line has at least one word, so a window has at most ``min_words`` lines, and
doubling ends at that length however long the copied runs are.

Each round is a map-side combined grouping and two equi-joins over the runs
still in play; every level is written to the shared folder.

Defined cases: null and empty texts never match and stay; lines without words
never match, go when they are inside a deleted run and stay elsewhere;
documents with a null key stay as they are; runs never cross documents; rows equal in key and text are one document, so each
loses the same lines; rows equal in key alone are ordered by the hash of their
text; a text left without lines is empty; empty tables stay empty; other
columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from martkit.llm.common import stage, table

MIN_WORDS = 25


PLACE = ["k", "t", "at"]


def numbered_lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(k, t, at, line, id, words): lines with words, numbered by ``at`` among
    themselves and by ``line`` among all; t tells equal keys apart."""
    base = docs.select(F.col(key).alias("k"), F.col(text).alias("x")).where("k IS NOT NULL AND x IS NOT NULL")
    rows = base.select("k", F.xxhash64("x").alias("t"), F.posexplode(F.split("x", "\n", -1)).alias("line", "own"))
    words = F.regexp_count("own", F.lit(r"[^\x20\x09-\x0D]+"))
    rows = rows.select("k", "t", "line", F.unhex(F.md5("own")).alias("id"), words.alias("words")).where("words > 0")
    # one exchange serves the grouping here and the windows over a document
    rows = rows.repartition("k", "t").groupBy("k", "t", "line").agg(F.first("id").alias("id"), F.first("words").alias("words"))
    return rows.withColumn("at", F.row_number().over(Window.partitionBy("k", "t").orderBy("line")))


def smallest_windows(lines: DataFrame, min_words: int) -> DataFrame:
    """(k, t, at, n, start, end): the shortest runs of ``min_words`` words that start or
    end at a line, and two neighbours of so many each; ``start`` and ``end`` are
    their first and last line among all."""
    own = Window.partitionBy("k", "t")
    # words before and up to a line; both grow with every line
    in_order = own.orderBy("at")
    sums = lines.select(*PLACE, "line", "words", F.sum("words").over(in_order).alias("upto"),
                        F.lead("line").over(in_order).alias("next"), F.lead("words").over(in_order).alias("more"))
    sums = sums.withColumn("before", F.col("upto") - F.col("words"))
    ahead = own.orderBy("before").rangeBetween(0, min_words - 1)
    behind = own.orderBy("upto").rangeBetween(1 - min_words, 0)
    ends = F.struct(F.col("at"), F.count("*").over(ahead).alias("n"), (F.max("upto").over(ahead) - F.col("before")).alias("w"),
                    F.col("line").alias("start"), F.max("line").over(ahead).alias("end"))
    starts = F.struct(F.min("at").over(behind).alias("at"), F.count("*").over(behind).alias("n"), (F.col("upto") - F.min("before").over(behind)).alias("w"),
                      F.min("line").over(behind).alias("start"), F.col("line").alias("end"))
    # also where no line is between: the copy may have one there
    two = F.when((F.col("words") >= min_words) & (F.col("more") >= min_words), F.struct(F.col("at"), F.lit(2).cast("long").alias("n"), (F.col("words") + F.col("more")).cast("long").alias("w"),
                                 F.col("line").alias("start"), F.col("next").alias("end")))
    kinds = sums.select("k", "t", ends.alias("e"), starts.alias("s"), two.alias("p"))
    whole = kinds.select("k", "t", F.explode(F.array("e", "s", "p")).alias("v")).select("k", "t", "v.*").where(F.col("w") >= min_words)
    return whole.select(*PLACE, F.col("n").cast("int").alias("n"), "start", "end").distinct()


def _named(pairs: DataFrame) -> DataFrame:
    """Names of the values found twice, in their order: (a, b, name)."""
    found = pairs.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1").select("a", "b")
    ranked = found.repartitionByRange("a", "b").sortWithinPartitions("a", "b")
    return stage(ranked.withColumn("name", F.monotonically_increasing_id()), "names")


def _shifted(level: DataFrame, by: int) -> DataFrame:
    return level.select("k", "t", (F.col("at") - by).alias("at"), F.col("name").alias("b"))


def repeated_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(k, t, at, n, start, end): windows of n lines with words, from the one numbered
    ``at``, that stand earlier too; their lines from ``start`` to ``end`` together
    are the later copies of all maximal repeated runs."""
    lines = stage(numbered_lines(docs, key, text), "lines")
    windows = stage(smallest_windows(lines, min_words), "windows")
    pairs = lines.select(*PLACE, F.col("id").alias("a"), F.lit(0).alias("b"))
    found, size = None, 1
    while size <= max(2, min_words):  # two neighbours are a window of any size
        level = stage(pairs.join(_named(pairs), ["a", "b"]).select(*PLACE, "name"), "level")
        # windows of size to 2 * size - 1 lines, by the names of both their ends
        own = windows.where(F.col("n").between(size, 2 * size - 1)).withColumn("back", F.col("at") + F.col("n") - size)
        tails = level.select("k", "t", F.col("at").alias("back"), F.col("name").alias("b"))
        named = own.join(level.withColumnRenamed("name", "a"), PLACE).join(tails, ["k", "t", "back"])
        part = named.select(*PLACE, "n", "start", "end", "a", "b")
        found = part if found is None else found.unionByName(part)
        pairs = level.select(*PLACE, F.col("name").alias("a")).join(_shifted(level, size), PLACE)
        size *= 2
    found = stage(found, "runs")
    same = ["n", "a", "b"]
    first = found.groupBy(*same).agg(F.min(F.struct(*PLACE)).alias("first"), F.count("*").alias("times")).where("times > 1")
    return found.join(first, same).where(F.struct(*PLACE) > F.col("first")).select(*PLACE, "n", "start", "end")


def deleted_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(k, t, gone): the sorted numbers of each text's deleted lines."""
    runs = repeated_runs(docs, key, text, min_words)
    each = runs.select("k", "t", F.explode(F.sequence("start", "end")).alias("line"))
    return each.groupBy("k", "t").agg(F.array_sort(F.collect_set("line")).alias("gone"))


def drop_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, report: str | None = None) -> DataFrame:
    """``docs`` with the deleted lines taken out of ``text``; with ``report``
    a column of that name counts them."""
    gone = deleted_lines(docs, key, text, min_words)
    # the caller's columns travel inside one struct, so no name can clash
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(key).alias("k"), F.xxhash64(text).alias("t"))
    joined = keyed.join(gone, ["k", "t"], "left")
    own = F.col("row").getField(text)
    # one pass over a text's lines: kept numbers by a hash set, lines by their numbers;
    # the outer transform holds the split text, so it is split once
    kept = lambda own_lines: F.array_except(F.sequence(F.lit(0), F.size(own_lines) - 1), F.col("gone").cast("array<int>"))
    joined_lines = lambda own_lines: F.array_join(F.transform(kept(own_lines), lambda i: F.get(own_lines, i)), "\n")
    left = F.transform(F.array(F.split(own, "\n", -1)), joined_lines)[0]
    out = F.when(F.col("gone").isNull(), own).otherwise(left)
    columns = [(out if c == text else F.col("row").getField(c)).alias(c) for c in docs.columns]
    if report:
        columns.append(F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias(report))
    return joined.select(*columns)


def q_op10(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = drop_repeated_lines(docs.select("doc_id", "text"), report="n_removed_lines")
    return out.select("doc_id", "n_removed_lines", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars_left"),
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


QUERIES = {"op10_line_dedup": q_op10}
ORACLE_SQL: dict[str, str] = {}

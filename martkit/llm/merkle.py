"""Merkle manifest of a dataset with pointer-jumping proofs (operator 11).

Every row is a leaf, the digest of its fields.  The leaves of a group (a source,
say) are stacked in key order, 16 to a run, until one node is left; the groups'
roots are stacked the same way.  The nodes of a run share their siblings, so the
run is what holds a segment: its digests in order, and the place of its parent
in the parent's run.  A run first points at its parent's run.  Each self-join
appends the segments of the run pointed at and takes over its pointer, which
doubles the distance, until every run that holds leaves reaches the root; a path
of d runs takes log2(d) joins.  A leaf's proof is its run's path without the
nodes on the way up.

* Texts are read once and never shuffled, only digests are.
* Places within a group come from a range sort over (group, key) and the counts
  of each range, so a group holding a third of the rows is many ranges, not one
  window.  A run has at most 16 members, whatever the group's size.
* The doubling moves runs, a fifteenth of the leaves.  Runs that are pointed at
  over distance 2^k stand on level 2^k or above and are a 16^(2^k)th of them;
  where these few fit a measured bound they are broadcast, else both sides are
  shuffled on the pointer, which is then shared by few rows.
* The only thing the driver reads is the size of the largest group and the
  number of groups, which give the number of levels.

Defined cases: a null field is ``-`` in the leaf; a null key sorts first, a null
group is a group and the first one; rows with equal keys stand in the order of
their digests, and equal rows are leaves each; a lone leaf is its group's root, a
lone group's root is the root; without rows there are no rows.  Other columns
never take part.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martkit.llm.common import stage, table
from martkit.operators.sizing import BroadcastPolicy, dimension

ARITY = 16
HEX = 64  # characters of a digest
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ID = "struct<tree:bigint,level:int,run:bigint>"
TOP_TREE = -1  # the tree over the groups' roots


def leaf_digest(fields: Sequence[Column]) -> Column:
    """SHA-256, as hex, of the fields: ``-`` for null, else byte count, ``:``, value."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def per_run(count: Column) -> Column:
    return F.call_function("div", count, F.lit(ARITY))


def run_id(tree: Column, level: int, run: Column) -> Column:
    return F.struct(tree.cast("bigint").alias("tree"), F.lit(level).alias("level"), run.cast("bigint").alias("run")).cast(ID)


def numbered(rows: DataFrame, by: list[str], order: list[str], name: str, labels: DataFrame | None = None) -> DataFrame:
    """``rows`` plus ``at``, the place in its group from 0, and ``n``, the group's
    size.  ``labels`` has columns for each group, which its rows get."""
    cut = rows.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order)
    cut = stage(cut.withColumn("_i", F.monotonically_increasing_id()), name)  # the range above bit 33, then rows in turn
    ranges = cut.groupBy(*by, F.shiftright("_i", 33).alias("_r")).agg(F.min("_i").alias("_first"), F.count("*").alias("_here"))
    group = Window.partitionBy(*by)
    earlier = F.sum("_here").over(group.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1))
    starts = ranges.withColumn("_shift", F.coalesce(earlier, F.lit(0)) - F.col("_first")).withColumn("n", F.sum("_here").over(group))
    starts = starts.drop("_first", "_here")
    if labels is not None:
        starts = starts.join(labels, by)
    return cut.withColumn("_r", F.shiftright("_i", 33)).join(starts, [*by, "_r"]).withColumn("at", F.col("_i") + F.col("_shift")).drop("_i", "_r", "_shift")


def levels_of(n: int) -> int:
    """Levels of runs over n nodes."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def stack(nodes: DataFrame, levels: int, name: str, above: int, carry: Sequence[str] = ()) -> tuple[list[DataFrame], DataFrame]:
    """The runs of each level over ``nodes`` (tree, at, n, h), and what remains of
    each tree (tree, h).  ``above``: so many trees are stacked upon these (0: none).
    Members are (at, h) and on the first level the columns ``carry`` too."""
    runs, tops = [], []
    for level in range(levels):
        tops.append(nodes.where("n = 1").select("tree", "h"))
        held = F.array_sort(F.collect_list(F.struct("at", "h", *(carry if not level else ()))))
        full = nodes.where("n > 1").groupBy("tree", "n", per_run(F.col("at")).alias("run")).agg(held.alias("members"))
        full = full.withColumn("digests", F.array_join(F.transform("members", lambda m: m["h"]), ""))
        full = stage(full.withColumn("more", per_run(F.col("n") + (ARITY - 1))), f"{name}_{level}")
        inside, tree, run = F.col("more") > 1, F.col("tree"), F.col("run")
        beyond = run_id(F.lit(TOP_TREE), 0, per_run(tree)) if above > 1 else F.lit(None).cast(ID)
        segment = F.struct(
            "digests", F.pmod(F.when(inside, run).otherwise(tree), F.lit(ARITY)).cast("int").alias("next_at"),
            (~inside & F.lit(above > 0)).alias("group_top"),
        )
        runs.append(full.select(
            run_id(tree, level, run).alias("id"), F.when(inside, run_id(tree, level + 1, per_run(run))).otherwise(beyond).alias("up"),
            F.array(segment).alias("path"), "members",
        ))
        nodes = full.select("tree", F.col("run").alias("at"), F.col("more").alias("n"), F.sha2("digests", 256).alias("h"))
    return runs, reduce(DataFrame.unionByName, tops, nodes.select("tree", "h"))


def jump(runs: DataFrame, depth: int, policy: BroadcastPolicy) -> DataFrame:
    """``runs`` (id, up, path) with paths that reach the root, in log2(depth)
    self-joins.  Kept are the runs that hold leaves and those still pointed at."""
    distance = 1
    upper = F.col("id.tree") == TOP_TREE
    while distance < depth:
        met = runs.where(upper | (F.col("id.level") >= distance))
        met = dimension(met.select(F.col("id").alias("_id"), F.col("up").alias("_up"), F.col("path").alias("_path")), policy)
        needed = runs.where(upper | (F.col("id.level") == 0) | (F.col("id.level") >= 2 * distance))
        path = F.when(F.col("_path").isNull(), F.col("path")).otherwise(F.concat("path", "_path"))
        runs = needed.join(met, F.col("up") == F.col("_id"), "left").select("id", F.col("_up").alias("up"), path.alias("path"))
        runs = stage(runs, f"reach_{distance}")
        distance *= 2
    return runs


def merkle_proofs(
    docs: DataFrame,
    key: str = "doc_id",
    group: str = "source",
    fields: Sequence[str] = FIELDS,
    carry: Mapping[str, Column] | None = None,
    policy: BroadcastPolicy = BroadcastPolicy(),
) -> DataFrame:
    """One row per document: key, leaf, subroot, root, the columns ``carry``
    computed from the document, and proof: (left, right), the digests before and
    after it in its run, from its own level up to the root."""
    more = dict(carry or {})
    columns = [F.col(group).isNotNull().alias("named"), F.coalesce(F.col(group).cast("string"), F.lit("")).alias("name")]
    carried = [c.alias(f"c_{i}") for i, c in enumerate(more.values())]
    leaves = stage(docs.select(*columns, F.col(key).alias("k"), leaf_digest([F.col(f) for f in fields]).alias("h"), *carried), "leaves")
    by, rest = ["named", "name"], ["k", *[f"c_{i}" for i in range(len(more))]]
    sizes = leaves.groupBy(*by).agg(F.count("*").alias("size"))
    largest, groups = sizes.agg(F.coalesce(F.max("size"), F.lit(0)), F.count("*")).first()
    trees = numbered(sizes.select(*by), [], by, "groups").select(*by, F.col("at").alias("tree"))
    placed = numbered(leaves, by, ["k", "h"], "placed", trees)
    low, high = levels_of(largest), levels_of(groups)
    below, roots = stack(placed, low, "run", groups, rest)
    above, _ = stack(roots.select(F.lit(TOP_TREE).cast("bigint").alias("tree"), F.col("tree").alias("at"), F.lit(groups).cast("bigint").alias("n"), "h"), high, "top", 0)

    # members by the run that holds them; a lone leaf stands among the groups' roots
    lone = placed.where("n = 1").withColumn("run", per_run(F.col("tree")))
    place = F.pmod(F.col("tree"), F.lit(ARITY)).alias("at")
    lone = lone.groupBy("run").agg(F.collect_list(F.struct(place, "h", *rest)).alias("members"))
    home = run_id(F.lit(TOP_TREE), 0, F.col("run")) if groups > 1 else F.lit(None).cast(ID)
    homes = lone.select(home.alias("home"), "members", F.lit(True).alias("alone"))
    if below:
        homes = homes.unionByName(below[0].select(F.col("id").alias("home"), "members", F.lit(False).alias("alone")))
    chains = [x.select("id", "up", "path") for x in [*below, *above]]
    if chains:
        paths = jump(reduce(DataFrame.unionByName, chains), low + high, policy).select("id", "path")
        held = homes.join(paths, F.col("home") == F.col("id"), "left")
    else:  # one leaf, or none
        held = homes.withColumn("path", F.lit(None).cast("array<struct<digests:string,next_at:int,group_top:boolean>>"))

    end = lambda segment: F.sha2(segment["digests"], 256)
    held = held.select(
        "members", "alone", F.coalesce("path", F.array().cast(held.schema["path"].dataType)).alias("path")
    ).withColumn("top", F.get(F.filter("path", lambda s: s["group_top"]), F.lit(0)))
    held = held.select(
        F.explode("members").alias("m"), "path", F.when(~F.col("alone"), end(F.col("top"))).alias("subroot"),
        F.when(F.size("path") > 0, end(F.element_at("path", -1))).alias("root"),
    )

    def siblings(segment: Column, i: Column) -> Column:
        at = F.when(i == 0, F.pmod(F.col("m.at"), F.lit(ARITY)).cast("int")).otherwise(F.get("path", i - 1)["next_at"])
        left = F.substring(segment["digests"], F.lit(1), at * HEX)
        return F.struct(left.alias("left"), F.substring(segment["digests"], at * HEX + HEX + 1, F.lit(ARITY * HEX)).alias("right"))

    return held.select(
        F.col("m.k").alias(key), F.col("m.h").alias("leaf"), F.coalesce("subroot", "m.h").alias("subroot"),
        F.coalesce("root", "m.h").alias("root"), F.transform("path", siblings).alias("proof"),
        *[F.col(f"m.c_{i}").alias(name) for i, name in enumerate(more)],
    )


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof give."""
    return F.aggregate(proof, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def proof_digest(proof: Column) -> Column:
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def q_op11(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    other = [F.translate(F.col(f), UPPER, LOWER) if f == "text" else F.col(f) for f in FIELDS]
    changed = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, leaf_digest(other))
    found = merkle_proofs(docs, carry={"changed": changed})
    found = found.withColumn("folded_root", folded(F.coalesce("changed", "leaf"), F.col("proof")))
    return found.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _leaf_sql(text: str) -> str:
    texts = [f"CAST({text if f == 'text' else f} AS VARCHAR)" for f in FIELDS]
    return "sha256(" + " || ".join(f"coalesce(CAST(strlen({t}) AS VARCHAR) || ':' || {t}, '-')" for t in texts) + ")"


QUERIES = {"op11_merkle_manifest": q_op11}
ORACLE_SQL = {
    "op11_merkle_manifest": f"""
WITH RECURSIVE places AS (
  SELECT row_number() OVER () AS id, doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
         {_leaf_sql("text")} AS leaf, {_leaf_sql(f"translate(text, '{UPPER}', '{LOWER}')")} AS lowered,
         xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT)),
             lambda a, x: list_reduce(range(8), lambda c, k: xor(c >> 1, 3988292384 * (c & 1)), xor(a, x)), 4294967295),
             4294967295) AS crc
  FROM documents
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS spot FROM places
), low(tree, level, spot, h) AS (
  SELECT tree, 0, spot, leaf FROM leaves
  UNION ALL
  SELECT tree, level + 1, spot // 16, sha256(string_agg(h, '' ORDER BY spot))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM low) WHERE n > 1 GROUP BY tree, level, spot // 16
), tops AS (SELECT tree, arg_max(h, level) AS h FROM low GROUP BY tree
), high(level, spot, h) AS (
  SELECT 0, tree, h FROM tops
  UNION ALL
  SELECT level + 1, spot // 16, sha256(string_agg(h, '' ORDER BY spot))
  FROM (SELECT *, count(*) OVER () AS n FROM high) WHERE n > 1 GROUP BY level, spot // 16
), runs AS (
  SELECT tree, level, spot // 16 AS run, string_agg(h, '' ORDER BY spot) AS digests
  FROM (SELECT *, count(*) OVER (PARTITION BY tree, level) AS n FROM low) WHERE n > 1 GROUP BY tree, level, spot // 16
  UNION ALL
  SELECT -1, level, spot // 16, string_agg(h, '' ORDER BY spot)
  FROM (SELECT *, count(*) OVER (PARTITION BY level) AS n FROM high) WHERE n > 1 GROUP BY level, spot // 16
), fold(id, step, tree, level, spot, h, proof) AS (
  SELECT id, 0, tree, 0, spot, CASE WHEN crc % 5 = 0 THEN lowered ELSE leaf END, '' FROM leaves
  UNION ALL
  SELECT f.id, f.step + 1, CASE WHEN r.run IS NULL THEN -1 ELSE f.tree END, CASE WHEN r.run IS NULL THEN 0 ELSE f.level + 1 END,
         CASE WHEN r.run IS NULL THEN f.tree ELSE f.spot // 16 END,
         CASE WHEN r.run IS NULL THEN f.h
              ELSE sha256(substr(r.digests, 1, 64 * (f.spot % 16)) || f.h || substr(r.digests, 64 * (f.spot % 16) + 65)) END,
         CASE WHEN r.run IS NULL THEN f.proof
              ELSE f.proof || substr(r.digests, 1, 64 * (f.spot % 16)) || substr(r.digests, 64 * (f.spot % 16) + 65) END
  FROM fold f LEFT JOIN runs r ON r.tree = f.tree AND r.level = f.level AND r.run = f.spot // 16
  WHERE r.run IS NOT NULL OR f.tree >= 0
), ends AS (SELECT id, arg_max(h, step) AS folded_root, arg_max(proof, step) AS proof FROM fold GROUP BY id)
SELECT l.doc_id, l.leaf, t.h AS subroot, r.root, sha256(e.proof) AS proof_sha256, e.folded_root, e.folded_root = r.root AS verified
FROM leaves l JOIN ends e USING (id) JOIN tops t USING (tree), (SELECT arg_max(h, level) AS root FROM high) r""",
}

"""Random small tables: operators against a brute-force pandas computation."""

import math

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from martkit.operators.marts import dim_average, flagged_counts, orphan_counts, visit_counts
from martkit.operators.ranking import rank_within

CODES = st.sampled_from(["AA", "BB", "CC", "DD", None])
PLACES = st.sampled_from(["P1", "P2", "P3", None])
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

fact_rows = st.lists(
    st.tuples(CODES, PLACES, PLACES, st.one_of(st.none(), st.integers(0, 50)), st.sampled_from([0, 1])),
    min_size=0, max_size=60,
)
dim_rows = st.lists(st.tuples(st.sampled_from(["AA", "BB", "CC", "ZZ"]), st.sampled_from(["n1", "n2"])), max_size=5)
place_rows = st.lists(st.sampled_from(["P1", "P2", "P9"]), max_size=4)

FACT = "AIRLINE string, ORIGIN string, DEST string, DISTANCE int, CANCELLED int"


def key(v):
    return (v is None, "" if v is None else str(v))


def rows(df):
    return sorted((tuple(None if (isinstance(x, float) and math.isnan(x)) else x for x in r) for r in df.collect()),
                  key=lambda t: tuple(key(x) for x in t))


def brute_sorted(items):
    return sorted(items, key=lambda t: tuple(key(x) for x in t))


@SETTINGS
@given(facts=fact_rows, dims=dim_rows, places=place_rows)
def test_marts_match_brute_force(spark, facts, dims, places):
    f = spark.createDataFrame(facts, FACT)
    d = spark.createDataFrame(dims, "IATA_CODE string, NAME string")
    p = spark.createDataFrame([(x,) for x in places], "CODE string")
    pf = pd.DataFrame(facts, columns=["AIRLINE", "ORIGIN", "DEST", "DISTANCE", "CANCELLED"])

    # M1: inner join on code, group by (code, name), mean of non-null distances
    expected = []
    for (code, name) in {(c, n) for c, n in dims}:
        mult = dims.count((code, name))
        vals = [r[3] for r in facts if r[0] == code for _ in range(mult)]
        if any(r[0] == code for r in facts):
            nn = [v for v in vals if v is not None]
            expected.append((name, sum(nn) / len(nn) if nn else None))
    got = rows(dim_average(f, d, "AIRLINE", "IATA_CODE", "NAME", "DISTANCE", order=False))
    assert got == brute_sorted(expected)

    # M2: inner joins on origin (places) and carrier (dims), count per (dest, name)
    counts = {}
    for a, o, dst, _, _ in facts:
        m = places.count(o) if o is not None else 0
        for code, name in dims:
            if a is not None and code == a and m:
                counts[(dst, name)] = counts.get((dst, name), 0) + m
    got = rows(visit_counts(f, p, d, origin="ORIGIN", dest="DEST", carrier="AIRLINE", place_key="CODE",
                            carrier_key="IATA_CODE", carrier_label="NAME", order=False))
    assert got == brute_sorted([(k[0], k[1], v) for k, v in counts.items()])

    # M4: non-null carrier count per (carrier, dest) among cancelled rows
    sub = pf[pf["CANCELLED"] == 1]
    exp = {}
    for a, dst in zip(sub["AIRLINE"], sub["DEST"]):
        exp[(a, dst)] = exp.get((a, dst), 0) + (a is not None)
    got = rows(flagged_counts(f, "CANCELLED", "1", ["AIRLINE", "DEST"]))
    assert got == brute_sorted([(k[0], k[1], v) for k, v in exp.items()])

    # M6: rows per dest not in places (NULL never matches)
    exp = {}
    for dst in pf["DEST"]:
        if dst is None or dst not in places:
            exp[dst] = exp.get(dst, 0) + 1
    got = rows(orphan_counts(f, p, "DEST", "CODE"))
    assert got == brute_sorted(list(exp.items()))


@SETTINGS
@given(
    data=st.lists(st.tuples(st.sampled_from(["g1", "g2", None]), st.one_of(st.none(), st.integers(0, 6))), max_size=50),
    descending=st.booleans(),
)
def test_rank_matches_brute_force(spark, data, descending):
    df = spark.createDataFrame([(g, v, i) for i, (g, v) in enumerate(data)], "g string, v int, i int")
    expected = {}
    for i, (g, v) in enumerate(data):
        peers = [w for h, w in data if h == g]
        if v is None:  # NULLs sort last descending, first ascending
            before = len([w for w in peers if w is not None]) if descending else 0
        elif descending:
            before = len([w for w in peers if w is not None and w > v])
        else:
            before = len([w for w in peers if w is None or w < v])
        expected[i] = before + 1
    for method, kw in (("window", {}), ("histogram", {}), ("distributed", {"ranges": 3})):
        got = {r.i: r.ranking for r in rank_within(df, "g", "v", method=method, descending=descending, **kw).collect()}
        assert got == expected, method


delta_rows = st.lists(st.tuples(st.sampled_from(["k1", "k2", "k3", "k4", None]), st.sampled_from(["a", "b"])), max_size=12)


@SETTINGS
@given(src=delta_rows, tgt=delta_rows)
def test_delta_matches_brute_force(spark, src, tgt):
    from martkit.functions.keys import row_hash
    from martkit.operators.delta import classify_delta, delta_inserts, delta_matched, delta_updates, upsert_snapshot

    schema = "k string, v string"
    s = row_hash(spark.createDataFrame(src, schema))
    t = row_hash(spark.createDataFrame(tgt, schema))
    t_keys = {k for k, _ in tgt if k is not None}
    t_rows = set(tgt)  # the digest covers the key, so "digest in target" == "row in target"

    def action(k, v):
        if k is None or k not in t_keys:
            return "insert"
        return "unchanged" if (k, v) in t_rows else "update"

    def pairs(df, *cols):
        return brute_sorted([tuple(r[c] for c in cols) for r in df.collect()])

    assert pairs(classify_delta(s, t, "k"), "k", "v", "action") == brute_sorted([(k, v, action(k, v)) for k, v in src])
    assert pairs(delta_inserts(s, t, "k"), "k", "v") == brute_sorted([r for r in src if action(*r) == "insert"])
    assert pairs(delta_matched(s, t, "k"), "k") == brute_sorted([(k,) for k, _ in src if k is not None and k in t_keys])
    assert pairs(delta_updates(s, t, "k"), "k") == brute_sorted([(k,) for k, v in src if action(k, v) == "update"])
    # applied: one row per key (NULL is a key), the one with the largest digest
    digest = {(r.k, r.v): r.hash_id for r in s.collect()}
    best = {}
    for r in src:
        if r[0] not in best or digest[r] > digest[best[r[0]]]:
            best[r[0]] = r
    changed = [r for r in best.values() if r not in t_rows]
    expected = [r for r in tgt if r[0] not in {k for k, _ in changed}] + changed
    once = upsert_snapshot(s, t, "k")
    assert pairs(once, "k", "v") == brute_sorted(expected)
    assert pairs(upsert_snapshot(s, once, "k"), "k", "v") == brute_sorted(expected)


@SETTINGS
@given(exp=delta_rows, act=delta_rows)
def test_readback_matches_brute_force(spark, exp, act):
    from collections import Counter

    from martkit.operators.quality import readback_check

    schema = "k string, v string"
    r = readback_check(spark.createDataFrame(exp, schema), spark.createDataFrame(act, schema)).collect()[0]
    ce, ca = Counter(exp), Counter(act)
    missing = sum((ce - ca).values())
    extra = sum((ca - ce).values())
    assert (r.expected_rows, r.actual_rows, r.missing_rows, r.extra_rows, r.matches) == (
        len(exp), len(act), missing, extra, missing == 0 and extra == 0,
    )

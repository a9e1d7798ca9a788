"""Operators against plain Python loops, for several plans of the same query."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from registrylake.operators import allocate, bridge, carry, crosswalk, dedupe, keysets, profile, reconcile, tenure


def number(s):
    try:
        return float(s)
    except (TypeError, ValueError):
        return None


def completions(seed, n=1500, keys=25):
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        key = rng.choice([None] + ["hot"] * 12 + [f"w{k}" for k in range(keys)])
        date = rng.choice([None, "0", "abc", "19990101", "20010101", "20010101", "20100505", "123"])
        rows.append((key, rng.choice([None, "A", "B", "C"]), date, rng.choice([None, "L1", "L2", "L3", "L4"]), rng.choice([None, "r"]), seq))
    return rows


COLUMNS = "api10 string, operator string, completion string, lease_name string, gas_rrcid string, seq bigint"


def tenure_by_loop(rows):
    by_key = defaultdict(list)
    for key, op, date, lease, _, seq in rows:
        if key is not None and op is not None:
            by_key[key].append((number(date) or 0.0, seq, op, date, lease))
    out = []
    for key, events in by_key.items():
        stays = []
        for _, _, op, date, lease in sorted(events, key=lambda e: e[:2]):
            if not stays or stays[-1][0] != op:
                stays.append((op, date, lease))
        for i, (op, date, lease) in enumerate(stays):
            last = i == len(stays) - 1
            out.append((key, "", op, date, None if last else stays[i + 1][1], last, lease or "", ""))
    return sorted(out, key=repr)


@pytest.mark.parametrize("ranges", [None, 1, 7, 60, 900])
@pytest.mark.parametrize("seed", [1, 2])
def test_tenure(spark, seed, ranges):
    rows = completions(seed)
    df = spark.createDataFrame(rows, COLUMNS).repartition(3)
    got = tenure.operator_tenure(df, ["seq"], ranges=ranges)
    assert sorted(map(tuple, got.collect()), key=repr) == tenure_by_loop(rows)
    assert tenure.multiple_current(got).count() == 0


def iso(x):
    s = str(int(x)) if x is not None and x > 0 else ""
    return f"{s[:4]}-{s[4:6]}-{s[6:8]}" if len(s) == 8 else None


def crosswalk_by_loop(rows):
    pairs, last = defaultdict(list), {}
    for key, _, date, lease, record, seq in rows:
        if key is None or lease is None:
            continue
        n = number(date)
        pairs[key, lease].append((n, record))
        rank = (n is None, n or 0.0, seq)
        if key not in last or rank > last[key][0]:
            last[key] = (rank, lease)
    out = []
    for (key, lease), seen in pairs.items():
        numbers = [n for n, _ in seen if n is not None]
        current = last[key][1] == lease
        out.append(
            (key, lease, iso(min(numbers, default=None)), None if current else iso(max(numbers, default=None)), current,
             sum(r is not None for _, r in seen), "")
        )
    return sorted(out, key=repr)


def test_crosswalk(spark):
    rows = completions(3)
    df = spark.createDataFrame(rows, COLUMNS).repartition(3)
    got = crosswalk.lease_crosswalk(df, ["seq"])
    assert sorted(map(tuple, got.collect()), key=repr) == crosswalk_by_loop(rows)


@pytest.mark.parametrize("ranges", [None, 1, 5, 600])
def test_carry_forward(spark, ranges):
    rng = random.Random(5)
    rows = [(f, i, rng.choice("RCPPPPPPPPxxx"), rng.randrange(100)) for f in ("a", "b") for i in range(1000)]
    rows += [("quiet", i, "P", i) for i in range(50)]
    df = spark.createDataFrame(rows, "f string, i bigint, kind string, v int").repartition(5)
    when = lambda k: F.when(F.col("kind") == k, F.col("v"))
    got = carry.carry_forward(df, "i", {"root": when("R"), "cycle": when("C")}, ["f"], ranges)
    want, state = {}, {}
    for f, i, kind, v in rows:
        root, cycle = state.get(f, (None, None))
        state[f] = (v if kind == "R" else root, v if kind == "C" else cycle)
        want[f, i] = state[f]
    assert {(r.f, r.i): (r.root, r.cycle) for r in got.collect()} == want


def test_carry_of_one_sequence_with_a_far_index(spark):
    """Ranges have equal numbers of rows though one index lies far off; nulls stay nulls, also in the group."""
    rows = [(i if i < 999 else 10**15, "x" if i % 400 == 7 else None) for i in range(1000)]
    df = spark.createDataFrame(rows, "i bigint, v string")
    got = carry.carry_forward(df, "i", {"last": F.col("v")}, ranges=300)
    want = [None] * 7 + ["x"] * 993
    assert [r.last for r in got.orderBy("i").collect()] == want
    parts = carry._filled(carry.in_ranges(df, [], ["i"], 10), [], []).groupBy("_part").count().collect()
    assert len(parts) > 5 and max(r["count"] for r in parts) < 300
    grouped = spark.createDataFrame([(None, 1, "a"), (None, 2, None), ("g", 1, None), ("g", 2, "b")], "g string, i int, v string")
    got = carry.carry_forward(grouped, "i", {"last": F.col("v")}, ["g"], ranges=4)
    assert {(r.g, r.i): r["last"] for r in got.collect()} == {(None, 1): "a", (None, 2): "a", ("g", 1): None, ("g", 2): "b"}
    assert carry.carry_forward(grouped.limit(0), "i", {"last": F.col("v")}, ["g"]).collect() == []


def test_first_rows_keeps_null_keys_and_order(spark):
    rows = [(None, None, 3), (None, None, 1), ("a", None, 2), ("a", "x", 5), ("a", "x", 4)]
    df = spark.createDataFrame(rows, "k string, r string, seq int").repartition(3)
    got = dedupe.first_rows(df, ["k", "r"], ["seq"]).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(None, None, 1), ("a", None, 2), ("a", "x", 4)], key=repr)


def test_subsets_and_key_sets(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("b", 3), (None, 4), ("c", 5)], "k string, seq int").repartition(2)
    assert sorted(r.seq for r in keysets.first_n_keys(df, "k", ["seq"], 3).collect()) == [1, 2, 3, 4]
    assert [r.seq for r in keysets.first_n_rows(df, ["seq"], 2).collect()] == [1, 2]
    other = spark.createDataFrame([("a",), ("z",), (None,), ("z",)], "j string")
    assert tuple(keysets.key_set_difference(df, other, "k", "j").first()) == (2, 1, False)
    assert tuple(keysets.key_set_difference(df, df, "k", "k").first()) == (0, 0, True)


def test_volatility(spark):
    rows = [("a", 1, "x", None), ("a", 1, "y", None), ("b", 2, "x", "p"), ("b", 2, "x", None), ("c", 9, "q", "r")]
    df = spark.createDataFrame(rows, "k string, steady int, moving string, sparse string")
    got = {r.column_name: (r.multi_row_keys, r.varying_keys, r.column_class) for r in profile.column_volatility(df, "k", ["steady", "moving", "sparse"]).collect()}
    assert got == {"steady": (2, 0, "well_property"), "moving": (2, 1, "event_property"), "sparse": (2, 0, "well_property")}


@pytest.mark.parametrize("salt_rows", [1000, 2, 1])
@pytest.mark.parametrize("method", ["equal", "proportional", "single"])
def test_allocation(spark, method, salt_rows):
    prod = [("A", 202101, 100), ("A", 202102, 90), ("B", 202101, 50), ("C", 202101, 7), ("A", 202109, 5)]
    wells = [("A", "w1", 202101, None, 1), ("A", "w2", 202102, 202103, 3), ("B", "w3", None, 202101, 1), ("B", "w4", 202001, 202102, 2),
             ("A", "w5", 202102, 202102, 9)]
    p = spark.createDataFrame(prod, "lease string, month int, volume bigint")
    w = spark.createDataFrame(wells, "lease string, api10 string, effective_month int, termination_month int, w int")
    weight = "w" if method == "proportional" else None
    got = allocate.allocate_to_wells(p, w, ["lease"], method=method, weight=weight, salt_rows=salt_rows).collect()
    want = set()
    for lease, month, volume in prod:
        on = [(x[1], x[4]) for x in wells if x[0] == lease and (x[2] is None or x[2] <= month) and (x[3] is None or month < x[3])]
        if method == "single" and len(on) != 1:
            on = []
        total = sum(k for _, k in on)
        for name, k in on:
            want.add((lease, month, name, len(on), volume, volume * k / total if method == "proportional" else volume / len(on)))
        if not on:
            want.add((lease, month, None, 0, volume, float(volume)))
    assert set(map(tuple, got)) == want and len(got) == len(want)


def test_allocation_leaves_out_wells_of_unknown_weight(spark):
    p = spark.createDataFrame([("A", 1, 100), ("B", 1, 7)], "lease string, month int, volume bigint")
    wells = [("A", "w1", None, None, 1.0), ("A", "w2", None, None, None), ("A", "w3", None, None, 3.0), ("B", "w4", None, None, None)]
    w = spark.createDataFrame(wells, "lease string, api10 string, effective_month int, termination_month int, w double")
    got = allocate.allocate_to_wells(p, w, ["lease"], method="proportional", weight="w").collect()
    assert {(r.lease, r.api10, r.n_wells, r.share) for r in got} == {("A", "w1", 2, 25.0), ("A", "w3", 2, 75.0), ("B", None, 0, 7.0)}


def test_reconcile_takes_one_source_row_a_key(spark):
    columns = "k string, oil_production_bbl int, casinghead_gas_mcf int, place int"
    ours = spark.createDataFrame([("a", 5, 6, 0), ("b", 1, 1, 0)], columns)
    theirs = spark.createDataFrame([("a", 9, 9, 2), ("a", 5, 6, 1), ("b", None, 1, 1), ("b", 1, 1, 2)], columns)
    got = {r.k: r.status for r in reconcile.reconcile(ours, theirs, ["k"], order=["place"]).collect()}
    assert got == {"a": reconcile.PASS, "b": reconcile.FAIL_FIRST}
    assert reconcile.reconcile(ours, theirs, ["k"]).count() == 2


def _jobs(spark):
    return spark.sparkContext.statusTracker().getJobIdsForGroup("built")


def test_nothing_runs_while_tenure_and_crosswalk_are_built(spark):
    df = spark.createDataFrame(completions(4), COLUMNS)
    spark.sparkContext.setJobGroup("built", "no job")
    try:
        history, pairs = tenure.operator_tenure(df, ["seq"]), crosswalk.lease_crosswalk(df, ["seq"])
        assert not _jobs(spark)
        history.count(), pairs.count()
        assert _jobs(spark)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_crosswalk_combines_before_the_first_exchange(spark):
    plan = crosswalk.lease_crosswalk(spark.createDataFrame(completions(4), COLUMNS), ["seq"])._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    for at, line in enumerate(lines):
        if "Exchange" in line:  # what feeds it, sorts and projections aside
            below = next(x for x in lines[at + 1 :] if "Sort " not in x and "Project" not in x)
            assert "Aggregate" in below, plan


def test_tenure_of_nothing(spark):
    assert tenure.operator_tenure(spark.createDataFrame([], COLUMNS), ["seq"], ranges=5).collect() == []


# Published spot checks (district, lease, year, month, oil, gas).
SPOT_CHECKS = [
    ("11", "003137", "2023", "03", 859389, 2985212),
    ("02", "009616", "2021", "05", 228372, 186183),
    ("10", "046263", "2022", "07", 517391, 1250347),
    ("03", "026879", "2021", "05", 408, 5600),
    ("09", "017838", "2021", "11", 25, 80),
    ("14", "008148", "2021", "11", 109, 1906),
    ("08", "026346", "2023", "01", 1, 44),
    ("05", "002765", "2022", "08", 2, 0),
    ("13", "033736", "2022", "08", 18, 2229),
    ("06", "004589", "2022", "02", 25, 550),
]


def test_reconcile_all_statuses(spark):
    names = "district string, lease_number string, prod_year string, prod_month string, oil_production_bbl bigint, casinghead_gas_mcf bigint"
    ours = spark.createDataFrame(SPOT_CHECKS, names)
    source = [list(t) for t in SPOT_CHECKS]
    source[0][4] += 1
    source[1][5] += 1
    source[2][4] += 1
    source[2][5] += 1
    theirs = spark.createDataFrame([tuple(t) for t in source[:-1]], names)
    keys = ["district", "lease_number", "prod_year", "prod_month"]
    got = {r.district: r.status for r in reconcile.reconcile(ours, theirs, keys).collect()}
    assert got == {"11": "FAIL_OIL", "02": "FAIL_GAS", "10": "FAIL_MULTIPLE", "06": "NOT_FOUND",
                   **{d: "PASS" for d in ("03", "09", "14", "08", "05", "13")}}


def test_sample_is_stable_and_banded(spark):
    rows = [(i, o, g) for i, (o, g) in enumerate([(200_000, 0), (5, 10), (5, 60), (500, 100)] * 20)]
    df = spark.createDataFrame(rows, "id int, oil int, gas int").withColumn("band", reconcile.volume_band(F.col("oil"), F.col("gas")))
    assert {r.band for r in df.select("band").distinct().collect()} == {"HIGH", "LOW", "GAS_DOM", "MODERATE"}
    a = reconcile.stratified_sample(df, ["band"], ["id"], 3, seed=1)
    b = reconcile.stratified_sample(df.repartition(7), ["band"], ["id"], 3, seed=1)
    assert a.count() == 12 and {r.id for r in a.collect()} == {r.id for r in b.collect()}


def _allocated_by_loop(prod, wells):
    """Proportional shares; spans of a well that overlap are merged one by one."""
    islands = {}
    for lease, name, f, t, w in sorted(wells, key=lambda x: (x[2] is not None, x[2] or 0)):
        known = islands.setdefault((lease, name), [])
        if known and (known[-1][1] is None or f is None or known[-1][1] > f):
            last = known[-1]
            known[-1] = (last[0], None if None in (last[1], t) else max(last[1], t), max(last[2], w))
        else:
            known.append((f, t, w))
    out = set()
    for lease, month, volume in prod:
        on = [(n, w) for (of, n), spans in islands.items() if of == lease for f, t, w in spans if (f is None or f <= month) and (t is None or month < t)]
        total = sum(w for _, w in on)
        out |= {(lease, month, n, len(on), volume, volume * (w / total)) for n, w in on} or {(lease, month, None, 0, volume, float(volume))}
    return out


@pytest.mark.parametrize("salt_rows", [3, 10_000])
def test_allocation_over_spans_that_overlap(spark, salt_rows):
    rng = random.Random(salt_rows)
    spans = []
    for _ in range(300):
        f = rng.choice([None, rng.randint(1, 30)])
        t = rng.choice([None, (f or 0) + rng.randint(1, 12)])
        # a third of all spans on one lease, weights from 1e-300 to 1e300
        spans.append((rng.choice(["hot", f"l{rng.randint(0, 5)}"]), f"w{rng.randint(0, 40)}", f, t, 2.0 ** rng.randint(-1000, 1000)))
    prod = [(lease, m, 1000 + m) for lease in ["hot", "none", *[f"l{i}" for i in range(6)]] for m in range(1, 40)]
    p = spark.createDataFrame(prod, "lease string, month int, volume bigint")
    w = spark.createDataFrame(spans, "lease string, api10 string, effective_month int, termination_month int, w double")
    got = allocate.allocate_to_wells(p, w, ["lease"], method="proportional", weight="w", salt_rows=salt_rows).collect()
    want = {r[:5]: r[5] for r in _allocated_by_loop(prod, spans)}
    assert {tuple(r)[:5] for r in got} == set(want) and len(got) == len(want)
    assert all(r.share == pytest.approx(want[tuple(r)[:5]], rel=1e-9, abs=1e-200) for r in got)


def test_allocation_of_bad_weights(spark):
    p = spark.createDataFrame([("A", 1, 100)], "lease string, month int, volume bigint")
    wells = [("A", "w1", 2e-300), ("A", "w2", 6e-300), ("A", "w3", float("nan")), ("A", "w4", float("inf")), ("A", "w5", -1.0), ("A", "w6", 0.0)]
    w = spark.createDataFrame([(a, b, None, None, c) for a, b, c in wells], "lease string, api10 string, effective_month int, termination_month int, w double")
    got = allocate.allocate_to_wells(p, w, ["lease"], method="proportional", weight="w").collect()
    assert {r.api10: round(r.share, 9) for r in got} == {"w1": 25.0, "w2": 75.0, "w6": 0.0}


def test_lease_well_bridge(spark):
    members = [("01", "5", "w1"), ("01", "5", "w1"), ("01", "5", "w2"), ("02", "", "w1"), (None, "5", "w1"), ("02", "7", None), ("02", "8", "w3")]
    spans = [("w1", "1999-05-02", "2001-02-03", False), ("w1", "2001-02-03", None, True), ("w2", None, "2004-01-01", False), ("w2", "2000-01-01", "2003-01-01", False)]
    m = spark.createDataFrame(members, "district string, lease_number string, api10 string")
    x = spark.createDataFrame(spans, "api10 string, effective_date string, termination_date string, is_current boolean")
    wells = bridge.lease_well_bridge(m, x)
    assert set(map(tuple, wells.collect())) == {("01", "5", "w1", 199905, None, True), ("01", "5", "w2", 200001, 200401, True), ("02", "8", "w3", None, None, False)}
    p = spark.createDataFrame([("01", "5", 10), ("01", "5", 5), ("02", "8", 3), ("09", "9", 4)], "district string, lease_number string, volume bigint")
    assert tuple(bridge.bridge_coverage(p, wells).first()) == (3, 2, 1, 22, 18, 3)
    assert tuple(bridge.bridge_coverage(p.limit(0), wells).first()) == (0, 0, 0, 0, 0, 0)


def test_allocation_does_not_shuffle_the_long_rows(spark):
    """Between the join and the result there is no exchange, and nothing is sent to all tasks by a hint."""
    p = spark.createDataFrame([("A", 1, 100)], "lease string, month int, volume bigint")
    w = spark.createDataFrame([("A", "w", 1, 2)], "lease string, api10 string, effective_month int, termination_month int")
    plan = allocate.allocate_to_wells(p, w, ["lease"])._jdf.queryExecution()
    assert "hint" not in plan.logical().toString().lower()
    assert "repartition" not in plan.logical().toString().lower()


def test_sketches_merge(spark):
    df = spark.range(20_000).selectExpr("id % 5 AS part", "id % 7000 AS v", "CAST(NULL AS STRING) AS nothing")
    sketches = profile.distinct_sketches(df, ["v", "nothing"], ["part"])
    assert sketches.count() == 10
    got = {r.column_name: r.n_distinct for r in profile.merged_counts(sketches).collect()}
    assert abs(got["v"] - 7000) < 200 and got["nothing"] == 0
    assert profile.merged_counts(sketches, ["part"]).count() == 10


def test_carry_shuffles_blocks_and_sends_a_row_for_each_range(spark, monkeypatch):
    asked = []
    deal = carry.in_packed_ranges
    monkeypatch.setattr(carry, "in_packed_ranges", lambda *args: asked.append(deal(*args)) or asked[-1])
    rows = spark.range(0, 6000, 1, 7).select(
        F.expr("IF(id % 97 = 0, NULL, concat('f', id % 40))").alias("f"), F.expr("6000 - id").alias("i"), F.expr("repeat('x', 100)").alias("rec"),
        F.expr("IF(id % 31 = 0, id, NULL)").alias("v"), F.expr("timestamp_seconds(id)").alias("t"),
    )
    got = carry.carry_forward(rows, "i", {"last": F.col("v")}, ["f"], ranges=9)
    held, want = {}, set()
    for r in sorted(rows.collect(), key=lambda r: r.i):
        held[r.f] = r.v if r.v is not None else held.get(r.f)
        want.add((r.f, r.i, r.rec, r.v, r.t, held[r.f]))
    assert set(map(tuple, got.collect())) == want and got.count() == 6000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    dealt = asked[0]
    assert dealt.rdd.getNumPartitions() == 9
    sizes = dealt.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(sizes) == 9 and max(r["count"] for r in sizes) < 1300
    assert "_block" in dealt._jdf.queryExecution().executedPlan().toString()
    floats = rows.withColumn("i", F.col("i").cast("double"))
    assert set(map(tuple, carry.carry_forward(floats, "i", {"last": F.col("v")}, ["f"], 9).collect())) == want

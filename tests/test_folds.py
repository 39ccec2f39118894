"""Order-dependent operators against plain loops."""

import math
import random

import pytest
from pyspark.sql import functions as F

from reelspark.operators import assets, frames, redaction, reid, tracks

# ---- case grouping ---------------------------------------------------------------------------


def grouped(spark, stamps, **kw):
    df = spark.createDataFrame([("24-01-01", s) for s in stamps], "date string, stamp string")
    return {r["stamp"]: r["case_no"] for r in assets.group_cases(df, **kw).collect()}


def test_group_cases_examples(spark):
    got = grouped(spark, ["2024-01-01_07-41-09", "2024-01-01_07-42-00", "2024-01-01_08-15-23"])
    assert list(got.values()).count(1) == 2 and got["2024-01-01_08-15-23"] == 2
    minutes = {m: f"2024-01-01_{m // 60:02d}-{m % 60:02d}-00.123" for m in (0, 20, 40, 65, 100)}
    got = grouped(spark, minutes.values())
    assert [got[minutes[m]] for m in (0, 20, 40, 65, 100)] == [1, 1, 2, 2, 3]


def test_group_cases_inclusive_limit_and_loop(spark):
    rng = random.Random(5)
    stamps = sorted({f"2024-01-01_{h:02d}-{m:02d}-{s:02d}" for h, m, s in
                     ((rng.randrange(24), rng.randrange(60), rng.choice((0, 30))) for _ in range(200))})
    want, anchor, case = {}, None, 0
    for s in stamps:
        h, m, sec = map(int, s.split("_")[1].split("-"))
        at = h * 3600 + m * 60 + sec
        if anchor is None or at - anchor > 1800:
            anchor, case = at, case + 1
        want[s] = case
    assert grouped(spark, stamps) == want


# ---- fragment merging ------------------------------------------------------------------------


def _points(tracks_of):
    """Keypoint rows of tracks (video, id, start, end, first place, last place); a place may be unknown."""
    return [
        (video, tid, int(t * 10), t, None if p is None else p[0], None if p is None else p[1])
        for video, tid, t0, t1, p0, p1 in tracks_of for t, p in ((t0, p0), (t1, p1))]


POINTS = "video string, Track_ID bigint, Frame_ID bigint, Timestamp double, centroid_x double, centroid_y double"


@pytest.mark.parametrize("second, joined", [
    ((5.0, (0.0, 0.0)), True), ((8.0, (0.0, 0.0)), True), ((8.5, (0.0, 0.0)), False),  # at most 3 s later
    ((4.5, (0.0, 0.0)), True), ((4.0, (0.0, 0.0)), False),  # at most half a second earlier
    ((5.0, (300.0, 0.0)), True), ((5.0, (300.5, 0.0)), False), ((5.0, None), True),  # near, or unknown where
])
def test_which_fragment_follows(spark, second, joined):
    t0, place = second
    rows = [("v", 1, 0.0, 5.0, (9.0, 9.0), (0.0, 0.0)), ("v", 2, t0, 20.0, place, place)]
    got = {r["Track_ID"]: r["merged_id"] for r in tracks.fragment_map(spark.createDataFrame(_points(rows), POINTS)).collect()}
    assert got == {1: 1, 2: 1 if joined else 2}


def test_chains_grow_from_their_last_fragment(spark):
    rows = [("v", k, 10.0 * k, 10.0 * k + 8, (100.0 * k, 0.0), (100.0 * k + 100, 0.0)) for k in range(1, 9)]
    got = {r["merged_id"] for r in tracks.fragment_map(spark.createDataFrame(_points(rows), POINTS)).collect()}
    assert got == {1}


@pytest.mark.parametrize("seed", range(3))
def test_merged_fragments_can_follow_each_other(spark, seed):
    """Every chain is named by a member and held together by members that can follow one another."""
    def follows(q, r):
        near = q[5] is None or r[4] is None or math.dist(q[5], r[4]) <= 300
        return near and -0.5 - 1e-9 <= r[2] - q[3] <= 3 + 1e-9

    rng = random.Random(seed)
    rows = []
    for video in ("v1", "v2"):
        for tid in range(1, 41):
            t0 = round(rng.uniform(0, 120), 1)
            places = [None if rng.random() < 0.1 else (rng.uniform(0, 600), rng.uniform(0, 200)) for _ in range(2)]
            rows.append((video, tid, t0, round(t0 + rng.uniform(0.1, 4), 1), *places))
    chains = {}
    for r in tracks.fragment_map(spark.createDataFrame(_points(rows), POINTS)).collect():
        chains.setdefault((r["video"], r["merged_id"]), set()).add(r["Track_ID"])
    assert any(len(c) > 1 for c in chains.values()) and len(chains) < 80
    for (video, name), ids in chains.items():
        members = {r[1]: r for r in rows if r[0] == video and r[1] in ids}
        reached, new = set(), {name}
        while new:
            reached |= new
            new = {
                b for a in new for b in members if b not in reached and (follows(members[a], members[b]) or follows(members[b], members[a]))}
        assert reached == ids


def test_merge_relabels_rows(spark):
    df = spark.createDataFrame([
        ("v", 1, 0, 0.0, 1.0, 1.0), ("v", 1, 30, 1.0, 1.0, 1.0), ("v", 2, 60, 2.0, 2.0, 2.0), ("v", 9, 900, 30.0, 2.0, 2.0),
    ], "video string, Track_ID bigint, Frame_ID bigint, Timestamp double, centroid_x double, centroid_y double")
    got = [(r["Frame_ID"], r["Track_ID"]) for r in tracks.merge_fragments(df).orderBy("Frame_ID").collect()]
    assert got == [(0, 1), (30, 1), (60, 1), (900, 9)]


# ---- burst capture ---------------------------------------------------------------------------


def burst_case(seed, n=4000):
    rng = random.Random(seed)
    good = set()
    f = 0
    while f < n:  # stretches with and without a person
        length = rng.randrange(1, 200)
        if rng.random() < 0.6:
            good |= {x for x in range(f, min(n, f + length)) if rng.random() < 0.97}
        f += length
    return good, {x for x in good if rng.random() < 0.8}


@pytest.mark.parametrize("chunk", [344, 500, 1 << 16])
def test_capture_bursts_follow_the_rule(spark, chunk):
    """A burst starts at the first usable frame after the last one's rest. Its looks are 21 frames apart, three in all; it
    keeps the usable ones, and ends at its third look, at one without a person, or with the video."""
    n, size, step, rest = 4000, 3, 21, 301
    cases = {f"v{v}": burst_case(v, n) for v in range(6)}
    rows = [(v, f, f in usable) for v, (good, usable) in cases.items() for f in good]
    df = spark.createDataFrame(rows, "video string, frame bigint, usable boolean")
    videos = df.select("video").distinct().withColumn("n_frames", F.lit(n).cast("bigint"))
    bursts = {v: [] for v in cases}
    for r in reid.capture_bursts(df, videos, chunk=chunk).collect():
        bursts[r["video"]].append((r["start_frame"], list(r["saved"]), r["outcome"]))
    seen = set()
    for v, (good, usable) in cases.items():
        free = 0
        for start, saved, outcome in sorted(bursts[v]):
            assert start == min(f for f in usable if f >= free)
            looks = [start + k * step for k in range(size)]
            held = next((k for k, f in enumerate(looks) if f not in good), size)  # looks with a person
            assert saved == [f for f in looks[:held] if f in usable]
            ends = looks[min(held, size - 1)]
            assert outcome == ("open" if ends >= n else "complete" if held == size else "aborted")
            free = ends + rest
            seen.add(outcome)
        assert not [f for f in usable if f >= free]
    assert seen >= {"complete", "aborted"}


def test_capture_totals(spark):
    df = spark.createDataFrame([("v", f, True) for f in range(0, 64)], "video string, frame bigint, usable boolean")
    videos = spark.createDataFrame([("v", 64)], "video string, n_frames bigint")
    got = reid.capture_totals(reid.capture_bursts(df, videos)).first()
    assert (got["crops_saved"], got["bursts_completed"], got["bursts_aborted"]) == (3, 1, 0)


def test_many_chunks_are_scanned_at_once():
    """One call serves thousands of short chunks, and gives each what a plain walk from any first frame gives."""
    import numpy as np
    import pyarrow as pa

    rng, chunk, size, gap, cooldown, spill = random.Random(5), 64, 3, 3, 12, 21
    rows, first = [], []
    for c in range(3000):
        n_frames = rng.choice([40, 70, 500])
        frames = [f for f in range(min(chunk + 9, n_frames)) if rng.random() < 0.7]
        first += [len(rows)] * len(frames)
        rows += [(c % 7, c % 7 * chunk + f, rng.random() < 0.8, c % 7 * chunk + n_frames) for f in frames]
    part = pa.table(dict(zip(("chunk", "frame", "usable", "n_frames"), map(list, zip(*rows)))))
    scan = reid._Scan(part, np.array(first), size, gap, cooldown, chunk)
    leaves = scan.leaves(spill)
    enter = np.array([rng.randrange(spill + 1) for _ in scan.first])
    taken = set(scan.rows[scan.taken(enter)].tolist())
    assert len(leaves) == len(scan.first) > 2500
    ends = [*scan.first[1:].tolist(), len(rows)]
    for k, (a, b) in enumerate(zip(scan.first.tolist(), ends)):
        lo = rows[a][0] * chunk
        good, usable = {rows[i][1] - lo for i in range(a, b)}, {rows[i][1] - lo for i in range(a, b) if rows[i][2]}
        last = rows[a][3] - 1 - lo
        for at in (0, spill, int(enter[k])):
            free, starts = at, []
            while (s := min((f for f in usable if free <= f < chunk), default=None)) is not None:
                starts.append(s)
                looks = [s + 4, s + 8]
                ends_at = next((f for f in looks if f > last or f not in good), looks[-1])
                free = last + 1 if ends_at > last else ends_at + cooldown + 1
            assert leaves[k][at] == (max(free, chunk) - chunk if starts else 0)
        # the last of the three was the entry
        assert {i for i in range(a, b) if i in taken} == {i for i in range(a, b) if rows[i][1] - lo in starts}


def test_sample_orders_rows_of_drawn_cases_only(spark, monkeypatch):
    """Cases of any size give the same draws, and the rows of other cases are never ranked."""
    crops = spark.range(6000).select(
        F.floor(F.sqrt("id")).cast("int").alias("case_no"), F.concat(F.lit("c"), "id").alias("name"))

    def run(n):
        return sorted(map(tuple, reid.balanced_sample(crops, n, 7).collect()))

    whole = run(500)
    assert len(whole) == 500
    monkeypatch.setattr(reid, "LARGE_CASE", 4)
    assert run(500) == whole
    ranked = []
    rank = reid.with_group_rank
    monkeypatch.setattr(reid, "with_group_rank", lambda df, *a, **k: ranked.append(df) or rank(df, *a, **k))
    few = run(3)
    assert ranked[1].count() == sum(crops.filter(F.col("case_no") == c).count() for c in {r[1] for r in few})


def test_copies_are_verified_behind_one_shuffle_a_side(spark):
    """No digest is shuffled: the rows were dealt out by the key of the join already."""
    from reelspark.plans import q_assets  # noqa: F401
    from reelspark.plans.registry import QUERIES

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES["verify_copies"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(") == 2 and "SortMergeJoin" in plan


def test_frames_are_counted_behind_the_shuffle(spark):
    """No count holds the rows of a whole part of a file."""
    from reelspark.plans import q_redaction  # noqa: F401
    from reelspark.plans.registry import QUERIES

    plan = QUERIES["stamp_intervals"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("HashAggregate") < plan.index("Exchange hashpartitioning(") and "REPARTITION_BY_NUM" in plan


# ---- interpolation and smoothing against pandas ------------------------------------------------


def test_clean_steps_equal_pandas(spark):
    import numpy as np
    import pandas as pd

    rng = random.Random(11)
    rows = []
    for tid in (1, 2):
        for i, f in enumerate(sorted(rng.sample(range(100), 40)) + [50, 51]):
            x = rng.uniform(0, 100) if rng.random() < 0.8 else None
            rows.append(("v", tid, f, f / 30, len(rows), x, rng.uniform(0, 1)))
    schema = "video string, Track_ID bigint, Frame_ID bigint, Timestamp double, ordinal bigint, Nose_x double, Nose_conf double"
    kp = spark.createDataFrame(rows, schema)
    grid = tracks.reindex_frames(kp, "ordinal", ["Timestamp", "Nose_x", "Nose_conf"])
    got = tracks.smooth_centered(tracks.interpolate_linear(grid, ["Nose_x", "Nose_conf"]), ["Nose_x"])
    got = got.toPandas().sort_values(["Track_ID", "Frame_ID"]).reset_index(drop=True)
    parts = []
    table = pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])
    for tid, g in table.groupby("Track_ID"):
        g = g.drop_duplicates("Frame_ID", keep="first").set_index("Frame_ID").sort_index()
        g = g.reindex(range(g.index.min(), g.index.max() + 1))
        g["Track_ID"] = tid
        cols = ["Nose_x", "Nose_conf"]
        g[cols] = g[cols].astype(float).interpolate(method="linear", limit_direction="both")
        g["Timestamp"] = g["Timestamp"].interpolate(method="linear")
        g["Nose_x"] = g["Nose_x"].rolling(5, min_periods=1, center=True).mean()
        parts.append(g.reset_index())
    want = pd.concat(parts).sort_values(["Track_ID", "Frame_ID"]).reset_index(drop=True)
    for c in ("Frame_ID", "Timestamp", "Nose_x", "Nose_conf"):
        assert np.allclose(got[c].astype(float), want[c].astype(float)), c


def test_smoothing_across_buckets(spark, monkeypatch):
    df = spark.range(200).select(
        F.lit("v").alias("video"), F.lit(1).cast("bigint").alias("Track_ID"), F.col("id").alias("Frame_ID"),
        (F.col("id") % 7).cast("double").alias("a_x"))
    whole = [r["a_x"] for r in tracks.smooth_centered(df, ["a_x"]).orderBy("Frame_ID").collect()]
    monkeypatch.setattr(tracks, "FRAME_BUCKET", 16)
    cut = [r["a_x"] for r in tracks.smooth_centered(df, ["a_x"]).orderBy("Frame_ID").collect()]
    assert cut == whole and len(cut) == 200


def test_cleaning_smooths_where_gaps_are_filled(spark, monkeypatch):
    """Filling and smoothing at once equals one after the other, for any bucket width, and shuffles no added frame."""
    rng = random.Random(3)
    rows = [("v", t, f, f / 30 if f % 5 else None, len(str(f)), rng.uniform(0, 9) if rng.random() < 0.7 else None, None, rng.random())
            for t in (1, 2, 3) for f in sorted([t, *rng.sample(range(t, 400), 40), *range(60, 70)], reverse=t == 2)]
    kp = spark.createDataFrame(rows, "video string, Track_ID bigint, Frame_ID bigint, Timestamp double, ordinal bigint, a double, b double, c double")
    want = tracks.smooth_centered(tracks.fill_gaps(kp, "ordinal", ["a", "b", "c"]), ["a", "b"]).collect()

    def run():
        out = tracks.fill_gaps_smoothed(kp, "ordinal", ["a", "b", "c"], ["a", "b"])
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        return out.columns, sorted(map(tuple, out.collect())), plan

    columns, whole, plan = run()
    assert columns == ["video", "Track_ID", "Frame_ID", "Timestamp", "a", "b", "c"]
    assert whole == [pytest.approx(r) for r in sorted(map(tuple, want))] and len(whole) > 1000
    monkeypatch.setattr(tracks, "FRAME_BUCKET", 16)
    assert run()[1] == [pytest.approx(r) for r in whole]
    cleaned = tracks.clean_tracks(
        kp.select("video", "Track_ID", "Frame_ID", "Timestamp", "ordinal", *[
            F.col("a").alias(f"Left_Hip_{p}") for p in ("x", "y", "conf")]), "ordinal", ["Left_Hip"], ordered=False)
    text = cleaned._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("MapInArrow") < text.index("RepartitionByExpression") and "_frame#" not in text


def test_short_and_long_tracks_are_filled_alike(spark, monkeypatch):
    """Against the single steps: tracks under and over a bucket, without names, repeated and missing frames, unknown columns."""
    rng = random.Random(5)
    rows = [("v", t, f, f / 30 if f > 9 else None, 100 - len(str(f)) - i, rng.uniform(0, 9) if rng.random() < 0.5 else math.nan, None, rng.random())
            for t, reach in ((1, 60), (2, 900), (None, 50), (4, 64), (5, 65)) for i, f in enumerate([*range(0, reach, 1 + reach // 25), 7, 12, reach - 1])]
    rows += [("v", 1, None, 1.0, 0, 1.0, 1.0, 1.0), ("v", 6, 2**40, None, 0, 1.0, 2.0, None), ("v", 7, None, None, 0, 1.0, 2.0, None)]
    kp = spark.createDataFrame(rows, "video string, Track_ID bigint, Frame_ID bigint, Timestamp double, ordinal bigint, a double, b double, c double")
    cols = ["a", "b", "c"]
    monkeypatch.setattr(tracks, "FRAME_BUCKET", 64)
    steps = tracks.interpolate_linear(tracks.reindex_frames(kp, "ordinal", ["Timestamp", *cols]), cols)

    def same(got, want):
        got, want = (sorted(map(tuple, df.select("video", "Track_ID", "Frame_ID", "Timestamp", *cols).collect()), key=repr) for df in (got, want))
        assert len(got) == len(want) > 1000 and all(
            a == b or (isinstance(a, float) and a == pytest.approx(b)) for r, q in zip(got, want) for a, b in zip(r, q))

    same(tracks.fill_gaps(kp, "ordinal", cols), steps)
    same(tracks.fill_gaps_smoothed(kp, "ordinal", cols, ["a", "b"]), tracks.smooth_centered(steps, ["a", "b"]))


@pytest.mark.parametrize("name", ["smooth_centered", "interpolate_linear"])
def test_added_frames_are_not_shuffled(spark, name):
    """Frames between measured ones, 22 to a measured row of the fixture, are made behind the last exchange of rows."""
    from reelspark.plans import q_tracks  # noqa: F401
    from reelspark.plans.registry import QUERIES

    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "_frame#" not in plan and plan.index("MapInArrow") < plan.index("RepartitionByExpression")


def test_smoothing_some_columns_of_a_filled_grid(spark):
    """Columns that a query drops after the grid is made take nothing else with them."""
    points = [f"{k}_{p}" for k in ("Left_Hip", "Right_Hip", "Left_Shoulder") for p in ("x", "y", "conf")]
    kp = spark.range(6).select(
        F.lit("v").alias("video"), F.lit(1).cast("bigint").alias("Track_ID"), (F.col("id") * 3).alias("Frame_ID"),
        F.col("id").alias("ordinal"), (F.col("id") / 10).alias("Timestamp"), *[(F.col("id") * 3.0).alias(c) for c in points])
    coords = [c for c in points if not c.endswith("_conf")]
    filled = tracks.interpolate_linear(tracks.reindex_frames(kp, "ordinal", ["Timestamp", *points]), points)
    got = tracks.smooth_centered(filled.select("video", "Track_ID", "Frame_ID", *coords), coords).orderBy("Frame_ID").collect()
    assert [r["Left_Hip_y"] for r in got] == pytest.approx([1.0, 1.5, *range(2, 14), 13.5, 14.0])


def test_interpolation_across_buckets(spark, monkeypatch):
    """Known values reach over any number of buckets, and other columns pass as they came."""
    rng = random.Random(8)
    rows = [("v", t, f, None if rng.random() < 0.9 else f * 1.5, float(f) if f % 40 == 3 else math.nan, f / 10 if f % 7 == 0 else None,
             None if f % 3 else 2**60 + f) for t in (1, 2) for f in range(t, 150)]
    df = spark.createDataFrame(rows, "video string, Track_ID bigint, Frame_ID bigint, a double, b double, Timestamp double, mark bigint")

    def run():
        out = tracks.interpolate_linear(df, ["a", "b"])
        return out.schema, sorted(map(tuple, out.collect())), out._jdf.queryExecution().executedPlan().toString()

    schema, whole, plan = run()
    assert [(r[0], r[1], r[2], r[6]) for r in whole] == sorted((r[0], r[1], r[2], r[6]) for r in rows)
    assert [f.name for f in schema] == df.columns
    known = {(r[1], r[2]): r for r in rows}
    for _, t, f, a, b, at, _ in whole:
        assert b == pytest.approx(min(max(f, 3), 123))
        assert at == (None if f < 7 else pytest.approx(min(f, 147) / 10))
        assert known[t, f][3] is None or a == known[t, f][3]
    monkeypatch.setattr(tracks, "FRAME_BUCKET", 16)
    assert run()[1] == [pytest.approx(r) for r in whole]
    # rows are sorted as they are: what lies next to their bucket comes as rows of its own
    assert "_own" in plan and "MapInArrow" in plan


def test_similarities_in_small_tiles_of_large_blocks(spark, monkeypatch):
    """A small tile bounds a product, not how often the rows are sent; tiles and blocks of any size agree with all pairs."""
    rng = random.Random(4)
    rows = [(i % 3, i, [rng.gauss(0, 1) for _ in range(5)]) for i in range(120)]
    emb = spark.createDataFrame(rows, "identity int, image int, vec array<double>")
    pairs = spark.createDataFrame([(0, 1), (1, 2)], "identity_a int, identity_b int")
    unit = {i: [x / math.hypot(*v) for x in v] for _, i, v in rows}
    sims = {}
    for p, i, _ in rows:
        for q, j, _ in rows:
            if (p == q and i < j) or q == p + 1:
                sims.setdefault((p, None if p == q else q), []).append(sum(x * y for x, y in zip(unit[i], unit[j])))
    asked, deal = [], reid.with_tiles

    def watched(*args):
        asked.append(args[3])
        return deal(*args)

    monkeypatch.setattr(reid, "with_tiles", watched)
    for block in (reid.BLOCK_ROWS, 16):
        monkeypatch.setattr(reid, "BLOCK_ROWS", block)
        got = reid.similarity_stats(emb, pairs, tile=7).collect()
        assert len(got) == len(sims) == 5
        for r in got:
            want = sims[r["identity_a"], r["identity_b"]]
            assert r["n_pairs"] == len(want)
            assert (r["mean"], r["min"], r["max"]) == pytest.approx((sum(want) / len(want), min(want), max(want)))
    assert asked == [4096, 4096, 16, 16]


# ---- what a row costs --------------------------------------------------------------------------


def below_groupings(df, word):
    """Conditions with the word on the rows themselves, below all groupings of the plan."""
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    last = max(i for i, line in enumerate(lines) if "Aggregate" in line)
    return [line for line in lines[last:] if "Filter" in line and word in line]


def listing(spark):
    minute = F.lpad((F.col("id") % 60).cast("string"), 2, "0")
    return spark.range(300).select(
        F.concat(F.lit("in/"), F.col("id") % 7, F.lit("/Monitor/2024-01-01_08-"), minute, F.lit("-00.seq")).alias("path"),
        (F.col("id") * 1000000).alias("length")).distinct()


def test_plans_parse_no_names_in_conditions_on_rows(spark):
    plan = assets.copy_plan(listing(spark), "out")
    assert not below_groupings(plan, "gettimestamp") and plan.count() == 300
    attached = assets.attach_companions(listing(spark))
    assert not below_groupings(attached, "substring_index") and not below_groupings(attached, "regexp") and attached.count() == 300
    manifest = listing(spark).select(F.col("path").alias("source_path"), F.substring("path", 1, 12).alias("destination_path")).distinct()
    names = assets.unique_names(manifest)
    assert not below_groupings(names, "regexp")
    assert names.select("unique_path").distinct().count() == manifest.count()


def test_bursts_shuffle_rows_once(spark):
    rows = [(1, 1, k * 40, f"n{k}") for k in range(50)] + [(None, 1, 5, "x"), (1, None, 5, "y"), (1, 1, None, "z")]
    crops = spark.createDataFrame(rows, "case_no int, video_idx int, frame_id bigint, name string").distinct()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = reid.bursts(crops)
        assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()
        assert [(r["images"], r["first_frame"], r["last_frame"]) for r in out.collect()] == [(50, 0, 1960)]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


# ---- documented examples -----------------------------------------------------------------------


def test_drop_stats_example(spark):
    df = spark.createDataFrame(
        [("f", i, 0, 10, 100 + i, 0, 0, n) for i, n in enumerate((5, 6, 9, 9, 2))],
        "file string, rec_no bigint, offset bigint, size bigint, ts_seconds bigint, ts_sub bigint, flags bigint, frame_number bigint")
    r = frames.drop_stats(df).first()
    assert (r["dropped_frames"], r["n_duplicates"], r["n_counter_resets"], r["frame_span"]) == (2, 1, 1, -3)
    assert r["drop_rate"] == pytest.approx(2 / 7)


def test_redaction_examples(spark):
    df = spark.createDataFrame([("v", 10000.0, "600", "1200", "0:30:00", "2400", None, None)],
                               "video string, duration_s double, start_1 string, end_1 string, start_2 string, end_2 string, "
                               "start_3 string, end_3 string")
    v = redaction.with_valid_ranges(df)
    assert v.first()["trimmed_s"] == 6000
    periods = [(r["start_s"], r["end_s"]) for r in redaction.black_periods(v, ["video"]).collect()]
    assert periods == [(0, 600), (1200, 1800), (2400, 6000)]
    segments = [(r["case_no"], r["pre_black_segment"], r["post_black_segment"])
                for r in redaction.black_segments(v, ["video"]).collect()]
    assert segments == [(1, 10, 5), (2, 5, 60)]


def test_bursts_example(spark):
    df = spark.createDataFrame([(f"1_v01_{f}.jpg",) for f in (10, 30, 50, 400, 420)], "name string")
    r = reid.burst_totals(reid.parsed_crops(df)).first()
    assert (r["bursts"], r["complete"]) == (2, 1)


def test_scorecard_example(spark):
    groups = [(638, "Monitor", 900, 5.0, True, True), (122, "Monitor", 900, None, True, True),
              (16, "Monitor", 100, None, True, True), (24, "Monitor", 900, None, False, True),
              (3, "Injection_Port", 900, None, False, True), (2, "Monitor", 10, None, True, True),
              (1, "Monitor", 900, None, True, False)]
    rows = [(c, s, m, i, h, 100, 1.6e9, 1.6e9 + 60) for n, c, s, m, i, h in groups for _ in range(n)]
    rows += [("Monitor", 900, None, True, True, 100, 5.0, 1.6e9)] * 6
    df = spark.createDataFrame(rows, "camera_name string, size_mb int, mp4_size_mb double, has_idx boolean, header_ok boolean, "
                                     "idx_frames bigint, t_start double, t_end double")
    done = frames.sync_completion(df).first()
    assert (done["valid"], done["synced"], done["syncable"], done["lost"]) == (812, 638, 138, 36)
    assert round(done["completion_pct"], 1) == 95.6
    card = {(r["sync_class"], r["reason"]): r for r in frames.sync_scorecard(df).collect()}
    assert card[("will_sync", None)]["n"] == 138 and round(card[("will_sync", None)]["pct"], 1) == 79.3
    assert card[("will_not_sync", "no_index")]["n"] == 24 and card[(None, None)]["n"] == 174


def test_key_years(spark):
    df = spark.createDataFrame([("DATA_24-01-07/Case2/Monitor/x.seq",), ("DATA_70-01-07/Case2/Monitor/x.seq",), ("x/y",)], "path string")
    got = [tuple(r)[1:] for r in assets.parse_recording_key(df).collect()]
    assert got == [("2024-01-07", 2, "Monitor"), ("1970-01-07", 2, "Monitor"), (None, None, None)]


def test_companion_case_fallback(spark):
    df = spark.createDataFrame([("d/45.123.seq",), ("d/45.123.seq.idx",), ("d/B.seq",), ("d/b.seq.idx",), ("d/lone.xml",)], "path string")
    got = {r["seq_path"]: r["companions"] for r in assets.attach_companions(df).collect()}
    assert got == {"d/45.123.seq": {".seq.idx": "d/45.123.seq.idx"}, "d/B.seq": {".seq.idx": "d/b.seq.idx"}}
    assert {r["path"] for r in assets.orphan_companions(df).collect()} == {"d/b.seq.idx", "d/lone.xml"}


# ---- similarity ----------------------------------------------------------------------------------


def test_similarity_is_the_same_in_any_tiling(spark):
    rng = random.Random(2)
    emb = spark.createDataFrame(
        [("hot" if i < 60 else "b", i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(80)] + [("one", 99, [1.0] * 8)],
        "identity string, image bigint, vec array<double>")
    pairs = spark.createDataFrame([("hot", "b"), ("b", "one")], "identity_a string, identity_b string")
    whole = reid.similarity_stats(emb, pairs).toPandas().sort_values(["identity_a", "identity_b"]).reset_index(drop=True)
    tiled = reid.similarity_stats(emb, pairs, tile=16).toPandas().sort_values(["identity_a", "identity_b"]).reset_index(drop=True)
    for c in ("mean", "std", "min", "max", "n_pairs"):
        assert whole[c].tolist() == pytest.approx(tiled[c].tolist()), c
    single = whole[(whole.identity_a == "one")].iloc[0]
    assert (single["mean"], single["std"], single["n_pairs"]) == (1.0, 0.0, 0)
    gap = {(r["identity_a"], r["identity_b"]): r for r in reid.separability(emb, pairs).collect()}
    inter = whole[(whole.identity_a == "hot") & (whole.identity_b == "b")].iloc[0]
    assert gap[("hot", "b")]["inter"] == pytest.approx(inter["mean"])


def test_loss_is_the_same_in_any_tiling(spark):
    rng = random.Random(4)
    views = spark.createDataFrame(
        [(b, p, v, [rng.gauss(0, 1) for _ in range(6)]) for b in range(2) for p in range(20) for v in (0, 1)],
        "batch bigint, pair_id bigint, view int, vec array<double>")
    whole = {r["batch"]: r["loss"] for r in reid.nt_xent(views, 0.07).collect()}
    tiled = {r["batch"]: r["loss"] for r in reid.nt_xent(views, 0.07, tile=8).collect()}
    assert whole == pytest.approx(tiled)


def test_balanced_sample_is_even_over_cases(spark):
    crops = spark.createDataFrame([(1, f"a{i}") for i in range(90)] + [(2, f"b{i}") for i in range(10)], "case_no int, name string")
    got = reid.balanced_sample(crops, 4000, seed=1).groupBy("case_no").count().collect()
    assert sum(r["count"] for r in got) == 4000
    assert all(1800 < r["count"] < 2200 for r in got)


def test_fused_fill_equals_the_two_steps(spark):
    rng = random.Random(8)
    rows = [("v", t, f, f / 30, i, rng.uniform(0, 9) if rng.random() < 0.6 else None, rng.uniform(0, 9))
            for t in (1, 2) for i, f in enumerate(rng.sample(range(300), 60))]
    kp = spark.createDataFrame(rows, "video string, Track_ID bigint, Frame_ID bigint, Timestamp double, ordinal bigint, a_x double, a_y double")
    cols = ["a_x", "a_y"]
    steps = tracks.interpolate_linear(tracks.reindex_frames(kp, "ordinal", ["Timestamp", *cols]), cols)
    fused = tracks.fill_gaps(kp, "ordinal", cols)
    key = ["Track_ID", "Frame_ID"]
    a, b = (d.select(*key, "Timestamp", *cols).toPandas().sort_values(key) for d in (steps, fused))
    assert len(a) == len(b)
    for c in (*key, "Timestamp", *cols):
        assert b[c].tolist() == pytest.approx(a[c].tolist(), nan_ok=True), c

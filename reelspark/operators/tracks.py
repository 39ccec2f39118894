"""Detections, pose keypoints and motion tracks."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, NumericType, StructField, StructType

from reelspark.constants import HEAD, KEYPOINTS, LOWER_BODY, TORSO, UPPER_BODY
from reelspark.functions import euclidean, iou, no_nan
from reelspark.plans.carry import (
    BUCKET, FRAME_BUCKET, bucketed, carried, inside, with_earlier_max, with_known_neighbours, with_next, with_previous,
    with_running_sum,
)
from reelspark.plans.folds import fold_groups, walk_groups
from reelspark.plans.quantiles import exact_quantiles
from reelspark.plans.runs import explode_range

TRACK = ("video", "Track_ID")

# ---- detections ------------------------------------------------------------------------------


def subsample_frames(df: DataFrame, fps: float, target: float, frame: str = "frame") -> DataFrame:
    """Keep every n-th frame, n = fps / target cut to a whole number and at least 1."""
    step = max(1, int(fps / target))
    return df.filter(F.pmod(F.col(frame), F.lit(step)) == 0)


def person_detections(dets: DataFrame, min_conf: float, person_class: int = 0) -> DataFrame:
    return dets.filter((F.col("cls") == person_class) & (F.col("conf") >= min_conf))


def touching_edges(width: float, margin: float = 15) -> Column:
    """Box closer than the margin to the left or right border."""
    return (F.col("x1") < margin) | (F.col("x2") > width - margin)


def best_detection(dets: DataFrame, min_conf: float = 0.8) -> DataFrame:
    """Most confident person per frame; the lower detection number wins a tie."""
    rest = [c for c in dets.columns if c not in ("video", "frame")]
    best = person_detections(dets, min_conf).groupBy("video", "frame").agg(
        F.max_by(F.struct(*rest), F.struct(F.col("conf"), -F.col("det_no"))).alias("_best")
    )
    return best.select("video", "frame", "_best.*")


def pad_bbox(df: DataFrame, width: int, height: int, pad: int = 30, min_side: int = 10) -> DataFrame:
    """Whole-pixel box with padding inside the frame; crops with a side below `min_side` are dropped."""
    padded = df.withColumns(_padded(width, height, pad))
    return padded.filter((F.col("crop_x2") - F.col("crop_x1") >= min_side)
                         & (F.col("crop_y2") - F.col("crop_y1") >= min_side))


def _padded(width: int, height: int, pad: int) -> dict[str, Column]:
    return {
        "crop_x1": F.greatest(F.lit(0), F.col("x1").cast("int") - pad),
        "crop_y1": F.greatest(F.lit(0), F.col("y1").cast("int") - pad),
        "crop_x2": F.least(F.lit(width), F.col("x2").cast("int") + pad),
        "crop_y2": F.least(F.lit(height), F.col("y2").cast("int") + pad),
    }


def match_tracks(tracks: DataFrame, dets: DataFrame, cell: float = 256.0) -> DataFrame:
    """Detection with the highest IoU for each track box of a frame; tracks without overlap are dropped.

    Boxes meet only inside shared cells of a coarse grid, and the best match is combined map-side."""

    def cells(x1: str, y1: str, x2: str, y2: str, df: DataFrame) -> DataFrame:
        def span(lo: str, hi: str) -> Column:
            return F.sequence(F.floor(F.col(lo) / cell), F.floor(F.greatest(F.col(lo), F.col(hi)) / cell))

        return df.withColumn("_cx", F.explode(span(x1, x2))).withColumn("_cy", F.explode(span(y1, y2)))

    box = ("x1", "y1", "x2", "y2")
    t = tracks.select("video", "frame", "Track_ID", *[F.col(c).alias(f"t_{c}") for c in box])
    d = dets.filter(F.col("cls") == 0).select("video", "frame", "det_no", *[F.col(c).alias(f"d_{c}") for c in box])
    joined = cells("t_x1", "t_y1", "t_x2", "t_y2", t).join(
        cells("d_x1", "d_y1", "d_x2", "d_y2", d), ["video", "frame", "_cx", "_cy"]
    )
    overlap = joined.withColumn("iou", iou(tuple(f"t_{c}" for c in box), tuple(f"d_{c}" for c in box)))
    return overlap.filter("iou > 0").groupBy(
        "video", "frame", "Track_ID", *[f"t_{c}" for c in box]
    ).agg(
        F.max_by("det_no", F.struct(F.col("iou"), -F.col("det_no"))).alias("det_no"), F.max("iou").alias("iou")
    )


# ---- keypoints -------------------------------------------------------------------------------


def keypoints_to_long(kp: DataFrame, keypoints: Sequence[str] = KEYPOINTS) -> DataFrame:
    """One row per keypoint; a keypoint without confidence has 0."""
    rest = [c for c in kp.columns if not any(c == f"{k}_{p}" for k in keypoints for p in ("x", "y", "conf"))]
    points = F.array(*[
        F.struct(
            F.lit(k).alias("keypoint"), no_nan(f"{k}_x").alias("x"), no_nan(f"{k}_y").alias("y"),
            F.coalesce(no_nan(f"{k}_conf"), F.lit(0.0)).alias("conf"),
        )
        for k in keypoints
    ])
    return kp.select(*rest, F.inline(points))


def keypoints_to_wide(long: DataFrame, keys: Sequence[str], keypoints: Sequence[str] = KEYPOINTS) -> DataFrame:
    """Back to one row per key; absent keypoints have NULL coordinates and confidence 0."""
    out = []
    for k in keypoints:
        here = F.col("keypoint") == k
        out += [F.max(F.when(here, F.col("x"))).alias(f"{k}_x"), F.max(F.when(here, F.col("y"))).alias(f"{k}_y"),
                F.coalesce(F.max(F.when(here, F.col("conf"))), F.lit(0.0)).alias(f"{k}_conf")]
    return long.groupBy(*keys).agg(*out)


def track_centroid(kp: DataFrame, keypoints: Sequence[str] = TORSO) -> DataFrame:
    """Mean of the torso keypoints per axis, ignoring missing ones; NULL when all are missing."""

    def mean(axis: str) -> Column:
        known = F.filter(F.array(*[no_nan(f"{k}_{axis}") for k in keypoints]), lambda v: v.isNotNull())
        return F.try_divide(F.aggregate(known, F.lit(0.0), lambda a, v: a + v), F.size(known))

    return kp.withColumns({"centroid_x": mean("x"), "centroid_y": mean("y")})


def remap_frames(df: DataFrame, videos: DataFrame, frame: str = "Frame_ID") -> DataFrame:
    """Shift a video's frames to start at 0 when they do not overlap it, then keep 0 ≤ frame < n_frames.

    `videos` holds (video, n_frames)."""
    span = df.groupBy("video").agg(F.min(frame).alias("_min"), F.max(frame).alias("_max"))
    plan = span.join(videos.select("video", "n_frames"), "video").select(
        "video", "n_frames",
        F.when((F.col("_min") >= F.col("n_frames")) | (F.col("_max") < 0), F.col("_min")).otherwise(F.lit(0)).alias("_by"),
    )
    moved = df.join(plan, "video").withColumn(frame, F.col(frame) - F.col("_by"))
    return moved.filter((F.col(frame) >= 0) & (F.col(frame) < F.col("n_frames"))).select(*df.columns)


def project_to_floor(df: DataFrame, h: Sequence[Sequence[float]], x: str = "x", y: str = "y") -> DataFrame:
    """Apply a 3×3 homography to points."""
    px, py = F.col(x), F.col(y)
    u, v, w = [px * float(r[0]) + py * float(r[1]) + float(r[2]) for r in h]
    return df.withColumns({"floor_x": F.try_divide(u, w), "floor_y": F.try_divide(v, w)})


def as_of_pose(poses: DataFrame, videos: DataFrame, max_age: int = 30, order: str | None = None) -> DataFrame:
    """Last known pose of each track on every frame up to `max_age` frames later.

    `videos` holds (video, n_frames). Of several poses of a track in a frame the last in `order` counts.
    A pose reaches exactly to the frame before its successor, so no frame grid is joined."""
    rest = [c for c in poses.columns if c not in ("video", "Track_ID", "Frame_ID")]
    last = poses.groupBy(*TRACK, "Frame_ID").agg(
        F.max_by(F.struct(*rest), F.struct(order or rest[0])).alias("_pose")
    )
    near = with_next(last, TRACK, ["Frame_ID"], ["Frame_ID"]).join(videos.select("video", "n_frames"), "video")
    until = F.least(F.col("Frame_ID") + max_age, F.col("n_frames") - 1, F.col("next_Frame_ID") - 1)
    return near.filter((F.col("Frame_ID") >= 0) & (until >= F.col("Frame_ID"))).select(
        "video", "Track_ID", F.explode(F.sequence("Frame_ID", until)).alias("frame"),
        F.col("Frame_ID").alias("pose_frame"), "_pose.*",
    ).withColumn("age", F.col("frame") - F.col("pose_frame"))


# ---- profiles --------------------------------------------------------------------------------


def profile(df: DataFrame) -> DataFrame:
    """Per numeric column: type, count, mean, sample deviation, extremes, quartiles and missing share."""
    numeric = [f for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    total = F.count(F.lit(1))
    flat = df.agg(F.array(*[
        F.struct(
            F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"), total.alias("rows"),
            F.count(no_nan(f.name)).alias("count"), F.avg(no_nan(f.name)).alias("mean"),
            F.stddev_samp(no_nan(f.name)).alias("std"), F.min(no_nan(f.name)).alias("min"),
            F.max(no_nan(f.name)).alias("max"),
        )
        for f in numeric
    ]).alias("_c")).select(F.inline("_c"))
    long = df.select(*[no_nan(f.name).alias(f.name) for f in numeric]).unpivot(
        [], [f.name for f in numeric], "column", "value"
    )
    quartiles = exact_quantiles(long, ["column"], "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    missing = F.col("rows") - F.col("count")
    return flat.join(quartiles, "column", "left").withColumns({
        "missing": missing, "missing_pct": F.try_divide(missing * 100.0, F.col("rows"))
    })


def missing_columns(df: DataFrame) -> DataFrame:
    """Columns with missing values, most first."""
    return profile(df).filter("missing > 0").select("column", "missing", "missing_pct").orderBy(
        F.desc("missing"), "column"
    )


def track_profile(kp: DataFrame) -> DataFrame:
    """One row: frame and time range, distinct frames and tracks, mean detections per frame."""
    flat = kp.agg(
        F.count(F.lit(1)).alias("rows"), F.min("Frame_ID").alias("min_frame"), F.max("Frame_ID").alias("max_frame"),
        F.countDistinct("Frame_ID").alias("frames"), F.min("Timestamp").alias("min_time"),
        F.max("Timestamp").alias("max_time"), F.countDistinct("Track_ID").alias("tracks"),
    )
    return flat.withColumn("avg_detections", F.try_divide(F.col("rows") * 1.0, F.col("frames")))


def track_shares(kp: DataFrame, k: int = 10) -> DataFrame:
    """The k longest tracks with their share of all rows in percent."""
    counts = kp.groupBy("Track_ID").agg(F.count(F.lit(1)).alias("n"))
    total = kp.select(F.count(F.lit(1))).scalar()
    top = counts.orderBy(F.desc("n"), "Track_ID").limit(k)
    return top.withColumn("pct", F.col("n") * 100.0 / total)


def _confident(k: str, threshold: float) -> Column:
    return F.coalesce(no_nan(f"{k}_conf") > threshold, F.lit(False))


def nose_rate(kp: DataFrame, keypoint: str = "Nose") -> DataFrame:
    """Rows with a detected pose and their percent."""
    hit, n = F.count_if(_confident(keypoint, 0.0)), F.count(F.lit(1))
    return kp.agg(n.alias("rows"), hit.alias("detected"), F.try_divide(hit * 100.0, n).alias("pct"))


def keypoint_stats(kp: DataFrame, keypoints: Sequence[str] = KEYPOINTS, threshold: float = 0.0) -> DataFrame:
    """Per keypoint: detections above the threshold, percent of rows, mean confidence when detected.

    One aggregation over the wide table; it is turned into rows afterwards."""
    n = F.count(F.lit(1))
    return kp.agg(F.array(*[
        F.struct(
            F.lit(k).alias("keypoint"), F.count_if(_confident(k, threshold)).alias("detected"), n.alias("rows"),
            F.try_divide(F.count_if(_confident(k, threshold)) * 100.0, n).alias("pct"),
            F.avg(F.when(_confident(k, threshold), F.col(f"{k}_conf"))).alias("mean_conf"),
        )
        for k in keypoints
    ]).alias("_k")).select(F.inline("_k"))


def _region(keypoint: Column, keypoints: Sequence[str]) -> Column:
    region = F.lit(None).cast("string")
    for name, members in (("head", HEAD), ("upper", UPPER_BODY), ("lower", LOWER_BODY)):
        here = [k for k in keypoints if k in members]
        if here:
            region = F.when(keypoint.isin(*here), name).otherwise(region)
    return region


def region_rates(kp: DataFrame, keypoints: Sequence[str] = KEYPOINTS, threshold: float = 0.3) -> DataFrame:
    """Per body region: detection rate in percent and the mean of its keypoints' mean confidences."""
    per_keypoint = keypoint_stats(kp, keypoints, threshold).withColumn("region", _region(F.col("keypoint"), keypoints))
    return per_keypoint.groupBy("region").agg(
        F.sum("detected").alias("detected"), F.sum("rows").alias("possible"),
        F.try_divide(F.sum("detected") * 100.0, F.sum("rows")).alias("rate_pct"),
        F.avg("mean_conf").alias("mean_conf"),
    )


def _rate(keypoints: Sequence[str], threshold: float) -> Column:
    hits = reduce(lambda a, b: a + b, [F.count_if(_confident(k, threshold)) for k in keypoints])
    return F.try_divide(hits * 100.0, F.count(F.lit(1)) * len(keypoints))


def track_region_rates(kp: DataFrame, keypoints: Sequence[str] = KEYPOINTS, threshold: float = 0.3) -> DataFrame:
    """Per track: upper and lower body rate in percent, worst upper body first."""
    upper = [k for k in keypoints if k in UPPER_BODY]
    lower = [k for k in keypoints if k in LOWER_BODY]
    return kp.groupBy(*TRACK).agg(
        F.count(F.lit(1)).alias("frames"), _rate(upper, threshold).alias("upper_rate"),
        _rate(lower, threshold).alias("lower_rate"),
    ).orderBy("upper_rate", *TRACK)


def diagnose(kp: DataFrame, keypoints: Sequence[str] = KEYPOINTS, threshold: float = 0.3) -> DataFrame:
    """Overall upper and lower body rate with a verdict."""
    rates = kp.agg(
        _rate([k for k in keypoints if k in UPPER_BODY], threshold).alias("upper_rate"),
        _rate([k for k in keypoints if k in LOWER_BODY], threshold).alias("lower_rate"),
    )
    upper, lower = F.col("upper_rate"), F.col("lower_rate")
    verdict = F.when((upper < 50) & (lower > 70), "warning").when(upper < 30, "critical").otherwise("ok")
    return rates.withColumn("verdict", verdict)


# ---- track cleaning --------------------------------------------------------------------------


def drop_short_tracks(kp: DataFrame, min_sec: float = 1.5) -> DataFrame:
    """Keep tracks that last at least `min_sec`."""
    keep = kp.groupBy(*TRACK).agg((F.max("Timestamp") - F.min("Timestamp")).alias("_d")).filter(F.col("_d") >= min_sec)
    return kp.join(keep.select(*TRACK), list(TRACK), "left_semi")


def track_endpoints(kp: DataFrame, ordinal: str | None = None) -> DataFrame:
    """First and last frame, time and centroid per track, and its number of rows.

    `kp` has centroid_x and centroid_y; `ordinal` breaks ties between rows of one frame."""
    row = F.struct("Frame_ID", "Timestamp", "centroid_x", "centroid_y")
    order = F.struct("Frame_ID", ordinal) if ordinal else F.struct("Frame_ID", "Timestamp")
    ends = kp.groupBy(*TRACK).agg(
        F.min_by(row, order).alias("_a"), F.max_by(row, order).alias("_b"), F.count(F.lit(1)).alias("n_rows")
    )
    return ends.select(
        *TRACK,
        *[F.col(f"_a.{s}").alias(f"start_{n}") for s, n in _END_NAMES],
        *[F.col(f"_b.{s}").alias(f"end_{n}") for s, n in _END_NAMES],
        "n_rows",
    )


_END_NAMES = (("Frame_ID", "frame"), ("Timestamp", "time"), ("centroid_x", "x"), ("centroid_y", "y"))


def _greedy_chains(t: dict[str, np.ndarray], gap: float, dist: float, overlap: float) -> dict[str, np.ndarray]:
    """Chain the fragments of one independent stretch of a video, given in start order."""
    start, end, ids = t["start_time"].tolist(), t["end_time"].tolist(), t["Track_ID"]
    at = list(zip(t["start_x"].tolist(), t["start_y"].tolist()))
    to = list(zip(t["end_x"].tolist(), t["end_y"].tolist()))
    owner = list(range(len(ids)))
    members = {i: [i] for i in owner}
    for i in range(len(ids)):
        mine, until, where = owner[i], end[i], to[i]
        for j in range(i + 1, len(ids)):
            wait = start[j] - until
            if wait > gap:
                break
            if owner[j] == mine or wait < -overlap:
                continue
            unknown = math.isnan(where[0]) or math.isnan(at[j][0])
            if (0.0 if unknown else math.dist(where, at[j])) <= dist:
                moved = members.pop(owner[j])
                members[mine] += moved
                for m in moved:
                    owner[m] = mine
                until, where = end[j], to[j]
    return {"video": t["video"], "Track_ID": ids, "merged_id": ids[np.array(owner)]}


def fragment_map(
    kp: DataFrame, gap: float = 3.0, dist: float = 300.0, overlap: float = 0.5, ordinal: str | None = None
) -> DataFrame:
    """(video, Track_ID, merged_id): which fragments belong to one person.

    Only track summaries take part. A video is first cut wherever every earlier track ended more than `gap`
    before the next start, since no chain can cross such a pause."""
    ends = track_endpoints(track_centroid(kp) if "centroid_x" not in kp.columns else kp, ordinal)
    order = ["start_time", "Track_ID"]
    seen = with_earlier_max(ends, ["video"], order, F.col("end_time"), "_latest")
    opens = F.coalesce(F.col("start_time") - F.col("_latest") > gap, F.lit(False)).cast("long")
    cut = with_running_sum(seen, ["video"], order, opens, "_stretch", width=3600)

    def chain(columns: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        return _greedy_chains(columns, gap, dist, overlap)

    schema = f"video {dict(kp.dtypes)['video']}, Track_ID bigint, merged_id bigint"
    nan = F.lit(float("nan"))
    slim = cut.select("video", F.col("Track_ID").cast("bigint").alias("Track_ID"), "_stretch", "start_time", "end_time",
                      *[F.coalesce(c, nan).alias(c) for c in ("start_x", "start_y", "end_x", "end_y")])
    return fold_groups(slim, ["video", "_stretch"], order, chain, schema)


def merge_fragments(
    kp: DataFrame, gap: float = 3.0, dist: float = 300.0, overlap: float = 0.5, ordinal: str | None = None
) -> DataFrame:
    """Relabel fragments of one person with the id of the chain that absorbed them."""
    mapping = fragment_map(kp, gap, dist, overlap, ordinal)
    joined = kp.join(mapping, list(TRACK), "left")
    return joined.select(*[
        F.coalesce("merged_id", "Track_ID").alias("Track_ID") if c == "Track_ID" else F.col(c) for c in kp.columns
    ])


def reindex_frames(kp: DataFrame, ordinal: str, cols: Sequence[str]) -> DataFrame:
    """Every frame between a track's first and last exists once; added rows have NULL values.

    Of several rows in a frame the one with the lowest `ordinal` stays."""
    first = kp.groupBy(*TRACK, "Frame_ID").agg(F.min_by(F.struct(*cols), ordinal).alias("_row"))
    runs = with_next(first, TRACK, ["Frame_ID"], ["Frame_ID"])
    until = F.coalesce(F.col("next_Frame_ID") - 1, F.col("Frame_ID"))
    # flat before rows are made: Spark 4.1 loses fields of a struct that passes two generators when a query drops some of them
    flat = runs.select(*TRACK, "Frame_ID", until.alias("_until"), *[F.col("_row")[c].alias(f"_row_{c}") for c in cols])
    grid = explode_range(flat, "Frame_ID", "_until", "_frame")
    real = F.col("_frame") == F.col("Frame_ID")
    return grid.select(
        *TRACK, F.col("_frame").alias("Frame_ID"), *[F.when(real, F.col(f"_row_{c}")).alias(c) for c in cols]
    )


def _lent(clean: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Nearest known values outside each bucket, as rows of it that know one column only.

    Buckets are summed up map-side; a track within one bucket is lent nothing."""
    summaries: dict[str, Column] = {}
    before, after = {}, {}
    for c in targets:
        at = F.when(F.col(c).isNotNull(), F.col("Frame_ID"))
        summaries |= {f"_to_{c}": F.max(at), f"_last_{c}": F.max_by(c, at), f"_from_{c}": F.min(at), f"_first_{c}": F.min_by(c, at)}
        for side, names in ((before, ("_to", "_last")), (after, ("_from", "_first"))):
            side |= {f"_near{n}_{c}": lambda w, n=n, c=c: F.last(f"{n}_{c}", ignorenulls=True).over(w) for n in names}
    points = [
        F.struct(F.col(f"_near{at}_{c}").alias("Frame_ID"), *[
            (F.col(f"_near{v}_{c}") if t == c else F.lit(None).cast("double")).alias(t) for t in targets])
        for c in targets for at, v in (("_to", "_last"), ("_from", "_first"))]
    return carried(clean, TRACK, summaries, before, after).select(
        *TRACK, BUCKET, F.inline(F.array_compact(F.array(*[F.when(p["Frame_ID"].isNotNull(), p) for p in points]))))


def interpolate_linear(df: DataFrame, cols: Sequence[str], time: str | None = "Timestamp") -> DataFrame:
    """Linear between known neighbours of a track, the nearest known value at both edges.

    The time column is only carried forward at its end. Frames are unique per track. Rows are sorted once, as narrow as they
    came; each bucket is lent the known values next to it as rows."""
    targets = [*cols, *([time] if time else [])]
    clean = bucketed(df.withColumns({c: no_nan(c) for c in targets}), "Frame_ID", FRAME_BUCKET)
    rows = clean.withColumn("_own", F.lit(True)).unionByName(_lent(clean, targets), allowMissingColumns=True)
    schema = to_arrow_schema(clean.select(*df.columns).schema)

    def fill(part: pa.Table, first: np.ndarray, end: np.ndarray) -> pa.Table:
        """`first` and `end` give the range of each row's bucket."""
        own, place = part["_own"].is_valid().to_numpy(), np.arange(len(part))
        frame = part["Frame_ID"].to_numpy()
        out = {}
        for c in targets:
            v = part[c].to_numpy()
            known = part[c].is_valid().to_numpy()
            lo = np.maximum.accumulate(np.where(known, place, -1))
            hi = np.minimum.accumulate(np.where(known, place, len(part))[::-1])[::-1]
            left, right = (lo >= first)[own], (hi < end)[own]
            lo, hi = np.maximum(lo, 0)[own], np.minimum(hi, len(part) - 1)[own]
            span = frame[hi] - frame[lo]
            share = (frame[own] - frame[lo]) / np.where(span == 0, 1, span)
            with np.errstate(invalid="ignore", over="ignore"):
                between = v[lo] + (v[hi] - v[lo]) * np.where(span == 0, 0.0, share)
            value = np.where(left & right, between, np.where(left, v[lo], v[hi]))
            out[c] = pa.array(value, mask=~(left if c == time else left | right))
        kept = part.filter(part["_own"].is_valid())
        return pa.table([out[c] if c in out else kept[c] for c in schema.names], schema=schema)

    return walk_groups(rows, [*TRACK, BUCKET], ["Frame_ID"], fill, clean.select(*df.columns).schema)


def _gap_lines(kp: DataFrame, ordinal: str, cols: Sequence[str], time: str | None) -> DataFrame:
    """Each measured frame up to the one before the next (`_until`), with every column's value at it (`_v`) and slope (`_s`).

    Of several rows in a frame the one with the lowest ordinal stays, of equal ordinals the one with the lowest values."""
    targets = [*([time] if time else []), *cols]
    order = F.col(ordinal).isNull().alias("_none"), F.col(ordinal).alias("_ordinal")
    first = kp.groupBy(*TRACK, "Frame_ID").agg(
        F.min(F.struct(*order, *[no_nan(c).alias(c) for c in targets])).alias("_row")
    ).select(*TRACK, "Frame_ID", *[F.col("_row")[c].alias(c) for c in targets])
    near = with_known_neighbours(first, TRACK, "Frame_ID", ["Frame_ID", *targets], sides=("before", "beyond"))

    def line(c: str) -> Column:
        """Value at the row and slope up to the next row."""
        lo, hi = F.col(f"_lo_{c}"), F.col(f"_hi_{c}")
        slope = F.coalesce((hi["value"] - lo["value"]) / (hi["at"] - lo["at"]), F.lit(0.0))
        start = lo["value"] + slope * (F.col("Frame_ID") - lo["at"])
        return F.struct((start if c == time else F.coalesce(start, hi["value"])).alias("v"), slope.alias("s"))

    lines = near.select(*TRACK, "Frame_ID", F.col("_hi_Frame_ID")["at"].alias("_next"), *[line(c).alias(c) for c in targets])
    return lines.select(*TRACK, "Frame_ID", F.coalesce(F.col("_next") - 1, F.col("Frame_ID")).alias("_until"),
                        *[F.col(c)[p].alias(f"{c}_{p}") for c in targets for p in ("v", "s")])


def _means(value: np.ndarray, left: np.ndarray, right: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean of what is known from `half` rows before to `half` rows after each, within its range of rows, and where nothing is."""
    known, place = ~np.isnan(value), np.arange(len(value))
    clean = np.where(known, value, 0.0)
    total, n = np.zeros(len(value)), np.zeros(len(value), np.int64)
    for k in range(-min(half, len(value)), min(half, len(value)) + 1):
        here, there = slice(max(-k, 0), len(value) - max(k, 0)), slice(max(k, 0), len(value) + min(k, 0))
        fits = (place[there] >= left[here]) & (place[there] < right[here])
        total[here] += np.where(fits, clean[there], 0.0)
        n[here] += fits & known[there]
    return total / np.maximum(n, 1), n == 0


def _target(kp: DataFrame, names: Sequence[str]) -> StructType:
    kinds = {f.name: f.dataType for f in kp.schema}
    return StructType([StructField(c, kinds[c]) for c in (*TRACK, "Frame_ID")] + [StructField(c, DoubleType()) for c in names])


def _filled_in_buckets(
    kp: DataFrame, ordinal: str, cols: Sequence[str], smooth: Sequence[str], half: int, time: str | None
) -> DataFrame:
    """`fill_gaps_smoothed` for tracks of any length.

    Only measured rows are shuffled and sorted: each goes to the buckets that its frames, or frames within half a window of
    them, lie in, and becomes frames where they are smoothed."""
    width, names = FRAME_BUCKET, [*([time] if time else []), *cols]
    lines = _gap_lines(kp, ordinal, cols, time)
    near = F.sequence(F.floor((F.col("Frame_ID") - half) / width), F.floor((F.col("_until") + half) / width))
    cut = lines.withColumn(BUCKET, F.explode(near)).withColumns({
        "_low": F.greatest(F.col("Frame_ID"), F.col(BUCKET) * width - half),
        "_high": F.least(F.col("_until"), (F.col(BUCKET) + 1) * width + (half - 1)),
    }).withColumn("_frames", F.col("_high") - F.col("_low") + 1).filter("_frames > 0")
    target = _target(lines, names)
    schema = to_arrow_schema(target)

    def fill(part: pa.Table, first: np.ndarray, end: np.ndarray) -> pa.Table:
        frames, low = part["_frames"].to_numpy(), part["_low"].to_numpy()
        after = np.cumsum(frames)
        begin = after - frames
        row = np.repeat(np.arange(len(part)), frames)
        frame = low[row] + np.arange(len(row)) - begin[row]
        step = (frame - part["Frame_ID"].to_numpy()[row]).astype(np.float64)
        own = frame // width == part[BUCKET].to_numpy()[row]
        left, right = begin[first][row], after[end - 1][row]
        source = pa.array(row[own])
        out = {c: part[c].take(source) for c in TRACK} | {"Frame_ID": pa.array(frame[own], schema.field("Frame_ID").type)}
        for c in names:
            with np.errstate(invalid="ignore", over="ignore"):
                value = part[f"{c}_v"].to_numpy()[row] + part[f"{c}_s"].to_numpy()[row] * step
                missing = part[f"{c}_v"].is_null().to_numpy()[row]
                if c in smooth:
                    value, missing = _means(value, left, right, half)
            out[c] = pa.array(value[own], mask=missing[own])
        return pa.table([out[c] for c in schema.names], schema=schema)

    def weight(rows: pa.Table, starts: np.ndarray) -> np.ndarray:
        return np.add.reduceat(rows["_frames"].to_numpy(), starts)

    return walk_groups(cut, [*TRACK, BUCKET], ["_low"], fill, target, weight)


def _filled_whole(
    kp: DataFrame, ordinal: str, cols: Sequence[str], smooth: Sequence[str], half: int, time: str | None
) -> DataFrame:
    """`fill_gaps_smoothed` for tracks of at most a bucket of frames: measured rows are shuffled once, as they came, and a
    track's become frames at once."""
    names = [*([time] if time else []), *cols]
    rows = kp.filter(F.col("Frame_ID").isNotNull()).select(
        *TRACK, "Frame_ID", F.col(ordinal).alias("_ordinal"), *[no_nan(c).alias(c) for c in names])
    target = _target(rows, names)
    schema = to_arrow_schema(target)

    def fill(part: pa.Table, first: np.ndarray, end: np.ndarray) -> pa.Table:
        frame, opens = part["Frame_ID"].to_numpy(), first == np.arange(len(part))
        # of the rows of a frame the first one stays
        stays = opens | (np.diff(frame, prepend=frame[:1]) != 0)
        part, opens = part.filter(pa.array(stays)), opens[stays]
        frame, place = part["Frame_ID"].to_numpy(), np.arange(len(part))
        starts = np.flatnonzero(opens)
        lengths = np.diff(starts, append=len(part))
        first, end = np.repeat(starts, lengths), np.repeat(starts + lengths, lengths)
        frames = np.where(place == end - 1, 1, np.diff(frame, append=0))
        after = np.cumsum(frames)
        begin = after - frames
        row = np.repeat(place, frames)
        at = frame[row] + np.arange(len(row)) - begin[row]
        left, right = begin[first][row], after[end - 1][row]
        source = pa.array(row)
        out = {c: part[c].take(source) for c in TRACK} | {"Frame_ID": pa.array(at, schema.field("Frame_ID").type)}
        for c in names:
            v, known = part[c].to_numpy(), part[c].is_valid().to_numpy()
            lo = np.maximum.accumulate(np.where(known, place, -1))
            hi = np.append(np.minimum.accumulate(np.where(known, place, len(part))[::-1])[::-1][1:], len(part))
            before, beyond = lo >= first, hi < end
            lo, hi = np.maximum(lo, 0), np.minimum(hi, len(part) - 1)
            both = before & beyond
            missing = (~before if c == time else ~(before | beyond))[row]
            with np.errstate(invalid="ignore", over="ignore"):
                rise = np.where(both, v[hi] - v[lo], 0.0)
                span = np.where(both, frame[hi] - frame[lo], 1)
                value = np.where(before, v[lo], v[hi])[row] + rise[row] * (at - frame[lo][row]) / span[row]
                value[begin[known]] = v[known]
                if c in smooth:
                    value, missing = _means(np.where(missing, np.nan, value), left, right, half)
            out[c] = pa.array(value, mask=missing)
        return pa.table([out[c] for c in schema.names], schema=schema)

    def weight(rows: pa.Table, starts: np.ndarray) -> np.ndarray:
        frame = rows["Frame_ID"].to_numpy()
        return frame[np.append(starts[1:], len(rows)) - 1] - frame[starts] + 1

    return walk_groups(rows, TRACK, ["Frame_ID", F.asc_nulls_last("_ordinal"), *names], fill, target, weight)


def _filled(
    kp: DataFrame, ordinal: str, cols: Sequence[str], smooth: Sequence[str], half: int, time: str | None
) -> DataFrame:
    """Tracks over more frames than a bucket are filled in pieces, all others whole.

    The long ones' names are broadcast: each stands for more than FRAME_BUCKET rows of the result."""
    rows = kp.withColumn("Frame_ID", F.col("Frame_ID").cast("bigint"))
    ends = rows.groupBy(*[F.col(c).alias(f"_{c}") for c in TRACK]).agg((F.max("Frame_ID") - F.min("Frame_ID")).alias("_span"))
    long = F.broadcast(ends.filter(F.col("_span") >= FRAME_BUCKET).drop("_span"))
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in TRACK])
    given = ordinal, cols, smooth, half, time
    return _filled_whole(rows.join(long, same, "left_anti"), *given).unionByName(
        _filled_in_buckets(rows.join(long, same, "left_semi"), *given))


def fill_gaps(kp: DataFrame, ordinal: str, cols: Sequence[str], time: str | None = "Timestamp") -> DataFrame:
    """`reindex_frames` followed by `interpolate_linear`, in one go.

    Only measured rows are shuffled; the added frames, usually most of the result, are made where their neighbours are known."""
    return _filled(kp, ordinal, cols, (), 0, time)


def fill_gaps_smoothed(
    kp: DataFrame, ordinal: str, cols: Sequence[str], smooth: Sequence[str], window: int = 5, time: str | None = "Timestamp"
) -> DataFrame:
    """`fill_gaps` followed by `smooth_centered` of the columns `smooth`, in one go and as narrow."""
    return _filled(kp, ordinal, cols, smooth, window // 2, time)


def smooth_centered(df: DataFrame, cols: Sequence[str], window: int = 5) -> DataFrame:
    """Centred mean over `window` rows of a track, fewer at its ends; frames are consecutive.

    Rows near a bucket border are lent to the neighbouring bucket, so long tracks are smoothed in pieces."""
    half = window // 2
    here = F.floor(F.col("Frame_ID") / FRAME_BUCKET)
    below = F.floor((F.col("Frame_ID") - half) / FRAME_BUCKET)
    above = F.floor((F.col("Frame_ID") + half) / FRAME_BUCKET)
    lent = df.withColumn("_home", here).withColumn(BUCKET, F.explode(F.array_distinct(F.array(here, below, above))))
    w = inside(TRACK, ["Frame_ID"]).rowsBetween(-half, half)
    smoothed = lent.withColumns({c: F.avg(no_nan(c)).over(w) for c in cols})
    return smoothed.filter(F.col("_home") == F.col(BUCKET)).select(*df.columns)


def union_tracks(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def clean_tracks(
    kp: DataFrame, ordinal: str, keypoints: Sequence[str] = KEYPOINTS, min_sec: float = 1.5, gap: float = 3.0,
    dist: float = 300.0, window: int = 5, ordered: bool = True,
) -> DataFrame:
    """Drop short tracks, merge fragments, fill every frame, interpolate and smooth, by frame and track.

    A global order samples the finished rows once more; `ordered=False` leaves sorting to the writer."""
    points = [f"{k}_{p}" for k in keypoints for p in ("x", "y", "conf")]
    coords = [c for c in points if not c.endswith("_conf")]
    kept = drop_short_tracks(kp, min_sec)
    merged = merge_fragments(track_centroid(kept, [k for k in TORSO if k in keypoints]), gap, dist, ordinal=ordinal)
    # in buckets at once: telling the long tracks first would merge the fragments once more
    smoothed = _filled_in_buckets(merged, ordinal, points, coords, window // 2, "Timestamp")
    return smoothed.orderBy("video", "Frame_ID", "Track_ID") if ordered else smoothed


def track_motion(kp: DataFrame, ordinal: str, conf: str = "conf") -> DataFrame:
    """Per track: rows, duration, mean confidence, mean centroid and path length in pixels.

    `kp` has centroid_x and centroid_y; a step from or to a missing centroid adds nothing."""
    near = with_previous(kp, TRACK, ["Frame_ID", ordinal], ["centroid_x", "centroid_y"])
    step = euclidean(F.col("prev_centroid_x"), F.col("prev_centroid_y"), F.col("centroid_x"), F.col("centroid_y"))
    return near.groupBy(*TRACK).agg(
        F.count(F.lit(1)).alias("frame_count"), (F.max("Timestamp") - F.min("Timestamp")).alias("duration_sec"),
        F.avg(conf).alias("avg_confidence"), F.avg("centroid_x").alias("mean_x"), F.avg("centroid_y").alias("mean_y"),
        F.coalesce(F.sum(step), F.lit(0.0)).alias("movement_px"),
    )

"""Re-identification: crop statistics, burst capture, embedding similarity and contrastive loss."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from reelspark.functions import l2_normalise, parse_crop_name
from reelspark.operators.tracks import _padded, best_detection, touching_edges
from reelspark.plans.carry import BUCKET, FRAME_BUCKET, bucketed, inside, with_group_rank
from reelspark.plans.folds import walk_groups
from reelspark.plans.quantiles import exact_quantiles
from reelspark.plans.tiles import TILE_ROWS, tile_pairs_between, tile_pairs_within, with_tiles

# ---- crops -----------------------------------------------------------------------------------


def parsed_crops(crops: DataFrame, name: str = "name") -> DataFrame:
    """Crop names with their key; other names have NULLs."""
    return crops.withColumn("_k", parse_crop_name(name)).select(*crops.columns, "_k.*")


def bursts(crops: DataFrame, max_gap: int = 100, size: int = 3) -> DataFrame:
    """Runs of frames with gaps below `max_gap` per case and video; complete means exactly `size` images.

    Runs are found inside buckets of frames and joined up where a run crosses a bucket border, so rows are
    shuffled once and only run fragments a second time."""
    keys = ["case_no", "video_idx"]
    order = ["frame_id", "name"]
    # rows without a key join nothing below; dropped here, both readers of the rows share one shuffle
    known = F.col(BUCKET).isNotNull() & F.col("case_no").isNotNull() & F.col("video_idx").isNotNull()
    cut = bucketed(crops, "frame_id", FRAME_BUCKET).filter(known)
    gap = F.col("frame_id") - F.lag("frame_id").over(inside(keys, order))
    flagged = cut.withColumn("_open", F.when(gap >= max_gap, 1).otherwise(0))
    upto = inside(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    pieces = flagged.withColumn("_local", F.sum("_open").over(upto)).groupBy(*keys, BUCKET, "_local").agg(
        F.count(F.lit(1)).alias("_n"), F.min("frame_id").alias("_first"), F.max("frame_id").alias("_last")
    )
    along = Window.partitionBy(*keys).orderBy(BUCKET)
    borders = pieces.groupBy(*keys, BUCKET).agg(
        F.max("_local").alias("_opens"), F.min("_first").alias("_from"), F.max("_last").alias("_to")
    ).withColumn("_step", F.when(F.col("_from") - F.lag("_to").over(along) >= max_gap, 1).otherwise(0))
    earlier = F.coalesce(F.sum("_opens").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = borders.select(*keys, BUCKET, (earlier + F.sum("_step").over(along)).alias("_offset"))
    joined = pieces.join(offsets, [*keys, BUCKET])
    return joined.groupBy(*keys, (F.col("_offset") + F.col("_local")).alias("burst_no")).agg(
        F.sum("_n").alias("images"), F.min("_first").alias("first_frame"), F.max("_last").alias("last_frame")
    ).withColumn("complete", F.col("images") == size)


def burst_totals(crops: DataFrame, max_gap: int = 100, size: int = 3) -> DataFrame:
    n, full = F.count(F.lit(1)), F.count_if("complete")
    return bursts(crops, max_gap, size).agg(
        n.alias("bursts"), full.alias("complete"), (n - full).alias("incomplete"),
        F.coalesce(F.try_divide(full * 100.0, n), F.lit(0.0)).alias("completion_pct"),
    )


def crop_counts(crops: DataFrame) -> DataFrame:
    """Images per case and video."""
    return crops.filter(F.col("case_no").isNotNull()).groupBy("case_no", "video_idx").agg(
        F.count(F.lit(1)).alias("images")
    )


def crop_stats(crops: DataFrame) -> DataFrame:
    """One row: images, identities, mean, median, population deviation, extremes and parse failures."""
    counts = crop_counts(crops)
    flat = counts.agg(
        F.coalesce(F.sum("images"), F.lit(0)).alias("total_images"), F.count(F.lit(1)).alias("identities"),
        F.avg("images").alias("mean_images"), F.stddev_pop("images").alias("std_images"),
        F.min("images").alias("min_images"), F.max("images").alias("max_images"),
    )
    failed = crops.select(F.count_if(F.col("case_no").isNull()))
    median = exact_quantiles(counts, [], "images", {"median_images": 0.5})
    return flat.withColumns({"parse_failures": failed.scalar(), "median_images": median.scalar()})


def balance_weights(crops: DataFrame, case: str = "case_no") -> DataFrame:
    """Weight 1 / images of the same case."""
    sizes = crops.groupBy(case).agg((F.lit(1.0) / F.count(F.lit(1))).alias("weight"))
    return crops.join(sizes, case)


#: Rows of a case that are put in order at once.
LARGE_CASE = 1 << 16


def balanced_sample(crops: DataFrame, n: int, seed: int, case: str = "case_no", name: str = "name") -> DataFrame:
    """n draws with replacement, each row with probability proportional to its balance weight.

    The weights of a case add up to one, so a draw picks a case evenly and then a row of it evenly; both
    are addressed by position and met with equi-joins. Only the rows of cases that were drawn are put in order."""
    # the condition keeps the counts for all readers of the cases, so that they share one grouping
    sizes = crops.groupBy(case).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 0")
    cases = with_group_rank(
        sizes.withColumn("_all", F.lit(1)), ["_all"], [case], F.md5(F.col(case).cast("string")), "_case_at")
    total = sizes.select(F.count(F.lit(1))).scalar()
    draws = crops.sparkSession.range(n).select(
        F.col("id").alias("draw"), F.floor(_uniform("id", seed) * total).alias("_case_at"), _uniform("id", seed + 1).alias("_u")
    )
    placed = draws.join(cases.drop("_all"), "_case_at").select(
        "draw", case, F.floor(F.col("_u") * F.col("_rows")).alias("_row_at"), "_rows"
    )
    drawn = crops.join(placed.select(case, "_rows").distinct(), case)
    rows = with_group_rank(drawn, [case], [name], F.md5(name), "_row_at", large=F.col("_rows") > LARGE_CASE)
    return placed.drop("_rows").join(rows, [case, "_row_at"]).select("draw", *crops.columns)


def _uniform(row_id: str, seed: int) -> Column:
    """Repeatable uniform number in [0, 1) per row, independent of partitioning: 52 bits of a digest any engine computes."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.col(row_id).cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


# ---- burst capture ---------------------------------------------------------------------------

CHUNK_FRAMES = 1 << 16


def burst_frames(
    dets: DataFrame, width: int, height: int, min_conf: float = 0.8, margin: float = 15, pad: int = 30,
    min_side: int = 10,
) -> DataFrame:
    """Frames whose best person is clear of the edges, with `usable` telling whether its crop is large enough."""
    best = best_detection(dets, min_conf).filter(~touching_edges(width, margin)).withColumns(_padded(width, height, pad))
    usable = (F.col("crop_x2") - F.col("crop_x1") >= min_side) & (F.col("crop_y2") - F.col("crop_y1") >= min_side)
    return best.select("video", "frame", usable.alias("usable"))


class _Scan:
    """The bursts that each usable frame of many chunks would begin, all chunks at once.

    Frames count from their chunk's first one; a chunk also holds the frames behind it that its bursts look at. `after` is the
    next place to begin from once a burst is over, `len(at)` where its chunk has none left."""

    def __init__(self, part: pa.Table, first: np.ndarray, size: int, gap: int, cooldown: int, chunk: int):
        new = first == np.arange(len(first))
        self.group, self.first = np.cumsum(new) - 1, np.flatnonzero(new)
        self.size, self.step, self.chunk = size, gap + 1, chunk
        self.span = chunk + (size - 1) * self.step + 1
        frame = part["frame"].to_numpy() - part["chunk"].to_numpy() * chunk
        usable = pc.fill_null(part["usable"], False).to_numpy()
        key = self.group * self.span + frame
        self.rows = np.flatnonzero(usable & (frame < chunk))
        self.at, self.key, of = frame[self.rows], key[self.rows], self.group[self.rows]
        last = (part["n_frames"].to_numpy() - 1 - part["chunk"].to_numpy() * chunk)[self.rows]
        known, look = np.ones(len(self.at), bool), self.at
        self.saved, self.outcome = [known], np.full(len(self.at), _OUTCOMES.index("complete"))
        self.resume = self.at + (size - 1) * self.step + cooldown + 1
        for _ in range(size - 1):
            look = look + self.step
            late, seen = look > last, self._among(key, of, look)
            ended, lost = known & late, known & ~late & ~seen
            self.outcome[ended], self.outcome[lost] = _OUTCOMES.index("open"), _OUTCOMES.index("aborted")
            self.resume[ended], self.resume[lost] = np.maximum(last, self.at)[ended] + 1, look[lost] + cooldown + 1
            known = known & ~late & seen
            self.saved.append(known & self._among(key[usable], of, look))
        self.after = np.where(self.resume < chunk, self.place(of, np.minimum(self.resume, chunk)), len(self.at))

    def _among(self, keys: np.ndarray, group: np.ndarray, frame: np.ndarray) -> np.ndarray:
        want = group * self.span + np.minimum(frame, self.span - 1)
        at = np.searchsorted(keys, want)
        return np.append(keys, -1)[at] == want

    def place(self, group: np.ndarray, frame: np.ndarray) -> np.ndarray:
        """The first start at or after a frame of a chunk."""
        at = np.searchsorted(self.key, group * self.span + frame)
        return np.where(np.append(self.key, -1)[at] // self.span == group, at, len(self.at))

    def leaves(self, spill: int) -> np.ndarray:
        """How far behind a chunk's end scanning leaves it, for each chunk and first frame up to `spill`."""
        n = len(self.at)
        last, end = np.append(np.where(self.after < n, self.after, np.arange(n)), n), np.append(self.resume, self.chunk)
        while (last[last] != last).any():
            last = last[last]
        chunks = np.arange(len(self.first))
        entry = self.place(np.repeat(chunks, spill + 1), np.tile(np.arange(spill + 1), len(chunks)))
        return np.maximum(end[last[entry]] - self.chunk, 0).reshape(-1, spill + 1)

    def taken(self, resume: np.ndarray) -> np.ndarray:
        """The starts of bursts when each chunk is scanned from its frame `resume`."""
        n, out = len(self.at), np.zeros(len(self.at), bool)
        now = self.place(np.arange(len(self.first)), resume)
        while len(now := now[now < n]):
            out[now] = True
            now = self.after[now]
        return np.flatnonzero(out)


_OUTCOMES = ("complete", "aborted", "open")


def _lists(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)), pa.int32()), pa.array(values, pa.int64()))


def capture_bursts(
    frames: DataFrame, videos: DataFrame, size: int = 3, gap: int = 20, cooldown: int = 300,
    chunk: int = CHUNK_FRAMES,
) -> DataFrame:
    """Bursts per video: start, saved frames and outcome (complete, aborted, or open at the video's end).

    `frames` comes from `burst_frames`, `videos` holds (video, n_frames). Between bursts the only state is
    the frame where scanning resumes, and a burst reaches a fixed distance. So a long video is cut into
    chunks: first each chunk reports where scanning leaves it for every way of entering it, then those short
    maps are followed through the video, and last all chunks run on their own."""
    reach = (size - 1) * (gap + 1)
    spill = reach + cooldown + 1
    if chunk <= spill:
        raise ValueError("a chunk must be longer than a burst and its cooldown")
    kind = dict(frames.dtypes)["video"]
    home = F.floor(F.col("frame") / chunk)
    lent = F.when(F.pmod("frame", F.lit(chunk)) <= reach, home - 1)
    rows = (
        frames.join(videos.select("video", "n_frames"), "video")
        .select("video", "n_frames", "frame", "usable",
                F.explode(F.array_compact(F.array(home, lent))).alias("chunk"))
        .filter("chunk >= 0")
    )

    def exits(part: pa.Table, first: np.ndarray, end: np.ndarray) -> pa.Table:
        scan = _Scan(part, first, size, gap, cooldown, chunk)
        leave = scan.leaves(spill)
        head = part.select(["video", "chunk"]).take(pa.array(scan.first))
        return head.append_column("leave", _lists(leave.ravel(), np.full(len(leave), spill + 1)))

    def enter(part: pa.Table, first: np.ndarray, end: np.ndarray) -> pa.Table:
        """The maps of all videos at hand are followed side by side."""
        leave = pc.list_flatten(part["leave"]).to_numpy().reshape(-1, spill + 1)
        lo = part["chunk"].to_numpy() * chunk
        out = np.zeros(len(part), np.int64)
        now = np.unique(first)
        resume = np.zeros(len(now), np.int64)
        while len(now):
            out[now] = resume = np.maximum(resume, lo[now])
            resume = lo[now] + chunk + leave[now, resume - lo[now]]
            more = now + 1 < end[now]
            now, resume = now[more] + 1, resume[more]
        return part.select(["video", "chunk"]).append_column("resume", pa.array(out))

    def run(part: pa.Table, first: np.ndarray, end: np.ndarray) -> pa.Table:
        scan = _Scan(part, first, size, gap, cooldown, chunk)
        resume = part["resume"].to_numpy()[scan.first] - part["chunk"].to_numpy()[scan.first] * chunk
        taken = scan.taken(np.maximum(resume, 0))
        rows = scan.rows[taken]
        start = part["frame"].to_numpy()[rows]
        kept = np.stack([s[taken] for s in scan.saved], axis=1)
        looks = start[:, None] + np.arange(size) * scan.step
        return pa.table({
            "video": part["video"].take(pa.array(rows)), "start_frame": start, "saved": _lists(looks[kept], kept.sum(axis=1)),
            "outcome": pa.array(_OUTCOMES).take(pa.array(scan.outcome[taken])),
        })

    # a video that fits one chunk is always entered at its first frame
    long_videos = rows.filter(F.col("n_frames") > chunk)
    maps = walk_groups(long_videos, ["video", "chunk"], ["frame"], exits,
                       f"video {kind}, chunk bigint, leave array<bigint>")
    entries = walk_groups(maps, ["video"], ["chunk"], enter, f"video {kind}, chunk bigint, resume bigint")
    placed = rows.join(entries, ["video", "chunk"], "left").fillna(0, ["resume"])
    return walk_groups(placed, ["video", "chunk"], ["frame"], run,
                       f"video {kind}, start_frame bigint, saved array<bigint>, outcome string")


def capture_totals(captures: DataFrame) -> DataFrame:
    """Crops saved, bursts completed and aborted per video."""
    return captures.groupBy("video").agg(
        F.sum(F.size("saved")).alias("crops_saved"), F.count_if(F.col("outcome") == "complete").alias("bursts_completed"),
        F.count_if(F.col("outcome") == "aborted").alias("bursts_aborted"),
    )


# ---- similarity ------------------------------------------------------------------------------
# Embeddings are (identity, image, vec). Pairs of images are summarised where they are computed.

#: Rows that travel together; a row goes to each block that it is compared with, and a task multiplies a tile of rows at a time.
BLOCK_ROWS = 4096
_SUMMARY = "n bigint, total double, squares double, low double, high double"


def _matrix(pdf: pd.DataFrame) -> np.ndarray:
    m = np.stack([np.asarray(v, dtype=np.float64) for v in pdf["vec"]])
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)


def _summary(key: list, columns: Sequence[str], a: pd.DataFrame, b: pd.DataFrame, tile: int, same: bool = False) -> pd.DataFrame:
    """Summary of all similarities of two blocks, multiplied `tile` rows at a time; of one block with itself (`same`) each pair
    counts once."""
    n, total, squares, low, high = 0, 0.0, 0.0, np.inf, -np.inf
    if len(a) and len(b):
        left, right = _matrix(a), _matrix(b)
        for at in range(0, len(left), tile):
            sims = left[at:at + tile] @ (right[at:] if same else right).T
            flat = sims[np.triu_indices(len(sims), 1, sims.shape[1])] if same else sims.ravel()
            if flat.size:
                n, total, squares = n + flat.size, total + flat.sum(), squares + flat @ flat
                low, high = min(low, flat.min()), max(high, flat.max())
    rows = [[*key, n, total, squares, low, high]] if n else []
    return pd.DataFrame(rows, columns=[*columns, "n", "total", "squares", "low", "high"])


def _finish(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    merged = parts.groupBy(*keys).agg(
        F.sum("n").alias("n_pairs"), F.sum("total").alias("_t"), F.sum("squares").alias("_q"),
        F.min("low").alias("min"), F.max("high").alias("max"),
    )
    n, t = F.col("n_pairs"), F.col("_t")
    variance = F.greatest(F.col("_q") - t * t / n, F.lit(0.0)) / (n - 1)
    return merged.select(
        *keys, (t / n).alias("mean"), F.when(n > 1, F.sqrt(F.when(n > 1, variance))).alias("std"), "min", "max", "n_pairs"
    )


def intra_similarity(emb: DataFrame, tile: int = TILE_ROWS) -> DataFrame:
    """Cosine similarity of all image pairs of each identity: mean, sample deviation, extremes, pairs.

    An identity with fewer than two images counts as (1, 0, 1, 1, 0)."""
    kind = dict(emb.dtypes)["identity"]

    def ordered(key, a, b):
        # both sides of a diagonal block are the same rows; one order makes the triangle meaningful
        return _summary([key[0]], ["identity"], a.sort_values("image"), b.sort_values("image"), tile, key[1] == key[2])

    tiles = with_tiles(emb.select("identity", "image", "vec"), "identity", "image", max(tile, BLOCK_ROWS))
    stats = _finish(tile_pairs_within(tiles, "identity", ordered, f"identity {kind}, {_SUMMARY}"), ["identity"])
    everyone = emb.select("identity").distinct().join(stats, "identity", "left")
    return everyone.select(
        "identity", F.coalesce("mean", F.lit(1.0)).alias("mean"),
        F.when(F.col("n_pairs").isNull(), F.lit(0.0)).otherwise(F.col("std")).alias("std"),
        F.coalesce("min", F.lit(1.0)).alias("min"), F.coalesce("max", F.lit(1.0)).alias("max"),
        F.coalesce("n_pairs", F.lit(0)).alias("n_pairs"),
    )


def inter_similarity(emb: DataFrame, pairs: DataFrame, tile: int = TILE_ROWS) -> DataFrame:
    """The same between the two identities of each row of `pairs` (identity_a, identity_b)."""
    kind = dict(emb.dtypes)["identity"]
    tiles = with_tiles(emb.select("identity", "image", "vec"), "identity", "image", max(tile, BLOCK_ROWS))
    count = tiles.groupBy("identity").agg(F.max("_tiles").alias("_other"))
    keys = ["identity_a", "identity_b"]
    a = tiles.withColumnRenamed("identity", "identity_a").join(pairs.select(*keys), "identity_a").join(
        count.withColumnRenamed("identity", "identity_b"), "identity_b")
    b = tiles.withColumnRenamed("identity", "identity_b").join(pairs.select(*keys), "identity_b").join(
        count.withColumnRenamed("identity", "identity_a"), "identity_a")

    def work(key: tuple, x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        return _summary([key[0], key[1]], keys, x, y, tile)

    parts = tile_pairs_between(a, b, keys, work, f"identity_a {kind}, identity_b {kind}, {_SUMMARY}")
    return _finish(parts, keys)


def similarity_stats(emb: DataFrame, pairs: DataFrame, tile: int = TILE_ROWS) -> DataFrame:
    """Intra statistics of every identity (identity_b NULL) and inter statistics of the given pairs."""
    intra = intra_similarity(emb, tile).withColumnRenamed("identity", "identity_a")
    return intra.unionByName(inter_similarity(emb, pairs, tile), allowMissingColumns=True)


def _vector_sums(emb: DataFrame) -> DataFrame:
    """Per identity the sum `s` of its unit vectors and their number `n`; added up map-side, one row for each identity."""
    unit = emb.select("identity", array_to_vector(l2_normalise("vec")).alias("u"))
    sums = unit.groupBy("identity").agg(Summarizer.sum(F.col("u")).alias("s"), F.count(F.lit(1)).alias("n"))
    return sums.select("identity", vector_to_array("s").alias("s"), "n")


def _dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)


def separability(emb: DataFrame, pairs: DataFrame) -> DataFrame:
    """Mean intra and inter similarity, their gap and the verdict for each pair of identities.

    The mean over all pairs of unit vectors follows from the vector sums of the two identities, so the cost
    grows with the number of images and not with the number of pairs."""
    n = F.col("n")
    intra = F.when(n > 1, (_dot("s", "s") - n) / F.when(n > 1, n * (n - 1.0))).otherwise(F.lit(1.0))
    sums = _vector_sums(emb).withColumn("intra", intra)

    def side(tag: str) -> DataFrame:
        return sums.select(*[F.col(c).alias(f"{c}_{tag}") for c in ("identity", "s", "n", "intra")])

    keys = ["identity_a", "identity_b"]
    joined = pairs.select(*keys).distinct().join(side("a"), "identity_a").join(side("b"), "identity_b")
    inter = _dot("s_a", "s_b") / (F.col("n_a") * F.col("n_b"))
    avg_intra = (F.col("intra_a") + F.col("intra_b")) / 2
    verdict = F.when(inter < 0.6, "success").when(inter < 0.8, "warning").otherwise("failure")
    return joined.select(
        *keys, "n_a", "n_b", "intra_a", "intra_b", avg_intra.alias("avg_intra"), inter.alias("inter"),
        (avg_intra - inter).alias("gap"), verdict.alias("verdict"),
    )


def compare_models(base: DataFrame, tuned: DataFrame) -> DataFrame:
    """Change of inter similarity and gap from a baseline to a tuned model, per pair of identities."""
    keys = ["identity_a", "identity_b"]
    a = base.select(*keys, F.col("inter").alias("base_inter"), F.col("gap").alias("base_gap"))
    b = tuned.select(*keys, F.col("inter").alias("tuned_inter"), F.col("gap").alias("tuned_gap"))
    delta = F.col("base_inter") - F.col("tuned_inter")
    conclusion = F.when(delta > 0.2, "strong").when(delta > 0.05, "moderate").otherwise("insufficient")
    return a.join(b, keys).select(
        *keys, delta.alias("delta_inter"), (F.col("tuned_gap") - F.col("base_gap")).alias("delta_gap"),
        (delta / F.greatest("base_inter", F.lit(1e-6)) * 100).alias("improvement_pct"),
        conclusion.alias("conclusion"),
    )


def nt_xent(views: DataFrame, temperature: float = 0.07, tile: int = TILE_ROWS) -> DataFrame:
    """Contrastive loss per batch of stored view pairs.

    `views` holds (batch, pair_id, view, vec) with two views per pair. Similarities are at most one, so
    exponents are shifted by 1 / temperature and the row sums of different tiles simply add up."""
    batch_kind = dict(views.dtypes)["batch"]
    pair_kind = dict(views.dtypes)["pair_id"]
    rows = views.withColumn("_row", F.concat_ws(":", F.col("pair_id").cast("string"), F.col("view").cast("string")))
    tiles = with_tiles(rows, "batch", "_row", tile)

    def work(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        names = ["batch", "pair_id", "view", "exp_sum", "positive"]
        if a.empty or b.empty:
            return pd.DataFrame(columns=names)
        sims = _matrix(a) @ _matrix(b).T
        same = a["_row"].to_numpy()[:, None] == b["_row"].to_numpy()[None, :]
        mate = (a["pair_id"].to_numpy()[:, None] == b["pair_id"].to_numpy()[None, :]) & ~same
        weights = np.where(same, 0.0, np.exp((sims - 1.0) / temperature))
        return pd.DataFrame({
            "batch": key[0], "pair_id": a["pair_id"].to_numpy(), "view": a["view"].to_numpy(),
            "exp_sum": weights.sum(axis=1), "positive": np.where(mate, sims, 0.0).sum(axis=1),
        })

    schema = f"batch {batch_kind}, pair_id {pair_kind}, view int, exp_sum double, positive double"
    parts = tile_pairs_within(tiles, "batch", work, schema, both_orders=True)
    per_row = parts.groupBy("batch", "pair_id", "view").agg(
        F.sum("exp_sum").alias("_e"), F.sum("positive").alias("_p")
    )
    loss = F.log("_e") + F.lit(1.0 / temperature) - F.col("_p") / F.lit(temperature)
    return per_row.groupBy("batch").agg(F.count(F.lit(1)).alias("views"), F.avg(loss).alias("loss"))

"""Queries over crops and embeddings."""

from pyspark.sql import functions as F

from reelspark.operators import reid as E
from reelspark.plans import bindings as B
from reelspark.plans.registry import query, rounded


def parsed(s, d):
    return E.parsed_crops(B.crops(s, d)).filter("case_no IS NOT NULL")


BURSTS = """
    SELECT case_no, video_idx, burst_no, count(*) AS images, min(frame_id) AS first_frame, max(frame_id) AS last_frame,
           count(*) = 3 AS complete
    FROM (SELECT *, sum(CASE WHEN gap >= 100 THEN 1 ELSE 0 END) OVER (PARTITION BY case_no, video_idx ORDER BY frame_id, name) AS burst_no
          FROM (SELECT *, frame_id - lag(frame_id) OVER (PARTITION BY case_no, video_idx ORDER BY frame_id, name) AS gap
                FROM parsed_crops)) GROUP BY 1, 2, 3"""


@query("bursts", f"SELECT * REPLACE (CAST(burst_no AS BIGINT) AS burst_no) FROM ({BURSTS})", "parsed_crops")
def _(s, d):
    return E.bursts(parsed(s, d))


@query("burst_totals", f"""
    SELECT count(*) AS bursts, count(*) FILTER (complete) AS complete, count(*) FILTER (NOT complete) AS incomplete,
           round(count(*) FILTER (complete) * 100.0 / count(*), 6) AS completion_pct FROM ({BURSTS})""", "parsed_crops")
def _(s, d):
    return rounded(E.burst_totals(parsed(s, d)))


@query("crop_counts", "SELECT case_no, video_idx, count(*) AS images FROM parsed_crops GROUP BY 1, 2", "parsed_crops")
def _(s, d):
    return E.crop_counts(parsed(s, d))


@query("crop_stats", """
    SELECT (SELECT count(*) FROM crops) - (SELECT count(*) FROM parsed_crops) AS parse_failures,
           CAST(sum(images) AS BIGINT) AS total_images, count(*) AS identities, round(avg(images), 6) AS mean_images,
           round(stddev_pop(images), 6) AS std_images, min(images) AS min_images, max(images) AS max_images,
           median(images) AS median_images
    FROM (SELECT count(*) AS images FROM parsed_crops GROUP BY case_no, video_idx)""", "crops parsed_crops")
def _(s, d):
    return rounded(E.crop_stats(E.parsed_crops(B.crops(s, d))))


@query("balance_weights", """
    SELECT name, case_no, round(1.0 / count(*) OVER (PARTITION BY case_no), 6) AS weight FROM parsed_crops""", "parsed_crops")
def _(s, d):
    return rounded(E.balance_weights(parsed(s, d)).select("name", "case_no", "weight"))


def _uniform_sql(seed: int) -> str:
    return f"CAST(CAST('0x' || substr(md5('{seed}:' || draw), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0::DOUBLE"


@query("balanced_sample", f"""
    , cases AS (SELECT case_no, count(*) AS n, row_number() OVER (ORDER BY md5(CAST(case_no AS VARCHAR)), case_no) - 1 AS case_at
                FROM parsed_crops GROUP BY 1),
    placed AS (SELECT range AS draw, CAST(floor({_uniform_sql(7)} * (SELECT count(*) FROM cases)) AS BIGINT) AS case_at,
                      {_uniform_sql(8)} AS u FROM (SELECT range, range AS draw FROM range(10000))),
    places AS (SELECT case_no, name, row_number() OVER (PARTITION BY case_no ORDER BY md5(name), name) - 1 AS row_at FROM parsed_crops)
    SELECT draw, case_no, name FROM placed JOIN cases USING (case_at) JOIN places USING (case_no)
    WHERE row_at = CAST(floor(u * n) AS BIGINT)""", "parsed_crops")
def _(s, d):
    return E.balanced_sample(parsed(s, d), 10000, 7).select("draw", "case_no", "name")


CAPTURES = """
    , best AS (SELECT video, frame, least(640, trunc(x2) + 30) - greatest(0, trunc(x1) - 30) >= 10
                          AND least(640, trunc(y2) + 30) - greatest(0, trunc(y1) - 30) >= 10 AS usable
               FROM (SELECT *, row_number() OVER (PARTITION BY video, frame ORDER BY conf DESC, det_no) AS i FROM dets
                     WHERE cls = 0 AND conf >= 0.5) WHERE i = 1 AND NOT (x1 < 0 OR x2 > 640)),
    followed AS (SELECT a.video, a.frame, l.last, b.usable AS second, c.usable AS third,
                        CASE WHEN a.frame + 4 > last THEN 'open' WHEN b.frame IS NULL THEN 'aborted'
                             WHEN a.frame + 8 > last THEN 'open' WHEN c.frame IS NULL THEN 'aborted' ELSE 'complete' END AS outcome
                 FROM best a JOIN (SELECT video, max(frame) AS last FROM dets GROUP BY 1) l USING (video)
                 LEFT JOIN best b ON b.video = a.video AND b.frame = a.frame + 4
                 LEFT JOIN best c ON c.video = a.video AND c.frame = a.frame + 8 AND b.frame IS NOT NULL WHERE a.usable),
    starts AS (SELECT *, CASE WHEN outcome = 'open' THEN last + 1 WHEN second IS NULL THEN frame + 17 ELSE frame + 21 END AS resume
               FROM followed),
    steps AS (SELECT s.*, n.frame AS following FROM starts s
              ASOF LEFT JOIN (SELECT video, frame FROM starts) n ON n.video = s.video AND n.frame >= s.resume),
    taken AS (SELECT video, min(frame) AS frame FROM steps GROUP BY 1
              UNION ALL SELECT s.video, s.following FROM taken JOIN steps s USING (video, frame) WHERE s.following IS NOT NULL)
    SELECT video, frame AS start_frame, outcome,
           list_filter([frame, CASE WHEN second THEN frame + 4 END, CASE WHEN third THEN frame + 8 END], lambda f: f IS NOT NULL) AS saved
    FROM taken JOIN steps USING (video, frame)"""


# chunks so short that the videos are cut and their entry states followed
@query("capture_bursts", CAPTURES, "dets")
def _(s, d):
    frames = E.burst_frames(B.dets(s, d), 640, 640, min_conf=0.5, margin=0)
    videos = B.dets(s, d).groupBy("video").agg((F.max("frame") + 1).alias("n_frames"))
    return E.capture_bursts(frames, videos, gap=3, cooldown=12, chunk=64)


@query("burst_frames", """
    SELECT video, frame, crop_w >= 10 AND crop_h >= 10 AS usable FROM (
        SELECT video, frame, least(640, trunc(x2) + 30) - greatest(0, trunc(x1) - 30) AS crop_w,
               least(640, trunc(y2) + 30) - greatest(0, trunc(y1) - 30) AS crop_h
        FROM (SELECT *, row_number() OVER (PARTITION BY video, frame ORDER BY conf DESC, det_no) AS i FROM dets
              WHERE cls = 0 AND conf >= 0.8) WHERE i = 1 AND NOT (x1 < 15 OR x2 > 625))""", "dets")
def _(s, d):
    return E.burst_frames(B.dets(s, d), 640, 640)


def neighbours(s, d):
    """Every identity with the next one."""
    ids = B.reid(s, d).select("identity").distinct()
    return ids.select(F.col("identity").alias("identity_a")).join(
        ids.select(F.col("identity").alias("identity_b"), (F.col("identity") - 1).alias("identity_a")), "identity_a")


SIMS = """
    , intra AS (SELECT a.identity AS identity_a, NULL::INT AS identity_b, list_inner_product(a.u, b.u) AS sim
                FROM reid a JOIN reid b ON a.identity = b.identity AND a.image < b.image),
    inter AS (SELECT a.identity AS identity_a, b.identity AS identity_b, list_inner_product(a.u, b.u) AS sim
              FROM reid a JOIN reid b ON b.identity = a.identity + 1),
    stats AS (SELECT identity_a, identity_b, avg(sim) AS mean, stddev_samp(sim) AS std, min(sim) AS min, max(sim) AS max,
                     count(*) AS n_pairs FROM (SELECT * FROM intra UNION ALL SELECT * FROM inter) GROUP BY 1, 2)"""


@query("similarity_stats", SIMS + """
    SELECT identity_a, identity_b, round(mean, 6) AS mean, round(std, 6) AS std, round(min, 6) AS min, round(max, 6) AS max, n_pairs
    FROM stats""", "reid")
def _(s, d):
    return rounded(E.similarity_stats(B.reid(s, d), neighbours(s, d)))


@query("cosine_pairs", SIMS + """
    SELECT identity_a, identity_b, round(mean, 6) AS mean, round(min, 6) AS min, round(max, 6) AS max, n_pairs
    FROM stats WHERE identity_b IS NOT NULL""", "reid")
def _(s, d):
    return rounded(E.inter_similarity(B.reid(s, d), neighbours(s, d), tile=64).drop("std"))


SEPARABLE = SIMS + """
    , sizes AS (SELECT identity, count(*) AS n FROM reid GROUP BY 1),
    sep AS (SELECT p.identity_a, p.identity_b, na.n AS n_a, nb.n AS n_b, coalesce(x.mean, 1) AS intra_a, coalesce(y.mean, 1) AS intra_b,
                   (coalesce(x.mean, 1) + coalesce(y.mean, 1)) / 2 AS avg_intra, p.mean AS inter,
                   (coalesce(x.mean, 1) + coalesce(y.mean, 1)) / 2 - p.mean AS gap
            FROM stats p LEFT JOIN stats x ON x.identity_a = p.identity_a AND x.identity_b IS NULL
            LEFT JOIN stats y ON y.identity_a = p.identity_b AND y.identity_b IS NULL
            JOIN sizes na ON na.identity = p.identity_a JOIN sizes nb ON nb.identity = p.identity_b
            WHERE p.identity_b IS NOT NULL)"""


@query("separability", SEPARABLE + """
    SELECT identity_a, identity_b, n_a, n_b, round(intra_a, 6) AS intra_a, round(intra_b, 6) AS intra_b,
           round(avg_intra, 6) AS avg_intra, round(inter, 6) AS inter, round(gap, 6) AS gap,
           CASE WHEN inter < 0.6 THEN 'success' WHEN inter < 0.8 THEN 'warning' ELSE 'failure' END AS verdict FROM sep""", "reid")
def _(s, d):
    return rounded(E.separability(B.reid(s, d), neighbours(s, d)))


def tuned(s, d):
    """A second model: the same images with every component moved."""
    return B.reid(s, d).withColumn("vec", F.transform("vec", lambda v: v.cast("double") * v.cast("double")))


@query("compare_models", """
    , base AS (SELECT identity, u AS v FROM reid),
    squares AS (SELECT identity, image, list_transform(u0, lambda x: x / sqrt(list_inner_product(u0, u0))) AS u
                FROM (SELECT label AS identity, vec_id AS image, list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x) AS u0
                      FROM embeddings)),
    sims AS (SELECT 'base' AS model, a.identity AS ia, b.identity AS ib, a.image = b.image AS self, list_inner_product(a.u, b.u) AS sim
             FROM reid a JOIN reid b ON b.identity IN (a.identity, a.identity + 1)
             UNION ALL SELECT 'tuned', a.identity, b.identity, a.image = b.image, list_inner_product(a.u, b.u)
             FROM squares a JOIN squares b ON b.identity IN (a.identity, a.identity + 1)),
    m AS (SELECT model, ia, ib, avg(sim) AS mean FROM sims WHERE NOT self GROUP BY 1, 2, 3),
    s AS (SELECT p.model, p.ia, p.ib, p.mean AS inter, (x.mean + y.mean) / 2 - p.mean AS gap
          FROM m p JOIN m x ON x.model = p.model AND x.ia = p.ia AND x.ib = p.ia
          JOIN m y ON y.model = p.model AND y.ia = p.ib AND y.ib = p.ib WHERE p.ib = p.ia + 1)
    SELECT b.ia AS identity_a, b.ib AS identity_b, round(b.inter - t.inter, 6) AS delta_inter, round(t.gap - b.gap, 6) AS delta_gap,
           round((b.inter - t.inter) / greatest(b.inter, 1e-6) * 100, 4) AS improvement_pct,
           CASE WHEN b.inter - t.inter > 0.2 THEN 'strong' WHEN b.inter - t.inter > 0.05 THEN 'moderate' ELSE 'insufficient' END AS conclusion
    FROM s b JOIN s t ON b.model = 'base' AND t.model = 'tuned' AND t.ia = b.ia AND t.ib = b.ib""", "reid")
def _(s, d):
    pairs = neighbours(s, d)
    out = E.compare_models(E.separability(B.reid(s, d), pairs), E.separability(tuned(s, d), pairs))
    return out.withColumns({"delta_inter": F.round("delta_inter", 6) + 0.0, "delta_gap": F.round("delta_gap", 6) + 0.0,
                            "improvement_pct": F.round("improvement_pct", 4) + 0.0})


@query("nt_xent", """
    , v AS (SELECT image // 128 AS batch, image // 2 AS pair_id, image, u FROM reid),
    x AS (SELECT a.batch, a.image, log(sum(CASE WHEN a.image <> b.image THEN exp(list_inner_product(a.u, b.u) / 0.5) END)) AS lse,
                 max(CASE WHEN a.image <> b.image AND a.pair_id = b.pair_id THEN list_inner_product(a.u, b.u) END) / 0.5 AS pos
          FROM v a JOIN v b ON b.batch = a.batch GROUP BY 1, 2)
    SELECT batch, count(*) AS views, round(avg(ln_lse - pos), 6) AS loss
    FROM (SELECT batch, lse * ln(10) AS ln_lse, pos FROM x) GROUP BY 1""", "reid")
def _(s, d):
    # batches of 64 stored pairs
    views = B.reid(s, d).select(
        F.floor(F.col("image") / 128).alias("batch"), F.floor(F.col("image") / 2).alias("pair_id"),
        (F.col("image") % 2).cast("int").alias("view"), "vec")
    return rounded(E.nt_xent(views, 0.5))

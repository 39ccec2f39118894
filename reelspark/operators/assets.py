"""Recording files: keys from paths, status, backup checks, curation planning."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from reelspark.constants import (
    CAMERAS, COMPANION_EXTENSIONS, DELETE_THRESHOLD_MB, MIB, RECORDING_KEY, STATUS_THRESHOLD_MB, SYNC_GROUPS,
)
from reelspark.functions import (
    bytes_to_mib, col, container_stem, directory, extension, file_name, normalise_channel, parent_dir, pivot_year,
    timestamp_from_stem,
)
from reelspark.operators.keys import one_per_key
from reelspark.plans.carry import FRAME_BUCKET, bucketed, carry, inside, with_running_sum
from reelspark.plans.spread import spread

# The three accepted forms of a recording path; groups are yy, mm-dd, case and camera.
KEY_PATTERNS = {
    "strict": r"^(?:.*[\\/])?DATA_(\d{2})-(\d{2}-\d{2})[\\/]Case(\d+)[\\/]([^\\/]+)[\\/][^\\/]+$",
    "relative": r"^DATA_(\d{2})-(\d{2}-\d{2})[\\/]Case(\d+)[\\/]([^\\/]+)(?:[\\/].*)?$",
    "anywhere": r"^(?:.*?[\\/])?DATA_(\d{2})-(\d{2}-\d{2})[^\\/]*[\\/]Case(\d+)[^\\/]*[\\/]([^\\/]+).*$",
}


def parse_recording_key(df: DataFrame, path: str = "path", mode: str = "strict", root: str = "") -> DataFrame:
    """Add recording_date, case_no and camera_name; all NULL when the path has no such key.

    `relative` reads the first three components under `root`. One regex pass pulls out all parts: a match is
    rewritten to its parts behind a mark that no path contains."""
    text = F.col(path)
    if mode == "relative" and root:
        prefix = root.rstrip("/\\") + "/"
        text = F.when(text.startswith(prefix), F.expr(f"substring(`{path}`, {len(prefix) + 1})")).otherwise(text)
    marked = df.withColumn("_key", F.regexp_replace(text, KEY_PATTERNS[mode], "\u0001$1\u0001$2\u0001$3\u0001$4"))
    parts = F.when(F.col("_key").startswith("\u0001"), F.split("_key", "\u0001"))
    keyed = marked.withColumn("_parts", parts)
    return keyed.select(
        *[F.col(c) for c in df.columns if c not in RECORDING_KEY],
        F.concat_ws("-", pivot_year(F.col("_parts")[1]), F.col("_parts")[2]).alias("recording_date"),
        F.col("_parts")[3].try_cast("int").alias("case_no"), F.col("_parts")[4].alias("camera_name"),
    ).withColumn("recording_date", F.when(F.col("camera_name").isNotNull(), F.col("recording_date")))


def exclude_junk(df: DataFrame, path: str = "path") -> DataFrame:
    """Drop paths with a component equal to JUNK in any case."""
    return df.filter(~F.exists(F.split(F.col(path), r"[\\/]"), lambda p: F.upper(p) == "JUNK"))


def size_status(size_bytes: str | Column, threshold_mb: int = STATUS_THRESHOLD_MB) -> Column:
    """3 missing, 1 at or above the threshold, 2 below it."""
    size = col(size_bytes)
    return F.when(size.isNull(), 3).when(size >= threshold_mb * MIB, 1).otherwise(2)


def size_status_label(status: str | Column) -> Column:
    status = col(status)
    return F.when(status == 1, ">=200MB").when(status == 2, "<200MB").when(status == 3, "Missing")


def presence_status(size_mb: str | Column) -> Column:
    """2 missing, 1 present; an empty file is present."""
    return F.when(col(size_mb).isNull(), 2).otherwise(1)


def in_cameras(df: DataFrame, cameras: Sequence[str] = CAMERAS) -> DataFrame:
    return df.filter(F.col("camera_name").isin(*cameras))


def date_contains(df: DataFrame, text: str, date: str = "recording_date") -> DataFrame:
    """Case-insensitive substring filter; empty text keeps every row."""
    return df if not text else df.filter(F.lower(F.col(date)).contains(text.lower()))


def small_files(df: DataFrame, mb: float = DELETE_THRESHOLD_MB, length: str = "length") -> DataFrame:
    return df.filter(F.col(length) < mb * MIB)


def freed_space(df: DataFrame, mb: float = DELETE_THRESHOLD_MB, length: str = "length") -> DataFrame:
    """Number and total MB of the files below the threshold."""
    return small_files(df, mb, length).agg(
        F.count(F.lit(1)).alias("files"),
        (F.coalesce(F.sum(length), F.lit(0)) / F.lit(float(MIB))).alias("freed_mb"),
    )


def tag_undersized(channel: str | Column, size: str | Column, min_bytes: int = STATUS_THRESHOLD_MB * MIB) -> Column:
    return F.when(col(size) < min_bytes, F.concat(col(channel), F.lit("_JUNK"))).otherwise(col(channel))


def map_channels(channel: str | Column, cameras: Sequence[str] = CAMERAS) -> Column:
    """Camera whose name equals the channel up to case, blanks and underscores; the first match wins."""
    known: dict[str, str] = {}
    for camera in cameras:
        known.setdefault(camera.lower().replace("_", "").replace(" ", ""), camera)
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    return F.coalesce(F.try_element_at(table, normalise_channel(channel)), F.lit("Unknown"))


def select_camera(df: DataFrame, spellings: Sequence[str]) -> DataFrame:
    """Rows of one camera under any spelling that have a path, by case then date."""
    rows = df.filter(F.col("camera_name").isin(*spellings) & F.col("path").isNotNull())
    return rows.orderBy("case_no", "recording_date", "path")


def largest_file(files: DataFrame, root_label: str = "") -> DataFrame:
    """Largest file per recording: whole MiB, its path, and status; equal sizes go to the smaller path.

    When every file is empty the path is NULL and the status is 2."""
    best = files.groupBy(*RECORDING_KEY).agg(
        F.max("length").alias("length"),
        F.min_by("path", F.struct(-F.col("length"), F.col("path"))).alias("_path"),
    )
    return best.select(
        *RECORDING_KEY,
        bytes_to_mib("length").alias("size_mb"),
        F.when(F.col("length") > 0, F.concat(F.lit(root_label), F.col("_path"))).alias("path"),
        size_status("length").alias("status"),
    )


def expected_grid(scan: DataFrame, cameras: Sequence[str] = CAMERAS) -> DataFrame:
    """Every case with every expected camera; combinations without a file have status 3.

    `scan` has one row per recording. The rows of a case are laid out per camera in a single aggregation, so the
    scan is read once and nothing is joined."""
    rest = [c for c in scan.columns if c not in RECORDING_KEY]
    row = F.struct(*rest)
    per_case = scan.groupBy("recording_date", "case_no").agg(F.array(*[
        F.struct(F.lit(c).alias("camera_name"), F.max(F.when(F.col("camera_name") == c, row)).alias("_row"))
        for c in cameras
    ]).alias("_grid"))
    flat = per_case.select("recording_date", "case_no", F.inline("_grid"))
    values = [F.col("_row")[c].alias(c) for c in rest if c != "status"]
    status = F.coalesce(F.col("_row")["status"], F.lit(3)).alias("status")
    return flat.select(*RECORDING_KEY, *values, status)


def _camera_rows(df: DataFrame, cameras: Sequence[str]) -> DataFrame:
    one = df.sparkSession.range(1)
    return one.select(F.explode(F.array(*map(F.lit, cameras))).alias("camera_name"))


def status_summary(t: DataFrame, cameras: Sequence[str] = CAMERAS) -> DataFrame:
    """Count per camera and presence status with zero fill; only statuses that occur, or both if none does."""
    counts = in_cameras(t, cameras).groupBy("camera_name").agg(
        F.count_if(presence_status("size_mb") == 1).alias("n1"),
        F.count_if(presence_status("size_mb") == 2).alias("n2"),
    )
    grid = _camera_rows(t, cameras).join(counts, "camera_name", "left").fillna(0, ["n1", "n2"])
    long = grid.select("camera_name", F.inline(F.array(
        F.struct(F.lit(1).alias("status"), F.lit("Present").alias("status_label"), F.col("n1").alias("n")),
        F.struct(F.lit(2).alias("status"), F.lit("Missing").alias("status_label"), F.col("n2").alias("n")),
    )))
    # one row: which statuses occur at all
    seen = counts.agg((F.coalesce(F.sum("n1"), F.lit(0)) > 0).alias("s1"),
                      (F.coalesce(F.sum("n2"), F.lit(0)) > 0).alias("s2"))
    keep = seen.select(F.explode(
        F.when(F.col("s1") & ~F.col("s2"), F.array(F.lit(1)))
        .when(F.col("s2") & ~F.col("s1"), F.array(F.lit(2)))
        .otherwise(F.array(F.lit(1), F.lit(2)))
    ).alias("status"))
    return long.join(F.broadcast(keep), "status").select("camera_name", "status", "status_label", "n")


def status_pivot(t: DataFrame, cameras: Sequence[str] = CAMERAS) -> DataFrame:
    """The summary with one column per status."""
    return (
        status_summary(t, cameras).groupBy("camera_name")
        .pivot("status_label", ["Present", "Missing"]).agg(F.sum("n")).fillna(0)
    )


def status_totals(t: DataFrame, cameras: Sequence[str] = CAMERAS) -> DataFrame:
    return status_summary(t, cameras).groupBy("status_label").agg(F.sum("n").alias("n"))


def case_total(t: DataFrame) -> DataFrame:
    """Number of distinct cases."""
    return t.agg(F.countDistinct(F.concat_ws("-", "recording_date", "case_no")).alias("cases"))


# ---- backup and companions -------------------------------------------------------------------


def backup_check(src: DataFrame, dst: DataFrame) -> DataFrame:
    """Flag each source file that exists anywhere in the destination under the same name and size."""
    stored = dst.select(file_name("path").alias("name"), F.col("length").alias("_size")).distinct()
    named = src.withColumn("name", file_name("path"))
    hit = stored.withColumn("_hit", F.lit(True)).withColumnRenamed("name", "_name")
    joined = named.join(hit, (F.col("name") == F.col("_name")) & (F.col("length") == F.col("_size")), "left")
    return joined.select(*src.columns, "name", F.coalesce("_hit", F.lit(False)).alias("backed_up"))


def backup_rate(src: DataFrame, dst: DataFrame) -> DataFrame:
    """Scanned, found and missing files, and the share found in percent (0 without files)."""
    checked = backup_check(src, dst).agg(
        F.count(F.lit(1)).alias("scanned"), F.count_if("backed_up").alias("found")
    )
    return checked.select(
        "scanned", "found", (F.col("scanned") - F.col("found")).alias("missing"),
        F.coalesce(F.try_divide(F.col("found") * 100.0, F.col("scanned")), F.lit(0.0)).alias("rate"),
    )


def _with_stem(files: DataFrame) -> DataFrame:
    named = files.withColumns({"dir": directory("path"), "_name": file_name("path")})
    return named.withColumns({"stem": container_stem("_name"), "ext": extension("_name")}).drop("_name")


def orphan_companions(files: DataFrame) -> DataFrame:
    """Companion files without a container of the same stem in their directory."""
    # one pass: a stem of a directory has a file for each extension and spelling, no more
    named = F.col("ext").isin(*COMPANION_EXTENSIONS)
    stems = _with_stem(files).filter(named | (F.col("ext") == ".seq")).groupBy("dir", "stem").agg(
        F.bool_or(F.col("ext") == ".seq").alias("_owned"),
        F.collect_list(F.when(named, F.struct("path", "ext"))).alias("_files"))
    return stems.filter(~F.col("_owned")).select("dir", "stem", F.inline("_files")).select("path", "dir", "stem", "ext")


def attach_companions(files: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """Each container with its companions as a map extension → path.

    A stem that differs only in case is a fallback: an exact match wins over it."""
    # one pass: containers and companions of a stem, in all its spellings, meet in one group
    parts = _with_stem(files).withColumn("_key", F.col("stem") if case_sensitive else F.lower("stem"))
    container = F.col("ext") == ".seq"
    # what counts is told apart while it is collected: a condition on rows would parse their paths once more
    groups = parts.groupBy("dir", "_key").agg(
        F.collect_list(F.when(container, F.struct("stem", F.col("path").alias("seq_path")))).alias("_containers"),
        F.collect_list(F.when(F.col("ext").isin(*COMPANION_EXTENSIONS), F.struct("ext", "stem", "path"))).alias("_companions"))
    each = groups.select("dir", "_companions", F.inline("_containers"))

    def best(e: str) -> Column:
        of = F.filter("_companions", lambda c: c["ext"] == e)
        return F.array_min(F.transform(of, lambda c: F.struct((c["stem"] != F.col("stem")).alias("other"), c["path"].alias("path"))))["path"]

    found = F.map_filter(
        F.create_map(*[x for e in COMPANION_EXTENSIONS for x in (F.lit(e), best(e))]), lambda _, v: v.isNotNull())
    return each.select("seq_path", "dir", "stem", found.alias("companions"))


def rebase_paths(df: DataFrame, inventory: DataFrame, new_root: str) -> DataFrame:
    """Keep a path that exists; else its part from `DATA_` under the new root when that exists; else NULL."""
    known = inventory.select("path").distinct()
    at = F.instr(F.col("path"), "DATA_")
    moved = F.when(at > 0, F.concat(F.lit(new_root.rstrip("/") + "/"), F.col("path").substr(at, F.length("path"))))
    old = known.select(F.col("path").alias("_old"))
    new = known.select(F.col("path").alias("_new"))
    joined = (
        df.withColumn("_moved", moved)
        .join(old, F.col("path") == F.col("_old"), "left")
        .join(new, F.col("_moved") == F.col("_new"), "left")
    )
    return joined.select(*df.columns, F.coalesce("_old", "_new").alias("resolved_path"))


def reuse_cached(scan: DataFrame, cached: DataFrame, keys: Sequence[str], size: str, value: str) -> DataFrame:
    """Carry a cached metric over when the size is unchanged and a value is present; else mark for computing.

    Of several cached rows of a key the one with the largest value counts."""
    old = one_per_key(cached.select(*keys, size, value), keys, [value, size]).select(*keys, F.col(size).alias("_size"), F.col(value).alias("_value"))
    joined = scan.join(old, list(keys), "left")
    fresh = F.col(size).eqNullSafe(F.col("_size")) & F.col("_value").isNotNull()
    return joined.select(
        *scan.columns, F.when(fresh, F.col("_value")).alias(value), (~fresh).alias("needs_compute")
    )


def pick_group(camera: str | Column, groups: Mapping[str, Sequence[str]] = SYNC_GROUPS) -> Column:
    """Sync group of a camera; a camera outside the groups is `solo_<camera>`."""
    camera = col(camera)
    group = F.concat(F.lit("solo_"), camera)
    for name, members in groups.items():
        group = F.when(camera.isin(*members), name).otherwise(group)
    return group


def hash_files(files: DataFrame, chunk: int = 8 * MIB) -> DataFrame:
    """SHA-256 of each file, read in chunks so that any size fits; NULL when unreadable."""
    from reelspark.sources.remote import open_file

    schema = pa.schema([("path", pa.string()), ("sha256", pa.string())])

    def digest(path: str) -> str | None:
        h = hashlib.sha256()
        try:
            with open_file(path) as f:
                while block := f.read(chunk):
                    h.update(block)
        except OSError:
            return None
        return h.hexdigest()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array([digest(p) for p in paths], pa.string())], schema=schema
            )

    return spread(files.select("path"), "path").mapInArrow(read, "path string, sha256 string")


def verify_copies(src: DataFrame, dst: DataFrame, key: str = "relative_path") -> DataFrame:
    """Join source and destination hashes on the relative path; a missing copy does not match."""
    a = src.select(key, F.col("sha256").alias("source_sha256"))
    b = dst.select(key, F.col("sha256").alias("copy_sha256"))
    same = F.coalesce(F.col("source_sha256") == F.col("copy_sha256"), F.lit(False))
    return a.join(b, key, "left").withColumn("verified", same)


# ---- curation --------------------------------------------------------------------------------


def group_cases(files: DataFrame, date: str = "date", stamp: str = "stamp", minutes: float = 30) -> DataFrame:
    """Number the cases of a day: a file joins while it is at most `minutes` from the first file of the case.

    The fold runs over the distinct whole seconds of a day, so its input is bounded whatever the number of
    files; it keeps only the first stamp of each case, and rows look their case up among those."""
    text = F.substring_index(F.col(stamp), ".", 1)
    moments = files.select(date, text.alias("_t")).distinct().withColumn(
        "_s", F.unix_timestamp(timestamp_from_stem("_t"))
    )
    days = moments.groupBy(date).agg(F.array_sort(F.collect_list(F.struct("_t", "_s"))).alias("_day"))
    start = F.struct(F.array().cast("array<string>").alias("anchors"), F.lit(None).cast("bigint").alias("at"))

    def step(acc: Column, x: Column) -> Column:
        opens = acc["at"].isNull() | (F.abs(x["_s"] - acc["at"]) > minutes * 60)
        return F.when(opens, F.struct(F.array_append(acc["anchors"], x["_t"]).alias("anchors"), x["_s"].alias("at"))
                      ).otherwise(acc)

    anchors = days.select(date, F.aggregate("_day", start, step)["anchors"].alias("_anchors"))
    numbered = files.withColumn("_t", text).join(anchors, date)
    case = F.size(F.filter("_anchors", lambda a: a <= F.col("_t")))
    return numbered.select(*files.columns, case.alias("case_no"))


#: Extension of a file name.
_SUFFIX = r"(\.[^./\\]*)$"


#: Rows of one name that are put in order together; those of a name with more are dealt out by the first digits of their digests.
NAME_ROWS = 1 << 17


def unique_names(
    manifest: DataFrame, dest: str = "destination_path", source: str = "source_path", distinct: bool = False
) -> DataFrame:
    """Colliding destinations get `_1`, `_2`, … before the extension; one file keeps the name. `distinct`: equal rows count once.

    A number is passed over where the name with it is a destination of its own, so no name occurs twice. The order
    among colliding files is that of a digest of their source, which lets a very common name be ranked in parallel.

    The i-th taken number t of a name has t - i free ones below it, so the r-th free number is r and as many more as there are
    taken ones with t - i < r. Names are counted first; then the rows are shuffled once, together with what each group of
    them has to know: the rows before it and the taken numbers among its own."""
    # columns go by place, so that the caller's names cannot meet those used here
    own = manifest.toDF(*[f"_c{i}" for i in range(len(manifest.columns))])
    name, file = (f"_c{manifest.columns.index(c)}" for c in (dest, source))
    rest = [c for c in own.columns if c not in (name, file)]
    names = own.groupBy(F.col(name).alias("_dest")).agg(F.count(F.lit(1)).alias("_rows"))
    # each stands for more than NAME_ROWS rows, so they are few beside those
    large = F.broadcast(names.filter(F.col("_rows") > NAME_ROWS).select(
        "_dest", F.ceil(F.log(16.0, F.col("_rows") / NAME_ROWS)).cast("int").alias("_digits")))
    digits = F.substring(F.md5(file), F.lit(1), F.col("_digits"))

    def dealt(how: str) -> DataFrame:
        joined = own.join(large, F.col(name).eqNullSafe(F.col("_dest")), how)
        return joined.select(*own.columns, F.when(F.col("_digits").isNotNull(), digits).otherwise("").alias("_group"))

    groups = (dealt("inner").distinct() if distinct else dealt("inner")).groupBy(F.col(name).alias("_dest"), "_group").agg(
        F.count(F.lit(1)).alias("_n"))
    turns = Window.partitionBy("_dest").orderBy("_group")
    groups = groups.select("_dest", "_group", (F.sum("_n").over(turns) - F.col("_n")).alias("_before"))
    marks = _taken_numbers(names)
    lent = _by_group(marks, groups)
    is_row = F.col("_at").isNull()
    # to a given number of tasks: sorted rows take many times the bytes of shuffled ones, by which partitions would be merged
    together = spread(dealt("left").unionByName(lent.withColumnRenamed("_dest", name), allowMissingColumns=True), name, "_group")
    together = together.withColumn("_digest", F.when(is_row, F.unhex(F.md5(file))))
    order = Window.partitionBy(name, "_group").orderBy(F.desc_nulls_last("_at"), "_digest", file, *(rest if distinct else []))
    new = is_row
    if distinct:
        whole = F.struct("_at", file, *rest)
        new = is_row & ~whole.eqNullSafe(F.lag(whole).over(order))
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    before = F.max(F.when(F.col("_at") == BEFORE, F.col("_lent"))).over(so_far)
    rank = F.coalesce(before, F.lit(0)) + F.sum(F.col("_new").cast("long")).over(so_far) - 1

    def ranked(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_new", new).withColumn("_rank", rank).filter(F.col("_new") | ~is_row)

    # only rows of names with taken numbers are put in order once more
    marked = marks.select("_dest").distinct().join(groups, "_dest", "left").select(
        F.col("_dest").alias("_name"), F.when(F.col("_before").isNull(), "").otherwise(F.col("_group")).alias("_part"))
    theirs = F.col(name).eqNullSafe(F.col("_name")) & F.col("_group").eqNullSafe(F.col("_part"))
    line = ranked(together.join(marked, theirs, "left_semi")).withColumn("_on", F.coalesce("_at", F.col("_rank") * 2))
    below = Window.partitionBy(name, "_group").orderBy("_on").rowsBetween(Window.unboundedPreceding, 0)
    passed = F.coalesce(F.sum(F.when(F.col("_at") > BEFORE, F.col("_lent"))).over(below), F.lit(0))
    numbered = line.withColumn("_number", F.col("_rank") + passed).unionByName(
        ranked(together.join(marked, theirs, "left_anti")).withColumns({"_on": F.lit(None).cast("long"), "_number": F.col("_rank")}))
    stem, suffix = F.regexp_replace(name, _SUFFIX, ""), F.regexp_extract(name, _SUFFIX, 1)
    renamed = F.concat(stem, F.lit("_"), F.col("_number").cast("string"), suffix)
    unique = F.when(F.col("_rank") == 0, F.col(name)).otherwise(renamed)
    return numbered.filter(is_row).select(*own.columns, unique.alias("unique_path")).toDF(*manifest.columns, "unique_path")


#: Places on a name's line: what a group is lent stands before its rows, a row of rank r at 2r, taken numbers between rows.
BEFORE, BELOW = -2, -1


def _by_group(marks: DataFrame, groups: DataFrame) -> DataFrame:
    """What groups are lent: the rows before them, the numbers taken below them, the marks among their rows.

    Names without `groups` are one group, which is lent its marks."""
    line = groups.withColumn("_at", F.col("_before") * 2).unionByName(marks, allowMissingColumns=True)
    starts = F.col("_before").isNotNull()
    opened = F.max(F.when(starts, F.struct("_at", "_group")))
    cut = carry(
        bucketed(line, "_at", FRAME_BUCKET), ["_dest"], {"_sum": F.sum("_lent"), "_last": opened},
        before={"_below": lambda w: F.sum("_sum").over(w), "_open": lambda w: F.last("_last", ignorenulls=True).over(w)},
    )
    so_far = inside(["_dest"], ["_at"]).rowsBetween(Window.unboundedPreceding, 0)
    placed = cut.withColumns({
        "_open": F.coalesce(opened.over(so_far), "_open"),
        "_below": F.coalesce("_below", F.lit(0)) + F.coalesce(F.sum("_lent").over(so_far), F.lit(0))})

    def mark(at: Column, value: str) -> Column:
        return F.struct(at.cast("long").alias("_at"), F.col(value).alias("_lent"))

    ahead = F.array(mark(F.lit(BEFORE), "_before"), mark(F.lit(BELOW), "_below"))
    return placed.select("_dest", F.when(F.col("_open").isNull(), "").otherwise(F.col("_open._group")).alias("_group"),
                         F.inline(F.when(starts, ahead).otherwise(F.array(mark(F.col("_at"), "_lent")))))


def _taken_numbers(names: DataFrame) -> DataFrame:
    """For names of several rows the numbers that other names take, as marks on the name's line.

    `_lent` tells how many numbers with m free ones below them stand at 2m + 1; those behind the last row are left out."""
    # read off the name only once names are counted: else the parse would go below the grouping, to every row and condition
    once = F.when(F.col("_rows") > 0, F.col("_dest"))
    bare = F.regexp_replace(once, _SUFFIX, "")
    numbered = names.select(
        F.concat(F.regexp_replace(bare, r"_[1-9]\d{0,17}$", ""), F.regexp_extract(once, _SUFFIX, 1)).alias("_base"),
        F.regexp_extract(bare, r"_([1-9]\d{0,17})$", 1).alias("_number")).filter("_number <> ''")
    several = names.filter(F.col("_rows") > 1)
    taken = numbered.join(several, F.col("_base") == F.col("_dest")).select(
        "_dest", "_rows", F.col("_number").cast("long").alias("_number"))
    free = F.col("_number") - F.col("_i")
    counted = with_running_sum(taken, ["_dest"], ["_number"], F.lit(1), "_i").filter(free < F.col("_rows") - 1)
    return counted.groupBy("_dest", (free * 2 + 1).alias("_at")).agg(F.count(F.lit(1)).alias("_lent"))


def distinct_channels(files: DataFrame) -> DataFrame:
    """Parent directories that hold containers."""
    return files.filter(F.lower("path").endswith(".seq")).select(parent_dir("path").alias("channel")).distinct()


def space_budget(manifest: DataFrame, free_bytes: int, size: str = "file_size", reserve: int = 100 * MIB) -> DataFrame:
    """Total bytes of the plan and whether they fit with a reserve."""
    total = F.coalesce(F.sum(size), F.lit(0))
    return manifest.agg(
        total.alias("total_bytes"), (total + reserve <= F.lit(free_bytes).cast("long")).alias("fits")
    )


def copy_plan(files: DataFrame, dest_root: str, cameras: Sequence[str] = CAMERAS) -> DataFrame:
    """Copy manifest: every container with its companions, sent to DATA_<date>/Case<n>/<channel>.

    `files` holds path and length; the capture stamp is the container's stem and the channel its directory.
    A container below the size threshold goes to `<channel>_JUNK` together with its companions."""
    # one pass: a stem of a directory has a file for each extension and spelling, no more; what is read off the path
    # stays above the grouping, so that nothing is parsed again for each condition
    parts = _with_stem(files)
    groups = parts.groupBy("dir", "stem").agg(F.collect_list(F.struct("path", "length", "ext", "stem")).alias("_files"))
    named = F.filter("_files", lambda f: f["ext"].isin(".seq", *COMPANION_EXTENSIONS))
    containers = F.filter(named, lambda f: f["ext"] == ".seq")
    found = groups.select(named.alias("_members"), F.explode(containers).alias("_seq")).withColumns({
        "_at": timestamp_from_stem("_seq.stem"), "_channel": map_channels(parent_dir("_seq.path"), cameras)})
    seqs = found.select(
        "_members", F.date_format("_at", "yy-MM-dd").alias("date"),
        tag_undersized("_channel", "_seq.length").alias("target"), F.col("_seq.stem").alias("stamp"))
    placed = group_cases(seqs.filter(F.col("date").isNotNull()))
    joined = placed.select("date", "target", "stamp", "case_no", F.inline("_members"))
    dest = F.concat_ws("/", F.lit(dest_root), F.concat(F.lit("DATA_"), F.col("date")),
                       F.concat(F.lit("Case"), F.col("case_no").cast("string")), "target", file_name("path"))
    return joined.select(
        F.col("path").alias("source_path"), dest.alias("destination_path"), F.col("length").alias("file_size"),
        F.col("ext").alias("file_type"),
        F.struct("date", F.col("target").alias("channel"), F.col("stamp").alias("timestamp"),
                 F.col("case_no").alias("case_number")).alias("sequence_info"),
        F.lit("pending").alias("status"),
    )


def copy_plan_totals(manifest: DataFrame) -> DataFrame:
    """Files, containers and bytes per date, case and channel with subtotals (NULL = all)."""
    flat = manifest.select("file_type", "file_size", "sequence_info.date", "sequence_info.case_number",
                           "sequence_info.channel")
    return flat.rollup("date", "case_number", "channel").agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(F.col("file_type") == ".seq").alias("sequences"),
        F.sum("file_size").alias("bytes"),
    )

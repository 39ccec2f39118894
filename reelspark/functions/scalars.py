"""Scalar functions as Column expressions. Nothing here leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from reelspark.constants import MIB, TARGET_FPS


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def first_group(c: Column, pattern: str, group: int = 1) -> Column:
    """Regex group, NULL when the pattern does not match or the group is empty."""
    return null_if_empty(F.regexp_extract(c, pattern, group))


def no_nan(c: str | Column) -> Column:
    """One missing value only: NaN becomes NULL."""
    return F.nanvl(col(c).cast("double"), F.lit(None).cast("double"))


# ---- dates, keys and names -------------------------------------------------------------------


def pivot_year(yy: str | Column) -> Column:
    """Two-digit year text: up to 69 is 20yy, above is 19yy."""
    yy = col(yy)
    return F.when(yy.cast("int") <= 69, F.concat(F.lit("20"), yy)).otherwise(F.concat(F.lit("19"), yy))


def date_from_filename(name: str | Column) -> Column:
    """`yyyy-mm-dd_hh-mm-ss…` or `mm-dd-yy_hh-mm-ss…` gives `yy-mm-dd`, anything else NULL."""
    base = F.substring_index(col(name), ".", 1)
    long_form = r"^\d{2}(\d{2})-(\d{2})-(\d{2})_\d{2}-\d{2}-\d{2}"
    short_form = r"^(\d{2})-(\d{2})-(\d{2})_\d{2}-\d{2}-\d{2}"

    def parts(pattern: str, order: tuple[int, int, int]) -> Column:
        joined = F.concat_ws("-", *[F.regexp_extract(base, pattern, i) for i in order])
        return F.when(base.rlike(pattern), joined)

    return F.coalesce(parts(long_form, (1, 2, 3)), parts(short_form, (3, 1, 2)))


def timestamp_from_stem(stem: str | Column) -> Column:
    """Capture time of a file stem; a fraction is dropped, an 8-character date is month first.

    The two century rules are written as rewrites, so the stem occurs once in the expression."""
    text = F.substring_index(col(stem), ".", 1)
    text = F.regexp_replace(text, r"^(\d\d)-(\d\d)-([0-6]\d)_", "20$3-$1-$2_")
    text = F.regexp_replace(text, r"^(\d\d)-(\d\d)-([7-9]\d)_", "19$3-$1-$2_")
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd_HH-mm-ss"))


def date_from_mtime(ts: str | Column) -> Column:
    return F.date_format(col(ts), "yy-MM-dd")


def month_of(date: str | Column) -> Column:
    return F.date_format(F.to_date(col(date)), "yyyy-MM")


def year_of(date: str | Column) -> Column:
    return F.year(F.to_date(col(date)))


def person_code(name: str | Column, start_date: str | Column) -> Column:
    """Initials of the first and last word and YYMM; empty text when either part is unusable."""
    words = F.split(F.trim(col(name)), r"\s+")
    date = col(start_date).cast("string")
    code = F.concat(
        F.upper(F.substring(F.element_at(words, 1), 1, 1)),
        F.upper(F.substring(F.element_at(words, -1), 1, 1)),
        F.substring(date, 3, 2),
        F.substring(date, 6, 2),
    )
    usable = (F.size(words) >= 2) & (F.length(date) >= 10)
    return F.when(usable, code).otherwise(F.lit(""))


def normalise_channel(name: str | Column) -> Column:
    return F.translate(F.lower(col(name)), " _", "")


def case_from_filename(name: str | Column) -> Column:
    """Case text of an image name; leading zeros are kept."""
    name = col(name)
    return F.coalesce(
        first_group(name, r"^(\d+)_v\d+_"),
        first_group(name, r"^[Cc](?:ase)?(\d+)_"),
        first_group(name, r"^(\d+)_"),
        F.substring_index(name, "_", 1),
    )


CROP_NAME = r"^\d+_v\d+_\d+\.jpg$"


def parse_crop_name(name: str | Column) -> Column:
    """`{case}_v{video}_{frame}.jpg` as struct<case_no, video_idx, frame_id>; NULL when not of that form."""
    name = col(name)
    video = F.split_part(name, F.lit("_"), F.lit(2))
    frame = F.substring_index(F.substring_index(name, "_", -1), ".", 1)
    return F.when(
        name.rlike(CROP_NAME),
        F.struct(
            F.substring_index(name, "_", 1).cast("int").alias("case_no"),
            F.substring(video, 2, 20).cast("int").alias("video_idx"),
            frame.cast("long").alias("frame_id"),
        ),
    )


def folder_from_key(date: str | Column, case_no: str | Column, camera: str | Column) -> Column:
    return F.concat_ws(
        "/",
        F.concat(F.lit("DATA_"), F.substring(col(date), 3, 8)),
        F.concat(F.lit("Case"), col(case_no).cast("string")),
        col(camera),
    )


def relative_path(path: str | Column, anchor: str = "recordings") -> Column:
    """Path below an anchor.

    `recordings`: after the first component equal to `Recordings` in any case, else the file name.
    `data`: from the first component starting with `DATA_`, else the last three components.
    `last3`: the last three components.
    """
    parts = F.split(col(path), r"[\\/]+")
    size = F.size(parts)
    if anchor == "recordings":
        at = F.array_position(F.transform(parts, lambda p: F.lower(p)), "recordings").cast("int")
        tail = F.when((at > 0) & (at < size), F.slice(parts, at + 1, size)).otherwise(F.slice(parts, -1, 1))
    elif anchor in ("data", "last3"):
        last = F.when(size >= 3, F.slice(parts, -3, 3)).otherwise(F.slice(parts, -1, 1))
        tail = last
        if anchor == "data":
            at = F.array_position(F.transform(parts, lambda p: p.startswith("DATA_")), True).cast("int")
            tail = F.when(at > 0, F.slice(parts, F.greatest(at, F.lit(1)), size)).otherwise(last)
    else:
        raise ValueError(f"unknown anchor: {anchor}")
    return F.array_join(tail, "/")


def _slashed(path: str | Column) -> Column:
    return F.replace(col(path), F.lit("\\"), F.lit("/"))


def file_name(path: str | Column) -> Column:
    return F.substring_index(_slashed(path), "/", -1)


def parent_dir(path: str | Column) -> Column:
    """Name of the directory that holds the file; empty for a bare file name."""
    return F.substring_index(directory(path), "/", -1)


def directory(path: str | Column) -> Column:
    """Everything before the file name, with forward slashes; empty for a bare file name."""
    whole = _slashed(path)
    keep = F.length(whole) - F.length(F.substring_index(whole, "/", -1)) - 1
    return F.left(whole, F.greatest(keep, F.lit(0)))


# Container and companion extensions, longest first.
_CONTAINER_EXTENSIONS = (".seq.metadata", ".seq.idx", ".seq", ".xml", ".aud")


def extension(name: str | Column) -> Column:
    """Lower-case extension; the two-part companion extensions count as one. Empty without a dot."""
    low = F.lower(col(name))
    known = F.lit(None).cast("string")
    for ext in reversed(_CONTAINER_EXTENSIONS):
        known = F.when(low.endswith(ext), ext).otherwise(known)
    plain = F.when(low.contains("."), F.concat(F.lit("."), F.substring_index(low, ".", -1))).otherwise(F.lit(""))
    return F.coalesce(known, plain)


def container_stem(name: str | Column) -> Column:
    """File name without a container or companion extension; dots inside the stem are kept."""
    name = col(name)
    low, stem = F.lower(name), name
    for ext in reversed(_CONTAINER_EXTENSIONS):
        stem = F.when(low.endswith(ext), F.left(name, F.length(name) - len(ext))).otherwise(stem)
    return stem


def count_label(n: str | Column, unit: str, plural: bool = True) -> Column:
    n = col(n)
    text = F.concat(n.cast("string"), F.lit(f" {unit}"))
    return F.when(n == 1, text).otherwise(F.concat(text, F.lit("s"))) if plural else text


# ---- time ------------------------------------------------------------------------------------


def hms_to_seconds(text: str | Column) -> Column:
    """`h:m:s`, `m:s` or a plain number of seconds; NULL when unreadable."""
    return _clock_parts(F.split(F.trim(col(text)), ":"))


def _clock_parts(parts: Column) -> Column:
    def number(i: int) -> Column:
        return F.try_element_at(parts, F.lit(i)).try_cast("double")

    return (
        F.when(F.size(parts) == 3, number(1) * 3600 + number(2) * 60 + number(3))
        .when(F.size(parts) == 2, number(1) * 60 + number(2))
        .when(F.size(parts) == 1, number(1))
    )


def jump_code_to_seconds(text: str | Column) -> Column:
    """Seek shorthand: clock parts, decimal seconds, or the digit codes ss, mss/mmss, hmmss."""
    val = F.trim(col(text))
    parts = F.filter(F.split(val, F.when(val.contains(":"), F.lit(":")).otherwise(F.lit(" "))), lambda p: p != "")
    digits = val.try_cast("bigint")
    width = F.length(digits.cast("string"))
    code = (
        F.when(width <= 2, digits)
        .when(width <= 4, F.floor(digits / 100) * 60 + digits % 100)
        .otherwise(F.floor(digits / 10000) * 3600 + F.floor(digits % 10000 / 100) * 60 + digits % 100)
    )
    return (
        F.when(val == "", F.lit(None).cast("double"))
        .when(val.contains(":") | val.contains(" "), _clock_parts(parts))
        .when(val.contains("."), val.try_cast("double"))
        .otherwise(code.cast("double"))
    )


def seconds_to_hms(seconds: str | Column, millis: bool = False) -> Column:
    """Clock text; hours are not wrapped at 24."""
    s = col(seconds).cast("double")
    hours = F.floor(s / 3600)
    minutes = F.floor((s - hours * 3600) / 60)
    rest = s - hours * 3600 - minutes * 60
    if millis:
        return F.format_string("%02d:%02d:%06.3f", hours, minutes, rest)
    return F.format_string("%02d:%02d:%02d", hours, minutes, F.floor(rest))


def unix_to_text(ts: str | Column) -> Column:
    """UTC text with microseconds; NULL and 0 mean unknown."""
    ts = col(ts)
    stamp = F.timestamp_micros(F.round(ts * 1000000).cast("long"))
    return F.when(ts.isNotNull() & (ts != 0), F.date_format(stamp, "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def decode_frame_time(seconds: str | Column, sub: str | Column) -> Column:
    """Seconds plus packed milliseconds (low word) and microseconds (high word)."""
    seconds, sub = col(seconds), col(sub).cast("long")
    millis = sub.bitwiseAND(F.lit(0xFFFF).cast("long"))
    micros = F.shiftright(sub, 16).bitwiseAND(F.lit(0xFFFF).cast("long"))
    return seconds.cast("double") + millis / F.lit(1000.0) + micros / F.lit(1000000.0)


def decode_description(raw: str | Column) -> Column:
    """Fixed-size UTF-16LE text up to its first NUL."""
    return F.substring_index(F.decode(col(raw), "UTF-16LE"), "\x00", 1)


# ---- sizes and rates -------------------------------------------------------------------------


def bytes_to_mib(n: str | Column, whole: bool = True) -> Column:
    n = col(n)
    return F.floor(n / MIB).cast("long") if whole else n.cast("double") / F.lit(float(MIB))


def bitrate(bit_rate: str | Column, size: str | Column, duration: str | Column) -> Column:
    """Given rate, else whole bits per second from size and duration, 500000 when there is no duration."""
    derived = F.when(col(duration) > 0, (col(size) * 8 / col(duration)).cast("long")).otherwise(F.lit(500000))
    return F.coalesce(col(bit_rate).cast("long"), derived)


# ---- geometry --------------------------------------------------------------------------------


def iou(a: tuple[str, str, str, str], b: tuple[str, str, str, str]) -> Column:
    """Intersection over union of two boxes given as column names (x1, y1, x2, y2)."""
    ax1, ay1, ax2, ay2 = map(F.col, a)
    bx1, by1, bx2, by2 = map(F.col, b)
    w = F.least(ax2, bx2) - F.greatest(ax1, bx1)
    h = F.least(ay2, by2) - F.greatest(ay1, by1)
    union = (ax2 - ax1) * (ay2 - ay1) + (bx2 - bx1) * (by2 - by1) - w * h
    return F.when((w > 0) & (h > 0), w * h / union).otherwise(F.lit(0.0))


def euclidean(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.hypot(col(x2) - col(x1), col(y2) - col(y1))


def dot(a: str | Column, b: str | Column) -> Column:
    products = F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def l2_normalise(v: str | Column) -> Column:
    """Unit vector in double precision; a zero vector stays zero."""
    norm = F.greatest(F.sqrt(dot(v, v)), F.lit(1e-12))
    return F.transform(col(v), lambda x: x.cast("double") / norm)


def cosine(a: str | Column, b: str | Column) -> Column:
    return dot(a, b) / F.greatest(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(1e-8))


# ---- camera synchronisation ------------------------------------------------------------------


def sync_delta(ts: str | Column, ref: str | Column, offset: str | Column) -> Column:
    return col(ts) - col(ref) + col(offset)


def sync_status(ts: str | Column, ref: str | Column, offset: str | Column, tolerance: float = 0.3) -> Column:
    """struct<delta, status, text> of a camera against the reference camera."""
    delta = sync_delta(ts, ref, offset)
    synced = F.abs(delta) <= tolerance
    text = (
        F.when(synced, F.lit("[OK] Synced"))
        .when(delta > 0, F.format_string("+%.1fs ahead", delta))
        .otherwise(F.format_string("%.1fs behind", delta))
    )
    return F.struct(
        delta.alias("delta"),
        F.when(synced, "synced").when(delta.isNotNull(), "out_of_sync").alias("status"),
        F.when(delta.isNotNull(), text).alias("text"),
    )


def nudge(offset: str | Column, amount: str | Column | float) -> Column:
    amount = F.lit(amount) if isinstance(amount, (int, float)) else col(amount)
    return F.bround(col(offset) + amount, 1)


def adjustment_text(camera: str | Column, old: str | Column, new: str | Column) -> Column:
    return F.format_string("%s: %+.1fs (was %+.1fs)", col(camera), col(new), col(old))


def seek_target(master: str | Column, offset: str | Column) -> Column:
    return F.greatest(F.lit(0.0), col(master) + col(offset))


# ---- texts of external tools -----------------------------------------------------------------


def parse_probe_json(text: str | Column) -> Column:
    """Duration in minutes of a probe report; NULL when missing or unreadable."""
    return F.get_json_object(col(text), "$.format.duration").try_cast("double") / 60


def parse_progress_line(text: str | Column, total_frames: str | Column | int | None = None) -> Column:
    """struct<frame, fps, speed, percent> of an encoder progress line."""
    text = col(text)
    frame = first_group(text, r"frame=\s*(\d+)").try_cast("long")
    fields = [
        frame.alias("frame"),
        first_group(text, r"fps=\s*([\d.]+)").try_cast("double").alias("fps"),
        first_group(text, r"speed=\s*([\d.]+)x").try_cast("double").alias("speed"),
    ]
    if total_frames is not None:
        total = F.lit(total_frames) if isinstance(total_frames, int) else col(total_frames)
        share = frame / F.greatest(F.lit(1), total) * 100
        fields.append(F.when(frame.isNotNull(), F.least(F.lit(100.0), share)).alias("percent"))
    return F.struct(*fields)


def log_line(at, success, skipped, date, case_no, group, camera, elapsed, message, output_path) -> Column:
    """One conversion log line; absent elapsed time and output path have their own forms."""
    status = F.when(col(skipped), "SKIPPED").when(col(success), "OK").otherwise("FAILED")
    spent = F.when(F.coalesce(col(elapsed), F.lit(0.0)) != 0, seconds_to_hms(elapsed)).otherwise("--:--:--")
    line = F.format_string(
        "[%s] %s | %s Case%d Group %s | %s | %s | %s",
        F.date_format(col(at), "yyyy-MM-dd HH:mm:ss"),
        F.rpad(status, 7, " "),
        col(date), col(case_no).cast("int"), col(group),
        F.when(F.length(col(camera)) >= 25, col(camera)).otherwise(F.rpad(col(camera), 25, " ")),
        spent,
        F.coalesce(col(message), F.lit("")),
    )
    has_output = F.coalesce(col(output_path), F.lit("")) != ""
    return F.when(has_output, F.concat(line, F.lit(" | "), col(output_path))).otherwise(line)


def half_even_frames(seconds: str | Column, fps: int = TARGET_FPS) -> Column:
    """Whole frames of a time span, rounded half to even."""
    return F.rint(col(seconds) * fps).cast("long")

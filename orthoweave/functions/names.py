"""File names, camera names and time strings as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orthoweave.functions.util import as_column

# The video file extensions that are recognised.
VIDEO_EXTENSIONS = (
    "avi", "mp4", "mov", "mkv", "wmv", "flv", "webm", "m4v", "mpg", "mpeg", "3gp", "dav",
)

_DIGITS14 = r"^[0-9]{14}$"
_INTEGER = r"^\s*[+-]?[0-9]+\s*$"
_DECIMAL = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def base_name(path) -> Column:
    """Last component of a ``/`` separated path."""
    return F.element_at(F.split(as_column(path), "/"), -1)


def stem(path) -> Column:
    """Base name without its last extension."""
    return F.regexp_replace(base_name(path), r"^(.+)\.[^.]+$", "$1")


def has_video_extension(path) -> Column:
    """True for a known extension written entirely in lower or upper case."""
    extension = F.regexp_extract(as_column(path), r"\.([^./]+)$", 1)
    known = [*VIDEO_EXTENSIONS, *(e.upper() for e in VIDEO_EXTENSIONS)]
    return extension.isin(known)


def _timestamp_from_fields(year, month, day, hour, minute, second) -> Column:
    # Casting text keeps the value free of any session time zone.
    text = F.concat(year, F.lit("-"), month, F.lit("-"), day, F.lit(" "),
                    hour, F.lit(":"), minute, F.lit(":"), second)
    return F.when(year != "0000", text.try_cast("timestamp_ntz"))


def timestamp_from_digits(text) -> Column:
    """``yyyyMMddHHmmss`` to TIMESTAMP_NTZ; anything else, also impossible dates, is NULL."""
    c = as_column(text)
    pieces = [F.substring(c, start, width) for start, width in
              ((1, 4), (5, 2), (7, 2), (9, 2), (11, 2), (13, 2))]
    return F.when(c.rlike(_DIGITS14), _timestamp_from_fields(*pieces))


# A path whose stem is parts joined by "_": any, a 14-digit time, any, a second
# 14-digit time, any. A trailing (n) is not part of the stem. The last dot begins the
# extension, so only a name without dots (group plain) may end without one.
_TIME = "([0-9]{4})([0-9]{2})([0-9]{2})([0-9]{2})([0-9]{2})([0-9]{2})"
_VIDEO_PATH = (
    r"^(?:.*/)?(?:(?=[^./]*$)(?<plain>)|(?=[^/]*\.))((?:[^_/]*_)*?)" + _TIME + r"_((?:[^_/]*_)*?)" + _TIME
    + r"(_[^/]*?)?(?:\([0-9]+\))?(?:\.[^./]+$|\k<plain>$)")
_VIDEO_FIELDS = "$16/$2$9/$3-$4-$5 $6:$7:$8/$10-$11-$12 $13:$14:$15"


def video_fields(path) -> Column:
    """``rest/camera_/start/end`` of a video path; other paths pass unchanged.

    One pattern does all the matching, and the times come out with a fixed width,
    so the fields can be cut by position.
    """
    return F.regexp_replace(as_column(path), _VIDEO_PATH, _VIDEO_FIELDS)


def fields_times(fields) -> tuple[Column, Column]:
    """Start and end time in :func:`video_fields`; both NULL for any other path."""
    c = as_column(fields)
    shaped = (
        (F.substring(c, -20, 1) == "/") & (F.substring(c, -40, 1) == "/")
        & (F.substr(c, F.lit(1), F.length(c) - 40) != "/")
        & (F.substring(c, -39, 4) != "0000") & (F.substring(c, -19, 4) != "0000"))
    return tuple(
        F.when(shaped, F.substring(c, at, 19).try_cast("timestamp_ntz")) for at in (-39, -19))


def fields_camera(fields) -> Column:
    """Camera name in :func:`video_fields`."""
    return F.regexp_extract(as_column(fields), "([^/]*)_/.{19}/.{19}$", 1)


def parse_video_name(path) -> Column:
    """Struct (camera, start_time, end_time) from a video file name, or NULL.

    The stem is split at ``_``; the first two 14-digit parts are the times and
    the other parts in front of the second time form the camera name.
    """
    fields = video_fields(path)
    start, end = fields_times(fields)
    return F.when(
        start.isNotNull() & end.isNotNull(),
        F.struct(fields_camera(fields).alias("camera"), start.alias("start_time"),
                 end.alias("end_time")))


def relative_seconds(text) -> Column:
    """Seconds of an offset written ``M:S``, ``H:M:S`` or as a plain number, else NULL."""
    c = as_column(text)
    parts = F.split(c, ":", -1)

    def whole(i: int) -> Column:
        part = F.get(parts, F.lit(i))
        return F.when(part.rlike(_INTEGER), F.trim(part).try_cast("bigint")).cast("double")

    def real(i: int) -> Column:
        part = F.get(parts, F.lit(i))
        return F.when(part.rlike(_DECIMAL), F.trim(part).try_cast("double"))

    return (
        F.when(F.size(parts) == 1, real(0))
        .when(F.size(parts) == 2, whole(0) * 60 + real(1))
        .when(F.size(parts) == 3, whole(0) * 3600 + whole(1) * 60 + real(2))
    )


def parse_clock_time(text) -> Column:
    """A clock time of 14 digits or ``yyyy-MM-dd HH:mm:ss`` as TIMESTAMP_NTZ, else NULL."""
    c = as_column(text)
    pattern = r"^([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})\s+([0-9]{1,2}):([0-9]{1,2}):([0-9]{1,2})$"
    fields = [F.regexp_extract(c, pattern, 1)]
    fields += [F.lpad(F.regexp_extract(c, pattern, i), 2, "0") for i in range(2, 7)]
    dashed = F.when(c.rlike(pattern), _timestamp_from_fields(*fields))
    return F.coalesce(timestamp_from_digits(c), dashed)


def interval_seconds(text) -> Column:
    """Seconds of an interval such as ``2min`` or ``1.5 h`` without the space, else NULL."""
    c = F.trim(F.lower(as_column(text)))
    pattern = r"^([0-9.]+)(s|sec|second|seconds|m|min|minute|minutes|h|hr|hour|hours)$"
    value = F.regexp_extract(c, pattern, 1).try_cast("double")
    unit = F.substring(F.regexp_extract(c, pattern, 2), 1, 1)
    return (
        F.when(unit == "s", value)
        .when(unit == "m", value * 60)
        .when(unit == "h", value * 3600)
    )


def qualified_camera(camera, path, base: str) -> Column:
    """Camera name prefixed with the folders between ``base`` and the file."""
    camera, path = as_column(camera), as_column(path)
    root = base.rstrip("/") + "/"
    relative = F.when(path.startswith(root), F.substr(path, F.lit(len(root) + 1)))
    folders = F.regexp_extract(relative, r"^(.*[^/])/+[^/]*$", 1)
    prefix = F.replace(F.regexp_replace(folders, "/+", "_"), F.lit(" "), F.lit("_"))
    return F.when(F.coalesce(prefix, F.lit("")) == "", camera).otherwise(
        F.concat_ws("_", prefix, camera))


def elapsed_seconds(start, ts) -> Column:
    """Seconds from ``start`` to ``ts`` as DOUBLE."""
    return F.timestamp_diff("MICROSECOND", as_column(start), as_column(ts)) / F.lit(1e6)


def frame_number(ts, start, fps) -> Column:
    """Number of the frame shown at ``ts``, truncated."""
    return (elapsed_seconds(start, ts) * as_column(fps)).cast("bigint")


def ts_folder(ts) -> Column:
    """``yyyyMMdd_HHmmss`` folder name of a timestamp."""
    text = F.substring(as_column(ts).cast("timestamp_ntz").cast("string"), 1, 19)
    return F.translate(text, " -:", "_")


def offset_folder(offset) -> Column:
    """Folder name of a relative offset."""
    return F.concat(F.lit("timestamp_"), F.translate(as_column(offset), ":.", "ms"))


def global_camera(name) -> Column:
    """Site-wide camera name of a recorder channel; names of another form pass unchanged."""
    c = as_column(name)
    pattern = r"^[a-z]+([0-9]+)_N910A6_ch([0-9]+)_main"
    folder = F.regexp_extract(c, pattern, 1).try_cast("bigint")
    channel = F.regexp_extract(c, pattern, 2).try_cast("bigint")
    mapped = F.format_string("N910A6_ch%02d_main", (folder - 1) * 8 + channel)
    return F.when(folder.isNotNull() & channel.isNotNull(), mapped).otherwise(c)


def path_date(path, default) -> Column:
    """First run of 8 digits in the nearest parent folder that has one, else in the stem."""
    c = as_column(path)
    parts = F.split(c, "/")
    folders = F.reverse(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0))))
    dates = F.filter(
        F.transform(folders, lambda d: F.regexp_extract(d, "([0-9]{8})", 1)), lambda d: d != "")
    in_stem = F.regexp_extract(stem(c), "([0-9]{8})", 1)
    return F.coalesce(F.get(dates, F.lit(0)), F.when(in_stem != "", in_stem), as_column(default))

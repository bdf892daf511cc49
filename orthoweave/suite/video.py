"""Queries on video names, clock times and segments."""

from __future__ import annotations

from pyspark.sql import functions as F

from orthoweave.functions import names
from orthoweave.operators import catalog
from orthoweave.plans import frames
from orthoweave.suite import views
from orthoweave.suite.oracle_views import with_views
from orthoweave.suite.registry import query

STAMP = "strftime({}, '%Y%m%d_%H%M%S')"

# --- listing -------------------------------------------------------------------------------

_EXTENSIONS = "['.dav','.DAV','.mp4','.Mp4','.txt','.MKV']"


def _listing(spark, sf_dir):
    extensions = F.array(*[F.lit(e) for e in (".dav", ".DAV", ".mp4", ".Mp4", ".txt", ".MKV")])
    return views.segments(spark, sf_dir).select(F.concat(
        F.regexp_replace("path", r"\.dav$", ""),
        F.get(extensions, (F.col("event_id") % 6).cast("int"))).alias("path"))


_LISTING_SQL = f"""select regexp_replace(path, '\\.dav$', '')||({_EXTENSIONS})[1+event_id%6] path, event_id
                   from segs"""


@query("SRC1_video_files", with_views("segs", f"""
    select distinct path from ({_LISTING_SQL}) where event_id%6 in (0,1,2,5)"""))
def video_files(spark, sf_dir):
    return catalog.video_files(_listing(spark, sf_dir))


@query("U1_union_extensions", with_views("segs", f"""
    select distinct path from ({_LISTING_SQL}) where event_id%6 in (0,1,2,5)"""))
def union_extensions(spark, sf_dir):
    listing = _listing(spark, sf_dir)
    endings = ((".dav", ".DAV"), (".mp4", ".MP4"), (".mkv", ".MKV"))
    return catalog.union_listings([
        listing.where(F.col("path").endswith(low) | F.col("path").endswith(high))
        for low, high in endings])


# --- names ---------------------------------------------------------------------------------

PARSED = """
    select distinct path, regexp_extract(path, '/(dac[0-9]+)/', 1)
             ||'_'||regexp_extract(path, '(N910A6_ch[0-9]+_main)_', 1) camera,
           start_time, end_time from segs where event_id%11<>0"""


@query("P1_parse_video_name", with_views("segs", f"""
    select path, substr(camera, 6) camera, {STAMP.format('start_time')} start_folder,
           {STAMP.format('end_time')} end_folder
    from ({PARSED})"""))
def parse_video_name(spark, sf_dir):
    return catalog.catalog_segments(views.segments(spark, sf_dir).select("path")).select(
        "path", "camera", names.ts_folder("start_time").alias("start_folder"),
        names.ts_folder("end_time").alias("end_folder"))


@query("P5_qualified_camera", with_views("segs", f"select path, camera from ({PARSED})"))
def qualified_camera(spark, sf_dir):
    paths = views.segments(spark, sf_dir).select("path")
    return catalog.catalog_segments(paths, base="/v").select("path", "camera")


@query("F1_unparsed_videos", with_views("segs", "select distinct path from segs where event_id%11=0"))
def unparsed_videos(spark, sf_dir):
    return catalog.unparsed_videos(views.segments(spark, sf_dir))


def _offset_texts(spark, sf_dir):
    k, v = F.col("event_id"), F.col("value")
    seconds = F.format_string("%d.5", k % 60)
    text = (
        F.when(k % 4 == 0, F.concat((k % 7).cast("string"), F.lit(":"), seconds))
        .when(k % 4 == 1, F.concat((k % 3).cast("string"), F.lit(":"), (k % 59).cast("string"),
                                   F.lit(":"), seconds))
        .when(k % 4 == 2, F.floor(v).cast("string"))
        .otherwise(F.concat_ws(":", *[(k % n).cast("string") for n in (2, 3, 5, 7)])))
    return views.table(spark, sf_dir, "events").select("event_id", text.alias("offset"))


_OFFSETS_SQL = """
    select event_id, case event_id%4
        when 0 then cast(event_id%7 as varchar)||':'||cast(event_id%60 as varchar)||'.5'
        when 1 then cast(event_id%3 as varchar)||':'||cast(event_id%59 as varchar)||':'
                    ||cast(event_id%60 as varchar)||'.5'
        when 2 then cast(cast(floor(value) as bigint) as varchar)
        else concat_ws(':', event_id%2, event_id%3, event_id%5, event_id%7) end as "offset"
    from events"""

_SECONDS_SQL = """
    case len(p) when 1 then p[1]::double when 2 then p[1]::int*60+p[2]::double
         when 3 then p[1]::int*3600+p[2]::int*60+p[3]::double end"""


@query("P2_relative_seconds", f"""
    select event_id, "offset", {_SECONDS_SQL} as seconds
    from (select *, string_split("offset", ':') p from ({_OFFSETS_SQL}))""")
def relative_seconds(spark, sf_dir):
    return _offset_texts(spark, sf_dir).withColumn("seconds", names.relative_seconds("offset"))


@query("P3_parse_clock_time", """
    select event_id, strftime(coalesce(try_strptime(t,'%Y%m%d%H%M%S'), try_strptime(t,'%Y-%m-%d %H:%M:%S')),
           '%Y%m%d_%H%M%S') folder
    from (select event_id, case event_id%3 when 0 then strftime(ts,'%Y%m%d%H%M%S')
          when 1 then strftime(ts,'%Y-%m-%d %H:%M:%S') else strftime(ts,'%Y13%d%H%M%S') end t from events)""")
def parse_clock_time(spark, sf_dir):
    text = F.substring(F.col("ts").cast("string"), 1, 19)
    digits = F.translate(text, "- :", "")
    k = F.col("event_id") % 3
    shown = F.when(k == 0, digits).when(k == 1, text).otherwise(
        F.concat(F.substring(digits, 1, 4), F.lit("13"), F.substring(digits, 7, 8)))
    return views.table(spark, sf_dir, "events").select(
        "event_id", names.ts_folder(names.parse_clock_time(shown)).alias("folder"))


_UNITS = ["s", "SEC", " minutes", "min ", "h", "Hours", "day", "hr"]


@query("P4_interval_seconds", f"""
    select event_id, text, case event_id%8 when 0 then n when 1 then n when 3 then n*60 when 4 then n*3600
           when 5 then n*3600 when 7 then n*3600 end::double as seconds
    from (select event_id, floor(value)+0.5 n,
          cast(cast(floor(value) as bigint) as varchar)||'.5'||({_UNITS!r})[1+event_id%8] text from events)""")
def interval_seconds(spark, sf_dir):
    units = F.array(*[F.lit(u) for u in _UNITS])
    text = F.concat(F.floor("value").cast("string"), F.lit(".5"),
                    F.get(units, (F.col("event_id") % 8).cast("int")))
    return views.table(spark, sf_dir, "events").select(
        "event_id", text.alias("text"), names.interval_seconds(text).alias("seconds"))


@query("P6_frame_number", with_views("segs", """
    select path, cast(trunc(((event_id*7)%3600 + 0.25)*29.97) as bigint) frame_number from segs"""))
def frame_number(spark, sf_dir):
    micros = ((F.col("event_id") * 7) % 3600) * 1000000 + 250000
    at = F.timestamp_add("MICROSECOND", micros, F.col("start_time"))
    return views.segments(spark, sf_dir).select(
        "path", names.frame_number(at, "start_time", F.lit(29.97)).alias("frame_number"))


@query("P7_ts_folder", f"""
    select event_id, {STAMP.format('ts')} ts_folder,
           'timestamp_'||replace(replace("offset", ':', 'm'), '.', 's') offset_folder
    from events join ({_OFFSETS_SQL}) using (event_id)""")
def ts_folder(spark, sf_dir):
    shown = _offset_texts(spark, sf_dir).select(
        "event_id", names.offset_folder("offset").alias("offset_folder"))
    stamped = views.table(spark, sf_dir, "events").select(
        "event_id", names.ts_folder("ts").alias("ts_folder"))
    return stamped.join(shown, "event_id")


_CHANNEL_SQL = """case when event_id%5=0 then 'NVR' else 'dac' end||cast(1+camera//8 as varchar)
                  ||'_N910A6_ch'||cast(1+event_id%8 as varchar)||'_main'"""


def _channel_name():
    prefix = F.when(F.col("event_id") % 5 == 0, "NVR").otherwise("dac")
    return F.concat(prefix, F.expr("1 + camera div 8").cast("string"), F.lit("_N910A6_ch"),
                    (1 + F.col("event_id") % 8).cast("string"), F.lit("_main"))


@query("P8_global_camera", with_views("segs", f"""
    select event_id, {_CHANNEL_SQL} as name, case when event_id%5=0 then {_CHANNEL_SQL}
           else 'N910A6_ch'||lpad(cast((camera//8)*8+1+event_id%8 as varchar),2,'0')||'_main' end global_name
    from segs"""))
def global_camera(spark, sf_dir):
    return views.segments(spark, sf_dir).select(
        "event_id", _channel_name().alias("name"),
        names.global_camera(_channel_name()).alias("global_name"))


@query("P9_path_date", with_views("segs", """
    select event_id, case event_id%3 when 0 then strftime(start_time,'%Y%m%d')
           when 1 then strftime(end_time,'%Y%m%d') else '19700101' end date from segs"""))
def path_date(spark, sf_dir):
    start, end = names.ts_folder("start_time"), names.ts_folder("end_time")
    k = F.col("event_id") % 3
    path = (
        F.when(k == 0, F.concat(F.lit("/data/20200229_x/"), start, F.lit("/sub/cam.tiff")))
        .when(k == 1, F.concat(F.lit("/data/frames/cam_"), end, F.lit(".tiff")))
        .otherwise(F.lit("/data/frames/cam.20240101")))
    return views.segments(spark, sf_dir).select(
        "event_id", names.path_date(path, F.lit("19700101")).alias("date"))


# --- grids and matches ---------------------------------------------------------------------

@query("S1_clock_grid", with_views("segs", f"""
    select event_id, {STAMP.format('g')} ts_folder from (
      select event_id, unnest(generate_series(start_time, end_time, interval '450 seconds')) g
      from segs where start_time<end_time)"""))
def clock_grid(spark, sf_dir):
    segments = views.segments(spark, sf_dir).select("event_id", "start_time", "end_time")
    return catalog.times_within(segments, 450.0).select("event_id", names.ts_folder("ts").alias("ts_folder"))


_MATCH_SQL = f"""
    select camera, {STAMP.format('ts')} ts_folder, path, {STAMP.format('start_time')} start_folder
    from (select s.camera, g.ts, s.path, s.start_time from segs s join grid g
          on g.ts between s.start_time and s.end_time
          qualify row_number() over (partition by s.camera, g.ts order by s.start_time, s.path)=1)"""


def _shown(matches):
    return matches.select("camera", names.ts_folder("ts").alias("ts_folder"), "path",
                          names.ts_folder("start_time").alias("start_folder"))


@query("J1_match_frames", with_views("segs grid", _MATCH_SQL))
def match_frames(spark, sf_dir):
    """Any set of clock times: the bucketed interval join."""
    start, end = views.clock_limits(spark, sf_dir)
    grid = catalog.make_grid(spark, start, end, "1h")
    return _shown(catalog.match_frames(
        views.segments(spark, sf_dir), catalog.clock_grid(spark, grid)))


@query("W1_first_segment", with_views("segs grid", _MATCH_SQL))
def first_segment(spark, sf_dir):
    """A regular grid: segments list their own clock times, then the first one is kept."""
    start, end = views.clock_limits(spark, sf_dir)
    grid = catalog.make_grid(spark, start, end, "1h")
    return _shown(catalog.match_grid(views.segments(spark, sf_dir), grid))


@query("O1_sort_segments", with_views("segs", f"""
    select camera, path, {STAMP.format('start_time')} start_folder from segs"""))
def sort_segments(spark, sf_dir):
    return catalog.ordered_segments(views.segments(spark, sf_dir)).select(
        "camera", "path", names.ts_folder("start_time").alias("start_folder"))


_REQUESTS_SQL = f"""
    select camera, path, ts, cast(trunc(epoch_us(ts)/1e6*25-epoch_us(start_time)/1e6*25) as bigint) frame_number
    from (select s.camera, s.path, g.ts, s.start_time from ({PARSED}) s join grid g
          on g.ts between s.start_time and s.end_time
          qualify row_number() over (partition by s.camera, g.ts order by s.start_time, s.path)=1)"""


def _requests(spark, sf_dir):
    start, end = views.clock_limits(spark, sf_dir)
    return frames.plan_frames(
        views.segments(spark, sf_dir).select("path"),
        catalog.make_grid(spark, start, end, "1h"), base="/v", fps=F.lit(25.0))


@query("C1_plan_frames", with_views("segs grid", f"""
    select camera, path, {STAMP.format('ts')} ts_folder, frame_number from ({_REQUESTS_SQL})"""))
def plan_frames(spark, sf_dir):
    return _requests(spark, sf_dir).select("camera", "path", "ts_folder", "frame_number")


@query("A9_requests_per_video", with_views("segs grid", f"""
    select camera, path, {STAMP.format("date_trunc('day', ts)")} block_folder, count(*) n_requests,
           string_agg(cast(frame_number as varchar), ',' order by ts) frames
    from ({_REQUESTS_SQL}) group by all"""))
def requests_per_video(spark, sf_dir):
    grouped = catalog.requests_per_video(_requests(spark, sf_dir), "DAY")
    frames_text = F.array_join(
        F.transform("requests", lambda q: q["frame_number"].cast("string")), ",")
    return grouped.select("camera", "path", names.ts_folder("block_start").alias("block_folder"),
                          "n_requests", frames_text.alias("frames"))


@query("C2_plan_clock_times", with_views("segs", f"""
    select camera, path, {STAMP.format('ts')} ts_folder,
           cast(trunc(epoch_us(ts)/1e6*25-epoch_us(start_time)/1e6*25) as bigint) frame_number
    from (select s.camera, s.path, g.ts, s.start_time from ({PARSED}) s
          join (select distinct date_trunc('minute', o_orderdate)
                  - interval 1 day * (datediff('day', date '2024-01-01', o_orderdate))
                  + interval 1 day * (o_orderkey%30) + interval 1 minute * (o_orderkey%1440) ts from orders) g
          on g.ts between s.start_time and s.end_time
          qualify row_number() over (partition by s.camera, g.ts order by s.start_time, s.path)=1)"""))
def plan_clock_times(spark, sf_dir):
    """Clock times that form no grid, one per order."""
    k = F.col("o_orderkey")
    base = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    minute_of_day = F.hour("o_orderdate") * 60 + F.minute("o_orderdate")
    minutes = (k % 30) * 1440 + (k % 1440) + minute_of_day
    times = views.table(spark, sf_dir, "orders").select(
        F.timestamp_add("MINUTE", minutes, base).alias("ts")).distinct()
    planned = frames.plan_clock_times(
        views.segments(spark, sf_dir).select("path"), times, base="/v", fps=F.lit(25.0))
    return planned.select("camera", "path", "ts_folder", "frame_number")


def _clips(spark, sf_dir):
    """Clips with frame rate and number of frames; some rates are zero."""
    k = F.col("event_id")
    return views.segments(spark, sf_dir).select(
        "event_id", "path", "start_time", (k % 4 * 12.5).alias("fps"),
        (F.timestamp_diff("SECOND", F.col("start_time"), F.col("end_time")) * 10).alias("frame_count"))


_CLIPS_SQL = """select event_id, path, start_time, (event_id%4*12.5)::double fps,
                datediff('second', start_time, end_time)*10 frame_count from segs"""
_DURATION = "case when fps>0 then frame_count/fps else 0 end"


@query("F2_in_duration", with_views("segs", f"""
    select event_id, offset_seconds from (
      select event_id, ((event_id*13)%4000-500)::double offset_seconds, {_DURATION} d from ({_CLIPS_SQL}))
    where offset_seconds>=0 and offset_seconds<=d"""))
def in_duration(spark, sf_dir):
    requests = _clips(spark, sf_dir).withColumn(
        "offset_seconds", ((F.col("event_id") * 13) % 4000 - 500).cast("double"))
    return catalog.in_duration(requests).select("event_id", "offset_seconds")


@query("C3_plan_offsets", with_views("segs", f"""
    select path, offset_folder, name, cast(trunc(s*fps) as bigint) frame_number
    from (select path, fps, {_DURATION} d,
                 regexp_extract(path, '/(dac[0-9]+)/', 1)||'_'||regexp_extract(path, '([^/]*)\\.dav$', 1) as name,
                 unnest(['timestamp_0m10','timestamp_1m30','timestamp_2m45s5','timestamp_0m40m00']) offset_folder,
                 unnest([10.0,90.0,165.5,2400.0]) s from ({_CLIPS_SQL}))
    where s<=d"""))
def plan_offsets(spark, sf_dir):
    return frames.plan_offsets(
        _clips(spark, sf_dir), ["0:10", "1:30", "2:45.5", "0:40:00"], base="/v"
    ).select("path", "offset_folder", "name", "frame_number")

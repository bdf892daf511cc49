"""Queries on rasters: layout, mosaics, gathers, elevation, neighbourhoods."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orthoweave.functions import geometry, pixels
from orthoweave.operators import dem as dem_ops
from orthoweave.operators import mosaic, neighbourhood, remap, seam, status, tile_costs, tiles
from orthoweave.operators.matching import with_metadata
from orthoweave.suite import views
from orthoweave.suite.oracle_views import projected, with_views
from orthoweave.suite.registry import ORACLES, query

# sides of the suite's tiles: half an image, and less than an overlap
SUITE_TILE, SMALL_TILE = 4, 3

# --- layout --------------------------------------------------------------------------------


@query("P10_image_bounds", with_views("images", """
    select ts, camera, x_min+width*pixel_width x_max, y_max+height*pixel_height y_min from images"""))
def image_bounds(spark, sf_dir):
    return mosaic.with_bounds(views.images(spark, sf_dir)).select("ts", "camera", "x_max", "y_min")


@query("A2_mosaic_bounds", with_views("mgrid", "select ts, x_min, x_max, y_min, y_max from mgrid"))
def mosaic_bounds(spark, sf_dir):
    return mosaic.mosaic_bounds(views.images(spark, sf_dir))


@query("A3_mosaic_grid", with_views("mgrid", "select ts, res resolution, width, height from mgrid"))
def mosaic_grid(spark, sf_dir):
    return mosaic.mosaic_grid(views.images(spark, sf_dir)).select("ts", "resolution", "width", "height")


@query("P19_order_priority", with_views("placed", "select ts, camera, cast(pos as int) as position from placed"))
def order_priority(spark, sf_dir):
    return mosaic.file_positions(views.images(spark, sf_dir)).select("ts", "camera", "position")


@query("O2_left_to_right", with_views("images", """
    select ts, camera, cast(row_number() over (partition by ts order by x_min, file) as int) seq from images"""))
def left_to_right(spark, sf_dir):
    return mosaic.left_to_right(views.images(spark, sf_dir)).select("ts", "camera", "seq")


@query("P20_mosaic_offset", with_views("placed", """
    select ts, camera, row_start, col_start, rh region_height, rw region_width from placed"""))
def mosaic_offset(spark, sf_dir):
    return mosaic.place_images(views.images(spark, sf_dir)).select(
        "ts", "camera", "row_start", "col_start", "region_height", "region_width")


# --- pixels --------------------------------------------------------------------------------

GRAY_SQL = "(3735*b+19235*g+9798*r+16384)//32768"


@query("P16_bgr_to_gray", with_views("px", f"""
    select ts, camera, row, col, cast({GRAY_SQL} as int) gray from px"""))
def bgr_to_gray(spark, sf_dir):
    return views.pixels(spark, sf_dir).select(
        "ts", "camera", "row", "col", pixels.bgr_to_gray().alias("gray"))


@query("P17_valid_pixel", with_views("px", """
    select ts, camera, count(*) filter (greatest(b,g,r)>0) valid, count(*) total from px group by ts, camera"""))
def valid_pixel(spark, sf_dir):
    return views.pixels(spark, sf_dir).groupBy("ts", "camera").agg(
        F.count_if(pixels.valid_pixel()).alias("valid"), F.count(F.lit(1)).alias("total"))


def _placed_pixels(spark, sf_dir):
    """Images are joined with their placement first and become pixels afterwards."""
    placed = mosaic.place_images(views.images(spark, sf_dir)).select(
        "ts", "camera", *mosaic.PLACEMENT)
    arrays = with_metadata(views.image_arrays(spark, sf_dir), placed, ["ts", "camera"])
    return mosaic.to_mosaic(views.explode_pixels(arrays))


@query("P18_centre_priority", with_views("prio", """
    select ts, camera, mr mosaic_row, mc mosaic_col, round(priority, 9) priority from prio"""))
def centre_priority(spark, sf_dir):
    priority = geometry.centre_priority("region_row", "region_col", "region_height", "region_width")
    return _placed_pixels(spark, sf_dir).select(
        "ts", "camera", "mosaic_row", "mosaic_col", F.round(priority, 9).alias("priority"))


def _best(order, where):
    return with_views("prio", f"""
        select ts, mr mosaic_row, mc mosaic_col, b, g, r, cast(pos as int) as position from prio
        where greatest(b,g,r)>0 and {where}
        qualify row_number() over (partition by ts, mr, mc order by {order})=1""")


@query("A12_mosaic_center", _best("priority desc, pos", "priority>0"))
def mosaic_center(spark, sf_dir):
    return mosaic.priority_argmax(_placed_pixels(spark, sf_dir), "center")


@query("A12_mosaic_order", _best("pos desc", "true"))
def mosaic_order(spark, sf_dir):
    return mosaic.priority_argmax(_placed_pixels(spark, sf_dir), "order")


@query("A14_band_stats", with_views("px", """
    select camera, cast(band as int) band, min(v) minimum, max(v) maximum, round(avg(v),6) mean,
           round(stddev_pop(v),6) stddev, round(count(v)*100.0::double/count(*),6) valid_percent
    from (select camera, band, nullif(v, 0) v from (
      select camera, unnest([1,2,3]) band, unnest([b,g,r]) v from px)) group by camera, band"""))
def band_stats(spark, sf_dir):
    """Zero counts as missing."""
    stats = status.band_stats(views.pixels(spark, sf_dir), ["camera"], no_data=0)
    return stats.select("camera", "band", "minimum", "maximum", F.round("mean", 6).alias("mean"),
                        F.round("stddev", 6).alias("stddev"),
                        F.round(F.col("valid_percent").cast("double"), 6).alias("valid_percent"))


# --- gathers -------------------------------------------------------------------------------

@query("J5_remap_bilinear", with_views("orthopx", "select ts, camera, row, col, b, g, r from orthopx"))
def remap_bilinear(spark, sf_dir):
    return remap.remap_bilinear(views.pixels(spark, sf_dir), views.lookup_map(spark, sf_dir))


@query("A7_map_range", with_views("lmap", """
    select camera, min(src_x)::double min_x, max(src_x)::double max_x,
           min(src_y)::double min_y, max(src_y)::double max_y from lmap group by camera"""))
def map_range(spark, sf_dir):
    found = remap.map_range(views.lookup_map(spark, sf_dir))
    return found.select("camera", *[F.col(c).cast("double").alias(c) for c in found.columns[1:]])


# --- output grids and elevation ------------------------------------------------------------

@query("A1_camera_bounds", with_views("gcp", """
    select camera, min(X)-0.5 x_min, max(X)+0.5 x_max, min(Y)-0.5 y_min, max(Y)+0.5 y_max, count(*) n_gcps
    from gcp group by camera"""))
def camera_bounds(spark, sf_dir):
    return remap.camera_bounds(views.gcps(spark, sf_dir))


@query("P11_ortho_grid", with_views("ogrid", """
    select camera, width, height, x_min, y_max, pw pixel_width, ph pixel_height from ogrid"""))
def ortho_grid(spark, sf_dir):
    return remap.camera_grids(views.gcps(spark, sf_dir), 0.25).drop(
        "n_gcps", "rotation_x", "rotation_y")


@query("P12_pixel_to_world", with_views("opx", """
    select camera, row, col, x_min+col*pw x, y_max+row*ph y from opx"""))
def pixel_to_world(spark, sf_dir):
    grid = dem_ops.ortho_pixels(remap.camera_grids(views.gcps(spark, sf_dir), 0.25))
    x, y = geometry.pixel_to_world()
    return grid.select("camera", "row", "col", x.alias("x"), y.alias("y"))


def _grid(spark, sf_dir):
    return dem_ops.ortho_pixels(remap.camera_grids(views.gcps(spark, sf_dir), 0.25))


@query("J6_dem_bilinear", with_views("demfill", """
    select camera, row, col, round(z::double, 4) z from demfill"""))
def dem_bilinear(spark, sf_dir):
    found = dem_ops.dem_bilinear(
        _grid(spark, sf_dir), views.dem(spark, sf_dir), views.dem_transform(spark, sf_dir))
    return found.select("camera", "row", "col", F.round(F.col("z").cast("double"), 4).alias("z"))


_NEAREST_SQL = """
    select o.camera, o.row, o.col, d.z::float z from opx o left join dem d
      on d.row=floor((64.0-(y_max+o.row*ph))/1.0::double) and d.col=floor((x_min+o.col*pw+16.0)/1.0::double)"""


@query("J7_dem_nearest", with_views("opx dem", f"""
    select camera, row, col, round(coalesce(z, (avg(z) over (partition by camera))::float)::double, 4) z
    from ({_NEAREST_SQL})"""))
def dem_nearest(spark, sf_dir):
    found = dem_ops.dem_nearest(
        _grid(spark, sf_dir), views.dem(spark, sf_dir), views.dem_transform(spark, sf_dir))
    return found.select("camera", "row", "col", F.round(F.col("z").cast("double"), 4).alias("z"))


@query("A6_dem_mean_range", with_views("demraw", """
    select camera, round(avg(z),6) mean_z, min(z)::double min_z, max(z)::double max_z
    from demraw group by camera"""))
def dem_mean_range(spark, sf_dir):
    sampled = dem_ops.dem_bilinear(
        _grid(spark, sf_dir), views.dem(spark, sf_dir), views.dem_transform(spark, sf_dir), fill=None)
    return dem_ops.valid_mean(sampled).select(
        "camera", F.round("mean_z", 6).alias("mean_z"),
        F.col("min_z").cast("double").alias("min_z"), F.col("max_z").cast("double").alias("max_z"))


_MAP_POINTS = "select camera, row, col, x_min+col*pw X, y_max+row*ph Y, z::double Z from demfill"


@query("S6_build_ortho_map", with_views("demfill latest", """
    select camera, row, col, round((a*sc*f+cx)::float::double, 2) src_x,
           round((b*sc*f+cy)::float::double, 2) src_y from project""", projected(_MAP_POINTS, "latest")))
def build_ortho_map(spark, sf_dir):
    built = remap.build_ortho_map(
        views.gcps(spark, sf_dir), views.latest_calibrations(spark, sf_dir),
        views.dem(spark, sf_dir), views.dem_transform(spark, sf_dir), 0.25)
    return built.select("camera", "row", "col", *[
        F.round(F.col(c).cast("double"), 2).alias(c) for c in ("src_x", "src_y")])


# --- neighbourhoods ------------------------------------------------------------------------

KEYS = ["ts", "camera"]

GRAYS = f"select ts, camera, row, col, cast({GRAY_SQL} as int) gray from px"

SOBEL = """
    select *, sqrt((gx*gx+gy*gy)::double) gradient from (
      select ts, camera, row, col, gray, coalesce(lag(dx) over d, lead(dx) over d)+2*dx
               +coalesce(lead(dx) over d, lag(dx) over d) gx,
             coalesce(lead(sx) over d, lag(sx) over d)-coalesce(lag(sx) over d, lead(sx) over d) gy
      from (select *, coalesce(lead(gray) over a, lag(gray) over a)-coalesce(lag(gray) over a, lead(gray) over a) dx,
                   coalesce(lag(gray) over a, lead(gray) over a)+2*gray
                     +coalesce(lead(gray) over a, lag(gray) over a) sx
            from grays window a as (partition by ts, camera, row order by col))
      window d as (partition by ts, camera, col order by row))"""

# direct form: all 225 mirrored neighbours of each pixel
VARIANCE = """
    select p.ts, p.camera, p.row, p.col,
           sum(q.gray*q.gray*m.n*k.n)/225.0::double
             - (sum(q.gray*m.n*k.n)/225.0::double)*(sum(q.gray*m.n*k.n)/225.0::double) variance
    from grays p
    join mirror m on m.here=p.row join mirror k on k.here=p.col
    join grays q on q.ts=p.ts and q.camera=p.camera and q.row=m.there and q.col=k.there
    group by 1,2,3,4"""

MIRROR = """
    select here, there, count(*) n from (
      select here, case when (p%14+14)%14<8 then (p%14+14)%14 else 14-(p%14+14)%14 end there
      from (select unnest(range(8)) here), (select unnest(range(-7,8)) d), lateral (select here+d p))
    group by 1,2"""

RASTER_VIEWS = {"grays": GRAYS, "mirror": MIRROR, "sobel": SOBEL, "variances": VARIANCE}


def _gray(spark, sf_dir):
    return views.pixels(spark, sf_dir).select(
        "ts", "camera", "row", "col", pixels.bgr_to_gray().alias("gray"),
        F.lit(views.SIDE).alias("height"), F.lit(views.SIDE).alias("width"))


@query("W2_sobel_gradient", with_views("px", """
    select ts, camera, row, col, cast(gx as int) gx, cast(gy as int) gy, round(gradient, 6) gradient
    from sobel""", RASTER_VIEWS))
def sobel_gradient(spark, sf_dir):
    return neighbourhood.sobel_gradient(_gray(spark, sf_dir), KEYS).select(
        "ts", "camera", "row", "col", "gx", "gy", F.round("gradient", 6).alias("gradient"))


@query("W3_local_variance", with_views("px", """
    select ts, camera, row, col, round(variance, 6) variance from variances""", RASTER_VIEWS))
def local_variance(spark, sf_dir):
    return neighbourhood.local_variance(_gray(spark, sf_dir), KEYS).select(
        "ts", "camera", "row", "col", F.round("variance", 6).alias("variance"))


@query("A13_region_max", with_views("px", """
    select ts, camera, round(max(gradient), 6) max_gradient, round(max(variance), 6) max_variance
    from sobel join variances using (ts, camera, row, col) group by ts, camera""", RASTER_VIEWS))
def region_max(spark, sf_dir):
    both = neighbourhood.local_variance(
        neighbourhood.sobel_gradient(_gray(spark, sf_dir), KEYS), KEYS)
    found = neighbourhood.region_max(both, KEYS, ["gradient", "variance"])
    return found.select(*KEYS, *[F.round(c, 6).alias(c) for c in ("max_gradient", "max_variance")])


@query("W4_combined_cost", with_views("px", """
    select ts, camera, row, col, round(0.5::double*gradient/(max(gradient) over i + 1e-10::double)
           + 0.5::double*variance/(max(variance) over i + 1e-10::double), 6) as cost
    from sobel join variances using (ts, camera, row, col)
    window i as (partition by ts, camera)""", RASTER_VIEWS))
def combined_cost(spark, sf_dir):
    return neighbourhood.quality_cost(_gray(spark, sf_dir), KEYS, "combined").select(
        "ts", "camera", "row", "col", F.round("cost", 6).alias("cost"))


def _gray_tiles(spark, sf_dir):
    return tiles.to_tiles(views.pixels(spark, sf_dir), SUITE_TILE)


@query("W2_sobel_gradient_tiles", ORACLES["W2_sobel_gradient"])
def sobel_gradient_tiles(spark, sf_dir):
    """Gradient on tiles; rims of one pixel are exchanged."""
    found = tile_costs.sobel_tiles(_gray_tiles(spark, sf_dir), KEYS, SUITE_TILE)
    rows = tile_costs.to_rows(found, KEYS, {"gx": T.IntegerType(), "gy": T.IntegerType(), "gradient": T.DoubleType()}, SUITE_TILE)
    return rows.withColumn("gradient", F.round("gradient", 6))


@query("W3_local_variance_tiles", ORACLES["W3_local_variance"])
def local_variance_tiles(spark, sf_dir):
    """Variance on tiles that are smaller than its window."""
    found = tile_costs.variance_tiles(_gray_tiles(spark, sf_dir), KEYS, SUITE_TILE)
    return tile_costs.to_rows(found, KEYS, {"variance": T.DoubleType()}, SUITE_TILE).withColumn("variance", F.round("variance", 6))


@query("A13_region_max_tiles", ORACLES["A13_region_max"])
def region_max_tiles(spark, sf_dir):
    found = tile_costs.region_max_tiles(_gray_tiles(spark, sf_dir), KEYS, SUITE_TILE)
    return found.select(*KEYS, *[F.round(c, 6).alias(c) for c in ("max_gradient", "max_variance")])


@query("W4_combined_cost_tiles", ORACLES["W4_combined_cost"])
def combined_cost_tiles(spark, sf_dir):
    found = tile_costs.cost_tiles(_gray_tiles(spark, sf_dir), KEYS, SUITE_TILE, "combined")
    return tile_costs.to_rows(found, KEYS, {"cost": T.DoubleType()}, SUITE_TILE).withColumn("cost", F.round("cost", 6))


@query("W5_seam_boundary", with_views("px", """
    select p.ts, p.camera, p.row, p.col,
           p.b<100 and exists (select 1 from px q where q.ts=p.ts and q.camera=p.camera and q.b>=100
             and abs(q.row-p.row)<=1 and abs(q.col-p.col)<=1) boundary
    from px p"""))
def seam_boundary(spark, sf_dir):
    mask = views.pixels(spark, sf_dir).select("ts", "camera", "row", "col", (F.col("b") >= 100).alias("mask"))
    return neighbourhood.seam_boundary(mask, KEYS).select("ts", "camera", "row", "col", "boundary")


# --- seams ---------------------------------------------------------------------------------

@query("F7_overlap", with_views("mpx", """
    select n.ts, n.camera, n.mr mosaic_row, n.mc mosaic_col, n.b, o.b old_b
    from mpx n join mpx o on o.ts=n.ts and o.camera=n.camera-1 and o.mr=n.mr and o.mc=n.mc
    where greatest(n.b,n.g,n.r)>0 and greatest(o.b,o.g,o.r)>0"""))
def overlap(spark, sf_dir):
    """Cells that an image shares with its left neighbour."""
    placed = _placed_pixels(spark, sf_dir)
    # pair number n: camera n as the new image, camera n - 1 as the existing mosaic
    new = placed.withColumn("ts", F.struct("ts", F.col("camera").alias("pair")))
    old = placed.withColumn("ts", F.struct("ts", (F.col("camera") + 1).alias("pair")))
    return seam.overlap(new, old).select(
        "ts.ts", "camera", "mosaic_row", "mosaic_col", "b", "old_b")


def _pair_costs(spark, sf_dir):
    """Overlap cost of every image with its left neighbour, one pair as one mosaic step."""
    cost = neighbourhood.quality_cost(_gray(spark, sf_dir), KEYS, "gradient").select(*KEYS, "row", "col", "cost")
    placed = _placed_pixels(spark, sf_dir).join(cost, [*KEYS, "row", "col"])
    new = placed.withColumn("ts", F.col("ts") * 1000 + F.col("camera"))
    old = placed.withColumn("ts", F.col("ts") * 1000 + F.col("camera") + 1)
    both = seam.overlap(new, old).select(
        *seam.CELL, *seam.REGION, F.col("cost").alias("cost_new"))
    return both.join(old.select(*seam.CELL, F.col("cost").alias("cost_old")), seam.CELL).withColumn(
        "cost", (F.col("cost_new") + F.col("cost_old")) / 2)


# cheapest path by recursion over the columns, then back from its end
SEAM_VIEWS = {
    **RASTER_VIEWS,
    "gcost": """
        select ts, camera, row, col, gradient/(max(gradient) over (partition by ts, camera)+1e-10::double) cst
        from sobel""",
    "pc": """
        select m.*, g.cst from mpx m join gcost g on g.ts=m.ts and g.camera=m.camera and g.row=m.rr and g.col=m.rc
        where greatest(b,g,r)>0""".replace("greatest(b,g,r)", "greatest(m.b,m.g,m.r)"),
    "cells": """
        select n.ts*1000+n.camera ts, n.mr, n.mc, (n.cst+o.cst)/2 as cost from pc n join pc o
          on o.ts=n.ts and o.camera=n.camera-1 and o.mr=n.mr and o.mc=n.mc""",
    "ends": "select ts, min(mc) l, max(mc) r from cells group by ts",
    "reach": """
        select ts, mr, mc, cost as d from cells join ends using (ts) where mc=l
        union all
        select c.ts, c.mr, c.mc, min(p.d)+c.cost from reach p join cells c
          on c.ts=p.ts and c.mc=p.mc+1 and abs(c.mr-p.mr)<=1 group by c.ts, c.mr, c.mc, c.cost""",
    "path": """
        select ts, mc, min(struct_pack(d := d, mr := mr)).mr mr from reach join ends using (ts) where mc=r
        group by ts, mc
        union all
        select q.ts, d.mc, min(struct_pack(d := d.d, mr := d.mr)).mr from path q join reach d
          on d.ts=q.ts and d.mc=q.mc-1 and abs(d.mr-q.mr)<=1 group by q.ts, d.mc""",
    "regions": "select ts*1000+camera ts, row_start, col_start, rh from placed",
}


@query("S3_seam_lines", with_views("px mpx", """
    select c.ts, cast(c.mr as int) mosaic_row, cast(coalesce(min(p.mc), g.col_start) as int) seam_col
    from cells c join ends e on e.ts=c.ts and c.mc=e.l join regions g on g.ts=c.ts
    left join path p on p.ts=c.ts and p.mr=c.mr
    where c.ts in (select ts from path) group by c.ts, c.mr, g.col_start
    union all
    select e.ts, cast(g.row_start+k as int), cast((l+r)//2 as int)
    from ends e join regions g using (ts), lateral (select unnest(range(g.rh)) k)
    where e.ts not in (select ts from path)""", SEAM_VIEWS))
def seam_lines(spark, sf_dir):
    """Seams between all neighbouring images."""
    return seam.seam_lines(_pair_costs(spark, sf_dir))


@query("S4_seam_mask", with_views("px mpx", """
    select c.ts, c.mr mosaic_row, c.mc mosaic_col, coalesce(c.mc>=s.seam_col, false) use_new
    from cells c left join (
      select c.ts, c.mr, coalesce(min(p.mc), g.col_start) seam_col
      from cells c join ends e on e.ts=c.ts and c.mc=e.l join regions g on g.ts=c.ts
      left join path p on p.ts=c.ts and p.mr=c.mr
      where c.ts in (select ts from path) group by c.ts, c.mr, g.col_start
      union all
      select c.ts, c.mr, (e.l+e.r)//2 from cells c join ends e using (ts)
      where c.ts not in (select ts from path) group by all) s on s.ts=c.ts and s.mr=c.mr""", SEAM_VIEWS))
def seam_mask(spark, sf_dir):
    """Side of the seam of every cell that neighbouring images share."""
    costs = _pair_costs(spark, sf_dir)
    lines = seam.seam_lines(costs)
    right = F.coalesce(F.col("mosaic_col") >= F.col("seam_col"), F.lit(False))
    return costs.select(*seam.CELL).join(lines, ["ts", "mosaic_row"], "left").select(
        *seam.CELL, right.alias("use_new"))


def _cost_sql(method: str, source: str) -> str:
    """Cost of every raster of a source (ts, camera, row, col, gray)."""
    gradient = "gradient/(max(gradient) over i+1e-10::double)"
    variance = "variance/(max(variance) over i+1e-10::double)"
    cost = {"gradient": gradient, "variance": variance,
            "combined": f"0.5::double*({gradient})+0.5::double*({variance})"}[method]
    tables = {"gradient": [SOBEL], "variance": [VARIANCE], "combined": [SOBEL, VARIANCE]}[method]
    joined = " join ".join(f"({t.replace(' grays ', f' {source} ')}) m{i}" for i, t in enumerate(tables))
    using = "using (ts, camera, row, col)" if len(tables) > 1 else ""
    return f"select ts, camera, row, col, {cost} cst from {joined} {using} window i as (partition by ts, camera)"


def _seam_steps(steps: int, method: str = "gradient") -> dict[str, str]:
    """Views st1, st2, ...: the seam mosaic after each image of every ts; ln1, ...: its cuts."""
    found = {**RASTER_VIEWS, "gcost": _cost_sql(method, "grays")}
    found["seqs"] = """
        select ts, camera, row_number() over (partition by ts order by x_min, file) seq from images"""
    found["st0"] = """
        select null::bigint ts, null::bigint mr, null::bigint mc, null::int b, null::int g, null::int r,
               null::int camera where false"""
    for k in range(1, steps + 1):
        found[f"reg{k}"] = f"""
            select m.ts, m.camera, m.rr, m.rc, m.mr, m.mc, m.rh, m.rw, m.b, m.g, m.r, g.cst,
                   greatest(m.b,m.g,m.r)>0 ok, o.ts is not null old, o.b ob, o.g og, o.r orr, o.camera oc,
                   (3735*coalesce(o.b,0)+19235*coalesce(o.g,0)+9798*coalesce(o.r,0)+16384)//32768 gray
            from mpx m join seqs s on s.ts=m.ts and s.camera=m.camera and s.seq={k}
            join gcost g on g.ts=m.ts and g.camera=m.camera and g.row=m.rr and g.col=m.rc
            left join st{k - 1} o on o.ts=m.ts and o.mr=m.mr and o.mc=m.mc"""
        found[f"og{k}"] = _cost_sql(method, f"(select ts, camera, rr as row, rc as col, gray from reg{k})")
        found[f"cl{k}"] = f"""
            select n.ts, n.mr, n.mc, (n.cst+o.cst)/2 as cost from reg{k} n
            join og{k} o on o.ts=n.ts and o.row=n.rr and o.col=n.rc where n.ok and n.old"""
        for name, sql in (("ends", "en"), ("reach", "rc"), ("path", "pt")):
            text = SEAM_VIEWS[name]
            for old, new in (("cells", "cl"), ("ends", "en"), ("reach", "rc"), ("path", "pt")):
                text = text.replace(f" {old} ", f" {new}{k} ")
            found[f"{sql}{k}"] = text
        found[f"ln{k}"] = f"""
            select c.ts, c.mr, coalesce(min(p.mc), min(c.mc-n.rc)) cut
            from cl{k} c join en{k} e on e.ts=c.ts and c.mc=e.l
            join reg{k} n on n.ts=c.ts and n.mr=c.mr and n.mc=c.mc
            left join pt{k} p on p.ts=c.ts and p.mr=c.mr
            where c.ts in (select ts from pt{k}) group by c.ts, c.mr
            union all
            select distinct n.ts, n.mr, (e.l+e.r)//2 from reg{k} n join en{k} e on e.ts=n.ts
            where n.ts not in (select ts from pt{k})"""
        found[f"st{k}"] = f"""
            select o.* from st{k - 1} o left join reg{k} n on n.ts=o.ts and n.mr=o.mr and n.mc=o.mc
            where n.ts is null
            union all
            select ts, mr, mc, case when u then b else ob end, case when u then g else og end,
                   case when u then r else orr end, case when u then camera else oc end
            from (select n.*, n.ok and (not n.old or coalesce(n.mc>=l.cut, false)) u
                  from reg{k} n left join ln{k} l on l.ts=n.ts and l.mr=n.mr)
            where u or old"""
    return found


# the suite has 16 cameras, so no ts has more images
_STEPS = 16


def _seam_sql(method: str = "gradient") -> str:
    return with_views("px mpx images", f"""
        select ts, cast(mr as int) mosaic_row, cast(mc as int) mosaic_col, b, g, r, camera from st{_STEPS}""",
        _seam_steps(_STEPS, method))


@query("S2_mosaic_seam", _seam_sql())
def mosaic_seam(spark, sf_dir):
    """Whole seam mosaic."""
    return seam.mosaic_seam(views.pixels(spark, sf_dir), views.images(spark, sf_dir))


@query("S2_mosaic_seam_tiles", _seam_sql())
def mosaic_seam_tiles(spark, sf_dir):
    """Whole seam mosaic with images and overlaps cut into many tiles."""
    return seam.mosaic_seam(views.pixels(spark, sf_dir), views.images(spark, sf_dir), size=SMALL_TILE)


@query("S2_mosaic_seam_variance", _seam_sql("variance"))
def mosaic_seam_variance(spark, sf_dir):
    """Seams through even areas."""
    return seam.mosaic_seam(views.pixels(spark, sf_dir), views.images(spark, sf_dir), "variance")


@query("S2_mosaic_seam_combined", _seam_sql("combined"))
def mosaic_seam_combined(spark, sf_dir):
    """Seams by the mean of both costs."""
    return seam.mosaic_seam(views.pixels(spark, sf_dir), views.images(spark, sf_dir), "combined")


def _seam_marks(steps: int) -> str:
    """Cells left of a cut that touch a cell right of it, over all steps."""
    sides = []
    for k in range(1, steps + 1):
        side = f"""(select n.ts, n.mr, n.mc, coalesce(n.mc>=l.cut, false) m
                    from reg{k} n left join ln{k} l on l.ts=n.ts and l.mr=n.mr)"""
        sides.append(f"""
            select p.ts, p.mr, p.mc from {side} p join {side} q
              on q.ts=p.ts and abs(q.mr-p.mr)<=1 and abs(q.mc-p.mc)<=1 where q.m and not p.m""")
    return " union ".join(sides)


@query("S5_seam_map", with_views("px mpx images", f"""
    select ts, cast(mr as int) mosaic_row, cast(mc as int) mosaic_col from ({_seam_marks(_STEPS)})""",
    _seam_steps(_STEPS)))
def seam_map(spark, sf_dir):
    """Seam boundaries of the whole seam mosaic."""
    return seam.mosaic_seam(views.pixels(spark, sf_dir), views.images(spark, sf_dir), seams=True)


@query("S5_mosaic_with_seams", with_views("px mpx images", f"""
    select s.ts, cast(s.mr as int) mosaic_row, cast(s.mc as int) mosaic_col, b, g, r, camera, m.ts is not null on_seam
    from st{_STEPS} s left join ({_seam_marks(_STEPS)}) m on m.ts=s.ts and m.mr=s.mr and m.mc=s.mc""", _seam_steps(_STEPS)))
def mosaic_with_seams(spark, sf_dir):
    """Mosaic and seam map from the same seams."""
    ortho = tiles.to_tiles(views.pixels(spark, sf_dir), SUITE_TILE)
    found = seam.Seams(ortho, views.images(spark, sf_dir), size=SUITE_TILE)
    marks = found.seam_map().withColumn("on_seam", F.lit(True))
    return found.mosaic_rows().join(marks, seam.CELL, "left").withColumn("on_seam", F.coalesce("on_seam", F.lit(False)))

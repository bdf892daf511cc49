"""The views of :mod:`orthoweave.suite.views` as DuckDB common table expressions."""

from __future__ import annotations

VIEWS = {
    "px": """
        select ts, camera, cast(i//8 as int) row, cast(i%8 as int) col, v b, (v*3)%256 g, (v*5)%256 r
        from (select cast(vec_id//16 as bigint) ts, cast(vec_id%16 as int) camera, i,
                     cast(greatest(0, least(255, floor((e+0.2)*510))) as int) v
              from (select vec_id, unnest(embedding)::double e,
                           generate_subscripts(embedding,1)-1 i from embeddings))""",
    "images": """
        select cast(vec_id//16 as bigint) ts, cast(vec_id%16 as int) camera,
               lpad(cast(vec_id%16 as varchar),2,'0')||'_ortho.tif' file, 8 width, 8 height,
               cast((vec_id%16)*1.25 as double) x_min, cast(10+((vec_id%16)%3)*0.25 as double) y_max,
               0.25::double pixel_width, (-0.25)::double pixel_height
        from embeddings""",
    "segs": """
        select event_id, camera, start_time, end_time,
               '/v/dac'||cast(1+camera//8 as varchar)||'/N910A6_ch'||cast(1+user_id%8 as varchar)||'_main_'
               ||strftime(start_time,'%Y%m%d%H%M%S')
               ||case when event_id%11=0 then '' else '_'||strftime(end_time,'%Y%m%d%H%M%S') end
               ||case when event_id%7=0 then '(1)' else '' end||'.dav' path
        from (select event_id, user_id, cast(user_id%16 as int) camera, date_trunc('second',ts) start_time,
                     date_trunc('second',ts)+to_minutes(cast(floor(value) as bigint)) end_time from events)""",
    "grid": """
        select g ts from (select unnest(generate_series(date_trunc('hour',min(ts)),
               date_trunc('hour',max(ts)), interval 1 hour)) g from events)""",
    "gcp": """
        select p_partkey pid, cast(p_partkey%16 as int) camera,
               (-(p_partkey%16) + (p_partkey%37)/8.0)::double X,
               ((p_partkey%16)*3 + (p_partkey%29)/4.0)::double Y, (-8 + p_size/64.0)::double Z,
               (100+(p_partkey%37)*90+p_size)::double col_sample,
               (100+(p_partkey%29)*70)::double row_sample
        from part""",
    "picks": """
        select * from gcp union all
        select pid+1000000, camera, X, Y, Z, col_sample+7, row_sample+11 from gcp where pid%5=0""",
    "dem": """
        select cast(p_partkey//40 as int) row, cast(p_partkey%40 as int) col,
               case when p_size<>50 then (-8 + p_size/64.0)::double end z from part""",
    "calib": """
        select s_suppkey candidate, cast(s_suppkey%16 as int) camera,
               strftime(date '2025-10-01' + cast(s_suppkey//16 as int), '%Y%m%d') version,
               (1500+s_suppkey%50)::double f, 1920::double cx, 1080::double cy,
               (0.01::double*(s_suppkey%5)) k1, (-0.001::double*(s_suppkey%3)) k2,
               0.1::double rx, (0.02::double*(s_suppkey%3)) ry, 0::double rz,
               0::double tx, 0::double ty, 20::double tz,
               ((s_suppkey%9)*0.75)::double rms, 6+s_suppkey%20 n_gcps,
               case when s_suppkey>=16 then
                 strftime(date '2025-10-01' + cast(s_suppkey//16 as int), '%Y%m%d') end recalibration_date,
               3840 image_width, 2160 image_height
        from supplier""",
    "latest": """
        select * from calib qualify row_number() over
          (partition by camera order by version desc, candidate desc)=1""",
    "lmap": """
        select cast(p_partkey%16 as int) camera, cast(p_partkey//16//12 as int) row,
               cast((p_partkey//16)%12 as int) col,
               (-1.0::double + (p_partkey*7%41)*0.25::double + p_size/64.0::double)::float src_x,
               (-1.0::double + (p_partkey*3%37)*0.25::double + p_size/128.0::double)::float src_y
        from part""",
    "status": """
        select (['extract','ortho','mosaic'])[1+event_id%3] stage, event_id//48 ts,
               cast(user_id%16 as int) camera, event_type<>'error' success,
               case when event_type='error' then props end error
        from events""",
    # placement of every image in the mosaic of its ts
    "mgrid": """
        select ts, x_min, x_max, y_min, y_max, res,
               trunc((x_max-x_min)/res)::int width, trunc((y_max-y_min)/abs(res))::int height
        from (select ts, min(x_min) x_min, max(x_min+width*pixel_width) x_max,
                     min(y_max+height*pixel_height) y_min, max(y_max) y_max,
                     arg_min(pixel_width, file) res from images group by ts)""",
    "placed": """
        select i.ts, i.camera, i.file, i.x_min, row_number() over (partition by i.ts order by file) pos,
               greatest(0,ro) row_start, greatest(0,co) col_start,
               greatest(0,-ro) src_row, greatest(0,-co) src_col,
               least(gh, ro+i.height)-greatest(0,ro) rh, least(gw, co+i.width)-greatest(0,co) rw
        from (select images.*, g.width gw, g.height gh,
                     trunc((g.y_max-images.y_max)/abs(g.res))::int ro,
                     trunc((images.x_min-g.x_min)/g.res)::int co
              from images join mgrid g using (ts)) i""",
    "mpx": """
        select p.ts, p.camera, p.b, p.g, p.r, l.pos, p.row-l.src_row rr, p.col-l.src_col rc,
               p.row-l.src_row+l.row_start mr, p.col-l.src_col+l.col_start mc, l.rh, l.rw
        from px p join placed l using (ts, camera)
        where p.row>=l.src_row and p.row-l.src_row<l.rh and p.col>=l.src_col and p.col-l.src_col<l.rw""",
    "prio": """
        select *, 1.0::double - sqrt((rc-rw/2.0::double)*(rc-rw/2.0::double)
                   + (rr-rh/2.0::double)*(rr-rh/2.0::double))
                   / sqrt((rw/2.0::double)*(rw/2.0::double)+(rh/2.0::double)*(rh/2.0::double)) priority
        from mpx""",
    # bilinear gather with weights in 1/32 pixel
    "taps": """
        select camera, row, col, iy+dy sr, ix+dx sc,
               (case when dy=1 then fy else 32-fy end)*(case when dx=1 then fx else 32-fx end) w
        from (select camera, row, col, cast(floor(sx/32.0) as bigint) ix, ((sx%32)+32)%32 fx,
                     cast(floor(sy/32.0) as bigint) iy, ((sy%32)+32)%32 fy
              from (select camera, row, col, cast(round_even(src_x::double*32,0) as bigint) sx,
                           cast(round_even(src_y::double*32,0) as bigint) sy from lmap)),
             (select unnest([0,1]) dy), (select unnest([0,1]) dx)""",
    "orthopx": """
        select i.ts, i.camera, t.row, t.col,
               cast((coalesce(sum(t.w*p.b),0)+512)//1024 as int) b,
               cast((coalesce(sum(t.w*p.g),0)+512)//1024 as int) g,
               cast((coalesce(sum(t.w*p.r),0)+512)//1024 as int) r
        from images i join taps t on i.camera=t.camera
        left join px p on p.ts=i.ts and p.camera=i.camera and p.row=t.sr and p.col=t.sc
        group by 1,2,3,4""",
    "ogrid": """
        select camera, n_gcps, x_min, y_max, 0.25::double pw, (-0.25)::double ph,
               trunc((x_max-x_min)/0.25)::int width, trunc((y_max-y_min)/0.25)::int height
        from (select camera, count(*) n_gcps, min(X)-0.5 x_min, max(X)+0.5 x_max,
                     min(Y)-0.5 y_min, max(Y)+0.5 y_max from gcp group by camera)""",
    "opx": """
        select camera, x_min, y_max, pw, ph, r.row::int as row, c.col::int as col
        from ogrid, lateral (select unnest(range(height)) as row) r,
             lateral (select unnest(range(width)) as col) c""",
    "demdims": "select max(p_partkey)//40+1 nrow, 40 ncol from part",
    "demraw": """
        select o.camera, o.row, o.col, o.x_min, o.y_max, o.pw, o.ph,
               (case when sum(case when d.z is not null then t.w end) > 1e-6
                then sum(t.w*d.z)/sum(case when d.z is not null then t.w end) end)::float z
        from (select camera, row, col, x_min, y_max, pw, ph, inside,
                     floor(rr-0.5) r0, floor(cc-0.5) c0,
                     rr-0.5-floor(rr-0.5) fr, cc-0.5-floor(cc-0.5) fc
              from (select q.*, rr>=0 and rr<nrow and cc>=0 and cc<ncol inside
                    from (select opx.*, (64.0-(y_max+(row+0.5)*ph))/1.0::double rr,
                                 ((x_min+(col+0.5)*pw)-(-16.0))/1.0::double cc from opx) q, demdims)) o
        cross join lateral (select unnest([0,0,1,1]) dr, unnest([0,1,0,1]) dc,
             unnest([(1-fr)*(1-fc),(1-fr)*fc,fr*(1-fc),fr*fc]) w) t
        left join dem d on o.inside and d.row=o.r0+t.dr and d.col=o.c0+t.dc
        group by all""",
    "demfill": """
        select camera, row, col, x_min, y_max, pw, ph,
               coalesce(z, (avg(z) over (partition by camera))::float) z from demraw""",
    "project": """
        select *, case when r2>1e-8 then th*(1+k1*th*th+k2*th*th*th*th)/r2 else 1 end sc
        from (select *, atan(r2) th from (select *, sqrt(a*a+b*b) r2 from (
          select *, pcx/nullif(pcz,0) a, pcy/nullif(pcz,0) b from (
            select *, m11*X+m12*Y+m13*Z+tx pcx, m21*X+m22*Y+m23*Z+ty pcy, m31*X+m32*Y+m33*Z+tz pcz
            from rot_points))))""",
}


# rotation of the camera record, to be joined with points
ROTATED = """
        select *, cs+(1-cs)*ux*ux m11, (1-cs)*ux*uy-sn*uz m12, (1-cs)*ux*uz+sn*uy m13,
               (1-cs)*ux*uy+sn*uz m21, cs+(1-cs)*uy*uy m22, (1-cs)*uy*uz-sn*ux m23,
               (1-cs)*ux*uz-sn*uy m31, (1-cs)*uy*uz+sn*ux m32, cs+(1-cs)*uz*uz m33
        from (select *, rx/th0 ux, ry/th0 uy, rz/th0 uz, cos(th0) cs, sin(th0) sn
              from (select *, sqrt(rx*rx+ry*ry+rz*rz) th0 from {calibrations}))"""

# views of the stepwise seam mosaic, each used several times by the next step
STEP_VIEWS = ("st", "reg", "og", "cl", "ln", "gcost")

# views each view needs, in order
NEEDS = {
    "picks": ["gcp"], "latest": ["calib"], "mgrid": ["images"], "placed": ["mgrid"],
    "mpx": ["px", "placed"], "prio": ["mpx"], "taps": ["lmap"], "orthopx": ["taps", "px", "images"],
    "ogrid": ["gcp"], "opx": ["ogrid"], "demraw": ["opx", "dem", "demdims"], "demfill": ["demraw"],
}


def _ordered(names: list[str], seen: list[str]) -> list[str]:
    for name in names:
        if name not in seen:
            _ordered(NEEDS.get(name, []), seen)
            seen.append(name)
    return seen


def with_views(names: str, query: str, extra: dict[str, str] | None = None) -> str:
    """The query behind the common table expressions it needs."""
    listed = [(n, VIEWS[n]) for n in _ordered(names.split(), [])]
    listed += list((extra or {}).items())
    ctes = ",\n".join(
        f"{n} as {'materialized ' if n.startswith(STEP_VIEWS) else ''}({sql})" for n, sql in listed)
    return f"with recursive {ctes}\n{query}"


def projected(points: str, calibrations: str) -> dict[str, str]:
    """Extra views that project ``points`` (columns X, Y, Z, camera) through ``calibrations``."""
    return {
        "rot": ROTATED.format(calibrations=calibrations),
        "rot_points": f"select * from ({points}) pts join rot using (camera)",
        "project": VIEWS["project"],
    }


def _newton_steps(source: str, steps: int = 10) -> str:
    """Nested selects that refine the angle t of the distorted angle td."""
    for _ in range(steps):
        source = f"""select * replace (t-(t*(1+k1*t*t+k2*t*t*t*t)-td)/(1+3*k1*t*t+5*k2*t*t*t*t) as t)
                     from ({source})"""
    return source


def undistorted(records: str) -> dict[str, str]:
    """View ``umap``: the undistorted 8 x 8 view of camera records with focal length 6 + candidate % 3."""
    edges = _newton_steps(f"""
        select *, least(sqrt(a*a+b*b), pi()/2) td, least(sqrt(a*a+b*b), pi()/2) t from (
          select camera, f, k1, k2, (u-4.0::double)/f a, (v-4.0::double)/f b
          from (select camera, (6+candidate%3)::double f, k1, k2, unnest([4.0,8.0,4.0,0.0])::double u,
                       unnest([0.0,4.0,8.0,4.0])::double v from ({records})))""")
    return {
        "uedges": f"select camera, f, k1, k2, a*tan(t)/td x, b*tan(t)/td y from ({edges})",
        "uview": """
            select camera, f, k1, k2, fo, -mx*fo+4.0::double cx, -my*fo+4.0::double cy from (
              select *, greatest(4.0::double/(mx-lx), 4.0::double/(hx-mx), 4.0::double/(my-ly),
                                 4.0::double/(hy-my)) fo
              from (select camera, f, k1, k2, sum(x)/4 mx, sum(y)/4 my, min(x) lx, max(x) hx, min(y) ly,
                           max(y) hy from uedges group by 1,2,3,4))""",
        "umap": """
            select camera, row, col, (a*sc*f+4.0::double)::float src_x, (b*sc*f+4.0::double)::float src_y from (
              select *, case when rr>1e-8 then th*(1+k1*th*th+k2*th*th*th*th)/rr else 1 end sc
              from (select *, atan(rr) th from (select *, sqrt(a*a+b*b) rr from (
                select camera, f, k1, k2, row::int as row, col::int as col, (col-cx)/fo a, (row-cy)/fo b
                from uview, (select unnest(range(8)) as row), (select unnest(range(8)) as col)))))""",
    }

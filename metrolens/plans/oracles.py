"""DuckDB SQL equivalents of the registered queries (same column names).

The views ``region nation customer supplier part orders lineitem events
...`` are registered by the checker. Each statement re-derives the same
reference-shaped rows as ``synthetic.py`` and computes the result directly
(plain range join, plain aggregates) so it is an independent oracle.
"""

from __future__ import annotations

_SEGMENTS = """
  select s_suppkey as id, s_name as geom, cast(s_nationkey as varchar) as lab,
         cast(s_suppkey % 40 as int) as r_lo, cast(s_suppkey % 40 + 6 as int) as r_hi,
         cast(s_suppkey % 40 + 4 as int) as l_lo, cast(s_suppkey % 40 + 10 as int) as l_hi
  from supplier"""

_RANGE = "((t.hn between g.r_lo and g.r_hi) or (t.hn between g.l_lo and g.l_hi))"

_BIKES = """
  select o_orderkey as trip_id, o_orderdate + to_hours(cast(o_orderkey % 24 as bigint)) as st,
         cast(floor(o_totalprice / 1000.0) - 5 as int) as duration, cast(o_custkey as int) as start_id,
         cast(o_orderkey % 500 as int) as end_id,
         case when o_orderstatus = 'P' then '' else o_orderpriority end as end_name
  from orders"""
_BIKE_OK = "duration > 0 and start_id > 0 and end_id > 0 and end_name is not null and trim(end_name) <> ''"
_SEASON = """case when month(st) in (12, 1, 2) then 'winter' when month(st) in (3, 4, 5) then 'spring'
                  when month(st) in (6, 7, 8) then 'summer' when month(st) in (9, 10, 11) then 'fall' end"""

_TAXI = """
  select l_orderkey, l_linenumber,
         40.6::double + l_discount * 3.0::double as plat, -74.05::double + l_tax * 3.75::double as plon,
         40.6::double + l_linenumber::double / 25.0::double as dlat,
         -74.05::double + l_quantity / 200.0::double as dlon,
         l_extendedprice / 1500.0::double as fare
  from lineitem"""
_IN_BOX = """plon < -73.75 and plon > -74.05 and dlon < -73.75 and dlon > -74.05
         and plat < 40.9 and plat > 40.6 and dlat < 40.9 and dlat > 40.6"""
_DIST = "sqrt((plat - dlat) * (plat - dlat) + (plon - dlon) * (plon - dlon))"

ORACLES: dict[str, str] = {
    "tickets_per_segment": f"""
with g as ({_SEGMENTS}),
t as (select cast(l_partkey % 25 as varchar) as st, cast(trunc(l_quantity) as int) as hn from lineitem)
select cast(g.id as int) as physical_id, g.geom as the_geom, count(*) as tickets
from g join t on g.lab = t.st and {_RANGE}
group by g.id, g.geom""",

    "tickets_per_segment_day": f"""
with g as ({_SEGMENTS}),
t as (select cast(l_partkey % 25 as varchar) as st, cast(trunc(l_quantity) as int) as hn,
             cast(isodow(l_shipdate) as int) as day_of_week from lineitem)
select cast(g.id as int) as physical_id, g.geom as the_geom, t.day_of_week, count(*) as tickets
from g join t on g.lab = t.st and {_RANGE}
group by g.id, g.geom, t.day_of_week""",

    "tickets_per_segment_hour": f"""
with g as ({_SEGMENTS}),
t as (select cast(user_id % 25 as varchar) as st, cast(floor(value) as int) as hn,
             cast(case when hour(ts) % 12 = 0 then 12 else hour(ts) % 12 end as int) as hour12,
             case when hour(ts) < 12 then 'A' else 'P' end as ampm
      from events)
select cast(g.id as int) as physical_id, g.geom as the_geom, t.hour12, t.ampm, count(*) as tickets
from g join t on g.lab = t.st and {_RANGE}
group by g.id, g.geom, t.hour12, t.ampm""",

    "tickets_by_hour": """
select cast(hour(ts) as int) as hour, count(*) as tickets
from events group by 1 order by 1""",

    "tickets_by_weekday": """
select cast(isodow(o_orderdate) as int) as day_of_week, count(*) as tickets
from orders group by 1 order by 1""",

    "meters_near_point": """
with m as (
  select cast(s_suppkey as varchar) as meter_no,
         cast(cast(round(s_acctbal * 100) as bigint) as varchar) as xs,
         cast(s_nationkey as varchar) as ys
  from supplier where s_nationkey <> 0),
mb as (select distinct meter_no, xs, ys from m
       where abs(cast(xs as double) - 500000.0) <= 200000.0 and abs(cast(ys as double) - 12.0) <= 200000.0),
t as (select cast(l_suppkey as varchar) as meter_no from lineitem where l_returnflag = 'R' and l_quantity > 49.5)
select mb.meter_no, count(t.meter_no) as tickets, 12.0::double as center_lat, 500000.0::double as center_long,
       mb.xs || ',' || mb.ys as lat_lon_text
from mb left join t on mb.meter_no = t.meter_no
group by mb.meter_no, mb.xs, mb.ys""",

    "wkt_points": """
select cast(s_suppkey as varchar) as meter_no,
       case when s_nationkey = 0 then null else cast(cast(round(s_acctbal * 100) as bigint) as double) end as x,
       case when s_nationkey = 0 then null else cast(s_nationkey as double) end as y
from supplier""",

    "monthly_trips": """
select cast(year(l_shipdate) as int) as year, cast(month(l_shipdate) as int) as month,
       round(avg(l_quantity), 6) as avg_distance, count(*) as trips
from lineitem group by 1, 2""",

    "midnight_trips": """
select event_id, ts as tpep_pickup_datetime, value / 5000.0::double - 74.0::double as pickup_longitude,
       user_id::double / 1000.0::double + 40.6::double as pickup_latitude
from events where hour(ts) < 1""",

    "bbox_trips": f"""
with d as (select *, {_DIST} as distance from ({_TAXI})
           where plat <> 0 and plon <> 0 and dlat <> 0 and dlon <> 0 and {_IN_BOX})
select l_orderkey, l_linenumber, round(fare, 6) as fare_amount, round(distance, 9) as distance
from d where fare > 0 and fare < 60 and distance < 0.21 and distance > 0""",

    "plot_window": f"""
with d as (select *, {_DIST} as distance from ({_TAXI}) where {_IN_BOX})
select l_orderkey, l_linenumber, round(fare, 6) as fare_amount, round(distance, 9) as distance
from d where distance between 0 and 0.22 and fare between 0 and 60""",

    "geocode_join": """
select c_custkey as trip_id, c_mktsegment as routes, n_name as address,
       40.0::double + n_nationkey::double / 2.0::double as latitude,
       -74.0::double + n_regionkey::double / 10.0::double as longtitude
from customer join nation on 'NATION_' || cast(c_nationkey as varchar) = n_name
where 40.0::double + n_nationkey::double / 2.0::double < 50.0""",

    "bike_clean": f"""
select trip_id, duration, start_id, end_id, end_name, cast(month(st) as int) as month,
       cast(year(st) as int) as year, cast(hour(st) as int) as start_hour
from ({_BIKES}) where {_BIKE_OK}""",

    "season_split": f"""
select {_SEASON} as season, count(*) as rides from ({_BIKES}) where {_BIKE_OK} group by 1""",

    "time_of_day_split": f"""
select case when hour(st) < 10 then 'morning' when hour(st) > 17 then 'evening' else 'midday' end as time_of_day,
       count(*) as rides
from ({_BIKES}) where {_BIKE_OK} group by 1""",

    "partitioned_csv": f"""
select {_SEASON} as season, count(*) as rides, cast(sum(duration) as bigint) as total_duration
from ({_BIKES}) where {_BIKE_OK} group by 1""",
}


# ---------------------------------------------------------------- map maths in SQL

_ONE_MINUS = "(1.0::double - 1e-5::double)"


def _mx(lon: str) -> str:
    return f"(256.0::double * (0.5::double + ({lon}) / 360.0::double))"


def _my(lat: str) -> str:
    s = f"least(greatest(sin(({lat}) * (pi() / 180.0::double)), -{_ONE_MINUS}), {_ONE_MINUS})"
    return f"(256.0::double * (0.5::double - ln((1.0::double + {s}) / (1.0::double - {s})) / (4.0::double * pi())))"


def _frame(pts: str) -> str:
    """CTEs b, a, f: bounds, centre, zoom and centre pixel of the points CTE ``pts`` (lat, lon)."""
    return f"""
b as (select min(lat) as lat_min, max(lat) as lat_max, min(lon) as lon_min, max(lon) as lon_max from {pts}),
a as (select *, (lat_max + lat_min) / 2 as clat, (lon_max + lon_min) / 2 as clon,
             greatest(abs({_mx('lon_max')} - {_mx('lon_min')}) * 2.0::double,
                      abs({_my('lat_max')} - {_my('lat_min')})) as amp from b),
f as (select *, case when amp is null or isnan(amp) or amp = 0 then 10
                     else cast(trunc(log2(1280.0::double / amp)) as int) end as zoom,
             {_mx('clon')} as cx, {_my('clat')} as cy from a)"""


def _tile(lon: str, lat: str) -> tuple[str, str]:
    x = f"(2.0::double * (({_mx(lon)} - cx) * pow(2.0::double, zoom) + 320.0::double))"
    y = f"(2.0::double * (({_my(lat)} - cy) * pow(2.0::double, zoom) + 320.0::double))"
    return x, y


_MAP_PTS = """pts as (select event_id as point_id, user_id::double / 1000.0::double + 40.6::double as lat,
                      value / 5000.0::double - 74.0::double as lon from events)"""
_TX, _TY = _tile("lon", "lat")
_PIXELS = f"""{_MAP_PTS}, {_frame('pts')},
px as (select point_id, {_TX} as x, {_TY} as y from pts, f)"""
_K = "(127.0::double / 1280.0::double)"
_CELLS = f"""cells as (
  select iy, ix, cast(count(*) as double) as z from (
    select cast(trunc(y * {_K}) as bigint) + 1 as iy, cast(trunc(x * {_K}) as bigint) + 1 as ix from px)
  where ix >= 0 and ix < 130 and iy >= 0 and iy < 130 group by 1, 2)"""

_HIST = """
with p as (select l_extendedprice as x, l_quantity as y from lineitem),
r as (select min(x) as x0, max(x) as x1, min(y) as y0, max(y) as y1 from p),
r2 as (select case when x0 = x1 then x0 - 0.5 else x0 end as x0, case when x0 = x1 then x1 + 0.5 else x1 end as x1,
              case when y0 = y1 then y0 - 0.5 else y0 end as y0, case when y0 = y1 then y1 + 0.5 else y1 end as y1 from r),
s as (select x0, y0, (x1 - x0) / 64 as sx, (y1 - y0) / 64 as sy from r2),
f as (select x, y, x0, y0, sx, sy, floor((x - x0) / sx) as fx, floor((y - y0) / sy) as fy from p, s),
g as (select x0, y0, sx, sy,
        cast(least(greatest(case when x < x0 + fx * sx then fx - 1 when x >= x0 + (fx + 1) * sx then fx + 1 else fx end, 0), 63) as int) as x_bin,
        cast(least(greatest(case when y < y0 + fy * sy then fy - 1 when y >= y0 + (fy + 1) * sy then fy + 1 else fy end, 0), 63) as int) as y_bin
      from f)
select x_bin, y_bin, min(x0) + x_bin * min(sx) as x_lo, min(y0) + y_bin * min(sy) as y_lo, count(*) as count
from g group by x_bin, y_bin"""

_LINE_PTS = """lp as (select l_orderkey as line_id, l_linenumber as seq,
                    40.5::double + l_quantity / 100.0::double as lat, -74.0::double + l_discount as lon from lineitem)"""
_LX, _LY = _tile("lon", "lat")

_SCATTER_PTS = """pts as (
  select event_id as point_id, user_id::double / 1000.0::double + 40.6::double as lat,
         value / 5000.0::double - 74.0::double as lon, cast(event_id % 20 as int)::double / 20.0::double as color,
         false as is_center from events
  union all
  select null, 40.7::double, -73.95::double, 0.0::double, true)"""

ORACLES.update({
    "mercator_pixels": f"""
select event_id, round({_mx('value - 245.0::double')}, 6) as x_pixel,
       round({_my('user_id::double - 75.0::double')}, 6) as y_pixel
from events""",

    "tile_pixels": f"""
with {_PIXELS}
select point_id, round(x, 6) as x_pixel, round(y, 6) as y_pixel, zoom from px, f""",

    "auto_zoom": f"""
with {_MAP_PTS}, {_frame('pts')}
select round(lat_min, 6) as lat_min, round(lat_max, 6) as lat_max, round(lon_min, 6) as lon_min,
       round(lon_max, 6) as lon_max, round(clat, 6) as center_lat, round(clon, 6) as center_long, zoom from f""",

    "scatter_points": f"""
with {_SCATTER_PTS}, {_frame('pts')}
select point_id, round({_TX}, 6) as x_pixel, round({_TY}, 6) as y_pixel, round(color, 6) as color, is_center, zoom
from pts, f""",

    "histogram_2d": _HIST,

    "density_grid": f"""
with {_PIXELS}, {_CELLS}
select cast(iy as int) as iy, cast(ix as int) as ix, z from cells""",

    "density_smooth": f"""
with {_PIXELS}, {_CELLS},
k0 as (select range as j, exp(-0.5::double / 1.0::double * cast(range * range as double)) as phi from range(-4, 5)),
k as (select j, phi / (select sum(phi) from k0) as w from k0),
ey as (select ix, unnest([iy, -1 - iy, 2 * 130 - 1 - iy]) as e, z from cells),
py as (select ix, e - j as iy, sum(z * w) as z from ey, k where e - j between 0 and 129 group by 1, 2),
ex as (select iy, unnest([ix, -1 - ix, 2 * 130 - 1 - ix]) as e, z from py),
pxx as (select iy, e - j as ix, sum(z * w) as z from ex, k where e - j between 0 and 129 group by 1, 2)
select cast(iy - 1 as int) as iy, cast(ix - 1 as int) as ix, round(z, 6) as z
from pxx where z > 0.002 and iy between 1 and 128 and ix between 1 and 128""",

    "line_overlay": f"""
with {_LINE_PTS}, {_frame('lp')},
px as (select line_id, seq, {_LX} as x, {_LY} as y from lp, f)
select line_id, cast(count(*) as int) as n_points,
       round(first(x order by seq, x, y), 6) as first_x, round(first(y order by seq, x, y), 6) as first_y,
       round(last(x order by seq, x, y), 6) as last_x, round(last(y order by seq, x, y), 6) as last_y
from px group by line_id""",

    "cluster_ranks": """
select cluster, cast(row_number() over (order by cluster desc) - 1 as int) as color_rank
from (select distinct l_suppkey % 7 as cluster from lineitem)""",

    "street_points": """
select l_orderkey * 100 + l_linenumber as feature_id, 0 as point_index,
       round(-74.0::double + l_discount, 6) as x, round(40.5::double + l_quantity / 100.0::double, 6) as y
from lineitem
union all
select l_orderkey * 100 + l_linenumber, 1,
       round(-74.0::double + l_tax, 6), round(40.5::double + l_linenumber::double / 100.0::double, 6)
from lineitem""",

    "fare_distance_fit": f"""
with d0 as (select *, {_DIST} as distance from ({_TAXI})
            where plat <> 0 and plon <> 0 and dlat <> 0 and dlon <> 0 and {_IN_BOX}),
d as (select fare, distance from d0 where fare > 0 and fare < 60 and distance < 0.21 and distance > 0),
f as (select regr_slope(fare, distance) as b, regr_intercept(fare, distance) as a, avg(fare) as m from d)
select round(min(b), 4) as slope, round(min(a), 4) as intercept,
       round(sqrt(avg((fare - (a + b * distance)) * (fare - (a + b * distance)))), 6) as rmse,
       round(avg((a + b * distance - m) * (a + b * distance - m)), 6) as explained_variance,
       count(*) as n
from d, f""",

    "marker_check": """
with p as (
  select event_id as point_id,
         case when event_type = 'error' then 'NaN'::double else user_id::double / 1000.0::double + 40.6::double end as lat,
         case when event_type = 'signup' then null else value / 5000.0::double - 74.0::double end as lon
  from events),
dr as (select cast(count(*) filter (where lat is null or lon is null or isnan(lat) or isnan(lon)) as bigint) as dropped from p)
select point_id, round(lat, 6) as latitude, round(lon, 6) as longitude, dropped
from p, dr where lat is not null and lon is not null and not isnan(lat) and not isnan(lon)""",
})

ORACLES.update({
    "csv_roundtrip": """
select cast(year(l_shipdate) as int) as year, cast(month(l_shipdate) as int) as month,
       round(avg(l_quantity), 6) as avg_distance, count(*) as trips, count(*) as trips_from_header_file
from lineitem group by 1, 2""",
})

ORACLES["stream_tickets_by_hour"] = ORACLES["tickets_by_hour"]


def _chain_sql(points: str) -> str:
    """Monotone-chain half hull of an (x, y)-sorted point list: popping while the turn is not
    to the left keeps exactly the prefix up to the last left turn, found with list_filter."""
    cross = ("(acc[i].x - acc[i - 1].x) * (q.y - acc[i - 1].y) "
             "- (acc[i].y - acc[i - 1].y) * (q.x - acc[i - 1].x) > 0")
    keep = f"coalesce(list_max(list_filter(range(2, len(acc) + 1), lambda i: {cross})), 1)"
    return (f"list_reduce({points}, lambda acc, q: list_concat(acc[1:{keep}], [q]), "
            f"[]::STRUCT(x DOUBLE, y DOUBLE)[])")


def _hulls_sql(cluster: str) -> str:
    return f"""
with p as (select {cluster} as cluster, l_extendedprice / 1000.0::double as x,
                  l_quantity + l_discount * 10.0::double as y from lineitem),
n as (select cluster, count(*) as n_points from p group by cluster),
s as (select cluster, list({{'x': x, 'y': y}} order by x, y) as pts
      from (select distinct cluster, x, y from p) group by cluster),
c as (select cluster, {_chain_sql('pts')} as lower, {_chain_sql('list_reverse(pts)')} as upper from s),
h as (select cluster, list_concat(lower[1:len(lower) - 1], upper[1:len(upper) - 1]) as hull from c)
select cluster, cast(i as int) as vertex, pt.x as x, pt.y as y, n_points
from (select h.cluster, unnest(hull) as pt, unnest(range(len(hull))) as i, n.n_points
      from h join n on h.cluster = n.cluster
      where len(hull) >= 3 and n.n_points >= 3)"""


ORACLES["cluster_hulls"] = _hulls_sql("l_suppkey % 7")
ORACLES["cluster_hulls_many"] = _hulls_sql("l_partkey")

ORACLES["line_points"] = f"""
with {_LINE_PTS}, {_frame('lp')},
px as (select line_id, seq, {_LX} as x, {_LY} as y from lp, f),
r as (select *, row_number() over (partition by line_id order by seq, x, y) - 1 as pos from px)
select line_id, pos // 3 as chunk, cast(pos % 3 as int) as place, seq, round(x, 6) as x, round(y, 6) as y from r"""

ORACLES["density_values"] = f"""
with {_PIXELS},
cells as (
  select iy, ix, cast(sum(cast(e.value as decimal(28, 6))) as double) as z from (
    select point_id, cast(trunc(y * {_K}) as bigint) + 1 as iy, cast(trunc(x * {_K}) as bigint) + 1 as ix from px) c
  join events e on e.event_id = c.point_id
  where ix >= 0 and ix < 130 and iy >= 0 and iy < 130 group by 1, 2)
select cast(iy as int) as iy, cast(ix as int) as ix, z from cells"""

ORACLES["bike_rejects"] = f"""
select case when duration <= 0 then 'duration' when trip_id % 11 = 0 then 'start time' when start_id <= 0 then 'start station'
            when end_id <= 0 then 'end station' when trim(end_name) = '' then 'end name' else 'kept' end as reason, count(*) as rows
from ({_BIKES}) group by 1"""

ORACLES["fit_rejects"] = """
select case when l_orderkey % 7 = 0 then 'unusable fare_amount' when l_linenumber = 4 then 'unusable distance' else 'kept' end as reason,
       count(*) as rows
from lineitem group by 1"""


# ---------------------------------------------------------------- fits in SQL


def _share(seed: int) -> str:
    return f"(cast('0x' || substr(md5('{seed}|' || l_orderkey || '|' || l_linenumber), 1, 8) as bigint) / 4294967296.0::double)"


def _det(m: list[list[str]]) -> str:
    """Determinant by the first row's minors."""
    if len(m) == 1:
        return m[0][0]
    terms = [f"{'-' if j % 2 else '+'} {m[0][j]} * ({_det([row[:j] + row[j + 1:] for row in m[1:]])})" for j in range(len(m))]
    return " ".join(terms)


def _fit_sql(ctes: str, features: list[str], intercept: bool) -> str:
    """Least squares by the normal equations (Cramer's rule) on the training rows of CTE ``d`` (y, features, share)."""
    f = [*features, "1.0::double"] if intercept else features
    n = range(len(f))
    sums = ", ".join([f"sum({f[i]} * {f[j]}) as s{i}{j}" for i in n for j in n] + [f"sum({f[i]} * y) as t{i}" for i in n])
    m = [[f"s{i}{j}" for j in n] for i in n]
    solved = ", ".join(f"({_det([[f't{i}' if j == c else m[i][j] for j in n] for i in n])}) / ({_det(m)}) as b{c}" for c in n)
    fitted = " + ".join(f"b{i} * {f[i]}" for i in n)
    metrics = lambda p, c: (f"round(sqrt(avg((y - p) * (y - p)) filter ({c})), 6) as {p}_rmse, "  # noqa: E731
                            f"round(var_pop(p) filter ({c}) + pow(avg(p) filter ({c}) - avg(y) filter ({c}), 2), 6) as {p}_explained_variance, "
                            f"count(*) filter ({c}) as {p}_n")
    names = [f"round(min(b{i}), 5) as {'intercept' if intercept and i == len(features) else f'coefficient_{i}'}" for i in n]
    return f"""
with {ctes},
g as (select {sums} from d where share < 0.8),
b as (select {solved} from g),
q as (select d.*, b.*, {fitted} as p from d, b)
select {', '.join(names)}, {metrics('train', 'share < 0.8')}, {metrics('test', 'share >= 0.8')} from q"""


def _distance_rows(sample: str = "") -> str:
    return f"""d as (select fare as y, distance as x, {_share(7)} as share
            from (select *, {_DIST} as distance from ({_TAXI}) where {_IN_BOX})
            where fare > 0 and fare < 60 and distance < 0.21 and distance > 0 {sample})"""


def _cuts(rows: str, col: str, buckets: int) -> str:
    """The distinct values of rank ceil(i * n / buckets), as a list."""
    return (f"(select list(distinct v) from (select {col} as v, row_number() over (order by {col}) as r, count(*) over () as n from {rows}) "
            f"where exists (select 1 from range(1, {buckets}) t(i) where r = (i * n + {buckets - 1}) // {buckets}))")


def _kmeans(p: str, rows: str, x: str, y: str, k: int, rounds: int = 10) -> str:
    """CTEs {p}0 .. {p}rounds (i, cx, cy) of the centres in millionths, and {p}n (i, rows) of the last round."""
    whole = lambda c: f"cast(floor({c} * 1000000.0::double + 0.5) as bigint)"
    away = "(px::double - cx) * (px::double - cx) + (py::double - cy) * (py::double - cy)"
    out = [f"{p}d as materialized (select {whole(x)} as px, {whole(y)} as py, count(*) as n from {rows} group by 1, 2)",
           f"{p}0 as materialized (select cast(row_number() over (order by md5('1|' || px || '|' || py), px, py) - 1 as int) as i, "
           f"px::double as cx, py::double as cy from {p}d qualify i < {k})"]
    for t in range(rounds):
        out.append(f"{p}a{t} as materialized (select px, py, n, i from {p}d, {p}{t} qualify row_number() over (partition by px, py order by {away}, i) = 1)")
        out.append(f"{p}{t + 1} as materialized (select c.i, coalesce(sx, cx) as cx, coalesce(sy, cy) as cy from {p}{t} c left join "
                   f"(select i, cast(sum(px * n) as double) / sum(n) as sx, cast(sum(py * n) as double) / sum(n) as sy from {p}a{t} group by i) s on s.i = c.i)")
    out.append(f"{p}n as (select c.i, cast(coalesce(sum(a.n), 0) as bigint) as rows from {p}{rounds} c left join {p}a{rounds - 1} a on a.i = c.i group by c.i)")
    scaled = "cx / 1000000.0::double * 1000000.0::double as cx, cy / 1000000.0::double * 1000000.0::double as cy"
    out.append(f"{p}f as materialized (select px, py, i from {p}d, (select i, {scaled} from {p}{rounds}) c "
               f"qualify row_number() over (partition by px, py order by {away}, i) = 1)")
    return ",\n".join(out)


_PICKUPS = """e as (select event_id, user_id::double / 1000.0::double + 40.6::double as lat,
                   value / 5000.0::double - 74.0::double as lon from events)"""
_BUCKETED = ", ".join(f"cast(len([c for c in {b} if c <= {c}]) as double) as f{i}"
                      for i, (b, c) in enumerate(zip(("c0", "c1", "c2", "c3"), ("plat", "plon", "dlat", "dlon"))))
_FIXED = "cast(floor({} * 1000000.0::double + 0.5) as bigint)"

ORACLES |= {
    "fare_regression_distance": _fit_sql(_distance_rows(), ["x"], True),
    "fare_regression_sample": _fit_sql(_distance_rows(f"and {_share(7)} < 0.5"), ["x"], True),
    "fare_regression_buckets": _fit_sql(f"""r as materialized (select * from ({_TAXI}) where {_IN_BOX}),
k as (select {', '.join(f"{_cuts('r', c, 100)} as c{i}" for i, c in enumerate(('plat', 'plon', 'dlat', 'dlon')))}),
d as materialized (select fare as y, {_share(7)} as share, {_BUCKETED} from r, k)""", ["f0", "f1", "f2", "f3"], False),
    "fare_regression_clusters": _fit_sql(f"""r as materialized (select * from ({_TAXI}) where plat <> 0 and plon <> 0 and dlat <> 0 and dlon <> 0),
{_kmeans('u', 'r', 'plat', 'plon', 20)},
{_kmeans('v', 'r', 'dlat', 'dlon', 5)},
d as materialized (select fare as y, {_share(7)} as share, uf.i::double as f0, vf.i::double as f1
      from r join uf on uf.px = {_FIXED.format('plat')} and uf.py = {_FIXED.format('plon')}
             join vf on vf.px = {_FIXED.format('dlat')} and vf.py = {_FIXED.format('dlon')})""", ["f0", "f1"], False),
    "pickup_clusters": f"""
with {_PICKUPS}, {_kmeans('u', 'e', 'lat', 'lon', 20)}
select event_id, lat as pickup_latitude, lon as pickup_longitude, i as predction_pickup
from e join uf on px = {_FIXED.format('lat')} and py = {_FIXED.format('lon')}""",
    "pickup_centres": f"""
with {_PICKUPS}, {_kmeans('u', 'e', 'lat', 'lon', 20)}
select c.i as cluster, round(cx / 1000000.0::double, 6) as pickup_latitude, round(cy / 1000000.0::double, 6) as pickup_longitude, rows
from u10 c join un on un.i = c.i""",
    "quantile_buckets": f"""
with k as (select {_cuts('lineitem', 'l_extendedprice', 10)} as c)
select cast(len([x for x in c if x <= l_extendedprice]) as double) as l_extendedprice_bucket, count(*) as rows,
       min(l_extendedprice) as lo, max(l_extendedprice) as hi
from lineitem, k group by 1""",
}

ORACLES["street_collection"] = ORACLES["street_points"]
ORACLES["meters_mixed_headers"] = """
select cast(s_suppkey as varchar) as meter_no,
       'POINT (' || cast(cast(round(s_acctbal * 100) as bigint) as varchar) || case when s_nationkey = 0 then '' else ' ' || cast(s_nationkey as varchar) end || ')' as wkt,
       case when s_suppkey % 2 = 1 then 'p' || cast(s_suppkey as varchar) end as pole
from supplier"""

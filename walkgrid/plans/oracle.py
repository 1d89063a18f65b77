"""ANSI SQL for every registered query, written independently of the Spark plans.

Everything is brute force over the whole tables: all pairs for nearest neighbours, all edges for point in polygon,
no bins, no tiles, no shortcuts.
"""

from __future__ import annotations

import math

from walkgrid.constants import (
    CATEGORIES, CATEGORY_LABELS, COLOR_STOPS, DEFAULT_WEIGHTS, EARTH_RADIUS_M, EDGE_M, MAX_RING, POI_TAGS, SCORE_KNOTS,
    UNKNOWN_MUNICIPALITY,
)
from walkgrid.functions.geo import M_PER_DEG
from walkgrid.functions.grid import DEFAULT_GRID, SQRT3
from walkgrid.functions.projection import system
from walkgrid.plans.personal import SPEED
from walkgrid.plans.queries import ANCHORS, CHOSEN, CUSTOM_WEIGHTS, PROJECTED

LAT0, LNG0, MX = DEFAULT_GRID.lat0, DEFAULT_GRID.lng0, DEFAULT_GRID.m_per_deg_lng
VALUES = ("livability", *[f"score_{c}" for c in CATEGORIES])


def num(x: float) -> str:
    """A DOUBLE literal."""
    return f"cast('{float(x)!r}' as double)"


REACH = num((MAX_RING * 3**0.5 + 2) * EDGE_M[10])


def axial(source: str, lng: str, lat: str, res: int, q: str = "q", r: str = "r") -> str:
    """``source`` plus the cell of (lng, lat) as ``q``, ``r``."""
    e = num(EDGE_M[res])
    return f"""(
      select * exclude (x_, y_, qf_, rf_, q0_, r0_, s0_, dq_, dr_, ds_),
        cast(case when dq_ > dr_ and dq_ > ds_ then -r0_ - s0_ else q0_ end as integer) as {q},
        cast(case when not (dq_ > dr_ and dq_ > ds_) and dr_ > ds_ then -q0_ - s0_ else r0_ end as integer) as {r}
      from (select *, abs(q0_ - qf_) as dq_, abs(r0_ - rf_) as dr_, abs(s0_ - (-qf_ - rf_)) as ds_
      from (select *, floor(qf_ + 0.5e0) as q0_, floor(rf_ + 0.5e0) as r0_, floor(-qf_ - rf_ + 0.5e0) as s0_
      from (select *, (x_ * {num(SQRT3 / 3)} - y_ / 3) / {e} as qf_, (y_ * {num(2.0 / 3)}) / {e} as rf_
      from (select *, ({lng} - {num(LNG0)}) * {num(MX)} as x_, ({lat} - {num(LAT0)}) * {num(M_PER_DEG)} as y_
      from {source})))))"""


def center_lng(q: str, r: str, res: int) -> str:
    return f"(({q} + {r} / 2e0) * {num(SQRT3 * EDGE_M[res])} / {num(MX)} + {num(LNG0)})"


def center_lat(r: str, res: int) -> str:
    return f"({r} * {num(1.5 * EDGE_M[res])} / {num(M_PER_DEG)} + {num(LAT0)})"


def parent(source: str, res: int, coarse: int, q: str, r: str) -> str:
    return axial(source, center_lng("q", "r", res), center_lat("r", res), coarse, q, r)


def cell(res: int = 10, q: str = "q", r: str = "r") -> str:
    return f"concat('{res}:', cast({q} as varchar), ':', cast({r} as varchar))"


def metres(lng1: str, lat1: str, lng2: str, lat2: str) -> str:
    return f"""({num(2 * EARTH_RADIUS_M)} * asin(sqrt(
      pow(sin((radians({lat2}) - radians({lat1})) / 2), 2)
      + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lng2}) - radians({lng1})) / 2), 2))))"""


def score(d: str) -> str:
    (d0, s0), (d1, s1), (d2, s2) = SCORE_KNOTS
    return f"""case when {d} is null or {d} > {d2} then 0e0 when {d} <= {d0} then {num(s0)}
      when {d} <= {d1} then {num(s0)} + ({d} - {num(d0)}) / {num(d1 - d0)} * {num(s1 - s0)}
      else {num(s1)} + ({d} - {num(d1)}) / {num(d2 - d1)} * {num(s2 - s1)} end"""


def color(expr: str) -> str:
    """Ramp colour of an already clamped score."""
    channels = []
    for i in (1, 2, 3):
        arms = " ".join(
            f"when {expr} <= {num(b[0])} then floor(({expr} - {num(a[0])}) / {num(b[0] - a[0])} * ({b[i] - a[i]}) + {a[i]} + 0.5e0)"
            for a, b in zip(COLOR_STOPS, COLOR_STOPS[1:])
        )
        channels.append(f"cast(cast(case {arms} end as integer) as varchar)")
    return "concat('rgb(', " + ", ',', ".join(channels) + ", ')')"


def each(template: str, sep: str = ", ") -> str:
    return sep.join(template.format(c=c) for c in CATEGORIES)


def rounds(names, digits: int = 4) -> str:
    return ", ".join(f"round({n}, {digits}) as {n}" for n in names)


def quoted(names) -> str:
    return ", ".join(f"'{n}'" for n in names)


# --- fixtures -------------------------------------------------------------------------------------------------------

AMENITY_POINT = """45.45e0 + ((p_partkey * 15485863) % 9973) / 9973e0 * 0.10e0 as lat,
  -73.70e0 + ((p_partkey * 32452843) % 9967) / 9967e0 * 0.15e0 as"""

FX_ADDRESS = """fx_address as (select c_custkey as id, c_nationkey as nk,
  case when c_custkey % 97 = 96 then null else 45.45e0 + ((c_custkey * 7919) % 10007) / 10007e0 * 0.10e0 end as lat,
  case when c_custkey % 97 = 96 then null else -73.70e0 + ((c_custkey * 104729) % 10009) / 10009e0 * 0.15e0 end as lng
  from customer)"""

FX_AMENITY = f"""fx_amenity as (select p_partkey as pid,
  case p_partkey % 6 when 0 then 'grocery' when 1 then 'school' when 2 then 'health'
    when 3 then 'transit' when 4 then 'park' else 'bike' end as category, {AMENITY_POINT} lng from part)"""

FX_ELEMENT = """fx_element as (select case p_partkey % 3 when 0 then 'node' when 1 then 'way' else 'relation' end as type,
  p_partkey as id,
  case p_partkey % 16 when 0 then 'supermarket' when 1 then 'convenience' when 2 then 'greengrocer' when 3 then 'bakery'
    when 4 then 'butcher' when 5 then 'school' when 6 then 'college' when 7 then 'university' when 8 then 'kindergarten'
    when 9 then 'clinic' when 10 then 'hospital' when 11 then 'pharmacy' when 12 then 'doctors' when 13 then 'dentist'
    when 14 then 'bench' else 'fuel' end as value,
  case when p_partkey % 16 < 5 then 'shop' else 'amenity' end as tag_key,
  case when c.copy = 1 then concat(p_name, ' bis') else p_name end as name,
  case when p_partkey % 41 = 0 then null else 45.45e0 + ((p_partkey * 15485863) % 9973) / 9973e0 * 0.10e0 end as lat,
  case when p_partkey % 41 = 0 then null else -73.70e0 + ((p_partkey * 32452843) % 9967) / 9967e0 * 0.15e0 end as lng,
  c.copy
  from part cross join (select 0 as copy union all select 1) c
  where c.copy = 0 or p_partkey % 10 = 0)"""


def _categories() -> str:
    arms = []
    for category, groups in POI_TAGS.items():
        for key, values in groups.items():
            arms.append(f"when tag_key = '{key}' and value in ({quoted(values)}) then '{category}'")
    return "case " + " ".join(arms) + " end"


POI = f"""{FX_ELEMENT},
  poi as (select type as osm_type, id as osm_id, name, value as fclass, lng, lat, category from (
    select *, {_categories()} as category, row_number() over (partition by type, id order by copy) as rn
    from fx_element where lat is not null and {_categories()} is not null) where rn = 1)"""

FX_STOP = f"""fx_stop as (select concat('S', cast(p_partkey as varchar)) as stop_id, {AMENITY_POINT} lng from part)"""

FX_PATH = """fx_path as (select s_suppkey as path_id, i.i,
  45.46e0 + ((s_suppkey * 7919) % 997) / 997e0 * 0.08e0 + i.i * ((s_suppkey * 31) % 7 - 3) * 0.0009e0 as lat,
  -73.69e0 + ((s_suppkey * 104729) % 991) / 991e0 * 0.13e0 + i.i * ((s_suppkey * 17) % 7 - 3) * 0.0012e0 as lng
  from supplier cross join (select 0 as i union all select 1 union all select 2 union all select 3 union all select 4) i)"""

FX_PARK = """fx_park as (select s_suppkey as park_id, v.i,
  45.46e0 + ((s_suppkey * 613) % 997) / 997e0 * 0.08e0 + v.dy * 0.0005e0 * (1 + s_suppkey % 3) as lat,
  -73.69e0 + ((s_suppkey * 1409) % 991) / 991e0 * 0.13e0 + v.dx * 0.0005e0 * (1 + s_suppkey % 3) as lng
  from supplier cross join (select 0 as i, 0 as dx, 0 as dy union all select 1, 2, 0 union all select 2, 2, 1
    union all select 3, 1, 1 union all select 4, 1, 2 union all select 5, 0, 2) v)"""

FX_MUNICIPALITY = """fx_municipality as (select n_name as municipality,
  case when n_nationkey % 4 = 0 then 'ville' else 'arrondissement' end as type, v.i,
  -73.68e0 + (n_nationkey % 5) * 0.022e0 + v.dx + 0.2e0 * (cast(floor(n_nationkey / 5) as int) * 0.016e0 + v.dy) as lng,
  45.46e0 + cast(floor(n_nationkey / 5) as int) * 0.016e0 + v.dy as lat
  from nation cross join (select 0 as i, 0e0 as dx, 0e0 as dy union all select 1, 0.022e0, 0e0
    union all select 2, 0.022e0, 0.016e0 union all select 3, 0e0, 0.016e0) v)"""

FX_ZONE = """fx_zone as (select concat('zone ', r_name) as name, v.i,
  -90e0 + r_regionkey * 3.1e0 + v.dx * (1e0 - r_regionkey * 0.15e0) as lng,
  33e0 + r_regionkey * 2.3e0 + v.dy * (1e0 - r_regionkey * 0.15e0) as lat
  from region cross join (select 0 as i, 0 as dx, 0 as dy union all select 1, 20, 0 union all select 2, 20, 8
    union all select 3, 9, 8 union all select 4, 9, 20 union all select 5, 0, 20) v)"""

FX_SITE = """fx_site as (select p_partkey as id,
  case when p_partkey % 3 <> 0 then 45.45e0 + ((p_partkey * 15485863) % 9973) / 9973e0 * 0.10e0
    else 31e0 + ((p_partkey * 7919) % 10007) / 10007e0 * 26e0 end as lat,
  case when p_partkey % 3 <> 0 then -73.70e0 + ((p_partkey * 32452843) % 9967) / 9967e0 * 0.15e0
    else -92e0 + ((p_partkey * 104729) % 10009) / 10009e0 * 30e0 end as lng from part)"""

FX_VERDICT = """fx_verdict as (select event_id, event_type as asset, user_id % 10 as shard, ts as run_ts,
  case event_id % 4 when 0 then 'schema_contract' when 1 then 'row_uniqueness'
    when 2 then 'field_completeness' else 'value_range' end as check_name,
  event_id % 7 <> 0 as passed, case when event_id % 4 = 2 then 'WARN' else 'ERROR' end as severity from events),
  latest as (select * exclude (rn) from (select *, row_number() over (
    partition by asset, check_name, shard order by run_ts desc, event_id desc) as rn from fx_verdict) where rn = 1)"""

FX_LEDGER = """fx_ledger as (select concat('T', cast(o_custkey % 6 as varchar)) as asset, o_custkey % 27 as shard,
  o_orderdate as run_ts, o_orderkey as version,
  case when o_orderkey % 5 = 0 then '0.1.0' else '0.2.0' end as code_version, o_orderkey % 50 as input_version from orders)"""

FX_DIRTY = """fx_dirty as (select l_orderkey as k, l_linenumber as ln,
  case when l_linenumber = 7 then null else l_quantity * 2.5e0 - 5e0 end as score from lineitem)"""

# --- shared steps ---------------------------------------------------------------------------------------------------

CELLED = f"""celled as (select * from {axial("fx_address", "lng", "lat", 10)}),
  cells as (select distinct q, r from celled where q is not null)"""

DIST = f"""{FX_ADDRESS}, {FX_AMENITY},
  pairs as (select a.id, b.category, min({metres("a.lng", "a.lat", "b.lng", "b.lat")}) as d
    from fx_address a cross join fx_amenity b where a.lat is not null group by a.id, b.category),
  dist as (select a.id, a.lat, a.lng, {each("max(case when p.category = '{c}' and p.d <= " + REACH + " then p.d end) as dist_{c}")}
    from fx_address a left join pairs p on a.id = p.id group by a.id, a.lat, a.lng)"""



def _moved(source: str, key: str) -> str:
    """A fixture's positions, even ids around the 180th meridian and odd ids around the pole."""
    name = source.split(" ")[0]
    return f"""{source.replace(name, "raw_" + name)}, {name} as (select * replace (
      case when {key} % 2 = 1 then 90e0 - (lat - 45.45e0) else lat end as lat,
      case when {key} % 2 = 1 then (lng + 73.70e0) * 2400e0 - 180e0 when lng + 73.625e0 + 180e0 > 180e0 then lng + 73.625e0 + 180e0 - 360e0
        else lng + 73.625e0 + 180e0 end as lng) from raw_{name})"""


EDGE_DIST = DIST.replace(FX_ADDRESS, _moved(FX_ADDRESS, "id")).replace(FX_AMENITY, _moved(FX_AMENITY, "pid"))

EDGES = f"""{FX_MUNICIPALITY},
  edges as (select a.municipality, a.lng as x1, a.lat as y1, b.lng as x2, b.lat as y2
    from fx_municipality a join fx_municipality b on a.municipality = b.municipality and b.i = (a.i + 1) % 4
    where a.lat <> b.lat),
  centers as (select q, r, {center_lng("q", "r", 10)} as px, {center_lat("r", 10)} as py from cells),
  inside as (select q, r, municipality from centers cross join edges
    group by q, r, municipality
    having sum(case when (y1 > py) <> (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1 then 1 else 0 end) % 2 = 1),
  tagged as (select c.q, c.r, coalesce(min(i.municipality), '{UNKNOWN_MUNICIPALITY}') as municipality
    from cells c left join inside i on c.q = i.q and c.r = i.r group by c.q, c.r)"""

CELL_SCORES = f"""{DIST},
  scored as (select id, lat, lng, {", ".join(f"{score(f'dist_{c}')} as score_{c}" for c in CATEGORIES)} from dist),
  celled as (select * from {axial("scored", "lng", "lat", 10)}),
  cells as (select distinct q, r from celled where q is not null),
  per_cell as (select q, r, count(*) as n_addresses, {each("avg(score_{c}) as score_{c}")}
    from celled where q is not null group by q, r)"""


def _liv(weights: dict[str, float]) -> str:
    total = " + ".join(f"score_{c} * {num(weights[c])}" for c in CATEGORIES)
    return f"""{CELL_SCORES}, {EDGES},
  liv as (select p.*, t.municipality, ({total}) / {num(sum(weights.values()))} as livability
    from per_cell p join tagged t on p.q = t.q and p.r = t.r)"""


LIV = _liv(DEFAULT_WEIGHTS)

WEIGHTED = f"cast(sum(n_addresses) as bigint) as addresses, " + ", ".join(
    f"sum({v} * n_addresses) / sum(n_addresses) as {v}" for v in VALUES
)

HEXES = f"""{LIV},
  parented as (select * from {parent("liv", 10, 9, "pq", "pr")}),
  modes as (select pq, pr, municipality from (select pq, pr, municipality, row_number() over (
    partition by pq, pr order by count(*) desc, municipality) as rn from parented group by pq, pr, municipality) where rn = 1),
  hexes as (select p.pq, p.pr, {WEIGHTED} from parented p group by p.pq, p.pr),
  hexed as (select h.*, m.municipality from hexes h join modes m on h.pq = m.pq and h.pr = m.pr)"""

MUNI = f"""{LIV}, muni as (select municipality, {WEIGHTED} from liv
  where municipality <> '{UNKNOWN_MUNICIPALITY}' group by municipality),
  ranked as (select *, row_number() over (order by livability desc, municipality) as rank from muni)"""

TRACE = f"""{FX_PATH},
  vertices as (select path_id, i, q, r from {axial("fx_path", "lng", "lat", 10)}),
  segments as (select a.path_id, a.q as q1, a.r as r1, b.q as q2, b.r as r2,
      greatest(abs(b.q - a.q), abs(b.r - a.r), abs(b.q - a.q + b.r - a.r)) as n
    from vertices a join vertices b on a.path_id = b.path_id and b.i = a.i + 1),
  steps as (select *, unnest(range(0, n + 1)) as t from segments),
  fractions as (select path_id, q1 + (q2 - q1) * (t / cast(greatest(n, 1) as double)) as qf,
      r1 + (r2 - r1) * (t / cast(greatest(n, 1) as double)) as rf from steps),
  walked as (select path_id, qf, rf, floor(qf + 0.5e0) as q0, floor(rf + 0.5e0) as r0, floor(-qf - rf + 0.5e0) as s0
    from fractions),
  off as (select *, abs(q0 - qf) as dq, abs(r0 - rf) as dr, abs(s0 - (-qf - rf)) as ds from walked),
  traced as (select distinct path_id,
      cast(case when dq > dr and dq > ds then -r0 - s0 else q0 end as integer) as q,
      cast(case when not (dq > dr and dq > ds) and dr > ds then -q0 - s0 else r0 end as integer) as r from off)"""

PARK_POINT = f"""{FX_PARK},
  heights as (select park_id, (min(lat) + max(lat)) / 2 as mid from fx_park group by park_id),
  scans as (select p.park_id, (min(case when lat > mid then lat end) + max(case when lat <= mid then lat end)) / 2 as scan
    from fx_park p join heights h on p.park_id = h.park_id group by p.park_id),
  hits as (select a.park_id, s.scan, (b.lng - a.lng) * (s.scan - a.lat) / (b.lat - a.lat) + a.lng as x
    from fx_park a join fx_park b on a.park_id = b.park_id and b.i = (a.i + 1) % 6
    join scans s on a.park_id = s.park_id where (a.lat > s.scan) <> (b.lat > s.scan)),
  numbered as (select *, row_number() over (partition by park_id order by x) as n from hits),
  spans as (select a.park_id, a.scan as lat, (a.x + b.x) / 2 as lng,
      row_number() over (partition by a.park_id order by b.x - a.x desc, a.x) as best
    from numbered a join numbered b on a.park_id = b.park_id and b.n = a.n + 1 where a.n % 2 = 1),
  park_points as (select park_id, lng, lat from spans where best = 1),
  park_cells as (select * from {axial("park_points", "lng", "lat", 10)})"""

def by_region(sql: str) -> str:
    """The query ``sql`` over either half of the addresses and amenities, the second half in a region elsewhere with its own
    reference point; ``region`` and the rows of both."""
    out = []
    for side in (0, 1):
        lat0, lng0 = 45.5 + side * 14.75, -73.6 + side * 98.5
        own = sql.replace(num(MX), num(M_PER_DEG * math.cos(math.radians(lat0)))).replace(num(LAT0), num(lat0)).replace(num(LNG0), num(lng0))
        for fixture, key in ((FX_ADDRESS, "id"), (FX_AMENITY, "pid"), (FX_MUNICIPALITY, None)):
            name = fixture.split(" ")[0]
            rows = f"where {key} % 2 = {side}" if key else ""
            own = own.replace(fixture, fixture.replace(name, f"raw_{name}", 1) + f""", {name} as (select * replace (
              lat + {num(side * 14.75)} as lat, lng + {num(side * 98.5)} as lng) from raw_{name} {rows})""")
        out.append(f"select (select r_name from region where r_regionkey = {side}) as region, * from ({own})")
    return " union all ".join(out)


OUTLINE = ", ".join(f"({i})" for i in range(6))


def corners(source: str, res: int) -> str:
    """Corner points ``lng``, ``lat``, ``corner`` of the cells ``q``, ``r`` in ``source``."""
    e = num(EDGE_M[res])
    return f"""(select *, {center_lng("q", "r", res)} + {e} * cos(radians(60 * corner - 30)) / {num(MX)} as lng,
      {center_lat("r", res)} + {e} * sin(radians(60 * corner - 30)) / {num(M_PER_DEG)} as lat
      from {source} cross join (values {OUTLINE}) v(corner))"""


FIRST_RING = f"""{FX_ADDRESS}, {FX_AMENITY}, {CELLED},
  shops as (select * from {axial("fx_amenity", "lng", "lat", 10, "sq", "sr")}),
  shop_cells as (select distinct category, sq, sr from shops),
  rings as (select q, r, category, min(greatest(abs(sq - q), abs(sr - r), abs(sq - q + sr - r))) as k
    from cells cross join shop_cells group by q, r, category),
  found as (select a.id, s.category, min({metres("a.lng", "a.lat", "s.lng", "s.lat")}) as d
    from celled a join rings g on a.q = g.q and a.r = g.r
    join shops s on s.category = g.category and greatest(abs(s.sq - a.q), abs(s.sr - a.r), abs(s.sq - a.q + s.sr - a.r)) = g.k
    where g.k <= 10 group by a.id, s.category)"""

def projected(source: str, srid: int) -> str:
    """``source`` plus ``x``, ``y`` in a transverse Mercator system, by the power series in the difference of longitude."""
    tm = system(srid)
    a, f = tm.ellipsoid[0], 1 / tm.ellipsoid[1]
    n, e2 = f / (2 - f), f * (2 - f)
    arc = (
        f"({num(a / (1 + n) * (1 + n**2 / 4 + n**4 / 64))} * p - {num(a / (1 + n) * 1.5 * (n - n**3 / 8))} * sin(2 * p)"
        f" + {num(a / (1 + n) * 15 / 16 * (n**2 - n**4 / 4))} * sin(4 * p) - {num(a / (1 + n) * 35 / 48 * n**3)} * sin(6 * p)"
        f" + {num(a / (1 + n) * 315 / 512 * n**4)} * sin(8 * p))"
    )
    return f"""(select * exclude (p, w, s2, nu, psi, t, c), {num(tm.easting)} + {num(tm.scale)} * nu * w * c * (1 + w * w * c * c / 6 * (psi - t * t)
        + pow(w * c, 4) / 120 * (4 * pow(psi, 3) * (1 - 6 * t * t) + psi * psi * (1 + 8 * t * t) - psi * 2 * t * t + pow(t, 4))
        + pow(w * c, 6) / 5040 * (61 - 479 * t * t + 179 * pow(t, 4) - pow(t, 6))) as x,
      {num(tm.northing)} + {num(tm.scale)} * ({arc} + nu * sin(p) * c * w * w / 2 * (1 + w * w * c * c / 12 * (4 * psi * psi + psi - t * t)
        + pow(w * c, 4) / 360 * (8 * pow(psi, 4) * (11 - 24 * t * t) - 28 * pow(psi, 3) * (1 - 6 * t * t) + psi * psi * (1 - 32 * t * t)
          - psi * 2 * t * t + pow(t, 4))
        + pow(w * c, 6) / 20160 * (1385 - 3111 * t * t + 543 * pow(t, 4) - pow(t, 6)))) as y
      from (select *, {num(a)} / sqrt(1 - {num(e2)} * s2) as nu, (1 - {num(e2)} * s2) / {num(1 - e2)} as psi, tan(p) as t, cos(p) as c
      from (select *, radians(lat) as p, radians(lng - {num(tm.meridian)}) as w, pow(sin(radians(lat)), 2) as s2 from {source})))"""


_clamped = "greatest(0e0, least(100e0, c_acctbal / 80e0))"
_custom = {c: DEFAULT_WEIGHTS[c] for c in CATEGORIES if c in CHOSEN}
_anchor_minutes = {
    a.name: f"({metres(center_lng('q', 'r', 10), center_lat('r', 10), num(a.lng), num(a.lat))} / {num(SPEED[a.mode])})"
    for a in ANCHORS
}


def _time_score(m: str) -> str:
    return f"case when {m} <= 15 then 100e0 when {m} <= 30 then 100e0 + ({m} - 15) / 15 * -50 else 0e0 end"


_personal = " + ".join(["livability", *[f"{_time_score(f'm_{a.name}')} * {num(a.weight)}" for a in ANCHORS]])
_why = " || ".join(
    ["'livability ' || printf('%.1f', livability)"]
    + [f"'; {a.name} ' || printf('%.1f', m_{a.name}) || ' min {a.mode}'" for a in ANCHORS]
)

_dirty_shards = f"""{FX_DIRTY}, keyed as (select *, k % 27 as s from fx_dirty),
  dup as (select s, cast(sum(n - 1) as bigint) as duplicate_rows from
    (select s, k, ln, count(*) as n from keyed group by s, k, ln) group by s),
  fig as (select s, count(*) as n, count(*) filter (where k is null or score is null) as bad,
    count(*) filter (where score is null) as nulls, count(*) filter (where score < 0) as below,
    count(*) filter (where score > 100) as above from keyed group by s)"""

ORACLE: dict[str, str] = {
    "cell_index": f"with {FX_ADDRESS}, {CELLED} select id, case when q is not null then {cell()} end as cell from celled",
    "cell_parent": f"""with {FX_ADDRESS}, {CELLED}, p9 as (select * from {parent("cells", 10, 9, "q9", "r9")}),
      p6 as (select * from {parent("p9", 10, 6, "q6", "r6")})
      select {cell()} as cell, {cell(9, "q9", "r9")} as parent_r9, {cell(6, "q6", "r6")} as parent_r6 from p6""",
    "cell_center": f"""with {FX_ADDRESS}, {CELLED} select {cell()} as cell, round({center_lat("r", 10)}, 6) as lat,
      round({center_lng("q", "r", 10)}, 6) as lng from cells""",
    "cell_outline": f"""with {FX_ADDRESS}, {CELLED} select {cell()} as cell, cast(corner as integer) as corner,
      round(lng, 6) as lng, round(lat, 6) as lat from {corners("cells", 10)}""",
    "ring_cells": f"""with {FX_ADDRESS}, {CELLED}, steps as (select cast(d as integer) as d from range(-10, 11) t(d)),
      disk as (select a.d as dq, b.d as dr, greatest(abs(a.d), abs(b.d), abs(a.d + b.d)) as k from steps a cross join steps b)
      select {cell()} as cell, cast(k as integer) as k, count(*) as n_cells,
        cast(sum((q + dq) * 1009 + r + dr) as bigint) as checksum,
        cast(sum(cast(q + dq as bigint) * (r + dr)) as bigint) as product_sum
      from cells cross join disk where k <= 10 group by q, r, k""",
    "line_trace": f"with {TRACE} select path_id, {cell()} as cell from traced",
    "line_cells": f"""with {TRACE}, c as (select distinct q, r from traced) select {cell()} as cell_r10,
      round({center_lat("r", 10)}, 6) as lat, round({center_lng("q", "r", 10)}, 6) as lng from c""",
    "polygon_point": f"""with {PARK_POINT} select park_id, round(lng, 6) as lng, round(lat, 6) as lat, {cell()} as cell
      from park_cells""",
    "mercator_to_wgs84": f"with {FX_ADDRESS} select id, round(lng, 6) as lng, round(lat, 6) as lat from fx_address",
    "projected_to_wgs84": f"""with {FX_ADDRESS}, landed as ({" union all ".join(f"select *, {srid} as srid from " + projected(f"(select * from fx_address where id % 2 = {k})", srid) for k, srid in enumerate(PROJECTED))})
      select id, cast(srid as integer) as srid, round(x, 2) as x, round(y, 2) as y, round(lng, 6) as lng, round(lat, 6) as lat from landed""",
    "haversine_pairs": f"""with {FX_ADDRESS}, {FX_AMENITY}
      select b.pid as id, round({metres("a.lng", "a.lat", "b.lng", "b.lat")}, 2) as metres
      from fx_amenity b join fx_address a on a.id = (b.pid - 1) % (select max(id) from fx_address) + 1""",
    "nearest_edges": f"with {EDGE_DIST} select id, {rounds([f'dist_{c}' for c in CATEGORIES], 2)} from dist",
    "nearest_exact": f"with {DIST} select id, {rounds([f'dist_{c}' for c in CATEGORIES], 2)} from dist",
    "nearest_first_ring": f"""with {FIRST_RING} select a.id,
      {each("round(max(case when f.category = '{c}' then f.d end), 2) as dist_{c}")}
      from fx_address a left join found f on a.id = f.id group by a.id""",
    "distance_profile": f"""with {DIST}, long as ({each("select '{c}' as category, dist_{c} as d from dist where lat is not null", " union all ")})
      select category, count(d) as resolved, count(*) as total, round(median(floor(d * 100 + 0.5e0)) / 100, 3) as median_m
      from long group by category""",
    "profile_after_move": f"""with {DIST}, long as ({each("select '{c}' as category, id, dist_{c} as d from dist where lat is not null", " union all ")})
      select category, count(d) as resolved, count(*) as total, round(avg(case when id % 27 = 3 then d * 2 + 5 else d end), 2) as mean_m,
        true as median_within_error from long group by category""",
    "distance_scores": f"with {CELL_SCORES} select id, {rounds([f'score_{c}' for c in CATEGORIES])} from scored",
    "cell_scores": f"""with {CELL_SCORES} select {cell()} as cell, n_addresses, {rounds([f'score_{c}' for c in CATEGORIES])}
      from per_cell""",
    "livability": f"with {LIV} select {cell()} as cell, n_addresses, municipality, {rounds(VALUES)} from liv",
    "livability_custom_weights": f"""with {_liv({**DEFAULT_WEIGHTS, **CUSTOM_WEIGHTS})}
      select {cell()} as cell, municipality, round(livability, 4) as livability from liv""",
    "custom_blends": f"""with {LIV} select {cell()} as cell,
      round(({" + ".join(f"score_{c} * {num(w)}" for c, w in _custom.items())}) / {num(sum(_custom.values()))}, 4) as blend
      from liv""",
    "score_colors": f"select c_custkey as id, {color(_clamped)} as color from customer",
    "region_cells": f"""select concat(region, '/', cell) as cell, concat(region, '/', parent_r9) as parent_r9,
        concat(region, '/', parent_r6) as parent_r6, lng, lat, corner_lng, corner_lat
      from ({by_region(f"""with {FX_ADDRESS}, {CELLED}, p9 as (select * from {parent("cells", 10, 9, "q9", "r9")}),
        p6 as (select * from {parent("p9", 10, 6, "q6", "r6")})
        select {cell()} as cell, {cell(9, "q9", "r9")} as parent_r9, {cell(6, "q6", "r6")} as parent_r6,
          round({center_lng("q", "r", 10)}, 6) as lng, round({center_lat("r", 10)}, 6) as lat,
          round({center_lng("q", "r", 10)} + {num(EDGE_M[10])} * cos(radians(90)) / {num(MX)}, 6) as corner_lng,
          round({center_lat("r", 10)} + {num(EDGE_M[10])} * sin(radians(90)) / {num(M_PER_DEG)}, 6) as corner_lat from p6""")})""",
    "region_livability": f"""select region, concat(region, '/', cell) as cell, n_addresses, municipality, {", ".join(VALUES)}
      from ({by_region(f"with {LIV} select {cell()} as cell, n_addresses, municipality, {rounds(VALUES)} from liv")})""",
    "region_rollup": f"""select region, concat(region, '/', cell) as cell, addresses, {", ".join(VALUES)}, municipality
      from ({by_region(f"with {HEXES} select {cell(9, 'pq', 'pr')} as cell, addresses, {rounds(VALUES)}, municipality from hexed")})""",
    "score_profile": f"""with {LIV}, long as ({each("select '{c}' as category, score_{c} as s from liv", " union all ")})
      select category, count(*) filter (where s > 0) as cells_scored, count(*) as cells, round(avg(s), 4) as mean_score
      from long group by category""",
    "score_metadata": f"""with {LIV} select count(*) as num_cells, count(distinct municipality) as num_municipalities,
      round(avg(livability), 2) as mean_livability from liv""",
    "tag_municipality": f"with {FX_ADDRESS}, {CELLED}, {EDGES} select {cell()} as cell, municipality from tagged",
    "tag_zones": f"""with {FX_MUNICIPALITY}, {FX_ZONE}, {FX_SITE},
      vertices as (select municipality as name, 4 as n, i, lng, lat from fx_municipality union all select name, 6, i, lng, lat from fx_zone),
      edges as (select a.name, a.lng as x1, a.lat as y1, b.lng as x2, b.lat as y2
        from vertices a join vertices b on a.name = b.name and b.i = (a.i + 1) % a.n where a.lat <> b.lat),
      inside as (select s.id, e.name from fx_site s cross join edges e group by s.id, e.name
        having sum(case when (y1 > lat) <> (y2 > lat) and lng < (x2 - x1) * (lat - y1) / (y2 - y1) + x1 then 1 else 0 end) % 2 = 1)
      select s.id, min(i.name) as name from fx_site s left join inside i on s.id = i.id group by s.id""",
    "address_municipality": f"""with {FX_ADDRESS}, {CELLED}, {EDGES} select a.id, coalesce(t.municipality, '{UNKNOWN_MUNICIPALITY}') as municipality
      from celled a left join tagged t on a.q = t.q and a.r = t.r""",
    "hex_rollup": f"with {HEXES} select {cell(9, 'pq', 'pr')} as cell, addresses, {rounds(VALUES)}, municipality from hexed",
    "dominant_municipality": """select segment, municipality from (select c_mktsegment as segment, n_name as municipality,
      row_number() over (partition by c_mktsegment order by count(*) desc, n_name) as rn
      from customer join nation on c_nationkey = n_nationkey group by c_mktsegment, n_name) where rn = 1""",
    "municipality_table": f"with {MUNI} select municipality, addresses, {rounds(VALUES)} from muni",
    "municipality_ranking": f"""with {MUNI} select rank, municipality, lower(trim(municipality)) as municipality_key,
      format('{{:,}}', addresses) as addresses, round(livability, 1) as livability,
      {rounds([f'score_{c}' for c in CATEGORIES], 0)} from ranked""",
    "customer_ranks": """select c_custkey as id, 'thousands' as "by", row_number() over (order by floor(c_acctbal / 1000) desc, c_custkey) as rank
      from customer union all select c_custkey, 'zero', row_number() over (order by c_custkey) from customer""",
    "ranked_boundaries": f"""with {MUNI} select rank, lower(trim(m.municipality)) as municipality_key,
      round(f.lng, 6) as first_lng, round(f.lat, 6) as first_lat, cast(4 as bigint) as n_vertices
      from ranked m join fx_municipality f on f.municipality = m.municipality and f.i = 0""",
    "global_stats": f"""with {LIV} select cast(sum(n_addresses) as bigint) as addresses,
      (select count(*) from fx_amenity) as amenities,
      count(distinct case when municipality <> '{UNKNOWN_MUNICIPALITY}' then municipality end) as municipalities,
      round(avg(livability), 4) as mean_livability from liv""",
    "category_share": f"""with {FX_AMENITY},
      names as (select * from (values {", ".join(f"('{c}', '{CATEGORY_LABELS[c]}')" for c in CATEGORIES)}) v(category, label)),
      counts as (select n.category, n.label, count(a.pid) as count from names n left join fx_amenity a
        on a.category = n.category group by n.category, n.label)
      select category, label, count, round(100e0 * count / greatest((select sum(count) from counts), 1), 1) as share from counts""",
    "map_center": f"""with {FX_ADDRESS}, {CELLED}, p as (select distinct pq, pr from {parent("cells", 10, 9, "pq", "pr")})
      select round(avg({center_lat("pr", 9)}), 6) as lat, round(avg({center_lng("pq", "pr", 9)}), 6) as lng from p""",
    "poi_elements": f"""with {POI} select osm_type, osm_id, name, fclass, round(lng, 6) as lng, round(lat, 6) as lat, category
      from poi""",
    "poi_bbox": f"""with {POI} select fclass, count(*) as n, round(max(lat), 6) as max_lat from poi
      where lng >= -74.05e0 and lng <= -73.4e0 and lat >= 45.35e0 and lat <= 45.5e0 group by fclass""",
    "amenities_union": f"""with {POI}, {FX_STOP}, {PARK_POINT}, {TRACE},
      points as (select category, lng, lat from poi union all select 'transit', lng, lat from fx_stop
        union all select 'park', lng, lat from park_points),
      placed as (select * from {axial("points", "lng", "lat", 10)}),
      bikes as (select distinct q, r from traced)
      select category, {cell()} as cell_r10, round(lat, 6) as lat, round(lng, 6) as lng from placed
      union all select 'bike', {cell()}, round({center_lat("r", 10)}, 6), round({center_lng("q", "r", 10)}, 6) from bikes""",
    "boundary_types": f"""with {FX_MUNICIPALITY} select type, count(*) filter (where i = 0) as n,
      count(distinct municipality) as n_names from fx_municipality group by type""",
    "check_schema": f"""with {FX_DIRTY} select count(*) as total_rows, 'absent' as missing_columns, 'k=bigint' as wrong_type
      from fx_dirty""",
    "check_uniqueness": f"""with {FX_DIRTY} select cast(sum(n) as bigint) as total_rows,
      cast(sum(n - 1) as bigint) as duplicate_rows from (select k, ln, count(*) as n from fx_dirty group by k, ln)""",
    "check_completeness": f"""with {FX_DIRTY} select
      round(count(*) filter (where k is null) / cast(count(*) as double), 6) as ratio_k,
      round(count(*) filter (where score is null) / cast(count(*) as double), 6) as ratio_score from fx_dirty""",
    "check_range": f"""with {FX_DIRTY} select count(*) filter (where score < 0) as below_score,
      count(*) filter (where score > 100) as above_score, min(score) as min_score, max(score) as max_score from fx_dirty""",
    "check_bundle_by_shard": f"""with {_dirty_shards}
      select 'silver/dirty' as asset, cast(s as varchar) as shard, 'schema_contract' as check_name, true as passed,
        'ERROR' as severity, cast(null as bigint) as duplicate_rows, cast(null as bigint) as above,
        cast(null as double) as score_null_ratio from fig
      union all select 'silver/dirty', cast(s as varchar), 'row_uniqueness', duplicate_rows = 0, 'ERROR', duplicate_rows,
        null, null from dup
      union all select 'silver/dirty', cast(s as varchar), 'field_completeness', bad = 0, 'WARN', null, null,
        round(nulls / cast(n as double), 6) from fig
      union all select 'silver/dirty', cast(s as varchar), 'value_range', below + above = 0, 'ERROR', null,
        case when below + above > 0 then above end, null from fig""",
    "latest_verdicts": f"with {FX_VERDICT} select asset, check_name, shard, run_ts, event_id, passed, severity from latest",
    "verdict_tally": f"""with {FX_VERDICT}, t as (select count(*) filter (where passed) as ok,
      count(*) filter (where not passed and severity = 'WARN') as warn,
      count(*) filter (where not passed and severity <> 'WARN') as fail from latest)
      select ok, warn, fail, concat(ok, ' ok | ', warn, ' warn | ', fail, ' fail') as summary from t""",
    "error_failures": f"""with {FX_VERDICT} select asset, check_name, shard, event_id from latest
      where not passed and severity = 'ERROR'""",
    "quality_report": f"""with {FX_VERDICT}, t as (select concat(count(*) filter (where passed), ' ok | ',
        count(*) filter (where not passed and severity = 'WARN'), ' warn | ', count(*) filter (where not passed and severity <> 'WARN'), ' fail') as summary from latest)
      select 'r1' as run, asset, check_name, cast(shard as bigint) as shard, event_id, passed, not passed and severity <> 'WARN' as alert, summary
      from latest cross join t""",
    "run_ledger": """with t as (select * from (values ('transit_stops', ''), ('municipality_boundaries', ''),
        ('cell_transit_stops', 'transit_stops'), ('municipalities', 'municipality_boundaries')) v(asset, inputs)),
      sized as (select *, case when asset like '%stops' then (select count(*) from part) else (select count(*) from nation) end as n from t)
      select asset, false as hit, true as same_version, inputs, n as rows, cast(least(n, 5) as integer) as previewed,
        '3 ok | 0 warn | 0 fail' as verdicts from sized
      union all select asset, true, true, inputs, null, null, null from sized""",
    "run_report": """select asset, check_name, true as passed, case when check_name = 'field_completeness' then 'WARN' else 'ERROR' end as severity,
        true as reused_snapshot
      from (values ('bronze/transit_stops'), ('bronze/municipality_boundaries'), ('silver/cell_transit_stops'), ('silver/municipalities')) a(asset)
      cross join (values ('schema_contract'), ('row_uniqueness'), ('field_completeness')) c(check_name)""",
    "snapshot_preview": f"""with {FX_MUNICIPALITY}, v as (select distinct municipality as "NOM", type as "TYPE" from fx_municipality)
      select "NOM", "TYPE", true as no_rings, (select count(*) from v) as rows, true as stamp_read, true as in_time
      from v order by "NOM" limit 5""",
    "plain_pois": f"""with {POI} select category, count(*) as n, cast(0 as bigint) as named from poi group by category
      union all select 'park', count(*), cast(6 * count(*) as bigint) from supplier""",
    "session_options": f"""with {FX_AMENITY} select category, count(*) as n from fx_amenity where lat >= 45.5e0 group by category""",
    "sharded_versions": f"""with {FX_LEDGER} select asset, true as same_in_any_order, asset <> 'T3' as same_after_move,
      count(distinct shard) as n_shards from fx_ledger group by asset""",
    "reused_verdicts": f"""with {FX_VERDICT}, pairs as (select asset, shard from fx_verdict group by asset, shard
      having count(*) % 2 = 0)
      select l.asset, l.check_name, l.shard, l.passed, l.event_id, true as reused_snapshot
      from latest l join pairs p on l.asset = p.asset and l.shard = p.shard""",
    "stale_tables": f"""with {FX_LEDGER}, newest as (select asset, max(run_ts) as ts from fx_ledger group by asset),
      aged as (select asset, case when asset < 'T3' then 25 else 360 end as max_days,
        epoch_us(timestamp '2001-08-26 00:00:00') - epoch_us(ts) as us from newest)
      select asset, cast(max_days as integer) as max_days, cast(us // 86400000000 as bigint) as age_days,
        us > max_days * 86400000000 as stale from aged""",
    "changed_shards": f"""with {FX_LEDGER},
      last as (select * from (select *, row_number() over (partition by asset, shard order by run_ts desc, version desc) as rn
        from fx_ledger) where rn = 1),
      cur as (select asset, max(version) % 2 as v from fx_ledger group by asset),
      up as (select l.asset, l.shard, l.version, l.code_version, l.input_version % 2 as seen, c.v,
          c.asset is null as never
        from last l left join cur c on l.asset <> 'T5'
          and c.asset = concat('T', cast(cast(substr(l.asset, 2, 1) as integer) + 1 as varchar))),
      why as (select asset, shard, version, case when code_version <> '0.2.0' then 'built by other code'
          when never then 'an input was never built' when seen <> v then 'an input has another version' end as miss_reason from up)
      select asset, shard, version, miss_reason is null as hit, miss_reason from why
      union all select 'T6', shard, null, false, 'never built' from (select distinct shard from fx_ledger)""",
    "shard_reconcile": f"""with {FX_ADDRESS}, {FX_AMENITY},
      a10 as (select * from {axial("(select lat, lng from fx_address where lat is not null)", "lng", "lat", 10)}),
      b10 as (select * from {axial("(select lat, lng from fx_amenity)", "lng", "lat", 10)}),
      a6 as (select distinct {cell(6, "pq", "pr")} as shard from {parent("a10", 10, 6, "pq", "pr")}),
      b6 as (select distinct {cell(6, "pq", "pr")} as shard from {parent("b10", 10, 6, "pq", "pr")})
      select coalesce(a6.shard, b6.shard) as shard,
        case when b6.shard is null then 'add' when a6.shard is null then 'drop' else 'keep' end as action
      from a6 full join b6 on a6.shard = b6.shard""",
    "sql_fragment": f"""with {FX_AMENITY} select category, count(*) as n, round(min(lng), 6) as min_lng, true as no_value
      from fx_amenity where lat >= 45.5e0 and category <> 'bi''ke' group by category""",
    "snapshot_roundtrip": f"""with {FX_STOP} select stop_id, round(lat, 6) as lat, round(lng, 6) as lng,
      cast(2 as integer) as version from fx_stop""",
    "sharded_roundtrip": f"""with {FX_ADDRESS}, {CELLED},
      sharded as (select id, {cell(6, "pq", "pr")} as shard from {parent("(select * from celled where q is not null)", 10, 6, "pq", "pr")}),
      busiest as (select shard from sharded group by shard order by count(*) desc, shard limit 1)
      select id, shard, cast(case when shard = (select shard from busiest) then 2 else 1 end as integer) as version from sharded""",
    "one_shard": f"""with {FX_ADDRESS}, {CELLED},
      sharded as (select id, q, r, {cell(6, "pq", "pr")} as shard from {parent("(select * from celled where q is not null)", 10, 6, "pq", "pr")}),
      busiest as (select shard from sharded group by shard order by count(*) desc, shard limit 1)
      select id, {cell()} as cell_r10 from sharded where shard = (select shard from busiest)""",
    "snapshot_metadata": f"with {FX_STOP} select count(*) as rows, true as has_bytes, true as in_mb from fx_stop",
    "read_formats": f"""with {FX_STOP} select f.format, count(*) as n, count(distinct stop_id) as n_stops,
      round(sum(lat), 4) as sum_lat, round(sum(lng), 4) as sum_lng
      from fx_stop cross join (values ('pq'), ('csv'), ('json')) f(format) group by f.format""",
    "geojson_paths": f"""with {FX_PATH} select path_id as "ID_CYCL", cast(i as integer) as i, round(lng, 6) as lng,
      round(lat, 6) as lat from fx_path""",
    "geojson_boundaries": f"""with {FX_MUNICIPALITY} select municipality, type, cast(i as integer) as i, round(lng, 6) as lng,
      round(lat, 6) as lat from fx_municipality""",
    "geojson_addresses": f"""with {FX_ADDRESS}, {CELLED} select cast(id as varchar) as "ID_UEV",
      cast(nk as varchar) as "MUNICIPALITE", id % 7 as "NOMBRE_LOGEMENT", cast(null as varchar) as "NOM_RUE",
      {cell()} as cell_r10 from celled where q is not null""",
    "feature_collection": f"""with {FX_PARK} select park_id, cast(i as integer) as i, round(lng, 6) as lng, round(lat, 6) as lat
      from fx_park""",
    "stops_csv": f"""with {FX_STOP} select stop_id, round(lng, 6) as lng, round(lat, 6) as lat, {cell()} as cell_r10
      from {axial("fx_stop", "lng", "lat", 10)}""",
    "feature_json": f"""with {HEXES}, c as (select pq as q, pr as r, municipality, addresses, livability, score_bike from hexed),
      k as (select * from {corners("c", 9)}),
      closed as (select *, corner as i from k union all select *, 6 as i from k where corner = 0)
      select {cell(9)} as cell, 'Feature' as type, 'Polygon' as geometry_type, municipality, addresses,
        round(livability, 1) as livability, round(score_bike, 1) as score_bike, {color("livability")} as fill,
        cast(i as integer) as i, round(lng, 6) as lng, round(lat, 6) as lat from closed""",
    "personal_top": f"""with {LIV}, timed as (select *, {", ".join(f"{m} as m_{n}" for n, m in _anchor_minutes.items())} from liv),
      best as (select *, {_personal} as personal_score from timed order by personal_score desc, q, r limit 10)
      select {cell()} as cell, round(personal_score, 4) as personal_score, {_why} as why from best""",
}
ORACLE |= {name: ORACLE["poi_elements"] for name in ("elements_document", "elements_files")}  # the same points, however they landed

"""The queries as plain SQL, written from the definitions and not from the Spark plans.

Joins are theta joins, medians come from a second pass joined back, hulls from gift wrapping, UTM from the
published series, polygon tests from the edges.
"""

from __future__ import annotations

from workload.points import POINT_LAT, POINT_LON

ORACLE: dict[str, str] = {}

R = 6371010.0

POINTS = """points AS (
  SELECT e.event_id AS id, e.ts AS ts, strftime(e.ts, '%Y-%m-%d') AS day, e.event_type AS station,
         -9.5::double + ((e.event_id * 7919) % 10007) / 10007.0::double AS lon,
         42.0::double + ((e.event_id * 104729) % 10009) / 10009.0::double AS lat,
         e.value * 1.00001234567891::double + 0.0137::double AS speed,
         ((e.event_id * 37) % 360) + ((e.event_id * 7) % 997) / 997.0::double * 0.9::double + 0.05::double AS dir,
         CASE WHEN e.event_id % 17 <> 0 THEN e.value * 2 - 5 END AS temp
  FROM events e)"""

GRID = """grid AS (
  SELECT 'G' || (i + 1) AS node_id, -9.5::double + (i % 10) * 0.1::double AS lon,
         42.0::double + (i // 10) * 0.1::double AS lat
  FROM range(110) t(i))"""

GLOBAL = """points AS (
  SELECT e.event_id AS id, -180.0::double + ((e.event_id * 7919) % 10007) * 360.0::double / 10006.0::double AS lon,
         -90.0::double + ((e.event_id * 104729) % 10009) * 180.0::double / 10008.0::double AS lat
  FROM events e),
grid AS (
  SELECT 'W' || i AS node_id, -180.0::double + ((i * 449) % 1997) * 360.0::double / 1996.0::double AS lon,
         -90.0::double + ((i * 613) % 1999) * 180.0::double / 1998.0::double AS lat
  FROM range(1990) t(i))"""

SUPPLIERS = """suppliers AS (
  SELECT CASE WHEN s_suppkey % 3 = 0 THEN 'G' ELSE 'M' END || s_suppkey AS node_id,
         -9.4::double + ((s_suppkey::bigint * 31) % 101) / 131.0::double AS lon,
         42.1::double + ((s_suppkey::bigint * 57) % 103) / 137.0::double AS lat
  FROM supplier)"""

CUSTOMERS = """customers AS (
  SELECT 'M' || (c_custkey % 251) AS node_id,
         -9.4::double + ((c_custkey::bigint * 131) % 1009) / 1301.0::double AS lon,
         42.1::double + ((c_custkey::bigint * 157) % 1013) / 1307.0::double AS lat
  FROM customer)"""


def distance(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """Great-circle distance, atan2 form."""
    a1, a2, d = f"radians({lat1})", f"radians({lat2})", f"radians({lon2} - {lon1})"
    return (
        f"atan2(sqrt(pow(cos({a2}) * sin({d}), 2) + "
        f"pow(cos({a1}) * sin({a2}) - sin({a1}) * cos({a2}) * cos({d}), 2)), "
        f"sin({a1}) * sin({a2}) + cos({a1}) * cos({a2}) * cos({d})) * {R}::double"
    )


def window(r: float) -> str:
    return (
        f"g.lat BETWEEN p.lat - {r}::double / 110.574::double AND p.lat + {r}::double / 110.574::double "
        f"AND g.lon BETWEEN p.lon - {r}::double / (111.320::double * cos(radians(p.lat))) "
        f"AND p.lon + {r}::double / (111.320::double * cos(radians(p.lat)))"
    )


def near(r: float) -> str:
    return f"{distance('p.lat', 'p.lon', 'g.lat', 'g.lon')} <= {r}::double * 1000"


def pairs(condition: str, tables: str = f"{POINTS}, {GRID}") -> str:
    return f"WITH {tables} SELECT p.id AS rowid, g.node_id AS node_id FROM points p JOIN grid g ON {condition}"


ORACLE["link_within_radius"] = pairs(f"{window(10.0)} AND {near(10.0)}")
ORACLE["link_shuffled_cells"] = ORACLE["link_within_radius"]
ORACLE["link_without_window"] = pairs(near(10.0))
ORACLE["link_global"] = pairs(f"{window(150.0)} AND {near(150.0)}", GLOBAL)
ORACLE["link_global_without_window"] = pairs(near(150.0), GLOBAL)
ORACLE["band_join_window"] = pairs(window(10.0))
ORACLE["preview_links"] = ORACLE["link_within_radius"] + " ORDER BY p.id, g.node_id LIMIT 10"
ORACLE["great_circle_distance"] = (
    f"WITH {POINTS} SELECT id AS rowid, "
    f"round({distance('lat', 'lon', f'{POINT_LAT}::double', f'{POINT_LON}::double')}, 3) + 0.0 AS metres FROM points"
)


# ---------------------------------------------------------------- statistics

BASE = f"""{POINTS}, {GRID},
base AS (
  SELECT p.*, g.node_id, g.lon AS glon, g.lat AS glat FROM points p JOIN grid g ON {window(10.0)} AND {near(10.0)})"""


def rounded(expression: str, name: str, digits: int = 6) -> str:
    return f"round({expression}, {digits}) + 0.0 AS {name}"


def two_pass(keys: list[str], columns: list[str], source: str = "base", median: str = "quantile_cont") -> str:
    """CTEs ``agg`` and ``mad``: statistics, then absolute deviations from the joined-back medians."""
    group = ", ".join(keys)
    stats = ", ".join(
        f"avg({c}) AS {c}_mean, {median}({c}, 0.5) AS {c}_median, stddev_samp({c}) AS {c}_stddev, "
        f"min({c}) AS {c}_min, max({c}) AS {c}_max, count({c}) AS {c}_n"
        for c in columns
    )
    on = " AND ".join(f"b.{k} = a.{k}" for k in keys)
    gaps = ", ".join(f"{median}(abs(b.{c} - a.{c}_median), 0.5) AS {c}_mad" for c in columns)
    return (
        f"agg AS (SELECT {group}, count(*) AS n, {stats} FROM {source} GROUP BY {group}), "
        f"mad AS (SELECT {', '.join('b.' + k for k in keys)}, {gaps} FROM {source} b JOIN agg a ON {on} "
        f"GROUP BY {', '.join('b.' + k for k in keys)})"
    )


def stats_of(columns: list[str]) -> str:
    doubles = ("mean", "median", "stddev", "min", "max")
    return ", ".join(
        ", ".join(rounded(f"a.{c}_{s}", f"{c}_{s}") for s in doubles)
        + f", a.{c}_n AS {c}_n, "
        + rounded(f"m.{c}_mad", f"{c}_mad")
        for c in columns
    )


def joined(keys: list[str]) -> str:
    return "FROM agg a JOIN mad m ON " + " AND ".join(f"a.{k} = m.{k}" for k in keys)


def grid_stats(columns: list[str], keys: list[str] = ["day", "node_id"], median: str = "quantile_cont") -> str:
    shown = ", ".join(f"a.{k} AS {'timestamp' if k == 'day' else k}" for k in keys)
    return (
        f"WITH {BASE}, {two_pass(keys, columns, median=median)} "
        f"SELECT {shown}, a.n AS n, {stats_of(columns)} {joined(keys)}"
    )


def located(sql: str) -> str:
    """Statistics with the coordinates of their node."""
    return (
        f"SELECT s.*, {rounded('g.lon', 'geometry_lon')}, {rounded('g.lat', 'geometry_lat')} FROM ({sql}) s "
        f"JOIN (WITH {GRID} SELECT * FROM grid) g USING (node_id)"
    )


ORACLE["agg_grid_exact"] = grid_stats(["speed", "temp"])
ORACLE["agg_grid_fused"] = ORACLE["agg_grid_exact"]
ORACLE["agg_grid_hot_split"] = ORACLE["agg_grid_exact"]
ORACLE["agg_grid_bucketed"] = ORACLE["agg_grid_exact"]
ORACLE["agg_grid_disc"] = grid_stats(["speed", "temp"], median="quantile_disc")
# Sketches of groups of up to 500 rows are exact; these have fewer.
ORACLE["agg_grid_approx"] = ORACLE["agg_grid_disc"]
ORACLE["agg_grid_partitioned"] = grid_stats(["speed", "temp"], ["day", "node_id", "station"])
ORACLE["agg_grid_wkb"] = grid_stats(["speed"])


def deviations(keys: list[str]) -> str:
    shown = ", ".join(f"a.{k} AS {'timestamp' if k == 'day' else k}" for k in keys)
    values = ", ".join(
        f"{rounded(f'a.{c}_median', f'{c}_median')}, {rounded(f'm.{c}_mad', f'{c}_mad')}" for c in ("speed", "temp")
    )
    return f"WITH {POINTS}, {two_pass(keys, ['speed', 'temp'], 'points')} SELECT {shown}, {values} {joined(keys)}"


ORACLE["median_deviation"] = deviations(["day", "station"])
ORACLE["median_deviation_few_large_groups"] = deviations(["station"])


def angle_of(name: str, magnitude: str | None) -> str:
    def length(s: str) -> str:
        alias = "m" if s == "mad" else "a"
        return f"sqrt({alias}.{name}_sin_{s} * {alias}.{name}_sin_{s} + {alias}.{name}_cos_{s} * {alias}.{name}_cos_{s})"

    def spread(s: str) -> str:
        if magnitude:
            weight = f"{'m' if s == 'mad' else 'a'}.{magnitude}_{s}"
            rho = f"coalesce({length(s)} / nullif({weight}, 0), 0.0)"
        else:
            rho = length(s)
        clamped = f"least(greatest({rho}, 1e-9::double), 1.0::double)"
        return f"CASE WHEN {rho} IS NOT NULL THEN sqrt(abs(-2 * ln({clamped}))) END"

    return ", ".join(
        [
            rounded(f"atan2(a.{name}_sin_mean, a.{name}_cos_mean) * 180 / pi()", f"{name}_mean"),
            rounded(f"atan2(a.{name}_sin_median, a.{name}_cos_median) * 180 / pi()", f"{name}_median"),
            rounded(spread("mean"), f"{name}_stddev"),
            rounded(spread("mad"), f"{name}_mad"),
            f"a.{name}_sin_n AS {name}_n",
        ]
    )


def direction(
    scalars: list[str], angles: list[tuple[str, str | None]], keys: list[str], extra: str = ""
) -> str:
    parts = ", ".join(
        f"sin({a} * pi() / 180) * {m or '1.0::double'} AS {a}_sin, cos({a} * pi() / 180) * {m or '1.0::double'} AS {a}_cos"
        for a, m in angles
    )
    columns = list(dict.fromkeys(scalars + [m for _, m in angles if m] + [f"{a}_{c}" for a, _ in angles for c in ("sin", "cos")]))
    shown = ", ".join(f"a.{k} AS {'timestamp' if k == 'day' else k}" for k in keys)
    body = ", ".join(([stats_of(scalars)] if scalars else []) + [angle_of(a, m) for a, m in angles])
    return (
        f"WITH {BASE}, more AS (SELECT *{extra} FROM base), parts AS (SELECT *, {parts} FROM more), "
        f"{two_pass(keys, columns, 'parts')} SELECT {shown}, a.n AS n, {body} {joined(keys)}"
    )


ORACLE["agg_direction_unit"] = direction(["speed"], [("dir", None)], ["day", "node_id"])
ORACLE["agg_direction_weighted"] = direction(["temp"], [("dir", "speed")], ["day", "node_id"])
ORACLE["agg_direction_skip_mixed"] = direction(
    ["speed"],
    [("dir", None), ("dir2", "speed")],
    ["day", "node_id", "station"],
    ", fmod(dir * 2 + 15, 360.0::double) AS dir2",
)

_ux, _uy = f"({POINT_LON}::double - lon)", f"({POINT_LAT}::double - lat)"
_vx, _vy = f"({POINT_LON}::double - glon)", f"({POINT_LAT}::double - glat)"
_norm = f"(sqrt({_ux} * {_ux} + {_uy} * {_uy}) * sqrt({_vx} * {_vx} + {_vy} * {_vy}))"
ORACLE["agg_projection"] = (
    f"WITH {BASE}, turned AS (SELECT day, node_id, temp, "
    f"CASE WHEN {_norm} <> 0 THEN speed * (({_ux} * {_vx} + {_uy} * {_vy}) / {_norm}) END AS speed FROM base), "
    f"{two_pass(['day', 'node_id'], ['speed', 'temp'], 'turned')} "
    f"SELECT a.day AS timestamp, a.node_id AS node_id, a.n AS n, {stats_of(['speed', 'temp'])} {joined(['day', 'node_id'])}"
)


# ---------------------------------------------------------------- geometry

_located = f"WITH {POINTS} SELECT id AS rowid, round(lon, 9) + 0.0 AS lon, round(lat, 9) + 0.0 AS lat FROM points"
for _name in ("wkb_decode", "wkb_decode_native", "wkt_decode"):
    ORACLE[_name] = _located
ORACLE["wkb_round_trip"] = "SELECT event_id AS rowid, 1::bigint AS same FROM events"
ORACLE["geometry_types"] = "SELECT 'Point' AS kind, count(*) AS n FROM events"
ORACLE["geometry_type_list"] = "SELECT 'Point' AS types FROM events GROUP BY 1"
ORACLE["extent_by_group"] = (
    f"WITH {POINTS} SELECT station, {rounded('min(lon)', 'minx', 9)}, {rounded('min(lat)', 'miny', 9)}, "
    f"{rounded('max(lon)', 'maxx', 9)}, {rounded('max(lat)', 'maxy', 9)} FROM points GROUP BY station"
)
ORACLE["distinct_points"] = (
    f"WITH {POINTS} SELECT station, {rounded('lon', 'lon', 9)}, {rounded('lat', 'lat', 9)} "
    "FROM (SELECT DISTINCT station, lon, lat FROM points)"
)

# Krüger series in the third flattening n, sixth order, as SQL over the published fractions.
_A, _FLAT = "6378137.0::double", "(1 / 298.257223563::double)"
_CONST = f"""const AS (
  SELECT n, sqrt({_FLAT} * (2 - {_FLAT})) AS e, 0.9996::double * {_A} / (1 + n) * (1 + n**2/4 + n**4/64 + n**6/256) AS ka
  FROM (SELECT {_FLAT} / (2 - {_FLAT}) AS n)),
coef AS (
  SELECT e, ka,
    n/2 - 2*n**2/3 + 5*n**3/16 + 41*n**4/180 - 127*n**5/288 + 7891*n**6/37800 AS a1,
    13*n**2/48 - 3*n**3/5 + 557*n**4/1440 + 281*n**5/630 - 1983433*n**6/1935360 AS a2,
    61*n**3/240 - 103*n**4/140 + 15061*n**5/26880 + 167603*n**6/181440 AS a3,
    49561*n**4/161280 - 179*n**5/168 + 6601661*n**6/7257600 AS a4,
    34729*n**5/80640 - 3418889*n**6/1995840 AS a5,
    212378941*n**6/319334400 AS a6,
    n/2 - 2*n**2/3 + 37*n**3/96 - n**4/360 - 81*n**5/512 + 96199*n**6/604800 AS b1,
    n**2/48 + n**3/15 - 437*n**4/1440 + 46*n**5/105 - 1118711*n**6/3870720 AS b2,
    17*n**3/480 - 37*n**4/840 - 209*n**5/4480 + 5569*n**6/90720 AS b3,
    4397*n**4/161280 - 11*n**5/504 - 830251*n**6/7257600 AS b4,
    4583*n**5/161280 - 108847*n**6/3991680 AS b5,
    20648693*n**6/638668800 AS b6
  FROM const)"""


def _wave(letter: str, outer: str, inner: str) -> str:
    return " + ".join(f"{letter}{j} * {outer}({2 * j} * xi) * {inner}({2 * j} * eta)" for j in range(1, 7))


def forward(source: str, out: str, meridian: str = "-9") -> str:
    """CTEs that end in ``out``: all columns of ``source`` plus UTM ``x``, ``y`` (northern half)."""
    return f"""{out}_1 AS (
  SELECT s.*, coef.*, tan(radians(s.lat)) AS tau, radians(s.lon - ({meridian})) AS lam FROM {source} s, coef),
{out}_2 AS (SELECT *, sinh(e * atanh(e * tau / sqrt(1 + tau * tau))) AS sigma FROM {out}_1),
{out}_3 AS (SELECT *, tau * sqrt(1 + sigma * sigma) - sigma * sqrt(1 + tau * tau) AS conf FROM {out}_2),
{out}_4 AS (
  SELECT *, atan2(conf, cos(lam)) AS xi, asinh(sin(lam) / sqrt(conf * conf + cos(lam) * cos(lam))) AS eta FROM {out}_3),
{out} AS (
  SELECT *, 500000 + ka * (eta + {_wave('a', 'cos', 'sinh')}) AS x, ka * (xi + {_wave('a', 'sin', 'cosh')}) AS y
  FROM {out}_4)"""


def inverse(source: str, out: str, meridian: str = "-9") -> str:
    """CTEs that end in ``out``: ``node_id, lon, lat`` from ``node_id, x, y`` (fixed-point latitude)."""
    steps = ",\n".join(
        f"{out}_t{k} AS (SELECT * EXCLUDE (tau), "
        f"conf * sqrt(1 + sg * sg) + sg * sqrt(1 + conf * conf) AS tau FROM "
        f"(SELECT *, sinh(e * atanh(e * tau / sqrt(1 + tau * tau))) AS sg FROM {out}_t{k - 1}))".replace(
            "SELECT * EXCLUDE (tau)", "SELECT * EXCLUDE (tau, sg)"
        )
        for k in range(1, 9)
    )
    return f"""{out}_1 AS (SELECT s.*, coef.*, s.y / ka AS xi, (s.x - 500000) / ka AS eta FROM {source} s, coef),
{out}_2 AS (
  SELECT *, xi - ({_wave('b', 'sin', 'cosh')}) AS xp, eta - ({_wave('b', 'cos', 'sinh')}) AS ep FROM {out}_1),
{out}_3 AS (SELECT *, sin(xp) / sqrt(sinh(ep) * sinh(ep) + cos(xp) * cos(xp)) AS conf FROM {out}_2),
{out}_t0 AS (SELECT *, conf AS tau FROM {out}_3),
{steps},
{out} AS (SELECT node_id, {meridian} + degrees(atan2(sinh(ep), cos(xp))) AS lon, degrees(atan(tau)) AS lat FROM {out}_t8)"""


ORACLE["utm_metres"] = (
    f"WITH {POINTS}, {_CONST}, {forward('points', 'metric')} "
    f"SELECT id AS rowid, 29::bigint AS zone, {rounded('x', 'x', 4)}, {rounded('y', 'y', 4)} FROM metric"
)
ORACLE["utm_round_trip"] = (
    f"WITH {POINTS} SELECT id AS rowid, {rounded('lon', 'lon', 9)}, {rounded('lat', 'lat', 9)} FROM points"
)


# ---------------------------------------------------------------- grids


def lattice(box: str, spacing: float, prefix: str) -> str:
    """CTEs that end in ``nodes(node_id, lon, lat)`` for the one-row CTE ``box(w, s, e_, n_)``."""
    return f"""corners AS (SELECT w AS lon, s AS lat, 0 AS corner FROM {box} UNION ALL SELECT e_, n_, 1 FROM {box}),
{forward('corners', 'metric')},
inset AS (
  SELECT max(CASE WHEN corner = 0 THEN x END) + {spacing} / 2 AS x0, max(CASE WHEN corner = 0 THEN y END) + {spacing} / 2 AS y0,
         max(CASE WHEN corner = 1 THEN x END) - {spacing} / 2 AS x1, max(CASE WHEN corner = 1 THEN y END) - {spacing} / 2 AS y1
  FROM metric),
size AS (
  SELECT *, ceil((x1 + {spacing} - x0) / {spacing})::bigint AS nx, ceil((y1 + {spacing} - y0) / {spacing})::bigint AS ny FROM inset),
flat AS (
  SELECT '{prefix}' || (r.j * nx + i + 1) AS node_id, x0 + i * {spacing} AS x, y0 + r.j * {spacing} AS y
  FROM (SELECT *, unnest(range(nx)) AS i FROM size) c, LATERAL (SELECT unnest(range(c.ny)) AS j) r),
{inverse('flat', 'nodes')}"""


_BOX = "box AS (SELECT min(lon) AS w, min(lat) AS s, max(lon) AS e_, max(lat) AS n_ FROM points)"
_SHOW = f"node_id, {rounded('lon', 'lon', 7)}, {rounded('lat', 'lat', 7)}"


def first_wins(*sources: str, digits: int = 7) -> str:
    ranked = " UNION ALL ".join(f"SELECT node_id, lon, lat, {k} AS src FROM {s}" for k, s in enumerate(sources))
    return (
        f"SELECT node_id, {rounded('lon', 'lon', digits)}, {rounded('lat', 'lat', digits)} FROM ("
        f"SELECT *, row_number() OVER (PARTITION BY node_id ORDER BY src, lon, lat) AS k FROM ({ranked})) WHERE k = 1"
    )


ORACLE["grid_lattice_bbox"] = f"WITH {POINTS}, {_CONST}, {_BOX}, {lattice('box', 5000.0, 'N')} SELECT {_SHOW} FROM nodes"
ORACLE["grid_with_manual_nodes"] = (
    f"WITH {POINTS}, {_CONST}, {_BOX}, {SUPPLIERS}, {lattice('box', 10000.0, 'G')} {first_wins('nodes', 'suppliers')}"
)
ORACLE["grid_manual_only"] = f"WITH {CUSTOMERS} {first_wins('customers', digits=9)}"
ORACLE["merge_grids"] = f"WITH {GRID}, {SUPPLIERS}, {CUSTOMERS} {first_wins('grid', 'suppliers', 'customers', digits=9)}"
ORACLE["first_event_per_user"] = (
    f"SELECT user_id, event_id, event_type, {rounded('value', 'value')} FROM ("
    "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events) WHERE k = 1"
)

# triangle corners as edges (ax, ay) -> (bx, by), counter-clockwise
_TRIANGLE = """corner AS (
  SELECT w + 0.1::double * (e_ - w) AS ax, s AS ay, e_ AS bx, s + 0.3::double * (n_ - s) AS "by",
         w + 0.4::double * (e_ - w) AS cx, n_ AS cy FROM box)"""
_IN_TRIANGLE = (
    '(bx - ax) * (lat - ay) - ("by" - ay) * (lon - ax) >= 0 AND (cx - bx) * (lat - "by") - (cy - "by") * (lon - bx) >= 0 '
    "AND (ax - cx) * (lat - cy) - (ay - cy) * (lon - cx) >= 0"
)
ORACLE["points_in_triangle"] = (
    f"WITH {POINTS}, {_BOX}, {_TRIANGLE} SELECT id AS rowid FROM points, corner WHERE {_IN_TRIANGLE}"
)
ORACLE["grid_in_hull"] = (
    f"WITH {POINTS}, {_CONST}, {_BOX}, {_TRIANGLE}, hull_box AS (SELECT ax AS w, ay AS s, bx AS e_, cy AS n_ FROM corner), "
    f"{lattice('hull_box', 5000.0, 'T')} SELECT {_SHOW} FROM nodes, corner WHERE {_IN_TRIANGLE}"
)


# ---------------------------------------------------------------- hulls

# Gift wrapping: from the leftmost point, always turn to the point with the smallest left turn.
_SCATTERED = f"""{POINTS},
scattered AS (
  SELECT id, station, lon + speed * 1.7e-5::double AS lon, lat + speed * 0.9e-5::double AS lat FROM points)"""
_WRAP = """start AS (
  SELECT station, min(lon) AS sx, arg_min(lat, lon) AS sy FROM scattered GROUP BY station),
wrap AS (
  SELECT station, sx, sy, sx AS x, sy AS y, -pi() / 2 AS heading, 0 AS k FROM start
  UNION ALL
  SELECT station, sx, sy, nxt.lon AS x, nxt.lat AS y, nxt.heading AS heading, k + 1 AS k FROM (
    SELECT w.station, w.sx, w.sy, w.k,
           arg_min({lon: p.lon, lat: p.lat, heading: atan2(p.lat - w.y, p.lon - w.x)},
                   CASE WHEN atan2(p.lat - w.y, p.lon - w.x) - w.heading < -1e-12
                        THEN atan2(p.lat - w.y, p.lon - w.x) - w.heading + 2 * pi()
                        ELSE atan2(p.lat - w.y, p.lon - w.x) - w.heading END) AS nxt
    FROM wrap w JOIN scattered p ON p.station = w.station AND (p.lon <> w.x OR p.lat <> w.y)
    WHERE w.k = 0 OR w.x <> w.sx OR w.y <> w.sy
    GROUP BY w.station, w.sx, w.sy, w.k)
  WHERE k < (SELECT count(*) FROM scattered))"""
_HULL = f"WITH RECURSIVE {_SCATTERED}, {_WRAP}"
ORACLE["hull_vertices"] = (
    f"{_HULL} SELECT station, {rounded('x', 'lon', 9)}, {rounded('y', 'lat', 9)} FROM wrap WHERE k > 0"
)
_COVERED = """edges AS (
  SELECT a.station, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS "by" FROM wrap a JOIN wrap b ON a.station = b.station AND b.k = a.k + 1),
covered AS (
  SELECT p.id, e.station FROM scattered p CROSS JOIN edges e
  GROUP BY p.id, e.station HAVING min((bx - ax) * (lat - ay) - ("by" - ay) * (lon - ax)) >= 0)"""
ORACLE["hull_union_parts"] = f"{_HULL}, {_COVERED} SELECT DISTINCT id AS rowid FROM covered"
# Corners that no other hull covers, and crossings of two hulls' edges that no third one covers.
_OUTLINE = """edges AS (
  SELECT a.station, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS "by" FROM wrap a JOIN wrap b ON a.station = b.station AND b.k = a.k + 1),
crossed AS (
  SELECT e.station AS one, f.station AS two, e.ax, e.ay, e.bx, e."by",
    (f.bx - f.ax) * (e.ay - f.ay) - (f."by" - f.ay) * (e.ax - f.ax) AS d1, (f.bx - f.ax) * (e."by" - f.ay) - (f."by" - f.ay) * (e.bx - f.ax) AS d2,
    (e.bx - e.ax) * (f.ay - e.ay) - (e."by" - e.ay) * (f.ax - e.ax) AS d3, (e.bx - e.ax) * (f."by" - e.ay) - (e."by" - e.ay) * (f.bx - e.ax) AS d4
  FROM edges e JOIN edges f ON e.station < f.station),
spots AS (
  SELECT station AS one, station AS two, bx AS x, "by" AS y FROM edges
  UNION ALL SELECT one, two, ax + (bx - ax) * d1 / (d1 - d2), ay + ("by" - ay) * d1 / (d1 - d2) FROM crossed WHERE d1 * d2 < 0 AND d3 * d4 < 0),
covering AS (
  SELECT s.x, s.y FROM spots s JOIN edges e ON e.station <> s.one AND e.station <> s.two
  GROUP BY s.x, s.y, e.station HAVING min((e.bx - e.ax) * (s.y - e.ay) - (e."by" - e.ay) * (s.x - e.ax)) >= 0),
outline AS (SELECT x, y FROM spots EXCEPT SELECT x, y FROM covering)"""
ORACLE["hull_union_outline"] = f"{_HULL}, {_OUTLINE} SELECT {rounded('x', 'lon', 9)}, {rounded('y', 'lat', 9)} FROM outline"
# The border runs along each edge between two neighbouring corners or crossings whose middle no other hull covers (Green).
ORACLE["hull_union_area"] = f"""{_HULL}, {_OUTLINE},
stops AS (
  SELECT station, ax, ay, bx, "by", unnest([0.0::double, 1.0::double]) AS t FROM edges
  UNION ALL SELECT one, ax, ay, bx, "by", d1 / (d1 - d2) FROM crossed WHERE d1 * d2 < 0 AND d3 * d4 < 0
  UNION ALL SELECT f.station, f.ax, f.ay, f.bx, f."by", c.d3 / (c.d3 - c.d4) FROM crossed c JOIN edges f ON f.station = c.two
    AND (c.bx - c.ax) * (f.ay - c.ay) - (c."by" - c.ay) * (f.ax - c.ax) = c.d3 AND (c.bx - c.ax) * (f."by" - c.ay) - (c."by" - c.ay) * (f.bx - c.ax) = c.d4
    WHERE c.d1 * c.d2 < 0 AND c.d3 * c.d4 < 0),
runs AS (
  SELECT *, lead(t) OVER (PARTITION BY station, ax, ay, bx, "by" ORDER BY t) AS u FROM stops),
pieces AS (
  SELECT station, ax + (bx - ax) * t AS px, ay + ("by" - ay) * t AS py, ax + (bx - ax) * u AS qx, ay + ("by" - ay) * u AS qy FROM runs WHERE u > t),
hidden AS (
  SELECT p.* FROM pieces p JOIN edges e ON e.station <> p.station
  GROUP BY p.station, p.px, p.py, p.qx, p.qy, e.station
  HAVING min((e.bx - e.ax) * ((p.py + p.qy) / 2 - e.ay) - (e."by" - e.ay) * ((p.px + p.qx) / 2 - e.ax)) >= 0),
border AS (SELECT * FROM pieces EXCEPT SELECT * FROM hidden),
total AS (
  SELECT sum(px * qy - qx * py) / 2 AS a, sum((px * qy - qx * py) * (px + qx)) / 6 AS ax, sum((px * qy - qx * py) * (py + qy)) / 6 AS ay FROM border)
SELECT {rounded('a', 'area', 8)}, {rounded('ax / a', 'lon', 8)}, {rounded('ay / a', 'lat', 8)} FROM total"""
ORACLE["hull_intersection"] = f"{_HULL}, {_COVERED} SELECT id AS rowid FROM covered GROUP BY id HAVING count(*) = (SELECT count(DISTINCT station) FROM scattered)"


# ---------------------------------------------------------------- files and catalogs

_REL = "'station=' || event_type || '/' || event_type || '.parquet'"
_STAMP = "strftime({0}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond({0}) % 1000000 <> 0 THEN strftime({0}, '.%f') ELSE '' END || 'Z'"
_SAFE = "regexp_replace('station=' || event_type, '[^A-Za-z0-9_-]+', '_', 'g')"
_ITEM = f"{_SAFE} || '_' || regexp_replace(event_type, '[^A-Za-z0-9_-]+', '_', 'g')"
_WHOLE_BOX = ", ".join(
    rounded(f"(SELECT {f}({c}) FROM points)", n, 9)
    for f, c, n in (("min", "lon", "minx"), ("min", "lat", "miny"), ("max", "lon", "maxx"), ("max", "lat", "maxy"))
)

ORACLE["consolidated_files"] = f"SELECT {_REL} AS rel, count(*) AS row_count FROM events GROUP BY event_type"
ORACLE["consolidated_rows"] = (
    f"WITH {POINTS} SELECT id AS rowid, station, {rounded('speed', 'speed', 9)}, {rounded('lon', 'lon', 9)}, "
    f"{rounded('lat', 'lat', 9)} FROM points"
)
_IN_BOX = (
    f"WITH {POINTS} SELECT id AS rowid, station, {rounded('speed', 'speed', 9)}, {rounded('lon', 'lon', 9)}, {rounded('lat', 'lat', 9)} "
    "FROM points WHERE lon BETWEEN -9.25::double AND -8.9::double AND lat BETWEEN 42.2::double AND 42.55::double"
)
ORACLE["geoparquet_in_box"] = ORACLE["geoparquet_in_box_without_covering"] = _IN_BOX
ORACLE["geo_footers"] = (
    f"WITH {POINTS} SELECT 'station=' || station || '/' || station || '.parquet' AS rel, 'geometry' AS primary_column, "
    f"'WKB' AS encoding, 'Point' AS types, {_WHOLE_BOX} FROM points GROUP BY station"
)
ORACLE["geo_footers_per_file"] = (
    f"WITH {POINTS} SELECT 'station=' || station || '/' || station || '.parquet' AS rel, {rounded('min(lon)', 'minx', 9)}, "
    f"{rounded('min(lat)', 'miny', 9)}, {rounded('max(lon)', 'maxx', 9)}, {rounded('max(lat)', 'maxy', 9)} "
    "FROM points GROUP BY station"
)
ORACLE["asset_inventory"] = (
    f"SELECT {_REL} AS rel, 'station=' || event_type AS partitions, count(*) AS row_count, "
    "'rowid:integer,time:datetime,geometry:binary,speed:number' AS columns FROM events GROUP BY event_type"
)
ORACLE["asset_time_range"] = (
    f"SELECT event_type AS station, {_STAMP.format('min(ts)')} AS start, {_STAMP.format('max(ts)')} AS \"end\" "
    "FROM events GROUP BY event_type"
)
_SECOND = "date_trunc('second', ts)"
_ISO = "strftime({0}, '%Y-%m-%dT%H:%M:%S')"
ORACLE["iso_text_times"] = (
    "SELECT event_id, CASE event_id % 5 "
    f"WHEN 0 THEN {_ISO.format(_SECOND)} || 'Z' "
    f"WHEN 1 THEN {_ISO.format(_SECOND + ' - INTERVAL 2 HOUR')} || 'Z' "
    f"WHEN 2 THEN {_ISO.format(_SECOND + ' + INTERVAL 90 MINUTE')} || '.250000Z' "
    "WHEN 3 THEN strftime(ts, '%Y-%m-%d') || 'T00:00:00Z' END AS time FROM events"
)
ORACLE["stac_items"] = (
    f"SELECT {_ITEM} AS id, 'items/' || {_SAFE} || '/items/' || {_ITEM} || '.json' AS self_path, "
    f"'../../../assets/' || {_REL} AS asset_href, {_STAMP.format('min(ts)')} AS start, {_STAMP.format('max(ts)')} AS \"end\", "
    "count(*) AS row_count, 'geometry' AS primary_column FROM events GROUP BY event_type"
)
ORACLE["stac_catalogs"] = (
    f"SELECT 'items/' || {_SAFE} || '/catalog.json' AS self_path, '' AS children, "
    f"'items/' || {_SAFE} || '/items/' || {_ITEM} || '.json' AS items FROM events GROUP BY event_type "
    f"UNION ALL SELECT 'collection.json', string_agg('items/' || s || '/catalog.json', ',' ORDER BY s), '' "
    f"FROM (SELECT DISTINCT {_SAFE} AS s FROM events)"
)
ORACLE["stac_extent"] = (
    f"WITH {POINTS} SELECT {_STAMP.format('min(ts)')} AS start, {_STAMP.format('max(ts)')} AS \"end\", count(*) AS row_count, "
    f"{rounded('min(lon)', 'minx', 9)}, {rounded('min(lat)', 'miny', 9)}, {rounded('max(lon)', 'maxx', 9)}, "
    f"{rounded('max(lat)', 'maxy', 9)} FROM points"
)

ORACLE["nodes_keep_first"] = (
    "WITH numbered AS (SELECT c_custkey, 'M' || (c_custkey % 251) AS node_id, -9.4::double + ((c_custkey::bigint * 131) % 1009) / 1301.0::double AS lon, "
    "42.1::double + ((c_custkey::bigint * 157) % 1013) / 1307.0::double AS lat FROM customer) "
    f"SELECT node_id, {rounded('arg_min(lon, c_custkey)', 'lon', 9)}, {rounded('arg_min(lat, c_custkey)', 'lat', 9)} FROM numbered GROUP BY node_id"
)
ORACLE["links_table"] = ORACLE["link_within_radius"]
ORACLE["agg_grid_repeated_nodes"] = ORACLE["agg_grid_exact"]
ORACLE["wkb_decode_srid"] = (
    f"WITH {POINTS} SELECT id AS rowid, {rounded('lon', 'lon', 9)}, {rounded('lat', 'lat', 9)}, {rounded('lon', 'native_lon', 9)}, "
    f"{rounded('lat', 'native_lat', 9)} FROM points"
)
ORACLE["asset_time_range_mixed"] = (
    "WITH t AS (SELECT event_id % 3 AS k, CASE WHEN event_id % 3 = 2 THEN date_trunc('day', ts) ELSE ts END AS ts FROM events) "
    f"SELECT 'part=' || k AS part, {_STAMP.format('min(ts)')} AS start, {_STAMP.format('max(ts)')} AS \"end\", count(*) AS row_count FROM t GROUP BY k"
)
# statistics carry the geometry of their node
for _name in [n for n in ORACLE if n.startswith("agg_") and n != "agg_mad" and "node_id" in ORACLE[n]]:
    ORACLE[_name] = located(ORACLE[_name])
ORACLE["statistics_table"] = ORACLE["agg_grid_partitioned"]

_FAULTS = (
    "count(*) AS rows, count(*) FILTER (event_id % 13 = 0) AS missing_geometry, "
    "count(*) FILTER (event_id % 13 IN (1, 3)) AS unreadable_geometry, count(*) FILTER (event_id % 13 = 2) AS non_finite, "
    "count(*) FILTER (event_id % 13 > 3 AND event_id % 11 = 0) AS missing_key FROM events"
)
ORACLE["faults_by_station"] = f"SELECT event_type AS station, {_FAULTS} GROUP BY event_type"


def of_rows(sql: str, events: str) -> str:
    """The statistics with other rows than all events."""
    return located(sql.replace("FROM events e)", f"FROM ({events}) e)"))


ORACLE["statistics_with_faults"] = (
    f"SELECT * FROM ({of_rows(grid_stats(['speed']), 'SELECT * FROM events WHERE event_id % 13 > 3 AND event_id % 11 <> 0')}) "
    f"CROSS JOIN (SELECT {_FAULTS})"
)
ORACLE["statistics_refreshed"] = of_rows(
    grid_stats(["speed", "temp"], ["day", "node_id", "station"]),
    "WITH places AS (SELECT *, dense_rank() OVER (ORDER BY event_type) AS place FROM events) "
    "SELECT * FROM places WHERE place > 3 OR place = 1 OR (place = 2 AND event_id % 3 = 0) "
    "UNION ALL SELECT * FROM places WHERE place = 1 AND event_id % 2 = 0",
)

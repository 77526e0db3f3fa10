"""The named queries as DuckDB SQL over the same tables.

Written from the definitions, not from the Spark plans, so that both sides check each other.
"""

from __future__ import annotations

from itertools import accumulate

from incident_engine import constants as C
from incident_engine.catalog import queries as q
from incident_engine.functions.geo import METRES_PER_DEGREE, HexGrid
from incident_engine.sources import adapters


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _double(value: float) -> str:
    return f"{value!r}::DOUBLE"


DAYS = _list(C.DAY_ORDER)

RAW = f"""
raw_text AS (
  SELECT event_id,
    {_list(adapters.EVENT_TYPES)}[((event_id * 31 + user_id) % 8) + 1] AS kind,
    {_list(adapters.LAT_MICRO)}[(user_id % 5) + 1] + ((event_id * 7919) % 21 - 10) * 1000 AS lat_u,
    {_list(adapters.LON_MICRO)}[(user_id % 5) + 1] + ((event_id * 104729) % 5 - 2) * 1000 AS lon_u,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp
  FROM events
),
raw AS (
  SELECT
    CASE WHEN event_id % 103 <> 0 THEN printf('V%04d', event_id) END AS "Violation_Id",
    CASE WHEN event_id % 97 = 0 THEN 'not-a-date' ELSE stamp END AS "Timestamp",
    CASE WHEN event_id % 61 = 0 THEN NULL
         WHEN event_id % 53 = 0 THEN ' ' || kind || ' ' ELSE kind END AS "Violation_Type",
    CASE WHEN event_id % 101 = 0 THEN NULL
         WHEN event_id % 89 = 0 THEN 'Main St & 5th Ave'
         ELSE printf('%d.%06d,-%d.%06d', lat_u // 1000000, lat_u % 1000000,
                     lon_u // 1000000, lon_u % 1000000) END AS "Location"
  FROM raw_text
)"""

PARSED = f"""{RAW},
parsed AS (
  SELECT "Violation_Id" AS violation_id,
    try_strptime("Timestamp", '%Y-%m-%d %H:%M:%S')::TIMESTAMP AS timestamp_parsed,
    "Violation_Type" AS violation_type, "Location" AS location
  FROM raw
)"""

CLEAN = f"""{PARSED},
clean AS (
  SELECT * FROM parsed
  WHERE violation_id IS NOT NULL AND timestamp_parsed IS NOT NULL AND location IS NOT NULL
)"""


def weight_of(column: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in C.SEVERITY_WEIGHTS.items())
    return f"CASE trim({column}) {cases} ELSE {C.DEFAULT_SEVERITY} END"


SCORED = f"""{CLEAN},
scored AS (
  SELECT *, hour(timestamp_parsed)::INTEGER AS "Hour",
    {weight_of("violation_type")} AS severity
  FROM clean
)"""

PRIMARY = f"""{SCORED},
type_ranks AS (
  SELECT "Hour", violation_type, count(*) AS n,
    row_number() OVER (PARTITION BY "Hour" ORDER BY count(*) DESC, violation_type) AS place
  FROM scored WHERE violation_type IS NOT NULL GROUP BY "Hour", violation_type
),
primary_type AS (SELECT * FROM type_ranks WHERE place = 1)"""

HOURLY = f"""{PRIMARY},
volumes AS (
  SELECT "Hour", count(violation_id) AS n, sum(severity) AS points, avg(severity) AS mean_points
  FROM scored GROUP BY "Hour"
),
stats AS (SELECT avg(n) AS m, stddev_samp(n) AS s FROM volumes),
z AS (
  SELECT volumes.*,
    CASE WHEN s > 0 THEN round_even((n - m) / s * 100, 0) / 100 + 0.0 ELSE 0.0 END AS z
  FROM volumes, stats
),
hourly AS (
  SELECT z."Hour", z.n::BIGINT AS violation_count, points::BIGINT AS total_risk_score,
    mean_points::DOUBLE AS avg_risk_score, violation_type AS primary_violation,
    z::DOUBLE AS z_score,
    CASE WHEN z >= {C.CRITICAL_Z} THEN '{C.CRITICAL}' WHEN z >= {C.ELEVATED_Z} THEN '{C.ELEVATED}'
         WHEN z <= {C.LOW_Z} THEN '{C.LOW}' ELSE '{C.NORMAL}' END AS anomaly_level,
    abs(z) >= {C.ELEVATED_Z} AS is_anomaly
  FROM z LEFT JOIN primary_type ON z."Hour" = primary_type."Hour"
)"""

MATRIX = f"""{SCORED},
matrix AS (
  SELECT "Hour", violation_type, count(violation_id)::BIGINT AS violation_count,
    sum(severity)::BIGINT AS total_risk_score
  FROM scored WHERE violation_type IS NOT NULL GROUP BY "Hour", violation_type
)"""

TIME_TYPE = f"""{PARSED},
time_type AS (
  SELECT {DAYS}[isodow(timestamp_parsed)] AS "DayOfWeek",
    hour(timestamp_parsed)::INTEGER AS "Hour", violation_type AS "Violation_Type",
    count(*)::BIGINT AS "count"
  FROM parsed WHERE timestamp_parsed IS NOT NULL AND violation_type IS NOT NULL
  GROUP BY ALL
)"""

PLACES = f"""{RAW},
places AS (
  SELECT "Location", count(*)::BIGINT AS "count" FROM raw
  WHERE "Location" IS NOT NULL GROUP BY "Location"
)"""

POINTS = f"""{CLEAN},
points AS (
  SELECT *, split_part(location, ',', 1)::DOUBLE AS lat, split_part(location, ',', 2)::DOUBLE AS lon
  FROM clean WHERE regexp_matches(location, '{C.COORDINATE_PATTERN}')
)"""

GRID = f"""{POINTS},
grid AS (
  SELECT floor(lat * 100)::BIGINT || '_' || floor(lon * 100)::BIGINT AS grid_id,
    count(*)::BIGINT AS "count"
  FROM points GROUP BY 1
)"""


def nearest(centres) -> str:
    """Index of the nearest of some fixed centres, by a list of distances."""
    distances = ", ".join(
        f"sqrt((lat - {_double(a)}) * (lat - {_double(a)}) + (lon - {_double(b)}) * (lon - {_double(b)}))"
        for a, b in centres
    )
    return f"(list_position([{distances}], list_min([{distances}])) - 1)::INTEGER"


LABELLED = f"""{POINTS},
labelled AS (SELECT *, {nearest(C.HOTSPOTS)} AS prediction FROM points)"""

def profile_of(labels: str) -> str:
    """The cluster profile of the CTE `labelled` that some CTEs end in."""
    return f"""{labels},
type_counts AS (
  SELECT prediction, violation_type,
    row_number() OVER (PARTITION BY prediction ORDER BY count(*) DESC, violation_type) AS place
  FROM labelled WHERE violation_type IS NOT NULL GROUP BY prediction, violation_type
),
sizes AS (
  SELECT prediction, round(avg(lat), 6) AS lat, round(avg(lon), 6) AS lon, count(*) AS n
  FROM labelled GROUP BY prediction
),
centroids AS (
  SELECT sizes.prediction AS cluster_id, lat AS center_lat, lon AS center_lon,
    n::BIGINT AS violation_count,
    coalesce(violation_type, '{C.DEFAULT_DOMINANT}') AS dominant_violation
  FROM sizes LEFT JOIN type_counts
    ON sizes.prediction = type_counts.prediction AND place = 1
)"""


PROFILE = profile_of(LABELLED)


def with_(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"


def hexbin() -> str:
    grid = HexGrid()
    per_lon, per_lat = _double(grid.metres_per_lon), _double(METRES_PER_DEGREE)
    root3, radius = 3**0.5, grid.radius_m
    return with_(
        f"""{POINTS},
flat AS (SELECT lon * {per_lon} AS x, lat * {per_lat} AS y FROM points),
axial AS (
  SELECT (x * {_double(root3 / 3)} - y / 3::DOUBLE) / {_double(radius)} AS q,
    y * {_double(2.0 / 3.0)} / {_double(radius)} AS r FROM flat
),
cubes AS (SELECT q, r, -q - r AS s, floor(q + 0.5) AS q0, floor(r + 0.5) AS r0,
  floor(-q - r + 0.5) AS s0 FROM axial),
gaps AS (SELECT *, abs(q0 - q) AS dq, abs(r0 - r) AS dr, abs(s0 - s) AS ds FROM cubes),
cells AS (
  SELECT (CASE WHEN dq > dr AND dq > ds THEN -r0 - s0 ELSE q0 END)::BIGINT AS hex_q,
    (CASE WHEN NOT (dq > dr AND dq > ds) AND dr > ds THEN -q0 - s0 ELSE r0 END)::BIGINT AS hex_r
  FROM gaps
)""",
        f"""
SELECT hex_q, hex_r,
  round(hex_r * {_double(1.5 * radius)} / {per_lat}, 6) AS center_lat,
  round((hex_q + hex_r / 2::DOUBLE) * {_double(root3 * radius)} / {per_lon}, 6) AS center_lon,
  count(*)::BIGINT AS "count"
FROM cells GROUP BY hex_q, hex_r""",
    )


def lloyd_step() -> str:
    start = ", ".join(f"({i}, {_double(a)}, {_double(b)})" for i, (a, b) in enumerate(q.LLOYD_START))
    return with_(
        f"""{POINTS},
start(id, lat, lon) AS (VALUES {start}),
members AS (SELECT lat, lon, {nearest(q.LLOYD_START)} AS id FROM points)""",
        """
SELECT start.id::INTEGER AS cluster_id,
  round(coalesce(avg(members.lat), any_value(start.lat)), 6) AS center_lat,
  round(coalesce(avg(members.lon), any_value(start.lon)), 6) AS center_lon,
  count(members.lat)::BIGINT AS violation_count
FROM start LEFT JOIN members ON start.id = members.id GROUP BY start.id""",
    )


def lloyd_passes(start: str, k: int = 5) -> tuple[str, str]:
    """CTEs of Lloyd's algorithm, ending in the row `centres`, and the label of a place by them.

    A recursion that ends with the pass after which no centre moves; `start` selects a0, b0, a1 and so on.
    """
    names = [f"{ax}{i}" for i in range(k) for ax in "ab"]
    distances = ", ".join(f"sqrt((lat - a{i}) * (lat - a{i}) + (lon - b{i}) * (lon - b{i}))"
                          for i in range(k))
    label = f"list_position([{distances}], list_min([{distances}])) - 1"
    means = ", ".join(
        f"coalesce(avg(CASE WHEN id = {i} THEN {col} END), any_value({ax}{i})) AS n_{ax}{i}"
        for i in range(k) for ax, col in (("a", "lat"), ("b", "lon"))
    )
    old = ", ".join(names)
    first = ", ".join(f"any_value({n}) AS {n}" for n in names)
    still = " AND ".join(f"abs({n} - n_{n}) <= 1e-5 + 1e-5 * abs(n_{n})" for n in names)
    kept = ", ".join(f"CASE WHEN {still} THEN {n} ELSE n_{n} END" for n in names)
    return f"""passes(pass, done, {old}) AS (
  SELECT 0, false, * FROM ({start})
  UNION ALL
  SELECT pass + 1, {still}, {kept} FROM (
    SELECT pass, {first}, {means} FROM (
      SELECT lat, lon, pass, {old}, {label} AS id FROM points, passes WHERE NOT done AND pass < 100
    ) GROUP BY pass
  )
),
centres AS (SELECT * FROM passes ORDER BY pass DESC LIMIT 1)""", f"({label})::INTEGER"


def recursive(ctes: str, select: str) -> str:
    return with_(ctes, select).replace("WITH ", "WITH RECURSIVE ", 1)


def lloyd_clusters() -> str:
    start = ", ".join(f"{_double(v)} AS {axis}{i}" for i, c in enumerate(q.LLOYD_START)
                      for axis, v in zip(("a", "b"), c))
    passes, label = lloyd_passes(f"SELECT {start}")
    return recursive(
        f"{POINTS},\n{passes}",
        f"""
SELECT violation_id, lat, lon, {label} AS prediction, violation_type, done AS settled
FROM points, centres""",
    )


def _start_row(table: str, k: int = 5) -> str:
    """The numbered places of a table as one row."""
    return "SELECT " + ", ".join(
        f"max({col}) FILTER (k = {i + 1}) AS {ax}{i}" for i in range(k) for ax, col in (("a", "lat"), ("b", "lon"))
    ) + f" FROM {table}"


def lloyd_sampled_centroids() -> str:
    passes, label = lloyd_passes(_start_row("drawn"))
    labels = f"""{POINTS},
drawn AS (
  SELECT lat, lon, row_number() OVER (ORDER BY md5('42:' || violation_id), violation_id, lat, lon) AS k
  FROM points QUALIFY k <= 5
),
{passes},
labelled AS (SELECT points.*, {label} AS prediction FROM points, centres)"""
    return recursive(profile_of(labels), "SELECT * FROM centroids")


def _square(a: str, b: str) -> str:
    return f"(({a}.lat - {b}.lat) * ({a}.lat - {b}.lat) + ({a}.lon - {b}.lon) * ({a}.lon - {b}.lon))"


def kmeans(k: int = 5, seed: int = 42, rounds: int = 3) -> str:
    """CTEs of k-means, ending in `labelled`: rounds of drawn candidates, their reduction, Lloyd's passes."""

    def u(turn: int) -> str:
        place = "round(lat * 1e6)::BIGINT || ',' || round(lon * 1e6)::BIGINT"
        return f"(('0x' || substr(md5('{seed}:{turn}:' || {place}), 1, 8))::BIGINT::DOUBLE / 4294967296)"

    steps = [f"cand0 AS (SELECT lat, lon, 0 AS turn FROM places ORDER BY {u(0)}, lat, lon LIMIT 1)"]
    for r in range(1, rounds + 1):
        steps += [
            f"""cost{r} AS (
  SELECT p.lat, p.lon, p.w * min({_square("p", "c")}) AS cost FROM places p, cand{r - 1} c GROUP BY p.lat, p.lon, p.w
)""",
            f"""cand{r} AS (
  SELECT * FROM cand{r - 1} UNION ALL
  SELECT lat, lon, {r} FROM cost{r} WHERE {u(r)} * (SELECT sum(cost) FROM cost{r}) < cost * {2 * k}
)""",
        ]
    steps += [
        f"""owned AS (
  SELECT c.lat, c.lon, p.w FROM places p, cand{rounds} c
  QUALIFY row_number() OVER (PARTITION BY p.lat, p.lon ORDER BY sqrt({_square("p", "c")}), c.turn, c.lat, c.lon) = 1
)""",
        "heavy AS (SELECT lat, lon, sum(w) AS w FROM owned GROUP BY lat, lon)",
        "start1 AS (SELECT lat, lon, 1 AS k FROM heavy ORDER BY w DESC, lat, lon LIMIT 1)",
    ]
    for i in range(2, k + 1):
        steps.append(f"""start{i} AS (
  SELECT * FROM start{i - 1} UNION ALL
  (SELECT h.lat, h.lon, {i} FROM heavy h, start{i - 1} s GROUP BY h.lat, h.lon, h.w
   ORDER BY h.w * min({_square("h", "s")}) DESC, h.lat, h.lon LIMIT 1)
)""")
    passes, _ = lloyd_passes(_start_row(f"start{k}", k), k)
    lats, lons = (", ".join(f"{ax}{i}" for i in range(k)) for ax in "ab")
    return f"""{POINTS},
places AS (SELECT lat, lon, count(*)::DOUBLE AS w FROM points GROUP BY lat, lon),
{",".join(steps)},
{passes},
sorted AS (
  SELECT lat, lon, row_number() OVER (ORDER BY lat, lon) - 1 AS id
  FROM (SELECT unnest([{lats}]) AS lat, unnest([{lons}]) AS lon FROM centres)
),
labels AS (
  SELECT p.lat, p.lon, c.id FROM places p, sorted c
  QUALIFY row_number() OVER (PARTITION BY p.lat, p.lon ORDER BY sqrt({_square("p", "c")}), c.id) = 1
),
labelled AS (
  SELECT points.*, labels.id::INTEGER AS prediction
  FROM points JOIN labels ON points.lat = labels.lat AND points.lon = labels.lon
)"""


def nearest_from_table() -> str:
    place = ", ".join(
        f"({c} + {_double(q.CENTRE_PLACE)}) / {q.CENTRE_CELLS}::DOUBLE AS {n}" for c, n in (("x", "lat"), ("y", "lon"))
    )
    return with_(
        f"""{POINTS},
cells AS (
  SELECT DISTINCT floor(lat * {q.CENTRE_CELLS})::BIGINT AS x, floor(lon * {q.CENTRE_CELLS})::BIGINT AS y FROM points
),
spots AS (SELECT ((x - 20000) * 10000 + y + 40000)::INTEGER AS id, {place} FROM cells),
places AS (SELECT DISTINCT lat, lon FROM points),
found AS (
  SELECT p.lat, p.lon, s.id, sqrt({_square("p", "s")}) AS d FROM places p, spots s
  QUALIFY row_number() OVER (PARTITION BY p.lat, p.lon ORDER BY d, s.id) = 1
)""",
        """
SELECT violation_id, points.lat, points.lon, id AS prediction, round(d, 9) AS distance
FROM points JOIN found ON points.lat = found.lat AND points.lon = found.lon""",
    )


def z_scores(table: str, column: str, by: str) -> str:
    """Rows of a table with their z-score among the rows of one key."""
    over = f"OVER (PARTITION BY {by})" if by else "OVER ()"
    gap = f"({column} - avg({column}) {over}) / nullif(stddev_samp({column}) {over}, 0)"
    return f"SELECT *, coalesce(round_even({gap} * 100, 0) / 100 + 0.0, 0.0)::DOUBLE AS z_score FROM {table}"


def synthesize() -> str:
    def u(draw: int) -> str:
        block, place = divmod(draw, 4)
        return (
            f"(('0x' || substr(md5('{q.SYNTH_SEED}:{block}:' || event_id), {8 * place + 1}, 8))"
            "::BIGINT::DOUBLE / 4294967296::DOUBLE)"
        )

    bounds = list(accumulate(C.HOUR_WEIGHTS))
    hour = " + ".join(f"(h * {bounds[-1]}::DOUBLE >= {b})::INTEGER" for b in bounds[:-1])
    radius = "sqrt(-2.0::DOUBLE * ln(g + 1.0 / 4294967296::DOUBLE))"
    spots = [_list([f for f in axis]) for axis in zip(*C.HOTSPOTS)]
    return with_(
        f"""
draws AS (
  SELECT event_id, {u(0)} AS d, {u(1)} AS h, {u(2)} AS mi, {u(3)} AS se, {u(4)} AS t,
    {u(5)} AS sp, {u(6)} AS g, {u(7)} AS w
  FROM events
)""",
        f"""
SELECT printf('V%04d', event_id) AS "Violation_Id",
  strftime(DATE '{q.SYNTH_ANCHOR}' + floor(d * {C.SYNTH_DAYS})::INTEGER, '%Y-%m-%d')
    || printf(' %02d:%02d:%02d', {hour}, floor(mi * 60)::INTEGER, floor(se * 60)::INTEGER)
    AS "Timestamp",
  {_list(C.SYNTH_TYPES)}[floor(t * {len(C.SYNTH_TYPES)})::INTEGER + 1] AS "Violation_Type",
  printf('%.6f,%.6f',
    {spots[0]}[floor(sp * 5)::INTEGER + 1]::DOUBLE
      + 0.005::DOUBLE * ({radius} * cos(2 * pi() * w)),
    {spots[1]}[floor(sp * 5)::INTEGER + 1]::DOUBLE
      + 0.005::DOUBLE * ({radius} * sin(2 * pi() * w))) AS "Location"
FROM draws""",
    )


CHOSEN = f""""Violation_Type" IN {_in(q.CHOSEN_TYPES)} AND "DayOfWeek" IN {_in(q.CHOSEN_DAYS)}"""
SELECT_CLEAN = "SELECT violation_id, timestamp_parsed, violation_type, location FROM clean"


def count_by(part: str, expression: str) -> str:
    return with_(
        CLEAN,
        f'SELECT ({expression})::INTEGER AS {part}, count(*)::BIGINT AS "count" FROM clean GROUP BY 1',
    )


def corridors(n: int) -> str:
    return f'SELECT "Location", "count" FROM places ORDER BY "count" DESC, "Location" LIMIT {n}'


def corridor_table(where: str = "") -> str:
    part = "trim(split_part(\"Location\", ',', {}))"
    number = f"TRY_CAST(regexp_extract({part}, '^[-+]?[0-9]+[.]?[0-9]*') AS DOUBLE)"
    return with_(
        f"""{PLACES},
ranks AS (SELECT *, row_number() OVER (ORDER BY "count" DESC, "Location") AS n FROM places)""",
        f"""
SELECT '#' || n AS rank_label, "Location", "count", least(100, "count" * 15)::BIGINT AS density_share,
  {number.format(1)} AS lat, {number.format(2)} AS lon
FROM ranks {where} ORDER BY n LIMIT 10""",
    )


def kpis(where: str) -> str:
    return with_(
        f"""{PLACES}, {TIME_TYPE.split(RAW)[1].lstrip(",")},
chosen AS (SELECT *, {weight_of('"Violation_Type"')} AS w FROM time_type WHERE {where}),
types AS (SELECT "Violation_Type" AS t, sum("count") AS n FROM chosen GROUP BY 1),
hours AS (SELECT "Hour" AS h, sum("count") AS n FROM chosen GROUP BY 1)""",
        """
SELECT coalesce((SELECT sum("count") FROM chosen), 0)::BIGINT AS total_violations,
  coalesce((SELECT t FROM types ORDER BY n DESC, t LIMIT 1), 'N/A') AS top_type,
  coalesce((SELECT max(n) FROM types), 0)::BIGINT AS top_type_count,
  coalesce((SELECT printf('%02d:00', h) FROM hours ORDER BY n DESC, h LIMIT 1), 'N/A') AS peak_hour,
  (SELECT "Location" FROM places ORDER BY "count" DESC, "Location" LIMIT 1) AS top_location,
  coalesce((SELECT sum("count" * w) FROM chosen), 0)::BIGINT AS risk_points,
  coalesce((SELECT sum("count" * w)::DOUBLE / sum("count")::DOUBLE FROM chosen), 0)::DOUBLE
    AS avg_severity""",
    )


def audit() -> str:
    actions = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in C.PATROL_ACTIONS.items())
    return with_(
        HOURLY,
        f"""
SELECT printf('%02d:00', "Hour") AS hour_label, violation_count,
  total_risk_score || ' pts' AS risk_label,
  CASE WHEN z_score > 0 THEN '+' ELSE '' END || printf('%.2f', z_score) AS z_label,
  anomaly_level, coalesce(primary_violation, '{C.DEFAULT_PRIMARY}') AS primary_violation,
  CASE anomaly_level {actions} ELSE '{C.DEFAULT_ACTION}' END AS action
FROM hourly""",
    )


def summary() -> str:
    return with_(
        f"""{HOURLY}, {PLACES.split(RAW)[1].lstrip(",")}, {PROFILE.split(CLEAN)[1].lstrip(",")}""",
        f"""
SELECT (SELECT sum(violation_count) FROM hourly)::BIGINT AS total_violations,
  (SELECT printf('%02d:00', "Hour") FROM hourly ORDER BY violation_count DESC, "Hour" LIMIT 1)
    AS rush_hour_spike,
  coalesce((SELECT string_agg("Hour"::VARCHAR, ',' ORDER BY "Hour") FROM hourly
            WHERE anomaly_level = '{C.CRITICAL}'), '') AS critical_spike_hours,
  (SELECT string_agg("Location" || '=' || "count", ';' ORDER BY "count" DESC, "Location")
   FROM ({corridors(10)})) AS top_locations,
  (SELECT string_agg(cluster_id || '=' || violation_count || '=' || dominant_violation, ';'
                     ORDER BY cluster_id) FROM centroids) AS clusters""",
    )


def colour(mapping: dict, default: str = "NULL") -> str:
    cases = " ".join(
        f"WHEN {k} THEN '{v if isinstance(v, str) else ','.join(map(str, v))}'"
        for k, v in mapping.items()
    )
    return f"CASE prediction {cases} ELSE {default} END"


def statements() -> dict[str, str]:
    """SQL per query name."""
    hourly = with_(HOURLY, "SELECT * FROM hourly")
    matrix = with_(MATRIX, "SELECT * FROM matrix")
    matrix_text = ", ".join(f'"{c}"::VARCHAR AS "{c}"' for c in (
        "Hour", "violation_type", "violation_count", "total_risk_score"))
    wide = ", ".join(
        f'coalesce(sum(violation_count) FILTER ("Hour" = {h}), 0)::BIGINT AS h{h:02d}'
        for h in range(24)
    )
    profile = with_(PROFILE, "SELECT * FROM centroids")
    titles = ", ".join(f'{k} AS "{v}"' for k, v in C.CENTROID_TITLES.items())
    filtered = with_(TIME_TYPE, f"SELECT * FROM time_type WHERE {CHOSEN}")
    days = ", ".join(f"('{d}')" for d in C.DAY_ORDER)
    clean = with_(CLEAN, SELECT_CLEAN)
    location_risk = with_(
        SCORED,
        f"""
SELECT location, count(violation_id)::BIGINT AS total_violations,
  sum(severity)::BIGINT AS total_risk_score, avg(severity)::DOUBLE AS avg_risk_score,
  count(*) FILTER (severity >= {C.HIGH_SEVERITY})::BIGINT AS high_severity_count
FROM scored GROUP BY location""",
    )
    return {
        "raw_violations": with_(RAW, "SELECT * FROM raw"),
        "clean": clean,
        "raw_reject_counts": with_(
            PARSED,
            """
SELECT count(*) FILTER (violation_id IS NULL)::BIGINT AS missing_id,
  count(*) FILTER (timestamp_parsed IS NULL)::BIGINT AS bad_timestamp,
  count(*) FILTER (location IS NULL)::BIGINT AS missing_location,
  count(*) FILTER (violation_id IS NOT NULL AND timestamp_parsed IS NOT NULL
                   AND location IS NOT NULL)::BIGINT AS accepted,
  count(*)::BIGINT AS total
FROM parsed""",
        ),
        "csv_scan_clean": clean,
        "parquet_scan_clean": clean,
        "result_csv_scan": hourly,
        "result_rows_scan": with_(MATRIX, f"SELECT {matrix_text} FROM matrix"),
        "synthesize": synthesize(),
        "count_by_hour": count_by("hour_of_day", "hour(timestamp_parsed)"),
        "count_by_day_of_week": count_by("day_of_week", "isodow(timestamp_parsed)"),
        "count_by_month": count_by("month", "month(timestamp_parsed)"),
        "count_by_year": count_by("year", "year(timestamp_parsed)"),
        "time_type_aggregation": with_(TIME_TYPE, "SELECT * FROM time_type"),
        "weekday_hour_type_counts": with_(
            CLEAN,
            f"""
SELECT (isodow(timestamp_parsed) - 1)::INTEGER AS weekday,
  hour(timestamp_parsed)::INTEGER AS "Hour", violation_type, count(*)::BIGINT AS n,
  {DAYS}[isodow(timestamp_parsed)] AS "DayOfWeek"
FROM clean GROUP BY ALL""",
        ),
        "violations_per_location": with_(PLACES, "SELECT * FROM places"),
        "top_locations": with_(PLACES, corridors(10)),
        "corridors_15": with_(PLACES, corridors(15)),
        "corridors_json": with_(
            PLACES,
            f"""SELECT '{{"Location":"' || "Location" || '","count":"' || "count" || '"}}' AS json
FROM ({corridors(15)})""",
        ),
        "corridor_table": corridor_table(),
        "corridor_search": corridor_table(
            f"""WHERE contains(lower('#' || n || chr(9) || "Location" || chr(9) || "count"),
                               '{q.SEARCH.lower()}')"""
        ),
        "extract_coordinates": with_(POINTS, "SELECT violation_id, lat, lon FROM points"),
        "grid_counts": with_(GRID, "SELECT * FROM grid"),
        "top_grids": with_(GRID, 'SELECT * FROM grid ORDER BY "count" DESC, grid_id LIMIT 10'),
        "hexbin_density": hexbin(),
        "map_hexagons": hexbin(),
        "nearest_centroid": with_(
            LABELLED, "SELECT violation_id, lat, lon, prediction, violation_type FROM labelled"
        ),
        "cluster_sizes": with_(
            LABELLED, 'SELECT prediction, count(*)::BIGINT AS "count" FROM labelled GROUP BY 1'
        ),
        "cluster_profile": profile,
        "hotspots": profile,
        "centroid_table": with_(PROFILE, f"SELECT {titles} FROM centroids"),
        "lloyd_step": lloyd_step(),
        "lloyd_clusters": lloyd_clusters(),
        "lloyd_sampled_centroids": lloyd_sampled_centroids(),
        "kmeans_clusters": recursive(
            kmeans(), "SELECT violation_id, lat, lon, prediction, violation_type FROM labelled"
        ),
        "kmeans_centroids": recursive(profile_of(kmeans()), "SELECT * FROM centroids"),
        "feature_vectors": with_(POINTS, "SELECT violation_id, lat AS f0, lon AS f1 FROM points"),
        "nearest_from_table": nearest_from_table(),
        "incident_fraction": with_(
            LABELLED,
            f"""SELECT violation_id, lat, lon, prediction, violation_type FROM labelled
WHERE ('0x' || substr(md5(violation_id), 1, 8))::BIGINT < {int(q.SAMPLE_FRACTION * 2**32)}""",
        ),
        "incident_sample_per_cluster": with_(
            LABELLED,
            f"""SELECT violation_id, lat, lon, prediction, violation_type FROM labelled QUALIFY
row_number() OVER (PARTITION BY prediction ORDER BY md5(violation_id), violation_id, lat, lon)
  <= {q.SAMPLE_PER_CLUSTER}""",
        ),
        "cluster_colours_from_table": with_(
            f"""{LABELLED},
colours(cluster, hex) AS (VALUES {", ".join(f"({k}, '{v}')" for k, v in list(C.CLUSTER_HEX.items())[:-1])})""",
            f"""SELECT violation_id, prediction, coalesce(hex, '{C.DEFAULT_HEX}') AS hex
FROM labelled LEFT JOIN colours ON prediction = cluster""",
        ),
        "severity_from_table": with_(
            f"""{CLEAN},
weights(kind, points) AS (VALUES {", ".join(f"('{k}', {v})" for k, v in C.SEVERITY_WEIGHTS.items())})""",
            f"""SELECT violation_id, violation_type, coalesce(points, {C.DEFAULT_SEVERITY})::INTEGER AS severity_score
FROM clean LEFT JOIN weights ON trim(violation_type) = kind""",
        ),
        "place_profile_lookup": with_(
            SCORED,
            """SELECT violation_id, location, (count(*) OVER (PARTITION BY location))::BIGINT AS total_violations,
  (sum(severity) OVER (PARTITION BY location))::BIGINT AS total_risk_score FROM scored""",
        ),
        "type_hour_z_scores": with_(
            f"""{SCORED},
counts AS (SELECT "Hour", violation_type, count(*)::BIGINT AS n FROM scored
           WHERE violation_type IS NOT NULL GROUP BY ALL)""",
            z_scores("counts", "n", "violation_type"),
        ),
        "place_type_z_scores": with_(
            f"""{CLEAN},
counts AS (SELECT location, violation_type, count(*)::BIGINT AS n FROM clean
           WHERE violation_type IS NOT NULL GROUP BY ALL)""",
            z_scores("counts", "n", "location"),
        ),
        "place_z_scores": with_(PLACES, z_scores("places", '"count"', "")),
        "completed_time_type": with_(
            f"""{TIME_TYPE},
kinds AS (SELECT DISTINCT "Violation_Type" AS kind FROM raw WHERE "Violation_Type" IS NOT NULL)""",
            f"""
SELECT d AS "DayOfWeek", h::INTEGER AS "Hour", kind AS "Violation_Type", coalesce("count", 0)::BIGINT AS "count"
FROM kinds CROSS JOIN (VALUES {days}) AS spine(d) CROSS JOIN range(24) AS hours(h)
LEFT JOIN (SELECT * FROM time_type WHERE "DayOfWeek" IN {_in(q.CHOSEN_DAYS)})
  ON h = "Hour" AND d = "DayOfWeek" AND kind = "Violation_Type"
""",
        ),
        "bundle_fallback": matrix,
        "underscore_header_scan": with_(RAW, "SELECT * FROM raw"),
        "ensured_timestamps": with_(
            RAW,
            """SELECT "Violation_Id", try_strptime("Timestamp", '%Y-%m-%d %H:%M:%S')::TIMESTAMP AS timestamp_parsed
FROM raw""",
        ),
        "hourly_view": hourly,
        "kpi_labels": f"""
SELECT format('{{:,}}', total_violations) AS total_violations, format('{{:,}}', risk_points) AS risk_points
FROM ({kpis("true")})""",
        "incident_sample": with_(
            LABELLED,
            f"""SELECT violation_id, lat, lon, prediction, violation_type FROM labelled
ORDER BY md5(violation_id), violation_id, lat, lon LIMIT {q.SAMPLE_SIZE}""",
        ),
        "map_points": with_(
            LABELLED,
            f"""
SELECT violation_id, lat, lon, prediction, violation_type,
  {colour(C.CLUSTER_RGBA)} AS color, {colour(C.CLUSTER_HEX, f"'{C.DEFAULT_HEX}'")} AS color_hex
FROM labelled""",
        ),
        "map_center": with_(
            POINTS,
            "SELECT round(avg(lat), 6) AS center_lat, round(avg(lon), 6) AS center_lon FROM points",
        ),
        "severity_lookup": with_(
            SCORED,
            "SELECT violation_id, violation_type, severity::INTEGER AS severity_score FROM scored",
        ),
        "hourly_risk_anomaly": hourly,
        "streaming_surges": hourly,
        "hourly_volume_stats": with_(
            HOURLY, "SELECT round(m, 6) AS mean_volume, round(s, 6) AS std_volume FROM stats"
        ),
        "primary_violation_per_hour": with_(
            PRIMARY,
            """SELECT "Hour", violation_type AS primary_violation, n::BIGINT AS v_count
FROM primary_type""",
        ),
        "top_risk_hours": with_(
            HOURLY,
            """SELECT "Hour", total_risk_score, anomaly_level FROM hourly
ORDER BY total_risk_score DESC, "Hour" LIMIT 3""",
        ),
        "critical_hours": with_(
            HOURLY, f"""SELECT "Hour", z_score FROM hourly WHERE anomaly_level = '{C.CRITICAL}'"""
        ),
        "location_risk": location_risk,
        "daily_location_risk": location_risk,
        "time_type_matrix": matrix,
        "intensity_matrix_wide": with_(
            MATRIX, f"SELECT violation_type, {wide} FROM matrix GROUP BY violation_type"
        ),
        "filtered_time_type": filtered,
        "export_filtered": filtered,
        "single_choice_time_type": with_(
            TIME_TYPE,
            """SELECT * FROM time_type WHERE "Violation_Type" = 'DUI' AND "DayOfWeek" = 'Friday'""",
        ),
        "kpis": kpis("true"),
        "kpis_filtered": kpis(CHOSEN),
        "hourly_curve": with_(
            TIME_TYPE,
            f"""
SELECT h::INTEGER AS "Hour", coalesce(sum("count"), 0)::BIGINT AS "count"
FROM range(24) AS spine(h) LEFT JOIN (SELECT * FROM time_type WHERE {CHOSEN}) ON h = "Hour"
GROUP BY h""",
        ),
        "daily_distribution": with_(
            TIME_TYPE,
            f"""
SELECT spine.d AS "DayOfWeek", sum("count")::BIGINT AS "count"
FROM (VALUES {", ".join(f"('{d}')" for d in q.CHOSEN_DAYS)}) AS spine(d)
LEFT JOIN (SELECT * FROM time_type WHERE {CHOSEN}) ON d = "DayOfWeek" GROUP BY d""",
        ),
        "daily_totals": with_(
            TIME_TYPE,
            f"""
SELECT spine.d AS "DayOfWeek", coalesce(sum("count"), 0)::BIGINT AS "count"
FROM (VALUES {days}) AS spine(d)
LEFT JOIN (SELECT * FROM time_type WHERE "Violation_Type" = 'DUI') ON d = "DayOfWeek" GROUP BY d""",
        ),
        "category_breakdown": with_(
            TIME_TYPE,
            f"""SELECT "Violation_Type", sum("count")::BIGINT AS "count" FROM time_type
WHERE "DayOfWeek" IN {_in(q.CHOSEN_DAYS)} GROUP BY 1""",
        ),
        "category_list": with_(TIME_TYPE, 'SELECT DISTINCT "Violation_Type" FROM time_type'),
        "critical_alert": with_(
            HOURLY,
            f"""
SELECT string_agg(printf('%02d:00', "Hour"), ', ' ORDER BY "Hour") AS spike_hours,
  count(*)::BIGINT AS n_hours
FROM hourly WHERE anomaly_level = '{C.CRITICAL}' HAVING count(*) > 0""",
        ),
        "anomaly_audit": audit(),
        "summary": summary(),
        "streaming_hourly_counts": with_(
            CLEAN,
            f"""
SELECT date_trunc('hour', timestamp_parsed)::TIMESTAMP AS hour_start, violation_type,
  count(*)::BIGINT AS "count"
FROM clean GROUP BY 1, 2
HAVING hour_start + INTERVAL 1 HOUR
  <= (SELECT max(timestamp_parsed) FROM clean) - INTERVAL {q.STREAM_DELAY_HOURS} HOUR""",
        ),
    }

"""The same results in plain SQL over the given tables, for comparison."""

from __future__ import annotations

from precinct.functions.text import OFFENCE_DIVISIONS

_CASES = " ".join(f"WHEN '{name.lower()}' THEN '{code}'" for code, name in OFFENCE_DIVISIONS.items())

# One SQL text per view or step; a query names what it needs and gets it with all it builds on.
_STEPS: dict[str, tuple[tuple[str, ...], str]] = {
    "incidents_raw": ((), """
        SELECT o_orderkey AS row_no, ' Area. ' || (o_custkey % 200) || '  Unit ' AS area_unit,
               CASE WHEN o_orderkey % 97 = 0 THEN 'unknown' WHEN o_orderkey % 101 = 0 THEN 'January ' || CASE WHEN o_orderkey % 2 = 0 THEN 9999 ELSE 1500 END
                    ELSE strftime(o_orderdate, '%B %Y') END AS year_month,
               CAST(o_custkey AS VARCHAR) AS meshblock,
               CASE o_orderkey % 5 WHEN 0 THEN 'Theft and Related Offences' WHEN 1 THEN 'ROBBERY, EXTORTION AND RELATED OFFENCES'
                    WHEN 2 THEN '08 Other' WHEN 3 THEN 'Unlisted' END AS division,
               o_orderpriority AS anzsoc_group
        FROM orders"""),
    "concordance": ((), """
        SELECT c_custkey AS row_no,
               CASE WHEN c_custkey % 200 < 190 THEN 'Area ' ELSE 'Former Area ' END || (c_custkey % 200) || ' Unit' AS au_name,
               CAST(100000 + c_custkey % 150 AS VARCHAR) AS code,
               CASE WHEN c_custkey % 150 >= 140 THEN 'Zone ' ELSE 'Place ' END || (c_custkey % 150)
                 || CASE WHEN c_custkey % 4 = 0 THEN ' (North)' ELSE '' END AS place,
               r_name AS region, n_name AS council, c_mktsegment AS location_type,
               CAST(CASE WHEN c_custkey % 10 = 0 THEN 4000000 + c_custkey ELSE c_custkey END AS VARCHAR) AS new_code,
               CAST(c_custkey AS VARCHAR) AS old_code
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""),
    "census": ((), """
        SELECT p_partkey AS row_no, 'Place ' || (p_partkey % 120) AS area, 2013 + 5 * (p_partkey % 7 % 3) AS census_year,
               500 + 100 * p_size AS value
        FROM part"""),
    "points": ((), """
        SELECT c_custkey AS id, -47e0 + (c_custkey * 37 % 1300) / 100e0 AS lat,
               CASE WHEN c_custkey % 50 = 0 THEN 0e0 ELSE 166e0 + (c_custkey * 91 % 1200) / 100e0 END AS lng
        FROM customer"""),
    "metrics": ((), """
        SELECT event_id, ts, value, user_id % 4 AS endpoint,
               CASE event_type WHEN 'view' THEN 'api_response_time_uncached' WHEN 'click' THEN 'api_response_time_cached_avg'
                    WHEN 'purchase' THEN 'database_query_time' WHEN 'signup' THEN 'memory_usage_peak'
                    WHEN 'error' THEN 'cache_hit_rate' END AS metric_name
        FROM events"""),
    "vertices": ((), """
        SELECT feature_id, part, ring, seq,
               round(lng + part * 0.5e0 + radius * cos(angle), 6) AS x,
               round(lat + (CASE WHEN ring = 1 THEN 0.001e0 ELSE 0e0 END) + radius * sin(angle) * (CASE WHEN seq = 1 THEN 1.5e0 ELSE 0.7e0 END), 6) AS y
        FROM (
          SELECT *, 2 * pi() * (seq % n) / n AS angle, CASE WHEN ring = 1 THEN 0.01e0 ELSE 0.05e0 END AS radius
          FROM (
            SELECT feature_id, n, lat, lng, part, ring, CAST(unnest(range(0, n + 1)) AS INTEGER) AS seq
            FROM (
              SELECT feature_id, n, lat, lng, part, unnest(CASE WHEN feature_id % 3 = 0 THEN [0, 1] ELSE [0] END) AS ring
              FROM (
                SELECT c_custkey AS feature_id, 4 + c_custkey % 5 AS n, -47e0 + (c_custkey * 37 % 1300) / 100e0 AS lat,
                       166e0 + (c_custkey * 91 % 1200) / 100e0 AS lng,
                       unnest(CASE WHEN c_custkey % 11 = 0 THEN [0, 1] ELSE [0] END) AS part
                FROM customer))))"""),
    "area_dim": (("concordance",), """
        SELECT au_name AS area_key, arg_max(code, row_no) AS suburb_id, arg_max(place, row_no) AS name, arg_max(place, row_no) AS name_orig,
               arg_max(region, row_no) AS region, arg_max(council, row_no) AS council, arg_max(location_type, row_no) AS location_type
        FROM concordance GROUP BY 1"""),
    "cleaned": (("incidents_raw",), """
        SELECT *, trim(regexp_replace(replace(area_unit, '.', ' '), '\\s+', ' ', 'g')) AS area_key,
               CASE WHEN regexp_matches(division, '^[0-9]{2}') THEN substr(division, 1, 2)
                    ELSE CASE lower(division) """ + _CASES + """ END END AS code,
               CASE WHEN CAST(try_strptime(year_month, '%B %Y') AS DATE) BETWEEN DATE '1677-10-01' AND DATE '2262-04-01'
                    THEN CAST(try_strptime(year_month, '%B %Y') AS DATE) END AS day
        FROM incidents_raw"""),
    "incidents": (("cleaned", "area_dim", "concordance"), """
        SELECT i.row_no, d.suburb_id, i.day, i.code, i.division, i.anzsoc_group, coalesce(m.new_code, i.meshblock) AS block, i.area_key,
               sha256(sha256('{"area_unit":"' || area_unit || '","year_month":"' || year_month || '","meshblock":"' || meshblock || '"'
                 || coalesce(',"division":"' || division || '"', '') || ',"anzsoc_group":"' || anzsoc_group || '","source":"orders"}') || '#'
                 || (row_number() OVER (PARTITION BY area_unit, year_month, meshblock, division, anzsoc_group ORDER BY i.row_no) - 1)) AS event_id
        FROM cleaned i JOIN area_dim d ON i.area_key = d.area_key
        LEFT JOIN (SELECT old_code, arg_max(new_code, row_no) AS new_code FROM concordance GROUP BY 1) m ON i.meshblock = m.old_code"""),
    "months": (("incidents",), """
        SELECT suburb_id AS area, CAST(date_trunc('month', day) AS DATE) AS month, count(*) AS n
        FROM incidents WHERE day IS NOT NULL GROUP BY 1, 2"""),
    "rolling": (("incidents",), """
        SELECT suburb_id AS area,
               count(*) FILTER (WHERE day >= (SELECT last_day(max(day)) FROM incidents) - INTERVAL 365 DAY) AS total_12m
        FROM incidents GROUP BY 1"""),
    "trends": (("months",), """
        SELECT area, recent_avg, previous_avg,
               CASE WHEN seen < 2 THEN 'flat' WHEN recent_avg > previous_avg * 1.1e0 THEN 'up'
                    WHEN recent_avg < previous_avg * 0.9e0 THEN 'down' ELSE 'flat' END AS crime_trend,
               CASE WHEN seen >= 2 AND previous_avg > 0 THEN (recent_avg - previous_avg) / previous_avg * 100e0 ELSE 0e0 END AS trend_3m_change
        FROM (
          SELECT area, count(*) AS seen, coalesce(avg(n) FILTER (WHERE r <= 3), 0e0) AS recent_avg,
                 coalesce(avg(n) FILTER (WHERE r > 3), 0e0) AS previous_avg
          FROM (SELECT *, row_number() OVER (PARTITION BY area ORDER BY month DESC) AS r FROM months) WHERE r <= 6 GROUP BY 1)"""),
    "peaks": (("months",), """
        SELECT area, string_agg(strftime(month, '%Y-%m-%d'), ',' ORDER BY month) AS peak_crime_months
        FROM (SELECT *, row_number() OVER (PARTITION BY area ORDER BY n DESC, month) AS r FROM months) WHERE r <= 3 GROUP BY 1"""),
    "codes": (("incidents",), """
        SELECT area, coalesce(string_agg(code || ':' || n, ',' ORDER BY code), '') AS codes
        FROM (SELECT suburb_id AS area, code, count(*) AS n FROM incidents WHERE code IS NOT NULL GROUP BY 1, 2) GROUP BY 1"""),
    "firsts": (("incidents",), "SELECT suburb_id AS area, arg_min(area_key, row_no) AS label FROM incidents GROUP BY 1"),
    "names": (("area_dim",), "SELECT DISTINCT name_orig FROM area_dim"),
    "population": (("names", "census"), """
        SELECT name_orig, coalesce(
          (SELECT arg_min(value, row_no) FROM census WHERE area = name_orig AND census_year = 2023),
          (SELECT arg_min(value, row_no) FROM census WHERE contains(lower(area), lower(name_orig)) OR contains(lower(name_orig), lower(area))),
          10000) AS population
        FROM names"""),
    "rated": (("firsts", "rolling", "trends", "area_dim", "population"), """
        SELECT f.area, f.label, d.name, d.name_orig, d.region, d.council, d.location_type, p.population, r.total_12m,
               coalesce(t.crime_trend, 'flat') AS crime_trend, coalesce(t.trend_3m_change, 0e0) AS trend_3m_change,
               CASE WHEN p.population > 0 THEN r.total_12m / p.population * 1000e0 ELSE 0e0 END AS rate
        FROM firsts f JOIN rolling r USING (area) LEFT JOIN trends t USING (area) JOIN area_dim d ON f.label = d.area_key
        JOIN population p ON d.name_orig = p.name_orig"""),
    "ranked": (("rated",), "SELECT *, dense_rank() OVER (PARTITION BY region ORDER BY rate DESC) AS rank_in_region FROM rated"),
    "wkt": (("vertices",), """
        SELECT feature_id, CASE WHEN count(*) > 1 THEN 'MULTIPOLYGON (' || string_agg(t, ', ' ORDER BY part) || ')'
               ELSE 'POLYGON ' || min(t) END AS wkt
        FROM (
          SELECT feature_id, part, '(' || string_agg(t, ', ' ORDER BY ring) || ')' AS t
          FROM (
            SELECT feature_id, part, ring, '(' || string_agg(regexp_replace(CAST(x AS VARCHAR), '\\.0$', '') || ' '
                   || regexp_replace(CAST(y AS VARCHAR), '\\.0$', ''), ', ' ORDER BY seq) || ')' AS t
            FROM vertices GROUP BY 1, 2, 3) GROUP BY 1, 2) GROUP BY 1"""),
    "layer": (("concordance", "points", "wkt"), """
        SELECT place AS name, arg_max(id, id) AS id, arg_max(lat, id) AS lat, arg_max(lng, id) AS lng, arg_max(wkt, id) AS geometry
        FROM concordance JOIN points ON row_no = id JOIN wkt ON feature_id = id GROUP BY 1"""),
    "areas": (("ranked", "layer", "codes", "peaks"), """
        SELECT r.area AS suburb_id, r.label AS "AU2017_name", r.name,
               regexp_replace(regexp_replace(regexp_replace(lower(r.name), '\\(([^)]+)\\)', ' \\1', 'g'), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug,
               r.region, r.council, r.location_type, coalesce(l.lat, 0e0) AS lat, coalesce(l.lng, 0e0) AS lng, l.geometry, 0e0 AS safety_score,
               r.rate AS crime_rate_per_1000, CAST(least(r.total_12m, 32767) AS BIGINT) AS total_crimes_12m, r.crime_trend, r.rank_in_region,
               coalesce(c.codes, '') AS crime_breakdown, r.trend_3m_change, coalesce(p.peak_crime_months, '') AS peak_crime_months,
               '' AS report_url, '' AS widget_embed_code, '' AS summary_text, '' AS tags, CAST(r.population AS BIGINT) AS population, '' AS nearby_suburbs
        FROM ranked r LEFT JOIN layer l ON r.name = l.name LEFT JOIN codes c ON r.area = c.area LEFT JOIN peaks p ON r.area = p.area"""),
    "neighbours": (("areas",), """
        SELECT *, row_number() OVER (PARTITION BY suburb_id ORDER BY distance_km, near_id) - 1 AS pos
        FROM (
          SELECT suburb_id, near_id, slug, name, region, round(km, 2) AS distance_km
          FROM (
            SELECT a.suburb_id, b.suburb_id AS near_id, b.slug, b.name, b.region, 2 * 6371e0 * asin(sqrt(least(1e0, pow(sin((radians(b.lat) - radians(a.lat)) / 2), 2)
                   + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin((radians(b.lng) - radians(a.lng)) / 2), 2)))) AS km
            FROM areas a JOIN areas b ON a.suburb_id <> b.suburb_id
            WHERE a.lat <> 0 AND a.lng <> 0 AND b.lat <> 0 AND b.lng <> 0 AND b.slug <> '') WHERE km <= 150)
        QUALIFY pos < 3"""),
    "blocks": (("incidents",), """
        SELECT block AS id, arg_min(suburb_id, row_no) AS suburb_id, count(*) AS crime_count FROM incidents GROUP BY 1"""),
    "flawed": (("incidents",), """
        SELECT CASE WHEN k % 10 = 0 THEN '' ELSE suburb_id END AS suburb_id, CASE WHEN k % 15 = 0 THEN repeat('x', 201) ELSE division END AS division
        FROM (SELECT *, CAST('0x' || substr(event_id, 1, 4) AS INTEGER) AS k FROM incidents)"""),
    "pinched": (("vertices",), """
        SELECT feature_id, part, ring, seq,
               CASE WHEN feature_id % 13 = 0 AND ring = 0 AND seq = 2 THEN round(166e0 + (feature_id * 91 % 1200) / 100e0 + part * 0.5e0 + 0.05e0, 6) ELSE x END AS x,
               CASE WHEN feature_id % 13 = 0 AND ring = 0 AND seq = 2 THEN round(-47e0 + (feature_id * 37 % 1300) / 100e0, 6) ELSE y END AS y
        FROM (SELECT * EXCLUDE seq, CASE WHEN ring = 0 AND feature_id % 4 = 1 AND seq = 1 THEN 2 WHEN ring = 0 AND feature_id % 4 = 1 AND seq = 2 THEN 1 ELSE seq END AS seq FROM vertices)
        WHERE NOT (feature_id % 7 = 0 AND seq = 4 + feature_id % 5)"""),
    "defective": (("pinched",), """
        SELECT feature_id, part, ring, seq, round(CASE WHEN ring = 1 AND feature_id % 16 = 0 THEN x + 0.2e0 ELSE x END, 6) AS x, y FROM pinched
        UNION ALL
        SELECT feature_id, part, ring, seq, round(cx + (x - cx) * share, 6), round(cy + (y - cy) * share, 6)
        FROM (
          SELECT feature_id, CASE WHEN again THEN 2 ELSE 0 END AS part, CASE WHEN again THEN 0 ELSE 2 END AS ring, seq, x, y, CASE WHEN again THEN 0.05e0 ELSE 0.5e0 END AS share,
                 166e0 + (feature_id * 91 % 1200) / 100e0 AS cx, -47e0 + (feature_id * 37 % 1300) / 100e0 + 0.001e0 AS cy
          FROM pinched, (SELECT unnest([true, false]) AS again)
          WHERE part = 0 AND ((again AND ring = 0 AND feature_id % 17 = 0) OR (NOT again AND ring = 1 AND feature_id % 5 = 0)))"""),
}


def _with(*names: str, recursive: str = "") -> str:
    """WITH clause for the named steps and everything they build on."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in _STEPS[name][0]:
            add(needed)
        if name not in order:
            order.append(name)

    for n in names:
        add(n)
    # steps are used several times and some are dear, so they are computed once
    steps = ", ".join(f"{n} AS MATERIALIZED ({_STEPS[n][1]})" for n in order)
    return f"WITH {'RECURSIVE ' if recursive else ''}{steps}{recursive} "


def _nearest(radius: str, k: int) -> str:
    return _with("points") + f"""
      SELECT id, neighbour_id, distance_km, rank FROM (
        SELECT id, neighbour_id, distance_km, row_number() OVER (PARTITION BY id ORDER BY distance_km, neighbour_id) AS rank FROM (
          SELECT id, neighbour_id, round(km, 2) AS distance_km FROM (
            SELECT a.id, b.id AS neighbour_id, 2 * 6371e0 * asin(sqrt(least(1e0, pow(sin((radians(b.lat) - radians(a.lat)) / 2), 2)
                   + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin((radians(b.lng) - radians(a.lng)) / 2), 2)))) AS km
            FROM points a JOIN points b ON a.id <> b.id
            WHERE a.lat <> 0 AND a.lng <> 0 AND b.lat <> 0 AND b.lng <> 0) WHERE km <= {radius}))
      WHERE rank <= {k}"""


def _exclusive_p95(by: str, source: str, always: bool) -> str:
    pick = "p" if always else "CASE WHEN sample_size >= 20 THEN p ELSE max END"
    return f"""
      SELECT {by}, round(average, 6) AS average, round(min, 6) AS min, round(max, 6) AS max, sample_size, round({pick}, 6) AS p95
      FROM (
        SELECT {by}, average, min, max, sample_size,
               CASE WHEN sample_size = 1 THEN v[1] ELSE (v[j] * (20 - delta) + v[j + 1] * delta) / 20e0 END AS p
        FROM (
          SELECT *, 19 * (sample_size + 1) - 20 * j AS delta
          FROM (
            SELECT *, greatest(1, least((19 * (sample_size + 1)) // 20, sample_size - 1)) AS j
            FROM (
              SELECT {by}, avg(value) AS average, min(value) AS min, max(value) AS max, count(*) AS sample_size,
                     list(value ORDER BY value) AS v
              FROM {source} GROUP BY 1))))"""


def _grade(value: str, low: bool, bands) -> str:
    sign = "<" if low else ">="
    names = ("EXCELLENT", "GOOD", "FAIR")
    return "CASE " + " ".join(f"WHEN {value} {sign} {b} THEN '{n}'" for b, n in zip(bands, names)) + " ELSE 'POOR' END"


def _errors(source: str, tests: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{f}' AS field, '{r}' AS rule, count(*) AS n_rows FROM {source} WHERE {test} HAVING count(*) > 0" for f, r, test in tests
    )


_AREA_TESTS = [
    ("lat", "range", "lat IS NOT NULL AND (isnan(lat) OR lat < -90 OR lat > 90)"),
    ("lng", "range", "lng < -180 OR lng > 180"),
    ("crime_rate_per_1000", "range", "rate < 0"),
    ("crime_trend", "one_of", "trend = 'sideways'"),
    ("population", "range", "population < 0"),
]
_BLOCK_TESTS = [
    ("id", "min_length", "id = ''"),
    ("crime_count", "range", "crime_count < 0"),
    ("lat", "range", "lat > 90"),
    ("lng", "range", "lng > 180"),
]


_VALIDITY = """
  , seg AS (
    SELECT feature_id, part, ring, seq, x AS x1, y AS y1, lead(x) OVER w AS x2, lead(y) OVER w AS y2, max(seq) OVER (PARTITION BY feature_id, part, ring) AS top
    FROM defective WINDOW w AS (PARTITION BY feature_id, part, ring ORDER BY seq)),
  edge AS (SELECT * FROM seg WHERE x2 IS NOT NULL AND (x1 <> x2 OR y1 <> y2)),
  pair AS (
    SELECT a.feature_id, a.part = b.part AND a.ring = b.ring AS same, a.seq AS sa, b.seq AS sb, a.top,
           a.x1 AS ax1, a.y1 AS ay1, a.x2 AS ax2, a.y2 AS ay2, b.x1 AS bx1, b.y1 AS by1, b.x2 AS bx2, b.y2 AS by2,
           sign((a.x2 - a.x1) * (b.y1 - a.y1) - (a.y2 - a.y1) * (b.x1 - a.x1)) AS t1,
           sign((a.x2 - a.x1) * (b.y2 - a.y1) - (a.y2 - a.y1) * (b.x2 - a.x1)) AS t2,
           sign((b.x2 - b.x1) * (a.y1 - b.y1) - (b.y2 - b.y1) * (a.x1 - b.x1)) AS t3,
           sign((b.x2 - b.x1) * (a.y2 - b.y1) - (b.y2 - b.y1) * (a.x2 - b.x1)) AS t4
    FROM edge a JOIN edge b ON a.feature_id = b.feature_id AND (a.part, a.ring, a.seq) < (b.part, b.ring, b.seq)),
  judged AS (
    SELECT feature_id, same, t1 * t2 < 0 AND t3 * t4 < 0 AS proper,
           (t1 = 0 AND bx1 BETWEEN least(ax1, ax2) AND greatest(ax1, ax2) AND by1 BETWEEN least(ay1, ay2) AND greatest(ay1, ay2))
           OR (t2 = 0 AND bx2 BETWEEN least(ax1, ax2) AND greatest(ax1, ax2) AND by2 BETWEEN least(ay1, ay2) AND greatest(ay1, ay2))
           OR (t3 = 0 AND ax1 BETWEEN least(bx1, bx2) AND greatest(bx1, bx2) AND ay1 BETWEEN least(by1, by2) AND greatest(by1, by2))
           OR (t4 = 0 AND ax2 BETWEEN least(bx1, bx2) AND greatest(bx1, bx2) AND ay2 BETWEEN least(by1, by2) AND greatest(by1, by2)) AS touch,
           (sb - sa = 1 AND ax2 = bx1 AND ay2 = by1) OR (sb - sa = top - 1 AND ((bx2 = ax1 AND by2 = ay1) OR (ax2 = bx1 AND ay2 = by1))) AS neighbour,
           t1 = 0 AND t2 = 0 AND (ax2 - ax1) * (bx2 - bx1) + (ay2 - ay1) * (by2 - by1) < 0 AS folded
    FROM pair),
  crossed AS (
    SELECT DISTINCT feature_id FROM judged
    WHERE CASE WHEN same AND neighbour THEN folded WHEN same THEN touch OR proper ELSE proper END),
  rings AS (
    SELECT feature_id, part, ring, count(*) >= 4 AND arg_min(x, seq) = arg_max(x, seq) AND arg_min(y, seq) = arg_max(y, seq)
           AND max(x) > min(x) AND max(y) > min(y) AS sound
    FROM defective GROUP BY 1, 2, 3),
  start AS (SELECT feature_id, part, ring, arg_min(x, seq) AS px, arg_min(y, seq) AS py FROM defective GROUP BY 1, 2, 3),
  inside AS (
    SELECT s.feature_id, s.part, s.ring, e.part AS b_part, e.ring AS b_ring,
           count(*) FILTER (WHERE (e.x1 > px) <> (e.x2 > px) AND e.y1 + (px - e.x1) * (e.y2 - e.y1) / (e.x2 - e.x1) > py) % 2 AS odd
    FROM start s JOIN edge e ON s.feature_id = e.feature_id AND (s.part, s.ring) <> (e.part, e.ring) GROUP BY ALL),
  misplaced AS (
    SELECT feature_id FROM inside WHERE ring > 0 AND part = b_part GROUP BY feature_id, part, ring
    HAVING coalesce(sum(odd) FILTER (WHERE b_ring = 0), 0) = 0 OR coalesce(sum(odd) FILTER (WHERE b_ring > 0), 0) > 0
    UNION SELECT feature_id FROM inside WHERE ring = 0 AND part <> b_part GROUP BY feature_id, part, b_part HAVING sum(odd) % 2 = 1)
  SELECT feature_id, bool_and(sound) AND feature_id NOT IN (SELECT feature_id FROM crossed) AND feature_id NOT IN (SELECT feature_id FROM misplaced) AS is_valid
  FROM rings GROUP BY 1"""

_MERCATOR = """
  , flat AS (SELECT feature_id, part, ring, seq, radians(x) * 6378137e0 AS x, ln(tan(pi() / 4 + radians(y) / 2)) * 6378137e0 AS y FROM vertices),
  origin AS (SELECT feature_id, arg_min(x, part * 1000000 + ring * 1000 + seq) AS ox, arg_min(y, part * 1000000 + ring * 1000 + seq) AS oy FROM flat GROUP BY 1),
  seg AS (
    SELECT feature_id, part, ring, ox, oy, x - ox AS ax, y - oy AS ay, lead(x) OVER w - ox AS bx, lead(y) OVER w - oy AS by_
    FROM flat JOIN origin USING (feature_id) WINDOW w AS (PARTITION BY feature_id, part, ring ORDER BY seq)),
  ring_sum AS (
    SELECT feature_id, ring, any_value(ox) AS ox, any_value(oy) AS oy, sum(ax * by_ - bx * ay) AS a,
           sum((ax + bx) * (ax * by_ - bx * ay)) AS mx, sum((ay + by_) * (ax * by_ - bx * ay)) AS my
    FROM seg WHERE bx IS NOT NULL GROUP BY feature_id, part, ring),
  total AS (
    SELECT feature_id, any_value(ox) AS ox, any_value(oy) AS oy, sum(w * a) AS a, sum(w * mx) AS mx, sum(w * my) AS my
    FROM (SELECT *, sign(a) * CASE WHEN ring = 0 THEN 1 ELSE -1 END AS w FROM ring_sum) GROUP BY 1),
  centre AS (
    SELECT feature_id, round(degrees(atan(exp((oy + my / (3 * a)) / 6378137e0)) * 2 - pi() / 2), 8) AS latitude,
           round(degrees((ox + mx / (3 * a)) / 6378137e0), 8) AS longitude
    FROM total)"""


_SIMPLIFY = """
  , far AS (
    SELECT feature_id, part, ring, lo, hi, seq AS c, d
    FROM (
      SELECT *, sqrt(ex * ex + ey * ey) AS d
      FROM (
        SELECT *, x - lx - t * dx AS ex, y - ly - t * dy AS ey
        FROM (
          SELECT *, greatest(0e0, least(1e0, coalesce(CASE WHEN dx * dx + dy * dy <> 0 THEN ((x - lx) * dx + (y - ly) * dy) / (dx * dx + dy * dy) END, 0e0))) AS t
          FROM (
            SELECT a.feature_id, a.part, a.ring, a.seq AS lo, b.seq AS hi, v.seq, v.x, v.y, a.x AS lx, a.y AS ly, b.x - a.x AS dx, b.y - a.y AS dy
            FROM vertices a JOIN vertices b ON a.feature_id = b.feature_id AND a.part = b.part AND a.ring = b.ring AND a.seq < b.seq
            JOIN vertices v ON a.feature_id = v.feature_id AND a.part = v.part AND a.ring = v.ring AND v.seq > a.seq AND v.seq < b.seq))))
    QUALIFY row_number() OVER (PARTITION BY feature_id, part, ring, lo, hi ORDER BY d DESC, seq) = 1),
  tree AS (
    SELECT feature_id, part, ring, CAST(0 AS INTEGER) AS lo, max(seq) AS hi, 1 AS depth FROM vertices GROUP BY 1, 2, 3
    UNION ALL
    SELECT feature_id, part, ring, CASE side WHEN 0 THEN lo ELSE c END, CASE side WHEN 0 THEN c ELSE hi END, depth + 1
    FROM tree JOIN far USING (feature_id, part, ring, lo, hi), (VALUES (0), (1)) s(side)
    WHERE d > 0.03e0 OR depth = 1 OR (depth = 2 AND lo = 0)),
  cut AS (SELECT feature_id, part, ring, min(hi) FILTER (WHERE depth = 2) AS c, max(hi) AS top FROM tree GROUP BY 1, 2, 3),
  tip AS (SELECT DISTINCT feature_id, part, ring, hi AS seq FROM tree),
  thin AS (
    SELECT feature_id, part, ring, any_value(c) AS lo, any_value(top) AS hi
    FROM tip JOIN cut USING (feature_id, part, ring) GROUP BY 1, 2, 3
    HAVING count(*) FILTER (WHERE seq <= c) < 3 AND count(*) FILTER (WHERE seq > c) = 1),
  tree2 AS (
    SELECT feature_id, part, ring, lo, hi, 1 AS depth FROM thin
    UNION ALL
    SELECT feature_id, part, ring, CASE side WHEN 0 THEN lo ELSE c END, CASE side WHEN 0 THEN c ELSE hi END, depth + 1
    FROM tree2 JOIN far USING (feature_id, part, ring, lo, hi), (VALUES (0), (1)) s(side)
    WHERE d > 0.03e0 OR depth = 1),
  kept AS (
    SELECT feature_id, part, ring, lo AS seq FROM tree UNION SELECT feature_id, part, ring, hi FROM tree
    UNION SELECT feature_id, part, ring, lo FROM tree2 UNION SELECT feature_id, part, ring, hi FROM tree2)
  SELECT feature_id, part, ring, CAST(row_number() OVER (PARTITION BY feature_id, part, ring ORDER BY seq) - 1 AS INTEGER) AS seq, x, y
  FROM kept JOIN vertices USING (feature_id, part, ring, seq)"""


def _reproject() -> str:
    """Inverse transverse Mercator by the series in n, of the published parameters: GRS80, 173 degrees east, scale 0.9996."""
    beta = ("n/2 - n**2*2/3 + n**3*37/96 - n**4/360", "n**2/48 + n**3/15 - n**4*437/1440", "n**3*17/480 - n**4*37/840", "n**4*4397/161280")
    delta = ("n*2 - n**2*2/3 - n**3*2 + n**4*116/45", "n**2*7/3 - n**3*8/5 - n**4*227/45", "n**3*56/15 - n**4*136/35", "n**4*4279/630")
    xi0 = "xi" + "".join(f" - b{k} * sin({2 * k} * xi) * cosh({2 * k} * eta)" for k in range(1, 5))
    eta0 = "eta" + "".join(f" - b{k} * cos({2 * k} * xi) * sinh({2 * k} * eta)" for k in range(1, 5))
    lat = "chi" + "".join(f" + d{k} * sin({2 * k} * chi)" for k in range(1, 5))
    return f"""
      WITH n AS (SELECT 1e0 / (2 * 298.257222101e0 - 1) AS n),
      k AS (SELECT *, 0.9996e0 * 6378137e0 / (1 + n) * (1 + n**2/4 + n**4/64) AS scale,
              {', '.join(f'{x} AS b{i}' for i, x in enumerate(beta, 1))}, {', '.join(f'{x} AS d{i}' for i, x in enumerate(delta, 1))} FROM n),
      p AS (SELECT k.*, c_custkey AS id, (4750000.5e0 + (c_custkey * 91 % 1500) * 1000 - 10000000e0) / scale AS xi,
              (1100000.25e0 + (c_custkey * 37 % 1000) * 1000 - 1600000e0) / scale AS eta FROM customer, k),
      q AS (SELECT *, {xi0} AS xi0, {eta0} AS eta0 FROM p),
      r AS (SELECT *, asin(sin(xi0) / cosh(eta0)) AS chi FROM q)
      SELECT id, round(173e0 + degrees(atan2(sinh(eta0), cos(xi0))), 8) AS lng, round(degrees({lat}), 8) AS lat FROM r"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["area_flagship"] = _with("ranked") + """
      SELECT area, name, region, CAST(population AS BIGINT) AS population, total_12m, rate AS crime_rate_per_1000, crime_trend, trend_3m_change, rank_in_region
      FROM ranked"""
    q["clean_text_areas"] = _with("cleaned") + "SELECT row_no, area_key AS area FROM cleaned"
    slug = "regexp_replace(regexp_replace(regexp_replace(lower({0}), '\\(([^)]+)\\)', ' \\1', 'g'), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"
    q["slugify_names"] = _with("concordance") + f"""
      SELECT p_partkey AS id, {slug.format("(p_name || ' (' || p_brand || ')')")} AS slug FROM part
      UNION ALL SELECT -1 - row_no, {slug.format('place')} FROM concordance"""
    q["incident_codes"] = _with("cleaned") + "SELECT row_no, code FROM cleaned"
    q["month_parse"] = _with("cleaned") + "SELECT row_no, strftime(day, '%Y-%m-%d') AS month FROM cleaned"
    q["incidents_built"] = _with("incidents") + """
      SELECT event_id, suburb_id, strftime(day, '%Y-%m-%d') AS victimisation_date, code AS offence_code, division AS offence_category,
             anzsoc_group AS offence_description, block AS meshblock_code, area_key AS "AU2017_name" FROM incidents"""
    q["stream_incidents"] = _with("incidents") + """
      SELECT suburb_id, strftime(day, '%Y-%m-%d') AS victimisation_date, code AS offence_code, division AS offence_category,
             anzsoc_group AS offence_description, block AS meshblock_code, area_key AS "AU2017_name", count(*) AS n, count(*) AS n_ids
      FROM incidents GROUP BY ALL"""
    q["stream_incidents_batches"] = q["stream_incidents"]
    q["incidents_unmatched"] = _with("cleaned", "area_dim") + """
      SELECT area_key, count(*) AS n_rows FROM cleaned WHERE area_key NOT IN (SELECT area_key FROM area_dim) GROUP BY 1"""
    q["last_wins_dim"] = _with("area_dim") + "SELECT * FROM area_dim"
    q["meshblock_remap"] = _with("incidents_raw", "concordance") + """
      SELECT i.row_no, meshblock, coalesce(new_code, meshblock) AS meshblock_code
      FROM incidents_raw i LEFT JOIN (SELECT old_code, arg_max(new_code, row_no) AS new_code FROM concordance GROUP BY 1) ON meshblock = old_code"""
    q["area_block_list"] = _with("concordance") + 'SELECT au_name AS "AU2017_name", row_no AS position, new_code AS meshblock FROM concordance'
    fan = """SELECT CASE WHEN n <= 1 THEN '1' WHEN n <= 5 THEN '2-5' ELSE '>5' END AS targets, count(*) AS n_keys, '{2}' AS direction
             FROM (SELECT {0}, count(DISTINCT {1}) AS n FROM concordance GROUP BY 1) GROUP BY 1"""
    q["mapping_fanout"] = _with("concordance") + fan.format("au_name", "place", "old to new") + " UNION ALL " + fan.format("place", "au_name", "new to old")
    q["area_counts"] = _with("incidents") + "SELECT count(DISTINCT area_key) AS n_names, count(DISTINCT suburb_id) AS n_areas FROM incidents"
    q["rolling_12m"] = _with("rolling") + "SELECT * FROM rolling"
    q["monthly_counts"] = _with("months") + "SELECT area, strftime(month, '%Y-%m-%d') AS month, n FROM months"
    q["trend_3m"] = _with("trends") + "SELECT * FROM trends"
    q["peak_months"] = _with("peaks") + "SELECT * FROM peaks"
    q["breakdown_map"] = _with("codes") + "SELECT * FROM codes"
    q["area_measures"] = _with("firsts", "rolling", "trends", "peaks", "codes") + """
      SELECT f.area, total_12m, (SELECT count(*) FROM incidents i WHERE i.suburb_id = f.area) AS total_all, coalesce(recent_avg, 0e0) AS recent_avg,
             coalesce(previous_avg, 0e0) AS previous_avg, coalesce(peak_crime_months, '') AS peak_crime_months, coalesce(codes, '') AS crime_breakdown, label,
             coalesce(crime_trend, 'flat') AS crime_trend, coalesce(trend_3m_change, 0e0) AS trend_3m_change
      FROM firsts f JOIN rolling USING (area) LEFT JOIN trends USING (area) LEFT JOIN peaks USING (area) LEFT JOIN codes USING (area)"""
    q["population_exact"] = _with("area_dim", "census") + """
      SELECT area_key, CAST((SELECT arg_min(value, row_no) FROM census WHERE area = name_orig AND census_year = 2023) AS BIGINT) AS population FROM area_dim"""
    q["population_fuzzy"] = _with("area_dim", "population") + """
      SELECT area_key, name_orig, CAST(population AS BIGINT) AS population FROM area_dim JOIN population USING (name_orig)"""
    q["rate_rank"] = _with("ranked") + "SELECT area, region, rate AS crime_rate_per_1000, rank_in_region FROM ranked"
    q["areas_built"] = _with("areas") + "SELECT * FROM areas"
    q["meshblocks_built"] = _with("blocks", "concordance", "points", "wkt") + """
      SELECT b.id, b.suburb_id, b.crime_count, coalesce(l.lat, 0e0) AS lat, coalesce(l.lng, 0e0) AS lng, l.geometry
      FROM blocks b LEFT JOIN (
        SELECT c.new_code, p.lat, p.lng, CASE WHEN p.id % 9 <> 0 THEN w.wkt END AS geometry
        FROM concordance c JOIN points p ON c.row_no = p.id JOIN wkt w ON w.feature_id = p.id) l ON b.id = l.new_code"""
    q["areas_with_nearby"] = _with("neighbours") + "SELECT suburb_id, CAST(pos AS INTEGER) AS pos, near_id, slug, name, region, distance_km FROM neighbours"
    q["nearby_topk"] = _nearest("25", 3)
    q["nearby_default"] = _nearest("10", 10)
    q["area_statistics"] = _with("rated") + """
      SELECT count(*) AS n_areas, CAST(sum(least(total_12m, 32767)) AS BIGINT) AS total_crimes, round(avg(rate), 9) AS mean_rate,
             round(quantile_cont(rate, 0.25), 9) AS rate_p25, round(quantile_cont(rate, 0.5), 9) AS rate_p50, round(quantile_cont(rate, 0.75), 9) AS rate_p75,
             round(quantile_cont(CAST(least(total_12m, 32767) AS DOUBLE), 0.25), 9) AS total_p25, round(quantile_cont(CAST(least(total_12m, 32767) AS DOUBLE), 0.5), 9) AS total_p50,
             round(quantile_cont(CAST(least(total_12m, 32767) AS DOUBLE), 0.75), 9) AS total_p75
      FROM rated"""
    q["filter_areas_page"] = _with("rated") + """
      SELECT area AS suburb_id, name, rate AS crime_rate_per_1000, crime_trend FROM rated
      WHERE region = 'ASIA' AND rate >= 0.5 AND total_12m <= 5000 ORDER BY area LIMIT 10 OFFSET 10"""
    q["filter_incidents_month"] = _with("incidents") + """
      SELECT event_id, suburb_id, code AS offence_code, anzsoc_group AS offence_description, division AS offence_category,
             strftime(day, '%Y-%m-%d') AS victimisation_date, block AS meshblock_code
      FROM incidents WHERE strftime(day, '%Y-%m-%d') LIKE '1997-03%' AND code = '8' ORDER BY event_id LIMIT 25 OFFSET 25"""
    q["filter_incidents_council"] = _with("incidents", "rated") + """
      SELECT event_id, suburb_id, strftime(day, '%Y-%m-%d') AS victimisation_date FROM incidents
      WHERE suburb_id IN (SELECT area FROM rated WHERE council = 'NATION_7') AND day BETWEEN DATE '1996-02-01' AND DATE '1997-06-01'
      ORDER BY event_id LIMIT 1000"""
    detail = ("suburb_id, slug, name, region, council, lat, lng, safety_score, crime_rate_per_1000, crime_trend, total_crimes_12m, report_url, "
              "rank_in_region, crime_breakdown, trend_3m_change, population, nearby_suburbs, peak_crime_months, CAST(NULL AS VARCHAR) AS geometry")
    q["area_detail"] = _with("areas") + f"SELECT {detail} FROM areas WHERE suburb_id = '100050'"
    q["meshblocks_of_area"] = _with("blocks") + "SELECT * FROM blocks WHERE suburb_id = '100050'"
    q["area_reports"] = _with("firsts") + "SELECT area AS suburb_id, '' AS pdf_url, 'not_purchased' AS status, '' AS embed_code FROM firsts"
    q["rejects_of_build"] = _with("incidents") + """
      SELECT suburb_id, code AS offence_code, count(*) AS n, count(*) AS n_ids, 'offence_description:max_length' AS what
      FROM incidents WHERE row_no % 50 = 0 GROUP BY ALL"""
    q["rejects_written"] = q["rejects_of_build"]
    q["block_layer_scan"] = _with("concordance", "points") + """
      SELECT new_code AS id, count(*) AS n, round(min(lat), 6) AS lat, round(max(lng), 6) AS lng FROM concordance JOIN points ON row_no = id GROUP BY 1"""
    q["appended_rows"] = "SELECT c_nationkey AS nation, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM customer GROUP BY 1"
    q["csv_export"] = _with("areas") + """
      SELECT suburb_id, name, population, total_crimes_12m, crime_breakdown, peak_crime_months, crime_trend FROM areas"""
    q["stored_columns"] = _with("incidents") + "SELECT suburb_id, code AS offence_code, count(*) AS n FROM incidents GROUP BY ALL"
    q["limited_lookup"] = _with("firsts") + "SELECT area AS suburb_id, label AS \"AU2017_name\" FROM firsts WHERE area = '100050'"
    q["crimes_stored"] = _with("incidents") + """
      SELECT event_id, suburb_id, strftime(day, '%Y-%m-%d') AS victimisation_date, code AS offence_code, block AS meshblock_code FROM incidents"""
    q["metric_samples"] = _with("metrics") + "SELECT metric_name, count(*) AS n, round(sum(value), 4) AS total FROM metrics GROUP BY 1"
    q["metric_report"] = _with("metrics") + """
      SELECT split_part(metric_name, '_', 1) AS family, count(*) AS count, round(avg(value), 6) AS average, (SELECT count(*) FROM metrics) AS total_metrics_collected
      FROM metrics GROUP BY 1"""
    q["sorted_layer"] = _with("concordance") + """
      SELECT row_no AS id, place AS name, row_number() OVER (ORDER BY place, row_no) AS position FROM concordance"""
    q["category_frequency"] = _with("incidents") + """
      SELECT coalesce(division, '') AS category, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, coalesce(division, '')) AS place
      FROM incidents GROUP BY 1"""
    q["breakdown_text"] = _with("codes") + """
      SELECT area, '{' || coalesce(string_agg('"' || split_part(c, ':', 1) || '":' || split_part(c, ':', 2), ',' ORDER BY c), '') || '}' AS text, count(*) AS n_codes
      FROM (SELECT area, unnest(string_split(codes, ',')) AS c FROM codes WHERE codes <> '') GROUP BY 1"""
    q["name_matches"] = _with("names", "census") + """
      SELECT name_orig, count(*) AS n FROM names JOIN (SELECT DISTINCT area FROM census) ON contains(lower(area), lower(name_orig)) OR contains(lower(name_orig), lower(area))
      GROUP BY 1"""
    q["orders_days"] = "SELECT strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, count(*) AS n FROM orders GROUP BY 1"
    q["full_build_blocks"] = _with("blocks") + "SELECT id, suburb_id, crime_count FROM blocks"
    q["validate_incidents_split"] = _with("flawed") + """
      SELECT 'valid' AS what, count(*) AS n_rows FROM flawed WHERE suburb_id <> '' AND (division IS NULL OR length(division) <= 200)
      UNION ALL SELECT 'rejected', count(*) FROM flawed WHERE suburb_id = '' OR length(division) > 200
      UNION ALL SELECT 'suburb_id:min_length', count(*) FROM flawed WHERE suburb_id = '' HAVING count(*) > 0
      UNION ALL SELECT 'offence_category:max_length', count(*) FROM flawed WHERE length(division) > 200 HAVING count(*) > 0"""
    q["validate_areas_reasons"] = _with("points") + """
      , rows_ AS (
        SELECT CASE WHEN id % 20 = 0 THEN CAST('NaN' AS DOUBLE) WHEN id % 21 = 0 THEN NULL ELSE lat * 2.1e0 END AS lat, lng + 5 AS lng, c_acctbal AS rate,
               CASE WHEN id % 17 = 0 THEN 'sideways' ELSE 'up' END AS trend, CAST(trunc(c_acctbal) AS BIGINT) AS population
        FROM points JOIN customer ON id = c_custkey) """ + _errors("rows_", _AREA_TESTS)
    q["validate_blocks"] = """WITH rows_ AS (
        SELECT CASE WHEN p_partkey % 30 = 0 THEN '' ELSE CAST(p_partkey AS VARCHAR) END AS id, p_size - 3 AS crime_count,
               p_retailprice / 12 AS lat, p_retailprice / 6 AS lng FROM part) """ + _errors("rows_", _BLOCK_TESTS)
    q["upsert_snapshot"] = """
      WITH u AS (SELECT o_custkey * 2 AS id, arg_max(o_totalprice, o_orderkey) AS amount FROM orders GROUP BY 1)
      SELECT id, amount FROM u UNION ALL SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT id FROM u)"""
    q["tsv_scan"] = _with("incidents_raw") + """
      SELECT trim(area_unit) AS area_unit, year_month, CASE WHEN row_no % 41 <> 0 THEN meshblock END AS meshblock, division, anzsoc_group, count(*) AS n
      FROM incidents_raw GROUP BY ALL"""
    q["geojson_layer"] = _with("concordance", "points", "wkt") + """
      SELECT p.id, c.place AS name, p.lat, p.lng, w.wkt FROM concordance c JOIN points p ON c.row_no = p.id JOIN wkt w ON w.feature_id = p.id"""
    q["full_build"] = _with("areas", "neighbours") + """
      SELECT a.* EXCLUDE ("AU2017_name", nearby_suburbs), coalesce(n.near, '') AS nearby_suburbs
      FROM areas a LEFT JOIN (SELECT suburb_id, string_agg(near_id, ',' ORDER BY pos) AS near FROM neighbours GROUP BY 1) n USING (suburb_id)"""
    q["full_build_tables"] = _with("blocks", "incidents", "concordance", "points", "wkt") + """
      SELECT 'meshblocks' AS stored, b.id, b.suburb_id, b.crime_count AS n, coalesce(l.lat, 0e0) AS lat, coalesce(l.lng, 0e0) AS lng, l.geometry AS text
      FROM blocks b LEFT JOIN (
        SELECT c.new_code, p.lat, p.lng, CASE WHEN p.id % 9 <> 0 THEN w.wkt END AS geometry
        FROM concordance c JOIN points p ON c.row_no = p.id JOIN wkt w ON w.feature_id = p.id) l ON b.id = l.new_code
      UNION ALL
      SELECT 'crimes', block, suburb_id, count(*), NULL, NULL,
             coalesce(strftime(day, '%Y-%m-%d'), '') || ':' || coalesce(code, '') || ':' || coalesce(division, '') || ':' || anzsoc_group FROM incidents GROUP BY ALL"""
    q["incident_pages"] = _with("incidents") + """
      , placed AS (SELECT event_id, suburb_id, code AS offence_code, row_number() OVER (ORDER BY event_id) AS r FROM incidents)
      SELECT CASE WHEN r <= 1500 THEN 'page' ELSE 'after' END AS which, event_id, suburb_id, offence_code FROM placed WHERE r BETWEEN 1451 AND 1570"""
    q["layer_collection"] = _with("concordance", "points", "vertices") + """
      SELECT row_number() OVER (ORDER BY c.place, c.row_no) AS position, c.row_no AS id, c.place AS name, p.lat, p.lng, v.n_points
      FROM concordance c JOIN points p ON c.row_no = p.id JOIN (SELECT feature_id, count(*) AS n_points FROM vertices GROUP BY 1) v ON v.feature_id = p.id"""
    q["metric_recorded"] = _with("metrics") + """
      SELECT metric_name, round(avg(value), 6) AS value, 'ms' AS unit, count(*)::VARCHAR AS samples FROM metrics GROUP BY 1"""
    q["metric_summary"] = _with("metrics") + """
      SELECT split_part(metric_name, '_', 1) AS family, count(*) AS count, round(avg(value), 6) AS average, round(min(value), 6) AS min, round(max(value), 6) AS max,
             round(median(value), 6) AS median, round(stddev_samp(value), 6) AS std_dev
      FROM metrics GROUP BY 1"""
    q["metric_p95_exclusive"] = _with("metrics") + _exclusive_p95("metric_name", "metrics", True)
    q["endpoint_latency"] = _with("metrics") + _exclusive_p95("endpoint", "metrics", False)
    q["user_latency"] = _exclusive_p95("user_id", "events", False)
    q["metric_latest"] = _with("metrics") + "SELECT metric_name, arg_max(value, (ts, event_id)) AS value FROM metrics GROUP BY 1"
    q["metric_grades"] = _with("metrics") + f"""
      , v AS (
        SELECT avg(value) FILTER (WHERE metric_name LIKE 'api%') AS api, arg_max(value, (ts, event_id)) FILTER (WHERE metric_name LIKE '%cache_hit_rate%') AS cache,
               max(value) FILTER (WHERE metric_name LIKE 'memory%') AS memory, avg(value) FILTER (WHERE metric_name LIKE 'database%') AS db
        FROM metrics)
      SELECT 'api_response' AS subject, round(api, 6) AS value, {_grade('api', True, (50, 100, 200))} AS grade FROM v
      UNION ALL SELECT 'cache_performance', round(cache, 6), {_grade('cache', False, (95, 85, 70))} FROM v
      UNION ALL SELECT 'memory_usage', round(memory, 6), {_grade('memory', True, (1024, 2048, 4096))} FROM v
      UNION ALL SELECT 'database_performance', round(db, 6), {_grade('db', True, (10, 50, 100))} FROM v"""
    q["throughput"] = _with("metrics") + """
      SELECT metric_name, records, round(s, 3) AS total_time_seconds, round(records / s, 3) AS records_per_second, round(records / s * 60, 3) AS records_per_minute
      FROM (SELECT metric_name, count(*) AS records, epoch(max(ts)) - epoch(min(ts)) AS s FROM metrics GROUP BY 1)"""
    q["hit_rate"] = """
      WITH c AS (SELECT ts, event_id, event_type, event_id * CASE WHEN event_type = 'click' THEN 3 ELSE 1 END AS reading FROM events),
      d AS (SELECT event_type, arg_max(reading, (ts, event_id)) - arg_min(reading, (ts, event_id)) AS d FROM c GROUP BY 1),
      w AS (SELECT CAST(max(d) FILTER (WHERE event_type = 'click') AS BIGINT) AS hits, CAST(max(d) FILTER (WHERE event_type = 'view') AS BIGINT) AS misses FROM d)
      SELECT hits, misses, hits + misses AS total_requests, round(hits / (hits + misses) * 100e0, 6) AS hit_rate_percent FROM w"""
    q["polygon_centroid"] = _with("vertices") + _MERCATOR + " SELECT * FROM centre"
    q["polygon_wkt"] = _with("wkt") + "SELECT * FROM wkt"
    q["reproject_tm"] = _reproject()
    q["ring_validity"] = _with("defective") + _VALIDITY
    q["simplify_layer"] = _with("vertices", recursive=_SIMPLIFY)
    q["sorted_batches"] = _with("concordance") + """
      SELECT row_no AS id, place AS name, (row_number() OVER (ORDER BY place, row_no) - 1) // 100 + 1 AS batch FROM concordance"""
    q["prepared_layer"] = _with("vertices", "concordance") + _MERCATOR + """
      SELECT c.row_no AS id, c.place AS name, longitude, latitude, (SELECT count(DISTINCT part) FROM vertices v WHERE v.feature_id = c.row_no) AS n_parts
      FROM concordance c JOIN centre ON feature_id = c.row_no"""
    q["stream_monthly_counts"] = """
      SELECT o_custkey % 200 AS area, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month, count(*) AS n FROM orders GROUP BY 1, 2"""
    q["stream_upsert"] = """
      SELECT o_custkey, max(o_orderkey) AS o_orderkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice FROM orders GROUP BY 1"""
    return q

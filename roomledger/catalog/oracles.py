"""The same results in plain SQL, as one would ask DuckDB for them.

Each entry is a final SELECT over named parts; the parts it needs are put in
front of it as common table expressions. Spatial parts are brute force over
all polygons.
"""

from __future__ import annotations

import re

from roomledger import fixed_values as fixed
from roomledger.catalog import queries as Q
from roomledger.catalog import standins as S


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def pick(values: list[str], index: str) -> str:
    return f"([{', '.join(map(text, values))}])[CAST({index} AS INTEGER) + 1]"


def among(values: list[str]) -> str:
    return f"({', '.join(map(text, values))})"


def pid(key: str) -> str:
    return f"((CASE WHEN {key} % 2 = 0 THEN 'ab-' ELSE 'ha-' END) || {key})"


def spot(key: str) -> str:
    return f"((({key} * 7919) % 24000) // 4800 + 5 * ((({key} * 104729) % 10000) // 2000))"


def canonical(column: str, spellings: dict[str, list[str]]) -> str:
    whens = " ".join(f"WHEN {column} IN {among(sources)} THEN {text(name)}" for name, sources in spellings.items())
    return f"CASE {whens} ELSE {column} END"


def spread(values: list[str], column: str) -> str:
    n = len(values)
    return f"""SELECT CASE WHEN o_orderkey % {n + 2} = {n} THEN NULL WHEN o_orderkey % {n + 2} = {n + 1} THEN 'Elsewhere'
        ELSE {pick(values, f'o_orderkey % {n + 2}')} END AS {column} FROM orders"""


def islands(source: str, keys: str, attributes: str, month: bool = False) -> str:
    """Ranges of consecutive dates with equal attributes."""
    group = ", ".join(x for x in (keys, attributes) if x)
    per_month = ", date_trunc('month', date)" if month else ""
    return f"""SELECT {group}, min(date) AS start_date, max(date) AS end_date
        FROM (SELECT *, date - CAST(row_number() OVER (PARTITION BY {group} ORDER BY date) AS INTEGER) AS island FROM {source})
        GROUP BY {group}, island{per_month}"""


def exception(scrape: str, geo: str, region: str) -> str:
    """The chain of country exceptions as nested CASEs: equations are null-strict, membership in a list is never null."""
    expression = scrape
    for claimed, located in fixed.COUNTRY_EXCEPTIONS.items():
        among_them = f"{geo} IN {among(located)}" if len(located) == 1 else f"coalesce({geo} IN {among(located)}, false)"
        test = f"({expression} = {text(claimed)} AND {among_them})"
        expression = f"(CASE WHEN {test} THEN {geo} WHEN NOT {test} THEN {expression} END)"
    test = f"({expression} = 'China' AND {geo} = 'Taiwan' AND {region} = 'Fujian')"
    expression = f"(CASE WHEN {test} THEN {geo} WHEN NOT {test} THEN {expression} END)"
    return f"(CASE WHEN {expression} = {text(fixed.BONAIRE_SCRAPED)} THEN {text(fixed.BONAIRE)} ELSE {expression} END)"


def rings(dx: int, dy: int) -> str:
    """Nation rings as edges in longitude and latitude."""
    return f"""SELECT name, unnest([{{a: x0, b: y0, c: x0 + 44, d: y0}}, {{a: x0 + 44, b: y0, c: x0 + 44, d: y0 + 17}},
            {{a: x0 + 44, b: y0 + 17, c: x0 + 22, d: y0 + 9}}, {{a: x0 + 22, b: y0 + 9, c: x0, d: y0 + 17}},
            {{a: x0, b: y0 + 17, c: x0, d: y0}}]) AS e
        FROM (SELECT {pick(S.NATIONS, 'n_nationkey')} AS name, CAST(-120 + 48 * (n_nationkey % 5) + {dx} AS DOUBLE) AS x0,
            CAST(-50 + 20 * (n_nationkey // 5) + {dy} AS DOUBLE) AS y0 FROM nation)"""


def mx(lon: str) -> str:
    return f"(radians({lon}) * 6378137.0::DOUBLE)"


def my(lat: str) -> str:
    return f"(ln(tan(radians({lat}) / 2 + 0.7853981633974483::DOUBLE)) * 6378137.0::DOUBLE)"


def measured(points: str, edges: str, match: str = "true") -> str:
    """Every point against every polygon: inside and distance, by brute force."""
    t = "greatest(0, least(1, ((p.x - e.x1) * (e.x2 - e.x1) + (p.y - e.y1) * (e.y2 - e.y1)) / ((e.x2 - e.x1) ** 2 + (e.y2 - e.y1) ** 2)))"
    return f"""SELECT property_ID, layer, name, odd OR away <= 1e-6 AS inside,
            CASE WHEN odd OR away <= 1e-6 THEN 0 ELSE away END AS distance
        FROM (SELECT property_ID, layer, name,
            sum(CASE WHEN (e.y1 > p.y) <> (e.y2 > p.y) AND p.x < e.x1 + (p.y - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1) THEN 1 ELSE 0 END) % 2 = 1 AS odd,
            min(sqrt((e.x1 + {t} * (e.x2 - e.x1) - p.x) ** 2 + (e.y1 + {t} * (e.y2 - e.y1) - p.y) ** 2)) AS away
            FROM {points} p JOIN {edges} e ON {match} GROUP BY ALL)"""


def hull(points: str, keys: list[str]) -> str:
    """Directed hull edges a -> b: nothing to their right, nothing on the line beyond them."""
    on = " AND ".join(f"a.{k} IS NOT DISTINCT FROM b.{k}" for k in keys)
    onc = " AND ".join(f"c.{k} IS NOT DISTINCT FROM a.{k}" for k in keys)
    cross = "(b.x - a.x) * (c.y - a.y) - (b.y - a.y) * (c.x - a.x)"
    along = "(b.x - a.x) * (c.x - a.x) + (b.y - a.y) * (c.y - a.y)"
    listed = ", ".join(f"a.{k}" for k in keys)
    return f"""SELECT {listed}, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM {points} a JOIN {points} b
        ON {on} AND (a.x <> b.x OR a.y <> b.y)
        WHERE NOT EXISTS (SELECT 1 FROM {points} c WHERE {onc} AND ({cross} < 0 OR ({cross} = 0
            AND ({along} < 0 OR {along} > (b.x - a.x) ** 2 + (b.y - a.y) ** 2))))"""


def corners(points: str, edges: str, keys: list[str]) -> str:
    """Hull corners: starts of hull edges, and points that are alone in their group."""
    listed = ", ".join(keys)
    return f"""SELECT DISTINCT {listed}, x1 AS x, y1 AS y FROM {edges}
        UNION ALL SELECT {listed}, min(x), min(y) FROM {points} GROUP BY {listed} HAVING count(*) = 1"""


REGION_CASE = f"""CASE WHEN k % 5 = 0 THEN NULL WHEN k % 17 = 0 THEN 'La Paz'
    WHEN country = 'Canada' AND k % 3 = 0 THEN {pick(fixed.PROVINCES, '(k * 5) % 13')}
    WHEN country = 'Canada' THEN {pick(fixed.PROVINCES, 'least(((k * 7919) % 4800) // 340, 12)')}
    WHEN country = 'United States' AND k % 3 = 0 THEN {pick(fixed.STATES, '(k * 5) % 51')}
    WHEN country = 'United States' THEN {pick(fixed.STATES, 'least(((k * 7919) % 4800) // 86, 50)')}
    WHEN country = 'Germany' AND k % 3 = 0 THEN 'Hamburg'
    WHEN country = 'Russia' AND k % 3 > 0 THEN {pick(S.OKRUGS, 'k % 8')}
    WHEN spot = 7 AND k % 4 = 1 THEN 'Fujian' ELSE 'Region ' || (k % 6) END"""

RUSSIA = canonical("region", fixed.REGION_SPELLINGS["Russia"])
HARMONIZED = f"CASE WHEN country = 'Germany' AND region = 'Hamburg' THEN 'Hamburg (Landmasse)' WHEN country = 'Russia' THEN {RUSSIA} ELSE region END"
SCRAPED_REGION = f"""CASE WHEN r.country = 'Canada' THEN {canonical('s.region', fixed.PROVINCE_SPELLINGS)}
    WHEN r.country = 'United States' THEN {canonical('s.region', fixed.STATE_SPELLINGS)} ELSE s.region END"""

PARTS = {
    "v_listings": f"""SELECT {pid('k')} AS property_ID, coalesce(ab_host, ha_host) AS host_ID, k, spot, property_type, listing_type,
        CASE WHEN k % 7 = 0 THEN NULL ELSE DATE '2024-01-01' + CAST(k % 20 AS INTEGER) END AS created,
        CASE WHEN k % 11 = 0 THEN NULL ELSE DATE '2024-01-12' + CAST(k % 25 AS INTEGER) END AS scraped,
        property_type IN ('Apartment', 'House', 'Villa') AS housing,
        -50 + CAST((k * 104729) % 10000 AS DOUBLE) / 100 AS latitude, -120 + CAST((k * 7919) % 24000 AS DOUBLE) / 100 AS longitude,
        country, {REGION_CASE} AS region, CASE WHEN k % 9 = 0 THEN NULL ELSE 'City ' || (k % 20) END AS city, ab_host, ha_host
        FROM (SELECT k, spot, listing_type,
            CASE WHEN k % 53 = 0 THEN NULL WHEN k % 2 = 0 OR k % 6 = 1 THEN 'a' || hn END AS ab_host,
            CASE WHEN k % 53 = 0 THEN NULL WHEN k % 2 = 1 OR k % 8 = 0 THEN 'm' || (hn - hn % 2) END AS ha_host,
            CASE WHEN k % 13 = 0 THEN NULL WHEN k % 2 = 0 THEN {pick(S.NATIONS, 'spot')} ELSE {pick(S.NATIONS, 'nation')} END AS country,
            {pick(['Apartment', 'House', 'Hotel', 'Hostel', 'Villa'], 'k % 5')} AS property_type
            FROM (SELECT c_custkey AS k, c_nationkey AS nation, c_mktsegment AS listing_type, {spot('c_custkey')} AS spot,
                CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE c_custkey // 4 END AS hn FROM customer))""",
    "v_raw": f"""SELECT CASE WHEN c_custkey % 97 = 5 THEN NULL WHEN c_custkey % 89 = 4 THEN 'xx-' || c_custkey ELSE {pid('c_custkey')} END AS property_ID,
        '"T''' || c_custkey || chr(10) || c_mktsegment || chr(13) AS listing_title,
        CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE c_mktsegment END AS listing_type,
        c_custkey % 23 = 0 OR c_custkey % 29 = 0 AS nowhere,
        CASE WHEN c_custkey % 3 = 0 THEN 'a' || (c_custkey % 40) END AS ab_host,
        CASE WHEN c_custkey % 4 > 0 THEN 'm' || (c_custkey % 40) END AS ha_host,
        c_custkey % 19 = 0 AS parse_error FROM customer""",
    "v_raw_routed": """SELECT *, replace(replace(replace(replace(listing_title, chr(10), ''), chr(13), ''), '"', ''), '''', '') AS title,
        CASE WHEN parse_error OR property_ID IS NULL OR listing_type IS NULL OR property_ID[1:3] NOT IN ('ab-', 'ha-') THEN 'error'
            WHEN nowhere THEN 'missing_geography' ELSE 'clean' END AS route FROM v_raw""",
    "v_events": f"""SELECT event_id, CASE WHEN event_id % 89 = 0 THEN NULL WHEN user_id % 10 = 3 THEN 'ab-new' || user_id ELSE {pid('user_id')} END AS property_ID,
        CASE WHEN event_id % 101 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS date,
        CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_type = 'error' THEN 'U' WHEN event_type = 'purchase' THEN 'R' ELSE 'A' END AS status,
        CASE WHEN event_type = 'purchase' THEN DATE '2023-12-24' END AS booked_date,
        100 + CAST(user_id % 5 AS INTEGER) * 10 AS price,
        CASE WHEN event_type = 'purchase' THEN CAST(user_id AS INTEGER) END AS res_ID FROM events""",
    "v_routed": """SELECT n.*, CASE WHEN n.property_ID IS NULL OR n.date IS NULL OR n.status IS NULL OR l.property_ID IS NULL THEN 'error'
        WHEN n.status = 'U' OR n.date < l.created OR n.date > l.scraped THEN 'inactive' ELSE 'active' END AS route
        FROM v_events n LEFT JOIN v_listings l ON n.property_ID = l.property_ID""",
    "v_unique": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY route, property_ID, date ORDER BY event_id DESC) AS rn
        FROM v_routed WHERE route <> 'error') WHERE rn = 1""",
    "v_active": "SELECT * FROM v_unique WHERE route = 'active'",
    "v_inactive": "SELECT * FROM v_unique WHERE route = 'inactive'",
    "v_enriched": "SELECT n.property_ID, n.date, n.status, n.price, l.host_ID, l.listing_type, l.housing, l.country, l.region, l.city FROM v_active n LEFT JOIN v_listings l ON n.property_ID = l.property_ID",
    "v_active_islands": islands("v_active", "property_ID", "status, booked_date, price, res_ID"),
    "v_inactive_islands": islands("v_inactive", "property_ID", "status, booked_date, price, res_ID"),
    "v_active_ranges": "SELECT r.*, l.host_ID, l.listing_type, l.housing, l.country, l.region, l.city FROM v_active_islands r LEFT JOIN v_listings l ON r.property_ID = l.property_ID",
    "v_inactive_ranges": "SELECT r.*, l.host_ID, l.listing_type, l.housing, l.country, l.region, l.city FROM v_inactive_islands r LEFT JOIN v_listings l ON r.property_ID = l.property_ID",
    "v_host_counts": "SELECT host_ID, listing_type, housing, date, count(*) AS count FROM v_enriched GROUP BY ALL",
    "v_ml": "SELECT host_ID, listing_type, date, count(*) AS count FROM v_enriched GROUP BY ALL",
    "v_host_inactive_counts": "SELECT l.host_ID, l.listing_type, l.housing, n.date, count(*) AS count FROM v_inactive n LEFT JOIN v_listings l ON n.property_ID = l.property_ID GROUP BY ALL",
    "v_suppliers": f"""SELECT {pid('s_suppkey')} AS property_ID, CASE WHEN s_suppkey % 3 = 0 THEN 'h0' ELSE 'h' || (s_suppkey // 4) END AS host_ID,
        {pick(S.SEGMENTS, 's_suppkey % 5')} AS listing_type, s_suppkey % 4 < 2 AS housing, DATE '1995-03-01' AS created,
        CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE DATE '2001-06-30' END AS scraped, {pick(S.NATIONS, 's_nationkey')} AS country,
        'Region ' || (s_suppkey % 6) AS region, 'City ' || (s_suppkey % 20) AS city FROM supplier""",
    "v_shipments": f"""SELECT {pid('l_suppkey')} AS property_ID, CAST(l_shipdate AS DATE) AS date,
        CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'U' WHEN l_returnflag = 'R' THEN 'R' ELSE 'A' END AS status,
        CAST(NULL AS DATE) AS booked_date, 100 + CAST(l_suppkey % 5 AS INTEGER) * 10 AS price, CAST(NULL AS INTEGER) AS res_ID FROM lineitem""",
    "v_shipped": """SELECT n.property_ID, n.date, max(n.status) AS status, any_value(n.price) AS price FROM v_shipments n
        JOIN v_suppliers l ON n.property_ID = l.property_ID
        WHERE n.status <> 'U' AND NOT coalesce(n.date < l.created OR n.date > l.scraped, false) GROUP BY ALL""",
    "v_shipped_islands": islands("v_shipped", "property_ID", "status, price"),
    "v_shipped_hosts": "SELECT l.host_ID, l.listing_type, l.housing, n.date, count(*) AS count FROM v_shipped n JOIN v_suppliers l ON n.property_ID = l.property_ID GROUP BY ALL",
    "v_shipped_host_ranges": islands("v_shipped_hosts", "host_ID, listing_type, housing", "count"),
    "v_shipment_nights": "SELECT property_ID, date, max(status) AS status, any_value(price) AS price FROM v_shipments GROUP BY ALL",
    "v_history": f"""SELECT {pid('o_custkey')} AS property_ID, CAST(o_orderdate AS DATE) AS start_date,
        CAST(o_orderdate AS DATE) + CAST(o_orderkey % 10 AS INTEGER) AS end_date,
        CASE WHEN o_orderstatus = 'F' THEN 'U' ELSE 'A' END AS status, o_orderpriority = '5-LOW' AS added FROM orders""",
    "v_history_nights": """SELECT l.host_ID, l.listing_type, l.housing, added, CAST(unnest(generate_series(start_date, end_date, INTERVAL 1 DAY)) AS DATE) AS date
        FROM v_history h LEFT JOIN v_listings l ON h.property_ID = l.property_ID""",
    "v_merged_counts": "SELECT host_ID, listing_type, housing, date, count(*) AS count FROM v_history_nights GROUP BY ALL",
    "v_merged": islands("v_merged_counts", "host_ID, listing_type, housing", "count"),
    "v_later": """SELECT property_ID, created, scraped FROM v_listings UNION ALL
        SELECT DISTINCT 'ab-new' || user_id, CASE WHEN user_id % 20 = 3 THEN NULL ELSE DATE '2024-01-05' END, DATE '2024-01-25' FROM events WHERE user_id % 10 = 3""",
    # the monthly plans: of a night's copies the greatest by its own columns
    "v_plan_unique": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY route, property_ID, date
        ORDER BY status DESC, booked_date DESC NULLS LAST, price DESC, res_ID DESC NULLS LAST) AS rn FROM v_routed WHERE route <> 'error') WHERE rn = 1""",
    "v_plan_hosts": """SELECT n.route, l.host_ID, l.listing_type, l.housing, n.date, count(*) AS count
        FROM v_plan_unique n LEFT JOIN v_listings l ON n.property_ID = l.property_ID GROUP BY ALL""",
    "v_plan_gaps": """SELECT property_ID FROM v_events WHERE property_ID IS NOT NULL GROUP BY property_ID
        HAVING max(date) - min(date) + 1 > count(DISTINCT date) OR count(date) > count(DISTINCT date)""",
    "v_replay_nights": "SELECT e.* EXCLUDE (route) FROM v_routed e WHERE route = 'error' AND property_ID IN (SELECT property_ID FROM v_later)",
    "v_replay_first": "SELECT property_ID, min(date) AS first_active FROM v_replay_nights WHERE status <> 'U' GROUP BY ALL",
    "v_replay_dated": """SELECT l.property_ID, l.scraped,
            CASE WHEN (l.created IS NULL OR l.scraped IS NULL) AND f.first_active IS NOT NULL THEN f.first_active ELSE l.created END AS created
        FROM v_later l LEFT JOIN v_replay_first f ON l.property_ID = f.property_ID""",
    "v_replay_unique": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY route, property_ID, date
            ORDER BY status DESC, booked_date DESC NULLS LAST, price DESC, res_ID DESC NULLS LAST) AS rn FROM (
        SELECT n.*, CASE WHEN n.status = 'U' OR n.date < l.created OR n.date > l.scraped THEN 'inactive' ELSE 'active' END AS route
        FROM v_replay_nights n JOIN v_replay_dated l ON n.property_ID = l.property_ID WHERE n.date IS NOT NULL AND n.status IS NOT NULL)) WHERE rn = 1""",
    "v_replay_property": """SELECT l.property_ID,
            CASE WHEN (l.created IS NULL OR l.scraped IS NULL) AND f.first_active IS NOT NULL THEN f.first_active ELSE l.created END AS created, l.scraped
        FROM v_later l LEFT JOIN v_replay_first f ON l.property_ID = f.property_ID""",
    # a month's nights as if all listings had been known when it came
    "v_known_nights": """SELECT route, property_ID, date, status, booked_date, price, res_ID FROM v_plan_unique
        UNION ALL SELECT route, property_ID, date, status, booked_date, price, res_ID FROM v_replay_unique""",
    "v_known_hosts": """SELECT n.route, l.host_ID, l.listing_type, l.housing, n.date, count(*) AS count FROM v_known_nights n JOIN (
            SELECT property_ID, host_ID, listing_type, housing FROM v_listings UNION ALL
            SELECT DISTINCT 'ab-new' || user_id, 'a' || user_id, 'BUILDING', user_id % 4 < 2 FROM events WHERE user_id % 10 = 3
        ) l ON n.property_ID = l.property_ID GROUP BY ALL""",
    "v_replay_left": """SELECT property_ID, date, CASE WHEN property_ID IS NULL THEN 'no listing id' WHEN date IS NULL THEN 'no date'
            WHEN status IS NULL THEN 'no status' ELSE 'unknown listing' END AS reason
        FROM v_routed WHERE route = 'error' AND (property_ID IS NULL OR date IS NULL OR status IS NULL OR property_ID NOT IN (SELECT property_ID FROM v_later))""",
    "v_history_bounds": "SELECT property_ID, min(start_date) AS first_start, max(end_date) AS last_end FROM v_history WHERE status <> 'U' GROUP BY ALL",
    "v_first_active": "SELECT property_ID, min(date) AS first_active, max(date) AS last_active FROM v_events WHERE status <> 'U' GROUP BY ALL",
    "v_scrapes": f"""SELECT {pid('k')} AS property_ID, 'Town ' || (o % 5) AS city,
        CASE WHEN o % 7 = 0 THEN NULL WHEN si = 0 AND o % 3 = 0 THEN {pick(S.PROVINCE_TEXTS, f'o % {len(S.PROVINCE_TEXTS)}')}
            WHEN si = 0 THEN {pick(fixed.PROVINCES, 'least(((k * 7919) % 4800) // 340, 12)')}
            WHEN si = 1 AND o % 3 = 0 THEN {pick(S.STATE_TEXTS, f'o % {len(S.STATE_TEXTS)}')}
            WHEN si = 1 THEN {pick(fixed.STATES, 'least(((k * 7919) % 4800) // 86, 50)')} ELSE 'Region ' || (o % 6) END AS region,
        CASE WHEN o % 29 = 0 THEN 'CHECK ' || (o % 7) WHEN o % 37 = 0 THEN NULL WHEN si = 19 THEN 'Bonaire Sint Eustatius and Saba'
            WHEN o % 2 = 0 AND si = 3 THEN 'France' WHEN o % 2 = 0 AND si = 5 THEN 'United Kingdom'
            WHEN o % 2 = 0 AND si = 7 THEN 'China' WHEN o % 2 = 0 AND si = 20 THEN 'United States' ELSE {pick(S.NATIONS, 'si')} END AS country,
        CASE WHEN state = 'P' THEN NULL ELSE 'raw' || o END AS raw, CASE WHEN o % 41 = 0 THEN NULL ELSE day END AS date
        FROM (SELECT o_orderkey AS o, o_custkey AS k, o_orderstatus AS state, CAST(o_orderdate AS DATE) AS day,
            ({spot('o_custkey')} + CASE WHEN o_orderkey % 10 < 6 THEN 0 ELSE o_orderkey % 5 END) % 25 AS si FROM orders)""",
    "v_dedup": """SELECT property_ID, city, region, country, raw, date FROM (SELECT *, row_number() OVER (
        PARTITION BY property_ID, city, region, country ORDER BY date DESC NULLS LAST, raw) AS rn FROM v_scrapes WHERE raw IS NOT NULL) WHERE rn = 1""",
    "v_single": """SELECT property_ID, country AS country_scrape, region AS region_scrape, city AS city_scrape FROM (SELECT *, row_number() OVER (
        PARTITION BY property_ID ORDER BY date DESC NULLS LAST, country DESC NULLS LAST, region DESC NULLS LAST, city DESC NULLS LAST) AS rn
        FROM v_scrapes WHERE raw IS NOT NULL) WHERE rn = 1""",
    "v_region_list": f"SELECT region FROM v_suppliers UNION SELECT unnest([{', '.join(map(text, fixed.PROVINCES + fixed.STATES))}])",
    "v_locations": """SELECT property_ID, latitude + CASE WHEN k % 4 = 0 THEN 1e-6 ELSE 0 END AS latitude, longitude,
        coalesce(country, 'Ghana') AS country, 'Region 9' AS region, city FROM v_listings""",
    "v_recent": "SELECT * FROM v_scrapes WHERE property_ID LIKE 'ab-%' AND date >= DATE '2001-03-01'",
    "v_reused": """SELECT l.property_ID, t.country, t.region, t.city FROM v_listings l JOIN v_locations t
        ON l.property_ID = t.property_ID AND l.latitude = t.latitude AND l.longitude = t.longitude
        WHERE (l.region IS NULL OR l.region IN (SELECT region FROM v_region_list)) AND l.property_ID NOT IN (SELECT property_ID FROM v_recent)""",
    "v_worklist": """SELECT property_ID, CAST(created - INTERVAL 284 MONTH AS DATE) AS created FROM v_listings
        WHERE property_ID NOT IN (SELECT property_ID FROM v_scrapes WHERE date >= DATE '2000-05-28')""",
    "v_numbered": """SELECT *, sum(n_first) OVER (PARTITION BY 1) AS first_pool FROM (
        SELECT property_ID, priority, row_number() OVER (PARTITION BY priority ORDER BY substr(md5(property_ID), 1, 3), property_ID) AS n,
            CASE WHEN priority = 1 THEN 1 ELSE 0 END AS n_first
        FROM (SELECT property_ID, CASE WHEN created >= DATE '2000-05-01' THEN 1 ELSE 2 END AS priority FROM v_worklist))""",
    # geometry
    "v_points": f"SELECT property_ID, country, region, city, {mx('longitude')} AS x, {my('latitude')} AS y FROM v_listings",
    "v_main_edges": rings(0, 0),
    "v_alt_edges": rings(5, 4),
    "v_edges": f"""SELECT layer, name, {mx('e.a')} AS x1, {my('e.b')} AS y1, {mx('e.c')} AS x2, {my('e.d')} AS y2
        FROM (SELECT 'main' AS layer, * FROM v_main_edges UNION ALL SELECT 'alternative', * FROM v_alt_edges)""",
    "v_measured": measured("v_points", "v_edges"),
    "v_hits": "SELECT * FROM v_measured WHERE distance <= 5000",
    "v_candidates": """SELECT h.*, CASE WHEN layer = 'main' AND inside AND name = p.country THEN 1 WHEN layer = 'main' AND inside THEN 2
        WHEN layer = 'main' THEN 3 WHEN inside THEN 4 ELSE 5 END AS pass FROM v_hits h JOIN v_points p ON h.property_ID = p.property_ID""",
    "v_best": "SELECT property_ID, pass, name FROM (SELECT *, row_number() OVER (PARTITION BY property_ID ORDER BY pass, distance, name) AS rn FROM v_candidates) WHERE rn = 1",
    "v_geocoded": "SELECT p.*, b.pass AS geo_pass, b.name AS country_geo FROM v_points p LEFT JOIN v_best b ON p.property_ID = b.property_ID",
    "v_scrape_compared": f"SELECT g.*, {exception('s.country_scrape', 'g.country_geo', 'g.region')} AS country_scrape FROM v_geocoded g LEFT JOIN v_single s ON g.property_ID = s.property_ID",
    "v_validated": """SELECT c.*, coalesce(country_scrape <> country_geo, false) AND EXISTS (SELECT 1 FROM v_hits h
        WHERE h.property_ID = c.property_ID AND h.name = c.country_scrape) AS scrape_valid FROM v_scrape_compared c""",
    "v_resolved": """SELECT property_ID, x, y, final AS country, CASE WHEN final IS NOT NULL THEN region END AS region, CASE WHEN final IS NOT NULL THEN city END AS city
        FROM (SELECT *, CASE WHEN scrape_valid THEN country_scrape ELSE country_geo END AS final FROM v_validated)""",
    "v_strips": f"""SELECT layer, name, unnest([{{a: xa, b: ya, c: xb, d: ya}}, {{a: xb, b: ya, c: xb, d: yb}}, {{a: xb, b: yb, c: xa, d: yb}}, {{a: xa, b: yb, c: xa, d: ya}}]) AS e
        FROM (SELECT layer, CASE WHEN n = 0 THEN {pick(fixed.PROVINCES, 'least(i, 12)')} ELSE {pick(fixed.STATES, 'i')} END AS name,
            x0 + CAST(CASE WHEN n = 0 THEN i * 340 ELSE i * 86 END AS DOUBLE) / 100 AS xa,
            x0 + CAST(CASE WHEN n = 0 THEN i * 340 + 320 ELSE i * 86 + 80 END AS DOUBLE) / 100 AS xb,
            CAST(-50 AS DOUBLE) AS ya, CAST(-33 AS DOUBLE) AS yb
            FROM (SELECT {pick(S.NATIONS, 'n_nationkey')} AS layer, n_nationkey AS n, CAST(-120 + 48 * n_nationkey AS DOUBLE) AS x0,
                unnest(range(CASE WHEN n_nationkey = 0 THEN 13 ELSE 51 END)) AS i FROM nation WHERE n_nationkey < 2))""",
    "v_strip_edges": f"SELECT layer, name, {mx('e.a')} AS x1, {my('e.b')} AS y1, {mx('e.c')} AS x2, {my('e.d')} AS y2 FROM v_strips",
    "v_strip_measured": measured("v_resolved", "v_strip_edges", "p.country = e.layer"),
    "v_strip_best": "SELECT property_ID, name FROM (SELECT *, row_number() OVER (PARTITION BY property_ID ORDER BY distance, name) AS rn FROM v_strip_measured) WHERE rn = 1",
    "v_region_compared": f"""SELECT r.*, b.name AS region_geo, {SCRAPED_REGION} AS region_scrape
        FROM v_resolved r JOIN v_strip_best b ON r.property_ID = b.property_ID
        LEFT JOIN (SELECT property_ID, region_scrape AS region FROM v_single) s ON r.property_ID = s.property_ID""",
    "v_agreement": "SELECT *, coalesce((region = region_geo AND region = region_scrape) OR (region_scrape IS NULL AND region = region_geo), false) AS agrees FROM v_region_compared",
    "v_region_valid": """SELECT a.*, NOT agrees AND EXISTS (SELECT 1 FROM v_strip_measured m WHERE m.property_ID = a.property_ID
        AND m.name = a.region_scrape AND m.distance <= 5000) AS scrape_valid FROM v_agreement a""",
    "v_written": """SELECT property_ID, country, CASE WHEN agrees THEN region WHEN scrape_valid THEN region_scrape ELSE region_geo END AS region,
        CASE WHEN scrape_valid THEN NULL ELSE city END AS city FROM v_region_valid
        UNION ALL SELECT property_ID, country, region, city FROM v_resolved WHERE country IS NULL OR country NOT IN ('Canada', 'United States')""",
    "v_written_coverage": f"""SELECT country FROM v_written GROUP BY country HAVING count(region) > 0
        AND (country IS NULL OR country NOT IN {among(fixed.REGION_WHITELIST)})""",
    "v_purged": f"""SELECT property_ID, country, {HARMONIZED} AS region, city FROM (
        SELECT w.property_ID, w.country, CASE WHEN hit THEN NULL ELSE region END AS region, CASE WHEN hit THEN NULL ELSE city END AS city
        FROM (SELECT *, region IS NOT NULL AND EXISTS (SELECT 1 FROM v_written_coverage c WHERE c.country IS NOT DISTINCT FROM v_written.country) AS hit FROM v_written) w)""",
    "v_purged_losers": f"""SELECT region, country FROM (SELECT *, max(n) OVER (PARTITION BY region) AS most, count(*) OVER (PARTITION BY region) AS countries
        FROM (SELECT region, country, count(*) AS n FROM v_purged WHERE region IS NOT NULL AND region NOT IN {among(fixed.SHARED_REGIONS)} GROUP BY ALL))
        WHERE countries >= 2 AND n < most""",
    "v_losers": f"""SELECT * FROM (SELECT *, max(n) OVER (PARTITION BY region) AS most, count(*) OVER (PARTITION BY region) AS countries
        FROM (SELECT region, country, count(*) AS n FROM v_listings WHERE region IS NOT NULL AND region NOT IN {among(fixed.SHARED_REGIONS)} GROUP BY ALL))
        WHERE countries >= 2 AND n < most""",
    "v_coverage": f"""SELECT country, avg(CASE WHEN region IS NULL THEN 0 ELSE 1 END) AS region_pct FROM v_listings GROUP BY country
        HAVING count(region) > 0 AND (country IS NULL OR country NOT IN {among(fixed.REGION_WHITELIST)})""",
    # hulls on integer coordinates
    "v_hull_points": f"""SELECT {pid('c_custkey')} AS property_ID, CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE {pick(S.NATIONS, 'c_nationkey')} END AS country,
        CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN 'Old Town' ELSE c_mktsegment END AS region,
        'City ' || (c_custkey % 4) AS city, (c_custkey * 7919) % 1009 AS x, (c_custkey * 104729) % 997 AS y FROM customer""",
    "v_old_points": f"""SELECT DISTINCT {pick(S.NATIONS, 's_nationkey')} AS country, {pick(S.SEGMENTS, 's_suppkey % 5')} AS region,
        (s_suppkey * 6151) % 1213 - 100 AS x, (s_suppkey * 3079) % 1103 - 50 AS y FROM supplier""",
    "v_hullable": "SELECT * FROM v_hull_points WHERE region IS NOT NULL AND (country IS NULL OR country NOT IN ('Canada', 'United States'))",
    "v_update_points": """SELECT * FROM v_old_points UNION SELECT country, region, x, y FROM v_hullable
        WHERE (country, region) IN (SELECT (country, region) FROM v_old_points)""",
    "v_update_edges": hull("v_update_points", ["country", "region"]),
    "v_add_keys": "SELECT country, region FROM v_hullable WHERE region NOT IN (SELECT region FROM v_old_points) GROUP BY ALL HAVING count(*) >= 8",
    "v_add_points": """SELECT DISTINCT p.country, p.region, p.x, p.y FROM v_hull_points p JOIN v_add_keys k
        ON p.country IS NOT DISTINCT FROM k.country AND p.region = k.region""",
    "v_add_edges": hull("v_add_points", ["country", "region"]),
    "v_country_points": "SELECT DISTINCT country, x, y FROM v_hull_points WHERE country IS NOT NULL",
    "v_country_edges": hull("v_country_points", ["country"]),
    "v_city_points": "SELECT DISTINCT region, city, x, y FROM v_hull_points WHERE country = 'Canada'",
    "v_city_edges": hull("v_city_points", ["region", "city"]),
    "v_old_edges": hull("v_old_points", ["country", "region"]),
    "v_old_boxes": "SELECT country, region, min(x) AS xa, max(x) AS xb, min(y) AS ya, max(y) AS yb FROM v_old_points GROUP BY ALL",
    "v_held": """SELECT p.property_ID, b.region FROM v_hull_points p JOIN v_old_boxes b
        ON p.country = b.country AND p.x BETWEEN b.xa AND b.xb AND p.y BETWEEN b.ya AND b.yb
        WHERE NOT EXISTS (SELECT 1 FROM v_old_edges e WHERE e.country = b.country AND e.region = b.region
            AND (e.x2 - e.x1) * (p.y - e.y1) - (e.y2 - e.y1) * (p.x - e.x1) < 0)""",
    "v_held_counts": "SELECT property_ID, count(*) AS n, min(region) AS region FROM v_held GROUP BY ALL",
    "v_places": f"""SELECT CASE WHEN s_suppkey % 11 = 0 THEN base WHEN s_suppkey % 4 = 0 THEN base || ' (RGM)' WHEN s_suppkey % 4 = 1 THEN base || ', Subd. A (SC)'
        WHEN s_suppkey % 4 = 2 THEN base || ' No. ' || (s_suppkey % 7) || ' (MD)' ELSE base || ' B (T)' END AS name, s_name AS part,
        (s_suppkey * 6151) % 1000 AS x0, (s_suppkey * 3079) % 1000 AS y0 FROM (SELECT *, {pick(S.NATIONS, 's_nationkey')} AS base FROM supplier)""",
    "v_place_joined": """SELECT p.property_ID, q.name AS place FROM v_hull_points p LEFT JOIN v_places q
        ON p.x BETWEEN q.x0 AND q.x0 + 30 AND p.y BETWEEN q.y0 AND q.y0 + 40""",
    "v_place_near": """SELECT property_ID, part, greatest(q.x0 - p.x, 0, p.x - q.x0 - 30) AS dx, greatest(q.y0 - p.y, 0, p.y - q.y0 - 40) AS dy
        FROM v_hull_points p JOIN v_places q ON p.x BETWEEN q.x0 - 50 AND q.x0 + 80 AND p.y BETWEEN q.y0 - 50 AND q.y0 + 90""",
    "v_place_ties": """SELECT property_ID, count(*) AS n, string_agg(part, '|' ORDER BY part) AS candidates FROM v_place_near
        WHERE dx * dx + dy * dy <= 2500 GROUP BY property_ID HAVING min(dx * dx + dy * dy) > 0""",
    # delivered files
    "v_delivered": """SELECT property_ID, '"T''' || k || chr(10) || listing_type AS listing_title, CASE WHEN k % 19 > 0 THEN created END AS created,
        latitude, region, k % 4 IN (0, 2) AS superhost, CASE WHEN k % 43 > 0 THEN false END AS instant_book,
        CASE WHEN k % 37 > 0 THEN CAST(k % 4 AS INTEGER) END AS bedrooms, CAST(NULL AS DOUBLE) AS rating, ha_host,
        k % 19 = 0 OR k % 37 = 0 OR k % 43 = 0 AS parse_error FROM v_listings""",
}

CLEAN_NAME = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(nullif(regexp_extract({0}, '^(.+) \(', 1), ''), ' No\.', ''), ' [A-Z]$', ''), ' [0-9]+$', ''), ', .*$', '')"""
NULLED = "CASE WHEN {0} THEN NULL ELSE region END AS region, CASE WHEN {0} THEN NULL ELSE city END AS city"
HOST = "host_ID, start_date, end_date, listing_type, housing, count"
DAILY = "property_ID, start_date, end_date, status, booked_date, price, res_ID, host_ID, listing_type, housing, country, region, city"
MERGED_PART = f"CASE WHEN name ~ '{fixed.MERGED_COUNTRIES['Cyprus']}' THEN 'Cyprus' WHEN name IN ('Morocco', 'Western Sahara') THEN 'Morocco' ELSE name END"
_SPELLED = [s for names in fixed.COUNTRY_SPELLINGS.values() for s in names]
_REGIONS = [*fixed.COUNTRY_BY_REGION, "United States Virgin Islands", "Lima"]
AREA = "abs(sum(CAST(x1 * y2 - x2 * y1 AS DOUBLE))) / 2"
FIRST_SET = f"""SELECT {canonical('merged', fixed.BOUNDARY_SPELLINGS)} AS name, name AS part FROM
    (SELECT name, {MERGED_PART} AS merged FROM ({spread(Q._boundary_texts(), 'name')}) WHERE name IS NOT NULL) WHERE merged NOT IN {among(fixed.BOUNDARY_DROPPED)}"""
SECOND_SET = f"SELECT {canonical('name', fixed.ALT_BOUNDARY_SPELLINGS)} AS name FROM ({spread(Q._alt_boundary_texts(), 'name')}) WHERE name IS NOT NULL"
PARTS |= {"v_first_set": FIRST_SET, "v_second_set": SECOND_SET}

SELECTS = {
    "active_ranges": f"SELECT {DAILY} FROM v_active_ranges",
    "inactive_ranges": f"SELECT {DAILY} FROM v_inactive_ranges",
    "shipment_ranges": """SELECT r.property_ID, start_date, end_date, status, CAST(NULL AS DATE) AS booked_date, price, CAST(NULL AS INTEGER) AS res_ID,
        host_ID, listing_type, housing, country, region, city FROM v_shipped_islands r JOIN v_suppliers l ON r.property_ID = l.property_ID""",
    "shipment_hosts": f"SELECT {HOST} FROM v_shipped_host_ranges",
    "compress_ranges": "SELECT * FROM v_active_islands",
    "compress_ranges_by_month": islands("v_shipment_nights", "property_ID", "status, price", month=True),
    "expand_ranges": "SELECT property_ID, date, status, price, host_ID FROM v_enriched",
    "unique_nights": "SELECT property_ID, date, status, booked_date, price, res_ID FROM v_active",
    "route_daily": "SELECT event_id, property_ID, date, route FROM v_routed",
    "daily_errors": "SELECT event_id, property_ID, date, status, booked_date, price, res_ID FROM v_routed WHERE route = 'error'",
    "enrich_daily": "SELECT property_ID, date, host_ID, listing_type, housing, country, region, city FROM v_enriched",
    "missing_rows": """SELECT * FROM (SELECT property_ID, count(date) AS count, CAST(max(date) - min(date) + 1 AS BIGINT) AS full_count,
        CAST(max(date) - min(date) + 1 AS BIGINT) - count(DISTINCT date) AS gaps, count(date) - count(DISTINCT date) AS copies
        FROM v_events WHERE property_ID IS NOT NULL GROUP BY property_ID) WHERE gaps > 0 OR copies > 0""",
    "monthly_daily_outputs": f"""SELECT CASE route WHEN 'active' THEN 'daily' ELSE 'daily_inactive' END AS output, property_ID AS id, start_date, end_date, CAST(1 AS BIGINT) AS n
            FROM ({islands('v_plan_unique', 'route, property_ID', 'status, booked_date, price, res_ID')})
        UNION ALL SELECT CASE route WHEN 'active' THEN 'host' ELSE 'host_inactive' END, host_ID, start_date, end_date, count
            FROM ({islands('v_plan_hosts', 'route, host_ID, listing_type, housing', 'count')})
        UNION ALL SELECT 'error', property_ID, date, date, 1 FROM v_routed WHERE route = 'error'
        UNION ALL SELECT 'missing_rows', property_ID, NULL, NULL, 1 FROM v_plan_gaps""",
    "replay_outputs": f"""SELECT CASE route WHEN 'active' THEN 'daily' ELSE 'daily_inactive' END AS output, property_ID AS id, start_date, end_date, CAST(NULL AS VARCHAR) AS reason
            FROM ({islands('v_replay_unique', 'route, property_ID', 'status, booked_date, price, res_ID')})
        UNION ALL SELECT 'backlog', property_ID, date, date, reason FROM v_replay_left""",
    "split_status": """SELECT property_ID, start_date, end_date, status, CASE WHEN status = 'U' THEN 'daily_inactive' ELSE 'daily' END AS stored_in FROM v_history
        UNION ALL SELECT property_ID, start_date, end_date, status, 'daily_inactive' FROM v_inactive_ranges""",
    "host_counts": "SELECT * FROM v_host_counts",
    "host_ranges": f"SELECT {HOST} FROM ({islands('v_host_counts', 'host_ID, listing_type, housing', 'count')})",
    "host_inactive_ranges": f"SELECT {HOST} FROM ({islands('v_host_inactive_counts', 'host_ID, listing_type, housing', 'count')})",
    "host_from_ranges": f"SELECT {HOST} FROM ({islands('v_host_counts', 'host_ID, listing_type, housing', 'count')})",
    "ml_counts": islands("v_ml", "host_ID, listing_type", "count"),
    "host_merge": f"SELECT {HOST} FROM v_merged",
    "semi_host": f"""SELECT {HOST} FROM v_shipped_host_ranges h WHERE EXISTS (SELECT 1 FROM v_listings l
        WHERE regexp_replace(l.host_ID, '^a', 'h') IS NOT DISTINCT FROM h.host_ID)""",
    "replay_stored": f"""SELECT CASE route WHEN 'active' THEN 'daily' ELSE 'daily_inactive' END AS output, property_ID AS id, start_date, end_date,
            CAST(1 AS BIGINT) AS n, strftime(start_date, '%Y_%m') AS year_month
            FROM ({islands('v_known_nights', 'route, property_ID', 'status, booked_date, price, res_ID', month=True)})
        UNION ALL SELECT CASE route WHEN 'active' THEN 'host' ELSE 'host_inactive' END, host_ID, start_date, end_date, count, strftime(start_date, '%Y_%m')
            FROM ({islands('v_known_hosts', 'route, host_ID, listing_type, housing', 'count', month=True)})
        UNION ALL SELECT 'property', property_ID, created, scraped, 1, NULL FROM v_replay_property""",
    "backlog_replay": """SELECT e.event_id, e.property_ID, e.date, CASE WHEN l.property_ID IS NULL THEN 'stays' WHEN e.date IS NULL OR e.status IS NULL THEN 'error'
        WHEN e.status = 'U' OR e.date < l.created OR e.date > l.scraped THEN 'inactive' ELSE 'active' END AS route
        FROM v_routed e LEFT JOIN v_later l ON e.property_ID = l.property_ID WHERE e.route = 'error'""",
    "orphan_accumulate": """SELECT property_ID, date, status FROM v_events e WHERE NOT EXISTS (SELECT 1 FROM v_listings l WHERE l.property_ID = e.property_ID)
        UNION ALL SELECT DISTINCT 'old-' || user_id, CAST(ts AS DATE), 'A' FROM events""",
    "cross_platform_host": """SELECT l.property_ID, l.host_ID, l.ha_host, s.linked_ab_host FROM v_listings l JOIN (
        SELECT ha_host, min(ab_host) AS linked_ab_host FROM v_listings WHERE ab_host IS NOT NULL AND ha_host IN
            (SELECT host_ID FROM v_listings WHERE ab_host IS NULL AND ha_host IS NOT NULL)
        GROUP BY ha_host HAVING count(DISTINCT ab_host) = 1) s ON l.ha_host = s.ha_host WHERE l.ab_host IS NULL""",
    "first_active": "SELECT * FROM v_first_active",
    "fill_created_hist": "SELECT l.property_ID, coalesce(created, first_start) AS created, scraped FROM v_listings l LEFT JOIN v_history_bounds b ON l.property_ID = b.property_ID",
    "fill_scraped_hist": """SELECT l.property_ID, created, coalesce(scraped, last_end) AS scraped FROM v_listings l LEFT JOIN v_history_bounds b
        ON l.property_ID = b.property_ID WHERE coalesce(scraped, last_end) IS NOT NULL""",
    "fill_created_new": "SELECT l.property_ID, coalesce(created, first_active) AS created, scraped FROM v_listings l LEFT JOIN v_first_active f ON l.property_ID = f.property_ID",
    "fill_created_backfill": """SELECT l.property_ID, CASE WHEN (created IS NULL OR scraped IS NULL) AND first_active IS NOT NULL THEN first_active ELSE created END AS created,
        scraped FROM v_listings l LEFT JOIN v_first_active f ON l.property_ID = f.property_ID""",
    "filled_dates": """SELECT l.property_ID, coalesce(created, first_start, first_active) AS created, coalesce(scraped, last_end) AS scraped
        FROM v_listings l LEFT JOIN v_history_bounds b ON l.property_ID = b.property_ID LEFT JOIN v_first_active f ON l.property_ID = f.property_ID
        WHERE coalesce(scraped, last_end) IS NOT NULL""",
    "year_month_prev": """SELECT day, strftime(day - INTERVAL 1 MONTH, '%Y_%m') AS last_month,
        strftime(date_trunc('month', day) - INTERVAL 2 MONTH, '%Y_%m') AS month_before FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)""",
    "month_bounds": """SELECT strftime(first, '%Y_%m') AS label, n, first, CAST(first + INTERVAL 1 MONTH AS DATE) AS next_first, first + 27 AS day_28
        FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS first, count(*) AS n FROM orders GROUP BY ALL)""",
    "route_property": "SELECT property_ID, listing_type, route, title FROM v_raw_routed",
    "clean_title": "SELECT title FROM v_raw_routed",
    "derive_host_id": "SELECT property_ID, CASE WHEN ab_host IS NOT NULL THEN ab_host ELSE ha_host END AS host_ID FROM v_raw",
    "derive_housing": "SELECT property_ID, property_type, property_type IN ('Apartment', 'House', 'Villa') AS private FROM v_listings",
    "platform_prefix": """SELECT property_ID LIKE 'ab-%' OR property_ID LIKE 'ha-%' AS known, property_ID LIKE 'ab-%' AS airbnb, count(*) AS n FROM v_raw GROUP BY 1, 2""",
    "country_alias": f"""SELECT country, region, n, CASE WHEN country IN {among(_SPELLED)} THEN {canonical('country', fixed.COUNTRY_SPELLINGS)}
        WHEN region IN ('Bhutan', 'Puerto Rico') THEN region WHEN region = 'United States Virgin Islands' THEN 'U.S. Virgin Islands' ELSE country END AS canonical
        FROM (SELECT country, {pick(_REGIONS, 'coalesce(length(country), 0) % 5')} AS region, count(*) AS n FROM ({spread([*_SPELLED, 'Peru'], 'country')}) GROUP BY ALL)""",
    "region_alias_ca": f"SELECT region, n, {canonical('region', fixed.PROVINCE_SPELLINGS)} AS canonical FROM (SELECT region, count(*) AS n FROM ({spread(S.PROVINCE_TEXTS, 'region')}) GROUP BY ALL)",
    "region_alias_us": f"SELECT region, n, {canonical('region', fixed.STATE_SPELLINGS)} AS canonical FROM (SELECT region, count(*) AS n FROM ({spread(S.STATE_TEXTS, 'region')}) GROUP BY ALL)",
    "region_alias_ru_de": f"SELECT country, {HARMONIZED} AS region, count(*) AS n FROM v_listings GROUP BY 1, 2",
    "boundary_name_alias": "SELECT name, part, count(*) AS n FROM v_first_set GROUP BY ALL",
    "semi_boundary_names": f"""SELECT merged AS name, name AS part, count(*) AS n FROM (SELECT name, {MERGED_PART} AS merged FROM v_second_set)
        WHERE merged <> 'Macau' AND merged IN (SELECT name FROM v_first_set) GROUP BY ALL""",
    "boundary_merge": f"SELECT {MERGED_PART} AS name, count(DISTINCT name) AS parts FROM ({spread(Q._alt_boundary_texts(), 'name')}) WHERE name IS NOT NULL GROUP BY 1",
    "boundary_dissolve": """WITH squares AS (
            SELECT 'Land ' || (s_suppkey % 20 // 7) AS name, CAST(s_suppkey % 20 * 10 AS BIGINT) AS x, CAST(s_suppkey // 20 * 10 AS BIGINT) AS y FROM supplier
        ), sides AS (
            SELECT name, x AS x1, y AS y1, x + 10 AS x2, y AS y2 FROM squares UNION ALL SELECT name, x, y + 10, x + 10, y + 10 FROM squares
            UNION ALL SELECT name, x, y, x, y + 10 FROM squares UNION ALL SELECT name, x + 10, y, x + 10, y + 10 FROM squares
        ) SELECT name, x1, y1, x2, y2 FROM sides GROUP BY ALL HAVING count(*) = 1""",
    "boundary_active": "SELECT DISTINCT name FROM v_main_edges WHERE name IN (SELECT country FROM v_listings)",
    "country_exception": f"""SELECT country, geo, supplied, n, {exception('country', 'geo', 'supplied')} AS after FROM (
        SELECT s.country, l.country AS geo, l.region AS supplied, count(*) AS n FROM v_scrapes s JOIN v_listings l ON s.property_ID = l.property_ID GROUP BY ALL)""",
    "concat_key": "SELECT DISTINCT country || ', ' || region AS country_region FROM v_listings WHERE country IS NOT NULL AND region IS NOT NULL",
    "contains_flag": "SELECT country, count(*) AS n FROM v_scrapes WHERE country LIKE '%CHECK%' GROUP BY ALL",
    "clean_place_name": rf"""SELECT name, n, {CLEAN_NAME.format('name')} AS clean, regexp_replace(regexp_extract(name, '^[^(,\d]*'), '\s$', '') AS leading
        FROM (SELECT name, count(*) AS n FROM v_places GROUP BY ALL)""",
    "filter_predicate": """SELECT property_ID, country, region FROM v_listings WHERE (created >= DATE '2024-01-10' OR scraped IS NULL)
        AND region IS NOT NULL AND coalesce(country NOT IN ('Peru', 'Chile'), true)""",
    "point_lookup": "SELECT property_ID, scraped, ab_host, ha_host FROM v_listings WHERE ha_host = 'm0' AND ab_host <> 'a1'",
    "null_out": f"SELECT property_ID, {NULLED.format('''coalesce(country IN ('Peru', 'Chile') AND region IS NOT NULL, false)''')} FROM v_listings",
    "rename_positional": "SELECT c_custkey AS key, c_name AS title, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS kind FROM customer",
    "reorder_columns": "SELECT property_ID, host_ID, country, region, city, listing_type, created, scraped, housing, ab_host, ha_host FROM v_listings",
    "to_mercator": "SELECT property_ID, round(x, 2) AS x, round(y, 2) AS y FROM v_points",
    "new_regions": "SELECT property_ID, region FROM v_listings WHERE region IS NOT NULL AND region NOT IN (SELECT region FROM v_region_list)",
    "region_list": "SELECT region FROM v_region_list UNION SELECT region FROM v_listings WHERE region IS NOT NULL",
    "new_scrapes": "SELECT property_ID, date, raw FROM v_recent",
    "reuse_location": "SELECT * FROM v_reused",
    "needs_check": "SELECT property_ID, country, region FROM v_listings WHERE property_ID NOT IN (SELECT property_ID FROM v_reused)",
    "scrape_worklist": "SELECT property_ID, created, CASE WHEN created >= DATE '2000-05-01' THEN 1 ELSE 2 END AS priority FROM v_worklist",
    "worklist_batches": """SELECT property_ID, priority, CAST((n - 1) // 100 + CASE WHEN priority = 2 THEN (first_pool + 99) // 100 ELSE 0 END AS BIGINT) AS batch
        FROM v_numbered""",
    "slice_n": "SELECT property_ID FROM v_numbered WHERE n <= 500 AND (priority = 1 OR first_pool = 0)",
    "dedup_keep_first": "SELECT * FROM v_dedup",
    "latest_per_key": "SELECT d.* FROM v_dedup d JOIN (SELECT property_ID, max(date) AS date FROM v_dedup GROUP BY ALL) m ON d.property_ID = m.property_ID AND d.date = m.date",
    "single_scrape": "SELECT * FROM v_single",
    "upsert_by_key": """SELECT property_ID, country, date, raw FROM v_scrapes WHERE property_ID NOT IN (SELECT property_ID FROM v_scrapes WHERE country LIKE '%CHECK%')
        UNION ALL SELECT property_ID, 'Peru', date, raw FROM v_scrapes WHERE country LIKE '%CHECK%'""",
    "scrape_merge": """SELECT property_ID, city, region, country, raw, date FROM (SELECT *, max(date) OVER (PARTITION BY property_ID) AS latest FROM (
        SELECT *, row_number() OVER (PARTITION BY property_ID, city, region, country ORDER BY date DESC NULLS LAST, raw) AS rn FROM (
            SELECT * FROM v_scrapes WHERE property_ID NOT IN (SELECT property_ID FROM v_scrapes WHERE date >= DATE '2001-01-01')
            UNION ALL SELECT property_ID, 'New Town', region, country, raw, date FROM v_scrapes WHERE date >= DATE '2001-01-01') WHERE raw IS NOT NULL)
        WHERE rn = 1) WHERE date = latest""",
    "count_by": "SELECT country, region, count(*) AS n FROM v_listings GROUP BY ALL",
    "group_distinct": "SELECT DISTINCT property_ID, country, region, city FROM v_scrapes",
    "distinct_all": "SELECT DISTINCT * FROM v_scrapes WHERE raw IS NOT NULL",
    "row_count": "SELECT count(*) - 1 AS daily_length FROM events",
    "union_strict": "SELECT property_ID, host_ID, country, region FROM v_listings UNION ALL SELECT property_ID, host_ID, country, region FROM v_suppliers",
    "union_fill": "SELECT property_ID, country, ab_host, NULL AS listing_type FROM v_listings UNION ALL SELECT property_ID, country, NULL, listing_type FROM v_suppliers",
    "sort_output": "SELECT * FROM v_active_islands ORDER BY property_ID, start_date",
    "assert_unique": "SELECT property_ID, count(*) AS n FROM v_scrapes GROUP BY ALL HAVING count(*) > 1",
    "assert_rowcount": """SELECT CAST(count(*) AS BIGINT) AS rows_before, CAST(count(country) AS BIGINT) AS rows_after, count(*) = count(country) AS unchanged FROM v_listings""",
    **{
        name: f"SELECT property_ID, country_geo FROM v_geocoded WHERE geo_pass = {number}"
        for number, name in enumerate(
            ["pip_claimed_country", "pip_any_country", "near_any_country", "pip_alt_boundary", "near_alt_boundary"], 1
        )
    },
    "geocode_cascade": "SELECT property_ID, geo_pass, country_geo FROM v_geocoded",
    "tie_groups": "SELECT property_ID, n, n > 1 AS tied FROM v_place_ties",
    "collect_candidates": "SELECT property_ID, candidates FROM v_place_ties WHERE n > 1",
    "scrape_compare": "SELECT property_ID, country_geo, country_scrape FROM v_scrape_compared",
    "country_validate_scrape": "SELECT property_ID, country_geo, country_scrape, scrape_valid FROM v_validated WHERE country_scrape <> country_geo",
    "country_resolve": "SELECT property_ID, country, region, city FROM v_resolved",
    "boundary_index": "SELECT name, count(*) AS n FROM v_measured WHERE layer = 'main' AND inside GROUP BY name",
    "region_compare": "SELECT property_ID, country, region, region_geo, region_scrape FROM v_region_compared",
    "province_nearest": "SELECT property_ID, region_geo FROM v_region_compared WHERE country = 'Canada'",
    "state_pip_then_nearest": "SELECT property_ID, region_geo FROM v_region_compared WHERE country = 'United States'",
    "region_agree": "SELECT property_ID, agrees FROM v_agreement",
    "region_validate_scrape": "SELECT property_ID, region_geo, region_scrape, scrape_valid FROM v_region_valid WHERE NOT agrees",
    "region_writeback": "SELECT property_ID, country, region, city FROM v_written",
    "region_coverage": "SELECT * FROM v_coverage",
    "spurious_region_purge": f"""SELECT property_ID, country, {NULLED.format('hit')} FROM (SELECT *, region IS NOT NULL AND EXISTS (
        SELECT 1 FROM v_coverage c WHERE c.country IS NOT DISTINCT FROM v_listings.country) AS hit FROM v_listings)""",
    "region_losers": "SELECT region, country, n, most FROM v_losers",
    "region_country_vote": f"""SELECT property_ID, country, {NULLED.format('hit')} FROM (SELECT *, EXISTS (SELECT 1 FROM v_losers s
        WHERE s.region = v_listings.region AND s.country = v_listings.country) AS hit FROM v_listings)""",
    "region_resolved": f"""SELECT property_ID, country, {NULLED.format('hit')} FROM (SELECT *, EXISTS (SELECT 1 FROM v_purged_losers s
        WHERE s.region = v_purged.region AND s.country = v_purged.country) AS hit FROM v_purged)""",
    "hull_update": corners("v_update_points", "v_update_edges", ["country", "region"]),
    "hull_add": corners("v_add_points", "v_add_edges", ["country", "region"]),
    "hull_refresh": f"""SELECT country, region, x, y FROM ({corners('v_update_points', 'v_update_edges', ['country', 'region'])})
        UNION ALL SELECT country, region, x, y FROM ({corners('v_add_points', 'v_add_edges', ['country', 'region'])})""",
    "country_hulls": f"SELECT country, {AREA} AS area, CAST(count(*) AS INTEGER) AS corners FROM v_country_edges GROUP BY country HAVING count(*) >= 3",
    "city_hulls": f"SELECT region, city, {AREA} AS area FROM v_city_edges GROUP BY region, city HAVING count(*) >= 3",
    "region_from_hull": """SELECT p.property_ID, p.country, CASE WHEN p.country IS NOT NULL AND p.region IS NULL THEN CASE WHEN h.n = 1 THEN h.region END ELSE p.region END AS region
        FROM v_hull_points p LEFT JOIN v_held_counts h ON p.property_ID = h.property_ID""",
    "hull_exclusive": """SELECT p.property_ID, coalesce(h.n, 0) AS hulls, coalesce(h.n, 0) = 1 AS exclusive FROM v_hull_points p
        LEFT JOIN v_held_counts h ON p.property_ID = h.property_ID WHERE p.country IS NOT NULL""",
    "place_join": "SELECT * FROM v_place_joined",
    "place_join_inner": "SELECT * FROM v_place_joined WHERE place IS NOT NULL",
    "place_counts": f"SELECT {CLEAN_NAME.format('place')} AS place, count(*) AS n FROM v_place_joined GROUP BY 1",
    "scan_property_csv": "SELECT property_ID, listing_title, created, latitude, region, superhost, instant_book, bedrooms, rating, ha_host FROM v_delivered",
    "parse_errors": "SELECT property_ID, created, bedrooms, instant_book FROM v_delivered WHERE parse_error",
    "scan_daily_csv": """SELECT property_ID, date, status, booked_date, CASE WHEN event_id % 71 > 0 THEN price END AS price, res_ID,
        event_id % 71 = 0 AS parse_error FROM v_events""",
    "scan_daily_min": "SELECT property_ID, date, status FROM v_events",
    "discover_delivery": "SELECT 'All_Property_Match_2024-02-17.csv' AS delivery, property_ID FROM v_listings",
    "scan_table": "SELECT property_ID, start_date, end_date FROM v_active_ranges WHERE status = 'R'",
    "scan_snapshot": "SELECT property_ID, country, region, city FROM v_locations",
    "sink_snapshot": "SELECT property_ID, country FROM v_listings",
    "scan_error_backlog": "SELECT property_ID, date, status, booked_date, price, res_ID FROM v_routed WHERE route = 'error'",
    "sink_append_table": """SELECT '2023_12' AS year_month, status, count(*) AS n FROM v_history GROUP BY ALL
        UNION ALL SELECT '2024_01', status, count(*) FROM v_active_ranges GROUP BY ALL""",
    "sink_replace_table": "SELECT property_ID, host_ID, country, region, city FROM v_listings",
    "sink_quarantine_csv": "SELECT route, count(*) AS n, count(property_ID) AS named FROM v_raw_routed WHERE route <> 'clean' GROUP BY route",
    "readback_check": "SELECT '2024_01' AS year_month, count(*) AS sent, count(*) AS stored, true AS complete FROM v_active_ranges",
}


def with_parts(select: str) -> str:
    """The SELECT preceded by every part it needs, in dependency order."""
    ordered: list[str] = []

    def need(sql: str) -> None:
        for name in re.findall(r"\bv_\w+", sql):
            if name not in ordered:
                need(PARTS[name])
                if name not in ordered:
                    ordered.append(name)

    need(select)
    parts = ",\n".join(f"{name} AS ({PARTS[name]})" for name in ordered)
    return f"WITH {parts}\n{select}" if ordered else select


ORACLES = {name: with_parts(select) for name, select in SELECTS.items()}

"""The given test tables seen as listings, nights, scrapes and boundaries.

Every stand-in is a projection of a whole given table, so queries grow with
it. Some values are skewed on purpose: a third of all listings share a host.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomledger import fixed_values as fixed
from roomledger.functions import geometry as geo

# Country of each nation key.
NATIONS = [
    "Canada", "United States", "France", "Guadeloupe", "United Kingdom", "Guernsey", "China",
    "Taiwan", "Germany", "Russia", "Mexico", "Peru", "Chile", "Italy", "Turkey", "Kenya", "Cuba",
    "Thailand", "Norway", "Bonaire, Sint Eustatius and Saba", "U.S. Virgin Islands", "Morocco",
    "Cyprus", "Bolivia", "Ghana",
]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
PROVINCE_TEXTS = [s for spellings in fixed.PROVINCE_SPELLINGS.values() for s in spellings]
STATE_TEXTS = [s for spellings in fixed.STATE_SPELLINGS.values() for s in spellings]
OKRUGS = [s for spellings in fixed.REGION_SPELLINGS["Russia"].values() for s in spellings]
# Month the stand-ins play in, and the cell that suits their long straight edges.
LABEL = "2024_01"
CELL = 250_000.0


def pick(values: list[str], index: str) -> str:
    """SQL for the value at an index counted from 0."""
    listed = ", ".join("'" + v.replace("'", "\\'") + "'" for v in values)
    return f"element_at(array({listed}), cast({index} as int) + 1)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listing_id(key: str) -> str:
    return f"concat(if({key} % 2 = 0, 'ab-', 'ha-'), {key})"


def spot(key: str) -> str:
    """Nation key of the place a listing's coordinates are in."""
    return f"(({key} * 7919) % 24000 div 4800 + 5 * (({key} * 104729) % 10000 div 2000))"


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean property rows from ``customer``."""
    keyed = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as k", "c_nationkey as nation", "c_mktsegment as listing_type",
        f"{spot('c_custkey')} as spot", "if(c_custkey % 3 = 0, 0, c_custkey div 4) as hn",
    )
    hosts = keyed.selectExpr(
        "*",
        "case when k % 53 = 0 then null when k % 2 = 0 or k % 6 = 1 then concat('a', hn) end as ab_host",
        "case when k % 53 = 0 then null when k % 2 = 1 or k % 8 = 0 then concat('m', hn - hn % 2) end as ha_host",
        f"case when k % 13 = 0 then null when k % 2 = 0 then {pick(NATIONS, 'spot')} else {pick(NATIONS, 'nation')} end as country",
        f"{pick(['Apartment', 'House', 'Hotel', 'Hostel', 'Villa'], 'k % 5')} as property_type",
    )
    region = f"""case
        when k % 5 = 0 then null
        when k % 17 = 0 then 'La Paz'
        when country = 'Canada' and k % 3 = 0 then {pick(fixed.PROVINCES, '(k * 5) % 13')}
        when country = 'Canada' then {pick(fixed.PROVINCES, 'least((k * 7919) % 4800 div 340, 12)')}
        when country = 'United States' and k % 3 = 0 then {pick(fixed.STATES, '(k * 5) % 51')}
        when country = 'United States' then {pick(fixed.STATES, 'least((k * 7919) % 4800 div 86, 50)')}
        when country = 'Germany' and k % 3 = 0 then 'Hamburg'
        when country = 'Russia' and k % 3 > 0 then {pick(OKRUGS, 'k % 8')}
        when spot = 7 and k % 4 = 1 then 'Fujian'
        else concat('Region ', k % 6) end"""
    return hosts.selectExpr(
        f"{listing_id('k')} as property_ID",
        "coalesce(ab_host, ha_host) as host_ID",
        "concat('Title ', k) as listing_title",
        "property_type",
        "listing_type",
        "if(k % 7 = 0, null, date_add(date'2024-01-01', cast(k % 20 as int))) as created",
        "if(k % 11 = 0, null, date_add(date'2024-01-12', cast(k % 25 as int))) as scraped",
        "property_type in ('Apartment', 'House', 'Villa') as housing",
        "-50 + cast((k * 104729) % 10000 as double) / 100 as latitude",
        "-120 + cast((k * 7919) % 24000 as double) / 100 as longitude",
        "country",
        f"{region} as region",
        "if(k % 9 = 0, null, concat('City ', k % 20)) as city",
        "ab_host",
        "ha_host",
    )


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Property rows as delivered, faults included."""
    return table(spark, sf_dir, "customer").selectExpr(
        f"""case when c_custkey % 97 = 5 then null when c_custkey % 89 = 4 then concat('xx-', c_custkey)
            else {listing_id('c_custkey')} end as property_ID""",
        "concat('\"T\\'', c_custkey, '\\n', c_mktsegment, '\\r') as listing_title",
        "if(c_custkey % 31 = 0, null, c_mktsegment) as listing_type",
        "if(c_custkey % 23 = 0, null, -50 + cast((c_custkey * 104729) % 10000 as double) / 100) as latitude",
        "if(c_custkey % 29 = 0, null, -120 + cast((c_custkey * 7919) % 24000 as double) / 100) as longitude",
        "if(c_custkey % 3 = 0, concat('a', c_custkey % 40), null) as ab_host",
        "if(c_custkey % 4 > 0, concat('m', c_custkey % 40), null) as ha_host",
        "c_custkey % 19 = 0 as parse_error",
    )


def night_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nights as delivered, from ``events``: copies per night, faults, unknown listings."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        f"""case when event_id % 89 = 0 then null when user_id % 10 = 3 then concat('ab-new', user_id)
            else {listing_id('user_id')} end as property_ID""",
        "if(event_id % 101 = 0, null, cast(ts as date)) as date",
        """case when event_id % 97 = 0 then null when event_type = 'error' then 'U'
            when event_type = 'purchase' then 'R' else 'A' end as status""",
        "if(event_type = 'purchase', date'2023-12-24', null) as booked_date",
        "100 + cast(user_id % 5 as int) * 10 as price",
        "if(event_type = 'purchase', cast(user_id as int), null) as res_ID",
    )


def nights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return night_events(spark, sf_dir).drop("event_id")


def later_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings known a month later: the unknown ones of ``night_events`` as well."""
    known = listings(spark, sf_dir)
    new = table(spark, sf_dir, "events").filter("user_id % 10 = 3").selectExpr(
        "concat('ab-new', user_id) as property_ID", "concat('a', user_id) as host_ID",
        "'BUILDING' as listing_type", "user_id % 4 < 2 as housing",
        "if(user_id % 20 = 3, null, date'2024-01-05') as created", "date'2024-01-25' as scraped",
        "'Peru' as country",
    )
    return known.unionByName(new.distinct(), allowMissingColumns=True)


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nights at scale from ``lineitem``: a supplier is a listing, a shipping day a night."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        f"{listing_id('l_suppkey')} as property_ID",
        "cast(l_shipdate as date) as date",
        "case when l_returnflag = 'N' and l_linestatus = 'F' then 'U' when l_returnflag = 'R' then 'R' else 'A' end as status",
        "cast(null as date) as booked_date",
        "100 + cast(l_suppkey % 5 as int) * 10 as price",
        "cast(null as int) as res_ID",
    )


def supplier_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings of ``shipments``."""
    return table(spark, sf_dir, "supplier").selectExpr(
        f"{listing_id('s_suppkey')} as property_ID",
        "if(s_suppkey % 3 = 0, 'h0', concat('h', s_suppkey div 4)) as host_ID",
        f"{pick(SEGMENTS, 's_suppkey % 5')} as listing_type",
        "s_suppkey % 4 < 2 as housing",
        "date'1995-03-01' as created",
        "if(s_suppkey % 7 = 0, null, date'2001-06-30') as scraped",
        f"{pick(NATIONS, 's_nationkey')} as country",
        "concat('Region ', s_suppkey % 6) as region",
        "concat('City ', s_suppkey % 20) as city",
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored daily ranges of earlier months from ``orders``."""
    return table(spark, sf_dir, "orders").selectExpr(
        f"{listing_id('o_custkey')} as property_ID",
        "cast(o_orderdate as date) as start_date",
        "date_add(cast(o_orderdate as date), cast(o_orderkey % 10 as int)) as end_date",
        "if(o_orderstatus = 'F', 'U', 'A') as status",
    )


def scrapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scrape results from ``orders``, several per listing."""
    seen = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as o", "o_custkey as k", "o_orderstatus as state", "cast(o_orderdate as date) as day",
        f"({spot('o_custkey')} + if(o_orderkey % 10 < 6, 0, o_orderkey % 5)) % 25 as si",
    )
    country = f"""case
        when o % 29 = 0 then concat('CHECK ', o % 7)
        when o % 37 = 0 then null
        when si = 19 then 'Bonaire Sint Eustatius and Saba'
        when o % 2 = 0 and si = 3 then 'France'
        when o % 2 = 0 and si = 5 then 'United Kingdom'
        when o % 2 = 0 and si = 7 then 'China'
        when o % 2 = 0 and si = 20 then 'United States'
        else {pick(NATIONS, 'si')} end"""
    region = f"""case
        when o % 7 = 0 then null
        when si = 0 and o % 3 = 0 then {pick(PROVINCE_TEXTS, f'o % {len(PROVINCE_TEXTS)}')}
        when si = 0 then {pick(fixed.PROVINCES, 'least((k * 7919) % 4800 div 340, 12)')}
        when si = 1 and o % 3 = 0 then {pick(STATE_TEXTS, f'o % {len(STATE_TEXTS)}')}
        when si = 1 then {pick(fixed.STATES, 'least((k * 7919) % 4800 div 86, 50)')}
        else concat('Region ', o % 6) end"""
    return seen.selectExpr(
        f"{listing_id('k')} as property_ID",
        "concat('Town ', o % 5) as city",
        f"{region} as region",
        f"{country} as country",
        "if(state = 'P', null, concat('raw', o)) as raw",
        "if(o % 41 = 0, null, day) as date",
    )


# --- geometry ---------------------------------------------------------------


def _ring(corners: list[tuple[str, str]]) -> str:
    points = ", ".join(f"struct({lon} as lon, {lat} as lat)" for lon, lat in corners)
    return f"array({points})"


def _projected(df: DataFrame) -> DataFrame:
    """Rings of longitude and latitude in EPSG:3857."""
    ring = F.transform(
        "lonlat",
        lambda p: F.struct(geo.mercator_x(p["lon"]).alias("x"), geo.mercator_y(p["lat"]).alias("y")),
    )
    return df.withColumn("ring", ring).drop("lonlat")


def _nation_rings(spark: SparkSession, sf_dir: str, dx: int, dy: int) -> DataFrame:
    placed = table(spark, sf_dir, "nation").selectExpr(
        f"{pick(NATIONS, 'n_nationkey')} as name",
        f"cast(-120 + 48 * (n_nationkey % 5) + {dx} as double) as x0",
        f"cast(-50 + 20 * (n_nationkey div 5) + {dy} as double) as y0",
    )
    notched = [("x0", "y0"), ("x0 + 44", "y0"), ("x0 + 44", "y0 + 17"), ("x0 + 22", "y0 + 9"), ("x0", "y0 + 17")]
    return _projected(placed.selectExpr("name", f"{_ring(notched)} as lonlat"))


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First boundary set: a notched ring per nation."""
    return _nation_rings(spark, sf_dir, 0, 0)


def alternatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second boundary set: the same rings, shifted."""
    return _nation_rings(spark, sf_dir, 5, 4)


def subdivisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provinces and states as strips with gaps between them."""
    strips = table(spark, sf_dir, "nation").filter("n_nationkey < 2").selectExpr(
        f"{pick(NATIONS, 'n_nationkey')} as layer", "n_nationkey",
        "cast(-120 + 48 * n_nationkey as double) as x0", "-50D as y0",
        "explode(sequence(0, if(n_nationkey = 0, 12, 50))) as i",
    )
    strips = strips.selectExpr(
        "layer",
        f"if(n_nationkey = 0, {pick(fixed.PROVINCES, 'least(i, 12)')}, {pick(fixed.STATES, 'i')}) as name",
        "x0 + if(n_nationkey = 0, cast(i * 340 as double), cast(i * 86 as double)) / 100 as xa",
        "x0 + if(n_nationkey = 0, cast(i * 340 + 320 as double), cast(i * 86 + 80 as double)) / 100 as xb",
        "y0 as ya", "y0 + 17 as yb",
    )
    corners = [("xa", "ya"), ("xb", "ya"), ("xb", "yb"), ("xa", "yb")]
    return _projected(strips.selectExpr("layer", "name", f"{_ring(corners)} as lonlat"))


def territories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squares that touch, one per supplier, as parts of three lands; every other ring turns the other way."""
    placed = table(spark, sf_dir, "supplier").selectExpr(
        "concat('Land ', s_suppkey % 20 div 7) as name", "s_name as part", "s_suppkey % 2 = 0 as turned",
        "cast(s_suppkey % 20 * 10 as double) as x0", "cast(s_suppkey div 20 * 10 as double) as y0",
    )
    corners = """array(struct(x0 as x, y0 as y), struct(x0 + 10 as x, y0 as y),
                       struct(x0 + 10 as x, y0 + 10 as y), struct(x0 as x, y0 + 10 as y))"""
    return placed.selectExpr("name", "part", f"if(turned, reverse({corners}), {corners}) as ring")


def hull_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points on integer coordinates with a country, region and city."""
    return table(spark, sf_dir, "customer").selectExpr(
        f"{listing_id('c_custkey')} as property_ID",
        f"if(c_custkey % 13 = 0, null, {pick(NATIONS, 'c_nationkey')}) as country",
        "case when c_custkey % 5 = 0 then null when c_custkey % 3 = 0 then 'Old Town' else c_mktsegment end as region",
        "concat('City ', c_custkey % 4) as city",
        "cast((c_custkey * 7919) % 1009 as double) as x",
        "cast((c_custkey * 104729) % 997 as double) as y",
    )


def old_hull_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points behind last month's hulls."""
    return table(spark, sf_dir, "supplier").selectExpr(
        f"{pick(NATIONS, 's_nationkey')} as country",
        f"{pick(SEGMENTS, 's_suppkey % 5')} as region",
        "cast((s_suppkey * 6151) % 1213 - 100 as double) as x",
        "cast((s_suppkey * 3079) % 1103 - 50 as double) as y",
    )


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Census places: a rectangle per supplier, named with subdivision marks."""
    base = pick(NATIONS, "s_nationkey")
    sited = table(spark, sf_dir, "supplier").selectExpr(
        "s_name as part",
        f"""case when s_suppkey % 11 = 0 then {base}
            when s_suppkey % 4 = 0 then concat({base}, ' (RGM)')
            when s_suppkey % 4 = 1 then concat({base}, ', Subd. A (SC)')
            when s_suppkey % 4 = 2 then concat({base}, ' No. ', s_suppkey % 7, ' (MD)')
            else concat({base}, ' B (T)') end as name""",
        "cast((s_suppkey * 6151) % 1000 as double) as x0",
        "cast((s_suppkey * 3079) % 1000 as double) as y0",
    )
    return sited.selectExpr(
        "name", "part",
        """array(struct(x0 as x, y0 as y), struct(x0 + 30 as x, y0 as y),
                 struct(x0 + 30 as x, y0 + 40 as y), struct(x0 as x, y0 + 40 as y)) as ring""",
    )

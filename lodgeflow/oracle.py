"""DuckDB SQL for every registered query: the correctness oracle.

Written from the definitions, with nothing of the engine imported. Months are
numbers (twelve times the year plus the month from 0), so that validity is a
range of numbers, and a mart is one aggregate over the cells (listing version,
month, host version). Money is summed as DECIMAL; what the registry rounds is
rounded here too.
"""

from __future__ import annotations

# The census' age bands, in order; a customer's band is its key modulo their number.
BANDS = ("0_4", "5_14", "15_19", "20_24", "25_34", "35_44", "45_54", "55_64", "65_74", "75_84", "85ov")
# Fixed value: the first area code.
AREA_BASE = 10000
SCORES = ("rating", "accuracy", "cleanliness", "checkin", "communication", "value")


def month_no(day: str) -> str:
    return f"(year({day}) * 12 + month({day}) - 1)"


def month_day(no: str) -> str:
    return f"make_date(CAST({no} // 12 AS BIGINT), CAST({no} % 12 + 1 AS BIGINT), 1)"


_SUB_SCORES = ",\n  ".join(
    f"CASE WHEN o_orderkey % {7 + i} <> 0 THEN CAST((o_orderkey + {i}) % 11 AS DOUBLE) END AS {s}"
    for i, s in enumerate(SCORES[1:], start=1))

OBS = f"""
picked AS (
  SELECT *, CASE WHEN o_orderkey % 23 <> 0 THEN CASE WHEN o_custkey % 2 = 0 THEN o_custkey ELSE o_custkey % 100 END END AS host
  FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) = 1),
obs AS (
  SELECT o_custkey AS listing_id, host AS host_id, 'HOST_' || host AS host_name,
  DATE '2010-01-01' + CAST(host % 2000 AS INTEGER) AS host_since,
  o_orderpriority AS property_type,
  ['ENTIRE HOME/APT', 'PRIVATE ROOM', 'SHARED ROOM'][CAST(o_orderkey % 3 + 1 AS INTEGER)] AS room_type,
  CAST(o_orderkey % 6 + 1 AS INTEGER) AS accommodates,
  CASE WHEN o_custkey % 10 = 0 THEN r_name ELSE n_name END AS neighbourhood,
  CAST(o_orderdate AS DATE) AS scraped_date, {month_no('CAST(o_orderdate AS DATE)')} AS mno,
  CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS price,
  CASE o_orderstatus WHEN 'O' THEN TRUE WHEN 'F' THEN FALSE END AS has_availability,
  CAST(o_orderkey % 31 AS INTEGER) AS availability_30, CAST(o_orderkey % 50 AS INTEGER) AS number_of_reviews,
  CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey % 100 AS DOUBLE) END AS rating,
  {_SUB_SCORES},
  o_orderkey % 5 = 0 AS superhost, CASE WHEN o_orderkey % 13 <> 0 THEN c_mktsegment END AS host_area,
  o_orderkey AS scrape_id
  FROM picked JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey)"""

# What the text files deliver: no rows with an unreadable date, impossible dates and prices as NULL.
DELIVERED = """
delivered AS (
  SELECT * REPLACE (CASE WHEN scrape_id % 19 <> 0 THEN scraped_date END AS scraped_date,
                    CASE WHEN scrape_id % 29 <> 0 THEN price END AS price)
  FROM obs WHERE scrape_id % 17 <> 0)"""


# What the raw table holds of it: one row per listing and date text; impossible dates of a listing
# have one text a year, and the row that comes first by its scrape's text holds the key.
LOADED = DELIVERED.replace("delivered AS", "delivered_all AS") + """,
delivered AS (
  SELECT * FROM delivered_all
  QUALIFY row_number() OVER (PARTITION BY listing_id, coalesce(CAST(scraped_date AS VARCHAR), CAST(mno // 12 AS VARCHAR))
                             ORDER BY CAST(scrape_id AS VARCHAR)) = 1)"""


def listing_versions(overlap: bool = True) -> str:
    """Each observation is valid until the next of its listing; ``past`` is the first month after."""
    extra = 1 if overlap else 0
    return f"""
lv AS (
  SELECT *, mno AS first_no, coalesce({month_no('until')} + {extra}, 1000000) AS past_no
  FROM (SELECT *, lead(scraped_date) OVER (PARTITION BY listing_id ORDER BY scraped_date) AS until FROM obs))"""


def host_versions(source: str = "obs", overlap: bool = True) -> str:
    """A host's attributes of a day are those of its smallest listing; a version begins where they change."""
    extra = 1 if overlap else 0
    return rf"""
host_days AS (
  SELECT host_id, scraped_date AS day, any_value(host_since) AS host_since, arg_min(struct_pack(name := upper(trim(host_name)), superhost := superhost,
    area := upper(regexp_replace(coalesce(nullif(trim(host_area), ''), trim(neighbourhood)), '\s+', ' ', 'g'))), listing_id) AS a
  FROM {source} WHERE host_id IS NOT NULL AND scraped_date IS NOT NULL GROUP BY ALL),
changes AS (
  SELECT * FROM host_days WINDOW days AS (PARTITION BY host_id ORDER BY day)
  QUALIFY row_number() OVER days = 1 OR a IS DISTINCT FROM lag(a) OVER days),
hv AS (
  SELECT *, {month_no('day')} AS first_no, coalesce({month_no('until')} + {extra}, 1000000) AS past_no
  FROM (SELECT *, lead(day) OVER (PARTITION BY host_id ORDER BY day) AS until FROM changes))"""


# The nearest twelve months, the newest last.
CALENDAR = """
calendar AS (SELECT unnest(range(newest - 11, newest + 1)) AS no FROM (SELECT max(mno) AS newest FROM obs))"""

GROUPS = {
    "neighbourhood": {"listing_neighbourhood": "upper(trim(l.neighbourhood))"},
    "property_type": {"property_type": "upper(trim(l.property_type))"},
    "property_room_size": {"property_type": "upper(trim(l.property_type))", "room_type": "l.room_type", "accommodates": "l.accommodates"},
    "host_neighbourhood": {"host_neighbourhood": "h.a.area"},
}


def mart(kind: str, overlap: bool = True) -> str:
    """CTEs up to ``mart``: one aggregate over the cells."""
    groups = GROUPS[kind]
    keys = ", ".join(groups)
    picks = ", ".join(f"{e} AS {n}" for n, e in groups.items())
    some = " AND ".join(f"{n} IS NOT NULL" for n in groups)
    how = "JOIN" if kind == "host_neighbourhood" else "LEFT JOIN"
    return "WITH " + ",".join([OBS, listing_versions(overlap), host_versions(overlap=overlap), CALENDAR]) + f""",
cells AS (
  SELECT {picks}, c.no, l.host_id, coalesce(h.a.superhost, FALSE) AS super, coalesce(l.has_availability, FALSE) AS open,
    CASE WHEN l.has_availability THEN greatest(30 - l.availability_30, 0) ELSE 0 END AS nights,
    nullif(l.price, 0) AS price, nullif(l.rating, 0) AS score
  FROM lv l JOIN calendar c ON c.no >= l.first_no AND c.no < l.past_no
  {how} hv h ON h.host_id = l.host_id AND c.no >= h.first_no AND c.no < h.past_no),
sums AS (
  SELECT {keys}, no, count(*) AS n, count_if(open) AS n_open, count_if(NOT open) AS n_shut,
    count(DISTINCT host_id) AS hosts, count(DISTINCT CASE WHEN super THEN host_id END) AS supers,
    min(price) FILTER (open) AS low, max(price) FILTER (open) AS high, quantile_cont(CAST(price AS DOUBLE), 0.5) FILTER (open) AS mid,
    CAST(sum(price) FILTER (open) AS DOUBLE) / CAST(count(price) FILTER (open) AS DOUBLE) AS mean,
    CAST(sum(score) FILTER (open) AS DOUBLE) / CAST(count(score) FILTER (open) AS DOUBLE) AS score,
    CAST(sum(nights) AS BIGINT) AS nights, CAST(sum(nights * coalesce(price, 0)) AS DOUBLE) / nullif(CAST(count_if(open) AS DOUBLE), 0) AS revenue
  FROM cells WHERE {some} GROUP BY {keys}, no),
mart AS (
  SELECT *, lag(n_open) OVER w AS open_before, lag(n_shut) OVER w AS shut_before
  FROM sums WINDOW w AS (PARTITION BY {keys} ORDER BY no))"""


def growth(now: str, before: str) -> str:
    return f"CAST({now} - {before} AS DOUBLE) / nullif(CAST({before} AS DOUBLE), 0)"


def mart_query(kind: str, overlap: bool = True) -> str:
    return mart(kind, overlap) + f"""
SELECT {", ".join(GROUPS[kind])}, {month_day('no')} AS month_start, CAST(no // 12 AS INTEGER) AS year, CAST(no % 12 + 1 AS INTEGER) AS month,
  CAST(n_open AS DOUBLE) / CAST(n AS DOUBLE) AS active_listings_rate, round(CAST(low AS DOUBLE), 6) AS min_price_active,
  round(CAST(high AS DOUBLE), 6) AS max_price_active, round(mid, 6) AS median_price_active,
  mean AS avg_price_active, hosts AS distinct_hosts, CAST(supers AS DOUBLE) / nullif(CAST(hosts AS DOUBLE), 0) AS superhost_rate,
  score AS avg_review_rating_active, nights AS total_stays, round(revenue, 6) AS avg_est_rev_per_active,
  {growth('n_open', 'open_before')} AS pct_change_active, {growth('n_shut', 'shut_before')} AS pct_change_inactive
FROM mart"""


def audited(months: int) -> str:
    """Exact measures over the ``months`` that end at each month of an area; sketches must be within their bounds."""
    return f""", spans AS (
  SELECT ends.listing_neighbourhood, ends.no AS last_no, cells.* EXCLUDE (listing_neighbourhood)
  FROM sums ends JOIN cells ON cells.listing_neighbourhood = ends.listing_neighbourhood AND cells.no BETWEEN ends.no - {months - 1} AND ends.no)
SELECT listing_neighbourhood, {month_day('last_no')} AS month_start, count(*) AS listings_total,
  CAST(count_if(open) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS active_listings_rate,
  round(CAST(min(price) FILTER (open) AS DOUBLE), 6) AS min_price_active, round(CAST(max(price) FILTER (open) AS DOUBLE), 6) AS max_price_active,
  CAST(sum(price) FILTER (open) AS DOUBLE) / CAST(count(price) FILTER (open) AS DOUBLE) AS avg_price_active, CAST(sum(nights) AS BIGINT) AS total_stays,
  round(CAST(sum(nights * coalesce(price, 0)) AS DOUBLE) / nullif(CAST(count_if(open) AS DOUBLE), 0), 6) AS avg_est_rev_per_active,
  count(DISTINCT host_id) AS hosts, TRUE AS hosts_within, CASE WHEN count(price) FILTER (open) > 0 THEN TRUE END AS median_within
FROM spans GROUP BY listing_neighbourhood, last_no"""


# Every known name of an area, each once: a region's own name before that of a nation.
AREAS = f"""
areas AS (
  SELECT lower(trim(name)) AS k, arg_min(CAST(key + {AREA_BASE} AS VARCHAR), way) AS code, arg_min(upper(trim(lga)), way) AS lga
  FROM (SELECT r_name AS name, r_regionkey AS key, r_name AS lga, 1 AS way FROM region
        UNION ALL SELECT n_name, r_regionkey, r_name, 2 FROM nation JOIN region ON r_regionkey = n_regionkey)
  GROUP BY 1)"""

PEOPLE = f"""
people AS (
  SELECT CAST(n_regionkey + {AREA_BASE} AS VARCHAR) AS code, c_custkey % {len(BANDS)} AS band, n_nationkey,
    CAST(c_acctbal AS DECIMAL(18,2)) AS bal
  FROM customer JOIN nation ON n_nationkey = c_nationkey),
census AS (
  SELECT code, count(*) AS n, CAST(sum(bal) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS age, max(bal) AS mortgage,
    CAST(count(*) AS DOUBLE) / CAST(count(DISTINCT n_nationkey) AS DOUBLE) AS household,
    list(band) AS bands
  FROM people GROUP BY code)"""

# The monthly fact, and its rows of the newest twelve months under each version valid in their month.
FACT = """
fact AS (
  SELECT listing_id, host_id, mno, has_availability, availability_30, nullif(price, 0) AS price, number_of_reviews, rating,
    CASE WHEN has_availability THEN greatest(30 - availability_30, 0) ELSE 0 END AS nights
  FROM obs)"""
PLACED = """
placed AS (
  SELECT f.*, lower(trim(l.neighbourhood)) AS k, l.neighbourhood, l.property_type, l.room_type, l.accommodates
  FROM fact f JOIN lv l ON l.listing_id = f.listing_id AND f.mno >= l.first_no AND f.mno < l.past_no
  WHERE f.mno > (SELECT max(mno) FROM fact) - 12)"""


def with_parts(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def analyses() -> dict[str, str]:
    def share(*bands: str) -> str:
        numbers = [BANDS.index(b) for b in bands]
        return f"CAST(len(list_filter(bands, lambda b: b IN ({', '.join(map(str, numbers))}))) AS DOUBLE) / CAST(n AS DOUBLE)"

    revenue = mart("neighbourhood") + "," + AREAS + "," + PEOPLE + """,
recent AS (SELECT listing_neighbourhood AS area, lower(listing_neighbourhood) AS k, no, revenue FROM mart WHERE no > (SELECT max(no) FROM mart) - 12)"""
    return {
        "top_bottom_bands": revenue + f""",
earned AS (SELECT code, any_value(lga) AS lga, avg(revenue) AS mean FROM recent JOIN areas USING (k) GROUP BY code),
ends AS (
  SELECT unnest([CASE WHEN rank() OVER (ORDER BY mean DESC NULLS FIRST) <= 3 THEN 'TOP3' END,
                 CASE WHEN rank() OVER (ORDER BY mean ASC NULLS LAST) <= 3 THEN 'BOT3' END]) AS band, * FROM earned)
SELECT band, lga AS lga_name, round(mean, 6) AS avg_rev_per_active_listing, age AS median_age, household AS avg_household_size,
  {share('0_4', '5_14')} AS pct_0_14, {share('15_19', '20_24')} AS pct_15_24, {share('25_34')} AS pct_25_34,
  {share('35_44')} AS pct_35_44, {share('45_54', '55_64')} AS pct_45_64, {share('65_74', '75_84', '85ov')} AS pct_65_plus
FROM ends LEFT JOIN census USING (code) WHERE band IS NOT NULL ORDER BY band DESC, mean DESC NULLS FIRST""",
        "age_revenue_corr": revenue + """
SELECT count(*) AS n_neighbourhoods, round(corr(age, mean), 6) AS corr_median_age_vs_revenue
FROM (SELECT k, avg(revenue) AS mean FROM recent GROUP BY k HAVING avg(revenue) IS NOT NULL) JOIN areas USING (k) JOIN census USING (code)""",
        "best_combo_per_area": revenue + "," + FACT + "," + PLACED + """,
leaders AS (SELECT area, k, avg(revenue) AS mean FROM recent GROUP BY area, k QUALIFY rank() OVER (ORDER BY avg(revenue) DESC NULLS FIRST) <= 5)
SELECT area AS listing_neighbourhood, round(mean, 6) AS avg_rev_per_active_listing_12m, property_type, room_type, accommodates,
  CAST(sum(nights) AS BIGINT) AS total_stays_12m, round(CAST(sum(nights * price) AS DOUBLE), 6) AS total_revenue_12m
FROM leaders JOIN placed USING (k) WHERE mno IN (SELECT no FROM recent)
GROUP BY area, mean, property_type, room_type, accommodates
QUALIFY row_number() OVER (PARTITION BY area ORDER BY sum(nights) DESC, property_type, room_type, accommodates) = 1
ORDER BY mean DESC NULLS FIRST""",
        "host_concentration": with_parts(OBS, listing_versions(), FACT, PLACED, AREAS) + """,
spread AS (
  SELECT CASE WHEN min(code) = max(code) THEN 'Concentrated' ELSE 'Distributed' END AS spread_type
  FROM placed JOIN areas USING (k) GROUP BY host_id HAVING min(listing_id) <> max(listing_id))
SELECT spread_type, count(*) AS hosts, round(CAST(count(*) * 100 AS DOUBLE) / (SELECT count(*) FROM spread), 2) AS pct_hosts
FROM spread GROUP BY spread_type ORDER BY spread_type""",
        "host_cost_cover": with_parts(OBS, listing_versions(), FACT, PLACED, AREAS, PEOPLE) + """,
single AS (
  SELECT host_id, mode(code ORDER BY code) AS code, sum(CASE WHEN has_availability THEN nights * price ELSE 0 END) AS earned
  FROM placed LEFT JOIN areas USING (k) WHERE host_id IS NOT NULL
  GROUP BY host_id HAVING min(listing_id) = max(listing_id))
SELECT lga AS lga_name, count(*) AS single_hosts, CAST(count_if(earned >= mortgage * 12) AS BIGINT) AS hosts_covering,
  round(CAST(100 * count_if(earned >= mortgage * 12) AS DOUBLE) / count(*), 2) AS pct_covering
FROM single JOIN census USING (code) JOIN (SELECT DISTINCT code, lga FROM areas) USING (code)
GROUP BY lga ORDER BY pct_covering DESC, lga LIMIT 30""",
    }


VERSION_KEY = "md5(concat_ws('|', CAST({0} AS VARCHAR), {1}CAST(CAST({2} AS TIMESTAMP) AS VARCHAR)))"
LISTING_KEY = VERSION_KEY.format("listing_id", "", "scraped_date")
HOST_KEY = VERSION_KEY.format("host_id", "coalesce(a.area, 'UNKNOWN'), ", "day")
SPAN = "CAST({0} AS TIMESTAMP) AS dbt_valid_from, CAST(until AS TIMESTAMP) AS dbt_valid_to"
HOST_ROWS = f"""
SELECT host_id, a.name AS host_name, a.superhost AS host_is_superhost, a.area AS host_neighbourhood, {SPAN.format('day')} FROM hv"""
SCORE_COLUMNS = ", ".join(f"round({s}, 6) AS review_scores_{s}" for s in SCORES)


def delivered(scores: str = SCORE_COLUMNS, since: str = "host_since", rows: str = DELIVERED) -> str:
    return with_parts(OBS, rows) + f"""
SELECT listing_id, scrape_id, host_id, scraped_date, {since} AS host_since, superhost AS host_is_superhost, has_availability,
  upper(neighbourhood) AS listing_neighbourhood, upper(host_area) AS host_neighbourhood, upper(property_type) AS property_type,
  availability_30, {month_day('mno')} AS month_date, CAST(price AS DOUBLE) AS price, {scores}
FROM delivered"""


def census_rows() -> str:
    """``g01`` and ``g02`` as queries of the loaded census."""
    return with_parts(PEOPLE, AREAS)


# States of events by key and time; the even users are one key.
HOT_KEY = """WITH seen AS (
  SELECT CASE WHEN user_id % 2 = 0 THEN 0 ELSE user_id END AS entity_id, ts AS seen_at, min(event_type) AS event_type
  FROM events GROUP BY ALL)"""
BY_ENTITY = "WINDOW w AS (PARTITION BY entity_id ORDER BY seen_at)"


def queries_sql() -> dict[str, str]:
    open_price = "coalesce(has_availability, FALSE) AND price IS NOT NULL"
    mixed = "CASE WHEN mno % 12 + 1 IN (2, 5, 8, 11) THEN NULL ELSE {0} END"
    lacking = ", ".join(f"{mixed.format('round(value, 6)')} AS review_scores_value" if s == "value" else f"round({s}, 6) AS review_scores_{s}" for s in SCORES)
    lacks = delivered(lacking, mixed.format("host_since"), LOADED)
    loaded = delivered(rows=LOADED)
    checked = {"listing_id": "listing_id", "host_id": "host_id", "price": "price", "has_availability": "has_availability",
               "review_scores_rating": "rating", "host_neighbourhood": "host_area", "scraped_date": "scraped_date"}
    versions = with_parts(OBS, listing_versions())
    month_guard = with_parts(OBS) + "\nSELECT listing_id, scraped_date, strftime(scraped_date, '%m_%Y') AS month_year FROM obs"
    tests = {"suburb_name": "SELECT upper(trim(n_name)) AS v FROM nation", "lga_code": f"SELECT CAST(r_regionkey + {AREA_BASE} AS VARCHAR) AS v FROM region",
             "listing_version_sk": f"SELECT {LISTING_KEY} AS v FROM lv", "host_version_sk": f"SELECT {HOST_KEY} AS v FROM hv"}
    return analyses() | {
        "kpi_neighbourhood": mart_query("neighbourhood"),
        "kpi_property_type": mart_query("property_type"),
        "kpi_host_area": mart_query("host_neighbourhood"),
        "kpi_property_room_size": mart_query("property_room_size"),
        "kpi_neighbourhood_refreshed": mart_query("neighbourhood"),
        "kpi_host_area_refreshed": mart_query("host_neighbourhood"),
        "kpi_neighbourhood_half_open": mart_query("neighbourhood", overlap=False),
        "pct_change_lag": mart("property_type") + f"""
SELECT property_type, {month_day('no')} AS month_start, n_open AS listings_active, n_shut AS listings_inactive,
  {growth('n_open', 'open_before')} AS pct_change_active, {growth('n_shut', 'shut_before')} AS pct_change_inactive FROM mart""",
        "scd2_timestamp": versions + f"""
SELECT listing_id, scraped_date, {LISTING_KEY} AS listing_version_sk, {SPAN.format('scraped_date')}, until IS NULL AS is_current,
  {SCORE_COLUMNS} FROM lv""",
        "scd2_check": with_parts(OBS, host_versions()) + f"""
SELECT host_id, a.name AS host_name, host_since, a.superhost AS host_is_superhost, a.area AS host_neighbourhood,
  {HOST_KEY} AS host_version_sk, {SPAN.format('day')}, until IS NULL AS is_current FROM hv""",
        # an open version of a host that the newest month lacks ends on that month's last day
        "scd2_hard_delete": with_parts(OBS, host_versions()) + f"""
SELECT host_id, day AS scraped_date, a.area AS host_neighbourhood, CAST(day AS TIMESTAMP) AS dbt_valid_from,
  CAST(coalesce(until, CASE WHEN {month_no('max(host_days.day)')} < (SELECT max({month_no('day')}) FROM host_days)
    THEN (SELECT max(day) FROM host_days) END) AS TIMESTAMP) AS dbt_valid_to
FROM hv JOIN host_days USING (host_id) GROUP BY host_id, hv.day, hv.a, until""".replace("day AS scraped_date", "hv.day AS scraped_date").replace(
            "a.area AS host", "hv.a.area AS host").replace("CAST(day AS TIMESTAMP) AS dbt_valid_from", "CAST(hv.day AS TIMESTAMP) AS dbt_valid_from"),
        "scd2_hot_key_timestamp": HOT_KEY + f"""
SELECT entity_id, event_type, seen_at AS dbt_valid_from, lead(seen_at) OVER w AS dbt_valid_to FROM seen {BY_ENTITY}""",
        "scd2_hot_key_check": HOT_KEY + f""",
changes AS (SELECT * FROM seen {BY_ENTITY} QUALIFY row_number() OVER w = 1 OR event_type IS DISTINCT FROM lag(event_type) OVER w)
SELECT entity_id, event_type, seen_at AS dbt_valid_from, lead(seen_at) OVER w AS dbt_valid_to FROM changes {BY_ENTITY}""",
        "scd2_apply_batches": with_parts(OBS, host_versions()) + HOST_ROWS,
        "stream_scd2_apply": with_parts(OBS, DELIVERED, host_versions("delivered")) + HOST_ROWS,
        "month_validity": versions + f"""
SELECT listing_id, CAST(scraped_date AS TIMESTAMP) AS dbt_valid_from, {month_day('first_no')} AS valid_from_month,
  CASE WHEN until IS NOT NULL THEN {month_day('(past_no - 1)')} END AS half_open_to_month,
  CASE WHEN until IS NOT NULL THEN {month_day('past_no')} END AS valid_to_month, until IS NULL AS is_current FROM lv""",
        "month_expand": with_parts(OBS, listing_versions(), CALENDAR) + f"""
SELECT listing_id, CAST(scraped_date AS TIMESTAMP) AS dbt_valid_from, {month_day('no')} AS month_start
FROM lv JOIN calendar ON no >= first_no AND no < past_no""",
        "asof_month_join": with_parts(OBS, listing_versions(), FACT) + f"""
SELECT f.listing_id, {month_day('f.mno')} AS month_date, f.nights AS stays, {LISTING_KEY.replace('listing_id', 'l.listing_id')} AS listing_version_sk
FROM fact f JOIN lv l ON l.listing_id = f.listing_id AND f.mno >= l.first_no AND f.mno < l.past_no""",
        "trailing_window": with_parts(OBS, FACT) + f"""
SELECT listing_id, host_id, {month_day('mno')} AS month_date, nights AS stays FROM fact WHERE mno > (SELECT max(mno) FROM fact) - 12""",
        "filtered_aggs": with_parts(OBS, FACT) + f"""
SELECT {month_day('mno')} AS month_date, count(*) AS listings, count_if(coalesce(has_availability, FALSE)) AS listings_active,
  count(DISTINCT CASE WHEN has_availability THEN host_id END) AS hosts_active,
  round(CAST(min(price) FILTER ({open_price}) AS DOUBLE), 6) AS min_price_active, round(CAST(max(price) FILTER ({open_price}) AS DOUBLE), 6) AS max_price_active,
  round(quantile_cont(CAST(price AS DOUBLE), 0.5) FILTER ({open_price}), 6) AS median_price_active,
  CAST(sum(price) FILTER ({open_price}) AS DOUBLE) / nullif(CAST(count(price) FILTER ({open_price}) AS DOUBLE), 0) AS avg_price_active
FROM fact GROUP BY mno""",
        "kpi_neighbourhood_sketched": mart("neighbourhood") + audited(1),
        "kpi_trailing_sketched": mart("neighbourhood") + audited(3),
        "median_outliers": """
WITH priced AS (SELECT o_orderpriority, CAST(o_totalprice AS DECIMAL(30,2)) AS price FROM orders),
everything AS (SELECT * FROM priced UNION ALL SELECT o_orderpriority, CAST(max(price) * 1000000000 AS DECIMAL(30,2)) FROM priced GROUP BY 1)
SELECT o_orderpriority, CAST(max(price) AS DOUBLE) AS max_price, quantile_cont(CAST(price AS DOUBLE), 0.5) AS median_price
FROM everything GROUP BY o_orderpriority""",
        "monthly_fact": with_parts(OBS, FACT) + f"""
SELECT listing_id, host_id, {month_day('mno')} AS month_date, has_availability, availability_30, CAST(price AS DOUBLE) AS price,
  nights AS stays, number_of_reviews, rating AS review_scores_rating FROM fact""",
        "lookup_resolve": with_parts(OBS, AREAS) + """
SELECT listing_id, scraped_date, upper(trim(neighbourhood)) AS listing_neighbourhood, code AS LGA_CODE_2016, lga AS lga_name
FROM obs LEFT JOIN areas ON k = lower(trim(neighbourhood))""",
        "stg_listing_clean": delivered(), "stream_month_ingest": loaded, "bronze_facts_load": loaded, "stream_split_months": loaded,
        "load_redelivered_month": loaded, "load_resumed": loaded,
        "load_resumed_quarantine": with_parts(OBS) + """
SELECT listing_id, scrape_id, strftime(scraped_date, '%m_%Y') AS month_year FROM obs WHERE scrape_id % 17 = 0""",
        # the even listings first, then the odd ones and every fifth
        "load_archive_clash": with_parts(OBS) + """
SELECT month_year, CAST((first_rows > 0)::INT + (later_rows > 0)::INT AS BIGINT) AS n_files,
  CAST((first_rows > 0 AND later_rows > 0)::INT AS BIGINT) AS n_stamped, CAST(first_rows + later_rows AS BIGINT) AS n_rows
FROM (SELECT strftime(scraped_date, '%m_%Y') AS month_year, count_if(listing_id % 2 = 0) AS first_rows,
  count_if(listing_id % 2 = 1 OR listing_id % 5 = 0) AS later_rows FROM obs GROUP BY 1)""",
        "load_mixed_headers": lacks, "stream_mixed_headers": lacks,
        "silver_quarantine": with_parts(OBS) + """
SELECT listing_id, scrape_id, concat_ws(',', CASE WHEN scrape_id % 19 = 0 THEN 'scraped_date' END, CASE WHEN scrape_id % 29 = 0 THEN 'price' END) AS reason
FROM obs WHERE scrape_id % 17 <> 0 AND (scrape_id % 19 = 0 OR scrape_id % 29 = 0)""",
        "pk_guard": with_parts(OBS) + """
SELECT listing_id, scrape_id, strftime(scraped_date, '%m_%Y') AS month_year FROM obs WHERE scrape_id % 17 = 0""",
        "align_columns": with_parts(OBS) + """
SELECT listing_id, scrape_id, property_type AS PROPERTY_TYPE, CAST(NULL AS VARCHAR) AS REVIEW_SCORES_VALUE,
  strftime(scraped_date, '%m_%Y') AS MONTH_YEAR FROM obs""",
        "key_normalise": census_rows() + """
SELECT code AS LGA_CODE_2016, upper(r_name) AS lga_name, CAST(n AS INTEGER) AS Tot_P_P
FROM census LEFT JOIN region ON CAST(r_regionkey AS VARCHAR) = right(code, 1)""",
        "census_g02": census_rows() + """
SELECT code AS LGA_CODE_2016, age AS Median_age_persons, CAST(mortgage AS DOUBLE) AS Median_mortgage_repay_monthly,
  CAST(mortgage * 12 AS DOUBLE) AS annual_median_mortgage, household AS Average_household_size FROM census""",
        "dim_suburb_lga": f"""
SELECT upper(n_name) AS suburb_name, upper(r_name) AS lga_name, CAST(r_regionkey + {AREA_BASE} AS VARCHAR) AS lga_code
FROM nation JOIN region ON r_regionkey = n_regionkey""",
        "unique_violations": "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1",
        "not_null_violations": with_parts(OBS) + "\nSELECT * FROM (" + " UNION ALL ".join(
            f"SELECT '{n}' AS column_name, count_if({e} IS NULL) AS null_rows FROM obs" for n, e in checked.items()) + ") WHERE null_rows > 0",
        "declared_tests": with_parts(OBS, listing_versions(), host_versions()) + "\n" + " UNION ALL ".join(
            f"SELECT '{n}' AS column_name, 'not_null' AS test, count_if(v IS NULL) AS failures FROM ({q}) UNION ALL "
            f"SELECT '{n}', 'unique', count(*) FROM (SELECT v FROM ({q}) WHERE v IS NOT NULL GROUP BY v HAVING count(*) > 1)" for n, q in tests.items()),
        "referential_integrity": with_parts(OBS) + """
SELECT upper(trim(neighbourhood)) AS listing_neighbourhood, count(*) AS n_rows FROM obs
WHERE upper(trim(neighbourhood)) NOT IN (SELECT upper(trim(n_name)) FROM nation) GROUP BY 1""",
        "freshness": with_parts(OBS) + """
SELECT upper(trim(neighbourhood)) AS listing_neighbourhood, max(scraped_date) AS newest_date,
  CAST((SELECT max(scraped_date) FROM obs) - max(scraped_date) AS INTEGER) AS age_days,
  (SELECT max(scraped_date) FROM obs) - max(scraped_date) > 31 AS is_stale FROM obs GROUP BY 1""",
        "bronze_dims_load": census_rows() + """
SELECT k AS name_key, code AS lga_code, lga AS lga_name, CAST(n AS INTEGER) AS Tot_P_P, CAST(mortgage * 12 AS DOUBLE) AS annual_median_mortgage
FROM areas LEFT JOIN census USING (code)""",
        "month_guard_load": month_guard,
    }

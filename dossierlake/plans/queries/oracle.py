"""Building blocks of the SQL that checks the queries."""

from __future__ import annotations

from dossierlake.sources.adapters import EVENTS_SPLIT, LINES_SPLIT

KEY = "entity_type, oid, data_source, protocol, action"
HEADER = f"{KEY}, capture_time, seq"
SEP = "chr(1)"

LEVEL = "CASE WHEN value < 50 THEN 'low' WHEN value < 150 THEN 'mid' ELSE 'high' END"

E_OBS = f"""
e_k AS (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events),
e_obs AS (
  SELECT 'user' AS entity_type, CAST(user_id AS VARCHAR) AS oid, event_type AS data_source,
    {LEVEL} AS protocol, CASE WHEN hour(ts) < 12 THEN 'am' ELSE 'pm' END AS action,
    epoch_us(ts) // 1000000 AS capture_time, event_id AS seq,
    'k' || (k // 10) AS S1, {LEVEL} AS S2,
    'd' || (k % 4) || ',e' || (k % 3) || ',d' || (k % 4) AS M1
  FROM e_k)"""

O_OBS = """
o_obs AS (
  SELECT 'customer' AS entity_type, CAST(o_custkey AS VARCHAR) AS oid,
    l_returnflag AS data_source, l_linestatus AS protocol, o_orderstatus AS action,
    epoch_us(l_shipdate) // 1000000 AS capture_time, l_orderkey * 1000 + l_linenumber AS seq,
    o_orderpriority AS S1, l_returnflag || l_linestatus AS S2,
    's' || (l_suppkey % 5) || ',q' || CAST(floor(l_quantity / 10) AS BIGINT) AS M1
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

OBS = {"e": E_OBS, "o": O_OBS}
SPLIT = {"e": EVENTS_SPLIT, "o": LINES_SPLIT}


def day(seconds: str = "capture_time") -> str:
    return f"CAST(strftime(make_timestamp({seconds} * 1000000), '%Y%m%d') AS BIGINT)"


def time_text(seconds: str) -> str:
    return f"strftime(make_timestamp({seconds} * 1000000), '%Y-%m-%d %H:%M:%S')"


def attrs(p: str, repeats: bool = False, name: str | None = None, source: str | None = None) -> str:
    """CTE of attribute rows of fixture ``p``."""
    parts = "string_split(M1, ',')" if repeats else "list_distinct(string_split(M1, ','))"
    source = source or f"{p}_obs"
    return f"""
{name or p + '_attr'} AS (
  SELECT {HEADER}, 'S1' AS code, S1 AS value FROM {source}
  UNION ALL SELECT {HEADER}, 'S2', S2 FROM {source}
  UNION ALL SELECT {HEADER}, 'M1', unnest({parts}) FROM {source})"""


def base(source: str, name: str, key: str = f"{KEY}, code, value") -> str:
    """CTEs of the fold: counters and histogram per key."""
    return f"""
{name}_day AS (
  SELECT {key}, {day()} AS day, count(*) AS n, min(capture_time) AS first_time,
    max(capture_time) AS last_time FROM {source} GROUP BY ALL),
{name} AS (
  SELECT {key}, CAST(sum(n) AS BIGINT) AS cnt, min(first_time) AS first_time,
    max(last_time) AS last_time, count(*) AS day_cnt,
    string_agg(day || ':' || n, ',' ORDER BY day) AS days
  FROM {name}_day GROUP BY {key})"""


def info(source: str, name: str) -> str:
    return base(source, name, "entity_type, oid")


def info_attr(source: str, name: str) -> str:
    """CTEs of the latest single values and the multi value sets."""
    return f"""
{name}_single AS (
  SELECT entity_type, oid, code, 'single' AS kind, value, capture_time AS last_time,
    capture_time AS last_arrival_time
  FROM {source} WHERE code <> 'M1'
  QUALIFY row_number() OVER (PARTITION BY entity_type, oid, code
    ORDER BY capture_time DESC, seq, value DESC) = 1),
{name}_arrival AS (
  SELECT entity_type, oid, code, value, capture_time AS last_arrival_time
  FROM {source} WHERE code = 'M1'
  QUALIFY row_number() OVER (PARTITION BY entity_type, oid, code, value
    ORDER BY seq DESC, capture_time DESC) = 1),
{name}_multi AS (
  SELECT entity_type, oid, code, value, max(capture_time) AS last_time
  FROM {source} WHERE code = 'M1' GROUP BY ALL),
{name} AS (
  SELECT * FROM {name}_single
  UNION ALL
  SELECT m.entity_type, m.oid, m.code, 'multi', m.value, m.last_time, a.last_arrival_time
  FROM {name}_multi m JOIN {name}_arrival a USING (entity_type, oid, code, value))"""


def sides(p: str) -> str:
    """CTEs of stored and new attribute rows and observations."""
    cut = SPLIT[p]
    return f"""
{p}_old AS (SELECT * FROM {p}_attr WHERE capture_time < {cut}),
{p}_new AS (SELECT * FROM {p}_attr WHERE capture_time >= {cut}),
{p}_old_obs AS (SELECT * FROM {p}_obs WHERE capture_time < {cut}),
{p}_new_obs AS (SELECT * FROM {p}_obs WHERE capture_time >= {cut})"""


def status(old: str, new: str, name: str, key: str = KEY) -> str:
    return f"""
{name} AS (
  SELECT {key}, CASE WHEN NOT in_new THEN 'UNCHANGED' WHEN in_old THEN 'UPDATE' ELSE 'NEW' END
    AS status
  FROM (SELECT {key}, bool_or(o) AS in_old, bool_or(n) AS in_new FROM (
    SELECT {key}, true AS o, false AS n FROM {old}
    UNION ALL SELECT {key}, false, true FROM {new}) GROUP BY {key}))"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def fixture(p: str, repeats: bool = False) -> str:
    return with_(OBS[p], attrs(p, repeats))


ENTITY_KEY = f"md5(entity_type || {SEP} || oid)"


def hex_number(text: str) -> str:
    return f"CAST('0x' || {text} AS BIGINT)"


SALT = f"substr({ENTITY_KEY}, 1, 4)"


def bucket(buckets: int) -> str:
    return f"CAST(floor({hex_number(SALT)} * {buckets} / 65536) AS BIGINT)"

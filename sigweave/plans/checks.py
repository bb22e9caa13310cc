"""SQL that gives the expected result of every registered query, in DuckDB's dialect."""

from __future__ import annotations

from sigweave.plans import tables as t
from sigweave.plans.queries import (
    CHANGES,
    DAY_S,
    FLOW_FIELDS,
    NOW,
    PAIR_DELAY_MS,
    PAIR_MS,
    STAY_LIMITS,
    STAY_TIMEOUT,
    WINDOW_DELAY_MS,
    WINDOW_MS,
)

_S = t.SIGNALS_SQL
_ORDER = "PARTITION BY imsi ORDER BY ts_ms, event_id"


def _with(*ctes: str, body: str, recursive: bool = False) -> str:
    word = "WITH RECURSIVE " if recursive else "WITH "
    return word + ",\n".join(ctes) + "\n" + body


def _signals(body: str) -> str:
    return _with(_S, body=body)


PARSED = (
    "parsed AS (SELECT p[1] AS event_id, p[2] AS lac, p[3] AS ci, p[4] AS imsi,"
    " p[5] AS event_type FROM (SELECT string_split(value, ',') AS p FROM lines)"
    " WHERE len(p) = 5)"
)
PARSE = _with(_S, t.lines_sql(), PARSED, body="SELECT * FROM parsed")

PARSE_COUNTS = _with(
    _S,
    t.lines_sql(),
    body="SELECT count(*) AS lines,"
    " count(*) FILTER (len(string_split(value, ',')) <> 5) AS rejected FROM lines",
)

TYPED = _signals(
    """SELECT event_id, TRY_CAST(lac AS INT) AS lac, TRY_CAST(ci AS SMALLINT) AS ci,
  CASE WHEN k % 10 <> 0 THEN CAST(floor(value) AS DOUBLE) END AS amount,
  TRY_CAST(event_type AS INT) AS event_type, k % 2 = 0 AS even,
  TRY_CAST(concat('2024-02-', lpad(CAST(k % 31 + 1 AS STRING), 2, '0')) AS DATE) AS day, imsi
FROM signals"""
)

DERIVE = _signals(
    """SELECT * FROM (SELECT event_id, ts_ms, event_type, lac, ci, concat(lac, ':', ci) AS lac_ci,
  CASE WHEN event_type = 'purchase' THEN '1' ELSE '0' END AS is_sale, ts_ms // 3600000 AS hour
FROM signals) WHERE is_sale = '1' AND lac_ci <> '0003:1'"""
)

EVENT_SELECT = _signals(
    """SELECT event_id, concat(lac, ci) AS site, imsi, 'news' AS kind, k * 2 AS twice
FROM signals WHERE event_type IN ('click', 'view') AND length(imei) >= 8"""
)

JSON_ROUNDTRIP = """SELECT event_id, event_type, json_extract_string(props, '$.k') AS k,
  CASE WHEN user_id <> 3 THEN CAST(user_id AS STRING) END AS user_text,
  CASE WHEN user_id <> 3 THEN 3 ELSE 2 END AS members
FROM events"""

JSON_DELIMITED = _signals(
    """SELECT event_id,
  concat(imsi, '|', CASE WHEN k % 5 > 0 THEN lac ELSE '' END, '||', event_type) AS kept,
  concat_ws('|', imsi, CASE WHEN k % 5 > 0 THEN lac END, event_type) AS shifted
FROM signals"""
)

JSON_EXPLODE = _signals(
    """SELECT event_id, 'lac' AS pname, lac AS pvalue FROM signals
UNION ALL SELECT event_id, 'ci', ci FROM signals
UNION ALL SELECT event_id, 'event_type', event_type FROM signals"""
)

HEX = """WITH numbers AS (SELECT event_id, (event_id % 1000) * 137 - 5000 AS n FROM events),
codes AS (SELECT *, upper(to_hex(n & 4294967295)) AS h FROM numbers)
SELECT event_id, CAST(n AS STRING) AS number,
  CASE WHEN length(h) < 4 THEN lpad(h, 4, '0') ELSE h END AS code FROM codes"""

TIMES = _signals(
    """SELECT event_id, plain, stamp, epoch_ms(strptime(plain, '%Y-%m-%d %H:%M:%S')) AS plain_ms,
  ts_ms AS stamp_ms, strftime(moment, '%a %b %d %H:%M:%S UTC %Y') AS printed
FROM (SELECT event_id, ts_ms, make_timestamp(ts_ms * 1000) AS moment,
  strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d %H:%M:%S') AS plain,
  strftime(make_timestamp(ts_ms * 1000), '%Y%m%d %H:%M:%S.%g') AS stamp FROM signals)"""
)

OFFSETS = _signals(
    f"""SELECT event_id, CAST({NOW} AS BIGINT) AS now, {NOW} - k * 1000 AS before,
  {NOW} + k * 1000 AS after FROM signals"""
)


def _whole_km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    h = (
        f"pow(sin((radians({lat1}) - radians({lat2})) / 2), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin((radians({lon1}) - radians({lon2})) / 2), 2)"
    )
    km = f"(asin(sqrt(CASE WHEN {h} > 1 THEN 1 ELSE {h} END)) * (2 * 6378.137))"
    return f"CAST(floor(floor({km} * 10000 + 0.5) / 10000) AS DOUBLE)"


GEO = _signals(
    f"""SELECT event_id, {_whole_km('lat', 'lon', '36.65', '117.12')} AS km FROM (
SELECT event_id, CAST(34.0 + (event_id % 1000) * 0.017 AS DOUBLE) AS lat,
  CAST(115.0 - k * 0.31 AS DOUBLE) AS lon FROM signals)"""
)

COMPOSITE = _signals(
    """SELECT event_id,
  concat(imsi, ',', CASE WHEN k % 6 > 0 THEN lac ELSE '' END, ',', CAST(k AS STRING)) AS state_key,
  concat(imsi, ':', CASE WHEN k % 6 > 0 THEN lac ELSE '' END) AS event_key,
  concat(lac, CAST(k AS STRING)) AS "both" FROM signals"""
)


def _valid(column: str, shortest: int = 1) -> str:
    return (
        f"CASE WHEN length({column}) >= {shortest} AND {column} <> '000000000000000'"
        f" THEN {column} END"
    )


IDENTITY = _signals(
    f"""SELECT event_id, {_valid('callingimsi')} AS caller, {_valid('calledimsi')} AS called,
  substr({_valid('callingimei', 8)}, 1, 8) AS caller_code,
  substr({_valid('calledimei', 8)}, 1, 8) AS called_code FROM signals"""
)


def _crossed(old: str, new: str, limits, pick: str = "list_max", less: str = "<=") -> str:
    hits = f"list_filter({list(limits)}, lambda l: {old} {less} l AND {new} >= l)"
    return f"coalesce(CAST({pick}({hits}) AS STRING), '0')"


CROSSING = _signals(
    f"""SELECT event_id, {_crossed('o', 'n', [60, 10, 30])} AS greatest,
  {_crossed('o', 'n', [60, 10, 30], 'list_min')} AS least,
  CASE WHEN {_crossed('o', 'n', [60, 10, 30])} = '0' THEN '0' ELSE CAST(n AS STRING) END
    AS true_value,
  {_crossed('o', 'n', [60, 10, 30], less='<')} AS strict
FROM (SELECT event_id, CAST(k AS BIGINT) AS o, k + event_id % 40 AS n FROM signals)"""
)

SQL_FUNCTIONS = _signals(
    f"""SELECT event_id, CASE WHEN length(h) < 4 THEN lpad(h, 4, '0') ELSE h END AS code,
  {NOW} - k * 1000 AS before, {NOW} + k * 1000 AS after, ts_ms AS same_ms,
  CAST(floor(asin(sqrt(pow(sin((radians(34 + event_id % 20) - radians(36.65)) / 2), 2)
    + cos(radians(34 + event_id % 20)) * cos(radians(36.65))
    * pow(sin((radians(115) - radians(117 + k)) / 2), 2))) * (2 * 6378.137)) AS BIGINT) AS km,
  {_valid('calledimsi')} AS called, substr({_valid('imei', 8)}, 1, 8) AS code8,
  strftime(make_timestamp(ts_ms * 1000), '%a %b %d 00:00:00 UTC %Y') AS printed
FROM (SELECT *, upper(to_hex(k * 700)) AS h FROM signals)"""
)

DIMENSION = _signals(
    """SELECT event_id, CASE WHEN k % 9 > 0 THEN k END AS who, c_name, c_nationkey
FROM signals LEFT JOIN customer ON k % 9 > 0 AND k = c_custkey"""
)


def _areas(areas) -> str:
    return ", ".join(
        f"CASE WHEN list_contains(members, '{a}') THEN 'true' ELSE '' END AS area_{a}"
        for a in areas
    )


_MEMBERS = (
    "placed AS (SELECT signals.*, site_name, areas, geo_longitude, geo_latitude,"
    " list_transform(string_split(areas, ','), lambda x: trim(x)) AS members"
    " FROM signals LEFT JOIN sites USING (lac))"
)
AREA_FLAGS = _with(
    _S,
    t.SITES_SQL,
    _MEMBERS,
    body=f"SELECT event_id, lac, {_areas([*t.AREAS, 'R9'])} FROM placed",
)
AREA_ATTRIBUTES = _with(
    _S,
    t.SITES_SQL,
    body="SELECT event_id, lac, ci, coalesce(site_name, '') AS areainfo_site_name,"
    " coalesce(areas, '') AS areainfo_areas FROM signals LEFT JOIN sites USING (lac)",
)
SITE_POSITION = _with(
    _S,
    t.SITES_SQL,
    body="SELECT event_id, lac, coalesce(geo_longitude, 0.0) AS geo_longitude,"
    " coalesce(geo_latitude, 0.0) AS geo_latitude FROM signals LEFT JOIN sites USING (lac)",
)


def _party(keys: str, dim_cte: str, dim: str, dim_key: str, columns, shown: str) -> str:
    plain = ", ".join(
        f"coalesce(CASE WHEN a = own THEN da.{c} WHEN b = own THEN db.{c} END, '') AS {c}"
        for c in columns
    )
    called = ", ".join(
        f"coalesce(CASE WHEN a <> b AND b <> own THEN db.{c} END, '') AS called_{c}"
        for c in columns
    )
    calling = ", ".join(
        f"coalesce(CASE WHEN a <> b AND a <> own THEN da.{c} END, '') AS calling_{c}"
        for c in columns
    )
    return _with(
        _S,
        dim_cte,
        f"parties AS (SELECT *, {keys} FROM signals)",
        body=f"SELECT {shown}, {plain}, {called}, {calling} FROM parties"
        f" LEFT JOIN {dim} da ON da.{dim_key} = a LEFT JOIN {dim} db ON db.{dim_key} = b",
    )


PARTY = _party(
    f"imsi AS own, {_valid('callingimsi')} AS a, {_valid('calledimsi')} AS b",
    t.USERS_SQL,
    "users",
    "imsi",
    ["c_name", "c_mktsegment"],
    "event_id, parties.imsi, callingimsi, calledimsi",
)
TERMINAL = _party(
    "substr(imei, 1, 8) AS own,"
    f" CASE WHEN length(imei) >= 8 THEN substr({_valid('callingimei', 8)}, 1, 8) END AS a,"
    f" CASE WHEN length(imei) >= 8 THEN substr({_valid('calledimei', 8)}, 1, 8) END AS b",
    t.TERMINALS_SQL,
    "terminals",
    "code",
    ["p_brand", "p_type"],
    "event_id, imei, callingimei, calledimei",
)

PREVIOUS = _signals(
    f"""SELECT event_id, ts_ms, imsi, imei,
  coalesce(lag(imei) OVER ({_ORDER}), '') AS last_imei FROM signals"""
)


def _track_cte(source: str) -> str:
    steps = (
        "SELECT *, lag(lat) OVER w AS lat0, lag(lon) OVER w AS lon0, lag(ts_ms) OVER w AS t0,"
        " lag(concat(lac, ci)) OVER w AS site0 FROM (SELECT *,"
        " coalesce(geo_latitude, 0.0) AS lat, coalesce(geo_longitude, 0.0) AS lon"
        f" FROM {source}) WINDOW w AS ({_ORDER})"
    )
    return (
        "track AS (SELECT *, CASE WHEN ts_ms <> t0 THEN distance / (ts_ms - t0) END AS speed,"
        " coalesce(site0, '') AS last_lac_ci FROM (SELECT *,"
        f" {_whole_km('lat', 'lon', 'lat0', 'lon0')} AS distance FROM ({steps})))"
    )


TRACK = _with(
    _S,
    t.SITES_SQL,
    _MEMBERS,
    _track_cte("placed"),
    body="SELECT event_id, ts_ms, imsi, lac, ci, lon AS geo_longitude, lat AS geo_latitude,"
    " distance, speed, last_lac_ci FROM track",
)


def _stay_ctes(source: str, areas) -> list[str]:
    """One chain per area: previous time, break, start of the stay, label."""
    previous = ", ".join(
        f"max(CASE WHEN area_{a} = 'true' THEN ts_ms END) OVER ({_ORDER}"
        f" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pt_{a}"
        for a in areas
    )
    starts = ", ".join(
        f"max(CASE WHEN area_{a} = 'true' AND (pt_{a} IS NULL OR ts_ms - pt_{a} > {STAY_TIMEOUT})"
        f" THEN ts_ms END) OVER ({_ORDER}) AS st_{a}"
        for a in areas
    )
    labels = ", ".join(
        f"CASE WHEN area_{a} = 'true' AND st_{a} <= pt_{a} AND ts_ms > pt_{a} THEN "
        + _crossed(f"(pt_{a} - st_{a})", f"(ts_ms - st_{a})", STAY_LIMITS)
        + f" ELSE '0' END AS stay_{a}"
        for a in areas
    )
    return [
        f"stay1 AS (SELECT *, {previous} FROM {source})",
        f"stay2 AS (SELECT *, {starts} FROM stay1)",
        f"stays AS (SELECT *, {labels} FROM stay2)",
    ]


def _stay_list(areas) -> str:
    return ", ".join(f"stay_{a}" for a in areas)


STAY = _with(
    _S,
    t.SITES_SQL,
    _MEMBERS,
    f"flagged AS (SELECT *, {_areas(t.AREAS)} FROM placed)",
    *_stay_ctes("flagged", t.AREAS),
    body=f"SELECT event_id, imsi, {_stay_list(t.AREAS)} FROM stays",
)


def _throttle_ctes(source: str, seconds: int) -> list[str]:
    return [
        f"emits AS (SELECT imsi, min(ts_ms) AS sent FROM {source} GROUP BY imsi UNION ALL"
        f" SELECT r.imsi, min(r.ts_ms) FROM emits e JOIN {source} r ON r.imsi = e.imsi"
        f" AND r.ts_ms >= e.sent + {seconds * 1000} GROUP BY r.imsi)",
        f"kept AS (SELECT {source}.* FROM {source} JOIN emits ON {source}.imsi = emits.imsi"
        " AND ts_ms = sent QUALIFY row_number() OVER"
        f" (PARTITION BY {source}.imsi, ts_ms ORDER BY event_id) = 1)",
    ]


THROTTLE = _with(
    _S,
    "wanted AS (SELECT event_id, ts_ms, imsi, event_type FROM signals)",
    *_throttle_ctes("wanted", DAY_S),
    body="SELECT * FROM kept",
    recursive=True,
)

LATEST = _signals(
    """SELECT event_id, ts_ms, imsi, event_type, value FROM signals
QUALIFY row_number() OVER (PARTITION BY imsi ORDER BY ts_ms DESC, event_id DESC) = 1"""
)
LATEST_EVENT = _signals(
    """SELECT event_id, ts_ms, value, imsi FROM signals WHERE event_type = 'purchase'
QUALIFY row_number() OVER (PARTITION BY imsi ORDER BY ts_ms DESC, event_id DESC) = 1"""
)
SNAPSHOT = _signals(
    """SELECT imsi, arg_max(imei, struct_pack(a := ts_ms, b := event_id)) AS last_imei_seen
FROM signals GROUP BY imsi"""
)
GREATEST = _signals(
    """SELECT imsi, max(concat_ws(',', imei, event_type, lac)) AS value FROM signals GROUP BY imsi"""
)

_STAMP = f"strftime(make_timestamp({NOW} * 1000), '%Y%m%d %H:%M:%S.%g')"
_LAC = "CASE WHEN k % 8 > 0 THEN lac END"
MESSAGE = _signals(
    f"""SELECT concat(imsi, ',', coalesce(l, '')) AS key,
  concat_ws('|', event_id, coalesce(l, ''), event_type, {_STAMP}) AS value, 'out' AS topic
FROM (SELECT *, {_LAC} AS l FROM signals)"""
)
WHOLE_ROW = _signals(
    f"""SELECT l AS key,
  concat_ws(',', event_id, imsi, coalesce(l, ''), event_type, {_STAMP}) AS value
FROM (SELECT *, {_LAC} AS l FROM signals)"""
)
PARTITION = _signals(
    """SELECT event_id, key, event_type AS value,
  CAST(abs(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END) % 12 AS INT) AS partition
FROM (SELECT *, list_reduce(list_transform(string_split(key, ''), lambda c: CAST(ascii(c) AS BIGINT)),
  lambda acc, c: (acc * 31 + c) % 4294967296, CAST(0 AS BIGINT)) AS h
FROM (SELECT event_id, event_type, concat(imsi, '/', imei) AS key FROM signals))"""
)

FAN_OUT = _with(
    _S,
    "wanted AS (SELECT * FROM signals WHERE event_type IN ('view', 'click') AND k < 50)",
    *_throttle_ctes("wanted", DAY_S),
    body=f"""SELECT imsi AS key, concat_ws('|', event_id, concat(lac, ':', ci), 'S', {_STAMP}) AS value,
  'sales' AS topic FROM signals WHERE event_type = 'purchase'
UNION ALL SELECT imsi, concat_ws(',', event_id, concat(lac, ':', ci), 'S', {_STAMP}), 'copy'
FROM signals WHERE event_type = 'purchase'
UNION ALL SELECT imsi, concat_ws(';', event_id, event_type, {_STAMP}), 'visits' FROM kept""",
    recursive=True,
)

CHAIN = _with(
    _S,
    t.SITES_SQL,
    _MEMBERS,
    f"flagged AS (SELECT *, {_areas(t.AREAS)} FROM placed)",
    *_stay_ctes("flagged", t.AREAS),
    _track_cte("stays"),
    body=f"""SELECT event_id, imsi, coalesce(site_name, '') AS areainfo_site_name,
  coalesce(lag(imei) OVER ({_ORDER}), '') AS last_imei, distance, speed, last_lac_ci,
  distance > 0 AS moved, {_stay_list(t.AREAS)} FROM track""",
)

_FLOW_NAMES = [f["pname"] for f in FLOW_FIELDS]
_STAMPED = "strftime(make_timestamp(ts_ms * 1000), '%Y%m%d %H:%M:%S.%g')"


def _flow_ctes(time: str = _STAMPED) -> list[str]:
    return [
        _S.replace("signals AS", "base AS", 1),
        f"signals AS (SELECT *, {time} AS time FROM base)",
        t.SITES_SQL,
        t.lines_sql(_FLOW_NAMES),
        "parts AS (SELECT string_split(value, ',') AS p FROM lines)",
        "rows AS (SELECT CAST(p[1] AS BIGINT) AS event_id, p[2] AS time, p[3] AS lac,"
        " p[4] AS ci, p[5] AS imsi, p[6] AS event_type,"
        " epoch_ms(try_strptime(p[2], '%Y%m%d %H:%M:%S.%g')) AS ts_ms"
        " FROM parts WHERE len(p) = 6 AND p[6] <> '')",
        "placed AS (SELECT rows.*, list_transform(string_split(areas, ','), lambda x: trim(x))"
        " AS members FROM rows LEFT JOIN sites USING (lac))",
        f"flagged AS (SELECT *, {_areas(['R1', 'R2'])} FROM placed)",
    ]


FLOW = _with(
    *_flow_ctes(),
    *_stay_ctes("flagged", ["R1", "R2"]),
    "wanted AS (SELECT * FROM stays WHERE stay_R1 <> '0' OR stay_R2 <> '0')",
    *_throttle_ctes("wanted", 3 * DAY_S),
    body=f"""SELECT imsi AS key,
  concat_ws(',', event_id, time, event_type, stay_R1, stay_R2, 'stay', {_STAMP}) AS value,
  'stays' AS topic FROM kept""",
    recursive=True,
)

BAD_TIME = _with(
    *_flow_ctes(f"CASE WHEN event_id % 13 = 0 THEN 'no time' ELSE {_STAMPED} END"),
    "timed AS (SELECT * FROM flagged WHERE ts_ms IS NOT NULL)",
    *_stay_ctes("timed", ["R1", "R2"]),
    body="""SELECT event_id, time, stay_R1, stay_R2 FROM stays
UNION ALL SELECT event_id, time, '0', '0' FROM flagged WHERE ts_ms IS NULL""",
)

LATEST_KEPT = _with(
    *_flow_ctes(),
    "sales AS (SELECT *, row_number() OVER (PARTITION BY imsi ORDER BY ts_ms DESC, event_id DESC)"
    " AS n FROM rows WHERE event_type = 'purchase')",
    body="SELECT imsi, event_id, time, ts_ms FROM sales WHERE n = 1",
)

SITE_AS_OF = _with(
    _S,
    t.SITE_MOVES_SQL,
    # Of the moves of one moment the last order's holds.
    "moves AS (SELECT lac, valid_from, max_by(o_orderkey, o_orderkey) AS o_orderkey,"
    " max_by(geo_longitude, o_orderkey) AS geo_longitude,"
    " max_by(geo_latitude, o_orderkey) AS geo_latitude FROM site_moves GROUP BY lac, valid_from)",
    body="SELECT s.event_id, s.lac, m.o_orderkey, m.geo_longitude, m.geo_latitude"
    " FROM signals s ASOF LEFT JOIN moves m ON s.lac = m.lac AND s.ts_ms >= m.valid_from",
)

EVENTS_IN_PERIODS = _with(
    _S,
    t.PERIODS_SQL,
    body="SELECT event_id, o_orderkey FROM signals JOIN periods"
    " ON start_ms <= ts_ms AND ts_ms < end_ms",
)

CHANGING_DIMENSION = _with(
    _S,
    t.SITES_SQL,
    f"arrived AS (SELECT event_id, lac, event_id % {CHANGES} AS version FROM signals)",
    # Each part meets the sites as they were when it arrived.
    "placed AS (SELECT a.event_id, a.lac, site_name || '/' || version AS name,"
    " list_transform(string_split(areas, ','), lambda x: trim(x)) AS members FROM arrived a"
    " LEFT JOIN sites s ON s.lac = a.lac AND CAST(s.lac AS INT) % 5 <> version)",
    body=f"SELECT event_id, lac, {_areas(['R1', 'R2'])}, coalesce(name, '') AS areainfo_site_name"
    " FROM placed",
)

CONFIGURED = _with(
    _S,
    t.SITES_SQL,
    "lines AS (SELECT *, CAST(event_id AS VARCHAR) AS id, CASE WHEN event_id % 89 = 0 THEN ''"
    " ELSE event_type END AS kind FROM signals WHERE event_id % 97 <> 0 OR event_id % 89 = 0)",
    "kept AS (SELECT l.*, lag(imei, 1, '') OVER (PARTITION BY imsi ORDER BY ts_ms, id) AS last_imei"
    " FROM lines l WHERE kind <> '')",
    "placed AS (SELECT k.*, site_name, list_transform(string_split(areas, ','), lambda x: trim(x))"
    " AS members FROM kept k LEFT JOIN sites s ON s.lac = k.lac AND k.ci IN ('0', '1', '2'))",
    body=f"""SELECT imsi AS key, concat_ws('#', id, lpad(upper(to_hex(CAST(lac AS INT))), 4, '0') || ':'
    || lpad(upper(to_hex(CAST(ci AS INT))), 4, '0'), last_imei, coalesce(site_name, ''), '1',
    {_STAMP}) AS value, 'moves' AS topic
FROM placed WHERE list_contains(members, 'R1') AND last_imei <> '' AND last_imei <> imei""",
)

# The watermark of a part is what the parts before it have reached.
WINDOWS = _with(
    _S,
    f"rows AS (SELECT lac, ts_ms, k, {t.LATE_PART} AS part,"
    f" ts_ms // {WINDOW_MS} * {WINDOW_MS} AS start_ms FROM signals)",
    f"passed AS (SELECT p, (SELECT max(ts_ms) FROM rows WHERE part < p) - {WINDOW_DELAY_MS} AS mark"
    " FROM (SELECT unnest([0, 1, 2, 3]) AS p))",
    f"judged AS (SELECT r.*, start_ms + {WINDOW_MS} AS end_ms,"
    f" coalesce(start_ms + {WINDOW_MS} <= mark, false) AS late FROM rows r JOIN passed ON p = part)",
    body="""SELECT CASE WHEN late THEN 'late' ELSE 'window' END AS kind, lac, start_ms, end_ms,
  count(*) AS n, CAST(sum(k) AS DOUBLE) AS k
FROM judged WHERE late OR end_ms <= (SELECT mark FROM passed WHERE p = 3)
GROUP BY late, lac, start_ms, end_ms""",
)

def _passed_limit(old: str, new: str) -> str:
    return (
        f"coalesce(CAST(list_max(list_filter({STAY_LIMITS}, lambda l: {old} <= l AND l <= {new}))"
        " AS VARCHAR), '0')"
    )


# One row after another in order of arrival; with one area its last time is the key's.
LATE_STAY = _with(
    _S,
    t.SITES_SQL,
    f"rows AS (SELECT event_id, imsi, ts_ms, {t.LATE_PART} AS part, coalesce(list_contains("
    "list_transform(string_split(areas, ','), lambda x: trim(x)), 'R1'), false) AS here"
    " FROM signals LEFT JOIN sites USING (lac))",
    "inside AS (SELECT *, row_number() OVER (PARTITION BY imsi ORDER BY part, ts_ms, event_id) AS n"
    " FROM rows WHERE here)",
    f"""walk AS (
  SELECT imsi, n, event_id, ts_ms AS first, ts_ms AS last, '0' AS stay_R1 FROM inside WHERE n = 1
  UNION ALL
  SELECT i.imsi, i.n, i.event_id,
    CASE WHEN i.ts_ms - w.last > {STAY_TIMEOUT} THEN i.ts_ms WHEN w.last - i.ts_ms > {STAY_TIMEOUT}
      THEN w.first ELSE least(w.first, i.ts_ms) END,
    CASE WHEN w.last - i.ts_ms > {STAY_TIMEOUT} THEN w.last ELSE greatest(w.last, i.ts_ms) END,
    CASE WHEN abs(i.ts_ms - w.last) > {STAY_TIMEOUT} THEN '0'
      WHEN i.ts_ms < w.first THEN {_passed_limit("w.last - w.first", "w.last - i.ts_ms")}
      WHEN i.ts_ms <= w.last THEN '0'
      ELSE {_passed_limit("w.last - w.first", "i.ts_ms - w.first")} END
  FROM walk w JOIN inside i ON i.imsi = w.imsi AND i.n = w.n + 1)""",
    body="SELECT event_id, stay_R1 FROM walk"
    " UNION ALL SELECT event_id, '0' FROM rows WHERE NOT here",
    recursive=True,
)

ROLLED_UP = _with(
    _S,
    "rows AS (SELECT lac, event_type, ts_ms // 3600000 % 24 AS hour, k FROM signals)",
    body="""SELECT lac, event_type, hour, GROUPING_ID(lac, event_type, hour) AS grouping,
  count(*) AS n, CAST(sum(k) AS BIGINT) AS sum_k, true AS users_close FROM rows
GROUP BY GROUPING SETS ((lac, event_type, hour), (lac, event_type), (hour), ())""",
)

PAIRS = _with(
    _S,
    "clicks AS (SELECT imsi, event_id AS click_id, ts_ms // 60000 * 60000 + 15000 AS click_ms"
    " FROM signals WHERE event_type = 'click')",
    "sales AS (SELECT imsi, event_id AS sale_id, ts_ms // 60000 * 60000 + 30000 AS sale_ms"
    " FROM signals WHERE event_type = 'purchase')",
    "mark AS (SELECT least((SELECT max(click_ms) FROM clicks), (SELECT max(sale_ms) FROM sales))"
    f" - {PAIR_DELAY_MS} AS reached)",
    body=f"""SELECT c.imsi, click_id, click_ms, sale_id, sale_ms FROM clicks c LEFT JOIN sales s
  ON s.imsi = c.imsi AND sale_ms BETWEEN click_ms AND click_ms + {PAIR_MS}
WHERE sale_id IS NOT NULL OR click_ms + {PAIR_MS} < (SELECT reached FROM mark)""",
)

CHECKS = {
    "parse_delimited": PARSE,
    "parse_counts": PARSE_COUNTS,
    "typed_cast": TYPED,
    "derive_filter": DERIVE,
    "event_select": EVENT_SELECT,
    "json_roundtrip": JSON_ROUNDTRIP,
    "json_to_delimited": JSON_DELIMITED,
    "json_array_explode": JSON_EXPLODE,
    "hex_code": HEX,
    "time_convert": TIMES,
    "time_offset": OFFSETS,
    "geo_distance": GEO,
    "composite_key": COMPOSITE,
    "identity_clean": IDENTITY,
    "threshold_crossing": CROSSING,
    "sql_functions": SQL_FUNCTIONS,
    "dimension_lookup": DIMENSION,
    "area_flags": AREA_FLAGS,
    "area_attributes": AREA_ATTRIBUTES,
    "site_position": SITE_POSITION,
    "site_as_of": SITE_AS_OF,
    "events_in_periods": EVENTS_IN_PERIODS,
    "changing_dimension_stream": CHANGING_DIMENSION,
    "party_info": PARTY,
    "terminal_info": TERMINAL,
    "previous_value": PREVIOUS,
    "user_track": TRACK,
    "location_stay": STAY,
    "event_throttle": THROTTLE,
    "event_throttle_stream": THROTTLE,
    "dedup_latest": LATEST,
    "latest_event_row": LATEST_EVENT,
    "state_snapshot": SNAPSHOT,
    "greatest_payload": GREATEST,
    "windows_stream": WINDOWS,
    "pair_stream": PAIRS,
    "late_stay": LATE_STAY,
    "late_stay_stream": LATE_STAY,
    "rollup_stream": ROLLED_UP,
    "keyed_message": MESSAGE,
    "whole_row_message": WHOLE_ROW,
    "fan_out_sinks": FAN_OUT,
    "partition_by_key": PARTITION,
    "text_stream_ingest": PARSE,
    "rule_chain": CHAIN,
    "rule_chain_stream": CHAIN,
    "rule_chain_resumed": CHAIN,
    "enriched_events": FLOW,
    "enriched_events_stream": FLOW,
    "configured_pipeline": CONFIGURED,
    "bad_time_stream": BAD_TIME,
    "latest_without_sink": LATEST_KEPT,
    "latest_table_stream": LATEST_KEPT,
}

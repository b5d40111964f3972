"""The same queries as SQL, for the comparison with another engine."""

from __future__ import annotations

from daybook.functions.choices import CITY_NOT_FOUND, NO_TEMPERATURE, OK, WEATHER_UNAVAILABLE
from daybook.operators.rules import GREATER_THAN_MESSAGE, HELP_ADDRESS, NON_EMPTY_MESSAGE
from daybook.plans.queries import (
    ARRIVALS,
    CALENDAR_MONTHS,
    DELAY,
    GAP,
    HORIZON,
    LATENESS,
    MISSING_FROM,
    POINTS,
    SLIDE,
    WIDE,
)
from daybook.operators.texts import LINES_PER_PART

_FAILED_RULES = f"""
SELECT c_custkey, 0 AS nr, 'c_name' AS field, 'string_too_short' AS type,
       '{NON_EMPTY_MESSAGE}' AS message,
       coalesce('''' || c_name || '''', 'None') AS input_value,
       CASE WHEN c_name IS NULL THEN 'NoneType' ELSE 'str' END AS input_type
FROM customer WHERE NOT coalesce(length(c_name) >= 1, false)
UNION ALL
SELECT c_custkey, 1, 'c_acctbal', 'greater_than', '{GREATER_THAN_MESSAGE.format(bound=0)}',
       coalesce(CAST(c_acctbal AS VARCHAR), 'None'),
       CASE WHEN c_acctbal IS NULL THEN 'NoneType' ELSE 'float' END
FROM customer WHERE NOT coalesce(c_acctbal > 0, false)
"""

def _problem(field: str, kind: str, message: str, value: str, value_type: str) -> str:
    return (
        f"'{field}' || chr(10) || '  {message} [type={kind}, input_value=' || {value}"
        f" || ', input_type={value_type}]' || chr(10)"
        f" || '    For further information visit {HELP_ADDRESS}{kind}'"
    )


_RAW_SALES = """
WITH raw AS (
  SELECT CASE WHEN c_custkey % 17 = 0 THEN ''
      ELSE '2024-' || lpad(CAST(c_custkey % 12 + 1 AS VARCHAR), 2, '0') END AS month,
    CASE WHEN c_custkey % 19 = 0 THEN NULL WHEN c_custkey % 23 = 1 THEN '  a '
      WHEN c_custkey % 23 = 2 THEN ' ' WHEN c_custkey % 23 = 3 THEN 'say "x", y'
      ELSE c_name END AS region,
    CAST(floor(c_acctbal) AS BIGINT) AS amount,
    CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 7 = 1 THEN ''
      ELSE c_mktsegment END AS category
  FROM customer)
"""

_SALES = """
WITH sales AS (
  SELECT n_name AS region, c_mktsegment AS category, strftime(o_orderdate, '%Y-%m') AS month,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey)
"""

_FIGURES = """CAST(sum(amount) AS DOUBLE) AS total, count(amount) AS records,
  CAST(sum(amount) AS DOUBLE) / count(amount) AS mean"""

_HIDDEN = (
    r"(?is)<!--.*?(?:-->|\z)|<script(?:\s[^>]*)?>.*?(?:</script\s*>|\z)"
    r"|<style(?:\s[^>]*)?>.*?(?:</style\s*>|\z)"
)


def _shown(html: str = "html") -> str:
    return f"regexp_replace({html}, '{_HIDDEN}', '', 'g')"


def _plain(text: str) -> str:
    breaks = f"regexp_replace({text}, '(?i)<br\\s*/?>', chr(10), 'g')"
    return f"regexp_replace(regexp_replace({breaks}, '(?s)<[^>]*>', '', 'g'), '^\\s+|\\s+$', '', 'g')"


def _by(*dimensions: str) -> str:
    names = ", ".join(dimensions)
    return f"{_SALES} SELECT {names}, {_FIGURES} FROM sales GROUP BY {names}"


_LAST_CHOICE = """
SELECT user_id, event_type, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS nr
  FROM events) WHERE nr = 1
"""

_AS_OF = """
SELECT c.event_id, c.user_id, v.event_id AS view_id, v.value
FROM (SELECT * FROM events WHERE event_type = 'click') c
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v
  ON c.user_id = v.user_id AND c.ts >= v.ts
"""

_CITIES = """
WITH cities AS (
  SELECT n_nationkey AS city, n_name AS label, c_custkey AS station, c_acctbal AS latitude,
         CAST(c_nationkey AS DOUBLE) AS longitude
  FROM nation LEFT JOIN (
    SELECT c_nationkey, min(c_custkey) AS c_custkey, arg_min(c_acctbal, c_custkey) AS c_acctbal
    FROM customer WHERE length(c_name) >= 1 AND c_acctbal > 0 AND c_nationkey % 6 <> 5
    GROUP BY c_nationkey) ON c_nationkey = n_nationkey)
"""

_ANCHORS = rf"""
SELECT page_id, url, nr - 1 AS pos, regexp_replace(regexp_extract(tag,
         '(?is)\shref\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)', 1), '^["'']|["'']$', '', 'g') AS href
FROM (SELECT page_id, url, unnest(tags) AS tag, generate_subscripts(tags, 1) AS nr
      FROM (SELECT page_id, url, regexp_extract_all({_shown()}, '(?is)<a\s[^>]*>') AS tags
            FROM pages))
WHERE regexp_matches(tag, '(?is)\shref\s*=')
"""

_KIND = r"""CASE WHEN lower(href) LIKE 'mailto:%' THEN 'mailto'
  WHEN regexp_matches(href, '^([A-Za-z][A-Za-z0-9+.-]*:|//)') THEN 'external'
  ELSE 'internal' END"""

_SENT = """
WITH sent AS (
  SELECT c_custkey, substring(c_name, 1, CAST(2 + c_custkey % 17 AS INT)) AS user_id,
         CAST(c_custkey % 11 AS INT) AS password_length,
         CASE WHEN c_custkey % 5 <> 0 THEN 'a ' || c_custkey END AS user_name,
         CASE c_custkey % 7 WHEN 1 THEN '2001-02-28' END AS birth,
         CASE WHEN c_custkey % 2 = 0 THEN 'female' ELSE 'male' END AS gender,
         CASE c_custkey % 4 WHEN 0 THEN 'uiux,backend' WHEN 1 THEN 'chess' ELSE '' END AS interests,
         CASE WHEN c_custkey % 6 = 1 THEN 'sns' END AS join_path,
         CAST(c_custkey % 203 AS INT) AS intro_length
  FROM customer)
"""

_PART = "SELECT p_partkey AS page_id, p_brand, p_type, p_size, p_size % 3 + 1 AS high, p_size % 4 + 1 AS wide FROM part"

_RAW_ROWS = f"{_RAW_SALES} SELECT region, category, amount, month FROM raw"

_ARRIVED = f"""
WITH marks AS (
  SELECT batch, max(latest) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    - INTERVAL '{DELAY}' AS mark
  FROM (SELECT event_id % {ARRIVALS} AS batch, max(ts) AS latest FROM events GROUP BY ALL)),
arrived AS (SELECT events.*, mark IS NOT NULL AND ts <= mark AS late
  FROM events JOIN marks ON batch = event_id % {ARRIVALS}),
over AS (SELECT max(ts) - INTERVAL '{DELAY}' AS mark FROM events)"""
_WINDOW_FIGURES = """count(*) AS events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total"""
_SHOWN = "'%Y-%m-%d %H:%M:%S'"

_FACTS = rf"""nullif(regexp_extract(regexp_extract(shown, '(?is)<html(?:\s[^>]*)?>'), '\slang="([^"]*)"', 1), '') AS lang,
  nullif({_plain("regexp_extract(shown, '(?is)<title(?:\\s[^>]*)?>(.*?)</title>', 1)")}, '') AS title,
  nullif(regexp_extract(regexp_extract(shown, '(?is)<meta\s[^>]*?name="description"[^>]*>'),
    '\scontent="([^"]*)"', 1), '') AS description"""

_REJECTS = f"""
SELECT month, region, amount, category, CAST(len(failed) AS VARCHAR)
  || CASE WHEN len(failed) = 1 THEN ' validation error for ' ELSE ' validation errors for ' END
  || 'SalesRecord' || chr(10) || array_to_string(failed, chr(10)) AS error
FROM (SELECT *, list_filter([
    CASE WHEN length(month) = 0 THEN {_problem("month", "string_too_short", NON_EMPTY_MESSAGE, "chr(39) || chr(39)", "str")} END,
    CASE WHEN region IS NULL THEN {_problem("region", "string_too_short", NON_EMPTY_MESSAGE, "'None'", "NoneType")} END,
    CASE WHEN amount <= 0 THEN {_problem("amount", "greater_than", GREATER_THAN_MESSAGE.format(bound=0), "CAST(amount AS VARCHAR)", "int")} END
  ], lambda x: x IS NOT NULL) AS failed FROM raw)
WHERE len(failed) > 0
"""

_SIDES = """
WITH e AS (SELECT CASE WHEN event_id % 3 = 0 THEN 0 WHEN event_id % 7 <> 1 THEN event_id % 400 END AS k,
    event_id, event_type FROM events),
s AS (SELECT CASE WHEN s_suppkey % 3 = 0 THEN 0 WHEN s_suppkey % 7 <> 1 THEN s_suppkey % 300 END AS k,
    s_suppkey, s_nationkey FROM supplier)"""
_LINES = """
WITH lines AS (SELECT l_extendedprice AS price, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem)"""
_LINE_ORDER = "price, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity"
_LATER = """
WITH later AS (
  SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 13 = 0 THEN c_acctbal + 1
      WHEN c_custkey % 31 <> 0 THEN c_acctbal END AS c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 11 <> 0
  UNION ALL SELECT c_custkey + 1000000000, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 17 = 0
  UNION ALL SELECT * FROM customer WHERE c_custkey % 19 = 0),
net AS (
  SELECT 'added' AS kind, count(*) AS times, * FROM (SELECT * FROM later EXCEPT ALL SELECT * FROM customer) GROUP BY ALL
  UNION ALL
  SELECT 'removed', count(*), * FROM (SELECT * FROM customer EXCEPT ALL SELECT * FROM later) GROUP BY ALL)"""

ORACLES: dict[str, str] = {
    "accepted_rows": """
SELECT c_custkey, c_name, c_acctbal AS amount, c_mktsegment FROM customer
WHERE length(c_name) >= 1 AND c_acctbal > 0
""",
    "rejected_rows": f"""
SELECT c_custkey, field, type, message, input_value, input_type FROM ({_FAILED_RULES})
""",
    "error_texts": f"""
SELECT c_custkey,
  CAST(count(*) AS VARCHAR)
  || CASE WHEN count(*) = 1 THEN ' validation error for ' ELSE ' validation errors for ' END
  || 'Customer' || chr(10)
  || string_agg(field || chr(10) || '  ' || message || ' [type=' || type || ', input_value='
       || input_value || ', input_type=' || input_type || ']' || chr(10)
       || '    For further information visit {HELP_ADDRESS}' || type, chr(10) ORDER BY nr) AS error
FROM ({_FAILED_RULES}) GROUP BY c_custkey
""",
    "score_reasons": """
SELECT event_id, reason, CASE WHEN reason = 'ok' THEN score END AS score,
  CASE reason WHEN 'not_a_number' THEN '숫자를 입력해주세요.'
    WHEN 'out_of_range' THEN '0점부터 100점 사이의 값을 입력해주세요.' END AS told
FROM (SELECT event_id, score,
  CASE WHEN event_id % 13 < 3 THEN 'not_a_number' WHEN event_id % 13 = 4 THEN NULL
    WHEN event_id % 13 IN (3, 6) OR score NOT BETWEEN 0 AND 100 THEN 'out_of_range'
    ELSE 'ok' END AS reason
  FROM (SELECT event_id, CASE event_id % 13 WHEN 5 THEN 5 WHEN 7 THEN 5 WHEN 8 THEN 15
    ELSE value END AS score FROM events))
""",
    "secret_numbers": """
SELECT c_custkey,
  CAST(CAST('0x' || substring(md5(CAST(c_custkey AS VARCHAR)), 1, 12) AS BIGINT) % 50 + 1 AS INT) AS secret
FROM customer
""",
    "json_array_rows": _RAW_ROWS,
    "assigned_array_rows": _RAW_ROWS,
    "array_line_rows": _RAW_ROWS,
    "split_array_rows": _RAW_ROWS,
    "written_accepted": f"""{_RAW_SALES}
SELECT month, region, CAST(amount AS DOUBLE) AS amount, category FROM raw
WHERE length(month) >= 1 AND length(region) >= 1 AND amount > 0
""",
    "written_rejects": f"{_RAW_SALES} {_REJECTS}",
    "written_split": f"""{_RAW_SALES}
SELECT month, region, CAST(amount AS DOUBLE) AS amount, category, NULL AS error FROM raw
WHERE length(month) >= 1 AND length(region) >= 1 AND amount > 0
UNION ALL SELECT month, region, CAST(amount AS DOUBLE), category, error FROM ({_REJECTS})
""",
    "literal_points": f"""
SELECT user_id, CAST(pos AS INTEGER) AS pos, event_type, CAST(sum(points) AS BIGINT) AS points
FROM events JOIN (VALUES {", ".join(f"({pos}, '{kind}', {count})" for pos, (kind, count) in enumerate(POINTS))})
  AS t(pos, event_type, points) USING (event_type) GROUP BY ALL
""",
    "page_files": rf"""
SELECT {_FACTS}, length(html) AS chars
FROM (SELECT html, {_shown()} AS shown FROM pages)
""",
    "form_submissions": f"{_SENT} SELECT * FROM sent",
    "form_violations": f"""{_SENT}
SELECT c_custkey, 'userId' AS field, 'length' AS type FROM sent
  WHERE length(user_id) > 0 AND length(user_id) NOT BETWEEN 4 AND 15
UNION ALL SELECT c_custkey, 'userId', 'required' FROM sent WHERE length(user_id) = 0
UNION ALL SELECT c_custkey, 'userPw_len', 'required' FROM sent WHERE password_length = 0
UNION ALL SELECT c_custkey, 'userPw_len', 'length' FROM sent WHERE password_length BETWEEN 1 AND 7
UNION ALL SELECT c_custkey, 'emailDomain', 'choice' FROM sent WHERE c_custkey % 3 = 0
UNION ALL SELECT c_custkey, 'userName', 'required' FROM sent WHERE user_name IS NULL
UNION ALL SELECT c_custkey, 'userBirth_text', 'date' FROM sent WHERE c_custkey % 7 = 0
UNION ALL SELECT c_custkey, 'interest', 'choice' FROM sent WHERE interests = 'chess'
UNION ALL SELECT c_custkey, 'intro', 'length' FROM sent WHERE intro_length > 200
""",
    "payload_fields": """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
""",
    "payload_answers": """
SELECT c_custkey, CASE WHEN c_custkey % 5 > 1 THEN c_acctbal END AS latitude,
  CASE WHEN c_custkey % 5 > 1 THEN CAST(c_nationkey AS DOUBLE) END AS longitude,
  CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal END AS temperature,
  CAST(55 AS DOUBLE) AS humidity
FROM customer
""",
    "query_params": r"""
SELECT page_id, nr - 1 AS pos,
  url_decode(replace(regexp_extract(pair, '^([^=]*)', 1), '+', '%20')) AS key,
  url_decode(replace(regexp_extract(pair, '^[^=]*=(.*)$', 1), '+', '%20')) AS value
FROM (SELECT page_id, unnest(pairs) AS pair, generate_subscripts(pairs, 1) AS nr
      FROM (SELECT page_id, list_filter(string_split(
                     regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'), lambda p: p <> '') AS pairs
            FROM pages))
""",
    "label_lookup": """
SELECT c_custkey, n_name AS nation, r_name AS region FROM customer
LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
""",
    "city_labels": """
SELECT event_id,
  CASE user_id % 5 WHEN 0 THEN 'Seoul' WHEN 1 THEN 'Busan' WHEN 2 THEN 'Gwangju'
    WHEN 3 THEN 'Daejeon' ELSE 'Jeju' END AS city,
  CASE user_id % 5 WHEN 0 THEN '서울' WHEN 1 THEN '부산' WHEN 2 THEN '광주'
    WHEN 3 THEN '대전' END AS label
FROM events
""",
    "first_match": """
SELECT n_nationkey, n_name, c_custkey, c_acctbal FROM nation LEFT JOIN (
  SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS nr
  FROM customer) ON c_nationkey = n_nationkey AND nr = 1
""",
    "current_value": f"SELECT event_id, user_id, value AS view_value FROM ({_AS_OF})",
    "observed_value": _AS_OF,
    "observed_value_cut": _AS_OF,
    "label_lookup_salted": """
SELECT c_custkey, n_name AS nation FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
""",
    "enriched_status": f"""{_CITIES}
SELECT e.event_id, e.user_id, label,
  CASE WHEN station IS NULL THEN '{CITY_NOT_FOUND}'
    WHEN view_id IS NULL THEN '{WEATHER_UNAVAILABLE}'
    WHEN seen_value >= {MISSING_FROM} THEN '{NO_TEMPERATURE}' ELSE '{OK}' END AS status,
  printf('%.4f', latitude) AS latitude_text,
  printf('%.4f', longitude) AS longitude_text,
  CASE WHEN seen_value < {MISSING_FROM} THEN seen_value END AS temperature,
  CASE WHEN station IS NULL THEN '도시 정보를 찾을 수 없습니다.'
    WHEN view_id IS NULL THEN '날씨 정보를 불러올 수 없습니다.'
    WHEN seen_value >= {MISSING_FROM} THEN '날씨 데이터를 불러올 수 없습니다.'
    ELSE '🌡️ 온도: ' || regexp_replace(CAST(seen_value AS VARCHAR), '[.]0$', '') || '°C' || chr(10)
      || '💧 습도: ' || CAST(longitude AS INT) || '%' END AS told
FROM (SELECT event_id, user_id, ts, cities.* FROM events LEFT JOIN cities ON city = user_id % 25
      WHERE event_type = 'click') e
ASOF LEFT JOIN (SELECT event_id AS view_id, user_id AS seen_by, ts AS seen, value AS seen_value
                FROM events WHERE event_type = 'view') v
  ON e.station = v.seen_by AND e.ts >= v.seen
""",
    "last_choice": _LAST_CHOICE,
    "score_result": """
WITH firsts AS (
  SELECT user_id, event_type, value FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS nr
    FROM events
    WHERE event_type IN ('click', 'view', 'purchase') AND value BETWEEN 0 AND 100) WHERE nr = 1),
totals AS (
  SELECT user_id, max(value) FILTER (event_type = 'click')
    + max(value) FILTER (event_type = 'view') + max(value) FILTER (event_type = 'purchase') AS total
  FROM firsts GROUP BY user_id HAVING count(*) = 3)
SELECT user_id, total, total / 3 AS mean,
  CASE WHEN total / 3 >= 60 THEN '합격' ELSE '불합격' END AS result,
  '총점: ' || regexp_replace(CAST(total AS VARCHAR), '[.]0$', '') || '점, 평균: '
    || regexp_replace(CAST(total / 3 AS VARCHAR), '[.]0$', '') || ', 결과: '
    || CASE WHEN total / 3 >= 60 THEN '합격' ELSE '불합격' END || '입니다!' AS told
FROM totals
""",
    "guess_answers": """
SELECT event_id, guess, CASE WHEN guess IS NULL THEN 'invalid' WHEN guess > target THEN 'Down'
    WHEN guess < target THEN 'Up' ELSE 'hit' END AS answer
FROM (SELECT event_id, user_id % 50 + 1 AS target,
  CASE event_id % 9 WHEN 0 THEN 0 WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN 5
    ELSE CAST(json_extract(props, '$.k') AS DOUBLE) END AS guess FROM events)
""",
    "attempts_to_hit": """
SELECT user_id, min(nr) AS attempts, '축하합니다! ' || min(nr) || '번 만에 맞추셨습니다.' AS told FROM (
  SELECT user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nr FROM events)
WHERE k = user_id % 50 + 1 GROUP BY user_id
""",
    "attempts_to_purchase": """
SELECT user_id, min(nr) AS attempts FROM (
  SELECT user_id, event_type,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nr
  FROM events WHERE value IS NOT NULL)
WHERE event_type = 'purchase' GROUP BY user_id
""",
    "attempts_to_purchase_cut": """
SELECT user_id, min(nr) AS attempts FROM (
  SELECT user_id, event_type,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nr
  FROM events WHERE value IS NOT NULL)
WHERE event_type = 'purchase' GROUP BY user_id
""",
    "ordered_text": f"""
SELECT l_orderkey, CAST((nr - 1) // {LINES_PER_PART} AS BIGINT) AS part,
       string_agg(line, '' ORDER BY nr) AS text
FROM (SELECT l_orderkey, '🌀' || p_name || CAST(CAST(l_quantity AS INT) AS VARCHAR) || '개' || chr(10) AS line,
        row_number() OVER (PARTITION BY l_orderkey
          ORDER BY l_linenumber, l_partkey, l_quantity, l_extendedprice) AS nr
      FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)
GROUP BY 1, 2
""",
    "ordered_text_parts": f"""
SELECT l_orderkey, CAST((nr - 1) // 3 AS BIGINT) AS part,
       string_agg(line, '' ORDER BY nr) AS text
FROM (SELECT l_orderkey, '🌀' || p_name || CAST(CAST(l_quantity AS INT) AS VARCHAR) || '개' || chr(10) AS line,
        row_number() OVER (PARTITION BY l_orderkey
          ORDER BY l_linenumber, l_partkey, l_quantity, l_extendedprice) AS nr
      FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)
GROUP BY 1, 2
""",
    "page_facts": rf"""
SELECT page_id, {_FACTS}
FROM (SELECT page_id, {_shown()} AS shown FROM pages)
""",
    "page_links": f"SELECT page_id, pos, href, {_KIND} AS kind FROM ({_ANCHORS})",
    "inlinks": rf"""
SELECT CASE WHEN path = '' OR path LIKE '?%' THEN page || path
    WHEN path LIKE '/%' THEN site || path
    ELSE site || CASE WHEN length(page) = length(site) THEN '/'
      ELSE regexp_replace(page[length(site) + 1:], '[^/]*$', '') END || path END AS target,
  count(*) AS links
FROM (SELECT regexp_replace(href, '(?s)#.*$', '') AS path, page,
        regexp_extract(page, '^([A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?)', 1) AS site
      FROM (SELECT *, regexp_replace(url, '(?s)[?#].*$', '') AS page FROM ({_ANCHORS}))
      WHERE {_KIND} = 'internal')
GROUP BY 1
""",
    "page_items": rf"""
SELECT page_id, nr - 1 AS pos, {_plain("item")} AS text
FROM (SELECT page_id, unnest(items) AS item, generate_subscripts(items, 1) AS nr
      FROM (SELECT page_id, regexp_extract_all({_shown()}, '(?is)<li(?:\s[^>]*)?>(.*?)</li>', 1) AS items
            FROM pages))
""",
    "site_facts": """
SELECT c_custkey AS page_id, 'ko' AS lang, 'Page ' || c_custkey AS title,
  'about ' || c_custkey AS description FROM customer
""",
    "site_links": """
SELECT c_custkey AS page_id, CAST(0 AS BIGINT) AS pos, 'home.html#a' AS href, 'internal' AS kind FROM customer
UNION ALL SELECT c_custkey, 1, '/n' || c_nationkey, 'internal' FROM customer
UNION ALL SELECT c_custkey, 2, 'https://else.example/', 'external' FROM customer
UNION ALL SELECT c_custkey, 3, 'mailto:a@b.example', 'mailto' FROM customer
""",
    "site_inlinks": """
SELECT 'http://site.example/n' || c_nationkey AS target, count(*) AS links FROM customer GROUP BY 1
UNION ALL
SELECT 'http://site.example/n' || c_nationkey || '/home.html', count(*) FROM customer GROUP BY 1
""",
    "schedule_lines": """
SELECT c_custkey AS page_id, CAST(0 AS BIGINT) AS section_pos, NULL AS section, CAST(0 AS BIGINT) AS pos,
  '07:30' AS time, CAST(450 AS INT) AS minute, 'early' AS text FROM customer
UNION ALL
SELECT c_custkey, 1, 'One', 0, lpad(CAST(c_custkey % 24 AS VARCHAR), 2, '0') || ':15',
  CAST(c_custkey % 24 * 60 + 15 AS INT), c_mktsegment || ' work' FROM customer
UNION ALL
SELECT c_custkey, 2, 'Two', 0, '23:05', 1385, c_name FROM customer
""",
    "dated_marks": """
SELECT c_custkey AS page_id, 'time' AS kind, CAST(0 AS BIGINT) AS pos,
  (c_custkey % 30 + 1995) || '-02-' || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0') AS day,
  CAST(c_custkey % 30 + 1995 AS INT) AS year FROM customer
UNION ALL
SELECT c_custkey, 'caption', 0, NULL, CAST(c_custkey % 30 + 1995 AS INT) FROM customer
""",
    "description_rows": """
SELECT p_partkey AS page_id, CAST(0 AS BIGINT) AS pos, 'brand' AS term, p_brand AS text FROM part
UNION ALL SELECT p_partkey, 1, 'type', p_type || chr(10) || p_size FROM part
""",
    "description_map": """
SELECT p_partkey AS page_id, CAST(2 AS BIGINT) AS terms, p_brand AS brand,
  p_type || chr(10) || p_size AS type FROM part
""",
    "table_slots": f"""
WITH p AS ({_PART})
SELECT page_id, CAST(0 AS BIGINT) AS table_pos, r AS row, CAST(0 AS BIGINT) AS "column", p_brand AS text
FROM p, unnest(range(high)) AS t(r)
UNION ALL SELECT page_id, 0, 0, 1 + c, p_type FROM p, unnest(range(wide)) AS t(c)
UNION ALL SELECT page_id, 0, 1, CASE WHEN high > 1 THEN 1 ELSE 0 END, 'second' FROM p
UNION ALL SELECT page_id, 0, 2, CASE WHEN high > 2 THEN 1 ELSE 0 END, 'third' || chr(10) || 'line' FROM p
""",
    "last_choice_stream": _LAST_CHOICE,
    "late_choice_stream": _LAST_CHOICE,
    "folded_choice_stream": _LAST_CHOICE,
    "active_choice_stream": _LAST_CHOICE,
    "late_events": f"{_ARRIVED} SELECT event_id, user_id FROM arrived WHERE late",
    "sliding_windows": f"""{_ARRIVED},
placed AS (SELECT event_type, value,
    time_bucket(INTERVAL '{SLIDE}', ts, TIMESTAMP '1970-01-01') - i * INTERVAL '{SLIDE}' AS start
  FROM arrived, range({int(WIDE.split()[0]) // int(SLIDE.split()[0])}) AS t(i) WHERE NOT late)
SELECT strftime(start, {_SHOWN}) AS start, strftime(start + INTERVAL '{WIDE}', {_SHOWN}) AS "end",
  event_type, {_WINDOW_FIGURES}
FROM placed, over WHERE start + INTERVAL '{WIDE}' <= mark GROUP BY start, event_type
""",
    "session_windows": f"""{_ARRIVED},
begun AS (SELECT user_id, ts, value,
    coalesce(ts > lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL '{GAP}', true) AS begins
  FROM arrived WHERE NOT late),
numbered AS (SELECT *, count(*) FILTER (begins) OVER (PARTITION BY user_id ORDER BY ts) AS nr FROM begun),
sessions AS (SELECT user_id, nr, min(ts) AS start, max(ts) + INTERVAL '{GAP}' AS until, {_WINDOW_FIGURES}
  FROM numbered GROUP BY user_id, nr)
SELECT strftime(start, {_SHOWN}) AS start, strftime(until, {_SHOWN}) AS "end", user_id, events, total
FROM sessions, over WHERE until <= mark
""",
    "enriched_stream": f"""{_CITIES}
SELECT event_id, user_id, label,
  CASE WHEN station IS NULL THEN '{CITY_NOT_FOUND}'
    WHEN event_type = 'error' THEN '{WEATHER_UNAVAILABLE}'
    WHEN value >= {MISSING_FROM} THEN '{NO_TEMPERATURE}' ELSE '{OK}' END AS status,
  printf('%.4f', latitude) AS latitude_text,
  CASE WHEN event_type <> 'error' AND value < {MISSING_FROM} THEN value END AS temperature
FROM events LEFT JOIN cities ON city = user_id % 25
""",
    "observed_stream": f"""
WITH v AS (SELECT event_id AS view_id, user_id, ts, value FROM events WHERE event_type = 'view'),
c AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'click'),
best AS (SELECT event_id, max(struct_pack(ts := v.ts, view_id := view_id, value := value)) AS b
  FROM c JOIN v ON c.user_id = v.user_id AND v.ts <= c.ts AND v.ts >= c.ts - INTERVAL '{HORIZON}' GROUP BY event_id)
SELECT event_id, user_id, b.view_id AS view_id, b.value AS value FROM c LEFT JOIN best USING (event_id)
WHERE b IS NOT NULL
  OR ts <= (SELECT least((SELECT max(ts) FROM c), (SELECT max(ts) FROM v))) - INTERVAL '{LATENESS}'
""",
    "skewed_pairs": f"{_SIDES} SELECT event_type, s_nationkey, count(*) AS pairs FROM e JOIN s USING (k) GROUP BY ALL",
    "skewed_full": f"""{_SIDES}
SELECT coalesce(e.k, s.k) AS k, s_suppkey, count(event_id) AS events, count(*) AS rows
FROM e FULL JOIN s ON e.k = s.k GROUP BY ALL
""",
    "skewed_semi_anti": f"""{_SIDES}
SELECT event_id, CASE WHEN k IN (SELECT k FROM s WHERE k IS NOT NULL) THEN 'semi' ELSE 'anti' END AS kind FROM e
""",
    "interval_overlaps": """
WITH r AS (SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS begin FROM events)
SELECT c.user_id, c.event_id AS click_id, v.event_id AS view_id
FROM r c JOIN r v ON c.user_id = v.user_id AND c.event_type = 'click' AND v.event_type = 'view'
  AND v.event_id % 4 > 0 AND c.begin < v.begin + v.event_id % 4 * 3600 AND v.begin < c.begin + 3600
""",
    "line_numbers": f"{_LINES} SELECT *, row_number() OVER (ORDER BY {_LINE_ORDER}) AS number FROM lines",
    "line_tiles": f"{_LINES} SELECT *, ntile(7) OVER (ORDER BY {_LINE_ORDER}) AS tile FROM lines",
    "quantity_ranks": f"""{_LINES}
SELECT *, rank() OVER w AS "rank", dense_rank() OVER w AS dense_rank,
  CAST(sum(CAST(price AS DECIMAL(18,2))) OVER w AS DOUBLE) AS total
FROM lines WINDOW w AS (ORDER BY l_quantity)
""",
    "price_ranks": f"""{_LINES}, v AS (SELECT price, count(*) AS rows, sum(l_orderkey) AS amount FROM lines GROUP BY price)
SELECT price, rows, CAST(sum(rows) OVER w - rows + 1 AS BIGINT) AS "rank", row_number() OVER w AS dense_rank,
  CAST(sum(amount) OVER w AS BIGINT) AS total
FROM v WINDOW w AS (ORDER BY price)
""",
    "top_quantities": f"""{_LINES}
SELECT * FROM (SELECT *, rank() OVER (ORDER BY l_quantity DESC) AS "rank" FROM lines) WHERE "rank" <= 10
""",
    "snapshot_difference": f"{_LATER} SELECT * FROM net",
    "snapshot_changes": f"""{_LATER},
sides AS (SELECT *, sum(times) FILTER (kind = 'added') OVER w AS plus,
    sum(times) FILTER (kind = 'removed') OVER w AS minus FROM net WINDOW w AS (PARTITION BY c_custkey))
SELECT 'changed' AS kind, CAST(1 AS BIGINT) AS times, c_custkey, max(c_acctbal) FILTER (kind = 'removed') AS balance_before,
  max(c_acctbal) FILTER (kind = 'added') AS balance_after
FROM sides WHERE plus = 1 AND minus = 1 GROUP BY c_custkey
UNION ALL SELECT kind, times, c_custkey, CASE kind WHEN 'removed' THEN c_acctbal END, CASE kind WHEN 'added' THEN c_acctbal END
FROM sides WHERE NOT coalesce(plus = 1 AND minus = 1, false)
""",
    "sales_sketches": """
SELECT o_orderpriority AS region, count(*) AS records, count(DISTINCT o_custkey) AS customers,
  true AS distinct_kept, true AS median_kept, least(3, count(DISTINCT o_custkey)) AS named
FROM orders GROUP BY o_orderpriority
""",
    "sales_by_region": _by("region"),
    "sales_by_category": _by("category"),
    "sales_by_month": _by("month"),
    "sales_cube": f"{_SALES} SELECT region, category, CAST(GROUPING(region, category) AS BIGINT) AS level, {_FIGURES} FROM sales GROUP BY CUBE (region, category)",
    "sales_rollup": f"{_SALES} SELECT region, category, CAST(GROUPING(region, category) AS BIGINT) AS level, {_FIGURES} FROM sales GROUP BY ROLLUP (region, category)",
    "sales_pivot": f"{_SALES} SELECT region, "
    + ", ".join(
        f"CAST(sum(amount) FILTER (month LIKE '%-{m}') AS DOUBLE) AS m_{m}" for m in CALENDAR_MONTHS
    )
    + ", CAST(sum(amount) FILTER (month IS NULL) AS DOUBLE) AS m_other FROM sales GROUP BY region",
    "top_category": f"""{_SALES}
SELECT region, category, CAST(total AS DOUBLE) AS total FROM (
  SELECT region, category, sum(amount) AS total,
    row_number() OVER (PARTITION BY region ORDER BY sum(amount) DESC, category) AS nr
  FROM sales GROUP BY region, category) WHERE nr = 1
""",
    "month_change": f"""{_SALES}
SELECT region, month, CAST(total AS DOUBLE) AS total,
  CAST(total - lag(total) OVER (PARTITION BY region ORDER BY month) AS DOUBLE) AS change
FROM (SELECT region, month, sum(amount) AS total FROM sales GROUP BY region, month)
""",
    "region_share": f"""{_SALES}
SELECT region, CAST(sum(amount) AS DOUBLE) AS total,
  CAST(sum(amount) AS DOUBLE) / (SELECT CAST(sum(amount) AS DOUBLE) FROM sales) AS share
FROM sales GROUP BY region
""",
}

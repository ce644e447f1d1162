"""The registered queries as SQL over the same tables, for checking results."""

RUN_TS = "2026-03-12T08:00:00+00:00"
SITE = "https://www.example.org"


def _consolidation(history: str, tie: bool = True, order: str = "", at: str = "") -> str:
    """One grouping of ``history(key, val, since, tie)``: each result is the value at
    an extreme of an ordering key without nulls. A null key has no last values."""
    low = "tie" if tie else "val IS NOT NULL, coalesce(val, '')"
    at = at or "coalesce(CAST(since AS TIMESTAMP), TIMESTAMP '1970-01-01')"
    return f"""
    WITH history AS ({history}),
    placed AS (
      SELECT key, val, row(since IS NULL, {at}, {low}) AS oldest, row(since IS NOT NULL, {at}, {low}) AS newest FROM history),
    consolidated AS (
      SELECT key, count(DISTINCT val) AS n, arg_min_null(val, oldest) AS first_val,
             CASE WHEN key IS NOT NULL THEN arg_max_null(val, newest) END AS last_val,
             CASE WHEN key IS NOT NULL THEN arg_max(val, newest) END AS known_val
      FROM placed GROUP BY key)
    {order}"""


def _named(key: str) -> str:
    return (
        f"SELECT key AS {key}, n AS distinct_values, first_val AS first_value, "
        "last_val AS last_value, known_val AS last_non_null_value FROM consolidated"
    )


_EVENT_HISTORY = "SELECT user_id AS key, nullif(event_type, 'error') AS val, ts AS since, event_id AS tie FROM events"
_HOT_EVENTS = (
    "SELECT CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END AS key, nullif(event_type, 'error') AS val, "
    "ts AS since, event_id AS tie FROM events"
)
_ORDER_HISTORY = (
    "SELECT o_custkey AS key, nullif(o_orderpriority, '4-NOT SPECIFIED') AS val, o_orderdate AS since, "
    "o_orderkey AS tie FROM orders"
)
_PATCHY_HISTORY = """
  SELECT CASE WHEN o_custkey % 3 > 0 THEN o_custkey END AS key,
         CASE WHEN o_orderpriority = '5-LOW' THEN '' WHEN o_orderpriority <> '1-URGENT' THEN o_orderpriority END AS val,
         CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS since, o_orderkey AS tie
  FROM orders"""
_NULL_TIES = """
  SELECT CASE WHEN o_custkey % 3 > 0 THEN o_custkey % 50 END AS key, o_orderpriority AS val,
         CASE WHEN o_orderkey % 7 > 0 THEN CAST(date_trunc('year', o_orderdate) AS DATE) END AS since,
         CASE WHEN o_orderkey % 4 > 0 THEN o_custkey % 5 END AS tie
  FROM orders"""
_EQUAL_TIES = """
  SELECT key AS k, n AS distinct_values, first_val AS first_value, last_val AS last_value, known_val AS last_non_null_value,
         first_val AS first_alone FROM consolidated"""
_PERSONS = _consolidation(_EVENT_HISTORY, tie=False)


def _row_numbers(history: str, key: str, tie: str) -> str:
    return f"""
    SELECT tie AS {tie}, key AS {key},
           row_number() OVER (PARTITION BY key ORDER BY since ASC NULLS LAST, tie ASC) AS rn_asc,
           row_number() OVER (PARTITION BY key ORDER BY since DESC NULLS LAST, tie DESC) AS rn_desc
    FROM ({history})"""


_TEXT_HISTORY = """
  SELECT o_orderkey AS person_id, o_orderpriority AS name, CAST(NULL AS VARCHAR) AS state, o_orderstatus AS city,
         CASE o_orderkey % 10 WHEN 0 THEN 'Spring 1940' WHEN 1 THEN ''
              WHEN 2 THEN strftime(o_orderdate, '%Y/%-m/%-d') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS valid_from,
         CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d 10:00:00') END AS valid_to
  FROM orders"""

_RECORDS = f"""
  SELECT o_orderkey,
         CASE o_orderpriority WHEN '1-URGENT' THEN c_mktsegment || ' Obituaries' WHEN '2-HIGH' THEN ' ' ELSE c_name END
           AS full_name,
         CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%B %-d, %Y') END AS date_of_birth,
         CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 'O' THEN '' END AS date_of_death,
         CASE WHEN o_orderpriority = '5-LOW' THEN ''
              ELSE c_mktsegment || ' "' || o_orderpriority || '"' || chr(10) || c_name END AS obituary_text,
         '{SITE}/us/' || lower(c_mktsegment)
           || CASE WHEN o_orderstatus = 'P' THEN '/' || o_orderkey ELSE '' END AS source_url,
         CASE WHEN o_orderstatus <> 'O' THEN strftime(o_orderdate, '%Y-%m-01T%H:%M:%SZ') END AS scraped_at
  FROM orders JOIN customer ON o_custkey = c_custkey"""
_FIELDS = "full_name, date_of_birth, date_of_death, obituary_text, source_url, scraped_at"

_CHECKED = f"""
  SELECT o_orderkey, full_name, nullif(date_of_birth, '') AS date_of_birth, nullif(date_of_death, '') AS date_of_death,
         nullif(obituary_text, '') AS obituary_text, source_url, coalesce(scraped_at, '{RUN_TS}') AS scraped_at,
         CASE WHEN full_name LIKE '%Obituaries' AND NOT regexp_matches(split_part(source_url, '/', -1), '[0-9]')
                THEN 'listing_page'
              WHEN trim(full_name) = '' THEN 'blank_name' END AS reject_reason
  FROM ({_RECORDS})"""
_ACCEPTED = f"SELECT o_orderkey, {_FIELDS} FROM ({_CHECKED}) WHERE reject_reason IS NULL"

_DAY_PATH = f"strftime(coalesce(CAST(left(scraped_at, 10) AS DATE), DATE '{RUN_TS[:10]}'), '%Y/%m/%d')"


def _key(suffix: str) -> str:
    name = "left(replace(replace(lower(full_name), ' ', '_'), '/', '-'), 50)"
    return f"'raw/site/' || {_DAY_PATH} || '/' || {name} || '_' || {suffix} || '.json'"


def _quoted(field: str) -> str:
    return f"""'  "{field}": ' || coalesce(CAST(to_json({field}) AS VARCHAR), 'null')"""


_PAYLOAD = (
    "'{' || chr(10) || "
    + " || ',' || chr(10) || ".join(_quoted(f) for f in _FIELDS.split(", "))
    + " || chr(10) || '}'"
)

# The rest of a line and its kinds, as the adapter writes them.
_LINES = """
  SELECT o_orderkey, o_orderkey % 13 AS kind, o_orderdate,
         CASE o_orderkey % 13 WHEN 0 THEN 'not json' WHEN 1 THEN '' WHEN 2 THEN full_line || ' x'
              WHEN 3 THEN '[' || full_line || ']' WHEN 4 THEN '{' || rest
              WHEN 6 THEN '{' || named || ',' || stamp ELSE full_line END AS value
  FROM (SELECT *, '{' || named || ',' || rest AS full_line
        FROM (SELECT *, '"full_name":"Order ' || o_orderkey || '"' AS named,
                     '"date_of_birth":null,"date_of_death":'
                       || CASE WHEN o_orderkey % 13 = 5 THEN 'null'
                               ELSE '"' || strftime(o_orderdate, '%Y-%m-%d') || '"' END
                       || ',"obituary_text":"it''s",' || stamp AS rest
              FROM (SELECT *, '"scraped_at":"' || strftime(o_orderdate, '%Y-%m-%dT08:00:00Z') || '"}' AS stamp
                    FROM orders)))"""
_NUMBERED = f"SELECT row_number() OVER (ORDER BY o_orderkey) AS line_no, value, kind, o_orderkey, o_orderdate FROM ({_LINES})"

_FETCH_LOG = f"""
  SELECT '{SITE}/a/very/long/path/to/make/the/cut/of/the/text/visible/in/the/log/' || event_type || '/' || event_id AS url,
         CASE event_type WHEN 'error' THEN 500 WHEN 'view' THEN 404 ELSE 200 END AS status, value AS ended, props AS body,
         CASE WHEN event_type = 'signup' THEN 'Timeout: ' || event_id END AS error
  FROM events"""


def _decoded(text: str) -> str:
    """Character references as they occur in the test pages."""
    step = f"replace(replace(replace({text}, '&quot;', '\"'), '&copy;', '©'), '&middot;', '·')"
    return f"regexp_replace({step}, '&amp;?', '&', 'g')"


_CLEAN = r"regexp_replace(html, '(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->', '', 'g')"
_SPACE = r"' ' || chr(9) || chr(10) || chr(13)"
_HEADING = (
    "trim(replace(" + _decoded(f"nullif(regexp_extract({_CLEAN}, '<h1[^>]*>([^<]+)', 1), '')") + f", ' Obituary', ''), {_SPACE})"
)
_LONGEST = f"""
  SELECT page_id, CASE WHEN length(t) > 100 THEN trim(t, {_SPACE}) END AS longest
  FROM (SELECT page_id, {_decoded("piece")} AS t, i
        FROM (SELECT page_id, unnest(ts) AS piece, generate_subscripts(ts, 1) AS i
              FROM (SELECT page_id, regexp_extract_all({_CLEAN}, '<p[^>]*>([^<]+)', 1) AS ts FROM pages)))
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(t) DESC, i) = 1"""
_HREFS = f"""
  SELECT page_id, url, regexp_extract(url, '^(https?://[^/?#]+)', 1)
         || unnest(regexp_extract_all({_CLEAN}, '<a href="(/[^"]*)"', 1)) AS dst_url
  FROM pages"""

_CUSTOMER_RECORDS = f"""
  SELECT c_custkey AS page_id,
         CASE WHEN c_custkey % 4 < 3 THEN c_name END AS full_name,
         CASE c_custkey % 4 WHEN 0 THEN strftime(DATE '1940-01-15' + c_nationkey * 31, '%Y-%m-%d')
              WHEN 2 THEN 'Spring 1940' END AS date_of_birth,
         CASE WHEN c_custkey % 4 = 0 THEN strftime(DATE '1940-01-15' + c_nationkey * 31 + 20000, '%Y-%m-%d') END
           AS date_of_death,
         CASE c_custkey % 4 WHEN 0 THEN c_mktsegment || ' of ' || c_name WHEN 1 THEN trim(repeat(c_name || ' & family. ', 6))
              WHEN 2 THEN c_mktsegment || ' f(1<2)' END AS obituary_text,
         '{SITE}/us/obituaries/c-' || c_custkey AS source_url, '{RUN_TS}' AS scraped_at
  FROM customer"""

_LISTINGS = f"""
  SELECT page_id, '{SITE}/us/obituaries?page=' || page_id AS url,
         CASE WHEN page_id % 7 <> 6 THEN '{SITE}/us/obituaries?page=' || (page_id + 1) END AS next_url,
         page_id = max(page_id) OVER () AS is_last
  FROM (SELECT DISTINCT c_custkey // 10 AS page_id FROM customer)"""
_REACHED = f"""
  listings AS ({_LISTINGS}),
  reached AS (
    SELECT page_id AS start_id, url AS start_url, page_id, url, 1 AS hop FROM listings WHERE page_id % {{every}} = 0
    UNION ALL
    SELECT start_id, start_url, page_id + 1, '{SITE}/us/obituaries?page=' || (page_id + 1), hop + 1
    FROM reached WHERE hop < {{hops}} AND page_id % 7 <> 6 AND page_id IN (SELECT page_id FROM listings))"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}

    # histories
    q["scd_consolidate_events"] = _consolidation(_EVENT_HISTORY, order=_named("user_id"))
    q["scd_consolidate_sorted"] = q["scd_consolidate_events"]
    q["scd_consolidate_orders"] = _consolidation(_ORDER_HISTORY, order=_named("o_custkey"))
    q["scd_consolidate_joined"] = q["scd_consolidate_orders"]
    q["scd_consolidate_hot_key"] = _consolidation(_HOT_EVENTS, order=_named("user_id"))
    q["scd_consolidate_unknowns"] = _consolidation(_PATCHY_HISTORY, order=_named("o_custkey"))
    q["scd_consolidate_dates"] = _consolidation(
        f"SELECT key % 40 AS key, val, CAST(date_trunc('month', since) AS DATE) AS since, tie FROM ({_ORDER_HISTORY})",
        order=_named("o_custkey"),
    )
    q["scd_consolidate_zoned"] = _consolidation(
        f"SELECT key, val, date_trunc('day', since) AS since, tie FROM ({_HOT_EVENTS})", order=_named("user_id")
    )
    q["scd_consolidate_decimals"] = _consolidation(
        """SELECT o_custkey % 40 AS key, nullif(o_orderpriority, '4-NOT SPECIFIED') AS val,
                  CASE WHEN o_orderkey % 5 > 0 THEN round(o_totalprice / 50000) END AS since FROM orders""",
        tie=False,
        order=_named("o_custkey"),
        at="coalesce(since, 0)",
    )
    q["scd_approximate_values"] = (
        f"SELECT key AS user_id, count(DISTINCT val) AS distinct_values FROM ({_EVENT_HISTORY}) GROUP BY key"
    )
    q["scd_row_numbers"] = _row_numbers(_ORDER_HISTORY, "o_custkey", "o_orderkey")
    q["scd_row_numbers_hot_key"] = _row_numbers(_HOT_EVENTS, "user_id", "event_id")
    q["scd_row_numbers_null_ties"] = f"""
      WITH h AS ({_NULL_TIES}),
      numbered AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY since ASC NULLS LAST, tie ASC NULLS FIRST) AS up,
        row_number() OVER (PARTITION BY key ORDER BY since DESC NULLS LAST, tie DESC NULLS LAST) AS down FROM h)
      SELECT key AS k, since AS at, tie AS i, count(*) AS n, min(up) AS first_asc, max(up) AS last_asc,
             min(down) AS first_desc, max(down) AS last_desc FROM numbered GROUP BY key, since, tie"""
    q["scd_equal_ties"] = _consolidation(f"SELECT key, val, since, CAST(NULL AS BIGINT) AS tie FROM ({_NULL_TIES})", tie=False) + _EQUAL_TIES
    q["scd_row_numbers_unknowns"] = _row_numbers(_PATCHY_HISTORY, "o_custkey", "o_orderkey")
    top = "SELECT key AS o_custkey, val AS {name} FROM ({h}) {where} QUALIFY row_number() OVER (PARTITION BY key ORDER BY {by}) = 1"
    newest = "since DESC NULLS LAST, tie DESC"
    q["scd_first"] = top.format(name="first_value", h=_ORDER_HISTORY, where="", by="since ASC NULLS LAST, tie ASC")
    q["scd_latest"] = top.format(name="last_value", h=_ORDER_HISTORY, where="", by=newest)
    q["scd_latest_non_null"] = f"""
      SELECT DISTINCT ON (key) key AS o_custkey, val AS last_non_null_value
      FROM ({_ORDER_HISTORY}) WHERE val IS NOT NULL ORDER BY key, {newest}"""
    q["scd_distinct_values"] = (
        f"SELECT key AS user_id, count(DISTINCT val) AS distinct_values FROM ({_EVENT_HISTORY}) GROUP BY key"
    )
    q["scd_summary"] = _PERSONS + """
      SELECT count(*) AS persons, avg(n) AS avg_values, count(*) FILTER (WHERE known_val IS NULL) AS without_value,
             CAST(round_even(avg(n), 1) AS VARCHAR) AS avg_text
      FROM consolidated"""
    q["consolidated_count"] = _PERSONS + "SELECT count(*) AS persons_consolidated, 'ok' AS status FROM consolidated"
    q["person_lines"] = _PERSONS + """
      SELECT key AS person_id,
             'person_id=' || key || ' | distinct_cities=' || n || ' | first_city=' || coalesce(first_val, 'None')
             || ' | last_city=' || coalesce(last_val, 'None') || ' | last_non_null_city=' || coalesce(known_val, 'None')
               AS line
      FROM consolidated"""
    q["display_columns"] = _PERSONS + """
      SELECT key AS "Person Id", n AS "Distinct Cities", first_val AS "First City", last_val AS "Last City",
             known_val AS "Last Non Null City" FROM consolidated"""
    q["typed_history"] = f"""
      SELECT person_id, name, state, city, TRY_CAST(valid_from AS DATE) AS valid_from, TRY_CAST(valid_to AS DATE) AS valid_to
      FROM ({_TEXT_HISTORY})"""
    q["stored_history"] = _consolidation(
        f"SELECT person_id % 100 AS key, city AS val, TRY_CAST(valid_from AS DATE) AS since FROM ({_TEXT_HISTORY})",
        tie=False,
        order="""SELECT key AS person_id, n AS distinct_cities, first_val AS first_city, last_val AS last_city,
                 known_val AS last_non_null_city FROM consolidated""",
    )
    q["history_rejects"] = f"""
      SELECT person_id, valid_from FROM ({_TEXT_HISTORY}) WHERE TRY_CAST(valid_from AS DATE) IS NULL"""

    # scalar functions
    q["normalize_dates"] = """
      SELECT o_orderkey,
             CASE o_orderkey % 9 WHEN 5 THEN 'Spring ' || strftime(o_orderdate, '%Y')
                  WHEN 8 THEN strftime(o_orderdate, '%B %-d, 0000') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS iso,
             o_orderkey % 9 NOT IN (5, 8) AS understood
      FROM orders"""
    q["stamp_days"] = f"""
      SELECT event_id, CASE WHEN event_id % 3 = 2 THEN '{RUN_TS[:10].replace("-", "/")}' ELSE strftime(ts, '%Y/%m/%d') END
               AS day_path
      FROM events"""
    q["joined_lines"] = f"""
      SELECT doc_id, trim(text, {_SPACE}) AS stripped,
             array_to_string([trim(x, {_SPACE}) for x in string_split(text, chr(10)) if trim(x, {_SPACE}) <> ''], ' ')
               AS joined
      FROM documents"""
    q["text_preview"] = """
      SELECT doc_id, CASE WHEN length(text) > 300 THEN substr(text, 1, 300) || '...' ELSE text END AS preview FROM documents"""
    q["url_segments"] = """
      SELECT page_id, split_part(url, '/', -1) AS last_segment,
             left(replace(replace(lower(url), ' ', '_'), '/', '-'), 50) AS safe_name
      FROM pages"""
    q["allowed_hosts"] = r"""
      SELECT page_id, url FROM pages WHERE regexp_matches(url, '^https?://([^/?#]*\.)?example\.(org|net)([:/?#]|$)')"""
    q["strict_json_lines"] = """
      SELECT event_id, event_id % 8 IN (0, 7) AS is_object,
             CASE event_id % 8 WHEN 0 THEN 'k' WHEN 7 THEN 'a,k' END AS keys
      FROM events"""

    # records
    q["record_defaults"] = f"""
      SELECT coalesce(full_name, '') AS full_name, date_of_birth, date_of_death, CAST(NULL AS VARCHAR) AS obituary_text,
             coalesce(source_url, '') AS source_url, coalesce(scraped_at, '{RUN_TS}') AS scraped_at, count(*) AS n
      FROM ({_RECORDS}) GROUP BY ALL"""
    q["typed_records"] = """
      SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS birth_date,
             CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END AS death_date,
             CASE WHEN o_orderstatus <> 'O' THEN strftime(o_orderdate, '%Y-%m-01 %H:%M:%S') END AS collected_at
      FROM orders"""
    q["record_to_scd"] = f"""
      SELECT o_orderkey AS person_id, coalesce(full_name, 'Unknown') AS name, CAST(NULL AS VARCHAR) AS state,
             CAST(NULL AS VARCHAR) AS city,
             TRY_CAST(coalesce(nullif(date_of_death, ''), left(coalesce(scraped_at, ''), 10)) AS DATE) AS valid_from,
             CAST(NULL AS DATE) AS valid_to
      FROM ({_RECORDS})"""
    q["validated_records"] = _ACCEPTED
    q["rejected_records"] = f"""
      SELECT o_orderkey, reject_reason,
             CASE reject_reason WHEN 'listing_page' THEN 'listing page dropped: ' || full_name || ' | ' || source_url
                  ELSE 'record without a name dropped: ' || source_url END AS reject_message
      FROM ({_CHECKED}) WHERE reject_reason IS NOT NULL"""
    titled = """
      SELECT page_id, CASE WHEN page_id % 5 > 0 THEN regexp_extract(html, '<title>([^<]*)</title>', 1) ELSE ' ' END AS full_name,
             CASE WHEN page_id % 2 = 0 THEN url ELSE regexp_replace(url, '[0-9]', '', 'g') END AS source_url
      FROM pages"""
    tail_digit = "regexp_matches(split_part(source_url, '/', -1), '[0-9]')"
    q["validate_pages"] = f"""
      SELECT page_id, full_name, source_url, '{RUN_TS}' AS scraped_at FROM ({titled})
      WHERE NOT (full_name LIKE '%.' AND NOT {tail_digit}) AND trim(full_name) <> ''"""
    q["reject_reasons"] = f"""
      SELECT reject_reason, count(*) AS n
      FROM (SELECT CASE WHEN full_name LIKE '%e' AND NOT {tail_digit} THEN 'listing_page'
                        WHEN trim(full_name) = '' THEN 'blank_name' END AS reject_reason FROM ({titled}))
      WHERE reject_reason IS NOT NULL GROUP BY 1"""
    q["storage_keys"] = f"SELECT o_orderkey, {_key('lpad(CAST(o_orderkey AS VARCHAR), 12, chr(48))')} AS key FROM ({_RECORDS})"
    q["storage_key_uniqueness"] = f"""
      SELECT count(*) AS keys, max(n) AS most_per_key
      FROM (SELECT count(*) AS n FROM ({_RECORDS}) GROUP BY {_key("''")}, source_url, scraped_at)"""
    q["payloads"] = f"SELECT o_orderkey, {_PAYLOAD} AS payload FROM ({_RECORDS})"
    size = f"CAST(strlen({_PAYLOAD}) AS BIGINT) AS size_bytes"
    q["upload_manifest"] = f"SELECT 'bucket' AS bucket, {_key('o_orderkey')} AS key, {size} FROM ({_RECORDS})"
    q["stored_listing"] = f"""
      SELECT {_key('o_orderkey')} AS object_key, {size}, CAST(strlen({_PAYLOAD}) AS BIGINT) AS found_bytes FROM ({_RECORDS})"""
    q["blob_manifest"] = f"""
      SELECT 'bucket' AS bucket, {_key('o_orderkey')} AS blob, {size}, 'application/json' AS content_type FROM ({_RECORDS})"""
    q["uploaded_count"] = "SELECT count(*) AS uploaded FROM orders"

    # profile
    q["name_search"] = "SELECT p_partkey, p_name FROM part WHERE regexp_matches(lower(p_name), 'gear|^red')"
    q["complete_records"] = """
      SELECT doc_id, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)
      WHERE lang IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL"""
    q["browse_counts"] = f"""
      SELECT count(*) FILTER (WHERE regexp_matches(lower(full_name), 'customer#0+1') AND date_of_birth IS NOT NULL
               AND date_of_death IS NOT NULL AND obituary_text IS NOT NULL) AS shown, count(*) AS total
      FROM ({_ACCEPTED})"""
    q["record_cards"] = f"""
      SELECT full_name AS name, coalesce(date_of_birth, '—') AS born, coalesce(date_of_death, '—') AS died,
             coalesce(obituary_text, 'No obituary text available.') AS preview, source_url AS url
      FROM ({_ACCEPTED}) WHERE regexp_matches(lower(full_name), 'customer#0+[0-4]')"""
    q["field_coverage"] = """
      WITH t AS (SELECT count(*) AS total, count(text) AS a, count(lang) AS b, count(quality) AS c
                 FROM documents LEFT JOIN labels USING (doc_id)),
      p AS (SELECT 'text' AS field, a / total * 100 AS pct FROM t UNION ALL SELECT 'lang', b / total * 100 FROM t
            UNION ALL SELECT 'quality', c / total * 100 FROM t UNION ALL SELECT 'absent', 0.0 FROM t)
      SELECT field, CAST(pct AS DOUBLE) AS pct, CAST(trunc(pct) AS INTEGER) AS bar_width,
             CASE WHEN pct > 80 THEN 'ok' WHEN pct > 40 THEN 'warn' ELSE 'bad' END AS band
      FROM p"""
    q["overview_metrics"] = _PERSONS + """
      SELECT total, with_birth, with_text, CAST(CAST(round_even(with_birth / total * 100, 0) AS INTEGER) AS VARCHAR) || '%' AS birth_share,
             CAST(CAST(round_even(with_text / total * 100, 0) AS INTEGER) AS VARCHAR) || '%' AS text_share,
             (SELECT count(*) FROM consolidated) AS persons
      FROM (SELECT count(*) AS total, count(quality) AS with_birth, count(text) AS with_text
            FROM documents LEFT JOIN labels USING (doc_id))"""
    q["last_collected"] = f"SELECT max(scraped_at) AS last_run FROM ({_RECORDS})"
    q["component_health"] = _PERSONS + f"""
      SELECT component, ok, description FROM (VALUES
        ('s3', true, 'date-partitioned JSON'), ('gcs', false, 'date-partitioned JSON'), ('jsonl', true, 'JSON Lines'))
        v(component, ok, description)
      UNION ALL SELECT 'extraction', count(*) > 0, 'records from pages' FROM ({_ACCEPTED})
      UNION ALL SELECT 'consolidation', count(*) > 0, 'one row per person' FROM consolidated"""

    # gates
    q["jsonl_gate"] = f"""
      SELECT count(*) FILTER (WHERE kind NOT IN (0, 1, 2, 3, 4, 6)) AS valid_records,
             count(*) FILTER (WHERE kind IN (0, 2, 3, 4, 6)) AS invalid_records,
             'date_of_birth,date_of_death,full_name,obituary_text' AS missing_fields, 'ok' AS status
      FROM ({_LINES})"""
    q["missing_fields"] = "SELECT event_id, 'z' AS missing, false AS valid FROM events WHERE json_exists(props, '$.k')"
    q["export_not_empty"] = f"SELECT count(*) AS s3_objects_count, 'ok' AS status FROM ({_LINES}) WHERE trim(value) <> ''"
    q["response_metrics"] = f"""
      SELECT status, CAST(trunc(ended * 1000) AS INTEGER) AS elapsed_ms, strlen(body) / 1024 AS size_kb, left(url, 80) AS url,
             CASE WHEN status >= 400 THEN 'warning' ELSE 'debug' END AS level
      FROM ({_FETCH_LOG}) WHERE error IS NULL"""
    q["fetch_failures"] = f"SELECT url, error FROM ({_FETCH_LOG}) WHERE error IS NOT NULL"

    # pages
    q["page_headings"] = f"SELECT page_id, {_HEADING} AS full_name FROM pages"
    ad = _decoded("regexp_extract(" + _CLEAN + ", '<div class=\"ad\">([^<]*)</div>', 1)")
    q["page_ad_text"] = f"SELECT page_id, nullif(trim({ad}, {_SPACE}), '') AS ad_text FROM pages"
    q["longest_paragraph"] = f"SELECT page_id, longest FROM pages LEFT JOIN ({_LONGEST}) USING (page_id)"
    q["page_records"] = f"""
      SELECT {_HEADING} AS full_name, CAST(NULL AS VARCHAR) AS date_of_birth, CAST(NULL AS VARCHAR) AS date_of_death,
             longest AS obituary_text, url AS source_url, '{RUN_TS}' AS scraped_at
      FROM pages LEFT JOIN ({_LONGEST}) USING (page_id)"""
    q["customer_page_records"] = _CUSTOMER_RECORDS
    # A script or style element holds one text; the text itself may look like tags.
    bodies = r"'(?s)(<(?:script|style)\b[^>]*>).*?(</(?:script|style)>)', '\1x\2', 'g'"
    plain = f"regexp_replace(regexp_replace(html, {bodies}), '(?s)<!--.*?-->', '', 'g')"
    q["page_node_counts"] = f"""
      SELECT tag, count(*) AS n
      FROM (SELECT unnest(list_transform(regexp_extract_all({plain}, '<[a-z][a-z0-9-]*|(?:^|>)[^<]+'),
                                         lambda x: CASE WHEN x[1] = '<' THEN x[2:] ELSE '#text' END)) AS tag FROM pages)
      GROUP BY tag"""

    # links
    q["page_links"] = f"SELECT url AS src_url, dst_url, 'detail' AS kind FROM ({_HREFS})"
    q["links_per_page"] = f"""
      SELECT page_id, CAST(len(regexp_extract_all({_CLEAN}, '<a href="(/[^"]*)"', 1)) AS BIGINT) AS n_links FROM pages"""
    q["distinct_targets"] = f"""
      SELECT DISTINCT dst_url AS page_key FROM ({_HREFS}) WHERE regexp_matches(dst_url, '^https?://([^/]*\\.)?example\\.org/')"""
    q["listing_links"] = f"""
      SELECT '{SITE}/us/obituaries?page=' || (c_custkey // 10) AS src_url,
             '{SITE}/us/obituaries/c-' || c_custkey AS dst_url, 'detail' AS kind FROM customer
      UNION ALL SELECT url, next_url, 'next' FROM ({_LISTINGS}) WHERE next_url IS NOT NULL"""
    q["reached_listings"] = (
        "WITH RECURSIVE " + _REACHED.format(every=5, hops=5) + " SELECT start_url, url, hop FROM reached"
    )
    q["selected_record_pages"] = (
        "WITH RECURSIVE "
        + _REACHED.format(every=8, hops=5)
        + f""" SELECT c_custkey AS page_id, '{SITE}/us/obituaries/c-' || c_custkey AS url
        FROM customer WHERE c_custkey // 10 IN (SELECT page_id FROM reached)"""
    )
    q["unfetched_pages"] = f"SELECT '{SITE}/us/obituaries/c-' || c_custkey AS url FROM customer WHERE c_custkey % 3 <> 0"

    # sources, sinks and whole jobs
    q["jsonl_round_trip"] = f"SELECT {_FIELDS} FROM ({_RECORDS})"
    q["jsonl_rows_written"] = "SELECT count(*) AS written, count(*) AS found FROM orders"
    q["numbered_export_lines"] = f"SELECT line_no, value FROM ({_NUMBERED})"
    q["export_history"] = f"""
      SELECT line_no AS person_id, CASE WHEN kind = 4 THEN 'Unknown' ELSE 'Order ' || o_orderkey END AS name,
             CAST(NULL AS VARCHAR) AS state, CAST(NULL AS VARCHAR) AS city,
             CAST(o_orderdate AS DATE) AS valid_from, CAST(NULL AS DATE) AS valid_to
      FROM ({_NUMBERED}) WHERE kind NOT IN (0, 1, 2, 3)"""
    q["export_rejects"] = f"SELECT line_no, value FROM ({_NUMBERED}) WHERE kind IN (0, 2, 3)"
    q["streamed_rejects"] = (
        f"SELECT 'malformed_line' AS reject_reason, value AS line FROM ({_NUMBERED}) WHERE kind IN (0, 2, 3)"
    )
    q["stored_days"] = f"""
      SELECT split_part(d, '/', 1) AS year, split_part(d, '/', 2) AS month, split_part(d, '/', 3) AS day, run, count(*) AS n
      FROM (SELECT {_DAY_PATH} AS d FROM ({_RECORDS})), (VALUES ('a'), ('b')) r(run) GROUP BY ALL"""
    q["sink_status"] = f"""
      SELECT sink, ok, error, exported FROM (VALUES ('s3', true, NULL), ('gcs', false, 'OSError: bucket is gone'),
             ('jsonl', true, NULL)) s(sink, ok, error)
      LEFT JOIN (SELECT 'jsonl' AS sink, count(*) AS exported FROM ({_ACCEPTED})) USING (sink)"""
    q["capped_records"] = f"""
      SELECT {_FIELDS} FROM ({_ACCEPTED})
      ORDER BY source_url NULLS FIRST, full_name NULLS FIRST, date_of_birth NULLS FIRST, date_of_death NULLS FIRST,
               obituary_text NULLS FIRST, scraped_at NULLS FIRST LIMIT 500"""
    q["streamed_records"] = f"SELECT {_FIELDS} FROM ({_ACCEPTED})"
    q["stored_page_rejects"] = f"""
      SELECT '{SITE}/us/obituaries/c-' || c_custkey AS source_url, 'blank_name' AS reject_reason
      FROM customer WHERE c_custkey % 4 = 3"""
    q["daily_job"] = """
      SELECT 'sinks' AS step, CAST(3 AS BIGINT) AS n
      UNION ALL SELECT 'export', count(*) FROM customer WHERE c_custkey % 4 <> 3
      UNION ALL SELECT 'valid', count(*) FROM customer WHERE c_custkey % 4 <> 3
      UNION ALL SELECT 'persons', count(DISTINCT user_id) FROM events
      UNION ALL SELECT 'rejects', count(*) FROM customer WHERE c_custkey % 4 = 3"""
    return q

"""DuckDB oracle: the same derived data and operators written as plain SQL.

Used by ``__spark_entry__.oracle_sql()``. The CTEs below rebuild the search
feed from ``events`` byte for byte, land it, and derive bronze, silver and the
marts with DuckDB's own functions, as an independent check of the Spark plans.
"""

from __future__ import annotations

from staylens import reference_data as R
from staylens.sources import search_feed as S


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _values(rows) -> str:
    out = []
    for r in rows:
        out.append("(" + ", ".join(str(x) if isinstance(x, int) else "'" + x + "'" for x in r) + ")")
    return ", ".join(out)


# --- JSON helpers over a JSON value j (NULL when the text is not JSON) -------

def jtext(j: str, f: str) -> str:
    return f"json_extract_string({j}, '$.{f}')"


def jnum(j: str, f: str) -> str:
    return f"TRY_CAST(json_extract_string({j}, '$.{f}') AS DOUBLE)"


def jint(j: str, f: str) -> str:
    d = jnum(j, f)
    return (f"(CASE WHEN {d} = floor({d}) AND {d} BETWEEN -2147483648 AND 2147483647 "
            f"THEN CAST({d} AS INTEGER) END)")


def jspelled(j: str, f: str) -> str:
    """The scalar as the dedup key spells it."""
    return f"(CASE WHEN json_type({j}, '$.{f}') = 'BOOLEAN' THEN upper(left({jtext(j, f)}, 1)) || substr({jtext(j, f)}, 2) ELSE {jtext(j, f)} END)"


def jkind(j: str, f: str | None = None) -> str:
    t = f"json_type({j})" if f is None else f"json_type({j}, '$.{f}')"
    return (f"(CASE WHEN {t} IS NULL THEN NULL WHEN {t} IN ('OBJECT','ARRAY','BOOLEAN') THEN {t} "
            f"WHEN {t} = 'VARCHAR' THEN 'STRING' WHEN {t} = 'NULL' THEN 'NULL' ELSE 'NUMBER' END)")


def strict_date(s: str) -> str:
    return f"(CASE WHEN regexp_full_match({s}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN TRY_CAST({s} AS DATE) END)"


TS_RE = r"\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?(Z|[+-]\d{2}:\d{2})?"


def strict_ts(s: str) -> str:
    return (f"(CASE WHEN NOT regexp_full_match({s}, '{TS_RE}') THEN NULL "
            f"WHEN regexp_matches({s}, '(Z|[+-]\\d{{2}}:\\d{{2}})$') "
            f"THEN timezone('UTC', TRY_CAST({s} AS TIMESTAMPTZ)) "
            f"ELSE TRY_CAST({s} AS TIMESTAMP) END)")


ISO_RE = (r"(\d{4})-?(\d{2})-?(\d{2})(?:[T ](\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?)?"
          r"(?:Z|([+-]\d{2})(?::?(\d{2}))?)?)?")


def iso_ts(s: str) -> str:
    """Any ISO spelling: the usual ones as they are, the others spelled out first."""
    g = lambda i: f"regexp_extract({s}, '^{ISO_RE}$', {i})"
    two = lambda i: f"lpad({g(i)}, 2, '0')"
    full = (f"{g(1)} || '-' || {g(2)} || '-' || {g(3)} || ' ' || {two(4)} || ':' || {two(5)} || ':' || {two(6)} || '.' "
            f"|| rpad({g(7)}, 6, '0') || CASE WHEN {g(8)} = '' THEN '+00' ELSE {g(8)} END || ':' || {two(9)}")
    return (f"coalesce({strict_ts(s)}, CASE WHEN regexp_full_match({s}, '{ISO_RE}') "
            f"AND NOT regexp_full_match({s}, '{TS_RE}') THEN timezone('UTC', TRY_CAST({full} AS TIMESTAMPTZ)) END)")


def falsy(j: str, f: str) -> str:
    t = f"CAST(json_extract({j}, '$.{f}') AS VARCHAR)"
    return (f"({t} IS NULL OR {t} IN ('null', 'false', '\"\"', '[]', '{{}}') "
            f"OR ({t} NOT LIKE '\"%' AND coalesce({jnum(j, f)} = 0, false)))")


# --- derived search feed ---------------------------------------------------

def _item(i: int) -> str:
    cents = f"(CAST(floor(value * 100 + 0.5) AS BIGINT) + {100 * (i + 1)})"
    price = f"(CAST({cents} // 100 AS VARCHAR) || '.' || lpad(CAST({cents} % 100 AS VARCHAR), 2, '0'))"
    room = _list(S.SEED_ROOMS) + f"[CAST((k + {i}) % 4 + 1 AS INTEGER)]"
    currency = _list(S.SEED_CURRENCIES) + f"[CAST((k + {i}) % 6 + 1 AS INTEGER)]"
    if i == 0:
        price = f"(CASE WHEN d = 7 THEN '0' ELSE {price} END)"
    price = f"',\"price\":' || {price}"
    if i == 0:
        room = f"CASE WHEN d = 27 THEN '' ELSE {room} END"
        price = f"CASE WHEN d = 26 THEN '' ELSE {price} END"
        currency = f"CASE WHEN d = 28 THEN 'eur' ELSE {currency} END"
    whole = (f"'{{\"room_name\":\"' || ({room}) || '\"' || ({price}) || ',\"currency\":\"' || ({currency}) || '\"}}'")
    return f"(CASE WHEN d = 24 THEN '5' ELSE {whole} END)" if i == 0 else f"({whole})"


def _q(x: str) -> str:
    return f"('\"' || {x} || '\"')"


FEED = f"""
feed_base AS (
  SELECT event_id AS k, ts, user_id, value,
         unnest(CASE WHEN event_id % 20 = 0 THEN [0, 1] ELSE [0] END) AS copy,
         CAST(event_id % 50 AS INTEGER) AS d
  FROM events
),
feed_f AS (
  SELECT *,
    CAST(1235 + user_id % 7 AS INTEGER) AS hid,
    CASE WHEN copy = 1 AND k % 40 = 0 THEN 1 ELSE 0 END AS dep_extra,
    (CASE WHEN k % 29 = 0 THEN 1 ELSE 0 END) + (CASE WHEN copy = 1 AND k % 40 = 20 THEN 1 ELSE 0 END) AS los_extra,
    CAST(1 + k % 16 AS INTEGER) AS nights,
    CAST(ts AS DATE) + CAST(k % 60 AS INTEGER) AS arr,
    strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts_text0
  FROM feed_base
),
feed_g AS (
  SELECT *,
    CASE WHEN d = 9 THEN arr - nights ELSE arr + nights + dep_extra END AS dep,
    CAST(nights + dep_extra + los_extra AS VARCHAR) AS los,
    CASE WHEN d = 13 THEN ts_text0 || 'Z' WHEN d = 14 THEN ts_text0 || '-05:00'
         WHEN d = 16 THEN ts_text0 || '.1234567Z' WHEN d = 17 THEN ts_text0 || '+0500'
         WHEN d = 18 THEN strftime(ts, '%Y%m%dT%H%M%S') ELSE ts_text0 END AS ts_text,
    {_list([a[1] for a in S.SEED_ANCHORS])}[hid - 1235 + 1] || lpad(CAST(k % 1000 AS VARCHAR), 3, '0') AS lat,
    CASE WHEN hid = 1241 AND k % 2 = 1 THEN '-179.9' ELSE {_list([a[2] for a in S.SEED_ANCHORS])}[hid - 1235 + 1] END
      || lpad(CAST(k * 7 % 1000 AS VARCHAR), 3, '0') AS lon
  FROM feed_f
),
feed_h AS (
  SELECT *,
    CASE WHEN d = 6 THEN '[]' ELSE '[' || concat_ws(',', {_item(0)},
         CASE WHEN k % 3 >= 1 THEN {_item(1)} END, CASE WHEN k % 3 >= 2 THEN {_item(2)} END) || ']' END AS results
  FROM feed_g
),
feed AS (
  SELECT CAST(k AS VARCHAR) || CASE WHEN copy = 1 THEN 'r' ELSE '' END AS request_id,
    ts + to_seconds(5 + copy * 3600) AS received_at,
    CASE WHEN d = 1 THEN 'not json ' || CAST(k AS VARCHAR)
         WHEN d = 2 THEN '[' || CAST(k AS VARCHAR) || ']'
         ELSE '{{' || concat_ws(',',
           '"arrival_date":' || CASE WHEN k % 97 = 0 THEN 'null' WHEN d = 11 THEN {_q("strftime(arr, '%d-%m-%Y')")}
                                     ELSE {_q("strftime(arr, '%Y-%m-%d')")} END,
           '"departure_date":' || {_q("strftime(dep, '%Y-%m-%d')")},
           '"length_of_stay":' || CASE WHEN d = 12 THEN los || '.0' WHEN d = 19 THEN '0' WHEN d = 31 THEN '400' ELSE los END,
           '"user_country":' || {_q("CASE WHEN d = 21 THEN '' ELSE " + _list(S.SEED_COUNTRIES) + "[CAST(k % 12 + 1 AS INTEGER)] END")},
           '"hotel_id":' || CASE WHEN d = 3 THEN NULL WHEN d = 4 THEN {_q("CAST(hid AS VARCHAR)")}
                                 WHEN d = 15 THEN '0' WHEN d = 29 THEN CAST(hid AS VARCHAR) || '.0'
                                 ELSE CAST(hid AS VARCHAR) END,
           '"hotel_name":' || {_q("CASE WHEN d = 22 THEN '' ELSE 'Hotel ' || CAST(hid AS VARCHAR) END")},
           '"hotel_latitude":' || CASE WHEN d = 5 THEN '95.0' ELSE lat END,
           '"hotel_longitude":' || CASE WHEN d = 23 THEN '200.5' ELSE lon END,
           '"timestamp":' || {_q("ts_text")},
           '"search_results":' || results,
           CASE WHEN d = 10 THEN '"partner_ref":' || {_q("'p' || CAST(k AS VARCHAR)")} END,
           CASE WHEN d = 8 THEN '"note":' || {_q("repeat('x', 2100)")} END
         ) || '}}' END AS value,
    'client-' || CAST(user_id % 16 AS VARCHAR) AS client
  FROM feed_h
)"""

# --- landing ---------------------------------------------------------------

LANDED_BASE = f"""
landed_j AS (
  SELECT request_id AS event_id, received_at AS ingestion_time, value AS payload,
         CASE WHEN json_valid(value) THEN CAST(value AS JSON) END AS j
  FROM feed
),
landed_t AS (
  SELECT *,
    sha256(concat_ws('|', coalesce({jspelled('j', 'hotel_id')}, 'None'), coalesce({jspelled('j', 'timestamp')}, 'None'),
                          coalesce({jspelled('j', 'user_country')}, 'None'), coalesce({jspelled('j', 'arrival_date')}, 'None')))
      AS dedup_key,
    {jint('j', 'hotel_id')} AS hotel_id,
    {iso_ts(jtext('j', 'timestamp'))} AS search_timestamp,
    CAST(ingestion_time AS DATE) AS ingest_date,
    CASE WHEN payload IS NULL THEN 'invalid_json'
         WHEN j IS NULL OR json_type(j) <> 'OBJECT' THEN 'invalid_json' END AS pre_reason
  FROM landed_j
)"""

LANDED_LIGHT = LANDED_BASE + f""",
landed AS (
  SELECT event_id, dedup_key, ingestion_time, '{R.PARTNER_ID}' AS partner_id, '{R.SCHEMA_VERSION}' AS schema_version,
    payload, hotel_id, search_timestamp, ingest_date,
    CASE WHEN pre_reason IS NOT NULL THEN pre_reason
         WHEN {falsy('j', 'hotel_id')} OR {falsy('j', 'timestamp')} THEN 'missing_required_fields'
         WHEN search_timestamp IS NULL THEN 'invalid_timestamp' END AS reason
  FROM landed_t
),
bronze AS (
  SELECT event_id, dedup_key, ingestion_time, partner_id, schema_version, payload, hotel_id,
         search_timestamp, ingest_date
  FROM landed WHERE reason IS NULL
)"""

# --- silver ----------------------------------------------------------------

DIMS = f"""
dim_hotels(hotel_id, city, country_iso) AS (VALUES {_values(R.DIM_HOTELS)}),
country_map(name, iso) AS (VALUES {_values(R.COUNTRY_MAP)})"""


def _bucket(x: str) -> str:
    parts = " ".join(f"WHEN {x} BETWEEN {lo} AND {hi} THEN '{label}'" for label, lo, hi in R.LOS_BUCKETS)
    return f"(CASE {parts} ELSE '{R.LOS_OTHER}' END)"


SILVER = DIMS + f""",
staged AS (
  SELECT event_id, dedup_key, ingestion_time, partner_id, schema_version, payload, hotel_id, search_timestamp,
    {jtext('CAST(payload AS JSON)', 'arrival_date')} AS arrival_date,
    {jtext('CAST(payload AS JSON)', 'departure_date')} AS departure_date,
    {jint('CAST(payload AS JSON)', 'length_of_stay')} AS length_of_stay,
    {jtext('CAST(payload AS JSON)', 'user_country')} AS user_country,
    {jtext('CAST(payload AS JSON)', 'hotel_name')} AS hotel_name,
    {jnum('CAST(payload AS JSON)', 'hotel_latitude')} AS hotel_latitude,
    {jnum('CAST(payload AS JSON)', 'hotel_longitude')} AS hotel_longitude
  FROM bronze
),
enriched AS (
  SELECT s.*, h.city, h.country_iso AS hotel_country_iso,
    coalesce(cm.iso, upper(left(s.user_country, 2))) AS user_country_iso,
    CAST(s.search_timestamp AS DATE) AS search_date,
    {_bucket('s.length_of_stay')} AS los_bucket,
    date_diff('day', {strict_date('s.arrival_date')}, {strict_date('s.departure_date')}) AS computed_los
  FROM staged s
  LEFT JOIN dim_hotels h ON s.hotel_id = h.hotel_id
  LEFT JOIN country_map cm ON lower(trim(s.user_country)) = lower(cm.name)
),
consistent AS (
  SELECT * FROM enriched
  WHERE arrival_date IS NOT NULL AND departure_date IS NOT NULL AND length_of_stay IS NOT NULL
    AND computed_los = length_of_stay AND los_bucket <> '{R.LOS_OTHER}'
),
silver AS (
  SELECT event_id, dedup_key, ingestion_time, partner_id, schema_version, payload, hotel_id, search_timestamp,
    arrival_date, departure_date, length_of_stay, user_country, hotel_name, city, hotel_latitude,
    hotel_longitude, hotel_country_iso, user_country_iso, search_date, los_bucket
  FROM consistent
  QUALIFY row_number() OVER (PARTITION BY dedup_key ORDER BY ingestion_time DESC, event_id DESC) = 1
)"""

# --- gold ------------------------------------------------------------------


def share(count: str, total: str) -> str:
    return f"round(CAST({count} AS DOUBLE) * 100.0 / CAST({total} AS DOUBLE), 1)"


GOLD = f"""
gold_arrival AS (
  SELECT city, CAST(arrival_date AS DATE) AS arrival_date, search_date, count(*) AS search_count
  FROM silver WHERE city IS NOT NULL GROUP BY city, arrival_date, search_date
),
gold_country AS (
  SELECT city, search_date, user_country, user_country_iso, count(*) AS search_count,
    {share('count(*)', 'sum(count(*)) OVER (PARTITION BY city, search_date)')} AS pct_of_total,
    round(avg(length_of_stay), 1) AS avg_los, sum(length_of_stay)::BIGINT AS total_nights
  FROM silver WHERE city IS NOT NULL GROUP BY city, search_date, user_country, user_country_iso
),
gold_los AS (
  SELECT city, search_date, los_bucket, count(*) AS search_count,
    {share('count(*)', 'sum(count(*)) OVER (PARTITION BY city, search_date)')} AS pct_of_total
  FROM silver WHERE city IS NOT NULL GROUP BY city, search_date, los_bucket
)"""


# --- full contract validation ---------------------------------------------

def _sq(x: str) -> str:
    return x.replace("'", "''")


def _err(key: str, path: str, msg: str, cond: str, code: str) -> str:
    return f"CASE WHEN {cond} THEN {{'k': {key}, 'e': {path} || ': ' || '{_sq(msg)}', 'c': '{code}'}} END"


def _contract_rules(version: str | None) -> list[str]:
    """The field rules as SQL; ``version`` is the column with the event's contract version (None: all are v1)."""
    from staylens.operators import validation as V
    integers = {f for c in R.CONTRACTS.values() for f in c.integers}
    out = []
    for r in V.field_rules():
        k, n, s = f"k_{r.field}", f"n_{r.field}", f"s_{r.field}"
        is_int = f"({k} = 'NUMBER' AND {n} = floor({n}))"
        typed = is_int if r.field in integers else f"({k} = 'NUMBER')"
        cond = {"required": f"{k} IS NULL", "integer": f"{k} IS NOT NULL AND NOT {is_int}",
                "string": f"{k} IS NOT NULL AND {k} <> 'STRING'", "number": f"{k} IS NOT NULL AND {k} <> 'NUMBER'",
                "array": f"{k} IS NOT NULL AND {k} <> 'ARRAY'", "minimum": f"{typed} AND {n} < {r.bound}",
                "maximum": f"{typed} AND {n} > {r.bound}", "empty": f"{k} = 'ARRAY' AND len(items) = 0",
                "too_short": f"{k} = 'STRING' AND length({s}) < {r.bound}",
                "too_long": f"{k} = 'STRING' AND length({s}) > {r.bound}"}[r.check]
        if set(r.versions) != set(R.CONTRACTS):
            if version is None and "v1" not in r.versions:
                continue
            if version is not None:
                cond = f"{version} IN ({', '.join(repr(v) for v in r.versions)}) AND {cond}"
        out.append(_err("''" if r.check == "required" else f"'{r.path}'", f"'{r.path}'", r.message, cond, r.code))
    return out


def _item_rules() -> str:
    from staylens.operators import validation as V
    base = "('search_results.' || CAST(i - 1 AS VARCHAR))"
    key = "('search_results.' || lpad(CAST(i - 1 AS VARCHAR), 10, '0'))"
    kx = jkind("x")
    kf = {f: jkind("x", f) for f in R.RESULT_ITEM_FIELDS}
    obj = f"{kx} = 'OBJECT'"
    codes = V.ITEM_CODES
    rules = [_err(key, base, V.MSG_NOT_OBJECT, f"NOT ({obj})", codes["object"])]
    for f in R.RESULT_ITEM_FIELDS:
        rules.append(_err(key, base, V.MSG_REQUIRED.format(field=f), f"{obj} AND {kf[f]} IS NULL", codes[f]))
    sub = {f: (f"({key} || '.{f}')", f"({base} || '.{f}')") for f in R.RESULT_ITEM_FIELDS}
    room, price, cur = jtext("x", "room_name"), jnum("x", "price"), jtext("x", "currency")
    rules += [
        _err(*sub["room_name"], V.MSG_TYPE.format(type="string"),
             f"{obj} AND {kf['room_name']} IS NOT NULL AND {kf['room_name']} <> 'STRING'", codes["room_type"]),
        _err(*sub["room_name"], V.MSG_TOO_SHORT, f"{obj} AND {kf['room_name']} = 'STRING' AND length({room}) < 1",
             codes["room_empty"]),
        _err(*sub["price"], V.MSG_TYPE.format(type="number"),
             f"{obj} AND {kf['price']} IS NOT NULL AND {kf['price']} <> 'NUMBER'", codes["price_type"]),
        _err(*sub["price"], V.MSG_EXCL_MIN, f"{obj} AND {kf['price']} = 'NUMBER' AND {price} <= 0", codes["price_low"]),
        _err(*sub["currency"], V.MSG_TYPE.format(type="string"),
             f"{obj} AND {kf['currency']} IS NOT NULL AND {kf['currency']} <> 'STRING'", codes["currency_type"]),
        _err(*sub["currency"], V.MSG_PATTERN.format(pattern=R.CURRENCY_PATTERN),
             f"{obj} AND {kf['currency']} = 'STRING' AND NOT regexp_matches({cur}, '{R.CURRENCY_PATTERN}')",
             codes["currency_form"]),
    ]
    return "[" + ", ".join(rules) + "]"


def _business(known=None, currency=None) -> str:
    from staylens.operators import validation as V
    a, d, t = strict_date("s_arrival_date"), strict_date("s_departure_date"), iso_ts("s_timestamp")
    los = "CAST(n_length_of_stay AS INTEGER)"
    nights = f"date_diff('day', {a}, {d})"
    both = f"{a} IS NOT NULL AND {d} IS NOT NULL"
    known = _list(known or R.KNOWN_COUNTRIES)
    codes = V.BUSINESS_CODES

    def rule(name: str, cond: str, text: str) -> str:
        return f"CASE WHEN {cond} THEN {{'e': {text}, 'c': '{codes[name]}'}} END"

    rules = [
        rule("arrival", f"{a} IS NULL", f"'arrival_date: {V.MSG_BAD_DATE}'"),
        rule("departure", f"{d} IS NULL", f"'departure_date: {V.MSG_BAD_DATE}'"),
        rule("timestamp", f"{t} IS NULL", f"'timestamp: {V.MSG_BAD_DATETIME}'"),
        rule("order", f"{both} AND {d} <= {a}", f"'departure_date: {V.MSG_DEP_AFTER}'"),
        rule("nights", f"{both} AND {d} > {a} AND {los} <> {nights}", f"printf('length_of_stay: {V.MSG_LOS}', {nights}, {los})"),
        rule("country", f"NOT list_contains({known}, lower(regexp_replace(s_user_country, '^\\s+|\\s+$', '', 'g')))",
             f"printf('user_country: {_sq(V.MSG_COUNTRY)}', s_user_country)"),
    ]
    cur = jtext("x", "currency")
    currencies = _list(currency or R.VALID_CURRENCIES)
    unsupported = rule("currency", f"NOT list_contains({currencies}, {cur})",
                       f"printf('search_results[%d].currency: {_sq(V.MSG_CURRENCY)}', i - 1, {cur})")
    items = f"list_transform(items, lambda x, i: {unsupported})"
    return f"list_filter(list_concat([{', '.join(rules)}], {items}), lambda e: e IS NOT NULL)"


def validated_cte(source: str = "feed", id_col: str = "request_id", known=None, name: str = "validated",
                  p: str = "v", currency=None, version: str | None = None) -> str:
    """CTE ``validated(event_id, value, errors, codes, failed_stage)`` over a raw message relation."""
    from staylens.operators import validation as V
    every = R.CONTRACTS.values()
    union = lambda kind: list(dict.fromkeys(f for c in every for f in getattr(c, kind)))
    facts = [f"{jkind('j', f)} AS k_{f}" for f in dict.fromkeys(union("required") + union("strings"))]
    facts += [f"{jnum('j', f)} AS n_{f}" for f in union("integers") + union("numbers")]
    facts += [f"{jtext('j', f)} AS s_{f}" for f in union("strings")]
    version_col = f", {version}" if version else ""
    return f"""
{p}_j AS (
  SELECT {id_col} AS event_id, value{version_col}, CASE WHEN json_valid(value) THEN CAST(value AS JSON) END AS j FROM {source}
),
{p}_facts AS (
  SELECT *, {jkind('j')} AS k_root, {', '.join(facts)},
    CASE WHEN json_type(j, '$.search_results') = 'ARRAY' THEN json_extract(j, '$.search_results[*]')
         ELSE CAST([] AS JSON[]) END AS items
  FROM {p}_j
),
{p}_stage1 AS (
  SELECT *, CASE WHEN k_root <> 'OBJECT' THEN [{{'e': 'root: {_sq(V.MSG_NOT_OBJECT)}', 'c': '{V.CODE_NOT_OBJECT}'}}]
    ELSE list_transform(list_sort(
      list_filter(list_concat([{', '.join(_contract_rules(version))}],
                              flatten(list_transform(items, lambda x, i: {_item_rules()}))),
      lambda e: e IS NOT NULL)), lambda e: {{'e': e.e, 'c': e.c}}) END AS stage1
  FROM {p}_facts
),
{p}_stage2 AS (
  SELECT *, CASE WHEN j IS NOT NULL AND len(stage1) = 0 THEN {_business(known, currency)} END AS stage2 FROM {p}_stage1
),
{p}_found AS (
  SELECT *, CASE WHEN j IS NULL THEN [{{'e': 'root: {V.MSG_INVALID_JSON}', 'c': '{V.CODE_NOT_JSON}'}}]
                 WHEN len(stage1) > 0 THEN stage1 ELSE stage2 END AS found
  FROM {p}_stage2
),
{name} AS (
  SELECT event_id, value, j{version_col}, list_transform(found, lambda e: e.e) AS errors, list_transform(found, lambda e: e.c) AS codes,
    CASE WHEN j IS NULL THEN 'parse' WHEN len(stage1) > 0 THEN 'contract' WHEN len(stage2) > 0 THEN 'business' END
      AS failed_stage
  FROM {p}_found
)"""


LANDED_FULL = validated_cte() + f""",
landed_full AS (
  SELECT t.event_id, t.ingestion_time, t.payload, t.ingest_date,
    CASE WHEN t.payload IS NOT NULL AND strlen(t.payload) > 2048 THEN 'payload_too_large'
         WHEN t.pre_reason IS NOT NULL THEN t.pre_reason WHEN len(v.errors) > 0 THEN 'validation_failed' END
      AS reason,
    CASE WHEN t.payload IS NOT NULL AND strlen(t.payload) > 2048 THEN
           [printf('root: body of %d bytes exceeds 2048', strlen(t.payload))]
         WHEN t.pre_reason = 'invalid_json' THEN ['root: invalid JSON'] ELSE v.errors END AS errors,
    CASE WHEN t.payload IS NOT NULL AND strlen(t.payload) > 2048 THEN ['root.size']
         WHEN t.pre_reason = 'invalid_json' THEN ['root.json'] ELSE v.codes END AS codes
  FROM landed_t t JOIN validated v ON t.event_id = v.event_id
)"""


BASE = FEED + "," + LANDED_LIGHT + "," + SILVER + "," + GOLD + "," + LANDED_FULL


def with_base(select: str, *extra_ctes: str) -> str:
    ctes = BASE + "".join("," + c for c in extra_ctes)
    return f"WITH {ctes}\n{select}"


# --- registered oracles ----------------------------------------------------

CITY, FROM_DATE, TO_DATE = "Paris", "2024-01-08", "2024-01-14"
RANGE = f"city = '{CITY}' AND search_date BETWEEN DATE '{FROM_DATE}' AND DATE '{TO_DATE}'"

AS_OF = "2024-01-31 00:00:00"
RETENTION_AS_OF = "2024-04-15"
BACKFILL = ("2024-01-08", "2024-01-14")
_ACC = ", ".join("'" + b + "'" for b in R.ACCEPTED_LOS_BUCKETS)


def _metric(table: str, check: str, value: str, op: str, threshold: str, severity: str, src: str) -> str:
    cond = {">": "metric > threshold", "<": "metric < threshold", "=": "metric = threshold"}[op]
    return (f"SELECT '{table}' AS table_name, '{check}' AS \"check\", metric, '{op}' AS op, threshold, "
            f"CASE WHEN {cond} THEN 'pass' ELSE 'fail' END AS outcome, '{severity}' AS severity FROM "
            f"(SELECT CAST({value} AS DOUBLE) AS metric, CAST({threshold} AS DOUBLE) AS threshold FROM {src})")


def dq_scan(silver: str = "silver") -> str:
    return " UNION ALL ".join([
        _metric("searches_enriched", "row_count", "count(*)", ">", "0", "error", silver),
        _metric("searches_enriched", "missing_count_city", "count(*) FILTER (WHERE city IS NULL)", "<", "1", "warn",
                silver),
        _metric("searches_enriched", "missing_pct_city",
                "coalesce(count(*) FILTER (WHERE city IS NULL) * 100.0 / count(*), 0.0)", "<", "1", "warn", silver),
        _metric("searches_enriched", "duplicate_count_dedup_key", "count(*) - count(DISTINCT dedup_key)", "=", "0",
                "error", silver),
        _metric("searches_enriched", "missing_count_dedup_key", "count(*) - count(dedup_key)", "=", "0", "error", silver),
        _metric("searches_enriched", "missing_count_length_of_stay", "count(*) - count(length_of_stay)", "=", "0", "error",
                silver),
        _metric("searches_enriched", "failed_rows_los_bucket",
                f"count(*) FILTER (WHERE NOT coalesce(los_bucket IN ({_ACC}), false))", "=", "0", "error", silver),
        _metric("searches_enriched", "failed_rows_los_consistency",
                f"count(*) FILTER (WHERE NOT coalesce(date_diff('day', {strict_date('arrival_date')}, "
                f"{strict_date('departure_date')}) = length_of_stay, false))", "=", "0", "error", silver),
        _metric("gold_country_trends", "row_count", "count(*)", ">", "0", "error", "gold_country"),
        _metric("gold_country_trends", "invalid_count_pct_of_total",
                "count(*) FILTER (WHERE pct_of_total IS NULL OR NOT pct_of_total BETWEEN 0 AND 100)", "=", "0", "error",
                "gold_country"),
        _metric("gold_los_distribution", "row_count", "count(*)", ">", "0", "error", "gold_los"),
        _metric("gold_los_distribution", "failed_rows_los_bucket",
                f"count(*) FILTER (WHERE NOT coalesce(los_bucket IN ({_ACC}), false))", "=", "0", "error", "gold_los"),
    ])


def _panels(where: str = "true", position: bool = False) -> str:
    """The three marts as one row per panel entry, numbered in panel order on request."""
    def part(panel, entry, iso, pct, avg, src, order):
        at = f"CAST(row_number() OVER (PARTITION BY city ORDER BY {order}) - 1 AS INTEGER) AS position, " if position else ""
        return (f"SELECT '{panel}' AS panel, city, {at}search_date, CAST({entry} AS VARCHAR) AS entry, "
                f"CAST({iso} AS VARCHAR) AS user_country_iso, search_count, CAST({pct} AS DOUBLE) AS pct_of_total, "
                f"CAST({avg} AS DOUBLE) AS avg_los FROM {src} WHERE {where}")
    return " UNION ALL ".join([
        part("arrival", "arrival_date", "NULL", "NULL", "NULL", "gold_arrival", "search_date, arrival_date NULLS FIRST"),
        part("country", "user_country", "user_country_iso", "pct_of_total", "avg_los", "gold_country",
             "search_count DESC, user_country NULLS FIRST, search_date, user_country_iso NULLS FIRST"),
        part("stay", "los_bucket", "NULL", "pct_of_total", "NULL", "gold_los", "los_bucket NULLS FIRST, search_date"),
    ])


def _mean(part: str, lat: str, lon: str) -> str:
    la, lo = f"radians({lat})", f"radians({lon})"
    return {"x": f"avg(cos({la}) * cos({lo}))", "y": f"avg(cos({la}) * sin({lo}))", "z": f"avg(sin({la}))"}[part]


def mean_lat(lat: str, lon: str) -> str:
    x, y, z = (_mean(p, lat, lon) for p in "xyz")
    return f"degrees(atan2({z}, sqrt({x} * {x} + {y} * {y})))"


def mean_lon(lat: str, lon: str) -> str:
    return f"degrees(atan2({_mean('y', lat, lon)}, {_mean('x', lat, lon)}))"


def draw(column: str, n: int) -> str:
    return f"(CAST(rtrim({column}, 'r') AS BIGINT) // 7 % {n})"


# Silver with the faults of ``queries._damaged``.
DAMAGED = f"""damaged AS (
  SELECT * EXCLUDE (c) REPLACE (
      CASE WHEN c = 1 THEN length_of_stay + 1 WHEN c = 2 THEN NULL ELSE length_of_stay END AS length_of_stay,
      CASE WHEN c = 3 THEN 'a while' ELSE los_bucket END AS los_bucket,
      CASE WHEN c = 4 THEN NULL ELSE dedup_key END AS dedup_key)
  FROM (SELECT *, {draw("event_id", 100)} AS c FROM silver), LATERAL (SELECT unnest(CASE WHEN c = 0 THEN [1, 2] ELSE [1] END) AS copy)
)"""


def gate_sql(silver: str) -> str:
    return f"""SELECT '{silver}' AS candidate, count(*) FILTER (WHERE outcome = 'fail' AND severity = 'error') = 0 AS passed,
              count(*) FILTER (WHERE outcome = 'fail' AND severity = 'error') AS failed_errors,
              count(*) FILTER (WHERE outcome = 'fail' AND severity = 'warn') AS failed_warnings,
              coalesce(string_agg(CASE WHEN outcome = 'fail' AND severity = 'error'
                                       THEN table_name || '.' || "check" END, ',' ORDER BY
                                  CASE WHEN outcome = 'fail' AND severity = 'error'
                                       THEN table_name || '.' || "check" END), '') AS failed_checks
              FROM ({dq_scan(silver)})"""


def oracles() -> dict[str, str]:
    from staylens.operators.validation import rule_codes
    q = {
        "bronze_landing": "SELECT * FROM bronze",
        "bronze_dedup_key": """SELECT dedup_key, count(*) AS copies, min(ingestion_time) AS first_ingestion,
              max(ingestion_time) AS last_ingestion FROM bronze GROUP BY dedup_key HAVING count(*) > 1""",
        "bronze_count": "SELECT count(*) AS bronze_rows FROM bronze",
        "staged_events": """SELECT event_id, dedup_key, ingestion_time, hotel_id, search_timestamp, arrival_date,
              departure_date, length_of_stay, user_country, hotel_name, hotel_latitude, hotel_longitude
              FROM staged""",
        "silver_enriched": "SELECT * EXCLUDE (payload) FROM silver",
        "silver_rejects": f"""SELECT e.event_id, e.dedup_key, e.ingestion_time, e.hotel_id, e.search_date,
              CASE
                WHEN e.arrival_date IS NULL OR e.departure_date IS NULL OR e.length_of_stay IS NULL THEN 'null_field'
                WHEN e.computed_los IS NULL OR e.computed_los <> e.length_of_stay THEN 'los_mismatch'
                WHEN e.los_bucket = '{R.LOS_OTHER}' THEN 'los_out_of_range'
                WHEN w.won IS NULL THEN 'duplicate' END AS reason
              FROM enriched e LEFT JOIN (SELECT event_id AS won FROM silver) w ON e.event_id = w.won
              WHERE reason IS NOT NULL""",
        "gold_arrival_popularity": "SELECT * FROM gold_arrival",
        "gold_country_trends": "SELECT * FROM gold_country",
        "gold_los_distribution": "SELECT * FROM gold_los",
        "pipeline_counts": """SELECT (SELECT count(*) FROM silver) AS silver_rows,
              (SELECT count(*) FROM gold_arrival) AS gold_arrival_date_popularity,
              (SELECT count(*) FROM gold_country) AS gold_country_trends,
              (SELECT count(*) FROM gold_los) AS gold_los_distribution""",
        "cities": "SELECT DISTINCT city FROM gold_country ORDER BY city",
        "arrival_trends": f"SELECT city, arrival_date, search_date, search_count FROM gold_arrival WHERE {RANGE}",
        "country_trends": f"""SELECT city, search_date, user_country, user_country_iso, search_count, pct_of_total,
              avg_los FROM gold_country WHERE {RANGE}""",
        "los_trends": f"SELECT city, search_date, los_bucket, search_count, pct_of_total FROM gold_los WHERE {RANGE}",
        "trends_missing_city": """SELECT h.city, CASE WHEN p.city IS NOT NULL THEN 'ok' ELSE 'not_found' END AS status,
                'all' AS marts
              FROM (SELECT city FROM dim_hotels UNION SELECT 'Atlantis') h LEFT JOIN (
                SELECT city FROM gold_arrival UNION SELECT city FROM gold_country UNION SELECT city FROM gold_los) p
              ON h.city = p.city
              UNION ALL SELECT city, 'not_ready', 'no_arrival' FROM dim_hotels
              UNION ALL SELECT 'Atlantis', 'not_ready', 'no_arrival'""",
    }
    q.update({
        "validate_schema_errors": """SELECT event_id, CAST(len(errors) AS INTEGER) AS error_count,
              array_to_string(errors, ' | ') AS error_text, array_to_string(codes, ',') AS error_codes
              FROM validated WHERE failed_stage = 'contract'""",
        "validate_business_errors": """SELECT event_id, CAST(len(errors) AS INTEGER) AS error_count,
              array_to_string(errors, ' | ') AS error_text, array_to_string(codes, ',') AS error_codes
              FROM validated WHERE failed_stage = 'business'""",
        "validate_split": """SELECT CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS outcome,
              coalesce(reason, 'none') AS reason, count(*) AS events FROM landed_full GROUP BY ALL""",
        "rejections_by_code": f"""SELECT r.code, coalesce(n, 0) AS error_count,
              coalesce(round(CAST(n AS DOUBLE) * 100.0 / (SELECT count(*) FROM validated), 2), 0.0) AS pct_of_events
              FROM (VALUES {_values([(c,) for c in rule_codes()])}) r(code)
              LEFT JOIN (SELECT c, count(*) AS n FROM (SELECT unnest(codes) AS c FROM validated) GROUP BY c) f ON r.code = f.c""",
        "quarantine_full": f"""SELECT event_id, ingestion_time, '{R.SCHEMA_VERSION}' AS schema_version, reason,
              array_to_string(errors, ' | ') AS error_text, array_to_string(codes, ',') AS error_codes,
              CASE WHEN reason = 'invalid_json' THEN left(payload, {R.DLQ_RAW_CHARS})
                   ELSE payload END AS raw, 1 AS attempts, ingest_date
              FROM landed_full WHERE reason IS NOT NULL""",
    })
    q.update({
        "dq_unique": f"WITH {DAMAGED} SELECT dedup_key, count(*) AS copies FROM damaged GROUP BY dedup_key HAVING count(*) > 1",
        "dq_not_null": f"""WITH {DAMAGED} SELECT event_id, dedup_key, hotel_id, c.check AS "check", c.severity AS severity FROM (
              SELECT event_id, dedup_key, hotel_id, unnest(list_filter([
                CASE WHEN dedup_key IS NULL THEN {{'check': 'not_null_dedup_key', 'severity': 'error'}} END,
                CASE WHEN hotel_id IS NOT NULL AND city IS NULL
                     THEN {{'check': 'not_null_city', 'severity': 'warn'}} END,
                CASE WHEN length_of_stay IS NULL THEN {{'check': 'not_null_length_of_stay', 'severity': 'error'}} END
              ], lambda c: c IS NOT NULL)) AS c FROM damaged)""",
        "dq_accepted_values": f"""WITH {DAMAGED} SELECT event_id, search_date, los_bucket FROM damaged
              WHERE los_bucket NOT IN ({_ACC})""",
        "dq_los_consistency": f"""WITH {DAMAGED} SELECT dedup_key, length_of_stay, arrival_date, departure_date FROM damaged
              WHERE NOT coalesce(date_diff('day', {strict_date('arrival_date')}, {strict_date('departure_date')})
                                 = length_of_stay, false)""",
        "dq_scan": dq_scan(),
        "dq_gate": f"""WITH {DAMAGED} SELECT * REPLACE ('built' AS candidate) FROM ({gate_sql('silver')})
              UNION ALL {gate_sql('damaged')}""",
        "dq_freshness": f"""SELECT table_name, refreshed_at,
                round((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(refreshed_at)) / 6.0e7, 2) AS refresh_lag_minutes,
                (epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(refreshed_at)) / 6.0e7 > {R.GOLD_STALE_MINUTES} AS stale,
                newest_ingestion,
                round((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(newest_ingestion)) / 6.0e7, 2) AS ingest_lag_minutes,
                round(null_city * 100.0 / silver_rows, 2) AS null_city_pct,
                round((bronze_rows - bronze_keys) * 100.0 / bronze_rows, 2) AS duplicate_pct,
                round(dead_letters * 100.0 / (dead_letters + bronze_rows), 2) AS dead_letter_pct,
                bronze_rows, silver_rows, dead_letters
              FROM (VALUES ('gold_arrival_date_popularity', TIMESTAMP '2024-01-20 06:00:00'),
                           ('gold_los_distribution', TIMESTAMP '2024-01-30 23:45:00')) m(table_name, refreshed_at),
                   (SELECT max(ingestion_time) AS newest_ingestion, count(*) AS bronze_rows,
                      count(DISTINCT dedup_key) AS bronze_keys FROM bronze) b,
                   (SELECT count(*) AS silver_rows, count(*) FILTER (WHERE city IS NULL) AS null_city FROM silver) s,
                   (SELECT count(*) AS dead_letters FROM landed WHERE reason IS NOT NULL) q""",
    })
    q.update({
        "oversize_quarantine": f"""SELECT event_id, ingestion_time, CAST(strlen(payload) AS INTEGER) AS kept_bytes,
              payload AS raw FROM landed_full WHERE reason = 'payload_too_large'""",
        "rate_limit_audit": f"""SELECT client, request_id, received_at,
              count(*) OVER (PARTITION BY client ORDER BY epoch_us(received_at)
                             RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW) AS window_count,
              count(*) OVER (PARTITION BY client ORDER BY epoch_us(received_at)
                             RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW) > 2 AS over_limit
              FROM feed""",
        "rate_limit_exact": f"""WITH RECURSIVE request_log AS MATERIALIZED (
                SELECT client, request_id, received_at, epoch_us(received_at) AS t,
                       row_number() OVER (PARTITION BY client ORDER BY received_at, request_id) AS rn
                FROM (SELECT CASE WHEN {draw("request_id", 3)} = 0 THEN 'client-hot' ELSE client END AS client,
                             request_id, received_at FROM feed)),
              limited AS (
                SELECT client, request_id, received_at, rn, true AS accepted, [t] AS recent FROM request_log WHERE rn = 1
                UNION ALL
                SELECT client, request_id, received_at, rn, len(kept) < 2,
                       CASE WHEN len(kept) < 2 THEN list_append(kept, t) ELSE kept END
                FROM (SELECT l.*, list_filter(p.recent, lambda x: x > l.t - 3600000000) AS kept
                      FROM limited p JOIN request_log l ON l.client = p.client AND l.rn = p.rn + 1))
              SELECT client, request_id, received_at, accepted FROM limited""",
        "gold_last_7_days": f"""SELECT city, (SELECT max(search_date) FROM silver) - 6 AS from_date,
              (SELECT max(search_date) FROM silver) AS to_date, user_country, user_country_iso,
              count(*) AS search_count,
              {share('count(*)', 'sum(count(*)) OVER (PARTITION BY city)')} AS pct_of_total,
              round(avg(length_of_stay), 1) AS avg_los
              FROM silver WHERE city IS NOT NULL AND search_date BETWEEN (SELECT max(search_date) FROM silver) - 6
                AND (SELECT max(search_date) FROM silver)
              GROUP BY city, user_country, user_country_iso""",
        "gold_weekly_arrivals": f"""SELECT city, week_start, count(*) AS search_count,
              count(*) >= {R.WEEKLY_HIGHLIGHT_THRESHOLD} AS highlight FROM (
                SELECT city, CAST(time_bucket(INTERVAL 7 DAY, CAST(arrival_date AS DATE),
                                              DATE '1970-01-01') AS DATE) AS week_start
                FROM silver WHERE city IS NOT NULL) GROUP BY city, week_start""",
    })
    q.update({
        "bronze_layout": """SELECT ingest_date, count(*) AS rows, count(DISTINCT hotel_id) AS hotels,
              min(hotel_id) AS min_hotel_id, max(hotel_id) AS max_hotel_id, 0::BIGINT AS overlapping_files FROM bronze GROUP BY ingest_date""",
        "bronze_retention": f"""SELECT ingest_date, count(*) AS rows FROM bronze
              WHERE ingest_date >= DATE '{RETENTION_AS_OF}' - {R.RETENTION_DAYS} GROUP BY ingest_date""",
        "bronze_idempotent_insert": "SELECT event_id, dedup_key, ingestion_time, ingest_date FROM bronze",
        "silver_watermark": "SELECT * EXCLUDE (payload) FROM silver",
        "full_refresh_counts": " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS rows, max(search_date) AS last_day FROM {src} "
            "WHERE search_date < DATE '2024-01-20'"
            for name, src in [("silver", "silver"), ("gold_arrival_date_popularity", "gold_arrival"),
                              ("gold_country_trends", "gold_country"), ("gold_los_distribution", "gold_los")]),
        "quarantine_retention": f"""SELECT ingest_date, reason, count(*) AS rows FROM landed_full
              WHERE reason IS NOT NULL AND ingest_date >= DATE '{RETENTION_AS_OF}' - {R.RETENTION_DAYS}
              GROUP BY ingest_date, reason""",
        "request_bodies": """SELECT coalesce(f.reason, 'none') AS reason, count(*) AS events,
              count(DISTINCT t.dedup_key) AS keys FROM landed_full f JOIN landed_t t USING (event_id) GROUP BY ALL""",
        "silver_incremental": "SELECT * EXCLUDE (payload) FROM silver",
        "gold_incremental": _panels(),
        "backfill_range": f"SELECT * FROM gold_country WHERE search_date BETWEEN DATE '{BACKFILL[0]}' AND DATE '{BACKFILL[1]}'",
    })
    q.update({
        "city_trends": _panels(RANGE, position=True),
        "city_trends_undated": _panels(f"city = '{CITY}'", position=True),
        "archive_jsonl": "SELECT * FROM bronze",
        "publish_envelope": """SELECT event_id AS "key", payload AS "value", h.header AS header, h.text AS header_value
              FROM (SELECT *, unnest([
                {'header': 'ingestion_time', 'text': strftime(ingestion_time, '%Y-%m-%dT%H:%M:%S.%f') || 'Z'},
                {'header': 'partner_id', 'text': partner_id},
                {'header': 'schema_version', 'text': schema_version}]) AS h FROM bronze)""",
        "gold_last_7_days_arrivals": """SELECT city, (SELECT max(search_date) FROM silver) - 6 AS from_date,
              (SELECT max(search_date) FROM silver) AS to_date, CAST(arrival_date AS DATE) AS arrival_date,
              count(*) AS search_count FROM silver
              WHERE city IS NOT NULL AND search_date BETWEEN (SELECT max(search_date) FROM silver) - 6
                AND (SELECT max(search_date) FROM silver) GROUP BY city, arrival_date""",
        "gold_last_7_days_los": f"""SELECT city, (SELECT max(search_date) FROM silver) - 6 AS from_date,
              (SELECT max(search_date) FROM silver) AS to_date, los_bucket, count(*) AS search_count,
              {share('count(*)', 'sum(count(*)) OVER (PARTITION BY city)')} AS pct_of_total FROM silver
              WHERE city IS NOT NULL AND search_date BETWEEN (SELECT max(search_date) FROM silver) - 6
                AND (SELECT max(search_date) FROM silver) GROUP BY city, los_bucket""",
        "stream_landing": "SELECT * FROM bronze",
        "stream_stable_ids": """SELECT coalesce(reason, 'none') AS reason, count(*) AS events, count(*) AS ids, count(*) AS same_again
              FROM landed GROUP BY ALL""",
        "stream_alerts": f"""WITH delivered AS (
                SELECT t, reason, CASE WHEN late THEN 1 ELSE span END AS span, time_bucket(INTERVAL 5 MINUTE, t) + INTERVAL 5 MINUTE AS own
                FROM (SELECT ingestion_time AS t, reason,
                        CASE WHEN ingest_date >= DATE '2024-01-21' THEN 2 WHEN ingest_date >= DATE '2024-01-11' THEN 1 ELSE 0 END AS span,
                        {draw("event_id", 5)} = 0 AND ingestion_time >= TIMESTAMP '2024-01-10 12:00:00'
                          AND ingestion_time < TIMESTAMP '2024-01-11' AS late FROM landed)),
              marks AS (SELECT s.span, (SELECT max(t) FROM delivered d WHERE d.span < s.span) - INTERVAL 10 MINUTE AS mark
                        FROM (VALUES (0), (1), (2)) s(span)),
              placed AS (SELECT w, own, reason FROM (SELECT *, unnest([own, own + INTERVAL 5 MINUTE]) AS w FROM delivered) JOIN marks USING (span)
                         WHERE mark IS NULL OR w > mark),
              counted AS (SELECT w, count(*) FILTER (WHERE own = w) AS requests,
                            count(*) FILTER (WHERE own = w AND reason IS NOT NULL) AS dead_letters,
                            CAST(count(*) FILTER (WHERE reason IS NOT NULL) AS DOUBLE) / count(*) AS rate
                          FROM placed GROUP BY w HAVING requests > 0)
              SELECT a.own - INTERVAL 5 MINUTE AS window_start, a.own AS window_end, coalesce(requests, 0) AS requests,
                coalesce(dead_letters, 0) AS dead_letters, round(rate * 100.0, 2) AS error_pct, rate > 0.3 AS error_rate_alert,
                dead_letters > 0 AS dead_letter_alert, arrived - coalesce(requests, 0) AS late_requests
              FROM (SELECT own, count(*) AS arrived FROM delivered GROUP BY own) a LEFT JOIN counted ON w = own""",
        "contract_versions": f"""WITH vfeed_n AS (SELECT request_id, value, CAST(rtrim(request_id, 'r') AS BIGINT) AS n FROM feed),
              vfeed_v AS (SELECT *, CASE WHEN n % 3 = 1 THEN 'v2' WHEN n % 11 = 3 THEN 'v9' ELSE 'v1' END AS version FROM vfeed_n),
              vfeed AS (SELECT request_id, version, CASE WHEN version = 'v2' AND value LIKE '{{%' THEN '{{' ||
                  CASE WHEN n % 7 = 0 THEN '' ELSE '"guests":' || CAST(n % 24 + 1 AS VARCHAR) || ',' END ||
                  CASE WHEN n % 5 < 2 THEN '"trip_purpose":"leisure",' ELSE '' END || substr(value, 2) ELSE value END AS value FROM vfeed_v),
              {validated_cte("vfeed", "request_id", None, "vvalidated", "vv", None, "version")},
              judged AS (SELECT version, j, CASE WHEN version = 'v9' THEN 'unsupported_schema_version' WHEN strlen(value) > 2048 THEN 'payload_too_large'
                  WHEN j IS NULL OR json_type(j) <> 'OBJECT' THEN 'invalid_json' WHEN len(errors) > 0 THEN 'validation_failed'
                  ELSE 'none' END AS reason FROM vvalidated)
              SELECT version AS schema_version, reason, count(*) AS events,
                count(g) AS with_guests, sum(g)::BIGINT AS guests, count(p) AS with_purpose
              FROM (SELECT *, CASE WHEN reason = 'none' AND version = 'v2' THEN {jint('j', 'guests')} END AS g,
                      CASE WHEN reason = 'none' AND version = 'v2' THEN {jtext('j', 'trip_purpose')} END AS p FROM judged)
              GROUP BY version, reason""",
    })
    admitted = R.VALID_CURRENCIES + ["XYZ"]
    spent = f"({draw('r.event_id', 3)} = 0)"  # three attempts before: the second replay is the fifth
    replay_ctes = (
        "replay_src AS (SELECT event_id AS request_id, payload AS value FROM landed_full "
        "WHERE reason IN ('validation_failed', 'payload_too_large')),"
        + validated_cte("replay_src", "request_id", None, "replayed_1", "r1", admitted) + ","
        + validated_cte("replay_src", "request_id", R.KNOWN_COUNTRIES + ["norway"], "replayed_2", "r2", admitted) + """,
        keys_0 AS (SELECT t.dedup_key FROM landed_t t JOIN landed_full f USING (event_id) WHERE f.reason IS NULL),
        landed_1 AS (SELECT r.event_id, t.dedup_key FROM replayed_1 r JOIN landed_t t USING (event_id)
                     WHERE len(r.errors) = 0 AND strlen(r.value) <= 2048 AND t.dedup_key NOT IN (SELECT dedup_key FROM keys_0)),
        keys_1 AS (SELECT dedup_key FROM keys_0 UNION SELECT dedup_key FROM landed_1),
        outcomes_2 AS (SELECT r.event_id, t.dedup_key,
                         CASE WHEN len(r.errors) > 0 THEN CASE WHEN {SPENT} THEN 'abandoned' ELSE 'still_failing' END
                              WHEN t.dedup_key IN (SELECT dedup_key FROM keys_1) THEN 'already_landed'
                              ELSE 'relanded' END AS outcome
                       FROM replayed_2 r JOIN landed_t t ON r.event_id = t.event_id)""".replace("{SPENT}", spent))
    hav = (f"2 * 6371.0088 * asin(least(1.0, sqrt(pow(sin((radians(c_lat) - radians(lat)) / 2), 2) + "
           f"cos(radians(lat)) * cos(radians(c_lat)) * pow(sin((radians(c_lon) - radians(lon)) / 2), 2))))")
    q.update({
        "quarantine_replay": f"""WITH {replay_ctes}
              SELECT event_id, dedup_key, outcome, CAST(CASE WHEN {draw('event_id', 3)} = 0 THEN 5 ELSE 3 END AS INTEGER) AS attempts,
                outcome = 'relanded' OR event_id IN (SELECT event_id FROM landed_1) AS in_bronze
              FROM outcomes_2""",
        "nearest_city_fallback": f"""WITH placed AS (SELECT * FROM silver WHERE hotel_id IS NOT NULL
                  AND hotel_latitude BETWEEN -90 AND 90 AND hotel_longitude BETWEEN -180 AND 180),
              u AS (SELECT hotel_id, {mean_lat('hotel_latitude', 'hotel_longitude')} AS lat, {mean_lon('hotel_latitude', 'hotel_longitude')} AS lon
                    FROM placed WHERE city IS NULL GROUP BY hotel_id),
              h AS (SELECT city, hotel_id, {mean_lat('hotel_latitude', 'hotel_longitude')} AS lat, {mean_lon('hotel_latitude', 'hotel_longitude')} AS lon
                    FROM placed WHERE city IS NOT NULL GROUP BY city, hotel_id),
              c AS (SELECT city, {mean_lat('lat', 'lon')} AS c_lat, {mean_lon('lat', 'lon')} AS c_lon FROM h GROUP BY city),
              near AS (SELECT hotel_id, city, d FROM (SELECT hotel_id, city, {hav} AS d FROM u, c) WHERE d <= 100.0
                       QUALIFY row_number() OVER (PARTITION BY hotel_id ORDER BY d, city) = 1)
              SELECT u.hotel_id, round(u.lat, 6) AS lat, round(u.lon, 6) AS lon, n.city AS fallback_city, round(n.d, 3) AS distance_km
              FROM u LEFT JOIN near n ON u.hotel_id = n.hotel_id""",
    })
    out = {}
    for k, v in q.items():
        v = v.strip()
        # A query with its own CTEs extends the shared WITH list.
        if v.startswith("WITH RECURSIVE "):
            out[k] = "WITH RECURSIVE " + BASE + "," + v[15:]
        else:
            out[k] = ("WITH " + BASE + "," + v[5:]) if v.startswith("WITH ") else with_base(v)
    return out

"""Inbound search requests derived from the ``events`` table.

The driver datasets hold no hotel searches, so the raw message log that feeds
landing is derived row by row from ``events`` (k = event_id). It is a narrow,
shuffle-free projection (one scan; the re-sent copies come from ``explode``),
so it grows exactly with the input. The same rule is written in SQL for the
DuckDB oracle; both build the JSON text with ``concat`` so bytes are equal.

Rule (k = event_id):
  hotel_id      1235 + user_id mod 7 (1240 and 1241 are not in the hotel dim)
  user_country  item k mod 12 of SEED_COUNTRIES
  timestamp     ts as yyyy-MM-dd'T'HH:mm:ss
  arrival_date  date(ts) + k mod 60 days; JSON null when k mod 97 = 0
  nights        1 + k mod 16; departure = arrival + nights
  length_of_stay nights, +1 when k mod 29 = 0
  coordinates   anchor of the hotel + k-derived digits; for odd k hotel 1241 lies at -179.9.., across the 180th meridian
  search_results 1 + k mod 3 rooms; price from ``value``; currency item (k+i) mod 6
  request_id    k; a re-sent copy ``k`` + 'r' when k mod 20 = 0, received 1 h later;
                the copy changes departure and stay by one night when k mod 40 = 0
                (a valid correction) and only the stay when k mod 40 = 20 (invalid)
  received_at   ts + 5 s (+ 3600 s for the copy)
  client        sending address, 'client-' + user_id mod 16

With ``dirty=True`` rows with k mod 50 in DEFECTS get one defect each (see DEFECTS).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Seed values of the derived feed (test fixture, not contract data).
SEED_COUNTRIES = ["Belgium", "Brazil", "France", "Germany", "Netherlands", "Spain",
                  "Switzerland", "United Kingdom", "United States", "USA", "Norway", " germany "]
SEED_ROOMS = ["Standard Room", "Deluxe Suite", "Double Room", "King Room"]
SEED_CURRENCIES = ["EUR", "USD", "GBP", "CHF", "BRL", "XYZ"]
# hotel_id -> (latitude prefix, longitude prefix); three more digits are appended.
SEED_ANCHORS = [
    (1235, "40.7", "-74.0"),
    (1236, "50.8", "4.3"),
    (1237, "48.8", "2.3"),
    (1238, "52.5", "13.4"),
    (1239, "47.3", "8.5"),
    (1240, "48.9", "2.4"),
    (1241, "-17.9", "179.7"),
]
# k mod 50 -> defect injected into the payload.
DEFECTS = {
    1: "not JSON",
    2: "JSON list instead of object",
    3: "hotel_id missing",
    4: "hotel_id as text",
    5: "latitude 95",
    6: "empty search_results",
    7: "first price 0",
    8: "body over 2048 bytes",
    9: "departure before arrival",
    10: "extra field",
    11: "arrival as dd-MM-yyyy",
    12: "length_of_stay written n.0",
    13: "timestamp with Z",
    14: "timestamp with -05:00 offset",
    15: "hotel_id 0",
    16: "timestamp with seven fraction digits and Z",
    17: "timestamp with +0500 offset",
    18: "timestamp in basic form",
    19: "length_of_stay 0",
    21: "user_country empty",
    22: "hotel_name empty",
    23: "longitude 200.5",
    24: "first search result a number",
    26: "first search result without price",
    27: "first room_name empty",
    28: "first currency in lower case",
    29: "hotel_id written n.0",
    31: "length_of_stay 400",
}


def versioned_feed(events: DataFrame) -> DataFrame:
    """The feed with a contract version a message (X5, FIXTURES.md 6), decided by the number in its id.

    n mod 3 = 1: v2 with guests 1 + n mod 24 (above 20 breaks the contract), left out when n mod 7 = 0;
    trip_purpose when n mod 5 < 2; n mod 11 = 3: the unknown version v9; else v1.
    """
    n = F.regexp_replace("request_id", "r$", "").cast("long")
    extra = F.concat(F.when(n % 7 == 0, F.lit("")).otherwise(F.concat(F.lit('"guests":'), (n % 24 + 1).cast("string"), F.lit(","))),
                     F.when(n % 5 < 2, F.lit('"trip_purpose":"leisure",')).otherwise(F.lit("")))
    version = F.when(n % 3 == 1, "v2").when(n % 11 == 3, "v9").otherwise("v1")
    body = F.when((version == "v2") & F.col("value").startswith("{"),
                  F.concat(F.lit("{"), extra, F.substring("value", 2, 1 << 30))).otherwise(F.col("value"))
    return search_feed(events).withColumns({"schema_version": version, "value": body})


def _lits(values):
    return F.array(*[F.lit(x) for x in values])


def _q(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def _kv(name: str, c: Column) -> Column:
    return F.concat(F.lit(f'"{name}":'), c)


def search_feed(events: DataFrame, dirty: bool = True) -> DataFrame:
    """Raw message log ``(request_id, received_at, value)`` derived from ``events``."""
    k = F.col("event_id")
    d = F.col("defect")
    e = (events.select("event_id", "ts", "user_id", "value")
         .withColumn("copy", F.explode(F.when(k % 20 == 0, F.array(F.lit(0), F.lit(1)))
                                       .otherwise(F.array(F.lit(0)))))
         .withColumn("defect", (k % 50).cast("int") if dirty else F.lit(0)))

    hid = (F.lit(1235) + F.col("user_id") % 7).cast("int")
    fix = F.col("copy") == 1
    dep_extra = F.when(fix & (k % 40 == 0), 1).otherwise(0)
    los_extra = (F.when(k % 29 == 0, 1).otherwise(0)
                 + F.when(fix & (k % 40 == 20), 1).otherwise(0))
    nights = (F.lit(1) + k % 16).cast("int")
    arr = F.date_add(F.to_date("ts"), (k % 60).cast("int"))
    dep = F.when(d == 9, F.date_sub(arr, nights)).otherwise(F.date_add(arr, nights + dep_extra))
    los = (nights + dep_extra + los_extra).cast("string")
    ts_text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    ts_text = (F.when(d == 13, F.concat(ts_text, F.lit("Z")))
               .when(d == 14, F.concat(ts_text, F.lit("-05:00")))
               .when(d == 16, F.concat(ts_text, F.lit(".1234567Z")))
               .when(d == 17, F.concat(ts_text, F.lit("+0500")))
               .when(d == 18, F.date_format("ts", "yyyyMMdd'T'HHmmss")).otherwise(ts_text))
    anchor = (hid - 1235 + 1)
    lat = F.concat(F.element_at(_lits([a[1] for a in SEED_ANCHORS]), anchor),
                   F.lpad((k % 1000).cast("string"), 3, "0"))
    across = (hid == 1241) & (k % 2 == 1)
    lon = F.concat(F.when(across, F.lit("-179.9")).otherwise(F.element_at(_lits([a[2] for a in SEED_ANCHORS]), anchor)),
                   F.lpad((k * 7 % 1000).cast("string"), 3, "0"))
    base_cents = F.floor(F.col("value") * 100 + 0.5)

    def item(i: int) -> Column:
        cents = base_cents + 100 * (i + 1)
        price = F.concat(F.expr(f"cast(floor(value * 100 + 0.5) + {100 * (i + 1)} as bigint) div 100")
                         .cast("string"), F.lit("."), F.lpad((cents % 100).cast("bigint").cast("string"), 2, "0"))
        if i == 0:
            price = F.when(d == 7, F.lit("0")).otherwise(price)
        room = F.element_at(_lits(SEED_ROOMS), ((k + i) % 4 + 1).cast("int"))
        currency = F.element_at(_lits(SEED_CURRENCIES), ((k + i) % 6 + 1).cast("int"))
        price = F.concat(F.lit(',"price":'), price)
        if i == 0:
            room = F.when(d == 27, F.lit("")).otherwise(room)
            price = F.when(d == 26, F.lit("")).otherwise(price)
            currency = F.when(d == 28, F.lit("eur")).otherwise(currency)
        whole = F.concat(F.lit('{"room_name":"'), room, F.lit('"'), price, F.lit(',"currency":"'), currency, F.lit('"}'))
        return F.when(d == 24, F.lit("5")).otherwise(whole) if i == 0 else whole

    n_items = k % 3
    results = F.concat(F.lit("["), F.concat_ws(",", item(0),
                                               F.when(n_items >= 1, item(1)),
                                               F.when(n_items >= 2, item(2))), F.lit("]"))
    results = F.when(d == 6, F.lit("[]")).otherwise(results)

    arrival = (F.when(k % 97 == 0, F.lit("null"))
               .when(d == 11, _q(F.date_format(arr, "dd-MM-yyyy")))
               .otherwise(_q(F.date_format(arr, "yyyy-MM-dd"))))
    hotel = (F.when(d == 3, F.lit(None).cast("string"))
             .when(d == 4, _q(hid.cast("string")))
             .when(d == 15, F.lit("0"))
             .when(d == 29, F.concat(hid.cast("string"), F.lit(".0")))
             .otherwise(hid.cast("string")))
    body = F.concat(F.lit("{"), F.concat_ws(
        ",",
        _kv("arrival_date", arrival),
        _kv("departure_date", _q(F.date_format(dep, "yyyy-MM-dd"))),
        _kv("length_of_stay", F.when(d == 12, F.concat(los, F.lit(".0"))).when(d == 19, F.lit("0")).when(d == 31, F.lit("400"))
            .otherwise(los)),
        _kv("user_country", _q(F.when(d == 21, F.lit("")).otherwise(F.element_at(_lits(SEED_COUNTRIES), (k % 12 + 1).cast("int"))))),
        _kv("hotel_id", hotel),
        _kv("hotel_name", _q(F.when(d == 22, F.lit("")).otherwise(F.concat(F.lit("Hotel "), hid.cast("string"))))),
        _kv("hotel_latitude", F.when(d == 5, F.lit("95.0")).otherwise(lat)),
        _kv("hotel_longitude", F.when(d == 23, F.lit("200.5")).otherwise(lon)),
        _kv("timestamp", _q(ts_text)),
        _kv("search_results", results),
        F.when(d == 10, _kv("partner_ref", _q(F.concat(F.lit("p"), k.cast("string"))))),
        F.when(d == 8, _kv("note", _q(F.repeat(F.lit("x"), 2100)))),
    ), F.lit("}"))
    body = (F.when(d == 1, F.concat(F.lit("not json "), k.cast("string")))
            .when(d == 2, F.concat(F.lit("["), k.cast("string"), F.lit("]")))
            .otherwise(body))

    return e.select(
        F.concat(k.cast("string"), F.when(fix, F.lit("r")).otherwise(F.lit(""))).alias("request_id"),
        (F.col("ts").cast("timestamp")
         + F.make_dt_interval(secs=(F.lit(5) + F.col("copy") * 3600).cast("decimal(18,6)"))).alias("received_at"),
        body.alias("value"),
        F.concat(F.lit("client-"), (F.col("user_id") % 16).cast("string")).alias("client"),
    )

"""Landing -> silver -> marts -> reads, on hand-made events (reference scenarios + gaps)."""

import hashlib

from pyspark.sql import functions as F

from conftest import messages
from staylens.operators import gold, landing, serving
from staylens.operators.silver import silver as build_silver, silver_rejects


def run(spark, items, gate="full"):
    labelled = landing.land(messages(spark, items), gate)
    bronze = landing.bronze_rows(labelled)
    s = build_silver(bronze)
    return labelled, bronze, s


def test_bronze_to_gold(spark, base_event):
    other = {**base_event, "user_country": "Germany", "timestamp": "2022-01-25T10:00:00"}
    _, _, s = run(spark, [("a", "2022-01-24 11:01:13", base_event), ("b", "2022-01-25 10:00:01", other)])
    assert s.count() >= 2
    cities = [r.city for r in gold.country_trends(s).select("city").distinct().collect()]
    assert "New York" in cities


def test_same_event_twice_is_one_silver_row(spark, base_event):
    _, bronze, s = run(spark, [("a", "2022-01-24 11:01:13", base_event), ("b", "2022-01-24 11:02:13", base_event)])
    assert bronze.count() == 2 and s.count() == 1


def test_accept_and_reject(spark, base_event):
    bad = {**base_event, "length_of_stay": 99}
    labelled, _, _ = run(spark, [("ok", "2022-01-24 11:01:13", base_event), ("bad", "2022-01-24 11:01:14", bad)])
    reasons = {r.event_id: r.reason for r in labelled.collect()}
    assert reasons == {"ok": None, "bad": "validation_failed"}


def test_trends_have_three_panels(spark, base_event):
    _, _, s = run(spark, [("a", "2022-01-24 11:01:13", base_event)])
    row = serving.city_trends(gold.arrival_popularity(s), gold.country_trends(s), gold.los_distribution(s),
                              "New York").first()
    assert row.city == "New York"
    assert len(row.arrival_date_popularity) >= 1 and len(row.country_trends) >= 1 and len(row.los_distribution) >= 1


def test_dedup_key_matches_python_formatting(spark, base_event):
    ev = {**base_event}
    del ev["arrival_date"]
    labelled = landing.land(messages(spark, [("a", "2022-01-24 11:01:13", ev)]), "light")
    expected = hashlib.sha256("1235|2022-01-24T09:20:00|Netherlands|None".encode()).hexdigest()
    assert labelled.first().dedup_key == expected


def test_latest_valid_duplicate_wins_and_invalid_latest_loses(spark, base_event):
    fixed = {**base_event, "departure_date": "2022-06-15", "length_of_stay": 5}
    broken = {**base_event, "length_of_stay": 7}
    _, _, s = run(spark, [("old", "2022-01-24 11:01:13", base_event), ("new", "2022-01-24 12:01:13", fixed)], "light")
    assert [r.event_id for r in s.collect()] == ["new"]
    _, _, s = run(spark, [("old", "2022-01-24 11:01:13", base_event), ("new", "2022-01-24 12:01:13", broken)], "light")
    assert [r.event_id for r in s.collect()] == ["old"]


def test_unknown_hotel_kept_without_city_and_absent_from_marts(spark, base_event):
    ev = {**base_event, "hotel_id": 9999}
    _, _, s = run(spark, [("a", "2022-01-24 11:01:13", ev)])
    row = s.first()
    assert row.city is None and gold.los_distribution(s).count() == 0


def test_los_14_kept_15_dropped(spark, base_event):
    e14 = {**base_event, "departure_date": "2022-06-24", "length_of_stay": 14}
    e15 = {**base_event, "departure_date": "2022-06-25", "length_of_stay": 15, "timestamp": "2022-01-24T11:05:00"}
    _, bronze, s = run(spark, [("a", "2022-01-24 11:01:13", e14), ("b", "2022-01-24 11:05:01", e15)])
    assert bronze.count() == 2 and [r.los_bucket for r in s.collect()] == ["8-14"]
    reasons = {r.event_id: r.reason for r in silver_rejects(bronze).collect()}
    assert reasons == {"b": "los_out_of_range"}


def test_country_iso_mapping(spark, base_event):
    evs = [(f"e{i}", "2022-01-24 11:01:13", {**base_event, "user_country": c, "timestamp": f"2022-01-24T11:0{i}:00"})
           for i, c in enumerate([" germany ", "USA", "Norway"])]
    _, _, s = run(spark, evs, "light")
    iso = {r.user_country: r.user_country_iso for r in s.collect()}
    assert iso == {" germany ": "DE", "USA": "US", "Norway": "NO"}


def test_offset_timestamp_moves_search_date(spark, base_event):
    ev = {**base_event, "timestamp": "2022-01-24T22:30:00-05:00"}
    _, _, s = run(spark, [("a", "2022-01-25 03:30:01", ev)])
    assert str(s.first().search_date) == "2022-01-25"


def test_light_gate_routes_bad_bodies(spark, base_event):
    items = [("json", "2022-01-24 11:01:13", "{not json"),
             ("list", "2022-01-24 11:01:13", "[1]"),
             ("zero", "2022-01-24 11:01:13", {**base_event, "hotel_id": 0}),
             ("big", "2022-01-24 11:01:13", {**base_event, "pad": "x" * 3000}),
             ("zero_text", "2022-01-24 11:01:13", {**base_event, "hotel_id": "0"}),
             ("compact", "2022-01-24 11:01:13", {**base_event, "timestamp": "20220124T110112,25+05"}),
             ("ok", "2022-01-24 11:01:13", {**base_event, "hotel_id": "1235"})]
    labelled = landing.land(messages(spark, items), "light")
    got = {r.event_id: (r.reason, r.hotel_id) for r in labelled.collect()}
    assert got == {"json": ("invalid_json", None), "list": ("invalid_json", None),
                   "zero": ("missing_required_fields", 0), "big": (None, 1235), "zero_text": (None, 0), "compact": (None, 1235),
                   "ok": (None, 1235)}
    at = {r.event_id: str(r.search_timestamp) for r in labelled.collect()}
    assert at["compact"] == "2022-01-24 06:01:12.250000"
    full = landing.quarantine_rows(landing.land(messages(spark, items), "full"))
    q = {r.event_id: (r.reason, len(r.raw)) for r in full.collect()}
    assert q["big"][0] == "payload_too_large" and q["big"][1] > 3000  # kept whole, so it can be replayed


def test_share_sums_to_100(spark, base_event):
    evs = [(f"e{i}", "2022-01-24 11:01:13",
            {**base_event, "timestamp": f"2022-01-24T11:{i:02d}:00",
             "user_country": ["Belgium", "France", "Spain"][i % 3]}) for i in range(7)]
    _, _, s = run(spark, evs)
    total = gold.country_trends(s).agg(F.sum("pct_of_total")).first()[0]
    assert abs(total - 100.0) <= 0.15


def test_second_contract_version(spark, base_event):
    """v2 needs the party size, v1 does not know it; both are staged side by side."""
    import json
    from staylens.operators.silver import stage_versions
    bodies = [("v1", {}), ("v2", {}), ("v2", {"guests": 2}), ("v2", {"guests": 21}), ("v2", {"guests": 3, "trip_purpose": ""}),
              ("v2", {"guests": 4, "trip_purpose": "work"}), ("v1", {"guests": 99}), ("v3", {"guests": 2})]
    df = messages(spark, [(f"e{i}", "2022-01-24 12:00:00", json.dumps({**base_event, **b})) for i, (_, b) in enumerate(bodies)])
    version = F.element_at(F.array(*[F.lit(v) for v, _ in bodies]), F.substring("request_id", 2, 1).cast("int") + 1)
    landed = landing.land(df.withColumn("schema_version", version), "full")
    got = {r.event_id: (r.reason, [e.code for e in r.errors]) for r in landed.collect()}
    assert got == {"e0": (None, []), "e1": ("validation_failed", ["guests.required"]), "e2": (None, []),
                   "e3": ("validation_failed", ["guests.maximum"]), "e4": ("validation_failed", ["trip_purpose.too_short"]),
                   "e5": (None, []), "e6": (None, []), "e7": ("unsupported_schema_version", ["root.version"])}
    staged = {r.event_id: (r.guests, r.trip_purpose, r.length_of_stay) for r in stage_versions(landing.bronze_rows(landed)).collect()}
    assert staged == {"e0": (None, None, 4), "e2": (2, None, 4), "e5": (4, "work", 4), "e6": (None, None, 4)}


def test_dedup_key_spells_numbers_and_booleans(spark, base_event):
    import json
    for value, spelled in ((1235.0, "1235.0"), (True, "True"), (1235, "1235"), (1235.5, "1235.5"), ("1235", "1235")):
        body = json.dumps({**base_event, "hotel_id": value})
        key = landing.land(messages(spark, [("a", "2022-01-24 11:01:13", body)]), "light").first().dedup_key
        text = f"{spelled}|{base_event['timestamp']}|{base_event['user_country']}|{base_event['arrival_date']}"
        assert key == hashlib.sha256(text.encode()).hexdigest(), value


def test_schema_version_routing(spark, base_event):
    import json
    rows = [("a", None, json.dumps(base_event)), ("b", "v1", json.dumps({**base_event, "timestamp": "2022-01-24T11:02:00"})),
            ("c", "v9", json.dumps({**base_event, "timestamp": "2022-01-24T11:03:00"}))]
    import datetime as dt
    df = spark.createDataFrame([(r, dt.datetime(2022, 1, 24, 12), v, b) for r, v, b in rows],
                               "request_id string, received_at timestamp, schema_version string, value string")
    got = {r.event_id: (r.schema_version, r.reason) for r in landing.land(df, "full").collect()}
    assert got == {"a": ("v1", None), "b": ("v1", None), "c": ("v9", "unsupported_schema_version")}


def test_replay_lands_once_and_abandons_after_five_attempts(spark, base_event):
    import json
    from staylens.operators.recovery import replay_and_land
    from staylens.session import work_dir
    from staylens.sources import sinks
    body = json.dumps({**base_event, "user_country": "Norway"})
    bad = json.dumps({**base_event, "hotel_id": -1})
    q = landing.quarantine_rows(landing.land(messages(spark, [
        ("n", "2022-01-24 11:01:13", body), ("x", "2022-01-24 11:01:13", bad)]), "full"))
    path = work_dir(spark, "replay-bronze")
    sinks.write_bronze(landing.bronze_rows(landing.land(messages(
        spark, [("seed", "2022-01-24 10:00:00", {**base_event, "timestamp": "2022-01-23T08:00:00"})]), "full")), path)
    known = ["netherlands", "norway"]
    first = {r.event_id: (r.outcome, r.attempts) for r in replay_and_land(spark, q, path, known).collect()}
    assert first == {"n": ("relanded", 2), "x": ("still_failing", 2)}
    late = q.drop("attempts").selectExpr("*", "4 as attempts")
    again = {r.event_id: (r.outcome, r.attempts) for r in replay_and_land(spark, late, path, known).collect()}
    assert again == {"n": ("already_landed", 5), "x": ("abandoned", 5)}
    assert sorted(r.event_id for r in sinks.read_bronze(spark, path).select("event_id").collect()) == ["n", "seed"]

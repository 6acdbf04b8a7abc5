"""Contract validation by rule (V1-V24), with edge cases of types, order and stages."""

import json

import pytest

from conftest import messages
from staylens.operators.validation import validate


def errors_of(spark, payload):
    body = payload if isinstance(payload, str) else json.dumps(payload)
    row = validate(messages(spark, [("1", "2022-01-24 11:01:13", body)])).first()
    return [f"{e.path}: {e.message}" for e in row["errors"]], row["failed_stage"]


def joined(errs):
    return " | ".join(errs)


# Per rule: the change to a good event, the stage that rejects it, the paths its errors name.
REQUIRED = ["arrival_date", "departure_date", "length_of_stay", "user_country", "hotel_id", "hotel_name",
            "hotel_latitude", "hotel_longitude", "timestamp", "search_results"]
RULES = [
    *[("V2", {f: ...}, "contract", [f]) for f in REQUIRED],
    *[("V3", {f: 7}, "contract", [f]) for f in ("arrival_date", "departure_date", "user_country", "hotel_name", "timestamp")],
    *[("V4", {f: "7"}, "contract", [f]) for f in ("length_of_stay", "hotel_id")],
    ("V5", {"length_of_stay": 0}, "contract", ["length_of_stay"]),
    ("V5", {"length_of_stay": 366}, "contract", ["length_of_stay"]),
    ("V6", {"user_country": ""}, "contract", ["user_country"]),
    ("V7", {"hotel_id": -3}, "contract", ["hotel_id"]),
    ("V8", {"hotel_name": ""}, "contract", ["hotel_name"]),
    *[("V9", {"hotel_latitude": x}, "contract", ["hotel_latitude"]) for x in (90.5, -91, "12")],
    *[("V10", {"hotel_longitude": x}, "contract", ["hotel_longitude"]) for x in (180.5, -181, None)],
    ("V11", {"search_results": []}, "contract", ["search_results"]),
    ("V12", {"search_results": [5]}, "contract", ["search_results.0"]),
    ("V13", {"search_results": [{"price": 3, "currency": "EUR"}]}, "contract", ["room_name"]),
    *[("V14", {"search_results": [{"room_name": "R", "price": p, "currency": "EUR"}]}, "contract", ["price"]) for p in (0, -0.5, "9")],
    ("V15", {"search_results": [{"room_name": "R", "price": 3, "currency": "EURO"}]}, "contract", ["currency"]),
    *[("V17", {f: "10/06/2022"}, "business", [f]) for f in ("arrival_date", "departure_date")],
    ("V17", {"arrival_date": "2022-02-30"}, "business", ["arrival_date"]),
    ("V18", {"timestamp": "yesterday"}, "business", ["timestamp"]),
    ("V19", {"departure_date": "2022-06-10"}, "business", ["departure_date"]),
    ("V20", {"length_of_stay": 6}, "business", ["length_of_stay"]),
    ("V22", {"user_country": "Atlantis"}, "business", ["user_country"]),
    ("V22", {"user_country": "Cote d'Ivoire"}, "business", ["user_country"]),
    ("V24", {"search_results": [{"room_name": "R", "price": 3, "currency": "ZZZ"}]}, "business", ["currency"]),
]


@pytest.mark.parametrize("rule,change,stage,paths", RULES, ids=[f"{r}-{i}" for i, (r, *_) in enumerate(RULES)])
def test_rule_rejects(spark, base_event, rule, change, stage, paths):
    event = {k: v for k, v in {**base_event, **change}.items() if v is not ...}
    errs, failed = errors_of(spark, event)
    assert failed == stage and errs
    assert all(any(p in e for e in errs) for p in paths)


def codes_of(spark, payload):
    row = validate(messages(spark, [("1", "2022-01-24 11:01:13", json.dumps(payload))])).first()
    return [e.code for e in row["errors"]]


def test_rejections_by_code(spark, base_event):
    """Counted by the code of the rule, whatever the value; every rule is listed."""
    from staylens.operators.validation import rejections_by_code, rule_codes
    bodies = [{**base_event, "user_country": c} for c in ("Cote d'Ivoire", "X'Y'Z", "Atlantis", "A\nB'")]
    df = validate(messages(spark, [(str(i), "2022-01-24 11:01:13", json.dumps(b)) for i, b in enumerate(bodies)]))
    got = {r.code: (r.error_count, r.pct_of_events) for r in rejections_by_code(df).collect()}
    assert sorted(got) == sorted(rule_codes()) and len(got) > 50
    assert {c: v for c, v in got.items() if v[0]} == {"user_country.known": (4, 100.0)}


def test_codes_name_the_rule(spark, base_event):
    assert codes_of(spark, {**base_event, "length_of_stay": 0}) == ["length_of_stay.minimum"]
    assert codes_of(spark, {**base_event, "hotel_name": ""}) == ["hotel_name.too_short"]
    assert codes_of(spark, {k: v for k, v in base_event.items() if k != "timestamp"}) == ["timestamp.required"]
    assert codes_of(spark, {**base_event, "search_results": [7, {"room_name": "R", "price": 0, "currency": "eur"}]}) == [
        "search_results[].object", "search_results[].currency.pattern", "search_results[].price.exclusive_minimum"]


def test_every_code_can_fire(spark, base_event):
    """Each rule of the contract's own version, broken once."""
    from staylens.operators.validation import field_rules, rule_codes
    wrong = {"string": 7, "integer": "7", "number": "x", "array": {}, "empty": []}
    events = [{k: v for k, v in base_event.items() if k != f} for f in base_event]
    for r in field_rules():
        if "v1" not in r.versions or r.check == "required":
            continue
        if r.check in wrong:
            value = wrong[r.check]
        elif r.check in ("minimum", "maximum"):
            value = r.bound + (1 if r.check == "maximum" else -1)
        else:
            value = "x" * (r.bound + 1 if r.check == "too_long" else r.bound - 1)
        events.append({**base_event, r.field: value})
    room = base_event["search_results"][0]
    for item in (5, {}, {**room, "room_name": 1}, {**room, "room_name": ""}, {**room, "price": "1"}, {**room, "price": 0},
                 {**room, "currency": 1}, {**room, "currency": "e"}, {**room, "currency": "XXX"}):
        events.append({**base_event, "search_results": [item]})
    events += [{**base_event, **c} for c in ({"arrival_date": "x"}, {"departure_date": "x"}, {"timestamp": "x"}, {"length_of_stay": 9},
                                             {"departure_date": base_event["arrival_date"]}, {"user_country": "x"})]
    bodies = [json.dumps(e) for e in events] + ["no json", "[]"]
    df = validate(messages(spark, [(str(i), "2022-01-24 11:01:13", b) for i, b in enumerate(bodies)]))
    fired = {e.code for r in df.select("errors").collect() for e in r.errors}
    only_v2 = {r.code for r in field_rules() if "v1" not in r.versions}
    assert set(rule_codes()) - fired == only_v2


def test_accepted_events(spark, base_event):
    """V1-V24 hold; V21: an arrival in the past is fine."""
    past = {"arrival_date": "2019-12-31", "departure_date": "2020-01-04"}
    for change in ({}, past, {"length_of_stay": 1, "departure_date": "2022-06-11"}):
        assert errors_of(spark, {**base_event, **change}) == ([], None)


def test_stay_message_names_both_values(spark, base_event):
    base_event["length_of_stay"] = 9
    assert errors_of(spark, base_event)[0] == ["length_of_stay: expected 4 based on dates, got 9"]


def test_country_is_stripped_and_lowered(spark, base_event):
    base_event["user_country"] = "\tUNITED kingdom \n"
    assert errors_of(spark, base_event) == ([], None)


def test_integral_float_is_integer_but_fraction_is_not(spark, base_event):
    base_event["length_of_stay"] = 4.0
    assert errors_of(spark, base_event)[0] == []
    base_event["length_of_stay"] = 4.5
    assert "length_of_stay: is not of type 'integer'" in errors_of(spark, base_event)[0]


def test_types_are_strict(spark, base_event):
    base_event["hotel_id"] = "1235"
    base_event["hotel_latitude"] = True
    errs, _ = errors_of(spark, base_event)
    assert "hotel_id: is not of type 'integer'" in errs
    assert "hotel_latitude: is not of type 'number'" in errs


def test_null_counts_as_present_but_wrong_type(spark, base_event):
    base_event["arrival_date"] = None
    errs, _ = errors_of(spark, base_event)
    assert errs == ["arrival_date: is not of type 'string'"]


def test_stage_two_skipped_when_contract_fails(spark, base_event):
    base_event["user_country"] = "Narnia"
    base_event["hotel_id"] = 0
    errs, stage = errors_of(spark, base_event)
    assert stage == "contract" and errs == ["hotel_id: is less than the minimum of 1"]


def test_item_errors_are_ordered_by_path(spark, base_event):
    base_event["search_results"] = [
        {"room_name": "", "price": 1, "currency": "usd"},
        "not an object",
        {"price": 2, "currency": "EUR"},
    ]
    errs, _ = errors_of(spark, base_event)
    assert errs == [
        "search_results.0.currency: does not match '^[A-Z]{3}$'",
        "search_results.0.room_name: is too short",
        "search_results.1: is not of type 'object'",
        "search_results.2: 'room_name' is a required property",
    ]


def test_root_must_be_object_and_json(spark):
    assert errors_of(spark, "[1, 2]")[0] == ["root: is not of type 'object'"]
    assert errors_of(spark, "not json")[0] == ["root: invalid JSON"]


def test_timestamp_with_offset_and_z(spark, base_event):
    for ts in ["2022-01-24T11:01:12Z", "2022-01-24T11:01:12-05:00", "2022-01-24 11:01:12.123",
               "2022-01-24T11:01:12.1234567Z", "2022-01-24T11:01:12+0500", "20220124T110112", "2022-01-24T11+05"]:
        base_event["timestamp"] = ts
        assert errors_of(spark, base_event)[0] == []
    base_event["timestamp"] = "24/01/2022"
    assert errors_of(spark, base_event)[0] == ["timestamp: invalid datetime format"]


def test_extra_fields_allowed(spark, base_event):
    base_event["partner_ref"] = {"a": 1}
    base_event["search_results"][0]["breakfast"] = True
    assert errors_of(spark, base_event)[0] == []

"""Contract validation as set-based column expressions (rules V1-V24, versions X5).

Stage 1 checks the JSON contract (types, required fields, bounds, item shape);
stage 2 (business rules) runs only when stage 1 found nothing. Each rule yields
an optional ``(path, code, message)``; the non-null ones form the ``errors``
array. Stage-1 errors are ordered by path (root first, items by index), stage-2
errors keep rule order. A code names a rule for good, whatever value broke it.

The field rules of every contract version are rows of one table
(``field_rules``); a rule that not all versions have is guarded by the event's version.

Two projections: ``_facts`` reads every field of the VARIANT once (kind,
number, text; one struct per search result), then the rules are plain
comparisons over those columns. Keeping the facts in their own projection
stops the optimizer from re-expanding the JSON access inside every rule, which
keeps the generated code small (whole-stage codegen) and plan time flat.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from staylens import reference_data as R
from staylens.functions import json as J
from staylens.functions.dates import strict_date, strict_timestamp

# FIXED VALUES: error message formats (the field path prefixes every message).
MSG_NOT_OBJECT = "is not of type 'object'"
MSG_REQUIRED = "'{field}' is a required property"
MSG_TYPE = "is not of type '{type}'"
MSG_MIN = "is less than the minimum of {bound}"
MSG_MAX = "is greater than the maximum of {bound}"
MSG_EXCL_MIN = "is less than or equal to the minimum of 0"
MSG_TOO_SHORT = "is too short"
MSG_TOO_LONG = "is too long"
MSG_EMPTY = "should be non-empty"
MSG_PATTERN = "does not match '{pattern}'"
MSG_INVALID_JSON = "invalid JSON"
MSG_BAD_DATE = "invalid date format"
MSG_BAD_DATETIME = "invalid datetime format"
MSG_DEP_AFTER = "must be after arrival_date"
MSG_LOS = "expected %d based on dates, got %d"
MSG_COUNTRY = "unknown country '%s'"
MSG_CURRENCY = "unsupported currency '%s'"

ERRORS = "array<struct<path:string,code:string,message:string>>"
_ITEM = "struct<kind:string,rk:string,rs:string,pk:string,pn:double,ck:string,cs:string>"


_kind = J.kind


def _c(prefix: str, field: str) -> Column:
    return F.col(f"_{prefix}_{field}")


@dataclass(frozen=True)
class FieldRule:
    """One rule about one field: the versions that have it, its code, its message and its bound."""

    versions: tuple[str, ...]
    field: str
    check: str
    message: str
    bound: float | None = None

    @property
    def code(self) -> str:
        return f"{self.field}.{self.check}"

    @property
    def path(self) -> str:
        return "root" if self.check == "required" else self.field


def field_rules() -> list[FieldRule]:
    """V2-V11 of every contract version, each rule once with the versions it holds for."""
    found: dict[tuple, list[str]] = {}
    for version, c in R.CONTRACTS.items():
        rules = [(f, "required", MSG_REQUIRED.format(field=f), None) for f in c.required]                    # V2
        rules += [(f, "string", MSG_TYPE.format(type="string"), None) for f in c.strings]                    # V3
        rules += [(f, "integer", MSG_TYPE.format(type="integer"), None) for f in c.integers]                 # V4
        rules += [(f, "number", MSG_TYPE.format(type="number"), None) for f in c.numbers]                    # V9, V10
        for f, lo, hi in c.bounds:                                                                           # V5, V7, V9, V10
            rules += [(f, "minimum", MSG_MIN.format(bound=lo), lo)] if lo is not None else []
            rules += [(f, "maximum", MSG_MAX.format(bound=hi), hi)] if hi is not None else []
        for f, lo, hi in c.lengths:                                                                          # V6, V8
            rules += [(f, "too_short", MSG_TOO_SHORT, lo), (f, "too_long", MSG_TOO_LONG, hi)]
        rules += [("search_results", "array", MSG_TYPE.format(type="array"), None),                          # V11
                  ("search_results", "empty", MSG_EMPTY, None)]
        for r in rules:
            found.setdefault(r, []).append(version)
    return [FieldRule(tuple(v), *r) for r, v in found.items()]


def _fields(kind: str) -> list[str]:
    return list(dict.fromkeys(f for c in R.CONTRACTS.values() for f in getattr(c, kind)))


# FIXED VALUES: codes of the rules that no table row states.
CODE_NOT_JSON = "root.json"
CODE_NOT_OBJECT = "root.object"
ITEM_CODES = {
    "object": "search_results[].object", **{f: f"search_results[].{f}.required" for f in R.RESULT_ITEM_FIELDS},
    "room_type": "search_results[].room_name.string", "room_empty": "search_results[].room_name.too_short",
    "price_type": "search_results[].price.number", "price_low": "search_results[].price.exclusive_minimum",
    "currency_type": "search_results[].currency.string", "currency_form": "search_results[].currency.pattern",
}
BUSINESS_CODES = {
    "arrival": "arrival_date.date", "departure": "departure_date.date", "timestamp": "timestamp.datetime",
    "order": "departure_date.after_arrival", "nights": "length_of_stay.nights", "country": "user_country.known",
    "currency": "search_results[].currency.known",
}


def rule_codes() -> list[str]:
    """Every rule's code."""
    codes = [CODE_NOT_JSON, CODE_NOT_OBJECT, *(r.code for r in field_rules()), *ITEM_CODES.values(), *BUSINESS_CODES.values()]
    return list(dict.fromkeys(codes))


def fact_columns(v: Column) -> list[Column]:
    """Per-field facts read once from the event VARIANT, for the fields of all contract versions."""
    cols = [F.when(J.is_object(v), F.lit("OBJECT")).alias("_k_root")]
    for f in dict.fromkeys(_fields("required") + _fields("strings")):
        cols.append(_kind(J.node(v, f)).alias(f"_k_{f}"))
    for f in _fields("integers") + _fields("numbers"):
        cols.append(J.number(v, f).alias(f"_n_{f}"))
    for f in _fields("strings"):
        cols.append(J.text(v, f).alias(f"_s_{f}"))
    items = F.try_variant_get(v, "$.search_results", "array<variant>")
    cols.append(F.transform(items, lambda x: F.struct(
        _kind(x).alias("kind"),
        _kind(J.node(x, "room_name")).alias("rk"), J.text(x, "room_name").alias("rs"),
        _kind(J.node(x, "price")).alias("pk"), J.number(x, "price").alias("pn"),
        _kind(J.node(x, "currency")).alias("ck"), J.text(x, "currency").alias("cs"),
    )).alias("_items"))
    return cols


def error(path, code, message) -> Column:
    """One ``(path, code, message)``."""
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    return F.struct(lit(path).alias("path"), lit(code).alias("code"), lit(message).alias("message"))


def no_errors() -> Column:
    return F.array().cast(ERRORS)


def error_texts(errors: Column | str) -> Column:
    """The errors as ``path: message`` texts."""
    return F.transform(errors, lambda e: F.concat(e["path"], F.lit(": "), e["message"]))


def _err(sort_key, path, code, message, cond: Column) -> Column:
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    return F.when(cond, F.struct(lit(sort_key).alias("k"), lit(path).alias("path"), lit(message).alias("message"),
                                 lit(code).alias("code")))


def _is_int(f: str) -> Column:
    return (_c("k", f) == "NUMBER") & J.is_integral(_c("n", f))


def _item_rules(x: Column, i: Column) -> Column:
    """The rules of an item, built only for one that breaks any."""
    return F.when(F.coalesce(_item_holds(x), F.lit(False)), F.array()).otherwise(_item_errors(x, i))


def _item_errors(x: Column, i: Column) -> Column:
    base = F.concat(F.lit("search_results."), i.cast("string"))
    key = F.concat(F.lit("search_results."), F.lpad(i.cast("string"), 10, "0"))
    is_obj = x["kind"] == "OBJECT"
    rules = [_err(key, base, ITEM_CODES["object"], MSG_NOT_OBJECT, ~is_obj)]
    for f, kf in zip(R.RESULT_ITEM_FIELDS, ["rk", "pk", "ck"]):
        rules.append(_err(key, base, ITEM_CODES[f], MSG_REQUIRED.format(field=f), is_obj & x[kf].isNull()))
    sub = {f: (F.concat(key, F.lit("." + f)), F.concat(base, F.lit("." + f))) for f in R.RESULT_ITEM_FIELDS}
    room, price, currency = (sub[f] for f in ("room_name", "price", "currency"))
    rules += [
        _err(*room, ITEM_CODES["room_type"], MSG_TYPE.format(type="string"), is_obj & x["rk"].isNotNull() & (x["rk"] != "STRING")),
        _err(*room, ITEM_CODES["room_empty"], MSG_TOO_SHORT, is_obj & (x["rk"] == "STRING") & (F.char_length(x["rs"]) < 1)),
        _err(*price, ITEM_CODES["price_type"], MSG_TYPE.format(type="number"), is_obj & x["pk"].isNotNull() & (x["pk"] != "NUMBER")),
        _err(*price, ITEM_CODES["price_low"], MSG_EXCL_MIN, is_obj & (x["pk"] == "NUMBER") & (x["pn"] <= 0)),
        _err(*currency, ITEM_CODES["currency_type"], MSG_TYPE.format(type="string"),
             is_obj & x["ck"].isNotNull() & (x["ck"] != "STRING")),
        _err(*currency, ITEM_CODES["currency_form"], MSG_PATTERN.format(pattern=R.CURRENCY_PATTERN),
             is_obj & (x["ck"] == "STRING") & ~x["cs"].rlike(R.CURRENCY_PATTERN)),
    ]
    return F.array(*rules)


def _item_holds(x: Column) -> Column:
    """True for an item that breaks none of ``_item_rules``; other items are left to those."""
    return ((x["kind"] == "OBJECT") & (x["rk"] == "STRING") & (F.char_length(x["rs"]) >= 1)
            & (x["pk"] == "NUMBER") & (x["pn"] > 0) & (x["ck"] == "STRING") & x["cs"].rlike(R.CURRENCY_PATTERN))


def _broken(rule: FieldRule) -> Column:
    """The condition under which a field rule is broken."""
    f, kind = rule.field, _c("k", rule.field)
    if rule.check == "required":
        return kind.isNull()
    if rule.check == "integer":
        return kind.isNotNull() & ~_is_int(f)
    if rule.check in ("string", "number", "array"):
        return kind.isNotNull() & (kind != rule.check.upper())
    if rule.check in ("minimum", "maximum"):
        typed = _is_int(f) if f in _fields("integers") else (kind == "NUMBER")
        return typed & (_c("n", f) < rule.bound if rule.check == "minimum" else _c("n", f) > rule.bound)
    if rule.check == "empty":
        return (kind == "ARRAY") & (F.size("_items") == 0)
    length = F.char_length(_c("s", f))
    return (kind == "STRING") & (length < rule.bound if rule.check == "too_short" else length > rule.bound)


def contract_errors(version: Column | None = None) -> Column:
    """Stage 1 (JSON contract of the event's ``version``) over the fact columns, ordered by path."""
    version = F.lit(R.SCHEMA_VERSION) if version is None else version
    rules, broken = [], F.lit(False)
    for r in field_rules():
        held = _broken(r) if set(r.versions) == set(R.CONTRACTS) else version.isin(*r.versions) & _broken(r)
        rules.append(_err("" if r.check == "required" else r.path, r.path, r.code, r.message, held))
        broken = broken | held
    items = F.coalesce(F.col("_items"), F.array().cast(f"array<{_ITEM}>"))
    all_errs = F.concat(F.array(*rules), F.flatten(F.transform(items, _item_rules)))   # V12-V15
    ordered = F.filter(F.sort_array(all_errs), lambda e: e.isNotNull())
    # the lists of errors are built only for the events that have any
    clean = ~F.coalesce(broken, F.lit(False)) & F.forall(items, lambda x: F.coalesce(_item_holds(x), F.lit(False)))
    return F.when(_c("k", "root") == "OBJECT", F.when(clean, no_errors()).otherwise(
                F.transform(ordered, lambda e: error(e["path"], e["code"], e["message"])))) \
            .otherwise(F.array(error("root", CODE_NOT_OBJECT, MSG_NOT_OBJECT)))


def python_strip(s: Column) -> Column:
    """Trim all leading/trailing whitespace (not only spaces)."""
    return F.regexp_replace(s, r"^\s+|\s+$", "")


def stay_columns() -> list[Column]:
    """What the business rules read, from the fact columns."""
    return [strict_date(_c("s", "arrival_date")).alias("_d_arrival"), strict_date(_c("s", "departure_date")).alias("_d_departure"),
            strict_timestamp(_c("s", "timestamp")).alias("_t_timestamp"),
            F.lower(python_strip(_c("s", "user_country"))).alias("_l_country")]


def business_errors(known_countries=None, currencies=None) -> Column:
    """Stage 2 (business rules V17-V24) over the fact and ``stay_columns``, in rule order; meaningful once stage 1 passed."""
    known_countries = known_countries or R.KNOWN_COUNTRIES
    currencies = currencies or R.VALID_CURRENCIES
    a, d, t = F.col("_d_arrival"), F.col("_d_departure"), F.col("_t_timestamp")
    los = _c("n", "length_of_stay").cast("int")
    nights = F.datediff(d, a)
    country = _c("s", "user_country")
    both = a.isNotNull() & d.isNotNull()
    rule = lambda name, path, message: error(path, BUSINESS_CODES[name], message)
    rules = F.array(
        F.when(a.isNull(), rule("arrival", "arrival_date", MSG_BAD_DATE)),                          # V17
        F.when(d.isNull(), rule("departure", "departure_date", MSG_BAD_DATE)),
        F.when(t.isNull(), rule("timestamp", "timestamp", MSG_BAD_DATETIME)),                        # V18
        F.when(both & (d <= a), rule("order", "departure_date", MSG_DEP_AFTER)),                     # V19
        F.when(both & (d > a) & (los != nights),                                                     # V20
               rule("nights", "length_of_stay", F.format_string(MSG_LOS, nights, los))),
        F.when(~F.col("_l_country").isin(*known_countries),                                          # V22
               rule("country", "user_country", F.format_string(MSG_COUNTRY, country))),
    )
    cur = F.transform(F.col("_items"), lambda x, i: F.when(                                          # V24
        ~x["cs"].isin(*currencies),
        rule("currency", F.format_string("search_results[%d].currency", i), F.format_string(MSG_CURRENCY, x["cs"]))))
    # an event that keeps them all; the lists of errors are built only for others
    clean = (both & t.isNotNull() & (d > a) & (los == nights) & F.col("_l_country").isin(*known_countries)
             & F.forall("_items", lambda x: x["cs"].isin(*currencies)))
    return F.when(clean, no_errors()).otherwise(F.filter(F.concat(rules, cur), lambda e: e.isNotNull()))


def with_errors(df: DataFrame, variant_col: str = "_v", out: str = "errors",
                stage_out: str | None = None, known_countries=None, currencies=None) -> DataFrame:
    """Adds ``errors`` (path, code, message) computed from a VARIANT column (NULL = not JSON).

    An event is checked against the contract that its ``schema_version`` column names (absent: v1).
    Stage-1 and stage-2 errors are each produced by a one-row ``inline`` (a
    Generate node). Filters on ``errors`` (or on columns derived from it)
    cannot be pushed below a Generate, so the optimizer never substitutes the
    rule trees into them and every rule runs at most once per event.
    ``stage_out`` optionally names a column saying which stage failed
    (``parse``, ``contract``, ``business``; NULL when valid).
    """
    keep = list(df.columns)
    version = F.coalesce(F.col("schema_version"), F.lit(R.SCHEMA_VERSION)) if "schema_version" in keep else None
    facts = df.select("*", *fact_columns(F.col(variant_col)))
    s1 = J.evaluated(facts, {"_stage1": contract_errors(version)}).select("*", *stay_columns())
    v_null = F.col(variant_col).isNull()
    has1 = F.size("_stage1") > 0
    # Stage 2 only runs for parsed events that passed stage 1, in its own Generate.
    s2 = J.evaluated(s1, {"_stage2": F.when(v_null | has1, no_errors()).otherwise(business_errors(known_countries, currencies))})
    errors = (F.when(v_null, F.array(error("root", CODE_NOT_JSON, MSG_INVALID_JSON)))
              .when(has1, F.col("_stage1")).otherwise(F.col("_stage2")))
    cols = [errors.alias(out)]
    if stage_out:
        cols.append(F.when(v_null, "parse").when(has1, "contract")
                    .when(F.size("_stage2") > 0, "business").alias(stage_out))
    return s2.select(*keep, *cols)


def validate(raw: DataFrame, text_col: str = "value") -> DataFrame:
    """Adds ``errors`` and ``is_valid`` to a frame of raw JSON text."""
    parsed = J.with_parsed(raw, text_col)
    return (with_errors(parsed, stage_out="failed_stage").drop("_v")
            .withColumn("is_valid", F.size("errors") == 0))


def rejections_by_code(validated: DataFrame) -> DataFrame:
    """Errors of every rule (0 where none) with their share of all validated events (SLI < 0.5 %).

    One pass: ``posexplode_outer`` yields one row per error and one marker row
    (position 0 or NULL) per event, so the event total is summed from the
    per-rule aggregate with a window over that small result.
    """
    rows = validated.select(F.posexplode_outer("errors.code").alias("pos", "code"))
    per_rule = (rows.groupBy("code")
                .agg(F.count("code").alias("error_count"),
                     F.count_if(F.coalesce(F.col("pos") == 0, F.lit(True))).alias("_events")))
    total = F.sum("_events").over(Window.partitionBy())
    pct = F.round(F.col("error_count").cast("double") * 100.0 / total, 2)
    every = R.relation(validated.sparkSession, [(c,) for c in rule_codes()], [("code", "STRING")])
    return (every.join(per_rule.withColumn("pct_of_events", pct), "code", "left")
            .select("code", F.coalesce("error_count", F.lit(0)).alias("error_count"),
                    F.coalesce("pct_of_events", F.lit(0.0)).alias("pct_of_events")))

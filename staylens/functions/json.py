"""JSON field access over a VARIANT column parsed once per row.

``try_parse_json`` turns the raw text into VARIANT a single time; every field is
then read with ``try_variant_get`` (no repeated text parsing, stays in codegen).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def parse(text: Column | str) -> Column:
    """VARIANT of the text, NULL when it is not JSON."""
    return F.try_parse_json(F.col(text) if isinstance(text, str) else text)


def path_of(field: str) -> str:
    return field if field.startswith("$") else f"$.{field}"


def node(v: Column, field: str) -> Column:
    return F.try_variant_get(v, path_of(field), "variant")


# First letters of the types that JSON values have as VARIANT -> their JSON kind.
_KINDS = {"STR": "STRING", "BOO": "BOOLEAN", "VOI": "NULL", "ARR": "ARRAY", "OBJ": "OBJECT",
          "BIG": "NUMBER", "DEC": "NUMBER", "DOU": "NUMBER", "FLO": "NUMBER"}


def kind(v: Column) -> Column:
    """JSON kind of a VARIANT: OBJECT, ARRAY, STRING, NUMBER, BOOLEAN, NULL; NULL if absent.

    One look at the VARIANT and one in a constant map. The type of a container is rendered
    whole: ask ``is_object`` of a whole document instead.
    """
    kinds = F.create_map(*[F.lit(x) for kv in _KINDS.items() for x in kv])
    return F.try_element_at(kinds, F.left(F.schema_of_variant(v), F.lit(3)))


def is_object(v: Column) -> Column:
    """True for a JSON object, without rendering its type."""
    return F.try_variant_get(v, "$", "map<string,variant>").isNotNull()


def text(v: Column, field: str) -> Column:
    """Scalar as text (strings unquoted, numbers in their JSON spelling); NULL for null/absent."""
    return F.try_variant_get(v, path_of(field), "string")


def number(v: Column, field: str) -> Column:
    return F.try_variant_get(v, path_of(field), "double")


def integer(v: Column, field: str) -> Column:
    """Integral value as INT: 4, 4.0 and "4" give 4; 4.5, text and overflow give NULL."""
    d = number(v, field)
    return F.when((d == F.floor(d)) & d.between(-2147483648, 2147483647), d.cast("int"))


def is_integral(d: Column) -> Column:
    return d == F.floor(d)


def with_parsed(df: DataFrame, text_col: str, out: str = "_v") -> DataFrame:
    """Adds the VARIANT of ``text_col``, parsed exactly once per row.

    The VARIANT is handed on by a one-row ``inline`` (a Generate node). Predicates
    on columns derived from it are then evaluated above the Generate instead of
    being rewritten into the scan with the parse substituted at every
    reference, which would re-parse the text many times per row and blow the
    generated code past the 64 KB method limit.
    """
    return evaluated(df, {out: parse(text_col)})


def evaluated(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds columns that are computed once a row, however often and wherever they are used later.

    They are computed in a projection of their own (generated code) and only handed on by a
    one-row ``inline``, through which the optimizer substitutes nothing.
    """
    keep = [c for c in df.columns if c not in columns]
    made = df.select(*keep, *[c.alias(f"_made_{name}") for name, c in columns.items()])
    return made.select(*keep, F.inline(F.array(F.struct(*[F.col(f"_made_{name}").alias(name) for name in columns]))))

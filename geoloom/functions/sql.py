"""Scalar functions by name for SQL: temporary functions of the session, made of expressions that Catalyst inlines."""

from __future__ import annotations

from pyspark.sql import SparkSession

from geoloom.functions.cells import FULL_3, SHORT_3_MASK, SHORT_3_SHIFT, SHORT_6_MASK, SHORT_6_SHIFT

GRAMS = """array_distinct(flatten(transform(filter(split(lower({x}), '[^a-z0-9]+'), w -> w <> ''),
  w -> transform(sequence(1, length(w) + 1), i -> substr(concat('  ', w, ' '), i, 3)))))"""

#: Signature, result type and body of each function.
FUNCTIONS = {
    "to_short_h3_3(x BIGINT)": ("INT", f"CAST(shiftright(x & {SHORT_3_MASK}L, {SHORT_3_SHIFT}) AS INT)"),
    "to_short_h3_6(x BIGINT)": ("INT", f"CAST(shiftright(x & {SHORT_6_MASK}L, {SHORT_6_SHIFT}) AS INT)"),
    "to_full_from_short_h3_3(s INT)": ("BIGINT", f"shiftleft(CAST(s AS BIGINT) & 65535L, {SHORT_3_SHIFT}) | {FULL_3}L"),
    "try_cast_to_int(t STRING)": ("INT", "CAST(rint(try_cast(t AS DOUBLE)) AS INT)"),
    "split_street_housenumber(a STRING)": (
        "ARRAY<STRING>",
        "CASE WHEN NOT trim(a) RLIKE '^[0-9]' THEN array(CASE WHEN regexp_extract(trim(a), '[0-9].*$', 0) = '' THEN trim(a) ELSE replace(trim(a), regexp_extract(trim(a), '[0-9].*$', 0), '') END, regexp_extract(trim(a), '[0-9].*$', 0)) END",
    ),
    "jsonb_array_int_array(j STRING)": ("ARRAY<INT>", "from_json(j, 'array<int>')"),
    "get_id_for_max_val(vals ARRAY<DOUBLE>, ids ARRAY<BIGINT>)": ("BIGINT", "element_at(ids, CAST(array_position(vals, array_max(vals)) AS INT))"),
    "similarity(a STRING, b STRING)": (
        "DOUBLE",
        f"coalesce(try_divide(size(array_intersect({GRAMS.format(x='a')}, {GRAMS.format(x='b')})), size(array_union({GRAMS.format(x='a')}, {GRAMS.format(x='b')}))), 0D)",
    ),
    "mercator_x(lon DOUBLE)": ("DOUBLE", "6378137D * radians(lon)"),
    "mercator_y(lat DOUBLE)": ("DOUBLE", "6378137D * ln(tan(pi() / 4 + radians(lat) / 2))"),
    "storeys(height DOUBLE)": ("INT", "CAST(CASE WHEN height > 3.5 THEN floor(height / 3.5) ELSE 1 END AS INT)"),
    "reconcile_classes(a INT, b INT)": ("INT", "CASE WHEN a = b THEN a WHEN a IN (0, 2) AND b = 1 THEN 1 WHEN a = 1 AND b IN (0, 2) THEN 1 ELSE 0 END"),
}


def register_all(spark: SparkSession) -> list[str]:
    """Make every function known to the session's SQL; returns their names."""
    for signature, (kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {kind} RETURN {body}")
    return [s.partition("(")[0] for s in FUNCTIONS]

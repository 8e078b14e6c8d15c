"""Registered SQL functions on values worked out by hand."""

import pytest

from geoloom.functions.sql import register_all


def test_sql_functions(spark):
    names = register_all(spark)
    assert len(names) == len(set(names))
    row = spark.sql("""
        SELECT to_short_h3_3(590112357393367039), to_full_from_short_h3_3(2048), try_cast_to_int('12.5'), try_cast_to_int('abc'),
               split_street_housenumber('Main St 12a'), jsonb_array_int_array('[1,2]'), get_id_for_max_val(array(300D, 10D, 30000D), array(33L, 12L, 88L)),
               similarity('word', 'two words'), similarity('', 'x'), mercator_x(11.333D), storeys(10D), reconcile_classes(2, 1), to_short_h3_6(4503599610593280)
    """).first()
    assert row[0] == 2048 and row[1] == 590112357393367039 and row[2] == 12 and row[3] is None
    assert row[4] == ["Main St ", "12a"] and row[5] == [1, 2] and row[6] == 88
    assert row[7] == pytest.approx(4 / 11) and row[8] == 0 and row[9] == pytest.approx(1261583.78916) and row[10] == 2 and row[11] == 1
    assert row[12] == 268435455

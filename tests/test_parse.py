from pyspark.sql import functions as F

from millrace.functions import parse


def test_days_times_numbers_and_epochs(spark):
    day = lambda x: spark.range(1).select(parse.parse_day(F.lit(x).cast("string")).cast("string")).first()[0]
    assert [day(x) for x in ("2013-01-05", "20130105", "2013/01/05", "05-Jan-2013", "2014-01-05T00:00:00", " 2013-01-05 ")] == ["2013-01-05"] * 4 + ["2014-01-05", "2013-01-05"]
    assert [day(x) for x in ("0000-00-00", "-", "", None, "2013-13-01", "30-Foo-2013")] == [None] * 6
    assert [day(x) for x in ("2013/01/05 10:00", "20130105T1", "2013-01/05", "5-JAN-2013")] == ["2013-01-05"] * 4
    assert [day(x) for x in ("2013-01-05x", "+013-01-05", "2013-1-05", "201301051", "2013/01/5")] == [None] * 5
    second = lambda x: spark.range(1).select(parse.parse_second_of_day(F.lit(x).cast("string"))).first()[0]
    assert [second(x) for x in ("01:02:03", "010203", "1:02:03 AM", "01:02:03.987", "1:02:03 PM", "12:00:00 AM", "12:00:00 PM")] == [3723] * 4 + [46923, 0, 43200]
    assert [second(x) for x in ("25:61:00", "24:00:00", "13:00:00 PM", "", None, "noon")] == [None] * 6
    assert [second(x) for x in ("01:60:00", "+1:02:03", "1:2:3", "0102", "010260")] == [None] * 5
    number = lambda x: spark.range(1).select(parse.parse_number(F.lit(x).cast("string"))).first()[0]
    assert [number(x) for x in (" 1,234.50", "1.2345e+03", "NULL", "", None, "x")] == [1234.5, 1234.5, None, None, None, None]
    r = spark.range(1).select(parse.epoch_millis(F.lit(1357009587)), parse.epoch_millis(F.lit(1357009587000)), parse.epoch_millis(F.lit(1357009587000000)), parse.iso_millis(F.lit("2013-01-01T11:06:27+08:00")), parse.iso_millis(F.lit("2013-01-01T03:06:27Z")), parse.iso_millis(F.lit("soon"))).first()
    assert list(r) == [1357009587000] * 5 + [None]

"""Queries of the general training-data operators (sessions, entity features, rolling totals) and their SQL."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.parse import clean_text, parse_day, parse_number, parse_second_of_day
from millrace.operators.features import entity_features, features_at, kind_report
from millrace.operators.orders import AMOUNT_PARTS, clean_orders
from millrace.operators.rolling import rolling_totals, trailing_at
from millrace.operators.sessions import sessionize
from millrace.plans.tables import table

IDLE_SECONDS = 1800
AS_OF = 16_251  # 2014-06-30, the last day of the orders
#: The shop paths of the orders, by the rule they are named by.
SHOP_PATHS = [f"st{s:02d}^b{b:02d}^{c}" for s, b, c in product(range(1, 7), range(1, 9), ("bags", "home", "shoes", "tea", "toys"))]
TOLERANCE = 0.01 + 1e-9


def _sessions(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "userlog_ec")
    second = F.unix_date(parse_day(F.col("dates"))).cast("bigint") * 86_400 + parse_second_of_day(F.col("time"))
    s = sessionize(rows, F.lower(clean_text(F.col("eruid"))), second, IDLE_SECONDS, once=rows.columns)
    stamp = lambda c: F.date_format(F.timestamp_seconds(c), "yyyy-MM-dd HH:mm:ss")
    return s.select(F.col("entity").alias("eruid"), stamp("start_second").alias("start_at"), stamp("end_second").alias("end_at"), F.col("n_rows").cast("bigint"), "duration")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _sessions(spark, d).select("eruid", "start_at", "end_at", "n_rows")


def p2_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Sessions with their duration in seconds."""
    return _sessions(spark, d).select("eruid", "start_at", "end_at", F.col("duration").cast("bigint").alias("duration"), "n_rows")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    stored = table(spark, d, "lrfm").select("cal_date", "shop_id", "member_id", "r", "f", "m").distinct()
    probes = stored.withColumns({"as_of": F.unix_date(parse_day(F.col("cal_date"))), "who": F.trim("member_id"), "path": F.trim("shop_id")})
    orders = clean_orders(table(spark, d, "data_prepare_member")).select(F.col("member_id").alias("who"), F.col("shop_id").alias("path"), F.col("day").alias("as_of"), "amount_parts")
    got = features_at(orders, probes, "who", "path", "as_of", "amount_parts", "as_of")
    r, f, m = F.col("payload.r"), F.col("payload.f"), F.col("payload.m")
    off = ~r.eqNullSafe(F.col("recency").cast("double")) | ~f.eqNullSafe(F.col("frequency").cast("double")) | F.coalesce(F.abs(m - F.col("total") / AMOUNT_PARTS) > TOLERANCE, F.lit(True))
    return got.where(off).select("payload.cal_date", "payload.shop_id", "payload.member_id").distinct()


def p4_features(spark: SparkSession, d: str, kinds: Sequence[str] | None = SHOP_PATHS, as_of: int | None = AS_OF) -> DataFrame:
    """R, F and M of every member for each of ``kinds`` (the 240 shop paths; None: those of the orders) as of a day (2014-06-30; None: the orders' last)."""
    orders = clean_orders(table(spark, d, "data_prepare_member"))
    wide = entity_features(orders, "member_id", "shop_id", "day", "amount_parts", kinds, as_of, AMOUNT_PARTS)
    return wide.select(F.col("entity").alias("member_id"), *[F.round(c, 4).alias(c) if c[0] == "m" else F.col(c) for c in wide.columns[1:]])


def p4_kinds(spark: SparkSession, d: str, kinds: Sequence[str] = SHOP_PATHS) -> DataFrame:
    """Every shop path of the orders, if the feature table has it, with its members and orders."""
    return kind_report(clean_orders(table(spark, d, "data_prepare_member")), "member_id", "shop_id", kinds)


def _daily_orders(spark: SparkSession, d: str) -> DataFrame:
    return clean_orders(table(spark, d, "data_prepare_member")).select("member_id", "day", "amount_parts")


PERIODS = {"L7D": 7, "L30D": 30}


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    stored = table(spark, d, "ta_raw").select("caldate", "periodtype", "member_id", *[parse_number(F.col(f"value{i}")).alias(f"v{i}") for i in (1, 2, 3)]).dropna().where(F.col("periodtype").isin(*PERIODS))
    stored = stored.withColumns({"day": F.unix_date(parse_day(F.col("caldate"))), "who": F.trim("member_id")})
    orders = _daily_orders(spark, d).withColumnRenamed("member_id", "who")
    got = trailing_at(orders, stored, "who", "day", "amount_parts", list(PERIODS.values()))
    off = F.lit(False)
    for name, width in PERIODS.items():
        total = F.col(f"total_{width}") / AMOUNT_PARTS
        wrong = (F.abs(F.col("payload.v1") - total) > TOLERANCE) | (F.abs(F.col("payload.v2") - total / width) > TOLERANCE) | (F.col("payload.v3") != F.col(f"n_{width}"))
        off |= (F.col("payload.periodtype") == name) & wrong
    return got.where(off).select("payload.member_id", "payload.caldate", "payload.periodtype").distinct()


def p7_rolling(spark: SparkSession, d: str) -> DataFrame:
    """Totals and averages over the last 7 and 30 days for every member and day from the first order on."""
    got = rolling_totals(_daily_orders(spark, d), "member_id", "day", "amount_parts", list(PERIODS.values()), parts=AMOUNT_PARTS)
    return got.select(F.col("entity").alias("member_id"), F.date_format(F.date_from_unix_date("day"), "yyyy-MM-dd").alias("caldate"), F.col("width").cast("bigint").alias("width"), F.round("total", 4).alias("total"), F.round("average", 4).alias("average"), F.col("n").cast("bigint").alias("n"))


QUERIES = {"p2_found": p2_found, "p2_sessions": p2_sessions, "p4_found": p4_found, "p4_features": p4_features, "p4_kinds": p4_kinds, "p7_found": p7_found, "p7_rolling": p7_rolling}

_DAY = """coalesce(try_strptime(case when regexp_matches(trim({c}), '^\\d{{4}}[-/]?\\d{{2}}[-/]?\\d{{2}}([T ].*)?$') then substr(regexp_replace(substr(trim({c}), 1, 10), '[-/]', '', 'g'), 1, 8) end, '%Y%m%d'),
 try_strptime(case when regexp_matches(trim({c}), '^\\d{{1,2}}-[A-Za-z]{{3}}-\\d{{4}}$') then trim({c}) end, '%d-%b-%Y'))::date"""

_ORDERS = f"""orders_clean as (
 select so_id, min(s) as s from (
  select so_id, {{'shop_id': trim(shop_id), 'member_id': trim(member_id), 'day': {_DAY.format(c='so_date')}, 'amount': cast(round(amount * 10000) as bigint)}} as s
  from data_prepare_member
  where so_id is not null and lower(trim(shop_id)) not in ('', '-', '-999', 'null') and not trim(shop_id) like '%^-999' and lower(trim(member_id)) not in ('', '-', '-999', 'null') and amount is not null and amount <> -999 and {_DAY.format(c='so_date')} is not null)
 group by so_id),
 o as (select so_id, s.shop_id as shop_id, s.member_id as member_id, s.day as day, s.amount as amount from orders_clean)"""

_SESSIONS = f"""with r as (select distinct * from userlog_ec), p as (
 select lower(trim(eruid)) as eruid, {_DAY.format(c='dates')} as d, regexp_extract(upper(trim(time)), '^(\\d{{1,2}}):?(\\d{{2}}):?(\\d{{2}})(?:\\.\\d+)?\\s*([AP]M)?$', ['h', 'm', 's', 'half']) as x from r
 where lower(trim(eruid)) not in ('', '-', '-999', 'null')),
 q as (select eruid, d, case when x.half = '' then try_cast(x.h as int) when try_cast(x.h as int) between 1 and 12 then try_cast(x.h as int) % 12 + case when x.half = 'PM' then 12 else 0 end end as h, try_cast(x.m as int) as m, try_cast(x.s as int) as s from p where d is not null),
 t as (select eruid, epoch(d)::bigint + h * 3600 + m * 60 + s as t from q where h < 24 and m < 60 and s < 60),
 f as (select *, case when t - lag(t) over (partition by eruid order by t) <= {IDLE_SECONDS} then 0 else 1 end as fresh from t),
 g as (select *, sum(fresh) over (partition by eruid order by t rows unbounded preceding) as nr from f)
 select eruid, strftime(make_timestamp(min(t) * 1000000), '%Y-%m-%d %H:%M:%S') as start_at, strftime(make_timestamp(max(t) * 1000000), '%Y-%m-%d %H:%M:%S') as end_at@MORE@, count(*)::bigint as n_rows from g group by eruid, nr"""

_NUMBER = "try_cast(replace(case when lower(trim({c})) not in ('', '-', '-999', 'null') then trim({c}) end, ',', '') as double)"


def _rolling_sql() -> str:
    part = lambda w: f"""select m.member_id, strftime(m.day, '%Y-%m-%d') as caldate, {w}::bigint as width, round(sum(coalesce(a, 0)) over win / 10000, 4) as total, round(sum(coalesce(a, 0)) over win / 10000 / {w}, 4) as average, (sum(coalesce(n, 0)) over win)::bigint as n
 from cal m left join daily using (member_id, day) window win as (partition by m.member_id order by m.day rows between {w - 1} preceding and current row)"""  # noqa: E731
    return f"""with {_ORDERS}, daily as (select member_id, day, sum(amount)::bigint as a, count(*) as n from o group by all),
 cal as (select member_id, unnest(generate_series(min(day), (select max(day) from o), interval 1 day))::date as day from o group by member_id)
 {part(7)} union all {part(30)}"""


def _features_sql() -> str:
    cols = []
    for p in SHOP_PATHS:
        s, x = "".join(c if c.isalnum() else "_" for c in p), f"shop_id = '{p}'"
        cols += [f"(date '2014-06-30' - max(day) filter ({x}))::bigint as r_{s}", f"(count(*) filter ({x}))::bigint as f_{s}", f"round(coalesce(sum(amount) filter ({x}), 0) / 10000, 4) as m_{s}"]
    return f"with {_ORDERS} select member_id, {', '.join(cols)} from o where day <= date '2014-06-30' group by member_id"


SQL = {
    "p2_found": _SESSIONS.replace("@MORE@", ""),
    "p2_sessions": _SESSIONS.replace("@MORE@", ", (max(t) - min(t))::bigint as duration"),
    "p4_found": f"""with {_ORDERS}, l as (select distinct cal_date, shop_id, member_id, r, f, m from lrfm),
 x as (select l.cal_date, l.shop_id, l.member_id, l.r, l.f, l.m, cast(l.cal_date as date) - max(o.day) as r2, count(o.so_id) as f2, coalesce(sum(o.amount), 0) / 10000 as m2
  from l left join o on o.member_id = trim(l.member_id) and o.shop_id = trim(l.shop_id) and o.day <= cast(l.cal_date as date) group by 1, 2, 3, 4, 5, 6)
 select distinct cal_date, shop_id, member_id from x where r is distinct from r2 or f is distinct from f2 or coalesce(abs(m - m2) > {TOLERANCE!r}, true)""",
    "p4_features": _features_sql(),
    "p4_kinds": f"with {_ORDERS} select shop_id as kind, shop_id in ({', '.join(repr(x) for x in SHOP_PATHS)}) as listed, count(distinct member_id)::bigint as entities, count(*)::bigint as events from o group by shop_id",
    "p7_found": f"""with {_ORDERS}, t as (select distinct member_id, caldate, periodtype, {', '.join(f"{_NUMBER.format(c=f'value{i}')} as v{i}" for i in (1, 2, 3))} from ta_raw),
 u as (select *, case periodtype when 'L7D' then 7 when 'L30D' then 30 end as w, cast(caldate as date) as day from t where v1 is not null and v2 is not null and v3 is not null),
 x as (select u.*, coalesce(sum(o.amount), 0) / 10000 as total, count(o.so_id) as n from u left join o on o.member_id = trim(u.member_id) and o.day between u.day - (u.w - 1)::int and u.day group by all)
 select distinct member_id, caldate, periodtype from x where abs(v1 - total) > {TOLERANCE!r} or abs(v2 - total / w) > {TOLERANCE!r} or v3 <> n""",
    "p7_rolling": _rolling_sql(),
}

"""Column functions of the kinds analysts name: tokens, codes, dates, distances, arrays, losses. All stay in the JVM."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

EARTH_KM = 6378.137
#: Fixed value: the clip and epsilon of the log loss.
LOSS_EPSILON = 10e-12


def tokens(c: Column) -> Column:
    """Lower-case runs of letters, digits and underscores; no empty ones."""
    return F.filter(F.split(F.lower(c), "[^A-Za-z0-9_]+"), lambda x: x != "")


def remove_punctuation(c: Column) -> Column:
    """Lower case, letters, digits and blanks only, trimmed."""
    return F.trim(F.lower(F.regexp_replace(c, r"[^\sa-zA-Z0-9]", "")))


def remove_quotes(c: Column) -> Column:
    return F.translate(c, "\"'", "")


def keep_alphanumeric(c: Column, joined: str = " ") -> Column:
    """Runs of anything but letters and digits become ``joined``."""
    return F.regexp_replace(c, "[^A-Za-z0-9]+", joined)


def path_level(c: Column, level: int = 1, sep: str = "^") -> Column:
    """The ``level``-th part of a hierarchical key, empty if there is none."""
    return F.split_part(c, F.lit(sep), F.lit(level))


def path_prefixes(c: Column, sep: str = "^") -> Column:
    """Every prefix of a hierarchical key, shortest first: ``a^b^c`` gives ``a, a^b, a^b^c``."""
    parts = F.split(c, "\\" + sep)
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.concat_ws(sep, F.slice(parts, F.lit(1), i)))


def list_length(c: Column, sep: str = ",") -> Column:
    return F.size(F.split(c, sep))


def zero_padded(c: Column, width: int = 20, places: int = 4) -> Column:
    return F.format_string(f"%0{width}.{places}f", c.cast("double"))


def rotate_span(c: Column, left: int, right: int, times: int) -> Column:
    """The characters ``left..right`` (from 1) turned right ``times`` times."""
    size = right - left + 1
    k = times % size
    span = F.substring(c, left, size)
    return F.concat(F.substring(c, 1, left - 1), F.substring(span, size - k + 1, k), F.substring(span, 1, size - k), F.substring(c, right + 1, 1 << 30))


def query_string_map(c: Column, pairs: str = ";", kv: str = "=") -> Column:
    return F.str_to_map(c, F.lit(pairs), F.lit(kv))


def triples(c: Column, sep: str = ",") -> Column:
    """``item,qty,amt,item,qty,amt,...`` as an array of structs; an unfinished last triple is left out."""
    parts = F.split(c, sep)
    n = F.floor(F.size(parts) / 3).cast("int")
    at = lambda i, k: F.element_at(parts, (i * 3 + k).cast("int"))
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(at(i, 1).alias("item"), at(i, 2).try_cast("bigint").alias("qty"), at(i, 3).try_cast("double").alias("amt"))))


def apache_time(c: Column) -> Column:
    """``01/Aug/1995:00:00:01 -0400`` as a timestamp of the local clock; the zone is dropped."""
    return F.try_to_timestamp(F.substring(c, 1, 20), F.lit("dd/MMM/yyyy:HH:mm:ss")).cast("timestamp_ntz")


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a, b = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_KM * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def safe_divide(a: Column, b: Column) -> Column:
    """0 where the denominator is 0 or either is null."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def sigmoid(x: Column, clip: float = 20.0) -> Column:
    return 1 / (1 + F.exp(-F.least(F.greatest(x, F.lit(-clip)), F.lit(clip))))


def log_loss(p: Column, y: Column) -> Column:
    """Of one row, with the probability kept off 0 and 1 by an epsilon."""
    q = F.when(p == 0, p + LOSS_EPSILON).when(p == 1, p - LOSS_EPSILON).otherwise(p)
    return F.when(y == 1, -F.log(q)).otherwise(-F.log(1 - q))


def power_bucket(c: Column, top: int = 1024) -> Column:
    """The least power of two not below a count; -1 above ``top``."""
    return F.when(c > top, -1).otherwise(F.pow(F.lit(2.0), F.ceil(F.log2(c.cast("double"))))).cast("bigint")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def rescale(a: Column) -> Column:
    """``(x - mean) / mean`` of an array's elements."""
    mean = F.aggregate(a, F.lit(0.0), lambda s, x: s + x) / F.size(a)
    return F.transform(a, lambda x: F.try_divide(x - mean, mean))


def tile_sums(a: Column, tile: int) -> Column:
    """Element-wise sum of an array's consecutive tiles of length ``tile``."""
    n = F.floor(F.size(a) / tile).cast("int")
    return F.transform(F.sequence(F.lit(0), F.lit(tile - 1)), lambda i: F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0.0), lambda s, k: s + F.element_at(a, (k * tile + i + 1).cast("int"))))


def block_sums(a: Column, block: int) -> Column:
    """Sums of an array's consecutive blocks of length ``block``."""
    n = F.floor(F.size(a) / block).cast("int")
    return F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.aggregate(F.slice(a, (k * block + 1).cast("int"), F.lit(block)), F.lit(0.0), lambda s, x: s + x))


def array_std(a: Column) -> Column:
    """Population standard deviation of an array."""
    mean = F.aggregate(a, F.lit(0.0), lambda s, x: s + x) / F.size(a)
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + (x - mean) * (x - mean)) / F.size(a))


def two_way_interactions(a: Column) -> Column:
    """The elements, then the products of every pair of them (d + d * d)."""
    return F.concat(a, F.flatten(F.transform(a, lambda x: F.transform(a, lambda y: x * y))))


def gaussian_kernel(a: Column, b: Column, sigma: float) -> Column:
    return F.exp(-F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x) / (2 * sigma * sigma))


def normal_density(x: Column, mean: Column, variance: Column) -> Column:
    return F.exp(-F.pow(x - mean, 2) / (2 * variance)) / F.sqrt(2 * F.pi() * variance)


def congruential(seed: Column, a: int, b: int, m: int, steps: int) -> Column:
    """The first ``steps`` values of ``x' = (a x + b) mod m``."""
    start = F.struct(seed.cast("bigint").alias("x"), F.array().cast("array<bigint>").alias("out"))
    step = lambda s, _: F.struct(F.pmod(s["x"] * a + b, F.lit(m)).cast("bigint").alias("x"), F.concat(s["out"], F.array(F.pmod(s["x"] * a + b, F.lit(m)).cast("bigint"))).alias("out"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step, lambda s: s["out"])


def months_since(year: Column, month: Column, since_year: Column, since_month: Column) -> Column:
    return F.greatest((year - since_year) * 12 + (month - since_month), F.lit(0))


def promo_months(year: Column, week: Column, since_year: Column, since_week: Column) -> Column:
    """Months since a promotion began, four weeks to a month; 0 before it and where it has no start."""
    return F.greatest((year - since_year) * 12 + (week - since_week) / 4.0, F.lit(0.0))


def in_month_list(day: Column, months: Column) -> Column:
    """If a day's month is in a comma list of English abbreviations (``Sept`` for September)."""
    name = F.when(F.month(day) == 9, "Sept").otherwise(F.date_format(day, "MMM"))
    return F.array_contains(F.split(months, ","), name)


#: What marks each class of device in a user agent, tested in this order.
DEVICE_RULES = (("mobile", r"(?i)mobile|iphone|ipod|android.*mobile|blackberry|windows phone|pocket"), ("tablet", r"(?i)tablet|ipad|android|kindle"), ("touch", r"(?i)touch"), ("pc", r"(?i)windows nt|macintosh|x11|linux"), ("bot", r"(?i)bot|crawler|spider|slurp"))
BROWSER_RULES = (("Edge", r"(?i)edg(e|a|ios)?/"), ("Opera", r"(?i)opr/|opera"), ("Chrome", r"(?i)chrome/|crios"), ("Firefox", r"(?i)firefox/"), ("IE", r"(?i)msie |trident/"), ("Safari", r"(?i)safari/"))
OS_RULES = (("Android", r"(?i)android"), ("iOS", r"(?i)iphone|ipad|ipod"), ("Windows", r"(?i)windows"), ("Mac OS", r"(?i)mac os|macintosh"), ("Linux", r"(?i)linux|x11"))


def first_rule(c: Column, rules: tuple, other: str = "Others") -> Column:
    """The name of the first rule whose pattern is found; ``other`` if none or null."""
    return F.coalesce(*[F.when(c.rlike(p), F.lit(n)) for n, p in rules], F.lit(other))


def device_class(agent: Column) -> Column:
    return first_rule(agent, DEVICE_RULES)


def browser_family(agent: Column) -> Column:
    return first_rule(agent, BROWSER_RULES)


def os_family(agent: Column) -> Column:
    return first_rule(agent, OS_RULES)


def all_of(rules: dict) -> Column:
    """Conjunction of equalities; rules that are empty, null or say ``NULL`` are skipped."""
    used = [F.col(k) == v for k, v in rules.items() if v not in (None, "", "NULL")]
    return reduce(lambda a, b: a & b, used, F.lit(True))


def row_hashes(columns: Sequence[str]) -> list[Column]:
    """Two hashes of 64 bits that tell rows apart, also by which of their values are null."""
    own = [F.col(f"`{c}`") for c in columns]
    absent = [c.isNull() for c in own]
    return [F.xxhash64(*own, *absent), F.xxhash64(F.lit(1), *absent, *reversed(own))]


def parse_record(c: Column, fields: Sequence[str], sep: str = ",") -> Column:
    """A line of separated, perhaps quoted values as a struct of ``fields`` and ``status``: 1 for a record, 0 for a header (the fields' own names), -1 for anything else (then the fields are null)."""
    got = F.from_csv(c, ", ".join(f"`{f}` string" for f in [*fields, "_more"]), {"sep": sep, "mode": "PERMISSIVE"})
    whole = got[fields[-1]].isNotNull() & got["_more"].isNull()
    header = reduce(lambda a, b: a & b, [F.lower(F.trim(got[f])) == f.lower() for f in fields])
    status = F.when(F.coalesce(whole, F.lit(False)), F.when(header, 0).otherwise(1)).otherwise(-1)
    return F.struct(*[F.when(status == 1, got[f]).alias(f) for f in fields], status.alias("status"))


def pluralise(c: Column, ending: str = "s") -> Column:
    return F.concat(c, F.lit(ending))


def labelled(c: Column, labels: dict, other: object = None) -> Column:
    """A value's label by a small mapping; ``other`` where it has none."""
    return F.coalesce(F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])[c], F.lit(other))


def md5_bucket(c: Column, buckets: int) -> Column:
    """One of ``buckets`` by the first 60 bits of a text's MD5 sum."""
    return F.conv(F.substring(F.md5(c), 1, 15), 16, 10).cast("bigint") % buckets


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds from one timestamp to another, with fractions."""
    return (F.unix_micros(end) - F.unix_micros(start)) / 1e6


def polar(x: Column, y: Column) -> Column:
    """Length and angle (degrees, 0 to 360) of a point, and the angle as a colour of full saturation (red, green, blue from 0 to 1)."""
    angle = F.pmod(F.degrees(F.atan2(y, x)), F.lit(360.0))
    channel = lambda at: F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.abs(F.pmod(angle + at, F.lit(360.0)) / 60 - 3) - 1))
    return F.struct(F.sqrt(x * x + y * y).alias("length"), angle.alias("angle"), channel(0).alias("red"), channel(240).alias("green"), channel(120).alias("blue"))


@F.pandas_udf(T.StringType())
def escape_unicode(texts: pd.Series) -> pd.Series:
    """Characters beyond ASCII as backslash escapes."""
    return texts.map(lambda t: None if t is None else t.encode("unicode_escape").decode("ascii"))


@F.pandas_udf(T.StringType())
def unescape_unicode(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else t.encode("ascii").decode("unicode_escape"))

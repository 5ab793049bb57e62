"""Scalar types and conversions as column expressions; no Python functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_float32(col: Column | str) -> Column:
    return _c(col).cast("float")


def to_float64(col: Column | str) -> Column:
    return _c(col).cast("double")


def to_decimal32(col: Column | str, scale: int) -> Column:
    """Decimal with 9 digits, rounded half up."""
    return F.round(_c(col), scale).cast(f"decimal(9,{scale})")


def to_decimal64(col: Column | str, scale: int) -> Column:
    """Decimal with 18 digits, rounded half up."""
    return F.round(_c(col), scale).cast(f"decimal(18,{scale})")


def type_name(col: Column | str) -> Column:
    return F.typeof(_c(col))


def fixed_string(col: Column | str, length: int) -> Column:
    """NUL-padded to ``length`` bytes; longer input is an error."""
    c = _c(col)
    size = F.octet_length(c)
    padded = F.concat(c, F.repeat(F.chr(F.lit(0)), F.lit(length) - size))
    return F.when(size <= length, padded).when(
        size > length, F.raise_error(F.concat(F.lit(f"longer than {length} bytes: "), c)).cast("string")
    )


def fixed_string_equals(col: Column | str, literal: str, length: int) -> Column:
    return _c(col) == fixed_string(F.lit(literal.rstrip("\0")), length)


def new_uuid() -> Column:
    return F.uuid()


def to_date(col: Column | str) -> Column:
    """Date of a date or date-time string or of a timestamp."""
    return F.to_date(_c(col))


def now_and_today() -> tuple[Column, Column]:
    return F.current_timestamp(), F.current_date()


def date_time_in_zone(col: Column | str, zone: str) -> Column:
    """Point in time (UTC) of a wall-clock text in ``zone``."""
    return F.to_utc_timestamp(F.to_timestamp(_c(col)), zone)


def date_time64(col: Column | str, digits: int) -> Column:
    """Timestamp cut to ``digits`` (0..6) decimal places of a second."""
    unit = 10 ** (6 - digits)
    micros = F.unix_micros(_c(col).cast("timestamp"))
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(unit)))


class EnumType:
    """Labels with small integer codes; either form may be written, unknown ones are an error."""

    def __init__(self, labels: dict[str, int]):
        self.labels = labels

    def _map(self, pairs) -> Column:
        return F.create_map(*[F.lit(x) for p in pairs for x in p])

    def _checked(self, found: Column, given: Column) -> Column:
        error = F.raise_error(F.concat(F.lit("unknown enum value "), given.cast("string")))
        return F.when(given.isNull() | found.isNotNull(), found).otherwise(error.cast("string"))

    def code(self, label: Column | str) -> Column:
        c = _c(label)
        found = F.try_element_at(self._map(self.labels.items()), c)
        return self._checked(found.cast("string"), c).cast("tinyint")

    def label(self, code: Column | str) -> Column:
        c = _c(code).cast("int")
        found = F.try_element_at(self._map((v, k) for k, v in self.labels.items()), c)
        return self._checked(found, c)


BOOLEAN_ENUM = EnumType({"true": 1, "false": 0})


def or_default(col: Column | str, default) -> Column:
    """Value of a non-null column type: null becomes the default."""
    return F.coalesce(_c(col), F.lit(default))


def array_of(*cols: Column | str) -> Column:
    return F.array(*[_c(c) for c in cols])


def array_at(col: Column | str, index: int | Column) -> Column:
    """1-based element; negative counts from the end; null outside."""
    at = index if isinstance(index, Column) else F.lit(index)
    return F.try_element_at(_c(col), at)


def tuple_of(*cols: Column | str) -> Column:
    return F.struct(*[_c(c).alias(f"_{i}") for i, c in enumerate(cols, 1)])


def nested(**arrays: Column | str) -> Column:
    """Parallel arrays as one array of structs; unequal lengths are an error."""
    cols = {n: _c(a) for n, a in arrays.items()}
    sizes = [F.size(a) for a in cols.values()]
    same = F.lit(True)
    for s in sizes[1:]:
        same = same & (s == sizes[0])
    zipped = F.arrays_zip(*[a.alias(n) for n, a in cols.items()])
    kind = F.raise_error(F.lit("nested arrays differ in length"))
    return F.when(same, zipped).otherwise(kind)


def nested_field(col: Column | str, field: str) -> Column:
    return F.transform(_c(col), lambda x: x[field])


def ipv4_to_number(col: Column | str) -> Column:
    """Number of an IPv4 text of exactly four parts from 0 to 255; any other text is an error, null stays null."""
    c = _c(col)
    byte = "(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
    parts = F.transform(F.split(c, "\\."), lambda p: p.cast("long"))
    number = F.aggregate(parts, F.lit(0).cast("long"), lambda acc, p: acc * 256 + p)
    wrong = F.raise_error(F.concat(F.lit("not an IPv4 address: "), c)).cast("long")
    return F.when(c.isNull(), F.lit(None).cast("long")).when(c.rlike(f"^({byte}\\.){{3}}{byte}$"), number).otherwise(wrong)


def number_to_ipv4(col: Column | str) -> Column:
    c = _c(col).cast("long")
    octets = [F.pmod(F.shiftright(c, s), F.lit(256)).cast("string") for s in (24, 16, 8, 0)]
    return F.concat_ws(".", *octets)


def ipv6_to_hex(col: Column | str) -> Column:
    """32 hex digits of an IPv6 text of eight groups; ``::`` stands for one or more groups of zero. Any other text is an error, null stays null."""
    c = F.lower(_c(col))
    halves = F.split(c, "::")
    groups = lambda h: F.filter(F.split(h, ":"), lambda g: g != "")
    short = F.size(halves) == 2
    head, tail = groups(halves[0]), F.when(short, groups(F.get(halves, F.lit(1)))).otherwise(F.array().cast("array<string>"))
    missing = F.lit(8) - F.size(head) - F.size(tail)
    all_groups = F.concat(head, F.array_repeat(F.lit("0"), F.greatest(missing, F.lit(0))), tail)
    digits = F.array_join(F.transform(all_groups, lambda g: F.lpad(g, 4, "0")), "")
    part = "[0-9a-f]{1,4}(:[0-9a-f]{1,4})*"
    right = c.rlike(f"^(({part})?::({part})?|{part})$") & F.when(short, missing >= 1).otherwise(missing == 0)
    return F.when(c.isNull(), F.lit(None).cast("string")).when(right, digits).otherwise(F.raise_error(F.concat(F.lit("not an IPv6 address: "), c)))


def hex_to_ipv6(col: Column | str) -> Column:
    """Eight groups without leading zeros of 32 hex digits."""
    group = lambda i: F.regexp_replace(F.substring(_c(col), 4 * i + 1, 4), "^0{1,3}", "")
    return F.concat_ws(":", *[group(i) for i in range(8)])


def yyyymm(col: Column | str) -> Column:
    return F.date_format(_c(col), "yyyyMM").cast("int")


def minute_key(col: Column | str) -> Column:
    return F.date_format(_c(col), "yyyyMMddHHmm")


def case_match(cases: list[tuple[Column, Column | str]], default: Column | str | None = None) -> Column:
    """First matching case wins; without a default the rest is null."""
    lift = lambda v: v if isinstance(v, Column) else F.lit(v)
    out = None
    for condition, value in cases:
        out = F.when(condition, lift(value)) if out is None else out.when(condition, lift(value))
    return out if default is None else out.otherwise(lift(default))


# The texts of the matched cases.
IS_EXACT, IS_FALSE, IS_BIG, IS_INT = " ...is 88", "false...is false", "...is int, > 50", "...is int"
UNKNOWN_TYPE = "I don't know what type it is"


def match_variant(col: Column | str) -> Column:
    """Value, type and guard matching on a variant column.

    88 -> "88 ...is 88"; false -> "false...is false"; int above 50 -> "n...is int, > 50";
    other int -> "n...n...is int"; anything else -> a default sentence.
    """
    v = _c(col)
    kind = F.schema_of_variant(v)
    is_int = kind == "BIGINT"
    n = F.try_variant_get(v, "$", "bigint")
    text = n.cast("string")
    return case_match(
        [
            (is_int & (n == 88), F.concat(text, F.lit(IS_EXACT))),
            ((kind == "BOOLEAN") & ~F.try_variant_get(v, "$", "boolean"), IS_FALSE),
            (is_int & (n > 50), F.concat(text, F.lit(IS_BIG))),
            (is_int, F.concat(text, F.lit("..."), text, F.lit(IS_INT))),
        ],
        UNKNOWN_TYPE,
    )

"""Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns of exchange test instruments.
RESERVED_CODE = r"^(Z[A-Z]ZZ[TC](NX)?|ZXYZ(-[A-Z])?|ZBZX|ZTST|ZEXIT|ZIEXT)$"
TESTISH_CODE = r"^([A-Z]?TEST(-[A-Z]{1,2})?|TEST[A-Z])(_old)?$"
TEST_NAME = r"(?i)(NYSE|NASDAQ|NYSE ARCA|BATS|CBOE)\b.*TEST|LISTED TEST|TEST STOCK|TEST CONTROL|TEST INSTRUMENT|TE?ST SECURITY|TEST SYMBOL"


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def squash(x: str | Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.upper(_c(x)), "[^A-Z0-9]", ""), "OLD$", "")


def is_test_instrument(code: str | Column, name: str | Column) -> Column:
    """A reserved code, a name that an exchange wrote about its own tests, or a testish code whose name only repeats it."""
    code, name = F.coalesce(_c(code), F.lit("")), F.coalesce(_c(name), F.lit(""))
    return code.rlike(RESERVED_CODE) | name.rlike(TEST_NAME) | (code.rlike(TESTISH_CODE) & (squash(name) == squash(code)))


def to_double(x: str | Column) -> Column:
    return _c(x).try_cast("double")


def to_long(x: str | Column) -> Column:
    """Fractions are cut off; junk is null."""
    d = to_double(x)
    return F.when(d >= 0, F.floor(d)).otherwise(F.ceil(d)).cast("long")


def split_ratio(raw: str | Column) -> list[Column]:
    """split_to, split_from and ratio of '2.0/1.0': all null without a stroke, ratio null when a part is 0 or junk."""
    parts = F.split(_c(raw), "/")
    has = F.size(parts) > 1
    a, b = (F.when(has, F.get(parts, F.lit(k))).try_cast("double") for k in (0, 1))
    return [a.alias("split_to"), b.alias("split_from"), F.when((a != 0) & (b != 0), a / b).alias("ratio")]


def request_hash(params: dict[str, Column], secret: tuple[str, ...] = ("api_token",)) -> Column:
    """First 16 hex digits of the SHA-256 of the sorted parameters as JSON, without the secret ones."""
    named = F.struct(*(params[k].alias(k) for k in sorted(params) if k not in secret))
    return F.substring(F.sha2(F.to_json(named), 256), 1, 16)


def safe_key(x: str | Column) -> Column:
    return F.substring(F.regexp_replace(_c(x), "[^A-Za-z0-9._=-]+", "_"), 1, 180)


def payload_shape(body: str | Column) -> Column:
    """empty, non-json, list[n], dict:keys or value."""
    body = _c(body)
    keys, items = F.json_object_keys(body), F.json_array_length(body)
    plain = body.rlike(r'^\s*(-?[0-9.eE+-]+|true|false|null|".*")\s*$')
    return (
        F.when(body.isNull() | (F.trim(body) == ""), "empty").when(items.isNotNull(), F.concat(F.lit("list["), items.cast("string"), F.lit("]")))
        .when(keys.isNotNull(), F.concat(F.lit("dict:"), F.array_join(keys, ","))).when(plain, "value").otherwise("non-json")
    )

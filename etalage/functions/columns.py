"""Column functions used across the shop: ids, ages, money, value maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def id_number(c: str | Column, prefix: str) -> Column:
    """``PAY0000012`` -> 12; null when what is left of the text is no number."""
    return F.replace(_col(c), F.lit(prefix), F.lit("")).try_cast("bigint")


def zero_pad(c: str | Column, width: int) -> Column:
    """At least ``width`` digits; longer numbers stay whole (lpad alone would cut them)."""
    text = _col(c).cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def id_text(prefix: str, c: str | Column, width: int) -> Column:
    """12 -> ``PAY0000012``."""
    return F.concat(F.lit(prefix), zero_pad(c, width))


def money(c: str | Column) -> Column:
    return _col(c).cast("decimal(18,2)")


def age_years(born: str | Column, as_of: str | Column) -> Column:
    """Completed years at ``as_of``, the way EXTRACT(YEAR FROM AGE(...)) counts them."""
    b = _col(born)
    a = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    before_birthday = F.date_format(a, "MMdd") < F.date_format(b, "MMdd")
    return F.year(a) - F.year(b) - before_birthday.cast("int")


def is_adult(born: str | Column, as_of: str | Column, years: int = 18) -> Column:
    """False, not null, when the birth date is unknown."""
    return F.coalesce(age_years(born, as_of) >= years, F.lit(False))


def mapped(c: str | Column, values: dict, default) -> Column:
    """Look a value up in a small fixed map."""
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), _col(c)), F.lit(default))


def flag(c: str | Column) -> Column:
    """0/1 -> boolean."""
    return _col(c).cast("int") == 1


def share(part: Column, whole: Column) -> Column:
    """part / whole as a double, 0 when there is nothing to divide by."""
    ratio = part.cast("double") / F.nullif(whole, F.lit(0)).cast("double")
    return F.coalesce(ratio, F.lit(0.0))


def micros(ts: str | Column) -> Column:
    """Microseconds since the epoch; the session zone is UTC."""
    return F.unix_micros(_col(ts).cast("timestamp"))


def salted_hash(c: str | Column, salt: str) -> Column:
    return F.sha2(F.concat(F.lit(salt), _col(c).cast("string")), 256)


def hash_bucket(c: str | Column, buckets: int = 100) -> Column:
    """A bucket that stays the same across runs and engines."""
    digits = F.substring(F.md5(_col(c).cast("string")), 1, 8)
    return F.pmod(F.conv(digits, 16, 10).cast("bigint"), F.lit(buckets))

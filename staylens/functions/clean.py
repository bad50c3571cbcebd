"""Column expressions: safe casts, cleaning, ages, names and group hashes.

All of them are built-in functions, so they stay inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400
SECONDS_PER_HOUR = 3600
OLDEST_AGE = 120
AGE_ABOVE_OLDEST = 90
DRUG_KEY_LENGTH = 100


def timestamp(c: Column) -> Column:
    return c.try_cast("timestamp")


def number(c: Column) -> Column:
    """Safe cast to double; text that is no number and NaN both become NULL."""
    value = c.try_cast("double")
    return F.when(~F.isnan(value), value)


def elapsed(start: Column, end: Column, unit_seconds: int) -> Column:
    """Whole seconds from ``start`` to ``end`` in units of ``unit_seconds``."""
    return F.timestamp_diff("SECOND", start, end) / F.lit(float(unit_seconds))


def length_of_stay(los: Column, intime: Column, outtime: Column) -> Column:
    """Given length of stay, else the days between entry and exit."""
    return F.coalesce(number(los), elapsed(intime, outtime, SECONDS_PER_DAY))


def window_end(intime: Column, hours: int) -> Column:
    return intime + F.make_dt_interval(hours=F.lit(hours))


# Everything that counts as white space, in the order of the code points.
BLANKS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def category(c: Column, mode: str = "plain") -> Column:
    """Upper-case category with UNKNOWN for missing.

    ``plain`` keeps blanks as they are, ``strip`` trims blanks, tabs and line ends
    and treats an empty text as missing.
    """
    text = c.cast("string")
    if mode == "strip":
        text = F.nullif(F.btrim(text, F.lit(BLANKS)), F.lit(""))
    elif mode != "plain":
        raise ValueError(f"unknown category mode {mode!r}; use 'plain' or 'strip'")
    return F.upper(F.coalesce(text, F.lit("UNKNOWN")))


def _cap_age(age: Column) -> Column:
    return F.when(age > OLDEST_AGE, F.lit(AGE_ABOVE_OLDEST)).when(age >= 0, age).cast("bigint")


def age_year_boundary(birth: Column, at: Column) -> Column:
    """Number of New Years between birth and ``at``, capped."""
    return _cap_age(F.year(at) - F.year(birth))


def age_exact(birth: Column, at: Column) -> Column:
    """Completed years of age at ``at``, capped."""
    before_birthday = (F.month(at) < F.month(birth)) | (
        (F.month(at) == F.month(birth)) & (F.dayofmonth(at) < F.dayofmonth(birth))
    )
    return _cap_age(F.year(at) - F.year(birth) - before_birthday.cast("int"))


def drug_name(drug: Column, generic: Column) -> Column:
    return F.upper(F.trim(F.coalesce(drug.cast("string"), generic.cast("string"), F.lit("UNKNOWN"))))


def drug_key(name: Column) -> Column:
    """A column-name-safe key; the same expression serves selection and features."""
    safe = F.regexp_replace(F.lower(name), "[^a-z0-9]+", "_")
    return F.substring(F.concat(F.lit("drug_"), safe), 1, DRUG_KEY_LENGTH)


def _hash32(group: Column, salt: str) -> Column:
    digest = F.md5(F.concat(F.lit(f"{salt}:"), group.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def hash_fraction(group: Column, seed: int) -> Column:
    """A number in [0, 1) that depends only on the group and the seed."""
    return _hash32(group, str(seed)) / F.lit(float(2**32))


def hash_bucket(group: Column, seed: int, buckets: int) -> Column:
    """A bucket in [0, buckets) that depends only on the group and the seed."""
    return F.pmod(_hash32(group, f"{seed}:fold"), F.lit(buckets)).cast("int")


def sql_name(column: str) -> str:
    """A column name quoted for SQL text."""
    return "`" + column.replace("`", "``") + "`"


def sql_text(value: str) -> str:
    """A string literal for SQL text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

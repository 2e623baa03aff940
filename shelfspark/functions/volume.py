"""Pack volumes in free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfspark.functions.text import once
from shelfspark.functions.vocabulary import AMOUNT, MULTIPACK, SET_OF_VOLUME, TIMES_VOLUME, UNITS

VOLUME_TYPE = "struct<amount:decimal(18,6),unit:string,count:int>"


def _unit(c: Column) -> Column:
    return F.str_to_map(F.lit(",".join(f"{k}:{v}" for k, v in UNITS.items())))[c]


def _amount(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit(".")).try_cast("decimal(18,6)")


def is_multipack(c: Column) -> Column:
    """Does the text name several pieces? Null and empty don't."""
    text, found = F.lower(F.coalesce(c, F.lit(""))), F.lit(False)
    for pattern in MULTIPACK:
        found |= text.rlike(f"(?U){pattern}")
    return found


def parse_volume(c: Column) -> Column:
    """struct(amount, unit, count) or null: a set of N of an amount, else N times an amount, else null for other multipacks, else the
    first amount with a known unit."""
    text = F.lower(c)

    def several(pattern: str) -> Column:
        part = lambda k: F.regexp_extract(text, f"(?U){pattern}", k)
        found = F.struct(_amount(part(2)).alias("amount"), _unit(part(3)).alias("unit"), part(1).try_cast("int").alias("count"))
        valid = once(found, lambda x: F.when(x["unit"].isNotNull() & (x["amount"] > 0) & (x["count"] > 0), x))
        return F.when(text.rlike(f"(?U){pattern}"), valid)  # most texts have none: one search tells

    pairs = F.arrays_zip(F.regexp_extract_all(text, F.lit(f"(?U){AMOUNT}"), 1).alias("a"), F.regexp_extract_all(text, F.lit(f"(?U){AMOUNT}"), 2).alias("u"))
    known = F.filter(F.transform(pairs, lambda p: F.struct(_amount(p["a"]).alias("amount"), _unit(p["u"]).alias("unit"), F.lit(1).alias("count"))), lambda p: p["unit"].isNotNull() & (p["amount"] > 0))
    single = F.when(~is_multipack(c), F.try_element_at(known, F.lit(1)))
    return F.coalesce(several(SET_OF_VOLUME), several(TIMES_VOLUME), single).cast(VOLUME_TYPE)


def write_volume(v: Column) -> Column:
    """The canonical form (50,ml,1), which joins compare; amounts have no trailing zeros."""

    def written(x: Column) -> Column:
        amount = F.regexp_replace(F.regexp_replace(x["amount"].cast("string"), "0+$", ""), r"\.$", "")
        return F.when(x.isNotNull(), F.concat(F.lit("("), amount, F.lit(","), x["unit"], F.lit(","), x["count"].cast("string"), F.lit(")")))

    return once(v, written)


def volume_norm(c: Column) -> Column:
    return write_volume(parse_volume(c))

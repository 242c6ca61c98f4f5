"""Column expressions and name rules for raw text input."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# A number as a person writes it: sign, decimals and exponent allowed, nothing else.
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_DAY_FIRST = r"^(\d{1,2})[/.-](\d{1,2})[/.-](\d{4}) +(\d{1,2}):(\d{1,2})$"
_YEAR_FIRST = r"^(\d{4})[/.-](\d{1,2})[/.-](\d{1,2})[ T]+(\d{1,2}):(\d{1,2}):(\d{1,2})$"

# Accepted spellings of a bit, compared trimmed and lower case.
TRUE_WORDS = ("1", "true", "t", "yes", "y")
FALSE_WORDS = ("0", "false", "f", "no", "n")


def clean_name(name: str) -> str:
    """Snake case: words split at case changes, anything else becomes `_`."""
    out = name.replace("%", "_percent_").replace("#", "_number_").replace("'", "")
    out = re.sub(r"[^0-9A-Za-z]+", "_", out)
    out = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", out)
    out = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", out)
    out = re.sub(r"_+", "_", out).strip("_").lower()
    if not out or out[0].isdigit():
        out = "x" + out
    return out


def clean_name_list(names: list[str]) -> list[str]:
    """Cleaned names made unique: later repeats get `_2`, `_3`, ..."""
    seen: dict[str, int] = {}
    taken = set()
    out = []
    for name in map(clean_name, names):
        seen[name] = seen.get(name, 0) + 1
        candidate = name if seen[name] == 1 else f"{name}_{seen[name]}"
        while candidate in taken:
            seen[name] += 1
            candidate = f"{name}_{seen[name]}"
        taken.add(candidate)
        out.append(candidate)
    return out


def blank_to_null(c: Column) -> Column:
    """Trimmed text; empty text and the marker `NA` are null."""
    t = F.trim(c)
    return F.when(~t.isin("", "NA"), t)


def to_int(c: Column) -> Column:
    """Lenient integer: decimals are cut off, anything not a number is null.

    The text check comes first because a plain cast reads `7d` as 7.
    """
    t = F.trim(c.cast("string"))
    return F.when(t.rlike(_NUMBER), t.try_cast("double").try_cast("int"))


def to_bit(c: Column) -> Column:
    """1 / 0 / null from the usual spellings of yes and no."""
    t = F.lower(F.trim(c.cast("string")))
    return F.when(t.isin(*TRUE_WORDS), F.lit(1)).when(t.isin(*FALSE_WORDS), F.lit(0))


def parse_mixed_ts(c: Column) -> Column:
    """Wall-clock timestamp from `d/m/Y H:M` or `Y/m/d H:M:S`, else null.

    Both shapes are rewritten to ISO text and try-cast to TIMESTAMP_NTZ: no zone is
    involved, so no hour is lost around a daylight-saving change, and an
    impossible day is null.
    """
    t = blank_to_null(c.cast("string"))
    day_first = F.regexp_replace(t, _DAY_FIRST, "$3-$2-$1 $4:$5:00")
    year_first = F.regexp_replace(t, _YEAR_FIRST, "$1-$2-$3 $4:$5:$6")
    return (
        F.when(t.rlike(_DAY_FIRST), day_first.try_cast("timestamp_ntz"))
        .when(t.rlike(_YEAR_FIRST), year_first.try_cast("timestamp_ntz"))
    )


def strip_quotes(c: Column) -> Column:
    """Drop one leading and one trailing quote character."""
    return F.regexp_replace(c, "^[\"']|[\"']$", "")

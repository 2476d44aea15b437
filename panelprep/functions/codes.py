"""Column expressions over security codes and prefix-hierarchy codes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from panelprep.functions.text import as_col

# Fixed values: (family, pattern), first match wins.
CODE_FAMILIES = (
    ("suffixed", r"^\d{6}\.(SZ|SH)\z"),
    ("raw_index", r"^\d{6}\z"),
    ("hk", r"^\d+\.HK\z"),
    ("fund", r"^[A-Za-z0-9]+\.OF\z"),
    ("suffixed_index", r"^[A-Za-z0-9]+\.(MI|SPI|CI)\z"),
    ("venue", r"^[A-Za-z]+\d*\.[A-Z]{3}\z"),
)
UNKNOWN_FAMILY = "unknown"

# Characters of a hierarchy code that name level 1, 2 and 3, and
# the padded length of a dictionary code.
PREFIX_LEN = {1: 4, 2: 6, 3: 8}
DICTIONARY_CODE_LEN = 16


def code_family(col: Column | str, families=CODE_FAMILIES) -> Column:
    """Family of a code by its format; formats are data, so callers can extend them."""
    code = as_col(col)
    hits = [F.when(code.rlike(pattern), F.lit(name)) for name, pattern in families]
    return F.coalesce(*hits, F.lit(UNKNOWN_FAMILY))


def to_raw_code(col: Column | str) -> Column:
    """``000300.SH`` to ``000300``."""
    return F.substring_index(as_col(col), ".", 1)


def hk_key(col: Column | str) -> Column:
    """Padding-free key of a Hong Kong code: ``00700.HK`` and ``0700.HK`` give ``700``."""
    digits = F.regexp_extract(as_col(col), r"^0*(\d+)\.HK\z", 1)
    return F.nullif(digits, F.lit(""))


def hk_default(col: Column | str) -> Column:
    """Hong Kong code padded to four digits, longer ones as they are; others unchanged."""
    code = as_col(col)
    key = hk_key(code)
    padded = F.when(F.length(key) < 4, F.lpad(key, 4, "0")).otherwise(key)
    return F.when(key.isNotNull(), F.concat(padded, F.lit(".HK"))).otherwise(code)


def prefix_len(level: int) -> int:
    if level not in PREFIX_LEN:
        raise ValueError(f"hierarchy level must be one of {sorted(PREFIX_LEN)}, got {level!r}")
    return PREFIX_LEN[level]


def hierarchy_key(col: Column | str, level: int) -> Column:
    """Dictionary key of a compact code at a level: prefix, zero-padded on the right."""
    prefix = F.substring(as_col(col), 1, prefix_len(level))
    return F.rpad(prefix, DICTIONARY_CODE_LEN, "0")

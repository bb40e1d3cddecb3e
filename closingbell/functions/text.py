from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: what a symbol may not contain. Unicode blanks count as blanks, and the four
# ASCII separators are listed because Java's blank class leaves them out.
NOT_A_SYMBOL_CHAR = r"(?U)[^a-zA-Z0-9\s\x1c-\x1f]"


def normalise_symbol(ticker: Column) -> Column:
    """Every other character becomes a slash, one for one: no trimming, no case change."""
    return F.regexp_replace(ticker, NOT_A_SYMBOL_CHAR, "/")


def stable_id(kind: str, *keys: Column) -> Column:
    """Surrogate key from the natural key, so a retried task writes the same id."""
    return F.sha2(F.concat_ws("\u0001", F.lit(kind), *[k.cast("string") for k in keys]), 256)


def shown(value: Column) -> Column:
    """A value inside a message; a null part must not turn the whole message into null."""
    return F.coalesce(value.cast("string"), F.lit("None"))


def shown_number(value: Column) -> Column:
    """A double in a message: digits in full where a plain reading is usual, so ten million
    is ``10000000.0`` and not in powers of ten."""
    plain = F.regexp_replace(
        value.cast("string").cast("decimal(38,21)").cast("string"), r"(\.\d+?)0*$", "$1"
    )
    usual = (F.abs(value) >= 1e-4) & (F.abs(value) < 1e16)
    return F.when(usual, plain).otherwise(shown(value))

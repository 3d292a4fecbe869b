"""Ticker symbols out of file names."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import as_column

TICKER_SUFFIX = ".us.txt"


def extract_symbol(file_name) -> Column:
    """Drop `.us.txt` (case-sensitive, every occurrence), else the last extension; upper case.

    A leading dot starts a name, not an extension.
    """
    f = as_column(file_name)
    return F.upper(
        F.when(
            F.endswith(f, F.lit(TICKER_SUFFIX)),
            F.replace(f, F.lit(TICKER_SUFFIX), F.lit("")),
        ).otherwise(F.regexp_replace(f, r"^(\.*[^.].*)\.[^.]*$", "$1"))
    )


def extract_ticker(file_name) -> Column:
    """Upper-case name before `.us.txt` (any case), empty string for other files."""
    f = as_column(file_name)
    stem = F.substring(f, F.lit(1), F.length(f) - len(TICKER_SUFFIX))
    return F.when(F.endswith(F.lower(f), F.lit(TICKER_SUFFIX)), F.upper(stem)).otherwise("")


def ticker_equals(symbol, ticker) -> Column:
    return F.upper(F.trim(as_column(symbol))) == F.upper(F.trim(as_column(ticker)))

"""Cleaning, typing and prechecks of raw bars."""

from functools import reduce
from operator import or_

from pyspark.sql import Observation
from pyspark.sql import functions as F

from ..functions.numeric import count_where, finite
from ..schema import RAW_BARS, floating_columns

# The flag stored for each kind of instrument.
TYPE_CODES = {"stock": 0, "etf": 1}


def parse_date(c, formats=()):
    """ISO text, then the given extra formats; anything else is NULL."""
    text = F.col(c).cast("string")
    # The parser skips fields of a timestamp; the cast alone would also take a bare year.
    iso = F.when(F.rlike(F.trim(text), F.lit(r"^\d{4}-\d{1,2}-\d{1,2}")), text.try_cast("date"))
    extra = [F.try_to_timestamp(text, F.lit(f)).cast("date") for f in formats]
    return F.coalesce(iso, *extra)


def infinite_to_null(df):
    floats = set(floating_columns(df))
    return df.select(*[finite(c).alias(c) if c in floats else F.col(c) for c in df.columns])


def clean_bars(df, drop_zero_volume=True, date_formats=(), seen=lambda df, step: df):
    """Drop rows with missing or infinite values, copies, zero volume and unreadable dates.

    `seen` gets the rows after each step and returns them.
    """
    clean = seen(infinite_to_null(seen(df, "in")).dropna("any"), "present").dropDuplicates()
    clean = seen(clean, "distinct")
    if drop_zero_volume and "Volume" in df.columns:
        clean = clean.where(F.col("Volume") > 0)
    clean = seen(clean, "traded")
    if "Date" in df.columns:
        clean = clean.withColumn("Date", parse_date("Date", date_formats)).where(
            F.col("Date").isNotNull()
        )
    return seen(clean, "out")


def counted_clean_bars(df, drop_zero_volume=True, date_formats=()):
    """(clean bars, function): the function gives `cleaning_report`'s counts once the bars were written.

    The rows are counted as they pass by, so that one write of the bars is the only pass. Write them as
    a plain stage: a sort or a range partitioning would draw its sample from the same rows.
    """
    counts = {}

    def seen(rows, step):
        counts[step] = Observation(f"rows {step}")
        return rows.observe(counts[step], F.count(F.lit(1)).alias("n"))

    bars = clean_bars(df, drop_zero_volume, date_formats, seen)

    def report():
        n = {step: int(found.get["n"]) for step, found in counts.items()}
        return {
            "rows_in": n["in"],
            "missing_removed": n["in"] - n["present"],
            "duplicates_removed": n["present"] - n["distinct"],
            "zero_volume_removed": n["distinct"] - n["traded"],
            "bad_dates_removed": n["traded"] - n["out"],
            "rows_out": n["out"],
        }

    return bars, report


def cleaning_report(df, drop_zero_volume=True, date_formats=()):
    """One row: rows before and after, and the rows each step of `clean_bars` removes.

    One shuffle: copies are counted per distinct row.
    """
    distinct = infinite_to_null(df).groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    missing = reduce(or_, [F.col(c).isNull() for c in df.columns])
    zero = F.col("Volume") <= 0 if drop_zero_volume and "Volume" in df.columns else F.lit(False)
    bad_date = parse_date("Date", date_formats).isNull() if "Date" in df.columns else F.lit(False)
    flagged = distinct.select(
        "_copies",
        missing.alias("_missing"),
        (~missing & zero).alias("_zero"),
        (~missing & ~zero & bad_date).alias("_bad_date"),
        (~missing & ~zero & ~bad_date).alias("_kept"),
    )

    def copies(condition, extra=0):
        return F.coalesce(
            F.sum(F.when(condition, F.col("_copies") - extra)), F.lit(0).cast("bigint")
        )

    return flagged.agg(
        F.coalesce(F.sum("_copies"), F.lit(0).cast("bigint")).alias("rows_in"),
        copies(F.col("_missing")).alias("missing_removed"),
        copies(~F.col("_missing"), 1).alias("duplicates_removed"),
        count_where(F.col("_zero")).alias("zero_volume_removed"),
        count_where(F.col("_bad_date")).alias("bad_dates_removed"),
        count_where(F.col("_kept")).alias("rows_out"),
    )


def type_code(c, strict=True):
    """`stock` and `etf` in any case to their flag; others raise, or NULL if not strict."""
    text = F.lower(F.col(c))
    code = F.lit(None).cast("tinyint")
    if strict:
        code = F.raise_error(F.concat(F.lit("unknown type: "), F.coalesce(text, F.lit("NULL")))).cast(
            "tinyint"
        )
    for name, flag in TYPE_CODES.items():
        code = F.when(text == name, F.lit(flag).cast("tinyint")).otherwise(code)
    return code


def typed_bars(df, strict=True, float_type="double"):
    """Lower-case names, DATE dates, numeric prices, BIGINT volume, instrument flag."""
    lower = df.toDF(*[c.lower() for c in df.columns])
    types = {"open": float_type, "high": float_type, "low": float_type, "close": float_type}
    types |= {"volume": "bigint", "symbol": "string"}
    casts = {c: F.col(c).cast(t) for c, t in types.items() if c in lower.columns}
    if "date" in lower.columns:
        casts["date"] = parse_date("date")
    if "type" in lower.columns:
        casts["type"] = type_code("type", strict)
    return lower.withColumns(casts)


def precheck(df):
    """One row: rows, columns, unreadable dates, first and last date."""
    parsed = parse_date("Date")
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).cast("bigint").alias("columns"),
        count_where(parsed.isNull()).alias("invalid_dates"),
        F.min(parsed).alias("min_date"),
        F.max(parsed).alias("max_date"),
    )


def guardrail(df, expected=tuple(RAW_BARS.fieldNames())):
    """One row per check: what was observed and whether it is acceptable."""
    lost = sorted(set(expected) - set(df.columns))
    zero = F.lit(0).cast("bigint")
    bad_dates = count_where(parse_date("Date").isNull()) if "Date" in df.columns else zero
    negative = count_where(F.col("Volume") < 0) if "Volume" in df.columns else zero - 1

    def absent(c):
        if c == "Date":
            return parse_date(c).isNull()
        if c in floating_columns(df):
            return F.col(c).isNull() | F.isnan(c)
        return F.col(c).isNull()

    missing = sum((count_where(absent(c)) for c in df.columns), zero)
    row = df.agg(
        F.lit(len(lost)).cast("bigint").alias("missing_columns"),
        bad_dates.alias("invalid_dates"),
        missing.alias("missing_values"),
        negative.alias("negative_volume"),
    )
    names = row.columns
    passed = reduce(lambda a, b: a & b, [F.col(c) <= 0 for c in names])
    checks = [
        F.struct(
            F.lit(c).alias("check_name"), F.col(c).alias("observed"), (F.col(c) <= 0).alias("ok")
        )
        for c in names
    ]
    failed = sum(((F.col(c) > 0).cast("bigint") for c in names), zero)
    checks.append(
        F.struct(F.lit("all").alias("check_name"), failed.alias("observed"), passed.alias("ok"))
    )
    return row.select(F.explode(F.array(*checks)).alias("_c")).select("_c.*")

"""Column names, types and constants shared by all operators.

Contract of the `bars` table: one row per (symbol, date), `date` is DATE,
missing values are NULL (never NaN or Inf).
"""

from pyspark.sql import types as T

# They define the results.
TARGET_HORIZONS = (1, 3, 5)
ROLL_WINDOWS = (5, 10, 20, 50)
RATIO_EPS = 1e-9
STD_EPS = 1e-8
REGIME_WINDOW = 20
REGIME_MIN_DAYS = 5
REGIME_BASE_WINDOW = 50
MIN_HISTORY_ROWS = 60
SEED = 42

TARGETS = tuple(f"target_{h}" for h in TARGET_HORIZONS)

RAW_BARS = T.StructType(
    [
        T.StructField("Date", T.StringType()),
        T.StructField("Open", T.DoubleType()),
        T.StructField("High", T.DoubleType()),
        T.StructField("Low", T.DoubleType()),
        T.StructField("Close", T.DoubleType()),
        T.StructField("Volume", T.LongType()),
        T.StructField("OpenInt", T.LongType()),
    ]
)


# Folder column of tables written by year.
YEAR = "year"


def feature_columns(df, exclude=()):
    """Everything that is not a key, a target, the folder column or listed in `exclude`."""
    skip = {"date", "symbol", YEAR, *TARGETS, *exclude}
    return [c for c in df.columns if c not in skip]


def numeric_columns(df):
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def floating_columns(df):
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    ]


def require_columns(df, names):
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    if len(set(df.columns)) != len(df.columns):
        raise ValueError(f"duplicate column names: {df.columns}")
    return df

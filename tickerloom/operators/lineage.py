"""Written stages and size-checked broadcasts."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.stages import staged

BROADCAST_ROWS = 1_000_000
# Days a DATE can name (years 1 to 9999): the most rows a table keyed by date can have.
CALENDAR_DAYS = 3_652_059
NARROW_COLUMNS = 8


def cut_lineage(df):
    """`df` as a Parquet stage in the shared folder; see `sources.stages`."""
    return staged(df, "stage", "snappy")


def checked_broadcast(small, max_rows=BROADCAST_ROWS):
    """Broadcast hint if `small` really has at most `max_rows` rows, else a shuffled join.

    It is written once, so that counting it is no second pass over what it comes from.
    """
    small = staged(small, "small", "snappy")
    return F.broadcast(small) if small.count() <= max_rows else small


def join_by_date(df, daily, how="left"):
    """Join a table that has one row per `date`; the rows of `df` stay where they are.

    A narrow table keyed by DATE is bounded by the calendar. A wide one is counted
    first, and a `date` that carries a time of day gets a shuffled join.
    """
    if isinstance(daily.schema["date"].dataType, T.DateType):
        if len(daily.columns) <= NARROW_COLUMNS + 1:
            daily = F.broadcast(daily)
        else:
            daily = checked_broadcast(daily, BROADCAST_ROWS // 10)
    return df.join(daily, "date", how)

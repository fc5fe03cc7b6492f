"""The parameter relation: which days to extract, and when the run happens."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession

PARAMETER_TABLE = "extract_date date, run_ts timestamp"


def extract_parameters(
    spark: SparkSession, dates: date | Iterable[date], run_ts: datetime | None = None
) -> DataFrame:
    """One row ``(extract_date, run_ts)`` per day to extract.

    File names carry the run time, not the extract date.  So that several days
    get several names, each day of a list counts as run on the day after it, at
    the time of day of ``run_ts``.
    """
    run = run_ts or datetime.now(timezone.utc)
    if isinstance(dates, date):
        rows = [(dates, run)]
    else:
        rows = [(day, datetime.combine(day + timedelta(days=1), run.timetz())) for day in sorted(set(dates))]
    return spark.createDataFrame(rows, PARAMETER_TABLE)

"""Names of the output files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_name(phase: Column, mac_id: Column, run_ts: Column) -> Column:
    """The day before the run in the session's zone, and New York wall time."""
    day = F.date_format(F.date_sub(run_ts.cast("date"), 1), "yyMMdd")
    wall = F.convert_timezone(
        F.current_timezone(), F.lit("America/New_York"), run_ts.cast("timestamp_ntz")
    )
    return F.concat(
        F.lit("P.IDR.IN.EFT.MAP."), phase, F.lit("."), F.lpad(mac_id, 5, "0"),
        F.lit(".D."), day, F.lit(".T"), F.date_format(wall, "HHmmss"), F.lit(".txt"),
    )

"""Landing folder of the event stream: newline-delimited JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def land_events(events: DataFrame, path: str) -> None:
    """Append a batch of events. Times are written as text, since the JSON writer cuts microseconds."""
    times = [f.name for f in events.schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
    events.withColumns({name: F.col(name).cast("string") for name in times}).write.mode("append").json(path)

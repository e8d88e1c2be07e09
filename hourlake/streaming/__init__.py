from hourlake.streaming.bronze import stream_events, stream_lines, stream_to_bronze
from hourlake.streaming.events import (
    dedupe_stream,
    hourly_volume_stream,
    upsert_stream,
    volume_to_table,
    with_watermark,
)
from hourlake.streaming.late import late_rows, recovered_volume, stored_volume, volume_and_late_rows

__all__ = [
    "dedupe_stream",
    "hourly_volume_stream",
    "late_rows",
    "recovered_volume",
    "stored_volume",
    "stream_events",
    "stream_lines",
    "stream_to_bronze",
    "upsert_stream",
    "volume_and_late_rows",
    "volume_to_table",
    "with_watermark",
]

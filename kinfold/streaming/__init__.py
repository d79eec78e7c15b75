"""Structured Streaming: incremental, exactly-once ingestion of date-named wearable files."""

from kinfold.streaming.wearables import (align_stream, daily_versions, hrv_stream, ingest_available,  # noqa: F401
                                        read_daily, refresh_daily)

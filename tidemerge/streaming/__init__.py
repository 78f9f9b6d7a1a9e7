from tidemerge.streaming.ingest import (
    collect_orphans, dedupe_stream, dropped_rows, ingest_stream, late_rows, orphan_stream, run_available, volume_stream,
)

__all__ = ["collect_orphans", "dedupe_stream", "dropped_rows", "ingest_stream", "late_rows", "orphan_stream", "run_available", "volume_stream"]

from tidemerge.sources.manifest import normalize_manifest, table_registry
from tidemerge.sources.pages import CONTACT_PAGE, ENVELOPE_PAGE, envelopes, over_all_cores, read_pages, stream_pages
from tidemerge.sources.tables import (
    cost, inventory, max_watermark, read_table, row_count, scan, scan_full, scan_range, scan_since, scan_top, stored_bytes,
)

__all__ = [
    "CONTACT_PAGE", "ENVELOPE_PAGE", "cost", "envelopes", "inventory", "max_watermark", "normalize_manifest", "over_all_cores",
    "read_pages", "read_table", "row_count", "scan", "scan_full", "scan_range", "scan_since", "scan_top",
    "stored_bytes", "stream_pages", "table_registry",
]

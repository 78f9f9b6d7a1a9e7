"""Fixed values that results depend on, kept together as plain text."""

# --- fixed values: size tiers -> rows per batch, months per chunk, retries, retry minutes
TIERS = {
    "heavy": {"batch_rows": 50_000, "chunk_months": 1, "retries": 3, "retry_minutes": 10},
    "medium": {"batch_rows": 25_000, "chunk_months": 3, "retries": 3, "retry_minutes": 5},
    "light": {"batch_rows": 10_000, "chunk_months": None, "retries": 2, "retry_minutes": 2},
}
DEFAULT_TIER = "medium"
HEAVY_ABOVE_ROWS = 5_000_000
MEDIUM_FROM_ROWS = 100_000

# --- fixed values: load planning
HISTORY_START = "2022-01-01"
FALLBACK_DAYS = 3
COMPLETE_COVERAGE = 0.99
TARGET_SCHEMA = "bq_import"

# --- fixed values: price assumptions in USD
QUERY_PRICE_PER_TB = 5.00
FREE_TB = 1.0
EGRESS_PRICE_PER_GB = 0.12

# --- fixed values: cursor windows per entity
SAFETY_LAG_SECONDS = 120
ENTITIES = {
    "messages": {"source": "export_messages", "lookback_minutes": 240, "overlap_seconds": 300,
                 "piece_days": 7, "sample_hours": 72},
    "statuses": {"source": "export_statuses", "lookback_minutes": 240, "overlap_seconds": 300,
                 "piece_days": 7, "sample_hours": 72},
    "contacts": {"source": "export_contacts", "lookback_minutes": 1440, "overlap_seconds": 600,
                 "piece_days": 30, "sample_hours": 168},
}

# --- fixed values: synced tables by tier, with their key column
SYNCED_TABLES = {
    "heavy": [("messages", "id"), ("statuses", "id"), ("contacts", "id"), ("chats", "id")],
    "medium": [("flow_results", "uuid"), ("message_attachments", "id"), ("chat_events", "uuid"),
               ("journey_insights", "uuid"), ("attachments", "id"), ("ai_events", "uuid")],
    "light": [("accounts", "uuid"), ("flow_results_data_packages", "uuid"), ("journey_summary", "uuid"),
              ("message_tags", "id"), ("number_tags", "id"), ("cards", "id")],
}
SYNCED_INCREMENTAL_COLUMN = "updated_at"
SYNCED_OVERRIDES = {"contacts": {"history_start": "2025-07-01", "batch_rows": 1_000}}

# --- fixed values: name of the lineage column
LOADED_AT = "_loaded_at"

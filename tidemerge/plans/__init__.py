from tidemerge.plans.chunks import chunk_stats, full_chunk, month_chunks, tier_for_rows, with_tier
from tidemerge.plans.load import incremental_chunk, plan_load, resume_point, with_fallback
from tidemerge.plans.windows import backfill_window, cursor_window, entity_settings, sample_window, subwindows

__all__ = [
    "backfill_window", "chunk_stats", "cursor_window", "entity_settings", "full_chunk", "incremental_chunk",
    "month_chunks", "plan_load", "resume_point", "sample_window", "subwindows", "tier_for_rows", "with_fallback",
    "with_tier",
]

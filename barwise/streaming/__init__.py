"""Streaming: landed bar files drive the fact-table load and the refresh of
the touched daily-rollup months (the reference's reload-then-refresh cycle)."""

from barwise.streaming.refresh import apply_batch, landed_bars, start_refresh

__all__ = ["apply_batch", "landed_bars", "start_refresh"]

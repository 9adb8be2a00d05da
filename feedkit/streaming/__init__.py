"""Incremental send cycle (feed -> publish -> control upsert)."""

from feedkit.streaming.cycle import run_cycle

__all__ = ["run_cycle"]

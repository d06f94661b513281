"""Micro-batch use of the merge operators."""

from tablesync.streaming.batches import apply_change_stream

__all__ = ["apply_change_stream"]

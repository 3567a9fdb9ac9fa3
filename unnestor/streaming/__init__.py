"""Incremental (file-stream) form of the batch load."""

from .incremental import start_incremental_load

__all__ = ["start_incremental_load"]

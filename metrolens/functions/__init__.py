"""Column-level functions: built-in Spark expressions only (no Python UDFs)."""

from . import geometry, text, timeparts

__all__ = ["geometry", "text", "timeparts"]

"""Structured Streaming online model update."""

from ridgeway._lazy import lazy_exports

_EXPORTS = {
    "OnlineUpdate": "ridgeway.streaming.online",
    "chunk_column": "ridgeway.streaming.online",
    "run_online_update": "ridgeway.streaming.online",
    "run_ordered_update": "ridgeway.streaming.online",
    "write_manifest": "ridgeway.streaming.online",
    "write_stream_chunks": "ridgeway.streaming.online",
}

__getattr__, __dir__ = lazy_exports(__name__, _EXPORTS)
__all__ = sorted(_EXPORTS)

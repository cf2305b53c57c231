"""Streaming source of commit files (see ``source.py`` for what runs on it)."""

from commitlake.streaming.source import stream_commits

__all__ = ["stream_commits"]

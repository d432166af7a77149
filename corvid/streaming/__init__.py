"""Structured Streaming versions of the feed's write path (posting tweets)."""

from corvid.streaming.feed_stream import start_timeline_writer, timeline_stream

__all__ = ["start_timeline_writer", "timeline_stream"]

"""Structured Streaming: event-time windows and stateful features over arriving files."""

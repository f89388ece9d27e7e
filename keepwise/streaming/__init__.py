"""Structured Streaming: file-stream scoring into the prediction store."""

"""Structured Streaming: detection over a landing folder, upload-event catalogue."""

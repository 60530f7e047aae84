"""Structured Streaming: message landing, streaming de-duplication and hourly latest."""

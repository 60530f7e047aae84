"""Readers and writers: station catalogue, XML payloads, JSON messages, partitioned tables."""

"""Streaming maintenance of the hourly aggregates."""

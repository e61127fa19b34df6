"""Structured Streaming variants of the table loads."""

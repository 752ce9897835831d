"""Structured Streaming forms of the monitor, the error counts and the quarterly rollup."""

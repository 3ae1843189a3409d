"""Structured Streaming jobs. Each gives the result of its batch twin."""

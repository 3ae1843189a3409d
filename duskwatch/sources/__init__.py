"""Scans of landed logs, dimensions and feeds; sinks; the sample telemetry tables."""

"""Scans, log parsers and sinks."""

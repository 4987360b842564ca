"""Scans, landed-file readers, fixture views and sinks."""

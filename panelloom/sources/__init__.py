"""Scans, sinks and named views."""

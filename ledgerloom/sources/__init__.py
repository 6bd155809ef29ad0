"""Scans, sinks, staged tables and JSON ledgers."""

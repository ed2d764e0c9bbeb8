"""Scans, sinks, declared schemas, inline lookups and test-table adapters."""

"""Sinks: silver (partitioned by dataset) and gold tables."""

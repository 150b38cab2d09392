"""Fact tables, saved results and sinks."""

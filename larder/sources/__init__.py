"""Readers, target tables and file sinks."""

"""Readers and writers: storage listings, footers, tables, reports, raw bytes."""

"""Readers and writers: landed documents, raw tables, catalog tables, published snapshots."""

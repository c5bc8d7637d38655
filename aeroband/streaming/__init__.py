"""Incremental refresh driven by newly landed files."""

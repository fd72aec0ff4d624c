"""Composite queries: enriched feeds and the query catalogue."""

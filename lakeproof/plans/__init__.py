"""End-to-end plans: migrate a lake, reconcile tables, compare buckets."""

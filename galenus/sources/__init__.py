"""Readers of external formats; each returns a DataFrame with declared columns and a ``source_file``."""

"""Relational operators: load, curate, graph, signals, recalls, lookups, quality, gates, audit, training data."""

"""Registered queries: each an operator applied to the provided tables, with its DuckDB SQL."""

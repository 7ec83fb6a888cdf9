"""Manifests: what a run read and wrote, and catalogue entries of tables."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession

from galenus.operators.checkpoints import put


def canonical(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), default=str)


def manifest(kind: str, inputs: list[dict], counts: dict, config: dict) -> dict:
    """Inputs in a fixed order, counts, config and the digest of the canonical config."""
    return {"kind": kind, "inputs": sorted(inputs, key=canonical), "counts": counts, "config": config, "config_sha256": hashlib.sha256(canonical(config).encode()).hexdigest()}


def write_manifest(path: str, **parts) -> str:
    """Write the manifest beside its data, in whatever store the path names; returns the config digest."""
    m = manifest(**parts)
    put(SparkSession.active(), path, json.dumps(m, indent=1, sort_keys=True, default=str).encode())
    return m["config_sha256"]


def catalogue(source: str, tables: dict[str, DataFrame]) -> dict:
    """Tables and columns of a source, from their schemas alone."""
    columns = lambda df: [{"name": f.name, "dataType": f.dataType.simpleString().upper(), "nullable": f.nullable} for f in df.schema.fields]
    return {"source": source, "tables": [{"name": n, "columns": columns(df)} for n, df in sorted(tables.items())]}

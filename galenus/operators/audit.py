"""Append-only, hash-chained audit trail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The event types, the hashed fields, and the hash before the first record.
EVENTS = frozenset(
    "run_start run_end extract_commit serialize_commit load_commit load_replace graph_commit corpus_materialize schema_migration force_override integrity_check "
    "manual_correction config_change bulk_index_drop bulk_index_rebuild orphan_cancel unit_skip gate_override".split()
)
HASHED = ("actor", "host", "pid", "run_id", "code_version", "event_type", "object", "input_content_hash", "rows_affected", "old_value", "new_value", "reason", "prev_hash")
NEEDS_REASON = frozenset({"manual_correction", "schema_migration"})
GENESIS = "0" * 64


def record_hash(columns: dict[str, Column] | None = None) -> Column:
    """SHA-256 of compact JSON of the hashed fields with sorted keys; nulls are written."""
    c = columns or {k: F.col(k) for k in HASHED}
    return F.sha2(F.to_json(F.struct(*(c[k].alias(k) for k in sorted(HASHED))), {"ignoreNullFields": "false"}), 256)


def append(trail: DataFrame, event: dict) -> DataFrame:
    """The trail with one more record; a single writer calls this. Unknown events, and corrections without a reason, are refused."""
    if event.get("event_type") not in EVENTS:
        raise ValueError(f"unknown event type {event.get('event_type')!r}")
    if event["event_type"] in NEEDS_REASON and not (event.get("reason") or "").strip():
        raise ValueError(f"{event['event_type']} needs a reason")
    last = trail.orderBy(F.desc("seq")).select("seq", "record_hash").head()
    fields = {**dict.fromkeys(HASHED), **event, "prev_hash": last.record_hash if last else GENESIS, "seq": last.seq + 1 if last else 1}
    schema = trail.schema
    row = trail.sparkSession.createDataFrame([tuple(fields.get(f.name) for f in schema.fields)], schema)
    return trail.unionByName(row.withColumn("record_hash", record_hash()).withColumn("recorded_at", F.current_timestamp()).select(*trail.columns))


def verify(trail: DataFrame, mirror_rows: int | None = None) -> DataFrame:
    """(seq, problem): hash_mismatch, chain_break, and mirror_short if a mirror has fewer rows. Empty means intact.

    The previous record is found by an equi join on seq - 1, not by a window
    over the whole trail, which one task would have to sort.
    """
    prior = trail.select((F.col("seq") + 1).alias("seq"), F.col("record_hash").alias("_before"))
    j = trail.join(prior, "seq", "left")
    first = trail.agg(F.min("seq").alias("_first"))
    j = j.crossJoin(F.broadcast(first))  # one row
    want = F.when(F.col("seq") == F.col("_first"), F.lit(GENESIS)).otherwise(F.col("_before"))
    problems = F.array_compact(F.array(F.when(record_hash() != F.col("record_hash"), F.lit("hash_mismatch")), F.when(~F.col("prev_hash").eqNullSafe(want), F.lit("chain_break"))))
    out = j.select("seq", F.explode(problems).alias("problem"))
    if mirror_rows is not None:
        out = out.unionByName(trail.agg(F.max("seq").alias("seq"), F.count("*").alias("n")).filter(F.col("n") > mirror_rows).select("seq", F.lit("mirror_short").alias("problem")))
    return out

"""Configured regulatory feeds: payload rows to reference records with key, names, products and date."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galenus.functions.dates import parse_date
from galenus.functions.ids import fits_key, norm_name, norm_product_key
from galenus.functions.json import payload_values


@dataclass(frozen=True)
class Feed:
    """Where a feed's payload holds its key, names, products and date. Paths are dotted; [*] steps into an array."""

    dataset: str
    format: str
    jurisdiction: str
    cadence: str = "daily"
    key_fields: tuple[str, ...] = ()
    name_fields: tuple[str, ...] = ()
    product_fields: tuple[str, ...] = ()
    date_field: str | None = None
    date_order: str = "dmy"


PARSERS: dict[str, Callable[..., DataFrame]] = {}


def parser(name: str) -> Callable:
    """Register a format: a function (spark, path) -> DataFrame with columns payload (JSON) and source_file."""

    def register(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        PARSERS[name] = f
        return f

    return register


@parser("json_lines")
def _json_lines(spark, path: str) -> DataFrame:
    return spark.read.text(path).select(F.col("value").alias("payload"), F.col("_metadata.file_path").alias("source_file")).filter("trim(payload) <> ''")


@parser("json_data")
def _json_data(spark, path: str) -> DataFrame:
    raw = spark.read.option("wholetext", "true").text(path)
    items = F.from_json(F.get_json_object("value", "$.data"), "array<string>")
    return raw.select(F.explode(items).alias("payload"), F.col("_metadata.file_path").alias("source_file"))


@parser("zip_results")
def _zip_results(spark, path: str) -> DataFrame:
    from galenus.sources.archives import read_members

    members = read_members(spark, path, ".json").filter("content is not null")
    return members.select(F.explode(F.from_json(F.get_json_object(F.decode("content", "UTF-8"), "$.results"), "array<string>")).alias("payload"), "source_file")


def read_feed(spark, feed: Feed, path: str) -> DataFrame:
    if feed.format not in PARSERS:
        raise ValueError(f"unknown format {feed.format!r}")
    return PARSERS[feed.format](spark, path)


def load_feeds(path: str) -> dict[str, Feed]:
    """Feeds of a TOML file: one table per dataset."""
    import tomllib

    with open(path, "rb") as f:
        entries = tomllib.load(f)
    return {k: Feed(dataset=k, **{a: tuple(b) if isinstance(b, list) else b for a, b in v.items()}) for k, v in entries.items()}


def prepare(rows: DataFrame, feed: Feed, release_id: str) -> tuple[DataFrame, DataFrame]:
    """(reference records, counters) of payload rows.

    Exact duplicates go by digest; the key joins its fields with ``|`` and list
    values with ``,``; a missing field makes it ``h:<digest>``, no key fields
    the digest. Names are split, normalised by way of their distinct values and
    kept once in order; those over the key limit are left out.
    """
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    seen = rows.groupBy("digest").agg(F.first("payload").alias("payload"), F.min("source_file").alias("source_file"), F.count("*").alias("copies"))
    values = [F.array_join(payload_values(F.col("payload"), f), ",") for f in feed.key_fields]
    missing = F.lit(False)
    for v in values:
        missing = missing | (v == "")
    key = F.col("digest") if not values else F.when(missing, F.concat(F.lit("h:"), "digest")).otherwise(F.concat_ws("|", *values))
    none = F.array().cast("array<string>")
    raw_names = F.concat(none, *(payload_values(F.col("payload"), f) for f in feed.name_fields))
    products = F.array_distinct(F.array_compact(F.transform(F.concat(none, *(payload_values(F.col("payload"), f) for f in feed.product_fields)), norm_product_key)))
    date = parse_date(F.get(payload_values(F.col("payload"), feed.date_field), F.lit(0)), feed.date_order) if feed.date_field else F.lit(None).cast("date")
    keyed = seen.select(
        F.lit(feed.dataset).alias("dataset"), F.lit(release_id).alias("release_id"), key.alias("record_key"), F.lit(feed.jurisdiction).alias("jurisdiction"),
        F.flatten(F.transform(raw_names, lambda n: F.split(n, "[|;]"))).alias("_raw"), products.alias("product_keys"), date.alias("event_date"), "payload", "source_file", "digest", "copies",
    )
    parts = keyed.select("digest", F.posexplode("_raw").alias("at", "raw")).filter("trim(raw) <> ''")
    normal = parts.select("raw").distinct().withColumn("name", norm_name("raw"))
    named = parts.join(normal, "raw").filter(fits_key(F.col("name"))).groupBy("digest", "name").agg(F.min("at").alias("at"))
    names = named.groupBy("digest").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "name"))), lambda n: n["name"]).alias("substance_names"))
    out = keyed.drop("_raw").join(names, "digest", "left").withColumn("substance_names", F.coalesce("substance_names", none))
    counters = keyed.agg(
        F.sum("copies").alias("rows"), (F.sum("copies") - F.count("*")).alias("exact_duplicates"), F.count_distinct("record_key").alias("keys"),
        (F.count("*") - F.count_distinct("record_key")).alias("key_conflicts"), F.count_if(F.col("event_date").isNull()).alias("undated"),
    )
    return out, counters


def check_counts(counters: DataFrame, declared: int | None) -> None:
    """Raises for no rows, or if the distinct keys differ from the declared total."""
    row = counters.head()
    if not row["rows"]:
        raise ValueError("the feed has no rows")
    if declared is not None and row["keys"] != declared:
        raise ValueError(f"{row['keys']} keys, but {declared} are declared")

"""Substance records of the regulator's dictionary: moiety, preferred name and cross references, in columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from galenus.functions.ids import fits_key, norm_name
from galenus.sources.archives import stream_json_items

SCHEMA = (
    "unii string, names array<struct<name:string,preferred:boolean>>, codes array<struct<code_system:string,code:string>>, "
    "relationships array<struct<type:string,related_substance:struct<unii:string>>>"
)
# The relationship that names a moiety, and the code systems that are kept, with their id type.
ACTIVE_MOIETY = "ACTIVE MOIETY"
SYSTEMS = {"RXCUI": "rxcui", "WHO-ATC": "atc"}


def clean(value: Column) -> Column:
    """Without NUL and outer space; null if nothing is left."""
    bare = F.trim(F.translate(value, "\0", ""))
    return F.when(bare != "", bare)


def other_moieties(unii: Column, relationships: Column) -> Column:
    """The related substances that are an active moiety and not the record itself, in order."""
    related = F.transform(F.filter(relationships, lambda r: r["type"] == ACTIVE_MOIETY), lambda r: clean(r["related_substance"]["unii"]))
    return F.filter(related, lambda u: u.isNotNull() & ~u.eqNullSafe(clean(unii)))


def moiety_of(unii: Column, relationships: Column) -> Column:
    """The first other active moiety, else the record's own code."""
    return F.coalesce(F.get(other_moieties(unii, relationships), F.lit(0)), clean(unii))


def preferred_name(names: Column) -> Column:
    """The first name that is flagged as preferred, else the first; blank ones don't count."""
    filled = F.filter(names, lambda n: clean(n["name"]).isNotNull())
    flagged = F.filter(filled, lambda n: F.coalesce(n["preferred"], F.lit(False)))
    return clean(F.coalesce(F.get(flagged, F.lit(0))["name"], F.get(filled, F.lit(0))["name"]))


def read_substances(spark: SparkSession, path: str) -> DataFrame:
    """Records of JSON files or zipped ones, streamed item by item."""
    return stream_json_items(spark, path, SCHEMA).select("source_file", "item.*")


def substance_rows(records: DataFrame) -> DataFrame:
    """(unii, name, moiety_unii, several) of the records that have a code; ``several`` marks more than one other moiety."""
    own, rel = F.col("unii"), F.col("relationships")
    rows = records.select(clean(own).alias("unii"), preferred_name(F.col("names")).alias("name"), moiety_of(own, rel).alias("moiety_unii"), F.coalesce(F.size(F.array_distinct(other_moieties(own, rel))) > 1, F.lit(False)).alias("several"))
    return rows.filter("unii is not null")


def cross_references(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((unii, id_type, id_value) without repeats, names that are too long for a key).

    Names are normalised by way of their distinct values; codes keep their
    form but for ATC codes, which are upper case.
    """
    own = clean(F.col("unii")).alias("unii")
    held = records.filter(clean(F.col("unii")).isNotNull())
    named = held.select(own, F.explode("names").alias("n")).select("unii", clean(F.col("n.name")).alias("raw")).filter("raw is not null")
    values = named.select("raw").distinct().withColumn("id_value", norm_name("raw"))
    named = named.join(values, "raw").filter("id_value <> ''").select("unii", F.lit("name").alias("id_type"), "id_value")
    fits = fits_key(F.col("id_value"))
    kind = F.create_map(*(F.lit(x) for pair in SYSTEMS.items() for x in pair))
    coded = held.select(own, F.explode("codes").alias("c")).select("unii", F.try_element_at(kind, F.col("c.code_system")).alias("id_type"), clean(F.col("c.code")).alias("code"))
    coded = coded.filter("id_type is not null and code is not null").select("unii", "id_type", F.when(F.col("id_type") == "atc", F.upper("code")).otherwise(F.col("code")).alias("id_value"))
    itself = held.select(own, F.lit("unii").alias("id_type"), own.alias("id_value"))
    return named.filter(fits).unionByName(coded).unionByName(itself).distinct(), named.filter(~fits)

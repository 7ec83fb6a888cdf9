"""Recalled lots: substances of a recall by three routes, its lots, and matches with reported lots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galenus.functions import lots
from galenus.functions.ids import is_real_lot


def names_by_code(recalls: DataFrame, products: DataFrame) -> DataFrame:
    """(recall_number, names): distinct substance names of the nine-digit products in the recall. ``products``: product_key, name."""
    keys = recalls.select("recall_number", F.explode(lots.ndc_products(F.concat_ws(" ", "description", "code_info"))).alias("product_key")).distinct()
    return keys.join(products, "product_key").groupBy("recall_number").agg(F.array_sort(F.collect_set("name")).alias("names"))


def names_by_unii(recalls: DataFrame, substances: DataFrame) -> DataFrame:
    keys = recalls.select("recall_number", F.explode("uniis").alias("unii")).distinct()
    return keys.join(substances.select("unii", "name").filter("name is not null"), "unii").groupBy("recall_number").agg(F.array_sort(F.collect_set("name")).alias("names"))


def names_by_text(recalls: DataFrame, known: DataFrame) -> DataFrame:
    """(recall_number, names): leftmost longest runs of words that are ``known`` names (name, normalised). All distinct grams are looked up once."""
    words = recalls.select("recall_number", lots.name_words(F.col("description")).alias("ws"))
    grams = words.select("recall_number", F.explode_outer(lots.name_grams(F.col("ws"))).alias("g")).filter("g is not null").select("recall_number", "g.pos", "g.n", "g.gram")
    found = lots.normalised_grams(grams).join(known.select(F.col("name").alias("gram")).distinct(), "gram", "left_semi")
    ordered = found.groupBy("recall_number").agg(F.array_sort(F.collect_list(F.struct("pos", (-F.col("n")).alias("short"), "n", "gram"))).alias("known"))
    return ordered.select("recall_number", lots.pick_names(F.col("known")).alias("names")).filter(F.size("names") > 0)


def names_with_a_key(found: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of ``found`` (recall_number, names) of which some name is ``known`` (name). All their names stay."""
    named = found.select("recall_number", F.explode("names").alias("name"))
    hit = named.join(known.select("name").distinct(), "name", "left_semi").select("recall_number").distinct()
    return found.join(hit, "recall_number", "left_semi")


def substances_of_recalls(recalls: DataFrame, products: DataFrame, substances: DataFrame, known: DataFrame) -> DataFrame:
    """(recall_number, names, substance_method) by the first route whose names have a key.

    Routes in order: openfda (the recall's own names, or those of its substance
    codes if it has none), ndc (names of the product codes in its texts),
    product_text (known names in its description). A route none of whose names
    is ``known`` gives way to the next; recalls that none ties to a key are left out.
    """
    own = recalls.filter(F.size("substance_names") > 0).select("recall_number", F.col("substance_names").alias("names"))
    bare = recalls.filter(F.coalesce(F.size("substance_names"), F.lit(0)) <= 0)
    routes = {"openfda": own.unionByName(names_by_unii(bare, substances)), "ndc": names_by_code(recalls, products), "product_text": names_by_text(recalls, known)}
    tied = [names_with_a_key(f, known).select("recall_number", "names", F.lit(k).alias("substance_method"), F.lit(i).alias("route")) for i, (k, f) in enumerate(routes.items())]
    first = reduce(DataFrame.unionByName, tied).groupBy("recall_number").agg(F.min_by(F.struct("names", "substance_method"), "route").alias("r"))
    return first.select("recall_number", "r.names", "r.substance_method")


def recall_lots(recalls: DataFrame, products: DataFrame, substances: DataFrame, known: DataFrame, release_id: str) -> DataFrame:
    """One row per recall and lot, with the recall's substances (``substances_of_recalls``; null without a route); a recall
    without a lot has one row with method none."""
    j = recalls.join(substances_of_recalls(recalls, products, substances, known), "recall_number", "left")
    found = j.select("recall_number", F.lit(release_id).alias("release_id"), F.col("names").alias("substance_names"), "substance_method", F.explode_outer(lots.extract_lots("code_info")).alias("l"))
    return found.select("recall_number", "release_id", "substance_names", F.col("l.lot").alias("lot_raw"), F.col("l.lot_norm").alias("lot_norm"), F.coalesce("l.method", F.lit("none")).alias("method"), "substance_method")


def recall_counts(rows: DataFrame) -> DataFrame:
    """Of the rows of ``recall_lots``: recalls by substance_method (none: no route), with how many of them have a lot, and their lots."""
    per = rows.groupBy("recall_number").agg(F.first("substance_method").alias("m"), F.count("lot_norm").alias("lots"))
    return per.groupBy(F.coalesce("m", F.lit("none")).alias("substance_method")).agg(F.count("*").alias("recalls"), F.count_if(F.col("lots") > 0).alias("with_lot"), F.sum("lots").alias("lots"))


def lot_matches(recalled: DataFrame, batches: DataFrame, moiety_names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(matches, counts): recalled lots that reports of the same moiety name, with reports and first and last quarter.

    ``recalled``: recall_number, substance_names, lot_norm, method; ``batches``:
    moiety, lot, quarter, reports; ``moiety_names``: moiety, name. Placeholders
    never match. Counts cover all recalls, also when nothing matches.
    """
    named = recalled.select("recall_number", "lot_norm", "method", F.explode("substance_names").alias("name"))
    keyed = named.filter(is_real_lot(F.col("lot_norm"))).join(moiety_names, "name").select("recall_number", "lot_norm", "method", "moiety").distinct()
    hits = keyed.join(batches, (keyed.moiety == batches.moiety) & (keyed.lot_norm == batches.lot)).drop(batches.moiety)
    matches = hits.groupBy("moiety", "recall_number", "lot_norm").agg(F.sum("reports").alias("reports"), F.min("quarter").alias("first_quarter"), F.max("quarter").alias("last_quarter"))
    counts = recalled.agg(
        F.count_distinct("recall_number").alias("recalls"), F.count_distinct(F.when(F.col("lot_norm").isNotNull(), F.col("recall_number"))).alias("recalls_with_lot"),
        F.count_distinct(F.when(F.col("method") == "range", F.col("recall_number"))).alias("recalls_with_range"),
    )
    return matches, counts


def resolve_names(names: DataFrame, xref: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(name, substance_key) of all matches of distinct normalised names, and how many names matched."""
    from galenus.functions.ids import norm_name

    normal = names.select("name").distinct().withColumn("id_value", norm_name("name"))
    j = normal.join(xref.filter("id_type = 'name'").select("id_value", "substance_key"), "id_value", "left")
    counts = j.groupBy("name").agg(F.max(F.col("substance_key").isNotNull().cast("int")).alias("hit")).agg(F.count("*").alias("names"), F.sum("hit").alias("matched"))
    return j.filter("substance_key is not null").select("name", "substance_key").distinct(), counts

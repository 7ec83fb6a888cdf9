"""Safety signals: bridge of drug entries to substances, and counts of drugs, events, lots and pairs with all margins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from galenus.functions.dates import quarter_start
from galenus.functions.ids import is_real_lot

PAIR_CAP = 30

# The roles and report flags as published.
ROLES = {"1": "suspect", "2": "concomitant", "3": "interacting"}
FLAGS = {
    "serious_death": "seriousnessdeath", "serious_hospitalization": "seriousnesshospitalization", "serious_life_threatening": "seriousnesslifethreatening",
    "serious_disabling": "seriousnessdisabling", "serious_congenital": "seriousnesscongenitalanomali", "serious_other": "seriousnessother",
}


def bridge_candidates(entries: DataFrame) -> DataFrame:
    """(entry_id, rank, id_type, id_value): annotation codes (1), parts of the active substance (2), product (3).

    ``entries``: entry_id, product, active, uniis array; names are normalised by
    the caller on distinct values.
    """
    parts = F.filter(F.transform(F.split(F.coalesce("active", F.lit("")), r"[\\;|]"), lambda p: F.trim(p)), lambda p: p != "")
    one = lambda rank, kind: lambda v: F.struct(F.lit(rank).alias("rank"), F.lit(kind).alias("id_type"), v.alias("id_value"))
    product = F.filter(F.array(F.trim("product")), lambda p: p.isNotNull() & (p != ""))
    codes = F.transform(F.coalesce("uniis", F.array().cast("array<string>")), lambda u: F.upper(F.trim(u)))
    every = F.concat(F.transform(codes, one(1, "unii")), F.transform(parts, one(2, "name")), F.transform(product, one(3, "name")))
    return entries.select("entry_id", F.explode(F.array_distinct(every)).alias("c")).select("entry_id", "c.*")


def bridge(candidates: DataFrame, xref: DataFrame) -> DataFrame:
    """Distinct (entry_id, substance_key, rank): all hits of the best rank that has any."""
    hits = candidates.join(xref.select("id_type", "id_value", "substance_key"), ["id_type", "id_value"])
    best = hits.groupBy("entry_id").agg(F.min("rank").alias("rank"))
    return hits.join(best, ["entry_id", "rank"], "left_semi").select("entry_id", "substance_key", "rank").distinct()


def unbridged(entries: DataFrame, bridged: DataFrame) -> DataFrame:
    return entries.join(bridged.select("entry_id").distinct(), "entry_id", "left_anti")


def moiety_map(bridged: DataFrame, substances: DataFrame) -> DataFrame:
    """Distinct (entry_id, moiety): the active part of each substance, itself where none is known."""
    moiety = substances.select("substance_key", F.coalesce("moiety_key", "substance_key").alias("moiety"))
    return bridged.join(moiety, "substance_key").select("entry_id", "moiety").distinct()


def canonical_terms(terms: DataFrame) -> DataFrame:
    """(term_id, canonical): the least id of equal normalised terms. The least is aggregated before the join, so a common term is no one task's work."""
    least = terms.groupBy("term_norm").agg(F.min("term_id").alias("canonical"))
    same = F.col("t.term_norm").eqNullSafe(F.col("l.term_norm"))
    return terms.alias("t").join(least.alias("l"), same).select("t.term_id", "l.canonical")


def winners(reports: DataFrame) -> DataFrame:
    """One copy of each report: highest version, then latest receipt, then largest source file; nulls last."""
    order = [F.col("version").desc_nulls_last(), F.col("receipt_date").desc_nulls_last(), F.col("source_file").desc_nulls_last()]
    w = Window.partitionBy("safetyreportid").orderBy(*order)
    return reports.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def without_losers(table: DataFrame, reports: DataFrame) -> DataFrame:
    """Rows of a drug or reaction table that belong to a winning copy."""
    return table.join(winners(reports).select("safetyreportid", "source_file"), ["safetyreportid", "source_file"], "left_semi")


def dated(reports: DataFrame) -> DataFrame:
    """(rid, quarter) of reports with a date."""
    return reports.filter("receive_date is not null").select("rid", quarter_start(F.col("receive_date")).alias("quarter"))


def drug_rows(reports: DataFrame, drugs: DataFrame, entry_moiety: DataFrame) -> DataFrame:
    """(rid, quarter, moiety, role, lot): drug rows of dated reports per moiety; rows without a moiety vanish."""
    return drugs.join(entry_moiety, "entry_id").join(dated(reports), "rid").select("rid", "quarter", "moiety", "role", "lot")


def report_moieties(rows: DataFrame) -> DataFrame:
    """(rid, quarter, moiety, suspect): a salt and its base in one report are one moiety; a null role isn't suspect.

    Dealt by report, so that all later groupings within a report need no further shuffle.
    """
    suspect = F.bool_or(F.coalesce(F.col("role") == "suspect", F.lit(False)))
    return rows.repartition("rid").groupBy("rid", "quarter", "moiety").agg(suspect.alias("suspect"))


def listed_reports(moieties: DataFrame, cap: int = PAIR_CAP) -> DataFrame:
    """(rid, quarter, n, items, over_cap); a report over the cap carries no items, and no array outgrows the cap."""
    w = Window.partitionBy("rid", "quarter").orderBy("moiety")
    ranked = moieties.withColumn("k", F.row_number().over(w))
    some = F.collect_list(F.when(F.col("k") <= cap, F.struct("moiety", "suspect")))
    lists = ranked.groupBy("rid", "quarter").agg(F.max("k").cast("long").alias("n"), some.alias("items"))
    return lists.select("rid", "quarter", "n", F.when(F.col("n") <= cap, F.col("items")).alias("items"), (F.col("n") > cap).alias("over_cap"))


def pair_quarter(moieties: DataFrame, cap: int = PAIR_CAP) -> DataFrame:
    """Ordered pairs a <> b of a report's moieties per quarter: reports with either role, and with a as suspect.

    Each report's short array is unnested twice in place: no join, and partial
    aggregation before the one shuffle of pairs.
    """
    first = listed_reports(moieties, cap).select("quarter", "items", F.explode("items").alias("x"))
    pairs = first.select("quarter", F.col("x.moiety").alias("a"), F.col("x.suspect").alias("s"), F.explode("items").alias("y")).select("quarter", "a", "s", F.col("y.moiety").alias("b"))
    return pairs.filter("a <> b").groupBy("a", "b", "quarter").agg(F.count_if("s").alias("reports_suspect"), F.count("*").alias("reports_any"))


def moiety_quarter(moieties: DataFrame) -> DataFrame:
    return moieties.groupBy("moiety", "quarter").agg(F.count_if("suspect").alias("reports_suspect"), F.count("*").alias("reports_any"))


def report_terms(reports: DataFrame, reactions: DataFrame, canonical: DataFrame) -> DataFrame:
    """Distinct (rid, quarter, term) with canonical terms."""
    return reactions.join(canonical, "term_id").join(dated(reports), "rid").select("rid", "quarter", F.col("canonical").alias("term")).distinct()


def event_quarter(moieties: DataFrame, terms: DataFrame) -> DataFrame:
    """Reports per moiety, term and quarter, any role and suspect."""
    j = moieties.join(terms.select("rid", "term"), "rid")
    return j.groupBy("moiety", "term", "quarter").agg(F.count_if("suspect").alias("reports_suspect"), F.count("*").alias("reports_any"))


def term_quarter(terms: DataFrame) -> DataFrame:
    return terms.groupBy("term", "quarter").agg(F.count("*").alias("reports"))


def quarter_totals(reports: DataFrame, moieties: DataFrame, terms: DataFrame, cap: int = PAIR_CAP) -> DataFrame:
    """Per quarter: dated reports, those with a moiety, those over the pair cap, those with a reaction."""
    all_ = dated(reports).groupBy("quarter").agg(F.count("*").alias("reports"))
    sizes = moieties.groupBy("rid", "quarter").agg(F.count("*").alias("n"))
    listed = sizes.groupBy("quarter").agg(F.count("*").alias("reports_listed"), F.count_if(F.col("n") > cap).alias("reports_over_pair_cap"))
    reacted = terms.select("rid", "quarter").distinct().groupBy("quarter").agg(F.count("*").alias("reports_with_reaction"))
    out = all_.join(listed, "quarter", "left").join(reacted, "quarter", "left")
    return out.na.fill(0, ["reports_listed", "reports_over_pair_cap", "reports_with_reaction"])


def batch_coverage(rows: DataFrame) -> DataFrame:
    """Drug rows per moiety and quarter, and those with a real lot."""
    return rows.groupBy("moiety", "quarter").agg(F.count("*").alias("drug_rows"), F.count_if(is_real_lot(F.col("lot"))).alias("rows_with_lot"))


def batch_quarter(rows: DataFrame) -> DataFrame:
    """Distinct reports per moiety, real lot and quarter."""
    return rows.filter(is_real_lot(F.col("lot"))).groupBy("moiety", "lot", "quarter").agg(F.count_distinct("rid").alias("reports"))


def rebuild(reports: DataFrame, drugs: DataFrame, reactions: DataFrame, entry_moiety: DataFrame, canonical: DataFrame, cap: int = PAIR_CAP) -> dict[str, DataFrame]:
    """The seven signal tables from two shared inputs; write those first (or cache them) when all seven are needed."""
    rows = drug_rows(reports, drugs, entry_moiety)
    moieties, terms = report_moieties(rows), report_terms(reports, reactions, canonical)
    return {
        "batch_coverage": batch_coverage(rows), "batch_quarter": batch_quarter(rows), "pair_quarter": pair_quarter(moieties, cap), "moiety_quarter": moiety_quarter(moieties),
        "event_quarter": event_quarter(moieties, terms), "term_quarter": term_quarter(terms), "quarter_totals": quarter_totals(reports, moieties, terms, cap),
    }


def shape_reports(raw: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(reports, drugs, reactions) of parsed report structs with columns report and source_file; positions count from 1.

    Flags: 1 is true, 2 false; a missing one is false if any flag of the report
    is known. A missing overall flag is true if any part is.
    """
    from galenus.functions import dates, ids
    from galenus.functions.json import sorted_names

    blank = lambda c: F.nullif(F.trim(F.translate(c, "\0\x1f", " ")), F.lit(""))
    r = lambda f: F.col(f"report.{f}")
    known = r("serious").isNotNull()
    for f in FLAGS.values():
        known = known | r(f).isNotNull()
    flag = lambda c: F.when(F.trim(c) == "1", True).when(F.trim(c) == "2", False).when(c.isNull() & known, False)
    parts = {k: flag(r(f)) for k, f in FLAGS.items()}
    any_part = F.lit(False)
    for p in parts.values():
        any_part = any_part | F.coalesce(p, F.lit(False))
    received, receipt = dates.strict_date(r("receivedate")), dates.strict_date(r("receiptdate"))
    first = dates.first_receipt(received, receipt)
    rid, year = blank(r("safetyreportid")), F.year(first)
    reports = raw.select(
        rid.alias("safetyreportid"), year.alias("receive_year"), first.alias("receive_date"), receipt.alias("receipt_date"), received.alias("source_receive_date"),
        dates.bounded_int(r("safetyreportversion")).alias("version"), F.when(r("serious").isNull() & known, any_part).otherwise(flag(r("serious"))).alias("serious"),
        *(p.alias(k) for k, p in parts.items()), F.coalesce(blank(r("occurcountry")), blank(r("primarysourcecountry")), blank(r("primarysource.reportercountry"))).alias("country"),
        blank(r("patient.patientsex")).alias("sex"), dates.age_years(r("patient.patientonsetage"), r("patient.patientonsetageunit")).alias("age_years"),
        dates.measure(r("patient.patientweight")).alias("weight_kg"), "source_file",
    )
    d = raw.select(rid.alias("safetyreportid"), year.alias("receive_year"), "source_file", F.posexplode("report.patient.drug").alias("at", "d"))
    names, uniis = sorted_names(F.col("d.openfda.substance_name")), sorted_names(F.col("d.openfda.unii"))
    some = lambda a: F.when(F.size(a) > 0, a)
    notes = F.to_json(F.struct(some(names).alias("substance_name"), some(uniis).alias("unii")))
    published = F.array_join(sorted_names(F.transform(F.col("d.activesubstance"), lambda s: s["activesubstancename"])), "; ")
    lot = ids.norm_lot(blank(F.col("d.drugbatchnumb")))
    roles = F.create_map(*(F.lit(x) for kv in ROLES.items() for x in kv))
    drugs = d.select(
        "safetyreportid", (F.col("at") + 1).alias("seq"), "receive_year", F.try_element_at(roles, F.trim("d.drugcharacterization")).alias("role"),
        blank(F.col("d.medicinalproduct")).alias("product_name"),
        F.coalesce(F.nullif(published, F.lit("")), F.nullif(F.array_join(names, "; "), F.lit("")), F.lower(F.regexp_replace(blank(F.col("d.medicinalproduct")), r"\s+", " "))).alias("active_substance"),
        F.nullif(notes, F.lit("{}")).alias("annotation"), blank(F.col("d.drugbatchnumb")).alias("batch_number"), F.when(ids.fits_key(lot), lot).alias("batch_norm"),
        F.coalesce(~ids.fits_key(lot), F.lit(False)).alias("batch_norm_too_long"), blank(F.col("d.drugadministrationroute")).alias("route"), blank(F.col("d.drugindication")).alias("indication"), "source_file",
    )
    e = raw.select(rid.alias("safetyreportid"), year.alias("receive_year"), "source_file", F.posexplode("report.patient.reaction").alias("at", "e"))
    reactions = e.select("safetyreportid", (F.col("at") + 1).alias("seq"), "receive_year", blank(F.col("e.reactionmeddrapt")).alias("term"), blank(F.col("e.reactionoutcome")).alias("outcome"), "source_file")
    return reports, drugs, reactions


def margins(a: DataFrame, moiety: int, term: int) -> DataFrame:
    """The 2x2 table (a, b, c, d) of one drug and one event from the stored margins, summed over quarters.

    ``a``: one frame with columns kind (event, moiety, term, total) and n.
    """
    s = a.groupBy().pivot("kind", ["event", "moiety", "term", "total"]).agg(F.sum("n"))
    return s.select(
        F.lit(moiety).alias("moiety"), F.lit(term).alias("term"), F.col("event").alias("a"), (F.col("moiety") - F.col("event")).alias("b"),
        (F.col("term") - F.col("event")).alias("c"), (F.col("total") - F.col("moiety") - F.col("term") + F.col("event")).alias("d"),
    )

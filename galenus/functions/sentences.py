"""Declarative sentences of structured records, from fixed templates; a clause goes with its field."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from galenus.functions.text import normalize_whitespace


def _clause(value: Column, *parts: Column | str) -> Column:
    """The parts if ``value`` is neither null nor empty, else nothing."""
    whole = F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    return F.when(F.coalesce(value, F.lit("")) != "", whole).otherwise("")


def general_number(value: Column) -> Column:
    """Six significant digits without trailing zeros, with an exponent from 1e+06 on and below 1e-04, as ``%g`` prints."""
    v = value.cast("double")
    power = F.floor(F.log10(F.abs(v))).cast("int")
    scaled = F.round(v / F.pow(F.lit(10.0), power), 5)
    power = F.when(F.abs(scaled) >= 10, power + 1).otherwise(power)
    scaled = F.when(F.abs(scaled) >= 10, scaled / 10).otherwise(scaled)
    trim = lambda s: F.regexp_replace(F.regexp_replace(s, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    exponent = F.concat(trim(F.format_string("%.5f", scaled)), F.lit("e"), F.when(power < 0, "-").otherwise("+"), F.lpad(F.abs(power).cast("string"), 2, "0"))
    plain = F.lit(None).cast("string")
    for p in range(-4, 6):
        plain = F.when(power == p, trim(F.format_string(f"%.{5 - p}f", v))).otherwise(plain)
    return F.when(v.isNull(), F.lit(None)).when(v == 0, "0").when(power.between(-4, 5), plain).otherwise(exponent)


def bioactivity(compound: Column, smiles: Column, endpoint: Column, relation: Column, value: Column, units: Column, target: Column, organism: Column, assay: Column) -> Column:
    number = F.concat(F.when(relation == "=", "").otherwise(F.coalesce(relation, F.lit(""))), general_number(value))
    return F.concat(
        F.lit("Compound "), F.coalesce(compound, F.lit("unknown compound")), _clause(smiles, " (SMILES ", smiles, ")"),
        F.lit(" exhibits "), F.coalesce(endpoint, F.lit("an activity")),
        F.coalesce(F.concat(F.lit(" = "), number, _clause(units, " ", units)), F.lit("")),
        _clause(target, " against ", target, _clause(organism, " (", organism, ")")),
        F.lit(", as reported in the ChEMBL curated bioactivity database"),
        _clause(F.trim(assay), " (assay: ", F.regexp_replace(F.trim(assay), r"\.+$", ""), ")"), F.lit("."),
    )


def variant(variation_id: Column, name: Column, significance: Column, phenotype: Column, accession: Column) -> Column:
    subject = F.when(F.coalesce(name, F.lit("")) != "", F.concat(F.lit("Variant "), name)).otherwise(F.concat(F.lit("ClinVar variation "), variation_id.cast("string")))
    return F.concat(
        subject, _clause(significance, " is classified ", significance), _clause(phenotype, " for ", phenotype),
        _clause(accession, ", per ClinVar accession ", accession), F.lit(", as catalogued in the NCBI ClinVar database."),
    )


def compound(cid: Column, smiles: Column, iupac: Column, title: Column, formula: Column) -> Column:
    said = F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(p), c)) for p, c in (("IUPAC name ", iupac), ("molecular formula ", formula), ("canonical SMILES ", smiles)))))
    n = F.size(said)
    body = F.when(n == 1, F.get(said, F.lit(0))).otherwise(F.concat(F.array_join(F.slice(said, F.lit(1), F.greatest(n - 1, F.lit(0))), ", "), F.lit(", and "), F.element_at(said, F.when(n > 0, -1).otherwise(1))))
    subject = F.concat(F.lit("PubChem compound CID "), cid.cast("string"), _clause(title, " (", title, ")"))
    return F.concat(subject, F.when(n > 0, F.concat(F.lit(" has "), body)).otherwise(""), F.lit(", as catalogued in the NCBI PubChem Compound database."))


def pathway(name: Column, species: Column, summation: Column, sample: Column, total: Column) -> Column:
    shown = F.size(F.split(sample, ", "))
    members = F.when(
        F.coalesce(sample, F.lit("")) != "",
        F.concat(F.lit(" Known protein participants include "), sample, F.when(total > shown, F.concat(F.lit(", among "), total.cast("string"), F.lit(" annotated in total."))).otherwise(".")),
    ).otherwise("")
    start = F.concat(F.lit("Reactome pathway "), name, F.lit(" ("), species, F.lit(")"))
    return F.concat(start, F.when(F.coalesce(summation, F.lit("")) != "", F.concat(F.lit(". "), summation)).otherwise("."), members, F.lit(" As catalogued in the Reactome pathway database."))


def protein(entry: Column, description: Column, organism: Column, gene: Column, sequence: Column) -> Column:
    return F.format_string("Protein %s (%s) in organism %s is encoded by gene %s. Its amino acid sequence is: %s", entry, description, organism, gene, sequence)


def descriptor(name: Column, scope_note: Column) -> Column:
    return normalize_whitespace(F.concat(_clause(name, name, "."), _clause(scope_note, " ", scope_note), F.lit(" As defined in the NLM Medical Subject Headings (MeSH) thesaurus.")))


def term(name: Column, definition: Column) -> Column:
    return F.concat_ws(": ", F.when(name != "", name), F.when(definition != "", definition))


def question_prompt(question: Column, options: Column, explanation: Column, answer: Column) -> Column:
    """A worked multiple-choice example; ``options`` is an array of texts."""
    listed = F.array_join(F.transform(options, lambda o, i: F.concat(F.char(i + 65), F.lit(". "), o)), "\n")
    return F.concat(F.lit("Question: "), question, F.lit("\n"), listed, F.lit("\nReasoning: "), F.coalesce(explanation, F.lit("")), F.lit("\nAnswer: "), answer)

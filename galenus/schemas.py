"""Fixed schemas of stored rows."""

from __future__ import annotations

SCHEMA_VERSION = "1"

ARTICLE = (
    "id string, source string, source_file string, source_record_id string, pmid string, pmcid string, doi string, title string, abstract string, "
    "body_text string, text string, authors array<string>, journal string, year int, mesh array<string>, publication_types array<string>, language string, "
    "license string, license_url string, license_raw string, subset string, is_retracted boolean, extract_status string, extract_notes string, "
    "retrieved_at timestamp, content_hash string, pmc_version string, is_manuscript boolean, is_historical_ocr boolean, pdf_url string, container_id string, book_meta string"
)

EDGES = {
    "mesh": "pmid string, descriptor_ui string, descriptor_name string, major_topic boolean, qualifier_uis array<string>, qualifiers array<string>, source_file string",
    "cites": "src_pmid string, dst_pmid string, dst_doi string, ref_text string, source_file string",
    "comments": "pmid string, ref_type string, ref_pmid string, ref_text string, source_file string",
    "chemicals": "pmid string, substance_ui string, name string, registry_number string, source_file string",
    "keywords": "pmid string, keyword string, owner string, major_topic boolean, source_file string",
    "authors": "pmid string, position int, last_name string, fore_name string, initials string, collective_name string, orcid string, affiliations array<string>, source_file string",
}

REPORT = (
    "safetyreportid string, receive_year int, receive_date date, receipt_date date, source_receive_date date, version int, serious boolean, serious_death boolean, "
    "serious_hospitalization boolean, serious_life_threatening boolean, serious_disabling boolean, serious_congenital boolean, serious_other boolean, country string, "
    "sex string, age_years double, weight_kg double, source_file string"
)
DRUG = (
    "safetyreportid string, seq int, receive_year int, role string, product_name string, active_substance string, annotation string, batch_number string, "
    "batch_norm string, batch_norm_too_long boolean, route string, indication string, source_file string"
)
REACTION = "safetyreportid string, seq int, receive_year int, term string, outcome string, source_file string"
SUBSTANCE = "substance_key long, unii string, name string, moiety_unii string, moiety_key long"
SUBSTANCE_XREF = "substance_key long, id_type string, id_value string, source string"
REG_RECORD = (
    "dataset string, release_id string, record_key string, jurisdiction string, substance_names array<string>, product_keys array<string>, event_date date, "
    "payload string, source_file string, load_seq long"
)
RELEASE = "dataset string, release_id string, is_latest boolean, row_count long, source_file string"
CODE = "system_key string, release_id string, code string, label string, is_latest boolean"
AUDIT = (
    "seq long, recorded_at timestamp, actor string, host string, pid int, run_id string, code_version string, event_type string, object string, "
    "input_content_hash string, rows_affected long, old_value string, new_value string, reason string, prev_hash string, record_hash string"
)

"""Each operator and stage on nulls, empty and long texts, ties, repeated rows, empty tables and clashing extra columns."""

from __future__ import annotations

import hashlib

import pyarrow as pa
import pytest

pytest.importorskip("galenus.llm")

from pyspark.sql import functions as F  # noqa: E402

import corpus_pipeline  # noqa: E402
from galenus.llm import decontamination, html, language, licenses, media, packing, pii, secrets, simhash, toxicity  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp long, row string, key long, window string, item string, spans string"
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def rows(texts):
    return [(i, t, "en", "s", len(t or ""), 1, "r", 2, "w", "i", "x") for i, t in texts]


LONG = " ".join(f"word{i % 997}" for i in range(60_000))
TEXTS = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "short"), (5, LONG), (6, "the same text in three rows of this table, word for word"), (7, "the same text in three rows of this table, word for word"),
    (8, "repeated row"), (8, "repeated row"), (None, "no id here"), (None, None), (9, "token = \"abcdef123456\" and mail me@example.org now"), (10, "ÄÖÜ ßéà 你好 \U0001f600 ok"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(TEXTS), DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def bench(spark):
    items = [(1, "word10 word11 word12 word13 word14 word15 word16 word17 word18 word19 word20"), (2, None), (3, ""), (None, "no id here"), (4, "short"), (4, "short")]
    return spark.createDataFrame([(i, t, "clash", 7) for i, t in items], "item_id long, text string, doc_id string, key long")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(5, 1, 0, "t"), (6, 1, 1, "t"), (6, 1, 1, "t"), (None, 1, 1, "t"), (4, None, None, "t"), (99, 1, 1, "t")], "doc_id long, quality int, toxic int, text string")


def test_personal_data(docs, none):
    got = pii.find_personal_data(docs).collect()
    assert len(got) == len(TEXTS)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[1].base_sha256 == by[2].base_sha256 == EMPTY_SHA and by[1].spans == ""
    assert by[9].n_email == 1 and by[9].spans == "email:32:46"
    assert pii.find_personal_data(none).count() == 0


def test_licenses(docs, none):
    got = licenses.license_scan(docs).collect()
    assert len(got) == len(TEXTS) and all(r.n_notices == 0 and r.license is None for r in got)
    assert licenses.license_scan(none).count() == 0


def test_simhash(docs, none):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(TEXTS)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[1].fingerprint == by[2].fingerprint == by[3].fingerprint == "0" * 16
    assert by[1].component_id == by[2].component_id == by[3].component_id == 1 and by[7].component_id == 6
    assert {r.component_id for r in got if r.doc_id is None} == {1, None} or {r.component_id for r in got if r.doc_id is None} == {1}
    assert simhash.near_duplicates(none).count() == 0
    kept = [r.doc_id for r in simhash.keep_representatives(docs).collect()]
    assert sorted(k for k in kept if k is not None) == [1, 4, 5, 6, 8, 9, 10] and kept.count(None) == 2
    assert simhash.keep_representatives(docs).columns == docs.columns


def test_media(docs, none):
    got = media.media_features(docs).collect()
    assert len(got) == len(TEXTS)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[1].n_bytes == 0 and by[1].payload_bytes == 64 and by[1].payload_sha256 == hashlib.sha256(bytes(64)).hexdigest()
    assert by[6].media_sha256 == by[7].media_sha256
    assert media.media_features(none).count() == 0


def test_packing(docs, none):
    got = packing.pack(docs).collect()
    totals = {}
    for r in got:
        totals[(r.doc_id, r.doc_tokens)] = totals.get((r.doc_id, r.doc_tokens), 0) + r.length
    assert totals[(1, 1)] == 1 and totals[(2, 1)] == 1
    assert sum(r.length for r in got) == sum(len(packing.encode(t or "")) for _, t in TEXTS)
    assert packing.pack(none).count() == 0


def test_toxicity(docs, none, labels):
    got = toxicity.severity(docs, labels).collect()
    assert len(got) == len(TEXTS) and not any(r.toxic for r in got if r.doc_id in (1, 2, 3))
    assert toxicity.severity(none, labels).count() == 0
    assert toxicity.severity(docs, labels.limit(0)).filter("toxic").count() == 0
    assert toxicity.keep_civil(docs, labels).columns == docs.columns


def test_html(spark):
    pages = spark.createDataFrame([(1, "u", None, "x"), (2, None, "", "x"), (None, "u", "<p>text", "x"), (3, "u", "<p>a &amp; b</p>" * 3000, "x"), (3, "u", "<p>a &amp; b</p>" * 3000, "x")], "page_id long, url string, html string, text string")
    got = html.extract_main_text(pages).collect()
    assert len(got) == 5
    by = {r.page_id: r for r in got}
    assert by[1].text == by[2].text == "" and by[1].n_chars == 0 and by[None].text == "text" and by[3].text.count("a & b") == 3000
    assert html.extract_main_text(pages.limit(0)).count() == 0


def test_html_aside_in_unmarked_text():
    text = "<div>" + "<p>first part of it</p>" * 5
    aside = "<aside><ul><li>one<li>two<li>three</ul></aside>"
    rest = "<p>the rest</p>" * 2 + "</div>"
    want = "\n".join(["first part of it"] * 5 + ["the rest"] * 2)
    nav = "<nav><a href=/>Home</a><p>x<p>y<p>z</nav>"
    assert html.main_text(nav + text + aside + rest + "<footer>f</footer>") == want
    assert html.main_text(nav + text + aside * 3 + rest + "<footer>f</footer>") == want


def test_html_layout_names():
    text = "<p>some text of the page</p>" * 3
    want = "\n".join(["some text of the page"] * 3)
    for name in ("has-sidebar", "no-comments", "with-header", "no-share", "page_with_right_sidebar", "sidebar-left"):
        assert html.main_text(f"<div id='page' class='{name}'><article>{text}</article><div class='ad-slot'>buy</div></div>") == want
        assert html.main_text(f"<div id='page' class='{name}'><div>{text}</div><div class='ad-slot'>buy</div></div>") == want
    assert html.main_text(f"<div class=sidebar><main>{text}</main></div><div>{text * 3}</div>") == want
    # names still count where they call no layout: an advert, comments and related cards, even long ones
    assert html.main_text(f"<div>{text}</div><div class='ad-slot'>buy</div>") == want
    assert html.main_text(f"<div>{text}</div><div class='comments-area'><article>{'I think so. ' * 40}</article></div>") == want
    assert html.main_text(f"<div>{text}</div><div class='related'><article>card</article></div>") == want


def test_decontamination(docs, none, bench):
    got = decontamination.contamination(docs, bench).collect()
    assert len(got) == len(TEXTS)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[1].n_words == 0 and not by[1].contaminated and by[1].items_sha256 == EMPTY_SHA
    assert by[4].n_hit == 1 and by[4].n_items == 1 and by[4].items_sha256 == hashlib.sha256(b"4").hexdigest()
    assert by[5].n_hit == 11 * (60_000 // 997) + (11 if 60_000 % 997 > 20 else 0) and by[5].n_items == 1
    unnamed = [r for r in got if r.doc_id is None]
    assert sorted(r.n_hit for r in unnamed) == [0, 3] and {r.items_sha256 for r in unnamed} == {EMPTY_SHA, hashlib.sha256(b"null").hexdigest()}
    assert decontamination.contamination(none, bench).count() == 0
    assert decontamination.contamination(docs, bench.limit(0)).filter("contaminated").count() == 0
    kept = decontamination.keep_clean(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {1, 2, 3, 6, 7, 8, 9, 10, None}


def test_language(docs, none, spark):
    got = language.identify_languages(docs).collect()
    assert len(got) == len(TEXTS)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[1].lang_pred == by[2].lang_pred == by[3].lang_pred == "und" and by[1].score == 0 and 0 <= by[5].score <= 1
    assert language.identify_languages(none).count() == 0
    unknown = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify_languages(unknown).collect()} == {"und"}


def test_language_of_long_runs():
    model = language.BackoffModel(["de", "en"], [0.0, 0.0], {}, {"x": [5, 5], "q": [1, 9], "z": [9, 1]})
    assert [lang for lang, _ in model.predict(["x" * 100 + "q" * 30, "q" * 30 + "x" * 100])] == ["en", "en"]
    assert model.predict(["z" * 64 + "q" * 5000])[0][0] == "en"
    batch = pa.RecordBatch.from_pydict({"lang": ["en"], "text": ["a" * 100 + "b"]})
    keys = {k for b in language._counted(iter([batch])) for k in b.column(1).to_pylist()}
    assert {"gb", "gaaaab", "gb "} <= keys


def test_secrets(docs, none):
    got = secrets.find_secrets(docs).collect()
    assert len(got) == len(TEXTS)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[1].spans == "" and by[1].base_sha256 == EMPTY_SHA and by[9].spans == "assign:0:21"
    assert secrets.find_secrets(none).count() == 0
    masked = secrets.mask_secrets(docs)
    assert masked.columns == docs.columns and masked.count() == len(TEXTS)
    hidden = masked.filter("doc_id = 9").head()
    assert hidden.text.startswith('[SECRET]" and mail') and hidden.n_chars == len(hidden.text)
    assert masked.filter("doc_id = 1").head().text is None


def test_private_keys_are_masked_whole(spark):
    begin, end, full = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----", "MIIEowIBAAKCAQEA+/bC" * 3 + "wxyz"
    head = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,AB12\n\n"
    cases = {
        f"a\n{begin}\n{head}{full}\n{full}\nQUJD==\n{end}\nplain words": "a\n[SECRET]\nplain words",
        f"{begin}\n{full}\n{full}\nQUJD==\nplain words follow": "[SECRET]\nplain words follow",
        f"{begin}\r\n{head}{full}\r\n{full}": "[SECRET]",
        f"{begin} is a header of plain words": "[SECRET] is a header of plain words",
        f'key: "{begin}\\n{full}\\n{full}\\nQUJD\\n{end}\\n" b': 'key: "[SECRET]\\n" b',
        f'key: "{begin}\\n{full}\\nQUJD" b': 'key: "[SECRET]" b',
        f"\U0001f600 {begin}\n{full}\nand plain words\n{begin}\n{full}\n{end} c": "\U0001f600 [SECRET]\nand plain words\n[SECRET] c",
        f"{begin}\n" + f"{full}\n" * 1000 + "plain words": "[SECRET]\nplain words",
        f"{begin}\n" + f"{full}\n" * 5000 + end + " d": "[SECRET] d",
        f"{begin}\n" + f"{full}\n" * 60_000 + "plain - words": "[SECRET]\nplain - words",
        f"{begin}\n" + "a - b " * 60_000 + end + " e": "[SECRET] e",
        f"{begin}\n" + "plain - words " * 5000: "[SECRET]\n" + "plain - words " * 5000,
    }
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(cases)], "doc_id long, text string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in secrets.mask_secrets(docs).collect()}
    assert got == {i: (t, len(t)) for i, t in enumerate(cases.values())}


def test_stages_keep_the_columns(spark, docs, sf):
    base = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for table in (base, base.limit(0)):
            out = stage(spark, table, sf)
            assert out.columns == base.columns
            assert out.count() <= table.count()


def test_stages_on_null_ids_repeats_and_empty_texts(spark, docs, sf):
    """What each stage leaves of the edge cases: null ids and the rest of each group stay, repeats of one id become one row."""
    now = docs.select("doc_id", "text", "lang", "source", "n_chars")
    ids = {"toxicity": [1, 2, 3, 4, 5, 6, 7, 8, 8, 9, 10], "simhash": [1, 4, 5, 6, 8, 9, 10], "decontamination": [1, 4, 5, 6, 8, 9, 10], "secrets": [1, 4, 5, 6, 8, 9, 10]}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, sf)
        rows = now.collect()
        assert sorted(r.doc_id for r in rows if r.doc_id is not None) == ids[name] and sum(r.doc_id is None for r in rows) == 2
    texts = {r.doc_id: r.text for r in rows if r.doc_id is not None}
    assert texts[1] is None and texts[9].startswith("[SECRET]") and texts[5] == LONG and texts[10] == TEXTS[-1][1]
    packed = corpus_pipeline.STAGES[-1][1](spark, now, sf).collect()
    assert sum(r.length for r in packed) == sum(len(packing.encode(r.text or "")) for r in rows)


def test_clashing_columns(spark, sf):
    """Extra columns named like the results change none of them."""
    base = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").limit(40)
    more = base.select("*", *(F.lit("x").alias(c) for c in ("held_out", "lang_pred", "score", "licenses", "license", "spans", "words", "grams", "places", "found", "notices", "best", "row", "seen", "base", "n_found", "fp", "key", "at", "known")))
    for f in (language.identify_languages, licenses.license_scan, pii.find_personal_data, secrets.find_secrets, simhash.near_duplicates):
        assert sorted(map(str, f(base).collect())) == sorted(map(str, f(more).collect()))

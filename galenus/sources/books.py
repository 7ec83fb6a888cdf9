"""Book packages: a row for the book and one for each part with content, nested parts too."""

from __future__ import annotations

import io
import json
import re
import tarfile
from collections.abc import Iterator
from pathlib import PurePosixPath
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame

from galenus.functions.markup import local, safe_xml
from galenus.functions.text import MIN_OK_CHARS

# Elements of the book schema, and titles of parts that hold no content.
ROOTS, PARTS, META = ("book", "book-part-wrapper", "book-part", "book-app"), ("book-part", "book-app"), ("book-part-meta", "book-app-meta")
FURNITURE = re.compile(r"copyright|index|table of contents", re.I)
SCHEMA = "id string, source_file string, source_record_id string, container_id string, title string, text string, year int, license_raw string, book_meta string, error string"


def flat(el: ET.Element | None) -> str:
    return "" if el is None else " ".join("".join(el.itertext()).split())


def child(el: ET.Element | None, *names: str) -> ET.Element | None:
    return next((c for c in el if local(c.tag) in names), None) if el is not None else None


def below(el: ET.Element | None, *names: str) -> ET.Element | None:
    return next((c for c in el.iter() if local(c.tag) in names), None) if el is not None else None


def has_content(title: str, body: ET.Element | None) -> bool:
    """A part counts if its body has text, its title is no furniture, and its body is more than an index of short lines."""
    if not flat(body) or FURNITURE.fullmatch(title.strip()):
        return False
    only = list(body)
    if len(only) == 1 and local(only[0].tag) == "index":
        return any(len(flat(p)) >= MIN_OK_CHARS for p in only[0].iter() if local(p.tag) == "p")
    return True


def parts_of(root: ET.Element) -> Iterator[dict]:
    """The parts with content, depth first. A part that holds others has their text too, and they have rows of their own."""
    for part in (e for e in root.iter() if local(e.tag) in PARTS):
        meta, body = child(part, *META), child(part, "body")
        title = flat(below(meta, "title"))
        if has_content(title, body):
            yield {"id": part.get("id") or flat(below(meta, "book-part-id")) or None, "title": title or None, "text": flat(body), "license_raw": flat(below(meta, "license")) or None}


def book_fields(root: ET.Element) -> dict:
    """What the book-level member says: title, text of contents and front (else the abstract), year, licence and particulars."""
    meta = below(root, "book-meta")
    text = "\n\n".join(filter(None, (flat(child(root, "toc")), flat(child(root, "front"))))) or flat(child(meta, "abstract"))
    year = re.search(r"(?:19|20)\d\d", flat(below(meta, "year")) or flat(below(meta, "pub-date")))
    editors = [flat(n) for c in (meta.iter() if meta is not None else ()) if local(c.tag) == "contrib" and c.get("contrib-type") == "editor" for n in c if local(n.tag) in ("name", "collab")]
    about = {"isbn": flat(below(meta, "isbn")) or None, "editors": editors or None, "publisher": flat(below(meta, "publisher-name")) or None, "edition": flat(below(meta, "edition")) or None}
    return {"title": flat(below(meta, "book-title")) or None, "text": text or None, "year": int(year[0]) if year else None, "license_raw": flat(below(meta, "license")) or None, "about": about, "has_meta": meta is not None}


def _unique(ident: str, stem: str, taken: set[str]) -> str:
    """A part id that a package repeats gets the name of its member, and a number if that repeats too."""
    names = (n for k in range(1, len(taken) + 3) for n in ([ident, f"{ident}__{stem}"] if k == 1 else [f"{ident}__{stem}_{k}"]))
    got = next(n for n in names if n not in taken)
    taken.add(got)
    return got


def package_rows(name: str, data: bytes) -> list[dict]:
    """The book's row and its parts' rows. The member named like the package is the book's; else the first with book
    metadata, else the first. Members that are no book documents are listed."""
    key = re.sub(r"\.(?:tar\.gz|tgz|tar)$", "", PurePosixPath(name).name)
    documents, skipped = [], []
    with tarfile.open(fileobj=io.BytesIO(data), mode="r:*") as archive:
        for member in archive:
            if member.isfile() and member.name.endswith((".nxml", ".xml")):
                root = safe_xml(archive.extractfile(member).read())
                (documents if local(root.tag) in ROOTS else skipped).append((member.name, root))
    if not documents:
        raise ValueError("no book document in the package")
    fields = [(PurePosixPath(n).stem, book_fields(root)) for n, root in documents]
    book = min(fields, key=lambda f: (f[0] != key, not f[1]["has_meta"]))[1]
    rows, taken = [], set()
    for n, root in documents:
        for part in parts_of(root):
            native = part["id"] or f"part{len(rows) + 1}"
            ident = _unique(native, PurePosixPath(n).stem, taken)
            rows.append({"id": f"book:{key}:{ident}", "source_record_id": native, "container_id": f"book:{key}", "title": part["title"], "text": part["text"], "license_raw": part["license_raw"] or book["license_raw"], "year": book["year"]})
    about = {**book["about"], "n_parts": len(rows), **({"skipped_members": [n for n, _ in skipped]} if skipped else {})}
    whole = {"id": f"book:{key}", "source_record_id": key, "title": book["title"], "text": book["text"], "license_raw": book["license_raw"], "year": book["year"], "book_meta": json.dumps(about, ensure_ascii=False)}
    return [{**r, "source_file": name} for r in (whole, *rows)]


def parse_books(files: DataFrame) -> DataFrame:
    """Rows (SCHEMA) of binary tar packages (path, content); a package that can't be read is a row with its error."""
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, content in zip(b["path"], b["content"], strict=True):
                try:
                    rows = package_rows(path, content)
                except Exception as e:
                    rows = [{"source_file": path, "error": f"{type(e).__name__}: {e}"}]
                table = pd.DataFrame(rows, columns=names, dtype=object)
                yield table.where(table.notna(), None)

    return files.select("path", "content").mapInPandas(parse, SCHEMA)

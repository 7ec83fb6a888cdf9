"""Archives: members of zip and tar files, JSON documents inside them, and workbooks."""

from __future__ import annotations

import io
import itertools
import json
import re
import tarfile
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A member beyond this size is reported, not read.
MAX_MEMBER_BYTES = 1 << 30

MEMBER_SCHEMA = "source_file string, member string, content binary, error string"


def _zip_members(data: bytes, suffix: str) -> Iterator[tuple[str, bytes | None, str | None]]:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        for i in z.infolist():
            if i.is_dir() or not i.filename.endswith(suffix):
                continue
            yield (i.filename, None, "too large") if i.file_size > MAX_MEMBER_BYTES else (i.filename, z.read(i), None)


def _tar_members(data: bytes, suffix: str) -> Iterator[tuple[str, bytes | None, str | None]]:
    with tarfile.open(fileobj=io.BytesIO(data), mode="r:*") as t:
        for i in t:
            if i.isfile() and i.name.endswith(suffix):
                yield (i.name, None, "too large") if i.size > MAX_MEMBER_BYTES else (i.name, t.extractfile(i).read(), None)


def read_members(spark: SparkSession, path: str, suffix: str = "", nested: bool = False) -> DataFrame:
    """One row per archive member; with ``nested``, members of the archives inside. A damaged archive is a row with an error."""

    def members(name: str, data: bytes) -> Iterator[tuple]:
        kind = _zip_members if data[:2] == b"PK" else _tar_members
        inner = ".zip" if nested else suffix
        try:
            for member, content, error in kind(data, inner):
                if nested and content is not None:
                    yield from ((name, f"{member}!{m}", c, e) for m, c, e in _zip_members(content, suffix))
                else:
                    yield name, member, content, error
        except (zipfile.BadZipFile, tarfile.TarError, OSError, EOFError) as e:
            yield name, None, None, f"{type(e).__name__}: {e}"

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, data in zip(b["path"], b["content"], strict=True):
                for row in members(name, data):
                    yield pd.DataFrame([row], columns=["source_file", "member", "content", "error"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(parse, MEMBER_SCHEMA)


def json_items(members: DataFrame, schema: str, field: str = "results") -> DataFrame:
    """Items of an array field of JSON members, each parsed with ``schema``."""
    doc = F.from_json(F.decode("content", "UTF-8"), f"{field} array<struct<{schema}>>")
    return members.filter("content is not null").select("source_file", "member", F.explode(doc[field]).alias("item"))


def read_json_feed(spark: SparkSession, path: str, schema: str, field: str = "data") -> DataFrame:
    raw = spark.read.schema(f"{field} array<struct<{schema}>>").option("multiLine", "true").json(path)
    return raw.select(F.explode(field).alias("item"), F.col("_metadata.file_path").alias("source_file"))


def array_items(chunks: Iterator[str], field: str) -> Iterator[str]:
    """The items of the first array under ``field`` of a JSON document that arrives in pieces, each as its JSON text.

    Only the item at hand is held, so a document may be of any size. ValueError
    if the document ends within the array.
    """
    decoder, opening = json.JSONDecoder(), re.compile(rf'"{re.escape(field)}"\s*:\s*\[')
    closing = re.compile(r"\s*[,\]]")
    held, inside, seen = "", False, 0
    for chunk in chunks:
        held += chunk
        if not inside:
            m = opening.search(held, max(0, seen - len(field) - 64))
            if m is None:
                seen = len(held)
                keep = len(field) + 1024
                held, seen = held[-keep:], min(seen, keep)
                continue
            held, inside, seen = held[m.end() :], True, 0
        at = 0
        while True:
            start = re.compile(r"[\s,]*").match(held, at).end()
            if held[start : start + 1] == "]":
                return
            if len(held) < seen:  # the last try needed more than this
                break
            try:
                _, end = decoder.raw_decode(held, start)
            except ValueError:
                seen = 2 * (len(held) - start)
                break
            if not closing.match(held, end):  # a number may go on
                break
            yield held[start:end]
            at, seen = end, 0
        held = held[at:]
    if inside:
        tail = held.strip().lstrip(",").strip()
        while tail and not tail.startswith("]"):
            _, end = decoder.raw_decode(tail)
            yield tail[:end]
            tail = tail[end:].strip().lstrip(",").strip()
        if not tail:
            raise ValueError(f"the array {field} doesn't end")


def stream_json_items(spark: SparkSession, path: str, schema: str, field: str = "results", piece: int = 1 << 20) -> DataFrame:
    """(source_file, item) of the array ``field`` of JSON files and of the JSON members of zip files, item by item.

    A task opens its file through the store of the URL and holds one piece and
    one item at a time, so that documents of gigabytes pass. Files are tasks;
    more parallelism needs more files.
    """
    import pyarrow.fs as pafs

    def texts(url: str) -> Iterator[tuple[str, Iterator[str]]]:
        store, name = pafs.FileSystem.from_uri(url)
        with store.open_input_file(name) as f:
            if url.endswith(".zip"):
                with zipfile.ZipFile(f) as z:
                    for i in z.infolist():
                        if i.filename.endswith(".json"):
                            with z.open(i) as m:
                                yield f"{url}!{i.filename}", iter(lambda r=io.TextIOWrapper(m, "utf-8"): r.read(piece), "")
            else:
                yield url, iter(lambda r=io.TextIOWrapper(f, "utf-8"): r.read(piece), "")

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for url in b["path"]:
                for name, chunks in texts(url):
                    items = array_items(chunks, field)
                    while rows := list(itertools.islice(items, 500)):
                        yield pd.DataFrame({"source_file": name, "json": rows})

    files = spark.read.format("binaryFile").load(path).select("path")
    listed = files.repartition(max(1, files.count()), "path")
    return listed.mapInPandas(parse, "source_file string, json string").select("source_file", F.from_json("json", schema).alias("item"))


def read_workbook(data: bytes, known: set[str], least: int = 3) -> pd.DataFrame:
    """The sheet below the first row that holds ``least`` known column names; repeated names get a suffix. Needs openpyxl."""
    try:
        import openpyxl
    except ImportError as e:
        raise RuntimeError("reading workbooks needs openpyxl") from e
    rows = openpyxl.load_workbook(io.BytesIO(data), read_only=True).active.iter_rows(values_only=True)
    for row in rows:
        names = [str(c or "").strip() for c in row]
        if len(known & {n.lower() for n in names}) >= least:
            return pd.DataFrame([r for r in rows if any(v is not None for v in r)], columns=unique_names(names))
    raise ValueError("no header row")


def unique_names(names: list[str]) -> list[str]:
    seen: dict[str, int] = {}
    out = []
    for n in names:
        seen[n] = seen.get(n, 0) + 1
        out.append(n if seen[n] == 1 else f"{n}_{seen[n]}")
    return out


def read_code_zip(spark: SparkSession, path: str, member: str, system: str, code: str, label: str) -> DataFrame:
    """(system_key, code, label) of a CSV member of zip files. Each member is parsed whole, so quoted line breaks stay."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for content in b["content"]:
                got = pd.read_csv(io.BytesIO(content), dtype=str, keep_default_na=False, na_values=[""], usecols=[code, label])
                yield pd.DataFrame({"system_key": system, "code": got[code], "label": got[label]})

    held = read_members(spark, path, member).filter("content is not null").select("content")
    return held.mapInPandas(parse, "system_key string, code string, label string")


def read_code_json(spark: SparkSession, path: str, system: str, field: str = "content") -> DataFrame:
    """(system_key, code, label) of JSON lists of terms."""
    raw = spark.read.schema(f"{field} array<struct<code:string,english:string,status:string>>").option("multiLine", "true").json(path)
    return raw.select(F.explode(field).alias("t")).filter("t.code is not null").select(F.lit(system).alias("system_key"), "t.code", F.col("t.english").alias("label"))

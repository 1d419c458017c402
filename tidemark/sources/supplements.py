"""Supplement files: delimited tables, JSON, XML, ZIP and DOCX, from Spark's binaryFile rows (path, content)."""

from __future__ import annotations

import csv
import io
import json
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame

from tidemark.shared import ship
from tidemark.sources.payloads import walk

#: Usual column headers and the field that they stand for.
HEADERS = {"sample": "samp_name", "sample id": "samp_name", "sample name": "samp_name", "latitude": "decimalLatitude", "lat": "decimalLatitude", "longitude": "decimalLongitude", "lon": "decimalLongitude", "depth": "depth", "depth (m)": "depth", "date": "eventDate", "collection date": "eventDate", "temperature": "temp", "salinity": "salinity", "ph": "ph", "biosample": "biosample_accession", "accession": "biosample_accession"}
MOST_BYTES = 50_000_000
CELLS = "path string, member string, row int, field string, locator string, value string"


def decoded(data: bytes) -> str:
    try:
        return data.decode("utf-8-sig")
    except UnicodeDecodeError:
        return data.decode("latin-1")


def letters(n: int) -> str:
    out = ""
    while n >= 0:
        n, r = divmod(n, 26)
        out, n = chr(65 + r) + out, n - 1
    return out


def delimited(text: str, sep: str) -> Iterator[tuple[int, str, str, str]]:
    """Cells below the first row of two or more cells, under their header's field; captions above it are skipped."""
    rows = list(csv.reader(io.StringIO(text), delimiter=sep))
    top = next((i for i, r in enumerate(rows) if sum(bool(c.strip()) for c in r) > 1), None)
    if top is None:
        return
    heads = [re.sub(r"\s+", " ", h.strip().lower().replace("_", " ")) for h in rows[top]]
    for i, row in enumerate(rows[top + 1 :], top + 2):
        for j, cell in enumerate(row[: len(heads)]):
            if cell.strip() and heads[j]:
                yield i, HEADERS.get(heads[j], heads[j]), f"{letters(j)}{i}", cell.strip()


def xml_leaves(data: bytes) -> Iterator[tuple[str, str, str]]:
    def go(e: ElementTree.Element, path: str) -> Iterator[tuple[str, str, str]]:
        tag = e.tag.rpartition("}")[2]
        here = f"{path}/{tag}"
        if len(e):
            for c in e:
                yield from go(c, here)
        elif (e.text or "").strip():
            yield tag, here, e.text.strip()

    yield from go(ElementTree.fromstring(data), "")


def docx_text(data: bytes) -> str:
    """Paragraphs of a Word document, by its main part."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        root = ElementTree.fromstring(z.read("word/document.xml"))
    w = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    return "\n".join("".join(t.text or "" for t in p.iter(f"{w}t")) for p in root.iter(f"{w}p"))


class Skipped(str):
    """Why a member isn't read."""


def members(name: str, data: bytes, most: int = MOST_BYTES) -> Iterator[tuple[str, bytes | Skipped]]:
    """The file itself, or a ZIP's members within the cap by declared and by actual size. Larger ones and nested archives come
    as Skipped, so that none goes unseen."""
    if not name.lower().endswith(".zip"):
        yield name, data
        return
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        for info in z.infolist():
            if info.is_dir():
                continue
            if info.filename.lower().endswith((".zip", ".gz", ".tar", ".7z", ".rar")):
                yield info.filename, Skipped("nested")
                continue
            if info.file_size > most:
                yield info.filename, Skipped("too_large")
                continue
            with z.open(info) as f:
                part = f.read(most + 1)
            yield info.filename, part if len(part) <= most else Skipped("too_large")


def parsed(name: str, data: bytes | Skipped) -> Iterator[tuple[int, str, str, str]]:
    low = name.lower()
    if isinstance(data, Skipped):
        yield 0, "skipped", "", str(data)
    elif low.endswith((".csv", ".tsv", ".txt")):
        text = decoded(data)
        yield from delimited(text, "\t" if low.endswith(".tsv") or text.count("\t") > text.count(",") else ",")
    elif low.endswith(".json"):
        yield from ((0, k, p, v) for k, p, v in walk(json.loads(data)))
    elif low.endswith(".xml"):
        yield from ((0, k, p, v) for k, p, v in xml_leaves(data))
    elif low.endswith(".docx"):
        yield from ((i, "text", f"P{i:03d}", t) for i, t in enumerate(docx_text(data).split("\n"), 1) if t.strip())
    elif low.endswith((".xlsx", ".xls")):
        for sheet, frame in pd.read_excel(io.BytesIO(data), sheet_name=None, header=None, dtype=str).items():  # needs a reader that may be missing
            yield from ((i, f, f"{sheet}!{at}", v) for i, f, at, v in delimited(frame.to_csv(index=False, header=False), ","))


def cells(files: DataFrame) -> DataFrame:
    """(path, member, row, field, locator, value) of binaryFile rows; a file that can't be read gives one row with the field
    "unreadable" and the error's kind as its value, and a member that isn't read one with "skipped" and why."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for path, content in zip(b["path"], b["content"], strict=True):
                try:
                    out += [(path, m, *c) for m, data in members(path, bytes(content)) for c in parsed(m, data)]
                except Exception as e:  # noqa: BLE001  any damage in a file from outside
                    out.append((path, path, 0, "unreadable", "", type(e).__name__))
            yield pd.DataFrame(out, columns=["path", "member", "row", "field", "locator", "value"])

    ship(files.sparkSession)
    return files.select("path", "content").mapInPandas(run, CELLS)

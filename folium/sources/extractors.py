"""Layout JSON of extractors as a data source: spark.read.format("layout").

`.json` files hold one document each, `.jsonl` files, or all files of a folder so named, one a line. A partition is a range of files or of a file's bytes.
"""

from __future__ import annotations

import hashlib
import json
import posixpath
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from folium.sources.layout import ELEMENT, LABELS

_BOX = pa.struct([(k, pa.float64()) for k in ("x0", "y0", "x1", "y1")])
_ARROW = pa.schema([("doc_id", pa.int64()), ("pos", pa.int32()), ("page_number", pa.int32()), ("physical_page_index", pa.int32()), ("kind", pa.string()), ("text", pa.string()), ("level", pa.int32()), ("bbox", _BOX), ("metadata", pa.map_(pa.string(), pa.string()))])
#: Bytes of files in one partition.
RANGE = 32 << 20
#: Elements in one batch.
ROWS = 4096


def doc_id_of(name: str, place: int = 0) -> int:
    """A 64-bit number for a document that has none: of its file's name and where in the file it begins."""
    return int.from_bytes(hashlib.blake2b(f"{name}#{place}".encode(), digest_size=8).digest(), "big", signed=True)


def _element(extractor: str, label: str, text: str | None, page: int, level: int | None, box: dict | None, notes: dict) -> dict | None:
    kind = LABELS[extractor].get(label, "other")
    text = (text or "").strip()
    if not text and kind not in ("table", "figure"):
        return None
    return {"page_number": page, "physical_page_index": max(page - 1, 0), "kind": kind, "text": text, "level": level, "bbox": box, "metadata": [(k, str(v)) for k, v in notes.items() if v is not None]}


def docling_elements(doc: dict) -> Iterator[dict]:
    """Items of a document tree in reading order: what its body's references name, groups walked through."""
    waiting = list(reversed((doc.get("body") or {}).get("children") or []))
    seen = set()
    while waiting:
        ref = waiting.pop().get("$ref", "")
        if ref in seen:
            continue
        seen.add(ref)
        _, _, rest = ref.partition("#/")
        kind, _, index = rest.partition("/")
        items = doc.get(kind) or []
        if not index.isdigit() or int(index) >= len(items):
            continue
        item = items[int(index)]
        waiting += reversed(item.get("children") or [])
        if kind == "groups":
            continue
        label = str(item.get("label") or "other").lower()
        text, marker = (item.get("text") or "").strip(), (item.get("marker") or "").strip()
        if marker and not text.startswith(marker):
            text = f"{marker} {text}"
        place = next(iter(item.get("prov") or []), {})
        box = place.get("bbox")
        box = box and {a: float(box.get(b) or 0) for a, b in zip(("x0", "y0", "x1", "y1"), "ltrb", strict=True)}
        found = _element("docling", label, text, place.get("page_no") or 0, item.get("level"), box, {"docling_label": label, "self_ref": item.get("self_ref")})
        if found:
            yield found


def unstructured_elements(doc: list | dict) -> Iterator[dict]:
    """Elements of a list, or of the list under `elements`."""
    for item in doc if isinstance(doc, list) else doc.get("elements") or []:
        notes = item.get("metadata") or {}
        points = (notes.get("coordinates") or {}).get("points") or []
        xs, ys = [float(p[0]) for p in points], [float(p[1]) for p in points]
        box = {"x0": min(xs), "y0": min(ys), "x1": max(xs), "y1": max(ys)} if points else None
        label = item.get("type") or "UncategorizedText"
        found = _element("unstructured", label, item.get("text"), int(notes.get("page_number") or 0), None, box, {"unstructured_category": label})
        if found:
            yield found


VENDORS = {"docling": docling_elements, "unstructured": unstructured_elements}


def kind_of_file(path: str) -> str | None:
    """The ending of a file, or of the folder that it lies in (as Spark writes files), if it is one that is read."""
    for name in reversed(path.rsplit("/", 2)[-2:]):
        for kind in (".json", ".jsonl"):
            if name.endswith(kind):
                return kind
    return None


@dataclass
class Range(InputPartition):
    """Bytes of a file: those documents whose line begins in it; a whole file where the end is its size and the start 0."""

    parts: list[tuple[str, int, int]]


def ranges(files: list[tuple[str, int]], size: int = RANGE) -> list[list[tuple[str, int, int]]]:
    """(path, size) of files as lists of (path, start, end) of about `size` bytes; only .jsonl files are cut."""
    out, now, left = [], [], size
    for path, length in sorted(files):
        lines = kind_of_file(path) == ".jsonl"
        for start in range(0, max(length, 1), size) if lines else [0]:
            end = min(length, start + size) if lines else length
            now.append((path, start, end))
            left -= end - start
            if left <= 0:
                out.append(now)
                now, left = [], size
    return out + [now] * bool(now)


def _documents(store: fs.FileSystem, path: str, start: int, end: int) -> Iterator[tuple[int, str]]:
    """Where each document of a range begins, and its text."""
    with store.open_input_file(path) as raw:
        if kind_of_file(path) != ".jsonl":
            yield 0, raw.read().decode()
            return
        at = max(start - 1, 0)
        raw.seek(at)
        rest, first = b"", start > 0  # up to the first line end behind start - 1 the line began before
        while at < end:
            block = raw.read(1 << 20)
            lines = (rest + block).split(b"\n")
            rest = lines.pop() if block else b""
            for line in lines:
                if not first and at < end and line.strip():
                    yield at, line.decode()
                first = False
                at += len(line) + 1
            if not block:
                return


class LayoutReader(DataSourceReader):
    def __init__(self, options: dict):
        self.extractor, self.size = options.get("extractor", ""), int(options.get("rangebytes", RANGE))
        if self.extractor not in VENDORS:
            raise ValueError(f"unknown extractor {self.extractor!r}; known: {sorted(VENDORS)}")
        if not options.get("path"):
            raise ValueError("the layout source needs a path")
        self.path = options["path"]

    def _store(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path) if ":" in self.path.partition("/")[0] else (fs.LocalFileSystem(), posixpath.abspath(self.path))

    def partitions(self) -> list[Range]:
        store, top = self._store()
        info = store.get_file_info(top)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        found = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(top, recursive=True))
        files = [(f.path, f.size) for f in found if f.type == fs.FileType.File and kind_of_file(f.path) and not f.base_name.startswith(("_", "."))]
        return [Range(p) for p in ranges(files, self.size)] or [Range([])]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        store, _ = self._store()
        rows: list[dict] = []
        for path, start, end in partition.parts:
            for place, text in _documents(store, path, start, end):
                try:
                    doc = json.loads(text)
                except ValueError:  # what can't be parsed counts as not extracted
                    continue
                known = doc.get("doc_id") if isinstance(doc, dict) else None
                doc_id = known if isinstance(known, int) else doc_id_of(posixpath.basename(path), place)
                for pos, element in enumerate(VENDORS[self.extractor](doc)):
                    rows.append({"doc_id": doc_id, "pos": pos, **element})
                    if len(rows) == ROWS:
                        yield pa.RecordBatch.from_pylist(rows, _ARROW)
                        rows = []
        yield pa.RecordBatch.from_pylist(rows, _ARROW)


class LayoutSource(DataSource):
    """Elements (doc_id, pos, page_number, ...) of vendors' layout JSON.

    Options: path (a file or folder; any that Arrow can open), extractor (docling or unstructured), rangeBytes. A document's
    id is its `doc_id`, else a hash of its file's name and place. Elements are numbered from 0 in reading order.
    """

    @classmethod
    def name(cls) -> str:
        return "layout"

    def schema(self) -> str:
        return f"struct<doc_id:bigint, pos:int, {ELEMENT.removeprefix('struct<')}"

    def reader(self, schema) -> LayoutReader:
        return LayoutReader({k.lower(): v for k, v in self.options.items()})


def register(spark: SparkSession) -> None:
    spark.dataSource.register(LayoutSource)


def read(spark: SparkSession, path: str, extractor: str):
    register(spark)
    return spark.read.format("layout").option("extractor", extractor).load(path)


READERS = {name: partial(read, extractor=name) for name in VENDORS}

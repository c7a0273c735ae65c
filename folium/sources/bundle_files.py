"""Bundle files as a data source: spark.write.format("bundle") and spark.read.format("bundle").

A bundle is one file, {slug}--{day}--v{n}.json, with its SHA-256 beside it. Tasks write into a staging folder; the files
come to their place when all tasks are done, and nothing of a job that fails stays. The driver sees names folder by folder
only, and keeps of each bundle a few bytes.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import os
import posixpath
import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.window import Window

from folium.functions.text import slug
from folium.sources.bundles import next_versions

# The size from which a bundle is compressed, and how files are named.
GZIP_BYTES = 25 * 1024 * 1024
NAME = r"^([a-z0-9._-]+)--(\d{8})--v(\d+)\.json(\.gz)?$"
STATES = ("ok", "mismatch", "missing")
#: Files that the driver moves at once.
MOVES = 16
#: Bundles in one folder of staging.
FOLDER = 2000
#: Bytes of files in one partition, and files at most.
RANGE, RANGE_FILES = 32 << 20, 5000


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":" in path.partition("/")[0] else (fs.LocalFileSystem(), posixpath.abspath(path))


def _write(store: fs.FileSystem, path: str, payload: bytes) -> None:
    with store.open_output_stream(path, compression=None) as out:
        out.write(payload)


def _read(store: fs.FileSystem, path: str) -> bytes:
    with store.open_input_file(path) as raw:
        return raw.read()


def _listed(store: fs.FileSystem, folder: str) -> Iterator[tuple[str, int]]:
    """(name, bytes) of the bundles in a folder; those of a local one one by one, others as Arrow lists them, at once."""
    if isinstance(store, fs.LocalFileSystem):
        with os.scandir(folder) as found:
            yield from ((f.name, f.stat().st_size) for f in found if re.match(NAME, f.name) and f.is_file())
    else:
        found = store.get_file_info(fs.FileSelector(folder))
        yield from ((f.base_name, f.size) for f in found if re.match(NAME, f.base_name) and f.type == fs.FileType.File)


def _plain(name: str) -> str:
    return name.removesuffix(".gz")


def _key(plain: str) -> bytes:
    return hashlib.blake2b(plain.encode(), digest_size=8).digest()


@dataclass
class Written(WriterCommitMessage):
    """The folder of a task's attempt, how many folders of bundles are in it, and a hash of 8 bytes of each name."""

    folder: str
    parts: int
    keys: bytes


class BundleWriter(DataSourceWriter):
    def __init__(self, options: dict):
        if not options.get("path"):
            raise ValueError("the bundle source needs a path")
        self.path, self.threshold = options["path"].rstrip("/"), int(options.get("gzipbytes", GZIP_BYTES))
        self.job = uuid.uuid4().hex
        store, top = _store(self.path)
        store.create_dir(self._staging(top), recursive=True)

    def _staging(self, top: str) -> str:
        return f"{top}/_staging-{self.job}"

    def write(self, rows: Iterator) -> Written:
        store, top = _store(self.path)
        # an attempt has a folder of its own, so that one begun twice can't spoil the other's files; it is not made where
        # the job's folder is gone, so that an attempt that outlives an aborted job leaves nothing
        folder, part, seen = f"{self._staging(top)}/{uuid.uuid4().hex}", "", set()
        store.create_dir(folder, recursive=False)
        for row in rows:
            plain = name = f"{row['slug']}--{row['day']}--v{row['version']}.json"
            if not re.match(NAME, name):
                raise ValueError(f"not the name of a bundle: {name!r}")
            payload = (json.dumps(json.loads(row["json"]), ensure_ascii=False, indent=2) + "\n").encode()
            if len(payload) > self.threshold:
                name, payload = f"{name}.gz", gzip.compress(payload, mtime=0)
            if plain in seen:
                raise FileExistsError(f"bundles exist already, or twice in one write: {[plain]}")
            if len(seen) % FOLDER == 0:
                part = f"{folder}/{len(seen) // FOLDER}"
                store.create_dir(part, recursive=False)
            _write(store, f"{part}/{name}", payload)
            _write(store, f"{part}/{name}.sha256", f"{hashlib.sha256(payload).hexdigest()}  {name}\n".encode())
            seen.add(plain)
        return Written(folder, -(-len(seen) // FOLDER), b"".join(map(_key, seen)))

    def commit(self, messages: list[Written | None]) -> None:
        store, top = _store(self.path)
        done = [m for m in messages if m is not None]
        parts = [f"{m.folder}/{k}" for m in done for k in range(m.parts)]
        keys = np.sort(np.frombuffer(b"".join(m.keys for m in done), np.uint64))
        alike = {k.tobytes() for k in keys[1:][keys[1:] == keys[:-1]]}
        taken, asked = [], Counter()
        for part in parts:
            names = [_plain(n) for n, _ in _listed(store, part)]
            there = store.get_file_info([f"{top}/{n}{end}" for n in names for end in ("", ".gz")])
            taken = (taken + [_plain(f.base_name) for f in there if f.type == fs.FileType.File])[:5]
            asked.update(n for n in names if alike and _key(n) in alike)
        twice = sorted({*taken, *(n for n, k in asked.items() if k > 1)})
        if twice:
            self.abort(messages)
            raise FileExistsError(f"bundles exist already, or twice in one write: {twice[:5]}")
        with ThreadPoolExecutor(MOVES) as pool:
            for part in parts:
                names = [n for n, _ in _listed(store, part)]
                # digests first: a bundle in its place always has one
                for suffix in (".sha256", ""):
                    list(pool.map(lambda x: store.move(*x), [(f"{part}/{n}{suffix}", f"{top}/{n}{suffix}") for n in names]))
        store.delete_dir(self._staging(top))

    def abort(self, messages: list[Written | None]) -> None:
        store, top = _store(self.path)
        if store.get_file_info(self._staging(top)).type == fs.FileType.Directory:
            store.delete_dir(self._staging(top))


@dataclass
class Files(InputPartition):
    """Names in a folder, packed: many names say nearly the same."""

    folder: str
    packed: bytes

    @classmethod
    def of(cls, folder: str, names: list[str]) -> Files:
        return cls(folder, zlib.compress("\n".join(sorted(names)).encode()))

    def names(self) -> list[str]:
        return zlib.decompress(self.packed).decode().split("\n") if self.packed else []


class BundleReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.size = options["path"], int(options.get("rangebytes", RANGE))
        self.names_only = options.get("namesonly", "false").lower() == "true"

    def partitions(self) -> list[Files]:
        store, top = _store(self.path)
        info = store.get_file_info(top)
        if self.names_only and info.type == fs.FileType.NotFound:
            return [Files(top, b"")]
        one = info.type == fs.FileType.File
        folder = posixpath.dirname(top) if one else top
        out, now, size = [], [], 0
        for name, n in ((f, n) for f, n in [(info.base_name, info.size)] if re.match(NAME, f)) if one else _listed(store, top):
            now.append(name)
            size += 0 if self.names_only else n
            if size >= self.size or len(now) >= RANGE_FILES:
                out.append(Files.of(folder, now))
                now, size = [], 0
        return [*out, Files.of(folder, now) if now else Files(folder, b"")]

    def read(self, partition: Files) -> Iterator[tuple]:
        if self.names_only:
            yield from ((name,) for name in partition.names())
            return
        store, _ = _store(self.path)
        for name in partition.names():
            path = f"{partition.folder}/{name}"
            payload = _read(store, path)
            digest = hashlib.sha256(payload).hexdigest()
            beside = store.get_file_info(f"{path}.sha256").type == fs.FileType.File
            said = _read(store, f"{path}.sha256").decode().split()[:1] if beside else []
            state = "missing" if not beside else "ok" if [x.lower() for x in said] == [digest] else "mismatch"
            try:
                text = (gzip.decompress(payload) if name.endswith(".gz") else payload).decode()
            except (OSError, EOFError, UnicodeDecodeError):
                text = None
            found = re.match(NAME, name)
            yield name, found[1], found[2], int(found[3]), text, digest, state


class BundleSource(DataSource):
    """Writes rows (slug, day, version, json) as bundle files; reads them as (name, slug, day, version, json, sha256, state).

    Options: path (any that Arrow can open), gzipBytes, rangeBytes, namesOnly. state is ok, mismatch, or missing where no
    digest lies beside a file; json is null where a file can't be decoded. Files of other names are left alone. Writing
    fails, and leaves nothing, if a bundle of that name exists or two rows have one name. With namesOnly just (name) is
    read, without opening the files, and nothing where there is no folder.
    """

    @classmethod
    def name(cls) -> str:
        return "bundle"

    def schema(self) -> str:
        if self._options().get("namesonly", "false").lower() == "true":
            return "name string"
        return "name string, slug string, day string, version int, json string, sha256 string, state string"

    def _options(self) -> dict:
        return {k.lower(): v for k, v in self.options.items()}

    def reader(self, schema) -> BundleReader:
        return BundleReader(self._options())

    def writer(self, schema, overwrite: bool) -> BundleWriter:
        if overwrite:
            raise ValueError("bundles are added, never replaced: use mode('append')")
        return BundleWriter(self._options())


class Corrupt(ValueError):
    """Bundles whose digest is missing or differs."""


def names(spark: SparkSession, path: str) -> DataFrame:
    """The names of the bundle files under a path, none where there is nothing; their contents are not read."""
    register(spark)
    return spark.read.format("bundle").option("namesOnly", "true").load(path)


def versioned(bundles: DataFrame, existing: DataFrame) -> DataFrame:
    """Bundles (code, generated_at, json) with slug, day and version: behind the highest among `existing` names, by code alone.

    Several of one code, at once, are numbered on in the order of their JSON.
    """
    rows = bundles.withColumns({"slug": slug(F.col("code")), "day": F.date_format("generated_at", "yyyyMMdd")})
    place = F.row_number().over(Window.partitionBy("slug").orderBy("generated_at", "json"))
    rows = rows.withColumn("_n", place).join(next_versions(existing), "slug", "left")
    return rows.withColumn("version", (F.coalesce("next_version", F.lit(1)) + F.col("_n") - 1).cast("int")).drop("_n", "next_version")


def register(spark: SparkSession) -> None:
    spark.dataSource.register(BundleSource)


def write(bundles: DataFrame, path: str, gzip_bytes: int = GZIP_BYTES) -> None:
    """Bundles (slug, day, version, json) as files under a path, which is made if it isn't there."""
    spark = bundles.sparkSession
    register(spark)
    store, top = _store(path)
    store.create_dir(top, recursive=True)
    # dealt by name: few bytes can be very many files, which would otherwise meet in one task
    dealt = bundles.select("slug", "day", "version", "json").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "slug", "day", "version")
    dealt.write.format("bundle").option("gzipBytes", gzip_bytes).mode("append").save(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    register(spark)
    return spark.read.format("bundle").load(path)


def checked(spark: SparkSession, path: str, skip_checksum: bool = False) -> DataFrame:
    """The bundles under a path; raises Corrupt with the first bad files unless the check is skipped."""
    rows = read(spark, path)
    if not skip_checksum:
        bad = rows.filter("state != 'ok'").select("name", "state").orderBy("name").limit(20).collect()
        if bad:
            raise Corrupt("; ".join(f"{r['name']}: {r['state']}" for r in bad))
    return rows

"""Page trees as a Python data source: ``<root>/<lang>/<book>/pages/page_0007.md`` in and out.

``spark.read.format("page_tree").load(root)`` gives lang, book, page, md; ``df.write.format("page_tree").save(root)`` writes
such rows under exactly these names. Predictions leave ``pages`` out: option ``inner=""``.

Reading: the driver lists names and sizes only and packs the files into partitions of about ``partitionBytes`` (64 MB,
each file counted with ``openCost`` bytes more), in path order; a task opens its files one by one. A partition holds its names
packed, so the driver holds some bytes a file. Equality and IN filters on
lang, book and page cut the listing itself, so other folders aren't even listed. A
listing of more files than fit a driver's memory belongs into a table (``files.write_pages``).

Writing: each task writes its files under a hidden folder of its attempt, with a list of their names beside them; the driver's
commit reads the lists line by line and renames the files into place. A task that fails or runs twice leaves nothing under the tree: what isn't committed is
removed. ``overwrite`` replaces the pages of the tree, ``append`` the pages of the same name. Names that would leave their folder
(empty, ``.``, ``..``, with a slash or null) are refused. Texts are written as they are, UTF-8; a null text as an empty file.

Paths are those of a file system that the driver and all executors mount (the tree's consumers read it as files); for
object stores use the table form.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from dataclasses import dataclass
from itertools import chain, groupby

from pyspark.sql import SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceWriter, EqualTo, In, InputPartition, WriterCommitMessage)

SCHEMA = "lang string, book string, page string, md string"
KEYS = ("lang", "book", "page")
HIDDEN = "."
NAMES = "names"                       # list of an attempt's files, a line each


@dataclass
class Files(InputPartition):
    packed: bytes

    @classmethod
    def of(cls, held):
        """Of (lang, book, page) in path order: each folder once, with its names."""
        folders = [(*k, [x[2] for x in g]) for k, g in groupby(held, lambda x: x[:2])]
        return cls(zlib.compress(json.dumps(folders).encode()))

    @property
    def rows(self) -> list[tuple]:
        return [(lang, book, page) for lang, book, pages in json.loads(zlib.decompress(self.packed)) for page in pages]


@dataclass
class Written(WriterCommitMessage):
    folder: str


def local_path(path: str) -> str:
    """The path of a mounted folder, without its scheme."""
    path = path[len("file:"):] if path.startswith("file:") else path
    if "://" in path:
        raise ValueError(f"page_tree needs a mounted folder, not {path}")
    return "/" + path.lstrip("/") if path.startswith("//") else path


def safe_name(name) -> str:
    if not isinstance(name, str) or name in ("", ".", "..") or "/" in name or "\0" in name or name.startswith(HIDDEN):
        raise ValueError(f"not a name of a folder or page: {name!r}")
    return name


def names(folder: str, wanted) -> list[str]:
    """Entries of a folder, in order; with ``wanted`` only those, looked up one by one."""
    if wanted is not None:
        return sorted(n for n in wanted if isinstance(n, str) and n and "/" not in n and n not in (".", "..") and os.path.lexists(os.path.join(folder, n)))
    return sorted(n for n in os.listdir(folder) if not n.startswith(HIDDEN)) if os.path.isdir(folder) else []


def pages_in(folder: str, wanted, suffix: str) -> list[tuple]:
    """(name, size) of the page files of a folder, in order; one pass over it, or a look at each wanted name."""
    if wanted is not None:
        at = ((n, os.path.join(folder, n)) for n in names(folder, wanted))
        return [(n, os.path.getsize(p)) for n, p in at if n.endswith(suffix) and os.path.isfile(p)]
    if not os.path.isdir(folder):
        return []
    with os.scandir(folder) as found:
        return sorted((e.name, e.stat().st_size) for e in found if not e.name.startswith(HIDDEN) and e.name.endswith(suffix) and e.is_file())


class PageTreeReader(DataSourceReader):
    def __init__(self, root: str, inner: str, suffix: str, size: int, open_cost: int):
        self.root, self.inner, self.suffix, self.size, self.open_cost = root, inner, suffix, size, open_cost
        self.wanted: dict = {}

    def pushFilters(self, filters):
        for f in filters:
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if values is None or len(f.attribute) != 1 or f.attribute[0] not in KEYS:
                yield f
                continue
            key = f.attribute[0]
            self.wanted[key] = values & self.wanted[key] if key in self.wanted else values

    def folder(self, lang: str, book: str) -> str:
        return os.path.join(self.root, lang, book, self.inner) if self.inner else os.path.join(self.root, lang, book)

    def listed(self):
        for lang in names(self.root, self.wanted.get("lang")):
            for book in names(os.path.join(self.root, lang), self.wanted.get("book")):
                for page, n in pages_in(self.folder(lang, book), self.wanted.get("page"), self.suffix):
                    yield lang, book, page, n

    def partitions(self):
        out, held, size = [], [], 0
        for lang, book, page, n in self.listed():
            if held and size + n + self.open_cost > self.size:
                out.append(Files.of(held))
                held, size = [], 0
            held.append((lang, book, page))
            size += n + self.open_cost
        return [*out, Files.of(held)] if held or not out else out

    def read(self, partition):
        for lang, book, page in partition.rows:
            with open(os.path.join(self.folder(lang, book), page), "rb") as f:
                yield lang, book, page, f.read().decode()


class PageTreeWriter(DataSourceWriter):
    def __init__(self, root: str, inner: str, overwrite: bool):
        self.root, self.inner, self.overwrite = root, inner, overwrite
        self.job = f"{HIDDEN}page-tree-{uuid.uuid4().hex}"

    def write(self, rows):
        folder = os.path.join(self.root, self.job, uuid.uuid4().hex)      # an attempt's own folder
        rows = iter(rows)
        first = next(rows, None)
        if first is None:
            return Written("")
        os.makedirs(folder)
        with open(os.path.join(folder, NAMES), "w") as listed:            # not in the commit message: the driver keeps all messages
            for i, row in enumerate(chain([first], rows)):
                lang, book, page = (safe_name(row[k]) for k in KEYS)
                if i % 1000 == 0:
                    part = os.path.join(folder, str(i // 1000))
                    os.mkdir(part)
                with open(os.path.join(part, str(i)), "wb") as f:
                    f.write((row["md"] or "").encode())
                listed.write(json.dumps([lang, book, page]) + "\n")
        return Written(folder)

    def _clear(self):
        top = os.path.join(self.root, self.job)
        for where, folders, files in os.walk(top, topdown=False):
            for n in files:
                os.remove(os.path.join(where, n))
            for n in folders:
                os.rmdir(os.path.join(where, n))
        if os.path.isdir(top):
            os.rmdir(top)

    def commit(self, messages):
        tree = PageTreeReader(self.root, self.inner, "", 1, 0)
        if self.overwrite:
            for lang, book, page, _ in tree.listed():                     # a folder is listed before its pages go
                os.remove(os.path.join(tree.folder(lang, book), page))
        folders: dict[tuple, str] = {}                                    # each is made once, not once a page
        for m in messages:
            if m is None or not m.folder:
                continue
            with open(os.path.join(m.folder, NAMES)) as listed:
                for i, line in enumerate(listed):
                    lang, book, page = json.loads(line)
                    folder = folders.get((lang, book))
                    if folder is None:
                        folder = folders[lang, book] = tree.folder(lang, book)
                        os.makedirs(folder, exist_ok=True)
                    os.replace(os.path.join(m.folder, str(i // 1000), str(i)), os.path.join(folder, page))   # whole files only, even under a reader's eyes
        self._clear()

    def abort(self, messages):
        self._clear()


class PageTree(DataSource):
    @classmethod
    def name(cls):
        return "page_tree"

    def schema(self):
        return SCHEMA

    def _root(self) -> str:
        if not self.options.get("path"):
            raise ValueError("page_tree needs a path")
        return local_path(self.options["path"])

    def reader(self, schema):
        o = self.options
        return PageTreeReader(self._root(), o.get("inner", "pages"), o.get("suffix", ".md"), int(o.get("partitionBytes", 64 << 20)), int(o.get("openCost", 1 << 16)))

    def writer(self, schema, overwrite):
        missing = [c for c in (*KEYS, "md") if c not in schema.names]
        if missing:
            raise ValueError(f"page_tree needs the columns {', '.join(missing)}")
        return PageTreeWriter(self._root(), self.options.get("inner", "pages"), overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to the session (needs ``spark.sql.python.filterPushdown.enabled`` for pruning, set here)."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PageTree)

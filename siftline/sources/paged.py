"""Saved provider pages as a Spark data source: one partition for each query group, pages followed until they end.

``folder/group=<name>/page=<n>/`` holds the files of a page, one record a line. Pages start at 1. A group ends with a page that
isn't there, one with fewer records than ``page_size`` (a short page), or page ``most_pages``; what lies beyond is not read.
As a stream, the offset is each group's next page, so a restart goes on where it stopped; a group that has ended
stays ended. Files are reached through Arrow's file systems (file, hdfs, s3, ...), by the executors and not by the driver alone.

    spark.dataSource.register(SavedPages)
    spark.read.format("saved_pages").option("page_size", 100).load("/shared/pages")
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from urllib.parse import unquote

from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "group string, page int, pos int, record string"


class _Pages(InputPartition):
    """Pages ``first`` to ``last`` (or as far as they go) of a group."""

    def __init__(self, name: str, first: int, last: int | None = None):
        super().__init__(name)
        self.name, self.first, self.last = name, first, last


class _Folder:
    """The folder's groups and pages, and the rules for where a group ends."""

    def __init__(self, options: dict[str, str]):
        if "path" not in options:
            raise ValueError("saved_pages needs a path")
        self.path, self.page_size, self.most_pages = options["path"], int(options.get("page_size", 100)), int(options.get("most_pages", 100))
        if self.page_size < 1 or self.most_pages < 0:
            raise ValueError("page_size must be 1 or more, most_pages 0 or more")

    def _store(self) -> tuple[fs.FileSystem, str]:
        uri = self.path.replace("file:/", "file:///", 1) if self.path.startswith("file:/") and not self.path.startswith("file://") else self.path
        return fs.FileSystem.from_uri(uri)

    def groups(self) -> list[str]:
        store, root = self._store()
        found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
        return sorted(i.base_name.partition("=")[2] for i in found if i.type == fs.FileType.Directory and i.base_name.startswith("group="))

    def records(self, group: str, page: int) -> Iterator[str] | None:
        """The page's records, None where there is no such page."""
        store, root = self._store()
        files = store.get_file_info(fs.FileSelector(f"{root}/group={group}/page={page}", allow_not_found=True))
        names = sorted(i.path for i in files if i.type == fs.FileType.File and not i.base_name.startswith(("_", ".")))
        return self._lines(store, names) if names else None

    @staticmethod
    def _lines(store: fs.FileSystem, names: list[str]) -> Iterator[str]:
        for name in names:
            with store.open_input_stream(name) as stream:
                rest = b""
                while chunk := stream.read(1 << 16):
                    *lines, rest = (rest + chunk).split(b"\n")
                    yield from (x.decode() for x in lines if x.strip())
                if rest.strip():
                    yield rest.decode()

    def read(self, part: _Pages | None) -> Iterator[tuple[str, int, int, str]]:
        if part is None:  # no groups
            return
        page = part.first
        while page <= self.most_pages and (part.last is None or page <= part.last):
            found = self.records(part.name, page)
            if found is None:
                return
            n = 0
            for n, record in enumerate(found, 1):  # noqa: B007
                yield unquote(part.name), page, n - 1, record
            if n < self.page_size:
                return
            page += 1

    def next_page(self, group: str, page: int) -> tuple[int, bool]:
        """The page after those that are there from ``page`` on, and whether the group has ended."""
        while page <= self.most_pages:
            found = self.records(group, page)
            if found is None:
                return page, False
            short = sum(1 for _ in found) < self.page_size
            page += 1
            if short:
                return page, True
        return page, True


class _Reader(DataSourceReader):
    def __init__(self, folder: _Folder):
        self.folder = folder

    def partitions(self) -> list[_Pages]:
        return [_Pages(g, 1) for g in self.folder.groups()]

    def read(self, partition: _Pages) -> Iterator[tuple]:
        return self.folder.read(partition)


class _Stream(DataSourceStreamReader):
    """Offsets are JSON: group to its next page, negative once it has ended."""

    def __init__(self, folder: _Folder):
        self.folder = folder
        self.at: dict[str, int] = {}

    def initialOffset(self) -> dict:
        return {"pages": "{}"}

    def latestOffset(self) -> dict:
        for group in self.folder.groups():
            page = self.at.get(group, 1)
            if page > 0:
                after, ended = self.folder.next_page(group, page)
                self.at[group] = -after if ended else after
        return {"pages": json.dumps(self.at, sort_keys=True)}

    def partitions(self, start: dict, end: dict) -> list[_Pages]:
        before, after = json.loads(start["pages"]), json.loads(end["pages"])
        self.at = {**self.at, **after}
        out = []
        for group, page in sorted(after.items()):
            first = before.get(group, 1)
            if first > 0 and abs(page) > first:
                out.append(_Pages(group, first, abs(page) - 1))
        return out

    def read(self, partition: _Pages) -> Iterator[tuple]:
        return self.folder.read(partition)

    def commit(self, end: dict) -> None:
        pass


class SavedPages(DataSource):
    """Group, page, pos and record (a line) of saved pages. Options: path, page_size, most_pages."""

    @classmethod
    def name(cls) -> str:
        return "saved_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(_Folder(self.options))

    def streamReader(self, schema) -> _Stream:
        return _Stream(_Folder(self.options))

"""Feeds of pages, newest first, as batch and streaming sources.

Pages are JSON files <path>/<column>/<n>.json in any store that pyarrow reaches by its address, each a list of announcements or an object with these
under ``announcements`` and their number under ``totalRecordNum``. Another transport overrides ``page`` of the readers.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

#: Pages of a task when their number is known.
BLOCK = 10


def stored_json(address: str, default):
    """A JSON file by its address; the default if it is missing or broken."""
    from pyarrow import fs

    try:
        store, path = fs.FileSystem.from_uri(address if "://" in address else f"file://{os.path.abspath(address)}")
        with store.open_input_stream(path) as f:
            return json.loads(f.read())
    except (OSError, ValueError):
        return default


def stamp(row: dict) -> float | None:
    """Seconds of a row's time, which may be in milliseconds."""
    t = row.get("announcementTime")
    return None if t is None else float(t) / (1000 if t > 1e12 else 1)


class _Pages(InputPartition):
    """Pages first..last of a column; of their rows, those after one time and until another."""

    def __init__(self, column: str, first: int, last: int, after: float, until: float = float("inf")):
        self.column, self.first, self.last, self.after, self.until = column, first, last, after, until


class _Feed:
    """What both readers share."""

    def __init__(self, options: dict):
        self.path, self.start = options["path"], float(options.get("start", "-inf"))
        self.columns = options.get("columns", "szse,sse").split(",")
        self.most, self.block = int(options.get("max_pages", 50)), int(options.get("block", BLOCK))

    def page(self, column: str, n: int):
        return stored_json(f"{self.path}/{column}/{n}.json", [])

    def rows(self, column: str, n: int) -> list[dict]:
        page = self.page(column, n)
        return page.get("announcements") or [] if isinstance(page, dict) else page

    def blocks(self, column: str, after: float, until: float = float("inf")) -> list[_Pages]:
        """One for all pages, or several once the feed says how many rows there are."""
        first = self.page(column, 1)
        total = first.get("totalRecordNum") if isinstance(first, dict) else None
        size = len(first.get("announcements") or []) if total else 0
        if not size:
            return [_Pages(column, 1, self.most, after, until)]
        last = min(self.most, -(-int(total) // size))
        return [_Pages(column, n, min(last, n + self.block - 1), after, until) for n in range(1, last + 1, self.block)]

    def read_pages(self, p: _Pages, cut: bool) -> Iterator[tuple]:
        """Rows up to the page whose oldest is before the window; none from a page whose newest is. cut: single rows outside are left out too."""
        for n in range(p.first, p.last + 1):
            rows = self.rows(p.column, n)
            stamps = [t for r in rows if (t := stamp(r)) is not None]
            if not rows or (stamps and max(stamps) < p.after):
                return
            for i, r in enumerate(rows):
                if not cut or (t := stamp(r)) is not None and p.after < t <= p.until:
                    yield p.column, r.get("announcementTitle"), r.get("secCode"), r.get("secName"), None if r.get("announcementTime") is None else float(r["announcementTime"]), json.dumps(r, ensure_ascii=False), n * 1000 + i
            if stamps and min(stamps) < p.after:
                return


class PagedReader(_Feed, DataSourceReader):
    """All pages of the window; pages that can't be read count as empty."""

    def partitions(self):
        return [b for c in self.columns for b in self.blocks(c, self.start)]

    def read(self, partition):
        return self.read_pages(partition, False)


class PagedStream(_Feed, DataSourceStreamReader):
    """The rows of each column after the newest time that was read: an offset is that time by column.

    Offsets are in the query's checkpoint, so a batch that failed is read again with the same limits and none is lost or read twice. A feed whose first page
    can't be read stops the query instead of looking empty. Rows that come later with a time that was read are not seen.
    """

    def initialOffset(self):
        return {c: None if self.start == float("-inf") else self.start for c in self.columns}

    def latestOffset(self):
        out = {}
        for c in self.columns:
            page = self.page(c, 1)
            if page == []:
                raise OSError(f"no first page of {c} in {self.path}")
            out[c] = max((t for r in self.rows(c, 1) if (t := stamp(r)) is not None), default=None)
        return out

    def partitions(self, start, end):
        lowest = float("-inf")
        since = {c: lowest if start.get(c) is None else start[c] for c in self.columns}
        return [b for c in self.columns if end.get(c) is not None and end[c] > since[c] for b in self.blocks(c, since[c], end[c])]

    def read(self, partition):
        return self.read_pages(partition, True)

    def commit(self, end):
        """Nothing to do: pages stay where they are."""


class PagedFeed(DataSource):
    """spark.read or spark.readStream, .format("paged_feed").option("path", ...).option("start", seconds).load()"""

    @classmethod
    def name(cls) -> str:
        return "paged_feed"

    def schema(self) -> str:
        return "col string, title string, stock_code string, stock_name string, ts double, ann string, ordinal long"

    def reader(self, schema):
        return PagedReader(self.options)

    def streamReader(self, schema):
        return PagedStream(self.options)

"""Stored feeds as a data source of Spark: RSS and Atom files, read in partitions, with the start date pushed to the readers.

    spark.dataSource.register(FeedSource)
    spark.read.format("feed").load(folder).filter("day >= DATE '2024-01-02'")

Files are packed into partitions of about `partitionBytes`, each file is parsed as a stream, and an item is the largest thing
that a reader holds. A lower bound for `day`, the local date (UTC+7), is compared while parsing, so older items
never reach Spark. Paths are folders, files or local patterns, and whatever file systems Arrow opens by URI.

Defined cases: an item without a time that can be read has neither at nor day; of a file that isn't well-formed the items
before the break are read; a folder without files gives no rows; unknown elements are left out.
"""

from __future__ import annotations

import glob
import gzip
from datetime import date, datetime, timedelta, timezone
from email.utils import parsedate_to_datetime
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition

PARTITION_BYTES = 32 << 20
LOCAL = timezone(timedelta(hours=7))
#: Formats beside those of mail headers and ISO-8601; times without an offset are local.
FORMATS = ("%Y/%m/%d %H:%M:%S", "%d/%m/%Y %H:%M:%S", "%d/%m/%Y %H:%M", "%d/%m/%Y", "%d-%m-%Y %H:%M", "%d-%m-%Y", "%Y-%m-%d %H:%M:%S", "%b %d, %Y", "%d %B %Y", "%B %d, %Y", "%d.%m.%Y %H:%M", "%d.%m.%Y")


def parse_time(raw: str | None) -> datetime | None:
    """The instant of a time in any of the known formats, None if none fits."""
    raw = " ".join((raw or "").split())
    if not raw:
        return None
    for read in (datetime.fromisoformat, parsedate_to_datetime, *(lambda x, f=f: datetime.strptime(x, f) for f in FORMATS)):
        try:
            at = read(raw)
        except (ValueError, TypeError, IndexError):
            continue
        try:
            return (at if at.tzinfo else at.replace(tzinfo=LOCAL)).astimezone(timezone.utc)
        except OverflowError:
            return None
    return None


def _text(node) -> str:
    return "".join(node.itertext()).strip()


def parse_item(node) -> dict:
    """Fields of an item (RSS) or entry (Atom); the first element that has a field gives it."""
    out: dict = {"category": []}
    for child in node:
        name = child.tag.rpartition("}")[2] if isinstance(child.tag, str) else ""
        if name == "link":
            if child.get("rel", "alternate") == "alternate":
                out.setdefault("link", (child.get("href") or _text(child)).strip())
        elif name == "category":
            if term := child.get("term") or _text(child):
                out["category"].append(term)
        elif name == "author":
            names = [_text(x) for x in child if isinstance(x.tag, str) and x.tag.rpartition("}")[2] == "name"]
            out.setdefault("author", names[0] if names else _text(child))
        else:
            field = {"title": "title", "description": "description", "summary": "description", "pubDate": "pubDate", "published": "pubDate", "updated": "updated", "creator": "author"}.get(name)
            if field:
                out.setdefault(field, _text(child))
    return out


def items_of(stream):
    """The items of a feed, as far as it is well-formed."""
    path = []
    try:
        for event, node in ElementTree.iterparse(stream, events=("start", "end")):
            if event == "start":
                path.append(node)
                continue
            path.pop()
            if isinstance(node.tag, str) and node.tag.rpartition("}")[2] in ("item", "entry"):
                yield parse_item(node)
                node.clear()
                if path:
                    path[-1].remove(node)
    except ElementTree.ParseError:
        return


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(paths)
        self.paths = paths


def _file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


class FeedReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.size = options["path"], int(options.get("partitionBytes", PARTITION_BYTES))
        self.since: date | None = None

    def pushFilters(self, filters: list[Filter]):
        """Bounds of day from below are used here and checked by Spark once more; the others are Spark's alone."""
        for f in filters:
            if isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)) and f.attribute == ("day",) and isinstance(f.value, date):
                self.since = max(self.since or f.value, f.value)
            yield f

    def _listed(self) -> list[tuple[str, int]]:
        from pyarrow import fs

        if "://" not in self.path and not self.path.startswith("file:") and glob.has_magic(self.path):
            system, found = fs.LocalFileSystem(), fs.LocalFileSystem().get_file_info(sorted(glob.glob(self.path)))
        else:
            system, path = _file_system(self.path)
            found = [system.get_file_info(path)]
        out = []
        for info in found:
            inside = system.get_file_info(fs.FileSelector(info.path, recursive=True)) if info.type == fs.FileType.Directory else [info]
            out += [(x.path, x.size) for x in inside if x.type == fs.FileType.File and not x.base_name.startswith((".", "_"))]
        return sorted(out)

    def partitions(self) -> list[Files]:
        packs, size = [], 0
        for path, n in self._listed():
            if not packs or size + n > self.size:
                packs.append([])
                size = 0
            packs[-1].append(path)
            size += n
        # With no file there is a partition that reads none.
        return [Files(p) for p in packs or [[]]]

    def read(self, partition: Files):
        system = _file_system(self.path)[0] if not glob.has_magic(self.path) else None
        for path in partition.paths:
            with (system or _file_system("/")[0]).open_input_file(path) as raw:
                stream = gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else raw
                for item in items_of(stream):
                    at = parse_time(item.get("pubDate")) or parse_time(item.get("updated"))
                    day = at.astimezone(LOCAL).date() if at else None
                    if self.since is None or (day is not None and day >= self.since):
                        yield (path, *(item.get(c) for c in ("title", "link", "description", "pubDate", "updated", "author")), item["category"], at, day)


class FeedSource(DataSource):
    """format("feed"); option partitionBytes: bytes of files that one task parses."""

    @classmethod
    def name(cls) -> str:
        return "feed"

    def schema(self) -> str:
        return "file string, title string, link string, description string, pubDate string, updated string, author string, category array<string>, at timestamp, day date"

    def reader(self, schema) -> FeedReader:
        return FeedReader(self.options)


def read_feeds(spark: SparkSession, path: str, start_date: date | None = None) -> DataFrame:
    """Items of stored feeds; those before start_date, and those of unknown dates if there is one, stay behind."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FeedSource)
    items = spark.read.format("feed").load(path)
    return items if start_date is None else items.filter(F.col("day") >= F.lit(start_date))


def unread_times(items: DataFrame) -> DataFrame:
    """(form, n): how many items have a time that can't be read, by its form with digits as 0 and letters as a."""
    raw = F.coalesce(F.nullif(F.trim("pubDate"), F.lit("")), F.trim("updated"))
    form = F.regexp_replace(F.regexp_replace(raw, r"\p{Nd}", "0"), r"\p{L}+", "a")
    return items.filter(F.col("at").isNull() & (raw != "")).groupBy(form.alias("form")).agg(F.count("*").alias("n"))

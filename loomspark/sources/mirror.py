"""``mirror``: a folder of Parquet or JSON-lines parts as a Spark data source, in batches and as a stream.

    mirror.register(spark)
    spark.read.format("mirror").schema("id long, text string").load(folder)
    spark.readStream.format("mirror").schema(...).load(folder)

A part is a task's. The scan of a part takes the columns that the schema names and the comparisons of the option ``filters``, a
JSON list of [column, operator, value]. Spark's own push-down of filters to Python sources is left alone: in Spark 4.1 a frame
that is filtered twice keeps the first filter where the second one has nothing to push, and loses rows (a test shows that
frames of this source can be filtered in turn). A stream's
offset is (file, row): all of the files before, by name, and the first rows of that one; so parts must be added under names that
sort after those that are there, and a part may only grow at its end. Rows are read by the offset's bounds, so a batch that runs
again after a failure reads the same rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyspark.sql import SparkSession
from pyspark.sql import datasource as api
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

from loomspark.sources import files

KINDS = {".parquet": "parquet", ".jsonl": "json", ".json": "json"}
#: Comparisons that the scan of a part takes; rows where the column is null don't pass.
TAKEN = {
    "=": lambda c, v: c == v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    "in": lambda c, v: c.isin(v),
    "starts with": lambda c, v: pc.starts_with(c, v),
}


def condition(filters: list) -> pc.Expression | None:
    """All of [column, operator, value] together (None: everything passes)."""
    out = None
    for name, operator, value in filters:
        one = TAKEN[operator](pc.field(name), value)
        out = one if out is None else out & one
    return out


@dataclass
class Part(api.InputPartition):
    """Rows [first, last) of a file (no last: to its end)."""

    path: str
    first: int = 0
    last: int | None = None


def parts_of(folder: str) -> list[str]:
    """The parts below a folder by name; hidden files and those being written don't count."""
    found = [n for n in files.names(folder, recursive=True) if n.endswith(tuple(KINDS)) and not any(x.startswith(("_", ".")) for x in n.split("/"))]
    return [files.join(folder, n) for n in found]


def _dataset(path: str, schema: pa.Schema | None) -> ds.Dataset:
    store, inner = files.store(path)
    return ds.dataset(inner, filesystem=store, format=next(k for end, k in KINDS.items() if path.endswith(end)), schema=schema)


def _read(part: Part, schema: pa.Schema, wanted: pc.Expression | None) -> Iterator[pa.RecordBatch]:
    """A part's rows as batches of the schema; columns that a file lacks are null."""
    at = 0
    # a range of rows is cut before anything is filtered, so the filter is the scan's only where the whole part is read
    whole = part.first == 0 and part.last is None
    for b in _dataset(part.path, schema).to_batches(columns=schema.names, filter=wanted if whole else None, batch_size=10_000):
        lo, hi = max(part.first - at, 0), b.num_rows if part.last is None else min(b.num_rows, part.last - at)
        at += b.num_rows
        if lo < hi:
            cut = pa.Table.from_batches([b.slice(lo, hi - lo)])
            for own in (cut if whole or wanted is None else cut.filter(wanted)).cast(schema).to_batches():
                yield own
        if part.last is not None and at >= part.last:
            return


class Reader(api.DataSourceReader):
    def __init__(self, folder: str, schema, filters: list):
        self.folder, self.schema, self.filters = folder, schema, filters

    def partitions(self) -> list[Part]:
        return [Part(p) for p in parts_of(self.folder)] or [Part("")]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        if partition.path:
            yield from _read(partition, to_arrow_schema(self.schema), condition(self.filters))


class StreamReader(api.DataSourceStreamReader):
    def __init__(self, folder: str, schema, filters: list):
        self.folder, self.schema, self.filters = folder, schema, filters

    def initialOffset(self) -> dict:
        return {"file": "", "row": 0}

    def latestOffset(self) -> dict:
        found = parts_of(self.folder)
        return {"file": found[-1], "row": _dataset(found[-1], None).count_rows()} if found else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[Part]:
        out = []
        for path in parts_of(self.folder):
            if start["file"] <= path <= end["file"]:
                first, last = start["row"] if path == start["file"] else 0, end["row"] if path == end["file"] else None
                if last is None or first < last:
                    out.append(Part(path, first, last))
        return out or [Part("")]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        if partition.path:
            yield from _read(partition, to_arrow_schema(self.schema), condition(self.filters))


class Mirror(api.DataSource):
    @classmethod
    def name(cls) -> str:
        return "mirror"

    def _folder(self) -> str:
        return self.options["path"]

    def _filters(self) -> list:
        found = json.loads(self.options.get("filters", "[]"))
        if bad := [f for f in found if len(f) != 3 or f[1] not in TAKEN]:
            raise ValueError(f"no such filters: {bad}")
        return found

    def schema(self):
        """Of the first part, where the reader names none."""
        found = parts_of(self._folder())
        if not found:
            raise FileNotFoundError(f"no parts in {self._folder()}")
        return from_arrow_schema(_dataset(found[0], None).schema)

    def reader(self, schema) -> Reader:
        return Reader(self._folder(), schema, self._filters())

    def streamReader(self, schema) -> StreamReader:
        return StreamReader(self._folder(), schema, self._filters())


def register(spark: SparkSession) -> None:
    """Make the format known to a session."""
    spark.dataSource.register(Mirror)


def loader(root: str):
    """A way to a source's rows for :func:`rows.source_records`: ``<root>/<dataset_id>[/<subset>]/<split>``."""

    def load(spark: SparkSession, source):
        register(spark)
        return spark.read.format("mirror").load(files.join(root, source.dataset_id, *([source.subset] if source.subset else []), source.split))

    return load

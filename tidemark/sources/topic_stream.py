"""A landed topic as a stream whose position is a map of offsets.

``spark.readStream.format("landed_topic")`` reads a topic's files as a Kafka
source reads its partitions: the position in the checkpoint is
``{topic: {partition: next offset}}``, a new query starts at given offsets, and
a resumed one goes on from the checkpoint whatever it is given.

Options:

``index``            the topic's offset index (:mod:`tidemark.sources.offset_index`)
``startingOffsets``  ``earliest`` (default), ``latest``, or JSON ``{topic: {partition: offset}}``,
                     where -2 is the earliest and -1 the latest offset
``assign``           JSON ``{topic: [partitions]}``: read only these (default: all)
``failOnDataLoss``   ``true`` (default): offsets that the topic no longer has stop the query;
                     ``false``: it goes on at the earliest that are there

Tasks read a slice of one file each, as Arrow batches.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidemark.sources.files import RECORD_SCHEMA

EARLIEST, LATEST = -2, -1
COLUMNS = ("topic", "partition", "offset", "key", "value", "ts")


def _opened(uri: str):
    """File system and path of a file as Spark names it."""
    from pyarrow import fs
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


@dataclass
class Slice(InputPartition):
    """Offsets ``low`` to before ``high`` of one partition in one file."""
    file: str
    topic: str
    partition: int
    low: int
    high: int


class TopicReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        if "index" not in options:
            raise ValueError("landed_topic needs the option 'index'")
        self.index = options["index"]
        self.starting = options.get("startingoffsets", options.get("startingOffsets", "earliest"))
        assign = options.get("assign")
        self.assign = None if assign is None else {(t, int(p)) for t, ps in json.loads(assign).items() for p in ps}
        self.strict = options.get("failondataloss", options.get("failOnDataLoss", "true")).lower() != "false"

    def _files(self) -> list[tuple[str, str, int, int, int]]:
        import pyarrow.dataset as ds
        system, path = _opened(self.index)
        table = ds.dataset(path, filesystem=system, format="parquet").to_table(columns=["file", "topic", "partition", "low", "high"])
        rows = zip(*(table.column(c).to_pylist() for c in table.column_names), strict=True)
        return [r for r in rows if self.assign is None or (r[1], r[2]) in self.assign]

    def _bounds(self) -> dict[tuple[str, int], tuple[int, int]]:
        out: dict[tuple[str, int], tuple[int, int]] = {}
        for _, topic, partition, low, high in self._files():
            first, last = out.get((topic, partition), (low, high + 1))
            out[topic, partition] = (min(first, low), max(last, high + 1))
        missing = (self.assign or set()) - set(out)
        if missing:
            raise ValueError(f"the topic has no partition {sorted(missing)}")
        return out

    @staticmethod
    def _position(offsets: dict[tuple[str, int], int]) -> dict:
        out: dict[str, dict[str, int]] = {}
        for (topic, partition), offset in sorted(offsets.items()):
            out.setdefault(topic, {})[str(partition)] = offset
        return out

    def _checked(self, key: tuple[str, int], offset: int, bounds: tuple[int, int]) -> int:
        if bounds[0] <= offset <= bounds[1]:
            return offset
        if self.strict:
            raise ValueError(f"offset {offset} of {key[0]} partition {key[1]} is gone: the topic has {bounds[0]} to {bounds[1]}")
        return bounds[0]

    def initialOffset(self) -> dict:
        bounds = self._bounds()
        if self.starting in ("earliest", "latest"):
            return self._position({k: b[self.starting == "latest"] for k, b in bounds.items()})
        given = {(t, int(p)): int(o) for t, ps in json.loads(self.starting).items() for p, o in ps.items()}
        if set(given) != set(bounds):
            raise ValueError(f"startingOffsets must list every partition: {sorted(set(given) ^ set(bounds))}")
        said = {EARLIEST: lambda b: b[0], LATEST: lambda b: b[1]}
        return self._position({k: said[o](bounds[k]) if o in said else self._checked(k, o, bounds[k]) for k, o in given.items()})

    def latestOffset(self) -> dict:
        return self._position({k: b[1] for k, b in self._bounds().items()})

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        bounds, out = self._bounds(), []
        # a partition that is new since the start is read from its first offset
        begin = {k: self._checked(k, start.get(k[0], {}).get(str(k[1]), b[0]), b) for k, b in bounds.items()}
        for file, topic, partition, low, high in self._files():
            upto = end.get(topic, {}).get(str(partition), 0)
            a, b = max(low, begin[topic, partition]), min(high + 1, upto)
            if a < b:
                out.append(Slice(file, topic, partition, a, b))
        return out

    def read(self, partition: Slice) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.dataset as ds
        system, path = _opened(partition.file)
        field = pc.field
        wanted = ((field("topic") == partition.topic) & (field("partition") == partition.partition)
                  & (field("offset") >= partition.low) & (field("offset") < partition.high))
        kinds = pa.schema([("topic", pa.string()), ("partition", pa.int32()), ("offset", pa.int64()), ("key", pa.string()),
                           ("value", pa.string()), ("ts", pa.timestamp("us"))])
        data = ds.dataset(path, filesystem=system, format="parquet")
        for batch in data.to_batches(columns=list(COLUMNS), filter=wanted):
            if batch.num_rows:
                yield batch.cast(kinds)


class LandedTopic(DataSource):
    @classmethod
    def name(cls) -> str:
        return "landed_topic"

    def schema(self) -> str:
        return RECORD_SCHEMA

    def streamReader(self, schema) -> TopicReader:
        return TopicReader(dict(self.options))


def topic_stream(spark: SparkSession, index: str, starting: str = "earliest", assign: dict[str, list[int]] | None = None,
                 strict: bool = True) -> DataFrame:
    """The landed topic as a stream with explicit positions."""
    spark.dataSource.register(LandedTopic)
    reader = (spark.readStream.format("landed_topic").option("index", index).option("startingOffsets", starting)
              .option("failOnDataLoss", str(strict).lower()))
    if assign is not None:
        reader = reader.option("assign", json.dumps(assign))
    return reader.load()

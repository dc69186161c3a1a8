"""A topic kept as files, read again as a stream with the topic's own offsets.

An archive has a folder ``partition=<n>`` per partition of the topic, with Parquet files of
``offset, key, value, timestamp``, as a batch read of Kafka gives them. ``archive_source`` replays it
into the same parser and sink as the live topic: the checkpoint holds an offset per partition, a
batch that failed is planned again with the offsets of its first try, and a bounded run takes at most
``max_messages`` and leaves the rest to the next one.

The driver reads Parquet footers alone. Tasks read a file's share of the offsets, as Arrow batches, and
may be run again at any time. Offsets may have gaps (a compacted topic), files may overlap in time but
not repeat an offset.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition


MESSAGES = "partition int, offset bigint, key string, value string, timestamp timestamp"
_ARROW = pa.schema([("partition", pa.int32()), ("offset", pa.int64()), ("key", pa.string()), ("value", pa.string()),
                    ("timestamp", pa.timestamp("us", tz="UTC"))])
BATCH_ROWS = 10_000
POSITION = "archive_position"  # a file of the checkpoint


@dataclass
class _Segment:
    """The offsets of one file, from its footer."""

    path: str
    partition: int
    first: int
    last: int


@dataclass
class _Piece(InputPartition):
    path: str
    partition: int
    start: int
    end: int  # exclusive


class TopicArchive(DataSource):
    """``format("topic_archive")`` with ``path``, and with ``max_messages`` and ``checkpoint`` for bounded runs."""

    @classmethod
    def name(cls) -> str:
        return "topic_archive"

    def schema(self) -> str:
        return MESSAGES

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return ArchiveReader(self.options)


class ArchiveReader(DataSourceStreamReader):
    """Offsets are ``{partition: next offset}``.

    Spark asks for the end of a batch without telling where the last one ended. A bounded run therefore
    keeps the end of the batch planned last in a file of the checkpoint, so both live and go together:
    whenever a new end is asked for, that batch is the one committed last.
    """

    def __init__(self, options: dict[str, str]) -> None:
        self.store, self.path = fs.FileSystem.from_uri(options["path"])
        self.bound = int(options.get("max_messages") or 0)
        self.at: dict[str, int] = {}
        self.position = f"{options['checkpoint']}/{POSITION}" if self.bound else None
        if self.position:
            store, path = fs.FileSystem.from_uri(self.position)
            if store.get_file_info(path).is_file:
                with store.open_input_stream(path) as file:
                    self.at = json.loads(file.read())
            elif store.get_file_info(f"{path.rpartition('/')[0]}/offsets").type != fs.FileType.NotFound:
                raise ValueError("this checkpoint was begun without max_messages; go on without it")

    def segments(self) -> list[_Segment]:
        """All files that hold rows; files that a writer has not finished start with _ or a dot."""
        found = []
        for info in self.store.get_file_info(fs.FileSelector(self.path, recursive=True, allow_not_found=True)):
            folder, _, name = info.path.rpartition("/")
            if not info.is_file or not name.endswith(".parquet") or name[0] in "._" or "/_" in folder[len(self.path):]:
                continue
            partition = int(folder.rpartition("partition=")[2])
            with self.store.open_input_file(info.path) as file:
                footer = pq.ParquetFile(file).metadata
            column = footer.schema.names.index("offset")
            groups = [footer.row_group(i).column(column).statistics for i in range(footer.num_row_groups)]
            if groups:
                found.append(_Segment(info.path, partition, min(g.min for g in groups), max(g.max for g in groups)))
        return found

    def initialOffset(self) -> dict[str, int]:  # noqa: N802
        return {}

    def latestOffset(self) -> dict[str, int]:  # noqa: N802
        ends: dict[str, int] = {}
        starts: dict[str, int] = {}
        for segment in self.segments():
            name = str(segment.partition)
            ends[name] = max(ends.get(name, 0), segment.last + 1)
            starts[name] = min(starts.get(name, segment.first), segment.first)
        if not self.bound:
            return ends
        # Those with the least to read choose first, and leave the others what they cannot use.
        begins = {name: max(self.at.get(name, 0), starts[name]) for name in ends}
        left, planned = self.bound, dict(self.at)
        waiting = sorted(ends, key=lambda name: ends[name] - begins[name])
        for done, name in enumerate(waiting):
            take = min(ends[name] - begins[name], -(-left // (len(waiting) - done)))
            left -= take
            if take:
                planned[name] = begins[name] + take
        return planned

    def partitions(self, start: dict[str, int], end: dict[str, int]) -> Sequence[InputPartition]:
        self.at = dict(end)
        if self.position:
            store, path = fs.FileSystem.from_uri(self.position)
            with store.open_output_stream(path) as file:
                file.write(json.dumps(end).encode())
        pieces = []
        for segment in self.segments():
            name = str(segment.partition)
            first, past = max(start.get(name, 0), segment.first), min(end.get(name, 0), segment.last + 1)
            if first < past:
                pieces.append(_Piece(segment.path, segment.partition, first, past))
        return pieces

    def read(self, piece: _Piece) -> Iterator[pa.RecordBatch]:
        offset = ds.field("offset")
        rows = ds.dataset(piece.path, filesystem=self.store, format="parquet").scanner(
            columns=["offset", "key", "value", "timestamp"], batch_size=BATCH_ROWS,
            filter=(offset >= piece.start) & (offset < piece.end))
        for batch in rows.to_batches():
            if batch.num_rows:
                partition = pa.array([piece.partition] * batch.num_rows, pa.int32())
                columns = [batch.column(f.name).cast(f.type) for f in list(_ARROW)[1:]]
                yield pa.RecordBatch.from_arrays([partition, *columns], schema=_ARROW)

    def commit(self, end: dict[str, int]) -> None:
        """Files stay; the checkpoint alone says what has been read."""


def write_archive(messages: DataFrame, path: str) -> None:
    """Add ``partition, offset, key, value, timestamp`` rows to an archive, in files sorted by offset.

    A partition may be of any size: its offsets are dealt over ranges, not gathered in one task.
    """
    rows = messages.select(*[F.col(name) for name in _ARROW.names])
    (rows.repartitionByRange("partition", "offset").sortWithinPartitions("partition", "offset")
     .write.mode("append").partitionBy("partition").parquet(path))


def archive_source(spark: SparkSession, path: str, max_messages: int | None = None, checkpoint: str | None = None) -> DataFrame:
    """Messages of an archive from its earliest offset; ``value`` goes to ``parse_events``.

    With ``max_messages`` a run that drains takes at most so many, and the next one goes on; pass the
    folder that the sink gets as its ``checkpoint``. Paths are local or of a store that Arrow opens (hdfs, s3).
    """
    spark.dataSource.register(TopicArchive)
    reader = spark.readStream.format(TopicArchive.name()).option("path", path)
    if max_messages:
        if not checkpoint:
            raise ValueError("max_messages needs the checkpoint of the run")
        reader = reader.option("max_messages", str(max_messages)).option("checkpoint", checkpoint)
    return reader.load()

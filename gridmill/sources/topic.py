"""A topic of messages in a folder: partitions, offsets and consumer groups, as a Python data source.

A partition is a chain of segments, ``partition=<p>/<offset of its first message>.jsonl``. The first line of a segment says how
many messages follow, one a line; so the next segment's name is known, and a reader asks for it instead of listing. A segment is
put in place only if it is absent: any number of producers may append, and none overwrites another's messages. Messages of one
key keep their order within a write. A streaming write that is repeated is found by its batch number; one that failed half-way
may send messages again.

A stream begins at its group's committed offsets, at the earliest message without any, and goes on from its own checkpoint after
that. Folders must be on a file system with hard links that all tasks and the driver reach, as the checkpoint folder is.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter, DataSourceStreamReader, InputPartition, WriterCommitMessage,
)

NAME = "gridmill_topic"
SCHEMA = "key string, value string, partition int, offset long"
#: Messages of a task are cut into segments of about so many bytes, each read by one task.
SEGMENT_BYTES = 32 << 20
PARTITIONS = 4


def local(path: str) -> str:
    """The plain path of a ``file:`` address or path."""
    if "://" in path and not path.startswith("file://"):
        raise ValueError(f"a topic folder needs a file system with hard links: {path}")
    return "/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path


@dataclass
class Segment(InputPartition):
    """Messages [first, last) of a segment that begins at offset ``start``."""

    partition: int
    start: int
    first: int
    last: int


@dataclass
class Written(WriterCommitMessage):
    """Files that a task has prepared: partition, path, number of messages."""

    files: list[tuple[int, str, int]]


class Folder:
    """What is in a topic's folder."""

    def __init__(self, path: str):
        self.path = local(path)

    def segment(self, partition: int, offset: int) -> str:
        return f"{self.path}/partition={partition}/{offset:020d}.jsonl"

    def partitions(self) -> int:
        try:
            with open(f"{self.path}/partitions") as f:
                return int(f.read())
        except FileNotFoundError:
            return 0

    def ensure(self, partitions: int) -> int:
        """Creates the topic when it is missing; the number of its partitions, which never changes."""
        if not self.partitions():
            for p in range(partitions):
                os.makedirs(f"{self.path}/partition={p}", exist_ok=True)
            os.makedirs(f"{self.path}/incoming", exist_ok=True)
            self.put(f"{self.path}/partitions", str(partitions))
        return self.partitions()

    def put(self, path: str, text: str) -> bool:
        """A small file, unless it is there."""
        temporary = f"{os.path.dirname(path)}/.{uuid.uuid4().hex}"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(temporary, "w") as f:
            f.write(text)
        return self.take(temporary, path)

    @staticmethod
    def take(temporary: str, path: str) -> bool:
        try:
            os.link(temporary, path)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(temporary)

    def count(self, partition: int, offset: int) -> int | None:
        """Messages of the segment that begins at an offset, None if there is none."""
        try:
            with open(self.segment(partition, offset)) as f:
                return json.loads(f.readline())["count"]
        except FileNotFoundError:
            return None

    def hint(self, partition: int, kind: str) -> int:
        try:
            with open(f"{self.path}/partition={partition}/{kind}") as f:
                return int(f.read() or 0)
        except FileNotFoundError:
            return 0

    def earliest(self, partition: int) -> int:
        """The first offset that is kept; 0 unless older segments were removed."""
        return self.hint(partition, "earliest")

    def end(self, partition: int, known: int | None = None) -> int:
        """The offset behind the last message, looked for from a known one on or from a producer's note."""
        at = max(self.hint(partition, "end"), self.earliest(partition)) if known is None else known
        while (n := self.count(partition, at)) is not None:
            at += n
        return at

    def append(self, partition: int, prepared: str, count: int) -> None:
        """Puts a prepared file behind the last segment."""
        at = self.end(partition)
        while True:
            try:
                os.link(prepared, self.segment(partition, at))
                break
            except FileExistsError:
                at = self.end(partition, at)
        os.unlink(prepared)
        note = f"{self.path}/partition={partition}/.{uuid.uuid4().hex}"
        with open(note, "w") as f:
            f.write(str(at + count))
        os.replace(note, f"{self.path}/partition={partition}/end")

    def ranges(self, start: dict, end: dict) -> list[Segment]:
        """The parts of segments between offsets, one task each."""
        out = []
        for p in sorted(end, key=int):
            # The segment that holds an offset begins at it: reads end where segments end.
            at = int(start.get(p, self.earliest(int(p))))
            while at < int(end[p]):
                n = self.count(int(p), at)
                if n is None:
                    raise ValueError(f"offset {at} of partition {p} of {self.path} is not kept any more")
                out.append(Segment(int(p), at, at, min(at + n, int(end[p]))))
                at += n
        return out

    def ends(self, known: dict | None = None) -> dict:
        return {str(p): self.end(p, (known or {}).get(str(p))) for p in range(self.partitions())}

    def read(self, part: Segment | None) -> Iterator[pa.RecordBatch]:
        if part is None:  # what Spark gives a task if there are no parts
            return
        schema = pa.schema([("key", pa.string()), ("value", pa.string()), ("partition", pa.int32()), ("offset", pa.int64())])
        keys, values, offset = [], [], part.start

        def batch() -> pa.RecordBatch:
            n = len(values)
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(values, pa.string()), pa.array([part.partition] * n, pa.int32()),
                                               pa.array(range(offset - n, offset), pa.int64())], schema=schema)

        with open(self.segment(part.partition, part.start)) as lines:
            next(lines)
            for line in lines:
                key, value = json.loads(line)
                keys.append(key)
                values.append(value)
                offset += 1
                if len(values) == 10_000:
                    yield batch()
                    keys, values = [], []
        if values:
            yield batch()


def prepare(folder: Folder, partitions: int, batches: Iterator[pa.RecordBatch]) -> Written:
    """A task's messages as files beside the topic: by key, or in turns without one."""
    open_files: dict[int, list] = {}
    done: list[tuple[int, str, int]] = []
    turn = 0

    def close(p: int) -> None:
        body, n, size = open_files.pop(p)
        path = f"{folder.path}/incoming/{uuid.uuid4().hex}"
        with open(path, "w") as f:
            f.write(json.dumps({"count": n}) + "\n")
            f.writelines(body)
        done.append((p, path, n))

    for batch in batches:
        names = batch.schema.names
        keys = batch.column("key").to_pylist() if "key" in names else [None] * batch.num_rows
        for key, value in zip(keys, batch.column("value").to_pylist(), strict=True):
            if key is None:
                turn += 1
            p = (turn if key is None else zlib.crc32(key.encode())) % partitions
            line = json.dumps([key, value]) + "\n"
            held = open_files.setdefault(p, [[], 0, 0])
            held[0].append(line)
            held[1] += 1
            held[2] += len(line)
            if held[2] > SEGMENT_BYTES:
                close(p)
    for p in list(open_files):
        close(p)
    return Written(done)


class _Writer:
    def __init__(self, options: dict):
        self.folder = Folder(options["topic"])
        self.partitions = self.folder.ensure(int(options.get("partitions", PARTITIONS)))
        self.producer = options.get("producer")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return prepare(self.folder, self.partitions, iterator)

    def _append(self, messages) -> None:
        for message in messages:
            for p, path, n in message.files if message else ():
                self.folder.append(p, path, n)

    def _drop(self, messages) -> None:
        for message in messages:
            for _, path, _ in message.files if message else ():
                if os.path.exists(path):
                    os.unlink(path)

    def abort(self, messages, *batch) -> None:
        self._drop(messages)


class TopicWriter(_Writer, DataSourceArrowWriter):
    def commit(self, messages) -> None:
        self._append(messages)


class TopicStreamWriter(_Writer, DataSourceStreamArrowWriter):
    def commit(self, messages, batchId: int) -> None:
        """Appends a micro-batch, unless this producer has appended it already."""
        note = f"{self.folder.path}/producers/{self.producer}/{batchId}"
        if self.producer and os.path.exists(note):
            self._drop(messages)
            return
        self._append(messages)
        if self.producer:
            self.folder.put(note, "")


class TopicReader(DataSourceReader):
    """Everything that is kept."""

    def __init__(self, options: dict):
        self.folder = Folder(options["topic"])

    def partitions(self):
        return self.folder.ranges({}, self.folder.ends())

    def read(self, partition: Segment):
        return self.folder.read(partition)


class TopicStreamReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.folder, self.group = Folder(options["topic"]), options.get("group")
        self.known: dict = {}

    def _committed(self) -> str:
        return f"{self.folder.path}/groups/{self.group}.json"

    def initialOffset(self) -> dict:
        earliest = {str(p): self.folder.earliest(p) for p in range(self.folder.partitions())}
        if self.group and os.path.exists(self._committed()):
            with open(self._committed()) as f:
                return earliest | json.load(f)
        return earliest

    def latestOffset(self) -> dict:
        self.known = self.folder.ends(self.known)
        return self.known

    def partitions(self, start: dict, end: dict):
        return self.folder.ranges(start, end)

    def read(self, partition: Segment):
        return self.folder.read(partition)

    def commit(self, end: dict) -> None:
        """What the group has read; a new checkpoint of the group goes on there."""
        if self.group:
            os.makedirs(os.path.dirname(self._committed()), exist_ok=True)
            note = f"{self._committed()}.{uuid.uuid4().hex}"
            with open(note, "w") as f:
                json.dump(end, f)
            os.replace(note, self._committed())


class Topic(DataSource):
    """Options: ``topic`` (folder), ``group`` (reading), ``partitions`` (of a new topic), ``producer`` (a name for repeated streaming writes)."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TopicReader:
        return TopicReader(self.options)

    def streamReader(self, schema) -> TopicStreamReader:
        return TopicStreamReader(self.options)

    def writer(self, schema, overwrite: bool) -> TopicWriter:
        return TopicWriter(self.options)

    def streamWriter(self, schema, overwrite: bool) -> TopicStreamWriter:
        return TopicStreamWriter(self.options)


def register(spark: SparkSession) -> str:
    """Makes the data source known to a session; its name."""
    spark.dataSource.register(Topic)
    return NAME


def read_topic(spark: SparkSession, path: str) -> DataFrame:
    """Key, value, partition and offset of all messages that are kept."""
    return spark.read.format(register(spark)).option("topic", path).load()


def commit_group(query, path: str, group: str) -> None:
    """Record what a query that has ended has read. While it runs, Spark reports a batch only when the next one is planned."""
    for progress in reversed(query.recentProgress):
        end = json.loads(progress.json)["sources"][0]["endOffset"]
        if end:
            TopicStreamReader({"topic": path, "group": group}).commit(end)
            return


def write_topic(messages: DataFrame, path: str, partitions: int = PARTITIONS) -> None:
    """Append messages (``value``, and ``key`` if there is one)."""
    messages.write.format(register(messages.sparkSession)).mode("append").option("topic", path).option("partitions", partitions).save()

"""Message channels as a streaming source: a Python data source whose offset maps each channel to the last id read.

Captured messages are Parquet files of ``channel, message_id, text, published_at`` in a folder that driver and executors read with
Arrow. A batch reads a channel after its offset, oldest first, at most ``catch_up`` messages; a channel without an offset starts
with its latest ``lookback``, a bot's with nothing but its latest id. The driver sees ids alone: once of every file, of which it keeps each
channel's lowest and highest, and then of the files in which a channel's next batch lies. So where files hold messages in about the order
of their ids, as a capture writes them, a batch costs what it reads, however many came before or wait behind it. Texts are read in the
tasks, a channel a task or several where they are many.

    spark.dataSource.register(MessageChannels)
    spark.readStream.format("message_channels").option("path", ...).option("position", ...).load()

Spark asks a source for its end without telling it where the query stands, so the end of each planned batch is also kept in
the file ``position``, one a query: it is written when a batch is planned, also when one is planned again after a restart, and hence never
behind what Spark has committed. ``cursors`` (JSON) is where channels stand when the query first starts.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

CATCH_UP, LOOKBACK, BOT = 3000, 100, "hirifyme_bot"
#: Channels beyond which one task reads several.
TASKS = 256
SCHEMA = "channel string, message_id long, text string, published_at timestamp"


def _system(path: str):
    """The file system of a path or URI, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


def _files(path: str):
    """The file system of a folder and its captured files: path, size and time of change."""
    from pyarrow import fs

    system, at = _system(path)
    found = [f for f in system.get_file_info(fs.FileSelector(at, recursive=True)) if f.is_file and f.path.endswith(".parquet")]
    return system, [(f.path, f.size, f.mtime_ns) for f in sorted(found, key=lambda f: f.path)]


class Ranges(InputPartition):
    """Ids ``(after, upto]`` of some channels, with the files that may hold them."""

    def __init__(self, ranges: list):
        super().__init__(ranges)
        self.ranges = ranges


class ChannelStream(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path, self.position = options["path"], options["position"]
        self.cursors = {k: int(v) for k, v in json.loads(options.get("cursors", "{}")).items() if int(v) > 0}
        self.catch_up, self.lookback = int(options.get("catch_up", CATCH_UP)), int(options.get("lookback", LOOKBACK))
        self._spans: dict = {}
        self.bots = set(json.loads(options.get("bots", json.dumps([BOT]))))

    def initialOffset(self) -> dict:
        return dict(self.cursors)

    def _stored(self) -> dict:
        from pyarrow import fs

        system, at = _system(self.position)
        if system.get_file_info(at).type == fs.FileType.NotFound:
            return dict(self.cursors)
        with system.open_input_stream(at) as f:
            return json.loads(f.read())

    def _store(self, offset: dict) -> None:
        system, at = _system(self.position)
        system.create_dir(at.rsplit("/", 1)[0])
        with system.open_output_stream(f"{at}.draft") as f:
            f.write(json.dumps(offset).encode())
        system.move(f"{at}.draft", at)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_spans": {}}

    def _index(self) -> dict:
        """``channel -> [(lowest, highest id, file)]`` in order: a captured file is read for it once."""
        import pyarrow.compute as pc
        from pyarrow import parquet

        system, files = _files(self.path)
        spans = {f: self._spans.get(f) for f in files}
        for file, known in spans.items():
            if known is None:
                with system.open_input_file(file[0]) as f:
                    ids = parquet.ParquetFile(f).read(columns=["channel", "message_id"])
                ids = ids.filter(pc.and_(pc.is_valid(ids["message_id"]), pc.is_valid(ids["channel"])))
                found = ids.group_by("channel").aggregate([("message_id", "min"), ("message_id", "max")])
                spans[file] = list(zip(*(found[c].to_pylist() for c in ("channel", "message_id_min", "message_id_max"))))
        self._spans = spans
        index: dict[str, list] = {}
        for (path, _, _), channels in spans.items():
            for channel, low, high in channels:
                index.setdefault(channel, []).append((low, high, path))
        return {channel: sorted(held) for channel, held in index.items()}

    def _ids(self, channel: str, path: str):
        import numpy as np
        import pyarrow.dataset as ds

        data = ds.dataset([path], format="parquet", filesystem=_system(self.path)[0])
        return np.asarray(data.to_table(columns=["message_id"], filter=(ds.field("channel") == channel) & ds.field("message_id").is_valid())["message_id"])

    def _upto(self, channel: str, after: int, held: list) -> int | None:
        """The last id of a channel's next batch: files in the order of their ids, as long as one may hold an earlier id than those found."""
        import numpy as np

        found = np.empty(0, "int64")
        for low, high, path in held:
            if len(found) >= self.catch_up and low >= found[-1]:
                break
            if high > after:
                ids = self._ids(channel, path)
                found = np.sort(np.concatenate([found, ids[ids > after]]))[: self.catch_up]
        return int(found[-1]) if len(found) else None

    def latestOffset(self) -> dict:
        now, index = self._stored(), self._index()
        new = {channel: max(high for _, high, _ in held) for channel, held in index.items() if channel not in now}
        next_ids = {channel: self._upto(channel, now[channel], held) for channel, held in index.items() if channel in now and max(h for _, h, _ in held) > now[channel]}
        return now | new | next_ids

    def _first(self, channel: str, upto: int, held: list) -> int:
        """The id before the latest messages of a channel that has no offset."""
        import numpy as np

        found = np.empty(0, "int64")
        for low, high, path in sorted(held, key=lambda x: -x[1]):
            if len(found) > self.lookback and high <= found[0]:
                break
            if low <= upto:
                ids = self._ids(channel, path)
                found = np.sort(np.concatenate([found, ids[ids <= upto]]))[-self.lookback - 1 :]
        return int(found[0]) if len(found) > self.lookback else (int(found[0]) - 1 if len(found) else upto)

    def partitions(self, start: dict, end: dict) -> list[Ranges]:
        self._store(end)
        ranges, index = [], self._index()
        for channel, upto in sorted(end.items()):
            held = index.get(channel, [])
            if channel in start:
                after = start[channel]
            elif channel not in self.bots:
                after = self._first(channel, upto, held)
            else:
                continue
            if upto > after:
                ranges.append((channel, after, upto, [path for low, high, path in held if low <= upto and high > after]))
        step = max(1, -(-len(ranges) // TASKS))
        return [Ranges(ranges[i : i + step]) for i in range(0, len(ranges), step)] or [Ranges([])]

    def read(self, partition: Ranges) -> Iterator:
        import pyarrow as pa
        import pyarrow.dataset as ds

        kinds = pa.schema([("channel", pa.string()), ("message_id", pa.int64()), ("text", pa.string()), ("published_at", pa.timestamp("us", "UTC"))])
        for channel, after, upto, paths in partition.ranges:
            wanted = (ds.field("channel") == channel) & (ds.field("message_id") > after) & (ds.field("message_id") <= upto)
            for batch in ds.dataset(paths, format="parquet", filesystem=_system(self.path)[0]).to_batches(columns=kinds.names, filter=wanted):
                if batch.num_rows:
                    yield batch.cast(kinds)

    def commit(self, end: dict) -> None:
        """Nothing to release: messages stay where they were captured."""


class MessageChannels(DataSource):
    @classmethod
    def name(cls) -> str:
        return "message_channels"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> ChannelStream:
        return ChannelStream(self.options)

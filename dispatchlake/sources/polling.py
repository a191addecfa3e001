"""Polled interfaces as a Spark source: `spark.read` and `spark.readStream` with format "polled".

    spark.dataSource.register(polling.PolledSource)
    calls = spark.readStream.format("polled").option("transport", "site.calls:Transport").option("start", "1767225600").load()

What is polled is one of three kinds. `window`: records of a time window, cut into slices that the interface
accepts. `snapshot`: a whole dataset, behind a probe of its version. `observations`: the present state of ids, asked
in chunks. Slices and chunks are Spark's input partitions, at most `concurrency` of them at a time, so fetching is
spread over executors, a lost task is fetched again, and nothing passes through the driver but bounds, versions and ids.

The stream's offset is the watermark: the end of what was fetched, the version taken, or the time of the last
observation. It lies in the query's checkpoint and is committed after the batch is. A batch that a crash interrupts is
planned anew from the same two offsets, so the same slices are fetched again. Spark does not tell a source that is
started again how far it had come before it asks for more, so the option `watermark` names a small file that keeps
the end of what was last planned: with it the watermark only moves forward, over restarts too. Windows begin
`lookback_minutes` before the watermark; what they bring twice is removed by key and content (`streaming.runner`).

`spark.read` fetches one window and knows of no watermark: `mode` backfill with `from` and `to`, or resweep with a past
`day`, extended by the lookback. `transport` names a class, module:name, that is made with the options and has
the methods of `Transport`.
"""

from __future__ import annotations

import importlib
import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import Protocol

from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..streaming import windows
from .polled import chunks

SCHEMA = "batch_from long, batch_to long, part long, payload string"


class Transport(Protocol):
    """The interface of a source. Times are seconds of its clock; records are what JSON can hold."""

    def now(self) -> int: ...

    def fetch(self, start: int, end: int) -> Iterable[dict]:
        """The records of [start, end)."""

    def version(self, dataset: str) -> dict:
        """{version, status} of a dataset."""

    def records(self, dataset: str) -> Iterable[dict]:
        """All of a dataset."""

    def ids(self) -> Iterable[str]: ...

    def observe(self, ids: list[str]) -> Iterable[dict]: ...


@dataclass
class Part(InputPartition):
    """What one task asks for, one request after the other."""

    requests: list[tuple]


class Options:
    """The options of a source, checked."""

    def __init__(self, given: dict[str, str]):
        self.given = dict(given)
        self.kind = given.get("kind", "window")
        if self.kind not in ("window", "snapshot", "observations"):
            raise ValueError("kind must be window, snapshot or observations")
        if "transport" not in given:
            raise ValueError("transport is missing")
        self.lookback = int(given.get("lookback_minutes", windows.LOOKBACK_MINUTES))
        windows.window_from(0, self.lookback)
        self.longest, self.shortest = int(given.get("max_span_seconds", windows.DAY)), int(given.get("min_span_seconds", 1))
        self.every = max(1, int(given.get("every_seconds", 1)))
        self.concurrency = max(1, int(given.get("concurrency", 1)))
        self.dataset, self.chunk = given.get("dataset", ""), int(given.get("batch_size", 100))

    def transport(self) -> Transport:
        module, _, name = self.given["transport"].partition(":")
        return getattr(importlib.import_module(module), name)(self.given)

    def dealt(self, requests: list[tuple]) -> list[Part]:
        """Requests in as many parts as may run at once, in order."""
        n = min(self.concurrency, len(requests))
        return [Part(requests[len(requests) * i // n : len(requests) * (i + 1) // n]) for i in range(n)]

    def window(self, start: int, end: int) -> list[Part]:
        cut = windows.slices(start, end, self.longest, self.shortest)
        return self.dealt([("fetch", start, end, i, a, b) for i, (a, b) in enumerate(cut)])


def read(options: Options, part: Part) -> Iterator[tuple]:
    transport = options.transport()
    ask = {"fetch": transport.fetch, "records": transport.records, "observe": transport.observe}
    for kind, start, end, i, *asked in part.requests:
        for record in ask[kind](*asked):
            yield start, end, i, json.dumps(record, ensure_ascii=False, sort_keys=True)


class Watermark:
    """How far was planned, kept in a file that only the driver uses; without one, in memory."""

    def __init__(self, uri: str | None):
        self.uri, self.at = uri, None
        if uri:
            files, path = fs.FileSystem.from_uri(uri)
            if files.get_file_info(path).type == fs.FileType.File:
                with files.open_input_stream(path) as f:
                    self.at = int(f.read())

    def advance(self, at: int) -> None:
        before, self.at = self.at, windows.advanced(self.at, at)
        if self.uri and self.at != before:
            files, path = fs.FileSystem.from_uri(self.uri)
            with files.open_output_stream(f"{path}.new") as f:
                f.write(str(self.at).encode())
            files.move(f"{path}.new", path)


class PolledStream(DataSourceStreamReader):
    def __init__(self, options: Options):
        self.options = options
        self.watermark = Watermark(options.given.get("watermark"))

    def initialOffset(self) -> dict:
        if self.options.kind == "window" and "start" not in self.options.given:
            raise ValueError("a stream without a watermark needs start")
        return {"at": int(self.options.given.get("start", -1))}

    def latestOffset(self) -> dict:
        """Where a batch that starts now would end: never before what was planned already."""
        transport, o = self.options.transport(), self.options
        held = self.initialOffset()["at"] if self.watermark.at is None else self.watermark.at
        if o.kind == "snapshot":
            told = transport.version(o.dataset)
            known = None if held < 0 else held
            at = int(told["version"]) if windows.version_gate(known, int(told["version"]), int(told.get("status", 2))) == "take" else held
        else:
            now = transport.now()
            if self.watermark.at is not None and o.kind == "window" and now < held:
                raise ValueError(f"the watermark {held} is later than the source's clock {now}")
            at = now if now - held >= o.every else held
        return {"at": max(at, held)}

    def partitions(self, start: dict, end: dict) -> list[Part]:
        a, b, o = start["at"], end["at"], self.options
        self.watermark.advance(b)
        if b <= a:
            return []
        if o.kind == "window":
            begin = windows.window_from(a, o.lookback)
            return o.window(min(begin, b - o.shortest), b)
        if o.kind == "snapshot":
            return [Part([("records", a, b, 0, o.dataset)])]
        return o.dealt([("observe", a, b, i, ids) for i, ids in enumerate(chunks(o.transport().ids(), o.chunk))])

    def read(self, partition: Part) -> Iterator[tuple]:
        return read(self.options, partition)

    def commit(self, end: dict) -> None:
        self.watermark.advance(end["at"])


class PolledWindow(DataSourceReader):
    """One window, whatever the watermark."""

    def __init__(self, options: Options):
        self.options = options

    def bounds(self) -> tuple[int, int]:
        given, mode = self.options.given, self.options.given.get("mode", "backfill")
        if mode == "backfill":
            start, end = int(given["from"]), int(given["to"])
        elif mode == "resweep":
            offset = int(given.get("offset_seconds", 0))  # of the source's days
            start = int(given["day"]) * windows.DAY - offset
            end = start + windows.DAY
            if end > self.options.transport().now():
                raise ValueError("a day is only swept again when it has ended")
            start = windows.window_from(start, self.options.lookback)
        else:
            raise ValueError("mode must be backfill or resweep")
        if end <= start:
            raise ValueError("a window must end after it starts")
        return start, end

    def partitions(self) -> list[Part]:
        o = self.options
        if o.kind == "window":
            return o.window(*self.bounds())
        transport = o.transport()
        if o.kind == "snapshot":
            version = int(transport.version(o.dataset)["version"])
            return [Part([("records", -1, version, 0, o.dataset)])]
        now = transport.now()
        return o.dealt([("observe", -1, now, i, ids) for i, ids in enumerate(chunks(transport.ids(), o.chunk))]) or [Part([])]

    def read(self, partition: Part) -> Iterator[tuple]:
        return read(self.options, partition)


class PolledSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "polled"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PolledWindow:
        return PolledWindow(Options(self.options))

    def streamReader(self, schema) -> PolledStream:
        return PolledStream(Options(self.options))

"""CSV as Python's strict reader has it, over files of any size.

Records may span lines, so where one begins depends on all the quotes before it. A file is read in blocks, as
Spark splits it. Of each block it is first found, line by line, whether it ends inside a quoted field if it
begins outside of one, and if it begins inside of one; what lies before a block then follows by putting these
two-valued functions together in order, one short row for each block. With the beginnings known, every block's
records are parsed where they lie, by Python's own reader; only records that cross the end of a block are put
together from their pieces, by a shuffle of those pieces alone.

A batch is judged as a whole. What cannot be read reliably (text that is not UTF-8, quotes that Python's strict
reader refuses, an unfinished record, a repeated column, a record with another number of fields, a blank line,
an empty file) gives no rows. A header that is not the contract's, in its order, gives rows and is a reason to
quarantine them. Fields are text as received: empty ones are '', quoted or not.
"""

from __future__ import annotations

import csv
import io
import json
from collections.abc import Iterable, Iterator
from itertools import chain, groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .contracts import Contract

#: Where a line may end: outside of quoted fields, inside of one, or not at all.
OUT, IN, BAD = 0, 1, 2


class Parsed(NamedTuple):
    """A batch: its rows (the contract's columns as text, on demand `payload`, all that was received as JSON, and `file`),
    or None where it cannot be read; why it is to be quarantined; columns that the contract does not know."""

    rows: DataFrame | None
    quarantine: tuple[str, ...]
    unknown: tuple[str, ...] = ()


def pieces(line: str) -> Iterable[str]:
    """A line as Python's reader wants its input: cut at carriage returns too."""
    return io.StringIO(f"{line}\n", newline="") if "\r" in line else (f"{line}\n",)


def _ends(line: str) -> int:
    for closing, state in (((), OUT), (('"',), IN)):
        try:
            for _ in csv.reader(chain(pieces(line), closing), strict=True):
                pass
            return state
        except csv.Error:
            continue
    return BAD


def after(line: str) -> tuple[int, int]:
    """Where a line ends that begins outside of quoted fields, and where if it begins inside of one."""
    if '"' not in line and len(line) < csv.field_size_limit():
        return OUT, IN
    return _ends(line), _ends(f'"{line}')


def runs(lines: Iterable[str], state: int) -> Iterator[tuple[int, int, list[str]]]:
    """(state before, state after, lines) of the shortest runs of lines that end outside of quoted fields; the last
    one may end inside."""
    held: list[str] = []
    before = state
    for line in lines:
        held.append(line)
        state = after(line)[state]
        if state == OUT:
            yield before, state, held
            held, before = [], state
    if held:
        yield before, state, held


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator[bytes]]]:
    rows = chain.from_iterable(zip(*(b.column(c).to_pylist() for c in ("file", "block", "line")), strict=True) for b in batches)
    for key, own in groupby(rows, key=lambda r: r[:2]):
        yield key, (r[2] for r in own)


_BLOCK = pa.schema([("file", pa.string()), ("block", pa.int64()), ("from_out", pa.int32()), ("from_in", pa.int32()), ("utf8", pa.bool_()), ("header", pa.list_(pa.string()))])
_BLOCK_SQL = "file string, block long, from_out int, from_in int, utf8 boolean, header array<string>"


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (file, block), lines in _blocks(batches):
        states, utf8, first, header = [OUT, IN], True, [], None
        for raw in lines:
            try:
                line = raw.decode()
            except UnicodeDecodeError:
                utf8 = False
                continue
            ends = (*after(line), BAD)
            states = [ends[s] for s in states]
            if block == 0 and header is None:
                first.append(line)
                if states[0] == OUT:
                    header = next(csv.reader(chain.from_iterable(map(pieces, first)), strict=True), [])
        yield pa.RecordBatch.from_pylist([{"file": file, "block": block, "from_out": states[0], "from_in": states[1], "utf8": utf8, "header": header}], schema=_BLOCK)


def _places(header: list[str], columns: tuple[str, ...]) -> list[int | None]:
    return [header.index(c) if c in header else None for c in columns]


_ROW = pa.schema([("file", pa.string()), ("n", pa.int32()), ("width", pa.int32()), ("fields", pa.list_(pa.string())), ("payload", pa.string())])
_ROW_SQL = "file string, n int, width int, fields array<string>, payload string"


class _Rows:
    """Records as rows; headers: those of files whose header is not the contract's."""

    def __init__(self, columns: tuple[str, ...], headers: dict[str, list[str]], payload: bool):
        self.columns, self.headers, self.payload = columns, headers, payload

    def batches(self, file: str, records: Iterator[list[str]], most: int = 5000) -> Iterator[pa.RecordBatch]:
        header = self.headers.get(file, list(self.columns))
        places = _places(header, self.columns)
        straight = places == list(range(len(header)))
        out: list[tuple] = []

        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*out, strict=True), _ROW, strict=True)], schema=_ROW)

        for record in records:
            n = len(record)
            fields = record if straight or n != len(header) else [None if p is None else record[p] for p in places]
            out.append((file, n, len(header), fields, json.dumps(dict(zip(header, record, strict=False)), ensure_ascii=False) if self.payload else None))
            if len(out) >= most:
                yield sent()
                out = []
        if out:
            yield sent()


def _parse(rows: _Rows, broadcast):
    """The records that lie within a block. broadcast: the blocks that begin inside a quoted field."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, block), lines in _blocks(batches):
            own = runs((raw.decode() for raw in lines), IN if (file, block) in broadcast.value else OUT)
            whole = (line for a, b, held in own if a == b == OUT for line in held)
            records = csv.reader(chain.from_iterable(map(pieces, whole)), strict=True)
            if block == 0:
                next(records, None)
            yield from rows.batches(file, records)

    return run


def _edges(broadcast):
    """The lines of a block that belong to records that cross its ends: kind 0 ends one, 1 is within one, 2 begins one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, block), lines in _blocks(batches):
            for a, b, held in runs((raw.decode() for raw in lines), IN if (file, block) in broadcast.value else OUT):
                if (a, b) != (OUT, OUT):
                    kind = 0 if b == OUT else 1 if a == IN else 2
                    yield pa.RecordBatch.from_pydict({"file": [file], "block": [block], "kind": pa.array([kind], pa.int32()), "text": ["\n".join(held)]})

    return run


def _parse_texts(rows: _Rows):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, text in zip(batch.column("file").to_pylist(), batch.column("text").to_pylist(), strict=True):
                yield from rows.batches(file, csv.reader(io.StringIO(text, newline=""), strict=True))

    return run


def header_findings(header: list[str], contract: Contract) -> dict[str, list[str]]:
    """missing, extra and reordered columns. A byte order mark shows as part of the first name."""
    columns = list(contract.columns)
    common = [c for c in header if c in columns]
    return {
        "missing": [c for c in columns if c not in header],
        "extra": [c for c in header if c not in columns],
        "reordered": common if common != [c for c in columns if c in header] else [],
        "repeated": sorted({c for c in header if header.count(c) > 1}),
    }


def _marked(spark: SparkSession, file: str) -> bool:
    """Whether a file begins with a byte order mark, which line readers skip. Three bytes are read."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(context._jvm.java.net.URI(file))
    stream = path.getFileSystem(context._jsc.hadoopConfiguration()).open(path)
    try:
        return [stream.read() for _ in range(3)] == [0xEF, 0xBB, 0xBF]
    finally:
        stream.close()


def _refused(reason: str) -> Parsed:
    return Parsed(None, (f"unparseable: {reason}",))


def parse_csv(spark: SparkSession, path: str | list[str], contract: Contract, more: tuple[str, ...] = ()) -> Parsed:
    """The batch that one or several files make up; more: further columns, of payload and file. Blocks that begin inside a quoted field are told to all tasks: at most
    one short entry for each `spark.sql.files.maxPartitionBytes` of input."""
    text = spark.read.option("lineSep", "\n").text([path] if isinstance(path, str) else path)
    lines = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("line"))
    blocks = sorted(lines.mapInArrow(_judge, _BLOCK_SQL).collect(), key=lambda b: (b["file"], b["block"]))
    if not blocks or len({b["file"] for b in blocks}) < len(text.inputFiles()):
        return _refused("the file is empty")
    if not all(b["utf8"] for b in blocks):
        return _refused("text that is not UTF-8")

    inside, crossed, headers, quarantine, unknown = set(), False, {}, [], []
    for file, own in groupby(blocks, key=lambda b: b["file"]):
        state, header = OUT, None
        for b in own:
            if state == IN:
                inside.add((file, b["block"]))
            header = b["header"] if b["block"] == 0 else header
            state = (b["from_out"], b["from_in"])[state]
            if state == BAD:
                return _refused("quotes that are not CSV")
        if state == IN or header is None:
            return _refused("the last record does not end")
        if _marked(spark, file):
            header = ["﻿" + header[0], *header[1:]]
        found = header_findings(header, contract)
        if found["repeated"]:
            return _refused(f"repeated columns {found['repeated']}")
        if header != list(contract.columns):
            headers[file] = header
            quarantine += [f"columns {what}: {names}" for what, names in found.items() if names]
            unknown += found["extra"]
        crossed = crossed or bool(inside)

    rows = _Rows(contract.columns, headers, "payload" in more)
    begins = spark.sparkContext.broadcast(inside)
    parsed = lines.mapInArrow(_parse(rows, begins), _ROW_SQL)
    if crossed:
        order = Window.partitionBy("file").orderBy("block", "kind")
        edges = lines.mapInArrow(_edges(begins), "file string, block long, kind int, text string")
        edges = edges.withColumn("record", F.sum((F.col("kind") == 2).cast("long")).over(order))
        joined = edges.groupBy("file", "record").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "kind", "text"))), lambda x: x["text"]), "\n").alias("text"))
        parsed = parsed.unionByName(joined.select("file", "text").mapInArrow(_parse_texts(rows), _ROW_SQL))
    if not parsed.filter("n <> width").isEmpty():
        return _refused("records with another number of fields than the header")
    fields = [F.get("fields", F.lit(i)).alias(c) for i, c in enumerate(contract.columns)]
    return Parsed(parsed.select(*fields, *more), tuple(dict.fromkeys(quarantine)), tuple(dict.fromkeys(unknown)))

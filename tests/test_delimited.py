"""CSV batches against Python's strict reader over the whole text."""

import csv
import io
import json
import random

import pytest

from dispatchlake.sources import delimited, files
from dispatchlake.sources.contracts import Contract

C = Contract("s", 1, "file_drop", ("id", "name"), ("id",))


def strict(text):
    """The rows as a strict reader of the whole file has them, or None where it refuses or a row is ragged."""
    try:
        records = list(csv.reader(io.StringIO(text, newline=""), strict=True))
    except csv.Error:
        return None
    return [tuple(r) for r in records[1:]] if records and all(len(r) == len(records[0]) for r in records) else None


def told(spark, path, more=()):
    batch = delimited.parse_csv(spark, str(path), C, more)
    return None if batch.rows is None else sorted(map(tuple, batch.rows.select("id", "name").collect())), batch


BODIES = [
    '1,"say ""hi"""', '1,"say ""hi"", you"', '1,"C:\\dir\\"', '1,"a\nb"\n2,c', '1,""\n2,', "1,a\"b", '1,a""b', '1,"a"b', '1,"a\n2,b', '1,"a\r\nb"\r\n2,c\r\n', "1,a\r2,b",
    '1,"x,\n\n\n,y"\n"2\n","\n"', "1,a\n\n2,b", "1,a\n2", "1,a,b", '"1","a"', ' "1",a', '1, "a"', "1,é日\x1c\u2028", "", "1,a\n\n", '1,"' + "z" * 200_000 + '"', "1," + "z" * 140_000, '1,"a"\r"2\r","b"\r3,c', "'1,a'",
]


def test_as_python_reads_it(spark, tmp_path):
    for i, body in enumerate(BODIES):
        text = f"id,name\n{body}" + ("\n" if i % 2 and body else "")
        (tmp_path / f"{i}.csv").write_bytes(text.encode())
        want, (got, batch) = strict(text), told(spark, tmp_path / f"{i}.csv")
        assert got == (None if want is None else sorted(want)), repr(body[:50])
        assert (want is None) == bool(batch.quarantine)


@pytest.mark.parametrize("seed", range(4))
def test_records_over_the_ends_of_blocks(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(str(i), "".join(rng.choices(["a", ",", '"', "\n", "\r\n", "é", " "], k=rng.choice([0, 3, 30, 400] if i % 40 else [3000])))) for i in range(400)]
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=rng.choice(["\n", "\r\n"]), quoting=rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]))
    writer.writerows([("id", "name"), *rows])
    (tmp_path / "f.csv").write_bytes(out.getvalue().encode())
    (tmp_path / "g.csv").write_bytes(b'"id","name"\r\nx,"y\r\n"\r\n')
    assert strict(out.getvalue()) == rows
    keys = {"spark.sql.files.maxPartitionBytes": "1500", "spark.sql.files.openCostInBytes": "100"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        assert spark.read.text(str(tmp_path / "f.csv")).rdd.getNumPartitions() > 10
        batch = delimited.parse_csv(spark, [str(tmp_path / "f.csv"), str(tmp_path / "g.csv")], C, ("file",))
        assert not batch.quarantine
        assert sorted((r.file[-5:], r.id, r.name) for r in batch.rows.collect()) == sorted([*(("f.csv", *r) for r in rows), ("g.csv", "x", "y\r\n")])
        # a quote too many is found wherever it lies
        text = out.getvalue().encode()
        at = text.index(b"\n", len(text) // 2)
        (tmp_path / "bad.csv").write_bytes(text + b'z,"open\n')
        assert delimited.parse_csv(spark, str(tmp_path / "bad.csv"), C).rows is None
        (tmp_path / "utf8.csv").write_bytes(text[:at] + b"\xff" + text[at:])
        assert delimited.parse_csv(spark, str(tmp_path / "utf8.csv"), C).quarantine == ("unparseable: text that is not UTF-8",)
    finally:
        for k in keys:
            spark.conf.unset(k)


def test_headers_that_differ_quarantine_and_keep_their_rows(spark, tmp_path):
    for name, header, rows, why in (
        ("extra", "id,name,new", [("1", "a")], "columns extra: ['new']"),
        ("order", "name,id", [("2", "1")], "columns reordered: ['name', 'id']"),
        ("missing", "id", None, "columns missing: ['name']"),
        ("quoted", '"id","name"', [("1", "2")], None),
        ("marked", "﻿id,name", None, None),
    ):
        body = {"extra": "1,a,x", "missing": "1"}.get(name, "1,2")
        (tmp_path / f"{name}.csv").write_text(f"{header}\n{body}\n", encoding="utf-8")
        batch = delimited.parse_csv(spark, str(tmp_path / f"{name}.csv"), C, ("payload",))
        if rows is not None:
            assert [tuple(r)[:2] for r in batch.rows.collect()] == rows
        if why is not None:
            assert why in batch.quarantine
        assert bool(batch.quarantine) == (name != "quoted")
        staged = files.stage_batch(spark, str(tmp_path / f"{name}.csv"), C, str(tmp_path / "raw"), name, 1, "2026-01")
        assert staged.rows == 1 and staged.quarantine == batch.quarantine
    raw = {r["run_id"]: r for r in spark.read.parquet(str(tmp_path / "raw")).collect()}
    assert json.loads(raw["extra"]["payload"]) == {"id": "1", "name": "a", "new": "x"} and raw["missing"]["name"] is None
    assert delimited.parse_csv(spark, str(tmp_path / "extra.csv"), C).unknown == ("new",)
    (tmp_path / "twice.csv").write_text("id,id\n1,2\n")
    assert files.stage_batch(spark, str(tmp_path / "twice.csv"), C, str(tmp_path / "raw"), "t", 1, "2026-01") == files.Staged(0, ("unparseable: repeated columns ['id']",), ())

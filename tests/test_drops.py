"""Drops that arrive in steps are loaded once, whole."""

import json
import zlib

from dispatchlake.sources.contracts import Contract
from dispatchlake.streaming.drops import Drops

C = Contract("s", 1, "file_drop", ("id", "name"), ("id",))


def manifest(parts, **wrong):
    lines = [line for text in parts.values() for line in text.encode().split(b"\n") if line]
    return json.dumps({"files": {f: t.count("\n") - 1 for f, t in parts.items()}, "checksum": sum(map(zlib.crc32, lines))} | wrong)


def test_a_drop_in_three_steps_is_loaded_once(spark, tmp_path):
    inbox, parts = tmp_path / "inbox", {"a.csv": "id,name\n1,x\n", "b c.csv": "id,name\n2,y\n3,z\n"}
    (inbox / "d1").mkdir(parents=True)
    drops = Drops(spark, str(inbox), str(tmp_path / "out"), C, patience=2)
    step = lambda: drops.run(str(tmp_path / "checkpoint"))
    state = lambda: {r["drop"]: (r["state"], r["reason"]) for r in drops.states().collect()}
    (inbox / "d1" / "a.csv").write_text(parts["a.csv"])
    step()
    assert state() == {"d1": ("waiting", "no manifest")}
    (inbox / "d1" / "manifest.json").write_text(manifest(parts))
    step()
    assert state() == {"d1": ("waiting", "missing: b c.csv")} and not (tmp_path / "out" / "rows").exists()
    # another drop does not agree with its manifest
    (inbox / "d2").mkdir()
    (inbox / "d2" / "a.csv").write_text(parts["a.csv"])
    (inbox / "d2" / "manifest.json").write_text(manifest({"a.csv": parts["a.csv"]}, checksum=5))
    step()
    assert state()["d2"][0] == "waiting"
    (inbox / "d1" / "b c.csv").write_text(parts["b c.csv"])
    step()
    assert state()["d1"] == ("loaded", None) and state()["d2"] == ("rejected", "the checksum differs from the manifest")
    rows = lambda: sorted(map(tuple, spark.read.parquet(str(tmp_path / "out" / "rows")).select("id", "name", "drop").collect()))
    want = [("1", "x", "d1"), ("2", "y", "d1"), ("3", "z", "d1")]
    assert rows() == want
    # a file that comes late to a drop that was loaded changes nothing, nor does an epoch that is repeated
    (inbox / "d1" / "late.csv").write_text("id,name\n9,q\n")
    step()
    drops.epoch(spark.createDataFrame([(f"{inbox}/d1/a.csv", 1)], "path string, length long"), 3)
    assert rows() == want and drops.events().filter("state = 'loaded'").count() == 1

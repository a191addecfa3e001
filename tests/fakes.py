"""A source made of files, whose requests are logged: folder/calls.json, folder/now, folder/agents.json."""

import json
import os
from pathlib import Path

from dispatchlake.sources import polled


class Transport:
    def __init__(self, options):
        self.folder = Path(options["folder"])

    def _log(self, *what):
        with open(self.folder / "log", "a") as f:
            f.write(json.dumps([*what, os.getpid()]) + "\n")

    def _held(self, name):
        return json.loads((self.folder / name).read_text())

    def now(self):
        return int((self.folder / "now").read_text())

    def fetch(self, start, end):
        self._log("fetch", start, end)
        if (self.folder / "fail").exists():
            raise RuntimeError("the source is down")
        send = lambda request, token: {"header": {"retcode": polled.EXPIRED}} if token == "old" else {"rows": [c for c in self._held("calls.json") if start <= c["at"] < end]}
        return polled.call(send, lambda: "new", f"{start}/{end}", "old")["rows"]

    def version(self, dataset):
        return self._held("version.json")

    def records(self, dataset):
        self._log("records", dataset)
        return self._held("agents.json")

    def ids(self):
        return [a["id"] for a in self._held("agents.json")]

    def observe(self, ids):
        self._log("observe", ids)
        return [{"id": i, "state": f"s{self.now()}"} for i in ids]

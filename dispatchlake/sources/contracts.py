"""Source contracts: what a source delivers, column by column, and what may be overridden at run time."""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

from .contract_rules import LOOKBACK_MINUTES, long_form, problems

MOST_LOOKBACK_MINUTES = LOOKBACK_MINUTES[1]


@dataclass(frozen=True)
class Contract:
    """A validated contract."""

    source_id: str
    version: int
    connector: str
    columns: tuple[str, ...]
    key: tuple[str, ...]
    zone: str = "UTC"
    lookback_minutes: int = 15
    max_span_seconds: int = 1200
    min_span_seconds: int = 60
    batch_size: int = 100
    mapping: dict[str, str] = field(default_factory=dict)
    code_sets: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def schema(self) -> T.StructType:
        """Every source column is text: types are given later, and never inferred."""
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])

    def digest(self) -> str:
        return hashlib.sha256(json.dumps(self.__dict__, default=list, sort_keys=True).encode()).hexdigest()


def load(text: str) -> dict:
    """A YAML document in which no mapping repeats a key."""
    import yaml

    class Loader(yaml.SafeLoader):
        pass

    def mapping(loader, node, deep=False):
        keys = [loader.construct_object(k, deep=deep) for k, _ in node.value]
        twice = sorted({k for k in keys if keys.count(k) > 1})
        if twice:
            raise ValueError(f"repeated keys: {', '.join(map(str, twice))}")
        return yaml.SafeLoader.construct_mapping(loader, node, deep=deep)

    Loader.add_constructor(yaml.resolver.BaseResolver.DEFAULT_MAPPING_TAG, mapping)
    return yaml.load(text, Loader)  # noqa: S506  a safe loader with one more check


def contract(raw: dict) -> Contract:
    """The contract of a document, in the long form or the short one of `contract_rules.SHORT`."""
    if found := problems(raw):
        raise ValueError("; ".join(found))
    full = long_form(raw)
    columns = full.get("columns") or []
    given = {
        "zone": at(full, "window.source_timezone"), "lookback_minutes": at(full, "window.lookback_minutes"), "min_span_seconds": at(full, "window.min_span_seconds"),
        "max_span_seconds": at(full, "window.max_span_seconds") or (at(full, "window.max_span_hours") or 0) * 3600 or None, "batch_size": at(full, "endpoint.objects.batch_size"),
    }
    return Contract(
        full["source_id"], full["contract_version"], full["connector"], tuple(c["src"] for c in columns), tuple(full["idempotent_key"]),
        mapping={c["src"]: c["state"] for c in columns}, code_sets={k: tuple(map(str, v["values"])) for k, v in (full.get("enums") or {}).items() if "values" in v},
        **{k: v for k, v in given.items() if v is not None},
    )


def overridden(c: Contract, lookback_minutes: int) -> Contract:
    """Overrides only raise what is fetched again, and not without bound."""
    if not c.lookback_minutes <= lookback_minutes <= MOST_LOOKBACK_MINUTES:
        raise ValueError("lookback may only be raised, up to a day")
    return Contract(**(c.__dict__ | {"lookback_minutes": lookback_minutes}))


def at(raw: dict, path: str):
    """The value at a path like `window.max_span_hours` or `datasets[0].name`, for literals of a plan; None where there
    is none."""
    value = raw
    for name, index in re.findall(r"([^.\[\]]+)|\[(\d+)\]", path):
        if index:
            value = value[int(index)] if isinstance(value, list) and int(index) < len(value) else None
        else:
            value = value.get(name) if isinstance(value, dict) else None
    return value


#: What each database connector needs besides its address; drivers are the site's to provide.
DRIVERS = {"pg_read": "org.postgresql.Driver", "mssql_read": "com.microsoft.sqlserver.jdbc.SQLServerDriver"}


def options_of(raw: dict, secret) -> tuple[str, bool, dict[str, str]]:
    """(format, whether it is a stream, options) with which Spark reads a source; `secret(reference)` gives (user,
    password). A REST source is polled (see `polled`), so it has no reader."""
    kind = raw.get("connector")
    if kind in DRIVERS:
        user, password = secret(at(raw, "auth.obtain.credential_ref"))
        return "jdbc", False, {"url": at(raw, "endpoint.url"), "dbtable": at(raw, "endpoint.table"), "driver": DRIVERS[kind], "user": user, "password": password, "fetchsize": str(at(raw, "endpoint.fetch_size") or 10_000)}
    if kind == "kafka_consume":
        return "kafka", True, {"kafka.bootstrap.servers": at(raw, "endpoint.servers"), "subscribe": at(raw, "endpoint.topic"), "startingOffsets": at(raw, "endpoint.from") or "earliest", "maxOffsetsPerTrigger": str(at(raw, "endpoint.batch_size") or 100_000)}
    if kind == "file_drop":
        return "text", False, {}
    raise ValueError(f"{kind} has no reader of its own")


def reader(spark, raw: dict, secret):
    """A configured reader (a stream reader for a stream): `.load()` it."""
    kind, stream, options = options_of(raw, secret)
    return (spark.readStream if stream else spark.read).format(kind).options(**options)


def sync(stored: dict[str, tuple[int, str]], new: Contract) -> str:
    """insert, unchanged or update; a lower version, or other content under the same one, is an error."""
    if new.source_id not in stored:
        return "insert"
    version, digest = stored[new.source_id]
    if new.version < version:
        raise ValueError("the version is lower than the one in force")
    if new.version == version:
        if digest != new.digest():
            raise ValueError("the content changed under the same version")
        return "unchanged"
    return "update"


def sync_metrics(stored: dict[tuple[str, int], tuple[str, str | None]], new: list, live: bool) -> dict[tuple[str, int], str]:
    """What each metric version becomes: insert, unchanged, or (before the service is live) redefined.

    stored: (code, version): (definition hash, confirmed name)."""
    out = {}
    for m in new:
        key = (m.code, m.version)
        if key not in stored:
            out[key] = "insert"
        elif stored[key][0] == m.definition_hash():
            out[key] = "unchanged"
        elif live:
            raise ValueError(f"{m.code} version {m.version} is redefined")
        else:
            out[key] = "redefined"
    return out


def confirmed_name(stored: str | None, offered: str) -> str:
    """A name that was confirmed is kept."""
    return stored or offered

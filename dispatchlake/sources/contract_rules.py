"""What a contract must look like: a table of rules for single fields, one checker for all of them, and a few rules
that hold between fields. Every finding is told; no shape of the input raises.

A path names a field; `[]` stands for each entry of a list and `{}` for each value of a mapping. A field that is
required is missed wherever what it belongs to is there.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from typing import Any, NamedTuple
from zoneinfo import ZoneInfo

# Names that contracts use.
CONNECTORS = ("pg_read", "mssql_read", "rest_api", "kafka_consume", "file_drop")
STATES = ("verified", "mapped_unverified", "unknown")
COLUMN_TYPES = ("text", "integer", "smallint", "bigint", "numeric", "boolean", "date", "timestamptz")
WATERMARK_TYPES = ("timestamptz", "sequence", "version")
RAW_MODES = ("append_if_changed", "snapshot_on_version")
RESPONSES = ("csv_attachment", "json")
SCOPES = {"cti": (), "vdn": ("{ccId}", "{vdnId}")}
RELEASE_CLASSES = ("agent", "caller", "system")
INDEX_PREFIX = "IDX_"
OBSERVED = "observed_at"

# Bounds.
LOOKBACK_MINUTES = (0, 1440)
STALE_DAYS = (1, 366)
MIDNIGHT_MINUTES = (1, 60)
OBJECTS = (1, 10_000)

NAME = re.compile(r"[a-z][a-z0-9_]*")
SECRET = re.compile(r"pass(word|wd)|secret|token|api_?key", re.IGNORECASE)

#: A check gives what is wrong with a value, or None.
Check = Callable[[Any], str | None]


def text(value) -> str | None:
    return None if isinstance(value, str) and value.strip() else "must be a text"


def name(value) -> str | None:
    return None if isinstance(value, str) and NAME.fullmatch(value) else "must be a lower-case name"


def flag(value) -> str | None:
    return None if isinstance(value, bool) else "must be true or false"


def mapping(value) -> str | None:
    return None if isinstance(value, dict) and value else "must be a mapping with entries"


def listing(value) -> str | None:
    return None if isinstance(value, list | tuple) and value else "must be a list with entries"


def whole(least: int = 1, most: int | None = None) -> Check:
    wanted = f"must be a whole number from {least}" + ("" if most is None else f" to {most}")
    return lambda value: None if type(value) is int and value >= least and (most is None or value <= most) else wanted


def one_of(*values: str) -> Check:
    return lambda value: None if isinstance(value, str) and value in values else f"must be one of {', '.join(values)}"


def zone(value) -> str | None:
    try:
        return None if ZoneInfo(value) else "must be a time zone"
    except Exception:  # whatever it is, it names no zone
        return "must be a time zone"


def schedule(value) -> str | None:
    return None if isinstance(value, str) and len(value.split()) == 5 else "must be a schedule of five fields"


def absolute(value) -> str | None:
    return None if isinstance(value, str) and value.startswith("/") else "must be an absolute path"


def or_null(check: Check) -> Check:
    return lambda value: None if value is None else check(value)


class Rule(NamedTuple):
    path: str
    check: Check
    required: bool = False


RULES = (
    Rule("source_id", name, True),
    Rule("contract_version", whole(1), True),
    Rule("connector", one_of(*CONNECTORS), True),
    Rule("target_raw", text),
    Rule("enabled", flag),
    Rule("endpoint", mapping),
    Rule("endpoint.host_ref", name),
    Rule("endpoint.response", one_of(*RESPONSES)),
    Rule("endpoint.index_ids", listing),
    Rule("endpoint.index_ids[]", text),
    Rule("endpoint.objects", mapping),
    Rule("endpoint.objects.batch_size", whole(*OBJECTS)),
    Rule("endpoint.version_probe", mapping),
    Rule("endpoint.version_probe.path", absolute, True),
    Rule("endpoint.datasets", listing),
    Rule("endpoint.datasets[]", mapping),
    Rule("endpoint.datasets[].name", text, True),
    Rule("endpoint.datasets[].path", absolute, True),
    Rule("endpoint.datasets[].scope", one_of(*SCOPES), True),
    Rule("endpoint.datasets[].key", or_null(text), True),
    Rule("auth", mapping),
    Rule("auth.inherits", name),
    Rule("auth.obtain", mapping),
    Rule("auth.obtain.credential_ref", name, True),
    Rule("window", mapping),
    Rule("window.filter_column", text),
    Rule("window.max_span_hours", whole(1)),
    Rule("window.max_span_seconds", whole(1)),
    Rule("window.min_span_seconds", whole(1)),
    Rule("window.concurrency", whole(1)),
    Rule("window.restate_days", whole(0)),
    Rule("window.lookback_minutes", whole(*LOOKBACK_MINUTES)),
    Rule("window.version_stale_days", whole(*STALE_DAYS)),
    Rule("window.midnight_skip_minutes", whole(*MIDNIGHT_MINUTES)),
    Rule("window.source_timezone", zone),
    Rule("window.day_timezone", zone),
    Rule("window.schedule", schedule),
    Rule("watermark", mapping),
    Rule("watermark.type", one_of(*WATERMARK_TYPES), True),
    Rule("watermark.column", text, True),
    Rule("idempotent_key", listing, True),
    Rule("idempotent_key[]", text),
    Rule("raw_write", mapping),
    Rule("raw_write.mode", one_of(*RAW_MODES), True),
    Rule("columns", listing),
    Rule("columns[]", mapping),
    Rule("columns[].src", text, True),
    Rule("columns[].type", one_of(*COLUMN_TYPES), True),
    Rule("columns[].state", one_of(*STATES), True),
    Rule("enums", mapping),
    Rule("enums{}", mapping),
    Rule("enums{}.values", listing),
    Rule("enums{}.inbound", listing),
    Rule("enums{}.outbound", listing),
    Rule("enums{}.classes", mapping),
    Rule("enums{}.classes{}", listing),
    Rule("enums{}.classes{}[]", whole(-(1 << 31), (1 << 31) - 1)),
)

_MISSING = object()
_STEP = re.compile(r"\.?([^.\[{]+)|(\[\])|(\{\})")


def found(raw, path: str) -> Iterator[tuple[str, Any]]:
    """(concrete path, value) of every field that a path means; a last field that is not there has no value."""
    places = [("", raw)]
    for field, each, every in _STEP.findall(path):
        if field:
            places = [(f"{p}.{field}".lstrip("."), v.get(field, _MISSING)) for p, v in places if isinstance(v, dict)]
        elif each:
            places = [(f"{p}[{i}]", x) for p, v in places if isinstance(v, list | tuple) for i, x in enumerate(v)]
        elif every:
            places = [(f"{p}.{k}", x) for p, v in places if isinstance(v, dict) for k, x in v.items()]
    return iter(places)


def values(raw, path: str) -> list:
    """The values that a path means."""
    return [v for _, v in found(raw, path) if v is not _MISSING]


def texts(raw, path: str) -> list[str]:
    return [v for v in values(raw, path) if isinstance(v, str)]


def _fields(raw) -> Iterator[str]:
    for rule in RULES:
        for path, value in found(raw, rule.path):
            if value is not _MISSING:
                if wrong := rule.check(value):
                    yield f"{path} {wrong}"
            elif rule.required:
                yield f"{path} is missing"


# --- between fields --------------------------------------------------------------------------------


def _repeated(raw) -> Iterator[str]:
    for path in ("columns[].src", "idempotent_key[]", "endpoint.datasets[].name", "endpoint.index_ids[]"):
        if twice := sorted(v for v, n in Counter(texts(raw, path)).items() if n > 1):
            yield f"{path} repeats {', '.join(twice)}"
    for path in ("values", "inbound", "outbound"):
        for where, codes in found(raw, f"enums{{}}.{path}"):
            if isinstance(codes, list | tuple) and len(set(map(repr, codes))) < len(codes):
                yield f"{where} repeats a code"
    for where, classes in found(raw, "enums{}.classes"):
        listed = Counter(repr(c) for own in values(classes, "{}") if isinstance(own, list | tuple) for c in own)
        if any(n > 1 for n in listed.values()):
            yield f"{where} has a code twice"


def _columns_named(raw) -> Iterator[str]:
    """What names a column must name one that is there; sources that are taken whole have datasets in their place."""
    columns = set(texts(raw, "columns[].src"))
    if not columns and not values(raw, "endpoint.datasets"):
        yield "columns is missing, and there are no datasets"
    if columns:
        for path in ("idempotent_key[]", "window.filter_column", "watermark.column"):
            yield from (f"{path} names {c}, which is no column" for c in texts(raw, path) if c not in columns and c != OBSERVED)


def _spans(raw) -> Iterator[str]:
    least = [v for v in values(raw, "window.min_span_seconds") if type(v) is int]
    most = [v for v in values(raw, "window.max_span_seconds") if type(v) is int] + [3600 * v for v in values(raw, "window.max_span_hours") if type(v) is int]
    if least and most and least[0] > min(most):
        yield "window.min_span_seconds exceeds the longest span"
    if values(raw, "window.max_span_hours") and not values(raw, "window.source_timezone"):
        yield "window.source_timezone is missing, so spans of time have no zone"


def _access(raw) -> Iterator[str]:
    if values(raw, "auth") and not values(raw, "auth.obtain") and not values(raw, "auth.inherits"):
        yield "auth says neither how access is obtained nor whose it inherits"
    # a contract only refers to secrets: no text may stand under a name of one
    stack = [(k, v) for k, v in raw.items() if k not in ("columns", "quality", "integration_checks")]
    while stack:
        path, value = stack.pop()
        children = value.items() if isinstance(value, dict) else enumerate(value) if isinstance(value, list | tuple) else ()
        for key, child in children:
            if isinstance(child, str | int) and not isinstance(child, bool) and SECRET.search(str(key)) and not str(key).endswith("_ref"):
                yield f"{path}.{key} looks like a credential"
            stack.append((f"{path}.{key}", child))


def _scopes(raw) -> Iterator[str]:
    for path, dataset in found(raw, "endpoint.datasets[]"):
        scope, at = next(iter(texts(dataset, "scope")), None), next(iter(texts(dataset, "path")), "")
        lacks = [place for place in SCOPES.get(scope, ()) if place not in at]
        if lacks:
            yield f"{path}.path lacks {', '.join(lacks)} of scope {scope}"


def _indexes(raw) -> Iterator[str]:
    asked, columns = set(texts(raw, "endpoint.index_ids[]")), {c for c in texts(raw, "columns[].src") if c.startswith(INDEX_PREFIX)}
    if asked and columns and asked != columns:
        yield f"endpoint.index_ids and columns differ in {', '.join(sorted(asked ^ columns))}"


def _codes(raw) -> Iterator[str]:
    for path, enum in found(raw, "enums{}"):
        listed = {repr(c) for own in values(enum, "values") if isinstance(own, list | tuple) for c in own}
        sides = [{repr(c) for own in values(enum, side) if isinstance(own, list | tuple) for c in own} for side in ("inbound", "outbound")]
        if sides[0] & sides[1]:
            yield f"{path} has codes both inbound and outbound"
        if listed and (sides[0] | sides[1]) - listed:
            yield f"{path} has codes of a direction that are not among its values"
    for unknown in {str(k) for c in values(raw, "enums.release_cause.classes") if isinstance(c, dict) for k in c} - set(RELEASE_CLASSES):
        yield f"enums.release_cause.classes has the unknown class {unknown}"


BETWEEN = (_repeated, _columns_named, _spans, _access, _scopes, _indexes, _codes)

#: A short form for small sources: the field that each name stands for.
SHORT = {
    "version": ("contract_version",), "key": ("idempotent_key",), "zone": ("window", "source_timezone"), "lookback_minutes": ("window", "lookback_minutes"),
    "min_span_seconds": ("window", "min_span_seconds"), "max_span_seconds": ("window", "max_span_seconds"), "batch_size": ("endpoint", "objects", "batch_size"),
}


def long_form(raw: dict) -> dict:
    """A contract with its short names written out: columns that are plain names are text of the state that `mapping`
    tells, code sets are enumerations. What is given in full stays."""
    out = {k: v for k, v in raw.items() if k not in SHORT and k not in ("mapping", "code_sets")}
    for short, path in SHORT.items():
        if short in raw:
            own = out
            for field in path[:-1]:
                own[field] = dict(own[field]) if isinstance(own.get(field), dict) else {}
                own = own[field]
            own.setdefault(path[-1], raw[short])
    states = raw.get("mapping") if isinstance(raw.get("mapping"), dict) else {}
    if isinstance(raw.get("columns"), list | tuple):
        out["columns"] = [{"src": c, "type": "text", "state": states.get(c, "unknown")} if isinstance(c, str) else c for c in raw["columns"]]
    if isinstance(raw.get("code_sets"), dict):
        own = out["enums"] = dict(out["enums"]) if isinstance(out.get("enums"), dict) else {}
        for k, v in raw["code_sets"].items():
            own[k] = {"values": v} | (own[k] if isinstance(own.get(k), dict) else {})
    return out


def problems(raw) -> list[str]:
    """Everything that is wrong with a contract, at once."""
    if not isinstance(raw, dict):
        return ["a contract must be a mapping"]
    whole_form = long_form(raw)
    return [*_fields(whole_form), *(finding for rule in BETWEEN for finding in rule(whole_form))]

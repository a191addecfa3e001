"""Metric requests: metric x dimension x range x version, under role, row and field permissions.

The order is fixed: permission, then the version of each day, then filters. Choosing the newest version
after filtering would bring back members that a correction has removed. What is refused is refused with
its own error; what is empty says why.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.periods import GRANULARITIES, period
from .marts import MARTS, UNLINKED, Mart
from .results import ResultCache

MAX_DAYS = 1098
MAX_ROWS = 10_000
MAX_SECONDS = 30.0


class Refused(Exception):
    """A request that is not answered. Each code is a class of its own."""

    code = "refused"

    def __init__(self, message: str = ""):
        super().__init__(message or self.code)


#: The error codes that callers tell apart.
CODES = (
    "unauthenticated", "no_role", "several_roles", "unknown_metric", "unknown_dimension", "not_implemented", "incompatible_grain", "range_too_long", "invalid_range",
    "duplicate_item", "empty_filter", "missing_dimension", "version_boundary", "metric_forbidden", "scope_unresolved", "result_too_large", "audit_failed",
)
ERRORS: dict[str, type[Refused]] = {c: type("".join(p.title() for p in c.split("_")), (Refused,), {"code": c}) for c in CODES}


@dataclass(frozen=True)
class Metric:
    """One version of a metric: a sum of a mart's column, or a ratio of two sums."""

    code: str
    version: int
    mart: str | None
    numerator: str | None
    denominator: str | None = None
    effective_from: date = date(1970, 1, 1)
    name: str = ""

    def definition_hash(self) -> str:
        return hashlib.sha256(json.dumps([self.code, self.mart, self.numerator, self.denominator], separators=(",", ":")).encode()).hexdigest()


@dataclass(frozen=True)
class Principal:
    user: str
    roles: tuple[str, ...]
    agent_no: str | None = None
    department: str | None = None
    #: A person, not a service: only persons may write queries of their own.
    natural: bool = True


@dataclass(frozen=True)
class Request:
    metrics: tuple[str, ...]
    first: date
    last: date
    dimensions: tuple[str, ...] = ()
    filters: dict[str, tuple[str, ...]] = field(default_factory=dict)
    granularity: str | None = None
    version: str | int = "latest"

    def digest(self) -> str:
        return hashlib.sha256(json.dumps([self.metrics, str(self.first), str(self.last), self.dimensions, sorted((k, sorted(v)) for k, v in self.filters.items()), self.granularity, self.version]).encode()).hexdigest()


#: The metrics that a mart column stands behind.
CATALOG = (
    Metric("M-C01", 1, "calls_day_volume", "offered"),
    Metric("M-C02", 1, "calls_day_volume", "answered"),
    Metric("M-C03", 1, "calls_day_volume", "abandoned"),
    Metric("M-C04", 1, "calls_day_volume", "answered", "offered"),
    Metric("M-C05", 1, "calls_day_queue_service", "answered_within", "queued"),
    Metric("M-C06", 1, "calls_day_queue_service", "wait_seconds", "queued"),
    Metric("M-C07", 1, "legs_day_agent_handling", "talk_seconds", "answered"),
    Metric("M-C08", 1, None, None),
    Metric("M-C09", 1, "legs_day_agent_handling", "presented"),
    Metric("M-C10", 1, "legs_day_agent_handling", "answered"),
    Metric("M-C11", 1, "calls_day_release", "calls", "day_calls"),
    Metric("M-C12", 1, "legs_day_agent_handling", "missed"),
    Metric("M-C13", 1, "calls_day_volume", "transferred"),
    Metric("M-C14", 1, None, None),
    Metric("M-C15", 1, "calls_day_repeat_failed", "callers"),
)


def segments(metrics: tuple[Metric, ...], code: str, first: date, last: date) -> list[tuple[date, date, Metric]]:
    """The versions of a metric over a range: (first day, last day, version)."""
    versions = sorted((m for m in metrics if m.code == code), key=lambda m: m.effective_from)
    if not versions:
        raise ERRORS["unknown_metric"](code)
    out = []
    for m, after in zip(versions, [*versions[1:], None]):
        start = max(first, m.effective_from)
        end = last if after is None else min(last, date.fromordinal(after.effective_from.toordinal() - 1))
        if start <= end:
            out.append((start, end, m))
    return out


@dataclass(frozen=True)
class Plan:
    request: Request
    mart: Mart
    segments: dict[str, list[tuple[date, date, Metric]]]
    role: str
    row_filter: dict[str, str]


def plan(request: Request, principal: Principal, metrics: tuple[Metric, ...] = CATALOG, marts: dict[str, Mart] = MARTS) -> Plan:
    """Checks permission and the request; raises the first refusal."""
    if not principal.roles:
        raise ERRORS["no_role"]()
    if len(principal.roles) > 1:
        raise ERRORS["several_roles"]()
    role = principal.roles[0]
    if request.last < request.first:
        raise ERRORS["invalid_range"]()
    if (request.last - request.first).days + 1 > MAX_DAYS:
        raise ERRORS["range_too_long"]()
    if not request.metrics or len(set(request.metrics)) < len(request.metrics) or len(set(request.dimensions)) < len(request.dimensions):
        raise ERRORS["duplicate_item"]()
    found = {code: segments(metrics, code, request.first, request.last) for code in request.metrics}
    names = {m.mart for parts in found.values() for _, _, m in parts}
    if None in names:
        raise ERRORS["not_implemented"]()
    if len(names) != 1:
        raise ERRORS["incompatible_grain"]()
    mart = marts[names.pop()]
    if role not in mart.roles:
        raise ERRORS["metric_forbidden"](mart.name)
    if request.granularity is not None and request.granularity not in GRANULARITIES:
        raise ERRORS["unknown_dimension"](request.granularity)
    for d in (*request.dimensions, *request.filters):
        if d not in mart.dimensions:
            raise ERRORS["unknown_dimension"](d)
    if any(not members for members in request.filters.values()):
        raise ERRORS["empty_filter"]()
    if any(d not in (*request.dimensions, *request.filters) for d in mart.required):
        raise ERRORS["missing_dimension"]()
    if request.granularity != "day" and any(len(parts) > 1 for parts in found.values()):
        raise ERRORS["version_boundary"]()
    scope: dict[str, str] = {}
    if mart.row_filter == "self" and role == "agent":
        if not principal.agent_no:
            raise ERRORS["scope_unresolved"]()
        scope = {"agent": principal.agent_no}
    if mart.row_filter == "department" and role == "supervisor":
        if not principal.department:
            raise ERRORS["scope_unresolved"]()
        scope = {"department": principal.department}
    return Plan(request, mart, found, role, scope)


def choose_versions(record: DataFrame, mart: str, first: date, last: date, version: str | int = "latest") -> DataFrame:
    """day, close_version, publication_seq and status of every day of the range.

    latest: the highest version; as_closed: version 1; a number: that version. A provisional version of a day
    that has been closed since has no rows left: its status is superseded."""
    spark = record.sparkSession
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("day"))
    own = record.filter((F.col("mart") == mart) & F.col("day").between(F.lit(first), F.lit(last)))
    all_days = own.groupBy("day").agg(F.max("close_version").alias("top"))
    wanted = own if version == "latest" else own.filter(F.col("close_version") == (1 if version == "as_closed" else int(version)))
    chosen = wanted.groupBy("day").agg(F.max(F.struct("close_version", "publication_seq")).alias("v"))
    joined = days.join(all_days, "day", "left").join(chosen, "day", "left")
    absent = F.when(F.col("top").isNull(), "not_built").when(F.lit(version == "as_closed") & (F.col("top") == 0), "not_closed").otherwise("version_not_found")
    old = (F.col("v.close_version") == 0) & (F.col("top") > 0)
    return joined.select("day", F.col("v.close_version").alias("close_version"), F.col("v.publication_seq").alias("publication_seq"), F.when(F.col("v").isNull(), absent).when(old, "superseded").otherwise("published").alias("status"))


def selected(p: Plan, rows: DataFrame, record: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the rows that a request may see of the chosen versions, those versions)."""
    request = p.request
    chosen = choose_versions(record, p.mart.name, request.first, request.last, request.version)
    # at most MAX_DAYS rows; the range on day prunes the partitions
    published = F.broadcast(chosen.filter("status = 'published'").select("day", "close_version"))
    used = rows.filter(F.col("day").between(F.lit(request.first), F.lit(request.last))).join(published, ["day", "close_version"], "left_semi")
    for column, member in p.row_filter.items():
        used = used.filter(F.col(column).cast("string") == member)
    for column, members in request.filters.items():
        used = used.filter(F.col(column).cast("string").isin(*members))
    return used, chosen


def metadata(p: Plan, rows: DataFrame, record: DataFrame) -> DataFrame:
    """One row over the rows that the request may see: in_progress (incomplete calls on provisional days; null where the
    mart has none) and has_unlinked (whether a member is unlinked; null where no dimension can be)."""
    used, _ = selected(p, rows, record)
    open_ = F.coalesce(F.sum(F.when(F.col("close_version") == 0, F.col("in_progress"))), F.lit(0)) if "in_progress" in rows.columns else F.lit(None)
    linked = [d for d in ("queue", "agent") if d in rows.columns]
    unlinked = F.coalesce(F.bool_or(sum((F.when(F.col(d) == UNLINKED, 1).otherwise(0) for d in linked), F.lit(0)) > 0), F.lit(False)) if linked else F.lit(None)
    return used.agg(open_.cast("long").alias("in_progress"), unlinked.cast("boolean").alias("has_unlinked"))


@dataclass(frozen=True)
class Availability:
    """Years in which a metric is not available, and the column that limits it."""

    metric: str
    year: int
    state: str
    limiting_column: str | None = None


def execute(p: Plan, rows: DataFrame, record: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(result rows, the versions chosen). rows: day, close_version and the mart's columns."""
    request = p.request
    used, chosen = selected(p, rows, record)
    by = ([period(F.col("day"), request.granularity).alias("period")] if request.granularity else []) + [F.col(d) for d in request.dimensions]
    values, versions = [], []
    for code in request.metrics:
        total = lambda name, a, b: F.sum(F.when(F.col("day").between(F.lit(a), F.lit(b)), F.col(name)))
        value = F.lit(None).cast("double")
        for a, b, m in p.segments[code]:
            n = total(m.numerator, a, b).cast("double")
            one = n if m.denominator is None else F.try_divide(n, total(m.denominator, a, b))
            value = F.coalesce(value, one)
        values.append(value.alias(code))
        # several versions only stand together by day, so the last that has begun by the row's day is its own
        own = F.lit(p.segments[code][0][2].version)
        for a, _, m in p.segments[code][1:]:
            own = F.when(F.col("period") >= F.lit(a), m.version).otherwise(own)
        versions.append(own.alias(f"{code}_version"))
    out = used.groupBy(*by).agg(*values).select("*", *versions)
    return (out.orderBy(*out.columns[: len(by)]) if by else out.filter(F.coalesce(*(F.col(f"`{c}`") for c in request.metrics)).isNotNull())), chosen


def answer(
    request: Request, principal: Principal, rows: Callable[[str], DataFrame], record: DataFrame, audit: Callable[[dict], None],
    metrics: tuple[Metric, ...] = CATALOG, marts: dict[str, Mart] = MARTS, availability: tuple[Availability, ...] = (), cache: ResultCache | None = None,
) -> tuple[list, dict]:
    """(rows, meta). The audit entry is written before anything is returned; if that fails nothing is. What `cache` holds
    for the versions that are chosen now is returned without reading the mart; refusals and overlong results are not kept."""
    try:
        p = plan(request, principal, metrics, marts)
    except Refused as refusal:
        _audit(audit, principal, request, refusal.code, 0)
        raise
    if cache is not None:
        versions = choose_versions(record, p.mart.name, request.first, request.last, request.version)
        key = cache_key(p, versions.agg(F.max("publication_seq")).first()[0] or 0)
        if (kept := cache.get(key, (availability, request.version))) is not None:
            _audit(audit, principal, request, "ok", len(kept[0]))
            return kept
    result, chosen = execute(p, rows(p.mart.name), record)
    found = result.limit(MAX_ROWS + 1).collect()
    if len(found) > MAX_ROWS:
        _audit(audit, principal, request, "result_too_large", 0)
        raise ERRORS["result_too_large"]()
    meta = describe(chosen, found, p, availability)
    meta |= metadata(p, rows(p.mart.name), record).first().asDict()
    meta["cache_key"] = cache_key(p, max((r["publication_seq"] or 0 for r in meta.pop("_days")), default=0))
    if cache is not None:
        cache.put(meta["cache_key"], found, result.schema, meta, (availability, request.version))
    _audit(audit, principal, request, "ok", len(found))
    return found, meta


def _audit(audit: Callable[[dict], None], principal: Principal, request: Request, outcome: str, n: int) -> None:
    try:
        audit({"user": principal.user, "request": request.digest(), "outcome": outcome, "rows": n})
    except Exception as error:
        raise ERRORS["audit_failed"]() from error


def describe(chosen: DataFrame, found: list, p: Plan | None = None, availability: tuple[Availability, ...] = ()) -> dict:
    """Day states, why a result is empty, and of a plan what was asked of which versions, what limits it, and the scope.
    The range has at most MAX_DAYS days."""
    days = sorted(chosen.collect(), key=lambda d: d["day"])
    states = {s: sum(d["status"] == s for d in days) for s in ("published", "not_built", "not_closed", "version_not_found", "superseded")}
    empty = None
    if not found:
        empty = "no_rows_in_scope" if states["published"] else next((s for s in states if states[s]), "no_days")
    of_plan = {}
    if p is not None:
        limits = [a for a in availability if a.metric in p.request.metrics and a.state != "available" and p.request.first.year <= a.year <= p.request.last.year]
        if empty and limits:
            empty = "out_of_availability"
        versions = {code: [{"version": m.version, "from": str(a), "to": str(b)} for a, b, m in parts] for code, parts in p.segments.items()}
        of_plan = {
            "table": p.mart.name, "data_version": p.request.version, "metrics": versions, "row_scope": dict(p.row_filter),
            "availability": [{"metric": a.metric, "year": a.year, "state": a.state, "limiting_column": a.limiting_column} for a in sorted(limits, key=lambda a: (a.metric, a.year))],
            "days": [{"day": str(d["day"]), "close_version": d["close_version"], "status": d["status"]} for d in days],
            "unclosed_dates": [str(d["day"]) for d in days if d["status"] == "not_closed"],
            "publication_seq": max((d["publication_seq"] for d in days if d["publication_seq"] is not None), default=None),
        }
    return of_plan | {"states": states, "has_provisional": any(d["close_version"] == 0 for d in days), "empty_reason": empty, "data_as_of": max((d["day"] for d in days if d["status"] == "published"), default=None), "_days": days}


def cache_key(p: Plan, publication_seq: int) -> str:
    """Nothing that can change an answer is left out: request, metric versions, publication, role, fields, scope."""
    versions = sorted((c, [m.version for _, _, m in parts]) for c, parts in p.segments.items())
    return hashlib.sha256(json.dumps([p.request.digest(), versions, publication_seq, p.role, sorted(p.mart.sensitive), sorted(p.row_filter.items())]).encode()).hexdigest()


def members(rows: DataFrame, dimension: str, scope: dict[str, str] | None = None, attributes: tuple[str, ...] = ()) -> DataFrame:
    """Members of a dimension, with attributes, within a scope."""
    for column, member in (scope or {}).items():
        rows = rows.filter(F.col(column).cast("string") == member)
    return rows.select(F.col(dimension).cast("string").alias("member"), *attributes).distinct()


def dictionary(metrics: tuple[Metric, ...], role: str, marts: dict[str, Mart] = MARTS) -> list[dict]:
    """Metrics with their newest version and whether the role may ask for them."""
    newest = {m.code: m for m in sorted(metrics, key=lambda m: m.version)}
    return [{"code": c, "version": m.version, "implemented": m.mart is not None, "allowed": m.mart is not None and role in marts[m.mart].roles} for c, m in sorted(newest.items())]


def search(records: DataFrame, criteria: dict[str, str], registered: tuple[str, ...], key: str, after: int | None = None, page: int = 50) -> DataFrame:
    """One page of records that meet registered criteria, in order of the key; the next page starts after the last key."""
    unknown = set(criteria) - set(registered)
    if unknown or not criteria:
        raise ERRORS["unknown_dimension"](", ".join(sorted(unknown)))
    for column, value in criteria.items():
        records = records.filter(F.col(column).cast("string") == value)
    return (records if after is None else records.filter(F.col(key) > after)).orderBy(key).limit(page)

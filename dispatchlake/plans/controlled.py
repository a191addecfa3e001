"""Controlled SQL: a person's own query over allowed views, and nothing else.

Three independent barriers, each of which refuses what it does not know:

1. Spark's parser gives the statement's tree before anything is resolved or run. Every kind of node in it must be one
   of a list, every function's name too, and every relation a single name, that of an allowed view or of a common
   table of the statement. Commands, table functions, names made by expressions, files, hints, scripts, time
   travel and whatever later versions add are not on the list.
2. The statement runs in a session of its own that holds the allowed views and no other, nor any function that
   somebody has registered. A common table may not have the name of a table that the catalog has.
3. Every leaf of the analysed plan, subqueries included, must be a leaf of an allowed view.

A result beyond the grant's rows or seconds is refused, never cut.
"""

from __future__ import annotations

import datetime as dt
import json
import threading
import uuid
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession

from .semantic import ERRORS, MAX_ROWS, MAX_SECONDS, Principal

#: Kinds of nodes that a statement may consist of, by the names that Spark gives them.
NODES = frozenset(
    """
    Project Filter Join Aggregate Sort SortOrder GlobalLimit LocalLimit Offset Distinct Union Except Intersect SubqueryAlias OneRowRelation
    UnresolvedSubqueryColumnAliases UnresolvedRelation UnresolvedWith UnresolvedHaving UnresolvedOrdinal UnresolvedFunction UnresolvedAttribute
    UnresolvedAlias UnresolvedStar UnresolvedExtractValue Alias Cast Literal CaseWhen In InSubquery ListQuery Exists ScalarSubquery
    And Or Not EqualTo EqualNullSafe LessThan LessThanOrEqual GreaterThan GreaterThanOrEqual IsNull IsNotNull IsTrue IsNotTrue IsFalse IsNotFalse
    IsUnknown IsNotUnknown Add Subtract Multiply Divide IntegralDivide Remainder UnaryMinus UnaryPositive BitwiseAnd BitwiseOr BitwiseXor BitwiseNot
    Like ILike RLike Concat Substring StringTrim StringTrimLeft StringTrimRight StringLocate TimestampAdd TimestampDiff
    WindowExpression WindowSpecDefinition SpecifiedWindowFrame UnspecifiedFrame$ UnboundedPreceding$ UnboundedFollowing$ CurrentRow$
    LambdaFunction UnresolvedNamedLambdaVariable Cube Rollup GroupingSets BaseGroupingSets
    """.split()
)
#: Functions that a statement may call: none of them reads, writes, waits, runs code by name or tells of the machine.
FUNCTIONS = frozenset(
    """
    count sum avg mean min max min_by max_by first last any_value median percentile percentile_approx approx_percentile approx_count_distinct stddev variance
    stddev_samp stddev_pop var_samp var_pop corr bool_and bool_or every some count_if mode grouping grouping_id collect_list collect_set listagg string_agg
    row_number rank dense_rank percent_rank cume_dist ntile lag lead first_value last_value nth_value
    abs sign ceil ceiling floor round bround sqrt cbrt exp ln log log2 log10 pow power mod pmod greatest least sin cos tan radians degrees try_add try_subtract
    try_multiply try_divide div width_bucket
    if ifnull nullif nvl nvl2 coalesce isnull isnotnull between try_cast
    upper lower ucase lcase initcap length char_length octet_length trim ltrim rtrim lpad rpad substr substring left right replace translate concat concat_ws
    split split_part instr locate position startswith endswith contains like ilike rlike regexp_like regexp_extract regexp_replace regexp_count reverse repeat ascii
    year quarter month day dayofmonth dayofweek dayofyear weekday weekofyear hour minute second extract date_part date_trunc trunc date_add date_sub dateadd datediff
    date_diff add_months months_between last_day next_day make_date to_date to_timestamp try_to_timestamp date_format unix_timestamp from_unixtime timestampdiff timestampadd
    array size cardinality element_at array_contains array_distinct array_join sort_array transform filter exists forall aggregate struct named_struct map_keys map_values
    get_json_object md5 sha2 xxhash64 hash crc32
    """.split()
)
#: Leaves that hold no data.
BARE = frozenset({"OneRowRelation", "CTERelationRef"})


class Grant(NamedTuple):
    """Who may ask: a person that the directory knows, with somebody who answers for it, until when and how much."""

    principal: str
    verified: bool
    responsible: str
    reason: str
    expires: dt.datetime | None = None
    revoked: bool = False
    daily: int | None = None
    most: int = MAX_ROWS
    seconds: float = MAX_SECONDS

    def faults(self, principal: Principal, at: dt.datetime, asked_today: int) -> list[str]:
        told = {
            "another principal's grant": self.principal != principal.user,
            "only for persons": not principal.natural,
            "not verified in the directory": not self.verified,
            "nobody is responsible": not self.responsible.strip(),
            "no reason given": not self.reason.strip(),
            "revoked": self.revoked,
            "expired": self.expires is not None and at >= self.expires,
            "the day's queries are used up": self.daily is not None and asked_today >= self.daily,
        }
        return [fault for fault, holds in told.items() if holds]


def _nodes(tree) -> Iterator[dict]:
    """The nodes of a tree that Spark gives as JSON, those inside fields of others too."""
    for x in tree if isinstance(tree, list) else tree.values():
        if isinstance(x, dict) and "class" in x:
            yield x
        if isinstance(x, dict | list):
            yield from _nodes(x)


def _name(node: dict, field: str) -> str:
    return str(node.get(field, "")).strip("[]").lower()


def refusals(tree: list, views: Iterable[str], taken: Callable[[str], bool]) -> list[str]:
    """Why a parsed statement may not run; `taken` tells whether the catalog has a table of a name."""
    allowed, nodes = {v.lower() for v in views}, list(_nodes(tree))
    kinds = [(n["class"].rpartition(".")[2], n) for n in nodes]
    common = {str(c["_1"]).lower() for kind, n in kinds if kind == "UnresolvedWith" for c in n["cteRelations"]}
    wrong = {kind for kind, _ in kinds if kind not in NODES}
    wrong |= {f"function {name}" for kind, n in kinds if kind == "UnresolvedFunction" and (name := _name(n, "nameParts")) not in FUNCTIONS}
    wrong |= {f"relation {name}" for kind, n in kinds if kind == "UnresolvedRelation" and (name := _name(n, "multipartIdentifier")) not in allowed | common}
    wrong |= {f"common table {name}" for name in common if name in allowed or taken(name)}
    return sorted(wrong)


def _own_session(spark: SparkSession, views: Iterable[str]) -> SparkSession:
    """A session with the allowed views of `spark` and no others."""
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    for name in views:
        plan = spark.table(name)._jdf.logicalPlan()
        spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(own._jsparkSession, plan).createOrReplaceTempView(name)
    return own


def _listed(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _leaves(df: DataFrame) -> list:
    plan = df._jdf.queryExecution().analyzed()
    return [leaf for p in [plan, *_listed(plan.subqueriesAll())] for leaf in _listed(p.collectLeaves())]


def controlled_sql(
    spark: SparkSession, text: str, views: frozenset[str], most: int = MAX_ROWS, principal: Principal | None = None, seconds: float = MAX_SECONDS,
    grant: Grant | None = None, at: dt.datetime | None = None, asked_today: int = 0, audit: Callable[[dict], None] | None = None,
) -> DataFrame:
    """The rows of one SELECT over allowed views, computed. With a grant its limits hold. The audit entry, if asked for,
    is written before anything is returned, of refusals too."""
    told = {"user": principal.user if principal else None, "statement": text, "outcome": "metric_forbidden", "rows": 0}
    try:
        if grant is not None and principal is not None:
            if faults := grant.faults(principal, at or dt.datetime.now(dt.UTC), asked_today):
                raise ERRORS["metric_forbidden"]("; ".join(faults))
            most, seconds = min(most, grant.most), min(seconds, grant.seconds)
        elif principal is not None and not principal.natural:
            raise ERRORS["metric_forbidden"]("only for persons")
        own = _own_session(spark, views)
        try:
            parsed = json.loads(own._jsparkSession.sessionState().sqlParser().parsePlan(text.strip().rstrip(";")).toJSON())
        except ParseException as error:
            raise ERRORS["metric_forbidden"]("only a single SELECT") from error
        if wrong := refusals(parsed, views, own.catalog.tableExists):
            raise ERRORS["metric_forbidden"](", ".join(wrong))
        asked = own.sql(text.strip().rstrip(";"))
        held = [leaf for name in views for leaf in _leaves(own.table(name))]
        if strange := [leaf.nodeName() for leaf in _leaves(asked) if leaf.nodeName() not in BARE and not any(leaf.sameResult(h) for h in held)]:
            raise ERRORS["metric_forbidden"](f"reads {', '.join(sorted(set(strange)))}")
        found = asked.limit(most + 1).persist()
        try:
            told["rows"] = _within(own, found.count, seconds)
            if told["rows"] > most:
                raise ERRORS["result_too_large"]()
        except BaseException:
            found.unpersist()
            told["outcome"], told["rows"] = "result_too_large", 0
            raise
        told["outcome"] = "ok"
        return found
    finally:
        if audit is not None:
            audit(told)


def _within(spark: SparkSession, work: Callable[[], int], seconds: float) -> int:
    """The work's result; its jobs are cancelled, and it is refused, once it takes longer."""
    context, tag, late = spark.sparkContext, f"quota-{uuid.uuid4().hex}", threading.Event()

    def stop() -> None:
        late.set()
        context.cancelJobsWithTag(tag)

    timer = threading.Timer(seconds, stop)
    context.addJobTag(tag)
    timer.start()
    try:
        return work()
    except Exception as error:
        if late.is_set():
            raise ERRORS["result_too_large"](f"took more than {seconds:g} seconds") from error
        raise
    finally:
        timer.cancel()
        context.removeJobTag(tag)

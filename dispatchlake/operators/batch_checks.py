"""Checks of whole batches as a source delivers them: every value is text, and a batch stands or falls as one.

Each check is one aggregation by batch (and one by batch and key for what repeats); the verdicts are in
`quality.verdicts`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import blank_to_null, try_timestamp
from . import quality

#: Fixed value: whole numbers as the source writes them.
WHOLE = r"^[+-]?[0-9]+\z"


def _whole(text: Column) -> Column:
    return F.coalesce(text.rlike(WHOLE), F.lit(False))


def leg_findings(rows: DataFrame, batch: list[str], call: str, seq: str, start: str, times: list[str], ordered: list[tuple[str, str]]) -> DataFrame:
    """Records of calls: rows with an empty key, a sequence that is no whole number, an empty start, times that do not
    have the source's form or do not exist, pairs of times in the wrong order, and sequences repeated in a call."""
    keyed = blank_to_null(F.col(call)).isNotNull() & blank_to_null(F.col(seq)).isNotNull()
    read = {c: try_timestamp(F.col(c)) for c in times}
    rules = {
        "empty_key": ~keyed,
        "bad_seq": keyed & ~_whole(F.col(seq)),
        "empty_start": blank_to_null(F.col(start)).isNull(),
        **{f"bad_{c}": blank_to_null(F.col(c)).isNotNull() & read[c].isNull() for c in times},
        **{f"{later}_before_{earlier}": read[later] < read[earlier] for earlier, later in ordered},
    }
    found = quality.batch_findings(rows, rules, batch)
    twice = rows.filter(keyed).groupBy(*batch, call, seq).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    twice = twice.groupBy(*batch).agg(F.count(F.lit(1)).alias("repeated_seq"))
    return found.join(twice, batch, "left").fillna(0, ["repeated_seq"])


def unknown_values(rows: DataFrame, batch: list[str], column: str, known: list[str]) -> DataFrame:
    """Values outside a code set, by batch: they are asked about, and do not hold the batch back."""
    value = F.coalesce(F.col(column), F.lit(""))
    return rows.filter(~value.isin(*known)).groupBy(*batch, value.alias("value")).agg(F.count(F.lit(1)).alias("rows"))


RECORD = "id string, idxs array<struct<id: string, val: string>>"
INTERVALS = "array<struct<inTime: string, outTime: string, duration: string>>"


def records(rows: DataFrame, batch: list[str], column: str = "payload") -> DataFrame:
    """batch, id, idxs, readable and has_idxs of records received as JSON; what cannot be read is kept as such."""
    parsed = rows.select(*batch, F.from_json(column, RECORD).alias("r"))
    return parsed.select(*batch, blank_to_null(F.col("r.id")).alias("id"), F.coalesce("r.idxs", F.array().cast("array<struct<id: string, val: string>>")).alias("idxs"), F.col("r").isNotNull().alias("readable"), F.col("r.idxs").isNotNull().alias("has_idxs"))


def _agents(parsed: DataFrame, asked: DataFrame, batch: list[str]) -> DataFrame:
    """By batch: agents that several records have, and agents that were not asked for (asked: id)."""
    per = parsed.filter("id is not null").groupBy(*batch, "id").agg(F.count(F.lit(1)).alias("n"))
    per = per.join(asked.select("id", F.lit(True).alias("asked")).distinct(), "id", "left")
    return per.groupBy(*batch).agg(F.count_if(F.col("n") > 1).alias("repeated_agents"), F.count_if(F.col("asked").isNull()).alias("not_asked"))


def _of(index: str) -> Column:
    return F.filter("idxs", lambda x: x["id"] == index)


def session_findings(rows: DataFrame, asked: DataFrame, batch: list[str], index: str) -> DataFrame:
    """Sign-in intervals: records without id or index, agents repeated or not asked for, intervals whose times or
    durations do not have the source's form, end before they begin, or occur twice."""
    parsed = records(rows, batch)
    own = _of(index)
    record_rules = {"without_id": F.col("id").isNull(), "without_index_list": ~F.col("has_idxs"), "index_missing_or_repeated": F.size(own) != 1}
    found = quality.batch_findings(parsed, record_rules, batch).withColumnRenamed("n", "records")
    # an index without a value: no interval that day
    each = parsed.filter(F.size(own) == 1).select(*batch, "id", F.explode(F.from_json(F.get(own, F.lit(0))["val"], INTERVALS)).alias("i"))
    begin, end = F.col("i.inTime"), blank_to_null(F.col("i.outTime"))
    rules = {
        "bad_in_time": try_timestamp(begin).isNull(),
        "bad_out_time": try_timestamp(begin).isNotNull() & end.isNotNull() & try_timestamp(end).isNull(),
        "out_before_in": try_timestamp(end) < try_timestamp(begin),
        "bad_duration": blank_to_null(F.col("i.duration")).isNotNull() & ~_whole(F.col("i.duration")),
    }
    intervals = quality.batch_findings(each, rules, batch).withColumnRenamed("n", "intervals")
    twice = each.groupBy(*batch, "id", begin.alias("begin")).agg(F.count(F.lit(1)).alias("n")).groupBy(*batch).agg(F.count_if(F.col("n") > 1).alias("repeated_intervals"))
    out = found
    for part in (_agents(parsed, asked, batch), intervals, twice):
        out = out.join(part, batch, "left")
    return out.fillna(0)


def day_findings(rows: DataFrame, asked: DataFrame, batch: list[str], indexes: list[str]) -> DataFrame:
    """Day totals: every index that was asked for is there once, as a whole number or without a value; indexes that were
    not asked for are counted as unknown and hold nothing back."""
    parsed = records(rows, batch)
    count = lambda test: sum((test(_of(i)).cast("int") for i in indexes), F.lit(0))
    value = lambda own: F.get(own, F.lit(0))["val"]
    checked = parsed.select(
        *batch, "id", "has_idxs",
        count(lambda own: F.size(own) == 0).alias("_missing"),
        count(lambda own: F.size(own) > 1).alias("_repeated"),
        count(lambda own: (F.size(own) == 1) & value(own).isNotNull() & ~_whole(value(own))).alias("_not_whole"),
        F.size(F.filter("idxs", lambda x: ~x["id"].isin(*indexes))).alias("_unknown"),
    )
    total = lambda name: F.sum(f"_{name}").alias(name)
    found = checked.groupBy(*batch).agg(F.count(F.lit(1)).alias("records"), F.count_if(F.col("id").isNull()).alias("without_id"), *map(total, ("missing", "repeated", "not_whole", "unknown")))
    return found.join(_agents(parsed, asked, batch), batch, "left").fillna(0)

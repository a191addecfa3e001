"""Secret scans over an incremental ledger of text blobs.

A blob is a text, addressed by its SHA-256. The ledger is a Parquet table of one row for each pair of blob
and rule version that has been scanned, with the spans found. A scan takes the blobs of all rows (every
version of every path), scans those whose pair is not in the ledger, each once, appends them to it, and
joins the findings back to all rows that hold the blob. A scan that is repeated, or that follows a new
version of the corpus, reads texts only of blobs it has not seen; a scan that breaks off before the append
is committed is repeated, and rows that two scans have appended count once.

Texts that have been seen do not leave their task: a bitmap of the unseen addresses, of fixed size, is broadcast,
and of what passes it a task merges equal texts before any is sent. `compact` makes one table of the ledger's files.

Nulls are scanned as empty texts. Repeated rows share one blob, null and repeated ids are rows of their
own, very long texts are scanned whole, and an empty table stays empty. Other columns of any name are
kept, but for `blob` and `spans`, which are the result's.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import bounded_batches, folder, saved

#: Rows of one blob are joined with its findings in so many tasks.
SALTS = 16
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "private_key", "service_token")

_ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ASSIGN_WORDS = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_PRIVATE = re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----")
_SERVICE = re.compile(r"(?a:\b(?:ghp|gho|ghs|glpat|xoxb|xoxp)[_-][A-Za-z0-9-]{20,})")

#: Follows from the rules themselves: where they change, blobs are scanned anew.
RULE_VERSION = hashlib.sha256(repr([KINDS, *((r.pattern, r.flags) for r in (_ASSIGN, _ACCESS, _HEX, _PRIVATE, _SERVICE)), _ASSIGN_WORDS]).encode()).hexdigest()[:16]
#: The unseen addresses are sketched in so many bits before texts meet them: 32 MB, whatever the corpus.
FILTER_BITS = 1 << 28
_BUCKET = 1 << 15

SPANS = "array<struct<kind: string, start: int, end: int>>"


def find(text: str) -> list[tuple[str, int, int]]:
    """Spans in code points, end exclusive, by start, then by the order of KINDS."""
    found = []
    lower = text.lower() if text.isascii() else text.translate(_LOWER)
    if any(w in lower for w in _ASSIGN_WORDS):
        found += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    if "-----BEGIN " in text:
        found += [("private_key", m.start(), m.end()) for m in _PRIVATE.finditer(text)]
    found += [("service_token", m.start(), m.end()) for m in _SERVICE.finditer(text)] if "gh" in text or "glpat" in text or "xox" in text else []
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        spans = [[{"kind": k, "start": a, "end": b} for k, a, b in find(t)] for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("blob"), pa.array(spans, kind)], names=["blob", "spans"])


def blob_of(text_column: str) -> F.Column:
    """The address of a row's text."""
    return F.unhex(F.sha2(F.coalesce(F.col(text_column), F.lit("")), 256))


class Ledger:
    """The ledger of a corpus at `path`, a folder for each rule version."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    @classmethod
    def of(cls, spark: SparkSession, corpus: str) -> Ledger:
        """The ledger that the shared folder holds for the corpus of this name."""
        return cls(spark, f"{folder(spark)}/secret-ledger/{hashlib.sha256(corpus.encode()).hexdigest()[:24]}")

    def _folder(self, version: str) -> str:
        return f"{self.path}/rule_version={version}"

    def rows(self, version: str = RULE_VERSION) -> DataFrame | None:
        """blob and spans of all that has been scanned under `version`; None before the first scan."""
        try:
            return self.spark.read.schema(f"blob binary, spans {SPANS}").parquet(self._folder(version))
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def append(self, rows: DataFrame, version: str = RULE_VERSION) -> None:
        rows.select("blob", "spans").write.mode("append").parquet(self._folder(version))

    def compact(self, version: str = RULE_VERSION) -> None:
        """One row for each blob, in as few files as their number asks for. If it breaks off between its two renames, the
        ledger is empty and the next scan fills it again."""
        held = self.rows(version)
        if held is None:
            return
        live, new, old = (f"{self._folder(version)}{end}" for end in ("", ".new", ".old"))
        held.dropDuplicates(["blob"]).write.mode("overwrite").parquet(new)
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        files = path(live).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        files.delete(path(old), True)
        files.rename(path(live), path(old))
        files.rename(path(new), path(live))
        files.delete(path(old), True)


def _place(blob: str) -> tuple[F.Column, F.Column]:
    """(bucket, bit) of an address in the bitmap."""
    bit = F.xxhash64(blob).bitwiseAND(F.lit(FILTER_BITS - 1))
    return F.floor(bit / _BUCKET), bit % _BUCKET


def _may_hold(texts: DataFrame, unseen: DataFrame) -> DataFrame:
    """The rows of `texts` (blob, text) whose address may be one of `unseen` (blob); none that is, is lost."""
    bucket, bit = _place("blob")
    bitmap = unseen.select(bucket.alias("_bucket"), bit.alias("_bit")).groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = texts.withColumn("_bucket", bucket).join(F.broadcast(bitmap), "_bucket")
    return held.filter(byte.bitwiseAND(F.element_at(F.array(*(F.lit(1 << i) for i in range(8))), (bit % 8).cast("int") + 1)) != 0).select("text", "blob")


def scan_new(docs: DataFrame, seen: DataFrame | None = None, text_column: str = "text") -> DataFrame:
    """blob and spans of the blobs of `docs` that `seen` (blob) does not hold.

    Addresses are made distinct before they meet what has been seen, and a partition sends each text once."""
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(text_column), F.lit("")).alias("text"), blob_of(text_column).alias("blob"))
    if seen is not None:
        unseen = saved(texts.select("blob").distinct().join(seen.select("blob"), "blob", "left_anti"), "secret-unseen")
        texts = texts.filter(F.lit(False)) if unseen.isEmpty() else _may_hold(texts, unseen)
    # first() of one blob's rows is the same text whichever row it comes from
    once = texts.groupBy("blob").agg(F.first("text").alias("text"))
    once = once if seen is None else once.join(unseen, "blob", "left_semi")
    return once.mapInArrow(_scan, f"blob binary, spans {SPANS}")


def update(docs: DataFrame, ledger: Ledger, version: str = RULE_VERSION, text_column: str = "text") -> DataFrame:
    """Scans what `ledger` has not seen of `docs`, appends it, and returns the ledger's rows."""
    found = saved(scan_new(docs, ledger.rows(version), text_column), "secret-news") if ledger.rows(version) is not None else scan_new(docs, None, text_column)
    if ledger.rows(version) is None or not found.isEmpty():
        ledger.append(found, version)
    return ledger.rows(version)


def scan(docs: DataFrame, ledger: Ledger | None = None, version: str = RULE_VERSION, text_column: str = "text") -> DataFrame:
    """`docs` with `blob` and `spans`; what is scanned goes to `ledger`, or without one is forgotten."""
    known = saved(scan_new(docs, None, text_column), "secret-spans") if ledger is None else update(docs, ledger, version, text_column)
    # a blob that a third of all rows hold is met in SALTS tasks, not in one
    found = known.filter(F.size("spans") > 0).dropDuplicates(["blob"]).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c not in ("blob", "spans")))
    rows = docs.select(own.alias("doc"), blob_of(text_column).alias("blob"), (F.monotonically_increasing_id() % SALTS).cast("int").alias("salt"))
    rows = rows.join(found, ["blob", "salt"], "left").withColumn("spans", F.coalesce("spans", F.array().cast(SPANS)))
    return rows.select("doc.*", "blob", "spans")


def _named(s) -> F.Column:
    return F.concat_ws(":", s["kind"], s["start"], s["end"])


def report(docs: DataFrame, ledger: Ledger | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of every row of `docs`."""
    rows = scan(docs.select("doc_id", "text"), ledger)
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    of_kind = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k))
    counts = [of_kind(k).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    joined = lambda spans: F.array_join(F.transform(spans, _named), ",")
    return rows.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op3_secret_scan(spark, sf_dir: str) -> DataFrame:
    """The contract's columns for every row of documents, over the ledger of this corpus."""
    return report(spark.read.parquet(f"{sf_dir}/documents.parquet"), Ledger.of(spark, sf_dir))

"""Contracts of the shapes that sources have give no problem; broken ones give all of theirs; nothing raises."""

import copy
import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dispatchlake.sources import contract_rules, contracts

CALLS = """
source_id: pbx_calls
connector: rest_api
target_raw: raw.pbx_calls
contract_version: 3
enabled: true
endpoint:
  method: POST
  path: /reports/calls
  host_ref: pbx_gateway
  request_body: {siteId: 1, startTime: "{{ window_from }}", endTime: "{{ window_to }}"}
  response: csv_attachment
auth:
  scheme: token_header
  header: x-token
  obtain: {method: POST, path: /auth, credential_ref: pbx_account}
  token_ttl_unknown: true
window:
  filter_column: BEGIN
  max_span_hours: 24
  min_span_seconds: 5
  concurrency: 1
  lookback_minutes: 15
  source_timezone: UTC
  schedule: "*/5 * * * *"
watermark: {type: timestamptz, column: BEGIN}
idempotent_key: [CALL, LEG]
raw_write: {mode: append_if_changed, content_hash: all_source_columns, dedup_ignores_batches: [pending, discarded]}
core_version: {from: observed_at}
columns:
  - {src: CALL, type: text, target: leg.call, state: verified, note: "x"}
  - {src: LEG, type: integer, target: leg.seq, state: verified}
  - {src: BEGIN, type: timestamptz, target: leg.begin, state: mapped_unverified}
  - {src: KIND, type: smallint, target: leg.kind, state: unknown}
enums:
  device: {table: device.csv, used: {queue: 1, agent: 2}}
  kind: {table: kind.csv, values: [0, 1, 2, 3], inbound: [0, 1], outbound: [2]}
  release_cause: {table: cause.csv, classes: {agent: [521], caller: [501, 502], system: [503]}}
quality: {batch_checks: ["a key once"], recon: rolling}
integration_checks: [{id: zone, question: which, why: shifts, status: open}]
"""
SESSIONS = """
source_id: pbx_sessions
connector: rest_api
contract_version: 1
enabled: true
endpoint:
  host_ref: pbx_gateway
  response: json
  site: {cc: "1"}
  index_ids: [IDX_01]
  objects: {from: pbx_reference, dataset: agents, batch_size: 2000}
  prerequisite: {inherits: pbx_days}
auth: {inherits: pbx_calls}
window: {grain: observation, schedule: "*/10 * * * *", day_timezone: Asia/Riyadh, midnight_skip_minutes: 30}
watermark: {type: timestamptz, column: observed_at}
idempotent_key: [id, at]
raw_write: {mode: append_if_changed}
columns:
  - {src: id, type: text, target: a.b, state: verified}
  - {src: at, type: date, target: a.c, state: verified, origin: derived}
  - {src: IDX_01, type: integer, target: a.d, state: verified}
"""
REFERENCE = """
source_id: pbx_reference
connector: rest_api
contract_version: 2
endpoint:
  host_ref: pbx_gateway
  version_probe: {path: /versions}
  datasets:
    - {name: sites, path: /sites, scope: cti, key: siteId, target: core.site}
    - {name: agents, path: "/agents/{ccId}/{vdnId}", scope: vdn, key: agentNo}
    - {name: rules, path: "/rules/{ccId}/{vdnId}", scope: vdn, key: null}
auth: {inherits: pbx_calls}
window: {schedule: "*/30 * * * *", strategy: version_gated, version_stale_days: 7}
watermark: {type: sequence, column: version, per: [ccId, vdnId]}
idempotent_key: [dataset, key]
raw_write: {mode: snapshot_on_version}
core_version: {from: config_version, rules: {greater: apply, equal: nothing, less: ask}}
"""
GOOD = [contracts.load(x) for x in (CALLS, SESSIONS, REFERENCE)]


@pytest.mark.parametrize("raw", GOOD, ids=lambda r: r["source_id"])
def test_good_contracts(raw):
    assert contract_rules.problems(raw) == []
    c = contracts.contract(raw)
    assert c.source_id == raw["source_id"] and c.version == raw["contract_version"] and len(c.digest()) == 64


def test_what_a_contract_gives():
    c = contracts.contract(GOOD[0])
    assert (c.columns, c.key, c.zone, c.lookback_minutes, c.max_span_seconds, c.min_span_seconds) == (("CALL", "LEG", "BEGIN", "KIND"), ("CALL", "LEG"), "UTC", 15, 86400, 5)
    assert c.mapping["KIND"] == "unknown" and c.code_sets == {"kind": ("0", "1", "2", "3")}
    assert contracts.contract(GOOD[1]).batch_size == 2000 and contracts.contract(GOOD[2]).columns == ()
    short = contracts.contract({"source_id": "s", "version": 1, "connector": "file_drop", "columns": ["a", "b"], "key": ["a"], "zone": "Asia/Riyadh", "lookback_minutes": 30, "mapping": {"b": "verified"}, "code_sets": {"k": ["1"]}})
    assert (short.zone, short.lookback_minutes, short.mapping, short.code_sets) == ("Asia/Riyadh", 30, {"a": "unknown", "b": "verified"}, {"k": ("1",)})


def changed(raw, path, value):
    raw = copy.deepcopy(raw)
    own = raw
    *way, last = path
    for step in way:
        own = own[step]
    if value is KeyError:
        del own[last]
    else:
        own[last] = value
    return raw


BROKEN = [
    (0, ["source_id"], "Calls", "source_id must"), (0, ["contract_version"], True, "contract_version must"), (0, ["contract_version"], 0, "contract_version must"), (0, ["connector"], "ftp", "connector must"),
    (0, ["enabled"], "yes", "enabled must"), (0, ["endpoint", "host_ref"], "http://x", "endpoint.host_ref must"), (0, ["endpoint", "response"], "xml", "endpoint.response must"),
    (0, ["endpoint", "request_body", "password"], "x", "endpoint.request_body.password looks"), (0, ["auth", "obtain", "client_secret"], "x", "auth.obtain.client_secret looks"), (0, ["auth", "obtain", "credential_ref"], KeyError, "auth.obtain.credential_ref is missing"),
    (0, ["auth", "obtain"], KeyError, "auth says"), (0, ["auth"], [], "auth must"), (1, ["auth", "inherits"], "Not A Name", "auth.inherits must"),
    (0, ["window", "max_span_hours"], 0, "window.max_span_hours must"), (0, ["window", "min_span_seconds"], 90_000, "window.min_span_seconds exceeds"), (0, ["window", "concurrency"], None, "window.concurrency must"),
    (0, ["window", "restate_days"], -1, "window.restate_days must"), (0, ["window", "lookback_minutes"], 1441, "window.lookback_minutes must"), (0, ["window", "source_timezone"], "Mars/One", "window.source_timezone must"),
    (0, ["window", "source_timezone"], KeyError, "window.source_timezone is missing"), (0, ["window", "schedule"], "daily", "window.schedule must"), (0, ["window", "filter_column"], "GONE", "window.filter_column names GONE"),
    (1, ["window", "day_timezone"], ["x"], "window.day_timezone must"), (1, ["window", "midnight_skip_minutes"], 61, "window.midnight_skip_minutes must"), (2, ["window", "version_stale_days"], 367, "window.version_stale_days must"),
    (0, ["watermark", "type"], "clock", "watermark.type must"), (0, ["watermark", "column"], "GONE", "watermark.column names GONE"), (0, ["watermark"], {"type": "sequence"}, "watermark.column is missing"),
    (0, ["idempotent_key"], [], "idempotent_key must"), (0, ["idempotent_key"], ["CALL", "CALL"], "idempotent_key[] repeats CALL"), (0, ["idempotent_key", 1], "GONE", "idempotent_key[] names GONE"), (0, ["idempotent_key"], KeyError, "idempotent_key is missing"),
    (0, ["raw_write", "mode"], "overwrite", "raw_write.mode must"), (0, ["columns"], KeyError, "columns is missing"), (0, ["columns", 0, "state"], "sure", "columns[0].state must"), (0, ["columns", 0, "state"], KeyError, "columns[0].state is missing"),
    (0, ["columns", 1, "type"], "int", "columns[1].type must"), (0, ["columns", 1, "src"], "CALL", "columns[].src repeats CALL"), (0, ["columns", 3], 5, "columns[3] must"), (0, ["columns", 3, "src"], "", "columns[3].src must"),
    (0, ["enums", "kind", "values"], [0, 0], "enums.kind.values repeats"), (0, ["enums", "kind", "inbound"], [2], "enums.kind has codes both"), (0, ["enums", "kind", "outbound"], [9], "enums.kind has codes of a direction"),
    (0, ["enums", "release_cause", "classes", "robot"], [9], "enums.release_cause.classes has the unknown class robot"), (0, ["enums", "release_cause", "classes", "agent"], [501], "enums.release_cause.classes has a code twice"),
    (0, ["enums", "release_cause", "classes", "agent"], ["x"], "enums.release_cause.classes.agent[0] must"), (0, ["enums", "release_cause", "classes", "agent"], [], "enums.release_cause.classes.agent must"), (0, ["enums", "device"], 5, "enums.device must"),
    (1, ["endpoint", "index_ids"], ["IDX_02"], "endpoint.index_ids and columns differ"), (1, ["endpoint", "index_ids"], ["IDX_01", "IDX_01"], "endpoint.index_ids[] repeats"), (1, ["endpoint", "objects", "batch_size"], 0, "endpoint.objects.batch_size must"),
    (2, ["endpoint", "version_probe"], {"note": "x"}, "endpoint.version_probe.path is missing"), (2, ["endpoint", "datasets"], [], "endpoint.datasets must"), (2, ["endpoint", "datasets", 0, "path"], "sites", "endpoint.datasets[0].path must"),
    (2, ["endpoint", "datasets", 1, "path"], "/agents/{ccId}", "endpoint.datasets[1].path lacks {vdnId}"), (2, ["endpoint", "datasets", 0, "scope"], "all", "endpoint.datasets[0].scope must"), (2, ["endpoint", "datasets", 2, "key"], KeyError, "endpoint.datasets[2].key is missing"),
    (2, ["endpoint", "datasets", 1, "name"], "sites", "endpoint.datasets[].name repeats sites"), (2, ["endpoint", "datasets", 1], "x", "endpoint.datasets[1] must"),
]


@pytest.mark.parametrize(("which", "path", "value", "told"), BROKEN, ids=lambda x: str(x)[:40])
def test_a_broken_field_is_told(which, path, value, told):
    found = contract_rules.problems(changed(GOOD[which], path, value))
    assert [f for f in found if f.startswith(told)], found
    with pytest.raises(ValueError):
        contracts.contract(changed(GOOD[which], path, value))


def test_all_are_told_at_once():
    raw = GOOD[0]
    apart = [b for b in BROKEN if b[0] == 0 and b[2] is not KeyError and len(b[1]) == 2 and b[1][0] == "window" and b[3].startswith("window.") and "must" in b[3]]
    for _, path, value, _ in apart:
        raw = changed(raw, path, value)
    found = contract_rules.problems(raw)
    assert len({b[3] for b in apart}) > 5 and all(any(f.startswith(told) for f in found) for told in {b[3] for b in apart})


anything = st.recursive(st.none() | st.booleans() | st.integers() | st.text(max_size=5) | st.floats() | st.dates() | st.just(dt.time()), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(max_size=6) | st.integers(), x, max_size=3), max_leaves=8)
fields = sorted({p.split(".")[0].split("[")[0].split("{")[0] for p, *_ in contract_rules.RULES} | {*contract_rules.SHORT, "mapping", "code_sets"})


@settings(max_examples=400, deadline=None)
@given(st.sampled_from(GOOD), st.dictionaries(st.sampled_from(fields), anything), st.lists(st.tuples(st.sampled_from([b[1] for b in BROKEN]), anything), max_size=3))
def test_no_shape_raises(raw, top, deep):
    for path, value in deep:
        try:
            raw = changed(raw, path, value)
        except (KeyError, IndexError, TypeError, AttributeError):
            continue
    assert isinstance(contract_rules.problems(raw | top), list)


@settings(max_examples=100, deadline=None)
@given(anything)
def test_nothing_raises(raw):
    assert contract_rules.problems(raw)

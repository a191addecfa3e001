"""Controlled SQL: what may run gives its rows, and whatever is not known to be harmless is refused."""

import datetime as dt

import pytest

from dispatchlake.plans import controlled, semantic

VIEWS = frozenset({"allowed_view", "other_view"})
FORBIDDEN = semantic.ERRORS["metric_forbidden"]


@pytest.fixture(scope="module", autouse=True)
def views(spark):
    spark.range(3).createOrReplaceTempView("allowed_view")
    spark.range(5, 9).selectExpr("id", "id % 2 AS odd", "cast(id AS string) AS name").createOrReplaceTempView("other_view")
    spark.range(3).createOrReplaceTempView("secret_view")
    spark.range(4).createOrReplaceGlobalTempView("secret_global")
    spark.sql("CREATE TABLE IF NOT EXISTS secret_table USING parquet AS SELECT 7 AS id")
    spark.udf.register("peek", lambda x: x)
    yield
    spark.sql("DROP TABLE secret_table")


def asked(spark, text, **more):
    return list(map(tuple, controlled.controlled_sql(spark, text, VIEWS, **more).collect()))


@pytest.mark.parametrize(
    ("text", "rows"),
    [
        ("SELECT count(*) AS n FROM allowed_view", [(3,)]),
        ("select odd, max(name) AS m FROM OTHER_VIEW GROUP BY odd HAVING count(*) > 1 ORDER BY odd DESC LIMIT 5;", [(0, "8"), (1, "7")]),
        ("WITH a AS (SELECT id + 5 AS id FROM allowed_view), b AS (SELECT * FROM a) SELECT b.id FROM b JOIN other_view USING (id) WHERE odd = 1", [(5,), (7,)]),
        ("SELECT id FROM allowed_view WHERE id IN (SELECT id - 5 FROM other_view WHERE odd = 0) OR NOT EXISTS (SELECT 1 FROM other_view WHERE id < 0) AND id = 0", [(0,), (1,)]),
        ("SELECT (SELECT max(id) FROM other_view) AS m UNION ALL SELECT min(id) FROM allowed_view", [(0,), (8,)]),
        ("SELECT id, row_number() OVER (PARTITION BY odd ORDER BY id DESC) AS r FROM other_view", [(5, 2), (6, 2), (7, 1), (8, 1)]),
        ("SELECT sum(CASE WHEN id BETWEEN 1 AND 2 THEN try_divide(id, 2) ELSE 0 END) FILTER (WHERE id <> 9) AS s, cast('1' AS int) AS c, upper(trim(' x ')) AS u FROM allowed_view", [(1.5, 1, "X")]),
        ("SELECT odd, count(*) AS n FROM other_view GROUP BY ROLLUP (odd)", [(0, 2), (1, 2), (None, 4)]),
    ],
)
def test_what_runs(spark, text, rows):
    assert sorted(asked(spark, text), key=str) == sorted(rows, key=str)


@pytest.mark.parametrize(
    "text",
    [
        "SELECT * FROM secret_view",
        "SELECT * FROM IDENTIFIER('secret_view')",
        "SELECT * FROM allowed_view WHERE id IN (SELECT id FROM IDENTIFIER('secret' || '_view'))",
        "SELECT (SELECT max(id) FROM secret_view) AS m FROM allowed_view",
        "SELECT IDENTIFIER('i' || 'd') FROM allowed_view",
        "SELECT java_method('java.lang.System', 'getProperty', 'user.home')",
        "SELECT reflect('java.lang.System', 'getProperty', 'user.home') FROM allowed_view",
        "SELECT id FROM allowed_view WHERE try_reflect('java.lang.System', 'getenv', 'HOME') IS NULL",
        "SELECT max(id) OVER (ORDER BY reflect('java.lang.System', 'getProperty', 'user.home')) FROM allowed_view",
        "SELECT max(id) OVER w FROM allowed_view WINDOW w AS (ORDER BY reflect('java.lang.System', 'getProperty', 'user.home'))",
        "SELECT count(*) FROM allowed_view GROUP BY CUBE (java_method('java.lang.System', 'getProperty', 'user.home'))",
        "SELECT * FROM parquet.`/tmp/x`",
        "SELECT * FROM text.`/etc/passwd`",
        "SELECT * FROM range(3)",
        "SELECT * FROM read_files('/etc/passwd')",
        "SELECT explode(array(1))",
        "SELECT * FROM allowed_view LATERAL VIEW explode(array(1)) t AS y",
        "SELECT * FROM VALUES (1) AS t(a)",
        "SELECT * FROM secret_table",
        "SELECT * FROM default.secret_table",
        "SELECT * FROM spark_catalog.default.secret_table",
        "SELECT * FROM global_temp.secret_global",
        "SELECT * FROM secret_table, (WITH secret_table AS (SELECT 1 AS id) SELECT id AS i FROM secret_table)",
        "WITH allowed AS (SELECT * FROM secret_view) SELECT * FROM allowed",
        "WITH allowed_view AS (SELECT 1 AS id) SELECT * FROM allowed_view",
        "WITH a AS (SELECT 1 AS id) INSERT INTO allowed_view SELECT * FROM a",
        "SELECT peek(id) FROM allowed_view",
        "SELECT input_file_name() FROM allowed_view",
        "SELECT TRANSFORM (id) USING 'cat' FROM allowed_view",
        "SELECT /*+ BROADCAST(a) */ * FROM allowed_view a",
        "SELECT id FROM allowed_view TIMESTAMP AS OF '2020-01-01'",
        "FROM allowed_view |> SELECT id |> WHERE reflect('a', 'b') IS NULL",
        "SELECT 1; SELECT 2",
        "BEGIN SELECT 1; END",
        "EXECUTE IMMEDIATE 'SELECT 1'",
        "DROP VIEW allowed_view",
        "SET spark.sql.ansi.enabled = false",
        "ADD JAR '/tmp/x.jar'",
        "CREATE TABLE t AS SELECT 1",
        "EXPLAIN SELECT * FROM secret_view",
        "SHOW TABLES",
        "DESCRIBE secret_view",
        "not sql",
        "",
    ],
)
def test_what_is_refused(spark, text):
    entries = []
    with pytest.raises(FORBIDDEN):
        controlled.controlled_sql(spark, text, VIEWS, audit=entries.append)
    assert [(e["statement"], e["outcome"]) for e in entries] == [(text, "metric_forbidden")]


def test_grants(spark):
    me, now = semantic.Principal("p1", ("analyst",)), dt.datetime(2026, 5, 1, tzinfo=dt.UTC)
    good = controlled.Grant("p1", True, "operations", "audit of May", now + dt.timedelta(days=1), daily=3, most=3)
    text = "SELECT * FROM allowed_view"
    assert len(asked(spark, text, principal=me, grant=good, at=now, asked_today=2)) == 3
    with pytest.raises(semantic.ERRORS["result_too_large"]):
        asked(spark, text, principal=me, grant=good._replace(most=2), at=now)
    faulty = [good._replace(**x) for x in ({"principal": "p2"}, {"verified": False}, {"responsible": " "}, {"reason": ""}, {"expires": now}, {"revoked": True}, {"daily": 0})]
    for grant in faulty:
        with pytest.raises(FORBIDDEN):
            asked(spark, text, principal=me, grant=grant, at=now)
    with pytest.raises(FORBIDDEN):
        asked(spark, text, principal=semantic.Principal("p1", ("admin",), natural=False), grant=good, at=now)

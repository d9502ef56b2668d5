import json

import pytest

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from runledger.functions.row_text import row_json, row_text
from runledger.functions.sql_text import is_result_query
from runledger.operators import batch as batches
from runledger.operators.batch import batch_outcomes, run_batch
from runledger.operators.run_log import read_run_log, stream_run_log
from runledger.operators.run_status import final_outcome
from runledger.operators.statements import (
    collect_rows,
    result_schema,
    run_sql,
    stamp_run,
    unique_out_path,
    write_result_text,
)
from runledger.session import session_builder
from runledger.sources.shared import fresh_folder
from runledger.sources.tables import read_table, register_views
from runledger.streaming.sinks import append_available

from submit import submit

# sql, is a result query, outcome. t1 is a table with customer rows, cu a view.
STATEMENTS = [
    ("select 1+2", True, "FINISHED", None),
    ("  select 1", True, "FINISHED", None),
    ("SELECT 1", True, "FINISHED", None),
    ("/* c */ with x as (select 1 a) select a from x", True, "FINISHED", None),
    ("-- hi\nselect 1", True, "FINISHED", None),
    ("values (1,'a'),(2,'b')", True, "FINISHED", None),
    ("(select 1) union (select 2)", True, "FINISHED", None),
    ("from t1 select *", True, "FINISHED", None),
    ("table t1", True, "FINISHED", None),
    ("show tables", False, "FINISHED", None),
    ("describe query select 1+2 as v", False, "FINISHED", None),
    ("create table t2 using parquet as select * from t1", False, "FINISHED", None),
    ("insert into t1 select * from cu", False, "FINISHED", None),
    ("with x as (select * from cu) insert into t1 select * from x", False, "FINISHED", None),
    ("from cu insert into t1 select *", False, "FINISHED", None),
    ("selec 1", False, "PARSEFAILED", "PARSE_SYNTAX_ERROR"),
    ("selected", False, "PARSEFAILED", "PARSE_SYNTAX_ERROR"),
    ("select nope from t1", True, "PLANFAILED", "UNRESOLVED_COLUMN.WITH_SUGGESTION"),
    ("select * from no_such_table", True, "PLANFAILED", "TABLE_OR_VIEW_NOT_FOUND"),
    ("insert into no_such_table select 1", False, "PLANFAILED", "TABLE_OR_VIEW_NOT_FOUND"),
    ("select 1/0", True, "FAILED", "DIVIDE_BY_ZERO"),
    ("select raise_error('x')", True, "FAILED", "USER_RAISED_EXCEPTION"),
    ("create table t1 (a int) using parquet", False, "FAILED", "TABLE_OR_VIEW_ALREADY_EXISTS"),
    ("insert into t1 select raise_error('x'), '', 0, 0, '' from cu", False, "FAILED",
     "USER_RAISED_EXCEPTION"),
]

MORE_TEXTS = [
    ("select 'insert into t'", True),
    ('select "--" as a', True),
    ("select '/*' as a, 'it''s' as b", True),
    ("select 'it\\'s -- not' as a", True),
    ("select `insert into` from t", True),
    ("/* a */ -- b\n /* insert into */ ( ( select 1))", True),
    ("-- it's\nselect 1", True),
    ("-- more \\\nof it\nselect 1", True),
    ("-- select 1", False),
    ("with x as (select 1) insert\n overwrite t select * from x", False),
    ("merge into t using s on true when matched then delete", False),
    ("explain select 1", False),
    ("values(1)", True),
    ("TABLE t", True),
    ("tables", False),
    ("", False),
    ("/* a /* insert into t */ b */ select 1", True),
    ("/* a /* b */ select 1", False),
    ("/* don't */ select 1 /* /* \" */ */", True),
    ("select 2*/* insert into t */3", True),
    ("select 8/2 - -1", True),
    ("select /*+ broadcast(t) */ a from t", True),
    ("select r'c:\\' as a, 'insert into t' as b", True),
    ("with x as (select R\"\\\" as a) insert into t select * from x", False),
    ("select $$it's /* insert into$$ as a", True),
    ("with x as (select bar'x' from t) update a.`b c` set d = 1", False),
    ("with x as (select 1) update /* the */ t set d = 1", False),
    ("select 'a' /* b */ 'c', \"--\", `a``b -- ` from t", True),
    ("insert /* x */ into t values (1)", False),
    ("with x as (select 1) insert -- y\n into t select 1", False),
]


def test_classify(spark):
    cases = [(s[0], s[1]) for s in STATEMENTS] + MORE_TEXTS
    df = spark.createDataFrame(cases, "sql string, want boolean")
    wrong = df.where(is_result_query(F.col("sql")) != F.col("want")).collect()
    assert wrong == []


def test_classify_nothing(spark):
    df = spark.createDataFrame([(None,)], "sql string")
    assert df.select(is_result_query(F.col("sql"))).first()[0] is None


def test_submit_arguments():
    from submit import arguments

    assert arguments(["--hive", "/base", "select 1"]).hive
    given = arguments(["/base", "select 1"])
    assert (given.hive, given.base, given.sql) == (False, "/base", "select 1")


def test_classify_long_literals(spark):
    text = "select '" + "\\'" * 200_000 + "' /*" + "*" * 200_000 + "*/"
    df = spark.createDataFrame([(text,)], "sql string")
    assert df.select(is_result_query(F.col("sql"))).first()[0] is True


def test_first_word_sample(spark):
    assert run_sql(spark, "select 1+2").first()[0] == 3


def test_args(spark):
    assert run_sql(spark, "select :a + 1 as b", {"a": 2}).first().b == 3


def test_row_text(spark):
    df = run_sql(
        spark,
        "select 1 as a, 'x,y' as a, cast(null as int) as `b.c`, array(1, 2) as d,"
        " map('k', 1) as e, cast(1.50 as decimal(5,2)) as f, named_struct('g', true) as h",
    )
    assert row_text(df).first().value == "[1,x,y,null,[1, 2],{k -> 1},1.50,{true}]"
    assert row_text(run_sql(spark, "select 1 as a where false")).count() == 0


def test_row_json(spark):
    df = run_sql(spark, "select 1 as a, 'x,\"y' as b, cast(null as int) as c")
    assert row_json(df).first().value == '{"a":1,"b":"x,\\"y","c":null}'


def test_write_result_text(spark, sf):
    nations = read_table(spark, sf, "nation")
    out = unique_out_path(fresh_folder(spark, "text"), 7)
    assert out.endswith("/run-7")
    write_result_text(nations, out)
    got = sorted(r.value for r in spark.read.text(out).collect())
    assert got == sorted(f"[{r[0]},{r[1]},{r[2]}]" for r in nations.collect())
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_result_text(nations, out)


def test_collect_rows_of_a_command(spark):
    rows = collect_rows(run_sql(spark, "describe query select 1 as v"))
    assert [r.value for r in rows.collect()] == ["[v,int,null]"]


def test_result_schema(spark):
    df = run_sql(
        spark,
        "select 1 as a, array('x') as b, map('k', 'v') as c, cast(1 as decimal(5,2)) as d,"
        " cast(null as string) as e",
    )
    assert [tuple(r) for r in result_schema(df).collect()] == [
        (0, "a", "int", False),
        (1, "b", "array<string>", False),
        (2, "c", "map<string,string>", False),
        (3, "d", "decimal(5,2)", True),
        (4, "e", "string", True),
    ]
    assert result_schema(run_sql(spark, "use default")).count() == 0


def test_stamp_run(spark):
    row = stamp_run(spark.range(1), "here").first()
    assert row.submit_host == "here" and row.submitted_at is not None


def test_hive_switch():
    options = session_builder(hive=True)._options
    assert options["spark.sql.catalogImplementation"] == "hive"
    builder = session_builder(conf={"spark.sql.session.timeZone": "Europe/Paris"})
    assert builder._options["spark.sql.session.timeZone"] == "Europe/Paris"


@pytest.fixture(scope="module")
def batch(spark, sf):
    register_views(spark, sf, ("customer",))
    run_sql(spark, "create temporary view cu as select * from customer")
    run_sql(spark, "create table t1 using parquet as select * from cu")
    statements = spark.createDataFrame(
        [(i, s[0]) for i, s in enumerate(STATEMENTS)], "stmt_id bigint, sql string"
    )
    log, out = fresh_folder(spark, "log"), fresh_folder(spark, "results")
    return run_batch(spark, statements, log, out), log, out


def test_run_batch_outcomes(spark, batch):
    outcomes, _, out = batch
    assert len(outcomes) == len(STATEMENTS)
    for outcome, (sql, is_query, state, error) in zip(outcomes, STATEMENTS):
        assert (sql, outcome.state, outcome.error_class) == (sql, state, error)
        assert (outcome.reason is None) == (error is None)
        if state == "FINISHED" and is_query:
            assert outcome.out_path == unique_out_path(out, outcome.run_id)
            assert spark.read.text(outcome.out_path).count() > 0
    assert outcomes[0].schema.simpleString() == "struct<(1 + 2):int>"
    shown = [o for o, s in zip(outcomes, STATEMENTS) if s[0] == "show tables"][0]
    assert collect_rows(shown.result).where("value like '%t1%'").count() == 1


def test_run_batch_log(spark, batch):
    _, log, _ = batch
    rows = read_run_log(spark, log)
    assert rows.count() == 2 * len(STATEMENTS)
    assert rows.where("state = 'SUBMITTED' and submitted_at is null").count() == 0
    got = {r.run_id: r.first_state for r in final_outcome(rows).collect()}
    assert got == {i: s[2] for i, s in enumerate(STATEMENTS)}
    logged = rows.where("run_id = 0 and state = 'FINISHED'").first()
    assert StructType.fromJson(json.loads(logged.schema_json)).names == ["(1 + 2)"]
    order = rows.orderBy("seq").select("run_id", "state").collect()
    for submitted, ended in zip(order[::2], order[1::2]):
        assert submitted.run_id == ended.run_id
        assert submitted.state == "SUBMITTED"
        assert ended.state == STATEMENTS[ended.run_id][2]


def test_run_log_as_stream(spark, batch):
    _, log, _ = batch
    failed = stream_run_log(spark, log).where("error_class is not null")
    out = fresh_folder(spark, "failed")
    append_available(failed, out, fresh_folder(spark, "progress")).awaitTermination()
    assert spark.read.parquet(out).count() == sum(s[3] is not None for s in STATEMENTS)


def test_run_batch_without_output(spark):
    statements = spark.createDataFrame(
        [(1, "select 1/0"), (2, "select 5 as a"), (3, "create table t2 (a int) using nosuch")],
        "stmt_id bigint, sql string",
    )
    outcomes = run_batch(spark, statements, fresh_folder(spark, "log"))
    assert [o.state for o in outcomes][:2] == ["FAILED", "FINISHED"]
    assert outcomes[1].result.first().a == 5


def test_existing_output_fails_the_run(spark):
    statements = spark.createDataFrame([(1, "select 1")], "stmt_id bigint, sql string")
    log, out = fresh_folder(spark, "log"), fresh_folder(spark, "results")
    assert run_batch(spark, statements, log, out)[0].state == "FINISHED"
    again = run_batch(spark, statements, log, out)[0]
    assert (again.state, again.error_class) == ("FAILED", "PATH_ALREADY_EXISTS")


def test_submit(spark, capsys):
    base = fresh_folder(spark, "base")
    assert submit(spark, base, "select 1+2")
    lines = capsys.readouterr().out.splitlines()
    assert lines[0] == "column: (1 + 2) int"
    path = lines[1].removeprefix("results: ")
    assert [r.value for r in spark.read.text(path).collect()] == ["[3]"]
    assert submit(spark, base, "describe query select 1 as v")
    assert "[v,int,null]" in capsys.readouterr().out
    assert not submit(spark, base, "selec 1")
    assert "PARSEFAILED PARSE_SYNTAX_ERROR" in capsys.readouterr().out
    states = read_run_log(spark, f"{base}/run-log").groupBy("state").count().collect()
    assert {r.state: r["count"] for r in states} == {
        "SUBMITTED": 3,
        "FINISHED": 2,
        "PARSEFAILED": 1,
    }


def log_rows(spark, log):
    rows = read_run_log(spark, log).orderBy("seq").collect()
    return [(r.seq, r.run_id, r.state, r.out_path is not None) for r in rows]


def test_batch_begun_again(spark, tmp_path):
    """Ended between statements, or after SUBMITTED: the log is that of one undisturbed batch."""
    texts = ["select 1 as a", "selec 2", "select id from range(3)", "select nope", "select 5 as b"]
    statements = spark.createDataFrame(list(enumerate(texts)), "stmt_id long, sql string")
    whole, out = str(tmp_path / "whole"), str(tmp_path / "out")
    run_batch(spark, statements, whole, out + "0")
    for stop in range(1, 5):
        log, results = str(tmp_path / f"log{stop}"), f"{out}{stop}"
        begun = batch_outcomes(spark, statements, log, results)
        for _ in range(stop):
            next(begun)
        begun.close()
        if stop == 2:  # the third had written something when its driver was lost
            row = statements.filter("stmt_id = 2").selectExpr("*", "true as is_result_query").first()
            batches._RunLog(spark, log, 4).append(row, "SUBMITTED", batches.Outcome(2, "SUBMITTED"), 0.0)
            spark.range(1).selectExpr("'half' as value").write.text(f"{results}/run-2")
        later = [o.run_id for o in batch_outcomes(spark, statements, log, results, resume=True)]
        assert later == list(range(stop, 5))
        assert log_rows(spark, log) == log_rows(spark, whole)
        assert sorted(r.value for r in spark.read.text(f"{results}/run-2").collect()) == ["[0]", "[1]", "[2]"]
    assert run_batch(spark, statements, whole, out + "0", resume=True) == []


def test_deadline(spark, tmp_path):
    slow = "select count(*) as n from range(0, 1000000000000000, 1, 4) where hash(id) = 7"
    statements = spark.createDataFrame([(1, slow), (2, "select 1 as a")], "stmt_id long, sql string")
    log = str(tmp_path / "log")
    outcomes = run_batch(spark, statements, log, str(tmp_path / "out"), deadline_seconds=3)
    assert [o.state for o in outcomes] == ["KILLED", "FINISHED"]
    assert "longer than 3 seconds" in outcomes[0].reason
    ended = {r.run_id: (r.outcome, r.first_state) for r in final_outcome(read_run_log(spark, log)).collect()}
    assert ended == {1: ("FAILED", "KILLED"), 2: ("FINISHED", "FINISHED")}

"""The dialect's own constructs: parsing, naming, coupling, introspection, errors, plans."""

import datetime as dt
import json
import zipfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lumenql.functions import prompts
from lumenql.functions.library import FUNCTIONS, ROW_FUNCTIONS, bits, place, wildcard
from lumenql.plans import ast as A
from lumenql.plans.lower import QueryError
from lumenql.plans.parser import ParseError, parse
from lumenql.session import Engine
from lumenql.sources.basic import column_name
from lumenql.sources.registry import UnknownName


@pytest.fixture(scope="module")
def engine(spark, sf_dir):
    return Engine(spark, tables=sf_dir)


def rows(df):
    return [tuple(r) for r in df.collect()]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_precedence():
    (q,) = parse("select a + b * c = d and not e or f from #s.m()")
    top = q.body.items[0].expr
    assert top.op == "or" and top.left.op == "and" and top.left.left.op == "="
    assert top.left.left.left == A.Binary("+", A.Name(("a",)), A.Binary("*", A.Name(("b",)), A.Name(("c",))))


@pytest.mark.parametrize("bad", ["select", "select a from", "select a from #s.m(", "select a where ?", "table T { a int"])
def test_parse_errors(bad):
    with pytest.raises((ParseError, IndexError)):
        parse(bad)


def test_names_follow_the_source_text(engine):
    assert engine.sql("select 2+2, n_name from #tables.nation() take 1").columns == ["2+2", "n_name"]
    assert engine.sql("select a.n_name from #tables.nation() a take 1").columns == ["a.n_name"]
    assert engine.sql("select n_name as 'the name %' from #tables.nation() take 1").columns == ["the name %"]


def test_names_ignore_case(engine):
    assert rows(engine.sql("SELECT COUNT(N_NAME) AS n FROM #TABLES.nation()")) == [(25,)]


def test_unknown_names_tell_the_alternatives(engine):
    with pytest.raises(UnknownName, match="range"):
        engine.sql("select 1 from #system.nothing()")
    with pytest.raises(UnknownName, match="system"):
        engine.sql("select 1 from #nothing.dual()")
    with pytest.raises(QueryError, match="n_name"):
        engine.sql("select missing from #tables.nation()")
    with pytest.raises(QueryError, match="ambiguous"):
        engine.sql("select n_name from #tables.nation() a inner join #tables.nation() b on a.n_nationkey = b.n_nationkey")


def test_anti_idiom_becomes_an_anti_join(engine):
    text = "select c.c_custkey from #tables.customer() c left outer join #tables.orders() o on c.c_custkey = o.o_custkey where o.o_custkey is null"
    assert "LeftAnti" in plan(engine.sql(text))


def test_pushdown_and_pruning(engine):
    text = plan(engine.sql("select a.o_orderkey from #tables.orders() a where a.o_custkey = 7"))
    assert "EqualTo(o_custkey,7)" in text and "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text


def test_desc(engine):
    got = rows(engine.sql("desc #system"))
    assert ("range", "min: long", "max: long") in got and ("dual", None, None) in got
    assert rows(engine.sql("desc #system.range(1, 2)")) == [("Value", 0, "bigint")]


def test_coupled_types_are_null_on_failure(engine, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("Id,Small,Flag,When,Money,Name\n1,300,true,01/31/2012,1.5,a\nx,12,maybe,nope,z,\n")
    got = engine.sql(f"table T {{ Name: string, Id: int, Small: byte, Flag: bool, When: datetime, Money: decimal }}; couple #separatedvalues.comma with table T as S; select Id, Small, Flag, When, Money, Name from S('{path}', true, 0) order by Name desc")
    assert rows(got) == [(1, None, True, dt.datetime(2012, 1, 31), Decimal("1.5"), "a"), (None, 12, None, None, None, None)]


def test_csv_headers_skip_and_missing(engine, tmp_path):
    assert column_name("operation date_of") == "operationDateOf" and column_name("A b!") == "AB"
    path = tmp_path / "t.csv"
    path.write_text("junk\nmore junk\nfirst name;n\nx;1\ny;\n")
    assert rows(engine.sql(f"select firstName, n from #separatedvalues.semicolon('{path}', true, 2)")) == [("x", "1"), ("y", None)]
    path.write_text("1\ta\n2\tb\n")
    assert rows(engine.sql(f"select Column1, Column2 from #separatedvalues.tab('{path}', false, 0)")) == [("1", "a"), ("2", "b")]
    assert rows(engine.sql("select Column1 from #separatedvalues.comma('/nowhere/at.csv', false, 0)")) == []


def test_paths_from_a_common_table(engine, tmp_path):
    for k in (1, 2):
        (tmp_path / f"{k}.csv").write_text(f"n\n{k}\n")
    text = f"table T {{ n: int }}; couple #separatedvalues.comma with table T as S; with p as (select FullPath from #os.files('{tmp_path}', false)) select Sum(n) as s from S(p, true, 0)"
    assert rows(engine.sql(text)) == [(3,)]


def test_flat_file_lines(engine, tmp_path):
    path = tmp_path / "t.txt"
    path.write_text("a\n\nc\n")
    assert rows(engine.sql(f"select LineNumber, Line from #flat.file('{path}')")) == [(1, "a"), (2, ""), (3, "c")]
    assert rows(engine.sql("select LineNumber from #flat.file('/nowhere.txt')")) == []


def test_lines_of_files_lose_one_line_end(engine, tmp_path):
    """Only a line end at the very close is none of a further line."""
    for k, text in enumerate(("a\n", "a\n\n", "a\n\n\n", "a\r\n\r\n", "a\n\u2028")):
        (tmp_path / f"{k}.txt").write_bytes(text.encode())
    got = rows(engine.sql(f"select f.Name, f.CountOfLines(), f.CountOfNotEmptyLines() from #os.files('{tmp_path}', false) f"))
    assert sorted(got) == [("0.txt", 1, 1), ("1.txt", 2, 1), ("2.txt", 3, 1), ("3.txt", 2, 1), ("4.txt", 2, 2)]


def test_line_numbers_run_through_splits(engine, spark, tmp_path):
    (tmp_path / "long.txt").write_text("".join(f"row {k}\n" for k in range(1, 5001)))
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        df = engine.sql(f"select LineNumber, Line from #flat.file('{tmp_path}/long.txt')")
        assert df.rdd.getNumPartitions() > 4 and sorted(rows(df)) == [(k, f"row {k}") for k in range(1, 5001)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)


def test_json_with_side_schema(engine, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps([{"Name": "A", "Age": 3, "Books": [{"Name": "x"}]}, 7]))
    (tmp_path / "s.json").write_text(json.dumps({"Name": "string", "Age": "int", "Books": [{"Name": "string"}]}))
    text = f"select p.Name, p.Age, b.Name from #json.file('{tmp_path}/d.json', '{tmp_path}/s.json') p cross apply p.Books b"
    assert rows(engine.sql(text)) == [("A", 3, "x")]


def test_archives_and_csv_inside(engine, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.mkdir("d")
        z.writestr("d/x.csv", "Name,Age\nann,4\nbob,5\n")
        z.writestr("note.txt", "hello")
    a = f"#archives.file('{tmp_path}/a.zip') a"
    assert rows(engine.sql(f"select a.Key, a.IsDirectory from {a} order by a.Key")) == [("d/", True), ("d/x.csv", False), ("note.txt", False)]
    assert rows(engine.sql(f"select a.GetTextContent() as t from {a} where a.Key like '%.txt'")) == [("hello",)]
    inside = f"table P {{ Name: string, Age: int }}; couple #separatedvalues.comma with table P as C; select a.Key, c.Name, c.Age from {a} cross apply C(a.Content, true, 0) c where a.Key like '%.csv' order by c.Name"
    assert rows(engine.sql(inside)) == [("d/x.csv", "ann", 4), ("d/x.csv", "bob", 5)]
    assert rows(engine.sql(f"select FullName, Length from #os.zip('{tmp_path}/a.zip') order by FullName")) == [("d/x.csv", 21), ("note.txt", 5)]


def test_directory_comparison(engine, tmp_path):
    for folder, files in (("a", {"same": "1", "changed": "1", "gone": "1"}), ("b", {"same": "1", "changed": "2", "new": "1"})):
        (tmp_path / folder).mkdir()
        for name, text in files.items():
            (tmp_path / folder / name).write_text(text)
    got = rows(engine.sql(f"select SourceFileRelative, DestinationFileRelative, State from #disk.DirsCompare('{tmp_path}/a', '{tmp_path}/b')"))
    assert set(got) == {("/same", "/same", "TheSame"), ("/changed", "/changed", "Modified"), ("/gone", None, "Removed"), (None, "/new", "Added")}


DBC = 'BO_ 292 Engine: 8 X\n SG_ Temp : 2|8@1- (1,-10) [0|0] "C" X,Y\n SG_ On : 0|1@1+ (1,0) [0|1] "" X\n\nBO_ 293 Gas: 1 X\n SG_ Heat : 0|8@1+ (0.5,0) [0|255] "" X\n\nCM_ SG_ 292 Temp "warm";\n'


def test_can_frames(engine, tmp_path):
    (tmp_path / "d.dbc").write_text(DBC)
    (tmp_path / "d.csv").write_text("Timestamp,ID,Data\n0,292,0x169\n1,293,16\n2,7,0b11\n")
    frames = f"#can.separatedvalues('{tmp_path}/d.csv', '{tmp_path}/d.dbc')"
    got = rows(engine.sql(f"select ID, IsWellKnown, Message, Engine.Temp as t, Engine.On as o, Gas.Heat as h, UnknownMessage.RawData as raw from {frames} order by Timestamp"))
    assert got == [(292, True, "Engine", 80.0, 1.0, None, None), (293, True, "Gas", None, None, 8.0, None), (7, False, None, None, None, None, 3)]
    assert rows(engine.sql(f"select Name, Comment, Receiver from #can.signals('{tmp_path}/d.dbc') where Name = 'Temp'")) == [("Temp", "warm", ["X", "Y"])]
    assert rows(engine.sql(f"select m.EncodeMessage('Heat', 8) as e, m.DecodeMessage('Heat', 16) as d from #can.messages('{tmp_path}/d.dbc') m take 1")) == [(16, 8.0)]


def test_bits_round_trip(spark):
    df = spark.createDataFrame([(5,), (200,), (1023,)], "v long")
    for start, length, little in ((3, 10, True), (7, 10, False), (20, 12, True)):
        got = df.select("v", bits(place(F.col("v"), start, length, little), start, length, little, False).alias("b"))
        assert all(r.v == r.b for r in got.collect())


def test_library_values(spark):
    one = spark.createDataFrame([("a, B", None, 3661, "AB-12")], "labels string, none string, s long, key string")
    f = FUNCTIONS
    got = one.select(
        f["haslabel"](F.col("labels"), F.lit("b")), f["haslabel"](F.col("none"), F.lit("b")), f["labelcount"](F.col("labels")), f["labelcount"](F.col("none")), f["formatduration"](F.col("s")),
        f["formatduration"](F.lit(None).cast("long")), f["extractprojectkey"](F.col("key")), f["extractissuenumber"](F.lit("AB-x")), f["shortsha"](F.col("none")), f["subpath"](F.lit("a/b"), F.lit(-1)),
        f["combine"](F.lit("a"), F.lit("/b")), f["getextension"](F.lit("/x/y")),
    ).first()
    assert tuple(got) == (True, False, 2, 0, "1h 1m", None, "AB", None, "", "", "/b", "")


def test_file_functions(spark):
    row = F.struct(F.lit(b"ab\n\ncab\n").alias("Content"), F.lit(1536).alias("Length"), F.lit(".ZIP").alias("Extension"))
    r = ROW_FUNCTIONS
    got = spark.range(1).select(r["countoflines"](row), r["countofnotemptylines"](row), r["getlinescontainingword"](row, F.lit("ab")), r["tail"](row, F.lit(99)), r["getfilebytes"](row, F.lit(2), F.lit(4)), r["isziparchive"](row)).first()
    assert tuple(got) == (3, 2, "(1,3)", bytearray(b"ab\n\ncab\n"), bytearray(b"ca"), True)


def test_wildcard(spark):
    df = spark.createDataFrame([("getItem",), ("xgetItem",), ("GETALL",)], "n string")
    assert [r.n for r in df.where(F.col("n").rlike(wildcard("get*"))).collect()] == ["getItem", "GETALL"]


def test_git_source(engine, tmp_path):
    import subprocess

    run = lambda *a: subprocess.run(["git", "-C", str(tmp_path), "-c", "user.name=A", "-c", "user.email=a@x", *a], check=True, capture_output=True)
    run("init", "-q", "-b", "main")
    for k in (1, 2):
        (tmp_path / "f.txt").write_text("line\n" * k)
        run("add", ".")
        run("commit", "-qm", f"change {k}")
    run("tag", "-a", "v1", "-m", "first")
    (tmp_path / "new.txt").write_text("x")
    assert rows(engine.sql(f"select MessageShort, Author from #git.commits('{tmp_path}')")) == [("change 2", "A"), ("change 1", "A")]
    assert rows(engine.sql(f"select FriendlyName, IsAnnotated from #git.tags('{tmp_path}')")) == [("v1", True)]
    assert rows(engine.sql(f"select ChangeType from #git.filehistory('{tmp_path}', '*.txt', -1)")) == [("Added",)]
    assert rows(engine.sql(f"select FilePath, State from #git.status('{tmp_path}')")) == [("new.txt", "NewInWorkdir")]
    assert rows(engine.sql(f"select StartLineNumber, LineCount from #git.blame('{tmp_path}', 'f.txt')")) == [(1, 1), (2, 1)]
    last = rows(engine.sql(f"select MaxCommit(c).MessageShort as last from #git.commits('{tmp_path}') c group by 'all'"))
    assert last in ([("change 2",)], [("change 1",)])  # both may fall into one second


def test_git_rows(engine, tmp_path):
    import subprocess

    run = lambda *a: subprocess.run(["git", "-C", str(tmp_path), "-c", "user.name=A", "-c", "user.email=a@x", *a], check=True, capture_output=True)
    run("init", "-q", "-b", "main")
    for branch, text in (("main", "1"), ("feature", "2")):
        if branch != "main":
            run("checkout", "-qb", branch)
        (tmp_path / "f.txt").write_text(text + "\n")
        run("add", ".")
        run("commit", "-qm", branch)
    source = f"#git.repository('{tmp_path}') r"
    assert rows(engine.sql(f"select d.Path, d.ChangeKind from {source} cross apply r.DifferenceBetween(r.BranchFrom('refs/heads/main'), r.BranchFrom('refs/heads/feature')) as d")) == [("f.txt", "Modified")]
    assert rows(engine.sql(f"select p.LinesAdded, p.LinesDeleted from {source} cross apply r.PatchBetween(r.BranchFrom('refs/heads/main'), r.BranchFrom('refs/heads/feature')) p")) == [(1, 1)]
    assert rows(engine.sql(f"select c.MessageShort from {source} cross apply r.SearchForBranches('feat') b cross apply b.GetBranchSpecificCommits(r.Self, b.Self, true) c")) == [("feature",)]
    (base,) = rows(engine.sql(f"select r.FindMergeBase(r.BranchFrom('refs/heads/feature')).Sha as s from {source}"))
    (main,) = rows(engine.sql(f"select b.Tip.Sha as s from #git.branches('{tmp_path}') b where b.FriendlyName = 'main'"))
    assert base == main
    assert len(rows(engine.sql(f"select c.Sha, p.Sha from #git.commits('{tmp_path}') c cross apply c.Parents as p"))) == 1


def test_snapshots_and_clients(spark, tmp_path):
    (tmp_path / "github").mkdir()
    (tmp_path / "github" / "branches.json").write_text('{"Name": "main", "RepositoryOwner": "o", "RepositoryName": "r"}\n{"Name": "x", "RepositoryOwner": "p", "RepositoryName": "r"}\n')
    engine = Engine(spark, snapshots=str(tmp_path))
    assert rows(engine.sql("select Name from #github.branches('o', 'r')")) == [("main",)]
    with pytest.raises(ValueError, match="client"):
        engine.sql("select Name from #kubernetes.pods()")
    assert rows(Engine(spark, missing_services="empty").sql("select Name from #kubernetes.pods()")) == []
    (tmp_path / "github" / "issues.json").write_text('{"Number": 1}\nnot json\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        engine.sql("select Number from #github.issues('o', 'r')").collect()

    def client(method, args, filters, page):
        assert args == ['project = "AB" AND status = "Open"']
        yield {"Key": "AB-1", "Status": "Done"}
        yield {"Key": "AB-2", "Status": "Open"}

    served = Engine(spark, clients={"jira": client})
    assert rows(served.sql("select Key from #jira.issues('AB') where Status = 'Open'")) == [("AB-2",)]


def test_unknown_columns_raise(engine):
    for text in ("select c.typo from #tables.region() c", "select Count(c.typo) as n from #tables.region() c", "select typo from #tables.region() c", "select c.r_name from #tables.region() c where c.nothing = 1"):
        with pytest.raises(QueryError, match="r_regionkey"):
            engine.sql(text)
    assert engine.sql("select c.Self.r_name as n from #tables.region() c").count() == 5


def test_model_functions_need_a_client(spark):
    with pytest.raises(ValueError, match="llm_client"):
        Engine(spark).sql("select m.Sentiment('a') as s from #openai.gpt() m")

    def broken(settings, prompt):
        raise RuntimeError("no service")

    before = prompts.failures(spark).value
    assert rows(Engine(spark, llm_client=broken).sql("select m.SummarizeContent('a') as s from #openai.gpt() m")) == [(None,)]
    assert prompts.failures(spark).value > before


def test_quoted_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,text\n1,"two\nlines, ""quoted"""\n2,plain\n3,\n')
    want = [("1", 'two\nlines, "quoted"'), ("2", "plain"), ("3", None)]
    for option in ({}, {"quoted_line_breaks": True}):
        assert rows(Engine(spark, **option).sql(f"select k, text from #separatedvalues.comma('{tmp_path}/a.csv', true, 0)")) == want
    assert len(rows(Engine(spark).sql(f"select Column1 from #separatedvalues.comma('{tmp_path}/a.csv', false, 1)"))) == 3


def test_applied_sources(spark, tmp_path):
    for d in ("a", "b"):
        (tmp_path / d).mkdir()
        (tmp_path / d / f"{d}.txt").write_text(d * 3)
    (tmp_path / "c").mkdir()
    engine = Engine(spark)
    source = f"#os.directories('{tmp_path}', false) d"
    assert sorted(rows(engine.sql(f"select d.Name, f.Name, f.Length from {source} cross apply #os.files(d.FullName, false) f"))) == [("a", "a.txt", 3), ("b", "b.txt", 3)]
    assert sorted(rows(engine.sql(f"select d.Name, f.Name from {source} outer apply #os.files(d.FullName, false) f")), key=str)[-1] == ("c", None)
    with pytest.raises(QueryError, match="max_paths"):
        Engine(spark, max_paths=2).sql(f"select f.Name from {source} cross apply #os.files(d.FullName, false) f")


def test_row_numbers(spark):
    got = sorted(rows(Engine(spark).sql("select Value, RowNumber() as n from #system.range(10, 30) where RowNumber() % 5 = 0")))
    assert got == [(14, 5), (19, 10), (24, 15), (29, 20)]


def test_symbol_tables(spark, tmp_path):
    (tmp_path / "csharp").mkdir()
    method = lambda n, c, used: {"Name": n, "IsAsync": n.startswith("Run"), "CyclomaticComplexity": c, "HasDocumentation": False, "Parameters": [{"Name": "p", "IsUsed": used}]}
    solution = {"Id": "s", "Projects": [{"Name": "P", "Classes": [{"Name": "C", "ReferenceCount": 0, "Methods": [method("Run", 9, False), method("Go", 1, True)]}]}]}
    (tmp_path / "csharp" / "solution.json").write_text(json.dumps(solution))
    engine = Engine(spark, snapshots=str(tmp_path))
    source = "#csharp.solution('x') s"
    assert rows(engine.sql(f"select m.Name from {source} cross apply s.GetHighComplexityMethods(5) m")) == [("Run",)]
    assert rows(engine.sql(f"select m.Name from {source} cross apply s.GetAsyncMethodsWithoutSuffix() m")) == [("Run",)]
    assert rows(engine.sql(f"select c.Name from {source} cross apply s.GetUnusedClasses() c")) == [("C",)]
    assert rows(engine.sql(f"select p.Name from {source} cross apply s.GetUnusedParameters() p")) == [("p",)]
    assert rows(engine.sql(f"select m.Name from {source} cross apply s.GetMethodsByPattern('g*') m")) == [("Go",)]


def test_derived_classes_and_files(engine, spark, tmp_path):
    (tmp_path / "csharp").mkdir()
    classes = [{"Name": "A", "BaseTypes": []}, {"Name": "C", "BaseTypes": ["B"]}, {"Name": "B", "BaseTypes": ["A"]}, {"Name": "X", "BaseTypes": ["Y"]}]
    (tmp_path / "csharp" / "solution.json").write_text(json.dumps({"Id": "s", "Projects": [{"Name": "P", "Classes": classes}]}))
    solution = Engine(spark, snapshots=str(tmp_path))
    assert rows(solution.sql("select c.Name from #csharp.solution('x') s cross apply s.FindDerivedClasses('A') c")) == [("C",), ("B",)]
    (tmp_path / "f.txt").write_text("abc")
    assert rows(engine.sql(f"select GetFileInfo('{tmp_path}/f.txt').Length as n, GetFileInfo('/nowhere') is null as none from #system.dual()")) == [(3, True)]
    assert rows(engine.sql(f"select Length(AggregateFiles()) as n from #os.files('{tmp_path}', false) group by 'all'")) == [(1,)]


def test_streaming_matches_batch(spark, sf_dir, tmp_path):
    from lumenql.streaming import windows

    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.write.parquet(str(tmp_path / "e"))
    stream = windows.stream_of(spark, str(tmp_path / "e"), events.schema)
    got = windows.run_once(windows.sliding(stream), "sliding_test")
    want = windows.sliding(events)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()

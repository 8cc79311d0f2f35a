"""Files with newlines inside quoted fields, read in pieces."""

import random
import re

import pytest

from landlens.plans import jobs
from landlens.session import conf_for
from landlens.sources import read_delimited, records
from landlens.sources.records import line_maps, read_records

COLUMNS = 4


def inside_after(text, start, sep, quote, escape):
    """State after ``text`` by the rules of the format, character by character."""
    state, i = ("quoted" if start else "start"), 0
    while i < len(text):
        c = text[i]
        if state == "quoted":
            if escape != quote and c == escape:
                i += 1
            elif escape == quote and c == quote and text[i + 1:i + 2] == quote:
                i += 1
            elif c == quote:
                state = "plain"
        elif c == sep:
            state = "start"
        elif state == "start" and c == quote:
            state = "quoted"
        else:
            state = "plain"
        i += 1
    return state == "quoted"


@pytest.mark.parametrize("sep, quote, escape", [(";", '"', "\\"), (",", '"', '"'), ("|", "'", "\\")])
def test_line_maps_equal_an_automaton(spark, sep, quote, escape):
    rng = random.Random(3)
    texts = {"".join(rng.choice([sep, quote, escape, "a", " ", "é"]) for _ in range(rng.randint(0, 14))) for _ in range(3000)}
    texts |= {quote + "x" * 200_000, ("a" + sep) * 50_000 + quote, quote + (escape + quote) * 50_000 + quote + sep, (quote + "b" + quote + sep) * 50_000}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    outside, inside = line_maps(df["t"], sep, quote, escape)
    for r in df.select("t", outside.alias("o"), inside.alias("i")).collect():
        assert (r.o, r.i) == (inside_after(r.t, False, sep, quote, escape), inside_after(r.t, True, sep, quote, escape)), r.t[:40]


def field(rng):
    kind = rng.random()
    if kind < 0.35:
        return rng.choice(["", "plain", 'pipe 12" wide', "back\\slash", " \"spaced\"", "42"])
    if kind < 0.4:
        return '""'
    body = "".join(rng.choice(["a", "b;", "\n", "\n\n", '\\"', "\\\\", "é", " ", "line"]) for _ in range(rng.randint(1, 8)))
    return f'"{body}"'


def write(path, rng, n, end="\n"):
    rows = [";".join(field(rng) for _ in range(COLUMNS)) for _ in range(n)]
    rows[5:5] = ["", ""]  # empty lines between records
    rows.append('a;b;"' + "long\n" * 3000 + 'end";d')  # a record over many pieces
    rows += [";".join(field(rng) for _ in range(COLUMNS)) for _ in range(50)]
    text = "\n".join(["w;x;y;z", *rows]) + "\n"
    path.write_bytes(text.replace("\n", end).encode())


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed, end", [(1, "\n"), (2, "\n"), (3, "\r\n")])
def test_pieces_of_a_file_read_as_one_task_would(spark, tmp_path, seed, end):
    rng = random.Random(seed)
    write(tmp_path / "a.csv", rng, 1500, end)
    write(tmp_path / "b.csv", rng, 300, end)
    whole = spark.read.options(header=True, sep=";", quote='"', escape="\\", multiLine=True).csv(str(tmp_path))
    want = bag(whole)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        mine = read_delimited(spark, str(tmp_path), multiline=True)
        assert mine.columns == whole.columns and bag(mine) == want
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10  # pieces that tasks read by themselves
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 << 20))
    assert bag(read_delimited(spark, str(tmp_path), multiline=True)) == want


def test_a_window_holds_a_chunk_of_lines_and_chunks_join_again(spark, tmp_path, monkeypatch):
    rng = random.Random(4)
    write(tmp_path / "a.csv", rng, 400)
    want = bag(spark.read.options(header=True, sep=";", quote='"', escape="\\", multiLine=True).csv(str(tmp_path)))
    monkeypatch.setattr(records, "CHUNK_LINES", 5)
    assert bag(read_delimited(spark, str(tmp_path), multiline=True)) == want
    lines = records._lines(spark, [str(tmp_path)], ";", '"', "\\")
    sizes = [r["count"] for r in lines.groupBy(*records._CHUNK).count().collect()]
    assert max(sizes) == 5 and len(sizes) > 500
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert all("__chunk" in w for w in plan.splitlines() if "windowspecdefinition" in w)


def test_a_header_over_several_chunks_is_left_out_whole(spark, tmp_path, monkeypatch):
    (tmp_path / "h.csv").write_text('"a\n\n\n\n\nname";b\n1;2\n"x\ny";3\n')
    monkeypatch.setattr(records, "CHUNK_LINES", 2)
    assert sorted(r.record for r in read_records(spark, str(tmp_path / "h.csv")).collect()) == ['"x\ny";3', "1;2"]


def test_the_text_goes_through_no_shuffle(spark, tmp_path):
    write(tmp_path / "a.csv", random.Random(5), 300)
    df = read_records(spark, str(tmp_path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    dealt = [line.split("hashpartitioning(")[1] for line in plan.splitlines() if "hashpartitioning(" in line]
    by = {re.sub(r"#\d+L?", "", d.split("), ")[0]).rsplit(", ", 1)[0] for d in dealt}
    assert by == {"__file", "__file, _groupingexpression"}  # a row a piece; lines of records that lie in several pieces, by record
    assert df.count() == 351


@pytest.mark.parametrize("size", [7, 40])
def test_records_over_pieces_headers_over_pieces_and_a_quote_that_stays_open(spark, tmp_path, size):
    texts = {"header": '"a\n\n\n\n\n\n\n\nname";b\n1;2\n"x\n\ny";3\n\n\n4;5\n', "only": '"a\n\n\n\n\n\n\n\nname";"b\nc"',
             "turned": 'a;b\n1;"\n";"\n";"2\n3;";4\n', "empty": "", "lines": "\n\n\n\n\n\n\n\n\n\n",
             "latin": 'a;b\n\xe9;"\xe9\n\xe9"\n', "returns": 'a;b\r\n1;"x\r\n\r\ny"\r\n\r\n2;3\r\n', "open": 'a;b\n1;2\n3;"never\nclosed\n\n4;5\n6;7'}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode("latin-1"))
    want = {"header": ["1;2", '"x\n\ny";3', "4;5"], "turned": ['1;"\n";"\n";"2\n3;";4'], "latin": ['\ufffd;"\ufffd\n\ufffd"'],
            "returns": ['1;"x\n\ny"', "2;3"], "open": ["1;2", '3;"never\nclosed\n\n4;5\n6;7']}
    with conf_for(spark, {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.execution.arrow.maxRecordsPerBatch": "3", "spark.sql.files.openCostInBytes": "0"}):
        got = {}
        for r in read_records(spark, str(tmp_path)).collect():
            got.setdefault(r.file.rsplit("/", 1)[1], []).append(r.record)
        headers = {r.record for r in read_records(spark, str(tmp_path / "only"), header=False).collect()}
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert headers == {'"a\n\n\n\n\n\n\n\nname";"b\nc"'}


def test_doubled_quotes_a_given_schema_and_malformed_records(spark, tmp_path):
    (tmp_path / "q.csv").write_text('k,t\n1,"say ""hi""\nthere"\n2,plain\n3\n4,"a",b\n"5","\n"\n')
    df = read_delimited(spark, str(tmp_path / "q.csv"), sep=",", escape='"', multiline=True)
    assert bag(df.select("k", "t"))[:2] == [("1", 'say "hi"\nthere'), ("2", "plain")]
    df = read_delimited(spark, str(tmp_path / "q.csv"), sep=",", escape='"', multiline=True, malformed_col=jobs.MALFORMED)
    assert sorted(r[jobs.MALFORMED] for r in df.collect() if r[jobs.MALFORMED] is not None) == ["3", '4,"a",b']
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("t", T.StringType())])
    got = read_delimited(spark, str(tmp_path / "q.csv"), sep=",", escape='"', multiline=True, schema=schema)
    assert (5, "\n") in bag(got) and got.schema["k"].dataType == T.IntegerType()


def test_no_records(spark, tmp_path):
    (tmp_path / "h.csv").write_text("a;b\n")
    assert read_delimited(spark, str(tmp_path / "h.csv"), multiline=True).collect() == []
    (tmp_path / "n.csv").write_text('x;"\n\ny"\n\n')
    assert [r.record for r in read_records(spark, str(tmp_path / "n.csv"), header=False).collect()] == ['x;"\n\ny"']

"""Multi-line CSV by many tasks against Spark's own one-task reader."""

import random

import pytest
from pyspark.sql import functions as F

from roadlark.sources import posts, records

SCHEMA = "a string, b string, c int"


@pytest.fixture
def small_splits(spark):
    """Splits of 64 bytes, so that fields and records reach over several of them."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for key, value in old.items():
        spark.conf.set(key, value)


def both(spark, path):
    wide = posts.read_csv(spark, str(path), SCHEMA)
    plain = [tuple(r) for r in wide.collect()]
    many = records.read_records(spark, str(path), SCHEMA).orderBy("source_file", "no")
    return plain, [tuple(r)[:3] for r in many.collect()]


def field(rng):
    kind = rng.random()
    if kind < 0.3:
        return "".join(rng.choices("xy z.", k=rng.randint(0, 9)))
    text = "".join(rng.choices(["x", "y ", ",", '""', "\n", "line\n", ', ""q"", ', "-"], k=rng.randint(0, 12)))
    return f'"{text}"'


def test_equals_the_one_task_read(spark, tmp_path, small_splits):
    rng = random.Random(11)
    rows = [f"{field(rng)},{field(rng)},{rng.randint(0, 99)}" for _ in range(150)]
    path = tmp_path / "many.csv"
    path.write_text("a,b,c\n" + "\n".join(rows) + "\n")
    plain, many = both(spark, path)
    assert many == plain and len(plain) > 100
    lines = spark.read.option("lineSep", "\n").text(str(path))
    assert lines.rdd.getNumPartitions() > 1


CASES = {
    "plain": "a,b,c\nx,y,1\nz,w,2\n",
    "no end": 'a,b,c\nx,"y\nz",1',
    "header over lines": '"a\n",b,c\nx,y,1\n',
    "blank lines": "a,b,c\n\nx,y,1\n\n\nz,w,2\n",
    "quotes inside unquoted": 'a,b,c\n5" pipe,x"y,1\n6" pipe,z,2\n"q\nr",s,3\n',
    "spaces before quotes": 'a,b,c\nx, "y\n, z" ,1\nu,v,2\n',
    "doubled": 'a,b,c\n"""","""\n""",1\n"x""","y",2\n',
    "empty quotes": 'a,b,c\n"","",1\n"","\n",2\n',
    "carriage returns": 'a,b,c\r\nx,"y",1\r\nz,w,2\r\n',
    "few and many fields": "a,b,c\nx\nx,y,1,extra\n,,\n",
    "bad number": 'a,b,c\nx,"y\nz",one\nu,v,2\n',
    "only a header": "a,b,c\n",
}


@pytest.mark.parametrize("name", CASES)
def test_odd_files(spark, tmp_path, small_splits, name):
    path = tmp_path / "odd.csv"
    path.write_bytes(CASES[name].encode())
    plain, many = both(spark, path)
    assert many == plain


def test_several_files_keep_their_own_state_and_order(spark, tmp_path, small_splits):
    (tmp_path / "1.csv").write_text('a,b,c\nx,"never closed\n' + "more\n" * 40)
    (tmp_path / "2.csv").write_text('a,b,c\n"1\n2",y,1\n' + "".join(f"r,s,{i}\n" for i in range(60)))
    found = records.read_records(spark, f"{tmp_path}/*.csv", SCHEMA).orderBy("no").collect()
    second = [r for r in found if r.source_file.endswith("2.csv")]
    assert [r.c for r in second] == [1, *range(60)] and second[0].a == "1\n2"
    assert len(found) - len(second) == 1
    assert records.read_records(spark, f"{tmp_path}/none*.csv", SCHEMA).count() == 0


def test_states_of_lines(spark):
    lines = ["x,y", '"x', 'y",z', 'a,"b""', 'c"",d', '"', '","', 'x"y"z', ',""', ',"""', ' "a', '"a"b"c']
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    marks = records.quote_marks(F.col("line"))
    got = df.select(records.ends_inside(marks).alias("o"), records.stays_inside(marks).alias("i")).collect()

    def ends(line, inside):
        at_start, i = True, 0
        while i < len(line):
            c = line[i]
            if inside:
                if line[i : i + 2] == '""':
                    i += 2
                    continue
                inside = c != '"'
                at_start = False
            elif c == ",":
                at_start = True
            elif c == '"' and at_start:
                inside = True
            elif c not in " \t":
                at_start = False
            i += 1
        return inside

    assert [(r.o, r.i) for r in got] == [(ends(x, False), ends(x, True)) for x in lines]

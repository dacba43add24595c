"""The parallel reader of quoted multi-line text against Spark's one-task reader."""
import numpy as np
import pytest

from citesight.sources import quoted
from citesight.sources.quoted import ends_inside, scan_quoted


def rows(df):
    return sorted((tuple("~" if v is None else v for v in r) for r in df.collect()))


def one_task(spark, path, encoding="ISO-8859-1", sep=","):
    return spark.read.options(**quoted.csv_options(encoding, sep)).csv(path)


@pytest.fixture
def small_ranges(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "301")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def field(rng, ends):
    words = ["a", "bc", "", "é", 'say ""x""', ends, "1,2", ",", "ÿ", ends + ends, " ", "long " * 30]
    text = "".join(rng.choice(words, rng.integers(0, 4)))
    if '"' in text or "," in text or "\n" in text or rng.random() < 0.3:
        return f'"{text}"'
    return text.strip() or "x"


@pytest.mark.parametrize("ends", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", range(2))
def test_equals_the_one_task_reader(spark, tmp_path, small_ranges, ends, seed):
    rng = np.random.default_rng(seed)
    for k in range(2):
        said = ["FACID,TEXT,MORE"] + [f"{k}-{i},{field(rng, ends)},{field(rng, ends)}" for i in range(40)]
        (tmp_path / f"p{k}.csv").write_bytes((ends.join(said) + (ends if k else "")).encode("latin-1"))
    got = scan_quoted(spark, str(tmp_path))
    want = one_task(spark, str(tmp_path))
    assert got.columns == want.columns and rows(got) == rows(want) and len(rows(got)) == 80


def test_many_tasks_read_one_file(spark, tmp_path, small_ranges):
    p = tmp_path / "n.csv"
    p.write_bytes(('FACID,"NARR\nATIVE"\n' + "".join(f'{i},"line é {i}\nsecond ""quoted"", {"z" * (i % 150)}\n"\n' for i in range(80))).encode("latin-1"))
    lines = spark.read.option("lineSep", "\n").text(str(p))
    assert lines.rdd.getNumPartitions() > 15
    assert rows(scan_quoted(spark, str(p))) == rows(one_task(spark, str(p)))


def test_a_record_over_many_ranges_and_utf8(spark, tmp_path, small_ranges):
    p = tmp_path / "n.csv"
    text = "\n".join(["ligne é 日本 \U0001f600"] * 60)
    p.write_text(f'a;b\n1;"{text}"\n2;x\n\n3;"{text} ""end"""\n4;5" pipe\n5;"q"\n', encoding="utf-8")
    got = rows(scan_quoted(spark, str(p), "utf-8", ";"))
    assert got == [("1", text), ("2", "x"), ("3", f'{text} "end"'), ("4", '5" pipe'), ("5", "q")]


def test_without_quotes_and_empty(spark, tmp_path, small_ranges):
    p = tmp_path / "n.csv"
    p.write_text("a,b\n" + "".join(f"{i},\n" for i in range(100)))
    assert rows(scan_quoted(spark, str(p))) == rows(one_task(spark, str(p)))
    q = tmp_path / "head.csv"
    q.write_text("a,b\n")
    assert scan_quoted(spark, str(q)).columns == ["a", "b"] and scan_quoted(spark, str(q)).count() == 0


def test_other_encodings_use_the_one_task_reader(spark, tmp_path):
    p = tmp_path / "n.csv"
    p.write_text('a,b\n1,"x\ny"\n', encoding="utf-16")
    assert rows(scan_quoted(spark, str(p), "utf-16")) == [("1", "x\ny")]


@pytest.mark.parametrize("line,outside,inside", [
    (b"a,b", False, True), (b'"a', True, False), (b'a","b', True, True), (b'x""y', False, True), (b'"a""', True, False),
    (b'a"', False, False), (b'a",b', False, False), (b'a,"b",c', False, False), (b'5" pipe', False, False), (b"", False, True)])
def test_line_states(line, outside, inside):
    assert (ends_inside(line, False, b","), ends_inside(line, True, b",")) == (outside, inside)

"""Delimited text whose quoted fields hold line ends, read in parallel.

Spark's own reader gives such a file to one task, because a byte range alone
does not tell whether its first line lies inside a quoted field.  Here the
ranges are read twice, both times in parallel:

1. Each range is followed from both possible starts (between records, inside a
   quoted field), which gives where it ends for either.  Ranges are combined in
   order of place: one small row a range.
2. With its start known, each range is cut into records.  Records that lie
   inside a range are complete; those that cross a border leave one fragment in
   each range, and only the fragments are shuffled and joined.

Records are landed as Parquet in the shared folder and split into fields by
Spark's own CSV expression.  Quotes inside a quoted field are doubled; a quote
elsewhere in an unquoted field is an ordinary character.  The encoding must be
one in which line ends, quotes and separators are single ASCII bytes; others go
to the one-task reader.  Lines end with a line feed; if a file's first line ends
with carriage return and line feed, both are read as a line feed throughout the
file.  Empty records are left out.  All this is as in Spark's reader.
"""

from __future__ import annotations

import codecs
import sys
from collections.abc import Iterator, Mapping

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, share

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: The driver combines one row of a few bytes for each range.
MAX_RANGES = 2_000_000
LATIN = "ISO-8859-1"   # every byte is one character: what is joined as text stays the same bytes


def ends_inside(line: bytes, inside: bool, sep: bytes) -> bool:
    """Whether a line that starts inside a quoted field, or else at the start
    of a field, ends inside a quoted field."""
    at = 0
    if not inside:
        if line[:1] != b'"':
            at = line.find(sep + b'"') + len(sep)
            if at < len(sep):
                return False
        at += 1
    while True:
        end = line.find(b'"', at)
        if end < 0:
            return True
        if line[end + 1:end + 2] == b'"':  # a quote that belongs to the text
            at = end + 2
            continue
        if line[end + 1:end + 1 + len(sep)] == sep and line[end + 1 + len(sep):end + 2 + len(sep)] == b'"':
            at = end + 2 + len(sep)        # the next field is quoted, too
            continue
        at = line.find(sep + b'"', end + 1)
        if at < 0:
            return False
        at += 1 + len(sep)


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.Array, list[bool]]]:
    """(file, start, lines, whether each has a quote), in order; consecutive
    items may belong to one range."""
    for b in batches:
        file, start, line = b.column("file"), b.column("start"), b.column("line")
        starts, files = start.to_numpy(), file.to_pylist()
        quotes = pc.greater_equal(pc.find_substring(line, b'"'), 0).to_pylist()
        at = 0
        for i in range(1, b.num_rows + 1):
            if i == b.num_rows or starts[i] != starts[at] or files[i] != files[at]:
                yield files[at], int(starts[at]), line.slice(at, i - at), quotes[at:i]
                at = i


def _follow(sep: bytes):
    """For each range: where it ends from either start, whether a record ends
    in it if it starts inside a quoted field, and whether its first line has a
    carriage return at its end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ends, closes, returns = None, [False, True], False, False

        def row():
            return pa.RecordBatch.from_pydict({"file": [key[0]], "start": [key[1]], "from_outside": [ends[0]],
                                               "from_inside": [ends[1]], "closes": [closes], "returns": [returns]})
        for file, start, lines, quotes in _ranges(batches):
            if key != (file, start):
                if key is not None:
                    yield row()
                key, ends, closes, returns = (file, start), [False, True], False, lines[0].as_py().endswith(b"\r")
            for i, quoted in enumerate(quotes):
                if quoted:
                    line = lines[i].as_py()
                    ends = [ends_inside(line, s, sep) for s in ends]
                    closes = closes or not ends[1]
        if key is not None:
            yield row()
    return run


def _starts(rows) -> dict[tuple[str, int], tuple[bool, int, bool]]:
    """For each range whether it starts inside a quoted field, where the
    record that is open there began, and whether the file's lines end with a
    carriage return, too (its first line tells)."""
    out, inside, owner, file, returns = {}, False, 0, None, False
    for r in sorted(rows, key=lambda r: (r.file, r.start)):
        if r.file != file:
            inside, owner, file, returns = False, r.start, r.file, r.returns
        out[r.file, r.start] = inside, owner, returns
        after = r.from_inside if inside else r.from_outside
        if after and not (inside and not r.closes):
            owner = r.start
        inside = after
    return out


def _records(sep: bytes, starts, header: bool):
    """Complete records, and fragments of those that cross a border."""
    fields = [("file", pa.string()), ("owner", pa.int64()), ("place", pa.int64()), ("first", pa.bool_()),
              ("whole", pa.bool_()), ("record", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, key, inside, owner, returns, head = starts.value, None, False, 0, False, False
        open_, first = [], False      # lines of the record that is open; whether the file's first record is still to come
        rows: list[tuple] = []

        def put(owner, whole):
            nonlocal first
            text = b"\n".join(open_)
            is_first = first and bool(text)
            if text or not whole:
                first = first and not is_first
                if not (whole and is_first):
                    rows.append((key[0], owner, key[1], is_first, whole, text.decode(LATIN)))
            open_.clear()

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(fields)],
                                             names=[n for n, _ in fields])
            rows.clear()
            return out

        for file, start, lines, quotes in _ranges(batches):
            if key != (file, start):
                if open_:
                    put(owner if head else key[1], False)
                key = file, start
                if key not in known:
                    raise RuntimeError("the files were split in another way than before, or have changed; read them again")
                inside, owner, returns = known[key]
                head, first = inside, header and start == 0
            for line, quoted in zip(lines.to_pylist(), quotes):
                open_.append(line.removesuffix(b"\r") if returns else line)
                if quoted:
                    inside = ends_inside(line, inside, sep)
                if not inside:
                    put(owner, not head)   # the end of a record from an earlier range is a fragment
                    head = False
            if len(rows) >= 2_000:
                yield flush()
        if open_:
            put(owner if head else key[1], False)
        yield flush()
    return run


def pinned(spark: SparkSession) -> SparkSession:
    """A session with the caller's settings in which files are always split in
    the same way, however many executors there are at the time."""
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if k.startswith("spark.sql."):
            try:
                own.conf.set(k, v)
            except Exception:  # noqa: BLE001 - static settings are shared and cannot be set
                pass
    if own.conf.get("spark.sql.files.minPartitionNum", None) is None:
        own.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    return own


def ascii_based(encoding: str) -> bool:
    """Whether line ends, quotes and separators are their ASCII bytes, which
    occur in no other character."""
    name = codecs.lookup(encoding).name
    return name in ("utf-8", "ascii") or name.startswith(("iso8859", "cp125", "koi8"))


def csv_options(encoding: str, sep: str = ",") -> dict[str, str]:
    return {"header": "true", "encoding": encoding, "multiLine": "true", "escape": '"', "sep": sep}


def scan_quoted(spark: SparkSession, path: str, encoding: str = LATIN, sep: str = ",",
                options: Mapping[str, str] | None = None) -> DataFrame:
    """The rows of delimited text with a header line, all columns as text.

    Equals ``spark.read.csv`` with ``multiLine``, but every byte range of the
    files is its own task.  ``options`` go to the splitting into fields
    (``nullValue`` and the like).  Compressed files are one range each."""
    reader = spark.read.options(**csv_options(encoding, sep), **(options or {}))
    if not ascii_based(encoding) or len(sep) != 1:
        return reader.csv(path)
    names = reader.csv(path).columns  # reads the first record only
    if not names:
        return reader.csv(path)
    own = pinned(spark)
    lines = own.read.option("lineSep", "\n").text(path).select(
        F.col("value").cast("binary").alias("line"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"))
    ranges = lines.mapInArrow(_follow(sep.encode()), "file string, start long, from_outside boolean, "
                                                     "from_inside boolean, closes boolean, returns boolean").limit(MAX_RANGES + 1).collect()
    if len(ranges) > MAX_RANGES:
        raise ValueError("too many ranges: raise spark.sql.files.maxPartitionBytes")
    found = materialize(lines.mapInArrow(
        _records(sep.encode(), share(own, _starts(ranges)), True),
        "file string, owner long, place long, first boolean, whole boolean, record string"), partition_by=["whole"], to=spark)
    complete = found.where("whole").select("record")
    joined = (found.where("NOT whole").groupBy("file", "owner")
              .agg(F.max("first").alias("first"), F.array_sort(F.collect_list(F.struct("place", "record"))).alias("parts"))
              .where("NOT first")
              .select(F.array_join(F.col("parts.record"), "\n").alias("record")))
    text = F.decode(F.encode("record", LATIN), encoding)
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(names))])
    split = F.from_csv(text, schema.simpleString()[7:-1].replace(":", " "),
                       {k: v for k, v in {**csv_options(encoding, sep), **(options or {}), "lineSep": "\n"}.items()
                        if k not in ("header", "encoding")})
    rows = complete.unionByName(joined).select(split.alias("r"))
    return rows.select(*[F.col(f"r._c{i}").alias(n) for i, n in enumerate(names)])

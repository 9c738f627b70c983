"""CSV records with quoted line breaks, from files that are read in ranges.

Spark's line reader cuts files into byte ranges at line ends. Whether a line starts inside quotes depends on all lines before
it, but each line only maps one state to another: outside or inside quotes, at its start and at its end. Most lines have no quote
and leave the state as it is. Two passes:

1. Each range composes its quoted lines' maps into one. A map keeps the state, turns it, or sets it, so the state after
   a range follows from window functions over one row per range: the last range that sets it, and the turns since.
2. Each range reads its lines knowing where it starts, and starts at its first line outside quotes. Lines of one record are
   joined. What lies before the first record, and a last record that stays open, are handed over as fragments: at most
   two per range, joined by file and place. Both are written once, as the records are asked for more than once.

A task reads as many ranges as make up ``TASK_BYTES``, one after the other, so small ranges do not make small tasks.

A quote opens only at the start of a field, a doubled quote inside is text, as Spark's parser has it, so stray quotes elsewhere do no harm.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmill.session import ship_package
from rowmill.storage import materialize

# a line that starts and ends outside quotes; possessive, so that no line is tried twice
CLOSED = r'^(?>"(?>[^"]+|"")*+"[^,]*+|[^",][^,]*+|)(?>,(?>"(?>[^"]+|"")*+"[^,]*+|[^",][^,]*+|))*+$'
_INSIDE = re.compile(r'(?:[^"]+|"")*+')
TASK_BYTES = 32 << 20
BATCH_CHARACTERS, BATCH_RECORDS = 4 << 20, 10_000  # of what a task hands over at a time
KEEP, TURN, SET_OUT, SET_IN = range(4)
_KIND = {(0, 1): KEEP, (1, 0): TURN, (0, 0): SET_OUT, (1, 1): SET_IN}


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line ends inside quotes."""
    at = 0
    while True:
        if inside or line.startswith('"', at):
            at = _INSIDE.match(line, at if inside else at + 1).end()
            if at == len(line):
                return True
            inside = False
        at = line.find(',"', at) + 1  # a quote elsewhere opens nothing
        if not at:
            return False


def file_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``file, place, line``: lines in file order within each range; ``place`` is where the range starts."""
    lines = spark.read.option("lineSep", "\n").text(path)
    lines = lines.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("place"), F.col("value").alias("line"))
    return _together(lines)


def _together(ranges: DataFrame) -> DataFrame:
    """Files read by ranges, ``TASK_BYTES`` of them in a task, if there are enough of them for all tasks that run at a time."""
    spark = ranges.sparkSession
    most = TASK_BYTES // max(1, _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes")))
    number, least = ranges.rdd.getNumPartitions(), 4 * spark.sparkContext.defaultParallelism
    return ranges.coalesce(max(least, -(-number // most))) if most > 1 and number > least else ranges


def _bytes(size: str) -> int:
    """A size as Spark's settings have it: ``256k``, ``128MB``, ``134217728b``, ``900``."""
    number, unit = re.match(r"\s*([0-9]+)\s*([kmgtp]?)", size.lower()).groups()
    return int(number) << 10 * "bkmgtp".index(unit or "b")


def _stretches(batch: pa.RecordBatch) -> Iterator[tuple[int, int, pa.Array]]:
    """Lines of one range each."""
    file, place = (np.asarray(batch.column(i)) for i in (0, 1))
    cuts = [0, *(np.flatnonzero((file[1:] != file[:-1]) | (place[1:] != place[:-1])) + 1).tolist(), len(file)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b > a:
            yield int(file[a]), int(place[a]), batch.column(2).slice(a, b - a)


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The map of every range's quoted lines together, possibly in several rows in order."""
    part = 0
    for batch in batches:
        rows = []
        for file, place, lines in _stretches(batch):
            out, inside = 0, 1
            for line in lines.to_pylist():
                out, inside = int(ends_inside(line, bool(out))), int(ends_inside(line, bool(inside)))
            rows.append((file, place, part, _KIND[out, inside]))
            part += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*rows)] or [pa.array([], pa.int64())] * 4, ["file", "place", "part", "kind"])


def ranges_inside(lines: DataFrame) -> dict[int, list[int]]:
    """Places of the ranges that turn the state, in order, for files that have any: the driver holds one entry per range for its tasks anyway."""
    maps = lines.where(F.col("line").contains('"')).mapInArrow(_composed, "file bigint, place bigint, part bigint, kind bigint")
    kind, so_far = F.col("kind"), Window.partitionBy("file").orderBy("place", "part").rowsBetween(Window.unboundedPreceding, -1)
    turns = F.coalesce(F.sum(F.when(kind == TURN, 1).otherwise(0)).over(so_far), F.lit(0))
    last = F.last(F.when(kind >= SET_OUT, F.struct((kind == SET_IN).cast("int").alias("state"), "turns")), ignorenulls=True).over(so_far)
    state = (F.coalesce("last.state", F.lit(0)) + F.col("turns") - F.coalesce("last.turns", F.lit(0))) % 2
    turned = (kind == TURN) | ((kind == SET_IN) & (state == 0)) | ((kind == SET_OUT) & (state == 1))
    found: dict[int, list[int]] = {}
    for row in maps.withColumn("turns", turns).withColumn("last", last).where(turned).select("file", "place").collect():
        found.setdefault(row["file"], []).append(row["place"])
    return {file: sorted(places) for file, places in found.items()}


def starts_inside(turned: dict[int, list[int]], file: int, place: int) -> bool:
    """Whether a range starts inside quotes: the ranges before it have turned the state an odd number of times."""
    return bisect_left(turned.get(file, ()), place) % 2 == 1


_SHAPE = pa.schema([("file", pa.int64()), ("place", pa.int64()), ("kind", pa.string()), ("record", pa.string())])


def _records(batches: Iterator[pa.RecordBatch], turned: dict[int, list[int]]) -> Iterator[pa.RecordBatch]:
    """Records of every range: ``header`` (the file's first), ``whole``, and the fragments ``head``, ``open`` and ``middle``."""
    at: tuple[int, int] | None = None
    pending: list[str] = []  # lines of the record that is being read
    ready: list[tuple[int, int, str, str]] = []  # what is read, until it makes a batch
    kind, inside, size = "whole", False, 0

    def closed(kind: str) -> None:
        nonlocal size
        record = "\n".join(pending)
        ready.append((*at, kind, record))
        size += len(record)

    def end_of_range() -> None:
        if at is not None and pending:
            closed({"head": "middle", "whole": "open", "header": "open"}[kind])

    def batch_of_ready() -> pa.RecordBatch:
        nonlocal size
        batch = pa.RecordBatch.from_arrays([pa.array(list(c), field.type) for c, field in zip(zip(*ready), _SHAPE)], schema=_SHAPE)
        ready.clear()
        size = 0
        return batch

    for batch in batches:
        for file, place, lines in _stretches(batch):
            if (file, place) != at:
                end_of_range()
                at, pending, inside = (file, place), [], starts_inside(turned, file, place)
                kind = "head" if inside else "whole" if place else "header"
            quoted = pc.match_substring(lines, '"').to_numpy(zero_copy_only=False)
            done = 0  # lines before it are dealt with
            for i in np.flatnonzero(quoted).tolist() + [len(lines)]:
                # without quotes in between, each line outside is a record, and each line inside goes on
                if inside:
                    pending += lines.slice(done, i - done).to_pylist()
                elif i > done:
                    if kind == "header":
                        pending = [lines[done].as_py()]
                        closed(kind)
                        pending, kind, done = [], "whole", done + 1
                    many = lines.slice(done, i - done).cast(pa.string())
                    if len(many) < 64:
                        ready += [(file, place, "whole", record) for record in many.to_pylist()]
                    else:
                        if ready:
                            yield batch_of_ready()
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(many), file)), pa.array(np.full(len(many), place)), pa.array(["whole"] * len(many), pa.string()), many], schema=_SHAPE)
                if i < len(lines):
                    line = lines[i].as_py()
                    pending.append(line)
                    inside = ends_inside(line, inside)
                    if not inside:
                        closed(kind)
                        pending, kind = [], "whole"
                done = i + 1
                if size >= BATCH_CHARACTERS or len(ready) >= BATCH_RECORDS:
                    yield batch_of_ready()
    end_of_range()
    if ready:
        yield batch_of_ready()


def _assembled(fragments: DataFrame) -> DataFrame:
    """Records that lie in several ranges. An open one is followed by any number of middles and a head, in file order."""
    # a head comes before what its range leaves open
    order = F.when(F.col("kind") == "open", 1).otherwise(0)
    opened = F.sum(F.when(F.col("kind") == "open", 1).otherwise(0)).over(Window.partitionBy("file").orderBy("place", order))
    parts = fragments.withColumn("number", opened).groupBy("file", "number").agg(F.array_sort(F.collect_list(F.struct("place", order.alias("order"), "record"))).alias("parts"))
    return parts.select(F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"), F.lit(None).cast("string").alias("kind"))


def breaks_in_quotes(lines: DataFrame) -> bool:
    """Whether any line ends inside quotes."""
    return not lines.where(F.col("line").contains('"') & ~F.col("line").rlike(CLOSED)).isEmpty()


def csv_rows(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of every record but each file's first (its header), as the file reader gives them. Lines are read once, and rows and fragments written."""
    ship_package(lines.sparkSession)
    turned = ranges_inside(lines)
    found = lines.mapInArrow(lambda batches: _records(batches, turned), "file bigint, place bigint, kind string, record string")
    whole = F.col("kind") == "whole"
    found = found.where((F.col("kind") != "header") & (~whole | _filled("record")))
    row = _row(F.when(whole, _ended("record")), schema)
    written = _together(materialize(found.select("file", "place", "kind", F.when(~whole, F.col("record")).alias("record"), row.alias("row")), "records", "zstd"))
    # a file's last record may stay open, too
    fragments = written.where("kind IN ('head', 'middle', 'open')").select("file", "place", "kind", "record")
    assembled = _assembled(fragments).where(_filled("record")).select(_row(_ended("record"), schema).alias("row"))
    rows = written.where("kind = 'whole'").select("row").unionByName(assembled)
    return rows.select(*[F.col(f"row.c{i}").alias(field.name) for i, field in enumerate(schema)])


def _ended(record: str) -> Column:
    """Without the line end."""
    return F.regexp_replace(record, "\r$", "")


def _filled(record: str) -> Column:
    return F.trim(_ended(record)) != ""


def _row(record: Column, schema: T.StructType) -> Column:
    text = T.StructType([T.StructField(f"c{i}", field.dataType) for i, field in enumerate(schema)])
    options = {"escape": '"', "multiLine": "true"}
    return F.from_csv(record, text.simpleString()[len("struct<") : -1].replace(":", " "), options)

"""CSV records whose cells may hold line breaks, from file splits that are read apart.

Whether a split starts inside a quoted cell depends on all text before it. But what a split does to that state is one
of four things: keep it, turn it, set it to inside or set it to outside. A first scan finds that for every split, with
the number of records that end there under either state; a pass over the list of splits then tells each one's state,
and a second scan cuts records, every split by itself. The pieces of records that cross splits are joined at the end.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tandem.functions.paths import logical_name, part_number
from tandem.operators.indexing import BROADCAST_BLOCKS, CHANGED
from tandem.session import fixed_splits, stage

OUTSIDE, INSIDE = 0, 1
# a quoted cell ends at its closing quote; what follows it up to the comma, and quotes inside bare cells, are text
CELL = r'(?:"(?:[^"]++|"")*+"[^,]*+|(?!")[^,]*+)'
COMPLETE = re.compile(f"(?:{CELL},)*+{CELL}\\Z")
CLOSING = re.compile(r'(?:[^"]++|"")*+"[^,]*+')
STATE = "out_state int, in_state int, out_ended bigint, in_ended bigint, header string"
RECORDS = "path string, block bigint, place bigint, piece bigint, record string"


def after(line: str, state: int) -> int:
    """The state behind a line that begins in ``state``."""
    start = 0
    if state == INSIDE:
        closed = CLOSING.match(line)
        if not closed:
            return INSIDE
        start = closed.end() + 1
    return OUTSIDE if COMPLETE.match(line, start) or start > len(line) else INSIDE


def _segments(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """The batch cut where the split changes, each part with its (path, block)."""
    blocks, paths = batch.column("block").to_numpy(), batch.column("path")
    same = np.asarray(pc.equal(paths[1:], paths[:-1])) if len(batch) > 1 else np.ones(0, bool)
    edges = np.flatnonzero((blocks[1:] != blocks[:-1]) | ~same.astype(bool)) + 1
    for start, end in zip([0, *edges.tolist()], [*edges.tolist(), len(batch)]):
        if end > start:
            yield (paths[start].as_py(), int(blocks[start])), batch.slice(start, end - start)


def _blanks(lines: pa.Array) -> np.ndarray:
    return np.asarray(pc.is_in(lines, pa.array(["", "\r"], lines.type))).astype(bool)


def _quoted(lines: pa.Array) -> tuple[np.ndarray, list[str]]:
    places = np.flatnonzero(np.asarray(pc.match_substring(lines, '"')).astype(bool))
    return places, lines.take(pa.array(places)).to_pylist()


class _Effect:
    """What a split does to either state, and the records that end in it."""

    def __init__(self) -> None:
        self.states, self.ended = [OUTSIDE, INSIDE], [0, 0]
        self.header: list[str] | str | None = []

    def add(self, lines: pa.Array) -> None:
        places, texts = _quoted(lines)
        filled = np.concatenate(([0], np.cumsum(~_blanks(lines))))
        for begin in (OUTSIDE, INSIDE):
            state, ended, done = self.states[begin], 0, 0
            for place, text in zip(places.tolist(), texts):
                if state == OUTSIDE:
                    ended += int(filled[place] - filled[done])
                state = after(text, state)
                ended += state == OUTSIDE
                done = place + 1
            if state == OUTSIDE:
                ended += int(filled[-1] - filled[done])
            self.states[begin] = state
            self.ended[begin] += ended

    def head(self, lines: pa.Array) -> None:
        """Gather the first record of a file."""
        if isinstance(self.header, list):
            state = INSIDE if self.header else OUTSIDE
            for line in lines:
                text = line.as_py()
                if state == OUTSIDE and text in ("", "\r"):
                    continue
                self.header.append(text)
                state = after(text, state)
                if state == OUTSIDE:
                    self.header = "\n".join(self.header)
                    return


def _effects(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, effect, span = None, _Effect(), 0

    def row() -> pa.RecordBatch:
        header = effect.header if isinstance(effect.header, str) else None
        values = [*key, span, *effect.states, *effect.ended, header]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
        names = ["path", "block", "span", "out_state", "in_state", "out_ended", "in_ended", "header"]
        return pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip(values, kinds)], names=names)

    for batch in batches:
        for found, part in _segments(batch):
            if found != key:
                if key is not None:
                    yield row()
                key, effect, span = found, _Effect(), part.column("span")[0].as_py()
            lines = part.column("text")
            effect.add(lines)
            if key[1] == 0:
                effect.head(lines)
    if key is not None:
        yield row()


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of splits whose state is known: whole ones, and pieces of those that cross to other splits."""
    key, owner, state, place, crossing, pending = None, 0, OUTSIDE, 0, False, []

    def rows(block: int, places: np.ndarray, piece: int | None, records: pa.Array) -> pa.RecordBatch:
        n = len(records)
        return pa.RecordBatch.from_arrays(
            [pa.repeat(key[0], n), pa.repeat(pa.scalar(block, pa.int64()), n), pa.array(places, pa.int64()),
             pa.repeat(pa.scalar(piece, pa.int64()), n), records], names=["path", "block", "place", "piece", "record"])

    def piece(into: int, number: int) -> pa.RecordBatch:
        return rows(into, np.array([number]), key[1], pa.array(["\n".join(pending)]))

    def tail() -> Iterator[pa.RecordBatch]:
        if pending:  # ends in another split, as its first record, or with the file
            yield piece(owner, place if owner == key[1] else 0)

    for batch in batches:
        for found, part in _segments(batch):
            if found != key:
                if key is not None:
                    yield from tail()
                key, place, pending = found, 0, []
                state, owner = part.column("inside")[0].as_py(), part.column("owner")[0].as_py()
                crossing = state == INSIDE
            lines = part.column("text")
            places, texts = _quoted(lines)
            states = np.empty(len(lines), np.int8)
            done = 0
            for at, text in zip(places.tolist(), texts):
                states[done:at] = state
                state = after(text, state)
                states[at] = state
                done = at + 1
            states[done:] = state
            ends = np.flatnonzero(states == OUTSIDE) + 1
            if not len(ends):
                pending += lines.to_pylist()
                continue
            start = 0
            if crossing or pending:
                pending += lines.slice(0, int(ends[0])).to_pylist()
                yield piece(key[1], place) if crossing else rows(
                    key[1], np.array([place]), None, pa.array(["\n".join(pending)]))
                crossing, pending, place, start = False, [], place + 1, 1
            bounds = np.concatenate((ends[start - 1: start] if start else [0], ends[start:]))
            if len(bounds) > 1:
                groups = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), lines)
                records = pc.binary_join(groups, "\n")
                records = records.filter(pa.array(~_blanks(records)))
                yield rows(key[1], place + np.arange(len(records)), None, records)
                place += len(records)
            pending = lines.slice(int(ends[-1])).to_pylist()
    if key is not None:
        yield from tail()


ADDRESS = "^([^:/]+):/+"  # listings and rows write the scheme with different numbers of slashes


class CsvSplits:
    """CSV files below some paths, read split by split; the list of splits is stored when the object is made.

    ``headers`` are the different headers, in the order of the paths and file names. Records end with LF or CR LF
    outside of quotes, blank ones are skipped; quotes are doubled inside quoted cells. An open cell at the end of a file
    ends there. Files without bytes have no header and no records.
    """

    def __init__(self, spark: SparkSession, paths: list[str]):
        fixed_splits(spark)
        self.spark = spark
        self.headers: list[tuple[str, ...]] = []
        raw = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(paths)
        self.scan = raw.select(
            F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
            F.col("_metadata.file_block_length").alias("span"), F.col("value").alias("text"))
        effects = self.scan.mapInArrow(_effects, f"path string, block bigint, span bigint, {STATE}")
        self.blocks = stage(self._states(effects), "splits")
        no_header = (F.col("block") == 0) & F.col("header").isNull()
        n_blocks, self.crossing, wide = self.blocks.agg(
            F.count("*"), *[F.coalesce(F.bool_or(flag), F.lit(False)) for flag in ("open", no_header)]).first()
        if n_blocks > BROADCAST_BLOCKS:
            raise ValueError(f"{n_blocks} file splits; raise spark.sql.files.maxPartitionBytes")
        # the header of a file stands in its first split, unless it is wider than that
        heads = self.blocks.filter("block = 0 AND header IS NOT NULL").select("path", "header")
        if wide:
            found = self._cut_records().join(self.blocks.filter(no_header), "path", "left_semi").filter("place < 0")
            heads = stage(heads.unionByName(found.select("path", F.col("record").alias("header"))), "headers")
        listing = [(file, number) for number, path in enumerate(paths) for file in sorted(spark.read.text(path).inputFiles())]
        sources = spark.createDataFrame(
            [(file, source, number) for number, (file, source) in enumerate(listing)],
            "_file string, source_no int, file_no int").withColumn("_file", F.regexp_replace("_file", ADDRESS, "$1:/"))
        named = heads.join(sources, F.regexp_replace("path", ADDRESS, "$1:/") == F.col("_file"))
        texts = [row.header for row in named.groupBy("header").agg(
            F.min("file_no").alias("first")).orderBy("first").collect()]
        self.headers = [tuple(next(csv.reader(io.StringIO(text.removeprefix("\ufeff"), newline="")), ())) for text in texts]
        for header in self.headers:
            if len(set(header)) < len(header):
                raise ValueError(f"a column name stands twice in the header {header}")
        numbers = spark.createDataFrame(list(enumerate(texts)), "header_no int, header string")
        files = named.join(numbers, "header").select("path", "header_no", "source_no")
        order = [logical_name(F.col("path")), part_number(F.col("path")), F.col("path"), F.col("block")]
        before = Window.partitionBy("source_no").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        # a file given with two paths is read for each of them
        self.places = self.blocks.join(files, "path").select(
            "file", F.col("block").alias("_block"), "header_no", "source_no",
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))

    @staticmethod
    def _states(effects: DataFrame) -> DataFrame:
        """Per split: whether it begins inside a cell, which split ends a record it leaves open, records and headers."""
        file = Window.partitionBy("path").orderBy("block")
        earlier, later = file.rowsBetween(Window.unboundedPreceding, -1), file.rowsBetween(1, Window.unboundedFollowing)
        turns = F.coalesce(F.sum((F.col("out_state") > F.col("in_state")).cast("int")).over(earlier), F.lit(0))
        is_set = F.when(F.col("out_state") == F.col("in_state"), F.struct("out_state", "turns"))
        begun = effects.withColumn("turns", turns).withColumn(
            "set", F.last(is_set, ignorenulls=True).over(earlier)).withColumn("inside", F.pmod(
                F.coalesce("set.out_state", F.lit(OUTSIDE)) + F.col("turns") - F.coalesce("set.turns", F.lit(0)),
                F.lit(2)).cast("int"))

        def under_state(name: str):
            return F.when(F.col("inside") == INSIDE, F.col(f"in_{name}")).otherwise(F.col(f"out_{name}"))

        is_last = F.lead("block").over(file).isNull()
        counted = begun.withColumn("open", under_state("state") == INSIDE).withColumn(
            "ended", under_state("ended") + (is_last & F.col("open")).cast("int"))
        ending = F.first(F.when(F.col("ended") > 0, F.col("block")), ignorenulls=True).over(later)
        first = (F.col("ended") > 0) & (F.coalesce(F.sum("ended").over(earlier), F.lit(0)) == 0)
        return counted.select(
            "path", F.xxhash64("path").alias("file"), "block", "span", "inside", "open",
            F.coalesce(ending, F.col("block")).alias("owner"), first.cast("int").alias("heads"),
            (F.col("ended") - first.cast("int")).alias("rows"), "header")

    def _cut_records(self) -> DataFrame:
        """(path, block, place, record) of all records; the header of a file has a place below 0."""
        known = F.broadcast(self.blocks.select(
            "file", F.col("block").alias("_block"), F.col("span").alias("_span"), "inside", "owner"))
        here = (F.xxhash64("path") == F.col("file")) & (F.col("block") == F.col("_block")) & (
            F.col("span") == F.col("_span"))
        inside = F.coalesce("inside", F.raise_error(F.lit(CHANGED)).cast("int"))
        rows = self.scan.join(known, here, "left").select(
            "path", "block", "text", inside.alias("inside"), "owner").mapInArrow(_cut, RECORDS)
        records = rows.filter("piece IS NULL").drop("piece")
        if self.crossing:
            pieces = F.sort_array(F.collect_list(F.struct("piece", "record")))
            records = records.unionByName(rows.filter("piece IS NOT NULL").groupBy("path", "block", "place").agg(
                F.array_join(F.transform(pieces, lambda part: part["record"]), "\n").alias("record")))
        heads = F.broadcast(self.blocks.select("file", F.col("block").alias("_block"), "heads"))
        return records.join(heads, (F.xxhash64("path") == F.col("file")) & (F.col("block") == F.col("_block"))).select(
            "path", "block", (F.col("place") - F.col("heads")).alias("place"),
            F.regexp_replace("record", r"\r\z", "").alias("record"))

    def table(self) -> DataFrame:
        """Every record as (source_no, line_no, one text column per name of any header); empty cells are NULL.

        ``source_no`` is the place of the record's path among the paths, ``line_no`` counts its records from 0 in the
        order of files and splits. Names come in first-seen order; a column that a file lacks is NULL.
        """
        names = list(dict.fromkeys(name for header in self.headers for name in header))
        if not names:
            return self.spark.createDataFrame([], "source_no int, line_no bigint")
        width = max(map(len, self.headers))
        cells = ", ".join(f"c{i} string" for i in range(width))
        placed = (F.xxhash64("path") == F.col("file")) & (F.col("block") == F.col("_block"))
        parsed = self._cut_records().filter("place >= 0").join(F.broadcast(self.places), placed).select(
            "source_no", (F.col("start") + F.col("place")).alias("line_no"), "header_no",
            F.from_csv("record", cells, {"escape": '"', "maxColumns": str(width + 1)}).alias("cells"))

        def cell(name: str):
            at = [header.index(name) if name in header else None for header in self.headers]
            known = [F.when(F.col("header_no") == number, F.col(f"cells.c{place}"))
                     for number, place in enumerate(at) if place is not None]
            return F.coalesce(*known)

        return parsed.select("source_no", "line_no", *[cell(name).alias(name) for name in names])

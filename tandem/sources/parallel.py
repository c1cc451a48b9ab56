"""Multilingual tables: CSV dictionaries and line-aligned files."""

from __future__ import annotations

import csv
import io
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tandem.functions.languages import LANGUAGE_NAMES, code_of_file, mapped
from tandem.functions.text import strip
from tandem.operators.indexing import number_lines
from tandem.operators.pairs import zip_columns
from tandem.sources.csv_splits import CsvSplits
from tandem.sources.lines import read_manifest, scan_lines


HEADER_BYTES = 1 << 16
READERS = 16


def _header(spark: SparkSession, file: str) -> tuple[str, ...]:
    """The first record of a CSV file, from as many of its first bytes as it takes."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(path)
    try:
        source, data = codec.createInputStream(stream) if codec else stream, b""
        while True:
            more = bytes(source.readNBytes(max(HEADER_BYTES, len(data))))
            data += more
            text = data.decode(errors="replace").removeprefix("\ufeff")
            reader = csv.reader(io.StringIO(text, newline=""))
            header = tuple(next(reader, ()))
            # a record that others follow is whole
            if not more or next(reader, None) is not None:
                return header
    finally:
        stream.close()


def files_by_header(spark: SparkSession, paths: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """The CSV files below the paths, grouped by their header, in the order of the paths.

    Only the listing and the first bytes of each file are read, by some threads of the driver.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    listing = {path: sorted(spark.read.text(path).inputFiles()) for path in dict.fromkeys(paths)}
    files = [file for path in paths for file in listing[path]]
    with ThreadPool(READERS) as pool:
        headers = pool.map(lambda file: _header(spark, file), files)
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, header in zip(files, headers):
        if header:  # an empty file has none, and no rows either
            groups.setdefault(header, []).append(file)
    return groups


def read_dictionary(
    spark: SparkSession, paths: str | list[str], *, multi_line: bool, null_words: tuple[str, ...] = ()
) -> DataFrame:
    """CSV files, or folders of part files, whose headers name the languages; every column is text.

    Columns go by name, whatever their order in a file: there is one reader per different header, and its rows are
    NULL where the header lacks a language. Empty cells are NULL; so are cells that hold just one of ``null_words``,
    while without them words like ``null`` and ``NA`` stay text. The caller says whether cells may hold line breaks
    (``multi_line``): then splits of a file are read apart by :class:`tandem.sources.csv_splits.CsvSplits`. Without
    any header the table is empty and has no columns.
    """
    if multi_line:
        paths = [paths] if isinstance(paths, str) else list(paths)
        return _without(CsvSplits(spark, paths).table().drop("source_no", "line_no"), null_words)
    return merge_schemas([
        _without(spark.read.schema(_schema(header)).csv(
            files, header=True, escape='"', enforceSchema=False), null_words)
        for header, files in files_by_header(spark, paths).items()
    ])


def _schema(header: tuple[str, ...]) -> StructType:
    return StructType([StructField(name, StringType()) for name in header])


def _without(table: DataFrame, words: tuple[str, ...]) -> DataFrame:
    if not words:
        return table
    return table.select(*[F.when(~F.col(f"`{c}`").isin(*words), F.col(f"`{c}`")).alias(c) for c in table.columns])


def merge_schemas(tables: list[DataFrame]) -> DataFrame:
    """Append tables; columns appear in first-seen order and are NULL where a table lacks them."""
    if not tables:
        return SparkSession.active().createDataFrame([], StructType([]))
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), tables)


def load_dictionaries(
    spark: SparkSession, paths: list[str], *, multi_line: bool, null_words: tuple[str, ...] = ()
) -> DataFrame:
    """All CSV dictionaries as one wide table."""
    return read_dictionary(spark, paths, multi_line=multi_line, null_words=null_words)


def load_numbered_dictionaries(spark: SparkSession, paths: list[str], *, multi_line: bool) -> DataFrame:
    """The same with (source_no, line_no): which dictionary, and which row of it, counted from 0."""
    if multi_line:
        return CsvSplits(spark, paths).table()
    number = {file: i for i, path in enumerate(paths) for file in spark.read.text(path).inputFiles()}
    # listings and rows write the scheme with different numbers of slashes
    address = F.regexp_replace("path", "^([^:/]+):/+", "$1:/")
    sources = spark.createDataFrame(list(number.items()), "path string, source_no int").withColumn("path", address)
    tables = []
    for header, files in files_by_header(spark, paths).items():
        table = spark.read.schema(_schema(header)).csv(
            files, header=True, escape='"', enforceSchema=False)
        tables.append(table.select(
            "*", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
            F.col("_metadata.file_block_length").alias("span"), F.monotonically_increasing_id().alias("row")).withColumn("path", address).join(sources, "path"))
    if not tables:
        return spark.createDataFrame([], "source_no int, line_no bigint")
    return number_lines(merge_schemas(tables), group=["source_no"])


def load_dictionary_manifest(
    spark: SparkSession, manifest: str, *, multi_line: bool, null_words: tuple[str, ...] = ()
) -> DataFrame:
    """The dictionaries whose paths a manifest lists."""
    return load_dictionaries(spark, read_manifest(spark, manifest), multi_line=multi_line, null_words=null_words)


def aligned_lines(
    spark: SparkSession, path: str, names: dict[str, str] | None = None, prefix: str = "dev"
) -> DataFrame:
    """(lang, line_no, text) of files named ``{split}.{code}``, blank lines kept.

    Files of one language are appended in the order of their names (``dev`` before ``devtest``) and
    numbered through. An unknown language code fails the job.
    """
    scan = scan_lines(spark, path, name_prefix=prefix)
    named = scan.withColumn("lang", mapped(code_of_file(F.col("name")), names or LANGUAGE_NAMES))
    return number_lines(named, group=["lang"]).select("lang", "line_no", strip(F.col("text")).alias("text"))


def load_aligned(
    spark: SparkSession, path: str, names: dict[str, str] | None = None, prefix: str = "dev",
    strict: bool = False,
) -> DataFrame:
    """Line-aligned files as a wide table (line_no, one column per language)."""
    names = names or LANGUAGE_NAMES
    languages = list(dict.fromkeys(names.values()))
    return zip_columns(aligned_lines(spark, path, names, prefix), languages, strict=strict)

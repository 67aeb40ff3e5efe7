"""Delimited text: everything is read as strings, types come from the cleaning step.

Files of one feed may differ in their headers, so files are grouped by header line and each group is
read with its own column list; the groups are united by name.
"""

from __future__ import annotations

import csv
import io
import re
from collections import defaultdict
from collections.abc import Callable
from functools import reduce

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from millrace.functions.names import plain_name
from millrace.operators.dedup import keep_last
from millrace.operators.filters import has_extension
from millrace.operators.schema import drop_serial, rename_all
from millrace.sources import heads

ORDER = ["file_path", "row_block", "row_seq"]


def list_files(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """(path, length, modified) of all files below a folder or of a list; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "length", F.col("modificationTime").alias("modified"))


def listed_by_extension(files: DataFrame, extensions: tuple[str, ...]) -> DataFrame:
    """File rows with ``format`` set, or NULL and status ``unsupported`` for any other extension."""
    ext = F.lower(F.regexp_extract("path", r"\.([^./\\]+)$", 1))
    known = has_extension(F.col("path"), extensions)
    return files.select(
        "*",
        F.when(known, ext).alias("format"),
        F.when(known, "accepted").otherwise("unsupported").alias("status"),
    )


def headers_of(files: DataFrame) -> DataFrame:
    """First record of each file, and whether the file has quotes; read as bytes, spread over the executors."""
    cloudpickle.register_pickle_by_value(heads)
    return files.select("path").mapInArrow(heads.read_heads, "path string, header string, quotes boolean")


def move_files(spark: SparkSession, moves: list[tuple[str, str]]) -> None:
    """Moves files, (path, target), in tasks; the pairs are those of one batch of a stream."""
    cloudpickle.register_pickle_by_value(heads)
    frame = spark.createDataFrame(moves, "path string, target string")
    frame.mapInArrow(heads.move_files, "path string, target string").write.format("noop").mode("overwrite").save()


def plain_path(uri: Column) -> Column:
    """A metadata path in the form file listings use: not escaped, one slash after ``file:``."""
    text = F.try_url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(F.coalesce(text, uri), "^file:/+", "file:/")


def _with_position(df: DataFrame, plain: bool) -> DataFrame:
    """Row position inside the source: file (its path, or its address as it is), block of the file, sequence inside the scan task."""
    address = F.col("_metadata.file_path")
    return df.select(
        "*",
        (plain_path(address) if plain else address).alias("file_path"),
        F.col("_metadata.file_block_start").alias("row_block"),
        F.monotonically_increasing_id().alias("row_seq"),
    )


def column_names(header: str) -> list[str]:
    """Names of a header line; a blank name gets its position, a repeated one a number."""
    names: list[str] = []
    taken: set[str] = set()
    csv.field_size_limit(max(csv.field_size_limit(), len(header) + 1))
    for i, cell in enumerate(next(csv.reader(io.StringIO(header, newline="")), [])):
        name = base = cell if cell.strip() else f"unnamed: {i}"
        n = 0
        while name.lower() in taken:
            n += 1
            name = f"{base}.{n}"
        taken.add(name.lower())
        names.append(name)
    return names


def files_with_line_breaks(spark: SparkSession, paths: list[str]) -> set[str]:
    """Files in which a quoted cell goes on in the next line: some line has an odd number of quotes.

    One pass over the text; all other files can be read in blocks.
    """
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    lines = spark.read.text(paths).where(quotes % 2 == 1)
    found = lines.select(plain_path(F.col("_metadata.file_path")).alias("path")).distinct()
    return {r["path"] for r in found.toLocalIterator()}


RECORD = "_record"


def surplus_text(cells: int) -> Column:
    """The whole record where it has more cells than the header, else NULL. Spark keeps the record of a row whose
    cells don't fit; commas outside quotes are counted for those rows only."""
    bare = F.regexp_replace(RECORD, r'"[^"]*"', "")
    commas = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit("")))
    return F.when(F.col(RECORD).isNotNull() & (commas >= cells), F.col(RECORD))


def read_csv_strings(
    spark: SparkSession, paths: list[str] | str, with_position: bool = False, surplus: str | None = None, plain: bool = True
) -> DataFrame:
    """All columns as strings, files with different headers united by name. Short rows end in NULLs.

    ``surplus`` names a column that holds the whole record of a row with more cells than its header. The row sequence is only stable inside one scan: land the frame as a table before using it twice.
    """
    if isinstance(paths, str):
        files = list_files(spark, paths, "*.csv")
    else:
        files = spark.createDataFrame([(p,) for p in paths], "path string")
    # One entry per file, as in the file index that Spark keeps of the same folder.
    found = {r["path"]: (r["header"], r["quotes"]) for r in headers_of(files).toLocalIterator()}
    headers = {path: header for path, (header, _) in found.items()}
    if not headers:
        raise FileNotFoundError(f"no csv files under {paths}")
    # A file without quotes has no line break in them; only the others are looked through line by line.
    quoted = sorted(path for path, (_, quotes) in found.items() if quotes)
    broken = files_with_line_breaks(spark, quoted) if quoted else set()
    groups: dict[tuple[str, bool], list[str]] = defaultdict(list)
    for path, header in headers.items():
        groups[header, _same(path) in broken].append(path)

    def read(header: str, multi_line: bool, members: list[str]) -> DataFrame:
        schema = StructType([StructField(n, StringType()) for n in column_names(header)])
        options = {"header": True, "escape": '"', "multiLine": multi_line, "maxColumns": len(schema) + 2**15}
        if surplus is None:
            df = spark.read.csv(sorted(members), schema=schema, **options)
        else:
            cells = len(schema)
            reader = spark.read.option("columnPruning", "false").option("columnNameOfCorruptRecord", RECORD)
            df = reader.schema(schema.add(RECORD, StringType())).options(**options).csv(sorted(members))
            df = df.withColumn(surplus, surplus_text(cells)).drop(RECORD)
        return _with_position(df, plain) if with_position else df

    frames = [read(*group, members) for group, members in sorted(groups.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _same(path: str) -> str:
    """``plain_path`` for a path in hand."""
    return re.sub("^file:/+", "file:/", path if ":" in path else f"file:{path}")


def union_parts(
    parts: list[DataFrame],
    keys: list[str],
    order: list[str],
    rename: Callable[[str], str] = plain_name,
) -> DataFrame:
    """Sheets of one workbook: headers normalised, serial column dropped, last row per key kept.

    ``order`` starts with the sheet's position, so one pass over the union equals a pass per sheet
    followed by one over all.
    """
    frames = [drop_serial(rename_all(p, rename)) for p in parts]
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return keep_last(united, keys, order)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).csv(path, header=True, escape='"')

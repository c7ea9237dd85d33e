"""Raw listing records from CSV."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from rategauge.sources.csv_options import read_options
from rategauge.sources.guards import reading


def month_file(
    input_path: str, month: str, name: str = "listings", extension: str = "csv"
) -> str:
    """``<input_path>/<name>_<month>.<extension>``."""
    return f"{input_path.rstrip('/')}/{name}_{month}.{extension}"


#: In quotes with doubled quotes inside, or without quotes (RFC 4180). Possessive, so that a long
#: field costs one pass and no stack.
_FIELD = r'''(?:"[^"]*+(?:""[^"]*+)*+"|[^",]*+)'''
#: A line of whole fields.
WHOLE_LINE = rf"\A{_FIELD}(?:,{_FIELD})*+\z"


def is_whole_line(line: Column) -> Column:
    """True for a line that neither opens a quoted field it does not close nor closes one."""
    return ~F.contains(line, F.lit('"')) | line.rlike(WHOLE_LINE)


def broken_files(spark: SparkSession, paths: Sequence[str]) -> tuple[list[str], list[str]]:
    """``(broken, plain)``: files that may hold a line break in a quoted field, and the others.

    If every line of a file is whole, none of its fields spans lines: the first line
    begins outside quotes, and each whole line ends there. The lines are tested where
    they lie, in blocks. Files that fit one task anyway are not tested but called
    broken, which costs them nothing.
    """
    split = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    sizes = spark.read.format("binaryFile").load(list(paths)).select("path", "length").collect()
    large = [row.path for row in sizes if row.length > split]
    if not large:
        return [row.path for row in sizes], []
    lines = spark.read.text(large).filter(~is_whole_line(F.col("value")))
    found = {row[0] for row in lines.select("_metadata.file_path").distinct().collect()}
    plain = [path for path in large if path not in found]
    return [row.path for row in sizes if row.path not in set(plain)], plain


def read_listings(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | None = None,
    infer_schema: bool = False,
    multi_line: bool | None = None,
) -> DataFrame:
    """Read listing CSV: a file, a directory, a glob or several of these.

    Without a schema all columns are text under their header names; select the
    ones you need and the parser skips the rest.  With a schema the header must
    match it.  ``infer_schema`` costs a pass over the data.

    Line breaks inside quoted fields make one task read a file from end to end.
    By default the data decide: files larger than one task's share are tested, and
    those without such fields are split into blocks.  ``multi_line`` says so instead,
    for all files, and saves the test.
    """
    return united(listing_parts(spark, path, schema, infer_schema, multi_line))


def united(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def listing_parts(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | None = None,
    infer_schema: bool = False,
    multi_line: bool | None = None,
) -> list[DataFrame]:
    """:func:`read_listings` before files that are split and files that are not are united.

    Of a part, unlike of their union, ``_metadata`` can be selected.
    """
    paths = [path] if isinstance(path, str) else list(path)

    def read(paths: Sequence[str], multi_line: bool) -> DataFrame:
        reader = spark.read.options(**read_options(multi_line))
        if schema is not None:
            reader = reader.schema(schema)
        elif infer_schema:
            reader = reader.option("inferSchema", "true")
        return reader.csv(list(paths))

    with reading(", ".join(paths)):
        if multi_line is not None:
            return [read(paths, multi_line)]
        broken, plain = broken_files(spark, paths)
        if infer_schema or not plain or not broken:
            return [read(paths, bool(broken) or not plain)]
        return [read(plain, False), read(broken, True)]

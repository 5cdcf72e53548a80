"""Reading vendor files: every value a string as written, every row kept, its number fixed when it is read."""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text

SEPARATORS = {".csv": ",", ".txt": ",", ".tsv": "\t"}
EXCEL = (".xlsx", ".xls", ".xlsm")


class UnsupportedFileType(ValueError):
    pass


class MultipleSheets(ValueError):
    pass


def suffix(path: str) -> str:
    name = path.rsplit("/", 1)[-1].lower()
    return name[name.rfind(".") :] if "." in name else ""


def disambiguate(names: list[str | None]) -> list[str]:
    """Trimmed names; a blank one is unnamed, the second of a name gets __2, and so on."""
    seen: dict[str, int] = {}
    out = []
    for n in names:
        n = (n or "").strip() or "unnamed"
        seen[n] = seen.get(n, 0) + 1
        out.append(n if seen[n] == 1 else f"{n}__{seen[n]}")
    return out


def csv_header(spark: SparkSession, path: str, separator: str) -> list[str]:
    """Names of the first row, without a byte order mark; [] for an empty file."""
    first = spark.read.text(path).limit(1).collect()
    if not first:
        return []
    return disambiguate(next(csv.reader(io.StringIO(first[0][0].removeprefix("﻿")), delimiter=separator), []))


def numbered(df: DataFrame, columns: list[str]) -> DataFrame:
    """row_number (from 1, in file order), raw_payload for rows that have a value; blank rows are dropped first.

    The number comes from two passes: rows of each partition are counted, then each adds the rows of those before."""
    payload = F.map_from_arrays(F.array(*[F.lit(c) for c in columns]), F.array(*[F.col(f"`{c}`") for c in columns]))
    some = F.exists(F.array(*[F.col(f"`{c}`") for c in columns]), lambda c: ~text.blank(c))
    rows = df.withColumn("_id", F.monotonically_increasing_id()).where(some).select("_id", F.shiftright("_id", 33).alias("_p"), payload.alias("raw_payload"))
    counts = rows.groupBy("_p").count()
    before = counts.select("_p", F.coalesce(F.sum("count").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))  # a row a partition
    at = F.row_number().over(Window.partitionBy("_p").orderBy("_id"))
    return rows.join(F.broadcast(before), "_p").select((at + F.col("before")).cast("int").alias("row_number"), "raw_payload")


def read_csv(spark: SparkSession, path: str, separator: str | None = None) -> tuple[list[str], DataFrame]:
    """(columns, rows) of a delimited file. A row with more or fewer cells than the header is an error.

    Quoted cells may hold line breaks, so a file is one split; many files are read side by side."""
    sep = separator or SEPARATORS[suffix(path)]
    names = csv_header(spark, path, sep)
    if not names:
        return [], spark.createDataFrame([], "row_number int, raw_payload map<string,string>")
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    df = spark.read.csv(path, schema=schema, header=True, sep=sep, quote='"', escape='"', multiLine=True, mode="FAILFAST", enforceSchema=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, emptyValue="", encoding="UTF-8")
    return names, numbered(df, names)


def sheet_names(path: str) -> list[str]:
    """Sheets that hold data, in the order of the workbook. Needs an Excel reader for pandas."""
    import pandas as pd

    with pd.ExcelFile(path) as book:
        return [s for s in book.sheet_names if not book.parse(s, header=None, dtype=str, nrows=1).empty]


def read_excel(spark: SparkSession, path: str, sheet: str | None = None) -> tuple[list[str], DataFrame]:
    """(columns, rows) of a sheet, all strings; a workbook with several sheets of data needs one named. A sheet is read
    whole on the driver: the format allows 1,048,576 rows."""
    import pandas as pd

    sheets = sheet_names(path)
    if sheet is None and len(sheets) > 1:
        raise MultipleSheets(f"{path} has data in {', '.join(sheets)}; name one")
    df = pd.read_excel(path, sheet_name=sheet or (sheets[0] if sheets else 0), header=None, dtype=str, keep_default_na=False)
    if df.empty:
        return [], spark.createDataFrame([], "row_number int, raw_payload map<string,string>")
    names = disambiguate([cell(x) for x in df.iloc[0]])
    rows = [dict(zip(names, (cell(x) or None for x in r), strict=True)) for r in df.iloc[1:].itertuples(index=False)]
    rows = [r for r in rows if any(v and v.strip() for v in r.values())]
    return names, spark.createDataFrame([(i + 1, r) for i, r in enumerate(rows)], "row_number int, raw_payload map<string,string>")


def cell(value: object) -> str:
    """Text of a cell: nothing is empty, a whole number has no decimals."""
    if value is None or value != value:
        return ""
    return str(int(value)) if isinstance(value, float) and value.is_integer() else str(value)


def read_file(spark: SparkSession, path: str, sheet: str | None = None) -> tuple[list[str], DataFrame]:
    kind = suffix(path)
    if kind in SEPARATORS:
        return read_csv(spark, path)
    if kind in EXCEL:
        return read_excel(spark, path, sheet)
    raise UnsupportedFileType(f"{path}: {kind or 'no suffix'}")


def file_facts(spark: SparkSession, path: str) -> tuple[str, int]:
    """(SHA-256 of the content, bytes): a file is its content, whatever its name."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark._jsc.hadoopConfiguration())
    # read as a stream, so a file of any size takes one buffer
    content = store.open(where)
    try:
        return spark._jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(content), store.getFileStatus(where).getLen()
    finally:
        content.close()


def sample_csv(rows: DataFrame, columns: list[str], n: int, out: str) -> None:
    """The first n rows as one quoted CSV file with a header in the folder out."""
    first = rows.where(F.col("row_number") <= n).orderBy("row_number").select(*[F.coalesce(F.col("raw_payload")[c], F.lit("")).alias(c) for c in columns])
    first.coalesce(1).write.csv(out, header=True, quoteAll=True, emptyValue="")

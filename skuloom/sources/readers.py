"""Readers: typed exports, reference bundles, dated folders, promoted headers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skuloom.functions.text import WHITESPACE
from skuloom.operators.projection import conform
from skuloom.schemas import EXPORT_HEADERS, TABLES
from skuloom.sources.ordered_text import ORDER, text_rows


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    columns: Sequence[str] | None = None,
    fmt: str | None = None,
    headers: Mapping[str, str] | None = None,
) -> DataFrame:
    """One export as a table, pruned to `columns` at the scan.

    Only the empty text is missing in a CSV file; "NA" or "nan" are texts. `headers` renames columns, by default as the
    exports call them. With a schema, columns are cast to its types, lenient ones as far as they can be read, missing
    ones read null, and `_ord` is stamped if the file has none. A file with no column of the schema raises.
    """
    fmt = fmt or ("csv" if path.endswith(".csv") else "parquet")
    df = spark.read.csv(path, header=True) if fmt == "csv" else spark.read.format(fmt).load(path)
    own = df.columns
    stamp = schema is not None and ORDER in schema.names and ORDER not in own
    if stamp:
        df = with_order(df)
    if fmt == "csv":
        df = df.select(*[F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) for c in own], *([ORDER] if stamp else []))
    if schema is not None:
        names = EXPORT_HEADERS if headers is None else headers
        # a header that stands for several columns of the reports goes to the one this table has
        taken = {c: next((n for n in names.get(c, "").split() if n in schema.names and n not in own), c) for c in own}
        if not set(taken.values()) & set(schema.names):
            raise ValueError(f"{path} has none of the columns {schema.names}, only {own}")
        df = conform(df.withColumnsRenamed({c: n for c, n in taken.items() if c != n}), schema)
    elif headers is not None:
        df = df.withColumnsRenamed({c: headers[c] for c in own if c in headers})
    return df.select(*columns) if columns else df


def read_bundle(spark: SparkSession, base: str, name: str, **options) -> DataFrame:
    """One named table of a bundle of reference tables (a directory per name)."""
    return read_table(spark, f"{base.rstrip('/')}/{name}", **options)


def load_inputs(
    spark: SparkSession, base: str, names: Sequence[str] | None = None, fmt: str = "parquet"
) -> dict[str, DataFrame]:
    """The input tables of the reports, each from its own directory under `base`."""
    return {
        name: read_bundle(spark, base, name, schema=TABLES[name], fmt=fmt)
        for name in (names or TABLES)
    }


def with_order(df: DataFrame) -> DataFrame:
    """Stamp the ingest position of every row: by file, then by place in the file.

    Both are properties of the row. In parquet a filter still reaches the scan; for text, whose rows are counted first,
    it does so once the export has been landed (`ordered_text.land`).
    """
    file = F.col("_metadata.file_path").alias("file")
    try:
        return df.select("*", F.struct(file, F.col("_metadata.row_index").alias("row")).alias(ORDER))
    except AnalysisException:
        return text_rows(df)


def discover(spark: SparkSession, folder: str, include: str, exclude: str | None = None) -> str:
    """Path of the first file whose name matches a glob and lacks a text.

    Lists the folder only; no file is opened.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", include)
        .load(folder)
        .select("path")
        .withColumn("_name", F.element_at(F.split("path", "/"), -1))
    )
    if exclude:
        files = files.filter(~F.contains("_name", F.lit(exclude)))
    first = files.agg(F.min_by("path", "_name")).first()[0]
    if first is None:
        raise FileNotFoundError(f"no file like {include} in {folder}")
    return first


def promote_header(
    spark: SparkSession, path: str, row: int, first_columns: int | None = None
) -> DataFrame:
    """CSV file, or files in the order of their names, whose row number `row` (from 0) holds the column names.

    The rows above are dropped, names are stripped, and only the first columns
    are kept if asked. The rows up to `row` travel to the driver. Cells stay text;
    `_ord` keeps the order of the files.
    """
    raw = with_order(spark.read.csv(path, header=False, nullValue=""))
    top = raw.orderBy(ORDER).limit(row + 1).collect()
    if len(top) <= row:
        raise ValueError(f"{path} has no row {row}")
    header = top[row]
    cells = [c for c in raw.columns if c != ORDER][:first_columns]
    names = [header[c].strip(WHITESPACE) if header[c] is not None else f"column_{i}" for i, c in enumerate(cells)]
    at = header[ORDER]
    after = F.col(ORDER) > F.struct(F.lit(at["file"]).alias("file"), F.lit(at["row"]).alias("row"))
    return raw.filter(after).select(*[F.col(c).alias(n) for c, n in zip(cells, names)], ORDER)


def positional(df: DataFrame, positions: Sequence[int], names: Sequence[str]) -> DataFrame:
    """Columns picked by position, under new names."""
    return df.select(*[F.col(f"`{df.columns[i]}`").alias(n) for i, n in zip(positions, names)])

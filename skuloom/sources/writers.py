"""Writers: one table, or a report of several."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folder of a bundle in which each complete run has one entry, a table of its sheets.
MANIFEST = "_manifest"
ENTRY = "nth long, run string, fmt string, sheets array<string>"


def write_table(df: DataFrame, path: str, fmt: str = "parquet", **options) -> None:
    """Write one table, replacing what is there."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        options = {"header": True, **options}
    writer.options(**options).save(path)


def write_report(sheets: Mapping[str, DataFrame], path: str, fmt: str = "parquet", **options) -> None:
    """Write the tables of a report, one directory per table."""
    for name, df in sheets.items():
        write_table(df, f"{path.rstrip('/')}/{name}", fmt, **options)


def write_bundle(sheets: Mapping[str, DataFrame], path: str, fmt: str = "parquet", **options) -> str:
    """Write the tables of a report as a unit, and return the name of this run.

    Every run has a folder of its own. Once all its sheets are there, one row is added to the manifest; a table in a
    folder appears there whole or not at all. Readers go by the manifest, so a run that fails half way changes nothing
    for them, and one that is under way is not seen. Earlier runs stay until `old_runs` names them to whoever clears them.
    """
    if not sheets:
        raise ValueError("a bundle has at least one sheet")
    spark = next(iter(sheets.values())).sparkSession
    base, run = path.rstrip("/"), uuid.uuid4().hex
    for name, df in sheets.items():
        write_table(df, f"{base}/{run}/{name}", fmt, **options)
    runs = _runs(spark, base)
    last = 0 if runs is None else runs.agg(F.max("nth")).first()[0] or 0
    entry = spark.createDataFrame([(last + 1, run, fmt, list(sheets))], ENTRY)
    entry.coalesce(1).write.mode("append").parquet(f"{base}/{MANIFEST}")
    return run


def read_run(spark: SparkSession, path: str, run: str | None = None) -> dict[str, DataFrame]:
    """All sheets of one complete run, by default the last; of runs that ended side by side, that with the greatest name."""
    base = path.rstrip("/")
    runs = _runs(spark, base)
    wanted = F.lit(True) if run is None else F.col("run") == run
    entry = None if runs is None else runs.filter(wanted).orderBy(F.desc("nth"), F.desc("run")).first()
    if entry is None:
        raise FileNotFoundError(f"no complete run {run or ''} in {path}")
    reader = spark.read.format(entry["fmt"])
    if entry["fmt"] == "csv":
        reader = reader.option("header", True)
    return {name: reader.load(f"{base}/{entry['run']}/{name}") for name in entry["sheets"]}


def old_runs(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Names of complete runs but the last `keep`, oldest first."""
    base = path.rstrip("/")
    runs = _runs(spark, base)
    # a row per run
    names = [] if runs is None else [r["run"] for r in runs.orderBy("nth", "run").collect()]
    return names[: max(0, len(names) - keep)]


def _runs(spark: SparkSession, base: str) -> DataFrame | None:
    """The manifest; None before the first complete run."""
    try:
        return spark.read.schema(ENTRY).parquet(f"{base}/{MANIFEST}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None

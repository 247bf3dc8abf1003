"""File sources.

Bar files and CSVs are read with a declared schema, so nothing is inferred;
driver tables use their Parquet footer schema. Reads select only the
columns asked for, so the Parquet scan prunes the rest.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barwise import schema as S
from barwise.operators.numbering import number_rows
from barwise.functions.timefn import from_epoch_micros


def require_columns(df: DataFrame, names: Iterable[str], what: str = "input") -> DataFrame:
    """Fail before any job runs when a required column is missing."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"{what}: missing columns {missing}")
    return df


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    """One driver table; ``columns`` limits the scan's ReadSchema."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


NANOS_AS_LONG = "spark.sql.legacy.parquet.nanosAsLong"


def bar_time(df: DataFrame, col: str = "timestamp") -> Column:
    """The bar time of a vendor file as a UTC wall-clock TIMESTAMP_NTZ,
    whatever the file stores: epoch nanoseconds (INT64 TIMESTAMP(NANOS),
    read as a long), a UTC-adjusted timestamp, or a zone-free one."""
    kind = df.schema[col].dataType
    if isinstance(kind, T.LongType):
        return from_epoch_micros(F.floor(F.col(col) / 1000))
    if isinstance(kind, T.TimestampType):
        return from_epoch_micros(F.unix_micros(F.col(col)))
    if isinstance(kind, T.TimestampNTZType):
        return F.col(col)
    raise ValueError(f"{col}: unsupported bar time type {kind.simpleString()}")


def read_bars(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None,
              columns: Sequence[str] | None = None) -> DataFrame:
    """Vendor bar files, one or many (S1-S4), as the ``BAR_FILE`` schema.

    ``paths`` may be files or folders; ``glob`` filters file names inside
    folders (``pathGlobFilter``). Many paths read as one table. No input or
    no matching file raises, like the reference's "no files" error.

    Column types come from the Parquet footers and are then cast to
    ``BAR_FILE``; the bar time is normalised by ``bar_time``. Spark rejects
    INT64 TIMESTAMP(NANOS) columns (the vendor loader's ``timestamp[ns,
    UTC]``) unless ``spark.sql.legacy.parquet.nanosAsLong`` is on; it is
    switched on for the session when such files are met.
    """
    if isinstance(paths, str):
        paths = [paths]
    if not paths:
        raise ValueError("read_bars: no input paths")
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    none = ValueError(f"read_bars: no files matching {glob or '*'} under {list(paths)}")
    try:
        raw = reader.parquet(*paths)
    except Exception as e:  # noqa: BLE001
        if "UNABLE_TO_INFER_SCHEMA" in str(e):
            raise none from e
        if "TIMESTAMP(NANOS" not in str(e):
            raise
        spark.conf.set(NANOS_AS_LONG, "true")
        raw = reader.parquet(*paths)
    if not raw.inputFiles():
        raise none
    require_columns(raw, S.BAR_FILE_REQUIRED, "bar files")
    out = []
    for f in S.BAR_FILE.fields:
        if f.name == "timestamp":
            out.append(bar_time(raw).alias("timestamp"))
        elif f.name in raw.columns:
            out.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
    return raw.select(*out).select(*(columns or S.BAR_FILE.fieldNames()))


def read_constituents(spark: SparkSession, path: str, numbered: bool = False) -> DataFrame:
    """Constituents CSV with header, every column a string.

    Columns are taken from the header as strings (no type inference); the
    required ones must be present (S6) and absent optional ones are added as
    nulls, so files with fewer or more columns load the same way.

    ``numbered`` adds ``row_no`` = 1, 2, ... in the order of the files (file by
    file, then line by line), for rules like "the last row of a symbol wins".
    """
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    require_columns(df, S.CONSTITUENTS_REQUIRED, "constituents")
    if numbered:
        # Splits come in order of their size; file, offset and place within the split give the line's.
        placed = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_offset"),
                           F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_line"))
        df = number_rows(placed, ["_file", "_offset", "_line"], "row_no").drop("_file", "_offset", "_line")
    for c in S.CONSTITUENT_COLUMNS:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    return df


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    """The stored daily rollup (S10); partition column ``month`` is kept
    so date filters can prune folders."""
    return spark.read.parquet(path)


def input_schema(df: DataFrame) -> DataFrame:
    """The columns of an input (S9): position, name, type, nullable; from the plan, without a job."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string, nullable boolean")


def profile_input(df: DataFrame, sample_rows: int = 5) -> tuple[DataFrame, DataFrame]:
    """Rows per input file and the first rows of each file.

    Returns (per-file counts, per-file sample). ``df`` must be a file scan
    (possibly projected or filtered). The sample uses each row's position
    in its file (``_metadata.row_index``), so it is a filter, not a shuffle.
    """
    per_file = (df.select(F.col("_metadata.file_path").alias("file_path"))
                .groupBy("file_path").agg(F.count(F.lit(1)).alias("rows")))
    sample = (df.withColumn("file_path", F.col("_metadata.file_path"))
              .withColumn("row_index", F.col("_metadata.row_index"))
              .where(F.col("row_index") < sample_rows))
    return per_file, sample

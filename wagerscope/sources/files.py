"""Bet and game files: discovery, typed load, rejects and export."""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wagerscope import schema
from wagerscope.functions.metrics import ratio


def headers(spark: SparkSession, path: str | Sequence[str], prefix: str = "") -> DataFrame:
    """``path, names`` of every file with text: the columns of its first line that is not blank.

    Each file is one task that stops after that line, so large files are not
    read through.  A file that cannot be read fails the job.
    """
    single = spark.newSession()
    # One file per partition, handed over line by line.
    single.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 50))
    single.conf.set("spark.sql.files.openCostInBytes", str(1 << 50))
    single.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    paths = [path] if isinstance(path, str) else list(path)
    lines = single.read.option("pathGlobFilter", f"{prefix}*").text(paths)

    def first_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            file, line = batch.column(0)[0].as_py(), batch.column(1)[0].as_py()
            if line.strip():
                names = next(csv.reader([line.removeprefix("\ufeff")]))
                yield pa.RecordBatch.from_pydict(
                    {"path": [file], "names": pa.array([names], pa.list_(pa.string()))}
                )
                return

    return lines.select("_metadata.file_path", "value").mapInArrow(
        first_line, "path string, names array<string>"
    )


def skipped_files(
    spark: SparkSession, path: str | Sequence[str], prefix: str = "transactions"
) -> DataFrame:
    """``path, reason`` of the files that ``read_bronze`` leaves out.

    A file belongs to the log only if its header is the contract's, in its
    order.  Files without any text hold no rows and are not listed.
    """
    lower = F.transform("names", lambda name: F.lower(F.trim(name)))
    wanted = F.array(*[F.lit(c) for c in schema.BRONZE_COLUMNS])
    return headers(spark, path, prefix).where(lower != wanted).select(
        "path", F.concat(F.lit("header: "), F.concat_ws(",", "names")).alias("reason")
    )


def read_games(spark: SparkSession, path: str) -> DataFrame:
    """The games file; its unnamed first column is the game's name.

    Columns are found by name.  Files that lack a column, or that differ from
    each other, are an error.
    """
    found = [r.names for r in headers(spark, path).select("names").distinct().limit(2).collect()]
    if len(found) != 1:
        raise ValueError(f"{path}: {'no header' if not found else 'files with different headers'}")
    kinds = {f.name: f.dataType.simpleString() for f in schema.GAMES.fields}
    names = [n.strip() or "game_name" for n in found[0]]
    if len(set(names)) < len(names) or not set(kinds) <= set(names):
        raise ValueError(f"{path}: the header lacks or repeats columns: {','.join(names)}")
    types = ", ".join(f"`{n}` {kinds.get(n, 'string')}" for n in names)
    games = spark.read.schema(types).csv(path, header=True, enforceSchema=True)
    return cast_times(games.select(*kinds))


def cast_times(df: DataFrame, cols: Sequence[str] = ("date", "timestamp")) -> DataFrame:
    """Cast the time columns that are there to timestamps."""
    present = {c: F.col(c).try_cast("timestamp") for c in cols if c in df.columns}
    return df.withColumns(present) if present else df


def read_bronze(
    spark: SparkSession,
    path: str | Sequence[str],
    prefix: str = "transactions",
    skip_bad_files: bool = True,
) -> DataFrame:
    """Every file below ``path`` whose name starts with ``prefix``, as text.

    One scan over all files, with the file each row came from.  Headers are
    looked at first, and a file with another one is left out as a whole, however
    many splits it has; ``skipped_files`` names it.  With ``skip_bad_files=False``
    such a file fails the load.  A file that cannot be read always does.
    """
    reader = (
        spark.read.schema(schema.BRONZE)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        # Without it a plain count would not look at headers and count bad files.
        .option("columnPruning", False)
        .option("pathGlobFilter", f"{prefix}*")
    )
    paths = [path] if isinstance(path, str) else list(path)
    bronze = reader.csv(paths)
    if skip_bad_files:
        # Paths only, like the file listing the driver holds anyway; the filter prunes files.
        bad = [r.path for r in skipped_files(spark, paths, prefix).select("path").collect()]
        if bad:
            bronze = bronze.where(~F.col("_metadata.file_path").isin(bad))
    return bronze.withColumn("source_file", F.col("_metadata.file_path"))


def discover(spark: SparkSession, path: str, prefix: str = "transactions") -> DataFrame:
    """S3: the files a load would read, with size; listed without reading them."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"{prefix}*")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))
    )


def month_paths(spark: SparkSession, folder: str, months: Sequence[str]) -> dict[str, bool]:
    """Which months have files, looked up in the file system and not by reading."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = {}
    for month in months:
        pattern = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/transactions_{month}.csv")
        hits = pattern.getFileSystem(conf).globStatus(pattern)
        found[month] = hits is not None and len(hits) > 0
    return found


def read_months(spark: SparkSession, folder: str, months: Sequence[str]) -> DataFrame:
    """The given months as one table; missing ones are skipped, none is an error."""
    found = month_paths(spark, folder, months)
    for month in (m for m in months if not found[m]):
        print(f"Warning: no transactions for {month} in {folder}")
    paths = [f"{folder.rstrip('/')}/transactions_{m}.csv" for m in months if found[m]]
    if not paths:
        raise ValueError("No transaction files found")
    return read_bronze(spark, paths)


def _typed(bronze: DataFrame) -> dict[str, Column]:
    fields = schema.TRANSACTIONS.fields
    return {
        f.name: F.col(f.name).try_cast(f.dataType) for f in fields if f.name in bronze.columns
    }


def silver(bronze: DataFrame) -> DataFrame:
    """Bronze text as typed columns; rows without a usable key or bet are left out."""
    typed = bronze.select(*[c.alias(name) for name, c in _typed(bronze).items()])
    return typed.where(_usable())


def rejects(bronze: DataFrame) -> DataFrame:
    """The bronze rows ``silver`` leaves out, unchanged."""
    typed = _typed(bronze)
    flags = [typed[c].isNull() for c in schema.REQUIRED]
    bad = flags[0]
    for flag in flags[1:]:
        bad = bad | flag
    return bronze.where(bad)


def _usable() -> Column:
    ok = F.lit(True)
    for c in schema.REQUIRED:
        ok = ok & F.col(c).isNotNull()
    return ok


# Bet times keep their microseconds; ties between bets would change streaks.
_CSV = {"header": True, "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A result as csv part files with a header."""
    df.write.mode(mode).options(**_CSV).csv(path)


def write_months(tx: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One folder ``transactions_month=yyyy-MM`` per month of play.

    All columns of the bet log's contract are written, in its order; those the
    table lacks stay empty.  Rows are grouped by month and a stable spread over 16 files first, so a
    month is neither one huge file nor thousands of tiny ones.
    """
    ordered = [
        F.col(c) if c in tx.columns else F.lit(None).cast("string").alias(c)
        for c in schema.BRONZE_COLUMNS
    ]
    keyed = tx.select(*ordered).withColumn("transactions_month", F.date_format("timestamp", "yyyy-MM"))
    spread = F.pmod(F.xxhash64("transaction_id"), F.lit(16))
    (
        keyed.repartition("transactions_month", spread)
        .write.mode(mode)
        .partitionBy("transactions_month")
        .options(**_CSV)
        .csv(path)
    )


def run_statistics(tx: DataFrame, churned: DataFrame, segments: DataFrame) -> DataFrame:
    """Totals of a run in one row; ``churned`` is a summary with ``is_churned``."""
    per_segment = (
        churned.where("is_churned")
        .join(segments.select("player_id", "player_segment"), "player_id")
        .groupBy("player_segment")
        .agg(F.count("*").alias("n"))
    )
    # At most one entry per segment.
    by_segment = per_segment.agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("player_segment", "n"))))
    ).scalar()
    players = churned.agg(
        F.count("*").alias("total_players"), F.count_if("is_churned").alias("total_churned")
    ).select(F.struct("*")).scalar()
    totals = tx.agg(
        F.count("*").alias("total_transactions"),
        F.sum("bet_amount").cast("double").alias("total_wagered"),
        F.sum(-F.col("net_result")).cast("double").alias("gross_gaming_revenue"),
    ).withColumn("_players", players)
    return totals.select(
        F.col("_players.total_players").alias("total_players"),
        "total_transactions",
        "total_wagered",
        "gross_gaming_revenue",
        F.col("_players.total_churned").alias("total_churned"),
        ratio("_players.total_churned", "_players.total_players").alias("churn_rate"),
        by_segment.alias("churn_by_segment"),
    )


def write_statistics(stats: DataFrame, path: str) -> None:
    """The statistics row as json."""
    stats.coalesce(1).write.mode("overwrite").json(path)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """A few rows (the feature itself is a preview)."""
    return df.limit(n)


def row_counts(**tables: DataFrame) -> DataFrame:
    """The number of rows per table."""
    parts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def read_daily(spark: SparkSession, path: str) -> DataFrame | None:
    """A daily table exported as csv, dates parsed; ``None`` if there is none.

    Columns are found by name, so operators can fall back where one is missing.
    """
    try:
        names = spark.read.option("header", True).csv(path).columns
    except AnalysisException:
        return None
    text = {"date": "date", "game_id": "string", "game_type": "string", "volatility": "string"}
    kinds = ", ".join(f"`{c}` {text.get(c, 'double')}" for c in names)
    return spark.read.schema(kinds).option("header", True).csv(path)

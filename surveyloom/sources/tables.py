"""Survey sources and result sinks."""

from pyspark.sql import DataFrame, SparkSession

ALWAYS_WRITTEN = ("variable_map", "cleaned_data")


def read_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Questionnaire export, UTF-8 with or without BOM; the header row holds the questions.

    All columns arrive as text; cleaning decides the types. ``multi_line`` allows line breaks in
    quoted cells but reads a file in one task, so switch it off for large plain files.
    """
    return spark.read.csv(path, header=True, multiLine=multi_line, encoding="UTF-8", inferSchema=False, escape='"')


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores where the source is one wave of tasks or less and has fewer files than cores.

    A file with one row group is a single task however many splits it has. Larger sources are
    never shuffled here.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    small = df.rdd.getNumPartitions() <= cores and len(df.inputFiles()) < cores
    return df.repartition(cores) if small else df


def read_survey(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """CSV or Parquet. Give ``multi_line`` for files with line breaks in quoted cells: those are read one task per file."""
    return read_csv(spark, path, multi_line) if path.lower().endswith(".csv") else read_parquet(spark, path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True, encoding="UTF-8", escape='"')


def write_tables(tables: dict[str, DataFrame], directory: str, format: str = "parquet") -> list[str]:
    """One directory per non-empty result table; returns the names written."""
    written = []
    for name, df in tables.items():
        if name not in ALWAYS_WRITTEN and df.isEmpty():
            continue
        path = f"{directory.rstrip('/')}/{name}"
        write_csv(df, path) if format == "csv" else df.write.mode("overwrite").parquet(path)
        written.append(name)
    return written

"""Raw CSV input and CSV export."""

from __future__ import annotations

import csv
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldspark.sources.schemas import RAW_COLUMNS
from fieldspark.sources.tables import Warehouse, balanced, hadoop_path


#: Files whose headers the driver reads at the same time.
HEADERS_AT_ONCE = 32


def _headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files of a path (a file or a folder) by their header. One line of each file is read."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    root = jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(conf)
    if not system.exists(root):
        raise FileNotFoundError(path)
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    listed, files = system.listFiles(root, True), []
    while listed.hasNext():
        status = listed.next()
        if status.getLen() and not status.getPath().getName().startswith(("_", ".")):
            files.append(status.getPath())

    def header(file) -> tuple[str, ...]:
        stream = system.open(file)
        try:
            codec = codecs.getCodec(file)
            source = codec.createInputStream(stream) if codec else stream
            line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(source, "UTF-8")).readLine() or ""
        finally:
            stream.close()
        return tuple(name.strip() for name in next(csv.reader([line.removeprefix("\ufeff")]), []))

    found: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(max_workers=HEADERS_AT_ONCE) as pool:
        for file, names in zip(files, pool.map(header, files)):
            found.setdefault(names, []).append(file.toString())
    return found


_CORRUPT = "_corrupt_line"


def _parsed(
    spark: SparkSession, folder: str, table: str, multi_line: bool, mode: str, add: Callable[[DataFrame], dict[str, Column]]
) -> DataFrame:
    """The rows of a raw table, columns matched by the header of each file, with columns added to them."""
    wanted = RAW_COLUMNS[table]
    parts = []
    for names, files in sorted(_headers(spark, f"{folder.rstrip('/')}/raw_{table}.csv").items()):
        missing = [c for c in wanted if names.count(c) != 1]
        if missing:
            raise ValueError(f"{files[0]}: missing or repeated columns {missing}")
        fields = [T.StructField(n or f"_{i}", T.StringType()) for i, n in enumerate(names)]
        if mode == "PERMISSIVE":
            fields.append(T.StructField(_CORRUPT, T.StringType()))
        df = (
            spark.read.schema(T.StructType(fields))
            .option("header", True)
            .option("enforceSchema", False)
            .option("escape", '"')
            .option("mode", mode)
            .option("columnNameOfCorruptRecord", _CORRUPT)
            .option("columnPruning", mode != "PERMISSIVE")  # whole lines are judged, whatever is read of them
            .option("multiLine", multi_line)
            .csv(files)
        )
        more = add(df)
        parts.append(df.select(*[F.col(c) for c in wanted], *[c.alias(n) for n, c in more.items()]))
    if not parts:
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in wanted]))
    return reduce(DataFrame.unionByName, parts)


def read_raw(
    spark: SparkSession, folder: str, table: str, multi_line: bool = False, min_tasks: int | None = None
) -> DataFrame:
    """One raw table as strings, from ``raw_<table>.csv`` (a file or a folder of files).

    Columns are matched by the header name of each file, whatever their order; further columns are
    passed over, a missing or repeated one is an error. An empty field is null; types are never
    inferred. Quoted line breaks need ``multi_line``, which stops Spark from splitting large files.
    ``min_tasks`` spreads the rows of files that cannot be split. A line with too few or too many fields
    stops the read; ``read_with_quarantine`` goes on.
    """
    return balanced(_parsed(spark, folder, table, multi_line, "FAILFAST", lambda df: {}), min_tasks)


class TooManyMalformed(Exception):
    """Raised when more lines of a raw table are malformed than may be."""


def read_with_quarantine(
    house: Warehouse, folder: str, table: str, max_share: float = 0.01, multi_line: bool = False, min_tasks: int | None = None
) -> DataFrame:
    """A raw table without its malformed lines, which are kept as ``quarantine/raw_<table>``: the file,
    the line as it is, the number of its fields, what is wrong, and its first column if it was read. Files are
    parsed once, into ``quarantine/parsed_<table>``. ``max_share`` is the share of lines
    that may be malformed; with more the read fails once they are kept, so they can be looked at."""
    spark = house.spark

    def judged(df: DataFrame) -> dict[str, Column]:
        # a field is quoted text, with doubled quotes inside, or anything without a comma
        fields = F.size(F.regexp_extract_all(F.col(_CORRUPT), F.lit('(?:^|,)("(?:[^"]|"")*"|[^,]*)'), F.lit(1)))
        wanted = len(df.columns) - 1
        reason = F.when(fields < wanted, "too few fields").when(fields > wanted, "too many fields").otherwise("unreadable")
        return {
            _CORRUPT: F.col(_CORRUPT), "_file": F.input_file_name(),
            "_fields": fields, "_reason": F.when(F.col(_CORRUPT).isNotNull(), reason),
        }

    rows = _parsed(spark, folder, table, multi_line, "PERMISSIVE", judged)
    if _CORRUPT not in rows.columns:
        return rows
    rows = house.write("quarantine", f"parsed_{table}", rows)
    bad = rows.where(F.col(_CORRUPT).isNotNull()).select(
        F.col("_file").alias("file"), F.col(_CORRUPT).alias("line"), F.col("_fields").alias("fields"), F.col("_reason").alias("reason"),
        F.col(RAW_COLUMNS[table][0]).alias("first_field"),
    )
    kept = house.write("quarantine", f"raw_{table}", bad)
    malformed, lines = kept.count(), rows.count()
    if malformed > max_share * lines:
        raise TooManyMalformed(f"raw_{table}: {malformed} of {lines} lines are malformed, see quarantine/raw_{table}")
    return balanced(rows.where(F.col(_CORRUPT).isNull()).select(*RAW_COLUMNS[table]), min_tasks)


def _csv(df: DataFrame, path: str) -> None:
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("dateFormat", "yyyy-MM-dd")
        .csv(path)
    )


def export_csv(df: DataFrame, path: str) -> None:
    """Write a table for BI tools: part files with a header, ISO dates, empty nulls."""
    _csv(df, path)


def export_one_csv(df: DataFrame, path: str) -> None:
    """The same as a single file ``path``, for tools that read one. Its rows are sorted by all columns and
    go through one task, so it suits marts that such a tool can hold; others are for ``export_csv``."""
    spark = df.sparkSession
    beside = f"{path}-{uuid.uuid4().hex}"
    _csv(df.coalesce(1).sortWithinPartitions(*df.columns), beside)
    folder, system = hadoop_path(spark, beside)
    parts = [s.getPath() for s in system.listStatus(folder) if s.getPath().getName().startswith("part-")]
    target = hadoop_path(spark, path)[0]
    system.delete(target, True)
    if not parts or not system.rename(parts[0], target):
        raise OSError(f"could not write {path}")
    system.delete(folder, True)

"""Parquet and CSV inputs. Paths are URIs of any file system Spark is set up for."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tripmetrics.operators.conform import conform, union_all
from tripmetrics.schemas import STANDARD, ZONES


def month_paths(template: str, year: int, last_month: int) -> list[str]:
    """Paths of months 1 to ``last_month``.

    The template names ``year`` and ``month``: ``s3a://raw/{year}/{year}-{month:02d}.parquet``.
    """
    return [template.format(year=year, month=month) for month in range(1, last_month + 1)]


def read_months(
    spark: SparkSession, paths: list[str], schema: StructType = STANDARD
) -> DataFrame:
    """All rows of all files at or below ``paths``, conformed to ``schema``.

    Types that drift between files cannot be merged while reading (an int column does not
    read as bigint data), so files are grouped by layout: one scan per layout, however many
    files there are, and the casts come after it. The footer of every file counts, so a column
    that only some files of a folder have is read from those. Partition folders are only
    folders here.
    """
    return union_all(
        [
            conform(spark.read.schema(found).parquet(*members), schema)
            for found, members in layouts(spark, data_files(spark, paths))
        ]
    )


def data_files(spark: SparkSession, paths: list[str]) -> list[str]:
    """All files at or below the paths, sorted; none is an error."""
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(list(dict.fromkeys(paths)))
        .inputFiles()
    )
    files = sorted(unquote(file) for file in found)  # they come as encoded URIs
    if not files:
        raise ValueError(f"no files at {paths}")
    return files


_CONFLICTS = ("CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE")
#: Files whose footers are told apart one by one; longer stretches are first tried as one layout.
STRETCH = 2048
_FOOTERS_AT_ONCE = 32


def layouts(
    spark: SparkSession, files: list[str], stretch: int = STRETCH
) -> list[tuple[StructType, list[str]]]:
    """Groups of files whose schemas merge, with the merged schema.

    Of a stretch of at most ``stretch`` files, the footers are read by threads of the driver, and
    files with equal ones are one layout; Spark infers a schema once a layout. Files that alternate
    between layouts cost no more than others. A longer stretch is read as one if its footers merge,
    which one distributed job over all of them finds out, and halved if they do not.
    """
    groups: list[tuple[StructType, list[str]]] = []
    waiting = [files]
    while waiting:
        part = waiting.pop()
        if len(part) <= stretch:
            for members in _by_footer(spark, part):
                _add(groups, spark.read.parquet(members[0]).schema, members)
            continue
        found = _all_footers(spark, part)
        if found is None:
            middle = len(part) // 2
            waiting += [part[middle:], part[:middle]]
        else:
            _add(groups, found, part)
    return groups


def _add(
    groups: list[tuple[StructType, list[str]]], schema: StructType, members: list[str]
) -> None:
    for number, (known, others) in enumerate(groups):
        merged = _merged(known, schema)
        if merged is not None:
            groups[number] = (merged, others + members)
            return
    groups.append((schema, members))


def _by_footer(spark: SparkSession, files: list[str]) -> list[list[str]]:
    """The files in groups of equal footer schemas, in the order of their first files."""
    jvm = spark.sparkContext._jvm
    settings = spark._jsparkSession.sessionState().newHadoopConf()

    def footer(file: str) -> str:
        place = jvm.org.apache.hadoop.fs.Path(file)
        opened = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(place, settings)
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(opened)
        try:
            return reader.getFileMetaData().getSchema().toString()
        finally:
            reader.close()

    groups: dict[str, list[str]] = {}
    with ThreadPoolExecutor(_FOOTERS_AT_ONCE) as threads:
        for file, found in zip(files, threads.map(footer, files)):
            groups.setdefault(found, []).append(file)
    return list(groups.values())


def _all_footers(spark: SparkSession, files: list[str]) -> StructType | None:
    """The merged schema of all files, or None if they do not merge."""
    try:
        return spark.read.option("mergeSchema", True).parquet(*files).schema
    except (PySparkException, Py4JJavaError) as error:  # raised on the driver, or in a task
        if any(conflict in str(error) for conflict in _CONFLICTS):
            return None
        raise


def _merged(one: StructType, other: StructType) -> StructType | None:
    """The columns of both, or None if a column differs in type."""
    fields = {field.name.lower(): field for field in one}
    for field in other:
        if fields.setdefault(field.name.lower(), field).dataType != field.dataType:
            return None
    return StructType(list(fields.values()))


def load_year(spark: SparkSession, template: str, year: int, last_month: int) -> DataFrame:
    """One year of monthly files, conformed."""
    return read_months(spark, month_paths(template, year, last_month))


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A folder of parquet files whose schemas merge.

    With ``schema`` no footer is opened and columns kept in folder names get their declared
    types. Without it all footers are read, in one distributed job, so a column that only some
    files have is there; types of folder columns are guessed from the names. Files whose types
    differ are an error here, and a case for ``read_months``.
    """
    if schema is None:
        return spark.read.option("mergeSchema", True).parquet(path)
    return spark.read.schema(schema).parquet(path)


def read_staged(spark: SparkSession, path: str) -> DataFrame:
    """The staged table; its schema is known, so no footer is opened for it."""
    return spark.read.schema(STANDARD).parquet(path)


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """The zone dimension from CSV with a header. ``N/A`` is text in it, not null.

    The schema is declared, so the file is not read twice, and the header has to match it. A
    value that does not have its column's type is an error, not a null key.
    """
    strict = {"header": True, "enforceSchema": False, "mode": "FAILFAST"}
    return spark.read.schema(ZONES).options(**strict).csv(path)

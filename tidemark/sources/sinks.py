"""Append and reload of catalog tables.

What replaces a table or is added to it is first written whole to a folder of its own;
one call to the catalog then makes it visible. A failure before that call changes
nothing, and readers see the rows before or after it.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.sources.files import Files

BATCH = "batch"  # partition column that names the load a row came with
_RELOAD = re.compile(r"__reload-[0-9a-f]{32}\Z")
_REPLACED = "tidemark.replaced"  # table property: the folder before the last reload


def is_empty(df: DataFrame) -> bool:
    """No row at all; reads one row at most."""
    return df.limit(1).count() == 0


def ensure_table(
    spark: SparkSession,
    name: str,
    schema: StructType,
    partition_by: Sequence[str] = (),
    location: str | None = None,
) -> None:
    """Create a parquet table unless it exists, in a given folder if asked."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    split = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{split}{place}")


def fill_columns(df: DataFrame, schema: StructType) -> DataFrame:
    """The schema's columns in order; those missing from ``df`` are NULL."""
    unknown = set(df.columns) - set(schema.names)
    if unknown:
        raise ValueError(f"not a column of the sink: {sorted(unknown)}")
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def append_rows(df: DataFrame, sink: str) -> None:
    """Append to a table; columns that ``df`` does not name become NULL."""
    schema = df.sparkSession.table(sink).schema
    fill_columns(df, schema).write.insertInto(sink)


def ensure_batch_table(spark: SparkSession, name: str, schema: StructType, location: str | None = None) -> None:
    """Create a table for :func:`append_once` unless it exists: the schema and the load's name."""
    if BATCH in schema.names:
        raise ValueError(f"{BATCH} names the load of a row")
    ensure_table(spark, name, StructType([*schema.fields]).add(BATCH, "string"), [BATCH], location)


def append_once(df: DataFrame, sink: str, batch: str) -> bool:
    """Append the rows of one load, unless a load of this name is there; tells if it was added.

    The rows go to a folder of their own, which becomes the table's partition of that name
    in one call. Of several writers of one load one succeeds. Repeating a load, or a job
    that died at any point, therefore leaves every row once.
    """
    spark = df.sparkSession
    where = f"{BATCH} = {_text(batch)}"
    if spark.sql(f"SHOW PARTITIONS {sink} PARTITION ({where})").count():
        return False
    schema = spark.table(sink).schema
    rows = fill_columns(df, StructType([f for f in schema.fields if f.name != BATCH]))
    details = _details(spark, sink)
    folder = f"{details['Location']}/load-{uuid.uuid4().hex}"
    try:
        rows.write.format(details["Provider"]).save(folder)
        spark.sql(f"ALTER TABLE {sink} ADD PARTITION ({where}) LOCATION {_text(folder)}")
    except Exception as failure:
        Files(spark).remove(folder)
        if isinstance(failure, AnalysisException) and failure.getCondition() == "PARTITIONS_ALREADY_EXIST":
            return False  # another writer of this load was faster
        raise
    return True


def _text(value: str) -> str:
    """A string literal of Spark SQL."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _details(spark: SparkSession, name: str) -> dict[str, str]:
    """Location, provider and so on, as the catalog has them."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    at = next(i for i, r in enumerate(rows) if r.col_name == "# Detailed Table Information")
    return {r.col_name: r.data_type for r in rows[at + 1 :]}


def truncate_reload(df: DataFrame, sink: str, schema: StructType | None = None) -> None:
    """Replace the rows of a table, creating it first when a schema is given.

    The new rows are written to a fresh folder beside the table's, and the table is
    switched to it; if that fails, the old rows stay. ``df`` may read the table itself.
    The replaced folder stays for readers under way until the next reload. The table is
    read by its name; its first folder, which somebody else made, is never removed.
    """
    spark = df.sparkSession
    if schema is not None:
        ensure_table(spark, sink, schema)
    if any(c.isPartition for c in spark.catalog.listColumns(sink)):
        raise ValueError(f"{sink} has partitions: they have folders of their own and cannot be switched in one call")
    details, files = _details(spark, sink), Files(spark)
    old = details["Location"]
    fresh = f"{_RELOAD.sub('', old)}__reload-{uuid.uuid4().hex}"
    try:
        fill_columns(df, spark.table(sink).schema).write.format(details["Provider"]).save(fresh)
        spark.sql(f"ALTER TABLE {sink} SET LOCATION {_text(fresh)}")
    except Exception:
        files.remove(fresh)
        raise
    before = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {sink}").collect()}.get(_REPLACED)
    spark.sql(f"ALTER TABLE {sink} SET TBLPROPERTIES ('{_REPLACED}' = {_text(old)})")
    if before is not None and _RELOAD.search(before):
        files.remove(before)

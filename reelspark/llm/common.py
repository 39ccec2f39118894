"""What the operators share: table access, scratch tables in the shared folder, word splitting."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query over the given tables; `sql` is its DuckDB oracle."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


#: Rows that Spark hands to Python at once. Texts are long: ten thousand, the default, can be hundreds of MB in a worker.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Hand rows to Python in small batches, unless the session has a number of its own."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder below `spark.checkpoint.dir`, which driver and executors share.

    Where the setting is absent, a local session uses a temporary folder and any other the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        local = (spark.sparkContext.master or "").split("[")[0] == "local"
        base = f"file://{tempfile.gettempdir()}/reelspark" if local else spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with as many underscores behind it as make it no column of `df`."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def collect_garbage(spark: SparkSession) -> None:
    """Spark drops shuffle files when the driver has collected their handles, so this asks for it rather than let the disks
    fill up until that happens by itself. The handles of the job just ended may stay until it is asked again."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def written(df: DataFrame) -> DataFrame:
    """The rows, written to the shared folder and read back, so that a lost executor costs no earlier work.

    What the rows were shuffled from is of no more use then."""
    small_batches(df.sparkSession)
    path = f"{shared_dir(df.sparkSession)}/rows.parquet"
    df.write.parquet(path)
    collect_garbage(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes A-Z in lower case; the ASCII bytes that separate words become a space. Bytes above 0x7F stay.
SPACE_WORDS = bytes(range(256)).lower()
ALNUM_WORDS = bytes(
    c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in SPACE_WORDS
)


def space_words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words `[^\\x20\\x09-\\x0D]+` as UTF-8 bytes."""
    return (text or "").encode("utf-8", "surrogatepass").translate(SPACE_WORDS).split()


def alnum_words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` as UTF-8 bytes."""
    return (text or "").encode("utf-8", "surrogatepass").translate(ALNUM_WORDS).split()

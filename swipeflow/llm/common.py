"""Session helpers of the operators: tables, shared intermediate tables, shipping the code."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from swipeflow.session import ensure_checkpoint_dir

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the executors, once per application, so
    that tasks can import it wherever the driver found it."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="swipeflow-")), "swipeflow.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: cuts the
    lineage and survives the loss of any executor."""
    ship_package(df.sparkSession)
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def smallest_hashes(rows: DataFrame, h: Column, id_col: str, n: int, count: int) -> DataFrame:
    """The ``n`` rows with the smallest 64-bit hash ``h`` of their id, of ``count`` rows. A threshold drops most of the
    others at the scan, so that about ``n`` rows in all, not ``n`` of every partition, meet to be ranked."""
    # ten standard deviations and more above what is needed
    wanted = n + 10 * n**0.5 + 100
    if wanted < count:
        rows = rows.filter(h < int(-(2.0**63) + 2.0**64 * (wanted / count)))
    return rows.orderBy(h, id_col).limit(n)


#: Row keys (about 64 bytes with overhead) that ``without`` sends to every task; more are joined by a shuffle.
BROADCAST_KEYS = 500_000


def row_key(id_col: str, text_col: str) -> Column:
    """128-bit digest of a row's id and text: equal for copies of a row only; null for a null text."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), F.col(text_col).cast("string")).cast("binary")))


def without(docs: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of ``docs`` whose ``key`` is not in ``keys`` (one column); rows with a null key stay.

    The keys are counted first, and broadcast only up to ``BROADCAST_KEYS`` of them.
    """
    keys = settle(keys.toDF(key).filter(F.col(key).isNotNull()).distinct())
    side = F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys
    return docs.join(side, key, "left_anti").select(*docs.columns)


def numbered(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, list[Column]]:
    """``docs`` with neutral column names and the row's ``_key``, and the columns that give the names back."""
    names = {f"_c{i}": c for i, c in enumerate(docs.columns)}
    own = {c: k for k, c in names.items()}
    keyed = docs.toDF(*names)
    return keyed.withColumn("_key", row_key(own[id_col], own[text_col])), [F.col(k).alias(c) for k, c in names.items()]

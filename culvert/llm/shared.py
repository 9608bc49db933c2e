"""Tables, folders and word rules that the operators of this subpackage share."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from culvert.session import work_dir

#: Runs of anything but blank, tab, line feed, vertical tab, form feed and return.
BLANKS = r"[\x20\x09-\x0D]+"


_ROOT = Path(__file__).resolve().parents[2]
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Gives the executors this package, unless they find it on their path: operators in
    Python are functions of its modules. Once per application."""
    places = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    app = spark.sparkContext.applicationId
    if app in _shipped or str(_ROOT) in [os.path.realpath(p) for p in places if p]:
        return
    path = Path(tempfile.mkdtemp(prefix="package-")) / f"{_ROOT.name}.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for source in sorted((_ROOT / "culvert").rglob("*.py")):
            archive.write(source, source.relative_to(_ROOT))
    spark.sparkContext.addPyFile(str(path))
    _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, group_bytes: int | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back: the lineage ends there.

    ``group_bytes``: of a row group, for rows that hold much each. A task holds a row group
    when it writes and when it reads; sizes are looked at from the first row on.
    """
    path = work_dir(df.sparkSession, name)
    writer = df.write
    if group_bytes:
        writer = writer.option("parquet.block.size", group_bytes).option("parquet.page.size.row.check.min", 1)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def words_of(text: str | Column) -> Column:
    """The words between blanks; of a null text, none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def fresh(name: str) -> str:
    """A column name that clashes with none in the caller's table."""
    return f"__{name}_{uuid.uuid4().hex[:8]}"


def remainder(doc_id: str | Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null for a null id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string").cast("binary")) % divisor

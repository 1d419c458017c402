"""How fetched records enter the sources table: as new ones only, or as versions of those that are there."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.tasks import new_versions


def only_new(have: DataFrame, fetched: DataFrame) -> DataFrame:
    """Fetched records whose identifier isn't there yet; a repeated attempt adds none."""
    return fetched.join(have.select("identifier").distinct(), "identifier", "left_anti").withColumn("parent_source_id", F.lit(None).cast(have.schema["source_id"].dataType))


#: Ways to persist by name: the normal one, and that of a refresh, which keeps what changed as a version with its parent.
MODES: dict[str, Callable[[DataFrame, DataFrame], DataFrame]] = {"normal": only_new, "refresh": new_versions}

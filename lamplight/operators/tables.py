"""Keyed changes to tables without a row-level table format: each gives the table's new content, to be staged and swapped in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamplight.functions.text import like_literal


def replace_by_key(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """old without the keys of new, and new: applied twice it's as once. Columns that one side lacks are null there."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def delete_by_key(old: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """old without the given keys; rows whose key is null stay."""
    if key not in old.columns:
        raise ValueError(f"no column {key}")
    return old.join(keys.select(key).distinct(), key, "left_anti")


def delete_containing(old: DataFrame, column: str, literal: str) -> DataFrame:
    """old without the rows whose column contains the literal; % and _ in it stand for themselves. Rows with null stay."""
    return old.where(~F.coalesce(F.col(column).like(f"%{like_literal(literal)}%"), F.lit(False)))


def add_nullable(df: DataFrame, column: str, kind: str) -> DataFrame:
    """df with a null column of that type, unless it's there."""
    return df if column in df.columns else df.withColumn(column, F.lit(None).cast(kind))


def replace_pending(queue: DataFrame, new: DataFrame, key: str = "catalog_id") -> DataFrame:
    """The queue without pending rows of new's keys, and new."""
    pending = queue.where("processed_at is null").join(new.select(key).distinct(), key, "left_anti")
    return queue.where("processed_at is not null").unionByName(pending).unionByName(new, allowMissingColumns=True)

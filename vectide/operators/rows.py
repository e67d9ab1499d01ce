"""Row-level operators: each takes a collection and returns its new state or the rows asked for."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectide.functions.predicates import fields_list, predicate
from vectide.sizing import broadcast_if_small
from vectide.sources.collections import assign_ids, in_partitions, names_list


# Rows that one task may hold to order a page.
TOP_ROWS = 100_000


def _comparable(df: DataFrame, name: str) -> Column:
    """The column in a form that can be hashed: entries of a map in the order of their keys."""
    value = F.col(f"`{name}`")
    return F.array_sort(F.map_entries(value)) if isinstance(df.schema[name].dataType, T.MapType) else value


def latest(batch: DataFrame, key: str, sequence: str | None = None) -> DataFrame:
    """The last row of each key; rows of a busy key are combined before the shuffle.

    A row without a sequence comes before all that have one. Rows of one sequence are
    ordered by a hash of their values, so a run on the same rows always keeps the same.
    """
    return batch.groupBy(key).agg(newest(batch, key, sequence).alias("_row")).select(key, "_row.*").select(*batch.columns)


def newest(batch: DataFrame, key: str, sequence: str | None = None) -> Column:
    """The other fields of the last row of a key, as an aggregate."""
    rest = [c for c in batch.columns if c != key]
    tie = F.xxhash64(*[_comparable(batch, c) for c in rest]).alias("tie")
    order = [F.col(sequence).isNotNull().alias("known"), F.col(sequence).alias("sequence")] if sequence else []
    return F.max_by(F.struct(*rest), F.struct(*order, tie))


def upsert(base: DataFrame, batch: DataFrame, key: str = "id", sequence: str | None = None) -> DataFrame:
    """Replace by key. Of a batch's rows with one key the one with the highest ``sequence`` counts.

    Without a sequence such rows are ordered by a hash of their values.
    """
    fresh = latest(batch, key, sequence).select(*base.columns)
    keys = broadcast_if_small(fresh.select(key), measured=batch.select(key))
    return base.join(keys, key, "left_anti").select(*base.columns).unionByName(fresh)


def delete_where(df: DataFrame, filter: str | Column, partition_names=None) -> DataFrame:
    """The rows that stay. A row for which the filter is NULL stays; an empty filter is refused."""
    if filter is None or (isinstance(filter, str) and not filter.strip()):
        raise ValueError("a filter is required: deleting all rows is refused")
    hit = F.coalesce(predicate(filter), F.lit(False))
    names = names_list(partition_names)
    if names:
        hit = hit & F.col("partition_name").isin(names)
    return df.where(~hit)


def delete_count(df: DataFrame, filter: str | Column) -> DataFrame:
    return df.agg(F.count_if(F.coalesce(predicate(filter), F.lit(False))).alias("delete_count"))


def id_frame(df: DataFrame, ids: str | Sequence | DataFrame, key: str) -> DataFrame:
    """Ids given as a JSON array, a list or a frame, as distinct keys; broadcast if they are few."""
    if isinstance(ids, DataFrame):
        rows = ids.select(F.col(ids.columns[0]).cast(df.schema[key].dataType).alias(key))
        return broadcast_if_small(rows.distinct(), measured=rows)
    values = json.loads(ids) if isinstance(ids, str) else list(ids)
    if not isinstance(values, list) or not values:
        raise ValueError("ids must be a non-empty JSON array")
    rows = df.sparkSession.createDataFrame([(str(v),) for v in values], "k string")
    # A parameter of this call, held by the driver already.
    return F.broadcast(rows.select(F.col("k").cast(df.schema[key].dataType).alias(key)).distinct())


def delete_ids(df: DataFrame, ids: str | Sequence | DataFrame, key: str = "id") -> DataFrame:
    return df.join(id_frame(df, ids, key), key, "left_anti").select(*df.columns)


def get(df: DataFrame, ids: str | Sequence | DataFrame, output_fields="*", key: str = "id") -> DataFrame:
    return df.join(id_frame(df, ids, key), key, "left_semi").select(*_columns(df, output_fields, key))


def _columns(df: DataFrame, output_fields, key: str) -> list[Column]:
    names = fields_list(output_fields, df.columns)
    if key not in names:
        names = [key, *names]
    return [F.col(n) for n in names]


def query(
    df: DataFrame,
    filter: str | Column | None = None,
    output_fields="*",
    limit: int = 100,
    offset: int = 0,
    partition_names=None,
    key: str = "id",
) -> DataFrame:
    """Filter, projection and limit, in the order of the key and then of the other fields asked for.

    A page among the first ``TOP_ROWS`` rows is a top-k of every task. A later one would make
    one task hold all rows before it, so rows are numbered slice by slice and the page is
    cut by number. A collection stored in order (``sources/ordered.py``) seeks any page.
    """
    if limit < 1 or offset < 0:
        raise ValueError("limit must be positive and offset must not be negative")
    rows = in_partitions(df, partition_names)
    rows = rows if filter is None or filter == "" else rows.where(predicate(filter))
    wanted = rows.select(*_columns(df, output_fields, key))
    order = [key, *[f.name for f in wanted.schema if f.name != key and not isinstance(f.dataType, T.MapType)]]
    if not offset or offset + limit <= TOP_ROWS:
        return wanted.orderBy(*order).offset(offset).limit(limit)
    place = F.col("_place")
    page = assign_ids(wanted, order, id_col="_place").where((place > offset) & (place <= offset + limit))
    return page.select(*wanted.columns).orderBy(*order)


def page_after(
    df: DataFrame, last=None, limit: int = 100, filter: str | Column | None = None, output_fields="*", key="id"
) -> DataFrame:
    """The page behind key ``last``: deep pages cost as little as the first."""
    rows = df if last is None else df.where(F.col(key) > F.lit(last))
    return query(rows, filter, output_fields, limit, key=key)

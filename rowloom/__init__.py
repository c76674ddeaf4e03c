"""Ordered dataset preparation on Spark DataFrames."""

from rowloom.frame import Frame, from_dataframe
from rowloom.operators.aggregates import count_rows, count_table, unique_values
from rowloom.operators.collect import iterate, to_data_list, to_list
from rowloom.operators.columns import flatten, map_column, remove_columns, rename_column, select_columns
from rowloom.operators.filters import filter_rows
from rowloom.operators.rows import (
    select_rows,
    shuffle,
    skip_rows,
    sort_rows,
    take_rows,
    take_shard,
    train_test_split,
)
from rowloom.sources.loader import concat, load
from rowloom.sources.splits import list_splits
from rowloom.streaming.drain import drain

__all__ = [
    "Frame",
    "concat",
    "count_rows",
    "count_table",
    "drain",
    "filter_rows",
    "flatten",
    "from_dataframe",
    "iterate",
    "list_splits",
    "load",
    "map_column",
    "remove_columns",
    "rename_column",
    "select_columns",
    "select_rows",
    "shuffle",
    "skip_rows",
    "sort_rows",
    "take_rows",
    "take_shard",
    "to_data_list",
    "to_list",
    "train_test_split",
    "unique_values",
]

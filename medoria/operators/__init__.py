"""Operators over whole DataFrames."""

from medoria.operators.advice import partition_advice, partition_column
from medoria.operators.dedup import keep_one
from medoria.operators.lookup import broadcastable, lookup
from medoria.operators.naming import unique_names
from medoria.operators.numbering import dense_number, number_within

__all__ = [
    "broadcastable",
    "dense_number",
    "keep_one",
    "lookup",
    "number_within",
    "partition_advice",
    "partition_column",
    "unique_names",
]

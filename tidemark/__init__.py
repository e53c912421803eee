"""tidemark: answers that arrive early and get better, on Spark.

Relational (TPC-H class) queries, online aggregation over a sequence of
input partitions, online sums with confidence bounds, forecasting of final
answers from running ones, and large total-order sorts with validation.
Everything is expressed as DataFrame / SQL operations so Catalyst plans it
and the work scales with the cluster.
"""

from tidemark.session import checkpoint_dir, get_spark
from tidemark.operators.online import Agg, Derived, OnlineSpec, final_snapshot, online_agg
from tidemark.operators.bounds import online_sum_ci
from tidemark.operators.forecast import forecast_cell, forecast_select, forecast_table
from tidemark.operators.sorting import total_sort, validate_sort, validate_sorted_files
from tidemark.sources.tpch import register_tables, tables

__all__ = ["get_spark", "checkpoint_dir", "Agg", "Derived", "OnlineSpec", "online_agg", "final_snapshot",
           "online_sum_ci", "forecast_cell", "forecast_select", "forecast_table", "total_sort",
           "validate_sort", "validate_sorted_files", "tables", "register_tables"]

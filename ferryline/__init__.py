"""Moving tables between warehouses and files with Spark DataFrames."""

from ferryline.errors import NotATableError, RejectBudgetExceeded, TransferError
from ferryline.functions.types import time_field
from ferryline.operators.decode import accepted, decode, rejected
from ferryline.operators.encode import encode
from ferryline.operators.slices import bounds, slice_df
from ferryline.operators.update import one_row_per_key, update_by_key, updated_by_key
from ferryline.options import Connection, LoadOptions, UnloadOptions
from ferryline.plans.jdbc_mode import export_dir, import_rows
from ferryline.plans.load import load, load_lines, load_records
from ferryline.plans.rewrite import recover, update_files
from ferryline.plans.unload import unload, unload_table
from ferryline.sinks.published import Published, publish
from ferryline.sinks.target import Directory
from ferryline.sources.jdbc import read_query, read_table
from ferryline.sources.table import Table
from ferryline.streaming.incremental import incremental, incremental_condition

__all__ = [
    "Connection", "Directory", "LoadOptions", "NotATableError", "Published",
    "RejectBudgetExceeded", "Table", "TransferError", "UnloadOptions", "accepted", "bounds", "decode", "encode",
    "export_dir", "import_rows", "incremental", "incremental_condition", "load",
    "load_lines", "load_records", "one_row_per_key", "publish", "read_query", "read_table",
    "recover", "rejected", "slice_df", "time_field", "unload", "unload_table", "update_by_key",
    "update_files", "updated_by_key",
]

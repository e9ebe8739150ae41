from trilode.sources.control import last_mark, write_mark
from trilode.sources.files import ensure_table, read_files, read_layer
from trilode.sources.lineage import with_lineage
from trilode.sources.queries import (
    Increment,
    late_rows,
    load_increment,
    load_query,
    plan_increment,
    read_increments,
    read_query,
)
from trilode.sources.samples import inline_rows, one_row, sales_rows, sales_sample

__all__ = [
    "Increment", "ensure_table", "inline_rows", "last_mark", "late_rows", "load_increment",
    "load_query", "one_row", "plan_increment", "read_files", "read_increments", "read_layer", "read_query", "sales_rows", "sales_sample",
    "with_lineage", "write_mark",
]

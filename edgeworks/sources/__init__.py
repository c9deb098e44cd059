"""Readers, generators and writers."""

from edgeworks.sources.appends import MatrixLog
from edgeworks.sources.generators import edges_for, matrix_for, random_edges, random_matrix
from edgeworks.sources.quarantine import quarantine_edges, quarantine_links
from edgeworks.sources.readers import (
    count_rows,
    read_edge_list,
    read_lines,
    read_matrix_csv,
    read_matrix_parquet,
    read_mtx_edges,
    read_scored_links,
    read_table,
    table_shape,
)
from edgeworks.sources.writers import (
    append_rows,
    write_csv,
    write_edges,
    write_lines,
    write_matrix_csv,
    write_parquet,
)

__all__ = [
    "MatrixLog",
    "append_rows",
    "count_rows",
    "edges_for",
    "matrix_for",
    "quarantine_edges",
    "quarantine_links",
    "random_edges",
    "random_matrix",
    "read_edge_list",
    "read_lines",
    "read_matrix_csv",
    "read_matrix_parquet",
    "read_mtx_edges",
    "read_scored_links",
    "read_table",
    "table_shape",
    "write_csv",
    "write_edges",
    "write_lines",
    "write_matrix_csv",
    "write_parquet",
]

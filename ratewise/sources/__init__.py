"""Readers: raw delimited text (S1-S5) and stored tables/documents."""

from .stores import first_rows, read_documents_defaulted, read_table_projected, select_all_limit
from .text import (
    parse_item_genres,
    parse_item_wide,
    parse_pipe_users,
    parse_ws_ratings,
    rejected_lines,
    scan_text_lines,
    write_text_lines,
)

__all__ = [
    "first_rows", "parse_item_genres", "parse_item_wide", "parse_pipe_users", "parse_ws_ratings",
    "read_documents_defaulted", "read_table_projected", "rejected_lines", "scan_text_lines",
    "select_all_limit", "write_text_lines",
]

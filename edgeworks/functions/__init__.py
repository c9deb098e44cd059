"""Column expressions shared by the operators."""

from edgeworks.functions.columns import (
    dot,
    edge_text,
    fields,
    format_vector,
    found_message,
    greatest_mean,
    hash60,
    other_end,
    parse_vector,
    scaled_int,
    tokens,
    uniform,
    uniform_below,
    vertex_part,
)

__all__ = [
    "dot",
    "edge_text",
    "fields",
    "format_vector",
    "found_message",
    "greatest_mean",
    "hash60",
    "other_end",
    "parse_vector",
    "scaled_int",
    "tokens",
    "uniform",
    "uniform_below",
    "vertex_part",
]

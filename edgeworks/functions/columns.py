"""Scalar column functions: text fields, vectors, hashes, messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\r\n\f"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text: Column | str) -> Column:
    """Pieces between single spaces; empty pieces and case are kept."""
    return F.split(_col(text), " ")


def fields(text: Column | str, sep: str = r"\s+") -> Column:
    """Fields of a line. The separator is a regular expression; for runs of
    white space the ends of the line are trimmed first."""
    text = _col(text)
    if sep == r"\s+":
        text = F.trim(text, F.lit(BLANKS))
    return F.split(text, sep)


def parse_vector(text: Column | str) -> Column:
    """``"[1, 2.5]"`` as ``array<double>``."""
    return F.from_json(_col(text), "array<double>")


def format_vector(vector: Column | str) -> Column:
    """An array as ``"[1, 2.5]"``, the form text and CSV files can hold."""
    return _col(vector).cast("string")


def dot(a: Column | str, b: Column | str) -> Column:
    """Inner product of two arrays of one length."""
    products = F.zip_with(_col(a), _col(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def hash60(seed: int | str | None, *cols: Column | str) -> Column:
    """A repeatable number in [0, 2^60) from a seed, if any, and columns.

    It depends only on the values, never on partitions or on the run, so a
    task that is run again gets the same answer. Taken from md5, which has the
    same hex digits in every engine.
    """
    return F.conv(F.substring(_digest(seed, *cols), 1, 15), 16, 10).cast("bigint")


def _digest(seed: int | str | None, *cols: Column | str) -> Column:
    prefix = [] if seed is None else [F.lit(str(seed))]
    return F.md5(F.concat_ws("|", *prefix, *[_col(c).cast("string") for c in cols]))


def uniform(seed: int | str, *cols: Column | str) -> Column:
    """A repeatable double in [0, 1) from a seed and columns."""
    return hash60(seed, *cols) / F.lit(float(2**60))


def uniform_below(p: float, seed: int | str, *cols: Column | str) -> Column:
    """``uniform(seed, *cols) < p``, told by the hex digits alone.

    The least number of 15 digits that is not below ``p`` is found first, with
    the rounding of a double; texts of digits are in the order of their numbers.
    """
    low, high = 0, 2**60
    while low < high:
        middle = (low + high) // 2
        if float(middle) / 2**60 < p:
            low = middle + 1
        else:
            high = middle
    return F.lit(True) if low == 2**60 else _digest(seed, *cols) < F.lit(f"{low:015x}")


def scaled_int(x: Column | str, scale: int) -> Column:
    """``x * scale`` without its fraction, as bigint."""
    return F.floor(_col(x) * F.lit(scale)).cast("bigint")


def vertex_part(vertex: Column | str, parts: int, seed: int | str = "part") -> Column:
    """Which of ``parts`` vertex parts an id of any type belongs to."""
    return F.pmod(hash60(seed, vertex), F.lit(parts)).cast("int")


def other_end(vertex: Column, src: Column | str = "src", dst: Column | str = "dst") -> Column:
    """The endpoint of an edge that is not ``vertex``."""
    return F.when(_col(src) == vertex, _col(dst)).otherwise(_col(src))


def greatest_mean(a: Column | str, b: Column | str) -> Column:
    """The larger of two means, a missing one counting as 0."""
    zero = F.lit(0.0)
    return F.greatest(F.coalesce(_col(a), zero), F.coalesce(_col(b), zero))


def edge_text(src: Column | str = "src", dst: Column | str = "dst", sep: str = " ") -> Column:
    """An edge as one line of text."""
    return F.concat_ws(sep, _col(src).cast("string"), _col(dst).cast("string"))


def found_message(vertex: Column, found: Column) -> Column:
    """The one-line report of a vertex lookup."""
    # Fixed wording of the report line.
    return F.concat(
        F.lit("User ID "),
        vertex.cast("string"),
        F.when(found, F.lit(" found in the dataset.")).otherwise(F.lit(" not found in the dataset.")),
    )

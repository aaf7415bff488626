"""Key/value text sinks: ``json(key) TAB json(value)`` lines in part files.

Each format is a function to a ``value STRING`` column of lines
(``*_lines``) and a writer.  Besides, every result is an ordinary DataFrame and
can be written with ``df.write.parquet`` / ``.csv``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def double_text(c: Column | str) -> Column:
    """The canonical text of a double: its shortest digits, as decimals for
    exponents from -4 to 15 (``0.0001``, ``123456789.0``), else with an
    exponent of two digits or more (``1e-05``, ``1.5e+16``).  This is how
    Python's ``json`` and SQL engines write it; the JVM's own text differs only
    in layout."""
    c = F.col(c) if isinstance(c, str) else c
    return _moved_point(c.cast("string"))


def _moved_point(java: Column) -> Column:
    """The canonical text from the JVM's; no regular expression runs."""
    unsigned = F.ltrim(java, F.lit("-"))
    sign = F.when(F.startswith(java, F.lit("-")), F.lit("-")).otherwise(F.lit(""))
    mantissa = F.substring_index(unsigned, "E", 1)
    short = F.when(F.endswith(mantissa, F.lit(".0")), F.substring_index(mantissa, ".", 1)).otherwise(mantissa)
    exponent = F.substring_index(java, "E", -1).try_cast("int")     # NULL, and not used, where there is none
    digits = F.replace(short, F.lit("."), F.lit(""))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)
    padded = F.rpad(digits, F.greatest(exponent + 2, F.length(digits)), "0")
    large = F.concat(F.substring(padded, F.lit(1), exponent + 1), F.lit("."), F.substring(padded, exponent + 2, F.length(padded)))
    power = F.concat(short, F.lit("e"), F.when(exponent < 0, F.lit("-")).otherwise(F.lit("+")),
                     F.lpad(F.abs(exponent).cast("string"), F.greatest(F.lit(2), F.length(F.abs(exponent).cast("string"))), "0"))
    moved = F.when((exponent >= -4) & (exponent < 0), small).when((exponent >= 0) & (exponent < 16), large).otherwise(power)
    return F.when(F.contains(java, F.lit("E")), F.concat(sign, moved)).otherwise(java)


def json_value(c: Column | str) -> Column:
    """JSON text of any scalar: ``to_json`` of a one-element array, brackets
    removed (``to_json`` does not take a bare scalar)."""
    c = F.col(c) if isinstance(c, str) else c
    text = F.to_json(F.array(c))
    return text.substr(F.lit(2), F.length(text) - 2)


def kv_lines(df: DataFrame, key: Column | str, value: Column) -> DataFrame:
    """``value STRING`` lines: JSON key, tab, already-rendered value."""
    return df.select(F.concat_ws("\t", json_value(key), value).alias("value"))


def probability_lines(df: DataFrame, key: str = "bigram", value: str = "probability") -> DataFrame:
    """``json(key) TAB json(value)`` lines (bigram output:
    ``"word-next"\t0.25``)."""
    if not isinstance(df.schema[value].dataType, DoubleType):
        return kv_lines(df, key, json_value(value))
    # The text of a double is used several times below: a column of its own
    # makes Spark compute it once.
    texts = df.select(F.col(key).alias("_key"), F.col(value).cast("string").alias("_java"))
    return kv_lines(texts, "_key", _moved_point(F.col("_java")))


def adjacency_lines(df: DataFrame) -> DataFrame:
    """Lines ``json(node) TAB {"out_links": [...], "page_rank": x}``; ids and
    links as JSON strings, as the text protocol carries them.

    ``page_rank`` is always written.  Of a hub that
    :func:`bigraph.operators.graph.adjacency` has cut into parts each part is
    a line with its ``part`` and ``parts`` and the rank ``null`` beyond part 0
    (one line could not be bounded); every other node has one line of just the
    two fields.
    """
    links = F.to_json(F.transform("out_links", lambda x: x.cast("string")))
    fields = [F.lit('{"out_links":'), links, F.lit(',"page_rank":'), F.coalesce(double_text("page_rank"), F.lit("null"))]
    if {"part", "parts"} <= set(df.columns):
        place = F.concat(F.lit(',"part":'), F.col("part").cast("string"), F.lit(',"parts":'), F.col("parts").cast("string"))
        fields.append(F.when(F.col("parts") > 1, place).otherwise(F.lit("")))
    return kv_lines(df, F.col("node").cast("string"), F.concat(*fields, F.lit("}")))


def rank_lines(df: DataFrame) -> DataFrame:
    """Lines ``page_rank TAB json(node)`` (rank as the leading key)."""
    return df.select(F.concat_ws("\t", double_text("page_rank"),
                                 json_value(F.col("node").cast("string"))).alias("value"))


def write_kv(df: DataFrame, path: str, key: str, value: str, mode: str = "error") -> None:
    """Write :func:`probability_lines`."""
    probability_lines(df, key, value).write.mode(mode).text(path)


def write_adjacency_kv(df: DataFrame, path: str, mode: str = "error") -> None:
    """Write :func:`adjacency_lines`."""
    adjacency_lines(df).write.mode(mode).text(path)


def write_ranks_kv(df: DataFrame, path: str, mode: str = "error") -> None:
    """Write :func:`rank_lines`."""
    rank_lines(df).write.mode(mode).text(path)

"""Samples of metrics (name, labels, value) in the text format that scrapers read, and back.

A line is `name value` or `name{label="text",...} value`, a value then maybe followed by a time in milliseconds; lines that
begin with # say what kind a metric is of, or are comments. In a label's text, backslashes, quotes and line ends are escaped
by a backslash. Labels are written in the order of their names. Lines that can't be read give no sample, as do empty ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NAME = r"[a-zA-Z_:][a-zA-Z0-9_:]*"
_PAIR = r'[a-zA-Z_][a-zA-Z0-9_]*="(?:[^"\\]|\\.)*"'
_LINE = rf"^({_NAME})(?:\{{((?:{_PAIR},?\s*)*)\}})?\s+([^\s]+)(?:\s+(-?[0-9]+))?\s*$"
SAMPLES = "name string, labels map<string,string>, value double"


def _escaped(text: Column) -> Column:
    for plain, written in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n")):
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def _plain(text: Column) -> Column:
    # what stands between escaped backslashes has only the other escapes
    parts = F.transform(F.split(text, r"\\\\"), lambda t: F.replace(F.replace(t, F.lit("\\n"), F.lit("\n")), F.lit('\\"'), F.lit('"')))
    return F.array_join(parts, "\\")


def _number(value: Column) -> Column:
    special = F.when(value == float("inf"), "+Inf").when(value == float("-inf"), "-Inf").when(F.isnan(value), "NaN")
    whole = (value == F.floor(value)) & (F.abs(value) < 2**53)
    return special.when(whole, value.cast("bigint").cast("string")).otherwise(value.cast("string"))


def labels_text(labels: Column) -> Column:
    """A map of labels as {a="x",b="y"} in the order of their names; nothing for none."""
    pairs = F.transform(F.array_sort(F.map_entries(labels)), lambda e: F.concat(e["key"], F.lit('="'), _escaped(e["value"]), F.lit('"')))
    return F.when(F.size(pairs) > 0, F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))).otherwise("")


def written(samples: DataFrame) -> DataFrame:
    """value: a line for each sample."""
    return samples.select(F.concat("name", labels_text(F.col("labels")), F.lit(" "), _number(F.col("value"))).alias("value"))


def read(lines: DataFrame) -> DataFrame:
    """name, labels and value of the samples in lines (value)."""
    part = lambda i: F.regexp_extract("value", _LINE, i)
    found = lines.where(F.regexp_like("value", F.lit(_LINE))).select(part(1).alias("name"), F.regexp_extract_all(part(2), F.lit(_PAIR), F.lit(0)).alias("pairs"), part(3).alias("text"))
    at = lambda p: F.position(F.lit("="), p)
    pairs = F.transform("pairs", lambda p: F.struct(F.substring_index(p, "=", 1).alias("key"), _plain(F.substr(p, at(p) + 2, F.length(p) - at(p) - 2)).alias("value")))
    number = F.when(F.col("text") == "+Inf", float("inf")).when(F.col("text") == "-Inf", float("-inf")).otherwise(F.col("text").try_cast("double"))
    return found.select("name", F.map_from_entries(pairs).alias("labels"), number.alias("value")).where("value is not null")


def value_of(lines: DataFrame, name: str) -> float | None:
    """The value of the metric of this very name that has no labels."""
    row = read(lines).where((F.col("name") == name) & (F.size("labels") == 0)).select("value").first()
    return None if row is None else row[0]

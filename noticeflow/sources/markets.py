"""Inputs and output of the source-market dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..functions.text import strip
from ..schemas import CENSUS, MARKET, MARKET_ROW


def census_scan(spark: SparkSession, path: str) -> DataFrame:
    """County file: pipe-delimited with a header; fields stripped."""
    raw = spark.read.csv(path, sep="|", header=True)
    return trimmed_census(raw)


def trimmed_census(raw: DataFrame) -> DataFrame:
    return raw.select(*[strip(F.col(f.name)).alias(f.name) for f in CENSUS])


def markets_scan(spark: SparkSession, path: str) -> DataFrame:
    """JSON array of markets; the place in the array becomes ``market_seq``."""
    return decode_markets(spark.read.text(path, wholetext=True))


def decode_markets(texts: DataFrame, text: str = "value") -> DataFrame:
    """One row per array element; other columns of ``texts`` stay."""
    items = F.from_json(F.col(text), T.ArrayType(MARKET), {"mode": "FAILFAST"})
    carried = [c for c in texts.columns if c != text]
    rows = texts.select(*carried, F.posexplode(items).alias("market_seq", "m"))
    return rows.select(*carried, "market_seq", "m.*")


def encode_markets(markets: DataFrame, ascii_only: bool = False) -> DataFrame:
    """Markets as JSON objects, one per row, in the order of ``market_seq``.

    With ``ascii_only`` other characters are written as escapes.
    """
    fields = [f.name for f in MARKET]
    text = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    if ascii_only:
        text = _escaped(text)
    return markets.select("market_seq", text.alias("value")).orderBy("market_seq")


def _escaped(text: Column) -> Column:
    """Characters outside ASCII as UTF-16 escapes."""
    units = F.regexp_extract_all(F.hex(F.encode(text, "UTF-16BE")), F.lit("(.{4})"), F.lit(1))
    written = F.transform(units, lambda u: F.when(
        u.rlike("^00[0-7]"), F.decode(F.unhex(u), "UTF-16BE"))
        .otherwise(F.concat(F.lit("\\u"), F.lower(u))))
    return F.array_join(written, "")


def write_markets(markets: DataFrame, path: str, mode: str = "errorifexists",
                  ascii_only: bool = False) -> None:
    """JSON lines carrying ``market_seq`` in their order; any task count."""
    lines = markets.select("market_seq", *[f.name for f in MARKET]).orderBy("market_seq")
    text = F.to_json(F.struct("market_seq", *[f.name for f in MARKET]))
    lines.select((_escaped(text) if ascii_only else text).alias("value")) \
        .write.mode(mode).text(path)


def read_markets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MARKET_ROW).json(path)


def county_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """``name`` and ``slug`` of tab-separated lines; lines with other than two parts drop."""
    parts = F.split(F.col(line), "\t", -1)
    kept = lines.withColumn("_p", parts).where(F.size("_p") == 2)
    return kept.withColumns({"name": F.col("_p")[0], "slug": F.col("_p")[1]}).drop("_p", line)

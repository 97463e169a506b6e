"""Records that go over several lines, put together from lines that were read in parallel.

A line break between quotes belongs to its record. Whether a line begins inside quotes
depends on the number of quotes before it in its file, so quotes are counted for each
split, added up over the splits of a file, and then over the lines of each split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landfold.operators.bronze import PLACE

_SPLIT, _ODD, _BEFORE, _START, _NOT_BLANK = "_split", "_odd", "_quotes_before", "_start", r"[^\x00-\x20]"


def quoted_records(lines: DataFrame, *, quote: str = '"', header: bool = False) -> DataFrame:
    """Bronze rows of whole files as one row for each record, its lines joined by line feeds.

    ``lines`` are all lines of their files, blank ones too, with their places. A record has the
    columns of its first line. A quote inside quotes is written twice, so that a record has an
    even number of them; the lines of a file with an odd number are left as they are. Blank
    records are dropped, and with ``header`` the first other record of each file.

    Lines are shuffled once, by split. Only records of several lines are grouped.
    """
    columns = lines.columns
    here = ["fullFilePath", _SPLIT]
    counted = lines.withColumns(
        {
            _SPLIT: F.col("fileMetadata.file_block_start"),
            _ODD: F.pmod(F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit(""))), F.lit(2)),
        }
    )
    # One row for each split of each file.
    whole = Window.partitionBy("fullFilePath")
    earlier = whole.orderBy(_SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    splits = counted.groupBy(*here).agg(
        F.sum(_ODD).alias("_n"), F.min(F.when(F.col("value").rlike(_NOT_BLANK), F.col(PLACE))).alias("_first")
    ).select(
        *here,
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias(_BEFORE),
        (F.pmod(F.sum("_n").over(whole), F.lit(2)) == 0).alias("_even"),
        F.min(F.when(F.col("_first").isNotNull(), F.struct(_SPLIT, F.col("_first").alias(PLACE)))).over(whole).alias("_header"),
    )
    above = Window.partitionBy(*here).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, -1)
    to_here = Window.partitionBy(*here).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, 0)
    place = F.struct(_SPLIT, PLACE)
    inside = F.pmod(F.col(_BEFORE) + F.coalesce(F.sum(_ODD).over(above), F.lit(0)), F.lit(2)) == 1
    marked = (
        counted.join(splits, here)
        .withColumn("_begins", ~F.col("_even") | ~inside)
        .withColumn(_START, F.max(F.when(F.col("_begins"), place)).over(to_here))
    )
    # Where a split begins inside a record: the last record that began in the splits before.
    last = marked.groupBy(*here).agg(F.max(_START).alias("_last")).select(
        *here, F.max("_last").over(earlier).alias("_carried")
    )
    marked = marked.join(last, here).withColumn(_START, F.coalesce(_START, "_carried"))

    one = F.col("_begins") & ((F.col(_ODD) == 0) | ~F.col("_even"))
    single = marked.where(one).select(*columns, _START, "_header")
    parts = marked.where(~one).groupBy("fullFilePath", F.col(_START).alias("_record")).agg(
        F.sort_array(F.collect_list(F.struct(_SPLIT, PLACE, "value"))).alias("_lines"),
        F.min_by(F.struct(*[c for c in columns if c not in ("value", "fullFilePath")], "_header"), place).alias("_own"),
    )
    joined = parts.select(
        *[
            F.col("fullFilePath") if c == "fullFilePath"
            else F.array_join(F.transform("_lines", lambda r: r["value"]), "\n").alias("value") if c == "value"
            else F.col("_own")[c].alias(c)
            for c in columns
        ],
        F.col("_record").alias(_START),
        F.col("_own._header").alias("_header"),
    )
    records = single.unionByName(joined).where(F.col("value").rlike(_NOT_BLANK))
    if header:
        records = records.where(F.col(_START) != F.col("_header"))
    return records.select(columns)

"""Dense surrogate keys without a one-partition window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from lumbung.sources.staging import by_range, stage, stage_parts

# Both src_seq and monotonically_increasing_id keep a row number in the low 33
# bits and the number of the block or partition above it.
ROW_BITS = 33
GROUP_BITS = 12


def number_rows(df: DataFrame, order_by: list, id_col: str, start: int | Column = 0) -> DataFrame:
    """Number the rows ``start + 1, start + 2, ...`` in ``order_by`` order, which must be total.

    Rows are range-partitioned and sorted once. Their place (partition, row) is
    written with them to a staged table, so that the counting pass and the
    numbering pass agree.
    """
    placed = df.orderBy(*order_by).withColumn("_place", F.monotonically_increasing_id())
    row = F.col("_place").bitwiseAND(F.lit((1 << ROW_BITS) - 1)) + 1
    placed = stage(
        placed.withColumns({"_part": F.shiftrightunsigned("_place", ROW_BITS), "_row": row}).drop("_place"), "numbering"
    )
    return _number(placed, df.columns, id_col, start)


def number_source_rows(
    df: DataFrame, id_col: str, start: int | Column = 0, seq: str = "src_seq", only: str | None = None, parts: list[Column] | None = None
) -> DataFrame:
    """Number rows in the order of their source sequence.

    The high bits of the sequence name the file block a row came from. Blocks
    are in order and each fits a task, so rows are numbered block by block after
    one hash shuffle; no sampling pass looks for range bounds.

    With ``only`` (a boolean column) the rows where it holds are numbered and
    the others get a null id. ``parts`` (block_parts) are the slices the rows are placed in.
    """
    block = F.shiftright(seq, ROW_BITS)
    groups = ["_part"] + ([only] if only else [])
    in_block = Window.partitionBy(*groups).orderBy(seq)
    placed = [
        rows.withColumn("_part", block).withColumn("_row", F.row_number().over(in_block).cast("bigint"))
        for rows in ([df.filter(part) for part in parts] if parts else [df])
    ]
    return _number(stage_parts(placed, "numbering"), df.columns, id_col, start, only)


def block_parts(df: DataFrame, n: int, seq: str = "src_seq") -> list[Column]:
    """Conditions that split rows into about ``n`` slices of whole file blocks, in source order."""
    if n == 1:
        return [F.lit(True)]
    at = df.agg(F.percentile_approx(seq, [nth / n for nth in range(1, n)], 10 * n)).first()[0] or []
    return by_range(seq, [((block + 1) << ROW_BITS) - 1 for block in sorted({x >> ROW_BITS for x in at})])


def _number(placed: DataFrame, columns: list[str], id_col: str, start: int | Column, only: str | None = None) -> DataFrame:
    sizes = (placed.filter(only) if only else placed).groupBy("_part").agg(F.count("*").alias("_rows"))
    # One row per file block or partition of the sort. They are summed in groups of 4096, so the
    # window without a key runs over one row per group, and the others over one group each.
    sizes = sizes.withColumn("_group", F.shiftright("_part", GROUP_BITS))
    groups = sizes.groupBy("_group").agg(F.sum("_rows").alias("_rows"))
    groups = groups.select("_group", _sum_before(Window.orderBy("_group")).alias("_groups_before"))
    within = sizes.select("_part", "_group", _sum_before(Window.partitionBy("_group").orderBy("_part")).alias("_parts_before"))
    offsets = within.join(groups, "_group").select("_part", (F.col("_groups_before") + F.col("_parts_before")).alias("_before"))
    number = F.col("_before") + F.col("_row") + (start if isinstance(start, Column) else F.lit(start))
    if only:
        number = F.when(F.col(only), number)
    # Staged, so that Spark knows its size and broadcasts it only below the threshold.
    numbered = placed.join(stage(offsets, "offsets"), "_part", "left")
    return numbered.select(number.cast("bigint").alias(id_col), *columns)


def _sum_before(window: WindowSpec) -> Column:
    return F.coalesce(F.sum("_rows").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def max_or_zero(df: DataFrame, column: str) -> DataFrame:
    """One row: the largest value, 0 when there is none."""
    return df.agg(F.coalesce(F.max(column), F.lit(0)).cast("bigint").alias(column))

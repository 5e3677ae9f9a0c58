"""Exact deduplication by content sort, in DataFrame functions only.

Texts are normalised (each run of white space becomes one space, null is the
empty text) and range-partitioned by sampled splitters; an external sort
inside each range places equal texts next to each other, and comparing
neighbouring rows on the whole text forms the groups (the window operator
compares each row's full key with the row before it).

* The splitters are drawn on the text's first characters and its 64-bit hash,
  so the samples sent to the driver stay small; the sort and the comparisons
  use whole texts, the hash only decides which range a text goes to.
* A text held by more rows than one cell may have (``cell_rows``, or 1/65536
  of the table where that is more) is dealt over several cells by its row
  ids, so a group of copies with a third of all rows spreads over the ranges.
  Such texts number at most 65,536, which bounds the broadcast list of hot
  hashes.  The cells' first rows are then grouped again on the whole text.

Defined results: a null text equals the empty text; a null id sorts after
every other id; among repeated rows with the same id and text exactly one is
kept; an empty table gives an empty result; extra columns are carried along,
also under names this module uses itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealsieve.llm.common import WHITE, materialise, text_or_empty

CELL_ROWS = 500          # rows of one text in one cell, at least
MOST_HOT_TEXTS = 65_536  # bound of the broadcast list of split texts
SPLITTER_CHARS = 32      # characters of a text that the splitters see


def normalised(text_col: str = "text"):
    """The text with every run of white space replaced by one space; null is empty."""
    return F.regexp_replace(text_or_empty(text_col), WHITE, " ")


def _sorted_cells(docs: DataFrame, id_col: str, text_col: str, cell_rows: int) -> DataFrame:
    """Every row as struct ``_row`` with its place in its cell.

    Columns: _row, _id, _norm, _hash, _cell, _cells (null unless the text is
    split), _rank (1 for the cell's smallest id), _first (that id), _size.
    """
    limit = max(cell_rows, docs.count() // MOST_HOT_TEXTS)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       F.col(f"`{id_col}`").alias("_id"), normalised(text_col).alias("_norm")) \
        .withColumn("_hash", F.xxhash64("_norm"))
    hot = (docs.select(F.xxhash64(normalised(text_col)).alias("_hash"))
           .groupBy("_hash").agg(F.count(F.lit(1)).alias("_n"))
           .where(F.col("_n") > limit)
           .select("_hash", F.ceil(F.col("_n") / limit).alias("_cells")))
    dealt = rows.join(F.broadcast(hot), "_hash", "left").withColumn(
        "_cell", F.coalesce(F.pmod(F.xxhash64("_id"), F.col("_cells")), F.lit(0))) \
        .withColumn("_start", F.substring("_norm", 1, SPLITTER_CHARS))
    ranged = dealt.repartitionByRange("_start", "_hash", "_cell")
    equal = Window.partitionBy("_start", "_hash", "_cell", "_norm")
    return ranged.select(
        "_row", "_id", "_norm", "_hash", "_cell", "_cells",
        F.row_number().over(equal.orderBy(F.col("_id").asc_nulls_last())).alias("_rank"),
        F.min("_id").over(equal).alias("_first"),
        F.count(F.lit(1)).over(equal).alias("_size"))


def content_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256 (of the normalised text)."""
    slim = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    cells = _sorted_cells(slim, id_col, text_col, cell_rows)
    heads_text = F.when(F.col("_cells").isNotNull() & (F.col("_rank") == 1), F.col("_norm"))
    placed = materialise(cells.select(
        "_id", F.sha2("_norm", 256).alias("_sha"), "_cell", "_cells", "_rank", "_first", "_size",
        heads_text.alias("_head")), "content-cells")
    # Texts in several cells: their cells' first rows meet on the whole text (at most rows / cell_rows of them).
    heads = placed.where(F.col("_head").isNotNull())
    whole = heads.groupBy("_head").agg(F.min("_first").alias("_keep"), F.sum("_size").alias("_total"))
    per_cell = heads.select("_head", "_sha", "_cell", "_first").join(whole, "_head") \
        .select("_sha", "_cell", "_keep", "_total",
                F.col("_first").eqNullSafe(F.col("_keep")).alias("_is_first"))
    # Null ids of one text meet in one cell, so at most one cell's first row is the text's first row.
    joined = placed.join(per_cell, ["_sha", "_cell"], "left")
    split = F.col("_cells").isNotNull()
    return joined.select(
        F.col("_id").alias(id_col),
        F.when(split, F.col("_keep")).otherwise(F.col("_first")).alias("keep_id"),
        F.when(split, F.col("_total")).otherwise(F.col("_size")).alias("group_size"),
        ((F.col("_rank") == 1) & F.when(split, F.col("_is_first")).otherwise(F.lit(True))).alias("kept"),
        F.col("_sha").alias("text_sha256"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                cell_rows: int = CELL_ROWS) -> DataFrame:
    """The rows that stay: of equal texts the one with the smallest id, all columns unchanged."""
    heads = materialise(_sorted_cells(docs, id_col, text_col, cell_rows).where(F.col("_rank") == 1)
                        .select("_row", "_id", "_cells", F.when(F.col("_cells").isNotNull(), F.col("_norm"))
                                .alias("_norm")), "content-heads")
    split = heads.where(F.col("_cells").isNotNull())
    first = Window.partitionBy("_norm").orderBy(F.col("_id").asc_nulls_last())
    from_split = split.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") == 1)
    kept = heads.where(F.col("_cells").isNull()).select("_row").unionByName(from_split.select("_row"))
    return kept.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])

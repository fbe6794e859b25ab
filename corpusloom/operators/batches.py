"""Fixed-size batches of token rows, padded for a causal language model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.order import global_index
from corpusloom.operators.tokens import PAD_ID
from corpusloom.spec import SEED

# Fixed value: label of a position that does not count in the loss.
IGNORED_LABEL = -100


def assign_batches(rows: DataFrame, batch_size: int, seed: int = SEED, drop_last: bool = True) -> DataFrame:
    """Add ``batch_id`` and ``batch_row``: ``batch_size`` rows per batch, in shuffled order.

    With ``drop_last`` an incomplete last batch is left out.
    """
    place = F.col("row_index") - 1
    batched = global_index(rows, seed).withColumns(
        {"batch_id": F.floor(place / batch_size), "batch_row": (place % batch_size).cast("int")}
    )
    if drop_last:
        batched = batched.where(F.col("batch_id") < F.floor(F.col("row_total") / batch_size))
    return batched.drop("row_index", "row_total")


def _padded(values: Column, length: Column, fill: int) -> Column:
    return F.concat(values, F.array_repeat(F.lit(fill), length - F.size(values)))


def collate(rows: DataFrame, pad_id: int = PAD_ID, mask_by_position: bool = False) -> DataFrame:
    """Pad each batch to its longest row and add ``labels``.

    Labels are the ids with every padding id ignored. If the padding id is also the
    end id, true end tokens are ignored too; ``mask_by_position`` ignores only the
    positions that were added.
    """
    longest = F.max(F.size("input_ids")).over(Window.partitionBy("batch_id"))
    sized = rows.withColumn("_length", longest)
    padded = sized.withColumns(
        {
            "input_ids": _padded(F.col("input_ids"), F.col("_length"), pad_id),
            "attention_mask": _padded(F.col("attention_mask"), F.col("_length"), 0),
            "_added": F.col("_length") - F.size("input_ids"),
        }
    )
    if mask_by_position:
        kept = F.slice("input_ids", F.lit(1), F.col("_length") - F.col("_added"))
        labels = F.concat(kept, F.array_repeat(F.lit(IGNORED_LABEL), F.col("_added")))
    else:
        labels = F.transform("input_ids", lambda i: F.when(i == pad_id, F.lit(IGNORED_LABEL)).otherwise(i))
    return padded.withColumn("labels", labels).drop("_length", "_added")

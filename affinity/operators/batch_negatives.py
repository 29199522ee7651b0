"""Negatives for batches of positives: no drawn item is a positive of any row of the batch.

The items that a batch bans are its sorted catalogue positions b_0 < b_1 < ... . Before b_j there are
b_j - j free positions, a series that never falls, so the x-th free position is x plus the number of its values
up to x: one binary search. A draw is a uniform number below the number of free positions, so it is
mapped straight to an item; nothing is rejected, and no draw meets the catalogue before its item is known.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.functions.hashing import md5_hex
from affinity.operators.ranking import dense_index

BATCH_ROWS = 8192
TWO_31 = 1 << 31


def nth_free(x: np.ndarray, banned: np.ndarray) -> np.ndarray:
    """The ``x``-th position (from 0) that is not among ``banned``, which are sorted and distinct."""
    return x + np.searchsorted(banned - np.arange(len(banned)), x, side="right")


def batch_negatives(
    pairs: DataFrame,
    catalogue: DataFrame,
    per_positive: int = 1,
    batch_rows: int = BATCH_ROWS,
    user: str = "user_id",
    item: str = "product_id",
    seed: int = 42,
) -> DataFrame:
    """``per_positive`` uniform negatives for each positive pair: batch, user, item, draw (from 0) and ``negative``.

    Distinct pairs are dealt to batches of about ``batch_rows`` by their hash, so their number follows the
    data. Draws are independent, so an item may be drawn again; they are functions of the pair. A
    positive outside the catalogue gets negatives and bans nothing. A batch that bans the whole
    catalogue is an error.
    """
    shelf = dense_index(catalogue.select(item).distinct(), [item], "_ix")
    n_items = shelf.count()
    n_batches = max(1, -(-pairs.count() // batch_rows))
    digest = md5_hex(seed, user, item, -1)
    batch = F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(n_batches)).cast("int")
    rows = pairs.select(batch.alias("batch"), F.col(user).cast("bigint"), F.col(item).cast("bigint"))
    placed = rows.join(shelf.select(F.col(item).cast("bigint").alias(item), "_ix"), item, "left")
    draws = F.transform(
        F.sequence(F.lit(0), F.lit(per_positive - 1)),
        lambda d: _word(seed, user, item, d, 0) * TWO_31 + _word(seed, user, item, d, 1),
    )
    placed = placed.select("batch", user, item, "_ix", draws.alias("_h"))

    def draw(table: pa.Table) -> pa.Table:
        banned = np.unique(table["_ix"].drop_null().to_numpy())
        free = n_items - len(banned)
        if free < 1:
            raise ValueError(f"batch {table['batch'][0]} has all {n_items} items among its positives")
        x = table["_h"].combine_chunks().flatten().to_numpy() % free
        each = np.repeat(np.arange(table.num_rows), per_positive)
        return table.select(["batch", user, item]).take(pa.array(each)).append_column(
            "draw", pa.array(np.tile(np.arange(per_positive, dtype=np.int32), table.num_rows))
        ).append_column("_ix", pa.array(nth_free(x, banned)))

    schema = f"batch int, `{user}` long, `{item}` long, draw int, _ix long"
    drawn = placed.groupBy("batch").applyInArrow(draw, schema)
    named = shelf.select("_ix", F.col(item).alias("negative"))
    return drawn.join(named, "_ix").select("batch", user, item, "draw", "negative")


def _word(seed: int, user: str, item: str, draw, at: int):
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(user).cast("string"), F.col(item).cast("string"), draw.cast("string")))
    return F.conv(F.substring(digest, 1 + 8 * at, 8), 16, 10).cast("bigint") % TWO_31

"""Sharding by jump consistent hashing: stable keys to shards, no ring table."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartfold.llm.common import numbered, ranked
from chartfold.shared import send_by_value

send_by_value(__name__)

# Fixed values of the published jump hash: multiplier of its generator, and the
# span of the 31 bits it draws.
MULTIPLIER = np.uint64(2862933555777941757)
SPAN = float(1 << 31)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key: it jumps ahead until a jump leaves the range."""
    if shards < 1:
        raise ValueError("there must be at least one shard")
    state = keys.astype(np.uint64)
    at = np.zeros(len(state), dtype=np.int64)
    live = np.arange(len(state))
    while len(live):
        state[live] = state[live] * MULTIPLIER + np.uint64(1)
        draw = (state[live] >> np.uint64(33)).astype(np.float64) + 1.0
        ahead = np.floor((at[live] + 1) * (SPAN / draw))
        live, ahead = live[ahead < shards], ahead[ahead < shards]
        at[live] = ahead.astype(np.int64)
    return at


def jump_column(key, shards: int):
    """A column with the shard of each non-NULL 64-bit key column value."""

    @F.pandas_udf("int")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for keys in batches:
            yield pd.Series(jump(keys.to_numpy(dtype=np.int64), shards).astype(np.int32))

    return of(key)


def shard(df: DataFrame, key: Sequence[str], shards: int) -> DataFrame:
    """`df` with `shard` (0 to `shards` - 1), `grown_shard` (with one shard more)
    and `slot`, a gapless number from 0 within the shard.

    Key and shard count alone decide the shard, so equal keys meet; a NULL key
    is a key like any other. Going from n to n + 1 shards moves a row only into
    the new shard. Slots follow no order of the data. Repeated rows keep a slot
    each; an empty table gives an empty one. `df` may hold any columns but
    these three.
    """
    # The columns of `df` go into one, so that they clash with nothing here.
    keyed = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), F.xxhash64(*key).alias("hash"))
    placed = keyed.select(
        "row", jump_column(F.col("hash"), shards).alias("shard"), jump_column(F.col("hash"), shards + 1).alias("grown_shard")
    )
    return ranked(numbered(placed), ["shard"], into="slot").select("row.*", "shard", "grown_shard", "slot")

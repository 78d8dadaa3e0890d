"""Best-fit packing into bins of several permitted sequence lengths.

Documents are cut into pieces no longer than the longest bin; pieces go to shards of bounded size and every shard packs
its pieces best-fit decreasing. A piece that fits no open bin opens one, of the length that costs least for each word it
is likely to hold, as what is still to come tells. Last, each bin shrinks to the smallest permitted length that holds its
contents. The same with one opening length for all bins is tried too, and the cheapest outcome stands.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .mixing import n_words

_KEYS = ["id", "words", "copy", "piece"]
_PACKED = "id long, words long, copy long, piece int, size int, shard long, bin int, capacity int, at int"


def _fit(sizes: list[int], caps: list[int], bin_cost: int, opening: int | None) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each size (given in falling order), and the bins' contents. Of equal rooms the oldest bin wins.

    Without `opening` each new bin chooses its length: what is to come and does not fit into open bins may fill it.
    """
    rooms: list[tuple[int, int]] = []  # (room left, bin), sorted
    where, at, filled = [], [], []
    ahead, free = sum(sizes), 0
    for size in sizes:
        ahead -= size
        i = bisect_left(rooms, (size, -1))
        if i < len(rooms):
            room, b = rooms.pop(i)
            free -= size
        else:
            b = len(filled)
            filled.append(0)
            fits = caps[bisect_left(caps, size) :]
            hold = size + max(0, ahead - free)
            room = max(opening, fits[0]) if opening else min(fits, key=lambda c: ((c + bin_cost) / min(c, hold), -c))
            free += room - size
        where.append(b)
        at.append(filled[b])
        filled[b] += size
        if room > size:
            insort(rooms, (room - size, b))
    return where, at, filled


def pack(sizes: list[int], caps: Sequence[int], bin_cost: int) -> tuple[list[int], list[int], list[int]]:
    """The cheapest of the packings whose bins choose their lengths, or all open with one; a bin costs its length and
    `bin_cost`. Returns bin and offset of each size, which must be in falling order, and the bins' lengths.
    """
    caps, best = sorted(caps), None
    for opening in (None, *reversed(caps)):
        where, at, filled = _fit(sizes, caps, bin_cost, opening)
        lengths = [caps[bisect_left(caps, f)] for f in filled]
        cost = sum(lengths) + bin_cost * len(lengths)
        if best is None or cost < best[0]:
            best = (cost, where, at, lengths)
    return best[1:]


def pack_documents(
    docs: DataFrame,
    caps: Sequence[int] = (512, 1024, 2048),
    bin_cost: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_pieces: int = 4096,
) -> DataFrame:
    """One row per piece: id, words (of its document), copy, piece, size (words), bin (string, null for a text without
    words), capacity, at (offset).

    A document longer than the longest bin becomes full pieces and a rest, in order; full pieces of the greatest
    length are bins by themselves. Null, empty and blank texts give one row of size 0 without a bin. Rows that repeat an
    id are packed each time: those of equal size, which packing can't tell apart, are numbered by `copy` from 1. An empty
    table gives no rows. Pieces are dealt to shards by hash, about `shard_pieces` in each, so no task holds more, however
    the lengths are distributed.
    """
    top = max(caps)
    d = docs.select(F.col(id_col).cast("long").alias("id"), n_words(F.col(text_col)).alias("words"))
    d = stored(d.groupBy("id", "words").agg(F.count(F.lit(1)).alias("copies")), "packing-sizes")
    # copies are numbered in runs, so that no row holds a long list
    run = 4096
    d = d.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / run))).alias("r"))
    d = d.select("id", "words", F.explode(F.sequence(F.col("r") * run + 1, F.least((F.col("r") + 1) * run, F.col("copies")))).alias("copy"))
    last = F.greatest(F.ceil(F.col("words") / top), F.lit(1)) - 1
    d = d.select("id", "words", "copy", F.explode(F.sequence(F.lit(0), last.cast("int"))).alias("piece"))
    d = d.select(*_KEYS, F.least(F.lit(top), F.col("words") - F.col("piece") * top).cast("int").alias("size"))
    alone = F.col("size").isin(0, top)
    part = d.where(~alone)
    shards = max(1, -(-part.count() // shard_pieces))
    part = part.withColumn("shard", F.pmod(F.xxhash64(*_KEYS), F.lit(shards)))

    def packed(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(["size", *_KEYS], ascending=[False, True, True, True, True], kind="stable")
        where, at, lengths = pack(p["size"].tolist(), caps, bin_cost)
        return p.assign(bin=where, at=at, capacity=[lengths[b] for b in where])[[*_KEYS, "size", "shard", "bin", "capacity", "at"]]

    packed_rows = part.groupBy("shard").applyInPandas(packed, _PACKED)
    name = F.format_string("%d-%d", "shard", "bin")
    own = F.concat_ws("-", F.lit("full"), F.coalesce(F.col("id").cast("string"), F.lit("null")), "words", "copy", "piece")
    single = d.where(alone).select(*_KEYS, "size", F.when(F.col("size") > 0, own).alias("bin"), F.when(F.col("size") > 0, top).otherwise(0).alias("capacity"), F.lit(0).alias("at"))
    return packed_rows.select(*_KEYS, "size", name.alias("bin"), "capacity", "at").unionByName(single)

"""Sharding by vector bin packing: bytes, tokens and rows balanced jointly.

Rows of equal texts are a group; a group is placed, as a vector of its bytes,
tokens and rows relative to a shard's capacity, where the dot product with the
residual capacity is highest, largest groups first; one that fits nowhere goes
where most bytes are left. A group over 1/50 of a
shard is split into parts of about that size first, so that even a group with a
third of all rows spreads.

At scale the placing has two levels. Groups are dealt by hash to ``blocks``
blocks, or to more, so that a block has a million groups on average; each block packs its groups into one local bin per shard, streaming
them in descending size with nothing but the residuals in memory. The at most
``blocks * shards`` local bins are then placed by the same rule. Slots follow from
three offsets (bin in shard, group in bin, row in group), so no shard is ever
sorted or numbered in one task.

Law: ``bytes`` (sizes near equal). A size is the text's UTF-8 bytes plus 16.
Tokens are blank-separated pieces.

Defined results: a null text has no bytes and stands with the empty texts; each
input row has its own slot, also with repeated or null ids; other columns are
ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.llm.frames import staged

SHARDS = 40
BLOCKS = 256
#: Groups of a block on average, above which there are more blocks.
BLOCK_GROUPS = 1_000_000
SPLIT = 50
_DIMS = ["bytes", "tokens", "rows"]


class Bins:
    """Residual capacities of bins, relative to the capacity."""

    def __init__(self, n: int, total: np.ndarray):
        self.scale = n / np.maximum(np.asarray(total, float), 1)
        self.left = np.ones((n, len(self.scale)))

    def place(self, item: np.ndarray) -> int:
        """The bin with the highest dot product among those that the item still
        fits; where it fits none, the one with most bytes left, as the law asks."""
        v = item * self.scale
        fits = (self.left >= v).all(axis=1)
        at = int(np.argmax(np.where(fits, self.left @ v, -1.0) if fits.any() else self.left[:, 0]))
        self.left[at] -= v
        return at


def _slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    blanks = F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("bytes"),
        F.when(text == "", 0).otherwise(blanks + 1).cast("long").alias("tokens"), F.crc32(text).alias("crc"),
        F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"), F.monotonically_increasing_id().alias("rid"))


def assign_shards(docs: DataFrame, shards: int = SHARDS, blocks: int = BLOCKS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: its size, shard and slot."""
    spark = docs.sparkSession
    slim = staged(_slim(docs, id_col, text_col), "slim")
    sums = [F.sum("bytes").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    total = slim.agg(*sums).first()
    groups = slim.groupBy("h1", "h2").agg(*sums)
    share = F.greatest(*(F.col(d) / max(total[d] or 0, 1) for d in _DIMS)) * (shards * SPLIT)
    # each has 1/(shards * SPLIT) of some total: at most 3 * shards * SPLIT groups
    large = groups.select("h1", "h2", F.ceil(share).cast("long").alias("parts")).where("parts > 1")
    rows = slim.join(F.broadcast(large), ["h1", "h2"], "left").select(
        "doc_id", "bytes", "tokens", "crc", "h1", "h2", "rid",
        F.coalesce(F.pmod(F.xxhash64("rid"), F.col("parts")), F.lit(0)).alias("salt"))
    units = staged(rows.groupBy("h1", "h2", "salt").agg(*sums), "units")
    blocks = max(blocks, -(-units.count() // BLOCK_GROUPS))
    units = units.withColumn("block", F.pmod(F.xxhash64("h1", "h2", "salt"), F.lit(blocks)).cast("int"))
    capacity = {r.block: np.array([r[d] for d in _DIMS], float) for r in units.groupBy("block").agg(*(F.sum(d).alias(d) for d in _DIMS)).collect()}

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, current, filled = None, None, None
        for b in batches:
            vectors = np.stack([b.column(d).to_numpy() for d in _DIMS], 1).astype(float)
            bin_no, before = np.empty(len(vectors), np.int32), np.empty(len(vectors), np.int64)
            for i, (block, v) in enumerate(zip(b.column("block").to_pylist(), vectors, strict=True)):
                if block != current:
                    current, bins, filled = block, Bins(shards, capacity[block]), np.zeros(shards, np.int64)
                at = bins.place(v)
                bin_no[i], before[i] = at, filled[at]
                filled[at] += int(v[2])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(bin_no), pa.array(before)], names=[*b.schema.names, "bin", "before"])

    packed = staged(units.repartition("block").sortWithinPartitions("block", F.desc("bytes"), "h1", "h2", "salt")
                    .mapInArrow(fill, "h1 long, h2 long, salt long, bytes long, tokens long, rows long, block int, bin int, before long"), "bins")
    local = sorted(packed.groupBy("block", "bin").agg(*(F.sum(d).alias(d) for d in _DIMS)).collect(),  # at most blocks * shards rows
                   key=lambda r: (-r.bytes, r.block, r.bin))
    level, base, place = Bins(shards, np.array([total[d] or 0 for d in _DIMS], float)), [0] * shards, []
    for r in local:
        at = level.place(np.array([r[d] for d in _DIMS], float))
        place.append((r.block, r.bin, at, base[at]))
        base[at] += r.rows
    places = spark.createDataFrame(place, "block int, bin int, shard int, base long")
    where = packed.select("h1", "h2", "salt", "block", "bin", "before").join(F.broadcast(places), ["block", "bin"]).select(
        "h1", "h2", "salt", "shard", (F.col("base") + F.col("before")).alias("first"))
    nth = F.row_number().over(Window.partitionBy("h1", "h2", "salt").orderBy("doc_id", "rid")) - 1
    return rows.withColumn("nth", nth).join(where, ["h1", "h2", "salt"]).select(
        "doc_id", F.col("bytes").alias("size"), F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
        (F.col("first") + F.col("nth")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "tokens")

"""Best-fit packing of documents into sequences of fixed capacity, under conflicts.

Open bins are ordered by residual capacity and carry two bitmaps: the sources and the duplicate
clusters they hold. A document goes to the tightest bin it fits in whose bitmaps have neither its
source nor its cluster; the search starts at the first bin with room enough and moves on to the
next larger residual until a bin is compatible.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmarts.llm import simhash
from tripmarts.llm.common import count_of, words

CAPACITY = 2048
# Documents packed together in one task.
SHARD_DOCS = 4096
# Bin ids set apart for each shard of a mix, more than the pieces that one shard can have.
SHARD_BINS = 1 << 32


class Bins:
    """Bins of one shard; ``add`` places an item and returns (bin, offset)."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.open: list[tuple[int, int]] = []
        self.sources: list[int] = []
        self.clusters: list[int] = []

    def add(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """``source`` and ``cluster`` are bitmaps of one bit, or 0 for none."""
        at = bisect_left(self.open, (size, -1))
        while at < len(self.open):
            residual, number = self.open[at]
            if not self.sources[number] & source and not self.clusters[number] & cluster:
                del self.open[at]
                break
            at += 1
        else:
            residual, number = self.capacity, len(self.sources)
            self.sources.append(0)
            self.clusters.append(0)
        self.sources[number] |= source
        self.clusters[number] |= cluster
        if residual > size or size == 0:
            insort(self.open, (residual - size, number))
        return number, self.capacity - residual


def _bits(values: pd.Series) -> list[int]:
    """One bit for each value that occurs twice or more, 0 for the others: those can meet no equal."""
    shared = {value: 1 << n for n, value in enumerate(sorted(values[values.duplicated()].dropna().unique()))}
    return [shared.get(value, 0) for value in values]


PACKED = "doc_id long, piece long, bin_id long, bin_offset long, piece_start long, piece_size long, source string"


def _pack_shard(capacity: int, shards: int | None):
    """``shards`` is None for shards in the order of a position: their bins are numbered by it."""

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "doc_id", "cluster"], ascending=[False, True, True], na_position="last")
        bins, out = Bins(capacity), []
        shard = int(rows["shard"].iloc[0])
        # The remainders of long documents take part with their own size, largest first.
        items = []
        for n, (doc_id, size) in enumerate(zip(rows["doc_id"], rows["size"], strict=True)):
            full = max(0, (int(size) - 1) // capacity)
            for piece in range(full):
                number, _ = bins.add(capacity, 0, 0)
                out.append((n, piece, number, 0, piece * capacity, capacity))
            items.append((int(size) - full * capacity, n, full))
        sources, clusters = _bits(rows["source"]), _bits(rows["cluster"])
        for size, n, piece in sorted(items, key=lambda item: (-item[0], item[1])):
            number, offset = bins.add(size, sources[n], clusters[n])
            out.append((n, piece, number, offset, piece * capacity, size))
        made = pd.DataFrame(out, columns=["n", "piece", "bin", "bin_offset", "piece_start", "piece_size"])
        made["doc_id"] = pd.array([None if x is None else int(x) for x in rows["doc_id"]], "Int64")[made["n"]]
        made["source"] = rows["source"].to_numpy()[made["n"]]
        if shards is None:
            # Bins in the order of the first document they hold, a long document's pieces in their own.
            made["position"] = rows["position"].to_numpy()[made["n"]]
            first = made.groupby("bin", as_index=False).agg({"position": "min", "piece": "min"})
            first = first.sort_values(["position", "piece", "bin"])["bin"].tolist()
            rank = {number: n for n, number in enumerate(first)}
            made["bin_id"] = shard * SHARD_BINS + made["bin"].map(rank)
        else:
            made["bin_id"] = made["bin"] * shards + shard
        return made[["doc_id", "piece", "bin_id", "bin_offset", "piece_start", "piece_size", "source"]]

    return pack


def with_near_copies(
    documents: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source", **options,
) -> DataFrame:
    """``doc_id, source, text_hash, size, cluster`` of every row, for :func:`pack` with these names.

    A cluster is a component of near copies, as :func:`simhash.grouped` finds them with ``options``;
    a row of NULL or repeated id takes that of its own text. Repeated rows are kept, each with its
    cluster; names of other columns do not matter, as none is read. An empty table stays empty.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    sizes = documents.select(
        F.col(key).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"),
        F.xxhash64(body).alias("text_hash"), F.size(words(body)).alias("size"),
    )
    found = simhash.grouped(documents, key=key, text=text, **options)
    # Equal texts have one component, so there is one row for each id and text.
    found = found.groupBy(F.col("doc_id").alias("found_id"), F.col("text_hash").alias("found_hash")).agg(
        F.min("component").alias("cluster")
    )
    same = F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("text_hash") == F.col("found_hash"))
    return sizes.join(found, same, "left").drop("found_id", "found_hash")


def pack(
    documents: DataFrame, *, capacity: int = CAPACITY, shard_docs: int = SHARD_DOCS, key: str = "doc_id",
    text: str = "text", source: str = "source", cluster: str | None = None, size: str | None = None,
    position: str | None = None,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, bin_id, bin_offset, piece_start, piece_size, source``.

    Sizes are words of the text, or column ``size``. Documents above ``capacity`` are cut into full
    pieces, each a bin of its own, and a remainder that is packed; nothing is dropped. No bin holds
    two documents of one source or of one duplicate cluster (column ``cluster``; by default equal
    texts are a cluster). NULL sources and clusters conflict with nothing; NULL and negative sizes
    count as 0, and a document of size 0 takes a place of its own in a bin. Shards by hash of key,
    text and the number of a copy are packed apart, each largest first, ties by key, so the result is
    the same in every run and rows equal in all of these, which are counted first, fill no shard.

    With column ``position``, the different places of the documents in a mix, every ``shard_docs``
    places in a row are a shard instead, and bins are numbered in the order of the mix: all bins of
    a shard before those of the next, and in a shard by the first place they hold. ``bin_id`` then
    has gaps between shards. With ``size`` and ``cluster`` as well, no text is read.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    measured = F.size(words(body)) if size is None else F.greatest(F.coalesce(F.col(size), F.lit(0)), F.lit(0))
    columns = [
        F.col(key).cast("long").cast("string").alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        (F.xxhash64(body) if cluster is None else F.col(cluster)).cast("string").alias("cluster"),
        measured.cast("long").alias("size"),
    ]
    if position is not None:
        place = F.col(position).cast("long")
        rows = documents.select(*columns, place.alias("position"), F.floor(place / shard_docs).cast("long").alias("shard"))
        return rows.groupBy("shard").applyInPandas(_pack_shard(capacity, None), PACKED)
    rows = documents.select(*columns, F.xxhash64(F.col(key), body).alias("mixed"))
    alike = rows.groupBy(*rows.columns).agg(F.count("*").alias("copies"))
    shards = count_of(documents.count(), shard_docs)
    rows = alike.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    shard = F.when(F.col("copies") == 1, F.col("mixed")).otherwise(F.xxhash64("mixed", "copy"))
    rows = rows.withColumn("shard", F.pmod(shard, F.lit(shards)).cast("int")).drop("mixed", "copies", "copy")
    return rows.groupBy("shard").applyInPandas(_pack_shard(capacity, shards), PACKED)

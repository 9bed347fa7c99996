"""Prefix trie of conversations, with totals rolled up in bands of depths.

A node is a sequence of leading turns, known by the sum of its turns' digests times powers of a
base, modulo a prime. Such sums can be continued anywhere, so one very long conversation is dealt
out in chunks. For totals over subtrees a node goes to its ancestors inside its band of HEIGHT
depths only; totals of band roots are rolled up among themselves by the same step, in bands of
bands, and are then handed to the band above. Rounds grow with the logarithm of the depth, and a
node meets at most HEIGHT ancestors a round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmarts.llm.common import count_of, kept, looked_up, ship

# Depths of a band. A group holds HEIGHT ** LEVELS turns of a conversation, so that bands are whole.
HEIGHT, LEVELS = 8, 4
# Levels of bands at most: more turns than any table has.
ALL_LEVELS = 64
# A borrowed prefix has fewer turns than this, and groups of so many conversations share one.
PREFIXES, SIBLINGS = 9, 5
# Rows of a sorted part, and ids in one piece of a list that is hashed.
PART_ROWS, PIECE = 200_000, 4096
PRIME = (1 << 127) - 1
BASE = 0x5BD1E995_9E3779B9_7F4A7C15_85EBCA6B % PRIME
ROOT = bytes(16)


class Paths:
    """Keys above a node, at each level those at multiples of ``height ** level`` inside one band of ``height ** (level + 1)``.

    Nodes pass in ascending depth below a start, whose depth is the root of a band at all levels.
    """

    def __init__(self, key: bytes, levels: range, height: int):
        self.height, self.above_now = height, {level: [key] for level in levels}

    def above(self, depth: int, key: bytes) -> list[list[bytes]]:
        """The paths of a node from its band's root to just above it, by level while the depth is a multiple."""
        out = []
        for level, path in self.above_now.items():
            if depth % self.height**level:
                break
            out.append(list(path))
            self.above_now[level] = [key] if depth % self.height ** (level + 1) == 0 else [*path, key]
        return out


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, seq, digest, bytes``: the turns of each conversation numbered from 0, as digests.

    NULL turns come first, equal ones are ordered by role and a digest of the text. Rows are dealt
    out by ranges, so a conversation of any length is sorted and numbered in parts.
    """
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    digest = F.substring(F.unhex(F.sha2(F.concat_ws(":", F.octet_length(role).cast("string"), F.concat(role, text)), 256)), 1, 16)
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes"),
    ).filter("conv_id IS NOT NULL")
    rows = kept(rows, "turns")
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    sorted_rows = rows.repartitionByRange(count_of(rows.count(), PART_ROWS), *order).sortWithinPartitions(*order)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, now, place = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            places = []
            for conv_id in batch.column(0).to_pylist():
                place = place + 1 if conv_id == now else 0
                now = conv_id
                places.append(place)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * batch.num_rows, pa.int64()), pa.array(places, pa.int64()), *batch.columns],
                ["part", "place", "conv_id", "digest", "bytes"],
            )

    placed = sorted_rows.select("conv_id", "digest", "bytes").mapInArrow(
        number, "part long, place long, conv_id long, digest binary, bytes long"
    )
    placed = kept(placed, "placed")
    spans = placed.groupBy("conv_id", "part").agg(F.count("*").alias("held"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # Only the first conversation of a part can have begun before it: at most one row a part.
    begun = spans.withColumn("before", F.sum("held").over(earlier)).filter("before > 0").select("conv_id", "part", "before")
    joined = placed.join(F.broadcast(begun), ["conv_id", "part"], "left")
    return joined.select("conv_id", (F.col("place") + F.coalesce("before", F.lit(0))).alias("seq"), "digest", "bytes")


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations: ``conv_id, depth, digest, bytes`` of their turns, and ``conv_id, length``.

    Conversation c starts with the first h turns of conversation ``c - c % 5``, h being
    ``crc32(c) % 9``, and goes on with its own turns after the first h.
    """
    own = turns.groupBy("conv_id").agg(F.count("*").alias("turns"))
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % PREFIXES
    own = kept(own.select("conv_id", "turns", taken.alias("h"), (F.col("conv_id") - F.col("conv_id") % SIBLINGS).alias("base")), "lengths")
    bases = own.select(F.col("conv_id").alias("base"), F.col("turns").alias("base_turns"))
    plans = own.join(bases, "base", "left").withColumn("m", F.least("h", F.coalesce("base_turns", F.lit(0))))
    plans = plans.select("conv_id", "base", "h", "m", (F.col("m") + F.greatest(F.col("turns") - F.col("h"), F.lit(0))).alias("length"))
    plans = kept(plans, "plans")
    kept_own = looked_up(turns, plans.select("conv_id", "h", "m"), ["conv_id"]).filter("seq >= h")
    kept_own = kept_own.select("conv_id", (F.col("m") + F.col("seq") - F.col("h") + 1).alias("depth"), "digest", "bytes")
    first = turns.filter(F.col("seq") < PREFIXES).withColumnRenamed("conv_id", "base")
    borrowed = plans.filter("m > 0").select("base", "conv_id", "m").join(first, "base").filter("seq < m")
    borrowed = borrowed.select("conv_id", (F.col("seq") + 1).alias("depth"), "digest", "bytes")
    return kept(kept_own.unionByName(borrowed), "rebuilt"), plans.select("conv_id", "length")


KEY_DDL = "conv_id long, depth long, key binary, parent binary, bytes long, paths array<array<binary>>"
KEY = pa.schema([
    ("conv_id", pa.int64()), ("depth", pa.int64()), ("key", pa.binary()), ("parent", pa.binary()), ("bytes", pa.int64()),
    ("paths", pa.list_(pa.list_(pa.binary()))),
])


def prefix_keys(rebuilt: DataFrame, lengths: DataFrame, height: int = HEIGHT, levels: int = LEVELS) -> DataFrame:
    """``conv_id, depth, key, parent, bytes, paths`` of every turn: the keys of its node, of the node above, and its paths.

    Chunks of ``height ** levels`` turns are worked on apart. Of conversations that fill a chunk the
    chunks' sums come first, and tell where each chunk goes on.
    """
    size_of_chunk = height**levels
    rows = rebuilt.withColumn("chunk", F.floor((F.col("depth") - 1) / size_of_chunk))
    several = lengths.filter(F.col("length") >= size_of_chunk).select("conv_id")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], int] = {}
        for batch in batches:
            for conv_id, depth, chunk, digest in zip(*(batch.column(n).to_pylist() for n in range(4)), strict=True):
                at = conv_id, chunk
                sums[at] = (sums.get(at, 0) + int.from_bytes(digest) * pow(BASE, depth, PRIME)) % PRIME
        made = [(conv_id, chunk, total.to_bytes(16)) for (conv_id, chunk), total in sums.items()]
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*made, strict=True)], ["conv_id", "chunk", "sum"])

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = paths = total = None

        for batch in batches:
            out = []
            for conv_id, chunk, digest in zip(*(batch.column(n).to_pylist() for n in range(3)), strict=True):
                if conv_id != now:
                    now, total, paths = conv_id, 0, Paths(ROOT, range(levels, ALL_LEVELS), height)
                carried = total.to_bytes(16)
                total = (total + int.from_bytes(digest)) % PRIME
                upper = paths.above((chunk + 1) * size_of_chunk, total.to_bytes(16))
                out.append((conv_id, chunk * size_of_chunk, chunk, carried, upper))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (
                    pa.int64(), pa.int64(), pa.int64(), pa.binary(), KEY.field("paths").type), strict=True)],
                ["conv_id", "depth", "chunk", "digest", "upper"],
            )

    part = rows.join(several, "conv_id", "left_semi").select("conv_id", "depth", "chunk", "digest")
    part = part.mapInArrow(add, "conv_id long, chunk long, sum binary")
    part = part.repartition("conv_id", "chunk").mapInArrow(_add_sums, "conv_id long, chunk long, sum binary")
    marks = part.repartition("conv_id").sortWithinPartitions("conv_id", "chunk").mapInArrow(
        chain, "conv_id long, depth long, chunk long, digest binary, upper array<array<binary>>"
    )
    every = rows.select("conv_id", "depth", "chunk", "digest", "bytes", F.lit(None).cast("array<array<binary>>").alias("upper"))
    every = every.unionByName(marks.withColumn("bytes", F.lit(None).cast("long")))
    every = every.repartition("conv_id", "chunk").sortWithinPartitions("conv_id", "chunk", "depth")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            out = []
            columns = (batch.column(n) for n in range(6))
            for conv_id, depth, chunk, digest, size, upper in zip(*(c.to_pylist() for c in columns), strict=True):
                if (conv_id, chunk) != now:
                    now, key, total, highest = (conv_id, chunk), ROOT, 0, []
                    power = pow(BASE, chunk * size_of_chunk, PRIME)
                    if size is None:
                        key, total, highest = digest, int.from_bytes(digest), upper
                    paths = Paths(key, range(levels), height)
                if size is None:
                    continue
                power = power * BASE % PRIME
                total = (total + int.from_bytes(digest) * power) % PRIME
                parent, key = key, total.to_bytes(16)
                above = paths.above(depth, key)
                out.append((conv_id, depth, key, parent, size, above + highest if depth % size_of_chunk == 0 else above))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), KEY, strict=True)], schema=KEY
                )

    return every.select("conv_id", "depth", "chunk", "digest", "bytes", "upper").mapInArrow(walk, KEY_DDL)


def _add_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[tuple[int, int], int] = {}
    for batch in batches:
        for conv_id, chunk, total in zip(*(batch.column(n).to_pylist() for n in range(3)), strict=True):
            sums[conv_id, chunk] = (sums.get((conv_id, chunk), 0) + int.from_bytes(total)) % PRIME
    if sums:
        made = [(conv_id, chunk, total.to_bytes(16)) for (conv_id, chunk), total in sums.items()]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*made, strict=True)], ["conv_id", "chunk", "sum"])


def subtree_sums(nodes: DataFrame, names: list[str], deepest: int, height: int = HEIGHT, level: int = 0) -> DataFrame:
    """``key`` and the sums of ``names`` over its subtree; nodes whose sums are all 0 may be left out.

    ``nodes`` holds ``key, depth, paths`` and the named columns. At level 0 these are all nodes, at
    each further level the band roots of the one before.
    """
    band = height ** (level + 1)
    own = F.array("key")
    upwards = F.when(F.col("depth") % band == 0, own).otherwise(F.concat(F.get("paths", F.lit(level)), own))
    some = nodes.filter(" OR ".join(f"{name} <> 0" for name in names))
    spread = some.select(F.posexplode(upwards).alias("place", "key"), *names)
    sums = [F.sum(name).alias(name) for name in names]
    # The first of a path is its band's root.
    part = spread.groupBy("key", (F.col("place") == 0).alias("root")).agg(*sums)
    if deepest < band:
        return part.select("key", *names)
    part = kept(part, "bands")
    totals = part.filter("root").select("key", *names)
    roots = nodes.filter(F.col("depth") % band == 0).select("key", "depth", "paths").join(totals, "key", "left").na.fill(0, names)
    roots = kept(roots, "roots")
    done = kept(subtree_sums(roots, names, deepest, height, level + 1), "done")
    inner = F.expr(f"slice(paths[{level}], 2, size(paths[{level}]) - 1)")
    passed = roots.filter("depth > 0").select("key", "paths").join(done, "key").select(F.explode(inner).alias("key"), *names)
    return part.filter("NOT root").select("key", *names).unionByName(passed).unionByName(done).groupBy("key").agg(*sums)


def ends_digests(ends: DataFrame) -> DataFrame:
    """``key, ends_sha256``: SHA-256 of the comma-joined ``conv_id`` of each key in ascending order.

    Ids are sorted by ranges and joined in pieces; one task meets the pieces of a key, not its rows.
    """
    order = ["key", "conv_id"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, out = None, [], []

        def piece():
            out.append((now, ids[0], ",".join(map(str, ids))))
            ids.clear()

        def batch():
            made = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["key", "first", "text"])
            out.clear()
            return made

        for part in batches:
            for key, conv_id in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                if ids and (key != now or len(ids) == PIECE):
                    piece()
                now = key
                ids.append(conv_id)
            if len(out) > 1000:
                yield batch()
        if ids:
            piece()
        if out:
            yield batch()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, running = None, None
        for part in batches:
            out = []
            for key, text in zip(part.column(0).to_pylist(), part.column(2), strict=True):
                if key == now:
                    running.update(b",")
                else:
                    if running is not None:
                        out.append((now, running.hexdigest()))
                    now, running = key, hashlib.sha256()
                running.update(text.as_py().encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["key", "ends_sha256"])
        if running is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([running.hexdigest()])], ["key", "ends_sha256"])

    sorted_ends = ends.select(*order).repartitionByRange(count_of(ends.count(), PART_ROWS), *order).sortWithinPartitions(*order)
    pieces = sorted_ends.mapInArrow(join, "key binary, first long, text string")
    return pieces.repartition("key").sortWithinPartitions("key", "first").mapInArrow(digest, "key binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, height: int = HEIGHT, levels: int = LEVELS) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    Rows of a NULL conversation do not count; NULL role and text are empty, so a row of NULLs is an
    empty turn, and repeated rows are repeated turns. Other columns are not read. A table without
    conversations has no node, not even a root. Remainders of negative ids are those of SQL.
    """
    ship(conversations.sparkSession)
    turns = kept(numbered_turns(conversations), "numbered")
    rebuilt, lengths = rebuilt_turns(turns)
    keys = kept(prefix_keys(rebuilt, lengths, height, levels), "keys")
    members = [F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")]
    same = [F.first(name).alias(name) for name in ("depth", "parent", "bytes", "paths")]
    root = lengths.agg(*members).filter("n_convs > 0").select(
        F.lit(ROOT).alias("key"), "n_convs", "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("parent"),
        F.lit(0).cast("long").alias("bytes"), F.array().cast("array<array<binary>>").alias("paths"),
    )
    nodes = kept(keys.groupBy("key").agg(*members, *same).unionByName(root), "nodes")
    children = nodes.groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, "key", "left").na.fill(0, ["n_children"])
    nodes = kept(nodes.withColumns({
        "n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("bytes"),
    }), "nodes")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    sums = subtree_sums(nodes, ["n_leaves", "saved_tokens"], deepest, height)
    ends = keys.groupBy("conv_id").agg(F.max_by("key", "depth").alias("key"))
    ends = lengths.select("conv_id").join(ends, "conv_id", "left").select("conv_id", F.coalesce("key", F.lit(ROOT)).alias("key"))
    ends = ends_digests(kept(ends, "ends"))
    rows = nodes.select("key", "conv_id", "depth", "parent", "n_convs", "n_children").join(sums, "key", "left").join(ends, "key", "left")
    above = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    rows = looked_up(kept(rows, "rows"), above, ["parent"])
    return rows.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.coalesce("n_leaves", F.lit(0)).alias("n_leaves"),
        F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )

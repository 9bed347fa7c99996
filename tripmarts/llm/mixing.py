"""Mixing sources to target weights by Pfair scheduling.

Documents of a source form blocks. With weight w, block j of a source is released at slot
floor(j / w) and due at slot ceil((j + 1) / w); every slot goes to the released block that is due
first. As the weights sum to one, all blocks are on time, and after any number of slots each source
has had its weight's share of them, less than one block more or less. When a source runs out, a new
schedule starts for the rest, in proportion to their weights, until every document has its place.

A cycle has as many slots as the weights' common denominator, so that weights are whole parts of it
without rounding, and a schedule is one cycle repeated: a table which documents look up by their
number within their source. A longer cycle than a segment is no table: the driver passes through
its slots once and keeps the state at the start of every segment, from which tasks make the slots
that documents are joined with.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Iterator, Sequence
from fractions import Fraction
from itertools import count, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmarts.llm.common import count_of

BLOCK_DOCS = 16
# Rows numbered in one task.
NUMBERED = 5000
# Slots of the longest cycle that is a table, and of a segment of longer ones.
SEGMENT = 1 << 14
OTHER = "(other)"


def exact_parts(weights: dict[str, float]) -> dict[str, int]:
    """The smallest whole parts in the very proportion of the weights, as these are written in decimals."""
    exact = {name: Fraction(str(weight)) for name, weight in weights.items()}
    unit = math.lcm(*(value.denominator for value in exact.values()))
    parts = {name: int(value * unit) for name, value in exact.items()}
    common = math.gcd(*parts.values())
    return {name: part // common for name, part in parts.items()}


def parts_of(weights: dict[str, float], cycle: int) -> dict[str, int]:
    """Whole parts of a given cycle nearly in proportion to the weights, one at least, by largest remainder."""
    if len(weights) > cycle:
        raise ValueError("more sources than slots in a cycle")
    total = sum(weights.values())
    exact = {name: weight * cycle / total for name, weight in weights.items()}
    parts = {name: max(1, int(value)) for name, value in exact.items()}
    order = sorted(exact, key=lambda name: (parts[name] - exact[name], name))
    while sum(parts.values()) < cycle:
        for name in order[: cycle - sum(parts.values())]:
            parts[name] += 1
    while sum(parts.values()) > cycle:
        largest = max(parts, key=lambda name: (parts[name] - exact[name], name) if parts[name] > 1 else (-cycle, name))
        parts[largest] -= 1
    return parts


def pfair_slots(parts: dict[str, int], waiting: list, ready: list, start: int = 0) -> Iterator[tuple[int, str, int]]:
    """(slot, source, block) from slot ``start`` on, without end: among released blocks, the earliest deadline first.

    ``waiting`` holds (release, source, block) of each source's next block if it is not released
    yet, ``ready`` (deadline, source, block) of the others. Both are kept up to date, so copies
    of them go on from the slot after the last one.
    """
    cycle = sum(parts.values())
    for slot in count(start):
        while waiting and waiting[0][0] <= slot:
            _, name, block = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(block + 1) * cycle // parts[name]), name, block))
        due, name, block = heapq.heappop(ready)
        if due <= slot:
            raise AssertionError("a deadline is missed")
        heapq.heappush(waiting, ((block + 1) * cycle // parts[name], name, block + 1))
        yield slot, name, block


def first_blocks(parts: dict[str, int]) -> list[tuple[int, str, int]]:
    return [(0, name, 0) for name in sorted(parts)]


def cycle_slots(parts: dict[str, int], blocks: dict[str, int] | None = None) -> dict[str, list[int]]:
    """Slots of each source in one cycle.

    With ``blocks`` the slots end when one source has had its number of blocks.
    """
    slots: dict[str, list[int]] = {name: [] for name in parts}
    for slot, name, block in islice(pfair_slots(parts, first_blocks(parts), []), sum(parts.values())):
        slots[name].append(slot)
        if blocks is not None and block + 1 >= blocks[name]:
            break
    return slots


def phase_segments(parts: dict[str, int], blocks: dict[str, int], size: int = SEGMENT) -> tuple[list[dict], dict[str, int]]:
    """States at the start of every ``size`` slots until a source has had its blocks, and the blocks had by then."""
    waiting, ready = first_blocks(parts), []
    had, segments = dict.fromkeys(parts, 0), []
    state = {"waiting": list(waiting), "ready": [], "first": 0}
    for slot, name, block in pfair_slots(parts, waiting, ready):
        had[name] = block + 1
        ended = had[name] >= blocks[name]
        if ended or (slot + 1) % size == 0:
            segments.append(state | {"slots": slot + 1 - state["first"]})
            state = {"waiting": list(waiting), "ready": list(ready), "first": slot + 1}
        if ended:
            return segments, had


def _segment_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, block, slot) of segments in JSON."""
    for batch in batches:
        for text in batch.column(0).to_pylist():
            one = json.loads(text)
            waiting, ready = ([tuple(item) for item in one[name]] for name in ("waiting", "ready"))
            made = islice(pfair_slots(one["parts"], waiting, ready, one["first"]), one["slots"])
            rows = [(name, one["done"][name] + block, one["start"] + slot) for slot, name, block in made]
            columns = zip(*rows, strict=True)
            types = (pa.string(), pa.int64(), pa.int64())
            arrays = [pa.array(column, kind) for column, kind in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["part", "block", "long_slot"])


def schedule(
    blocks: dict[str, int], weights: dict[str, float], cycle: int | None = None, segments: list[str] | None = None,
    segment: int = SEGMENT,
) -> list[tuple]:
    """Rows (source, first block, first slot, slots of a cycle, cycle length) for every phase.

    A phase lasts until a source has had its last block. Weights count exactly, unless a ``cycle``
    is given, to whose parts they are rounded. With a list ``segments``, phases whose cycle is
    longer than ``segment`` slots give no rows; their segments are added to it as JSON.
    """
    done = dict.fromkeys(blocks, 0)
    start, rows = 0, []
    while True:
        active = {name: weights.get(name, 0.0) for name in blocks if done[name] < blocks[name]}
        if not active:
            return rows
        weighted = {name: weight for name, weight in active.items() if weight > 0}
        weighted = weighted or dict.fromkeys(active, 1.0)
        parts = exact_parts(weighted) if cycle is None else parts_of(weighted, cycle)
        length = sum(parts.values())
        if segments is not None and length > segment:
            cut, had = phase_segments(parts, {name: blocks[name] - done[name] for name in parts}, segment)
            before = {name: done[name] for name in parts}
            segments += [json.dumps(one | {"parts": parts, "done": before, "start": start}) for one in cut]
            for name, number in had.items():
                done[name] += number
            start += sum(had.values())
            continue
        slots = cycle_slots(parts, {name: blocks[name] - done[name] for name in parts})
        made = sum(map(len, slots.values()))
        if made < length:
            end = made - 1
        else:
            last = []
            for name, own in slots.items():
                whole, rest = divmod(blocks[name] - done[name] - 1, len(own))
                last.append(whole * length + own[rest])
            end = min(last)
        for name, own in slots.items():
            # In a phase shorter than its cycle a source may have no slot.
            if own:
                rows.append((name, done[name], start, own, length))
            whole, rest = divmod(end + 1, length)
            done[name] += whole * len(own) + sum(slot < rest for slot in own)
        start += end + 1


def _placed(
    documents: DataFrame, weights: dict[str, float], *, other_weight: float = 0.0, key: str = "doc_id",
    source: str = "source", block_docs: int = BLOCK_DOCS, cycle: int | None = None, numbered: int = NUMBERED,
    segment: int = SEGMENT, ties: Sequence[str | Column] = (),
) -> DataFrame:
    """The documents as one struct ``doc``, and ``part, block, slot, position``."""
    name = F.when(F.col(source).isin(*weights), F.col(source)).otherwise(OTHER) if weights else F.lit(OTHER)
    marks = {f"tie{n}": F.col(tie) if isinstance(tie, str) else tie for n, tie in enumerate(ties)}
    rows = documents.select(
        F.struct("*").alias("doc"), name.alias("part"), F.col(key).alias("key"), *[tie.alias(n) for n, tie in marks.items()]
    )
    sizes = {row[0]: row[1] for row in rows.groupBy("part").count().collect()}
    blocks = {one: -(-size // block_docs) for one, size in sizes.items()}
    segments: list[str] = []
    plan = schedule(blocks, weights | {OTHER: other_weight}, cycle, segments, segment)
    deals = count_of(max(sizes.values(), default=1), numbered)
    rows = rows.withColumn("deal", F.pmod(F.xxhash64("key"), F.lit(deals)).cast("int"))
    # One row for each source and deal: how many of the source's rows stand before.
    counts = rows.groupBy("part", "deal").agg(F.count("*").alias("held"))
    order = Window.partitionBy("part").orderBy("deal")
    before = F.sum("held").over(order.rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("part", "deal", F.coalesce(before, F.lit(0)).alias("before"))
    inside = Window.partitionBy("part", "deal").orderBy(F.xxhash64("key"), "key", *marks)
    rows = rows.withColumn("number", F.row_number().over(inside) - 1)
    rows = rows.join(counts, ["part", "deal"])
    number = F.col("before") + F.col("number")
    rows = rows.withColumns({"block": F.floor(number / block_docs), "offset": number % block_docs})
    # The plan has a row for each source and phase, both bounded by the number of weights, and slots by a segment.
    spark = documents.sparkSession
    phases = spark.createDataFrame(
        plan, "part string, first_block long, first_slot long, slots array<long>, cycle long"
    )
    phases = phases.groupBy("part").agg(
        F.array_sort(F.collect_list(F.struct("first_block", "first_slot", "slots", "cycle"))).alias("phases")
    )
    rows = rows.join(F.broadcast(phases), "part", "left")
    begun = F.filter("phases", lambda one: one["first_block"] <= F.col("block"))
    rows = rows.withColumn("phase", F.try_element_at(begun, F.lit(-1)))
    inner = F.col("block") - F.col("phase.first_block")
    size = F.size("phase.slots")
    slot = F.col("phase.first_slot") + F.floor(inner / size) * F.col("phase.cycle") + F.get(
        F.col("phase.slots"), (inner % size).cast("int")
    )
    if segments:
        long = spark.createDataFrame([(one,) for one in segments], "segment string")
        rows = rows.join(long.mapInArrow(_segment_slots, "part string, block long, long_slot long"), ["part", "block"], "left")
        slot = F.coalesce("long_slot", slot)
    rows = rows.withColumn("slot", slot.cast("long"))
    rows = rows.withColumn("position", (F.col("slot") * block_docs + F.col("offset")).cast("long"))
    return rows.select("doc", "part", "block", "slot", "position")


def mix(documents: DataFrame, weights: dict[str, float], **options) -> DataFrame:
    """All columns of ``documents`` and ``mix_source, mix_block, mix_slot, mix_position``.

    ``weights`` names the sources; rows of others, and of NULL, form one source of weight
    ``other_weight``, and with weight 0 they follow when the others are through. Sorting by
    ``mix_position`` gives the mix; nothing is dropped or repeated. Documents of a source keep an
    order drawn from their keys; equal keys are ordered by ``ties``, names or expressions over the
    documents, and without them in any way. An empty table stays empty. A column of the documents
    that has the name of one of the four, in any case, is returned with ``own_`` before its name.

    Numbering splits every source by key hash, so a source of any size is many tasks' work.
    Other options: ``key``, ``source``, ``block_docs``, ``cycle``, ``numbered``, ``segment``.
    """
    made = ("mix_source", "mix_block", "mix_slot", "mix_position")
    taken, names = {name.lower() for name in (*made, *documents.columns)}, []
    for name in documents.columns:
        if name.lower() in made:
            name = f"own_{name}"
            while name.lower() in taken:
                name = f"own_{name}"
            taken.add(name.lower())
        names.append(name)
    rows = _placed(documents, weights, **options)
    rest = [F.col(column).alias(name) for column, name in zip(("part", "block", "slot", "position"), made, strict=True)]
    fields = [F.col("doc").getField(name).alias(new) for name, new in zip(documents.columns, names, strict=True)]
    return rows.select(*fields, *rest)


def in_mix_order(documents: DataFrame, weights: dict[str, float], **options) -> DataFrame:
    """The documents, all columns as they are, in the order of :func:`mix`: files and rows of a file follow it."""
    rows = _placed(documents, weights, **options)
    return rows.repartitionByRange(F.col("position")).sortWithinPartitions("position").select("doc.*")

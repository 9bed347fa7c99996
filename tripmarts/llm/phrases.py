"""Phrase collocations by multikey quicksort of suffix pointers.

Words are counted first, then pairs of frequent words in a hashed table of fixed size. A place of a
text whose leading pair can be frequent becomes a suffix pointer: its words up to the first pair
that cannot be frequent, five at most. Pointers are routed by language and leading pair; each
slot's pointers are partitioned three ways by one word after the other, and the weight of an
equal partition is the count of its phrase. Lighter partitions than a candidate needs are left.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmarts.llm.common import count_of, kept, looked_up, ship

LEAST = 100
DEPTH = 5
BEST = 2000
# Counters of the hashed pair table: about one for each 16 words, within these bounds (powers of 2).
FEWEST_BITS, MOST_BITS = 16, 30
# Ranges of the pair table, each summed by one task.
RANGES = 64
# Distinct words or pairs that a task gathers before it passes them on.
GATHERED = 1 << 20
# Weight of the pointers of one task, about, and slots that they are sorted in.
TASK_WEIGHT, SLOTS = 1 << 19, 4
# A pair of more than this share of all pointers is dealt out to several tasks.
HOT_SHARE = 512

_STOP = b"."
_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else 0x2E if b in b".,;:!?\n\x0b\x0c\r" else 0x20 if b == 9 else b for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words in UTF-8; a lone stop ends a piece and is never a word."""
    return (text or "").encode("utf-8").translate(_BYTES).replace(_STOP, b" . ").split()


class _Codes(dict):
    """Numbers words from 1; 0 is the end of a piece."""

    def __init__(self):
        super().__init__({_STOP: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, _Codes, np.ndarray]]:
    """Language, codes and coded words of every few texts; codes start anew when there are many."""
    known: dict[str, _Codes] = {}
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            groups: dict[str, list[bytes]] = {}
            for lang, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                groups.setdefault(lang, []).extend([*words_of(text.as_py()), _STOP])
            for lang, words in groups.items():
                codes = known.setdefault(lang, _Codes())
                yield lang, codes, np.fromiter(map(codes.__getitem__, words), np.int64, len(words))
                if len(codes) > GATHERED:
                    del known[lang]


def _hashes(lang: str, words: list[bytes]) -> np.ndarray:
    import xxhash

    # As Spark's xxhash64(lang, word).
    seed = xxhash.xxh64_intdigest(lang.encode(), 42)
    return np.array([xxhash.xxh64_intdigest(word, seed) for word in words], np.uint64)


def _pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    mixed = (first * np.uint64(0x9E3779B97F4A7C15)) ^ second
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(29))


def word_counts(rows: DataFrame) -> DataFrame:
    """``lang, word, f`` of all words of ``lang, text`` rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[_Codes, np.ndarray]] = {}

        def batch(lang):
            codes, counts = held.pop(lang)
            listed = [word.decode() for word in codes][1:]
            counts = counts[1 : len(codes)]
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(listed)), pa.array(listed, pa.string()), pa.array(counts)], ["lang", "word", "f"]
            )

        for lang, codes, coded in _coded(batches):
            if lang in held and held[lang][0] is not codes:
                yield batch(lang)
            counts = held[lang][1] if lang in held else np.zeros(1024, np.int64)
            if len(codes) > len(counts):
                counts = np.pad(counts, (0, max(len(codes), 2 * len(counts)) - len(counts)))
            counts[: len(codes)] += np.bincount(coded, minlength=len(codes))
            held[lang] = codes, counts
        for lang in list(held):
            yield batch(lang)

    return rows.mapInArrow(count, "lang string, word string, f long").groupBy("lang", "word").agg(F.sum("f").alias("f"))


def _bitmap(found: DataFrame, width: int):
    """Broadcast bitmap of ``2 ** width`` bits with those in the column ``at`` set."""
    number = F.col("at") + 1
    maps = found.groupBy(F.bitmap_bucket_number(number).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits")
    )
    out = np.zeros((1 << width) // 8, np.uint8)
    for row in maps.collect():
        out[(row.bucket - 1) * 4096 : row.bucket * 4096] = np.frombuffer(row.bits, np.uint8)
    return found.sparkSession.sparkContext.broadcast(out)


def _has(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the bits are set; the lowest bit of a byte comes first."""
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


class _Frequent:
    """For coded words: which can be frequent, and the hash of each."""

    def __init__(self, bits: np.ndarray, width: int):
        self.bits, self.width, self.known = bits, width, {}

    def of(self, lang: str, codes: _Codes) -> tuple[np.ndarray, np.ndarray]:
        hashes, may, owner = self.known.get(lang, (np.zeros(1, np.uint64), np.zeros(1, bool), None))
        if owner is not codes:
            hashes, may = np.zeros(1, np.uint64), np.zeros(1, bool)
        if len(codes) > len(hashes):
            fresh = _hashes(lang, list(islice(codes, len(hashes), None)))
            hashes = np.append(hashes, fresh)
            may = np.append(may, _has(self.bits, (fresh >> np.uint64(64 - self.width)).astype(np.int64)))
        self.known[lang] = hashes, may, codes
        return hashes, may


def pair_table(rows: DataFrame, words, width: int, least: int) -> DataFrame:
    """``at, f`` of the counters of the hashed pair table with ``least`` or more; a pair's own count is no higher.

    ``words`` is the bitmap of words that can be frequent, as a broadcast.
    """
    span = 1 << (width - RANGES.bit_length() + 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, held, size = _Frequent(words.value, width), [], 0

        def batch():
            at, counts = np.unique(np.concatenate(held), return_counts=True)
            cuts = np.searchsorted(at, np.arange(RANGES + 1) * span)
            parts = [(n, (at[a:b] - n * span).astype("<u4").tobytes(), counts[a:b].astype("<u4").tobytes())
                     for n, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
            return pa.RecordBatch.from_arrays(
                [pa.array(column) for column in zip(*parts, strict=True)], ["range", "at", "counts"]
            )

        for lang, codes, coded in _coded(batches):
            hashes, may = frequent.of(lang, codes)
            both = np.flatnonzero(may[coded[:-1]] & may[coded[1:]])
            if len(both):
                hashed = _pair_hash(hashes[coded[both]], hashes[coded[both + 1]])
                held.append((hashed >> np.uint64(64 - width)).astype(np.int64))
                size += len(both)
            if size > 4 * GATHERED:
                yield batch()
                held, size = [], 0
        if held:
            yield batch()

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counters = None, None

        def batch():
            high = np.flatnonzero(counters >= least)
            return pa.RecordBatch.from_arrays([pa.array(high + now * span), pa.array(counters[high])], ["at", "f"])

        for part in batches:
            for number, at, counts in zip(*(part.column(n) for n in range(3)), strict=True):
                if number.as_py() != now:
                    if now is not None:
                        yield batch()
                    now, counters = number.as_py(), np.zeros(span, np.int64)
                counters[np.frombuffer(at.as_py(), "<u4")] += np.frombuffer(counts.as_py(), "<u4")
        if now is not None:
            yield batch()

    partial = rows.mapInArrow(count, "range long, at binary, counts binary")
    return partial.repartition(RANGES, "range").sortWithinPartitions("range").mapInArrow(total, "at long, f long")


def pointers(rows: DataFrame, words, pairs, hot: dict[int, int], width: int, slots: int) -> DataFrame:
    """``slot, lang, words, codes, dealt, f``: suffix pointers by the slot that their leading pair falls into.

    Equal pointers of a task are one with their number in ``f``, and those of a slot are one row:
    their words, and five places in them for each pointer, 0 for none. ``words`` and ``pairs`` are
    broadcast bitmaps. ``hot`` tells into how many parts a counter's pointers are dealt, by all their words.
    """

    def point(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, bits = _Frequent(words.value, width), pairs.value
        held: dict[str, tuple[_Codes, list[np.ndarray]]] = {}
        size = 0

        def batch(lang):
            codes, parts = held.pop(lang)
            hashes, _ = frequent.of(lang, codes)
            rows = np.concatenate(parts)
            order = np.lexsort(rows.T[::-1])
            rows = rows[order]
            first = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]).any(axis=1)))
            counts, rows = np.diff(first, append=len(rows)), rows[first]
            at = (_pair_hash(hashes[rows[:, 0]], hashes[rows[:, 1]]) >> np.uint64(64 - width)).astype(np.int64)
            mixed = hashes[rows[:, 2]]
            for n in range(3, DEPTH):
                mixed = _pair_hash(mixed, hashes[rows[:, n]])
            dealt = np.array([hot.get(x, 1) for x in at.tolist()], np.uint64)
            part = (mixed % dealt).astype(np.int64)
            slot = (_pair_hash(at.astype(np.uint64), part.astype(np.uint64)) % np.uint64(slots)).astype(np.int64)
            order = np.argsort(slot, kind="stable")
            slot, rows, counts, dealt = slot[order], rows[order], counts[order], dealt[order] > 1
            first = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))
            names, made = list(codes), {name: [] for name in _POINTERS.names}
            for a, b in zip(first, [*first[1:], len(slot)], strict=True):
                used, local = np.unique(rows[a:b], return_inverse=True)
                listed = [names[n].decode() for n in used.tolist() if n]
                local = local.reshape(-1, DEPTH) + (used[0] > 0)
                for name, value in zip(_POINTERS.names, (
                    int(slot[a]), lang, listed, local.astype("<i4").tobytes(), dealt[a:b].tobytes(), counts[a:b].astype("<i8").tobytes()
                ), strict=True):
                    made[name].append(value)
            return pa.RecordBatch.from_pydict(made, _POINTERS)

        for lang, codes, coded in _coded(batches):
            if lang in held and held[lang][0] is not codes:
                size -= sum(map(len, held[lang][1]))
                yield batch(lang)
            hashes, may = frequent.of(lang, codes)
            runs = may[coded[:-1]] & may[coded[1:]]
            both = np.flatnonzero(runs)
            hashed = _pair_hash(hashes[coded[both]], hashes[coded[both + 1]])
            runs[both] = _has(bits, (hashed >> np.uint64(64 - width)).astype(np.int64))
            starts = np.flatnonzero(runs)
            if not len(starts):
                continue
            made = np.zeros((len(starts), DEPTH), np.int64)
            made[:, 0], made[:, 1] = coded[starts], coded[starts + 1]
            live = np.arange(len(starts))
            for n in range(2, DEPTH):
                at = starts[live] + n - 1
                live = live[(at < len(runs)) & runs[np.minimum(at, len(runs) - 1)]]
                made[live, n] = coded[starts[live] + n]
            held.setdefault(lang, (codes, []))[1].append(made)
            size += len(made)
            if size > GATHERED:
                for lang in list(held):
                    yield batch(lang)
                size = 0
        for lang in list(held):
            yield batch(lang)

    return rows.mapInArrow(
        point, "slot long, lang string, words array<string>, codes binary, dealt binary, f binary"
    )


_POINTERS = pa.schema([
    ("slot", pa.int64()), ("lang", pa.string()), ("words", pa.list_(pa.string())), ("codes", pa.binary()),
    ("dealt", pa.binary()), ("f", pa.binary()),
])


def quicksort_counts(rows: np.ndarray, weights: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, int]]:
    """Prefixes of two codes or more of the rows with their weight, where that is ``least`` or more.

    Rows are codes above 0, ended by zeros. A partition of equal codes goes on with the next place,
    those of lower and higher codes with the same one; a partition below ``least`` is left.
    """
    stack = [(np.arange(len(rows)), 0)]
    while stack:
        at, depth = stack.pop()
        if weights[at].sum() < least:
            continue
        column = rows[at, depth]
        pivot = np.partition(column, len(column) // 2)[len(column) // 2]
        if pivot:
            equal = at[column == pivot]
            weight = int(weights[equal].sum())
            if weight >= least:
                if depth:
                    yield rows[equal[0], : depth + 1], weight
                if depth + 1 < rows.shape[1]:
                    stack.append((equal, depth + 1))
        higher = at[column > pivot]
        lower = at[(column < pivot) & (column > 0)]
        stack += [(part, depth) for part in (lower, higher) if len(part)]


def phrase_counts(routed: DataFrame, least: int) -> DataFrame:
    """``lang, words, f``: phrases of two words and more with their counts, from rows of ``pointers`` sorted by slot."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def batch():
            index, langs, parts = {}, {}, []
            for lang, words, codes, dealt, _ in held:
                lookup = np.array([0, *(index.setdefault(word, len(index) + 1) for word in words)], np.int64)
                codes = lookup[np.frombuffer(codes, "<i4").reshape(-1, DEPTH)]
                # Languages, and pointers that are dealt out, are kept apart by a number in front.
                front = 1 + 2 * langs.setdefault(lang, len(langs)) + np.frombuffer(dealt, bool)
                parts.append(np.column_stack([front, codes]))
            rows = np.concatenate(parts)
            weights = np.concatenate([np.frombuffer(f, "<i8") for *_, f in held])
            named, words = list(langs), list(index)
            made = {"lang": [], "words": [], "f": []}
            # The parts of a pair that was dealt out are sums of their own: only their totals tell.
            for some, wanted in ((rows[:, 0] % 2 == 1, least), (rows[:, 0] % 2 == 0, 1)):
                if not some.any():
                    continue
                for codes, weight in quicksort_counts(rows[some], weights[some], wanted):
                    if len(codes) > 2:
                        made["lang"].append(named[(codes[0] - 1) // 2])
                        made["words"].append([words[n - 1] for n in codes[1:]])
                        made["f"].append(weight)
            return pa.RecordBatch.from_pydict(made, _PHRASE)

        for part in batches:
            for slot, *row in zip(*(column.to_pylist() for column in part.columns), strict=True):
                if slot != now and held:
                    yield batch()
                    held.clear()
                now = slot
                held.append(row)
        if held:
            yield batch()

    return routed.mapInArrow(sort, "lang string, words array<string>, f long")


_PHRASE = pa.schema([("lang", pa.string()), ("words", pa.list_(pa.string())), ("f", pa.int64())])


def frequent_phrases(rows: DataFrame, counts: DataFrame, least: int) -> DataFrame:
    """``lang, words, f`` of phrases of two to five words met ``least`` times or more in ``lang, text`` rows.

    ``counts`` are the words' counts, as a table. The bitmaps of words and of pairs pass through the
    driver: at most 2 ** MOST_BITS bits each, whatever the corpus. They only leave out what cannot
    be frequent.
    """
    total = counts.agg(F.sum("f")).first()[0] or 0
    width = min(MOST_BITS, max(FEWEST_BITS, (total // 16).bit_length()))
    place = F.shiftrightunsigned(F.xxhash64("lang", "word"), 64 - width)
    words = _bitmap(counts.filter(F.col("f") >= least).select(place.alias("at")), width)
    table = kept(pair_table(rows, words, width, least), "pairs")
    weight = table.agg(F.sum("f")).first()[0] or 0
    limit = max(least, weight // HOT_SHARE)
    # Fewer than HOT_SHARE counters hold more than that share of the pointers.
    hot = {row["at"]: -(-row.f // limit) for row in table.filter(F.col("f") > limit).collect()}
    parts = count_of(weight, TASK_WEIGHT)
    made = pointers(rows, words, _bitmap(table, width), hot, width, SLOTS * parts)
    routed = made.repartition(parts, "slot").sortWithinPartitions("slot")
    found = phrase_counts(routed, least).groupBy("lang", "words").agg(F.sum("f").alias("f"))
    return found.filter(F.col("f") >= least)


def collocations(
    documents: DataFrame, *, text: str = "text", lang: str = "lang", least: int = LEAST, best: int = BEST
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``best`` phrases of two to five words.

    Words are lower-cased (A-Z); phrases stay within pieces between stops. A phrase met ``a >= least``
    times is cut in two where ``floor(1000 * a * n / (l * r))`` is lowest, ``n`` being the language's
    words, ``l`` and ``r`` the counts of both parts. A phrase that a longer one of equal count contains
    does not count. NULL languages are ``und``, NULL texts are empty; no phrase, no rows. Products are
    decimals of 38 digits: exact up to 10 ** 17 words.
    """
    ship(documents.sparkSession)
    rows = documents.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )
    counts = kept(word_counts(rows), "words")
    phrases = kept(frequent_phrases(rows, counts, least), "phrases")
    named = phrases.withColumn("phrase", F.array_join("words", " "))
    longer = named.filter(F.size("words") > 2)
    inside = longer.select("lang", "f", F.explode(F.array(
        F.array_join(F.slice("words", F.lit(1), F.size("words") - 1), " "), F.array_join(F.slice("words", F.lit(2), F.size("words") - 1), " ")
    )).alias("phrase"))
    # What a phrase two words longer contains as often, one a word longer does.
    inside = inside.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    single = named.join(inside, ["lang", "phrase"], "left").filter("longer IS NULL OR longer < f")
    cuts = single.select("lang", "phrase", F.col("f").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    sides = cuts.select("lang", "phrase", "a", "k", F.inline(F.array(
        F.struct(F.lit("l").alias("side"), F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("part")),
        F.struct(F.lit("r").alias("side"), F.array_join(F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")), " ").alias("part")),
    )))
    known = named.select("lang", F.col("phrase").alias("part"), F.col("f").alias("held")).unionByName(
        counts.filter(F.col("f") >= least).select("lang", F.col("word").alias("part"), F.col("f").alias("held"))
    )
    sides = looked_up(kept(sides, "cuts"), known, ["lang", "part"])
    side = [F.max(F.when(F.col("side") == name, F.col("held"))).alias(name) for name in ("l", "r")]
    both = kept(sides.groupBy("lang", "phrase", "a", "k").agg(*side), "sides")
    both = looked_up(both, counts.groupBy("lang").agg(F.sum("f").alias("n")), ["lang"])
    whole = {name: F.col(name).cast("decimal(19,0)") for name in "lrn"}
    wide = both.select(
        "*", ((F.col("a") * 1000).cast("decimal(19,0)") * whole["n"]).alias("_over"), (whole["l"] * whole["r"]).alias("_under")
    )
    scored = wide.select("lang", "phrase", "a", "n", F.struct(F.expr("_over div _under").alias("score"), "k", "l", "r").alias("cut"))
    lowest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min("cut").alias("cut"))
    lowest = lowest.select("lang", "phrase", "a", "n", "cut.*")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = lowest.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

"""Benchmark decontamination with suffix arrays of the training texts.

Training words become codes, and the suffixes of a shard's documents are sorted once (prefix
doubling on the places that are still tied). Every suffix of every test item is then looked up by
binary search in every shard. Test items come in blocks of bounded size, so neither the number of
documents nor that of items is limited.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmarts.llm.common import kept, ship

# Words of a match; a shorter item is one match as a whole.
LEAST_WORDS = 10
# Words of a shard, about; a longer document is a shard of its own.
SHARD_WORDS = 1 << 21
# Bytes of the test texts that are searched together, about.
BLOCK_BYTES = 1 << 24
# Occurrences that are joined into matches together, about.
STEP = 1 << 21
_LETTERS = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_WORDS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _LETTERS else 0x20 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and characters beyond ASCII, in UTF-8."""
    return (text or "").encode("utf-8").translate(_WORDS).split()


def suffix_order(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places of ``codes`` (1 and above) in the order of the suffixes that start there.

    A suffix ends with its document; ``ends`` are the documents' ends in ascending order. Equal
    suffixes are in no particular order.
    """
    n = len(codes)
    left = np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(n)
    bits = int(codes.max(initial=1)).bit_length()
    depth = 3 if 3 * bits <= 63 else 2
    key = codes.astype(np.int64)
    for k in range(1, depth):
        following = np.zeros(n, np.int64)
        following[: n - k] = codes[k:]
        following[left <= k] = 0
        key = key << bits | following
    order = np.argsort(key)
    key = key[order]
    rank, slots = np.empty(n, np.int64), np.arange(n)
    while True:
        # ``slots`` are the places of the order that were just sorted, ``key`` their sort keys.
        first = np.append(True, key[1:] != key[:-1]) if len(key) else np.zeros(0, bool)
        starts = np.flatnonzero(first)
        sizes = np.diff(starts, append=len(key))
        rank[order[slots]] = np.repeat(slots[starts], sizes) + 1
        tied = np.repeat(sizes > 1, sizes) & (left[order[slots]] >= depth)
        slots = slots[tied]
        if not len(slots):
            return order
        at = order[slots]
        following = np.zeros(len(at), np.int64)
        inside = left[at] > depth
        following[inside] = rank[at[inside] + depth]
        key = rank[at] << 32 | following
        sort = np.argsort(key)
        order[slots], key = at[sort], key[sort]
        depth *= 2


def build_index(documents: DataFrame, *, key: str = "doc_id", text: str = "text", shard_words: int = SHARD_WORDS) -> DataFrame:
    """Shards ``shard, doc_ids, marks, ends, vocabulary, codes, suffixes``: whole documents and their sorted suffixes.

    ``marks`` are hashes of the texts. A NULL text has no words. Every row is a document of its own, with whatever key. Other columns
    are not read; an empty table has no shards. Keep the result as a table to search it often.
    """
    ship(documents.sparkSession)
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = documents.select(F.col(key).cast("long"), F.xxhash64(body), body)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        index, doc_ids, marks, held, size = _Codes(), [], [], [], 0

        def shard():
            codes = np.concatenate(held) if held else np.zeros(0, np.int32)
            ends = np.cumsum([len(one) for one in held], dtype=np.int64)
            blobs = [ends.astype("<i8").tobytes(), b" ".join(index), codes.astype("<i4").tobytes(),
                     suffix_order(codes, ends).astype("<i4").tobytes()]
            return pa.RecordBatch.from_arrays(
                [pa.array([part << 32 | number], pa.int64())]
                + [pa.array([listed], pa.list_(pa.int64())) for listed in (doc_ids, marks)]
                + [pa.array([_packed(blob)], pa.binary()) for blob in blobs],
                ["shard", "doc_ids", "marks", "ends", "vocabulary", "codes", "suffixes"],
            )

        for batch in batches:
            for doc_id, mark, body in zip(*(batch.column(n) for n in range(3)), strict=True):
                words = words_of(body.as_py())
                doc_ids.append(doc_id.as_py())
                marks.append(mark.as_py())
                held.append(np.fromiter(map(index.__getitem__, words), np.int32, len(words)))
                size += len(words)
                if size >= shard_words:
                    yield shard()
                    index, doc_ids, marks, held, size, number = _Codes(), [], [], [], 0, number + 1
        if doc_ids:
            yield shard()

    return rows.mapInArrow(
        build, "shard long, doc_ids array<long>, marks array<long>, ends binary, vocabulary binary, codes binary, suffixes binary"
    )


class _Codes(dict):
    """Numbers words from 1 in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self) + 1
        return number


def _packed(blob: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(blob)


def _unpacked(blob: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(blob)


class Items:
    """A block of test items: their words as codes of the block, and where each starts."""

    def __init__(self, texts: list[str | None]):
        index = _Codes()
        coded = [[index[word] for word in words_of(text)] for text in texts]
        self.vocabulary = list(index)
        self.lengths = np.array([len(one) for one in coded], np.int64)
        self.codes = np.array([code for one in coded for code in one], np.int64)
        self.owner = np.repeat(np.arange(len(coded)), self.lengths)
        self.place = np.arange(len(self.codes)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        self.left = self.lengths[self.owner] - self.place


class Shard:
    """A shard's codes and sorted suffixes, ready for binary search."""

    def __init__(self, ends: bytes, vocabulary: bytes, codes: bytes, suffixes: bytes):
        self.ends = np.frombuffer(_unpacked(ends), "<i8")
        self.words = _unpacked(vocabulary).split(b" ")
        self.codes = np.frombuffer(_unpacked(codes), "<i4")
        self.order = np.frombuffer(_unpacked(suffixes), "<i4")
        self.document = np.repeat(np.arange(len(self.ends)), np.diff(self.ends, prepend=0))

    def find(self, items: Items, least: int = LEAST_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For every item suffix: its longest match in words, and the range of suffixes that share its first window.

        The window of an item is its ``least`` words from a place on, or the whole of a shorter item;
        suffixes shorter than that have an empty range. Returned: longest, low, high, window.
        """
        numbers = dict(zip(self.words, range(1, len(self.words) + 1), strict=True)) if len(self.codes) else {}
        table = np.array([0, *(numbers.get(word, 0) for word in items.vocabulary)], np.int64)
        codes = table[items.codes]
        window = np.minimum(least, items.lengths)[items.owner] if len(codes) else np.zeros(0, np.int64)
        counts = np.bincount(self.codes, minlength=len(self.words) + 2)
        before = np.concatenate([[0], np.cumsum(counts)])
        low, high = before[codes], np.where(codes > 0, before[codes + 1], 0)
        longest = (high > low).astype(np.int64)
        found_low, found_high = np.zeros_like(low), np.zeros_like(high)
        live = np.flatnonzero(high > low)
        depth = 1
        while len(live):
            whole = live[window[live] == depth]
            found_low[whole], found_high[whole] = low[whole], high[whole]
            live = live[items.left[live] > depth]
            wanted = codes[live + depth]
            live, wanted = live[wanted > 0], wanted[wanted > 0]
            low[live], high[live] = (self._bound(low[live], high[live], depth, wanted, right) for right in (False, True))
            live = live[high[live] > low[live]]
            depth += 1
            longest[live] = depth
        return longest, found_low, found_high, window

    def _bound(self, low: np.ndarray, high: np.ndarray, depth: int, wanted: np.ndarray, right: bool) -> np.ndarray:
        """First place of each range whose word at ``depth`` is not below (or is above) the wanted one."""
        low, high = low.copy(), high.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            middle = (low[open_] + high[open_]) >> 1
            at = self.order[middle].astype(np.int64)
            inside = at + depth < self.ends[self.document[at]]
            word = np.where(inside, self.codes[np.minimum(at + depth, len(self.codes) - 1)], 0)
            below = word <= wanted[open_] if right else word < wanted[open_]
            low[open_[below]], high[open_[~below]] = middle[below] + 1, middle[~below]

    def matches(self, items: Items, least: int = LEAST_WORDS) -> Iterator[np.ndarray]:
        """Maximal verbatim matches in rows ``document, start, n_words, item, item_start``; starts count words.

        Windows that follow each other in document and item are one match.
        """
        _, low, high, window = self.find(items, least)
        sizes = high - low
        used = np.flatnonzero(sizes)
        # Items are whole within a step.
        reached = np.cumsum(sizes[used])
        step = reached // STEP
        last = np.append(items.owner[used][1:] != items.owner[used][:-1], True) if len(used) else np.zeros(0, bool)
        borders = np.flatnonzero(last)
        cuts = borders[np.append(step[borders][1:] != step[borders][:-1], True)] + 1 if len(borders) else []
        for part in np.split(used, cuts):
            if not len(part):
                continue
            size = sizes[part]
            suffix = np.repeat(part, size)
            at = np.repeat(low[part] - np.cumsum(size) + size, size) + np.arange(size.sum())
            place = self.order[at].astype(np.int64)
            item, item_start = items.owner[suffix], items.place[suffix]
            document = self.document[place]
            start = place - np.concatenate([[0], self.ends[:-1]])[document]
            sort = np.lexsort((start, start - item_start, document, item))
            item, item_start, document, start, length = (x[sort] for x in (item, item_start, document, start, window[suffix]))
            fresh = np.ones(len(item), bool)
            fresh[1:] = (item[1:] != item[:-1]) | (document[1:] != document[:-1]) | (start[1:] != start[:-1] + 1) | (
                item_start[1:] != item_start[:-1] + 1
            )
            first = np.flatnonzero(fresh)
            runs = np.diff(first, append=len(fresh))
            yield np.stack([document[first], start[first], length[first] + runs - 1, item[first], item_start[first]])


MATCH_DDL = (
    "shard long, row int, doc_id long, mark long, n_words long, start array<int>, length array<int>, "
    "item_id array<long>, item_start array<int>"
)


def find_matches(index: DataFrame, tests: DataFrame, *, key: str = "item_id", text: str = "text", least: int = LEAST_WORDS) -> DataFrame:
    """``shard, row, doc_id, n_words`` of every indexed document and its matches as four arrays of equal length.

    A match is a run of words (``start``, ``length``) equal to words of an item from ``item_start``
    on, of ``least`` words at least or a whole shorter item, and as long as it can be. NULL and
    wordless items match nothing. Items with a NULL key match under a NULL ``item_id``.
    """
    spark = index.sparkSession
    items = tests.select(F.col(key).cast("long").alias("item_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-int(total) // BLOCK_BYTES))
    found = []
    for block in range(blocks):
        # One block of about BLOCK_BYTES at a time passes through the driver.
        chosen = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).toArrow()
        sent = spark.sparkContext.broadcast((chosen["item_id"].to_pylist(), chosen["text"].to_pylist()))
        found.append(index.mapInArrow(_search(sent, least, block == 0), MATCH_DDL))
    if blocks == 1:
        return found[0]
    every = found[0]
    for one in found[1:]:
        every = every.unionByName(one)
    joined = [F.flatten(F.collect_list(name)).alias(name) for name in ("start", "length", "item_id", "item_start")]
    return every.groupBy("shard", "row").agg(*[F.max(name).alias(name) for name in ("doc_id", "mark", "n_words")], *joined)


def _search(sent, least: int, every: bool):
    """Matches of one block of items; documents without any are listed if ``every``."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item_ids, texts = sent.value
        items = Items(texts)
        item_ids = pa.array(item_ids, pa.int64())
        for batch in batches:
            for n in range(batch.num_rows):
                row = {name: batch.column(name)[n] for name in batch.schema.names}
                shard = Shard(*(row[name].as_py() for name in ("ends", "vocabulary", "codes", "suffixes")))
                parts = list(shard.matches(items, least))
                made = np.concatenate(parts, axis=1) if parts else np.zeros((5, 0), np.int64)
                made = made[:, np.lexsort((made[3], made[1], made[0]))]
                documents = len(shard.ends)
                offsets = np.concatenate([[0], np.cumsum(np.bincount(made[0], minlength=documents))]).astype(np.int32)
                lists = [pa.array(made[1], pa.int32()), pa.array(made[2], pa.int32()),
                         item_ids.take(pa.array(made[3])), pa.array(made[4], pa.int32())]
                out = pa.RecordBatch.from_arrays([
                    pa.array(np.full(documents, row["shard"].as_py())), pa.array(np.arange(documents), pa.int32()),
                    row["doc_ids"].values, row["marks"].values, pa.array(np.diff(shard.ends, prepend=0)),
                    *(pa.ListArray.from_arrays(pa.array(offsets), values) for values in lists),
                ], ["shard", "row", "doc_id", "mark", "n_words", "start", "length", "item_id", "item_start"])
                yield out if every else out.filter(pa.array(np.diff(offsets) > 0))

    return search


HITS_DDL = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def contamination(matches: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every document of ``find_matches``.

    ``n_hit`` counts the words inside any match. Rows of equal ``item_id`` are one item; the NULL
    item counts as one, written as nothing.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits, counts, sums = [], [], []
            for words, start, length, items in zip(*(batch.column(n) for n in range(1, 5)), strict=True):
                names = sorted({"" if one is None else str(one) for one in items.as_py()})
                counts.append(len(names))
                sums.append(hashlib.sha256(",".join(names).encode()).hexdigest())
                if not names:
                    hits.append(0)
                    continue
                start = start.values.to_numpy().astype(np.int64)
                steps = np.zeros(words.as_py() + 1, np.int64)
                np.add.at(steps, start, 1)
                np.add.at(steps, start + length.values.to_numpy(), -1)
                hits.append(int((np.cumsum(steps) > 0).sum()))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(hits, pa.int64()), pa.array(counts, pa.int64()),
                pa.array(sums, pa.string()), pa.array([n > 0 for n in hits], pa.bool_()),
            ], ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    return matches.select("doc_id", "n_words", "start", "length", "item_id").mapInArrow(digest, HITS_DDL)


def drop_contaminated(documents: DataFrame, tests: DataFrame, *, key: str = "doc_id", text: str = "text", least: int = LEAST_WORDS) -> DataFrame:
    """The documents without a match, all columns and repeated rows kept.

    Equal texts have equal matches, so a row is found again by its key and the hash of its text.
    """
    index = kept(build_index(documents, key=key, text=text), "suffixes")
    hit = find_matches(index, tests, least=least).filter(F.size("start") > 0).select("doc_id", "mark").distinct()
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = documents.select(F.struct("*").alias("_row"), F.col(key).cast("long").alias("_key"), F.xxhash64(body).alias("_mark"))
    same = F.col("_key").eqNullSafe(F.col("doc_id")) & (F.col("_mark") == F.col("mark"))
    return rows.join(hit, same, "left_anti").select("_row.*")

"""Token ids in wavelet matrices, one compressed file per shard.

A wavelet matrix holds a sequence as bit-planes, from the highest bit down; after each plane the
zeros stand before the ones. With counts of ones per block it answers which token stands at a
place, how often a token occurs before a place and where it occurs, without decoding the rest.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmarts.llm.common import kept

MAGIC = b"WVMX1\n"
# Bits between two entries of a plane's rank directory.
BLOCK_BITS = 512
SHARD_TOKENS = 1 << 21
END_ID = 2
# Rows of documents that are sorted and written by one task, about.
SHARD_DOCS = 10_000
# Distinct words a worker remembers before it starts anew.
REMEMBERED = 1_000_000


class WaveletMatrix:
    """A sequence of unsigned ids with access, rank and select."""

    def __init__(self, length: int, bits: int, zeros: list[int], planes: np.ndarray):
        self.length, self.bits, self.zeros, self.planes = length, bits, zeros, planes
        self._ranks: np.ndarray | None = None

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        planes, zeros = np.zeros((bits, -(-len(ids) // 8)), np.uint8), []
        for level in range(bits):
            ones = (ids & ids.dtype.type(1 << (bits - 1 - level))) != 0
            planes[level] = np.packbits(ones)
            low = ids[~ones]
            zeros.append(len(low))
            ids = np.concatenate([low, ids[ones]])
        return cls(len(ids), bits, zeros, planes)

    def decode(self) -> np.ndarray:
        """The whole sequence: planes are undone from the last one up."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        ids = np.zeros(self.length, kind)
        for level in range(self.bits - 1, -1, -1):
            ones = np.unpackbits(self.planes[level], count=self.length).view(bool)
            up = np.empty_like(ids)
            up[~ones] = ids[: self.zeros[level]]
            up[ones] = ids[self.zeros[level] :] | kind(1 << (self.bits - 1 - level))
            ids = up
        return ids

    @property
    def ranks(self) -> np.ndarray:
        """Ones before each block of each plane."""
        if self._ranks is None:
            step = BLOCK_BITS // 8
            ones = np.bitwise_count(self.planes)
            pad = -ones.shape[1] % step
            per_block = np.pad(ones, ((0, 0), (0, pad))).reshape(self.bits, -1, step).sum(axis=2, dtype=np.int64)
            self._ranks = np.concatenate([np.zeros((self.bits, 1), np.int64), per_block.cumsum(axis=1)], axis=1)
        return self._ranks

    def _bit(self, level: int, at: int) -> int:
        return int(self.planes[level, at >> 3] >> (7 - (at & 7))) & 1

    def _ones(self, level: int, at: int) -> int:
        """Ones before ``at`` in a plane."""
        block = at // BLOCK_BITS
        count = int(self.ranks[level, block])
        first = block * (BLOCK_BITS // 8)
        count += int(np.bitwise_count(self.planes[level, first : at >> 3]).sum())
        if at & 7:
            count += (int(self.planes[level, at >> 3]) >> (8 - (at & 7))).bit_count()
        return count

    def _step(self, level: int, at: int, bit: int) -> int:
        ones = self._ones(level, at)
        return self.zeros[level] + ones if bit else at - ones

    def access(self, at: int) -> int:
        """The id at a place."""
        if not 0 <= at < self.length:
            raise IndexError(at)
        value = 0
        for level in range(self.bits):
            bit = self._bit(level, at)
            value = value << 1 | bit
            at = self._step(level, at, bit)
        return value

    def _range(self, token: int, end: int) -> tuple[int, int]:
        first = 0
        for level in range(self.bits):
            bit = token >> (self.bits - 1 - level) & 1
            first, end = self._step(level, first, bit), self._step(level, end, bit)
        return first, end

    def rank(self, token: int, end: int) -> int:
        """How often a token occurs before a place."""
        if token >> self.bits:
            return 0
        first, last = self._range(token, min(end, self.length))
        return last - first

    def count(self, token: int) -> int:
        return self.rank(token, self.length)

    def select(self, token: int, number: int) -> int:
        """Place of a token's occurrence, numbered from 0; IndexError where there is none."""
        if token >> self.bits or number < 0:
            raise IndexError(number)
        first, last = self._range(token, self.length)
        if number >= last - first:
            raise IndexError(number)
        at = first + number
        for level in range(self.bits - 1, -1, -1):
            bit = token >> (self.bits - 1 - level) & 1
            at = self._select_bit(level, bit, at - self.zeros[level] if bit else at)
        return at

    def _select_bit(self, level: int, bit: int, number: int) -> int:
        """Place of a plane's bit, numbered from 0: its block by bisection, then inside the block."""
        ranks = self.ranks[level]
        held = ranks if bit else np.arange(len(ranks)) * BLOCK_BITS - ranks
        block = int(np.searchsorted(held, number, side="right")) - 1
        first = block * (BLOCK_BITS // 8)
        inside = np.unpackbits(self.planes[level, first : first + BLOCK_BITS // 8])
        return block * BLOCK_BITS + int(np.flatnonzero(inside == bit)[number - int(held[block])])


def to_file(matrix: WaveletMatrix, doc_ids: list[int | None], ends: np.ndarray, **more) -> bytes:
    """Bytes of a shard: a compressed frame with header, documents and planes, behind its length."""
    import zstandard

    head = json.dumps({
        "length": matrix.length, "bits": matrix.bits, "zeros": matrix.zeros, "documents": len(doc_ids),
        "null_ids": [n for n, one in enumerate(doc_ids) if one is None], **more,
    }).encode()
    ids = np.array([one or 0 for one in doc_ids], "<i8")
    body = struct.pack("<I", len(head)) + head + ids.tobytes() + ends.astype("<i8").tobytes() + matrix.planes.tobytes()
    frame = zstandard.ZstdCompressor(level=1).compress(body)
    return MAGIC + struct.pack("<Q", len(frame)) + frame


def from_file(data: bytes) -> tuple[WaveletMatrix, list[int | None], np.ndarray, dict]:
    """Matrix, document ids, ends of the documents and header of a shard."""
    import zstandard

    if data[: len(MAGIC)] != MAGIC:
        raise ValueError("not a wavelet matrix file")
    start = len(MAGIC) + 8
    (size,) = struct.unpack_from("<Q", data, len(MAGIC))
    body = zstandard.ZstdDecompressor().decompress(data[start : start + size])
    (length,) = struct.unpack_from("<I", body)
    head, at = json.loads(body[4 : 4 + length]), 4 + length
    documents = head["documents"]
    ids = np.frombuffer(body, "<i8", documents, at).tolist()
    for n in head["null_ids"]:
        ids[n] = None
    ends = np.frombuffer(body, "<i8", documents, at + 8 * documents)
    planes = np.frombuffer(body, np.uint8, offset=at + 16 * documents)
    planes = planes.reshape(head["bits"], -(-head["length"] // 8))
    return WaveletMatrix(head["length"], head["bits"], head["zeros"], planes), ids, ends, head


class Coder:
    """Ids of whole texts, by encoding every distinct word once.

    For texts of the characters in ``_PLAIN`` the tokenizer's own steps, which are to compose, lower,
    split at white space and split by a fixed pattern, work word by word; their words are looked up
    and new ones are encoded by the tokenizer's model. Any other text is encoded whole.
    """

    # Composed already, with one lower form wherever they stand; white space is ASCII only.
    _PLAIN = "\x00-\x1b\x20-\x84\x86-\x9f\xa1-įı-ɏ‐-‧‰-⁒"
    # Fixed value: the pattern that the tokenizer file names.
    _PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole, self.model = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        self.model.encode_special_tokens = True
        self.model.normalizer = None
        self.model.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        spec = json.loads(self.whole.to_str())
        steps = [step["type"] for step in spec["normalizer"]["normalizers"]]
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.by_word = steps == ["NFC", "Replace", "Lowercase"] and pattern == self._PIECES
        self.other = regex.compile(f"[^{self._PLAIN}]")
        self.pieces = regex.compile(self._PIECES)
        size = self.whole.get_vocab_size()
        self.bits = max(1, (size - 1).bit_length())
        self.last = np.array([(self.whole.id_to_token(n) or "").endswith("</w>") for n in range(size)])
        self.forget()

    def forget(self) -> None:
        self.index, self.fresh = _Index(), []
        self.index.fresh = self.fresh
        self.flat, self.lengths = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.int64)
        self.starts = np.zeros(1 << 16, np.int64)
        self.words = self.used = 0

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        plain = [self.by_word and not self.other.search(text) for text in texts]
        out: list[np.ndarray | None] = [None] * len(texts)
        rest = [n for n, one in enumerate(plain) if not one]
        if rest:
            coded = self.whole.encode_batch([texts[n] for n in rest], add_special_tokens=False)
            for n, one in zip(rest, coded, strict=True):
                out[n] = np.array(one.ids, np.uint32)
        listed = [(n, texts[n].lower().split()) for n, one in enumerate(plain) if one]
        if listed:
            if len(self.index) > REMEMBERED:
                self.forget()
            total = sum(len(words) for _, words in listed)
            every = chain.from_iterable(words for _, words in listed)
            codes = np.fromiter(map(self.index.__getitem__, every), np.int64, total)
            self._learn()
            lengths = self.lengths[codes]
            ends = np.cumsum(lengths)
            at = np.repeat(self.starts[codes] - ends + lengths, lengths) + np.arange(ends[-1] if total else 0)
            ids = self.flat[at]
            bounds = np.concatenate([[0], ends])[np.cumsum([0, *(len(words) for _, words in listed)])]
            for (n, _), a, b in zip(listed, bounds[:-1], bounds[1:], strict=True):
                out[n] = ids[a:b]
        return out

    def _learn(self) -> None:
        """Encode the fresh words and append their ids."""
        if not self.fresh:
            return
        pieces = [self.pieces.findall(word) for word in self.fresh]
        groups = [" ".join([p for word in pieces[n : n + 64] for p in word]) for n in range(0, len(pieces), 64)]
        coded = self.model.encode_batch_fast(groups, add_special_tokens=False)
        ids = np.array([i for one in coded for i in one.ids], np.uint32)
        # A piece ends with an id that ends a word.
        piece_ends = np.flatnonzero(self.last[ids]) + 1
        word_ends = piece_ends[np.cumsum([len(word) for word in pieces]) - 1]
        if word_ends[-1] != len(ids) or len(piece_ends) != sum(map(len, pieces)):
            raise ValueError("the tokenizer does not mark the ends of words")
        count, size = len(pieces), len(ids)
        self.flat = _room(self.flat, self.used + size)
        self.starts, self.lengths = _room(self.starts, self.words + count), _room(self.lengths, self.words + count)
        self.flat[self.used : self.used + size] = ids
        begins = np.concatenate([[0], word_ends[:-1]])
        self.starts[self.words : self.words + count] = begins + self.used
        self.lengths[self.words : self.words + count] = word_ends - begins
        self.words, self.used = self.words + count, self.used + size
        self.fresh.clear()


def _room(values: np.ndarray, size: int) -> np.ndarray:
    return values if size <= len(values) else np.resize(values, max(size, 2 * len(values)))


class _Index(dict):
    """Numbers words in order of appearance and lists the fresh ones."""

    def __missing__(self, word: str) -> int:
        self.fresh.append(word)
        self[word] = number = len(self)
        return number


_CODERS: dict[str, Coder] = {}


def coder(path: str) -> Coder:
    """One coder for a worker's tasks."""
    if path not in _CODERS:
        _CODERS[path] = Coder(path)
    return _CODERS[path]


def write_shards(
    documents: DataFrame, folder: str, tokenizer_path: str, *, key: str = "doc_id", text: str = "text",
    end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS, shard_docs: int = SHARD_DOCS,
) -> None:
    """Write the ids of all texts, each with ``end_id`` behind it, in ascending order of key.

    A NULL text is empty; NULL keys come first and equal keys are ordered by a hash of the text.
    A shard holds whole documents, about ``shard_tokens`` ids or one longer document. Files are
    written by Spark, so a lost task is repeated and leaves no half file.
    """
    rows = documents.select(
        F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )
    parts = max(1, -(-rows.count() // shard_docs))
    ordered = rows.repartitionByRange(parts, F.col("doc_id").asc_nulls_first())
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        made, part, number = coder(tokenizer_path), TaskContext.get().partitionId(), 0
        bits = max(made.bits, int(end_id).bit_length())
        kind = np.uint16 if bits <= 16 else np.uint32
        doc_ids, held, size = [], [], 0
        mark = np.array([end_id], kind)

        def shard():
            matrix = WaveletMatrix.build(np.concatenate(held), bits)
            ends = np.cumsum([len(x) for x in held]).reshape(-1, 2)[:, 1]
            return pa.RecordBatch.from_arrays(
                [pa.array([to_file(matrix, doc_ids, ends, part=part, number=number)], pa.binary())], ["value"]
            )

        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                cut = batch.slice(start, 500)
                for doc_id, ids in zip(cut.column(0).to_pylist(), made.encode(cut.column(1).to_pylist()), strict=True):
                    doc_ids.append(doc_id)
                    held += [ids.astype(kind), mark]
                    size += len(ids) + 1
                    if size >= shard_tokens:
                        yield shard()
                        doc_ids, held, size, number = [], [], 0, number + 1
        if held:
            yield shard()

    files = ordered.mapInArrow(encode, "value binary").select(F.col("value").cast("string").alias("value"))
    files.write.option("maxRecordsPerFile", 1).text(folder)


SHARD_DDL = "part long, number long, place long, doc_id long, local_start long, n_tokens long, ids_crc32 long"


def _read_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column(0):
            matrix, doc_ids, ends, head = from_file(content.as_py())
            ids, count = matrix.decode().astype("<u4"), len(doc_ids)
            starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            sums = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(count, head["part"])), pa.array(np.full(count, head["number"])),
                pa.array(np.arange(count)), pa.array(doc_ids, pa.int64()), pa.array(starts),
                pa.array(ends - starts), pa.array(sums, pa.int64()),
            ], ["part", "number", "place", "doc_id", "local_start", "n_tokens", "ids_crc32"])


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files below ``folder``."""
    files = spark.read.format("binaryFile").load(folder).select("content")
    rows = kept(files.mapInArrow(_read_documents, SHARD_DDL), "tokens")
    shards = rows.groupBy("part", "number").agg(F.sum("n_tokens").alias("held"))
    parts = shards.groupBy(F.col("part").alias("place")).agg(F.sum("held").alias("held"))
    inner = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    first = _begins(parts, 3).withColumnRenamed("place", "part")
    begins = shards.withColumn("inside", F.coalesce(F.sum("held").over(inner), F.lit(0))).join(first, "part")
    begins = begins.select("part", "number", (F.col("first") + F.col("inside")).alias("shard_start"))
    rows = rows.join(begins, ["part", "number"])
    start = (F.col("shard_start") + F.col("local_start")).cast("long")
    return rows.select("doc_id", start.alias("start"), "n_tokens", "ids_crc32")


def _begins(sums: DataFrame, levels: int) -> DataFrame:
    """``place, first``: the sum of ``held`` over all smaller places, by groups of a thousand and groups of groups.

    One task sees a thousand rows, and after all levels a thousandth of a thousandth of them.
    """
    if not levels:
        before = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
        return sums.select("place", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("first"))
    group = F.floor(F.col("place") / 1000)
    above = sums.groupBy(group.alias("place")).agg(F.sum("held").alias("held"))
    before = Window.partitionBy("group").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    inside = sums.withColumn("group", group).withColumn("inside", F.coalesce(F.sum("held").over(before), F.lit(0)))
    joined = inside.join(_begins(above, levels - 1).withColumnRenamed("place", "group"), "group")
    return joined.select("place", (F.col("first") + F.col("inside")).alias("first"))

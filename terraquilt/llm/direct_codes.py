"""Token ids in directly addressable codes: byte levels, continuation bitmaps and rank directories."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from terraquilt.llm.common import settle, text_of
from terraquilt.llm.packing import UnitTokenizer
from terraquilt.session import broadcast_if_small

#: Fixed values of the format: its mark, bits of a chunk, words of 64 bits that a directory entry stands for.
MAGIC, CHUNK, WORDS = b"DAC1", 8, 8
#: Ids after which a segment ends with its document.
SEGMENT = 1 << 18


class Level:
    """The chunks of one level, a bit for each that goes on in the next, and the number of set bits before every eighth word."""

    def __init__(self, chunks: np.ndarray, words: np.ndarray, directory: np.ndarray):
        self.chunks, self.words, self.directory = chunks, words, directory

    @classmethod
    def build(cls, chunks: np.ndarray, goes_on: np.ndarray) -> Level:
        bits = np.zeros(-(-len(chunks) // 512) * 512, np.uint8)
        bits[:len(chunks)] = goes_on
        words = np.packbits(bits, bitorder="little").view("<u8")
        counts = np.bitwise_count(words).reshape(-1, WORDS).sum(axis=1, dtype=np.uint64)
        return cls(chunks, words, np.concatenate([[0], np.cumsum(counts)[:-1]]).astype("<u8") if len(counts) else counts.astype("<u8"))

    def bits(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Set bits before each place: the directory's entry, the whole words after it, and the rest of one word."""
        if not len(self.words):
            return np.zeros(len(at), np.int64)
        word = at >> 6
        found = self.directory[np.minimum(at >> 9, len(self.directory) - 1)].astype(np.int64)
        start = np.minimum(at >> 9, len(self.directory) - 1) * WORDS
        for step in range(WORDS):
            inside = start + step < word
            found += np.where(inside, np.bitwise_count(self.words[np.minimum(start + step, len(self.words) - 1)]), 0)
        last = self.words[np.minimum(word, len(self.words) - 1)] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        return found + np.where(word < len(self.words), np.bitwise_count(last), 0)


class DirectCodes:
    """A sequence of unsigned 32-bit ids: level j holds the j-th byte, least first, of every id that has one.

    An id's next byte lies at the rank of its continuation bit in the level below, so any id is
    found by a directory entry and at most eight words a level, whatever is before it.
    """

    def __init__(self, levels: list[Level], count: int):
        self.levels, self.count = levels, count

    def __len__(self) -> int:
        return self.count

    @classmethod
    def encode(cls, ids: np.ndarray) -> DirectCodes:
        left, levels = np.asarray(ids, "<u4"), []
        count = len(left)
        while len(left) or not levels:
            rest = left >> CHUNK
            goes_on = rest > 0
            levels.append(Level.build((left & 255).astype(np.uint8), goes_on))
            left = rest[goes_on]
        return cls(levels, count)

    def to_bytes(self) -> bytes:
        """Mark, number of ids and of levels, then of each level the number of chunks, chunks, bitmap and directory."""
        parts = [MAGIC, struct.pack("<QI", self.count, len(self.levels))]
        for level in self.levels:
            parts += [struct.pack("<Q", len(level.chunks)), level.chunks.tobytes(), level.words.tobytes(), level.directory.tobytes()]
        return b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> DirectCodes:
        """The codes in ``data``, whose sections are read in place."""
        if bytes(data[:4]) != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        count, levels = struct.unpack_from("<QI", data, 4)
        at, found = 16, []
        for _ in range(levels):
            (size,) = struct.unpack_from("<Q", data, at)
            blocks = -(-size // 512)
            chunks = np.frombuffer(data, np.uint8, size, at + 8)
            words = np.frombuffer(data, "<u8", blocks * WORDS, at + 8 + size)
            directory = np.frombuffer(data, "<u8", blocks, at + 8 + size + blocks * WORDS * 8)
            at += 8 + size + blocks * (WORDS + 1) * 8
            found.append(Level(chunks, words, directory))
        return cls(found, count)

    def at(self, places: np.ndarray) -> np.ndarray:
        """The ids at any places, in any order."""
        at = np.asarray(places, np.int64)
        if len(at) and (at.min() < 0 or at.max() >= self.count):
            raise IndexError("place beyond the ids")
        out = np.zeros(len(at), "<u4")
        open_ = np.arange(len(at))
        for depth, level in enumerate(self.levels):
            out[open_] |= level.chunks[at].astype("<u4") << np.uint32(CHUNK * depth)
            more = level.bits(at) if len(at) else np.zeros(0, bool)
            open_, at = open_[more], level.rank(at[more])
            if not len(open_):
                break
        return out

    def slice(self, start: int, stop: int) -> np.ndarray:
        """The ids from ``start`` up to ``stop``: one rank a level, then neighbours."""
        out = np.zeros(max(0, stop - start), "<u4")
        open_, low, high = np.arange(len(out)), start, stop
        for depth, level in enumerate(self.levels):
            if low >= high:
                break
            out[open_] |= level.chunks[low:high].astype("<u4") << np.uint32(CHUNK * depth)
            words = level.words[low >> 6:(high + 63) >> 6]
            bits = np.unpackbits(words.view(np.uint8), bitorder="little")[low & 63:(low & 63) + high - low].astype(bool)
            open_ = open_[bits]
            low = int(level.rank(np.array([low]))[0])
            high = low + len(open_)
        return out


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, key: str = "doc_id", text: str = "text") -> None:
    """Write the ids of all documents, each with ``end_id`` after it, as segments of codes in ascending order of key.

    One file per range of keys, numbered in their order; a row of it is a segment: part, segment, first
    (ids before it in its part), ids, codes, and the keys and lengths of its documents. A segment ends with the
    document that brings it to ``SEGMENT`` ids. A NULL text is empty, a NULL key comes first; rows that share a key
    each are a document, in the order of their texts' hashes, and repeats are spread by a salt, so
    that a key with a third of all rows is many ranges. Other columns are left out. Texts are shuffled
    once; the ids are made where the texts arrive.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = f"part int, segment int, first long, ids long, codes binary, keys array<{kind}>, lengths array<bigint>"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenize = UnitTokenizer(tokenizer).encode
        part, segment, first = TaskContext.get().partitionId(), 0, 0
        keys: list[pa.Array] = []
        parts: list[np.ndarray] = []
        held = 0

        def row() -> pa.RecordBatch:
            named = pa.concat_arrays(keys)
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "segment": pa.array([segment], pa.int32()), "first": pa.array([first]),
                "ids": pa.array([held]), "codes": pa.array([DirectCodes.encode(np.concatenate(parts)).to_bytes()], pa.binary()),
                "keys": pa.ListArray.from_arrays(pa.array([0, len(named)], pa.int32()), named),
                "lengths": pa.array([[len(p) for p in parts]], pa.list_(pa.int64())),
            })

        for batch in batches:
            names = batch.column("key")
            for i, value in enumerate(batch.column("text")):
                ids = np.array([*tokenize(value.as_py()), end_id], "<u4")
                keys.append(names.slice(i, 1))
                parts.append(ids)
                held += len(ids)
                if held >= SEGMENT:
                    yield row()
                    segment, first = segment + 1, first + held
                    keys, parts, held = [], [], 0
        if held:
            yield row()

    rows = docs.select(F.col(key).alias("key"), text_of(text).alias("text"))
    rows = rows.withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))
    order = [F.col("key").asc_nulls_first(), F.xxhash64("text"), F.col("salt")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "text")
    ordered.mapInArrow(encode, schema).write.parquet(path)


def _segments(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """Segments with ``start``, the ids of all before them: the sums of the parts before, one row a file, and its place there."""
    rows = spark.read.parquet(path)
    before = F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = rows.groupBy("part").agg(F.sum("ids").alias("ids")).select("part", F.coalesce(before, F.lit(0)).alias("before"))
    return rows.join(broadcast_if_small(parts), "part").select((F.col("before") + F.col("first")).alias("start"), *columns)


def read_documents(spark: SparkSession, path: str, key: str = "doc_id", ids: bool = False) -> DataFrame:
    """key, start (ids of all documents before), n_tokens, ids_crc32 and, with ``ids``, the ids as bytes, read from the files.

    No shuffle. Files of an empty table give no rows. For some documents or tokens see ``tokens_at``.
    """
    rows = _segments(spark, path, "codes", "keys", "lengths")
    kind = rows.schema["keys"].dataType.elementType.simpleString()
    schema = f"key {kind}, start long, n_tokens long, ids_crc32 long" + (", ids binary" if ids else "")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                codes = DirectCodes.from_bytes(batch.column("codes")[i].as_py())
                lengths = np.array(batch.column("lengths")[i].as_py(), np.int64)
                starts = np.cumsum(lengths) - lengths
                # every document of the segment is asked for, so their ids are one slice
                whole = codes.slice(0, len(codes)).tobytes()
                found = [whole[4 * s:4 * (s + n)] for s, n in zip(starts.tolist(), lengths.tolist())]
                out = {
                    "key": batch.column("keys")[i].values, "start": pa.array(starts + batch.column("start")[i].as_py()),
                    "n_tokens": pa.array(lengths), "ids_crc32": pa.array([zlib.crc32(f) for f in found], pa.int64()),
                }
                yield pa.RecordBatch.from_pydict(out | ({"ids": pa.array(found, pa.binary())} if ids else {}))

    return rows.mapInArrow(decode, schema).withColumnRenamed("key", key)


def tokens_at(spark: SparkSession, path: str, places: DataFrame, place: str = "place") -> DataFrame:
    """place and token_id for every row of ``places``; places that no id has are left out, as are NULLs and other columns.

    Places meet the segments in ranges of ``SEGMENT`` ids, where only the numbers of segments go; those asked for bring
    their codes, and only the places' own chunks are read.
    """
    found = _segments(spark, path, "part", "segment", "ids")
    low, high = F.floor(F.col("start") / SEGMENT), F.floor((F.col("start") + F.col("ids") - 1) / SEGMENT)
    ranges = found.withColumn("range", F.explode(F.sequence(low, high)))
    asked = places.select(F.col(place).cast("long").alias("place")).withColumn("range", F.floor(F.col("place") / SEGMENT))
    met = asked.join(ranges, "range").where((F.col("place") >= F.col("start")) & (F.col("place") < F.col("start") + F.col("ids")))
    # places of one segment in lists of a few thousand, so that no segment asked for often is one task's
    met = settle(met.select("part", "segment", "start", "place"), "tokens-met")
    sizes = met.groupBy("part", "segment").agg(F.ceil(F.count(F.lit(1)) / 4096).cast("long").alias("slots"))
    met = met.join(sizes, ["part", "segment"])
    slot = F.pmod(F.xxhash64("place", F.monotonically_increasing_id()), F.col("slots"))
    lists = settle(met.groupBy("part", "segment", slot.alias("slot")).agg(
        F.collect_list(F.struct((F.col("place") - F.col("start")).alias("at"), "place")).alias("asked")
    ), "tokens-asked")
    rows = spark.read.parquet(path).select("part", "segment", "codes").join(lists, ["part", "segment"]).select("codes", "asked")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                asked = batch.column("asked")[i].values
                codes = DirectCodes.from_bytes(batch.column("codes")[i].as_py())
                yield pa.RecordBatch.from_pydict({
                    "place": asked.field("place"), "token_id": pa.array(codes.at(asked.field("at").to_numpy()).astype(np.int64)),
                })

    return rows.mapInArrow(look, "place long, token_id long").withColumnRenamed("place", place)

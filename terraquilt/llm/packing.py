"""Harmonic packing: pieces fall into reciprocal-capacity classes, and a class k fills k pieces a sequence."""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from terraquilt.llm.common import number_equal_rows, settle, slices, text_of

#: Units whose ids one worker remembers; beyond it, it starts anew.
_REMEMBERED = 300_000
#: How the byte-level pre-tokenizer divides a text; a fixed value.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: itself if printable, else the next free one."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class UnitTokenizer:
    """Ids of whole texts under a byte-level vocabulary file, from the ids of their space-separated units.

    The pattern starts a new pre-token at every space that a non-space follows, so a text's ids
    are those of its units " word", one after the other. Units repeat and are encoded once. A
    text with a space before other white space is encoded as it is. The file's vocabulary is in the order of
    its merges, so the ids are ranks, and the quicker of the two libraries that read such ranks
    gives the ids that the file's own library gives.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        special = {t["content"] for t in model["added_tokens"]}
        byte_of = _byte_of()
        ranks = {bytes(byte_of[c] for c in token): rank for token, rank in model["model"]["vocab"].items() if token not in special}
        self._encode = tiktoken.Encoding("units", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.encode = self._encode  # ids of a whole text as a list, nothing remembered
        self._spaced: dict[str, bytes] = {}

    def _packed(self, text: str) -> bytes:
        found = self._encode(text)
        return struct.pack(f"<{len(found)}I", *found)

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of the text."""
        first, *words = text.split(" ")
        known = self._spaced
        new = {w for w in words if w not in known}
        if new:
            if any(not w or w[0].isspace() for w in new):
                return self._packed(text)
            if len(known) + len(new) > _REMEMBERED:
                known.clear()
                new = set(words)
            for w in new:
                known[w] = self._packed(" " + w)
        return self._packed(first) + b"".join(map(known.__getitem__, words))


def piece_class(length: int, capacity: int, finest: int = 32) -> int:
    """Pieces of this class that fill a sequence: the greatest k up to ``finest``, or power of two beyond, that fits."""
    k = capacity // length
    return k if k <= finest else 1 << (k.bit_length() - 1)


def cut_document(tokens: int, capacity: int, finest: int = 32, pieces: int = 3) -> list[int]:
    """Lengths of a document's pieces, in text order.

    Whole sequences are cut off first. What is left, of length r in ``(C/(k+1), C/k]``, would
    waste up to r - C/(k+1) in each place of class k. So a piece of just C/(k+1) is cut off, which
    fills its place in class k+1, and the rest is cut the same way, into ``pieces`` at most. A
    rest beyond class ``finest``, or one whose class wastes under 1/64 of a sequence, stays whole.
    """
    out = [capacity] * (tokens // capacity)
    rest = tokens % capacity
    for left in range(pieces - 1, -1, -1):
        if not rest:
            break
        k = capacity // rest
        if not left or k >= finest or (capacity - k * rest) * 64 <= capacity:
            out.append(rest)
            break
        place = capacity // (k + 1)
        out.append(place)
        rest -= place
    return out


def cut_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1, finest: int = 32,
                  key: str = "doc_id", text: str = "text", ids: bool = False) -> DataFrame:
    """One row per piece: key, doc_tokens, start, length, class, ids_crc32, and with ``ids`` the ids themselves.

    A document's ids are those of its whole text (NULL: empty) and then ``end_id``; every id
    lies in exactly one piece. Tokenizing is per row, in Arrow batches, without a shuffle.
    """
    schema = f"key {docs.schema[key].dataType.simpleString()}, doc_tokens long, start long, length long, class long, ids_crc32 long"
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens_of = UnitTokenizer(tokenizer).ids
        for batch in slices(batches):
            of, rows, parts = [], [], []
            for i, value in enumerate(batch.column("text").to_pylist()):
                found = tokens_of(value) + end
                n, start = len(found) // 4, 0
                for length in cut_document(n, capacity, finest):
                    part = found[4 * start:4 * (start + length)]
                    of.append(i)
                    rows.append((n, start, length, piece_class(length, capacity, finest), zlib.crc32(part)))
                    parts.append(part)
                    start += length
            numbers = np.array(rows, np.int64).reshape(len(rows), 5)
            out = {"key": batch.column("key").take(pa.array(of, pa.int64()))}
            out |= {name: numbers[:, j] for j, name in enumerate(("doc_tokens", "start", "length", "class", "ids_crc32"))}
            yield pa.RecordBatch.from_pydict(out | ({"ids": pa.array(parts, pa.binary())} if ids else {}))

    whole = docs.select(F.col(key).alias("key"), text_of(text).alias("text"))
    return whole.mapInArrow(cut, schema + (", ids binary" if ids else "")).withColumnRenamed("key", key)


def _first_fit(capacity: int):
    def pack(group: pd.DataFrame) -> pd.DataFrame:
        """First-fit decreasing over the pieces that no class could fill a sequence with."""
        room: list[int] = []
        places = []
        group = group.sort_values(["length", "class", "number"], ascending=[False, True, True], kind="stable")
        for length in group["length"]:
            at = next((i for i, free in enumerate(room) if free >= length), len(room))
            if at == len(room):
                room.append(capacity)
            places.append((at, capacity - room[at]))
            room[at] -= int(length)
        return group[["class", "number"]].assign(
            sequence=[p[0] for p in places], offset=[p[1] for p in places]
        )

    return pack


def pack_pieces(pieces: DataFrame, capacity: int = 2048, key: str = "doc_id") -> DataFrame:
    """Add sequence_id and offset to pieces with start, length and class: class k fills k pieces a sequence.

    Each class numbers its own pieces and fills its own sequences, whatever the others do, and
    the numbering of a class is spread over hash blocks. The fewer than k pieces a class has left
    over, a few thousand in all at any size of input, share sequences by first fit. Offsets are
    gapless from 0 in each sequence; sequence_id is gapless too.
    """
    numbered = settle(number_equal_rows(pieces, ["class"], [key, "start"], "number"), "pack-numbers")
    counts = settle(numbered.groupBy("class").agg(F.count(F.lit(1)).alias("pieces")), "pack-classes")
    full = F.floor(F.col("pieces") / F.col("class")).cast("long")
    bases = counts.select(
        "class", full.alias("full"),
        F.coalesce(F.sum(full).over(Window.orderBy("class").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"),
        F.sum(full).over(Window.partitionBy()).alias("all_full"),
    )
    placed = numbered.join(F.broadcast(bases), "class")  # one row per class
    inner = F.sum("length").over(Window.partitionBy("sequence_id").orderBy("number").rowsBetween(Window.unboundedPreceding, -1))
    filled = (
        placed.where(F.col("number") < F.col("full") * F.col("class"))
        .withColumn("sequence_id", F.col("base") + F.floor(F.col("number") / F.col("class")).cast("long"))
        .withColumn("offset", F.coalesce(inner, F.lit(0)).cast("long"))
    )
    left = placed.where(F.col("number") >= F.col("full") * F.col("class"))
    shared = left.select("class", "number", "length").groupBy().applyInPandas(
        _first_fit(capacity), "class long, number long, sequence long, offset long"
    )
    rest = left.join(F.broadcast(shared), ["class", "number"]).withColumn("sequence_id", F.col("all_full") + F.col("sequence"))
    columns = [*pieces.columns, "sequence_id", "offset"]
    return filled.select(*columns).unionByName(rest.select(*columns))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1, key: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """Pieces of all documents with their places: key, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Documents that share a key each have their own pieces. An empty or NULL text is the one id
    ``end_id``. An empty table gives no pieces. Other columns are left out.
    """
    pieces = settle(cut_documents(docs, tokenizer, capacity, end_id, key=key, text=text), "pack-pieces")
    return pack_pieces(pieces, capacity, key).select(
        key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )

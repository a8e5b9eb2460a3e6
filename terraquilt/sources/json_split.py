"""Large JSON files read by many tasks: one array, one collection, or objects one after the other.

Spark's text source cuts a file into blocks at any byte and reads each on to the next ``}``. What a
brace means there depends on all text before it, so the file is read twice. First every block says what it
does to the depth and whether it ends in a string, once for either state it may begin in. These
summaries, one row a block, are chained in file order. Then every block knows how it begins and cuts its
records; only records that cross blocks meet in a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

_QUOTE, _OPEN, _CLOSE, _LIST, _LIST_END = (ord(c) for c in '"{}[]')
_KEY = re.compile(rb'"((?:[^"\\]|\\.)*)"\s*:\s*\Z', re.S)
_ESCAPED = re.compile(rb"\\.", re.S)
#: Bytes before a list that may hold its key.
_KEY_REACH = 1024


def _blocks(spark: SparkSession, path: str) -> DataFrame:
    """Texts between closing braces in file order within a block, with the file and the byte where the block begins."""
    return spark.read.option("lineSep", "}").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bytes]]:
    """File, block and text of each stretch of one block, its closing braces put back."""
    for batch in batches:
        if not len(batch):
            continue
        blocks, files = batch.column("block").to_numpy(), batch.column("file")
        change = np.flatnonzero(blocks[1:] != blocks[:-1]) + 1
        names = files.dictionary_encode().indices.to_numpy()
        cuts = sorted({0, len(batch), *change.tolist(), *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist()})
        for low, high in zip(cuts, cuts[1:]):
            texts = batch.column("value").slice(low, high - low).to_pylist()
            yield files[low].as_py(), int(blocks[low]), ("}".join(texts) + "}").encode()


@dataclass
class _Braces:
    """Braces and brackets of a text outside its strings: places, kinds, depth after each; and whether it ends in a string."""

    at: np.ndarray
    kind: np.ndarray
    depth: np.ndarray
    inside: int

    @classmethod
    def of(cls, text: bytes, inside: int, depth: int) -> _Braces:
        plain = _ESCAPED.sub(b"__", text) if b"\\" in text else text
        codes = np.frombuffer(plain, np.uint8)
        quotes = np.flatnonzero(codes == _QUOTE)
        at = np.flatnonzero((codes == _OPEN) | (codes == _CLOSE) | (codes == _LIST) | (codes == _LIST_END))
        at = at[(np.searchsorted(quotes, at) + inside) % 2 == 0]
        kind = codes[at]
        steps = np.where((kind == _OPEN) | (kind == _LIST), 1, -1)
        return cls(at, kind, depth + np.cumsum(steps), (inside + len(quotes)) % 2)

    def last_depth(self, depth: int) -> int:
        return int(self.depth[-1]) if len(self.depth) else depth


def _is_named(text: bytes, at: int, key: bytes) -> bool:
    """Whether the list that opens at ``at`` is the value of ``key``."""
    found = _KEY.search(text, max(0, at - _KEY_REACH), at)
    return bool(found) and found.group(1) == key


#: What opens a depth: an object, a list, the list of the key.
_OBJECT, _PLAIN, _NAMED = range(3)


def _opened(text: bytes, braces: _Braces, key: bytes) -> dict[int, int]:
    """By depth: what opened it last."""
    opens = np.flatnonzero((braces.kind == _OPEN) | (braces.kind == _LIST))
    depths, first = np.unique(braces.depth[opens][::-1], return_index=True)
    out = {}
    for depth, i in zip(depths.tolist(), first.tolist()):
        j = opens[len(opens) - 1 - i]
        named = braces.kind[j] == _LIST and _is_named(text, int(braces.at[j]), key)
        out[depth] = _OBJECT if braces.kind[j] == _OPEN else _NAMED if named else _PLAIN
    return out


_SUMMARY = ("file string, block long, head string, flips int, " + ", ".join(
    f"change{s} long, low{s} long, depths{s} array<bigint>, openers{s} array<int>" for s in (0, 1)
))


def _summaries(blocks: DataFrame, key: str) -> DataFrame:
    """One row a block: how its braces change the depth and how low it gets, for a block that begins outside (0) or in a string (1)."""
    name = key.encode()

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[str, int], dict] = {}
        for file, block, text in _runs(batches):
            seen = known.setdefault((file, block), {
                "head": "", "flips": 0, "change": [0, 0], "low": [0, 0], "opened": [{}, {}],
            })
            if not seen["head"]:
                seen["head"] = text.decode().lstrip("﻿ \t\r\n")[:1]
            flips = seen["flips"]
            for start in (0, 1):
                braces = _Braces.of(text, (start + flips) % 2, seen["change"][start])
                seen["low"][start] = min([seen["low"][start], *(braces.depth[[braces.depth.argmin()]].tolist() if len(braces.depth) else [])])
                seen["opened"][start] |= _opened(text, braces, name)
                seen["change"][start] = braces.last_depth(seen["change"][start])
                seen["flips"] = braces.inside ^ start
        if known:
            columns = {
                "file": [k[0] for k in known], "block": [k[1] for k in known], "head": [v["head"] for v in known.values()],
                "flips": pa.array([v["flips"] for v in known.values()], pa.int32()),
            }
            for s in (0, 1):
                columns[f"change{s}"] = pa.array([v["change"][s] for v in known.values()], pa.int64())
                columns[f"low{s}"] = pa.array([v["low"][s] for v in known.values()], pa.int64())
                columns[f"depths{s}"] = pa.array([list(v["opened"][s]) for v in known.values()], pa.list_(pa.int64()))
                columns[f"openers{s}"] = pa.array([list(v["opened"][s].values()) for v in known.values()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    return blocks.mapInArrow(summarise, _SUMMARY)


def _starts(summaries: DataFrame, key: str) -> DataFrame:
    """How each block begins: base (depth that holds records), inside, depth, named, and origin, the block whose record is open."""
    def chain(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("block")
        inside, depth, named, origin, opener = 0, 0, False, -1, _PLAIN
        heads = [h for h in rows["head"] if h]
        base = 2 if key else int(bool(heads) and heads[0] == "[")
        out = []
        for row in rows.itertuples(index=False):
            out.append((row.file, row.block, base, inside, depth, named, origin))
            change, low = getattr(row, f"change{inside}"), depth + getattr(row, f"low{inside}")
            opened = dict(zip(getattr(row, f"depths{inside}"), getattr(row, f"openers{inside}")))
            named = opened.get(base - depth, _NAMED if named else _PLAIN) == _NAMED
            opener = opened.get(base + 1 - depth, opener)
            was_open, depth = depth > base, depth + change
            origin = -1 if depth <= base or opener != _OBJECT else origin if was_open and low > base else row.block
            inside ^= row.flips
        return pd.DataFrame(out, columns=["file", "block", "base", "inside", "depth", "named", "origin"])

    return summaries.groupBy("file").applyInPandas(
        chain, "file string, block long, base int, inside int, depth long, named boolean, origin long"
    )


def read_objects(spark: SparkSession, path: str, key: str = "") -> DataFrame:
    """``value``: the text of every record of JSON files however large, each file read by as many tasks as it has blocks.

    The records are the objects of a file's outer array, or of the list under ``key`` in its outer
    object, or else its objects one after the other (JSON lines among them). Elements that are no
    objects, and other parts of the outer object, are left out. A file without the key, and an empty
    one, has none. Order is not kept. Only one row a block reaches the driver, and is broadcast.
    """
    blocks = _blocks(spark, path)
    starts = {(r["file"], r["block"]): tuple(r)[2:] for r in _starts(_summaries(blocks, key), key).collect()}
    shared = spark.sparkContext.broadcast(starts)
    name = key.encode()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None
        held: list[bytes] = []  # of the object that is open at depth base + 1
        base = inside = depth = 0
        named = wanted = False
        origin = -1

        def rows(found: list[bytes], whole: bool, origin: int) -> pa.RecordBatch:
            n = len(found)
            return pa.RecordBatch.from_pydict({
                "file": pa.array([at[0]] * n, pa.string()), "origin": pa.array([origin] * n, pa.int64()),
                "block": pa.array([at[1]] * n, pa.int64()), "whole": pa.array([whole] * n, pa.bool_()),
                "value": pa.array([f.decode() for f in found], pa.string()),
            })

        for file, block, text in _runs(batches):
            if at != (file, block):
                if at and held and wanted:
                    yield rows([b"".join(held)], False, origin)
                at = (file, block)
                base, inside, depth, named, origin = shared.value[at]
                held, wanted = ([b""], named or base < 2) if origin >= 0 else ([], False)
                carried = origin >= 0
            braces = _Braces.of(text, inside, depth)
            inner = np.flatnonzero((braces.kind == _OPEN) & (braces.depth == base + 1))
            ends = braces.at[(braces.kind == _CLOSE) & (braces.depth == base)]
            begins = braces.at[inner]
            flags = np.full(len(begins), named or base < 2)
            if base == 2:
                holders = np.flatnonzero(((braces.kind == _LIST) | (braces.kind == _OPEN)) & (braces.depth == base))
                marks = [bool(braces.kind[j] == _LIST) and _is_named(text, int(braces.at[j]), name) for j in holders.tolist()]
                place = np.searchsorted(holders, inner)
                flags = np.array([marks[p - 1] if p else named for p in place.tolist()], bool)
                named = marks[-1] if marks else named
            depth, inside = braces.last_depth(depth), braces.inside
            if held:
                if not len(ends):
                    held.append(text)
                    continue
                if wanted:
                    done = b"".join([*held, text[:int(ends[0]) + 1]])
                    yield rows([done], False, origin) if carried else rows([done], True, -1)
                ends, held, carried = ends[1:], [], False
            # the last object may be open still; what closes without an opening here is no object of this depth
            pairs = [(b, e, f) for b, e, f in zip(begins.tolist(), ends.tolist(), flags.tolist())]
            found = [text[b:e + 1] for b, e, f in pairs if f]
            if found:
                yield rows(found, True, -1)
            if len(begins) > len(ends):
                held, wanted, origin, carried = [text[int(begins[-1]):]], bool(flags[-1]), block, False
        if at and held and wanted:
            yield rows([b"".join(held)], False, origin)

    found = blocks.mapInArrow(cut, "file string, origin long, block long, whole boolean, value string")
    crossing = found.where(~F.col("whole")).groupBy("file", "origin").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "value"))), lambda x: x["value"]), "").alias("value")
    )
    return found.where("whole").select("value").unionByName(crossing.select("value"))

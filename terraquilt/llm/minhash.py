"""Near duplicates by one-permutation MinHash: densified bins, banded buckets, stars, exact confirmation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from terraquilt.llm.common import discard, settle, slices, text_of
from terraquilt.session import broadcast_if_small

_MIX = np.uint64(0x9E3779B97F4A7C15)
_FOLD = np.uint64(0xBF58476D1CE4E5B9)
#: Keys that may be broadcast, after they were counted; more are joined by a shuffle.
_BROADCAST_KEYS = 1_000_000
#: Words whose hashes one worker remembers; beyond it, it starts anew.
_REMEMBERED = 1_000_000


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _FOLD
    x = (x ^ (x >> np.uint64(27))) * _MIX
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sets of word shingles as sorted 64-bit hashes; words are lower-cased A-Z and split at ASCII white space."""

    def __init__(self, width: int):
        self.width = width
        self._known: dict[bytes, int] = {}

    def shingles(self, text: str) -> np.ndarray:
        words = text.encode().lower().split()
        if not words:
            return np.empty(0, np.uint64)
        known = self._known
        if len(known) > _REMEMBERED:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        width = min(self.width, len(words))
        last = len(words) - width + 1
        out = np.full(last, width, np.uint64)
        for i in range(width):
            out = _mix((out ^ hashes[i:i + last]) * _MIX + np.uint64(i + 1))
        return np.unique(out)


class OnePermutation:
    """``bins`` minima of one hash order, an empty bin borrowing a filled one's (optimal densification).

    An empty bin asks bins in an order of its own, drawn by a hash of the bin and the attempt, until
    one is filled, so two sets borrow alike where they are filled alike.
    """

    def __init__(self, bins: int, seed: int = 5, attempts: int = 64):
        self.bins = bins
        tries = np.arange(bins, dtype=np.uint64)[None, :] + np.arange(1, attempts + 1, dtype=np.uint64)[:, None] * np.uint64(bins)
        self._asked = (_mix(tries * _MIX + np.uint64(seed)) % np.uint64(bins)).astype(np.int64)

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        """Of a set that isn't empty."""
        values = _mix(shingles + _FOLD)
        bins = (values % np.uint64(self.bins)).astype(np.int64)
        out = np.full(self.bins, np.iinfo(np.uint64).max, np.uint64)
        np.minimum.at(out, bins, values)
        filled = np.zeros(self.bins, bool)
        filled[bins] = True
        own = filled.copy()
        empty = np.flatnonzero(~filled)
        for asked in self._asked:
            if not len(empty):
                return out
            found = own[asked[empty]]
            out[empty[found]] = out[asked[empty[found]]]
            empty = empty[~found]
        out[empty] = values.min()
        return out


def add_classes(docs: DataFrame, width: int = 3, bands: int = 32, rows: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_shingles, node (128-bit digest of the set; NULL for an empty one) and the hashes of its bands; no shuffle."""
    kind = docs.schema[key].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, permutation = Shingler(width), OnePermutation(bands * rows)
        places = np.arange(1, bands + 1, dtype=np.uint64)
        for batch in slices(batches):
            sizes, nodes, hashes = [], [], []
            for value in batch.column("text").to_pylist():
                found = shingler.shingles(value)
                sizes.append(len(found))
                if not len(found):
                    nodes.append(None)
                    hashes.append(None)
                    continue
                parts = permutation.minima(found).reshape(bands, rows)
                band = places.copy()
                for i in range(rows):
                    band = _mix((band ^ parts[:, i]) * _MIX)
                nodes.append(xxhash.xxh3_128_digest(found.tobytes()))
                hashes.append(band.view(np.int64))
            yield pa.RecordBatch.from_pydict({
                "key": batch.column("key"), "n_shingles": pa.array(sizes, pa.int64()), "node": pa.array(nodes, pa.binary()),
                "bands": pa.array(hashes, pa.list_(pa.int64())),
            })

    return docs.select(F.col(key).alias("key"), text_of(text).alias("text")).mapInArrow(
        sign, f"key {kind}, n_shingles long, node binary, bands array<bigint>"
    )


def _sets(docs: DataFrame, nodes: DataFrame, width: int, key: str, text: str) -> DataFrame:
    """node and its set, for the nodes (node, rep: a key that has the node), from the texts of those keys.

    The keys are broadcast if their counted number allows, so that texts stay where they are; else texts are shuffled once.
    """
    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in slices(batches):
            found = [shingler.shingles(value) for value in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "node": pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in found], pa.binary()),
                "shingles": pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64())),
            })

    reps = broadcast_if_small(nodes.select("rep").distinct(), _BROADCAST_KEYS)
    wanted = docs.select(F.col(key).alias("rep"), text_of(text).alias("text")).join(reps, "rep", "left_semi")
    found = wanted.select("text").mapInArrow(shingle, "node binary, shingles array<bigint>")
    # keys that repeat with other texts bring other sets, or the same set again
    return found.join(nodes.select("node"), "node", "left_semi").groupBy("node").agg(F.any_value("shingles").alias("shingles"))


def connect(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): node, root, the least node of its component.

    Each step links every node to the least of its neighbours and itself, from both
    ends in turn, so that components turn into stars in a number of steps that grows with the
    logarithm of their size. Edges per step stay as many as before; hubs are pre-aggregated.
    """
    edges = settle(edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    ).distinct(), "cc-edges")
    while True:
        both = edges.union(edges.select("v", "u"))
        # large star: neighbours above a node go to the least around it
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where(
            F.col("u") != F.col("v")
        ).distinct()
        # small star: a node and its lesser neighbours go to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = large.join(least, "u")
        small = pairs.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).where(
            F.col("u") != F.col("v")
        ).distinct()
        after = settle(small, "cc-edges")
        same = _mark(after) == _mark(edges)
        discard(edges)
        if same:
            return after.select(F.col("u").alias("node"), F.col("v").alias("root"))
        edges = after


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())


def _climbed(parents: DataFrame) -> DataFrame:
    """node and ref, the node that parents (node, parent) lead to, for nodes whose parents are among them; by doubled steps."""
    up = settle(parents, "minhash-parents")
    while True:
        above = up.select(F.col("node").alias("parent"), F.col("parent").alias("ref"))
        after = settle(up.join(above, "parent").select("node", F.col("ref").alias("parent"), (F.col("ref") != F.col("parent")).alias("moved")), "minhash-parents")
        discard(up)
        if after.where("moved").isEmpty():
            return after.select("node", F.col("parent").alias("ref"))
        up = after.drop("moved")
        up._settled_at = after.__dict__["_settled_at"]


def _differences(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """center, node, reference, n, size, linked, and for references the shingles that one of both has: those added and missing."""
    first = pairs.join(sets.select("node", F.col("shingles").alias("s")), "node")
    centers = sets.join(pairs.select(F.col("center").alias("node")).distinct(), "node", "left_semi")
    both = first.join(centers.select(F.col("node").alias("center"), F.col("shingles").alias("c")), "center")
    parts = both.select("center", "node", "reference", F.size("s").cast("long").alias("n"), F.size("c").cast("long").alias("m"),
                        F.array_except("s", "c").alias("added"), F.array_except("c", "s").alias("missing"))
    size = (F.size("added") + F.size("missing")).cast("long")
    return parts.select(
        "center", "node", "reference", "n", size.alias("size"),
        ((100 - percent) * (F.col("n") + F.col("m")) >= (100 + percent) * size).alias("linked"),
        F.when(F.col("reference"), F.concat("added", "missing")).otherwise(F.array().cast("array<bigint>")).alias("parts"),
    )


def _able(members: DataFrame, percent: int) -> DataFrame:
    """Members (center, node, root, main, q, parts) that some member of another root may be linked with.

    Two sets differ in as many shingles as both differ from the center, less twice what these differences share. A
    part of them is shared at most if members of several roots have it. With c of those, and q the own excess, a link of a and b needs
    2 (100 + percent) min(c_a, c_b) >= q_a + q_b. Added are: shared, those parts with the number of their holders,
    rarest first; c; least, the least q of what it may be linked with. Repeated while fewer remain.
    """
    twice = 2 * (100 + percent)
    count = None
    while True:
        marks = members.select("center", "node", "root", F.explode("parts").alias("part"))
        several = marks.groupBy("part").agg(
            F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("holders")
        ).where(F.col("low") != F.col("high")).select("part", "holders")
        shared = marks.join(several, "part").groupBy("center", "node").agg(
            F.sort_array(F.collect_list(F.struct("holders", "part"))).alias("shared")
        )
        placed = settle(members.drop("parts", "shared", "c", "least").join(shared, ["center", "node"], "left").withColumn(
            "shared", F.coalesce("shared", F.array().cast("array<struct<holders: bigint, part: bigint>>"))
        ).withColumn("c", F.size("shared").cast("long")).withColumn("p", twice * F.col("c") - F.col("q")), "minhash-able")
        # what one may be linked with has a p of at least one's q: the least q of each of 32 steps of p
        steps = placed.groupBy("center").agg(F.greatest(F.max("q") / 32, F.lit(1.0)).alias("step"))
        level = lambda x: F.least(F.greatest(F.floor(F.col(x) / F.col("step")), F.lit(0)), F.lit(33)).cast("int")
        placed_steps = placed.join(steps, "center")
        of_level = placed_steps.groupBy("center", "main", level("p").alias("level")).agg(F.min("q").alias("q"))
        levels = of_level.groupBy("center").agg(F.collect_list(F.struct("main", "level", "q")).alias("levels"))  # 68 at most
        met = placed_steps.withColumn("own", level("q")).join(levels, "center")
        fits = F.filter("levels", lambda x: (x["level"] >= F.col("own")) & ~(x["main"] & F.col("main")))
        able = met.withColumn("least", F.array_min(F.transform(fits, lambda x: x["q"]))).where(F.col("p") >= F.col("least"))
        after = settle(able.select(
            "center", "node", "root", "main", "q", "shared", "c", "least", F.transform("shared", lambda x: x["part"]).alias("parts")
        ), "minhash-able")
        discard(members, placed)
        members, left = after, after.count()
        if not left or count is not None and left > 0.9 * count:
            return members
        count = left


def _met(able: DataFrame, percent: int) -> DataFrame:
    """center, a, b: pairs of members of different roots that may be linked, each once.

    Linked sets share so many parts of their differences that a rare one is among those before
    which each has too few left; and enough must be left from it on.
    """
    twice = 2 * (100 + percent)
    needed = F.greatest(F.ceil((F.col("q") + F.col("least")) / twice), F.lit(1))
    rare = able.where(F.col("c") >= needed).select(
        "center", "node", "root", "q", "c", F.posexplode(F.slice("shared", F.lit(1), (F.col("c") - needed + 1).cast("int"))).alias("at", "x")
    ).select("center", "node", "root", "q", (F.col("c") - F.col("at")).alias("left"), F.col("x.part").alias("part"))
    x, y = rare.alias("x"), rare.alias("y")
    possible = twice * F.least("x.left", "y.left") >= F.col("x.q") + F.col("y.q")
    same = (F.col("x.part") == F.col("y.part")) & (F.col("x.center") == F.col("y.center"))
    pairs = x.join(y, same & (F.col("x.node") < F.col("y.node")) & (F.col("x.root") != F.col("y.root")) & possible)
    return pairs.groupBy(F.col("x.node").alias("a"), F.col("y.node").alias("b")).agg(F.min("x.center").alias("center"))


def _judged(docs: DataFrame, width: int, percent: int, bands: int, rows: int, key: str, text: str) -> DataFrame:
    """key, n_shingles, node, component_id, root (the least node of the component; NULL without key or shingles)."""
    signed = settle(add_classes(docs, width, bands, rows, key, text), "minhash-signed")
    nodes = signed.where(F.col("node").isNotNull() & F.col("key").isNotNull()).groupBy("node").agg(
        F.min("key").alias("rep"), F.any_value("n_shingles").alias("n"), F.any_value("bands").alias("bands")
    )
    nodes = settle(nodes, "minhash-nodes")
    members = nodes.select("node", F.posexplode("bands").alias("band", "value")).select(F.xxhash64("band", "value").alias("bucket"), "node")
    # a bucket's members as a whole: buckets with the same members are one
    mark = [F.count(F.lit(1)).alias("count"), F.min("node").alias("low"), F.max("node").alias("high"),
            F.bit_xor(F.xxhash64("node")).alias("x1"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("x2")]
    buckets = members.groupBy("bucket").agg(*mark).where(F.col("count") > 1)
    buckets = buckets.groupBy("count", "low", "high", "x1", "x2").agg(F.min("bucket").alias("bucket")).select("bucket", "count")
    active = settle(members.join(buckets, "bucket"), "minhash-buckets")

    # who meets most others stands in the middle: the center of its buckets, and of those whose centers it leads
    scores = active.groupBy("node").agg(F.sum("count").alias("score"))
    scored = active.join(scores, "node").select("bucket", F.struct("score", "node").alias("ranked"))
    tops = scored.groupBy("bucket").agg(F.max("ranked").alias("top"))
    led = settle(scored.join(tops, "bucket").select("ranked.node", "top").distinct(), "minhash-led")
    discard(active)
    parents = led.groupBy("node").agg(F.max("top")["node"].alias("parent"))
    leaders = led.select(F.col("top.node").alias("node")).distinct()
    refs = _climbed(parents.join(leaders, "node"))
    by_ref = led.select("node", F.col("top.node").alias("leader")).join(refs.withColumnRenamed("node", "leader"), "leader")
    pairs = parents.select(F.col("parent").alias("center"), "node", F.lit(False).alias("reference")).union(
        by_ref.select(F.col("ref").alias("center"), "node", F.lit(True).alias("reference"))
    ).where(F.col("center") != F.col("node")).groupBy("center", "node").agg(F.max("reference").alias("reference"))
    pairs = settle(pairs, "minhash-pairs")
    met = pairs.select("node").union(pairs.select("center")).distinct()
    sets = settle(_sets(docs, met.join(nodes.select("node", "rep"), "node"), width, key, text), "minhash-sets")
    diffs = settle(_differences(pairs, sets, percent), "minhash-differences")
    discard(led, pairs, sets)
    roots = connect(diffs.where("linked").select(F.col("center").alias("a"), F.col("node").alias("b")))

    placed = diffs.where("reference").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mains = placed.groupBy("center", "root").agg(F.count(F.lit(1)).alias("count")).groupBy("center").agg(
        F.max_by("root", F.struct("count", "root")).alias("largest"), F.count(F.lit(1)).alias("roots")
    ).where(F.col("roots") > 1)
    excess = (100 + percent) * F.col("size") - (100 - percent) * F.col("n")
    members = settle(placed.join(mains, "center").select(
        "center", "node", "root", (F.col("root") == F.col("largest")).alias("main"), excess.alias("q"),
        # parts as hashes with their center: what two centers' members have in common isn't shared
        F.transform("parts", lambda x: F.xxhash64(F.col("center"), x)).alias("parts"),
    ), "minhash-members")
    able = _able(members, percent)
    pairs = settle(_met(able, percent), "minhash-pairs")
    side = lambda name, to: diffs.where("reference").select(
        "center", F.col("node").alias(to), F.col("n").alias(f"{name}n"), F.col("size").alias(f"{name}size"), F.col("parts").alias(f"{name}parts")
    )
    both = pairs.join(side("x", "a"), ["center", "a"]).join(side("y", "b"), ["center", "b"])
    apart = F.col("xsize") + F.col("ysize") - 2 * F.size(F.array_intersect("xparts", "yparts"))
    links = settle(both.where((100 - percent) * (F.col("xn") + F.col("yn")) >= (100 + percent) * apart).select("a", "b"), "minhash-links")
    if not links.isEmpty():
        roots = connect(links.union(roots.select("node", "root")))
    discard(able, pairs, links, diffs)

    named = nodes.select("node", "rep").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    classes = named.join(smallest, "root").select("node", "component_id", "root")
    joined = signed.select("key", "n_shingles", "node").join(classes, "node", "left")
    nameless = F.col("key").isNull()
    component = F.when(nameless, F.lit(None)).otherwise(F.coalesce("component_id", "key"))
    return joined.withColumn("component_id", component).withColumn("root", F.when(~nameless, F.col("root")))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, bands: int = 32, rows: int = 4, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """key, n_shingles, component_id (least key reachable over links, itself included), kept.

    Documents are linked if 100 * intersection >= percent * union of their sets of word shingles;
    a text with fewer words than ``width`` is one shingle, one without words (or NULL) has none
    and is linked with nothing. A row without key has no name to be linked by: component_id is
    NULL and kept is true. Rows that share key and text are one document. Other columns are left out.

    Equal sets form one node, so a third of all rows being copies is one node. Nodes that share a
    band's minima meet in a bucket. A bucket never emits all its pairs. Each has a center, the
    member that meets most others, and every node is compared with the center that meets most of all
    and with the one that its bucket's center leads to, so that a group of copies has one center
    whatever bucket they meet in. Confirmed links are joined to components. What is left are bucket
    mates of different components that differ from one center by more than a link allows: two of them
    can only be linked if their differences from it share enough, so they meet again through the
    rarest parts of these differences, those that members of other components share, and are
    confirmed on the differences, which say exactly how far both are apart. Every pair in a bucket is tested, can't be a
    link, or is connected anyway: no link is lost to stars.
    Two sets at 0.85 share no band of 32 with a chance of 6e-11 (long texts).
    """
    return _judged(docs, width, percent, bands, rows, key, text).select(
        F.col("key").alias(key), "n_shingles", "component_id", F.coalesce(F.col("key") == F.col("component_id"), F.lit(True)).alias("kept")
    )


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80, bands: int = 32,
                         rows: int = 4) -> DataFrame:
    """``docs`` with one row of each group of near duplicates; columns as they were.

    The row is one of the group's least key and, of its texts, that of the least digest. Rows that share
    a key but whose texts aren't linked are of different groups, and all stay; of rows that share key and
    set of shingles one stays, the one of least text hash. Texts without shingles are one group for each key. Rows without
    key stay.
    """
    found = settle(_judged(docs, width, percent, bands, rows, key, text).where(F.col("key").isNotNull()).groupBy("key", "node", "root").agg(
        F.count(F.lit(1)).alias("rows")
    ), "minhash-found")
    # each group's least key, and its least digest under that key
    chosen = found.groupBy(F.col("root"), F.when(F.col("root").isNull(), F.col("key")).alias("alone")).agg(
        F.min(F.struct("key", "node")).alias("first")
    ).select(F.col("first.key").alias("key"), F.col("first.node").alias("node"), F.lit(True).alias("first"))
    same = (F.col("f.key") == F.col("c.key")) & F.col("f.node").eqNullSafe(F.col("c.node"))
    judged = settle(found.alias("f").join(chosen.alias("c"), same, "left").select("f.key", "f.node", "f.rows", F.col("c.first").isNotNull().alias("stays")), "minhash-judged")
    # rows of other keys all stay, where they are if these keys can be broadcast
    touched = broadcast_if_small(judged.where(~F.col("stays") | (F.col("rows") > 1)).select("key").distinct(), _BROADCAST_KEYS)
    whole = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    others = whole.join(touched, "key", "left_anti")  # a NULL key is none of them
    kept = _of_nodes(whole.join(touched, "key", "left_semi"), judged.where("stays").select("key", "node"), width)
    return others.select("row").unionByName(kept).select("row.*")


def _of_nodes(rows: DataFrame, chosen: DataFrame, width: int) -> DataFrame:
    """``row`` of one of the rows (key, text, row) for each chosen (key, node), that of least text hash."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in slices(batches):
            sets = [shingler.shingles(value or "") for value in batch.column("text").to_pylist()]
            nodes = pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, nodes], ["key", "text", "row", "node"])

    schema = StructType([rows.schema["key"], rows.schema["text"], rows.schema["row"], StructField("node", BinaryType())])
    hashes = [F.xxhash64(F.col("row")[c]) for c, kind in rows.select("row.*").dtypes if "map<" not in kind]
    ordered = rows.select("key", "text", "row").mapInArrow(sign, schema)
    same = (F.col("r.key") == F.col("c.key")) & F.col("r.node").eqNullSafe(F.col("c.node"))
    hashed = ordered.alias("r").join(chosen.alias("c"), same).select("r.key", "r.row", "r.node", F.struct(F.xxhash64("r.text"), *hashes).alias("order"))
    # copies of one key and set can be a third of all rows: the least hash is found by sums, then one row of equal ones is taken
    least = hashed.groupBy("key", "node").agg(F.min("order").alias("order"))
    alike = (F.col("h.key") == F.col("l.key")) & F.col("h.node").eqNullSafe(F.col("l.node")) & (F.col("h.order") == F.col("l.order"))
    return hashed.alias("h").join(least.alias("l"), alike).select("h.*").dropDuplicates(["key", "node"]).select("row")

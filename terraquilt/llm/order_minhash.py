"""Order MinHash fingerprints: minimal occurrence-numbered k-mers of words, kept in text order, hashed as tuples.

SQL functions only. The k-mers of a text are an array of packed numbers; they are exploded and every
order is a minimum over them, so hashing runs in generated code. Arrays that a lambda reads are
columns of an earlier projection that is referenced more than once, so that Spark keeps them as columns.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window, functions as F

from terraquilt.llm.common import settle, text_of

#: Low bits of a packed number: a k-mer's place in its text; the bits above: its hash.
_PLACE_BITS = 28
_PLACE = (1 << _PLACE_BITS) - 1


def _packed(value: Column, place: Column) -> Column:
    return value.bitwiseAND(F.lit(~_PLACE)).bitwiseOR(place)


def _hash_of(packed: Column) -> Column:
    return F.shiftright(packed, _PLACE_BITS)


def _place_of(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit(_PLACE))


def _occurrence(ordered: Column, steps: Column, x: Column, i: Column) -> Column:
    """How many equal k-mers come before place ``i`` of the sorted array: halving steps back while the hash is the same."""
    return F.aggregate(steps, F.lit(0), lambda n, step: F.when(_same(ordered, x, i - n - step), n + step).otherwise(n))


def _same(ordered: Column, x: Column, j: Column) -> Column:
    """Whether the k-mer at ``j`` is that of ``x``; NULL before the start."""
    return F.shiftright(F.get(ordered, j).bitwiseXOR(x), _PLACE_BITS) == 0


def _numbered_kmers(df: DataFrame, text: str, k: int) -> DataFrame:
    """``df`` without ``text`` and with ``kmers``: one packed number each, of the hash of its words and occurrence, and its place.

    The k-mers are of k words; a text of fewer words is one k-mer, one without words none. Equal
    k-mers are told apart by their number of occurrence.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c != text]
    df = df.withColumn("_words", F.array_remove(F.split(F.col(text), "[\\x20\\x09-\\x0D]+"), "")).select(*kept, "_words")
    w = F.col("_words")
    starts = F.slice(w, F.lit(1), F.greatest(F.size(w) - (k - 1), F.lit(1)))
    kmers = F.transform(starts, lambda x, i: _packed(
        F.xxhash64(x, *[F.get(w, i + step) for step in range(1, k)]), i.cast("long")
    ))
    df = df.select(*kept, F.sort_array(kmers).alias("_ordered"))
    o = F.col("_ordered")
    powers = F.array(*[F.lit(1 << b) for b in range(_PLACE_BITS - 1, -1, -1)])
    df = df.withColumn("_steps", F.filter(powers, lambda step: step < F.size(o)))
    return df.select(*kept, F.transform(o, lambda x, i: F.when(
        _same(o, x, i - 1), _packed(F.xxhash64(_hash_of(x), _occurrence(o, F.col("_steps"), x, i)), _place_of(x))
    ).otherwise(x)).alias("kmers"))


def signatures(texts: DataFrame, text: str, name: str = "signature", k: int = 3, size: int = 32, seed: int = 11) -> DataFrame:
    """One row for each distinct value of the other columns of ``texts``, which decide ``text``: ``name`` and ``rows``.

    ``name`` is an array of ``size`` tuple hashes, ``rows`` how many rows there were. Each of ``size`` orders, that of the
    k-mers hashed with a number of its own, parts all k-mers of the text, whatever its length, in two
    halves by the sign of their hash and picks the least of each; the two are put in text order and hashed
    as a pair (a half without k-mers gives none; without any k-mer it is 0). Swapping passages changes pairs but not k-mers, so
    signatures follow edit distance where plain MinHash doesn't. Minima are found in one pass over the exploded k-mers and pre-aggregated;
    where ``texts`` is partitioned by one of its columns, nothing is shuffled.
    """
    names = [c for c in texts.columns if c != text]
    others = [f"o{i}" for i in range(len(names))]
    numbers = random.Random(seed)
    x = F.col("x")
    renamed = texts.select(*[F.col(f"`{c}`").alias(o) for c, o in zip(names, others)], F.col(f"`{text}`").alias("text"))
    exploded = _numbered_kmers(renamed, "text", k).select(*others, F.explode_outer("kmers").alias("x"))
    values = exploded.select(*others, x, *[
        _packed(F.xxhash64(_hash_of(x), F.lit(numbers.getrandbits(63))), _place_of(x)).alias(f"v{j}") for j in range(size)
    ])
    found = values.groupBy(*others).agg(
        F.sum(F.when(x.isNull() | (_place_of(x) == 0), 1).otherwise(0)).alias("rows"),
        *[F.min(f"v{j}").alias(f"a{j}") for j in range(size)],
        *[F.min(F.when(F.col(f"v{j}") >= 0, F.col(f"v{j}"))).alias(f"b{j}") for j in range(size)],
    )
    pairs = [_pair_hash(F.col(f"a{j}"), F.when(F.col(f"a{j}") < 0, F.col(f"b{j}"))) for j in range(size)]
    return found.select(*[F.col(o).alias(c) for c, o in zip(names, others)], "rows", F.array(*pairs).alias(name))


def _pair_hash(a: Column, b: Column) -> Column:
    """32 bits for two packed minima in text order; ``b`` is NULL for a lone one, ``a`` too for none (0)."""
    first, second = _hash_of(a), _hash_of(b)
    hashed = F.when(_place_of(a) > _place_of(b), F.xxhash64(second, first)).otherwise(F.xxhash64(first, second))
    return F.when(a.isNull(), F.lit(0).cast("long")).otherwise(hashed.bitwiseAND(F.lit(0xFFFFFFFF)))


def as_text(signature: Column) -> Column:
    """Eight hex digits for each hash."""
    return F.array_join(F.transform(signature, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """How much two signatures' texts have in common, 0 to 1.

    A place is equal if both k-mers of its pair are shared: the share of equal places is about the
    square of the Jaccard index J of the k-mers in order. Given is 2 J / (1 + J), the share of a text
    that the other has too: 0 with no equal place, 1 with all.
    """
    equal = F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same)
    jaccard = F.sqrt(F.size(equal) / F.size(a))
    return F.lit(2.0) * jaccard / (F.lit(1.0) + jaccard)


def next_keys(docs: DataFrame, key: str = "doc_id", ranges: int = 256) -> DataFrame:
    """For each distinct key (long): ``next``, the key after it in descending order, and for the least the greatest.

    Keys are cut at ``ranges`` sampled quantiles, so ranges hold like numbers of keys whatever
    the gaps between them, and put in order within a range; the ends of the ranges, one row each,
    are joined up by one small window. A lone key is its own next one. NULL keys have none.
    """
    ids = settle(docs.select(F.col(key).cast("long").alias("id")).where(F.col("id").isNotNull()).distinct(), "next-ids")
    bounds = ids.stat.approxQuantile("id", [i / ranges for i in range(1, ranges)], 0.25 / ranges)
    cuts = F.array(*[F.lit(int(b)).cast("long") for b in sorted(set(bounds))])
    part = F.size(F.filter(cuts, lambda b: b <= F.col("id"))) if bounds else F.lit(0)
    placed = settle(ids.withColumn("part", part), "next-parts")
    ends = placed.groupBy("part").agg(F.max("id").alias("top"))
    below = F.lead("top").over(Window.orderBy(F.col("part").desc()))
    first = F.first("top").over(Window.orderBy(F.col("part").desc()))
    follow = ends.select("part", F.coalesce(below, first).alias("follow"))
    inside = F.lead("id").over(Window.partitionBy("part").orderBy(F.col("id").desc()))
    return placed.withColumn("inside", inside).join(F.broadcast(follow), "part").select(  # one row a range
        "id", F.coalesce("inside", "follow").alias("next")
    )


def fingerprint_edits(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 3, size: int = 32) -> DataFrame:
    """Fingerprints of each document and of its edited text, and their likenesses.

    The edited text is the text with its last floor(n_chars / 2) code points replaced by the first as
    many (or all) of the next document, in descending order of the key; after the least key comes
    the greatest. near_edited and near_next are the likenesses of the document's fingerprint to
    the edited text's and the next document's. A NULL text is empty; two empty texts are alike
    (1.0). Documents that share a key share the next one, and stand before it with their least text.
    A row without key has no next document: nothing replaces its end, and near_next is 0.

    Whole texts are shuffled once, by key; the part of the next text that an edit needs follows
    to the document that needs it. Rows that repeat key and text are one until the end. Other columns are left out.
    """
    half = F.floor(F.col("n_chars") / 2).cast("int")
    follows = settle(next_keys(docs, key), "next-keys")
    needs = docs.select(F.col(key).alias("id"), F.char_length(text_of(text)).alias("n_chars")).groupBy("id").agg(
        F.floor(F.max("n_chars") / 2).cast("int").alias("part")
    )
    wanted = follows.join(needs, "id").select(F.col("id").alias("for_id"), F.col("next").alias("id"), "part")
    # never NULL, so that no join adds a filter on it to one of the two uses of the exchange of texts
    digest = F.coalesce(F.md5(F.encode("own", "UTF-8")), F.lit(""))
    texts = docs.select(F.col(key).alias("id"), text_of(text).alias("own"))
    # minima of own texts are sent, not the texts
    signed = settle(signatures(texts.select("id", digest.alias("digest"), "own"), "own", "signature", k, size), "signed")
    # all that reads texts below reads this one exchange, and stays where it put them
    own = texts.where(F.col("id").isNotNull()).repartition("id")
    heads = own.groupBy("id").agg(F.min("own").alias("head"))
    sent = wanted.join(heads, "id").select(
        F.col("for_id").alias("id"), F.left("head", F.least("part", F.char_length("head"))).alias("start"),
        F.col("id").alias("next"), F.md5(F.encode("head", "UTF-8")).alias("next_digest"),
    )

    def edits(rows: DataFrame, keys: list[str]) -> DataFrame:
        """The edited texts' lengths, hashes and signatures, for own, start and digest."""
        counted = rows.withColumn("n_chars", F.char_length("own").cast("long"))
        edited = F.concat(F.left("own", F.col("n_chars").cast("int") - half), F.left("start", half))
        made = counted.select(*keys, "digest", "n_chars", edited.alias("edited")).withColumn("edited_sha256", F.sha2(F.encode("edited", "UTF-8"), 256))
        return signatures(made, "edited", "edited_signature", k, size).drop("rows")

    paired = edits(own.withColumn("digest", digest).join(sent, "id", "left"), ["id", "next", "next_digest"])
    mine = (F.col("p.id") == F.col("s.id")) & (F.col("p.digest") == F.col("s.digest"))
    after = (F.col("p.next") == F.col("n.id")) & (F.col("p.next_digest") == F.col("n.digest"))
    named = paired.alias("p").join(signed.alias("s"), mine).join(signed.alias("n"), after, "left").select(
        "p.id", "p.n_chars", "p.edited_sha256", "p.edited_signature", "s.rows", "s.signature", F.col("n.signature").alias("next_signature")
    )
    nameless = texts.where(F.col("id").isNull()).withColumn("digest", digest).withColumn("start", F.lit(""))
    alone = edits(nameless, ["id"]).alias("p").join(signed.where(F.col("id").isNull()).alias("s"), "digest").select(
        "p.id", "p.n_chars", "p.edited_sha256", "p.edited_signature", "s.rows", "s.signature",
        F.lit(None).cast("array<bigint>").alias("next_signature"),
    )
    both = named.unionByName(alone).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return both.select(
        F.col("id").alias(key), "n_chars", "edited_sha256",
        as_text(F.col("signature")).alias("fingerprint"), as_text(F.col("edited_signature")).alias("edited_fingerprint"),
        likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
        F.coalesce(likeness(F.col("signature"), F.col("next_signature")), F.lit(0.0)).alias("near_next"),
    )

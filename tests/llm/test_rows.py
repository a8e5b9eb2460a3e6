"""Near duplicates, mixing, shards, packing and fingerprints against brute force, and on awkward rows."""

import hashlib
import math
import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from awkward_rows import awkward, renamed
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from terraquilt.llm import common, minhash, mixing, order_minhash, packing, sharding
from terraquilt.llm.queries import tokenizer_path

def words_of(text):
    return (text or "").encode().split()


def shingles(text, width):
    w = [x.lower() for x in words_of(text)]
    return frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def components(docs, width, percent):
    """Smallest id reachable over links, by comparing all pairs."""
    sets = {i: shingles(t, width) for i, t in docs}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def chained(seed=1):
    """A group of copies with more and more edits, whose ends are linked over the middle only, and a hub of variants."""
    rng = random.Random(seed)
    base = [f"t{rng.randrange(10**6)}" for _ in range(120)]
    docs, text = [], base[:]
    for i in range(25):
        docs.append(" ".join(text))
        text = text[:]
        text[rng.randrange(120)] = f"e{i}"
    for i in range(60):
        other = base[:]
        for _ in range(rng.randrange(1, 9)):
            other[rng.randrange(120)] = f"v{rng.randrange(10**6)}"
        docs.append(" ".join(other))
    docs += [" ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 60))) for _ in range(40)]
    rng.shuffle(docs)
    return list(enumerate(docs + docs[:10]))


@pytest.mark.parametrize("width, percent", [(3, 85), (5, 80)])
def test_components_match_all_pairs(spark, width, percent):
    docs = chained(width)
    got = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), width, percent).collect()
    want = components(docs, width, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_on_awkward_rows(spark):
    got = sorted(minhash.near_duplicates(awkward(spark), 3, 85).collect(), key=str)
    assert len(got) == 13
    of = defaultdict(list)
    for r in got:
        of[r.doc_id].append(r)
    assert [of[i][0].component_id for i in (1, 2, 3, 4, 5, 6, 7, 8, 9)] == [1, 1, 1, 4, 5, 6, 7, 8, 8]
    assert [of[i][0].n_shingles for i in (4, 5, 6, 7)] == [0, 0, 0, 1]
    assert len(of[10]) == 2 and all(r.kept for r in of[10])
    assert of[None][0].component_id is None and of[None][0].kept
    left = minhash.drop_near_duplicates(awkward(spark))
    assert left.columns == awkward(spark).columns
    assert Counter(r.doc_id for r in left.collect()) == Counter([1, 4, 5, 6, 7, 8, 10, None, 2**60 + 1])
    assert minhash.near_duplicates(awkward(spark).limit(0)).count() == 0


def worn(count, seed):
    """Copies of one text with up to 17 words replaced, many by common words, and copies of some of these."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(150)]
    texts = []
    for i in range(count):
        text = (texts[rng.randrange(len(texts))].split() if texts and rng.random() < 0.1 else base)[:]
        for _ in range(rng.choice([1, 2, 3, 4, 5, 6, 8, 11, 17])):
            at = rng.randrange(len(text))
            text[at:at + rng.choice([1, 1, 1, 0, 2])] = [rng.choice(["the", "and", "of", f"n{rng.randrange(9999)}"])]
        texts.append(" ".join(text))
    return texts


@pytest.mark.parametrize("width, percent", [(3, 85), (5, 80)])
def test_components_of_a_large_group_of_copies_match_all_pairs(spark, width, percent):
    texts = worn(3000, width)
    sets = [shingles(t, width) for t in texts]
    number = {}
    rows, columns = zip(*[(i, number.setdefault(x, len(number))) for i, s in enumerate(sets) for x in s])
    held = np.zeros((len(sets), len(number)), np.float32)
    held[rows, columns] = 1
    sizes = held.sum(axis=1)
    common = held @ held.T
    linked = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
    root = np.arange(len(sets))
    while True:
        least = np.where(linked, root[None, :], len(sets)).min(axis=1)
        if (least == root).all():
            break
        root = least
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, width, percent).collect()}
    assert got == dict(enumerate(root.tolist())) and 10 < len(set(got.values())) < 2900


def test_dropping_keeps_columns_of_any_name(spark):
    docs = renamed(awkward(spark))
    left = minhash.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter([1, 4, 5, 6, 7, 8, 10, None, 2**60 + 1])


def test_rows_of_one_key_with_unlinked_texts_all_stay(spark):
    rng = random.Random(2)
    texts = [" ".join(f"k{rng.randrange(10**6)}" for _ in range(40)) for _ in range(12)]
    rows = [(7, t) for t in texts] + [(7, texts[0])] * 3 + [(3, texts[1]), (9, texts[2]), (8, None), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = [tuple(r) for r in minhash.drop_near_duplicates(docs).collect()]
    assert Counter(left) - Counter([(8, None), (8, "")]) == Counter([(7, t) for t in texts if t != texts[1]] + [(3, texts[1])])
    assert len(left) == 13
    assert sorted(left, key=str) == sorted((tuple(r) for r in minhash.drop_near_duplicates(docs.repartition(5)).collect()), key=str)


def filled(sizes, weights, total, cap):
    """Clamp, reshare, repeat."""
    target, open_, left = {}, set(sizes), total
    while open_:
        per = left / sum(weights[s] for s in open_)
        over = {s for s in open_ if per * weights[s] > cap * sizes[s]}
        if not over:
            return target | {s: per * weights[s] for s in open_}
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def mixed_docs(seed=3):
    rng = random.Random(seed)
    sources = ["b", "a", None, "", "é", "z9"]
    return [(i, " ".join("w" for _ in range(int(rng.lognormvariate(3, 1)))), rng.choices(sources, [9, 5, 1, 1, 2, 2])[0]) for i in range(3000)]


def test_mix_matches_repeated_clamping(spark):
    rows = mixed_docs()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix_plan(docs).collect()
    again = mixing.mix_plan(docs.repartition(5)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)
    sizes, largest = Counter(), Counter()
    for _, t, s in rows:
        sizes[s] += len(words_of(t))
        largest[s] = max(largest[s], len(words_of(t)))
    order = sorted(s for s in sizes if s is not None) + [None]
    weights = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(order)}
    want = filled(sizes, weights, 1.5 * sum(sizes.values()), 2)
    taken = Counter()
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        assert r.taken == r.repeats * r.size and 0 <= r.repeats <= 2
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6
    copies = Counter(r.doc_id for r in mixing.mix_documents(docs).collect())
    assert copies == Counter({r.doc_id: r.repeats for r in got if r.repeats})


def test_repeated_keys_do_not_move_a_source_off_its_target(spark):
    rows = [(5, f"t{i} w w w", "a") for i in range(300)] + [(None, "n w w w", "a")] * 300 + [(i + 10, "u w w w", "b") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for weights in ((5.0, 2.0), (2.0, 5.0), (3.0, 4.0)):
        got = mixing.mix_plan(docs, weights, 1.2).collect()
        for s in "ab":
            own = [r for r in got if r.source == s]
            assert abs(sum(r.taken for r in own) - own[0].target) <= 2 + 1e-6
        copies = Counter((r.doc_id, r.source) for r in mixing.mix_documents(docs, weights, 1.2).collect())
        want = Counter()
        for r in got:
            want[r.doc_id, r.source] += r.repeats
        assert copies == +want


def test_mix_on_awkward_rows(spark):
    got = mixing.mix_plan(awkward(spark)).collect()
    assert len(got) == 13 and all(r.taken == r.repeats * r.size for r in got)
    assert {r.repeats for r in got if r.source == "y"} == {1}
    out = mixing.mix_documents(awkward(spark))
    assert out.columns == awkward(spark).columns and out.count() == sum(r.repeats for r in got)
    assert mixing.mix_plan(awkward(spark).limit(0)).count() == 0


def test_shards_grow_only_into_the_new_one_and_slots_are_gapless(spark):
    docs = spark.range(20_000).selectExpr("id * 7 AS doc_id", "CAST(id % 100 AS string) AS text")
    rows = sharding.shard_layout(docs).collect()
    slots = defaultdict(list)
    for r in rows:
        assert r.grown_shard in (r.shard, 8)
        text = str(r.doc_id // 7 % 100).encode()
        assert (r.size, r.text_crc32) == (len(text) + 1, zlib.crc32(text))
        slots[r.shard].append(r.slot)
    assert sorted(slots) == list(range(8))
    for s in slots.values():
        assert sorted(s) == list(range(len(s))) and abs(len(s) - 2500) < 250
    assert abs(sum(r.grown_shard == 8 for r in rows) - 20_000 / 9) < 250


def test_numbers_of_equal_rows_are_spread_and_gapless(spark, monkeypatch):
    monkeypatch.setattr(common, "_REPEATS", 50)
    rows = [(7, "a")] * 1000 + [(None, "b")] * 500 + [(i, "c") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = sharding.shard_layout(docs).collect()
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert len(found) == 2400 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert Counter((r.doc_id, r.text_crc32) for r in found) == Counter((i, zlib.crc32(t.encode())) for i, t in rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    tasks = sharding.shard_layout(docs).groupBy(F.spark_partition_id()).count().collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(r["count"] for r in tasks) < 900
    assert sorted(map(str, sharding.shard_layout(docs.repartition(3)).collect())) == sorted(map(str, found))
    assert sorted(map(str, sharding.shard_layout(docs.limit(0)).collect())) == []


def test_mixing_keeps_columns_of_any_name(spark):
    docs = renamed(awkward(spark))
    out = mixing.mix_documents(docs)
    assert out.columns == docs.columns
    want = Counter({(r.doc_id, r.source): 0 for r in docs.collect()})
    for r in mixing.mix_plan(docs).collect():
        want[r.doc_id, r.source] += r.repeats
    assert Counter((r.doc_id, r.source) for r in out.collect()) == +want


def test_shards_score_by_weight_over_exponential_draws(spark):
    """Rendezvous scores recomputed from plain hashes."""
    weights = (1.0, 2.0, 0.5)
    docs = spark.range(300).withColumnRenamed("id", "doc_id")
    def score(key, shard):
        h = 17
        state = xxhash.xxh64_intdigest(struct.pack("<q", key), 42)
        state = xxhash.xxh64_intdigest(struct.pack("<i", shard), state)
        h = xxhash.xxh64_intdigest(struct.pack("<i", h), state)
        return weights[shard] / -math.log(((h >> 12) + 0.5) / 2**52)
    for r in sharding.assign_shards(docs, weights=weights).collect():
        assert r.shard == max(range(3), key=lambda s: score(r.doc_id, s))


def test_shards_follow_weights_and_take_awkward_rows(spark):
    docs = spark.range(20_000).withColumnRenamed("id", "doc_id")
    counts = Counter(r.shard for r in sharding.assign_shards(docs, weights=(1.0, 0.0, 3.0)).collect())
    assert counts[1] == 0 and abs(counts[2] / counts[0] - 3) < 0.3
    rows = sharding.shard_layout(awkward(spark)).collect()
    assert len(rows) == 13 and {(r.size, r.text_crc32) for r in rows if r.doc_id in (4, 5)} == {(1, 0)}
    assert sharding.shard_layout(awkward(spark).limit(0)).count() == 0
    with pytest.raises(ValueError):
        sharding.assign_shards(docs, weights=())


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(tokenizer_path())
    found.encode_special_tokens = True
    return found


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*"ab é漢1'!.\n\t\u3000\xa0\x1c\x85", "  ", "'s", "<|endoftext|>", " the"]), max_size=30).map("".join))
def test_unit_ids_are_those_of_the_whole_text(text):
    from tokenizers import Tokenizer

    global _UNITS, _WHOLE
    if "_UNITS" not in globals():
        _UNITS, _WHOLE = packing.UnitTokenizer(tokenizer_path()), Tokenizer.from_file(tokenizer_path())
        _WHOLE.encode_special_tokens = True
    assert np.frombuffer(_UNITS.ids(text), "<u4").tolist() == _WHOLE.encode(text, add_special_tokens=False).ids


def test_packing_is_an_exact_round_trip_with_little_padding(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    ids = {i: library.encode(t, add_special_tokens=False).ids + [1] for i, t in texts.items()}
    pieces, places = defaultdict(list), defaultdict(list)
    for r in packing.pack_documents(docs, tokenizer_path()).collect():
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        pieces[r.doc_id].append((r.start, r.length))
        places[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(ids)
    for i, parts in pieces.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at and length > 0
            at += length
        assert at == len(ids[i])
    padding = 0
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert sorted(places) == list(range(len(places)))
    assert padding < 0.02 * sum(map(len, ids.values()))


def test_packing_awkward_rows(spark):
    rows = packing.pack_documents(awkward(spark), tokenizer_path()).collect()
    tokens = Counter()
    for r in rows:
        tokens[r.doc_id] += r.length
    assert tokens[4] == tokens[5] == 1 and tokens[10] % 2 == 0 and None in tokens
    assert all(sum(r.length for r in rows if r.doc_id == i) in (r2.doc_tokens, 2 * r2.doc_tokens) for i in tokens for r2 in rows if r2.doc_id == i)
    assert packing.pack_documents(awkward(spark).limit(0), tokenizer_path()).count() == 0


@given(st.integers(1, 20_000), st.sampled_from([64, 2048]))
def test_cut_lengths_add_up(tokens, capacity):
    parts = packing.cut_document(tokens, capacity)
    assert sum(parts) == tokens and all(0 < p <= capacity for p in parts)
    assert len(parts) <= tokens // capacity + 3
    assert all(packing.piece_class(p, capacity) * p <= capacity for p in parts)


def test_fingerprints_of_edits(spark):
    rng = random.Random(5)
    texts = {i * i * 1000 + 3: " ".join(rng.choice("abcdefghij") * 3 + str(rng.randrange(500)) for _ in range(rng.randrange(1, 200))) for i in range(60)}
    texts[2_000_000] = texts[3_481_003]
    texts[17] = ""
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    order = sorted(texts, reverse=True)
    following = dict(zip(order, order[1:] + order[:1]))
    got = {r.doc_id: r for r in order_minhash.fingerprint_edits(docs).collect()}
    assert set(got) == set(texts)
    edits = {}
    for i, text in texts.items():
        half = len(text) // 2
        edits[i] = text[:len(text) - half] + texts[following[i]][:half]
        assert got[i].n_chars == len(text)
        assert got[i].edited_sha256 == hashlib.sha256(edits[i].encode()).hexdigest()
    assert got[2_000_000].fingerprint == got[3_481_003].fingerprint != got[3].fingerprint
    assert all(0 <= v <= 1 for r in got.values() for v in (r.near_edited, r.near_next))
    long = [i for i in texts if len(texts[i]) > 400]
    assert np.mean([got[i].near_edited for i in long]) > np.mean([got[i].near_next for i in long if texts[i] != texts[following[i]]]) + 0.2


def order_minhash_of(text, k=3, size=32, seed=11):
    """The signature in plain Python, from the same hashes."""
    def mixed(*values):
        state = 42
        for v in values:
            if v is not None:
                raw = v.encode() if isinstance(v, str) else struct.pack("<i" if isinstance(v, np.int32) else "<q", v)
                state = xxhash.xxh64_intdigest(raw, state)
        return state - 2**64 if state >= 2**63 else state

    words = [w.decode() for w in words_of(text)]
    kmers = [words[i:i + k] for i in range(max(1, len(words) - k + 1))] if words else []
    seen, labels = Counter(), []
    for kmer in kmers:
        label = mixed(*kmer) >> 28
        n = seen[label]
        seen[label] += 1
        labels.append(mixed(label, np.int32(n)) >> 28 if n else label)
    numbers, out = random.Random(seed), []
    for _ in range(size):
        number = numbers.getrandbits(63)
        values = sorted((mixed(label, number) >> 28, place) for place, label in enumerate(labels))
        halves = [[v for v in values if v[0] < 0][:1], [v for v in values if v[0] >= 0][:1]]
        pair = sorted(halves[0] + halves[1], key=lambda v: v[1])
        out.append(mixed(*[v for v, _ in pair]) & 0xFFFFFFFF if pair else 0)
    return out


def test_signatures_match_plain_python(spark):
    rng = random.Random(6)
    texts = ["", " ", "x", "x y", "a b c d", "x x x x x x x", "é 漢 😀 ü"] + [
        " ".join(rng.choice(["the", "of", f"w{rng.randrange(50)}"]) for _ in range(rng.randrange(1, 400))) for _ in range(60)
    ]
    df = spark.createDataFrame([(i, t, "v0") for i, t in enumerate(texts)] + [(2, "x", "v0")] * 2, "id int, text string, a0 string")
    found = order_minhash.signatures(df, "text").collect()
    assert {r.id: r.signature for r in found} == {i: order_minhash_of(t) for i, t in enumerate(texts)}
    assert {r.id: r.rows for r in found} == {i: 3 if i == 2 else 1 for i in range(len(texts))}
    docs = df.select(F.col("id").cast("long").alias("doc_id"), "text").where("doc_id <> 2")
    order = sorted((i for i in range(len(texts)) if i != 2), reverse=True)
    next_of = dict(zip(order, order[1:] + order[:1]))
    for r in order_minhash.fingerprint_edits(docs).collect():
        text, other = texts[r.doc_id], texts[next_of[r.doc_id]]
        half = len(text) // 2
        own, edited = order_minhash_of(text), order_minhash_of(text[:len(text) - half] + other[:half])
        assert r.fingerprint == "".join(f"{x:08x}" for x in own) and r.edited_fingerprint == "".join(f"{x:08x}" for x in edited)
        for near, sig in ((r.near_edited, edited), (r.near_next, order_minhash_of(other))):
            j = math.sqrt(sum(a == b for a, b in zip(own, sig)) / 32)
            assert near == pytest.approx(2 * j / (1 + j))


def test_fingerprints_feel_order_where_sets_do_not(spark):
    words = [f"w{i}" for i in range(60)]
    swapped = " ".join(words[30:] + words[:30])
    rows = [(0, " ".join(words)), (1, swapped), (2, " ".join(words)), (3, "x x x x x x"), (4, "x x x x x x x"), (5, "x"), (6, "")]
    df = order_minhash.signatures(spark.createDataFrame(rows, "id int, text string"), "text", "sig")
    sig = {r.id: r.sig for r in df.collect()}
    assert sig[0] == sig[2] and set(sig[6]) == {0}
    assert sum(a == b for a, b in zip(sig[0], sig[1])) < 28
    assert sig[3] != sig[4] and all(len(s) == 32 for s in sig.values())


def test_fingerprints_of_long_texts_pick_from_all_kmers(spark):
    """A text of 2,400 words and its first half or two thirds: as many places are equal as the whole sets of k-mers say."""
    rng = random.Random(8)
    texts = []
    for i in range(20):
        words = [f"{i}w{rng.randrange(10**9)}" for _ in range(2400)]
        texts += [(3 * i, " ".join(words)), (3 * i + 1, " ".join(words[:1200])), (3 * i + 2, " ".join(words[:1600]))]
    df = order_minhash.signatures(spark.createDataFrame(texts, "id int, text string"), "text", "sig")
    sig = {r.id: r.sig for r in df.collect()}
    for part, jaccard in ((1, 1 / 2), (2, 2 / 3)):
        equal = np.mean([a == b for i in range(20) for a, b in zip(sig[3 * i], sig[3 * i + part])])
        assert abs(equal - jaccard ** 2) < 0.08


def test_fingerprints_of_awkward_rows(spark):
    rows = order_minhash.fingerprint_edits(awkward(spark)).collect()
    assert len(rows) == 13
    by = {r.doc_id: r for r in rows}
    assert by[4].n_chars == 0 and by[4].fingerprint == by[5].fingerprint
    assert by[2].near_next == 1.0 and by[None].near_next == 0.0
    assert by[1].edited_sha256 == hashlib.sha256(("a b c d" + " " + "far key")[:15].encode()).hexdigest()
    assert order_minhash.fingerprint_edits(awkward(spark).limit(0)).count() == 0
    lone = spark.createDataFrame([(5, "a b c d")], "doc_id long, text string")
    assert order_minhash.fingerprint_edits(lone).first().near_next == 1.0
    assert not math.isnan(by[9].near_edited)


def test_workers_get_few_texts_at_a_time(spark):
    whole = pa.RecordBatch.from_pydict({"text": [f"text {i}" for i in range(1300)]})
    parts = list(common.slices(iter([whole, whole.slice(0, 0)])))
    assert [p.num_rows for p in parts] == [512, 512, 276]
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([whole]))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        for given_rows, most in (("10000", 512), ("0", 512), ("100", 100)):
            spark.conf.set(name, given_rows)
            common.small_batches(spark)
            found = [r.n for r in spark.range(0, 1300, 1, 1).mapInArrow(sizes, "n long").collect()]
            assert max(found) == most and sum(found) == 1300
        spark.conf.set(name, "10000")
        docs = spark.createDataFrame([(1, "a b c d e f"), (2, "g h i j k l")], "doc_id long, text string")
        assert corpus_pipeline.dedup_stage(spark, docs, "").count() == 2
        assert spark.conf.get(name) == "512"
    finally:
        spark.conf.set(name, before)

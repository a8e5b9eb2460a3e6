"""Conversation repair against a plain search over all edits, whole and in fragments."""

import functools
import hashlib
import random
import re
import zlib

import pytest

from terraquilt.llm import conversation_repair as repair, queries

SPACE = " \t\n\x0b\x0c\r"


def best(rows):
    """(cost, audit, lines) of the cheapest edits, ties by audit, trying all edits of every turn."""
    seen, forced, extra = set(), [], []
    for _, role, text in rows:
        said = text.strip(SPACE)
        forced.append(not said or (role, text) in seen)
        extra.append(0 if said[-1:] in set(".!?") else 3)
        seen.add((role, text))
    expected = {"": "us", "s": "u", "u": "a", "a": "u"}

    @functools.lru_cache(None)
    def find(i, state, inserts):
        out = []
        if i == len(rows) and state in ("", "a"):
            out.append((0, "", ()))
        if inserts:
            new = "a" if state == "u" else "u"
            cost, audit, lines = find(i, new, inserts - 1)
            out.append((cost + 3, "I" + audit, (("user:" if new == "u" else "assistant:"), *lines)))
        if i < len(rows):
            _, role, text = rows[i]
            cost, audit, lines = find(i + 1, state, 2)
            out.append((cost + 4, "D" + audit, lines))
            if not forced[i]:
                if role[:1] in tuple(expected[state]):
                    cost, audit, lines = find(i + 1, role[0], 2)
                    out.append((cost + extra[i], "K" + audit, (f"{role}:{text}", *lines)))
                new = "a" if state == "u" else "u"
                cost, audit, lines = find(i + 1, new, 2)
                out.append((cost + 3 + extra[i], "R" + audit, (("user:" if new == "u" else "assistant:") + text, *lines)))
        return min(out, default=(10**9, "", ()))

    return find(0, "", 2)


def expected(table):
    """Report of every conversation of damaged rows, from (conv, turn, role, text, copies)."""
    out = {}
    for conv in {r[0] for r in table}:
        rows = []
        own = [(t, " " if r is None else r, " " if x is None else x, n) for c, t, r, x, n in table if c == conv]
        for t, role, text, n in sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())):
            rows += [(t, role, text)] * n
        counts, seen = [0, 0, 0], set()
        for _, role, text in rows:
            said = text.strip(SPACE)
            fault = 0 if not said else 1 if (role, text) in seen else 2 if said[-1] not in ".!?" else None
            if fault is not None:
                counts[fault] += 1
            seen.add((role, text))
        turns = [t for t, *_ in rows if t is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit, lines = best(tuple(rows))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
        out[conv] = (gaps, *counts, illegal, cost, audit, digest)
    return out


FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def reported(df):
    rows = df.collect()
    out = {r.conv_id: tuple(r[f] for f in FIELDS) for r in rows}
    assert len(out) == len(rows)
    return out


SCHEMA = "conv_id long, turn long, role string, text string, copies int, conv string, number int, part int, place long, fault int, ends int, entry int, said int, salt int"


def frame(spark, table):
    return spark.createDataFrame([(*r, "c", 1, 2, 3, 4, 5, 6, 7, 8) for r in table], SCHEMA)


def tangled(seed, convs=60, most=14):
    rng = random.Random(seed)
    out = []
    for conv in range(convs):
        for turn in range(rng.randrange(1, most)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "agent", None])
            text = rng.choice(["Yes.", "No!", "cut off", "", " \n", "Why? ", "Fine.", None, "a. b", "é漢."]) if rng.random() < 0.8 else f"t{rng.random()}."
            out.append((conv if conv else None, rng.choice([turn, turn, turn, turn * 3 - 5, None, 2]), role, text, rng.choice([0, 1, 1, 1, 1, 2])))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_reports_match_a_search_over_all_edits(spark, seed):
    table = tangled(seed)
    assert reported(repair.repair_report(frame(spark, table), copies="copies")) == expected(table)


def test_fragments_give_the_same_reports(spark, monkeypatch):
    table = tangled(3, 12, 40)
    table += [(500, 7, "user", "Same.", 1)] * 60 + [(501, i, "assistant" if i % 2 else "user", f"{i}.", 1) for i in range(41)]
    table += [(502, i, "user", "gone", 0) for i in range(30)] + [(503, None, None, None, 2)] * 9
    want = expected(table)
    for fragment in (4, 9):
        monkeypatch.setattr(repair, "FRAGMENT", fragment)
        df = frame(spark, table).repartition(5)
        assert reported(repair.repair_report(df, copies="copies")) == want
        turns = {}
        for r in sorted(repair.repaired_turns(df, copies="copies").collect(), key=lambda r: (str(r.conv_id), r.part, r.place)):
            turns.setdefault(r.conv_id, []).append(r)
        for conv, (*_, audit, digest) in want.items():
            own = turns.get(conv, [])
            assert "".join(r.edit for r in own) == audit
            lines = [f"{r.role}:{r.text}" for r in own if r.edit != "D"]
            assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == digest


def test_whole_query_matches_the_search(spark):
    sf_dir = "/root/testdata/sf0.01"
    table = []
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect():
        code = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        text = "" if code == 1 else re.sub("[.!?]", "", r.text) if code == 2 else r.text
        table.append((r.conv_id, r.turn, "user" if code == 4 else r.role, text, {0: 0, 3: 2}.get(code, 1)))
    assert reported(queries.QUERIES["op12_conversation_repair"](spark, sf_dir)) == expected(table)


def test_damage_of_nulls_and_empty_tables(spark):
    rows = [(None, None, None, None), (1, None, "user", "a."), (None, 3, None, "b."), (2, 2**62, "", ""), (2, -2**63, "system", "x" * 100_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for r in repair.damage(df).collect():
        conv, turn = (" " if v is None else v for v in (r.conv_id, r.turn))
        code = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        assert r.copies == {0: 0, 3: 2}.get(code, 1) and r.role is not None and r.text is not None
    found = reported(repair.repair_report(repair.damage(df), copies="copies"))
    assert set(found) == {None, 1, 2}
    assert repair.repair_report(repair.damage(df.limit(0)), copies="copies").count() == 0
    gone = reported(repair.repair_report(frame(spark, [(9, 1, "user", "x.", 0)]), copies="copies"))
    assert gone == {9: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}

"""Conversation structure repair: cheapest edits by cost DP, least audit by ranks over doubled path lengths.

A conversation has to read, in initials of its roles, ``(s?(ua)+)?``. Nodes are (turns passed,
state), the state being the role written last: nothing, system, user or assistant.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from terraquilt.llm.common import settle
from terraquilt.session import broadcast_if_small

#: Fixed costs of the edits.
DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3
#: Turns up to which a conversation is repaired by one task; longer ones are dealt out in fragments.
FRAGMENT = 4096

#: Character classes for patterns: white space, and the rest.
_SPACE, _OTHER = "[\\x20\\x09-\\x0D]", "[^\\x20\\x09-\\x0D]"
_FAR = 1 << 50
#: States: 0 nothing, 1 system, 2 user, 3 assistant. The role that an insert or rerole writes, and its state.
_NEXT = np.array([2, 2, 3, 2])
_WANTED = np.array([1, 1, 2, 1])
_ROLES = ("user", "user", "assistant", "user")
#: Cost from the end of a conversation in each state: what is missing is inserted.
_END = np.array([0, 2 * INSERT, INSERT, 0])
#: Letters of the edits by their ASCII order; 0 stands for the end.
_LETTERS = np.frombuffer(b"\0DIKR", np.uint8)


class Conversations:
    """Conversations (or fragments of one) whose turns lie one after the other, with costs and ranked paths of all nodes.

    ``initial`` is 0, 1, 2 for s, u, a and 3 for other roles, ``forced`` marks turns that must
    go, ``truncated`` those that cost more when they stay. ``ends`` are the costs from each state
    after the last turn; ``last`` says that nothing follows, so that edits may go on there.
    """

    def __init__(self, lengths: np.ndarray, initial: np.ndarray, forced: np.ndarray, truncated: np.ndarray, ends: np.ndarray,
                 last: bool = True):
        self.lengths = np.asarray(lengths, np.int64)
        self.base = np.cumsum(self.lengths) - self.lengths + np.arange(len(self.lengths))
        total = int(self.lengths.sum()) + len(self.lengths)
        self.cost, self.keep, self.rerole, self.delete = (np.full((total, 4), _FAR, np.int64) for _ in range(4))
        self.system = np.zeros(total, bool)
        self.last = last
        at_end = self.base + self.lengths
        self.cost[at_end] = ends
        self.ended = np.zeros(total, bool)
        self.ended[at_end] = True
        self._fill(initial, forced, np.where(truncated, TRUNCATED, 0))
        self.cost = np.minimum(self.cost, _FAR)

    def _fill(self, initial: np.ndarray, forced: np.ndarray, extra: np.ndarray) -> None:
        """The cost DP, from the last turns backwards, a turn of every conversation at a time."""
        order = np.argsort(-self.lengths, kind="stable")
        longest = self.lengths[order]
        for back in range(1, int(longest[0]) + 1 if len(longest) else 0):
            active = order[:np.searchsorted(-longest, -back, side="right")]
            node = self.base[active] + self.lengths[active] - back
            turn = node - active
            follow = self.cost[node + 1]
            after = follow[:, _NEXT]
            kind, must, more = initial[turn][:, None], forced[turn][:, None], extra[turn][:, None]
            keep = np.where(kind == _WANTED, after, _FAR)
            keep[:, 0] = np.where(kind[:, 0] == 0, follow[:, 1], keep[:, 0])
            keep = np.where(must, _FAR, keep + more)
            rerole = np.where(must, _FAR, after + REROLE + more)
            delete = follow + DELETE
            best = np.minimum(np.minimum(keep, rerole), delete)
            user = np.minimum(best[:, 2], best[:, 3] + INSERT)
            assistant = np.minimum(best[:, 3], best[:, 2] + INSERT)
            start = np.minimum(best[:, :2], user[:, None] + INSERT)
            self.cost[node] = np.column_stack([start, user, assistant])
            self.keep[node], self.rerole[node], self.delete[node] = keep, rerole, delete
            self.system[node] = initial[turn] == 0

    def rank(self) -> None:
        """Optimal arcs, ranks of all nodes by their least audits, and pointers over doubled lengths.

        Round k ranks the nodes by the first 2**k letters of their least audits: the ranks of a
        round, paired with those of the nodes that many letters on, order the next one. The arc of
        least letter, then least rank of its target, is a node's. An edit leads from a
        state to one state, so the arcs of a node have different letters.
        """
        total = len(self.cost)
        rows = np.arange(total)[:, None]
        states = np.arange(4)[None, :]
        reached = self.cost < _FAR
        inserted = self.cost[:, _NEXT] + INSERT
        open_ = ~self.ended[:, None] | self.last
        optimal = np.stack([
            (self.delete == self.cost) & reached, (inserted == self.cost) & reached & open_,
            (self.keep == self.cost) & reached, (self.rerole == self.cost) & reached,
        ])
        kept = np.broadcast_to(_NEXT, (total, 4)).copy()
        kept[self.system, 0] = 1
        targets = np.stack([
            (rows + 1) * 4 + states, rows * 4 + _NEXT[None, :] + 0 * states, (rows + 1) * 4 + kept, (rows + 1) * 4 + _NEXT[None, :] + 0 * states,
        ])
        optimal, targets = optimal.reshape(4, -1), targets.reshape(4, -1)
        itself = np.arange(total * 4)
        any_ = optimal.any(axis=0)
        first = optimal.argmax(axis=0)
        self.letter = np.where(any_, first + 1, 0)
        pointer = np.where(any_, targets[first, itself], itself)
        rank, pointers = self.letter.astype(np.int64), [pointer]
        while (self.letter[pointer] > 0).any():
            rank = np.unique(rank * (int(rank.max()) + 1) + rank[pointer], return_inverse=True)[1]
            pointer = pointer[pointer]
            pointers.append(pointer)
        chosen = np.where(optimal, np.arange(4)[:, None] * (int(rank.max(initial=0)) + 1) + rank[np.where(optimal, targets, 0)], _FAR)
        pick = chosen.argmin(axis=0)
        assert (np.where(any_, targets[pick, itself], itself) == pointers[0]).all()
        self.pointers = pointers

    def paths(self, entry: int = 0) -> np.ndarray:
        """The nodes of each conversation's least path from ``entry``, a row each, its end repeated."""
        found = (self.base * 4 + entry)[:, None]
        for pointer in self.pointers:
            found = np.concatenate([found, pointer[found]], axis=1)
        return found

    def turn_of(self, which: int, node: int) -> int:
        """Number of the turn before which a node of conversation ``which`` stands."""
        return (node >> 2) - which


def turn_columns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 copies: str | None = None) -> DataFrame:
    """conv, turn, role, text (NULL: one space), copies, initial, blank, truncated; the rest is left out."""
    said = F.coalesce(F.col(text), F.lit(" "))
    named = F.coalesce(F.col(role), F.lit(" "))
    blank = ~said.rlike(_OTHER)
    first = F.left(named, F.lit(1))
    return turns.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), named.alias("role"), said.alias("text"),
        (F.col(copies) if copies else F.lit(1)).cast("int").alias("copies"),
        F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3).alias("initial"),
        blank.alias("blank"), (~blank & ~said.rlike(f"[.!?]{_SPACE}*\\z")).alias("truncated"),
    )


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]


def _expanded(frame: pd.DataFrame) -> pd.DataFrame:
    """Rows as often as their copies say, with ``fault``: 1 blank, 2 duplicate, 3 truncated, 0 none."""
    frame = frame.loc[frame.index.repeat(frame["copies"])].reset_index(drop=True)
    seen = frame.duplicated(["number", "role", "text"]).to_numpy() | frame["earlier"].to_numpy(bool)
    frame["fault"] = np.select([frame["blank"].to_numpy(bool), seen, frame["truncated"].to_numpy(bool)], [1, 2, 3], 0)
    return frame


def _illegal(initial: np.ndarray) -> np.ndarray:
    """Whether each turn but the first is no legal follower of the one before it."""
    pair = initial[:-1] * 4 + initial[1:]
    return ~np.isin(pair, (0 * 4 + 1, 1 * 4 + 2, 2 * 4 + 1))


def _solved(frame: pd.DataFrame, lengths: np.ndarray, ends: np.ndarray, last: bool = True) -> Conversations:
    fault = frame["fault"].to_numpy()
    found = Conversations(lengths, frame["initial"].to_numpy(), (fault == 1) | (fault == 2), fault == 3, ends, last)
    found.rank()
    return found


def _edits(solved: Conversations, which: int, nodes: list[int], roles: list[str], texts: list[str]) -> Iterator[tuple]:
    """Turn number, letter, role and text of each edit on a path; None for what an edit hasn't."""
    for node in nodes:
        letter = "\0DIKR"[solved.letter[node]]
        if letter == "\0":
            return
        at = solved.turn_of(which, node)
        if letter == "I":
            yield None, letter, _ROLES[node & 3], ""
        elif letter == "D":
            yield at, letter, None, None
        else:
            yield at, letter, roles[at] if letter == "K" else _ROLES[node & 3], texts[at]


def _gaps(turns: np.ndarray, known: np.ndarray) -> int | None:
    found = turns[known]
    if not len(found):
        return 0
    value = int(found.max()) - int(found.min()) + 1 - len(np.unique(found))
    return value if value < 2**63 else None


_REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_TURNS = "part int, place long, edit string, turn long, role string, text string"


def _report(frame: pd.DataFrame, convs: pa.Array, turns: bool) -> dict:
    """Report rows of whole conversations (``number`` tells them apart, 0 to len(convs)), or their repaired turns."""
    frame = _expanded(frame.assign(earlier=False))
    numbers = frame["number"].to_numpy()
    lengths = np.bincount(numbers, minlength=len(convs))
    starts = np.cumsum(lengths) - lengths
    out: dict[str, list] = {name.split(" ")[0]: [None] * len(convs) for name in _REPORT.split(", ")}
    rows: dict[str, list] = {name.split(" ")[0]: [] for name in f"conv long, {_TURNS}".split(", ")}
    # conversations of like length together, so that paths of one table are about as long
    for size in np.unique(np.ceil(np.log2(lengths + 1))).tolist():
        chosen = np.flatnonzero(np.ceil(np.log2(lengths + 1)) == size)
        part = frame[np.isin(numbers, chosen)]
        solved = _solved(part, lengths[chosen], _END)
        paths = solved.paths()
        roles, texts = part["role"].tolist(), part["text"].tolist()
        turn, known = part["turn_number"].to_numpy(), part["turn_known"].to_numpy(bool)
        fault, initial = part["fault"].to_numpy(), part["initial"].to_numpy()
        audits = _LETTERS[solved.letter[paths]]
        offsets = np.cumsum(lengths[chosen]) - lengths[chosen]
        for k, (conv, start) in enumerate(zip(chosen.tolist(), offsets.tolist())):
            stop = start + int(lengths[conv])
            edits = list(_edits(solved, k, paths[k].tolist(), roles, texts))
            if turns:
                for place, (at, letter, role, text) in enumerate(edits):
                    number = int(turn[at]) if at is not None and known[at] else None
                    for name, value in zip(rows, (conv, 0, place, letter, number, role, text)):
                        rows[name].append(value)
                continue
            lines = [f"{role}:{text}" for _, letter, role, text in edits if letter != "D"]
            found = (
                _gaps(turn[start:stop], known[start:stop]), *(int((fault[start:stop] == f).sum()) for f in (1, 2, 3)),
                int(_illegal(initial[start:stop]).sum()), int(solved.cost[solved.base[k], 0]),
                audits[k].tobytes().rstrip(b"\0").decode(), hashlib.sha256("\n".join(lines).encode()).hexdigest(),
            )
            for name, value in zip(out, found):
                out[name][conv] = value
    if turns:
        return {"conv": convs.take(pa.array(rows.pop("conv"), pa.int64()))} | rows
    return {"conv": convs} | out


def _frame(table: pa.Table) -> pd.DataFrame:
    turn = table.column("turn")
    frame = table.select(["role", "text", "copies", "initial", "blank", "truncated"]).to_pandas()
    return frame.assign(
        turn_number=turn.fill_null(0).to_numpy(), turn_known=turn.is_valid().to_numpy(),
    )


def _short(rows: DataFrame, turns: bool) -> DataFrame:
    """Reports or repaired turns of conversations that fit a task: one shuffle by conversation, sorted, read as a stream."""
    kind = rows.schema["conv"].dataType.simpleString()
    schema = f"conv {kind}, {_TURNS if turns else _REPORT}"
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def done(table: pa.Table, convs: list, last: bool) -> tuple[pa.RecordBatch | None, pa.Table]:
            cuts = [i for i in range(1, len(convs)) if convs[i] != convs[i - 1]]
            if not last:
                if not cuts:
                    return None, table
                table, rest = table.slice(0, cuts[-1]), table.slice(cuts[-1])
                cuts.pop()
            else:
                rest = table.slice(0, 0)
            numbers = np.zeros(len(table), np.int64)
            numbers[cuts] = 1
            firsts = pa.array([0, *cuts], pa.int64())
            columns = _report(_frame(table).assign(number=np.cumsum(numbers)), table.column("conv").combine_chunks().take(firsts), turns)
            return pa.RecordBatch.from_pydict(columns, schema=arrow), rest

        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            found, held = done(held, held.column("conv").to_pylist(), False)
            if found is not None:
                yield found
        if held is not None and len(held):
            yield done(held, held.column("conv").to_pylist(), True)[0]

    ordered = rows.repartition("conv").sortWithinPartitions("conv", *_order())
    return ordered.mapInArrow(repair, schema)


def _fragments(rows: DataFrame, count: int) -> DataFrame:
    """Rows of long conversations in order, dealt out in ranges: ``part`` and ``place`` number them.

    Repeated rows are told apart by a salt, so that a turn that makes a third of all rows is cut too.
    ``earlier`` marks rows whose role and text an earlier part of their conversation has.
    """
    salted = rows.withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))
    keys = ["conv", *_order(), "salt"]
    ranged = salted.repartitionByRange(max(1, -(-2 * count // FRAGMENT)), *keys).sortWithinPartitions(*keys)
    placed = settle(
        ranged.withColumn("part", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id())
        .withColumn("said", F.md5(F.to_binary(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), F.lit("utf-8")))).drop("salt"), "turn-fragments"
    )
    # one row for each part that has a saying, whatever its number there
    parts = placed.where(F.col("copies") > 0).select("conv", "said", "part").distinct()
    first = parts.groupBy("conv", "said").agg(F.min("part").alias("first"), F.count(F.lit(1)).alias("parts")).where(F.col("parts") > 1)
    same = F.col("p.conv").eqNullSafe(F.col("f.conv")) & (F.col("p.said") == F.col("f.said")) & (F.col("p.part") > F.col("f.first"))
    again = parts.alias("p").join(first.alias("f"), same, "left_semi")
    here = F.col("r.conv").eqNullSafe(F.col("a.conv")) & (F.col("r.part") == F.col("a.part")) & (F.col("r.said") == F.col("a.said"))
    marked = placed.alias("r").join(again.alias("a"), here, "left")
    return settle(marked.select("r.*", F.col("a.said").isNotNull().alias("earlier")).drop("said"), "turn-fragments")


def _fragment(table: pa.Table) -> pd.DataFrame:
    table = table.sort_by("place")
    return _expanded(_frame(table).assign(number=0, earlier=table.column("earlier").to_numpy()))


def _per_fragment(rows: DataFrame, schema: str, work) -> DataFrame:
    """``work(frame, ends)`` on each fragment; rows with its conv and part."""
    kind = rows.schema["conv"].dataType.simpleString()

    def run(table: pa.Table) -> pa.Table:
        ends = table.column("ends")[0].as_py() if "ends" in table.column_names else None
        entry = table.column("entry")[0].as_py() if "entry" in table.column_names else 0
        found = work(_fragment(table), ends, entry)
        count = len(next(iter(found.values())))
        at = pa.array([0] * count, pa.int64())
        return pa.table({"conv": table.column("conv").combine_chunks().take(at), "part": table.column("part").combine_chunks().take(at)} | found)

    return rows.groupBy("conv", "part").applyInArrow(run, f"conv {kind}, part int, {schema}")


def _matrix(frame: pd.DataFrame, ends, entry) -> dict:
    """Least costs of a fragment from each state to each, its faults, and what its borders need."""
    costs = np.empty((4, 4), np.int64)
    fault, initial = frame["fault"].to_numpy(), frame["initial"].to_numpy()
    for state in range(4):
        solved = Conversations(
            np.array([len(frame)]), initial, (fault == 1) | (fault == 2), fault == 3, np.where(np.arange(4) == state, 0, _FAR), False
        )
        costs[:, state] = solved.cost[0]
    some = len(initial) > 0
    return {
        "costs": pa.array([costs.reshape(-1)], pa.list_(pa.int64())), "faults": pa.array([[int((fault == f).sum()) for f in (1, 2, 3)]]),
        "illegal": pa.array([int(_illegal(initial).sum())]), "first": pa.array([int(initial[0]) if some else None], pa.int32()),
        "last": pa.array([int(initial[-1]) if some else None], pa.int32()),
    }


def _exits(frame: pd.DataFrame, ends, entry) -> dict:
    """The state in which a fragment's least path from each state leaves it."""
    solved = _solved(frame, np.array([len(frame)]), np.array(ends["cost"]), ends["last"])
    return {"exits": pa.array([[int(solved.paths(state)[0, -1]) & 3 for state in range(4)]])}


def _written(frame: pd.DataFrame, ends, entry) -> dict:
    """The repaired turns of a fragment that is entered in the given state."""
    solved = _solved(frame, np.array([len(frame)]), np.array(ends["cost"]), ends["last"])
    turn, known = frame["turn_number"].to_numpy(), frame["turn_known"].to_numpy(bool)
    edits = list(_edits(solved, 0, solved.paths(entry)[0].tolist(), frame["role"].tolist(), frame["text"].tolist()))
    numbers = [int(turn[at]) if at is not None and known[at] else None for at, *_ in edits]
    return {
        "place": pa.array(range(len(edits)), pa.int64()), "edit": pa.array([e[1] for e in edits], pa.string()),
        "turn": pa.array(numbers, pa.int64()), "role": pa.array([e[2] for e in edits], pa.string()),
        "text": pa.array([e[3] for e in edits], pa.string()),
    }


def _ends(table: pa.Table) -> pa.Table:
    """Costs after each fragment of a conversation, from the last one backwards, and the sums of the whole."""
    rows = table.sort_by("part").to_pylist()
    cost, ends, last = _END.copy(), [], True
    for row in reversed(rows):
        ends.append({"cost": cost.tolist(), "last": last})
        matrix = np.array(row["costs"]).reshape(4, 4)
        cost, last = np.minimum((matrix + cost[None, :]).min(axis=1), _FAR), False
    seen = [(r["first"], r["last"]) for r in rows if r["first"] is not None]
    borders = sum(int(_illegal(np.array([a[1], b[0]]))[0]) for a, b in zip(seen, seen[1:]))
    faults = np.sum([r["faults"] for r in rows], axis=0).tolist()
    at = pa.array([0] * len(rows), pa.int64())
    kind = pa.struct([("cost", pa.list_(pa.int64())), ("last", pa.bool_())])
    return pa.table({
        "conv": table.column("conv").combine_chunks().take(at), "part": pa.array([r["part"] for r in rows], pa.int32()),
        "ends": pa.array(ends[::-1], kind), "faults": pa.array([faults] * len(rows), pa.list_(pa.int64())),
        "illegal": pa.array([borders + sum(r["illegal"] for r in rows)] * len(rows), pa.int64()),
        "total": pa.array([int(cost[0])] * len(rows), pa.int64()),
    })


def _entries(table: pa.Table) -> pa.Table:
    """The state in which each fragment is entered, from the first one on."""
    rows = table.sort_by("part").to_pylist()
    states = [0]
    for row in rows:
        states.append(row["exits"][states[-1]])
    at = pa.array([0] * len(rows), pa.int64())
    return pa.table({
        "conv": table.column("conv").combine_chunks().take(at), "part": pa.array([r["part"] for r in rows], pa.int32()),
        "entry": pa.array(states[:-1], pa.int32()),
    })


def _beside(rows: DataFrame, other: DataFrame) -> DataFrame:
    """``rows`` with the columns that ``other`` has for their fragment."""
    same = F.col("r.conv").eqNullSafe(F.col("o.conv")) & (F.col("r.part") == F.col("o.part"))
    added = [F.col(f"o.{c}") for c in other.columns if c not in ("conv", "part")]
    return rows.alias("r").join(other.alias("o"), same).select("r.*", *added)


def _long(rows: DataFrame, count: int) -> tuple[DataFrame, DataFrame]:
    """Repaired turns of long conversations, and conv, faults, illegal, total and gaps of each.

    Fragments are solved on their own: first each one's least costs between states, then, these
    added up from the end, its least paths; then, the states chained from the start, its edits.
    What a conversation brings together is one row for each fragment.
    """
    kind = rows.schema["conv"].dataType.simpleString()
    parts = _fragments(rows, count)
    matrices = _per_fragment(parts, "costs array<long>, faults array<long>, illegal long, first int, last int", _matrix)
    ends = settle(matrices.groupBy("conv").applyInArrow(_ends, (
        f"conv {kind}, part int, ends struct<cost: array<long>, last: boolean>, faults array<long>, illegal long, total long"
    )), "turn-ends")
    with_ends = _beside(parts, ends.select("conv", "part", "ends"))
    entries = settle(_per_fragment(with_ends, "exits array<long>", _exits).groupBy("conv").applyInArrow(
        _entries, f"conv {kind}, part int, entry int"
    ), "turn-entries")
    written = _per_fragment(
        _beside(with_ends, entries), "place long, edit string, turn long, role string, text string", _written
    )
    known = parts.where((F.col("copies") > 0) & F.col("turn").isNotNull()).groupBy("conv", "turn").agg(F.lit(1).alias("one"))
    span = F.max("turn").cast("decimal(38,0)") - F.min("turn").cast("decimal(38,0)") + 1 - F.count(F.lit(1))
    gaps = known.groupBy("conv").agg(span.alias("gaps"))
    sums = ends.groupBy("conv").agg(*[F.any_value(c).alias(c) for c in ("faults", "illegal", "total")])
    whole = sums.alias("s").join(gaps.alias("g"), F.col("s.conv").eqNullSafe(F.col("g.conv")), "left").select(
        "s.*", F.expr("try_cast(coalesce(g.gaps, 0) AS long)").alias("gaps")
    )
    return written, whole


def _hashed(written: DataFrame) -> DataFrame:
    """conv, audit and repaired_sha256 of repaired turns, read in order as a stream; of a conversation, only its audit is held."""
    kind = written.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, first, letters = None, None, True, []

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "conv": conv, "audit": pa.array(["".join(letters)]), "repaired_sha256": pa.array([state.hexdigest()]),
            })

        for batch in batches:
            convs = batch.column("conv")
            for i, (letter, role, text) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("edit", "role", "text")))):
                if state is None or convs[i].as_py() != conv[0].as_py():
                    if state is not None:
                        yield row()
                    conv, state, first, letters = convs.slice(i, 1), hashlib.sha256(), True, []
                letters.append(letter)
                if letter != "D":
                    state.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                    first = False
        if state is not None:
            yield row()

    ordered = written.repartition("conv").sortWithinPartitions("conv", "part", "place")
    return ordered.mapInArrow(run, f"conv {kind}, audit string, repaired_sha256 string")


def _split(rows: DataFrame) -> tuple[DataFrame, DataFrame | None, int]:
    """Rows of conversations that fit a task, those of longer ones (None without any) and their number."""
    sizes = rows.groupBy("conv").agg(F.sum(F.greatest("copies", F.lit(1))).alias("turns")).where(F.col("turns") > FRAGMENT)
    large = broadcast_if_small(sizes)
    count = large.agg(F.coalesce(F.sum("turns"), F.lit(0))).first()[0]
    if not count:
        return rows, None, 0
    same = F.col("r.conv").eqNullSafe(F.col("l.conv"))
    return (
        rows.alias("r").join(large.alias("l"), same, "left_anti"), rows.alias("r").join(large.alias("l"), same, "left_semi"), count,
    )


def repaired_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                   copies: str | None = None) -> DataFrame:
    """The edits of every conversation in order (conv, part, place): edit, turn, role and text as they stand after it.

    An inserted turn has no number and an empty text, a deleted one no role and text. See
    ``repair_report`` for the rules.
    """
    small, large, count = _split(turn_columns(turns, conv, turn, role, text, copies))
    columns = ["conv", "part", "place", "edit", "turn", "role", "text"]
    out = _short(small, True).select(*columns)
    out = out.unionByName(_long(large, count)[0].select(*columns)) if large is not None else out
    return out.withColumnRenamed("conv", conv)


def repair_report(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                  copies: str | None = None) -> DataFrame:
    """One row per conversation: conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Turns are read by number, NULL first, equal ones by role and text. A NULL role or text is one
    space; a NULL conv is a conversation of its own. ``copies`` names a column that says how often
    a row stands; 0 only names its conversation, and one without turns has zeros, an empty audit and the
    hash of nothing. A turn is blank, or a duplicate (role and text came before), or truncated,
    the first of these that holds. Kept turns cost 0, new roles 3, deletions 4 (the only way
    for blank ones and duplicates), inserts 3, truncated ones that stay 3 more. Of the cheapest
    edits those of the ASCII-least audit are taken. gaps of more than a long holds is NULL.

    Conversations of up to ``FRAGMENT`` turns go whole to a task, in one shuffle of their texts. Longer
    ones are dealt out in ranges and solved in fragments, with the same results; of those, only the
    hash of the whole text, and the audit it returns, is one stream. Other columns are left out.
    """
    small, large, count = _split(turn_columns(turns, conv, turn, role, text, copies))
    out = _short(small, False)
    if large is not None:
        written, whole = _long(large, count)
        same = F.col("w.conv").eqNullSafe(F.col("h.conv"))
        empty = F.lit(hashlib.sha256().hexdigest())
        out = out.unionByName(whole.alias("w").join(_hashed(written).alias("h"), same, "left").select(
            "w.conv", "w.gaps", *[F.col("w.faults")[i].alias(n) for i, n in enumerate(("blank", "duplicate", "truncated"))],
            "w.illegal", F.col("w.total").alias("cost"), F.coalesce("h.audit", F.lit("")).alias("audit"),
            F.coalesce("h.repaired_sha256", empty).alias("repaired_sha256"),
        ))
    return out.withColumnRenamed("conv", conv)


def damage(turns: DataFrame) -> DataFrame:
    """Rows of conversations with known faults: conv_id, turn, role, text and copies (0: dropped, 2: repeated).

    crc32 of ``conv_id:turn`` modulo 20 decides: 0 drops a row, 1 empties its text, 2 takes its
    ``[.!?]`` away, 3 repeats it, 4 makes its role user. NULLs are one space.
    """
    space = F.lit(" ")
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    code = F.pmod(F.crc32(F.encode(name, "UTF-8")), F.lit(20))
    said = F.coalesce("text", space)
    return turns.select(
        "conv_id", "turn", F.when(code == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(code <= 1, "").when(code == 2, F.regexp_replace(said, "[.!?]", "")).otherwise(said).alias("text"),
        F.when(code == 0, 0).when(code == 3, 2).otherwise(1).alias("copies"),
    )

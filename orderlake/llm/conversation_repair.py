"""Conversations brought into the form of an optional system turn and pairs of user and assistant, by the cheapest edits.

Rows. A conversation's rows are taken by turn, nulls first; of equal turns by role, then by the text's first LEADING
characters, then by a hash of role and text. A row's first fault counts: it is blank; its role and text were seen earlier; its
last character that isn't white space ends no sentence.

Lattice. A node is a place between rows and what the roles so far allow next. Keeping a row costs 0, giving it the role that
is due 2, deleting it 3, inserting an empty turn of the role that is due 2; a row that is cut off costs 1 more unless it is
deleted; blank and repeated rows must go. Heaps from the start and from the end settle nodes until the sum of their least costs
exceeds the best path: by then each cheapest path has an edge from a node settled from the start to one settled from the end.
Nodes get the least audit among their cheapest ones, from either side, and the least concatenation over those edges is taken.
An audit (K, R, D, I) determines its path, and two audits of equal cost up to one node are never one the start of the other,
so that the least parts make the least whole.

Size. A conversation may hold any share of all rows. Rows are placed by a range partitioning over hashes and short columns,
without their texts, and cut into chunks of at most CHUNK rows; the 16 costs of a chunk, from each state to each, are summed
from the last chunk to the first, then each chunk finds its audits for itself. Only these sums, a row for each chunk, meet in
one group. Texts are shuffled once, by conversation, and read as a stream, because a hash over the whole repaired conversation
is asked for; no task holds more than one row's text and the conversation's audit.

Nulls, ties, repeated rows: a null role or text is one space; rows without conversation are one conversation; null turns come
first and count in no gap; repeated rows are duplicates of their first one. A conversation without rows has an empty audit and
the hash of the empty string. Empty tables give empty results. Other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from heapq import heappop, heappush
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.scratch import stored

#: Rows of a chunk at most, as a power of two.
CHUNK_BITS = 12
#: Characters of a text that order rows of equal turn and role.
LEADING = 64
SPACES = " \t\n\x0b\x0c\r"

# What may come next: at the start, after the system turn, after a user, after an assistant. Only the first and the last may end.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
#: The state that the role that is due leads to, and that role.
DUE = (USER, USER, ASSISTANT, USER)
DUE_ROLE = ("user", "user", "assistant", "user")
#: By initial of a kept row, the states that it leads to.
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
LEGAL = {"su", "ua", "au"}
#: What is left to insert after the last row, by state.
TO_END = (0, 4, 2, 0)
INSERT, REROLE, DELETE, CUT_OFF = 2, 2, 3, 1
NEVER = 1 << 60


def damaged(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, role, text with faults put in, by a checksum of conversation and turn: one row in 20 is dropped, one loses its text, one its ends of sentences, one is repeated, one gets the role of the user."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(name(conv_id), F.lit(":"), name(turn)).cast("binary")) % 20
    told = F.when(fate == 1, F.lit("")).when(fate == 2, F.translate(name(text), ".!?", "")).otherwise(name(text))
    times = F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1)
    rows = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.when(fate == 4, F.lit("user")).otherwise(name(role)).alias("role"),
        told.alias("text"),
        F.explode(F.array_repeat(F.lit(0), times)).alias("_again"),
    )
    return rows.drop("_again")


def _edges(codes: str, tails: tuple[int, ...]) -> Callable[[int], list[tuple[str, int, int]]]:
    """By node its edges: letter, cost, node. Node 4 * i + state stands before row i; the last one is the end."""
    rows = len(codes) // 2
    end = STATES * (rows + 1)

    def of(node: int) -> list[tuple[str, int, int]]:
        if node == end:
            return []
        row, state = divmod(node, STATES)
        if row == rows:
            return [("", tails[state], end)] if tails[state] < NEVER else []
        initial, fault = codes[2 * row], codes[2 * row + 1]
        after = STATES * (row + 1)
        found = [("D", DELETE, after + state), ("I", INSERT, STATES * row + DUE[state])]
        if fault not in "BD":
            more = CUT_OFF if fault == "T" else 0
            kept = KEPT.get(initial, {}).get(state)
            if kept is not None:
                found.append(("K", more, after + kept))
            found.append(("R", REROLE + more, after + DUE[state]))
        return found

    return of


def _into(codes: str, tails: tuple[int, ...], edges: Callable) -> Callable[[int], list[tuple[str, int, int]]]:
    """By node the edges that lead to it: letter, cost, node where it comes from."""
    rows = len(codes) // 2
    end = STATES * (rows + 1)
    made: dict[int, dict[int, list[tuple[str, int, int]]]] = {}  # by row

    def around(row: int) -> dict[int, list[tuple[str, int, int]]]:
        if row not in made:
            made[row] = {}
            for node in range(STATES * row, STATES * (row + 1)):
                for letter, cost, to in edges(node):
                    made[row].setdefault(to, []).append((letter, cost, node))
        return made[row]

    def of(node: int) -> list[tuple[str, int, int]]:
        row = node // STATES if node != end else rows + 1
        found = around(row).get(node, []) if row <= rows else []
        return [*found, *(around(row - 1).get(node, []) if row else [])]

    return of


def _settle(heap: list[tuple[int, int]], costs: dict[int, int], done: set[int], edges: Callable, others: dict[int, int], best: int) -> int:
    """Takes the next node from the heap; gives the least cost of a whole path that is known by now."""
    cost, node = heappop(heap)
    if node in done:
        return best
    done.add(node)
    if node in others:
        best = min(best, cost + others[node])
    for _, more, to in edges(node):
        if cost + more < costs.get(to, NEVER):
            costs[to] = cost + more
            heappush(heap, (cost + more, to))
            if to in others:
                best = min(best, cost + more + others[to])
    return best


def cheapest(codes: str, entry: int = START, tails: tuple[int, ...] = TO_END) -> str | None:
    """The least audit of the cheapest paths from a state before the rows to the end, where tails are the costs of what follows, by state. codes: two characters for each row, its initial and its fault."""
    rows = len(codes) // 2
    start, end = entry, STATES * (rows + 1)
    edges = _edges(codes, tails)
    into = _into(codes, tails, edges)
    forward, backward = {start: 0}, {end: 0}
    ahead, behind = [(0, start)], [(0, end)]
    done_ahead: set[int] = set()
    done_behind: set[int] = set()
    best = NEVER
    while ahead and behind and ahead[0][0] + behind[0][0] <= best:
        if ahead[0][0] <= behind[0][0]:
            best = _settle(ahead, forward, done_ahead, edges, backward, best)
        else:
            best = _settle(behind, backward, done_behind, into, forward, best)
    if best >= NEVER:
        return None
    # Nodes below these costs are settled with all cheapest edges to them, or from them.
    below = ahead[0][0] if ahead else NEVER
    above = behind[0][0] if behind else NEVER
    first = {n: c for n, c in forward.items() if c < below}
    second = {n: c for n, c in backward.items() if c < above}
    row = lambda n: rows + 1 if n == end else n // STATES
    prefix: dict[int, str] = {start: ""} if start in first else {}
    for node in sorted(first, key=lambda n: (row(n), first[n])):
        for letter, cost, to in edges(node) if node in prefix else []:
            if first.get(to) == first[node] + cost:
                audit = prefix[node] + letter
                if to not in prefix or audit < prefix[to]:
                    prefix[to] = audit
    suffix: dict[int, str] = {end: ""} if end in second else {}
    for node in sorted(second, key=lambda n: (-row(n), second[n])):
        found = [letter + suffix[to] for letter, cost, to in edges(node) if to in suffix and second[to] + cost == second[node]]
        if found:
            suffix[node] = min(found)
    whole = [prefix[end]] if end in prefix and first[end] == best else []
    whole += [suffix[start]] if start in suffix and second[start] == best else []
    for node, audit in prefix.items():
        whole += [audit + letter + suffix[to] for letter, cost, to in edges(node) if to in suffix and first[node] + cost + second[to] == best]
    return min(whole)


def exit_state(codes: str, audit: str, state: int) -> int:
    """Where the audit leads from a state."""
    at = 0
    for letter in audit:
        if letter in "RI":
            state = DUE[state]
        elif letter == "K":
            state = KEPT[codes[at]][state]
        at += 0 if letter == "I" else 2
    return state


def chunk_costs(codes: str) -> list[int]:
    """From each state before the rows to each after them, the least cost; NEVER where no edits lead there."""
    out = []
    edges = _edges(codes, (0,) * STATES)
    for entry in range(STATES):
        costs = [NEVER] * STATES
        costs[entry] = 0
        for row in range(len(codes) // 2):
            for state in sorted(range(STATES), key=lambda s: costs[s]) * 2:  # an insertion may lead to another
                due = DUE[state]
                costs[due] = min(costs[due], costs[state] + INSERT)
            after = [NEVER] * STATES
            for state in range(STATES):
                for letter, cost, to in edges(STATES * row + state):
                    if letter != "I" and costs[state] + cost < after[to % STATES]:
                        after[to % STATES] = costs[state] + cost
            costs = after
        out += [min(c, NEVER) for c in costs]
    return out


def with_faults(turns: DataFrame, conv_id: Column, turn: Column, role: Column, text: Column) -> DataFrame:
    """conv_id, turn, role, text, and what orders and names rows: leading, name; code, the row's initial and its fault, but for repetition."""
    space = F.lit(" ")
    rows = turns.select(conv_id.alias("conv_id"), turn.alias("turn"), F.coalesce(role, space).alias("role"), F.coalesce(text, space).alias("text"))
    ending = F.rtrim("text", F.lit(SPACES))
    fault = F.when(ending == "", F.lit("B")).when(F.substring(ending, -1, 1).isin(".", "!", "?"), F.lit(".")).otherwise(F.lit("T"))
    initial = F.substring("role", 1, 1)
    name = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    return rows.withColumns({"leading": F.substring("text", 1, LEADING), "name": name, "code": F.concat(F.when(initial.isin(*KEPT), initial).otherwise(F.lit("-")), fault)})


_ORDER = ("turn", "role", "leading", "name")


def _chunks(rows: DataFrame) -> DataFrame:
    """By conversation and chunk: codes of its rows in order."""
    keys = ["conv_id", *_ORDER]
    placed = rows.select(*keys, "code").repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = stored(placed.select("conv_id", "name", "code", F.monotonically_increasing_id().alias("place")), "placed")
    again = placed.groupBy(F.col("conv_id").alias("of"), F.col("name").alias("same")).agg(F.min("place").alias("first"), F.count("*").alias("times"))
    again = stored(again.where("times > 1"), "repeated")
    marked = placed.join(again, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("name") == F.col("same")), "left")
    repeated = (F.col("place") > F.col("first")) & ~F.col("code").endswith("B")
    code = F.when(repeated, F.concat(F.substring("code", 1, 1), F.lit("D"))).otherwise(F.col("code"))
    marked = marked.select("conv_id", F.shiftrightunsigned("place", CHUNK_BITS).alias("chunk"), F.struct("place", code.alias("code")).alias("row"))
    codes = F.array_join(F.transform(F.sort_array(F.collect_list("row")), lambda r: r["code"]), "")
    return marked.groupBy("conv_id", "chunk").agg(codes.alias("codes"))


def _audits(chunks: DataFrame) -> DataFrame:
    """chunks: conv_id, chunk, codes. With audit, and whether the chunk is its conversation's last."""
    kind = chunks.schema["conv_id"].dataType.simpleString()
    chunks = stored(chunks, "chunks")
    several = chunks.groupBy(F.col("conv_id").alias("of")).agg(F.count("*").alias("n"), F.max("chunk").alias("end")).where("n > 1")
    several = stored(several, "several")
    same = F.col("conv_id").eqNullSafe(F.col("of"))
    long = chunks.join(several, same).select("conv_id", "chunk", "codes", (F.col("chunk") == F.col("end")).alias("last"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            audits = pa.array([cheapest(x) for x in batch.column("codes").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, audits], [*batch.schema.names, "audit"])

    schema = f"conv_id {kind}, chunk long, codes string, last boolean, audit string"
    alone = chunks.join(several, same, "left_anti").withColumn("last", F.lit(True)).mapInArrow(whole, schema)
    if several.isEmpty():
        return alone
    long = stored(long, "long")

    def cost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            costs = pa.array([chunk_costs(x) for x in batch.column("codes").to_pylist()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("chunk"), costs], ["of", "nth", "costs"])

    def tail(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("nth", "descending")])
        tails, tail = [], list(TO_END)
        for costs in rows.column("costs").to_pylist():
            tails.append(tail)
            tail = [min(NEVER, *(costs[STATES * s + t] + tail[t] for t in range(STATES))) for s in range(STATES)]
        return rows.drop_columns("costs").append_column("tails", pa.array(tails, pa.list_(pa.int64())))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            audits, exits = [], []
            for codes, tails in zip(batch.column("codes").to_pylist(), batch.column("tails").to_pylist(), strict=True):
                audits.append([cheapest(codes, s, tuple(tails)) for s in range(STATES)])
                exits.append([exit_state(codes, a, s) if a is not None else None for s, a in enumerate(audits[-1])])
            found = [pa.array(audits, pa.list_(pa.string())), pa.array(exits, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv_id", "chunk", "codes", "last")), *found], ["conv_id", "chunk", "codes", "last", "audits", "exits"])

    def follow(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("nth")
        entries = list(accumulate(rows.column("exits").to_pylist(), lambda state, exits: exits[state], initial=START))[:-1]
        return rows.drop_columns("exits").append_column("entry", pa.array(entries, pa.int32()))

    at = same & (F.col("chunk") == F.col("nth"))
    costs = long.mapInArrow(cost, f"of {kind}, nth long, costs array<long>")
    tails = costs.groupBy("of").applyInArrow(tail, f"of {kind}, nth long, tails array<long>")
    found = long.join(tails, at).select("conv_id", "chunk", "codes", "last", "tails")
    found = stored(found.mapInArrow(find, f"conv_id {kind}, chunk long, codes string, last boolean, audits array<string>, exits array<int>"), "found")
    states = found.select(F.col("conv_id").alias("of"), F.col("chunk").alias("nth"), "exits")
    entries = states.groupBy("of").applyInArrow(follow, f"of {kind}, nth long, entry int")
    chosen = found.join(entries, at).select("conv_id", "chunk", "codes", "last", F.element_at("audits", F.col("entry") + 1).alias("audit"))
    return alone.union(chosen)


class _Conversation:
    """Rows of one conversation as they come; turns of the repaired one as they are known."""

    def __init__(self):
        self.codes: list[str] = []
        self.audits: list[str] = []
        self.state, self.cost, self.rows, self.illegal = START, 0, 0, 0
        self.before = ""
        self.turns: tuple[int, int, int] | None = None  # least, greatest, distinct
        self._edits: Iterator[tuple[str, str]] | None = None

    def _next(self) -> Iterator[tuple[str, str]]:
        """The letters, each with the code of its row; inserted turns have none."""
        for codes, audit in zip(self.codes, self.audits, strict=True):
            at = 0
            for letter in audit:
                yield letter, "" if letter == "I" else codes[at : at + 2]
                at += 0 if letter == "I" else 2

    def _insert(self) -> tuple[str, str, str]:
        role = DUE_ROLE[self.state]
        self.state, self.cost = DUE[self.state], self.cost + INSERT
        return "I", role, ""

    def row(self, turn: int | None, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """letter, role, text of the turns up to this row's."""
        self._edits = self._edits or self._next()
        self.illegal += self.rows > 0 and self.before + role[:1] not in LEGAL
        self.before, self.rows = role[:1], self.rows + 1
        if turn is not None:
            low, high, n = self.turns or (turn, turn, 0)
            self.turns = low, turn, n + (n == 0 or turn != high)
        for letter, code in self._edits:
            if letter == "I":
                yield self._insert()
                continue
            self.cost += DELETE if letter == "D" else (REROLE if letter == "R" else 0) + (CUT_OFF if code[1] == "T" else 0)
            if letter == "R":
                yield letter, DUE_ROLE[self.state], text
                self.state = DUE[self.state]
            elif letter == "K":
                yield letter, role, text
                self.state = KEPT[code[0]][self.state]
            return

    def rest(self) -> Iterator[tuple[str, str, str]]:
        """What is inserted after the last row."""
        while TO_END[self.state]:
            yield self._insert()

    def figures(self) -> tuple:
        """Values of FIGURES."""
        low, high, distinct = self.turns or (0, -1, 0)
        faults = "".join(x[1::2] for x in self.codes)
        return high - low + 1 - distinct, faults.count("B"), faults.count("D"), faults.count("T"), self.illegal, self.cost


def _stream(turns: DataFrame, conv_id: str, turn: str, role: str, text: str, ids: DataFrame | None) -> tuple[DataFrame, str]:
    """Rows of every conversation, one after the other: first its name, then its audits, then its rows in order."""
    rows = with_faults(turns, F.col(conv_id), F.col(turn).cast("long"), F.col(role), F.col(text))
    kind = rows.schema["conv_id"].dataType.simpleString()
    audits = _audits(_chunks(rows))
    names = turns.select(F.col(conv_id).alias("conv_id"))
    names = (names if ids is None else names.union(ids.select(F.col(conv_id).alias("conv_id")))).distinct()
    none = lambda kind: F.lit(None).cast(kind)
    empty = {"turn": "long", "role": "string", "leading": "string", "name": "binary", "chunk": "long", "codes": "string", "audit": "string", "text": "string"}
    columns = ["conv_id", "part", "chunk", *_ORDER, "codes", "audit", "text"]
    filled = lambda df, part: df.select(*(F.lit(part).alias("part") if c == "part" else F.col(c) if c in df.columns else none(empty[c]).alias(c) for c in columns))
    every = filled(names, 0).union(filled(audits, 1)).union(filled(rows.drop("code"), 2))
    return every.repartition("conv_id").sortWithinPartitions("conv_id", "part", "chunk", *_ORDER), kind


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, _Conversation, Iterator[tuple[str, str, str]]]]:
    """Identifier, state and repaired turns of each conversation; the turns must be read before the next one is asked for."""
    records = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "part", "codes", "audit", "turn", "role", "text")), strict=True))
    waiting = next(records, None)

    def told(conversation: _Conversation) -> Iterator[tuple[str, str, str]]:
        nonlocal waiting
        while (waiting := next(records, None)) and waiting[1] > 0:
            _, part, codes, audit, turn, role, text = waiting
            if part == 1:
                conversation.codes.append(codes)
                conversation.audits.append(audit)
            else:
                yield from conversation.row(turn, role, text)
        yield from conversation.rest()

    while waiting:
        name, conversation = waiting[0], _Conversation()
        yield name, conversation, told(conversation)


FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repairs(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", ids: DataFrame | None = None) -> DataFrame:
    """By conversation: conv_id, FIGURES, audit, repaired_sha256 (of role:text of all repaired turns, joined by line ends). ids: rows with further conversations to report."""
    rows, kind = _stream(turns, conv_id, turn, role, text, ids)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[] for _ in range(len(FIGURES) + 3)]
        id_type = None

        def made() -> pa.RecordBatch:
            types = [id_type, *(pa.int64() for _ in FIGURES), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types, strict=True)], ["conv_id", *FIGURES, "audit", "repaired_sha256"])

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal id_type
            for batch in batches:
                id_type = batch.schema.field("conv_id").type
                yield batch

        for name, conversation, repaired in _conversations(typed()):
            digest, n = hashlib.sha256(), 0
            for _, said_by, told in repaired:
                digest.update(f"{chr(10) if n else ''}{said_by}:{told}".encode())
                n += 1
            audit = "".join(conversation.audits)
            audit += "I" * _trailing(conversation, n, audit)
            for column, value in zip(out, (name, *conversation.figures(), audit, digest.hexdigest()), strict=True):
                column.append(value)
            if len(out[0]) >= 4096:
                yield made()
                out = [[] for _ in out]
        if out[0]:
            yield made()

    figures = "".join(f"{c} long, " for c in FIGURES)
    return rows.mapInArrow(read, f"conv_id {kind}, {figures}audit string, repaired_sha256 string")


def _trailing(conversation: _Conversation, turns: int, audit: str) -> int:
    """Turns inserted after the last row: those that no letter of the audit stands for."""
    return turns - (len(audit) - audit.count("D"))


def repaired_turns(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), edit (K, R or I), role, text."""
    rows, kind = _stream(turns, conv_id, turn, role, text, None)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_type = None

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal id_type
            for batch in batches:
                id_type = batch.schema.field("conv_id").type
                yield batch

        out: list[tuple] = []
        made = lambda: pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (id_type, pa.int64(), pa.string(), pa.string(), pa.string()), strict=True)], ["conv_id", "place", "edit", "role", "text"])
        for name, _, repaired in _conversations(typed()):
            for place, (edit, said_by, told) in enumerate(repaired):
                out.append((name, place, edit, said_by, told))
                if len(out) >= 1000:
                    yield made()
                    out = []
        if out:
            yield made()

    return rows.mapInArrow(read, f"conv_id {kind}, place long, edit string, role string, text string")

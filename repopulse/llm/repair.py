"""Repair of conversation structure by a grammar-compressed dynamic program.

A conversation is a sequence of symbols, one per row: the initial of its role (system, user, assistant, other) and
whether the row must go (blank, or a duplicate), is cut short, or neither. The cheapest edits that make the roles
`(s?(ua)+)?` are found in the min-plus algebra: a symbol is a matrix over the states of that pattern, whose entries
are the least cost of getting from one state to another, the audit of the edits, and how it ranks among the others.

1. Sequences are cut into chunks of bounded length. Re-Pair turns the most frequent pairs of neighbouring symbols into
   rules, round by round, counted by Spark over the distinct chunks of all conversations.
2. Each rule's matrix is the product of the matrices of its two symbols, computed once, from below, and used
   wherever the rule occurs. An audit is a rope: an entry knows by which state its two parts meet. To break ties no
   audit is opened: each has as many letters for rows as any other of the same symbol and ends with such a letter,
   so none is the beginning of another, and audits of a product rank as the pairs of ranks of their parts.
3. A chunk is the product of its few symbols. Chunks of a long conversation are multiplied in groups, level by level,
   and the way through the states is handed down the same levels. Only then ropes are opened, chunk by chunk.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repopulse.llm.order import matched, ranged, running
from repopulse.llm.store import stored
from repopulse.llm.textops import prepare

#: Rows in a chunk at most, and nodes that are multiplied in one group.
CHUNK = 4096
FAN = 256
#: Rounds of Re-Pair and the rules that a round makes at most, so that a grammar is small enough to be sent to
#: every task whatever the size of the data. Pairs without a rule are multiplied where they stand.
ROUNDS = 8
PAIRS = 128

#: A row's symbol: initial of the role, as it is, cut short (capital), or to be deleted (w to z).
CLEAN, SHORT, GONE = "suao", "SUAO", "wxyz"
SYMBOLS = CLEAN + SHORT + GONE
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
SHORT_COST = 3
#: Pairs of neighbouring role initials that are in order.
LEGAL = ("su", "ua", "au")

START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: The state after a user's or an assistant's row, whichever may follow a state: what an insert or a change of role gives.
NEXT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
#: What must be inserted at the end, by state.
ENDING = ("", "II", "I", "")
NEVER = 1 << 50
WHITE = " \t\n\x0b\x0c\r"


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text after faults chosen by crc32(`conv_id:turn`) modulo 20: 0 drops a row, 1 empties
    its text, 2 takes `.`, `!` and `?` out of it, 3 repeats it, 4 makes the role `user`. Nulls are one space there,
    in role and text as well as in what is hashed; conv_id and turn stay null."""

    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20
    rows = conversations.select(
        "conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), fault.alias("fault")
    ).where("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("_copy")).drop("_copy")


class Matrix(NamedTuple):
    """From state to state: costs, ranks of the audits (equal for equal ones), the state between the two parts; and
    what the rows say of themselves: initials of the first and last, and pairs that are out of order."""

    cost: np.ndarray
    rank: np.ndarray
    via: np.ndarray
    first: str
    last: str
    illegal: int


def _dense(code: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Ranks from 0 of the codes of entries that can be reached."""
    rank = np.zeros(code.shape, np.int64)
    can = cost < NEVER
    rank[can] = np.unique(code[can], return_inverse=True)[1].reshape(-1)
    return rank


def product(left: Matrix, right: Matrix) -> Matrix:
    # Cost first, then the rank of the left audit and that of the right one: ranks are under 16.
    code = (left.cost[:, :, None] + right.cost[None]) * 256 + left.rank[:, :, None] * 16 + right.rank[None]
    via = code.argmin(axis=1)
    best = np.take_along_axis(code, via[:, None, :], axis=1)[:, 0, :]
    cost = np.minimum(best // 256, NEVER)
    crossing = left.last + right.first not in LEGAL
    illegal = left.illegal + right.illegal + crossing
    return Matrix(cost, _dense(best % 256, cost), via, left.first, right.last, illegal)


def _terminal(symbol: str) -> tuple[Matrix, dict[tuple[int, int], str]]:
    """A row's matrix, and the audits of its entries: inserts before the row and what is done to the row."""
    kind = next(k for k, group in enumerate((CLEAN, SHORT, GONE)) if symbol in group)
    initial = CLEAN[(CLEAN, SHORT, GONE)[kind].index(symbol)]
    extra = SHORT_COST if kind == 1 else 0
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for begin in range(4):
        state, cost, audit = begin, 0, ""
        for _ in range(3):  # no more inserts in a row can be of use
            ways = [(state, COST[DELETE], DELETE)]
            if kind < 2:
                ways.append((NEXT[state], COST[REROLE] + extra, REROLE))
                if initial == "s" and state == START:
                    ways.append((AFTER_S, extra, KEEP))
                if initial in "ua" and NEXT[state] == (AFTER_U if initial == "u" else AFTER_A):
                    ways.append((NEXT[state], extra, KEEP))
            for end, more, letter in ways:
                found = (cost + more, audit + letter)
                best[begin, end] = min(best.get((begin, end), found), found)
            state, cost, audit = NEXT[state], cost + COST[INSERT], audit + INSERT
    cost = np.full((4, 4), NEVER, np.int64)
    rank = np.zeros((4, 4), np.int64)
    order = sorted({audit for _, audit in best.values()})
    for place, (least, audit) in best.items():
        cost[place], rank[place] = least, order.index(audit)
    return Matrix(cost, rank, np.zeros((4, 4), np.int64), initial, initial, 0), {k: v[1] for k, v in best.items()}


class Grammar:
    """Symbols by number: those of rows, then a rule for each pair; and a matrix for each."""

    def __init__(self) -> None:
        found = [_terminal(symbol) for symbol in SYMBOLS]
        self.matrices = [matrix for matrix, _ in found]
        self.audits = [audits for _, audits in found]
        self.rules: list[tuple[int, int]] = []
        self._opened: dict[tuple[int, int, int], str] = {}

    def add(self, left: int, right: int) -> None:
        self.rules.append((left, right))
        self.matrices.append(product(self.matrices[left], self.matrices[right]))

    def rewrite(self, flat: np.ndarray, first: int = 0) -> np.ndarray:
        """Symbols, with -1 after each sequence, with the rules from number `first` on in place of their pairs."""
        for number in range(first, len(self.rules)):
            left, right = self.rules[number]
            at = np.flatnonzero((flat[:-1] == left) & (flat[1:] == right))
            if not len(at):
                continue
            if left == right:  # of a run every other one
                begins = np.r_[True, np.diff(at) > 1]
                since = at - at[begins][np.cumsum(begins) - 1]
                at = at[since % 2 == 0]
            flat[at] = len(SYMBOLS) + number
            flat = np.delete(flat, at + 1)
        return flat

    def sequences(self, texts: list[str]) -> list[np.ndarray]:
        """Each text of row symbols as the symbols that are left when all rules are applied."""
        flat = self.rewrite(flattened(texts))
        ends = np.flatnonzero(flat < 0)
        return [flat[begin:end] for begin, end in zip(np.r_[0, ends[:-1] + 1], ends)]

    def open(self, symbol: int, begin: int, end: int) -> str:
        """The audit of an entry."""
        out, waiting = [], [(symbol, begin, end)]
        while waiting:
            now, i, j = waiting.pop()
            if now < len(SYMBOLS):
                out.append(self.audits[now][i, j])
                continue
            known = self._opened.get((now, i, j))
            if known is None:
                left, right = self.rules[now - len(SYMBOLS)]
                k = int(self.matrices[now].via[i, j])
                if left < len(SYMBOLS) and right < len(SYMBOLS):
                    known = self._opened[now, i, j] = self.audits[left][i, k] + self.audits[right][k, j]
                else:
                    waiting += [(right, k, j), (left, i, k)]
                    continue
            out.append(known)
        return "".join(out)


def flattened(texts: list[str]) -> np.ndarray:
    joined = "\n".join([*texts, ""]).encode()
    return _NUMBER[np.frombuffer(joined, np.uint8)]


_NUMBER = np.full(256, -1, np.int32)
for _n, _c in enumerate(SYMBOLS):
    _NUMBER[ord(_c)] = _n


def fold(matrices: list[Matrix]) -> list[Matrix]:
    """The products of the first, the first two, and so on."""
    out = matrices[:1]
    for one in matrices[1:]:
        out.append(product(out[-1], one))
    return out


def ways(prefixes: list[Matrix], begin: int, end: int) -> list[tuple[int, int]]:
    """For each factor the states before and after it on the best way from `begin` to `end`."""
    out = []
    for k in range(len(prefixes) - 1, 0, -1):
        middle = int(prefixes[k].via[begin, end])
        out.append((middle, end))
        end = middle
    return [(begin, end), *out[::-1]]


def best_end(whole: Matrix) -> tuple[int, int]:
    """Least cost of a conversation and the state it is in before what is inserted at its end."""
    cost, _, end = min(
        (int(whole.cost[START, j]) + COST[INSERT] * len(ENDING[j]), int(whole.rank[START, j]), j) for j in range(4)
    )
    return cost, end


def learnt(chunks: DataFrame, rounds: int = ROUNDS, pairs: int = PAIRS) -> Grammar:
    """Re-Pair over `chunks` (symbols, many). A round makes rules of the most frequent pairs, by count and then by
    number, and replaces them in that order; the next counts what is left. Rules stop where no pair comes twice."""
    grammar = Grammar()
    now = stored(chunks.select("symbols", F.lit(None).cast("array<int>").alias("left"), "many"), "distinct")
    first, fresh = 0, True
    schema = "left array<int>, many long, pairs array<struct<a:int,b:int,n:long>>"
    for _ in range(rounds):
        shared = chunks.sparkSession.sparkContext.broadcast((grammar, first, fresh))

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, first, fresh = shared.value
            for batch in batches:
                if not batch.num_rows:
                    continue
                if fresh:
                    flat = flattened(batch.column("symbols").to_pylist())
                else:
                    left = batch.column("left")
                    lengths = left.value_lengths().to_numpy()
                    flat = np.insert(left.flatten().to_numpy().astype(np.int32), np.cumsum(lengths), -1)
                flat = own.rewrite(flat, first)
                ends = np.flatnonzero(flat < 0)
                row = np.repeat(np.arange(len(ends)), np.diff(np.r_[-1, ends]))
                many = batch.column("many").to_numpy()
                inside = (flat[:-1] >= 0) & (flat[1:] >= 0)
                size = len(SYMBOLS) + len(own.rules)
                code = flat[:-1][inside].astype(np.int64) * size + flat[1:][inside]
                found, which = np.unique(code, return_inverse=True)
                n = np.bincount(which, many[row[:-1][inside]], minlength=len(found)).astype(np.int64)
                counts = pa.StructArray.from_arrays(
                    [pa.array((found // size).astype(np.int32)), pa.array((found % size).astype(np.int32)), pa.array(n)],
                    names=["a", "b", "n"],
                )
                # The batch's counts stand in its first row.
                edges = np.r_[0, np.full(len(ends), len(found))].astype(np.int32)
                offsets = np.r_[0, ends - np.arange(len(ends))].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat[flat >= 0].astype(np.int32))),
                        batch.column("many"),
                        pa.ListArray.from_arrays(pa.array(edges), counts),
                    ],
                    names=["left", "many", "pairs"],
                )

        now = stored(now.mapInArrow(count, schema), "repair")
        frequent = now.select(F.explode("pairs").alias("p")).groupBy("p.a", "p.b").agg(F.sum("p.n").alias("n"))
        chosen = frequent.where("n > 1").orderBy(F.desc("n"), "a", "b").limit(pairs).collect()
        shared.unpersist()
        if not chosen:
            break
        first, fresh = len(grammar.rules), False
        for row in chosen:
            grammar.add(row.a, row.b)
        now = now.select(F.lit(None).cast("string").alias("symbols"), "left", "many")
    return grammar


def _numbered(rows: DataFrame) -> DataFrame:
    """Per row conv_id, position, symbol, blank, duplicate, truncated; texts are left behind."""
    trimmed = F.rtrim("text", F.lit(WHITE))
    narrow = rows.select(
        "conv_id",
        "turn",
        "role",
        F.sha2("text", 256).alias("digest"),
        (trimmed == "").alias("blank"),
        (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("open"),
        F.lit(1).cast("long").alias("one"),
    )
    order = [F.col("turn").asc_nulls_first(), "role", "digest"]
    placed = running(ranged(narrow, ["conv_id", *order], "turns"), ["conv_id"], order, "one", "upto")
    placed = stored(placed.select("conv_id", (F.col("upto") - 1).alias("position"), "role", "digest", "blank", "open"), "placed")
    firsts = placed.where("not blank").groupBy("conv_id", "role", "digest").agg(F.min("position").alias("position"))
    firsts = stored(firsts.select("conv_id", "position", F.lit(True).alias("first")), "firsts")
    joined = placed.alias("p").join(firsts.alias("f"), matched("p", "f", "conv_id", "position"), "left")
    named = joined.select("p.*", (F.col("f.first").isNull() & ~F.col("p.blank")).alias("duplicate"))
    kind = F.when(F.col("blank") | F.col("duplicate"), 2).when(F.col("open"), 1).otherwise(0)
    place = F.instr(F.lit(CLEAN), F.substring("role", 1, 1))
    # An empty role has no initial, and instr finds it at the first place.
    place = F.when((F.col("role") == "") | (place == 0), len(CLEAN)).otherwise(place)
    symbol = F.substr(F.lit(SYMBOLS), (kind * len(CLEAN) + place).cast("int"), F.lit(1))
    truncated = (kind == 1).cast("long").alias("truncated")
    return named.select(
        "conv_id", "position", symbol.alias("symbol"), F.col("blank").cast("long").alias("blank"),
        F.col("duplicate").cast("long").alias("duplicate"), truncated,
    )


def _chunks(numbered: DataFrame, chunk: int) -> DataFrame:
    """conv_id, block, symbols, blank, duplicate, truncated: a row per `chunk` rows of a conversation."""
    block = F.floor(F.col("position") / chunk).cast("long").alias("block")
    letters = F.array_sort(F.collect_list(F.struct("position", "symbol")))
    return numbered.groupBy("conv_id", block).agg(
        F.array_join(F.transform(letters, lambda x: x["symbol"]), "").alias("symbols"),
        *[F.sum(name).alias(name) for name in ("blank", "duplicate", "truncated")],
    )


_NODE = "conv_id long, block long, cost array<long>, rank array<long>, first string, last string, illegal long"
_GOAL = "conv_id long, block long, begin int, finish int, total long, illegal long"


def _as_row(conv_id: int | None, block: int, m: Matrix) -> list:
    return [conv_id, block, m.cost.ravel().tolist(), m.rank.ravel().tolist(), m.first, m.last, m.illegal]


def _of_rows(rows: list[dict]) -> list[Matrix]:
    def square(values: list[int]) -> np.ndarray:
        return np.array(values, np.int64).reshape(4, 4)

    return [Matrix(square(r["cost"]), square(r["rank"]), square([0] * 16), r["first"], r["last"], r["illegal"]) for r in rows]


def _table(rows: list[list], schema: pa.Schema) -> pa.Table:
    columns = list(map(list, zip(*rows))) if rows else [[] for _ in schema]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


_WIDE = pa.list_(pa.int64())
_NODES = pa.schema(
    [("conv_id", pa.int64()), ("block", pa.int64()), ("cost", _WIDE), ("rank", _WIDE), ("first", pa.string()),
     ("last", pa.string()), ("illegal", pa.int64())]
)
_GOALS = pa.schema(
    [("conv_id", pa.int64()), ("block", pa.int64()), ("begin", pa.int32()), ("finish", pa.int32()), ("total", pa.int64()),
     ("illegal", pa.int64())]
)


def _goals(chunks: DataFrame, grammar: Grammar, fan: int) -> DataFrame:
    """(conv_id, block, begin, finish, total, illegal) for the chunks of conversations that have several: the states
    before and after the chunk on the best way. Cost and illegal pairs of the whole stand in block 0."""
    shared = chunks.sparkSession.sparkContext.broadcast(grammar)

    def evaluate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            rows = batch.to_pylist()
            found = own.sequences([r["symbols"] for r in rows])
            out = [_as_row(r["conv_id"], r["block"], fold([own.matrices[s] for s in seq])[-1]) for r, seq in zip(rows, found)]
            yield from _table(out, _NODES).to_batches()

    def up(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["block"])
        return _table([_as_row(rows[0]["conv_id"], rows[0]["block"] // fan, fold(_of_rows(rows))[-1])], _NODES)

    def down(goals: pa.Table, nodes: pa.Table) -> pa.Table:
        out = []
        rows = sorted(nodes.to_pylist(), key=lambda r: r["block"])
        for goal in goals.to_pylist():
            for row, way in zip(rows, ways(fold(_of_rows(rows)), goal["begin"], goal["finish"])):
                first = row["block"] == 0
                out.append([row["conv_id"], row["block"], *way, goal["total"] if first else 0, goal["illegal"] if first else 0])
        return _table(out, _GOALS)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            ends = [best_end(m) for m in _of_rows(rows)]
            out = [[r["conv_id"], 0, START, end, cost, r["illegal"]] for r, (cost, end) in zip(rows, ends)]
            yield from _table(out, _GOALS).to_batches()

    long = chunks.where("block = 1").select(F.col("conv_id").alias("long_id"))
    several = chunks.join(long, F.col("conv_id").eqNullSafe(F.col("long_id")), "left_semi")
    levels = [stored(several.select("conv_id", "block", "symbols").mapInArrow(evaluate, _NODE), "nodes")]
    parent = F.floor(F.col("block") / fan).cast("long").alias("parent")
    while not levels[-1].where("block > 0").isEmpty():
        levels.append(stored(levels[-1].groupBy("conv_id", parent).applyInArrow(up, _NODE), "nodes"))
    goals = stored(levels.pop().mapInArrow(finish, _GOAL), "goals")
    for nodes in reversed(levels):
        above = goals.withColumn("parent", F.col("block")).groupBy("conv_id", "parent")
        goals = stored(above.cogroup(nodes.withColumn("parent", parent).groupBy("conv_id", "parent")).applyInArrow(down, _GOAL), "goals")
    return goals


_AUDIT = "conv_id long, block long, audit string, cost long, illegal long"


def _audits(chunks: DataFrame, grammar: Grammar, fan: int) -> DataFrame:
    """Per chunk the audit of its rows, with what is inserted after the last; cost and illegal in block 0."""
    goals = _goals(chunks, grammar, fan)
    shared = chunks.sparkSession.sparkContext.broadcast(grammar)
    last = goals.groupBy("conv_id").agg(F.max("block").alias("last"))
    goals = goals.alias("g").join(last.alias("l"), matched("g", "l", "conv_id"))
    goals = goals.select("g.*", (F.col("g.block") == F.col("l.last")).alias("ends"))
    joined = chunks.alias("c").join(goals.alias("g"), matched("c", "g", "conv_id", "block"), "left")
    asked = joined.select("c.conv_id", "c.block", "c.symbols", "g.begin", "g.finish", "g.total", "g.illegal", "g.ends")
    schema = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("audit", pa.string()), ("cost", pa.int64()), ("illegal", pa.int64())])

    def open_ropes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            rows = batch.to_pylist()
            texts = list(dict.fromkeys(r["symbols"] for r in rows))
            folded = {t: (seq, fold([own.matrices[s] for s in seq])) for t, seq in zip(texts, own.sequences(texts))}
            known: dict[tuple, tuple] = {}
            out = []
            for r in rows:
                key = r["symbols"], r["begin"], r["finish"], r["ends"]
                if key not in known:
                    seq, prefixes = folded[r["symbols"]]
                    cost, begin, end, ends = None, r["begin"], r["finish"], r["ends"]
                    if begin is None:  # the only chunk
                        (cost, end), begin, ends = best_end(prefixes[-1]), START, True
                    audit = "".join(own.open(int(s), i, j) for s, (i, j) in zip(seq, ways(prefixes, begin, end)))
                    known[key] = audit + (ENDING[end] if ends else ""), cost, prefixes[-1].illegal
                audit, cost, illegal = known[key]
                alone = cost is not None
                out.append([r["conv_id"], r["block"], audit, cost if alone else r["total"], illegal if alone else r["illegal"]])
            yield from _table(out, schema).to_batches()

    return asked.mapInArrow(open_ropes, _AUDIT)


class _Conversation:
    """A conversation that is gone through row by row, once its audit is known."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.audit: list[str] = []
        self.letters = ""
        self.at, self.state, self.position = 0, START, 0
        self.sums = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0)
        self.digest = hashlib.sha256()
        self.lowest = self.highest = None
        self.turns = 0

    def chunk(self, row: dict) -> None:
        self.audit.append(row["audit"])
        for name in self.sums:
            self.sums[name] += row[name]

    def _put(self, role: str, text: str, letter: str) -> list:
        self.state = AFTER_S if role[:1] == "s" else NEXT[self.state]
        self.digest.update((("\n" if self.position else "") + f"{role}:{text}").encode())
        self.position += 1
        return [self.conv_id, self.position - 1, role, text, letter]

    def _inserted(self) -> Iterator[list]:
        while self.letters[self.at : self.at + 1] == INSERT:
            self.at += 1
            yield self._put(self._fitting(), "", INSERT)

    def _fitting(self) -> str:
        return "user" if NEXT[self.state] == AFTER_U else "assistant"

    def row(self, row: dict) -> Iterator[list]:
        """The repaired rows up to this one."""
        if self.audit:
            self.letters, self.audit = "".join(self.audit), []
        if (turn := row["turn"]) is not None:
            self.turns += self.highest is None or turn != self.highest
            self.lowest = turn if self.lowest is None else self.lowest
            self.highest = turn
        yield from self._inserted()
        letter = self.letters[self.at]
        self.at += 1
        if letter != DELETE:
            yield self._put(row["role"] if letter == KEEP else self._fitting(), row["text"], letter)

    def end(self) -> Iterator[list]:
        yield from self._inserted()
        if self.at != len(self.letters):
            raise ValueError(f"conversation {self.conv_id}: its audit has more letters than rows")

    def summary(self) -> list:
        gaps = 0 if self.lowest is None else self.highest - self.lowest + 1 - self.turns
        s = self.sums
        faults = [s["blank"], s["duplicate"], s["truncated"], s["illegal"], s["cost"]]
        return [self.conv_id, gaps, *faults, self.letters, self.digest.hexdigest()]


def _gone_through(planned: DataFrame, out: Callable[[list, _Conversation | None], list | None], schema: pa.Schema) -> DataFrame:
    """What `out` makes of each repaired row, and of each conversation at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Conversation | None = None
        found: list[list] = []

        def take(rows: Iterator[list]) -> None:
            found.extend(x for x in (out(row, None) for row in rows) if x is not None)

        def done() -> None:
            if now is not None:
                take(now.end())
                if (last := out([], now)) is not None:
                    found.append(last)

        for batch in batches:
            for row in batch.to_pylist():
                if now is None or row["conv_id"] != now.conv_id:
                    done()
                    now = _Conversation(row["conv_id"])
                if row["kind"] == 1:
                    now.chunk(row)
                elif row["kind"] == 2:
                    take(now.row(row))
            if found:
                yield from _table(found, schema).to_batches()
                found.clear()
        done()
        if found:
            yield from _table(found, schema).to_batches()

    fields = ", ".join(f"{f.name} {'long' if f.type == pa.int64() else 'string'}" for f in schema)
    order = ["conv_id", "kind", "block", F.col("turn").asc_nulls_first(), "role", "digest"]
    return planned.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(run, fields)


def planned(rows: DataFrame, original: DataFrame | None = None, chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """The rows with the audits of their conversations, as `repaired` and `summaries` read them.

    `rows` has conv_id, turn, role and text; other columns are ignored. Rows are in order of turn, nulls first, then
    of role and of the text's digest. A null role or text is one space; a row with an empty role has no initial and
    cannot stay as it is; rows with a null conv_id are one conversation.
    Conversations of `original` that have no row have an empty audit. A conversation's rows are spread over many tasks
    but where its texts are written or hashed in order, which one task does row by row.
    """
    prepare(rows)
    rows = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(name) for name in ("role", "text")],
    )
    chunks = stored(_chunks(_numbered(rows), chunk), "chunks")
    grammar = learnt(chunks.groupBy("symbols").agg(F.count("*").alias("many")))
    audits = _audits(chunks, grammar, fan).alias("a")
    told = chunks.alias("c").join(audits, matched("a", "c", "conv_id", "block"))
    told = told.select(
        "a.conv_id", "a.block", "a.audit", "a.cost", "a.illegal", "c.blank", "c.duplicate", "c.truncated", F.lit(1).alias("kind")
    )
    texts = rows.select("*", F.sha2("text", 256).alias("digest"), F.lit(2).alias("kind"))
    parts = told.unionByName(texts, allowMissingColumns=True)
    if original is not None:
        ids = original.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
        parts = parts.unionByName(ids.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    return parts


_ROW = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])
_SUMMARY = pa.schema(
    [("conv_id", pa.int64()), *[(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
     ("audit", pa.string()), ("repaired_sha256", pa.string())]
)


def repaired(plan: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, position, role, text, and the edit that gave the row (K, R or I)."""
    return _gone_through(plan, lambda row, ended: row if ended is None else None, _ROW)


def summaries(plan: DataFrame) -> DataFrame:
    """Per conversation conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256."""
    return _gone_through(plan, lambda row, ended: None if ended is None else ended.summary(), _SUMMARY)


ORACLE = r"""
with recursive hashed as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce("text", ' ') as t,
           xor(4294967295, list_reduce(list_concat([4294967295::bigint], list_transform(
               string_split(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '), ''), lambda x: ord(x)::bigint)),
               lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)),
                                        lambda d, i: case when d % 2 = 1 then xor(d // 2, 3988292384) else d // 2 end))) % 20 as fault
    from conversations),
hurt as (
    select conv_id, turn, case when fault = 4 then 'user' else role end as role,
           case when fault = 1 then '' when fault = 2 then translate(t, '.!?', '') else t end as t,
           unnest(case when fault = 3 then [0, 1] else [0] end) as again
    from hashed where fault <> 0),
placed as (select conv_id, turn, role, t, left(role, 1) as initial, not regexp_matches(t, '[^\x20\x09-\x0D]') as blank,
                  row_number() over (partition by conv_id order by turn nulls first, role, sha256(t)) as place from hurt),
seen as (select *, not blank and row_number() over (partition by conv_id, role, t order by place) > 1 as duplicate from placed),
turns as (select *, not blank and not duplicate
                 and regexp_extract(t, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) not in ('.', '!', '?') as truncated,
                 lag(initial) over (partition by conv_id order by place) || initial as pair from seen),
nexts(state, n) as (values (0, 2), (1, 2), (2, 3), (3, 2)),
names(n, added) as (values (2, 'user:'), (3, 'assistant:')),
inserts as (
    select state as begin, state as middle, '' as letters, '' as added, 0 as price from nexts
    union all select s.state, s.n, 'I', a.added || chr(10), 3 from nexts s join names a using (n)
    union all select s.state, t.n, 'II', a.added || chr(10) || b.added || chr(10), 6
    from nexts s join nexts t on t.state = s.n join names a on a.n = s.n join names b on b.n = t.n),
walk as (
    select conv_id, 0::bigint as place, 0 as state, 0::bigint as cost, {'audit': '', 'text': ''} as best
    from turns group by conv_id
    union all
    select conv_id, place, state, min(cost), arg_min({'audit': audit, 'text': made}, (cost, audit)) from (
        select r.conv_id, r.place, case e.edit when 'D' then i.middle when 'R' then m.n else if(r.initial = 's', 1, m.n) end as state,
               w.cost + i.price + case e.edit when 'D' then 4 when 'R' then 3 else 0 end
                   + if(e.edit <> 'D' and r.truncated, 3, 0) as cost,
               w.best.audit || i.letters || e.edit as audit,
               w.best.text || i.added || case e.edit when 'D' then '' when 'K' then r.role || ':' || r.t || chr(10)
                                                     else a.added || r.t || chr(10) end as made
        from walk w join turns r on r.conv_id is not distinct from w.conv_id and r.place = w.place + 1
        join inserts i on i.begin = w.state join nexts m on m.state = i.middle join names a on a.n = m.n,
             (select unnest(['D', 'K', 'R']) as edit) e
        where e.edit = 'D' or not (r.blank or r.duplicate) and (e.edit = 'R' or r.initial = 's' and i.middle = 0
              or r.initial = 'u' and m.n = 2 or r.initial = 'a' and m.n = 3)) steps
    group by conv_id, place, state),
counts as (
    select conv_id, max(turn) - min(turn) + 1 - count(distinct turn) as gaps, count(*) filter (blank) as blank,
           count(*) filter (duplicate) as duplicate, count(*) filter (truncated) as truncated,
           count(*) filter (pair is not null and pair not in ('su', 'ua', 'au')) as illegal, max(place) as places
    from turns group by conv_id),
ended as (
    select w.conv_id, w.cost + 3 * length(e.letters) as cost, w.best.audit || e.letters as audit, w.best.text || e.added as made
    from walk w join counts c on c.conv_id is not distinct from w.conv_id and c.places = w.place
    join (values (0, '', ''), (1, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)), (2, 'I', 'assistant:' || chr(10)), (3, '', ''))
         e(state, letters, added) on e.state = w.state),
cheapest as (select conv_id, min(cost) as cost, arg_min({'audit': audit, 'text': made}, (cost, audit)) as best from ended group by conv_id)
select o.conv_id, cast(coalesce(c.gaps, 0) as bigint) as gaps, coalesce(c.blank, 0) as blank, coalesce(c.duplicate, 0) as duplicate,
       coalesce(c.truncated, 0) as truncated, coalesce(c.illegal, 0) as illegal, coalesce(b.cost, 0) as cost,
       coalesce(b.best.audit, '') as audit,
       sha256(case when coalesce(b.best.text, '') = '' then '' else left(b.best.text, length(b.best.text) - 1) end) as repaired_sha256
from (select distinct conv_id from conversations) o
left join counts c on c.conv_id is not distinct from o.conv_id
left join cheapest b on b.conv_id is not distinct from o.conv_id
"""

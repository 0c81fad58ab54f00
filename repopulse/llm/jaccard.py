"""Similarity join on word shingles with a token-group matrix.

Two documents link when the Jaccard similarity of their sets of 5-word shingles is 0.8 or more; a
component holds what links connect. The join is exact:

1. Documents with the same set become one node.
2. A node is compared with the most typical of those that share two min-hashes with it. Links among these join most of a
   large group of near copies before anything else. Nodes that are similar to the same typical one, which asks for less
   than a link does, are a family, and make groups of about one size and of `GROUP` members at most, about.
3. The matrix holds each group's union of tokens: (token, group), with the sizes and positions it has there. Tokens are
   ordered from rare to frequent, and only a set's first tokens go in: two sets with similarity 0.8 share some of
   these, so the tokens that two rows of groups share bound the overlap of any two members. Groups meet in the matrix,
   not documents, so a family of thousands is a few rows for each token.
4. Only pairs of groups are opened that the bound leaves, and not those whose members have all come together. There a
   query's whole set is first held against the union of the other group's tokens, and then, where that is enough,
   against the members that it is not connected with.

What groups there are decides how fast the join is, and never what it finds.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repopulse.llm import textops as T
from repopulse.llm.components import components
from repopulse.llm.store import IdFilter, stored, without

SHINGLE = 5
#: Least similarity, in hundredths.
LEAST = 80
#: How many more first tokens than one common one would need.
MORE = 3
#: Pairs that are compared at a time.
_PAIRS = 256
MIN_HASHES = 6
#: Least similarity, in hundredths, of a node and the typical one that its family is named after.
LOOSE = 25
#: Sizes in a group differ by this factor at most, so that bounds by size are close.
BAND = 1.12
#: Members of a group at most, about; a task compares two groups.
GROUP = 256
#: Tokens per slot of the table of token frequencies, and its most slots, of a byte each: so many at
#: most are broadcast. More tokens than these have room for blur the order, which costs time only.
TOKENS_PER_SLOT = 16
MOST_SLOT_BITS = 24
_BLOCK = 1 << 14
_RANK_SHIFT = np.uint64(58)


def shingles(chunk: T.Chunk, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every shingle, in order of rows. A text with fewer words is one shingle."""
    data = T.lower_ascii(chunk.data)
    found = T.words(chunk)
    hashes = T.word_hashes(data, found)
    value, at = T.ngrams(hashes, found.row, size)
    row = found.row[at]
    length = T.per_row(found.row, chunk.rows)
    few = (length > 0) & (length < size)
    if few.any():
        parts, rows = [value], [row]
        small = few[found.row]
        h, r = hashes[small], found.row[small]
        for n in range(1, size):
            v, a = T.ngrams(h, r, n)
            exact = length[r[a]] == n
            parts.append(v[exact])
            rows.append(r[a][exact])
        value, row = np.concatenate(parts), np.concatenate(rows)
        order = np.argsort(row, kind="stable")
        value, row = value[order], row[order]
    return value, row


def _bits(docs: DataFrame) -> int:
    """Bits of a slot's number for these documents, by the characters that they have."""
    characters = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    slots = characters / 6 / TOKENS_PER_SLOT
    return int(min(MOST_SLOT_BITS, max(14, np.ceil(np.log2(slots + 1)))))


def token_ranks(docs: DataFrame, size: int) -> np.ndarray:
    """By slot of a token's hash how frequent it is: 0 for up to the usual count, and one more for
    each doubling. A task's count of a slot stops at 255, which is frequent in any case."""
    bits = _bits(docs)
    shift = np.uint64(64 - bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, np.uint8)
        for batch in T.each(batches):
            for chunk in T.chunks(batch.column("text")):
                value, _ = shingles(chunk, size)
                slot, many = np.unique((value >> shift).astype(np.int32), return_counts=True)
                counts[slot] = np.minimum(counts[slot] + many, 255)
        yield from _blocks(dict(enumerate(counts.reshape(-1, _BLOCK))))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in T.each(batches):
            for block, data in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
                part = np.frombuffer(zlib.decompress(data), np.uint8).astype(np.int64)
                sums[block] = sums[block] + part if block in sums else part
        total = {block: np.minimum(np.log2(np.maximum(part, 1)) * 8, 255) for block, part in sums.items()}
        yield from _blocks({block: part.astype(np.uint8) for block, part in total.items()})

    schema = "block int, counts binary"
    parts = docs.mapInArrow(count, schema).repartition("block").mapInArrow(add, schema)
    logs = np.zeros(1 << bits, np.uint8)
    for row in parts.toLocalIterator():  # a byte a slot in all
        logs[row.block * _BLOCK : (row.block + 1) * _BLOCK] = np.frombuffer(zlib.decompress(row.counts), np.uint8)
    usual = np.log2(max(1.0, 1.5 * float(np.mean(2.0 ** (logs[:: max(1, len(logs) >> 18)] / 8.0)))))
    return np.clip(logs / 8.0 - usual, 0, 63).astype(np.uint8)


def _blocks(blocks: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    if blocks:
        # Most counts are 0 or 1, so blocks are sent packed.
        counts = [zlib.compress(part.tobytes(), 1) for part in blocks.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(blocks), pa.int32()), pa.array(counts, pa.binary())], names=["block", "counts"]
        )


def _prefix_lengths(n: np.ndarray, least: int) -> np.ndarray:
    """How many of a set's tokens are first tokens. A linked set has at least `least` hundredths of a
    set's tokens, so it shares one of the others' number plus one, and k of that number plus k."""
    common = -(-n * least // 100)
    return np.minimum(n, n - common + 1 + MORE)


def _sets(chunk: T.Chunk, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each row, rows in order and hashes sorted."""
    value, row = shingles(chunk, size)
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    return value[new], row[new]


def _digests(value: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that stand for a set."""
    return tuple(np.add.reduceat(T.mix(value ^ np.uint64(c)), first) for c in (0x51ED270B0F4A, 0xB5297A4D3F11))


def _firsts(row: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.zeros(0, np.int64)


def _sizes(chunk: T.Chunk, value: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row of a chunk the set's size and the two halves of its digest; and where each set starts."""
    first = _firsts(row)
    n = np.zeros(chunk.rows, np.int64)
    digests = np.zeros((2, chunk.rows), np.uint64)
    if len(first):
        n[row[first]] = np.diff(np.r_[first, len(row)])
        digests[:, row[first]] = _digests(value, first)
    return n, digests, first


def _set_sizes(docs: DataFrame, size: int) -> DataFrame:
    """Per row: doc_id, set size n, digests d1 and d2."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.each(batches):
            for chunk in T.chunks(batch.column("text")):
                n, digests, _ = _sizes(chunk, *_sets(chunk, size))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(chunk.first, chunk.rows),
                        pa.array(n),
                        *[pa.array(T.signed(d)) for d in digests],
                    ],
                    names=["doc_id", "n", "d1", "d2"],
                )

    return docs.mapInArrow(run, "doc_id long, n long, d1 long, d2 long")


def _describe(docs: DataFrame, rank: np.ndarray, size: int, least: int) -> DataFrame:
    """Per row that has a set: doc_id, its size, digests, min-hashes and first tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(rank)
    shift = np.uint64(64 - int(np.log2(len(rank))))
    seeds = T.mix(np.arange(1, MIN_HASHES + 1, dtype=np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.each(batches):
            for chunk in T.chunks(batch.column("text")):
                value, row = _sets(chunk, size)
                n, digests, first = _sizes(chunk, value, row)
                rows = row[first]
                if not len(rows):
                    continue
                mins = np.stack([np.minimum.reduceat(T.mix(value ^ seed), first) for seed in seeds], axis=1)
                # Rank above, hash below: sorts from rare to frequent.
                frequent = shared.value[(value >> shift).astype(np.int64)].astype(np.uint64)
                token = (frequent << _RANK_SHIFT) | (value >> np.uint64(6))
                token = token[np.lexsort((token, row))]
                keep = _prefix_lengths(n, least)
                place = np.arange(len(row)) - np.repeat(first, n[rows])
                chosen = token[place < keep[row]]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(chunk.first + rows)),
                        pa.array(n[rows]),
                        *[pa.array(T.signed(d[rows])) for d in digests],
                        _lists(T.signed(mins.ravel()), np.full(len(rows), MIN_HASHES)),
                        _lists(T.signed(chosen), keep[rows]),
                    ],
                    names=["doc_id", "n", "d1", "d2", "mins", "tokens"],
                )

    return docs.mapInArrow(run, "doc_id long, n long, d1 long, d2 long, mins array<long>, tokens array<long>")


def _lists(values: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    offsets = np.r_[0, np.cumsum(lengths)].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _texts_of(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(node, text) for the `wanted` nodes: the text of the document that stands for the node."""
    chosen = nodes.join(wanted, "node").select("node", "rep", "d1", "d2")
    chosen = stored(chosen, "wanted")
    held = IdFilter(chosen.select("rep"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.each(batches):
            ids = batch.column("doc_id")
            some = held.holds(ids.fill_null(0).to_numpy(zero_copy_only=False))
            batch = batch.filter(pa.array(some & ids.is_valid().to_numpy(zero_copy_only=False)))
            for chunk in T.chunks(batch.column("text")):
                _, digests, _ = _sizes(chunk, *_sets(chunk, size))
                part = batch.slice(chunk.first, chunk.rows)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(T.signed(digests[0])), pa.array(T.signed(digests[1]))],
                    names=["doc_id", "text", "d1", "d2"],
                )

    # Rows that share an id and a set stand for the same node: the least text is as good as any. They are where the
    # join has put them already.
    found = docs.mapInArrow(run, "doc_id long, text string, d1 long, d2 long").withColumnRenamed("doc_id", "rep")
    own = chosen.join(found, ["rep", "d1", "d2"]).groupBy("rep", "d1", "d2")
    return own.agg(F.min("node").alias("node"), F.min("text").alias("text")).select("node", "text")


def _compared(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, size: int) -> DataFrame:
    """The pairs (a, b) of nodes with how many tokens their whole sets have in common, and how many in all."""
    wanted = pairs.selectExpr("explode(array(a, b)) as node").distinct()
    texts = stored(_texts_of(docs, nodes, wanted, size), "texts")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.each(batches):
            for at in range(0, batch.num_rows, _PAIRS):
                part = batch.slice(at, _PAIRS)
                sides = [_per_text(part.column(c), size) for c in ("text_a", "text_b")]
                common = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(*sides)]
                every = [len(x) + len(y) - c for x, y, c in zip(*sides, common)]
                columns = [part.column("a"), part.column("b"), pa.array(common, pa.int64()), pa.array(every, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "common", "every"])

    sided = pairs.join(texts.selectExpr("node as a", "text as text_a"), "a").join(
        texts.selectExpr("node as b", "text as text_b"), "b"
    )
    return sided.select("a", "b", "text_a", "text_b").mapInArrow(compare, "a long, b long, common long, every long")


def _per_text(texts: pa.Array, size: int) -> list[np.ndarray]:
    sets: list[np.ndarray] = []
    for chunk in T.chunks(texts):
        value, row = _sets(chunk, size)
        sets += np.split(value, np.searchsorted(row, np.arange(1, chunk.rows)))
    return sets


def _shared_keys(nodes: DataFrame) -> DataFrame:
    """(k, key, many, node, n), stored: the min-hashes of each node that more than one node has."""
    keys = nodes.select("node", "n", F.posexplode("mins").alias("k", "key"))
    many = stored(keys.groupBy("k", "key").agg(F.count("*").alias("many")).where("many > 1"), "many")
    return stored(keys.join(many, ["k", "key"]).select("k", "key", "many", "node", "n"), "keys")


def _star_pairs(shared: DataFrame) -> DataFrame:
    """Pairs of a node and the most typical node with which it shares two min-hashes or more."""
    typical = stored(shared.groupBy("node").agg(F.sum("many").alias("typical")), "typical")
    known = shared.join(typical, "node")
    centers = stored(known.groupBy("k", "key").agg(F.max(F.struct("typical", "node", "n")).alias("center")), "centers")
    pairs = shared.join(centers, ["k", "key"]).where("node <> center.node")
    pairs = pairs.where(f"100 * least(n, center.n) >= {LEAST} * greatest(n, center.n)")
    return pairs.groupBy(F.col("node").alias("a"), F.col("center.node").alias("b")).agg(
        F.count("*").alias("keys")
    ).where("keys > 1").select("a", "b")


def _merged(groups: DataFrame, links: DataFrame) -> DataFrame:
    """(node, grp) after links between nodes (a, b) have joined groups; only the groups are gone through."""
    ends = links.join(groups.selectExpr("node as a", "grp as ga"), "a").join(groups.selectExpr("node as b", "grp as gb"), "b")
    joined = components(ends.selectExpr("ga as a", "gb as b"))
    moved = groups.join(joined.withColumnRenamed("node", "grp"), "grp", "left")
    return stored(moved.selectExpr("node", "coalesce(component, grp) as grp"), "groups")


def _common(a: str, b: str, least: int) -> str:
    """SQL: how many tokens sets of these sizes have in common if they link."""
    return f"ceil({least} * ({a} + {b}) / {100 + least})"


def _dealt(nodes: DataFrame, compared: DataFrame, found: DataFrame, group: int) -> tuple[DataFrame, DataFrame]:
    """(node, n, grp, part), stored: `found` (node, grp) are the components so far, and `part` is the group that the node is
    dealt into, by the typical node that it is most similar to, its size, and a number that bounds the group. A group is
    named after its least node, and a node alone is a group alone. The second table (node, part) has the others only."""
    loose = compared.where(f"100 * common >= {LOOSE} * every")
    best = loose.groupBy("a").agg(F.max(F.struct(F.expr("common / every"), "b")).alias("best"))
    best = stored(best.selectExpr("a as node", "best.b as family"), "families")
    many = stored(best.groupBy("family").agg(F.count("*").alias("many")), "many")
    # A typical node belongs to its own family, unless it is more like another one.
    family = best.join(many, "family").select("node", "family", "many").unionByName(
        many.selectExpr("family as node", "family", "many").join(best.select("node"), "node", "left_anti")
    )
    sized = family.join(nodes.select("node", "n"), "node")
    band = F.floor(F.log("n") / float(np.log(BAND))).cast("int")
    number = F.pmod(F.xxhash64("node"), F.greatest(F.ceil(F.col("many") / group), F.lit(1)))
    keyed = stored(sized.select("node", "family", band.alias("band"), number.alias("number")), "keyed")
    key = ["family", "band", "number"]
    named = stored(keyed.groupBy(*key).agg(F.min("node").alias("part")), "named")
    grouped = stored(keyed.join(named, key).select("node", "part"), "grouped")
    sizes = nodes.select("node", F.col("n").cast("int").alias("n")).join(found, "node").join(grouped, "node", "left")
    return stored(sizes.select("node", "n", "grp", F.coalesce("part", "node").alias("part")), "dealt"), grouped


def _matrix(nodes: DataFrame, grouped: DataFrame) -> DataFrame:
    """(token, part, pos, lo, hi), stored: for each token that more than one group has, and each of these, where it comes
    soonest, and the least and the largest size of the sets that have it.

    Only the nodes that are not groups of their own are shuffled to find their group. No task has two Python workers
    at once: an executor would keep both.
    """
    dealt = IdFilter(grouped.select("node"))
    rows = nodes.select(F.col("node").alias("part"), F.col("n").cast("int").alias("n"), "tokens")
    marked = rows.withColumn("_held", dealt.column(F.col("part")))
    named = grouped.select("node", F.col("part").alias("_part"))
    # With an exchange at any size, so that its Python is not in the task of what comes after.
    moved = marked.where("_held").join(named.hint("merge"), F.col("part") == F.col("node"), "left")
    moved = moved.select(F.coalesce("_part", "part").alias("part"), "n", "tokens")
    placed = marked.where("not _held").select("part", "n", "tokens").unionByName(moved)
    ends = placed.select("part", F.explode("tokens").alias("token")).groupBy("token").agg(
        F.min("part").alias("first"), F.max("part").alias("last")
    )
    meeting = stored(ends.where("first <> last").select("token"), "meeting")
    held = IdFilter(meeting)

    def some(batches: Iterator[pa.RecordBatch], left_out: IdFilter | None = None) -> Iterator[pa.RecordBatch]:
        for batch in T.each(batches):
            if left_out is not None:
                batch = batch.filter(pa.array(~left_out.among(batch.column("part"))))
            tokens = batch.column("tokens")
            many = tokens.value_lengths().to_numpy()
            token = tokens.flatten().to_numpy()
            row = np.repeat(np.arange(batch.num_rows), many)
            pos = np.arange(len(token)) - np.repeat(np.cumsum(many) - many, many)
            keep = held.holds(token)
            at = pa.array(row[keep])
            columns = [pa.array(token[keep]), batch.column("part").take(at), pa.array(pos[keep].astype(np.int32)), batch.column("n").take(at)]
            yield pa.RecordBatch.from_arrays(columns, names=["token", "part", "pos", "n"])

    schema = "token long, part long, pos int, n int"
    alone = rows.mapInArrow(lambda batches: some(batches, dealt), schema)
    rows = alone.unionByName(moved.mapInArrow(some, schema)).join(meeting, "token", "left_semi")
    found = rows.groupBy("token", "part").agg(F.min("pos").alias("pos"), F.min("n").alias("lo"), F.max("n").alias("hi"))
    return stored(found, "matrix")


def _opened(nodes: DataFrame, dealt: DataFrame, grouped: DataFrame, least: int) -> DataFrame:
    """(x, y), stored: pairs of groups, x <= y, that may hold a link between nodes which have not come together.

    Sets of n and m tokens with c in common share MORE + 1 of their first n - c + MORE + 1 and
    m - c + MORE + 1 tokens, or all c. So rows of the matrix meet only where the token comes soon enough in both, for
    some sizes of the groups, and a pair needs that many of them.
    """
    one = dealt.groupBy("part").agg(
        F.min("grp").alias("first"), F.max("grp").alias("last"), F.count("*").alias("members")
    )
    one = stored(one.selectExpr("part", "members", "if(first = last, first, null) as whole"), "wholes")
    matrix = _matrix(nodes, grouped).join(one, "part")
    matrix = stored(matrix.select("token", "part", "pos", "lo", "hi", "whole"), "matrix")
    x, y = matrix.alias("x"), matrix.alias("y")

    def soon(own: str, other: str) -> str:
        # Largest for the largest own set and the smallest other one that can link with it.
        most, fewest = f"{own}.hi", f"greatest({other}.lo, ceil({own}.hi * {least} / 100))"
        rounded = f"if({own}.lo < {own}.hi, 1, 0)"  # a smaller set can be one ahead where halves are rounded up
        return f"{own}.pos < {most} - {_common(most, fewest, least)} + {MORE + 1} + {rounded}"

    fits = f"100 * x.hi >= {least} * y.lo and 100 * y.hi >= {least} * x.lo"
    apart = "(x.whole is null or y.whole is null or x.whole <> y.whole)"
    met = (
        x.join(y, F.expr(f"x.token = y.token and x.part < y.part and {apart} and {fits} and {soon('x', 'y')} and {soon('y', 'x')}"))
        .groupBy(F.col("x.part").alias("x"), F.col("y.part").alias("y"))
        .agg(F.count("*").alias("shared"), F.min(F.expr(_common("x.lo", "y.lo", least))).alias("common"))
    )
    pairs = met.where(f"shared >= least({MORE + 1}, common)").select("x", "y")
    within = one.where("members > 1 and whole is null").selectExpr("part as x", "part as y")
    return stored(pairs.unionByName(within), "opened")


def _common(a: str, b: str, least: int) -> str:
    """SQL: how many tokens sets of these sizes have in common if they link."""
    return f"ceil({least} * ({a} + {b}) / {100 + least})"


class _Connected:
    """Which of the nodes that a task sees have come together."""

    def __init__(self, groups: np.ndarray):
        self.above = np.unique(groups, return_inverse=True)[1].reshape(-1)
        self.above = np.r_[np.arange(self.above.max() + 1 if len(groups) else 0), self.above]
        self.first = len(self.above) - len(groups)

    def root(self, i: int) -> int:
        i = int(self.above[self.first + i])
        while self.above[i] != i:
            self.above[i] = self.above[self.above[i]]
            i = int(self.above[i])
        return i

    def roots(self) -> np.ndarray:
        now = self.above[self.above[self.first :]]
        while (then := self.above[now]).tolist() != now.tolist():
            now = then
        return now

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.above[max(i, j)] = min(i, j)


def linked_groups(
    nodes: list[int], sets: list[np.ndarray], groups: np.ndarray, split: int, least: int
) -> list[tuple[int, int]]:
    """Links that bring together what is linked between the first `split` sets and the others, or, if there are no others,
    among the first: as few as do it. `groups` says what has come together before."""
    sizes = np.array([len(x) for x in sets], np.int64)
    connected, links = _Connected(groups), []
    others = np.arange(split, len(sets)) if split < len(sets) else np.arange(split)
    token = np.concatenate([sets[j] for j in others]) if len(others) else np.zeros(0, np.uint64)
    owner = np.repeat(others, sizes[others])
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    for i in range(split):
        able = (100 * sizes >= least * sizes[i]) & (100 * sizes[i] >= least * sizes)
        able[: len(sets) - len(others)] = False
        if split == len(sets):
            able[: i + 1] = False
        able &= connected.roots() != connected.root(i)
        if not able.any():
            continue
        begin, end = np.searchsorted(token, sets[i], "left"), np.searchsorted(token, sets[i], "right")
        # The union of the group's tokens bounds the overlap with any member.
        fewest = int(sizes[able].min())
        if (end > begin).sum() * (100 + least) < least * (sizes[i] + fewest):
            continue
        many = end - begin
        at = np.repeat(begin - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(many.sum())
        common = np.bincount(owner[at], minlength=len(sets))
        similar = able & (100 * common >= least * (sizes + sizes[i] - common))
        for j in np.flatnonzero(similar).tolist():
            if connected.root(i) != connected.root(j):
                connected.join(i, j)
                links.append((nodes[i], nodes[j]))
    return links


def _linked_between(docs: DataFrame, nodes: DataFrame, dealt: DataFrame, opened: DataFrame, size: int, least: int) -> DataFrame:
    """Links (a, b) that bring together what is linked in the opened pairs of groups, by whole sets."""
    sides = opened.select("x", "y", F.explode(F.array_distinct(F.array("x", "y"))).alias("part"))
    members = stored(sides.join(dealt.select("node", "grp", "part"), "part"), "members")
    texts = stored(_texts_of(docs, nodes, members.select("node").distinct(), size), "texts")

    def compare(table: pa.Table) -> pa.Table:
        T.give_back()
        own = pc.equal(table["part"], table["x"])
        table = pa.concat_tables([table.filter(own), table.filter(pc.invert(own))])
        split = pc.sum(own).as_py()
        found = linked_groups(
            table["node"].to_pylist(), _per_text(table["text"], size), table["grp"].to_numpy(), split, least
        )
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    whole = members.join(texts, "node").select("x", "y", "part", "node", "grp", "text")
    return whole.groupBy("x", "y").applyInArrow(compare, "a long, b long")


def similar_documents(docs: DataFrame, size: int = SHINGLE, least: int = LEAST, group: int = GROUP) -> DataFrame:
    """(doc_id, n_shingles, component_id), a row per row of `docs`.

    `component_id` is the smallest doc_id that links connect the document with, itself included. A
    null or empty text, or one without words, has no shingles and is its own component. A row with
    a null id has a null component and links with nothing. Rows that share an id are rows of one
    document: each has the size of its own text, and each text's links count. Other columns of
    `docs` are ignored.
    """
    T.prepare(docs)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    ranks = token_ranks(docs.select("text"), size)
    known = _describe(docs.where("doc_id is not null"), ranks, size, least)
    nodes = known.groupBy("d1", "d2").agg(
        F.min("doc_id").alias("rep"), F.min("n").alias("n"), F.min("mins").alias("mins"), F.min("tokens").alias("tokens")
    )
    nodes = stored(nodes.select(F.monotonically_increasing_id().alias("node"), "*"), "nodes")
    star = stored(_star_pairs(_shared_keys(nodes)), "star")
    compared = stored(_compared(docs, nodes, star, size), "compared")
    first = components(compared.where(f"100 * common >= {least} * every").select("a", "b")).withColumnRenamed("component", "grp")
    groups = nodes.select("node").join(first, "node", "left").selectExpr("node", "coalesce(grp, node) as grp")
    groups = stored(groups, "groups")
    dealt, grouped = _dealt(nodes, compared, groups, group)
    opened = _opened(nodes, dealt, grouped, least)
    found = _merged(groups, stored(_linked_between(docs, nodes, dealt, opened, size, least), "links"))
    ids = nodes.select("node", "rep", "d1", "d2").join(found, "node")
    least_ids = ids.groupBy("grp").agg(F.min("rep").alias("least_id"))
    by_set = ids.join(least_ids, "grp").select("d1", "d2", "least_id")
    rows = _set_sizes(docs, size).join(by_set, ["d1", "d2"], "left")
    return rows.selectExpr(
        "doc_id",
        "n as n_shingles",
        "case when doc_id is null then null when n = 0 then doc_id else least_id end as component_id",
    )


def keep_one(docs: DataFrame, size: int = SHINGLE, least: int = LEAST) -> DataFrame:
    """One document of each component stays, with all its columns: the one with the smallest id.
    Rows with a null id stay; of rows that share an id, one stays."""
    found = stored(similar_documents(docs, size, least), "similar")
    dropped = found.where("component_id <> doc_id").select("doc_id").distinct()
    repeated = found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    return without(docs, dropped, repeated)

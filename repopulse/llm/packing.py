"""Best-fit packing with a grouping genetic algorithm.

Documents become token ids, long ones are cut into pieces, and pieces are packed into sequences. The
pieces are dealt into blocks of a fixed expected size. Each block is worked on by several islands, rows
of a table of their own: an island keeps a few packings, and a child takes well-filled sequences of one
parent whole, loses the sequences of the other that repeat their pieces, and best-fits the pieces this
displaces. After each epoch an island's best packing goes to the next island of its block.

Well-filled sequences of a block's best packing are final. The others of all blocks, about one a block,
are dealt anew. Where sizes do not go together and most sequences stay under that fill, the emptiest of
each block are. Each level has at most about half of the pieces of the one before, and the last is one block.
"""

from __future__ import annotations

import bisect
import os
import random
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repopulse.llm import textops as T
from repopulse.llm.store import stored

CAPACITY = 4096
END = 1
BLOCK = 1024
ISLANDS = 2
EPOCHS = 2
GENERATIONS = 30
POPULATION = 16
#: A sequence is final from this fill on.
FULL = 0.99
#: The emptiest sequences of a block that is not well filled are dealt anew, up to this part of its pieces.
AGAIN = 0.25
#: Sequences that a block can fill at least, on average.
LEAST_SEQUENCES = 8
#: Units whose ids a process remembers at most.
MEMORY = 400_000
_TEXT_BYTES = 1 << 19
_UNITS = 20_000

Bins = list[list[int]]


#: Kinds of bytes after lowering A-Z: white space, letters, signs, digits, others. Letters are a-z and,
#: as the two bytes of each, the Latin letters U+00C0 to U+00FF. An apostrophe is among the others,
#: since the tokenizer keeps some of them with letters.
_SPACES, _LETTERS, _SIGNS, _DIGITS, _OTHERS = range(5)
_KINDS = np.full(256, _OTHERS, np.uint8)
_KINDS[33:127] = _SIGNS
_KINDS[48:58] = _DIGITS
_KINDS[97:123] = _LETTERS
_KINDS[[9, 10, 11, 12, 13, 32]] = _SPACES
_KINDS[39] = _OTHERS


def _kinds(data: np.ndarray) -> np.ndarray:
    kinds = _KINDS[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    after = data[lead + 1]
    # Not the signs of multiplication and division.
    lead = lead[(after >= 0x80) & (after <= 0xBF) & (after != 0x97) & (after != 0xB7)]
    kinds[lead] = kinds[lead + 1] = _LETTERS
    return kinds


class WordIds:
    """Token ids of texts, by units that the tokenizer works on one by one.

    It never joins characters across white space, nor letters, digits and signs, so a text's ids are
    those of its units one after the other: runs of letters, single digits, runs of signs, and whole words
    where there is anything else in them. A unit is encoded once for all its occurrences that are
    remembered. Each unit but a whole word ends with the one id in it that ends a token's word, so many
    are encoded as one text.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=False)
        self._ends = np.zeros(max(self._tokenizer.get_vocab().values()) + 1, bool)
        self._ends[[number for token, number in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self._hashes = np.zeros(0, np.uint64)  # of known units, sorted
        self._begin = self._length = np.zeros(0, np.int64)
        self._flat = np.zeros(0, np.uint32)

    def _units(self, chunk: T.Chunk, data: np.ndarray) -> tuple[T.Words, np.ndarray]:
        """Units in order, and which of them are whole words."""
        kinds = _kinds(data)
        runs = T.spans(kinds, chunk, skip=_SPACES)
        kind = kinds[runs.start]
        # Special tokens begin so; their strings are words for the tokenizer to find.
        odd = kind == _OTHERS
        special = np.flatnonzero((data[:-1] == 60) & (data[1:] == 124))
        odd[np.searchsorted(runs.start, special, "right") - 1] = True
        words = T.words(chunk)
        in_word = np.searchsorted(words.start, runs.start, "right") - 1
        whole = np.zeros(len(words.start), bool)
        whole[in_word[odd]] = True
        part = ~whole[in_word]
        digits = part & (kind == _DIGITS)
        plain = part & ~digits
        single = np.flatnonzero((kinds == _DIGITS))
        single = single[~whole[np.searchsorted(words.start, single, "right") - 1]]
        start = np.concatenate([runs.start[plain], single, words.start[whole]])
        end = np.concatenate([runs.end[plain], single + 1, words.end[whole]])
        order = np.argsort(start, kind="stable")
        start, end = start[order], end[order]
        is_word = (np.arange(len(order)) >= plain.sum() + len(single))[order]
        return T.Words(start, end, np.searchsorted(chunk.offsets, start, "right") - 1), is_word

    def _learn(self, hashes: np.ndarray, units: list[bytes], whole: np.ndarray) -> None:
        """Encode units that are not known yet; `hashes` are sorted and distinct."""
        if len(self._hashes) + len(hashes) > MEMORY:
            self._forget()
        plain = [u for u, w in zip(units, whole) if not w]
        parts = [b" ".join(plain[k : k + _UNITS]).decode() for k in range(0, len(plain), _UNITS)]
        encode = self._tokenizer.encode_batch_fast
        encoded = [np.array(encode([p], add_special_tokens=False)[0].ids, np.uint32) for p in parts]
        flat = np.concatenate([np.zeros(0, np.uint32), *encoded])
        stop = np.flatnonzero(self._ends[flat]) + 1
        if len(stop) != len(plain) or (len(stop) and stop[-1] != len(flat)):
            raise ValueError("this tokenizer does not end each unit with one id of its own")
        length = np.zeros(len(units), np.int64)
        length[~whole] = np.diff(np.r_[0, stop])
        begin = np.zeros(len(units), np.int64)
        begin[~whole] = np.r_[0, stop[:-1]] if len(stop) else 0
        words = [u.decode() for u, w in zip(units, whole) if w]
        ids = [np.array(e.ids, np.uint32) for e in encode(words, add_special_tokens=False)]
        length[whole] = [len(x) for x in ids]
        begin[whole] = len(flat) + np.cumsum(length[whole]) - length[whole]
        flat = np.concatenate([flat, *ids])
        place = np.searchsorted(self._hashes, hashes)
        self._hashes = np.insert(self._hashes, place, hashes)
        self._begin = np.insert(self._begin, place, begin + len(self._flat))
        self._length = np.insert(self._length, place, length)
        self._flat = np.concatenate([self._flat, flat])

    def rows(self, chunk: T.Chunk) -> list[np.ndarray]:
        """The ids of each text of a chunk."""
        data = T.lower_ascii(chunk.data)
        found, is_word = self._units(chunk, data)
        if not len(found.start):
            return [np.zeros(0, np.uint32)] * chunk.rows
        hashes = T.span_hashes(data, found.start, found.end)
        if is_word.any():  # a whole word's case may make it a special token
            hashes = np.where(is_word, T.span_hashes(chunk.data, found.start, found.end), hashes)
        value, first, which = T.distinct(hashes)

        def places() -> tuple[np.ndarray, np.ndarray]:
            place = np.minimum(np.searchsorted(self._hashes, value), max(0, len(self._hashes) - 1))
            known = self._hashes[place] == value if len(self._hashes) else np.zeros(len(value), bool)
            return place, known

        place, known = places()
        if not known.all():
            if len(self._hashes) + int((~known).sum()) > MEMORY:
                self._forget()
                place, known = places()
            new = first[~known]
            lower, own = data.tobytes(), chunk.data.tobytes()
            ends = zip(found.start[new].tolist(), found.end[new].tolist(), is_word[new].tolist())
            units = [(own if w else lower)[a:b] for a, b, w in ends]
            self._learn(value[~known], units, is_word[new])
            place, known = places()
        length, begin = self._length[place][which], self._begin[place][which]
        total = np.cumsum(length)
        # Position in the remembered ids of every id: the unit's first one, and onwards.
        at = np.arange(total[-1]) + np.repeat(begin - (total - length), length)
        cut = np.r_[0, total][np.searchsorted(found.row, np.arange(1, chunk.rows))]
        return np.split(self._flat[at], cut)


_coders: dict[str, WordIds] = {}


def coder(path: str) -> WordIds:
    """The process's own, so that a worker keeps what it has learned from one task to the next."""
    if path not in _coders:
        _coders[path] = WordIds(path)
    return _coders[path]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every document's ids and an end id, in pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = coder(tokenizer)
        for batch in T.each(batches):
            ids = batch.column("doc_id")
            for chunk in T.chunks(batch.column("text"), _TEXT_BYTES):
                row, piece, start, length, crc = [], [], [], [], []
                for k, own in enumerate(ids_of.rows(chunk)):
                    own = np.append(own, np.uint32(end)).astype("<u4")
                    for n, at in enumerate(range(0, len(own), capacity)):
                        part = own[at : at + capacity]
                        row.append(chunk.first + k)
                        piece.append(n)
                        start.append(at)
                        length.append(len(part))
                        crc.append(zlib.crc32(part.tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(row, pa.int64())),
                        pa.array(piece, pa.int32()),
                        *[pa.array(x, pa.int64()) for x in (start, length, crc)],
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return docs.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(bins: Bins, free: list[int], items: list[int], sizes: list[int], capacity: int) -> None:
    """Put each item, from the largest, into the fullest bin that takes it, or into a new one."""
    open_bins = sorted((space, b) for b, space in enumerate(free))
    for item in sorted(items, key=lambda i: -sizes[i]):
        size = sizes[item]
        at = bisect.bisect_left(open_bins, (size, -1))
        if at < len(open_bins):
            space, b = open_bins.pop(at)
        else:
            space, b = capacity, len(bins)
            bins.append([])
            free.append(capacity)
        bins[b].append(item)
        free[b] = space - size
        bisect.insort(open_bins, (space - size, b))


def fitness(bins: Bins, sizes: list[int], capacity: int) -> float:
    """Mean square of the fill: few full bins and an empty one beat many half full ones."""
    return sum((sum(sizes[i] for i in b) / capacity) ** 2 for b in bins) / max(1, len(bins))


def cross(first: Bins, second: Bins, sizes: list[int], capacity: int, rng: random.Random) -> Bins:
    """A child: well-filled bins of `second` whole, the bins of `first` that share no piece with them,
    and the displaced pieces by best fit."""
    ranked = sorted(range(len(second)), key=lambda b: -sum(sizes[i] for i in second[b]))
    good = ranked[: max(1, len(ranked) // 2)]
    taken = [second[b] for b in rng.sample(good, max(1, len(good) // 2))]
    inside = {i for b in taken for i in b}
    bins, displaced = [list(b) for b in taken], []
    for b in first:
        if inside.isdisjoint(b):
            bins.append(list(b))
        else:
            displaced += [i for i in b if i not in inside]
    # The emptiest bins give their pieces up too.
    bins.sort(key=lambda b: -sum(sizes[i] for i in b))
    for _ in range(min(len(bins) - 1, 1 + len(bins) // 50)):
        displaced += bins.pop()
    free = [capacity - sum(sizes[i] for i in b) for b in bins]
    best_fit(bins, free, displaced, sizes, capacity)
    return bins


def start_packings(sizes: list[int], capacity: int, many: int, rng: random.Random) -> list[Bins]:
    """Packings by best fit: the first with all pieces by size, the others after some at random."""
    packings = []
    for k in range(many):
        bins: Bins = []
        free: list[int] = []
        items = list(range(len(sizes)))
        if k:
            rng.shuffle(items)
            cut = len(items) // 4
            for part in (items[:cut], items[cut:]):
                best_fit(bins, free, part, sizes, capacity)
        else:
            best_fit(bins, free, items, sizes, capacity)
        packings.append(bins)
    return packings


def evolve(packings: list[Bins], sizes: list[int], capacity: int, generations: int, rng: random.Random) -> list[Bins]:
    """The packings after some generations, best first. It stops early at the least possible number."""
    least = -(-sum(sizes) // capacity)
    ranked = sorted(((fitness(p, sizes, capacity), n, p) for n, p in enumerate(packings)), reverse=True)
    for g in range(generations):
        if len(ranked[0][2]) <= least:
            break
        children = []
        for k in range(len(packings) // 2):
            a, b = rng.sample(ranked, 2) if len(ranked) > 1 else (ranked[0], ranked[0])
            child = cross(max(a, b)[2], min(a, b)[2], sizes, capacity, rng)
            children.append((fitness(child, sizes, capacity), -1 - g * len(packings) - k, child))
        ranked = sorted(ranked + children, reverse=True)[: len(packings)]
    return [p for _, _, p in ranked]


def _encode(packing: Bins, n: int) -> bytes:
    own = np.zeros(n, np.int32)
    for b, items in enumerate(packing):
        own[items] = b
    return own.tobytes()


def _decode(own: bytes) -> Bins:
    bins: Bins = []
    for item, b in enumerate(np.frombuffer(own, np.int32).tolist()):
        while b >= len(bins):
            bins.append([])
        bins[b].append(item)
    return [b for b in bins if b]


_ISLAND = "block long, island int, items array<long>, sizes array<int>, packings array<binary>"


def _epoch(islands: DataFrame, capacity: int, epoch: int) -> DataFrame:
    """One epoch of every island; without packings yet, an island starts with its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.each(batches):
            out = []
            for row in batch.select(["block", "island", "sizes", "packings"]).to_pylist():
                rng = random.Random(f"{row['block']} {row['island']} {epoch}")
                sizes = row["sizes"]
                packings = [_decode(p) for p in row["packings"]]
                if not packings:
                    packings = start_packings(sizes, capacity, POPULATION, rng)
                packings = evolve(packings, sizes, capacity, GENERATIONS, rng)[:POPULATION]
                out.append([_encode(p, len(sizes)) for p in packings])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("block", "island", "items", "sizes")], pa.array(out, pa.list_(pa.binary()))],
                names=["block", "island", "items", "sizes", "packings"],
            )

    return stored(islands.mapInArrow(run, _ISLAND), f"epoch{epoch}")


def _migrated(islands: DataFrame, count: int) -> DataFrame:
    """Every island's best packing joins those of the next island of its block."""
    elite = islands.select("block", F.expr(f"pmod(island + 1, {count})").cast("int").alias("island"), F.expr("packings[0]").alias("guest"))
    return islands.join(elite, ["block", "island"]).select(
        "block", "island", "items", "sizes", F.expr("array_append(packings, guest)").alias("packings")
    )


def dealt_anew(bins: Bins, sizes: list[int], capacity: int) -> list[bool]:
    """For each sequence of a block, whether its pieces are dealt anew: those under the fill that is
    final if they hold half of the pieces at most, and otherwise the emptiest of them, the first always."""
    fill = [sum(sizes[i] for i in b) for b in bins]
    under = sorted((b for b in range(len(bins)) if fill[b] < FULL * capacity), key=lambda b: fill[b])
    most = len(sizes) / 2
    if sum(len(bins[b]) for b in under) > most:
        most = AGAIN * len(sizes)
    again, many = [False] * len(bins), 0
    for n, b in enumerate(under):
        many += len(bins[b])
        if n and many > most:
            break
        again[b] = True
    return again


def _placed(islands: DataFrame, level: int, capacity: int) -> DataFrame:
    """(item, size, sequence_id, offset, again) by the best packing of each block."""
    best_first = F.struct(F.expr("size(array_distinct(packings))").alias("n"), "island")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.each(batches):
            columns: list[list[int]] = [[], [], [], [], []]
            for row in batch.to_pylist():
                sizes = row["sizes"]
                choices = [_decode(p) for p in row["best"]]
                bins = min(choices, key=lambda p: (len(p), -fitness(p, sizes, capacity)))
                again = dealt_anew(bins, sizes, capacity)
                for b, own in enumerate(bins):
                    at = 0
                    for i in own:
                        for column, value in zip(columns, (row["items"][i], sizes[i], (level << 56) | (row["block"] << 16) | b, at, again[b])):
                            column.append(value)
                        at += sizes[i]
            kinds = [*[pa.int64()] * 4, pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(columns, kinds)],
                names=["item", "size", "sequence_id", "offset", "again"],
            )

    blocks = islands.groupBy("block").agg(
        F.max_by("items", best_first).alias("items"),
        F.max_by("sizes", best_first).alias("sizes"),
        F.collect_list(F.expr("packings[0]")).alias("best"),
    )
    return blocks.mapInArrow(run, "item long, size long, sequence_id long, offset long, again boolean")


def pack_items(items: DataFrame, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """(item, sequence_id, offset) for items (item, size) with distinct numbers and sizes from 1 to
    `capacity`. An item of the whole capacity is a sequence of its own, with a negative number."""
    whole = items.where(F.col("size") >= capacity).selectExpr("item", "-1 - item as sequence_id", "0L as offset")
    done = [whole]
    rest = items.where(F.col("size") < capacity).select("item", F.col("size").cast("long").alias("size"))
    many, total = rest.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    level = 1
    while many:
        # Blocks of small pieces have more of them, so that there are sequences to fill.
        blocks = max(1, min(-(-many // block), total // (LEAST_SEQUENCES * capacity)))
        dealt = rest.withColumn("block", F.pmod(F.xxhash64("item", F.lit(level)), F.lit(blocks)))
        # A block holds about `block` items, or a few sequences of small ones, whatever the number of all.
        grouped = dealt.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("item", "size"))).alias("own"))
        islands = grouped.select(
            "block",
            F.explode(F.array(*[F.lit(k) for k in range(ISLANDS)])).alias("island"),
            F.expr("own.item").alias("items"),
            F.expr("transform(own, x -> cast(x.size as int))").alias("sizes"),
            F.expr("cast(array() as array<binary>)").alias("packings"),
        )
        islands = islands.repartition("block", "island")
        for epoch in range(EPOCHS):
            islands = _epoch(_migrated(islands, ISLANDS) if epoch else islands, capacity, epoch)
        placed = stored(_placed(islands, level, capacity), f"level{level}")
        rest, before = placed.where("again").select("item", "size"), (many, total)
        many, total = (0, 0) if blocks == 1 else rest.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
        if (many, total) == before:
            many = 0
        done.append((placed.where("not again") if many else placed).select("item", "sequence_id", "offset"))
        level += 1
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is the end id alone. Rows that share an id, or have none, are documents of
    their own. Other columns are ignored; no documents give no rows.
    """
    T.prepare(docs)
    cut = pieces(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), tokenizer, capacity, end)
    cut = stored(cut.select(F.monotonically_increasing_id().alias("item"), "*"), "pieces")
    placed = pack_items(cut.select("item", F.col("length").alias("size")), capacity)
    return cut.join(placed, "item").drop("item")

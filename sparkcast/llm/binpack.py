"""Best-fit packing of whole documents by a grouping genetic algorithm.

Pieces of equal length are interchangeable, so the problem is the table of
lengths and their counts (at most ``capacity`` rows, whatever the corpus), and
a packing is a list of *genes*: a bin pattern (the lengths in one sequence)
and how many sequences have it. An individual's genes use every piece once.

* Crossover injects well-filled bins of the second parent into the first. Bins
  of the first parent that now hold a piece twice are removed, and the
  displaced pieces of their other lengths go, longest first, to the bins where
  they fit best.
* Mutation dissolves the emptiest bins and some others and refills in the
  same way.
* Islands are groups of a Spark job: each evolves its own population from its
  own seed. After an epoch its best individuals move to the next island. The
  populations are written to the shared folder between epochs.
* The search ends early when a packing reaches the lower bound, which no
  packing can beat.

Documents never meet in one place. Each task numbers the pieces of a length as
it tokenizes them; with offsets from the (task, length) counts that gives every
piece a number within its length, and the winning packing, as a bounded table
of slots, tells where that number goes.
"""

from __future__ import annotations

import bisect
import gc
import random
from collections import Counter
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkcast.llm.packing import END_ID, WordTokenizer
from sparkcast.llm.queries import register
from sparkcast.llm.shared import numbered, read_table, saved
from sparkcast.llm.words import blocks

CAPACITY = 4096
#: Bytes of text tokenized at once.
BLOCK = 2 << 20


@dataclass(frozen=True)
class Search:
    """Size of the genetic search; it does not depend on the corpus."""

    islands: int = 8
    population: int = 8
    generations: int = 12
    epochs: int = 3
    elites: int = 2
    #: Fill (share of the capacity) from which a bin counts as well filled.
    well_filled: float = 0.995
    seed: int = 11


# A pattern is a tuple of (length, copies), longest first; an individual is a
# Counter {pattern: bins}.


def _room(pattern, capacity: int) -> int:
    return capacity - sum(n * k for n, k in pattern)


class _Rooms(dict):
    """Room left by each pattern met so far, and the square of each room's fill."""

    #: Patterns remembered at once.
    most = 1 << 18

    def __init__(self, capacity: int):
        super().__init__()
        self.capacity = capacity
        self.squares = [(1 - room / capacity) ** 2 for room in range(capacity + 1)]

    def __missing__(self, pattern):
        if len(self) >= self.most:
            self.clear()
        room = self[pattern] = _room(pattern, self.capacity)
        return room


_rooms: dict[int, _Rooms] = {}


def _rooms_of(capacity: int) -> _Rooms:
    if capacity not in _rooms:
        _rooms.clear()
        _rooms[capacity] = _Rooms(capacity)
    return _rooms[capacity]


# Hashing a pattern costs more than the work on it, so the search hands on lists
# of genes (pattern, bins, room) and looks a pattern up as seldom as it can.


def _genes(bins: Counter, capacity: int) -> list:
    room = _rooms_of(capacity)
    return [(p, m, room[p]) for p, m in bins.items()]


def _individual(genes) -> Counter:
    found = Counter()
    for p, m, _ in genes:
        found[p] = m
    return found


def _by_room(genes) -> dict[int, list]:
    """Positions of the genes that leave each room."""
    groups = {}
    for i, (_, _, room) in enumerate(genes):
        if room in groups:
            groups[room].append(i)
        else:
            groups[room] = [i]
    return groups


def _ordered(genes, capacity: int, well: float) -> tuple[list, list]:
    """The genes by room, then pattern; the well-filled ones by pattern."""
    groups, order, end = _by_room(genes), [], 0
    for room in sorted(groups):
        order += sorted([genes[i] for i in groups[room]])
        if room <= (1 - well) * capacity:
            end = len(order)
    return order, sorted(order[:end])


def _with(pattern, length: int, copies: int):
    """The pattern with more pieces of a length."""
    if not pattern or length < pattern[-1][0]:
        return (*pattern, (length, copies))
    held = Counter(dict(pattern))
    held[length] += copies
    return tuple(sorted(held.items(), reverse=True))


def best_fit(bins: Counter, pieces, capacity: int) -> Counter:
    """Put the (length, count) ``pieces``, in the given order, where they fit best.

    The same bins as placing piece by piece, each in the fullest bin with room
    for it: a bin that takes one takes as many of that length as it can hold.
    """
    return _individual(_place(_genes(bins, capacity), pieces, capacity))


def _place(genes, pieces, capacity: int) -> list:
    """``best_fit`` into genes of different patterns."""
    done, open_ = {}, {}
    for pattern, m, room in genes:
        if not room:
            done[pattern] = m
        elif room in open_:
            open_[room][pattern] = m
        else:
            open_[room] = {pattern: m}
    rooms = sorted(open_)

    def put(pattern, m, room):
        if not m:
            return
        if not room:
            done[pattern] = done.get(pattern, 0) + m
            return
        held = open_.get(room)
        if held is None:
            held = open_[room] = {}
            bisect.insort(rooms, room)
        held[pattern] = held.get(pattern, 0) + m

    for length, count in pieces:
        while count:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                pattern, m = open_[room].popitem()
                if not open_[room]:
                    del open_[room], rooms[at]
            else:
                room, pattern, m = capacity, (), -(-count // (capacity // length))
            each = room // length
            used = min(m, count // each)
            if used:
                put(_with(pattern, length, each), used, room - each * length)
                count -= used * each
                m -= used
            if m and 0 < count < each:
                put(_with(pattern, length, count), 1, room - count * length)
                count, m = 0, m - 1
            if pattern:
                put(pattern, m, room)
    found = [(pattern, m, 0) for pattern, m in done.items()]
    for room, held in open_.items():
        found += [(pattern, m, room) for pattern, m in held.items()]
    return found


def lower_bound(counts: Counter, capacity: int) -> int:
    """Sequences that any packing needs: by volume, and by pieces over half.

    For each t up to half the capacity, a piece longer than ``capacity - t``
    stands alone among pieces of t or more, and the pieces from t to that
    length share at best the room that the ones over half leave.
    """
    size = np.zeros(capacity + 1, dtype=object)
    for n, k in counts.items():
        size[n] = k
    n = np.cumsum(size)
    words = np.cumsum(size * np.arange(capacity + 1))
    half = capacity // 2
    best = -(-int(words[capacity]) // capacity)
    for t in range(1, half + 1):
        alone = int(n[capacity] - n[capacity - t])
        large = int(n[capacity - t] - n[half])
        rest = int(words[half] - words[t - 1])
        room = large * capacity - int(words[capacity - t] - words[half])
        best = max(best, alone + large + max(0, -(-(rest - room) // capacity)))
    return best


def fitness(bins: Counter, capacity: int) -> tuple[int, float]:
    """Smaller is better: sequences first, then how evenly they are filled."""
    return _score(_genes(bins, capacity), capacity)


def _score(genes, capacity: int) -> tuple[int, float]:
    square = _rooms_of(capacity).squares
    return sum([m for _, m, _ in genes]), -sum([m * square[room] for _, m, room in genes])


def crossover(a: Counter, b: Counter, counts: Counter, rng, capacity: int, well: float) -> Counter:
    """``a`` with well-filled bins of ``b``; duplicates removed, displaced pieces refitted."""
    a, b = _genes(a, capacity), _genes(b, capacity)
    return _individual(_crossover(a, b, counts, rng, capacity, well, {}))


def _crossover(a, b, counts, rng, capacity, well, orders) -> list:
    # orders remembers the parents' genes in order, by the parent's id
    for parent in (a, b):
        if id(parent) not in orders:
            orders[id(parent)] = _ordered(parent, capacity, well)
    good = orders[id(b)][1]
    chosen = rng.sample(good, rng.randint(1, len(good))) if good else []
    child, left, at = list(chosen), dict(counts), {}
    for i, (p, m, _) in enumerate(chosen):
        at[p] = i
        for n, k in p:
            left[n] -= k * m
    # the first parent's fullest bins stay as long as their pieces are free
    for gene in orders[id(a)][0]:
        p, m, room = gene
        for n, k in p:
            free = left[n] // k
            if free < m:
                m = free
        if m > 0:
            i = at.get(p)
            if i is None:
                child.append((p, m, room))
            else:
                child[i] = (p, child[i][1] + m, room)
            for n, k in p:
                left[n] -= k * m
    return _refill(child, left, rng, capacity)


def mutate(a: Counter, counts: Counter, rng, capacity: int) -> Counter:
    """Dissolve the emptiest bins and a few others; refit their pieces."""
    return _individual(_mutate(_genes(a, capacity), counts, rng, capacity))


def _mutate(genes, counts, rng, capacity) -> list:
    child, groups = list(genes), _by_room(genes)
    # ranks by room, the emptiest first, then by pattern
    ranks = set(range(min(len(child), rng.randint(1, 4))))
    ranks.update(rng.sample(range(len(child)), min(len(child), rng.randint(1, 4))))
    gone, before = [], 0
    for room in sorted(groups, reverse=True):
        here = [x - before for x in ranks if before <= x < before + len(groups[room])]
        if here:
            ranked = sorted([(child[i][0], i) for i in groups[room]])
            gone += [ranked[x][1] for x in here]
        before += len(groups[room])
    left = dict.fromkeys(counts, 0)
    for i in sorted(gone):
        p, m, room = child[i]
        out = min(m, rng.randint(1, 3))
        child[i] = (p, m - out, room)
        for n, k in p:
            left[n] += k * out
    return _refill([gene for gene in child if gene[1]], left, rng, capacity)


def _refill(child, free, rng, capacity):
    left = [(n, free[n]) for n in sorted(free, reverse=True) if free[n] > 0]
    if rng.random() < 0.5:  # now and then not quite longest first
        left.sort(key=lambda x: -x[0] * rng.uniform(0.8, 1.25))
    return _place(child, left, capacity)


def max_genes(counts: Counter) -> int:
    """Genes an individual may have: a best-fit packing has at most three a length."""
    return 3 * len(counts) + 1


def first_population(counts: Counter, rng, size: int, capacity: int) -> list[Counter]:
    """One packing longest first, the others in orders between that and random."""
    found = []
    for i in range(size):
        order = sorted(counts.items(), key=lambda x: -x[0] * rng.uniform(1 - i / size, 1))
        found.append(best_fit(Counter(), order, capacity))
    return found


def evolve(population, counts, rng, capacity: int, search: Search, bound: int) -> list[Counter]:
    """One epoch of one island: tournaments, crossover, mutation, worst replaced."""
    limit = max_genes(counts)
    genes = [_genes(p, capacity) for p in population]
    ranked = sorted((_score(p, capacity), i, p) for i, p in enumerate(genes))
    number, orders = len(ranked), {}
    for _ in range(search.generations):
        if ranked[0][0][0] <= bound:
            break
        for _ in range(search.population):
            a, b = (min(rng.sample(ranked, min(3, len(ranked))))[2] for _ in range(2))
            child = _crossover(a, b, counts, rng, capacity, search.well_filled, orders)
            if rng.random() < 0.5:
                child = _mutate(child, counts, rng, capacity)
            if len(child) <= limit:
                number += 1
                ranked.append((_score(child, capacity), number, child))
        ranked = sorted(ranked, key=lambda x: x[:2])[: search.population]
        kept = {id(p) for _, _, p in ranked}
        orders = {i: order for i, order in orders.items() if i in kept}
    return [_individual(p) for _, _, p in ranked]


# distributed part


GENES = (
    "island int, rank int, gene int, lengths array<int>, copies array<long>, bins long, "
    "sequences long, squares double"
)


def _to_rows(island: int, population, capacity: int):
    for rank, individual in enumerate(population):
        n, squares = fitness(individual, capacity)
        for gene, (p, m) in enumerate(sorted(individual.items(), reverse=True)):
            yield island, rank, gene, [x for x, _ in p], [k for _, k in p], m, n, squares


def _from_rows(rows: pd.DataFrame) -> list[Counter]:
    found = []
    for _, genes in rows.sort_values(["island", "rank", "gene"]).groupby(["island", "rank"], sort=True):
        found.append(
            Counter(
                {
                    tuple(zip(n.tolist(), k.tolist())): m
                    for n, k, m in zip(genes["lengths"], genes["copies"], genes["bins"].tolist())
                }
            )
        )
    return found


@contextmanager
def _no_cycles():
    """Without the collector of cycles: a search makes millions of small tuples and no cycle."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def search_packing(
    spark, counts: Counter, capacity: int = CAPACITY, search: Search = Search()
) -> DataFrame:
    """The best packing found, a row a gene: ``lengths``, ``copies``, ``bins``.

    ``counts``: pieces by length, at most ``capacity`` entries. Islands evolve
    in parallel; between epochs their populations are written, and each
    island's best move to the next. Equal seeds give equal packings.
    """
    bound = lower_bound(counts, capacity)
    columns = [c.split()[0] for c in GENES.split(", ")]
    if not counts:
        return spark.createDataFrame([], GENES).select("lengths", "copies", "bins")

    def epoch(number):
        def run(rows: pd.DataFrame) -> pd.DataFrame:
            island = int(rows["home"].iloc[0])
            rng = random.Random(f"{search.seed}/{number}/{island}")
            with _no_cycles():
                if number:
                    population = _from_rows(rows)
                else:
                    population = first_population(counts, rng, search.population, capacity)
                population = evolve(population, counts, rng, capacity, search, bound)
                return pd.DataFrame(list(_to_rows(island, population, capacity)), columns=columns)

        return run

    population = spark.range(search.islands).select(F.col("id").cast("int").alias("home"))
    for number in range(search.epochs):
        dealt = population.repartition(search.islands, "home")
        population = saved(dealt.groupBy("home").applyInPandas(epoch(number), GENES), "islands")
        best = population.orderBy("sequences", "squares", "island", "rank").first()
        if best["sequences"] <= bound or number + 1 == search.epochs:
            break
        moved = F.explode(
            F.when(
                F.col("rank") < search.elites,
                F.array(F.col("island"), (F.col("island") + 1) % search.islands),
            ).otherwise(F.array("island"))
        )
        population = population.select("*", moved.alias("home"))
    return population.where(
        (F.col("island") == best["island"]) & (F.col("rank") == best["rank"])
    ).select("lengths", "copies", "bins")


class Slots:
    """Where the k-th piece of a length goes, from the winning genes.

    A gene's sequences take consecutive numbers. Entry: length, first piece
    number, first sequence, copies a sequence holds, offset of the first copy.
    """

    def __init__(self, genes, capacity: int):
        entries, taken, base = [], Counter(), 0
        for lengths, copies, bins in genes:
            offset = 0
            for n, k in zip(lengths, copies):
                entries.append((n, taken[n], base, k, offset))
                taken[n] += k * bins
                offset += n * k
            base += bins
        entries.sort()
        self.length, self.first, self.base, self.copies, self.offset = np.array(
            entries, dtype=np.int64
        ).reshape(-1, 5).T
        self.begin = np.searchsorted(self.length, np.arange(capacity + 2))

    def __call__(self, length: np.ndarray, number: np.ndarray):
        """(sequence, offset) of pieces given by length and number within it."""
        # entries are sorted by length and first number, so both fit one key
        key = (self.length << 48) + self.first
        at = np.searchsorted(key, (length << 48) + number, side="right") - 1
        bin_, copy = np.divmod(number - self.first[at], self.copies[at])
        return self.base[at] + bin_, self.offset[at] + copy * length


def tokenized(
    docs: DataFrame, tokenizer_file: str, id_col: str, text_col: str, capacity: int, end_id: int
) -> DataFrame:
    """Pieces of all documents; ``task`` and ``turn`` number those of a length."""
    schema = T.StructType(
        [
            T.StructField("id", docs.schema[id_col].dataType),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("task", T.IntegerType()),
            T.StructField("turn", T.LongType()),
        ]
    )

    def run(batches):
        tokenizer = WordTokenizer.load(tokenizer_file)
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            for i, j in blocks(batch.column(1), BLOCK):
                rows = batch.slice(i, j - i)
                ids, first = tokenizer.encode(rows.column(1), end_id)
                tokens = np.diff(first)
                n = -(-tokens // capacity)
                doc = np.repeat(np.arange(len(n)), n)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * capacity
                length = np.minimum(tokens[doc] - start, capacity)
                order = np.argsort(length, kind="stable")
                ranked = length[order]
                head = np.searchsorted(ranked, ranked)
                turn = np.empty(len(doc), dtype=np.int64)
                turn[order] = np.arange(len(doc)) - head + seen[ranked]
                seen += np.bincount(length, minlength=capacity + 1)
                ends = np.concatenate(([0], np.cumsum(length))) * 4
                content = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(),
                    len(doc),
                    [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(ids.astype("<u4"))],
                )
                yield pa.record_batch(
                    [
                        rows.column(0).take(pa.array(doc)),
                        pa.array(piece, pa.int32()),
                        pa.array(start),
                        pa.array(length),
                        content.cast(pa.binary()),
                        pa.array(np.full(len(doc), task), pa.int32()),
                        pa.array(turn),
                    ],
                    names=schema.names,
                )

    renamed, names = numbered(docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")))
    return renamed.select(
        F.col(names[id_col]).alias("id"), F.col(names[text_col]).alias("text")
    ).mapInArrow(run, schema)


def pack(
    docs: DataFrame,
    tokenizer_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    search: Search = Search(),
) -> DataFrame:
    """Pieces of all documents with their place in a sequence.

    Returns ``id_col``, ``piece`` (from 0), ``start`` (the document's ids
    before it), ``length``, ``ids`` (little-endian unsigned 32-bit ids),
    ``ids_crc32``, ``sequence_id`` and ``offset`` (gapless from 0). Only
    documents of more than ``capacity`` ids are cut, the last piece may be
    shorter.

    NULL or empty text is the closing id alone. Repeated rows and rows equal in
    id are packed each. An empty table gives an empty table. Other columns are
    not read. The pieces are written once, so that a task that runs again finds
    the same numbers; columns that the caller drops (``ids``) are not read back
    or shuffled.
    """
    spark = docs.sparkSession
    pieces = tokenized(docs, tokenizer_file, id_col, text_col, capacity, end_id)
    pieces = saved(pieces.withColumn("ids_crc32", F.crc32("ids")), "pieces")
    held = saved(
        pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts"
    )
    counts = Counter(
        {int(r.length): int(r.n) for r in held.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    )
    genes = [tuple(r) for r in search_packing(spark, counts, capacity, search).collect()]
    slots = spark.sparkContext.broadcast(Slots(sorted(genes), capacity))

    # a length has a row a task here, however many pieces it has
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    ahead = held.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))

    @F.pandas_udf("struct<sequence_id: long, offset: long>")
    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        sequence, offset = slots.value(length.to_numpy(), number.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    return (
        pieces.join(ahead, ["task", "length"])
        .withColumn("_at", place("length", F.col("turn") + F.col("ahead")))
        .select(
            F.col("id").alias(id_col),
            "piece",
            "start",
            "length",
            "ids",
            "ids_crc32",
            "_at.sequence_id",
            "_at.offset",
        )
    )


@register("op11_genetic_packing")
def op11_genetic_packing(spark, sf_dir):
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents")
    return pack(docs, public_tokenizers.path("word_bpe_49k.json")).drop("ids")

"""What the genetic search of op11 costs."""

import random
from collections import Counter

from sparkcast.llm import binpack


def test_the_room_of_a_pattern_is_summed_once(monkeypatch):
    summed, room = [], binpack._room
    monkeypatch.setattr(binpack, "_room", lambda p, capacity: summed.append(p) or room(p, capacity))
    getattr(binpack, "_rooms", {}).clear()
    rng = random.Random(3)
    counts = Counter(rng.randint(20, 60) for _ in range(300))
    population = binpack.first_population(counts, rng, 6, 100)
    search = binpack.Search(population=6, generations=5)
    found = binpack.evolve(population, counts, rng, 100, search, 0)
    assert len(found) == 6 and len(summed) == len(set(summed))
    for bins in found:
        held = Counter()
        for pattern, m in bins.items():
            assert room(pattern, 100) >= 0
            for n, k in pattern:
                held[n] += k * m
        assert held == counts


def test_the_search_looks_a_pattern_up_once_a_start(monkeypatch):
    looked_up = []

    class Rooms(binpack._Rooms):
        def __getitem__(self, pattern):
            looked_up.append(pattern)
            return super().__getitem__(pattern)

    rooms = Rooms(100)
    monkeypatch.setattr(binpack, "_rooms_of", lambda capacity: rooms)
    rng = random.Random(3)
    counts = Counter(rng.randint(20, 60) for _ in range(300))
    population = binpack.first_population(counts, rng, 6, 100)
    looked_up.clear()
    found = binpack.evolve(population, counts, rng, 100, binpack.Search(population=6, generations=5), 0)
    assert len(looked_up) <= sum(map(len, population))
    scores = [binpack.fitness(p, 100) for p in found]
    assert scores == sorted(scores) and scores[0] <= min(binpack.fitness(p, 100) for p in population)


def test_a_search_leaves_the_collector_as_it_was():
    import gc

    with binpack._no_cycles():
        assert not gc.isenabled()
    assert gc.isenabled()

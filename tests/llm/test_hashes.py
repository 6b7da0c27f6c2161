"""Hashes of words, lines and windows: patterns that made sums collide, long texts."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest

from sparkcast.llm import backoff, linedup, quality
from sparkcast.llm.words import Hasher, gram_hashes, split_words, text_bytes, word_hashes


def morse(n):
    """The Thue-Morse sequence's first n letters, and the same with letters swapped."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("n", [64, 512, 1024, 4096])
def test_pattern_words_differ(n):
    one, two = morse(n)
    h = word_hashes(split_words(*text_bytes(pa.array([f"{one} {two} {one}"]))))
    assert h[0] != h[1] and h[0] == h[2]


def test_pattern_windows_differ():
    one, two = (np.array([ord(c) for c in x], dtype=np.uint64) for x in morse(4096))
    for n in (8, 26, 50, 1024):
        g = gram_hashes(np.concatenate((one[:n], two[:n], one[:n])), n)
        assert len(g) == 2 * n + 1
        assert g[0] != g[n] and g[0] == g[2 * n]


def test_ranges_hash_by_bytes_alone():
    rng = random.Random(3)
    texts = ["".join(rng.choice("abé中") for _ in range(rng.randrange(1, 60))) for _ in range(4000)]
    texts += [t for t in texts[:500]] + ["x" * k for k in range(1, 300)] + ["\0" * k for k in range(1, 300)]
    rng.shuffle(texts)
    data, rows = text_bytes(pa.array(texts))
    h = Hasher(data)(rows[:-1], rows[1:])
    assert len(set(h.tolist())) == len(set(texts)) == len(set(zip(h.tolist(), texts)))


@pytest.mark.parametrize("n", [1, 2, 7, 8, 26, 50])
def test_window_hashes_against_windows(n):
    v = np.random.default_rng(n).integers(0, 2, 3000).astype(np.uint64)
    g = gram_hashes(v, n)
    windows = [tuple(v[i : i + n].tolist()) for i in range(len(v) - n + 1)]
    assert len(g) == len(windows)
    assert len(set(zip(g.tolist(), windows))) == len(set(windows)) == len(set(g.tolist()))


def test_pattern_lines_in_operators(spark):
    one, two = morse(1024)
    docs = spark.createDataFrame(
        [(1, f"{one}\n{two}", "en", "s"), (2, f"{one} {two}", "en", "s")],
        "doc_id long, text string, language string, source string",
    )
    f = {r.doc_id: r for r in quality.with_features(docs).collect()}
    assert f[1].n_dup_lines == 0
    kept = linedup.similar_lines(docs).where("doc = 1").collect()
    assert len(kept) == 2 and all(r.kept and r.n_links == 0 for r in kept)
    assert {r.doc_id: r.text for r in linedup.dedup_lines(docs).collect()}[1] == f"{one}\n{two}"


def test_long_text_of_equal_lines(spark):
    n = 200_000
    docs = spark.createDataFrame(
        [(1, "\n".join(["a line of words"] * n) + "\n\nlast one"), (2, None), (3, ""), (4, "other\n\nother\n")],
        "doc_id long, text string",
    )
    begin = time.time()
    got = {r.doc_id: r.text for r in linedup.dedup_lines(docs).collect()}
    assert got == {1: "a line of words\n\nlast one", 2: None, 3: "", 4: "other\n\n"}
    assert time.time() - begin < 120


def test_pattern_words_score_apart(spark):
    """Two words of a pattern count as two: ln 1/2 each, the second after a back-off."""
    one, two = morse(1024)
    docs = spark.createDataFrame([(1, f"{one} {two}")], "doc_id long, text string")
    (row,) = backoff.backoff_scores(docs).collect()
    assert row.log_score == pytest.approx(2 * np.log(0.5) + np.log(0.4), abs=1e-5)


def test_pairs_of_an_empty_block():
    """Members of one block alone, met for a pair of blocks, give no pair."""
    table = np.zeros(1 << linedup.COUNT_BITS, np.uint8)
    words = np.sort(np.arange(1, 6, dtype=np.uint64) << np.uint64(58))
    off = np.arange(0, 31, 5)
    every = np.tile(words, 6)
    for cut, n in ((None, 15), (0, 0), (6, 0), (2, 8)):
        i, j = linedup._matrix_pairs(off, every, words[0], cut, table, 0.8)
        assert len(i) == len(j) == n

"""Genetic packing, fill-in-the-middle and tokenizer alignment against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from sparkcast.llm import align, binpack, fim
from sparkcast.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_SMALL

P = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module", params=["messy", "table"])
def docs(request, spark, messy):
    return messy if request.param == "messy" else spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return [r.asDict() for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    return path, Tokenizer.from_file(path)


# genetic packing


@pytest.mark.parametrize("capacity", [100, 4096])
def test_every_id_has_one_place(docs, rows, tokenizer, capacity):
    path, whole = tokenizer
    got = [r.asDict() for r in binpack.pack(docs, path, capacity=capacity).collect()]
    want, have = Counter(), Counter()
    total = 0
    for r in rows:
        ids = np.array(whole.encode(r["text"] or "", add_special_tokens=False).ids + [1], "<u4")
        total += len(ids)
        for i, s in enumerate(range(0, len(ids), capacity)):
            piece = ids[s : s + capacity]
            want[r["doc_id"], i, s, len(piece), zlib.crc32(piece.tobytes())] += 1
    bins = defaultdict(list)
    for r in got:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        have[r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]] += 1
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    assert have == want
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    counts = Counter(r["length"] for r in got)
    decreasing = binpack.best_fit(Counter(), sorted(counts.items(), reverse=True), capacity)
    assert binpack.lower_bound(counts, capacity) <= len(bins) <= sum(decreasing.values())


def test_a_rerun_gives_the_same_packing(messy, tokenizer):
    again = [
        sorted(map(str, binpack.pack(messy, tokenizer[0], capacity=200).drop("ids").collect()))
        for _ in range(2)
    ]
    assert again[0] == again[1]


def best_fit_brute(pieces, capacity):
    rooms = []
    for n in pieces:
        fits = [i for i, r in enumerate(rooms) if r >= n]
        if fits:
            i = min(fits, key=lambda i: rooms[i])
            rooms[i] -= n
        else:
            rooms.append(capacity - n)
    return sorted(rooms)


def pieces_of(bins):
    found = Counter()
    for pattern, m in bins.items():
        for n, k in pattern:
            found[n] += k * m
    return found


def test_best_fit_by_counts_is_best_fit_by_pieces():
    rng = random.Random(3)
    for _ in range(200):
        capacity = rng.choice([10, 50, 100])
        counts = Counter(rng.randint(1, capacity) for _ in range(rng.randint(1, 150)))
        order = sorted(counts.items(), reverse=True)
        if rng.random() < 0.5:
            rng.shuffle(order)
        got = binpack.best_fit(Counter(), order, capacity)
        assert pieces_of(got) == counts
        rooms = sorted(binpack._room(p, capacity) for p, m in got.items() for _ in range(m))
        assert rooms == best_fit_brute([n for n, k in order for _ in range(k)], capacity)


def test_lower_bound_never_exceeds_a_known_packing():
    rng = random.Random(4)
    for _ in range(200):
        counts, bins = Counter(), rng.randint(1, 30)
        for _ in range(bins):
            room = 100
            while room and rng.random() < 0.9:
                n = rng.randint(1, room)
                counts[n] += 1
                room -= n
        assert binpack.lower_bound(counts, 100) <= bins
    assert binpack.lower_bound(Counter({51: 7}), 100) == 7
    assert binpack.lower_bound(Counter(), 100) == 0


def test_crossover_and_mutation_keep_every_piece():
    rng = random.Random(5)
    counts = Counter(rng.randint(20, 60) for _ in range(400))
    population = binpack.first_population(counts, rng, 6, 100)
    for _ in range(40):
        a, b = rng.sample(population, 2)
        child = binpack.mutate(binpack.crossover(a, b, counts, rng, 100, 0.97), counts, rng, 100)
        assert pieces_of(child) == counts and all(binpack._room(p, 100) >= 0 for p in child)


def test_the_search_beats_best_fit_and_reaches_a_known_optimum(spark):
    """Triples that fill their bins exactly: longest-first best fit misses them."""
    rng = random.Random(8)
    counts, bins = Counter(), 40
    for _ in range(bins):
        a = rng.randint(380, 490)
        b = rng.randint(max(260, 1000 - a - 340), 300)
        for n in (a, b, 1000 - a - b):
            counts[n] += 1
    greedy = sum(binpack.best_fit(Counter(), sorted(counts.items(), reverse=True), 1000).values())
    search = binpack.Search(islands=4, population=12, generations=30, epochs=2)
    genes = binpack.search_packing(spark, counts, 1000, search).collect()
    assert pieces_of({tuple(zip(g.lengths, g.copies)): g.bins for g in genes}) == counts
    assert bins <= sum(g.bins for g in genes) < greedy


def test_millions_of_equal_pieces(spark):
    counts = Counter({1365: 3_000_000_000, 700: 1_000_000_000, 1: 17})
    genes = binpack.search_packing(spark, counts, 4096).collect()
    assert pieces_of({tuple(zip(g.lengths, g.copies)): g.bins for g in genes}) == counts
    slots = binpack.Slots(sorted(map(tuple, genes)), 4096)
    number = np.array([0, 2_999_999_999, 5])
    sequence, offset = slots(np.array([1365, 1365, 1]), number)
    assert (offset < 4096).all() and sequence.max() < sum(g.bins for g in genes)


# fill in the middle


def fim_brute(doc_id, text, unit):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "line" else list(text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100:
        return doc_id, n, "plain", None, None, text
    i, j = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(units[a:b]) for a, b in ((0, i), (i, j), (j, n)))
    spm = h4 % 100 < 50
    out = f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, n, "spm" if spm else "psm", len(p), len(m), out


ODD = [
    "\n", "\n\n\n", "a", "a\n", "\na", "é", "中文\n中\n", "x\n" * 300, "a<P>b", "<", "<S", "M>\n<\n<\n",
    "\n<\n>\nP>\n<P\n", "\r\n\x0b\n\x8aĊਊ\U0001f60a\n" * 5, " \x85\n", "no break " * 900,
]


@pytest.mark.parametrize("unit", ["line", "char"])
def test_fim_against_brute_force(spark, docs, rows, unit):
    odd = [(1000 + 20 * k + i, t) for k in range(20) for i, t in enumerate(ODD)]
    data = [(r["doc_id"], r["text"]) for r in rows] + odd
    table = docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    out = fim.transform(table, unit=unit)
    got = out.select("*", fim.restored_text(out["fim_text"], out["form"]).alias("back")).collect()
    want = Counter(fim_brute(i, t, unit) for i, t in data)
    assert Counter(tuple(r[:6]) for r in got) == want
    back = Counter((r.doc_id, r.back) for r in got)
    assert back == Counter((i, t or "") for i, t in data)


def test_marks_rank_and_select():
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 8, 9, 1000):
        data = rng.choice(np.array([0x0A, 0x0B, 0x8A, 0x0A ^ 0x80, 0xC3, 0x00, 0xFF], np.uint8), n)
        words = fim.as_words(data)
        for mark, is_marked in (
            (fim.line_ends, data == 0x0A),
            (fim.char_starts, (data & 0xC0) != 0x80),
        ):
            marks = fim.Marks(words, mark)
            want = np.concatenate(([0], np.cumsum(is_marked)))
            assert (marks.rank(np.arange(n + 1)) == want).all()
            at = np.flatnonzero(is_marked)
            assert (marks.select(np.arange(len(at))) == at).all()


# alignment


@pytest.fixture(scope="module")
def both():
    import sentencepiece
    from tokenizers import Tokenizer

    files = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
    a = Tokenizer.from_file(files[0])
    a.encode_special_tokens = True
    return files, a, sentencepiece.SentencePieceProcessor(model_file=files[1])


def align_brute(rows, a, b):
    alphabet = align._byte_alphabet()
    a_bytes = {i: bytes(alphabet[c] for c in t) if all(c in alphabet for c in t) else t.encode() for t, i in a.get_vocab().items()}
    found, counts = [], Counter()
    for doc_id, text in rows:
        text = text or ""
        ia, ib = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        ta = [a_bytes[i] for i in ia]
        tb = [
            bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()
            for p in map(b.id_to_piece, ib)
        ]
        whole = (" " + text).encode()
        if not text or b"".join(ta) != whole or b"".join(tb) != whole:
            found.append((doc_id, 0, 0, [], ""))
            continue
        links, groups, i, j, x, y, ga, gb = [], [], 0, 0, 0, 0, [], []
        while i < len(ta):
            links.append((ia[i], ib[j]))
            if not ga or ga[-1] != (i,):
                ga.append((i,))
            if not gb or gb[-1] != (j,):
                gb.append((j,))
            ea, eb = x + len(ta[i]), y + len(tb[j])
            if ea <= eb:
                i, x = i + 1, ea
            if eb <= ea:
                j, y = j + 1, eb
            if ea == eb:
                groups.append(",".join(str(ia[k]) for (k,) in ga) + "|" + ",".join(str(ib[k]) for (k,) in gb))
                ga, gb = [], []
        counts.update(links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        found.append((doc_id, len(ia), len(ib), links, len(groups), digest))
    top = defaultdict(int)
    for (x, y), n in counts.items():
        top[y] = max(top[y], n)
    out = Counter()
    for doc_id, na, nb, links, *rest in found:
        groups, digest = rest if len(rest) == 2 else (0, "")
        best = sum(counts[x] == top[x[1]] for x in links)
        out[doc_id, na, nb, groups, len(links), best, sum(counts[x] for x in links), digest] += 1
    return out, counts, top


TRICKY = [
    " leading", "  two", "trailing ", "a  b", "tab\tx \ty", "line\n\n next\n", "<|endoftext|> x<|endoftext|>y",
    "</s> <s> <unk> <0x0A>", "under▁score ▁ x", "é ö ́ x", "½ ﬁ Ａ１ ㎏", "中文 字 中", "don't it's I'LL we've",
    " nb  em x", "​zero x", "\x00 nul", "\x1c sep\x85 x", "a ́b á b", "١٢٣ 12 3", "😀 👩‍👩‍👧 x",
    "x y" * 400, "a b c d e f", " ", "\n", "!", "! ! !", "x ! y", "A" * 3000, "﻿ bom", "İ İ i",
]


@pytest.mark.parametrize("frequent", [20, align.FREQUENT])
def test_alignment_against_brute_force(spark, docs, rows, both, frequent):
    files, a, b = both
    odd = [(5000 + i, t) for i, t in enumerate(TRICKY + TRICKY[:10])]
    data = [(r["doc_id"], r["text"]) for r in rows] + odd
    table = docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    want, counts, top = align_brute(data, a, b)
    got, pairs = align.align(table, *files, frequent=frequent, frequent_texts=frequent)
    columns = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    assert got.columns == columns
    assert Counter(map(tuple, got.collect())) == want
    found = {(r.a, r.b): (r.links, r.best) for r in pairs.collect()}
    assert found == {k: (n, n == top[k[1]]) for k, n in counts.items()}


def test_chunks_give_the_ids_of_whole_texts(both):
    files, a, b = both
    t = align.Tokenizers.load(*files)
    assert t.cut
    rng = random.Random(9)
    marks = [*"ab.,'!0 \n\t  ", "́", "é", "中", "▁", " ", "'s", "　", " ", "ﬁ", "<s>", "\U0001d7d8", "ำ"]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    chunks = align._Chunks(*align.text_bytes(pa.array(texts)), True)
    for encoder, want in (
        (t.a, [e.ids for e in a.encode_batch([" " + x for x in texts], add_special_tokens=False)]),
        (t.b, b.encode(texts)),
    ):
        ids, first = encoder.tokens(chunks)
        assert [ids[i:j].tolist() for i, j in zip(first, first[1:])] == want


# shared cases


def test_empty_tables(empty, tokenizer, both):
    assert binpack.pack(empty, tokenizer[0]).count() == 0
    assert fim.transform(empty).count() == 0
    found, pairs = align.align(empty, *both[0])
    assert found.count() == 0 and pairs.count() == 0


def test_registered():
    assert {"op11_genetic_packing", "op12_fill_in_middle", "op13_tokenizer_alignment"} <= QUERIES.keys()
    assert "op12_fill_in_middle" in ORACLE

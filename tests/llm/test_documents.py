"""Document operators against brute force, on messy rows and on a real table."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from sparkcast.llm import backoff, linedup, mix, packing, quality, simhash, suffix
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


@pytest.fixture(scope="module", params=["messy", "table"])
def docs(request, spark, messy):
    return messy if request.param == "messy" else spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return [r.asDict() for r in docs.collect()]


# mixing


def test_mix_targets_and_words(docs, rows):
    got = mix.mix_sources(docs).select("doc_id", "source", "size", "source_size", "target", "taken", "placements").collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += len(words(r["text"]))
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    goal, open_, left = {}, set(order), 1.5 * sum(sizes.values())
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] >= 2 * sizes[s]}
        if not full:
            goal |= share
            break
        for s in full:
            goal[s] = 2.0 * sizes[s]
            left -= goal[s]
        open_ -= full
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(goal[r.source])
        assert 0 <= r.taken <= 2 * r.size
        assert all(0 <= p.position <= 1 for p in r.placements)
        assert sum(p.words for p in r.placements) == r.taken
        taken[r.source] += r.taken
    for s in order:
        assert abs(taken[s] - goal[s]) <= 1
    again = mix.mix_sources(docs.repartition(5)).select("doc_id", "size", "taken").collect()
    key = lambda x: (x.doc_id is None, x.doc_id or 0, x.size, x.taken)
    assert sorted(map(key, again)) == sorted(map(key, got))


def test_mix_order_follows_the_schedules(docs):
    placed = mix.training_order(mix.mix_sources(docs)).select("position", "words").collect()
    at = [r.position for r in placed]
    assert at == sorted(at) and all(r.words > 0 for r in placed)


def test_mixed_documents_keep_columns_and_cut(docs, rows):
    out = mix.mixed_documents(docs)
    assert out.columns == docs.columns
    total = sum(len(words(r.text)) for r in out.collect())
    assert total == sum(r.taken for r in mix.mix_sources(docs).select("taken").collect())


def test_cumulative_demand_is_inverted(spark):
    one = spark.createDataFrame([(i, "a " * 10, "s") for i in range(100)], "doc_id long, text string, source string")
    for a, b in ((4.5, 1.5), (0.5, 1.5), (2.0, 2.0), (0.0, 2.0)):
        got = mix.training_order(mix.mix_sources(one, schedules=[(a, b)], budget=1.0)).select("position").collect()
        for i, r in enumerate(got):
            t = r.position
            assert (a * t + (b - a) * t * t / 2) / ((a + b) / 2) == pytest.approx(i / 100, abs=1e-9)


# packing


@pytest.fixture(scope="module")
def tokenizer():
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    return path, Tokenizer.from_file(path)


@pytest.mark.parametrize("capacity", [64, 2048])
def test_packing_places_every_id_once(docs, rows, tokenizer, capacity):
    path, whole = tokenizer
    got = [r.asDict() for r in packing.with_checksum(packing.pack(docs, path, capacity=capacity)).collect()]
    ids = [np.array(whole.encode(r["text"] or "", add_special_tokens=False).ids + [1], "<u4") for r in rows]
    want = defaultdict(Counter)
    for r, x in zip(rows, ids):
        doc, start, length = packing.cut(np.array([len(x)]), capacity)
        for s, n in zip(start.tolist(), length.tolist()):
            want[r["doc_id"]][s, n, len(x), zlib.crc32(x[s : s + n].tobytes())] += 1
        assert length.sum() == len(x) and (np.diff(start) == length[:-1]).all()
    have = defaultdict(Counter)
    for r in got:
        have[r["doc_id"]][r["start"], r["length"], r["doc_tokens"], r["ids_crc32"]] += 1
    assert have == want
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity and at & (at - 1) == 0  # no padding at all


# quality


def features(text):
    ws = words(text)
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = Counter(tuple(ws[i : i + 8]) for i in range(len(ws) - 7))
    twice = {j for i in range(len(ws) - 7) if grams[tuple(ws[i : i + 8])] > 1 for j in range(i, i + 8)}
    return (
        len(ws),
        sum(map(len, ws)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines),
        len(lines) - len(set(lines)),
        len(twice),
    )


def test_quality_counts_and_base_rules(docs, rows):
    got = quality.quality_rules(docs, min_group=3).collect()
    have = Counter((r.doc_id, *(r[c] for c in quality.FEATURES), r.base_failed) for r in got)
    want = Counter()
    for r in rows:
        f = features(r["text"])
        want[r["doc_id"], *f, f[0] < 20 or 100 * f[-1] > 30 * f[0]] += 1
    assert have == want
    assert not any(r.kept and r.base_failed for r in got)


def test_quality_filter_keeps_what_the_rules_keep(docs):
    out = quality.quality_filter(docs)
    assert out.columns == docs.columns and out.schema == docs.schema
    kept = [r.doc_id for r in quality.quality_rules(docs).where("kept").collect()]
    assert Counter(r.doc_id for r in out.collect()) == Counter(kept)


def test_quality_on_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    r = quality.quality_rules(docs).where("not base_failed").join(labels, "doc_id").toPandas()
    assert r[r.quality == 1].kept.mean() > 0.99
    assert r[r.quality == 0].kept.mean() < 0.2


def of_length(rng, n, words=40):
    """A text of words of about ``n`` characters."""
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(n + i % 3 - 1)) for i in range(words))


@pytest.mark.parametrize("n", [12, 99, 100])
def test_quality_of_a_rare_language(spark, n):
    rng = random.Random(7)
    rows = [(i, of_length(rng, 5), "en", f"s{i % 2}") for i in range(300)]
    rows += [(1000 + i, of_length(rng, 12), "xx", "s0") for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert quality.quality_rules(docs).where("kept").count() == 300 + n
    # an outlier is still told apart in the rare language
    more = docs.unionByName(docs.limit(1).selectExpr("-1L doc_id", f"'{of_length(rng, 45)}' text", "'xx' lang", "'s0' source"))
    assert [r.doc_id for r in quality.quality_rules(more).where("not kept").collect()] == [-1]


def test_quality_of_long_words(spark):
    rng = random.Random(8)
    rows = [(i, of_length(rng, 48 + i % 40), "zh", "s") for i in range(200)]
    rows += [(900, of_length(rng, 40), "zh", "s"), (901, of_length(rng, 10000), "zh", "s")]
    rows += [(1000 + i, of_length(rng, 20011), "ja", "s") for i in range(30)]  # no spread
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert [r.doc_id for r in quality.quality_rules(docs).where("not kept").collect()] == [901]


# SimHash


def simhash_brute(rows, bits=3):
    import xxhash

    def fingerprint(text):
        ws = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        grams = [" ".join(ws[i : i + 3]) for i in range(max(len(ws) - 2, 1))] if ws else []
        h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fp = [fingerprint(r["text"]) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= bits and group[i] != group[j]:
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    least = {}
    for g, r in zip(group, rows):
        if r["doc_id"] is not None:
            least[g] = min(least.get(g, r["doc_id"]), r["doc_id"])
        else:
            least.setdefault(g, least.get(g))
    least = {
        g: min((r["doc_id"] for h, r in zip(group, rows) if h == g and r["doc_id"] is not None), default=None)
        for g in set(group)
    }
    return fp, group, least


@pytest.mark.parametrize("block", [8, 16384])
def test_simhash_components(docs, rows, block):
    got = simhash.simhash_components(docs, block=block).collect()
    fp, group, least = simhash_brute(rows)
    want = Counter((r["doc_id"], f"{f:016x}", least[g]) for r, f, g in zip(rows, fp, group))
    assert Counter(map(tuple, got)) == want


def test_simhash_dedup_keeps_one_of_each_group(docs, rows):
    out = simhash.simhash_dedup(docs)
    assert out.columns == docs.columns
    _, group, least = simhash_brute(rows)
    left = out.collect()
    assert len(left) == len(set(group))
    key = lambda x: (x is None, x or 0)
    assert sorted((r.doc_id for r in left), key=key) == sorted(least.values(), key=key)


def test_blocks_of_one_dense_cluster(spark):
    rng = np.random.default_rng(1)
    fp = np.uint64(0x0123456789ABCDEF) ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64))
    fp = np.unique(np.concatenate((fp, rng.integers(0, 1 << 63, 300).astype(np.uint64))))
    label = simhash.link_blocks(fp, None, np.arange(len(fp)), 3)
    near = np.bitwise_count(fp[:, None] ^ fp) <= 3
    want = np.arange(len(fp))
    for _ in range(len(fp)):
        new = np.where(near, want[None, :], len(fp)).min(axis=1)
        if (new == want).all():
            break
        want = new
    assert (label == want).all()


# lines


def lines_brute(rows, t=0.8):
    place = lambda r, n: (r["doc_id"] is not None, r["doc_id"] or 0, r["text_key"], n)
    seen = {}
    for r in rows:
        for n, line in enumerate((r["text"] or "").split("\n")):
            if words(line):
                seen[line] = min(seen.get(line, place(r, n)), place(r, n))
    keys = sorted(seen, key=seen.get)
    sets = [frozenset(words(k)) for k in keys]
    links, earlier = Counter(), set()
    for i in range(len(keys)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both >= t * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                links[keys[i]] += 1
                links[keys[j]] += 1
                earlier.add(keys[i])
    out = Counter()
    for r in rows:
        for n, line in enumerate((r["text"] or "").split("\n")):
            if words(line):
                kept = place(r, n) == seen[line] and line not in earlier
                out[r["doc_id"], n, seen[line][3], links[line], kept] += 1
    return out


@pytest.mark.parametrize("sizes", [linedup.SIZES, linedup.Sizes(hot=200, block=3, bulk=4)])
def test_similar_lines(docs, sizes):
    from pyspark.sql import functions as F

    rows = [r.asDict() for r in docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).collect()]
    if len(rows) > 150:
        docs, rows = docs.where("doc_id < 60"), [r for r in rows if r["doc_id"] < 60]
    got = linedup.similar_lines(docs, sizes=sizes).collect()
    assert Counter((r.doc, r.line_no, r.class_line, r.n_links, r.kept) for r in got) == lines_brute(rows)


def test_dedup_lines_rebuilds_texts(docs, rows):
    out = linedup.dedup_lines(docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert len(got) == len(rows)
    assert sum(r.text is None for r in got) == sum(r["text"] is None for r in rows)
    kept = linedup.similar_lines(docs).where("kept").count()
    assert sum(bool(words(x)) for r in got for x in (r.text or "").split("\n")) == kept


# repeated passages


@pytest.mark.parametrize("hot", [2, 1000])
def test_repeated_passages(docs, hot):
    from pyspark.sql import functions as F

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("k")).collect()
    first, having = {}, defaultdict(set)
    place = lambda r, s: (r.doc_id is not None, r.doc_id or 0, r.k, s)
    for r in rows:
        ws = words(r.text)
        for s in range(len(ws) - 49):
            g = tuple(ws[s : s + 50])
            first[g] = min(first.get(g, place(r, s)), place(r, s))
            having[g].add(r.doc_id)
    want = set()
    for r in rows:
        ws = words(r.text)
        for s in range(len(ws) - 49):
            g = tuple(ws[s : s + 50])
            if len(having[g]) > 1:
                want |= {(r.doc_id, r.k, first[g] == place(r, s), x) for x in range(s, s + 50)}
    got = suffix.repeated_passages(docs, hot=hot).collect()
    assert {(r.doc, r.text_key, r.first, x) for r in got for x in range(r.start, r.stop)} == want
    assert all(r.stop - r.start >= 50 for r in got)


@pytest.mark.parametrize("hot", [2, 1000])
def test_passages_of_texts_under_one_id(spark, hot):
    rng = random.Random(10)
    shared, *ends = (" ".join(f"w{rng.random()}" for _ in range(60)) for _ in range(5))
    rows = [(None, f"{shared} {ends[0]}"), (None, f"{ends[1]} {shared}")]
    rows += [(7, f"{ends[2]} {ends[3]}"), (7, f"{ends[2]} more")]
    rows += [(8, ends[1][::-1])] * 2  # one row twice
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix.repeated_passages(docs, hot=hot).collect()
    assert sorted((str(r.doc), r.start, r.stop) for r in got) == [
        ("7", 0, 60), ("7", 0, 60), ("None", 0, 60), ("None", 60, 120)
    ]
    assert sorted(r.first for r in got) == [False, False, True, True]


def test_hot_cells_keep_their_marks(spark):
    # so many keys that some share a cell of the table with a hot one
    rng = np.random.default_rng(9)
    hot, cold = (" ".join(map(str, rng.integers(1 << 40, size=500_000))) for _ in range(2))
    docs = spark.createDataFrame([(hot,)] * 5 + [(cold,)] * 2, "text string").coalesce(1)
    key = suffix._suffixes(pa.array([hot]))[3]
    marks = suffix.suffix_marks(docs, "text", 5)
    assert suffix.marked(marks[1], key >> np.uint64(64 - suffix.MARK_BITS)).all()


# scores


@pytest.mark.parametrize("frequent", [40, backoff.FREQUENT])
def test_backoff_scores(docs, rows, frequent):
    count, pairs, having = Counter(), Counter(), defaultdict(set)
    copies = Counter((r["doc_id"], r["text"]) for r in rows)
    for r in rows:
        ws = words(r["text"])
        count.update(ws)
        for p in zip(ws, ws[1:]):
            pairs[p] += 1
            having[p].add((r["doc_id"], r["text"]))
    total = sum(count.values())
    want = []
    for r in rows:
        ws, score, seen = words(r["text"]), 0.0, 0
        for i, w in enumerate(ws):
            p = (ws[i - 1], w) if i else None
            if p and len(having[p]) > 1:
                score += math.log(pairs[p] / count[p[0]])
                seen += 1
            else:
                score += math.log(count[w] / total) + (math.log(0.4) if i else 0)
        want.append((r["doc_id"] is None, r["doc_id"] or 0, len(ws), seen, round(score, 6)))
    assert copies
    got = backoff.backoff_scores(docs, frequent=frequent, words_per_task=3000).collect()
    have = [(r.doc_id is None, r.doc_id or 0, r.n_words, r.n_seen, r.log_score) for r in got]
    assert [x[:4] for x in sorted(have)] == [x[:4] for x in sorted(want)]
    for a, b in zip(sorted(have), sorted(want)):
        assert a[4] == pytest.approx(b[4], abs=1e-5)


def test_backoff_packed_arrays():
    rng = np.random.default_rng(5)
    for dtype in ("<u2", "<u4", "<u8"):
        for n in (0, 1, 1000):
            a = rng.integers(0, np.iinfo(dtype).max, n, dtype=dtype, endpoint=True)
            got = backoff._array(pa.py_buffer(backoff._dense(a)), dtype)
            assert got.dtype == a.dtype and (got == a).all()


def test_backoff_pairs_travel_small(spark):
    """A travelling pair takes few bytes: words as numbers, columns compressed."""
    rng = np.random.default_rng(11)
    texts = [" ".join(map(str, x)) for x in np.exp(rng.uniform(0, 14, (1000, 400))).astype(int)]
    docs = spark.createDataFrame(list(enumerate(texts)), "key long, text string").coalesce(1)
    count = Counter(w for t in texts for w in t.split())
    often = pa.array([w for w, n in count.items() if n > 3])
    hashes = np.sort(np.concatenate([backoff._tokens(often.slice(i, 1))[0] for i in range(len(often))]))
    none = np.empty(0, np.uint64)
    f = backoff.Frequent(400_000, hashes, np.ones(len(hashes)), none, np.empty(0), np.empty(0, bool))
    packed = backoff.exploded_pairs(docs, spark.sparkContext.broadcast(f), 0.4, 12)
    size = sum(len(x) for row in packed.drop("task").collect() for x in row)
    assert size < 10 * 400_000


# empty tables


def test_empty_tables(empty, tokenizer):
    made = [
        mix.mix_sources(empty),
        mix.mixed_documents(empty),
        packing.pack(empty, tokenizer[0]),
        quality.quality_rules(empty),
        quality.quality_filter(empty),
        simhash.simhash_components(empty),
        simhash.simhash_dedup(empty),
        linedup.similar_lines(empty),
        linedup.dedup_lines(empty),
        suffix.repeated_passages(empty),
        backoff.backoff_scores(empty),
    ]
    for df in made:
        assert df.count() == 0

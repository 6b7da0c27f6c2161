"""Top-k search, WARC archives and reply trees against brute force and round trips."""

import gzip
import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkcast.llm import chat, topk, warc
from sparkcast.llm.components import connected_components
from tests.conftest import SF_SMALL

# top-k


def top_k_brute(rows, queries, k):
    def quantized(v):
        if not v or any(c is None or not np.isfinite(c) for c in v):
            return None
        return [int(np.floor(256 * float(c))) for c in v]

    good = [(i, q) for i, v in rows if i is not None and (q := quantized(v)) is not None]
    size = max({len(q) for _, q in good}, key=[len(q) for _, q in good].count)
    good = [(i, q) for i, q in good if len(q) == size]
    out = []
    for qi in queries:
        asks = [q for i, q in good if i == qi]
        if asks:
            q = min(asks)
            found = sorted((-sum(a * b for a, b in zip(q, x)), i) for i, x in good if i != qi)[:k]
            out += [(qi, n + 1, i, -s) for n, (s, i) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("part", [7, 512])
def test_top_k_on_messy_vectors(spark, part):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=6)]) for i in range(120)]
    rows += [(200 + i, rows[4][1]) for i in range(40)]  # one very common vector: ties
    rows += [(300, None), (301, []), (302, [0.1, None, 0.2, 0.3, 0.1, 0.0]), (303, [float("nan")] + [0.1] * 5)]
    rows += [(304, [float("inf")] + [0.0] * 5), (None, [0.5] * 6), (305, [1.0, 2.0]), (306, [0.0] * 6)]
    rows += [(10, rows[11][1]), rows[20]]  # an id met twice, and a repeated row
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    df = df.select("*", *[F.lit(1).alias(c) for c in ("id", "v", "pivot", "ring", "rank", "score", "qb")])
    queries = [4, 10, 20, 205, 300, 303, 305, 306]
    got = topk.exact_top_k(df, df.where(F.col("vec_id").isin(queries)), 5, part=part, query_block=3)
    assert sorted(map(tuple, got.collect())) == top_k_brute(rows, queries, 5)


def test_top_k_with_fewer_rows_than_k(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, [2.0]), (3, [2.0])], "vec_id long, embedding array<float>")
    got = topk.exact_top_k(df, df, 5).orderBy("query_id", "rank").collect()
    assert [tuple(r)[:3] for r in got] == [(1, 1, 2), (1, 2, 3), (2, 1, 3), (2, 2, 1), (3, 1, 2), (3, 2, 1)]
    assert topk.exact_top_k(df.where("false"), df, 5).count() == 0
    assert topk.exact_top_k(df, df.where("false"), 5).count() == 0


def test_top_k_on_the_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = [(r.vec_id, [float(c) for c in r.embedding]) for r in df.collect()]
    queries = [i for i, _ in rows if i % 50 == 0]
    got = topk.exact_top_k(df, df.where("vec_id % 50 = 0"), 5).collect()
    assert sorted(map(tuple, got)) == top_k_brute(rows, queries, 5)


@pytest.mark.parametrize("few", [0, 4096])
def test_top_k_of_large_vectors_and_all_lengths(spark, few, monkeypatch):
    monkeypatch.setattr(topk, "FEW", few)
    rng = np.random.default_rng(4)
    rows = []
    for size, base in ((6, 0), (3, 1000)):
        for i in range(150 if size == 6 else 90):
            scale = (1.0, 5e3, 5e4, 2e5)[i % 7] if i % 7 < 4 else 1.0
            rows.append((base + i, [float(c) for c in rng.normal(size=size) * scale]))
    rows += [(2000, [4096.0] + [0.0] * 5), (2001, [0.0] * 5 + [1e30]), (2002, [0.0, 0.0, -1e300])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for i, c in ((2001, 5), (2002, 2)):  # its score with these queries fits
        df = df.withColumn("embedding", F.expr(f"CASE WHEN size(embedding) = {c + 1} AND vec_id < 2000 THEN concat(slice(embedding, 1, {c}), array(0D)) ELSE embedding END"))
    rows = [(r.vec_id, list(r.embedding)) for r in df.collect()]
    queries = [0, 1, 2, 3, 7, 8, 9, 10, 2000, 1000, 1001, 1002, 1005]
    got = topk.exact_top_k(df, df.where(F.col("vec_id").isin(queries)), 5, part=40, query_block=3)
    want = []
    for size in (6, 3):
        own = [r for r in rows if len(r[1]) == size]
        want += top_k_brute(own, [q for q in queries if q in dict(own)], 5)
    assert sorted(map(tuple, got.collect())) == sorted(want)


# WARC


def record(n, body, extra=b"", kind=b"response"):
    digest = hashlib.sha256(body).hexdigest().encode()
    return (
        b"WARC/1.1\r\nWARC-Type: %s\r\nWARC-Record-ID: <urn:page:%d>\r\nWARC-Block-Digest: sha256:%s\r\n%s"
        b"Content-Length: %d\r\n\r\n%s\r\n\r\n" % (kind, n, digest, extra, len(body), body)
    )


def pieces(data):
    found = list(warc.salvage(data))
    assert [f.start for f in found][:1] in ([0], []) or found[0].reason is None
    ids = [int(f.headers["warc-record-id"][10:-1]) for f in found if f.reason is None]
    return ids, [(f.start, f.end) for f in found if f.reason]


def test_salvage_plain_records():
    r = [record(i, b"body %d " % i * 20) for i in range(5)]
    assert pieces(b"".join(r)) == ([0, 1, 2, 3, 4], [])
    a, b = len(r[0]), len(r[0]) + len(r[1])
    flipped = bytearray(b"".join(r))
    flipped[b - 20] ^= 1  # a body byte: the digest fails
    assert pieces(bytes(flipped)) == ([0, 2, 3, 4], [(a, b)])
    assert pieces(r[0] + r[1][:40] + r[2]) == ([0, 2], [(a, a + 40)])  # cut in the header
    assert pieces(r[0] + r[1][:-30] + r[2]) == ([0, 2], [(a, b - 30)])  # cut in the body
    assert pieces(r[0] + b"junk\x1f\x8b\x08junk" + r[1]) == ([0, 1], [(a, a + 11)])
    assert pieces(r[0] + r[1][:-1]) == ([0], [(a, b - 1)])  # unfinished end
    assert pieces(b"") == ([], [])
    assert pieces(b"\x00" * 50) == ([], [(0, 50)])
    bad = record(9, b"x").replace(b"Content-Length: 1", b"Content-Length: -1")
    assert pieces(bad + r[0])[0] == [0]


def test_salvage_gzip_members():
    r = [gzip.compress(record(i, b"body %d " % i * 200)) for i in range(4)]
    assert pieces(b"".join(r)) == ([0, 1, 2, 3], [])
    a, b = len(r[0]), len(r[0]) + len(r[1])
    broken = bytearray(b"".join(r))
    broken[b - 6] ^= 1  # the member's checksum
    assert pieces(bytes(broken)) == ([0, 2, 3], [(a, b)])
    assert pieces(r[0] + r[1][: len(r[1]) // 2] + r[2])[0] == [0, 2]
    assert pieces(r[0] + record(7, b"plain") + r[1])[0] == [0, 7, 1]
    both = gzip.compress(record(1, b"a") + record(2, b"b"))
    assert pieces(both + r[3])[0] == [1, 2, 3]


def test_bodies_may_hold_anything(spark, tmp_path):
    body = b"WARC/1.1\r\n\x1f\x8b\x08 \xff\xfe \r\n\r\n"
    data = record(1, body) + record(2, body[::-1])
    (tmp_path / "a.warc").write_bytes(data)
    (tmp_path / "b.warc").write_bytes(b"")
    got = warc.read_warc(spark, str(tmp_path))
    assert [bytes(x.body) for x in warc.records(got).orderBy("start").collect()] == [body, body[::-1]]
    assert warc.quarantine(got).count() == 0


def test_pages_round_trip(spark, tmp_path):
    long = "é<p>long</p>\r\n\r\n" * 4000
    rows = [
        (5, "http://a/ b\r\nX: y%", long),
        (3, "http://a", long),
        (9, None, long),
        (3, "http://twice", long),
        (1, "u", "short"),
        (2, "u", "short"),
        (7, "u", None),
        (8, "u", ""),
        (None, "u", long),
        (None, "u", "alone " * 40),
        (10, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 9),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    df = df.select("*", *[F.lit(0).alias(c) for c in ("id", "payload", "digest", "first", "record")])
    path = str(tmp_path / "out")
    warc.write_warc(warc.with_records(df), path, records_per_file=2)
    read = warc.read_warc(spark, path)
    assert warc.quarantine(read).count() == 0
    got = sorted(map(tuple, warc.page_rows(warc.records(read)).collect()), key=str)
    want = []
    for i, _, html in rows:
        body = (html or "").encode()
        again = html == long and i != 3
        want.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", 3 if again else None))
    assert got == sorted(want, key=str)
    empty = str(tmp_path / "empty")
    warc.write_warc(warc.with_records(df.where("false")), empty)
    assert warc.read_warc(spark, empty).count() == 0


# chats


def test_escape_is_reversible(spark):
    rng = random.Random(1)
    parts = ["<", "[", "\\", "|", "s>", "/", "INST]", "<<", "SYS>>", "end|>", "\n", "x", "|>", ">", "é"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    bad = df.where(chat.unescape(chat.escape(F.col("t"))) != F.col("t"))
    assert bad.count() == 0
    assert df.where(chat.unescape_role(chat.escape_role(F.col("t"))) != F.col("t")).count() == 0
    clean = df.where(chat.escape(F.col("t")).rlike(r"<\||</?s>|\[/?INST\]|<<"r"/?SYS>>"))
    assert clean.count() == 0


@pytest.fixture(scope="module")
def forest(spark):
    rng = random.Random(2)
    rows = []
    for tree in range(12):
        for node in range(rng.randint(1, 60)):
            parent = rng.randint(max(0, node - 3), node - 1) if node else None
            text = rng.choice([None, "", "hi <|end|>\n", "\n<|end|>\n<|assistant|>\n", "é" * 9, "[INST] x </s>"])
            role = rng.choice(["user", "assistant", "system", None, "a|>\nb", "<"])
            rows.append((tree, node, parent, role, text, rng.choice([None, 0.0, 1.0, 2.5])))
    rows.append((90, 1, 999, "user", "its parent is missing", 1.0))
    rows += [(91, 1, 2, "user", "a cycle", 1.0), (91, 2, 1, "user", "a cycle", 1.0)]
    rows.append((None, 5, None, "assistant", "no tree id", 1.0))
    schema = "tree long, node long, parent long, role string, text string, score double"
    df = spark.createDataFrame(rows, schema).select("*", *[F.lit(1).alias(c) for c in ("rank", "depth", "up", "size")])
    return df, rows


@pytest.mark.parametrize("best", [1, 3])
def test_paths_of_trees(forest, best):
    df, rows = forest
    out = chat.format_trees(df, best).select(
        "tree", "rank", "n_turns",
        chat.parse_turns(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    ).collect()
    trees = defaultdict(dict)
    for tree, node, parent, role, text, score in rows:
        trees[tree][node] = (parent, role or "", text or "", score or 0.0)
    want = {}
    for tree, nodes in trees.items():
        parents = {p for p, *_ in nodes.values()}
        paths = []
        for leaf in nodes:
            if leaf in parents:
                continue
            path, at = [], leaf
            while at in nodes:
                path.append(at)
                at = nodes[at][0]
            path.reverse()
            mean = sum(nodes[n][3] for n in path) / len(path)
            paths.append((-mean, -len(path), leaf, path))
        for rank, (_, _, _, path) in enumerate(sorted(paths)[:best], 1):
            want[tree, rank] = [nodes[n][1:3] for n in path]
    got = {(r.tree, r["rank"]): [tuple(t) for t in r.turns] for r in out}
    assert got == want
    for r in out:
        assert r.loss == "".join(t.text for t in r.turns if t.role == "assistant")
        assert r.n_turns == len(r.turns)


def test_chains_keep_every_row(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None), (None, 3, "user", ""), (2, 5, "assistant", "z" * 100000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_trees(chat.chain_nodes(df)).collect()
    assert sorted(r.n_turns for r in out) == [1, 1, 3]
    assert chat.format_trees(chat.chain_nodes(df.where("false"))).count() == 0


# components


def test_connected_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 90)] + [(200, x) for x in range(201, 300)]
    edges += [(rng.randint(400, 500), rng.randint(400, 500)) for _ in range(60)] + [(7, 7), (None, 3), (5, None), (1, 0)]
    got = connected_components(spark.createDataFrame(edges, "u long, v long")).collect()
    group = {}
    for u, v in edges:
        if u is not None and v is not None and u != v:
            a, b = group.get(u, u), group.get(v, v)
            group.setdefault(u, u), group.setdefault(v, v)
            group = {k: min(a, b) if g in (a, b) else g for k, g in group.items()}
    assert {r.node: r.root for r in got} == {k: g for k, g in group.items() if k != g}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0

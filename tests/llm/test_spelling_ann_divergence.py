"""Spelling variants, neighbour search and source divergence against brute force, and on odd tables."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import prose
from pyspark.sql import functions as F

from goldpan.llm import ann, divergence, spelling

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(rows, every):
    total = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(SMALL)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if h % every == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            total[word] += 1
    n = {w: k for w, k in total.items() if len(w) >= 5 and k >= 3}
    found = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w, others in found.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted(((w, form[w], root(w), n[w], len(found[w]), n.get(form[w])) for w in n), key=repr)


def variants(df, **settings):
    return sorted(((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling.group_variants(df, **settings).collect()), key=repr)


def test_variants_equal_brute_force(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abl") for _ in range(rng.randint(4, 8))) for _ in range(250)] + ["éclair", "éclaiR", "Éclair", "hello", "helo", "helllo", "ÀÀÀÀÀ"]
    rows = [(i, " ".join(rng.choices(words, k=60)) + "-" + rng.choice(words).upper()) for i in range(120)]
    rows += [(None, "hello hello helo"), (7, None), (8, ""), rows[0], rows[0]]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("word", "n", "id", "path")})
    expected = plain_variants(rows, 7)
    assert sum(r[1] is not None for r in expected) > 20 and max(r[4] for r in expected) > 3 and any(r[1] != r[2] and r[1] for r in expected)
    assert variants(df, every=7) == expected
    assert variants(df, every=7, range_words=9) == expected  # nodes shared across many ranges


def test_variants_of_odd_tables(spark, documents, nothing):
    assert variants(nothing) == []
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    assert variants(documents) == plain_variants(rows, 97)
    long = "ab" * 5_000
    df = spark.createDataFrame([(k, f"{long} {long[:500]}x{long[500:]}") for k in range(4)], "doc_id long, text string")
    assert [(r[3], r[4]) for r in variants(df, every=10**9)] == [(4, 1), (4, 1)]


def test_common_beginnings():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choice("ab") for _ in range(rng.randint(0, 12))) for _ in range(2))
        assert spelling.common(a, b) == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def searched(vectors, queries, **settings):
    return [tuple(r) for r in ann.nearest_neighbours(vectors, queries, **settings).orderBy("query_id", "rank").collect()]


def dot(v, w):
    total = 0.0
    for x, y in zip(v, w):  # the built-in sum compensates rounding
        total += x * y
    return total


def exact(rows, asked, k):
    found = []
    for q in sorted(set(asked)):
        v = next(v for i, v in rows if i == q)
        scored = sorted({(-dot(v, w), i) for i, w in rows if i != q})[:k]
        found += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)]
    return found


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((40, 16)) * 4
    rows = centres[rng.integers(0, 40, 6000)] + rng.standard_normal((6000, 16)) * 0.5
    rows *= rng.uniform(0.5, 2, (6000, 1))  # lengths differ, so the nearest by inner product is not the nearest by angle
    return [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rows)]


def test_search_recall_and_work(spark, clustered):
    df = spark.createDataFrame(clustered, "vec_id long, embedding array<float>").repartition(5)
    got = searched(df, df.where("vec_id % 20 = 0"), k=10, leaf_rows=32, sample_rows=2000, shard_rows=256, block_rows=64)
    expected = exact(clustered, range(0, 6000, 20), 10)
    assert [r[:2] for r in got] == [r[:2] for r in expected]
    true = {(q, i): s for q, _, i, s in expected}
    assert len(set(true) & {(q, i) for q, _, i, _ in got}) >= 0.9 * len(expected)
    vectors = dict(clustered)
    assert all(s == dot(vectors[q], vectors[i]) for q, _, i, s in got)


def test_search_queue_prunes_clusters(clustered):
    rows = np.array([v for _, v in clustered])
    forest = ann.grow(rows[:2000], float(np.sqrt((rows ** 2).sum(1).max())), len(rows), 4, 32, 1)
    lifted, aimed = forest.lifted(rows), forest.aimed(rows[:20])
    leaves = [forest.leaves(t, lifted) for t in range(4)]
    rows_of = [np.bincount(x, minlength=2 ** forest.depth) for x in leaves]
    bounds = [forest.bounds(t, aimed) for t in range(4)]
    squared = ((aimed[:, None, :] - lifted[None]) ** 2).sum(2)
    for t in range(4):
        assert (bounds[t][:, leaves[t]] <= squared + 1e-6).all()
    for k, q in enumerate(aimed):
        reach = float(np.quantile(bounds[0][k], 0.05))
        found = forest.search(q, reach, 1, rows_of)
        assert {x for x in found if bounds[x[0]][k][x[1]] <= reach} == {(t, b) for t in range(4) for b in np.flatnonzero(bounds[t][k] <= reach)}
        order = [bounds[t][k][b] for t, b in found]
        assert order == sorted(order) and len(found) == len(set(found))


def test_search_of_odd_vectors(spark):
    rng = np.random.default_rng(4)
    same, twin = [1.0, 2.0, 0.5], [2.0, 1.0, 0.5]
    rows = [(i, same) for i in range(0, 900)] + [(i, rng.standard_normal(3).round(2).tolist()) for i in range(900, 1000)]
    rows += [(1000, twin), (1001, twin), (1002, [1.0]), (1004, [3.0, 1.0])]
    odd = [(1005, None), (1006, []), (1007, [0.0, 0.0, 0.0]), (1008, [1.0, None, 2.0]), (1010, [float("nan"), 1.0, 1.0]),
           (1011, [float("inf"), 1.0, 1.0]), (None, [9.0, 9.0, 9.0]), (1002, [1.0]), (1004, [3.0, 1.0])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumns({c: F.lit("x") for c in ("id", "v", "rank", "point", "score")})
    asked = [0, 20, 900, 1000, 1002, 1004]
    for few in ({}, {"leaf_rows": 4, "shard_rows": 16, "block_rows": 2}):
        got = searched(df, df.where(F.col("vec_id").isin([*asked, 1005, 1006, 1007, 1008, 1010])), k=5, target=1.0, **few)
        padded = [(i, (v + [0.0] * 3)[:3]) for i, v in rows]
        assert got == exact(padded, asked, 5) or not few
        assert [r[:2] for r in got] == [r[:2] for r in exact(padded, asked, 5)]
    assert searched(df, df.where("vec_id < 0")) == [] and searched(df.where("false"), df) == []
    alone = df.where("vec_id = 900")
    assert searched(alone, alone) == []


def plain_divergence(rows, least_docs, top):
    rows = [tuple(x or "" for x in r) for r in rows]
    counted = [(g, s, Counter(re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", t.translate(SMALL)))) for g, s, t in rows]
    out = []
    for lang in {r[0] for r in rows}:
        docs = Counter(w for g, _, c in counted if g == lang for w in c)
        kept = [w for w, k in docs.items() if k >= least_docs]
        groups, whole = defaultdict(Counter), Counter()
        for g, s, c in counted:
            if g == lang:
                groups[s].update({w: c[w] for w in kept if c[w]})
                whole.update({w: c[w] for w in kept if c[w]})
        v = len(kept)

        def share(c, w):
            return 1 + 10**9 * (c[w] + 2) // (sum(c.values()) + 2 * v)

        def price(p, q):
            return (p - q) ** 2 // (p + q)

        for s, c in groups.items():
            pair = [(sum(price(share(c, w), share(d, w)) for w in kept), o) for o, d in groups.items() if o != s]
            term = [(price(share(c, w), share(whole, w)), w) for w in kept if c[w] and share(c, w) > share(whole, w)]
            for part, items in (("pair", pair), ("term", sorted(term, key=lambda x: (-x[0], x[1].encode()))[:top])):
                for rank, (value, item) in enumerate(sorted(items, key=lambda x: (-x[0], x[1].encode())), 1):
                    out.append((lang, s, part, item, value, rank))
    return sorted(out)


def divergences(df, **settings):
    return sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in divergence.source_divergence(df, **settings).collect())


def test_divergence_equals_brute_force(spark):
    rng = random.Random(8)
    rows = []
    for k in range(150):
        rows.append((rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", "d", "ü", None]), prose(k, rng.randint(0, 40), 60) + rng.choice([" Ärger Ä", " x1y", " 漢字"])))
    rows += [("en", "silent", "123 ..."), ("xx", "only", None), ("xx", "other", "rare words"), ("yy", "single", prose(1, 30))] + [rows[0]] * 30
    df = spark.createDataFrame(rows, "lang string, source string, text string").withColumns({c: F.lit("x") for c in ("term", "n", "docs", "v", "member", "value")})
    for settings in ({}, {"tile": 2, "block_terms": 7}, {"tile": 1}):
        assert divergences(df, least_docs=4, top=3, **settings) == plain_divergence(rows, 4, 3)


def test_divergence_of_odd_tables(documents, nothing):
    assert divergences(nothing) == []
    rows = [(r["lang"], r["source"], r["text"]) for r in documents.select("lang", "source", "text").collect()]
    assert divergences(documents, least_docs=2) == plain_divergence(rows, 2, 10)


def test_galloping_intersection():
    rng = np.random.default_rng(6)
    for _ in range(200):
        a, b = (np.unique(rng.integers(0, rng.integers(1, 3000), rng.integers(0, 900))) for _ in range(2))
        at, to = divergence.gallop(a, b)
        assert (a[at] == b[to]).all() and set(a[at]) == set(a) & set(b) and len(at) == len(set(at))


def test_shares_are_exact():
    rng = random.Random(2)
    for _ in range(2000):
        total = rng.randint(1, 9 * 10**rng.randint(1, 15))
        count = rng.randint(0, total)
        assert divergence.scaled_share(np.array([count]), total)[0] == 1 + 10**9 * count // total

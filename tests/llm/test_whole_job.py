"""Findings of the review: operators do the whole job, against brute force."""

import random

import numpy as np
from conftest import prose

from goldpan.llm import neardup
from goldpan.llm.pages import main_text


def test_near_duplicates_of_a_large_bucket_equal_brute_force(spark):
    """Texts of one bucket, most of them in one class, where the only link of a text is to another that may be no centre."""
    rng = random.Random(5)
    middle = prose(20, 60).split()
    texts = []
    for k in range(160):
        # pairs that share the middle with all others, but only with each other nine tenths of their words
        own = prose(1000 + k, 40).split()
        texts += [" ".join(own[:20] + middle + own[20:]), " ".join(own[:20] + middle + own[20:-1] + [f"end{k}"])]
    rng.shuffle(texts)
    runs = [neardup.shingles(t, 5)[1] for t in texts]
    expected = {tuple(sorted((i, j))) for i in range(len(texts)) for j in range(i) if neardup.similar(runs[i], runs[j], 0.8)}
    assert len(expected) == 160
    # sketches of one key put all texts into one bucket
    contents = spark.createDataFrame([(i, [1]) for i in range(len(texts))], "content long, prints array<long>")
    shingled = spark.createDataFrame([(i, r.astype("uint32").view("int32").tolist()) for i, r in enumerate(runs)], "content long, runs array<int>")
    few = neardup.Settings(centres=1, partners=1, later_centres=1, later_partners=1)
    roots = {i: i for i in range(len(texts))}
    for moves in neardup.linked_classes(contents, lambda wanted: shingled.join(wanted, "content", "left_semi"), few):
        to = {r["node"]: r["root"] for r in moves.collect()}
        roots = {i: to.get(r, r) for i, r in roots.items()}
    assert {(r, i) for i, r in roots.items() if r != i} == expected


def test_near_duplicates_of_short_texts(spark):
    rows = []
    for k in range(60):
        words = [f"w{k}x{j}" for j in range(8 + k % 4)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(words + ["more"]))]
    found = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {i: i - i % 2 for i in found} and len(found) == 120


def test_similarity_of_exactly_four_fifths_counts():
    for n in range(9, 4000, 9):
        # n shingles in both texts together, of which 4 n / 9 are common
        a, b = np.arange(n // 2, dtype=np.uint64), np.arange(n - n // 2, dtype=np.uint64)
        common = 4 * n // 9
        a[common:] += np.uint64(10_000)
        b[common:] += np.uint64(20_000)
        assert neardup.similar(a, b, 0.8)
        a[0] += np.uint64(30_000)
        assert not neardup.similar(a, b, 0.8)


LONG = "This sentence of the text is long enough to count as a part of the content of the page and has no links at all."


def test_main_text_keeps_all_content():
    body = "".join(f"<p>{LONG} {k}</p>" for k in range(40))
    lead = f"<div><p>{LONG} {LONG} {LONG} lead</p></div>"  # less than a tenth of the text
    assert main_text(f"<html><head></head><body>{lead}<div>{body}</div></body></html>").startswith(f"{LONG} {LONG} {LONG} lead\n{LONG} 0\n")
    teaser = f"<article><p>{LONG} teaser</p></article>"
    text = main_text(f"<html><head></head><body><div>{body}</div>{teaser}</body></html>")
    assert all(f"{LONG} {k}" in text.split("\n") for k in range(40))
    for start in ("<body>", "", "<br>"):
        assert main_text(f"<html><head><title>T</title>{start}<p>{LONG}</p>") == LONG
    assert main_text(f"<head><title>T</title>{LONG}") == LONG


def test_prefixes_meet_wherever_texts_are_similar(spark):
    """Texts that share common passages: exact counts put rare shingles first, lengths are graded, and no similar pair is lost."""
    from pyspark.sql import functions as F

    from goldpan.llm.shared import stored

    rng = random.Random(9)
    passages = [prose(300 + k, 60) for k in range(3)]
    texts = []
    for k in range(150):
        body = f"{passages[k // 3 % 3]} {prose(2000 + k // 3, 5 + k // 3 * 7 % 50)}".split()
        for _ in range(rng.randint(0, 3)):
            body[rng.randrange(len(body))] = f"odd{rng.randrange(1000)}"
        texts.append(" ".join(body))
    runs = [neardup.shingles(t, 5)[1] for t in texts]
    expected = {(i, j) for j in range(len(texts)) for i in range(j) if neardup.similar(runs[i], runs[j], 0.8)}
    assert len(expected) > 30
    shingled = stored(spark.createDataFrame([(i, r.astype("uint32").view("int32").tolist()) for i, r in enumerate(runs)], "content long, runs array<int>"), "t")
    front = shingled.select("content", F.col("content").alias("root"))
    found = {(min(r), max(r)) for r in neardup.open_links(front, shingled, neardup.Settings()).collect()}
    assert found == expected
    prefixes = neardup.shared_prefixes(front.join(shingled, "content"), neardup.Settings())
    kept = {r["content"]: r["n"] for r in prefixes.groupBy("content").agg(F.count("*").alias("n")).collect()}
    assert all(n <= len(runs[i]) - neardup.needed(len(runs[i]), 0.8) + 1 for i, n in kept.items())


def test_pipeline_keeps_every_text_of_a_repeated_id(spark):
    import corpus_pipeline

    rows = [(1, prose(1, 60))] + [(i, prose(100 + i, 50)) for i in range(2, 12)] + [(i, prose(1, 60)) for i in range(2, 12)] + [(3, ""), (3, None), (None, prose(1, 60))]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.without_near_duplicates(spark, docs, "").collect()]
    assert sorted(kept, key=repr) == sorted(rows[:11] + rows[21:], key=repr)


def test_texts_of_signs_alone_have_a_digest():
    content, runs = neardup.shingles("!!! ??? ...", 5)
    assert content == neardup.text_digest("!!!  ???\n...") and len(runs) == 1
    assert neardup.shingles(" \n ", 5)[0] is None and neardup.text_digest(None) is None and neardup.text_digest("") is None
    assert neardup.text_digest("A, b!") == neardup.shingles("a b", 5)[0]


def test_later_rounds_ask_only_centres_that_several_buckets_name(spark):
    """Forty texts share one bucket, as by a common line; only pairs share five more.  A text with a single bucket still asks."""
    rows = [(i, i, [], [(0, 7)] + [(k, i // 2) for k in range(1, 6)]) for i in range(40)] + [(i, i, [], [(6, 9)]) for i in (100, 101)]
    front = spark.createDataFrame(rows, "content long, root long, asked array<long>, keys array<struct<sketch:int,key:long>>")
    met = neardup.met_centres(front, 1, neardup.Settings()).collect()
    asked = {r["content"]: [p["centre"] for p in r["partners"]] for r in met}
    assert asked == {i: [i - 1] if i % 2 else [] for i in [*range(40), 100, 101]}

"""Operators on odd tables, against plain versions."""

from collections import defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from goldpan.llm import decontaminate, language, licenses, mixing, neardup, pages, substrings, tokens, topk, toxicity

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_token_counts(spark, documents, nothing):
    library = Tokenizer.from_file(VOCABULARY)
    texts = [r["text"] for r in documents.select("text").collect()] + ["a<|endoftext|>b", "½ Ⅷ x²'s  \n\n y", "don't I'll"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]
    got = {r["doc_id"]: r for r in tokens.token_counts(df, VOCABULARY).collect()}
    assert [got[i]["n_tokens"] for i in range(len(texts))] == expected
    assert [got[i]["n_bytes"] for i in range(len(texts))] == [len((t or "").encode()) for t in texts]
    assert tokens.token_counts(documents, VOCABULARY).count() == documents.count()
    assert tokens.token_counts(nothing, VOCABULARY).count() == 0


def test_repeated_passages(documents, nothing):
    def plain(rows):
        owners = defaultdict(set)
        for i, t in rows:
            w = (t or "").encode().split()
            for s in range(len(w) - 12):
                owners[tuple(w[s:s + 13])].add(i)
        result = []
        for i, t in rows:
            w = (t or "").encode().split()
            gone = {s + d for s in range(len(w) - 12) if i is not None and min((o for o in owners[tuple(w[s:s + 13])] if o is not None), default=i) < i for d in range(13)}
            result.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
        return sorted(result, key=repr)

    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    assert rows_of(substrings.remove_repeated_passages(documents), "doc_id", "n_words", "n_removed", "kept_text") == plain(rows)
    assert substrings.remove_repeated_passages(nothing).count() == 0


def test_near_duplicates(documents, nothing):
    got = defaultdict(set)
    for r in neardup.near_duplicate_classes(documents).collect():
        got[r["doc_id"]].add(r["class_id"])
    assert got[1] == got[2] == got[3] == {1}
    assert got[6] == got[14] == {6}
    assert all(got[i] == {i} for i in (4, 5, 7, 8, 9, 10, 11, 12, 13))
    assert neardup.near_duplicate_classes(documents).count() == documents.count()
    assert neardup.near_duplicate_classes(nothing).count() == 0


def test_leaks(spark, documents, nothing):
    item = documents.where("doc_id = 4").first()["text"].split()[10:50]
    benchmark = spark.createDataFrame([(1, " ".join(item[20:] + item[:20])), (2, "short"), (3, None), (4, "")], "item_id long, text string")
    got = {r["doc_id"] for r in decontaminate.find_leaks(documents, benchmark, block_bytes=100).where("contaminated").collect()}
    assert got == {4}
    assert decontaminate.find_leaks(documents, benchmark).count() == documents.count()
    assert decontaminate.find_leaks(documents, benchmark.where("false")).where("contaminated").count() == 0
    assert decontaminate.find_leaks(nothing, benchmark).count() == 0


def test_mix(documents, nothing):
    rows = mixing.mix_sources(documents).collect()
    assert len(rows) == documents.count() and all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    total = sum(r["size"] for r in rows)
    targets = {(r["source_size"], r["target"]) for r in rows}
    assert sum(t for _, t in targets) == pytest.approx(total) and all(t <= 3 * s + 1e-9 for s, t in targets)
    assert rows_of(mixing.mix_sources(documents), "doc_id", "taken") == rows_of(mixing.mix_sources(documents.repartition(3)), "doc_id", "taken")
    assert mixing.mix_sources(nothing).count() == 0
    assert set(mixing.mix_sources(documents, carry=["lang", "size"]).columns) == {"doc_id", "size", "source_size", "target", "taken", "repeats", "lang"}


def test_language(spark, nothing):
    words = {"en": "the and of with that", "de": "der und nicht für über"}
    rows = [(k, " ".join([words[y]] * (1 + k % 3)), y) for k in range(60) for y in words]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit_language_model(df)
    odd = spark.createDataFrame([(1, "und für über"), (2, "with the and"), (3, None), (4, ""), (5, "12 !!"), (6, "the " * 50_000)], "doc_id long, text string")
    got = {r["doc_id"]: r["p"] for r in odd.select("doc_id", language.predict_language(odd, model).alias("p")).collect()}
    assert [got[i]["lang_pred"] for i in range(1, 7)] == ["de", "en", "und", "und", "und", "en"]
    assert all(0 <= p["score"] <= 1 for p in got.values())
    assert language.fit_language_model(nothing) is None


def test_toxicity(spark, documents, nothing):
    rows, labels = [], []
    for k in range(120):
        toxic = k % 3 == 0
        rows.append((k, f"word{k} plain{k % 7} {'scoundrel' if toxic else 'neighbour'} text{k} more{k % 5}"))
        labels.append((k, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit_toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert model.terms == ("scoundrel",)
    got = {r["doc_id"]: r for r in toxicity.score_documents(docs, model).collect()}
    assert all(got[k]["predicted"] == y for k, y in labels)
    none = toxicity.fit_toxicity(documents, spark.createDataFrame([], "doc_id long, toxic int"))
    scored = toxicity.score_documents(documents, none).collect()
    assert len(scored) == documents.count() and all(0 <= r["score"] < 0.5 for r in scored)
    assert toxicity.score_documents(nothing, model).count() == 0


def test_licenses_and_pages(spark, documents, nothing):
    assert licenses.scan_licenses(documents).count() == documents.count()
    assert licenses.scan_licenses(nothing).count() == 0
    html = spark.createDataFrame([(1, "u", "<p>Some text here</p>"), (2, None, None), (None, "v", "")], "page_id long, url string, html string").withColumn("text", F.lit("x"))
    assert rows_of(pages.extract_pages(html), "page_id", "text", "n_chars") == sorted([(1, "Some text here", 14), (2, "", 0), (None, "", 0)], key=repr)


def test_top_k(spark):
    nan = float("nan")
    rows = [(k, [(k * 7 % 11) / 11.0, -(k * 5 % 13) / 13.0, 0.5]) for k in range(300)] + [(300, None), (301, [nan, 1.0, 1.0]), (302, [None, 1.0, 1.0]), (299, [0.1, 0.1, 0.1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    got = rows_of(topk.exact_top_k(df, df.where("vec_id % 100 = 0"), range_rows=40, block_rows=8, query_rows=2, sample_rows=30), "query_id", "rank", "vec_id", "score")
    import numpy as np

    whole = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in rows if v is not None and all(x is not None and x == x for x in v)]
    expected = []
    for q, v in whole:
        if q % 100 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in whole if i != q)[:10]
            expected += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert got == sorted(expected, key=repr)
    assert topk.exact_top_k(df.where("false"), df.where("false")).count() == 0


def test_components_equal_union_find(spark):
    """Chains, hubs, cycles, repeated and looping links against a plain union-find."""
    import random

    from goldpan.llm.components import components

    rng = random.Random(5)
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(rng.randint(200, 400), rng.randint(200, 400)) for _ in range(120)] + [(7, 7), (1, 0)]
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    found = components(spark.createDataFrame(links, "a long, b long"))
    assert {r["node"]: r["root"] for r in found.collect()} == {x: root(x) for x in parent if root(x) != x}
    assert found.count() == len({r["node"] for r in found.collect()})
    assert components(spark.createDataFrame([], "a long, b long")).isEmpty()

"""Divergence of the word use of sources, per language: every source against every other and against the language as a whole.

The counts of a source lie as sorted arrays of term ids.  A task merges two of them at a time by a galloping intersection and prices the
terms that both have, those that one has, and those that neither has.  All arithmetic is on whole numbers and exact.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldpan.llm.shared import stored

SCALE = 1_000_000_000
_FLUSH = 400_000  # entries of a task's table of counts; more are handed on and counted again later
# A-Z lower-cased, letters and all bytes of code points beyond ASCII kept, everything else a space
_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def terms(text: str) -> list[bytes]:
    """Runs of ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]`` as UTF-8, only A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts: lang, source, term, occurrences, documents; the empty term stands for the group itself."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def handed() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            names, size = pa.array(n.keys(), pa.binary()).cast(pa.string()), len(n)
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(lang, size), pa.repeat(source, size), names, pa.array(n.values(), pa.int64()), pa.array([docs[t] for t in n], pa.int64())],
                names=["lang", "source", "term", "n", "docs"])
        held.clear()

    entries = 0
    for batch in batches:
        for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text")), strict=True):
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            found = terms(text)
            entries -= len(n)
            n.update(found)
            docs.update(set(found))
            n[b""] += 0  # a group without terms is one as well
            docs[b""] += 1
            entries += len(n)
            if entries > _FLUSH:
                yield from handed()
                entries = 0
    yield from handed()


def scaled_share(count: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(SCALE * count / total) in whole numbers, three decimal digits at a time, so totals up to 9e15 fit in 64 bits."""
    whole, rest = np.divmod(count, total)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + digits
    return whole + 1


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def gallop(short: np.ndarray, long: np.ndarray, run: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Places of the common entries in two sorted arrays without repeats: runs of ``short`` leap through ``long`` in doubling steps."""
    at, to = [], []
    low = 0
    for start in range(0, len(short), run):
        part = short[start:start + run]
        step = run
        while low + step < len(long) and long[low + step] < part[-1]:
            step *= 2
        window = long[low:low + step + 1]
        place = np.searchsorted(window, part)
        inside = place < len(window)
        hit = np.flatnonzero(inside)[window[place[inside]] == part[inside]]
        at.append(start + hit)
        to.append(low + place[hit])
        low += int(place[-1])
        if low >= len(long):
            break
    nothing = np.empty(0, np.int64)
    return np.concatenate(at or [nothing]), np.concatenate(to or [nothing])


def merged(ids_a: np.ndarray, n_a: np.ndarray, total_a: int, ids_b: np.ndarray, n_b: np.ndarray, total_b: int) -> tuple[int, int]:
    """The price of all terms that one of two groups has, and how many terms that are; totals are N + 2V.  The same both ways."""
    if len(ids_a) > len(ids_b):
        return merged(ids_b, n_b, total_b, ids_a, n_a, total_a)
    at, to = gallop(ids_a, ids_b)
    p, q = scaled_share(n_a + 2, total_a), scaled_share(n_b + 2, total_b)
    none_a, none_b = scaled_share(np.array([2]), total_a), scaled_share(np.array([2]), total_b)
    only_a, only_b = np.ones(len(p), bool), np.ones(len(q), bool)
    only_a[at], only_b[to] = False, False
    value = int(price(p[at], q[to]).sum()) + int(price(p[only_a], none_b).sum()) + int(price(none_a, q[only_b]).sum())
    return value, len(p) + len(q) - len(at)


def _pair_tasks(tile: int):
    def prices(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        """All unordered pairs of the groups of two tiles within one block of terms."""
        lang, _, low, high = key
        rows = rows.sort_values("member", kind="stable")
        ids, n = [np.asarray(x, np.int64) for x in rows["ids"]], [np.asarray(x, np.int64) for x in rows["n"]]
        member, totals = rows["member"].to_numpy(), rows["total"].to_numpy()
        found = []
        for a in range(len(rows)):
            for b in range(a + 1, len(rows)):
                if low == high or member[a] // tile != member[b] // tile:
                    found.append((lang, member[a], member[b], *merged(ids[a], n[a], int(totals[a]), ids[b], n[b], int(totals[b]))))
        return pd.DataFrame(found, columns=["lang", "a", "b", "value", "terms"])

    return prices


def _share(count: str, total: str) -> Column:
    """``scaled_share`` of a column; null where the total is 0."""
    return F.expr(f"1 + (cast({count} as decimal(20, 0)) * {SCALE}) div nullif({total}, 0)")


def _price(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def source_divergence(docs: DataFrame, lang_column: str = "lang", source_column: str = "source", text_column: str = "text",
                      least_docs: int = 10, top: int = 10, tile: int = 8, block_terms: int = 16_384) -> DataFrame:
    """lang, source, part, item, value and rank: how far the word use of each (lang, source) is from others.

    A language keeps the V terms of at least ``least_docs`` of its documents.  A group with counts c, N in all, gives a term the share
    p = 1 + floor(10^9 (c + 2) / (N + 2V)), and two shares the price floor((p - q)^2 / (p + q)).  Part ``pair``: every other source of
    the language with the price of all kept terms.  Part ``term``: the ``top`` terms that the source uses more than its language does.

    Null languages, sources and texts count as ''.  Every row is a document, repeated rows and ids included.  Groups without terms are
    compared as well; a language without kept terms has the value 0 throughout; the only source of a language has no pairs.  An empty
    table gives no rows.  Other columns are not read.  Terms are dealt to blocks of about ``block_terms`` and sources to tiles of ``tile``, so
    a task holds 2 x tile arrays of a block, whatever the size of a source.
    """
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
                         for c, name in ((lang_column, "lang"), (source_column, "source"), (text_column, "text"))])
    # dealt by language and term once: counts per source, totals per language and the choice of terms all follow without moving rows
    of_term = Window.partitionBy("lang", "term")
    every = stored(
        rows.mapInArrow(_counted, "lang string, source string, term string, n long, docs long").repartition("lang", "term")
        .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        .withColumns({"lang_n": F.sum("n").over(of_term), "lang_docs": F.sum("docs").over(of_term)})
        .where((F.col("term") == "") | (F.col("lang_docs") >= least_docs)).select("lang", "source", "term", "n", "lang_n"), "counts")
    counts = every.where("term != ''")
    kept = stored(counts.groupBy("lang", "term").agg(F.max("lang_n").alias("lang_n")).select(
        "lang", "term", "lang_n", F.monotonically_increasing_id().alias("term_id")), "kept")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    own = stored(counts.join(kept.select("lang", "term", "term_id"), ["lang", "term"]), "own")
    member = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = stored(
        every.where("term = ''").select("lang", "source").join(own.groupBy("lang", "source").agg(F.sum("n").alias("sum")), ["lang", "source"], "left")
        .join(langs, "lang", "left").select(
            "lang", "source", member.alias("member"), F.coalesce("v", F.lit(0)).alias("v"),
            F.expr("coalesce(sum, 0) + 2 * coalesce(v, 0)").alias("total"), F.expr("coalesce(lang_total, 0) + 2 * coalesce(v, 0)").alias("lang_total")),
        "groups")  # one row per language and source

    with_group = own.join(groups, ["lang", "source"])
    p, q = _share("n + 2", "total"), _share("lang_n + 2", "lang_total")
    best = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    of_terms = (
        with_group.withColumns({"p": p, "q": q}).where("p > q").select("lang", "source", F.col("term").alias("item"), _price("p", "q").alias("value"))
        .withColumn("rank", best).where(F.col("rank") <= top).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))

    # every group has an array in every block, if only an empty one: what the other side has alone must be priced too
    blocks = F.ceil(F.col("v") / F.lit(block_terms))
    entries = F.array_sort(F.collect_list(F.struct("term_id", "n")))
    filled = with_group.withColumn("block", F.pmod(F.xxhash64("term_id"), blocks)).groupBy("lang", "block", "member").agg(entries.alias("terms"))
    places = groups.where("v > 0").select("lang", "member", "total", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block"))
    arrays = places.join(filled, ["lang", "block", "member"], "left").select(
        "lang", "block", "member", "total",
        *[F.coalesce(F.col(f"terms.{c}"), F.array().cast("array<long>")).alias(name) for c, name in (("term_id", "ids"), ("n", "n"))])
    tiles = groups.groupBy("lang").agg(F.floor(F.max("member") / F.lit(tile)).alias("last"))
    mine = F.floor(F.col("member") / F.lit(tile))
    dealt = arrays.join(tiles, "lang").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), "last"))).withColumns(
        {"low": F.least(mine, "other"), "high": F.greatest(mine, "other")})
    parts = dealt.groupBy("lang", "block", "low", "high").applyInPandas(
        _pair_tasks(tile), "lang string, a int, b int, value long, terms long").groupBy("lang", "a", "b").agg(
        F.sum("value").alias("seen"), F.sum("terms").alias("terms"))
    side = {x: groups.select("lang", "v", F.col("source").alias(f"source_{x}"), F.col("member").alias(x), F.col("total").alias(f"total_{x}"))
            for x in "ab"}
    pairs = side["a"].join(side["b"].drop("v"), "lang").where("a < b").join(parts, ["lang", "a", "b"], "left").withColumns(
        {"p": _share("2L", "total_a"), "q": _share("2L", "total_b")})
    absent = F.coalesce(_price("p", "q"), F.lit(0)) * (F.col("v") - F.coalesce("terms", F.lit(0)))
    both_ways = pairs.withColumn("value", F.coalesce("seen", F.lit(0)) + absent).select("lang", "value", F.explode(F.array(
        F.struct(F.col("source_a").alias("source"), F.col("source_b").alias("item")),
        F.struct(F.col("source_b").alias("source"), F.col("source_a").alias("item")))).alias("x"))
    of_pairs = both_ways.select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value").withColumn("rank", best)
    return of_pairs.unionByName(of_terms).select("lang", "source", "part", "item", F.col("value").cast("long").alias("value"), "rank")


DIVERGENCE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS (SELECT r, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM t GROUP BY ALL),
kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 10),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM kept GROUP BY lang),
own AS (SELECT c.* FROM c JOIN kept USING (lang, term)),
groups AS (SELECT g.lang, g.source, coalesce(l.v, 0) AS v, coalesce(s.n, 0)::HUGEINT + 2 * coalesce(l.v, 0) AS total, l.n + 2 * l.v AS lang_total
  FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN langs l USING (lang)
  LEFT JOIN (SELECT lang, source, sum(n) AS n FROM own GROUP BY ALL) s USING (lang, source)),
shares AS (SELECT g.lang, g.source, k.term, coalesce(o.n, 0) AS own_n, 1 + 1000000000 * (coalesce(o.n, 0) + 2) // g.total AS p,
  1 + 1000000000 * (k.n + 2) // g.lang_total AS q
  FROM groups g JOIN kept k USING (lang) LEFT JOIN own o USING (lang, source, term)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
all_pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0)::BIGINT AS value FROM groups a
  JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM shares WHERE own_n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
  FROM (SELECT * FROM all_pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

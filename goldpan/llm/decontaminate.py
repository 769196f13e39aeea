"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are joined on shared runs of words (seeds).  Where the seeds could cover enough of an item, the pair is
tiled: the longest matches of unmarked words are found with running Karp-Rabin hashes and marked, again and again, so passages count in
whatever order they stand.  The share of an item's words under tiles decides.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldpan.llm.words import plain_words

_BASE, _MODULUS = 1_000_003, (1 << 61) - 1


def _rolled(words: Sequence[int], free: list[bool], length: int) -> Iterator[tuple[int, int]]:
    """Start and running hash of every run of ``length`` unmarked words."""
    top = pow(_BASE, length, _MODULUS)
    value = run = 0
    for i, word in enumerate(words):
        if not free[i]:
            value = run = 0
            continue
        value = (value * _BASE + word + 2) % _MODULUS
        run += 1
        if run > length:
            value = (value - (words[i - length] + 2) * top) % _MODULUS
        if run >= length:
            yield i - length + 1, value


def tiles(pattern: Sequence[int], text: Sequence[int], least: int) -> list[tuple[int, int, int]]:
    """Non-overlapping matches (start in pattern, start in text, length) of at least ``least`` words, longest first.

    Negative words match nothing.
    """
    free_p, free_t = [w >= 0 for w in pattern], [w >= 0 for w in text]
    length = max(least, min(len(pattern), len(text)) // 2)
    found: list[tuple[int, int, int]] = []
    while True:
        places = defaultdict(list)
        for at, value in _rolled(text, free_t, length):
            places[value].append(at)
        matches = []
        for p, value in _rolled(pattern, free_p, length):
            for t in places.get(value, ()):
                n = 0
                while p + n < len(pattern) and t + n < len(text) and free_p[p + n] and free_t[t + n] and pattern[p + n] == text[t + n]:
                    n += 1
                if n >= length:  # else only the hashes were equal
                    matches.append((-n, p, t))
        marked = False
        for n, p, t in sorted(matches):
            n = -n
            if all(free_p[p:p + n]) and all(free_t[t:t + n]):
                free_p[p:p + n] = free_t[t:t + n] = [False] * n
                found.append((p, t, n))
                marked = True
        if marked:
            continue  # what a longer match has cut off may still hold a run of this length
        if length == least:
            return found
        length = max(least, length // 2)


@dataclass(frozen=True)
class Block:
    """A bounded part of the benchmark: items as word numbers, and where each seed stands."""

    items: tuple[tuple[int, tuple[int, ...]], ...]
    numbers: dict[str, int]
    seeds: dict[tuple[int, ...], tuple[tuple[int, int], ...]]
    seed_words: int

    @staticmethod
    def of(rows: Sequence[tuple[int, str]], seed_words: int) -> Block:
        numbers: dict[str, int] = {}
        items, seeds = [], defaultdict(list)
        for item_id, text in rows:
            words = tuple(numbers.setdefault(w, len(numbers)) for w in plain_words(text))
            if len(words) < seed_words:
                continue
            for at in range(len(words) - seed_words + 1):
                seeds[words[at:at + seed_words]].append((len(items), at))
            items.append((item_id, words))
        return Block(tuple(items), numbers, {k: tuple(v) for k, v in seeds.items()}, seed_words)

    def compare(self, text: str | None, threshold: float) -> list[tuple[int, float]]:
        """Items of which at least ``threshold`` is tiled in the text, with the share."""
        words = [self.numbers.get(w, -1) for w in plain_words(text)]
        k = self.seed_words
        known = np.array(words) >= 0
        if len(words) < k:
            return []
        # starts of runs of k words that all occur in the benchmark
        sums = np.concatenate([[0], np.cumsum(known)])
        covered: dict[int, set[int]] = defaultdict(set)  # item -> words of it under seeds
        places: dict[int, list[int]] = defaultdict(list)  # item -> seed starts in the text
        for at in np.flatnonzero(sums[k:] - sums[:-k] == k):
            for item, p in self.seeds.get(tuple(words[at:at + k]), ()):
                covered[item].update(range(p, p + k))
                places[item].append(int(at))
        result = []
        for item, under in covered.items():
            item_id, pattern = self.items[item]
            if len(under) < threshold * len(pattern):
                continue  # every tile is a run of seeds, so tiles cannot cover more
            part: list[int] = []  # the words of the text under this item's seeds, gaps as one word that matches nothing
            end = -1
            for at in sorted(set(places[item])):
                if at > end and part:
                    part.append(-1)
                part.extend(words[max(at, end):at + k])
                end = at + k
            share = sum(n for _, _, n in tiles(pattern, part, k)) / len(pattern)
            if share >= threshold:
                result.append((item_id, share))
        return result


def _compared_with(block: Broadcast[Block], threshold: float):
    @F.pandas_udf("array<struct<item:long,coverage:double>>")
    def compared(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"item": i, "coverage": c} for i, c in block.value.compare(t, threshold)] for t in texts], dtype="object")

    return compared


def find_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5, seed_words: int = 5, block_bytes: int = 16 << 20,
               id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text",
               carry: Sequence[str] = ()) -> DataFrame:
    """id, ``contaminated``, ``n_items``, ``item`` and ``coverage`` of the item covered most (ties: the smaller id), and carried columns.

    Words are compared without case and punctuation.  Items with fewer than ``seed_words`` words are too short to tell and are left out,
    as are null items; null, empty and short documents are clean.  The benchmark is laid against the documents in blocks of about
    ``block_bytes`` of text, so what a task holds is bounded whatever the benchmark's size; each row is judged by itself, so repeated rows
    and null ids need no care.
    """
    items = benchmark.select(F.col(item_column).cast("long").alias("i"), F.col(item_text).alias("t")).where(F.col("t").isNotNull())
    size = items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    n_blocks = max(1, -(-size // block_bytes))
    context = docs.sparkSession.sparkContext
    out = (id_column, "contaminated", "n_items", "item", "coverage")
    carried = [c for c in carry if c not in out]
    frame = docs.select(F.col(id_column), F.col(text_column).alias("_text"), *[F.col(c).alias(f"_c_{c}") for c in carried])
    hits = F.lit(None).cast("array<struct<item:long,coverage:double>>")
    for n in range(n_blocks):
        part = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n_blocks)) == n).collect()
        block = context.broadcast(Block.of(sorted(((r["i"], r["t"]) for r in part), key=lambda r: (r[0] is None, r[0] or 0, r[1])), seed_words))

        found = _compared_with(block, threshold)(F.col("_text"))
        hits = found if n == 0 else F.concat(hits, found)
    best = F.array_sort(
        "_hits", lambda a, b: F.when(a["coverage"] > b["coverage"], -1).when(a["coverage"] < b["coverage"], 1)
        .when(a["item"] < b["item"], -1).when(a["item"] > b["item"], 1).otherwise(0))
    judged = frame.withColumn("_hits", hits).withColumn("_best", F.get(best, F.lit(0)))
    return judged.select(
        id_column, (F.size("_hits") > 0).alias("contaminated"), F.size("_hits").cast("long").alias("n_items"),
        F.col("_best.item").alias("item"), F.coalesce(F.col("_best.coverage"), F.lit(0.0)).alias("coverage"),
        *[F.col(f"_c_{c}").alias(c) for c in carried])

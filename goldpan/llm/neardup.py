"""Near-duplicate classes by order min-hashing, verified by banded alignment.

A text is the sequence of its five-word shingles, each labelled with how often it has occurred before.  A sketch takes the few
labelled shingles with the smallest hashes and keeps them in text order, so two texts share a sketch only if they share these
shingles in the same order: that follows the edit similarity, not only the sets.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from goldpan.llm.components import components
from goldpan.llm.shared import stored
from goldpan.llm.words import mixed, plain_words, run_hashes, word_hashes


_SPREAD = np.uint64(0xE7037ED1A0B428DB)
_HASHES_AT_ONCE = 1 << 16  # all sketches of a short text in one array; those of a long one in several
_SLICE_LETTERS = 1 << 20  # texts of so many letters are worked on at once


@dataclass(frozen=True)
class Settings:
    """With 6 shingles a sketch, two long texts of similarity 0.8 share one of 32 with probability 0.99994, and those just above
    ``short`` with at least 0.99989.  Two texts of ``short`` shingles at most always share a key, as they have their prefixes as keys as well.
    """

    shingle_words: int = 5
    similarity: float = 0.8
    sketches: int = 32
    per_sketch: int = 6
    short: int = 75  # so every pair of similarity 0.8 in which one text has 60 shingles at most
    centres: int = 4
    partners: int = 4  # centres that a member is compared with in the first round
    # the same in later rounds, where few buckets are left and only members of the class with the greater root ask
    later_centres: int = 32
    later_partners: int = 16
    later_names: int = 4  # buckets that have to name a centre for it, or all if the member has fewer


def _words(text: str | None) -> list[str]:
    """The words, or where there are only signs, their runs."""
    return plain_words(text) or (text.split() if text else [])


def _digest(words: list[str]) -> int:
    return int.from_bytes(hashlib.md5(" ".join(words).encode("utf-8", "surrogatepass")).digest()[:8], "little", signed=True)


def shingles(text: str | None, length: int) -> tuple[int | None, np.ndarray]:
    """A 64-bit digest of the words, and the hashes of the occurrence-labelled shingles; a text of fewer words is one shingle."""
    words = _words(text)
    if not words:
        return None, np.empty(0, np.uint64)
    hashes = word_hashes(words)
    runs = run_hashes(hashes, min(length, len(hashes)))
    order = np.argsort(runs, kind="stable")
    same = np.concatenate([[False], runs[order][1:] == runs[order][:-1]])
    if same.any():
        # occurrence number: distance to the first of the equal ones in sorted order
        at = np.arange(len(runs))
        first = np.maximum.accumulate(np.where(same, 0, at))
        label = np.empty(len(runs), np.uint64)
        label[order] = (at - first).astype(np.uint64)
        runs = mixed(runs + label * np.uint64(0xD6E8FEB86659FD93))
    return _digest(words), runs


def sketches(runs: np.ndarray, count: int, size: int) -> list[int]:
    """One key per sketch: the ``size`` shingles with the smallest hashes under its own hash function, in text order."""
    k = np.arange(count, dtype=np.uint64)[:, None]
    flips = (k + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    factors = (k * np.uint64(0xD6E8FEB86659FD92) + np.uint64(0xA0761D6478BD642F)) | np.uint64(1)
    at_once = max(1, _HASHES_AT_ONCE // max(1, len(runs)))
    keys: list[int] = []
    for low in range(0, count, at_once):
        h = (runs ^ flips[low:low + at_once]) * factors[low:low + at_once]
        h ^= h >> np.uint64(32)
        h *= _SPREAD
        if h.shape[1] > size:
            least = np.sort(np.argpartition(h, size, axis=1)[:, :size], axis=1)
            h = np.take_along_axis(h, least, axis=1)
        width = h.shape[1]
        keys += run_hashes(h.ravel(), width)[::width].view(np.int64).tolist()
    return keys


def needed(size: int, least: float) -> int:
    """The smallest whole number that is not below ``least`` x ``size``, as a fraction and so without rounding."""
    p = Fraction(least).limit_denominator(1000)
    return -(-p.numerator * size // p.denominator)


def prefix_keys(runs: np.ndarray, least: float) -> list[int]:
    """The smallest hashes of the shingles: two texts of similarity ``least`` have one of them in common."""
    return np.sort(runs)[:len(runs) - needed(len(runs), least) + 1].view(np.int64).tolist()


def similar(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    """Whether the best alignment has at least ``least`` of all shingles in common: L / (|a| + |b| - L).

    Labelled shingles are unique within a text, so the alignment is the longest rising run of positions in ``b``.  Pairs outside the
    band that so many common shingles allow are left out; they cannot be part of such an alignment.
    """
    p = Fraction(least).limit_denominator(1000)
    need = -(-p.numerator * (len(a) + len(b)) // (p.numerator + p.denominator))
    if min(len(a), len(b)) < need:
        return False
    _, at, to = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    order = np.argsort(at)
    at, to = at[order], to[order]
    band = len(a) + len(b) - 2 * need
    to = to[np.abs(at - to) <= band]
    if len(to) < need:
        return False
    if (to[1:] > to[:-1]).all():
        return True
    tails: list[int] = []
    for place in to.tolist():
        k = bisect_left(tails, place)
        tails[k:k + 1] = [place]
    return len(tails) >= need


def _slices(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """A batch in parts of bounded length, so that the arrays of a whole batch are never held together."""
    part = np.cumsum([len(t) if t else 0 for t in batch["text"]]) // _SLICE_LETTERS
    for k in np.unique(part):
        yield batch[part == k]


def _sketched(s: Settings):
    def keys(runs: np.ndarray) -> list[int] | None:
        if not len(runs):
            return None
        return sketches(runs, s.sketches, s.per_sketch) + (prefix_keys(runs, s.similarity) if len(runs) <= s.short else [])

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for some in _slices(batch):
                found = [shingles(t, s.shingle_words) for t in some["text"]]
                yield pd.DataFrame({"id": some["id"], "content": pd.array([c for c, _ in found], dtype="Int64"),
                                    "prints": [keys(runs) for _, runs in found]})

    return made


def _shingled(s: Settings):
    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for some in _slices(batch):
                found = [shingles(t, s.shingle_words) for t in some["text"]]
                # 32 bits are enough to align two texts by
                yield pd.DataFrame([(c, runs.astype(np.uint32).view(np.int32)) for c, runs in found if c is not None], columns=["content", "runs"])

    return made


def _verified(s: Settings):
    def kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good = [similar(np.asarray(x), np.asarray(y), s.similarity)
                    for x, y in zip(batch["runs_a"], batch["runs_b"], strict=True)]
            yield batch.loc[good, ["a", "b"]]

    return kept


def _partners(first: bool, most: int, least: int):
    @F.pandas_udf("array<struct<centre:long,its_root:long>>")
    def chosen(root: pd.Series, asked: pd.Series, buckets: pd.Series, centres: pd.Series, roots: pd.Series) -> pd.Series:
        """Of the centres in other classes, not asked before, those that most buckets name, ``least`` of them or all; ties to the smaller."""
        found = []
        for own, before, own_buckets, c, r in zip(root, asked, buckets, centres, roots, strict=True):
            c, r = np.asarray(c, np.int64), np.asarray(r, np.int64)
            new = (r != own if first else r < own) & ~np.isin(c, np.asarray(before, np.int64))
            names, at, counts = np.unique(c[new], return_index=True, return_counts=True)
            best = np.lexsort((names, -counts))[:min(most, np.count_nonzero(counts >= min(least, own_buckets)))]
            found.append([{"centre": int(names[k]), "its_root": int(r[new][at[k]])} for k in best])
        return pd.Series(found, dtype="object")

    return chosen


def met_centres(front: DataFrame, n: int, s: Settings) -> DataFrame:
    """The rows of ``front`` that still share a bucket with another class, with these buckets as ``keys`` and the ``partners`` of round ``n``.

    ``front`` has one row per content: content, root, asked and keys (array of sketch and key).  Centres are minima, combined before the
    shuffle and handed back by a join, which splits hot buckets; a content gets at most one list of centres from each of its sketches.
    After the first round each pair of classes is looked at from one side: the root is the smallest digest, so it is mostly the smaller
    class that asks, and the smallest root of the bucket is one more centre.
    """
    count = s.later_centres if n else s.centres
    nothing = F.array().cast("array<long>")
    placed = front.select("content", "root", F.explode("keys").alias("k")).select("content", "root", "k.sketch", "k.key")
    # the hash of one number is one-to-one, so there are no ties and both minima are of the same row
    ranks = [F.xxhash64(F.lit(n * s.later_centres + c), "content") for c in range(count)]
    centres = placed.groupBy("sketch", "key").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.array(*[F.min_by("content", r) for r in ranks]).alias("centres"),
        F.array(*[F.min_by("root", r) for r in ranks]).alias("roots")).where("low != high")
    if n > 0:
        centres = centres.withColumns({"centres": F.array_append("centres", F.col("low")), "roots": F.array_append("roots", F.col("low"))})
    asks = F.lit(True) if n == 0 else F.col("root") > F.col("low")
    met = placed.join(centres, ["sketch", "key"]).groupBy("content").agg(F.collect_list(F.struct(
        "sketch", "key", F.when(asks, F.col("centres")).otherwise(nothing).alias("centres"),
        F.when(asks, F.col("roots")).otherwise(nothing).alias("roots"))).alias("met"))
    partners = _partners(n == 0, s.later_partners if n else s.partners, s.later_names if n else 1)
    joined = met.join(front.select("content", "root", "asked"), "content").withColumn(
        "partners", partners("root", "asked", F.size("met"), F.flatten("met.centres"), F.flatten("met.roots")))
    return joined.select(
        "content", "root", "partners", F.concat("asked", "partners.centre").alias("asked"),
        F.transform("met", lambda m: F.struct(m["sketch"], m["key"])).alias("keys"))


def relabelled(rows: DataFrame, moves: DataFrame) -> DataFrame:
    """``rows`` with every ``root`` that ``moves`` lists as a node replaced by its new root."""
    to = moves.select(F.col("node").alias("root"), F.col("root").alias("new_root"))
    return rows.join(to, "root", "left").withColumn("root", F.coalesce("new_root", "root")).drop("new_root")


def shared_prefixes(rows: DataFrame, s: Settings) -> DataFrame:
    """The shingles by which the contents in ``rows`` (content, root, runs) can meet another class.

    content, root, size, shingle and place.  Shingles that occur in one class alone come first and meet nothing, so only their number is
    kept.  The others follow by the number of texts that have them, counted exactly, and then by hash.  Of n shingles all but the
    least x n - 1 last ones are the prefix, which has one in common with that of every similar text.
    """
    p = Fraction(s.similarity).limit_denominator(1000)
    size = F.size("runs").cast("long")
    kept = size - F.ceil(size * F.lit(p.numerator) / F.lit(p.denominator)) + 1
    entries = rows.withColumn("own", F.array_distinct("runs")).select(
        "content", "root", size.alias("size"), kept.alias("kept"), F.size("own").alias("different"), F.explode("own").alias("shingle"))
    several = entries.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high")).where(
        "low != high").select("shingle", "n")
    met = entries.join(several, "shingle")
    # at most as many rows as the text has shingles
    of_content = Window.partitionBy("content")
    alone = F.col("different") - F.count(F.lit(1)).over(of_content)
    place = alone + F.row_number().over(of_content.orderBy("n", "shingle")) - 1
    return met.withColumn("place", place).where(F.col("place") < F.col("kept")).select("content", "root", "size", "shingle", "place")


def open_links(front: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """All links (a, b: roots) between the contents of ``front`` that are in different classes; no pair is left out by a limit.

    Prefix filter: two similar texts have a shingle in common among the rarest of each, and from the first such one on enough are left of
    both.  Texts whose lengths cannot be similar are in no common length class, so they do not meet.  Each pair is verified once.
    """
    rows = front.select("content", "root").join(texts, "content")
    placed = stored(shared_prefixes(rows, s), "prefixes")
    p = Fraction(s.similarity).limit_denominator(1000)
    # lengths that differ by less than the similarity allows lie in the same class or in neighbouring ones
    grade = F.floor(F.log(F.col("size").cast("double")) / F.lit(-math.log(s.similarity)) + F.lit(1e-9)).cast("int")
    graded = placed.withColumn("grade", grade)
    left = graded.withColumn("grade", F.explode(F.array(F.col("grade") - 1, F.col("grade"), F.col("grade") + 1)))
    side = {x: frame.select("shingle", "grade", *[F.col(c).alias(f"{c}_{x}") for c in ("content", "root", "size", "place")])
            for x, frame in (("a", left), ("b", graded))}
    rest = F.least(F.col("size_a") - F.col("place_a"), F.col("size_b") - F.col("place_b"))
    pairs = (
        side["a"].join(side["b"], ["shingle", "grade"])
        .where((F.col("root_a") < F.col("root_b")) & (rest * F.lit(p.numerator + p.denominator) >= (F.col("size_a") + F.col("size_b")) * F.lit(p.numerator)))
        .select("content_a", "content_b", "root_a", "root_b").distinct()
    )
    return verified(stored(pairs, "pairs"), texts, s)


def verified(pairs: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """Roots (a, b) of the pairs (content_a, content_b, root_a, root_b) whose texts are similar."""
    with_texts = (
        pairs.join(texts.select(F.col("content").alias("content_a"), F.col("runs").alias("runs_a")), "content_a")
        .join(texts.select(F.col("content").alias("content_b"), F.col("runs").alias("runs_b")), "content_b")
    )
    return stored(with_texts.select(F.col("root_a").alias("a"), F.col("root_b").alias("b"), "runs_a", "runs_b")
                  .mapInPandas(_verified(s), "a long, b long"), "found")


def linked_classes(contents: DataFrame, texts_of: Callable[[DataFrame], DataFrame], s: Settings) -> list[DataFrame]:
    """Moves of roots (node, root), one table per round, to be applied in turn: the classes that verified links form.

    ``contents`` has content and prints (one key per sketch, then prefix keys of a short text, in buckets of their own); ``texts_of`` gives content and runs of the contents in a table.  In every
    bucket each member is compared with a few centres.  Centres are the contents first by digests of their own, so a centre turns up in all
    buckets of its neighbours.  Buckets whose members are in several classes by then go on with other centres.  These rounds only make the
    classes large: what is open after them, pairs that share a bucket and are in different classes, is finished by ``open_links``.  A class
    left apart costs it as many pairs as the class it belongs to has members, so the rounds go on while the moves of a round times the members
    of the largest class are more than the pairs that the round compared.  Links are kept between classes, so later rounds are as small as what
    they find.
    """
    front = contents.select(
        "content", F.col("content").alias("root"), F.array().cast("array<long>").alias("asked"),
        F.transform("prints", lambda p, k: F.struct(F.least(k, F.lit(s.sketches)).alias("sketch"), p.alias("key"))).alias("keys"))
    moves: list[DataFrame] = []
    texts = None
    while True:
        front = stored(met_centres(front, len(moves), s), "front")
        if texts is None:
            texts = stored(texts_of(front.select("content")), "shingles")
        pairs = front.select("content", "root", F.explode("partners").alias("p")).select(
            F.col("content").alias("content_a"), F.col("p.centre").alias("content_b"),
            F.col("root").alias("root_a"), F.col("p.its_root").alias("root_b"))
        found = verified(pairs, texts, s)
        if found.isEmpty():
            break
        moves.append(components(found))
        compared = front.agg(F.sum(F.size("partners"))).first()[0]
        front = relabelled(front, moves[-1])
        largest = front.groupBy("root").count().agg(F.max("count")).first()[0]
        if moves[-1].count() * largest <= compared:
            break
    rest = open_links(front, texts, s)
    return moves if rest.isEmpty() else [*moves, components(rest)]


def text_digest(text: str | None) -> int | None:
    """The digest by which texts with the same words are one; null for a text without words."""
    words = _words(text)
    return _digest(words) if words else None


@F.pandas_udf(LongType())
def content_digest(texts: pd.Series) -> pd.Series:
    return pd.Series([text_digest(t) for t in texts], dtype="Int64")


def _classified(rows: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """``prints`` (id, content) of all rows, and per content its smallest id, number of copies and class (root)."""
    prints = stored(rows.mapInPandas(_sketched(s), "id long, content long, prints array<long>"), "prints")
    contents = stored(
        prints.where(F.col("content").isNotNull()).groupBy("content")
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"), F.first("prints").alias("prints")), "contents")

    def texts_of(wanted: DataFrame) -> DataFrame:
        needed = contents.select("content", F.col("first").alias("needed")).join(wanted, "content", "left_semi").select("needed")
        owners = rows.join(needed, F.col("id").eqNullSafe(F.col("needed")), "left_semi")
        return owners.select("text").mapInPandas(_shingled(s), "content long, runs array<int>").dropDuplicates(["content"])

    per_content = contents.select("content", "first", "copies", F.col("content").alias("root"))
    for moved in linked_classes(contents.select("content", "prints"), texts_of, s):
        per_content = relabelled(per_content, moved)
    return prints, per_content


def class_firsts(docs: DataFrame, settings: Settings = Settings(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id and ``content`` (``content_digest``) of one text per class of near duplicates: the one with the smallest id, then digest.

    Id and content together name a text, also where rows with different texts share an id.  Texts without words are in no class.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    _, per_content = _classified(rows, settings)
    first = F.min(F.struct(F.col("first").isNull().alias("none"), "first", "content"))  # a null id comes last
    return per_content.groupBy("root").agg(first.alias("f")).select(F.col("f.first").alias(id_column), "f.content")


def near_duplicate_classes(docs: DataFrame, settings: Settings = Settings(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, ``class_id`` and ``class_size`` of every row; ``class_id`` is the smallest id of the class.

    Two texts are linked if their shingle sequences, over lower-case words without punctuation, align with similarity of at least 0.8;
    classes are what links connect.  Texts with the same words are one class member however often they occur.  Null, empty and blank
    texts are linked to nothing: each is its own class, with its own id.  A class all of whose ids are null has the id null.  Repeated rows
    give repeated results.  Other columns are not read.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    prints, per_content = _classified(rows, settings)
    classes = per_content.groupBy("root").agg(F.min("first").alias("class_id"), F.sum("copies").alias("class_size"))
    labelled = per_content.join(classes, "root").select("content", "class_id", "class_size")
    alone = F.col("content").isNull()
    return prints.select("id", "content").join(labelled, "content", "left").select(
        F.col("id").alias(id_column), F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.lit(1)).otherwise(F.col("class_size")).cast("long").alias("class_size"))

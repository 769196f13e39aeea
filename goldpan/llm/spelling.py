"""Spelling variants: words at exactly one inserted, deleted or replaced letter, by pairs of trie nodes.

The nodes of a trie over the words (their prefixes) and of one over the reversed words (their suffixes) are numbered.  Leaving out the
letter at one place of a word gives a pair (prefix node, suffix node), standing between two letters gives another.  Two words that skip
a place each and have the same pair differ by a replaced letter; one that skips a place and one that stands between two letters there
differ by an inserted one.  The pair stands for exact strings, so nothing has to be compared afterwards.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goldpan.llm.shared import stored

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_FLUSH = 200_000  # words in a task's table of counts; more are handed on and counted again later

GAP, SKIP, SKIP_AGAIN = 0, 1, 2  # between two letters; past the first letter of a run of equal ones; past another letter of such a run


def _counted(least_length: int, every: int):
    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: Counter = Counter()

        def handed() -> pd.DataFrame:
            out = pd.DataFrame(list(totals.items()), columns=["word", "n"])
            totals.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch["id"], batch["text"], strict=True):
                start = zlib.crc32(f"{doc or ''}:".encode())
                # only A-Z become small letters; that moves no border of a run
                lowered = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass")
                for word, n in Counter(_RUN.findall(lowered)).items():
                    if len(word) >= least_length:
                        h = zlib.crc32(word.encode(), start)
                        if h % every == 0:
                            place = h % len(word)
                            word = word[:place] + word[place + 1:]
                            if len(word) < least_length:
                                continue
                        totals[word] += n
                if len(totals) > _FLUSH:
                    yield handed()
        if totals:
            yield handed()

    return made


def counted_words(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least_length: int = 5, least_n: int = 3,
                  every: int = 97) -> DataFrame:
    """word and n.  A run of letters whose crc32 with its document's id is divisible by ``every`` loses one letter."""
    rows = docs.select(F.col(id_column).cast("string").alias("id"), F.col(text_column).alias("text"))
    return rows.mapInPandas(_counted(least_length, every), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(
        F.col("n") >= least_n)


def common(a: str, b: str) -> int:
    """Length of the common beginning."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] is common, a[:high] is not
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle)
    return low


def _trie(rows: pd.DataFrame) -> pd.DataFrame:
    """Nodes on the path of every word of a range, numbered from 1 as they turn up in sorted order; the root is 0."""
    rows = rows.sort_values("word", kind="stable")
    paths, before, path, nodes = [], "", [0], 0
    for word in rows["word"]:
        shared = common(before, word)
        path = path[:shared + 1] + list(range(nodes + 1, nodes + len(word) - shared + 1))
        nodes += len(word) - shared
        before = word
        paths.append(path)
    return pd.DataFrame({"range": rows["range"], "word": rows["word"], "id": rows["id"], "place": np.arange(len(rows)), "path": paths,
                         "nodes": nodes, "rows": len(rows)})


def numbered_trie(words: DataFrame, range_words: int, name: str) -> DataFrame:
    """``words`` (word, id) with ``place``, its number in sorted order, and ``path``, the numbers of the nodes from the root to it.

    Sorted ranges are numbered by themselves.  The first word of a range continues the last one of the range before, so the nodes they
    share are renamed and the others shifted; that takes the first and last word of each range, which is all that the driver sees.
    """
    spark = words.sparkSession
    ranges = max(1, -(-words.count() // range_words))
    dealt = words.repartitionByRange(ranges, "word").withColumn("range", F.spark_partition_id())
    schema = "range int, word string, id long, place long, path array<long>, nodes long, rows long"
    local = stored(stored(dealt, f"{name}_ranges").groupBy("range").applyInPandas(_trie, schema), f"{name}_local")
    ends = local.where("place = 0 or place = rows - 1").orderBy("range", "place").collect()
    known, nodes, places = [], 0, 0
    before, path = "", [0]
    for k, row in enumerate(ends):
        if row["place"] == 0:
            shared = common(before, row["word"])
            inherited, shift = path[:shared + 1], nodes - shared
            known.append((row["range"], inherited, shift, places))
            nodes, places = nodes + row["nodes"] - shared, places + row["rows"]
        if k + 1 == len(ends) or ends[k + 1]["range"] != row["range"]:
            before, path = row["word"], [inherited[x] if x < len(inherited) else x + shift for x in row["path"]]
    moved = spark.createDataFrame(known, "range int, inherited array<long>, shift long, offset long")
    return local.join(moved, "range").select(
        "word", "id", (F.col("place") + F.col("offset")).alias("place"),
        F.transform("path", lambda x: F.when(x < F.size("inherited"), F.get("inherited", x.cast("int"))).otherwise(x + F.col("shift"))).alias("path"))


def _node_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every place of every word: prefix node, suffix node, id, n and kind."""
    for batch in batches:
        slices = np.cumsum(batch["word"].str.len().to_numpy()) >> 18  # so many letters at once
        for _, some in batch.groupby(slices, sort=False):
            lengths = some["word"].str.len().to_numpy().astype(np.int64)
            forward, backward = (np.concatenate([np.asarray(p, np.int64) for p in some[c]]) for c in ("path", "back"))
            letters = np.frombuffer("".join(some["word"]).encode("utf-32-le"), np.uint32)
            base = np.cumsum(lengths + 1) - lengths - 1  # where the path of each word begins
            which = np.repeat(np.arange(len(some)), lengths)
            at = np.arange(len(letters)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            again = (at > 0) & (letters == np.concatenate([letters[:1], letters[:-1]]))
            gap_which = np.repeat(np.arange(len(some)), lengths + 1)
            gap_at = np.arange(len(forward)) - base[gap_which]
            word = np.concatenate([which, gap_which])
            yield pd.DataFrame({
                "prefix": np.concatenate([forward[base[which] + at], forward]),
                "suffix": np.concatenate([backward[base[which] + lengths[which] - 1 - at], backward[base[gap_which] + lengths[gap_which] - gap_at]]),
                "id": some["id"].to_numpy()[word], "n": some["n"].to_numpy()[word],
                "kind": np.concatenate([np.where(again, SKIP_AGAIN, SKIP), np.full(len(gap_which), GAP)]).astype(np.int8)})


def near_words(words: DataFrame, range_words: int = 20_000) -> DataFrame:
    """id (number in code-point order), word, n, n_near and best (n and id of the near word with the largest n; null without one).

    ``words`` has distinct words and n.  A pair of nodes is shared by at most as many words as there are letters, so no group is large.
    """
    words = stored(words.select("word", "n", F.monotonically_increasing_id().alias("id")), "words")
    forward = numbered_trie(words.select("word", "id"), range_words, "forward")
    back = numbered_trie(words.select(F.reverse("word").alias("word"), "id"), range_words, "back").select("id", F.col("path").alias("back"))
    pathed = stored(forward.join(words.select("id", "n"), "id").join(back, "id").select(F.col("place").alias("id"), "word", "n", "path", "back"), "paths")
    pairs = pathed.mapInPandas(_node_pairs, "prefix long, suffix long, id long, n long, kind byte")
    # a larger n is better, then a smaller id
    member = F.struct("n", (-F.col("id")).alias("less"), "kind")
    together = pairs.withColumn("met", F.collect_list(member).over(Window.partitionBy("prefix", "suffix"))).where(F.size("met") > 1)
    # a letter more in a run of equal letters is one insertion, told at the run's first letter
    others = F.filter("met", lambda o: (o["less"] != -F.col("id")) & ((o["kind"] == F.col("kind")) | (o["kind"] + F.col("kind") != GAP + SKIP_AGAIN)))
    found = together.select("id", others.alias("near")).where(F.size("near") > 0).select(
        "id", F.size("near").alias("n_near"), F.array_max(F.transform("near", lambda o: F.struct(o["n"].alias("n"), o["less"].alias("less")))).alias("best"))
    per_word = found.groupBy("id").agg(F.sum("n_near").alias("n_near"), F.max("best").alias("best"))
    return pathed.select("id", "word", "n").join(per_word, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("best").isNotNull(), F.struct(F.col("best.n").alias("n"), (-F.col("best.less")).alias("id"))).alias("best"))


def followed(links: DataFrame) -> DataFrame:
    """``links`` (id, to) without cycles, each followed to its end by doubling: as many rounds as the longest chain has binary digits."""
    links = stored(links, "links")
    while True:
        step = links.select(F.col("id").alias("to"), F.col("to").alias("next"))
        further = stored(links.join(step, "to", "left").select("id", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")), "links")
        links = further.select("id", "to")
        if further.where("moved").isEmpty():
            return links


def group_variants(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least_length: int = 5, least_n: int = 3,
                   every: int = 97, factor: int = 2, range_words: int = 20_000) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of at least ``least_length`` letters and ``least_n`` occurrences.

    Words are near if they differ by exactly one inserted, deleted or replaced letter.  The form of a word is its near word with the
    largest n, the smallest in code-point order among equals, if that n is at least ``factor`` times its own; the root is where following
    forms ends.  Null and empty texts have no words, a null id counts as an empty one, a repeated row counts again; an empty table, or one
    without words, gives no rows.  Words may be of any length.  Other columns are not read.
    """
    words = stored(near_words(counted_words(docs, id_column, text_column, least_length, least_n, every), range_words), "near")
    links = stored(words.where(F.col("best.n") >= F.lit(factor) * F.col("n")).select("id", F.col("best.id").alias("to"), F.col("best.n").alias("form_n")), "forms")
    names = words.select(F.col("id").alias("to"), F.col("word").alias("name"))
    forms = links.join(names, "to").select("id", F.col("name").alias("form"), "form_n")
    roots = followed(links.select("id", "to")).join(names, "to").select("id", F.col("name").alias("root"))
    return words.join(forms, "id", "left").join(roots, "id", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


VARIANTS_SQL = r"""
WITH RECURSIVE runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS doc, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents WHERE text IS NOT NULL),
counted AS (SELECT doc, run, count(*) AS n FROM runs WHERE length(run) >= 5 GROUP BY ALL),
crc_table AS (SELECT list(list_reduce(range(8), lambda c, step: xor(c >> 1, 3988292384 * (c & 1)), b) ORDER BY b) AS crc
  FROM range(256) t(b)),
hashed AS (SELECT run, n, xor(4294967295, list_reduce(list_transform(range(octet_length(encode(doc || ':' || run))),
    lambda i: ('0x' || substr(hex(encode(doc || ':' || run)), 2 * i + 1, 2))::BIGINT),
    lambda c, b: xor(crc[xor(c & 255, b) + 1], c >> 8), 4294967295::BIGINT)) AS h FROM counted, crc_table),
changed AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM changed WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
skips AS (SELECT word, n, substr(word, 1, i::BIGINT) AS pre, substr(word, i::BIGINT + 2) AS post FROM words, LATERAL (SELECT unnest(range(length(word)))) t(i)),
gaps AS (SELECT word, n, substr(word, 1, i::BIGINT) AS pre, substr(word, i::BIGINT + 1) AS post FROM words, LATERAL (SELECT unnest(range(length(word) + 1))) t(i)),
one_way AS (SELECT a.word, b.word AS near, b.n AS near_n FROM skips a JOIN skips b ON a.pre = b.pre AND a.post = b.post AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM skips a JOIN gaps b ON a.pre = b.pre AND a.post = b.post
  UNION SELECT b.word, a.word, a.n FROM skips a JOIN gaps b ON a.pre = b.pre AND a.post = b.post),
best AS (SELECT word, count(*) AS n_near, (list(near ORDER BY near_n DESC, near))[1] AS near, max(near_n) AS near_n FROM one_way GROUP BY word),
formed AS (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.near_n >= 2 * w.n THEN b.near END AS form,
  CASE WHEN b.near_n >= 2 * w.n THEN b.near_n END AS form_n FROM words w LEFT JOIN best b USING (word)),
chain AS (SELECT word, word AS root, 0 AS steps FROM formed
  UNION ALL SELECT c.word, f.form, c.steps + 1 FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL),
ends AS (SELECT word, (list(root ORDER BY steps DESC))[1] AS root FROM chain GROUP BY word)
SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n FROM formed f JOIN ends e USING (word)
"""

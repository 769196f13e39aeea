"""Token counts by byte-pair merging, without producing identifiers."""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Callable, Iterator
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The contractions that byte-level BPE vocabularies of this kind keep apart, and Unicode's white space.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
DEAD = 1 << 31  # a symbol that was merged into the one before it; part of no pair
WHITE_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


@cache
def rare_numbers() -> frozenset[str]:
    """Numbers that are no decimal digits, such as fractions and Roman numerals."""
    return frozenset(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) in ("No", "Nl"))


@cache
def word_pattern(numbers: str = "") -> re.Pattern[str]:
    """Letters, numbers or other signs, each with at most one space before them; contractions; white space.

    ``\\w`` without ``\\d`` and the underscore is letters and rare numbers; the latter are passed for texts that have any.
    """
    return re.compile(
        rf" ?[^\W\d_{numbers}]+|{'|'.join(CONTRACTIONS)}| ?[\d{numbers}]+| ?(?:[^\w{WHITE_SPACE}]|_)+|[{WHITE_SPACE}]+(?![^{WHITE_SPACE}])|[{WHITE_SPACE}]+"
    )


def split_words(text: str) -> list[str]:
    rare = "" if text.isascii() or rare_numbers().isdisjoint(text) else "".join(sorted(rare_numbers().intersection(text)))
    return word_pattern(rare).findall(text)


def _byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next one from 256 on."""
    printable = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)}
    spare = iter(range(256, 512))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


class _Counts(dict):
    """Counts of words already seen; emptied when full, and long words are not kept."""

    WORDS, LONGEST = 800_000, 64

    def __init__(self, pieces: Callable[[str], int]) -> None:
        super().__init__()
        self.pieces = pieces

    def __missing__(self, word: str) -> int:
        n = self.pieces(word)
        if len(word) <= self.LONGEST:
            if len(self) >= self.WORDS:
                self.clear()
            self[word] = n
        return n


class MergeCounter:
    """Counts the pieces that remain of a word after all merges.

    A word is a doubly linked list of symbols; a heap holds the ranks of adjacent pairs.  The lowest rank (leftmost on ties)
    is merged until no known pair is left.  Only the number of merges is needed, so pieces are never looked up.
    """

    def __init__(self, definition: str) -> None:
        parsed = json.loads(definition)
        model, split = parsed["model"], parsed.get("pre_tokenizer") or {}
        unsupported = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix") if model.get(k)]
        if model["type"] != "BPE" or model.get("ignore_merges") or unsupported or parsed.get("normalizer") or \
                split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
            raise ValueError("only plain byte-level BPE definitions are supported")
        symbols: dict[str, int] = {c: b for b, c in enumerate(_byte_alphabet())}
        self.pairs: dict[int, tuple[int, int]] = {}  # both symbols in one number -> (rank, merged symbol)
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            merged = symbols.setdefault(left + right, len(symbols))
            self.pairs.setdefault(symbols[left] << 32 | symbols[right], (rank, merged))
        added = sorted((t["content"] for t in parsed.get("added_tokens", [])), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.counts = _Counts(self.pieces)

    def pieces(self, word: str) -> int:
        symbols = list(word.encode("utf-8", "surrogatepass"))
        n = len(symbols)
        if n < 2:
            return n
        known = self.pairs.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []  # rank, place, merged symbol: the lowest rank comes first, the leftmost place on ties
        for i in range(n - 1):
            if pair := known(symbols[i] << 32 | symbols[i + 1]):
                heap.append((pair[0], i, pair))
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            # an entry is stale if either symbol has changed since it was pushed
            if j >= n or known(symbols[i] << 32 | symbols[j]) is not pair:
                continue
            k, merged = after[j], pair[1]
            symbols[i], symbols[j], after[i] = merged, DEAD, k
            if k < n:
                before[k] = i
                if pair := known(merged << 32 | symbols[k]):
                    heapq.heappush(heap, (pair[0], i, pair))
            h = before[i]
            if h >= 0 and (pair := known(symbols[h] << 32 | merged)):
                heapq.heappush(heap, (pair[0], h, pair))
            merges += 1
        return n - merges

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        parts, total = [text], 0
        if self.added is not None and self.added.search(text):  # an added token inside a text is one token, and splits it
            parts = self.added.split(text)
            total = len(parts) - 1
        for part in parts:
            total += sum(map(self.counts.__getitem__, split_words(part)))
        return total


def token_count(definition_path: str, text: str | Column = "text") -> Column:
    """Number of tokens of a text column under the vocabulary file; null and empty texts have 0.

    The file is read on the driver (its size is that of one vocabulary) and shipped with the function.
    """
    with open(definition_path, encoding="utf-8") as file:
        definition = file.read()

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = MergeCounter(definition)
        for texts in batches:
            yield pd.Series([counter.count(t) for t in texts], dtype="int64")

    return counted(F.col(text) if isinstance(text, str) else text)


def token_counts(docs: DataFrame, definition_path: str, limit: int = 512, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Bytes, tokens and whether the limit is passed, for every row.

    Only the id and the text are read, so further columns of any name do not matter; repeated rows are counted each.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    return (
        docs.select(F.col(id_column), F.octet_length(text).cast("long").alias("n_bytes"), token_count(definition_path, text).alias("n_tokens"))
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )

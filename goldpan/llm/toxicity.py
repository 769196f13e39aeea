"""Toxicity scores: a lexicon trie crossed with Levenshtein automata, and windows that tell quotation from abuse.

The lexicon is learned: words far more frequent in toxic than in clean labelled texts.  Misspelled forms are found by running a word through
the product of the trie and a Levenshtein automaton, built state by state as words need it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldpan.functions.hashing import digest

# Signs that open or close a quotation, and words that report somebody's wording.
QUOTES = frozenset('"“”„«»')
REPORTING = frozenset(
    "said says saying called calls quote quoted quotes word words term terms wrote reported dit mot mots terme sagte sagt wort wörter zitat dijo"
    " palabra palabras término".split()
)
_TOKEN = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Settings:
    """``labelled_rows`` and ``lexicon_terms`` bound what is learned from; every text is scored whole."""

    labelled_rows: int = 20_000
    lexicon_terms: int = 5_000
    least_documents: int = 3
    least_share: float = 0.004  # of the toxic rows
    least_log_odds: float = 2.5
    window: int = 4
    levels: tuple[int, ...] = (1, 2, 3, 5, 8)  # counts are told apart up to these
    ridge: float = 1.0
    seed: int = 5


def edits_allowed(term: str) -> int:
    """Short terms must match exactly: nearly every short word is one edit from another."""
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class LexiconAutomaton:
    """Distance of a word to the nearest lexicon term, up to the edits that the term allows.

    A state is a set of (trie node, edits so far).  One letter of the word moves every pair along the trie (match), keeps it (letter too
    much), moves it to any child (letter changed) or further down without a letter (letter missing).  States and moves are kept once
    made, so a word costs one look-up per letter; the store is emptied when it is full.
    """

    DEAD = frozenset()
    STATES = 200_000

    def __init__(self, terms: Iterable[str]) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.allowed: list[int] = [-1]  # edits allowed at a node that ends a term, else -1
        self.most: list[int] = [0]  # the largest number of edits allowed in the terms below
        for term in terms:
            node, limit = 0, edits_allowed(term)
            for letter in term:
                self.most[node] = max(self.most[node], limit)
                node = self._child(node, letter)
            self.most[node] = max(self.most[node], limit)
            self.allowed[node] = max(self.allowed[node], limit)
        self.moves: dict[tuple[frozenset, str], frozenset] = {}
        self.start = self._closed({0: 0})

    def _child(self, node: int, letter: str) -> int:
        child = self.children[node].get(letter)
        if child is None:
            child = self.children[node][letter] = len(self.children)
            self.children.append({})
            self.allowed.append(-1)
            self.most.append(0)
        return child

    def _closed(self, pairs: dict[int, int]) -> frozenset:
        """Add what is reached by missing letters; of each node only the fewest edits are kept."""
        open_ = list(pairs.items())
        while open_:
            node, edits = open_.pop()
            if pairs[node] < edits:
                continue
            for child in self.children[node].values():
                if edits + 1 <= self.most[child] and pairs.get(child, 99) > edits + 1:
                    pairs[child] = edits + 1
                    open_.append((child, edits + 1))
        return frozenset(pairs.items())

    def _move(self, state: frozenset, letter: str) -> frozenset:
        pairs: dict[int, int] = {}

        def reach(node: int, edits: int) -> None:
            if edits <= self.most[node] and pairs.get(node, 99) > edits:
                pairs[node] = edits

        for node, edits in state:
            reach(node, edits + 1)
            for known, child in self.children[node].items():
                reach(child, edits + (known != letter))
        return self._closed(pairs) if pairs else self.DEAD

    def distance(self, word: str) -> int | None:
        """Edits to the nearest term that allows them; None if there is none."""
        state = self.start
        for letter in word:
            following = self.moves.get((state, letter))
            if following is None:
                if len(self.moves) >= self.STATES:
                    self.moves.clear()
                following = self.moves[state, letter] = self._move(state, letter)
            state = following
            if not state:
                return None
        return min((e for n, e in state if e <= self.allowed[n]), default=None)


class ToxicityCounter:
    """Counts lexicon hits of a text by distance and by whether they are quoted."""

    CLEAN_WORDS = 500_000

    def __init__(self, terms: Iterable[str], settings: Settings) -> None:
        self.automaton = LexiconAutomaton(terms)
        self.settings = settings
        self.clean: set[str] = set()  # words known to be no hits; emptied when full
        self.hits: dict[str, int] = {}

    def _find(self, words: set[str]) -> bool:
        found = False
        for word in words.difference(self.clean):
            d = self.hits.get(word)
            if d is None:
                d = self.automaton.distance(word)
                if d is None:
                    if len(self.clean) >= self.CLEAN_WORDS:
                        self.clean.clear()
                    self.clean.add(word)
                    continue
                if len(self.hits) >= self.CLEAN_WORDS:
                    self.hits.clear()
                self.hits[word] = d
            found = True
        return found

    def count(self, text: str | None) -> tuple[int, int, int, int]:
        """Abusive hits at distance 0, 1 and 2, and quoted hits, each as a level."""
        if not text:
            return 0, 0, 0, 0
        lower = text.lower()
        if not self._find(set(_TOKEN.findall(lower))):
            return 0, 0, 0, 0
        places = list(_TOKEN.finditer(lower))
        words = [m.group() for m in places]
        counts = Counter()
        window = self.settings.window
        for i, word in enumerate(words):
            d = self.hits.get(word)
            if d is None:
                if word in self.clean:
                    continue
                d = self.automaton.distance(word)  # the store was emptied meanwhile
                if d is None:
                    continue
            counts["quoted" if self._quoted(lower, places, words, i, window) else min(d, 2)] += 1
        level = lambda n: sum(n >= x for x in self.settings.levels)
        return level(counts[0]), level(counts[1]), level(counts[2]), level(counts["quoted"])

    @staticmethod
    def _quoted(text: str, places: list[re.Match[str]], words: list[str], i: int, window: int) -> bool:
        """Between quotation signs inside the window on one line, or right after a reporting word."""
        if not REPORTING.isdisjoint(words[max(0, i - 2):i]):
            return True
        left = text[places[max(0, i - window)].start():places[i].start()].rpartition("\n")[2]
        right = text[places[i].end():places[min(len(words) - 1, i + window)].end() + 1].partition("\n")[0]
        return not QUOTES.isdisjoint(left) and not QUOTES.isdisjoint(right)


@dataclass(frozen=True)
class ToxicityModel:
    terms: tuple[str, ...]
    weights: np.ndarray
    settings: Settings


def design(levels: np.ndarray) -> np.ndarray:
    """Constant, any exact hit, level of exact hits, of one and two edits, and of quoted hits."""
    return np.column_stack([np.ones(len(levels)), levels[:, 0] > 0, levels]).astype(float)


PRIOR = np.array([-3.0, 2.5, 0.7, 0.7, 0.2, 0.1])  # what the weights are drawn to where the labels say little


def fitted_weights(levels: np.ndarray, toxic: np.ndarray, rows: np.ndarray, ridge: float) -> np.ndarray:
    """Logistic regression by damped Newton steps on counted rows, drawn to PRIOR.

    A hit never speaks against toxicity: a weight that comes out negative is set to 0 and the rest is fitted again.
    """
    used = np.ones(len(PRIOR), bool)
    while True:
        w = np.zeros(len(PRIOR))
        w[used] = _newton(design(levels)[:, used], toxic, rows, ridge, PRIOR[used])
        negative = used & (w < 0)
        negative[0] = False
        if not negative.any():
            return w
        used &= ~negative


def _newton(x: np.ndarray, toxic: np.ndarray, rows: np.ndarray, ridge: float, prior: np.ndarray) -> np.ndarray:
    w = prior.copy()

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(rows @ (np.logaddexp(0.0, z) - toxic * z)) + 0.5 * ridge * float((w - prior) @ (w - prior))

    for _ in range(100):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (rows * (p - toxic)) + ridge * (w - prior)
        step = np.linalg.solve((x * (rows * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1]), gradient)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return w


def _levels(terms: tuple[str, ...], settings: Settings, text: Column) -> Column:
    @F.pandas_udf("exact int, one int, two int, quoted int")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counter = ToxicityCounter(terms, settings)
        for texts in batches:
            yield pd.DataFrame([counter.count(t) for t in texts], columns=["exact", "one", "two", "quoted"], dtype="int32")

    return counted(text)


def fit_toxicity(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text",
                 label: str = "toxic") -> ToxicityModel:
    """Learn lexicon and weights from labelled rows.

    At most ``labelled_rows`` labels are used, drawn by a digest of the key; that bounded table is broadcast, so the texts are not moved.
    Labels that disagree about a key count as toxic.  Without labels the model has no terms and scores every text by its prior.
    """
    s = settings
    one_each = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key).agg(F.max(label).cast("int").alias("y"))
    drawn = one_each.orderBy(digest(s.seed, [key]), key).limit(s.labelled_rows)
    train = docs.select(F.col(key), F.col(text).alias("t")).join(F.broadcast(drawn), key).select("t", "y").where(F.col("t").isNotNull())

    totals = {r["y"]: r["n"] for r in train.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = totals.get(1, 0), totals.get(0, 0)
    tokens = F.filter(F.split(F.lower("t"), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    words = train.select(F.explode(F.array_distinct(tokens)).alias("w"), "y")
    per_word = words.groupBy("w").agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b"))
    odds = F.log((F.col("a") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("b") + 0.5) / (n_clean + 1.0))
    least = max(s.least_documents, s.least_share * n_toxic)
    candidates = per_word.where((F.col("a") >= least) & (odds >= s.least_log_odds)).orderBy(odds.desc(), "w").limit(s.lexicon_terms).select("w")
    # a word that only copies of one text share stands between the same two words every time; a term of abuse does not
    neighbours = train.where("y = 1").select(tokens.alias("ws")).select(F.explode(F.transform(
        "ws", lambda w, i: F.struct(w.alias("w"), F.struct(F.get("ws", i - 1), F.get("ws", i + 1)).alias("between")))).alias("n")).select("n.*")
    contexts = neighbours.join(F.broadcast(candidates), "w").groupBy("w").agg(F.count_distinct("between").alias("places"))
    terms = tuple(sorted(r["w"] for r in contexts.where(F.col("places") >= least).select("w").collect()))

    counted = train.select(_levels(terms, s, F.col("t")).alias("c"), "y").groupBy("c", "y").count()
    table = counted.select("c.exact", "c.one", "c.two", "c.quoted", "y", "count").toPandas()
    table = table.sort_values(list(table.columns)).astype(float)
    weights = fitted_weights(table[["exact", "one", "two", "quoted"]].to_numpy(), table["y"].to_numpy(), table["count"].to_numpy(), s.ridge)
    return ToxicityModel(terms, weights, s)


def toxicity_score(model: ToxicityModel, text: Column) -> Column:
    """Probability of the toxic label for a text column; null and empty texts get that of a text without hits."""
    c = _levels(model.terms, model.settings, text)
    w = [float(x) for x in model.weights]

    def scored(levels: Column) -> Column:
        part = F.lit(w[0]) + F.when(levels["exact"] > 0, w[1]).otherwise(0.0)
        for name, x in zip(("exact", "one", "two", "quoted"), w[2:], strict=True):
            part = part + levels[name] * x
        return 1.0 / (1.0 + F.exp(-part))

    return F.transform(F.array(c), scored)[0]


def score_documents(docs: DataFrame, model: ToxicityModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, score and prediction of every row; repeated rows are scored each, further columns are not read."""
    return docs.select(F.col(id_column), toxicity_score(model, F.col(text_column)).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))

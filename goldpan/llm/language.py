"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Trained by follow-the-regularised-leader with elastic-net penalties, one model per shard of a bounded sample and the weights averaged;
a temperature fitted on rows kept back from training calibrates the probabilities.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldpan.functions.hashing import fold_of, uniform
from goldpan.llm.words import mixed

UNDETERMINED = "und"
_NO_LETTERS = re.compile(r"[\W\d_]+")


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` bounds the labelled rows a model is fitted on; document frequencies come from all labelled rows."""

    buckets: int = 1 << 14
    longest: int = 3
    sample_rows: int = 12_000
    calibration_share: float = 0.1
    shards: int = 6
    passes: int = 2
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 1.0
    seed: int = 17


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    idf: np.ndarray  # one per bucket
    weights: np.ndarray  # buckets x languages
    temperature: float
    settings: Settings


def letters_only(text: str | None) -> str:
    """Lower-case words with single spaces around them, without digits; empty if there is no letter (signs such as ½ or Ⅻ are none)."""
    cut = _NO_LETTERS.sub(" ", text.lower()).strip() if text else ""
    if not cut.isascii() and not any(map(str.isalpha, cut)):
        return ""
    return f" {cut} " if cut else ""


def bucket_counts(text: str | None, settings: Settings) -> np.ndarray | None:
    """How often each hashed n-gram bucket occurs; None for texts without letters."""
    cut = letters_only(text)
    if not cut:
        return None
    codes = np.frombuffer(cut.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    counts = np.zeros(settings.buckets, np.int64)
    gram = np.zeros(len(codes), np.uint64)
    for n in range(1, settings.longest + 1):
        gram = (gram[:len(codes) - n + 1] << np.uint64(21)) | codes[n - 1:]
        if not len(gram):
            break
        counts += np.bincount((mixed(gram + np.uint64(n)) % np.uint64(settings.buckets)).astype(np.int64), minlength=settings.buckets)
    return counts


def features(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets that occur and their damped TF-IDF values, of length one together."""
    at = np.flatnonzero(counts)
    values = (1.0 + np.log(counts[at])) * idf[at]
    return at, values / max(float(np.sqrt(values @ values)), 1e-12)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def follow_the_leader(rows: list[tuple[np.ndarray, np.ndarray, int]], n_languages: int, s: Settings) -> np.ndarray:
    """FTRL-proximal with per-coordinate rates; weights below the L1 penalty are exactly zero."""
    z = np.zeros((s.buckets, n_languages))
    n = np.zeros((s.buckets, n_languages))

    def solved(zs: np.ndarray, ns: np.ndarray) -> np.ndarray:
        shrunk = np.sign(zs) * np.maximum(np.abs(zs) - s.l1, 0.0)
        return -shrunk / ((s.beta + np.sqrt(ns)) / s.alpha + s.l2)

    for _ in range(s.passes):
        for at, values, label in rows:
            w = solved(z[at], n[at])
            p = _softmax(values @ w)
            p[label] -= 1.0
            g = values[:, None] * p[None, :]
            squared = g * g
            z[at] += g - (np.sqrt(n[at] + squared) - np.sqrt(n[at])) / s.alpha * w
            n[at] += squared
    return solved(z, n)


def fitted_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """Scale that gives the kept-back rows the highest likelihood, from a fixed grid; 1 without such rows."""
    if not len(labels):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.05), np.log(5.0), 93))
    losses = [-np.log(np.maximum(_softmax(logits / t)[np.arange(len(labels)), labels], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(losses))])


def fit_language_model(labelled: DataFrame, settings: Settings = Settings(), text: str = "text", lang: str = "lang",
                       key: str | Column = "doc_id") -> LanguageModel | None:
    """Fit on rows with a language and a letter in the text; None if there are none.

    Every labelled row counts for the document frequencies.  The rows to fit on are drawn by a digest of the key, about
    ``sample_rows`` of them; the driver gets the frequencies, the shard models and the kept-back logits, all of fixed size.
    """
    s = settings
    id_text = (F.col(key) if isinstance(key, str) else key).cast("string")
    # rows that share an id, or have none, are told apart by their text
    rows = labelled.select(F.concat_ws("|", id_text, F.xxhash64(F.col(text)).cast("string")).alias("k"), F.col(text).alias("t"), F.col(lang).alias("y"))
    rows = rows.where(F.col("y").isNotNull() & F.col("t").isNotNull())

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, total = np.zeros(s.buckets, np.int64), 0
        for batch in batches:
            for t in batch["t"]:
                counts = bucket_counts(t, s)
                if counts is not None:
                    seen += counts > 0
                    total += 1
        yield pd.DataFrame({"bucket": [-1, *range(s.buckets)], "df": [total, *seen]})

    totals = rows.select("t").mapInPandas(frequencies, "bucket int, df long").groupBy("bucket").agg(F.sum("df").alias("df")).toPandas()
    df = np.zeros(s.buckets + 1, np.int64)
    df[totals["bucket"].to_numpy()] = totals["df"].to_numpy()
    n = int(df[-1])
    if not n:
        return None
    idf = np.log((1 + n) / (1 + df[:-1])) + 1.0

    # an equal part of the sample for every language, so that a rare one is learned from tables of any size
    counts = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = tuple(sorted(counts))
    rates = F.create_map(*[F.lit(v) for y in languages for v in (y, min(1.0, s.sample_rows / len(languages) / counts[y]))])
    sample = rows.where(uniform(s.seed, ["k"]) < F.element_at(rates, F.col("y"))).select(
        "t", "y", fold_of(s.seed + 1, ["k"], s.shards).alias("shard"), (uniform(s.seed + 2, ["k"]) < s.calibration_share).alias("kept"), "k")
    code = {y: i for i, y in enumerate(languages)}

    def shard_model(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["k", "t", "y"])
        prepared = [(*features(c, idf), code[y]) for t, y in zip(pdf["t"], pdf["y"], strict=True) if (c := bucket_counts(t, s)) is not None]
        # the order of a pass must not follow the keys' order in the source
        order = np.random.default_rng(s.seed).permutation(len(prepared))
        w = follow_the_leader([prepared[i] for i in order], len(languages), s)
        at, lang_at = np.nonzero(w)
        return pd.DataFrame({"bucket": at.astype("int32"), "lang_at": lang_at.astype("int32"), "w": w[at, lang_at]})

    train = sample.where(~F.col("kept"))
    averaged = (
        train.groupBy("shard").applyInPandas(shard_model, "bucket int, lang_at int, w double")
        .groupBy("bucket", "lang_at").agg(F.sum(F.col("w")).alias("w")).orderBy("bucket", "lang_at").toPandas()
    )
    weights = np.zeros((s.buckets, len(languages)))
    weights[averaged["bucket"].to_numpy(), averaged["lang_at"].to_numpy()] = averaged["w"].to_numpy() / s.shards

    def kept_logits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for t, y in zip(batch["t"], batch["y"], strict=True):
                counts = bucket_counts(t, s)
                if counts is not None:
                    at, values = features(counts, idf)
                    yield pd.DataFrame({"z": [list(values @ weights[at])], "label": [code[y]]})

    kept = sample.where("kept").select("t", "y").mapInPandas(kept_logits, "z array<double>, label int").toPandas()
    logits = np.array(kept["z"].tolist(), dtype=float).reshape(len(kept), len(languages))
    return LanguageModel(languages, idf, weights, fitted_temperature(logits, kept["label"].to_numpy(dtype=int)), s)


def predict_language(docs: DataFrame, model: LanguageModel | None, text: str = "text") -> Column:
    """Struct of ``lang_pred`` and ``score`` for a text column.

    ``score`` is the calibrated probability of the predicted language.  Null, empty and letter-free texts, and all texts without a
    model, give ``und`` with score 0.  Ties go to the language that comes first by code point.
    """

    @F.pandas_udf("lang_pred string, score double")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            names, scores = [], []
            for t in texts:
                counts = bucket_counts(t, model.settings) if model is not None else None
                if counts is None:
                    names.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                at, values = features(counts, model.idf)
                p = _softmax(values @ model.weights[at] / model.temperature)
                best = int(np.argmax(p))
                names.append(model.languages[best])
                scores.append(float(p[best]))
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    return predicted(docs[text])

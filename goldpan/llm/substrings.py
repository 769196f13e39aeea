"""Removal of passages that an earlier document has, found by difference-cover anchors.

Anchors are short word runs hashed only where the position modulo a period lies in a difference cover.  For any two positions some shift below
the period puts both into the cover, so two equal windows always share an aligned anchor.  Windows around anchors that more than one
document has are extended to full length and compared; all others never leave their task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from goldpan.llm.shared import releasing
from goldpan.llm.words import blank_words, mixed, run_hashes, word_hashes

# Fixed value: the smallest difference cover of 7; every remainder is a difference of two of its elements.
PERIOD, COVER = 7, (0, 1, 3)
ANCHOR_BITS = 48  # two anchors taken for equal by chance only add windows to compare
FILTER_BITS = 1 << 27  # 16 MB, whatever the size of the corpus
SEGMENT_BITS = 1 << 16
BUCKET_BITS = 11  # segments of the bitmap, and parts into which windows are dealt: a task holds one at a time
REST_BITS = 21  # of an anchor beside its slot; with the slot within its segment they are LOW_BYTES
LOW_BYTES = 5
HELD = 250_000  # anchors or windows that a task packs at a time; memory and packing depend on it, results do not


class Anchors:
    """Anchor and window hashes of single texts."""

    def __init__(self, window: int, period: int, cover: Sequence[int]) -> None:
        if {(a - b) % period for a in cover for b in cover} != set(range(period)) or window < period:
            raise ValueError("not a difference cover of the period, or a window shorter than it")
        self.window, self.period, self.length = window, period, window - period + 1
        self.covered = np.isin(np.arange(period), list(cover))

    def of(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in the cover and the hashes of the anchors there; none in texts shorter than a window."""
        if len(hashes) < self.window:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        runs = run_hashes(hashes, self.length)
        at = np.flatnonzero(np.resize(self.covered, len(runs)))
        return at, runs[at] >> np.uint64(64 - ANCHOR_BITS)

    def candidates(self, hashes: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the windows that hold an anchor whose bit is set in ``shared``."""
        at, anchors = self.of(hashes)
        slots = anchors % np.uint64(FILTER_BITS)
        at = at[(shared[(slots >> np.uint64(3)).astype(np.int64)] >> (slots & np.uint64(7)).astype(np.uint8)) & 1 > 0]
        wanted = np.zeros(max(0, len(hashes) - self.window + 1), bool)
        for shift in range(self.period):
            starts = at - shift
            wanted[starts[(starts >= 0) & (starts < len(wanted))]] = True
        starts = np.flatnonzero(wanted)
        return starts, run_hashes(hashes, self.window)[starts] if len(starts) else np.empty(0, np.uint64)


def shared_filter(rows: DataFrame, anchors: Anchors) -> np.ndarray:
    """Bitmap of fixed size over the anchors that more than one document has.

    Anchors travel as packed arrays, one per segment of the bitmap, so that no exchange or aggregation carries a row per anchor.
    """

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, held = [], 0
        for batch in batches:
            for text in batch["_text"]:
                own = np.unique(anchors.of(word_hashes(blank_words(text)))[1])
                if len(own):
                    found.append(own)
                    held += len(own)
                if held > HELD:
                    yield _tally(found)
                    found, held = [], 0
        if found:
            yield _tally(found)

    def segment(pdf: pd.DataFrame) -> pd.DataFrame:
        values = np.sort(np.concatenate([_unpacked(b) for b in pdf["anchors"]]))
        bits = np.zeros(SEGMENT_BITS, np.uint8)
        bits[(values[1:][values[1:] == values[:-1]] >> np.uint64(REST_BITS)) & np.uint64(SEGMENT_BITS - 1)] = 1
        packed = np.packbits(bits, bitorder="little").tobytes()
        return pd.DataFrame({"segment": [pdf["segment"].iloc[0]], "bits": [packed]}).iloc[:int(bits.any())]

    shared = np.zeros(FILTER_BITS // 8, np.uint8)
    packed = rows.select("_text").mapInPandas(counted, "segment int, anchors binary")
    with releasing(rows.sparkSession):
        segments = packed.groupBy("segment").applyInPandas(segment, "segment int, bits binary").collect()
    for row in segments:
        at = row["segment"] * SEGMENT_BITS // 8
        shared[at:at + SEGMENT_BITS // 8] = np.frombuffer(row["bits"], np.uint8)
    return shared


def _tally(found: list[np.ndarray]) -> pd.DataFrame:
    """Anchors by segment, each at most twice: that two documents have it is all the filter asks."""
    values = np.concatenate(found)
    # the slot comes first, so that sorted values lie by segment
    values = np.sort(((values % np.uint64(FILTER_BITS)) << np.uint64(REST_BITS)) | (values // np.uint64(FILTER_BITS)))
    keep = np.ones(len(values), bool)
    keep[2:] = values[2:] != values[:-2]
    values = values[keep]
    segments = (values >> np.uint64(ANCHOR_BITS - BUCKET_BITS)).astype(np.int32)
    low = values.view(np.uint8).reshape(-1, 8)[:, :LOW_BYTES]
    cuts = _cuts(segments)
    return pd.DataFrame({"segment": segments[cuts[:-1]], "anchors": [low[a:b].tobytes() for a, b in pairwise(cuts)]})


def _unpacked(packed: bytes) -> np.ndarray:
    """The values of a segment again; the bits of its number are the same in all of them."""
    values = np.zeros((len(packed) // LOW_BYTES, 8), np.uint8)
    values[:, :LOW_BYTES] = np.frombuffer(packed, np.uint8).reshape(-1, LOW_BYTES)
    return values.view(np.uint64).ravel()


def _cuts(sorted_keys: np.ndarray) -> list[int]:
    """Where each run of equal keys begins, and the end."""
    return [0, *(np.flatnonzero(sorted_keys[1:] != sorted_keys[:-1]) + 1).tolist(), len(sorted_keys)]


def covered_windows(rows: DataFrame, anchors: Anchors) -> DataFrame:
    """_id, _print and the starts of the windows that also start in a document with a smaller id.

    Windows travel as packed arrays, dealt by their hash.  What a task already knows to be later than a row of its own is not compared again,
    so a window that very many documents have is no large group: every HELD windows send it for one document only.
    """
    shared = rows.sparkSession.sparkContext.broadcast(shared_filter(rows, anchors))

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, held = [], 0
        for batch in batches:
            for own, print_, text in zip(batch["_id"], batch["_print"], batch["_text"], strict=True):
                starts, hashes = anchors.candidates(word_hashes(blank_words(text)), shared.value)
                if len(starts):
                    found.append((own, print_, starts, hashes))
                    held += len(starts)
                if held > HELD:
                    yield _dealt(found)
                    found, held = [], 0
        if found:
            yield _dealt(found)

    def compared(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, places = _joined(pdf["ids"], np.int64), _joined(pdf["places"], np.int64)
        open_ = np.repeat(~pdf["known"].to_numpy(), pdf["ids"].str.len() // 8)
        order, later = _later(_joined(pdf["windows"], np.uint64), ids[open_])
        out = [np.concatenate([column[~open_], column[open_][order][later]]) for column in (ids, places)]
        return pd.DataFrame({"_id": out[0], "place": out[1]})

    dealt = rows.mapInPandas(windows, "bucket int, known boolean, windows binary, ids binary, places binary")
    later = dealt.groupBy("bucket").applyInPandas(compared, "_id long, place long")
    print_, start = F.shiftright("place", 32).cast("int").alias("_print"), F.col("place").bitwiseAND(0xFFFFFFFF).cast("int")
    return later.groupBy("_id", print_).agg(F.collect_list(start).alias("starts"))


def _later(windows: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by window and id, and which entries in that order have a larger id than the first of their window."""
    order = np.lexsort((ids, windows))
    if not len(order):
        return order, np.zeros(0, bool)
    windows, ids = windows[order], ids[order]
    opens = np.concatenate([[True], windows[1:] != windows[:-1]])
    return order, ids > ids[opens][np.cumsum(opens) - 1]


def _dealt(found: list[tuple[int, int, np.ndarray, np.ndarray]]) -> pd.DataFrame:
    """Packed windows by hash, and those known to be later by document."""
    sizes = [len(s) for _, _, s, _ in found]
    windows, ids = np.concatenate([h for *_, h in found]), np.repeat(np.array([f[0] for f in found], np.int64), sizes)
    # print and start in one number
    places = np.repeat(np.array([f[1] for f in found], np.int64) << 32, sizes) | np.concatenate([s for _, _, s, _ in found])
    order, later = _later(windows, ids)
    parts = []
    for known, at in ((False, order[~later]), (True, order[later])):
        buckets = ((mixed(ids[at].view(np.uint64)) if known else windows[at]) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
        by = np.argsort(buckets, kind="stable")
        at, buckets = at[by], buckets[by]
        for a, b in pairwise(_cuts(buckets)) if len(at) else ():
            sent = at[a:b]
            parts.append((buckets[a], known, b"" if known else windows[sent].tobytes(), ids[sent].tobytes(), places[sent].tobytes()))
    return pd.DataFrame(parts, columns=["bucket", "known", "windows", "ids", "places"])


def _joined(packed: pd.Series, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(packed), kind)


def kept_words(text: str | None, starts: Sequence[int] | None, window: int) -> tuple[int, int, str]:
    """Words, removed words, and the words that are left joined by one space."""
    words = blank_words(text)
    removed = np.zeros(len(words) + 1, np.int64)
    if starts is not None and len(starts):
        at = np.asarray(starts)
        np.add.at(removed, at, 1)
        np.add.at(removed, at + window, -1)
    keep = np.cumsum(removed[:-1]) == 0
    left = words if keep.all() else [w for w, k in zip(words, keep, strict=True) if k]
    return len(words), len(words) - len(left), b" ".join(left).decode("utf-8", "surrogatepass")


def remove_repeated_passages(docs: DataFrame, window: int = 13, id_column: str = "doc_id", text_column: str = "text",
                             carry: Sequence[str] = (), period: int = PERIOD, cover: Sequence[int] = COVER) -> DataFrame:
    """id, n_words, n_removed, kept_text and the carried columns of every row.

    Every word inside a window whose words also start in a document with a smaller id is removed; windows are judged on the input.  Null,
    empty and short texts lose nothing, and a null text has no words.  Rows without an id neither lose words nor take any from others.  Rows
    that repeat an id are one document and do not count against each other.  Columns other than id, text and ``carry`` are not read.
    """
    anchors = Anchors(window, period, cover)
    # rows that share an id but not the text are told apart by a print of the text
    out = {id_column, "n_words", "n_removed", "kept_text"}
    # the text travels once, also if it is carried
    carried = {c: "_text" if c == text_column else f"_c_{c}" for c in carry if c not in out}
    base = docs.select(F.col(id_column).cast("long").alias("_id"), F.hash(text_column).alias("_print"), F.col(text_column).alias("_text"),
                       *[F.col(c).alias(at) for c, at in carried.items() if at != "_text"])
    starts = covered_windows(base.select("_id", "_print", "_text").where(F.col("_id").isNotNull() & F.col("_text").isNotNull()), anchors)

    # whole batches, as in the other steps: Python functions on columns would keep workers of their own beside those of the steps before
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, places = batch["_text"].to_pandas(), batch["starts"].to_pandas()
            rows = [kept_words(t, p, window) for t, p in zip(texts, places, strict=True)]
            made = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch["_id"], *made, *[batch[at] for at in carried.values()]], names=schema.fieldNames())

    schema = StructType([StructField(id_column, LongType()), StructField("n_words", LongType()), StructField("n_removed", LongType()),
                         StructField("kept_text", StringType()), *[StructField(c, base.schema[at].dataType) for c, at in carried.items()]])
    return base.join(starts, ["_id", "_print"], "left").select("_id", "_text", "starts", *[at for at in carried.values() if at != "_text"]).mapInArrow(
        cut, schema)


REPEATED_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, s, array_to_string(w[s:s + 12], ' ') AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS s FROM words)),
firsts AS (SELECT win, min(doc_id) AS first FROM windows GROUP BY win HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT DISTINCT doc_id, s + d AS p FROM windows JOIN firsts USING (win), range(13) AS shifts(d) WHERE doc_id > first),
gone_list AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id),
kept AS (
  SELECT doc_id, len(w) AS n_words, coalesce(len(ps), 0) AS n_removed,
         CASE WHEN ps IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(ps, i)) END AS k
  FROM words LEFT JOIN gone_list USING (doc_id))
SELECT doc_id, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed, sha256(array_to_string(k, ' ')) AS kept_sha256 FROM kept
"""

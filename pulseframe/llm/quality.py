"""Quality filter: importance resampling between target text and raw text."""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.llm.common import by_batch, pa_schema, saved, whole_text
from pulseframe.llm.mixing import unit_draw

#: Buckets that n-grams are hashed to: two tables for single tokens and two for pairs.
BUCKETS = 1 << 19
#: Labelled rows that the target model is fitted on, at most.
LABELLED_ROWS = 50_000
#: Documents that are added to the target count and to the expected count of each bucket.
PRIOR = 0.5
#: Characters of the word beginnings that count besides whole words.
BEGINNINGS = (4, 6)
#: Share of the labelled target rows that the cut keeps at least.
LEAST_KEPT = 0.98
SEED = "quality-1"
#: Tokens whose hashes a worker remembers; when they are this many, it starts anew.
REMEMBERED = 300_000


class Weighing(NamedTuple):
    """How counts become weights and weights a sample; the default is plain importance resampling.

    ``half_z``: standard errors of difference among labelled rows at which half of an
    n-gram's log ratio counts; with 0 every log ratio counts in full. ``both_tables``: an
    n-gram counts with that of its two buckets that is nearer to 0, else with its first.
    ``temperature``: scale of the Gumbel noise; weights are raised to one over it.
    """

    half_z: float = 0.0
    both_tables: bool = False
    temperature: float = 1.0


#: For filters of whole documents: only what labels show counts, and the sample is close to a cut.
SHARPENED = Weighing(half_z=4.0, both_tables=True, temperature=0.1)

_TOKEN = re.compile(r"\w+|[^\w\s]+")
_COUNTS = "bucket INT, raw LONG, labelled LONG, target LONG"


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate([np.ones(min(len(values), 1), bool), values[1:] != values[:-1]])]


def _hash(text: str) -> int:
    data = text.encode("utf-8", "surrogatepass")
    return zlib.crc32(data) << 32 | zlib.crc32(data, 0x9E3779B9)


class _Known(dict):
    """A dict that has ``new`` make the values of missing keys."""

    def __init__(self, new: Callable[[str], int]) -> None:
        self._new = new

    def __missing__(self, key: str) -> int:
        return self._new(key)


class Features:
    """The hashed n-grams of a text.

    One and two tokens in a row; a token is a run of word characters or of marks, in lower
    case unless it is all capitals; the beginnings of longer words, which inflected and
    compound words share; and whether a quarter of the tokens repeat the one before.
    Each n-gram has a bucket in two tables, so that two that share one seldom share both.
    """

    def __init__(self) -> None:
        self._places, self._beginnings = _Known(self._place), _Known(self._beginning)
        self._hashes = array("Q")

    def _place(self, token: str) -> int:
        """The row of ``_hashes`` with the hashes of a new token and its beginnings, 0 for none."""
        place = self._places[token] = len(self._places)
        lower = token.lower()
        plain = token if len(token) > 1 and token.isupper() else lower
        self._hashes.extend([_hash(plain), *[self._beginnings["^" + lower[:n]] if len(lower) > n else 0 for n in BEGINNINGS]])
        return place

    def _beginning(self, marked: str) -> int:
        value = self._beginnings[marked] = _hash(marked)
        return value

    def __call__(self, text: str) -> np.ndarray:
        """Two rows of buckets, a column for each n-gram, repeats of pairs and beginnings included."""
        if len(self._places) >= REMEMBERED:
            self._places.clear()
            self._beginnings.clear()
            self._hashes = array("Q")
        places = np.array(list(map(self._places.__getitem__, _TOKEN.findall(text))), np.int64)
        if not len(places):
            return np.zeros((2, 0), np.int64)
        hashes = np.frombuffer(self._hashes, np.uint64).reshape(-1, 1 + len(BEGINNINGS))
        one = hashes[places, 0]
        distinct = hashes[_distinct(places)].ravel()
        two = (one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:]) * np.uint64(0xD6E8FEB86659FD93)
        repeats = 4 * np.count_nonzero(one[1:] == one[:-1]) >= len(one)
        single = np.append(distinct[distinct > 0], np.uint64(0xABCDEF0123456789 if repeats else one[0]))
        table = np.uint64(BUCKETS // 4)
        grams = [(g * np.uint64(k)) >> np.uint64(36) for g in (single, two) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]
        singles, singles_too, pairs, pairs_too = ((g & (table - np.uint64(1))) + table * np.uint64(i) for i, g in enumerate(grams))
        return np.array([np.concatenate([singles, pairs]), np.concatenate([singles_too, pairs_too])]).astype(np.int64)


def _weights(ratios: list[np.ndarray], grams: np.ndarray, both_tables: bool) -> list[float]:
    """For each of ``ratios``: the sum over the different n-grams (with both tables 0 for one whose buckets disagree)."""
    both = _distinct(grams[0] * BUCKETS + grams[1])
    first = both // BUCKETS
    if not both_tables:
        return [float(ratio[first].sum()) for ratio in ratios]
    second = both - first * BUCKETS
    out = []
    for ratio in ratios:
        a, b = ratio[first], ratio[second]
        out.append(float(np.where(a * b > 0, np.where(np.abs(a) < np.abs(b), a, b), 0.0).sum()))
    return out


def labelled_rows(labels: DataFrame, most: int = LABELLED_ROWS) -> dict[int, bool]:
    """doc_id to whether it is target text (quality 1, not toxic), of a bounded sample by hash."""
    known = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        ((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)).alias("target"),
    ).dropna().groupBy("doc_id").agg(F.min("target").alias("target"))
    return {r[0]: r[1] for r in known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).collect()}


def ngram_counts(docs: DataFrame, labelled: dict[int, bool]) -> DataFrame:
    """(bucket, raw, labelled, target): documents with the bucket; bucket -1 counts all documents.

    ``raw`` covers every document. Each task adds up its own documents first.
    """
    arrow = pa_schema(docs.sparkSession, _COUNTS)
    shared = docs.sparkSession.sparkContext.broadcast(labelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, known = Features(), shared.value
        counts = np.zeros((3, BUCKETS + 1), np.int64)
        last = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                # Of equal buckets the one that was written last counts, so each counts once.
                found, target = features(text).ravel(), known.get(doc_id)
                last[found] = place = np.arange(len(found))
                found = np.append(found[last[found] == place], BUCKETS)
                counts[0, found] += 1
                if target is not None:
                    counts[1, found] += 1
                    counts[2, found] += target
        seen = np.nonzero(counts[0])[0]
        bucket = np.where(seen == BUCKETS, -1, seen).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(bucket), *(pa.array(c[seen]) for c in counts)], schema=arrow)

    parts = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")).mapInArrow(run, _COUNTS)
    return parts.groupBy("bucket").agg(*(F.sum(c).alias(c) for c in ("raw", "labelled", "target")))


def _ratio(raw: np.ndarray, labelled: np.ndarray, target: np.ndarray, whole: tuple[int, int, int], half_z: float) -> np.ndarray:
    """The smoothed log ratio of the target and the raw model by bucket.

    Both counts get PRIOR documents more. With ``half_z`` a log ratio counts in full only
    where the labelled rows show the difference; the less they do, the less of it is left.
    """
    n, n_labelled, n_target = whole
    if not n_target or n_target == n_labelled:
        return np.zeros(len(raw))
    plain = np.log((target + PRIOR) / (raw * (n_target / n) + PRIOR))
    if not half_z:
        return plain
    share = n_target / n_labelled
    z = (target - labelled * share) / np.sqrt(np.maximum(labelled * share * (1 - share), 0.3))
    return plain * (z**4 / (z**4 + half_z**4))


def log_ratios(counts: DataFrame, half_z: float = 0.0) -> np.ndarray:
    """Three rows of ratios of the two models by bucket, 0 where they are alike.

    The first holds for any document; the second for a labelled target document, as if it
    had not been counted; the third for a labelled other one. There are BUCKETS of them at most.
    """
    counts = saved(counts, "counts")
    ratio, whole = np.zeros((3, BUCKETS)), counts.filter("bucket < 0").first()
    if whole is None or not whole["target"]:
        return ratio
    n = tuple(whole[c] for c in ("raw", "labelled", "target"))
    # What no labelled row has is shrunk to 0 and need not be fetched.
    told = counts.filter("bucket >= 0 AND labelled > 0" if half_z else "bucket >= 0").toArrow()
    bucket, *seen = (told[c].to_numpy() for c in ("bucket", "raw", "labelled", "target"))
    for row, own in enumerate(((0, 0, 0), (1, 1, 1), (1, 1, 0))):
        # Buckets that no such document has go below 0, and are not looked up for one.
        left = [np.maximum(a - b, 0) for a, b in zip(seen, own)]
        if n[1] > own[1]:
            ratio[row, bucket] = _ratio(*left, tuple(a - b for a, b in zip(n, own)), half_z)
    return ratio


def log_weights(docs: DataFrame, ratio: np.ndarray, labelled: dict[int, bool], both_tables: bool = False) -> DataFrame:
    """(doc_id, log_weight, held_out): sums of the ratios of a document's distinct n-grams.

    ``held_out`` is the weight of a labelled document as if it had not been counted, null for others.
    """
    shared = docs.sparkSession.sparkContext.broadcast((ratio, labelled))

    def make():
        features = Features()

        def step(doc_id, text):
            (plain, target, other), known = shared.value
            weights, held_out = [], []
            for i, t in zip(doc_id, text):
                kind = known.get(i)
                found = _weights([plain] if kind is None else [plain, target if kind else other], features(t), both_tables)
                weights.append(found[0])
                held_out.append(None if kind is None else found[1])
            return {"doc_id": doc_id, "log_weight": weights, "held_out": held_out}

        return step

    return by_batch(docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")), make,
                    "doc_id LONG, log_weight DOUBLE, held_out DOUBLE")


def best_cut(weights: np.ndarray, target: np.ndarray) -> float:
    """The weight that parts target rows from the others best and keeps LEAST_KEPT of the target rows."""
    if not target.any() or target.all():
        return -np.inf
    order = np.argsort(weights, kind="stable")
    weights, target = weights[order], target[order]
    good, bad = target.sum(), (~target).sum()
    below = lambda kind: np.concatenate([[0], np.cumsum(kind)])
    lost = below(target) / good
    gain = np.where(lost <= 1 - LEAST_KEPT, below(~target) / bad - lost, -np.inf)
    edges = np.concatenate([[True], weights[1:] > weights[:-1], [False]])
    place = np.nonzero(edges & (gain >= gain[edges].max()))[0][0]
    return float(weights[place]) if place else -np.inf


def kth_largest(df: DataFrame, column: str, k: int, few: int = 10_000) -> float:
    """The k-th largest value of a finite double column, by histograms that narrow down to it."""
    value = F.col(column)
    low, high, _ = df.agg(F.min(value), F.max(value), F.count(value)).first()
    while True:
        inside = df.filter((value >= low) & (value <= high))
        if low == high:
            return low
        width = (high - low) / 1024
        bin_ = F.least(F.floor((value - low) / width), F.lit(1023)) if width else F.lit(0)
        bins = inside.groupBy(bin_.alias("bin")).agg(F.count("*").alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi"))
        for _, n, lo, hi in sorted(bins.collect(), reverse=True):
            if k <= n:
                break
            k -= n
        if n <= few:
            rest = [r[0] for r in inside.filter((value >= lo) & (value <= hi)).select(column).collect()]
            return sorted(rest, reverse=True)[k - 1]
        low, high = lo, hi


def gumbel(key: Column, seed: str) -> Column:
    """A Gumbel draw that depends on seed and key alone."""
    return -F.log(-F.log(unit_draw(key, seed) + F.lit(2.0**-54)))


def resample(
    docs: DataFrame, labels: DataFrame, weighing: Weighing = Weighing(), size: int | None = None, seed: str = SEED
) -> DataFrame:
    """The sampled documents: doc_id, log_weight, sample_key.

    Weights are the ratio of hashed n-gram models of target and raw text. The target
    model comes from at most LABELLED_ROWS labelled rows, raw counts from all documents.
    ``size`` documents are sampled by Gumbel top-k: those with the largest log weight plus
    noise. Without ``size``, as many as have weights of at least the cut that parts the
    labelled rows best, each weighed without its own counts. Documents that tie at the
    last place all stay. Null and empty texts weigh 0; rows that repeat a doc_id share the
    noise; without labels of both kinds all weigh 0, and without ``size`` all stay. Texts
    of any length are read whole, other columns may have any names, and an empty table of
    documents gives an empty result.
    """
    labelled = labelled_rows(labels)
    ratio = log_ratios(ngram_counts(docs, labelled), weighing.half_z)
    noise = F.lit(weighing.temperature) * gumbel(F.col("doc_id"), seed)
    weighed = saved(
        log_weights(docs, ratio, labelled, weighing.both_tables).withColumn("sample_key", F.col("log_weight") + noise), "weights")
    if size is None:
        held_out = weighed.filter("held_out IS NOT NULL").groupBy("doc_id").agg(F.min("held_out").alias("w")).collect()
        cut = best_cut(np.array([r["w"] for r in held_out]), np.array([labelled[r["doc_id"]] for r in held_out], bool))
        size = weighed.filter(F.col("log_weight") >= F.lit(float(cut))).count()
    else:
        size = min(size, weighed.count())
    weighed = weighed.drop("held_out")
    if not size:
        return weighed.limit(0)
    return weighed.filter(F.col("sample_key") >= F.lit(kth_largest(weighed, "sample_key", size)))


def keep_good(docs: DataFrame, labels: DataFrame, weighing: Weighing = SHARPENED) -> DataFrame:
    """The sampled documents with all their columns; rows that share a doc_id stay if one does."""
    stay = resample(docs, labels, weighing).select(F.col("doc_id").alias("stay")).distinct()
    columns = [f"c{i}" for i in range(len(docs.columns))]
    own = F.col(columns[docs.columns.index("doc_id")]).cast("long")
    return docs.toDF(*columns).join(stay, own.eqNullSafe(F.col("stay")), "left_semi").toDF(*docs.columns)

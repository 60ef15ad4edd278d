import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulseframe.llm import quality

DOCS, LABELS = "doc_id LONG, text STRING", "doc_id LONG, quality INT, toxic INT"


def corpus(seed, n):
    r = random.Random(seed)
    sound = ["".join(r.choice("bdfglmnprst") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(900)]
    docs, labels = [], []
    for i in range(n):
        words = [r.choice(sound) for _ in range(r.randint(20, 200))]
        kind = r.choices(("good", "junk", "toxic", "loop"), (7, 1, 1, 1))[0]
        if kind == "junk":
            words = [w + r.choice(("###", "$$$")) for w in words]
        elif kind == "toxic":
            for _ in range(6):
                words.insert(r.randrange(len(words)), r.choice(("vile", "scum", "trashy")))
        elif kind == "loop":
            words = [w for w in words[:8] for _ in range(15)]
        docs.append((i, " ".join(words)))
        if r.random() < 0.5:
            labels.append((i, int(kind in ("good", "toxic")), int(kind == "toxic")))
        docs[-1] = (*docs[-1], kind)
    return docs, labels


def test_good_stays_and_the_rest_goes(spark):
    docs, labels = corpus(3, 3000)
    frame = spark.createDataFrame([d[:2] for d in docs], DOCS).repartition(4).withColumns({c: F.lit(1) for c in ("log_weight", "stay", "target")})
    kept = quality.keep_good(frame, spark.createDataFrame(labels, LABELS))
    assert kept.columns == frame.columns
    ids = {r["doc_id"] for r in kept.collect()}
    share = {k: np.mean([d[0] in ids for d in docs if d[2] == k]) for k in ("good", "junk", "toxic", "loop")}
    assert share["good"] > 0.98 and max(share["junk"], share["toxic"], share["loop"]) < 0.05, share


def noise_of(spark, ids, seed=quality.SEED):
    frame = spark.createDataFrame([(i,) for i in ids], "doc_id LONG")
    return {r["doc_id"]: r["g"] for r in frame.select("doc_id", quality.gumbel(F.col("doc_id"), seed).alias("g")).collect()}


@pytest.mark.parametrize("weighing", [quality.Weighing(), quality.SHARPENED])
def test_sample_is_that_of_a_plain_computation(spark, weighing):
    docs, labels = corpus(5, 400)
    docs += [(1000, None, ""), (1001, "", ""), (1001, "", ""), (None, "x y", "")]
    target = {i: q == 1 and t == 0 for i, q, t in labels}
    features = quality.Features()
    grams = [(i, set(map(tuple, features(t or "").T.tolist()))) for i, t, _ in docs]
    counts = {}
    for i, g in grams:
        for b in {b for pair in g for b in pair}:
            old = counts.get(b, (0, 0, 0))
            counts[b] = old[0] + 1, old[1] + (i in target), old[2] + target.get(i, False)
    share, n_target = sum(target.values()) / len(target), sum(target.values())

    def ratio(bucket):
        raw, known, good = counts[bucket]
        value = np.log((good + quality.PRIOR) / (raw * n_target / len(docs) + quality.PRIOR))
        if weighing.half_z:
            z = abs(good - known * share) / max(known * share * (1 - share), 0.3) ** 0.5
            value *= z**4 / (z**4 + weighing.half_z**4)
        return value

    def counted(pair):
        a, b = map(ratio, pair)
        return a if not weighing.both_tables else min(a, b, key=abs) if a * b > 0 else 0

    want = {i: sum(map(counted, g)) for i, g in grams}
    noise = noise_of(spark, want)
    keys = [want[i] + weighing.temperature * noise[i] for i, _ in grams]
    frame = spark.createDataFrame([d[:2] for d in docs], DOCS)
    known = spark.createDataFrame(labels, LABELS)
    for size in (1, 40, 399):
        got = quality.resample(frame, known, weighing, size).collect()
        assert all(r["log_weight"] == pytest.approx(want[r["doc_id"]]) for r in got)
        least = sorted(keys, reverse=True)[size - 1]
        assert sorted(map(str, (r["doc_id"] for r in got))) == sorted(str(i) for (i, _), k in zip(grams, keys) if k >= least - 1e-9)
    assert quality.resample(frame, known, weighing, 10_000).count() == len(docs)
    assert quality.resample(frame, known, weighing, 0).count() == 0


@pytest.mark.parametrize("temperature", [1.0, 0.5])
def test_gumbel_draws_in_proportion_to_weights(spark, temperature):
    weights = np.array([0.0, 0.5, 1.0, -1.0])
    noise = noise_of(spark, range(4 * 10_000))
    keys = np.array([noise[i] for i in range(4 * 10_000)]).reshape(-1, 4) * temperature + weights
    share = np.bincount(keys.argmax(axis=1), minlength=4) / len(keys)
    wanted = np.exp(weights / temperature)
    assert np.abs(share - wanted / wanted.sum()).max() < 0.02


def test_kth_largest(spark):
    r = random.Random(1)
    values = [r.gauss(0, 1) for _ in range(500)] + [0.25] * 300 + [-7.0, 9.0]
    frame = spark.createDataFrame([(v,) for v in values], "x DOUBLE")
    for k in (1, 2, 250, 500, len(values)):
        assert quality.kth_largest(frame, "x", k, few=20) == sorted(values, reverse=True)[k - 1]


def test_without_labels_or_documents(spark):
    frame = spark.createDataFrame([(1, "a b"), (2, None)], DOCS)
    none = spark.createDataFrame([], LABELS)
    assert quality.keep_good(frame, none).count() == 2
    assert quality.keep_good(frame.limit(0), none).count() == 0
    one = spark.createDataFrame([(1, 1, 0), (1, None, 0), (3, 1, None)], LABELS)
    assert quality.keep_good(frame, one).count() == 2


def test_best_cut():
    w = np.array([-9, -8, -7, -0.5, 0, 0, 0, 0.1])
    assert quality.best_cut(w, np.array([0, 0, 0, 1, 1, 1, 1, 1], bool)) == -0.5
    assert quality.best_cut(w, np.ones(8, bool)) == -np.inf
    # A cut that would lose too many target rows is not taken.
    assert quality.best_cut(np.array([-3, -2, -2, -1, 0, 0]), np.array([0, 1, 0, 0, 1, 1], bool)) == -2


def tongues(seed, n):
    """Four languages, each with stems of toxic words that are inflected, so that most forms are rare."""
    r = random.Random(seed)
    parts = ["".join(p) for p in zip("bdfglmnprst" * 3, "aeiou" * 7)]
    stems = {"k": ("vukro", "zhimpa"), "w": ("qoltra", "hyxene"), "y": ("jubrok", "xandri"), "v": ("whobla", "zygmor")}
    docs, labels = [], []
    for i in range(n):
        tongue, toxic = r.choice("kwyv"), r.random() < 0.15
        words = [tongue + "".join(r.choice(parts) for _ in range(r.randint(1, 2))) for _ in range(r.randint(30, 120))]
        for _ in range(6 if toxic else 0):
            words.insert(r.randrange(len(words)), r.choice(stems[tongue]) + r.choice(parts) + r.choice(parts))
        docs.append((i, " ".join(words), tongue, toxic))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_rare_inflected_words_of_each_language(spark):
    docs, labels = tongues(1, 600)
    frame = spark.createDataFrame([d[:2] for d in docs], DOCS)
    ids = {r["doc_id"] for r in quality.keep_good(frame, spark.createDataFrame(labels, LABELS)).collect()}
    assert np.mean([d[0] in ids for d in docs if not d[3]]) > 0.95
    for tongue in "kwyv":
        assert np.mean([d[0] in ids for d in docs if d[3] and d[2] == tongue]) < 0.3, tongue


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_labelled_toxic_rows_of_the_given_tables_go(spark, size):
    read = lambda name: spark.read.parquet(f"/root/testdata/{size}/{name}.parquet")
    kept = quality.keep_good(read("documents"), read("labels")).join(read("labels"), "doc_id").collect()
    rows = read("documents").join(read("labels"), "doc_id").collect()
    count = lambda some, toxic: sum(r["quality"] == 1 and r["toxic"] == toxic for r in some)
    assert count(kept, 0) > 0.97 * count(rows, 0) and count(kept, 1) < 0.4 * count(rows, 1)


def test_held_out_weights_are_those_without_the_document(spark):
    docs, labels = tongues(2, 60)
    frame, known = spark.createDataFrame([d[:2] for d in docs], DOCS), {i: not t for i, _, t in labels if i % 3}
    ratio = quality.log_ratios(quality.ngram_counts(frame, known), quality.SHARPENED.half_z)
    got = {r["doc_id"]: r for r in quality.log_weights(frame, ratio, known, both_tables=True).collect()}
    features = quality.Features()
    for i in (0, 1, 4, next(d[0] for d in docs if d[3] and d[0] in known)):
        rest = [d for d in docs if d[0] != i or i not in known]
        counts = np.zeros((3, quality.BUCKETS))
        for j, text, *_ in rest:
            counts[:, np.unique(features(text))] += np.array([[1], [j in known], [known.get(j, False)]])
        n = len(rest), sum(j != i for j in known), sum(t and j != i for j, t in known.items())
        share = n[2] / n[1]
        z = (counts[2] - counts[1] * share) / np.sqrt(np.maximum(counts[1] * share * (1 - share), 0.3))
        plain = np.log((counts[2] + quality.PRIOR) / (counts[0] * n[2] / n[0] + quality.PRIOR)) * z**4 / (z**4 + quality.SHARPENED.half_z**4)
        pairs = [plain[list(p)] for p in set(map(tuple, features(docs[i][1]).T.tolist()))]
        want = sum(min(p, key=abs) for p in pairs if p[0] * p[1] > 0)
        assert got[i]["held_out" if i in known else "log_weight"] == pytest.approx(want)
        assert (got[i]["held_out"] is None) == (i not in known)

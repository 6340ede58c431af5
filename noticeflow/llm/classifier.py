"""Quality classifier: vectors of hashed words and character n-grams, averaged per text, with a softmax on top.

Trained by stochastic gradient descent in numpy on a bounded sample of the labelled
rows (MOST_TRAIN in each class). The output is linear in the average, so for scoring each
feature's vector is reduced to its share of the logit: the broadcast model is BUCKETS + 2
numbers, whatever the size of the data.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeflow.llm.common import map_text, mix64, powers, small_batches

BUCKETS, DIMS, GRAMS = 1 << 17, 8, (3, 4)
# Two features of their own: every text has PRIOR of the first, so short texts stay near the average; the second
# stands at each word that repeats the word before it. They follow the hashed buckets.
PRIOR, TEXT, AGAIN = 30, BUCKETS, BUCKETS + 1
MOST_TRAIN, EPOCHS, RATE = 2000, 6, 0.5
CHARS = 1_000_000  # per batch: a dozen arrays of that length are held
HELD_OUT_OF = 5


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of all words, repeats and character n-grams inside words, in order of text.

    White space is ASCII; case is kept. The PRIOR features are not listed here.
    """
    codes = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(codes):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    sizes[-1] -= 1
    row = np.repeat(np.arange(len(texts)), sizes)
    blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
    inside = np.concatenate([[False], ~blank, [False]])
    edges = np.flatnonzero(np.diff(inside.astype(np.int8)))
    start, end = edges[0::2], edges[1::2]
    if not len(start):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    wide = codes.astype(np.uint64) + np.uint64(1)
    rows, hashes = [], []
    # Words: a polynomial over the letters.
    base = np.zeros(len(codes), np.int64)
    base[start] = np.diff(np.concatenate([[0], start]))
    place = np.maximum(np.arange(len(codes)) - np.cumsum(base), 0)
    place[: start[0]] = 0
    weighted = wide * powers(int(place.max()) + 1)[place]
    weighted[blank] = 0
    words = np.add.reduceat(weighted, start) + np.uint64(7)
    rows.append(row[start])
    hashes.append(words)
    again = row[start][1:][(words[1:] == words[:-1]) & (row[start][1:] == row[start][:-1])]
    # Letters left in the word from each position.
    left = np.zeros(len(codes), np.int64)
    lengths = end - start
    left[~blank] = np.repeat(lengths, lengths) - place[~blank]
    for n in GRAMS:
        at = np.flatnonzero(left >= n)
        value = np.zeros(len(at), np.uint64)
        for j, p in enumerate(powers(n, 0xD6E8FEB86659FD93)):
            value += wide[at + j] * p
        rows.append(row[at])
        hashes.append(value + np.uint64(n))
    buckets = (mix64(np.concatenate(hashes)) & np.uint64(BUCKETS - 1)).astype(np.int64)
    rows_all = np.concatenate([*rows, again])
    buckets = np.concatenate([buckets, np.full(len(again), AGAIN)])
    order = np.argsort(rows_all, kind="stable")
    return rows_all[order], buckets[order]


def train(examples: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS, rate: float = RATE) -> np.ndarray:
    """The logit of label 1 against 0 for each feature, from (features, shares, label) of each text."""
    random = np.random.default_rng(10)
    vectors = random.uniform(-1 / DIMS, 1 / DIMS, (BUCKETS + 2, DIMS)).astype(np.float32)
    out = random.uniform(-0.5, 0.5, (DIMS, 2)).astype(np.float32)
    steps, done = max(1, epochs * len(examples)), 0
    for _ in range(epochs):
        for number in random.permutation(len(examples)):
            buckets, shares, label = examples[number]
            now = rate * (1 - done / steps)
            done += 1
            hidden = shares @ vectors[buckets]
            logits = hidden @ out
            chance = np.exp(logits - logits.max())
            error = chance / chance.sum()
            error[label] -= 1
            back = out @ error
            out -= now * np.outer(hidden, error)
            # The step of a text is shared out over its features by their weight in the average.
            vectors[buckets] -= now * np.outer(shares / shares.max(), back)
    return (vectors @ (out[:, 1] - out[:, 0])).astype(np.float32)


def example(buckets: np.ndarray, label: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Different features of one text, their share of all, and its label."""
    kinds, counts = np.unique(buckets, return_counts=True)
    kinds, counts = np.append(kinds, TEXT), np.append(counts, PRIOR)
    return kinds, (counts / counts.sum()).astype(np.float32), label


def held_out(key: str):
    """Whether crc32 of the key as text leaves no remainder; a NULL key is not held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % HELD_OUT_OF == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, text: str, key: str, label: str, most: int) -> DataFrame:
    """(_key, _text, _label) of at most ``most`` labelled keys per class that are not held out, chosen by the hash of the key.

    A key with both labels is left out. Of rows with the same key one is taken, that with the least hash of its text, so repeated
    documents neither displace others nor count twice.
    """
    given = (labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label"))
             .where(F.col("_label").isin(0, 1) & F.col("_key").isNotNull()).where(~held_out("_key"))
             .groupBy("_key").agg(F.min("_label").alias("_label"), F.max("_label").alias("_other"))
             .where("_label = _other"))
    order = F.xxhash64("_key")
    chosen = [given.where(F.col("_label") == c).orderBy(order, "_key").limit(most).select("_key", "_label") for c in (0, 1)]
    # Bounded by 2 * most rows of two numbers.
    few = F.broadcast(chosen[0].unionAll(chosen[1]))
    rows = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text")).join(few, "_key")
    return rows.groupBy("_key", "_label").agg(F.min_by("_text", F.struct(F.xxhash64("_text"), "_text")).alias("_text"))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality",
        most: int = MOST_TRAIN) -> np.ndarray:
    """The model, trained in one task on the bounded sample; zeros if a class has no row.

    NULL and empty texts take part as empty; labels other than 0 and 1, keys with both of them and NULL keys do not. Repeated rows
    count once. Empty tables give zeros. Other columns are not read.
    """
    sample = training_rows(docs, labels, text, key, label, most)
    sample = sample.repartition(1).sortWithinPartitions(F.xxhash64("_key"), "_key").select("_text", "_label")  # 2 * most rows

    def run(batches):
        examples = []
        for batch in batches:
            for part in small_batches(iter([batch]), "_text", CHARS):
                texts = part.column("_text").to_pylist()
                row, buckets = features(texts)
                bounds = np.searchsorted(row, np.arange(len(texts) + 1))
                for n, wanted in enumerate(part.column("_label").to_pylist()):
                    examples.append(example(buckets[bounds[n]:bounds[n + 1]], wanted))
        if len({e[2] for e in examples}) == 2:
            yield pa.RecordBatch.from_arrays([pa.array([train(examples).tobytes()], pa.binary())], names=["weights"])

    made = sample.mapInArrow(run, "weights binary").collect()
    return np.frombuffer(bytes(made[0]["weights"]), np.float32) if made else np.zeros(BUCKETS + 2, np.float32)


def score_texts(docs: DataFrame, model: np.ndarray, text: str = "text", key: str = "doc_id",
                cut_off: float = 0.3) -> DataFrame:
    """key, held_out, score (of label 1) and predicted of every row; no shuffle.

    The score depends on the whole text alone. A NULL or empty text has the score of the PRIOR features alone.
    Repeated rows and NULL keys are kept; other columns are not read; an empty table gives no rows.
    """
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(key).alias("_key"), held_out(key).alias("held_out"), F.col(text).alias("_text"))

    def make(batch: pa.RecordBatch) -> dict:
        weights = shared.value
        texts = [t or "" for t in batch.column("_text").to_pylist()]
        row, buckets = features(texts)
        counts = np.bincount(row, minlength=len(texts)) + PRIOR
        sums = np.bincount(row, weights=weights[buckets], minlength=len(texts)) + PRIOR * weights[TEXT]
        score = 1 / (1 + np.exp(-np.clip(sums / counts, -50, 50)))
        return {"_key": batch.column("_key"), "held_out": batch.column("held_out"), "score": score,
                "predicted": (score >= cut_off).astype(np.int32)}

    schema = f"_key {kind}, held_out boolean, score double, predicted int"
    return map_text(rows, "_text", schema, make, CHARS).withColumnRenamed("_key", key)

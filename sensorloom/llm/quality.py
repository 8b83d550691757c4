"""Quality rules: statistics that rules are about, and an isolation forest over them.

Rules look at one statistic each. The forest looks at all: each of its trees splits a small sample of documents at random
until they stand alone, and a document that random splits isolate early, averaged over the trees, is an anomaly. A
forest needs its anomalies to be rare, so it grows on documents labelled good with a few (`CONTAMINATION`) labelled bad
among them. How early is too early is learned from labelled rows too: the threshold is the one that catches most
documents labelled bad while it rejects no more than `MAX_FALSE` of those labelled good. Documents that fail the rules
take no part in either.

The forest is fitted on the driver from the statistics of at most `SAMPLE_ROWS` labelled documents (those whose
identifiers have the smallest hashes); a tree is a few small arrays. Judging is one pass over the documents, without a
shuffle.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.frames import text_of

SAMPLE_ROWS = 20_000
TREES, TREE_ROWS, SEED = 200, 1024, 17
MAX_FALSE, CONTAMINATION = 0.001, 0.005

# The rules' own limits.
MIN_WORDS = 20
MAX_REPEATED = 30  # percent
REPEAT_WINDOW = 8
SYMBOLS = b"#*$%&|<>"

# Rows judged at once where their texts are handed on.
SLICE = 500

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# What the forest splits on, all per word, so that none grows with the length of a text: characters, symbols of the
# rule, words in capitals, ASCII punctuation. (What the rules decide well by themselves, repeats, only blurs it.)
FEATURES = ("word_length", "symbols", "capital_words", "marks")

_MIX = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.array([pow(int(_MIX), i, 1 << 64) for i in range(REPEAT_WINDOW)], np.uint64)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of eight words which occurs at least twice, the first occurrence included."""
    if len(words) <= REPEAT_WINDOW:
        return 0
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    count = len(words) - REPEAT_WINDOW + 1
    windows = np.zeros(count, np.uint64)
    for i, power in enumerate(_POWERS):
        windows += hashes[i : i + count] * power
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    again = np.zeros(count, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:count] += again
    edges[REPEAT_WINDOW:] -= again
    return int((np.cumsum(edges) > 0).sum())


def statistics(text: str) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """The rules' counts and the forest's shares of one text."""
    data = text.encode()
    words = data.split()  # of bytes: white space is the six ASCII characters
    lines = [line for line in data.split(b"\n") if line.strip()]
    n, size = len(words), max(len(words), 1)
    used = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    chars = len(text) - (len(data) - sum(map(len, words)))
    symbols = int(used[list(SYMBOLS)].sum())
    dup_lines, repeats = len(lines) - len(set(lines)), repeated_words(words)
    marks = int(used[33:48].sum() + used[58:65].sum() + used[91:97].sum() + used[123:127].sum())
    capital = sum(map(bytes.isupper, words))
    shares = (chars / size, symbols / size, capital / size, marks / size)
    return (n, chars, symbols, dup_lines, repeats), shares


def base_failed(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MAX_REPEATED * counts[:, 0])


def _average_path(n: np.ndarray) -> np.ndarray:
    """Mean depth at which a search in a random tree of `n` rows ends."""
    n = np.maximum(np.asarray(n, float), 1.0)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / n, (n > 1) * 1.0)


@dataclass(frozen=True)
class Forest:
    """Trees as arrays by node: the share split on (-1: a leaf), the split value, the left child (the right one follows
    it), and for leaves the path length. Scores lie between 0 and 1; those above `threshold` are anomalies."""

    feature: np.ndarray
    split: np.ndarray
    child: np.ndarray
    path: np.ndarray
    rows: int
    threshold: float = np.inf

    def scores(self, shares: np.ndarray) -> np.ndarray:
        total = np.zeros(len(shares))
        at_row = np.arange(len(shares))
        for feature, split, child, path in zip(self.feature, self.split, self.child, self.path):
            node = np.zeros(len(shares), np.int64)
            while (inner := feature[node] >= 0).any():
                right = shares[at_row, np.maximum(feature[node], 0)] >= split[node]
                node = np.where(inner, child[node] + right, node)
            total += path[node]
        return 2.0 ** (-total / len(self.feature) / max(_average_path(np.array(self.rows)), 1e-9))


def grow_forest(shares: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = SEED) -> Forest:
    rng = np.random.default_rng(seed)
    rows = min(tree_rows, len(shares))
    deepest, size = max(1, int(np.ceil(np.log2(max(rows, 2))))), 4 * rows
    feature, child = np.full((trees, size), -1), np.zeros((trees, size), np.int64)
    split, path = np.zeros((trees, size)), np.zeros((trees, size))
    for tree in range(trees):
        free = 1
        waiting = [(0, 0, shares[rng.choice(len(shares), rows, replace=False)])]
        while waiting:
            node, depth, part = waiting.pop()
            low, high = part.min(0), part.max(0)
            varied = np.flatnonzero(high > low)
            if depth == deepest or len(varied) == 0:
                path[tree, node] = depth + _average_path(np.array(len(part)))
                continue
            column = rng.choice(varied)
            value = rng.uniform(low[column], high[column])
            value = value if value > low[column] else high[column]
            right = part[:, column] >= value
            feature[tree, node], split[tree, node], child[tree, node] = column, value, free
            waiting += [(free, depth + 1, part[~right]), (free + 1, depth + 1, part[right])]
            free += 2
    return Forest(feature, split, child, path, rows)


def calibrated(forest: Forest, shares: np.ndarray, bad: np.ndarray, max_false: float = MAX_FALSE) -> Forest:
    """The lowest threshold that at most `max_false` of the good rows exceed; none if either kind is missing."""
    if not bad.any() or bad.all():
        return forest
    good = np.sort(forest.scores(shares[~bad]))
    threshold = good[len(good) - 1 - int(max_false * len(good))]
    return Forest(forest.feature, forest.split, forest.child, forest.path, forest.rows, float(threshold))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, max_false: float = MAX_FALSE) -> Forest | None:
    """Forest and threshold from at most `sample_rows` labelled documents; `None` where no document is labelled.

    Labels with a null identifier or null quality do not count; of several labels for one document the better holds. The
    bound holds for the rows that reach the driver: repeated documents count once.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("good"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = F.broadcast(known.orderBy(*order).limit(sample_rows))
    texts = docs.select("doc_id", text_of("text").alias("text")).join(chosen, "doc_id")
    kind = texts.schema["doc_id"].dataType.simpleString()

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            counts, failed, shares = measured_rows(frame["text"])
            yield pd.DataFrame({"doc_id": frame["doc_id"], "good": frame["good"], "shares": shares.tolist()})[~failed]

    measured = texts.mapInPandas(measure, f"doc_id {kind}, good int, shares array<double>")
    rows = measured.groupBy("doc_id").agg(F.min(F.struct("good", "shares")).alias("row")).select("doc_id", "row.*")
    sample = rows.toPandas().sort_values("doc_id")
    if not len(sample):
        return None
    shares, bad = np.array(sample["shares"].tolist(), float), sample["good"].to_numpy() == 0
    return calibrated(grow_forest(mixed(shares, bad)), shares, bad, max_false)


def mixed(shares: np.ndarray, bad: np.ndarray, contamination: float = CONTAMINATION) -> np.ndarray:
    """The good rows and so many of the bad ones; all, where none is good."""
    few = int(np.ceil(contamination * (~bad).sum()))
    return np.concatenate([shares[~bad], shares[bad][:few]]) if few else shares


def judged(docs: DataFrame, forest: Forest | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: `doc_id`, the counts, `base_failed`, `kept` (neither the rules nor the forest object) and `score`.

    A null text has no words, so it fails the rules; a null identifier is carried; repeated rows are judged alike; other
    columns are ignored; an empty table gives an empty result. Without a forest the rules decide alone.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    counts_schema = ", ".join(f"{c} bigint" for c in COUNTS)
    names = ["doc_id", *COUNTS, "base_failed", "kept", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, failed, score = _verdicts(batch.column("text"), forest)
            kept = ~failed & (score <= (forest.threshold if forest else np.inf))
            made = [*(pa.array(c) for c in counts.T), pa.array(failed), pa.array(kept), pa.array(score)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made], names)

    return texts.mapInArrow(run, f"doc_id {kind}, {counts_schema}, base_failed boolean, kept boolean, score double")


def keep_good(docs: DataFrame, forest: Forest | None, text_col: str = "text") -> DataFrame:
    """The rows that `judged` keeps, with all their columns."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, SLICE):  # whole texts go back: few at a time
                part = batch.slice(begin, SLICE)
                _, failed, score = _verdicts(part.column(at), forest)
                yield part.filter(pa.array(~failed & (score <= (forest.threshold if forest else np.inf))))

    # Under plain names meanwhile, as those of other columns may hold any character.
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


def measured_rows(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts, whether the rules fail, and shares, of texts that may be null."""
    measured = [statistics(text or "") for text in texts]
    counts = np.array([m[0] for m in measured], np.int64).reshape(len(measured), len(COUNTS))
    shares = np.array([m[1] for m in measured], float).reshape(len(measured), len(FEATURES))
    return counts, base_failed(counts), shares


def _verdicts(texts: pa.Array, forest: Forest | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    counts, failed, shares = measured_rows(text.as_py() for text in texts)
    return counts, failed, forest.scores(shares) if forest else np.zeros(len(failed))

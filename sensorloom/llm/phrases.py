"""Phrase collocations: phrases of two to four words whose words come together more often than apart.

1. *Words.* Counted per language. A phrase is no more frequent than its words, so a rare word ends a run of words: which
   words are frequent, tasks know from a bit table of fixed size (a chance hit costs work, not correctness).
2. *Suffixes.* Every word with the words after it, four at most, within its piece of text. Each task folds equal ones, so a
   passage that many documents share is one row per task, and routes them by their leading two words, so that all
   suffixes that begin alike meet in one place.
3. *Hot leads.* Two words that begin too many suffixes for one place are routed by three, and three such words by four;
   what their own count needs is summed in the task. Which leads are hot is known from the first pass.
4. *Sort.* In its place, pointers to suffixes are sorted by multikey three-way quicksort, word by word: a pivot parts
   them into smaller, equal and larger; the size of an equal part is the count of a phrase, and it is parted by the next
   word. Parts below the least count are abandoned, whatever their depth, and nothing is sorted beyond four words.
5. *Scores* by joins of the frequent phrases with their own parts.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.llm.frames import stored

# What ends a piece of text, and the language of texts without one.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
NO_LANG = "und"
LEAST = 30
DEPTH = 4
SCALE = 2_000_000
# A candidate goes if a longer one that holds it comes to this many percent of its count.
INSIDE = 80
TOP = 2_000

# Words whose suffixes a task folds together, and suffixes that meet in one place.
CHUNK = 2_000_000
PLACE = 4_000_000
# Slots of the table of frequent words.
SLOTS = 1 << 20
# A lead with this share of a chunk is reported, if it occurs a few times at all. It is hot with this share of all words,
# but only where it would fill a quarter of a place: so at most HOT leads of each length are hot.
HOT, REPORTED = 1 << 16, 16
# Tasks that share in finding one language's first phrases.
SALTS = 32

_TO_PIECES = bytes.maketrans(PIECE_ENDS + b"\t", b"." * len(PIECE_ENDS) + b" ")


class Codes(dict):
    """A number from 1 on for each word, in order of first use; 0 for the end of a piece and for words not wanted."""

    def __init__(self, wanted=None) -> None:
        super().__init__({b".": 0})
        self.words, self.wanted = [b""], wanted

    def __missing__(self, word: bytes) -> int:
        code = 0
        if self.wanted is None or self.wanted[xxhash.xxh64_intdigest(word, 42) & (SLOTS - 1)]:
            code = len(self.words)
            self.words.append(word)
        if code or len(self) < CHUNK:
            self[word] = code
        return code


def words_of(texts: list[str]) -> list[bytes]:
    """The words of all texts, with `.` where a piece ends. Only A-Z are lowered."""
    joined = b".".join(text.encode().lower().translate(_TO_PIECES) for text in texts)
    return joined.replace(b".", b" . ").split()


def _chunks(batches: Iterator[pa.RecordBatch], wanted=None) -> Iterator[tuple[str, np.ndarray, list[bytes]]]:
    """Per language: codes of words in a row, 0 between pieces, and the words. A chunk ends with a document."""
    held: dict[str, tuple[Codes, list[np.ndarray]]] = {}
    size = 0

    def emptied():
        for lang, (codes, found) in held.items():
            yield lang, np.concatenate(found), codes.words
        held.clear()

    for batch in batches:
        langs, texts = batch.column("lang").to_pylist(), batch.column("text")
        order: dict[str, list[int]] = {}
        for i, lang in enumerate(langs):
            order.setdefault(lang, []).append(i)
        for lang, rows in order.items():
            for begin in range(0, len(rows), 256):
                words = words_of([texts[i].as_py() for i in rows[begin : begin + 256]])
                codes, found = held.setdefault(lang, (Codes(wanted), []))
                found.append(np.fromiter(map(codes.__getitem__, words), np.int32, len(words)))
                found.append(np.zeros(1, np.int32))
                size += len(words)
                if size >= CHUNK:
                    yield from emptied()
                    size = 0
    yield from emptied()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows `lang`, `phrase`, `size`, `n`: all words (size 1), and leads of two and three words that fill much of a chunk."""
    for lang, codes, words in _chunks(batches):
        counts = np.bincount(codes, minlength=len(words))
        used = np.flatnonzero(counts[1:]) + 1
        phrases, sizes, n = [words[i] for i in used], [1] * len(used), list(counts[used])
        second, third = np.append(codes[1:], 0), np.append(codes[2:], [0, 0])[: len(codes)]
        lead = np.flatnonzero((codes > 0) & (second > 0))
        base = len(words)
        for length in (2, 3):
            keys = codes[lead].astype(np.int64) * base + second[lead]
            if length == 3:
                lead = lead[third[lead] > 0]
                keys = codes[lead].astype(np.int64) * base + second[lead]
                # Only three words that begin with a large pair can be large.
                large = np.isin(keys, big)
                lead, keys = lead[large], np.searchsorted(big, keys[large]) * base + third[lead[large]]
            values, times = np.unique(keys, return_counts=True)
            kept = times >= max(REPORTED, len(codes) / HOT)
            values, times = values[kept], times[kept]
            if length == 2:
                big = values
            for value, count in zip(values.tolist(), times.tolist()):
                rest, last = divmod(value, base)
                first = [rest] if length == 2 else divmod(int(big[rest]), base)
                phrases.append(b" ".join(words[c] for c in (*first, last)))
                sizes.append(length)
                n.append(count)
        arrays = [pa.array([lang] * len(n), pa.string()), pa.array([p.decode() for p in phrases], pa.string())]
        arrays += [pa.array(sizes, pa.int32()), pa.array(np.array(n, np.int64))]
        yield pa.RecordBatch.from_arrays(arrays, ["lang", "phrase", "size", "n"])


def _folded(columns: list[np.ndarray], weight: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Equal rows become one, in order."""
    if not len(weight):
        return columns, weight
    keys = [a.astype(np.int64) << 32 | b for a, b in ((columns[0], columns[1]), (columns[2], columns[3]))]
    order = np.lexsort((keys[1], keys[0]))
    keys, weight = [k[order] for k in keys], weight[order]
    first = np.append(True, (keys[0][1:] != keys[0][:-1]) | (keys[1][1:] != keys[1][:-1]))
    edges = np.flatnonzero(first)
    return [c[order][edges] for c in columns], np.add.reduceat(weight, edges)


def suffixes(codes: np.ndarray) -> list[np.ndarray]:
    """Columns of up to four words from each word that has one after it; 0 beyond the end of a piece."""
    padded = np.append(codes, np.zeros(DEPTH, codes.dtype))
    columns = [padded[i : i + len(codes)] for i in range(DEPTH)]
    keep = (columns[0] > 0) & (columns[1] > 0)
    columns = [c[keep] for c in columns]
    for i in range(1, DEPTH):
        columns[i] = np.where(columns[i - 1] > 0, columns[i], 0)
    return columns


def _routed(
    batches: Iterator[pa.RecordBatch], wanted: np.ndarray, hot: dict[str, set[bytes]], places: int
) -> Iterator[pa.RecordBatch]:
    """Suffixes by place. Rows `place`, `lang`, `lead` (words that routed them), `words`, `columns`, `weight`."""
    for lang, codes, words in _chunks(batches, wanted):
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)
        number = {word: i for i, word in enumerate(words)}
        leads = [tuple(map(number.get, phrase.split(b" "))) for phrase in hot.get(lang, ())]
        columns = suffixes(codes)
        columns, weight = _folded(columns, np.ones(len(columns[0]), np.int64))
        for lead in range(2, DEPTH + 1):
            longer = _begins(columns, lead, [x for x in leads if len(x) == lead and None not in x])
            # Of a hot lead, its own count stays here; what follows it is routed by a word more.
            own = [np.where(longer, 0, c) if i >= lead else c for i, c in enumerate(columns)]
            own, own_weight = _folded(own, weight) if longer.any() else (own, weight)
            if len(own_weight):
                yield _rows(lang, lead, own, own_weight, _mixed(own[:lead], hashes) % np.uint64(places), words)
            if not longer.any():
                break
            longer &= columns[lead] > 0
            columns, weight = [c[longer] for c in columns], weight[longer]


def _mixed(columns: list[np.ndarray], hashes: np.ndarray) -> np.ndarray:
    total = np.full(len(columns[0]), len(columns), np.uint64)
    for column in columns:
        total = (total ^ hashes[column]) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
    return total


def _begins(columns: list[np.ndarray], lead: int, leads: list[tuple[int, ...]]) -> np.ndarray:
    """Whether a suffix begins with one of the leads."""
    if not leads:
        return np.zeros(len(columns[0]), bool)
    heads = {head: i for i, head in enumerate(sorted({x[:2] for x in leads}))}
    keys = np.array([a << 32 | b for a, b in heads])
    own = columns[0].astype(np.int64) << 32 | columns[1]
    at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
    found = keys[at] == own
    if lead == 3:
        found &= np.isin(at << 32 | columns[2], [heads[x[:2]] << 32 | x[2] for x in leads])
    return found


def _rows(lang, lead, columns, weight, place, words) -> pa.RecordBatch:
    order = np.argsort(place, kind="stable")
    place, weight, columns = place[order], weight[order].astype("<u4"), np.stack(columns)[:, order]
    edges = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    dictionaries, data, weights = [], [], []
    for begin, end in zip(edges, np.append(edges[1:], len(place))):
        used, codes = np.unique(columns[:, begin:end], return_inverse=True)
        dictionaries.append(b"\n".join([words[c] for c in used]))
        data.append(codes.astype(_code(len(used))).tobytes())
        weights.append(weight[begin:end].tobytes())
    arrays = [pa.array(place[edges].astype(np.int64)), pa.array([lang] * len(edges), pa.string())]
    arrays.append(pa.array([lead] * len(edges), pa.int32()))
    arrays += [pa.array(c, pa.binary()) for c in (dictionaries, data, weights)]
    return pa.RecordBatch.from_arrays(arrays, ["place", "lang", "lead", "words", "columns", "weight"])


def _code(words: int) -> str:
    return "<u2" if words <= 1 << 16 else "<u4"


def sorted_counts(columns: list[np.ndarray], weight: np.ndarray, least: int = LEAST, lead: int = 1) -> Iterator[tuple[tuple[int, ...], int]]:
    """Phrases of `lead` words or more and their counts, those of `least` and above, by multikey three-way quicksort of
    pointers to the suffixes. `columns` hold the suffixes' words, 0 for none."""
    work = [(np.arange(len(weight), dtype=np.int32), 0, ())]
    while work:
        pointers, depth, prefix = work.pop()
        words = columns[depth][pointers]
        pivot = words[len(words) // 2]
        equal = words == pivot
        less = words < pivot
        for part in (pointers[less], pointers[~(less | equal)]):
            if _enough(part, weight, least):
                work.append((part, depth, prefix))
        same = pointers[equal]
        if not pivot or not _enough(same, weight, least):
            continue
        phrase = (*prefix, int(pivot))
        if depth + 1 >= lead:
            yield phrase, int(weight[same].sum())
        if depth + 1 < len(columns):
            work.append((same, depth + 1, phrase))


def _enough(pointers: np.ndarray, weight: np.ndarray, least: int) -> bool:
    return len(pointers) > 0 and (len(pointers) >= least or weight[pointers].sum() >= least)


def _phrases_of_place(rows: pa.Table, least: int) -> pa.Table:
    """The frequent phrases of one place."""
    sets: dict[tuple[str, int], list[int]] = {}
    for i, (lang, lead) in enumerate(zip(rows.column("lang").to_pylist(), rows.column("lead").to_pylist())):
        sets.setdefault((lang, lead), []).append(i)
    langs, phrases, sizes, counts = [], [], [], []
    for (lang, lead), chosen in sets.items():
        number: dict[bytes, int] = {b"": 0}
        parts, weights = [], []
        for i in chosen:
            words = rows.column("words")[i].as_py().split(b"\n")
            local = np.array([number.setdefault(w, len(number)) for w in words], np.int32)
            codes = np.frombuffer(rows.column("columns")[i].as_buffer(), _code(len(words)))
            parts.append(local[codes].reshape(DEPTH, -1))
            weights.append(np.frombuffer(rows.column("weight")[i].as_buffer(), "<u4"))
        columns, known, weight = list(np.concatenate(parts, 1)), list(number), np.concatenate(weights)
        parts.clear()
        for phrase, count in sorted_counts(columns, weight, least, lead):
            langs.append(lang)
            phrases.append(b" ".join(known[c] for c in phrase).decode())
            sizes.append(len(phrase))
            counts.append(count)
    return pa.table(
        [pa.array(langs, pa.string()), pa.array(phrases, pa.string()), pa.array(sizes, pa.int32()), pa.array(counts, pa.int64())],
        ["lang", "phrase", "size", "a"],
    )


def frequent_phrases(docs: DataFrame, least: int = LEAST, per_place: int = PLACE) -> tuple[DataFrame, DataFrame]:
    """All phrases of one to four words that occur `least` times or more in a language (`lang`, `phrase`, `size`, `a`), and
    every language's number of words (`lang`, `n`). Null texts are empty; a null language is `und`."""
    texts = docs.select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    counted = texts.mapInArrow(_counted, "lang string, phrase string, size int, n bigint")
    counted = stored(counted.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("a")))
    words = counted.where("size = 1")
    totals = stored(words.groupBy("lang").agg(F.sum("a").alias("n")))
    all_words = totals.agg(F.sum("n").alias("n")).first()["n"] or 0
    frequent = words.where(F.col("a") >= least)
    # At most SLOTS numbers, and HOT leads of each length: their counts add up to no more than all words.
    slots = frequent.select(F.pmod(F.xxhash64("phrase"), F.lit(SLOTS)).alias("slot")).distinct().collect()
    wanted = np.zeros(SLOTS, bool)
    wanted[[row["slot"] for row in slots]] = True
    hot: dict[str, set[bytes]] = {}
    for row in counted.where((F.col("size") > 1) & (F.col("a") >= max(all_words / HOT, per_place / 4))).collect():
        hot.setdefault(row["lang"], set()).add(row["phrase"].encode())
    places = max(1, -(-all_words // per_place))
    routed = texts.mapInArrow(
        lambda batches: _routed(batches, wanted, hot, places),
        "place bigint, lang string, lead int, words binary, columns binary, weight binary",
    )

    def phrases_of(rows: pa.Table) -> pa.Table:
        return _phrases_of_place(rows, least)

    longer = routed.groupBy("place").applyInArrow(phrases_of, "lang string, phrase string, size int, a bigint")
    return stored(frequent.select("lang", "phrase", "size", "a").union(longer)), totals


def collocations(docs: DataFrame, least: int = LEAST, inside: int = INSIDE, top: int = TOP, per_place: int = PLACE) -> DataFrame:
    """Each language's first `top` phrases: `lang`, `rank`, `phrase`, `a` (its count), `l` and `r` (those of its parts at the
    lowest-scoring cut), `n` (the language's words), `score`.

    A null text has no words; a null language is `und`, together with rows that say so. Repeated rows count as often as they
    occur, identifiers and other columns are ignored, ties are broken by count and then by the phrase's bytes. An empty table
    gives an empty result.
    """
    counts, totals = frequent_phrases(docs, least, per_place)
    candidates = counts.where("size > 1").withColumn("words", F.split("phrase", " "))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumn("first", F.expr("array_join(slice(words, 1, k), ' ')"))
    cuts = cuts.withColumn("rest", F.expr("array_join(slice(words, k + 1, size - k), ' ')"))
    of = lambda part, name: counts.select("lang", F.col("phrase").alias(part), F.col("a").alias(name))
    cuts = cuts.join(of("first", "l"), ["lang", "first"]).join(of("rest", "r"), ["lang", "rest"])
    # Exact beyond 64 bits.
    score = F.expr(f"cast(a as decimal(20, 0)) * {SCALE} div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))")
    scored = cuts.withColumn("score", score.cast("bigint"))
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    scored = scored.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    spans = F.expr(
        """flatten(transform(sequence(2, size - 1), len ->
             transform(sequence(1, size - len + 1), at -> array_join(slice(words, at, len), ' '))))"""
    )
    holders = candidates.where("size > 2").select("lang", F.explode(spans).alias("phrase"), F.col("a").alias("longer"))
    holders = holders.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    joined = scored.join(holders, ["lang", "phrase"], "left")
    enough = F.expr(f"cast(longer as decimal(20, 0)) * 100 >= cast(a as decimal(20, 0)) * {inside}")
    kept = joined.where(~F.coalesce(enough, F.lit(False))).drop("longer")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = Window.partitionBy("lang", "salt").orderBy(*order)
    kept = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    # The first of each salt hold the first of all, so the last step sees a bounded number of a language's phrases.
    kept = kept.withColumn("place", F.row_number().over(salted)).where(F.col("place") <= top).drop("salt", "place")
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

"""BPE encoding by backtracking over longest matches, and decoding by an offset table.

Plain BPE merges the best pair of a word again and again. The same tokens come out of one pass from left to right: at
each place take the longest token that matches there; keep it if it may stand after the token before it; else try the
next shorter one; with none left, take back the token before. Places that failed once are never tried again, so the work
is linear in the word.

* Longest matches come from an Aho-Corasick automaton over the vocabulary: one run over the word gives the longest token
  at each of its places.
* Two tokens may stand next to each other unless BPE would, while making them, have merged across the border. Along its
  border each token shows a row of smaller parts, each until the merge that takes it up; a pair of facing parts that are
  both there when their own merge is due makes the tokens incompatible. Answers are kept in a table.

Decoding gathers the bytes of all tokens from one buffer by offsets, without a loop over tokens.
"""

import functools
import hashlib
import json
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.encoding import SEPARATORS, Memory, byte_letters, finder, lowered
from sensorloom.llm.frames import text_of

# Stands for the end of a word within tokens; no byte is mapped to it.
_END = "\x00"
_NEVER = 1 << 60


class Offsets:
    """Strings of all ids in one buffer, each followed by a space; ids that have no string are refused."""

    def __init__(self, strings: list[bytes]) -> None:
        self.buffer = np.frombuffer(b"".join(s + b" " for s in strings), np.uint8)
        self.starts = np.concatenate([[0], np.cumsum([len(s) + 1 for s in strings])]).astype(np.int64)

    def joined(self, ids: np.ndarray) -> bytes:
        if not len(ids):
            return b""
        if ids.max() >= len(self.starts) - 1:
            raise ValueError(f"no token has the id {ids.max()}")
        begin = self.starts[ids]
        sizes = self.starts[ids.astype(np.int64) + 1] - begin
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1]) + np.repeat(begin - ends + sizes, sizes)
        return self.buffer[places[:-1]].tobytes()


class WordBpe:
    """A lower-casing BPE whose words end in a suffix, read from a tokenizers file."""

    def __init__(self, path: str) -> None:
        import ahocorasick

        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model, vocabulary = data["model"], data["model"]["vocab"]
        self.suffix = model["end_of_word_suffix"]
        self.special = {token["content"]: token["id"] for token in data["added_tokens"]}
        self.find_words = finder(data["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.letters = byte_letters()

        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        size = max(*vocabulary.values(), *self.special.values()) + 1
        self.rank = {(vocabulary[a], vocabulary[b]): rank for rank, (a, b) in enumerate(merges)}
        self.parts: list = [None] * size
        self.made = [-1] * size  # rank of the merge that makes the token
        for a, b in merges:
            token, pair = vocabulary[a + b], (vocabulary[a], vocabulary[b])
            if self.parts[token] is not None or self.rank[pair] <= max(self.made[pair[0]], self.made[pair[1]]):
                raise ValueError("merges have to be in order, one for each token")
            self.parts[token], self.made[token] = pair, self.rank[pair]
        self.pairs = Memory(self._compatible, 500_000)

        written = {}
        for text, token in vocabulary.items():
            if token not in self.special.values():
                ended = text.endswith(self.suffix)
                written[token] = text[: -len(self.suffix)] + _END if ended else text
        self.length = [len(written.get(i, "")) for i in range(size)]
        by_text = {written[i]: i for i in written if self.parts[i] is None or self._whole(i)}
        self.matches = ahocorasick.Automaton()
        for text, token in by_text.items():
            self.matches.add_word(text, token)
        self.matches.make_automaton()
        # The longest token that a token begins with.
        self.shorter = [-1] * size
        for text, token in by_text.items():
            self.shorter[token] = next((by_text[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in by_text), -1)

        names = dict((i, t) for t, i in vocabulary.items()) | {i: t for t, i in self.special.items()}
        self.table = Offsets([names.get(i, "").encode() for i in range(size)])
        self.decimals = Offsets([str(i).encode() for i in range(size)])
        self.words = Memory(self._pieces)

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The parts seen at the token's left (0) or right (1) border, with the rank of the merge that takes each up."""
        seen, until = [], _NEVER
        while True:
            seen.append((token, until))
            if self.parts[token] is None:
                return seen
            until, token = self.made[token], self.parts[token][side]

    def _compatible(self, pair: tuple[int, int]) -> bool:
        return self._crossing(*pair) == _NEVER

    def _crossing(self, left: int, right: int) -> int:
        """The rank of a merge across the border, if any is due. Of equal merges, the one further left comes first."""
        facing = self._edge(right, 0)
        for a, a_until in self._edge(left, 1):
            for b, b_until in facing:
                due = self.rank.get((a, b), _NEVER)
                if due < a_until and due <= b_until and due != _NEVER:
                    return due
        return _NEVER

    def _whole(self, token: int) -> bool:
        """Whether BPE makes this token of its own text: nothing crosses the border of its halves before their merge."""
        left, right = self.parts[token]
        made, facing = self.made[token], self._edge(right, 0)
        halves = all(self.parts[half] is None or self._whole(half) for half in (left, right))
        return halves and not any(
            self.rank.get((a, b), _NEVER) < min(a_until, b_until + 1, made)
            for a, a_until in self._edge(left, 1)
            for b, b_until in facing
        )

    def encode_word(self, text: str) -> list[int]:
        """Tokens of one word, written in byte letters with the end mark."""
        size = len(text)
        longest = [-1] * size
        for last, token in self.matches.iter(text):
            longest[last - self.length[token] + 1] = token
        failed, path, at, token = set(), [], 0, longest[0]
        while at < size:
            while token >= 0:
                after = at + self.length[token]
                if after not in failed and (not path or self.pairs[path[-1], token]):
                    break
                token = self.shorter[token]
            if token >= 0:
                path.append(token)
                at = after
                token = longest[at] if at < size else -1
            else:
                failed.add(at)
                token = path.pop()
                at -= self.length[token]
                token = self.shorter[token]
        return path

    def _pieces(self, chunk: str) -> bytes:
        """Ids of a stretch without white space, lowered."""
        stem = chunk.rstrip(string.punctuation)
        if stem and stem != chunk and stem[-1].isalpha():
            return self.words[stem] + self._encoded(chunk[len(stem) :])
        return self._encoded(chunk)

    def _encoded(self, chunk: str) -> bytes:
        ids = []
        for word in self.find_words(chunk):
            ids += self.encode_word("".join(map(self.letters.__getitem__, word.encode())) + _END)
        return np.array(ids, "<u4").tobytes()

    def _plain(self, text: str) -> bytes:
        low = lowered(text)
        chunks = _CHUNK.findall(low) if SEPARATORS.search(low) else low.split()
        return b"".join(map(self.words.__getitem__, chunks))

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text; special tokens' strings in it count as those tokens."""
        if not any(s in text for s in self.special):
            return np.frombuffer(self._plain(text), "<u4")
        cut = re.split("(" + "|".join(map(re.escape, self.special)) + ")", text)
        ids = (self.special[p].to_bytes(4, "little") if p in self.special else self._plain(p) for p in cut)
        return np.frombuffer(b"".join(ids), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens' strings, joined by a space, in UTF-8: what a tokenizer without a decoder gives."""
        return self.table.joined(ids)


# What Unicode calls white space.
_CHUNK = re.compile("[^\t-\r \x85\xa0  -     　]+")


@functools.cache
def word_bpe(path: str) -> WordBpe:
    """One per worker process, so that words and pairs stay known from task to task."""
    return WordBpe(path)


def encoded(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id`, `ids` (little-endian unsigned 32-bit integers) and `decoded` (UTF-8) per document.

    A null text is empty and has no ids; a null identifier is carried; repeated rows stay; other columns are ignored; an
    empty table gives an empty result.
    """

    def rows(bpe: WordBpe, text: str):
        ids = bpe.encode(text)
        return ids.tobytes(), bpe.decode(ids)

    return _mapped(docs, tokenizer, id_col, text_col, rows, {"ids": "binary", "decoded": "binary"})


def digests(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id`, `n_tokens`, and checksums of the decimal ids and of the decoded text; nulls as in `encoded`."""

    def rows(bpe: WordBpe, text: str):
        ids = bpe.encode(text)
        decimal, back = bpe.decimals.joined(ids), bpe.decode(ids)
        return len(ids), hashlib.sha256(decimal).hexdigest(), hashlib.sha256(back).hexdigest()

    columns = {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    return _mapped(docs, tokenizer, id_col, text_col, rows, columns)


def _mapped(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, rows, columns: dict[str, str]) -> DataFrame:
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kinds = {"binary": pa.binary(), "bigint": pa.int64(), "string": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(tokenizer)
        for batch in batches:
            texts = batch.column("text")
            # Few rows at a time: texts may be long, and results are longer.
            for begin in range(0, len(texts), 500):
                part = [rows(bpe, text.as_py()) for text in texts[begin : begin + 500]]
                made = [pa.array(c, kinds[k]) for c, k in zip(zip(*part), columns.values())]
                ids = batch.column("doc_id")[begin : begin + 500]
                yield pa.RecordBatch.from_arrays([ids, *made], ["doc_id", *columns])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{c} {k}" for c, k in columns.items()))

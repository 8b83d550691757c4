"""Token ids as the tokenizers library gives them, from its files, at the speed of tiktoken.

tiktoken's encoder merges by rank as the library does, in linear time. Its ranks are made from the file's own vocabulary
and merges, for two kinds of file:

* byte-level BPE, where a token's rank is its merge;
* lower-casing word BPE, whose words end in a suffix: each word gets an end byte, which merges with the byte before it
  first of all. So a last letter is the suffixed symbol that the file's merges speak of. Words between white space do not
  depend on each other here: a worker keeps those that it has met, within a bound of bytes, and gathers their ids.

Other files, and texts that hold a special token or a control character used here, go to the library itself.
"""

import functools
import json
import os
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Words remembered per generation; two generations are kept, so frequent words stay.
WORDS = 500_000
# Bytes of the words and ids that a worker keeps, and characters of a word worth keeping.
KEPT, KEPT_WORD = 1 << 26, 64
# Characters of the texts that are looked up together.
TOGETHER = 8_000_000
# Python's split() takes these for white space, the tokenizers do not.
SEPARATORS = re.compile(r"[\x1c-\x1f]")
_NOT_WORDS = "\x00\x02\x1c\x1d\x1e\x1f"

# How byte-level BPE cuts a text, and the words of the lower-casing kind.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_LEVEL = r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_END, _MARK = "\x00", "\x02"
PLANE = "\U00010000"


class Memory(dict):
    """Values by key, made when first asked for; the less recent half is forgotten from time to time."""

    def __init__(self, make: Callable, size: int = WORDS) -> None:
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def byte_letters() -> list[str]:
    """The letter that byte-level tokenizers write for each byte: itself where it prints, else from 256 on."""
    prints = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(prints)]
    return [chr(256 + hidden.index(b)) if b in hidden else chr(b) for b in range(256)]


class Words(dict):
    """Ids of words that do not depend on what stands around them. Each word has a number, given when it is first met; `learn`
    takes new words together and returns all their ids in a row, and how many each has. Beyond `kept` bytes, words that were
    met only once since the last time are forgotten."""

    def __init__(self, learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], kept: int = KEPT) -> None:
        super().__init__()
        self.learn, self.kept = learn, kept
        self._forget()

    def _forget(self) -> None:
        self.clear()
        self.new: list[str] = []
        self.ids, self.ends, self.size = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.int64), 0
        self.count, self.uses = 0, np.zeros(0, np.int64)

    def __missing__(self, word: str) -> int:
        self[word] = number = self.count + len(self.new)
        self.new.append(word)
        return number

    def _learn_new(self) -> None:
        ids, counts = self.learn(self.new)
        last = self.ends[self.count - 1] if self.count else 0
        self.ids = _put(self.ids, last, ids)
        self.ends = _put(self.ends, self.count, last + np.cumsum(counts))
        self.size += sum(map(len, self.new)) + 150 * len(self.new) + 4 * len(ids)
        self.count += len(self.new)
        for word in self.new:
            if len(word) > KEPT_WORD:
                del self[word]
        self.new = []

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text's words, which are what stands between white space."""
        # Arrow tells equal words apart faster than a large dictionary does.
        lists = pc.utf8_split_whitespace(pa.array(texts, pa.large_string()))
        words = lists.flatten().dictionary_encode()
        distinct = words.dictionary.to_pylist()
        numbers = np.fromiter(map(self.__getitem__, distinct), np.int64, len(distinct))
        if self.new:
            self._learn_new()
        numbers = numbers[words.indices.to_numpy()]
        ids, sizes = self._ids_of(numbers)
        data, ends = memoryview(ids.astype("<u4", copy=False)).cast("B"), np.append(0, 4 * np.cumsum(sizes))
        edges = ends[lists.offsets.to_numpy()].tolist()
        for begin, end in zip(edges, edges[1:]):
            yield bytes(data[begin:end])
        uses = np.bincount(numbers, minlength=self.count)
        uses[: len(self.uses)] += self.uses
        self.uses = uses
        if self.size > self.kept:
            self._forget_rare()

    def _ids_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ends = self.ends[numbers]
        sizes = ends - np.where(numbers > 0, self.ends[numbers - 1], 0)
        places = np.arange(sizes.sum()) + np.repeat(ends - np.cumsum(sizes), sizes)
        return self.ids[places], sizes

    def _forget_rare(self) -> None:
        met = [(word, number) for word, number in self.items() if self.uses[number] > 1]
        ids, sizes = self._ids_of(np.array([number for _, number in met], np.int64))
        self._forget()
        self.size = sum(len(word) + 150 for word, _ in met) + 4 * len(ids)
        if 2 * self.size > self.kept:
            return self._forget()
        self.update((word, i) for i, (word, _) in enumerate(met))
        self.count, self.ids, self.ends = len(met), _put(self.ids, 0, ids), _put(self.ends, 0, np.cumsum(sizes))


def _put(buffer: np.ndarray, at: int, values: np.ndarray) -> np.ndarray:
    """The values from a place on, in a larger buffer if need be."""
    if at + len(values) > len(buffer):
        buffer = np.concatenate([buffer[:at], np.zeros(at + 2 * len(values), buffer.dtype)])
    buffer[at : at + len(values)] = values
    return buffer


class Encoder:
    """`encode(texts)`: each text's ids as little-endian unsigned 32-bit integers. Special tokens' strings in a text count
    as those tokens, which is the library's default."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        kind = json.loads(self.tokenizer.to_str())
        self.fast = self._spaced(kind)
        self.words = None if self.fast else self._ended(kind)

    def whole(self, text: str) -> bytes:
        """By the library."""
        (found,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return array("I", found.ids).tobytes()

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        waiting, size = [], 0
        for text in texts:
            waiting.append(text)
            size += len(text)
            if size >= TOGETHER:
                yield from self._encoded(waiting)
                waiting, size = [], 0
        yield from self._encoded(waiting)

    def _encoded(self, texts: list[str]) -> Iterator[bytes]:
        plain = [not any(s in text for s in self.special) for text in texts]
        if self.fast:
            yield from (self._by_text(text) if p else self.whole(text) for text, p in zip(texts, plain))
        elif self.words is not None:
            plain = [p and not any(c in text for c in _NOT_WORDS) for text, p in zip(texts, plain)]
            found = self.words.encode([lowered(text) for text, p in zip(texts, plain) if p])
            yield from (next(found) if p else self.whole(text) for text, p in zip(texts, plain))
            next(found, None)
        else:
            yield from map(self.whole, texts)

    def _by_text(self, text: str) -> bytes:
        try:
            return self.fast(text).astype("<u4", copy=False).tobytes()
        except ValueError:  # white space without end: more than the cutting pattern takes
            return self.whole(text)

    def _spaced(self, kind: dict) -> Callable | None:
        """Byte-level BPE whose words take the space before them along."""
        before, model = kind["pre_tokenizer"] or {}, kind["model"]
        plain = before.get("type") == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"]
        if not plain or kind["normalizer"] or model["end_of_word_suffix"] or not _simple(model):
            return None
        encoding, ids = _ranked(model, BYTE_LEVEL)

        def fast(text: str) -> np.ndarray:
            return ids[encoding.encode_to_numpy(text, disallowed_special=())]

        return fast

    def _ended(self, kind: dict) -> Words | None:
        """Lower-casing BPE of words with a suffix, white space dropped."""
        before, model, normal = kind["pre_tokenizer"] or {}, kind["model"], kind["normalizer"] or {}
        split, level = (*(before.get("pretokenizers") or ()), {}, {})[:2]
        pattern = split.get("pattern", {}).get("Regex", "")
        plain = split.get("invert") and split.get("behavior") == "Removed" and pattern.endswith(WORD_LEVEL)
        plain = plain and level.get("type") == "ByteLevel" and not level["add_prefix_space"] and not level["use_regex"]
        steps = [step["type"] for step in normal.get("normalizers", ())]
        if not plain or steps != ["NFC", "Replace", "Lowercase"] or not model["end_of_word_suffix"] or not _simple(model):
            return None
        words = finder(pattern)
        encoding, ids = _ranked(model, f"[^{_END}]+{_END}", model["end_of_word_suffix"])
        mark = ids[256 + ord(_MARK)]

        def learn(new: list[str]) -> tuple[np.ndarray, np.ndarray]:
            found = words(f" {_MARK} ".join([*new, ""]))
            ended = _END.join(found) + _END
            got = ids[encoding.encode_to_numpy(ended, disallowed_special=())]
            cuts = np.flatnonzero(got == mark)
            return np.delete(got, cuts), np.diff(cuts, prepend=-1) - 1

        return Words(learn)


def _letters() -> list[str]:
    """All characters of the planes that hold letters, but surrogates."""
    return list(map(chr, [*range(0xD800), *range(0xE000, 0x40000)]))


def _ranges(runs: list[str]) -> str:
    """Inside of a character class: from the first to the last of each run."""
    return "".join(f"{re.escape(run[0])}-{re.escape(run[-1])}" for run in runs)


@functools.cache
def finder(pattern: str) -> Callable[[str], list[str]]:
    """All matches of a pattern. Which characters are letters, numbers or white space depends on the edition of Unicode: where
    a text holds one that the library and `regex` see differently, the pattern has the library's classes written out."""
    import regex
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    letters = "".join(_letters())
    written, other = pattern, set()
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        spans = [text for text, _ in Split(Regex(f"{name}+"), "removed", invert=True).pre_tokenize_str(letters)]
        written = written.replace(name, _ranges(spans))
        other |= set("".join(spans)) ^ set(regex.findall(name, letters))
    runs = regex.findall(r"\S+", "".join(c if c in other and c < PLANE else " " for c in letters))
    exact, plain = re.compile(written).findall, regex.compile(pattern).findall
    # One range for all other planes: many would be slow to look through, and such characters are rare.
    differs = re.compile(f"[{_ranges(runs)}{PLANE}-\U0003ffff]").search
    return lambda text: exact(text) if not text.isascii() and differs(text) else plain(text)


@functools.cache
def _newer_letters() -> dict[str, str]:
    """Letters whose lower case the library knows and Python does not yet."""
    from tokenizers.normalizers import Lowercase

    letters = [c for c in _letters() if unicodedata.category(c) == "Cn"]
    low = Lowercase().normalize_str("\n".join(letters)).split("\n")
    return {c: small for c, small in zip(letters, low) if c != small}


def lowered(text: str) -> str:
    """In composed form and lower case, character by character, as the final form of a sigma depends on its neighbours
    otherwise."""
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFC", text)
    newer = _newer_letters()
    if any(c in text for c in newer):
        text = text.translate(str.maketrans(newer))
    return "".join(c.lower() for c in text) if "Σ" in text else text.lower()


def _simple(model: dict) -> bool:
    """Nothing but merges."""
    options = ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges")
    return model["type"] == "BPE" and not any(model.get(option) for option in options)


def _ranked(model: dict, pattern: str, suffix: str | None = None):
    """tiktoken's encoder of a file's merges, and the file's id for each of its ranks: single bytes, with a suffix those
    before the end byte, and then merges in order."""
    import tiktoken

    letters, vocabulary = byte_letters(), model["vocab"]
    bytes_of = {letter: bytes([i]) for i, letter in enumerate(letters)}
    end = _END.encode()

    def written(token: str) -> bytes:
        ended = suffix is not None and token.endswith(suffix)
        return b"".join(map(bytes_of.__getitem__, token[: -len(suffix)] if ended else token)) + end * ended

    tokens = [(bytes([i]), letter) for i, letter in enumerate(letters)]
    if suffix:
        tokens += [(bytes([i]) + end, letter + suffix) for i, letter in enumerate(letters)]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    tokens += [(written(a + b), a + b) for a, b in merges]
    ranks = {data: rank for rank, (data, _) in enumerate(tokens)}
    if len(ranks) != len(tokens):
        raise ValueError("each token has to come from one merge")
    ids = np.array([vocabulary.get(token, -1) for _, token in tokens], np.int64)
    return tiktoken.Encoding("merges", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), ids.astype(np.uint32)


@functools.cache
def encoder(path: str) -> Encoder:
    """One per worker process."""
    return Encoder(path)

import pytest

from sensorloom.llm import entry


@pytest.fixture(scope="session")
def byte_bpe() -> str:
    return entry.tokenizer("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def low_bpe() -> str:
    return entry.tokenizer("word_bpe_49k.json")


# Pieces that texts are put together from where white space, case, marks and special tokens matter.
PARTS = [" ", " ", "  ", "\n", " \n", "\t", "\xa0", "\x1c", "\x85", "　", "a", "th", "the", "Then", "ÀÉß", "é", "İ", "Σας"]
PARTS += ["'s", "don't", "'LL", "😀", "日本", "1", "0", "22", "½", "...", "!?", "_", "<|endoftext|>", "<|ENDOFTEXT|>", "<|"]
PARTS += ["</w>", "aaaa", "́", "ﬁ", "\x00", "internationalization", "%%%", "."]


@pytest.fixture(scope="session")
def texts() -> list[str]:
    import random

    rng = random.Random(4)
    made = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(14))) for _ in range(1_500)]
    return [*made, "", "word " * 3_000, "x" * 5_000, "Long, words. " * 700]

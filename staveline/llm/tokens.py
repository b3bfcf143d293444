"""Token ids by public tokenizers, inside a task."""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Callable

import numpy as np

# Letters, digits and signs that all Unicode versions class alike. Texts of these alone
# go to the faster of two libraries that hold the same vocabulary.
_PLAIN = re.compile(
    "[\x00-\u024f\u0400-\u045f\u2010-\u2027\u20ac\u3041-\u3093\u30a1-\u30f3\u4e00-\u9fa5]*"
)

# Longer runs of white space overflow the stack of the faster library.
_LONG_SPACE = re.compile(r"\s{5000}")


def vocabulary_path(name: str) -> str:
    """Place of an installed vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.cache
def load(vocabulary: str):
    """The tokenizer of a file, one thread, without truncation or padding.

    Read once a process: each reading anew leaves some megabytes that are not given back.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary)


@functools.cache
def byte_bpe(vocabulary: str) -> Callable[[bytes], np.ndarray]:
    """ids of a whole text, as little-endian 32-bit numbers, as the tokenizer of the file gives them.

    The merges of the file are ranks as well, so ``tiktoken`` gives the same ids, in a
    quarter of the time; special tokens and rarer characters go to the tokenizer itself.
    """
    import tiktoken
    from public_tokenizers import PATTERN

    tokenizer = load(vocabulary)
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    has_special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
    ranks = {_piece_bytes(p): i for p, i in tokenizer.get_vocab().items() if p not in special}
    fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: bytes) -> np.ndarray:
        words = text.decode("utf-8", "replace")
        plain = words.isascii() or _PLAIN.fullmatch(words)
        if plain and not has_special.search(words) and not _LONG_SPACE.search(words):
            return np.array(fast.encode_ordinary(words), dtype="<u4")
        return np.array(tokenizer.encode(words, add_special_tokens=False).ids, dtype="<u4")

    return encode


@functools.cache
def _byte_letters() -> dict[str, int]:
    """Letter -> byte of byte-level vocabularies: visible bytes are themselves, the others follow 255."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _piece_bytes(piece: str) -> bytes:
    letters = _byte_letters()
    return bytes(letters[c] for c in piece)

"""Chunks of documents as numbers, and their distinct words dealt out by hash.

Words of a whole corpus are many, distinct words are few. A chunk is what one task
reads of some documents: its distinct words, and each document as the numbers of its
words. The words of all chunks meet by hash bucket, where each distinct word is worked
on once; what was found comes back to the chunk, in the order in which it was sent.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard

from staveline.llm.common import ASCII_LOWER

CHUNK_BYTES = 12 << 20


@dataclass
class Chunk:
    key: int
    doc_ids: list[int | None]
    flags: list[bool]
    lengths: np.ndarray  # words of each document
    codes: np.ndarray  # word numbers of all documents, one after the other
    words: list[bytes]  # by number


def squeeze(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, compressed byte by byte of their width."""
    planes = np.ascontiguousarray(numbers, dtype="<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def unsqueeze(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _chunk(held: list[tuple[int | None, bool, bytes]]) -> Chunk:
    digest = xxhash.xxh3_64()
    for doc_id, flag, text in held:
        digest.update(f"{doc_id} {flag} {len(text)} ".encode())
        digest.update(text)
    lengths, codes, words = _numbered([text for _, _, text in held])
    return Chunk(
        int.from_bytes(digest.digest(), "big", signed=True),
        [d for d, _, _ in held],
        [f for _, f, _ in held],
        lengths,
        codes,
        words,
    )


def _numbered(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Words of each text, the numbers of all words, and the distinct words in order of first use."""
    split = pc.ascii_split_whitespace(pa.array(texts, pa.large_binary()).view(pa.large_string()))
    words, starts = split.flatten(), split.offsets.to_numpy()
    # White space at the ends of a text leaves empty words there.
    full = pc.greater(pc.binary_length(words), 0)
    before = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    coded = words.filter(full).view(pa.large_binary()).dictionary_encode()
    numbered = np.diff(before[starts]), coded.indices.to_numpy().astype(np.uint32), coded.dictionary.to_pylist()
    del split, words, full, coded
    pa.default_memory_pool().release_unused()
    return numbered


def chunks(batches: Iterable[pa.RecordBatch], lower: bool = False, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Chunks of rows (doc_id, flag, text): words between ASCII white space, in order.

    A chunk ends with the text that brings it to ``limit`` bytes.

    The key of a chunk is a hash of all it holds, so reading the same rows again in
    the same order gives the same keys.
    """
    held, size = [], 0
    for batch in batches:
        ids, flags, texts = (batch.column(i) for i in range(3))
        for doc_id, flag, value in zip(ids, flags, texts.cast(pa.large_binary())):
            text = value.as_py() or b""
            held.append((doc_id.as_py(), bool(flag.as_py()), text.translate(ASCII_LOWER) if lower else text))
            size += len(text) + 64
            if size >= limit:
                yield _chunk(held)
                held, size = [], 0
    if held:
        yield _chunk(held)


def dealt(chunk: Chunk, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers in order of their bucket, and where each bucket begins."""
    hashed = (xxhash.xxh32_intdigest(w) % buckets for w in chunk.words)
    of_word = np.fromiter(hashed, dtype=np.int64, count=len(chunk.words))
    order = np.argsort(of_word, kind="stable")
    return order, np.searchsorted(of_word[order], np.arange(buckets + 1))


def ordered_blob(order: np.ndarray) -> bytes:
    return squeeze(np.diff(order.astype(np.int64), prepend=0).astype(np.int64) & 0xFFFFFFFF)


def ordered_from(blob: bytes) -> np.ndarray:
    steps = unsqueeze(blob).astype(np.int64)
    return np.cumsum(np.where(steps >= 1 << 31, steps - (1 << 32), steps))


def gathered(starts: np.ndarray, lengths: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Places of the numbers of the chosen lists, one list after the other."""
    n = lengths[chosen]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts[chosen] - (ends - n), n) + np.arange(total)

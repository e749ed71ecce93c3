"""Words of a text as hashes and places, vectorised.

A word is a run of 0-9, A-Z, a-z and characters beyond ASCII; A-Z count as lower case.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

_WORD = np.zeros(129, dtype=bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), 128]] = True
_LOWER = np.zeros(129, dtype=np.uint32)
_LOWER[65:91] = 32
_RADIX = 0x9E3779B97F4A7C15
_RADIX_BACK = pow(_RADIX, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}
BLOCK_CHARS = 1 << 16


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit integers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


# letters of words spread, 0 for what is between words; place 128 stands for all beyond ASCII
_SPREAD = np.where(_WORD, mixed((np.arange(129) + _LOWER).astype(np.uint64)), np.uint64(0))


def powers(radix: int, n: int) -> np.ndarray:
    """The first n powers of an odd radix or more, modulo 2**64."""
    if len(_powers.get(radix, ())) < n:
        with np.errstate(over="ignore"):
            factors = np.full(max(1024, 2 * n), radix, dtype=np.uint64)
            factors[0] = 1
            _powers[radix] = np.cumprod(factors)
    return _powers[radix]


def code_points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def words_of(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end (in code points) of every word of a text."""
    return words_in(code_points(text))


def words_in(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    small = np.minimum(codes, 128)
    inside = _WORD[small]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), starts, ends
    letters = (codes + _LOWER[small])[inside].astype(np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(letters)) - np.repeat(first, lengths)
    with np.errstate(over="ignore"):
        sums = np.add.reduceat(mixed(letters) * powers(_RADIX, int(lengths.max()))[place], first)
    return mixed(sums), starts, ends


def words_of_texts(texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the words of all texts, in blocks of whole texts, and where each text of a block begins among them.

    A block has BLOCK_CHARS code points at most, or is one longer text.
    """
    block: list[str] = []
    size = 0
    for text in texts:
        text = text or ""
        if block and size + len(text) >= BLOCK_CHARS:
            yield _block_words(block)
            block, size = [], 0
        block.append(text)
        size += len(text) + 1
    if block:
        yield _block_words(block)


def _block_words(block: list[str]) -> tuple[np.ndarray, np.ndarray]:
    if len(block) == 1 and len(block[0]) > BLOCK_CHARS:
        words, _, _ = words_of(block[0])
        return words, np.array([0, len(words)])
    joined = "\n" + "\n".join(block) + "\n"
    if joined.isascii():
        spread = _SPREAD[np.frombuffer(joined.encode(), dtype=np.uint8)]
    else:
        codes = code_points(joined)
        spread = _SPREAD[np.minimum(codes, 128)]
        beyond = np.flatnonzero(codes > 127)
        spread[beyond] = mixed(codes[beyond].astype(np.uint64))
    inside = spread != 0
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    with np.errstate(over="ignore"):
        # one running sum over the block; what a word adds, taken back to the powers from 0 on, is its own sum
        sums = np.cumsum(spread * powers(_RADIX, BLOCK_CHARS + 2)[: len(spread)])
        words = mixed((sums[ends - 1] - sums[starts - 1]) * powers(_RADIX_BACK, BLOCK_CHARS + 2)[starts])
    lengths = np.cumsum([len(text) + 1 for text in block])
    return words, np.concatenate([[0], np.searchsorted(starts, lengths)])


def run_digests(words: np.ndarray, first: np.ndarray, n: np.ndarray, radix: int) -> np.ndarray:
    """Digests of the runs of n[i] words that begin at first[i], from one running sum over all words."""
    with np.errstate(over="ignore"):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(words * powers(radix, len(words))[: len(words)])])
        back = powers(pow(radix, -1, 1 << 64), len(words))
        return mixed((sums[first + n] - sums[first]) * back[first] + n.astype(np.uint64))


def grams(words: np.ndarray, n: int, radix: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """Hashes of all runs of n words; of fewer words than that, one of them all; of none, none."""
    n = min(n, len(words))
    if not n:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(len(words) - n + 1, n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            out = out * np.uint64(radix) + words[i : len(words) - n + 1 + i]
    return mixed(out)

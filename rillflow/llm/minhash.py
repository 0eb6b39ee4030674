"""Document fingerprints: one-permutation MinHash.

The shingle hashes (``SHINGLE_WORDS`` words each) of a text are computed once and
dealt into ``BINS`` bins; each bin keeps its smallest hash. An empty bin borrows the
value of a bin that has one, found along a fixed pseudo-random probe sequence that
depends on the empty bin alone (optimal densification), so that equal sets borrow
alike and the estimate stays unbiased. ``BITS`` low-order bits of each bin are packed
into the fingerprint (hexadecimal text). ``likeness`` counts equal bins and corrects
for the chance that two different values share their low bits.

Edge cases: a null text counts as empty; a text without words has the empty
fingerprint, and two of those are alike (1.0), one of those and any other not
(0.0); a text of fewer words than a shingle is one shingle. Equal texts have equal
fingerprints. Very long texts are hashed in pieces of ``PIECE_WORDS`` words.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.llm.common import batch_rows

SHINGLE_WORDS = 5
BINS = 256
BITS = 8
PIECE_WORDS = 1 << 20
#: texts in an Arrow batch
BATCH = 256
#: probes of an empty bin that are laid out in advance; later ones walk on from there
PROBES = 2048

_U = np.uint64
_MUL = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=_U)
_PROBE = np.random.Generator(np.random.PCG64(1)).integers(
    0, BINS, size=(BINS, PROBES), dtype=np.int64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    return h ^ (h >> _U(29))


def shingle_hashes(words: list[str]) -> np.ndarray:
    """A hash for each run of SHINGLE_WORDS words (all words, if fewer)."""
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=_U, count=len(words))
    k = min(SHINGLE_WORDS, len(words))
    n = len(words) - k + 1
    out = np.zeros(n, dtype=_U)
    for i in range(k):
        out += h[i:i + n] * _MUL[i]
    return _mix(out)


def bins(text: str) -> np.ndarray | None:
    """The smallest hash of each bin, empty bins filled; None without words."""
    words = text.split()
    if not words:
        return None
    low = np.full(BINS, np.iinfo(_U).max, dtype=_U)
    filled = np.zeros(BINS, dtype=bool)
    for a in range(0, max(1, len(words) - SHINGLE_WORDS + 1), PIECE_WORDS):
        h = shingle_hashes(words[a:a + PIECE_WORDS + SHINGLE_WORDS - 1])
        at = (h >> _U(56)).astype(np.int64) * BINS >> 8
        np.minimum.at(low, at, h)
        filled[at] = True
    empty = np.flatnonzero(~filled)
    if len(empty):
        donors = np.empty(len(empty), dtype=np.int64)
        todo, step = np.arange(len(empty)), 32
        for p in range(0, PROBES, step):
            tries = _PROBE[empty[todo], p:p + step]
            hit = filled[tries]
            found = hit.any(axis=1)
            donors[todo[found]] = tries[found, hit[found].argmax(axis=1)]
            todo = todo[~found]
            if not len(todo):
                break
        full = np.flatnonzero(filled)
        donors[todo] = full[empty[todo] % len(full)]
        low[empty] = low[donors]
    return low


def fingerprint(text: str) -> str:
    low = bins(text)
    if low is None:
        return ""
    bits = (low[:, None] >> np.arange(BITS, dtype=_U)) & _U(1)
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes().hex()


def likeness(a: str, b: str) -> float:
    """Estimated Jaccard likeness of two fingerprinted texts, 0 to 1."""
    if not a or not b:
        return float(a == b)
    x, y = (np.unpackbits(np.frombuffer(bytes.fromhex(s), np.uint8), bitorder="little")
            .reshape(BINS, BITS) for s in (a, b))
    same = (x == y).all(axis=1).mean()
    chance = 2.0 ** -BITS
    return float(max(0.0, (same - chance) / (1 - chance)))


@lru_cache(maxsize=2 * BATCH)
def _remembered(text: str) -> str:
    """A text that comes again soon (as its neighbour's neighbour) is not hashed anew."""
    return fingerprint(text)


@F.pandas_udf(T.StringType())
def fingerprints(text: pd.Series) -> pd.Series:
    return pd.Series([_remembered(t or "") for t in text], dtype=object)


@F.pandas_udf(T.DoubleType())
def likenesses(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([likeness(x or "", y or "") for x, y in zip(a, b)], dtype=float)


def fingerprinted(docs: DataFrame, out: str, text_col: str = "text") -> DataFrame:
    """``docs`` plus the fingerprint of their text."""
    batch_rows(docs.sparkSession, BATCH)
    return docs.withColumn(out, fingerprints(F.col(text_col)))

"""Byte-level BPE encoding and decoding.

A text is cut by a pattern; each piece is encoded alone. A piece that is a token is
that token; of any other, the neighbouring parts whose joint bytes have the lowest
rank are merged, the leftmost of equal ones first, until no pair has a rank. A segment
tree over the byte positions holds at each position the rank of the pair that
begins there and in its root the leftmost minimum; a merge changes two positions,
each by a walk to the root, so a piece of n bytes takes O(n log n).

The vocabulary file is read on each worker from ``path`` (a parameter: it must exist
on all of them) and kept there; parts that occur again are looked up in a bounded
cache. Nothing is shuffled.

Edge cases: a null or empty text has no ids and decodes to no bytes; repeated rows are
encoded alike; an empty table gives an empty result. Very long texts and very long
pieces are handled whole.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.llm.common import batch_rows, release_memory

#: texts in an Arrow batch
BATCH = 256
#: distinct texts in a generation of a worker's memory
CACHE = 1 << 18
#: the same for a worker that shares its memory with other stages
SMALL_CACHE = 1 << 15
_NONE = 1 << 60  # rank of a position where no pair begins


def put(tree: list[int], k: int, rank: int) -> None:
    """Set leaf ``k`` and the minima above it, as far as they change."""
    if tree[k] == rank:
        return
    tree[k] = rank
    while k > 1:
        low = tree[k ^ 1]
        if rank < low:
            low = rank
        k >>= 1
        if tree[k] == low:
            return
        tree[k] = rank = low


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece by lowest-rank merges, found in a segment tree."""
    n = len(piece)
    if n == 1:
        return [ranks[piece]]
    size = 1 << (n - 1).bit_length()
    get = ranks.get
    tree = [_NONE] * (2 * size)  # leaves: at position i the rank of the pair that begins there
    for i in range(n - 1):
        tree[size + i] = get(piece[i:i + 2], _NONE)
    for k in range(size - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a <= b else b
    end = list(range(1, n + 1))  # where the part that begins at i ends
    before = list(range(-1, n))  # where the part before it begins

    while (low := tree[1]) != _NONE:
        k = 1
        while k < size:  # the leftmost leaf that holds the minimum
            k *= 2
            if tree[k] != low:
                k += 1
        i = k - size
        j = end[i]  # the part to merge with the one at i
        stop = end[i] = end[j]
        if stop < n:
            before[stop] = i
            rank = get(piece[i:end[stop]], _NONE)
        else:
            rank = _NONE
        put(tree, size + j, _NONE)
        put(tree, size + i, rank)
        if i:
            h = before[i]
            put(tree, size + h, get(piece[h:stop], _NONE))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i:end[i]]])
        i = end[i]
    return ids


class Remembered(dict):
    """text -> its ids, for the texts of late: two generations of at most ``most``
    texts each; the older one goes when the newer one is full."""

    def __init__(self, encode, most: int):
        super().__init__()
        self.encode, self.most, self.older = encode, most, {}

    def __missing__(self, text: str) -> tuple[int, ...]:
        ids = self.older.get(text)
        if ids is None:
            ids = self.encode(text)
        if len(text) <= 64:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[text] = ids
        return ids


class _Unclean(Exception):
    """A part that begins or ends with white space."""


class Codec:
    """Encoder and decoder of one vocabulary file (base64 token and rank a line).

    ``pattern`` must start a match at each single space between two other characters,
    as the patterns of byte-level BPE do (``\\s`` characters meet only others of their
    kind in a match, but for one leading space): a text is cut there first, and
    the parts are remembered like the pieces.
    """

    def __init__(self, path: str, pattern: str, cache: int | None = None):
        cache = CACHE if cache is None else cache
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
        self.tokens = {r: t for t, r in self.ranks.items()}
        self.pieces = regex.compile(pattern).findall
        self.known = Remembered(self._piece, cache)
        self.parts = Remembered(self._part, cache)

    def _piece(self, piece: str) -> tuple[int, ...]:
        data = piece.encode()
        rank = self.ranks.get(data)
        return (rank,) if rank is not None else tuple(merge(data, self.ranks))

    def _part(self, part: str) -> tuple[int, ...]:
        if not part or part[0].isspace() or part[-1].isspace():
            raise _Unclean
        return tuple(self._whole(" " + part))

    def _whole(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.known.__getitem__, self.pieces(text))))

    def encode(self, text: str) -> list[int]:
        first, *parts = text.split(" ")
        if first[-1:].isspace() or not first:
            return self._whole(text)
        try:
            rest = list(chain.from_iterable(map(self.parts.__getitem__, parts)))
        except _Unclean:
            return self._whole(text)
        return self._whole(first) + rest

    def forget(self) -> None:
        for memory in (self.known, self.parts):
            memory.clear()
            memory.older = {}

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=4)
def codec(path: str, pattern: str, cache: int | None = None) -> Codec:
    return Codec(path, pattern, cache)


def little_endian(ids: list[int]) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


def encoded(text: Column, path: str, pattern: str) -> Column:
    """The ids of each text: array of int."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def ids(texts: pd.Series) -> pd.Series:
        c = codec(path, pattern)
        return pd.Series([np.asarray(c.encode(t or ""), dtype=np.int32) for t in texts],
                         dtype=object)

    return ids(text)


def decoded(ids: Column, path: str, pattern: str) -> Column:
    """The bytes of each array of ids."""

    @F.pandas_udf(T.BinaryType())
    def data(rows: pd.Series) -> pd.Series:
        c = codec(path, pattern)
        return pd.Series([c.decode(r if r is not None else ()) for r in rows], dtype=object)

    return data(ids)


def encoded_checked(text: Column, path: str, pattern: str) -> Column:
    """struct(ids, decodes): the ids of each text, and whether they decode to its very
    bytes, in one pass. A worker remembers few texts, and lets them go with the task: it
    may go on to other work."""
    kind = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())),
                         T.StructField("decodes", T.BooleanType())])

    @F.pandas_udf(kind)
    def checked(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        c = codec(path, pattern, SMALL_CACHE)
        for texts in batches:
            ids, fine = [], []
            for t in texts:
                own = c.encode(t or "")
                ids.append(np.asarray(own, dtype=np.int32))
                fine.append(c.decode(own) == (t or "").encode())
            yield pd.DataFrame({"ids": pd.Series(ids, dtype=object), "decodes": fine})
        c.forget()
        release_memory()

    return checked(text)


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Per row: id, n_tokens, and digests of the ids (little-endian 32-bit integers)
    and of the bytes that they decode to; ids and bytes stay on the worker."""
    kind = T.StructType([T.StructField("n_tokens", T.LongType()),
                         T.StructField("ids_sha256", T.StringType()),
                         T.StructField("decoded_sha256", T.StringType())])

    @F.pandas_udf(kind)
    def digests(texts: pd.Series) -> pd.DataFrame:
        c, rows = codec(path, pattern), []
        for t in texts:
            ids = c.encode(t or "")
            rows.append((len(ids), hashlib.sha256(little_endian(ids)).hexdigest(),
                         hashlib.sha256(c.decode(ids)).hexdigest()))
        return pd.DataFrame(rows, columns=kind.names)

    batch_rows(docs.sparkSession, BATCH)
    return docs.select(id_col, digests(text_col).alias("d")).select(id_col, "d.*")

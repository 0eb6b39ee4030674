"""op5: ids against tiktoken, exact round trips."""

import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from rillflow.llm import bpe
from rillflow.llm.queries import REGISTRY
from tests.llm.fixtures import awkward_docs, docs_frame, with_clashes, write

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def theirs():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_random_texts(theirs):
    own, rng = bpe.codec(PATH, P.PATTERN), random.Random(1)
    parts = [" ", "  ", "\n", "\t", "a", "b", "\u00e9", "1", "22", ".", ",", "'s", "'", "\x1c",
             "\xa0", "foo", "The", " x", "\u4e2d", "\U0001f600", "zzz"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(15))) for _ in range(3000)]
    texts += ["a" * 3000, " " * 2000, "xy" * 4000, "".join(rng.choice(parts) for _ in range(20_000))]
    for text in texts:
        ids = own.encode(text)
        assert ids == theirs.encode_ordinary(text), text[:50]
        assert own.decode(ids) == text.encode()


def test_memory_generations(theirs, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 5)
    own = bpe.Codec(PATH, P.PATTERN)
    text = "one two three four five six seven one two eight nine ten one"
    assert own.encode(text) == theirs.encode_ordinary(text)
    assert len(own.known) <= 5 and len(own.parts) <= 5


def test_query(spark, scratch, theirs):
    sf = write(with_clashes(docs_frame(spark)), scratch + "/d", "documents")
    got = REGISTRY["op5_byte_bpe"](spark, sf).collect()
    want = []
    for i, text, *_ in awkward_docs():
        ids = theirs.encode_ordinary(text or "")
        want.append((i, len(ids), hashlib.sha256(b"".join(
            x.to_bytes(4, "little") for x in ids)).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    none = docs_frame(spark).limit(0)
    assert bpe.round_trip(none, PATH, P.PATTERN).collect() == []


def test_checked_worker_remembers_few_texts(spark, monkeypatch):
    """The pipeline's encoder: ids as with the large memory, and a memory of its own size."""
    monkeypatch.setattr(bpe, "SMALL_CACHE", 4)
    used = []
    monkeypatch.setattr(bpe, "codec", lambda *how: used.append(bpe.Codec(*how)) or used[-1])
    monkeypatch.setattr(bpe.Codec, "forget", lambda self: None)
    monkeypatch.setattr(bpe.F, "pandas_udf", lambda kind: lambda f: lambda text: f)
    text = "one two three four five six seven one two eight nine ten one"
    import pandas as pd
    got, = bpe.encoded_checked("text", PATH, P.PATTERN)(iter([pd.Series([text, None])]))
    assert [list(x) for x in got["ids"]] == [bpe.Codec(PATH, P.PATTERN).encode(text), []]
    assert all(got["decodes"])
    for memory in (used[0].known, used[0].parts):
        assert len(memory) <= 4 and len(memory.older) <= 4

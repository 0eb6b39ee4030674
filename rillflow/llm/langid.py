"""Language identification by hierarchical discrimination.

A text is lower-cased, everything but letters becomes white space, and its byte
n-grams are hashed into a vector (square roots of counts, length 1). First a linear
support vector machine per language family picks the family, then, within the
family, one-versus-one machines between its languages vote. ``score`` is the chance
of the family times that of the language, by the margins. As the better of two machines
always has a chance of a half, ``score`` cannot tell a text of no learned language:
``margin`` (the least winning margin of the machines asked; near 0, or less, if they tell
nothing) and ``likeness`` (cosine to the language's mean vector) can.

``fit`` learns from at most ``MAX_PER_LANG`` labelled texts of each language, those
with the smallest hash of their id (the bound of the sample; only these texts' vectors come to
the driver). A language of no known family is a family of its own.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; rows
without a label are never learnt from; without any labelled text everything is
``und``; with one language every text with a letter is of it; repeated rows are
judged alike; an empty table gives an empty result; extra columns are kept by
``identified`` whatever their names. Very long texts are read whole, in pieces.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.llm.common import batch_rows

UND = "und"
#: labelled texts that are learnt from, per language
MAX_PER_LANG = 300
#: slots of a vector, and the n-grams hashed into it
BITS, NGRAMS = 13, (1, 2, 3, 4)
#: texts in an Arrow batch
BATCH = 256
_PIECE = 1 << 20

#: closely related languages (fixed values)
FAMILIES = {
    "germanic": ("en", "de", "nl", "af", "sv", "da", "no", "nb", "nn", "is", "lb", "fy"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "mk", "sr", "hr", "bs", "sl"),
    "uralic": ("fi", "et", "hu"), "baltic": ("lt", "lv"), "turkic": ("tr", "az", "kk", "uz"),
    "indic": ("hi", "bn", "mr", "ur", "pa", "gu", "ne"), "semitic": ("ar", "he", "mt"),
    "celtic": ("ga", "cy", "br", "gd"),
}
_FAMILY = {lang: family for family, langs in FAMILIES.items() for lang in langs}

_ASCII = np.arange(256, dtype=np.uint32)
_ASCII[:128] = [c if chr(c).isalpha() else 32 for c in range(128)]


def vector(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(slots, values) of a text."""
    data = _ASCII[np.frombuffer(f" {text.lower()} ".encode(), dtype=np.uint8)]
    blank = data == 32
    data = data[~(blank & np.concatenate(([False], blank[:-1])))]
    counts = np.zeros(1 << BITS, dtype=np.int64)
    for a in range(0, len(data), _PIECE):
        for n in NGRAMS:
            part = data[a:a + _PIECE + n - 1]
            m = len(part) - n + 1
            if m <= 0:
                continue
            h = np.full(m, n, dtype=np.uint32)
            for k in range(n):
                h = h * np.uint32(0x01000193) + part[k:k + m]
            h *= np.uint32(0x9E3779B1)
            counts += np.bincount(h >> np.uint32(32 - BITS), minlength=1 << BITS)
    at = np.flatnonzero(counts)
    values = np.sqrt(counts[at]).astype(np.float32)
    return at, values / max(float(np.linalg.norm(values)), 1e-12)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, rounds: int = 120) -> np.ndarray:
    """Linear support vector machine (squared hinge, classes weighed alike): weights
    and, last, the bias; y is +1 or -1. Accelerated gradient descent from zero."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=np.float32)])
    weigh = np.where(y > 0, 1 / max((y > 0).sum(), 1), 1 / max((y < 0).sum(), 1)) \
        .astype(np.float32) * len(y) / 2 * c
    top = np.ones(x.shape[1], dtype=np.float32)
    for _ in range(12):  # power iteration: the largest singular value, a little enlarged
        top = x.T @ (x @ (top / np.linalg.norm(top)))
    step = 1 / (1 + 2.5 * float(weigh.max()) * float(np.linalg.norm(top)))
    w = at = np.zeros(x.shape[1], dtype=np.float32)
    t = 1.0
    for _ in range(rounds):
        slack = np.maximum(0, 1 - y * (x @ at))
        after = at - np.float32(step) * (at - 2 * (x.T @ (weigh * slack * y)))
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        at = after + np.float32((t - 1) / t2) * (after - w)
        w, t = after, t2
    return w


@dataclass
class Model:
    """``weights``: a column for each machine, families first, then pairs."""
    families: list[str] = field(default_factory=list)
    langs: dict[str, list[str]] = field(default_factory=dict)
    pairs: list[tuple[str, str]] = field(default_factory=list)
    weights: np.ndarray | None = None
    bias: np.ndarray | None = None
    #: the languages' mean vectors, of length 1
    centres: dict[str, np.ndarray] = field(default_factory=dict)

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.judge(text)[:2]

    def judge(self, text: str | None) -> tuple[str, float, float, float]:
        """(language, score, margin, likeness)"""
        if not self.families or not has_letter(text):
            return UND, 0.0, 0.0, 0.0
        at, values = vector(text)
        margin = values @ self.weights[at] + self.bias
        chance = 1 / (1 + np.exp(-4 * margin))
        first = chance[:len(self.families)]
        best = int(first.argmax())
        langs = self.langs[self.families[best]]
        if len(langs) == 1:
            return (langs[0], float(first[best]), float(margin[best]),
                    float(values @ self.centres[langs[0]][at]))
        won = dict.fromkeys(langs, 0.0)
        for k, (a, b) in enumerate(self.pairs, start=len(self.families)):
            if a in won and b in won:  # a vote, ties by chance
                won[a] += float(chance[k] > 0.5) + chance[k] / 1000
                won[b] += float(chance[k] <= 0.5) + (1 - chance[k]) / 1000
        lang = max(langs, key=lambda x: won[x])
        own = [chance[k] if a == lang else 1 - chance[k]
               for k, (a, b) in enumerate(self.pairs, start=len(self.families))
               if lang in (a, b)]
        won_by = [margin[k] if a == lang else -margin[k]
                  for k, (a, b) in enumerate(self.pairs, start=len(self.families))
                  if lang in (a, b)]
        return (lang, float(first[best] * min(own)), float(min(margin[best], *won_by)),
                float(values @ self.centres[lang][at]))


def train(vectors: list[tuple[np.ndarray, np.ndarray]], langs: list[str]) -> Model:
    """The machines of a labelled sample."""
    if not langs:
        return Model()
    x = np.zeros((len(langs), 1 << BITS), dtype=np.float32)
    for i, (at, values) in enumerate(vectors):
        x[i, at] = values
    y = np.array(langs)
    family = np.array([_FAMILY.get(lang, lang) for lang in langs])
    model = Model(sorted(set(family)))
    model.langs = {f: sorted(set(y[family == f])) for f in model.families}
    model.pairs = [p for f in model.families for p in combinations(model.langs[f], 2)]
    for lang in set(langs):
        mean = x[y == lang].mean(axis=0)
        model.centres[lang] = mean / max(float(np.linalg.norm(mean)), 1e-12)
    ws = []
    for f in model.families:
        one = np.zeros(x.shape[1] + 1, dtype=np.float32)
        one[-1] = 1.0
        if len(model.families) == 2 and ws:  # the other one, mirrored
            ws.append(-ws[0])
        else:
            ws.append(one if len(model.families) == 1
                      else svm(x, np.where(family == f, 1, -1).astype(np.float32)))
    for a, b in model.pairs:
        rows = (y == a) | (y == b)
        ws.append(svm(x[rows], np.where(y[rows] == a, 1, -1).astype(np.float32)))
    w = np.stack(ws, axis=1)
    model.weights, model.bias = w[:-1], w[-1]
    return model


_VECTOR = T.StructType([T.StructField("at", T.BinaryType()), T.StructField("values", T.BinaryType())])


@F.pandas_udf(_VECTOR)
def _vectors(texts: pd.Series) -> pd.DataFrame:
    rows = [vector(t) for t in texts]
    return pd.DataFrame({"at": [a.astype("<i4").tobytes() for a, _ in rows],
                         "values": [v.astype("<f4").tobytes() for _, v in rows]})


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_lang: int = MAX_PER_LANG) -> Model:
    """Learn from labelled documents (all rows of ``docs`` with a text and a label)."""
    batch_rows(docs.sparkSession, BATCH)
    rows = docs.select(F.xxhash64(F.col(id_col).cast("string")).alias("h"),
                       F.col(text_col).alias("t"), F.col(lang_col).alias("lang")) \
        .where("t is not null and lang is not null").where(F.col("t").rlike(r"\p{L}"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    # a little more than enough rows of each language, by hash, then exactly enough
    keep = F.lit(False)
    for lang, n in counts.items():
        part = min(1.0, (2 * per_lang + 50) / n)
        keep = keep | ((F.col("lang") == lang)
                       & (F.pmod("h", F.lit(1_000_003)) < int(part * 1_000_003) + 1))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("h", "t"))
    sample = rows.where(keep).withColumn("nth", nth).where(F.col("nth") <= per_lang) \
        .select("lang", "nth", _vectors("t").alias("v")).orderBy("lang", "nth").collect()
    return train([(np.frombuffer(r["v"]["at"], "<i4"), np.frombuffer(r["v"]["values"], "<f4"))
                  for r in sample], [r["lang"] for r in sample])


PREDICTION = T.StructType([T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()),
                           T.StructField("margin", T.DoubleType()),
                           T.StructField("likeness", T.DoubleType())])


def predicted(text: Column, model: Model) -> Column:
    """struct(lang_pred, score, margin, likeness) of each text."""

    @F.pandas_udf(PREDICTION)
    def of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.judge(t) for t in texts], columns=PREDICTION.names)

    return of(text)


def identified(docs: DataFrame, model: Model, out: str, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``out``: struct(lang_pred, score, margin, likeness)."""
    batch_rows(docs.sparkSession, BATCH)
    return docs.withColumn(out, predicted(F.col(text_col), model))

"""Language identification by hierarchical discrimination.

The family of a text is predicted first, one linear support vector machine per
family against the rest. Within the family one machine per pair of languages
votes. Features are hashed counts of one to three neighbouring bytes of the
letters of the whole text, in lower case.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobweave.llm.common import stage
from jobweave.session import ship_package

DIMENSIONS = 4096
SAMPLE_PER_LANGUAGE = 400
UNDETERMINED = "und"

# Language codes by family. A language that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no is",
    "romance": "fr es it pt ro ca gl",
    "slavic": "ru uk pl cs sk bg sr hr sl",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz",
    "semitic": "ar he mt",
}
_FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs.split()}

# ASCII signs other than letters become a blank; bytes of longer characters stay.
_LETTERS = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in range(256))
_BLOCK = 1 << 20


def family_of(lang: str) -> str:
    return _FAMILY_OF.get(lang, lang)


def has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


def features(text: str) -> np.ndarray:
    """Unit vector of the square roots of the hashed counts; the whole text counts, block by block."""
    plain = b" " + b" ".join(text.lower().encode().translate(_LETTERS).split()) + b" "
    total = np.zeros(DIMENSIONS, dtype=np.int64)
    for start in range(0, len(plain), _BLOCK):
        # Two bytes of overlap, so a block border hides no run of three.
        b = np.frombuffer(plain[start : start + _BLOCK + 2], dtype=np.uint8).astype(np.uint32)
        own = min(_BLOCK, len(plain) - start)
        pairs = (b[:-1] << 8) | b[1:]
        runs = [b[:own], pairs[:own] | (1 << 24)]
        if len(b) > 2:
            runs.append((((pairs[:-1] << 8) | b[2:]) + np.uint32(1 << 25))[:own])
        for run in runs:
            total += np.bincount((run * np.uint32(2654435761)) >> np.uint32(20), minlength=DIMENSIONS)
    vector = np.sqrt(total, dtype=np.float32)
    return vector / np.float32(max(np.linalg.norm(vector), 1e-9))


def train_svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 300) -> np.ndarray:
    """Weights and bias of a linear machine with squared hinge loss, classes balanced, by accelerated descent."""
    data = np.hstack([x, np.ones((len(x), 1), dtype=np.float32)])
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32) * cost
    step = 1.0 / (1.0 + 2.0 * cost * 2.0)
    w = previous = np.zeros(data.shape[1], dtype=np.float32)
    for k in range(rounds):
        ahead = w + (k / (k + 3)) * (w - previous)
        short = np.maximum(0, 1 - y * (data @ ahead))
        gradient = ahead - 2 * (data.T @ (weight * short * y))
        previous, w = w, (ahead - step * gradient).astype(np.float32)
    return w


@dataclass(frozen=True)
class LanguageModel:
    """Small, of a size fixed by the number of languages; sent to tasks with the function that uses it."""

    families: list[str]
    family_weights: np.ndarray
    members: dict[str, list[str]]
    pair_weights: dict[tuple[str, str], np.ndarray]

    def floors(self) -> dict[str, float]:
        """The least score a prediction of each language can have: all families alike, and all languages of its own."""
        alike = 1 / max(len(self.families), 1)
        return {g: alike * (0.5 if len(m) > 1 else 1.0) for m in self.members.values() for g in m}

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.families or not has_letter(text):
            return UNDETERMINED, 0.0
        x = np.append(features(text), np.float32(1))
        margins = _sigmoid(self.family_weights @ x)
        best = int(np.argmax(margins))
        sure = float(margins[best] / margins.sum())
        langs = self.members[self.families[best]]
        if len(langs) == 1:
            return langs[0], sure
        votes = dict.fromkeys(langs, 0.0)
        for (a, b), w in self.pair_weights.items():
            if a in votes:
                p = float(_sigmoid(w @ x))
                votes[a] += p
                votes[b] += 1 - p
        lang = max(langs, key=lambda v: (votes[v], v))
        return lang, min(1.0, max(0.0, sure * votes[lang] / (len(langs) - 1)))


def _sigmoid(margin: np.ndarray | float) -> np.ndarray | float:
    return 1 / (1 + np.exp(-4 * np.clip(margin, -10, 10)))


def held_out(doc_id: str) -> Column:
    """One id in four is never learned from. A null id is never learned from either, but isn't held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = SAMPLE_PER_LANGUAGE
) -> LanguageModel:
    """Fit on at most ``per_language`` labelled rows of each language, chosen by a hash of the id.

    Only the chosen rows' texts are read as features; what reaches the driver is
    ``per_language`` vectors of ``DIMENSIONS`` numbers for each language.
    """
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc"), "doc")
    chosen = (
        docs.select(F.col(doc_id).alias("doc"), F.col(lang).alias("lang"), F.col(text).isNotNull().alias("there"))
        .filter(F.col("lang").isNotNull() & F.col("doc").isNotNull() & F.col("there") & ~held_out("doc"))
        .distinct()
        .withColumn("n", F.row_number().over(order))
        .filter(F.col("n") <= per_language)
        .select("doc", "lang")
    )
    chosen = stage(chosen, "lang-sample")

    @F.arrow_udf("binary")
    def vectors(values: pa.Array) -> pa.Array:
        return pa.array([features(t).tobytes() if has_letter(t) else None for t in values.to_pylist()], pa.binary())

    ship_package(docs.sparkSession)
    labelled = docs.select(F.col(doc_id).alias("doc"), F.col(lang).alias("lang"), F.col(text).alias("value"))
    # Ids may repeat: one row of each, before its vector is made; one with a letter if there is any.
    first = F.min(F.struct(~F.regexp_like("value", F.lit("\\p{L}")), F.xxhash64("value"), F.col("value").alias("value")))
    rows = labelled.filter("value is not null").join(chosen, ["doc", "lang"], "left_semi")
    single = rows.groupBy("doc", "lang").agg(first.alias("first"))
    found = single.select("doc", "lang", vectors("first.value").alias("x")).toArrow()
    rows = sorted((d, g, x) for d, g, x in zip(*(found[c].to_pylist() for c in ("doc", "lang", "x"))) if x is not None)
    langs = np.array([g for _, g, _ in rows])
    x = np.array([np.frombuffer(v, dtype=np.float32) for _, _, v in rows]).reshape(-1, DIMENSIONS)
    members: dict[str, list[str]] = {}
    for g in sorted(set(langs.tolist())):
        members.setdefault(family_of(g), []).append(g)
    families = sorted(members)
    kin = np.array([family_of(g) for g in langs.tolist()])
    alone = len(families) == 1
    by_family = [
        np.append(np.zeros(DIMENSIONS, dtype=np.float32), np.float32(1)) if alone else train_svm(x, np.where(kin == f, 1, -1))
        for f in families
    ]
    pairs = {}
    for f in families:
        for a, b in combinations(members[f], 2):
            own = (langs == a) | (langs == b)
            pairs[a, b] = train_svm(x[own], np.where(langs[own] == a, 1, -1))
    return LanguageModel(families, np.array(by_family), members, pairs)


def identify(
    docs: DataFrame, model: LanguageModel, text: str = "text", lang_pred: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """All rows and columns of ``docs`` with the predicted language and a score from 0 to 1.

    Null text, a text without any letter, or a model without languages:
    ``und`` and 0. Columns of these two names are replaced. The prediction
    depends on the text alone, so repeated rows get equal results.
    """
    out = pa.struct([("lang", pa.string()), ("score", pa.float64())])

    @F.arrow_udf("struct<lang: string, score: double>")
    def predicted(values: pa.Array) -> pa.Array:
        return pa.array([dict(zip(("lang", "score"), model.predict(t))) for t in values.to_pylist()], out)

    ship_package(docs.sparkSession)
    found = docs.withColumn("_lang_found", predicted(F.col(text)))
    return found.withColumns(
        {lang_pred: F.col("_lang_found.lang"), score: F.col("_lang_found.score")}
    ).drop("_lang_found")

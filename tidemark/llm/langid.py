"""Language identification: the family first, then one-versus-one linear SVMs within it.

Features are hashed character 1- to 3-grams of the whole lower-cased letters of
a text, as square roots of relative counts. The classifiers are fitted on a
bounded sample of labelled rows (at most ``SAMPLE`` distinct texts a language,
chosen by a hash of the text); prediction reads every text whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIMENSIONS = 2048
#: Labelled texts for each language that the classifiers are fitted on, and languages told apart.
SAMPLE = 600
LANGUAGES = 200
UNKNOWN = "und"
#: Closely related languages by family; a language that is not listed is a family of its own.
FAMILIES = {
    "da": "germanic", "de": "germanic", "en": "germanic", "nl": "germanic", "no": "germanic", "sv": "germanic",
    "ca": "romance", "es": "romance", "fr": "romance", "it": "romance", "pt": "romance", "ro": "romance",
    "bg": "slavic", "cs": "slavic", "pl": "slavic", "ru": "slavic", "sk": "slavic", "uk": "slavic",
}


@lru_cache(1)
def _letter_table():
    """Lower-case letters keep their code, everything else becomes 0, a gap."""
    import numpy as np

    table = np.zeros(1 << 16, np.uint32)
    for k in range(1 << 16):
        if (c := chr(k)).isalpha():
            low = c.lower()
            table[k] = ord(low) if len(low) == 1 else k
    return table


def features(text: str | None):
    """Unit-length vector of ``DIMENSIONS`` hashed n-grams; None for a text without a letter."""
    import numpy as np

    if not text:
        return None
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    x = _letter_table()[np.minimum(raw, 0xFFFF)]
    if len(high := np.flatnonzero(raw > 0xFFFF)):
        x[high] = [c if chr(c).isalpha() else 0 for c in raw[high].tolist()]
    if not x.any():
        return None
    # Runs of other characters count as one gap.
    x = np.r_[np.uint32(0), x[(x != 0) | np.r_[True, x[:-1] != 0]], np.uint32(0)]
    grams = [x[x != 0], x[:-1] * np.uint32(0x9E3779B1) + x[1:] + np.uint32(7)]
    if len(x) > 2:
        grams.append((x[:-2] * np.uint32(0x85EBCA6B) + x[1:-1]) * np.uint32(0xC2B2AE35) + x[2:] + np.uint32(13))
    h = np.concatenate(grams)
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    made = np.sqrt(np.bincount((h >> np.uint32(21)).astype(np.int64), minlength=DIMENSIONS).astype(np.float32))
    return made / np.sqrt((made**2).sum())


def linear_svm(x, y, cost: float = 10.0, steps: int = 150):
    """Weights and bias of a squared-hinge linear SVM by accelerated gradient descent; ``y`` is -1 or 1.

    Both sides weigh the same however many rows they have.
    """
    import numpy as np

    x1 = np.c_[x, np.ones(len(x), np.float32)]
    side = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32) * cost
    w = v = np.zeros(x1.shape[1], np.float32)
    rate, speed = 1 / (1 + 2 * 2 * cost), 1.0
    for _ in range(steps):
        slack = np.maximum(0, 1 - y * (x1 @ v))
        grad = v - 2 * (side * slack * y) @ x1
        new, faster = v - rate * grad, (1 + (1 + 4 * speed**2) ** 0.5) / 2
        v = new + (speed - 1) / faster * (new - w)
        w, speed = new, faster
    return w[:-1], float(w[-1])


@dataclass
class Model:
    """Families with their one-versus-rest machines, and a machine for each pair of languages of a family."""

    families: list[tuple[str, list[str]]]
    family_weights: object
    family_bias: object
    pairs: dict[tuple[str, str], tuple[object, float]]

    def predict(self, vectors):
        """Language and score of each row; the score is the family's share times the language's share in it."""
        import numpy as np

        squash = lambda m: 1 / (1 + np.exp(-4 * np.clip(m, -20, 20)))
        if not self.families:
            return [UNKNOWN] * len(vectors), np.zeros(len(vectors))
        odds = squash(vectors @ self.family_weights + self.family_bias)
        share = odds / odds.sum(axis=1, keepdims=True)
        chosen = share.argmax(axis=1)
        names, scores = np.empty(len(vectors), object), share[np.arange(len(vectors)), chosen]
        for f, (_, langs) in enumerate(self.families):
            rows = np.flatnonzero(chosen == f)
            if not len(rows):
                continue
            won = np.zeros((len(rows), len(langs)))
            for (a, b), (w, bias) in ((p, m) for p, m in self.pairs.items() if p[0] in langs):
                p = squash(vectors[rows] @ w + bias)
                won[:, langs.index(a)] += p
                won[:, langs.index(b)] += 1 - p
            if len(langs) > 1:
                won /= len(langs) - 1
            else:
                won += 1
            best = won.argmax(axis=1)
            names[rows] = np.array(langs, object)[best]
            scores[rows] = scores[rows] * won[np.arange(len(rows)), best]
        return names.tolist(), np.clip(scores, 0.0, 1.0).astype(float)


def held_out(doc_id: str | Column) -> Column:
    """Rows that are not learned from: crc32 of the id's text leaves 1 when divided by 3. A null id is learned from."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, sample: int = SAMPLE, languages: int = LANGUAGES, families: dict[str, str] = FAMILIES) -> Model:
    """Fits on ``docs(doc_id, text, lang)``; at most ``sample`` distinct texts of each of the ``languages`` most frequent languages.

    The sample is chosen by the hash of the text, so repeated rows count once
    and no order of the rows matters.
    """
    import numpy as np

    known = docs.where(~held_out("doc_id") & F.col("lang").isNotNull() & (F.col("lang") != UNKNOWN) & (F.length("text") > 0)).select("lang", "text", F.xxhash64("text").alias("h"))
    top = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    distinct = known.select("lang", "h").distinct()
    chosen = distinct.join(top.select("lang"), "lang", "left_semi").withColumn("r", rank).where(F.col("r") <= sample)
    # A few hashes a language, at most languages * sample rows: read back to find the texts in one more scan.
    limits = chosen.groupBy("lang").agg(F.max("h").alias("most"))
    texts = known.join(F.broadcast(limits), "lang").where("h <= most").groupBy("lang", "h").agg(F.min("text").alias("text"))

    def vectors(batches):

        for b in batches:
            made = [features(t) for t in b["text"]]
            yield pd.DataFrame({"lang": [x for x, m in zip(b["lang"], made) if m is not None], "v": [m.astype(np.float16).tobytes() for m in made if m is not None]})

    rows = texts.select("lang", "text").mapInPandas(vectors, "lang string, v binary").collect()
    langs = np.array([r["lang"] for r in rows], object)
    x = np.array([np.frombuffer(r["v"], np.float16) for r in rows], np.float32).reshape(-1, DIMENSIONS)
    groups: dict[str, list[str]] = {}
    for name in sorted(set(langs.tolist())):
        groups.setdefault(families.get(name, name), []).append(name)
    kinds = sorted(groups.items())
    machines = []
    for _, members in kinds:
        y = np.where(np.isin(langs, members), 1, -1).astype(np.float32)
        machines.append(linear_svm(x, y) if len(kinds) > 1 else (np.zeros(DIMENSIONS, np.float32), 1.0))
    pairs = {}
    for _, members in kinds:
        for a, b in combinations(members, 2):
            rows_ab = (langs == a) | (langs == b)
            pairs[a, b] = linear_svm(x[rows_ab], np.where(langs[rows_ab] == a, 1, -1).astype(np.float32))
    return Model(kinds, np.array([m[0] for m in machines], np.float32).T, np.array([m[1] for m in machines], np.float32), pairs)


def predict(docs: DataFrame, model: Model, text: str = "text", out: str = "language") -> DataFrame:
    """``docs`` with ``out``: a struct of ``lang_pred`` and ``score``; ``und`` and 0 for a text without a letter."""

    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def guess(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import numpy as np

        for texts in batches:
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            every = texts.tolist()
            for at in range(0, len(every), 256):
                made = [(k, v) for k, t in enumerate(every[at : at + 256], at) if (v := features(t)) is not None]
                if made:
                    got, score = model.predict(np.array([v for _, v in made]))
                    for (k, _), name, s in zip(made, got, score):
                        names[k], scores[k] = name, s
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    return docs.withColumn(out, guess(F.col(f"`{text}`")))


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs(doc_id, text, lang)``.

    Null texts and texts without a letter are ``und`` with score 0; without any
    learned language every text is. Repeated rows are answered each.
    """
    found = predict(docs.select("doc_id", "text"), fit(docs.select("doc_id", "text", "lang")))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "language.lang_pred", "language.score")

"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1.  A trigram's vector binds (multiplies) the
vectors of its letters, permuted by place: two shifts for the first letter, one for the second.
A text's vector bundles (adds) those of its trigrams.  A language's prototype bundles
the unit vectors of its documents; a document goes to the prototype of the largest cosine
once the mean of all prototypes, which holds what the languages share, is taken off both.

Trigrams run over lower-cased letters; every run of other characters is one space.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import process_cache

DIMENSIONS = 1024
#: At most about so many labelled documents are learned from, drawn by a hash of id and text.
TRAIN_ROWS = 20_000
#: Letters share this many vectors: a to z have their own, others are dealt by code point.
SYMBOLS = 128
#: Texts whose vectors are held at once.
CHUNK = 512


def _tables(dimensions: int) -> tuple[np.ndarray, list[np.ndarray]]:
    cache, key = process_cache(), ("letters", dimensions)
    if key not in cache:
        symbol = np.zeros(0x110000, dtype=np.uint8)
        for c in range(0x110000):
            if chr(c).isalpha():
                symbol[c] = c - 96 if 97 <= c <= 122 else 27 + (c * 2654435761 % (1 << 32)) * (SYMBOLS - 27) // (1 << 32)
        letters = (np.random.default_rng(7).integers(0, 2, (SYMBOLS, dimensions)) * 2 - 1).astype(np.float32)
        cache[key] = symbol, [np.roll(letters, shift, axis=1) for shift in (2, 1, 0)]
    return cache[key]


def trigrams(text: str, symbol: np.ndarray) -> np.ndarray:
    """Trigram numbers of a text; none if it has no letter."""
    s = symbol[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")]
    s = np.concatenate(([0], s, [0])).astype(np.int32)
    s = s[(s > 0) | np.append(True, s[:-1] > 0)]
    if len(s) < 3:
        return np.zeros(0, dtype=np.int32)
    return (s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:]


def vectors(texts: list[str | None], dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """The unit vector of each text, and whether it has a letter."""
    symbol, placed = _tables(dimensions)
    out, some = np.zeros((len(texts), dimensions), dtype=np.float32), np.zeros(len(texts), dtype=bool)
    lo = 0
    while lo < len(texts):
        grams, rows, hi, size = [], [], lo, 0
        while hi < len(texts) and (hi == lo or (size < 500_000 and hi - lo < 128)):
            g = trigrams(texts[hi] or "", symbol)
            g, n = np.unique(g, return_counts=True)
            grams.append((g, n))
            size += len(texts[hi] or "")
            hi += 1
        all_grams, at = np.unique(np.concatenate([g for g, _ in grams]), return_inverse=True)
        if len(all_grams):
            # counts by document, a few thousand trigrams at a time
            doc = np.repeat(np.arange(hi - lo), [len(g) for g, _ in grams])
            counts = np.zeros((hi - lo, len(all_grams)), dtype=np.float32)
            counts[doc, at] = np.concatenate([n for _, n in grams])
            for i in range(0, len(all_grams), 4096):
                g = all_grams[i:i + 4096]
                bound = placed[0][g // SYMBOLS ** 2] * placed[1][g // SYMBOLS % SYMBOLS] * placed[2][g % SYMBOLS]
                out[lo:hi] += counts[:, i:i + 4096] @ bound
            some[lo:hi] = [len(g) > 0 for g, _ in grams]
        lo = hi
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norm > 0, norm, 1), some


def learn(df: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
          dimensions: int = DIMENSIONS, train_rows: int = TRAIN_ROWS) -> dict[str, np.ndarray]:
    """Prototypes by language from all rows of ``df`` with text and language.

    Of more than ``train_rows`` rows about that many are drawn by a hash; a model has one vector a language.
    Rows with a null in either column teach nothing; an empty table gives an empty model.
    """
    rows = df.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    n = rows.count()
    if n > train_rows:
        draw = F.pmod(F.xxhash64(F.lit("train"), id_col, F.crc32(F.col(text_col).cast("binary"))), F.lit(1 << 30))
        rows = rows.where(draw < int(train_rows / n * (1 << 30)))

    def bundle(batches):
        sums: dict = {}
        for pdf in (b.iloc[at:at + CHUNK] for b in batches for at in range(0, len(b), CHUNK)):
            v, some = vectors(pdf["text"].tolist(), dimensions)
            for lang in pdf["lang"].unique():
                own = (pdf["lang"] == lang).values & some
                if own.any():
                    s = v[own].astype(np.float64)
                    sums[lang] = sums.get(lang, 0) + s.sum(axis=0)
        for lang, s in sums.items():
            yield pd.DataFrame({"lang": lang, "i": np.arange(dimensions), "v": np.rint(s * (1 << 24)).astype(np.int64)})

    # whole numbers: the sums do not depend on the order of the parts
    sums = rows.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).mapInPandas(
        bundle, "lang string, i int, v long").groupBy("lang", "i").agg(F.sum("v").alias("v"))
    model: dict[str, np.ndarray] = {}
    for r in sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "v"))).alias("s")).orderBy("lang").collect():
        v = np.array([x["v"] for x in r["s"]], dtype=np.float64)
        model[r["lang"]] = v / max(np.linalg.norm(v), 1e-12)
    return model


def classify(texts: list[str | None], model: dict[str, np.ndarray]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text; ``und`` and 0 without a letter or a model."""
    if not model:
        return ["und"] * len(texts), np.zeros(len(texts))
    names = sorted(model)
    protos = np.stack([model[k] for k in names])
    v, some = vectors(texts, protos.shape[1])
    mean = protos.mean(axis=0) if len(names) > 1 else 0
    centred = protos - mean
    centred /= np.maximum(np.linalg.norm(centred, axis=1, keepdims=True), 1e-12)
    v = v - mean
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    cosine = np.round(v @ centred.T, 9)
    best = cosine.argmax(axis=1)  # ties: the first name
    score = np.clip((1 + cosine[np.arange(len(texts)), best]) / 2, 0, 1)
    return [names[b] if s else "und" for b, s in zip(best, some)], np.where(some, score, 0.0)


def predict(text: Column, model: dict[str, np.ndarray]) -> Column:
    """Struct ``(lang, score, letter)``; a null or letterless text is ``und`` with score 0 and no letter."""
    @F.pandas_udf("lang string, score double, letter boolean")
    def language(t: pd.Series) -> pd.DataFrame:
        out = []
        symbol = _tables(DIMENSIONS)[0]
        for at in range(0, len(t), CHUNK):
            texts = [None if x is None else x for x in t.iloc[at:at + CHUNK]]
            lang, score = classify(texts, model)
            letter = [len(trigrams(x or "", symbol)) > 0 for x in texts] if not model else [n != "und" or s > 0 for n, s in zip(lang, score)]
            out.append(pd.DataFrame({"lang": lang, "score": score, "letter": letter}))
        return pd.concat(out) if out else pd.DataFrame({"lang": [], "score": [], "letter": []})

    # else a filter on the result would run it a second time
    return language.asNondeterministic()(text)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             dimensions: int = DIMENSIONS, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """All columns of ``df`` with ``_held_out, _lang_pred, _score, _letter``; learned from the rows not held out.

    Columns of ``df`` that have one of these names are replaced; all others stay.  Where nothing could be learned all rows
    are ``und``; ``_letter`` still tells texts from what has no letter.
    """
    model = learn(df.where(~held_out(id_col)), text_col, lang_col, id_col, dimensions, train_rows)
    new = {"_held_out": held_out(id_col), "_lang_pred": "lang", "_score": "score", "_letter": "letter"}
    kept = [F.col(f"`{c}`") for c in df.columns if c not in new]
    both = df.select(F.struct(*kept).alias("row"), held_out(id_col).alias("held"), predict(F.col(text_col), model).alias("found"))
    return both.select("row.*", F.col("held").alias("_held_out"), *[F.col(f"found.{v}").alias(k) for k, v in new.items() if isinstance(v, str)])

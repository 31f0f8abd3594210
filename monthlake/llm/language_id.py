"""Language ID by string kernels: presence of blended-spectrum n-grams, Nystrom, ridge regression.

The kernel of two texts counts the n-grams (2 to 4 bytes of lower-cased letters, hashed into a
table of 2^15 places) that both hold, divided by the root of the numbers each holds. Nystrom
landmarks give it a finite map, one-versus-rest ridge regression a score for each language. The
score of a text is linear in its presence vector, so landmarks, map and regression fold into one
matrix (places x languages), and a batch of texts is scored by one matrix product.

The fit sees at most `per_lang` texts of each language, the first by hash of id and text in the learn
fold, as presence bits (4 KB each). Scoring is one Arrow pass over whole texts, without shuffle.

Defined cases: null text, or text without a letter, is `und` with score 0; a text whose letters
give no n-gram takes the language of the smallest score name; with no labelled row all texts are
`und`; repeated rows are judged alike. Labels that are null are not learnt.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from monthlake.llm import text as tx
from monthlake.plans.joins import dimension

GRAMS = (2, 3, 4)
PLACES = 1 << 15
PER_LANG = 400
LANDMARKS = 60  # of each language
RIDGE = 1e-3
BATCH = 64

# ASCII but letters becomes a space; the case of A-Z is dropped, other bytes stay.
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
# Arbitrary odd multipliers, one for each n.
_MIX = {2: 0x9E3779B1, 3: 0x85EBCA77, 4: 0xC2B2AE3D}


def presence(text: str, out: np.ndarray) -> None:
    """Mark the hashed n-grams of the whole text in `out`."""
    body = b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_LETTERS).split())
    codes = np.frombuffer(b" " + body + b" ", dtype=np.uint8).astype(np.uint32)
    gram = codes
    for n in range(2, max(GRAMS) + 1):
        gram = (gram[:-1] << np.uint32(8)) | codes[n - 1 :]
        if not len(gram):
            return
        if n in GRAMS:
            out[(gram * np.uint32(_MIX[n])) >> np.uint32(17)] = True


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def fit(bits: np.ndarray, langs: np.ndarray, landmarks: int = LANDMARKS, ridge: float = RIDGE):
    """Language names and the matrix (places x languages) that scores presence vectors."""
    names = sorted(set(langs))
    x = bits.astype(np.float32)
    norm = np.sqrt(np.maximum(x.sum(1), 1))
    x = x / norm[:, None]
    marks = np.concatenate([np.flatnonzero(langs == n)[:landmarks] for n in names])
    k_mm = (x[marks] @ x[marks].T).astype(np.float64)
    values, vectors = np.linalg.eigh(k_mm)
    keep = values > 1e-6 * values.max()
    to_map = vectors[:, keep] / np.sqrt(values[keep])
    z = (x @ x[marks].T) @ to_map
    y = np.where(langs[:, None] == np.array(names)[None, :], 1.0, -1.0)
    # Languages weigh alike, however many texts each gave.
    each = 1.0 / np.array([(langs == n).sum() for n in names])[np.searchsorted(names, langs)]
    zw = z * each[:, None]
    coef = np.linalg.solve(z.T @ zw + ridge * np.eye(z.shape[1]), zw.T @ y)
    return names, (x[marks].T @ (to_map @ coef)).astype(np.float32)


def sample_bits(docs: DataFrame, per_lang: int = PER_LANG) -> pd.DataFrame:
    """lang, _hash and presence bits of the first per_lang different rows of each language, by hash of id and text.

    Rows whose hash is below a share taken from counts go on: about twice as many as wanted, however many there are.
    Rows that repeat are dropped where they lie, so no copy reaches a window or the driver twice.
    """
    rows = docs.filter(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~tx.held_out(F.col("doc_id"))
    ).select("lang", "text", F.xxhash64("doc_id", "text").alias("_hash"))
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("_hash", 0.05).alias("_n"))
    share = F.shiftrightunsigned("_hash", 11) / float(1 << 53)
    near = rows.join(dimension(counts), "lang").filter(share * F.col("_n") < 2.0 * per_lang)

    def bits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            packed = []
            for text in frame["text"]:
                row = np.zeros(PLACES, dtype=bool)
                presence(text, row)
                packed.append(np.packbits(row).tobytes())
            yield pd.DataFrame({"lang": frame["lang"], "_hash": frame["_hash"], "bits": packed})

    made = near.select("lang", "_hash", "text").mapInPandas(bits, "lang string, _hash long, bits binary")
    different = made.groupBy("lang", "_hash").agg(F.any_value("bits").alias("bits"))
    first = W.partitionBy("lang").orderBy("_hash")
    chosen = different.withColumn("_k", F.row_number().over(first)).filter(F.col("_k") <= per_lang).drop("_k")
    return chosen.toPandas()


def learn(docs: DataFrame, per_lang: int = PER_LANG, landmarks: int = LANDMARKS):
    rows = sample_bits(docs, per_lang)
    if rows.empty:
        return [], np.zeros((PLACES, 0), np.float32)
    rows = rows.sort_values(["lang", "_hash"], kind="stable")
    bits = np.unpackbits(np.frombuffer(b"".join(rows["bits"]), np.uint8).reshape(len(rows), -1), axis=1)
    return fit(bits, rows["lang"].to_numpy(str), landmarks)


def predict_texts(texts, names: list[str], matrix: np.ndarray) -> tuple[list[str], list[float]]:
    langs, scores = ["und"] * len(texts), [0.0] * len(texts)
    todo = [i for i, t in enumerate(texts) if t and names and has_letter(t)]
    for at in range(0, len(todo), BATCH):
        rows = todo[at : at + BATCH]
        x = np.zeros((len(rows), PLACES), dtype=bool)
        for k, i in enumerate(rows):
            presence(texts[i], x[k])
        dense = x.astype(np.float32)
        f = dense @ matrix / np.sqrt(np.maximum(dense.sum(1), 1))[:, None]
        best = f.argmax(1)
        for k, i in enumerate(rows):
            langs[i], scores[i] = names[best[k]], float(np.clip((f[k, best[k]] + 1) / 2, 0, 1))
    return langs, scores


def predict(docs: DataFrame, model, text: str = "text") -> DataFrame:
    """`docs` with lang_pred and score; columns of those names are replaced."""
    names, matrix = model
    docs = docs.drop("lang_pred", "score")

    @F.pandas_udf("lang_pred string, score double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            langs, scores = predict_texts(texts.tolist(), names, matrix)
            yield pd.DataFrame({"lang_pred": langs, "score": scores})

    return docs.withColumn("_p", judge(F.col(f"`{text}`"))).select("*", "_p.lang_pred", "_p.score").drop("_p")


def op3_language_id(spark, sf_dir: str) -> DataFrame:
    docs = tx.documents(spark, sf_dir)
    model = learn(docs.select("doc_id", "text", "lang"))
    return predict(docs.select("doc_id", "text"), model).select(
        "doc_id", tx.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )

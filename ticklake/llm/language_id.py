"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed character 1- to 3-grams of the lower-cased text, in which
everything but letters is a space; a row is the TF-IDF vector of length one.
Training is follow-the-regularised-leader (FTRL-proximal) with elastic-net
penalties, then one temperature is fitted on rows kept out of training.
Prediction runs over whole texts in Arrow batches.

The classifier is fitted on a bounded sample of labelled rows: about
``per_language`` rows of each language, taken by a hash of the id (fewer where
there are fewer), and never more than twice that. It is fitted in one task;
the model (HASHED x languages floats) is the only thing that reaches the driver.

A null text or one without a letter gets ``und`` with score 0; so does every
row if there is nothing to learn from. A null id counts as held out. Repeated
rows are predicted alike. No other column is read.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import RID

#: Hashed features.
HASHED = 1 << 15
#: Rows of each language to learn from.
PER_LANGUAGE = 800
#: Every so many of the sampled rows calibrate the temperature.
CALIBRATE_EVERY = 5
EPOCHS = 3
#: Languages whose shares are written into the filter.
AT_HAND = 200
#: FTRL: learning rate and the elastic-net penalties.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 1e-4, 1e-3
#: Code points that numpy handles at a time.
STEP = 1 << 18


def held_out(id_col: str) -> Column:
    """crc32 of the id as text is 0 modulo 5 (a null id counts as held out)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """By code point: whether it is a letter."""
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000)


def counts(text: str) -> np.ndarray | None:
    """Counts of the hashed n-grams of the whole text; None without a letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.zeros(HASHED, np.int64)
    letter = False
    for at in range(0, len(points), STEP):
        p = points[max(0, at - 2):at + STEP]
        is_letter = _letters()[p]
        letter = letter or bool(is_letter.any())
        p = np.where(is_letter, p, np.uint32(32))
        fresh = min(at, 2)  # characters of the step before
        h = p.astype(np.uint32)
        for n in (1, 2, 3):
            if n > 1:
                if len(p) < n:
                    break
                h = h[:-1] * np.uint32(0x9E3779B1) + p[n - 1:]
            x = (h * np.uint32(0x85EBCA6B)) ^ np.uint32(n * 0x27D4EB2F)
            x = (x ^ (x >> np.uint32(15))) * np.uint32(0xC2B2AE35)
            out += np.bincount((x >> np.uint32(17))[max(0, fresh - n + 1):], minlength=HASHED)
    return out if letter else None


def sparse(text: str) -> tuple[np.ndarray, np.ndarray] | None:
    """(features, damped counts) of a text; None without a letter."""
    c = counts(text)
    if c is None:
        return None
    at = np.flatnonzero(c)
    return at.astype(np.int32), (1 + np.log(c[at])).astype(np.float32)


def scaled(x: np.ndarray) -> np.ndarray:
    return x / max(np.sqrt((x * x).sum()), 1e-9)


def fit(texts: list[str], langs: list[str]) -> tuple[list[str], np.ndarray, float]:
    """Languages, weights times idf (HASHED x languages; last row unused) and temperature."""
    usable = [(lang, *f) for t, lang in zip(texts, langs) if (f := sparse(t)) is not None]
    names = sorted({lang for lang, _, _ in usable})
    df = np.zeros(HASHED)
    for _, at, _ in usable:
        df[at] += 1
    idf = np.log((1 + len(usable)) / (1 + df)) + 1
    data = [(at, scaled(x * idf[at]).astype(np.float32), names.index(lang)) for lang, at, x in usable]
    keep = [d for k, d in enumerate(data) if (k + 1) % CALIBRATE_EVERY]
    rest = [d for k, d in enumerate(data) if (k + 1) % CALIBRATE_EVERY == 0] or keep
    z, n = np.zeros((HASHED, len(names))), np.zeros((HASHED, len(names)))

    def weights(at):
        big = np.abs(z[at]) > L1
        return np.where(big, (np.sign(z[at]) * L1 - z[at]) / ((BETA + np.sqrt(n[at])) / ALPHA + L2), 0.0)

    order = np.random.default_rng(0)
    for _ in range(EPOCHS):
        for k in order.permutation(len(keep)):
            at, x, y = keep[k]
            w = weights(at)
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y] -= 1
            g = x[:, None] * p[None, :]
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    w = weights(np.arange(HASHED))
    scores = np.array([x @ w[at] for at, x, _ in rest]) if rest else np.zeros((0, len(names)))
    labels = np.array([y for *_, y in rest], int)
    best, temperature = np.inf, 1.0
    for t in np.geomspace(0.05, 20, 61):
        s = scores / t
        s = s - s.max(axis=1, keepdims=True) if len(s) else s
        loss = (np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(s)), labels]).mean() if len(s) else 0.0
        if loss < best:
            best, temperature = loss, float(t)
    return names, np.hstack([idf[:, None], w]).astype(np.float32), temperature


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = PER_LANGUAGE, out: Column | None = None):
    """The model from labelled rows outside ``out`` (default: those held out)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"),
                       (held_out(id_col) if out is None else out).alias("out"))
    rows = rows.filter(~F.col("out") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    share = rows.groupBy("lang").count().select("lang", (F.lit(per_language) / F.col("count")).alias("share"))
    draw = F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    # A draw where the rows are scanned: only drawn texts are moved. The shares
    # (one number a language) go into the filter, or are joined if they are many.
    some = share.limit(AT_HAND + 1).collect()
    if len(some) <= AT_HAND:
        chance = F.lit(0.0)
        for r in some:
            chance = F.when(F.col("lang") == r.lang, r.share).otherwise(chance)
        drawn = rows.filter(draw < chance)
    else:
        drawn = rows.join(share, "lang").filter(draw < F.col("share"))
    drawn = drawn.select("id", "text", "lang")

    def learn(batches):
        seen: dict[str, list[tuple[str, str]]] = {}
        for b in batches:
            for i, text, lang in zip(*(b.column(k).to_pylist() for k in range(3))):
                own = seen.setdefault(lang, [])
                if len(own) < 2 * per_language:
                    own.append((str(i), text))
        rows = sorted((i, lang, t) for lang, own in seen.items() for i, t in own)
        names, w, t = fit([r[2] for r in rows], [r[1] for r in rows])
        if names:
            yield pa.record_batch({"names": [names], "w": [w.tobytes()], "t": [t]})

    got = drawn.repartition(1).mapInArrow(learn, "names array<string>, w binary, t double").collect()
    if not got:
        return None
    names = list(got[0].names)
    return names, np.frombuffer(got[0].w, np.float32).reshape(HASHED, len(names) + 1), got[0].t


def predict(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text",
            row_id: str | None = None) -> DataFrame:
    """One row per input row: RID (if ``row_id``), id, held_out, lang_pred, score."""
    cols = [F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text")]
    cols = ([F.col(row_id).alias(RID)] if row_id else []) + cols
    rows = docs.select(*cols)
    schema = ", ".join(f"{c} {t}" for c, t in rows.drop("text").dtypes) + ", lang_pred string, score double"

    def label(text):
        f = sparse(text) if text and model else None
        if f is None:
            return "und", 0.0
        names, w, t = model
        at, x = f
        s = scaled(x * w[at, 0]) @ w[at, 1:] / t
        p = np.exp(s - s.max())
        k = int(p.argmax())
        return names[k], float(p[k] / p.sum())

    def run(batches):
        for b in batches:
            found = [label(x.as_py()) for x in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column(k) for k in range(b.num_columns - 1)]
                + [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=[*b.schema.names[:-1], "lang_pred", "score"])

    return rows.mapInArrow(run, schema).withColumnRenamed("doc_id", id_col)


def language_id(docs: DataFrame, row_id: str | None = None) -> DataFrame:
    return predict(docs, train(docs), row_id=row_id)


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    from ticklake.llm.common import table
    return language_id(table(spark, sf_dir, "documents"))

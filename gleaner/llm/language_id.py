"""Language identification: multinomial naive Bayes over hashed character n-grams.

Features are the n-grams of 1 to 3 characters of the lower-cased text in which every
run of characters that are neither letters nor combining marks is one space, with a
space before and after the text, hashed to BUCKETS counts.
Training counts (language, bucket) in every task, as one array for each language
and block of buckets, and adds the arrays up; the log-probability matrix of
languages x buckets has a fixed size and goes to every task.  A batch of texts is
scored by gathering matrix rows for its n-grams and summing them by text.

The score is the softmax of the mean log-probability times the number of n-grams,
at most ``sharpness``: short texts stay unsure.  Texts that are null or have
no letter get ``und`` and score 0.  With no training row every text gets ``und``.
Equal rows get equal predictions; ties go to the language that sorts first.  Long
texts are read whole, CHUNK characters at a time.  Other columns of the input are read
only if they are to be carried; a carried column may not be called lang_pred or score.
"""

from __future__ import annotations

import unicodedata
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import let_go
from gleaner.session import ship

BUCKETS = 1 << 16
BLOCK = 1 << 13
SHARPNESS = 60.0
#: Characters that are hashed at a time.
CHUNK = 1 << 17
#: Rows whose texts are held at a time.
ROWS = 512


@lru_cache(maxsize=1)
def spelling() -> np.ndarray:
    """By code point: whether it is a letter or a combining mark."""
    return np.fromiter((chr(i).isalpha() or unicodedata.category(chr(i))[0] == "M" for i in range(0x110000)), bool, 0x110000)


def held_out(column, folds: int = 4, fold: int = 2):
    """Whether crc32 of the id's text leaves the remainder ``fold``."""
    return F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(folds)) == fold


def features(data: np.ndarray) -> list[np.ndarray]:
    """The buckets of the 1-, 2- and 3-grams starting at each character; data holds code points (32 bits)."""
    a = data
    b = a[:-1] * np.uint32(0x85EBCA6B) + a[1:]
    c = b[:-1] * np.uint32(0x85EBCA6B) + a[2:]
    out = []
    for salt, x in enumerate((a, b, c)):
        x = (x + np.uint32(salt << 25)) * np.uint32(0x9E3779B1)
        out.append(((x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - 16))
    return out


def letters(text: str) -> np.ndarray:
    """Code points of the text with a space before and after, everything but letters and marks folded into one space."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32)
    spelled = spelling()[codes]
    keep = spelled.copy()
    keep[1:] |= spelled[:-1]
    keep[0] = True
    return np.where(spelled, codes, np.uint32(32))[keep]


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def count_features(text: str, into: np.ndarray) -> None:
    data = letters(text)
    for at in range(0, len(data), CHUNK):
        for f in features(data[at : at + CHUNK + 2]):
            into += np.bincount(f[:CHUNK], minlength=BUCKETS)


def train(rows: DataFrame, lang: str = "lang", text: str = "text", alpha: float = 0.5) -> tuple[list[str], np.ndarray]:
    """(languages, log-probabilities of buckets x languages plus the row of priors) from all rows with both columns."""

    def count(batches):
        let_go()
        counts: dict[str, np.ndarray] = {}
        n: dict[str, int] = {}
        for b in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            parts: dict[str, list[str]] = {}
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                parts.setdefault(k, []).append(t)
            for k, ts in parts.items():
                into = counts.setdefault(k, np.zeros(BUCKETS, np.int64))
                n[k] = n.get(k, 0) + len(ts)
                at, size = 0, 0
                for i, t in enumerate(ts):  # texts are counted together, about a chunk at a time
                    size += len(t)
                    if size >= CHUNK or i == len(ts) - 1:
                        count_features(" ".join(ts[at : i + 1]), into)
                        at, size = i + 1, 0
        for k, into in counts.items():
            for i in range(0, BUCKETS, BLOCK):
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([i], pa.int32()), pa.array([n[k] if i == 0 else 0], pa.int64()), pa.array([into[i : i + BLOCK].tobytes()], pa.binary())], ["lang", "block", "n", "counts"])

    def add(key, table):
        total = np.zeros(BLOCK, np.int64)
        for x in table.column("counts"):
            total += np.frombuffer(x.as_buffer(), np.int64)
        n = sum(table.column("n").to_pylist())
        return pa.table({"lang": [table.column("lang")[0].as_py()], "block": pa.array([table.column("block")[0].as_py()], pa.int32()), "n": pa.array([n], pa.int64()), "counts": pa.array([total.tobytes()], pa.binary())})

    schema = "lang string, block int, n long, counts binary"
    ship(rows.sparkSession)
    known = rows.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(lang, text)
    # a few hundred kB for each language, whatever the number of rows
    got = known.mapInArrow(count, schema).groupBy("lang", "block").applyInArrow(add, schema).collect()
    names = sorted({r["lang"] for r in got})
    table, docs = np.zeros((BUCKETS + 1, len(names))), np.zeros(len(names))
    for r in got:
        k = names.index(r["lang"])
        table[r["block"] : r["block"] + BLOCK, k] = np.frombuffer(r["counts"], np.int64)
        docs[k] += r["n"]
    if names:
        table[:BUCKETS] = np.log((table[:BUCKETS] + alpha) / (table[:BUCKETS].sum(0) + alpha * BUCKETS))
        table[BUCKETS] = np.log(docs / docs.sum())
    return names, table.astype(np.float32)


def score_texts(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(mean log-probability by language, number of n-grams) of each text."""
    means, sizes = np.zeros((len(texts), table.shape[1])), np.ones(len(texts))
    data = [letters(t) for t in texts]
    at = 0
    while at < len(data):
        end, size = at, 0
        while end < len(data) and (end == at or size + len(data[end]) <= CHUNK):
            size += len(data[end])
            end += 1
        group = data[at:end]
        starts = np.cumsum([0, *map(len, group)])[:-1]
        joined = group[0] if len(group) == 1 else np.concatenate(group)
        sums = np.zeros((end - at, table.shape[1]))
        if len(group) == 1:  # a long text by chunks
            for i in range(0, len(joined), CHUNK):
                for f in features(joined[i : i + CHUNK + 2]):
                    sums[0] += table[f[:CHUNK]].sum(0, dtype=np.float64)
        else:
            one, two, three = features(joined)
            total = table[one]
            total[:-1] += table[two]
            total[:-2] += table[three]
            sums = np.add.reduceat(total, starts, axis=0)
        n = 3.0 * np.array([max(len(g), 1) for g in group])
        means[at:end] = sums / n[:, None]
        sizes[at:end] = n
        at = end
    return means, sizes


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], key: str = "doc_id", text: str = "text", sharpness: float = SHARPNESS, carry: tuple[str, ...] = ()) -> DataFrame:
    """(key, columns to carry, lang_pred, score) of every row."""
    names, table = model
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType

    fields = {f.name: f for f in docs.schema.fields}
    columns = list(dict.fromkeys([key, *carry]))
    if {"lang_pred", "score"}.intersection(columns):
        raise ValueError("a column to carry has the name of a result")
    schema = StructType([*[fields[c] for c in columns], StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast((names, table))  # BUCKETS x languages floats

    def run(batches):
        let_go()
        names, table = shared.value
        for b in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            texts = b.column(1).to_pylist()
            lettered = [bool(names) and t is not None and has_letter(t) for t in texts]
            means, sizes = score_texts([t if ok else "" for t, ok in zip(texts, lettered)], table)
            if names:
                means += table[BUCKETS] / sizes[:, None]
                share = np.exp((means - means.max(1, keepdims=True)) * np.minimum(sizes, sharpness)[:, None])
                share /= share.sum(1, keepdims=True)
                best = means.argmax(1)
            labels = [names[best[i]] if ok else "und" for i, ok in enumerate(lettered)]
            scores = [float(share[i, best[i]]) if ok else 0.0 for i, ok in enumerate(lettered)]
            yield pa.RecordBatch.from_arrays([*b.column(0).flatten(), pa.array(labels, pa.string()), pa.array(scores, pa.float64())], [*columns, "lang_pred", "score"])

    ship(docs.sparkSession)
    own = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("own")
    return docs.select(own, F.col(f"`{text}`").alias("text")).mapInArrow(run, schema)


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(key, held_out, lang_pred, score): learned from the rows that aren't held out, predicted for all."""
    model = train(docs.filter(~F.coalesce(held_out(F.col(key)), F.lit(False))), lang, text)
    out = predict(docs.select(key, text), model, key, text)
    return out.select(key, F.coalesce(held_out(F.col(key)), F.lit(False)).alias("held_out"), "lang_pred", "score")


def held_out_py(doc_id: int, folds: int = 4, fold: int = 2) -> bool:
    return zlib.crc32(str(doc_id).encode()) % folds == fold

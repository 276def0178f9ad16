"""Language identification: averaged hashed subword embeddings, linear softmax.

A text is its byte n-grams (orders 2 to 4, A-Z in lower case, digits as one,
white space as a word boundary). Each n-gram hashes to a row of an embedding
table; the mean row goes through a linear softmax. Both are trained on the
driver by stochastic gradient descent in numpy, on at most `sample_per_language`
whole texts of each language, chosen by hash. For prediction the table and the
linear layer are folded into one score table per language, so a whole text is
a sum of table rows.

Calibration: a tenth of the sample is held back; a temperature is fitted to it
by its log-likelihood with smoothed goals, and `reject_below` is the score that all but
`reject_share` of its correctly named texts reach, never above `REJECT_MOST`.

Defined cases: a null text or one without a letter is `und`, score 0, rejected;
very long texts are summed in pieces; without any labelled text everything is
`und` and rejected; ties go to the first language by code point; repeated rows
get equal results; an empty table gives an empty result; the documents' own
columns pass through whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from tidewright.llm.common import as_bytes, first_columns, free_names, picked, slices, tidy

ORDERS = (2, 3, 4)
BUCKET_BITS = 16
DIMENSION = 16
SAMPLE_PER_LANGUAGE = 600
EPOCHS = 3
# A small sample is gone over more often.
LEAST_STEPS = 4000
RATE = 0.25
REJECT_SHARE = 0.001
REJECT_MOST = 0.4
UNKNOWN = "und"
ADDED = ("lang_pred", "score", "rejected")

_LETTER = re.compile(r"[^\W\d_]")
_FOLD = np.array(
    [b + 32 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else 32 if b in (9, 10, 11, 12, 13, 32) else b for b in range(256)],
    np.uint32,
)


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    table: np.ndarray  # score of each bucket for each language
    bias: np.ndarray
    temperature: float
    reject_below: float


def _buckets(text: np.ndarray) -> list[np.ndarray]:
    """Bucket of every n-gram that starts at each place, by order."""
    folded = _FOLD[text]
    packed, found = folded, []
    for order in range(2, max(ORDERS) + 1):
        packed = (packed[:-1] << np.uint32(8)) | folded[order - 1 :]
        if order in ORDERS:
            mixed = (packed ^ np.uint32(order * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(2654435761)
            found.append((mixed >> np.uint32(32 - BUCKET_BITS)).astype(np.int64))
    return found


def bag(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their shares."""
    raw = np.frombuffer(b" " + text + b" ", np.uint8)
    ids, n = np.unique(np.concatenate(_buckets(raw)), return_counts=True)
    return ids, (n / n.sum()).astype(np.float32)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(texts: list[bytes], labels: list[str], seed: int = 7, reject_share: float = REJECT_SHARE) -> LanguageModel:
    """Stochastic gradient descent over the texts, then calibration on a tenth of them."""
    languages = sorted(set(labels))
    at = {x: i for i, x in enumerate(languages)}
    bags = [bag(t) for t in texts]
    goal = np.array([at[x] for x in labels], np.int64)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(bags))
    kept_back, learned = order[: len(bags) // 10], order[len(bags) // 10 :]
    rows = rng.uniform(-0.5 / DIMENSION, 0.5 / DIMENSION, (1 << BUCKET_BITS, DIMENSION)).astype(np.float32)
    layer = np.zeros((DIMENSION, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    epochs = max(EPOCHS, -(-LEAST_STEPS // max(1, len(learned))))
    steps, step = epochs * len(learned), 0
    for _ in range(epochs):
        for i in rng.permutation(learned):
            ids, share = bags[i]
            mean = share @ rows[ids]
            error = _softmax(mean @ layer + bias)
            error[goal[i]] -= 1
            rate = RATE * (1 - step / steps)
            back = layer @ error
            layer -= rate * np.outer(mean, error)
            bias -= 0.01 * rate * error
            # Scaled so that the text's mean moves by rate * back, however many rows it has.
            rows[ids] -= (rate / float(share @ share) * share)[:, None] * back
            step += 1
    table = (rows @ layer).astype(np.float32)
    if not len(kept_back):
        return LanguageModel(languages, table, bias, 1.0, 0.0)
    logits = np.array([bags[i][1] @ table[bags[i][0]] for i in kept_back]) + bias
    truth = goal[kept_back]

    # Smoothed goals, as for any calibration on few texts: certainty is never the best answer.
    doubt = 1 / (len(truth) + 2)
    goals = np.full(logits.shape, doubt / max(1, len(languages) - 1))
    goals[np.arange(len(truth)), truth] = 1 - doubt

    def loss(t: float) -> float:
        return -float((goals * np.log(_softmax(logits / t) + 1e-12)).sum(axis=1).mean())

    temperature = min(np.geomspace(0.25, 64, 97), key=loss)
    scores = _softmax(logits / temperature)
    right = scores.argmax(axis=1) == truth
    reached = np.quantile(scores[right].max(axis=1), reject_share) if right.any() else 0.0
    return LanguageModel(languages, table, bias, float(temperature), float(min(reached, REJECT_MOST)))


def training_sample(
    docs: DataFrame, learn_from: Column, text_col: str, lang_col: str, id_col: str, per_language: int
) -> list[tuple[bytes, str]]:
    """At most `per_language` whole texts of each language, lowest hash first.

    Languages are counted first, which gives the range of hashes to fetch.
    """
    rows = docs.where(learn_from & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.xxhash64(F.col(id_col), F.lit(17)).alias("drawn"),
        F.col(lang_col).cast("string").alias("lang"),
        F.col(text_col).cast("string").alias("text"),
    )
    bounds = rows.groupBy("lang").agg(F.count("*").alias("n")).collect()
    top = (1 << 63) - 1
    wanted = F.lit(False)
    for row in bounds:
        # Hashes are uniform: this range holds about 1.3 times the wanted number.
        share = min(1.0, 1.3 * per_language / row.n)
        edge = top if share == 1.0 else int(-(1 << 63) + share * (1 << 64))
        wanted = wanted | ((F.col("lang") == row.lang) & (F.col("drawn") <= F.lit(edge)))
    found = rows.where(wanted).collect() if bounds else []
    taken: dict[str, int] = {}
    sample = []
    for row in sorted(found, key=lambda r: (r.drawn, r.lang, r.text)):
        taken[row.lang] = taken.get(row.lang, 0) + 1
        if taken[row.lang] <= per_language and row.text:
            sample.append((row.text.encode(), row.lang))
    return sample


def _predict(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: LanguageModel = model.value
        names = np.array([*m.languages, UNKNOWN], object)
        for whole in batches:
            for batch in slices(whole, "named_text", 1 << 20):
                texts = [x or b"" for x in as_bytes(batch.column("named_text"))]
                known = np.array([_LETTER.search(x.decode("utf-8", "replace")) is not None for x in texts], bool)
                known &= len(m.languages) > 0
                pred = np.full(len(texts), len(m.languages))
                score = np.zeros(len(texts))
                if known.any():
                    p = _softmax(_scores(texts, m) / m.temperature)
                    pred[known], score[known] = p.argmax(axis=1)[known], p.max(axis=1)[known]
                yield pa.RecordBatch.from_arrays(
                    batch.columns
                    + [
                        pa.array(names[pred].tolist(), pa.string()),
                        pa.array(score),
                        pa.array(~known | (score < m.reject_below)),
                    ],
                    names=[*batch.schema.names, *ADDED],
                )

    return tidy(run)


# Bytes of text whose n-grams are looked up at once; each takes some 100 meanwhile.
PIECE_BYTES = 1 << 16


def _scores(texts: list[bytes], m: LanguageModel, piece: int = PIECE_BYTES) -> np.ndarray:
    """Mean table row of every text; n-grams don't cross texts, whose ends are boundaries."""
    total = np.zeros((len(texts), len(m.languages)))
    lengths = np.array([len(t) + 2 for t in texts])
    joined = np.frombuffer(b"".join(x for t in texts for x in (b" ", t, b" ")), np.uint8)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    over = max(ORDERS) - 1
    counts = np.zeros(len(texts))
    for order in ORDERS:
        counts += np.maximum(0, lengths - order + 1)
    for at in range(0, len(joined), piece):
        part = joined[at : at + piece + over]
        for order, ids in zip(ORDERS, _buckets(part), strict=True):
            n = min(piece, len(part) - order + 1)
            if n <= 0:
                continue
            who = owner[at : at + n]
            inside = np.arange(at, at + n) + order <= ends[who]
            rows = m.table[ids[:n]] * inside[:, None]
            first, last = who[0], who[-1]
            cuts = np.maximum(starts[first : last + 1] - at, 0)
            total[first : last + 1] += np.add.reduceat(rows, cuts, axis=0, dtype=np.float64)
    return total / np.maximum(counts, 1)[:, None] + m.bias


def fit(
    docs: DataFrame,
    *,
    learn_from: Column | None = None,
    text_col: str = "text",
    lang_col: str = "lang",
    id_col: str = "doc_id",
    sample_per_language: int = SAMPLE_PER_LANGUAGE,
) -> LanguageModel:
    """A model from the documents that have a language (and meet `learn_from`, a condition on the three columns named here)."""
    docs = picked(docs, **{name: name for name in (id_col, text_col, lang_col)})
    condition = F.lit(True) if learn_from is None else learn_from
    sample = training_sample(docs, condition, text_col, lang_col, id_col, sample_per_language)
    if not sample:
        empty = np.zeros((1 << BUCKET_BITS, 0), np.float32)
        return LanguageModel([], empty, np.zeros(0, np.float32), 1.0, 0.0)
    return train([t for t, _ in sample], [x for _, x in sample])


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """The documents with lang_pred, score and rejected behind their own columns (as the last three)."""
    spark = docs.sparkSession
    own = [f"own_{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*own)
    rows = rows.withColumn("named_text", rows[own[docs.columns.index(text_col)]].cast("string"))
    schema = StructType(
        [StructField(f.name, f.dataType) for f in rows.schema.fields]
        + [StructField(n, k) for n, k in zip(ADDED, (StringType(), DoubleType(), BooleanType()), strict=True)]
    )
    # Its size is fixed: 2 ** BUCKET_BITS rows of one float per language.
    found = rows.mapInArrow(_predict(spark.sparkContext.broadcast(model)), schema).drop("named_text")
    return found.toDF(*docs.columns, *free_names(docs.columns, ADDED))


def recognised(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """The documents whose language is not rejected, with their own columns."""
    return first_columns(identify(docs, model, text_col), docs.columns, lambda rejected: ~rejected)


def held_out(id_col: str = "doc_id") -> Column:
    """True for the third of the documents that is never learned from; null ids are neither."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def learnable(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 != 1, F.lit(False))

"""Deterministic hash vectors and cosine similarity."""

from __future__ import annotations

import sys
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F

from tidewright.functions.binding import let

# The task functions travel with their code, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DEFAULT_DIM = 512
_WORDS_PER_DIGEST = 8
_TEXTS_AT_ONCE = 512


def _digest_vectors(texts: list[bytes], dim: int) -> np.ndarray:
    """One unit row per text; lengths are added up from left to right, as `norm` does."""
    heads = [b"%d:" % i for i in range(-(-dim // _WORDS_PER_DIGEST))]
    digests = b"".join(sha256(head + text).digest() for text in texts for head in heads)
    words = np.frombuffer(digests, dtype=">u4").reshape(len(texts), -1)[:, :dim]
    vectors = words / 2147483648.0 - 1.0
    length = np.sqrt(np.cumsum(vectors * vectors, axis=1)[:, -1:])
    length[length == 0.0] = 1.0
    return vectors / length


def hash_vector(text: Column, dim: int = DEFAULT_DIM, item: str = "double") -> Column:
    """Unit vector from SHA-256 digests of `"<i>:<text>"`, its components as `item` (double or float).

    Each digest gives eight big-endian 32-bit words mapped to [-1, 1]. The
    digests of a whole Arrow batch become numbers at once; no text gives a
    vector of NULLs.
    """

    @F.arrow_udf(f"array<{item}>")
    def vectors(texts: pa.Array) -> pa.Array:
        kind = {"double": np.float64, "float": np.float32}[item]
        flat = np.empty((len(texts), dim), dtype=kind)
        for at in range(0, len(texts), _TEXTS_AT_ONCE):
            part = texts.slice(at, _TEXTS_AT_ONCE).to_pylist()
            flat[at : at + len(part)] = _digest_vectors([t.encode() for t in part], dim)
        ends = np.arange(len(texts) + 1, dtype=np.int32) * dim
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.ravel()))

    nothing = F.array_repeat(F.lit(None).cast(item), dim)
    return F.when(text.isNull(), nothing).otherwise(vectors(F.coalesce(text, F.lit(""))))


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda acc, v: acc + v * v))


def unit(vector: Column) -> Column:
    """Divide by the length; a zero vector stays as it is."""
    with_length = let(
        vector,
        lambda v: F.struct(
            v.alias("v"), F.coalesce(F.nullif(norm(v), F.lit(0.0)), F.lit(1.0)).alias("n")
        ),
    )
    return let(
        with_length, lambda s: F.transform(s.getField("v"), lambda x: x / s.getField("n"))
    )


def cosine(left: Column, right: Column) -> Column:
    a = left.cast("array<double>")
    b = right.cast("array<double>")
    dot = F.aggregate(
        F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v
    )
    return F.try_divide(dot, norm(a) * norm(b))

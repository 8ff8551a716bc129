"""Text to normalised vectors."""

from __future__ import annotations

import hashlib
import sys
import types
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from jobloom.functions.text import _col, collapse

Encoder = Callable[[Sequence[str]], np.ndarray]


def hashed_vectors(df: DataFrame, text: str, dim: int = 256,
                   output: str = "embedding") -> DataFrame:
    """Vectors without a model: hashed word counts, scaled to length 1. Runs in the JVM."""
    words = F.split(F.lower(collapse(F.coalesce(_col(text), F.lit("")))), " ")
    tokens = df.withColumn("_words", F.filter(words, lambda w: w != ""))
    counted = HashingTF(inputCol="_words", outputCol="_counts", numFeatures=dim).transform(tokens)
    scaled = Normalizer(inputCol="_counts", outputCol="_scaled", p=2.0).transform(counted)
    return scaled.withColumn(output, vector_to_array("_scaled", "float32")).drop(
        "_words", "_counts", "_scaled")


def once_per_worker(name: str, make_encoder: Callable[[], Encoder]) -> Encoder:
    """The encoder of this worker process, made at the first call.

    Functions travel inside their task, so a module of this package is new in every task; the
    encoder is kept in a module of its own, which lives as long as the process. One encoder
    is kept at a time.
    """
    home = sys.modules.setdefault("_jobloom_encoder", types.ModuleType("_jobloom_encoder"))
    if getattr(home, "name", None) != name:
        home.encode = None
        home.encode, home.name = make_encoder(), name
    return home.encode


def _lists(vectors: np.ndarray, known: np.ndarray) -> pa.Array:
    """Rows of a matrix as an Arrow list column, null where a row is not known."""
    dim = vectors.shape[1] if vectors.ndim == 2 else 0
    ends = np.concatenate([[0], np.cumsum(known) * dim]).astype(np.int32)
    mask = pa.array(~known) if len(known) else None
    return pa.ListArray.from_arrays(
        pa.array(ends), pa.array(vectors.astype(np.float32).ravel()), mask=mask)


def encode_texts(df: DataFrame, text: str, make_encoder: Callable[[], Encoder],
                 batch_size: int = 32, output: str = "embedding") -> DataFrame:
    """Vectors from a caller's model.

    ``make_encoder`` runs once per worker process and returns a function from texts to a 2-d
    array; it is fed ``batch_size`` texts at a time. Rows without text get a null vector.
    """
    name = hashlib.sha256(cloudpickle.dumps(make_encoder)).hexdigest()

    @F.arrow_udf("array<float>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = once_per_worker(name, make_encoder)
        for batch in batches:
            known = np.asarray(batch.is_valid())
            texts = batch.drop_null().to_pylist()
            found = [np.asarray(encode(texts[at:at + batch_size]), dtype=np.float64)
                     for at in range(0, len(texts), batch_size)]
            matrix = np.concatenate(found) if found else np.zeros((0, 0))
            length = np.linalg.norm(matrix, axis=1, keepdims=True)
            yield _lists(matrix / np.where(length > 0, length, 1.0), known)

    return df.withColumn(output, run(_col(text)))


def require_text(df: DataFrame, text: str) -> DataFrame:
    """The same rows; the job fails on a blank query text."""
    c = F.col(text)
    blank = F.raise_error(F.lit("query text is empty")).cast("string")
    return df.withColumn(text, F.when(c.isNull() | (c == ""), blank).otherwise(c))


def embed_text_column(df: DataFrame, text: str, make_encoder=None, dim: int = 256,
                      batch_size: int = 32, output: str = "embedding") -> DataFrame:
    if make_encoder is None:
        return hashed_vectors(df, text, dim, output)
    return encode_texts(df, text, make_encoder, batch_size, output)


def embed_queries(df: DataFrame, text: str, make_encoder=None, dim: int = 256,
                  output: str = "embedding") -> DataFrame:
    return embed_text_column(require_text(df, text), text, make_encoder, dim, 1, output)

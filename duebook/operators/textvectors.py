"""Text vectors without a language model: hashed words, weighted by rarity, of length one.

Words fall into buckets by a stable hash, so no vocabulary is learnt and every text gives as many numbers as there are
buckets, whatever the corpus. One pass counts in how many texts each bucket occurs; the rest is done row by row.
"""

from __future__ import annotations

from pyspark.ml.feature import IDF, CountVectorizerModel, IDFModel, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.functions.keys import hash_bucket
from duebook.functions.text import words

BUCKETS = 256
#: Chunks of a document at most, where a chunk's number is part of its key.
CHUNKS_PER_DOCUMENT = 1_000_000


def hashed_counts(texts: DataFrame, text: str, buckets: int = BUCKETS) -> DataFrame:
    """Adds ``counts``, the words of each bucket; NULL and blank texts have none."""
    names = F.transform(words(F.lower(text)), lambda w: hash_bucket(w, buckets).cast("string"))
    counter = CountVectorizerModel.from_vocabulary([str(i) for i in range(buckets)], inputCol="buckets", outputCol="counts")
    return counter.transform(texts.withColumn("buckets", names)).drop("buckets")


def fit_rarity(counted: DataFrame) -> IDFModel:
    """ln((texts + 1) / (texts with the bucket + 1)) per bucket."""
    return IDF(inputCol="counts", outputCol="weights").fit(counted)


def unit_vectors(counted: DataFrame, rarity: IDFModel) -> DataFrame:
    """``counts`` becomes ``vector``: weighted by rarity, of length one; all zero for a text without rare words."""
    scaled = Normalizer(inputCol="weights", outputCol="unit").transform(rarity.transform(counted))
    return scaled.withColumn("vector", vector_to_array("unit")).drop("counts", "weights", "unit")


def chunk_keys(chunks: DataFrame) -> DataFrame:
    """(vec_id, chunk_text) with a number for each chunk."""
    key = F.col("doc_id") * CHUNKS_PER_DOCUMENT + F.col("chunk_index")
    return chunks.select(key.alias("vec_id"), "chunk_text")

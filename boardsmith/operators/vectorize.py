"""U4: text -> dense unit vector with Spark ML (tokenize, hash, idf-weight, L2-normalise).

Re-aimed from a hosted embedding call; a caller-supplied model can instead run through
the enrichment hook (U3).  The IDF fit is one distributed aggregation; the transform is
row-local.  The output is ``array<float>`` so it feeds the cosine search (C4/F1) directly.
"""

from __future__ import annotations

from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIMS = 256


class TextVectorizer:
    """A fitted text -> vector model (tokenizer, hashing, IDF weights, L2 norm); apply it to
    the corpus and to queries so both live in the same space."""

    def __init__(self, text_col: str, dims: int, stages):
        self.text_col, self.dims, self._tok, self._tf, self._idf, self._norm = text_col, dims, *stages

    def transform(self, df: DataFrame, text_col: str | None = None, out: str = "content_vector") -> DataFrame:
        col = text_col or self.text_col
        d = df.withColumn("_text", F.coalesce(F.col(col), F.lit("")))
        v = self._norm.transform(self._idf.transform(self._tf.transform(self._tok.transform(d))))
        return v.withColumn(out, vector_to_array("_n", "float32")).drop("_text", "_tok", "_tf", "_idf", "_n")


def fit_text_vectors(df: DataFrame, text_col: str = "content", dims: int = DIMS, min_df: int = 1) -> TextVectorizer:
    """Fit the IDF weights on ``df`` (one distributed aggregation)."""
    tok = RegexTokenizer(inputCol="_text", outputCol="_tok", pattern=r"[\p{L}\p{N}]+", gaps=False, toLowercase=True)
    tf = HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=dims)
    t = tf.transform(tok.transform(df.select(F.coalesce(F.col(text_col), F.lit("")).alias("_text"))))
    idf_model = IDF(inputCol="_tf", outputCol="_idf", minDocFreq=min_df).fit(t)
    return TextVectorizer(text_col, dims, (tok, tf, idf_model, Normalizer(inputCol="_idf", outputCol="_n", p=2.0)))


def text_vectors(df: DataFrame, text_col: str = "content", out: str = "content_vector", dims: int = DIMS, min_df: int = 1) -> DataFrame:
    """U4: fit on ``df`` and vectorise it."""
    return fit_text_vectors(df, text_col, dims, min_df).transform(df, text_col, out)

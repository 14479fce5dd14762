"""JSON decoding of texts that must be one whole object."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardsmith.functions.util import as_col


def whole_object(c, schema: T.StructType) -> Column:
    """The struct of a JSON object that is the whole text, or null: any text before or after it makes it undecodable.

    Spark's decoder stops at the end of the object.  So the text is decoded as an element of an array whose other element
    holds the text's own digest: what follows the object breaks the array or changes its length.
    """
    c = as_col(c)
    end = F.sha1(c)
    kind = T.ArrayType(T.StructType([*schema.fields, T.StructField("_end", T.StringType())]))
    both = F.from_json(F.concat(F.lit("["), c, F.lit(',{"_end":"'), end, F.lit('"}]')), kind, {"mode": "PERMISSIVE", "allowSingleQuotes": "false"})
    whole = c.rlike(r"\A\s*\{") & (F.size(both) == 2) & (F.get(both, F.lit(1))["_end"] == end)
    first = F.get(both, F.lit(0))
    return F.when(whole, F.struct(*[first[f.name].alias(f.name) for f in schema.fields]))

"""Arrow-batched UDF factories.

Kept in a module without postponed annotations: ``pandas_udf`` reads the
type hints of the wrapped function to pick the UDF kind.
"""

import pandas as pd
from pyspark.sql import functions as F


def string_udf(batch_fn):
    """Wrap ``batch_fn(list[str]) -> list[str]`` as a scalar pandas UDF."""

    @F.pandas_udf("string")
    def _str(words: pd.Series) -> pd.Series:
        return pd.Series(batch_fn(words.tolist()), dtype=object)

    return _str

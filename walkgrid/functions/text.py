"""Text and number shaping for reports."""

from __future__ import annotations

from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _match_key_udf():
    # defined here, so it travels by value and workers need not import this package
    def match_key(names: pd.Series) -> pd.Series:
        import unicodedata

        return names.map(lambda s: unicodedata.normalize("NFKC", s).casefold().strip(), na_action="ignore")

    return F.pandas_udf(match_key, "string")


def match_key(name: Column) -> Column:
    """Caseless key of a name (NFKC, casefold, strip). Spark has no NFKC, hence the one Arrow UDF.

    Meant for name dimensions, not for fact rows.
    """
    return _match_key_udf()(name)


def label(key: Column, labels: Mapping[str, str]) -> Column:
    """Label of a key, or the key capitalised."""
    pairs = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, key), F.initcap(key))

"""Text normalisation."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def capitalised(raw: Column) -> Column:
    """Trimmed, first letter upper case, everything after it lower case."""
    value = F.trim(raw)
    return F.concat(F.upper(F.substring(value, 1, 1)), F.lower(F.substr(value, F.lit(2))))


def loosely_in(value: Column, words: list[str]) -> Column:
    """Membership ignoring case and accents."""
    return F.collate(value, "UNICODE_CI_AI").isin(words)


def labelled(code: Column, labels: dict[str, str]) -> Column:
    """Label of a code from a small fixed list; NULL when the code is not listed."""
    pairs = [F.lit(part) for item in labels.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), code)


@F.pandas_udf(T.StringType())
def _ascii(text: pd.Series) -> pd.Series:
    """Spark has no compatibility decomposition, hence the Arrow batch."""
    return text.str.normalize("NFKD").str.encode("ascii", "ignore").str.decode("ascii")


def ascii_slug(text: Column | str) -> Column:
    """Accents stripped, lower case, letters and digits only."""
    return F.regexp_replace(F.lower(_ascii(text)), "[^a-z0-9]", "")

"""Surrogate keys."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_key(*parts: Column) -> Column:
    """MD5 of the parts as text, joined with a bar; NULL counts as empty text."""
    return F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))

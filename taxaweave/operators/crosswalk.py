"""Id crosswalks (C8, K8). A key that repeats on both sides gives the product of
its rows, as the equality join of the source semantics does."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def crosswalk_join(
    taxa: DataFrame,
    records: DataFrame,
    keys: Sequence[str],
    taxa_id: str = "id",
    record_id: str = "id",
    where: Column | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """(taxon id, record id) for records matching a taxon on all ``keys``.

    With ``null_safe=False`` a NULL key never matches (SQL equality); the
    ``null_safe`` variant treats NULL = NULL. The join fans out only as far as
    the keys repeat on either side. Shuffle join on the keys; AQE splits a
    hot key on the larger side.
    """
    if where is not None:
        records = records.where(where)
    r = records.select(*[F.col(f"`{k}`").alias(f"__r_{k}") for k in keys], F.col(record_id).alias("external_id"))
    t = taxa.select(*[F.col(f"`{k}`") for k in keys], F.col(taxa_id).alias("__taxon_id"))
    cond = None
    for k in keys:
        e = t[k].eqNullSafe(r[f"__r_{k}"]) if null_safe else (t[k] == r[f"__r_{k}"])
        cond = e if cond is None else (cond & e)
    return t.join(r, cond, "inner").select(F.col("__taxon_id").alias("id"), "external_id")

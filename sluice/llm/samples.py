"""Labelled rows that the classifiers are fitted on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled(labels: DataFrame, label: str, learn: Column, per_class: int | None, id_col: str = "doc_id") -> DataFrame:
    """``(id, y, _order)``: for labels 0 and 1 the ``per_class`` ids of least hash among the rows of ``learn``, or all (None).

    Ids with a null label, and ids labelled both ways, are left out.
    """
    one = (labels.where(learn & F.col(label).isin(0, 1) & F.col(id_col).isNotNull())
           .groupBy(id_col).agg(F.min(label).alias("y"), F.max(label).alias("_most"))
           .where("y = _most").select(id_col, "y", F.xxhash64(id_col).alias("_order")))
    if per_class is None:
        return one
    return (one.where("y = 0").orderBy("_order").limit(per_class)
            .union(one.where("y = 1").orderBy("_order").limit(per_class)))


def rows_of(docs: DataFrame, sample: DataFrame, text: str, max_bytes: int, id_col: str = "doc_id") -> DataFrame:
    """Texts of at most ``max_bytes`` of the sampled ids.  The sample's row bound makes it fit for broadcast."""
    return (docs.where(F.col(text).isNotNull() & (F.octet_length(text) <= max_bytes))
            .join(F.broadcast(sample), id_col))

"""Label arithmetic for word tagging."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import IGNORE_LABEL, NER_LABELS


def _literal_map(pairs: Mapping) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def map_labels(labels: Column, label_ids: Mapping[str, int] = NER_LABELS) -> Column:
    """Label names -> ids; names outside the dictionary -> the ignore label."""
    table = _literal_map(label_ids)
    return F.transform(
        labels, lambda name: F.coalesce(F.try_element_at(table, name), F.lit(IGNORE_LABEL))
    )


def name_labels(ids: Column, label_ids: Mapping[str, int] = NER_LABELS) -> Column:
    """Label ids -> names, through the inverted dictionary."""
    table = _literal_map({i: name for name, i in label_ids.items()})
    return F.transform(ids, lambda i: F.try_element_at(table, i))


def argmax(scores: Column) -> Column:
    """0-based index of the largest score, the first one on ties."""
    return F.array_position(scores, F.array_max(scores)).cast("int") - 1


def keep_labelled(values: Column, labels: Column) -> Column:
    """The values at positions whose label is not the ignore label."""
    zipped = F.arrays_zip(values.alias("value"), labels.alias("label"))
    kept = F.filter(zipped, lambda z: z["label"] != IGNORE_LABEL)
    return F.transform(kept, lambda z: z["value"])

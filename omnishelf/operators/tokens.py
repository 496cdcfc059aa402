"""Map the tokens of a multi-valued text column to labels, per item or per text."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from omnishelf.functions.keys import norm_key
from omnishelf.operators.dedupe import reduce_for_join


def map_tokens(
    df: DataFrame,
    tokens: Column,
    mapping: DataFrame,
    out: str,
    id_cols: Sequence[str],
    distinct: bool = True,
    separator: str = ",",
) -> DataFrame:
    """Add ``out``: the labels of the item's tokens, ordered and joined; NULL when none is mapped.

    The item is named by ``id_cols``: all rows that share it get the labels of all of them, each
    once, or with ``distinct=False`` as often as the tokens occur. A row whose id has a NULL is no
    item and gets no labels. ``mapping`` is (token_key, label), unique on token_key; tokens without
    a label are dropped. The result does not depend on the size of the mapping.

    Tokens are counted per item and key before they meet the mapping, so neither a frequent token
    nor a repeated item sends more than one row per task, item and key. What is gathered per item is
    its distinct labels, or its distinct mapped keys with their counts: both bounded by the mapping.
    """
    labels = _labels(df, tokens, mapping, out, id_cols, distinct, separator)
    same = [F.col(c) == F.col(f"_id_{i}") for i, c in enumerate(id_cols)]
    return df.join(labels, same, "left").drop(*[f"_id_{i}" for i in range(len(id_cols))])


def label_texts(
    texts: DataFrame,
    split: Callable[[str], Column],
    mapping: DataFrame,
    distinct: bool = True,
    separator: str = ",",
) -> DataFrame:
    """(text, label) of the texts of a one-column relation that have mapped tokens, unique on text.

    For rows that are items of their own: their labels depend on the text alone, so equal texts are
    mapped once and the rows take their labels by an ``attach``, without being grouped by item.
    Otherwise as ``map_tokens``.
    """
    once = texts.toDF("text").filter("text IS NOT NULL").distinct()
    labels = _labels(once, split("text"), mapping, "label", ["text"], distinct, separator)
    return labels.withColumnRenamed("_id_0", "text")


def _labels(
    df: DataFrame,
    tokens: Column,
    mapping: DataFrame,
    out: str,
    id_cols: Sequence[str],
    distinct: bool,
    separator: str,
) -> DataFrame:
    """Labels of the items that have any; their ids are named ``_id_0`` and so on."""
    known = mapping.filter("token_key IS NOT NULL AND label IS NOT NULL")
    named = [F.col(c).isNotNull() for c in id_cols]
    item = df
    for present in named:
        item = item.filter(present)
    counted = (
        item.select(*id_cols, F.explode(tokens).alias("_token"))
        .groupBy(*id_cols, norm_key("_token").alias("_key"))
        .agg(F.count("*").alias("_n"))
    )
    mapped = counted.join(known, F.col("_key") == F.col("token_key"))
    if distinct:
        listed = F.sort_array(F.collect_set("label"))
    else:
        times = F.col("_n").cast("int").alias("times")
        gathered = F.sort_array(F.collect_list(F.struct("label", times)))
        listed = F.flatten(F.transform(gathered, lambda x: F.array_repeat(x["label"], x["times"])))
    return reduce_for_join(
        mapped,
        {f"_id_{i}": c for i, c in enumerate(id_cols)},
        {out: F.array_join(listed, separator)},
    )

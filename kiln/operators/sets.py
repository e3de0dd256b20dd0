"""Set operations (inventory family G)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.constants import CLASSIFIER_MAX_TOKENS
from kiln.functions.tokenize import WORDS
from kiln.operators.ranking import first_n_per_group
from kiln.operators.rows import encode_labels


def union_all(*frames: DataFrame, tags: list[str] | None = None, tag_col: str = "source") -> DataFrame:
    """Union-all by column name (duplicates kept), optionally tagging each input."""
    fs = list(frames)
    if tags:
        fs = [f.withColumn(tag_col, F.lit(t)) for f, t in zip(fs, tags)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), fs)


def classifier_corpus(responses: DataFrame, group=("constitution", "method"), order="pos",
                      n: int = 500, text="response", max_tokens: int = CLASSIFIER_MAX_TOKENS, tokenizer=WORDS) -> DataFrame:
    """G5 (+F7, B25, C8): the first ``n`` responses per group with their label id and
    the text the classifier sees after right truncation, up to the end of its ``max_tokens``-th token."""
    first = first_n_per_group(responses, list(group), order, n, out="rank_in_group")
    return (encode_labels(first)
            .withColumn("n_tokens", tokenizer.count(text)).withColumn("kept_text", tokenizer.first(text, max_tokens)))

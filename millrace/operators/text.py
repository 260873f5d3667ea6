"""Story pairs, generated text and overlap scores."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import conditions, maths, strings


def story_pairs(
    df: DataFrame, key: str, sentences: Sequence[str], ending: str, null_policy: str = "strict"
) -> DataFrame:
    """Context of the leading sentences next to the ending."""
    return df.select(key, strings.join_words(sentences, null_policy).alias("context"), F.col(ending).alias("ending"))


def cloze_pairs(
    df: DataFrame, key: str, sentences: Sequence[str], first: str, second: str, answer: str
) -> DataFrame:
    """As ``story_pairs``, with the right one of two endings."""
    right = conditions.pick_by_flag(F.col(answer), F.col(first), F.col(second))
    return story_pairs(df.withColumn("__right", right), key, sentences, "__right")


def full_story(df: DataFrame, context: str = "context", ending: str = "ending") -> DataFrame:
    return df.withColumn("story", F.concat(F.col(context), F.lit(" "), F.col(ending)))


def parse_generated(df: DataFrame, text: str) -> DataFrame:
    """Beginning and ending of generated text that still holds its prompt."""
    line = strings.one_line(F.col(text))
    return df.withColumns({"beginning": strings.between_markers(line), "ending": strings.after_marker(line)})


def empty_results(df: DataFrame, text: str) -> DataFrame:
    """Rows whose text is missing or blank."""
    return df.filter(F.col(text).isNull() | (F.trim(text) == ""))


def words(col: Column) -> Column:
    """Lower-case runs of letters a-z and digits."""
    return F.regexp_extract_all(F.lower(col), F.lit("[a-z0-9]+"), F.lit(0))


def _grams(tokens: Column, n: int) -> Column:
    """Runs of ``n`` tokens, built from shifted slices so that tokens are not split again per gram."""
    size = F.greatest(F.size(tokens) - F.lit(n - 1), F.lit(0))
    grams = F.slice(tokens, F.lit(1), size)
    for shift in range(1, n):
        grams = F.zip_with(grams, F.slice(tokens, F.lit(shift + 1), size), lambda a, b: F.concat_ws(" ", a, b))
    return grams


def _with_scores(df: DataFrame) -> DataFrame:
    p = F.coalesce(maths.share(F.col("overlap"), F.col("n_pred")), F.lit(0.0))
    r = F.coalesce(maths.share(F.col("overlap"), F.col("n_ref")), F.lit(0.0))
    out = df.withColumns({"precision": p, "recall": r})
    f1 = maths.share(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return out.withColumn("f1", F.coalesce(f1, F.lit(0.0)))


def rouge_n(df: DataFrame, key: Sequence[str], prediction: str, reference: str, n: int = 1) -> DataFrame:
    """Overlap of n-grams, counted with repeats, per row key.

    Grams of both sides are counted together per key and gram, partly on the
    map side; no join is needed.
    """
    side = lambda c, p: F.transform(
        _grams(F.col(c), n), lambda g: F.struct(g.alias("gram"), F.lit(p).alias("p"), F.lit(1 - p).alias("r"))
    )
    tokens = df.select(*key, words(F.col(prediction)).alias("__p"), words(F.col(reference)).alias("__r"))
    # A null gram keeps rows that have no grams at all.
    none = F.array(F.struct(F.lit(None).cast("string").alias("gram"), F.lit(0).alias("p"), F.lit(0).alias("r")))
    grams = tokens.select(*key, F.explode(F.concat(side("__p", 1), side("__r", 0), none)).alias("g"))
    counts = grams.groupBy(*key, "g.gram").agg(F.sum("g.p").alias("p"), F.sum("g.r").alias("r"))
    return _with_scores(
        counts.groupBy(*key).agg(
            F.sum(F.least("p", "r")).alias("overlap"), F.sum("p").alias("n_pred"), F.sum("r").alias("n_ref")
        )
    )


def common_subsequence(a: Sequence[str], b: Sequence[str]) -> int:
    """Length of the longest common subsequence, 64 and more cells per machine operation.

    Bits of ``row`` stand for the tokens of ``a``; each zero bit left at the end is one match.
    """
    where: dict[str, int] = {}
    for i, token in enumerate(a):
        where[token] = where.get(token, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for token in b:
        hit = row & where.get(token, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


@F.pandas_udf(T.IntegerType())
def _lcs(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for a, b in batches:
        yield pd.Series([common_subsequence(x, y) for x, y in zip(a, b)], dtype="int32")


def rouge_l(df: DataFrame, key: Sequence[str], prediction: str, reference: str) -> DataFrame:
    """Longest common subsequence of the whole token lists, per row."""
    tokens = df.select(*key, words(F.col(prediction)).alias("a"), words(F.col(reference)).alias("b"))
    out = tokens.select(
        *key, _lcs("a", "b").alias("overlap"), F.size("a").alias("n_pred"), F.size("b").alias("n_ref")
    )
    return _with_scores(out)


def mean_scores(scores: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return scores.groupBy(*keys).agg(
        *[F.avg(c).alias(c) for c in ("precision", "recall", "f1")], F.count(F.lit(1)).alias("n")
    )


def label_codes(df: DataFrame, text: str, label: str = "HS Code: ") -> DataFrame:
    """Distinct codes found in the texts."""
    return df.select(F.explode(strings.find_codes(F.col(text), label)).alias("code")).distinct()

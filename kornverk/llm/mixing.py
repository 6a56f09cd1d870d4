"""Training mix with target shares of tokens: a rate for each source, and Bernoulli draws for its fraction.

A source with target share s of all tokens T and t tokens of its own is used at rate s * T / t, at most ``max_uses``. A document
is used as often as the whole part of the rate says, and once more with the fraction as probability, drawn from a hash of its key.
"""

from __future__ import annotations

import base64
from functools import cache

import public_tokenizers
import tiktoken
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..arrow import map_columns

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


@cache
def _encoding() -> tiktoken.Encoding:
    with open(public_tokenizers.path(VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(text: str | None) -> int:
    return len(_encoding().encode_ordinary(text)) if text else 0


def _even(source: Column) -> Column:
    return F.lower(F.regexp_replace(source, r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))


def document_tokens(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """(key, source, tokens) of every document; the source is trimmed and lower-cased, a null text has no tokens."""
    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(key).alias("k"), _even(F.col(source)).alias("s"), F.col(text).alias("t"))
    got = map_columns(rows, lambda c: {"k": c["k"], "s": c["s"], "n": list(map(count_tokens, c["t"]))}, f"k {kind}, s string, n bigint")
    return got.select(F.col("k").alias(key), F.col("s").alias("source"), F.col("n").alias("tokens"))


def rates(tokens: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, max_uses, tokens, target_tokens, rate, short) of every target; documents of other sources count in all tokens only."""
    goal = F.broadcast(targets.select(_even(F.col("source")).alias("source"), "target_share", "max_uses"))
    known = tokens.join(goal.select("source", F.lit(True).alias("known")), "source", "left").select(F.when(F.col("known"), F.col("source")).alias("source"), "tokens")
    each = known.unionByName(goal.select("source", F.lit(0).cast("bigint").alias("tokens"))).groupBy("source").agg(F.sum("tokens").alias("tokens"))
    of_all = each.withColumn("total", F.sum("tokens").over(Window.partitionBy(F.lit(1))))  # a row for each target and one for the rest
    found = of_all.join(goal, "source").withColumn("target_tokens", F.col("target_share") * F.col("total"))
    rate = F.when(F.col("tokens") > 0, F.least(F.col("target_tokens") / F.nullif(F.col("tokens"), F.lit(0)), F.col("max_uses").cast("double"))).otherwise(0.0)
    short = F.col("tokens") * F.col("max_uses") < F.col("target_tokens")
    return found.select("source", "target_share", "max_uses", "tokens", "target_tokens", "total", rate.alias("rate"), short.alias("short"))


def mix(tokens: DataFrame, targets: DataFrame, key: str = "doc_id", seed: int = 42) -> DataFrame:
    """(key, source, tokens, uses) of every document that is used."""
    part = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 30)) / F.lit(1 << 30)
    rate = F.broadcast(rates(tokens, targets).select("source", "rate"))
    uses = F.floor("rate") + (part < F.col("rate") - F.floor("rate")).cast("bigint")
    return tokens.join(rate, "source").select(key, "source", "tokens", uses.alias("uses")).where("uses > 0")


def shares_reached(tokens: DataFrame, targets: DataFrame, key: str = "doc_id") -> DataFrame:
    """(source, target_share, reached_share, short): tokens in the mix as a share of the tokens of all documents."""
    used = mix(tokens, targets, key).groupBy("source").agg(F.sum(F.col("tokens") * F.col("uses")).alias("used"))
    got = rates(tokens, targets).join(used, "source", "left")
    return got.select("source", "target_share", F.coalesce(F.col("used") / F.nullif(F.col("total"), F.lit(0)), F.lit(0.0)).alias("reached_share"), "short")

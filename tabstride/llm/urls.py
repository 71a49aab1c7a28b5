"""URL filters: host and path rules, and gradient-boosted trees on lexical features.

Everything is column expressions and Spark ML.  Rules decide first, the longest that fits;
the trees judge the rest.  They learn from labelled URLs, of which a bounded sample is used.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabstride.llm.components import stored
from tabstride.llm.licenses import LOWER, UPPER
from tabstride.session import broadcast_if_small

ALLOW, BLOCK = "allow", "block"

# Rules of the query, host and path in one: fixed values.
RULES = (
    (ALLOW, "com/"),
    (BLOCK, "example.com/en/"),
    (ALLOW, "www.example.com/en/"),
    (BLOCK, "net/es/"),
    (BLOCK, "net/fr/"),
)

# Words in hosts that mark a URL as unwanted when no other labels are given: fixed values.  They
# stand in for labelled URLs, which the given tables lack.
SEED_WORDS = ("adult", "bets", "casino", "pills", "spam", "track")

FEATURES = (
    "url_length", "host_length", "path_length", "path_depth", "host_depth", "digit_ratio",
    "host_digit_ratio", "hyphens", "host_entropy", "path_entropy", "n_params", "has_fragment",
    "suffix_urls", "suffix_host_length", "parent_urls",
)


@dataclass(frozen=True)
class UrlModel:
    """Sizes of the fit: labelled rows per class at most, trees, depth."""

    most_labelled: int = 10_000
    trees: int = 12
    depth: int = 4
    seed: int = 42


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty without ``://`` or for null."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return F.translate(F.regexp_extract(text, pattern, 1), UPPER, LOWER), F.regexp_extract(text, pattern, 2)


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """Struct ``verdict, rule`` of the longest rule that fits, or null.

    A rule fits its host and the hosts below it when the path starts with the rule's path.
    The list is part of the plan, so it should be a short one.
    """
    choices = []
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        answer = F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))
        choices.append(F.when(fits, answer))
    return F.coalesce(*choices) if choices else F.lit(None).cast("struct<verdict:string,rule:string>")


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    letters = F.split(text, "")
    size = F.greatest(F.length(text), F.lit(1))

    def part(count: Column) -> Column:
        share = count / size
        return -share * F.log2(share)

    counts = F.transform(
        F.array_distinct(letters),
        lambda c: F.size(F.filter(letters, lambda x: x == c)),
    )
    return F.when(F.length(text) == 0, 0.0).otherwise(
        F.aggregate(counts, F.lit(0.0), lambda total, n: total + part(n))
    )


def _digit_share(text: Column) -> Column:
    rest = F.length(F.translate(text, "0123456789", ""))
    return (F.length(text) - rest) / F.greatest(F.length(text), F.lit(1))


def _count(text: Column, character: str) -> Column:
    return F.length(text) - F.length(F.translate(text, character, ""))


def _parts(df: DataFrame, url_col: str) -> DataFrame:
    """``_url, host, path`` and the host's last label and last two labels."""
    host, path = host_and_path(F.col(url_col))
    return df.withColumns({
        "_url": F.coalesce(F.col(url_col).cast("string"), F.lit("")), "host": host, "path": path,
    }).withColumns({
        "_suffix": F.substring_index("host", ".", -1), "_parent": F.substring_index("host", ".", -2),
    })


def _suffix_statistics(parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Counts of URLs under each last label and under each last two, over all rows."""
    suffix = stored(parts.groupBy("_suffix").agg(
        F.count("*").alias("_n"), F.avg(F.length("host")).alias("suffix_host_length")
    ), "suffixes")
    parent = stored(parts.groupBy("_parent").agg(F.count("*").alias("_m")), "parents")
    return suffix, parent


def _features(parts: DataFrame, statistics: tuple[DataFrame, DataFrame]) -> DataFrame:
    suffix, parent = statistics
    query = F.regexp_extract("_url", r"\?([^#]*)", 1)
    return (
        parts.join(broadcast_if_small(suffix), "_suffix", "left")
        .join(broadcast_if_small(parent), "_parent", "left")
        .withColumns({
            "url_length": F.length("_url").cast("double"),
            "host_length": F.length("host").cast("double"),
            "path_length": F.length("path").cast("double"),
            "path_depth": _count(F.col("path"), "/").cast("double"),
            "host_depth": _count(F.col("host"), ".").cast("double"),
            "digit_ratio": _digit_share(F.col("_url")).cast("double"),
            "host_digit_ratio": _digit_share(F.col("host")).cast("double"),
            "hyphens": _count(F.col("host"), "-").cast("double"),
            "host_entropy": _entropy(F.col("host")),
            "path_entropy": _entropy(F.col("path")),
            "n_params": F.when(F.length(query) > 0, _count(query, "&") + 1).otherwise(0).cast("double"),
            "has_fragment": F.col("_url").contains("#").cast("double"),
            "suffix_urls": F.log1p(F.coalesce("_n", F.lit(0))).cast("double"),
            "suffix_host_length": F.coalesce("suffix_host_length", F.lit(0.0)),
            "parent_urls": F.log1p(F.coalesce("_m", F.lit(0))).cast("double"),
        })
        .drop("_n", "_m")
    )


def seed_label(host: Column, words: Sequence[str] = SEED_WORDS) -> Column:
    """1 where the host holds one of the words, else 0."""
    return reduce(lambda a, b: a | b, [host.contains(w) for w in words]).cast("double")


def fit_urls(features: DataFrame, label_col: str, model: UrlModel | None = None) -> PipelineModel | None:
    """Trees fitted on rows with a label of 0 or 1; None if one of the classes has no row.

    Of each class at most about ``most_labelled`` rows are used, chosen by a hash of the URL.
    """
    model = model or UrlModel()
    labelled = features.filter(F.col(label_col).isin(0.0, 1.0))
    counts = {r["label"]: r["n"] for r in labelled.groupBy(F.col(label_col).alias("label"))
              .agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return None
    place = F.pmod(F.xxhash64(F.col("_url"), F.lit(model.seed)), F.lit(1_000_000))
    chosen = reduce(lambda a, b: a | b, [
        (F.col(label_col) == label) & (place < int(1_000_000 * min(1, model.most_labelled / n)))
        for label, n in counts.items()
    ])
    sample = stored(
        labelled.filter(chosen).select(*FEATURES, F.col(label_col).alias("label"), "_url")
        .repartition(4, "_url").sortWithinPartitions("_url").drop("_url"),
        "labelled",
    )
    if sample.select("label").distinct().count() < 2:
        return None
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    trees = GBTClassifier(
        labelCol="label", featuresCol="features", maxIter=model.trees, maxDepth=model.depth,
        stepSize=0.3, seed=model.seed, predictionCol="_blocked",
    ).fit(assembler.transform(sample))
    return PipelineModel([assembler, trees])


def judge(
    df: DataFrame,
    url_col: str = "url",
    id_col: str = "page_id",
    labels: DataFrame | None = None,
    rules: Sequence[tuple[str, str]] = RULES,
    model: UrlModel | None = None,
) -> DataFrame:
    """Per row ``id, host, path, rule, verdict``.

    ``labels`` has a URL column of the same name and ``label`` (1 unwanted, 0 wanted); without
    it the hosts of ``df`` are labelled by ``SEED_WORDS``.  A URL without a host has only
    features of its own text.  If no model can be fitted, what no rule decides is allowed.
    Repeated rows get equal answers, and URLs of any length are read whole; other columns are
    not read.  An empty table gives an empty result.
    """
    parts = _parts(df.select(id_col, url_col), url_col)
    statistics = _suffix_statistics(parts)
    described = _features(parts, statistics)
    if labels is None:
        fitting = described.withColumn("_label", seed_label(F.col("host")))
    else:
        own = labels.select(url_col, F.col("label").cast("double").alias("_label"))
        fitting = _features(_parts(own, url_col), statistics)
    fitted = fit_urls(fitting, "_label", model)
    decided = rule_for(F.col("host"), F.col("path"), rules)
    if fitted is None:
        scored = described.withColumn("_blocked", F.lit(0.0))
    else:
        scored = fitted.transform(described)
    guess = F.when(F.col("_blocked") == 1, BLOCK).otherwise(ALLOW)
    return scored.withColumn("_rule", decided).select(
        id_col, "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), guess).alias("verdict"),
    )

"""URL verdicts: domain and path rules first, gradient-boosted trees for the rest.

The URLs that a rule decides are the labelled ones. Trees learn from lexical
features of a bounded sample of them and judge the URLs that no rule fits.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FEATURES = (
    "f_length", "f_host_length", "f_labels", "f_depth", "f_digits", "f_entropy", "f_params",
    "f_hyphens", "f_suffix_rate", "f_suffix_count",
)


@dataclass(frozen=True)
class Rule:
    """``site`` is a host, a slash and what the path starts with after it."""

    verdict: str
    site: str

    def fits(self) -> Column:
        host, _, path = self.site.partition("/")
        own = (F.col("host") == host) | F.col("host").endswith(f".{host}")
        return own & F.col("path").startswith(f"/{path}")


# The rules.
RULES = (
    Rule("allow", "com/"),
    Rule("block", "example.com/en/"),
    Rule("allow", "www.example.com/en/"),
    Rule("block", "net/es/"),
    Rule("block", "net/fr/"),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A to Z lower-cased."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", F.coalesce(url, F.lit("")))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def entropy(text: Column) -> Column:
    """Bits per character of the distribution of characters."""
    size = F.length(text)

    def part(char: Column) -> Column:
        p = (size - F.length(F.replace(text, char, F.lit("")))) / size
        return -p * F.log2(p)

    chars = F.filter(F.array_distinct(F.split(text, "")), lambda c: c != "")
    return F.aggregate(F.transform(chars, part), F.lit(0.0), lambda a, x: a + x)


def lexical(urls: DataFrame) -> DataFrame:
    """Adds ``suffix`` and the features that one URL has by itself."""
    url, host = F.coalesce("url", F.lit("")), F.col("host")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return urls.withColumns({
        "suffix": F.substring_index("host", ".", -1),
        "f_length": F.length(url),
        "f_host_length": F.length(host),
        "f_labels": F.regexp_count(host, F.lit(r"\.")),
        "f_depth": F.regexp_count("path", F.lit("/[^/]")),
        "f_digits": F.coalesce(F.try_divide(F.regexp_count(url, F.lit("[0-9]")), F.length(url)), F.lit(0.0)),
        "f_entropy": entropy(url),
        "f_params": F.regexp_count(query, F.lit("[^&]+")),
        "f_hyphens": F.regexp_count(url, F.lit("[-_]")),
    })


def with_suffix_stats(urls: DataFrame, folds: int = FOLDS, prior: int = 10) -> DataFrame:
    """Adds the share of blocked URLs of the same suffix and the number of labelled ones.

    Labelled URLs are dealt into ``folds`` by a hash; a labelled URL gets the statistics
    of the other folds, so that its own label is in none of its features. The share is
    drawn to the overall one as if by ``prior`` more URLs and by all undecided ones of
    the suffix: where most are undecided, the few labelled ones say little.
    """
    total = _block_rate(urls)
    dealt = urls.withColumn("fold", F.when(F.col("label").isNotNull(), _fold(folds)))
    stats = dealt.groupBy("suffix", "fold").agg(F.count("*").alias("n"), F.sum("label").alias("blocked"))
    every = stats.groupBy("suffix").agg(
        F.sum(F.when(F.col("fold").isNotNull(), F.col("n"))).alias("n_all"), F.sum("blocked").alias("blocked_all"),
        F.sum(F.when(F.col("fold").isNull(), F.col("n"))).alias("undecided"),
    )
    n = F.coalesce("n_all", F.lit(0)) - F.when(F.col("fold").isNull(), 0).otherwise(F.coalesce("n", F.lit(0)))
    blocked = F.coalesce("blocked_all", F.lit(0.0)) - F.coalesce("blocked", F.lit(0.0))
    drawn = prior + F.coalesce("undecided", F.lit(0))
    own = stats.withColumnsRenamed({"suffix": "s", "fold": "f"})
    same = (dealt["suffix"] == own["s"]) & dealt["fold"].eqNullSafe(own["f"])
    return dealt.join(own, same, "left").join(every, "suffix", "left").withColumns({
        "f_suffix_rate": (blocked + drawn * F.lit(total)) / (n + drawn),
        "f_suffix_count": F.log1p(n.cast("double")),
    }).drop("s", "f", "n", "blocked", "n_all", "blocked_all", "undecided")


def _block_rate(urls: DataFrame) -> float:
    return urls.agg(F.avg("label").alias("rate")).first()["rate"] or 0.0


def _fold(folds: int) -> Column:
    return F.pmod(F.xxhash64(F.coalesce("url", F.lit("")), F.lit(17)), F.lit(folds)).cast("int")


def fitted(
    featured: DataFrame, *, share: float, trees: int, depth: int, seed: int
) -> PipelineModel:
    """Trees over a share of the labelled URLs, taken by a hash of the URL.

    Each is learnt twice, with the statistics of its suffix and as one of a suffix
    without labelled URLs, so that the suffix does not stand for the label and URLs of
    new suffixes are judged by their other features.
    """
    drawn = F.pmod(F.xxhash64("url", F.lit(seed)), F.lit(1_000_000)) < int(share * 1_000_000)
    sample = featured.where("label is not null").where(drawn).select(*FEATURES, "label")
    unknown = sample.withColumns({
        "f_suffix_rate": F.lit(_block_rate(featured)), "f_suffix_count": F.lit(0.0),
    })
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid="keep")
    learner = GBTClassifier(maxIter=trees, maxDepth=depth, seed=seed, stepSize=0.3)
    return Pipeline(stages=[assembler, learner]).fit(sample.unionByName(unknown).coalesce(8))


def scored(featured: DataFrame, model: PipelineModel) -> DataFrame:
    """Adds ``block_score``, the trees' probability of a block."""
    return model.transform(featured).withColumn("block_score", vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability", "prediction"
    )


def held_out(
    pages: DataFrame, *, page_id: str = "page_id", url: str = "url", rules: tuple[Rule, ...] = RULES,
    max_training_urls: int = 20_000, trees: int = 12, depth: int = 3, seed: int = 42,
) -> DataFrame:
    """``suffix, n, n_blocked, n_right, n_right_without``: verdicts of the trees on labelled URLs not learnt from.

    One fold of five is held out, its labels are hidden from all statistics too.
    ``n_right_without`` counts right verdicts if the suffix is treated as an unknown one.
    Both kinds of label have to be among the others.
    """
    known = ruled(pages, page_id=page_id, url=url, rules=rules).where("label is not null")
    hidden = lexical(known.withColumns({
        "truth": F.col("label"), "label": F.when(_fold(FOLDS) != 0, F.col("label")),
    }))
    featured = with_suffix_stats(hidden)
    count = featured.where("label is not null").count()
    share = min(1.0, max_training_urls / max(count, 1))
    model = fitted(featured, share=share, trees=trees, depth=depth, seed=seed)
    test = featured.where("label is null")
    without = test.withColumns({
        "f_suffix_rate": F.lit(_block_rate(featured)), "f_suffix_count": F.lit(0.0),
    })

    def right(rows: DataFrame, name: str) -> DataFrame:
        ok = (F.col("block_score") >= 0.5) == (F.col("truth") == 1)
        return scored(rows, model).groupBy("suffix").agg(
            F.count("*").alias("n"), F.count_if(F.col("truth") == 1).alias("n_blocked"), F.count_if(ok).alias(name)
        )

    return right(test, "n_right").join(right(without, "n_right_without").drop("n", "n_blocked"), "suffix")


def ruled(pages: DataFrame, *, page_id: str, url: str, rules: tuple[Rule, ...]) -> DataFrame:
    """``page_id, url, host, path, rule, decided, label`` of every page; no rule, no label."""
    parsed = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"),
        host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"),
    )
    longest_first = sorted(rules, key=lambda r: (-len(r.site), r.site))
    return parsed.withColumns({
        "rule": F.coalesce(*(F.when(r.fits(), F.lit(r.site)) for r in longest_first)),
        "decided": F.coalesce(*(F.when(r.fits(), F.lit(r.verdict)) for r in longest_first)),
    }).withColumn("label", (F.col("decided") == "block").cast("double"))


def judged(
    pages: DataFrame,
    *,
    page_id: str = "page_id",
    url: str = "url",
    rules: tuple[Rule, ...] = RULES,
    max_training_urls: int = 20_000,
    trees: int = 12,
    depth: int = 3,
    seed: int = 42,
) -> DataFrame:
    """``page_id, url, host, path, rule, verdict, by_rule, block_score`` for every page.

    The longest rule that fits decides (``rule``, its verdict, no score); else the
    trees do, block from a score of 0.5. They learn from about
    ``max_training_urls`` labelled URLs at most, taken by a hash of the URL. If no
    URL or only one kind is labelled, the rest gets the verdict of that kind, or
    allow. Equal sites with different verdicts: the first rule given decides. Very long
    URLs are judged whole. Null and schemeless URLs have empty host and path and are judged like
    others; repeated rows stay; an empty table gives no rows; other columns are
    not looked at.
    """
    sorted_out = ruled(pages, page_id=page_id, url=url, rules=rules)
    featured = with_suffix_stats(lexical(sorted_out))
    kinds = {r["label"]: r["count"] for r in sorted_out.groupBy("label").count().collect()}
    kinds.pop(None, None)
    if len(kinds) < 2:
        judgements = featured.withColumn("block_score", F.lit(1.0 if kinds.keys() == {1.0} else 0.0))
    else:
        share = min(1.0, max_training_urls / sum(kinds.values()))
        judgements = scored(featured, fitted(featured, share=share, trees=trees, depth=depth, seed=seed))
    verdict = F.coalesce("decided", F.when(F.col("block_score") >= 0.5, "block").otherwise("allow"))
    return judgements.select(
        "page_id", "url", "host", "path", "rule", verdict.alias("verdict"),
        F.col("decided").isNotNull().alias("by_rule"),
        F.when(F.col("decided").isNull(), F.col("block_score")).alias("block_score"),
    )


def op8_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return judged(pages).select("page_id", "host", "path", "rule", "verdict")

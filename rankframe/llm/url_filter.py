"""URL verdicts: longest matching rule, else gradient-boosted trees on lexical features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankframe.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (verdict, host, path)
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))


@dataclass(frozen=True)
class UrlModelConfig:
    """``max_labelled``: labelled URLs, drawn by hash, that a fit uses (about; it bounds the
    suffix table too). ``smoothing``: labelled URLs' worth of the overall block rate that
    every suffix rate starts from."""

    max_labelled: int = 100_000
    smoothing: float = 10.0
    trees: int = 20
    depth: int = 4
    step: float = 0.2


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as ``struct(rule, verdict)``; null if none does."""
    fitting: list[Column] = [
        F.when(
            ((host == h) | host.endswith("." + h)) & path.startswith(p),
            F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")),
        )
        for v, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2]))
    ]
    return F.coalesce(*fitting, F.lit(None).cast("struct<rule:string,verdict:string>"))


def _entropy(text: Column) -> Column:
    """Bits per character of the text's own characters."""
    letters = F.split(text, "")
    n = F.greatest(F.length(text), F.lit(1))
    share = lambda c: (F.length(text) - F.length(F.replace(text, c))) / n
    return F.aggregate(F.transform(F.array_remove(F.array_distinct(letters), ""), share), F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(0.0))


def lexical_features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    whole = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(whole, r"(?s)\?([^#]*)", 1)
    digits = F.length(F.regexp_replace(whole, r"[^0-9]", ""))
    return {
        "length": F.length(whole),
        "host_length": F.length(host),
        "host_labels": F.size(F.split(host, r"\.")),
        "host_hyphens": F.length(host) - F.length(F.replace(host, F.lit("-"))),
        "host_entropy": _entropy(host),
        "depth": F.length(path) - F.length(F.replace(path, F.lit("/"))),
        "path_length": F.length(path),
        "path_entropy": _entropy(F.substring(path, 1, 1 << 30)),
        "digit_ratio": digits / F.greatest(F.length(whole), F.lit(1)),
        "parameters": F.when(query == "", 0).otherwise(F.size(F.split(query, "&"))),
        "has_fragment": whole.contains("#").cast("int"),
        "secure": whole.startswith("https:").cast("int"),
    }


def suffixes(host: Column, path: Column) -> dict[str, Column]:
    """What block rates are kept for: the last host label, the last two, and the first path
    segment. None of them names host and path together, as a rule does, so that what the
    rules decide says something about other URLs."""
    segment = F.substring_index(F.substring(path, 2, 1 << 30), "/", 1)
    return {"tld": F.substring_index(host, ".", -1), "domain": F.substring_index(host, ".", -2), "segment": segment}


@dataclass(frozen=True)
class UrlModel:
    """A fitted model: the trees, and the block rate of every suffix that was labelled."""

    trees: Model
    rates: DataFrame
    overall: float
    columns: list[str]

    def features(self, urls: DataFrame) -> DataFrame:
        return _with_features(urls, self.rates, self.overall)

    def block_probability(self, urls: DataFrame) -> DataFrame:
        """Add ``block_probability`` to rows with ``url, host, path``."""
        from pyspark.ml.functions import vector_to_array

        vectors = VectorAssembler(inputCols=self.columns, outputCol="_features", handleInvalid="keep").transform(self.features(urls))
        scored = self.trees.transform(vectors)
        return scored.withColumn("block_probability", vector_to_array("_probability")[1]).select(*urls.columns, "block_probability")


def _with_features(urls: DataFrame, rates: DataFrame, overall: float) -> DataFrame:
    url, host, path = F.col("url"), F.col("host"), F.col("path")
    out = urls.select("*", *[c.cast("double").alias(f"f_{n}") for n, c in lexical_features(url, host, path).items()])
    for kind, suffix in suffixes(host, path).items():
        known = rates.where(F.col("kind") == kind).select(F.col("suffix").alias(f"_{kind}"), F.col("rate").alias(f"f_{kind}_rate"), F.col("weight").alias(f"f_{kind}_weight"))
        # as many rows as suffixes among max_labelled URLs at most
        out = out.withColumn(f"_{kind}", suffix).join(F.broadcast(known), f"_{kind}", "left").drop(f"_{kind}")
        out = out.fillna({f"f_{kind}_rate": overall, f"f_{kind}_weight": 0.0})
    return out


def _without_own_label(rows: DataFrame, config: UrlModelConfig) -> DataFrame:
    """Labelled URLs' features with the rates that the other URLs give their suffixes."""
    for kind in suffixes(F.col("host"), F.col("path")):
        rate, weight = F.col(f"f_{kind}_rate"), F.col(f"f_{kind}_weight")
        total = rate * (weight + config.smoothing) - F.col("blocked")
        rows = rows.withColumn(f"f_{kind}_rate", total / (weight - 1 + config.smoothing)).withColumn(f"f_{kind}_weight", weight - 1)
    return rows


def suffix_rates(labelled: DataFrame, overall: float, config: UrlModelConfig) -> DataFrame:
    """``(kind, suffix, weight, rate)``: labelled URLs of a suffix, and their block rate."""
    pairs = labelled.select("blocked", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), s.alias("suffix")) for k, s in suffixes(F.col("host"), F.col("path")).items()])).alias("s"))
    sums = pairs.groupBy("s.kind", "s.suffix").agg(F.sum("blocked").alias("blocked"), F.count(F.lit(1)).cast("double").alias("weight"))
    return sums.select("kind", "suffix", "weight", ((F.col("blocked") + config.smoothing * overall) / (F.col("weight") + config.smoothing)).alias("rate"))


def fit_url_model(labelled: DataFrame, config: UrlModelConfig | None = None) -> UrlModel | None:
    """Fit on ``labelled(url, host, path, blocked 0/1)``; None unless both labels occur.

    A URL's own label is left out of the suffix rates it is trained with, so the trees
    do not learn to trust a rate that only repeats the label.
    """
    config = config or UrlModelConfig()
    n = labelled.count()
    share = min(1.0, config.max_labelled / max(1, n))
    bounded = labelled if share == 1.0 else labelled.where(F.pmod(F.xxhash64("url"), F.lit(1 << 30)) < int(share * (1 << 30)))
    bounded = stored(bounded.select("url", "host", "path", F.col("blocked").cast("double").alias("blocked")), "labelled-urls")
    overall, kinds = bounded.agg(F.avg("blocked"), F.count_distinct("blocked")).first()
    if kinds != 2:
        return None
    rates = stored(suffix_rates(bounded, overall, config), "url-suffixes")
    rows = _without_own_label(_with_features(bounded, rates, overall), config)
    columns = [c for c in rows.columns if c.startswith("f_")]
    vectors = stored(VectorAssembler(inputCols=columns, outputCol="_features", handleInvalid="keep").transform(rows).select("_features", "blocked"), "url-vectors")
    trees = GBTClassifier(featuresCol="_features", labelCol="blocked", maxIter=config.trees, maxDepth=config.depth, stepSize=config.step, seed=7)
    trees = trees.setPredictionCol("_prediction").setProbabilityCol("_probability").setRawPredictionCol("_raw").setCheckpointInterval(-1)
    return UrlModel(trees.fit(vectors), rates, float(overall), columns)


def judge_urls(pages: DataFrame, rules=RULES, labelled: DataFrame | None = None, config: UrlModelConfig | None = None) -> DataFrame:
    """Host, path, rule and verdict of ``pages(page_id, url)``, one row per input row.

    The longest fitting rule decides. Other URLs go to trees fitted on ``labelled(url,
    blocked)``, or, without it, on the URLs that a rule decided. If these hold just one
    label or none, there is nothing to learn and the URL is allowed.

    A null url, or one without ``://``, has an empty host and path, and no rule fits it.
    Repeated rows are judged each. Other columns are ignored.
    """
    split = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"))
    split = split.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    judged = split.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    if labelled is None:
        known = judged.where("_rule is not null").select("url", "host", "path", (F.col("_rule.verdict") == "block").cast("int").alias("blocked"))
    else:
        known = labelled.select(F.col("url").cast("string"), F.col("blocked").cast("int")).where("blocked is not null")
        known = known.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    model = fit_url_model(known, config)
    scored = model.block_probability(judged) if model else judged.withColumn("block_probability", F.lit(0.0))
    guess = F.when(F.col("block_probability") >= 0.5, "block").otherwise("allow")
    return scored.select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), guess).alias("verdict"), "block_probability",
    )

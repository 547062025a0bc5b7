"""URL filters: rules decide what they know, boosted trees on lexical features the rest.

A rule (host, path) fits its host and all subdomains, if the url's path starts with the rule's; of several the
longest, host and path together, wins. The urls that a rule fits are the labelled ones: gradient-boosted trees learn
block or allow from at most about ``TRAINING`` of them (chosen by a hash; a bound of the model alone), and judge every
url that no rule fits. Features: lengths and depth, digit share, entropy of the characters, query parameters, and the
blocked share of labelled urls under the same last host label, the same last two and the same first path segment, over
all labelled urls and drawn towards the overall share.

Null urls and those without `://` have an empty host and path and no rule; their features are those of an empty text.
Without urls of both labels the verdict of the rest is the one label, or allow. Repeated rows are judged alike.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.llm.storage import saved

#: (verdict, host, path) of each rule.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
TRAINING, TREES, DEPTH, STEP, SEED, SHRINK = 20_000, 10, 4, 0.3, 9, 5.0
_NUMBERS = ["url_length", "host_length", "path_length", "host_labels", "depth", "digits", "entropy", "parameters", "query_length", "last_segment", "marks", "top_share", "domain_share", "segment_share"]


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case."""
    host = F.regexp_extract(url, r"(?s)\A(?:(?!://).)*+://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A(?:(?!://).)*+://[^/?#]*([^?#]*)", 1), F.lit(""))


def ruled(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """Add host, path, rule (null where none fits) and rule_verdict."""
    rows = pages.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    fits = []
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    for _, host, path in ordered:
        same = (F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))
        fits.append(same & F.startswith(F.col("path"), F.lit(path)))
    rule = F.coalesce(*(F.when(fit, F.lit(host + path)) for fit, (_, host, path) in zip(fits, ordered, strict=True)))
    verdict = F.coalesce(*(F.when(fit, F.lit(v)) for fit, (v, _, _) in zip(fits, ordered, strict=True)))
    return rows.withColumn("rule", rule).withColumn("rule_verdict", verdict)


def _entropy(text: str) -> Column:
    """Bits a character, from the counts of each distinct one."""
    count = f"(length({text}) - length(replace({text}, c, '')))"
    return F.expr(f"coalesce(aggregate(array_distinct(split({text}, '')), 0D, (a, c) -> if(c = '', a, a - {count} / length({text}) * log2({count} / length({text})))), 0D)")


def lexical(rows: DataFrame) -> DataFrame:
    """Add the features that the url itself gives, and the three suffixes that statistics are kept of."""
    url, host, path = F.coalesce(F.col("url"), F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    labels = F.when(host == "", F.lit(0)).otherwise(F.size(F.split(host, "[.]")))
    numbers = {
        "url_length": F.length(url), "host_length": F.length(host), "path_length": F.length(path), "host_labels": labels,
        "depth": F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit(""))),
        "digits": F.coalesce(F.try_divide(F.length(F.regexp_replace(url, "[^0-9]", "")), F.length(url)), F.lit(0.0)),
        "parameters": F.when(query == "", F.lit(0)).otherwise(F.size(F.split(query, "&"))), "query_length": F.length(query),
        "last_segment": F.length(F.substring_index(path, "/", -1)), "marks": F.length(F.regexp_replace(url, "[A-Za-z0-9]", "")),
    }
    rows = rows.withColumns({k: v.cast("double") for k, v in numbers.items()}).withColumn("__url", url).withColumn("entropy", _entropy("__url")).drop("__url")
    return rows.withColumns({"top": F.substring_index(host, ".", -1), "domain": F.substring_index(host, ".", -2), "segment": F.substring_index(F.substring_index(path, "/", 2), "/", -1)})


def _suffix_shares(rows: DataFrame, labelled: DataFrame, overall: float) -> DataFrame:
    """Add the blocked share of the labelled urls of each suffix; an unseen one has the overall share.

    A suffix of very many urls is counted before it is shuffled, and its one row is joined to them.
    """
    for suffix in ("top", "domain", "segment"):
        counts = labelled.groupBy(F.col(suffix).alias("__s")).agg(F.count(F.lit(1)).alias("__n"), F.sum("blocked").alias("__k"))
        share = (F.col("__k") + SHRINK * overall) / (F.col("__n") + SHRINK)
        counts = counts.select("__s", share.alias(f"{suffix}_share"))
        rows = rows.join(counts, F.col(suffix) == F.col("__s"), "left").drop("__s").fillna(overall, [f"{suffix}_share"])
    return rows


def judged(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, and the model's score where no rule fits."""
    rows = saved(lexical(ruled(pages.select("page_id", "url"), rules)))
    labelled = rows.where("rule is not null").withColumn("blocked", (F.col("rule_verdict") == "block").cast("double"))
    n, blocked = labelled.agg(F.count(F.lit(1)), F.sum("blocked")).first()
    if not n or blocked in (0, n):
        only = "block" if n and blocked else "allow"
        return rows.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", F.lit(only)).alias("verdict"), F.lit(None).cast("double").alias("score"))
    overall = blocked / n
    rows = saved(_suffix_shares(rows, labelled, overall))
    # which urls are learnt from hangs on their hash alone
    part = min(1.0, TRAINING / n)
    sample = rows.where(F.col("rule").isNotNull() & (F.pmod(F.xxhash64("url", "page_id"), F.lit(1 << 20)) < int(part * (1 << 20))))
    assembler = VectorAssembler(inputCols=_NUMBERS, outputCol="features")
    sample = sample.withColumn("label", (F.col("rule_verdict") == "block").cast("double"))
    both = sample.agg(F.countDistinct("label")).first()[0] == 2
    learner = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=SEED)
    if not both:
        return rows.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", F.lit("block" if overall >= 0.5 else "allow")).alias("verdict"), F.lit(None).cast("double").alias("score"))
    model = learner.fit(assembler.transform(sample).select("features", "label"))
    scored = model.transform(assembler.transform(rows))
    chance = F.when(F.col("rule").isNull(), F.get(vector_to_array("probability"), 1))
    return scored.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", F.when(F.col("prediction") == 1, "block").otherwise("allow")).alias("verdict"), chance.alias("score"))


"""URL filter: rules first, then a ratio of two character language models.

URLs that a rule allows or blocks are the labelled text. Two Markov models of
variable order, one of accepted and one of rejected URLs, are counts of exact
character runs, so what is learnt grows with the URLs. A probability of a
character backs off through shorter and shorter contexts (each order is
smoothed by the next lower one). The mean log ratio per character is compared
with a threshold that is calibrated on labelled URLs kept out of the counts.

A character's log ratio depends on the run of ``RUN`` characters that ends
there alone. So runs are counted first, the counts of shorter runs and of
contexts are sums of these, and the log ratio is worked out once per distinct
run; characters then need a single join.

Everything is column expressions. Null URLs and URLs without ``://`` have an
empty host and path, and are judged by the end mark alone. Without labelled
URLs every ratio is 0, the threshold is 0, and the verdict is ``allow``.
Repeated rows are judged alike, and count as often as they occur.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logtrail.llm.components import stored
from logtrail.session import configure

#: Characters of the longest run: the character itself and its context.
RUN = 4
#: Weight of the lower order, in characters seen.
PRIOR = 1.0
#: Of labelled URLs, those with this remainder of page_id by this divisor are kept for calibration.
FOLDS, CALIBRATION = 5, 0
#: Steps of the threshold, in log ratio per character.
STEP = 100


@dataclass(frozen=True)
class Rule:
    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.text.split("/", 1)[1]


RULES = (
    Rule("allow", "org/"),
    Rule("block", "example.org/es/"),
    Rule("block", "example.org/en/1"),
    Rule("allow", "com/fr/"),
    Rule("block", "com/de/"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.substr(url, at + 3)
    host = F.when(at > 0, F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)).otherwise("")
    path = F.when(at > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def matching_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; null where none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def _runs(urls: DataFrame) -> DataFrame:
    """``_no`` and the run of ``RUN`` characters up to each character of host, path and end mark."""
    chars = F.split(F.concat(F.lit("^" * (RUN - 1)), "_host", "_path", F.lit("\n")), "")
    last = F.length(F.concat("_host", "_path"))
    at = urls.select("_no", last.alias("_last"), chars.alias("_chars"))
    run = F.transform(F.sequence(F.lit(0), F.col("_last")), lambda i: F.concat(*(F.get(F.col("_chars"), i + k) for k in range(RUN))))
    return at.select("_no", F.explode(run).alias("_run"))


def count_runs(urls: DataFrame) -> DataFrame:
    """How often each run of any URL occurs in the accepted and in the rejected URLs to learn from (``_learn``)."""
    parts = []
    for name in ("allow", "block", None):
        chosen = urls.where(F.col("_learn") & (F.col("_verdict") == name)) if name else urls.where("not _learn")
        parts.append(_runs(chosen).groupBy("_run").agg(*(F.count("*").alias(n) if n == name else F.lit(0).cast("bigint").alias(n) for n in ("allow", "block"))))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("_run").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))


def log_ratios(counts: DataFrame) -> DataFrame:
    """``_run, log_ratio``: log P(accepted) - log P(rejected) of the run's last character after its others."""
    total = counts.agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in ("allow", "block"))).first()
    at = counts.select("_run", F.col("allow").alias(f"allow_g{RUN}"), F.col("block").alias(f"block_g{RUN}"))
    # Runs of k characters end a run, contexts of k characters stand before its last one. Sums per key are
    # far fewer than runs; Spark measures whether a side is broadcast.
    keys = {f"g{k}": F.substring("_run", RUN - k + 1, k) for k in range(1, RUN)} | {f"x{k}": F.substring("_run", RUN - k, k) for k in range(1, RUN)}
    for name, key in keys.items():
        sums = counts.groupBy(key.alias(name)).agg(F.sum("allow").alias(f"allow_{name}"), F.sum("block").alias(f"block_{name}"))
        at = at.withColumn(name, key).join(sums, name)
    chance = {}
    for side in ("allow", "block"):
        at = at.withColumn(f"{side}_x0", F.lit(total[side]))
        p = F.lit(1.0 / 256)
        for k in range(1, RUN + 1):
            p = (F.col(f"{side}_g{k}") + PRIOR * p) / (F.col(f"{side}_x{k - 1}") + PRIOR)
        chance[side] = p
    return at.select("_run", (F.log(chance["allow"]) - F.log(chance["block"])).alias("log_ratio"))


def score(urls: DataFrame, ratios: DataFrame) -> DataFrame:
    """``_no, ratio``: mean log ratio over the characters of each URL."""
    # Every run has a ratio. A left join, as only the side of distinct runs may be broadcast: characters are many more than their file tells.
    return _runs(urls).join(ratios, "_run", "left").groupBy("_no").agg(F.avg("log_ratio").alias("ratio"))


def calibrate(scored: DataFrame) -> float:
    """Threshold with the best balanced accuracy; 0 without both kinds.

    All thresholds between two ratios that occur do equally well: the middle of
    that gap is taken, in the lowest of gaps that are equally good.
    """
    histogram = scored.groupBy(F.floor(F.col("ratio") * STEP).alias("bin")).agg(
        F.count(F.when(F.col("_verdict") == "allow", 1)).alias("allow"),
        F.count(F.when(F.col("_verdict") == "block", 1)).alias("block"),
    )
    # A mean log ratio lies within +-(log 256 + log of all counts): a few thousand bins at most.
    histogram = histogram.orderBy("bin").collect()
    allow, block = sum(b["allow"] for b in histogram), sum(b["block"] for b in histogram)
    best, threshold, kept, gone, before = -1.0, 0.0, allow, 0, None
    if not allow or not block:
        return 0.0
    for b in histogram:
        if kept / allow + gone / block > best + 1e-9:
            # From the upper edge of the bin before, if there is one, to the lower edge of this one.
            lower = b["bin"] if before is None else before + 1
            best, threshold = kept / allow + gone / block, (lower + b["bin"]) / 2.0 / STEP
        kept, gone, before = kept - b["allow"], gone + b["block"], b["bin"]
    return threshold


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and ratio of every row of ``pages``."""
    configure(pages.sparkSession)
    host, path = split_url(F.col("url"))
    rule, verdict = matching_rule(F.col("_host"), F.col("_path"), rules)
    held = F.coalesce(F.pmod(F.col("page_id"), F.lit(FOLDS)) == CALIBRATION, F.lit(False))
    urls = pages.select("page_id", host.alias("_host"), path.alias("_path")).select("*", rule.alias("_rule"), verdict.alias("_verdict"), held.alias("_held"))
    # Numbered once and written, so that the number stands for the row from here on.
    urls = stored(urls.select("*", (F.col("_verdict").isNotNull() & ~F.col("_held")).alias("_learn"), F.monotonically_increasing_id().alias("_no")), "urls")
    counts = stored(count_runs(urls), "url-runs")
    ratios = stored(log_ratios(counts), "url-ratios")
    rows = urls.join(stored(score(urls, ratios), "url-scores"), "_no")
    threshold = calibrate(rows.where("_held and _verdict is not null").select("ratio", "_verdict"))
    return rows.select(
        "page_id",
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.col("_rule").alias("rule"),
        F.coalesce("_verdict", F.when(F.col("ratio") >= threshold, "allow").otherwise("block")).alias("verdict"),
        "ratio",
    )

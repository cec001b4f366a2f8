"""URL filters mined as association rules.

A labelled url is a transaction of its tokens: scheme, host labels, path segments, query keys. FP-growth finds token combinations that go with bad labels often
enough; rules below the confidence or support wanted, and rules that a shorter one implies, are
pruned. Tokens that occur in exactly the same labelled urls are one item there, so many copies of a
long url have few combinations; a rule takes any of an item's tokens. Rules are matched by an inverted
index: each is filed under its rarest item's tokens, urls meet it by such a token, and the rest of the
rule is checked on the few that do. Given rules for hosts and paths come first, the longest that fits.

Defined results: a null url or one without ``://`` has an empty host and path, fits no given rule,
and keeps the default verdict unless a mined rule fits. Null ids and repeated rows are rows like any
other; of repeated labels the worst counts; labels without id or value are left out. Without labelled
urls nothing is mined. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window, functions as F

from quillprep.session import cut_lineage

BAD = "label:bad"


@dataclass(frozen=True)
class Given:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"


# The given rules.
GIVEN = (
    Given("allow", "com", "/"),
    Given("block", "example.com", "/en/"),
    Given("allow", "www.example.com", "/en/"),
    Given("block", "net", "/es/"),
    Given("block", "net", "/fr/"),
)


@dataclass(frozen=True)
class RuleParams:
    """A rule holds in at least ``support`` of the labelled urls and in ``confidence`` of those it fits.

    It also rests on at least ``least_rows`` urls, so that few labels make no rules by chance. The
    number of frequent combinations is bounded by the support, and so is what the index holds.
    ``most_tokens`` is a rule's length, not a url's.
    """

    support: float = 0.001
    confidence: float = 0.5
    least_rows: int = 20
    most_tokens: int = 3
    partitions: int | None = None


def parts(url: Column) -> tuple[Column, Column]:
    """``(host, path)``; ASCII capitals of the host are lowered."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.char_length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def given_rule(host: Column, path: Column, rules: tuple[Given, ...] = GIVEN) -> Column:
    """The longest fitting rule as ``struct(rule, verdict)``; null if none fits."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        chosen = F.when(fits, F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def tokens(host: Column, path: Column, url: Column) -> Column:
    """Distinct tokens of a url; numbers in segments are written ``0``, so that they can recur."""
    text = F.coalesce(url, F.lit(""))
    some = lambda values: F.filter(values, lambda x: x != "")
    marked = lambda mark, values: F.transform(values, lambda x: F.concat(F.lit(mark), x))
    scheme = some(F.array(F.when(F.instr(text, "://") > 0, F.lower(F.substring_index(text, "://", 1))).otherwise("")))
    segments = F.transform(some(F.split(path, "/")), lambda x: F.regexp_replace(x, "[0-9]+", "0"))
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    keys = F.transform(some(F.split(query, "&")), lambda x: F.substring_index(x, "=", 1))
    return F.array_distinct(
        F.concat(
            marked("scheme:", scheme),
            marked("host:", some(F.split(host, r"\."))),
            marked("path:", segments),
            marked("key:", keys),
        )
    )


def labelled(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``tokens, bad`` of the pages whose document has a label.

    A page's document is the number in its url's last path segment. Bad is low quality or toxic.
    """
    judged = (
        labels.filter("doc_id is not null and (quality is not null or toxic is not null)")
        .groupBy("doc_id")
        .agg(F.max(F.expr("coalesce(quality, 1) = 0 or coalesce(toxic, 0) = 1")).alias("bad"))
    )
    number = F.regexp_extract("path", r"/([0-9]+)[^/0-9]*/?$", 1)
    asked = pages.withColumn("doc_id", number.try_cast("long"))
    return asked.filter("doc_id is not null").join(judged, "doc_id").select("tokens", "bad")


def same_urls(baskets: DataFrame, least: int) -> DataFrame:
    """``lead, members``: tokens of at least ``least`` of the ``row, tokens``, those of the same rows together.

    A token's rows are told by their number and the exclusive or of their hashes. As many tokens are
    frequent as the wanted share and the length of urls allow, however many urls there are.
    """
    each = baskets.select(F.xxhash64("row").alias("h"), F.explode("tokens").alias("token"))
    rows = each.groupBy("token").agg(F.count("*").alias("n"), F.bit_xor("h").alias("mark")).filter(F.col("n") >= least)
    members = F.array_sort(F.collect_set("token"))
    return rows.groupBy("n", "mark").agg(members.alias("members")).select(F.get("members", F.lit(0)).alias("lead"), "members")


def mine(transactions: DataFrame, params: RuleParams = RuleParams()) -> DataFrame:
    """``rule_id, antecedent, alternatives, anchor, support, confidence`` of the rules that are kept.

    A rule asks for each token of ``antecedent`` or one that goes with the same labelled urls;
    ``alternatives`` lists these for each, in any order. Rules are pruned twice: by confidence and
    support, and where a rule with fewer of the same tokens is kept.
    """
    spark = transactions.sparkSession
    empty = "rule_id long, antecedent array<string>, alternatives array<array<string>>, anchor string, anchors array<string>, support double, confidence double"
    given = cut_lineage(transactions.select(F.monotonically_increasing_id().alias("row"), "tokens", "bad"))
    total = given.count()
    if total < params.least_rows:
        return spark.createDataFrame([], empty)
    support = max(params.support, params.least_rows / total)
    items = cut_lineage(same_urls(given, ceil(support * total)))
    marked = given.select("row", F.explode(F.concat("tokens", F.array(F.when(F.col("bad"), BAD).otherwise("")))).alias("token"))
    leads = items.select(F.col("lead").alias("token"), F.lit(True).alias("_leads"))
    used = F.when(F.col("_leads") | (F.col("token") == BAD), F.col("token"))
    baskets = cut_lineage(marked.join(leads, "token", "left").groupBy("row").agg(F.collect_list(used).alias("items")))
    growth = FPGrowth(itemsCol="items", minSupport=support, minConfidence=params.confidence)
    if params.partitions:
        growth = growth.setNumPartitions(params.partitions)
    sets = cut_lineage(growth.fit(baskets).freqItemsets)
    split = sets.withColumn("antecedent", F.array_sort(F.array_remove("items", BAD))).filter(
        F.size("antecedent").between(1, params.most_tokens)
    )
    bad = split.filter(F.array_contains("items", BAD)).select("antecedent", F.col("freq").alias("hits"))
    every = split.filter(~F.array_contains("items", BAD)).select("antecedent", F.col("freq").alias("seen"))
    rules = bad.join(every, "antecedent").select(
        F.xxhash64("antecedent").alias("rule_id"),
        "antecedent",
        (F.col("hits") / F.lit(float(total))).alias("support"),
        (F.col("hits") / F.col("seen")).alias("confidence"),
    )
    rules = cut_lineage(rules.filter(F.col("confidence") >= params.confidence))
    # a rule is implied where one of its tokens heads a kept rule all of whose tokens it has
    headed = rules.select(F.col("antecedent").alias("less"), F.get("antecedent", F.lit(0)).alias("token"))
    implied = (
        rules.select("rule_id", "antecedent", F.explode("antecedent").alias("token"))
        .join(headed, "token")
        .filter((F.size("less") < F.size("antecedent")) & (F.size(F.array_except("less", "antecedent")) == 0))
        .select("rule_id")
        .distinct()
    )
    single = every.filter(F.size("antecedent") == 1).select(F.get("antecedent", F.lit(0)).alias("token"), "seen")
    rarest = Window.partitionBy("rule_id").orderBy("seen", "token")
    anchors = (
        rules.join(implied, "rule_id", "left_anti")
        .withColumn("token", F.explode("antecedent"))
        .join(single, "token")
        .join(items.withColumnRenamed("lead", "token"), "token")
        .withColumn("alternatives", F.collect_list("members").over(Window.partitionBy("rule_id")))
        .withColumn("_nth", F.row_number().over(rarest))
        .filter("_nth = 1")
    )
    names = [F.col("token").alias("anchor"), F.col("members").alias("anchors")]
    return anchors.select("rule_id", "antecedent", "alternatives", *names, "support", "confidence")


def matched(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """``row, rule_id, confidence``: the surest mined rule of each row of ``pages`` (``row, tokens``) that any fits.

    The index side has a row for each token a rule is filed under. Only a row's own tokens are sent to
    it, and only rows with such a token go on, so frequent ones cost nothing unless a rule is under them.
    """
    index = rules.withColumn("anchor", F.explode("anchors"))
    hits = (
        pages.select("row", "tokens", F.explode("tokens").alias("anchor"))
        .join(index, "anchor")
        .filter(F.forall("alternatives", lambda some: F.arrays_overlap(some, F.col("tokens"))))
    )
    best = F.max(F.struct("confidence", "support", "rule_id"))
    return hits.groupBy("row").agg(best.alias("best")).select("row", "best.rule_id", "best.confidence")


def judge(pages: DataFrame, labels: DataFrame, params: RuleParams = RuleParams(), given: tuple[Given, ...] = GIVEN, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, mined_rule, confidence`` for each page.

    Equal urls get equal verdicts, so the index is asked once for each distinct set of tokens.
    """
    host, path = parts(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("tokens", tokens(F.col("host"), F.col("path"), F.col("url")))
    rules = cut_lineage(mine(labelled(rows, labels), params))
    # two hashes tell sets of tokens apart, as one would not over billions of urls
    row = F.struct(F.xxhash64("tokens").alias("a"), F.xxhash64(F.lit("b"), "tokens").alias("b"))
    keyed = cut_lineage(rows.withColumn("row", row).select("page_id", "host", "path", "row", "tokens"))
    found = matched(keyed.select("row", "tokens").dropDuplicates(["row"]), rules)
    choice = given_rule(F.col("host"), F.col("path"), given)
    return (
        keyed.join(found, "row", "left")
        .withColumn("_given", choice)
        .select(
            "page_id",
            "host",
            "path",
            F.col("_given.rule").alias("rule"),
            F.coalesce("_given.verdict", F.when(F.col("rule_id").isNotNull(), "block"), F.lit("allow")).alias("verdict"),
            F.col("rule_id").alias("mined_rule"),
            "confidence",
        )
    )

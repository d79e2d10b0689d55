"""URL filter: explicit host and path rules, then association rules mined from labelled URLs.

A URL is a set of tokens: scheme, host suffixes, path segments with numbers masked, query keys, fragment.  FP-growth finds the
token sets that are frequent among the bad ones; a set that is bad often enough (support and confidence) becomes a rule, unless a
smaller rule lies inside it, which would block the same URLs.  Rules are posted in an inverted index under their rarest token; a URL meets only
the rules of its own tokens and is blocked if all tokens of one are its own.

Each frequent token holds ``MIN_SUPPORT`` of the bad URLs, which bounds the tokens whatever the size of the table; tokens that always come
together count as one, so a template of many keys is one item.  The index is broadcast up to ``BROADCAST_RULES`` rules and joined with hot tokens split beyond it.

Defined cases: a NULL url or one without ``://`` has empty host and path and no tokens, so nothing blocks it; without labels there
are no mined rules; repeated rows are judged once and given back as often as they came.
"""

from __future__ import annotations

from math import ceil

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from freshet.llm.common import ascii_lower, repeated
from freshet.operators.skew import salted
from freshet.session import stored_table

# verdict, host, path: the longest fitting rule decides
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
MIN_SUPPORT = 0.0005        # of the bad URLs: those with all tokens of the rule
LEAST_URLS = 10        # and so many at least
MIN_CONFIDENCE = 0.7
BROADCAST_RULES = 20_000


def _rest(url: Column) -> Column:
    """What follows the first ``://``; NULL without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def host(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(_rest(url), "^([^/?#]*)", 1)), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(url: Column) -> Column:
    """The distinct tokens of a URL."""
    labels = F.split(host(url), r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat(F.lit("h:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    parts = F.filter(F.split(path(url), "/", -1), lambda p: p != "")
    segments = F.transform(parts, lambda p: F.concat(F.lit("p:"), F.regexp_replace(p, "[0-9]+", "#")))
    keys = F.filter(F.split(F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1), "&", -1), lambda q: q != "")
    queries = F.transform(keys, lambda q: F.concat(F.lit("q:"), F.regexp_extract(q, "^([^=]*)", 1)))
    fragment = F.when(F.instr(_rest(url), "#") > 0, F.array(F.lit("f:"))).otherwise(F.array().cast("array<string>"))
    scheme = F.array(F.concat(F.lit("s:"), ascii_lower(F.regexp_extract(url, "^(.*?)://", 1))))
    return F.when(F.instr(url, "://") > 0, F.array_distinct(F.concat(scheme, suffixes, segments, queries, fragment))).otherwise(F.array().cast("array<string>"))


def _same_urls(posted: DataFrame) -> DataFrame:
    """(token, first): the first of the tokens that occur in exactly the same URLs; ``posted`` has token and place (the number of a URL).

    Host suffixes or the query keys of one template always come together; as one item they cannot multiply the sets that are mined.  Lists of
    URLs are compared by count and two sums of hashes.
    """
    seen = posted.groupBy("token").agg(F.count(F.lit(1)).alias("urls"), *[F.sum(F.xxhash64(F.col("place"), F.lit(k)).cast("decimal(38,0)")).alias(f"h{k}") for k in (1, 2)])
    firsts = seen.groupBy("urls", "h1", "h2").agg(F.min("token").alias("first"))
    return seen.join(firsts, ["urls", "h1", "h2"]).select("token", "first", "urls")


def _holding(rules: DataFrame, postings: DataFrame, urls: DataFrame) -> DataFrame:
    """(rule, place, bad): the URLs that hold all tokens of a rule, found under its rarest token; ``urls`` has place, bad and tokens."""
    posted = index(rules, postings)
    left, right, on = salted(stored_table(urls.select("place", "bad", "tokens", F.explode("tokens").alias("token")), "url-tokens"), posted, ["token"], ["place"])
    return left.join(right, on).filter(F.size(F.array_except("rule", "tokens")) == 0).select("rule", "place", "bad")


def mine(labelled: DataFrame, url_col: str = "url", bad_col: str = "bad", min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
         least: int = LEAST_URLS) -> DataFrame:
    """(rule, support, confidence): sorted token sets, of any size, that go with bad URLs; no rule lies inside another.

    A token that is a rule alone is left out of what is mined, since a set with it says no more.  The others go through FP-growth over the
    bad URLs, tokens of the same URLs as one; then the sets that are frequent there are counted over all labelled URLs.
    """
    flag = F.col(bad_col).cast("boolean")
    numbered = labelled.filter(flag.isNotNull()).select(F.monotonically_increasing_id().alias("place"), flag.alias("bad"), tokens(F.col(url_col)).alias("tokens"))
    urls = stored_table(numbered.filter(F.size("tokens") > 0), "labelled-urls")
    each = urls.select("place", "bad", F.explode("tokens").alias("token"))
    n_bad = urls.filter("bad").count()
    needed = max(least, ceil(min_support * n_bad))
    empty = labelled.sparkSession.createDataFrame([], "rule array<string>, support long, confidence double")
    if n_bad < needed:
        return empty
    often = stored_table(each.groupBy("token").agg(F.count_if(F.col("bad")).alias("support"), F.count(F.lit(1)).alias("urls")).filter(F.col("support") >= needed), "often-tokens")
    sure = F.col("support") / F.col("urls")
    alone = often.filter(sure >= min_confidence).select(F.array("token").alias("rule"), "support", sure.alias("confidence"))
    rest = often.filter(sure < min_confidence).select("token")
    same = stored_table(_same_urls(each.join(rest, "token")), "same-urls")
    baskets = stored_table(each.join(same, "token").groupBy("place", "bad").agg(F.collect_set("first").alias("tokens")), "baskets")
    bad = baskets.filter("bad").select(F.col("tokens").alias("items"))
    if bad.isEmpty():
        return alone
    share = needed / max(needed, bad.count())
    sets = FPGrowth(itemsCol="items", minSupport=share).fit(bad).freqItemsets.filter((F.size("items") > 1) & (F.col("freq") >= needed)).select(F.array_sort("items").alias("rule"))
    held = _holding(stored_table(sets, "token-sets"), same.filter("token = first").select("token", "urls"), baskets)
    counted = held.groupBy("rule").agg(F.count_if(F.col("bad")).alias("support"), F.count(F.lit(1)).alias("urls"))
    rules = stored_table(counted.filter((F.col("support") >= needed) & (sure >= min_confidence)).select("rule", "support", sure.alias("confidence")), "sure-sets")
    return alone.unionByName(rules.join(_nested(rules), "rule", "left_anti"))


def _nested(rules: DataFrame) -> DataFrame:
    """The rules inside which another one lies, found under that one's first token."""
    inner = rules.select(F.col("rule").alias("inner"), F.get("rule", F.lit(0)).alias("token"))
    outer = rules.select("rule", F.explode("rule").alias("token"))
    inside = (F.size("inner") < F.size("rule")) & (F.size(F.array_except("inner", "rule")) == 0)
    return outer.join(inner, "token").filter(inside).select("rule").distinct()


def index(rules: DataFrame, labelled_tokens: DataFrame) -> DataFrame:
    """(token, rule): each rule under its rarest token; ``labelled_tokens`` has token and urls."""
    each = rules.select("rule", F.explode("rule").alias("token")).join(labelled_tokens, "token")
    return each.groupBy("rule").agg(F.min_by("token", F.struct("urls", "token")).alias("token"))


def explicit_rule(host_: Column, path_: Column, rules: list[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits host and path; NULL if none does."""
    rule = verdict = F.lit(None).cast("string")
    for word, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):        # the longest is tested first
        fits = ((host_ == name) | host_.endswith("." + name)) & path_.startswith(start)
        rule, verdict = F.when(fits, F.lit(name + start)).otherwise(rule), F.when(fits, F.lit(word)).otherwise(verdict)
    return rule, verdict


def judge(pages: DataFrame, labelled: DataFrame, id_col: str = "page_id", url_col: str = "url", bad_col: str = "bad", **mining) -> DataFrame:
    """Per row: page_id, host, path, rule, verdict and mined (whether a mined rule fits).  ``labelled`` has urls and a bad flag."""
    rules = stored_table(mine(labelled, url_col, bad_col, **mining), "kept-rules")
    seen = labelled.filter(F.col(bad_col).isNotNull()).select(F.explode_outer(tokens(F.col(url_col))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("urls"))
    posted = stored_table(index(rules, seen), "rule-index")
    once = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url")).groupBy("page_id", "url").agg(F.count(F.lit(1)).alias("copies"))
    met = once.select("page_id", "url", "copies", tokens(F.col("url")).alias("tokens")).select("page_id", "url", "copies", "tokens", F.explode_outer("tokens").alias("token"))
    if posted.count() <= BROADCAST_RULES:
        with_rules = met.join(F.broadcast(posted), "token", "left")
    else:
        left, right, on = salted(met, posted, ["token"], ["page_id"])
        with_rules = left.join(right, on, "left")
    fits = F.coalesce(F.size(F.array_except("rule", "tokens")) == 0, F.lit(False))
    fired = with_rules.groupBy("page_id", "url", "copies").agg(F.bool_or(fits).alias("mined"))
    placed = fired.select("page_id", "copies", "mined", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    rule, verdict = explicit_rule(F.col("host"), F.col("path"))
    return repeated(placed.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(F.col("mined"), "block").otherwise("allow")).alias("verdict"),
                                  "mined", "copies"), "copies")

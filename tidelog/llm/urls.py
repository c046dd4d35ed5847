"""URL filters: pattern rules found through their rarest literal token.

A rule is a regular expression with literal tokens (runs of ``a-z0-9``) that any
URL it matches must hold.  The rarest of them, counted over all URLs, is the key
under which the rule is indexed.  A URL's tokens fetch candidate rules and only
those run their expression.

Up to ``INLINE_RULES`` rules the index is a constant map inside the row's own
expression: nothing is shuffled and nothing but the map travels.  More rules are
a table joined on the token.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOKEN = re.compile("[a-z0-9]+")
INLINE_RULES = 5_000
RULE_TYPE = "struct<rank:int,name:string,verdict:string,pattern:string,site:boolean>"


@dataclass(frozen=True)
class Rule:
    """``site`` rules see host and path and are named in the result; the longest
    that fits decides.  Other rules see the whole lower-cased URL and decide only
    where no site rule fits; one that blocks is enough."""

    name: str
    verdict: str
    pattern: str
    literals: tuple[str, ...]
    site: bool = False

    @property
    def rank(self) -> int:
        return len(self.name) if self.site else int(self.verdict == "block")


def site_rule(verdict: str, site: str) -> Rule:
    """A rule like ``example.org/en/``: the host, its subdomains, paths that start so."""
    host, _, path = site.partition("/")
    path = "/" + path
    tokens = TOKEN.findall(host.translate(str.maketrans(UPPER, LOWER)))
    # The last run of a path may go on in the URL, so it is no token to look up;
    # paths keep their case, so only lower-case runs bounded by other ASCII count.
    inner = re.findall(r"(?<![a-zA-Z0-9\x80-\U0010ffff])[a-z0-9]+(?=[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f])", path)
    return Rule(site, verdict, rf"^(?:[^/]*\.)?{_java(host)}{_java(path)}", tuple(tokens + inner), True)


def _java(text: str) -> str:
    return r"\Q" + text.replace(r"\E", r"\E\\E\Q") + r"\E" if text else ""


def page_rule(name: str, pattern: str, *literals: str) -> Rule:
    return Rule(name, "block", pattern, literals)


#: Pages that are forms, carts, feeds or files and hold no prose.
PAGE_RULES = (
    page_rule("login", r"/login(?:[/?#.]|$)", "login"),
    page_rule("signup", r"/signup(?:[/?#.]|$)", "signup"),
    page_rule("cart", r"/cart(?:[/?#.]|$)", "cart"),
    page_rule("checkout", r"/checkout(?:[/?#.]|$)", "checkout"),
    page_rule("admin", r"/wp-admin(?:[/?#]|$)", "wp", "admin"),
    page_rule("session", r"[?&]sessionid=", "sessionid"),
    page_rule("reply", r"[?&]replytocom=", "replytocom"),
    page_rule("print", r"[?&]print=(?:1|true|yes)(?:[&#]|$)", "print"),
    page_rule("feed", r"/feed/?(?:[?#]|$)", "feed"),
    page_rule("picture", r"\.jpg(?:[?#]|$)", "jpg"),
    page_rule("archive", r"\.zip(?:[?#]|$)", "zip"),
)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (lower-cased) and path; both empty for null or a URL without ``://``."""
    text = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(text, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(text, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _tokens(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(text, "[^a-z0-9]+"), lambda t: t != ""))


def rule_index(urls: DataFrame, rules: Sequence[Rule]) -> dict[str, list[Rule]]:
    """Rules by their rarest literal; rules without one are under the empty token.

    Only tokens that some rule names are counted, so what reaches the driver is
    at most one count per literal of the rules.
    """
    wanted = sorted({t for r in rules for t in r.literals})
    counts = {}
    if wanted and len(rules) <= INLINE_RULES:
        named = F.array(*[F.lit(t) for t in wanted])
        counts = dict(urls.select(F.explode(F.array_intersect("tokens", named)).alias("token"))
                      .groupBy("token").count().collect())
    elif wanted:
        named = urls.sparkSession.createDataFrame([(t,) for t in wanted], "token string")
        counts = dict(urls.select(F.explode("tokens").alias("token")).join(named, "token", "left_semi")
                      .groupBy("token").count().collect())
    index: dict[str, list[Rule]] = {}
    for r in rules:
        index.setdefault(min(r.literals, key=lambda t: (counts.get(t, 0), t), default=""), []).append(r)
    return index


def _rule_sql(r: Rule) -> Column:
    return F.struct(F.lit(r.rank).alias("rank"), F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"),
                    F.lit(r.pattern).alias("pattern"), F.lit(r.site).alias("site"))


def judge_urls(pages: DataFrame, rules: Sequence[Rule], key: str = "page_id") -> DataFrame:
    """Host, path, deciding site rule and verdict of every page.

    ``pages`` needs ``key`` and ``url``; other columns are ignored.  A URL that is
    null or has no ``://`` has an empty host and path and is judged like any
    other: allowed unless a rule blocks it.  One row per input row, repeated rows
    and null keys included.
    """
    host, path = split_url(F.col("url").cast("string"))
    urls = pages.select(F.col(key), host.alias("host"), path.alias("path"),
                        F.translate(F.coalesce(F.col("url").cast("string"), F.lit("")), UPPER, LOWER).alias("url"))
    # Site rules look at the path in its own case; a token of theirs is lower
    # case there and therefore also a token of the lower-cased URL.
    urls = urls.withColumn("site", F.concat("host", "path")).withColumn("tokens", _tokens(F.col("url")))
    index = rule_index(urls, rules)

    def fits(r: Column, site: Column, url: Column) -> Column:
        return F.when(r["site"], F.rlike(site, r["pattern"])).otherwise(F.rlike(url, r["pattern"]))

    if len(rules) <= INLINE_RULES:
        none = F.array().cast(f"array<{RULE_TYPE}>")
        always = F.array(*map(_rule_sql, index.get("", []))) if index.get("") else none
        pairs = [x for t, rs in index.items() if t for x in (F.lit(t), F.array(*map(_rule_sql, rs)))]
        fetched = F.flatten(F.transform("tokens", lambda t: F.coalesce(F.try_element_at(F.create_map(*pairs), t), none))
                            ) if pairs else none
        hits = F.filter(F.concat(always, fetched), lambda r: fits(r, F.col("site"), F.col("url")))
        judged = urls.withColumn("hits", hits)
    else:
        judged = _judge_by_join(urls, index, fits)
    best = F.array_max(F.filter("hits", lambda r: r["site"]))
    rest = F.exists("hits", lambda r: ~r["site"] & (r["verdict"] == "block"))
    return (judged.withColumn("best", best).withColumn("rest", rest)
            .select(key, "host", "path", F.col("best.name").alias("rule"),
                    F.coalesce(F.col("best.verdict"), F.when(F.col("rest"), F.lit("block")), F.lit("allow"))
                    .alias("verdict")))


def _judge_by_join(urls: DataFrame, index: dict[str, list[Rule]], fits) -> DataFrame:
    """Many rules: distinct URLs meet the rule table on the token.

    Each rule's token is its rarest, so a token that most URLs share fetches only
    the rules that have no other.
    """
    spark = urls.sparkSession
    table = spark.createDataFrame([(t, (r.rank, r.name, r.verdict, r.pattern, r.site))
                                   for t, rs in index.items() for r in rs], f"token string, r {RULE_TYPE}")
    each = (urls.select("site", "url", "tokens").distinct()
            .select("site", "url", F.explode(F.concat("tokens", F.array(F.lit("")))).alias("token")))
    hits = (each.join(table, "token").filter(fits(F.col("r"), F.col("site"), F.col("url")))
            .groupBy("site", "url").agg(F.collect_set("r").alias("hits")))
    return (urls.join(hits, ["site", "url"], "left")
            .withColumn("hits", F.coalesce("hits", F.array().cast(f"array<{RULE_TYPE}>"))))

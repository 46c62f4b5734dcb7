"""URL filters: association rules over URL tokens, mined by FP-growth.

A URL becomes a set of tokens: host labels, path segments with digits masked and
query keys. FP-growth finds the combinations that go with bad labels; those under
the support or confidence floor go, and so does a rule that contains another. Each
rule stands in an inverted index under its rarest token; a URL is blocked if all
tokens of a rule are among its own. Policy rules of host and path come first, the
longest that fits wins; of policy rules of one length the last given.

Tokens that stand in the same labelled URLs are one item while rules are mined: n of
them would make 2^n combinations that all go with the same labels. That is exact: with
a combination every one of its kind is a rule too, so a URL is blocked by one token of
each item. Equal URLs are found by count and two hashes over their numbers.

The index is a literal in the plan. With support s and k tokens a URL at most k / s
tokens are frequent; the rules over them are a table without such a bound where many
frequent tokens mix freely. Everything runs in the JVM; nothing is shuffled to match.

Edge cases: a null URL or one without ``://`` has an empty host and path, no
tokens and no rule, so it is allowed; with no labelled URL, or no bad one, there
are no mined rules; repeated rows are judged alike.
"""

from __future__ import annotations

import json

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table

#: The policy of the contract's query: verdict, host, path prefix.
POLICY = (("block", "com", "en/"), ("allow", "example.com", "en/7"), ("allow", "net", "de/"), ("block", "example.net", "de/8"), ("block", "org", "es/"))
MIN_SUPPORT, MIN_CONFIDENCE = 0.005, 0.6
BAD = "label:bad"
#: Stands between tokens of one item; a token that holds it is in no rule.
OR = "\x00"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(url: Column) -> Column:
    """The distinct tokens of a URL; none for a null one or one without ``://``."""
    labels = F.filter(F.split(host(url), r"\."), lambda x: x != "")
    segments = F.filter(F.split(path(url), "/"), lambda x: x != "")
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    keys = F.filter(F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1)), lambda x: x != "")
    every = F.concat(
        F.transform(labels, lambda x: F.concat(F.lit("host:"), x)),
        F.transform(segments, lambda x: F.concat(F.lit("path:"), F.regexp_replace(x, "[0-9]+", "0"))),
        F.transform(keys, lambda x: F.concat(F.lit("key:"), x)),
    )
    return F.when(F.instr(url, "://") > 0, F.array_distinct(every)).otherwise(F.array().cast("array<string>"))


def _same(baskets: DataFrame, least: float) -> dict[str, str]:
    """The frequent tokens, each with the first of those that stand in the same baskets."""
    each = baskets.select(F.monotonically_increasing_id().alias("b"), "items").select("b", F.explode("items").alias("t")).filter((F.col("t") != BAD) & ~F.contains("t", F.lit(OR)))
    spread = each.groupBy("t").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("b")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "b")).alias("y")).filter(F.col("n") >= least)
    named = spread.groupBy("n", "x", "y").agg(F.min("t").alias("name"), F.collect_list("t").alias("ts"))  # of frequent tokens only
    return {r["t"]: r["name"] for r in named.select("name", F.explode("ts").alias("t")).collect()}


def _renamed(items: Column, same: dict[str, str]) -> Column:
    """Items by the names of ``same``, others gone."""
    names = F.from_json(F.lit(json.dumps(same)), "map<string,string>")
    return F.array_distinct(F.filter(F.transform(items, lambda t: F.element_at(names, t)), lambda t: t.isNotNull()))


def mine(labelled: DataFrame, url_col: str, bad: Column, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> dict[str, list[list[str]]]:
    """The inverted index of the rules: rarest token of each rule to the rule's other tokens; tokens that always stand together each have the rule, and stand in it as one, divided by ``OR``."""
    baskets = labelled.select(F.when(bad, F.array_append(tokens(F.col(url_col)), F.lit(BAD))).otherwise(tokens(F.col(url_col))).alias("items")).filter(F.size("items") > 0)
    if baskets.filter(F.array_contains("items", BAD)).isEmpty():
        return {}
    same = _same(baskets, min_support * baskets.count())
    baskets = baskets.select(_renamed(F.col("items"), same | {BAD: BAD}).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    sets = model.freqItemsets
    found = model.associationRules.filter(F.col("consequent") == F.array(F.lit(BAD))).select("antecedent").collect()
    rules, kept = sorted((frozenset(r["antecedent"]) for r in found), key=lambda r: (len(r), sorted(r))), []
    for r in rules:
        if not any(k <= r for k in kept):
            kept.append(r)
    often = {r["items"][0]: r["freq"] for r in sets.filter(F.size("items") == 1).collect()} if kept else {}
    index: dict[str, list[list[str]]] = {}
    tokens_by: dict[str, list[str]] = {}
    for t, name in sorted(same.items()):
        tokens_by.setdefault(name, []).append(t)
    for r in kept:
        first, *others = sorted(r, key=lambda t: (often[t], t))
        for t in tokens_by[first]:
            index.setdefault(t, []).append([OR.join(tokens_by[o]) for o in others])
    return index


def matches(tokens_of: Column, index: dict[str, list[list[str]]]) -> Column:
    """Whether all tokens of some rule are among a URL's."""
    if not index:
        return F.lit(False)
    held = F.from_json(F.lit(json.dumps(index)), "map<string,array<array<string>>>")
    fits = lambda others: F.forall(others, lambda o: F.arrays_overlap(F.split(o, OR), tokens_of))
    return F.exists(tokens_of, lambda t: F.coalesce(F.exists(F.element_at(held, t), fits), F.lit(False)))


def policy_rule(host_of: Column, path_of: Column, policy=POLICY) -> Column:
    """``struct(rule, verdict)`` of the longest policy rule that fits, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(policy, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host_of == h) | host_of.endswith("." + h)) & path_of.startswith("/" + p)
        out = F.when(fits, F.struct(F.lit(f"{h}/{p}").alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def filter_urls(pages: DataFrame, index: dict[str, list[list[str]]], policy=POLICY, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, mined`` for every row of ``pages``."""
    url = F.col(url_col)
    got = pages.select(F.col(id_col).alias("page_id"), host(url).alias("host"), path(url).alias("path"), matches(tokens(url), index).alias("mined"))
    got = got.withColumn("policy", policy_rule(F.col("host"), F.col("path"), policy))
    own = F.when(F.col("mined"), "block").otherwise("allow")
    return got.select("page_id", "host", "path", F.col("policy.rule").alias("rule"), F.coalesce("policy.verdict", own).alias("verdict"), "mined")


def query(spark, sf_dir: str) -> DataFrame:
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    labelled = pages.select("page_id", "url").join(labels, F.col("page_id") == F.col("doc_id"))
    index = mine(labelled, "url", (F.col("quality") == 0) | (F.col("toxic") == 1))
    return filter_urls(pages, index)


SQL = f"""
WITH u AS (
  SELECT page_id, url, row_number() OVER () AS r, coalesce(strpos(url, '://') > 0, false) AS ok,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, r, ok, translate(regexp_extract(rest, '^[^/?#]*', 0), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*\\?([^#]*)', 1) AS qs FROM u),
t AS (SELECT *, CASE WHEN ok THEN list_sort(list_distinct(list_concat(
      [concat('host:', x) FOR x IN string_split(host, '.') IF x <> ''],
      [concat('path:', regexp_replace(x, '[0-9]+', '0', 'g')) FOR x IN string_split(path, '/') IF x <> ''],
      [concat('key:', string_split(x, '=')[1]) FOR x IN string_split(qs, '&') IF string_split(x, '=')[1] <> '']))) ELSE [] END AS toks FROM p),
b AS (SELECT t.toks, (l.quality = 0 OR l.toxic = 1) AS bad FROM t JOIN labels l ON l.doc_id = t.page_id WHERE len(t.toks) > 0 OR (l.quality = 0 OR l.toxic = 1)),
n AS (SELECT count(*) AS n FROM b),
m AS (SELECT toks, coalesce(bad, false) AS bad, unnest(range(1, CAST(pow(2, len(toks)) AS BIGINT))) AS mask FROM b),
i AS (SELECT [toks[k] FOR k IN range(1, len(toks) + 1) IF (mask >> (k - 1)) & 1 = 1] AS items, bad FROM m),
f AS (SELECT items, count(*) AS c, count(*) FILTER (WHERE bad) AS cb FROM i GROUP BY items),
rules AS (SELECT items FROM f, n WHERE cb >= ceil({MIN_SUPPORT} * n.n) AND cb / c >= {MIN_CONFIDENCE}),
hit AS (SELECT DISTINCT t.r FROM t JOIN rules ON list_has_all(t.toks, rules.items)),
pol(verdict, h, pre) AS (VALUES {", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in POLICY)}),
best AS (SELECT t.r, arg_max(h || '/' || pre, length(h) + length(pre)) AS rule, arg_max(verdict, length(h) + length(pre)) AS verdict
  FROM t JOIN pol ON (t.host = h OR ends_with(t.host, '.' || h)) AND starts_with(t.path, '/' || pre) GROUP BY t.r)
SELECT t.page_id, t.host, t.path, best.rule, coalesce(best.verdict, CASE WHEN hit.r IS NULL THEN 'allow' ELSE 'block' END) AS verdict, hit.r IS NOT NULL AS mined
FROM t LEFT JOIN best ON best.r = t.r LEFT JOIN hit ON hit.r = t.r
"""

"""URL filter: stated host and path rules first, association rules mined by FP-growth for the rest.

A url is a set of tokens (domain suffixes, sub-domain, first path part, kind of ending, query
keys, fragment). URLs that a stated rule decides are the labelled ones. FP-growth mines their
frequent token sets together with the label; a set whose urls carry one label with enough
confidence and support becomes a rule, unless a subset of it already says the same with no
less confidence. Rules match through an inverted index from token to rule: a rule fires when
all its tokens are found. The most confident rule decides, then the one of more support, then
the smaller text; with no rule the default stands.

All work is on DataFrame functions and MLlib's FP-growth on the JVM. URLs are reduced to their
distinct token sets before matching, so a hot host costs one row per token set.

Defined results: a null url, or one without ``://``, has empty host and path and no tokens: no
rule, default verdict. Empty tables give no rows. Repeated rows are judged each.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medalloy.llm.common import col, cut
from medalloy.operators.sizing import broadcast_if_small

# The stated rules (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.9
DEFAULT = "allow"


def with_parts(pages: DataFrame, url_col: str) -> DataFrame:
    """``pages`` with ``host`` (A-Z lower-cased), ``path`` and ``rest`` (what follows the path)."""
    url = F.coalesce(col(url_col).cast("string"), F.lit(""))
    after = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)  # '' without '://'
    host = F.regexp_extract(after, r"^([^/?#]*)", 1)
    tail = F.regexp_extract(after, r"(?s)^[^/?#]*(.*)$", 1)
    low = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return pages.withColumns({"host": low, "path": F.regexp_extract(tail, r"^([^?#]*)", 1),
                              "rest": F.regexp_extract(tail, r"(?s)^[^?#]*(.*)$", 1)})


def rule_of(host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest stated rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(RULES, key=lambda r: len(r[1] + r[2])):  # a longer one replaces a shorter one
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def tokens(host: Column, path: Column, rest: Column) -> Column:
    """Sorted distinct tokens of a url; none for an empty host."""
    part = F.split(host, r"\.")
    n = F.size(part)
    seg = F.regexp_extract(path, r"^/([^/]+)/", 1)
    end = F.when(path.endswith("/"), F.lit("end=/")).otherwise(
        F.concat(F.lit("end="), F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1)))
    keys = F.transform(F.regexp_extract_all(rest, F.lit(r"[?&]([^=&#]+)="), 1), lambda k: F.concat(F.lit("key="), k))
    some = F.array(
        F.concat(F.lit("top="), F.element_at(part, -1)),
        F.when(n >= 2, F.concat(F.lit("dom="), F.concat_ws(".", F.slice(part, -2, 2)))),
        F.when(n >= 3, F.concat(F.lit("sub="), F.element_at(part, 1))),
        F.when(F.length(seg) > 0, F.concat(F.lit("dir="), seg)),
        end, F.when(F.contains(rest, F.lit("#")), F.lit("frag")))
    return F.when(F.length(host) > 0, F.array_sort(F.array_distinct(F.array_compact(F.concat(some, keys))))) \
        .otherwise(F.array().cast("array<string>"))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(rule_id, items, verdict, confidence, support, token) from (toks, verdict) rows.

    Exact: FP-growth's frequent sets of tokens with and without the label item. ``token`` is
    the rarest token of the rule, under which the inverted index lists it.
    """
    baskets = labelled.select(F.concat("toks", F.array(F.concat(F.lit("verdict="), "verdict"))).alias("items"))
    found = FPGrowth(itemsCol="items", minSupport=min_support).fit(baskets).freqItemsets
    sets = cut(found.select(
        F.array_sort(F.filter("items", lambda x: ~x.startswith("verdict="))).alias("set"),
        F.expr("substring(get(filter(items, x -> x like 'verdict=%'), 0), 9)").alias("verdict"), "freq"))
    plain = sets.where("verdict is null")
    rules = (sets.where("verdict is not null and size(set) > 0")
             .join(plain.select("set", F.col("freq").alias("of")), "set")
             .withColumn("confidence", F.col("freq") / F.col("of")).where(F.col("confidence") >= min_confidence)
             .select(F.array_join("set", " ").alias("rule_id"), F.col("set").alias("items"), "verdict", "confidence",
                     F.col("freq").alias("support")))
    one = plain.where("size(set) = 1").select(F.col("set")[0].alias("token"), F.col("freq").alias("n"))
    rarest = (rules.select("rule_id", "verdict", F.explode("items").alias("token")).join(one, "token")
              .groupBy("rule_id", "verdict").agg(F.min(F.struct("n", "token")).alias("r"))
              .select("rule_id", "verdict", F.col("r.token").alias("token")))
    return prune(rules).join(rarest, ["rule_id", "verdict"])


def prune(rules: DataFrame) -> DataFrame:
    """Without the rules that say the same, no more confidently, once a token is left out.

    No verdict changes: the shorter rule fires whenever the longer one would, and ranks no lower.
    """
    less = F.expr("transform(sequence(0, size(items) - 1), i -> array_join(filter(items, (x, j) -> j <> i), ' '))")
    short = rules.select(F.col("rule_id").alias("less_id"), "verdict", F.col("confidence").alias("less_confidence"))
    needless = (rules.select("rule_id", "verdict", "confidence", F.explode(less).alias("less_id"))
                .join(short, ["less_id", "verdict"]).where("less_confidence >= confidence").select("rule_id", "verdict"))
    return rules.join(needless, ["rule_id", "verdict"], "left_anti")


def decide(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(key, mined): verdict of the best rule that fires on each token set, by inverted index."""
    index = broadcast_if_small(rules.select("token", "items", "verdict", "confidence", "support"))
    hits = (sets.select("key", "toks", F.explode("toks").alias("token")).join(index, "token")
            .where(F.forall("items", lambda x: F.array_contains(F.col("toks"), x))))
    best = F.min(F.struct((-F.col("confidence")).alias("c"), (-F.col("support")).alias("s"), "verdict"))
    return hits.groupBy("key").agg(best.alias("best")).select("key", F.col("best.verdict").alias("mined"))


def judge(pages: DataFrame, url_col: str = "url", keep: list[str] | None = None, min_support: float = MIN_SUPPORT,
          min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``pages`` (its columns ``keep``) with host, path, rule and verdict."""
    names = [c for c in (pages.columns if keep is None else keep) if c not in ("host", "path", "rule", "verdict")]
    inner = pages.select(*(col(c).alias(f"__{i}") for i, c in enumerate(names)), col(url_col).alias("__url"))
    parts = with_parts(inner, "__url")
    rule, verdict = rule_of(F.col("host"), F.col("path"))
    parts = parts.withColumns({"rule": rule, "stated": verdict, "toks": tokens(F.col("host"), F.col("path"), F.col("rest"))})
    parts = parts.withColumn("key", F.array_join("toks", " "))
    labelled = parts.where("stated is not null").select("toks", F.col("stated").alias("verdict"))
    rules = mine(labelled, min_support, min_confidence)
    sets = parts.where("stated is null").groupBy("key").agg(F.first("toks").alias("toks"))
    out = parts.join(broadcast_if_small(decide(sets, rules)), "key", "left")
    return out.select(*(F.col(f"__{i}").alias(c) for i, c in enumerate(names)), "host", "path", "rule",
                      F.coalesce("stated", "mined", F.lit(DEFAULT)).alias("verdict"))


ORACLE = r"""
with p as (
  select page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://(.*)$', 1) as aft from pages),
q as (
  select page_id,
    translate(regexp_extract(aft, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(regexp_extract(aft, '(?s)^[^/?#]*(.*)$', 1), '^([^?#]*)', 1) as path,
    regexp_extract(regexp_extract(aft, '(?s)^[^/?#]*(.*)$', 1), '(?s)^[^?#]*(.*)$', 1) as rest from p),
r as (
  select *, case
      when (host = 'example.net' or host like '%.example.net') and starts_with(path, '/en/') then 'example.net/en/'
      when (host = 'example.com' or host like '%.example.com') and starts_with(path, '/de/') then 'example.com/de/'
      when (host = 'org' or host like '%.org') and starts_with(path, '/fr/') then 'org/fr/'
      when (host = 'net' or host like '%.net') and starts_with(path, '/') then 'net/' end as rule,
    string_split(host, '.') as part, regexp_extract(path, '^/([^/]+)/', 1) as seg from q),
s as (
  select page_id, host, path, rule,
    case when rule in ('net/', 'example.com/de/') then 'block' when rule is not null then 'allow' end as stated,
    case when host = '' then [] else list_sort(list_distinct(list_filter(list_concat(
      ['top=' || part[-1],
       case when len(part) >= 2 then 'dom=' || part[-2] || '.' || part[-1] end,
       case when len(part) >= 3 then 'sub=' || part[1] end,
       case when seg <> '' then 'dir=' || seg end,
       case when ends_with(path, '/') then 'end=/' else 'end=' || regexp_extract(path, '\.([A-Za-z0-9]+)$', 1) end,
       case when contains(rest, '#') then 'frag' end],
      list_transform(regexp_extract_all(rest, '[?&]([^=&#]+)=', 1), lambda k: 'key=' || k)), lambda x: x is not null))) end as toks from r),
u as (
  select page_id, stated, unnest(list_transform(range(1, (1 << len(toks))::bigint), lambda m: list_filter(toks,
    lambda x, i: (m >> (i - 1)::bigint) & 1 = 1))) as items from s),
n as (select count(*) as n from s where stated is not null),
f as (
  select items, stated, count(*) as support, sum(count(*)) over (partition by items) as of_all
  from u where stated is not null group by items, stated),
g as (
  select items, stated as verdict, support, support / of_all as confidence from f, n
  where support >= ceil({support} * n) and support / of_all >= {confidence}),
m as (
  select page_id, arg_min(verdict, (-confidence, -support, verdict)) as mined
  from u join g using (items) where stated is null group by page_id)
select page_id, host, path, rule, coalesce(stated, mined, 'allow') as verdict from s left join m using (page_id)
""".replace("{support}", str(MIN_SUPPORT)).replace("{confidence}", str(MIN_CONFIDENCE))

"""Blocked best-match of entity names (J14), manual overrides (J15) and entity masters.

Score of a (name, candidate) pair — the reference rule, the maximum of:
  * the token-sort Indel ratio ``100·2·LCS(a,b)/(|a|+|b|)`` of the normalised, token-sorted
    name and title,
  * per principal name: 100 when equal, else the token-sort ratio against it,
  * 96 when the title starts with the name;
≥ 90 accept, 80–89 accept with ``needs_review``, below 80 unmatched (``needs_review`` set,
code and score NULL: pairs below 80 are not generated, so their best score is not known).
Reported scores are truncated to integers. The candidate's block set (e.g. its states) must
contain the name's block; a row without a block is held against all candidates, a candidate
without blocks against all rows, by the same filters. Ties keep the smallest code.

A name that normalises to nothing matches nothing.

No block is ever expanded into all pairs. Candidates come from three exact filters:
  1. equality of the name with a principal name (equi-join),
  2. the name equal to a prefix of the title (each title emits its prefixes: linear),
  3. overlap counts for the ratio, see :func:`ratio_candidates`.
What the counts leave is counted again on whole strings (shared bigrams, shared characters), in
the JVM; only pairs of strings that pass are scored, in Arrow batches.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalloy.functions.text import normalise_name
from medalloy.operators.sizing import broadcast_if_small
from medalloy.store import cut_lineage

ACCEPT, REVIEW = 90.0, 80.0
# Fixed value: the method label of a blocked fuzzy match.
FUZZY_METHOD = "city+state_fuzzy"

# Functions of this module run inside Python workers (Arrow batches); ship them by value so
# executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def token_sort(col: Column) -> Column:
    """normalise, split on blanks, sort tokens, re-join."""
    toks = F.array_remove(F.split(normalise_name(col), " "), "")
    return F.array_join(F.array_sort(toks), " ")


def lcs_len(a: str, b: str) -> int:
    if len(a) < len(b):
        a, b = b, a
    prev = [0] * (len(b) + 1)
    for ca in a:
        cur = [0]
        for j, cb in enumerate(b, 1):
            cur.append(prev[j - 1] + 1 if ca == cb else max(prev[j], cur[j - 1]))
        prev = cur
    return prev[-1]


def lcs_len_bits(a: str, b: str) -> int:
    """LCS length by the bit-parallel recurrence (Hyyrö 2004): one word-parallel step per
    character of ``b``; equal to ``lcs_len`` (checked by a property test)."""
    if not a or not b:
        return 0
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for c in b:
        u = v & masks.get(c, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def indel_ratio(a: str, b: str, lcs=lcs_len) -> float:
    if not a and not b:
        return 100.0
    return 100.0 * 2 * lcs(a, b) / (len(a) + len(b))


@F.pandas_udf(T.DoubleType())
def indel_ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else indel_ratio(x, y, lcs_len_bits) for x, y in zip(a, b)],
                     dtype="float64")


def _grams(text: Column, q: int) -> Column:
    """The stretches of ``q`` characters, each with its occurrence number ('abab' → ab#1, ab#2, ba#1),
    so that the overlap of two arrays counts like that of the multisets."""
    n = F.length(text) - (q - 1)
    places = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    # an array of one array binds the sorted grams to a name: they are made once, not once a gram
    once = F.array(F.array_sort(F.transform(places, lambda i: F.substring(text, i, F.lit(q)))))
    numbered = F.transform(once, lambda g: F.transform(g, lambda x, i: F.concat(x, F.lit("#"), (i - F.array_position(g, x) + 2).cast("string"))))
    return F.get(numbered, 0)


def _least_lcs(total: Column, percent: int) -> Column:
    """Least LCS of two strings of ``total`` characters with a ratio of ``percent`` or more (integers only:
    a rounded quotient could lose pairs that score exactly the threshold)."""
    return F.floor((total * percent + 199) / F.lit(200) + F.lit(1e-9)).cast("int")


def _least_shared(total: Column, percent: int) -> Column:
    """Least number of bigrams two such strings share.

    An LCS of L characters has L - 1 neighbours; each of the la - L and lb - L characters outside
    it parts one pair of them at most, so L - 1 - (la - L) - (lb - L) stay bigrams of both.
    """
    return _least_lcs(total, percent) * 3 - total - 1


def _family(total: Column, percent: int) -> Column:
    """What a pair of strings is found by: 2 = two shared bigrams, 1 = one, 0 = characters."""
    return F.greatest(F.least(_least_shared(total, percent), F.lit(2)), F.lit(0))


def ratio_candidates(left: DataFrame, right: DataFrame, percent: int) -> DataFrame:
    """(blk, a, b): pairs of strings of one block that may have an Indel ratio of ``percent`` or more (none is lost).

    Both sides hold distinct (blk, txt). A pair of total length ``s`` shares at least ``3 L - s - 1``
    bigrams, ``L = ceil(percent s / 200)``. Among the rarest bigrams of each string (all but that
    number, and two) it therefore shares two: the join key is a pair of bigrams. Where only one
    shared bigram is sure it is one bigram, and where none is (for 80 %: strings of up to three
    characters) it is a character among the rarest. Which of the three holds depends on ``s`` alone,
    so a string sends keys for each kind that a partner's length can lead to.
    """
    sides = left.select("blk", "txt", F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(right.select("blk", "txt", F.lit(0).alias("l"), F.lit(1).alias("r")))
    n = F.length("txt")
    strings = sides.where(n > 0).groupBy("blk", "txt").agg(F.max("l").alias("l"), F.max("r").alias("r")).withColumn("n", n)
    shortest = F.floor((F.col("n") * percent + (199 - percent)) / F.lit(200 - percent) + F.lit(1e-9)).cast("int")
    longest = F.floor(F.col("n") * (200 - percent) / F.lit(percent) + F.lit(1e-9)).cast("int")
    strings = strings.withColumn("totals", F.transform(F.sequence(shortest, F.greatest(shortest, longest)), lambda m: m + F.col("n")))

    def least(family: int) -> Column:
        """Least shared bigrams (or, for characters, LCS) over the partners of a family; null if there are none."""
        of = F.filter("totals", lambda s: _family(s, percent) == family)
        return F.array_min(F.transform(of, lambda s: _least_shared(s, percent) if family else _least_lcs(s, percent)))

    strings = strings.select("blk", "txt", "l", "r", "n", *(least(f).alias(f"least{f}") for f in (0, 1, 2)))
    grams = F.concat(_grams(F.col("txt"), 2), F.when(F.col("least0").isNotNull(), _grams(F.col("txt"), 1)).otherwise(F.array().cast("array<string>")))
    tokens = strings.select("*", F.explode(grams).alias("tok"))
    order = broadcast_if_small(tokens.groupBy("tok").agg(F.count(F.lit(1)).alias("freq")))
    rarest = F.array_sort(F.collect_list(F.struct("freq", "tok")))
    each = tokens.join(order, "tok").groupBy(*strings.columns).agg(rarest.alias("t"))

    def of_size(q: int) -> Column:
        mine = F.filter("t", lambda x: F.length(F.regexp_replace(x["tok"], "#[0-9]+$", "")) == q)
        return F.transform(mine, lambda x: x["tok"]).alias(f"t{q}")

    each = each.select(*strings.columns, of_size(1), of_size(2))

    def head(q: int, family: int) -> Column:
        short = F.size(f"t{q}") - F.col(f"least{family}") + (2 if family == 2 else 1)
        return F.when(F.col(f"least{family}").isNotNull(), F.slice(f"t{q}", F.lit(1), F.greatest(short, F.lit(1)))).otherwise(F.array().cast("array<string>"))

    each = each.select("blk", "txt", "l", "r", "n", head(2, 2).alias("h2"), head(2, 1).alias("h1"), head(1, 0).alias("h0"))
    two = F.flatten(F.transform("h2", lambda x, i: F.transform(F.slice("h2", i + 2, F.size("h2")), lambda y: F.concat_ws(" ", F.lit("2"), x, y))))
    keys = F.concat(two, F.transform("h1", lambda x: F.concat_ws(" ", F.lit("1"), x)), F.transform("h0", lambda x: F.concat_ws(" ", F.lit("0"), x)))
    keyed = each.select("blk", "txt", "l", "r", "n", F.explode(keys).alias("tok"))
    a = keyed.where("l = 1").select("blk", "tok", F.col("txt").alias("a"), F.col("n").alias("la"))
    b = keyed.where("r = 1").select("blk", "tok", F.col("txt").alias("b"), F.col("n").alias("lb"))
    la, lb = F.col("la"), F.col("lb")
    fits = (F.least(la, lb) >= _least_lcs(la + lb, percent)) & (_family(la + lb, percent).cast("string") == F.substring("tok", 1, 1))
    return a.join(b, ["blk", "tok"]).where(fits).select("blk", "a", "b").distinct()


def may_reach(a: Column, b: Column, percent: int) -> Column:
    """Whether shared characters and bigrams of two whole strings allow a ratio of ``percent``."""
    total = F.length(a) + F.length(b)
    return ((F.size(F.array_intersect(_grams(a, 1), _grams(b, 1))) >= _least_lcs(total, percent))
            & (F.size(F.array_intersect(_grams(a, 2), _grams(b, 2))) >= _least_shared(total, percent)))


def _blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def best_match(left: DataFrame, right: DataFrame, *, left_key: str, left_name: str, left_block: str,
               right_key: str, right_title: str, right_blocks: str, right_names: Column | None = None,
               accept: float = ACCEPT, review: float = REVIEW, materialise: bool = True) -> DataFrame:
    """J14 — per left row: code of the best candidate, its score, method and review flag.

    ``right_blocks`` is an ARRAY column (e.g. the states a metro spans); ``right_names`` an
    optional ARRAY of principal names. Scores below ``review`` are reported as unmatched
    (code and score NULL): pairs under the threshold are never generated.
    """
    percent = int(review)
    if percent != review:
        raise ValueError("review is a whole percentage")
    rows = left.select(F.col(left_key).alias("lk"), F.col(left_block).alias("blk"),
                       normalise_name(F.col(left_name)).alias("nm"))
    # match distinct (block, name) values once; rows join back at the end
    # a row without a block meets every target (block '*all'), a target without blocks every row ('*none')
    values = rows.where("nm <> ''").select("blk", "nm").distinct().select(F.struct("blk", "nm").alias("lk"), "nm", token_sort(F.col("nm")).alias("ts"))
    meets = F.when(_blank(F.col("lk.blk")), F.array(F.lit("*all"))).otherwise(F.array(F.col("lk.blk"), F.lit("*none")))
    lft = values.select("lk", F.explode(meets).alias("blk"), "nm", "ts")
    stated = F.filter(F.coalesce(F.col(right_blocks) if isinstance(right_blocks, str) else right_blocks,
                                 F.array().cast("array<string>")), lambda b: ~_blank(b))
    held = F.concat(F.array_distinct(stated), F.array(F.lit("*all")),
                    F.when(F.size(stated) == 0, F.array(F.lit("*none"))).otherwise(F.array().cast("array<string>")))
    rgt = right.select(F.col(right_key).alias("rk"), F.explode(held).alias("blk"),
                       normalise_name(F.col(right_title)).alias("title_n"), token_sort(F.col(right_title)).alias("rts"),
                       (F.transform(F.col(right_names) if isinstance(right_names, str) else right_names, lambda x: normalise_name(x)) if right_names is not None
                        else F.array().cast("array<string>")).alias("names"))
    if materialise:
        # each value set feeds five branches: write it once to the shared checkpoint dir
        # (reliable, so also a recovery point) instead of re-deriving it from the inputs
        lft, rgt = cut_lineage(lft), cut_lineage(rgt)
    # 1) principal-name equality
    eq = (rgt.select("rk", "blk", F.explode("names").alias("nm"))
             .join(lft.select("lk", "blk", "nm"), ["blk", "nm"]).select("lk", "rk", F.lit(100.0).alias("score")))
    # 2) title starts with the name: every title prefix is a join key (linear in title length)
    pre = (rgt.select("rk", "blk", "title_n",
                      F.explode(F.sequence(F.lit(1), F.greatest(F.length("title_n"), F.lit(1)))).alias("_l"))
              .select("rk", "blk", F.substring("title_n", 1, F.col("_l")).alias("nm"))
              .join(lft.select("lk", "blk", "nm").where(F.length("nm") > 0), ["blk", "nm"])
              .select("lk", "rk", F.lit(96.0).alias("score")))
    # 3) ratio targets: the whole title and every principal name (token-sorted)
    targets = rgt.select("rk", "blk", "rts").unionByName(
        rgt.select("rk", "blk", F.explode("names").alias("_pn")).select("rk", "blk", token_sort(F.col("_pn")).alias("rts"))
    ).distinct()
    pairs = ratio_candidates(lft.select("blk", F.col("ts").alias("txt")).distinct(), targets.select("blk", F.col("rts").alias("txt")).distinct(), percent)
    if materialise:
        pairs = cut_lineage(pairs)  # read twice; and the counts below must not be pushed under the key join
    # count and score each distinct string pair once (strings repeat across rows and blocks), then join back
    ratios = (pairs.select("a", "b").distinct().where(may_reach(F.col("a"), F.col("b"), percent))
                   .select("a", "b", indel_ratio_udf(F.col("a"), F.col("b")).alias("score"))
                   .where(F.col("score") >= review))
    scored = (pairs.join(ratios, ["a", "b"]).join(lft.select("lk", "blk", F.col("ts").alias("a")), ["blk", "a"])
                   .join(targets.select("rk", "blk", F.col("rts").alias("b")), ["blk", "b"]).select("lk", "rk", "score"))
    allc = eq.unionByName(pre).unionByName(scored)
    best = (allc.groupBy("lk").agg(F.max(F.struct(F.col("score"), (-F.col("rk")).alias("neg"))).alias("b"))
                .select("lk", F.col("b.score").alias("match_score"), (-F.col("b.neg")).alias("rk")))
    titles = right.select(F.col(right_key).alias("rk"), F.col(right_title).alias("match_title"))
    per_value = best.join(titles, "rk", "left")
    per_value = per_value.select(F.col("lk.blk").alias("_b"), F.col("lk.nm").alias("_m"), "rk", "match_score", "match_title")
    out = rows.join(per_value, F.col("blk").eqNullSafe(F.col("_b")) & F.col("nm").eqNullSafe(F.col("_m")), "left")
    matched = F.col("match_score").isNotNull()
    return out.select(F.col("lk").alias(left_key), F.col("rk").alias(right_key), "match_title",
                      F.floor("match_score").cast("int").alias("match_score"),
                      F.when(matched, F.lit(FUZZY_METHOD)).otherwise(F.lit("unmatched")).alias("match_method"),
                      (~matched | (F.col("match_score") < accept)).alias("needs_review"))


def apply_overrides(matches: DataFrame, overrides: DataFrame, *, key: str, code: str,
                    titles: DataFrame | None = None, title: str = "match_title") -> DataFrame:
    """J15 — an override row wins (method ``manual``, review off); overrides for unknown keys
    are ignored (left join from the matches). ``titles`` (code, title) gives the title of an
    overriding code; without it such a title is null."""
    ov = overrides.select(key, F.col(code).alias("_ov"))
    ov = ov.join(titles.select(F.col(code).alias("_ov"), F.col(title).alias("_title")), "_ov", "left") if titles is not None \
        else ov.withColumn("_title", F.lit(None).cast("string"))
    j = matches.join(broadcast_if_small(ov), key, "left")
    hit = F.col("_ov").isNotNull()
    named = [F.when(hit, F.col("_title")).otherwise(F.col(title)).alias(title)] if title in matches.columns else []
    return j.select(
        key, F.when(hit, F.col("_ov")).otherwise(F.col(code)).alias(code), *named,
        F.col("match_score"),
        F.when(hit, "manual").otherwise(F.col("match_method")).alias("match_method"),
        F.when(hit, F.lit(False)).otherwise(F.col("needs_review")).alias("needs_review"))


def entity_master(detail: DataFrame, *, code: str, title: str, block: str, code_pattern: str | None = None) -> DataFrame:
    """A17 — one row per code from detail rows: title (rows agree; ``min`` is deterministic),
    sorted distinct block set, and row count. ``code_pattern`` keeps well-formed codes only."""
    d = detail.where(F.col(code).rlike(code_pattern)) if code_pattern else detail
    return d.groupBy(code).agg(F.min(title).alias(title), F.array_sort(F.collect_set(block)).alias("blocks"),
                               F.count(F.lit(1)).alias("detail_rows"))


def brute_force_best(left: pd.DataFrame, right: pd.DataFrame, normalise, accept=ACCEPT, review=REVIEW) -> dict:
    """Reference implementation over all pairs in a block, for tests on small fixtures."""
    out = {}
    for _, lrow in left.iterrows():
        nm = normalise(lrow["name"])
        if not nm:
            out[lrow["key"]] = (None, None)
            continue
        ts = " ".join(sorted(t for t in nm.split(" ") if t))
        best = None
        for _, rrow in right.iterrows():
            blocks = [b for b in (rrow["blocks"] if rrow["blocks"] is not None else []) if b and b.strip()]
            if lrow["block"] and lrow["block"].strip() and blocks and lrow["block"] not in blocks:
                continue
            title = normalise(rrow["title"])
            rts = " ".join(sorted(t for t in title.split(" ") if t))
            names = [normalise(x) for x in (rrow.get("names") or [])]
            s = indel_ratio(ts, rts)
            for pn in names:
                pts = " ".join(sorted(t for t in pn.split(" ") if t))
                s = max(s, 100.0 if nm == pn else indel_ratio(ts, pts))
            if nm and title.startswith(nm):
                s = max(s, 96.0)
            cand = (s, -rrow["code"])
            if best is None or cand > best:
                best = cand
        if best is None or best[0] < review:
            out[lrow["key"]] = (None, None)
        else:
            out[lrow["key"]] = (-best[1], int(best[0]))
    return out


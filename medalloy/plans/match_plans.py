"""Matching and spatial plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from medalloy.operators import matching as mt
from medalloy.operators import spatial as sp
from medalloy.plans.registry import plan
from medalloy.plans.tables import read


def master(spark, sf_dir):
    """Entity master from detail rows: one code per distinct part name (smallest part key),
    its title and the set of brands ("states") it occurs in."""
    p = read(spark, sf_dir, "part")
    return (p.groupBy("p_name").agg(F.min("p_partkey").alias("code"),
                                    F.array_sort(F.collect_set("p_brand")).alias("brands"),
                                    F.count(F.lit(1)).alias("detail_rows"))
             .withColumnRenamed("p_name", "title"))


@plan("entity_master", "A17 O5", oracle="""
SELECT min(p_partkey) AS code, p_name AS title, array_to_string(list_sort(list_distinct(list(p_brand))), ',') AS brands,
       count(*) AS detail_rows
FROM part WHERE regexp_matches(p_brand, '^Brand#[0-9]+$') GROUP BY p_name
""")
def entity_master(spark, sf_dir):
    p = read(spark, sf_dir, "part").where(F.col("p_brand").rlike(r"^Brand#[0-9]+$"))
    m = mt.entity_master(p.withColumn("title", F.col("p_name")), code="p_name", title="title", block="p_brand")
    first = p.groupBy("p_name").agg(F.min("p_partkey").alias("code"))
    return m.join(first, "p_name").select("code", "title", F.array_join("blocks", ",").alias("brands"), "detail_rows")


def edited_names(spark, sf_dir):
    """Part names with deterministic edits by size band: dropped last letter, swapped words,
    an appended 'st.' word, an appended type word."""
    p = read(spark, sf_dir, "part")
    w = F.split("p_name", " ")
    name = (F.when(F.col("p_size") < 10, F.expr("substring(p_name, 1, length(p_name) - 1)"))
             .when(F.col("p_size") < 20, F.concat_ws(" ", F.element_at(w, -1), F.element_at(w, 1)))
             .when(F.col("p_size") < 30, F.concat(F.col("p_name"), F.lit(" st.")))
             .when(F.col("p_size") < 40, F.concat(F.col("p_name"), F.lit(" "), F.lower("p_type")))
             .otherwise(F.upper("p_name")))
    return p.select("p_partkey", name.alias("region_name"), F.col("p_brand").alias("state"))


def _norm_sql(c: str) -> str:
    spelled = f"replace(replace(lower({c}), 'st.', 'saint'), 'ste.', 'sainte')"
    return f"trim(regexp_replace(regexp_replace({spelled}, '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g'))"


def _sorted_sql(c: str) -> str:
    return f"array_to_string(list_sort(string_split({c}, ' ')), ' ')"


# The longest common subsequence as a fold over one string's letters: the state is the row of the
# usual table, the next row a running maximum.
_LCS_SQL = """list_last(list_reduce([list_transform(string_split(a, ''), lambda x: 0)]
    || list_transform(string_split(b, ''), lambda c: list_transform(string_split(a, ''), lambda x: (x = c)::int)),
  lambda r, m: list_transform(range(1, len(r) + 1), lambda j: list_max(list_transform(range(1, j + 1),
    lambda i: case when m[i] = 1 then coalesce(r[i - 1], 0) + 1 else r[i] end)))::int[]))"""

_MATCH_SQL = f"""
WITH master AS (SELECT p_name AS title, min(p_partkey) AS code, list(DISTINCT p_brand) AS brands FROM part GROUP BY p_name),
named AS (SELECT p_partkey, p_brand AS state, {_norm_sql("""CASE
            WHEN p_size < 10 THEN substring(p_name, 1, length(p_name) - 1)
            WHEN p_size < 20 THEN split_part(p_name, ' ', -1) || ' ' || split_part(p_name, ' ', 1)
            WHEN p_size < 30 THEN p_name || ' st.'
            WHEN p_size < 40 THEN p_name || ' ' || lower(p_type) ELSE upper(p_name) END""")} AS nm FROM part),
l AS (SELECT DISTINCT state, nm, {_sorted_sql("nm")} AS a FROM named WHERE nm <> ''),
r AS (SELECT code, title, brands, {_norm_sql("title")} AS tn, {_sorted_sql(_norm_sql("title"))} AS b FROM master),
ratio AS (SELECT a, b, 200.0::double * {_LCS_SQL} / (length(a) + length(b)) AS ratio
          FROM (SELECT DISTINCT a, b FROM l JOIN r ON list_contains(r.brands, l.state))),
scored AS (SELECT state, nm, code, title,
             greatest(ratio, CASE WHEN nm = tn THEN 100.0 ELSE 0 END, CASE WHEN starts_with(tn, nm) THEN 96.0 ELSE 0 END) AS score
           FROM l JOIN r ON list_contains(r.brands, l.state) JOIN ratio USING (a, b)),
best AS (SELECT * FROM scored WHERE score >= 80 QUALIFY row_number() OVER (PARTITION BY state, nm ORDER BY score DESC, code) = 1),
matched AS (SELECT n.p_partkey, b.code, b.title AS match_title, floor(b.score)::int AS match_score,
              CASE WHEN b.code IS NULL THEN 'unmatched' ELSE '{mt.FUZZY_METHOD}' END AS match_method,
              coalesce(b.score < 90, true) AS needs_review
            FROM named n LEFT JOIN best b ON b.state = n.state AND b.nm = n.nm)"""


@plan("fuzzy_match", "J14 T14", oracle=_MATCH_SQL + " SELECT * FROM matched")
def fuzzy_match(spark, sf_dir):
    """Blocked best match of edited part names to the master (block = brand)."""
    m = master(spark, sf_dir)
    return mt.best_match(edited_names(spark, sf_dir), m, left_key="p_partkey", left_name="region_name",
                         left_block="state", right_key="code", right_title="title", right_blocks="brands",
                         right_names=F.array(F.col("title")))


@plan("override", "J15", oracle=_MATCH_SQL + """
SELECT m.p_partkey, coalesce(o.code, m.code) AS code, CASE WHEN o.code IS NULL THEN m.match_title ELSE p.p_name END AS match_title,
  m.match_score, CASE WHEN o.code IS NULL THEN m.match_method ELSE 'manual' END AS match_method, o.code IS NULL AND m.needs_review AS needs_review
FROM matched m JOIN part p USING (p_partkey) LEFT JOIN master o ON o.title = p.p_name AND p.p_size = 50""")
def override(spark, sf_dir):
    """Matches with manual overrides: the largest parts are pinned to their true code; an
    override for an unknown key (-1) is ignored."""
    m = master(spark, sf_dir)
    matches = mt.best_match(edited_names(spark, sf_dir), m, left_key="p_partkey", left_name="region_name",
                            left_block="state", right_key="code", right_title="title", right_blocks="brands",
                            right_names=F.array(F.col("title")))
    p = read(spark, sf_dir, "part")
    ov = (p.where(F.col("p_size") == 50).join(m.select(F.col("title").alias("p_name"), "code"), "p_name")
           .select("p_partkey", "code")
           .unionByName(spark.createDataFrame([(-1, -1)], "p_partkey long, code long")))
    return mt.apply_overrides(matches, ov, key="p_partkey", code="code",
                              titles=m.select("code", F.col("title").alias("match_title")))


def _points(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    n_orders = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    c = read(spark, sf_dir, "customer").join(n_orders, "c_custkey", "left")
    return c.select(F.col("c_custkey").alias("point_id"), (F.col("c_acctbal") / 100.0).alias("x"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("double").alias("y"))


# Hexagon offsets (dx, dy) around each nation's centre.
HEX = [(-5, 0), (-3, -4), (3, -4), (5, 0), (3, 5), (-3, 5)]


def _polygons(spark, sf_dir):
    n = read(spark, sf_dir, "nation")
    cx = (F.col("n_nationkey") * 4).cast("double")
    cy = (F.col("n_regionkey") * 2 + 10).cast("double")
    ring = F.array(*[F.struct((cx + dx).alias("x"), (cy + dy).alias("y")) for dx, dy in HEX])
    return n.select(F.col("n_nationkey").alias("polygon_id"), ring.alias("ring"))


_HEX_SQL = " UNION ALL ".join(
    f"SELECT {i} AS k, {dx}.0 AS dx, {dy}.0 AS dy" for i, (dx, dy) in enumerate(HEX))


@plan("point_in_polygon", "J16 O6", oracle=f"""
WITH pts AS (SELECT c.c_custkey AS point_id, c.c_acctbal / 100.0 AS px, CAST(coalesce(o.n, 0) AS DOUBLE) AS py
             FROM customer c LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) o ON o.o_custkey = c.c_custkey),
hex AS ({_HEX_SQL}),
v AS (SELECT n_nationkey AS polygon_id, k, CAST(n_nationkey * 4 AS DOUBLE) + dx AS x, CAST(n_regionkey * 2 + 10 AS DOUBLE) + dy AS y
      FROM nation, hex),
e AS (SELECT a.polygon_id, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM v a JOIN v b
      ON a.polygon_id = b.polygon_id AND b.k = (a.k + 1) % {len(HEX)}),
hits AS (SELECT p.point_id, e.polygon_id, count(*) AS c FROM pts p JOIN e
         ON ((e.y1 > p.py) <> (e.y2 > p.py)) AND p.px < e.x1 + (p.py - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)
         GROUP BY 1, 2)
SELECT point_id, min(polygon_id) AS polygon_id FROM hits WHERE c % 2 = 1 GROUP BY 1
""")
def point_in_polygon(spark, sf_dir):
    """Customers as points (x = balance/100, y = order count) inside nation hexagons."""
    return sp.within(_points(spark, sf_dir), _polygons(spark, sf_dir))


# Rings around each nation's centre: an outer square, a hole in it, an island in the hole, a far part.
PARTS = {"outer": [(-9, -9), (9, -9), (9, 9), (-9, 9)], "hole": [(-6, -6), (6, -6), (6, 6), (-6, 6)],
         "island": [(-2, -3), (3, -2), (1, 4)], "far": [(40, -5), (52, 0), (44, 7), (41, 3)]}
_PARTS_SQL = " UNION ALL ".join(f"SELECT '{name}' AS part, {len(ring)} AS n, {k} AS k, {dx}.0 AS dx, {dy}.0 AS dy"
                                for name, ring in PARTS.items() for k, (dx, dy) in enumerate(ring))


@plan("point_in_parts", "J16 O6", oracle=f"""
WITH pts AS (SELECT c.c_custkey AS point_id, c.c_acctbal / 100.0 AS px, CAST(coalesce(o.n, 0) AS DOUBLE) AS py
             FROM customer c LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) o ON o.o_custkey = c.c_custkey),
rings AS ({_PARTS_SQL}),
v AS (SELECT n_nationkey AS polygon_id, part, n, k, CAST(n_nationkey * 4 AS DOUBLE) + dx AS x, CAST(n_regionkey * 2 + 10 AS DOUBLE) + dy AS y
      FROM nation, rings),
e AS (SELECT a.polygon_id, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM v a JOIN v b
      ON a.polygon_id = b.polygon_id AND a.part = b.part AND b.k = (a.k + 1) % a.n),
hits AS (SELECT p.point_id, e.polygon_id, count(*) AS c FROM pts p JOIN e
         ON ((e.y1 > p.py) <> (e.y2 > p.py)) AND p.px < e.x1 + (p.py - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)
         GROUP BY 1, 2)
SELECT point_id, min(polygon_id) AS polygon_id FROM hits WHERE c % 2 = 1 GROUP BY 1
""")
def point_in_parts(spark, sf_dir):
    """Customers as points in nations of several parts, one with a hole and an island in it."""
    n = read(spark, sf_dir, "nation")
    cx, cy = (F.col("n_nationkey") * 4).cast("double"), (F.col("n_regionkey") * 2 + 10).cast("double")
    rings = F.array(*[F.array(*[F.struct((cx + dx).alias("x"), (cy + dy).alias("y")) for dx, dy in ring]) for ring in PARTS.values()])
    return sp.within(_points(spark, sf_dir), n.select(F.col("n_nationkey").alias("polygon_id"), rings.alias("ring")))

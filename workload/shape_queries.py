"""Queries over shapes: superimposition, outliers, variance, classifiers, numbering, crop space."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alula.functions import shapes as G
from alula.operators import cropspace as C
from alula.operators import discriminant as LD
from alula.operators import numbering as N
from alula.operators import outliers as U
from alula.operators import reports as P
from alula.operators import superimposition as A
from alula.operators import variance as VA
from alula.operators.arrow import append_arrow, exploded_points, list_column, matrix
from alula.plans import train as TR
from alula.plans.variance_report import variance_report
from alula.schema import DOUBLES
from workload import views as V
from workload.registry import query

STD_SQL = """
cen as (select ord, avg(x) as cx, avg(y) as cy from pts group by 1),
siz as (select ord, sqrt(sum((x - cx) * (x - cx) + (y - cy) * (y - cy))) as cs from pts join cen using (ord) group by 1),
std as (select ord, i, (x - cx) / cs as x, (y - cy) / cs as y, cs from pts join cen using (ord) join siz using (ord))
"""


def aligned_sql(out: str, ref: str) -> str:
    """std turned onto a reference (i, x, y)."""
    return f"""
{out}_rot as (select s.ord, sum(s.x * r.x + s.y * r.y) as a, sum(s.x * r.y - s.y * r.x) as b from std s join {ref} r using (i) group by 1),
{out} as (select s.ord, s.i, (a * s.x - b * s.y) / sqrt(a * a + b * b) as x, (b * s.x + a * s.y) / sqrt(a * a + b * b) as y, s.cs
          from std s join {out}_rot using (ord))
"""


def consensus_sql(rounds: int) -> str:
    """The consensus iteration written out ``rounds`` times."""
    parts = ["ref0 as (select i, x, y from std where ord = (select min(ord) from std))"]
    for k in range(1, rounds + 1):
        parts.append(aligned_sql(f"al{k}", f"ref{k - 1}"))
        parts.append(f"raw{k} as (select i, avg(x) as x, avg(y) as y from al{k} group by 1)")
        parts.append(f"nrm{k} as (select sqrt(sum(x * x + y * y)) as h from raw{k})")
        parts.append(f"ref{k} as (select i, x / h as x, y / h as y from raw{k}, nrm{k})")
    return ",".join(parts)


def settled_sql(rounds: int, ref: str = "ref", key: str = "") -> str:
    """its: the first pass that moves the reference by less than the tolerance (per ``key``)."""
    by, using = (f"{key}, ", f"{key}, i") if key else ("", "i")
    shifts = " union all ".join(
        f"select {by}{k} as k, sqrt(sum((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))) as shift from {ref}{k} a join {ref}{k - 1} b using ({using})"
        + (f" group by {key}" if key else "")
        for k in range(1, rounds + 1)
    )
    return f"its as (select {by}min(k)::int as n_iterations from ({shifts}) where shift < 1e-8" + (f" group by {key})" if key else ")")


def grouped_consensus_sql(rounds: int) -> str:
    parts = [
        "gs as (select s.*, p.species from std s join photo p using (ord))",
        "gref0 as (select species, i, x, y from gs where ord in (select min(ord) from photo group by species))",
    ]
    for k in range(1, rounds + 1):
        parts.append(f"""
grot{k} as (select s.ord, sum(s.x * r.x + s.y * r.y) as a, sum(s.x * r.y - s.y * r.x) as b from gs s join gref{k - 1} r using (species, i) group by 1),
gal{k} as (select s.ord, s.species, s.i, (a * s.x - b * s.y) / sqrt(a * a + b * b) as x, (b * s.x + a * s.y) / sqrt(a * a + b * b) as y
           from gs s join grot{k} using (ord)),
graw{k} as (select species, i, avg(x) as x, avg(y) as y from gal{k} group by 1, 2),
gnrm{k} as (select species, sqrt(sum(x * x + y * y)) as h from graw{k} group by 1),
gref{k} as (select species, i, x / h as x, y / h as y from graw{k} join gnrm{k} using (species))""")
    return ",".join(parts)


FROZEN = ("frozen as (select i, x, y from std where ord = 0)", aligned_sql("al", "frozen"))
DIST = "dst as (select ord, sqrt(sum((a.x - r.x) * (a.x - r.x) + (a.y - r.y) * (a.y - r.y))) as d, any_value(cs) as cs from al a join frozen r using (i) group by 1)"


def frozen_reference(spark: SparkSession, d: str) -> np.ndarray:
    """Unit shape of vector 0: 32 points, the frozen reference of these queries."""
    row = A.standardized(V.shapes(spark, d).filter("ord = 0")).select("xs", "ys").first()
    return np.column_stack([row["xs"], row["ys"]])


def frozen_aligned(spark: SparkSession, d: str) -> DataFrame:
    return A.align_to_reference(V.shapes(spark, d), frozen_reference(spark, d), "ord")


def _r(name: str, digits: int = 6):
    return (F.round(name, digits) + 0.0).alias(name)


# --- superimposition -----------------------------------------------------------------


@query(V.with_sql(V.PHOTO_SQL, V.POINTS_SQL, STD_SQL, *FROZEN, DIST) + """
select species, count(*) as n, round(avg(cs), 6) as mean_size, round(avg(d), 6) as mean_distance, round(max(d), 6) as max_distance,
       count(*) filter (d > 0.3) as n_atypical from dst join photo using (ord) group by 1""")
def align_distance_by_species(spark, d):
    rows = frozen_aligned(spark, d)
    return rows.groupBy("species").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("centroid_size"), 6).alias("mean_size"),
        F.round(F.avg("procrustes_distance"), 6).alias("mean_distance"),
        F.round(F.max("procrustes_distance"), 6).alias("max_distance"),
        F.count_if(F.col("procrustes_distance") > 0.3).alias("n_atypical"),
    )


@query(V.with_sql(V.POINTS_SQL, STD_SQL, *FROZEN) + """
, m as (select i, avg(x) as x, avg(y) as y from al group by 1)
select i, round(x / h, 6) + 0.0 as mean_x, round(y / h, 6) + 0.0 as mean_y from m, (select sqrt(sum(x * x + y * y)) as h from m)""")
def gpa_one_pass_mean(spark, d):
    points = exploded_points(frozen_aligned(spark, d), [])
    mean = points.groupBy(F.col("i").cast("long").alias("i")).agg(F.avg("px").alias("x"), F.avg("py").alias("y"))
    size = mean.agg(F.sqrt(F.sum(F.col("x") * F.col("x") + F.col("y") * F.col("y"))).alias("h"))  # 32 rows
    joined = mean.join(F.broadcast(size), F.col("h").isNotNull())
    return joined.select("i", (F.col("x") / F.col("h")).alias("mean_x"), (F.col("y") / F.col("h")).alias("mean_y")).select(
        "i", _r("mean_x"), _r("mean_y"))


#: Passes that the SQL writes out, more than the iteration takes to settle on these shapes.
ROUNDS = 9


@query(V.with_sql(V.NEAR_POINTS_SQL, STD_SQL, consensus_sql(ROUNDS), settled_sql(ROUNDS)) + f"""
select a.ord, round(any_value(cs), 6) as centroid_size,
       round(sqrt(sum((a.x - r.x) * (a.x - r.x) + (a.y - r.y) * (a.y - r.y))), 6) as distance, any_value(n_iterations) as n_iterations
from al{ROUNDS} a join ref{ROUNDS} r using (i), its group by 1""")
def gpa_consensus(spark, d):
    fitted = A.consensus(V.near_shapes(spark, d), ["ord"])
    mx, my = (G.literal_array(fitted.mean_shape[:, k].tolist()) for k in (0, 1))
    return fitted.aligned.select(
        "ord", _r("centroid_size"), F.round(G.shape_distance(F.col("ax"), F.col("ay"), mx, my), 6).alias("distance"),
        F.lit(fitted.n_iterations).alias("n_iterations"),
    )


@query(V.with_sql(V.PHOTO_SQL, V.NEAR_POINTS_SQL, STD_SQL, grouped_consensus_sql(ROUNDS), settled_sql(ROUNDS, "gref", "species")) + f"""
select species, i, round(x, 6) + 0.0 as mean_x, round(y, 6) + 0.0 as mean_y, n_iterations from gref{ROUNDS} join its using (species)""")
def gpa_by_species(spark, d):
    fitted = A.consensus_by_group(V.near_shapes(spark, d), "species", ["ord"])
    pts = exploded_points(fitted.means, ["species", "n_iterations"], "mean_x", "mean_y")
    return pts.select("species", F.col("i").cast("long").alias("i"), F.col("px").alias("mean_x"), F.col("py").alias("mean_y"), "n_iterations").select(
        "species", "i", _r("mean_x"), _r("mean_y"), F.col("n_iterations").cast("int").alias("n_iterations"))


@query(V.with_sql(V.PHOTO_SQL, V.NEAR_POINTS_SQL) + "," + STD_SQL + "," + consensus_sql(ROUNDS) + f"""
select row_number() over (order by i) - 1 as i, round(x, 6) + 0.0 as x, round(y, 6) + 0.0 as y from ref{ROUNDS} where i <> 3""")
def reference_shape(spark, d):
    shape = A.reference_shape(V.near_shapes(spark, d), "ord", n_points=32, drop_point=3)
    frame = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(shape)], "i long, x double, y double")
    return frame.select("i", _r("x"), _r("y"))


@query(V.with_sql(V.POINTS_SQL, STD_SQL) + """
, r as (select i, x, y from pts where ord = 0), rc as (select avg(x) as tx, avg(y) as ty from r),
f as (select p.ord, sum((p.x - cx) * (r.x - tx) + (p.y - cy) * (r.y - ty)) as a, sum((p.x - cx) * (r.y - ty) - (p.y - cy) * (r.x - tx)) as b,
             sum((p.x - cx) * (p.x - cx) + (p.y - cy) * (p.y - cy)) as w, any_value(cx) as cx, any_value(cy) as cy
      from pts p join cen using (ord) join r using (i), rc group by 1)
select ord, round(atan2(b, a), 6) + 0.0 as angle, round(sqrt(a * a + b * b) / w, 6) as scale, round(cx, 6) + 0.0 as cx, round(cy, 6) + 0.0 as cy from f""")
def similarity_fit(spark, d):
    target = V.shapes(spark, d).filter("ord = 0").select("x", "y").first()
    fit = G.similarity_fit(F.col("x"), F.col("y"), G.literal_array(target["x"]), G.literal_array(target["y"]))
    rows = V.shapes(spark, d).select("ord", fit.alias("f")).select("ord", "f.*")
    return rows.select("ord", *[_r(c) for c in ("angle", "scale", "cx", "cy")])


# --- robust outliers ------------------------------------------------------------------


def _mad_sql(source: str, factor: float, heavy: float) -> str:
    return f"""
med as (select species, i, median(x) as mx, median(y) as my from {source} group by 1, 2),
far as (select a.ord, a.species, a.i, sqrt((x - mx) * (x - mx) + (y - my) * (y - my)) as dist from {source} a join med using (species, i)),
mid as (select species, i, median(dist) as md from far group by 1, 2),
mad as (select species, i, any_value(md) as md, median(abs(dist - md)) as mad from far join mid using (species, i) group by 1, 2),
flg as (select ord, species, count(*) filter (dist > md + {factor} * mad) as n_outlier_landmarks, count(*) as p
        from far join mad using (species, i) group by 1, 2)
select ord, species, n_outlier_landmarks, n_outlier_landmarks >= {heavy} * p as heavy from flg"""


@query(V.with_sql(V.PHOTO_SQL, V.NEAR_POINTS_SQL, STD_SQL, grouped_consensus_sql(ROUNDS)) + "," + _mad_sql(f"gal{ROUNDS}", 6.0, 0.55))
def outlier_flags_by_species(spark, d):
    return U.flag_by_group(V.near_shapes(spark, d), "species", "ord", ["ord"])


@query(V.with_sql(V.PHOTO_SQL, V.POINTS_SQL, STD_SQL, *FROZEN, "js as (select a.ord, a.i, a.x, a.y, p.species from al a join photo p using (ord))") + "," + _mad_sql("js", 2.0, 0.25))
def outlier_flags_frozen_reference(spark, d):
    return U.shape_flags(frozen_aligned(spark, d), "species", "ord", mad_factor=2.0, heavy_fraction=0.25)


# --- variance ---------------------------------------------------------------------------


LONG_SQL = "lng as (select a.ord, 2 * i as pos, x as v from al a union all select ord, 2 * i + 1, y from al), lp as (select l.*, species, caste, inv_id from lng l join photo using (ord))"


def _vectors(spark, d) -> DataFrame:
    return frozen_aligned(spark, d).select("ord", "species", "caste", "inv_id", VA.shape_vector().alias("v"))


ANOVA_SQL = """
, fine as (select pos, species, caste, inv_id, count(*) as n, sum(v) as s, sum(v * v) as q from lp group by all),
g as (select pos, sum(n) as n, sum(s) as s, sum(q) as q from fine group by 1),
b0 as (select sum(s * s / n) as b, sum(q) as q, max(n) as rows from g),
b1 as (select sum(s * s / n) as b, count(*) / 64 as c from (select pos, species, sum(n) as n, sum(s) as s from fine group by all)),
b2 as (select sum(s * s / n) as b, count(*) / 64 as c from (select pos, species, caste, sum(n) as n, sum(s) as s from fine group by all)),
b3 as (select sum(s * s / n) as b, count(*) / 64 as c from fine),
t as (select 1 as rank, 'species' as source, b1.b - b0.b as ss, b1.c - 1 as df from b0, b1
      union all select 2, 'caste', b2.b - b1.b, b2.c - b1.c from b1, b2 union all select 3, 'inv_id', b3.b - b2.b, b3.c - b2.c from b2, b3
      union all select 4, 'Residual', b0.q - b3.b, b0.rows - b3.c from b0, b3),
r as (select ss / df as m from t where rank = 4)
select cast(rank as int) as rank, source, round(ss, 6) as ss, cast(df as bigint) as df, round(ss / df, 6) as ms, case when rank < 4 then round(ss / df / m, 6) end as f from t, r"""


@query(V.with_sql(V.PHOTO_SQL, V.POINTS_SQL, STD_SQL, *FROZEN, LONG_SQL) + ANOVA_SQL)
def nested_anova(spark, d):
    table = VA.nested_anova(_vectors(spark, d), ["species", "caste", "inv_id"])
    return table.select("rank", "source", _r("ss"), "df", _r("ms"), _r("f"))


@query(V.with_sql(V.PHOTO_SQL, V.NEAR_POINTS_SQL, STD_SQL, consensus_sql(ROUNDS), LONG_SQL.replace("from al", f"from al{ROUNDS}")) + ANOVA_SQL)
def variance_report_job(spark, d):
    table = variance_report(V.near_shapes(spark, d), ["species", "caste", "inv_id"])
    return table.select("rank", "source", _r("ss"), "df", _r("ms"), _r("f"))


@query(V.with_sql(V.PHOTO_SQL, V.POINTS_SQL, STD_SQL, *FROZEN, LONG_SQL) + """
select inv_id, max(n) as n, round(sum(vs), 6) as shape_variance from (select inv_id, pos, count(*) as n, var_samp(v) as vs from lp group by 1, 2) group by 1""")
def within_group_variance(spark, d):
    return VA.within_group_variance(_vectors(spark, d), "inv_id").withColumn("shape_variance", F.round("shape_variance", 6))


@query(V.with_sql(V.PHOTO_SQL, V.POINTS_SQL, STD_SQL, *FROZEN, LONG_SQL) + """
, gm as (select pos, avg(v) as g from lp group by 1), cm as (select pos, species, avg(v) as c from lp group by 1, 2)
select round(sum((c - g) * (c - g)), 6) as ss_between, round(sum((v - c) * (v - c)), 6) as ss_within, round(sum((v - g) * (v - g)), 6) as ss_total
from lp join gm using (pos) join cm using (pos, species)""")
def between_within(spark, d):
    return VA.between_within(_vectors(spark, d), "species").select(_r("ss_between"), _r("ss_within"), _r("ss_total"))


# A keyed bijection of the places 0 .. n - 1: four Feistel rounds on two halves of b bits, again until the result is inside.
MIXED_SQL = "(((x & ((1::bigint << b) - 1)) + k) % 2147483647)"
TWICE_SQL = f"(({MIXED_SQL} * {MIXED_SQL} + k) % 2147483647)"
FEISTEL_SQL = (
    "list_reduce(list_concat([{x}], keys), lambda x, k: ((x & ((1::bigint << b) - 1)) << b)"
    f" | xor(x >> b, ({TWICE_SQL} * {TWICE_SQL} % 2147483647 >> 8) & ((1::bigint << b) - 1)))"
)
PERMUTED_SQL = f"""
, lv as (select 1 as depth, 'species' as lev, 'all' as stratum, species as label, ord from photo
         union all select 2, 'caste', concat('{{"species":"', species, '"}}'), caste, ord from photo),
held as (select *, row_number() over (partition by depth, stratum order by label, cast(ord as varchar)) - 1 as place, count(*) over (partition by depth, stratum) as n from lv),
kd as (select distinct depth, lev, stratum, n, perm, sha256(concat_ws('|', '11', lev, perm, stratum)) as h from held, range(99) t(perm)),
ky as materialized (
  select depth, stratum, perm, n, greatest(3, (ceil(log2(greatest(n, 2)))::bigint + 1) // 2) as b,
    list_transform(range(4), lambda r: ('0x' || substr(h, 8 * r + 1, 8))::bigint % 2147483647) as keys from kd
), wk as (
  select depth, stratum, perm, ord, n, b, keys, {FEISTEL_SQL.format(x='place')} as x from held join ky using (depth, stratum, n)
  union all select depth, stratum, perm, ord, n, b, keys, {FEISTEL_SQL.format(x='x')} from wk where x >= n
),
dealt as (select d.depth, d.perm, d.stratum, d.ord, h.label from wk d join held h on h.depth = d.depth and h.stratum = d.stratum and h.place = d.x),
pc as (select depth, perm, stratum, label, pos, sum(v) as s, count(*) as n from dealt join lp using (ord) group by all),
pq as (select depth, perm, sum(s * s / n) as q from pc group by all),
c0 as (select pos, sum(v) as s, sum(v * v) as q, count(*) as n from lp group by 1),
c1 as (select pos, species, sum(v) as s, count(*) as n from lp group by all), c2 as (select pos, species, caste, sum(v) as s, count(*) as n from lp group by all),
bs as (select 0 as depth, sum(s * s / n) as b, 1 as c, sum(q) as q, max(n) as n from c0
       union all select 1, sum(s * s / n), count(*) / 64, null, null from c1 union all select 2, sum(s * s / n), count(*) / 64, null, null from c2),
whole as (select b as b0, q, n from bs where depth = 0),
lev as (select x.depth, x.b - y.b as ss, x.c - y.c as df, y.b as below from bs x join bs y on x.depth = y.depth + 1),
res as (select whole.q - b as ss, whole.n - c as df from whole, bs where depth = 2),
hit as (select depth, (1 + count(*) filter (pq.q - below >= ss - 1e-9 * (whole.q - b0))) / 100.0 as p from pq join lev using (depth), whole group by 1)
select cast(depth as int) as rank, case depth when 1 then 'species' else 'caste' end as source, round(lev.ss, 6) as ss, cast(lev.df as bigint) as df,
       round(lev.ss / lev.df, 6) as ms, round(lev.ss / lev.df / (res.ss / res.df), 6) as f, round(cast(p as double), 6) as p from lev join hit using (depth), res
union all select 3, 'Residual', round(ss, 6), cast(df as bigint), round(ss / df, 6), null, null from res"""


@query(V.with_sql(V.PHOTO_SQL, V.POINTS_SQL, STD_SQL, *FROZEN, LONG_SQL).replace("with", "with recursive", 1) + PERMUTED_SQL)
def permutation_p(spark, d):
    table = VA.nested_anova(_vectors(spark, d), ["species", "caste"], n_perm=99, seed=11)
    return table.select("rank", "source", _r("ss"), "df", _r("ms"), _r("f"), _r("p"))


# --- classifier ----------------------------------------------------------------------------------


@query(V.with_sql(V.PHOTO_SQL, V.POINTS_SQL, STD_SQL, *FROZEN, LONG_SQL) + """
, sq as (select pos, sum(v * v) as q from lp group by 1)
select species, pos, count(*) as n, round(avg(v), 6) + 0.0 as mean, round(any_value(q), 6) as square_sum from lp join sq using (pos) group by 1, 2""")
def class_statistics(spark, d):
    sums = LD.class_sums(_vectors(spark, d), "species", "v")
    rows = [
        (c, k, int(n), float(s / n), float(sums.products[k, k]))
        for c, n, per in zip(sums.classes, sums.counts, sums.sums) for k, s in enumerate(per)
    ]
    frame = spark.createDataFrame(rows, "species string, pos long, n long, mean double, square_sum double")
    return frame.select("species", "pos", "n", _r("mean"), _r("square_sum"))


# Two scores of an aligned shape, so that discriminants have a closed form of 2 x 2 matrices.
TWO_SQL = "sc as (select ord, inv_id, species, sum(cos(pos) * v) as s1, sum(sin(pos) * v) as s2 from lp group by all)"
# Given gc (fold, species, n, a, b) and gp (fold, p11, p12, p22), the posteriors of sc joined with its fold.
POSTERIOR_SQL = """
gt as (select fold, sum(n) as n, count(*) as k, sum(a * a / n) as q11, sum(a * b / n) as q12, sum(b * b / n) as q22 from gc group by 1),
w as (select fold, n, (p11 - q11) / (n - k) as w11, (p12 - q12) / (n - k) as w12, (p22 - q22) / (n - k) as w22 from gt join gp using (fold)),
inv as (select fold, n, w22 / (w11 * w22 - w12 * w12) as i11, -w12 / (w11 * w22 - w12 * w12) as i12, w11 / (w11 * w22 - w12 * w12) as i22 from w),
cls as (select fold, species, a / gc.n as m1, b / gc.n as m2, ln(gc.n / inv.n) as prior, i11, i12, i22 from gc join inv using (fold)),
lg as (select r.ord, cls.species, m1 * (i11 * s1 + i12 * s2) + m2 * (i12 * s1 + i22 * s2) - 0.5 * (m1 * m1 * i11 + 2 * m1 * m2 * i12 + m2 * m2 * i22) + prior as l
       from scf r join cls using (fold)),
mx as (select ord, max(l) as top from lg group by 1)
select ord, species as cls, round(exp(l - top) / sum(exp(l - top)) over (partition by ord), 6) + 0.0 as p from lg join mx using (ord)"""


def _two_scores(spark, d) -> DataFrame:
    score = lambda f: F.aggregate("v", F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("k")), lambda a, x: F.struct((a["s"] + f(a["k"]) * x).alias("s"), (a["k"] + 1).alias("k")))["s"]
    return _vectors(spark, d).select("ord", "inv_id", "species", F.array(score(F.cos), score(F.sin)).alias("scores"))


def _by_class(rows: DataFrame, classes: list[str]) -> DataFrame:
    exploded = rows.select("ord", F.posexplode("proba").alias("k", "p"))
    return exploded.select("ord", F.get(F.array(*[F.lit(c) for c in classes]), F.col("k")).alias("cls"), _r("p"))


@query(V.with_sql(V.PHOTO_SQL, V.POINTS_SQL, STD_SQL, *FROZEN, LONG_SQL, TWO_SQL) + """
, scf as (select *, 0 as fold from sc), gc as (select 0 as fold, species, count(*) as n, sum(s1) as a, sum(s2) as b from sc group by all),
gp as (select 0 as fold, sum(s1 * s1) as p11, sum(s1 * s2) as p12, sum(s2 * s2) as p22 from sc),""" + POSTERIOR_SQL)
def discriminant_posteriors(spark, d):
    rows = _two_scores(spark, d)
    model = LD.fit_discriminant(rows, "species")
    kernel = lambda batch: [list_column(LD.posteriors(matrix(batch.column("scores")), model.coef, model.intercept))]
    return _by_class(append_arrow(rows, [T.StructField("proba", DOUBLES)], kernel), model.classes)


@query(V.with_sql(V.PHOTO_SQL, V.POINTS_SQL, STD_SQL, *FROZEN, LONG_SQL, TWO_SQL) + """
, scf as (select *, inv_id as fold from sc),
c as (select species, count(*) as n, sum(s1) as a, sum(s2) as b from sc group by 1),
g as (select inv_id, species, count(*) as n, sum(s1) as a, sum(s2) as b, sum(s1 * s1) as p11, sum(s1 * s2) as p12, sum(s2 * s2) as p22 from sc group by all),
t as (select sum(s1 * s1) as p11, sum(s1 * s2) as p12, sum(s2 * s2) as p22 from sc),
gc as (select inv_id as fold, c.species, c.n - if(c.species = g.species, g.n, 0) as n, c.a - if(c.species = g.species, g.a, 0) as a,
              c.b - if(c.species = g.species, g.b, 0) as b from c, g where c.n - if(c.species = g.species, g.n, 0) > 0),
gp as (select inv_id as fold, t.p11 - g.p11 as p11, t.p12 - g.p12 as p12, t.p22 - g.p22 as p22 from g, t),""" + POSTERIOR_SQL)
def left_out_posteriors(spark, d):
    proba, classes = LD.leave_group_out(_two_scores(spark, d), "species", "inv_id")
    return _by_class(proba, classes)


def _fitted(spark, d) -> tuple[DataFrame, np.ndarray, LD.Components]:
    ref = frozen_reference(spark, d)
    rows = frozen_aligned(spark, d).drop("x", "y")
    pca = LD.fit_components(rows, len(ref), ref.reshape(-1))
    return rows, ref, pca


@query(V.with_sql(V.POINTS_SQL, STD_SQL, *FROZEN) + """
, l as (select ord, 2 * i as pos, x as v from al union all select ord, 2 * i + 1, y from al)
select count(*) as n_coordinates, round(sum(var_v), 4) as total_variance from (select pos, var_samp(v) as var_v from l group by 1)""")
def pca_total_variance(spark, d):
    """Scores of all components carry the coordinates' whole variance."""
    rows, ref, pca = _fitted(spark, d)
    scores = LD.with_scores(rows.select("ax", "ay"), pca).select(F.posexplode_outer("scores").alias("k", "s"))
    kept = scores.groupBy("k").agg(F.var_samp("s").alias("var_s"))
    share = float(pca.explained_ratio.sum())
    return kept.agg(
        (F.count(F.lit(1)) + 4).alias("n_coordinates"), F.round(F.sum("var_s") / F.lit(share), 4).alias("total_variance")
    )


@query(V.with_sql(V.PHOTO_SQL, V.POINTS_SQL, STD_SQL, *FROZEN, LONG_SQL) + """
, c as (select a.pos as i, b.pos as j, covar_samp(a.v, b.v) as c from lp a join lp b using (ord) group by all),
cc as (select a.i, b.j, sum(a.c * b.c) as c from c a join c b on a.j = b.i group by all),
t as (select sum(c) filter (i = j) as t1, sum(c * c) as t2 from c), t3 as (select sum(c.c * cc.c) as t3 from c join cc using (i, j)), t4 as (select sum(c * c) as t4 from cc)
select round(t2 / t1 ** 2, 8) as second, round(t3 / t1 ** 3, 8) as third, round(t4 / t1 ** 4, 8) as fourth, cast(0 as bigint) as correlated from t, t3, t4""")
def pca_power_sums(spark, d):
    """Sums of powers of the components' variances are traces of powers of the covariance matrix; scores are uncorrelated.

    Three of the four components left out are null (centred, turned), so the fourth has the rest of the variance."""
    rows, _, pca = _fitted(spark, d)
    sums = LD.class_sums(LD.with_scores(rows.select("species", "ax", "ay"), pca), "species")
    n, total = sums.counts.sum(), sums.sums.sum(axis=0)
    cov = (sums.products - np.outer(total, total) / n) / (n - 1)
    kept = float(pca.explained_ratio.sum())
    share = np.append(np.diag(cov) / np.trace(cov) * kept, 1 - kept)
    apart = int((np.abs(np.triu(cov, 1)) > 1e-10 * np.trace(cov)).sum())
    row = [round(float((share**k).sum()), 8) for k in (2, 3, 4)]
    return spark.createDataFrame([(*row, apart)], "second double, third double, fourth double, correlated long")


@query()
def pca_scores(spark, d):
    rows, _, pca = _fitted(spark, d)
    scored = LD.with_scores(rows.select("ord", "species", "ax", "ay"), pca)
    return scored.select("ord", "species", *[F.round(F.get("scores", k), 6).alias(f"pc{k + 1}") for k in range(4)])


def _model(spark, d) -> LD.TrainedModel:
    rows, ref, pca = _fitted(spark, d)
    lda = LD.fit_discriminant(LD.with_scores(rows.select("species", "ax", "ay"), pca), "species")
    return LD.TrainedModel(ref, pca, lda, "species", LD.projection_axes(len(lda.classes)))


@query()
def lda_posteriors(spark, d):
    table = LD.predict(_model(spark, d), V.shapes(spark, d).select("ord", "inv_id", "species", "x", "y"))
    return P.with_correctness(table.drop("x", "y"), "species", F.col("species"))


@query()
def lda_projection(spark, d):
    scored = LD.score_shapes(_model(spark, d), V.shapes(spark, d).select("ord", "species", "x", "y"), projection=True)
    return scored.groupBy("species").agg(
        F.count(F.lit(1)).alias("n"), *[F.round(F.avg(F.get("lda", k)), 6).alias(f"axis{k + 1}") for k in range(2)])


@query()
def logo_cv(spark, d):
    rows, _, pca = _fitted(spark, d)
    scored = LD.with_scores(rows.select("ord", "inv_id", "species", "ax", "ay"), pca).drop("ax", "ay")
    proba, classes = LD.leave_group_out(scored, "species", "inv_id")
    table = P.prediction_columns(proba.drop("scores"), "species", classes)
    return P.accuracy(P.with_correctness(table, "species", F.col("species")))


@query(V.with_sql(V.PHOTO_SQL, V.POINTS_SQL, STD_SQL, *FROZEN) + """
select species, i, round(avg(x), 6) + 0.0 as cx, round(avg(y), 6) + 0.0 as cy from al join photo using (ord) group by 1, 2""")
def group_centroids(spark, d):
    model = _model(spark, d)
    data = V.shapes(spark, d).select(F.col("ord").alias("tps_id"), "species", "device_type", "x", "y")
    tables = TR.classification_report(model, P.with_correctness(LD.predict(model, data), "species", F.col("species")), data)
    return tables["centroids"].select(F.col("grp").alias("species"), F.col("i").cast("long").alias("i"), _r("x").alias("cx"), _r("y").alias("cy"))


# --- numbering ---------------------------------------------------------------------------------------

# A cloud per photo: the reference, slightly deformed by the photo's own shape, turned,
# enlarged and shuffled; every tenth photo has lost a point.
CLOUD_SQL = """
turn as (select distinct ord, 0.1 + (ord % 4) * 1.5707963267948966 + (ord % 7) * 0.05 as th from std),
cloud as (select s.ord, s.i, 100 * (cos(th) * (r.x + 0.004 * s.x) - sin(th) * (r.y + 0.004 * s.y)) + 50 as x,
                 100 * (sin(th) * (r.x + 0.004 * s.x) + cos(th) * (r.y + 0.004 * s.y)) + 20 as y
          from std s join frozen r using (i) join turn using (ord)),
whole as (select * from cloud where ord % 10 <> 3)
"""


def _clouds(spark, d, n: int = 32, step: int = 7) -> tuple[DataFrame, np.ndarray]:
    """``step`` is coprime to ``n``: point k of a cloud is landmark (step * k + ord) mod n."""
    shapes = V.shapes(spark, d).select(
        "ord", "inv_id", "species", F.slice("x", 1, n).alias("x"), F.slice("y", 1, n).alias("y"))
    row = A.standardized(shapes.filter("ord = 0")).select("xs", "ys").first()
    ref = np.column_stack([row["xs"], row["ys"]])
    rx, ry = G.literal_array(ref[:, 0].tolist()), G.literal_array(ref[:, 1].tolist())
    base = A.standardized(shapes).withColumn(
        "th", F.expr("0.1D + (ord % 4) * 1.5707963267948966D + (ord % 7) * 0.05D"))
    c, s = F.cos("th"), F.sin("th")
    near = base.withColumn("px", F.zip_with("xs", rx, lambda a, r: r + 0.004 * a)).withColumn(
        "py", F.zip_with("ys", ry, lambda a, r: r + 0.004 * a))
    turned = near.withColumn("qx", F.zip_with("px", "py", lambda a, b: 100 * (c * a - s * b) + 50)).withColumn(
        "qy", F.zip_with("px", "py", lambda a, b: 100 * (s * a + c * b) + 20))
    slot = lambda v: F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.get(v, F.pmod(k * step + F.col("ord"), F.lit(n)).cast("int")))
    keep = lambda v: F.when(F.col("ord") % 10 == 3, F.slice(v, 1, n - 1)).otherwise(v)
    mixed = turned.select("ord", "inv_id", "species", keep(slot(F.col("qx"))).alias("x"), keep(slot(F.col("qy"))).alias("y"))
    return mixed, ref


def numbering_sql(n: int) -> str:
    points = V.POINTS_SQL.replace("range(32)", f"range({n})")
    head = V.with_sql(points, STD_SQL, "frozen as (select i, x, y from std where ord = 0)", CLOUD_SQL)
    return head + f"""
, m as (select ord, avg(x) as mx, avg(y) as my from whole group by 1), f as (select avg(x) as fx, avg(y) as fy from frozen),
k as (select w.ord, sum((w.x - mx) * (r.x - fx) + (w.y - my) * (r.y - fy)) as a, sum((w.x - mx) * (r.y - fy) - (w.y - my) * (r.x - fx)) as b,
             sum((w.x - mx) * (w.x - mx) + (w.y - my) * (w.y - my)) as p, sum((r.x - fx) * (r.x - fx) + (r.y - fy) * (r.y - fy)) as t
      from whole w join frozen r using (i) join m using (ord), f group by 1)
select ord, 'OK' as status, '' as error_reason, round((t - (a * a + b * b) / p) / {n}, 8) as cost,
       (select round(sum(x * (i + 1)), 3) from whole w where w.ord = k.ord) as check_x, (select round(sum(y * (i + 1)), 3) from whole w where w.ord = k.ord) as check_y from k
union all select distinct ord, 'FAILED', '{n - 1} landmarks, {n} expected', null, null, null from std where ord % 10 = 3"""


def _numbering_check(spark, d, n: int, step: int) -> DataFrame:
    clouds, ref = _clouds(spark, d, n, step)
    done = N.number_landmarks(clouds, ref)
    good = F.col("status") == "OK"
    weight = lambda v: G.total(F.transform(v, lambda e, i: e * (i + 1)))
    return done.select(
        "ord", "status", "error_reason", F.when(good, F.round("registration_cost", 8)).alias("cost"),
        F.when(good, F.round(weight(F.col("nx")), 3)).alias("check_x"), F.when(good, F.round(weight(F.col("ny")), 3)).alias("check_y"),
    )


@query(numbering_sql(32))
def renumber(spark, d):
    return _numbering_check(spark, d, 32, 7)


@query(numbering_sql(18))
def renumber_eighteen_points(spark, d):
    """The landmark count of the published throughput figure."""
    return _numbering_check(spark, d, 18, 5)


@query(V.with_sql(V.PHOTO_SQL) + """
select 'OK' as status, count(*) as n from photo where ord % 10 <> 3 union all select 'FAILED', count(*) from photo where ord % 10 = 3""")
def renumber_statuses(spark, d):
    clouds, ref = _clouds(spark, d)
    biology = V.photos(spark, d).groupBy("inv_id").agg(F.min("species").alias("species"))
    # the deformation is noise of one size, so no specimen stands out from its species
    return N.renumber(clouds, ref, biology).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query()
def renumber_noise_clouds(spark, d):
    """Clouds unrelated to the reference: the hardest case for the solver."""
    shapes = V.shapes(spark, d).select("ord", "x", "y")
    done = N.number_landmarks(shapes, frozen_reference(spark, d))
    return done.select("ord", "status", F.round("registration_cost", 8).alias("registration_cost"))


@query(V.with_sql(V.POINTS_SQL, STD_SQL) + """
, t as (select ord, i, 10000 * x as x, 10000 * y as y from std),
p as (select ord, i, x + 0.02 * (i % 5) * (1 + ord % 90) as px, y as py from t where not (ord % 10 = 3 and i = 31)),
d as (select t.ord, sqrt((x - px) * (x - px)) as d from t join p using (ord, i)), c as (select count(distinct ord) as n, count(distinct ord) filter (ord % 10 = 3) as m, count(distinct ord) filter (ord % 10 = 4) as s from t)
select c.n as n_specimens, c.n as ok, 0::bigint as suspect, 0::bigint as failed, count(*) as n_matched_points, any_value(m) as n_missed_points, any_value(s) as n_spurious_points,
       round(avg(d), 6) as mean_error_px, round(avg(cast(d <= 5.001 as int)), 6) as pct_within_5px, round(avg(cast(d <= 10 as int)), 6) as pct_within_10px, round(median(d), 6) as median_error_px
from d, c group by c.n""")
def localization_error(spark, d):
    base = A.standardized(V.shapes(spark, d).select("ord", "x", "y"))
    truth = base.select("ord", G.scaled(F.col("xs"), F.lit(10000.0)).alias("tx"), G.scaled(F.col("ys"), F.lit(10000.0)).alias("ty"))
    shifted = F.transform("tx", lambda v, i: v + 0.02 * (i % 5) * (1 + F.col("ord") % 90))
    lost = lambda v: F.when(F.col("ord") % 10 == 3, F.slice(v, 1, 31)).otherwise(v)
    extra = lambda v: F.when(F.col("ord") % 10 == 4, F.array_append(v, F.lit(1e7))).otherwise(v)
    pairs = truth.withColumn("px", F.reverse(extra(lost(shifted)))).withColumn("py", F.reverse(extra(lost(F.col("ty")))))
    table = N.localization_error(N.matched_distances(pairs, "px", "py", "tx", "ty"))
    exact = [c for c in table.columns if c.startswith(("mean", "median", "pct"))]
    return table.select(*[F.round(c, 6).alias(c) if c in exact else F.col(c) for c in table.columns])


# --- crop space ------------------------------------------------------------------------------------------


def _boxes(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Per photo an image size, a turned box and crop-space landmarks."""
    base = A.standardized(V.shapes(spark, d).select("ord", "species", "x", "y")).withColumn("photo_id", F.col("ord"))
    landmarks = base.select(
        "photo_id", F.transform("xs", lambda v: 256 + 500 * v).alias("x"), F.transform("ys", lambda v: 128 + 250 * v).alias("y"))
    manifest = base.selectExpr(
        "photo_id", "concat('img/', ord) as path", "3000 + (ord % 5) * 200 as width", "2000 + (ord % 3) * 100 as height", "species").filter("species <> 'sp9'")
    detection = base.selectExpr(
        "photo_id", "case when species = 'sp8' then 'FAILED' else 'OK' end as status", "0.4D + (ord % 20) * 0.01D as cx", "0.5D as cy",
        "(ord % 180) * 0.017453292519943295D as t", "0.12D + (ord % 7) * 0.01D as hw", "0.05D as hh")
    corner = lambda sx, sy, k: F.expr(
        f"cx + ({sx}) * hw * cos(t) - ({sy}) * hh * sin(t)" if k == "x" else f"cy + ({sx}) * hw * sin(t) + ({sy}) * hh * cos(t)")
    signs = [(-1, -1), (1, -1), (1, 1), (-1, 1)]
    corners = [corner(sx, sy, k).alias(f"{k}{n}") for n, (sx, sy) in enumerate(signs, start=1) for k in ("x", "y")]
    return landmarks, manifest, detection.select("photo_id", "status", *corners)


@query("""
select case when label = 9 then 'photo_id not found in manifest.csv' when label = 8 then 'no OK detection row in detection.csv (OBB unavailable)' else 'moved' end as outcome, count(*) as n
from embeddings group by 1""")
def reproject_outcomes(spark, d):
    moved = C.reproject(*_boxes(spark, d))
    outcome = F.coalesce("reproject_reason", F.when(F.col("rx").isNotNull(), "moved"))
    return moved.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


@query("""
select vec_id as photo_id, true as same_points, 0 as n_out_of_bounds, 'OK' as status from embeddings where label not in (8, 9)""")
def reproject_round_trip(spark, d):
    """Crop space to raw image and back gives the same points again."""
    landmarks, manifest, detections = _boxes(spark, d)
    there = C.reproject(landmarks, manifest, detections).filter("reproject_reason is null")
    back = C.reproject(there.select("photo_id", F.col("rx").alias("x"), F.col("ry").alias("y")), manifest, detections, direction="to_crop")
    joined = C.bounds_status(back).join(landmarks.select("photo_id", F.col("x").alias("ox"), F.col("y").alias("oy")), "photo_id")
    same = G.shape_distance(F.col("rx"), F.col("ry"), F.col("ox"), F.col("oy")) < 1e-6
    inside = G.count_outside(F.col("ox"), F.col("oy"), C.OUT_WIDTH, C.OUT_HEIGHT)
    return joined.select("photo_id", same.alias("same_points"), (F.col("n_out_of_bounds") - inside).alias("n_out_of_bounds"),
                         F.when((F.col("n_out_of_bounds") > 0) == (F.col("status") == "SUSPECT"), "OK").otherwise("wrong").alias("status"))


UPRIGHT_SQL = """
with sized as (
  select vec_id, 3000 + (vec_id % 5) * 200 as w, 2000 + (vec_id % 3) * 100 as h, (vec_id * 373) % 3600 as cx, (vec_id * 257) % 2300 as cy,
         1 + (vec_id * 11) % 61 + case when (vec_id * 11) % 61 = (vec_id * 7) % 83 then 1 else 0 end as a, 1 + (vec_id * 7) % 83 as b,
         [floor(1500 + 1000 * cast(v as double)) for v in embedding[1:64:2]] as xs, [floor(1000 + 1000 * cast(v as double)) for v in embedding[2:64:2]] as ys
  from embeddings),
turned as (
  select vec_id, a, b, greatest(a, b) as long, least(a, b) as short, case when a > b then w else h end as cw, case when a > b then h else w end as ch,
         case when a > b then cx else h - cy end as mx, case when a > b then cy else cx end as my,
         case when a > b then xs else [h - y for y in ys] end as us, case when a > b then ys else xs end as vs
  from sized),
want as (select *, greatest(44 * long, 88 * short) as ww, greatest(22 * long, 44 * short) as wh from turned),
cut as (select *, least(ww, cw) as iw, least(wh, ch) as ih from want),
placed as (select *, greatest(0, least(mx - ww / 2, cw - iw)) as l, greatest(0, least(my - wh / 2, ch - ih)) as t, abs(iw / ih - 2.0) > 0.02 as off from cut),
fitted as (select *, case when off and iw / 2 > ih then 2 * ih else iw end as sw, case when off and iw / 2 <= ih then iw / 2 else ih end as sh from placed)
select vec_id as photo_id, l::double as l, t::double as t, (l + sw)::double as r, (t + sh)::double as b, true as aspect_right, round((us[1] - l) * 512 / sw, 3) as x1, round((vs[1] - t) * 256 / sh, 3) as y1,
       round((list_sum(us) - 32 * l) * 512 / sw, 3) as sum_x, round((list_sum(vs) - 32 * t) * 256 / sh, 3) as sum_y
from fitted"""


@query(UPRIGHT_SQL)
def reproject_points(spark, d):
    """Upright and quarter-turned boxes, some beyond the image or larger than it: window and points are plain arithmetic in SQL."""
    sized = V.shapes(spark, d).selectExpr(
        "ord as photo_id", "x", "y", "3000 + (ord % 5) * 200 as width", "2000 + (ord % 3) * 100 as height", "(ord * 373) % 3600 as cx", "(ord * 257) % 2300 as cy",
        "1 + (ord * 11) % 61 + case when (ord * 11) % 61 = (ord * 7) % 83 then 1 else 0 end as a", "1 + (ord * 7) % 83 as b")
    landmarks = sized.selectExpr(
        "photo_id", "transform(x, v -> cast(floor(1500 + 1000 * v) as double)) as x", "transform(y, v -> cast(floor(1000 + 1000 * v) as double)) as y")
    manifest = sized.selectExpr("photo_id", "concat('img/', photo_id) as path", "width", "height")
    signs = [(-1, -1), (1, -1), (1, 1), (-1, 1)]
    corners = [c for n, (sx, sy) in enumerate(signs, start=1) for c in (f"(cx + ({sx}) * 20 * a) / width as x{n}", f"(cy + ({sy}) * 20 * b) / height as y{n}")]
    detections = sized.selectExpr("photo_id", "'OK' as status", *corners)
    moved = C.reproject(landmarks, manifest, detections, direction="to_crop")
    framed = sized.join(detections, "photo_id").select(
        "photo_id", "a", "b", C.crop_transform([F.col(c) for c in C.CORNER_COLUMNS], F.col("width").cast("double"), F.col("height").cast("double")).alias("g"))
    ratio = F.greatest("a", "b") / F.least("a", "b")
    total = lambda c: F.round(F.aggregate(c, F.lit(0.0), lambda s, v: s + v), 3)
    return framed.join(moved, "photo_id").select(
        "photo_id", F.col("g.left").alias("l"), F.col("g.top").alias("t"), F.col("g.right").alias("r"), F.col("g.bottom").alias("b"),
        (F.abs(F.col("aspect_ratio") - ratio) < 0.001 * ratio).alias("aspect_right"), F.round(F.col("rx")[0], 3).alias("x1"), F.round(F.col("ry")[0], 3).alias("y1"),
        total("rx").alias("sum_x"), total("ry").alias("sum_y"))

"""Registered queries over the classification view: cleaning, profile, encoders, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyridge.functions.hashing import hash_mod, md5_key
from tallyridge.operators import clean as C
from tallyridge.operators import dedup as D
from tallyridge.operators import features as E
from tallyridge.operators import joins as J
from tallyridge.operators import profile as Q
from tallyridge.operators import sketches as K
from tallyridge.operators import splits as P
from tallyridge.operators import stats as T
from tallyridge.plans.catalog import query

NUMERIC = ["cap_diameter", "stem_height", "stem_width"]
CATEGORIES = ["brand", "kind", "color", "has_ring", "ring_type", "veil"]
INPUTS = NUMERIC + CATEGORIES
CONTENT = ["label", *INPUTS]
# Category vocabularies of the study table.
KINDS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]

C_LIST, IN_LIST = ", ".join(CONTENT), ", ".join(INPUTS)


def each(columns, template, sep=" UNION ALL "):
    return sep.join(template.format(c=c) for c in columns)


# ---------------------------------------------------------------- cleaning


@query("clean_zero_to_null", "SELECT row_id, cap_diameter, nullif(stem_height, 0) AS stem_height, nullif(stem_width, 0) AS stem_width FROM items")
def _(v):
    return C.zero_to_null(v.items, ["stem_height", "stem_width"]).select("row_id", *NUMERIC)


@query("clean_missing_category", "SELECT row_id, coalesce(brand, 'missing') AS brand, coalesce(kind, 'missing') AS kind, coalesce(color, 'missing') AS color FROM items")
def _(v):
    return C.fill_missing_category(v.items, ["brand", "kind", "color"], "missing").select("row_id", "brand", "kind", "color")


@query("check_vocabulary", """
SELECT 'kind' AS "column", kind AS value, count(*) AS n FROM items WHERE kind NOT IN ('ECONOMY', 'LARGE', 'MEDIUM') GROUP BY 2
UNION ALL SELECT 'ring_type', ring_type, count(*) FROM items WHERE ring_type NOT IN ('f') GROUP BY 2""")
def _(v):
    return C.unexpected_values(v.items, {"kind": KINDS[:3], "ring_type": ["f"], "has_ring": ["t", "f"]})


@query("check_field_contradiction", "SELECT label, count(*) AS n FROM items WHERE has_ring = 't' AND ring_type = 'f' GROUP BY 1")
def _(v):
    return C.contradictions(v.items, (F.col("has_ring") == "t") & (F.col("ring_type") == "f"), "label")


@query("check_negative_values", each(NUMERIC, """SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} < 0) AS negatives FROM items"""))
def _(v):
    return C.negative_counts(v.items, NUMERIC)


@query("filter_dropna_effect", f"SELECT count(*) AS rows, count_if({' AND '.join(f'{c} IS NOT NULL' for c in CONTENT)})::BIGINT AS complete_rows FROM items")
def _(v):
    return C.complete_rows(v.items.select(*CONTENT))


BOUNDS_SQL = each(NUMERIC, """SELECT '{c}' AS k, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM items""")


@query("clean_iqr_flags", f"""
WITH q AS ({BOUNDS_SQL}), b AS (SELECT k, round(q1 - 1.5 * (q3 - q1), 6) AS lo, round(q3 + 1.5 * (q3 - q1), 6) AS hi FROM q),
 f AS (SELECT label, {' OR '.join(f"{c} < (SELECT lo FROM b WHERE k = '{c}') OR {c} > (SELECT hi FROM b WHERE k = '{c}')" for c in NUMERIC[:1])} OR
   {' OR '.join(f"{c} < (SELECT lo FROM b WHERE k = '{c}') OR {c} > (SELECT hi FROM b WHERE k = '{c}')" for c in NUMERIC[1:])} AS o FROM items)
SELECT label, count(*) AS n, count_if(o)::BIGINT AS outliers, round(100.0 * count_if(o) / count(*), 6) AS loss_percent FROM f GROUP BY 1""")
def _(v):
    flagged, _bounds = C.iqr_flags(v.items, NUMERIC)
    out = F.count_if("is_outlier")
    return flagged.groupBy("label").agg(F.count(F.lit(1)).alias("n"), out.alias("outliers"), (out * 100.0 / F.count(F.lit(1))).alias("loss_percent"))


@query("clean_clip_quantiles", "WITH " + each(NUMERIC, """q_{c} AS (SELECT quantile_cont({c}, 0.005) AS lo, quantile_cont({c}, 0.995) AS hi FROM items)""", ", ") + " " + each(NUMERIC, """
SELECT '{c}' AS "column", round(lo, 6) AS low_q, round(hi, 6) AS high_q, count_if({c} < lo OR {c} > hi)::BIGINT AS changed FROM items, q_{c} GROUP BY ALL"""))
def _(v):
    clipped, bounds = C.clip_to_quantiles(v.items.select("row_id", *NUMERIC, *[F.col(c).alias(f"old_{c}") for c in NUMERIC]), NUMERIC)
    changed = clipped.agg(*[F.count_if(F.col(c) != F.col(f"old_{c}")).alias(c) for c in NUMERIC])
    return bounds.join(changed.unpivot([], NUMERIC, "column", "changed"), "column")


@query("clean_effect_report", f"""
WITH f AS (SELECT min(row_id) AS row_id, {C_LIST} FROM items GROUP BY {C_LIST}),
 a AS (SELECT row_id, label, cap_diameter, nullif(stem_height, 0) AS stem_height, stem_width, coalesce(brand, 'missing') AS brand, coalesce(kind, 'missing') AS kind,
   coalesce(color, 'missing') AS color, has_ring, ring_type, veil FROM f)
SELECT 'rows' AS "check", (SELECT count(*) FROM items) AS before, (SELECT count(*) FROM a) AS after
UNION ALL SELECT 'repeated_rows', (SELECT sum(n - 1)::BIGINT FROM (SELECT count(*) AS n FROM items GROUP BY {C_LIST})), (SELECT sum(n - 1)::BIGINT FROM (SELECT count(*) AS n FROM a GROUP BY {C_LIST}))
UNION ALL SELECT 'empty_cells', (SELECT sum({' + '.join(f'({c} IS NULL)::INT' for c in CONTENT)})::BIGINT FROM items), (SELECT sum({' + '.join(f'({c} IS NULL)::INT' for c in CONTENT)})::BIGINT FROM a)
UNION ALL SELECT 'explicit_unknown', 0, (SELECT sum({' + '.join(f"({c} = 'missing')::INT" for c in CATEGORIES)})::BIGINT FROM a)
UNION ALL SELECT 'changed_measures', 0, (SELECT sum((a.stem_height IS DISTINCT FROM f.stem_height)::INT)::BIGINT FROM a JOIN f USING (row_id))""")
def _(v):
    first = D.keep_first_row(v.items, CONTENT, "row_id").select("row_id", *CONTENT)
    after = C.fill_missing_category(C.zero_to_null(first, ["stem_height"]), ["brand", "kind", "color"], "missing")
    return C.effect_report(v.items.select("row_id", *CONTENT), after, "row_id", CATEGORIES, NUMERIC, "missing")


# ---------------------------------------------------------------- profile


@query("agg_missing_by_column", each(CONTENT, """SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) AS missing, round(100.0 * count(*) FILTER (WHERE {c} IS NULL) / count(*), 6) AS percent FROM items"""))
def _(v):
    return Q.missing_by_column(v.items, CONTENT)


@query("agg_value_counts_share", "SELECT label, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS percent FROM items GROUP BY 1")
def _(v):
    return Q.value_shares(v.items, "label")


@query("agg_before_after_share", f"""
WITH u AS (SELECT DISTINCT {C_LIST} FROM items), a AS (SELECT label, count(*) AS n FROM items GROUP BY 1), b AS (SELECT label, count(*) AS n FROM u GROUP BY 1)
SELECT label, a.n AS n_before, round(100.0 * a.n / (SELECT sum(n) FROM a), 6) AS percent_before, coalesce(b.n, 0) AS n_after,
  round(coalesce(100.0 * b.n / (SELECT sum(n) FROM b), 0), 6) AS percent_after, round(100.0 * (a.n - coalesce(b.n, 0)) / a.n, 6) AS loss_percent FROM a LEFT JOIN b USING (label)""")
def _(v):
    return Q.before_after(v.items, v.items.select(*CONTENT).distinct(), "label")


DISTINCT_SQL = each(CONTENT, """SELECT '{c}' AS "column", count(DISTINCT {c}) AS "distinct" FROM items""")


@query("agg_distinct_per_column", DISTINCT_SQL)
def _(v):
    return Q.distinct_per_column(v.items, CONTENT)


@query("agg_distinct_sketches", f'SELECT "column", "distinct", true AS near_of_3, true AS near_of_7 FROM ({DISTINCT_SQL})')
def _(v):
    """Distinct counts merged from the sketches of three and of seven parts: within 5 % of the exact ones."""
    out = Q.distinct_per_column(v.items, CONTENT)
    for n in (3, 7):
        parts = K.distinct_parts(v.items.withColumn("part", F.col("row_id") % n), "part", CONTENT)
        out = out.join(K.merged_distinct(parts).withColumnRenamed("distinct", f"of_{n}"), "column", "left")
    near = {n: F.coalesce(F.abs(F.col(f"of_{n}") - F.col("distinct")) <= 0.05 * F.col("distinct"), F.col("distinct") == 0) for n in (3, 7)}
    return out.select("column", "distinct", *[c.alias(f"near_of_{n}") for n, c in near.items()])


@query("agg_constant_columns", f'SELECT * FROM ({DISTINCT_SQL}) WHERE "distinct" <= 1')
def _(v):
    return Q.constant_columns(v.items, CONTENT)


@query("agg_describe", each(NUMERIC, """
SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS sd, min({c}) AS minimum, round(quantile_cont({c}, .25), 6) AS q25,
  round(quantile_cont({c}, .5), 6) AS median, round(quantile_cont({c}, .75), 6) AS q75, max({c}) AS maximum, round(avg({c}) - quantile_cont({c}, .5), 6) AS mean_minus_median FROM items"""))
def _(v):
    return Q.describe(v.items, NUMERIC)


@query("agg_group_moments", each(NUMERIC, """
SELECT label, '{c}' AS "column", round(avg({c}), 6) AS mean, round(quantile_cont({c}, .5), 6) AS median, round(stddev_samp({c}), 6) AS sd FROM items GROUP BY 1"""))
def _(v):
    return Q.group_moments(v.items, "label", NUMERIC)


@query("agg_crosstab", """
SELECT coalesce(kind, 'missing') AS level, count(*) AS total, count_if(label = 'e')::BIGINT AS n_e, count_if(label = 'p')::BIGINT AS n_p,
  round(100.0 * count_if(label = 'e') / count(*), 6) AS percent_e, round(100.0 * count_if(label = 'p') / count(*), 6) AS percent_p FROM items GROUP BY 1""")
def _(v):
    return Q.crosstab(v.items, "kind", "label", ["e", "p"])


@query("agg_known_unknown_by_class", "SELECT * FROM (" + each(CATEGORIES, """
SELECT '{c}' AS "column", count({c}) AS known, count(DISTINCT {c}) AS "distinct", round(100.0 * count_if({c} IS NOT NULL AND label = 'p') / nullif(count({c}), 0), 6) AS percent_known,
  round(100.0 * count_if({c} IS NULL AND label = 'p') / nullif(count_if({c} IS NULL), 0), 6) AS percent_unknown FROM items HAVING 100.0 * count_if({c} IS NULL) / count(*) > 80""") + ")")
def _(v):
    return Q.sparse_columns(v.items, CATEGORIES, "label", "p")


@query("agg_label_conflicts", f"""
SELECT count(*) FILTER (WHERE k > 1) AS conflicting_inputs, coalesce(sum(n) FILTER (WHERE k > 1), 0)::BIGINT AS rows
FROM (SELECT count(DISTINCT label) AS k, count(*) AS n FROM items GROUP BY {IN_LIST})""")
def _(v):
    return Q.label_conflicts(v.items, INPUTS, "label")


@query("agg_duplicate_profile", f"SELECT label, sum(n - 1)::BIGINT AS repeated_rows FROM (SELECT label, count(*) AS n FROM items GROUP BY {C_LIST}) GROUP BY 1")
def _(v):
    return Q.duplicate_profile(v.items, CONTENT, "label")


@query("agg_combination_counts", "SELECT stem_height, stem_width, kind, color, label, count(*) AS n FROM items WHERE stem_height = 0 OR stem_width = 0 GROUP BY ALL")
def _(v):
    return Q.combination_counts(v.items.where("stem_height = 0 OR stem_width = 0"), ["stem_height", "stem_width", "kind", "color", "label"])


@query("agg_mode", each(CATEGORIES, """SELECT * FROM (SELECT '{c}' AS "column", {c} AS mode, count(*) AS n FROM items WHERE {c} IS NOT NULL GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 1)"""))
def _(v):
    return Q.modes(v.items, CATEGORIES)


@query("agg_correlation_matrix", " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM items" for a in NUMERIC for b in NUMERIC))
def _(v):
    return Q.correlations(v.items, NUMERIC)


@query("model_majority", "SELECT label AS mode, count(*) AS n FROM items GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1")
def _(v):
    return Q.modes(v.items, ["label"]).select("mode", "n")


@query("win_keep_first_row", f"SELECT min(row_id) AS row_id, label, kind, brand, count(*) AS copies FROM items GROUP BY {C_LIST}")
def _(v):
    return D.keep_first_row(v.items, CONTENT, "row_id").select("row_id", "label", "kind", "brand", "copies")


@query("set_distinct_rows", f"SELECT DISTINCT {C_LIST} FROM items")
def _(v):
    return v.items.select(*CONTENT).distinct()


@query("sample_fixed_size", "SELECT row_id, label FROM items ORDER BY md5(concat_ws('|', row_id::VARCHAR, '42')), row_id LIMIT 100")
def _(v):
    return v.items.orderBy(md5_key(F.col("row_id"), "42"), "row_id").limit(100).select("row_id", "label")


CHI_COLUMNS = ["has_ring", "kind", "brand"]


@query("stat_chi_square", " UNION ALL ".join(f"""
SELECT * FROM (WITH o AS (SELECT r, c, count(i.row_id) AS o FROM (SELECT DISTINCT {c} AS r FROM items WHERE {c} IS NOT NULL) x CROSS JOIN (SELECT DISTINCT label AS c FROM items) y
    LEFT JOIN items i ON i.{c} = r AND i.label = c GROUP BY ALL),
  e AS (SELECT *, sum(o) OVER (PARTITION BY r) * sum(o) OVER (PARTITION BY c) / (sum(o) OVER ())::DOUBLE AS e FROM o),
  d AS (SELECT (count(DISTINCT r) - 1) * (count(DISTINCT c) - 1) AS dof FROM o)
SELECT t.* EXCLUDE (raw), round(CASE WHEN dof < 1 THEN 1 ELSE 1 - list_sum(list_transform(range(0, 400 + (2 * chi2)::BIGINT + dof), lambda k:
    exp((dof / 2 + k) * ln(greatest(raw, 1e-300) / 2) - raw / 2 - lgamma(dof / 2 + k + 1)))) END, 6) AS p_value FROM (
SELECT '{c}' AS "column", sum(CASE WHEN dof = 1 THEN pow(abs(o - e) - least(0.5, abs(o - e)), 2) / e ELSE pow(o - e, 2) / e END) AS raw, round(sum(CASE WHEN dof = 1 THEN pow(abs(o - e) - least(0.5, abs(o - e)), 2) / e ELSE pow(o - e, 2) / e END), 6) AS chi2, max(dof)::BIGINT AS dof, round(min(e), 6) AS min_expected FROM e, d) t)""" for c in CHI_COLUMNS))
def _(v):
    cells = Q.value_counts(v.items, CHI_COLUMNS, ["label"]).where("value IS NOT NULL")
    return T.chi_square(cells, ["column"], "value", "label")


# ---------------------------------------------------------------- encoders and imputers


@query("feat_one_hot_fixed", "SELECT row_id, " + ", ".join(f"(kind = '{k}')::INT AS kind_{k.lower()}" for k in KINDS)
       + ", (has_ring = 't')::INT AS has_ring_t, (has_ring = 'f')::INT AS has_ring_f FROM items WHERE kind IS NOT NULL")
def _(v):
    out = E.one_hot(v.items.where("kind IS NOT NULL"), {"kind": KINDS, "has_ring": ["t", "f"]})
    return out.select("row_id", *[f"kind_{k.lower()}" for k in KINDS], "has_ring_t", "has_ring_f")


TRAIN_SQL = """
holed AS (SELECT *, CASE WHEN row_id % 10 <> 3 THEN cap_diameter END AS cap, nullif(stem_height, 0) AS height,
  ('0x' || substr(md5(concat_ws('|', row_id::VARCHAR, 'imp')), 1, 8))::BIGINT % 5 <> 0 AS in_train FROM items)"""


def holed(v):
    return v.items.withColumns({
        "cap": F.when(F.col("row_id") % 10 != 3, F.col("cap_diameter")), "height": F.nullif(F.col("stem_height"), F.lit(0.0)),
        "in_train": hash_mod(5, F.col("row_id"), "imp") != 0})


@query("feat_impute_median", f"""
WITH {TRAIN_SQL} SELECT row_id, coalesce(cap, (SELECT quantile_cont(cap, 0.5) FROM holed WHERE in_train)) AS cap,
  round(coalesce(height, (SELECT quantile_cont(height, 0.5) FROM holed WHERE in_train)), 6) AS height FROM holed""")
def _(v):
    rows = holed(v)
    return E.impute_median(rows, rows.where("in_train"), ["cap", "height"]).select("row_id", "cap", "height")


@query("feat_impute_mode_constant", f"""
WITH {TRAIN_SQL} SELECT row_id, coalesce(kind, (SELECT kind FROM holed WHERE in_train AND kind IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS kind,
  coalesce(brand, (SELECT brand FROM holed WHERE in_train AND brand IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS brand, coalesce(color, 'missing') AS color FROM holed""")
def _(v):
    rows = holed(v)
    out = E.impute_mode(rows, rows.where("in_train"), ["kind", "brand"])
    return E.impute_constant(out, ["color"]).select("row_id", "kind", "brand", "color")


@query("feat_missing_indicator", "SELECT row_id, (brand IS NULL)::INT AS brand_missing, (kind IS NULL)::INT AS kind_missing, (color IS NULL)::INT AS color_missing FROM items")
def _(v):
    return E.missing_indicators(v.items, ["brand", "kind", "color"]).select("row_id", "brand_missing", "kind_missing", "color_missing")


@query("feat_geometry_ratio", """
SELECT row_id, round(cap_diameter / CASE WHEN stem_height > 0 THEN stem_height END, 6) AS cap_to_stem_height,
  round(10 * stem_height / CASE WHEN stem_width > 0 THEN stem_width END, 6) AS stem_slenderness FROM items""")
def _(v):
    return E.geometry(v.items, *NUMERIC).select("row_id", "cap_to_stem_height", "stem_slenderness")


@query("feat_standard_scale", f"""
WITH {TRAIN_SQL} SELECT row_id, {', '.join(f"round(({c} - (SELECT avg({c}) FROM holed WHERE in_train)) / (SELECT stddev_pop({c}) FROM holed WHERE in_train), 6) + 0 AS {c}_z" for c in NUMERIC)} FROM holed""")
def _(v):
    rows = holed(v)
    return E.standard_scale(rows, rows.where("in_train"), NUMERIC).select("row_id", *[f"{c}_z" for c in NUMERIC])


@query("feat_polynomial2", "SELECT row_id, " + ", ".join(f"round({a} * {b}, 6) + 0 AS {a}_x_{b}" for i, a in enumerate(NUMERIC) for b in NUMERIC[i:]) + " FROM items")
def _(v):
    return E.polynomial2(v.items, NUMERIC).select("row_id", *[f"{a}_x_{b}" for i, a in enumerate(NUMERIC) for b in NUMERIC[i:]])


@query("feat_native_category_levels", f"""
WITH {TRAIN_SQL}, t AS (SELECT * FROM holed WHERE in_train AND brand <> 'Brand#7')
SELECT row_id, CASE WHEN brand IN (SELECT brand FROM t) THEN brand END AS brand, CASE WHEN color IN (SELECT color FROM t) THEN color END AS color FROM items""")
def _(v):
    train = holed(v).where("in_train AND brand <> 'Brand#7'")
    return E.training_levels(v.items, train, ["brand", "color"]).select("row_id", "brand", "color")


# ---------------------------------------------------------------- splits


def md5_order(seed, row="row_id"):
    return f"md5(concat_ws('|', {row}::VARCHAR, '{seed}')), {row}"


HOLD_SQL = f"""
hold AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY {md5_order(7)}) <= round(count(*) OVER (PARTITION BY label) * 0.2) THEN 'test' ELSE 'train' END AS split FROM items)"""


@query("split_stratified_holdout", f"WITH {HOLD_SQL} SELECT row_id, label, split FROM hold")
def _(v):
    return P.stratified_holdout(v.items, "label", "row_id", 0.2, 7).select("row_id", "label", "split")


@query("split_stratified_kfold", f"SELECT row_id, label, ((row_number() OVER (PARTITION BY label ORDER BY {md5_order(42)}) - 1) % 5 + 1)::INT AS fold FROM items")
def _(v):
    return P.stratified_folds(v.items, "label", "row_id", 5, 42).select("row_id", "label", "fold")


def _uneven(n: str) -> str:
    """Deviation of one class's shares over five folds if fold f takes one more group."""
    return (f"sqrt(5 * (list_sum(list_transform(s_{n}, lambda x: x * x)) + 2 * s_{n}[f] * {n} + {n} * {n}) - (list_sum(s_{n}) + {n}) * (list_sum(s_{n}) + {n})) "
            f"/ (5 * all_{n})")


@query("split_group_kfold", f"""
WITH RECURSIVE r AS (SELECT *, row_id // 50 AS grp FROM items),
 g AS (SELECT grp, count_if(label = 'e')::BIGINT AS e, count_if(label = 'p')::BIGINT AS p FROM r GROUP BY 1),
 o AS (SELECT *, (sum(e) OVER ())::BIGINT AS all_e, (sum(p) OVER ())::BIGINT AS all_p, row_number() OVER (ORDER BY 2 * (e * e + p * p) - (e + p) * (e + p) DESC, e, p, md5(concat_ws('|', grp::VARCHAR, '42')), grp) AS i FROM g),
 steps AS (
  SELECT 0::BIGINT AS i, NULL::BIGINT AS grp, NULL::BIGINT AS fold, [0, 0, 0, 0, 0]::BIGINT[] AS s_e, [0, 0, 0, 0, 0]::BIGINT[] AS s_p
  UNION ALL
  SELECT i, grp, b.f AS fold, list_transform(s_e, lambda x, j: CASE WHEN j = b.f THEN x + e ELSE x END), list_transform(s_p, lambda x, j: CASE WHEN j = b.f THEN x + p ELSE x END)
  FROM (SELECT o.*, s_e, s_p, list_sort(list_transform(range(1, 6), lambda f: {{'v': {_uneven('e')} + {_uneven('p')}, 'n': s_e[f] + s_p[f], 'f': f}}))[1] AS b
    FROM steps JOIN o ON o.i = steps.i + 1))
SELECT row_id, r.grp, fold::INT AS fold FROM r JOIN steps USING (grp)""")
def _(v):
    rows = v.items.withColumn("grp", F.floor(F.col("row_id") / 50))
    return P.group_folds(rows, "grp", "label", 5, 42).select("row_id", "grp", "fold")


MANIFEST_SQL = f"""{HOLD_SQL},
tr AS (SELECT row_id, label, split, row_number() OVER (ORDER BY {md5_order('7-order')}) - 1 AS training_order,
  ((row_number() OVER (PARTITION BY label ORDER BY {md5_order('7-cv')}) - 1) % 5 + 1)::INT AS cv_validation_fold FROM hold WHERE split = 'train'),
manifest AS (SELECT * FROM tr UNION ALL SELECT row_id, label, split, NULL, NULL FROM hold WHERE split = 'test')"""


@query("split_manifest", f"WITH {MANIFEST_SQL} SELECT * FROM manifest")
def _(v):
    return P.split_manifest(v.items, "label", "row_id", 0.2, 5, 7)


@query("join_split_manifest", f"""
WITH {MANIFEST_SQL} SELECT i.row_id, i.kind, training_order, cv_validation_fold FROM items i JOIN manifest m ON m.row_id = i.row_id AND m.split = 'train'""")
def _(v):
    manifest = P.split_manifest(v.items, "label", "row_id", 0.2, 5, 7)
    return P.manifest_training(v.items.select("row_id", "kind"), manifest, "row_id")


@query("split_nested", f"""
WITH o AS (SELECT row_id, label, (row_number() OVER (PARTITION BY label ORDER BY {md5_order(11)}) - 1) % 5 + 1 AS own FROM items),
 t AS (SELECT row_id, label, f::INT AS "outer" FROM o CROSS JOIN (SELECT unnest(generate_series(1, 5)) AS f) WHERE f <> own)
SELECT row_id, label, "outer", ((row_number() OVER (PARTITION BY "outer", label ORDER BY md5(concat_ws('|', row_id::VARCHAR, (11 + "outer")::VARCHAR)), row_id) - 1) % 3 + 1)::INT AS inner FROM t""".replace(" AS inner ", ' AS "inner" '))
def _(v):
    return P.nested_folds(v.items, "label", "row_id", 5, 3, 11)


@query("set_disjoint_splits", f"""
WITH {HOLD_SQL}, g AS (SELECT row_id, split, row_id // 50 AS grp FROM hold),
 a AS (SELECT row_id AS k, max((split = 'train')::INT) AS tr, max((split = 'test')::INT) AS te FROM g GROUP BY 1), b AS (SELECT grp AS k, max((split = 'train')::INT) AS tr, max((split = 'test')::INT) AS te FROM g GROUP BY 1)
SELECT 'row' AS unit, sum(tr)::BIGINT AS train, sum(te)::BIGINT AS test, sum(tr * te)::BIGINT AS shared, count(*) AS all_keys FROM a
UNION ALL SELECT 'group', sum(tr)::BIGINT, sum(te)::BIGINT, sum(tr * te)::BIGINT, count(*) FROM b""")
def _(v):
    rows = P.stratified_holdout(v.items, "label", "row_id", 0.2, 7).withColumn("grp", F.floor(F.col("row_id") / 50))
    return P.disjoint_report(rows, "split", "row_id", "grp")


@query("join_content_overlap", f"""
WITH {HOLD_SQL} SELECT row_id, label FROM hold a WHERE split = 'test' AND EXISTS (SELECT 1 FROM hold b WHERE b.split = 'train' AND {' AND '.join(f'a.{c} IS NOT DISTINCT FROM b.{c}' for c in INPUTS)})""")
def _(v):
    rows = P.stratified_holdout(v.items, "label", "row_id", 0.2, 7)
    return J.content_overlap(rows.where("split = 'test'"), rows.where("split = 'train'"), INPUTS).select("row_id", "label")


@query("join_block_dimension", """
WITH r AS (SELECT *, row_id // 50 AS block FROM items),
 d AS (SELECT block, min(label) AS label, '[' || string_agg(DISTINCT kind, ', ') FILTER (WHERE row_id % 3 <> 0) || ']' AS kind, '[' || string_agg(DISTINCT ring_type, ', ') || ']' AS ring_type FROM r WHERE block % 9 <> 4 GROUP BY 1),
 j AS (SELECT r.label, r.kind, r.ring_type, d.block AS known, d.label AS dl, d.kind AS dk, d.ring_type AS dr FROM r LEFT JOIN d USING (block))
SELECT 'unknown_block' AS "check", count_if(known IS NULL)::BIGINT AS violations FROM j
UNION ALL SELECT 'class_mismatch', count_if(label <> dl)::BIGINT FROM j
UNION ALL SELECT 'kind', count_if(kind IS NOT NULL AND NOT coalesce(list_contains(string_split(trim(dk, '[]'), ', '), kind), false))::BIGINT FROM j
UNION ALL SELECT 'ring_type', count_if(ring_type IS NOT NULL AND NOT coalesce(list_contains(string_split(trim(dr, '[]'), ', '), ring_type), false))::BIGINT FROM j""")
def _(v):
    rows = v.items.withColumn("block", F.floor(F.col("row_id") / 50))

    def listed(column):
        return F.concat(F.lit("["), F.array_join(F.sort_array(F.collect_set(column)), ", "), F.lit("]"))

    # One reference entry per block of 50 rows: the sets hold at most 50 codes.
    dims = rows.where("block % 9 <> 4").groupBy("block").agg(
        F.min("label").alias("label"), listed(F.when(F.col("row_id") % 3 != 0, F.col("kind"))).alias("kind"), listed("ring_type").alias("ring_type"))
    return J.block_consistency(v.items, "row_id", 50, dims, "label", ["kind", "ring_type"])

"""Registered statistics / model / what-if queries and their oracles."""

from __future__ import annotations

import uuid
from statistics import NormalDist

from pyspark.sql import functions as F

from ..operators import models as MD
from ..operators import orders as O
from ..operators import sellers as S
from ..operators import stats as ST
from ..operators import whatif as W
from ..session import cut_lineage, ensure_checkpoint_dir
from ..sinks.datasets import read_datasets, union_datasets, write_datasets
from ..sources.catalog import load_tables
from ..sources.driver_tables import driver_catalog
from . import model_sql as SQL
from .order_queries import details_raw_sql, train_raw_sql
from .registry import npround, r6, register, stable_doubles
from .seller_queries import ECON_SQL

D = "::DOUBLE"
#: The numeric columns of the training table, in its order; ids aren't numbers.
NUMERIC = ["wait_time", "expected_wait_time", "delay_vs_expected", "dim_is_five_star", "dim_is_four_star",
           "dim_is_three_star", "dim_is_two_star", "dim_is_one_star", "review_score", "number_of_products",
           "number_of_sellers", "price", "freight_value", "distance_seller_customer"]
DETAILS = ["price", "freight_value", "distance_seller_customer", "number_of_products", "number_of_sellers",
           "product_weight_g_sum", "product_length_cm_max", "product_height_cm_max", "product_width_cm_max"]
LOGIT_FEATURES = ["wait_time", "delay_vs_expected", "number_of_sellers", "distance_seller_customer",
                  "price", "freight_value"]
MODEL4 = ["wait_time", "delay_vs_expected", "number_of_products", "price", "number_of_sellers",
          "distance_seller_customer"]
ETA_FEATURES = ["number_of_products", "number_of_sellers", "price", "freight_value", "distance_seller_customer"]
TRAIN = f"({train_raw_sql(True)})"
ONCE = f"WITH tr AS MATERIALIZED {TRAIN} "     # for oracles that read the training rows many times


def _train(spark, sf_dir):
    return O.training_data(driver_catalog(spark, sf_dir), with_distance=True)


def _numeric(d):
    """All numeric columns but ids, whatever the table has."""
    return [c for c in ST.select_numeric(d) if not c.endswith("_id")]


def _econ(spark, sf_dir):
    return S.seller_economics(driver_catalog(spark, sf_dir))


@register("describe_training", ONCE + " UNION ALL ".join(
    f"""SELECT '{c}' AS variable, count({c}) AS count, {r6(f'avg({c})')} AS mean, {r6(f'stddev_samp({c})')} AS std,
    {r6(f'min({c}){D}')} AS min, {r6(f'quantile_cont({c}{D}, 0.25)')} AS q25, {r6(f'quantile_cont({c}{D}, 0.5)')} AS q50,
    {r6(f'quantile_cont({c}{D}, 0.75)')} AS q75, {r6(f'max({c}){D}')} AS max FROM tr""" for c in NUMERIC))
def q_describe(spark, sf_dir):
    d = _train(spark, sf_dir)
    return stable_doubles(ST.describe_table(d, _numeric(d)))


@register("medians_training", ONCE + " UNION ALL ".join(
    f"SELECT '{c}' AS variable, {r6(f'quantile_cont({c}{D}, 0.5)')} AS median FROM tr" for c in NUMERIC))
def q_medians(spark, sf_dir):
    d = _train(spark, sf_dir)
    return stable_doubles(ST.medians(d, _numeric(d)))


_ORDER_TYPES = [("order_id", "bigint"), ("customer_id", "bigint"), ("order_status", "string"),
                ("order_purchase_timestamp", "timestamp_ntz"), ("order_approved_at", "timestamp_ntz"),
                ("order_delivered_carrier_date", "timestamp_ntz"), ("order_delivered_customer_date", "timestamp_ntz"),
                ("order_estimated_delivery_date", "timestamp_ntz")]


@register("schema_info_orders", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{t}' AS dtype, count({c}) AS non_null FROM ol_orders" for c, t in _ORDER_TYPES))
def q_schema_info(spark, sf_dir):
    return ST.schema_info(driver_catalog(spark, sf_dir)["orders"])


#: Column types of the profiled tables, as Spark names them.
_TYPES = {
    "orders": dict(_ORDER_TYPES),
    "order_items": {"order_id": "bigint", "order_item_id": "int", "product_id": "bigint", "seller_id": "bigint",
                    "shipping_limit_date": "timestamp_ntz", "price": "double", "freight_value": "double"},
    "order_reviews": {"review_id": "bigint", "order_id": "bigint", "review_score": "int", "review_comment_title": "string",
                      "review_comment_message": "string", "review_creation_date": "timestamp_ntz",
                      "review_answer_timestamp": "timestamp_ntz"},
    "customers": {"customer_id": "bigint", "customer_unique_id": "bigint", "customer_zip_code_prefix": "int",
                  "customer_city": "string", "customer_state": "string"},
    "sellers": {"seller_id": "bigint", "seller_zip_code_prefix": "int", "seller_city": "string", "seller_state": "string"},
    "products": {"product_id": "bigint", "product_category_name": "string", "product_name_lenght": "int",
                 "product_description_lenght": "int", "product_photos_qty": "int", "product_weight_g": "double",
                 "product_length_cm": "double", "product_height_cm": "double", "product_width_cm": "double"},
}


def _profile_sql(table: str) -> str:
    parts = []
    for c, kind in _TYPES[table].items():
        number = kind in ("int", "bigint", "double")
        x = f"{c}{D}" if number else f"NULL{D}"
        q = [f"quantile_cont({x}, {p})" if number else f"NULL{D}" for p in ST.QUARTILES]
        top = f"""(SELECT {{}} FROM (SELECT {c} AS v, count(*) AS c FROM ol_{table} WHERE {c} IS NOT NULL GROUP BY {c}) g
                   ORDER BY c DESC, v DESC LIMIT 1)"""
        parts.append(f"""SELECT '{c}' AS variable, '{kind}' AS dtype, count(*) AS n_rows,
    count(*) FILTER (WHERE {c} IS NULL) AS n_null, count(DISTINCT {c}) AS n_distinct,
    count(*) FILTER (WHERE {x} = 0) AS n_zeros, {r6(f'min({x})')} AS min, {r6(f'max({x})')} AS max,
    {r6(f'avg({x})')} AS mean, {r6(f'stddev_samp({x})')} AS std, {r6(q[0])} AS q25, {r6(q[1])} AS q50, {r6(q[2])} AS q75,
    {top.format('CAST(v AS VARCHAR)')} AS top_value, {top.format('c')} AS top_count FROM ol_{table}""")
    return " UNION ALL ".join(parts)


def _profile_query(table: str):
    @register(f"profile_{table}", _profile_sql(table))
    def q_profile(spark, sf_dir):
        return stable_doubles(ST.profile_table(driver_catalog(spark, sf_dir)[table]))


for _table in _TYPES:
    _profile_query(_table)


@register("profile_sink", " UNION ALL ".join(f"SELECT '{t}' AS dataset, * FROM ({_profile_sql(t)}) p_{t}" for t in _TYPES))
def q_profile_sink(spark, sf_dir):
    """Six profiles written as one version of a report, and read back."""
    tables, path = driver_catalog(spark, sf_dir), f"{ensure_checkpoint_dir(spark)}/profiles-{uuid.uuid4().hex}"
    write_datasets({t: stable_doubles(ST.profile_table(tables[t])) for t in _TYPES}, path)
    return union_datasets(read_datasets(spark, path))


_REVIEW_TEXT = """review_comment_message || chr(10) || '"' || coalesce(review_comment_title, '') || '",' || chr(10) || chr(10)"""


@register("load_tables_reviews", f"""SELECT review_id::VARCHAR AS review_id, order_id::VARCHAR AS order_id, review_score,
    review_comment_title, {_REVIEW_TEXT} AS review_comment_message, review_creation_date, review_answer_timestamp
    FROM ol_order_reviews""")
def q_load_tables(spark, sf_dir):
    """Reviews written as CSV files whose texts hold quotes and line breaks, and loaded."""
    folder = f"{ensure_checkpoint_dir(spark)}/csv-{uuid.uuid4().hex}"
    text = F.concat("review_comment_message", F.lit('\n"'), F.coalesce("review_comment_title", F.lit("")), F.lit('",\n\n'))
    (driver_catalog(spark, sf_dir)["order_reviews"].withColumn("review_comment_message", text)
     .write.options(header=True, escape='"', ignoreTrailingWhiteSpace=False, timestampNTZFormat="yyyy-MM-dd HH:mm:ss")
     .csv(f"{folder}/olist_order_reviews_dataset.csv"))
    return load_tables(spark, folder)["order_reviews"]


def _pairs(cols):
    return [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]


@register("corr_matrix_training", ONCE + " UNION ALL ".join(
    f"SELECT '{a}' AS variable_a, '{b}' AS variable_b, {r6(f'corr({a}{D}, {b}{D})')} AS corr FROM tr"
    for a, b in _pairs(NUMERIC)))
def q_corr_matrix(spark, sf_dir):
    d = _train(spark, sf_dir)
    return stable_doubles(ST.corr_matrix(d, _numeric(d)))


@register("corr_with_review_score", ONCE + " UNION ALL ".join(
    f"""SELECT '{c}' AS variable, {r6(f'corr(review_score{D}, {c}{D})')} AS corr,
    {npround(f'abs(corr(review_score{D}, {c}{D}))', 2)} AS abs_corr FROM tr""" for c in NUMERIC if c != "review_score"))
def q_corr_target(spark, sf_dir):
    d = _train(spark, sf_dir)
    return stable_doubles(ST.corr_with_target(d, "review_score", _numeric(d)))


@register("corr_with_wait_time", ONCE + " UNION ALL ".join(
    f"""SELECT '{c}' AS variable, {r6(f'corr(wait_time{D}, {c}{D})')} AS corr,
    {npround(f'abs(corr(wait_time{D}, {c}{D}))', 2)} AS abs_corr FROM tr""" for c in NUMERIC if c != "wait_time"))
def q_corr_wait(spark, sf_dir):
    d = _train(spark, sf_dir)
    return stable_doubles(ST.corr_with_target(d, "wait_time", _numeric(d)))


_Z = ["wait_time", "delay_vs_expected", "price", "distance_seller_customer"]


@register("zscore_training", "SELECT order_id, " + ", ".join(
    f"{r6(f'({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER ()')} AS {c}" for c in _Z) + f" FROM {TRAIN} t")
def q_zscore(spark, sf_dir):
    return stable_doubles(ST.zscore(_train(spark, sf_dir).select("order_id", *_Z), _Z, ddof=1))


def _hist_sql(col: str, bins: int, by: str | None = None) -> str:
    key = f"{by}, " if by else ""
    gkey = f"g.{by}, " if by else ""
    grid = (f"(SELECT DISTINCT {by} FROM {TRAIN} t0), range({bins}) r(bin)" if by else f"range({bins}) r(bin)")
    return f"""
WITH b AS (SELECT min({col}){D} AS lo, max({col}){D} AS hi FROM {TRAIN} t1),
c AS (SELECT {key}CAST(least(greatest(CASE WHEN b.hi = b.lo THEN 0
             ELSE floor(({col}{D} - b.lo) / ((b.hi - b.lo) / {bins})) END, 0), {bins - 1}) AS INTEGER) AS bin,
             count(*) AS cnt FROM {TRAIN} t2, b WHERE {col} IS NOT NULL GROUP BY ALL)
SELECT {gkey}CAST(g.bin AS INTEGER) AS bin, {r6(f'b.lo + g.bin * ((b.hi - b.lo) / {bins})')} AS bin_lo,
       {r6(f'b.lo + (g.bin + 1) * ((b.hi - b.lo) / {bins})')} AS bin_hi, coalesce(c.cnt, 0) AS count
FROM (SELECT * FROM {grid}) g CROSS JOIN b LEFT JOIN c ON c.bin = g.bin{f' AND c.{by} = g.{by}' if by else ''}"""


@register("histogram_wait_time", _hist_sql("wait_time", 20))
def q_histogram(spark, sf_dir):
    return stable_doubles(ST.histogram(_train(spark, sf_dir), "wait_time", bins=20))


def _hists_sql(bins: int) -> str:
    return ONCE + " UNION ALL ".join(f"""SELECT '{c}' AS variable, CAST(g.bin AS INTEGER) AS bin,
    {r6(f'lo + g.bin * ((hi - lo) / {bins})')} AS bin_lo, {r6(f'lo + (g.bin + 1) * ((hi - lo) / {bins})')} AS bin_hi,
    count(t.x) AS count
FROM range({bins}) g(bin) CROSS JOIN (SELECT min({c}){D} AS lo, max({c}){D} AS hi FROM tr) b
LEFT JOIN (SELECT {c}{D} AS x FROM tr) t
  ON g.bin = least(CASE WHEN hi = lo THEN 0 ELSE floor((t.x - lo) / ((hi - lo) / {bins})) END, {bins - 1})
GROUP BY g.bin, lo, hi""" for c in NUMERIC)


@register("histograms_training", _hists_sql(10))
def q_histograms(spark, sf_dir):
    d = _train(spark, sf_dir)
    return stable_doubles(ST.histograms(d, _numeric(d), bins=10))


@register("histogram_wait_by_score", _hist_sql("wait_time", 20, "review_score"))
def q_histogram_by(spark, sf_dir):
    return stable_doubles(ST.histogram(_train(spark, sf_dir), "wait_time", bins=20, by="review_score"))


def _density_sql(source: str, x: str, by: str | None) -> str:
    key = f"{by}, " if by else ""
    on = f"USING ({by})" if by else "ON true"
    return f"""
WITH st AS (SELECT {key}n, lo, hi, sd * pow(n, -0.2{D}) AS bw FROM (
        SELECT {key}count({x}){D} AS n, stddev_samp({x}) AS sd, min({x}) AS lo, max({x}) AS hi FROM ({source}) s0
        {f'GROUP BY {by}' if by else ''}) s1 WHERE sd > 0),
bins AS (SELECT {key}n, lo, hi, bw, lo + (floor(({x} - lo) / (bw / 8)) + 0.5{D}) * (bw / 8) AS center, count(*) AS c
         FROM ({source}) s2 JOIN st {on} WHERE {x} IS NOT NULL GROUP BY ALL),
pts AS (SELECT *, lo - 3 * bw + i * ((hi - lo + 6 * bw) / 199) AS gx FROM bins, range(200) g(i))
SELECT {key}{r6('gx')} AS x, {r6(f'sum(c * exp(-0.5{D} * pow((gx - center) / bw, 2)) / (n * bw * sqrt(2 * pi())))')} AS density
FROM pts GROUP BY {key}i, gx"""


@register("density_wait_by_score", _density_sql(TRAIN[1:-1], "wait_time", "review_score"))
def q_density(spark, sf_dir):
    return stable_doubles(ST.density(_train(spark, sf_dir), "wait_time", by="review_score"))


_QQ_PROBS = [(k - 0.5) / 100 for k in range(1, 101)]


@register("qq_wait_time", f"""
WITH s AS (SELECT avg(wait_time) AS m, stddev_samp(wait_time) AS sd,
                  quantile_cont(wait_time, {_QQ_PROBS}) AS q FROM {TRAIN} t)
SELECT {r6('p')} AS p, {r6('theoretical')} AS theoretical, {r6('sample')} AS sample,
       {r6('m + sd * theoretical')} AS line
FROM (SELECT m, sd, unnest(q) AS sample, unnest({_QQ_PROBS}) AS p,
             unnest({[NormalDist().inv_cdf(p) for p in _QQ_PROBS]}) AS theoretical FROM s) x""")
def q_qq(spark, sf_dir):
    return stable_doubles(ST.qq_points(_train(spark, sf_dir), "wait_time", n_points=100))


def _uni_sql(y: str, x: str) -> str:
    inner = f"""SELECT regr_slope({y}, {x}) AS b, regr_intercept({y}, {x}) AS a, regr_count({y}, {x}) AS n,
        regr_sxx({y}, {x}) AS sxx, regr_syy({y}, {x}) AS syy, regr_sxy({y}, {x}) AS sxy,
        regr_avgx({y}, {x}) AS mx, regr_r2({y}, {x}) AS r2 FROM {TRAIN} t"""
    s2 = "((syy - b * sxy) / (n - 2))"
    return f"""
SELECT 'Intercept' AS variable, {r6('a')} AS coef, {r6(f'sqrt({s2} * (1.0 / n + mx * mx / sxx))')} AS std_err,
       {r6(f'a / sqrt({s2} * (1.0 / n + mx * mx / sxx))')} AS t, {r6('r2')} AS r2, n FROM ({inner}) u
UNION ALL
SELECT '{x}', {r6('b')}, {r6(f'sqrt({s2} / sxx)')}, {r6(f'b / sqrt({s2} / sxx)')}, {r6('r2')}, n FROM ({inner}) u"""


def _uni(spark, sf_dir, y, x):
    d = _train(spark, sf_dir)
    coefs, stats = MD.ols(d, y, [x])
    fit = stats.first()
    return stable_doubles(coefs.select("variable", "coef", "std_err", "t", F.lit(fit.r2).alias("r2"), F.lit(fit.n).alias("n")))


@register("ols_review_on_wait", _uni_sql("review_score", "wait_time"))
def q_ols_wait(spark, sf_dir):
    return _uni(spark, sf_dir, "review_score", "wait_time")


@register("ols_review_on_delay", _uni_sql("review_score", "delay_vs_expected"))
def q_ols_delay(spark, sf_dir):
    return _uni(spark, sf_dir, "review_score", "delay_vs_expected")


def _coef_sql(ctes, name, xs, where="", columns=None):
    full = (f"SELECT variable, {r6('coef')} AS coef, {r6('std_err')} AS std_err, {r6('t')} AS t, {r6('p_value')} AS p_value, "
            f"{r6('coef - ' + SQL.t_quantile(SQL.Z975, 'df') + ' * std_err')} AS ci_low, "
            f"{r6('coef + ' + SQL.t_quantile(SQL.Z975, 'df') + ' * std_err')} AS ci_high "
            f"FROM ({SQL.t_tail(SQL.ols_rows(name, xs))}) r")
    return SQL.with_ctes(ctes, f"SELECT {columns or '*'} FROM ({full}) x {where}")


def _fit_sql(ctes, name, k):
    r2 = "(1 - rss / tss)"
    ll = "(-n / 2 * (ln(2 * pi()) + ln(rss / n) + 1))"
    f = f"(({r2} / {k}) / ((1 - {r2}) / df))"
    return SQL.with_ctes(ctes, f"""SELECT CAST(n AS BIGINT) AS n, CAST({k} AS BIGINT) AS k, {r6(r2)} AS r2,
    {r6(f'1 - (1 - {r2}) * (n - 1) / df')} AS adj_r2, {r6(f)} AS f_stat, {r6(SQL.f_tail(f, f'{k}.0{D}', 'df'))} AS f_pvalue,
    {r6(ll)} AS log_likelihood, {r6(f'-2 * {ll} + 2 * {k + 1}')} AS aic, {r6(f'-2 * {ll} + {k + 1} * ln(n)')} AS bic,
    {r6('sqrt(rss / n)')} AS rmse FROM {name}""")


_MULTI = ["wait_time", "delay_vs_expected"]


@register("ols_review_multivariate", _coef_sql(SQL.ols_ctes("m", TRAIN[1:-1], "review_score", _MULTI), "m", _MULTI))
def q_ols_multi(spark, sf_dir):
    coefs, _ = MD.ols(_train(spark, sf_dir), "review_score", _MULTI)
    return stable_doubles(coefs)


def _model4(spark, sf_dir):
    """The report's model: target and regressors standardized (ddof 0)."""
    d = ST.zscore(_train(spark, sf_dir), ["review_score", *MODEL4], ddof=0)
    return MD.ols(d, "review_score", MODEL4)


_M4 = SQL.ols_ctes("m", SQL.zscored(TRAIN[1:-1], ["review_score", *MODEL4], ddof=0), "review_score", MODEL4)


@register("ols_review_standardized_fit", _fit_sql(_M4, "m", len(MODEL4)))
def q_ols_model4(spark, sf_dir):
    return stable_doubles(_model4(spark, sf_dir)[1])


@register("significant_coefs", _coef_sql(_M4, "m", MODEL4, "WHERE p_value < 0.05 AND variable <> 'Intercept'",
                                         "variable, p_value, coef"))
def q_significant(spark, sf_dir):
    return stable_doubles(MD.significant_coefs(_model4(spark, sf_dir)[0]))


_DETAILS_SOURCE = details_raw_sql()
_MD = SQL.ols_ctes("m", SQL.zscored(_DETAILS_SOURCE, DETAILS, ["wait_time"]), "wait_time", DETAILS)


def _details_model(spark, sf_dir):
    """Delivery time on nine standardized order and product details."""
    d = O.details_training(driver_catalog(spark, sf_dir))
    return MD.ols(ST.zscore(d, DETAILS, ddof=1), "wait_time", DETAILS)


@register("ols_wait_details", _coef_sql(_MD, "m", DETAILS))
def q_ols_details(spark, sf_dir):
    return stable_doubles(_details_model(spark, sf_dir)[0])


@register("ols_wait_details_fit", _fit_sql(_MD, "m", len(DETAILS)))
def q_ols_details_fit(spark, sf_dir):
    return stable_doubles(_details_model(spark, sf_dir)[1])


def _logit_source(y):
    return SQL.zscored(TRAIN[1:-1], LOGIT_FEATURES, [y])


def _logit_rows(name):
    return " UNION ALL ".join(f"SELECT '{v}' AS variable, b{i} AS coef, sqrt(v{i}) AS std_err, b{i} / sqrt(v{i}) AS t FROM {name}"
                              for i, v in enumerate(["Intercept", *LOGIT_FEATURES]))


def _logit_sql(y):
    z = repr(SQL.Z975)
    return SQL.with_ctes(SQL.logit_ctes("g", _logit_source(y), y, LOGIT_FEATURES), f"""
SELECT variable, {r6('coef')} AS coef, {r6('std_err')} AS std_err, {r6('t')} AS t, {r6(SQL.normal_tail('t'))} AS p_value,
       {r6(f'coef - {z} * std_err')} AS ci_low, {r6(f'coef + {z} * std_err')} AS ci_high, true AS converged
FROM ({_logit_rows('g')}) r""")


def _logit(spark, sf_dir, y):
    return MD.logit(ST.zscore(_train(spark, sf_dir).select(y, *LOGIT_FEATURES), LOGIT_FEATURES, ddof=1), y, LOGIT_FEATURES)


@register("logit_one_star", _logit_sql("dim_is_one_star"))
def q_logit_one(spark, sf_dir):
    return stable_doubles(_logit(spark, sf_dir, "dim_is_one_star")[0])


@register("logit_five_star", _logit_sql("dim_is_five_star"))
def q_logit_five(spark, sf_dir):
    return stable_doubles(_logit(spark, sf_dir, "dim_is_five_star")[0])


_NULL_DEV = "(-2 * (pos * ln(pos / n) + (n - pos) * ln(1 - pos / n)))"


@register("logit_one_star_fit", SQL.with_ctes(
    SQL.logit_ctes("g", _logit_source("dim_is_one_star"), "dim_is_one_star", LOGIT_FEATURES), f"""
SELECT CAST(n AS BIGINT) AS n, CAST({len(LOGIT_FEATURES)} AS BIGINT) AS k, {r6(f'1 - deviance / {_NULL_DEV}')} AS pseudo_r2,
       {r6('deviance')} AS deviance, {r6(_NULL_DEV)} AS null_deviance, {r6(f'deviance + {2 * (len(LOGIT_FEATURES) + 1)}')} AS aic,
       true AS converged FROM g"""))
def q_logit_fit(spark, sf_dir):
    return stable_doubles(_logit(spark, sf_dir, "dim_is_one_star")[1].drop("iterations"))


@register("coef_compare_linear_logit", SQL.with_ctes(
    SQL.ols_ctes("m", SQL.zscored(TRAIN[1:-1], LOGIT_FEATURES, ["review_score"]), "review_score", LOGIT_FEATURES)
    + SQL.logit_ctes("g", _logit_source("dim_is_five_star"), "dim_is_five_star", LOGIT_FEATURES),
    " UNION ALL ".join(f"SELECT '{v}' AS variable, {r6(f'm.b{i}')} AS linear_coef, {r6(f'g.b{i}')} AS logit_coef FROM m, g"
                       for i, v in enumerate(LOGIT_FEATURES, 1))))
def q_coef_compare(spark, sf_dir):
    rows = cut_lineage(_train(spark, sf_dir).select("review_score", "dim_is_five_star", *LOGIT_FEATURES))
    d = ST.zscore(rows, LOGIT_FEATURES, ddof=1)
    lin, _ = MD.ols(d, "review_score", LOGIT_FEATURES)
    lg, _ = MD.logit(d, "dim_is_five_star", LOGIT_FEATURES)
    return stable_doubles(MD.coef_compare(lin, lg))


@register("vif_training", SQL.with_ctes(
    SQL.ols_ctes("m", SQL.zscored(TRAIN[1:-1], LOGIT_FEATURES, ["0 AS zero"]), "zero", LOGIT_FEATURES),
    " UNION ALL ".join(f"SELECT '{v}' AS variable, {r6(f'm.v{i} * m_m.{SQL.entry(i, i)}')} AS vif FROM m, m_m"
                       for i, v in enumerate(LOGIT_FEATURES, 1))))
def q_vif(spark, sf_dir):
    d = ST.zscore(_train(spark, sf_dir), LOGIT_FEATURES, ddof=1)
    return stable_doubles(MD.vif(d, LOGIT_FEATURES))


_ETA = SQL.ols_ctes("m", TRAIN[1:-1], "wait_time", ETA_FEATURES, ["order_id", "expected_wait_time"])


def _fitted(name, xs):
    return " + ".join([f"{name}.b0"] + [f"{name}.b{i} * x{i}" for i in range(1, len(xs) + 1)])


def _eta_rows(spark, sf_dir):
    return cut_lineage(_train(spark, sf_dir).select("order_id", "wait_time", "expected_wait_time", *ETA_FEATURES))


@register("eta_comparison", SQL.with_ctes(_ETA, f"""
SELECT {r6('(SELECT sqrt(avg(pow(expected_wait_time - y, 2))) FROM m_d)')} AS eta_rmse, {r6('sqrt(rss / n)')} AS model_rmse FROM m"""))
def q_eta(spark, sf_dir):
    """RMSE of the platform's ETA (expected - actual wait) vs an OLS model of wait_time."""
    d = _eta_rows(spark, sf_dir)
    p = MD.with_prediction(d, "wait_time", ETA_FEATURES)
    err = F.col("expected_wait_time") - F.col("wait_time")
    return stable_doubles(p.agg(F.sqrt(F.avg(err * err)).alias("eta_rmse"),
                                F.sqrt(F.avg(F.col("residual") * F.col("residual"))).alias("model_rmse")))


@register("rmse_eta_model", SQL.with_ctes(_ETA, f"SELECT {r6('sqrt(rss / n)')} AS rmse FROM m"))
def q_rmse(spark, sf_dir):
    return stable_doubles(MD.rmse(MD.with_prediction(_eta_rows(spark, sf_dir), "wait_time", ETA_FEATURES)))


def _partial_sql(y, xs, focus, variable=False):
    others = [x for x in xs if x != focus]
    cols = [y, *xs]
    base = f"SELECT row_number() OVER () AS rid, {', '.join(cols)} FROM ({TRAIN[1:-1]}) t0"
    ctes = [f"rows_{focus} AS MATERIALIZED ({base})"]
    ctes += SQL.ols_ctes(f"py_{focus}", f"SELECT * FROM rows_{focus}", y, others, ["rid"])
    ctes += SQL.ols_ctes(f"px_{focus}", f"SELECT * FROM rows_{focus}", focus, others, ["rid"])
    tag = f"'{focus}' AS variable, " if variable else ""
    fit = [" + ".join([f"{m}.b0"] + [f"{m}.b{i} * d.x{i}" for i in range(1, len(others) + 1)]) for m in (f"py_{focus}", f"px_{focus}")]
    body = f"""SELECT {tag}{r6(f'e.y - ({fit[1]})')} AS res_x, {r6(f'd.y - ({fit[0]})')} AS res_y
FROM py_{focus}_d d JOIN px_{focus}_d e USING (rid), py_{focus}, px_{focus}"""
    return ctes, body


@register("partial_regression_delay", SQL.with_ctes(*_partial_sql("review_score", MODEL4, "delay_vs_expected")))
def q_partial(spark, sf_dir):
    return stable_doubles(MD.partial_regression(_train(spark, sf_dir), "review_score", MODEL4, "delay_vs_expected"))


_GRID = [_partial_sql("wait_time", ETA_FEATURES, x, True) for x in ETA_FEATURES]


@register("partial_regressions_wait", SQL.with_ctes([c for ctes, _ in _GRID for c in ctes],
                                                    " UNION ALL ".join(body for _, body in _GRID)))
def q_partial_grid(spark, sf_dir):
    return stable_doubles(MD.partial_regressions(_train(spark, sf_dir), "wait_time", ETA_FEATURES))


_RESIDUALS = f"SELECT {_fitted('m', ETA_FEATURES)} AS fitted, {_fitted('m', ETA_FEATURES)} - y AS residual FROM m_d, m"


@register("residual_vs_fitted", SQL.with_ctes(_ETA + [f"p AS MATERIALIZED ({_RESIDUALS})", """
e AS (SELECT min(fitted) AS f0, (max(fitted) - min(fitted)) / 50 AS fw, min(residual) AS r0,
             (max(residual) - min(residual)) / 50 AS rw FROM p)"""], f"""
SELECT CAST(least(floor((fitted - f0) / fw), 49) AS INTEGER) AS fitted_bin,
       CAST(least(floor((residual - r0) / rw), 49) AS INTEGER) AS residual_bin, count(*) AS count,
       {r6('avg(fitted)')} AS fitted_mean, {r6('avg(residual)')} AS residual_mean FROM p, e GROUP BY 1, 2"""))
def q_resid_fitted(spark, sf_dir):
    return stable_doubles(MD.residual_vs_fitted(_train(spark, sf_dir), "wait_time", ETA_FEATURES))


def _residuals(spark, sf_dir):
    d = _eta_rows(spark, sf_dir).drop("expected_wait_time")
    return cut_lineage(MD.with_prediction(d, "wait_time", ETA_FEATURES).select("residual"))


@register("qq_residuals", SQL.with_ctes(_ETA + [f"p AS MATERIALIZED ({_RESIDUALS})", f"""
s AS (SELECT avg(residual) AS m, stddev_samp(residual) AS sd, quantile_cont(residual, {_QQ_PROBS}) AS q FROM p)"""], f"""
SELECT {r6('p')} AS p, {r6('theoretical')} AS theoretical, {r6('sample')} AS sample, {r6('m + sd * theoretical')} AS line
FROM (SELECT m, sd, unnest(q) AS sample, unnest({_QQ_PROBS}) AS p,
             unnest({[NormalDist().inv_cdf(p) for p in _QQ_PROBS]}) AS theoretical FROM s) x"""))
def q_qq_residuals(spark, sf_dir):
    return stable_doubles(ST.qq_points(_residuals(spark, sf_dir), "residual", n_points=100))


@register("density_residuals", SQL.with_ctes(_ETA + [f"p AS MATERIALIZED ({_RESIDUALS})"],
                                             _density_sql("SELECT * FROM p", "residual", None).replace("\nWITH st AS", "SELECT * FROM (WITH st AS", 1) + ") z"))
def q_density_residuals(spark, sf_dir):
    return stable_doubles(ST.density(_residuals(spark, sf_dir), "residual"))


def _line_sql(x, y, z):
    t = SQL.t_quantile(z, "(n - 2)")
    half = f"({t} * sqrt(greatest(syy - b * sxy, 0) / (n - 2)) * sqrt(1.0{D} / n + pow(x - mx, 2) / sxx))"
    return f"""SELECT {r6('x')} AS x, {r6('a + b * x')} AS fit, {r6(f'a + b * x - {half}')} AS ci_low, {r6(f'a + b * x + {half}')} AS ci_high
FROM (SELECT *, lo + i * ((hi - lo) / 99) AS x FROM (
  SELECT regr_slope({y}, {x}) AS b, regr_intercept({y}, {x}) AS a, regr_count({y}, {x}){D} AS n, regr_sxx({y}, {x}) AS sxx,
         regr_syy({y}, {x}) AS syy, regr_sxy({y}, {x}) AS sxy, regr_avgx({y}, {x}) AS mx, min({x}) AS lo, max({x}) AS hi
  FROM {TRAIN} t) u, range(100) g(i)) v"""


@register("regplot_review_wait", _line_sql("wait_time", "review_score", SQL.Z975))
def q_regplot(spark, sf_dir):
    return stable_doubles(MD.regplot_line(_train(spark, sf_dir), "wait_time", "review_score"))


@register("regplot_review_delay_99", _line_sql("delay_vs_expected", "review_score", SQL.Z995))
def q_regplot_delay(spark, sf_dir):
    return stable_doubles(MD.regplot_line(_train(spark, sf_dir), "delay_vs_expected", "review_score", level=0.99))


@register("design_matrix_eta", "SELECT 1.0::DOUBLE AS constant, " + ", ".join(
    f"{r6(f'{c}{D}')} AS {c}" for c in ETA_FEATURES) + f" FROM {TRAIN} t")
def q_design(spark, sf_dir):
    return stable_doubles(MD.design_matrix(_train(spark, sf_dir), ETA_FEATURES))


_SAMPLE_KEY = ["order_id", "review_score", "dim_is_one_star"]
_SAMPLED = ", ".join(r6(c) + f" AS {c}" if c in ("wait_time", "expected_wait_time", "delay_vs_expected", "price",
                                                 "freight_value", "distance_seller_customer") else c
                     for c in ["order_id", "order_status", *NUMERIC])


def _hash_order(key):
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in key)
    return f"md5(concat_ws('|', {parts}, '42')), {', '.join(key)}"


@register("sample_training_rows", f"""
SELECT {_SAMPLED} FROM (SELECT * FROM {TRAIN} t ORDER BY {_hash_order(_SAMPLE_KEY)} LIMIT 1000) s""")
def q_sample(spark, sf_dir):
    # an order with two reviews has two rows; rows with equal keys are equal in every column
    return stable_doubles(ST.sample_rows(_train(spark, sf_dir), 1000, _SAMPLE_KEY, seed=42))


@register("sample_low_reviews", f"""
SELECT review_comment_message FROM ol_order_reviews
WHERE review_id IS NOT NULL AND order_id IS NOT NULL AND review_comment_title IS NOT NULL
  AND review_comment_message IS NOT NULL AND review_creation_date IS NOT NULL AND review_answer_timestamp IS NOT NULL
  AND review_score = 1 ORDER BY {_hash_order(['review_id'])} LIMIT 20""")
def q_sample_low(spark, sf_dir):
    r = driver_catalog(spark, sf_dir)["order_reviews"].na.drop("any")
    return ST.sample_rows(r.filter(F.col("review_score") == 1), 20, ["review_id"], seed=42).select("review_comment_message")


# -- seller what-if --------------------------------------------------------------

WHATIF_SQL = f"""
WITH e AS ({ECON_SQL}),
tot AS (SELECT sum(revenues) AS r, sum(costs) AS c, sum(n_orders) AS n FROM e WHERE profits IS NOT NULL),
ranked AS (SELECT seller_id,
             row_number() OVER w AS k,
             sum(revenues) OVER w AS cr, sum(costs) OVER w AS cc, sum(n_orders) OVER w AS cn
           FROM e WHERE profits IS NOT NULL
           WINDOW w AS (ORDER BY profits, seller_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
allk AS (SELECT 0::BIGINT AS k, NULL::BIGINT AS removed_seller_id, r AS revenues, c AS costs, n AS n_orders FROM tot
         UNION ALL
         SELECT k, seller_id, tot.r - cr, tot.c - cc, tot.n - cn FROM ranked, tot)
SELECT k, removed_seller_id, revenues, costs, revenues - costs AS gross_profit, CAST(n_orders AS BIGINT) AS n_orders,
       500000.0{D} / sqrt((SELECT n FROM tot){D}) * sqrt(n_orders{D}) AS it_cost,
       revenues - costs - 500000.0{D} / sqrt((SELECT n FROM tot){D}) * sqrt(n_orders{D}) AS net_profit
FROM allk"""


def _whatif(spark, sf_dir):
    return W.seller_removal_whatif(_econ(spark, sf_dir))


@register("seller_removal_whatif", f"""SELECT k, removed_seller_id, {r6('revenues')} AS revenues, {r6('costs')} AS costs,
    {r6('gross_profit')} AS gross_profit, n_orders, {r6('it_cost')} AS it_cost, {r6('net_profit')} AS net_profit
    FROM ({WHATIF_SQL}) w""")
def q_whatif(spark, sf_dir):
    return stable_doubles(_whatif(spark, sf_dir))


@register("whatif_best", f"""SELECT k, {r6('net_profit')} AS net_profit, {r6('revenues')} AS revenues, {r6('costs')} AS costs,
    n_orders, {r6('it_cost')} AS it_cost FROM ({WHATIF_SQL}) w ORDER BY net_profit DESC, k LIMIT 1""")
def q_whatif_best(spark, sf_dir):
    return stable_doubles(W.whatif_best(_whatif(spark, sf_dir)))


@register("whatif_rule", f"""
WITH e AS ({ECON_SQL})
SELECT count(*) AS n_sellers, {r6('sum(revenues)')} AS revenues, {r6('sum(costs)')} AS costs,
       {r6('sum(profits)')} AS profits, CAST(sum(n_orders) AS BIGINT) AS n_orders,
       {r6(f'500000.0{D} / sqrt((SELECT sum(n_orders) FROM e){D}) * sqrt(sum(n_orders){D})')} AS it_cost,
       {r6(f'sum(profits) - 500000.0{D} / sqrt((SELECT sum(n_orders) FROM e){D}) * sqrt(sum(n_orders){D})')} AS net_profit
FROM e WHERE profits > 0 OR (profits > -700 AND revenues > 5000)""")
def q_whatif_rule(spark, sf_dir):
    return stable_doubles(W.whatif_rule(_econ(spark, sf_dir)))


_ECON_R = (f"seller_id, n_orders, {r6('revenues')} AS revenues, {r6('costs')} AS costs, {r6('profits')} AS profits, "
           f"{r6('revenues_per_n_orders')} AS revenues_per_n_orders")


@register("worst_sellers", f"SELECT {_ECON_R} FROM ({ECON_SQL}) e ORDER BY profits, seller_id LIMIT 10")
def q_worst_sellers(spark, sf_dir):
    return stable_doubles(W.sort_by_profit(_econ(spark, sf_dir)).limit(10))


@register("remove_worst_sellers", f"""SELECT {_ECON_R} FROM ({ECON_SQL}) e WHERE seller_id NOT IN (
    SELECT seller_id FROM ({ECON_SQL}) e2 WHERE profits IS NOT NULL ORDER BY profits, seller_id LIMIT 10)""")
def q_remove_worst(spark, sf_dir):
    return stable_doubles(W.remove_worst_sellers(_econ(spark, sf_dir), 10))


@register("filter_profit_band", f"SELECT {_ECON_R} FROM ({ECON_SQL}) e WHERE profits > -200 AND profits < 200")
def q_profit_band(spark, sf_dir):
    return stable_doubles(W.filter_profit_band(_econ(spark, sf_dir), -200, 200))


@register("ols_predictions_eta", SQL.with_ctes(_ETA, f"""
SELECT order_id, {r6('y')} AS wait_time, {r6(_fitted('m', ETA_FEATURES))} AS fitted,
       {r6(_fitted('m', ETA_FEATURES) + ' - y')} AS residual FROM m_d, m"""))
def q_ols_predictions(spark, sf_dir):
    """Fitted wait time and residual (fitted - actual) per training row."""
    d = _eta_rows(spark, sf_dir)
    return stable_doubles(MD.with_prediction(d, "wait_time", ETA_FEATURES).select("order_id", "wait_time", "fitted", "residual"))


def _pnl_dedup_sql() -> str:
    from .seller_queries import COUNTS_SQL, DATES_SQL, DELAY_SQL, FEATURES_SQL, QUANTITY_SQL, SALES_SQL
    rev = f"(dt.months_on_olist * 80.0{D} + s.sales * 0.1{D})"
    cost = f"((100 * c.count_of_one_star + 50 * c.count_of_two_star + 40 * c.count_of_three_star){D})"
    return f"""SELECT f.seller_id, q.n_orders, {r6(rev)} AS revenues, {r6(cost)} AS costs,
    {r6(f'{rev} - {cost}')} AS profits, {r6(f'{rev} / q.n_orders')} AS revenues_per_n_orders
FROM ({FEATURES_SQL}) f JOIN ({DELAY_SQL}) dw USING (seller_id) JOIN ({DATES_SQL}) dt USING (seller_id)
JOIN ({COUNTS_SQL}) c USING (seller_id) JOIN ({QUANTITY_SQL}) q USING (seller_id) JOIN ({SALES_SQL}) s USING (seller_id)"""


@register("seller_pnl_dedup", _pnl_dedup_sql())
def q_seller_pnl_dedup(spark, sf_dir):
    """Unrounded revenues, de-duplicated review cost (the recap variant)."""
    return stable_doubles(S.seller_economics(driver_catalog(spark, sf_dir), variant="dedup"))

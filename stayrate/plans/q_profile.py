"""Queries: table profiles, distribution summaries and correlations."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayrate.operators import eda
from stayrate.operators import profile as pr
from stayrate.plans.q_eda import ACTIVITY_SQL, activity_df
from stayrate.plans.q_features import features_df
from stayrate.plans.registry import R, finish, register
from stayrate.plans.sqlparts import with_features
from stayrate.sources.fixtures import fixture, oracle_with

A = "DATE '2001-12-31'"
ALL_VIEWS = ("f_customers", "f_transactions", "f_events", "f_tickets", "f_churn_labels", "f_clv_labels")
ROLES = ["customers", "transactions", "events", "support_tickets", "churn_labels", "clv_labels"]
VIEW_OF = dict(zip(ROLES, ALL_VIEWS))


@register("table_shapes", oracle_with(*ALL_VIEWS) + "\nUNION ALL\n".join(
    f"SELECT '{role}' AS table_name, count(*) AS n_rows, "
    f"CAST((SELECT count(*) FROM (DESCRIBE {view})) AS INTEGER) AS n_cols FROM {view}"
    for role, view in VIEW_OF.items()))
def q_table_shapes(spark, sf):
    fx = fixture(spark, sf)
    return pr.table_shapes({r: getattr(fx, r) for r in ROLES})


# Expected Spark type names of the six input views.
SPARK_TYPES = {
    "customers": [("customer_id", "bigint"), ("signup_date", "date"), ("age", "int"), ("gender", "string"),
                  ("country", "string"), ("plan_type", "string"), ("monthly_fee", "double")],
    "transactions": [("customer_id", "bigint"), ("transaction_date", "date"), ("amount", "double"),
                     ("payment_method", "string"), ("is_refund", "boolean")],
    "events": [("customer_id", "bigint"), ("event_date", "date"), ("event_type", "string"),
               ("event_value", "double")],
    "support_tickets": [("ticket_id", "string"), ("customer_id", "bigint"), ("ticket_date", "date"),
                        ("ticket_category", "string"), ("resolution_time_hrs", "double"),
                        ("satisfaction_score", "int")],
    "churn_labels": [("customer_id", "bigint"), ("churn_30d", "int")],
    "clv_labels": [("customer_id", "bigint"), ("clv", "double")],
}


@register("column_profile", oracle_with(*ALL_VIEWS) + "\nUNION ALL\n".join(
    f"SELECT '{role}' AS table_name, '{c}' AS column_name, '{t}' AS data_type, "
    f"count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM {VIEW_OF[role]}"
    for role, cols in SPARK_TYPES.items() for c, t in cols))
def q_column_profile(spark, sf):
    fx = fixture(spark, sf)
    out = None
    for r in ROLES:
        p = pr.column_profile(getattr(fx, r), r)
        out = p if out is None else out.unionByName(p)
    return out


@register("head_rows", oracle_with("f_customers") + f"""
SELECT customer_id, signup_date, age, gender, country, plan_type, {R("monthly_fee")} AS monthly_fee
FROM f_customers ORDER BY customer_id LIMIT 3""")
def q_head_rows(spark, sf):
    """First three customers (the notebook's head(3)), a top-n limit."""
    return finish(pr.head_rows(fixture(spark, sf).customers, 3, ["customer_id"]))


def _describe_sql(view: str, col: str) -> str:
    return oracle_with(view) + f"""
SELECT count({col}) AS count, {R(f"avg({col})")} AS mean, {R(f"stddev_samp({col})")} AS std,
  {R(f"min({col})")} AS min, {R(f"quantile_cont({col}, 0.25)")} AS q25,
  {R(f"quantile_cont({col}, 0.5)")} AS q50, {R(f"quantile_cont({col}, 0.75)")} AS q75,
  {R(f"max({col})")} AS max FROM {view}"""


@register("describe_age", _describe_sql("f_customers", "age"))
def q_describe_age(spark, sf):
    return finish(pr.describe(fixture(spark, sf).customers, "age"))


@register("describe_clv", _describe_sql("f_clv_labels", "clv"))
def q_describe_clv(spark, sf):
    return finish(pr.describe(fixture(spark, sf).clv_labels, "clv"))


@register("fee_summary", oracle_with("f_customers", "f_clv_labels") + f"""
SELECT {R("CAST(sum(CAST(monthly_fee AS DECIMAL(18,4))) AS DOUBLE) / count(monthly_fee)")} AS fee_mean, {R("quantile_cont(monthly_fee, 0.5)")} AS fee_median,
  {R("stddev_samp(monthly_fee)")} AS fee_std,
  {R("(SELECT min(clv) FROM f_clv_labels)")} AS clv_min,
  {R("(SELECT max(clv) FROM f_clv_labels)")} AS clv_max,
  {R("(SELECT avg(clv) FROM f_clv_labels)")} AS clv_mean FROM f_customers""")
def q_fee_summary(spark, sf):
    fx = fixture(spark, sf)
    return finish(pr.fee_summary(fx.customers, fx.clv_labels))


def _hist_sql(views: tuple[str, ...], source: str, expr: str, n: int) -> str:
    """Counts by a range join on the bin edges (the last bin holds its upper edge)."""
    return oracle_with(*views) + f""",
hx AS (SELECT CAST({expr} AS DOUBLE) AS x FROM {source} WHERE {expr} IS NOT NULL),
hs AS (SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
              CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM hx),
hb AS (SELECT CAST(range AS INTEGER) AS bin, lo + range * ((hi - lo) / {n}) AS lower,
              CASE WHEN range = {n} - 1 THEN hi ELSE lo + (range + 1) * ((hi - lo) / {n}) END AS upper
       FROM range({n}), hs)
SELECT bin, {R("lower")} AS lower, {R("upper")} AS upper, count(x) AS count
FROM hb LEFT JOIN hx ON x >= lower AND (x < upper OR (bin = {n} - 1 AND x = upper))
GROUP BY bin, lower, upper"""


HISTOGRAMS = [
    # name, role, view, column, SQL expression, bins
    ("age", "customers", ("f_customers",), "f_customers", "age", "age", 30),
    ("monthly_fee", "customers", ("f_customers",), "f_customers", "monthly_fee", "monthly_fee", 30),
    ("signup_date", "customers", ("f_customers",), "f_customers", "signup_date",
     "(signup_date - DATE '1970-01-01')", 50),
    ("clv", "clv_labels", ("f_clv_labels",), "f_clv_labels", "clv", "clv", 50),
    ("event_value", "events", ("f_events",), "f_events", "event_value", "event_value", 50),
    ("resolution_time", "support_tickets", ("f_tickets",), "f_tickets", "resolution_time_hrs",
     "resolution_time_hrs", 40),
]

for _name, _role, _views, _src, _col, _expr, _n in HISTOGRAMS:
    def _mk(role, col, n):
        def q(spark, sf):
            return finish(pr.histogram(getattr(fixture(spark, sf), role), col, n))
        q.__doc__ = f"{n}-bin histogram of {col}"
        return q
    register(f"histogram_{_name}", _hist_sql(_views, _src, _expr, _n))(_mk(_role, _col, _n))


@register("histogram_amount", _hist_sql(("f_transactions",), "(SELECT * FROM f_transactions WHERE NOT is_refund)",
                                        "amount", 50))
def q_histogram_amount(spark, sf):
    """50-bin histogram of positive transaction amounts."""
    t = fixture(spark, sf).transactions.where(~F.col("is_refund"))
    return finish(pr.histogram(t, "amount", 50))


def _box_sql(views, source: str, col: str, by: str | None) -> str:
    g = f"{by}, " if by else ""
    grp = f"GROUP BY {by}" if by else ""
    on = f"d.{by} = q.{by}" if by else "TRUE"
    gsel = f"q.{by}, " if by else ""
    return oracle_with(*views) + f""",
bd AS (SELECT {g}CAST({col} AS DOUBLE) AS x FROM {source} WHERE {col} IS NOT NULL),
bq AS (SELECT {g}quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
         quantile_cont(x, 0.75) AS q3 FROM bd {grp}),
bf AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo_f, q3 + 1.5 * (q3 - q1) AS hi_f FROM bq)
SELECT {gsel}count(*) AS n, {R("q.q1")} AS q1, {R("q.median")} AS median, {R("q.q3")} AS q3,
  {R("q.iqr")} AS iqr,
  {R("min(d.x) FILTER (WHERE d.x >= q.lo_f AND d.x <= q.hi_f)")} AS whisker_low,
  {R("max(d.x) FILTER (WHERE d.x >= q.lo_f AND d.x <= q.hi_f)")} AS whisker_high,
  count(*) FILTER (WHERE NOT (d.x >= q.lo_f AND d.x <= q.hi_f)) AS n_outliers
FROM bd d JOIN bf q ON {on}
GROUP BY {gsel}q.q1, q.median, q.q3, q.iqr"""


@register("boxplot_clv", _box_sql(("f_clv_labels",), "f_clv_labels", "clv", None))
def q_boxplot_clv(spark, sf):
    return finish(pr.boxplot_stats(fixture(spark, sf).clv_labels, "clv"))


@register("boxplot_amount_by_payment", _box_sql(("f_transactions",), "f_transactions", "amount",
                                                "payment_method"))
def q_boxplot_amount_by_payment(spark, sf):
    return finish(pr.boxplot_stats(fixture(spark, sf).transactions, "amount", ["payment_method"]))


RA_CORR_COLS = ["age", "tenure_days", "monthly_fee", "frequency", "monetary", "refund_count",
                "total_events", "total_tickets", "avg_resolution_time", "avg_satisfaction",
                "recency_days", "clv", "churn_30d"]
NB_CORR_COLS = ["age", "tenure_days", "monthly_fee", "txn_count", "txn_total", "txn_avg",
                "refund_count", "event_count", "event_value_total", "ticket_count",
                "avg_resolution_time", "avg_satisfaction", "clv", "churn_30d"]


def _corr_sql(cols, table: str) -> str:
    aggs = []
    rows = []
    for i, a in enumerate(cols):
        aggs.append(f"var_pop(CAST({a} AS DOUBLE)) AS v{i}")
        for j in range(i):
            aggs.append(f"covar_pop(CAST({a} AS DOUBLE), CAST({cols[j]} AS DOUBLE)) AS c{i}_{j}")
    for i, a in enumerate(cols):
        for j in range(i + 1):
            if i == j:
                r = f"CASE WHEN v{i} > 0 THEN 1.0 END"
            else:
                r = f"CASE WHEN sqrt(v{i} * v{j}) > 0 THEN c{i}_{j} / sqrt(v{i} * v{j}) END"
            rows.append(f"SELECT '{a}' AS var1, '{cols[j]}' AS var2, {R(r)} AS corr FROM cw")
    return f""",
cw AS (SELECT {", ".join(aggs)} FROM {table})
""" + "\nUNION ALL\n".join(rows)


@register("correlation_matrix", with_features("f_clv_labels", "f_churn_labels") + f""",
cm AS (SELECT f.*, l.clv, h.churn_30d FROM feat f
       JOIN f_clv_labels l ON f.customer_id = l.customer_id
       JOIN f_churn_labels h ON f.customer_id = h.customer_id)""" + _corr_sql(RA_CORR_COLS, "cm"))
def q_correlation_matrix(spark, sf):
    """Pearson matrix of the 13 key features and both labels (lower triangle)."""
    fx = fixture(spark, sf)
    df = eda.attach_labels(features_df(spark, sf), fx.clv_labels, fx.churn_labels)
    return finish(pr.correlation_matrix(df, RA_CORR_COLS))


@register("correlation_matrix_activity",
          oracle_with("f_customers", "f_transactions", "f_events", "f_tickets", "f_clv_labels",
                      "f_churn_labels") + ACTIVITY_SQL.rstrip() + _corr_sql(NB_CORR_COLS, "act"))
def q_correlation_matrix_activity(spark, sf):
    """The notebook's variant over plain activity totals."""
    return finish(pr.correlation_matrix(activity_df(spark, sf), NB_CORR_COLS))


@register("select_features", with_features("f_clv_labels", "f_churn_labels") + f"""
SELECT f.customer_id, f.age, f.tenure_days, {R("f.monthly_fee")} AS monthly_fee, f.frequency,
  {R("f.monetary")} AS monetary, f.refund_count, f.total_events, f.total_tickets,
  {R("f.avg_resolution_time")} AS avg_resolution_time, {R("f.avg_satisfaction")} AS avg_satisfaction,
  f.recency_days, {R("l.clv")} AS clv, h.churn_30d FROM feat f
JOIN f_clv_labels l ON f.customer_id = l.customer_id
JOIN f_churn_labels h ON f.customer_id = h.customer_id""")
def q_select_features(spark, sf):
    fx = fixture(spark, sf)
    df = eda.attach_labels(features_df(spark, sf), fx.clv_labels, fx.churn_labels)
    return finish(df.select("customer_id", *RA_CORR_COLS))


@register("attach_labels", with_features("f_clv_labels", "f_churn_labels") + f"""
SELECT f.customer_id, {R("f.monetary")} AS monetary, {R("l.clv")} AS clv, h.churn_30d FROM feat f
JOIN f_clv_labels l ON f.customer_id = l.customer_id
JOIN f_churn_labels h ON f.customer_id = h.customer_id""")
def q_attach_labels(spark, sf):
    fx = fixture(spark, sf)
    df = eda.attach_labels(features_df(spark, sf), fx.clv_labels, fx.churn_labels)
    return finish(df.select("customer_id", "monetary", "clv", "churn_30d"))

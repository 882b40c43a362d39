"""Views that give the driver's TPC-H-ish tables the roles of the six inputs.

Each view is written once as SQL text with ``{placeholders}`` for its inputs.
Spark runs the text with DataFrames bound to the placeholders
(``spark.sql(text, name=df)``); the DuckDB oracle inlines the same text as
CTEs.  The columns invented here are test inputs, not operators: they only
give rows of the expected schema and do none of the operators' work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stayrate.sources.tables import read_driver_table

# Fixed values of the fixture (FIXTURES.md §2).
AS_OF = "2001-12-31"
EVENT_SHIFT_DAYS = 8066
TICKET_CATEGORIES = ["billing", "technical", "account", "feature_request", "cancellation"]
BASIC_PLAN = "BUILDING"

VIEW_SQL: dict[str, str] = {
    "f_customers": """
SELECT c.c_custkey AS customer_id,
       DATE '2001-12-31' - CAST(60 + (c.c_custkey * 37) % 1767 AS INT) AS signup_date,
       CAST(18 + (c.c_custkey * 37) % 68 AS INT) AS age,
       CASE CAST(c.c_custkey % 3 AS INT) WHEN 0 THEN 'Male' WHEN 1 THEN 'Female'
            ELSE 'Non-Binary' END AS gender,
       n.n_name AS country,
       c.c_mktsegment AS plan_type,
       abs(c.c_acctbal) / 100 AS monthly_fee
FROM {customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey
""",
    "f_transactions": """
SELECT o.o_custkey AS customer_id,
       CAST(l.l_shipdate AS DATE) AS transaction_date,
       CASE WHEN l.l_returnflag = 'R' THEN -1 ELSE 1 END
           * (l.l_extendedprice * (1 - l.l_discount)) AS amount,
       o.o_orderpriority AS payment_method,
       l.l_returnflag = 'R' AS is_refund
FROM {lineitem} l
JOIN {orders} o ON l.l_orderkey = o.o_orderkey
JOIN {f_customers} c ON o.o_custkey = c.customer_id
WHERE CAST(l.l_shipdate AS DATE) >= c.signup_date
""",
    "f_events": """
SELECT user_id AS customer_id,
       CAST(ts AS DATE) - 8066 AS event_date,
       event_type,
       value AS event_value
FROM {events}
""",
    "f_tickets": """
SELECT concat('T', CAST(e.event_id AS STRING)) AS ticket_id,
       e.user_id AS customer_id,
       e.event_date - 5 * e.k AS ticket_date,
       CASE e.k % 5 WHEN 0 THEN 'billing' WHEN 1 THEN 'technical' WHEN 2 THEN 'account'
            WHEN 3 THEN 'feature_request' ELSE 'cancellation' END AS ticket_category,
       e.value AS resolution_time_hrs,
       CAST(1 + floor(e.k / 20) AS INT) AS satisfaction_score
FROM (SELECT event_id, user_id, value,
             CAST(ts AS DATE) - 8066 AS event_date,
             TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k
      FROM {events} WHERE event_type = 'error') e
JOIN {f_customers} c ON e.user_id = c.customer_id
WHERE e.event_date - 5 * e.k >= c.signup_date
""",
    "f_churn_labels": """
SELECT customer_id,
       CASE WHEN monthly_fee < 45 AND (customer_id * 31) % 100 < 26 THEN 1 ELSE 0 END AS churn_30d
FROM {f_customers}
""",
    "f_clv_labels": """
SELECT c.customer_id,
       CAST(coalesce(t.pos_total, 0) AS DOUBLE) / 100
           * (CAST(90 + c.customer_id % 21 AS DOUBLE) / 100) AS clv
FROM {f_customers} c
LEFT JOIN (SELECT customer_id, sum(CAST(amount AS DECIMAL(18, 4))) AS pos_total
           FROM {f_transactions} WHERE NOT is_refund GROUP BY customer_id) t
  ON c.customer_id = t.customer_id
""",
    "f_scores": """
SELECT customer_id,
       churn_30d AS label,
       CAST((customer_id * 7919) % 1000 AS DOUBLE) / 2000
           + CAST(churn_30d AS DOUBLE) / 2 * (CAST(customer_id % 7 AS DOUBLE) / 6) AS score,
       CASE WHEN CAST((customer_id * 7919) % 1000 AS DOUBLE) / 2000
           + CAST(churn_30d AS DOUBLE) / 2 * (CAST(customer_id % 7 AS DOUBLE) / 6) >= 0.5
            THEN 1 ELSE 0 END AS prediction
FROM {f_churn_labels}
""",
}

#: The joins of a view in the order in which Spark moves the fewest rows, where that is not the text's:
#: an order meets its customer before its lines, so lines are shuffled once.  The rows are the same.
SPARK_JOINS: dict[str, tuple[str, str]] = {
    "f_transactions": ("""FROM {lineitem} l
JOIN {orders} o ON l.l_orderkey = o.o_orderkey
JOIN {f_customers} c ON o.o_custkey = c.customer_id
""", """FROM {lineitem} l
JOIN ({orders} o JOIN {f_customers} c ON o.o_custkey = c.customer_id) ON l.l_orderkey = o.o_orderkey
"""),
}

# Inputs of each view, in dependency order.
VIEW_INPUTS: dict[str, tuple[str, ...]] = {
    "f_customers": ("customer", "nation"),
    "f_transactions": ("lineitem", "orders", "f_customers"),
    "f_events": ("events",),
    "f_tickets": ("events", "f_customers"),
    "f_churn_labels": ("f_customers",),
    "f_clv_labels": ("f_customers", "f_transactions"),
    "f_scores": ("f_churn_labels",),
}

ROLE = {
    "customers": "f_customers",
    "transactions": "f_transactions",
    "events": "f_events",
    "support_tickets": "f_tickets",
    "churn_labels": "f_churn_labels",
    "clv_labels": "f_clv_labels",
    "scores": "f_scores",
}


class Fixture:
    """Lazily built fixture views over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        key = "raw:" + name
        if key not in self._cache:
            self._cache[key] = read_driver_table(self.spark, self.sf_dir, name)
        return self._cache[key]

    def view(self, name: str) -> DataFrame:
        name = ROLE.get(name, name)
        if name not in self._cache:
            args = {}
            for dep in VIEW_INPUTS[name]:
                args[dep] = self.view(dep) if dep in VIEW_SQL else self.raw(dep)
            text, (joins, ordered) = VIEW_SQL[name], SPARK_JOINS.get(name, ("", ""))
            self._cache[name] = self.spark.sql(text.replace(joins, ordered) if joins else text, **args)
        return self._cache[name]

    def tables(self) -> dict[str, DataFrame]:
        return {role: self.view(view) for role, view in ROLE.items() if role != "scores"}

    def __getattr__(self, item: str) -> DataFrame:
        if item in ROLE:
            return self.view(item)
        raise AttributeError(item)


def fixture(spark: SparkSession, sf_dir: str) -> Fixture:
    return Fixture(spark, sf_dir)


def oracle_with(*names: str) -> str:
    """``WITH`` clause that defines the given views (and their inputs) for DuckDB."""
    order: list[str] = []

    def visit(n: str) -> None:
        for dep in VIEW_INPUTS[n]:
            if dep in VIEW_SQL:
                visit(dep)
        if n not in order:
            order.append(n)

    for n in names:
        visit(ROLE.get(n, n))
    parts = []
    for n in order:
        mapping = {dep: dep for dep in VIEW_INPUTS[n]}
        parts.append(f"{n} AS ({VIEW_SQL[n].format(**mapping).strip()})")
    return "WITH " + ",\n".join(parts) + "\n"

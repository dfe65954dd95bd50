"""Data-quality checks: each returns its violating rows, and a report counts them all.

The report scans each table once: row rules, uniqueness, references and sequences of all tables meet in one aggregation.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions.columns import row_count
from bazaarlens.plans.settings import ORDER_STATUSES, PAYMENT_TYPES, REVIEW_SCORES
from bazaarlens.plans.star import Star

c = F.col


KEYS_PER_TASK = 500_000  # rows of a key check that one task counts


def check_unique(df: DataFrame, *cols: str, rows: int | None = None) -> DataFrame:
    """Values that occur more than once; a NULL in the key is ignored.

    With ``rows``, about how many there are, the keys are dealt to as many tasks as that takes, so that what a task holds
    does not grow with the table.
    """
    known = df.filter(reduce(Column.__and__, [c(n).isNotNull() for n in cols]))
    if rows is not None:
        known = known.select(*cols).repartition(max(df.sparkSession.sparkContext.defaultParallelism, rows // KEYS_PER_TASK + 1), *cols)
    return known.groupBy(*cols).agg(row_count().alias("n")).filter(c("n") > 1)


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(c(col).isNull())


def check_accepted(df: DataFrame, col: str, values) -> DataFrame:
    """Rows with a value outside the list; NULL passes."""
    return df.filter(~c(col).isin(*values))


def check_relationship(df: DataFrame, col: str, ref: DataFrame, field: str) -> DataFrame:
    """Rows whose reference has no counterpart; NULL passes."""
    return df.filter(c(col).isNotNull()).join(ref.select(c(field).alias(col)), col, "left_anti")


def check_rule(df: DataFrame, violation: str) -> DataFrame:
    return df.filter(violation)


# --- the business rules --------------------------------------------------------------------------------------------

# violated conditions; a NULL comparison is no violation
item_values_wrong = "price <= 0 or freight_value < 0"
installments_wrong = "payment_installments < 1"
approved_too_early = "approved_at < purchased_at"
delivered_before_carrier = "delivered_to_customer_at < delivered_to_carrier_at"
answered_too_early = "answered_at < created_at"
payment_differs = "has_payment_value_mismatch"
rate_out_of_range = "on_time_delivery_rate < 0 or on_time_delivery_rate > 1"
score_out_of_range = "avg_review_score < 1 or avg_review_score > 5"
no_orders = "total_orders <= 0"
negative_spend = "total_spend < 0"


def incomplete_sequences(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        F.max("payment_sequential").alias("max_sequential"), row_count().alias("payment_rows")
    ).filter(c("max_sequential") != c("payment_rows"))


def several_reviews(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(row_count().alias("review_rows")).filter(c("review_rows") > 1)


def shared_review_ids(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("review_id").agg(F.count_distinct("order_id").alias("orders")).filter(c("orders") > 1)


def unpaid_orders(orders: DataFrame, payments: DataFrame) -> DataFrame:
    return check_relationship(orders, "order_id", payments, "order_id")


def both_summaries(star: Star, violation: str, *cols: str) -> DataFrame:
    """A rule over the customer and the seller summary."""
    customers = star.table("mart_customer_summary").filter(violation).select(
        F.lit("mart_customer_summary").alias("model"), c("customer_id").alias("id"), *cols
    )
    sellers = star.table("mart_seller_performance").filter(violation).select(
        F.lit("mart_seller_performance").alias("model"), c("seller_id").alias("id"), *cols
    )
    return customers.unionByName(sellers)


# --- which check runs on which column ------------------------------------------------------------------------------

NOT_NULL = {
    "stg_orders": "order_id customer_id status purchased_at estimated_delivery_date",
    "stg_customers": "customer_id customer_unique_id zip_code_prefix city state",
    "stg_sellers": "seller_id zip_code_prefix city state",
    "stg_products": "product_id",
    "stg_product_categories": "category_name_portuguese category_name",
    "stg_order_items": "order_id order_item_id product_id seller_id shipping_limit_at price freight_value",
    "stg_order_payments": "order_id payment_sequential payment_type payment_installments payment_value",
    "stg_order_reviews": "review_id order_id score created_at answered_at",
    "stg_geolocation": "zip_code_prefix latitude longitude city state",
    "int_orders": "order_id customer_id status purchased_at estimated_delivery_date",
    "int_order_reviews": "review_id order_id score created_at answered_at is_duplicate_review",
    "int_order_payments": "order_id primary_payment_type payment_types installments total_payment_value "
    "payment_method_count has_not_defined_payment has_incomplete_payment_sequence",
    "int_geolocation_by_zip": "zip_code_prefix city state",
    "dim_geolocation": "zip_code_prefix city state",
    "dim_customers": "customer_id zip_code_prefix",
    "dim_sellers": "seller_id zip_code_prefix",
    "dim_products": "product_id",
    "fct_orders": "order_id customer_id status purchased_at estimated_delivery_date",
    "fct_order_items": "order_id order_item_id product_id seller_id shipping_limit_at price freight_value "
    "total_item_value",
    "mart_customer_summary": "customer_id total_orders total_spend avg_order_value first_order_at last_order_at "
    "is_repeat_customer",
    "mart_seller_performance": "seller_id total_orders total_items_sold total_revenue avg_item_price "
    "total_freight_charged distinct_categories",
}
NOT_NULL = {model: cols.split() for model, cols in NOT_NULL.items()}

UNIQUE = [
    ("stg_orders", "order_id"),
    ("stg_customers", "customer_id"),
    ("stg_sellers", "seller_id"),
    ("stg_products", "product_id"),
    ("stg_product_categories", "category_name_portuguese"),
    ("int_orders", "order_id"),
    ("int_order_reviews", "review_id"),
    ("int_order_payments", "order_id"),
    ("int_geolocation_by_zip", "zip_code_prefix"),
    ("dim_geolocation", "zip_code_prefix"),
    ("dim_customers", "customer_id"),
    ("dim_sellers", "seller_id"),
    ("dim_products", "product_id"),
    ("fct_orders", "order_id"),
    ("mart_customer_summary", "customer_id"),
    ("mart_seller_performance", "seller_id"),
]

COMPOSITE = [
    ("stg_order_items", "order_id", "order_item_id"),
    ("stg_order_payments", "order_id", "payment_sequential"),
]

ACCEPTED = [
    ("stg_orders", "status", ORDER_STATUSES),
    ("stg_order_payments", "payment_type", PAYMENT_TYPES),
    ("stg_order_reviews", "score", REVIEW_SCORES),
    ("int_order_reviews", "score", REVIEW_SCORES),
]

RELATIONSHIPS = [
    ("stg_orders", "customer_id", "stg_customers", "customer_id"),
    ("stg_order_items", "order_id", "stg_orders", "order_id"),
    ("stg_order_items", "product_id", "stg_products", "product_id"),
    ("stg_order_items", "seller_id", "stg_sellers", "seller_id"),
    ("stg_order_payments", "order_id", "stg_orders", "order_id"),
    ("stg_order_reviews", "order_id", "stg_orders", "order_id"),
    ("fct_orders", "customer_id", "dim_customers", "customer_id"),
    ("fct_order_items", "order_id", "fct_orders", "order_id"),
    ("fct_order_items", "product_id", "dim_products", "product_id"),
    ("fct_order_items", "seller_id", "dim_sellers", "seller_id"),
]


@dataclass(frozen=True)
class Rule:
    check: str
    model: str
    column: str
    severity: str
    violation: Column | str


def row_rules() -> list[Rule]:
    return [
        Rule("item_values", "stg_order_items", "price", "error", item_values_wrong),
        Rule("installments", "stg_order_payments", "payment_installments", "warn", installments_wrong),
        Rule("approved", "stg_orders", "approved_at", "error", approved_too_early),
        Rule("delivery_seq", "stg_orders", "delivered_to_customer_at", "warn", delivered_before_carrier),
        Rule("answered", "stg_order_reviews", "answered_at", "error", answered_too_early),
        Rule("pay_match", "int_order_payments", "has_payment_value_mismatch", "warn", payment_differs),
        *[
            Rule(check, model, column, "error", violation)
            for model in ("mart_customer_summary", "mart_seller_performance")
            for check, column, violation in (
                ("rate_range", "on_time_delivery_rate", rate_out_of_range),
                ("score_range", "avg_review_score", score_out_of_range),
                ("orders_pos", "total_orders", no_orders),
            )
        ],
        Rule("spend", "mart_customer_summary", "total_spend", "error", negative_spend),
    ]


# --- all of them in one pass ---------------------------------------------------------------------------------------


def all_row_rules(model: str) -> list[Rule]:
    """Rules that a row of the table breaks or keeps by itself."""
    rules = [Rule("not_null", model, n, "error", c(n).isNull()) for n in NOT_NULL.get(model, [])]
    rules += [Rule("accepted_values", m, n, "error", ~c(n).isin(*values)) for m, n, values in ACCEPTED if m == model]
    return rules + [r for r in row_rules() if r.model == model]


@dataclass(frozen=True)
class Place:
    """A key of a table: ``domain`` names all columns that are compared with each other, ``slot`` this one of them."""

    model: str
    columns: tuple[str, ...]
    domain: int
    slot: int


# rules over several rows also look at the largest number of a key's rows, and at how many different values it goes with;
# these values are the keys then, and what they are counted for is their owner
NUMBERED = {("stg_order_payments", "order_id"): "payment_sequential"}
REFERRED = {("stg_order_reviews", "review_id"): "order_id"}


def places() -> dict[tuple[str, ...], Place]:
    """Every key that uniqueness, references and sequences ask for, by (model, columns)."""
    domains: list[list[tuple[str, ...]]] = []
    asked = [[(m, n), (ref, field)] for m, n, ref, field in RELATIONSHIPS]
    asked += [[(m, n)] for m, n in UNIQUE] + [[tuple(key)] for key in COMPOSITE]
    asked += [[("stg_order_payments", "order_id"), ("stg_orders", "order_id")], [("stg_order_reviews", "order_id")], [("stg_order_reviews", "review_id")]]
    for together in asked:
        joined = [d for d in domains if any(k in d for k in together)]
        domains = [d for d in domains if d not in joined]
        domains.append(list(dict.fromkeys(k for d in [*joined, together] for k in d)))
    return {key: Place(key[0], key[1:], i, slot) for i, keys in enumerate(domains) for slot, key in enumerate(sorted(keys))}


def _entries(df: DataFrame, model: str, keys: list[Place], rules: list[tuple[int, Rule]]) -> DataFrame:
    """A row of a table as its keys, and as the rules that it breaks; the table is scanned once for all of them."""
    def entry(domain: int, key: Column, slot: int, number: Column | None = None, owner: Column | None = None) -> Column:
        number = F.lit(None).cast("bigint") if number is None else number.cast("bigint")
        owner = F.lit(None).cast("string") if owner is None else owner.cast("string")
        return F.struct(F.lit(domain).alias("domain"), owner.alias("owner"), key.alias("key"), F.lit(slot).alias("slot"), number.alias("number"))

    cells = []
    for place in keys:
        name = (model, *place.columns)
        if name in REFERRED:
            value = c(REFERRED[name])
            cells.append(F.when(value.isNotNull(), entry(place.domain, value.cast("string"), place.slot, owner=c(*place.columns))))
            continue
        known = reduce(Column.__and__, [c(n).isNotNull() for n in place.columns])
        key = F.when(known, F.concat_ws("\u0000", *[c(n).cast("string") for n in place.columns]))
        cells.append(entry(place.domain, key, place.slot, c(NUMBERED[name]) if name in NUMBERED else None))
    for at, rule in rules:
        broken = F.expr(rule.violation) if isinstance(rule.violation, str) else rule.violation
        cells.append(F.when(broken, entry(-1, F.lit(str(at)), 0)))
    return df.select(F.inline(F.array(*cells))).where(c("domain").isNotNull())


def dq_report(star: Star) -> DataFrame:
    """check, model, column, severity, failing_rows, status for every check. Run it on a star whose marts are
    written, otherwise each branch composes them anew.

    Each table is scanned once. Its rows become their keys and the rules they break; all tables meet in one aggregation
    by key, which counts a key's rows per column. Uniqueness, references and sequences are read off these counts. They
    are numbers only, as a text among the aggregates would have every entry sorted.
    """
    by_key = places()
    models = list(dict.fromkeys([*NOT_NULL, *[k[0] for k in by_key]]))
    rules = list(enumerate(r for m in models for r in all_row_rules(m)))
    parts = [
        _entries(star.table(m), m, [p for p in by_key.values() if p.model == m], [(i, r) for i, r in rules if r.model == m]) for m in models
    ]
    slots = max(p.slot for p in by_key.values()) + 1
    counts = reduce(DataFrame.unionByName, parts).groupBy("domain", "owner", "key").agg(
        *[F.count_if(c("slot") == i).alias(f"_{i}") for i in range(slots)],
        F.max("number").alias("number"),
    )

    def n(*key: str) -> Column:
        return c(f"_{by_key[key].slot}")

    found: dict[int, list[tuple[Rule, Column]]] = {}

    def judged(check: str, key: tuple[str, ...], severity: str, failing: Column, null_key: bool = False) -> None:
        if not null_key:
            failing = F.when(c("key").isNotNull(), failing).otherwise(0)
        found.setdefault(by_key[key].domain, []).append((Rule(check, key[0], "+".join(key[1:]), severity, ""), failing.cast("bigint")))

    one = F.lit(1)
    for m, name in UNIQUE:
        judged("unique", (m, name), "error", F.when(n(m, name) > 1, one).otherwise(0))
    for key in COMPOSITE:
        judged("composite_key", tuple(key), "error", F.when(n(*key) > 1, one).otherwise(0))
    for m, name, ref, field in RELATIONSHIPS:
        judged("relationships", (m, name), "error", F.when(n(ref, field) == 0, n(m, name)).otherwise(0))
    paid, reviewed, review, order = ("stg_order_payments", "order_id"), ("stg_order_reviews", "order_id"), ("stg_order_reviews", "review_id"), ("stg_orders", "order_id")
    judged("pay_seq", paid, "warn", F.when((n(*paid) > 0) & (c("number") != n(*paid)), one).otherwise(0), null_key=True)
    judged("one_review", reviewed, "warn", F.when(n(*reviewed) > 1, one).otherwise(0), null_key=True)
    judged("review_order", review, "warn", one, null_key=True)  # an order of the review; more than one fail
    judged("has_payment", order, "warn", F.when(n(*paid) == 0, n(*order)).otherwise(0))

    # a key's rows become (number of the check, failing rows), for the checks of its domain only
    listed: list[Rule] = [r for _, r in rules]
    named = {"pay_seq": "payment_sequential"}
    cells = F.when(c("domain") == -1, F.array(F.struct(c("key").try_cast("int").alias("at"), c("_0").alias("failing"), c("owner").alias("owner"))))
    for domain, own in found.items():
        structs = []
        for rule, failing in own:
            structs.append(F.struct(F.lit(len(listed)).alias("at"), failing.alias("failing"), c("owner").alias("owner")))
            listed.append(Rule(rule.check, rule.model, named.get(rule.check, rule.column), rule.severity, ""))
        cells = cells.when(c("domain") == domain, F.array(*structs))
    found_rows = counts.select(F.inline(cells)).where("failing > 0")
    per_owner = found_rows.groupBy("at", "owner").agg(F.sum("failing").alias("failing"))
    several = F.when(c("failing") > 1, 1).otherwise(0).cast("bigint")
    of_owners = c("at").isin([i for i, r in enumerate(listed) if r.check == "review_order"])
    sums = per_owner.groupBy("at").agg(F.sum(F.when(of_owners, several).otherwise(c("failing"))).alias("failing"))
    known = star.table(models[0]).sparkSession.createDataFrame(
        [(i, r.check, r.model, r.column, r.severity) for i, r in enumerate(listed)], "at int, check string, model string, column string, severity string"
    )
    report = known.join(sums, "at", "left").select("check", "model", "column", "severity", F.coalesce("failing", F.lit(0)).alias("failing_rows"))
    return report.withColumn("status", F.when(c("failing_rows") == 0, "pass").otherwise(c("severity")))

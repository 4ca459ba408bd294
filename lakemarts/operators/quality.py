"""Data-quality checks, results table, gate and reports.

Each check yields one row: (table_name, check_name, check_type, severity,
allowed_failures, details, total_rows, failed_rows).  ``finish_results``
adds the run columns, the PASS/FAIL status and the failure rate (Q01).

Cost model: checks that need the same key share one grouping.  Every table
that carries a key is reduced to it in one tagged union, so one exchange per
key serves the not-null, uniqueness and business-rule checks of the tables
and the foreign keys between them (see ``KeyFamily``).  Partial aggregation
runs map-side, so a hot key is one row per map task, and no check joins rows.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemarts.functions import Ref, all_not_null, any_null, null_as_false, stack_rows

CRITICAL = "CRITICAL"
WARNING = "WARNING"

RESULT_COLUMNS = (
    "run_id",
    "checked_at",
    "layer",
    "table_name",
    "check_name",
    "check_type",
    "severity",
    "status",
    "total_rows",
    "failed_rows",
    "failure_rate",
    "details",
)


#: The results history as declared: no column may be NULL.  The run's date
#: and id, by which the table is partitioned, stand last.
HISTORY_SCHEMA = T.StructType([
    T.StructField(name, kind, False) for name, kind in (
        ("checked_at", T.TimestampNTZType()), ("layer", T.StringType()), ("table_name", T.StringType()),
        ("check_name", T.StringType()), ("check_type", T.StringType()), ("severity", T.StringType()),
        ("status", T.StringType()), ("total_rows", T.LongType()), ("failed_rows", T.LongType()),
        ("failure_rate", T.DoubleType()), ("details", T.StringType()), ("run_date", T.DateType()),
        ("run_id", T.StringType()),
    )
])


@dataclass(frozen=True)
class Rule:
    name: str
    condition: object  # () -> Column: the *valid* condition; NULL counts as failed
    details: str
    severity: str = CRITICAL


# ---------------------------------------------------------------------------
# The recorded rule set (required columns, business keys,
# foreign keys, business rules, detail texts) of the quality run.
# ---------------------------------------------------------------------------
NOT_NULL_DETAILS = "Required columns must not contain NULL."
UNIQUE_DETAILS = "Business-key columns must be unique."

KEY_RULES = {
    "customers": {"required": ["customer_id", "customer_unique_id"], "unique": ["customer_id"]},
    "orders": {"required": ["order_id", "customer_id"], "unique": ["order_id"]},
    "order_items": {
        "required": ["order_id", "order_item_id", "product_id", "seller_id"],
        "unique": ["order_id", "order_item_id"],
    },
    "payments": {
        "required": ["order_id", "payment_sequential", "payment_value"],
        "unique": ["order_id", "payment_sequential"],
    },
    "reviews": {"required": ["review_id", "order_id", "review_score"], "unique": ["review_id"]},
    "products": {"required": ["product_id"], "unique": ["product_id"]},
    "sellers": {"required": ["seller_id"], "unique": ["seller_id"]},
}

FOREIGN_KEYS = (
    ("orders", "customers", ["customer_id"]),
    ("order_items", "orders", ["order_id"]),
    ("order_items", "products", ["product_id"]),
    ("order_items", "sellers", ["seller_id"]),
    ("payments", "orders", ["order_id"]),
    ("reviews", "orders", ["order_id"]),
)

BUSINESS_RULES = {
    "order_items": [
        Rule(
            "non_negative_item_amounts",
            lambda: (F.col("price") >= 0) & (F.col("freight_value") >= 0) & (F.col("item_total_amount") >= 0),
            "Price, freight, and item total must not be negative.",
        )
    ],
    "payments": [
        Rule(
            "non_negative_payment_value",
            lambda: F.col("payment_value") >= 0,
            "Payment value must not be negative.",
        )
    ],
    "reviews": [
        Rule(
            "valid_review_score",
            lambda: F.col("review_score").between(1, 5),
            "Review score must be between 1 and 5.",
        )
    ],
    "orders": [
        Rule(
            "valid_delivery_sequence",
            lambda: F.col("order_delivered_customer_date").isNull()
            | (F.col("order_delivered_customer_date") >= F.col("order_purchase_timestamp")),
            "Delivery date must not occur before purchase date.",
        )
    ],
}

SOURCE_DUPLICATE_DETAILS = (
    "The source contains repeated review_id values. Silver currently retains one record per review_id."
)


# ------------------------------------------------------------------ checks


CHECK_FIELDS = ["table_name", "check_name", "check_type", "severity", "allowed_failures", "details",
                "total_rows", "failed_rows"]
CHECK_CASTS = {"allowed_failures": "BIGINT", "total_rows": "BIGINT", "failed_rows": "BIGINT"}


def _row(table: str, name: str, ctype: str, severity: str, details: str, total: str, failed: str,
         allowed: str | int = 0) -> tuple:
    """One check row: metadata literals plus the aggregate columns holding
    its total and failed counts (and allowed failures, if not 0)."""
    return (table, name, ctype, severity, Ref(allowed) if isinstance(allowed, str) else allowed, details,
            Ref(total), Ref(failed))


def _rows(one_row: DataFrame, rows: list[tuple]) -> DataFrame:
    counts = [c for c in one_row.columns]
    filled = one_row.select(*[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in counts])
    return stack_rows(filled, rows, CHECK_FIELDS, CHECK_CASTS)


def table_checks(
    df: DataFrame,
    table: str,
    required: list[str],
    unique: list[str],
    rules: list[Rule] = (),
    severity: str = CRITICAL,
) -> DataFrame:
    """Q02 not-null, Q03 uniqueness and Q05 business rules in one pass.

    A row with several NULL required columns fails the not-null check once;
    NULL keys are equal to each other for uniqueness (surplus rows fail); a
    rule whose condition is NULL counts as failed.
    """
    per_key = df.groupBy(*unique).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(any_null(required), 1).otherwise(0)).alias("nulls"),
        *[
            F.sum(F.when(~null_as_false(rule.condition()), 1).otherwise(0)).alias(f"rule_{i}")
            for i, rule in enumerate(rules)
        ],
    )
    totals = per_key.agg(
        F.sum("n").alias("total"),
        F.sum(F.col("n") - 1).alias("surplus"),
        F.sum("nulls").alias("nulls"),
        *[F.sum(f"rule_{i}").alias(f"rule_{i}") for i in range(len(rules))],
    )
    rows = [
        _row(table, f"not_null: {', '.join(required)}", "not_null", severity, NOT_NULL_DETAILS, "total", "nulls"),
        _row(table, f"unique: {', '.join(unique)}", "uniqueness", severity, UNIQUE_DETAILS, "total", "surplus"),
    ]
    rows += [
        _row(table, rule.name, "business_rule", rule.severity, rule.details, "total", f"rule_{i}")
        for i, rule in enumerate(rules)
    ]
    return _rows(totals, rows)


def key_presence(child: DataFrame, parent: DataFrame, key: list[str]) -> DataFrame:
    """Child key groups with their row count and whether the parent has them.

    The child is reduced to one row per key before the join, so the join
    moves distinct keys only and a hot key cannot overload a join task.
    """
    child_keys = child.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    parent_keys = parent.select(*key).distinct().withColumn("found", F.lit(True))
    return child_keys.join(parent_keys, key, "left")


def foreign_key_check(child: DataFrame, parent: DataFrame, child_table: str, parent_table: str,
                      key: list[str], severity: str = CRITICAL) -> DataFrame:
    """Q04: child rows whose non-NULL key is missing from the parent.

    Child rows with a NULL key part are not failures but stay in total_rows.
    """
    keyed = key_presence(child, parent, key)
    missing = all_not_null(key) & F.col("found").isNull()
    totals = keyed.agg(
        F.sum("n").alias("total"),
        F.sum(F.when(missing, F.col("n")).otherwise(0)).alias("failed"),
    )
    return _rows(
        totals,
        [
            _row(
                child_table,
                f"foreign_key: {child_table} → {parent_table}",
                "referential_integrity",
                severity,
                f"Keys {key} must exist in {parent_table}.",
                "total",
                "failed",
            )
        ],
    )


def source_duplicate_check(raw_reviews: DataFrame) -> DataFrame:
    """Q06: surplus review_id rows in bronze; allowed = observed, a warning."""
    totals = raw_reviews.groupBy("review_id").count().agg(
        F.sum("count").alias("total"), F.sum(F.col("count") - 1).alias("surplus")
    )
    return _rows(
        totals,
        [
            _row(
                "reviews_raw",
                "duplicate_review_ids_in_source",
                "source_quality",
                WARNING,
                SOURCE_DUPLICATE_DETAILS,
                "total",
                "surplus",
                allowed="surplus",
            )
        ],
    )


@dataclass(frozen=True)
class KeyFamily:
    """Tables that carry ``key``: ``parent`` (whose key it is, if checked),
    ``children`` that must find it there, and ``finer`` tables whose business
    key starts with it and goes on with another column."""

    key: str
    parent: str | None = None
    children: tuple[str, ...] = ()
    finer: tuple[tuple[str, str], ...] = ()

    @property
    def checked(self) -> tuple[str, ...]:
        """Tables whose own checks this family counts."""
        return ((self.parent,) if self.parent else ()) + tuple(t for t, _ in self.finer)


#: One family per key; every table's own checks are counted in one of them.
KEY_FAMILIES = (
    KeyFamily("order_id", "orders", ("order_items", "payments", "reviews"),
              (("order_items", "order_item_id"), ("payments", "payment_sequential"))),
    KeyFamily("customer_id", "customers", ("orders",)),
    KeyFamily("product_id", "products", ("order_items",)),
    KeyFamily("seller_id", "sellers", ("order_items",)),
    KeyFamily("review_id", "reviews"),
)


def _zero_one(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0).cast("long")


def family_checks(family: KeyFamily, silver) -> DataFrame:
    """The checks of a family in one grouped plan: rows are tagged by table
    and united, grouped by key (by the finer key first, where there is one),
    then summed.  NULL keys are one group: equal to each other for
    uniqueness, and no failure of a foreign key."""
    finer = dict(family.finer)
    tables = list(dict.fromkeys([*family.checked, *family.children]))
    width = max([len(BUSINESS_RULES.get(t, ())) for t in family.checked] + [0])

    def tagged(table: str) -> DataFrame:
        own = table in family.checked
        rules = [r.condition() for r in BUSINESS_RULES.get(table, ())] if own else []
        nulls = any_null(KEY_RULES[table]["required"]) if own else F.lit(False)
        failed = [_zero_one(~null_as_false(c)) for c in rules] + [F.lit(0).cast("long")] * (width - len(rules))
        part = F.col(finer[table]).cast("string") if table in finer else F.lit(None).cast("string")
        return silver(table).select(
            F.lit(tables.index(table)).alias("tag"), F.col(family.key).alias("k"), part.alias("part"),
            _zero_one(nulls).alias("nulls"), *[c.alias(f"rule_{i}") for i, c in enumerate(failed)],
        )

    rows = tagged(tables[0])
    for table in tables[1:]:
        rows = rows.unionByName(tagged(table))
    sums = ["nulls", *[f"rule_{i}" for i in range(width)]]
    surplus = F.lit(0).cast("long")
    if finer:
        rows = rows.groupBy("tag", "k", "part").agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in sums])
        surplus = F.col("n") - 1
    else:
        rows = rows.withColumn("n", F.lit(1).cast("long"))

    def of(table: str, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(F.col("tag") == tables.index(table), value)), F.lit(0))

    per_key = [of(t, F.col("n")).alias(f"n_{t}") for t in tables]
    per_key += [of(t, surplus).alias(f"surplus_{t}") for t in finer]
    per_key += [of(t, F.col(c)).alias(f"{c}_{t}") for t in family.checked for c in sums]
    keyed = rows.groupBy("k").agg(*per_key)

    totals = [F.sum(f"n_{t}").alias(f"n_{t}") for t in tables]
    totals += [F.sum(f"surplus_{t}").alias(f"surplus_{t}") for t in finer]
    totals += [F.sum(f"{c}_{t}").alias(f"{c}_{t}") for t in family.checked for c in sums]
    if family.parent:
        found = F.col(f"n_{family.parent}")
        totals.append(F.sum(F.when(found > 0, found - 1).otherwise(0)).alias(f"surplus_{family.parent}"))
        missing = F.col("k").isNotNull() & (found == 0)
        totals += [F.sum(F.when(missing, F.col(f"n_{c}")).otherwise(0)).alias(f"orphans_{c}") for c in family.children]

    out = []
    for table in family.checked:
        spec = KEY_RULES[table]
        required, unique = ", ".join(spec["required"]), ", ".join(spec["unique"])
        total = f"n_{table}"
        out.append(_row(table, f"not_null: {required}", "not_null", CRITICAL, NOT_NULL_DETAILS, total, f"nulls_{table}"))
        out.append(_row(table, f"unique: {unique}", "uniqueness", CRITICAL, UNIQUE_DETAILS, total, f"surplus_{table}"))
        out += [
            _row(table, r.name, "business_rule", r.severity, r.details, total, f"rule_{i}_{table}")
            for i, r in enumerate(BUSINESS_RULES.get(table, ()))
        ]
    out += [
        _row(child, f"foreign_key: {child} → {family.parent}", "referential_integrity", CRITICAL,
             f"Keys {[family.key]} must exist in {family.parent}.", f"n_{child}", f"orphans_{child}")
        for child in family.children
    ]
    return _rows(keyed.agg(*totals), out)


def quality_checks(silver, raw_reviews: DataFrame) -> DataFrame:
    """All 25 recorded checks as one DataFrame (no run columns yet).

    ``silver`` is a provider ``name -> DataFrame``; ``raw_reviews`` is the
    bronze reviews table.
    """
    result = source_duplicate_check(raw_reviews)
    for family in KEY_FAMILIES:
        result = result.unionByName(family_checks(family, silver))
    return result


def raw_checks(raw) -> DataFrame:
    """The check operators over raw tables (a provider), which do hold
    defects."""
    scores = Rule("valid_review_score", lambda: F.expr("try_cast(review_score AS int)").between(1, 5),
                  "Review score must be between 1 and 5.")
    return (
        table_checks(raw("order_items"), "order_items_raw", ["order_id", "seller_id"], ["order_id", "order_item_id"])
        .unionByName(table_checks(
            raw("reviews"), "reviews_raw", ["review_id", "review_comment_title"], ["review_id"], [scores]))
        .unionByName(foreign_key_check(raw("orders"), raw("reviews"), "orders_raw", "reviews_raw", ["order_id"]))
    )


def new_run() -> tuple[str, str]:
    """A run id (uuid4) and the UTC check time without zone."""
    checked_at = datetime.now(timezone.utc).replace(tzinfo=None)
    return str(uuid.uuid4()), checked_at.isoformat(sep=" ")


def finish_results(checks: DataFrame, run_id: str, checked_at: str, layer: str = "silver") -> DataFrame:
    """Q01/Q07: status, failure rate (0.0 for an empty table) and run columns."""
    failed = F.col("failed_rows")
    return checks.select(
        F.lit(run_id).alias("run_id"),
        F.lit(checked_at).cast("timestamp_ntz").alias("checked_at"),
        F.lit(layer).alias("layer"),
        "table_name",
        "check_name",
        "check_type",
        "severity",
        F.when(failed <= F.col("allowed_failures"), "PASS").otherwise("FAIL").alias("status"),
        "total_rows",
        "failed_rows",
        F.coalesce(F.try_divide(failed.cast("double"), F.col("total_rows")), F.lit(0.0)).alias("failure_rate"),
        "details",
    )


def dated(results: DataFrame) -> DataFrame:
    """Results with the run's date, as the history keeps them."""
    return results.withColumn("run_date", F.to_date("checked_at"))


# -------------------------------------------------------------------- gate


GATE_FAILED = "Data quality gate failed: "


class QualityGateError(RuntimeError):
    pass


def critical_failures(results: DataFrame) -> DataFrame:
    return results.filter((F.col("severity") == CRITICAL) & (F.col("status") == "FAIL"))


def gate(results: DataFrame) -> DataFrame:
    """Q08: the verdict on a run's results as one row: ``verdict`` PASS or
    FAIL, the number of critical failures, and ``error``, their list (NULL
    where there is none).  The list is bounded by the number of checks."""
    listed = F.when(
        (F.col("severity") == CRITICAL) & (F.col("status") == "FAIL"),
        F.concat("table_name", F.lit(": "), "check_name", F.lit(" ("), F.col("failed_rows").cast("string"), F.lit(" rows)")),
    )
    found = results.agg(F.array_sort(F.collect_list(listed)).alias("failures"))
    n = F.size("failures")
    return found.select(
        F.when(n == 0, "PASS").otherwise("FAIL").alias("verdict"),
        n.cast("long").alias("critical_failures"),
        F.when(n > 0, F.array_join("failures", "; ")).alias("error"),
    )


def gated(df: DataFrame, verdict: DataFrame) -> DataFrame:
    """``df``, readable only where the gate has passed: the verdict is a
    scalar subquery of the same job, which fails on the first row otherwise."""
    error = verdict.select("error").scalar()
    stop = F.raise_error(F.concat(F.lit(GATE_FAILED), error)).cast("boolean")
    return df.where(F.when(error.isNull(), F.lit(True)).otherwise(stop))


# ---------------------------------------------------------- reconciliation


@dataclass(frozen=True)
class FactCheck:
    """Q16/Q17 of a fact: its source, natural key and keys never NULL."""

    fact: str
    source: str
    natural_key: tuple[str, ...]
    keys: tuple[str, ...]


# The facts' sources and their key columns.
FACT_CHECKS = (
    FactCheck("fct_orders", "orders", ("order_id",), ("order_key", "customer_key", "order_date_key")),
    FactCheck("fct_order_items", "order_items", ("order_id", "order_item_id"),
              ("order_item_key", "customer_key", "product_key", "seller_key", "order_date_key")),
)


def _key_number(columns: tuple[str, ...]) -> Column:
    """60 bits of the natural key's MD5, whose sum does not depend on order."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(38,0)")


def reconciliation(facts, sources, checks: tuple[FactCheck, ...] = FACT_CHECKS) -> DataFrame:
    """Q16 and Q17 as one row per fact, in one grouped plan over the facts and
    their sources (providers name → DataFrame): rows and key checksums of both
    sides, rows with a NULL key, and NULLs by key column.  ``status`` is FAIL
    unless rows and checksums agree and no key is NULL."""
    width = max(len(c.keys) for c in checks)
    no = F.lit(0).cast("long")

    def side(check: FactCheck, df: DataFrame, is_fact: bool) -> DataFrame:
        nulls = [_zero_one(F.col(k).isNull()) for k in check.keys] if is_fact else []
        any_key = _zero_one(any_null(check.keys)) if is_fact else no
        return df.select(
            F.lit(check.fact).alias("fact_name"), F.lit(is_fact).alias("is_fact"),
            _key_number(check.natural_key).alias("number"), any_key.alias("null_keys"),
            *[(nulls[i] if i < len(nulls) else no).alias(f"null_{i}") for i in range(width)],
        )

    parts = [side(c, sources(c.source), False) for c in checks] + [side(c, facts(c.fact), True) for c in checks]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)

    def total(is_fact: bool, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(F.col("is_fact") == is_fact, value)), F.lit(0))

    one = F.lit(1)
    counted = rows.groupBy("fact_name").agg(
        total(False, one).alias("source_rows"), total(True, one).alias("fact_rows"),
        total(False, F.col("number")).alias("source_sum"), total(True, F.col("number")).alias("fact_sum"),
        F.sum("null_keys").alias("null_key_rows"), *[F.sum(f"null_{i}").alias(f"null_{i}") for i in range(width)],
    )
    by_key = F.lit(None).cast("string")
    for c in checks:
        named = F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), F.col(f"null_{i}").cast("string")) for i, k in enumerate(c.keys)])
        by_key = F.when(F.col("fact_name") == c.fact, named).otherwise(by_key)
    same = (F.col("source_rows") == F.col("fact_rows")) & (F.col("source_sum") == F.col("fact_sum"))
    return counted.select(
        "fact_name", "source_rows", "fact_rows",
        F.col("source_sum").cast("string").alias("source_checksum"),
        F.col("fact_sum").cast("string").alias("fact_checksum"),
        "null_key_rows", by_key.alias("nulls_by_key"),
        F.when(same & (F.col("null_key_rows") == 0), "PASS").otherwise("FAIL").alias("status"),
    )


# ----------------------------------------------------------------- reports


def latest_run(results: DataFrame) -> DataFrame:
    """Rows of the latest run: ``checked_at = max(checked_at)``, ties broken by
    run_id.  The one-row maximum is joined (broadcast, one row), not collected."""
    latest = results.agg(F.max(F.struct("checked_at", "run_id")).alias("m")).select("m.checked_at", "m.run_id")
    return results.join(F.broadcast(latest), ["checked_at", "run_id"], "inner")


def summary_report(results: DataFrame) -> DataFrame:
    """Q09: latest run by severity and status."""
    return (
        latest_run(results)
        .groupBy("severity", "status")
        .agg(F.count(F.lit(1)).alias("check_count"), F.sum("failed_rows").alias("failed_rows"))
        .orderBy("severity", "status")
    )


def failure_report(results: DataFrame) -> DataFrame:
    """Q10: failed checks of the latest run."""
    return (
        latest_run(results)
        .filter(F.col("status") == "FAIL")
        .select("table_name", "check_name", "severity", "failed_rows", "failure_rate", "details")
        .orderBy("severity", "table_name")
    )


# --------------------------------------------------------------- mart tests

# The 16 mart tests (model, not-null columns, unique column).
MART_TESTS = {
    "mart_daily_sales": (["date_key", "total_orders", "payment_total"], "date_key"),
    "mart_product_performance": (["product_key", "total_orders", "gross_sales"], "product_key"),
    "mart_customer_summary": (["customer_unique_id", "total_orders", "lifetime_payment_value"], "customer_unique_id"),
    "mart_delivery_quality": (["delivery_quality_key", "year_month", "customer_state"], "delivery_quality_key"),
}


def mart_test(df: DataFrame, model: str, not_null: list[str], unique: str) -> DataFrame:
    """T01-T16 for one mart in one grouped pass: NULL rows per column, and the
    number of non-NULL key values that occur more than once."""
    per_key = df.groupBy(unique).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).alias(f"null_{i}") for i, c in enumerate(not_null)],
    )
    totals = per_key.agg(
        F.sum(F.when(F.col(unique).isNotNull() & (F.col("n") > 1), 1).otherwise(0)).alias("dup"),
        *[F.sum(f"null_{i}").alias(f"null_{i}") for i in range(len(not_null))],
    )

    filled = totals.select(*[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in totals.columns])
    rows = [(model, "not_null", c, Ref(f"null_{i}")) for i, c in enumerate(not_null)]
    rows.append((model, "unique", unique, Ref("dup")))
    tests = stack_rows(filled, rows, ["model", "test_name", "column_name", "failures"], {"failures": "BIGINT"})
    return tests.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def mart_tests(marts) -> DataFrame:
    parts = [mart_test(marts(model), model, cols, key) for model, (cols, key) in MART_TESTS.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result

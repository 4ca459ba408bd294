"""Bronze → silver cleansing driven by a ``TableContract``.

Order of work: clean and type columns, reject rows, deduplicate on the
business key, add derived columns, stamp ``_silver_processed_at``.  Rows are
rejected *before* deduplication, so a rejected row never becomes the survivor
of its key.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemarts.contracts import TableContract
from lakemarts.functions import clean
from lakemarts.operators.dedup import keep_first

AUDIT_COLUMNS = ("_source_file", "_ingested_at")


def clean_columns(raw: DataFrame, contract: TableContract) -> DataFrame:
    """Project, clean and type the contract's columns; keep lineage columns."""
    # Every rule maps NULL to NULL, so a raw NULL in a required column can be
    # dropped before cleaning.  Unlike the filter on trim(x), this predicate
    # reaches the file scan (PushedFilters).
    source_of = {c.target: c.source for c in contract.columns}
    required = list(contract.not_null) + list(contract.non_negative) + [r[0] for r in contract.ranges]
    present = [F.col(source_of[target]).isNotNull() for target in dict.fromkeys(required)]
    if present:
        raw = raw.filter(reduce(and_, present))
    audit = [c for c in AUDIT_COLUMNS if c in raw.columns]
    return raw.select(*[clean(c.rule, c.source).alias(c.target) for c in contract.columns], *audit)


def row_filter(contract: TableContract):
    conditions = [F.col(c).isNotNull() for c in contract.not_null]
    conditions += [F.length(F.col(c)) > 0 for c in contract.non_blank]
    conditions += [F.col(c) >= 0 for c in contract.non_negative]
    conditions += [F.col(c).between(lo, hi) for c, lo, hi in contract.ranges]
    return reduce(and_, conditions) if conditions else None


def cleanse(raw: DataFrame, contract: TableContract, stamp: bool = True) -> DataFrame:
    df = clean_columns(raw, contract)
    condition = row_filter(contract)
    if condition is not None:
        df = df.filter(condition)
    df = keep_first(df, contract.key, contract.survivor_order())
    if contract.derived:
        df = df.withColumns({name: build() for name, build in contract.derived})
    if stamp:
        df = df.withColumn("_silver_processed_at", F.current_timestamp())
    return df

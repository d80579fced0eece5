"""Declared schemas; nothing is inferred from data."""

from pyspark.sql import types as T

_TYPES = {
    "BIGINT": T.LongType(), "INT": T.IntegerType(), "DOUBLE": T.DoubleType(), "STRING": T.StringType(),
    "DATE": T.DateType(), "TIMESTAMP": T.TimestampType(), "BOOLEAN": T.BooleanType(),
}


def struct(columns: str) -> T.StructType:
    """Schema from "name TYPE, ..." without needing a running session."""
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


EVENTS = struct("timestamp BIGINT, visitorid BIGINT, event STRING, itemid BIGINT, transactionid STRING")
ITEM_PROPERTIES = struct("timestamp BIGINT, itemid BIGINT, property STRING, value STRING")
CATEGORY_TREE = struct("categoryid BIGINT, parentid BIGINT")

RUN_LOG = struct("run_id STRING, run_timestamp TIMESTAMP, dataset_name STRING, total_records BIGINT, status STRING")
RESULTS = struct(
    "run_id STRING, rule_id STRING, rule_desc STRING, dimension STRING, severity STRING, status STRING,"
    " total_records BIGINT, failed_records BIGINT, failure_pct DOUBLE"
)
SUMMARY = struct(
    "run_id STRING, dataset_name STRING, run_timestamp TIMESTAMP, quality_score DOUBLE, status STRING,"
    " pass_count INT, fail_count INT, warn_count INT,"
    " critical_failures INT, high_failures INT, medium_failures INT, low_failures INT,"
    " score_completeness DOUBLE, score_uniqueness DOUBLE, score_validity DOUBLE,"
    " score_consistency DOUBLE, score_freshness DOUBLE, score_referential_integrity DOUBLE"
)

INVENTORY_DDL = (
    "dataset_id STRING, dataset_name STRING, domain STRING, category STRING, owner STRING, steward STRING,"
    " refresh_frequency STRING, source_system STRING, regulatory_criticality STRING"
)
RULEBOOK_DDL = "rule_id STRING, rule_name STRING, category STRING, threshold DOUBLE, severity STRING"
BRIDGE_DDL = "dataset_id STRING, rule_id STRING"

INVENTORY = struct(INVENTORY_DDL)
RULEBOOK = struct(RULEBOOK_DDL)
TESTS = struct(
    "test_id STRING, test_date DATE, dataset_id STRING, rule_id STRING, total_records BIGINT, pass_count BIGINT,"
    " fail_count BIGINT, failure_rate DOUBLE, control_effectiveness DOUBLE, status STRING"
)

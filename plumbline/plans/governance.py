"""The governance run: every layer once, each reuse point written before it is read again."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.exceptions import EXCEPTION_COLUMNS
from ..operators.watchlist import with_watchlist_ids

ORDER = ("data_inventory", "control_rulebook", "control_test_results", "dq_watchlist", "exceptions",
         "remediation_tickets", "domain_trust_scores", "governance_maturity")
PARTITIONS = {"control_test_results": ["test_date"]}
SOURCES = {
    "data_inventory": "inventory", "control_rulebook": "rulebook", "control_test_results": "tests", "dq_watchlist": "watchlist",
    "exceptions": "exceptions", "remediation_tickets": "tickets", "domain_trust_scores": "trust", "governance_maturity": "maturity",
}

# published layouts, where a layer carries more than is stored
LAYOUTS = {"dq_watchlist": with_watchlist_ids, "exceptions": lambda df: df.select(*EXCEPTION_COLUMNS)}


def refresh(layers, root: str) -> dict[str, DataFrame]:
    """Write all eight tables under ``root`` and return them as read back.

    ``layers`` exposes the tables as attributes (see SOURCES). A table is written when its
    turn comes and the stored copy takes its place, so later layers start from files: the
    fact tables are scanned once for the test history, and a lost executor costs at most
    the layer in progress. The history is partitioned by test date for date filters.
    """
    from ..sources.store import refresh_tables

    done: dict[str, DataFrame] = {}
    for name in ORDER:
        df = getattr(layers, SOURCES[name])
        df = LAYOUTS[name](df) if name in LAYOUTS else df
        refresh_tables({name: df}, root, PARTITIONS)
        stored = layers.spark.read.schema(df.schema).parquet(f"{root.rstrip('/')}/{name}")
        setattr(layers, SOURCES[name], stored)
        done[name] = stored
    return done

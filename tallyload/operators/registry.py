"""A3 registry_active, C1 registry_resolve, C2 commands_unregistered, C3 registry_diff.

A registry row: ``event_type int, base string, columns string (DDL),
cycle string, partgranularity int, state int`` (state 1 = enabled).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyload.functions.naming import dest_table_name, family_name, split_mode
from tallyload.operators.sizing import bounded_broadcast

REGISTRY_SCHEMA = "event_type int, base string, columns string, cycle string, partgranularity int, state int"
RESOLVED_COLUMNS = ["base", "cycle", "split_mode", "columns", "family", "dest_table"]


def registry_active(registry: DataFrame) -> DataFrame:
    """Enabled rows with the split code decoded."""
    return registry.filter(F.col("state") == 1).withColumn("split_mode", split_mode("partgranularity"))


def registry_resolve(tasks: DataFrame, registry: DataFrame, ts_col: str = "content_ts",
                     checked: bool = False) -> DataFrame:
    """Tasks of registered types, with their target family and table name.

    ``checked=True`` says the registry was already size-checked (and hinted)
    by the caller, e.g. once per batch; otherwise it is checked here.
    """
    reg = registry_active(registry).select(
        "event_type", "base", "cycle", "split_mode", "columns",
        family_name("base", "cycle").alias("family"),
    )
    joined = tasks.join(reg if checked else bounded_broadcast(reg), "event_type", "inner")
    return joined.withColumn("dest_table", dest_table_name("base", "cycle", "split_mode", ts_col))


def commands_unregistered(tasks: DataFrame, registry: DataFrame, checked: bool = False) -> DataFrame:
    """Tasks whose event type has no enabled registry row."""
    reg = registry_active(registry).select("event_type")
    return tasks.join(reg if checked else bounded_broadcast(reg), "event_type", "left_anti")


def registry_diff(fresh: DataFrame, known: DataFrame) -> DataFrame:
    """Compare a freshly read registry with the configurations in use.

    ``change``: ``new`` (only enabled in ``fresh``), ``disabled`` (in use, no
    longer enabled), ``changed`` (columns, cycle or split mode differ, NULLs
    compared safely) or ``unchanged``.
    """
    cols = ["columns", "cycle", "split_mode"]
    n = registry_active(fresh).select("event_type", *[F.col(c).alias(f"n_{c}") for c in cols])
    o = known.withColumn("split_mode", split_mode("partgranularity")).select(
        "event_type", *[F.col(c).alias(f"o_{c}") for c in cols]
    )
    differs = None
    for c in cols:
        d = ~F.col(f"n_{c}").eqNullSafe(F.col(f"o_{c}"))
        differs = d if differs is None else (differs | d)
    change = (
        F.when(F.col("o_present").isNull(), F.lit("new"))
        .when(F.col("n_present").isNull(), F.lit("disabled"))
        .when(differs, F.lit("changed"))
        .otherwise(F.lit("unchanged"))
    )
    n = n.withColumn("n_present", F.lit(True))
    o = o.withColumn("o_present", F.lit(True))
    j = n.join(o, "event_type", "full_outer")
    return j.select("event_type", change.alias("change"))


def registry_validate(registry: DataFrame) -> DataFrame:
    """Whether Spark can read the column list of each enabled row: ``event_type, valid, error``.

    Spark's DDL reader lives on the driver.  It tries every distinct column
    list once; they come partition by partition, and there is no limit on the
    number of rows.
    """
    from tallyload.functions.ddl import declared_schema

    active = registry_active(registry).select("event_type", "columns")
    checked = []
    for r in active.select("columns").distinct().toLocalIterator():
        try:
            declared_schema(r["columns"])
            checked.append((r["columns"], True, None))
        except Exception as e:  # reported, not raised
            checked.append((r["columns"], False, str(e).strip()))
    lists = registry.sparkSession.createDataFrame(checked, "columns string, valid boolean, error string")
    return active.join(lists, active["columns"].eqNullSafe(lists["columns"])).select("event_type", "valid", "error")


def tables_needed_now(registry: DataFrame, now=None) -> DataFrame:
    """B5's current-time twin: the target table each enabled registry row
    writes to at ``now`` (default: the current timestamp) -- the input of the
    periodic "which period tables are missing" report (C4)."""
    ts = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    reg = registry_active(registry)
    return reg.select("event_type", dest_table_name("base", "cycle", "split_mode", ts).alias("dest_table"))


def snapshot_registry(registry: DataFrame) -> DataFrame:
    """A written copy of a registry, so a version in use stays as it was even when its source table changes."""
    return registry.select(*[c.split(" ")[0] for c in REGISTRY_SCHEMA.split(", ")]).checkpoint(eager=True)


def effective_registry(fresh: DataFrame, known: DataFrame | None) -> DataFrame:
    """The registry to load with after a refresh: fresh rows whose column
    lists Spark can read; where an enabled fresh row cannot be read, the
    version in use (``known``) stays.  ``registry_validate`` reports them."""
    checks = registry_validate(fresh)
    bad = checks.filter(~F.col("valid")).select("event_type")
    keep = fresh.join(bad, "event_type", "left_anti")
    if known is None:
        return keep
    return keep.unionByName(known.join(bad, "event_type", "left_semi"))

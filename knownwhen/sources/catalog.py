"""Published tables as tables, views and functions of the session's SQL catalog.

Tables are entries for the folders that are published: they carry the comment, the layer
and the version, columns their comments. Registering again after a publication moves the
entry to the new folder. Views and as-of functions are plain SQL over them, so filters on
either reach the scan. Where entries live on is the catalog's business: a session without a
metastore forgets them, and registering takes them up again.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

from knownwhen.sources import tables

DATABASE = "knownwhen"

# View: the table it reads, its columns and its condition.
VIEWS = {
    "current_fundamental": ("fact_fundamental_pit", "is_current"),
    "current_company": ("dim_company_scd2", "is_current"),
    "pending_quarter": ("ingest_control", "status <> 'DONE'"),
}
# Function of an instant: its table, and the columns between which the instant lies.
AS_OF = {
    "fundamental_as_of": ("fact_fundamental_pit", "known_from_ts", "known_to_ts"),
    "company_as_of": ("dim_company_scd2", "valid_from_ts", "valid_to_ts"),
}


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _create_database(spark: SparkSession, root: str, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION {_quoted(root + '/_catalog')}")


def register(spark: SparkSession, root: str, names: Iterable[str] | None = None,
             database: str = DATABASE) -> list[str]:
    """Entries for the published tables among ``names`` (all by default); returns which."""
    _create_database(spark, root, database)
    done = []
    for name in tables.CATALOGUE if names is None else names:
        version = tables.version_of(spark, root, name)
        if version:
            _register(spark, root, name, version, f"{database}.{name}")
            done.append(name)
    return done


def _register(spark: SparkSession, root: str, name: str, version: int, entry: str) -> None:
    about = tables.CATALOGUE[name]
    folder = tables.folder_of(spark, root, name, version)
    schema = spark.read.parquet(folder).schema
    if spark.catalog.tableExists(entry) and spark.table(entry).schema == schema:
        spark.sql(f"ALTER TABLE {entry} SET LOCATION {_quoted(folder)}")
        spark.catalog.refreshTable(entry)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {entry}")  # the entry only, rows stay where they are
        spark.catalog.createTable(entry, path=folder, source="parquet", schema=schema,
                                  description=about.comment)
    spark.sql(f"ALTER TABLE {entry} SET TBLPROPERTIES ('layer' = {_quoted(about.layer)}, "
              f"'version' = '{version}', 'clustered by' = {_quoted(','.join(about.cluster))})")


def create_views(spark: SparkSession, database: str = DATABASE) -> list[str]:
    """The views whose table is registered."""
    made = []
    for view, (name, condition) in VIEWS.items():
        if spark.catalog.tableExists(f"{database}.{name}"):
            spark.sql(f"CREATE OR REPLACE VIEW {database}.{view} "
                      f"AS SELECT * FROM {database}.{name} WHERE {condition}")
            made.append(view)
    return made


def create_functions(spark: SparkSession, database: str = DATABASE) -> list[str]:
    """Table functions of an instant, such as ``fundamental_as_of``, over registered tables.

    ``SELECT * FROM fundamental_as_of(TIMESTAMP_NTZ '2022-06-01 00:00:00')`` has the rows in
    force at that instant: known from then or before, and until after it. They belong to the
    session, since Spark calls table functions by one name only.
    """
    made = []
    for function, (name, opened, closed) in AS_OF.items():
        entry = f"{database}.{name}"
        if not spark.catalog.tableExists(entry):
            continue
        fields = spark.table(entry).schema.fields
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        chosen = ", ".join(f"t.`{f.name}`" for f in fields)
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {function}(instant TIMESTAMP_NTZ) "
            f"RETURNS TABLE ({columns}) RETURN SELECT {chosen} FROM {entry} t "
            f"WHERE t.{opened} <= {function}.instant AND t.{closed} > {function}.instant")
        made.append(function)
    return made


def described(spark: SparkSession, database: str = DATABASE) -> list[tuple[str, str, str, int]]:
    """(table, layer, comment, version) as the catalog says it."""
    out = []
    for entry in spark.catalog.listTables(database):
        if entry.tableType != "VIEW" and not entry.isTemporary:
            rows = spark.sql(f"SHOW TBLPROPERTIES {database}.{entry.name}").collect()
            known = {r["key"]: r["value"] for r in rows}
            out.append((entry.name, known.get("layer", ""), entry.description or "",
                        int(known.get("version", 0))))
    return sorted(out)

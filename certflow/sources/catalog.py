"""The data dictionary of a catalog's tables, with lengths and defaults, as rows, JSON and Markdown."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

_COLUMN = ("schema_name string, table_name string, table_comment string, column_name string, position int, data_type string, "
           "max_length int, precision int, scale int, nullable boolean, default_value string, description string")


def catalog_columns(spark: SparkSession, schemas: list[str]) -> DataFrame:
    """One row per column of every table of the schemas, from the catalog alone.

    CHAR and VARCHAR columns have their length, decimals precision and scale. The catalog's
    own listing passes through the driver; no table is read.
    """
    rows = []
    for schema in schemas:
        for table in spark.catalog.listTables(schema):
            if table.isTemporary or table.tableType == "VIEW":
                continue
            name = f"`{schema}`.`{table.name}`"
            found = json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {name} AS JSON").first()[0])
            more = {c["name"]: c for c in found["columns"]}
            # this listing alone has CHAR and VARCHAR as declared; partition columns come again below a heading
            types: dict[str, str] = {}
            for r in spark.sql(f"DESCRIBE TABLE {name}").collect():
                if r.col_name and not r.col_name.startswith("#"):
                    types.setdefault(r.col_name, r.data_type)
            for k, c in enumerate(spark.catalog.listColumns(name)):
                data_type = types[c.name]
                kind, _, size = data_type.partition("(")
                sizes = [int(x) for x in size.rstrip(")").split(",")] if size and kind in ("char", "varchar", "decimal") else []
                rows.append((
                    schema, table.name, found.get("comment"), c.name, k + 1, data_type, sizes[0] if kind in ("char", "varchar") else None,
                    sizes[0] if kind == "decimal" else None, sizes[1] if kind == "decimal" else None, c.nullable,
                    more[c.name].get("default"), c.description))
    return spark.createDataFrame(rows, _COLUMN)


def with_row_counts(spark: SparkSession, columns: DataFrame) -> DataFrame:
    """The dictionary with the rows of each table, all counted in one job."""
    names = [tuple(r) for r in columns.select("schema_name", "table_name").distinct().collect()]
    counts = None
    for schema, table in names:
        one = spark.table(f"`{schema}`.`{table}`").agg(F.count("*").alias("row_count")).select(
            F.lit(schema).alias("schema_name"), F.lit(table).alias("table_name"), "row_count")
        counts = one if counts is None else counts.unionByName(one)
    if counts is None:
        return columns.withColumn("row_count", F.lit(0).cast("long"))
    return columns.join(counts, ["schema_name", "table_name"])


def dictionary_json(dictionary: DataFrame) -> DataFrame:
    """One JSON document per table: schema, name, description, row count and its columns in order."""
    fields = ["position", "column_name", "data_type", "max_length", "precision", "scale", "nullable", "default_value", "description"]
    columns = F.transform(F.array_sort(F.collect_list(F.struct(*fields))), lambda c: c.dropFields("position"))
    return dictionary.groupBy("schema_name", "table_name", "table_comment", "row_count").agg(columns.alias("columns")).select(
        "schema_name", "table_name", F.to_json(F.struct(
            F.col("schema_name").alias("schema"), F.col("table_name").alias("name"), F.col("table_comment").alias("description"), "row_count", "columns"),
            {"ignoreNullFields": "false"}).alias("document"))


def dictionary_report(dictionary: DataFrame) -> DataFrame:
    """The dictionary as Markdown: schema_name, table_name, position and value; in that order the lines make the report."""
    text = lambda c, none: F.coalesce(F.col(c).cast("string"), F.lit(none))
    heads = dictionary.select("schema_name", "table_name", "table_comment", "row_count").distinct().select(
        "schema_name", "table_name", F.lit(0).alias("position"),
        F.concat(F.lit("### "), "schema_name", F.lit("."), "table_name", F.lit("\n"), text("table_comment", "No description"), F.lit("\n\n**Rows**: "),
                 text("row_count", "0"), F.lit("\n\n| Column | Type | Length | Nullable | Default | Description |\n|---|---|---|---|---|---|")).alias("value"))
    nullable = F.when(F.col("nullable"), "Yes").otherwise("No")
    cells = F.concat(F.lit("| "), F.concat_ws(" | ", "column_name", "data_type", text("max_length", ""), nullable, text("default_value", ""), text("description", "")), F.lit(" |"))
    return heads.unionByName(dictionary.select("schema_name", "table_name", "position", cells.alias("value")))


def catalog_objects(spark: SparkSession, schemas: list[str]) -> DataFrame:
    """Tables, views and functions of each schema; a schema without any has zeros."""
    rows = []
    for schema in schemas:
        kinds = [t.tableType for t in spark.catalog.listTables(schema) if not t.isTemporary]
        functions = [f for f in spark.catalog.listFunctions(schema) if f.namespace == [schema]]
        rows.append((schema, len(kinds) - kinds.count("VIEW"), kinds.count("VIEW"), len(functions)))
    return spark.createDataFrame(rows, "schema_name string, tables int, views int, functions int")


def missing_names(spark: SparkSession, required: dict[str, list[str]]) -> DataFrame:
    """Schemas and tables that should be there and are not; a missing schema has no table name."""
    there = {d.name for d in spark.catalog.listDatabases()}
    rows = [(schema, None) for schema in required if schema not in there]
    for schema in required:
        if schema in there:
            held = {t.name.lower() for t in spark.catalog.listTables(schema)}
            rows += [(schema, t) for t in required[schema] if t.lower() not in held]
    return spark.createDataFrame(rows, "schema_name string, table_name string")

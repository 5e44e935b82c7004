"""the worklists as table functions of SQL, with the number of rows as argument."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from certflow.schemas import CALL_COLUMNS

# Name of a function -> the views that it reads, the columns that it gives (of the first view), and its text. A
# row's place is among those left to do; without a limit Spark drops the place, and with one it takes the first rows of each task.
PROCEDURES: dict[str, tuple[list[str], list[str], str]] = {
    "api_worklist": (["certificates", "api_log"], CALL_COLUMNS, """
        SELECT {columns} FROM (
          SELECT {columns}, row_number() OVER (ORDER BY CertificateID) AS place FROM certificates c
          LEFT ANTI JOIN (SELECT DISTINCT CertificateID AS done FROM api_log) l ON c.CertificateID = l.done)
        WHERE top_rows IS NULL OR place <= top_rows"""),
    "url_worklist": (["urls", "inventory", "download_log"], ["attest_url", "expected_filename"], """
        SELECT {columns} FROM (
          SELECT {columns}, row_number() OVER (ORDER BY attest_url) AS place FROM (
            SELECT attest_url, min(expected_filename) AS expected_filename FROM urls WHERE attest_url RLIKE '^https?://' GROUP BY attest_url) u
          LEFT ANTI JOIN (SELECT DISTINCT attest_url AS done FROM download_log WHERE status = 'Success') l ON u.attest_url = l.done
          LEFT ANTI JOIN (SELECT DISTINCT filename AS there FROM inventory) i ON u.expected_filename = i.there)
        WHERE top_rows IS NULL OR place <= top_rows"""),
    "extract_worklist": (["inventory", "extracts"], ["file_id", "filename", "full_path", "file_size"], """
        SELECT {columns} FROM (
          SELECT {columns}, row_number() OVER (ORDER BY filename, file_id) AS place FROM inventory f
          LEFT ANTI JOIN (SELECT DISTINCT file_id AS done FROM extracts) e ON f.file_id = e.done
          WHERE lower(file_extension) = '.pdf')
        WHERE top_rows IS NULL OR place <= top_rows"""),
    # only keys are ordered; the texts of the keys picked are read where they lie
    "clean_worklist": (["extracts", "cleaned"], ["file_id", "extracted_text"], """
        SELECT {columns} FROM extracts x LEFT SEMI JOIN (
          SELECT picked FROM (
            SELECT file_id AS picked, row_number() OVER (ORDER BY file_id) AS place FROM extracts y
            LEFT ANTI JOIN (SELECT DISTINCT file_id AS done FROM cleaned) d ON y.file_id = d.done)
          WHERE top_rows IS NULL OR place <= top_rows) p ON x.file_id <=> p.picked"""),
}


def register_procedures(spark: SparkSession, tables: dict[str, DataFrame]) -> list[str]:
    """Make the worklists whose tables are given callable from SQL, as `SELECT * FROM api_worklist(100)` or without a limit.

    The tables become temporary views under their names, which the functions read. Gives the functions' names.
    """
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    made = []
    for name, (views, columns, text) in PROCEDURES.items():
        if all(v in tables for v in views):
            types = {f.name: f.dataType.simpleString() for f in tables[views[0]].schema.fields}
            given = ", ".join(f"`{c}` {types[c]}" for c in columns)
            body = text.format(columns=", ".join(f"`{c}`" for c in columns)).replace("top_rows", f"{name}.top_rows")
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(top_rows BIGINT DEFAULT NULL) RETURNS TABLE({given}) RETURN {body}")
            made.append(name)
    return made

"""Every query beside its SQL twin on the smallest tables."""

import math

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from certflow.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def plain(rows):
    def one(v):
        if v is None or isinstance(v, float) and math.isnan(v):
            return None
        return round(v, 6) if isinstance(v, float) else v
    return sorted((tuple(one(v) for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_twin(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    made = QUERIES[name](spark, FOLDER)
    columns = sorted(made.columns)
    found = db.sql(SQL[name])
    assert sorted(found.columns) == columns
    assert plain(made.select(columns).collect()) == plain(db.sql(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall())


PROSE = "Une phrase assez longue pour compter dix mots au moins, je crois bien."
LINES = [
    "« Oui », dit-il. « Non », dit-elle. « Peut-être », dit-on.", "Accueil » Articles » Contact.", "Home | News | About.", "a > b > c > d.",
    "He said <b> twice > and then > left the room for good.", "Tous droits réservés.", "Alle Rechte vorbehalten 2020.", "We use a cookie.",
    "A very long line about design in a catalog in which one cookie is baked for many guests every day.", "cookies cookie cookie.",
    "Unsubscribe or subscribe here.", "écookie is no phrase.", "Impressum und Datenschutzerklärung.", "No end mark here", "!!! ... ??? ;;; !!!", "privacy policy",
    "Privacy Policy. Terms of use.", "x › y › z.", "‹ x › y › z ›.", "   ", "Aviso legal.", "Leer más.", " » » » end.",
]


def run_twin(spark, name, table, folder):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    made = QUERIES[name](spark, f"file://{folder}")
    columns = sorted(made.columns)
    assert plain(made.select(columns).collect()) == plain(db.sql(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall())


def test_quality_twin_on_each_rule(spark, tmp_path):
    texts = [f"{PROSE}\n{line}" for line in LINES] + [line for line in LINES] + ["\n".join([PROSE, *LINES]), "\n".join(LINES[::-1]), None, "", "\n\n"]
    pq.write_table(pa.table({"doc_id": list(range(len(texts))), "text": texts}), tmp_path / "documents.parquet")
    run_twin(spark, "op5_quality", "documents", tmp_path)


def test_links_twin(spark, tmp_path):
    refresh = "<meta http-equiv=refresh content='0; url={}'>"
    html = [
        refresh.format("http://x.com/1") + refresh.format("http://bad.net/y"), "<link rel=canonical href=/a><link rel=canonical href=//bad.net/z>",
        "<!-- " + refresh.format("http://bad.net/y") + " -->", "<script>" + refresh.format("http://bad.net/y") + "</script>", "<style>" + refresh.format("http://bad.net/y"),
        "<!---->" + refresh.format("http://p2.example.com/x"), None, ""]
    pq.write_table(pa.table({"page_id": list(range(len(html))), "url": [f"http://p{k}.example.com/x" for k in range(len(html))], "html": html}),
                   tmp_path / "pages.parquet")
    run_twin(spark, "op3_url_filter", "pages", tmp_path)

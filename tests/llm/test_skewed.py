"""Queries with SQL on tables in which one text, page, line or vector has a large share of the rows."""

import duckdb
import pytest
from oracle_check import differences

from barmill.llm.registry import ORACLE, QUERIES

GIVEN = "/root/testdata/sf0.001"

HOT = {
    "documents": """
        WITH one AS (SELECT text, lang, n_chars FROM given WHERE length(text) BETWEEN 800 AND 1500 ORDER BY doc_id LIMIT 1)
        SELECT doc_id, text, lang, source, n_chars FROM given
        UNION ALL
        SELECT 10000 + i, text, lang, 'src0', n_chars FROM one, range(150) r(i)
        UNION ALL
        SELECT 20000 + i, replace(text, substr(text, CAST(20 + i * 7 AS BIGINT), 12), ' changed' || i || ' '), lang, 'src0', n_chars
        FROM one, range(100) r(i)
        UNION ALL
        SELECT 30000 + doc_id, left(text, 300) || ' This line stands at the end of every page of the site, always.',
               lang, source, n_chars
        FROM given WHERE doc_id % 2 = 0
        UNION ALL
        SELECT * FROM (VALUES (40000, NULL, 'en', 'src0', 0), (40001, '', 'en', 'src0', 0), (40002, ' ', 'en', 'src0', 1))""",
    "pages": """
        SELECT page_id, url, html FROM given
        UNION ALL
        SELECT 1000 + i, 'http://hot.example/' || i, (SELECT html FROM given ORDER BY page_id LIMIT 1) FROM range(120) r(i)
        UNION ALL
        SELECT 5000, NULL, NULL""",
    "embeddings": """
        SELECT vec_id, embedding, label FROM given
        UNION ALL
        SELECT 10000 + i, (SELECT embedding FROM given ORDER BY vec_id LIMIT 1), 0 FROM range(250) r(i)""",
    "benchmark": """
        SELECT item_id, text FROM given
        UNION ALL
        SELECT 1000, 'This line stands at the end of every page of the site, always'
        UNION ALL
        SELECT 1001, text FROM (SELECT text FROM given ORDER BY item_id LIMIT 1)""",
    "conversations": """
        SELECT conv_id, turn, role, text FROM given
        UNION ALL
        SELECT 10000 + i, turn, role, text FROM given, range(60) r(i)
        WHERE conv_id = (SELECT min(conv_id) FROM given)
        UNION ALL
        SELECT 20000 + i, t, 'user', CASE WHEN t < 12 THEN 'the same beginning' ELSE i || ' differs' END
        FROM range(90) r(i), range(14) s(t)
        UNION ALL
        SELECT 30000, t, 'user', 'turn ' || t FROM range(300) s(t)""",
}


@pytest.fixture(scope="module")
def hot_dir(tmp_path_factory):
    folder = tmp_path_factory.mktemp("hot")
    con = duckdb.connect()
    for name, rows in HOT.items():
        con.execute(f"CREATE OR REPLACE VIEW given AS SELECT * FROM '{GIVEN}/{name}.parquet'")
        con.execute(f"COPY ({rows}) TO '{folder}/{name}.parquet' (FORMAT parquet, ROW_GROUP_SIZE 200)")
    return str(folder)


@pytest.mark.parametrize("name", ORACLE)
def test_against_sql(spark, hot_dir, name):
    assert differences(spark, name, hot_dir, QUERIES[name], ORACLE[name]) == []

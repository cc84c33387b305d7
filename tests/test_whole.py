"""Queries that do the whole job: no row is left out so that results agree with the SQL."""

from html import unescape

import __spark_entry__ as entry


def test_html_plain_of_all_documents(spark, tmp_path):
    cases = {
        "<p>A &amp; B</p>&nbsp;&copy; wire": "A & B © wire",
        "a<!-- no <b> -->b": "a b",
        "x<SCRIPT type='t'>if (a < b) {}</SCRIPT >y<style>p {}</style>z": "x y z",
        "&#39;&#x41;&#65;&apos;&quot; &lt;b&gt; &eacute;&Eacute;&#128512;": "'AA'\" <b> éÉ😀",
        "&amp;lt; once": "&lt; once",
        "https://a.b/?id=1&utm=x &nosuch; &#0; &#1114112; &": "https://a.b/?id=1&utm=x &nosuch; &#0; &#1114112; &",
        "a&#160;&emsp;b": "a b",
        "plain": "plain",
        "": "",
        None: None,
    }
    spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.plain for r in entry.queries()["html_plain"](spark, str(tmp_path)).collect()}
    assert got == {i: plain for i, (t, plain) in enumerate(cases.items()) if t is not None}


def test_html_plain_of_the_lake(spark):
    import pyarrow.parquet as pq

    docs = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    got = {r.doc_id: r.plain for r in entry.queries()["html_plain"](spark, "/root/testdata/sf0.01").collect()}
    assert got.keys() == {r["doc_id"] for r in docs if r["text"] is not None}
    entities = [r for r in docs if "&" in (r["text"] or "") and "<" not in r["text"]]
    assert entities and all(got[r["doc_id"]] == " ".join(unescape(r["text"]).split()) for r in entities)


def test_latest_per_entity_of_all_entities(spark):
    import duckdb

    root = "/root/testdata/sf0.001"
    sql = entry.oracle_sql()["latest_per_entity"].replace(" AND entity IN ('1', '2', '3', '5', '8')", "")
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW events AS FROM '{root}/events.parquet'")
        wanted = con.execute(sql).fetchall()
        everyone = con.execute("SELECT count(DISTINCT user_id) FROM events WHERE ts <= TIMESTAMP '2024-01-15'").fetchone()[0]
    got = entry.queries()["latest_per_entity"](spark, root).collect()
    assert sorted(map(tuple, got)) == sorted(wanted) and len(got) == everyone > 5


def test_text_snippet_of_the_newest_filing_of_any_form(spark, tmp_path):
    rows = [
        (1, "A", "8-K", "2021-01-01", "older"), (2, "A", "10-K", "2021-06-01", "newest" + "t" * 900), (3, "A", "10-Q", "2022-06-01", "later than asked"),
        (4, "B", "10-Q", "2021-02-01", "only a 10-Q"), (5, "C", "8-K", "2021-03-01", "first"), (6, "C", "8-K", "2021-03-01", "same time, greater id"),
        (7, "A", "article", "2021-12-01", "no filing"), (8, None, "10-K", "2021-12-01", "no entity"), (9, "D", "article", "2021-12-01", "no filing"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, entity string, doc_type string, day string, text string")
    df.selectExpr("*", "cast(day as timestamp) as event_time", "cast(day as timestamp) as knowledge_time").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.entity: r.excerpt for r in entry.queries()["text_snippet"](spark, str(tmp_path)).collect()}
    assert got == {"A": "newest" + "t" * 494, "B": "only a 10-Q", "C": "same time, greater id"}


def test_text_snippet_same_as_sql_of_three_forms(spark):
    import duckdb

    root = "/root/testdata/sf0.1"
    sql = entry.oracle_sql()["text_snippet"].replace("doc_type = '8-K'", "doc_type IN ('8-K', '10-K', '10-Q')")
    with duckdb.connect() as con:
        con.execute("SET TimeZone = 'UTC'")
        con.execute(f"CREATE VIEW documents AS FROM '{root}/documents.parquet'")
        wanted = {tuple(r) for r in con.execute(sql).fetchall()}
    got = entry.queries()["text_snippet"](spark, root).collect()
    assert {tuple(r) for r in got} == wanted and len(got) == len(wanted)


def test_long_tails_by_join_equal_broadcast(spark):
    from tidemark.operators.packed import split_packed

    df = spark.createDataFrame([("1", '"A, b, c, d, e, f, g";B'), ("2", "A, b, c, d, e, f, g;C"), ("3", "x, y")], "k string, f string")
    got = [sorted(map(tuple, split_packed(df, "f", ["k"], **bound).collect())) for bound in ({}, {"tail_bound": 0})]
    assert got[0] == got[1] == [("1", 1, "A, b, c, d, e, f, g"), ("1", 2, "B"), ("2", 1, "A, b, c, d, e, f, g"), ("2", 2, "C"), ("3", 1, "x"), ("3", 2, "y")]

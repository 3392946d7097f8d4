from gridpulse.llm import licenses as lic
from tools.check_oracles import compare, connect


def test_query_equals_sql(spark):
    from gridpulse.llm.queries import QUERIES, SQL

    sf = "/root/testdata/sf0.01"
    got = QUERIES["op10_license_scan"](spark, sf)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert compare(got.toPandas(), connect(sf).execute(SQL["op10_license_scan"]).df()) is None


def test_spellings_case_punctuation_and_copyright_lines(spark):
    texts = [
        "The MIT License (MIT)\n\nCopyright (c) 2020 A. Body\n\n" + lic._MIT.upper().replace("SUBLICENSE", "SUB-LICENCE"),
        "© 1999 Some One <some@one>\nAll rights reserved.\n" + lic._ISC.replace(", ", " ,  "),
        lic._ZLIB.replace("acknowledgment", "acknowledgement"),
        lic._MIT + "\nAnd one more condition.",
        "licensed under cc by-nc 4.0",
    ]
    rows = lic.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).where("unit = 'document'").collect()
    assert {r["doc_id"]: r["license"] for r in rows} == {0: "MIT", 1: "ISC", 2: "Zlib", 4: "CC-BY-NC-4.0"}


def test_odd_rows(spark, odd, none):
    assert lic.scan(odd).count() == 0 == lic.scan(none).count()
    more = odd.selectExpr("doc_id", "concat(coalesce(text, ''), '\n Released under the MIT Licence\n') AS text", "score", "source AS line", "word AS license")
    got = lic.scan(more).collect()
    assert len(got) == 12 + 3 and {r["license"] for r in got} == {"MIT"}  # the three empty texts are the line alone
    assert sum(r["doc_id"] == 1 for r in got) == 2
    assert lic.scan(odd, known=[("own", "ONE two")]).select("doc_id", "unit").collect() == [(6, "document"), (6, "line")]


def test_oracle_on_odd_rows(spark, odd):
    import duckdb

    more = odd.selectExpr("doc_id", "concat_ws('\n', text, '(c) 2020 x', '© 2021 y', 'Released under the MIT Licence') AS text")
    con = duckdb.connect()
    documents = more.toArrow()  # noqa: F841  read by name
    got, want = lic.scan(more).toArrow(), con.execute(lic.sql()).to_arrow_table()
    assert got.num_rows == 12 + 3 and compare(got.to_pandas(), want.to_pandas()) is None

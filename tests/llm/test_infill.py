"""Fill-in-the-middle: against a plain version and SQL, marks cut anywhere, texts restored."""

import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from gridpulse.llm import infill, queries

NAMES = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(doc, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i: 8 * i + 8], 16) for i in range(4))
    n = len(text)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (doc, n, "plain", None, None, sha(text), sha(text)), text
    p, m, s = text[:low], text[low:high], text[high:]
    form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return (doc, n, form, low, high - low, sha(out), sha(text)), out


def same(got, docs):
    order = lambda rows: sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, [str(v) for v in r]))
    assert order(got) == order(plain(*d)[0] for d in docs)


def texts():
    draw = random.Random(1)
    bits = ["<", "P", ">", "<P", "<S", "M>", "S>", "<M", "word ", "\U0001f926‍♂️", "é", "\n", "<<", "\x00"]
    return ["", "a", "ab", "<P>", "x<S>", "<M>y", *["".join(draw.choices(bits, k=draw.randint(1, 60))) for _ in range(300)]]


@pytest.mark.parametrize("unit", [1, 2, 3, 7, 4096])
def test_marks_cut_anywhere(spark, unit):
    docs = [*enumerate(texts()), (None, "no id"), (3, None), (9, "same"), (9, "same")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = infill.digests(df, unit=unit).select(*NAMES).collect()
    same(got, docs)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("width", [1, 2, 3, 5])
def test_marks_are_found_across_pieces(width):
    for form, order in infill.FORMS.items():
        own = {"prefix": "a<P", "middle": "M><", "suffix": "<S<"}
        whole = "".join(infill.MARKS[p] + own[p] for p in order)
        parts, found = infill.Parts(form), {}
        for at in range(0, len(whole), width):
            for part, text in parts.feed(whole[at: at + width]):
                found[part] = found.get(part, "") + text
        for part, text in parts.rest():
            found[part] = found.get(part, "") + text
        assert found == own


def test_odd_rows(odd):
    same(infill.digests(odd).select(*NAMES).collect(), [(r["doc_id"], r["text"]) for r in odd.collect()])


def test_output_texts_and_their_restoration(spark, odd):
    docs = [*enumerate(texts()), *[(r["doc_id"], r["text"]) for r in odd.collect()]]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    outputs = infill.transform(df, unit=5)
    key = lambda x: (str(x[0]), x[1])
    assert sorted(((r["doc_id"], r["output"]) for r in outputs.collect()), key=key) == sorted(((d[0], plain(*d)[1]) for d in docs), key=key)
    back = infill.restore(outputs).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in back), key=key) == sorted(((d[0], d[1] or "") for d in docs), key=key)


def test_one_id_on_a_third_of_the_rows(spark):
    docs = [(7 if i % 3 else i, f"text {i % 5}") for i in range(900)]
    same(infill.digests(spark.createDataFrame(docs, "doc_id long, text string")).select(*NAMES).collect(), docs)


def test_a_single_shuffle(odd):
    plan = infill.digests(odd)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_no_rows(none):
    assert infill.digests(none).collect() == [] and infill.transform(none).collect() == []


def test_query_against_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    want = con.execute(f"select {', '.join(NAMES)} from ({queries.SQL['op12_infill']}) order by doc_id").fetchall()
    got = [tuple(r) for r in queries.QUERIES["op12_infill"](spark, sf).select(*NAMES).orderBy("doc_id").collect()]
    assert got == want and len(got) == 200


def test_shares_of_forms(spark):
    got = infill.cut(spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("abcdef").alias("text"))).groupBy("form").count().collect()
    n = {r["form"]: r["count"] / 20_000 for r in got}
    assert abs(n["plain"] - 0.1) < 0.01 and abs(n["spm"] - 0.18) < 0.01

import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from delaynet.llm import secret_ledger
from delaynet.llm.secret_ledger import Rule, scan, summary
from delaynet.session import scratch_path
from answers import plain

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{('assign', 'access', 'hex')[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def secretive(n, seed=3):
    """Texts made of parts of secrets, so that matches meet, nest and fail in all ways."""
    rng = random.Random(seed)
    parts = [
        "password", "PassWd", "secret", "Token", "api_key", "APIKEY", ":", "=", " = ", '": "', "'", " ", "abcde", "abcdef", "AKIA", "A1B2C3D4E5F6G7H8",
        "0123456789abcdef", "deadbeef", "ſecret", "toKen", "東京", "😀", "\n", "x",
    ]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(n)]


@pytest.fixture(scope="module")
def versions(spark):
    texts = [None, "", "token=token=abcdef", "password: token:abcdef", "😀" * 50 + " secret=abcdefg", *secretive(400)]
    rows = [(i % 390, text, i) for i, text in enumerate(texts)] + [(5, texts[4], 9)] * 30 + [(None, texts[4], 1)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, spans int").repartition(5)


def lines(df):
    return plain(summary(df), "doc_id", "spans")


def wanted(versions):
    rows = [(r.doc_id, brute(r.text)) for r in versions.collect()]
    return sorted(rows, key=lambda row: [(v is not None, str(type(v)), v) for v in row])


def test_against_brute_force_and_with_big_tables_joined(spark, versions):
    for small, hot in ((500_000, 100_000), (0, 4)):
        assert lines(scan(versions, scratch_path(spark, "ledger"), small_rows=small, hot_copies=hot)) == wanted(versions)


def test_only_unseen_pairs_are_scanned(spark, versions):
    ledger = scratch_path(spark, "ledger")
    half = versions.filter("doc_id % 2 = 0")
    scan(half, ledger)
    blobs = half.select(secret_ledger.address(half.text)).distinct().count()
    assert spark.read.parquet(ledger).count() == 3 * blobs
    marked = spark.read.parquet(ledger).inputFiles()
    assert lines(scan(versions, ledger)) == wanted(versions)
    assert lines(scan(versions, ledger)) == wanted(versions)  # nothing is due
    pairs = spark.read.parquet(ledger).select("blob", "rule")
    assert pairs.count() == pairs.distinct().count() == 3 * versions.select(secret_ledger.address(versions.text)).distinct().count()
    assert set(marked) < set(spark.read.parquet(ledger).inputFiles())  # what was written stays as it was

    changed = (*secret_ledger.RULES[:2], Rule("hex", "[0-9a-f]{8,}", version=2))
    found = scan(versions, ledger, changed)
    assert spark.read.parquet(ledger).select("blob", "rule").count() == pairs.distinct().count() * 4 // 3
    eight = {(m.start(), m.end()) for text in [r.text or "" for r in versions.collect()] for m in re.finditer("[0-9a-f]{8,}", text)}
    assert {(s.begin, s.end) for r in found.collect() for s in r.spans if s.kind == "hex"} == eight


def test_awkward_and_empty_tables(spark, awkward, no_documents):
    assert lines(scan(awkward, scratch_path(spark, "ledger"))) == wanted(awkward)
    ledger = scratch_path(spark, "ledger")
    assert scan(no_documents, ledger).collect() == []
    assert scan(no_documents, ledger).collect() == []


def test_query_against_sql(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = summary(scan(docs, scratch_path(spark, "ledger")))
    with duckdb.connect() as db:
        db.sql(f"CREATE VIEW documents AS FROM '{sf_dir}/documents.parquet'")
        rows = db.sql(secret_ledger.SUMMARY_SQL)
        assert rows.columns == found.columns
        assert sorted(rows.fetchall()) == plain(found)


def test_sql_on_nested_matches(spark, versions):
    with duckdb.connect() as db:
        documents = versions.toPandas()  # noqa: F841
        rows = db.sql(secret_ledger.SUMMARY_SQL).fetchall()
    assert sorted(row[-1] for row in rows) == sorted(line for _, line in wanted(versions))


def test_no_python_in_the_plans(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = docs.select(secret_ledger.address(F.col("text")).alias("blob"), "text", F.array(F.lit("hex@1")).alias("due"))
    for df in (secret_ledger.find(texts), summary(scan(docs, scratch_path(spark, "ledger")))):
        plan = df._jdf.queryExecution().toString()
        assert not any(name in plan for name in ("Python", "Arrow", "MapInPandas", "ExistingRDD"))

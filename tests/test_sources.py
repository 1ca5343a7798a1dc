import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from delaynet import session
from delaynet.plans import catalog
from delaynet.schema import FLIGHT_SCHEMA, RAW_COLUMNS
from delaynet.session import materialize, shared_folder
from delaynet.sources import files, logs, messages
from delaynet.streaming import ingest


def test_csv_columns_go_by_name(spark, tmp_path):
    (tmp_path / "jan.csv").write_text("ORIGIN,EXTRA,DEST,DEP_DELAY\nATL,x,ORD,5\n,y,DFW,\n")
    (tmp_path / "feb.csv").write_text("DEP_DELAY,DEST,ORIGIN\n7,LAX,SFO\n")
    raw = files.read_raw_csv(spark, str(tmp_path / "jan.csv"), str(tmp_path / "feb.csv"))
    assert raw.columns == [*RAW_COLUMNS, "source_file"]
    got = {(r.ORIGIN, r.DEST, r.DEP_DELAY, Path(r.source_file).name) for r in raw.collect()}
    assert got == {("ATL", "ORD", "5", "jan.csv"), (None, "DFW", None, "jan.csv"), ("SFO", "LAX", "7", "feb.csv")}


FLIGHT = ("A|B|AA|1|2024-1-1|5", "", 1, "A", "B", "2024-01-01T00:05:00", 3, "nas")


def test_message_round_trip(spark):
    rows = spark.createDataFrame([FLIGHT], FLIGHT_SCHEMA)
    sent = messages.keyed_messages(rows)
    assert sent.first().key == "flight-A|B|AA|1|2024-1-1|5"
    assert messages.decode_json(sent).select(*FLIGHT_SCHEMA.names).first() == rows.first()


@pytest.mark.parametrize("value, bad", [('{"flight_id":"x","delay_minutes":1}', False), ('{"flight_id":"x"', True), ("junk", True), ('{"origin":"A"}', True), ("", True), (None, True)])
def test_quarantine(spark, value, bad):
    decoded = messages.decode_json(spark.createDataFrame([(value,)], "value string"))
    assert decoded.select(messages.is_quarantined()).first()[0] is bad


def test_report_is_one_bounded_file(spark, tmp_path):
    rows = spark.range(1000).select("id", (-F.col("id")).alias("x"))
    files.write_report(rows, str(tmp_path / "r"), [F.desc("id")], 5)
    parts = list((tmp_path / "r").glob("*.csv"))
    assert len(parts) == 1
    assert parts[0].read_text().splitlines() == ["id,x", "999,-999", "998,-998", "997,-997", "996,-996", "995,-995"]


def test_results_are_replaced(spark, tmp_path):
    for n in (5, 2):
        files.write_results({"t": spark.range(n)}, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "t.parquet")).count() == 2


def test_materialized_table_is_under_the_shared_folder(spark):
    table = materialize(spark.range(3), "three")
    assert table.count() == 3 and all(shared_folder(spark) in path for path in table.inputFiles())


RUN_LOG = """--- Timing (seconds) ---
Spark Streaming ETL:  ~23400s (~6.5 hours)
Records accepted:     6098055
ETL Throughput:       ~260.5 records/sec
Curated Parquet:      {size}
Records accepted:     1
"""


def test_run_metrics(spark, tmp_path):
    for name, size in (("a", "129M"), ("b", "512K"), ("c", "2G"), ("d", "N/A")):
        (tmp_path / f"{name}.log").write_text(RUN_LOG.format(size=size))
    lines = logs.read_log_lines(spark, str(tmp_path))
    got = {Path(r.source).stem: r for r in logs.run_metrics(lines).collect()}
    assert {k: r.parquet_mb for k, r in got.items()} == {"a": 129.0, "b": 0.5, "c": 2048.0, "d": None}
    assert (got["a"].records, got["a"].throughput, got["a"].etl_seconds) == (6098055.0, 260.5, 23400.0)


def test_sweeps_start_at_their_marker(spark, tmp_path):
    (tmp_path / "p.log").write_text("1.0 | 9.0\n[B] Sweeping Privacy Budgets (x)\nhead | er\n0.01   | 100.5\n0.10 | 9.95\n")
    (tmp_path / "q.log").write_text("0.5 | 2.0\n[C] Sweeping CMS Width (Memory)\n10   | 200   | 55.25\n50 | 1000 | 3\n7 | 8\n")
    lines = logs.read_log_lines(spark, str(tmp_path))
    assert sorted((r.parameter, r.error) for r in logs.sweep_rows(lines, "epsilon").collect()) == [(0.01, 100.5), (0.1, 9.95)]
    assert sorted((r.parameter, r.error) for r in logs.sweep_rows(lines, "cms_width").collect()) == [(10.0, 55.25), (50.0, 3.0)]


def test_stream_session_has_its_own_settings(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert ingest.stream_session(spark, 3).conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_curated_table_grows_by_appending(spark, tmp_path):
    rows = spark.createDataFrame([FLIGHT, (*FLIGHT[:3], None, *FLIGHT[4:]), (*FLIGHT[:3], "", *FLIGHT[4:])], FLIGHT_SCHEMA)
    for _ in range(2):
        files.append_curated(rows, str(tmp_path / "c"))
    assert sorted(r.origin for r in files.read_curated(spark, str(tmp_path / "c")).collect()) == ["", "", "A", "A"]


@pytest.mark.parametrize("absent", ["xxhash", "tokenizers", "delaynet.llm", "corpus_pipeline"])
def test_entry_loads_without_the_corpus_part(absent):
    code = f"import sys; sys.modules[{absent!r}] = None; import __spark_entry__ as e; print(len(e.queries()), 'route_edges' in e.oracle_sql())"
    root = Path(__file__).resolve().parents[1]
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) == len(catalog.QUERIES) and out[1] == "True"


def test_release_drops_bucketed_tables(spark):
    own = spark.newSession()
    before = {t.name for t in own.catalog.listTables()}
    kept = set(session._TABLES)
    session._TABLES.clear()
    session.bucketed(own.range(10), "links", 2, "id")
    assert len({t.name for t in own.catalog.listTables()} - before) == len(session._TABLES) == 1
    folders, folder = session._own_folder, session.scratch_path(own, "released")
    session._own_folder = lambda _: folder  # other tests still read theirs
    try:
        session.release(own)
    finally:
        session._own_folder = folders
        session._TABLES.update(kept)
    assert {t.name for t in own.catalog.listTables()} == before


def test_scratch_on_a_cluster_is_not_on_this_machine():
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    def folder(master, **conf):
        made = type("Session", (), {"conf": Conf(conf), "sparkContext": type("Context", (), {"master": master})})
        return session.shared_folder(made)

    assert folder("yarn", **{"spark.checkpoint.dir": "hdfs://x/y/"}) == "hdfs://x/y"
    assert folder("local[2]", **{"spark.sql.warehouse.dir": "file:/w"}) == "file:/w/_scratch"
    assert folder("yarn", **{"spark.sql.warehouse.dir": "s3a://b/w"}) == "s3a://b/w/_scratch"
    with pytest.raises(ValueError):
        folder("spark://host:7077", **{"spark.sql.warehouse.dir": "file:/w"})


def test_malformed_lines_are_set_aside(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "jan.csv").write_text("ORIGIN,EXTRA,DEST\nATL,x,ORD\nSFO,y\nLAX,z,JFK,more\n,,\n\n")
    (tmp_path / "in" / "feb.csv").write_text('ORIGIN,EXTRA,DEST\n"A,B",q,ORD\nonly\n')
    aside = str(tmp_path / "aside")
    good = files.ingest_csv(spark, aside, str(tmp_path / "in"))
    assert good.columns == [*RAW_COLUMNS, "source_file"]
    assert sorted((r.ORIGIN or "", r.DEST or "") for r in good.collect()) == [("", ""), ("A,B", "ORD"), ("ATL", "ORD")]
    bad = spark.read.parquet(aside).orderBy("source_file", "position").collect()
    assert [(Path(r.source_file).name, r.raw) for r in bad] == [("feb.csv", "only"), ("jan.csv", "SFO,y"), ("jan.csv", "LAX,z,JFK,more")]
    files.ingest_csv(spark, aside, str(tmp_path / "in" / "feb.csv"))
    assert spark.read.parquet(aside).count() == 4

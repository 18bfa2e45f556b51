import json
import sqlite3

import pytest

from spanloom import cli
from spanloom.config import Config, load_config
from spanloom.operators import assembly, metrics, sinks, tagging
from spanloom.schemas import OUTPUT_ROW
from spanloom.sources import keyset, tables
from spanloom.sources.files import Files
from spanloom.streaming import extract as stream

ROWS = [(1, "LOC", 'a|"b"', 0.5, 0, 3), (2, "PER", "x\ny", 0.25, 1, 2), (3, "ORG", " padded ", 1.0, 0, 1), (4, "MISC", "Нева, «Мир»", 0.1, 5, 9)]


@pytest.mark.parametrize("format", ["csv", "parquet"])
def test_rows_come_back(spark, tmp_path, format):
    path = str(tmp_path / "rows")
    df = spark.createDataFrame(ROWS, OUTPUT_ROW)
    sinks.write_rows(df, path, format)
    back = sinks.read_rows(spark, path, OUTPUT_ROW) if format == "csv" else spark.read.parquet(path)
    assert sorted(map(tuple, back.collect())) == ROWS
    sinks.write_rows(df, path, format)
    assert spark.read.format(format).option("header", "true").option("sep", "|").option("multiLine", "true").load(path).count() == 8
    with pytest.raises(ValueError):
        sinks.write_rows(df, path, "xml")


def test_output_defaults(spark):
    df = spark.createDataFrame([(1, None, "t", None, None, None)], "doc_id long, type string, text string, confidence double, start_pos int, end_pos int")
    assert tuple(assembly.output_rows(df).first()) == (1, "MISC", "t", 0.5, 0, 0)
    assert assembly.output_rows(df, False, False).columns == ["doc_id", "entity_type", "entity_text"]


@pytest.fixture
def database(tmp_path):
    path = str(tmp_path / "db")
    con = sqlite3.connect(path)
    con.execute("CREATE TABLE docs (id INTEGER, content TEXT)")
    con.executemany("INSERT INTO docs VALUES (?, ?)", [(i * 3, f"Text {i}" if i % 5 else None) for i in range(1, 41)])
    con.commit()
    con.close()
    return {"module": "sqlite3", "connect": json.dumps({"database": path}), "table": "docs", "batch_size": "7", "partitions": "3"}


def test_keyset_source(spark, database):
    keyset.register(spark)
    rows = spark.read.format("keyset").options(**database).load()
    assert sorted(r.id for r in rows.collect()) == [i * 3 for i in range(1, 41)]
    assert tables.documents(rows).count() == 32
    assert spark.read.format("keyset").options(**database, last_id="60").load().count() == 20
    assert spark.read.format("keyset").options(**database, last_id="600").load().count() == 0


def test_keyset_stream_goes_on_after_the_last_key(spark, database, tmp_path):
    def run():
        docs = stream.keyset_documents(spark, **database)
        stream.start(docs, str(tmp_path / "rows"), str(tmp_path / "checkpoint"), min_confidence=0.0).awaitTermination()
        return sorted(r.doc_id for r in spark.read.parquet(str(tmp_path / "rows")).select("doc_id").distinct().collect())

    first = run()
    con = sqlite3.connect(json.loads(database["connect"])["database"])
    con.execute("INSERT INTO docs VALUES (1000, 'Another Text here')")
    con.commit()
    assert run() == [*first, 1000]
    assert run() == [*first, 1000]


def test_plain_names_only(spark, database):
    keyset.register(spark)
    with pytest.raises(Exception, match="plain name"):
        spark.read.format("keyset").options(**database | {"table": "docs; drop"}).load().count()


def test_text_column(spark):
    table = spark.createDataFrame([(1, 2, "t", "u")], "id long, n long, role string, text string")
    assert tables.text_column(table, "id") == "role"
    assert tables.text_column(table, "id", "text") == "text"
    with pytest.raises(ValueError):
        tables.text_column(table.select("id", "n"), "id")


def test_state(spark, tmp_path):
    files, path = Files(spark), str(tmp_path / "c" / "state.json")
    assert metrics.load_state(files, path) is None
    stats = {"documents": 42, "total_entities": 3, "entities_by_type": {"LOC": 3}, "seconds": 1.0}
    metrics.save_state(files, path, 100500, 42, stats, "1")
    state = metrics.save_state(files, path, 7, 3, stats | {"entities_by_type": {"PER": 1}}, "1")
    assert (state["last_id"], state["processed"], state["stats"]["documents"], state["stats"]["entities_by_type"]) == (100500, 45, 84, {"LOC": 3, "PER": 1})
    assert metrics.load_state(files, path) == state
    (tmp_path / "c" / "state.json").unlink()  # as if a write had been cut short between its two renames
    (tmp_path / "c" / ".state.json.crc").unlink(missing_ok=True)
    assert metrics.load_state(files, path)["processed"] == 42
    (tmp_path / "c" / "state.json").write_text("{not json")
    assert metrics.load_state(files, path) is None


def test_config(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("model: {max_tokens: 64, unknown: 1}\ngpu_devices: [{device_id: 1}]\noutput: {enable_expansion: true, expansion_params: {enable_stopwords: false, other: 2}}\n")
    config = load_config(str(path))
    assert config.model.max_tokens == 64 and config.devices[0].device_id == 1 and config.workers == 4
    assert config.output.expansion.enable_stopwords is False and config.output.expansion.max_search_left == 30
    assert Config.from_dict({}).output.enable_expansion is False and Config.from_dict({"tokenizer": {"num_workers": 7}, "logging": {"verbose": True}}).workers == 7
    with pytest.raises(FileNotFoundError):
        load_config(str(tmp_path / "none"))
    assert cli.main(["--config", str(tmp_path / "none")]) == 1


TEXTS = [(i, f"Meeting Peter {i} in London") for i in range(1, 9)]


@pytest.fixture
def settings(spark, tmp_path):
    docs = str(tmp_path / "docs")
    spark.createDataFrame(TEXTS, "doc_id long, text string").write.parquet(docs)
    return {"source": {"table": docs}, "output": {"path": str(tmp_path / "out"), "format": "parquet"}, "checkpoint": {"file": str(tmp_path / "check")}, "model": {"min_confidence": 0.0}}


def rows_of(spark, settings):
    return sorted(map(tuple, spark.read.parquet(settings["output"]["path"]).collect()))


def test_command_line_run_and_resume(spark, settings):
    config = Config.from_dict(settings)
    first = cli.run(spark, config, limit=3)
    assert first["last_id"] == 3 and first["stats"]["documents"] == 3
    state = cli.run(spark, config, resume=True)
    assert (state["last_id"], state["processed"]) == (8, 8)
    rows = rows_of(spark, settings)
    assert {r[0] for r in rows} == set(range(1, 9))
    stats = state["stats"]
    assert stats["documents"] == stats["chunks"] == 8 and stats["total_entities"] == len(rows) == sum(stats["entities_by_type"].values())
    assert {"tokens", "long_documents", "seconds", "documents_per_second", "chunks_per_second"} <= set(stats)
    assert cli.run(spark, config, resume=True)["processed"] == 8 and rows_of(spark, settings) == rows
    assert cli.run(spark, config)["processed"] == 8 and rows_of(spark, settings) == rows


def test_a_run_that_is_cut_short_leaves_no_row_twice(spark, settings, monkeypatch):
    config = Config.from_dict(settings)
    cli.run(spark, config, limit=3)
    monkeypatch.setattr(metrics, "save_state", lambda *a: (_ for _ in ()).throw(RuntimeError("cut short")))
    with pytest.raises(RuntimeError):
        cli.run(spark, config, resume=True)
    monkeypatch.undo()
    assert len(rows_of(spark, settings)) > 0
    assert cli.run(spark, config, resume=True)["processed"] == 8
    rows = rows_of(spark, settings)
    assert rows == sorted(set(rows)) and {r[0] for r in rows} == set(range(1, 9))
    assert cli.run(spark, config, resume=True)["processed"] == 8 and rows_of(spark, settings) == rows


def test_command_line_over_a_database(spark, database, settings, tmp_path):
    source = {"type": "keyset", "module": "sqlite3", "connect": json.loads(database["connect"]), "table": "docs", "batch_size": 7, "partitions": 3}
    config = Config.from_dict(settings | {"source": source, "model": {"min_confidence": 0.0, "tokenizer": ""}})
    assert cli.run(spark, config, limit=10)["last_id"] == 36
    state = cli.run(spark, config, resume=True)
    assert (state["last_id"], state["processed"]) == (117, 32)
    assert len({r[0] for r in rows_of(spark, settings)}) == 32


def test_lost_connections_are_taken_up_after_the_last_row(database, tmp_path, monkeypatch):
    (tmp_path / "flaky.py").write_text(
        "import sqlite3\nopen_, asked, fail = [0], [0], {2, 3, 6}\n"
        "class Cursor:\n"
        "    def __init__(self, c): self.c = c\n"
        "    def execute(self, q):\n"
        "        asked[0] += 1\n"
        "        if asked[0] in fail: raise OSError('lost')\n"
        "        return self.c.execute(q)\n"
        "    def __getattr__(self, n): return getattr(self.c, n)\n"
        "class Connection:\n"
        "    def __init__(self, **a): self.c = sqlite3.connect(**a); open_[0] += 1\n"
        "    def cursor(self): return Cursor(self.c.cursor())\n"
        "    def close(self): self.c.close(); open_[0] -= 1\n"
        "connect = Connection\n"
    )
    monkeypatch.syspath_prepend(str(tmp_path))
    import flaky

    table = keyset._Table(database | {"module": "flaky", "retry_wait": "0"})
    assert [i for i, _ in table.rows(0, 120)] == [i * 3 for i in range(1, 41)]
    left = flaky.open_[0]
    reader = table.rows(0, 120)
    next(reader)
    reader.close()  # given up
    assert flaky.open_[0] == left
    flaky.fail.update(range(0, 1000))
    with pytest.raises(OSError):
        list(table.rows(0, 120))


def test_progress_version_and_devices(spark, monkeypatch):
    with cli.Progress(spark, every=0.01) as progress:
        spark.range(100).count()
    assert progress.done.is_set() and isinstance(progress.lines(), list)
    assert cli.version().startswith(cli.__version__)
    assert tagging.device_of_task([3, 5]) == 3
    from pyspark.sql import functions as F

    ask = F.udf(lambda _: tagging.device_of_task([3, 5]), "int")
    assert {r[0] for r in spark.range(0, 8, 1, 4).select(ask("id")).collect()} == {3, 5}


def test_signals_cancel_jobs_and_leave_the_state(spark, settings, monkeypatch):
    import os
    import signal

    before = {s: signal.getsignal(s) for s in (signal.SIGINT, signal.SIGTERM)}
    try:
        asked = cli.stopped_by_signals(spark)
        os.kill(os.getpid(), signal.SIGTERM)
        assert asked.wait(5)
    finally:
        for s, handler in before.items():
            signal.signal(s, handler)
    assert spark.range(3).count() == 3


def test_library_functions(spark):
    import spanloom

    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    assert spanloom.extract(docs, min_confidence=0.0).count() > 0
    with pytest.raises(AttributeError):
        spanloom.other  # noqa: B018

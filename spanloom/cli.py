"""``python -m spanloom.cli --config FILE [--resume] [--limit N] [--version]``: run the extraction plan by its settings.

A run appends its rows and then moves the state on. Before it writes, the state says which files were there; a run that was cut short
leaves that note, and the next one takes the files back that came after it, so that no row is written twice and none is left out.
"""

from __future__ import annotations

import argparse
import json
import logging
import signal
import subprocess
import sys
import threading
import time
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession

from spanloom import __version__
from spanloom.config import Config, load_config
from spanloom.operators import chunking, metrics, sinks, tagging
from spanloom.plans.extract import extract
from spanloom.sources import keyset, tables
from spanloom.sources.files import Files

log = logging.getLogger("spanloom")


def tagger(config: Config):
    """The backend that the settings name: ``rule``, or a token-classification model on as many devices as they list."""
    if config.model.name == "rule":
        return tagging.rule
    first = config.devices[0] if config.devices else None
    ids = [d.device_id for d in config.devices] or [-1]
    make = tagging.transformers_model(config.model.name, ids, bool(first) and first.precision == "float16")
    return lambda chunks: tagging.from_model(chunks, make, first.batch_size if first else 32)


def plan_options(config: Config) -> dict:
    return {
        "expand": config.output.enable_expansion,
        "config": config.output.expansion,
        "confidence": config.output.include_confidence,
        "positions": config.output.include_positions,
        "max_tokens": config.model.max_tokens,
        "overlap_ratio": config.model.overlap_ratio,
        "min_confidence": config.model.min_confidence,
        "tagger": tagger(config),
        "tokens": chunking.tokenizer_tokens(config.model.tokenizer) if config.model.tokenizer else chunking.tokens,
    }


def documents(spark: SparkSession, config: Config, last_id: int = 0) -> DataFrame:
    """(doc_id, text) of the configured source past an id."""
    s = config.source
    if s.type in ("keyset", "mysql"):
        keyset.register(spark)
        own = {"host": s.host, "port": s.port, "user": "root", "charset": "utf8mb4", "connect_timeout": s.connection_timeout, "read_timeout": s.connection_timeout} if s.module == "pymysql" else {}
        table = spark.read.format("keyset").options(module=s.module, connect=json.dumps(own | s.connect), table=s.table, batch_size=s.batch_size, partitions=s.partitions, last_id=last_id).load()
    elif s.type == "jdbc":
        table = spark.read.format("jdbc").options(dbtable=s.table, fetchsize=s.batch_size, **s.connect).load()
    else:
        table = spark.read.format(s.type).options(**s.connect).load(s.table)
    id_column = next((c for c in ("doc_id", "id") if c in table.columns), table.columns[0])
    return tables.after(tables.documents(table, id_column, "content" if "content" in table.columns else "text"), last_id)


def run(spark: SparkSession, config: Config, resume: bool = False, limit: int | None = None) -> dict:
    """One run; returns the state it leaves. Without ``resume`` the results and the state start anew."""
    files, state, note = Files(spark), f"{config.checkpoint}/state.json", f"{config.checkpoint}/started.json"
    out = config.output
    if not resume:
        for name in (state, f"{state}.old", note, f"{note}.old"):
            files.delete(name)
    old = metrics.load_state(files, state) or {}
    if resume and (text := files.read(note)):
        started = json.loads(text)
        if started["last_id"] == old.get("last_id", 0):  # that run's rows were not counted: they are written anew
            for name in files.data(out.path) - set(started["files"]):
                files.delete(f"{out.path}/{name}")
    docs = documents(spark, config, old.get("last_id", 0))
    docs = tables.spread(docs, config.workers) if limit is None else docs.orderBy("doc_id").limit(limit).repartition(config.workers)
    there = sorted(files.data(out.path)) if resume else []
    files.write(note, json.dumps({"last_id": old.get("last_id", 0), "files": there}))
    seen, made = Observation("documents"), Observation("chunks")
    began = time.perf_counter()
    rows = extract(metrics.observed_docs(docs, seen), seen=made, **plan_options(config))
    with Progress(spark):
        sinks.write_rows(rows, out.path, out.format, out.delimiter, "append" if resume else "overwrite")
    stats = metrics.final_stats(seen.get, made.get, time.perf_counter() - began)
    log.info("%s", json.dumps(stats))
    return metrics.save_state(files, state, seen.get["last_id"], seen.get["documents"], stats, __version__)


class Progress:
    """Says every so many seconds how far the running stages are."""

    def __init__(self, spark: SparkSession, every: float = 30.0):
        self.tracker, self.every, self.done = spark.sparkContext.statusTracker(), every, threading.Event()
        self.thread = threading.Thread(target=self.watch, daemon=True)

    def lines(self) -> list[str]:
        found = (self.tracker.getStageInfo(k) for k in self.tracker.getActiveStageIds())
        return [f"stage {s.stageId}: {s.numCompletedTasks} of {s.numTasks} tasks, {s.numActiveTasks} running, {s.numFailedTasks} failed" for s in found if s]

    def watch(self) -> None:
        while not self.done.wait(self.every):
            for line in self.lines():
                log.info("%s", line)

    def __enter__(self) -> Progress:
        self.thread.start()
        return self

    def __exit__(self, *_) -> None:
        self.done.set()
        self.thread.join(1)


def version() -> str:
    """The package's version, and the commit if it runs from a checkout."""
    try:
        found = subprocess.run(["git", "rev-parse", "--short", "HEAD"], cwd=Path(__file__).parent, capture_output=True, text=True, timeout=5)
    except (OSError, subprocess.SubprocessError):
        return __version__
    return f"{__version__} ({found.stdout.strip()})" if found.returncode == 0 else __version__


def stopped_by_signals(spark: SparkSession) -> threading.Event:
    """On SIGINT and SIGTERM running jobs are cancelled; the state stays as it was, and the next run takes up there."""
    asked = threading.Event()

    def stop(number, frame) -> None:
        asked.set()
        log.warning("stopping on signal %s", number)
        spark.sparkContext.cancelAllJobs()

    for number in (signal.SIGINT, signal.SIGTERM):
        signal.signal(number, stop)
    return asked


def logged(config: Config, file: str = "spanloom.log") -> None:
    logging.basicConfig(level=logging.DEBUG if config.verbose else logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s", handlers=[logging.StreamHandler(), logging.FileHandler(file, encoding="utf-8")], force=True)
    logging.getLogger("py4j").setLevel(logging.WARNING)


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="spanloom")
    parser.add_argument("--config", default="config.yaml")
    parser.add_argument("--resume", action="store_true")
    parser.add_argument("--limit", type=int)
    parser.add_argument("--log", default="spanloom.log")
    parser.add_argument("-v", "--version", action="version", version=version())
    given = parser.parse_args(arguments)
    try:
        config = load_config(given.config)
    except FileNotFoundError:
        print(f"no such file: {given.config}", file=sys.stderr)
        return 1
    logged(config, given.log)
    spark = SparkSession.builder.getOrCreate()
    asked = stopped_by_signals(spark)
    try:
        print(json.dumps(run(spark, config, given.resume, given.limit), ensure_ascii=False))
    except Exception:
        if not asked.is_set():
            raise
        return 130
    return 0


if __name__ == "__main__":
    sys.exit(main())

"""Files of the driver: settings, prompt templates, documents of JSON, the state of a run; and sinks of JSON lines."""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def overwrite_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_table(df: DataFrame, path: str) -> None:
    """A table in place of the one before."""
    df.write.mode("overwrite").parquet(path)


def write_vectors(df: DataFrame, path: str) -> None:
    """(id, vec) as a table of its own; a row's place means nothing."""
    df.select("id", F.col("vec").cast("array<float>").alias("vec")).write.mode("overwrite").parquet(path)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("id string, vec array<float>").parquet(path) if not Path(path).exists() else spark.read.parquet(path)


def reference_sample(rows: DataFrame, n: int, order: list[str]) -> DataFrame:
    """(query, short_answer, hop_count) of the first n rows: empty or missing columns give way to the second name, a
    missing count is 2."""
    have = lambda c: F.nullif(F.col(c).cast("string"), F.lit("")) if c in rows.columns else F.lit(None).cast("string")
    pick = lambda *names: F.coalesce(*[have(c) for c in names], F.lit(""))
    hops = F.coalesce(F.col("hop_count").cast("long"), F.lit(2).cast("long")) if "hop_count" in rows.columns else F.lit(2).cast("long")
    return rows.orderBy(*order).limit(n).select(*order, pick("question", "query").alias("query"), pick("answer", "short_answer").alias("short_answer"), hops.alias("hop_count"))


def write_json(path: str | Path, value: object) -> None:
    """Write a document whole or not at all."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    new = path.with_name(path.name + ".new")
    new.write_text(json.dumps(value, indent=2), encoding="utf-8")
    os.replace(new, path)


def read_json(path: str | Path) -> dict:
    """The document, empty if there is none."""
    return json.loads(Path(path).read_text(encoding="utf-8")) if Path(path).exists() else {}


def merged(base: dict, over: dict) -> dict:
    """Both settings, those of `over` first, at any depth."""
    return base | {k: merged(base[k], v) if isinstance(v, dict) and isinstance(base.get(k), dict) else v for k, v in over.items()}


def settings(folder: str | Path, name: str) -> dict:
    """Settings of a JSON or YAML file; `extends` names one in the folder that they go over, itself not extended."""

    def load(path: Path) -> dict:
        text = path.read_text(encoding="utf-8")
        if path.suffix == ".json":
            return json.loads(text)
        import yaml

        return yaml.safe_load(text) or {}

    folder, stem = Path(folder), Path(name).stem
    own = load(next(p for p in (folder / f"{stem}{x}" for x in (".json", ".yaml", ".yml")) if p.exists()))
    if "extends" not in own:
        return own
    return merged(load(folder / own["extends"]), {k: v for k, v in own.items() if k != "extends"})


def template(folder: str | Path, name: str) -> str:
    return (Path(folder) / f"{name}.txt").read_text(encoding="utf-8")


class Run:
    """The phases of a run in a file: pending, running, done or failed, with their times. Opening it again keeps it."""

    def __init__(self, path: str | Path, phases: list[str], name: str = "run"):
        self.path = Path(path)
        if not self.path.exists():
            write_json(self.path, {"run": name, "started": self._now(), "phases": {p: {"status": "pending"} for p in phases}})

    @staticmethod
    def _now() -> str:
        return time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())

    def state(self) -> dict:
        return read_json(self.path)

    def _set(self, phase: str, **values) -> None:
        s = self.state()
        s["phases"].setdefault(phase, {}).update(values)
        write_json(self.path, s)

    def phase(self, name: str, work):
        """Run work() as a phase; its dict is kept with the phase. A failure is noted and raised."""
        began = time.time()
        self._set(name, status="running", start=self._now())
        try:
            got = work()
        except Exception as e:
            self._set(name, status="failed", error=f"{type(e).__name__}: {e}", seconds=round(time.time() - began, 3))
            raise
        self._set(name, status="done", end=self._now(), seconds=round(time.time() - began, 3), **(got if isinstance(got, dict) else {}))
        return got

    def decide(self, gates: list[dict], decision: str) -> None:
        s = self.state()
        s["quality_gates"], s["escalation_decision"] = gates, decision
        write_json(self.path, s)

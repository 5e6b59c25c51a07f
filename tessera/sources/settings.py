"""Settings: a JSON document, overridden by environment variables for a fixed set of integers; layouts as tables."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession

PREFIX = "TESSERA_"


@dataclass(frozen=True)
class Settings:
    first_year: int = 2019
    last_year: int = 2025
    work_seconds: int = 19_800
    checkpoint_seconds: int = 900
    batch_size: int = 20
    pack_size: int = 100
    least_pack: int = 5
    failure_limit: int = 6

    def in_range(self, year: int) -> bool:
        return self.first_year <= year <= self.last_year


def load_settings(text: str = "{}", env: dict[str, str] | None = None) -> Settings:
    env = os.environ if env is None else env
    got = {k: v for k, v in json.loads(text).items() if k in {f.name for f in fields(Settings)}}
    for f in fields(Settings):
        raw = env.get(PREFIX + f.name.upper(), "").strip()
        if raw.lstrip("-").isdigit():
            got[f.name] = int(raw)
    return Settings(**got)


def layout_tables(spark: SparkSession, document: dict) -> tuple[DataFrame, DataFrame, DataFrame]:
    """kind(kind, number, exam, includes, excludes), rule(kind, rule_no, years, lengths), span(kind, rule_no, number,
    subject, start, end) of a layout document {exams: [{code, kinds: [{id, includes, excludes, rules: [{years, lengths,
    spans: [[subject, start, end]]}]}]}]}."""
    kinds, rules, spans = [], [], []
    for exam in document.get("exams", []):
        for kind in exam.get("kinds", []):
            kinds.append((kind["id"], len(kinds), exam["code"], kind.get("includes", []), kind.get("excludes", [])))
            for r, rule in enumerate(kind.get("rules", [])):
                rules.append((kind["id"], r, rule.get("years"), rule.get("lengths")))
                spans += [(kind["id"], r, k, *s) for k, s in enumerate(rule.get("spans", []))]
    return (
        spark.createDataFrame(kinds, "kind string, number int, exam string, includes array<string>, excludes array<string>"),
        spark.createDataFrame(rules, "kind string, rule_no int, years array<int>, lengths array<int>"),
        spark.createDataFrame(spans, "kind string, rule_no int, number int, subject string, start int, end int"),
    )

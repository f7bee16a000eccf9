"""Working stage by stage: settings change between stages, and only what they make stale is forgotten."""

from __future__ import annotations

import yaml
from pyspark.sql import DataFrame, SparkSession

from citeloom.plans import files, stages
from citeloom.plans.config import Config, as_dict, from_dict


class Session:
    """A run that a person drives: set_section, run_stage, table, save_summary.  Stages do not start each other here."""

    def __init__(self, spark: SparkSession, root: str, config: Config | None = None):
        config = config or Config()
        self.ctx = stages.Context(spark, config, stages.run_folder(spark, root, config.run.name))

    def set_section(self, section: str, **values) -> str | None:
        """Change settings of a section; the earliest stage that they make stale, if any."""
        held = as_dict(self.ctx.config)
        if section not in held:
            raise ValueError(f"unknown section {section!r}; known: {', '.join(held)}")
        held[section] |= values
        return stages.invalidate(self.ctx, from_dict(held))

    def run_stage(self, stage: str) -> None:
        lacking = [t for t in stages.needs(self.ctx.config, stage) if t not in self.ctx.tables]
        if lacking:
            raise ValueError(f"{stage} needs {', '.join(lacking)}; run {', '.join(sorted({stages.maker(t) for t in lacking}, key=stages.STAGES.index))} first")
        stages.work(self.ctx, stage)
        self.ctx.notes.setdefault("stages", []).append(stage)

    def table(self, name: str) -> DataFrame:
        return self.ctx.tables[name]

    def save_summary(self) -> dict:
        out = stages.summary(self.ctx)
        files.write_text(self.ctx.spark, f"{self.ctx.folder}/run_summary.yaml", yaml.safe_dump(out))
        return out

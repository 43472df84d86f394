"""The stages from a shell: ``python -m lectern STAGE [config=FILE] [provider=MODULE:FACTORY] [strict=true] [key=value ...]``."""

from __future__ import annotations

import importlib
import sys

from lectern.plans import stages
from lectern.sources import config
from lectern.spark_session import session

STAGES = {
    "transcode": (config.Transcode, stages.transcode), "transcribe": (config.Transcribe, stages.transcribe), "preprocess": (config.Preprocess, stages.preprocess),
    "summarize": (config.Summarize, stages.summarize), "export": (config.Export, stages.export), "distribute": (config.Distribute, stages.distribute),
}
WITHOUT_MODEL = {"preprocess", "export"}


def provider(name: str):
    """What MODULE:FACTORY makes; a stage that asks a model has no default."""
    module, _, factory = name.partition(":")
    return getattr(importlib.import_module(module), factory)()


def main(args: list[str]) -> int:
    if not args or args[0] not in STAGES:
        print(__doc__, file=sys.stderr)
        return 2
    stage, given = args[0], dict(a.partition("=")[::2] for a in args[1:])
    own = {k: given.pop(k) for k in ("config", "provider", "strict") if k in given}
    kind, run = STAGES[stage]
    try:
        text = open(own["config"], encoding="utf-8").read() if "config" in own else ""
        settings = config.load(kind, text, tuple(f"{k}={v}" for k, v in given.items()))
        if stage not in WITHOUT_MODEL and "provider" not in own:
            raise ValueError("a provider is needed: provider=MODULE:FACTORY")
        more = () if stage in WITHOUT_MODEL else (provider(own["provider"]),)
        report = run(session(), settings, *more)
        if stage == "export":
            print(f"exported: {report.count()} files")
            return 0
        report = report.cache()
        for r in report.where("status = 'failed'").select("name", "error").toLocalIterator():
            print(f"{r['name']}: {r['error']}", file=sys.stderr)
        print(", ".join(f"{r['status']}: {r['n']}" for r in report.groupBy("status").count().withColumnRenamed("count", "n").orderBy("status").collect()) or "nothing to do")
        code = stages.exit_code(stage, report, own.get("strict", "").lower() == "true")
        stages.clean(session(), getattr(settings, "manifest", None) or settings.dst)
        return code
    except (OSError, ValueError, KeyError) as e:
        print(e, file=sys.stderr)
        return 1

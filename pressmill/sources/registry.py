"""The source registry and the keyword dictionary as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill.schemas import SOURCE

DEFAULTS = {"region": "GLOBAL", "language": "en", "topic_filter": True, "weight": 1.0, "enabled": True, "notes": "",
            "funding": False, "reserve": False, "media_monitor": False, "media_only": False, "organization": "",
            "homepage": ""}


def read_sources(spark: SparkSession, path: str, include_disabled: bool = True) -> DataFrame:
    """The registry from a YAML or JSON file (a list, or an object with ``sources``), with defaults and positions.

    The file is a configuration of some hundred entries that people edit; duplicate ids are an error.
    """
    text = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as exc:  # pragma: no cover
            raise RuntimeError("reading a YAML registry needs PyYAML; a JSON registry does not") from exc
        data = yaml.safe_load(text)
    else:
        import json

        data = json.loads(text)
    return source_table(spark, data["sources"] if isinstance(data, dict) else data, include_disabled)


def source_table(spark: SparkSession, entries: list[dict], include_disabled: bool = True) -> DataFrame:
    import json

    schema = spark.createDataFrame([], SOURCE + ", position int").schema
    lines = [(json.dumps({**DEFAULTS, **e, "position": i}, ensure_ascii=False),) for i, e in enumerate(entries)]
    rows = spark.createDataFrame(lines, "line string").select(F.from_json("line", schema).alias("s")).select("s.*")
    twice = [r.id for r in duplicate_ids(rows).collect()]
    if twice:
        raise ValueError(f"source ids used twice: {twice}")
    return rows if include_disabled else rows.where("enabled")


def duplicate_ids(sources: DataFrame) -> DataFrame:
    return sources.groupBy("id").count().where("count > 1").select("id").orderBy("id")

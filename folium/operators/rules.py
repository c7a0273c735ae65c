"""Generation rules: defaults by profile, and sparse overrides of documents."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIELDS = ("forbidden_topics", "preferred_topics", "style_guide", "extra_instructions")
SCHEMA = "name string, forbidden_topics array<string>, preferred_topics array<string>, style_guide string, extra_instructions string"


@dataclass(frozen=True)
class Rules:
    name: str
    forbidden_topics: tuple[str, ...] = ()
    preferred_topics: tuple[str, ...] = ()
    style_guide: str = ""
    extra_instructions: str = ""


DEFAULTS = {
    "manual": Rules("manual", ("fechas de edición", "números de página"), ("definiciones", "principios", "clasificaciones"), "Una idea por pregunta."),
    "codigo_legal": Rules("codigo_legal", ("notas de reforma",), ("supuestos", "sanciones", "competencias"), "Nombra el artículo."),
    "ley_organica": Rules("ley_organica", ("notas de reforma",), ("atribuciones", "organización"), "Nombra el artículo."),
}


def default_rules(name: str) -> Rules:
    if name not in DEFAULTS:
        raise ValueError(f"no rules for {name!r}; known: {sorted(DEFAULTS)}")
    return DEFAULTS[name]


def table(spark: SparkSession) -> DataFrame:
    """The defaults, one row a profile."""
    return spark.createDataFrame([tuple(list(v) if isinstance(v, tuple) else v for v in asdict(r).values()) for r in DEFAULTS.values()], SCHEMA)


def merged(defaults: DataFrame, overrides: DataFrame, key: str = "doc_id") -> DataFrame:
    """Overrides (key, profile, and FIELDS, null where the default holds) over the defaults; lists are replaced whole."""
    rows = overrides.select(key, F.coalesce("profile", F.lit("manual")).alias("name"), *(F.col(f).alias(f"_{f}") for f in FIELDS)).join(defaults, "name", "left")
    return rows.select(key, "name", *(F.coalesce(f"_{f}", f).alias(f) for f in FIELDS))


def from_metadata(documents: DataFrame, key: str = "doc_id", metadata: str = "metadata_json") -> DataFrame:
    """Documents' profile and override, from JSON with `profile` and `question_rules`; what can't be read overrides nothing."""
    kind = "profile string, question_rules struct<forbidden_topics:array<string>, preferred_topics:array<string>, style_guide:string, extra_instructions:string>"
    rows = documents.select(key, F.from_json(metadata, kind, {"mode": "PERMISSIVE"}).alias("m"))
    return rows.select(key, F.col("m.profile").alias("profile"), *(F.col(f"m.question_rules.{f}").alias(f) for f in FIELDS))


def as_json(rules: DataFrame, key: str = "doc_id") -> DataFrame:
    return rules.select(key, F.to_json(F.struct("name", *FIELDS)).alias("rules"))

"""The registry of models: listing, order, filtering, upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Kinds of model that do not write text, by a part of their name.
EXCLUDED = ["tts", "image", "robotics", "computer-use", "clip", "lyria", "nano-banana", "antigravity", "deep-research"]
#: Parts of names that are kept whatever else they contain.
INCLUDED = ["gemma-4-26b", "gemma4-26b"]
METHOD = "generateContent"


def usable(models: DataFrame, name: str = "name", methods: str | None = "methods", included: list[str] = INCLUDED) -> DataFrame:
    """Models that can generate text: the method must be among their methods (if given); a name with an included part
    stays, one with an excluded part goes."""
    low = F.lower(name)
    has = lambda parts: F.greatest(F.lit(False), F.lit(False), *[F.contains(low, F.lit(p)) for p in parts])
    keep = has(included) | ~has(EXCLUDED)
    return models.where(keep & F.array_contains(methods, METHOD) if methods else keep)


def listed(models: DataFrame, preferred: list[str], fallback: list[str] = (), extra: str | None = None) -> DataFrame:
    """(rank, entry): ``provider: model`` of the registry, preferred ones first in their order, the rest by name, an
    extra entry last, each once. The fallback stands in for an empty registry."""
    own = models.select(F.concat_ws(": ", "provider", "model_id").alias("entry")).distinct()
    if fallback:
        spare = models.sparkSession.createDataFrame([(e,) for e in dict.fromkeys(fallback)], "entry string")
        own = own.unionByName(spare.join(own.limit(1).select(F.lit(True).alias("_any")), F.lit(True), "left_anti"))
    place = F.lit(len(preferred))
    for i, e in enumerate(preferred):
        place = F.when(F.col("entry") == e, F.lit(i)).otherwise(place)
    rows = own.withColumn("rank", place)
    if extra:
        rows = rows.where(F.col("entry") != extra).unionByName(models.sparkSession.createDataFrame([(extra, len(preferred) + 1)], "entry string, rank int"))
    return rows.orderBy("rank", "entry").select("rank", "entry")


def discovered(spark: SparkSession, found: dict[str, list[str]]) -> DataFrame:
    """(provider, model_id) rows of what the providers' listings returned."""
    return spark.createDataFrame([(p, m) for p, ms in found.items() for m in ms], "provider string, model_id string")

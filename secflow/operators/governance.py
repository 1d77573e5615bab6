"""Governance operators over dataset metadata: tags, properties, plans, checks.

The catalog side (what is already applied / defined / registered) is an input
DataFrame; each operator returns the diff or plan as a DataFrame, the data a
catalog client would then apply.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from secflow.operators.enrich import as_of_literal
from secflow.sources.catalog_metadata import metadata_frame, tag_definitions_frame  # noqa: F401

BASE_TAG = "CDC"
TAG_STRIP = r"[^A-Za-z0-9_]"
DEFAULT_SCHEMA_TYPE = "PROTOBUF"
REQUIRED_FIELDS = ["schema", "description", "tags", "labels", "owner", "domain", "environment",
                   "classification"]


def derived_tags(meta: DataFrame) -> DataFrame:
    """Tag set per dataset: base tag, classification and cleaned tags; sorted, unique."""
    cleaned = F.transform(F.coalesce(F.col("tags"), F.array().cast("array<string>")),
                          lambda t: F.regexp_replace(t, TAG_STRIP, ""))
    tags = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(BASE_TAG), F.col("classification")), cleaned)))
    return meta.select("topic", tags.alias("tags"))


def missing_tags(meta: DataFrame, applied: DataFrame) -> DataFrame:
    """(topic, tag) pairs to apply: derived tags not yet on the topic."""
    wanted = derived_tags(meta).select("topic", F.explode("tags").alias("tag"))
    return wanted.join(applied.select("topic", "tag"), ["topic", "tag"], "left_anti")


def missing_tagdefs(defs: DataFrame, existing: DataFrame) -> DataFrame:
    """Tag definitions to create: wanted definitions whose name is not defined yet."""
    return defs.join(existing.select("name"), "name", "left_anti")


def properties(meta: DataFrame, with_owner: bool = False) -> DataFrame:
    """Business-metadata attributes; nested labels renamed to source_system / retention_policy."""
    cols = ["company", "domain", "environment", "data_type", "classification"]
    if with_owner:
        cols = ["owner", "description"] + cols
    attrs = F.struct(*cols, F.col("labels.source").alias("source_system"),
                     F.col("labels.retention").alias("retention_policy"))
    return meta.select("topic", attrs.alias("attributes"), F.to_json(attrs).alias("attributes_json"))


def upsert_plan(desired: DataFrame, existing: DataFrame, key: str = "topic") -> DataFrame:
    """POST where nothing exists for the key yet, PUT otherwise."""
    have = existing.select(key).distinct().withColumn("_exists", F.lit(True))
    return desired.join(have, key, "left").select(
        *desired.columns, F.when(F.col("_exists"), "PUT").otherwise("POST").alias("method"))


def unused_tags(defs: DataFrame, meta: DataFrame) -> DataFrame:
    """Defined tags no dataset uses, and used tags without a definition."""
    used = derived_tags(meta).select(F.explode("tags").alias("name")).distinct()
    unused = defs.select("name").join(used, "name", "left_anti").withColumn("status", F.lit("defined_unused"))
    undefined = used.join(defs.select("name"), "name", "left_anti").withColumn("status", F.lit("used_undefined"))
    return unused.unionByName(undefined)


def lookup(entities: DataFrame, names: DataFrame) -> DataFrame:
    """First exact-name match per requested name (ordered by qualified name)."""
    hits = entities.join(names.select("name"), "name")
    w = Window.partitionBy("name").orderBy("qualifiedName")
    return hits.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def resolve_schema(meta: DataFrame, registered: DataFrame, local: DataFrame) -> DataFrame:
    """Registered schema if any, else the local file; default type and empty references."""
    r = registered.select("topic", F.col("schema").alias("_rs"), F.col("schemaType").alias("_rt"),
                          F.col("references").alias("_rr"))
    l_ = local.select("topic", F.col("schema").alias("_ls"))
    j = meta.select("topic").join(r, "topic", "left").join(l_, "topic", "left")
    from_registry = F.col("_rs").isNotNull()
    return j.select(
        "topic",
        F.coalesce(F.col("_rs"), F.col("_ls")).alias("schema"),
        F.when(from_registry, F.coalesce(F.col("_rt"), F.lit(DEFAULT_SCHEMA_TYPE)))
         .otherwise(F.lit(DEFAULT_SCHEMA_TYPE)).alias("schemaType"),
        F.when(from_registry, F.coalesce(F.col("_rr"), F.array().cast("array<string>")))
         .otherwise(F.array().cast("array<string>")).alias("references"),
        F.when(from_registry, "registry").when(F.col("_ls").isNotNull(), "local").otherwise("missing")
         .alias("source"),
    )


def search(meta: DataFrame, term: str) -> DataFrame:
    """Datasets matching a term by tag (exact, case-insensitive) or by company/domain/classification text."""
    t = term.lower()
    tag_hit = F.exists(F.coalesce(F.col("tags"), F.array().cast("array<string>")), lambda x: F.lower(x) == t)
    text = F.lower(F.concat_ws(" ", "company", "domain", "classification", "data_type"))
    return meta.filter(tag_hit | text.contains(t))


def completeness(meta: DataFrame, schemas: DataFrame | None = None) -> DataFrame:
    """One row per (topic, missing field); empty strings and empty arrays count as missing."""
    m = meta
    if schemas is not None:
        m = m.join(schemas.select("topic", "schema"), "topic", "left")
    else:
        m = m.withColumn("schema", F.lit(None).cast("string"))

    def missing(c: str) -> Column:
        col = F.col(c)
        if c == "tags":
            return col.isNull() | (F.size(col) == 0)
        if c == "labels":
            return col.isNull()
        return col.isNull() | (F.trim(col) == "")

    checks = F.array(*[F.when(missing(c), F.lit(c)) for c in REQUIRED_FIELDS])
    return m.select("topic", F.explode(F.filter(checks, lambda x: x.isNotNull())).alias("missing_field"))


def retention_days(label: Column) -> Column:
    """'30-days' -> 30; other units (weeks, hours) are converted; junk -> NULL."""
    n = F.regexp_extract(label, r"^\s*(\d+)\s*-?\s*([A-Za-z]+)\s*$", 1)
    unit = F.lower(F.regexp_extract(label, r"^\s*(\d+)\s*-?\s*([A-Za-z]+)\s*$", 2))
    num = F.when(n != "", n.cast("int"))
    return (F.when(unit.startswith("day"), num)
             .when(unit.startswith("week"), num * 7)
             .when(unit.startswith("month"), num * 30)
             .when(unit.startswith("year"), num * 365)
             .when(unit.startswith("hour"), F.floor(num / 24).cast("int")))


def retention_hours(label: Column) -> Column:
    """Hours beyond the whole days of ``retention_days`` ('36-hours' -> 12)."""
    n = F.regexp_extract(label, r"^\s*(\d+)\s*-?\s*[Hh]ours?\s*$", 1)
    return F.when(n != "", n.cast("int") % 24).otherwise(F.lit(0))


def retention_expired(meta: DataFrame, data: dict[str, DataFrame], as_of) -> DataFrame:
    """Per dataset: rows and rows past the retention of its metadata label at ``as_of``.

    ``data`` maps dataset (topic) name to a frame with one timestamp column ``ts``.
    """
    frames = [df.select(F.lit(name).alias("topic"), "ts") for name, df in data.items()]
    rows = frames[0]
    for f in frames[1:]:
        rows = rows.unionByName(f)
    days = meta.select("topic", F.col("labels.retention").alias("retention"),
                       retention_days(F.col("labels.retention")).alias("retention_days"))
    cut = days.withColumn("cutoff", (as_of_literal(as_of) - F.make_dt_interval(F.col("retention_days"), retention_hours(F.col("retention"))))
                          .cast("timestamp_ntz"))
    # One row per topic, so a topic listed twice cannot double the counts.
    j = rows.join(cut.dropDuplicates(["topic"]), "topic")
    return j.groupBy("topic", "retention", "retention_days", "cutoff").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(F.col("ts") < F.col("cutoff"), 1)).alias("expired_rows"))


def metadata(spark: SparkSession) -> DataFrame:
    return metadata_frame(spark)

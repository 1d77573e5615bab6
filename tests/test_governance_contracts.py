"""Governance diffs and contract checks."""

from secflow.operators import contracts, governance
from secflow.sources.catalog_metadata import metadata_frame, tag_definitions_frame
from tests.helpers import assets_df, interfaces_df


def test_derived_tags(spark):
    meta = metadata_frame(spark).limit(1).selectExpr("topic", "array('a-b', 'acme') AS tags",
                                                     "'Internal' AS classification")
    assert governance.derived_tags(meta).first().tags == ["CDC", "Internal", "ab", "acme"]


def test_missing_tags_and_defs(spark):
    meta = metadata_frame(spark)
    applied = spark.createDataFrame([("assets", "CDC"), ("assets", "acme")], "topic string, tag string")
    miss = governance.missing_tags(meta, applied)
    assert miss.filter("topic = 'assets'").count() == 4      # Internal, asset, endpoint, inventory
    assert miss.count() == 6 + 6 + 6 + 4
    defs = tag_definitions_frame(spark)
    existing = spark.createDataFrame([("CDC",), ("acme",)], "name string")
    assert governance.missing_tagdefs(defs, existing).count() == 22


def test_unused_tags(spark):
    res = {(r.name, r.status) for r in governance.unused_tags(tag_definitions_frame(spark),
                                                              metadata_frame(spark)).collect()}
    assert res == {(n, "defined_unused") for n in
                   ["EndpointSecurity", "NetworkSecurity", "VulnerabilityManagement", "ThreatDetection"]}


def test_properties_and_plan(spark):
    props = governance.properties(metadata_frame(spark))
    r = props.filter("topic = 'assets'").first()
    assert r.attributes.source_system == "postgres-cdc" and r.attributes.retention_policy == "30-days"
    existing = spark.createDataFrame([("assets",)], "topic string")
    plan = {x.topic: x.method for x in governance.upsert_plan(props.select("topic"), existing).collect()}
    assert plan["assets"] == "PUT" and plan["asset_cves"] == "POST"


def test_lookup_first_match(spark):
    ents = spark.createDataFrame([("assets", "q:b"), ("assets", "q:a"), ("assets-x", "q:c")],
                                 "name string, qualifiedName string")
    got = governance.lookup(ents, spark.createDataFrame([("assets",)], "name string")).collect()
    assert [(g.name, g.qualifiedName) for g in got] == [("assets", "q:a")]


def test_schema_resolution(spark):
    meta = metadata_frame(spark)
    reg = spark.createDataFrame([("assets", "syntax...", None, None)],
                                "topic string, schema string, schemaType string, references array<string>")
    loc = spark.createDataFrame([("asset_cves", "local...")], "topic string, schema string")
    res = {r.topic: r for r in governance.resolve_schema(meta, reg, loc).collect()}
    assert res["assets"].schemaType == "PROTOBUF" and res["assets"].references == []
    assert res["asset_cves"].source == "local" and res["network_interfaces"].source == "missing"


def test_search_and_completeness(spark):
    meta = metadata_frame(spark)
    assert {r.topic for r in governance.search(meta, "acme").collect()} == {"assets"}
    assert {r.topic for r in governance.search(meta, "threat").collect()} == {"security_findings"}
    missing = governance.completeness(meta).collect()
    # Descriptions and owners come with documents that are read, not with the built-in entries.
    assert {r.missing_field for r in missing} == {"description", "owner", "schema"} and len(missing) == 12


def test_retention_days(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("30-days",), ("2-weeks",), ("junk",)], "l string")
    assert [r.d for r in df.select(governance.retention_days(F.col("l")).alias("d")).collect()] == [30, 14, None]


def test_orphans_and_ips(spark):
    a = assets_df(spark, [("t", "a1", "server", "LOW", False)])
    n = interfaces_df(spark, [("t", "i1", "a1", "10.0.0.1", True), ("t", "i2", "zz", "999.1.1.1", True),
                              ("t", "i3", "a1", "fe80::1", True)])
    assert [r.interface_id for r in contracts.orphans(n, a, ["tenant_id", "asset_id"]).collect()] == ["i2"]
    assert [r.interface_id for r in contracts.invalid_ips(n).collect()] == ["i2"]
    s = contracts.check_ip(n).first()
    assert (s.checked, s.invalid, s.ipv4, s.ipv6) == (3, 1, 1, 1)


def test_pk_and_defaults(spark):
    a = assets_df(spark, [("t", "a1", "server", None, None), ("t", "a1", "router", "HIGH", True)])
    r = contracts.check_pk(a, ["tenant_id", "asset_id"], "assets").first()
    assert (r.rows, r.distinct_keys, r.duplicate_keys) == (2, 1, 1)
    d = contracts.apply_defaults(a, {"risk_level": "LOW", "is_quarantined": False}).collect()
    assert {(x.risk_level, x.is_quarantined) for x in d} == {("LOW", False), ("HIGH", True)}


def test_metadata_json_scan_and_lakehouse_table(spark):
    import json
    import os
    import tempfile

    import pytest

    from secflow.sources.catalog_metadata import DATASETS, read_metadata, read_tag_definitions
    from secflow.sources.connectors import lakehouse_table
    d = tempfile.mkdtemp(prefix="secflow-meta-")
    keys = ["topic", "description", "company", "domain", "environment", "owner", "data_type", "classification",
            "tags"]
    for row in DATASETS:
        doc = dict(zip(keys, row[:9]))
        doc["labels"] = dict(zip(["sensitivity", "retention", "source"], row[9]))
        with open(os.path.join(d, f"{row[0]}.metadata.json"), "w") as f:
            json.dump(doc, f, indent=2)
    meta = read_metadata(spark, os.path.join(d, "*.metadata.json"))
    assert sorted(r.topic for r in meta.collect()) == sorted(r[0] for r in DATASETS)
    assert governance.derived_tags(meta.filter("topic = 'assets'")).first().tags == \
        ["CDC", "Internal", "acme", "asset", "endpoint", "inventory"]
    tags_path = os.path.join(d, "tags.json")
    with open(tags_path, "w") as f:
        json.dump([{"entityTypes": ["e"], "name": "CDC", "description": "x"}], f)
    assert read_tag_definitions(spark, tags_path).first().name == "CDC"
    meta.createOrReplaceTempView("governance_metadata")
    assert lakehouse_table(spark, "governance_metadata").count() == 4
    with pytest.raises(ValueError):
        lakehouse_table(spark, "")

"""Dataset governance metadata and catalog definitions.

Production reads these documents with ``read_metadata`` (multi-line JSON, one
document per dataset, explicit schema).  The values below are what must match
for the retention query and the tests: names, classes, tags and labels.
Descriptions, companies and owners come with the documents that are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from secflow import schemas as S

# Dataset metadata documents (topic, description, company, domain, environment,
# owner, data_type, classification, tags, labels{sensitivity, retention, source}).
DATASETS = [
    ("assets", None, None, "Endpoint Security", "Demo", None, "Asset Inventory", "Internal",
     ["endpoint", "asset", "inventory", "acme"], ("internal", "30-days", "postgres-cdc")),
    ("network_interfaces", None, None, "Network Security", "Demo", None, "Network Interface", "Internal",
     ["network", "interface", "ip", "wayne"], ("internal", "14-days", "postgres-cdc")),
    ("asset_cves", None, None, "Vulnerability Management", "Demo", None, "CVE", "Confidential",
     ["cve", "vulnerability", "globex", "cvss"], ("confidential", "90-days", "postgres-cdc")),
    ("security_findings", None, None, "Threat Detection", "Demo", None, "Security Findings", "Restricted",
     ["findings", "threat", "anomaly", "umbrella"], ("restricted", "180-days", "flink")),
]

# Tag definition names of the catalog, in definition order.
TAG_NAMES = [
    "CDC", "EndpointSecurity", "NetworkSecurity", "VulnerabilityManagement", "ThreatDetection",
    "Internal", "Confidential", "Restricted", "endpoint", "asset", "inventory", "acme", "network",
    "interface", "ip", "wayne", "cve", "vulnerability", "globex", "cvss", "findings", "threat",
    "anomaly", "umbrella",
]

# Business-metadata attribute names of the data-product definition.
BUSINESS_ATTRIBUTES = ["company", "domain", "environment", "data_type", "classification",
                       "source_system", "retention_policy"]


def metadata_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(*d[:9], d[9]) for d in DATASETS], S.GOVERNANCE_METADATA)


def tag_definitions_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(["entity"], n, None) for n in TAG_NAMES], S.TAG_DEFINITION)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Governance metadata documents (``*.metadata.json``, one JSON object per file)."""
    return spark.read.schema(S.GOVERNANCE_METADATA).option("multiLine", True).json(path)


def read_tag_definitions(spark: SparkSession, path: str) -> DataFrame:
    """Tag definitions file: a JSON array of {entityTypes, name, description}."""
    return spark.read.schema(S.TAG_DEFINITION).option("multiLine", True).json(path)

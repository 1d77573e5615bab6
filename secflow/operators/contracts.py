"""Data-contract checks derived from the source DDL (PK, FK, NOT NULL, lengths, defaults, IP).

Each check is one or two aggregations over the table (partial aggregation, one
shuffle) and returns a small summary table; nothing is collected.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from secflow import schemas as S

# IPv4: four numbers 0..255.  IPv6: eight groups, or fewer with one '::' for the missing ones; the last two
# groups may be an IPv4 address.
_OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_V4 = rf"({_OCTET}\.){{3}}{_OCTET}"
_GROUP = "[0-9A-Fa-f]{1,4}"


def _ipv6() -> str:
    g, forms = _GROUP, []
    for tail, most in (("", 8), (_V4, 6)):
        # All groups written out; then one '::' with k groups before it and as many as fit after it.
        forms.append(f"({g}:){{{most}}}{tail}" if tail else f"({g}:){{7}}{g}")
        for k in range(most):
            after = most - 1 - k
            end = f"(({g}:){{0,{after}}}{tail})" if tail else (f"({g}(:{g}){{0,{after - 1}}})?" if after else "")
            head = f"{g}(:{g}){{{k - 1}}}" if k else ""
            forms.append(f"{head}::{end}")
    return "^(" + "|".join(forms) + ")$"


IPV4_PATTERN = f"^{_V4}$"
IPV6_PATTERN = _ipv6()


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def check_pk(df: DataFrame, keys: list[str], table: str) -> DataFrame:
    """rows, distinct keys and duplicated keys for a declared primary key."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.sum("_n").cast("bigint").alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.sum(F.when(F.col("_n") > 1, 1).otherwise(0)).cast("bigint").alias("duplicate_keys"),
    ).select(F.lit(table).alias("table_name"), "rows", "distinct_keys", "duplicate_keys")


def check_pk_all(assets: DataFrame, interfaces: DataFrame, cves: DataFrame) -> DataFrame:
    return _union([check_pk(df, S.PRIMARY_KEYS[t], t) for t, df in
                   (("assets", assets), ("network_interfaces", interfaces), ("asset_cves", cves))])


def orphans(child: DataFrame, parent: DataFrame, keys: list[str]) -> DataFrame:
    """Child rows whose foreign key has no parent (anti join)."""
    return child.join(parent.select(*keys), keys, "left_anti")


def check_fk_all(assets: DataFrame, interfaces: DataFrame, cves: DataFrame) -> DataFrame:
    keys = ["tenant_id", "asset_id"]
    return _union([
        orphans(child, assets, keys).agg(F.count(F.lit(1)).alias("orphans"))
        .select(F.lit(name).alias("table_name"), "orphans")
        for name, child in (("network_interfaces", interfaces), ("asset_cves", cves))
    ])


def check_not_null(df: DataFrame, columns: list[str], table: str) -> DataFrame:
    counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "null_count") \
                 .select(F.lit(table).alias("table_name"), "column_name", "null_count")


def check_not_null_all(assets: DataFrame, interfaces: DataFrame, cves: DataFrame) -> DataFrame:
    return _union([check_not_null(df, S.NOT_NULL[t], t) for t, df in
                   (("assets", assets), ("network_interfaces", interfaces), ("asset_cves", cves))])


def check_lengths(df: DataFrame, limits: dict[str, int], table: str) -> DataFrame:
    cols = list(limits)
    counts = df.agg(*[F.count(F.when(F.length(c) > limits[c], 1)).alias(c) for c in cols])
    lim = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(limits[c]))])
    return counts.unpivot([], cols, "column_name", "violations").select(
        F.lit(table).alias("table_name"), "column_name", lim[F.col("column_name")].alias("max_length"),
        "violations")


def check_decimal(df: DataFrame, column: str, precision: int, scale: int, table: str) -> DataFrame:
    """Values that do not fit DECIMAL(precision, scale)."""
    v = F.col(column)
    scaled = v * F.lit(10 ** scale)
    bad = v.isNotNull() & ((F.abs(scaled - F.round(scaled)) > F.lit(1e-9))
                           | (F.abs(v) >= F.lit(10.0 ** (precision - scale))))
    return df.agg(F.count(F.when(bad, 1)).alias("violations")).select(
        F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
        F.lit(precision).alias("max_length"), "violations")


def check_lengths_all(assets: DataFrame, interfaces: DataFrame, cves: DataFrame) -> DataFrame:
    parts = [check_lengths(df, S.LENGTH_LIMITS[t], t) for t, df in
             (("assets", assets), ("network_interfaces", interfaces), ("asset_cves", cves))]
    parts.append(check_decimal(cves, "cvss_score", 3, 1, "asset_cves"))
    return _union(parts)


def apply_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Column defaults for missing values."""
    return df.select(*[F.coalesce(F.col(c), F.lit(defaults[c])).alias(c) if c in defaults else F.col(c)
                       for c in df.columns])


def cascade(children: DataFrame, deleted_parents: DataFrame, keys=("tenant_id", "asset_id")) -> DataFrame:
    """Children that survive ON DELETE CASCADE of the deleted parents."""
    return children.join(deleted_parents.select(*keys), list(keys), "left_anti")


def ip_valid(ip) -> F.Column:
    c = F.col(ip) if isinstance(ip, str) else ip
    return c.rlike(IPV4_PATTERN) | c.rlike(IPV6_PATTERN)


def check_ip(df: DataFrame, column: str = "ip_address", max_length: int = 45) -> DataFrame:
    c = F.col(column)
    invalid = c.isNotNull() & (~ip_valid(c) | (F.length(c) > max_length))
    return df.agg(
        F.count(c).alias("checked"),
        F.count(F.when(invalid, 1)).alias("invalid"),
        F.count(F.when(c.rlike(IPV4_PATTERN), 1)).alias("ipv4"),
        F.count(F.when(c.rlike(IPV6_PATTERN), 1)).alias("ipv6"),
    )


def invalid_ips(df: DataFrame, column: str = "ip_address") -> DataFrame:
    c = F.col(column)
    return df.filter(c.isNotNull() & ~ip_valid(c))

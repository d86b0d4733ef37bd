"""Settings for the public HBase Spark connector; its jar must be on the class path."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

HBASE_FORMAT = "org.apache.hadoop.hbase.spark"


def hbase_options(rule: Mapping[str, str], fields: Sequence[str]) -> dict[str, str]:
    """Connector options for a rule: every field a string cell of the rule's column family.

    The field named by `rowKey` is the row key; without one the key is read as `_key`.
    """
    family, key = rule.get("family") or "", rule.get("rowKey")
    cells = [] if key in fields else ["_key STRING :key"]
    cells += [f"{f} STRING :key" if f == key else f"{f} STRING {family}:{f}" for f in fields]
    return {
        "hbase.table": rule.get("hbaseTable") or "",
        "hbase.columns.mapping": ", ".join(cells),
        "hbase.spark.use.hbasecontext": "false",
        "hbase.zookeeper.quorum": rule.get("zkHosts") or "",
        "hbase.zookeeper.property.clientPort": rule.get("zkPort") or "",
    }

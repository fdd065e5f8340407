"""Documents for a search index.

The connector is an external jar, so its format name is an argument; any other
format (``json``) works for a dry run.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

# The connector's format name and option keys.
CONNECTOR = "org.elasticsearch.spark.sql"
NODES, RESOURCE, AUTO_CREATE, ID = "es.nodes", "es.resource", "es.index.auto.create", "es.mapping.id"


@dataclass(frozen=True)
class IndexSink:
    hosts: str
    id_column: str | None = None
    mode: str = "append"
    format: str = CONNECTOR
    more: dict[str, str] = field(default_factory=dict)

    def options(self, resource: str) -> dict[str, str]:
        options = {NODES: self.hosts, AUTO_CREATE: "yes", RESOURCE: resource, **self.more}
        return options if self.id_column is None else {**options, ID: self.id_column}

    def write(self, df: DataFrame, resource: str) -> None:
        """Each row becomes a document; with an id column a rerun replaces it."""
        writer = df.write.format(self.format).mode(self.mode).options(**self.options(resource))
        if self.format == CONNECTOR:
            writer.save()
        else:
            writer.save(resource)

"""The graph as named DataFrames.  Nothing here is ever collected."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Relation of a concept to a taxonomy value, by field; other fields give HAS_<FIELD> (fixed values).
RELATIONS = {"topic": "GROUPED_BY", "aspect": "QUALIFIED_BY", "dimension": "BELONGS_TO", "confidence": "RATED_AS"}


@dataclass
class Graph:
    """Tables of one project.

    concepts: name, search_name, description, aliases, props          values: concept, field, value, ord
    sources: bibtex, title, author, year, doi, journal, abstract, props
    items: item_id, citation, description, source_file, source_line, annotation_id, props
    from_source: item_id, ref       mentions: item_id, concept, mention_order
    chains: item_id, source, target, type, description, ord             hierarchy: child, parent, type
    located: concept, item_id, ref of the mentions whose item has a source, where the source of rows knows them together
    source_values: bibtex, field, value, ord of the fields by which sources name entities (one row a value)
    entities: entity, label, entity_id, member, source_bibtex           references: entity, label, entity_id, member, from_source

    An item has one source.
    """

    concepts: DataFrame
    values: DataFrame
    sources: DataFrame
    items: DataFrame
    from_source: DataFrame
    mentions: DataFrame
    chains: DataFrame
    hierarchy: DataFrame | None = None
    located: DataFrame | None = None
    source_values: DataFrame | None = None
    entities: DataFrame | None = None
    references: DataFrame | None = None
    orphans: DataFrame | None = None
    concept_label: str = "Concept"
    graph_fields: list[str] = field(default_factory=list)
    field_specs: dict[str, Any] = field(default_factory=dict)
    context: dict[str, Any] = field(default_factory=dict)

    @property
    def topic_field(self) -> str | None:
        """The first graph field declared TYPE TOPIC, else the one called topic, else none."""
        for name in self.graph_fields:
            if (self.field_specs.get(name) or {}).get("type") == "TOPIC":
                return name
        return "topic" if "topic" in self.graph_fields else None

    def vertices(self) -> DataFrame:
        """Names of ontology concepts and of all ends of chains."""
        ends = self.chains.select(F.explode(F.array("source", "target")).alias("name"))
        return self.concepts.select("name").unionByName(ends).where("name is not null and name <> ''").distinct()

    def relates_to(self) -> DataFrame:
        """One edge per (source, target, type); item and description of the last chain."""
        last = F.max_by(F.struct("item_id", "description"), "ord")
        edges = self.chains.groupBy("source", "target", "type").agg(last.alias("last"))
        return edges.select("source", "target", "type", "last.item_id", "last.description")

    def kept(self, path: str) -> Graph:
        """The same graph with every table written once below ``path``, a shared folder, and read from there."""
        tables = {f.name: getattr(self, f.name) for f in fields(self) if isinstance(getattr(self, f.name), DataFrame)}
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{path}/{name}")
        spark = self.concepts.sparkSession
        return replace(self, **{name: spark.read.schema(df.schema).parquet(f"{path}/{name}") for name, df in tables.items()})

    def of_field(self, name: str) -> DataFrame:
        return self.values.where(F.col("field") == name).select("concept", "value").distinct()


def relation_of(name: str) -> str:
    return RELATIONS.get(name, f"HAS_{name.upper()}")

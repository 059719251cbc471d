"""The run of a project: load, store or draw, compute metrics, report."""

from __future__ import annotations

import argparse
import time
import uuid
from dataclasses import dataclass, field, replace
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.errors import PipelineError, StoreError
from loomgraph.model import Graph
from loomgraph.operators import algorithms, embeddings, estimates, fulltext, linkage, metrics, projection, view
from loomgraph.plans import context, settings
from loomgraph.sources import page, project_json, sinks

MODES = ("rebuild", "update")
KEYS = {"concepts": ["name"], "values": ["concept", "field", "value"], "sources": ["bibtex"], "items": ["item_id"], "from_source": ["item_id"], "mentions": ["item_id", "mention_order", "concept"], "relations": ["source", "target", "type"], "entities": ["label", "entity_id"], "refers_to": ["label", "entity_id", "from_source"]}


@dataclass
class Result:
    success: bool
    error: Exception | None = None
    stats: dict[str, int] = field(default_factory=dict)
    warnings: list[str] = field(default_factory=list)


def linked(spark: SparkSession, paths: list[str]) -> Graph:
    """Several projects as one graph: references and items carry their member's name, equal concepts are one.

    Entities that one member's sources identify and others' refer to link the members; equal references never do.
    """
    members = [(Path(p).stem, project_json.load(spark, p)) for p in paths]
    if not members:
        raise PipelineError("no project is given", "load")
    if len({n for n, _ in members}) < len(members):
        raise PipelineError("two projects have one name", "load", ", ".join(n for n, _ in members))
    between = linkage.across([(n, g.field_specs, g.source_values) for n, g in members if g.source_values is not None])
    entities, references, orphans, warnings = between or (None, None, None, [])
    warnings = [*(f"{n}: {w}" for n, g in members for w in g.context.get("warnings", [])), *warnings]
    if len(members) == 1:
        g = members[0][1]
        own = lambda df, column: df if df is None else df.withColumn(column, F.regexp_replace(column, "^.*?:@", ""))
        return replace(g, entities=own(entities, "source_bibtex"), references=own(references, "from_source"), orphans=own(orphans, "from_source"), context=g.context | {"warnings": warnings})

    def united(pick) -> DataFrame:
        out = None
        for name, g in members:
            df = pick(name, g)
            out = df if out is None else out.unionByName(df, allowMissingColumns=True)
        return out

    first = members[0][1]
    q = linkage.qualified
    return Graph(
        concepts=linkage.union_concepts([g.concepts for _, g in members]),
        values=united(lambda n, g: g.values).dropDuplicates(["concept", "field", "value"]),
        sources=united(lambda n, g: q(g.sources, "bibtex", n, at=True)),
        items=united(lambda n, g: q(g.items, "item_id", n)),
        from_source=united(lambda n, g: q(q(g.from_source, "item_id", n), "ref", n, at=True)),
        mentions=united(lambda n, g: q(g.mentions, "item_id", n)),
        chains=united(lambda n, g: q(g.chains, "item_id", n)),
        hierarchy=united(lambda n, g: g.hierarchy).distinct(),
        concept_label=first.concept_label,
        graph_fields=list(dict.fromkeys(f for _, g in members for f in g.graph_fields)),
        field_specs={k: v for _, g in reversed(members) for k, v in g.field_specs.items()},
        entities=entities,
        references=references,
        orphans=orphans,
        context=first.context | {"project": " + ".join(n for n, _ in members), "project_parts": (first.context.get("project_parts") or {}) | {"name": " + ".join(n for n, _ in members)}, "warnings": warnings},
    )


def tables(g: Graph) -> dict[str, DataFrame]:
    """What is stored: nodes are all vertices, those too that only chains name."""
    beyond = g.vertices().join(g.concepts.select("name"), "name", "left_anti")
    out = {"concepts": g.concepts.unionByName(beyond, allowMissingColumns=True), "values": g.values, "sources": g.sources, "items": g.items, "from_source": g.from_source, "mentions": g.mentions, "relations": g.relates_to()}
    if g.entities is not None:
        out |= {"entities": g.entities, "refers_to": g.references}
    return out


def stored(g: Graph, root: str, mode: str, owner: str) -> None:
    spark = g.concepts.sparkSession
    for name, df in tables(g).items():
        if mode == "rebuild":
            sinks.rebuild(df, f"{root}/{name}")
        else:
            sinks.update(df.dropDuplicates(KEYS[name]), f"{root}/{name}", KEYS[name])
        sinks.beat(spark, root, owner)
    if mode == "update" and sinks.exists(spark, f"{root}/hierarchy"):
        old = spark.read.parquet(f"{root}/hierarchy")
        sinks.replace(sinks.replace_types(old, g.hierarchy, sorted(project_json.SPECIES.values())), f"{root}/hierarchy")
    else:
        sinks.rebuild(g.hierarchy, f"{root}/hierarchy")


def _vectors(g: Graph, target: str, wanted: settings.StoreSettings, encoder: embeddings.Encoder | None, about: context.Context, warnings: list[str]) -> context.Context:
    """Writes the sidecar that the settings ask for, reusing vectors that still hold."""
    if not wanted.embedding_fields:
        return about
    spark = g.concepts.sparkSession
    encoder = encoder or (embeddings.hashed() if wanted.embedding_model == settings.DEFAULT_ENCODER else None)
    if encoder is None:
        warnings.append(f"no encoder for {wanted.embedding_model}: concepts have no vectors")
        return about
    fields, remarks = embeddings.checked(g, wanted.embedding_fields)
    warnings += remarks
    path = f"{target}/embeddings"
    embeddings.write(embeddings.sidecar(g, fields, encoder, embeddings.read(spark, path)), path)
    return context.with_vectors(about, fields, encoder.name, encoder.dimensions)


def run(spark: SparkSession, paths: list[str], target: str, backend: str = settings.PARQUET, mode: str = "rebuild", choice: str = "all", scope: view.Scope | None = None, wanted: settings.StoreSettings | None = None, encoder: embeddings.Encoder | None = None) -> Result:
    """Errors are returned, not raised; metrics that fail are warnings."""
    try:
        if backend not in settings.BACKENDS:
            raise PipelineError(f"unknown target {backend}", "config")
        if backend == settings.HTML:
            if len(paths) > 1:
                raise PipelineError("a page shows one project", "config")
            g = linked(spark, paths)
            page.write(g, target, scope)
            return Result(True, stats=metrics.counting_units(g).first().asDict())
        if mode not in MODES:
            raise PipelineError(f"unknown mode {mode}", "config")
        wanted = wanted or settings.StoreSettings(target)
        if mode == "update":
            asked = context.Context(fulltext_analyzer=wanted.fulltext_analyzer, embedding_model=wanted.embedding_model if wanted.embedding_fields else "", embedding_fields=",".join(wanted.embedding_fields))
            changed = context.incompatible(context.read(spark, target), asked)
            if changed:
                raise StoreError("an update cannot change how the tables were made; rebuild them", details="; ".join(changed))
        g, owner = linked(spark, paths).kept(f"{target}/_plan"), uuid.uuid4().hex
        warnings = list(g.context.get("warnings", []))
        fields = fulltext.fields_of(g)
        about = context.with_search(context.build(g), fields["concept"], fields["item"], fields["source"], wanted.fulltext_analyzer)
        sinks.begin(spark, target, owner)
        stored(g, target, mode, owner)
        sinks.rebuild(fulltext.graph_index(g, wanted.fulltext_analyzer), f"{target}/fulltext")
        about = _vectors(g, target, wanted, encoder, about, warnings)
        sinks.beat(spark, target, owner)
        own = metrics.degrees(g).join(metrics.mention_counts(g), "name")
        done = written_metrics(g, choice, target, owner, warnings)
        for name in done:
            own = own.join(spark.read.parquet(f"{target}/_plan/{name}").where(F.col("name").isNotNull()), "name", "left")
        sinks.rebuild(own, f"{target}/concept_metrics")
        sinks.rebuild(metrics.taxonomy_counts(g), f"{target}/taxonomy_metrics")
        sinks.rebuild(metrics.source_metrics(g), f"{target}/source_metrics")
        context.write(spark, context.with_metrics(about, "spark" if done else "", "concepts and their relations"), target)
        stats = metrics.counting_units(g).first().asDict()
        sinks.discard(spark, f"{target}/_plan")
        sinks.finish(spark, target, owner)
        return Result(True, stats=stats, warnings=warnings)
    except Exception as e:  # noqa: BLE001  (the caller decides)
        return Result(False, error=e)


def written_metrics(g: Graph, choice: str, target: str, owner: str, warnings: list[str]) -> list[str]:
    """Each chosen metric computed and written by itself; one that fails is a warning and the others go on.

    What PageRank took tells how long the others will.
    """
    spark = g.concepts.sparkSession
    edges = projection.projected(g)
    sinks.rebuild(edges, f"{target}/_plan/edges")
    edges = spark.read.parquet(f"{target}/_plan/edges")
    n_edges, n_vertices, factor, done = edges.count(), g.vertices().count(), None, []
    names = algorithms.METRIC_SETS.get(choice, algorithms.METRIC_SETS["all"])
    for i, name in enumerate(names):
        began = time.monotonic()
        try:
            sinks.rebuild(algorithms.METRICS[name](edges), f"{target}/_plan/{name}")
            done.append(name)
        except Exception as e:  # noqa: BLE001  (reported to the caller)
            warnings.append(f"{name}: {e}")
        if name == "pagerank" and name in done:
            factor = estimates.calibration(time.monotonic() - began, n_vertices, n_edges)
            rest = estimates.seconds(n_vertices, names[i + 1 :], factor, n_edges)
            if rest > 600:
                warnings.append(f"{', '.join(names[i + 1 :])}: expected to take {rest:.0f} s")
        sinks.beat(spark, target, owner)
    return done


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="loomgraph")
    parser.add_argument("backend", choices=settings.BACKENDS)
    parser.add_argument("--json", "--project", dest="json", action="append", required=True, help="an exported project; may be repeated")
    parser.add_argument("--target", help="folder of the tables, or file of the page")
    parser.add_argument("--config", help="TOML with a section for each target")
    parser.add_argument("--mode", default="rebuild", choices=MODES)
    parser.add_argument("--metrics", default="all", choices=sorted(algorithms.METRIC_SETS))
    args = parser.parse_args(argv)
    try:
        wanted = settings.load(args.config, args.backend)
    except PipelineError as e:
        print(f"failed: {e}")
        return 1
    target = args.target or wanted.target
    if not target:
        parser.error("a target is needed, here or in the configuration")
    spark = SparkSession.builder.appName("loomgraph").getOrCreate()
    drawn = isinstance(wanted, settings.PageSettings)
    result = run(spark, args.json, target, args.backend, args.mode, args.metrics, wanted.scope if drawn else None, None if drawn else wanted)
    print(result.stats if result.success else f"failed: {result.error}")
    for w in result.warnings:
        print(f"warning: {w}")
    return 0 if result.success else 1


if __name__ == "__main__":
    raise SystemExit(main())

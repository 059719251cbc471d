"""Identity across projects, aliases, and origins that are merged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.functions import text


def trimmed_values(df: DataFrame, column: str) -> DataFrame:
    """One row per non-blank value; lists are flattened, case is kept."""
    return df.withColumn(column, F.explode(F.filter(F.transform(column, lambda x: F.trim(x)), lambda x: x != "")))


def resolve(owners: DataFrame, referrers: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(entities, edges, orphans).  owners: entity, value, member, source, ord; referrers: entity, value, member, source.

    The first owner row of (entity, value) holds it; values match exactly; what refers to no owner is an orphan.
    """
    first = F.min_by(F.struct("member", "source"), F.struct("ord", "member", "source"))
    entities = owners.groupBy("entity", "value").agg(first.alias("own")).select("entity", F.col("value").alias("entity_id"), "own.member", F.col("own.source").alias("source_bibtex"))
    key = [F.col("r.entity") == F.col("e.entity"), F.col("r.value") == F.col("e.entity_id")]
    known = entities.select("entity", "entity_id")
    edges = referrers.alias("r").join(known.alias("e"), key).select("r.entity", "e.entity_id", "r.member", F.col("r.source").alias("from_source")).distinct()
    orphans = referrers.alias("r").join(known.alias("e"), key, "left_anti").select("r.entity", "r.value", "r.member", F.col("r.source").alias("from_source")).distinct()
    return entities, edges, orphans


def declared(specs: dict) -> tuple[dict[str, str], dict[str, str]]:
    """(field: entity) of the source fields that identify entities, and of those that refer to them."""
    fields = {n: x for n, x in specs.items() if isinstance(x, dict) and str(x.get("scope") or "").upper() == "SOURCE"}
    return {n: str(x["identifies"]) for n, x in fields.items() if x.get("identifies")}, {n: str(x["refers_to"]) for n, x in fields.items() if x.get("refers_to")}


def across(members: list[tuple[str, dict, DataFrame]]) -> tuple[DataFrame, DataFrame, DataFrame, list[str]] | None:
    """(entities, references, orphans, warnings) of members (alias, field specs, source values); none if nothing is declared.

    An entity belongs to the first member that identifies it; others that do are warned of.  Sources are named alias:@ref.
    """
    owner: dict[str, str] = {}
    warnings, own, other = [], None, None
    for place, (alias, specs, values) in enumerate(members):
        identify, refer = declared(specs)
        for name, entity in identify.items():
            if entity in owner:
                warnings.append(f"{entity} is identified by {owner[entity]} and by {alias}; the first counts")
                continue
            owner[entity] = alias
            own = _also(own, _named(values, name, entity, alias).withColumn("ord", F.col("ord") + F.lit(place << 40)))
        for name, entity in refer.items():
            other = _also(other, _named(values, name, entity, alias).drop("ord"))
    if own is None and other is None:
        return None
    empty = members[0][2].limit(0)
    entities, edges, orphans = resolve(own if own is not None else _named(empty, "", "", ""), other if other is not None else _named(empty, "", "", "").drop("ord"))
    return _labelled(entities), _labelled(edges), _labelled(orphans), warnings


def _also(a: DataFrame | None, b: DataFrame) -> DataFrame:
    return b if a is None else a.unionByName(b)


def _named(values: DataFrame, name: str, entity: str, alias: str) -> DataFrame:
    rows = values.where(F.col("field") == name).withColumn("value", F.trim("value")).where("value <> ''")
    return rows.select(F.lit(entity).alias("entity"), "value", F.lit(alias).alias("member"), F.concat(F.lit(f"{alias}:@"), F.regexp_replace("bibtex", "^@+", "")).alias("source"), "ord")


def _labelled(rows: DataFrame) -> DataFrame:
    return rows.withColumn("label", text.entity_label(F.col("entity")))


def merge_origins(bibliography: DataFrame, dataset: DataFrame, key: str) -> DataFrame:
    """Both origins of a source's fields; per field the bibliography wins, blank ones do not count."""
    fields = sorted({*bibliography.columns, *dataset.columns} - {key})
    a, b = bibliography.alias("a"), dataset.alias("b")
    pick = lambda f: F.coalesce(*(F.expr(f"nullif({x}.`{f}`, '')") for x, df in (("a", bibliography), ("b", dataset)) if f in df.columns)).alias(f)
    return a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full").select(F.coalesce(f"a.{key}", f"b.{key}").alias(key), *map(pick, fields))


def tolerant_lookup(rows: DataFrame, ref: str, table: DataFrame, key: str, value: str) -> DataFrame:
    """rows with ``value`` of the table: by the reference itself, else without its leading @, else in lower case."""
    out = rows
    steps = (F.col(ref), F.regexp_replace(ref, "^@+", ""), F.lower(F.regexp_replace(ref, "^@+", "")))
    for i, how in enumerate(steps):
        side = table.select(F.col(key).alias(f"_k{i}"), F.col(value).alias(f"_v{i}"))
        out = out.join(side, how == F.col(f"_k{i}"), "left")
    return out.select(*rows.columns, F.coalesce("_v0", "_v1", "_v2").alias(value))


def resolve_aliases(chains: DataFrame, mentions: DataFrame, aliases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chains and mentions with aliases replaced by their targets.  aliases: alias, target.

    Chains that collapse onto one concept go and equal mentions count once; both only where there are aliases at all.
    """
    if aliases.isEmpty():
        return chains, mentions
    to = lambda df, column: df.join(aliases.select(F.col("alias").alias(column), F.col("target").alias("_to")), column, "left").withColumn(column, F.coalesce("_to", column)).drop("_to")
    chains = to(to(chains, "source"), "target").select(*chains.columns)
    return chains.where("source <> target"), to(mentions, "concept").select(*mentions.columns).distinct()


def union_concepts(members: list[DataFrame]) -> DataFrame:
    """Concepts of several members, one per exact name, the first member's."""
    rows = None
    for i, df in enumerate(members):
        df = df.withColumn("_member", F.lit(i))
        rows = df if rows is None else rows.unionByName(df, allowMissingColumns=True)
    names = [c for c in rows.columns if c not in ("name", "_member")]
    return rows.groupBy("name").agg(F.min_by(F.struct(*names), "_member").alias("x")).select("name", "x.*") if names else rows.select("name").distinct()


def qualified(df: DataFrame, column: str, alias: str, at: bool = False) -> DataFrame:
    """The column prefixed by the member's alias; source references get one leading @."""
    body = F.concat(F.lit("@"), F.regexp_replace(column, "^@+", "")) if at else F.col(column)
    return df.withColumn(column, F.concat(F.lit(f"{alias}:"), body))

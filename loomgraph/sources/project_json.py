"""A graph from an exported project: template, ontology, corpus and bibliography in one JSON document.

The template is small and analysed on the driver.  Everything else stays a variant column that is exploded and read by
field; ordinals of blocks and hops go along, so "first" and "last" never depend on the order of rows.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.errors import CompilationError
from loomgraph.functions import text
from loomgraph.model import Graph
from loomgraph.operators import linkage

SOURCE_FIELDS = ("title", "author", "year", "doi", "journal", "abstract")
CITATION_NAMES = ("text", "citação", "citation")
DESCRIPTION_NAMES = ("justificativa_interna", "descricao")
TAXONOMY_TYPES = ("TOPIC", "ENUMERATED", "ORDERED")
SPECIES = {"KIND": "KIND_OF", "PART": "PART_OF", "INSTANCE": "INSTANCE_OF"}
#: Keys of an item that its template fields may not replace.
PROTECTED = ("item_id", "citation", "description", "source_file", "source_line", "annotation_id")


@dataclass
class Template:
    scalar: list[str] = field(default_factory=list)
    graph: list[str] = field(default_factory=list)
    chain: list[str] = field(default_factory=list)
    code: list[str] = field(default_factory=list)
    source: list[str] = field(default_factory=list)
    value_maps: dict[str, dict[int, str]] = field(default_factory=dict)
    relations: dict[str, str] = field(default_factory=dict)
    partners: dict[str, str] = field(default_factory=dict)
    memo: str = "note"
    quotation: str = "citation"
    specs: dict[str, Any] = field(default_factory=dict)

    @property
    def label(self) -> str:
        first = (self.chain or self.code or [None])[0]
        kept = "".join(c for c in (first or "").capitalize() if c.isalnum() or c == "_")
        return ("_" + kept if kept[:1].isdigit() else kept or "Unknown") if first else "Concept"


def analyzed(template: dict[str, Any]) -> Template:
    """Fields by scope and type.  Of several MEMO or QUOTATION fields the last counts."""
    t = Template(specs=template.get("field_specs") or {})
    for name, spec in t.specs.items():
        scope, kind = (spec.get("scope") or "").upper(), spec.get("type") or "TEXT"
        if scope == "ONTOLOGY" and kind in TAXONOMY_TYPES:
            t.graph.append(name)
            if spec.get("values"):
                t.value_maps[name] = {v["index"]: v.get("label") for v in spec["values"] if "index" in v}
        elif scope == "ONTOLOGY":
            t.scalar.append(name)
        elif scope == "ITEM" and kind == "CHAIN":
            t.chain.append(name)
            t.relations.update(spec.get("relations") or {})
        elif scope == "ITEM" and kind == "CODE":
            t.code.append(name)
        elif scope == "ITEM" and kind == "MEMO":
            t.memo = name
        elif scope == "ITEM" and kind == "QUOTATION":
            t.quotation = name
        elif scope == "SOURCE":
            t.source.append(name)
    for key in ("bundled_fields", "optional_bundles"):
        for bundles in (template.get(key) or {}).values():
            for bundle in bundles:
                for code in (c for c in bundle if c in t.code):
                    rest = [f for f in bundle if f not in t.code]
                    if rest:
                        t.partners.setdefault(code, rest[0])
    return t


def _get(v: Column, kind: str) -> Column:
    return F.try_variant_get(v, "$", kind)


def _list(v: Column) -> Column:
    """Strings of a list or of a scalar; empty for null."""
    single = _get(v, "string")
    return F.coalesce(_get(v, "array<string>"), F.when(single.isNotNull(), F.array(single)), F.array().cast("array<string>"))


def _is_list(v: Column) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(v), F.lit("ARRAY")), F.lit(False))


def _text(v: Column) -> Column:
    """The scalar, or the first of a list."""
    return F.coalesce(F.when(_is_list(v), F.try_element_at(_list(v), F.lit(1))).otherwise(_get(v, "string")), F.lit(""))


def _first_full(*columns: Column) -> Column:
    out = F.lit("")
    for c in reversed(columns):
        out = F.when(F.coalesce(c, F.lit("")) != "", c).otherwise(out)
    return out


def document(spark: SparkSession, path: str) -> DataFrame:
    """One row: the document's parts as variants."""
    raw = spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("d"))
    parts = ("version", "project", "template", "ontology", "corpus", "bibliography", "dataset", "indices", "export_metadata")
    return raw.select(*(F.try_variant_get("d", f"$.{p}", "variant").alias(p) for p in parts))


def _small(spark: SparkSession, path: str, *names: str) -> dict[str, Any]:
    """Bounded parts as Python values, keys in the order of the document (a variant sorts them)."""
    raw = spark.read.text(path, wholetext=True)
    row = raw.select(*(F.get_json_object("value", f"$.{n}").alias(n) for n in names)).first()
    if row is None:
        raise CompilationError("no document")
    return {n: _parsed(row[n]) if row[n] else {} for n in names}


def _parsed(value: str) -> Any:
    """A part of the document; a bare string is itself."""
    try:
        return json.loads(value)
    except ValueError:
        return value


def _entries(doc: DataFrame, name: str, key: str) -> DataFrame:
    """key, v of an object of entries."""
    return doc.select(F.explode(F.map_entries(_get(F.col(name), "map<string,variant>"))).alias("e")).select(F.col("e.key").alias(key), F.col("e.value").alias("v"))


def _labels(t: Template, name: str, v: Column) -> Column:
    """Values of a field as labels: only integers are looked up, 0 included; anything else is itself."""
    plain = _list(v)
    if name not in t.value_maps:
        return plain
    pairs = [F.lit(x) for kv in t.value_maps[name].items() for x in kv]
    table = F.create_map(*pairs)
    one = F.when(F.schema_of_variant(v) == "BIGINT", F.array(text.index_label(_get(v, "int"), table)))
    many = F.when(F.schema_of_variant(v) == "ARRAY<BIGINT>", F.transform(_get(v, "array<int>"), lambda i: text.index_label(i, table)))
    return F.coalesce(one, many, plain)


def own_description(described: Column, props: Column) -> Column:
    """A description that no property repeats."""
    same = F.exists(F.map_values(props), lambda x: x == described)
    return F.when(~F.coalesce(same, F.lit(False)), described)


def item_id(mark: str) -> Column:
    """The id of an item: its block's, n for a hop or c for a code, and its number in the block from 1; over columns id and i."""
    return F.format_string(f"%s_{mark}%04d", "id", F.col("i") + 1)


def concepts(doc: DataFrame, t: Template) -> tuple[DataFrame, DataFrame]:
    """Concepts with scalar properties, and their taxonomy values in order."""
    rows = _entries(doc, "ontology", "name").withColumn("f", _get(F.col("v"), "map<string,variant>"))
    at = lambda f: F.try_element_at("f", F.lit(f))
    props = F.map_filter(F.create_map(*(x for f in t.scalar for x in (F.lit(f), _get(at(f), "string")))) if t.scalar else F.create_map().cast("map<string,string>"), lambda k, v: v.isNotNull())
    described = _get(at("description"), "string")
    out = rows.select("name", text.humanized(F.col("name")).alias("search_name"), own_description(described, props).alias("description"), F.lit(None).cast("array<string>").alias("aliases"), props.alias("props"))
    values = None
    for f in t.graph:
        one = rows.select(F.col("name").alias("concept"), F.lit(f).alias("field"), F.posexplode(_labels(t, f, at(f))).alias("ord", "value")).where("value is not null and value <> ''").select("concept", "field", "value", "ord")
        values = one if values is None else values.unionByName(one)
    return out, values if values is not None else out.select(F.col("name").alias("concept"), F.lit("").alias("field"), F.lit("").alias("value"), F.lit(0).alias("ord")).limit(0)


def blocks(doc: DataFrame, t: Template, root: str = "") -> DataFrame:
    """Annotated blocks with their hops, codes, notes and citation; ``b`` is the block's place in the corpus."""
    rows = doc.select(F.posexplode(_get(F.col("corpus"), "array<variant>")).alias("b", "v"))
    rows = rows.select("b", F.try_variant_get("v", "$.id", "string").alias("id"), F.regexp_replace(F.try_variant_get("v", "$.source_ref", "string"), "^@+", "").alias("ref"), F.try_variant_get("v", "$.data", "map<string,variant>").alias("data"), F.try_variant_get("v", "$.traceability.file", "string").alias("file"), F.try_variant_get("v", "$.traceability.line", "int").alias("line"))
    at = lambda f: F.try_element_at("data", F.lit(f))
    hop = "struct<`from`:string,relation:string,`to`:string>"
    hops = F.lit(None)
    none = F.array().cast(f"array<{hop}>")
    lists = [F.coalesce(_get(at(f), f"array<{hop}>"), F.when(_get(at(f), hop).isNotNull(), F.array(_get(at(f), hop))), none) for f in (t.chain or ["chain"])]
    hops = F.filter(F.concat(*lists), lambda h: h.isNotNull())
    codes = [_list(at(f)) for f in t.code]
    every = F.filter(F.transform(F.concat(*codes), lambda c: F.trim(c)), lambda c: c.isNotNull() & (c != "")) if codes else F.array().cast("array<string>")
    first = F.array().cast("array<string>")
    described = F.lit(None).cast("variant")
    for f, c in reversed(list(zip(t.code, codes, strict=True))):
        names = ([t.partners[f]] if f in t.partners else []) + list(DESCRIPTION_NAMES)
        partner = F.lit(None).cast("variant")
        for n in reversed(names):
            partner = F.when(_text(at(n)) != "", at(n)).otherwise(partner)
        first, described = F.when(F.size(c) > 0, c).otherwise(first), F.when(F.size(c) > 0, partner).otherwise(described)
    skip = {"chain", t.memo, t.quotation, *t.chain, *t.code, *t.scalar, *t.graph, *CITATION_NAMES}
    shown = F.transform_values("data", lambda k, v: F.array_join(F.filter(_list(v), lambda x: F.trim(x) != ""), ", "))
    extra = F.map_filter(shown, lambda k, v: ~k.isin(*skip) & v.isNotNull() & (F.trim(v) != "") & (v != "None"))
    path = text.relative_path(F.col("file"), root) if root else F.lit(None).cast("string")
    return rows.select(
        "b", "id", "ref", hops.alias("hops"), every.alias("codes"), first.alias("first_codes"), described.alias("described"), at(t.memo).alias("memo"),
        _first_full(*(_text(at(f)) for f in (t.quotation, *CITATION_NAMES))).alias("chain_citation"),
        _first_full(*(_text(at(f)) for f in (t.quotation, t.memo, "text", "citation"))).alias("code_citation"),
        extra.alias("props"), path.alias("source_file"), "line",
    )


def _item(rows: DataFrame, mark: str, citation: str, described: Column, *more: str) -> DataFrame:
    return rows.select(item_id(mark).alias("item_id"), "b", "i", "ref", F.col(citation).alias("citation"), described.alias("description"), "source_file", F.col("line").alias("source_line"), F.col("id").alias("annotation_id"), F.map_filter("props", lambda k, v: ~k.isin(*PROTECTED)).alias("props"), *more)


def inferred_root(doc: DataFrame, includes: list[str]) -> str:
    """What is left of the first annotated file that ends with an included path, when that path is taken off its end.

    Files come as absolute paths of the machine that compiled, includes relative to the project.
    """
    rows = doc.select(F.posexplode(_get(F.col("corpus"), "array<variant>")).alias("b", "v"))
    return root_of(rows.select("b", F.try_variant_get("v", "$.traceability.file", "string").alias("file")), includes)


def root_of(files: DataFrame, includes: list[str]) -> str:
    """As inferred_root(), of files (b, file) in order of b."""
    known = [i.replace("\\", "/") for i in includes if i]
    if not known:
        return ""
    rows = files.select("b", F.translate("file", "\\", "/").alias("file"))
    fits = F.filter(F.array(*map(F.lit, known)), lambda i: F.endswith(F.col("file"), i))
    rows = rows.where(F.col("file").isNotNull()).withColumn("include", F.try_element_at(fits, F.lit(1))).where("include is not null")
    first = rows.agg(F.min_by(F.expr("left(file, length(file) - length(include))"), "b").alias("root")).first().root
    return (first or "").rstrip("/")


def load(spark: SparkSession, path: str, root: str | None = None) -> Graph:
    """The graph of an exported project.  Files are shown below ``root``, by default the one that includes give away."""
    doc = document(spark, path)
    small = _small(spark, path, "version", "template", "project", "indices", "export_metadata")
    if not small["template"] and not small["project"]:
        raise CompilationError(f"{path} is no exported project")
    warnings = [] if str(small["version"]).startswith("3") else [f"version {small['version'] or 'unknown'} of the export; made for 3"]
    if root is None:
        root = inferred_root(doc, [str(i["path"]) for i in (small["project"] or {}).get("includes") or [] if isinstance(i, dict) and i.get("path")])
    t = analyzed(small["template"])
    nodes, values = concepts(doc, t)
    every = blocks(doc, t, root)

    notes, shared = _list(F.col("memo")), F.when(~_is_list(F.col("memo")), _get(F.col("memo"), "string"))
    note = F.coalesce(F.when(_is_list(F.col("memo")), F.try_element_at(notes, F.col("i") + 1)), shared, F.lit(""))
    with_hops = every.where(F.size("hops") > 0).select("*", F.posexplode("hops").alias("i", "hop"))
    by_hop = _item(with_hops, "n", "chain_citation", note, "hop", "codes")
    told = F.when(_is_list(F.col("described")), F.try_element_at(_list(F.col("described")), F.col("i") + 1)).otherwise(_get(F.col("described"), "string"))
    by_code = _item(every.where((F.size("hops") == 0) & (F.size("first_codes") > 0)).select("*", F.posexplode("first_codes").alias("i", "code")), "c", "code_citation", F.coalesce(told, F.lit("")), "code")

    columns = ["item_id", "citation", "description", "source_file", "source_line", "annotation_id", "props"]
    items = by_hop.select(*columns).unionByName(by_code.select(*columns))
    located = by_hop.select("item_id", "ref").unionByName(by_code.select("item_id", "ref"))
    place = F.col("b") * F.lit(1 << 20) + F.col("i")
    ends = by_hop.select("item_id", place.alias("ord"), F.trim("hop.from").alias("source"), F.trim(F.coalesce("hop.relation", F.lit(""))).alias("rel"), F.trim("hop.to").alias("target")).where("source <> '' and target <> ''")
    means = F.create_map(*(F.lit(x) for kv in t.relations.items() for x in kv)) if t.relations else F.create_map().cast("map<string,string>")
    chains = ends.select("item_id", "source", "target", text.relation_type(F.col("rel")).alias("type"), F.coalesce(F.try_element_at(means, F.col("rel")), F.lit("")).alias("description"), "ord")
    criteria = by_hop.select("item_id", F.explode("codes").alias("concept"), F.lit(0).alias("mention_order"))
    mentions = (
        criteria.unionByName(ends.select("item_id", F.col("source").alias("concept"), F.lit(1).alias("mention_order")))
        .unionByName(ends.select("item_id", F.col("target").alias("concept"), F.lit(2).alias("mention_order")))
        .unionByName(by_code.select("item_id", F.col("code").alias("concept"), F.lit(1).alias("mention_order")))
    )

    nodes, chains, mentions, canon = _reconciled(spark, nodes, chains, mentions, (small["indices"] or {}).get("aliases") or {})
    species = (small["indices"] or {}).get("relations") or {}
    edges = [(a, b, SPECIES[k]) for k, pairs in species.items() if k in SPECIES for a, b in pairs]
    hierarchy = spark.createDataFrame(edges, "child string, parent string, type string")
    for c in ("child", "parent"):
        hierarchy = _renamed(hierarchy, canon, c)
    graph = Graph(
        concepts=nodes, values=values, sources=_sources(doc, every, t), items=items, from_source=located, mentions=mentions, chains=chains, hierarchy=hierarchy,
        concept_label=t.label, graph_fields=t.graph, field_specs=t.specs,
        source_values=_source_values(doc, every, t),
        context={
            "project": (small["project"] or {}).get("name", "project"), "description": (small["project"] or {}).get("description"), "compiled_at": (small["export_metadata"] or {}).get("timestamp"),
            "project_parts": small["project"], "template": small["template"], "export_metadata": small["export_metadata"], "root": root, "warnings": warnings,
        },
    )
    return graph


def _renamed(df: DataFrame, canon: DataFrame, column: str) -> DataFrame:
    """The column's names as the ontology spells them."""
    ids = df.select(column).distinct().withColumn("_id", text.identity(F.col(column)))
    known = ids.join(canon, ids["_id"] == canon["identity"]).select(F.col(column).alias("_old"), F.col("canonical").alias("_new"))
    return df.join(known, F.col(column) == F.col("_old"), "left").withColumn(column, F.coalesce("_new", column)).drop("_old", "_new")


def _reconciled(spark: SparkSession, nodes: DataFrame, chains: DataFrame, mentions: DataFrame, aliases: dict[str, str]) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Ends and mentions by the ontology's spelling; aliases give way to their targets, which list them."""
    if aliases:
        table = spark.createDataFrame(sorted(aliases.items()), "alias string, goal string")
        nodes = nodes.join(table.select(F.col("alias").alias("name")), "name", "left_anti")
    canon = nodes.select(text.identity(F.col("name")).alias("identity"), "name").groupBy("identity").agg(F.max("name").alias("canonical"))
    if aliases:
        goal = table.select(text.identity(F.col("alias")).alias("identity"), text.identity(F.col("goal")).alias("_goal"), "goal", "alias")
        known = canon.withColumnRenamed("identity", "_goal").withColumnRenamed("canonical", "_canonical")
        to = goal.join(known, "_goal", "left").select("identity", F.coalesce("_canonical", "goal").alias("canonical"), "alias")
        lists = to.groupBy("canonical").agg(F.sort_array(F.collect_list("alias")).alias("listed"))
        nodes = nodes.join(lists, nodes["name"] == lists["canonical"], "left").withColumn("aliases", F.col("listed")).drop("canonical", "listed")
        canon = canon.join(to.select("identity"), "identity", "left_anti").unionByName(to.select("identity", "canonical"))
    for c in ("source", "target"):
        chains = _renamed(chains, canon, c)
    mentions = _renamed(mentions, canon, "concept")
    if aliases:
        chains, mentions = chains.where("source <> target"), mentions.distinct()
    return nodes, chains, mentions, canon


def _source_values(doc: DataFrame, every: DataFrame, t: Template) -> DataFrame:
    """bibtex, field, value, ord: each value of the fields that identify or refer to entities, by first use of the source.

    Of a field's origins the bibliography counts unless it is blank there; lists give a row a value.
    """
    names = [n for part in linkage.declared(t.specs) for n in part]
    refs = every.groupBy("ref").agg(F.min("b").alias("ord"))
    if not names:
        return refs.select(F.col("ref").alias("bibtex"), F.lit("").alias("field"), F.lit("").alias("value"), "ord").limit(0)
    full = lambda v: F.filter(F.transform(_list(v), lambda x: F.trim(x)), lambda x: x != "")
    entry = lambda part: _entries(doc, part, "key").withColumn("f", _get(F.col("v"), "map<string,variant>")).select("key", *(full(F.try_element_at("f", F.lit(n))).alias(f"{part}_{n}") for n in names))
    both = entry("bibliography").join(entry("dataset"), "key", "full")
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    pick = lambda n: F.when(size(f"bibliography_{n}") > 0, F.col(f"bibliography_{n}")).otherwise(F.col(f"dataset_{n}")).alias(n)
    packed = both.select("key", F.struct(*map(pick, names)).alias("entry"))
    rows = linkage.tolerant_lookup(refs, "ref", packed, "key", "entry")
    pairs = F.array(*(F.struct(F.lit(n).alias("field"), F.col(f"entry.{n}").alias("list")) for n in names))
    rows = rows.select("ref", "ord", F.explode(pairs).alias("x")).select("ref", "ord", "x.field", F.explode("x.list").alias("value"))
    return rows.select(F.col("ref").alias("bibtex"), "field", "value", "ord")


def _sources(doc: DataFrame, every: DataFrame, t: Template) -> DataFrame:
    """A source per reference of the corpus, with the fields of bibliography and dataset; the bibliography wins."""
    names = list(dict.fromkeys([*SOURCE_FIELDS, *t.source]))
    entry = lambda part: _entries(doc, part, "key").withColumn("f", _get(F.col("v"), "map<string,variant>")).select("key", *(F.array_join(_list(F.try_element_at("f", F.lit(n))), ", ").alias(n) for n in names))
    known = linkage.merge_origins(entry("bibliography"), entry("dataset"), "key")
    refs = every.select("ref").distinct()
    packed = known.select("key", F.struct(*names).alias("entry"))
    out = linkage.tolerant_lookup(refs, "ref", packed, "key", "entry")
    more = [n for n in t.source if n not in SOURCE_FIELDS]
    props = F.create_map(*(x for n in more for x in (F.lit(n), F.col(f"entry.{n}")))) if more else F.create_map().cast("map<string,string>")
    return out.select(F.col("ref").alias("bibtex"), *(F.nullif(F.col(f"entry.{n}"), F.lit("")).alias(n) for n in SOURCE_FIELDS), F.map_filter(props, lambda k, v: v.isNotNull()).alias("props"))

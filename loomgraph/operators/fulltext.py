"""Full-text index with a row per field, and the analysis of words by language."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.model import Graph
from loomgraph.operators import search

#: Endings that a language's analyzer takes from words of five letters or more, one of each, in order (fixed values).
ENDINGS = {
    "english": (("ies$", "y"), ("(?:sses)$", "ss"), ("([^su])s$", "$1"), ("(?:ing|ed)$", "")),
    "portuguese": (("oes$", "ao"), ("ais$", "al"), ("ns$", "m"), ("([^s])s$", "$1"), ("(?:mente)$", ""), ("[aeo]$", "")),
    "spanish": (("ces$", "z"), ("([^s])s$", "$1"), ("(?:mente)$", ""), ("[aeo]$", "")),
    "french": (("eaux$", "eau"), ("aux$", "al"), ("([^s])s$", "$1"), ("(?:ment)$", ""), ("e$", "")),
    "german": (("(?:en|er|em|es|e|n|s)$", ""),),
    "italian": (("(?:mente)$", ""), ("[aeio]$", "")),
}
#: Other names of the same analyzers (fixed values).
ALIASES = {"brazilian": "portuguese", "standard-no-stop-words": "simple", "": "standard"}
KNOWN = ("standard", "simple", "whitespace", *ENDINGS)


@dataclass(frozen=True)
class Analyzer:
    """How text becomes terms.  Languages fold marks and take endings off; the others do neither."""

    name: str
    folds: bool = False
    endings: tuple[tuple[str, str], ...] = ()

    def terms(self, text: Column) -> Column:
        if self.name == "whitespace":
            return F.filter(F.split(text, r"\s+"), lambda x: x != "")
        words = search.tokens(text, folding=self.folds)
        if self.name == "simple":
            words = F.filter(F.flatten(F.transform(words, lambda w: F.split(w, r"[^\p{L}]+"))), lambda x: x != "")
        return F.transform(words, self._stem) if self.endings else words

    def _stem(self, word: Column) -> Column:
        out = word
        for ending, put in self.endings:
            out = F.when(F.length(out) > 4, F.regexp_replace(out, ending, put)).otherwise(out)
        return out


def analyzer(name: str | None) -> Analyzer:
    """By name or alias in any case, also by the last part of a class name (org.x.EnglishAnalyzer); unknown ones are standard."""
    wish = (name or "").strip().lower().rsplit(".", 1)[-1].removesuffix("analyzer")
    wish = ALIASES.get(wish, wish)
    return Analyzer(wish, wish in ENDINGS, ENDINGS.get(wish, ())) if wish in KNOWN else Analyzer("standard")


def once(names: Iterable[str]) -> list[str]:
    """Each name once, where it comes first."""
    return list(dict.fromkeys(names))


def fields_of(g: Graph) -> dict[str, list[str]]:
    """The indexed fields: of concepts the readable name, description and text properties; of items and sources their texts."""
    typed = {n: (str(s.get("scope") or "").upper(), str(s.get("type") or "TEXT").upper()) for n, s in g.field_specs.items() if isinstance(s, dict)}
    props = [n for n, (scope, kind) in typed.items() if scope == "ONTOLOGY" and kind in ("TEXT", "MEMO")]
    more = [n for n, (scope, kind) in typed.items() if scope == "SOURCE" and kind == "TEXT"]
    return {"concept": once(["search_name", "description", *props]), "item": ["citation", "description"], "source": once(["title", "abstract", *more])}


def _column(df: DataFrame, name: str) -> Column:
    """A field that is a column or a property; no text where it is neither."""
    if name in df.columns:
        return F.col(name).cast("string")
    return F.try_element_at("props", F.lit(name)).cast("string") if "props" in df.columns else F.lit(None).cast("string")


def index(docs: DataFrame, key: str, fields: Iterable[str], how: Analyzer) -> DataFrame:
    """id, field, term, tf, length: a row for each document, field and term; fields are analysed where the row lies."""
    texts = F.array(*(F.struct(F.lit(f).alias("field"), _column(docs, f).alias("text")) for f in once(fields)))
    rows = docs.select(F.col(key).cast("string").alias("id"), F.explode(texts).alias("x")).where("x.text is not null")
    rows = rows.select("id", "x.field", how.terms(F.col("x.text")).alias("terms"))
    return rows.select("id", "field", F.size("terms").alias("length"), F.explode("terms").alias("term")).groupBy("id", "field", "length", "term").agg(F.count(F.lit(1)).alias("tf")).select("id", "field", "term", "tf", "length")


def graph_index(g: Graph, name: str | None = None) -> DataFrame:
    """kind, id, field, term, tf, length over concepts, items and sources."""
    how, fields = analyzer(name), fields_of(g)
    parts = [("concept", g.concepts, "name"), ("item", g.items, "item_id"), ("source", g.sources, "bibtex")]
    out = None
    for kind, df, key in parts:
        one = index(df, key, fields[kind], how).select(F.lit(kind).alias("kind"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def found(index: DataFrame, query: str, name: str | None = None, k: int = 10) -> DataFrame:
    """id, score of the k best of an index by BM25 over all its fields, the query analysed as the index was."""
    spark = index.sparkSession
    wanted = spark.range(1).select(F.explode(analyzer(name).terms(F.lit(query))).alias("term")).distinct()
    whole = index.select("id", "field", "length").distinct().groupBy("id").agg(F.sum("length").alias("length"))
    facts = whole.agg(F.count(F.lit(1)).alias("n"), F.avg("length").alias("mean"))
    counts = index.join(F.broadcast(wanted), "term").groupBy("id", "term").agg(F.sum("tf").alias("tf"))
    df = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    rows = counts.join(df, "term").join(whole, "id").join(F.broadcast(facts))
    return rows.groupBy("id").agg(F.round(F.sum(search.weight()), 6).alias("score")).orderBy(F.desc("score"), "id").limit(k)

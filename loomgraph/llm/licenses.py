"""Licence scans with ordered signature rules, as DataFrame functions only.

Texts are split into words once.  Every rule needs a word (one of a few, where it has choices) that its pattern cannot do
without, so the words of a text, met with the set of all such words, tell which rules can match; most texts meet none and
are done.  For the others the words are joined by single spaces, and each rule left runs as an expression of its own with a
literal pattern, which Spark compiles once a task; it puts marks around its matches, and one pass over the pieces between
marks gives their places.  Detections that lie within another one are dropped, of equal ones all but that of the best
priority; where two overlap in part the better priority, then the longer one stays.  Everything happens within the row:
nothing is shuffled.

Fixed phrases are counted beside the rules, and their labels always stay.

Defined results: null text is empty and has no words; without detections the labels are empty strings, the score 0 and
first_word and last_word null; texts are whole however long; repeated rows give equal results; other columns may have any
names; empty input, empty output.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.license_rules import BASE, CONFIDENCE, NOTICE, Rule, rules

_APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The two characters beyond ASCII whose lower case begins with an ASCII letter, and words of their own to stand for them.
_FALSE_LETTERS = (("\u0130", "\ue000"), ("\u212a", "\ue001"))
#: Set around matches; the words of a text cannot hold it.
_MARK = "\x01"

_KEPT = "struct<s:int,less:int,priority:int,label:string,first:bigint,after:bigint>"
_PLACE = "struct<label:string,priority:int,base:boolean,s:int,e:int,first:bigint,after:bigint>"


def words_of(text: Column) -> Column:
    """Words in lower case; the first and the last may be empty."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    for false, stand_in in _FALSE_LETTERS:
        text = F.replace(text, F.lit(false), F.lit(stand_in))
    return F.split(F.lower(text), _APART, -1)


_GROUP = re.compile(r"\(\?:([^()]*)\)([?*+]|\{[^}]*\})?\??")
_HOLE = "\x00"
#: Words that say little about a text: a rule is gated by another one of its own, if it has any.
_COMMON = frozenset("the this that with from under work works your free software public version terms other copy source code program without source use used only any same".split())


def _hole(m: re.Match) -> str:
    """What stands for a group: a hole, set apart from the words beside it if the group brings the space itself."""
    choices = m[1].split("|")
    return (" " if all(c.startswith(" ") for c in choices) else "") + _HOLE + (" " if all(c.endswith(" ") for c in choices) else "")


def needed(pattern: str) -> frozenset[str]:
    """Words of which every match of the pattern holds at least one; none if there are no such words."""
    bare, before, choices = pattern, "", []
    while bare != before:
        choices += [m[1].split("|") for m in _GROUP.finditer(bare) if not m[2] and _HOLE not in m[1]]
        bare, before = _GROUP.sub(_hole, bare), bare
    found = []
    for token in bare.replace(" ?", "\x01").split(" "):
        ways = [token.replace("[sc]", c) for c in "sc"] if "[sc]" in token else [token]
        ways = [w for x in ways for w in ((x.split("\x01")[0], x.replace("\x01", "")) if x.count("\x01") == 1 else (x,))]
        if all(re.fullmatch("[a-z0-9]+", w) for w in ways):
            found.append(frozenset(ways))
    for group in choices:
        each = [needed(c) for c in group]
        if all(each):
            found.append(frozenset().union(*each))
    return max(found, key=lambda ws: (not ws & _COMMON, -len(ws) > -3, min(map(len, ws)), -len(ws)), default=frozenset())


def _quoted(text: str) -> str:
    return "r'" + text + "'"


def _tried(table: list[Rule]) -> tuple[str, list[Rule]]:
    """SQL for an array with, for each rule, the text with marks around its matches (null without one); and their order.

    Rules that need the same words are behind one test for these.  It is SQL as one string, for thousands of column objects
    take the driver longer to make than the scan.
    """
    groups: dict[frozenset[str], list[Rule]] = {}
    for r in table:
        groups.setdefault(needed(r.pattern), []).append(r)
    parts = []
    for need, group in groups.items():
        patterns = [_quoted(f"(?<= )(?:{r.pattern})(?= )") for r in group]
        runs = ", ".join(f"CASE WHEN norm RLIKE {p} THEN regexp_replace(norm, {p}, concat(char(1), '$0', char(1))) END" for p in patterns)
        test = " OR ".join(f"array_contains(met, '{w}')" for w in sorted(need)) or "true"
        parts.append(f"CASE WHEN {test} THEN array({runs}) ELSE array_repeat(CAST(NULL AS STRING), {len(group)}) END")
    return f"concat({', '.join(parts)})", [r for group in groups.values() for r in group]


def _run(table: list[Rule], base: list[Rule]) -> Column:
    """label, priority, base and marked text of every rule that matches; over the columns norm and met."""
    tried, order = _tried([*base, *table])
    kinds = {id(r) for r in base}
    told = F.expr("array(" + ", ".join(f"named_struct('label', '{r.label}', 'priority', {r.priority}, 'base', {'true' if id(r) in kinds else 'false'})" for r in order) + ")")
    both = F.zip_with(told, F.expr(tried), lambda t, m: F.when(m.isNotNull(), F.struct(t["label"].alias("label"), t["priority"].alias("priority"), t["base"].alias("base"), m.alias("marked"))))
    return F.filter(both, lambda x: x.isNotNull())


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _places(x: Column) -> Column:
    """A rule's detections: begin and end in characters, first word and the word after the last.

    Every second piece between marks is a match; a match begins and ends at words, so spaces count words.
    """
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("words"), F.lit(False).alias("hit"), F.array().cast(f"array<{_PLACE}>").alias("out"))

    def step(acc: Column, piece: Column) -> Column:
        at, words = acc["at"] + F.length(piece), acc["words"] + _spaces(piece)
        first = (acc["words"] - 1).cast("long")
        one = F.struct(x["label"].alias("label"), x["priority"].alias("priority"), x["base"].alias("base"), acc["at"].alias("s"), at.alias("e"), first.alias("first"), words.cast("long").alias("after"))
        return F.struct(at.alias("at"), words.alias("words"), (~acc["hit"]).alias("hit"), F.when(acc["hit"], F.concat(acc["out"], F.array(one))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(F.split(x["marked"], _MARK, -1), start, step, lambda acc: acc["out"])


def _within(found: Column) -> Column:
    """Without detections that lie within another; of equal ones the best priority, then the first label."""
    order = F.transform(found, lambda d: F.struct(d["s"].alias("s"), (-d["e"]).alias("less"), d["priority"].alias("priority"), d["label"].alias("label"), d["first"].alias("first"), d["after"].alias("after")))
    start = F.struct(F.lit(-1).alias("far"), F.array().cast(f"array<{_KEPT}>").alias("kept"))
    step = lambda acc, d: F.when(-d["less"] > acc["far"], F.struct((-d["less"]).alias("far"), F.concat(acc["kept"], F.array(d)).alias("kept"))).otherwise(acc)
    return F.aggregate(F.sort_array(order), start, step, lambda acc: acc["kept"])


def _apart(kept: Column) -> Column:
    """In order of place, a detection that overlaps the one before it replaces it or goes."""

    def step(acc: Column, d: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        clash = last.isNotNull() & (d["s"] < -last["less"])
        longer = (-d["less"] - d["s"]) > (-last["less"] - last["s"])
        better = (d["priority"] < last["priority"]) | ((d["priority"] == last["priority"]) & longer)
        return F.when(~F.coalesce(clash, F.lit(False)), F.concat(acc, F.array(d))).when(better, F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(d))).otherwise(acc)

    return F.aggregate(kept, F.array().cast(f"array<{_KEPT}>"), step)


def scanned(docs: DataFrame, table: list[Rule] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections ("label:first:end" in words)."""
    table = rules() if table is None else table
    base = [Rule(label, NOTICE, phrase, phrase) for phrase, label in BASE]
    gates = sorted(frozenset().union(*(needed(r.pattern) for r in [*table, *base])))
    free = any(not needed(r.pattern) for r in table)
    out = docs.select("doc_id", words_of(docs["text"]).alias("words"))
    apart = lambda place: F.when(F.element_at("words", F.lit(place)) == "", 1).otherwise(0)
    n_words = F.greatest(F.size("words") - apart(1) - apart(-1), F.lit(0)).cast("long")
    met = F.array_intersect("words", F.expr("array(" + ", ".join(f"'{w}'" for w in gates) + ")"))
    out = out.select("doc_id", n_words.alias("n_words"), met.alias("met"), F.when(F.lit(free) | (F.size(met) > 0), F.concat(F.lit(" "), F.trim(F.array_join("words", " ")), F.lit(" "))).alias("norm"))
    nothing = F.array().cast(f"array<{_PLACE}>")
    out = out.select("doc_id", "n_words", F.when(F.col("norm").isNotNull(), F.flatten(F.transform(_run(table, base), _places))).otherwise(nothing).alias("found"))
    out = out.select("doc_id", "n_words", F.filter("found", lambda d: d["base"]).alias("base"), F.when(F.size("found") > 0, _apart(_within(F.col("found")))).alias("kept"))
    place = lambda how: F.when(F.size("base") > 0, how(F.transform("base", lambda d: d["first"])))
    sure = F.create_map(*(x for k, v in CONFIDENCE.items() for x in (F.lit(k), F.lit(v))))
    base_labels = F.array_sort(F.array_distinct(F.transform("base", lambda d: d["label"])))
    kept_labels = F.coalesce(F.transform("kept", lambda d: d["label"]), F.array().cast("array<string>"))
    best = F.coalesce(F.array_max(F.transform("kept", lambda d: F.element_at(sure, d["priority"]))), F.lit(0.0))
    shown = F.transform("kept", lambda d: F.concat_ws(":", d["label"], d["first"], d["after"]))
    return out.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        place(F.array_min).alias("first_word"),
        place(F.array_max).alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base_labels, kept_labels))), ",").alias("labels"),
        best.alias("score"),
        F.coalesce(F.array_join(shown, ","), F.lit("")).alias("detections"),
    )

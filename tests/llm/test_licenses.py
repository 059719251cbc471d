import random
import re

from loomgraph.llm import license_rules, licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text):
    w = words(text)
    places, labels = [], set()
    for phrase, label in BASE.items():
        p = phrase.split()
        for i in range(len(w)):
            if w[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def brute_rules(text):
    """Detections kept: (label, first word, last word + 1)."""
    w = words(text)
    norm = " " + "".join(x + " " for x in w)
    found = []
    for r in [*license_rules.rules(), *(license_rules.Rule(v, license_rules.NOTICE, k, k) for k, v in BASE.items())]:
        found += [(m.start(), -m.end(), r.priority, r.label) for m in re.finditer(f"(?<= )(?:{r.pattern})(?= )", norm)]
    kept, far = [], -1
    for d in sorted(found):
        if -d[1] > far:
            kept.append(d)
            far = -d[1]
    out = []
    for d in kept:
        if out and d[0] < -out[-1][1]:
            last = out[-1]
            if (d[2], -(-d[1] - d[0])) < (last[2], -(-last[1] - last[0])):
                out[-1] = d
            continue
        out.append(d)
    at = lambda c: norm[:c].count(" ") - 1
    return [f"{d[3]}:{at(d[0])}:{at(-d[1]) + 1}" for d in out]


def made():
    rng = random.Random(3)
    bits = ["MIT License", "mit", "license", "CC-BY", "CC-BY-SA-4.0", "apache license, version 2.0", "the GNU General Public License version 3 or later", "gnu", "SPDX-License-Identifier: Apache-2.0", "K", "É", "foo", "Released under the MIT license", "all rights reserved", "Copyright (c) 2019", "cc by nc nd 3.0", "GPL v2", "redistribution and use in source and binary forms, with or without modification, are permitted"]
    docs = [(i, rng.choice([" ", "\n", " * "]).join(rng.choice(bits) for _ in range(rng.randrange(0, 14)))) for i in range(150)]
    return docs + [(900, None), (901, ""), (902, "..."), (903, "mit license mit license"), (904, "x " * 20000 + "the MIT License"), (905, "mit-license"), (906, "mitlicense")] + odd()


def odd():
    """Letters whose lower case holds ASCII letters, repeats, very long texts, and bodies without the licence's name."""
    body = "Everyone is free.\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY"
    return [(907, "m\u0130t license"), (908, "blue oa\u212a model license"), (909, "MIT License " * 900), (909, "MIT License " * 900), (910, body), (911, "\u03a3 \u03a3\u03a3. GNU GPL"), (912, ("words and words " * 30_000) + body + " CC BY 4.0")]


def test_against_the_words_and_every_rule(spark):
    docs = made()
    rows = licenses.scanned(spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, norm string")).collect()
    assert len(rows) == len(docs) and len(set(rows)) == len(dict(docs))
    got = {r.doc_id: r for r in rows}
    for d, text in docs:
        r = got[d]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(text), text
        kept = brute_rules(text)
        assert r.detections.split(",") == (kept or [""]), text
        assert r.labels == ",".join(sorted({x.split(":")[0] for x in kept} | set(filter(None, r.base_labels.split(",")))))
        assert (r.score > 0) == bool(kept)


def test_every_rule_needs_its_words():
    """The prefilter never changes results: whatever a pattern matches holds one of its words."""
    for r in license_rules.rules():
        need = licenses.needed(r.pattern)
        assert need, r
        for pick in range(6):
            assert need & set(spelled(r.pattern, pick).split()), (r, need, spelled(r.pattern, pick))
    assert len(license_rules.rules()) > 200
    assert len(license_rules._TEXTS) + len(license_rules._BODIES) > 214


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "mit license")], "doc_id long, text string")
    assert not re.search("Python|Arrow|Pandas", licenses.scanned(docs)._jdf.queryExecution().executedPlan().toString())
    assert licenses.scanned(docs.limit(0)).count() == 0


def test_every_signature_finds_itself():
    """A text made of a signature's own words is matched by it."""
    for r in (license_rules.Rule(*x) for x in (*license_rules._TEXTS, *license_rules._BODIES)):
        text = f" {spelled(r.pattern)} "
        assert re.search(f"(?<= )(?:{r.pattern})(?= )", text), r


def spelled(pattern, pick=0):
    """A text that the pattern matches; ``pick`` chooses among choices and (if odd) leaves optional parts out."""
    parse = re._parser.parse(pattern)

    def of(items):
        out = ""
        for op, arg in items:
            name = str(op)
            if name == "LITERAL":
                out += chr(arg)
            elif name == "IN":
                kind, value = arg[0]
                literal = [chr(v) for k, v in arg if str(k) == "LITERAL"]
                out += literal[pick % len(literal)] if literal else "7" if "DIGIT" in str(value) else "x"
            elif name in ("MAX_REPEAT", "MIN_REPEAT"):
                low, high, inner = arg
                out += of(inner) * max(low, min(1 - pick % 2, high))
            elif name == "SUBPATTERN":
                out += of(arg[3])
            elif name == "BRANCH":
                out += of(arg[1][pick % len(arg[1])])
            else:
                raise AssertionError(name)
        return out

    return of(parse)

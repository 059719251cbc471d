"""Secret scans: fixed patterns, and novelty against a primed zstandard dictionary.

Three kinds of spans come from fixed patterns (assign, access, hex).  The kind ``novel`` comes from novelty: a long run of
key characters near a sensitive word is compressed behind its surrounding code, with a dictionary of identifiers loaded
into the compressor; the bytes that it adds, a byte of its own each if nothing is known of it, are its novelty.  Runs that
add at least ``NOVELTY`` of their length are reported unless a pattern has them already.  A run of NAME=value is judged by
its values, a name with a value behind it (token_value) by what follows the sensitive word; either may hold the word itself.

What is measured is set by ``Scan``: a candidate has ``least`` characters or more, begins at most ``reach`` characters behind
a sensitive word, and is set beside ``around`` characters on either side.  It needs a letter and a digit as long as
``mixed`` holds: of sixteen letters that no dictionary has, compression cannot tell whether they are a key or a long word
(internationalization adds all of its twenty bytes).

Texts are read where they lie; nothing is shuffled.  Cheap byte searches decide which patterns a text needs.

Defined results: null text is empty; without spans the strings are empty (and the hash that of the empty string); texts
and runs are whole, however long; ill-formed UTF-8 counts as replacement characters; rows are judged one by one, so
repeated rows give equal results; other columns may have any names.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import octets, shown_text, sliced

KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_ASSIGN, LEAST_ACCESS = 12, 18
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

#: Words that make the text behind them sensitive, and how far behind them (fixed values).
SENSITIVE = ("secret", "token", "passw", "passphrase", "credential", "private", "apikey", "api_key", "api-key", "access_key", "access-key", "auth", "bearer", "signature", "session", "cookie", "webhook", "client_id", "connectionstring")
SENSITIVE_WORD = re.compile("|".join(map(re.escape, SENSITIVE)), re.A | re.I)
RUN = re.compile(r"[A-Za-z0-9+/_~=-]{16,}")
#: What inner equals signs leave of a run; those at its end are padding.
PIECE = re.compile(r"[A-Za-z0-9+/_~-]+(?:=+(?![A-Za-z0-9+/_~=-]))?")
#: Between a sensitive word and a value within a run, and words of a name that may follow there.
JOINT, NAME_WORDS = re.compile(r"[+/_~-]*"), re.compile(r"(?:[A-Za-z]+[+/_~-]+)*")
LEVEL = 12


@dataclass(frozen=True)
class Scan:
    reach: int = 64
    around: int = 600
    least: int = 16
    mixed: bool = True
    novelty: float = 0.7


SCAN = Scan()

#: Identifiers and phrases of code and configuration that prime the dictionary (fixed values).
IDENTIFIERS = """
abstract account address admin allow alias api application argument array assert async attribute author authorization available await
backend background base64 batch begin binary block body boolean branch bucket buffer build byte cache callback catch certificate
channel character charset class client cluster code collection column command comment commit common component config configuration
connect connection console const constructor container content context controller convert cookie copy count create credential cursor
database dataset date debug decode default define delete deploy description deserialize destination development device dict
directory disable document domain double download driver duration dynamic element email enable encode encoding encrypt endpoint
engine entity enum environment error event example exception execute exit export expression extend extension factory failed false
field file filter final flag float folder format frame framework function future generate generic get global group handle handler
hash header height hidden home host html http https identifier image implement import include index info init initial inner input
insert instance integer interface internal interval invalid item iterator json keyword label lambda language last layout length level
library license limit line link list listen load local location lock log logger login logout main manager map master match max memory
message metadata method metric migration min mode model modify module monitor multiple mutable mutex name namespace native network
next node normal notification null number object offset open operation operator option order organization output override owner
package page param parameter parent parse partition password path pattern payload permission pipeline platform plugin pointer policy
port position prefix previous primary print priority private process production profile program project property protected protocol
provider proxy public publish push python query queue random range raw read readonly receive record recursive redirect reference
refresh region register registry release remote remove rename render replace report repository request require reset resource
response result return role root route router rule runtime sample save schema scheme scope script search secret section security
select send sequence serialize server service session setting setup shared shell signature simple size snapshot socket source
span split stack standard start state static status storage store stream string struct style submit subscribe success suffix super
support switch symbol sync syntax system table tag target task template temp test text thread time timeout timestamp title token
tool topic trace track transaction transfer transform true type unique unit unknown update upload url user username util uuid valid
validate value variable vector verify version view virtual void volume wait warning watch web width window worker workspace wrapper
write xml yaml zone 0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ
"""

_HEX_RUN = bytes(48 if chr(c) in "0123456789abcdef" else 32 for c in range(256))
_HEX_ENOUGH = b"0" * 16


def _dictionary() -> zstandard.ZstdCompressionDict:
    words = IDENTIFIERS.split()
    spelled = [*words, *(w.capitalize() for w in words), *(w.upper() for w in words)]
    primed = zstandard.ZstdCompressionDict(" ".join(spelled).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    primed.precompute_compress(level=LEVEL)
    return primed


_compressor: zstandard.ZstdCompressor | None = None


def novelty(before: str, run: str, after: str) -> float:
    """Bytes that the run adds to the compressed surroundings, as a share of its own."""
    global _compressor
    if _compressor is None:
        _compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(), write_content_size=False, write_checksum=False)
    known = (after + "\n" + before).encode()
    added = len(_compressor.compress(known + run.encode())) - len(_compressor.compress(known))
    return added / len(run.encode())


def base_spans(raw: bytes, text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the secret itself) of the fixed patterns."""
    out = []
    low = raw.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    if b"AKIA" in raw:
        out += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    if _HEX_ENOUGH in raw.translate(_HEX_RUN):
        out += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(out)


_SENSITIVE_BYTES = tuple(w.encode() for w in SENSITIVE)


def novel_spans(raw: bytes, text: str, known: list[tuple[int, int, int, int]], scan: Scan = SCAN) -> list[tuple[int, int, int, int]]:
    low = raw.lower()
    if not any(w in low for w in _SENSITIVE_BYTES):
        return []
    ends = [m.end() for m in SENSITIVE_WORD.finditer(text)]
    if not ends:
        return []
    out = []
    starts = [k[0] for k in known]
    furthest, top = [], 0
    for k in known:
        top = max(top, k[2])
        furthest.append(top)

    def near(s: int) -> bool:
        i = bisect.bisect_right(ends, s) - 1
        return i >= 0 and s - ends[i] <= scan.reach

    def novel(s: int, e: int) -> bool:
        run = text[s:e]
        if len(run) < scan.least or scan.mixed and not (re.search("[0-9]", run) and re.search("[A-Za-z]", run)):
            return False
        j = bisect.bisect_right(starts, s) - 1
        if j >= 0 and furthest[j] > s or j + 1 < len(starts) and starts[j + 1] < e:
            return False
        return novelty(text[max(0, s - scan.around) : s], run, text[e : e + scan.around]) >= scan.novelty

    def behind(s: int, e: int) -> int | None:
        """Where a value begins behind the first sensitive word that ends within the piece, and not within a word."""
        for end in ends[bisect.bisect_right(ends, s) : bisect.bisect_left(ends, e)]:
            if not text[end].isalpha():
                at = JOINT.match(text, end, e).end()
                return next((v for v in dict.fromkeys((at, NAME_WORDS.match(text, at, e).end())) if novel(v, e)), None)
        return None

    for m in RUN.finditer(text):
        s, e = m.span()
        here = bisect.bisect_left(ends, e)
        if not here or s - ends[here - 1] > scan.reach:
            continue
        found = []
        for piece in PIECE.finditer(text, s, e):
            ps, pe = piece.span()
            if pe - ps >= scan.least:
                v = ps if near(ps) and novel(ps, pe) else behind(ps, pe)
                found += [] if v is None else [(v, 3, pe, v)]
        if not found and near(s) and novel(s, e):
            found = [(s, 3, e, s)]
        out += found
    return out


def spans_of(raw: bytes | None, scan: Scan = SCAN) -> tuple[list[tuple[int, int, int, int]], list[tuple[int, int, int, int]]]:
    """Spans of the fixed patterns, and all spans, both by start and kind."""
    if not raw:
        return [], []
    if not (suspicious(raw)):
        return [], []
    text = shown_text(raw)
    base = base_spans(raw, text)
    return base, sorted(base + novel_spans(raw, text, base, scan))


def suspicious(raw: bytes) -> bool:
    low = raw.lower()
    return any(w in low for w in ASSIGN_WORDS) or b"AKIA" in raw or _HEX_ENOUGH in raw.translate(_HEX_RUN) or any(w in low for w in _SENSITIVE_BYTES)


def shown(spans: list[tuple[int, int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, _ in spans)


def findings(docs: DataFrame, scan: Scan = SCAN) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_novel, base_sha256, spans ("kind:start:end", code points, comma-joined)."""
    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            both = [spans_of(t, scan) for t in octets(b.column("text"))]
            count = lambda kind: pa.array([sum(s[1] == kind for s in every) for _, every in both], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), count(0), count(1), count(2), count(3), pa.array([hashlib.sha256(shown(base).encode()).hexdigest() for base, _ in both], pa.string()), pa.array([shown(every) for _, every in both], pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "n_novel", "base_sha256", "spans"],
            )

    return narrow.mapInArrow(found, f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, n_novel bigint, base_sha256 string, spans string")


def redacted(raw: bytes | None, mark: str = "[SECRET]", scan: Scan = SCAN) -> bytes | None:
    """The text with the secrets themselves, not the names they are assigned to, replaced by a mark."""
    _, spans = spans_of(raw, scan)
    if not spans:
        return raw
    text, out, at = shown_text(raw), [], 0
    for s, e in sorted((v, e) for _, _, e, v in spans):
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]]).encode()


def scrubbed(docs: DataFrame, mark: str = "[SECRET]", scan: Scan = SCAN) -> DataFrame:
    """docs with secrets replaced in ``text``; ``n_chars``, if there is one, is counted anew for changed texts."""

    def scrub(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            texts = octets(b.column("text"))
            new = [redacted(t, mark, scan) for t in texts]
            columns = {name: b.column(i) for i, name in enumerate(b.schema.names)}
            columns["text"] = pa.array(new, pa.binary()).view(pa.string())
            if "n_chars" in columns:
                held = columns["n_chars"].to_pylist()
                columns["n_chars"] = pa.array([h if x is y else len(shown_text(y)) for h, x, y in zip(held, texts, new, strict=True)], columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return docs.mapInArrow(scrub, docs.schema)

"""Secret scans: known formats, and strings that a primed compressor finds new.

Base spans are three fixed patterns (``assign``, ``access``, ``hex``).  The
method adds ``novel`` spans: tokens in a sensitive context that do not compress.
A context is a word such as password, secret, token or key shortly before on
the line; if the line ends after it with a sign such as ":" or "=", also the
start of the next line or the whole block that is indented deeper; the string's
own public prefix (``PREFIXES``); and the body of a private key's PEM block,
which is measured as a whole.
A candidate's novelty is the number of bytes that it adds to the zstandard
frame of its surroundings, the compressor being primed with a dictionary of
identifiers: what the code around it or common identifiers already contain
costs almost nothing, a random string costs close to its entropy.  Copies of
the candidate itself are blanked out of the surroundings first, so a secret
that is repeated nearby is found at each of its places.  Reported are
candidates of at least ``min_ratio`` marginal bytes per character.

One map over whole texts, no shuffle.  Offsets are code points, end exclusive.
The contexts are merged and each run of token characters is met once, measured
whole and, behind a sensitive word inside it, from there: time grows with the
text.  Runs of more than ``LONG`` characters are measured without surroundings.

Defined results: null and empty texts have no spans; a candidate that one base
span covers wholly is not measured, one that reaches beyond it is, and its novel
span then overlaps the base span, which always stays; repeated rows are
repeated; an empty table gives an empty result; ``redact`` passes all columns
through, null text stays null.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import plain_names

# The base patterns, in the order in which kinds are listed.
KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_ASSIGN, MIN_ACCESS = 6, 20
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

SENSITIVE = re.compile(r"passw(?:or)?d|passphrase|secret|token|credential|bearer|authorization"
                       r"|api[_ -]?key|access[_ -]?key|private[_ -]?key|client[_ -]?id", re.IGNORECASE | re.ASCII)
MIN_CANDIDATE = 16
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_CANDIDATE, re.ASCII)

# Public prefixes by which issuers mark their keys.
PREFIXES = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "github_pat_", "glpat-", "xoxa-", "xoxb-", "xoxp-", "xoxr-",
            "xoxs-", "sk-proj-", "sk-ant-", "sk_live_", "rk_live_", "AIza", "npm_", "pypi-", "hf_", "eyJ")
PREFIX = re.compile("(?<![A-Za-z0-9])(?:" + "|".join(sorted(PREFIXES, key=len, reverse=True)) + ")")
# A line that ends with one of these signs has its value below.
OPEN = ":=>|({[\\"
INDENT = re.compile(r"[ \t]*+")
PEM = re.compile(r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----")
PEM_BODY = re.compile(r"(?:(?:\\n|\s)*+(?:(?:Proc-Type|DEK-Info|Version|Comment):[^\n]*+|[A-Za-z0-9+/=]{16,}+"
                      r"|[A-Za-z0-9+/=]++(?=(?:\\n|\s)*+-----END)))*+")
LONG = 4096

# Identifiers that code around secrets is made of; primes the compressor.
IDENTIFIERS = (
    "access account admin api application auth authorization base64 bearer branch bucket build cache callback "
    "certificate class client cluster cmd code commit compile config configuration connection const container "
    "context cookie credential credentials database debug default delete deploy description dictionary directory "
    "document domain download email enabled encoding encrypt endpoint environment error event example exception "
    "export expires false field file filename function gateway generate github handler hash header hostname http "
    "https identifier import include index instance integer interface internal json key language length library "
    "license local localhost login manager message metadata method module monitor name namespace network null "
    "number object option organization output package parameter passphrase password path permission policy port "
    "private process production profile project property protocol provider proxy public query queue record refresh "
    "region register release remote repository request resource response result return role schema script secret "
    "security select self sender server service session setting signature source ssh state static status storage "
    "string subject system table target template test token transaction true type update upload url user username "
    "uuid value variable version virtual webhook window worker workspace abcdefghijklmnopqrstuvwxyz "
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 0123456789abcdef")


def base_spans(text: str) -> list[tuple[int, int, int, int, int]]:
    """(start, end, kind, secret start, secret end) of the fixed patterns."""
    found = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), m.end(), 0, m.start(2), m.end(2)) for m in ASSIGN.finditer(text)
                  if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1, m.start(), m.end()) for m in ACCESS.finditer(text)
                  if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), m.end(), 2, m.start(), m.end()) for m in HEX.finditer(text)]
    return found


class Novelty:
    """Marginal compressed bytes, the compressor primed with identifiers."""

    def __init__(self, identifiers: str = IDENTIFIERS, level: int = 3):
        prime = zstandard.ZstdCompressionDict(identifiers.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.zstd = zstandard.ZstdCompressor(level=level, dict_data=prime, write_content_size=False)

    def ratio(self, around: str, candidate: str) -> float:
        base, own = around.encode("utf-8", "replace"), candidate.encode("utf-8", "replace")
        return (len(self.zstd.compress(base + b"\n" + own)) - len(self.zstd.compress(base))) / len(own)


def surroundings(text: str, start: int, end: int, context: int) -> str:
    """``context`` characters on either side of text[start:end], its own other
    occurrences blanked (also those without the signs around it, and of its
    long parts between "=" signs)."""
    if end - start > LONG:
        return ""
    own, reach = text[start:end], context + end - start     # copies across the border count too
    before, after = text[max(0, start - reach):start], text[end:end + reach]
    for copy in [own, *(p for p in own.strip("+/_=-").split("=") if len(p) >= MIN_CANDIDATE)]:
        blank = " " * len(copy)
        before, after = before.replace(copy, blank), after.replace(copy, blank)
    return before[max(0, len(before) - context):] + after[:context]


def contexts(text: str, words: list, reach: int) -> list[list[int]]:
    """Ranges in which a candidate may begin, merged, ascending: after each
    sensitive word, and on the lines below it where the line ends open."""
    zones: list[list[int]] = []

    def add(lo, hi):
        if zones and lo <= zones[-1][1]:
            zones[-1][1] = max(zones[-1][1], hi)
        else:
            zones.append([lo, hi])

    for _, end in words:
        line_end = text.find("\n", end, end + reach)
        add(end, end + reach if line_end < 0 else line_end)
        if line_end < 0 or zones[-1][1] > line_end or not text[end:line_end].rstrip(" \t\r\"'`").endswith(tuple(OPEN)):
            continue            # not open, or inside the block of a word before
        line = text.rfind("\n", 0, end) + 1
        depth = INDENT.match(text, line).end() - line
        at = line_end + 1
        first = INDENT.match(text, at).end()
        add(at, first + reach if (stop := text.find("\n", first, first + reach)) < 0 else stop)
        while at < len(text):                               # the lines that are indented deeper
            first = INDENT.match(text, at).end()
            stop = text.find("\n", first)
            stop = len(text) if stop < 0 else stop
            if first < stop and first - at <= depth:
                break
            add(at, stop)
            at = stop + 1
    return zones


def private_keys(text: str) -> list[tuple[int, int]]:
    """Bodies of the PEM blocks of private keys."""
    found = []
    for m in PEM.finditer(text) if "PRIVATE KEY" in text else ():
        lo, hi = m.end(), PEM_BODY.match(text, m.end()).end()
        while lo < hi and (text[lo].isspace() or text.startswith("\\n", lo)):
            lo += 2 if text[lo] == "\\" else 1
        if hi - lo >= MIN_CANDIDATE:
            found.append((lo, hi))
    return found


def novel_spans(text: str, taken: list, novelty: Novelty, *, context: int, reach: int,
                min_ratio: float) -> list[tuple[int, int, int, int, int]]:
    keys = private_keys(text)
    found = [(s, e, 3, s, e) for s, e in keys if novelty.ratio("", text[s:e]) >= min_ratio]
    words = [m.span() for m in SENSITIVE.finditer(text)]
    own_prefix = [m.start() for m in PREFIX.finditer(text)] if any(p in text for p in PREFIXES) else []
    if not words and not own_prefix:
        return found
    zones = contexts(text, words, reach)
    starts, ends = [z[0] for z in zones], [e for _, e in words]
    covers = sorted([(b[0], b[1]) for b in taken] + keys)
    first_cover, furthest = [c[0] for c in covers], list(accumulate((c[1] for c in covers), max))

    def fresh(s, e):        # a span that begins no later and ends no earlier covers it
        at = bisect_right(first_cover, s)
        return not at or furthest[at - 1] < e

    def is_new(s, e):
        return e - s >= MIN_CANDIDATE and fresh(s, e) and \
            novelty.ratio(surroundings(text, s, e, context), text[s:e]) >= min_ratio

    for m in CANDIDATE.finditer(text):
        s, e = m.span()
        z = bisect_right(starts, s) - 1
        at = bisect_right(own_prefix, e) - 1
        if z >= 0 and s < zones[z][1] or at >= 0 and own_prefix[at] >= s:
            if is_new(s, e):
                found.append((s, e, 3, s, e))
                continue
        k = bisect_right(ends, e - MIN_CANDIDATE) - 1       # behind the last sensitive word inside
        if k >= 0 and ends[k] > s and is_new(ends[k], e):
            found.append((ends[k], e, 3, ends[k], e))
    return found


def find_secrets(text: str | None, novelty: Novelty, *, context: int = 256, reach: int = 48,
                 min_ratio: float = 0.55) -> list[tuple[int, int, int, int, int]]:
    """All spans of one text, by start, then kind."""
    if not text:
        return []
    base = base_spans(text)
    return sorted(base + novel_spans(text, base, novelty, context=context, reach=reach,
                                     min_ratio=min_ratio))


_STRUCT = pa.list_(pa.struct([("kind", pa.string()), ("first", pa.int64()), ("end", pa.int64()),
                              ("secret_first", pa.int64()), ("secret_end", pa.int64())]))


def scan_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 **options) -> DataFrame:
    """Per document row: doc_id and spans (kind, first, end and the part that is the secret)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        novelty = Novelty()
        for b in batches:
            spans = [[{"kind": KINDS[k], "first": s, "end": e, "secret_first": x, "secret_end": y}
                      for s, e, k, x, y in find_secrets(t, novelty, **options)]
                     for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(spans, _STRUCT)],
                                             ["doc_id", "spans"])

    return rows.mapInArrow(run, f"doc_id {id_type}, spans array<struct<kind:string,first:bigint,"
                                f"end:bigint,secret_first:bigint,secret_end:bigint>>")


def mask(text: str | None, spans: list, replacement: str) -> str | None:
    """``text`` with the secret part of every span replaced, overlaps as one."""
    if not spans:
        return text
    out, at = [], 0
    for lo, hi in sorted((x, y) for _, _, _, x, y in spans):
        if hi > at:
            out += [text[at:lo], replacement] if lo >= at else []
            at = hi
    return "".join(out) + text[at:]


def redact(docs: DataFrame, *, text_col: str = "text", replacement: str = "[SECRET]",
           length_col: str | None = None, **options) -> DataFrame:
    """``docs`` with every secret replaced in the text; ``length_col`` is set
    to the new length in code points where the text changed."""
    given, (docs, plain) = docs.columns, plain_names(docs)
    names, text_col, length_col = docs.columns, plain[text_col], plain.get(length_col)

    def run(batches):
        novelty = Novelty()
        for b in batches:
            texts = b.column(text_col).to_pylist()
            new = [mask(t, find_secrets(t, novelty, **options), replacement) for t in texts]
            if new == texts:
                yield b
                continue
            cols = {n: b.column(i) for i, n in enumerate(b.schema.names)}
            cols[text_col] = pa.array(new, b.schema.field(text_col).type)
            if length_col is not None:
                old = cols[length_col].to_pylist()
                cols[length_col] = pa.array([o if n == t else len(n) for o, n, t in zip(old, new, texts)],
                                            b.schema.field(length_col).type)
            yield pa.RecordBatch.from_arrays([cols[n] for n in names], names)

    return docs.mapInArrow(run, docs.schema).toDF(*given)

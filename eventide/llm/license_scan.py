"""License scans: fuzzy search for short license notices.

Texts are lower-cased (A-Z) and reduced to their words (``common.WORD_BYTES``)
with one space between them.  Base places are the exact ones: the words of a
phrase one after another.  Beyond them, a notice may differ by up to
``int(len * max_error)`` single-character edits.  Pigeonhole: cut into one
piece more than that, at least one piece must occur unchanged; the pieces of
all notices are searched exactly in one pass (Aho-Corasick), and only around a
found piece does the regex library's bounded-error matching verify the edits
and report the span.  A place counts if it starts and ends at word borders.

A notice may have tails: words that follow it without edits and tell its
version, or in an SPDX line its licence (one letter parts ``gpl`` from
``lgpl`` there, so edits are only allowed before it).  A notice table of one's
own is a DataFrame; ``max_notices`` bounds it.

All of it is one map over whole texts: no shuffle, and a hot document only
costs its own length.

Defined results: null and empty texts have no words, no labels and score 0;
the score is 1 with a base place, else 1 - edits / length of the best
notice found; of two tails that fit the longer counts; spans overlap freely between labels, of overlapping neighbours
with one label the better (fewer edits, then longer) stays, exact ones always; repeated rows are
repeated; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import WORD_BYTES, utf8

# Phrases whose exact places are counted, and their labels.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Short notices searched with edits, and their labels.
NOTICES = {
    "released under the mit license": "mit",
    "licensed under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the apache license": "apache",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "redistribution and use in source and binary forms": "bsd",
    "licensed under the bsd license": "bsd",
    "licensed under cc by 4 0": "cc-by",
    "licensed under cc by sa": "cc-by-sa",
    "licensed under cc by nc": "cc-by-nc",
    "creative commons attribution": "cc-by",
    "cc0 1 0 universal": "cc0",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "boost software license": "boost",
    "this software is provided as is without any express or implied warranty in no event will the authors": "zlib",
    "nor the names of its contributors may be used to endorse or promote products": "bsd",
}

# The words of SPDX identifiers, their labels and versions.
SPDX = {
    "mit": ("mit", None), "isc": ("isc", None), "zlib": ("zlib", None), "unlicense": ("unlicense", None),
    "apache 2 0": ("apache", "2.0"), "bsl 1 0": ("boost", "1.0"), "mpl 1 1": ("mpl", "1.1"), "mpl 2 0": ("mpl", "2.0"),
    "epl 1 0": ("epl", "1.0"), "epl 2 0": ("epl", "2.0"), "cc0 1 0": ("cc0", "1.0"),
    "bsd 2 clause": ("bsd", "2-clause"), "bsd 3 clause": ("bsd", "3-clause"),
    "gpl 2 0": ("gpl", "2.0"), "gpl 3 0": ("gpl", "3.0"), "lgpl 2 0": ("lgpl", "2.0"), "lgpl 2 1": ("lgpl", "2.1"),
    "lgpl 3 0": ("lgpl", "3.0"), "agpl 3 0": ("agpl", "3.0"),
    "cc by 3 0": ("cc-by", "3.0"), "cc by 4 0": ("cc-by", "4.0"), "cc by sa 3 0": ("cc-by-sa", "3.0"),
    "cc by sa 4 0": ("cc-by-sa", "4.0"), "cc by nc 4 0": ("cc-by-nc", "4.0"),
}
# How the versions of a family of notices are written.
VERSIONS = {
    "apache license": ("apache", ["1.1", "2.0"]), "gnu general public license": ("gpl", ["2", "2.0", "3", "3.0"]),
    "gnu lesser general public license": ("lgpl", ["2.1", "3", "3.0"]),
    "gnu affero general public license": ("agpl", ["3", "3.0"]), "mozilla public license": ("mpl", ["1.1", "2.0"]),
    "eclipse public license": ("epl", ["1.0", "2.0"]), "boost software license": ("boost", ["1.0"]),
    "creative commons attribution": ("cc-by", ["3.0", "4.0"]),
}
AS_PUBLISHED = "as published by the free software foundation either version"


def default_tails() -> list[tuple[str, str, str, str | None]]:
    """(notice, tail, label, version) of the fixed values above; an empty tail
    is the notice by itself.  A notice that is only here needs one of its tails."""
    rows = [("spdx license identifier", words, label, v) for words, (label, v) in SPDX.items()]
    for family, (label, versions) in VERSIONS.items():
        for v in versions:
            words, whole = v.replace(".", " "), v if "." in v else v + ".0"
            forms = ["version " + words, "v" + words, "v " + words, words]
            if family.startswith("gnu"):
                forms.append(f"{AS_PUBLISHED} {words}")
            rows += [(family, form, label, whole) for form in forms]
    for short in ("gpl", "lgpl", "agpl"):
        rows += [(f"{short}v{v}", "", short, f"{v}.0") for v in (2, 3) if (short, v) != ("agpl", 2)]
    return rows + [("redistribution and use in source and binary forms", "", "bsd", "2-clause"),
                   ("nor the names of its contributors may be used to endorse or promote products", "", "bsd", "3-clause")]


# An opening whose version is the second one if that follows.
COMPLETED = {("bsd", "2-clause"): "3-clause"}

SPAN_TYPE = "array<struct<label:string,first_word:bigint,end_word:bigint,edits:int,score:double,version:string>>"


def pieces(notice: str, edits: int) -> list[tuple[int, bytes]]:
    """(offset, piece): ``edits + 1`` pieces of nearly equal length, in bytes."""
    data = notice.encode()
    cut = [len(data) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, data[a:b]) for a, b in zip(cut, cut[1:])]


def _in_words(text: str) -> str:
    return b" ".join(utf8(text).translate(WORD_BYTES).split()).decode()


class Scanner:
    """Compiled phrases and notices; one per task.  ``notices`` are labels by
    text, ``tails`` rows like those of ``default_tails``."""

    def __init__(self, base: dict, notices: dict, max_error: float, tails=None):
        self.base = [(b" " + p.encode() + b" ", label) for p, label in base.items()]
        known: dict[str, dict] = {n: {b"": (label, None)} for n, label in notices.items()}
        for notice, tail, label, version in default_tails() if tails is None else tails:
            known.setdefault(notice, {})[(" " + tail if tail else "").encode()] = (label, version)
        self.fuzzy, seeds = [], {}
        for i, (notice, ends) in enumerate(known.items()):
            size = len(notice.encode())
            edits = int(size * max_error)
            border = rb"(?e)(?<= )(?:%s){e<=%d}(?= )" % (regex.escape(notice.encode(), special_only=True), edits)
            self.fuzzy.append((size, edits, regex.compile(border),
                               sorted(((t + b" ", *x) for t, x in ends.items()), key=lambda t: -len(t[0]))))
            for offset, seed in pieces(notice, edits):
                seeds.setdefault(seed.decode("latin-1"), []).append((i, offset + len(seed) - 1))
        self.seeds = ahocorasick.Automaton()
        for seed, places in seeds.items():
            self.seeds.add_word(seed, places)
        if seeds:
            self.seeds.make_automaton()

    def scan(self, text: str | None):
        """(words, base places [(word, label)], spans [(label, first, end, edits, score, version)])."""
        words = utf8(text).translate(WORD_BYTES).split()
        line, count = b" " + b" ".join(words) + b" ", len(words)
        del words
        exact, near = [], []     # (start, end, label, edits, length, version) in bytes of ``line``
        for phrase, label in self.base:
            at = line.find(phrase)
            while at >= 0:
                exact.append((at + 1, at + len(phrase) - 1, label, 0, len(phrase) - 2, None))
                at = line.find(phrase, at + 1)
        for i, windows in self._windows(line).items():
            size, edits, pattern, tails = self.fuzzy[i]
            for lo, hi in windows:
                for m in pattern.finditer(line, lo, hi):
                    tail = next((t for t in tails if line.startswith(t[0], m.end())), None)
                    if tail and m.end() > m.start():
                        near.append((m.start(), m.end() + len(tail[0]) - 1, tail[1], sum(m.fuzzy_counts), size, tail[2]))
        word = _word_numbers(line, {x for s in exact + near for x in s[:2]})
        exact, near = ([(label, word[a], word[b] + 1, e, 1.0 - e / n, v)
                        for a, b, label, e, n, v in found] for found in (exact, near))
        return count, sorted((s[1], s[0]) for s in exact), _versions(_best(exact, near))

    def _windows(self, line: bytes) -> dict:
        """Per notice the stretches around its exact pieces that can hold a
        match, united where they touch."""
        found: dict[int, list] = {}
        if not len(self.seeds):
            return found
        for end, places in self.seeds.iter(line.decode("latin-1")):
            for i, back in places:
                size, edits = self.fuzzy[i][:2]
                lo, hi = max(0, end - back - edits - 1), min(len(line), end - back + size + edits + 1)
                united = found.setdefault(i, [])
                while united and lo <= united[-1][1] and hi >= united[-1][0]:
                    last = united.pop()
                    lo, hi = min(lo, last[0]), max(hi, last[1])
                united.append((lo, hi))
        return found


def _versions(spans: list) -> list:
    """Openings that a later span of their label completes get its version."""
    out, ahead = [], {}
    for s in reversed(spans):
        version = s[5]
        if (s[0], version) in COMPLETED:
            if ahead.get(s[0]) == COMPLETED[s[0], version]:
                version = ahead[s[0]]
            ahead[s[0]] = None
        elif version:
            ahead[s[0]] = version
        out.append((*s[:5], version))
    return out[::-1]


def _word_numbers(line: bytes, offsets: set) -> dict:
    """Number of the word at (or ending at) each offset, in one pass over the line."""
    numbers, at, n = {}, 0, -1
    for x in sorted(offsets):
        n += line.count(b" ", at, x)
        numbers[x], at = n, x
    return numbers


def _best(exact: list, near: list) -> list:
    """Exact spans, and of the others those that no better one of the others
    with the same label overlaps (fewer edits, then longer; without a version
    of its own it takes the other's); in text order."""
    kept: dict[str, list] = {}
    for s in sorted(near, key=lambda s: (s[1], s[3], -s[2])):
        own = kept.setdefault(s[0], [])
        if not own or s[1] >= own[-1][2]:
            own.append(s)
        else:
            a, b = own[-1], s
            if (b[3], b[1] - b[2]) < (a[3], a[1] - a[2]):
                a, b = b, a
            own[-1] = (*a[:5], a[5] or b[5])
    return sorted({s for own in kept.values() for s in own} | set(exact),
                  key=lambda s: (s[1], s[2], s[0], s[3], s[5] or ""))


def notice_rows(notices: DataFrame, max_notices: int) -> list:
    """A notice table (text, label, and if there: version, tail) as rows like
    those of ``default_tails``; texts and tails are reduced to their words."""
    cols = [F.col(c) if c in notices.columns else F.lit(None).cast("string") for c in ("text", "tail", "label", "version")]
    rows = notices.select(*cols).distinct().limit(max_notices + 1).collect()
    if len(rows) > max_notices:
        raise ValueError(f"more than max_notices = {max_notices} notices")
    rows = sorted((_in_words(t), _in_words(tail), label, v or None) for t, tail, label, v in rows if label)
    return [r for r in rows if r[0]]


def scan_licenses(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  base: dict | None = None, notices: dict | DataFrame | None = None,
                  max_error: float = 0.08, max_notices: int = 10_000) -> DataFrame:
    """Per document row: doc_id, n_words, base_places (word, label) and spans.
    ``notices`` replaces the built-in ones: labels by text, or a table with the
    columns text and label and, if wanted, version and tail."""
    base, tails = dict(base or BASE_PHRASES), None
    if isinstance(notices, DataFrame):
        notices, tails = {}, notice_rows(notices, max_notices)
    elif notices is not None:
        tails = []
    notices = dict(NOTICES if notices is None else notices)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        scanner = Scanner(base, notices, max_error, tails)
        for b in batches:
            got = [scanner.scan(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([g[0] for g in got], pa.int64()),
                 pa.array([[{"word": w, "label": x} for w, x in sorted(g[1])] for g in got],
                          pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))),
                 pa.array([[dict(zip(("label", "first_word", "end_word", "edits", "score", "version"), s))
                            for s in g[2]] for g in got],
                          pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()),
                                              ("end_word", pa.int64()), ("edits", pa.int32()),
                                              ("score", pa.float64()), ("version", pa.string())])))],
                ["doc_id", "n_words", "base_places", "spans"])

    return rows.mapInArrow(run, f"doc_id {id_type}, n_words long, "
                                f"base_places array<struct<word:bigint,label:string>>, spans {SPAN_TYPE}")

"""Bounded-space online packing of tokenized documents.

Each task keeps ``open_windows`` windows of ``capacity`` tokens open.  A
document's ids, the end id last, are placed in order: whole windows first,
then the rest goes best-fit into the open window that it leaves least room
in.  When it fits into none, the fullest window takes as much of it as it
holds and is emitted, full; the remainder is placed again.  So only windows
that are still open when a task ends have room.  These leftovers are merged:
tasks are grouped, a group's leftovers (at most one partly filled window's
worth for each task after merging within the task) are packed the same way,
and what remains in a group is cut at the powers of two of its length, which
need no padding.

Nothing is lost or repeated: every id lies in exactly one piece.  The first
pass is written to the shared checkpoint folder, because its rows are used
twice; a lost executor does not repack windows that others already hold.

Tokenizing: between a space before a non-space and the text around it no
token of a byte-level BPE ever stretches, so a text is cut there, and the ids
of a cut word are remembered per Python worker (``cache_words`` at most; they
are the first met, hence the common ones).  Words that are not remembered are
encoded together.  Texts with runs of white space take the same cut by
regular expression.

Defined results: null and empty texts are the end id alone; documents with
a null id are packed with a null id; repeated rows are packed repeatedly; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import SECTION, reliable, slices_of, worker_cache

_CUT = re.compile(r"(?= \S)")
# White space beside the space and the line feed.
_OTHER_SPACE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
_MARKS = ".,;:!?"
_RUNS = ("  ", " \n", "\n ", "\n\n")
PIECES = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
           "sequence_id long, offset long, ids binary")
_ARROW = pa.schema([(c, pa.int64()) for c in PIECES] + [("ids", pa.binary())])


class Encoder:
    """ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, tokenizer_json: str, cache_words: int):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_str(tokenizer_json)
        self.limit = cache_words
        self.newline = self._whole("\n")
        self.marks = {c: self._whole(c) for c in _MARKS}
        # ids by word after a space; a word that begins with a line feed has
        # no space before it, and first words of texts are kept that way too
        self.words: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, words: set) -> tuple[dict, list]:
        """Ids of new words: (those to keep, those of this slice only).  One
        punctuation mark after a letter or digit is a piece of its own, so such
        a word is the one without it and the mark, and is not kept."""
        marked = [w for w in words if w[-1] in _MARKS and len(w) > 1 and w[-2].isalnum()]
        plain = words.difference(marked)
        plain.update(w[:-1] for w in marked if w[:-1] not in self.words)
        found: dict = {}
        self._encode_words(sorted(plain), found)
        return found, marked

    def _encode_words(self, words: list, into: dict) -> None:
        """Encode words together, one to a line: a line feed between
        non-spaces is always a token of its own."""
        for head, own in (("", [w[1:] for w in words if w[0] == "\n"]),
                          (" ", [w for w in words if w[0] != "\n"])):
            for at in range(0, len(own), 4096):
                part = own[at:at + 4096]
                ids = np.array(self.tok.encode_batch_fast([head + f"\n{head}".join(part)],
                                                          add_special_tokens=False)[0].ids, "<u4")
                cuts = np.flatnonzero(ids == np.frombuffer(self.newline, "<u4")[0])
                if len(self.newline) != 4 or len(cuts) != len(part) - 1 or any("<|" in w for w in part):
                    for w in part:
                        into[w if head else "\n" + w] = self._whole(" " + w if head else "\n" + w)
                    continue
                data, lo = ids.tobytes(), 0
                for w, hi in zip(part, [*cuts.tolist(), len(ids)]):
                    into[w if head else "\n" + w] = (b"" if head else self.newline) + data[4 * lo:4 * hi]
                    lo = hi + 1

    @staticmethod
    def _cut(text: str) -> list | None:
        """Words of a text without runs of white space, None for others."""
        if text[:1] in " \n" or text[-1] in " \n" or any(r in text for r in _RUNS) \
                or any(c in text for c in _OTHER_SPACE):
            return None
        return f"\n{text}".replace("\n", " \n").split(" ")[1:]

    def encode(self, texts: list) -> list[bytes]:
        part = [t or "" for t in texts]
        cut = [self._cut(t) if t else None for t in part]
        new: set = set()
        for words in cut:
            new.update(words or ())
        new.difference_update(self.words)
        found, marked = self._learn(new)
        keep = len(self.words) + len(found) <= self.limit
        known = self.words
        known.update(found)
        for w in marked:
            known[w] = known[w[:-1]] + self.marks[w[-1]]
        get, skip, out = known.__getitem__, len(self.newline), []
        for t, words in zip(part, cut):
            if words is None:
                out.append(b"".join(map(self._whole, _CUT.split(t))))
            else:       # without the line feed put before the first word
                out.append(b"".join(map(get, words))[skip:])
        for w in marked if keep else [*marked, *found]:
            known.pop(w, None)
        return out


def _encoder(tokenizer_json: str, cache_words: int) -> Encoder:
    """The Python worker's encoder; workers outlive tasks, and their words with them."""
    key = (zlib.crc32(tokenizer_json.encode()), len(tokenizer_json), cache_words)
    return worker_cache(key, lambda: Encoder(tokenizer_json, cache_words))


class Packer:
    """Open windows; a window is a list of pieces (doc, start, doc tokens, ids)."""

    def __init__(self, capacity: int, open_windows: int):
        self.capacity, self.most = capacity, open_windows
        self.open: list[list] = []          # [room, pieces]
        self.done: list[list] = []          # emitted, full

    def place(self, doc, start: int, total: int, ids: bytes) -> None:
        at = 0                              # ``ids`` is not copied: it may be very long
        while at < len(ids):
            n = (len(ids) - at) // 4
            if n >= self.capacity:
                cut = at + 4 * self.capacity
                self.done.append([(doc, start, total, ids[at:cut])])
                start, at = start + self.capacity, cut
                continue
            fits = [w for w in self.open if w[0] >= n]
            if fits:
                best = min(fits, key=lambda w: w[0])
            elif len(self.open) < self.most:
                best = [self.capacity, []]
                self.open.append(best)
            else:
                best = min(self.open, key=lambda w: w[0])       # the fullest
                n = best[0]
            best[1].append((doc, start, total, ids[at:at + 4 * n]))
            best[0] -= n
            start, at = start + n, at + 4 * n
            if not best[0]:
                self.open.remove(best)
                self.done.append(best[1])

    def merge_open(self) -> list:
        """Put the open windows together: all but one get full; the pieces of the last."""
        pieces = [p for w in sorted(self.open, key=lambda w: w[0]) for p in w[1]]
        last, self.open, self.most = pieces, [], 1
        for p in last:
            self.place(*p)
        return self.open[0][1] if self.open else []

    def cut_open(self) -> None:
        """Emit the remaining window as sequences of powers of two."""
        for w in self.open:
            left = self.capacity - w[0]
            for doc, start, total, ids in _at_powers(w[1], left):
                if not self.done or doc is _NEW:
                    self.done.append([])
                if doc is not _NEW:
                    self.done[-1].append((doc, start, total, ids))
        self.open = []


_NEW = object()
# Windows that a task gathers before it gives them out.
_FLUSH = 512


def task_sequence(task: int) -> int:
    """The first sequence id of a task: 2^32 ids each, from 2^32 on."""
    return (task + 1) << 32


def group_sequence(group: int) -> int:
    """The first sequence id of a group of tasks' leftovers: 2^20 ids each,
    all below 0, so that they never meet those of a task."""
    return -((group + 1) << 20)


def _at_powers(pieces: list, left: int):
    size, room = 0, 0
    for doc, start, total, ids in pieces:
        while ids:
            if not room:
                size = 1 << (left.bit_length() - 1)
                room, left = size, left - size
                yield _NEW, 0, 0, b""
            n = min(room, len(ids) // 4)
            yield doc, start, total, ids[:4 * n]
            start, ids, room = start + n, ids[4 * n:], room - n


def _batch(windows: list, first_sequence: int, with_ids: bool) -> pa.RecordBatch:
    rows = [[] for _ in _ARROW]
    for s, pieces in enumerate(windows):
        offset = 0
        for doc, start, total, ids in pieces:
            n = len(ids) // 4
            for col, v in zip(rows, (doc, start, n, zlib.crc32(ids), total,
                                     None if first_sequence is None else first_sequence + s, offset,
                                     ids if with_ids else None)):
                col.append(v)
            offset += n
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, _ARROW)], schema=_ARROW)


def pack(docs: DataFrame, tokenizer_json: str, *, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = 2048, open_windows: int = 16, end_id: int = 1, with_ids: bool = True,
         cache_words: int = 600_000, tasks_per_group: int = 64) -> DataFrame:
    """One row per piece: doc_id, start (ids of its document before it),
    length, ids_crc32, doc_tokens, sequence_id, offset (in its sequence) and,
    ``with_ids``, the ids.  ``tokenizer_json`` is the text of a byte-level BPE
    tokenizer file."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    end, step = np.array([end_id], "<u4").tobytes(), 4 * capacity * _FLUSH

    def fill(batches):
        from pyspark import TaskContext
        encoder, packer = _encoder(tokenizer_json, cache_words), Packer(capacity, open_windows)
        sequence = task_sequence(TaskContext.get().partitionId())
        for b in batches:
            docs = b.column("doc_id").to_pylist()
            for lo, hi in slices_of(b.column("text"), SECTION * 4):
                for doc, ids in zip(docs[lo:hi], encoder.encode(b.column("text")[lo:hi].to_pylist())):
                    ids += end
                    for at in range(0, len(ids), step):         # whole windows of a long document first
                        packer.place(doc, at // 4, len(ids) // 4, ids[at:at + step] if len(ids) > step else ids)
                        if len(packer.done) >= _FLUSH:
                            yield _batch(packer.done, sequence, with_ids)
                            sequence, packer.done = sequence + len(packer.done), []
        left = packer.merge_open()
        yield _batch(packer.done, sequence, with_ids)
        yield _batch([left], None, True)

    first = reliable(rows.mapInArrow(fill, _SCHEMA).withColumn("task", F.spark_partition_id()))
    group = (F.col("task") / tasks_per_group).cast("long")
    order = ["task", "offset"]

    def merge(key, table):
        table = table.sort_by([(c, "ascending") for c in order])
        packer = Packer(capacity, 1)
        for r in table.select(["doc_id", "start", "doc_tokens", "ids"]).to_pylist():
            packer.place(r["doc_id"], r["start"], r["doc_tokens"], r["ids"])
        full, packer.done = packer.done, []
        packer.cut_open()
        return pa.Table.from_batches([_batch(full + packer.done, group_sequence(key[0].as_py()), with_ids)])

    rest = first.filter("sequence_id is null").withColumn("group", group)
    merged = rest.groupBy("group").applyInArrow(merge, _SCHEMA)
    out = first.filter("sequence_id is not null").drop("task").unionByName(merged)
    return out if with_ids else out.drop("ids")

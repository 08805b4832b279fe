"""Operator 9, harmonic packing of token sequences.

A document's ids are cut into lengths near C/k (C: the capacity; k = 1, 2,
... the reciprocal-capacity classes): full pieces of C first, then for the
rest the class k it fits k times; when it fills less than ``fill`` of that
class's slot C//k it is cut again at the slot of class k+1 and the remainder
goes on the same way. Each class fills its bins with exactly k pieces,
independently in every Spark task, so packing needs no shuffle and no state
beyond one open bin for a class: fewer than ``classes``**2 / 2 pieces. Pieces
under C/classes share bins by next fit. What the open bins still hold at a
task's end is packed together, first fit by decreasing length.
"""

from __future__ import annotations

import zlib
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Sequence ids of one task start at its partition number times this.
TASK_STRIDE = 1 << 33
EMIT_ROWS = 20_000


def cut_rest(rest: int, capacity: int, classes: int, fill: float) -> tuple[tuple[int, int], ...]:
    """(length, class) of the pieces of a rest under ``capacity``; class 0 is the class of small pieces."""
    out = []
    while rest:
        k = capacity // rest
        if k > classes:
            out.append((rest, 0))
            break
        slot = capacity // k
        if rest >= fill * slot or k == classes:
            out.append((rest, k))
            break
        piece = capacity // (k + 1)
        out.append((piece, k + 1))
        rest -= piece
    return tuple(out)


def cuts(n: int, capacity: int, classes: int, fill: float) -> list[tuple[int, int]]:
    return [(capacity, 1)] * (n // capacity) + list(cut_rest(n % capacity, capacity, classes, fill))


class HarmonicPacker:
    """Bins of one task and group, numbered from ``ids``. ``add`` and ``close`` yield (sequence, offset, piece)."""

    def __init__(self, capacity: int, classes: int, ids):
        self.capacity, self.classes, self.ids = capacity, classes, ids
        self.open = {}
        self.small, self.small_len = [], 0

    def _bin(self, pieces):
        offset, number = 0, next(self.ids)
        for p in pieces:
            yield number, offset, p
            offset += p[1]

    def add(self, piece, length, k):
        if k == 0:
            if self.small_len + length > self.capacity:
                yield from self._bin(self.small)
                self.small, self.small_len = [], 0
            self.small.append(piece)
            self.small_len += length
            return
        held = self.open.setdefault(k, [])
        held.append(piece)
        if len(held) == k:
            yield from self._bin(held)
            self.open[k] = []

    def close(self):
        left = sorted((p for held in [*self.open.values(), self.small] for p in held),
                      key=lambda p: -p[1])
        bins = []  # [room, pieces]; at most one bin of pieces for each class is left
        for p in left:
            for b in bins:
                if b[0] >= p[1]:
                    b[0] -= p[1]
                    b[1].append(p)
                    break
            else:
                bins.append([self.capacity - p[1], [p]])
        for _, pieces in bins:
            yield from self._bin(pieces)
        self.open, self.small = {}, []


def load_encoder(path: str):
    """A function text -> ids for a byte-level BPE file of the ``tokenizers``
    library. Its merges are given to tiktoken (the same ids, five times as
    fast); a text tiktoken refuses goes to ``tokenizers`` itself. As in that library, the
    file's special tokens inside a text are their ids, and what is between them is encoded by itself."""
    import json
    import re

    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    tok = Tokenizer.from_file(path)
    # the byte-level alphabet: printable Latin-1 stands for itself, the rest for U+0100 onward
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    byte_of = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}
    special = {i: t.content for i, t in tok.get_added_tokens_decoder().items()}
    ranks = {bytes(byte_of[c] for c in s): i for s, i in vocab.items() if i not in special}
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    fast = tiktoken.Encoding("byte-bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    id_of = {t: i for i, t in special.items()}
    marks = re.compile("(" + "|".join(re.escape(t) for t in sorted(id_of, key=len, reverse=True)) + ")") if id_of else None

    def encode(text: str) -> list[int]:
        try:
            if marks is None or not marks.search(text):
                return fast.encode_ordinary(text)
            return [i for part in marks.split(text) for i in ([id_of[part]] if part in id_of else fast.encode_ordinary(part))]
        except BaseException as e:  # the Rust side panics on runs beyond its backtracking limit
            if isinstance(e, (KeyboardInterrupt, SystemExit)):
                raise
            return tok.encode(text, add_special_tokens=False).ids

    return encode


SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, class int")


def pack(docs: DataFrame, tokenizer_path: str, *, capacity: int = 2048, end_id: int = 1, classes: int = 64,
         fill: float = 0.97, id_col: str = "doc_id", text_col: str = "text", group_col: str | None = None) -> DataFrame:
    """Pieces of all documents placed in sequences of at most ``capacity`` ids.

    One row per piece: doc_id, start, length, ids_crc32 (unsigned, of the
    piece's ids as little-endian unsigned 32-bit), doc_tokens, sequence_id,
    offset, class. A null or empty text is the lone end id; a null doc_id
    stays null; repeated rows are packed each for itself; an empty table
    gives an empty result. With ``group_col`` a sequence holds documents of one of its values
    (null is one) only: each task keeps open bins for each value it meets. Other columns are not read, whatever their names.
    """
    def run(batches):
        encode = load_encoder(tokenizer_path)
        ids_of, packers = count(TaskContext.get().partitionId() * TASK_STRIDE), {}
        rows, known = [], {}

        def batch():
            cols = list(zip(*rows, strict=True))
            rows.clear()
            kinds = [pa.int64()] * 7 + [pa.int32()]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "class"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names)

        def place(placed):
            for seq, offset, (doc, length, start, crc, total, k) in placed:
                rows.append((doc, start, length, crc, total, seq, offset, k))

        for b in batches:
            for doc, text, group in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), strict=True):
                packer = packers.get(group)
                if packer is None:
                    packer = packers[group] = HarmonicPacker(capacity, classes, ids_of)
                ids = encode(text.as_py() or "")
                ids.append(end_id)
                raw = memoryview(np.asarray(ids, dtype="<u4").tobytes())
                total, start = len(ids), 0
                plan = known.get(total)
                if plan is None:
                    plan = known[total] = cuts(total, capacity, classes, fill)
                for length, k in plan:
                    crc = zlib.crc32(raw[4 * start: 4 * (start + length)])
                    place(packer.add((doc, length, start, crc, total, k), length, k))
                    start += length
                if len(rows) >= EMIT_ROWS:
                    yield batch()
        for packer in packers.values():
            place(packer.close())
        if rows:
            yield batch()

    group = F.col(f"`{group_col}`").cast("string") if group_col else F.lit(None).cast("string")
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), group.alias("group"))
    return narrow.mapInArrow(run, SCHEMA)

"""Operator 1: vector bin packing of token sequences by the dot-product heuristic.

A sequence has room for tokens, segments and loss-bearing tokens at once. Each task packs
its own documents in one pass with a bounded window of open pieces: an open sequence takes
the piece whose need, as a vector, has the largest dot product with the room left. When
nothing fits whole, a piece is cut to fill the room exactly, as training on packed text allows.
What is left at the end of a partition goes into sequences of powers of two, which need no padding.
No shuffle: a sequence never spans partitions.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from clickledger.llm.common import give_back
from clickledger.llm.tokens import library

#: Whole documents' tails that a task holds open at a time.
WINDOW = 512


@dataclass(frozen=True)
class Limits:
    tokens: int = 1024
    segments: int = 64
    loss: int = 1024


class Encoder:
    """Token ids as the `tokenizers` library gives them for `path`, special strings in texts included.

    `ranks`: the same vocabulary as a rank file. Its faster merger gives the same ids (tests compare them over a part of all code
    points); texts that it refuses go to the library, and are counted.
    """

    def __init__(self, path: str, ranks: str | None):
        self.lib = library(path)
        self.fast, self.refused = None, 0
        if ranks:
            import base64

            import tiktoken

            from clickledger.llm.tokens import PATTERN

            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            special = {t.content: i for i, t in self.lib.get_added_tokens_decoder().items()}
            self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens=special)

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is not None:
            try:
                return np.asarray(self.fast.encode_to_numpy(text, allowed_special="all"), dtype="<u4")
            except BaseException as e:  # a panic of the native code is no Exception; all else is a fault
                if type(e).__name__ != "PanicException" and not isinstance(e, ValueError):
                    raise
                self.refused += 1
        return np.array(self.lib.encode(text, add_special_tokens=False).ids, dtype="<u4")


class Packer:
    """Packs documents as they come; done pieces are rows (doc index, start, length, crc, sequence, offset, loss)."""

    def __init__(self, limits: Limits, first_sequence: int):
        self.limits = limits
        self.next = first_sequence
        self.docs: dict[int, tuple[np.ndarray, np.ndarray | None]] = {}
        self.open: list[list[int]] = []  # doc, start, end
        self.rows: list[tuple[int, int, int, int, int, int, int]] = []
        self.tokens = 0

    def _loss(self, doc: int, a: int, b: int) -> int:
        """Loss-bearing tokens of a piece: the flagged ones, or all but the first of a document, which nothing predicts."""
        flags = self.docs[doc][1]
        return b - a - (a == 0) if flags is None else int(flags[a:b].sum())

    def _emit(self, pieces: list[tuple[int, int, int]]) -> None:
        at = 0
        for doc, a, b in pieces:
            ids = self.docs[doc][0][a:b]
            self.rows.append((doc, a, b - a, zlib.crc32(ids.tobytes()), self.next, at, self._loss(doc, a, b)))
            at += b - a
        self.next += 1

    def add(self, doc: int, ids: np.ndarray, flags: np.ndarray | None = None) -> None:
        self.docs[doc] = (ids, flags)
        a, n, cap = 0, len(ids), self.limits.tokens
        while n - a >= cap:  # full sequences of one document
            b = self._fit(doc, a, a + cap, self.limits.loss)
            self._emit([(doc, a, b)])
            a = b
        if a < n:
            self.open.append([doc, a, n])
            self.tokens += n - a
        else:
            del self.docs[doc]
        if len(self.open) >= WINDOW:
            while len(self.open) > WINDOW // 2 and self.tokens >= 4 * cap:
                self._sequence(cap)

    def _fit(self, doc: int, a: int, b: int, loss: int) -> int:
        """The largest end up to b with at most `loss` loss-bearing tokens, but at least one token."""
        if self._loss(doc, a, b) <= loss:
            return b
        flags = self.docs[doc][1]
        if flags is None:
            return max(a + 1, min(b, a + loss + (a == 0)))
        return max(a + 1, a + int(np.searchsorted(np.cumsum(flags[a:b]), loss, side="right")))

    def _sequence(self, size: int) -> None:
        """One sequence of at most `size` tokens from the open pieces."""
        room = np.array([size, self.limits.segments, self.limits.loss], np.int64)
        scale = 1.0 / np.array([self.limits.tokens, self.limits.segments, max(1, self.limits.loss)])
        need = np.array([(b - a, 1, self._loss(doc, a, b)) for doc, a, b in self.open], np.int64)
        free = np.ones(len(need), bool)
        pieces: list[tuple[int, int, int]] = []
        cut: list[list[int]] = []
        while room[0] > 0 and room[1] > 0 and free.any():
            fits = free & (need <= room).all(axis=1)
            if room[1] == 1:  # the last segment should fill the sequence
                fits &= need[:, 0] == room[0]
            if fits.any():
                score = np.where(fits, (need * scale) @ (room * scale), -1.0)
                i = int(score.argmax())
                doc, a, b = self.open[i]
            else:
                rest = np.where(free, need[:, 0], -1)
                i = int(rest.argmax())
                doc, a, end = self.open[i]
                b = self._fit(doc, a, min(end, a + int(room[0])), int(room[2]))
                if self._loss(doc, a, b) > room[2]:
                    break
                if b < end:
                    cut.append([doc, b, end])
            free[i] = False
            pieces.append((doc, a, b))
            room -= (b - a, 1, self._loss(doc, a, b))
        left = [x for x, f in zip(self.open, free, strict=True) if f] + cut
        self._emit(pieces)
        self.tokens -= sum(b - a for _, a, b in pieces)
        going = {doc for doc, _, _ in pieces} - {x[0] for x in left}
        self.open = left
        for doc in going:
            del self.docs[doc]

    def finish(self) -> None:
        cap = self.limits.tokens
        while self.tokens:
            self._sequence(cap if self.tokens >= cap else 1 << (self.tokens.bit_length() - 1))

    def taken(self) -> list[tuple[int, int, int, int, int, int, int]]:
        rows, self.rows = self.rows, []
        return rows


_NAMES = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "n_loss")


def pack(df: DataFrame, path: str, ranks: str | None = None, key: str = "doc_id", text: str = "text", loss_from: str | None = None, end_id: int = 0, limits: Limits = Limits()) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset, n_loss.

    A document is the ids of its text (null: empty) and end_id. loss_from: a column with the character from which
    on tokens bear loss (instruction data: where the answer starts; null: all bear loss). Rows that repeat
    a key are documents of their own; an empty text is one piece of one id; an empty
    table gives no rows; other columns are not read. Sequences exceed none of the limits; sequence
    ids are the partition's number and a count in it, the same on every run over the same partitions.
    """
    kind = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, " + ", ".join(f"{n} bigint" for n in _NAMES)
    cols = [df[key], df[text]] + ([df[loss_from].cast("bigint")] if loss_from else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(path, ranks)
        packer = Packer(limits, TaskContext.get().partitionId() << 32)
        facts: dict[int, tuple[object, int, int]] = {}  # number -> key, tokens, tokens still to come
        count = 0

        def out() -> pa.RecordBatch:
            rows = packer.taken()
            keys, cells = [], []
            for doc, start, length, crc, seq, offset, loss in rows:
                k, total, rest = facts[doc]
                keys.append(k)
                cells.append((start, length, crc, total, seq, offset, loss))
                facts[doc] = (k, total, rest - length)
                if rest == length:
                    del facts[doc]
            flat = np.array(cells, np.int64).reshape(-1, len(_NAMES))
            return pa.RecordBatch.from_arrays([pa.array(keys, key_type), *(pa.array(flat[:, i]) for i in range(len(_NAMES)))], names=[key, *_NAMES])

        key_type = pa.int64()
        for b in batches:
            key_type = b.schema.field(0).type
            keys = b.column(0).to_pylist()
            starts = b.column(2).to_pylist() if loss_from else None
            for i, t in enumerate(b.column(1)):
                t = t.as_py() or ""
                ids = np.append(encode(t), np.uint32(end_id)).astype("<u4")
                flags = None
                if starts is not None and starts[i] is not None:
                    flags = np.arange(len(ids)) >= len(encode(t[: max(0, starts[i])]))
                facts[count] = (keys[i], len(ids), len(ids))
                packer.add(count, ids, flags)
                count += 1
                if len(packer.rows) >= 8192:
                    yield out()
            give_back()
        packer.finish()
        if packer.rows:
            yield out()

    return df.select(cols).mapInArrow(run, schema)

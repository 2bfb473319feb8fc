"""Tokenizers by file, and operator 3: token counts by whole-token shortcut.

The vocabulary strings that the byte-level merges bring back to one token are proved once, on
the driver, by encoding every string of the vocabulary. A text is cut into pre-tokens; a
pre-token among the proved strings counts one, and only the rest is merged, each
different string once per task and cache generation.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: The byte-level pre-tokenizer's public pattern.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Strings that a task remembers merged counts of, before it starts anew.
CACHE = 200_000


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def library(path: str):
    """The tokenizer of a .json file, on one thread."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def byte_level_bpe(path: str) -> bool:
    """Whether the file is a plain byte-level BPE, so that pre-tokens are merged on their own."""
    with open(path, encoding="utf-8") as f:
        j = json.load(f)
    pre, model = j.get("pre_tokenizer") or {}, j["model"]
    return (
        pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and j.get("normalizer") is None and j.get("post_processor") is None
        and model["type"] == "BPE" and not model.get("dropout") and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in j["added_tokens"])
    )


@lru_cache(maxsize=4)
def _bytes_of() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=4)
def prove_whole(path: str) -> frozenset[str]:
    """The vocabulary's texts that encode alone as one token and are one pre-token."""
    tok, to_byte = library(path), _bytes_of()
    special = set(tok.get_added_tokens_decoder())
    texts = []
    for s, i in tok.get_vocab(with_added_tokens=True).items():
        if i not in special and all(c in to_byte for c in s):
            try:
                texts.append(bytes(to_byte[c] for c in s).decode("utf-8"))
            except UnicodeDecodeError:
                continue
    cut = regex.compile(PATTERN)
    found = tok.encode_batch(texts, add_special_tokens=False)
    return frozenset(t for t, e in zip(texts, found, strict=True) if len(e.ids) == 1 and cut.findall(t) == [t])


class TokenCounter:
    """Counts tokens as the library does, for the tokenizer file at `path`."""

    def __init__(self, path: str, whole: frozenset[str] | None = None):
        self.path = path
        self.piece = path.endswith(".model")
        if self.piece:
            import sentencepiece

            self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
            self.fast = False
            return
        self.lib = library(path)
        self.fast = byte_level_bpe(path)
        if self.fast:
            self.whole = whole if whole is not None else prove_whole(path)
            self.cut = regex.compile(PATTERN)
            self.special = [t.content for t in self.lib.get_added_tokens_decoder().values()]
            self.split_special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
            self.known: dict[str, int] = {}
            self.chars: dict[str, bool] = {}

    def _same_class(self, c: str) -> bool:
        """Whether the library cuts around this character as PATTERN does here (their Unicode versions may differ)."""
        s = f"a{c}a1{c}1!{c}! {c} {c}{c}a"
        return [(m.start(), m.end()) for m in self.cut.finditer(s)] == [at for _, at in self.lib.pre_tokenizer.pre_tokenize_str(s)]

    def _plain(self, text: str) -> bool:
        if text.isascii():
            return True
        for c in set(text).difference(self.chars):
            self.chars[c] = self._same_class(c)
        return all(map(self.chars.__getitem__, set(text)))

    def counts(self, texts: list[str]) -> list[int]:
        if self.piece:
            return [len(x) for x in self.lib.encode(texts, num_threads=1)]
        if not self.fast:
            return [len(e.ids) for e in self.lib.encode_batch(texts, add_special_tokens=False)]
        out, cuts, slow = [0] * len(texts), [], []
        for i, t in enumerate(texts):
            if not self._plain(t):
                slow.append(i)
                continue
            parts = [t]
            if self.split_special and any(s in t for s in self.special):
                parts = self.split_special.split(t)
                out[i] = len(parts) - 1
            c = Counter(self.cut.findall(parts[0]))
            for p in parts[1:]:
                c.update(self.cut.findall(p))
            cuts.append((i, c))
        for i, e in zip(slow, self.lib.encode_batch([texts[i] for i in slow], add_special_tokens=False), strict=True):
            out[i] = len(e.ids)
        if len(self.known) > CACHE:
            self.known.clear()
        rest = list({p for _, c in cuts for p in c if p not in self.whole and p not in self.known})
        for p, e in zip(rest, self.lib.encode_batch(rest, add_special_tokens=False), strict=True):
            self.known[p] = len(e.ids)
        whole, known = self.whole, self.known
        for i, c in cuts:
            out[i] += sum(n if p in whole else n * known[p] for p, n in c.items())
        return out


def _batches(texts: list[str], chars: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Slices of about that many characters."""
    a = n = 0
    for b, t in enumerate(texts):
        n += len(t)
        if n >= chars:
            yield a, b + 1
            a, n = b + 1, 0
    if a < len(texts):
        yield a, len(texts)


def count_tokens(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = 1024) -> DataFrame:
    """One row per row of df: key, n_bytes, n_tokens, over_limit (more than `limit` tokens).

    A null text counts as empty; texts of any length are read whole; repeated rows are counted each; an
    empty table gives no rows; other columns are not read. The broadcast set of proved strings is
    bounded by the vocabulary.
    """
    spark = df.sparkSession
    whole = None
    if path.endswith(".json") and byte_level_bpe(path):
        whole = spark.sparkContext.broadcast(prove_whole(path))
    kind = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean"

    def run(batches):
        counter = TokenCounter(path, whole.value if whole else None)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            n = np.zeros(len(texts), np.int64)
            for x, y in _batches(texts):
                n[x:y] = counter.counts(texts[x:y])
            size = pa.array([len(t.encode()) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), size, pa.array(n), pa.array(n > limit)], names=[key, "n_bytes", "n_tokens", "over_limit"])

    return df.select(df[key], df[text]).mapInArrow(run, schema)

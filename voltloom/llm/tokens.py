"""Token counts by the whole-token shortcut.

A word-level BPE splits a text into pre-tokens, which never span white space, and merges each alone. Offline, every
vocabulary string is put through the library once; those which come back as exactly one token form the *whole-token*
table. What stands between white space and is found there counts as one token without any merging. Only the rest runs
through the merges, and each distinct stretch only once per worker as long as it stays in a bounded memo.

The fast path reproduces the tokenizer's normaliser and splitter for texts whose characters lie below U+0250 (ASCII
and the Latin blocks), where Python and the library agree on case and letter classes. Any other text goes whole
through the library, so the result is the library's for every input.
"""

from __future__ import annotations

import gc
import json
import os
import re
import unicodedata
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Distinct stretches between white space that a worker remembers because they came back (about 200 bytes each), those
#: it keeps until they might, and how many it looks up at once.
MEMO, RECENT, CHUNKS = 200_000, 120_000, 100_000
#: Fixed values of the tokenizer file that the fast path reproduces.
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALISERS = ["NFC", "Replace", "Lowercase"]
#: The same split over lower-case text below U+0250, for the standard library's faster engine: a letter is a word
#: character that is neither a digit nor an underscore, except for the numerals below U+0250 that are no decimals.
_NUMERALS = "0-9²³¹¼½¾"
_SPLIT = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d|[^\W_{_NUMERALS}]+|[{_NUMERALS}]|(?:[^\w\s]|_)+"
)
#: What the fast path takes: below U+0250, without the separators U+001C to U+001F that only Python calls white space,
#: U+0085, and U+0130, whose lower case is two characters.
_PLAIN = re.compile("[\x00-\x1b\x20-\x84\x86-įı-ɏ]*")


class WholeTokenEncoder:
    """Encodes texts to token ids with whole-token and memo lookups before merges."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.suffix = spec["model"].get("end_of_word_suffix") or ""
        steps = (spec.get("normalizer") or {}).get("normalizers", [])
        split = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0].get("pattern", {}).get("Regex")
        self.fast = [s["type"] for s in steps] == NORMALISERS and split == SPLIT_PATTERN
        specials = [t["content"] for t in spec["added_tokens"]]
        self.specials = re.compile("|".join(map(re.escape, specials))) if specials else None
        largest = max(spec["model"]["vocab"].values(), default=0) + 1 + len(specials)
        self.width = 2 if largest < 1 << 16 else 4
        self.code = [i.to_bytes(self.width, "little") for i in range(largest)]
        self.whole = self._prove_whole(spec["model"]["vocab"]) if self.fast else {}
        self.memo: dict[str, bytes] = dict(self.whole)
        self.recent: dict[str, bytes] = {}
        self.letters = {b: c for c, b in _byte_letters().items()}
        self.fast = self.fast and bool(self.suffix)

    def _prove_whole(self, vocab: dict[str, int]) -> dict[str, bytes]:
        """Vocabulary strings that the library encodes, alone, as exactly their own token."""
        alphabet = _byte_letters()
        words = []
        for token in vocab:
            if token.endswith(self.suffix) and len(token) > len(self.suffix):
                raw = bytes(alphabet.get(c, 0) for c in token[: -len(self.suffix)] if c in alphabet)
                try:
                    word = raw.decode("utf-8")
                except UnicodeDecodeError:
                    continue
                if _PLAIN.fullmatch(word) and self._normal(word) == word and _SPLIT.findall(word) == [word]:
                    words.append((word, vocab[token]))
        encoded = self.library.encode_batch([w for w, _ in words], add_special_tokens=False)
        return {w: self.code[i] for (w, i), e in zip(words, encoded, strict=True) if e.ids == [i]}

    @staticmethod
    def _normal(text: str) -> str:
        return (text if text.isascii() else unicodedata.normalize("NFC", text)).lower()

    def _merged(self, chunk: str) -> bytes:
        """Ids of a stretch between white space, pre-token by pre-token, by the library's own merges."""
        merge, letters, code = self.library.model.tokenize, self.letters, self.code
        if chunk.isalpha():
            return b"".join([code[t.id] for t in merge(chunk if chunk.isascii() else chunk.encode().decode("latin-1").translate(letters))])
        out = []
        for w in _SPLIT.findall(chunk):
            known = self.memo.get(w)
            if known is None:
                raw = w if w.isascii() and w.isprintable() else w.encode().decode("latin-1").translate(letters)
                known = b"".join([code[t.id] for t in merge(raw)])
            out.append(known)
        return b"".join(out)

    def _learn(self, chunks: set[str]) -> dict[str, bytes]:
        """Ids of stretches that aren't in the memo. One that was met a short while ago is remembered from now on; most
        are met once and never again, and only pass through the list of recent ones."""
        recent, out = self.recent, {}
        for chunk in chunks:
            known = recent.get(chunk)
            if known is not None:
                self.memo[chunk] = known
            else:
                known = self._merged(chunk)
                if len(chunk) <= 64:
                    recent[chunk] = known
            out[chunk] = known
        if len(recent) > RECENT:
            recent.clear()
        if len(self.memo) > MEMO:
            self.memo = dict(self.whole)
        return out

    def packed(self, text: str | None) -> bytes:
        """Ids of the whole text, ``self.width`` little-endian bytes each; null is empty."""
        if not text:
            return b""
        if not self.fast or not _PLAIN.fullmatch(text) or (self.specials and "<|" in text and self.specials.search(text)):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, f"<u{self.width}").tobytes()
        out = []
        words = self._normal(text).split()
        for at in range(0, len(words), CHUNKS):  # keeps the lists of a giant text small
            part = words[at : at + CHUNKS]
            found = list(map(self.memo.get, part))
            if None in found:
                new = self._learn({w for w, f in zip(part, found, strict=True) if f is None})
                found = [new[w] if f is None else f for w, f in zip(part, found, strict=True)]
            out.append(b"".join(found))
        return b"".join(out)

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of the whole text."""
        return np.frombuffer(self.packed(text), f"<u{self.width}")

    def count(self, text: str | None) -> int:
        """Number of ids of the whole text."""
        return len(self.packed(text)) // self.width


@contextmanager
def without_cycles() -> Iterator[None]:
    """Pause Python's search for cyclic garbage, which scans the whole memo again and again; nothing here is cyclic."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def _byte_letters() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 characters stand for themselves, the other bytes follow from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def encoder(path: str) -> WholeTokenEncoder:
    """One encoder for each worker process and file."""
    return WholeTokenEncoder(path)


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 2048, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Tokens of every whole text, as the library counts them without added special tokens.

    Special strings inside a text are matched as the library does by default. A null text counts as empty (0 tokens);
    repeated rows give repeated results; a null id stays null; an empty table gives an empty result. Other columns of
    the input are ignored, whatever their names. Map-only: nothing is shuffled, and a worker holds one Arrow batch and
    the bounded memo.

    Returns: ``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (n_tokens > limit).
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(tokenizer_path)
        for b in batches:
            texts = [t if isinstance(t, str) else "" for t in b["text"]]
            with without_cycles():
                n = np.fromiter(map(enc.count, texts), np.int64, len(texts))
            size = np.fromiter((len(t) if t.isascii() else len(t.encode()) for t in texts), np.int64, len(texts))
            yield pd.DataFrame({"doc_id": b["doc_id"], "n_bytes": size, "n_tokens": n, "over_limit": n > limit})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInPandas(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")

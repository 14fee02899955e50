"""SentencePiece encoding and decoding: by a max-plus parallel scan, or by rank merges.

A BPE model merges neighbours by rank. No merge crosses a place whose two characters stand side by side in no piece; so a
giant document is cut at such places only, and the library merges each chunk by itself. A stretch without one stays whole.

In a unigram model, a text's segmentation is the path of pieces with the largest sum of scores. A giant document is cut into chunks, at
any character. What a chunk does to a path is a matrix over boundary states: entry (i, j) is the best score of a path
that enters when i characters of the chunk are already covered by a piece from before and leaves with j characters of
the next chunk covered. Such matrices multiply associatively in the max-plus semiring, so a document's boundary states
come from a tree of products over small matrices; then every chunk finds its own pieces between its two states.

Within a chunk, no piece holds a space mark after another character, so all paths meet before such a mark. What lies
between two of them is solved once and remembered. Of paths with equal scores, the one whose last piece is longer wins
from one meeting place to the next; where a chunk's edge lies within such a stretch, another of equal score may win.

The vocabulary, scores and byte pieces are those of the model file; special pieces never match text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .tokens import without_cycles

MARK = "▁"
#: Characters of a chunk; documents of more than one chunk are scanned in parallel.
CHUNK = 1 << 15
#: Words that a worker remembers.
MEMO = 250_000
LEAST = -np.inf
_WORD = re.compile(f"{MARK}*[^{MARK}\\n]+|{MARK}+|\\n")


class Lattice:
    """The pieces of a model and the best paths through them."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.piece = [model.id_to_piece(i) for i in range(n)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i) for i in range(n)]
        self.score = {p: (model.get_score(i), i) for i, p in enumerate(self.piece) if not special[i]}
        self.byte = {int(p[3:5], 16): i for i, p in enumerate(self.piece) if model.is_byte(i)}
        self.unknown_id = model.unk_id()
        self.unknown = min(s for s, _ in self.score.values()) - 10.0
        self.longest = max(map(len, self.score))
        self.states = self.longest  # 0 to longest - 1 characters covered
        self.apart = not any((MARK in p[1:] and p.strip(MARK)) or "\n" in p for p in self.score)
        self.codes = [i.to_bytes(2 if n < 1 << 16 else 4, "little") for i in range(n)]
        self.root: dict = {}  # a trie: character to (children, score or None)
        for p in sorted(self.score, key=len):
            node = self.root
            for c in p[:-1]:
                node = node.setdefault(c, ({}, None))[0]
            node[p[-1]] = (node.get(p[-1], ({},))[0], self.score[p][0])
        # a character that no piece covers costs as much however many byte pieces write it: the first byte's piece counts
        self.worth_of = np.array([self.score[p][0] if not special[i] else 0.0 for i, p in enumerate(self.piece)])
        for b, i in self.byte.items():
            self.worth_of[i] = self.unknown if b & 0xC0 != 0x80 else 0.0
        if self.unknown_id >= 0 and len(self.byte) < 256:
            self.worth_of[self.unknown_id] = self.unknown
        self.alphabet = {p for p in self.score if len(p) == 1}
        self.automaton = ahocorasick.Automaton()
        for p, (x, i) in self.score.items():
            self.automaton.add_word(p, (len(p), x, self.codes[i]))
        self.automaton.make_automaton()
        self.bytes_of = [b"" if special[i] else p.encode("utf-8", "surrogatepass") for i, p in enumerate(self.piece)]
        for b, i in self.byte.items():
            self.bytes_of[i] = bytes([b])
        self.width = 2 if n < 1 << 16 else 4
        self.memo: dict[str, bytes] = {}

    def code(self, ids: list[int]) -> bytes:
        return b"".join([self.codes[i] for i in ids])

    def unknown_ids(self, c: str) -> list[int]:
        """A character that no piece covers: its bytes' pieces, or the unknown piece in a model without them."""
        return [self.byte[b] for b in c.encode("utf-8", "surrogatepass")] if len(self.byte) == 256 else [self.unknown_id]

    def forward(self, s: str, start: int, stop: int) -> tuple[list[float], list[int]]:
        """Best scores and last steps' starts from ``start`` to each place up to ``longest - 1`` after ``stop``.

        Pieces begin before ``stop``. Both lists count from ``start``. Of equal scores the longer last piece wins.
        """
        end = min(len(s), stop + self.longest - 1)
        best, back = [LEAST] * (end - start + 1), [-1] * (end - start + 1)
        best[0] = 0.0
        root, unknown, until = self.root, self.unknown, end - start
        for i in range(stop - start):
            here = best[i]
            if here == LEAST:
                continue
            node, single = root, False
            for to in range(i, until):
                step = node.get(s[start + to])
                if step is None:
                    break
                node, score = step
                if score is not None:
                    single |= to == i
                    if here + score > best[to + 1]:
                        best[to + 1], back[to + 1] = here + score, start + i
            if not single and here + unknown > best[i + 1]:
                best[i + 1], back[i + 1] = here + unknown, start + i
        return best, back

    def path(self, s: str, start: int, end: int, back: list[int]) -> list[int]:
        out: list[list[int]] = []
        at = end
        while at > start:
            i = back[at - start]
            found = self.score.get(s[i:at])
            out.append([found[1]] if found else self.unknown_ids(s[i]))
            at = i
        return [x for ids in reversed(out) for x in ids]

    def word(self, w: str) -> bytes:
        """Packed ids of a stretch in which paths begin and end: the search of ``forward`` over an automaton's matches.

        Matches come by their ends, the longest first; so all that lead to a place are known before any goes on from it.
        """
        n = len(w)
        if not self.alphabet.issuperset(w):  # only here can a character be uncovered
            return self.code(self.path(w, 0, n, self.forward(w, 0, n)[1]))
        best, back, code = [0.0] + [LEAST] * n, [0] * (n + 1), [b""] * (n + 1)
        for last, (length, score, own) in self.automaton.iter(w):
            start = last + 1 - length
            x = best[start] + score
            if x > best[last + 1]:
                best[last + 1], back[last + 1], code[last + 1] = x, start, own
        out = []
        while n:
            out.append(code[n])
            n = back[n]
        out.reverse()
        return b"".join(out)

    def words(self, s: str) -> list[str]:
        """Cut before every mark that follows another character, and around line breaks."""
        if not self.apart:
            return [s]
        return _WORD.findall(s)

    def solved(self, s: str) -> bytes:
        """Packed ids of a text in which paths begin and end."""
        words = self.words(s) if s else []
        found = list(map(self.memo.get, words))
        if None in found:
            if len(self.memo) > MEMO:
                self.memo.clear()
            memo, new = self.memo, {}
            for w, f in zip(words, found, strict=True):
                if f is None and w not in new:
                    new[w] = self.word(w)
            found = [new[w] if f is None else f for w, f in zip(words, found, strict=True)]
            memo.update((w, f) for w, f in new.items() if len(w) <= 64)
        return b"".join(found)

    def worth(self, s: str) -> float:
        """Score of the best path through a text in which paths begin and end: that of its pieces."""
        return float(self.worth_of[np.frombuffer(self.solved(s), f"<u{self.width}")].sum())

    # --- chunks ------------------------------------------------------------------------------------------------------

    def _cuts(self, s: str, n: int) -> tuple[int, int] | None:
        """The first and last place of a chunk, beyond any entry state, at which all paths meet."""
        if not self.apart:
            return None
        first = next((p for p in range(self.longest, n + 1) if p < len(s) and s[p] == MARK and s[p - 1] != MARK), None)
        if first is None:
            return None
        return first, next(p for p in range(n, first - 1, -1) if p < len(s) and s[p] == MARK and s[p - 1] != MARK)

    def transfer(self, s: str, n: int) -> np.ndarray:
        """Matrix of a chunk of ``n`` characters; ``s`` goes on into the next chunk by ``longest - 1`` characters."""
        k = self.states
        cuts = self._cuts(s, n)
        if cuts:
            first, last = cuts
            enter = np.array([self.forward(s, i, first)[0][first - i] for i in range(k)])
            leave = np.full(k, LEAST)
            best = self.forward(s, last, n)[0]
            leave[: len(best) - (n - last)] = best[n - last :][:k]
            return enter[:, None] + self.worth(s[first:last]) + leave[None, :]
        return self._from_all(s, n)

    def _from_all(self, s: str, n: int) -> np.ndarray:
        """The matrix by one pass, in which every place holds the best scores from all entry states."""
        k = self.states
        until = min(len(s), n + k - 1)
        best = np.full((n + k, k), LEAST)
        entries = np.arange(min(k, n + 1))
        best[entries, entries] = 0.0
        for i in range(n):
            here, node, single = best[i], self.root, False
            for to in range(i, until):
                step = node.get(s[to])
                if step is None:
                    break
                node, score = step
                if score is not None:
                    single |= to == i
                    np.maximum(best[to + 1], here + score, out=best[to + 1])
            if not single:
                np.maximum(best[i + 1], here + self.unknown, out=best[i + 1])
        return best[n:].T.copy()

    def between(self, s: str, n: int, enter: int, leave: int) -> bytes:
        """Packed ids of the pieces that begin in a chunk, given its boundary states."""
        cuts = self._cuts(s, n)
        if not cuts:
            _, back = self.forward(s, enter, n)
            return self.code(self.path(s, enter, n + leave, back))
        first, last = cuts
        head, tail = self.forward(s, enter, first)[1], self.forward(s, last, n)[1]
        return self.code(self.path(s, enter, first, head)) + self.solved(s[first:last]) + self.code(self.path(s, last, n + leave, tail))

    def decode(self, packed: bytes) -> str:
        """Text of packed ids; special pieces have none."""
        raw = b"".join(map(self.bytes_of.__getitem__, np.frombuffer(packed, f"<u{self.width}").tolist()))
        text = raw.decode("utf-8", "surrogatepass").replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


class Merges(Lattice):
    """The pieces of a BPE model, merged by rank as the library does."""

    def __init__(self, path: str):
        super().__init__(path)
        from sentencepiece import SentencePieceProcessor

        proto = _proto(path)
        proto.normalizer_spec.add_dummy_prefix = False  # texts come with their mark
        self.library = SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.pairs = {p[i : i + 2] for p in self.piece for i in range(len(p) - 1)}

    def solved(self, s: str) -> bytes:
        return np.array(self.library.encode(s), f"<u{self.width}").tobytes()

    def _joined(self, pair: str) -> bool:
        """Whether a merge may cross the place between two characters; unknown pieces side by side become one."""
        return pair in self.pairs or (len(self.byte) < 256 and self.alphabet.isdisjoint(pair))

    def edges(self, s: str, chunk: int) -> list[int]:
        """Edges of chunks of at least about ``chunk`` characters that no merge crosses."""
        n = max(1, len(s) // chunk)
        out = [0]
        for i in range(1, n):
            at = max(out[-1] + 1, len(s) * i // n)
            while at < len(s) and self._joined(s[at - 1 : at + 1]):
                at += 1
            if at >= len(s):
                break
            out.append(at)
        return [*out, len(s)]


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product."""
    return (a[:, :, None] + b[None, :, :]).max(1)


def boundary_states(matrices: list[np.ndarray]) -> list[int]:
    """The state at each boundary of the best path that enters the first chunk at 0 and leaves the last at 0.

    An up-sweep multiplies neighbours in a binary tree; a down-sweep splits each product's best score into its halves.
    """
    if not matrices:
        return [0]
    level = [list(matrices)]
    while len(level[-1]) > 1:
        m = level[-1]
        level.append([times(m[i], m[i + 1]) if i + 1 < len(m) else m[i] for i in range(0, len(m), 2)])
    edges = [0, 0]
    for m in reversed(level[:-1]):
        out = [edges[0]]
        for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            if 2 * i + 1 < len(m):
                out.append(int((m[2 * i][a] + m[2 * i + 1][:, b]).argmax()))
            out.append(b)
        edges = out
    return edges


@lru_cache(maxsize=2)
def lattice(path: str) -> Lattice:
    return Lattice(path)


@lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


def _proto(path: str):
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    return proto


def merges_by_rank(path: str) -> bool:
    """Whether a model file is a BPE model."""
    spec = _proto(path).trainer_spec
    return spec.model_type == spec.BPE


def marked(text: str | None) -> str:
    """Text with a space in front and spaces as marks; nothing for an empty one."""
    return MARK + text.replace(" ", MARK) if text else ""


def encode(docs: DataFrame, model_path: str, text: str = "text", id_col: str = "doc_id", chunk: int = CHUNK) -> DataFrame:
    """Encode and decode every whole text.

    A null or empty text has no pieces and decodes to an empty one; characters that no piece covers become byte pieces.
    (A mark U+2581 in a text is the same as a space, as in the format itself, and decodes to one.) Repeated rows and null
    ids give a row each; an empty table gives an empty result; other columns are ignored.

    Short documents are solved where they are read. Chunks of giant ones are dealt out; their matrices, of a size that
    doesn't depend on the text, meet by document; the chunks' ids then meet by document, as the result has them.

    Returns ``doc_id``, ``n_pieces``, ``ids`` (little-endian unsigned 32-bit), ``decoded``, ``n_chunks``.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    kind = "doc_id long, n_pieces long, ids binary, decoded string, n_chunks int"
    giant = F.length("text") >= chunk
    by_rank = merges_by_rank(model_path)
    load = merges if by_rank else lattice

    def result(m: Lattice, ids: list, packed: list[bytes], chunks: list[int]) -> pd.DataFrame:
        wide = [np.frombuffer(x, f"<u{m.width}").astype("<u4").tobytes() for x in packed]
        frame = pd.DataFrame({"doc_id": ids, "n_pieces": [len(x) // 4 for x in wide], "ids": wide, "decoded": list(map(m.decode, packed)), "n_chunks": chunks})
        return frame.assign(doc_id=frame["doc_id"].astype("Int64"))

    def whole(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = load(model_path)
        for b in it:
            for at in range(0, len(b), 500):
                part = b.iloc[at : at + 500]
                with without_cycles():
                    packed = [m.solved(marked(t)) for t in part["text"]]
                yield result(m, part["doc_id"].tolist(), packed, [1] * len(part))

    def cut(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = load(model_path)
        for b in it:
            for doc, rid, t in zip(b["doc_id"], b["rid"], b["text"], strict=True):
                s = marked(t)
                n = max(1, len(s) // chunk)
                edges = m.edges(s, chunk) if by_rank else [len(s) * i // n for i in range(n + 1)]
                over = 0 if by_rank else m.longest - 1
                for i in range(len(edges) - 1):
                    out = {"doc_id": [doc], "rid": [rid], "chunk": [i], "n": [edges[i + 1] - edges[i]], "s": [s[edges[i] : edges[i + 1] + over]]}
                    yield pd.DataFrame(out).astype({"doc_id": "Int64"})

    def matrices(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = lattice(model_path)
        for b in it:
            made = [m.transfer(s, n).astype("<f8").tobytes() for s, n in zip(b["s"], b["n"], strict=True)]
            yield pd.DataFrame({"rid": b["rid"], "chunk": b["chunk"], "matrix": made})

    def scan(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values("chunk")
        k = int(round((len(b["matrix"].iloc[0]) // 8) ** 0.5))
        states = boundary_states([np.frombuffer(x, "<f8").reshape(k, k) for x in b["matrix"]])
        return pd.DataFrame({"rid": b["rid"], "chunk": b["chunk"], "enter": states[:-1], "leave": states[1:]})

    def trace(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = lattice(model_path)
        for b in it:
            ids = [m.between(s, n, a, z) for s, n, a, z in zip(b["s"], b["n"], b["enter"], b["leave"], strict=True)]
            yield pd.DataFrame({"rid": b["rid"], "doc_id": b["doc_id"].astype("Int64"), "chunk": b["chunk"], "packed": ids})

    def merge(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = load(model_path)
        for b in it:
            yield pd.DataFrame({"rid": b["rid"], "doc_id": b["doc_id"].astype("Int64"), "chunk": b["chunk"], "packed": list(map(m.solved, b["s"]))})

    def join(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values("chunk")
        doc = b["doc_id"].iloc[0]
        return result(load(model_path), [None if pd.isna(doc) else int(doc)], [b"".join(b["packed"])], [len(b)])

    short = rows.where(~giant).mapInPandas(whole, kind)
    long_ = rows.where(giant).withColumn("rid", F.monotonically_increasing_id())
    spread = F.xxhash64("rid", "chunk")
    chunks = materialise(long_.mapInPandas(cut, "doc_id long, rid long, chunk int, n int, s string"), "chunks").repartition(spread)
    found = "rid long, doc_id long, chunk int, packed binary"
    if by_rank:
        return short.unionByName(chunks.mapInPandas(merge, found).groupBy("rid").applyInPandas(join, kind))
    states = chunks.mapInPandas(matrices, "rid long, chunk int, matrix binary").groupBy("rid").applyInPandas(scan, "rid long, chunk int, enter int, leave int")
    traced = chunks.join(states, ["rid", "chunk"]).mapInPandas(trace, found)
    return short.unionByName(traced.groupBy("rid").applyInPandas(join, kind))

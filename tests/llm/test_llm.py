"""The corpus operators against brute force, exact round trips and defined results of odd input."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voltloom.llm import neardup, packing, pieces, quality, repeats, sharding, suffix_kernel, tokens, vectors
from voltloom.llm.components import connected_components
from voltloom.llm.html_text import extract, main_text
from voltloom.llm.queries import oracle_sql, queries, tokenizer
from voltloom.llm.shingles import shingles

from .conftest import prose

WORD = tokenizer("word_bpe_49k.json")
DATA = "/root/testdata/sf0.001"


# --- tokens and packing ---------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORD)


def test_whole_tokens_are_proved(library):
    enc = tokens.encoder(WORD)
    assert len(enc.whole) > 30_000
    some = sorted(enc.whole)[::500]
    assert [library.encode(w, add_special_tokens=False).ids for w in some] == [[int.from_bytes(enc.whole[w], "little")] for w in some]


@settings(max_examples=60, deadline=None)
@given(st.text(st.characters(max_codepoint=0x260, exclude_categories=["Cs"]), max_size=60))
def test_ids_are_the_librarys(text):
    enc = tokens.encoder(WORD)
    assert enc.encode(text).tolist() == enc.library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["", "It's <|endoftext|>here<|startoftext|>", "a\u0085b\x1cc", "日本語 ＡＢ", "ǅ İ ß ſ", "don't we'll 12.5% ±²"])
def test_special_and_rare_characters(text):
    enc = tokens.encoder(WORD)
    assert enc.encode(text).tolist() == enc.library.encode(text, add_special_tokens=False).ids


def test_memo_is_bounded(monkeypatch):
    enc = tokens.WholeTokenEncoder(WORD)
    monkeypatch.setattr(tokens, "MEMO", len(enc.whole) + 10)
    monkeypatch.setattr(tokens, "RECENT", 5)
    monkeypatch.setattr(tokens, "CHUNKS", 7)
    text = " ".join(prose(np.random.default_rng(0), 3, 100))
    assert enc.encode(text).tolist() == enc.library.encode(text, add_special_tokens=False).ids


def test_counts(spark, docs, odd_rows, library):
    got = sorted(map(tuple, tokens.count_tokens(docs(odd_rows), WORD).collect()), key=str)
    want = [(i, len((t or "").encode()), (n := len(library.encode(t or "", add_special_tokens=False).ids)), n > 2048) for i, t in odd_rows]
    assert got == sorted(want, key=str)
    assert tokens.count_tokens(docs([]), WORD).count() == 0


def check_packing(pieces_, want):
    seen = {}
    for p in pieces_:
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert len(ids) == p.length > 0
        seen.setdefault((p.doc_id, p.doc_tokens), []).append((p.start, ids))
    assert sorted(Counter((d, tuple(i for _, x in sorted(v, key=lambda x: x[0]) for i in x)) for (d, _), v in seen.items()).items(), key=str) == sorted(want.items(), key=str)


def test_packing(spark, docs, library):
    rng = np.random.default_rng(1)
    rows = [(i, t) for i, t in enumerate(prose(rng, 60, 250) + [None, "", "word " * 7000])]
    got = packing.pack(docs(rows), WORD).collect()
    check_packing(got, Counter((i, tuple([*library.encode(t or "", add_special_tokens=False).ids, 1])) for i, t in rows))
    sequences = {}
    for p in got:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(p.length for p in got)
    assert len(sequences) == -(-total // 2048)  # one block: no more sequences than the ids need


def test_packing_odd_rows(spark, docs, odd_rows):
    got = packing.pack(docs(odd_rows), WORD).agg(F.sum("length"), F.countDistinct("sequence_id")).first()
    want = tokens.count_tokens(docs(odd_rows), WORD).agg(F.sum("n_tokens") + F.count("*")).first()[0]
    assert got[0] == want
    assert packing.pack(docs([]), WORD).count() == 0


def test_copies_of_a_row_spread_over_blocks(spark, docs, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 50)
    monkeypatch.setattr(packing, "COPIES", 7)
    rows = [(1, "the same row")] * 600 + [(i, f"row {i} of its own") for i in range(2, 400)] + [(5000, None), (5000, ""), (None, "x"), (None, "x")]
    spread = docs(rows).repartition(8)
    got = [packing.pack(d, WORD).drop("ids").collect() for d in (docs(rows).coalesce(1), spread)]
    assert sorted(map(str, got[0])) == sorted(map(str, got[1]))  # however the rows are split
    blocks = Counter(p.sequence_id >> packing.LOCAL_BITS for p in got[0] if p.start == 0)
    assert len(blocks) == 21 and max(blocks.values()) < 100
    assert Counter(p.doc_id for p in got[0] if p.start == 0)[1] == 600


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 50), max_size=40))
def test_assignment(lengths):
    out = packing.assign(np.array(lengths, np.int64), 50)
    used = Counter()
    covered = Counter()
    for i, start, n, s, offset in sorted(out, key=lambda x: (x[3], x[4])):
        assert offset == used[s]
        used[s] += n
        covered.update((i, k) for k in range(start, start + n))
    assert covered == Counter((i, k) for i, n in enumerate(lengths) for k in range(n))
    assert all(n <= 50 for n in used.values()) and len(used) <= -(-sum(lengths) // 50)


# --- sharding ---------------------------------------------------------------------------------------------------------------


def check_shards(rows, got, shards):
    size = Counter()
    slots = {}
    for r in got:
        size[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.law == "bytes" and 0 <= r.shard < shards
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == want
    return size


def test_shards(spark, docs):
    rng = np.random.default_rng(2)
    texts = prose(rng, 300, 60)
    rows = list(enumerate(texts + texts[:40] + texts[:20]))
    got = sharding.shard(docs(rows), 8).collect()
    size = check_shards(rows, got, 8)
    mean = sum(size.values()) / 8
    assert max(size.values()) - min(size.values()) < 0.1 * mean
    of = {}
    for r in got:
        of.setdefault(r.text_crc32, set()).add(r.shard)
    assert sum(len(s) > 1 for s in of.values()) <= 3


def test_shards_split_a_class_that_is_too_large(spark, docs):
    rng = np.random.default_rng(3)
    rows = list(enumerate(prose(rng, 100, 40) + prose(rng, 1, 40) * 100))
    size = check_shards(rows, sharding.shard(docs(rows), 4).collect(), 4)
    assert max(size.values()) < 1.15 * min(size.values())


def test_shards_odd_rows(spark, docs, odd_rows):
    check_shards(odd_rows, sharding.shard(docs(odd_rows), 3).collect(), 3)
    assert sharding.shard(docs([]), 3).count() == 0


# --- repeats ----------------------------------------------------------------------------------------------------------------


def brute_repeats(rows, window):
    raws = [(t or "").encode() for _, t in rows]
    count = Counter(r[i : i + window] for r in raws for i in range(len(r) - window + 1))
    out = []
    for (doc, _), r in zip(rows, raws, strict=True):
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - window + 1):
            if count[r[i : i + window]] > 1:
                gone[i : i + window] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((doc, len(r), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(r, np.uint8)[~gone])).hexdigest()))
    return sorted(out, key=str)


def brute_passages(rows, window, words, size):
    """Runs of repeated windows with more than so many words, or so many bytes or more, by document."""
    raws = [(t or "").encode() for _, t in rows]
    count = Counter(r[i : i + window] for r in raws for i in range(len(r) - window + 1))
    out = []
    for (doc, _), r in zip(rows, raws, strict=True):
        gone = np.zeros(len(r) + 2, int)
        for i in range(len(r) - window + 1):
            if count[r[i : i + window]] > 1:
                gone[i + 1 : i + window + 1] = 1
        edge = np.flatnonzero(np.diff(gone))
        runs = [(int(a), int(z)) for a, z in zip(edge[::2], edge[1::2], strict=True)]
        out.append((doc, [(a, z) for a, z in runs if z - a >= size or len(r[a:z].decode("utf-8", "ignore").split()) > words]))
    return sorted(out, key=str)


def got_repeats(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in df.collect()), key=str)


def planted(rng):
    texts = prose(rng, 25, 150)
    passage = prose(rng, 1, 90)[0]
    for i in range(0, 12):
        cut = int(rng.integers(0, len(texts[i])))
        texts[i] = texts[i][:cut] + passage[int(rng.integers(0, 60)) : len(passage) - int(rng.integers(0, 60))] + texts[i][cut:]
    texts[3] += texts[3]
    return list(enumerate([*texts, texts[0], texts[1][:500] + "é" + texts[1][500:]]))


@pytest.mark.parametrize("group", [256, 3, 1])
def test_repeats(spark, docs, monkeypatch, group):
    monkeypatch.setattr(repeats, "GROUP", group)
    rows = planted(np.random.default_rng(4))
    assert got_repeats(repeats.remove_repeats(docs(rows).drop("kept", "n_bytes"))) == brute_repeats(rows, 400)


def test_passages(spark, docs):
    rng = np.random.default_rng(4)
    a, b, c = prose(rng, 1, 55)[0][:340], prose(rng, 1, 30)[0], "x" * 250 + " " + "y" * 120  # of over 50 words; of fewer; of few words
    assert len(a.split()) > 50 and len(a) < 400
    texts = [f"{p} {x} {q}" for p, q, x in zip(prose(rng, 9, 40), prose(rng, 9, 60), [a, b, c] * 3, strict=True)]
    rows = list(enumerate([*texts, *(t for _, t in planted(rng))]))
    want = brute_passages(rows, 200, 50, 400)
    out = repeats.remove_repeats(docs(rows).drop("kept", "n_bytes"), passages=(repeats.PASSAGE, repeats.PASSAGE_GRAM))
    assert got_repeats(out) == brute_repeats(rows, 400)
    assert sorted(((r.doc_id, [(x.start, x.end) for x in r.passages]) for r in out.collect()), key=str) == want
    assert [bool(x) for i, x in want if i < 9] == [True, False, False] * 3
    cut = repeats.remove_repeats(docs(rows).drop("kept", "n_bytes"), repeats.PASSAGE, repeats.PASSAGE_GRAM, least=repeats.LEAST)
    assert sorted(((r.doc_id, [(x.start, x.end) for x in r.spans]) for r in cut.collect()), key=str) == want


def test_query_gives_texts_without_passages(spark, docs, odd_rows, tmp_path):
    """The contract's columns say what 400 bytes do; passages of over 50 words that are shorter are gone from ``text``."""
    rng = np.random.default_rng(6)
    passage = prose(rng, 1, 55)[0][:340]
    assert len(passage.split()) > 50
    plants = [(100 + i, f"{p} {passage} {q}") for i, (p, q) in enumerate(zip(prose(rng, 4, 40), prose(rng, 4, 60), strict=True))]
    clean = list(enumerate(prose(rng, 3, 200), 200))
    rows = [*plants, *clean, *odd_rows]
    docs(rows).select("doc_id", "text").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries()["op5_suffix_dedup"](spark, str(tmp_path)).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=str) == brute_repeats(rows, 400)
    text = {r.doc_id: r.text for r in got if (r.doc_id or 0) >= 100}
    assert all(r.n_removed == 0 for r in got if r.doc_id in text)
    assert [passage in text[i] for i, _ in plants] == [False] * 4 and [text[i] for i, _ in clean] == [t for _, t in clean]
    raws = {i: (t or "").encode() for i, t in rows if i not in (None, 12)}  # ids of one text
    runs = brute_passages(rows, 200, 50, 400)
    want = {i: b"".join(raws[i][a:z] for a, z in zip([0, *(z for _, z in x)], [*(a for a, _ in x), len(raws[i])], strict=True)) for i, x in runs if i in raws}
    assert {r.doc_id: r.text for r in got if r.doc_id in raws} == {i: b.decode("utf-8", "ignore") if i != 3 else None for i, b in want.items()}
    assert sorted(((r.doc_id, r.n_passages) for r in got), key=str) == sorted(((i, len(x)) for i, x in runs), key=str)


def test_passages_odd_rows(spark, docs, odd_rows):
    out = repeats.remove_repeats(docs(odd_rows), passages=(200, 40))
    assert got_repeats(out) == brute_repeats(odd_rows, 400)
    assert sorted(((r.doc_id, [(x.start, x.end) for x in r.passages]) for r in out.collect()), key=str) == brute_passages(odd_rows, 200, 50, 400)
    assert repeats.remove_repeats(docs([]), passages=(200, 40)).count() == 0


def test_periodic_texts(spark, docs):
    """Texts that repeat themselves all along, up to 10 MB of one byte, take few rows of the search and go as a whole."""
    rows = [(1, "a" * 10_000_000), (2, "ab" * 300_000), (3, "q" * 399), (4, "abcdefghij" * 30_000), (5, "a" * 401), (6, "xyz" * 135)]
    frames = list(repeats._segments(400, 64)(iter([pd.DataFrame({"doc": [1], "text_hash": [1], "text": [rows[0][1].encode()]})])))
    assert sum(map(len, frames)) < 100
    out = {r.doc_id: (r.n_bytes, r.n_removed) for r in repeats.remove_repeats(docs(rows).drop("kept", "n_bytes")).select("doc_id", "n_bytes", "n_removed").collect()}
    assert out == {i: (len(t), 0 if i == 3 else len(t)) for i, t in rows}
    small = [(1, "a" * 450), (2, "ab" * 350), (3, "abc" * 160 + "x" * 30), (4, "x" * 500 + "abc" * 50), (5, ("-" * 120 + "\n") * 6), (6, "z" + "-" * 399)]
    assert got_repeats(repeats.remove_repeats(docs(small).drop("kept", "n_bytes"))) == brute_repeats(small, 400)


def test_repeats_odd_rows(spark, docs, odd_rows):
    df = docs(odd_rows)
    out = repeats.remove_repeats(df)
    assert got_repeats(out) == brute_repeats(odd_rows, 400)
    assert {"tid", "key", "size", "row", "rid"} <= set(out.columns)
    assert repeats.remove_repeats(docs([])).count() == 0


def test_repeats_without_other_columns(spark, docs):
    assert repeats.remove_repeats(docs([(1, "a" * 900)]).select("doc_id", "text")).first().n_removed == 900


def test_parts_of_giant_texts_overlap(spark, docs, monkeypatch):
    monkeypatch.setattr(repeats, "PASS", 700)
    rows = planted(np.random.default_rng(6))
    assert got_repeats(repeats.remove_repeats(docs(rows).drop("kept", "n_bytes"))) == brute_repeats(rows, 400)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("ab", min_size=6, max_size=30), min_size=2, max_size=12))
def test_suffix_sort(texts):
    raw = np.frombuffer("".join(texts).encode() + b"\0" * 6, np.uint8)
    at = np.arange(len(raw) - 6)
    s = suffix_kernel.Suffixes(raw, 6)
    got = suffix_kernel.merge_sort(s, at, np.array([0]), np.array([len(at)]))
    order = [bytes(raw[i : i + 6]) for i in got]
    assert order == sorted(order) and sorted(got.tolist()) == at.tolist()


def test_hash_collisions_are_noticed(monkeypatch):
    texts = [b"abcdefgh", b"abcdefgh", b"xbcdefgh"]
    group, shift, count = np.zeros(3, int), np.zeros(3, int), np.ones(3, int)
    want = [True, True, False]
    assert [bool(f[0]) for f in suffix_kernel.repeated_windows(texts, group, shift, count, 8)] == want
    monkeypatch.setattr(suffix_kernel.Suffixes, "equal", lambda self, x, y, length: np.ones(len(x), bool))  # all hashes collide
    assert [bool(f[0]) for f in suffix_kernel.repeated_windows(texts, group, shift, count, 8)] == want


# --- near duplicates --------------------------------------------------------------------------------------------------------


def brute_classes(rows):
    texts = sorted({t or "" for _, t in rows})
    text, h, count = shingles([t for _, t in rows])
    bucket = (h & np.uint64(neardup.BUCKETS - 1)).astype(np.int64)
    freq = np.bincount(np.unique(text * neardup.BUCKETS + bucket) % neardup.BUCKETS, minlength=neardup.BUCKETS)
    idf = neardup.idf_table(freq, len(rows))
    text, h, count = shingles(texts)
    w = neardup.weights(h, count, idf).astype(float)
    e = np.searchsorted(text, np.arange(len(texts) + 1))
    sets = [(h[a:b], w[a:b]) for a, b in zip(e[:-1], e[1:], strict=True)]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if neardup.weighted_jaccard(sets[i], sets[j]) >= neardup.SIMILAR:
                a, b = root[i], root[j]
                root = [a if r == b else r for r in root]
    at = {t: root[i] for i, t in enumerate(texts)}
    first = {}
    for i, t in rows:
        r = at[t or ""]
        first[r] = i if first.get(r) is None else first[r] if i is None else min(first[r], i)
    size = Counter(at[t or ""] for _, t in rows)
    return sorted(((i, first[at[t or ""]], size[at[t or ""]]) for i, t in rows), key=str)


def near_copies(rng, n=12, copies=6):
    rows = []
    for t in prose(rng, n, 300):
        words = t.split()
        rows.append(t)
        for _ in range(copies):
            w = list(words)
            for k in rng.integers(0, len(w), int(rng.integers(0, 12))):
                w[k] = "changed"
            rows.append(" ".join(w))
    return list(enumerate(rows))


def test_near_duplicates(spark, docs):
    rows = near_copies(np.random.default_rng(7))
    got = sorted(((r.doc_id, r.class_id, r.class_size) for r in neardup.near_duplicates(docs(rows)).collect()), key=str)
    assert got == brute_classes(rows)


def test_near_duplicates_in_blocks(spark, docs, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 4)
    rows = near_copies(np.random.default_rng(8), 4, 20)
    got = sorted(((r.doc_id, r.class_id, r.class_size) for r in neardup.near_duplicates(docs(rows)).collect()), key=str)
    assert got == brute_classes(rows)


def test_near_duplicates_across_blocks_of_a_template(spark, docs, monkeypatch):
    """Texts of one template are alike under the threshold; their near copies mostly lie in other blocks of a bucket."""
    monkeypatch.setattr(neardup, "BLOCK", 8)
    monkeypatch.setattr(neardup, "SIDE", 32)
    rng = np.random.default_rng(21)
    template = prose(rng, 1, 330)[0].split()
    rows = []
    for i in range(150):
        own = [f"own{i}x{k}" for k in range(70)]
        rows.append(" ".join(template + own))
        if i % 5 == 0:
            rows.append(" ".join(template + own[:35] + [f"new{i}x{k}" for k in range(35)]))
    rows = list(enumerate(rows))
    want = brute_classes(rows)
    assert Counter(size for _, _, size in want) == {1: 120, 2: 60}
    got = sorted(((r.doc_id, r.class_id, r.class_size) for r in neardup.near_duplicates(docs(rows)).collect()), key=str)
    assert got == want


def test_near_duplicates_odd_rows(spark, docs, odd_rows):
    got = sorted(((r.doc_id, r.class_id, r.class_size) for r in neardup.near_duplicates(docs(odd_rows)).collect()), key=str)
    assert got == brute_classes(odd_rows)
    assert neardup.near_duplicates(docs([])).count() == 0


def test_samples_agree_as_texts_are_similar():
    rng = np.random.default_rng(9)
    h = np.sort(rng.integers(0, 1 << 63, 400, dtype=np.uint64))
    w = rng.uniform(0.5, 2, 400)
    agree = []
    for _ in range(30):
        hs = np.sort(rng.integers(0, 1 << 63, 500, dtype=np.uint64))
        a, b = hs[:450], hs[50:]
        sa = neardup.sketch(np.zeros(450, int), a, np.ones(450), 1)
        sb = neardup.sketch(np.zeros(450, int), b, np.ones(450), 1)
        agree.append((sa == sb).mean())
    assert np.mean(agree) == pytest.approx(400 / 500, abs=0.04)
    assert (neardup.sketch(np.zeros(400, int), h, w, 1) == neardup.sketch(np.zeros(400, int), h, w, 1)).all()


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 14), st.integers(0, 14)), max_size=14))
def test_components(spark, pairs):
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    root = {x: x for p in pairs for x in p if p[0] != p[1]}
    for _ in root:
        for a, b in pairs:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    assert got == root


# --- pieces -----------------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def unigram(tmp_path_factory):
    """The piece vocabulary as a unigram model, so that the library searches for the best path too. Scores that the
    library's single precision can't add to others are raised."""
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(tokenizer("piece_bpe_32k.model"), "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    for p in model.pieces:
        p.score = max(p.score, -40000)
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(model.SerializeToString())
    return SentencePieceProcessor(model_proto=model.SerializeToString()), str(path)


def worth(m, packed):
    return sum(m.score[m.piece[i]][0] for i in np.frombuffer(packed, "<u2").tolist() if m.piece[i] in m.score)


def test_best_paths_are_the_librarys(unigram):
    library, path = unigram
    m = pieces.lattice(path)
    for t in [*(x[:300] for x in prose(np.random.default_rng(10), 40, 60)), "  two  spaces ", "Grüße, café", "日本語"]:
        assert np.frombuffer(m.solved(pieces.marked(t)), "<u2").tolist() == library.encode(t)


@settings(max_examples=40, deadline=None)
@given(st.text(st.sampled_from("ab the日é\n🙂_"), min_size=40, max_size=120), st.integers(1, 5))
def test_chunks(text, n):
    m = pieces.lattice(tokenizer("piece_bpe_32k.model"))
    s = pieces.marked(text)
    edges = [len(s) * i // n for i in range(n + 1)]
    if min(np.diff(edges)) < m.longest:
        return
    parts = [(s[a : z + m.longest - 1], z - a) for a, z in zip(edges[:-1], edges[1:], strict=True)]
    states = pieces.boundary_states([m.transfer(*p) for p in parts])
    got = b"".join(m.between(*p, a, z) for p, a, z in zip(parts, states[:-1], states[1:], strict=True))
    assert m.decode(got) == text
    assert worth(m, got) == worth(m, m.solved(s))


def test_matrices_of_space_free_chunks(unigram):
    m = pieces.lattice(unigram[1])
    rng = np.random.default_rng(37)
    letters = "abcdefghijklmnopqrstuvwxyzé日"
    for n in (1, 3, m.states, 90):
        for over in (0, 2, m.longest - 1):
            s = "".join(rng.choice(list(letters), n + over))
            want = np.full((m.states, m.states), pieces.LEAST)
            for i in range(min(m.states, n + 1)):
                best = m.forward(s, i, n)[0][n - i :][: m.states]
                want[i, : len(best)] = best
            assert np.array_equal(m.transfer(s, n), want)


def test_max_plus_products_are_associative():
    rng = np.random.default_rng(11)
    a, b, c = (rng.integers(-9, 9, (4, 4)).astype(float) for _ in range(3))
    assert (pieces.times(pieces.times(a, b), c) == pieces.times(a, pieces.times(b, c))).all()


def test_encode(spark, docs, odd_rows):
    path = tokenizer("piece_bpe_32k.model")
    rows = sorted(((r.doc_id, r.decoded, r.n_pieces, len(r.ids) // 4) for r in pieces.encode(docs(odd_rows), path, chunk=200).collect()), key=str)
    assert [r[:2] for r in rows] == sorted([(i, t or "") for i, t in odd_rows], key=str)
    assert all(r[2] == r[3] for r in rows)
    whole = pieces.encode(docs(odd_rows), path).where("n_chunks > 1").count()
    assert whole == 0 and pieces.encode(docs(odd_rows), path, chunk=200).where("n_chunks > 1").count() > 3
    assert pieces.encode(docs([]), path).count() == 0


def test_encode_merges_by_rank_as_the_library(spark, docs, odd_rows):
    from sentencepiece import SentencePieceProcessor

    path = tokenizer("piece_bpe_32k.model")
    library = SentencePieceProcessor(model_file=path)
    given_ = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    rows = [*given_, *odd_rows, (50, "une " * 200), (51, "  a\n\n b" * 100), (52, "▁d ▁▁ \t" * 60), (53, "日本語" * 100)]
    want = sorted(((i, library.encode(t or "")) for i, t in rows), key=str)
    for chunk in (200, pieces.CHUNK):
        got = pieces.encode(docs(rows), path, chunk=chunk).collect()
        assert sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in got), key=str) == want
        assert sorted((str(r.doc_id), r.decoded) for r in got) == sorted((str(i), (t or "").replace("▁", " ")) for i, t in rows)


# --- pages ------------------------------------------------------------------------------------------------------------------


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{body}</body></html>"


LONG = "This is a sentence, with commas, of some length that reads like prose. " * 4


@pytest.mark.parametrize(
    ("html", "want"),
    [
        (None, ""), ("", ""), ("plain text", "plain text"),
        (page(f"<nav><ul><li><a href=/>Home</a></li></ul></nav><article><h1>Head</h1><p>{LONG}<p>Second &amp; last.</article><footer>f</footer>"), f"Head {LONG.strip()} Second & last."),
        (page(f"<div class='sidebar'><p>{LONG}</p></div><div id=content><p>{LONG}</p><p>Short.</p><div class='comments'><p>{LONG}</p></div></div>"), f"{LONG.strip()} Short."),
        (page(f"<main><p>One<br>two<b>three</b>{LONG}</p><form>F</form><script>var x='</p>'</script></main>"), f"One twothree{LONG.strip()}"),
        (page(f"<article><p>{LONG}</p><!-- c <p>x</p> --><p>Cut <b>off"), f"{LONG.strip()} Cut off"),
        (page(f"<article><p>{LONG}</p></article><ol class=commentlist><li><article class='comment-body'><p>{LONG}</p></article></li></ol>"), LONG.strip()),
        (page(f"<div class=cookie-notice><p>{LONG}</p></div><div class=story><p>{LONG}</p><ul><li>point, one</li></ul><pre>x  = 1</pre></div>"), f"{LONG.strip()} point, one x = 1"),
        (page(f"<div class=ad>{LONG}</div><article><p>{LONG}</p><aside>no</aside></article>"), LONG.strip()),
    ],
)
def test_main_text(html, want):
    assert main_text(html) == want


@pytest.mark.parametrize(
    "body",
    [
        *(f"<article class={name}><p>{LONG}</p></article>" for name in ("responsive", "commentary", "replay", "replacement")),
        *(f"<div class='{name}'><p>{LONG}</p></div>" for name in ("page has-sidebar", "no-sidebar", "content with-sidebar", "hasSidebar", "legal")),
        f"<div class=widget><h1></h1><p>{LONG}</p></div>",
        f"<article><section id=related-work><h2 id=legal-status></h2><p id=search class=notice>{LONG}</p></section></article>",
    ],
)
def test_names_keep_main_text(body):
    assert main_text(page(body + "<div class=sidebar><p>Other.</p></div>" if "legal" not in body[:20] else body)) == LONG.strip()


def test_headings_keep_their_text():
    assert main_text(page(f"<article><h2 id=search>Search</h2><p>{LONG}</p><h2 class=related>Related work</h2><p>{LONG}</p></article>")) == f"Search {LONG.strip()} Related work {LONG.strip()}"


TEXTY = "commentary legal-analysis search-results response-time social-history related-work subscribe-rate reply-rate cookie-recipe notification-theory banner-year sponsorship-history share-price"
FOUR = "One more sentence, of the article. Another one follows it, and then a third. This is the fourth of them, the last in this part of the text, which ends with a full stop."


@pytest.mark.parametrize("outer", ["<article>{}</article>", "<div class=story>{}</div>", "<main>{}</main>"])
@pytest.mark.parametrize("part", [*(f"<section class={n}>" for n in TEXTY.split()), *(f"<section id={n}>" for n in ("related-work", "legal", "search", "commentary")), *(f"<div class={n}>" for n in ("legal", "search", "related", "social", "share", "header"))])
def test_parts_of_the_article_stay_whatever_they_are_called(outer, part):
    body = f"<h1>Head</h1><p>{LONG}</p><p>{LONG}</p>{part}<p>{FOUR}</p></section></div><p>{LONG}</p>".replace("</div>" if "section" in part else "</section>", "")
    beside = f"<div class=comments><p>{LONG}</p></div><div class=advert><p>{LONG}</p></div><div class=related-posts><p>{LONG}</p></div><div class=sidebar><p>{LONG}</p></div>"
    assert main_text(page(outer.format(body) + beside)) == " ".join(["Head", LONG.strip(), LONG.strip(), FOUR, LONG.strip()])


@pytest.mark.parametrize("name", "comment comments comment-list commentlist post-comments comments-area ad ad-slot advert cookie-notice cookie-banner notice newsletter-box left-sidebar site-footer top-nav main-menu pagination promo sponsored-links related-links share-buttons social-links search-form page-widget breadcrumbs".split())
def test_surroundings_go_by_whole_names(name):
    links = "<a href=x>Other text</a> <a href=y>More of it</a>"
    assert main_text(page(f"<article><p>{LONG}</p><p>{LONG}</p><div class={name}>{links}</div></article>")) == f"{LONG.strip()} {LONG.strip()}"
    assert main_text(page(f"<div class=story><p>{LONG}</p><p>{LONG}</p></div><div class={name}><p>{FOUR}</p></div>")) == f"{LONG.strip()} {LONG.strip()}"


def test_labels_and_formulas_in_paragraphs_stay():
    assert main_text(page(f"<article><p>{LONG}</p><p>A <label>word</label> and <math><mi>x</mi><mo>=</mo><mn>1</mn></math> here, in a line.</p></article>")) == f"{LONG.strip()} A word and x=1 here, in a line."


def test_pages(spark):
    rows = [(1, "u", page(f"<article><p>{LONG}</p></article>"), "x"), (1, "u", None, "x"), (None, None, "", "x"), (2, "v", "<p>" * 3000 + "deep", "x")]
    out = extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(r.n_chars for r in out.collect()) == [0, 0, 4, len(LONG.strip())]
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# --- vectors ----------------------------------------------------------------------------------------------------------------


def vector_rows(rng, n=400, d=16):
    v = rng.standard_normal((n, d))
    v[50:60] = v[40]
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    rows += [(20, v[3].tolist()), (500, None), (520, [0.0] * d), (540, [float("nan")] * d), (560, [None] * d), (580, [1.0, 2.0]), (600, []), (None, v[2].tolist()), (-20, v[5].tolist()), (640, [float("inf")] * d)]
    return rows


def brute_neighbours(rows, measure, zero, k=20):
    d = Counter(len(v) for _, v in rows if v).most_common(1)[0][0]
    fine = [(i, np.array(v)) for i, v in rows if i is not None and v and len(v) == d and all(x is not None and np.isfinite(x) for x in v) and (zero or any(v))]
    out = []
    for a, (q, x) in enumerate(fine):
        if q % 20 == 0:
            scored = sorted((-measure(x, y), i) for b, (i, y) in enumerate(fine) if a != b)[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)]
    return sorted(out)


def test_one_bit_codes(spark):
    rows = vector_rows(np.random.default_rng(12))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit(1))
    got = sorted(map(tuple, vectors.search(df).collect()))
    want = brute_neighbours(rows, lambda x, y: float((x * y).sum()), zero=False)
    assert [g[0:2] for g in got] == [w[0:2] for w in want]
    near = {(q, i) for q, _, i, _ in want}
    assert len({(g[0], g[2]) for g in got} & near) >= 0.99 * len(near)
    assert vectors.search(df.limit(0)).count() == 0
    assert vectors.search(df.where("vec_id in (0, 1)")).count() == 1


def test_voronoi_join(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 50)
    monkeypatch.setattr(vectors, "QUERIES", 7)
    monkeypatch.setattr(vectors, "RUN", 2)
    rows = vector_rows(np.random.default_rng(13))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cell", F.lit(1))
    got = sorted(map(tuple, vectors.voronoi_join(df).collect()))
    assert got == brute_neighbours(rows, lambda x, y: int((np.floor(64 * x) * np.floor(64 * y)).sum()), zero=True)
    assert vectors.voronoi_join(df.limit(0)).count() == 0
    assert vectors.voronoi_join(df.where("vec_id % 20 != 0")).count() == 0


def test_voronoi_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{DATA}/embeddings.parquet'")
    want = sorted(con.sql(oracle_sql()["op7_voronoi_knn"]).fetchall())
    assert sorted(map(tuple, queries()["op7_voronoi_knn"](spark, DATA).collect())) == want


# --- quality ----------------------------------------------------------------------------------------------------------------


def test_trees_learn():
    rng = np.random.default_rng(14)
    x = rng.uniform(size=(2000, 5))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    model = quality.fit(x[:1500], y[:1500])
    assert ((model.score(x[1500:]) >= 0.5) == y[1500:]).mean() > 0.95
    assert quality.fit(x[:0], y[:0]).score(x[:3]).tolist() == [0.5] * 3
    assert quality.fit(x[:9], np.ones(9)).score(x[:1])[0] > 0.9


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.classify(docs, quality.train(docs, labels)).where(quality.fold(F.col("doc_id")) == 1).join(labels, "doc_id")
    right = scored.select(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0]
    assert right > 0.98


def test_classify_odd_rows(spark, docs, odd_rows):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None), (9, 0), (12, 1)], "doc_id long, quality int")
    model = quality.train(docs(odd_rows), labels)
    out = quality.classify(docs(odd_rows), model).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(i) for i, _ in odd_rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    assert quality.classify(docs([]), quality.train(docs([]), labels.limit(0))).count() == 0


def test_folds(spark):
    rows = spark.range(50).select("id", quality.fold(F.col("id")).alias("f")).collect()
    assert [r.f for r in rows] == [zlib.crc32(str(r.id).encode()) % 3 for r in rows]


# --- pipeline ---------------------------------------------------------------------------------------------------------------


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{DATA}/documents.parquet").withColumns({"row": F.lit(1), "score": F.lit(2), "kept": F.lit("k"), "_id": F.lit(3), "tid": F.lit("t")})
    for n, (_, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, docs, DATA)
        if n < 3:
            assert out.columns == docs.columns
        out.write.parquet(path := str(tmp_path / f"stage{n}"))
        before = docs.select("doc_id", "text").collect()
        docs = spark.read.parquet(path)
        after = docs.collect()
        if n == 0:
            model = quality.train(spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet"))
            assert {r.doc_id for r in after} == {r.doc_id for r in before if model.score(quality.matrix([r.text]))[0] >= 0.5}
        if n == 1:
            assert sorted(r.doc_id for r in after) == sorted({c for _, c, _ in brute_classes([tuple(r) for r in before])})
        if n == 2:
            size = {r.doc_id: len((r.text or "").encode()) for r in before}
            want = {i: size[i] - sum(z - a for a, z in runs) for i, runs in brute_passages([tuple(r) for r in before], 200, 50, 400)}
            assert {r.doc_id for r in after} == set(want)
            assert all(len(r.text.encode()) <= want[r.doc_id] and len(r.text.encode()) >= want[r.doc_id] - 8 for r in after)
            assert all(r.n_chars == len(r.text) for r in after if r.text is not None)
        if n == 3:
            assert docs.groupBy("doc_id").agg((F.sum("length") == F.first("doc_tokens")).alias("all")).where("not all").count() == 0


def test_pipeline_keeps_one_of_repeated_rows(spark, docs):
    import corpus_pipeline as pipeline

    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (None, "n m"), (None, "n m"), (2, None), (3, "")]
    out = pipeline.near_dedup(spark, docs(rows), DATA)
    assert sorted((str(r.doc_id), r.text or "") for r in out.collect()) == [("1", "a b c d e f g"), ("2", ""), ("None", "n m")]
    assert pipeline.repeats(spark, docs(rows), DATA).count() == 6


def test_registry():
    names = list(queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 11)]
    assert set(oracle_sql()) <= set(names)

"""Vector codes, the overlap join and the Merkle manifest against plain versions, and defined results of odd input."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltloom.llm import merkle, overlap, vafile
from voltloom.llm.queries import queries

from .conftest import CLASHES, prose

# --- vector codes -----------------------------------------------------------------------------------------------------------


def plain_codes(rows, rounds=vafile.ROUNDS):
    """rows: (id, vector, label) of one length. Codes and codebooks by loops over integers."""
    ints = [[int(np.floor(np.float64(x) * 4096)) for x in v] for _, v, _ in rows]
    w = len(ints[0]) // 8
    part = [[v[p * w : (p + 1) * w] for p in range(8)] for v in ints]
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, ints[i]))[:16]
    books = [[list(part[i][p]) for i in first] for p in range(8)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(8):
            mine = [near(v[p], books[p])[1] for v in part]
            for k in range(len(first)):
                own = [v[p] for v, m in zip(part, mine, strict=True) if m == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    best = [[near(v[p], books[p]) for p in range(8)] for v in part]
    error = [sum(d for d, _ in b) for b in best]
    sums = {}
    for (_, _, label), e in zip(rows, error, strict=True):
        sums[label] = sums.get(label, 0) + e
    out = [(i, "".join(f"{k:02x}" for _, k in b), e, sums[label]) for (i, _, label), b, e in zip(rows, best, error, strict=True)]
    return sorted(out, key=str), books


VECTORS = "vec_id long, embedding array<float>, label int, id string, vec int, code string, error string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1, "y", "z") for i, v, label in rows], VECTORS)


def coded(df, **more):
    out, books = vafile.compress(df, **more)
    return sorted([tuple(r) for r in out.select("vec_id", "code", "error", "label_error").collect()], key=str), books


def test_codes_are_those_of_plain_loops(spark):
    rng = np.random.default_rng(11)
    rows = [(int(i), rng.normal(i % 3, 1, 16).astype(np.float32).tolist(), [None, 1, 2, 3][i % 4]) for i in rng.permutation(90)]
    rows += [rows[0], (rows[1][0], rows[2][1], 7), (None, rows[3][1], 1)]
    fine = list(rows)
    rows += [(500, None, 1), (501, [1.0] * 15 + [None], 1), (502, [float("nan")] * 16, 1), (503, [float("inf")] * 16, 1), (504, [], 1), (505, [1.0] * 8, 1)]
    got, books = coded(vectors(spark, rows))
    want, plain = plain_codes(fine)
    assert got == want
    assert books.tolist() == plain


def test_few_vectors_odd_lengths_and_large_components(spark):
    few = [(3, [1.0] * 8, None), (1, [-1.0] * 8, None), (1, [-2.0] * 8, 4)]
    assert coded(vectors(spark, few))[0] == plain_codes(few)[0]
    got, books = coded(vectors(spark, [(1, [1.0, 2.0, 3.0], 1), (2, [3.0, 2.0, 1.0], 1)]))
    assert books.shape == (8, 2, 1) and [r[2] for r in got] == [0, 0]
    huge = [(i, [float(10.0 ** (30 * i))] * 8, 1) for i in range(3)]
    assert [r[1] for r in coded(vectors(spark, [(i, [x if x < 1e38 else 3e38 for x in v], e) for i, v, e in huge]))[0]] == ["00" * 8, "01" * 8, "01" * 8]
    assert coded(vectors(spark, []))[0] == []


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(1)
    book = rng.integers(-4000, 4000, (16, 8))
    x = book[rng.integers(0, 16, 500)] + rng.integers(-300, 300, (500, 8))
    cells = vafile.Cells(book)
    least, most = cells.bounds(x)
    exact = ((x[:, None] - book[None]) ** 2).sum(2)
    assert (least <= exact).all() and (exact <= most).all()
    best, error, taken = cells.nearest(x)
    assert (best == exact.argmin(1)).all() and (error == exact.min(1)).all()
    assert taken < 0.3 * exact.size


def test_hot_and_rare_labels_get_their_sums(spark, monkeypatch):
    monkeypatch.setattr(vafile, "SHARES", 4)
    rows = [(i, None if i % 3 == 0 else i if i % 3 == 1 else -1, i) for i in range(60)]
    got = vafile.with_label_sums(spark.createDataFrame(rows, "id long, label int, error long")).collect()
    sums = {}
    for _, label, e in rows:
        sums[label] = sums.get(label, 0) + e
    assert sorted(r.id for r in got) == list(range(60)) and all(r.label_error == sums[r.label] for r in got)


# --- overlap join -----------------------------------------------------------------------------------------------------------


def plain_components(rows):
    def grams(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        return frozenset(tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))) if w else frozenset()

    sets = [grams(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                root[top(i)] = top(j)
    ids = {}
    for i, (doc, _) in enumerate(rows):
        ids.setdefault(top(i), []).append(doc)
    first = lambda i: rows[i][0] if not sets[i] else min((x for x in ids[top(i)] if x is not None), default=None)
    return sorted([(doc, len(sets[i]), first(i)) for i, (doc, _) in enumerate(rows)], key=str)


def joined(df):
    return sorted([tuple(r) for r in overlap.overlap_join(df).collect()], key=str)


def test_odd_rows_link_as_defined(docs, odd_rows):
    rows = [*odd_rows, (20, "A b\x0bC"), (21, "a B\x1fc"), (22, "a b c"), (23, "É x y z"), (24, "é x y z"), (25, "a\x00 b c d"), (26, "a b c d")]
    assert joined(docs(rows)) == plain_components(rows)


def test_links_at_the_border(docs):
    """Sets of 20 and 17 n-grams, all shared, link (85 hundredths); with 16 they don't."""
    words = [f"w{i}" for i in range(23)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:20])), (3, " ".join(words[:19]))]
    got = joined(docs(rows))
    assert got == plain_components(rows) and [r[2] for r in got] == [1, 1, 1]  # 3 links with 2
    assert [r[2] for r in joined(docs([rows[0], rows[2]]))] == [1, 3]


@pytest.mark.parametrize("small, side", [(64, 1024), (2, 8), (1, 3)])
def test_components_are_those_of_all_pairs(docs, monkeypatch, small, side):
    """Families of near copies around the border, passages that all share, columns of every size."""
    monkeypatch.setattr(overlap, "SMALL", small)
    monkeypatch.setattr(overlap, "SIDE", side)
    monkeypatch.setattr(overlap, "AHEAD", 2)
    monkeypatch.setattr(overlap, "PARTNERS", 1)
    rng = np.random.default_rng(12)
    rows, shared = [], prose(rng, 1, 40)[0]
    for base in prose(rng, 5, 60):
        words = base.split()
        for _ in range(14):
            w = list(words)
            for _ in range(int(rng.integers(0, 4))):
                w[int(rng.integers(len(w)))] = f"x{rng.integers(50)}"
            rows.append((len(rows), " ".join(w[: len(w) - int(rng.integers(0, 8))])))
    rows += [(len(rows) + i, shared + " " + t) for i, t in enumerate(prose(rng, 12, 14))]
    want = plain_components(rows)
    assert len({r[2] for r in want}) < len(rows)
    assert joined(docs(rows)) == want


def test_products_count_shared_columns(monkeypatch):
    monkeypatch.setattr(overlap, "COLUMNS", 3)
    rng = np.random.default_rng(2)
    a, b = rng.random((5, 20)) < 0.4, rng.random((7, 20)) < 0.4
    (r, g), (s, h) = np.nonzero(a), np.nonzero(b)
    assert (overlap.multiply((g, h), (r, s), (5, 7)) == a.astype(int) @ b.T.astype(int)).all()


def test_empty_table_joins_to_nothing(docs):
    assert joined(docs([])) == []


# --- Merkle manifest --------------------------------------------------------------------------------------------------------


def H(s):
    return hashlib.sha256(s.encode()).hexdigest()


def plain_manifest(rows):
    """rows: Row with the fields of a leaf."""

    def leaf(*fields):
        return H("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in fields))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([H("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
        return out

    def path(tree, i):
        out = []
        for nodes in tree[:-1]:
            at = i // 3 * 3
            out.append(("".join(nodes[at:i]), "".join(nodes[i + 1 : at + 3])))
            i //= 3
        return out

    groups = {}
    for r in rows:
        text = r.text
        if text is not None and r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0:
            text = text.replace("\n", "")
        own = leaf(r.doc_id, r.source, r.lang, r.n_chars, r.text)
        groups.setdefault(r.source, []).append((r.doc_id is not None, r.doc_id or 0, own, leaf(r.doc_id, r.source, r.lang, r.n_chars, text), r.doc_id))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([x[2] for x in sorted(groups[g])]) for g in names}
    top = levels([trees[g][-1][0] for g in names]) if names else []
    out = []
    for i, g in enumerate(names):
        for j, (_, _, own, now, doc) in enumerate(sorted(groups[g])):
            steps = path(trees[g], j) + path(top, i)
            h = now
            for left, right in steps:
                h = H(left + h + right)
            out.append((doc, own, trees[g][-1][0], top[-1][0], H("".join(a + b for a, b in steps)), h, h == top[-1][0]))
    return sorted(out, key=str)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, s long, pos long, n string, h string, bucket int"


def sourced(spark, sizes, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for source, n in sizes:
        rows += [(len(rows) + i, f"text {i}\n{rng.integers(9)}" if i % 5 else None, "en" if i % 3 else None, source, i, 1, 2, "n", "h", 3) for i in range(n)]
    return spark.createDataFrame([rows[i] for i in rng.permutation(len(rows))], SCHEMA)


def proved(df, **more):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    found = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    out = merkle.manifest(df, found=found, **more)
    return sorted([tuple(r) for r in out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()], key=str)


@pytest.mark.parametrize("depth", [1, 2, 8])
def test_trees_are_those_of_plain_loops(spark, depth):
    """Groups of one, two and three leaves, of a bucket and of several, so that rounds end at different heights."""
    df = sourced(spark, [("b", 1), ("a", 2), (None, 3), ("é", 4), ("", 9), ("z", 10), ("hot", 91), ("B", 28)])
    got = proved(df, depth=depth)
    assert got == plain_manifest(df.collect())
    assert 0 < sum(r[-1] for r in got) < len(got)


@pytest.mark.parametrize("sizes", [[("one", 1)], [("one", 5)], [("one", 1), ("two", 1)], [(f"s{i}", 1) for i in range(11)], []])
def test_few_groups_and_leaves(spark, sizes):
    df = sourced(spark, sizes)
    assert proved(df, depth=1) == plain_manifest(df.collect())


def test_odd_rows_are_proved(docs, odd_rows):
    df = docs(odd_rows)
    got = proved(df)
    assert got == plain_manifest(df.collect()) and len(got) == len(odd_rows)
    assert set(CLASHES) <= set(df.columns)


def test_batches_keep_buckets_whole(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(merkle, "BATCH", 5)
    s, b = [0] * 7 + [1] * 9, [0, 0, 0, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0, 1, 1]
    batches = [pa.record_batch({"s": s[i : i + 3], "bucket": b[i : i + 3]}) for i in range(0, 16, 3)]
    parts = list(merkle._buckets(iter(batches)))
    assert sum(map(len, parts)) == 16
    seen = [set(zip(p["s"].to_pylist(), p["bucket"].to_pylist(), strict=True)) for p in parts]
    assert sum(map(len, seen)) == len(set().union(*seen)) == 4


def test_queries_give_the_contracts_columns(spark):
    want = {"op11_vector_codes": ["vec_id", "code", "error", "label_error", "codebooks_sha256"], "op12_overlap_join": ["doc_id", "n_shingles", "component_id"], "op13_merkle": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]}
    assert all(queries()[name](spark, "/root/testdata/sf0.001").columns == columns for name, columns in want.items())

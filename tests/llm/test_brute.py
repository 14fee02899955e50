"""Operators held against independent plain versions on small tables."""

import html
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from voltloom.llm import neardup, packing, quality, vectors
from voltloom.llm.html_text import main_text
from voltloom.llm.queries import tokenizer

from .conftest import prose

SMALL = "/root/testdata/sf0.01"


# --- packing ----------------------------------------------------------------------------------------------------------------


def test_the_layout_does_not_depend_on_tasks(spark, docs):
    rng = np.random.default_rng(31)
    rows = [(i, t) for i, t in enumerate(prose(rng, 150, 80) + prose(rng, 2, 9000))] + [(3, None), (None, "a b"), (400, ""), (401, "")]
    layouts = []
    for n in (1, 5):
        got = packing.pack(docs(rows).repartition(n), tokenizer("word_bpe_49k.json"), capacity=256)
        layouts.append(sorted(((r.doc_id, r.start, r.length, r.sequence_id, r.offset) for r in got.collect()), key=str))
    assert layouts[0] == layouts[1]


def test_copies_of_a_row_spread_over_blocks(spark, docs, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 20)
    got = packing.pack(docs([(7, "the same words")] * 400).coalesce(1), tokenizer("word_bpe_49k.json"))
    per = Counter(r.sequence_id >> packing.LOCAL_BITS for r in got.collect())
    assert len(per) == 20 and max(per.values()) < 60


# --- main text --------------------------------------------------------------------------------------------------------------

GONE = re.compile(r"<!--.*?-->|<(script|style|aside|nav|footer|form|noscript|select|button|iframe)\b.*?</\1\s*>", re.S | re.I)
INLINE = {"a", "abbr", "b", "bdi", "bdo", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "mark", "q", "s", "samp", "small", "span", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}


def plain_article(page):
    """What lies between the tags of a page's one article: no tree, no scores."""
    body = re.search(r"<article[^>]*>(.*)</article>", page, re.S)[1]
    body = GONE.sub("", body)
    body = re.sub(r"</?([a-zA-Z][a-zA-Z0-9]*)[^>]*>", lambda m: "" if m[1].lower() in INLINE else " ", body)
    return " ".join(html.unescape(body).split())


def test_main_text_of_all_pages():
    import duckdb

    pages = duckdb.sql(f"select html from '{SMALL}/pages.parquet' where html is not null").fetchall()
    one = [h for (h,) in pages if len(re.findall(r"<article\b", h)) == 1 and "</article>" in h]
    assert len(one) > 0.8 * len(pages)
    assert sum(main_text(h) != plain_article(h) for h in one) == 0
    assert all(main_text(h) for (h,) in pages)


@pytest.mark.parametrize("name", ["layout has-sidebar", "page menu-open", "content with-share", "post no-comments", "related-off wrapper", "cookie-banner-page"])
@pytest.mark.parametrize("tag", ["div", "section", "form"])
def test_wrappers_keep_the_article(name, tag):
    text = "This is a sentence, with commas, of some length that reads like prose."
    paragraphs = f"<p>{text}</p>" * 5
    for body in (f"<article>{paragraphs}</article>", f"<div>{paragraphs}</div>"):
        got = main_text(f"<html><body><{tag} class='{name}'>{body}</{tag}><footer>f</footer></body></html>")
        assert got == " ".join([text] * 5)


def test_reader_comments_are_not_the_main_text():
    text = "This is a sentence, with commas, of some length that reads like prose."
    comments = "".join(f"<div class=comment><p>Reader {i}: {text}</p></div>" for i in range(40))
    assert main_text(f"<body><div class=story><p>{text}</p><p>{text}</p></div><div id=comments>{comments}</div></body>") == f"{text} {text}"


@pytest.mark.parametrize("piece", ["<div>ab", "<li>x<div>", "<p><b>a", "<table><tr><td>a", "<span>a", "<div class=comment>a", "<div class=related>a", "<a href=x>", "</div>"])
def test_deep_pages_take_linear_time(piece):
    from time import process_time

    times = []
    for n in (20_000, 80_000):
        began = process_time()
        main_text(piece * n)
        times.append(process_time() - began)
    assert times[1] < 8 * times[0] + 1


# --- quality ----------------------------------------------------------------------------------------------------------------


def test_trees_against_loops():
    rng = np.random.default_rng(32)
    x = rng.normal(size=(300, 4)).round(1)
    y = (x[:, 1] + 0.5 * x[:, 2] + rng.normal(0, 0.3, 300) > 0).astype(float)
    model = quality.fit(x, y, trees=7, depth=3)

    def walk(row):
        total = model.base
        for root in model.roots:
            node = int(root)
            while model.child[node] != node:
                node = int(model.child[node]) + int(row[model.feature[node]] > model.threshold[node])
            total += model.value[node]
        return 1 / (1 + np.exp(-total))

    assert model.score(x) == pytest.approx([walk(r) for r in x])
    # the first split is the best of all
    p = y.mean()
    g, h = p - y, np.full(len(y), p * (1 - p))
    gain = lambda m: g[m].sum() ** 2 / (h[m].sum() + quality.LAMBDA)
    best = []
    for f in range(4):
        for cut in np.unique(np.quantile(x[:, f], np.linspace(0, 1, quality.BINS + 1)[1:-1])):
            low = x[:, f] <= cut
            if min(h[low].sum(), h[~low].sum()) >= quality.MIN_HESSIAN:
                best.append((gain(low) + gain(~low), f, cut))
    root = int(model.roots[0])
    top = max(best)[0]
    low = x[:, model.feature[root]] <= model.threshold[root]
    assert gain(low) + gain(~low) == pytest.approx(top, rel=1e-3)


# --- near duplicates --------------------------------------------------------------------------------------------------------


def plain_classes(texts, similar=0.8, damp=0.1):
    """Classes by all pairs: shingles as strings, counts in dictionaries, frequencies of shingles themselves."""
    def words(t):
        w = (t or "").lower().split()
        return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()

    every = [words(t) for t in texts]
    seen = Counter(s for c in every for s in c)
    weigh = {s: 1 + damp * min(1, np.log1p(len(texts) / k) / np.log1p(512)) for s, k in seen.items()}
    bags = [{s: k * weigh[s] for s, k in c.items()} for c in every]
    have = defaultdict(list)
    for i, b in enumerate(bags):
        for s in b:
            have[s].append(i)
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    size = [sum(b.values()) for b in bags]
    border = set()
    for i, b in enumerate(bags):
        low = Counter()
        for s, w in b.items():
            for j in have[s]:
                if j < i:
                    low[j] += min(w, bags[j][s])
        for j, m in low.items():
            alike = m / (size[i] + size[j] - m)
            if abs(alike - similar) < 0.01:
                border.add((j, i))
            if alike >= similar:
                root[max(top(i), top(j))] = min(top(i), top(j))
    first = {}
    for i, t in enumerate(texts):  # equal texts, empty ones too
        root[top(i)] = root[top(first.setdefault(t or "", i))]
    return [top(i) for i in range(len(texts))], border


@pytest.mark.parametrize("block", [256, 16])
def test_links_against_all_pairs(spark, monkeypatch, block):
    """Of all pairs that plain code puts into one class, on the whole table, also where buckets are dealt into blocks."""
    monkeypatch.setattr(neardup, "BLOCK", block)
    monkeypatch.setattr(neardup, "HUBS", 2)
    monkeypatch.setattr(neardup, "SIDE", 32)
    df = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in df.orderBy("doc_id").collect()]
    rng = np.random.default_rng(33)
    template = prose(rng, 1, 200)[0].split()  # texts that share most of a template, so that buckets are large
    for i in range(120):
        own = [f"own{i}x{k}" for k in range(45)]
        rows.append((10_000 + 2 * i, " ".join(template + own)))
        if i % 4 == 0:
            rows.append((10_001 + 2 * i, " ".join(template + own[:25] + [f"new{i}x{k}" for k in range(20)])))
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    root, border = plain_classes([t for _, t in rows])
    want = {i: rows[r][0] for (i, _), r in zip(rows, root, strict=True)}
    mates = defaultdict(list)
    for i, c in want.items():
        mates[c].append(i)
    pairs = [(c, i) for c, m in mates.items() for i in m if i != c]
    assert len(pairs) > 100
    kept = sum(got[a] == got[b] for a, b in pairs)
    assert kept >= 0.99 * len(pairs)
    # nothing else is joined, except by pairs within a hundredth of the threshold, where hashed counters round weights
    near = {frozenset((rows[a][0], rows[b][0])) for a, b in border}
    wrong = [i for i in got if want[i] != want[got[i]] and not near]
    assert not wrong


# --- vectors ----------------------------------------------------------------------------------------------------------------


def test_estimates_stay_within_their_errors():
    rng = np.random.default_rng(34)
    for d in (8, 64, 100):
        vec, q = rng.standard_normal((500, d)) * rng.uniform(0.1, 5, (500, 1)), rng.standard_normal((70, d))
        turn = vectors.rotation(d)
        words, scale, error = vectors.encode(vec, turn)
        assert words.nbytes == 500 * 8 * -(-d // 64)
        asked = vectors.Asked(q, turn)
        ones = np.bitwise_count(words).sum(1, dtype=np.float32)
        got, wide = asked.estimate(slice(0, 70), words, ones, scale, error)
        q /= np.sqrt((q * q).sum(1))[:, None]
        off = np.abs(got - q @ vec.T) / wide
        assert (off > 1).mean() < 0.01 and (off > 1 / vectors.SIGMAS).mean() > 0.1
        # the bits say the same as signs multiplied out
        signs = np.where(vec @ turn > 0, 1.0, -1.0)
        assert got == pytest.approx((q @ turn @ signs.T) * scale, abs=float(5 * (asked.rounding[:, None] * scale).max()))


def test_very_large_and_small_vectors(spark):
    rng = np.random.default_rng(36)
    base = rng.normal(size=(200, 16))
    for size in (1e-140, 1e-30, 1e30, 1e150):
        data = [(i, (v * size).tolist()) for i, v in enumerate(base)]
        got = vectors.search(spark.createDataFrame(data, "vec_id long, embedding array<double>"), k=5).collect()
        score = base @ base.T
        want = {(i, j) for i in range(0, 200, 20) for j in sorted(range(200), key=lambda j: (-score[i, j], j) if j != i else (9e9, 0))[:5]}  # noqa: B023
        assert len({(r.query_id, r.vec_id) for r in got} & want) >= 0.98 * len(want)


def test_pivots_and_pruning(spark, monkeypatch):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = df.selectExpr("vec_id rid", "transform(embedding, x -> cast(floor(64 * cast(x as double)) as double)) vec").where("embedding is not null")
    n = rows.count()
    assert vectors.FEWEST <= len(vectors.choose_pivots(rows, n, 1e6)) <= vectors.PIVOTS
    # clusters far from each other: most pairs of queries and cells are never compared
    rng = np.random.default_rng(35)
    centre = rng.normal(size=(12, 8)) * 40
    data = [(i, (centre[i % 12] + rng.normal(0, 0.5, 8)).tolist()) for i in range(600)]
    calls = []
    own = vectors.Group.within
    monkeypatch.setattr(vectors.Group, "within", lambda self, best, cell, far: calls.append((len(self.q), len(x := own(self, best, cell, far)), len(far))) or x)
    frame = [(i, np.floor(64 * np.array(v))) for i, v in data]
    ids, vec = np.array([i for i, _ in frame]), np.stack([v for _, v in frame])
    top = float((vec * vec).sum(1).max())
    full = vectors._augmented(vec, top)
    pivots = full[rng.permutation(600)[:24]]
    q = vec[ids % 20 == 0]
    far = vectors._distances(full, pivots)
    cell = far.argmin(1)
    bounds = np.array([(c, x) for c in range(24) for x in np.sort(far[cell == c, c])[:21]])
    group = vectors.Group(q, 20, pivots, bounds, 1e-6 * top**0.5)
    best = vectors.Best(len(q), 20, int)
    open_ = sum(len(group.within(best, c, np.sort(far[cell == c, c]))) * int((cell == c).sum()) for c in range(24))
    assert open_ < 0.5 * len(q) * 600
    got = sorted(map(tuple, vectors.voronoi_join(spark.createDataFrame(data, "vec_id long, embedding array<double>")).collect()))
    score = (vec[ids % 20 == 0] @ vec.T).astype(int)
    want = []
    for i, s in zip(ids[ids % 20 == 0], score, strict=True):
        near = sorted((-x, j) for j, x in zip(ids.tolist(), s.tolist(), strict=True) if j != i)[:20]
        want += [(int(i), r, j, -x) for r, (x, j) in enumerate(near, 1)]
    assert got == sorted(want)


# --- sharding ---------------------------------------------------------------------------------------------------------------


def test_few_edges_are_cut(spark, docs):
    """Edges between equal texts that shards cut, against plain counting and dealing at random; sizes against their mean."""
    from voltloom.llm import sharding

    rng = np.random.default_rng(38)
    texts = prose(rng, 400, 50)
    for i in range(60):
        texts += [texts[i]] * int(rng.integers(1, 6))
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.shard, r.size) for r in sharding.shard(docs(rows).repartition(3), 8).collect()}
    same = defaultdict(list)
    for i, t in rows:
        same[t].append(i)
    edges = [(a, b) for m in same.values() for a in m for b in m if a < b]
    dealt = rng.integers(0, 8, len(rows))
    cut, at_random = sum(got[a][0] != got[b][0] for a, b in edges), sum(dealt[a] != dealt[b] for a, b in edges)
    assert at_random > 0.8 * len(edges) and cut < 0.1 * len(edges)
    load = Counter()
    for shard, size in got.values():
        load[shard] += size
    mean = sum(load.values()) / 8
    assert max(abs(x - mean) for x in load.values()) < 0.05 * mean

"""The operators on vectors, ranked search and spelling against brute force, on messy tables too."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowframe.llm import queries, search, spelling, vectors

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# -- vectors


def linked(rows, threshold):
    """(n_links, component_id) of each row (id, vector) by all pairs."""
    def good(v):
        return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    n, top = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if good(v) else None for _, v in rows]
    for i in range(len(rows)):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                n[i], n[j] = n[i] + 1, n[j] + 1
                top[find(i)] = find(j)
    least = defaultdict(list)
    for i, (k, _) in enumerate(rows):
        least[find(i)].append(k)
    low = [min((k for k in least[find(i)] if k is not None), default=None) for i in range(len(rows))]
    return Counter((k, c, m, k is not None and k == m) for (k, _), c, m in zip(rows, n, low))


def cloud(seed, n, dim, groups, spread):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(groups, dim))
    centre /= np.linalg.norm(centre, axis=1, keepdims=True)
    return centre[rng.integers(0, groups, n)] + rng.normal(size=(n, dim)) * rng.choice(spread, (n, 1))


@pytest.mark.parametrize(("seed", "n", "dim", "groups", "spread", "tile", "fan", "leaf"), [(0, 300, 64, 20, [0.01, 0.06, 0.1], 16, 2, 4), (1, 300, 5, 12, [0.02, 0.3], 10, 3, 3), (2, 260, 16, 1, [0.002, 0.01], 20, 2, 8), (3, 200, 2, 40, [0.05], 8192, 16, 512), (4, 240, 30, 3, [0.0, 0.05], 7, 2, 512)])
def test_vectors_equal_all_pairs(spark, seed, n, dim, groups, spread, tile, fan, leaf):
    x = cloud(seed, n, dim, groups, spread).astype(np.float32)
    rows = [(int(i), [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [(n + i, rows[i][1]) for i in range(20)]  # equal ones
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = vectors.near_vectors(df, tile=tile, fan=fan, leaf=leaf)
    assert Counter(map(tuple, got.collect())) == linked(rows, 0.9)


def test_vectors_that_are_no_vectors_repeated_ids_and_clashing_names(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [2.0, 0.0]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [nan, 1.0]), (8, [None, 1.0]), (9, [inf, 1.0]), (10, [1e300, 1e290]), (11, [0.0, 1.0]), (None, [0.0, -1.0]), (None, None), (14, [1.0, 0.0, 0.0]), (15, [0.9, math.sqrt(0.19)]), (16, [-1.0, 0.0]), (17, [1.0]), (18, [5e-324, 0.0])]
    df = spark.createDataFrame([(*r, 1, 2, b"k", 3, 4) for r in rows], "vec_id long, embedding array<double>, row int, rep int, key binary, at int, label int")
    assert Counter(map(tuple, vectors.near_vectors(df).collect())) == linked([(k, [1.0, 0.0] if k in (10, 18) else v) for k, v in rows], 0.9 - 1e-15)  # whose squares leave the range of doubles
    assert vectors.near_vectors(df.limit(0)).collect() == []
    none = vectors.near_vectors(df.where("vec_id in (4, 5)")).collect()
    assert sorted(map(tuple, none)) == [(4, 0, 4, True), (5, 0, 5, True)]


def test_intervals_far_apart_are_skipped_and_dense_ones_linked_whole(spark):
    x = np.concatenate([np.tile([1.0, 0, 0], (60, 1)), np.tile([0, 1.0, 0], (60, 1)), np.tile([0, 0, 1.0], (60, 1))]) + np.random.default_rng(5).normal(size=(180, 3)) * 0.001
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    reps = vectors.packed(df.selectExpr("vec_id as row", "vec_id", "embedding"), "embedding").selectExpr("row as rep", "1L as mult", "dim", "vec")
    line = vectors.ordered(reps, None, "<f8", math.sqrt(0.2), 3, 3, 10)
    pairs, whole, _ = vectors.open_pairs(vectors.tiles(line, None, "<f8", 3).drop("vecs"), math.sqrt(0.2), 3)
    assert pairs.count() <= 3 * 12  # 18 tiles make 171 pairs; only mixed ones at the borders stay open
    assert sum(p.count() for _, p in whole) >= 1


# -- search


def best(docs, items, k):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))
    bags = [(i, Counter(words(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for i, b in bags:
            m = 75 + 25 * sum(b.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 12 * m)) for t in words(text) if t in b)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return Counter(out)


DOCS = [(1, None), (2, ""), (3, "... --- !!"), (4, "The cat sat on the mat"), (5, "the Cat sat"), (5, "the Cat sat"), (None, "the Cat sat"), (None, "cats and mats"), (9, "naïve café 日本語 über Straße"), (10, "a " * 30000 + "needle"), (11, "needle"), (12, "x" * 100000), (13, "The cat sat on the mat")]
DOCS += [(100 + i, f"copy of one text, the cat {'sat' if i % 2 else 'ran'}") for i in range(60)]
ITEMS = [(1, "The CAT sat, on the mat?"), (1, "needle NEEDLE needle"), (None, "café über"), (3, None), (4, ""), (5, "nowhere"), (6, "日本語 naïve a"), (7, "copy text ran " + "x" * 100000)]


@pytest.mark.parametrize(("k", "pass_terms"), [(20, 1 << 20), (3, 1 << 20), (5, 4)])
def test_search_equals_brute_force(spark, k, pass_terms):
    docs = spark.createDataFrame([(*d, "f", 1, 2) for d in DOCS], "doc_id long, text string, no string, rank int, item_id int").repartition(4)
    items = spark.createDataFrame([(*i, 1, 2) for i in ITEMS], "item_id long, text string, no int, doc_id int")
    index = search.build(docs)
    got = search.search(index, items, k, pass_terms)
    assert Counter(map(tuple, got.collect())) == best(DOCS, ITEMS, k)
    index.close()


def test_search_of_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert search.ranked(docs.limit(0), items).collect() == search.ranked(docs, items.limit(0)).collect() == []
    assert search.ranked(docs.where("doc_id < 3"), items).columns == ["item_id", "rank", "doc_id", "score"]


def test_impacts_bound_scores():
    rng = np.random.default_rng(3)
    tf, m = rng.integers(1, 10**6, 10000), rng.integers(75, 10**6, 10000)
    s = search.term_score(tf, m)
    q = -(-s // search.STEP)
    assert s.min() >= 0 and q.max() <= 255 and (q * search.STEP >= s).all() and ((q - 1) * search.STEP < s).all()


# -- spelling


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def forms(docs, drop, letters=6, occurrences=5):
    count = Counter()
    for i, t in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate(LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if drop and h % drop == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            count[w] += len(w) >= letters
    count = {w: n for w, n in count.items() if n >= occurrences and len(w) >= letters}
    one = {}
    for w, n in count.items():
        others = [x for x in count if near(w, x)]
        top = min(others, key=lambda x: (-count[x], x), default=None)
        one[w] = (top if top and count[top] >= 5 * n else None, len(others))
    out = Counter()
    for w, n in count.items():
        root = w
        while one[root][0]:
            root = one[root][0]
        out[w, one[w][0], root, n, one[w][1], count.get(one[w][0])] += 1
    return out


def spelled():
    rng = np.random.default_rng(7)
    base = ["colour", "colours", "color s", "müller", "mueller", "aaaaaa", "aaaaaaa", "aaaaaaaa", "×÷ßÿéà", "letter", "lettter", "letters", "bitter", "better", "butter", "batter", "abcdefghijk" * 30, "abcdefghijk" * 30 + "l", "übermäßig", "ubermäßig"]
    docs = []
    for i in range(400):
        words = [base[int(k)] for k in np.minimum(rng.zipf(1.3, 12), len(base)) - 1] + [str(x) for x in rng.choice(["colour", "letter", "better"], 6)]
        docs.append((None if i % 50 == 0 else i % 390, " ".join(w.upper() if i % 7 == 0 and w.isascii() else w for w in words) + ", 5x Ünd…\n"))
    return [*docs, (1, None), (2, ""), (3, "aaaaaa" * 4000 + " kurz"), (4, "ĀĀĀĀĀĀ ok")]


@pytest.mark.parametrize("drop", [None, 7, 199])
def test_spelling_equals_brute_force(spark, drop):
    docs = spelled()
    df = spark.createDataFrame([(*d, 1, "w") for d in docs], "doc_id long, text string, n int, word string").repartition(5)
    assert Counter(map(tuple, spelling.variants(df, drop_every=drop).collect())) == forms(docs, drop)


def test_spelling_chains_long_words_and_empty_tables(spark):
    long = "a" * 3000
    counts = {"abcdef": 5, "abcdefg": 25, "abcdefgh": 125, "abcdefgi": 125, "abcdefghi": 700, long: 5, long + "b": 30}
    df = spark.createDataFrame([(1, " ".join(w for w, n in counts.items() for _ in range(n)))], "doc_id long, text string")
    got = {r["word"]: r for r in spelling.variants(df).collect()}
    assert got["abcdef"]["root"] == "abcdefghi" and got["abcdefg"]["form"] == "abcdefgh" and got["abcdefgi"]["root"] == "abcdefghi"
    assert got[long]["form"] == long + "b" and got[long + "b"]["n_near"] == 1
    assert spelling.variants(df.limit(0)).collect() == []
    assert spelling.variants(df, occurrences=10**6).columns == ["word", "form", "root", "n", "n_near", "form_n"]
    with pytest.raises(ValueError):
        spelling.variants(df, ratio=1)


DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize(("name", "sql"), [(n, n) for n in ("op11_vectors", "op12_search", "op13_spelling")])
def test_query_equals_sql(spark, name, sql):
    import duckdb

    c = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        c.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, DIR), c.execute(queries.ORACLE_SQL[sql])
    cols = [x[0] for x in want.description]
    assert sorted(got.columns) == sorted(cols)
    assert Counter(map(tuple, got.select(*cols).collect())) == Counter(want.fetchall())


# -- stalls


def test_many_items_that_share_a_piece_with_many_places():
    import time

    from flowframe.llm import decontamination

    rng = np.random.default_rng(0)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 5000, n)]
    items = [(i, " ".join([*word(4), "of", "the", *word(4)])) for i in range(2000)]
    text = " ".join(f"x{i} of the" for i in range(2000)) + " " + items[7][1] + " tail " + items[9][1].replace("of the", "of a") + " end"
    held = decontamination.Items(items, 0.2)
    data = np.frombuffer(text.encode(), np.uint8)
    began = time.perf_counter()
    got = held.matches(data, np.array([0, len(data)]))
    assert time.perf_counter() - began < 1
    assert [(d, i, k) for d, i, k, _ in got] == [(0, 7, 0), (0, 9, 1)]


def test_matches_equal_a_table_of_distances(spark):
    """Repeated and tied items, items without an id or a word, repeated and null rows, against the distance by its definition."""
    from flowframe.llm import decontamination

    rng = np.random.default_rng(3)
    word = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 9, n))
    items = [(i % 40 if i % 13 else None, word(int(rng.integers(1, 16)))) for i in range(60)] + [(1, None), (2, ""), (3, "..."), (5, "a b c d e f"), (5, "a b c d e f"), (6, "a b c d e g")]
    docs = [(i % 50 if i % 11 else None, word(int(rng.integers(0, 60)))) for i in range(70)] + [(1, None), (2, ""), (3, "x a b c d e f y"), (3, "x a b c d e f y"), (4, "a b x d e g")]

    def best(p, t):
        row = [0] * (len(t) + 1)
        for i, c in enumerate(p, 1):
            new = [i]
            for j, d in enumerate(t, 1):
                new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
            row = new
        low = min(row[1:], default=len(p))
        return low, next((j for j in range(1, len(row)) if row[j] == low), None)

    want = Counter()
    for i, t in docs:
        for j, p in items:
            pattern, text = re.findall(r"[a-z0-9]+", p or ""), (t or "").split()
            if pattern and text:
                k, end = best(pattern, text)
                if k <= int(0.2 * len(pattern)):
                    want[i, j, k, end] += 1
    d = spark.createDataFrame([(*x, 1, "i") for x in docs], "doc_id long, text string, distance int, item_id string").repartition(3)
    m = spark.createDataFrame([(*x, 2) for x in items], "item_id long, text string, doc_id int")
    assert Counter(map(tuple, decontamination.matches(d, m).collect())) == want
    kept = decontamination.clean(d, m).select("doc_id", "text").collect()
    held = {(i, t) for i, t in docs if any(best(re.findall(r"[a-z0-9]+", p or ""), (t or "").split())[0] <= int(0.2 * len(re.findall(r"[a-z0-9]+", p or ""))) for _, p in items if re.findall(r"[a-z0-9]+", p or "")) and t}
    assert Counter(map(tuple, kept)) == Counter(x for x in docs if x not in held)
    few, decontamination.ITEMS_PER_PASS = decontamination.ITEMS_PER_PASS, 7
    try:
        assert Counter(map(tuple, decontamination.matches(d, m).collect())) == want
        assert Counter(map(tuple, decontamination.clean(d, m).select("doc_id", "text").collect())) == Counter(map(tuple, kept))
    finally:
        decontamination.ITEMS_PER_PASS = few


def test_many_special_tokens():
    import time

    from tokenizers import Tokenizer

    from flowframe.llm import bpe

    t, enc = Tokenizer.from_file(bpe.vocabulary_path()), bpe.encoder(bpe.vocabulary_path())
    texts = ["<|endoftext|>ab" * 32000, "", "<|endoftext|>", "a <|endoftext|><|endoftext|> b<|endoftext", "|> c", "plain", "<|endoftext|>" * 3 + "\n ü"]
    raw = [x.encode() for x in texts]
    offs = np.append(0, np.cumsum([len(x) for x in raw]))
    began = time.perf_counter()
    ids, at = enc.encode(np.frombuffer(b"".join(raw), np.uint8), offs)
    assert time.perf_counter() - began < 3
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [t.encode(x, add_special_tokens=False).ids for x in texts]


# -- flat token files


@pytest.mark.parametrize(("block", "chunk", "width"), [(1, 2, 2), (3, 1, 4), (5, 3, 2), (1 << 16, 1 << 12, 4)])
def test_files_of_odd_names_over_many_tasks(spark, tmp_path, monkeypatch, block, chunk, width):
    from flowframe.llm import token_counts

    monkeypatch.setattr(token_counts, "CHUNK", chunk)
    rng, want = np.random.default_rng(block), {}
    for name, n in (("a b#1%.bin", 60), ("plain.bin", 1), ("ü%20.bin", 37), ("only ends.bin", 9), ("no end.bin", 20), ("empty.bin", 0)):
        ids = np.zeros(n, int) if name.startswith("only") else rng.integers(1 if name.startswith("no") else 0, 6, n)
        (tmp_path / name).write_bytes(ids.astype(f"<u{width}").tobytes())
        start, out = 0, []
        for i, t in enumerate(ids.tolist()):
            if t == 0:
                out.append((len(out), start, i - start))
                start = i + 1
        want[name] = out + [(len(out), start, n - start)] * (n > start)
    blocks = token_counts.read_token_files(spark, str(tmp_path), width, block)
    assert blocks.count() == sum(-(-len((tmp_path / name).read_bytes()) // (block * width)) for name in want)
    got = {name: [] for name in want}
    for r in token_counts.scan(blocks, end=0, width=width).collect():
        got[r["file"].split("/")[-1]].append((r["ordinal"], r["start"], r["n_tokens"]))
    assert {k: sorted(v) for k, v in got.items()} == want


def test_counts_come_from_files_that_go_away(spark):
    import os

    from flowframe.llm import bpe, common, token_counts
    from tokenizers import Tokenizer

    rows = [(1, "a b c"), (1, None), (None, "<|endoftext|> x"), (None, "<|endoftext|> x"), (5, ""), (6, "word " * 3000)]
    d = spark.createDataFrame([(*r, "f", 1) for r in rows], "doc_id long, text string, file string, first int").repartition(3)
    t = Tokenizer.from_file(bpe.vocabulary_path())
    t.encode_special_tokens = True
    left = lambda: {x for x in os.listdir(common.shared_dir(spark).removeprefix("file:")) if x.startswith(("tokens-", "token-ends", "token-names"))}
    before = left()
    got = token_counts.counts(d)
    assert Counter((r["doc_id"], r["n_tokens"]) for r in got.collect()) == Counter((i, len(t.encode(x or "", add_special_tokens=False).ids)) for i, x in rows)
    assert token_counts.counts(d.limit(0)).collect() == []
    assert not [x for x in left() - before if not x.startswith("token-names")]  # an empty result reads the empty list of names


# -- near duplicates around a common passage


def test_a_common_passage_below_the_threshold_makes_no_pairs(spark):
    from flowframe.llm import minhash

    rng = np.random.default_rng(0)
    common = " ".join(f"c{i}" for i in range(200))
    own = lambda i, n: " ".join(f"d{i}_{k}" for k in range(n))
    n = 1200
    rows = [(i, own(i, int(rng.integers(26, 31))) + " " + common) for i in range(n)]
    rows += [(n + i, own(i, 12) + " " + own(n + i, 2) + " " + common) for i in range(6)]  # near to one another? the tail alone is shared
    d = spark.createDataFrame(rows, "doc_id long, text string")
    bag = minhash.elements(d)
    left = bag.select(F.col("doc_id").alias("rep"), F.size("bag").alias("size"), F.col("doc_id").alias("label"))
    pairs, _ = minhash.across(left, bag, 0.8)
    found = {(r["a"], r["b"]) for r in pairs.collect()}
    assert len(found) < 40 * n  # all pairs would be 727,000
    bags = {r["doc_id"]: set(r["bag"]) for r in bag.collect()}
    ids = sorted(bags)
    true = {(a, b) for k, a in enumerate(ids[-206:]) for b in ids[-206:][k + 1 :] if len(bags[a] & bags[b]) >= 0.8 * len(bags[a] | bags[b])}
    assert true <= found and len(true) >= 15
    assert {(r["a"], r["b"]) for r in minhash.verified(pairs, bag, 0.8).collect()} >= true

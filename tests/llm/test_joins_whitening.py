"""Operators 11 to 13 against brute-force versions, on small tables with nulls,
empty and long texts, ties, repeated rows and clashing columns."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lorem(n, seed):
    return " ".join(f"w{zlib.crc32(f'{seed}:{i}'.encode()) % 9973:x}" for i in range(n))


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


# 11 -----------------------------------------------------------------

def shingle_set(t, k):
    w = WORD.findall(lower(t))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute_components(rows, words, num, den):
    sets = [shingle_set(t, words) for _, t in rows]
    up = {i: i for i, _ in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    key = lambda x: (x is not None, x or 0)
    for i in range(len(rows)):
        for j in range(i):
            k = len(sets[i] & sets[j])
            if k and den * k >= num * len(sets[i] | sets[j]):
                a, b = sorted((root(rows[i][0]), root(rows[j][0])), key=key)
                if a != b:
                    up[b] = a
    return sorted(((i, len(s), root(i)) for (i, _), s in zip(rows, sets)), key=repr)


def copies(seed, groups=6, size=7):
    """Documents around the threshold: texts of many sizes with a few words changed, inserted or deleted."""
    r, rows = random.Random(seed), []
    common = lorem(40, "passage")
    for g in range(groups):
        base = (common + " " + lorem(r.choice([3, 9, 12, 40, 200, 700]), f"{seed}{g}")).split()
        for _ in range(size):
            w = list(base)
            for _ in range(r.randint(0, 1 + len(w) // 25)):
                at = r.randrange(len(w))
                w[at:at + r.randint(0, 1)] = [f"x{r.randint(0, 9)}"] * r.randint(0, 2)
            rows.append((len(rows), " ".join(w)))
    return rows


EDGE = [(900, None), (901, ""), (902, " \t\n "), (903, "One two"), (904, "one TWO"), (905, "one two three"), (906, "ONE two\tthree"),
        (907, lorem(9, "s")), (908, lorem(10, "s")), (909, lorem(11, "s")), (910, lorem(30000, "long")), (911, lorem(30000, "long") + " end"),
        (None, lorem(50, "null")), (912, lorem(50, "null")), (913, lorem(300, "a")), (913, lorem(300, "b")), (914, lorem(300, "a") + " q"),
        (915, lorem(300, "b") + " q"), (913, lorem(300, "c")), (916, lorem(300, "c")), (917, "\x00 é 😀 \x1c it's")]


def table(spark, rows):
    return spark.createDataFrame([(i, t, 3, "x", 1.5) for i, t in rows], "doc_id long, text string, n int, cls string, key double")


@pytest.mark.parametrize("words,num,den,rare", [(3, 90, 100, 8), (2, 80, 100, 0), (5, 95, 100, 2)])
def test_jaccard_join(spark, words, num, den, rare):
    from sparkngram.llm import jaccard_join as J
    rows = copies(f"s{words}") + EDGE
    got = J.join_documents(table(spark, rows), words, num, den, rare=rare, hubs=16)
    assert sorted((tuple(r)[:3] for r in got.collect()), key=repr) == brute_components(rows, words, num, den)


def test_jaccard_hot_group(spark):
    """A third of all rows are near copies, others hold their passage only."""
    from sparkngram.llm import jaccard_join as J
    base = lorem(100, "hot").split()
    rows = [(i, " ".join(base[:i % 97] + [f"n{i}"] + base[i % 97 + 1:])) for i in range(60)]
    rows += [(100 + i, " ".join(base[:50]) + " " + lorem(60, f"own{i}")) for i in range(60)]
    rows += [(200 + i, lorem(30, f"else{i}")) for i in range(60)]
    got = {r.doc_id: r.component_id for r in J.join_documents(table(spark, rows), hubs=16).collect()}
    assert got == {i: c for i, _, c in brute_components(rows, 3, 90, 100)}


def test_parity_bits_never_exceed_the_difference(spark):
    """Bits in which two maps differ are at most the tokens in which the sets
    differ, whichever of the two is the larger; close sets are told from others."""
    from sparkngram.llm import jaccard_join as J
    rng, rows, want = np.random.default_rng(3), [], []
    for i, n in enumerate([1, 2, 60, 127, 128, 129, 255, 257, 1000, 1030, 4096, 20000] * 4):
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        b = np.concatenate([a[rng.integers(0, n // 10 + 1):], rng.integers(0, 1 << 63, rng.integers(0, n // 10 + 1), dtype=np.uint64)])
        if rng.integers(0, 2):
            a, b = b, a
        owner = np.repeat([0, 1], [len(a), len(b)])
        bounds, words = J.parity_bits(owner, np.concatenate([a, b]), 2)
        maps = [[int(x) for x in words[s:e].view(np.int64)] for s, e in zip(bounds[:-1], bounds[1:])]
        assert all(64 * len(m) >= 2 * k and len(m) & len(m) - 1 == 0 for m, k in zip(maps, (len(a), len(b))))
        rows.append((i, *maps))
        want.append(len(np.setxor1d(a, b)))
    df = spark.createDataFrame(rows, "i int, m array<long>, h array<long>").selectExpr("i", "struct(m as bits) as m", "struct(h as bits) as h")
    for r in df.selectExpr("i", f"{J.DIFFERENT} as d").collect():
        assert (want[r.i] + 1) // 2 - 4 <= r.d <= want[r.i] and (want[r.i] - r.d) % 2 == 0


def test_jaccard_empty_and_threshold(spark):
    from sparkngram.llm import jaccard_join as J
    assert J.join_documents(table(spark, EDGE).limit(0)).count() == 0
    with pytest.raises(ValueError):
        J.join_documents(table(spark, EDGE), numerator=70)


@pytest.mark.parametrize("num,den", [(3, 4), (80, 100), (90, 100), (95, 100), (1, 1)])
def test_prefixes_leave_a_common_key(num, den):
    """Random sets at the threshold share a key whatever the order and however tokens are called rare."""
    from sparkngram.llm.jaccard_join import index_keys, lacking
    r = np.random.default_rng(5)
    met = 0
    for _ in range(3000):
        x = r.choice(400, r.integers(2, 60), replace=False)
        y = np.union1d(np.setdiff1d(x, r.choice(x, r.integers(0, len(x) // 4 + 1), replace=False)), r.choice(400, r.integers(0, len(x) // 4 + 1)))
        k = len(np.intersect1d(x, y))
        if len(y) < 2 or den * k < num * (len(x) + len(y) - k) or set(x) == set(y):
            continue
        often = r.random(400) < r.choice([0, .3, .7, 1])
        keys = []
        for s in (np.sort(x), np.sort(y)):
            most = min(len(s), int(lacking(np.array(len(s)), num, den)[1]) + 2)
            keys.append(set(index_keys(len(s), s[:most].astype(np.int64), np.ones(most, bool), often[s[:most]], num, den).tolist()))
        assert keys[0] & keys[1]
        met += 1
    assert met > 50 or num == den


def test_span_hash_tells_built_texts_apart():
    from sparkngram.llm.common import prime_span_hash
    a = np.array([bin(i).count("1") % 2 for i in range(1 << 12)], np.uint8)
    data = np.concatenate([a, 1 - a, a]) + np.uint8(97)
    at = np.array([0, 1 << 12, 1 << 13])
    h = prime_span_hash(data, at, at + (1 << 12))
    assert h[0] == h[2] != h[1]


# 12 -----------------------------------------------------------------

def brute_variants(rows, every=199):
    count = Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = lower(w)
            h = zlib.crc32(f"{i}:{w}".encode())
            count[w[:h % len(w)] + w[h % len(w) + 1:] if i is not None and h % every == 0 else w] += 1
    n = {w: k for w, k in count.items() if len(w) >= 6 and k >= 5}

    def near(a, b):
        a, b = sorted((a, b), key=len)
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    form = {}
    close = {w: [o for o in n if near(w, o)] for w in n}
    for w in n:
        best = min(close[w], key=lambda o: (-n[o], o), default=None)
        if best and n[best] >= 5 * n[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, form.get(w), root(w), n[w], len(close[w]), n[form[w]] if w in form else None) for w in n)


def variant_rows():
    r, rows = random.Random(3), []
    words = ["banana", "letter", "ÉÉcole", "straßen", "aabbcc", "écoles", "running", "signal", "zzzzzz", "ÀÁÂÃÄÅ"]
    pool = [(w, 400) for w in words] + [("bannana", 50), ("bannanna", 8)]
    for w in words:
        for _ in range(12):
            at = r.randrange(len(w))
            v = w[:at] + r.choice(["", "x", "é", "ÿ", w[at] * 2, "ab"]) + w[at + r.randint(0, 1):]
            pool.append((v, r.choice([4, 5, 6, 30, 80, 79])))
    text = [w if r.random() < .5 else w.upper() if w.isascii() else w for w, n in pool for _ in range(n)]
    r.shuffle(text)
    for i in range(0, len(text), 50):
        rows.append((i // 50, " ".join(text[i:i + 50])))
    return rows + [(3, None), (4, ""), (5, "1234 -- ..."), (None, "banana lettér " * 20), (7, "a" * 20000), (7, "a" * 20000), (8, "×÷×÷×÷ " * 6), rows[0]]


@pytest.mark.parametrize("tile,bucket", [(2048, 8192), (3, 20)])
def test_spelling(spark, tile, bucket):
    from sparkngram.llm import spelling as S
    rows = variant_rows()
    got = S.group_variants(table(spark, rows), tile, bucket)
    want = brute_variants(rows)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert any(w[1] for w in want) and any(w[1] and w[1] != w[2] for w in want)


def test_spelling_empty(spark):
    from sparkngram.llm import spelling as S
    assert S.group_variants(table(spark, EDGE).limit(0)).collect() == []


# 13 -----------------------------------------------------------------

SCHEMA = "vec_id long, embedding array<double>, n long, x string"


def brute_whitening(rows, components=4):
    ok = [(i, v) for i, v in rows if v and None not in v and np.isfinite(v).all()]
    x = {i: [int(np.floor(256 * c)) for c in v] for i, v in ok}
    fit = np.array(sorted({tuple(v) for v in x.values()}), object)
    n, s = len(fit), fit.sum(axis=0)
    v = np.array((n * fit.T @ fit - np.outer(s, s)) / n ** 2, float)
    e, p = np.linalg.eigh(v)
    out = {}
    for i, row in x.items():
        d = sum((n * a - b) ** 2 for a, b in zip(row, s))
        y = (np.array(row, float) - np.array(s / n, float))
        for k in range(min(components, len(e))):
            out[i, k + 1] = (n, d, abs(y @ p[:, -1 - k]) / np.sqrt(e[-1 - k]), e[-1 - k] / e.sum())
    return out


def vectors(scale=1.0):
    r = np.random.default_rng(2)
    x = r.normal(size=(400, 6)) * [3, 2, 1.5, 1, .5, .2] * scale
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(1000 + i, rows[0][1]) for i in range(300)]  # one vector in many rows
    return rows


def test_whitening(spark):
    from sparkngram.llm import whitening as W
    rows = vectors()
    bad = [(2000, None), (2001, []), (2002, [1.0] * 5 + [None]), (2003, [float("nan")] * 6), (2004, [1.0] * 5 + [float("inf")]), (2005, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 5, "x") for i, v in rows + bad], SCHEMA)
    got = {(r.vec_id, r.component): r for r in W.whiten(df).collect()}
    want = brute_whitening(rows)
    assert set(got) == set(want)
    for k, (n, d, w, e) in want.items():
        r = got[k]
        assert (r.n, r.deviation) == (n, d) and abs(abs(r.whitened) - w) < 1e-9 and abs(r.explained / e - 1) < 1e-9 and r.identity_error < 1e-9
    signs = {np.sign(got[i, 1].whitened * got[0, 1].whitened) for i in range(1000, 1300)}
    assert signs == {1.0}


def test_whitening_large_entries(spark):
    from sparkngram.llm import whitening as W
    rows = vectors(1e9)
    got = {(r.vec_id, r.component): r for r in W.whiten(spark.createDataFrame([(i, v, 5, "x") for i, v in rows], SCHEMA)).collect()}
    for k, (n, d, w, e) in brute_whitening(rows).items():
        assert got[k].deviation == (d if d < 1 << 63 else None) and abs(abs(got[k].whitened) - w) < 1e-6


def test_whitening_degenerate(spark):
    from sparkngram.llm import whitening as W
    df = spark.createDataFrame([(i, v, 5, "x") for i, v in vectors()], SCHEMA)
    assert W.whiten(df.limit(0)).count() == 0
    assert W.whiten(df.where("vec_id >= 1000")).count() == 0  # one distinct vector has no component
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0, 1e300], 5, "x") for i in range(9)] + [(None, [1.0, 2.0, 0.0, 1e300], 5, "x")], SCHEMA)
    got = W.whiten(line).collect()
    assert {r.component for r in got} == {1} and len(got) == 10 and abs(got[0].explained - 1) < 1e-9


def test_bit_sliced_products_exact():
    from sparkngram.llm.whitening import scatter
    r = np.random.default_rng(1)
    for high in (1, 2, 500, 1 << 33, 1 << 60):
        x = r.integers(-high, high + 1, (130, 5))
        n, s, c = scatter(x)
        o = x.astype(object)
        assert n == 130 and (s == o.sum(axis=0)).all() and (np.triu(c) == np.triu(o.T @ o)).all()


# 4: pieces whose hashes collide --------------------------------------

def test_bpe_tells_colliding_pieces_apart(spark):
    """Two pieces that a polynomial hash modulo 2**64 can't tell apart, in one text and one after the other on a worker."""
    import base64
    import hashlib

    import public_tokenizers
    import tiktoken
    from sparkngram.llm import bpe
    with open(public_tokenizers.path(bpe.VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}
    tik = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    bits = [bin(i).count("1") % 2 for i in range(1024)]
    a, b = ("".join("ab"[x ^ flip] for x in bits) for flip in (0, 1))
    texts = [a, b, f"{a}\n{b}", f"{b} {a} {b}", "x" * 70 + a[:60] + " " + b[:60], a[:64], b[:64]]
    codec = bpe.Codec(public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.PATTERN)
    for t in [*texts, *texts]:
        assert codec.encode(t) == tik.encode(t, disallowed_special=()) and codec.decode(codec.encode(t)).decode() == t
    # remembered pieces whose hash meets another's are compared, too
    codec.hashes[:] = 7
    span_hash, bpe.span_hash = bpe.span_hash, lambda h, s, e: np.full(len(s), 7, np.uint64)
    try:
        for t in [*texts, "some words more", "words"]:
            assert codec.encode(t) == tik.encode(t, disallowed_special=())
    finally:
        bpe.span_hash = span_hash
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.ids_sha256 for r in bpe.round_trip_digests(docs).collect()}
    assert got == {i: hashlib.sha256(" ".join(map(str, tik.encode(t, disallowed_special=()))).encode()).hexdigest() for i, t in enumerate(texts)}


def test_a_cut_lets_go_of_the_shuffle_files_behind_it(spark):
    """Of many steps in a row, those behind the last cuts leave no files."""
    import time

    from sparkngram.llm.common import cut
    store = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: store.getAllFiles().mkString("|").count("shuffle_")
    df = spark.range(1000)
    cut(df)
    time.sleep(1)
    before = files()
    for k in range(1, 9):
        df = cut(df.groupBy((df.id % (1000 - k)).alias("id")).count().select("id").repartition(16))
    for _ in range(20):
        time.sleep(0.3)
        if files() <= before + 200:
            break
    assert files() <= before + 200


def test_what_the_driver_sends_and_holds_stays_small(spark):
    """A filter of many ids is sent as bits, the counts of the order once, and
    the driver hands memory back at each cut."""
    from sparkngram import session
    from sparkngram.llm import jaccard_join as J
    from sparkngram.llm import neardup as ND
    rows = spark.range(200_000)
    kept = ND._spared(rows, "id", rows.where("id % 4 = 0").withColumnRenamed("id", "node"))
    assert "_words" in kept._jdf.queryExecution().optimizedPlan().toString()
    got = {r.id for r in kept.collect()}
    assert set(range(0, 200_000, 4)) <= got and len(got) < 55_000
    order = J.Order(np.arange(8, dtype=np.int64).reshape(2, 4))
    sent = order.shared(rows)
    assert order.shared(rows) is sent and sent.value.sum() == 28
    order.release()
    assert order.shared(rows) is not sent
    assert "rim" in session._trim(spark)  # what the command answers: trimmed, or not available
    session.let_go(spark)

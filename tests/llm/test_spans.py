"""Spans in linear time: running sums, stretches of texts, spans apart from
others, and texts of megabytes through operators 5 and 6 and the PII stage."""

import hashlib
import random
import re
import time

from pyspark.sql import functions as F

from tests.llm.test_operators import base_pii, base_secrets, counted

UNIT = "id 123-45-6789, 10.1.2.3 x9 a.b@c.de token=abcdef12 é😀 4111 1111 1111 1111 "


def test_running_stretch_apart(spark):
    from sparkngram.llm import spans as S
    rnd = random.Random(3)
    lists = [[rnd.randrange(-9, 9) for _ in range(n)] for n in (0, 1, 2, 3, 7, 8, 9, 1000)]
    out = spark.createDataFrame([(x,) for x in lists], "a array<int>").select(
        "a", S.running(F.col("a"), lambda a, b: a + b).alias("s"), S.running(F.col("a"), lambda a, b: F.greatest(a, b)).alias("m")).collect()
    for r in out:
        assert r.s == [sum(r.a[:i + 1]) for i in range(len(r.a))] and r.m == [max(r.a[:i + 1]) for i in range(len(r.a))]
    text = "".join(rnd.choice("ab\né😀") for _ in range(5000))
    cuts = [tuple(sorted((rnd.randrange(5001), rnd.randrange(5001)))) for _ in range(200)] + [(0, 0), (0, 5000), (5000, 5000), (1023, 1024), (1024, 2048)]
    df = spark.createDataFrame([(text, a, b) for a, b in cuts], "t string, a int, b int")
    for r in df.select("a", "b", S.let(S.blocks(F.col("t")), lambda p: S.stretch(p, F.col("a"), F.col("b"))).alias("s")).collect():
        assert r.s == text[r.a:r.b]
    rows = []
    for i in range(300):
        some = lambda n: sorted((a, a + rnd.randrange(1, 9)) for a in (rnd.randrange(40) for _ in range(rnd.randrange(n))))
        rows.append((i, some(9), some(6)))
    kind = "array<struct<start: int, end: int>>"
    for r in spark.createDataFrame(rows, f"i int, x {kind}, b {kind}").select("x", "b", S.apart(F.col("x"), F.col("b")).alias("free")).collect():
        assert [tuple(x) for x in r.free] == [tuple(x) for x in r.x if not any(b.start < x.end and x.start < b.end for b in r.b)]


def test_texts_of_megabytes(spark):
    from sparkngram.llm import pii, secrets
    texts = [UNIT * 5000 + "plain words only " * 270_000 + UNIT * 100, "12 " * 200_000, "7" * 2_000_000, "a.b@" * 200_000, "x" * 100 + " " + UNIT]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    # the plain search would try the run of digits from each of its places; nothing in it passes a check
    personal = [base_pii(t) if t.strip("7") else [] for t in texts]
    found = {r.doc_id: r for r in pii.find(docs).collect()}
    for i in range(len(texts)):
        r = found[i]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) == counted(personal[i], pii.BASE)
    for r in pii.redact(docs).collect():
        out, at = [], 0
        for kind, a, b in (x.split(":") for x in found[r.doc_id].spans.split(",") if x):
            if int(a) >= at:
                out += [texts[r.doc_id][at:int(a)], f"[{kind.upper()}]"]
            at = max(at, int(b))
        assert r.text == "".join(out) + texts[r.doc_id][at:]
    for r in secrets.scan(docs).collect():
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) == counted(base_secrets(texts[r.doc_id]), secrets.KINDS[:3])


def test_time_grows_with_the_matches(spark):
    from sparkngram.llm import pii
    def seconds(n):
        docs = spark.createDataFrame([(1, "12345 " * n)], "doc_id long, text string")
        start = time.time()
        assert pii.find(docs).collect()[0].doc_id == 1
        return time.time() - start

    seconds(100)
    assert seconds(160_000) < 30  # a fold that copies its spans takes about 74 s for 40,000


def test_entropy_looks_at_whole_runs(spark):
    """A token whose first digit, capital or small letter comes late is found
    as a whole; brute force over runs."""
    from sparkngram.llm import secrets
    texts = ["Q" * 120 + "q" * 100 + "7" * 3, "a" * 5000 + "B" + "c" * 5000 + "1", "a1" * 40, "A1" * 40, "aB" * 40, "aB3" * 9, "aB3" * 10,
             "token=" + "cD5" * 10 + " next " + "zZ9+/_-" * 5, "é" + "aB3" * 20 + "😀" + "x" * 400 + "Y2"]
    docs = spark.createDataFrame([(i, t, f"s{i}") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    for r in secrets.scan(docs).collect():
        t = texts[r.doc_id]
        base = base_secrets(t)
        runs = [(m.start(), 3, m.end()) for m in re.finditer(r"[A-Za-z0-9+/_-]+", t)
                if len(m[0]) >= secrets.ENTROPY_CHARS and all(re.search(c, m[0]) for c in ("[0-9]", "[A-Z]", "[a-z]"))]
        more = [x for x in runs if not any(b[0] < x[2] and x[0] < b[2] for b in base)]
        assert r.spans == ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(base + more))
        assert r.base_sha256 == hashlib.sha256(",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in base).encode()).hexdigest()

"""Spans that the boosted trees add, against planted personal data and
look-alikes whose truth the trees never see."""

import random

import pytest

from tests.llm.test_operators import base_pii, lorem


def planted(n=600, seed=11):
    """(doc_id, text) rows and per row the (start, end) of planted personal data
    and of look-alikes, none of them a base span."""
    rng = random.Random(seed)
    d = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    name = lambda: rng.choice(("jane", "omar", "li", "ana")) + rng.choice(("", ".", "_")) + rng.choice(("roe", "poe", "kim")) + d(2)
    number = lambda: rng.choice(("({}) {}-{}", "{}-{}-{}", "{} {} {}", "{}.{}.{}")).format(d(3), d(3), d(4))
    identity = lambda: f"{rng.randint(100, 665)}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)}"
    at, dot = rng.choice, lambda: rng.choice((" (dot) ", "(dot)", " [dot] "))
    spelt = lambda: f"{name()}{at((' (at) ', '(at)', ' [at] '))}mail{d(1)}{dot()}example{dot()}com"
    real = ((("write to ", "e-mail: ", "so said ", "by "), spelt), (("call me at ", "phone ", "tel: ", "mobile number "), number),
            (("ssn ", "social security number is ", "her SSN: "), identity))
    alike = ((("come ", "be there "), lambda: f"sharp (at) 1{d(1)} (dot) {d(2)}"), (("rows ", "order ", "seen between ", "invoice no. "), number),
             (("part ", "the score was ", "catalogue "), identity))
    base = (lambda: f"+1 {d(3)} 555-{d(4)}", lambda: f"{name()}@mail{d(1)}.example.com", lambda: f"+44 ({d(3)}) {d(3)}-{d(4)}",
            lambda: f"10.0.{d(1)}.{rng.randint(256, 999)}", lambda: f"4111 1111 1111 {d(4)}", lambda: d(rng.randint(2, 11)))
    rows, yes, no = [], {}, {}
    for i in range(n):
        text, yes[i], no[i] = lorem(8, f"p{seed}{i}"), set(), set()
        for _ in range(rng.randint(1, 4)):
            what = rng.random()
            text += " and "
            if what < 0.5:
                cues, make = rng.choice(real if what < 0.25 else alike)
                text += rng.choice(cues)
                value = make()
                (yes if what < 0.25 else no)[i].add((len(text), len(text) + len(value)))
                text += value
            else:
                text += rng.choice(base)()
            text += rng.choice((".", ",", "")) + " " + lorem(rng.randint(3, 9), f"q{seed}{i}{len(text)}")
        rows.append((i, text))
    return rows, yes, no


@pytest.mark.parametrize("seed", [11, 12, 21])
def test_added_spans_have_precision_and_recall(spark, seed):
    from sparkngram.llm import pii
    rows, yes, no = planted(seed=seed)
    caught = {k: [0, 0] for k in ("spelt", "local", "identity")}
    wrong = added = 0
    for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        spans = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in r.spans.split(",") if s)]
        base = {(pii.BASE[k], a, b) for a, k, b in base_pii(rows[r.doc_id][1])}
        more = [s for s in spans if s not in base]
        assert base <= set(spans) and len(more) == r.n_added
        added += len(more)
        wrong += sum((a, b) not in yes[r.doc_id] for _, a, b in more)
        for a, b in yes[r.doc_id]:
            value = rows[r.doc_id][1][a:b]
            kind = "spelt" if "at" in value else "identity" if len(value) == 11 and value[3] == value[6] == "-" else "local"
            caught[kind][0] += any((x, y) == (a, b) for _, x, y in more)
            caught[kind][1] += 1
    figures = f"added {added}, wrong {wrong}, caught {caught}"
    print(figures)
    assert added and wrong <= 0.05 * added, figures
    assert all(hit >= 0.9 * n and n > 20 for hit, n in caught.values()), figures


def test_a_generator_that_does_not_reach_precision_selects_nothing(spark):
    """Cards that fail their check look like those that pass: none is added."""
    from sparkngram.llm import pii
    rng = random.Random(5)
    rows = [(i, lorem(4, f"c{i}") + " card " + "".join(rng.choice("0123456789") for _ in range(16)) + ".") for i in range(400)]
    found = pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.n_card for r in found} == {0, 1} and all(r.n_added == 0 for r in found)


def test_thresholds_are_per_generator():
    from sparkngram.llm import pii
    rows = [((k, d, 2, s, 0, w, 0, 0), 96 if w and k == 5 else 50 if k == 2 else 1, 100) for k in (2, 5) for d in (10, 16) for s in (0, 2) for w in (0, 1)]
    m = pii.calibrate(pii.boost(rows), rows)
    assert m.thresholds[2] is None and m.thresholds[7] is None
    assert m.score([5, 10, 2, 2, 0, 1, 0, 0]) >= m.thresholds[5] > m.score([5, 10, 2, 2, 0, 0, 0, 0])


def test_trees_and_thresholds_learn_from_every_span(spark, monkeypatch):
    """The counts that reach the fit and the thresholds add up to all spans."""
    from pyspark.sql import functions as F

    from sparkngram.llm import pii
    seen = []
    monkeypatch.setattr(pii, "boost", lambda rows: seen.append(sum(n for _, _, n in rows)) or pii.Trees())
    monkeypatch.setattr(pii, "calibrate", lambda model, rows: seen.append(sum(n for _, _, n in rows)) or model)
    span = "struct({0} as start, {1} as kind, {0} + 2 as end, {1} = 0 as ok, array({1}, 2, 0, 0, 0, 0, 0, 0) as f, {1} = 0 as y, cast(null as array<int>) as weak)"
    rows = spark.range(30_000).select(F.xxhash64("id").alias("text_hash"), F.expr(f"array({span.format(0, 0)}, {span.format(9, 7)})").alias("s"))
    pii.train(rows)
    assert sum(seen) == 60_000 and min(seen) > 25_000

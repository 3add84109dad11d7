"""Personal data by candidate gradient boosting.

Generators with high recall propose spans, which may overlap: the four fixed
base patterns and wider ones (emails spelt out with "(at)" and "(dot)",
telephone numbers without a country code, identity numbers, and plain digit
groups).  A span of a base pattern that passes its check is personal data as
such.  The others are judged: boosted trees score a span by its generator,
format and context, and a threshold per generator, calibrated for PRECISION
on spans of that generator that the trees have not seen, selects.

The trees and thresholds learn from every span of the table: half of them, by
hash, fit the trees, the other half sets the thresholds.  Personal are base spans that pass their checks, the same spans weakened to what a wider
generator would see in their place (a checked email spelt out, a checked
telephone number without its country code), and wide spans with a cue of
personal data before them and none of a thing's number, identity numbers only
if their parts are in use, spelt emails if they end in letters, cue or not.
All other spans that touch no base span are counter-examples.  The trees see
the cues as two features among eight; a wide generator's spans without a cue
are selected where their format alone speaks for them.  A generator whose
held-back spans never reach PRECISION selects nothing, one without any takes
the threshold of all spans together; plain digit groups are counter-examples
only.  Spark reduces the spans to counts of equal feature vectors before they
reach the driver; a feature is a small whole number with a fixed bound, so the
number of vectors has one too, whatever the table's size.  Scores are a column
expression.

Edge cases: a null text is the empty text; rows come out one for one, repeated
ids included; without spans of both kinds to learn from nothing is added;
redaction keeps a null text null; other columns pass through untouched
(:func:`redact`) or are ignored (:func:`find`); an empty table gives an empty
table.  Everything is DataFrame operations.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkngram.llm.common import cut
from sparkngram.llm.spans import apart, blocks, let, matches, running, stretch

ROUNDS, RATE, PRECISION = 64, 0.3, 0.95

# The base patterns.  Lookbehinds and possessive repeats only
# keep a search from starting again inside a run that has failed as a whole,
# and long runs from being tried over and over; what matches stays the same.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE = ("email", "ip", "card", "phone")

# The wider generators: name, pattern, strings one of which any match holds.
SPELT = (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,}+\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]++"
         r"(?:\x20?[\[(](?:dot|DOT)[\])]\x20?[A-Za-z0-9-]++)++")
LOCAL = r"(?<![0-9+)(.-])\(?[0-9]{3}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}(?![0-9])"
IDENTITY = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
DIGITS = r"(?<![0-9])[0-9]{2,11}(?![0-9])"
WIDE = (("spelt", SPELT, ("(at)", "[at]", "(AT)", "[AT]")), ("local", LOCAL, ()), ("identity", IDENTITY, ("-",)), ("digits", DIGITS, ()))
KINDS = (*BASE, *(w[0] for w in WIDE))
# Cues right before a span, at most three words off: of personal data, and of
# the numbers of things.
CONTEXT = (r"(?i)\b(?:e-?mail|mail|contact|phone|telephone|tel|call|mobile|cell|fax|card|visa|account|ssn|social|passport|ip|host|address)"
           r"\W{0,3}(?:\w{1,8}\W{1,3}){0,3}$")
THINGS = r"(?i)\b(?:order|invoice|part|item|version|page|isbn|serial|model|ref|reference|catalogue|tracking|lot)\W{0,3}(?:\w{1,8}\W{1,3}){0,2}$"
AROUND = 36  # code points of context before a span
FEATURES = ("kind", "digits", "chars", "signs", "thing", "word", "glued", "plus")
_SPAN = "array<struct<start: int, kind: int, end: int, value: string, ok: boolean>>"
_SCORED = "array<struct<start: int, kind: int, end: int, ok: boolean, f: array<int>, y: boolean, weak: array<int>>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _checked(kind: int, x: Column) -> Column:
    """Whether a base match passes the check of its kind."""
    n = F.char_length(_digits(x))
    if kind == 1:
        # parts at most 255, whatever leading zeros they have
        return F.forall(F.split(x, r"\."), lambda p: F.regexp_replace(p, "^0+", "").rlike(r"^(?:|[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"))
    if kind == 2:
        return (n >= 12) & (n <= 19) & _luhn(_digits(x))
    if kind == 3:
        return (n >= 9) & (n <= 15)
    return F.lit(True)


def _luhn(digits: Column) -> Column:
    """Luhn's check of a digit string."""
    reverse = F.split(F.reverse(digits), "")
    doubled = F.transform(reverse, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        F.element_at(F.array(*[F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), d.cast("int") + 1)))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def proposals(text: Column) -> Column:
    """All proposed spans by start, then kind; ``ok`` marks base spans."""
    base = ((EMAIL, ("@",)), (IP, (".",)), (CARD, ()), (PHONE, ("+",)))

    def as_spans(kind, pattern, needs):
        check = (lambda v: _checked(kind, v)) if kind < len(base) else (lambda v: F.lit(False))
        return F.transform(matches(text, pattern, needs=needs), lambda x: F.struct(
            x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end"), x["value"].alias("value"),
            check(x["value"]).alias("ok")))

    out = [as_spans(kind, pattern, needs) for kind, (pattern, needs) in enumerate((*base, *(w[1:] for w in WIDE)))]
    # short runs of digits are no card numbers, they are among the plain groups
    real = F.filter(F.concat(*out), lambda x: (x["kind"] != 2) | (F.char_length(x["value"]) >= 12))
    return F.when(text.rlike("[0-9@\\[(]"), F.array_sort(real.cast(_SPAN))).otherwise(F.array().cast(_SPAN))


def with_features(text: Column, spans: Column) -> Column:
    """The spans with an array of small whole numbers, one per FEATURES, with
    what the trees are taught of them (``y``) and the features of their
    weakened form (``weak``, null where there is none)."""

    def form(kind, value):
        return [kind, F.least(F.char_length(_digits(value)), F.lit(20)), F.least(F.floor(F.char_length(value) / 4), F.lit(12)),
                F.least(F.char_length(F.regexp_replace(value, "[A-Za-z0-9]", "")), F.lit(7))]

    def one(parts, x):
        before = stretch(parts, F.greatest(x["start"] - AROUND, F.lit(0)), x["start"])
        after = stretch(parts, x["end"], x["end"] + 1)
        return let(F.struct(before.alias("b"), after.alias("a")), lambda c: judged(x, c["b"], c["a"]))

    def judged(x, before, after):
        value = x["value"]
        thing, word = before.rlike(THINGS), before.rlike(CONTEXT)
        context = [thing, word, before.rlike("[A-Za-z0-9]$") | after.rlike("^[A-Za-z0-9]")]
        ints = lambda bits: F.array(*[b.cast("int") for b in bits])
        spelt = F.regexp_replace(F.regexp_replace(value, "@", " (at) "), r"\.(?=[A-Za-z0-9-]*+(?:\.[A-Za-z0-9-]++)*+$)", " (dot) ")
        local = F.regexp_replace(value, r"^\+[0-9]{1,3}[\x20.-]*", "")
        weak = (F.when(x["ok"] & (x["kind"] == 0), ints([*form(F.lit(4), spelt), *context, F.lit(0)]))
                .when(x["ok"] & (x["kind"] == 3) & local.rlike(f"^{LOCAL}$"), ints([*form(F.lit(5), local), *context, F.lit(0)])))
        cue = word & ~thing
        taught = (F.when(x["kind"] < 4, x["ok"]).when(x["kind"] == 4, value.rlike(r"[A-Za-z]{2,}$")).when(x["kind"] == 5, cue)
                  .when(x["kind"] == 6, cue & ~value.rlike("^(?:000|666|9..)|-00-|0000$")).otherwise(F.lit(False)))
        return F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"), x["ok"].alias("ok"),
                        ints([*form(x["kind"], value), *context, value.startswith("+")]).alias("f"), taught.alias("y"), weak.alias("weak"))

    return let(spans, lambda found: F.when(F.size(found) > 0, let(blocks(text), lambda parts: F.transform(found, lambda x: one(parts, x)).cast(_SCORED)))
               .otherwise(F.array().cast(_SCORED)))


@dataclass(frozen=True)
class Trees:
    """Two-level trees: (feature, cut, (feature, cut, low, high) twice), and
    a threshold per kind; a kind without one selects nothing."""
    trees: tuple = ()
    bias: float = 0.0
    thresholds: tuple[float | None, ...] = (None,) * len(KINDS)

    def score(self, f: list[int]) -> float:
        z = self.bias
        for i, c, left, right in self.trees:
            j, d, low, high = left if f[i] <= c else right
            z += low if f[j] <= d else high
        return z

    def column(self, f: Column) -> Column:
        """:meth:`score` as a column over the feature array."""
        z = F.lit(float(self.bias))
        for i, c, left, right in self.trees:
            side = [F.when(f[j] <= d, F.lit(low)).otherwise(F.lit(high)) for j, d, low, high in (left, right)]
            z = z + F.when(f[i] <= c, side[0]).otherwise(side[1])
        return z

    def selected(self, kind: Column, f: Column) -> Column:
        at = F.element_at(F.array(*[F.lit(t if t is not None else math.inf).cast("double") for t in self.thresholds]), kind + 1)
        return self.column(f) >= at


def _best_split(rows, grad, hess):
    """(gain, feature, cut) of the best split of weighted rows."""
    g, h = sum(grad), sum(hess)
    best = (1e-9, 0, -1)
    for i in range(len(FEATURES)):
        by: dict[int, list[float]] = {}
        for f, a, b in zip(rows, grad, hess):
            s = by.setdefault(f[i], [0.0, 0.0])
            s[0] += a
            s[1] += b
        ga = ha = 0.0
        for value in sorted(by)[:-1]:
            ga, ha = ga + by[value][0], ha + by[value][1]
            gain = ga * ga / (ha + 1) + (g - ga) ** 2 / (h - ha + 1) - g * g / (h + 1)
            if gain > best[0]:
                best = (gain, i, value)
    return best


def boost(rows: list[tuple], rounds: int = ROUNDS, rate: float = RATE) -> Trees:
    """Fit trees to (features, positives, total) rows by gradient boosting of
    the logistic loss."""
    x = [tuple(r[0]) for r in rows]
    yes, total = [float(r[1]) for r in rows], [float(r[2]) for r in rows]
    share = (sum(yes) + 1) / (sum(total) + 2)
    model = Trees((), math.log(share / (1 - share)))
    z = [model.bias] * len(x)
    for _ in range(rounds):
        p = [1 / (1 + math.exp(-max(-30, min(30, v)))) for v in z]
        grad = [y - n * q for y, n, q in zip(yes, total, p)]
        hess = [n * q * (1 - q) for n, q in zip(total, p)]
        gain, i, c = _best_split(x, grad, hess)
        if c < 0:
            break
        leaves = []
        for part in ([k for k, f in enumerate(x) if f[i] <= c], [k for k, f in enumerate(x) if f[i] > c]):
            xs, gs, hs = [x[k] for k in part], [grad[k] for k in part], [hess[k] for k in part]
            _, j, d = _best_split(xs, gs, hs)
            values = []
            for side in (True, False):
                g = sum(a for f, a in zip(xs, gs) if (f[j] <= d) == side)
                h = sum(b for f, b in zip(xs, hs) if (f[j] <= d) == side)
                values.append(round(rate * g / (h + 1), 6))
            leaves.append((j, d, values[0], values[1]))
        tree = (i, c, leaves[0], leaves[1])
        model = Trees((*model.trees, tree), model.bias)
        z = [v + Trees((tree,)).score(f) for v, f in zip(z, x)]
    return model


def _threshold(model: Trees, rows: list[tuple], precision: float) -> float | None:
    """The least score from which on the share of personal data reaches ``precision``."""
    by_score: dict[float, list[float]] = {}
    for f, y, n in rows:
        sums = by_score.setdefault(round(model.score(list(f)), 9), [0.0, 0.0])
        sums[0] += y
        sums[1] += n
    best, yes, total = None, 0.0, 0.0
    for s in sorted(by_score, reverse=True):  # equal scores stand or fall together
        yes, total = yes + by_score[s][0], total + by_score[s][1]
        if yes >= precision * total:
            best = s - 1e-9
    return best


def calibrate(model: Trees, rows: list[tuple], precision: float = PRECISION) -> Trees:
    """A threshold per generator over the (features, positives, total) rows of
    that generator, which the trees have not seen; a generator without such
    rows takes the threshold of all rows together.  Plain digit groups, the
    last kind, are only counter-examples."""
    own = [[r for r in rows if r[0][0] == kind] for kind in range(len(KINDS) - 1)]
    return Trees(model.trees, model.bias, (*[_threshold(model, part or rows, precision) for part in own], None))


def taught(s: Column) -> Column:
    """What the trees learn from a row's spans: ``array<struct<start, kind, f,
    y>>`` of base spans, their weakened forms and spans that touch none."""
    def every(found):
        row = lambda x, f, y: F.struct(x["start"].alias("start"), F.get(f, 0).alias("kind"), f.alias("f"), y.alias("y"))
        base = F.filter(found, lambda x: x["ok"])
        free = let(base, lambda b: apart(F.filter(found, lambda x: ~x["ok"]), b))
        weak = F.filter(found, lambda x: x["weak"].isNotNull())
        return F.concat(F.transform(base, lambda x: row(x, x["f"], x["y"])), F.transform(free, lambda x: row(x, x["f"], x["y"])),
                        F.transform(weak, lambda x: row(x, x["weak"], F.lit(True))))

    return let(s, every)


def train(found: DataFrame) -> Trees:
    """Learn from all rows (spans with features in column ``s``)."""
    spans = found.where(F.size("s") > 0).select("text_hash", F.explode(taught(F.col("s"))).alias("x"))
    half = F.pmod(F.xxhash64("text_hash", "x.start", "x.kind"), F.lit(2))
    # equal vectors are counted before and after the shuffle: few rows are left
    rows = (spans.select(F.col("x.f").alias("f"), F.col("x.y").cast("long").alias("y"), half.alias("half"))
            .groupBy("half", "f").agg(F.sum("y").alias("y"), F.count(F.lit(1)).alias("n")).collect())
    fit = sorted((tuple(r["f"]), r["y"], r["n"]) for r in rows if r["half"] == 0)
    rest = sorted((tuple(r["f"]), r["y"], r["n"]) for r in rows if r["half"] == 1)
    if not any(y for _, y, _ in fit) or all(y == n for _, y, n in fit):
        return Trees()
    return calibrate(boost(fit), rest)


def spans_of(docs: DataFrame) -> tuple[DataFrame, Trees]:
    """((doc_id, text_hash, s), model): all proposals with features."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    found = rows.withColumn("_p", proposals(F.col("text"))).select("doc_id", "text_hash", with_features(F.col("text"), F.col("_p")).alias("s"))
    found = cut(found)  # one pass over the texts; the spans are few
    return found, train(found)


def kept_spans(s: Column, model: Trees) -> Column:
    """Base spans and selected ones that touch no base span."""
    def kept(found):
        base = F.filter(found, lambda x: x["ok"])
        more = F.filter(found, lambda x: ~x["ok"] & model.selected(x["kind"], x["f"]))
        return let(base, lambda b: F.array_sort(F.concat(b, apart(more, b))))

    return let(s, kept)


def digest(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"),
                                                                 x["end"].cast("string"))), ",")


def find(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans,
    and n_added, the spans beyond the base ones."""
    found, model = spans_of(docs)
    rows = found.select("doc_id", F.filter("s", lambda x: x["ok"]).alias("b"), kept_spans(F.col("s"), model).alias("k"))
    count = lambda k: F.size(F.filter("b", lambda x: x["kind"] == k)).cast("long")
    return rows.select("doc_id", *[count(i).alias(f"n_{name}") for i, name in enumerate(BASE)],
                       F.sha2(digest(F.col("b")), 256).alias("base_sha256"), digest(F.col("k")).alias("spans"),
                       (F.size("k") - F.size("b")).cast("long").alias("n_added"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every kept span replaced by its kind in brackets (of
    spans that overlap, the first one's, for all they cover), and ``n_chars``, where there is one, counted anew."""
    _, model = spans_of(docs)
    text = F.col("text").cast("string")
    spans = kept_spans(with_features(text, proposals(text)), model)
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def replaced(found, parts):
        # what the spans up to each one cover ends at ``e``; a span that starts before it is joined
        ends = running(F.transform(found, lambda x: x["end"]), lambda a, b: F.greatest(a, b))

        def joined(e):
            def with_ends(z, i):
                at = F.when(i > 0, F.get(e, i - 1)).otherwise(F.lit(0))
                return F.when(z["start"] >= at, F.concat(stretch(parts, at, z["start"]), F.element_at(names, z["kind"] + 1))).otherwise(F.lit(""))

            tail = stretch(parts, F.element_at(e, -1), F.char_length(text))
            return F.concat(F.array_join(F.transform(found, with_ends), ""), tail)

        return let(ends, joined)

    marked = docs.withColumn("_spans", spans)
    clean = F.when(F.size("_spans") > 0, let(F.col("_spans"), lambda found: let(blocks(text), lambda parts: replaced(found, parts)))).otherwise(text)
    out = marked.withColumn("text", clean).drop("_spans")
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out

"""Toxicity by a weighted lexicon.

A text is folded (lower case, homoglyphs and accented letters to plain
letters, digits and signs to the letters they stand in for), an Aho-Corasick
automaton finds the lexicon's entries, whole words or stems ("stem*") that a
word starts with, hits inside an exception phrase are left out, and the weighted hits are divided by a power of the
text's length in words before a logistic link.

The lexicon is learnt: words and stems of the toxic training documents whose
document frequency speaks for the label are candidates; an L1-penalised logistic fit
gives their weights, the power of the length and the bias.  The fit sees a
hash sample of about SAMPLE labelled rows; candidates are counted by Spark,
only their hits in the sample (at most CANDIDATES per row) reach the driver.

Edge cases: a null text is the empty text, scored like one without hits; rows
come out one for one, repeated ids included; a null doc_id is not held out;
labels other than 0 and 1 and rows without a document are ignored; without
toxic training rows every score is 0; extra columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkngram.llm.common import bounded_batches, id_text

SAMPLE = 12_000       # labelled rows that the fit sees, about
CANDIDATES = 300      # words that the fit may weigh
LEAST_DOCS = 3        # toxic documents that a candidate occurs in
STEMS = (4, 5, 6, 7)  # lengths of stems
THRESHOLD = 0.7
PENALTY = 1e-5        # of the L1 fit
POWERS = (0.05, 0.1, 0.25, 0.5)  # of the length; the fit chooses one

# Look-alike letters and the letters that digits and signs
# stand in for.
LOOK_ALIKE = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p",
    "с": "c", "т": "t", "у": "y", "х": "x", "ѕ": "s", "ԁ": "d", "ɡ": "g", "ո": "n", "ս": "u",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ł": "l", "ø": "o", "đ": "d",
}
STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "circus clown", "rodeo clown", "pond scum", "soap scum")


class _Fold(dict):
    """One character to one character, worked out when first met."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        low = c.lower()
        low = low[0] if len(low) > 1 else low
        plain = LOOK_ALIKE.get(low) or STANDS_FOR.get(low)
        if plain is None:
            first = unicodedata.normalize("NFKD", low)[0].lower()
            first = LOOK_ALIKE.get(first, first)
            plain = first if len(first) == 1 and first.isascii() and first.isalpha() else low
        self[code] = plain
        return plain


_FOLD = _Fold()
_WORD = re.compile(r"[^\W_]+")


def fold(text: str) -> str:
    """Folded text, as many characters long as ``text``.  An exclamation mark
    counts as a letter only inside a word."""
    out = text.translate(_FOLD)
    if "!" in text or "@" in text or "$" in text:
        out = re.sub(r"(?<!\w)[!@$]+|[!@$]+(?!\w)", lambda m: " " * len(m[0]) if m[0][0] == "!" else m[0], text).translate(_FOLD)
    return out


def words(folded: str) -> list[str]:
    return _WORD.findall(folded)


def automaton(lexicon, exceptions=EXCEPTIONS):
    """Aho-Corasick automaton over words, stems and exception phrases.  A value
    is the length and the entry's index as a word, as a stem, and whether it
    is an exception."""
    import ahocorasick
    at: dict[str, list] = {}
    for i, w in enumerate(lexicon):
        stem = w.endswith("*")
        at.setdefault(w.rstrip("*"), [None, None, False])[stem] = i
    for p in exceptions:
        at.setdefault(fold(p), [None, None, False])[2] = True
    a = ahocorasick.Automaton()
    for w, (word, stem, spare) in at.items():
        a.add_word(w, (len(w), word, stem, spare))
    a.make_automaton()
    return a


def hits(a, folded: str) -> Counter:
    """Lexicon index -> number of hits outside exception phrases."""
    found, spared = [], []
    n = len(folded)
    for end, (size, word, stem, spare) in a.iter(folded):
        start, end = end - size + 1, end + 1
        if start and folded[start - 1].isalnum():
            continue
        if stem is not None:
            found.append((start, end, stem))
        if end < n and folded[end].isalnum():
            continue
        if word is not None:
            found.append((start, end, word))
        if spare:
            spared.append((start, end, None))
    if spared:
        found = [f for f in found if not any(s <= f[0] and f[1] <= e for s, e, _ in spared)]
    return Counter(i for _, _, i in found)


@dataclass(frozen=True)
class Model:
    lexicon: tuple[str, ...] = ()
    weights: tuple[float, ...] = ()
    bias: float = -20.0
    power: float = 0.25
    exceptions: tuple[str, ...] = EXCEPTIONS

    def score(self, found: Counter, n_words: int) -> float:
        z = self.bias + sum(self.weights[i] * np.log1p(k) for i, k in found.items()) * strength(n_words, self.power)
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def strength(n_words, power: float):
    """The factor that a length gives, 1 at a hundred words."""
    return (100 / (np.maximum(n_words, 10) + 90)) ** power


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(toxic, text) of a hash sample of about ``sample`` labelled rows that
    aren't held out.  Only (doc_id, toxic) of the sample, whose size that
    bounds, is broadcast; texts stay where they are."""
    lab = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
           .where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    n = lab.count()
    if n > sample:
        lab = lab.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)) < F.lit(int(sample / n * (1 << 30))))
    return id_text(docs).join(F.broadcast(lab), "doc_id").select("toxic", "text")


def candidate_words(rows: DataFrame, most: int = CANDIDATES, least: int = LEAST_DOCS) -> list[str]:
    """Words by how strongly their document frequency speaks for the label."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = [0, 0], [Counter(), Counter()]
        for b in batches:
            for y, t in zip(b.column(0).to_pylist(), b.column(1)):
                total[y] += 1
                every = {w for w in words(fold(t.as_py())) if 2 < len(w) <= 40}
                seen[y].update(every | {w[:k] + "*" for w in every for k in STEMS if len(w) >= k})
                if len(seen[0]) + len(seen[1]) > 200_000:
                    yield batch(total, seen)
                    total, seen = [0, 0], [Counter(), Counter()]
        yield batch(total, seen)

    def batch(total, seen):
        every = ["", *(seen[0].keys() | seen[1].keys())]
        return pa.RecordBatch.from_arrays(
            [pa.array(every, pa.string()), pa.array([total[1], *(seen[1][w] for w in every[1:])], pa.int64()),
             pa.array([total[0], *(seen[0][w] for w in every[1:])], pa.int64())], ["word", "toxic", "clean"])

    c = rows.mapInArrow(count, "word string, toxic long, clean long").groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    top = c.where((F.col("word") == "") | ((F.col("toxic") >= least) & (F.col("toxic") > F.col("clean"))))
    # a word that a document in ten holds counts more than one that a single group of copies holds
    got = top.orderBy(F.col("word") != "", (F.col("toxic") * F.log((F.col("toxic") + 0.5) / (F.col("clean") + 0.5))).desc(), "word").limit(4 * most + 1).collect()
    # of entries in the same documents, as counts and a common beginning tell, the longest stays
    kept: dict[tuple, str] = {}
    for r in got:
        if r["word"]:
            key = (r["toxic"], r["clean"], r["word"][:min(STEMS)])
            kept[key] = max(kept.get(key, ""), r["word"], key=lambda w: (len(w.rstrip("*")), w))
    return list(kept.values())[:most]


def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float, rounds: int = 800) -> tuple[np.ndarray, float]:
    """L1-penalised logistic weights, never negative (accelerated proximal gradient)."""
    share = weight / weight.sum()
    mean = float(share @ y)
    bias = float(np.log((mean + 1e-3) / (1 - mean + 1e-3)))
    w = v = np.zeros(x.shape[1])
    vb, t = bias, 1.0
    both = np.column_stack([x, np.ones(len(x))]) * np.sqrt(share)[:, None]
    step = 4 / max(1e-9, float(np.linalg.norm(both, 2) ** 2))
    for _ in range(rounds):
        g = (1 / (1 + np.exp(-np.clip(x @ v + vb, -30, 30))) - y) * share
        w2 = np.maximum(0, v - step * (x.T @ g + penalty))
        b2 = vb - step * g.sum()
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v, vb = w2 + (t - 1) / t2 * (w2 - w), b2 + (t - 1) / t2 * (b2 - bias)
        w, bias, t = w2, b2, t2
    return w, float(bias)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, exceptions=EXCEPTIONS) -> Model:
    """Learn a :class:`Model`; see the module's text."""
    rows = training_rows(docs, labels, sample)
    lexicon = candidate_words(rows)
    if not lexicon:
        return Model(exceptions=tuple(exceptions))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = automaton(lexicon, exceptions)
        for b in batches:
            got = [(f := fold(t.as_py())) and (hits(a, f), len(words(f))) or (Counter(), 0) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([n for _, n in got], pa.int64()),
                 pa.array([[{"i": i, "k": k} for i, k in sorted(h.items())] for h, _ in got],
                          pa.list_(pa.struct([("i", pa.int32()), ("k", pa.int32())])))],
                ["toxic", "n", "h"])

    # rows without a hit are alike whatever their length: only their number counts
    found = rows.mapInArrow(find, "toxic int, n long, h array<struct<i: int, k: int>>")
    got = (found.withColumn("n", F.when(F.size("h") > 0, F.col("n")).otherwise(0)).groupBy("toxic", "n", "h")
           .agg(F.count(F.lit(1)).alias("rows")).collect())
    y = np.array([r["toxic"] for r in got], float)
    if not y.any():
        return Model(exceptions=tuple(exceptions))
    n = np.array([r["n"] for r in got], float)
    weight = np.array([r["rows"] for r in got], float)
    x = np.zeros((len(got), len(lexicon)))
    for row, r in enumerate(got):
        for h in r["h"]:
            x[row, h["i"]] = np.log1p(h["k"])
    best = None
    test = (np.arange(len(got)) % 4 == 0) & (n > 0)
    for power in POWERS:
        z = x * strength(n, power)[:, None]
        w, b = _fit(z[~test], y[~test], weight[~test], PENALTY)
        p = np.clip(1 / (1 + np.exp(-np.clip(z[test] @ w + b, -30, 30))), 1e-6, 1 - 1e-6)
        loss = -float(weight[test] @ (y[test] * np.log(p) + (1 - y[test]) * np.log(1 - p)))
        if best is None or loss < best[0] - 1e-6:
            best = (loss, power)
    w, b = _fit(x * strength(n, best[1])[:, None], y, weight, PENALTY)
    keep = np.flatnonzero(w > 1e-3)
    return Model(tuple(lexicon[i] for i in keep), tuple(float(w[i]) for i in keep), b, best[1], tuple(exceptions))


def score_documents(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), name: str = "score") -> DataFrame:
    """``keep`` columns of ``docs`` and ``name double``; one pass, no shuffle."""
    bounded_batches(docs.sparkSession)
    # a text that is kept anyway is sent once
    once = "text" in keep and docs.schema["text"].dataType.simpleString() == "string"
    at = keep.index("text") if once else len(keep)
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = automaton(model.lexicon, model.exceptions) if model.lexicon else None
        for b in batches:
            out = []
            for t in b.column(at):
                f = fold(t.as_py() or "")
                found = hits(a, f) if a is not None else Counter()
                # the length counts only where something was found
                out.append(model.score(found, len(words(f)) if found else 0))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), pa.array(out, pa.float64())], [*keep, name])

    read = docs.select(*keep) if once else docs.select(*keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    return read.mapInArrow(run, f"{fields}, `{name}` double")


def drop_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all columns as they were."""
    scored = score_documents(docs, train(docs, labels, sample), tuple(docs.columns), "_toxicity")
    return scored.where(F.col("_toxicity") < threshold).drop("_toxicity")


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    scored = score_documents(id_text(docs), train(docs, labels, sample))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))

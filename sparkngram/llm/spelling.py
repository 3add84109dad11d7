"""Spelling variants by blocked Gram matrices.

Words are counted over all documents first (partial sums before the shuffle),
so what follows grows with the vocabulary, not with the corpus.  A word is the
vector of its letter counts.  One inserted or deleted letter moves that vector
by a squared distance of 1, one replaced letter by 2, and the lengths differ by
at most 1.  So the words are dealt to blocks by length, a NumPy product of two
blocks' vectors gives all squared distances |a|^2 + |b|^2 - 2ab at once, the
pairs at most two apart are kept, and an exact edit check decides.

Two things keep the products small.  A vector that moves in at most two
letters keeps the counts of at least one of three groups of letters: each word
goes to three blocks, one per group, by a hash of that group's counts, and a
pair is taken from the first group that it agrees in.  The number of hash
buckets follows the vocabulary (about BUCKET words of all lengths in each).
And a block of more than TILE words is cut into tiles by hash; tiles meet
pairwise, each pair of tiles in a group of its own, so that no task holds more
than about two tiles.

Edge cases: a null text has no words; under a null doc_id no letter is
deleted; repeated rows count each time; other columns are ignored; an empty
table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkngram.llm.common import cut, id_text

# Fixed by the contract: letters of a word, every how many-th hash loses a
# letter, least length and count of a word, how much more frequent a form is.
RUN = "[A-Za-z\\u00C0-\\u00FF]+"
EVERY, LEAST_LENGTH, LEAST_COUNT, TIMES = 199, 6, 5, 5

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TILE, BUCKET = 2048, 8192
# Three groups of letters; letters beyond a-z are dealt by code point.
GROUPS = ("etosdlfbkx", "anhcmpyvj", "irugwqz")
SLICE = 1 << 22     # squared distances that one step holds


def runs(docs: DataFrame, every: int = EVERY) -> DataFrame:
    """(word): every run of letters with A-Z lower-cased; where ``every``
    divides the crc32 of "<doc_id>:<run>", one of its letters is deleted."""
    run = id_text(docs).select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    run = run.select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))
    h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run")).cast("binary"))
    at = F.pmod(h, F.length("run").cast("long")).cast("int")
    less = F.concat(F.expr("substring(run, 1, at)"), F.expr("substring(run, at + 2)"))
    return (run.select("run", h.alias("h"), at.alias("at"))
            .select(F.when(F.pmod("h", F.lit(every)) == 0, less).otherwise(F.col("run")).alias("word")))


def count_words(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    return (words.where(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= least_count))


def group_counts(word: Column, group: int) -> Column:
    """The counts of one group's letters in ``word``, as a string."""
    mine = GROUPS[group] + "".join(chr(c) for c in range(0xC0, 0x100) if c % 3 == group)
    kept = F.regexp_replace(word, f"[^{mine}]", "")
    return F.array_join(F.array_sort(F.split(kept, "")), "")


def letter_counts(letters: np.ndarray) -> np.ndarray:
    """Counts (words x letters that occur) of padded Latin-1 words."""
    used = np.unique(letters)
    used = used[used > 0]
    out = np.zeros((len(letters), len(used)), np.float32)
    for k, c in enumerate(used):
        out[:, k] = (letters == c).sum(axis=1)
    return out


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether two rows of zero-padded letters, the second as long as the
    first or one longer, differ by one replaced or one inserted letter."""
    na, nb = (a > 0).sum(axis=1), (b > 0).sum(axis=1)
    differ = a != b
    same = (na == nb) & (differ.sum(axis=1) == 1)
    # letters before the first difference, and those from there on moved by one
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])
    place = np.arange(a.shape[1] - 1)
    moved = (a[:, :-1] == b[:, 1:]) | (place < first[:, None]) | (place >= na[:, None])
    return same | ((nb == na + 1) & moved.all(axis=1))


def near_in_block(a: np.ndarray, b: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Positions (in a, in b) of words one edit apart, for two blocks of
    zero-padded Latin-1 letters; ``same``: both are one block."""
    both = letter_counts(np.concatenate([a, b]))
    va, vb = both[:len(a)], both[len(a):]
    sa, sb = (va * va).sum(axis=1), (vb * vb).sum(axis=1)
    found = []
    step = max(1, SLICE // max(len(b), 1))
    for i in range(0, len(a), step):
        d2 = sa[i:i + step, None] + sb[None, :] - 2 * (va[i:i + step] @ vb.T)
        x, y = np.nonzero(d2 <= 2)
        x += i
        if same:
            x, y = x[x < y], y[x < y]
        ok = one_edit(a[x], b[y]) if len(x) else np.zeros(0, bool)
        found.append((x[ok], y[ok]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def padded(words: list[str]) -> np.ndarray:
    """Latin-1 letters of words, zero-padded to one width and a column."""
    width = max(map(len, words)) + 1
    return np.frombuffer(b"".join(w.encode("latin-1").ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)


_GROUP_OF = np.zeros(256, np.int64)
for _g, _letters in enumerate(GROUPS):
    _GROUP_OF[[ord(c) for c in _letters]] = _g
_GROUP_OF[0xC0:] = np.arange(0xC0, 0x100) % 3


def first_agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The first group in whose letters two rows of words have equal counts."""
    out = np.full(len(a), len(GROUPS))
    for g in reversed(range(len(GROUPS))):
        mine = [np.sort(np.where((_GROUP_OF[w] == g) & (w > 0), w, 0), axis=1) for w in (a, b)]
        out[(mine[0] == mine[1]).all(axis=1)] = g
    return out


def blocks(words: DataFrame, tile: int = TILE, bucket: int = BUCKET) -> DataFrame:
    """(g, key, size, p, q, side, word, n): each word in every pair of tiles
    that it takes part in; tile p of length ``size`` meets tile q of the same
    length (p <= q, side 0 and 1) or of the next (sides 0 and 2)."""
    buckets = words.count() // bucket + 1
    keys = [F.pmod(F.xxhash64(group_counts(F.col("word"), g)), F.lit(buckets)) for g in range(len(GROUPS))]
    dealt = words.select("word", "n", F.length("word").alias("size"), F.posexplode(F.array(*keys)).alias("g", "key"))
    # tiles per block, and per block of the next length: one row per block
    count = dealt.groupBy("g", "key", "size").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles"))
    count = cut(count)
    near = (count.join(count.select("g", "key", (F.col("size") - 1).alias("size"), F.col("tiles").alias("above")), ["g", "key", "size"], "left")
            .join(count.select("g", "key", (F.col("size") + 1).alias("size"), F.col("tiles").alias("below")), ["g", "key", "size"], "left")
            .fillna(0, ["above", "below"]))
    x = dealt.join(near, ["g", "key", "size"]).withColumn("t", F.pmod(F.xxhash64("word"), "tiles").cast("int"))
    places = F.expr("""concat(
        transform(sequence(0, tiles - 1), q -> struct(size as size, least(t, q) as p, greatest(t, q) as q, if(t <= q, 0, 1) as side)),
        transform(if(above > 0, sequence(0, above - 1), array()), q -> struct(size as size, t as p, q as q, 2 as side)),
        transform(if(below > 0, sequence(0, below - 1), array()), p -> struct(size - 1 as size, p as p, t as q, 3 as side)))""")
    return x.select("g", "key", "word", "n", F.explode(places).alias("x")).select(
        "g", "key", F.col("x.size").alias("size"), F.col("x.p").alias("p"), F.col("x.q").alias("q"), F.col("x.side").alias("side"), "word", "n")


def near_pairs(words: DataFrame, tile: int = TILE, bucket: int = BUCKET) -> DataFrame:
    """(a, na, b, nb): every pair of words one edit apart, once, with counts."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        side = table["side"].to_numpy()
        word, n = table["word"].to_pylist(), table["n"].to_numpy()
        group, p, q = (key[i].as_py() for i in (0, 3, 4))
        letters = padded(word)
        out: list[tuple] = []
        # one tile with itself, two tiles of a length, a tile and one of the next length
        tasks = [(0, 0)] if p == q else [(0, 1)]
        for left, right in [*tasks, (2, 3)]:
            i, j = np.flatnonzero(side == left), np.flatnonzero(side == right)
            if not len(i) or not len(j):
                continue
            x, y = near_in_block(letters[i], letters[j], left == right)
            x, y = i[x], j[y]
            mine = first_agreement(letters[x], letters[y]) == group
            out += [(word[u], n[u], word[v], n[v]) for u, v in zip(x[mine], y[mine])]
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.table([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], ["a", "na", "b", "nb"])

    return blocks(words, tile, bucket).groupBy("g", "key", "size", "p", "q").applyInArrow(run, "a string, na long, b string, nb long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last word of each chain word -> form -> ...; chains
    end, as counts rise along them, and their pointers double each round."""
    at = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        after = cut(at.join(on, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")))
        done = not after.where("moved").limit(1).count()
        at = after.select("word", "root")
        if done:
            return at


def group_variants(docs: DataFrame, tile: int = TILE, bucket: int = BUCKET) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n."""
    return variants(cut(count_words(runs(docs))), tile, bucket)


def variants(words: DataFrame, tile: int = TILE, bucket: int = BUCKET, times: int = TIMES) -> DataFrame:
    """The same for given words (word, n)."""
    pairs = cut(near_pairs(words, tile, bucket))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("o"), F.col("nb").alias("no")).union(
        pairs.select(F.col("b"), F.col("a"), F.col("na")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("no")).alias("m"), "o")).alias("best"))
    x = (words.join(best, "word", "left").withColumn("far", -F.col("best.m") >= F.lit(times) * F.col("n"))
         .select("word", F.when(F.col("far"), F.col("best.o")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                 F.when(F.col("far"), -F.col("best.m")).alias("form_n")))
    x = cut(x)
    chain = roots(x.where("form is not null"))
    return x.join(chain, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

"""Near-duplicate groups by SuperMinHash.

A document is the set of its word shingles (A-Z lower-cased, words
``[^\\x20\\x09-\\x0D]+``).  SuperMinHash gives every shingle a random
permutation of the signature's places and takes, per place, the least of
(rank in the permutation, random fraction): the correlated ranks make the
estimate's variance lower than that of independent minima, and the work on a
text stops as soon as no later rank can win a place.  Signatures are banded.

Documents with equal sets form a class at once, by a digest of the set.
Classes that share a band's bucket are candidates, but no bucket is ever
spelt out as pairs: a first round compares every member of a bucket with the
one that shares most of itself, then, as long as a bucket holds members of different groups,
the members outside its largest group (a fixed number per round) are compared
with the rest.  Every comparison takes both full sets.  A pair is left out
only if its two classes are already in one group, or if it cannot reach the
threshold: a shingle that no other candidate class has is in no intersection,
and what two members share lies within what each shares with the bucket's
first or within what each shares with others beyond it.  The groups are those
that all pairs of all buckets would give.

With 24 bands of 4 places a pair at similarity 0.85 shares no bucket with
probability 2e-8, at 0.8 with 3e-6.

Edge cases: a null text is the empty text; a text without words has an empty
set and is linked with nothing; a text with fewer words than a shingle is one
shingle; rows of one doc_id are one document, so their groups join; rows with
a null doc_id share the null id, which counts as the least; other columns are ignored; an
empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkngram.llm.common import chunks, cut, id_text, mix64, prefix_hash, span_hash, utf8
from sparkngram.llm.components import components
from sparkngram.plans.joins import thin

WORDS = 3
NUMERATOR, DENOMINATOR = 85, 100
BANDS, ROWS = 24, 4
HUBS = 512            # members that a bucket compares with the rest in one round
NOBODY = -(1 << 63)   # stands for a null doc_id
PER_SALT = 500        # comparisons of one hub that a task gets, about
SPREAD = 256          # parts that the comparisons of one hub are counted and salted in
FILTER = 1 << 22      # bits of the broadcast that spares needless shuffling (half a megabyte)
ODD = np.uint64(0xD6E8FEB86659FD93)


def shingles(data: np.ndarray, off: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(text index, shingle hash), distinct and sorted, of texts laid end to end."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    word = ~((data == 32) | ((data >= 9) & (data <= 13)))
    first = np.zeros(n + 1, bool)
    first[off] = True
    before = np.append(False, word[:-1]) & ~first[:-1]
    after = np.append(word[1:], False) & ~first[1:]
    start, end = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    text = np.searchsorted(off, start, "right") - 1
    h = span_hash(prefix_hash(data), start, end)
    count = np.bincount(text, minlength=len(off) - 1)
    begin = np.concatenate([[0], np.cumsum(count)])
    m = len(h) - words + 1
    if m > 0:
        s = np.zeros(m, np.uint64)
        for i in range(words):
            s = s * ODD + h[i:i + m]
        whole = text[:m] == text[words - 1:]
        s, owner = mix64(s[whole] + np.uint64(words)), text[:m][whole]
    else:
        s, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    few = np.flatnonzero((count > 0) & (count < words))
    if len(few):
        short = np.zeros(len(few), np.uint64)
        for i in range(words - 1):
            more = count[few] > i
            short[more] = short[more] * ODD + h[begin[few[more]] + i]
        s = np.concatenate([s, mix64(short + count[few].astype(np.uint64))])
        owner = np.concatenate([owner, few])
    order = np.lexsort((s, owner))
    s, owner = s[order], owner[order]
    new = np.append(True, (s[1:] != s[:-1]) | (owner[1:] != owner[:-1])) if len(s) else np.zeros(0, bool)
    return owner[new], s[new]


def super_minhash(owner: np.ndarray, h: np.ndarray, texts: int, places: int) -> np.ndarray:
    """Signatures (texts x places) of the sets that (owner, h) spell out; rows
    of texts without elements stay at the greatest value."""
    top = np.iinfo(np.uint64).max
    sig = np.full(texts * places, top, np.uint64)
    owner = owner.astype(np.int64)
    rank, seat = 0, None
    while len(h) and rank < places:
        draw = mix64(h + np.uint64((2 * rank + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        pick = rank + ((draw >> np.uint64(40)) * np.uint64(places - rank) >> np.uint64(24)).astype(np.int64)
        fraction = draw & np.uint64((1 << 40) - 1)
        if seat is None:
            place = pick
        else:
            row = np.arange(len(h))
            place = seat[row, pick].astype(np.int64)
            seat[row, pick] = seat[:, rank]
        np.minimum.at(sig, owner * places + place, np.uint64(rank << 40) | fraction)
        # a text goes on only while a later rank could win a place
        going = (sig.reshape(texts, places).max(axis=1) >= np.uint64(rank + 1 << 40))[owner]
        if seat is None:
            owner, h, pick = owner[going], h[going], pick[going]
            seat = np.tile(np.arange(places, dtype=np.uint16), (len(h), 1))
            seat[np.arange(len(h)), pick] = 0
        elif not going.all():
            owner, h, seat = owner[going], h[going], seat[going]
        rank += 1
    return sig.reshape(texts, places)


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One bucket key per band (texts x bands)."""
    out = np.zeros((len(sig), bands), np.uint64)
    for r in range(rows):
        out = out * ODD + sig[:, r::rows][:, :bands]
    return mix64(out + np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def set_digest(owner: np.ndarray, h: np.ndarray, texts: int) -> np.ndarray:
    """A 64-bit digest of each text's set."""
    out = np.zeros(texts, np.uint64)
    np.add.at(out, owner, mix64(h ^ np.uint64(0x5851F42D4C957F2D)))
    np.add.at(out, owner, np.uint64(1))
    return mix64(out)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def signatures(docs: DataFrame, words: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(node, n, cls, keys): document, set size, digest of its set, bucket keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            node = b.column(0)
            data, off = utf8(b.column(1))
            for i, j in chunks(off):
                owner, h = shingles(data[off[i]:off[j]], off[i:j + 1] - off[i], words)
                n = np.bincount(owner, minlength=j - i)
                keys = signed(band_keys(super_minhash(owner, h, j - i, bands * rows), bands, rows))
                keys = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.where(n > 0, bands, 0))]), pa.int32()),
                                                pa.array(keys[n > 0].ravel(), pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [node.slice(i, j - i), pa.array(n, pa.int64()), pa.array(signed(set_digest(owner, h, j - i)), pa.int64()), keys],
                    ["node", "n", "cls", "keys"])

    rows_ = id_text(docs).select(F.coalesce("doc_id", F.lit(NOBODY)).alias("node"), "text")
    return rows_.mapInArrow(run, "node long, n long, cls long, keys array<long>")


def _spared(table: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """Rows of ``table`` whose ``column`` may be in ``wanted`` (one column):
    only FILTER bits are broadcast, whatever the input."""
    return thin(table, [column], wanted.select(F.col(wanted.columns[0]).alias(column)), FILTER)


def full_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(cls, hashes): the full sets, sorted 64-bit shingle hashes, of the
    classes in ``wanted`` (cls, rep)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = utf8(b.column(1))
            for i, j in chunks(off):
                owner, h = shingles(data[off[i]:off[j]], off[i:j + 1] - off[i], words)
                digest = signed(set_digest(owner, h, j - i))
                bounds = np.searchsorted(owner, np.arange(j - i + 1))
                sets = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(signed(h), pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(digest, pa.int64()), sets], ["cls", "hashes"])

    ids = wanted.select(F.col("rep").alias("node")).distinct()
    rows = id_text(docs).select(F.coalesce("doc_id", F.lit(NOBODY)).alias("node"), "text")
    texts = _spared(rows, "node", ids).join(ids, "node", "left_semi").select("node", "text")
    # another text under the same doc_id may be of a class of its own
    return texts.mapInArrow(run, "cls long, hashes array<long>").join(wanted.select("cls"), "cls", "left_semi").dropDuplicates(["cls"])


def shared_sizes(sets: DataFrame) -> DataFrame:
    """(cls, n, e): set size and how many of its shingles another set has, too."""
    alone = (sets.select(F.explode("hashes").alias("h"), "cls").groupBy("h")
             .agg(F.count(F.lit(1)).alias("k"), F.min("cls").alias("cls")).where("k = 1").groupBy("cls").agg(F.count(F.lit(1)).alias("own")))
    return (sets.select("cls", F.size("hashes").cast("long").alias("n")).join(alone, "cls", "left")
            .select("cls", "n", (F.col("n") - F.coalesce("own", F.lit(0))).alias("e")))


def linked(pairs: DataFrame, sets: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """Pairs (a, b) of classes with the size of their intersection and whether
    denominator * |A and B| >= numerator * |A or B|, on full sets.  The set of
    ``a`` goes once to each task that compares with it; a hub with many
    partners gets several tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, own = None, None
        for batch in batches:
            found = []
            column = batch.column(3)
            values, bounds = column.values.to_numpy(), column.offsets.to_numpy()
            for a, b, i, j in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), bounds[:-1], bounds[1:]):
                other = values[i:j]
                if b is None:
                    hub, own = a, other.copy()
                    continue
                if hub != a:
                    raise ValueError("a comparison without its hub")
                both = len(np.intersect1d(own, other, assume_unique=True))
                found.append((a, b, both, denominator * both >= numerator * (len(own) + len(other) - both)))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], k) for i, k in enumerate(kinds)], ["a", "b", "both", "link"])

    # a hub may hold a third of all pairs: only its parts, SPREAD at most, meet the number of its salts
    split = pairs.withColumn("part", F.pmod(F.xxhash64("b", F.lit(1)), F.lit(SPREAD)).cast("int"))
    parts = split.groupBy("a", "part").agg(F.count(F.lit(1)).alias("k"))
    per_hub = parts.groupBy("a").agg(F.ceil(F.sum("k") / F.lit(PER_SALT)).cast("int").alias("salts"))
    members = (split.join(parts.select("a", "part").join(per_hub, "a"), ["a", "part"])
               .withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int"))
               .join(sets, F.col("b") == F.col("cls")).select("a", "salt", "b", "hashes"))
    hubs = (per_hub.join(sets, F.col("a") == F.col("cls"))
            .select("a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(None).cast("long").alias("b"), "hashes"))
    both = members.unionByName(hubs).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return both.mapInArrow(run, "a long, b long, both long, link boolean")


def _labelled(classes: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``classes`` with ``grp``, the group that links found so far give."""
    if labels is None:
        return classes.withColumn("grp", F.col("rep"))
    return (classes.join(labels.select(F.col("node").alias("rep"), F.col("component").alias("_c")), "rep", "left")
            .withColumn("grp", F.coalesce("_c", "rep")).drop("_c"))


def group_documents(docs: DataFrame, words: int = WORDS, numerator: int = NUMERATOR, denominator: int = DENOMINATOR,
                    bands: int = BANDS, rows: int = ROWS, hubs: int = HUBS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept, class_id
    (documents with equal sets share it)."""
    sig = cut(signatures(docs, words, bands, rows))
    full = sig.where("n > 0")
    classes = cut(full.groupBy("cls").agg(F.min("node").alias("rep"), F.first("n").alias("n"), F.first("keys").alias("keys")))
    member = full.select("node", "cls").join(classes.select("cls", "rep"), "cls")
    # a doc_id with several texts joins their classes, each through its first
    # document; ids whose texts are all of one class need no link
    several = member.groupBy("node").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a != b").select("node")
    links = _spared(member.where("node != rep"), "node", several).select(F.col("node").alias("u"), F.col("rep").alias("v")).distinct()
    buckets = classes.select(F.explode("keys").alias("key"), "cls")
    crowded = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("key")
    seats = cut(buckets.join(crowded, "key"))
    rep = classes.select("cls", "rep")
    sets = cut(full_sets(docs, rep.join(seats.select("cls").distinct(), "cls", "left_semi"), words))
    # a class that shares too few shingles with any other is in no pair
    able = cut(shared_sizes(sets).where(F.col("e") * denominator >= F.col("n") * numerator))
    seats = seats.join(able, "cls")
    # the first to be compared is one that shares the greatest part of itself
    first = (seats.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.max(F.struct((F.col("e") / F.col("n")).alias("part"), "cls", "n", "e")).alias("h"))
             .where("size > 1").select("key", "h"))
    seats = cut(seats.join(first, "key"))

    met = cut(linked(cut(seats.where("cls != h.cls").select(F.col("h.cls").alias("a"), F.col("cls").alias("b")).distinct()),
                     sets, numerator, denominator))
    # i: what a member shares with its bucket's first
    seats = cut(seats.withColumn("a", F.col("h.cls")).join(met.select("a", F.col("b").alias("cls"), "both"), ["a", "cls"], "left")
                .select("key", "cls", "n", "e", F.coalesce("both", "e").alias("i")))
    labels = None
    while True:
        new = (met.where("link").join(rep.select(F.col("cls").alias("a"), F.col("rep").alias("u")), "a")
               .join(rep.select(F.col("cls").alias("b"), F.col("rep").alias("v")), "b").select("u", "v"))
        labels = cut(components(links.union(new) if labels is None else labels.select("node", "component").union(new)))
        mixed = seats.join(_labelled(rep, labels).select("cls", "grp"), "cls")
        unlike = mixed.groupBy("key").agg(F.min("grp").alias("x"), F.max("grp").alias("y")).where("x != y").select("key")
        mixed = cut(mixed.join(unlike, "key", "left_semi"))
        hub = cut(choose_hubs(mixed, hubs))
        if not hub.limit(1).count():
            break
        most = F.expr("least(m.i, h.i) + least(m.e - m.i, h.e - h.i)")  # shingles that the two may share
        could = most * (numerator + denominator) >= F.expr("m.n + h.n") * numerator
        # of the buckets that a pair shares only the first emits it
        keys = classes.select("cls", "keys")
        once = F.expr("array_intersect(m.keys, h.keys)[0] = m.key")
        pairs = cut(mixed.join(keys, "cls").alias("m").join(hub.join(keys, "cls").alias("h"), F.expr("m.key = h.key and m.grp != h.grp") & could & once)
                    .select(F.least("m.cls", "h.cls").alias("a"), F.greatest("m.cls", "h.cls").alias("b")).distinct())
        met = linked(pairs, sets, numerator, denominator)
        # a hub has met the whole bucket and leaves it
        seats = cut(mixed.drop("grp").join(hub.select("key", "cls"), ["key", "cls"], "left_anti"))
    return _result(docs, sig, classes, labels)


def choose_hubs(seats: DataFrame, hubs: int) -> DataFrame:
    """Up to ``hubs`` members per bucket from outside its largest group, the
    smallest groups first; none once every bucket is of one group."""
    share = seats.groupBy("key", "grp").agg(F.count(F.lit(1)).alias("size"))
    largest = share.groupBy("key").agg(F.max(F.struct("size", "grp")).alias("m")).select("key", F.col("m.grp").alias("most"))
    outside = seats.join(share, ["key", "grp"]).join(largest, "key").where("grp != most")
    rank = F.row_number().over(W.partitionBy("key").orderBy("size", "cls"))
    return outside.withColumn("_rank", rank).where(F.col("_rank") <= hubs).select("key", "cls", "grp", "n", "e", "i")


def _result(docs: DataFrame, sig: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    grouped = _labelled(classes.select("cls", "rep"), labels)
    out = (sig.select("node", "n", "cls").join(grouped, "cls", "left")
           .withColumn("grp", F.when(F.col("n") > 0, F.col("grp")).otherwise(F.col("node"))))
    return out.select(
        F.nullif(F.col("node"), F.lit(NOBODY)).alias("doc_id"), F.col("n").alias("n_shingles"),
        F.nullif(F.col("grp"), F.lit(NOBODY)).alias("component_id"), (F.col("node") == F.col("grp")).alias("kept"),
        F.when(F.col("n") > 0, F.col("cls")).alias("class_id"))


def keep_one(docs: DataFrame, words: int = WORDS, numerator: int = NUMERATOR, denominator: int = DENOMINATOR) -> DataFrame:
    """One row of each group of alike texts, all columns as they were: the one
    with the least doc_id, of its texts the one with the least hash.  Here a
    row, not a doc_id, is a document: texts that only share a doc_id are not
    alike and stay, and so does one row of each doc_id with a text without
    words.  Rows without a doc_id come before all others, and of a group's
    only one stays, too; rows equal in doc_id and text are one."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.withColumn("_row", F.xxhash64(F.col("doc_id").cast("long"), text))
    alike = group_documents(keyed.select(F.col("_row").alias("doc_id"), "text"), words, numerator, denominator)
    group = alike.select(F.col("doc_id").alias("_row"), F.col("component_id").alias("_group")).distinct()
    # ids and hashes only: the least of each group, a null id before all others
    ids = keyed.select("_row", F.coalesce(F.col("doc_id").cast("long"), F.lit(NOBODY)).alias("_id")).distinct()
    stay = ids.join(group, "_row").groupBy("_group").agg(F.min(F.struct("_id", "_row")).alias("_least")).select("_least._row")
    # one row each before the join, so that a row repeated without end is cut down inside each task
    first = keyed.withColumn("_rank", F.row_number().over(W.partitionBy("_row").orderBy("text"))).where("_rank = 1")
    return first.join(stay, "_row", "left_semi").select(*docs.columns)

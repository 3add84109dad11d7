"""Exploratory corpus statistics (I1-I13) as DataFrames (plot data only).

Everything is an aggregation over long tables; the two pairwise
statistics are bounded by construction: co-occurrence is restricted to
the top-k features *before* the self-join (at most k^2/2 pairs per
document), and document distance is computed only for a given table of
document pairs via a sparse join on the feature.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkngram.operators.ngrams import top_by_group

# Features whose names may be broadcast.
NAMED_FEATURES = 500_000
LOW = (1 << 32) - 1


def top_log(counts: DataFrame, k: int = 30) -> DataFrame:
    """Top-k n-grams per order with rank and log10 frequency."""
    t = top_by_group(counts, ["n"], [F.col("freq").desc(), F.col("word").asc()], k)
    return t.select("n", "rnk", "word", "freq", F.log10("freq").alias("log10_freq"))


def freq_spectrum(counts: DataFrame) -> DataFrame:
    """Every (order, count r, number of types with count r) with logs."""
    s = counts.groupBy("n", F.col("freq").alias("r")).agg(F.count(F.lit(1)).alias("n_r"))
    return s.select("n", "r", "n_r", F.log10("r").alias("log10_r"), F.log10("n_r").alias("log10_n_r"))


def top_features_by_group(d: DataFrame, group: str, k: int = 100) -> DataFrame:
    """Top-k features per group (comparison cloud data)."""
    f = d.groupBy(group, "feature").agg(F.sum("count").alias("freq"))
    return top_by_group(f, [group], [F.col("freq").desc(), F.col("feature").asc()], k)


def text_frequency(d: DataFrame, doc: str, k: int = 15) -> DataFrame:
    """Feature, frequency, rank, document frequency for the top k."""
    f = d.groupBy("feature").agg(F.sum("count").alias("frequency"), F.count(F.lit(1)).alias("docfreq"))
    t = f.orderBy(F.col("frequency").desc(), F.col("feature").asc()).limit(k)
    from pyspark.sql.window import Window
    return t.withColumn("rank", F.row_number().over(Window.orderBy(F.col("frequency").desc(), F.col("feature").asc())))


def cooccurrence(d: DataFrame, doc: str, k: int = 50) -> DataFrame:
    """I6 + I7: document co-occurrence ``sum_d x_d,f1 * x_d,f2`` (f1 < f2)
    among the k most frequent features."""
    topf = d.groupBy("feature").agg(F.sum("count").alias("freq")) \
        .orderBy(F.col("freq").desc(), F.col("feature").asc()).limit(k).select("feature")
    x = d.join(F.broadcast(topf), "feature", "left_semi")  # k rows: bounded broadcast
    a = x.select(doc, F.col("feature").alias("f1"), F.col("count").alias("c1"))
    b = x.select(doc, F.col("feature").alias("f2"), F.col("count").alias("c2"))
    return a.join(b, doc).where(F.col("f1") < F.col("f2")).groupBy("f1", "f2").agg(
        F.sum(F.col("c1") * F.col("c2")).alias("count"))


def _cell_sums(batches: Iterator[pa.RecordBatch], one: int, two: int, blocks: int, width: int) -> Iterator[pa.RecordBatch]:
    """(i1, i2, count) of the cell of blocks ``one`` and ``two`` from the rows
    (l, r), what a document has of either, summed in a table of width**2 numbers."""
    sums = None
    for b in batches:
        l, r = ((c.flatten().to_numpy(), c.offsets.to_numpy() - c.offsets[0].as_py()) for c in (b.column(0), b.column(1)))
        if sums is None:
            sums = np.zeros((width, width), np.int64)
            flat = sums.reshape(-1)
        for k in range(b.num_rows):
            x, y = (v[o[k]:o[k + 1]] for v, o in (l, r))
            for i in range(0, len(x) if len(y) else 0, 256):  # features of a document are distinct: no sum is met twice
                p = x[i:i + 256]
                flat[((p >> 32) // blocks * width)[:, None] + (y >> 32) // blocks] += (p & LOW)[:, None] * (y & LOW)
    for at in range(0, width if sums is not None else 0, 64):
        x, y = np.nonzero(np.triu(sums[at:at + 64], at + 1) if one == two else sums[at:at + 64])
        if len(x):
            i, j = (x + at) * blocks + one, y * blocks + two
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(i, j)), pa.array(np.maximum(i, j)), pa.array(sums[x + at, y])], ["i1", "i2", "count"])


def full_cooccurrence(d: DataFrame, doc: str, min_freq: int = 1, min_count: int = 1, block: int = 4096) -> DataFrame:
    """``(f1, f2, count)`` for all pairs f1 < f2 of features with a total
    count of at least ``min_freq``, ``count = sum_d x_d,f1 * x_d,f2``.

    The features are numbered by name and dealt into blocks of about ``block``.
    The documents are written once, with a column per block.  A pair of blocks
    is a cell, one task that reads its two columns: nothing is shuffled for it,
    however many cells there are.  All pairs of a cell are summed where they are
    made, at most block**2 sums.  With
    ``min_count`` only pairs of that count are wanted: as ``count**2 <= S_f1 *
    S_f2`` with ``S_f = sum_d x_d,f**2``, features whose bound with the greatest
    S falls short are dropped first, which loses no pair."""
    from sparkngram.operators.ranking import global_rank
    from sparkngram.plans.joins import kept
    total = d.groupBy("feature").agg(F.sum("count").alias("freq"), F.sum(F.col("count") * F.col("count")).alias("s")).where(F.col("freq") >= min_freq)
    if min_count > 1:
        most = total.agg(F.max("s").alias("_most"))  # one row
        total = total.crossJoin(F.broadcast(most)).where(F.col("s").cast("double") * F.col("_most") >= float(min_count) ** 2)
    ids = global_rank(total.select("feature"), [F.col("feature").asc()], "place").select("feature", (F.col("place") - 1).alias("id"))
    n = ids.count()
    blocks = max(1, -(-n // block))
    small = F.broadcast if n <= NAMED_FEATURES else lambda t: t
    # a feature of a document is one number, its id above its count
    x = d.join(small(ids), "feature").select(doc, (F.col("id") % blocks).cast("int").alias("b"), F.shiftleft("id", 32).bitwiseOR(F.col("count")).alias("v"))
    held = kept(x.repartition(doc).groupBy(doc).agg(*[F.collect_list(F.when(F.col("b") == k, F.col("v"))).alias(f"v{k}") for k in range(blocks)]).drop(doc))

    def cell(one: int, two: int) -> DataFrame:
        rows = held.select(F.col(f"v{one}").alias("l"), F.col(f"v{two}").alias("r")).where((F.size("l") > 0) & (F.size("r") > 0))
        return rows.coalesce(1).mapInArrow(lambda it: _cell_sums(it, one, two, blocks, -(-n // blocks)), "i1 long, i2 long, count long")

    # a union of single partitions alone would be one partition: the first of its members has none of its rows, but two
    cells = [d.sparkSession.range(0, 0, 1, 2).select(*[F.col("id").alias(c) for c in ("i1", "i2", "count")])]
    cells += [cell(one, two) for one in range(blocks) for two in range(one, blocks)]
    while len(cells) > 1:  # pairwise: a plan that is not deep
        cells = [a.unionByName(b[0]) if b else a for a, *b in (cells[k:k + 2] for k in range(0, len(cells), 2))]
    sums = cells[0].where(F.col("count") >= min_count)
    name = lambda t, i: small(ids.select(F.col("feature").alias(t), F.col("id").alias(i)))
    return sums.join(name("f1", "i1"), "i1").join(name("f2", "i2"), "i2").select("f1", "f2", "count")


def feature_sizes(d: DataFrame, k: int = 50, scale: float = 3.0) -> DataFrame:
    """``log(freq) / max(log(freq)) * scale`` for the top-k features."""
    topf = d.groupBy("feature").agg(F.sum("count").alias("freq")) \
        .orderBy(F.col("freq").desc(), F.col("feature").asc()).limit(k)
    mx = topf.agg(F.max(F.log("freq")).alias("_mx"))
    return topf.crossJoin(F.broadcast(mx)).select("feature", "freq", (F.log("freq") / F.col("_mx") * F.lit(scale)).alias("size"))


def type_token_ratio(d: DataFrame, doc: str) -> DataFrame:
    """Distinct features / tokens per document."""
    return d.groupBy(doc).agg((F.count(F.lit(1)) / F.sum("count")).alias("ttr"),
                              F.count(F.lit(1)).alias("types"), F.sum("count").alias("tokens"))


def keyness(d: DataFrame, flag: str) -> DataFrame:
    """Signed chi-square with Yates' correction, target (flag true)
    vs reference documents, per feature."""
    f = d.groupBy("feature").agg(F.sum(F.when(F.col(flag), F.col("count")).otherwise(0)).alias("a"),
                                 F.sum(F.when(~F.col(flag), F.col("count")).otherwise(0)).alias("b"))
    tot = d.agg(F.sum(F.when(F.col(flag), F.col("count")).otherwise(0)).alias("ta"),
                F.sum(F.when(~F.col(flag), F.col("count")).otherwise(0)).alias("tb"))
    x = f.crossJoin(F.broadcast(tot)).select("feature", "a", "b", (F.col("ta") - F.col("a")).alias("c"),
                                             (F.col("tb") - F.col("b")).alias("dd"))
    a, b, c, dd = (F.col(k).cast("double") for k in ("a", "b", "c", "dd"))
    n = a + b + c + dd
    num = n * F.pow(F.greatest(F.abs(a * dd - b * c) - n / 2, F.lit(0.0)), 2)
    den = (a + b) * (c + dd) * (a + c) * (b + dd)
    chi = F.try_divide(num, den)
    sign = F.when(a * dd >= b * c, F.lit(1.0)).otherwise(F.lit(-1.0))
    return x.select("feature", F.col("a").alias("n_target"), F.col("b").alias("n_reference"), (sign * chi).alias("chi2"))


def collocations(counts: DataFrame, min_count: int = 100) -> DataFrame:
    """Two-word collocations with log odds ratio ``lambda`` (0.5
    smoothing) and ``z = lambda / sigma``.  ``counts`` is read four times:
    pass a stored table."""
    big = counts.where(F.col("n") == 2).select("word", "w", "pred", F.col("freq").alias("n11"))
    # only pairs that reach min_count meet their marginals
    x = big.where(F.col("n11") >= F.lit(min_count))
    x = x.join(big.groupBy("w").agg(F.sum("n11").alias("r1")), "w")
    x = x.join(big.groupBy("pred").agg(F.sum("n11").alias("c1")), "pred")
    tot = big.agg(F.sum("n11").alias("N"))  # one row
    x = x.crossJoin(F.broadcast(tot))
    n11 = F.col("n11") + 0.5
    n12 = F.col("r1") - F.col("n11") + 0.5
    n21 = F.col("c1") - F.col("n11") + 0.5
    n22 = F.col("N") - F.col("r1") - F.col("c1") + F.col("n11") + 0.5
    lam = F.log(n11) + F.log(n22) - F.log(n12) - F.log(n21)
    sig = F.sqrt(1 / n11 + 1 / n12 + 1 / n21 + 1 / n22)
    return x.select(F.regexp_replace("word", "_", " ").alias("collocation"), F.col("n11").alias("count"),
                    lam.alias("lambda"), (lam / sig).alias("z"))


def doc_distance(d: DataFrame, pairs: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Euclidean distance on counts for the document pairs in
    ``pairs(doc_a, doc_b)``: ``sqrt(|x|^2 + |y|^2 - 2 x.y)`` with the dot
    product from a sparse join on (document pair, feature)."""
    sq = d.groupBy(doc).agg(F.sum(F.col("count") * F.col("count")).alias("sq"))
    xa = d.select(F.col(doc).alias("doc_a"), "feature", F.col("count").alias("ca"))
    xb = d.select(F.col(doc).alias("doc_b"), "feature", F.col("count").alias("cb"))
    dot = pairs.join(xa, "doc_a").join(xb, ["doc_b", "feature"]).groupBy("doc_a", "doc_b").agg(
        F.sum(F.col("ca") * F.col("cb")).alias("dot"))
    out = (pairs.join(dot, ["doc_a", "doc_b"], "left")
           .join(sq.select(F.col(doc).alias("doc_a"), F.col("sq").alias("sa")), "doc_a", "left")
           .join(sq.select(F.col(doc).alias("doc_b"), F.col("sq").alias("sb")), "doc_b", "left"))
    val = F.coalesce("sa", F.lit(0)) + F.coalesce("sb", F.lit(0)) - 2 * F.coalesce("dot", F.lit(0))
    return out.select("doc_a", "doc_b", F.sqrt(F.greatest(val.cast("double"), F.lit(0.0))).alias("distance"))


# Distances that one Arrow batch of a task may hold.
DISTANCE_ROWS = 1 << 17


def _block_distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (at, docs, asks), a block of documents (its number, lists of name,
    sq and v) with one of queries: the distance of every query to every
    document, through the documents' postings (ids in order), which are made
    once for the rows in a row that have the same documents."""
    def lists(column):
        rows = column.values
        names, own, v = rows.field("name"), rows.field("sq").to_numpy(zero_copy_only=False), rows.field("v")
        return column.offsets.to_numpy(), names, own, v.offsets.to_numpy(), v.values.to_numpy(zero_copy_only=False)

    last, index, met = None, None, []

    def emit():
        docs = index[0]
        out = pa.RecordBatch.from_arrays([pa.concat_arrays([m[0] for m in met]).take(pa.array(np.repeat(np.arange(len(met)), len(docs)))),
                                          pa.concat_arrays([docs] * len(met)), pa.array(np.concatenate([m[1] for m in met]))], names=["query", "doc", "distance"])
        met.clear()
        return out

    for batch in batches:
        at = batch.column("at").to_numpy()
        ends, names, own, vends, flat = lists(batch.column("docs"))
        qends, qnames, qown, qvends, qflat = lists(batch.column("asks"))
        for r in range(batch.num_rows):
            if index is None or at[r] != last:
                if met:
                    yield emit()
                i, j = ends[r], ends[r + 1]
                every = flat[vends[i]:vends[j]]
                order = np.argsort(every >> 32, kind="stable")
                ids, start, size = np.unique((every >> 32)[order], return_index=True, return_counts=True)
                who = np.repeat(np.arange(j - i), np.diff(vends[i:j + 1]))[order]
                index = (names.slice(i, j - i), own[i:j].copy(), ids, start, size, who, (every & LOW)[order])
                last = at[r]
            docs, squares, ids, start, size, who, counts = index
            for k in range(qends[r], qends[r + 1]):
                part, dot = qflat[qvends[k]:qvends[k + 1]], np.zeros(len(squares))
                if len(ids) and len(part):
                    place = np.minimum(np.searchsorted(ids, part >> 32), len(ids) - 1)
                    hit = ids[place] == part >> 32
                    place, mine = place[hit], (part & LOW)[hit]
                    run = np.repeat(start[place] - np.cumsum(size[place]) + size[place], size[place]) + np.arange(size[place].sum())
                    dot = np.bincount(who[run], weights=counts[run] * np.repeat(mine, size[place]), minlength=len(squares))
                met.append((qnames.slice(k, 1), np.sqrt((squares + qown[k]) - 2 * dot)))
                if len(met) * len(squares) >= DISTANCE_ROWS:
                    yield emit()
    if met:
        yield emit()


def pairwise_distance(d: DataFrame, queries: DataFrame, doc: str = "doc_id", block: int = 1000, hot_rows: int | None = None) -> DataFrame:
    """``(query, doc, distance)``, the Euclidean distance on counts of
    every document of ``queries`` (one column) to every document of ``d``.

    The features are numbered by name.  Documents and queries are written once,
    ``block`` of them to a row, about.  Every row of the one table meets every
    row of the other by a cross join, which shuffles neither, and pairs are made
    where they meet.  There queries pass one by one over the documents'
    postings, so a feature of many documents has no task of its own, and
    ``hot_rows`` changes nothing.  Sums are whole numbers, exact up to 2**53."""
    from sparkngram.operators.ranking import global_rank
    from sparkngram.plans.joins import dropped, kept
    tasks = int(d.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = global_rank(d.select("feature").distinct(), [F.col("feature").asc()], "place").select("feature", (F.col("place") - 1).alias("id"))
    q = queries.select(F.col(queries.columns[0]).alias("name")).distinct()
    small = F.broadcast if ids.count() <= NAMED_FEATURES else lambda t: t
    held = kept(d.join(small(ids), "feature").groupBy(F.col(doc).alias("name"))
                .agg(F.sum(F.col("count") * F.col("count")).cast("long").alias("sq"), F.collect_list(F.shiftleft("id", 32).bitwiseOR(F.col("count"))).alias("v")))
    asking = q.join(held, "name", "left").select("name", F.coalesce("sq", F.lit(0)).cast("long").alias("sq"), F.coalesce("v", F.array().cast("array<bigint>")).alias("v"))

    def blocks(t: DataFrame, as_: str) -> DataFrame:
        n = max(1, -(-t.count() // block))
        x = t.withColumn("at", F.pmod(F.xxhash64("name"), F.lit(n)).cast("int")).repartition(min(n, max(tasks, -(-n // 8))), "at")  # few rows to a file
        return kept(x.groupBy("at").agg(F.collect_list(F.struct("name", "sq", "v")).alias(as_)))

    docs, asks = blocks(held, "docs"), blocks(asking, "asks").drop("at")
    dropped(held)
    kind = held.schema["name"].dataType.simpleString()
    return docs.crossJoin(asks).mapInArrow(_block_distances, f"query {kind}, doc {kind}, distance double")


def group_max(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Per-group maximum ignoring nulls, null when all are null."""
    return df.groupBy(*group).agg(F.max(value).alias(f"max_{value}"))

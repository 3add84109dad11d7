"""N-gram extraction and counting.

All orders are produced in **one** pass over the token arrays (a nested
``transform`` + one ``explode``) and counted in **one** aggregation keyed
by ``(n, word)``; partial aggregation runs before the shuffle, so a hot
n-gram costs one row per map task, not one row per occurrence.

Where every occurrence counts and the tokens come from a split, a position
sends one row instead of one per order (``count_windows``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SEP = "_"


def ngram_structs(tokens: Column, orders: Sequence[int], sep: str = SEP, distinct: bool = False) -> Column:
    """``array<struct<n int, word string>>`` of all contiguous n-grams of
    the given orders inside one token array (an order longer than the
    array contributes nothing); ``distinct``: each of them once."""
    orders = sorted(set(int(o) for o in orders))
    t = tokens

    def one_order(n: int) -> Column:
        cnt = F.size(t) - F.lit(n) + F.lit(1)
        words = F.transform(F.sequence(F.lit(1), F.greatest(cnt, F.lit(1))), lambda i: F.array_join(F.slice(t, i, F.lit(n)), sep))
        if distinct:  # of strings, which are hashed; structs would be compared with each other
            words = F.array_distinct(words)
        return F.when(cnt >= 1, F.transform(words, lambda w: F.struct(F.lit(n).alias("n"), w.alias("word")))
                      ).otherwise(F.array().cast("array<struct<n:int,word:string>>"))

    return F.flatten(F.array(*[one_order(n) for n in orders]))


def explode_ngrams(df: DataFrame, tokens_col: str, orders: Sequence[int], keep: Sequence[str] = (),
                   distinct_per_row: bool = False, sep: str = SEP) -> DataFrame:
    """One row per n-gram occurrence: ``keep`` + ``n`` + ``word``.

    ``distinct_per_row`` counts an n-gram once per row (document frequency).
    """
    arr = ngram_structs(F.col(tokens_col), orders, sep, distinct_per_row)
    return (df.where(F.size(tokens_col) > 0)
            .select(*keep, F.explode(arr).alias("g"))
            .select(*keep, F.col("g.n").alias("n"), F.col("g.word").alias("word")))


def count_ngrams(df: DataFrame, tokens_col: str = "tokens", orders: Sequence[int] = (1, 2, 3, 4),
                 doc_freq: bool = False, min_freq: int = 1) -> DataFrame:
    """E1+E2 (+E3 with ``doc_freq``) + E4 + E5: ``(n, word, w, pred, freq)``.

    ``w`` is the prefix (first n-1 words, ``''`` for unigrams) and ``pred``
    the last word.  ``min_freq`` is the trim threshold (5 = "freq > 4").
    """
    g = explode_ngrams(df, tokens_col, orders, distinct_per_row=doc_freq)
    counts = g.groupBy("n", "word").agg(F.count(F.lit(1)).alias("freq"))
    if min_freq > 1:
        counts = counts.where(F.col("freq") >= F.lit(min_freq))
    return split_prefix(counts)


def _new_windows(at: Sequence[str], sep: str) -> Column:
    """``array<struct<mark int, win string>>``: a row's distinct windows, from
    its tokens and the columns that follow each of them (``at``).  Sorted, the
    windows that start with an n-gram are neighbours: the first of them is new
    for it.  ``mark`` + 1 is the least order that a window is new for."""
    # a separator behind the last token, too: "a b" comes with "a b c", not apart from it by "a bc"
    win = F.array_sort(F.array_distinct(F.transform(F.arrays_zip(*at), lambda s: F.concat(F.concat_ws(sep, *[s[x] for x in at]), F.lit(sep)))))

    def marked(w: Column, before: Column) -> Column:
        mark = F.lit(len(at) - 1)
        for n in reversed(range(1, len(at))):
            mark = F.when(F.substring_index(w, sep, n) == F.substring_index(before, sep, n), mark).otherwise(F.lit(n - 1))
        return F.struct(mark.alias("mark"), F.rtrim(w, F.lit(sep)).alias("win"))

    return F.zip_with(win, F.slice(F.concat(F.array(F.lit("")), win), F.lit(1), F.size(win)), marked)


def count_windows(df: DataFrame, tokens_col: str, orders: Sequence[int], sep: str = SEP, marks: tuple[str, int] | None = None,
                  min_freq: int = 1, partitions: int | None = None, once: bool = False, part: tuple[int, int] | None = None) -> DataFrame:
    """``(n, word, freq)`` as ``count_ngrams`` has them, for tokens that do not
    hold ``sep`` (cleaning leaves none).

    A position sends its window, the next ``max(orders)`` tokens or what the
    row has left, to the task of the window's first two tokens; there every
    n-gram of two tokens or more is a prefix of windows that are all in place.
    Equal windows are summed first, then sorted once: each shorter n-gram's
    windows are neighbours, and the first of them brings its total.
    Single tokens are summed over the tasks, a row per task and token.
    ``marks``: a column of ``df`` of 0 to k - 1, and k; then f0 to f(k-1) stand
    for freq, of which fj counts the rows marked j or less.  ``min_freq`` is the
    trim threshold: rows whose freq (any of f0 to f(k-1)) reaches it are kept.
    ``partitions``: into how many the windows go (default: as the session has it).
    ``once``: an n-gram counts once per row (document frequency).
    ``part`` (k, of): only the n-grams whose first token's hash falls to the k-th
    of so many parts, which together have all."""
    orders = sorted(set(int(o) for o in orders))
    most, t = orders[-1], F.col(tokens_col)
    if once:  # a window new for order n counts for n-grams of order n and up
        marks = ("mark", most)
    keep = [F.col(marks[0]).alias("mark")] if marks and not once else []
    names = [f"f{j}" for j in range(marks[1])] if marks else ["freq"]
    sums = [F.count(F.when(F.col("mark") <= j, 1)).alias(f"f{j}") for j in range(marks[1])] if marks else [F.count(F.lit(1)).alias("freq")]
    of = {n: [f"f{n - 1}"] if once else names for n in orders}
    shown = ["freq"] if once else names

    def reaches(totals: Sequence[Column]) -> Column:
        return (F.greatest(*totals) if len(totals) > 1 else totals[0]) >= F.lit(min_freq)

    at = [f"x{i}" for i in range(1, most + 1)]
    # rows without tokens give no windows; a filter of them would go below the cleaning and do it a second time
    win = df.select(*keep, *[(F.slice(t, F.lit(i + 1), F.size(t)) if i else t).alias(x) for i, x in enumerate(at)])
    # one column, so that both uses read the same shuffle
    mine = lambda first: F.pmod(F.xxhash64(first), F.lit(part[1])) == part[0]
    if once:
        win = win.select(F.inline(_new_windows(at, sep)))
        win = win.where(mine(F.substring_index("win", sep, 1))) if part else win
    else:
        win = win.select(*win.columns[:len(keep)], F.inline(F.arrays_zip(*at)))
        win = (win.where(mine(F.col(at[0]))) if part else win).select(*win.columns[:len(keep)], F.concat_ws(sep, *at).alias("win"))
    head = F.substring_index("win", sep, 2)
    win = win.repartition(partitions, head) if partitions else win.repartition(head)
    out = []
    if orders[0] == 1:
        out.append(win.groupBy(F.substring_index("win", sep, 1).alias("word")).agg(*sums).where(reaches([F.col(f) for f in of[1]]))
                   .select(F.lit(1).alias("n"), "word", *[F.col(f).alias(c) for f, c in zip(of[1], shown)]))
    longer = [n for n in orders if n > 1]
    if longer:
        rest = at[2:]
        x = win.select(*[c for c in win.columns if c != "win"], head.alias("head"), F.expr(f"substring(win, char_length(substring_index(win, '{sep}', 2)) + 2)").alias("tail"))
        x = x.groupBy("head", "tail").agg(*sums)
        parts = F.split(F.nullif("tail", F.lit("")), sep)
        x = x.select("head", *[F.get(parts, F.lit(i)).alias(c) for i, c in enumerate(rest)], *names).sortWithinPartitions("head", *rest)
        grams = []
        for n in longer:
            word = F.concat_ws(sep, "head", *rest[:n - 2])
            # not a filter of x: it would go below the shuffle, which then would be another than that of the single tokens
            whole = F.col("head").contains(sep) if n == 2 else F.col(rest[n - 3]).isNotNull()
            if n == most:
                totals, first = [F.col(f) for f in of[n]], F.lit(True)
            else:
                w = Window.partitionBy("head", *rest[:n - 2]).orderBy(*rest[n - 2:])
                everyone = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
                x = x.select("*", *[F.sum(f).over(everyone).alias(f"{f}_{n}") for f in of[n]], F.row_number().over(w).alias(f"row_{n}"))
                totals, first = [F.col(f"{f}_{n}") for f in of[n]], F.col(f"row_{n}") == 1
                if n == longer[0]:  # an n-gram is at least as frequent as any that it starts; later rows may bring a shorter one's total
                    x = x.where(reaches(totals))
            grams.append(F.when(first & whole & reaches(totals), F.struct(F.lit(n).alias("n"), word.alias("word"), *[c.alias(f) for c, f in zip(totals, shown)])))
        x = x.select(F.explode(F.array(*grams)).alias("g")).where("g IS NOT NULL")
        out.append(x.select("g.n", "g.word", *[F.col(f"g.{f}").alias(f) for f in shown]))
    return out[0] if len(out) == 1 else out[0].unionByName(out[1])


def split_prefix(df: DataFrame, word: str = "word", n: str = "n", sep: str = SEP) -> DataFrame:
    """E5: prefix ``w`` (all but the last word) and prediction ``pred``."""
    w = F.when(F.col(n) > 1, F.expr(f"substring_index({word}, '{sep}', {n} - 1)")).otherwise(F.lit(""))
    return df.withColumn("w", w).withColumn("pred", F.substring_index(F.col(word), sep, -1))


def merge_counts(*tables: DataFrame) -> DataFrame:
    """Merge per-source count tables by summing (union + aggregate)."""
    u = tables[0]
    for t in tables[1:]:
        u = u.unionByName(t)
    return split_prefix(u.groupBy("n", "word").agg(F.sum("freq").alias("freq")))


def merge_counts_outer(a: DataFrame, b: DataFrame) -> DataFrame:
    """E6 literal form: full outer join, NA-ignoring sum."""
    j = a.select("n", "word", F.col("freq").alias("fa")).join(
        b.select("n", "word", F.col("freq").alias("fb")), ["n", "word"], "full_outer")
    return split_prefix(j.select("n", "word", (F.coalesce("fa", F.lit(0)) + F.coalesce("fb", F.lit(0))).alias("freq")))


def ordered_counts(runs: Sequence[DataFrame], by: str = "name", apart: bool = False) -> DataFrame:
    """E8 + E9: count tables merged and put in one global order, ``(n, word,
    freq, position)`` with positions 1, 2, ... over the whole result.

    ``by="name"``: by order and n-gram (the key order of an aggregated table);
    ``by="freq"``: by frequency, greatest first, ties by order and n-gram.  The
    runs' rows are summed per n-gram, range-partitioned and sorted within the
    partitions; positions add the sizes of the partitions before.  ``apart``: the
    runs are summed already and share no n-gram, such as one run per order; then
    nothing is left to sum, and rows are shuffled once, for the order."""
    from sparkngram.operators.ranking import global_rank
    u = runs[0].select("n", "word", "freq")
    for t in runs[1:]:
        u = u.unionByName(t.select("n", "word", "freq"))
    if not apart:
        u = u.groupBy("n", "word").agg(F.sum("freq").alias("freq"))
    name = [F.col("n").asc(), F.col("word").asc()]
    if by not in ("name", "freq"):
        raise ValueError(f"no order {by}")
    return global_rank(u, name if by == "name" else [F.col("freq").desc(), *name], "position")


def freq_of_freq(counts: DataFrame, max_r: int = 7) -> DataFrame:
    """``(n, r, n_r, n_types)`` for r = 1..max_r, zero-filled, joined on
    the value r (not on position).  ``n_types`` is the number of types of
    the order.  Both inputs are tiny aggregates."""
    spark = counts.sparkSession
    per = counts.groupBy("n").agg(
        F.count(F.lit(1)).alias("n_types"),
        *[F.count(F.when(F.col("freq") == F.lit(r), 1)).alias(f"c{r}") for r in range(1, max_r + 1)])
    stacked = per.select("n", "n_types", F.explode(F.array(*[
        F.struct(F.lit(r).cast("long").alias("r"), F.col(f"c{r}").alias("n_r")) for r in range(1, max_r + 1)
    ])).alias("x"))
    del spark
    return stacked.select("n", "x.r", "x.n_r", "n_types")


def top_by_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int,
                 rank_col: str = "rnk") -> DataFrame:
    """Top-k rows per group with an explicit rank column.

    ``row_number() <= k`` is planned as a WindowGroupLimit, which keeps at
    most k rows per group *before* the shuffle, so hot groups do not skew.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= F.lit(k))

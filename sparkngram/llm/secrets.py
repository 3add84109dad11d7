"""Secret scans with corpus-wide ownership.

Base spans come from three fixed patterns.  The method judges each candidate
value over the whole corpus: the value's hash is aggregated by distinct owners
(the ``source`` of a document) and repositories (documents, told apart by
doc_id and text).  A value that several owners hold, or one owner in
WIDE_REPOSITORIES documents or more, is a widely copied example; one that a
single owner holds in fewer looks live.  It also adds spans: high-entropy
tokens (letters of both cases and digits, ENTROPY_CHARS or more) outside the
base spans that look live, kind ``entropy``.

Edge cases: a null text is the empty text; a null source is an owner of its
own, null; rows come out one for one, repeated ids included (a repeated
row counts once as a repository); other columns are ignored; an empty table
gives an empty table.  Everything is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkngram.llm.common import cut
from sparkngram.llm.spans import apart, let, matches

# The base patterns and least lengths.  The lookbehinds only
# keep a search from starting inside a run that has failed as a whole.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
ASSIGN_CHARS = 6
ENTROPY_CHARS = 28
_RUN = "A-Za-z0-9+/_-"
# a whole run of such characters that holds a digit, a capital and a small letter
ENTROPY = (rf"(?<![{_RUN}])(?=[A-Za-z+/_-]*+[0-9])(?=[a-z0-9+/_-]*+[A-Z])(?=[A-Z0-9+/_-]*+[a-z])[{_RUN}]{{{ENTROPY_CHARS},}}+")
KINDS = ("assign", "access", "hex", "entropy")
WIDE_OWNERS = 2       # owners from which on a value is a copied example
WIDE_REPOSITORIES = 10  # one owner's documents from which on it is, too
SALTS = 16
_SPAN = "array<struct<start: int, kind: int, end: int, value: string>>"


def _spans(found: Column, kind: int, value: str = "value") -> Column:
    return F.transform(found, lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end"),
                                                 x[value].alias("value")))


def base_spans(text: Column) -> Column:
    """Base spans by start, then kind."""
    assign = F.filter(matches(text, ASSIGN, 1, (":", "=")), lambda x: F.char_length(x["part"]) >= ASSIGN_CHARS)
    return F.array_sort(F.concat(_spans(assign, 0, "part"), _spans(matches(text, ACCESS, needs=("AKIA",)), 1), _spans(matches(text, HEX), 2)).cast(_SPAN))


def entropy_spans(text: Column, base: Column) -> Column:
    """High-entropy tokens that no base span touches."""
    return let(base, lambda b: apart(_spans(matches(text, ENTROPY), 3).cast(_SPAN), b))


def candidates(docs: DataFrame) -> DataFrame:
    """(row, doc_id, owner, base, more): the candidate spans of each row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("owner"),
                       F.xxhash64(text).alias("text_hash"), text.alias("text"))
    rows = rows.withColumn("base", base_spans(F.col("text")))
    return rows.select("doc_id", "owner", "text_hash", "base", entropy_spans(F.col("text"), F.col("base")).alias("more"))


def ownership(found: DataFrame) -> DataFrame:
    """(hash, n_owners, n_repositories) of each candidate value: distinct
    owners and documents, counted pair by pair first, so that a value in a
    third of all rows is summed up before it meets itself."""
    values = found.select("owner", "doc_id", "text_hash", F.explode(F.concat("base", "more")).alias("s"))
    pairs = values.select(F.xxhash64("s.value").alias("hash"), "owner", "doc_id", "text_hash").distinct()
    by_owner = pairs.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("docs"))
    return by_owner.groupBy("hash").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("docs").alias("n_repositories"))


def digest(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"),
                                                                 x["end"].cast("string"))), ",")


def scan(docs: DataFrame, wide_owners: int = WIDE_OWNERS, wide_repositories: int = WIDE_REPOSITORIES) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, and
    n_live and n_example, the spans whose value looks live or is an example."""
    found = cut(candidates(docs))  # one pass over the texts; the candidates are few
    own = ownership(found)
    some = F.size(F.concat("base", "more")) > 0
    spread = own.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    each = (found.where(some).select("doc_id", "owner", "text_hash", F.explode(F.concat("base", "more")).alias("s"))
            .withColumn("hash", F.xxhash64("s.value")).withColumn("salt", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(SALTS)).cast("int"))
            .join(spread, ["hash", "salt"]))
    live = (F.col("n_owners") < wide_owners) & (F.col("n_repositories") < wide_repositories)
    # repeated rows give repeated spans: distinct ones are collected, and every row gets them all
    judged = each.groupBy("doc_id", "owner", "text_hash").agg(
        F.array_sort(F.collect_set(F.when((F.col("s.kind") < 3) | live, F.struct("s.start", "s.kind", "s.end", live.alias("live"))))).alias("all"))
    none = F.array().cast("array<struct<start: int, kind: int, end: int, live: boolean>>")
    left = found.select("doc_id", "owner", "text_hash", "base").alias("f")
    same = F.expr("f.doc_id <=> j.doc_id and f.owner <=> j.owner and f.text_hash = j.text_hash")
    out = left.join(judged.alias("j"), same, "left").select("f.doc_id", "base", F.coalesce("all", none).alias("all"))
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    return out.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(digest(F.col("base")), 256).alias("base_sha256"), digest(F.col("all")).alias("spans"),
        F.size(F.filter("all", lambda x: x["live"])).cast("long").alias("n_live"),
        F.size(F.filter("all", lambda x: ~x["live"])).cast("long").alias("n_example"))

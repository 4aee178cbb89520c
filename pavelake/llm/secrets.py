"""Secret scan: pattern candidates judged by who else in the corpus owns the same value.

A value copied by many owners is an example from a manual; a value that few owners hold looks live.
All of it is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pavelake.llm.common import kept, text_or_empty

# Fixed patterns, in the order in which equal starts are listed.
ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]""" \
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"  # the runs of [0-9a-f]+ that have 16 characters or more
PEM = r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"  # added by this method; it names no value
KINDS = (("assign", ASSIGN, 12), ("access", ACCESS, 18), ("hex", HEX, 16), ("pem", PEM, 1))
BASE_KINDS = 3

OWNERS_OF_AN_EXAMPLE = 3  # a value held by this many owners is an example
REPOSITORIES_OF_AN_EXAMPLE = 20  # so is a value in this many repositories of however few owners
MARK, STAND_IN = "\uE000", "\uE001"  # private-use characters; no pattern holds either


def _spans(text: Column, kind: int) -> Column:
    """Matches of one kind with their places in code points: marks are set around each match, then pieces are measured."""
    name, pattern, least = KINDS[kind]
    marked = F.split(F.regexp_replace(text, pattern, MARK + "$0" + MARK), MARK)
    # odd pieces are matches; the fold carries the length passed so far
    walked = F.aggregate(
        marked,
        F.struct(F.lit(0).alias("at"), F.lit(False).alias("hit"),
                 F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>").alias("out")),
        lambda acc, piece: F.struct(
            (acc["at"] + F.length(piece)).alias("at"),
            (~acc["hit"]).alias("hit"),
            F.when(acc["hit"], F.concat(acc["out"], F.array(F.struct(
                acc["at"].alias("start"), F.lit(kind).alias("kind"), (acc["at"] + F.length(piece)).alias("end"),
                (F.regexp_extract(piece, pattern, 2) if name == "assign" else piece).alias("value")))))
            .otherwise(acc["out"]).alias("out")),
        lambda acc: F.filter(acc["out"], lambda s: F.length(s["value"]) >= least))
    nothing = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
    return F.when(F.size(marked) > 1, walked).otherwise(nothing)


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text", owner: str = "source") -> DataFrame:
    """(key, owner, spans): every pattern match, ordered by start and then kind; values as SHA-256."""
    plain = F.translate(text_or_empty(text), MARK, STAND_IN)
    found = docs.select(F.col(key).alias("key"), F.col(owner).cast("string").alias("owner"), plain.alias("body"))
    found = found.select("key", "owner", F.concat(*[_spans(F.col("body"), k) for k in range(len(KINDS))]).alias("spans"))
    return found.select("key", "owner", F.transform(F.array_sort("spans"), lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"),
        F.sha2(s["value"], 256).alias("value"))).alias("spans"))


def ownership(found: DataFrame) -> DataFrame:
    """(value, repositories, owners) over the corpus. A repository is a key; rows without an owner count as one owner.

    Three partial aggregations, so a value in a third of all rows never meets in one task.
    """
    each = found.select("key", F.coalesce("owner", F.lit("")).alias("owner"), F.explode("spans").alias("s")).where(
        f"s.kind < {BASE_KINDS}").select("key", "owner", F.col("s.value").alias("value"))
    by_repository = each.groupBy("value", "owner", "key").agg(F.lit(1).alias("one"))
    by_owner = by_repository.groupBy("value", "owner").agg(F.count("*").alias("repositories"))
    return by_owner.groupBy("value").agg(F.sum("repositories").alias("repositories"), F.count("*").alias("owners"))


def _live(by_owners: bool) -> Column:
    few = F.col("owners") < OWNERS_OF_AN_EXAMPLE
    return few if by_owners else few & (F.col("repositories") < REPOSITORIES_OF_AN_EXAMPLE)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", owner: str = "source", by_owners: bool = False) -> DataFrame:
    """One row per document: (key, spans, live), spans ordered, live being the spans whose value looks live.

    A null text is empty and has no span. Key headers carry no value and are always live. Equal keys are kept as
    separate rows with the same judgement of each value; a null key is a repository of its own. by_owners: a value of
    few owners looks live in however many repositories.
    """
    found = kept(candidates(docs, key, text, owner).withColumn("row", F.monotonically_increasing_id()))
    each = found.select("row", F.explode("spans").alias("s"))
    examples = ownership(found).where(~_live(by_owners)).select("value")
    # a value in very many rows meets one row on the other side, a join that Spark splits when it is skewed
    hits = each.join(examples.withColumnRenamed("value", "known"), F.col("s.value") == F.col("known"), "left")
    live = hits.where(F.col("known").isNull() | (F.col("s.kind") >= BASE_KINDS)).groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("s.start", "s.kind", "s.end"))).alias("live"))
    nothing = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    joined = found.join(live, "row", "left")
    return joined.select(F.col("key").alias(key), "spans", F.coalesce("live", nothing).alias("live"))


def digest(scanned: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts and digests of the spans of each document."""
    base = F.filter("spans", lambda s: s["kind"] < BASE_KINDS)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return scanned.select(
        key, count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"),
        F.size("live").cast("long").alias("n_live"), _listed(F.col("live")).alias("live_spans"))


def masked(text: Column, live: Column, instead: str = "[secret]") -> Column:
    """The text with each live span replaced; overlapping spans are replaced once."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    step = lambda acc, s: F.struct(
        F.greatest(acc["at"], s["end"]).alias("at"),
        F.when(s["start"] >= acc["at"], F.concat(
            acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(instead)))
        .otherwise(acc["out"]).alias("out"))
    return F.when(F.size(live) == 0, text).otherwise(
        F.aggregate(live, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))))


def mask(docs: DataFrame, text: str = "text", owner: str = "source") -> DataFrame:
    """The documents with live-looking secrets replaced; all columns stay, n_chars follows the text if present.

    A value of few owners is replaced in however many documents it is. Equal texts hold equal spans, so what is live is
    told by text and rows meet it by the digest of theirs: rows with null or repeated keys are masked like any other,
    and repeated rows stay as many as they are.
    """
    columns = docs.columns
    mine = F.sha2(text_or_empty(text), 256)
    scanned = scan(docs.select(mine.alias("__text"), F.col(text), F.col(owner)), "__text", text, owner, by_owners=True)
    live = scanned.where(F.size("live") > 0).dropDuplicates(["__text"]).select(F.col("__text").alias("__known"), F.col("live").alias("__live"))
    nothing = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    joined = docs.join(live, mine == F.col("__known"), "left")
    new = masked(F.col(text), F.coalesce("__live", nothing))
    out = joined.withColumn(text, F.when(F.col(text).isNotNull(), new))
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.when(F.col("__live").isNull(), F.col("n_chars")).otherwise(F.length(text).cast("long")))
    return out.select(*columns)

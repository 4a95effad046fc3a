"""Document fingerprints from closed syncmers, with DataFrame functions only.

Units are words (runs of non-blank characters; longer ones in pieces of ``LONGEST``). The inner
substrings of a k-mer of five words are its four pairs of neighbours; the k-mer is a closed syncmer
if the smallest pair hash is the first or the last of them. Whether a k-mer is chosen depends on
nothing but its words, so edits elsewhere move no anchor. ``anchors`` lists them with their word
positions for positional matching. The fingerprint is the whole set of anchor hashes (32 bits of each), in the
order of the text, and the likeness of two fingerprints is the share of anchors in common (Jaccard); ``n_in_place``
counts the anchors that also stand at the same word of the edited text.

Edge cases: null is empty text; a text without anchors is its own single anchor; without words the
fingerprint is empty, like only to another empty one (1.0). Repeated rows are one place in the order
and each get the same result; null doc_ids come first; a table of one document has itself as the
next one; an empty table gives an empty result; other columns of the input are ignored. A very long text
is one row: its arrays take some 10 bytes a byte of text, and its fingerprint grows with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumbung.llm.common import KEY, keyed
from lumbung.sources.staging import stage

LONGEST = 24
K = 5
_LOW = (1 << 32) - 1


def _units(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(rf"\S{{1,{LONGEST}}}"), F.lit(0))


def with_syncmers(df: DataFrame, text: str, to: str) -> DataFrame:
    """Column ``to``: array of (pos, hash) of the text's closed syncmers, ``pos`` the number of the first word.

    Intermediate arrays are columns, so that each is made once a row.
    """
    count = F.greatest(F.size("_w") - (K - 1), F.lit(0))
    pairs = F.zip_with(F.expr("slice(_w, 1, greatest(size(_w) - 1, 0))"), F.expr("slice(_w, 2, greatest(size(_w) - 1, 0))"), lambda a, b: F.xxhash64(a, b))
    df = df.withColumn("_w", F.transform(_units(F.col(text)), lambda w: F.xxhash64(w)))
    df = df.withColumn("_p", pairs).withColumn("_n", count)
    zipped = F.arrays_zip(
        F.sequence(F.lit(1), F.greatest("_n", F.lit(1))).alias("i"), *[F.slice("_p", i, F.col("_n")).alias(c) for i, c in enumerate("abcd", 1)],
        F.slice("_w", K, F.col("_n")).alias("e"))
    closed = F.filter(zipped, lambda x: F.least(x["a"], x["d"]) <= F.least(x["b"], x["c"]))
    chosen = F.transform(closed, lambda x: F.struct((x["i"] - 1).alias("pos"), F.xxhash64(x["a"], x["c"], x["e"]).alias("hash")))
    alone = F.array(F.struct(F.lit(0).alias("pos"), F.xxhash64(F.array_join(F.transform("_w", lambda h: h.cast("string")), " ")).alias("hash")))
    df = df.withColumn(to, chosen)
    return df.withColumn(to, F.when(F.size(to) > 0, F.col(to)).when(F.size("_w") > 0, alone).otherwise(F.col(to))).drop("_w", "_p", "_n")


def with_places(df: DataFrame, text: str, to: str) -> DataFrame:
    """Column ``to``: the anchors of ``text`` in order, each a long of its word's number and 32 bits of its hash."""
    df = with_syncmers(df, text, "_s")
    place = F.transform("_s", lambda x: F.shiftleft(x["pos"].cast("long"), 32).bitwiseOR(x["hash"].bitwiseAND(F.lit(_LOW))))
    return df.withColumn(to, place).drop("_s")


def hashes(places: str) -> Column:
    """The distinct hashes of ``with_places``, in order, as integers."""
    return F.array_distinct(F.transform(places, lambda x: F.shiftright(F.shiftleft(x, 32), 32).cast("int")))


def as_text(found: str) -> Column:
    """The fingerprint: the hashes as 8 hexadecimal digits each."""
    return F.lower(F.array_join(F.transform(found, lambda h: F.lpad(F.hex(h.cast("long").bitwiseAND(F.lit(_LOW))), 8, "0")), ""))


def likeness(a: str, b: str) -> Column:
    """Share of the hashes of both fingerprints together that are in each of them."""
    common = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(common.cast("double") / (F.size(a) + F.size(b) - common))


def anchors(docs: DataFrame) -> DataFrame:
    """doc_id, pos, hash: all closed syncmers of all texts."""
    return with_syncmers(keyed(docs).select("doc_id", "text"), "text", "s").select("doc_id", F.inline("s"))


def following(rows: DataFrame) -> DataFrame:
    """(_id, _th, t_id, t_th, q): each key, the key before it in ascending order (the last before the first), and that
    one's number q of characters to replace. Range partitions are numbered; one row per partition links them."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = rows.groupBy(*KEY).agg(F.first(F.floor(F.length("text") / 4)).cast("int").alias("q"))
    placed = stage(ids.repartitionByRange(parts, *KEY).withColumn("part", F.spark_partition_id()), "order")
    inside = Window.partitionBy("part").orderBy(*KEY)
    before = F.struct(*[F.col(c) for c in (*KEY, "q")])
    linked = placed.withColumn("prev", F.lag(before).over(inside))
    ends = placed.groupBy("part").agg(F.max(before).alias("end"))
    in_order = Window.orderBy("part")  # one row per partition
    last = F.max(F.struct("part", "end")).over(Window.partitionBy())["end"]
    ends = ends.select("part", F.coalesce(F.lag("end").over(in_order), last).alias("end"))
    prev = F.coalesce("prev", "end")
    return linked.join(ends, "part").select(*KEY, prev["_id"].alias("t_id"), prev["_th"].alias("t_th"), prev["q"].alias("q"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_anchors, n_in_place, next_doc_id.

    The texts are shuffled once: as the next document (giving its first characters and its fingerprint) and as the
    document itself they are read from the same exchange. The anchors are found after it, on both
    sides, as they would be half as much again to shuffle.
    """
    rows = keyed(docs)
    base = rows.withColumn("n", F.length("text"))
    given = with_places(base.join(following(rows), KEY), "text", "places").select(
        F.col("t_id").alias("_id"), F.col("t_th").alias("_th"), F.col("doc_id").alias("next_doc_id"), hashes("places").alias("next"),
        F.substring("text", F.lit(1), F.least("q", "n")).alias("head"))
    given = given.groupBy(*KEY).agg(F.first("next_doc_id").alias("next_doc_id"), F.first("next").alias("next"), F.first("head").alias("head"))
    joined = with_places(base.join(given, KEY), "text", "places")
    kept = F.substring("text", F.lit(1), F.col("n") - F.floor(F.col("n") / 4).cast("int"))
    edited = with_places(joined.withColumn("edited", F.concat(kept, "head")), "edited", "edited_places")
    edited = edited.withColumn("own", hashes("places")).withColumn("changed", hashes("edited_places"))
    return edited.select(
        "doc_id", F.col("n").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        as_text("own").alias("fingerprint"), as_text("changed").alias("edited_fingerprint"),
        likeness("own", "changed").alias("near_edited"), likeness("own", "next").alias("near_next"),
        F.size("places").cast("long").alias("n_anchors"), F.size(F.array_intersect("places", "edited_places")).cast("long").alias("n_in_place"), "next_doc_id")

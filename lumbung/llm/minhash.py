"""MinHash near-dedup with tensored banding, links confirmed on full shingle sets.

Plan. (1) One pass over the texts makes each document's set of 5-word shingles and from it the
set's 128-bit hash, ``HALF`` + ``HALF`` sub-keys of ``WIDTH`` minhashes each, and the minhashes
themselves. Documents with equal sets are one node from here on. (2) Tensoring: table (i, j) is
keyed by sub-key i of the first collection and sub-key j of the second, so 2 * HALF * WIDTH
minhashes serve HALF * HALF tables. Sub-keys that one node only has are dropped before pairs of
them are formed. Two sets of similarity s meet with probability (1 - (1 - s^WIDTH)^HALF)^2;
at 0.85 they miss with about two in a hundred thousand, at 0.80 with about four in ten thousand. (3) Nodes of a bucket join the group of
the bucket's smallest node, so a group of near copies is listed once and not once a table.
Minhashes tell which nodes have a partner at all: ``reach`` of them equal, which a pair at the
threshold misses with a chance of ``MISSED`` at most. (4) What is left gets the texts, makes the full
sets anew and confirms every link between nodes that are not yet connected. Groups put out one link
for each node at most, never a pair that is not linked. In both steps a large group is not cut into
pairs of blocks: in each round a bounded number of its members lead and are compared with all others,
which deals two rows a member. A group of near copies is settled by the first leaders, and only what
they do not reach leads in later rounds; no pair of different components is left out. Rounds grow in
number only with the members that stay unconnected. (5) The links are closed to components.

Edge cases: null or blank texts have the empty set, are linked with nothing and are their own
component; fewer than five words are one shingle; repeated rows share their component; null
doc_ids do not name components (``kept`` is false in a group that has another id, else null ids
name it null and are kept); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.llm.common import KEY, keyed, mix, pieces, prefix_sums, span_hashes, word_hashes, words
from lumbung.llm.graph import components
from lumbung.sources.staging import stage

HALF, WIDTH = 12, 3
MINHASHES = 2 * HALF * WIDTH
MISSED = 4e-5  # chance that a pair just at the threshold has fewer equal minhashes than asked for
NODES, SHINGLES = 1000, 400_000  # of a group that is compared in one piece, and of the leaders of a round
SIGNATURES = 4000  # nodes of such a group when only minhashes are compared
_RNG = np.random.default_rng(85)
_XOR = _RNG.integers(1, 1 << 63, MINHASHES, dtype=np.uint64)
_ODD = _RNG.integers(1, 1 << 63, MINHASHES, dtype=np.uint64) | np.uint64(1)


def reach(percent: int) -> int:
    """Equal minhashes asked of a pair: the most that one at the threshold lacks with a chance of ``MISSED`` at most."""
    chance, below = percent / 100, 0.0
    for n in range(MINHASHES):
        below += comb(MINHASHES, n) * chance**n * (1 - chance) ** (MINHASHES - n)
        if below > MISSED:
            return n
    return MINHASHES


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every row, sorted within the row, and the offsets of the rows."""
    begin, end, counts = words(data, offsets)
    sums = prefix_sums(word_hashes(data, begin, end, lower=True))
    sizes = np.diff(counts)
    shingles = np.where(sizes >= k, sizes - k + 1, np.minimum(sizes, 1))
    first = np.cumsum(shingles) - shingles
    rows = np.repeat(np.arange(len(sizes)), shingles)
    starts = counts[:-1][rows] + np.arange(len(rows)) - first[rows]
    hashes = span_hashes(sums, starts, np.minimum(starts + k, counts[1:][rows]))
    by = np.lexsort((hashes, rows))
    hashes, rows = hashes[by], rows[by]
    new = np.append(True, (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1]))[: len(rows)]
    return hashes[new], np.searchsorted(rows[new], np.arange(len(sizes) + 1))


def signatures(hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Minhashes (rows x MINHASHES, 16 bits each) and sub-keys (rows x 2 HALF) of non-empty sets that start at ``at``."""
    least = np.empty((MINHASHES, len(at)), np.uint64)
    for i in range(MINHASHES):
        least[i] = np.minimum.reduceat((hashes ^ _XOR[i]) * _ODD[i], at)
    grouped = least.reshape(2 * HALF, WIDTH, -1)
    keys = np.zeros((2 * HALF, len(at)), np.uint64)
    for i in range(WIDTH):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + grouped[:, i])
    return (least >> np.uint64(48)).astype(np.uint16).T.copy(), keys.T.copy()


def _profile(k: int):
    def run(batches):
        for batch in batches:
            for row, data, offsets in pieces(batch.column("text")):
                hashes, bounds = shingle_sets(data, offsets, k)
                sizes = np.diff(bounds)
                full = np.flatnonzero(sizes)
                sig, keys = signatures(hashes, bounds[:-1][full]) if len(full) else (np.zeros((0, 1)), np.zeros((0, 1)))
                sigs, subs, names = [None] * len(sizes), [None] * len(sizes), [(None, None)] * len(sizes)
                view = memoryview(hashes).cast("B")
                for nth, i in enumerate(full.tolist()):
                    sigs[i], subs[i] = sig[nth].tobytes(), keys[nth].view(np.int64)
                    digest = xxhash.xxh3_128_intdigest(view[8 * int(bounds[i]) : 8 * int(bounds[i + 1])])
                    names[i] = ((digest >> 64) - (1 << 63), (digest & ((1 << 64) - 1)) - (1 << 63))
                part = batch.slice(row, len(sizes))
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), *(part.column(c) for c in KEY), pa.array(sizes.astype(np.int64)),
                    pa.array([x[0] for x in names], pa.int64()), pa.array([x[1] for x in names], pa.int64()),
                    pa.array(subs, pa.list_(pa.int64())), pa.array(sigs, pa.binary()),
                ], names=["doc_id", *KEY, "n", "s1", "s2", "subs", "sig"])

    return run


PROFILE = "doc_id long, _id long, _th long, n long, s1 long, s2 long, subs array<long>, sig binary"


def _buckets(profiles: DataFrame) -> DataFrame:
    """(table, key, node): the tensored tables, without keys that only one node can have."""
    subs = profiles.filter("n > 0").select("s1", "s2", F.posexplode("subs").alias("pos", "sub"))
    # A sub-key is a hash of minhashes of its place, so it names the place too.
    shared = subs.groupBy("sub").agg(F.min("s1").alias("a"), F.max("s1").alias("b")).filter("a < b").select("sub")
    halves = subs.select("s1", "s2", F.col("pos").cast("byte").alias("pos"), "sub").join(
        # Merged at every size: the shared sub-keys grow with the input.
        stage(shared, "sub-keys").hint("merge"), "sub", "left_semi")
    halves = halves.groupBy("s1", "s2").agg(F.collect_set(F.struct("pos", "sub")).alias("x"))
    halves = stage(halves.select(F.struct("s1", "s2").alias("node"), "x"), "halves")
    first, second = F.filter("x", lambda e: e["pos"] < HALF), F.filter("x", lambda e: e["pos"] >= HALF)
    pairs = F.flatten(F.transform(first, lambda a: F.transform(second, lambda b: F.struct(
        (a["pos"].cast("int") * HALF + b["pos"] - HALF).alias("table"), F.xxhash64(a["pos"], a["sub"], b["pos"], b["sub"]).alias("key")))))
    return halves.select("node", F.inline(pairs))


def _parts(rows: DataFrame, nodes: int, shingles: int | None) -> DataFrame:
    """(u, parts): so many parts of bounded size each group (u, node, n) makes."""
    by = F.count("*") / nodes
    by = by if shingles is None else F.greatest(by, F.sum("n") / shingles)
    return rows.groupBy("u").agg(F.ceil(by).cast("int").alias("parts"))


def _sharded(rows: DataFrame) -> DataFrame:
    """Rows (u, node, n, x, part) with the shard they are dealt to, which is the unit of a Python call."""
    rows = stage(rows, "blocks")
    shards = max(1, int((rows.agg(F.sum(F.col("n") + 100)).first()[0] or 0) // SHINGLES))
    return rows.withColumn("shard", F.pmod(F.xxhash64("u", "x"), F.lit(shards)))


def _whole(members: DataFrame) -> DataFrame:
    """Groups that are compared in one piece: their members as part 0, and u itself as part -1."""
    rows = members.select("u", "node", "n", F.lit(0).alias("x"), F.lit(0).alias("part"))
    leads = members.groupBy("u").agg(F.first("n").alias("n"))
    return rows.unionByName(leads.select("u", F.col("u").alias("node"), "n", F.lit(0).alias("x"), F.lit(-1).alias("part")))


def _round(large: DataFrame, todo: DataFrame, parts: DataFrame, nodes: int, shingles: int | None, nth: int) -> tuple[DataFrame, DataFrame]:
    """Some of the members still to do as leaders, and the rows of one round: every member once, every leader with each part."""
    share = _parts(todo, nodes, shingles).withColumnRenamed("parts", "_of")
    leaders = stage(todo.join(share, "u").filter(F.pmod(F.xxhash64("node", F.lit(nth)), F.col("_of")) == 0).select("u", "node", "n"), "leaders")
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    others = large.join(leaders, ["u", "node"], "left_anti").join(parts, "u").select("u", "node", "n", part.alias("x"), part.alias("part"))
    copied = leaders.join(parts, "u").select("u", "node", "n", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("x"), F.lit(-2).alias("part"))
    return leaders, others.unionByName(copied)


def _rounds(members: DataFrame, nodes: int, shingles: int | None, compare, settled, always: bool) -> DataFrame:
    """What ``compare`` finds in all groups, large ones by rounds of leaders.

    A large group is never compared block with block. In each round a bounded number of its members
    lead: they are compared with all members, and have all their links then. ``settled(found)`` names
    members that need not lead, because each of their links that matters shows when the other
    end leads; it is asked after the first round, and with ``always`` after the others too. A round
    deals every member once and has leaders with each part, in all twice the group.
    """
    sizes = stage(_parts(members, nodes, shingles).filter("parts > 1"), "large-groups")
    found = stage(compare(_sharded(_whole(members.join(sizes.select("u"), "u", "left_anti")))), "found")
    if not sizes.limit(1).count():
        return found
    own = members.join(sizes.select("u"), "u", "left_semi")
    large = stage(own.unionByName(own.groupBy("u").agg(F.first("n").alias("n")).select("u", F.col("u").alias("node"), "n")), "large")
    todo, nth, rest = large, 0, None
    while True:
        leaders, rows = _round(large, todo, sizes, nodes, shingles, nth)
        some = stage(compare(_sharded(rows)), "found")
        rest = some if rest is None else rest.unionByName(some)
        todo = todo.join(leaders, ["u", "node"], "left_anti")
        if nth == 0 or always:
            todo = todo.join(settled(some).distinct(), ["u", "node"], "left_anti")
        todo, nth = stage(todo, "to-do"), nth + 1
        if not todo.limit(1).count():
            return found.unionByName(rest)


def _named(rows: DataFrame, *more: str) -> DataFrame:
    """Flat columns, as pandas takes them."""
    pair = [F.col(f"{c}.{s}").alias(f"{c[0]}{s[1]}") for c in ("u", "node") for s in ("s1", "s2")]
    return rows.select("shard", *pair, "x", "part", "sig", *more)


def _groups(pdf: pd.DataFrame):
    """Rows of each group or part of one, the leaders first."""
    by = np.lexsort([pdf[c].to_numpy() for c in ("n2", "n1", "part")])
    for rows in pdf.iloc[by].groupby(["u1", "u2", "x"], sort=False).indices.values():
        yield by[rows]


def _comparable(part: np.ndarray, i: int) -> np.ndarray:
    """Later rows of the group that row i is compared with: beside leaders of a round, none if it is no leader."""
    return np.arange(i + 1, len(part)) if part[i] < 0 or part[0] > -2 else np.zeros(0, np.int64)


def _partnered(least: int):
    """Members with a partner within reach."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sig = np.frombuffer(b"".join(pdf["sig"]), np.uint16).reshape(len(pdf), -1)
        part = pdf["part"].to_numpy()
        found = np.zeros(len(pdf), bool)
        for rows in _groups(pdf):
            for nth, i in enumerate(rows.tolist()):
                j = rows[_comparable(part[rows], nth)]
                if len(j):
                    j = j[(sig[j] == sig[i]).sum(axis=1) >= least]
                    found[j] = True
                    found[i] |= len(j) > 0
        return pdf.loc[found & (part != -1), ["u1", "u2", "n1", "n2"]]

    return run


def _linked(k: int, percent: int):
    least = reach(percent)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sets = []
        for _, data, offsets in pieces(pa.array(pdf["text"], pa.large_string())):
            hashes, bounds = shingle_sets(data, offsets, k)
            sets += [hashes[bounds[i] : bounds[i + 1]] for i in range(len(offsets) - 1)]
        sig = np.frombuffer(b"".join(pdf["sig"]), np.uint16).reshape(len(pdf), -1)
        part = pdf["part"].to_numpy()
        lefts, rights, settled = [], [], []
        for rows in _groups(pdf):
            parts = part[rows]
            own = [sets[i] for i in rows.tolist()]
            size = np.array([len(s) for s in own])
            # A set shares at most the shingles that another set of the group has too.
            _, back, times = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
            most = np.add.reduceat(times[back] > 1, np.cumsum(size) - size)
            label, leads = np.arange(len(rows)), int((parts == -2).sum())

            def confirm(i: int, j: np.ndarray) -> None:
                j = j[label[j] != label[i]]
                common = np.minimum(most[j], most[i])
                j = j[100 * common >= percent * (size[j] + size[i] - common)]
                j = j[(sig[rows[j]] == sig[rows[i]]).sum(axis=1) >= least]
                for other in j.tolist():
                    if label[other] != label[i]:
                        common = len(np.intersect1d(own[i], own[other], assume_unique=True))
                        if 100 * common >= percent * (size[i] + size[other] - common):
                            label[label == label[other]] = label[i]
                            lefts.append(rows[i])
                            rights.append(rows[other])

            # Leaders among themselves first: every part of a group then agrees on their largest component.
            for i in range(leads):
                confirm(i, np.arange(i + 1, leads))
            largest = int(np.argmax(np.bincount(label[:leads]))) if leads else -1
            at = np.flatnonzero(label[:leads] == largest)[:1]
            for i in range(leads or len(rows)):
                confirm(i, np.arange(max(i + 1, leads), len(rows)))
            if len(at):
                settled.append(rows[label == label[at[0]]])
        a, b = pdf.iloc[lefts], pdf.iloc[rights]
        done = pdf.iloc[np.concatenate(settled)] if settled else pdf.iloc[:0]
        ends = [np.concatenate([x.to_numpy(), y.to_numpy()]) for x, y in zip((a["n1"], a["n2"], b["n1"], b["n2"]), (done["u1"], done["u2"], done["n1"], done["n2"]), strict=True)]
        return pd.DataFrame({"settled": np.repeat([False, True], [len(a), len(done)]), **dict(zip(("u1", "u2", "v1", "v2"), ends, strict=True))})

    return run


def confirmed_links(stars: DataFrame, nodes: DataFrame, rows: DataFrame, k: int, percent: int) -> DataFrame:
    """(u, v): links that connect all nodes of a group that are connected by links within it."""
    pair = [F.struct(F.col(c + "1").alias("s1"), F.col(c + "2").alias("s2")).alias(to) for c, to in (("u", "u"), ("n", "node"))]
    ends = [F.struct(F.col(c + "1").alias("s1"), F.col(c + "2").alias("s2")).alias(c) for c in "uv"]
    n, signed = nodes.select("node", "n"), nodes.select("node", "sig")

    def partnered(dealt: DataFrame) -> DataFrame:
        some = _named(dealt.join(signed, "node")).groupBy("shard").applyInPandas(_partnered(reach(percent)), "u1 long, u2 long, n1 long, n2 long")
        return some.distinct().select(*pair)

    # A member known to have a partner need not lead; one that is near it finds it when it leads itself.
    members = _rounds(stage(stars.join(n, "node"), "candidates"), SIGNATURES, None, partnered, lambda some: some, always=True)
    members = stage(members.distinct(), "members")
    wanted = stage(members.select("node").unionByName(members.select(F.col("u").alias("node"))).distinct(), "wanted")
    places = nodes.join(wanted, "node", "left_semi").select("node", "sig", "place.*")
    # Of rows repeated as a whole one text is taken; the key tells the text.
    texts = stage(rows.select(*KEY, "text").join(places, KEY).dropDuplicates(KEY).select("node", "sig", "text"), "texts")

    def linked(dealt: DataFrame) -> DataFrame:
        some = _named(dealt.join(texts, "node"), "text").groupBy("shard").applyInPandas(_linked(k, percent), "settled boolean, u1 long, u2 long, v1 long, v2 long")
        return some.select("settled", *ends)

    # Members of the component that most of the first leaders are in need not lead: what they are linked
    # with outside of it leads. That holds for one component of a group only, so for no later leaders'.
    members = stage(members.filter("u != node").join(n, "node"), "members")
    return _rounds(members, NODES, SHINGLES, linked, lambda some: some.filter("settled").select("u", F.col("v").alias("node")), always=False).filter("NOT settled").select("u", "v")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, and the row's key (_id, _th)."""
    rows = keyed(docs)
    profiles = stage(rows.mapInArrow(_profile(k), PROFILE), "profiles")
    node = F.struct("s1", "s2").alias("node")
    nodes = stage(profiles.filter("n > 0").groupBy(node).agg(
        F.first("n").alias("n"), F.first("sig").alias("sig"), F.min(F.struct(*KEY)).alias("place")), "nodes")
    buckets = _buckets(profiles)
    full = buckets.groupBy("table", "key").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a < b")
    full = stage(full.select("table", "key", F.col("a").alias("u")), "full-buckets")
    stars = stage(buckets.join(full, ["table", "key"]).filter("u != node").select("u", "node").distinct(), "stars")
    labels = components(stage(confirmed_links(stars, nodes, rows, k, percent), "links"))
    named = profiles.filter("n > 0").select(node, "doc_id")
    named = named.join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("label"), "doc_id")
    names = stage(named.groupBy("label").agg(F.min("doc_id").alias("component_id")), "names")
    by_node = stage(named.select("node", "label").distinct().join(names, "label").select("node", "component_id"), "components")
    out = profiles.select("doc_id", *KEY, "n", F.when(F.col("n") > 0, F.struct("s1", "s2")).alias("node")).join(by_node, "node", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), *KEY)

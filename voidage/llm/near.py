"""Near-duplicates by an LSH forest: sorted signature orders and their nearest neighbours."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voidage.llm.chunks import slices
from voidage.llm.common import components, id_and_text, stored
from voidage.llm.hashing import U64, Words, shingle_set

#: Minimum hashes of a signature, 32 bits each.
VALUES = 80
#: Values that neighbours must share at least. An order begins every so many values,
#: so 20 orders; two texts at 0.85 share the first four values of none of them
#: with a probability of 4e-7, two at 0.8 of 3e-5.
DEPTH = 4
#: Values by which an order is sorted.
PATH = 8
ORDERS = VALUES // DEPTH


def _signatures(starts: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """Minimum hashes of the sets that begin at ``starts`` in ``flat`` (none of them empty)."""
    rng = np.random.default_rng(20_231)
    turn, factor = (rng.integers(0, 1 << 63, VALUES, dtype=np.int64).astype(U64) for _ in range(2))
    out = np.empty((len(starts), VALUES), ">u4")
    for k in range(VALUES):
        out[:, k] = np.minimum.reduceat((flat ^ turn[k]) * (factor[k] << U64(1) | U64(1)) >> U64(32), starts)
    return out


def sets_of(docs: DataFrame, width: int) -> DataFrame:
    """Per row ``doc_id``, ``text_hash``, ``n_shingles``, ``digest`` of the set and ``signature`` (null for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(lower=True)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in slices(texts, 1_000_000):
                hashes, ends = words(texts[a:b])
                found = [shingle_set(x, width) for x in np.split(hashes, ends[:-1])]
                sizes = np.array([len(x) for x in found], np.int64)
                digests = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None for x in found]
                full = np.flatnonzero(sizes)
                signatures: list[bytes | None] = [None] * len(found)
                if len(full):
                    starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
                    for k, row in zip(full, _signatures(starts, np.concatenate([found[k] for k in full]))):
                        signatures[k] = row.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        batch.column(2).slice(a, b - a),
                        pa.array(sizes),
                        pa.array(digests, pa.binary()),
                        pa.array(signatures, pa.binary()),
                    ],
                    ["doc_id", "text_hash", "n_shingles", "digest", "signature"],
                )

    rows = id_and_text(docs).withColumn("text_hash", F.xxhash64("text"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, n_shingles long, digest binary, signature binary")


NEIGHBOURS = "tree int, path binary, node long, n long, before long, n_before long, shared int, edge boolean"


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a sorted run of rows, those that share ``DEPTH`` values with a row next to them, and the run's ends.

    ``before`` is the row in front where that is near; ``shared`` how many values
    they have in common, up to ``PATH``. One batch and the last row of the batch
    before are held at a time.
    """
    names = ["tree", "path", "node", "n"]
    held, ahead = None, (0, 0, 0)  # the row not yet given back, and the one in front of it

    def given(rows: pa.RecordBatch, before, n_before, shared, edge, at: np.ndarray) -> pa.RecordBatch:
        none = shared[at] < DEPTH
        return pa.RecordBatch.from_arrays(
            [
                *rows.take(pa.array(at)).columns,
                pa.array(before[at], mask=none),
                pa.array(n_before[at], mask=none),
                pa.array(shared[at]),
                pa.array(edge[at]),
            ],
            [*names, "before", "n_before", "shared", "edge"],
        )

    start = True
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch.select(names)
        if held is not None:
            rows = pa.Table.from_batches([held, rows]).combine_chunks().to_batches()[0]
        tree, nodes, n = (rows.column(c).to_numpy() for c in ("tree", "node", "n"))
        paths = np.frombuffer(b"".join(rows.column("path").to_pylist()), ">u4").reshape(-1, PATH)
        alike = (paths[1:] == paths[:-1]).cumprod(axis=1).sum(axis=1) * (tree[1:] == tree[:-1])
        before, n_before = np.append(ahead[0], nodes[:-1]), np.append(ahead[1], n[:-1])
        shared = np.append(ahead[2], alike).astype(np.int32)
        edge = np.zeros(len(nodes), bool)
        edge[0] = start
        near = shared >= DEPTH
        kept = (near | edge)[:-1] | near[1:]
        if kept.any():
            yield given(rows, before, n_before, shared, edge, np.flatnonzero(kept))
        if len(nodes) > 1:
            start = False
        held, ahead = rows.slice(len(nodes) - 1), (before[-1], n_before[-1], shared[-1])
    if held is not None:
        last = (np.array([x]) for x in (ahead[0], ahead[1], np.int32(ahead[2]), True))
        yield given(held, *last, np.array([0]))


def forest(classes: DataFrame) -> DataFrame:
    """Rows of all orders that have a near neighbour; see ``_neighbours``. ``classes``: ``node``, ``n``, ``signature``.

    Order t sorts the signature from its value t * DEPTH on, around its end. Rows are
    dealt by ranges of (order, path, node); as that is unique, a region in which
    very many signatures agree is spread over tasks like any other.
    """
    twice = F.concat("signature", "signature")
    orders = classes.select(
        F.explode(F.sequence(F.lit(0), F.lit(ORDERS - 1))).alias("tree"), "node", "n", twice.alias("twice")
    ).select("tree", F.substring("twice", F.col("tree") * (4 * DEPTH) + 1, 4 * PATH).alias("path"), "node", "n")
    by = ["tree", "path", "node"]
    rows = stored(orders.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(_neighbours, NEIGHBOURS))
    # Neighbours in different tasks: the two ends of every task, few enough for one. Many tasks look for them.
    ends = rows.filter("edge").select("tree", "path", "node", "n").repartition(1).sortWithinPartitions(*by)
    across = ends.mapInArrow(_neighbours, NEIGHBOURS).filter("before IS NOT NULL")
    return rows.unionByName(stored(across))


def _verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The ``pairs`` (``a``, ``b``) whose whole sets have ``percent`` of their union in common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(lower=True)
        last: tuple = (None, None)

        def set_of(text: str) -> np.ndarray:
            return shingle_set(words([text])[0], width)

        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            keys = batch.column(0).to_pylist()
            for k in range(batch.num_rows):
                if last[0] != keys[k]:
                    last = (keys[k], set_of(batch.column(2)[k].as_py()))
                x, y = last[1], set_of(batch.column(3)[k].as_py())
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep[k] = 100 * common >= percent * (len(x) + len(y) - common)
            yield batch.filter(pa.array(keep)).select(["a", "b"])

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(run, "a long, b long")


def _apart(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """The ``pairs`` whose ends are not yet in one component."""
    of = lambda side: parts.select(F.col("id").alias(side), F.col("component").alias(f"in_{side}"))
    joined = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    return joined.filter(F.coalesce("in_a", "a") != F.coalesce("in_b", "b")).drop("in_a", "in_b")


def _merged(parts: DataFrame, links: DataFrame) -> DataFrame:
    """``parts`` with components that ``links`` connect made one; only what they connect is gone through."""
    if links.isEmpty():
        return parts
    of = lambda side: parts.select(F.col("id").alias(side), F.col("component").alias(f"in_{side}"))
    between = links.join(of("a"), "a", "left").join(of("b"), "b", "left")
    more = components(between.select(F.coalesce("in_a", "a").alias("a"), F.coalesce("in_b", "b").alias("b")))
    moved = parts.join(more.select(F.col("id").alias("component"), F.col("component").alias("top")), "component", "left")
    added = more.join(parts.select("id"), "id", "left_anti")
    return stored(moved.select("id", F.coalesce("top", "component").alias("component")).unionByName(added))


def _rest(members: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs ``a``, ``b`` of ``members`` (``node``, ``part``, ``family``, ``text``) by which every part is linked that can be.

    Every pair of different parts that reaches ``percent`` is among them, or both its
    ends are paired with the same third member that they reach. Pairs of one family
    come from ``_within``, others from ``_across``; families are any division of the members.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(lower=True)
        for batch in batches:
            texts = batch.column(3).to_pylist()
            for a, b in slices(texts, 1_000_000):
                hashes, ends = words(texts[a:b])
                found = [shingle_set(x, width).view(np.int64) for x in np.split(hashes, ends[:-1])]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
                shingles = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found)))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(a, b - a) for c in range(3)), shingles], ["node", "part", "family", "shingles"]
                )

    rows = members.select("node", "part", "family", "text")
    all_ = stored(rows.mapInArrow(run, "node long, part long, family long, shingles array<long>"))
    each = all_.select("family", F.explode("shingles").alias("shingle"))
    counts = stored(each.groupBy("family", "shingle").agg(F.count(F.lit(1)).alias("f")))
    pairs = _within(all_, counts, percent).union(_across(all_, counts, percent))
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _across(all_: DataFrame, counts: DataFrame, percent: int) -> DataFrame:
    """Every pair ``x``, ``y`` of different families and parts that can reach ``percent``.

    Sets that reach it share one of the first n - ceil(n * percent / 100) + 1 shingles
    in any common order; those of one family alone come first and are shared by none.
    Of each shared shingle the members of the family with most of them meet only the
    members of other families, never each other.

    What most members of a family have is looked up once for the family, however many
    they are, and a member only takes from it, in order, what its prefix has room for.
    """
    often = counts.groupBy("shingle").agg(
        F.sum("f").alias("f"), F.max(F.struct("f", "family"))["family"].alias("main"), F.count(F.lit(1)).alias("families")
    )
    often = stored(often.filter("families > 1").drop("families"))
    # No more shingles than twice the mean of its members' numbers.
    sizes = all_.groupBy("family").agg(F.count(F.lit(1)).alias("size"))
    typical = stored(
        counts.withColumnRenamed("f", "here").join(often, "shingle").join(sizes, "family").filter("2 * here > size").drop("here", "size")
    )
    in_order = F.array_sort(F.collect_list(F.struct("f", "shingle")))["shingle"]
    known = all_.join(typical.groupBy("family").agg(in_order.alias("t")), "family", "left")
    known = known.withColumn("t", F.coalesce("t", F.array().cast("array<long>"))).select(
        "node",
        "part",
        "family",
        F.size("shingles").alias("n"),
        F.array_intersect("t", "shingles").alias("own"),
        F.array_except("shingles", "t").alias("more"),
    )
    beyond = known.select("node", "part", "family", "n", F.size("own").alias("owned"), F.explode("more").alias("shingle"))
    beyond = stored(beyond.join(often, "shingle"))
    of_node = Window.partitionBy("node")
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    # Places of the prefix that the shingles of one family alone leave.
    room = (prefix - F.col("n") + F.col("owned") + F.col("met")).cast("int").alias("room")
    met = beyond.groupBy("node").agg(F.count(F.lit(1)).alias("met"))
    columns = ["shingle", "node", "part", "family", "n", "main", "f", "room"]
    taken = (
        known.withColumn("owned", F.size("own"))
        .filter("owned > 0")
        .join(met, "node", "left")
        .withColumn("met", F.coalesce("met", F.lit(0)))
        .select("node", "part", "family", "n", "own", room)
        .filter("room > 0")
        .select("node", "part", "family", "n", "room", F.explode(F.slice("own", F.lit(1), F.col("room"))).alias("shingle"))
        .join(typical, ["family", "shingle"])
    )
    beyond = beyond.withColumn("met", F.count(F.lit(1)).over(of_node)).withColumn("room", room)
    ranked = beyond.select(*columns).union(taken.select(*columns)).withColumn(
        "place", F.row_number().over(of_node.orderBy("f", "shingle"))
    )
    first = stored(ranked.filter("place <= room").select("shingle", "node", "part", "family", "n", "main"))
    side = lambda k: [F.col(c).alias(f"{c}{k}") for c in ("node", "part", "family", "n")]
    left = first.filter("family != main").select("shingle", *side(1))
    met = left.join(first.select("shingle", "main", *side(2)), "shingle").filter(
        "family1 != family2 AND part1 != part2 AND (family2 = main OR node1 < node2)"
        f" AND 100 * least(n1, n2) >= {percent} * greatest(n1, n2)"
    )
    return met.select(F.col("node1").alias("x"), F.col("node2").alias("y"))


def _within(all_: DataFrame, counts: DataFrame, percent: int) -> DataFrame:
    """Pairs ``x``, ``y`` of one family and of different parts: all that can reach ``percent``, but for what one link tells.

    Let T be the shingles that most of a family have, and D(x) what x has beyond T or
    lacks of it. What x and y do not share is then |D(x)| + |D(y)| - 2 |D(x) & D(y)|.
    With g(x) = (100 + percent) |D(x)| - (100 - percent) n(x), the two reach
    ``percent`` exactly if 2 (100 + percent) |D(x) & D(y)| >= g(x) + g(y).

    If g(x) + g(y) <= 0, both also reach the member of the least g: one pair for each.
    Else they share elements of D, which are few and rare however large the family
    is: one of the first |D(x)| - o + 1 in a common order, where o is how many it takes
    even with the least g. How many they can share is also bounded by what each has
    that is not its own alone, and by what is left behind the place where they meet.
    """
    up, down = 100 + percent, 100 - percent
    several = all_.groupBy("family").agg(
        F.count(F.lit(1)).alias("size"), F.min("part").alias("low"), F.max("part").alias("high")
    )
    several = several.filter("low != high").select("family", "size")
    # No more shingles than twice the mean of its members' numbers.
    typical = (
        counts.filter("f > 1").join(several, "family").filter("2 * f > size").groupBy("family").agg(F.collect_list("shingle").alias("t"))
    )
    known = several.select("family").join(typical, "family", "left").select(
        "family", F.coalesce("t", F.array().cast("array<long>")).alias("t")
    )
    around = stored(
        all_.join(known, "family")
        .select(
            "node",
            "part",
            "family",
            F.size("shingles").cast("long").alias("n"),
            F.array_except("shingles", "t").alias("more"),
            F.array_except("t", "shingles").alias("less"),
        )
        .withColumn("d", (F.size("more") + F.size("less")).cast("long"))
        .withColumn("g", F.col("d") * up - F.col("n") * down)
    )
    centre = around.groupBy("family").agg(F.min(F.struct("g", "node", "part")).alias("centre"))
    around = around.join(centre, "family")
    close = around.filter("g + centre.g <= 0 AND part != centre.part").select(
        F.col("node").alias("x"), F.col("centre.node").alias("y")
    )
    one = lambda column, lacks: F.transform(column, lambda s: F.struct(s.alias("shingle"), F.lit(lacks).alias("lacks")))
    each = around.select(
        "node",
        "part",
        "family",
        "d",
        "g",
        F.greatest(F.lit(1), F.ceil((F.col("g") + F.col("centre.g")) / (2 * up))).alias("o"),
        F.explode(F.concat(one("more", 0), one("less", 1))).alias("e"),
    ).select("node", "part", "family", "d", "g", "o", "e.shingle", "e.lacks")
    each = stored(each)
    by_part = each.groupBy("family", "shingle", "part").agg(F.count(F.lit(1)).alias("f"))
    often = by_part.groupBy("family", "shingle").agg(
        F.sum("f").alias("f"), F.max(F.struct("f", "part"))["part"].alias("main"), F.count(F.lit(1)).alias("parts")
    )
    of_node = Window.partitionBy("node")
    ranked = each.join(often.filter("f > 1"), ["family", "shingle"]).select(
        "*",
        F.row_number().over(of_node.orderBy("f", "shingle")).alias("place"),
        F.count(F.lit(1)).over(of_node).alias("repeated"),
        F.sum("lacks").over(of_node).alias("lacking"),
    )
    left_over = ranked.withColumn("left_over", F.col("repeated") - F.col("place") + 1)
    first = stored(
        left_over.filter("left_over >= o AND parts > 1").select(
            "family", "shingle", "main", "node", "part", "g", "repeated", "lacking", "left_over"
        )
    )
    side = lambda k: [F.col(c).alias(f"{c}{k}") for c in ("node", "part", "g", "repeated", "lacking", "left_over")]
    left = first.filter("part != main").select("family", "shingle", *side(1))
    met = left.join(first.select("family", "shingle", "main", *side(2)), ["family", "shingle"]).filter(
        "part1 != part2 AND (part2 = main OR node1 < node2) AND g1 + g2 > 0"
        f" AND {2 * up} * least(left_over1, left_over2,"
        " least(lacking1, lacking2) + least(repeated1 - lacking1, repeated2 - lacking2)) >= g1 + g2"
    )
    return close.union(met.select(F.col("node1").alias("x"), F.col("node2").alias("y")))


def near_duplicates(docs: DataFrame, width: int = 3, percent: int = 85) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id``, ``kept`` and ``text_hash``.

    Texts are linked when ``percent`` of the union of their sets of ``width``-word
    shingles is common (A-Z lower-cased; shorter texts are one shingle; a null or
    empty text, or one without words, links with nothing). ``component_id`` is the
    smallest ``doc_id`` that links reach, ``kept`` marks the row that has it. A row
    without ``doc_id`` is linked with nothing, has no component and is kept. Rows
    that repeat a ``doc_id`` are classes by their text. Other columns are not read.

    Equal sets are one class. Candidates are each class's neighbours in 20 sorted
    signature orders; the depth of a region is as long as the prefix that neighbours
    there share. Of a class's neighbours the one met in most orders is verified
    first, then those still in another component. Regions of three or more classes
    that are still in several components then get an exact search (``_rest``).
    """
    sets = stored(sets_of(docs, width))
    full = sets.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stored(
        full.groupBy("digest")
        .agg(F.min(F.struct("doc_id", "signature", "n_shingles")).alias("one"))
        .select(
            F.monotonically_increasing_id().alias("node"),
            "digest",
            F.col("one.doc_id").alias("least_id"),
            F.col("one.n_shingles").alias("n"),
            F.col("one.signature").alias("signature"),
        )
    )
    rows = forest(classes.select("node", "n", "signature"))
    pairs = (
        rows.filter(f"before IS NOT NULL AND 100 * least(n, n_before) >= {percent} * greatest(n, n_before)")
        .groupBy(F.least("before", "node").alias("a"), F.greatest("before", "node").alias("b"))
        .agg(F.sum("shared").alias("weight"))
    )
    pairs = stored(pairs)
    texts = _texts_of(docs, classes.join(rows.select("node").distinct(), "node"), width)
    best = pairs.groupBy("b").agg(F.max(F.struct("weight", F.col("a"))).alias("m")).select(F.col("m.a").alias("a"), "b")
    parts = components(stored(_verified(best, texts, width, percent)))
    parts = _merged(parts, stored(_verified(_apart(pairs, parts), texts, width, percent)))
    placed = rows.join(parts.withColumnRenamed("id", "node"), "node", "left").select(
        "tree", F.substring("path", 1, 4 * DEPTH).alias("prefix"), "node", F.coalesce("component", "node").alias("part")
    )
    mixed_regions = (
        placed.groupBy("tree", "prefix")
        .agg(F.count(F.lit(1)).alias("size"), F.min("part").alias("low"), F.max("part").alias("high"))
        .filter("size > 2 AND low != high")
    )
    open_ = stored(placed.join(mixed_regions.select("tree", "prefix"), ["tree", "prefix"]))
    if not open_.isEmpty():
        found = stored(_rest(texts.join(_families(open_), "node"), width, percent))
        if not found.isEmpty():
            parts = _merged(parts, stored(_verified(found, texts, width, percent)))
    return _labelled(sets, classes, parts)


def _families(open_: DataFrame) -> DataFrame:
    """``node``, ``part`` and ``family`` of the nodes in open regions: the largest part that is in a region with the node."""
    sizes = open_.select("node", "part").distinct().groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    top = open_.join(sizes, "part").groupBy("tree", "prefix").agg(F.max(F.struct("size", "part")).alias("top"))
    return open_.join(top, ["tree", "prefix"]).groupBy("node", "part").agg(F.max("top")["part"].alias("family"))


def _texts_of(docs: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """A text of each class: ``node``, ``text``. Where a ``doc_id`` repeats, the text that has the class's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(lower=True)
        for batch in batches:
            digests, texts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            same = [
                hashlib.blake2b(shingle_set(words([text])[0], width).tobytes(), digest_size=16).digest() == digest
                for digest, text in zip(digests, texts)
            ]
            yield batch.filter(pa.array(same, pa.bool_())).select(["node", "text"])

    wanted = classes.select("node", "digest", F.col("least_id").alias("doc_id"))
    found = id_and_text(docs).join(wanted, "doc_id").select("node", "digest", "text")
    return stored(found.mapInArrow(run, "node long, text string").dropDuplicates(["node"]))


def _labelled(sets: DataFrame, classes: DataFrame, parts: DataFrame) -> DataFrame:
    owned = classes.select("digest", "node", "least_id").join(parts.withColumnRenamed("id", "node"), "node", "left")
    owned = owned.withColumn("component", F.coalesce("component", "node"))
    least = owned.groupBy("component").agg(F.min("least_id").alias("component_id"))
    ids = owned.join(least, "component").select("digest", "component_id")
    linked = sets.filter("n_shingles > 0 AND doc_id IS NOT NULL").join(ids, "digest")
    alone = sets.filter("NOT (n_shingles > 0 AND doc_id IS NOT NULL)").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", "component_id", "text_hash"]
    rows = linked.select(*columns).union(alone.select(*columns))
    return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, width: int = 3, percent: int = 85) -> DataFrame:
    """``docs`` with all its columns, one document of each component; rows without ``doc_id`` stay."""
    gone = near_duplicates(docs, width, percent).filter("NOT kept")
    gone = gone.select(F.col("doc_id").alias("__gone"), F.col("text_hash").alias("__text")).distinct()
    same = (docs["doc_id"] == gone["__gone"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == gone["__text"])
    return docs.join(gone, same, "left_anti")

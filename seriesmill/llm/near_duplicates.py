"""Near-duplicate documents: SuperMinHash signatures, banding, exact check, union-find."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seriesmill.llm import words
from seriesmill.llm.components import connected_components
from seriesmill.llm.scratch import map_batches, sent_if_small, stored

#: Bands and rows of a band. A pair at similarity 0.8 shares no band with probability
#: (1 - 0.8 ** 5) ** 32, about 3 in a million; a pair at 0.15 shares one in 1 of 400 cases.
BANDS, ROWS = 32, 5
SLOTS = BANDS * ROWS
#: Sketch bits in which a pair at similarity 0.8 may differ: 16 of 160 on average, more
#: than LINK_BITS in under 1 of 10^9 cases. A member this near to its bucket's hub in
#: GROUP_BITS belongs to the hub's group; beyond CORE_BITS it looks for another hub, too.
#: A linked partner of a member within CORE_BITS is within CORE_BITS + LINK_BITS.
LINK_BITS, CORE_BITS = 40, 24
GROUP_BITS = CORE_BITS + LINK_BITS
#: Hubs that a bucket gets before what is left of it is compared in pairs.
HUBS = 3

_U = np.uint64
_GOLDEN = 0x9E3779B97F4A7C15
_RANK = _U(52)


def superminhash(elements: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash signature of a set of 64-bit hashes.

    Every element walks through its own random permutation of the slots (a
    Fisher-Yates shuffle driven by its hash). At rank j it offers the value j + r,
    0 <= r < 1, to the j-th slot of its permutation, and a slot keeps its smallest
    offer. Values of rank j are below those of rank j + 1, so all elements take one
    rank after the other, and it stops as soon as no slot is empty. The rank is kept in
    the upper 12 bits. An empty set gives the largest value everywhere.
    """
    signature = np.full(slots, ~_U(0), _U)
    if not len(elements):
        return signature
    own = words.mix(elements + _U(_GOLDEN))
    rows = np.arange(len(own))
    order = None
    for rank in range(slots):
        with np.errstate(over="ignore"):
            draw = words.mix(own + _U((2 * rank + 1) * _GOLDEN & 0xFFFFFFFFFFFFFFFF))
            value = words.mix(own + _U((2 * rank + 2) * _GOLDEN & 0xFFFFFFFFFFFFFFFF))
        chosen = rank + ((draw >> _U(32)) * _U(slots - rank) >> _U(32)).astype(np.int64)
        if rank == 0:
            slot, first = chosen, chosen
        else:
            if order is None:
                order = np.tile(np.arange(slots, dtype=np.int16), (len(own), 1))
                order[rows, first] = 0
            slot = order[rows, chosen].astype(np.int64)
            order[rows, chosen] = order[:, rank]
        np.minimum.at(signature, slot, (_U(rank) << _RANK) | (value >> _U(12)))
        if rank >= (signature >> _RANK).max():
            break
    return signature


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    return np.unique(words.windows(words.hashes(text), width))


def _signature_row(shingles: np.ndarray) -> tuple[list[int], list[int]]:
    signature = superminhash(shingles)
    grid = words.mix(signature).reshape(BANDS, ROWS)
    weight = np.arange(1, 2 * ROWS, 2, dtype=_U)
    with np.errstate(over="ignore"):
        bands = words.mix((grid * weight).sum(axis=1, dtype=_U) + np.arange(BANDS, dtype=_U))
    bits = np.packbits((words.mix(signature) & _U(1)).astype(np.uint8)).tobytes()
    sketch = np.frombuffer(bits.ljust(-(-len(bits) // 8) * 8, b"\0"), np.int64)
    return words.signed(bands).tolist(), sketch.tolist()


def _sign(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in batches:
            out = [[], [], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shingles = shingle_set(text, width)
                bands, sketch = _signature_row(shingles) if len(shingles) else (None, None)
                mixed = words.mix(shingles + _U(7))
                digest = (int(shingles.sum(dtype=_U)), int(mixed.sum(dtype=_U)))
                first, second = (words.signed(np.array(digest, _U))).tolist()
                for column, value in zip(out, (doc_id, len(shingles), first, second, bands, sketch)):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in out[:4]), *(pa.array(c, pa.list_(pa.int64())) for c in out[4:])],
                ["doc_id", "n_shingles", "digest", "digest2", "bands", "sketch"],
            )

    return run


_SIGNED = "doc_id long, n_shingles long, digest long, digest2 long, bands array<long>, sketch array<long>"


def _sets(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in batches:
            found = [words.signed(shingle_set(t, width)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["doc_id", "shingles"]
            )

    return run


def _alike_in_size(a: str, b: str, percent: int) -> Column:
    """Sets whose sizes differ more cannot reach the similarity."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


_SKETCH = [f"sketch{k}" for k in range(-(-SLOTS // 64))]


def _bits_apart(prefix: str) -> Column:
    apart = [F.bit_count(F.col(k).bitwiseXOR(F.col(prefix + k))) for k in _SKETCH]
    return sum(apart[1:], apart[0])


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of `docs` (doc_id, text).

    Two documents are linked when `percent` of the union of their shingle sets is shared
    (shingles of `width` words, A-Z lower-cased). `component_id` is the smallest doc_id
    that can be reached over links, `kept` says that it is the document's own.

    Documents with equal sets form a class, and the class's smallest doc_id stands for
    it from then on, so copies are never compared. Representatives get a SuperMinHash
    signature, whose bands put them into buckets. Instead of all pairs of a bucket, its
    members are compared with a hub, and union-find joins what is linked. Where a group
    around a hub is not one component yet, its other pairs are searched by what each
    member differs in from the group's middle (see `_by_differences`), which finds every
    link and again makes no pairs of all members. A link counts only after a check on
    full sets.

    Null or wordless texts have no shingles and are linked with nothing. A text with
    fewer words than a shingle is one shingle. Rows that share a doc_id count as one
    document. A null doc_id takes part as a copy only: it gets its class's component,
    or null and kept, and never stands for a class. Other columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = stored(map_batches(texts, _sign(width), _SIGNED), "signatures")
    key = ["digest", "digest2", "n_shingles"]
    classes = signed.where("n_shingles > 0").groupBy(*key).agg(
        F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")
    )
    classes = stored(classes.where("rep is not null"), "classes")
    components = _components_of(classes, texts, width, percent)
    named = classes.select(*key, "rep").join(components, F.col("rep") == F.col("node"), "left")
    named = stored(named.select(*key, F.coalesce("component", "rep").alias("component_id")), "class-components")
    rows = signed.select("doc_id", *key).join(named, key, "left")
    rows = rows.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return rows.select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def _components_of(classes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """(node, component) of the representatives that are linked with another one."""
    members = _bucket_members(classes)
    groups, rest = _groups(members)
    ids = groups.select(F.explode(F.array("hub", "rep")).alias("doc_id")).unionByName(rest.select(F.col("rep").alias("doc_id")))
    ids = stored(ids.distinct(), "compared-ids")
    involved = texts.join(sent_if_small(ids), "doc_id", "left_semi").select("doc_id", "text")
    sets = stored(map_batches(involved, _sets(width), "doc_id long, shingles array<long>"), "shingle-sets")

    near = groups.where((F.col("bits") <= LINK_BITS) & _alike_in_size("n_shingles", "hub_n", percent))
    pairs = stored(near.select(*_pair("rep", "hub")).distinct(), "hub-pairs")
    compared = stored(_compared(pairs, sets), "compared")
    links = compared.where(_linked(percent)).select("a", "b")
    components = connected_components(links)

    unsettled = _unsettled(groups.select("hub", "rep"), "hub", components)
    more = rest_pairs = None
    if not unsettled.isEmpty():
        middles = stored(_middles(unsettled, compared), "middles")
        differences = stored(_differences(middles, sets), "differences")
        near_middle = differences.where(_near_middle(percent)).select(*_pair("rep", "middle"))
        links = links.unionByName(near_middle)
        components = connected_components(links)
        more = _by_differences(differences, components, percent)
    if not rest.isEmpty():
        rest_pairs = _across(rest, components, percent)
    if more is None and rest_pairs is None:
        return components
    pairs = more if rest_pairs is None else rest_pairs if more is None else more.unionByName(rest_pairs)
    pairs = stored(pairs.distinct(), "last-pairs")
    last = stored(_compared(pairs, sets).where(_linked(percent)).select("a", "b"), "last-links")
    return components if last.isEmpty() else connected_components(links.unionByName(last))


def _bucket_members(classes: DataFrame) -> DataFrame:
    """(bucket, rep, n_shingles, sketch) of the buckets with two representatives or more."""
    banded = classes.select(F.posexplode("bands").alias("band", "hash"), "rep")
    banded = banded.select(F.xxhash64("band", "hash").alias("bucket"), "rep")
    shared = banded.groupBy("bucket").agg(F.min("rep").alias("least"), F.max("rep").alias("most"))
    shared = stored(shared.where("least <> most").select("bucket"), "buckets")
    sketches = [F.col("sketch")[k].alias(name) for k, name in enumerate(_SKETCH)]
    members = banded.join(shared, "bucket").join(classes.select("rep", "n_shingles", *sketches), "rep")
    return stored(members, "bucket-members")


def _groups(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups (hub, rep, hub_n, n_shingles, bits) and the members that no group settles.

    Each bucket's smallest member is its first hub. Members outside its core choose
    the next hub among themselves, and so on. Two members that are linked are in a
    common group if either is in the core of a hub, since the other is then in its
    group. What is left after HUBS hubs comes back with the hubs whose group it is in.
    """
    pool, groups = members.withColumn("seen", F.lit(0)), None
    for turn in range(HUBS):
        hub = F.min(F.struct("rep", "n_shingles", *_SKETCH)).alias("hub")
        hubs = pool.groupBy("bucket").agg(hub, F.count(F.lit(1)).alias("members")).where("members > 1")
        names = {"rep": "hub", "n_shingles": "hub_n"} | {k: f"hub_{k}" for k in _SKETCH}
        hubs = stored(hubs.select("bucket", "hub.*").withColumnsRenamed(names), "hubs")
        tested = pool.join(hubs, "bucket").where("rep <> hub").withColumn("bits", _bits_apart("hub_"))
        tested = stored(tested.drop(*[f"hub_{k}" for k in _SKETCH]), "hub-distances")
        own = tested.where(F.col("bits") <= GROUP_BITS).select("hub", "rep", "hub_n", "n_shingles", "bits")
        groups = own if groups is None else groups.unionByName(own)
        seen = F.col("seen") + F.when(F.col("bits") <= GROUP_BITS, 1 << turn).otherwise(0)
        pool = tested.where(F.col("bits") > CORE_BITS).withColumn("seen", seen).select(members.columns + ["seen"])
    several = pool.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1").select("bucket")
    rest = pool.join(stored(several, "rest-buckets"), "bucket")
    return stored(groups.distinct(), "groups"), stored(rest, "rest")


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _with_sets(pairs: DataFrame, a: str, b: str, sets: DataFrame) -> DataFrame:
    """Add the full sets of both ends to stored pairs, of which `a` may have many partners.

    Few pairs are sent to where the sets are, so a set moves only once, as the one of
    `b`, to where `a` is dealt to; the sets of `a`, one for all its partners, come last.
    Many pairs are dealt out with the sets by `b` before. Adaptive execution splits a
    document with many partners.
    """
    hubs = stored(pairs.select(F.col(a).alias("doc_id")).distinct(), "first-ends")
    hubs = sets.join(sent_if_small(hubs), "doc_id", "left_semi")
    hubs = hubs.select(F.col("doc_id").alias(a), F.col("shingles").alias("of_a"))
    members = sets.select(F.col("doc_id").alias(b), F.col("shingles").alias("of_b"))
    return members.join(sent_if_small(pairs), b).join(hubs, a)


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b, common): sizes of the full sets and of what they share."""
    common = F.size(F.array_intersect("of_a", "of_b")).alias("common")
    return _with_sets(pairs, "a", "b", sets).select("a", "b", F.size("of_a").alias("n_a"), F.size("of_b").alias("n_b"), common)


def _linked(percent: int) -> Column:
    return F.col("common") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("common")) * percent


def _labelled(rows: DataFrame, components: DataFrame) -> DataFrame:
    """Add the component of each `rep`."""
    found = sent_if_small(components.withColumnRenamed("node", "rep"))
    return rows.join(found, "rep", "left").withColumn("component", F.coalesce("component", "rep"))


def _unsettled(groups: DataFrame, hub: str, components: DataFrame) -> DataFrame:
    """(hub, rep) of the groups of three or more that are not in one component; the hub is a member."""
    own = groups.select(hub, F.col(hub).alias("rep"))
    everyone = groups.unionByName(own).distinct()
    counts = _labelled(everyone, components).groupBy(hub).agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("members")
    )
    open_ = stored(counts.where("low <> high and members > 2").select(hub), "open-groups")
    return stored(everyone.join(open_, hub), "open-members")


def _middles(members: DataFrame, compared: DataFrame) -> DataFrame:
    """(middle, rep) for each member of a group: the middle is the hub's nearest neighbour.

    If members are edits of one text, the distance to the hub grows with a member's own
    edits, so the nearest one has the fewest of them.
    """
    apart = (F.col("n_a") + F.col("n_b") - 2 * F.col("common")).alias("apart")
    both = compared.select(F.col("a").alias("hub"), F.col("b").alias("other"), apart)
    both = both.unionByName(compared.select(F.col("b").alias("hub"), F.col("a").alias("other"), apart))
    nearest = both.groupBy("hub").agg(F.min(F.struct("apart", "other")).alias("n"))
    nearest = stored(nearest.select("hub", F.col("n.other").alias("nearest")), "nearest")
    found = members.join(nearest, "hub", "left").select(F.coalesce("nearest", "hub").alias("middle"), "rep")
    return found.where("middle <> rep").distinct()


def _differences(middles: DataFrame, sets: DataFrame) -> DataFrame:
    """(middle, rep, n_middle, n_rep, apart): shingles that are in one of the two sets only."""
    both = _with_sets(middles, "middle", "rep", sets)
    apart = F.concat(F.array_except("of_a", "of_b"), F.array_except("of_b", "of_a"))
    return both.select("middle", "rep", F.size("of_a").alias("n_middle"), F.size("of_b").alias("n_rep"), apart.alias("apart"))


def _near_middle(percent: int) -> Column:
    """The same as a similarity of `percent`: few enough differences for the sizes."""
    return F.size("apart") * (100 + percent) <= (F.col("n_middle") + F.col("n_rep")) * (100 - percent)


def _by_differences(differences: DataFrame, components: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of one group that may be linked though at least one end is not linked to the middle.

    Let D(x) be what x differs in from the middle m, and q = (100 - percent) / (100 +
    percent). Then x and y differ in |D(x)| + |D(y)| - 2 |D(x) & D(y)| shingles, and they
    are linked if that is at most q (|x| + |y|). If x is not linked to m, |D(x)| is over
    q (|x| + |m|), so the two must share more than (|D(y)| + q (|m| - |y|)) / 2 of y's
    differences. Independent edits do not share that many. y therefore only offers as
    many of its rarest differences as must contain a shared one, and x looks up all of
    its own. Two that meet are a pair only if enough differences of both are shared with
    anybody at all, which rules out most texts with edits of their own. Pairs that are in
    one component already are left out.
    """
    q = (100 - percent) / (100 + percent)
    labelled = _labelled(differences, components)
    spread = labelled.groupBy("middle").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    open_ = stored(spread.where("low <> high").select("middle"), "open-middles")
    n = F.size("apart")
    least = F.greatest(F.lit(1), F.floor((n + q * (F.col("n_middle") - F.col("n_rep"))) / 2 + 1 - 1e-6))
    each = labelled.join(open_, "middle").select(
        "middle", "rep", "component", "n_rep", _near_middle(percent).alias("near"), n.alias("n"), (n - least + 1).alias("offers"),
        F.explode("apart").alias("shingle"),
    )
    each = stored(each, "each-difference")
    counts = each.groupBy("middle", "shingle").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1")
    shared = each.join(stored(counts, "shared-differences"), ["middle", "shingle"])
    own = W.partitionBy("middle", "rep")
    ranked = shared.withColumn("rank", F.row_number().over(own.orderBy("holders", "shingle")))
    # Differences that nobody shares come first in the order and need no row.
    ranked = ranked.withColumn("shared", F.count(F.lit(1)).over(own))
    offered = (F.col("n") - F.col("shared") + F.col("rank") <= F.col("offers")).alias("offered")
    ranked = stored(ranked.select("middle", "shingle", "rep", "component", "near", "n", "n_rep", "shared", offered), "ranked-differences")
    names = {"rep": "x", "component": "of_x", "n": "n_x", "n_rep": "size_x", "shared": "shared_x"}
    asking = ranked.where("not near").drop("near", "offered").withColumnsRenamed(names)
    offers = ranked.where("offered").drop("near", "offered")
    offers = offers.withColumnsRenamed({old: new[:-1] + "y" for old, new in names.items()})
    # Twice the differences that a linked pair shares at least, times 100 + percent.
    needed = (F.col("n_x") + F.col("n_y")) * (100 + percent) - (F.col("size_x") + F.col("size_y")) * (100 - percent)
    possible = needed <= 2 * (100 + percent) * F.least("shared_x", "shared_y")
    found = asking.join(offers, ["middle", "shingle"]).where((F.col("x") != F.col("y")) & (F.col("of_x") != F.col("of_y")) & possible)
    return found.select(*_pair("x", "y")).distinct()


def _across(rest: DataFrame, components: DataFrame, percent: int) -> DataFrame:
    """Pairs of members that are in no common group, where size and sketch allow a link."""
    rows = stored(_labelled(rest, components), "rest-labelled")
    other = rows.withColumnsRenamed({c: f"other_{c}" for c in rows.columns if c != "bucket"})
    both = rows.join(other, "bucket").where(
        (F.col("rep") < F.col("other_rep")) & (F.col("component") != F.col("other_component"))
        & (F.col("seen").bitwiseAND(F.col("other_seen")) == 0)
        & _alike_in_size("n_shingles", "other_n_shingles", percent) & (_bits_apart("other_") <= LINK_BITS)
    )
    return both.select(*_pair("rep", "other_rep")).distinct()


def without_copies(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, with the columns of `docs`: the one with the smallest doc_id.

    Documents without words are linked with nothing and stay. Equal rows are one
    document, of which one row stays. Rows that share only the doc_id stay or go together.
    """
    judged = stored(near_duplicates(docs, width, percent).groupBy("doc_id").agg(
        F.max("kept").alias("kept"), (F.count(F.lit(1)) > 1).alias("several")
    ), "kept-documents")
    gone = stored(judged.where("not kept").select(F.col("doc_id").alias("_gone")), "gone")
    left = docs.join(sent_if_small(gone), docs.doc_id.eqNullSafe(gone["_gone"]), "left_anti")
    several = stored(judged.where("kept and several").select(F.col("doc_id").alias("_several")), "several")
    if several.isEmpty():
        return left
    # Only rows whose doc_id occurs again are compared as a whole.
    again, several = left.doc_id.eqNullSafe(several["_several"]), sent_if_small(several)
    return left.join(several, again, "left_anti").unionByName(left.join(several, again, "left_semi").distinct())

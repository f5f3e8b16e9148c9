"""Near-duplicate documents by b-bit MinHash."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tripweave.llm.components import components
from tripweave.llm.text import blocks, mix
from tripweave.session import store

# Minima of a sketch, and those of each band. A pair of similarity 0.8 shares no
# band with a chance of 4e-6, one of 0.85 of 2e-8.
HASHES = 512
BANDS = 24
BAND_ROWS = 4

# Bits kept of each minimum, and longs that hold them all.
BITS = 2
LONGS = HASHES * BITS // 64

# Candidates whose estimate is below the threshold by more than so many standard
# errors are dropped: of pairs at the threshold, one in 300,000.
SIGMAS = 4.5

# Documents that one task compares with the same leader.
TOGETHER = 512

# Classes of a band, outside its largest part, that all others are compared with at a time.
FEW = 4096

_FACTORS = np.random.RandomState(11).randint(1, 1 << 62, HASHES).astype(np.uint64) * np.uint64(2) + np.uint64(1)

SHARE = ["group", "share"]
PARTNERS = "group long, share int, node long, partners array<long>, is_member boolean"
SKETCHES = "doc_id long, n_shingles long, digest binary, bits array<long>, bands array<long>"


def minima(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The least value of each set under each hash function; sets begin at `starts`."""
    out = np.empty((HASHES, len(starts)), np.uint64)
    for i in range(HASHES):
        np.minimum.reduceat(hashes * _FACTORS[i], starts, out=out[i])
    return out


def low_bits(least: np.ndarray) -> np.ndarray:
    """The low bits of the minima's upper halves, packed: one row of longs per set."""
    kept = (least >> np.uint64(32)) & np.uint64((1 << BITS) - 1)
    each = 64 // BITS
    packed = np.zeros((least.shape[1], LONGS), np.uint64)
    for i in range(HASHES):
        packed[:, i // each] |= kept[i] << np.uint64(BITS * (i % each))
    return packed.view(np.int64)


def band_keys(least: np.ndarray) -> np.ndarray:
    """One key per set and band, from all minima of the band."""
    keys = np.empty((least.shape[1], BANDS), np.uint64)
    for band in range(BANDS):
        total = np.full(least.shape[1], band + 1, np.uint64)
        for row in least[band * BAND_ROWS : (band + 1) * BAND_ROWS]:
            total = mix(total ^ row)
        keys[:, band] = total
    return keys.view(np.int64)


def similarity(a: list[Column], b: list[Column]) -> Column:
    """Estimate from packed bits: the share of equal minima less chance collisions."""
    low = F.lit(0x5555555555555555)
    unequal = sum(
        (F.bit_count((x.bitwiseXOR(y)).bitwiseOR(F.shiftrightunsigned(x.bitwiseXOR(y), 1)).bitwiseAND(low)))
        for x, y in zip(a, b, strict=True)
    )
    chance = 2.0**-BITS
    return (1 - unequal / F.lit(float(HASHES)) - chance) / (1 - chance)


def _least_estimate(threshold: float) -> float:
    chance = 2.0**-BITS
    equal = threshold + (1 - threshold) * chance
    return threshold - SIGMAS * (equal * (1 - equal) / HASHES) ** 0.5 / (1 - chance)


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """Groups of documents that links of similar shingle sets hold together.

    `docs` has doc_id and text. Words are runs of characters other than ASCII
    white space, with A-Z in lower case; a document's set holds its distinct
    runs of `shingle` words, or all its words if it has fewer. Two documents
    are linked if their sets have 100 * common >= `percent` * union. A text
    that is null or without words has no set and no links.

    Returns one row per row of `docs`: doc_id, n_shingles, component_id (the
    smallest doc_id that links reach) and kept (doc_id is component_id). Rows
    that share a doc_id are taken as one document where links are concerned,
    but for texts without words, whose component is their own doc_id.
    A row without doc_id has no links, a null component_id, and is kept.

    Equal sets are one class; classes are told apart by a 64-bit hash. Classes that share a band are compared with the
    band's smallest class, its leader, by estimate; each is compared with the
    smallest of its leaders on full sets. What that leaves apart is compared
    with further leaders and with its nearest in other components, and at last
    with all that still is in another component. So the work stays in
    proportion to the rows of a group of copies, links to the classes that they
    join, and no pair of different components that shares a band is left out.
    """
    sketches = store(_sketches(docs, shingle), "sketches")
    named = sketches.where("doc_id is not null and digest is not null")
    classes = store(
        named.groupBy("digest").agg(
            F.min("doc_id").alias("node"), F.first("bits").alias("bits"), F.first("bands").alias("bands")
        ).withColumn("class_id", F.xxhash64("digest")),
        "classes",
    )
    shared = store(_shared_bands(classes, _least_estimate(percent / 100)), "bands")
    sets = store(_sets(docs, shared.select("node").distinct(), shingle), "sets")

    led = shared.where("alike and node <> leader").select("node", "leader").distinct()
    pairs = store(led.groupBy("node").agg(F.min("leader").alias("leader")), "pairs")
    nothing = docs.sparkSession.createDataFrame([], "node long, component long")
    first = _confirmed(sets, *_by_leader(pairs), percent).union(_same_documents(named, classes))
    parts = _joined(nothing, first)
    others = _placed(led, parts).where("part <> leader_part").select("node", "leader")
    # Tried once, and in vain, if they are still apart.
    others = store(others.join(pairs, ["node", "leader"], "left_anti"), "others")
    least = _least_estimate(percent / 100)
    near = _confirmed(sets, *_by_band(_across(shared, classes, parts, least, nearest=True)), percent)
    parts = _joined(parts, near.union(_confirmed(sets, *_by_leader(others), percent)))
    parts = _joined(parts, _confirmed(sets, *_by_band(_across(shared, classes, parts, least)), percent))

    nodes = classes.select("digest", "node")
    found = sketches.where("doc_id is not null").select("doc_id", "n_shingles", "digest")
    found = (
        found.join(nodes, "digest", "left")
        .join(parts, "node", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "node", "doc_id").alias("component_id"))
    )
    unnamed = sketches.where("doc_id is null").select(
        "doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id")
    )
    return found.unionByName(unnamed).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _same_documents(named: DataFrame, classes: DataFrame) -> DataFrame:
    """Links a, b between the classes that texts of one doc_id belong to."""
    several = named.groupBy("doc_id").agg(F.min("digest").alias("least"), F.max("digest").alias("most"))
    several = several.where("least <> most").select("doc_id")
    own = store(named.join(several, "doc_id", "left_semi").select("doc_id", "digest").distinct(), "several")
    placed = store(own.join(classes.select("digest", "node"), "digest").select("doc_id", "node"), "placed")
    low = store(placed.groupBy("doc_id").agg(F.min("node").alias("a")), "lowest")
    return placed.join(low, "doc_id").where("node <> a").select("a", F.col("node").alias("b")).distinct()


def _joined(parts: DataFrame, links: DataFrame) -> DataFrame:
    """Components so far and further links, as components."""
    if links.isEmpty():
        return parts
    return components(parts.select(F.col("node").alias("a"), F.col("component").alias("b")).union(links))


def _bits(prefix: str) -> list[Column]:
    return [F.col(prefix)[i] for i in range(LONGS)]


def _shared_bands(classes: DataFrame, least: float) -> DataFrame:
    """Bands of two nodes and more: band, node, class_id, leader, leads, alike.

    A node with several texts has a class for each. Of a band's classes one
    leads: the least of those of its least node, `leader`. `leads` says which
    it is, `alike` whether a class is like it by estimate.
    """
    rows = classes.select(F.explode("bands").alias("band"), "node", "class_id")
    least_class = F.min(F.struct("node", "class_id"))
    first = rows.groupBy("band").agg(least_class.alias("first"), F.max("node").alias("last")).where("first.node < last")
    first = first.select("band", F.col("first.node").alias("leader"), F.col("first.class_id").alias("leader_class"))
    shared = rows.join(first, "band").join(classes.select("class_id", "bits"), "class_id")
    shared = shared.withColumn("leads", F.col("class_id") == F.col("leader_class"))
    leaders = shared.where("leads").select("band", F.col("bits").alias("led"))
    alike = similarity(_bits("bits"), _bits("led")) >= least
    return shared.join(leaders, "band").select("band", "node", "class_id", "leader", "leads", alike.alias("alike"))


def _placed(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """Add the components that node and leader lie in so far: part, leader_part."""
    own = parts.withColumnRenamed("component", "part")
    led = parts.select(F.col("node").alias("leader"), F.col("component").alias("leader_part"))
    return rows.join(own, "node", "left").join(led, "leader", "left").select(
        *rows.columns, F.coalesce("part", "node").alias("part"), F.coalesce("leader_part", "leader").alias("leader_part")
    )


def _across(
    shared: DataFrame, classes: DataFrame, parts: DataFrame, least: float, nearest: bool = False
) -> DataFrame:
    """Classes of a band that are alike by estimate and lie in different components.

    One side are the classes outside the band's largest part, in shares of
    `FEW`; all of the band pass by each share, split themselves if they are
    many. A class comes with the list of its partners in the share, so that
    rows stay in proportion to the classes: group, share, node, partners,
    is_member. Partners have a row of their own, without is_member. The class
    that leads was compared with all of its band and needs no more partners.

    With `nearest`, each of the classes outside gets the one of each batch that
    passes by which is most like it. Links to these join most of a family, so
    that the lists of a second pass hold only what no link has joined.
    """
    own = parts.withColumnRenamed("component", "part")
    rows = shared.where("not leads").select("band", "node", "class_id").join(own, "node", "left")
    rows = rows.select("band", "node", "class_id", F.coalesce("part", "node").alias("part"))
    sizes = rows.groupBy("band", "part").count()
    bands = sizes.groupBy("band").agg(
        F.max_by("part", F.struct("count", "part")).alias("main"),
        F.sum("count").alias("all"),
        (F.sum("count") - F.max("count")).alias("few"),
    )
    bands = bands.where("few > 0").select(
        "band",
        "main",
        F.expr(f"cast(ceil(few / {FEW}) as int)").alias("shares"),
        F.expr(f"cast(ceil(all / {4 * FEW}) as int)").alias("turns"),
    )
    mixed = rows.join(bands, "band").join(classes.select("class_id", "bits", "bands"), "class_id")
    share, turn = F.expr("pmod(hash(class_id), shares)"), F.expr("pmod(xxhash64(class_id), turns)").cast("int")
    roles = F.array(F.lit(False), F.lit(True))
    mixed = mixed.select("*", F.explode(roles).alias("is_member")).where("is_member or part <> main")
    shares = F.when(F.col("is_member"), F.sequence(F.lit(0), F.col("shares") - 1)).otherwise(F.array(share))
    turns = F.when(F.col("is_member"), F.array(turn)).otherwise(F.sequence(F.lit(0), F.col("turns") - 1))
    mixed = mixed.withColumn("share", F.explode(shares)).withColumn("turn", F.explode(turns))
    key = ["band", "share", "turn"]
    return (
        mixed.select(*key, "is_member", "node", "part", "main", "bits", "bands")
        .repartition(*key)
        .sortWithinPartitions(*key, "is_member")
        .mapInArrow(_partners(least, nearest), PARTNERS)
    )


def _partners(least: float, nearest: bool):
    """Estimate each class of a sorted partition against its share's few."""

    def matrix(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy().reshape(len(column), -1)

    def partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, few = None, []
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
            member = batch.column(3).to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1) | (member[1:] != member[:-1])) + 1
            for start, end in zip([0, *edges.tolist()], [*edges.tolist(), len(member)], strict=True):
                if start == end:
                    continue
                part = batch.slice(start, end - start)
                rows = [part.column(i).to_numpy() for i in (4, 5, 6)] + [matrix(part.column(i)) for i in (7, 8)]
                if key != tuple(keys[start]):
                    key, few = tuple(keys[start]), []
                if not member[start]:
                    few.append(rows)
                    continue
                if len(few) > 1:
                    few = [[np.concatenate(column) for column in zip(*few, strict=True)]]
                if few:
                    pairs = _estimated(int(key[0]), rows, few[0], least, nearest)
                    yield _listed(int(key[0]), int(key[1]), rows[0], few[0][0], pairs)

    return partners


def _estimated(
    band: int, rows: list, few: list, least: float, nearest: bool
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places in `rows` and in `few`, block by block; with `nearest`, one for each of the few at most."""
    node, part, main, bits, bands = rows
    x_node, x_part, _, x_bits, x_bands = few
    chance = 2.0**-BITS
    most = int(HASHES * (1 - (least * (1 - chance) + chance)))
    low = np.int64(0x5555555555555555)
    best, best_at = np.full(len(x_node), HASHES + 1, np.int32), np.zeros(len(x_node), np.int64)
    # So many at a time that their comparison takes some 16 MB.
    step = max(1, (1 << 21) // (LONGS * len(x_node)))
    for i in range(0, len(node), step):
        own = slice(i, i + step)
        unequal = np.zeros((len(node[own]), len(x_node)), np.int32)
        for word in range(LONGS):
            differ = bits[own, word][:, None] ^ x_bits[:, word]
            unequal += np.bitwise_count((differ | differ >> 1) & low)
        # Two classes outside the largest part meet twice: once is enough, unless each looks for its nearest.
        once = nearest | (part[own] == main[own])[:, None] | (node[own][:, None] < x_node)
        at, x = np.nonzero((unequal <= most) & (part[own][:, None] != x_part) & once)
        # A pair is taken up in the first of the bands it shares only. If one of the
        # two leads that band, they have been compared.
        first = np.zeros(len(at), bool)
        for j in range(0, len(at), 2048):
            pair = slice(j, j + 2048)
            mine, theirs = bands[own][at[pair]], x_bands[x[pair]]
            common = (mine[:, :, None] == theirs[:, None, :]).any(axis=2)
            first[pair] = np.where(common, mine, np.iinfo(np.int64).max).min(axis=1) == band
        at, x = at[first], x[first]
        if not nearest:
            yield at + i, x
            continue
        far = np.full(unequal.shape, HASHES + 1, np.int32)
        far[at, x] = unequal[at, x]
        nearer = far.min(axis=0) < best
        best_at[nearer] = far.argmin(axis=0)[nearer] + i
        best[nearer] = far.min(axis=0)[nearer]
    if nearest:
        x = np.flatnonzero(best <= most)
        yield best_at[x], x


def _listed(
    band: int, share: int, node: np.ndarray, x_node: np.ndarray, pairs: Iterator[tuple[np.ndarray, np.ndarray]]
) -> pa.RecordBatch:
    nodes, lists, found = [], [], set()
    for at, x in pairs:
        for k in np.unique(at):
            partners = x_node[x[at == k]]
            nodes.append(int(node[k]))
            lists.append(partners)
            found.update(partners.tolist())
    rows = nodes + sorted(found)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([band] * len(rows), pa.int64()),
            pa.array([share] * len(rows), pa.int32()),
            pa.array(rows, pa.int64()),
            pa.array(lists + [[]] * len(found), pa.list_(pa.int64())),
            pa.array([True] * len(nodes) + [False] * len(found), pa.bool_()),
        ],
        names=["group", "share", "node", "partners", "is_member"],
    )


def _sketches(docs: DataFrame, shingle: int) -> DataFrame:
    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1), lower=True):
                yield _sketch(batch.column(0).slice(block.rows.start, len(block.rows)), block, shingle)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(sketched, SKETCHES)


def _sketch(doc_ids: pa.Array, block, shingle: int) -> pa.RecordBatch:
    hashes, places = block.shingles(shingle, short=True)
    full = np.flatnonzero(np.diff(places))
    bits, bands = [None] * len(doc_ids), [None] * len(doc_ids)
    digests, sizes = [None] * len(doc_ids), [0] * len(doc_ids)
    if len(full):
        least = minima(hashes, places[full])
        for i, own_bits, own_bands in zip(full, low_bits(least), band_keys(least), strict=True):
            distinct = np.unique(hashes[places[i] : places[i + 1]])
            digests[i] = hashlib.blake2b(distinct.tobytes(), digest_size=16).digest()
            sizes[i] = len(distinct)
            bits[i], bands[i] = own_bits, own_bands
    return pa.RecordBatch.from_arrays(
        [
            doc_ids,
            pa.array(sizes, pa.int64()),
            pa.array(digests, pa.binary()),
            pa.array(bits, pa.list_(pa.int64())),
            pa.array(bands, pa.list_(pa.int64())),
        ],
        names=["doc_id", "n_shingles", "digest", "bits", "bands"],
    )


def _sets(docs: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """The full shingle sets of some documents: node, members (sorted 64-bit hashes)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1), lower=True):
                hashes, places = block.shingles(shingle, short=True)
                sets = [np.unique(hashes[a:b]).tobytes() for a, b in zip(places[:-1], places[1:], strict=True)]
                own = batch.column(0).slice(block.rows.start, len(block.rows))
                yield pa.RecordBatch.from_arrays([own, pa.array(sets, pa.binary())], names=["node", "members"])

    wanted = docs.select(F.col("doc_id").cast("long").alias("node"), "text").join(nodes, "node", "left_semi")
    return wanted.mapInArrow(rows, "node long, members binary")


def _by_leader(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs (node, leader) as members and leaders, in groups of `TOGETHER` members of one leader."""
    sizes = pairs.groupBy("leader").agg(F.count("*").alias("n"))
    shares = sizes.select("leader", F.expr(f"cast(ceil(n / {TOGETHER}) as int)").alias("shares"))
    members = pairs.join(shares, "leader").select(
        F.col("leader").alias("group"),
        F.expr("pmod(hash(node), shares)").alias("share"),
        "node",
        F.array("leader").alias("partners"),
    )
    every = F.explode(F.expr("sequence(0, shares - 1)")).alias("share")
    return members, shares.select(F.col("leader").alias("group"), every, F.col("leader").alias("node"))


def _by_band(across: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What `_across` found, stored, as members and leaders."""
    across = store(across, "across")
    return across.where("is_member").drop("is_member"), across.where("not is_member").select(*SHARE, "node").distinct()


def _confirmed(sets: DataFrame, members: DataFrame, leaders: DataFrame, percent: int) -> DataFrame:
    """Members and partners that full sets confirm, as links a, b.

    `members` has group, share, node and partners; the partners' sets are
    those of `leaders` (group, share, node), which wait in a task while the
    members pass by. A link between two that links of the same share hold
    together already is left out, so that a share of n members and k partners
    gives less than n + k links, with the components that all would have.
    """
    rows = members.withColumn("is_member", F.lit(True)).unionByName(
        leaders.withColumns({"partners": F.lit(None).cast("array<long>"), "is_member": F.lit(False)})
    )
    gathered = (
        rows.join(sets, "node")
        .select(*SHARE, "is_member", "node", "partners", "members")
        .repartition(*SHARE)
        .sortWithinPartitions(*SHARE, "is_member")
    )
    return store(gathered.mapInArrow(_compared(percent), "a long, b long"), "confirmed")


def _compared(percent: int):
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, kept, roots = None, {}, {}
        for batch in batches:
            found = []
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for key, share, is_member, node, partners, members in zip(*columns, batch.column(5), strict=True):
                if (key, share) != group:
                    group, kept, roots = (key, share), {}, {}
                own = np.frombuffer(members.as_buffer(), np.uint64)
                if not is_member:
                    kept.setdefault(node, []).append(own)
                    continue
                for partner in partners:
                    mine, theirs = _root(roots, node), _root(roots, partner)
                    if mine != theirs and any(alike(own, other, percent) for other in kept[partner]):
                        found.append((node, partner))
                        roots[mine] = theirs
                # No root is a mere member, which only its own rows ask for.
                if node not in kept:
                    roots.pop(node, None)
            yield pa.RecordBatch.from_arrays(
                [pa.array([pair[i] for pair in found], pa.int64()) for i in (0, 1)], names=["a", "b"]
            )

    return links


def _root(roots: dict[int, int], node: int) -> int:
    """The node that stands for all that are joined with `node`; nodes passed on the way come nearer to it."""
    while (up := roots.get(node, node)) != node:
        roots[node] = roots.get(up, up)
        node = up
    return node


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have 100 * common >= percent * union."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort()
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * common >= percent * (len(a) + len(b) - common)

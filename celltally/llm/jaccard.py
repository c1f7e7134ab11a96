"""N-gram Jaccard join: grouped prefix join.

Two documents link when the Jaccard similarity of their sets of word shingles
reaches a threshold. Shingles are ordered by how many documents hold them
(exact counts, asked slab by slab), rarest first; linked documents then share a
shingle within short prefixes. A shingle of one document alone links nothing
and is left out of the prefixes.

Documents with equal sets form one class, classes with identical prefixes and
size one group. Group pairs come from shared prefix shingles, filtered by size,
by how many of their shingles any other document holds, and by position. To find components without all pairs of a large group, the first
round pairs the groups of a shingle with the most ordinary of them (fewest
shingles of its own); the second takes
the candidates whose documents are still in different components. Both expand
groups to members and verify each pair on its whole texts, so no link between
components is lost. All links inside a component are counted on request: its
classes are cut into bands of size and blocks, and a task compares two blocks
as matrices. No row per pair is made; the arithmetic grows with the square of
the different sets of a component that are near in size.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from celltally.llm import slabs
from celltally.llm import textkit as tk
from celltally.llm.common import land, small
from celltally.llm.links import components

#: Near-duplicate defaults of the library: five words, 80 %.
WORDS, PERCENT = 5, 80
#: Members verified against one text by one task at a time.
SALT_MEMBERS = 256
#: Classes of a component, and bytes of their texts, in a block whose links are counted.
BLOCK_MEMBERS, BLOCK_BYTES = 512, 2 << 20
#: Cells of a matrix of shingles by classes that are held at a time.
CELLS = 1 << 21


def shingle_sets(data: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and the offsets of the texts.

    A-Z count as a-z. A text of fewer than ``k`` words has one shingle, all of
    its words; without words it has none.
    """
    starts, ends, first = tk.words(data, offs)
    h = tk.hash_spans(data, starts, ends, lower=True)
    n = np.diff(first)
    ok = np.flatnonzero(tk.whole(first, k))
    hashes, doc = [tk.windows(h, k)[ok] if len(ok) else np.zeros(0, tk.U)], [tk.owner(first)[ok]]
    for short in range(1, k):
        own = np.flatnonzero(n == short)
        if len(own):
            hashes.append(tk.windows(h, short)[first[:-1][own]])
            doc.append(own)
    return distinct_by(np.concatenate(doc), np.concatenate(hashes), len(n))


def distinct_by(doc: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(h)
    order = order[np.argsort(doc[order].astype(np.uint16 if n < 65536 else np.int64), kind="stable")]
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], np.concatenate([[0], np.cumsum(np.bincount(doc[new], minlength=n))])


class SlabSets:
    """Shingle sets of a slab's documents."""

    def __init__(self, table: pa.Table, k: int):
        self.table, _ = slabs.ordered(table)
        sets, upto = [], [np.zeros(1, np.int64)]
        for part in tk.slices(self.table):
            h, offs = shingle_sets(*tk.text_bytes(part.column("text")), k)
            sets.append(h)
            upto.append(offs[1:] + upto[-1][-1])
        self.h = np.concatenate(sets) if sets else np.zeros(0, tk.U)
        self.offs = np.concatenate(upto)

    def keys(self, n_shards: int):
        """Sorted distinct keys of the slab, how many documents hold each, and the key of each entry."""
        narrow = slabs.narrow(self.h, n_shards)
        keys, which, n = np.unique(narrow, return_inverse=True, return_counts=True)
        return keys, n, which


def ask_counts(table: pa.Table, n_shards: int, k: int) -> pa.Table:
    """Sends each shard its keys (4 bytes) and in how many documents of the slab each is (1 byte, 255 for more)."""
    keys, n, _ = SlabSets(table, k).keys(n_shards)
    present, cuts = slabs.shard_cuts(keys >> tk.U(32))
    return slabs.rows_of(table.column("slab")[0].as_py(), 1, present, cuts, keys.astype(np.uint32), np.minimum(n, 255).astype(np.uint8))


def rarity(n: np.ndarray) -> np.ndarray:
    """A count in one byte: exact up to 64, then eight steps per doubling."""
    return np.where(n <= 64, n, np.minimum(64 + 8 * np.log2(np.maximum(n, 64) / 64), 255)).astype(np.uint8)


def answer_counts(table: pa.Table) -> pa.Table:
    """The rarity of each key over all slabs."""
    rows = slabs.collected(table)
    arrays = [np.frombuffer(b, np.uint32, len(b) // 5) for _, b in rows]
    counts = [np.frombuffer(b, np.uint8, len(b) // 5, len(b) // 5 * 4) for _, b in rows]
    keys, which = np.unique(np.concatenate(arrays), return_inverse=True)
    total = rarity(np.bincount(which, np.concatenate(counts), minlength=len(keys)))
    ends = np.cumsum([len(a) for a in arrays])
    return slabs.answers_of(rows, table, 1, [total[which[e - len(a):e]].tobytes() for e, a in zip(ends, arrays, strict=True)])


PREFIXES = "doc_id long, n_shingles long, n_common long, digest binary, prefix_key binary, prefix array<struct<h: bigint, i: int>>, text string"


def prefixes(key, table: pa.Table, answers: pa.Table, n_shards: int, k: int, percent: int) -> pa.Table:
    """One row per document: set size, how many shingles other documents hold
    too, digest of the set, and its prefix (common shingles with their places
    among the common ones); texts only where the prefix has any."""
    if not table.num_rows:
        return pa.table({c: [] for c in ("doc_id", "n_shingles", "n_common", "digest", "prefix_key", "prefix", "text")})
    slab = SlabSets(table, k)
    _, _, which = slab.keys(n_shards)
    told = slabs.told(answers, 1)
    rare = np.frombuffer(b"".join(told), np.uint8)[which] if told else np.zeros(0, np.uint8)
    n = np.diff(slab.offs)
    doc = np.repeat(np.arange(len(n)), n)
    order = np.argsort(rare.astype(tk.U) << tk.U(56) | slab.h >> tk.U(8))
    order = order[np.argsort(doc[order].astype(np.uint16 if len(n) < 65536 else np.int64), kind="stable")]
    place = np.arange(len(doc)) - np.repeat(slab.offs[:-1], n)
    length = n - (percent * n + 99) // 100 + 1
    use = (place < np.repeat(length, n)) & (rare[order] > 1)
    common = np.bincount(doc, rare > 1, minlength=len(n)).astype(np.int64)
    owner = doc[use]
    h, place = slab.h[order][use], (place[use] - (n - common)[owner]).astype(np.int32)
    upto = np.searchsorted(owner, np.arange(len(n) + 1))
    digest, prefix_key = [], []
    for i in range(len(n)):
        digest.append(hashlib.blake2b(slab.h[slab.offs[i]:slab.offs[i + 1]].tobytes(), digest_size=16).digest())
        a, b = upto[i], upto[i + 1]
        prefix_key.append(hashlib.blake2b(h[a:b].tobytes() + place[a:b].tobytes() + int(n[i]).to_bytes(8, "little") + int(common[i]).to_bytes(8, "little"), digest_size=16).digest())
    items = pa.StructArray.from_arrays([pa.array(h.view(np.int64)), pa.array(place)], names=["h", "i"])
    has = np.diff(upto) > 0
    text = slab.table.column("text").combine_chunks().cast(pa.string())
    return pa.table({"doc_id": slab.table.column("doc_id"), "n_shingles": pa.array(n.astype(np.int64)), "n_common": pa.array(common),
                     "digest": pa.array(digest, pa.binary()), "prefix_key": pa.array(prefix_key, pa.binary()),
                     "prefix": pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), items),
                     "text": pa.compute.if_else(pa.array(has), text, pa.scalar(None, pa.string()))})


def verify(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose texts link. ``texts``: id, text.

    A text is compared with up to about ``SALT_MEMBERS`` others at a time; the
    task reads its rows in order and keeps one text of a's side.
    """
    share = pairs.groupBy("a").agg(F.ceil(F.count("*") / SALT_MEMBERS).alias("salts"))
    members = (pairs.join(share, "a").select("a", F.pmod(F.xxhash64("b"), "salts").alias("salt"), F.lit(1).alias("side"), F.col("b").alias("id")))
    centres = share.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"),
                           F.lit(0).alias("side"), F.col("a").alias("id"))
    rows = (members.unionByName(centres).join(texts, "id").repartition("a", "salt")
            .sortWithinPartitions("a", "salt", "side").select("a", "salt", "side", "id", "text"))

    def run(batches):
        held = None  # the last centre seen: (a, salt) and its row
        for batch in batches:
            for part in tk.slices(batch):
                tab = pa.Table.from_batches([part])
                if held is not None:
                    tab = pa.concat_tables([held, tab])
                yield from linked(tab, k, percent)
                last = np.flatnonzero(tab.column("side").to_numpy() == 0)
                held = tab.slice(last[-1], 1) if len(last) else held

    return rows.mapInArrow(run, "a long, b long")


def linked(tab: pa.Table, k: int, percent: int):
    side = tab.column("side").to_numpy()
    group = np.cumsum(side == 0) - 1
    h, offs = shingle_sets(*tk.text_bytes(tab.column("text")), k)
    n = np.diff(offs)
    row = np.repeat(np.arange(len(n)), n)
    key = tk.mix(h ^ group[row].astype(tk.U) * tk.M1)
    of_centre = side[row] == 0
    common = np.bincount(row[~of_centre][np.isin(key[~of_centre], key[of_centre])], minlength=len(n))
    size = n[np.flatnonzero(side == 0)][group]
    hit = (side == 1) & (100 * common >= percent * (n + size - common))
    yield pa.RecordBatch.from_arrays([tab.column("a").combine_chunks().filter(pa.array(hit)).cast(pa.int64()),
                                      tab.column("id").combine_chunks().filter(pa.array(hit)).cast(pa.int64())], names=["a", "b"])


TASK = ("root", "lo", "p", "hi", "q")


def link_counts(members: DataFrame, k: int, percent: int) -> DataFrame:
    """(id, n_links): the weights of the members of each one's component that
    link with it, added up. ``members``: id, root (its component), n (set size),
    weight, text; a landed table, one row per different set.

    A component of more than a block is cut into bands of size: sets that link
    are in one band or in neighbouring ones. A band is dealt into blocks by a
    hash of the id, and a task gets two blocks.
    """
    width = max(math.log(100 / percent) * 1.0001, 1e-9)
    members = members.withColumn("band", F.floor(F.log("n") / width))
    parts = land(members.groupBy("root", "band").agg(F.count("*").alias("c"), F.sum(F.octet_length("text")).alias("b")), "jaccard-bands")
    many = parts.groupBy("root").agg(F.sum("c").alias("c"), F.sum("b").alias("b")).where((F.col("c") > BLOCK_MEMBERS) | (F.col("b") > BLOCK_BYTES))
    blocks = parts.join(many.select("root"), "root", "left_semi").select(
        "root", "band", F.greatest(F.ceil(F.col("c") / BLOCK_MEMBERS), F.ceil(F.col("b") / BLOCK_BYTES)).alias("blocks"))
    above = blocks.select("root", (F.col("band") - 1).alias("band"), F.col("blocks").alias("above"))
    below = blocks.select("root", (F.col("band") + 1).alias("band"), F.col("blocks").alias("below"))
    blocks = blocks.join(above, ["root", "band"], "left").join(below, ["root", "band"], "left")
    blocks = land(blocks, "jaccard-blocks")

    dealt = members.join(small(blocks, 40), ["root", "band"], "left")
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("id"), F.coalesce("blocks", F.lit(1))))
    band, own, zero = F.col("band"), F.col("own"), F.lit(0).cast("long")

    def pairs_of(blocks, task):
        return F.when(blocks.isNull(), F.array().cast("array<struct<lo: bigint, p: bigint, hi: bigint, q: bigint, first: boolean>>")).otherwise(
            F.transform(F.sequence(zero, blocks - 1), lambda other: F.struct(*[c.alias(x) for c, x in zip(task(other), ("lo", "p", "hi", "q", "first"), strict=True)])))

    alone = F.array(F.struct(zero.alias("lo"), zero.alias("p"), zero.alias("hi"), zero.alias("q"), F.lit(True).alias("first")))
    tasks = F.when(F.col("blocks").isNull(), alone).otherwise(F.concat(
        pairs_of(F.col("blocks"), lambda o: (band, F.least(own, o), band, F.greatest(own, o), own <= o)),
        pairs_of(F.col("above"), lambda o: (band, own, band + 1, o, F.lit(True))),
        pairs_of(F.col("below"), lambda o: (band - 1, o, band, own, F.lit(False)))))
    rows = dealt.select("id", "root", "weight", "text", F.explode(tasks).alias("t")).select("root", "t.*", "id", "weight", "text")
    rows = rows.repartition(*TASK).sortWithinPartitions(*TASK)

    def run(batches):
        held = None
        for batch in batches:
            tab = pa.Table.from_batches([batch])
            tab = tab if held is None else pa.concat_tables([held, tab])
            cuts = task_cuts(tab)
            held = tab.slice(cuts[-2]) if tab.num_rows else tab  # the last task may go on
            yield from counted(tab, cuts[:-1], k, percent)
        if held is not None and held.num_rows:
            yield from counted(held, np.array([0, held.num_rows]), k, percent)

    return rows.mapInArrow(run, "id long, n_links long").groupBy("id").agg(F.sum("n_links").alias("n_links"))


def task_cuts(tab: pa.Table) -> np.ndarray:
    """Where the tasks of sorted rows begin, and the end."""
    change = np.zeros(max(tab.num_rows - 1, 0), bool)
    for c in TASK:
        x = tab.column(c).to_numpy()
        change |= x[1:] != x[:-1]
    return np.concatenate([[0], np.flatnonzero(change) + 1, [tab.num_rows]])


def counted(tab: pa.Table, cuts: np.ndarray, k: int, percent: int):
    """(id, n_links) of whole tasks, texts of about ``tk.SLICE_BYTES`` hashed at a time."""
    at = 0
    upto = np.concatenate([[0], np.cumsum(pa.compute.binary_length(tab.column("text")).to_numpy())])[cuts]
    while at < len(cuts) - 1:
        end = max(at + 1, int(np.searchsorted(upto, upto[at] + tk.SLICE_BYTES, "right")) - 1)
        part = tab.slice(cuts[at], cuts[end] - cuts[at]).combine_chunks()
        h, offs = shingle_sets(*tk.text_bytes(part.column("text")), k)
        first, weight = part.column("first").to_numpy(), part.column("weight").to_numpy()
        same = (part.column("lo").to_numpy() == part.column("hi").to_numpy()) & (part.column("p").to_numpy() == part.column("q").to_numpy())
        found = np.zeros(part.num_rows, np.int64)
        for a, b in zip(cuts[at:end] - cuts[at], cuts[at + 1:end + 1] - cuts[at], strict=True):
            found[a:b] = block_links(h[offs[a]:offs[b]], offs[a:b + 1] - offs[a], first[a:b], same[a], weight[a:b], percent)
        yield pa.RecordBatch.from_arrays([part.column("id").combine_chunks().cast(pa.int64()), pa.array(found)], names=["id", "n_links"])
        at = end
    tk.release()


def block_links(h: np.ndarray, offs: np.ndarray, first: np.ndarray, same: bool, weight: np.ndarray, percent: int) -> np.ndarray:
    """Per set the weight of those it links with: all others of one block, or those of the other block."""
    n = np.diff(offs)
    if len(n) < 2:
        return np.zeros(len(n), np.int64)
    row = np.repeat(np.arange(len(n)), n)
    order = np.argsort(h, kind="stable")
    h, row = h[order], row[order]
    key = np.concatenate([[0], np.cumsum(h[1:] != h[:-1])])
    shared = np.bincount(key)[key] > 1
    key, row = np.unique(key[shared], return_inverse=True)[1], row[shared]
    left = np.arange(len(n)) if same else np.flatnonzero(first)
    right = left if same else np.flatnonzero(~first)
    common = np.zeros((len(left), len(right)))
    n_keys = int(key[-1]) + 1 if len(key) else 0
    step = max(1, min(n_keys, CELLS // len(n)))
    for begin in range(0, n_keys, step):
        a, b = np.searchsorted(key, [begin, begin + step])
        has = np.zeros((step, len(n)))
        has[key[a:b] - begin, row[a:b]] = 1
        common += has[:, left].T @ has[:, right]
    hit = 100 * common >= percent * (n[left][:, None] + n[right][None, :] - common)
    if same:
        np.fill_diagonal(hit, False)
    out = np.zeros(len(n), np.int64)
    out[left] = hit @ weight[right]
    if not same:
        out[right] = hit.T @ weight[left]
    return out


def near_duplicates(docs: DataFrame, k: int = WORDS, percent: int = PERCENT, slab_bytes: int = slabs.SLAB_BYTES, count_links: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id): one row per input row.

    ``component_id`` is the smallest doc_id reachable by links. With
    ``count_links`` also ``n_links``: how many other rows link with the row,
    copies included. Null or empty texts have no shingles and no links; repeated
    rows and equal texts are one class, every other row being a link; rows of
    one doc_id are one document, so its different texts are in one component,
    but are a link only if they are near; a row without doc_id links like any
    other and takes its component's smallest doc_id (null if there is none);
    other columns are not read; an empty table gives an empty result.
    """
    base, n = slabs.deal(docs, slab_bytes, by_range=False)
    asked = base.groupBy("slab").applyInArrow(lambda t: ask_counts(t, n, k), slabs.ROWS)
    counts = asked.groupBy("shard").applyInArrow(answer_counts, slabs.ROWS)
    members = land(base.groupBy("slab").cogroup(counts.groupBy("slab"))
                   .applyInArrow(lambda key, t, a: prefixes(key, t, a, n, k, percent), PREFIXES), "jaccard-members")

    classes = members.where("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("least"), F.count("*").alias("n_rows"))
    classes = land(classes.withColumn("id", F.monotonically_increasing_id()), "jaccard-classes")
    reps = members.where("size(prefix) > 0").join(classes, "digest").where(F.col("doc_id").eqNullSafe(F.col("least")))
    reps = reps.select("id", F.col("n_shingles").alias("n"), F.col("n_common").alias("m"), "n_rows", "prefix_key", "prefix", "text")
    reps = land(reps.dropDuplicates(["id"]), "jaccard-classes")
    texts = reps.select("id", "text")

    groups = reps.groupBy("prefix_key").agg(F.min(F.struct("id", "n", "m", "prefix")).alias("g"))
    groups = land(groups.select("prefix_key", F.col("g.id").alias("g"), "g.n", "g.m", "g.prefix"), "jaccard-groups")
    inside = land(reps.select("id", "prefix_key").join(groups.select("prefix_key", "g"), "prefix_key").select("id", "g"), "jaccard-inside")
    grams = land(groups.select("g", "n", "m", F.explode("prefix").alias("p")).select("p.h", "p.i", "g", "n", "m"), "jaccard-grams")

    def may_link(n1, m1, i1, n2, m2, i2):
        """Sizes allow a link, and so does the most that two sets can share if
        this is their first shingle in common, at these places among their m
        common ones: nothing before it counts. Linked sets pass at their first."""
        sizes = 100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)
        most = F.least(m1 - i1, m2 - i2)
        return sizes & ((100 + percent) * most >= percent * (n1 + n2))

    c = F.col
    stars = grams.groupBy("h").agg(F.min(F.struct((F.col("n") - F.col("m")).alias("own"), "g", "n", "m", "i")).alias("c"), F.count("*").alias("holders")).where("holders > 1")
    star = grams.join(stars, "h").where((c("g") != c("c.g")) & may_link(c("n"), c("m"), c("i"), c("c.n"), c("c.m"), c("c.i")))
    star = star.select(c("c.g").alias("a"), c("g")).unionByName(inside.where("id <> g").select(c("g").alias("a"), "g")).distinct()
    first = land(star.join(inside, "g").where("a <> id").select("a", c("id").alias("b")).distinct(), "jaccard-pairs")
    links = land(verify(first, texts, k, percent), "jaccard-links")

    label = components(links)
    named = inside.join(label, "id", "left").select("id", "g", F.coalesce("root", "id").alias("label"))
    placed = grams.join(named, "g").select("h", "i", "n", "m", "id", "label")
    mixed = placed.groupBy("h").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("h")
    placed = land(placed.join(mixed, "h", "left_semi"), "jaccard-placed")
    # rows of a shingle that agree in component, sizes and place are one side: a
    # component however large is compared with others once per such side
    at = ("h", "label", "n", "m", "i")
    sides = placed.select(*at).distinct()
    others = sides.select("h", *[c(x).alias(f"o_{x}") for x in at[1:]])
    cross = sides.join(others, "h").where((c("label") < c("o_label")) & may_link(c("n"), c("m"), c("i"), c("o_n"), c("o_m"), c("o_i")))
    right = placed.select("h", *[c(x).alias(f"o_{x}") for x in at[1:]], c("id").alias("b"))
    rest = (cross.join(placed.withColumnRenamed("id", "a"), list(at)).join(right, ["h", *[f"o_{x}" for x in at[1:]]])
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
            .join(first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"))
    rest = land(rest, "jaccard-pairs")
    more = land(verify(rest, texts, k, percent), "jaccard-links")

    # an id with several sets is one document
    owned = members.where("n_shingles > 0 AND doc_id IS NOT NULL")
    several = land(owned.groupBy("doc_id").agg(F.min("digest").alias("one"), F.max("digest").alias("other")).where("one <> other").select("doc_id"), "jaccard-several")
    several = land(owned.join(small(several, 16), "doc_id").select("doc_id", "digest").distinct().join(classes.select("digest", "id"), "digest").select("doc_id", "id"), "jaccard-several")
    joined = several.join(several.groupBy("doc_id").agg(F.min("id").alias("a")), "doc_id").select("a", F.col("id").alias("b"))

    root = land(components(links.unionByName(more).unionByName(joined)), "jaccard-roots")
    root = root.unionByName(root.select(F.col("root").alias("id"), "root").distinct())
    least = root.join(classes.select("id", "least"), "id").groupBy("root").agg(F.min("least").alias("component"))
    told = classes.join(root.join(least, "root"), "id", "left").select("digest", "id", "n_rows", F.coalesce("component", "least").alias("component"))
    if count_links:
        near = land(root.join(reps.select("id", "n", F.col("n_rows").alias("weight"), "text"), "id"), "jaccard-near")
        told = told.join(link_counts(near, k, percent), "id", "left").withColumn("n_links", F.col("n_rows") - 1 + F.coalesce("n_links", F.lit(0)))
    told = land(told.drop("id", "n_rows"), "jaccard-roots")
    out = [F.coalesce("component", "doc_id").alias("component_id")] + ([F.coalesce("n_links", F.lit(0)).alias("n_links")] if count_links else [])
    return members.select("doc_id", "n_shingles", "digest").join(told, "digest", "left").select("doc_id", "n_shingles", *out)

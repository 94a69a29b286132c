"""N-gram Jaccard join with a count-vector R-tree.

A document's set holds the 64-bit hashes of its distinct 5-word shingles.  Two
documents link when the Jaccard similarity of their sets is at least 3/4.

1. *Points.*  Shingles are hashed into groups (a power of two of at least n
   groups, so that the bound is tight at any length); the counts per group are
   the document's point.  Folding a longer vector onto a shorter one keeps it
   valid.  For two points the sum of
   coordinate minima bounds the size of the intersection from above.
2. *Cells.*  High-dimensional points of unrelated texts lie all at one distance
   from each other, so no box over them prunes anything and a single tree would
   compare everything.  Points are therefore dealt to cells: one for each of
   the first floor(n/4) + 1 shingles of a set in a fixed order.  Two sets that
   link share at least one of them (prefix filter), so cells lose no link.  A set
   leaves a cell where the sizes and places of all others rule out that the
   cell's shingle is the first one that they share.
   Frequent shingles, found by lossy counting over all documents, come last in
   the order, the most frequent ones at its end, so a passage that many
   documents hold forms a cell only for documents that hold little else.  Which
   shingles count as frequent does not depend on the number of documents: a
   share of them would let cells grow with the table, and the pairs in them
   with its square.
3. *Stars.*  Every cell names its smallest set id its center.  Cells of one
   center form one group, so near copies that share forty cells are dealt to a
   few groups only.  Sets are first compared with their centers: pairs that
   pass the size and coordinate bounds are verified on their sets, and linked
   sets are joined into components.
4. *Trees.*  Groups whose sets are not yet all in one component are indexed by
   an R-tree on the points (boxes keep the largest count per group and the
   range of sizes), one tree for a block of at most about BLOCK sets.  First
   every set outside its block's commonest component is searched in its own
   block, and verified against its most promising partners only; the links
   found join most of what the stars left apart.  Then the sets that are
   still outside the largest component of their group are searched in all
   blocks, and every pair of different components whose bounds allow a link
   is verified.  No task holds a whole group.

Identical sets are one node throughout, so copies never meet in pairs, and
pairs inside a component are not compared again: the result is the components
of all links, not the links.

Defined results: null, empty and wordless texts have an empty set, link with
nothing and are their own component; fewer than five words are one shingle of
the whole sequence; rows that repeat an id are rows of their own that get equal
results where their texts are equal; null ids link like others but are never a
component's name unless all its ids are null; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.components import components
from tidepool.llm.scratch import saved
from tidepool.llm.textvec import SPACED, Words, grams, lean, mix, text_pieces

SHINGLE = 5
#: Fewest groups of a count vector.
GROUPS = 16
#: Shingles counted together by a task before those seen once are forgotten.
COUNTED = 2_000_000
#: A shingle counted more than HOT_LEAST times is frequent; the HOT_MOST most frequent (900 kB with their levels) are reordered.
HOT_LEAST, HOT_MOST = 2, 100_000
#: Largest cell whose sets are compared by size.
CELL = 64
#: Bits of the map of documents whose sets are read again: a fixed size, whatever the input.
MARK_BITS = 23
#: Children of a tree node; most rows of a block.
FANOUT, BLOCK = 32, 1_024

_U = np.uint64


def shingle_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text index, shingle) pairs, sorted by both."""
    w = Words(texts, SPACED)
    hashes, counts = w.hashes(), w.counts()
    g = grams(hashes, SHINGLE)
    inside = w.doc[SHINGLE - 1:] == w.doc[:len(g)] if len(g) else np.zeros(0, bool)
    docs, values = [w.doc[:len(g)][inside]], [g[inside]]
    first = np.cumsum(counts) - counts
    for n in range(1, SHINGLE):
        short = np.flatnonzero(counts == n)
        if len(short):
            docs.append(short)
            values.append(grams(hashes, n)[first[short]] + _U(n))
    doc, h = np.concatenate(docs), np.concatenate(values)
    if len(docs) > 1:
        order = np.argsort(doc, kind="stable")
        doc, h = doc[order], h[order]
    ends = np.cumsum(np.bincount(doc, minlength=len(texts))).tolist()
    for a, b in zip([0, *ends], ends):
        h[a:b].sort()
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    return doc[new], h[new]


def _set_ids(doc: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Order-free 64-bit identity of each text's set."""
    total = np.zeros(len(n), _U)
    if len(h):
        starts = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
        total[doc[starts]] = np.add.reduceat(mix(h ^ _U(0x5851F42D4C957F2D)), starts)
    return mix(total + n.astype(_U)).view(np.int64)


def _width(n: int) -> int:
    """Groups of a set of n shingles: a power of two of at least n."""
    return max(GROUPS, 1 << (max(int(n), 1) - 1).bit_length())


def _points(doc: np.ndarray, h: np.ndarray, n: np.ndarray) -> list[bytes]:
    """Count vectors: half a byte a group, or one or two bytes where a count needs them."""
    width = np.array([_width(x) for x in n], np.int64)
    offset = np.cumsum(width) - width
    at = offset[doc] + (h & (width[doc] - 1).astype(_U)).astype(np.int64)
    flat = np.bincount(at, minlength=int(width.sum()))
    out = []
    for o, w in zip(offset.tolist(), width.tolist(), strict=True):
        x = flat[o:o + w]
        most = x.max()
        if most < 16:
            x = x.astype(np.uint8)
            out.append((x[0::2] | x[1::2] << 4).tobytes())
        else:
            out.append(x.astype(np.uint8 if most < 256 else "<u2").tobytes())
    return out


def vector(point: bytes, n: int) -> np.ndarray:
    """The counts of ``_points``."""
    if 2 * len(point) > _width(n):
        return np.frombuffer(point, np.uint8 if len(point) == _width(n) else "<u2")
    x = np.frombuffer(point, np.uint8)
    return np.stack([x & 15, x >> 4], axis=1).ravel()


def coded(point: bytes) -> bytes:
    """A point as it is kept and shuffled: small counts are common, so the bytes alone are coded, not their repeats."""
    c = zlib.compressobj(1, zlib.DEFLATED, -9, 5, zlib.Z_HUFFMAN_ONLY)
    return c.compress(point) + c.flush()


def decoded(point: bytes) -> bytes:
    return zlib.decompress(point, -15)


def _survey(docs: DataFrame) -> DataFrame:
    """One pass over the texts.  Rows with set_id: (doc_id, n, set_id, point) of
    a document.  Rows with h: (h, c), a shingle that c documents of one task's
    stretch hold, c > 1 (lossy counting)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0

        def counted() -> pa.RecordBatch:
            every = np.concatenate(held)
            held.clear()
            every.sort()
            u, c = np.unique(every[1:][every[1:] == every[:-1]], return_counts=True)  # each one but for its first
            c += 1
            none = pa.nulls(len(u), pa.int64())
            return pa.RecordBatch.from_arrays(
                [none, none, none, pa.nulls(len(u), pa.binary()), pa.array(u.view(np.int64)), pa.array(c)], names=names)

        names = ["doc_id", "n", "set_id", "point", "h", "c"]
        for b in batches:
            ids = b.column(0)
            for first, texts in text_pieces(b.column(1)):
                doc, h = shingle_sets(texts)
                n = np.bincount(doc, minlength=len(texts))
                none = pa.nulls(len(texts), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, len(texts)), pa.array(n), pa.array(_set_ids(doc, h, n)),
                     pa.array([coded(p) for p in _points(doc, h, n)], pa.binary()), none, none], names=names)
                held.append(h)
                total += len(h)
                if total >= COUNTED:
                    yield counted()
                    total = 0
        if total:
            yield counted()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        lean(run), "doc_id bigint, n bigint, set_id bigint, point binary, h bigint, c bigint")


def _frequent(survey: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles, sorted, and the level (1 to 255) of each one's count: of
    those counted more than HOT_LEAST times the HOT_MOST most frequent.  Only
    these and the ties of the last one are brought together."""
    counted = saved(survey.where("h is not null").groupBy("h").agg(F.sum("c").alias("c")).where(F.col("c") > HOT_LEAST)
                    .withColumn("level", F.least(F.lit(255), F.floor(8 * F.log2("c"))).cast("int")))
    least = total = 0
    for r in sorted(counted.groupBy("level").agg(F.count(F.lit(1)).alias("k")).collect(), reverse=True):
        least, total = r["level"], total + r["k"]
        if total >= HOT_MOST:
            break
    rows = counted.where(F.col("level") >= least).orderBy(F.desc("c"), "h").limit(HOT_MOST).select("h", "level").toPandas()
    hot = rows["h"].to_numpy(np.int64).view(_U)
    order = np.argsort(hot)
    return hot[order], rows["level"].to_numpy(np.uint8)[order]


def _prefixes(docs: DataFrame, hot: np.ndarray, level: np.ndarray) -> DataFrame:
    """(h, set_id, sizes): the first floor(n/4) + 1 shingles of each set, frequent
    ones last, by their level, and ``_sizes`` there.  A task deals each set once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            for _, texts in text_pieces(b.column(0)):
                doc, h = shingle_sets(texts)
                n = np.bincount(doc, minlength=len(texts))
                ids = _set_ids(doc, h, n)
                if len(hot):
                    at = np.minimum(np.searchsorted(hot, h), len(hot) - 1)
                    late = np.where(hot[at] == h, level[at], 0)
                    h = h[np.argsort(doc << 8 | late, kind="stable")]  # within a level the shingles stay sorted
                place = np.arange(len(doc)) - (np.cumsum(n) - n)[doc]
                if len(seen) > 1_000_000:
                    seen.clear()
                fresh = np.zeros(len(texts), bool)
                for i, s in enumerate(ids.tolist()):
                    if s not in seen:
                        seen.add(s)
                        fresh[i] = True
                take = (place <= n[doc] // 4) & fresh[doc]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[take].view(np.int64)), pa.array(ids[doc[take]]), pa.array(_sizes(n[doc[take]], place[take]))],
                    names=["h", "set_id", "sizes"])

    return docs.select("text").mapInArrow(lean(run), "h bigint, set_id bigint, sizes bigint")


def _sizes(n: np.ndarray, place: np.ndarray) -> np.ndarray:
    """A set's size (upper half) and that of the largest set (lower half) it can
    link with if their first common shingle has this place (from 0) in its order:
    n - place shingles are left to share, and 3/7 of both sizes must be shared."""
    return n << 32 | (4 * n - 7 * place) // 3


def _mates(h: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Of rows sorted by h: those with another one of the same h whose ``_sizes``
    allow a link both ways, and all rows of cells of more than CELL."""
    n, most = sizes >> 32, sizes & 0xFFFFFFFF
    found = np.zeros(len(h), bool)
    i = np.arange(len(h))
    for d in range(1, CELL):
        i = i[:np.searchsorted(i, len(h) - d)]
        i = i[h[i] == h[i + d]]
        if not len(i):
            return found
        both = i[(n[i] <= most[i + d]) & (n[i + d] <= most[i])]
        found[both] = found[both + d] = True
    i = i[:np.searchsorted(i, len(h) - CELL)]
    return found | np.isin(h, h[i[h[i] == h[i + CELL]]])


def _cell_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (h, set_id, sizes) sorted by (h, set_id): members (center, set_id)
    of the cells with two different sets at least; the center is the smallest set
    id.  Sets without a mate there are left out of the cells inside a batch; only
    one row is held over between batches, however large a cell is."""
    last_h = last_s = center = None
    single = False  # the held cell has one member so far, not yet given out
    for b in batches:
        h, s, sizes = (b.column(i).to_numpy() for i in range(3))
        if not len(h):
            continue
        keep = np.ones(len(h), bool)
        keep[1:] = (h[1:] != h[:-1]) | (s[1:] != s[:-1])
        keep[0] = last_h is None or h[0] != last_h or s[0] != last_s
        last = h[-1], s[-1]
        h, s, sizes = h[keep], s[keep], sizes[keep]
        if not len(h):
            continue
        ends = h == last[0]  # this cell may go on, and the first one may have begun before
        if last_h is not None:
            ends |= h == last_h
        kept = ends | _mates(h, sizes)
        h, s = h[kept], s[kept]
        i = np.arange(len(h))
        begins = np.ones(len(h), bool)
        begins[1:] = h[1:] != h[:-1]
        begins[0] = last_h is None or h[0] != last_h
        start = np.maximum.accumulate(np.where(begins, i, -1))
        mid = np.where(start >= 0, s[start.clip(0)], center if center is not None else 0)
        member = ~begins
        member[:-1] |= begins[:-1] & ~begins[1:]
        out = [mid[member], s[member]]
        if single and not begins[0]:
            out = [np.concatenate(([x], y)) for x, y in zip((center, center), out, strict=True)]
        if len(out[0]):
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in out], names=["center", "set_id"])
        single = bool(begins[-1]) or (single and not begins.any() and not len(out[0]))
        last_h, last_s, center = last[0], last[1], mid[-1]


def _folded(v: np.ndarray, width: int) -> np.ndarray:
    """Count vectors (rows) folded onto ``width`` groups."""
    if v.shape[-1] == width:
        return v
    return v.reshape(*v.shape[:-1], -1, width).sum(axis=-2, dtype=np.int32)


def may_link(na: int, a: np.ndarray, nb: int, b: np.ndarray) -> bool:
    """Whether sizes and count vectors allow a Jaccard similarity of 3/4."""
    if 4 * min(na, nb) < 3 * max(na, nb):
        return False
    w = min(len(a), len(b))
    shared = int(np.minimum(_folded(a, w), _folded(b, w)).sum(dtype=np.int64))
    return 100 * shared >= 75 * (na + nb - shared)


def _near_centers(members: DataFrame, points: DataFrame) -> DataFrame:
    """Pairs (a, b) of a center and a member of its group that sizes and points
    allow to link.  A group streams past its center's point; a group of more
    than BLOCK members is dealt in blocks, each with a copy of the center."""
    sizes = points.select("set_id", "n")
    sized = (members.where("set_id != center").join(sizes, "set_id")
             .join(sizes.select(F.col("set_id").alias("center"), F.col("n").alias("cn")), "center")
             .where("4 * least(n, cn) >= 3 * greatest(n, cn)").select("center", "set_id"))
    blocks = sized.groupBy("center").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("blocks"))
    rows = (sized.join(blocks, "center")
            .select("center", F.expr("cast(pmod(xxhash64(set_id), blocks) as int)").alias("block"), F.lit(1).alias("member"), "set_id")
            .unionByName(blocks.select("center", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"),
                                       F.lit(0).alias("member"), F.col("center").alias("set_id"))))
    dealt = (rows.join(points, "set_id").select("center", "block", "member", "set_id", "n", "point")
             .repartition("center", "block").sortWithinPartitions("center", "block", "member"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        center = size = point = None
        for x in batches:
            out: list[tuple[int, int]] = []
            for c, _, member, s, n, p in zip(*[x.column(k).to_pylist() for k in range(6)], strict=True):
                if not member:
                    center, size, point = c, n, vector(decoded(p), n)
                elif may_link(size, point, n, vector(decoded(p), n)):
                    out.append((min(s, center), max(s, center)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return dealt.mapInArrow(lean(run), "a bigint, b bigint")


class RTree:
    """Packed R-tree over count vectors: a box keeps the largest count per
    group, folded to its narrowest member, and the range of set sizes.  A node
    holds its children's boxes as one matrix, so a visit is a few array steps."""

    def __init__(self, n: np.ndarray, vectors: list[np.ndarray]):
        # sort-tile: by width, so that boxes fold little, then by the first count, then by size
        order = np.lexsort((n, [int(v[0]) for v in vectors], [len(v) for v in vectors]))
        boxes = [(int(n[i]), int(n[i]), vectors[i], int(i)) for i in order]
        leaf = True
        while leaf or len(boxes) > 1:
            boxes = [self._node(boxes[k:k + FANOUT], leaf) for k in range(0, len(boxes), FANOUT)]
            leaf = False
        self.root = boxes[0][3]

    @staticmethod
    def _node(boxes: list[tuple], leaf: bool) -> tuple:
        """Box around ``boxes`` and the node below it: (least sizes, most sizes, matrix, children, leaf)."""
        w = min(len(x[2]) for x in boxes)
        low, most = np.array([x[0] for x in boxes]), np.array([x[1] for x in boxes])
        high = np.stack([_folded(x[2], w) for x in boxes])
        return int(low.min()), int(most.max()), high.max(axis=0), (low, most, high, [x[3] for x in boxes], leaf)

    def search(self, n: int, v: np.ndarray) -> Iterator[tuple[int, int]]:
        """Points whose bounds allow a link with (n, v), and the bound on the shared shingles."""
        stack = [self.root]
        least = -(-3 * n // 4)
        while stack:
            low, most, high, children, leaf = stack.pop()
            w = min(len(v), high.shape[1])
            shared = np.minimum(_folded(high, w), _folded(v, w)).sum(axis=1, dtype=np.int64)
            # the smallest union a member can make is n + its least size - shared
            ok = (4 * most >= 3 * n) & (3 * low <= 4 * n) & (175 * shared >= 75 * (n + np.maximum(low, least)))
            hit = np.flatnonzero(ok)
            if leaf:
                yield from [(children[k], int(shared[k])) for k in hit]
            else:
                stack += [children[k] for k in hit]


_Row = tuple[int, int, int, int, np.ndarray]  # own block, set id, component, size, point


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list[_Row]]]:
    """(i, j, rows) of each tree, from rows (center, i, j, own, set_id, comp, n,
    point) sorted by (center, i, j).  A tree has about 2 * BLOCK rows at most,
    and is all that is held."""
    held, rows = None, []
    for x in batches:
        c, i, j, own, s, comp, n, p = (x.column(k).to_pylist() for k in range(8))
        for k in range(x.num_rows):
            key = c[k], i[k], j[k]
            if key != held:
                if rows:
                    yield *held[1:], rows
                held, rows = key, []
            rows.append((own[k], s[k], comp[k], n[k], vector(decoded(p[k]), n[k])))
    if rows:
        yield *held[1:], rows


def _candidates(indexed: list[_Row], asking: list[_Row]) -> Iterator[tuple[_Row, list[tuple[float, _Row]]]]:
    """For each row that asks, the rows of other components that sizes and points allow it to link, with the bound on the similarity."""
    tree = RTree(np.array([r[3] for r in indexed], np.int64), [r[4] for r in indexed])
    for r in asking:
        # a leaf may fold wide points onto a narrow one: compare at full width
        yield r, [(shared / (r[3] + other[3] - shared), other) for k, shared in tree.search(r[3], r[4])
                  if (other := indexed[k])[2] != r[2] and may_link(r[3], r[4], other[3], other[4])]


def _pair_batch(pairs: set[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _nearest_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b): every set outside its tree's commonest component with the
    most promising set of that component and of all others."""
    for _, _, rows in _trees(batches):
        main = Counter(r[2] for r in rows).most_common(1)[0][0]
        found = set()
        for r, others in _candidates(rows, [r for r in rows if r[2] != main]):
            for side in ([x for x in others if x[1][2] == main], [x for x in others if x[1][2] != main]):
                if side:
                    best = max(side, key=lambda x: (x[0], -x[1][1]))[1]
                    found.add((min(r[1], best[1]), max(r[1], best[1])))
        if found:
            yield _pair_batch(found)


def _tree_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All pairs (a, b) of different components that the bounds allow, between
    block i of a group and its block j."""
    for i, j, rows in _trees(batches):
        indexed, asking = ([r for r in rows if r[0] == k] for k in (i, j))
        if not indexed or not asking:
            continue
        found: set[tuple[int, int]] = set()
        for r, others in _candidates(indexed, asking):
            found.update((min(r[1], o[1]), max(r[1], o[1])) for _, o in others)
            if len(found) > 100_000:
                yield _pair_batch(found)
                found = set()
        if found:
            yield _pair_batch(found)


def _open_groups(members: DataFrame, component: DataFrame, points: DataFrame, whole: bool) -> DataFrame:
    """Rows of the trees of the groups that hold more than one component.

    Not ``whole``: each block of a group is one tree, so a group is read once.
    ``whole``: the sets outside the group's largest component are dealt in
    blocks, and each of these meets itself, the others and the blocks of the
    largest component, whose own blocks never meet.  A group of near copies
    of which few are left apart is so read once per block of these few."""
    labelled = saved(members.join(component.withColumnRenamed("node", "set_id"), "set_id", "left")
                     .select("center", "set_id", F.coalesce("component", "set_id").alias("comp")))
    mixed = (labelled.groupBy("center", "comp").agg(F.count(F.lit(1)).alias("k"))
             .groupBy("center").agg(F.sum("k").alias("size"), F.count(F.lit(1)).alias("comps"), F.max(F.struct("k", "comp")).alias("top"))
             .where("comps > 1")
             .select("center", F.col("top.comp").alias("main"),
                     *[F.ceil(n / F.lit(BLOCK)).cast("int").alias(b) for b, n in
                       (("blocks", F.col("size")), ("of_main", F.col("top.k")), ("of_rest", F.col("size") - F.col("top.k")))]))
    rows = labelled.join(mixed, "center")
    if whole:  # blocks of the largest component come first, those of the rest after them ask
        last = "of_main + of_rest - 1"
        dealt = (rows.withColumn("own", F.expr("cast(if(comp = main, pmod(xxhash64(set_id), of_main), of_main + pmod(xxhash64(set_id), of_rest)) as int)"))
                 .select("center", "set_id", "comp", "own",
                         F.explode(F.expr(f"if(comp = main, sequence(of_main, {last}), sequence(0, {last}))")).alias("other"))
                 .select("center", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "set_id", "comp"))
    else:
        own = F.expr("cast(pmod(xxhash64(set_id), blocks) as int)")
        dealt = rows.select("center", own.alias("i"), own.alias("j"), own.alias("own"), "set_id", "comp")
    return (dealt.join(points, "set_id").select("center", "i", "j", "own", "set_id", "comp", "n", "point")
            .repartition("center", "i", "j").sortWithinPartitions("center", "i", "j"))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("set_id")).unionByName(pairs.select(F.col("b").alias("set_id"))).distinct()


def _marks(ids: DataFrame) -> np.ndarray:
    """A bit per hashed id, 2**MARK_BITS bits at any input (1 MB): which documents may be among ``ids``."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << MARK_BITS))
    words = (ids.select(place.alias("p"))
             .groupBy(F.expr("cast(p div 32 as int)").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 32 as int))")).alias("m"))
             .toPandas())
    marks = np.zeros((1 << MARK_BITS) // 32, np.uint32)
    marks[words["w"].to_numpy(np.int64)] = words["m"].to_numpy(np.int64).astype(np.uint32)
    return marks


def _tree_links(component: DataFrame) -> DataFrame:
    """Links (a, b) that hold ``component`` together."""
    return component.where("node != component").select(F.col("node").alias("a"), F.col("component").alias("b"))


def _sets(nodes: DataFrame, docs: DataFrame, holders: DataFrame) -> DataFrame:
    """(set_id, items) of ``nodes``, read again from one document per set:
    ``holders`` (set_id, doc_id).  Texts that the marks rule out are skipped
    where they are read, so no text is shuffled; the join drops what the marks
    let through in vain."""
    marks = _marks(holders.join(nodes, "set_id").select("doc_id"))
    keyed = docs.select(F.pmod(F.xxhash64(F.col("doc_id").cast("long").alias("doc_id")), F.lit(1 << MARK_BITS)).alias("p"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = b.column(0).to_numpy()
            b = b.filter(pa.array((marks[p // 32] >> (p % 32).astype(np.uint32) & 1).astype(bool)))
            for _, part in text_pieces(b.column(1)):
                doc, h = shingle_sets(part)
                n = np.bincount(doc, minlength=len(part))
                values = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))), pa.int32()),
                                                  pa.array(h.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(_set_ids(doc, h, n)), values], names=["set_id", "items"])

    sets = keyed.mapInArrow(lean(run), "set_id bigint, items array<bigint>").join(nodes, "set_id", "left_semi")
    return saved(sets.dropDuplicates(["set_id"]))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of set ids whose sets link."""
    both = (pairs.join(sets.select(F.col("set_id").alias("a"), F.col("items").alias("x")), "a")
            .join(sets.select(F.col("set_id").alias("b"), F.col("items").alias("y")), "b")
            .withColumn("both", F.size(F.array_intersect("x", "y"))))
    return both.where("100 * both >= 75 * (size(x) + size(y) - both)").select("a", "b")


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``."""
    survey = saved(_survey(docs))
    rows = survey.where("set_id is not null")
    members = saved(_prefixes(docs, *_frequent(survey)).repartition("h").sortWithinPartitions("h", "set_id")
                    .mapInArrow(lean(_cell_members), "center bigint, set_id bigint").distinct())
    holders = rows.where("n > 0").groupBy("set_id").agg(F.min("doc_id").alias("doc_id"))
    alive = members.select("set_id").distinct()
    points = saved(rows.join(alive, "set_id", "left_semi").select("set_id", "n", "point").dropDuplicates(["set_id"]))

    stars = saved(_near_centers(members, points))
    sets = _sets(_ends(stars), docs, holders)
    links = saved(_verified(stars, sets))
    first = components(links)

    near = saved(_open_groups(members, first, points, whole=False).mapInArrow(lean(_nearest_pairs), "a bigint, b bigint")
                 .distinct().join(stars, ["a", "b"], "left_anti"))
    # most of their sets were read for the stars
    sets = sets.unionByName(_sets(_ends(near).join(sets, "set_id", "left_anti"), docs, holders))
    second = components(_tree_links(first).unionByName(saved(_verified(near, sets))))

    found = (_open_groups(members, second, points, whole=True).mapInArrow(lean(_tree_pairs), "a bigint, b bigint").distinct())
    found = saved(found.join(stars.unionByName(near), ["a", "b"], "left_anti"))
    sets = sets.unionByName(_sets(_ends(found).join(sets, "set_id", "left_anti"), docs, holders))
    every = components(_tree_links(second).unionByName(saved(_verified(found, sets))))

    joined = (rows.select("doc_id", "n", "set_id").join(every.withColumnRenamed("node", "set_id"), "set_id", "left")
              .select("doc_id", "n", F.coalesce("component", "set_id").alias("comp")))
    names = joined.where("n > 0").groupBy("comp").agg(F.min("doc_id").alias("name"))
    return (joined.join(names, "comp", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("name")).alias("component_id")))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id names their component: one document of each group."""
    stay = (classes(docs).where(F.col("component_id").eqNullSafe(F.col("doc_id")))
            .select(F.col("doc_id").alias("__jj_keep")).distinct())
    return docs.join(stay, F.col("doc_id").eqNullSafe(F.col("__jj_keep")), "left_semi")

"""Near-duplicate documents by a chosen-path set similarity join.

A document is its set of word shingles; a sketch of 128 least hashes stands
for it until the end. In each of several independent trees, documents branch
by chosen least hashes: those with the same value go to the same child, so a
similar pair mostly stays together and others part. Nodes that are too large
branch again, by two more places. Small nodes are compared exhaustively, on
sketches. A node that stays together because its documents are alike is not
split further but taken as a whole.

All this only names candidates: groups that may hold a link, kept as
spanning links, never as all pairs. The documents of a group are then compared
on their full sets, in bounded tasks, and only confirmed links count.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import blocks as b
from ledgerloom.llm import words as w
from ledgerloom.llm.components import components

SKETCH = 128      # least hashes in a sketch
TREES = 12        # a pair of similarity 0.8 shares no first child in all of them once in 2e8
BRANCHES = 2      # places by which a large node branches
SMALL = 1000      # documents in a node that are compared exhaustively
DEPTH = 24        # a node that is still large then is taken as a whole
ALIKE = 0.5       # mean similarity from which a large node is taken as a whole
SLACK = 0.15      # candidates: estimated similarity of the wanted one less this, over four deviations of the estimate
TOGETHER = 512    # documents in a block of full comparisons
EMPTY, PLACES = 0, 23

_rng = np.random.default_rng(5)
_FLIPS = _rng.integers(0, 1 << 32, (SKETCH, 1), dtype=np.uint64).astype(np.uint32)
_FACTORS = (_rng.integers(0, 1 << 31, (SKETCH, 1), dtype=np.uint64).astype(np.uint32) << np.uint32(1)) | np.uint32(1)


def shingle_sets(texts, size: int) -> list[np.ndarray]:
    """For each text the sorted hashes of its distinct shingles; with fewer words than a shingle, of the whole sequence."""
    found = w.find(*w.buffer(texts), w.UNBLANK, w.FOLDED)
    full = w.windows(found.hash, size)
    out = []
    for a, z in zip(found.first[:-1].tolist(), found.first[1:].tolist()):
        if z - a >= size:
            out.append(np.unique(full[a:z - size + 1]))
        elif z > a:
            h = found.hash[a:a + 1] + np.uint64(z - a)
            for k in range(a + 1, z):
                h = w.pair(h, found.hash[k:k + 1])
            out.append(w.mix(h.copy()))
        else:
            out.append(found.hash[:0])
    return out


def sketch(members: np.ndarray) -> np.ndarray:
    least = np.full(SKETCH, 0xFFFFFFFF, np.uint32)
    for a in range(0, len(members), 4096):
        folded = (members[a:a + 4096] >> np.uint64(16)).astype(np.uint32)
        least = np.minimum(least, ((folded ^ _FLIPS) * _FACTORS).min(axis=1))
    return least


def _digest(members: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums over the set."""
    one, two = w.mix(members ^ np.uint64(0x1234567)), w.mix(members + np.uint64(0x89ABCDEF))
    return int(one.sum(dtype=np.uint64).view(np.int64)), int(two.sum(dtype=np.uint64).view(np.int64))


DOCUMENT = "node long, doc_id long, n_shingles long, one long, two long, sketch binary, brief binary"


def _documents(packed: DataFrame, size: int) -> DataFrame:
    def each(batches):
        for batch in batches:
            for block, payload in zip(batch.column("block").to_pylist(), batch.column("payload")):
                rows = b.of_payload(payload)
                assert rows.num_rows <= 1 << PLACES
                for i, j in b.pieces(rows):
                    part = rows.slice(i, j - i)
                    sets = shingle_sets(part.column("text"), size)
                    digests, sketches = [_digest(s) for s in sets], [sketch(s) if len(s) else None for s in sets]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block << PLACES | k for k in range(i, j)]), part.column("id").cast(pa.int64()).combine_chunks(),
                         pa.array([len(s) for s in sets]), pa.array([d[0] for d in digests]), pa.array([d[1] for d in digests]),
                         pa.array([None if s is None else s.tobytes() for s in sketches], pa.binary()),
                         pa.array([None if s is None else s.astype(np.uint8).tobytes() for s in sketches], pa.binary())],
                        names=["node", "doc_id", "n_shingles", "one", "two", "sketch", "brief"])
    return packed.select("block", "payload").mapInArrow(each, DOCUMENT)


def _matrix(column: pa.ChunkedArray, kind=np.uint32) -> np.ndarray:
    return np.concatenate([w.buffer(c)[0] for c in column.chunks] or [np.zeros(0, np.uint8)]).view(kind).reshape(-1, SKETCH)


def _branch(nodes: DataFrame, level: int) -> DataFrame:
    """``parent, path, node``: the children of nodes (``path, node, sketch``), or of the roots, one for each tree (``node, sketch``)."""
    def roots(batches):
        for batch in batches:
            values = _matrix(pa.chunked_array([batch.column("sketch")]))[:, :TREES].astype(np.uint64)
            tree = np.arange(TREES, dtype=np.uint64)
            path = w.pair(values, np.broadcast_to(tree, values.shape)).view(np.int64)
            node = batch.column("node").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(np.tile(np.arange(TREES), len(node))), pa.array(path.ravel()), pa.array(np.repeat(node, TREES))],
                                             names=["parent", "path", "node"])

    def children(batches):
        for batch in batches:
            values, parent = _matrix(pa.chunked_array([batch.column("sketch")])), batch.column("path").to_numpy()
            node, pick = batch.column("node").to_numpy(), parent.view(np.uint64)
            used = np.zeros((len(node), 0), np.int64)
            paths = []
            for k in range(BRANCHES):
                place = (w.mix(pick + np.uint64(level * 16 + k)) % np.uint64(SKETCH)).astype(np.int64)
                while (again := (used == place[:, None]).any(axis=1)).any():  # two different places
                    place[again] = (place[again] + 1) % SKETCH
                used = np.concatenate([used, place[:, None]], axis=1)
                value = values[np.arange(len(node)), place].astype(np.uint64)
                paths.append(w.pair(w.pair(pick.copy(), value), np.full(len(node), level * 16 + k, np.uint64)).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.tile(parent, BRANCHES)), pa.array(np.concatenate(paths)), pa.array(np.tile(node, BRANCHES))],
                                             names=["parent", "path", "node"])
    schema = "parent long, path long, node long"
    if level == 0:
        return nodes.select("node", "sketch").mapInArrow(roots, schema)
    return nodes.select("path", "node", "sketch").mapInArrow(children, schema)


def _close(scratch: b.Scratch, reps: DataFrame, wanted: float) -> DataFrame:
    """Spanning links of all groups that may hold a pair of the wanted similarity.

    Only documents in large nodes go on to the next level, and only their sketches. Sketches cut to a byte a place are
    compared in small nodes; they agree by chance in one place of 256, so they miss nothing that whole ones would find.
    """
    brief, sketches = reps.select("node", "brief"), reps.select("node", "sketch")
    children, links, level = scratch.save(_branch(sketches, 0), "children0"), [], 0
    while True:
        sizes = scratch.save(children.groupBy("path").agg(F.count("*").alias("n"), F.min("node").alias("head")).filter("n > 1"), f"sizes{level}")
        small = children.join(sizes.filter(F.col("n") <= SMALL).select("path"), "path", "left_semi").select("path", "node")
        links.append(scratch.save(_compare_small(small.join(brief, "node"), wanted), f"links{level}"))
        large = scratch.save(children.join(sizes.filter(F.col("n") > SMALL), "path").select("path", "node", "n", "head"), f"large{level}")
        scratch.drop(f"children{level}", f"sizes{level}")
        if large.isEmpty():
            break
        if level == DEPTH:
            links.append(large.select(F.col("head").alias("a"), F.col("node").alias("b")))
            break
        sketches = scratch.save(sketches.join(large.select("node"), "node", "left_semi"), f"sketches{level}")
        again = scratch.save(_branch(large.join(sketches, "node"), level + 1), f"again{level}")
        # Mean similarity of a large node: how often two of its documents meet again in a child.
        met = (again.groupBy("parent", "path").agg(F.count("*").alias("m")).groupBy("parent").agg(F.sum(F.col("m") * F.col("m")).alias("met")))
        dense = (large.groupBy("path").agg(F.first("n").alias("n")).join(met, F.col("path") == F.col("parent"))
                 .filter(F.col("met") >= ALIKE * BRANCHES * F.col("n") * F.col("n")).select("path"))
        dense = scratch.save(dense, f"dense{level}")
        links.append(large.join(dense, "path", "left_semi").select(F.col("head").alias("a"), F.col("node").alias("b")))
        level += 1
        children = scratch.save(again.join(dense.withColumnRenamed("path", "parent"), "parent", "left_anti"), f"children{level}")
        scratch.drop(f"again{level - 1}")
    out = links[0]
    for more in links[1:]:
        out = out.unionByName(more)
    return out.filter("a <> b")


def _spanning(nodes: np.ndarray, linked: np.ndarray) -> list[tuple[int, int]]:
    """Links from the first member of each component of a boolean matrix to the others."""
    label, seen, out = np.arange(len(nodes)), np.zeros(len(nodes), bool), []
    for i in range(len(nodes)):
        if seen[i]:
            continue
        front = reach = linked[i].copy()
        reach[i] = True
        front = reach & ~seen
        while True:
            grown = reach | linked[front].any(axis=0) if front.any() else reach
            front = grown & ~reach
            if not front.any():
                break
            reach = grown
        seen |= reach
        label[reach] = i
        out += [(nodes[i], nodes[j]) for j in np.flatnonzero(reach) if j != i]
    return out


def _compare_small(members: DataFrame, wanted: float) -> DataFrame:
    least = int(np.ceil((wanted - SLACK) * SKETCH))

    def each(table):
        path, node = table.column("path").to_numpy(), table.column("node").to_numpy()
        values = _matrix(table.column("brief"), np.uint8)
        order = np.argsort(path, kind="stable")
        cuts = np.append(np.flatnonzero(np.append(True, path[order][1:] != path[order][:-1])), len(order))
        links = []
        for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            pick = order[a:z]
            some = values[pick]
            if z - a == 2:
                if (some[0] == some[1]).sum() >= least:
                    links.append((node[pick[0]], node[pick[1]]))
            elif z - a > 2:
                alike = np.stack([(some == some[k]).sum(axis=1) >= least for k in range(z - a)])
                links += _spanning(node[pick], alike)
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 2
    return members.withColumn("part", F.pmod(F.xxhash64("path"), F.lit(parts))).groupBy("part").applyInArrow(lambda t: each(t), "a long, b long")


def confirmed(sets: list[np.ndarray], sides: np.ndarray | None, percent: int) -> np.ndarray:
    """Which pairs have 100 times their intersection at least ``percent`` times their union (with ``sides``: pairs across only)."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    every = np.concatenate(sets)
    shared, number, counts = np.unique(every, return_inverse=True, return_counts=True)
    rank = np.cumsum(counts > 1) - 1
    bits = np.zeros((n, -(-max(1, int((counts > 1).sum())) // 64) * 64), bool)
    owner, of = np.repeat(np.arange(n), sizes), counts[number] > 1
    bits[owner[of], rank[number[of]]] = True
    packed = np.packbits(bits, axis=1).view(np.uint64)
    linked = np.zeros((n, n), bool)
    for i in range(n):
        both = np.bitwise_count(packed[i] & packed).sum(axis=1, dtype=np.int64)
        linked[i] = 100 * both >= percent * (sizes[i] + sizes - both)
    if sides is not None:
        linked &= sides[:, None] != sides
    np.fill_diagonal(linked, False)
    return linked


def _confirm(scratch: b.Scratch, packed: DataFrame, groups: DataFrame, size: int, percent: int) -> DataFrame:
    """Confirmed links, spanning, in groups of candidates: each group whole or, if large, in pairs of blocks of its documents."""
    counts = groups.groupBy("component").agg(F.count("*").alias("n"))
    parts = F.ceil(F.col("n") / TOGETHER).cast("int")
    dealt = (groups.join(counts, "component").withColumn("parts", parts)
             .withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")))
    wanted = (dealt.withColumn("block", F.shiftright("node", PLACES))
              .select("block", F.struct("node", "component", "parts", "part").alias("want")).groupBy("block").agg(F.collect_list("want").alias("wants")))

    def each(key, left, right):
        none = pa.schema([("node", pa.int64()), ("component", pa.int64()), ("parts", pa.int32()), ("part", pa.int32()), ("members", pa.binary())])
        if not left.num_rows or not right.num_rows:
            return none.empty_table()
        rows = b.of_payload(left.combine_chunks().column("payload").chunk(0)[0])
        wants = right.column("wants").to_pylist()[0]
        sets = []
        for k in range(0, len(wants), 500):
            places = pa.array([x["node"] & ((1 << PLACES) - 1) for x in wants[k:k + 500]])
            sets += [s.tobytes() for s in shingle_sets(rows.column("text").take(places), size)]
        return pa.table([pa.array([x["node"] for x in wants]), pa.array([x["component"] for x in wants]), pa.array([x["parts"] for x in wants], pa.int32()),
                         pa.array([x["part"] for x in wants], pa.int32()), pa.array(sets, pa.binary())], schema=none)
    sets = packed.select("block", "payload").groupBy("block").cogroup(wanted.groupBy("block")).applyInArrow(
        each, "node long, component long, parts int, part int, members binary")
    # A document of part p meets part q in the task (p, q), p <= q.
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    met = sets.withColumn("other", other).withColumn("low", F.least("part", "other")).withColumn("high", F.greatest("part", "other"))
    bundles = int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 4
    met = met.withColumn("task", F.when(F.col("parts") == 1, F.pmod(F.xxhash64("component"), F.lit(bundles)))
                         .otherwise(F.xxhash64("component", "low", "high")))

    def verify(table):
        column = table.column("members").combine_chunks()
        data, at = w.buffer(column)
        group = np.unique(np.stack([table.column(c).to_numpy() for c in ("component", "low", "high")]), axis=1, return_inverse=True)[1].ravel()
        node, part = table.column("node").to_numpy(), table.column("part").to_numpy()
        low, high = table.column("low").to_numpy(), table.column("high").to_numpy()
        order = np.argsort(group, kind="stable")
        cuts = np.append(np.flatnonzero(np.append(True, group[order][1:] != group[order][:-1])), len(order))
        links = []
        for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            pick = order[a:z]
            if len(pick) > 1:
                sides = part[pick] if low[pick[0]] != high[pick[0]] else None
                links += _spanning(node[pick], confirmed([data[at[k]:at[k + 1]].view(np.uint64) for k in pick], sides, percent))
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})
    return met.groupBy("task").applyInArrow(lambda t: verify(t), "a long, b long")


def _placed(scratch: b.Scratch, packed: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Each row (``node``) with its ``component`` (a node) and ``component_id`` (the smallest id in it)."""
    every = scratch.save(_documents(packed, shingle), "documents")
    reps = scratch.save(every.filter("n_shingles > 0").groupBy("one", "two").agg(
        F.min("doc_id").alias("doc_id"), F.min_by(F.struct("sketch", "brief"), "node").alias("s"), F.min("node").alias("node")).select(
            "one", "two", "doc_id", "node", "s.sketch", "s.brief"), "representatives")
    groups = components(scratch, _close(scratch, reps, percent / 100), "groups")
    linked = components(scratch, scratch.save(_confirm(scratch, packed, groups, shingle, percent), "confirmed"), "linked")
    placed = reps.join(linked, "node", "left").select("one", "two", "doc_id", F.coalesce("component", "node").alias("component"))
    first = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    placed = placed.join(first, "component").select("one", "two", "component", "component_id")
    some = every.filter("n_shingles > 0").drop("sketch", "brief").join(placed, ["one", "two"]).select("node", "doc_id", "n_shingles", "component", "component_id")
    none = every.filter("n_shingles = 0").select("node", "doc_id", "n_shingles", F.col("node").alias("component"), F.col("doc_id").alias("component_id"))
    return some.unionByName(none)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80,
                    block_bytes: int = b.BLOCK_BYTES) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    A document's set is its distinct shingles of ``shingle`` words (``[^\\x20\\x09-\\x0D]+`` after A-Z became a-z), or its whole
    sequence if it has fewer words. Documents are linked if 100 times the intersection is at least ``percent`` times
    the union; ``component_id`` is the smallest id that links reach, and that document is ``kept``.

    Null and wordless texts have no shingles and no links: each is its own component. A row without an id takes the smallest
    id of its component, null if no member has one, and is kept only then. Repeated rows are linked and have one id, so they
    are all marked as kept. Other columns are ignored; an empty table gives no rows. Long texts are worked on whole,
    texts with equal sets as one.
    """
    scratch = b.Scratch(docs.sparkSession, "near")
    out = _placed(scratch, b.pack(scratch, docs, id_col, text_col, size=block_bytes), shingle, percent)
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """The documents, all columns, with one row of each component: the one with the smallest id (of repeated rows, one; rows without an id come last)."""
    scratch = b.Scratch(docs.sparkSession, "near")
    others = [c for c in docs.columns if c != text_col]
    packed = b.pack(scratch, docs, id_col, text_col, F.struct(*(F.col(f"`{c}`") for c in others)).alias("rest"))
    rows = _placed(scratch, packed, shingle, percent)
    best = rows.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "node")).alias("m")).select(F.col("m.node").alias("node"))
    kept = best.groupBy(F.shiftright("node", PLACES).alias("block")).agg(F.collect_list(F.col("node").bitwiseAND((1 << PLACES) - 1)).alias("places"))
    names = docs.columns

    def each(key, left, right):
        rows = b.of_payload(left.combine_chunks().column("payload").chunk(0)[0])
        places = sorted(right.column("places").to_pylist()[0]) if right.num_rows else []
        rows = rows.take(pa.array(places, pa.int64()))
        rest = rows.column("rest").combine_chunks()
        rest = rest.chunk(0) if isinstance(rest, pa.ChunkedArray) and rest.num_chunks else rest
        fields = dict(zip(others, rest.flatten())) if others else {}
        return pa.table([rows.column("text") if c == text_col else fields[c] for c in names], names=names)
    return packed.select("block", "payload").groupBy("block").cogroup(kept.groupBy("block")).applyInArrow(each, docs.schema)

"""Near-duplicates by a MinHash LSH forest.

Every distinct shingle set is one node with a signature of minimum hashes.  A tree of the
forest sorts the nodes by the signature, each tree starting at another place of it.  Nodes that
share the first ``ROOT`` hashes of a tree form a region; inside it the depth is not fixed: a
node's candidates are the neighbours with the longest common prefix, which lie deep in the
order where the region is dense and right below the root where it is sparse.  There are as many trees as it
takes for two sets at the similarity limit to share a root but for ``MISSED``.

Candidates are confirmed on the full sets.  Only what can still change the result is looked at
again: regions that hold more than one component.  There every node outside the region's largest
component meets all nodes of other components, in blocks that index the full sets by shingle and count
what a probe has in common with all targets at once; each block returns only a spanning forest of
its links.  So no link of a region is lost, and neither the pairs inside large groups of copies nor those
of many texts just below the limit are ever written out.

A region of several blocks sends its sets to more than one of them.  Before that, nodes are left out that
cannot link with another component: too few of their shingles occur in any other one.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import ascii_words, map_batches, mixed, stored, table, word_hasher

ROOT = 4
# Share of pairs at the limit that may have no root in common.
MISSED = 1e-5
NEIGHBOURS = 3
# Nodes and shingles of one block of a region.
BLOCK, BLOCK_SHINGLES = 2048, 1 << 20
# Rows of one region are spread over so many keys where they meet what is known of the region.
SALTS = 8
# Links that one task of the components search takes at first.
EDGES_PER_TASK = 200_000
SIMILARITY = 85
WIDTH = 3


def trees_for(similarity: int) -> int:
    """Trees after which a pair at the limit has missed a common root with probability ``MISSED``."""
    shared = min(similarity / 100, 0.99) ** ROOT
    return max(1, math.ceil(math.log(MISSED) / math.log(1 - shared)))


def least_agreeing(similarity: int) -> int:
    """Equal hashes of neighbours worth a look at their sets: five deviations below those at the limit.

    What this leaves out is met again in open regions; it only saves work.
    """
    n, share = trees_for(similarity) * ROOT, similarity / 100
    return max(1, math.floor(n * share - 5 * math.sqrt(n * share * (1 - share))))


def _constants(n: int) -> tuple[np.ndarray, np.ndarray]:
    factors = mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    return factors, mixed(np.arange(101, 101 + n, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def shingle_set(text: str | None, width: int = WIDTH) -> set:
    """Distinct runs of ``width`` words; with fewer words the whole sequence; none without words."""
    words = ascii_words(text)
    if not words:
        return set()
    if len(words) < width:
        return {tuple(words)}
    return set(zip(*(words[i:] for i in range(width))))


def hashed_set(words: list[bytes], hasher, width: int) -> np.ndarray:
    """Sorted distinct 64-bit digests of the shingles."""
    h = np.fromiter(map(hasher.__getitem__, words), np.uint64, len(words))
    width = min(width, len(words))
    n = len(h) - width + 1
    total = np.full(n, width, np.uint64)
    for i in range(width):
        total = total * np.uint64(0x9E3779B97F4A7C15) + h[i:i + n]
        total ^= total >> np.uint64(29)
    return np.unique(mixed(total))


def signatures(sets: list[np.ndarray], constants: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """One row of 32-bit minima per set."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), len(constants[0])), np.uint32)
    for k, (factor, shift) in enumerate(zip(*constants)):
        out[:, k] = np.minimum.reduceat((flat * factor + shift) >> np.uint64(32), starts)
    return out


def region_keys(minima: np.ndarray) -> np.ndarray:
    """Per tree, the digest of the hashes at its root."""
    trees = minima.shape[1] // ROOT
    keys = np.tile(np.arange(1, trees + 1, dtype=np.uint64), (len(minima), 1))
    roots = minima.reshape(len(minima), trees, ROOT).astype(np.uint64)
    for k in range(ROOT):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + roots[:, :, k])
    return keys.view(np.int64)


def signed(docs: DataFrame, width: int = WIDTH, similarity: int = SIMILARITY) -> DataFrame:
    """(doc_id, text_hash, n_shingles, node, sig, keys) per row; node is null without words."""
    hashes = trees_for(similarity) * ROOT

    def make():
        hasher, constants = word_hasher(), _constants(hashes)

        def work(batch):
            texts = batch.column("text")
            out = {c: [] for c in ("n_shingles", "node", "sig", "keys")}
            for i in range(0, batch.num_rows, 64):
                words = [ascii_words(t) for t in texts.slice(i, 64).to_pylist()]
                sets = [hashed_set(w, hasher, width) if w else None for w in words]
                full = [s for s in sets if s is not None]
                minima = signatures(full, constants) if full else None
                keys = region_keys(minima).tolist() if full else []
                at = 0
                for s in sets:
                    out["n_shingles"].append(0 if s is None else len(s))
                    if s is None:
                        out["node"].append(None)
                        out["sig"].append(None)
                        out["keys"].append(None)
                        continue
                    out["node"].append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    out["sig"].append(minima[at].astype(np.uint8).tobytes())
                    out["keys"].append(keys[at])
                    at += 1
            return out | {"doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash")}

        return work

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(
        docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")),
        f"doc_id {kind}, text_hash long, n_shingles long, node binary, sig binary, keys array<long>", make)


def _spread_join(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """``rows`` joined with what is known per ``key``; the rows of one key go to ``SALTS`` places."""
    salt = f"_{key}_salt"
    salted = rows.withColumn(salt, F.pmod(F.xxhash64("node"), F.lit(SALTS)))
    copies = known.withColumn(salt, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(copies, [key, salt]).drop(salt)


def regions_of(nodes: DataFrame) -> DataFrame:
    """(key, node, n_shingles, sig, place): members of regions with two nodes or more, with their place in the order."""
    members = nodes.select("node", F.posexplode("keys").alias("tree", "key"))
    shared = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    turn = F.col("tree") * ROOT
    place = F.concat(F.substring("sig", turn + 1, F.length("sig")), F.substring("sig", F.lit(1), turn))
    return _spread_join(members, shared, "key").join(nodes.select("node", "n_shingles", "sig"), "node").select(
        "key", "node", "n_shingles", "sig", place.alias("place"))


def _agreeing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).sum(axis=-1)


def _sizes_allow(n, m, similarity: int):
    """The smaller set must reach the limit even if the larger one contains it."""
    return 100 * np.minimum(n, m) >= similarity * np.maximum(n, m)


def _sig_matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


_PAIR = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("agreeing", pa.int32())])


def neighbour_pairs(regions: DataFrame, similarity: int) -> DataFrame:
    """Each node and its neighbour in the order of each tree, at most NEIGHBOURS of them, the closest.

    The order is global, so one large region spreads over many tasks; the neighbours on both sides of
    a cut between tasks meet later, in ``open_pairs``.
    """
    ordered = regions.repartitionByRange("key", "place").sortWithinPartitions("key", "place", "node")
    least = least_agreeing(similarity)

    def pair(batches):
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.asarray(batch.column("key"), np.int64)
            sizes = np.asarray(batch.column("n_shingles"), np.int64)
            nodes = batch.column("node").to_pylist()
            sigs = _sig_matrix(batch.column("sig"))
            if last is not None:
                keys, sizes = np.append(last[0], keys), np.append(last[1], sizes)
                nodes, sigs = [last[2], *nodes], np.vstack([last[3], sigs])
            last = keys[-1:], sizes[-1:], nodes[-1], sigs[-1:]
            agreeing = _agreeing(sigs[1:], sigs[:-1])
            good = (keys[1:] == keys[:-1]) & (agreeing >= least) & _sizes_allow(sizes[1:], sizes[:-1], similarity)
            at = np.flatnonzero(good)
            yield pa.RecordBatch.from_arrays([
                pa.array([nodes[i + 1] for i in at], pa.binary()), pa.array([nodes[i] for i in at], pa.binary()),
                pa.array(agreeing[at], pa.int32())], schema=_PAIR)

    found = ordered.select("key", "n_shingles", "node", "sig").mapInArrow(pair, "a binary, b binary, agreeing int")
    # A node has one such neighbour per tree: the set is small.
    nearest = found.groupBy("a").agg(F.sort_array(F.collect_set(F.struct("agreeing", "b")), asc=False).alias("x"))
    return nearest.select("a", F.explode(F.slice("x", 1, NEIGHBOURS)).alias("x")).select(
        F.least("a", "x.b").alias("a"), F.greatest("a", "x.b").alias("b")).distinct()


def digests_of(texts: DataFrame, width: int) -> DataFrame:
    """(node, digests): the hashed shingle set of each node, sorted, as little-endian 64-bit integers."""
    def make():
        hasher = word_hasher()

        def work(batch):
            sets = [hashed_set(ascii_words(t.as_py()), hasher, width) for t in batch.column("text")]
            return {"node": batch.column("node"), "digests": [s.astype("<u8").tobytes() for s in sets]}

        return work

    return map_batches(texts.select("node", "text"), "node binary, digests binary", make)


class Block:
    """Targets of one block of a region, indexed by shingle, kept while its probes pass by."""

    def __init__(self, rows: list[dict], similarity: int):
        self.similarity = similarity
        self.nodes = [r["node"] for r in rows]
        self.numbers: dict[bytes, int] = {}
        self.joined: dict[int, int] = {}
        self.label = np.array([self._number(r["component"]) for r in rows])
        sets = [np.frombuffer(r["digests"], "<u8") for r in rows]
        self.sizes = np.array([len(s) for s in sets])
        flat = np.concatenate(sets)
        order = np.argsort(flat, kind="stable")
        self.digests, self.owners = flat[order], np.repeat(np.arange(len(sets), dtype=np.int32), self.sizes)[order]

    def _number(self, component: bytes) -> int:
        return self.numbers.setdefault(component, len(self.numbers))

    def common(self, digests: np.ndarray) -> np.ndarray:
        """How many of the digests each target has."""
        low, high = np.searchsorted(self.digests, digests, "left"), np.searchsorted(self.digests, digests, "right")
        counts = high - low
        at = np.repeat(low - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())
        return np.bincount(self.owners[at], minlength=len(self.nodes))

    def _now(self, number: int) -> int:
        """The component that a component is part of by now."""
        while number in self.joined:
            number = self.joined[number]
        return number

    def links(self, probe: dict):
        """Targets that link the probe to components it isn't linked with yet, one of each."""
        digests = np.frombuffer(probe["digests"], "<u8")
        common = self.common(digests)
        near = np.flatnonzero(100 * common >= self.similarity * (len(digests) + self.sizes - common))
        if not len(near):
            return
        own = self._now(self._number(probe["component"]))
        for j in near[self.label[near] != own]:
            other = self.label[j]
            if other != own:
                self.label[self.label == own] = other
                self.joined[own] = other
                own = other
                yield self.nodes[j]


def _linkable(rows: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The nodes that can link with another component: enough of their shingles occur in one.

    A link shares at least ``similarity`` percent of the shingles of either side.
    """
    members = rows.select("node", "component").distinct().join(sets, "node")

    def make():
        def work(batch):
            digests = [np.frombuffer(d.as_py(), "<i8") for d in batch.column("digests")]
            counts = np.array([len(d) for d in digests])
            row = pa.array(np.repeat(np.arange(len(digests)), counts))
            return {"digest": np.concatenate(digests), "node": batch.column("node").take(row),
                    "component": batch.column("component").take(row)}

        return work

    each = map_batches(members, "digest long, node binary, component binary", make)
    ends = each.groupBy("digest").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    shared = _spread_join(each, ends.where("low <> high").select("digest"), "digest").groupBy("node").agg(
        F.count(F.lit(1)).alias("shared"))
    sizes = rows.select("node", "n_shingles").distinct()
    return shared.join(sizes, "node").where(F.col("shared") * 100 >= F.col("n_shingles") * similarity).select("node")


def _mixed_regions(placed: DataFrame) -> DataFrame:
    """(key, largest, blocks, probe_blocks) of the regions with several components."""
    parts = placed.groupBy("key", "component").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("s"))

    def blocks(rows, shingles):
        return F.greatest(F.ceil(rows / BLOCK), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")

    found = parts.groupBy("key").agg(
        F.count(F.lit(1)).alias("parts"), F.max(F.struct("n", "component", "s")).alias("top"),
        F.sum("n").alias("n"), F.sum("s").alias("s")).where("parts > 1")
    return found.select(
        "key", F.col("top.component").alias("largest"), blocks(F.col("n"), F.col("s")).alias("blocks"),
        blocks(F.col("n") - F.col("top.n"), F.col("s") - F.col("top.s")).alias("probe_blocks"))


def open_pairs(regions: DataFrame, components: DataFrame, texts: DataFrame, width: int, similarity: int) -> DataFrame:
    """Similar pairs between components of a region: every node outside the largest component meets all others.

    Targets and probes are dealt in blocks, so a task holds one block of targets however large the region is.
    A block returns a spanning forest of what it links, never all pairs.
    """
    comp = F.coalesce("component", "node").alias("component")
    placed = regions.join(components, "node", "left").select("key", "node", "n_shingles", comp)
    rows = stored(_spread_join(placed, _mixed_regions(placed), "key"), "open")
    sets = stored(digests_of(texts.join(rows.select("node").distinct(), "node", "left_semi"), width), "sets")
    columns = "key", "node", "n_shingles", "component"
    large = rows.where("blocks > 1").select(*columns)
    if not large.isEmpty():
        able = large.join(_linkable(large, sets, similarity), "node", "left_semi").select(*columns)
        able = stored(able, "linkable")
        rows = rows.where("blocks = 1").unionByName(_spread_join(able, _mixed_regions(able), "key"))
    rows = rows.join(sets, "node")

    def dealt_to(count):
        return F.pmod(F.xxhash64("node"), F.col(count)).cast("int")

    def each_of(count):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    columns = "key", "block", "probe_block", "role", "node", "component", "digests"
    targets = rows.withColumn("block", dealt_to("blocks")).select(
        "*", each_of("probe_blocks").alias("probe_block"), F.lit(0).alias("role")).select(*columns)
    probes = rows.where(F.col("component") != F.col("largest")).withColumn(
        "probe_block", dealt_to("probe_blocks")).select(
        "*", each_of("blocks").alias("block"), F.lit(1).alias("role")).select(*columns)
    grouped = targets.unionByName(probes).repartition("key", "block", "probe_block").sortWithinPartitions(
        "key", "block", "probe_block", "role", "node")

    def run(batches):
        group, rows, block = None, [], None
        for batch in batches:
            found = []
            for start in range(0, batch.num_rows, 256):
                for row in batch.slice(start, 256).to_pylist():
                    name = row["key"], row["block"], row["probe_block"]
                    if name != group:
                        group, rows, block = name, [], None
                    if row["role"] == 0:
                        rows.append(row)
                        continue
                    if block is None:
                        if not rows:
                            continue
                        block, rows = Block(rows, similarity), []
                    found += [(row["node"], other) for other in block.links(row)]
            yield pa.RecordBatch.from_arrays([
                pa.array([min(x) for x in found], pa.binary()), pa.array([max(x) for x in found], pa.binary())],
                names=["a", "b"])

    return grouped.mapInArrow(run, "a binary, b binary").distinct()


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, similarity: int) -> DataFrame:
    """``pairs`` with ``linked``: whether the full sets are similar enough."""
    left = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    both = left.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")

    def make():
        recent: dict[bytes, set] = {}

        def full(node, text):
            found = recent.get(node)
            if found is None:
                if len(recent) >= 16:
                    recent.clear()
                found = recent[node] = shingle_set(text, width)
            return found

        def work(batch):
            linked = []
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64).to_pydict()
                for a, b, s, t in zip(part["a"], part["b"], part["text_a"], part["text_b"]):
                    x, y = full(a, s), full(b, t)
                    common = len(x & y)
                    linked.append(100 * common >= similarity * (len(x) + len(y) - common))
            return {"a": batch.column("a"), "b": batch.column("b"), "linked": linked}

        return work

    return map_batches(both.select("a", "b", "text_a", "text_b"), "a binary, b binary, linked boolean", make)


def local_stars(edges: DataFrame) -> DataFrame:
    """The edges of each task as stars around the smallest node: same components, no more rows than nodes."""
    def run(batches):
        parent: dict = {}

        def root(x):
            top = x
            while (up := parent.get(top, top)) != top:
                top = up
            while x != top:
                parent[x], x = top, parent.get(x, x)
            return top

        for batch in batches:
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x, y = root(u), root(v)
                if x != y:
                    parent[max(x, y)] = min(x, y)
        nodes = list(parent)
        for start in range(0, len(nodes), 10_000):
            part = nodes[start:start + 10_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.binary()), pa.array([root(x) for x in part], pa.binary())], names=["u", "v"])

    return edges.select("u", "v").mapInArrow(run, "u binary, v binary")


def components_of(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) for all nodes of the links (a, b) but the smallest of each component.

    Tasks of at most about EDGES_PER_TASK links first turn their own links to stars.  Then large and
    small star steps in turn: every node's neighbours move to its smallest neighbour, until each component is a
    star around its smallest node.
    """
    links = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(),
                   label)
    tasks = links.count() // EDGES_PER_TASK + 1
    # Coalesced, one task is one task; a number given with a key may be raised.
    edges = stored(local_stars(links.repartition(tasks, "u") if tasks > 1 else links.coalesce(1)), label)
    if tasks == 1:  # one task has seen all links: its stars are the components
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))

    def fingerprint(table):
        return table.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    state = fingerprint(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large.coalesce(tasks), label)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u")
        edges = stored(moved.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))).distinct().coalesce(tasks), label)
        now = fingerprint(edges)
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        state = now


def near_duplicates(
    docs: DataFrame, ident: str = "doc_id", text: str = "text", width: int = WIDTH, similarity: int = SIMILARITY,
) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id reachable over links) and kept, per row.

    Null and empty texts have no set and link with nothing.  A row without identifier takes no part
    either: its component is null and it stays.  Rows with equal sets are one node, so copies cost one row
    each.  Repeated identifiers are rows like any other; all rows with the smallest identifier of a
    component stay.  Empty table: no rows.  Other columns are not read.
    """
    docs = docs.select(F.col(ident).alias("doc_id"), F.col(text).alias("text"))
    rows = stored(signed(docs, width, similarity), "signed")
    usable = rows.where(F.col("node").isNotNull() & F.col("doc_id").isNotNull())
    nodes = stored(usable.groupBy("node").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("first"), F.first("n_shingles").alias("n_shingles"),
        F.first("sig").alias("sig"), F.first("keys").alias("keys")), "nodes")
    regions = stored(regions_of(nodes), "regions")

    active = nodes.join(regions.select("node").distinct(), "node", "left_semi").select(
        "node", F.col("first.doc_id").alias("doc_id"), F.col("first.text_hash").alias("text_hash"))
    hashed = docs.where(F.col("doc_id").isNotNull()).withColumn("text_hash", F.xxhash64("text"))
    # A row given twice is one text.
    texts = stored(hashed.join(active, ["doc_id", "text_hash"]).select("node", "text").dropDuplicates(["node"]), "texts")

    pairs = stored(neighbour_pairs(regions, similarity), "pairs")
    tested = stored(confirmed(pairs, texts, width, similarity), "tested")
    components = components_of(tested.where("linked"))
    found = stored(open_pairs(regions, components, texts, width, similarity), "pairs")
    if not found.isEmpty():
        checked = stored(confirmed(found, texts, width, similarity), "tested")
        # The stars found so far hold all links known before.
        known = components.select(F.col("node").alias("a"), F.col("component").alias("b"))
        components = components_of(known.unionByName(checked.where("linked").select("a", "b")))

    # Every node of a component carries the smallest identifier of all of them.
    named = nodes.select("node", F.col("first.doc_id").alias("low")).join(components, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    lowest = named.groupBy("component").agg(F.min("low").alias("component_id"))
    of_node = _spread_join(named, lowest, "component").select("node", "component_id")
    return (
        rows.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("node")).alias("node"))
        .join(of_node, "node", "left")
        .select(F.col("doc_id").alias(ident), "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
        .withColumn("kept", F.col(ident).eqNullSafe(F.col("component_id")))
    )


def op1_minhash_forest(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))

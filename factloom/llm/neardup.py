"""MinHash near-dedup by a chosen-path set similarity join.

A document is the set of its distinct k-word shingles.  Equal sets are
collapsed first.  Every tree then branches the rest recursively: the path of
a set so far chooses one of its minwise coordinates, and sets with the same
value there go on together.  A node that has become small is compared
exhaustively; a large one is branched again.  Independent trees repeat this
to the target recall: a pair of similarity s stays together for d levels of
one path with probability s^d, and most nodes are small after two.

Every row carries a sketch, two bits of each minwise value; pairs whose
sketches differ too much are no candidates.  Comparing goes in two rounds.
The first confirms, in each small node, a spanning forest of the closest
pairs, and in nodes that stay large (thousands of near copies) each member
with its nearest of a few pivots, members close to the node's majority.  The second compares in all nodes exactly
the pairs that are still in different components: the links that it leaves
out can't change a class, and nothing is capped.

Candidates are confirmed on full sets of 64-bit shingle hashes.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel, shared
from .components import components


@dataclass(frozen=True)
class Join:
    """shingle: words a shingle; percent: least Jaccard similarity; trees, levels, small: of the recursion.

    pivots: of a node that stays large; deviations: standard ones above the mean that a sketch of a pair at the threshold may differ by.
    """

    shingle: int = 2
    percent: int = 80
    trees: int = 14
    levels: int = 4
    small: int = 48
    pivots: int = 6
    deviations: float = 4.0

    def _most(self, n: int, q: float) -> int:
        return int(np.ceil(n * q + self.deviations * np.sqrt(n * q * (1 - q))))

    @property
    def apart(self) -> int:
        """Coordinates whose two sketch bits may differ."""
        return self._most(COORDINATES, (1 - self.percent / 100) * 3 / 4)

    @property
    def fine_apart(self) -> int:
        """Bits of the fine sketches that may differ."""
        return self._most(FINE, (1 - self.percent / 100) / 2)


#: Minwise values of a set; the sketch holds their lowest bits in two words and the next ones in two more.
COORDINATES = 128
SKETCH = ("s0", "s1", "s2", "s3")


#: Minwise values behind the one-bit sketches that members of unsettled large nodes get besides.
FINE = 2048


def _differing(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    low, high = np.bitwise_count((x[0] ^ y[0]) | (x[2] ^ y[2])), np.bitwise_count((x[1] ^ y[1]) | (x[3] ^ y[3]))
    return low.astype(np.int64) + high


def _words(of) -> list[np.ndarray]:
    return [np.asarray(of(k)).view(np.uint64) for k in SKETCH]


def _seeds(n: int, salt: int) -> np.ndarray:
    return kernel.mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt))


def _minwise(values: np.ndarray, n: int) -> np.ndarray:
    a, b = (_seeds(n, 1) | np.uint64(1))[:, None], _seeds(n, 2)[:, None]
    low = np.full(n, (1 << 32) - 1, dtype=np.uint32)
    step = max(1, (1 << 18) // n)
    for lo in range(0, len(values), step):
        x = values[None, lo : lo + step] * a
        x += b
        np.minimum(low, (x >> np.uint64(32)).astype(np.uint32).min(axis=1), out=low)
    return low


def _paths(low: np.ndarray, conf: Join) -> np.ndarray:
    """(rows, trees, levels): the nodes that each row passes in each tree."""
    out = np.zeros((len(low), conf.trees, conf.levels), dtype=np.uint64)
    rows = np.arange(len(low))
    for t, seed in enumerate(_seeds(conf.trees, 3)):
        path = np.full(len(low), seed, dtype=np.uint64)
        for level in range(conf.levels):
            chosen = ((path >> np.uint64(17)) % np.uint64(COORDINATES)).astype(np.int64)
            path = kernel.mix(path ^ (low[rows, chosen].astype(np.uint64) + (chosen.astype(np.uint64) << np.uint64(40))))
            out[:, t, level] = path
    return out


def sets_of(batch_text: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes, A-Z lower-cased) of every row."""
    for lo, hi, data, offsets in kernel.blocks(batch_text):
        words = kernel.Words(data, offsets, lower=True)
        all_of, first = kernel.shingles(words, k)
        for i in range(hi - lo):
            yield lo + i, np.unique(all_of[first[i] : first[i + 1]])


def _summaries(conf: Join):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            size, digest = np.zeros(n, np.int64), np.zeros((n, 2), np.uint64)
            low = np.zeros((n, COORDINATES), np.uint32)
            for row, members in sets_of(batch["text"], conf.shingle):
                size[row] = len(members)
                if len(members):
                    digest[row] = kernel.mix(members * np.uint64(0xA24BAED4963EE407)).sum(), kernel.mix(members ^ np.uint64(0x9FB21C651E98DF25)).sum()
                    low[row] = _minwise(members, COORDINATES)
            low_bytes = pa.array([x.tobytes() for x in low], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch["rid"], pa.array(size), pa.array(digest[:, 0].view(np.int64)), pa.array(digest[:, 1].view(np.int64)), low_bytes],
                names=["rid", "n_shingles", "d1", "d2", "low"],
            )

    return run


def _branches(conf: Join):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                batch = whole.slice(at, 2000)
                n = batch.num_rows
                low = np.frombuffer(b"".join(batch["low"].to_pylist()), dtype=np.uint32).reshape(n, COORDINATES)
                nodes = _paths(low, conf)
                place = np.arange(64, dtype=np.uint64)
                packed = lambda part, bit: pa.array(np.bitwise_or.reduce((low[:, part] >> np.uint32(bit) & np.uint32(1)).astype(np.uint64) << place, axis=1).view(np.int64))  # noqa: E731, B023
                sketches = [packed(half, bit) for bit in (0, 1) for half in (slice(0, 64), slice(64, 128))]
                ids = batch["rid"]
                for t in range(conf.trees):
                    yield pa.RecordBatch.from_arrays([ids, *sketches, *[pa.array(nodes[:, t, v].view(np.int64)) for v in range(conf.levels)]], names=["rid", *SKETCH, *[f"p{v}" for v in range(conf.levels)]])

    return run


def _close_pairs(members: pa.ListArray, conf: Join) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.StructArray]:
    """All pairs of each node's members whose sketches are close: positions, distances, and the members."""
    size = np.diff(np.asarray(members.offsets))
    flat = members.flatten()
    sketch = _words(flat.field)
    node = np.repeat(np.arange(len(size)), size)
    left, right, far = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for step in range(1, int(size.max(initial=1))):
        at = np.flatnonzero(node[step:] == node[:-step])
        apart = _differing([w[at] for w in sketch], [w[at + step] for w in sketch])
        near = apart <= conf.apart
        left.append(at[near])
        right.append(at[near] + step)
        far.append(apart[near])
    return np.concatenate(left), np.concatenate(right), np.concatenate(far), flat


#: Pairs of a node's members that are compared at once.
PAIRS_AT_ONCE = 400_000


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.ListArray]:
    """The nodes' members in parts with about so many pairs each, and unused memory given back after the last."""
    for batch in batches:
        size = np.diff(np.asarray(batch["members"].offsets)).astype(np.int64)
        part = np.cumsum(size * size) // (2 * PAIRS_AT_ONCE)
        cuts = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(size)]]).tolist()
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            yield batch["members"].slice(lo, hi - lo)
    pa.default_memory_pool().release_unused()


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def _spanning(conf: Join):
    """Of each small node, a spanning forest of its close pairs, the closest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for members in _bounded(batches):
            left, right, far, flat = _close_pairs(members, conf)
            ids = np.asarray(flat.field("rid"))
            parent: dict[int, int] = {}

            def find(x: int) -> int:
                while (p := parent.setdefault(x, x)) != x:
                    parent[x] = x = parent[p]
                return x

            taken = []
            order = np.argsort(far, kind="stable")
            for k, x, y in zip(order.tolist(), left[order].tolist(), right[order].tolist(), strict=True):
                x, y = find(x), find(y)
                if x != y:
                    parent[x] = y
                    taken.append(k)
            yield _pairs(ids[left[taken]], ids[right[taken]])

    return run


def _across(conf: Join):
    """Of each small node, all close pairs of members in different components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for members in _bounded(batches):
            left, right, _, flat = _close_pairs(members, conf)
            ids, of = np.asarray(flat.field("rid")), np.asarray(flat.field("component"))
            cross = of[left] != of[right]
            yield _pairs(ids[left[cross]], ids[right[cross]])

    return run


def _near_pivots(conf: Join):
    """Each row of a large node with its nearest pivot; a pivot goes with all others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pivots = batch["pivots"]
            size = np.diff(np.asarray(pivots.offsets))
            flat = pivots.flatten()
            ids, own = np.asarray(flat.field("rid")), np.asarray(batch["rid"])
            row = np.repeat(np.arange(len(size)), size)
            apart = _differing(_words(flat.field), [w[row] for w in _words(batch.column)])
            is_pivot = np.zeros(len(own), bool)
            is_pivot[row[ids == own[row]]] = True
            order = np.lexsort((apart, row))
            rank = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
            take = order[(rank == 0) | is_pivot[row[order]]]
            take = take[(ids[take] != own[row[take]]) & (apart[take] <= conf.apart)]
            yield _pairs(own[row[take]], ids[take])

    return run


def _full_sets(conf: Join):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                yield pa.RecordBatch.from_arrays([part["rid"], pa.array([x.tobytes() for _, x in sets_of(part["text"], conf.shingle)], pa.binary())], names=["rid", "members"])

    return run


def _fine_sketches(conf: Join):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                bits = np.array([_minwise(x, FINE) & 1 for _, x in sets_of(part["text"], conf.shingle)], dtype=np.uint8).reshape(-1, FINE)
                words = np.packbits(bits, axis=1).view(np.int64)
                yield pa.RecordBatch.from_arrays([part["rid"], *(pa.array(np.ascontiguousarray(words[:, i])) for i in range(FINE // 64))], names=["rid", *(f"f{i}" for i in range(FINE // 64))])

    return run


def _confirm(conf: Join):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = []
            for x, y in zip(batch["x"], batch["y"], strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if 100 * min(len(x), len(y)) < conf.percent * max(len(x), len(y)):
                    held.append(False)
                    continue
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                both = int((y[at] == x).sum())
                held.append(100 * both >= conf.percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], names=["a", "b"]).filter(pa.array(held, pa.bool_()))

    return run


#: A table of ids is broadcast up to this many rows (8 bytes each); beyond, it is shuffled.
BROADCAST_ROWS = 500_000


def _confirmed(pairs: DataFrame, texts: DataFrame, conf: Join) -> DataFrame:
    """Stored edges (a, b) of the stored distinct candidates whose full sets are similar enough."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("rid")).distinct()
    sets = shared.stored(_of_ids(texts, ids).mapInArrow(kernel.tidy(_full_sets(conf)), "rid long, members binary"), "sets")
    x = sets.select(F.col("rid").alias("a"), F.col("members").alias("x"))
    y = sets.select(F.col("rid").alias("b"), F.col("members").alias("y"))
    out = shared.stored(pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(kernel.tidy(_confirm(conf)), "a long, b long"), "links")
    shared.drop(sets)
    return out


def _bit(i: int) -> int:
    """Bit i of a signed 64-bit word."""
    return 1 << i if i < 63 else -(1 << 63)


def _row_id():
    """A key of the row's content: repeated rows are one document, and null ids can be joined."""
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce("text", F.lit("")))


def similarity_classes(docs: DataFrame, conf: Join = Join()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text, ...).

    component_id: smallest doc_id reachable over links of at least
    ``conf.percent`` Jaccard similarity.  Null text and text without words:
    empty set, linked with nothing.  Equal sets are linked.  Rows with a null
    doc_id join a class by their text; a class without any id has a null
    component_id; kept is true for the row that carries the class's smallest
    id, and for null ids only where the class has no other id.  Repeated rows
    get equal results; two texts with one id are two members.  A text of any
    length is one row of work.  Extra columns are not read.  An empty table
    gives no rows.
    """
    every, found = _classes(docs, conf)
    narrow = every.select("doc_id", "n_shingles", "d1", "d2")
    out = narrow.filter("n_shingles > 0").join(found, ["d1", "d2"]).select("doc_id", "n_shingles", "component_id")
    alone = narrow.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, conf: Join = Join()) -> DataFrame:
    """The rows of ``docs``, whole, of which one of each class stays.

    It is the row with the smallest doc_id, null ids last; of several texts
    with that id, the one whose hash of id and text is the smallest; of
    repeated rows, the one whose columns come first as JSON text.  Null texts
    and texts without words belong to no class: all of them stay.  Columns
    keep their names, order and values.  An empty table gives no rows.
    """
    every, found = _classes(docs, conf)
    members = shared.stored(every.filter("n_shingles > 0").join(found, ["d1", "d2"]).groupBy("component", "rid").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("rows")), "rows")
    chosen = members.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "rid"))["rid"].alias("rid"))
    gone = shared.stored(members.join(chosen, "rid", "left_anti").select("rid"), "gone")
    again = shared.stored(members.filter("rows > 1").join(gone, "rid", "left_anti").select("rid"), "again")
    rows = docs.select(_row_id().alias("rid"), F.struct(*docs.columns).alias("row"))
    beside = lambda ids: F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids
    once = rows.join(beside(gone), "rid", "left_anti")
    if again.isEmpty():
        return once.select("row.*")
    twice = once.join(beside(again), "rid", "left_semi").groupBy("rid").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return once.join(beside(again), "rid", "left_anti").select("row.*").unionByName(twice.select("row.*"))


def _classes(docs: DataFrame, conf: Join) -> tuple[DataFrame, DataFrame]:
    """(doc_id, rid, n_shingles, d1, d2, low) of every row, and (d1, d2, component, component_id) of each set with shingles; both stored."""
    base = shared.own_columns(docs, "doc_id", "text").withColumn("rid", _row_id())
    every = shared.stored(base.select("doc_id", "rid", "text").mapInArrow(kernel.tidy(_with_id(conf)), "doc_id long, rid long, n_shingles long, d1 long, d2 long, low binary"), "summaries")
    classes = every.filter("n_shingles > 0").groupBy("d1", "d2").agg(F.min("rid").alias("cid"), F.min("doc_id").alias("least"))
    classes = shared.stored(classes, "classes")
    heads = every.join(classes.select(F.col("cid").alias("rid")), "rid", "left_semi").select("rid", "low").dropDuplicates(["rid"])
    rows = shared.stored(heads.mapInArrow(kernel.tidy(_branches(conf)), "rid long, s0 long, s1 long, s2 long, s3 long, " + ", ".join(f"p{v} long" for v in range(conf.levels))), "branches")

    candidates, stay, made, small, now = None, None, [rows], [], rows
    for level in range(conf.levels):
        node = F.col(f"p{level}")
        sizes = now.groupBy(node.alias("node")).agg(F.count("*").alias("n")).filter("n > 1")
        joined = shared.stored(now.withColumn("node", node).join(sizes, "node"), f"level{level}")
        made.append(joined)
        small.append(joined.filter(F.col("n") <= conf.small).select("node", "rid", *SKETCH))
        found = small[-1].groupBy("node").agg(F.collect_list(F.struct("rid", *SKETCH)).alias("members")).select("members").mapInArrow(kernel.tidy(_spanning(conf)), "a long, b long")
        candidates = found if candidates is None else candidates.unionByName(found)
        stay = joined.filter(F.col("n") > conf.small)
        now = stay.drop("node", "n")
        if stay.isEmpty():
            stay = None
            break
    if stay is not None:
        # A node's pivots: in each of a few slices the row closest to the majority of the node's first sketch word.  No node is gathered.
        ones = stay.groupBy("node").agg(F.count("*").alias("n"), *[F.sum(F.shiftright("s0", i).bitwiseAND(F.lit(1))).alias(f"o{i}") for i in range(64)])
        middle = ones.select("node", functools.reduce(lambda x, y: x.bitwiseOR(y), [F.when(2 * F.col(f"o{i}") > F.col("n"), F.lit(_bit(i))).otherwise(F.lit(0).cast("long")) for i in range(64)]).alias("middle"))
        slices = stay.select("node", "rid", *SKETCH).join(middle, "node").withColumn("far", F.bit_count(F.col("s0").bitwiseXOR(F.col("middle")))).withColumn("slice", F.pmod(F.xxhash64("rid"), F.lit(conf.pivots)))
        pivots = slices.groupBy("node", "slice").agg(F.min(F.struct("far", "rid", *SKETCH)).alias("pivot"))
        pivots = pivots.groupBy("node").agg(F.collect_list("pivot").alias("pivots"))
        near = stay.join(pivots, "node").select("rid", *SKETCH, "pivots").mapInArrow(kernel.tidy(_near_pivots(conf)), "a long, b long")
        candidates = candidates.unionByName(near)

    texts = base.select("rid", "text")
    tested = shared.stored(candidates.distinct(), "candidates")
    edges = _confirmed(tested, texts, conf)
    labels = components(edges)
    left = _left(small, stay, labels, texts, conf, made).distinct().join(tested, ["a", "b"], "left_anti")
    left = shared.stored(left, "candidates")
    made += [tested, left, edges, labels]
    if not left.isEmpty():
        more = _confirmed(left, texts, conf)
        labels = components(edges.unionByName(more))
        made += [more, labels]

    found = classes.join(labels.withColumnRenamed("id", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    least = found.groupBy("component").agg(F.min("least").alias("component_id"))
    found = shared.stored(found.join(least, "component").select("d1", "d2", "component", "component_id"), "members")
    shared.drop(classes, *made)
    return every, found


def _with_id(conf: Join):
    inner = _summaries(conf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                for out in inner(iter([part])):
                    yield pa.RecordBatch.from_arrays([part["doc_id"].cast(pa.int64()), *out.columns], names=["doc_id", *out.schema.names])

    return run


def _of_ids(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The texts of distinct ids, each once; the ids are broadcast only after they were counted."""
    few = ids.count() <= BROADCAST_ROWS
    return texts.join(F.broadcast(ids) if few else ids, "rid", "left_semi").dropDuplicates(["rid"])


def _left(small: list[DataFrame], stay: DataFrame | None, labels: DataFrame, texts: DataFrame, conf: Join, made: list[DataFrame]) -> DataFrame:
    """Close pairs that share a node and are still in different components.

    In a node that stayed large, members outside its largest component meet
    those of other components inside a join that compares sketches, the usual
    and finer ones of their own, so only close pairs come out of it.
    made: gets the tables that are stored on the way.
    """
    tag = lambda df: df.join(labels.withColumnRenamed("id", "rid"), "rid", "left").withColumn("component", F.coalesce("component", "rid"))
    leaves = small[0]
    for x in small[1:]:
        leaves = leaves.unionByName(x)
    nodes = tag(leaves).groupBy("node").agg(F.collect_list(F.struct("rid", *SKETCH, "component")).alias("members")).select("members")
    pairs = nodes.mapInArrow(kernel.tidy(_across(conf)), "a long, b long")
    if stay is None:
        return pairs
    tagged = tag(stay.select("node", "rid", *SKETCH))
    per = tagged.groupBy("node", "component").agg(F.count("*").alias("n"))
    split = per.groupBy("node").agg(F.max(F.struct("n", "component"))["component"].alias("main"), F.count("*").alias("kinds")).filter("kinds > 1")
    mixed = shared.stored(tagged.join(split, "node"), "mixed")
    made.append(mixed)
    if mixed.isEmpty():
        return pairs
    words = [f"f{i}" for i in range(FINE // 64)]
    fine = shared.stored(_of_ids(texts, mixed.select("rid").distinct()).mapInArrow(kernel.tidy(_fine_sketches(conf)), "rid long, " + ", ".join(f"{w} long" for w in words)), "fine")
    made.append(fine)
    # A pair that shares nodes in several trees comes out of one of them.
    nodes = mixed.groupBy("rid").agg(F.collect_set("node").alias("nodes"))
    mixed = mixed.join(fine, "rid").join(nodes, "rid")
    side = lambda df, rid, of, mark: df.select("node", F.col("rid").alias(rid), F.col("component").alias(of), *[F.col(k).alias(mark + k) for k in ("nodes", *SKETCH, *words)])
    x, y = side(mixed.filter("component <> main"), "a", "ca", "x"), side(mixed, "b", "cb", "y")
    other = lambda k: F.col(f"xs{k}").bitwiseXOR(F.col(f"ys{k}"))
    differing = F.bit_count(other(0).bitwiseOR(other(2))) + F.bit_count(other(1).bitwiseOR(other(3)))
    finely = sum((F.bit_count(F.col(f"x{w}").bitwiseXOR(F.col(f"y{w}"))) for w in words), F.lit(0))
    near = x.join(y, (x["node"] == y["node"]) & (F.col("ca") != F.col("cb")) & (differing <= conf.apart) & (finely <= conf.fine_apart) & (x["node"] == F.array_min(F.array_intersect("xnodes", "ynodes"))))
    return pairs.unionByName(near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))

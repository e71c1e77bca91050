"""Embedding near-dedup: NN-descent over bit sketches, exact links within what it connects, audited recall."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import components, discard, stored

TABLES = 16  # random-projection orders that seed the neighbour lists in one pass
LIST = 8  # neighbours kept for each vector; doubled while the last one is still near, up to LONGEST
LONGEST = 64
ROUNDS = 4  # of neighbours-of-neighbours joins in one pass, fewer once lists settle
BLOCK = 256  # vectors next to each other in a projection order that are compared
NEAR = 44  # differing bits of 128 up to which a pair is measured exactly; at a cosine of 0.95 they number 13 +- 3.4
CROWDED = 30  # a list of LONGEST neighbours no further than this may lack some that link
PART_BYTES = 8 << 20  # vectors of a component that are compared at once
BALL = 1024  # vectors with full lists that are handled as one ball
CENTRES = 4096  # balls that all others are held against at once
AUDIT = 1024  # vectors whose links are counted by brute force
WANTED, LEAST, PASSES = 0.99, 0.9, 4


def _classes(vectors: DataFrame, vec_id: str, vec: str) -> DataFrame:
    """One row for each distinct usable vector: smallest id, number of rows, components."""
    usable = F.coalesce(F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    usable &= F.coalesce(F.exists(vec, lambda x: x != 0), F.lit(False))
    return (vectors.filter(usable & F.col(vec_id).isNotNull()).groupBy(F.col(vec).alias("vec"))
            .agg(F.min(vec_id).alias("id"), F.count(F.lit(1)).alias("n")))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a binary column of doubles."""
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, width)


def _planes(width: int, n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((width, n))


def _bits(x: np.ndarray) -> np.ndarray:
    """Rows of signs as whole numbers of up to 64 bits."""
    full = np.zeros((len(x), 64), np.uint8)
    full[:, :x.shape[1]] = x
    return np.packbits(full, axis=1, bitorder="little").view(np.int64).reshape(-1)


def _sketched(classes: DataFrame, width: int) -> DataFrame:
    """``id``, ``n``, unit vector ``x`` and the 128-bit sketch ``s1``, ``s2`` of its signs on random planes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = _planes(width, 128, 7)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _unit(np.asarray(batch.column(2).flatten()).reshape(-1, width))
            s = x @ planes > 0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([r.tobytes() for r in x], pa.binary()), pa.array(_bits(s[:, :64])), pa.array(_bits(s[:, 64:]))],
                names=["id", "n", "x", "s1", "s2"])

    return classes.select("id", "n", "vec").mapInArrow(run, "id bigint, n bigint, x binary, s1 bigint, s2 bigint")


def _distance(a1, a2, b1, b2) -> np.ndarray:
    return (np.bitwise_count((a1[:, None] ^ b1[None]).view(np.uint64)).astype(np.int16)
            + np.bitwise_count((a2[:, None] ^ b2[None]).view(np.uint64)).astype(np.int16))


def _nearest(ids: np.ndarray, d: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row its ``k`` nearest others: (a, b, distance)."""
    m = min(k, len(ids) - 1)
    if m < 1:
        return ids[:0], ids[:0], d[:0, :0].reshape(-1)
    d = d.copy()
    np.fill_diagonal(d, 1000)
    near = np.argpartition(d, m - 1, axis=1)[:, :m]
    return np.repeat(ids, m), ids[near].reshape(-1), np.take_along_axis(d, near, axis=1).reshape(-1)


LINK = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("d", pa.int32())])


def _links(parts: list) -> pa.RecordBatch:
    a, b, d = (np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in range(3))
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(d, pa.int32())], schema=LINK)


def _seeds(points: DataFrame, width: int, count: int, seed: int) -> DataFrame:
    """First neighbours: vectors with the same signs on a few random planes lie together in one of the orders.

    The orders are dealt out by range, so a crowded stretch is spread over tasks.
    """
    bits = min(32, max(1, (count // 16).bit_length()))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = _planes(width, bits * TABLES, 1000 + seed)
        for batch in batches:
            if not batch.num_rows:
                continue
            signs = _matrix(batch.column(1), width) @ planes > 0
            for t in range(TABLES):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(batch.num_rows, t), pa.int32()), pa.array(_bits(signs[:, t * bits:(t + 1) * bits])),
                     batch.column(2), batch.column(3), batch.column(0)], names=["t", "code", "s1", "s2", "id"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t, code, s1, s2, ids = (c.to_numpy() for c in batch.columns)
            cuts = np.flatnonzero((t[1:] != t[:-1]) | (code[1:] != code[:-1])) + 1
            parts = []
            for a, b in zip(np.append(0, cuts), np.append(cuts, len(ids))):
                for i in range(a, b, BLOCK // 2):  # blocks overlap by half
                    s = slice(i, min(i + BLOCK, b))
                    if s.stop - i > 1:
                        parts.append(_nearest(ids[s], _distance(s1[s], s2[s], s1[s], s2[s]), LIST // 2))
                    if s.stop == b:
                        break
            yield _links(parts)

    placed = points.select("id", "x", "s1", "s2").mapInArrow(place, "t int, code bigint, s1 bigint, s2 bigint, id bigint")
    order = ["t", "code", "s1", "s2", "id"]
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(compare, "a bigint, b bigint, d int")


def _lists(links: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """The nearest neighbours of each vector, as many as its list may hold: ``a``, ``k``, ``near`` (d, b ascending)."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"), "d"))
    both = both.groupBy("a", "b").agg(F.min("d").alias("d"))
    # many may list a hub; it keeps its nearest, and the rank is cut in every task before the shuffle
    rank = F.row_number().over(Window.partitionBy("a").orderBy("d", "b"))
    both = both.withColumn("rank", rank).filter(F.col("rank") <= LONGEST)
    every = both.groupBy("a").agg(F.array_sort(F.collect_list(F.struct("d", "b"))).alias("near"))
    every = every.join(sizes, "a", "left") if sizes is not None else every.withColumn("k", F.lit(LIST))
    return every.select("a", F.coalesce("k", F.lit(LIST)).alias("k"), F.slice("near", 1, F.coalesce("k", F.lit(LIST))).alias("near"))


def _join_round(lists: DataFrame, points: DataFrame) -> DataFrame:
    """Neighbours of neighbours: all that share a list are compared, each offers its nearest."""
    known = lists.select(F.col("a").alias("v"), F.explode(F.array_append("near.b", F.col("a"))).alias("id"))
    members = known.join(points.select("id", "s1", "s2"), "id").groupBy("v").agg(F.collect_list(F.struct("id", "s1", "s2")).alias("m"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.column(0)
            flat, cuts = m.flatten(), np.concatenate([[0], np.cumsum(m.value_lengths().to_numpy())])
            ids, s1, s2 = (np.asarray(flat.field(k)) for k in range(3))
            parts = []
            for a, b in zip(cuts[:-1], cuts[1:]):
                s = slice(a, b)
                parts.append(_nearest(ids[s], _distance(s1[s], s2[s], s1[s], s2[s]), max(LIST // 2, (b - a) // 4)))
            yield _links(parts)

    return members.select("m").mapInArrow(compare, "a bigint, b bigint, d int")


def _measured(links: DataFrame, points: DataFrame, threshold: float, width: int) -> DataFrame:
    """Links whose cosine, in double precision, reaches the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cos = (_matrix(batch.column(2), width) * _matrix(batch.column(3), width)).sum(axis=1)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(cos >= threshold))

    pairs = links.filter(F.col("d") <= NEAR).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    x = points.select(F.col("id"), F.col("x"))
    pairs = pairs.join(x.select(F.col("id").alias("a"), F.col("x").alias("xa")), "a").join(x.select(F.col("id").alias("b"), F.col("x").alias("xb")), "b")
    return pairs.select("a", "b", "xa", "xb").mapInArrow(run, "a bigint, b bigint")


def _counted(members: DataFrame, threshold: float, width: int) -> DataFrame:
    """``id``, ``links``: rows linked with each member of a component (``component``, ``id``, ``n``, ``x``), itself left out.

    Here the lists of saturated vectors grow to their whole component, without
    listing a pair: its members are dealt into parts, pairs of parts are measured
    and only counted.
    """
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    part = max(256, PART_BYTES // (8 * width))
    m = members.join(sizes, "component").withColumn("parts", F.ceil(F.col("size") / part).cast("int"))
    mine = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    meets = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: F.struct(
        F.least(p, mine).alias("p"), F.greatest(p, mine).alias("q"), mine.alias("part")))
    m = m.select("component", "id", "n", "x", F.explode(meets).alias("e")).select("component", "e.p", "e.q", "e.part", "id", "n", "x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def out(t: pa.Table) -> pa.RecordBatch:
            c, p, q, part, ids, n = (t.column(k).to_numpy() for k in ("component", "p", "q", "part", "id", "n"))
            x = _matrix(t.column("x"), width)
            total = np.zeros(len(ids), np.int64)
            cuts = np.flatnonzero((c[1:] != c[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1])) + 1
            for a, b in zip(np.append(0, cuts), np.append(cuts, len(ids))):
                left, right = a + np.flatnonzero(part[a:b] == p[a]), a + np.flatnonzero(part[a:b] == q[a])
                for i in range(0, len(left), 1024):
                    some = left[i:i + 1024]
                    near = x[some] @ x[right].T >= threshold
                    near &= ids[some][:, None] != ids[right][None]
                    total[some] += near @ n[right]
                    if p[a] != q[a]:
                        total[right] += n[some] @ near
            return pa.RecordBatch.from_pydict({"id": pa.array(ids, pa.int64()), "links": pa.array(total, pa.int64())})

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= 1 << 13:  # whole groups go out, the last may go on
                t = pa.Table.from_batches(held).combine_chunks()
                keys = [t.column(k).to_numpy() for k in ("component", "p", "q")]
                last = np.logical_and.reduce([k == k[-1] for k in keys])
                cut = int(np.flatnonzero(last)[0])
                if cut:
                    yield out(t.slice(0, cut))
                    held = t.slice(cut).to_batches()
        if held:
            yield out(pa.Table.from_batches(held))

    m = m.repartition("component", "p", "q").sortWithinPartitions("component", "p", "q")
    return m.mapInArrow(run, "id bigint, links bigint").groupBy("id").agg(F.sum("links").alias("links"))


def _audit(points: DataFrame, found: DataFrame, threshold: float, width: int) -> float:
    """Share of the true links that were found, over a sample of vectors compared with all by brute force."""
    sample = points.orderBy(F.xxhash64("id"), "id").limit(AUDIT).join(found, "id", "left").select("id", "x", F.coalesce("links", F.lit(0)).alias("links")).collect()
    if not sample:
        return 1.0
    ids, queries = np.array([r["id"] for r in sample]), np.frombuffer(b"".join(bytes(r["x"]) for r in sample), np.float64).reshape(-1, width)
    shared = points.sparkSession.sparkContext.broadcast((ids, queries))  # AUDIT vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, q = shared.value
        total = np.zeros(len(own), np.int64)
        for batch in batches:
            if batch.num_rows:
                near = q @ _matrix(batch.column(1), width).T >= threshold
                near &= own[:, None] != batch.column(0).to_numpy()[None]
                total += near @ batch.column(2).to_numpy()
        yield pa.RecordBatch.from_pydict({"id": pa.array(own, pa.int64()), "links": pa.array(total, pa.int64())})

    true = {r["id"]: r["links"] for r in points.select("id", "x", "n").mapInArrow(run, "id bigint, links bigint").groupBy("id").agg(F.sum("links").alias("links")).collect()}
    all_links = sum(true.values())
    return sum(min(r["links"], true[r["id"]]) for r in sample) / all_links if all_links else 1.0


BALLS = "ball bigint, label bigint, centre binary, radius double, component binary, x binary"


def _balls(full: DataFrame, width: int) -> DataFrame:
    """Vectors with full lists (``component``, ``x``) in balls of ``BALL`` that lie together, of one component if it has as many.

    ``label`` is the component of all members, null if they differ.
    """
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = _planes(width, 24, 99)
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(_bits(_matrix(batch.column(1), width) @ planes > 0))], names=["component", "x", "code"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number = pa.table({"component": pa.array([], pa.int64()), "x": pa.array([], pa.binary())}), TaskContext.get().partitionId() << 32

        def ball(t: pa.Table) -> pa.RecordBatch:
            nonlocal number
            component, x = t.column("component").to_numpy(), _matrix(t.column("x"), width)
            centre = x.mean(axis=0)
            centre /= np.sqrt(centre @ centre) or 1.0
            radius = float(np.arccos(np.clip(x @ centre, -1, 1)).max())
            number += 1
            return pa.RecordBatch.from_pydict({
                "ball": pa.array([number], pa.int64()), "label": pa.array([int(component[0]) if (component == component[0]).all() else None], pa.int64()),
                "centre": pa.array([centre.tobytes()], pa.binary()), "radius": pa.array([radius]),
                "component": pa.array([component.astype(np.int64).tobytes()], pa.binary()), "x": pa.array([x.tobytes()], pa.binary())})

        for batch in batches:
            held = pa.concat_tables([held, pa.Table.from_batches([batch.select(["component", "x"])])])
            while held.num_rows >= 2 * BALL:
                c = held.column("component").to_numpy()[:BALL]
                change = np.flatnonzero(c[1:] != c[:-1]) + 1  # a ball ends with its component if half of it is full
                cut = int(change[change >= BALL // 2][-1]) if (change >= BALL // 2).any() else BALL
                yield ball(held.slice(0, cut))
                held = held.slice(cut)
        for i in range(0, held.num_rows, BALL):
            yield ball(held.slice(i, BALL))

    order = ["component", "code"]
    coded = full.select("component", "x").mapInArrow(code, "component bigint, x binary, code bigint")
    return coded.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pack, BALLS)


def _ball_pairs(balls: DataFrame, width: int, threshold: float) -> DataFrame:
    """``p``, ``q``, ``gap``: pairs of balls that may hold a link across components, by centres and radii.

    The centres are sent round ``CENTRES`` at a time.
    """
    slim = balls.select("ball", "label", "centre", "radius")
    numbers = sorted(r["ball"] for r in slim.select("ball").collect())  # a ball stands for BALL vectors with full lists
    angle = float(np.arccos(threshold))

    def against(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ball, label, centre, radius = shared.value
            for batch in batches:
                if batch.num_rows:
                    own = pc.fill_null(batch.column(1), -1).to_numpy(zero_copy_only=False)
                    between = np.arccos(np.clip(_matrix(batch.column(2), width) @ centre.T, -1, 1))
                    gap = between - batch.column(3).to_numpy()[:, None] - radius[None]
                    apart = (own[:, None] != label) | (own[:, None] < 0)
                    i, j = np.nonzero((gap <= angle + 1e-6) & (batch.column(0).to_numpy()[:, None] <= ball) & apart)
                    yield pa.RecordBatch.from_pydict({"p": batch.column(0).take(pa.array(i)), "q": pa.array(ball[j]), "gap": pa.array(gap[i, j])})
        return run

    out = balls.sparkSession.createDataFrame([], "p bigint, q bigint, gap double")
    for k in range(0, len(numbers), CENTRES):
        t = slim.filter(F.col("ball").between(numbers[k], numbers[min(k + CENTRES, len(numbers)) - 1])).toArrow()
        label = pc.fill_null(t.column("label"), -1).to_numpy()
        shared = balls.sparkSession.sparkContext.broadcast((t.column("ball").to_numpy(), label, _matrix(t.column("centre"), width), t.column("radius").to_numpy()))
        out = out.unionByName(slim.mapInArrow(against(shared), "p bigint, q bigint, gap double"))
    return out


def _across(pairs: DataFrame, balls: DataFrame, width: int, threshold: float) -> DataFrame:
    """Components ``a``, ``b`` linked by members of the two balls of a pair, each once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                a, b = (np.frombuffer(r[k], np.int64) for k in ("cp", "cq"))
                x, y = (np.frombuffer(r[k], np.float64).reshape(-1, width) for k in ("xp", "xq"))
                i, j = np.nonzero((x @ y.T >= threshold) & (a[:, None] != b))
                found = np.unique(np.stack([np.minimum(a[i], b[j]), np.maximum(a[i], b[j])], axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    side = lambda k: balls.select(F.col("ball").alias(k), F.col("component").alias(f"c{k}"), F.col("x").alias(f"x{k}"))
    rows = pairs.select("p", "q").join(side("p"), "p").join(side("q"), "q").select("cp", "cq", "xp", "xq").repartition(min(10_000, max(1, pairs.count())))  # a row is a megabyte
    return rows.mapInArrow(run, "a bigint, b bigint").distinct()


def _united(full: DataFrame, groups: DataFrame, width: int, threshold: float) -> DataFrame:
    """``groups`` (``id``, ``component``) with the components united that vectors with full lists link.

    Two crowds whose members know only their own may be linked where no list
    tells. The vectors with full lists (``id``, ``x``) are put in balls; pairs of
    balls that centres and radii cannot rule out are measured, the closest of
    each pair of components first, until none is left between two of them.
    Members of one component are compared when its links are counted.
    """
    everyone = full.join(groups, "id", "left").select("id", F.coalesce("component", "id").alias("component"), "x")
    balls = stored(_balls(everyone, width), "balls")
    left, links, take = stored(_ball_pairs(balls, width, threshold), "ball_pairs"), None, 4
    labels = balls.select(F.col("ball"), "label")
    while not left.isEmpty():
        a, b = (labels.select(F.col("ball").alias(k), F.col("label").alias(f"l{k}")) for k in ("p", "q"))
        named = left.join(a, "p").join(b, "q").filter("lp is null or lq is null or lp <> lq")
        mixed = F.col("lp").isNull() | F.col("lq").isNull()
        near = Window.partitionBy(F.least("lp", "lq"), F.greatest("lp", "lq"), F.when(mixed, F.struct("p", "q"))).orderBy("gap", "p", "q")
        ranked = stored(named.withColumn("rank", F.row_number().over(near)).select("p", "q", "gap", "rank"), "ranked_pairs")
        new = _across(ranked.filter(F.col("rank") <= take), balls, width, threshold)
        links = stored(new if links is None else links.unionByName(new), "crossings")
        left, take = ranked.filter(F.col("rank") > take).select("p", "q", "gap"), take * 8
        root = components(links).select(F.col("node").alias("label"), "component")
        labels = stored(balls.select("ball", "label").join(root, "label", "left").select("ball", F.coalesce("component", "label").alias("label")), "ball_labels")
    if links is None:
        return groups
    root = components(links).select(F.col("node").alias("component"), F.col("component").alias("root"))
    alone = everyone.select("id", "component").join(groups.select("id"), "id", "left_anti").join(root.select("component"), "component", "left_semi")
    every = groups.select("id", "component").unionByName(alone.select("id", "component")).join(root, "component", "left")
    return every.select("id", F.coalesce("root", "component").alias("component"))


def _of_width(classes: DataFrame, width: int, threshold: float) -> DataFrame:
    """``id``, ``links``, ``component`` for the distinct vectors of one width that have a link."""
    points = stored(_sketched(classes.filter(F.size("vec") == width), width), "sketches")
    count, lists = points.count(), None
    for attempt in range(PASSES):
        links = _seeds(points, width, count, attempt)
        if lists is not None:
            links = links.unionByName(lists.select("a", F.explode("near").alias("e")).select("a", "e.b", "e.d"))
        lists, before = stored(_lists(links, lists.select("a", "k") if lists is not None else None), "lists"), None
        for _ in range(ROUNDS):
            full = (F.size("near") == F.col("k")) & (F.element_at("near", -1)["d"] <= NEAR) & (F.col("k") < LONGEST)
            sizes = lists.select("a", F.when(full, F.col("k") * 2).otherwise(F.col("k")).alias("k"))
            old = lists.select("a", F.explode("near").alias("e")).select("a", "e.b", "e.d")
            last, lists = lists, stored(_lists(old.unionByName(_join_round(lists, points)), sizes), "lists")
            discard(last)
            # settled once next to no list gets nearer or larger
            now = lists.agg(F.sum(F.aggregate("near", F.lit(0), lambda s, e: s + (128 - e["d"])))).first()[0] or 0
            if before is not None and now <= before * 1.005:
                break
            before = now
        near = lists.select("a", F.explode("near").alias("e")).select("a", "e.b", "e.d")
        groups = components(_measured(near, points, threshold, width)).withColumnRenamed("node", "id")
        crowded = lists.filter((F.size("near") >= LONGEST) & (F.element_at("near", -1)["d"] <= CROWDED)).select(F.col("a").alias("id"))
        if not crowded.isEmpty():
            groups = stored(_united(points.select("id", "x").join(crowded, "id"), stored(groups, "groups"), width, threshold), "groups")
        members = points.select("id", "n", "x").join(groups, "id")
        found = stored(_counted(members, threshold, width).join(groups, "id"), "links")
        recall = _audit(points, found.select("id", "links"), threshold, width)
        if recall >= WANTED:
            break
    if recall < LEAST:
        raise RuntimeError(f"audited recall of embedding links is {recall:.3f}")
    return found


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, vec_id: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` for every row of ``vectors``.

    Rows are linked if the cosine of their vectors, in double precision, is
    ``threshold`` or more; ``n_links`` counts the other rows linked directly,
    ``component_id`` is the smallest id reachable, ``kept`` tells whether that is
    the row's own.

    Equal vectors become one class with a count first. NN-descent runs on
    128-bit sign sketches: random-projection orders seed neighbour lists, joins
    of neighbours' neighbours refine them, and lists whose last neighbour is
    still near are enlarged. Near pairs are measured exactly; the links found
    give components, within which all pairs are measured in blocks and counted,
    so no link inside a component is missed and no pair is listed. Where lists
    are full at their longest, the components are united exactly, by balls of
    vectors (:func:`_united`). A sample of vectors is compared with all rows;
    while its recall is below ``WANTED``, up to ``PASSES`` times, new projection
    orders are added; a recall below ``LEAST`` in the end is an error.

    Null, empty and zero vectors and those with null or non-finite components
    link with nothing, as do rows without an id and vectors of different width.
    Rows of one id stay separate rows. An empty table gives an empty one.
    """
    vectors = vectors.select(F.col(vec_id).cast("bigint").alias(vec_id), vec)
    classes = stored(_classes(vectors, vec_id, vec), "vector_classes")
    spark = vectors.sparkSession
    found = spark.createDataFrame([], "id bigint, links bigint, component bigint")
    for r in classes.select(F.size("vec").alias("width")).distinct().orderBy("width").collect():  # widths in use
        found = found.unionByName(_of_width(classes, r["width"], threshold).select("id", "links", "component"))
    known = classes.join(found, "id", "left").select(
        "vec", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    rows = vectors.join(known.withColumnRenamed("vec", "k_vec"), (F.col(vec) == F.col("k_vec")) & F.col(vec_id).isNotNull(), "left")
    component = F.coalesce("component_id", F.col(vec_id))
    return rows.select(
        vec_id, F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.coalesce(component == F.col(vec_id), F.lit(False)).alias("kept"))

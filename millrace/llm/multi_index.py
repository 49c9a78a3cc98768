"""Near-duplicate vectors by an inverted multi-index.

Each half of the vectors has a codebook of its own; the product of the two is a
grid of cells, and every vector lies in the cell of its nearest words.  A
vector visits the cells nearest to it, in the order of the sum of its halves'
squared distances: that is the multi-sequence order, in which the first ``t``
cells can only be pairs of ranks with ``(i + 1) * (j + 1) <= t``.  How many are
visited is found on a bounded sample: vectors are turned by exactly the largest
angle that still links, in random directions, and visits go on until the
target share of them is met from one side or the other.  What meets is then
verified, so every link is one.

* Only vectors with the same label, not null, can meet.
* Equal vectors are one class and take part once, counted as often as they are
  there.  (Equal by two 64-bit hashes of label and entries.)
* Vectors of a cell that lie within half the largest angle of a common centre
  are all linked with each other; they make a ball and take part as one, with
  the cells that any of them visits.  Two balls are settled by their centres
  and radii where these leave no doubt.  Only the others' members are compared,
  each first with the other ball's centre.  So a large group of close copies
  takes a few comparisons of balls, whatever its size; a group whose members
  are about as far apart as a link reaches takes as many as it has pairs.
* Cells are cut into ranges anywhere, so a hot one is spread over many tasks
  and holds several balls.
* Pairs of balls are narrowed down by 128 signs of random projections before
  their centres are fetched, with so much room that one in 10 ** 5 is lost.

The number of words follows the number of classes, up to a documented most.
Codebooks and the number of visits come from the sample; every vector is
indexed and asks.

Vectors that are null, empty, zero or hold a null or non-finite entry, and
those without label, link with nothing and are their own components.  Vectors
of different lengths do not link.  Rows that repeat count each.  A component is
named by its least ``vec_id`` that is not null.  Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import by_batch, stored
from millrace.llm.graph import components

_PORTION = 2048
_CHUNK = 4096  # rows of a cell that are put into balls together
_SAFE = 1e-7  # of an angle: far above what rounding does
_ROOM = 4.5  # standard deviations of the signs' difference
_SIGNS = 128


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with that of ``b``; the same either way round."""
    lengths = np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b))
    return np.einsum("ij,ij->i", a, b) / lengths


def _rows_of(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


class Grid:
    """Two codebooks and how many cells a vector visits."""

    def __init__(self, books: tuple[np.ndarray, np.ndarray], visits: int, signs: np.ndarray):
        self.books, self.visits, self.signs = books, visits, signs
        self.words = len(books[0])

    def distances(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances of both halves to their words, less the halves' own lengths."""
        half = self.books[0].shape[1]
        parts = unit[:, :half], unit[:, half:]
        return tuple((book**2).sum(axis=1)[None] - 2 * part @ book.T for part, book in zip(parts, self.books, strict=True))

    def nearest(self, unit: np.ndarray, visits: int | None = None) -> np.ndarray:
        """The cells that each vector visits, nearest first; the first one is its own."""
        visits = min(visits or self.visits, self.words**2)
        deep = min(visits, self.words)
        ranks = np.array([(i, j) for i in range(deep) for j in range(min(deep, visits // (i + 1)))])
        return np.concatenate([self._nearest(unit[k : k + _PORTION], ranks, visits) for k in range(0, len(unit), _PORTION)])

    def _nearest(self, unit: np.ndarray, ranks: np.ndarray, visits: int) -> np.ndarray:
        deep = ranks.max() + 1
        both = self.distances(unit)
        by = [np.argsort(x, axis=1, kind="stable")[:, :deep] for x in both]
        near = [np.take_along_axis(x, order, axis=1) for x, order in zip(both, by, strict=True)]
        sums = near[0][:, ranks[:, 0]] + near[1][:, ranks[:, 1]]
        best = np.argsort(sums, axis=1, kind="stable")[:, :visits]
        first, second = (np.take_along_axis(order, ranks[:, side][best], axis=1) for side, order in enumerate(by))
        return first * self.words + second

    def sketch(self, unit: np.ndarray) -> np.ndarray:
        """Signs of random projections, as two numbers of 64 bits."""
        bits = np.packbits(unit @ self.signs > 0, axis=1, bitorder="little")
        return bits.view(np.int64)


def _words(rows: np.ndarray, count: int, rng: np.random.Generator, turns: int = 8) -> np.ndarray:
    """A codebook by k-means."""
    book = rows[rng.permutation(len(rows))[:count]].copy()
    for _ in range(turns):
        own = ((book**2).sum(axis=1)[None] - 2 * rows @ book.T).argmin(axis=1)
        held = np.bincount(own, minlength=count)
        sums = np.zeros_like(book)
        np.add.at(sums, own, rows)
        book[held > 0] = sums[held > 0] / held[held > 0, None]
    return book


def learn_grid(unit: np.ndarray, classes: int, angle: float, target: float = 0.99, most_words: int = 1024, cell: int = 16, seed: int = 7) -> Grid:
    """A grid from a sample of unit vectors, for so many classes in all.

    About ``cell`` classes lie in a cell, unless that took more than
    ``most_words`` words.  ``visits`` reaches ``target`` of the sample's
    vectors, each turned by ``angle``.
    """
    rng = np.random.default_rng(seed)
    half = max(1, unit.shape[1] // 2)
    words = 1
    while words < most_words and words**2 * cell < classes and words * 2 <= len(unit):
        words *= 2
    signs = rng.normal(size=(unit.shape[1], _SIGNS))
    grid = Grid((_words(unit[:, :half], words, rng), _words(unit[:, half:], words, rng)), 1, signs)
    some = unit[rng.permutation(len(unit))[:2000]]
    away = rng.normal(size=some.shape)
    away -= np.einsum("ij,ij->i", away, some)[:, None] * some
    length = np.sqrt(np.einsum("ij,ij->i", away, away))
    turned = np.where(length[:, None] > 0, math.cos(angle) * some + math.sin(angle) * away / np.maximum(length, 1e-300)[:, None], some)

    def rank(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many cells ``a`` visits until that of ``b``."""
        (first, second), own = grid.distances(a), grid.nearest(b, 1)[:, 0]
        out = np.zeros(len(a), np.int64)
        for i in range(len(a)):
            one, two = first[i], np.sort(second[i])
            limit = one[own[i] // words] + second[i][own[i] % words]
            out[i] = np.searchsorted(two, limit - one, "left").sum() + 1
        return out

    needed = np.sort(np.minimum(rank(some, turned), rank(turned, some)))
    grid.visits = int(needed[min(len(needed) - 1, math.ceil(target * len(needed)))])
    return grid


def _balls(unit: np.ndarray, reach: float) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """The balls of several of some vectors: members, centre and radius of each.

    The next vector that is free takes all free ones within reach; their mean
    is the centre, and what lies within reach of that is the ball.
    """
    near = math.cos(reach)
    # Most vectors are near no other one.
    close = np.zeros(len(unit), np.int64)
    for start in range(0, len(unit), 1024):
        close[start : start + 1024] = ((unit[start : start + 1024] @ unit.T) >= near).sum(axis=1)
    free = np.flatnonzero(close > 1)
    while len(free):
        taken = unit[free] @ unit[free[0]] >= near
        taken[0] = True
        centre = unit[free[taken]].sum(axis=0)[None]
        centre = _unit(centre)[0] if centre.any() else unit[free[0]]
        taken = unit[free] @ centre >= near
        if taken[0] and taken.sum() > 1:
            inside = free[taken]
            yield inside, centre, float(np.arccos(np.clip(unit[inside] @ centre, -1, 1)).max()) + _SAFE
        else:  # the mean lies elsewhere: the first one stays alone
            taken[:] = False
            taken[0] = True
        free = free[~taken]


_BALLS = "class long, n long, label long, v array<double>, ball long, cell int, visits array<int>, centre array<double>, radius double, members long, weight long, s0 long, s1 long"


def _condensed(classes: DataFrame, grid: Grid, reach: float) -> DataFrame:
    """The classes, each with its ball; a ball's first member has the ball's figures."""
    shared = classes.sparkSession.sparkContext.broadcast(grid)

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        cells = shared.value.nearest(_unit(_rows_of(batch.column(3))), 1)[:, 0]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells.astype(np.int32))], ["class", "n", "label", "v", "cell"])

    def condense(table: pa.Table, cuts: list[int]) -> pa.RecordBatch:
        """Rows of some cells and labels, which end at the cuts."""
        unit = _unit(_rows_of(table.column("v")))
        names, n = table.column("class").to_numpy(), table.column("n").to_numpy()
        first = np.arange(len(unit))  # of a row's ball
        centres, radius = unit.copy(), np.zeros(len(unit))
        members, weight = np.ones(len(unit), np.int64), n.copy()
        visits = shared.value.nearest(unit).astype(np.int32)
        cells: list[np.ndarray] = list(visits)
        for start, end in zip(cuts, cuts[1:], strict=False):
            if end - start > 1:
                for inside, centre, wide in _balls(unit[start:end], reach):
                    inside = inside + start
                    head = inside[0]
                    first[inside], centres[head], radius[head] = head, centre, wide
                    members[head], weight[head] = len(inside), n[inside].sum()
                    cells[head] = np.unique(visits[inside])
        # A ball's figures stand in the row of its first member.
        rest = first != np.arange(len(unit))
        sketch = shared.value.sketch(centres)
        columns = [
            *(table.column(c).combine_chunks() for c in ("class", "n", "label", "v")),
            pa.array(names[first]),
            table.column("cell").combine_chunks(),
            pa.array([None if r else c for r, c in zip(rest.tolist(), cells, strict=True)], pa.list_(pa.int32())),
            pa.array([None if r else c for r, c in zip(rest.tolist(), centres, strict=True)], pa.list_(pa.float64())),
            *(pa.array(x, mask=rest) for x in (radius, members, weight, sketch[:, 0].copy(), sketch[:, 1].copy())),
        ]
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _BALLS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted rows, cut where a cell ends or a chunk is full."""
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            cell, label = table.column("cell").to_numpy(), table.column("label").to_numpy()
            new = np.flatnonzero((cell[1:] != cell[:-1]) | (label[1:] != label[:-1])) + 1
            cuts = [0]
            for edge in [*new.tolist(), len(cell)]:
                while edge - cuts[-1] > _CHUNK:
                    cuts.append(cuts[-1] + _CHUNK)
                if edge < len(cell) and edge > cuts[-1]:
                    cuts.append(edge)
            if cuts[-1]:
                yield condense(table.slice(0, cuts[-1]), cuts)
            held = table.slice(cuts[-1])
        if held is not None and held.num_rows:
            yield condense(held, [0, held.num_rows])

    placed = classes.mapInArrow(lambda batches: (place(b) for b in batches if b.num_rows), "class long, n long, label long, v array<double>, cell int")
    ordered = stored(placed).repartitionByRange("label", "cell", "class").sortWithinPartitions("label", "cell", "class")
    return stored(ordered.mapInArrow(run, _BALLS))


def _met(balls: DataFrame, angle: float) -> DataFrame:
    """Pairs of balls of which one visits the other's cell, as far as signs allow them to link."""
    asks = balls.select("label", F.explode("visits").alias("cell"), *(F.col(c).alias(f"my_{c}") for c in ("ball", "radius", "s0", "s1")))
    held = balls.select("label", "cell", "ball", "radius", "s0", "s1")
    apart = F.bit_count(F.col("s0").bitwiseXOR(F.col("my_s0"))) + F.bit_count(F.col("s1").bitwiseXOR(F.col("my_s1")))
    share = F.least(F.lit(0.5), (F.lit(angle) + F.col("radius") + F.col("my_radius")) / math.pi)
    room = share * _SIGNS + _ROOM * F.sqrt(share * (1 - share) * _SIGNS) + 1
    found = asks.join(held, ["label", "cell"]).where((F.col("ball") != F.col("my_ball")) & (apart <= room))
    return found.select(F.greatest("ball", "my_ball").alias("a"), F.least("ball", "my_ball").alias("b")).distinct()


def _beside(pairs: DataFrame, of: DataFrame, columns: list[str], a: str = "a", b: str = "b") -> DataFrame:
    """The pairs with these columns of both, as ``a_*`` and ``b_*``."""
    for side, key in (("a", a), ("b", b)):
        own = of.select(F.col("ball").alias(key), *(F.col(c).alias(f"{side}_{c}") for c in columns))
        pairs = pairs.join(own, key)
    return pairs


def _settled(pairs: DataFrame, balls: DataFrame, cosine: float) -> DataFrame:
    """The pairs that link or may: ``sure`` where all their members link."""
    angle = math.acos(cosine)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        t = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        cos = cosines(_rows_of(t["a_centre"]), _rows_of(t["b_centre"]))
        radii = t["a_radius"].to_numpy() + t["b_radius"].to_numpy()
        single = (t["a_members"].to_numpy() == 1) & (t["b_members"].to_numpy() == 1)
        between = np.arccos(np.clip(cos, -1, 1))
        possible = between - radii - _SAFE <= angle
        sure = between + radii + _SAFE <= angle
        sure &= ~single
        keep = pa.array(possible)
        return pa.RecordBatch.from_arrays([t["a"].filter(keep), t["b"].filter(keep), pa.array(sure).filter(keep)], ["a", "b", "sure"])

    both = _beside(pairs, balls, ["centre", "radius", "members"])
    return stored(by_batch(both, work, "a long, b long, sure boolean"))


def _compared(doubtful: DataFrame, members: DataFrame, balls: DataFrame, cosine: float) -> DataFrame:
    """``class, ball, other, links``: how many vectors of another ball a class links with,
    for pairs of balls that are neither surely linked nor surely apart."""
    angle = math.acos(cosine)
    both = doubtful.select("a", "b").unionByName(doubtful.select(F.col("b").alias("a"), F.col("a").alias("b")))
    mine = members.select(F.col("ball").alias("a"), "class", "v")
    theirs = balls.select(F.col("ball").alias("b"), "centre", "radius", "weight", "members")

    def by_centre(batch: pa.RecordBatch) -> pa.RecordBatch:
        t = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        between = np.arccos(np.clip(cosines(_rows_of(t["v"]), _rows_of(t["centre"])), -1, 1))
        radius = t["radius"].to_numpy()
        sure = (between + radius + _SAFE <= angle) & (t["members"].to_numpy() > 1)
        open_ = ~sure & (between - radius - _SAFE <= angle)
        keep = pa.array(sure | open_)
        # Not yet known where null.
        links = pa.array(t["weight"].to_numpy(), mask=open_)
        return pa.RecordBatch.from_arrays([t["class"].filter(keep), t["a"].filter(keep), t["b"].filter(keep), links.filter(keep)], ["class", "ball", "other", "links"])

    first = both.join(mine, "a").join(theirs, "b").select("class", "a", "b", "v", "centre", "radius", "weight", "members")
    first = stored(by_batch(first, by_centre, "class long, ball long, other long, links long"))

    def one_by_one(batch: pa.RecordBatch) -> pa.RecordBatch:
        t = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        keep = pa.array(cosines(_rows_of(t["v"]), _rows_of(t["their_v"])) >= cosine)
        return pa.RecordBatch.from_arrays([t[c].filter(keep) for c in ("class", "ball", "other", "their_n")], ["class", "ball", "other", "links"])

    own = members.select("class", "v")
    their = members.select(F.col("ball").alias("other"), F.col("v").alias("their_v"), F.col("n").alias("their_n"))
    open_ = first.where("links is null").select("class", "ball", "other").join(own, "class").join(their, "other")
    open_ = by_batch(open_.select("class", "ball", "other", "v", "their_v", "their_n"), one_by_one, "class long, ball long, other long, links long")
    return stored(first.where("links is not null").unionByName(open_).groupBy("class", "ball", "other").agg(F.sum("links").alias("links")))


def near_duplicates(vectors: DataFrame, cosine: float = 0.93, column: str = "embedding", label: str = "label", sample: int = 16_384, target: float = 0.99) -> DataFrame:
    """``vec_id, n_links, component_id`` for every row.

    Runs the jobs that store classes, balls, pairs and links.
    """
    if not 0 < cosine < 1:
        raise ValueError("the cosine of a link lies between 0 and 1")
    entries = F.col(column)
    real = lambda c: c.cast("double")
    fine = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(real(c)) & (F.abs(real(c)) < F.lit(math.inf)))
    usable = F.coalesce(F.col(label).isNotNull() & (F.size(entries) > 0) & fine & F.exists(entries, lambda c: c != 0), F.lit(False))
    kind: Column = F.xxhash64(F.col(label), F.size(entries))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(usable, kind).alias("label"),
        F.when(usable, F.transform(entries, real)).alias("v"),
        F.when(usable, F.xxhash64(F.col(label), entries)).alias("h0"),
        F.when(usable, F.xxhash64(F.lit(5), entries, F.col(label))).alias("h1"),
    )
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()))
    by = ["label", "h0", "h1"]
    classes = rows.where("v is not null").groupBy(*by).agg(F.min("row").alias("class"), F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"))
    classes = stored(classes)
    firsts = stored(rows.select("row", "v").join(classes.select(F.col("class").alias("row"), "n", "label"), "row").select(F.col("row").alias("class"), "n", "label", "v"))

    lengths = [r[0] for r in firsts.groupBy(F.size("v")).count().collect()]  # a few kinds of vectors
    angle = math.acos(cosine)
    linked, edges = None, None
    for d in sorted(lengths):
        own = firsts.where(F.size("v") == d)
        count = own.count()
        some = own.where(F.pmod(F.xxhash64("class", F.lit(3)), F.lit(max(1, count // sample))) == 0).select("v")
        grid = learn_grid(_unit(_rows_of(some.toArrow().column("v"))) if count else np.zeros((0, d)), count, angle, target)
        members = _condensed(own, grid, angle / 2 - _SAFE)
        balls = members.where("centre is not null").select("ball", "label", "cell", "visits", "centre", "radius", "members", "weight", "s0", "s1")
        pairs = _settled(stored(_met(balls, angle)), balls, cosine)
        found = _compared(pairs.where("not sure"), members.select("class", "n", "ball", "v"), balls, cosine)
        sure = pairs.where("sure").select("a", "b")
        # What all members of a ball link with: the rest of it and balls surely near.
        weights = balls.select("ball", "weight")
        outside = sure.unionByName(sure.select(F.col("b").alias("a"), F.col("a").alias("b"))).join(weights.withColumnRenamed("ball", "b"), "b")
        outside = outside.groupBy(F.col("a").alias("ball")).agg(F.sum("weight").alias("outside"))
        inside = members.select("class", "ball").join(weights, "ball").join(outside, "ball", "left")
        several = found.groupBy("class").agg(F.sum("links").alias("others"))
        each = inside.join(several, "class", "left").select(
            "class", "ball", (F.col("weight") - 1 + F.coalesce("outside", F.lit(0)) + F.coalesce("others", F.lit(0))).alias("n_links")
        )
        links = sure.unionByName(found.where("links > 0").select(F.col("ball").alias("a"), F.col("other").alias("b")).distinct())
        linked = each if linked is None else linked.unionByName(each)
        edges = links if edges is None else edges.unionByName(links)
    if linked is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))

    linked = stored(linked)
    of = components(edges).withColumnRenamed("node", "ball")
    each = linked.join(of, "ball", "left").select("class", "n_links", F.coalesce("component", "ball").alias("component"))
    each = stored(each.join(classes, "class"))
    names = each.groupBy("component").agg(F.min("least").alias("component_id"))
    each = each.join(names, "component").select(*by, "n_links", "component_id")
    single = rows.where("v is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return rows.where("v is not null").select("vec_id", *by).join(each, by).select("vec_id", "n_links", "component_id").unionByName(single)

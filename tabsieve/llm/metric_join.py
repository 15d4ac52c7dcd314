"""Exact near-duplicate join of vectors by pivots.

Vectors are scaled to length one, where cosine >= c means Euclidean distance
<= r = sqrt(2 - 2c).  Pivots (vectors of the table, spread by hash) cut the
space into cells: a vector's home is its nearest pivot p.  By the triangle
inequality a neighbour of v can only live in the cell of a pivot q with
d(v, q) - d(v, p) <= 2r, and, sharper, v's distance to the bisector of p and
q, (d(v, q)^2 - d(v, p)^2) / (2 d(p, q)), must be at most r.  Two vectors are
compared if each reaches the other's cell in this sense.

Where the table needs more cells than ``max_pivots``, each cell is cut again
into parts by pivots of its own members; a vector that reaches the cell reaches
those of its parts that the same rule allows.

No vector is copied for the comparison.  The vectors are written once to the
checkpoint folder, in the order of their cells, as blocks of ``block_rows``; a
task is given numbers of block pairs, reads the two blocks and compares their
cells pair by pair.  So disk grows with the vectors, a task holds two blocks,
and the pairs of blocks go to many tasks.  Cosines are taken in single
precision, and again in double precision where that could decide otherwise.
Equal vectors are one class before the join.  Of each pair of blocks only link
counts and a spanning forest leave the task.

How many cells a vector reaches depends on the data: with clusters wider apart
than 2r a vector stays in its cell; without them (vectors spread evenly over
many dimensions) any exact method has to compare most pairs, and time, not
disk, grows with the square of the vectors.
"""

from __future__ import annotations

import contextlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.ipc as ipc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from tabsieve.llm.arrow_tokens import _filesystem
from tabsieve.llm.common import connected_components, join_facts, prepare, segments
from tabsieve.session import shuffle_partitions

COSINE = 0.9
#: Vectors of a block at most, and their components: a task holds two blocks.
BLOCK_ROWS = 32_768
BLOCK_NUMBERS = 1 << 21
#: Blocks of a small table, about, so that its pairs go to several tasks.
LEAST_BLOCKS = 8
#: Vectors that a cell holds on average; sets the number of pivots.
CELL_ROWS = 4096
#: Pivots of a level at most.  Beyond their product, cells have more blocks.
MAX_PIVOTS = 1024
#: Rows of a first-level cell that one task cuts into its parts, about.
CUT_ROWS = 200_000
#: Tasks of the join at most; with more pairs of blocks a task has several.
MAX_TASKS = 4096
#: Rows compared with a cell at a time.
STRIP = 256
#: Pairs of cells of two blocks; with more, the blocks are compared as a whole.
CELL_PAIRS = 1024
#: Distances are compared with this much slack, links by the cosine itself.
SLACK = 1e-6


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of an array column in double precision; all of one length."""
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(n, -1) if n else np.zeros((0, 0))


def usable(vec) -> "F.Column":
    """Not null, not empty, not all zero, no null or non-finite component."""
    v = vec.cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0.0), F.lit(False))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.abs(x).max(axis=1, keepdims=True) / np.linalg.norm(
        x / np.abs(x).max(axis=1, keepdims=True), axis=1, keepdims=True)


def _home(pivots: np.ndarray):
    """Rows (cell, class_id, copies, vec): a vector's cell is its nearest pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                cell = (_unit(_matrix(part.column("vec"))) @ pivots.T).argmax(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell.astype(np.int64)), *(part.column(c) for c in ("class_id", "copies", "vec"))],
                    names=["cell", "class_id", "copies", "vec"])

    return run


def _parts(max_pivots: int):
    """Streams rows sorted by (cell, salt, place): a cell's own pivots (place from
    0), then its rows (place ``max_pivots``).  Yields the rows of :func:`_home`
    with the cell's part in the cell number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, held, pivots = None, [], None
        for (cell, salt, place), part in segments(batches, ["cell", "salt", "place"]):
            if (cell, salt) != unit:
                unit, held, pivots = (cell, salt), [], None
            if place < max_pivots:
                held.append(_unit(_matrix(part.column("vec"))))
                continue
            if pivots is None:
                pivots = np.concatenate(held)
            for at in range(0, part.num_rows, 1024):
                piece = part.slice(at, 1024)
                sub = (_unit(_matrix(piece.column("vec"))) @ pivots.T).argmax(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell * max_pivots + sub), *(piece.column(c) for c in ("class_id", "copies", "vec"))],
                    names=["cell", "class_id", "copies", "vec"])

    return run


def _placed_schema(df: DataFrame) -> str:
    return f"cell bigint, class_id bigint, copies bigint, vec {df.schema['vec'].dataType.simpleString()}"


def _cut_cells(placed: DataFrame, cell_rows: int, max_pivots: int) -> tuple[DataFrame, dict[int, np.ndarray]]:
    """Rows of :func:`_home`, each cell cut into parts by its own pivots: about
    one member in ``cell_rows``, at least one, at most ``max_pivots``.  The cell
    number is then ``cell * max_pivots + part``.  Also the pivots of each cell."""
    placed = placed.checkpoint()
    # one row a first-level cell
    sizes = placed.groupBy("cell").agg(F.count("*").alias("n")).checkpoint()
    wanted = F.least(F.lit(max_pivots), F.ceil(F.col("n") / cell_rows)).cast("bigint")
    order = F.struct(F.xxhash64("class_id", F.lit(7)), "class_id")
    members = placed.join(F.broadcast(sizes), "cell").select("cell", "class_id", "vec", "n", wanted.alias("wanted"), order.alias("h"))
    # four times the pivots wanted pass by hash, and the first of each cell always
    few = members.filter(F.pmod(F.xxhash64("class_id", F.lit(8)), F.col("n")) < 4 * F.col("wanted")).select("cell", "h", "wanted", "vec")
    first = members.groupBy("cell").agg(F.min(F.struct("h", "wanted", "vec")).alias("m")).select("cell", "m.*")
    pivots = (few.unionByName(first).dropDuplicates(["cell", "h"])
              .withColumn("place", F.row_number().over(Window.partitionBy("cell").orderBy("h")) - 1)
              .filter("place < wanted").select("cell", "place", "vec").checkpoint())
    salts = F.ceil(F.col("n") / CUT_ROWS).cast("int")
    empty = [F.lit(0).cast("bigint").alias(c) for c in ("class_id", "copies")]
    heads = pivots.join(F.broadcast(sizes), "cell").select(
        "cell", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), "place", *empty, "vec")
    rows = placed.join(F.broadcast(sizes), "cell").select(
        "cell", F.pmod(F.xxhash64("class_id", F.lit(9)), salts).cast("int").alias("salt"), F.lit(max_pivots).alias("place"),
        "class_id", "copies", "vec")
    units = (heads.unionByName(rows).repartition(max(shuffle_partitions(placed.sparkSession), max_pivots), "cell", "salt")
             .sortWithinPartitions("cell", "salt", "place"))
    cut = units.mapInArrow(_parts(max_pivots), _placed_schema(placed)).checkpoint()
    own: dict[int, list] = {}
    for r in pivots.orderBy("cell", "place").toLocalIterator():  # one vector in cell_rows
        own.setdefault(r["cell"], []).append(np.array(r["vec"], dtype=np.float64))
    return cut, {cell: _unit(np.stack(vs)) for cell, vs in own.items()}


class Reach:
    """Which cells a vector has to meet, given the pivots of the first level and,
    if cells are cut, those of each cell's parts."""

    def __init__(self, pivots: np.ndarray, parts: dict[int, np.ndarray] | None, max_pivots: int, radius: float):
        self.pivots, self.parts, self.radius = pivots, parts, radius
        self.step = max_pivots if parts is not None else 1

    def _near(self, sq: np.ndarray, home_sq: np.ndarray, gap: np.ndarray) -> np.ndarray:
        near = np.sqrt(sq) - np.sqrt(home_sq) <= 2 * self.radius + SLACK
        return near & (sq - home_sq <= 2 * gap * (self.radius + SLACK) + SLACK)

    def tops(self, unit: np.ndarray, home: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """(rows, cells): which first-level cells the rows of first-level cells
        ``home`` reach."""
        out = np.zeros((len(unit), len(cells)), dtype=bool)
        for at in range(0, len(unit), 1024):
            x, h = unit[at:at + 1024], self.pivots[home[at:at + 1024]]
            sq = np.maximum(0, 2 - 2 * x @ self.pivots[cells].T)
            home_sq = np.maximum(0, 2 - 2 * (x * h).sum(axis=1, keepdims=True))
            gap = np.sqrt(np.maximum(0, 2 - 2 * h @ self.pivots[cells].T))
            out[at:at + 1024] = self._near(sq, home_sq, gap) | (home[at:at + 1024, None] == cells)
        return out

    def cells(self, unit: np.ndarray, home: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """(rows, cells): which cells (parts, if cut) the rows reach."""
        tops, at = np.unique(cells // self.step, return_inverse=True)
        out = self.tops(unit, home // self.step, tops)[:, at]
        for k, top in enumerate(tops.tolist() if self.parts is not None else []):
            pivots, mine = self.parts[top], np.flatnonzero(at == k)
            gaps = np.sqrt(np.maximum(0, 2 - 2 * pivots @ pivots.T))
            wanted = cells[mine] % self.step
            for lo in range(0, len(unit), 1024):
                sq = np.maximum(0, 2 - 2 * unit[lo:lo + 1024] @ pivots.T)
                nearest = sq.argmin(axis=1)
                near = self._near(sq[:, wanted], sq.min(axis=1, keepdims=True), gaps[nearest][:, wanted])
                out[lo:lo + 1024, mine] &= near
        return out


def _plan_blocks(sizes: list[tuple[int, int]], block_rows: int) -> list[tuple[int, int, int]]:
    """(cell, first block, blocks) of cells with so many rows: small cells share a
    block, large ones have several."""
    plan, block, room = [], 0, block_rows
    for cell, n in sizes:
        if n > room and room < block_rows:
            block, room = block + 1, block_rows
        pieces = max(1, math.ceil(n / block_rows))
        plan.append((cell, block, pieces))
        if pieces > 1:
            block += pieces
        else:
            room -= n
    return plan


def _write_blocks(folder: str, reach: Reach):
    """Streams rows sorted by (block, cell) and writes a file a block.  Yields
    (block, name, held, reached): bits of the first-level cells that the block
    has rows of and that its rows reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(folder)
        every = np.arange(len(reach.pivots))

        def write(block: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
            name = f"{int(block)}-{uuid.uuid4().hex}.arrow"
            with fs.open_output_stream(f"{root}/{name}") as out, ipc.new_file(out, held[0].schema) as writer:
                for part in held:
                    writer.write_batch(part)
            has, reached = (np.zeros(len(every), dtype=bool) for _ in range(2))
            for part in held:
                for at in range(0, part.num_rows, 1024):
                    piece = part.slice(at, 1024)
                    home = piece.column("cell").to_numpy() // reach.step
                    has[home] = True
                    reached |= reach.tops(_unit(_matrix(piece.column("vec"))), home, every).any(axis=0)
            bits = [pa.array([np.packbits(b).tobytes()], pa.binary()) for b in (has, reached)]
            return pa.RecordBatch.from_arrays([pa.array([int(block)], pa.int64()), pa.array([name]), *bits],
                                              names=["block", "name", "held", "reached"])

        fs.create_dir(root, recursive=True)
        unit, held = None, []
        for (block,), part in segments(batches, ["block"]):
            if block != unit and held:
                yield write(unit, held)
                held = []
            unit = block
            held.append(part.select(["cell", "class_id", "copies", "vec"]))
        if held:
            yield write(unit, held)

    return run


class Block:
    """One block's vectors in memory, their cells side by side."""

    def __init__(self, fs, path: str):
        with fs.open_input_file(path) as f:
            table = ipc.open_file(f).read_all().combine_chunks()
        cell, self.ids, self.copies = (table.column(c).to_numpy() for c in ("cell", "class_id", "copies"))
        flat = table.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        self.x = flat.reshape(len(self.ids), -1)
        with np.errstate(over="ignore", under="ignore"):
            self.norm = np.linalg.norm(self.x.astype(np.float64), axis=1)
        self.unit = _unit(self.x.astype(np.float64))
        self.single = self.unit.astype(np.float32)
        #: the others are left to the formula itself
        self.plain = (self.norm > 1e-140) & (self.norm < 1e140)
        self.home = cell
        starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        self.cells, self.bounds = cell[starts], np.append(starts, len(cell))


def _linked(a: Block, ra: np.ndarray, b: Block, rb: np.ndarray, same: bool, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows out of ``ra`` and ``rb`` that link, strip by strip; with
    ``same`` both are the same rows and each pair comes once."""
    if not len(ra) or not len(rb):
        return
    width = a.x.shape[1]
    doubt = (width + 8) * 2.0 ** -22  # bounds the error of a cosine in single precision
    low, high, exact = np.float32(cosine - doubt), np.float32(cosine + doubt), max(1, BLOCK_NUMBERS // width)
    columns = np.ascontiguousarray(b.single[rb].T)
    for at in range(0, len(ra), STRIP):
        first = at if same else 0
        s = a.single[ra[at:at + STRIP]] @ columns[:, first:]
        where = np.flatnonzero((s >= low).ravel())
        if not len(where):
            continue
        value = s.ravel()[where]
        i, h = np.divmod(where, s.shape[1])
        i, h = i + at, h + first
        if same:
            once = i < h
            i, h, value = i[once], h[once], value[once]
        i, h = ra[i], rb[h]
        links = value > high
        links &= a.plain[i] & b.plain[h]
        unsure = np.flatnonzero(~links)
        for lo in range(0, len(unsure), exact):
            some = unsure[lo:lo + exact]
            x, y = a.x[i[some]].astype(np.float64), b.x[h[some]].astype(np.float64)
            with np.errstate(all="ignore"):
                links[some] = np.einsum("ij,ij->i", x, y) / (a.norm[i[some]] * b.norm[h[some]]) >= cosine
        if links.any():
            yield i[links], h[links]


def _join_rows(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join rows in a forest where each row knows its root, the smallest row."""
    while True:
        x, y = parent[a], parent[b]
        apart = np.flatnonzero(x != y)
        if not len(apart):
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := parent[parent], parent):
            parent[:] = up


def _meet(a: Block, b: Block, reach: Reach, cosine: float) -> pa.RecordBatch | None:
    """(class_id, links, root) of two blocks, or of one with itself: how many
    vectors the class links with, and a class of the same local component."""
    alone, n = a is b, len(a.ids)
    links = np.zeros(n if alone else n + len(b.ids), dtype=np.int64)
    copies = a.copies if alone else np.concatenate([a.copies, b.copies])
    parent, shift = np.arange(len(links)), 0 if alone else n
    near_a, near_b = reach.cells(a.unit, a.home, b.cells), reach.cells(b.unit, b.home, a.cells)

    def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if len(a.cells) * len(b.cells) > CELL_PAIRS:
            rows = [np.arange(len(x.ids)) if alone else np.flatnonzero(near.any(axis=1)) for x, near in ((a, near_a), (b, near_b))]
            yield from _linked(a, rows[0], b, rows[1], alone, cosine)
            return
        for p, cell in enumerate(a.cells):
            for q in range(p if alone else 0, len(b.cells)):
                ra, rb = np.arange(a.bounds[p], a.bounds[p + 1]), np.arange(b.bounds[q], b.bounds[q + 1])
                if cell != b.cells[q]:
                    ra, rb = ra[near_a[ra, q]], rb[near_b[rb, p]]
                yield from _linked(a, ra, b, rb, alone and p == q, cosine)

    for i, h in pairs():
        h = h + shift
        links += np.bincount(i, copies[h], len(links)).astype(np.int64) + np.bincount(h, copies[i], len(links)).astype(np.int64)
        # each row joins its first partner; few pairs are apart after that
        first = np.concatenate([[True], i[1:] != i[:-1]])
        _join_rows(parent, i[first], h[first])
        _join_rows(parent, i, h)
    some = np.flatnonzero(links > 0)
    if not len(some):
        return None
    ids = a.ids if alone else np.concatenate([a.ids, b.ids])
    return pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in (ids[some], links[some], ids[parent[some]])],
                                      names=["class_id", "links", "root"])


def _join_blocks(shared, folder: str, cosine: float):
    """Streams numbers of chunks of block pairs; yields the rows of :func:`_meet`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, pairs, per, reach = shared.value
        fs, root = _filesystem(folder)
        at, a = None, None
        for batch in batches:
            for chunk in batch.column("id").to_pylist():
                for i, j in pairs[chunk * per:(chunk + 1) * per].tolist():
                    if i != at:
                        at, a = i, Block(fs, f"{root}/{names[i]}")
                    found = _meet(a, a if i == j else Block(fs, f"{root}/{names[j]}"), reach, cosine)
                    if found is not None:
                        yield found

    return run


def choose_pivots(classes: DataFrame, n: int) -> np.ndarray:
    """Unit vectors of ``n`` classes with the smallest hashes."""
    got = classes.orderBy(F.xxhash64("vec"), "class_id").limit(n).select("vec").collect()
    return _unit(np.array([r["vec"] for r in got], dtype=np.float64))


def near_vectors(vectors: DataFrame, cosine: float = COSINE, cell_rows: int = CELL_ROWS,
                 block_rows: int = BLOCK_ROWS, max_pivots: int = MAX_PIVOTS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of (vec_id,
    embedding).

    Rows whose vector is null, empty, zero or holds a null or non-finite number
    have no links and are their own component.  Equal vectors are copies: they
    link with each other.  Vectors of different lengths never link.  Rows that
    share an id are rows of their own, linked through their vectors; a null id
    counts as a vector but names no component unless no other row does.  Other
    columns are not read."""
    folder = f"{prepare(vectors.sparkSession)}/vectors-{uuid.uuid4().hex}"
    given = vectors.schema["embedding"].dataType
    number = "float" if isinstance(given, ArrayType) and isinstance(given.elementType, FloatType) else "double"
    rows = vectors.select("vec_id", F.col("embedding").cast(f"array<{number}>").alias("vec"))
    sound = (rows.filter(usable(F.col("vec")))
             .select("vec_id", F.transform("vec", lambda x: (x + F.lit(0.0)).cast(number)).alias("vec")))  # -0.0 is 0.0
    # classes are numbered and written once; rows find theirs by 128 bits of hash
    key = F.struct(F.xxhash64("vec"), F.xxhash64(F.lit(2), "vec"))
    classes = (sound.groupBy("vec").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first_id"))
               .withColumns({"class_id": F.monotonically_increasing_id(), "key": key})).checkpoint()
    parts = []
    for size in [r["k"] for r in classes.select(F.size("vec").alias("k")).distinct().orderBy("k").collect()]:
        parts.append(_links(classes.filter(F.size("vec") == size), f"{folder}/{size}", cosine, cell_rows, block_rows, max_pivots))
    if not parts:
        return rows.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.lit(True).alias("kept"))
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    found = found.checkpoint()
    with contextlib.suppress(OSError):  # the blocks are read
        fs, root = _filesystem(folder)
        fs.delete_dir(root)
    links = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    component = connected_components(found.select(F.col("class_id").alias("a"), F.col("root").alias("b")))
    named = (classes.select("class_id", "key", "copies", "first_id")
             .join(links, "class_id", "left")
             .join(component.withColumnRenamed("node", "class_id"), "class_id", "left")
             .select("key", F.coalesce("component", "class_id").alias("component"), "first_id",
                     (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))).checkpoint()
    lowest = named.groupBy("component").agg(F.min("first_id").alias("component_id")).checkpoint()
    by_class = join_facts(named, lowest, "component").select("key", "n_links", "component_id").checkpoint()
    members = sound.select("vec_id", key.alias("key")).checkpoint()
    linked = join_facts(members, by_class, "key").select("vec_id", "n_links", "component_id")
    alone = rows.filter(~usable(F.col("vec"))).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _block_pairs(held: np.ndarray, reached: np.ndarray) -> np.ndarray:
    """Pairs (i, j), i <= j, of blocks of which each reaches a cell of the other."""
    out = []
    for i in range(len(held)):
        meet = (held[i:] & reached[i]).any(axis=1) & (reached[i:] & held[i]).any(axis=1)
        meet[0] = True
        j = i + np.flatnonzero(meet)
        out.append(np.stack([np.full(len(j), i), j], axis=1).astype(np.int32))
    return np.concatenate(out)


def _links(classes: DataFrame, folder: str, cosine: float, cell_rows: int, block_rows: int, max_pivots: int) -> DataFrame:
    """(class_id, links, root) over the cells of classes of one vector length.
    Reads the blocks in ``folder``, which it writes."""
    spark = classes.sparkSession
    n = classes.count()
    wanted, radius = max(1, math.ceil(n / cell_rows)), math.sqrt(max(0.0, 2 - 2 * cosine))
    pivots, own = choose_pivots(classes, min(max_pivots, wanted)), None
    placed = classes.select("class_id", "copies", "vec").mapInArrow(_home(pivots), _placed_schema(classes))
    if wanted > max_pivots:
        placed, own = _cut_cells(placed, cell_rows, max_pivots)
    reach = Reach(pivots, own, max_pivots, radius)
    rows = min(block_rows, max(1, BLOCK_NUMBERS // pivots.shape[1]), max(cell_rows, math.ceil(n / LEAST_BLOCKS)))
    # one row a cell
    sizes = [(r["cell"], r["n"]) for r in placed.groupBy("cell").agg(F.count("*").alias("n")).orderBy("cell").collect()]
    plan = _plan_blocks(sizes, rows)
    cells = spark.createDataFrame(plan, "cell bigint, first bigint, pieces int")
    dealt = (placed.join(F.broadcast(cells), "cell")
             .select((F.col("first") + F.pmod(F.xxhash64("class_id", F.lit(5)), F.col("pieces"))).alias("block"),
                     "cell", "class_id", "copies", "vec")
             .repartition(max(first + pieces for _, first, pieces in plan), "block").sortWithinPartitions("block", "cell"))
    written = dealt.mapInArrow(_write_blocks(folder, reach), "block bigint, name string, held binary, reached binary").collect()
    written.sort(key=lambda r: r["block"])
    held, reached = (np.stack([np.unpackbits(np.frombuffer(r[c], dtype=np.uint8), count=len(pivots)) for r in written]).astype(bool)
                     for c in ("held", "reached"))
    pairs = _block_pairs(held, reached)
    per = math.ceil(len(pairs) / MAX_TASKS)
    chunks = math.ceil(len(pairs) / per)
    shared = spark.sparkContext.broadcast(([r["name"] for r in written], pairs, per, reach))
    return spark.range(0, chunks, 1, chunks).mapInArrow(_join_blocks(shared, folder, cosine), "class_id bigint, links bigint, root bigint")

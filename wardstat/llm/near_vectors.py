"""Near-duplicate embeddings by a navigable small-world graph of centres.

Equal vectors of a label are one class. Some classes of a label are centres of
cells, and every class belongs to the cell of its nearest centre, found in the
graph of the centres. Cells that lie together make shards of at most about
``SHARD_ROWS`` classes, each in a file of the shared folder. A pair of shards is
one piece of work for one task: a class looks into the cells whose border is near
enough, and meets all their members. An audit compares some classes with all members
of the other shard, and beams are widened until it passes; the widest beam misses
no link between cells of nearest centres. Scores that count are cosines in doubles.

Links are added up inside a piece of work: a task hands on how many links each
class has and edges that span its components, never all pairs of a group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from wardstat.functions.names import column
from wardstat.llm.blocks import new_file, open_file, saved, trimmed
from wardstat.llm.graph import connected_components, with_least
from wardstat.llm.smallworld import Graph, held_by
from wardstat.llm.vectors import doubles, finite, matrix
from wardstat.session import scratch_path

SIMILARITY = 0.93
#: Classes in a shard, and bytes of their vectors in doubles.
SHARD_ROWS = 65_536
SHARD_BYTES = 64 << 20
#: Centres of a label for each square root of its classes, and classes for each centre that say how large its cell is.
CENTRES = 4
COUNTED = 16
#: Graphs of more centres get links and are walked.
WALKED = 65_536
#: Bytes of centres that a task holds.
HELD_BYTES = 64 << 20
#: The first beam and the widest, and how near to the threshold a score of floats is looked at in doubles, at least.
BEAM = 32
WHOLE = 128
SLACK = 1e-5
#: Queries that are audited for each pair of shards, and the part of their links that must have been found.
AUDITED = 256
RECALL = 0.999
QUERIES = 8192
#: Queries and members that are compared at once, and scores that are looked at in doubles at once.
ROWS, MEMBERS, DOUBLES = 2048, 1024, 1 << 16


def units(vectors):
    """Vectors of length one; entries are scaled first, so that none is lost to overflow."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def floats(vectors):
    """Vectors of length one as floats."""
    scaled = (vectors / np.abs(vectors).max(axis=1, keepdims=True)).astype(np.float32)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def reach(least, beam):
    """How near the border of a cell must be to a class that looks into it.

    Two vectors with a cosine of ``least`` lie at most ``sqrt(2 - 2 least)`` apart, so one of
    them lies within half of that of any border between them: the widest beam.
    """
    return float(np.sqrt(max(0, 2 - 2 * least) * min(1, beam / WHOLE))) / 2


class Shard:
    """Vectors by cells, the graph of the cells' centres, the number of each class and how many rows it has."""

    def __init__(self, centres, vectors, cell, node, rows):
        self.graph, self.vectors, self.cell, self.node, self.rows = Graph(centres), vectors, cell, node, rows
        self.points = floats(vectors)
        self.ends = np.searchsorted(cell, np.arange(len(centres) + 1))
        self.home = np.einsum("ij,ij->i", self.points, centres[cell])

    @classmethod
    def build(cls, vectors, node, rows, centres=None, cell=None):
        """Without centres and the cells of the classes, some of the classes are centres."""
        order = np.argsort(node, kind="stable")
        if centres is None:
            points = floats(vectors)
            some = np.random.default_rng(len(node)).permutation(order)[:centres_of(len(node))]
            centres = points[some]
            graph = Graph(centres)
            cell = np.concatenate([graph.nearest(points[at:at + QUERIES]) for at in range(0, len(points), QUERIES)])
        order = order[np.argsort(cell[order], kind="stable")]
        return cls(centres, vectors[order], cell[order], node[order], rows[order])

    def written(self, folder):
        path, out = new_file(folder, ".graph")
        out.write(self.graph.dumped(vectors=self.vectors, cell=self.cell, node=self.node, rows=self.rows))
        out.close()
        return path

    @classmethod
    def read(cls, path):
        with open_file(path) as file:
            graph, held = Graph.loaded(file.read())
        return cls(graph.points, **held)

    def __len__(self):
        return len(self.node)

    @property
    def unit(self):
        return units(self.vectors.astype(np.float64))

    def looks_into(self, other, least, beam):
        """A matrix that says which cells of the other shard each class looks into."""
        made = np.zeros((len(self), len(other.graph.points)), bool)
        apart = reach(least, beam) * np.sqrt(np.maximum(0, 2 - 2 * self.graph.points @ other.graph.points.T))
        for at in range(0, len(self), QUERIES):
            some = slice(at, at + QUERIES)
            row, cell = other.graph.near(self.points[some], self.home[some, None] - apart[self.cell[some]] - SLACK, beam)
            made[at + row, cell] = True
        return made

    def linked_to(self, some, other, members, least):
        """Which of some classes are linked to which of a slice of members of the other shard: places in both."""
        slack = max(SLACK, (self.points.shape[1] + 16) * 2.0 ** -23)
        scores = self.points[some] @ other.points[members].T
        row, member = held_by(scores >= least - slack)
        if len(row):
            unsure = np.flatnonzero(scores[row, member] < least + slack)
            sure = np.ones(len(row), bool)
            for at in range(0, len(unsure), DOUBLES):
                part = unsure[at:at + DOUBLES]
                one, two = (units(x.astype(np.float64)) for x in (
                    self.vectors[some[row[part]]], other.vectors[members.start + member[part]]))
                sure[part] = np.einsum("ij,ij->i", one, two) >= least
            if not sure.all():
                row, member = row[sure], member[sure]
        return row, member

    def true_links(self, some, other, least, same):
        """How many members of the other shard some classes are linked to, by all of them."""
        made = np.zeros(len(some), np.int64)
        for at in range(0, len(other), MEMBERS):
            made += np.bincount(self.linked_to(some, other, slice(at, at + MEMBERS), least)[0], minlength=len(some))
        return made - same


def centres_of(n):
    """How many of the classes of a label are centres."""
    return int(min(n, np.ceil(CENTRES * np.sqrt(n))))


def spanning(bits, back):
    """Edges from a row to rows, and to columns, that span each component of rows and columns."""
    rows, columns = [], []
    seen = np.zeros(len(bits), bool)
    met = np.zeros(len(back), bool)
    for start in np.flatnonzero(bits.any(axis=1)):
        if seen[start]:
            continue
        seen[start] = True
        edge = np.array([start])
        while len(edge):
            new = np.unpackbits(np.bitwise_or.reduce(bits[edge], axis=0), count=len(back)).astype(bool) & ~met
            met |= new
            columns += [(start, c) for c in np.flatnonzero(new)]
            if not new.any():
                break
            edge = np.unpackbits(np.bitwise_or.reduce(back[new], axis=0), count=len(bits)).astype(bool) & ~seen
            seen |= edge
            edge = np.flatnonzero(edge)
            rows += [(start, r) for r in edge]
    return (np.array(x, np.int64).reshape(-1, 2) for x in (rows, columns))


def hung(a, b, n):
    """Edges that hang every one of ``n`` nodes on the smallest node of its component."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        for ends in (root[a], root[b], a, b):
            np.minimum.at(root, ends, low)
        root = root[root]
        if (root == before).all():
            break
    some = np.flatnonzero(root != np.arange(n))
    return some, root[some]


class Found:
    """What is known of the links of two shards; classes of the second are numbered after those of the first."""

    def __init__(self, one, other, same):
        self.at = 0 if same else len(one)
        self.rows = one.rows if same else np.concatenate([one.rows, other.rows])
        self.links = np.zeros(len(self.rows), np.int64)
        self.classes = np.zeros(len(self.rows), np.int64)
        self.edges = [np.zeros((2, 0), np.int64)]

    def add(self, row, column, who, whom):
        """Add the links of some classes with others; ``who`` holds a class once."""
        self.links[who] += np.bincount(row, self.rows[whom][column], len(who)).astype(np.int64)
        self.classes[who] += np.bincount(row, minlength=len(who))

    def span(self, row, column, who, whom):
        """Edges for links between some classes and others, no more than there are classes if they have many links."""
        if len(row) <= 2 * (len(who) + len(whom)):
            self.edges.append(np.stack([who[row], whom[column]]))
        else:
            matrix = np.zeros((len(who), len(whom)), bool)
            matrix[row, column] = True
            rows, columns = spanning(np.packbits(matrix, axis=1), np.packbits(matrix.T, axis=1))
            self.edges += [np.stack([who[rows[:, 0]], who[rows[:, 1]]]), np.stack([who[columns[:, 0]], whom[columns[:, 1]]])]
        if sum(e.shape[1] for e in self.edges) > 8 * len(self.rows) + (1 << 20):
            self.hang()

    def hang(self):
        self.edges = [np.stack(hung(*np.concatenate(self.edges, axis=1), len(self.rows)))]
        return self.edges[0]

    def meet(self, one, other, shifts, least, looks, back, same):
        """Links of classes with the members of the cells that they look into; ``back`` says which pairs are met the other way.

        Inside a shard such a pair is met again; of two shards it has been met.
        """
        for cell, lookers in enumerate(np.ascontiguousarray(looks.T)):
            who = np.flatnonzero(lookers)
            if not len(who):
                continue
            for first in range(other.ends[cell], other.ends[cell + 1], MEMBERS):
                members = slice(first, min(first + MEMBERS, other.ends[cell + 1]))
                for at in range(0, len(who), ROWS):
                    self._block(one, who[at:at + ROWS], other, members, shifts, least, back, same)

    def _block(self, one, some, other, members, shifts, least, back, same):
        row, column = one.linked_to(some, other, members, least)
        if same:  # nothing is linked to itself
            two = some[row] != members.start + column
            row, column = row[two], column[two]
        if not len(row):
            return
        who, whom = some + shifts[0], np.arange(members.start, members.stop) + shifts[1]
        once = slice(None) if back is None else ~back[members.start + column, one.cell[some[row]]]
        self.add(column[once], row[once], whom, who)
        if not same:
            row, column = row[once], column[once]
        self.add(row, column, who, whom)
        self.span(row, column, who, whom)


def linked(one, other, least, same):
    """Edges, and for each member of both shards the rows that it is linked to, for the classes of two shards."""
    some = np.linspace(0, len(one) - 1, min(AUDITED, len(one))).astype(np.int64)
    beam, true = BEAM, None
    while True:
        found = Found(one, other, same)
        looks = one.looks_into(other, least, beam)
        if same:
            found.meet(one, one, (0, 0), least, looks, looks, True)
        else:
            found.meet(one, other, (0, found.at), least, looks, None, False)
            found.meet(other, one, (found.at, 0), least, other.looks_into(one, least, beam), looks, False)
        if beam >= WHOLE:
            break
        true = one.true_links(some, other, least, same) if true is None else true
        if found.classes[some].sum() >= RECALL * true.sum():
            break
        beam = min(2 * beam, WHOLE)
    node = one.node if same else np.concatenate([one.node, other.node])
    counts = [(one.node, found.links[:len(one)])]
    if not same:
        counts.append((other.node, found.links[found.at:]))
    return node[found.hang()].T, counts


class Plan:
    """The centres of a label, as a graph, and the shards of their cells: the first, and over how many a large one is dealt."""

    def __init__(self, graph, first, parts):
        self.graph, self.first, self.parts = graph, first, parts

    @classmethod
    def build(cls, vectors, node, n, most):
        """Of some of the ``n`` classes of a label, the first are centres and the others say how large cells are."""
        points = floats(vectors)[np.random.default_rng(n).permutation(np.argsort(node, kind="stable"))]
        centres = points[:centres_of(n)]
        graph = Graph.build(centres)[0] if len(centres) > WALKED else Graph(centres)
        counts = np.zeros(len(centres), np.int64)
        for at in range(0, len(points), QUERIES):
            np.add.at(counts, graph.nearest(points[at:at + QUERIES]), 1)
        sizes = counts * (n / len(points))
        few = graph.points[:int(np.sqrt(len(centres)))]
        near = np.concatenate([np.argmax(graph.points[at:at + QUERIES] @ few.T, axis=1) for at in range(0, len(centres), QUERIES)])
        first, parts = np.zeros(len(centres), np.int64), np.ceil(np.maximum(1, sizes / most)).astype(np.int64)
        shard, held = 0, 0
        for cell in np.argsort(near, kind="stable"):
            if held and held + sizes[cell] > most:
                shard, held = shard + 1, 0
            first[cell], held = shard, held + sizes[cell]
            if parts[cell] > 1:
                shard, held = shard + parts[cell], 0
        return cls(graph, first, parts)

    def written(self, folder):
        path, out = new_file(folder, ".centres")
        out.write(self.graph.dumped(first=self.first, parts=self.parts))
        out.close()
        return path

    @classmethod
    def read(cls, path):
        with open_file(path) as file:
            graph, held = Graph.loaded(file.read())
        return cls(graph, **held)

    def dealt(self, vectors, node):
        """The cell and the shard of classes."""
        points = floats(vectors)
        cell = np.concatenate([self.graph.nearest(points[at:at + QUERIES]) for at in range(0, len(points), QUERIES)])
        return cell, self.first[cell] + node % self.parts[cell]


class Plans:
    """The plans of the labels that have one, read as they are needed and forgotten when they are too many."""

    def __init__(self, paths):
        self.paths, self.held = paths, {}

    def of(self, label):
        if label not in self.held:
            if sum(p.graph.points.nbytes for p in self.held.values()) > HELD_BYTES:
                self.held.clear()
            self.held[label] = Plan.read(self.paths[label])
        return self.held[label]


def _plans(classes, sizes, width, folder, most):
    """Path of the plan of every label of more than one shard, on the driver."""
    large = {r.label: r.rows for r in sizes.where(F.col("rows") > most).collect()}
    if not large:
        return {}
    share = {label: min(1.0, (1 + COUNTED) * centres_of(n) / n) for label, n in large.items()}

    def plan(table):
        vectors = matrix(table.column("vector").combine_chunks(), width, np.float64)
        label = table.column("label")[0].as_py()
        made = Plan.build(vectors, table.column("node").to_numpy(), large[label], most)
        return pa.table({"label": [label], "path": [made.written(folder)]})

    draw = F.pmod(F.xxhash64("node", F.lit("centre")), F.lit(1 << 30)) / F.lit(1 << 30)
    shares = classes.sparkSession.createDataFrame(list(share.items()), "label string, share double")
    some = classes.select("label", "node", "vector", draw.alias("draw")).where(F.col("draw") < max(share.values()))
    plans = saved(some.join(shares, "label").where("draw < share").select("label", "node", "vector").groupBy(
        "label").applyInArrow(plan, "label string, path string"), "vector-plans")
    return {r.label: r.path for r in plans.collect()}


def _dealt(classes, paths, width):
    """The classes with their cell and shard; those of a label without a plan are one shard."""
    def deal(batches):
        plans = Plans(paths)
        for batch in batches:
            label, node = (batch.column(batch.schema.get_field_index(n)) for n in ("label", "node"))
            node = node.to_numpy()
            cells = batch.column(batch.schema.get_field_index("vector"))
            shard, cell = np.zeros(len(batch), np.int64), np.full(len(batch), -1, np.int64)
            coded = label.dictionary_encode()
            codes = coded.indices.to_numpy()
            for code, name in enumerate(coded.dictionary.to_pylist()):
                if name in paths:
                    some = np.flatnonzero(codes == code)
                    vectors = matrix(cells.take(pa.array(some)), width, np.float64)
                    cell[some], shard[some] = plans.of(name).dealt(vectors, node[some])
            for name, values in (("shard", shard), ("cell", cell)):
                batch = batch.append_column(name, pa.array(values, pa.int32()))
            yield batch

    if not paths:
        return classes.withColumns({"shard": F.lit(0), "cell": F.lit(-1)})
    kind = classes.schema["vector"].dataType.simpleString()
    return classes.mapInArrow(trimmed(deal), f"label string, node long, n long, vector {kind}, shard int, cell int")


def _graphs(classes, width, folder, shard_rows):
    """``label, shard, path`` of every shard."""
    most = max(1, min(shard_rows, SHARD_BYTES // (8 * max(1, width))))
    paths = _plans(classes, classes.groupBy("label").agg(F.count("*").alias("rows")), width, folder, most)
    kind = np.float32 if classes.schema["vector"].dataType.elementType.simpleString() == "float" else np.float64

    def build(table):
        vectors = matrix(table.column("vector").combine_chunks(), width, kind)
        node, rows, cell = (table.column(c).to_numpy() for c in ("node", "n", "cell"))
        if cell[0] < 0:
            shard = Shard.build(vectors, node, rows)
        else:
            some, cell = np.unique(cell, return_inverse=True)
            centres = Plan.read(paths[table.column("label")[0].as_py()]).graph.points[some]
            shard = Shard.build(vectors, node, rows, centres, cell)
        return pa.table({"label": table.column("label").slice(0, 1), "shard": table.column("shard").slice(0, 1),
                         "path": [shard.written(folder)]})

    dealt = _dealt(classes.select("label", "node", "n", "vector"), paths, width)
    return saved(dealt.groupBy("label", "shard").applyInArrow(build, "label string, shard int, path string"), "graphs")


def _pieces(graphs, least):
    """``a, b, links``: edges with ``links`` null, and the links of ``a`` in one pair of shards with ``b`` null."""
    def run(batches):
        last = (None, None)
        for batch in batches:
            for one, other in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
                if last[0] != one:
                    last = (one, Shard.read(one))
                edges, counts = linked(last[1], last[1] if other == one else Shard.read(other), least, other == one)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(edges[:, 0]), pa.array(edges[:, 1]), pa.nulls(len(edges), pa.int64())], names=["a", "b", "links"])
                for node, links in counts:
                    some = links > 0
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(node[some]), pa.nulls(int(some.sum()), pa.int64()), pa.array(links[some])],
                        names=["a", "b", "links"])

    one, other = (graphs.select("label", F.col("shard").alias(f"{n}_shard"), F.col("path").alias(n)) for n in ("one", "other"))
    pairs = saved(one.join(other, "label").where("one_shard <= other_shard").select("one", "other"), "shard-pairs")
    return saved(pairs.repartition(max(1, pairs.count()), "one", "other").mapInArrow(
        trimmed(run), "a long, b long, links long"), "vector-links")


def near_vectors(docs, id_col="vec_id", vector_col="embedding", label_col="label", least=SIMILARITY, shard_rows=SHARD_ROWS):
    """``vec_id, n_links, component_id, kept`` of every row.

    Rows of one label whose vectors have a cosine of ``least`` or more are
    linked. ``n_links`` counts the other rows that a row is linked to,
    ``component_id`` is the smallest id reachable over links, the row's own
    included, and the row with it is kept. Null labels, and vectors that are
    null, all zeros or hold null or non-finite entries, link with nothing. A
    shorter vector stands for one with zeros at its end. Repeated rows are linked
    to each other; a null id is a component's only where it has no other. Other
    columns are not looked at; an empty table gives an empty table.

    Found links are verified, so none below ``least`` is there; the audits of
    every pair of shards hold the part that is found at ``RECALL`` or more. The names
    of labels of more than one shard, and the paths of their centres, come to the driver.
    """
    given = docs.select(column(vector_col)).schema[0].dataType.simpleString() == "array<float>"
    zero = F.lit(0.0).cast("float" if given else "double")  # floats stay floats, which take half the room
    plain = F.transform(column(vector_col) if given else doubles(vector_col), lambda c: c + zero)  # no negative zero
    vector = F.when(column(label_col).isNotNull() & finite(plain) & F.exists(plain, lambda c: c != 0), plain)
    rows = docs.select(column(id_col).cast("long").alias("vec_id"), column(label_col).cast("string").alias("label"),
                       vector.alias("vector"))
    hashes = {"h": F.xxhash64("vector"), "g": F.xxhash64(F.lit(1), "vector")}  # two of 64 bits name a vector
    some = rows.where("vector is not null").withColumns(hashes)
    classes = some.groupBy("label", "h", "g", "vector").agg(F.count("*").alias("n"), F.min("vec_id").alias("least"))
    classes = saved(classes.withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    width = classes.agg(F.max(F.size("vector"))).first()[0] or 0
    spark = docs.sparkSession
    graphs = _graphs(classes, width, scratch_path(spark, "vector-graphs"), shard_rows)
    pieces = _pieces(graphs, least)
    roots = connected_components(pieces.where("links is null"))
    rooted = classes.drop("vector").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    counts = pieces.where("links is not null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    named = saved(with_least(rooted, "root", "node", component_id="least").join(counts, "node", "left").select(
        "label", "h", "g", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"), "named-vectors")
    met = rows.withColumns(hashes).select(
        "vec_id", F.when(F.col("vector").isNotNull(), F.col("label")).alias("label"), "h", "g").join(
        named, ["label", "h", "g"], "left")
    alone = F.col("n_links").isNull()
    return met.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(alone, F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id")).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
